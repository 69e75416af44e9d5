"""The registered queries of this folder, each over its whole table, and their oracles where SQL can state them."""

from importlib import import_module

MODULES = {
    "mixing": "op1_entropy_mix", "simhash": "op2_simhash_groups", "packing": "op5_curve_packing",
    "suffix": "op6_radix_suffixes", "ngram": "op7_kneser_ney",
    "sharding": "op3_virtual_slots", "topk": "op4_block_top_k", "warc": "op8_capture_index", "quality": "op9_quality_divergence", "chat": "op10_chat_assembly",
    "toxicity": "op11_nearest_votes", "manifest": "op12_merkle_climb", "whitening": "op13_feast_whitening",
}
FLAT = "op9_quality_flat_limits"


def _module(name):
    return import_module(f"tunewright.llm.{name}")


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {key: _module(name).query for name, key in MODULES.items()} | {FLAT: _module("quality").flat_limits, "pipeline": _pipeline}


def oracles():
    return {key: _module(name).ORACLE for name, key in MODULES.items() if getattr(_module(name), "ORACLE", None)} | {FLAT: _module("quality").FLAT_ORACLE}
