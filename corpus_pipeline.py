"""A training corpus from raw documents: clean, deduplicate, mix, pack.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before
left, and returns documents with the columns of the table; the last returns the
pieces of packed sequences.  Between stages the rows are written to the shared
folder and read again, so a lost executor costs part of one stage.
"""

from tunewright.llm import mixing, packing, quality, simhash, suffix
from tunewright.llm.common import materialised


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the distance from their language reject go."""
    return quality.accepted(spark, docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash group stays."""
    return simhash.deduplicated(spark, docs)


def repeated_passages(spark, docs, sf_dir):
    """Passages of 50 bytes that also stand in a document with a smaller id are cut out."""
    return suffix.without_repeats(spark, docs)


def source_mixture(spark, docs, sf_dir):
    """Documents repeated or left out so that the sources' words meet their targets."""
    return mixing.mixture(spark, docs)


def packed_sequences(spark, docs, sf_dir):
    """Token sequences along the space-filling curve."""
    return packing.packed(spark, docs)


STAGES = [("quality_rules", quality_rules), ("simhash", near_duplicates), ("suffix_array", repeated_passages),
          ("mixing", source_mixture), ("packing", packed_sequences)]

#: Fingerprints, tilted rates and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialised(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
