"""The stages in a row, each against a brute-force version of its decision."""

from collections import Counter

import corpus_pipeline
from test_simhash import groups, plain as fingerprint
from test_suffix import plain as removed
from tunewright.llm import mixing, quality
from tunewright.llm.common import materialised


def test_stages(spark, docs):
    before, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialised(spark, stage(spark, before, ""), name)
        seen[name] = before, after
        before = after
    for name, (_, after) in list(seen.items())[:-1]:
        assert after.schema == docs.schema, name

    start, clean = seen["quality_rules"]
    kept = {r.doc_id for r in quality.verdicts(spark, start).where("kept").collect()}
    assert {r.doc_id for r in clean.collect()} == kept and clean.count() == start.where(start.doc_id.isin(sorted(kept))).count()

    start, single = seen["simhash"]
    rows = start.collect()
    prints = [(r.doc_id, fingerprint(r.text)) for r in rows]
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups(prints)))

    start, cut = seen["suffix_array"]
    want = {r[0]: r[1] - r[2] for r in removed([(r.doc_id, r.text) for r in start.collect()])}
    left = {r.doc_id: r.text for r in cut.collect()}
    # a character that only partly repeats stays, up to three bytes at either end of a span
    assert set(left) == set(want) and all(0 <= len(left[i].encode()) - want[i] <= 6 * 20 for i in want)

    start, mix = seen["mixing"]
    copies = Counter({r.doc_id: r.copies for r in mixing.mixed(spark, start).collect() if r.copies})
    assert Counter(r.doc_id for r in mix.collect()) == copies

    start, packed = seen["packing"]
    assert Counter(r.doc_id for r in start.collect()) == Counter({r.doc_id: round(r.t) for r in packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).selectExpr("doc_id", "`sum(length)` / `max(doc_tokens)` AS t").collect()})


def test_registered_and_empty(spark, no_docs, tmp_path):
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert __spark_entry__.queries()["pipeline"](spark, str(tmp_path)).count() == 0
