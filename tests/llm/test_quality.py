"""Base rules against plain Python, distances against numpy."""

import math
import re

import pytest

from tunewright.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [s for s in text.split("\n") if WORD.search(s)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)} if len(grams) < 3000 else {
        i + k for g in [g for g in set(grams)] for at in [[i for i, x in enumerate(grams) if x == g]] if len(at) > 1 for i in at for k in range(5)}
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def test_base_measures(spark, clashing, rows_of_docs):
    found = quality.verdicts(spark, clashing).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    found = sorted(tuple(r) for r in found.collect())
    short = [r for r in rows_of_docs if r[0] != 405]
    assert [r[:-1] for r in found if r[0] != 405] == sorted((r[0], *plain(r[1])) for r in short)
    assert len(found) == len(rows_of_docs)
    kept = {r[0]: r[-1] for r in found}
    assert not any(kept[k] for k in (400, 401, 402, 403, 406, 407, 409))
    assert kept[100] and kept[300] and kept[405]


def jsd(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    half = lambda a: sum(x * math.log2(x / ((x + y) / 2)) for x, y in a if x)
    return math.sqrt((half(zip(p, q)) + half(zip(q, p))) / 2)


@pytest.mark.parametrize("p,q", [([1, 2, 3], [3, 2, 1]), ([5, 0, 0], [0, 5, 5]), ([1, 1], [2, 2]), ([0, 7, 1], [1, 0, 3])])
def test_distance(spark, p, q):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(p, q)], "p array<long>, q array<long>")
    assert frame.select(quality.distance(F.col("p"), F.col("q"))).first()[0] == pytest.approx(jsd(p, q), abs=1e-12)


def test_far_document_is_rejected(spark, docs):
    odd = spark.createDataFrame([(1000, " ".join(f"*** w{k}$$$ %%%&&&" for k in range(200)), "en", "s0")], docs.schema)
    found = {r.doc_id: r for r in quality.verdicts(spark, docs.where("doc_id <> 409").unionByName(odd)).where("doc_id in (100, 1000)").collect()}
    assert found[100].kept and not found[1000].kept and not found[1000].base_failed


def test_word_limit_follows_length(spark, docs):
    """Texts of 60 to 3,000 words: those without their language's common words go, those with them stay, short or long."""
    rows = [(2000 + k, " ".join(f"stone{i}" if i % 3 else quality.COMMON["en"][(i // 3) % 8] for i in range(n)), "en", "s0") for k, n in enumerate((60, 120, 180, 600, 3000))]
    odd = [(3000 + k, " ".join(f"pierre{i}" for i in range(n)), "en", "s0") for k, n in enumerate((60, 120, 180))]
    many = spark.createDataFrame(rows + odd, docs.schema)
    found = quality.verdicts(spark, many).collect()
    assert not any(r.base_failed for r in found) and {r.doc_id for r in found if r.kept} == set(range(2000, 2005))
    assert quality.accepted(spark, many).where("doc_id >= 3000").count() == 0


@pytest.mark.parametrize("n,far", [(49, False), (60, True), (400, True)])
def test_word_limit_by_words(spark, n, far):
    refs = spark.createDataFrame([("en", [100] * 7, [30] + [0] * 15, 100)], "_lang string, ref_classes array<long>, ref_words array<long>, ref_all long")
    one = spark.createDataFrame([("en", n, 0, [n] * 7, [0] * 16)], "_lang string, n_words long, n_repeat_words long, _classes array<long>, _per_word array<long>")
    assert quality.judged(one, refs).first().kept != far


def test_stage_and_empty(spark, clashing, no_docs):
    kept = quality.accepted(spark, clashing)
    assert kept.columns == clashing.columns
    assert kept.where("doc_id = 400").count() == 0 and kept.where("doc_id = 100 and _row = 'other'").count() == 1
    assert quality.verdicts(spark, no_docs).count() == 0 and quality.accepted(spark, no_docs).count() == 0


def test_no_python_on_the_main_path(spark, docs):
    plan = quality.verdicts(spark, docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
