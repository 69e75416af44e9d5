"""Merkle manifests against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest

from tunewright.llm import manifest

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def _leaf(r):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))


def _levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][k:k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def _climb(levels, pos, h):
    siblings = ""
    for level in levels[:-1]:
        run, own = level[pos // 8 * 8:pos // 8 * 8 + 8], pos % 8
        siblings += "".join(run[:own] + run[own + 1:])
        h, pos = H("".join(run[:own] + [h] + run[own + 1:])), pos // 8
    return h, siblings


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append(r)
    trees = []
    for key in sorted(groups):
        group = sorted(groups[key], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees.append((group, _levels([_leaf(r) for r in group])))
    top = _levels([levels[-1][0] for _, levels in trees])
    out = []
    for k, (group, levels) in enumerate(trees):
        for pos, r in enumerate(group):
            t = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                t = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            h, low = _climb(levels, pos, _leaf(t))
            h, high = _climb(top, k, h)
            out.append((r[0], levels[0][pos], levels[-1][0], top[-1][0], H(low + high), h, h == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows(seed, sizes):
    rng = random.Random(seed)
    out, k = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            text = "".join(rng.choice("abcÄÖ AB\n") for _ in range(rng.randrange(0, 12)))
            out.append((k, rng.choice(("s0", None, "s:1")), lang, rng.choice((len(text), None)), rng.choice((text, text, text, None))))
            k += 1
    return out


CASES = {
    "five levels": rows(1, {"en": 4200, "de": 513, "fr": 512, None: 64, "": 8, "x": 1, "ü": 9}),
    "many groups": rows(2, {f"l{k}": 1 + k % 10 for k in range(70)}),
    "one group": rows(3, {"en": 30}),
    "one row": rows(4, {"en": 1}),
    "repeats": rows(5, {"en": 20, None: 3}) + rows(5, {"en": 20})[:6] * 9 + [(None, "s", "en", 1, "A"), (None, None, None, None, None), (0, "q", "en", 2, "B" * 70_000)],
}


@pytest.mark.parametrize("case", CASES)
def test_against_plain_trees(spark, case):
    frame = spark.createDataFrame(CASES[case], SCHEMA).selectExpr("*", "'a' AS tree", "'b' AS leaf", "1 AS pos", "2 AS row", "3 AS step").repartition(4)
    got = [tuple(r) for r in manifest.manifest(spark, frame).collect()]
    assert sorted(got, key=str) == plain(CASES[case])


def test_no_rows(spark):
    got = manifest.manifest(spark, spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_session_limit_stays(spark):
    name = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(name, "77")
    manifest.manifest(spark, spark.createDataFrame(rows(3, {"en": 100}), SCHEMA)).count()
    assert spark.conf.get(name) == "77"
    spark.conf.unset(name)
