"""Fingerprints and groups against all pairs in plain Python."""

import re

import pytest
import xxhash

from tunewright.llm import common, simhash


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


def groups(prints):
    """{id: smallest id reachable} over (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(prints):
        low[find(k)] = min(low.get(find(k), i), i)
    return [low[find(k)] for k in range(len(prints))]


def test_against_all_pairs(spark, docs, rows_of_docs):
    path = docs.inputFiles()[0].rsplit("/documents.parquet", 1)[0]
    found = sorted(tuple(r) for r in simhash.query(spark, path).collect())
    prints = [(r[0], plain(r[1])) for r in rows_of_docs]
    assert found == sorted((i, f"{f:016x}", g) for (i, f), g in zip(prints, groups(prints)))
    assert {g for i, _, g in found if 100 <= i < 108} == {100}


def test_chain_of_two_bit_steps(spark):
    """A link needs two bits or fewer, a component may be long; bit 63 is the sign."""
    prints, fp = [], 0
    for k in range(40):
        prints.append((500 - k, fp))
        fp ^= 1 << (3 * k) % 64 | 1 << (3 * k + 1) % 64
    prints += [(1, 0b111 << 60), (2, (0b111 << 60) ^ 0b111), (3, (0b111 << 60) ^ 0b11 ^ 1 << 63)]
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in prints]
    frame = spark.createDataFrame(signed, "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.groups(spark, frame).collect()}
    assert [got[f] for _, f in signed] == groups(prints)


def test_one_large_group_stays_linear(spark):
    """All fingerprints within one bit of one: entries have 65 members at most, links stay a star."""
    frame = spark.createDataFrame([(1 << b,) for b in range(60)] + [(0,)], "fp long")
    links = simhash.links(frame)
    assert links.count() <= 61 * 65
    assert {(r.a ^ r.b).bit_count() <= 2 for r in links.collect()} == {True}


def test_stage(spark, clashing, no_docs, rows_of_docs):
    kept = simhash.deduplicated(spark, clashing)
    assert kept.columns == clashing.columns
    prints = [(r[0], plain(r[1])) for r in rows_of_docs]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups(prints)))
    assert simhash.deduplicated(spark, no_docs).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (3, 1)], [(k, k + 1) for k in range(60)] + [(100, 101)], [(0, k) for k in range(1, 50)]])
def test_components(spark, edges):
    low = {}
    for a, b in edges * len(edges):
        m = min(low.get(a, a), low.get(b, b))
        low[a] = low[b] = m
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in common.components(spark, frame, "test").collect()}
    assert got == {n: c for n, c in low.items() if any(a != b and n in (a, b) for a, b in edges)}
