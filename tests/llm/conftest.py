import random

import pytest
from pyspark.sql import types as T

WORDS = "the of and to river stone light carry window paper green seven table cloud horse bread glass music number winter".split()
#: Names that operators use inside; the input's own columns of these names must neither break them nor be read.
CLASHING = ("size", "slot", "shard", "fp", "_row", "chunk", "curve", "_text", "n", "src", "copies", "kept", "_words", "bucket", "root")


def _text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "", ",", ".")) for _ in range(n))


def edge_rows(seed=7):
    """(doc_id, text, lang, source): copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    base, shared = _text(rng, 120), _text(rng, 30)
    rows = [(k, _text(rng, rng.randrange(12, 160)), rng.choice(("en", "de", "xx")), f"s{k % 4}") for k in range(24)]
    rows += [(100 + k, base, "en", "s0") for k in range(8)]
    rows += [(200 + k, base.replace(" ", "  ", 1) + f" tail{k}", "en", "s0") for k in range(6)]
    rows += [(300 + k, _text(rng, 20) + " " + shared + " " + _text(rng, 15), "fr", "s1") for k in range(6)]
    rows += [(400, None, "en", "s2"), (401, "", None, "s2"), (402, " \t\n ", "en", None), (403, "one two", "es", None),
             (404, "Ünï cödé 漢字 🙂 " * 9, "de", "s3"), (405, _text(rng, 30_000), "en", "s3"), (406, None, None, None),
             (407, "tara " * 200, "en", "s1"), (408, "a\nb\na\n\nb " + base, "en", "s1"), (409, "### ||| %%% " * 40, "en", "s0")]
    rows += [rows[0], rows[0], (410, "x" * 49, "en", "s0"), (411, "x" * 50, "en", "s0"), (412, "x" * 51, "en", "s0"), (413, "tara " * 201, "en", "s1")]
    rng.shuffle(rows)
    return rows


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


@pytest.fixture(scope="session")
def rows_of_docs():
    return edge_rows()


@pytest.fixture(scope="session")
def docs(spark, rows_of_docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows_of_docs, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with columns that are named as the operators' own."""
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'other' AS {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
