"""Archives written and read back; index lookups against a list."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tunewright.llm import warc
from tunewright.llm.common import shared_dir


def rows(seed=3):
    rng = random.Random(seed)
    page = lambda n: "".join(rng.choice("abc é\n<>") for _ in range(n))
    big, edge, small = "é" * 500, "x" * 1000, "y" * 999
    out = [(k, f"https://{rng.choice(('www.a', 'b.a', 'c'))}.example.org{rng.choice(('', '/', '/p?q=1', '/x#y'))}", page(rng.randrange(3000))) for k in range(40)]
    out += [(100 + k, "http://hot.example.net/same", big) for k in range(30)] + [(200 + k, f"http://u@h.example:80/{k}", edge) for k in range(3)]
    out += [(300, "x", small), (301, "x", small), (302, None, None), (303, "", ""), (304, "bad url\r\nX: y", "a" * 2000), (None, "http://n/", big),
            (305, "http://m/", "m" * 1500), (305, "http://m/", "m" * 1500), (306, "http://long/", page(3_000_000))]
    rng.shuffle(out)
    return out


def plain(data):
    data = [(i, (h or "").encode()) for i, _, h in data]
    holder = {}
    for i, h in data:
        if len(h) >= 1000:
            holder.setdefault(h, []).append(i)
    out = []
    for i, h in data:
        top = max(x for x in holder[h] if x is not None) if len(holder.get(h, [])) > 1 else i
        revisit = top != i
        out.append((i, len(h), hashlib.sha1(h).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    data = rows()
    pages = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'z' AS url_key", "1 AS offset").repartition(4)
    folder = shared_dir(spark, "test-warc")
    files = warc.write_index(spark, warc.write_archives(spark, pages, folder), folder, partitions=3)
    wanted = pages.select(warc.url_key(F.col("url")).alias("url_key"), "page_id")
    assert sorted((tuple(r) for r in warc.read_back(wanted, folder, files).collect()), key=str) == plain(data)
    # one host only: the lookup finds it and nothing else
    one = warc.read_back(wanted.where("url_key like 'net,example,hot)%'"), folder, files)
    assert sorted(r.page_id for r in one.collect()) == list(range(100, 130))
    assert warc.read_back(wanted.selectExpr("'org,none)/' AS url_key", "page_id"), folder, files).count() == 0


def test_lookups_over_many_blocks(spark, monkeypatch):
    """Blocks of two lines: captures of one key go on in the next block and file."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    data = [(k % 9, f"http://h{k % 5}.example/", "t" * k) for k in range(60)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    folder = shared_dir(spark, "test-warc")
    files = warc.write_index(spark, warc.write_archives(spark, pages, folder), folder, partitions=4)
    wanted = pages.select(warc.url_key(F.col("url")).alias("url_key"), "page_id")
    assert sorted(r.payload_bytes for r in warc.read_back(wanted, folder, files).collect()) == list(range(60))


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = shared_dir(spark, "test-warc")
    files = warc.write_index(spark, warc.write_archives(spark, pages, folder), folder)
    assert files == [] and warc.read_back(pages.select(F.col("url").alias("url_key"), "page_id"), folder, files).count() == 0


@pytest.mark.parametrize("url,key", [("http://www.Example.org/a?b#c", "org,example)/a?b"), ("https://user@x.y.z:8080", "z,y,x)/"), ("nonsense", ")nonsense"), (None, ")")])
def test_url_key(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(warc.url_key(F.col("u"))).first()[0] == key


def test_damaged_payload_is_noticed():
    import zlib

    data = zlib.decompress(warc.record(1, "http://a/", b"payload", "response", None), 31).replace(b"payload", b"paYload")
    with pytest.raises(ValueError):
        warc.parsed(zlib.compress(data, wbits=31))
