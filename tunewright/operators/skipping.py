"""Copies clustered on several columns at once, and a manifest that rules out files before they are read.

A copy ordered by (a, b) helps filters on b little.  Here each column's values become
ranks among borders that part a sample of the rows evenly, the bits of the ranks are
interleaved, and the rows are ordered by that number (Z order), so a file covers a
small range of every column.

The manifest has one row per file: rows, and per column the smallest and largest
value, the number of nulls, and two bitmaps of hashed values (a Bloom filter of two
hash functions).  A filter is first a filter of the manifest; only files that may hold
a match are opened, and Spark applies the filter to their rows as usual.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright.operators.layout import pieces
from tunewright.session import materialised, shared_dir, table

BITS = 6
#: Rows looked at to place the borders, about.
SAMPLE = 100_000
#: Bits of one bitmap, as the engine builds them.
BITMAP_BITS = 32768
SEEDS = ("a", "b")


def borders(df, columns, bits=BITS, sample=SAMPLE):
    """Per column 2^bits - 1 or fewer rising values that part a hash sample of the rows evenly."""
    rows = df.count()
    share = min(1.0, sample / max(1, rows))
    some = df.select(*columns).where(F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about `sample` values a column, whatever the table's size
    found = some.agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in columns]).first()
    out = {}
    for c in columns:
        values, n = found[c], 1 << bits
        out[c] = sorted({values[len(values) * k // n] for k in range(1, n)}) if values else []
    return out


def rank(column, values):
    """How many borders a value has reached: a tree of comparisons, as deep as the rank has bits; null is 0."""
    def node(lo, hi):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column < F.lit(values[mid]), node(lo, mid)).otherwise(node(mid + 1, hi))
    return F.when(column.isNull(), 0).otherwise(node(0, len(values))).cast("long")


def z_order(ranks, bits=BITS):
    """The bits of several ranks in turn, from the top."""
    k = len(ranks)
    taken = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)), b * k + k - 1 - j) for j, r in enumerate(ranks) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def z_ordered_copy(df, path, columns, files=None, tie=None):
    """Copy of df as files that each cover a small box of the columns, a power of two of them or more.

    A file is a box of the leading bits.  A box with much more than its share of the
    rows is dealt into several files by `tie`, so that equal values fill no task.
    """
    at, total = borders(df, columns), BITS * len(columns)
    bits = min(total, max(0, (files or pieces(df)) - 1).bit_length())
    keyed = df.withColumn("_z", z_order([rank(F.col(c), at[c]) for c in columns])).withColumn("_box", F.shiftright("_z", total - bits))
    boxes = keyed.groupBy("_box").agg(F.count(F.lit(1)).alias("_rows"))
    # at most 2^18 boxes, and one number for all of them
    fair = F.ceil(F.sum("_rows").over(Window.partitionBy()) * 2 / (1 << bits))
    boxes = materialised(df.sparkSession, boxes.withColumn("_parts", F.ceil(F.col("_rows") / fair)), "boxes")
    boxes = boxes.select(F.col("_box").alias("_b"), "_parts", (F.sum("_parts").over(Window.orderBy("_box")) - F.col("_parts")).alias("_first"))
    n = boxes.agg(F.coalesce(F.sum("_parts"), F.lit(1))).first()[0]
    own = F.col("_first") + F.pmod(F.xxhash64(*([tie] if tie else df.columns)), F.col("_parts"))
    dealt = keyed.join(F.broadcast(boxes), F.col("_box") == F.col("_b")).repartitionById(int(n), own.cast("int"))
    dealt.sortWithinPartitions("_z").select(*df.columns).write.parquet(path)


def _bit(value, seed):
    return F.pmod(F.xxhash64(F.lit(seed), value), F.lit(BITMAP_BITS))


def manifest(spark, path, columns):
    """One row per file of a copy: file, rows, and per column a struct of lo, hi, nulls and the two bitmaps."""
    rows = spark.read.parquet(path).select(F.input_file_name().alias("file"), *columns)
    ends = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(f"_{c}") for c in columns])
    # bits are gathered in words by file, map and place: numbers in a hash table, where an aggregate of bitmaps would sort all rows
    names = [(c, s) for c in columns for s in SEEDS]
    bits = rows.select("file", F.posexplode(F.array(*[F.when(F.col(c).isNotNull(), _bit(F.col(c), s)) for c, s in names])).alias("_map", "_at")).where("_at IS NOT NULL")
    # the first byte of a word is its highest, as hex writes it
    word, bit = F.expr("_at div 64"), F.expr("shiftleft(1L, CAST((7 - _at div 8 % 8) * 8 + _at % 8 AS INT))")
    words = bits.groupBy("file", "_map", word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    found = words.groupBy("file").agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("_map") == k, F.struct("_word", "_bits")))).alias(f"_{k}") for k in range(len(names))])

    def bitmap(k):
        filled = F.coalesce(F.col(f"_{k}"), F.create_map().cast("map<bigint,bigint>"))
        return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // 64 - 1)), lambda w: F.lpad(F.hex(F.coalesce(filled[w.cast("bigint")], F.lit(0))), 16, "0")), ""))
    joined = ends.join(found, "file", "left")
    return joined.select("file", "rows", *[
        F.struct(*[F.col(f"_{c}")[x].alias(x) for x in ("lo", "hi", "nulls")], *[bitmap(names.index((c, s))).alias(f"map_{s}") for s in SEEDS]).alias(c) for c in columns])


def _has_bit(bitmap, position):
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def _in_bitmaps(entry, value):
    return reduce(lambda a, b: a & b, [_has_bit(entry[f"map_{s}"], _bit(value, s)) for s in SEEDS])


def may_match(kind, column, op, *values):
    """Whether a file may hold a row with `column op values` (the column's type is `kind`), from its manifest row; True where the manifest cannot tell."""
    # equal values only have equal hashes in one type
    entry, given = F.col(column), [F.lit(v).cast(kind) for v in values]
    lo, hi = entry["lo"], entry["hi"]
    if op in ("=", "IN"):
        test = reduce(lambda a, b: a | b, [(lo <= v) & (hi >= v) & _in_bitmaps(entry, v) for v in given])
    elif op == "BETWEEN":
        test = (hi >= given[0]) & (lo <= given[1])
    elif op in ("<", "<="):
        test = lo < given[0] if op == "<" else lo <= given[0]
    elif op in (">", ">="):
        test = hi > given[0] if op == ">" else hi >= given[0]
    elif op == "IS NULL":
        return entry["nulls"] > 0
    else:
        return F.lit(True)
    # a file of nulls alone has no smallest value, and no match
    return F.coalesce(test, F.lit(False))


def matches(column, op, *values):
    """The same condition on rows."""
    c, given = F.col(column), [F.lit(v) for v in values]
    return {"=": lambda: c == given[0], "IN": lambda: c.isin(*given), "BETWEEN": lambda: c.between(*given), "<": lambda: c < given[0], "<=": lambda: c <= given[0],
            ">": lambda: c > given[0], ">=": lambda: c >= given[0], "IS NULL": lambda: c.isNull()}[op]()


def surviving(files, conditions):
    """Rows of the manifest that may hold a match of all conditions (column, op, values...)."""
    return files.where(reduce(lambda a, b: a & b, [may_match(files.schema[c[0]].dataType["lo"].dataType, *c) for c in conditions]))


def read_matching(spark, path, files, conditions):
    """(rows that match all conditions, files opened, files there are): only files that the manifest lets through are read."""
    schema = spark.read.parquet(path).schema
    # a name a file, of files that may match
    names = [r["file"] for r in surviving(files, conditions).select("file").collect()]
    rows = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    return rows.where(reduce(lambda a, b: a & b, [matches(*c) for c in conditions])), len(names), files.count()


# ------------------------------------------------------------------ queries

Z_COLUMNS = ("l_shipdate", "l_suppkey", "l_quantity")


def z_ordered(spark, sf_dir, files=64):
    """Filters on the first, the second, the third and several columns of one copy: rows, a sum, and whether under a third of the files were opened."""
    lineitem = table(spark, sf_dir, "lineitem")
    path = shared_dir(spark, "z-ordered")
    z_ordered_copy(lineitem, path, Z_COLUMNS, files=max(files, pieces(lineitem)), tie="l_orderkey")
    index = materialised(spark, manifest(spark, path, Z_COLUMNS), "manifest")
    day = lambda text: F.lit(text).cast(lineitem.schema["l_shipdate"].dataType)
    filters = {
        "first": [("l_shipdate", "BETWEEN", day("1995-03-01"), day("1995-03-31"))],
        "second": [("l_suppkey", "=", 42)],
        "third": [("l_quantity", "<", 3)],
        "both": [("l_suppkey", "IN", 3, 4, 5), ("l_shipdate", ">=", day("1998-06-01"))],
        "none": [("l_suppkey", "=", -1)],
    }
    out = []
    for name, conditions in filters.items():
        rows, opened, there = read_matching(spark, path, index, conditions)
        out.append(rows.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.col("l_orderkey")), F.lit(0)).alias("key_sum")).select(
            F.lit(name).alias("filter"), "n_rows", "key_sum", F.lit(opened * 3 < there).alias("few_files")))
    return reduce(lambda a, b: a.unionByName(b), out)


QUERIES = {"L2_z_ordered_skipping": z_ordered}
