"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, how often the mix takes it.  Among all rates that give
each source its target number of words and lie between 0 and 3, those nearest to
1 in relative entropy are exponentially tilted, ``min(3, exp(lambda z))`` with z the
document's size over its source's typical size and one lambda per source.  The
lambdas solve a convex dual: each Newton iteration sums gradient and curvature
over the documents in one aggregate (documents of one source and size count
together), and a bracket keeps steps that overshoot inside.  Sources are rows of a
table, never of the driver.

Rates become whole copies by running sums in the order of size, so what is rounded
off one size is made up by the next.  What is still open, up to half the largest
document, is then filled (or taken away) by a running sum of words over the copies
that are free, the largest that fit first, until every free copy is larger than the
rest; a last single copy may bring a source closer.  Copies of a cell (source
and size) are dealt to its documents in the order of a hash; a cell of many
documents, such as a group of exact copies, is cut by another hash first.

Defined cases: a null text has size 0; a null source is a source of its own, the
last; size 0 takes nothing; a source without words has target 0; rows that share an
id are documents of their own; an empty table gives no rows; other columns, of
whatever name, are not read.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tunewright.llm.common import WORD, materialised

MOST = 3  # copies of a document, and words of a source's target per word it has
WEIGHTS = (1, 2, 3)
CELL = 200  # documents of a cell that are ranked together
ITERATIONS, CLOSE = 60, 1e-10


def sized(docs: DataFrame, key="doc_id", text="text", source="source") -> DataFrame:
    """(doc_id, source key, size): words of the text."""
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("src"),
                       F.col(source).isNull().alias("last"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(cells: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(src, source_size, target) from (src, last, size, n): shares by weight of all words, held at MOST times the source's own.

    A level c with target = min(MOST * size, c * weight): sources in the order in
    which they are filled, c from the words that the filled ones leave over.  One
    row per source passes through the windows.
    """
    sources = cells.groupBy("src").agg(F.first("last").alias("last"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy("last", "src")) - 1
    sources = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    sources = sources.withColumns({
        "full": MOST * F.col("source_size") / F.col("weight"),
        "left": F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(MOST * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
    level = F.min(F.when(F.col("left") / F.col("open") <= F.col("full"), F.struct(F.col("source_size") / F.col("weight"), "src", (F.col("left") / F.col("open")).alias("c"))))
    return sources.withColumn("c", level.over(Window.partitionBy())["c"]).select(
        "src", "source_size", F.least(MOST * F.col("source_size").cast("double"), F.coalesce("c", F.lit(0.0)) * F.col("weight")).alias("target"))


def rate(lam, size, scale):
    return F.least(F.lit(float(MOST)), F.exp(lam * size / scale))


def balanced(spark: SparkSession, cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """(src, source_size, target, scale, lambda): the dual solved by Newton steps, each over all cells."""
    scale = cells.groupBy("src").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.nullif(F.sum(F.col("n") * F.col("size")), F.lit(0))).alias("scale"))
    solvable = (F.col("target") > 0) & (F.col("target") < MOST * F.col("source_size"))
    state = wanted.join(scale, "src").select("src", "source_size", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"), (~solvable).alias("done"),
                                             F.when(F.col("target") > 0, F.when(solvable, 0.0).otherwise(1e12)).otherwise(-1e12).alias("lam"),
                                             F.lit(-1e9).alias("low"), F.lit(1e9).alias("high"))
    state = materialised(spark, state, "mix-state")
    tilt = F.exp(F.col("lam") * F.col("size") / F.col("scale"))
    words = F.col("n") * F.col("size")
    for _ in range(ITERATIONS):
        sums = cells.join(state.where("not done"), "src").groupBy("src").agg(
            F.sum(words * F.least(F.lit(float(MOST)), tilt)).alias("got"),
            F.sum(F.when(tilt < MOST, words * F.col("size") / F.col("scale") * tilt).otherwise(0.0)).alias("slope"))
        off = F.col("got") - F.col("target")
        low, high = F.when(off < 0, F.col("lam")).otherwise(F.col("low")), F.when(off > 0, F.col("lam")).otherwise(F.col("high"))
        step = F.col("lam") - off / F.nullif(F.col("slope"), F.lit(0.0))
        # halving by size rather than by value: the bracket spans many powers of ten
        middle = F.when(low >= 1e-3, F.sqrt(low * high)).when(high <= -1e-3, -F.sqrt(low * high)).when(low >= 0, F.least(high, F.lit(2e-3)) / 2 + low / 2).when(
            high <= 0, F.greatest(low, F.lit(-2e-3)) / 2 + high / 2).when(off < 0, F.least(high, F.lit(1.0)) / 2).otherwise(F.greatest(low, F.lit(-1.0)) / 2)
        inside = step.isNotNull() & (step > low) & (step < high)
        done = F.col("done") | (F.abs(off) <= CLOSE * F.col("target"))
        state = materialised(spark, state.join(sums, "src", "left").select(
            "src", "source_size", "target", "scale", F.coalesce(done, F.lit(True)).alias("done"),
            F.when(F.coalesce(done, F.lit(True)), F.col("lam")).when(inside, step).otherwise(middle).alias("lam"), low.alias("low"), high.alias("high")), "mix-state")
        if not state.where("not done").take(1):
            break
    return state.select("src", "source_size", "target", "scale", F.round("lam", 9).alias("lam"))


def closer(frame: DataFrame) -> DataFrame:
    """copies changed towards the target: many at once where free copies fit into the gap, else a single one; moving: the gap has halved.

    The cell at which the running sum stops is larger than what is left, and no larger
    than the gap, so a pass that takes several halves the gap.
    """
    whole = Window.partitionBy("src")
    largest = whole.orderBy(F.desc("size"))
    frame = frame.withColumn("lack", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(whole)).withColumn("gap", F.abs("lack"))
    frame = frame.withColumn("free", F.when(F.col("size") <= 0, 0).when(F.col("lack") > 0, MOST * F.col("n") - F.col("copies")).otherwise(F.col("copies")))
    fits = F.when(F.col("size") <= F.col("gap"), F.col("free") * F.col("size")).otherwise(0)
    before = F.coalesce(F.sum(fits).over(largest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    many = F.when(fits > 0, F.greatest(F.lit(0), F.least("free", F.floor((F.col("gap") - before) / F.nullif("size", F.lit(0)))))).otherwise(0)
    miss = F.abs(F.col("gap") - F.col("size"))
    frame = frame.withColumn("many", many.cast("long")).withColumn("filled", F.sum(F.col("many") * F.col("size")).over(whole))
    frame = frame.withColumn("best", F.min(F.when((F.col("free") > 0) & (miss < F.col("gap")), F.struct(miss.alias("miss"), F.col("size").alias("size")))).over(whole))
    single = F.when(F.col("best.size") == F.col("size"), 1).otherwise(0)
    change = F.signum("lack").cast("long") * F.when(F.col("filled") > 0, F.col("many")).otherwise(single)
    rest = F.when(F.col("filled") > 0, F.col("gap") - F.col("filled")).otherwise(F.col("best.miss"))
    return frame.select("src", "size", "n", (F.col("copies") + change).alias("copies"), "source_size", "target", "rate",
                        F.coalesce(2 * rest <= F.col("gap"), F.lit(False)).alias("moving"))


def copies_of_cells(spark: SparkSession, cells: DataFrame, solved: DataFrame) -> DataFrame:
    """(src, size, n, copies, source_size, target): rates of all documents of a cell rounded into whole copies."""
    by_size = Window.partitionBy("src").orderBy("size")
    frame = cells.select("src", "size", "n").join(solved, "src").withColumn("rate", rate(F.col("lam"), F.col("size"), F.col("scale")))
    frame = frame.withColumn("run", F.sum(F.when(F.col("size") > 0, F.col("n") * F.col("rate")).otherwise(0.0)).over(by_size))
    frame = frame.withColumn("copies", (F.floor(F.col("run") + 0.5) - F.floor(F.coalesce(F.lag("run").over(by_size), F.lit(0.0)) + 0.5)).cast("long"))
    while True:
        frame = materialised(spark, closer(frame), "mix-copies")
        if not frame.where("moving").take(1):
            return frame.drop("moving")


def mixed(spark: SparkSession, docs: DataFrame, key="doc_id", text="text", source="source") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate and the source key for every document."""
    sizes = materialised(spark, sized(docs, key, text, source), "mix-sizes")
    cells = materialised(spark, sizes.groupBy("src", "size").agg(F.first("last").alias("last"), F.count("*").alias("n")), "mix-cells")
    solved = balanced(spark, cells, targets(cells))
    rounded = copies_of_cells(spark, cells, solved)
    # no more than CELL documents, or 1/65536 of the cell, are ranked together
    parts = F.greatest(F.lit(1), F.least(F.lit(65536), F.ceil(F.col("n") / CELL)))
    rows = sizes.select("doc_id", "src", "size").join(rounded, ["src", "size"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), parts))
    part = rows.groupBy("src", "size", "part", "n", "copies").agg(F.count("*").alias("m"))
    run = F.sum("m").over(Window.partitionBy("src", "size").orderBy("part"))
    part = part.withColumn("run", run).select("src", "size", "part", "m", (
        F.floor(F.col("copies") * F.col("run") / F.col("n")) - F.floor(F.col("copies") * (F.col("run") - F.col("m")) / F.col("n"))).cast("long").alias("dealt"))
    rows = rows.join(part, ["src", "size", "part"])
    rank = F.row_number().over(Window.partitionBy("src", "size", "part").orderBy(F.xxhash64("doc_id", "size"), "doc_id"))
    copies = F.floor(F.col("dealt") / F.col("m")) + F.when(F.col("rank") <= F.col("dealt") % F.col("m"), 1).otherwise(0)
    return rows.withColumn("rank", rank).withColumn("copies", copies.cast("long")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate", "src")


def mixture(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with their columns."""
    nth = lambda frame: frame.withColumn("_nth", F.row_number().over(Window.partitionBy("_id").orderBy("_src", "_size")))
    taken = mixed(spark, docs).select(F.col("doc_id").alias("_id"), F.col("src").alias("_src"), F.col("size").alias("_size"), F.col("copies").alias("_copies"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"),
                       F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("_src"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("_size"))
    left, right = nth(rows), nth(taken).select(F.col("_id").alias("_i"), F.col("_nth").alias("_k"), "_copies")
    both = left.join(right, left["_id"].eqNullSafe(right["_i"]) & (left["_nth"] == right["_k"])).where("_copies > 0")
    return both.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    return mixed(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("src")
