"""Merkle manifest of a corpus, and proofs checked by a recursive query.

A row's leaf is the digest of its fields, a group's leaves ascend by id, and runs of
eight digests become one digest a level up until one is left, the subroot.  The
subroots, in the order of their groups, make a tree of the same kind up to the root.

Leaves get their places from one global sort, whose partitions are numbered and
counted, so no window spans a group.  Every run of every level is a row: its
digests, and the link to its own digest's place a level up.  The runs of the upper
levels are ancestors of very many leaves; they are repeated for each cell of 512
consecutive leaves (one row a cell and level), so that no key is met by more than a
cell's leaves.

Spark's recursive query starts from each leaf, tampered or not: a step meets the
run that the current digest stands in, appends the place there, which names the
digest's siblings, puts the digest between them and folds them to the digest one
level up.  The appended siblings are read from the cell's runs once, at the end,
instead of carrying seven more digests through every step.

Defined cases: null fields count as `-`, a null group is a group of its own and the
first; rows that share an id stand in the order of their leaves; equal rows are
leaves of their own; a null id is smaller than any; a row whose id's checksum is
not a multiple of three, or null, is not tampered with; a single row is its own root
and proves itself with no siblings; an empty table gives no rows; other columns, of
whatever name, are not read.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tunewright.llm.common import materialised

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, CELL_LEVELS = 8, 3
CELL = ARITY ** CELL_LEVELS
TAMPER_MODULUS = 3
#: Levels that a climb may have: ARITY ** 64 leaves.
MOST_LEVELS = 64
TOP = "top"


def digest(*parts):
    return F.sha2(F.concat(*parts), 256)


def field(c):
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields=FIELDS, key="doc_id", group="lang", text="text") -> DataFrame:
    """(doc_id, tree, leaf, tampered): digests of a row as it is and as tampering would leave it."""
    lowered = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.coalesce(F.crc32(F.col(key).cast("string")) % TAMPER_MODULUS == 0, F.lit(False))
    of = lambda change: digest(*[field(change if c == text else F.col(c)) for c in fields])
    return docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.unhex(of(F.col(text))).alias("leaf"), F.when(hit, F.unhex(of(lowered))).alias("tampered"))


def numbered(spark: SparkSession, rows: DataFrame, order, purpose) -> DataFrame:
    """Rows with `pos`, their place from 0 in their tree by `order`; one global sort and one row a task and tree beside it."""
    at = "_at"
    rows = materialised(spark, rows.withColumn("_id", F.monotonically_increasing_id()), purpose)
    rows = materialised(spark, rows.orderBy("tree", *order, "_id").drop("_id").withColumn(at, F.monotonically_increasing_id()), purpose)
    # rows of one task are numbered through: its first number and its count place them
    task = F.shiftright(at, 33).alias("_task")
    counts = rows.groupBy("tree", task).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_first"))
    earlier = Window.partitionBy("tree").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("tree", "_task", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (rows.withColumn("_task", task).join(before, ["tree", "_task"])
            .withColumn("pos", F.col("_before") + F.col(at) - F.col("_first")).drop("_task", "_first", "_before", at))


def runs_of(nodes: DataFrame) -> DataFrame:
    """(tree, run, digests): runs of neighbouring digests of one level (tree, pos, hash)."""
    part = F.array_sort(F.collect_list(F.struct("pos", "hash")))
    return nodes.groupBy("tree", F.floor(F.col("pos") / ARITY).alias("run")).agg(F.transform(part, lambda x: x["hash"]).alias("digests"))


def folded(digests):
    return F.unhex(F.sha2(F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), ""), 256))


def forest(spark: SparkSession, nodes: DataFrame, purpose):
    """(runs of all levels, roots): runs (tree, level, run, digests) of every tree over its leaves (tree, pos, hash); roots (tree, height, hash)."""
    sizes = materialised(spark, nodes.groupBy("tree").agg(F.max("pos").alias("last")), purpose)
    levels, roots = [], [nodes.where("pos = 0").join(sizes.where("last = 0"), "tree", "left_semi").select("tree", F.lit(0).alias("height"), "hash")]
    deepest = sizes.agg(F.max("last")).first()[0] or 0
    level, last = 0, F.col("last")
    while deepest > 0:
        # trees whose level is one digest are done
        open_trees = sizes.where(last > 0).select("tree")
        runs = materialised(spark, runs_of(nodes.join(open_trees, "tree", "left_semi")).withColumn("level", F.lit(level)), purpose)
        levels.append(runs)
        nodes = runs.select("tree", F.col("run").alias("pos"), folded("digests").alias("hash"))
        last, deepest, level = F.floor(last / ARITY), deepest // ARITY, level + 1
        done = sizes.where((last == 0) & (F.floor(F.col("last") / ARITY ** (level - 1)) > 0)).select("tree")
        roots.append(nodes.join(done, "tree", "left_semi").select("tree", F.lit(level).alias("height"), "hash"))
    union = lambda parts: parts[0] if len(parts) == 1 else union([parts[0].unionByName(parts[1]), *parts[2:]])
    empty = spark.createDataFrame([], "tree string, level int, run long, digests array<binary>")
    return (union(levels) if levels else empty), materialised(spark, union(roots), purpose)


def cells_of(spark, sizes, runs, top_runs, top_height):
    """Runs as (tree, cell, step, run, digests, up): each cell of leaves with every run above it, and the place of its digest a step up.

    sizes: (tree, height, last, top_pos).  Steps count the levels of the leaf's own
    tree and go on through the top tree.
    """
    cells = sizes.select("tree", "height", "top_pos", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / CELL))).alias("cell"))
    inner = runs.join(sizes.select("tree", "height", "top_pos"), "tree")
    up = F.when(F.col("level") + 1 == F.col("height"), F.col("top_pos")).otherwise(F.col("run"))
    low = inner.where(F.col("level") < CELL_LEVELS).select(
        "tree", F.expr(f"run div cast(power({ARITY}, {CELL_LEVELS - 1} - level) as bigint)").alias("cell"), F.col("level").alias("step"), "run", "digests", up.alias("up"))
    above = cells.select("tree", "cell", "height", F.explode(F.expr(f"if(height > {CELL_LEVELS}, sequence({CELL_LEVELS}, height - 1), cast(array() as array<int>))")).alias("level")).withColumn(
        "run", F.expr(f"cell div cast(power({ARITY}, level + 1 - {CELL_LEVELS}) as bigint)"))
    high = above.drop("height").join(inner, ["tree", "level", "run"]).select("tree", "cell", F.col("level").alias("step"), "run", "digests", up.alias("up"))
    if not top_height:
        return low.unionByName(high)
    # the top tree's runs, for the cells of every group below them
    ways = cells.select("tree", "cell", "height", "top_pos", F.explode(F.sequence(F.lit(0), F.lit(top_height - 1))).alias("level")).withColumn(
        "run", F.expr(f"top_pos div cast(power({ARITY}, level + 1) as bigint)"))
    top = ways.join(top_runs.select("level", "run", "digests"), ["level", "run"]).select(
        "tree", "cell", (F.col("height") + F.col("level")).alias("step"), "run", "digests", F.col("run").alias("up"))
    return low.unionByName(high).unionByName(top)


CLIMB = """
WITH RECURSIVE climb(row, tree, cell, steps, step, pos, hash, path) MAX RECURSION LEVEL {most} AS (
  SELECT row, tree, cell, steps, 0, pos, hash, array(pos) FROM {leaves}
  UNION ALL
  SELECT c.row, c.tree, c.cell, c.steps, c.step + 1, n.up,
    unhex(sha2(array_join(transform(n.digests, (d, i) -> lower(hex(if(i = c.pos % {arity}, c.hash, d)))), ''), 256)),
    array_append(c.path, n.up)
  FROM climb c JOIN {runs} n ON n.tree = c.tree AND n.cell = c.cell AND n.step = c.step AND n.run = c.pos div {arity}
)
SELECT row, tree, cell, hash, path FROM climb WHERE step = steps
"""


def climbed(spark: SparkSession, starts: DataFrame, cells: DataFrame) -> DataFrame:
    """(row, tree, cell, hash, path): the root that every leaf's digest folds to, and the places passed on the way.

    The session's limit of rows a recursive query may return is lifted while it runs:
    it returns one row a leaf and step.
    """
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        text = CLIMB.format(leaves="{leaves}", runs="{runs}", most=MOST_LEVELS, arity=ARITY)
        return materialised(spark, spark.sql(text, leaves=starts, runs=cells), "merkle-climb")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def proofs(paths: DataFrame, cells: DataFrame) -> DataFrame:
    """paths with proof_sha256: the siblings of every place on the way, level by level, digested."""
    # a cell has at most CELL / 7 runs and one more a level above it
    rows = F.array_sort(F.collect_list(F.struct("step", "run", "digests")))
    cell = cells.groupBy("tree", "cell").agg(rows.alias("runs")).select(
        "tree", "cell", "runs.digests", F.expr("transform(sequence(0, array_max(runs.step)), s -> array_position(runs.step, s) - 1 - runs.run[cast(array_position(runs.step, s) - 1 as int)])").alias("base"))
    sibling = F.expr(f"""array_join(transform(slice(path, 1, size(path) - 1), (pos, s) ->
        array_join(transform(filter(digests[cast(base[s] + pos div {ARITY} as int)], (d, i) -> i <> pos % {ARITY}), d -> lower(hex(d))), '')), '')""")
    found = paths.join(cell, ["tree", "cell"], "left")
    return found.select("row", "hash", F.sha2(F.when(F.size("path") > 1, sibling).otherwise(F.lit("")), 256).alias("proof_sha256"))


def manifest(spark: SparkSession, docs: DataFrame, fields=FIELDS, key="doc_id", group="lang", text="text") -> DataFrame:
    """One row per document: its leaf, subroot, root, proof, and whether the tampered document still folds to the root."""
    rows = numbered(spark, leaves(docs, fields, key, group, text), ("doc_id", "leaf"), "merkle-leaves")
    rows = materialised(spark, rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    runs, subroots = forest(spark, rows.select("tree", "pos", F.col("leaf").alias("hash")), "merkle-levels")
    tops = numbered(spark, subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "height", "hash"), ("of",), "merkle-top")
    tops = materialised(spark, tops, "merkle-top")
    top_runs, root = forest(spark, tops.select("tree", "pos", "hash"), "merkle-top")
    root = root.first()
    if root is None:
        return spark.createDataFrame([], rows.select("doc_id").schema.add("leaf", "string").add("subroot", "string").add("root", "string").add(
            "proof_sha256", "string").add("folded_root", "string").add("verified", "boolean"))
    groups = tops.select(F.col("of").alias("tree"), "height", F.col("pos").alias("top_pos"), F.lower(F.hex("hash")).alias("subroot"))
    sizes = rows.groupBy("tree").agg(F.max("pos").alias("last")).join(groups, "tree")
    sizes = materialised(spark, sizes, "merkle-top")
    cells = materialised(spark, cells_of(spark, sizes, runs, top_runs, root["height"]), "merkle-cells")
    # a tree of one leaf is a place of the top tree at once
    starts = rows.join(sizes.select("tree", "height", "top_pos"), "tree").select(
        "row", "tree", F.floor(F.col("pos") / CELL).alias("cell"), (F.col("height") + root["height"]).alias("steps"),
        F.when(F.col("height") == 0, F.col("top_pos")).otherwise(F.col("pos")).alias("pos"), F.coalesce("tampered", "leaf").alias("hash"))
    proved = proofs(climbed(spark, starts, cells), cells)
    whole = F.lit(bytes(root["hash"]))
    return rows.join(proved, "row").join(groups.select("tree", "subroot"), "tree").select(
        "doc_id", F.lower(F.hex("leaf")).alias("leaf"), "subroot", F.lower(F.hex(whole)).alias("root"), "proof_sha256",
        F.lower(F.hex("hash")).alias("folded_root"), (F.col("hash") == whole).alias("verified"))


def query(spark, sf_dir):
    return manifest(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _field(c):
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf(text):
    return "sha256(" + " || ".join(_field(text if c == "text" else c) for c in FIELDS) + ")"


_BYTE = "list_reduce(list_concat([xor(c, b)], [0::BIGINT for z in range(8)]), lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"
_CRC = f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii((doc_id::VARCHAR)[i])::BIGINT for i in range(1, strlen(doc_id::VARCHAR) + 1)]), lambda c, b: {_BYTE}))"""

#: The levels are built by one recursive query, the siblings are a join on places, and a second recursive query climbs.
ORACLE = f"""
WITH RECURSIVE l0 AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l0),
low(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, n FROM l
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM low WHERE n > 1 GROUP BY tree, pos // 8),
sub AS (SELECT tree, level AS height, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
top(level, pos, h, n) AS (
  SELECT 0, pos, h, n FROM sub
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM top WHERE n > 1 GROUP BY pos // 8),
nodes AS (SELECT tree, level AS step, pos, h FROM low WHERE n > 1
  UNION ALL SELECT s.tree, s.height + t.level, t.pos, t.h FROM sub s, top t WHERE t.n > 1),
way AS (SELECT l.r, l.tree, s.height, s.pos AS top_pos, l.pos FROM l JOIN sub s USING (tree)),
steps AS (SELECT r, tree, k AS step, CASE WHEN k < height THEN pos // (8 ** k)::BIGINT ELSE top_pos // (8 ** (k - height))::BIGINT END AS pos FROM way, range(0, 20) g(k)),
sib AS (SELECT s.r, s.step, s.pos % 8 AS own, list(n.h ORDER BY n.pos) AS run, string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> s.pos) AS others
  FROM steps s JOIN nodes n ON n.tree = s.tree AND n.step = s.step AND n.pos // 8 = s.pos // 8 GROUP BY s.r, s.step, s.pos),
proof AS (SELECT r, sha256(coalesce(string_agg(others, '' ORDER BY step), '')) AS p, count(*) AS k FROM sib GROUP BY r),
climb(r, step, h) AS (
  SELECT r, 0, coalesce(tampered, leaf) FROM l
  UNION ALL
  SELECT c.r, c.step + 1, sha256(array_to_string(list_concat(s.run[1:s.own], [c.h], s.run[s.own + 2:]), '')) FROM climb c JOIN sib s ON s.r = c.r AND s.step = c.step),
root AS (SELECT h FROM top WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, c.h AS folded_root, c.h = root.h AS verified
FROM l JOIN sub s USING (tree) CROSS JOIN root LEFT JOIN proof p ON p.r = l.r JOIN climb c ON c.r = l.r AND c.step = coalesce(p.k, 0)
"""
