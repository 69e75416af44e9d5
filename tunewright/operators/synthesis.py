"""Sampling of tasks and procedural scenario generation.

Randomness is a multiplicative congruence over a seed column, so a scenario
depends on its seed alone: reruns after a lost executor give the same rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright import dims
from tunewright.functions.text import dbl
from tunewright.operators import scan
from tunewright.session import shared_dir, table

MODULUS = 2147483647
SEEDS_PER_TASK = 50_000


def draw(seed, salt):
    """Pseudo-random integer 0 .. 2**31-2 as SQL text; two multiplicative rounds."""
    first = f"((({seed}) % {MODULUS} + {salt * 7919 + 1}) * 48271 % {MODULUS})"
    return f"(({first} + {salt}) * 69621 % {MODULUS})"


def between(seed, salt, low, high):
    return f"({low} + {draw(seed, salt)} % {high - low + 1})"


def nth(values, index):
    """values[index] as a SQL CASE."""
    arms = " ".join(f"WHEN {i} THEN {dims.quote(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def stratified_pick(df, key, stratum, k, seed=42):
    """k rows per stratum in pseudo-random order; the limit is applied map-side."""
    w = Window.partitionBy(stratum).orderBy("draw", key)
    return (df.withColumn("draw", F.expr(draw(key, seed))).withColumn("r", F.row_number().over(w))
            .where(F.col("r") <= k).drop("draw", "r"))


def fresh_pick(pool, used, key, stratum, k, seed=42):
    """k unused rows per stratum; a stratum without unused rows starts over with all of its rows."""
    left = pool.join(used.select(key).distinct(), key, "left_anti")
    alive = left.select(F.col(stratum).alias("alive")).distinct()
    over = pool.join(alive, pool[stratum] == F.col("alive"), "left_anti")
    return stratified_pick(left.unionByName(over), key, stratum, k, seed)


def mixed(c, salt):
    """draw for a column."""
    return ((c % MODULUS + (salt * 7919 + 1)) * 48271 % MODULUS + salt) * 69621 % MODULUS


def permuted(place, n, key):
    """A permutation of 0 .. n-1, another one for each key: where a place goes.

    A Feistel network over pairs (a, b) with a < r and b < s, r * s the least such
    rectangle that holds n places, permutes the rectangle; a place that leaves 0 .. n-1
    walks on along its cycle.  The cycle meets at most r * s - n places outside before
    it is back, so that many further steps are enough.
    """
    r = F.ceil(F.sqrt(n.cast("double")))
    s = F.ceil(n / r)

    def step(x):
        a, b = F.floor(x / s), x % s
        a = (a + mixed(b * 31 + key, 1)) % r
        b = (b + mixed(a * 31 + key, 2)) % s
        a = (a + mixed(b * 31 + key, 3)) % r
        return (a * s + b).cast("bigint")
    once = step(place)
    walked = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), r * s - n)), once, lambda x, _: F.when(x < n, x).otherwise(step(x)))
    return F.when(once < n, once).otherwise(walked)


def round_picks(spark, pool, requests, key, stratum):
    """For every request (stratum, nth from 0) the pool row that the nth pick of its stratum takes, and its round.

    A round takes each row once; the next one starts over in another order.  The row is
    computed from the request's number, so no list of used rows is kept or joined.
    """
    ranked = scan.numbered(spark, pool.select(key, stratum), stratum, [key])
    sizes = ranked.groupBy(F.col(stratum).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    asked = requests.join(sizes, F.col(stratum) == F.col("_of")).withColumn("round", F.floor(F.col("nth") / F.col("_n")))
    where = permuted(F.col("nth") % F.col("_n"), F.col("_n"), F.col("round") * 131 + F.crc32(F.col(stratum).cast("string")) % 65_536)
    asked = asked.withColumn("_rank", where).drop("_of", "_n")
    ranked = ranked.select(F.col(stratum).alias("_of"), F.col("rank").alias("_r"), key)
    return asked.join(ranked, (F.col(stratum) == F.col("_of")) & (F.col("_rank") == F.col("_r"))).drop("_of", "_r", "_rank")


def scenarios(seeds, seed, tier, domain=None):
    """One row per scenario: domain, distinct tables and one query per slot.

    seeds: frame with an integer column `seed`.  Five tables per domain; start
    and stride 1..4 walk them without repetition because five is prime.
    """
    spec = dims.GENERATOR_TIERS[tier]
    low, high = spec["rows"]
    names = [d for d, _ in dims.DOMAINS]
    choose = domain or f"{draw(seed, 1)} % {len(names)}"
    base = seeds.selectExpr("*", f"CAST({choose} AS INT) AS dom", f"{draw(seed, 2)} % 5 AS start", f"1 + {draw(seed, 3)} % 4 AS stride")
    per_domain = "CASE dom " + " ".join(
        f"WHEN {i} THEN array({', '.join(dims.quote(t) for t in ts)})" for i, (_, ts) in enumerate(dims.DOMAINS)) + " END"
    base = base.withColumn("names", F.expr(per_domain))
    tables = "array(" + ", ".join(
        f"named_struct('name', element_at(names, CAST((start + stride * {j}) % 5 + 1 AS INT)), 'rows', {between(seed, 10 + j, low, high)})"
        for j in range(spec["tables"])) + ")"
    base = base.withColumn("tables", F.expr(tables))
    cols = f"array({', '.join(dims.quote(c) for c in dims.FILTER_COLUMNS)})"

    def query(i):
        t = f"element_at(tables, CAST({draw(seed, 20 + i)} % {spec['tables']} + 1 AS INT))"
        a = f"{draw(seed, 30 + i)} % 6"
        b = f"({draw(seed, 30 + i)} % 6 + 1 + {draw(seed, 40 + i)} % 5) % 6"
        c1, c2 = (f"element_at({cols}, CAST({x} + 1 AS INT))" for x in (a, b))
        return (f"named_struct('id', 'q{i + 1}', 'sql', concat('SELECT * FROM ', {t}.name, ' WHERE ', {c1}, '=? AND ', {c2}, '=?'), "
                f"'avg_ms', {between(seed, 50 + i, 3000, 25000)}, 'main_table', {t}.name, 'rows_examined', {t}.rows, 'columns', array({c1}, {c2}))")
    base = base.withColumn("queries", F.expr("array(" + ", ".join(query(i) for i in range(spec["queries"])) + ")"))
    t_low, t_high = spec["target"]
    return base.selectExpr(
        "seed", f"concat('gen_{tier}_', lpad(CAST(seed AS STRING), 10, '0')) AS id", f"'{tier}' AS tier",
        f"{nth(names, 'dom')} AS domain",
        "transform(tables, t -> named_struct('name', t.name, 'rows', t.rows, 'indexes', array('PRIMARY'), 'size_mb', t.rows div 200)) AS tables",
        "queries AS slow_queries",
        "transform(queries, q -> named_struct('table', q.main_table, 'columns', q.columns, 'reason', concat('Composite WHERE clause on ', q.main_table))) AS missing_index_hints",
        f"{between(seed, 4, 30, 120)} AS baseline_tenths", f"{between(seed, 5, t_low * 10, t_high * 10)} AS target_tenths",
        f"{spec['max_steps']} AS max_steps")


def seeds_of(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seed"))


def flat(made):
    """One row per slow query, in comparable types."""
    rows = made.select(
        "seed", "id", "tier", "domain", "max_steps", "baseline_tenths", "target_tenths",
        F.array_join(F.transform("tables", lambda t: F.concat_ws(":", t["name"], t["rows"], t["size_mb"])), ",").alias("tables"),
        F.posexplode(F.arrays_zip("slow_queries", "missing_index_hints")).alias("pos", "z"))
    q, h = F.col("z.slow_queries"), F.col("z.missing_index_hints")
    return rows.select("id", "tier", "domain", "tables", F.col("max_steps").cast("int").alias("max_steps"),
                       dbl(F.col("baseline_tenths") / 10, "baseline"), dbl(F.col("target_tenths") / 10, "target"),
                       q["id"].alias("query_id"), q["sql"].alias("sql_text"), q["avg_ms"].alias("avg_ms"),
                       q["rows_examined"].alias("rows_examined"), F.array_join(h["columns"], ",").alias("hint_columns"))


def stratified(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    return stratified_pick(p, "p_partkey", "p_type", 5)


def no_repeat(spark, sf_dir):
    """Unused parts per type; the type ECONOMY is used up and starts over."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    used = p.where("p_type = 'ECONOMY' OR p_partkey % 3 = 0")
    return fresh_pick(p, used, "p_partkey", "p_type", 5)


def picks_by_round(spark, sf_dir):
    """Each event asks for a part of one size; of a size all parts are handed out before one comes again."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("event_id") % 50 + 1).cast("int").alias("p_size"))
    asked = scan.running(events, "p_size", ("ts", "event_id"), {"nth": ("sum", F.lit(1))}).withColumn("nth", F.col("nth") - 1)
    pool = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return round_picks(spark, pool.withColumn("p_size", F.col("p_size").cast("int")), asked, "p_partkey", "p_size").select("event_id", "p_size", "round", "p_partkey")


def generated(spark, sf_dir):
    return flat(scenarios(seeds_of(spark, sf_dir), "seed", "hard"))


def balanced(spark, sf_dir):
    """The i-th scenario takes the i-th domain, cycling."""
    made = scenarios(seeds_of(spark, sf_dir), "seed", "medium", domain=f"seed % {len(dims.DOMAINS)}")
    return made.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.sum("target_tenths").alias("target_sum"))


def augmented(spark, sf_dir):
    """Scenarios of all tiers written by tier and read back."""
    path = shared_dir(spark, "augmented")
    seeds = seeds_of(spark, sf_dir)
    # a row becomes many wide ones: small files of seeds are spread over tasks
    seeds = seeds.repartition(max(1, -(-seeds.count() // SEEDS_PER_TASK)), "seed")
    for tier in dims.GENERATOR_TIERS:  # a folder each, so that no task sorts its rows by tier
        flat(scenarios(seeds, "seed", tier)).drop("tier").write.parquet(f"{path}/tier={tier}")
    return spark.read.parquet(path).groupBy("tier").agg(
        F.count(F.lit(1)).alias("queries"), F.count_distinct("id").alias("scenarios"), F.sum("avg_ms").alias("ms"),
        F.max("rows_examined").alias("max_rows"))


def ultra(spark, sf_dir):
    """Largest tier: 5-8 of ten tables, 4-6 queries, tight budget, no hints.

    Start and stride 1, 3, 7 or 9 walk ten tables without repetition.
    """
    s = "seed"
    base = seeds_of(spark, sf_dir).selectExpr(
        "seed", f"{between(s, 61, 5, 8)} AS n_tables", f"{between(s, 62, 4, 6)} AS n_queries", f"{between(s, 63, 30, 40)} AS max_steps",
        f"{between(s, 64, 650, 720)} AS target_tenths", f"{draw(s, 65)} % 10 AS start",
        f"{nth((1, 3, 7, 9), draw(s, 66) + ' % 4')} AS stride")
    names = f"array({', '.join(dims.quote(t) for t in dims.ULTRA_TABLES)})"
    base = base.selectExpr("*", f"transform(sequence(0, n_tables - 1), j -> element_at({names}, CAST((start + stride * j) % 10 + 1 AS INT))) AS names")
    item = draw("seed * 31 + i", 70)
    ms = f"8000 + {draw('seed * 31 + i', 71)} % 22001"
    rows = base.selectExpr("seed", "n_tables", "max_steps", "target_tenths", "names", "explode(sequence(1, n_queries)) AS i")
    return rows.selectExpr(
        "concat('ultra_', seed) AS id", "n_tables", "max_steps", "CAST(target_tenths AS DOUBLE) / 10 AS target",
        "array_join(names, ',') AS tables", "concat('q', i) AS query_id",
        f"concat('SELECT * FROM ', element_at(names, CAST({item} % n_tables + 1 AS INT)), ' WHERE user_id=? AND status=? AND created_at > ?') AS sql_text",
        f"{ms} AS avg_ms")


QUERIES = {
    "S1_stratified_pick": stratified,
    "S2_no_repeat_pick": no_repeat,
    "S2_round_picks": picks_by_round,
    "S3_generated_scenarios": generated,
    "S4_balanced_batch": balanced,
    "S5_augmentation": augmented,
    "S6_ultra_tier": ultra,
}
