"""Partial-credit expressions used by the graders.

What depends on the expected answer alone (its words, keywords, phrases) is
prepared once on the small ground-truth table, before the join.  Per submission
only plain columns remain: nothing here shuffles or leaves the JVM.
"""

from functools import reduce

from pyspark.sql import functions as F

from tunewright import dims
from tunewright.functions.text import clamp, count_hits, normalize, round4, shared, strip, texts, words


def expect_text(df, expected):
    """Prepare the expected text: normalised, distinct words, critical keywords."""
    return (df.withColumn("want_norm", normalize(expected))
            .withColumn("want_words", words(F.col("want_norm")))
            .withColumn("want_keywords", F.filter(texts(dims.CRITICAL_KEYWORDS),
                                                  lambda k: F.contains(F.col("want_norm"), k))))


def with_similarity(df, submitted, out="similarity"):
    """Add 1.0 for equal normalised text, else 0.4 word overlap + 0.6 keyword recall.

    df carries the columns of expect_text; NULL want_norm gives NULL.
    """
    keep = df.columns
    s, e, ew, keys = F.col("_s"), F.col("want_norm"), F.col("want_words"), F.col("want_keywords")
    df = df.select("*", F.when(e.isNotNull(), normalize(submitted)).alias("_s"))
    recall = F.when(F.size(keys) > 0, count_hits(s, keys) / F.size(keys)).otherwise(F.lit(0.0))
    mixed = round4(shared(s, ew) * F.lit(0.4) + recall * F.lit(0.6)).cast("double")
    sim = (F.when(e.isNull(), F.lit(None).cast("double")).when(s == e, F.lit(1.0))
           .when(F.size(ew) == 0, F.lit(0.0)).otherwise(mixed))
    return df.select(*keep, sim.alias(out))


def error_type_credit(submitted, expected, aliases):
    """0.10 for the right class, 0.05 for one of its aliases (array column)."""
    s = F.lower(strip(F.coalesce(submitted, F.lit(""))))
    return (F.when(F.coalesce(submitted, F.lit("")) == "", F.lit(0.0))
            .when(s == F.lower(strip(expected)), F.lit(0.10))
            .when(F.exists(aliases, lambda a: F.contains(s, a)), F.lit(0.05)).otherwise(F.lit(0.0)))


def location_credit(submitted, expected, place_words):
    """0.15 for the same place, else up to 0.10 for shared words (array column)."""
    missing = (F.coalesce(submitted, F.lit("")) == "") | (F.coalesce(expected, F.lit("")) == "")
    return (F.when(missing, F.lit(0.0))
            .when(F.lower(strip(submitted)) == F.lower(strip(expected)), F.lit(0.15))
            .when(F.size(place_words) < 1, F.lit(0.0))
            .otherwise(round4(shared(normalize(submitted), place_words) * F.lit(0.10)).cast("double")))


def explanation_credit(text):
    n = F.length(strip(F.coalesce(text, F.lit(""))))
    return (F.when(n < 10, F.lit(0.0)).when(n < 30, F.lit(0.05))
            .when(n < 80, F.lit(0.10)).otherwise(F.lit(0.15)))


NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def confidence_credit(text):
    """0.05 when the text is a number between 0 and 1."""
    trimmed = strip(text)
    number = F.when(F.regexp_like(trimmed, F.lit(NUMBER)), trimmed).try_cast("double")
    return F.when(number.between(0.0, 1.0), F.lit(0.05)).otherwise(F.lit(0.0))


def longer_than(text, n, credit):
    return F.when(F.length(strip(F.coalesce(text, F.lit("")))) > n, F.lit(credit)).otherwise(F.lit(0.0))


def ladder(sim, steps):
    out = F.lit(0.0)
    for at_least, credit in reversed(steps):
        out = F.when(sim >= at_least, F.lit(credit)).otherwise(out)
    return out


def first_text(*cols):
    """First non-empty text, '' if there is none."""
    return F.coalesce(*[F.when(c != "", c) for c in cols], F.lit(""))


def total(*parts):
    """Sum of credits as an exact decimal, clamped."""
    return clamp(reduce(lambda a, b: a + b, [p.cast("decimal(18,4)") for p in parts])).cast("double")


# Names of the answer fields a debugging submission may carry.
ANSWER_FIELDS = ("fixed_query", "optimized_query", "explanation", "error_type", "error_location",
                 "confidence", "impact", "root_cause", "expected_improvement", "optimization_type", "change_made")


def case_facts(cases):
    """Ground truth per task with everything the graders need prepared.

    cases: id, fixed_query, error_location, error_type, issue_type.
    """
    issue = F.lower(F.coalesce("issue_type", F.lit("")))
    phrases = texts(())
    for keys, said in reversed(dims.CONCEPTS):
        phrases = F.when(F.exists(texts(keys), lambda k: F.contains(issue, k)), texts(said)).otherwise(phrases)
    kind = F.lower(strip(F.col("error_type")))
    aliases = texts(())
    for name, words_of in dims.ERROR_TYPE_ALIASES.items():
        aliases = F.when(kind == name, texts(words_of)).otherwise(aliases)
    return expect_text(cases, F.col("fixed_query")).select(
        F.col("id").alias("task_id"), "want_norm", "want_words", "want_keywords",
        F.col("error_location").alias("want_location"), words(normalize(F.col("error_location"))).alias("want_place"),
        F.col("error_type").alias("want_type"), aliases.alias("want_aliases"),
        F.when(F.col("error_type") == "performance", texts(dims.PERFORMANCE_KEYWORDS))
        .otherwise(texts(dims.LOGIC_KEYWORDS)).alias("want_terms"),
        phrases.alias("want_phrases"))


def _easy(place):
    c = F.col
    return total(ladder(c("_sim"), dims.FIX_LADDER["easy"]), place,
                 error_type_credit(c("error_type"), c("want_type"), c("want_aliases")), c("_explained"), c("_confident"))


def _medium(place):
    c = F.col
    terms = F.least(count_hits(c("_text"), c("want_terms")) * F.lit(0.05), F.lit(0.20))
    return total(ladder(c("_sim"), dims.FIX_LADDER["medium"]), terms, place,
                 c("_explained"), c("_confident"), longer_than(c("impact"), 20, 0.05))


def _hard():
    c = F.col
    said = F.concat_ws(" ", c("_text"), F.lower(F.coalesce(c("optimization_type"), F.lit(""))))
    concept = F.least(count_hits(said, c("want_phrases")) * F.lit(0.06), F.lit(0.30))
    return total(ladder(c("_sim"), dims.FIX_LADDER["hard"]), concept, c("_explained"),
                 longer_than(c("root_cause"), 30, 0.10), longer_than(c("expected_improvement"), 20, 0.10), c("_confident"))


def with_case_grade(answers, facts, out="grade"):
    """Grade answers to debugging cases; the tier is the first part of task_id.

    answers carries task_id and ANSWER_FIELDS; facts (see case_facts) is a task
    catalogue, which Spark broadcasts as long as its size allows.  An unknown
    task gets the floor.
    """
    keep, c = answers.columns, F.col
    df = answers.join(facts, "task_id", "left")
    df = df.select("*", F.split_part("task_id", F.lit("_"), F.lit(1)).alias("_tier"))
    offered = (F.when(c("_tier") == "hard", first_text(c("optimized_query"), c("fixed_query")))
               .otherwise(first_text(c("fixed_query"), c("optimized_query"))))
    df = with_similarity(df, offered, "_sim")
    said = first_text(c("explanation"), c("change_made"))
    df = df.select("*", F.lower(said).alias("_text"), explanation_credit(said).alias("_explained"),
                   confidence_credit(c("confidence")).alias("_confident"))
    place = location_credit(c("error_location"), c("want_location"), c("want_place"))
    grade = (F.when(c("want_norm").isNull(), F.lit(0.001))
             .when(c("_tier") == "easy", _easy(place))
             .when(c("_tier") == "medium", _medium(place))
             .when(c("_tier") == "hard", _hard())
             .otherwise(F.lit(0.001)))
    return df.select(*keep, grade.alias(out))
