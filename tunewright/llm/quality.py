"""Quality rules: fixed base rules, and how far a text is from its language.

Each document gets two histograms, of character classes and of the common words
of its language.  The same histograms summed over all documents of a language
are that language's reference, and the Jensen-Shannon distance (square root of
the divergence to base 2, so 0 to 1) between the two must stay under a limit.
A text shorter than the guards has too few characters or words for a histogram
to say anything and passes that rule.

Everything is a DataFrame expression: arrays and regular expressions inside one
projection per document, one small aggregate for the references.

Defined cases: a null text is an empty one (no words, base rule fails); a
language that is null or has no word list shares the reference `other`, which
has character classes only; repeated rows are judged each by itself; columns of
the input may have any names, also those used here.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tunewright.llm.common import GAP, materialised, packed_row, unpacked, words_of

# Frequent function words by language.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "was", "on", "with", "as", "by", "it", "from", "be"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su"),
}
SPELLINGS = sorted({s for v in COMMON.values() for w in v for s in (w, w.upper(), w.capitalize())})
OTHER = "other"
#: Character classes in the order in which they are taken out of the text.
CLASSES = (("lower", r"\p{Ll}+"), ("space", GAP), ("upper", r"\p{Lu}+"), ("digit", r"\p{Nd}+"),
           ("symbol", r"[#*$%&|<>]+"), ("point", r"[.,;:!?'()\"\-]+"))
MIN_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
WINDOW = 5


class Limits:
    """Distances from which a text is rejected, and the sizes under which it is not judged."""

    def __init__(self, classes=0.30, words=0.28, least_chars=300, least_words=200):
        self.classes, self.words, self.least_chars, self.least_words = classes, words, least_chars, least_words

    def words_at(self, n):
        """Column: the word limit of a text of n words."""
        return F.lit(self.words)


class ByLength(Limits):
    """The word limit falls with the text's length, as sampling noise does: words + fall / sqrt(n).

    words, fall and least_words (from 50, 60, 75) make the fewest errors of both kinds on
    the 20,598 labelled documents of check_s; README has the figures.
    """

    def __init__(self, classes=0.30, words=0.14, fall=1.3, least_chars=300, least_words=50):
        super().__init__(classes, words, least_chars, least_words)
        self.fall = fall

    def words_at(self, n):
        return self.words + self.fall / F.sqrt(F.greatest(n, F.lit(1)))


def _repeated(hashes, ordered):
    """Words covered by windows whose hash occurs twice: windows in hash order, flagged ones back in text order."""
    twin = F.filter(ordered, lambda e, i: (F.get(ordered, i - 1)["h"] == e["h"]) | (F.get(ordered, i + 1)["h"] == e["h"]))
    return F.sort_array(F.transform(twin, lambda e: e["i"]))


def _times(words, word):
    return F.size(F.filter(words, lambda x: x == F.lit(word))).cast("long")


def measured(docs: DataFrame, text="text", lang="lang", carry=()) -> DataFrame:
    """Base measures and histogram counts, one row per input row, beside the columns named in carry."""
    frame = docs.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("_text"),
                        F.when(F.col(lang).isin(list(COMMON)), F.col(lang)).otherwise(OTHER).alias("_lang"))
    frame = frame.withColumns({"_words": words_of(F.col("_text")),
                               "_lines": F.filter(F.split("_text", "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))})
    # classes are taken out one after the other, the largest first: later patterns meet short strings
    rest, counts = "_text", {}
    for k, (name, pattern) in enumerate(CLASSES):
        frame = frame.withColumn(f"_rest{k}", F.regexp_replace(rest, pattern, ""))
        counts[name] = F.length(rest) - F.length(f"_rest{k}")
        rest = f"_rest{k}"
    counts["rest"] = F.length(rest)
    n = F.size("_words")
    frame = frame.withColumns({
        "_classes": F.array(*[c.cast("long") for c in counts.values()]),
        "n_words": n.cast("long"),
        "_hashes": F.when(n > WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
            *[F.get("_words", i + k) for k in range(WINDOW)]))),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # found in any of three spellings first, lower-cased after: few words are left by then
        "_common": F.transform(F.filter("_words", lambda w: w.isin(SPELLINGS)), lambda w: F.lower(w)),
    })
    frame = frame.withColumn("_ordered", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array(
        F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    frame = frame.withColumn("_at", _repeated(F.col("_hashes"), F.col("_ordered")))
    per_word = None
    for name, listed in COMMON.items():
        found = F.array(*[_times("_common", w) for w in listed])
        per_word = F.when(F.col("_lang") == name, found) if per_word is None else per_word.when(F.col("_lang") == name, found)
    covered = F.aggregate(F.transform("_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", i + 1) - p, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    return frame.select(
        *carry, "_lang", "n_words", (F.length("_text") - F.get("_classes", 1)).cast("long").alias("word_chars"),
        F.get("_classes", 4).alias("n_symbols"), "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "_classes", F.coalesce(per_word, F.array().cast("array<bigint>")).alias("_per_word"))


def references(features: DataFrame) -> DataFrame:
    """(_lang, ref_classes, ref_words): counts summed over all documents of a language; five rows at most."""
    most = max(map(len, COMMON.values()))
    sums = [F.sum(F.get("_classes", k)).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    sums += [F.sum(F.get("_per_word", k)).alias(f"w{k}") for k in range(most)]
    return features.groupBy("_lang").agg(*sums, F.sum("n_words").alias("all")).select(
        "_lang", F.array(*[F.col(f"c{k}") for k in range(len(CLASSES) + 1)]).alias("ref_classes"),
        F.array(*[F.coalesce(f"w{k}", F.lit(0)) for k in range(most)]).alias("ref_words"), F.col("all").alias("ref_all"))


def distance(p, q):
    """Column: Jensen-Shannon distance of two arrays of counts of one length; 0 if either is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    shares = F.zip_with(p, q, lambda x, y: F.struct((x / F.nullif(total(p), F.lit(0.0))).alias("x"), (y / F.nullif(total(q), F.lit(0.0))).alias("y")))
    terms = F.transform(shares, lambda s: 0.5 * part(s["x"], (s["x"] + s["y"]) / 2) + 0.5 * part(s["y"], (s["x"] + s["y"]) / 2))
    return F.coalesce(F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))), F.lit(0.0))


def judged(features: DataFrame, refs: DataFrame, limits: Limits = None) -> DataFrame:
    """features with class_distance, word_distance, base_failed and kept; refs has a row per language and may be broadcast."""
    limits = limits or ByLength()
    rest = lambda counts, total: F.concat(counts, F.array(total - F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)))
    both = features.join(F.broadcast(refs), "_lang")
    known = F.size("_per_word") > 0
    both = both.withColumns({
        "class_distance": distance(F.col("_classes"), F.col("ref_classes")),
        "word_distance": F.when(known, distance(rest(F.col("_per_word"), F.col("n_words")), rest(F.col("ref_words"), F.col("ref_all")))).otherwise(0.0),
    })
    chars = F.aggregate("_classes", F.lit(0).cast("long"), lambda s, x: s + x)
    far = ((chars >= limits.least_chars) & (F.col("class_distance") > limits.classes)) | (
        (F.col("n_words") >= limits.least_words) & (F.col("word_distance") > limits.words_at(F.col("n_words"))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return both.withColumns({"base_failed": failed, "kept": ~failed & ~far})


def verdicts(spark: SparkSession, docs: DataFrame, limits: Limits = None, carry=("doc_id",), text="text", lang="lang") -> DataFrame:
    """Measures are written once to the shared folder; references and verdicts come from them."""
    features = materialised(spark, measured(docs, text, lang, carry), "quality")
    return judged(features, references(features), limits)


def accepted(spark: SparkSession, docs: DataFrame, limits: Limits = None) -> DataFrame:
    """The rows of docs that pass, with their columns.

    Texts are measured twice, for the references and for the verdict, rather than
    written once more.
    """
    refs = materialised(spark, references(measured(docs)), "quality-references")
    packed = docs.select(packed_row(docs).alias("_row"), F.col("text"), F.col("lang"))
    # a row number keeps the filter above the verdicts: pushed down, it would repeat every expression below it
    rows = judged(measured(packed, carry=("_row",)), refs, limits).withColumn("_at", F.monotonically_increasing_id())
    return unpacked(rows.where(F.col("kept") & (F.col("_at") >= 0)), "_row", docs.columns)


def _answer(spark, sf_dir, limits):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return verdicts(spark, docs, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def query(spark, sf_dir):
    """The word limit follows the text's length."""
    return _answer(spark, sf_dir, ByLength())


def flat_limits(spark, sf_dir):
    return _answer(spark, sf_dir, Limits())


def _flat_oracle():
    """The verdicts by flat limits as one statement of another engine, lists in place of arrays."""
    common = {lang: "[" + ", ".join(f"'{w}'" for w in v) + "]" for lang, v in COMMON.items()}
    pick = "CASE l " + " ".join(f"WHEN '{lang}' THEN {v}" for lang, v in common.items()) + " ELSE []::VARCHAR[] END"
    rest, steps, names = "t", [], []
    for k, (name, pattern) in enumerate(CLASSES):
        steps.append("regexp_replace({}, '{}', '', 'g')".format(rest, pattern.replace("'", "''")))
        names.append(f"r{k}")
        rest = f"r{k}"
    chain = "\n".join(f", s{k} AS (SELECT *, {step} AS r{k} FROM {'w' if k == 0 else f's{k - 1}'})" for k, step in enumerate(steps))
    lens = ["length(t)", *[f"length({n})" for n in names]]
    classes = "[" + ", ".join(f"{a} - {b}" for a, b in zip(lens, lens[1:])) + f", {lens[-1]}]"
    limits = Limits()
    jsd = ("sqrt(greatest(0, list_sum([0.0] || list_transform(range(1, len({p}) + 1), lambda k: CASE WHEN list_sum({p}) = 0 OR list_sum({q}) = 0 THEN 0.0 ELSE "
           "(CASE WHEN {p}[k] > 0 THEN 0.5 * ({p}[k] / list_sum({p})) * log2(2 * ({p}[k] / list_sum({p})) / ({p}[k] / list_sum({p}) + {q}[k] / list_sum({q}))) ELSE 0.0 END"
           " + CASE WHEN {q}[k] > 0 THEN 0.5 * ({q}[k] / list_sum({q})) * log2(2 * ({q}[k] / list_sum({q})) / ({p}[k] / list_sum({p}) + {q}[k] / list_sum({q}))) ELSE 0.0 END) END))))")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ('en', 'de', 'fr', 'es') THEN lang ELSE 'other' END AS l FROM documents)
, w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d)
{chain}
, f AS (SELECT doc_id, l, len(ws) AS n_words, length(t) - (length(r0) - length(r1)) AS word_chars, length(r3) - length(r4) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, {classes} AS cs,
    list_transform({pick}, lambda c: len(list_filter(ws, lambda x: lower(x) = c))) AS ps,
    list_transform(range(1, len(ws) - {WINDOW} + 2), lambda i: array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS gs FROM s{len(CLASSES) - 1})
, g AS (SELECT doc_id, g, i FROM (SELECT doc_id, unnest(gs) AS g, generate_subscripts(gs, 1) AS i FROM f))
, p AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1)
, c AS (SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words
    FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM p) GROUP BY doc_id)
, rw AS (SELECT l, list(s ORDER BY k) AS rp FROM (SELECT l, k, sum(x) AS s FROM (SELECT l, unnest(ps) AS x, generate_subscripts(ps, 1) AS k FROM f) GROUP BY l, k) GROUP BY l)
, rc AS (SELECT l, list(s ORDER BY k) AS rcs FROM (SELECT l, k, sum(x) AS s FROM (SELECT l, unnest(cs) AS x, generate_subscripts(cs, 1) AS k FROM f) GROUP BY l, k) GROUP BY l)
, ra AS (SELECT l, sum(n_words) AS ra FROM f GROUP BY l)
, v AS (SELECT f.*, coalesce(c.n_repeat_words, 0) AS n_repeat_words, rcs, ps || [n_words - coalesce(list_sum(ps), 0)] AS pw, rp || [ra - list_sum(rp)] AS rw
    FROM f LEFT JOIN c USING (doc_id) JOIN rc USING (l) JOIN ra USING (l) LEFT JOIN rw USING (l))
, j AS (SELECT *, {jsd.format(p="cs", q="rcs")} AS cd, CASE WHEN len(ps) > 0 THEN {jsd.format(p="pw", q="rw")} ELSE 0.0 END AS wd,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM v)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT ((list_sum(cs) >= {limits.least_chars} AND cd > {limits.classes}) OR (n_words >= {limits.least_words} AND wd > {limits.words})) AS kept FROM j
"""


def _oracle():
    flat, falling = Limits(), ByLength()
    rule = f"n_words >= {flat.least_words} AND wd > {flat.words}"
    assert FLAT_ORACLE.count(rule) == 1
    return FLAT_ORACLE.replace(rule, f"n_words >= {falling.least_words} AND wd > {falling.words}::DOUBLE + {falling.fall}::DOUBLE / sqrt(greatest(n_words, 1))")


FLAT_ORACLE = _flat_oracle()
ORACLE = _oracle()
