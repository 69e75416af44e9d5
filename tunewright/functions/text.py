"""Text and rounding expressions.  All JVM-side."""

from pyspark.sql import functions as F

# Unicode white space as one class (Java and RE2 both accept it).
BLANK = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


BLANK_CHARS = "".join(chr(x) for x in (
    *range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
    0x2028, 0x2029, 0x202f, 0x205f, 0x3000))
# a run of ASCII blanks other than one plain space
UNTIDY = r"[\x09-\x0d\x1c-\x1f][\s\x1c-\x1f]*| [\s\x1c-\x1f]+"


def strip(c):
    return F.btrim(c, F.lit(BLANK_CHARS))


def normalize(c):
    """Lower case, trimmed, runs of blanks collapsed; NULL becomes ''.

    Only texts beyond ASCII can hold the rare blanks; the replacement touches
    just the runs that are not a single space already.
    """
    low = F.lower(F.coalesce(c, F.lit("")))
    plain = F.when(F.octet_length(low) != F.length(low),
                   F.translate(low, BLANK_CHARS, " " * len(BLANK_CHARS))).otherwise(low)
    return F.trim(F.regexp_replace(plain, UNTIDY, " "))


def words(c):
    """Distinct words of normalised text."""
    return F.array_remove(F.array_distinct(F.split(c, " ")), "")


def shared(text, word_set):
    """Share of a set of distinct words that occurs in normalised text."""
    return F.size(F.array_intersect(F.split(text, " "), word_set)) / F.size(word_set)


def fingerprint(c):
    """Statement template: quoted strings and digit runs become '?'."""
    no_strings = F.regexp_replace(c, "'[^']*'", "?")
    return F.regexp_replace(no_strings, "[0-9]+", "?")


def count_hits(text, phrases):
    """How many phrases of an array column occur in the text."""
    return F.size(F.filter(phrases, lambda p: F.contains(text, p)))


def texts(values):
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def round4(c):
    """Half-up rounding to 4 digits that is free of binary noise, for scores and shares: below 10^8."""
    return F.round(c.cast("decimal(18,10)"), 4)


def amount4(c):
    """round4 for amounts of any size that a sum may reach."""
    return F.round(c.cast("decimal(38,10)"), 4)


def clamp(c, low="0.001", high="0.999"):
    """Scores are kept strictly between 0 and 1, rounded to 4 digits."""
    dec = "decimal(18,4)"
    return F.greatest(F.lit(low).cast(dec), F.least(F.lit(high).cast(dec), c.cast(dec)))


def dbl(c, name):
    return c.cast("double").alias(name)
