"""Secrets in texts: fixed rules, and sliding-window entropy of candidate strings.

Candidates are runs of key-like characters.  Allowed parts of a run (words,
placeholders, UUIDs, checksums and the like) cut it into stretches, each scored on
its own: the pieces between separators, and a longer stretch as it stands in the
text with its separators (base64 holds some).  A window slides over a stretch one
character at a time; its character counts, and the sum of c*log2(c) over them, are
updated for the character that enters and the one that leaves, which gives the
Shannon entropy of each window.  A run is reported when the highest window entropy
of a stretch reaches the threshold of its character class (what nearly all
random strings of the class and length reach).

All of it is built-in column functions; only texts with a candidate pay for the
windows.

Definitions for odd input: a NULL text is empty and has no spans; repeated rows
are scanned each on its own; an empty table gives no rows; extra columns stay
out of the result of the query and untouched in ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import free_name
from llm.spans import apart_from, as_text, count_of, matches, ordered, redacted

KINDS = ["assign", "access", "hex", "entropy"]

# --- fixed values: the base rules ------------------------------------------
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]++"
ACCESS_LEAST = 20
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
# --- end of fixed values ----------------------------------------------------

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
SEPARATORS = r"[+/_=-]+"
WINDOW = 20
SHORTEST = 12
SHORTEST_JOINED = 18        # of a stretch that holds separators
# class, pattern of the run without separators (the first that fits), and the least entropy in bits of its best
# window, for windows of SHORTEST .. WINDOW characters: what 99 of 100 uniformly random strings of the class reach
CLASSES = [
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", [2.35, 2.44, 2.52, 2.60, 2.65, 2.74, 2.79, 2.83, 2.90]),
    ("letters", r"^(?:[a-z]+|[A-Z]+)$", [2.62, 2.71, 2.83, 2.92, 2.97, 3.05, 3.12, 3.15, 3.20]),
    ("alnum", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", [2.79, 2.87, 2.98, 3.05, 3.14, 3.21, 3.28, 3.32, 3.40]),
    ("mixed letters", r"^[A-Za-z]+$", [2.91, 3.02, 3.12, 3.18, 3.28, 3.38, 3.46, 3.51, 3.58]),
    ("mixed", r"^[A-Za-z0-9]+$", [3.02, 3.08, 3.18, 3.27, 3.32, 3.45, 3.50, 3.57, 3.64]),
]
# Known harmless parts: they cut a run, and each stretch that is left is scored.
PLACEHOLDERS = r"(?i)example|sample|dummy|placeholder|changeme|your|x{4,}+|test|lorem"
ALLOWED = [
    r"(?i)(?<![0-9a-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-z])",        # UUID
    r"(?i)(?<![0-9a-z])(?:sha(?:1|256|384|512)|md5)[-_=][0-9a-f]++(?![0-9a-z])",                         # named checksums
    r"(?<![0-9A-Za-z])(?i:md5[-_=](?-i:[0-9A-Za-z+/]{22}={2})|sha1[-_=](?-i:[0-9A-Za-z+/]{27}=)"
    r"|sha256[-_=](?-i:[0-9A-Za-z+/_-]{43}=?+)|sha384[-_=](?-i:[0-9A-Za-z+/_-]{64})"
    r"|sha512[-_=](?-i:[0-9A-Za-z+/_-]{86}(?:==)?+))(?![0-9A-Za-z])",
    PLACEHOLDERS,
    r"(?i)0?123456789|abcdefghij",                                                                       # counting
    r"(.)\1{5,}+",                                                                                       # one character repeated
]
# whole tokens of a run: words in one case, capitalised or joined by capitals, short numbers, words with a number
WORD = (r"(?<![0-9A-Za-z])(?:[a-z]{1,19}+|[A-Z]{1,19}+|[A-Z]?[a-z]*+(?:[A-Z][a-z]{2,}+)++|[A-Z][a-z]++"
        r"|[0-9]{1,8}+|(?:[a-z]{1,12}+|[A-Z][a-z]{0,11}+|[A-Z]{1,12}+)[0-9]{1,4}+)(?![0-9A-Za-z])")
# names and paths hold no plus: in a run with one, only longer words cut the stretch that is read with its separators
LONG_WORD = WORD.replace("(?<![0-9A-Za-z])", "(?<![0-9A-Za-z])(?=[0-9A-Za-z]{5})", 1)
NUMBER = r"^[0-9]+$"


def window_entropy(value: Column, width: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of any ``width`` consecutive
    characters (of the whole string when it is shorter)."""

    def part(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(F.greatest(count, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))

    def slide(chars: Column) -> Column:
        return F.transform(F.array(F.array_distinct(chars)), lambda signs: counted(
            F.transform(chars, lambda c: F.array_position(signs, c).cast("int") - 1), F.size(signs)))[0]

    def counted(places: Column, n_signs: Column) -> Column:
        n = F.least(F.lit(width), F.size(places))

        def walk(acc: Column, i: Column) -> Column:
            coming, going = F.get(places, i - 1), F.get(places, i - width - 1)
            full = i > width
            leaving, present = F.get(acc["counts"], going), F.get(acc["counts"], coming)
            out = F.when(full, part(leaving - 1) - part(leaving)).otherwise(F.lit(0.0))
            present = F.when(full & (coming == going), present - 1).otherwise(present)
            total = acc["total"] + out + part(present + 1) - part(present)
            counts = F.transform(acc["counts"], lambda c, k: c + (k == coming).cast("int")
                                 - F.coalesce((k == going) & full, F.lit(False)).cast("int"))
            return F.struct(total.alias("total"),
                            F.when(i >= n, F.least(acc["lowest"], total)).otherwise(acc["lowest"]).alias("lowest"),
                            counts.alias("counts"))

        return F.aggregate(
            F.sequence(F.lit(1), F.size(places)),
            F.struct(F.lit(0.0).alias("total"), F.lit(float("inf")).alias("lowest"),
                     F.array_repeat(F.lit(0), n_signs).alias("counts")), walk,
            lambda acc: F.log2(n.cast("double")) - acc["lowest"] / n)

    # through a one-element array, so that the string is taken apart once
    return F.transform(F.array(F.split(value, "")), slide)[0]


def stretches(value: Column) -> Column:
    """What allowed parts leave of a run, as an array: the pieces between
    separators, and longer stretches with the separators they hold."""
    left = value
    for part in ALLOWED:
        left = F.regexp_replace(left, part, " ")

    def both(text: Column) -> Column:
        cut = F.regexp_replace(text, WORD, " ")
        pieces = F.filter(F.split(cut, r"[ +/_=-]+"), lambda t: F.length(t) >= SHORTEST)
        standing = F.when(text.contains("+"), F.regexp_replace(text, LONG_WORD, " ")).otherwise(cut)
        whole = F.transform(F.split(standing, " +"), lambda t: F.regexp_replace(t, r"^[+/_=-]+|[+/_=-]+$", ""))
        return F.concat(pieces, F.filter(whole, lambda t: (F.length(t) >= SHORTEST_JOINED) & t.rlike(SEPARATORS)))

    return F.transform(F.array(left), both)[0]


def looks_secret(value: Column) -> Column:
    """A stretch of a run reaches its class's threshold.  Beside a placeholder
    a whole window must be left."""
    needed = F.when(value.rlike(PLACEHOLDERS), WINDOW).otherwise(SHORTEST)

    def judged(rest: Column) -> Column:
        letters = F.regexp_replace(rest, SEPARATORS, "")
        least = F.lit(None).cast("double")
        for _, pattern, bits in reversed(CLASSES):
            by_length = F.get(F.array(*[F.lit(x) for x in bits]), F.least(F.length(rest), F.lit(WINDOW)) - SHORTEST)
            least = F.when(letters.rlike(pattern), by_length).otherwise(least)
        return F.when((F.length(rest) >= needed) & ~letters.rlike(NUMBER) & least.isNotNull(),
                      window_entropy(rest) >= least).otherwise(F.lit(False))

    return F.exists(stretches(value), judged)


def with_spans(docs: DataFrame, text: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """Adds ``base`` (spans of the fixed rules) and ``spans`` (those and the
    entropy spans that touch none of them), each ordered."""
    whole = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(matches(whole, ASSIGN, 0), lambda s: F.length(
        F.regexp_extract(s["value"], ASSIGN, 1)) >= ASSIGN_LEAST)
    access = F.filter(matches(whole, ACCESS, 1), lambda s: F.length(s["value"]) >= ACCESS_LEAST)
    found = docs.withColumn(base, ordered(F.concat(assign, access, matches(whole, HEX, 2))))
    candidates = F.filter(matches(whole, CANDIDATE, 3), lambda s: looks_secret(s["value"]))
    return found.withColumn(spans, ordered(F.concat(F.col(base), apart_from(candidates, F.col(base)))))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every secret replaced by its kind in brackets."""
    base, spans = free_name(docs, "_base"), free_name(docs, "_spans")
    return (with_spans(docs, text, base, spans)
            .withColumn(text, redacted(F.col(text), F.col(spans), KINDS)).select(*docs.columns))


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    from llm.common import load

    found = with_spans(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[count_of(F.col("base"), n).alias(f"n_{KINDS[n]}") for n in range(3)],
        F.sha2(as_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        as_text(F.col("spans"), KINDS).alias("spans"))
