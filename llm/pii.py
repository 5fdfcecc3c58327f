"""Personal data in texts: base rules, and gradient boosting over candidates.

Base rules give spans of four kinds.  Beside them, high-recall generators
propose overlapping candidates (spelled-out addresses, groups of digits, address
forms).  A candidate is described by its context and by its format as it is with
obfuscation undone (``[at]``, ``dot``, brackets, a leading plus), in small
integers.  A base rule that confirms a candidate makes it a positive example;
counter-evidence (a word like "order" before it, a currency after it, a failed
check) makes an unconfirmed one negative.  The other candidates are unlabelled:
they are no examples, but are scored.  The trees see neither the evidence nor
what tells confirmed forms from obfuscated ones.  The training table has one
weighted row per distinct description, so its size does not follow the corpus.
A threshold per kind is calibrated on the documents that the trees did not see:
the lowest score at which the labelled candidates above it are confirmed often
enough.  Candidates above the threshold without counter-evidence that touch no
base span are added.

All of it is DataFrame operations and the trees of Spark's own library; scores
are computed once per distinct description and joined.

Definitions for odd input: a NULL text is empty and has no spans; repeated rows
are scanned each on its own; an empty table, or one without confirmed
candidates, adds no spans; extra columns stay out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import saved
from llm.spans import apart_from, as_text, count_of, matches, none, ordered

KINDS = ["email", "ip", "card", "phone"]

# --- fixed values: the base rules ------------------------------------------
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_VALID = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[1-9])?(?:\.|$)){4}"
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)
# --- end of fixed values ----------------------------------------------------

# Candidates: (pattern, kind)
GENERATORS = [
    (r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[\[({]at[\])}]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+"
     r"(?:\x20?(?:\.|[\[({]dot[\])}]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+)++", 0),
    (r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:(?:\.|\[\.\]|\x20\.\x20)[0-9]{1,3}+){3}+(?![0-9A-Za-z])", 1),
    (r"(?<![0-9A-Za-z])[0-9](?:[\x20.-]?+[0-9]){11,18}+(?![0-9A-Za-z])", 2),
    (r"(?<![0-9A-Za-z])\+?[(]?[0-9](?:[\x20().-]{0,2}+[0-9]){6,14}+(?![0-9A-Za-z])", 3),
]
CUES = [
    r"(?i)e-?mail|contact|write|mail\b|@",
    r"(?i)\bip\b|host|server|address|ping|login from",
    r"(?i)card|visa|credit|account|payment|iban",
    r"(?i)phone|\btel|call|mobile|fax|whatsapp|dial",
]
AGAINST = r"(?i)(?:isbn|issn|doi|version|\bv|chapter|section|page|no\.|nr\.|order|invoice|[$€£#])\s*$"
CONTEXT_CHARS = 24
PRECISION = 0.97            # share of confirmed candidates that a threshold must keep
TREES, DEPTH = 10, 3
EVIDENCE = ["against", "money", "failed"]          # makes negative examples; not for the trees
LEARNT = ["kind_no", "digits", "length", "groups", "separators", "same", "cue", "line"]
FEATURES = [*LEARNT, *EVIDENCE]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(total: Column, pair: Column) -> Column:
        doubled = pair["digit"] * F.when(pair["place"] % 2 == 1, 2).otherwise(1)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    numbered = F.transform(F.split(F.reverse(digits), ""),
                           lambda d, i: F.struct(d.try_cast("int").alias("digit"), i.alias("place")))
    return F.aggregate(numbered, F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the base rules, ordered."""
    ip = F.filter(matches(text, IP, 1), lambda s: s["value"].rlike(IP_VALID))
    card = F.filter(matches(text, CARD, 2), lambda s: F.when(
        F.length(_digits(s["value"])).between(*CARD_DIGITS), luhn(_digits(s["value"]))).otherwise(F.lit(False)))
    phone = F.filter(matches(text, PHONE, 3), lambda s: F.length(_digits(s["value"])).between(*PHONE_DIGITS))
    email = F.when(text.contains("@"), matches(text, EMAIL, 0)).otherwise(none())
    return ordered(F.concat(email, ip, card, phone))


def _plain(value: Column, kind: Column) -> Column:
    """A candidate with obfuscation undone; a telephone number without its
    country code or leading zero."""
    for sign, rule in (("@", r"(?i)\x20?[\[({]at[\])}]\x20?|\x20at\x20|\x20?@\x20?"),
                       (".", r"(?i)\x20?[\[({]dot[\])}]\x20?|\x20dot\x20|\[\.\]|\x20\.\x20|\x20\.|\.\x20")):
        value = F.regexp_replace(value, rule, sign)
    national = F.regexp_replace(F.regexp_replace(value, r"[()]", ""),
                                r"^(?:(?:\+|00)(?:[0-9]{1,3}[\x20.-]++)?+)?+0?+", "")
    return F.when(kind == 3, national).otherwise(value)


def _failed(value: Column, kind: Column, digits: Column, plain: Column, cue: Column) -> Column:
    """What the kind's own check says against a candidate."""
    spelled_at_only = value.rlike(r"(?i)\x20at\x20") & ~value.rlike(r"(?i)[\[({\x20]dot[\])}\x20]")
    email = (spelled_at_only & ~cue) | ~plain.rlike(r"\.[A-Za-z]{2,24}$")
    date = r"(?<![0-9])(?:(?:19|20)[0-9]{2}[ .-](?:0?[1-9]|1[0-2])[ .-](?:0?[1-9]|[12][0-9]|3[01])" \
           r"|(?:0?[1-9]|[12][0-9]|3[01])[ .-](?:0?[1-9]|1[0-2])[ .-](?:19|20)[0-9]{2})(?![0-9])"
    bare = value.rlike(r"^[1-9][0-9]*$") & ~cue            # a number like any other
    phone = ~F.length(digits).between(*PHONE_DIGITS) | value.rlike(date) | bare
    card = F.when(F.length(digits).between(*CARD_DIGITS), ~luhn(digits)).otherwise(F.lit(True))
    return (F.when(kind == 0, email).when(kind == 1, ~plain.rlike(IP_VALID)).when(kind == 2, card).otherwise(phone))


def _described(text: Column, span: Column) -> Column:
    """A candidate's place and its format and context as small integers."""
    value, digits, plain = span["value"], _digits(span["value"]), _plain(span["value"], span["kind_no"])
    before = F.substring(text, F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0)) + 1,
                         F.least(span["start"], F.lit(CONTEXT_CHARS)))
    after = F.substring(text, span["end"] + 1, CONTEXT_CHARS)
    cue = F.lit(False)
    for n, rule in enumerate(CUES):
        cue = cue | ((span["kind_no"] == n) & before.rlike(rule))
    flag = lambda c: c.cast("int")
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), span["kind_no"].alias("kind_no"),
        F.least(F.length(_digits(plain)), F.lit(20)).alias("digits"),
        F.least(F.floor(F.length(plain) / 4).cast("int"), F.lit(10)).alias("length"),
        F.least(F.size(F.split(plain, r"[^0-9A-Za-z]+")), F.lit(8)).alias("groups"),
        F.least(F.length(F.regexp_replace(plain, r"[0-9A-Za-z]", "")), F.lit(8)).alias("separators"),
        flag(digits.rlike(r"^(.)\1+$")).alias("same"), flag(cue).alias("cue"),
        flag(before.rlike(r"(?:^|\n)\s*$")).alias("line"),
        flag(before.rlike(AGAINST)).alias("against"),
        flag(after.rlike(r"^\s*(?:%|€|\$|EUR|USD|kg|km)")).alias("money"),
        flag(_failed(value, span["kind_no"], digits, plain, cue)).alias("failed"))


def _opposed() -> Column:
    """Counter-evidence on a row with FEATURES."""
    return (F.col("against") + F.col("money") + F.col("failed")) > 0


def candidates(text: Column) -> Column:
    found = F.concat(*[matches(text, pattern, kind) for pattern, kind in GENERATORS])
    return F.transform(found, lambda s: _described(text, s))


def _confirmed(candidate: Column, base: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < candidate["end"]) & (candidate["start"] < b["end"]))


def accepted_descriptions(table: DataFrame) -> DataFrame:
    """``table``: candidates with FEATURES, ``confirmed`` and ``half`` -> the
    descriptions (FEATURES) whose score reaches their kind's threshold."""
    counted = saved(
        table.groupBy(*FEATURES, "half", "confirmed").agg(F.count(F.lit(1)).cast("double").alias("weight"))
        .withColumn("label", F.when(F.col("confirmed"), 1.0).when(_opposed(), 0.0)).repartition(4), "descriptions")
    learnt = counted.filter((F.col("half") == 0) & F.col("label").isNotNull())
    labels = {r[0] for r in learnt.select("label").distinct().collect()}
    if 1.0 not in labels:
        return counted.select(*FEATURES).limit(0)
    if 0.0 in labels:
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        together = VectorAssembler(inputCols=LEARNT, outputCol="vector")
        trees = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH,
                              seed=4, checkpointInterval=-1).fit(together.transform(learnt))
        rated = trees.transform(together.transform(counted)).withColumn(
            "score", F.round(vector_to_array("probability")[1], 6))
    else:       # nothing speaks against any candidate
        rated = counted.withColumn("score", F.lit(1.0))
    scored = saved(rated.select(*FEATURES, "half", "label", "weight", "score"), "descscores")
    by_score = scored.filter((F.col("half") == 1) & F.col("label").isNotNull()).groupBy("kind_no", "score").agg(
        F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("good"))
    down = Window.partitionBy("kind_no").orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    thresholds = (by_score.withColumn("share", F.sum("good").over(down) / F.sum("n").over(down))
                  .filter(F.col("share") >= PRECISION)
                  .groupBy("kind_no").agg(F.min("score").alias("threshold")))
    return scored.join(F.broadcast(thresholds), "kind_no").filter(F.col("score") >= F.col("threshold")) \
        .select(*FEATURES).distinct()


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans) of every row: the spans of the base rules, and all
    spans, each ordered, as ``struct<start, end, kind_no, value>`` (value NULL)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = lambda spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind_no"].alias("kind_no"),
        F.lit(None).cast("string").alias("value")))
    found = saved(
        docs.select(F.col(key), F.monotonically_increasing_id().alias("_row"),
                    F.pmod(F.xxhash64(key, F.lit(4)), F.lit(2)).cast("int").alias("_half"),
                    bare(base_spans(whole)).alias("base"), candidates(whole).alias("_candidates")), "pii")
    each = (found.filter(F.size("_candidates") > 0)
            .select("_row", "base", F.col("_half").alias("half"), F.explode("_candidates").alias("c"))
            .select("_row", "half", "c.*", _confirmed(F.col("c"), F.col("base")).alias("confirmed")))
    accepted = accepted_descriptions(each)
    added = (each.filter(~F.col("confirmed") & ~_opposed()).join(accepted, FEATURES, "left_semi")
             .groupBy("_row").agg(F.collect_set(F.struct(
                 "start", "end", "kind_no", F.lit(None).cast("string").alias("value"))).alias("_added")))
    extra = F.coalesce(F.col("_added"), none())
    return (found.join(added, "_row", "left")
            .select(key, "base", ordered(F.concat(F.col("base"), apart_from(extra, F.col("base")))).alias("spans")))


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    from llm.common import load

    found = find(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[count_of(F.col("base"), n).alias(f"n_{k}") for n, k in enumerate(KINDS)],
        F.sha2(as_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        as_text(F.col("spans"), KINDS).alias("spans"))
