"""Spans of regular expressions in whole texts, from built-in functions only.

A text is split at the matches and the matches are extracted; running sums of
the lengths give the places, in code points, end exclusive.  Patterns passed
here are written so that no text makes them slow or recursive: repetitions are
possessive, and a lookbehind lets a match begin only where its run begins.

A span is ``struct<start, end, kind_no, value>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
SPAN = "struct<start:int,end:int,kind_no:int,value:string>"


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def matches(text: Column, pattern: str, kind_no: int) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as an array of spans."""
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.filter(F.zip_with(gaps, values, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value"))),
                     lambda s: s["value"].isNotNull())

    def walk(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + F.length(s["value"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind_no).alias("kind_no"),
                        s["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def block(acc: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(acc["at"].alias("at"), none().alias("spans")), walk)
        return F.transform(F.array(inner), lambda i: F.struct(
            i["at"].alias("at"), F.concat(acc["spans"], i["spans"]).alias("spans")))[0]

    def blocks(all_steps: Column) -> Column:
        # an array grows by copying, so it is grown in blocks
        parts = F.transform(F.sequence(F.lit(0), F.floor(F.size(all_steps) / BLOCK).cast("int")),
                            lambda b: F.slice(all_steps, b * BLOCK + 1, F.lit(BLOCK)))
        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none().alias("spans")), block,
                           lambda acc: acc["spans"])

    return F.when(text.rlike(pattern), F.transform(F.array(steps), blocks)[0]).otherwise(none())


def ordered(spans: Column) -> Column:
    """By start, then kind."""
    return F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                        .when(a["kind_no"] != b["kind_no"], a["kind_no"] - b["kind_no"])
                        .otherwise(a["end"] - b["end"]))


def as_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of every span in its order, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind_no: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind_no"] == kind_no)).cast("long")


def apart_from(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others``."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def redacted(text: Column, spans: Column, kinds: list[str]) -> Column:
    """``text`` with every ordered span replaced by its kind in brackets; of
    overlapping spans, the part not yet covered."""
    names = F.array(*[F.lit(f"[{k}]") for k in kinds])

    def walk(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["end"] <= acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], before, F.get(names, s["kind_no"]))).alias("out"))

    whole = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), walk,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
