"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is dealt by a hash into blocks of about ``block_words`` words, and
its blocks are put in a random but repeatable order.  A source's target words
make a whole number of passes over all its blocks, then a prefix of the order,
then part of one more block (whole documents, cut so that the words come as
near as the block allows).  The blocks to draw are exact quotas per source.

The output is a number of shards.  A binary tree over the shards splits the
quotas: at each node the left half gets its capacity in blocks by drawing
without replacement from what the node holds of every source (the multivariate
hypergeometric distribution, source by source), the right half the rest.
A shard then takes the next blocks of every source, so that draws are disjoint,
and shuffles its own rows.

Only tables with a row per source, block or shard are gathered in windows; a
document meets its block in a join with that small table.  Repeated rows are
numbered among themselves, so that each is drawn on its own; their numbers meet
the texts in one join by row, and nothing else shuffles text.  All steps are
DataFrame operations.

Definitions for odd input: a NULL text has size 0 (and is drawn like any other,
taking no words); a NULL source is a source of its own, after all others;
repeated rows are documents of their own, drawn independently; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import free_name, saved

WEIGHTS = (5.0, 2.0, 1.0)       # by place of the source, repeating
SHARE = 1.5                     # of all words, in the mix
MOST_COPIES = 2
BLOCK_WORDS = 200_000
SHARD_WORDS = 4_000_000
SEED = 7


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def _running(partition: list, order: list, value: str) -> Column:
    """Sum of ``value`` up to and with this row."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(value).over(w)


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> adds place (from 0) and target.

    A target is ``level * weight`` up to ``most`` times the source's size.  The
    level is found on the sources in order of the level that fills them: it is
    the first at which what is left, shared among the rest, fills no more."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    listed = totals.withColumn("place", place)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights))
    cap = F.col("source_size") * float(most)
    rows = listed.withColumn("_w", weight).withColumn("_cap", cap).withColumn("_full_at", F.col("_cap") / F.col("_w"))
    order = ["_full_at", "place"]
    everything = Window.partitionBy()
    rows = (rows.withColumn("_capped", _running([], order, "_cap") - F.col("_cap"))
            .withColumn("_rest", F.sum("_w").over(everything) - _running([], order, "_w") + F.col("_w"))
            .withColumn("_all", F.sum("source_size").over(everything) * share)
            .withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_rest")))
    level = F.min(F.when(F.col("_full_at") >= F.col("_level"), F.struct("_full_at", "place", "_level"))).over(everything)
    return (rows.withColumn("_at", level["_level"])
            .select("source", "source_size", "place",
                    F.when(F.col("_at").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_at") * F.col("_w")))
                    .alias("target")))


def _hypergeometric(held: Column, good: Column, room: Column, chance: Column) -> Column:
    """How many of ``good`` among ``held`` blocks come when ``room`` of them are
    drawn without replacement: the value at ``chance`` (0 to 1) of that
    distribution, counted off from its mode outwards.  The weights follow from
    each other by their ratios, so no factorial is needed; beyond twelve standard
    deviations (and 40 blocks) they are zero in double precision.  The steps
    grow with the square root of the blocks."""

    def drawn(p: Column) -> Column:
        n, k, m, mode = p["held"], p["good"], p["room"], p["mode"]
        off = n - k - m
        spread = F.sqrt(m * k / n * (1 - k / n) * (n - m) / F.greatest(n - 1, F.lit(1.0)))
        steps = F.least(F.greatest(F.least(k, m) - mode, mode - F.greatest(F.lit(0.0), -off)),
                        F.ceil(spread * 12) + 40).cast("int")
        walk = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))

        def up(weight: Column, j: Column) -> Column:
            x = mode + j        # the value reached
            return weight * (k - x + 1) * (m - x + 1) / (x * (off + x))

        def down(weight: Column, j: Column) -> Column:
            x = mode - j
            return weight * (x + 1) * (off + x + 1) / ((k - x) * (m - x))

        def add(acc: Column, j: Column) -> Column:
            over, under = up(acc["up"], j), down(acc["down"], j)
            return F.struct(over.alias("up"), under.alias("down"), (acc["t"] + over + under).alias("t"))

        def pick(acc: Column, j: Column) -> Column:
            over, under = up(acc["up"], j), down(acc["down"], j)
            got = F.when(acc["got"].isNotNull(), acc["got"]).when(acc["t"] < over, mode + j) \
                .when(acc["t"] < over + under, mode - j)
            return F.struct(over.alias("up"), under.alias("down"), (acc["t"] - over - under).alias("t"), got.alias("got"))

        one = F.lit(1.0)
        total = F.aggregate(walk, F.struct(one.alias("up"), one.alias("down"), one.alias("t")), add, lambda acc: acc["t"])

        def picked(t: Column) -> Column:
            start = F.struct(one.alias("up"), one.alias("down"), (t - 1).alias("t"), F.when(t < 1, mode).alias("got"))
            return F.aggregate(walk, start, pick, lambda acc: F.coalesce(acc["got"], mode))

        return F.transform(F.array(total * p["chance"]), picked)[0].cast("long")

    mode = F.floor((room + 1.0) * (good + 1.0) / (held + 2.0)).cast("double")
    given = F.struct(held.cast("double").alias("held"), good.cast("double").alias("good"), room.cast("double").alias("room"),
                     F.least(F.greatest(mode, (room - held + good).cast("double")), good.cast("double"), room.cast("double"))
                     .alias("mode"), chance.alias("chance"))
    return F.when((good > 0) & (room > 0), F.transform(F.array(given), drawn)[0]).otherwise(F.lit(0).cast("long"))


def _split(quotas: Column, capacity: Column, node: Column, seed: int) -> Column:
    """How many of each source's blocks go left: ``capacity`` of the node's
    blocks drawn without replacement, one source after the other."""
    held = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q["n"])

    def one_source(acc: Column, q: Column) -> Column:
        chance = F.pmod(F.xxhash64(F.lit(seed), node, q["place"]), F.lit(1 << 53)) / F.lit(float(1 << 53))
        left = _hypergeometric(acc["held"], q["n"], acc["room"], chance)
        return F.transform(F.array(left), lambda x: F.struct(
            (acc["held"] - q["n"]).alias("held"), (acc["room"] - x).alias("room"),
            F.concat(acc["out"], F.array(F.struct(q["place"].alias("place"), x.alias("n")))).alias("out")))[0]

    empty = F.array().cast("array<struct<place:int,n:bigint>>")
    return F.aggregate(quotas, F.struct(held.alias("held"), capacity.alias("room"), empty.alias("out")),
                       one_source, lambda acc: acc["out"])


def shard_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(place, n) per source -> (shard, place, n): the leaves of the splitting tree."""
    listed = quotas.select(F.struct(F.col("place").cast("int").alias("place"), F.col("n").cast("long").alias("n")).alias("q"))
    nodes = (listed.agg(F.array_sort(F.collect_list("q")).alias("quotas"))
             .select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "quotas"))
    level = 0
    while (1 << level) < shards:
        inner = F.col("hi") - F.col("lo") > 1
        mid = F.floor((F.col("lo") + F.col("hi")) / 2)
        held = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q["n"])
        capacity = F.floor(held * (mid - F.col("lo")) / (F.col("hi") - F.col("lo")))
        node = F.col("lo") * F.lit(1 << 20) + F.col("hi")
        split = (nodes.withColumn("mid", mid)
                 .withColumn("left", F.when(inner, _split(F.col("quotas"), capacity, node, seed + level))))
        rest = F.zip_with("quotas", "left", lambda q, d: F.struct(q["place"].alias("place"), (q["n"] - d["n"]).alias("n")))
        halves = F.when(inner, F.array(
            F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), F.col("left").alias("quotas")),
            F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), rest.alias("quotas")))) \
            .otherwise(F.array(F.struct("lo", "hi", "quotas")))
        nodes = split.select(F.explode(halves).alias("h")).select("h.lo", "h.hi", "h.quotas")
        level += 1
        if level % 4 == 0:      # the subtrees go on in parallel
            nodes = saved(nodes.repartition(min(1 << level, 64), "lo"), "quotas")
    return nodes.select(F.col("lo").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.place", "q.n")


class Mix:
    """The plan of a mix: what every block of every source gives to which shards."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                 weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
                 block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED):
        self.key, self.text, self.source, self.seed = key, text, source, seed
        self.row = free_name(docs, "_row")
        self.numbered = saved(docs.withColumn(self.row, F.monotonically_increasing_id()), "mixrows")
        own = saved(self._told_apart(self.numbered.select(
            F.col(source).alias("source"), size_of(F.col(text)).alias("size"), self._draw_key().alias("key"),
            F.col(self.row).alias("row"))).withColumn("h", self._draw_hash()), "sizes")
        self.repeats = saved(own.filter(F.col("copy") > 0).select("row", "copy"), "copies")
        totals = own.groupBy("source").agg(F.sum("size").alias("source_size"))
        passes = F.when(F.col("source_size") > 0, F.least(
            F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(F.lit(0)).cast("long")
        self.sources = saved(
            targets(totals, weights, share, most)
            .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
            .withColumn("passes", passes)
            .withColumn("extra", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size"))),
            "sources")
        dealt = self._with_block(own, "source")
        words = dealt.groupBy("place", "block").agg(F.sum("size").alias("words"))
        about = self.sources.select(F.col("place"), "n_blocks", "passes", "extra")
        order = [F.xxhash64(F.lit(seed), "place", "block"), "block"]
        ranked = (words.join(about, "place")
                  .withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*order)) - 1)
                  .withColumn("upto", _running(["place"], order, "words")))
        before = F.col("upto") - F.col("words")
        self.blocks = saved(ranked.withColumn("whole", F.col("upto") <= F.col("extra"))
                            .withColumn("gap", F.when((before < F.col("extra")) & (F.col("upto") > F.col("extra")),
                                                      F.col("extra") - before)), "blocks")
        cuts = self._cuts(dealt)
        units = (self.blocks.groupBy("place")
                 .agg(F.sum(F.col("passes") + (F.col("whole") | F.col("gap").isNotNull()).cast("long")).alias("n")))
        # one number about the whole mix
        words_out = self.sources.agg(F.sum("target")).first()[0] or 0.0
        self.n_shards = max(1, round(words_out / shard_words))
        self.plan = saved(self._draws(units).join(cuts, ["place", "block"], "left"), "mixplan")

    def _draw_key(self) -> Column:
        # with the source, so that equal rows of two sources are numbered apart
        return F.xxhash64(F.lit(self.seed), F.col(self.key), F.col(self.text), F.col(self.source))

    @staticmethod
    def _told_apart(rows: DataFrame) -> DataFrame:
        """Rows with ``copy``, their number (from 0) among those of their ``key``:
        counted within a partition of the written rows, from where the
        partitions before it stopped."""
        parts = rows.withColumn("part", F.shiftright("row", 33))        # as monotonically_increasing_id numbers them
        here = F.row_number().over(Window.partitionBy("key", "part").orderBy("row")) - 1
        upto = _running(["key"], ["part"], "n")
        before = (parts.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("before", upto - F.col("n")).filter(F.col("before") > 0).select("key", "part", "before"))
        return (parts.withColumn("here", here).join(before, ["key", "part"], "left")
                .withColumn("copy", F.col("here") + F.coalesce("before", F.lit(0))).drop("part", "here", "before"))

    @staticmethod
    def _draw_hash() -> Column:
        return F.when(F.col("copy") > 0, F.xxhash64("key", "copy")).otherwise(F.col("key"))

    def _with_block(self, rows: DataFrame, source: str) -> DataFrame:
        about = self.sources.select(F.col("source").alias("_source"), "place", "n_blocks", "source_size", "target")
        return (rows.join(about, F.col(source).eqNullSafe(F.col("_source")))
                .withColumn("block", F.pmod("h", "n_blocks")).drop("_source", "n_blocks"))

    def _cuts(self, dealt: DataFrame) -> DataFrame:
        """Which documents of each source's partly drawn block belong to the draw:
        those up to a place in random order, then the smallest of the others
        while they fit (or come nearer than leaving the gap)."""
        part = (dealt.join(self.blocks.filter(F.col("gap").isNotNull()).select("place", "block", "gap"), ["place", "block"])
                .withColumn("_order", F.xxhash64(F.lit(self.seed + 1), "h"))
                .withColumn("_upto", _running(["place", "block"], ["_order"], "size")))
        fits = F.col("_upto") <= F.col("gap")
        by_block = Window.partitionBy("place", "block")
        part = (part.withColumn("_first", fits)
                .withColumn("_gap", F.col("gap") - F.coalesce(F.max(F.when(fits, F.col("_upto"))).over(by_block), F.lit(0)))
                .withColumn("_fill", _running(["place", "block", "_first"], ["size", "_order"], "size")))
        before = F.col("_fill") - F.col("size")
        taken = (F.col("_fill") <= F.col("_gap")) | (
            (before < F.col("_gap")) & (F.col("_fill") - F.col("_gap") < F.col("_gap") - before))
        return part.groupBy("place", "block").agg(
            F.max(F.when(F.col("_first"), F.col("_order"))).alias("cut"),
            F.max(F.when(~F.col("_first") & taken, F.struct("size", "_order"))).alias("fill"))

    def _draws(self, units: DataFrame) -> DataFrame:
        """(place, block, partial, shards): the shards that draw each block, by
        pass; the last draw of a partial block takes only part of it."""
        leaves = shard_quotas(units, self.n_shards, self.seed)
        upto = _running(["place"], ["shard"], "n")
        ranges = leaves.withColumn("_upto", upto).filter(F.col("n") > 0)
        each = ranges.select("place", "shard", F.explode(
            F.sequence(F.col("_upto") - F.col("n"), F.col("_upto") - 1)).alias("unit"))
        about = self.sources.select("place", "n_blocks")
        drawn = (each.join(about, "place")
                 .select("place", "shard", "unit", (F.col("unit") % F.col("n_blocks")).alias("rank")))
        shards = (drawn.join(self._ranked(), ["place", "rank"])
                  .groupBy("place", "block").agg(F.array_sort(F.collect_list(F.struct("unit", "shard"))).alias("s")))
        return (self.blocks.select("place", "block", F.col("gap").isNotNull().alias("partial"))
                .join(shards, ["place", "block"], "left")
                .select("place", "block", "partial",
                        F.coalesce(F.transform("s", lambda x: x["shard"]), F.array().cast("array<bigint>")).alias("shards")))

    def _ranked(self) -> DataFrame:
        return self.blocks.select("place", "block", "rank")

    def draws(self, docs: DataFrame) -> DataFrame:
        """Every row of ``docs``, the table of the plan, with ``_size``, ``_source_size``,
        ``_target`` and ``_shards`` (a shard for each time the mix takes it)."""
        names = {n: free_name(docs, f"_{n}") for n in ("size", "source_size", "target", "shards")}
        copies = self.repeats.select(F.col("row").alias("_of"), "copy")
        rows = (self.numbered.select(F.struct(*docs.columns).alias("row"), F.col(self.source).alias("source"),
                                     size_of(F.col(self.text)).alias("size"), self._draw_key().alias("key"),
                                     F.col(self.row).alias("_number"))
                .join(copies, F.col("_number") == F.col("_of"), "left")
                .withColumn("copy", F.coalesce("copy", F.lit(0).cast("long"))).withColumn("h", self._draw_hash()))
        met = (self._with_block(rows, "source").withColumn("_order", F.xxhash64(F.lit(self.seed + 1), "h"))
               .join(self.plan, ["place", "block"]))
        inside = F.coalesce(F.col("_order") <= F.col("cut"), F.lit(False)) | F.coalesce(
            F.struct("size", "_order") <= F.col("fill"), F.lit(False))
        shards = F.when(F.col("partial") & ~inside, F.slice("shards", 1, F.greatest(F.size("shards") - 1, F.lit(0)))) \
            .otherwise(F.col("shards"))
        return met.select("row.*", F.col("size").alias(names["size"]), F.col("source_size").alias(names["source_size"]),
                          F.col("target").alias(names["target"]), shards.alias(names["shards"]))

    def rows(self, docs: DataFrame) -> DataFrame:
        """The mix itself: every draw a row, shards in order, shuffled within."""
        shard, order = free_name(docs, "_shard"), free_name(docs, "_place")
        drawn = self.draws(docs)
        taken = drawn.select(*docs.columns, F.posexplode(drawn.columns[-1]).alias(order, shard))
        key = F.xxhash64(F.lit(self.seed + 2), shard, order, self.key, self.text)
        return (taken.repartitionByRange(self.n_shards, F.col(shard)).sortWithinPartitions(shard, key)
                .select(*docs.columns))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    from llm.common import load

    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return Mix(docs).draws(docs).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.size("_shards")).alias("taken"))
