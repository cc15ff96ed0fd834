"""Mixing sources to target weights, in blocks of words.

The documents of a source form one stream of words, cut into blocks of a fixed
length. Every output shard draws how many of its slots each source fills:
the whole part of the source's share for certain, and the slots that remain by
a multinomial draw over the fractions left, so that shares are met on average
and nearly so in every shard. The slots of a source are numbered through all
shards and mapped through pseudorandom permutations of its block indexes, one
for each time the source is gone through; blocks join slots by index.

Every step is a DataFrame operation. Words are counted in one scan; after it,
rows hold numbers only. Streams and permutations come from range-partitioned
sorts with offsets, so a source that holds a third of all rows is spread over
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, global_index, running_total, stored, with_row

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2
BLOCK_WORDS = 128
SHARD_BLOCKS = 65_536
SEED = 7
_ONE = 1 << 40  # fractions of a slot as whole numbers, so that sums are exact


def _key(source: Column) -> Column:
    """A text that is never null and differs for every source, null included."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
) -> DataFrame:
    """Target of every source, from rows of (source, source_size).

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all sizes. A target stops at ``limit`` times the source's size;
    what is over goes to the others by weight, until none is above. Adds place
    (the source's number) and target. Each round of sharing is one aggregate
    over the sources, and caps one more source at least.
    """
    named = sizes.withColumn("no_source", F.col("source").isNull())
    placed = global_index(named, ["no_source", "source"], "place", "sources").drop("no_source")
    turn = F.array(*(F.lit(w) for w in weights))
    placed = placed.withColumn(
        "weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int"))
    )
    most = F.col("source_size") * limit
    total, weight = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    goal, level, capped = share * (total or 0), 0.0, -1
    level = goal / weight if weight else 0.0
    while True:
        above = F.col("weight") * F.lit(level) >= most
        now, held, free = placed.agg(
            F.count_if(above), F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if now == capped or not free:
            break
        capped, level = now, (goal - (held or 0)) / free
    target = F.least(F.col("weight") * F.lit(level), most.cast("double"))
    return placed.select("source", "source_size", "place", target.alias("target"))


def _uniform(below: Column | int, *parts) -> Column:
    """A pseudorandom whole number from 0 to below - 1."""
    return F.pmod(F.xxhash64(*parts), F.lit(below) if isinstance(below, int) else below)


def shard_counts(sources: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """Blocks each shard takes of each source: place, shard, count.

    ``sources`` has place, blocks (how many the source has) and wanted (how
    many the mix takes of it).
    """
    wanted = sources.agg(F.sum("wanted")).first()[0] or 0.0
    slots = round(wanted)
    if not slots:
        return sources.select("place", *(F.lit(0).cast("long").alias(c) for c in ("shard", "count")))
    shards = -(-slots // shard_blocks)
    room = -(-slots // shards)
    exact = F.col("wanted") * F.lit(room / wanted)
    parts = sources.select(
        "place",
        F.floor(exact).cast("long").alias("whole"),
        F.floor((exact - F.floor(exact)) * _ONE).cast("long").alias("part"),
    )
    parts = stored(running_total(parts, ["place"], "part", "low", "parts"), "shares")
    sure, fractions = parts.agg(F.sum("whole"), F.sum("part")).first()
    left = room - sure

    # Every row of ``sure`` stands for a slot at least: no more rows than slots.
    shard = F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard")
    sure = parts.filter("whole > 0").select("place", shard, F.col("whole").alias("count"))
    if left <= 0 or not fractions:
        return sure
    numbers = sources.sparkSession.range(shards).withColumnRenamed("id", "shard")
    draws = numbers.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(left - 1))).alias("draw")
    ).select("shard", _uniform(fractions, F.lit(seed), "shard", "draw").alias("at"))
    # A source's fraction is below one, so it lies in two whole cells at most.
    cell = F.sequence(F.expr(f"low div {_ONE}"), F.expr(f"(low + part - 1) div {_ONE}"))
    cells = parts.filter("part > 0").select("place", "low", "part", F.explode(cell).alias("cell"))
    hits = draws.withColumn("cell", F.expr(f"at div {_ONE}")).join(cells, "cell")
    hits = hits.filter("at >= low AND at < low + part")
    drawn = hits.select("place", "shard", F.lit(1).cast("long").alias("count"))
    return sure.union(drawn).groupBy("place", "shard").agg(F.sum("count").alias("count"))


class Mix:
    """A mix of documents; every table is stored or follows from stored ones.

    sources: source, source_size, place, target, blocks
    rows: row, doc_id, place, size, start (words of its source before it)
    parts: row, place, block, words (of the block that are in the row)
    slots: shard, order (of slots in a shard), place, turn, block
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[int, ...] = WEIGHTS,
        share: float = SHARE,
        limit: int = LIMIT,
        block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS,
        seed: int = SEED,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
    ):
        self.docs, self.text_col, self.block_words = docs, text_col, block_words
        size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD))
        counted = with_row(
            docs.select(
                F.col(id_col).alias("doc_id"),
                F.col(source_col).alias("source"),
                size.cast("long").alias("size"),
            )
        )
        counted = stored(counted, "mix-sizes")
        sizes = counted.groupBy("source").agg(F.sum("size").alias("source_size"))
        targets = source_targets(sizes, weights, share, limit)
        blocks = F.expr(f"(source_size + {block_words - 1}) div {block_words}")
        targets = targets.withColumn("blocks", blocks)
        before = running_total(targets, ["place"], "source_size", "words_before", "mix-sources")
        self.sources = stored(before, "mix-targets")

        places = self.sources.select(_key(F.col("source")).alias("key"), "place", "words_before")
        placed = counted.withColumn("key", _key(F.col("source"))).join(places, "key")
        placed = placed.select("row", "doc_id", "place", "size", "words_before")
        ordered = running_total(placed, ["place", "doc_id", "row"], "size", "before", "mix-rows")
        self.rows = ordered.select(
            "row", "doc_id", "place", "size", (F.col("before") - F.col("words_before")).alias("start")
        )
        self.parts = stored(self._parts(), "mix-parts")
        self.slots = stored(self._slots(limit, shard_blocks, seed), "mix-slots")

    def _parts(self) -> DataFrame:
        b = self.block_words
        spans = F.expr(
            f"CASE WHEN size > 0 THEN sequence(start div {b}, (start + size - 1) div {b}) END"
        )
        cut = self.rows.withColumn("block", F.explode_outer(spans))
        first = F.greatest(F.col("block") * b, "start")
        last = F.least((F.col("block") + 1) * b, F.col("start") + F.col("size"))
        return cut.select(
            "row", "doc_id", "place", "size", "block",
            (first - F.col("start")).alias("at"),
            F.coalesce(last - first, F.lit(0)).alias("words"),
            (F.col("block") * b >= F.col("start")).alias("begins"),
        )

    def _slots(self, limit: int, shard_blocks: int, seed: int) -> DataFrame:
        has = F.col("source_size") > 0
        wanted = F.when(has, F.col("target") * F.col("blocks") / F.col("source_size"))
        sources = self.sources.select("place", "blocks", F.coalesce(wanted, F.lit(0.0)).alias("wanted"))
        counts = shard_counts(sources, shard_blocks, seed)
        before = W.partitionBy("place").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
        counts = counts.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0)))
        # The window leaves a source in one task: its slots are made by shard, in many.
        counts = stored(counts.filter("count > 0"), "mix-counts").repartition("place", "shard")
        numbered = counts.select(
            "place", "shard", F.explode(F.expr("sequence(first, first + count - 1)")).alias("number")
        )
        by_place = self.sources.select("place", "blocks", "words_before")
        # A slot past ``limit`` turns of its source stays empty: no block is taken more often.
        numbered = numbered.join(by_place.drop("words_before"), "place").filter(
            F.col("number") < F.col("blocks") * limit
        )
        numbered = numbered.select(
            "place", "shard",
            F.expr("cast(number div blocks as int)").alias("turn"),
            (F.col("number") % F.col("blocks")).alias("index"),
        )

        # One permutation of a source's blocks for each turn: their order by a keyed hash.
        turns = self.parts.filter("begins").select(
            "place", "block", F.explode(F.sequence(F.lit(0), F.lit(limit - 1))).alias("turn")
        )
        keyed = turns.withColumn("key", F.xxhash64(F.lit(seed), "place", "turn", "block"))
        order = global_index(keyed, ["place", "turn", "key", "block"], "position", "mix-order")
        starts = running_total(
            self.sources.select("place", (F.col("blocks") * limit).alias("both"), "blocks"),
            ["place"], "both", "offset", "mix-starts",
        ).select("place", (F.col("offset")).alias("offset"), F.col("blocks").alias("per_turn"))
        indexed = order.join(starts, "place").select(
            "place", "turn", "block",
            (F.col("position") - F.col("offset") - F.col("turn") * F.col("per_turn")).alias("index"),
        )
        return numbered.join(indexed, ["place", "turn", "index"]).select(
            "shard", F.xxhash64(F.lit(seed), "place", "turn", "block").alias("order"),
            "place", "turn", "block",
        )

    def _taken_parts(self) -> DataFrame:
        """Parts with how often their block is taken."""
        times = self.slots.groupBy("place", "block").agg(F.count(F.lit(1)).alias("times"))
        return self.parts.join(times, ["place", "block"], "left").withColumn(
            "times", F.coalesce("times", F.lit(0))
        )

    def taken(self) -> DataFrame:
        """Words the mix takes of each row: row, doc_id, size, source_size, target, taken."""
        sums = (
            self._taken_parts()
            .groupBy("row", "doc_id", "place", "size")
            .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        )
        names = self.sources.select("place", "source_size", "target")
        return sums.join(names, "place").select(
            "row", "doc_id", "size", "source_size", "target", "taken"
        )

    def texts(self) -> DataFrame:
        """The documents as mixed, in their own columns: one row for each time a row is taken.

        A row of which every word is taken keeps its text; otherwise its text is
        the words of the blocks taken, with single spaces. Rows of which
        nothing is taken go, rows without words too. Only the text column changes.
        """
        row = "_row" + "_" * max((len(c) for c in self.docs.columns), default=0)
        copies = (
            self._taken_parts()
            .filter("times > 0")
            .withColumn("copy", F.explode(F.expr("sequence(1L, times)")))
            .groupBy("row", "copy", "size")
            .agg(
                F.sum("words").alias("held"),
                F.array_sort(F.collect_list(F.struct("at", "words"))).alias("ranges"),
            )
        )
        whole = F.col("held") == F.col("size")
        plan = copies.select(
            F.struct(
                F.col("row").alias("row"), F.when(~whole, F.col("ranges")).alias("ranges")
            ).alias(row)
        )
        joined = with_row(self.docs, f"{row}id").join(plan, F.col(f"{row}id") == F.col(f"{row}.row"))
        cut = F.col(f"{row}.ranges")
        # Exploded from an array of one, so that a text is split once and not for each range.
        split = F.regexp_extract_all(F.col(self.text_col), F.lit(WORD), F.lit(0))
        split = F.array(F.when(cut.isNotNull(), split))
        joined = joined.withColumn(f"{row}words", F.explode(split))
        words = F.col(f"{row}words")
        kept = F.array_join(
            F.flatten(
                F.transform(
                    cut,
                    lambda r: F.slice(words, (r["at"] + 1).cast("int"), r["words"].cast("int")),
                )
            ),
            " ",
        )
        text = F.when(cut.isNull(), F.col(self.text_col)).otherwise(kept)
        return joined.select(
            *(text.alias(c) if c == self.text_col else F.col(c) for c in self.docs.columns)
        )


def mix(docs: DataFrame, **options) -> DataFrame:
    """Words taken of every document; see ``Mix`` for options and other outputs.

    A null text has no words. Rows with a null source form a source of their
    own. A document's blocks are taken ``limit`` times at most, so ``taken``
    never exceeds that many times its size. ``docs`` must read a stored table;
    an empty one gives an empty result.
    """
    return Mix(docs, **options).taken()
