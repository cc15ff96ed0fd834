"""Line de-duplication by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity, and a line's
prefix are its rarest words: two lines whose sets reach a Jaccard similarity
of 0.8 share words of their prefixes. Lines meet on such a word if their
lengths and its places allow the overlap the threshold asks for and if their
bit sketches do. A line goes if an earlier one is similar, which the hashes of
all words confirm.

No step lists the pairs of a large group of similar lines. A semi join keeps
the words on which a line meets any other. Lines that share two such words in
a row are one family: its lines meet in blocks, and each counts its links where
it meets them. In a large family lines that differ only in words of their own
are one form and meet the others once. Only lines of different families meet as
pairs. So families may be drawn in any way; only the number of pairs depends on it.

Every step is a DataFrame operation. Any fixed order of words gives the same
result; rarity only keeps the candidates few. A word's rarity is a level on a
logarithmic scale of how often words of its hash bucket occur in the whole
corpus: a bucket is never rarer than its words, so no common word is taken for
a rare one, and the counts of 262,144 buckets are all that reaches the driver,
whatever the corpus. Lines with the same words are one class, which posts its
prefix once.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.llm.common import stored, with_row
from tripflow.llm.components import connected_components
from tripflow.session import scratch_dir

BUCKET_BITS = 18
# A key is the level of a word's bucket, then bits of the word's hash.
LEVELS, _HASH_BITS = 128, 56
_STEP = LEVELS / 64  # levels to a doubling, so that any long count has one
# Lines that are looked up again are marked in so many bits; more lines than
# that share bits, and are then shuffled without need.
_MARK_BITS = 22
# Lines of a family that meet at once, and how many blocks of them meet all
# others in one group of rows: a larger family is dealt into more groups.
BLOCK_LINES, GROUP_BLOCKS = 128, 16
# As many words make a block of fewer lines.
BLOCK_WORDS = 1 << 16
# Lines of larger families are compared by bits for their family's most frequent words.
FEW_LINES, SHARED_BITS = 32, 4


def _words(line: Column) -> Column:
    """Hashes of the distinct runs of non-blanks; all blanks are spaces by now."""
    hashes = F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def _bucket(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BUCKET_BITS).cast("int")


def _levels(hashed: DataFrame) -> Column:
    """Level of every bucket by how many lines hold its words, as one constant array of bytes."""
    buckets = hashed.select(F.explode("hashes").alias("hash")).select(_bucket(F.col("hash")).alias("bucket"))
    # All buckets fit into the compact map that Spark tries first.
    conf, size = hashed.sparkSession.conf, "spark.sql.codegen.aggregate.fastHashMap.capacityBit"
    before = conf.get(size, None)
    conf.set(size, str(BUCKET_BITS))
    try:
        counts = buckets.groupBy("bucket").count().toArrow()
    finally:
        conf.unset(size) if before is None else conf.set(size, before)
    levels = [0] * (1 << BUCKET_BITS)
    pairs = zip(counts.column("bucket").to_pylist(), counts.column("count").to_pylist(), strict=True)
    for bucket, count in pairs:
        levels[bucket] = int(_STEP * log2(count))
    return F.from_json(F.lit(str(levels).replace(" ", "")), "array<tinyint>")


def _keys(levels: Column) -> Column:
    """The hashes of a line as whole numbers above zero, the rarest word first."""
    low = F.lit((1 << _HASH_BITS) - 1)
    level = lambda h: F.shiftleft(F.get(levels, _bucket(h)).cast("long"), _HASH_BITS)
    return F.sort_array(F.transform("hashes", lambda h: level(h).bitwiseOR(h.bitwiseAND(low))))


def _sketch(words: str) -> Column:
    """64 bits, of which every word turns one."""
    return F.expr(f"aggregate({words}, 0L, (acc, k) -> acc ^ shiftleft(1L, cast(k & 63 AS int)))")


def _least_share(n: str, percent: int) -> str:
    """The overlap a set of n words needs with any that is similar."""
    return f"(({n} * {percent} + 99) div 100)"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with their ids and rows; blanks within lines become spaces."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = F.translate(text, "\t\x0b\x0c\r", " " * 4)
    text = F.when(text.rlike(r"[\x09\x0B-\x0D]"), spaced).otherwise(text)
    return with_row(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")))


def _marks(places: DataFrame) -> Column:
    """Whether (row, line_no) may be one of ``places``: a constant map of bits."""
    bit = F.pmod(F.xxhash64("row", "line_no"), F.lit(1 << _MARK_BITS))
    cells = places.select(bit.alias("bit")).selectExpr(
        "cast(bit div 64 AS int) AS cell", "shiftleft(1L, cast(bit % 64 AS int)) AS mark"
    )
    found = cells.groupBy("cell").agg(F.bit_or("mark").alias("marks")).toArrow()
    marks = [0] * (1 << (_MARK_BITS - 6))
    for cell, value in zip(*(found.column(c).to_pylist() for c in ("cell", "marks")), strict=True):
        marks[cell] = value
    table = F.from_json(F.lit(str(marks).replace(" ", "")), "array<long>")
    cell = F.get(table, F.floor(bit / 64).cast("int"))
    return F.getbit(cell, (bit % 64).cast("int")) == 1


def similar_lines(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every line with whether it goes: row, doc_id, line_no, n_words, links, removed.

    Lines are what newlines separate, numbered from 0; words are runs of
    non-blanks. A line is removed if a line before it, in the order of id, row
    and line number (null ids last), has a Jaccard similarity of at least
    ``percent`` in their sets of words. ``links`` counts the other word sets
    that are that similar. A line without words is never removed. A null text
    is one empty line. ``docs`` must read a stored table; extra columns are
    ignored; an empty table gives an empty result; texts are read as a whole,
    however long, and rows that repeat are lines of their own.

    Words of a line count as one if 64 bits of their hash agree, and two sets
    as one class or form if 128 bits of theirs do; pairs of classes are
    confirmed on the hashes of all their words.
    """
    spark = docs.sparkSession
    texts = _lines(docs, id_col, text_col)
    each = texts.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    prefix = F.expr(
        f"transform(slice(keys, 1, n - cast({_least_share('n', percent)} AS int) + 1),"
        " k -> cast(k % 2147483647 as int))"
    )
    narrow = ["row", "doc_id", "line_no", "n", "class", "class2"]
    some = F.col("n") > 0
    with scratch_dir(spark, "line-keys") as keys, scratch_dir(spark, "line-postings") as posted:
        # Texts are split once; the hashes go when the keys are made of them.
        with scratch_dir(spark, "line-hashes") as split:
            each = each.select("row", "doc_id", "line_no", _words(F.col("line")).alias("hashes"))
            each.write.option("parquet.enable.dictionary", "false").parquet(split)
            hashed = spark.read.parquet(split)
            keyed = hashed.withColumn("keys", _keys(_levels(hashed)))
            keyed.withColumn("n", F.size("keys")).select(
                "row", "doc_id", "line_no", "n",
                F.xxhash64("keys").alias("class"),
                F.xxhash64(F.lit(1), "keys").alias("class2"),
                F.when(some, _sketch("keys")).alias("bits"),
                F.when(some, prefix).alias("prefix"),
            ).write.option("parquet.enable.dictionary", "false").parquet(keys)
        wide = spark.read.parquet(keys)
        # A count alone is summed up by hash; the first lines follow for those that need them.
        wide.filter("n > 0").groupBy("class", "class2", "n", "bits", "prefix").agg(
            F.count(F.lit(1)).alias("lines")
        ).select(
            # In this order both sides of the join of postings read alike and share one shuffle.
            F.monotonically_increasing_id().alias("id"), "n", "bits", "prefix", "class", "class2", "lines",
        ).write.option("parquet.enable.dictionary", "false").parquet(posted)
        classes = spark.read.parquet(posted)
        live = F.array_sort(F.collect_list(F.struct("at", "word"))).alias("live")
        met = stored(_live(classes, percent).groupBy("id", "n", "bits").agg(live), "line-met")
        wanted = classes.join(met.select("id", F.lit(True).alias("met")), "id", "left")
        wanted = wanted.filter("lines > 1 OR met").select("id", "class", "class2")
        placed = wide.select(*narrow).join(wanted, ["class", "class2"], "left").drop("class", "class2")
        placed = stored(placed, "line-placed")

    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "line_no")
    again = placed.filter("id IS NOT NULL")
    firsts = stored(again.groupBy("id").agg(F.min(order).alias("first")), "line-firsts")
    links = stored(_links(texts, firsts, met, percent), "line-links")
    found = firsts.join(links, "id", "left").select(
        "id", F.struct("first.row", "first.line_no").alias("kept_at"), "links", "late"
    )
    here = F.struct("row", "line_no")
    late = F.coalesce("late", F.lit(False))
    counted = again.join(found, "id").select(
        "row", "doc_id", "line_no", F.col("n").alias("n_words"),
        F.coalesce("links", F.lit(0)).alias("links"), (late | (here != F.col("kept_at"))).alias("removed"),
    )
    # A line that is neither repeated nor linked.
    alone = placed.filter("id IS NULL").select(
        "row", "doc_id", "line_no", F.col("n").alias("n_words"),
        F.lit(0).cast("long").alias("links"), F.lit(False).alias("removed"),
    )
    return counted.union(alone)


def _meet(percent: int) -> Column:
    """Whether two classes may be similar that share a word of their prefixes.

    o common words of sets with m and n reach the threshold t when
    o >= t / (1 + t) * (m + n); in percent, (100 + p) * o >= p * (m + n). The
    first common word has o - 1 common words behind it in either set; places
    one further on are let through for the second.
    """
    p = percent
    long_enough = F.expr(f"100 * a.n >= {p} * b.n AND 100 * b.n >= {p} * a.n")
    near = F.expr(f"{100 + p} * (least(a.n - a.at, b.n - b.at) + 1) >= {p} * (a.n + b.n)")
    # Words that one set lacks are at least as many as bits that differ.
    sketches = F.expr(f"{100 + p} * bit_count(a.bits ^ b.bits) <= {100 - p} * (a.n + b.n)")
    return (F.col("a.word") == F.col("b.word")) & long_enough & near & sketches




def _live(classes: DataFrame, percent: int) -> DataFrame:
    """The words of prefixes on which a class meets any other: a row each, whatever meets there."""
    posted = classes.select("id", "n", "bits", F.posexplode("prefix").alias("at", "word"))
    a, b = posted.alias("a"), posted.alias("b")
    return a.join(b, _meet(percent) & (F.col("a.id") != F.col("b.id")), "left_semi")


def _families(met: DataFrame) -> DataFrame:
    """Classes connected by two live words in a row: id, family. Linear in the words."""
    two = F.expr("transform(sequence(1, size(live) - 1), i -> xxhash64(live[i - 1].word, live[i].word))")
    marks = met.filter("size(live) > 1")
    marks = stored(marks.select("id", F.explode(two).alias("mark")), "line-marks")
    least = marks.groupBy("mark").agg(F.min("id").alias("least"))
    edges = stored(marks.join(least, "mark").filter("id <> least").select("id", "least"), "line-edges")
    return connected_components(edges, "line-families").toDF("id", "family")


def _sets(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``places``, each a line, with the hashes of its words, taken from the texts again."""
    cut = texts.select("row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    cut = cut.filter(_marks(places)).join(places, ["row", "line_no"])
    return cut.withColumn("words", _words(F.col("line"))).drop("row", "line_no", "line")


def _similar(a: str, b: str, percent: int) -> str:
    common = f"size(array_intersect({a}, {b}))"
    return f"{100 + percent} * {common} >= {percent} * (size({a}) + size({b}))"


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different families that pass the count and positional filters.

    o common words of sets with m and n are needed. With q = n - o + 2 words of
    each set, or all of its prefix if that is shorter, a set has at most n - q of
    them beyond these, and the one whose q words end first in the order of words
    shares all others: two of them, but where a prefix is too short.
    """
    a, b = met.alias("a"), met.alias("b")
    apart = (F.col("a.family") != F.col("b.family")) & (F.col("a.id") < F.col("b.id"))
    counted = a.join(b, apart & _meet(percent)).groupBy(
        F.col("a.id").alias("id"), F.col("b.id").alias("other"),
        F.col("a.n").alias("m"), F.col("b.n").alias("n"),
    ).agg(F.count(F.lit(1)).alias("shared"), F.min("a.at").alias("a_at"), F.min("b.at").alias("b_at"))
    p = percent
    least = f"(({p} * (m + n) + {99 + p}) div {100 + p})"
    # Words of a set beyond its whole prefix: n - (n - least_share + 1).
    beyond = ", ".join(f"{_least_share(x, p)} - 1" for x in ("m", "n"))
    return counted.filter(
        f"shared >= least(2, {least} - greatest({beyond}))"
        f" AND least(m - a_at, n - b_at) >= {least}"
    ).select("id", "other")


def _links(texts: DataFrame, firsts: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Of every class with a similar one: how many there are, and if one comes earlier.

    Words are taken only for classes that are in a family or in a pair.
    """
    family = stored(_families(met), "line-family")
    words = met.join(family, "id", "left").withColumn("family", F.coalesce("family", "id"))
    words = stored(words.select("id", "n", "bits", "family", F.inline("live")), "line-met-words")
    pairs = stored(_pairs(words, percent), "line-pairs")
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("lines"))
    paired = pairs.select("id").union(pairs.select("other")).distinct()
    wanted = family.join(sizes, "family").join(paired.withColumn("paired", F.lit(True)), "id", "full")
    places = firsts.join(wanted, "id").withColumns(
        {"row": F.col("first.row"), "line_no": F.col("first.line_no")}
    )
    sets = stored(_sets(texts, stored(places, "line-places")), "line-sets")
    inside = _links_inside(sets.filter("family IS NOT NULL"), percent)
    sets = sets.filter("paired").select("id", "first", "words")
    other = sets.toDF("other", "other_first", "other_words")
    joined = pairs.join(sets, "id").join(other, "other").filter(_similar("words", "other_words", percent))
    earlier = F.col("first") < F.col("other_first")
    ends = F.array(
        F.struct(F.col("id").alias("id"), F.lit(1).cast("long").alias("links"), (~earlier).alias("late")),
        F.struct(F.col("other").alias("id"), F.lit(1).cast("long").alias("links"), earlier.alias("late")),
    )
    both = inside.union(joined.select(F.inline(ends)))
    return both.groupBy("id").agg(F.sum("links").alias("links"), F.bool_or("late").alias("late"))


def _forms(lines: DataFrame) -> DataFrame:
    """Lines of large families by what they share there: id, first, n, bits0 to bits3, rest, form, form2.

    A word has a bit if it is one of the 256 that most lines of its family have,
    and is left out if no other line has it; the rest are listed. Two lines
    share what their bits and their rests do. Lines with the same n, bits and
    rest are one form.
    """
    key = ["family", "word"]
    words = lines.select("id", "family", F.explode("words").alias("word"))
    often = words.groupBy(*key).agg(F.count(F.lit(1)).alias("found")).filter("found > 1")
    often = stored(often, "line-family-words")
    place = F.row_number().over(W.partitionBy("family").orderBy(F.desc("found"), "word")) - 1
    top = often.withColumn("place", place).filter(f"place < {64 * SHARED_BITS}").select(*key, "place")
    bits = [f"bits{k}" for k in range(SHARED_BITS)]
    marked = [
        F.bit_or(F.expr(f"if(place div 64 = {k}, shiftleft(1L, cast(place % 64 AS int)), 0L)")).alias(name)
        for k, name in enumerate(bits)
    ]
    rest = F.sort_array(F.collect_list(F.when(F.col("place").isNull(), F.col("word")))).alias("rest")
    held = words.join(often.join(top, key, "left").drop("found"), key).groupBy("id").agg(*marked, rest)
    found = lines.select("id", "first", "family", F.size("words").alias("n")).join(held, "id", "left")
    none = F.array().cast("array<long>")
    found = found.withColumns({b: F.coalesce(b, F.lit(0).cast("long")) for b in bits} | {"rest": F.coalesce("rest", none)})
    form = {"form": F.xxhash64("n", *bits, "rest"), "form2": F.xxhash64(F.lit(1), "n", *bits, "rest")}
    return found.withColumns(form)


def _links_inside(sets: DataFrame, percent: int) -> DataFrame:
    """The same for links within families: id, links, late."""
    member = F.struct("id", "first", "words", F.size("words").alias("n"))
    few = sets.filter(f"lines <= {FEW_LINES}").groupBy("family").agg(F.collect_list(member).alias("members"))
    reached = (
        f"x.id <> y.id AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
        f" AND {_similar('x.words', 'y.words', percent)}"
    )
    # Links in the lower half, those to earlier lines in the upper: one pass.
    here = f"aggregate(members, 0L, (sum, y) -> sum + if({reached}, if(y.first < x.first, {(1 << 32) + 1}L, 1L), 0L))"
    found = few.select(F.expr(f"inline(transform(members, x -> struct(x.id AS id, {here} AS found)))"))
    found = found.filter("found > 0").select(
        "id", F.col("found").bitwiseAND(F.lit((1 << 32) - 1)).alias("links"),
        (F.shiftright("found", 32) > 0).alias("late"),
    )
    return found.union(_links_of_forms(sets.filter(f"lines > {FEW_LINES}"), percent))


def _links_of_forms(lines: DataFrame, percent: int) -> DataFrame:
    """The same for large families.

    The forms of a family are dealt into blocks; every block meets all others,
    a group of them at once, and each of its forms counts the lines it finds
    there and keeps the first of them.
    """
    key, bits = ["family", "form", "form2"], [f"bits{k}" for k in range(SHARED_BITS)]
    lines = stored(_forms(lines), "line-forms")
    forms = stored(
        lines.groupBy(*key, "n", *bits, "rest").agg(
            F.count(F.lit(1)).alias("lines"), F.min("first").alias("first")
        ),
        "line-family-forms",
    )
    blocks = F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_LINES), F.ceil(F.sum(F.size("rest")) / BLOCK_WORDS)
    )
    forms = forms.join(forms.groupBy("family").agg(blocks.cast("int").alias("blocks")), "family")
    block = F.pmod(F.xxhash64("form", "form2"), "blocks").cast("int").alias("block")
    p = percent
    least, most = F.expr(_least_share("n", p)).alias("least"), F.expr(f"100 * n div {p}").alias("most")
    member = F.struct("form", "form2", "n", least, most, *bits, F.size("rest").alias("size"), "rest", "lines", "first")
    dealt = forms.groupBy("family", "blocks", block).agg(F.collect_list(member).alias("members"))
    dealt = stored(dealt, "line-blocks")
    group = F.floor(F.col("block") / GROUP_BLOCKS).cast("int")
    groups = F.sequence(F.lit(0), F.floor((F.col("blocks") - 1) / GROUP_BLOCKS).cast("int"))
    mine = dealt.select("family", F.explode(groups).alias("group"), "members")
    theirs = dealt.groupBy("family", group.alias("group")).agg(F.flatten(F.collect_list("members")).alias("others"))
    common = " + ".join(f"bit_count(x.{b} & y.{b})" for b in bits)
    enough = f">= {p} * (x.n + y.n)"
    # Rests are compared only if they may decide it.
    reached = (
        f"y.n >= x.least AND y.n <= x.most AND {100 + p} * ({common} + least(x.size, y.size)) {enough}"
        f" AND (x.size = 0 OR y.size = 0 OR"
        f" {100 + p} * ({common} + size(array_intersect(x.rest, y.rest))) {enough})"
    )
    near = f"transform(members, x -> struct(x, filter(others, y -> {reached}) AS near))"
    # A form finds itself too if its own lines are similar.
    count = "aggregate(z.near, 0L, (sum, y) -> sum + y.lines - if(y.form = z.x.form AND y.form2 = z.x.form2, 1L, 0L))"
    first = "array_min(transform(z.near, y -> y.first))"
    found = mine.join(theirs, ["family", "group"]).select(
        "family",
        F.expr(f"inline(transform({near}, z -> struct(z.x.form, z.x.form2, {count} AS links, {first} AS least)))"),
    )
    found = found.filter("links > 0").groupBy(*key).agg(F.sum("links").alias("links"), F.min("least").alias("least"))
    return lines.join(found, key).select("id", "links", (F.col("least") < F.col("first")).alias("late"))


def line_report(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: row, doc_id, n_lines, n_removed, n_links, removed_lines.

    ``removed_lines`` lists the numbers of the lines that go.
    """
    lines = similar_lines(docs, percent, id_col, text_col)
    gone = F.array_sort(F.collect_list(F.when(F.col("removed"), F.col("line_no"))))
    return lines.groupBy("row", "doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("removed").alias("n_removed"),
        F.sum("links").alias("n_links"),
        gone.alias("removed_lines"),
    )


def without_repeated_lines(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the removed lines taken out of their texts; a null text stays null."""
    row = "_row" + "_" * max((len(c) for c in docs.columns), default=0)
    report = line_report(docs, percent, id_col, text_col).filter("n_removed > 0")
    plan = report.select(F.struct("row", "removed_lines").alias(row))
    joined = with_row(docs, f"{row}id").join(plan, F.col(f"{row}id") == F.col(f"{row}.row"), "left")
    gone = F.col(f"{row}.removed_lines")
    kept = F.array_join(
        F.filter(F.split(F.col(text_col), "\n"), lambda line, i: ~F.array_contains(gone, i)), "\n"
    )
    text = F.when(gone.isNull(), F.col(text_col)).otherwise(kept)
    return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))
