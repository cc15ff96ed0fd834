"""Exact de-duplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Distinct blocks are
sorted and named by their place, then distinct pairs of adjacent names are
sorted and named, and so on until one name is left. Two texts have the same
level and name exactly when they are the same: a name stands for one block or
one pair of names, so nothing can collide.

Only the first level moves text, and only once. Blocks meet by a 64-bit hash,
and all different blocks with one hash are kept beside each other, so a hash
that two blocks share still gives two names. Rows join names by hash; only if
some hash is shared do rows carry the blocks themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import WHITE, global_index, stored, with_row

BLOCK_BYTES = 4096
_NONE = -1  # partner of an odd last name; names start at 0


def _blocks(block_bytes: int) -> Column:
    """Blocks of the binary column ``bytes``; an empty text is one empty block."""
    return F.expr(
        f"transform(sequence(0L, (octet_length(bytes) - 1) div {block_bytes}),"
        f" i -> substring(bytes, cast(i * {block_bytes} + 1 as int), {block_bytes}))"
    )


def _normalised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return with_row(docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))).select(
        "row",
        "doc_id",
        F.length("text").alias("n_points"),
        F.regexp_replace("text", f"{WHITE}+", "").cast("binary").alias("bytes"),
    )


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with their place in sorted order as ``name``."""
    return global_index(df, keys, "name", "names")


def _block_names(texts: DataFrame, block_bytes: int, hashed: Callable[[Column], Column]):
    """Names of distinct blocks, and whether different blocks share a hash.

    ``collect_set`` combines in each task before the shuffle, so a block that
    millions of rows hold travels once per task. Its sets hold the different
    blocks of one 64-bit hash: one, but for a rare collision.
    """
    blocks = texts.select(F.explode(_blocks(block_bytes)).alias("block"))
    by_hash = (
        blocks.select(hashed(F.col("block")).alias("hash"), "block")
        .groupBy("hash")
        .agg(F.array_sort(F.collect_set("block")).alias("variants"))
        .select("hash", F.size("variants").alias("n"), F.posexplode("variants"))
        .select("hash", F.col("pos").alias("variant"), F.when(F.col("n") > 1, F.col("col")).alias("block"))
    )
    distinct = stored(by_hash, "blocks")
    shared = distinct.filter("block IS NOT NULL").limit(1).count() > 0
    return _named(distinct, ["hash", "variant"]), shared


def name_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per document with (level, name), equal exactly for equal normalised texts.

    Also row, doc_id, n_points (code points of the text as it is) and sha256
    (binary, of the normalised text). Null text counts as empty. ``docs`` must
    read a stored table. Extra columns are ignored, whatever their names.
    """
    texts = _normalised(docs, id_col, text_col)
    names, shared = _block_names(texts, block_bytes, hashed)

    pieces = F.transform(
        _blocks(block_bytes),
        lambda b: F.struct(
            hashed(b).alias("hash"), (b if shared else F.lit(None).cast("binary")).alias("block")
        ),
    )
    cut = stored(
        texts.select(
            "row", "doc_id", "n_points", F.unhex(F.sha2("bytes", 256)).alias("sha256"),
            pieces.alias("pieces"),
        ),
        "documents-cut",
    )

    placed = cut.select("row", F.size("pieces").alias("left"), F.posexplode("pieces").alias("pos", "p"))
    placed = placed.select("row", "left", "pos", "p.hash", F.col("p.block").alias("own"))
    same = placed["hash"] == names["hash"]
    if shared:
        same &= names["block"].isNull() | (names["block"] == placed["own"])
    level = placed.join(names, same).select("row", "left", "pos", "name")
    level = stored(level, "level-0")

    depth, done = 0, []
    most = cut.agg(F.max(F.size("pieces"))).first()[0] or 1
    while True:
        done.append(
            level.filter("left = 1").select("row", F.lit(depth).alias("level"), "name")
        )
        if most == 1:
            break
        most = -(-most // 2)
        depth += 1
        level = _next_level(level.filter("left > 1"), depth)
    identity = reduce(DataFrame.unionByName, done)
    return stored(cut.drop("pieces").join(identity, "row"), "documents-named")


def _next_level(level: DataFrame, depth: int) -> DataFrame:
    """Pairs of adjacent names, named in turn."""
    half = F.col("pos") % 2
    pairs = (
        level.groupBy("row", "left", F.expr("pos div 2").alias("half"))
        .agg(
            F.max(F.when(half == 0, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(_NONE)).alias("second"),
        )
    )
    pairs = stored(pairs, f"pairs-{depth}")
    names = _named(pairs.select("first", "second").distinct(), ["first", "second"])
    return stored(
        pairs.join(names, ["first", "second"]).select(
            "row",
            F.expr("cast((left + 1) div 2 as int)").alias("left"),
            F.col("half").cast("int").alias("pos"),
            "name",
        ),
        f"level-{depth}",
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Groups of equal texts and the row of each that stays.

    Texts are equal when they are the same without whitespace. Of equal texts
    the one with the most code points stays, then the smallest id; a null id
    comes last; of rows that repeat an id and text, the first in the table.
    Returns one row per input row: row, doc_id, keep_id, group_size, kept,
    text_sha256. An empty table gives an empty result.
    """
    named = name_documents(docs, id_col, text_col, block_bytes, hashed)
    order = F.struct(
        (-F.col("n_points")).alias("less"),
        F.col("doc_id").isNull().alias("no_id"),
        "doc_id",
        "row",
    )
    groups = named.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best")
    )
    # Stored first, so that the join has two plain sides and a large group can be split.
    groups = stored(groups, "text-groups")
    return named.join(groups, ["level", "name"]).select(
        "row",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def keep_first_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row stands for; columns unchanged."""
    # A name no column of the table has, however it is written.
    row = "_row" + "_" * max((len(c) for c in docs.columns), default=0)
    dropped = exact_dedup(docs, id_col, text_col).filter("NOT kept").select(F.col("row").alias(row))
    return with_row(docs, row).join(dropped, row, "left_anti").select(*docs.columns)
