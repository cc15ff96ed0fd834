"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered in the order of their ids. A keyed Feistel network permutes
0 .. 2^bits - 1; numbers that leave 0 .. n - 1 go through it again until they
are back (cycle walking), which makes it a permutation of the row numbers.
Shard and slot of a row follow from its number alone, and so can be computed
for any row without looking at the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import global_index, with_row

ROUNDS = 6
SEED = 20_240_607


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser of the half and the round key."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [int(k) for k in np.random.SeedSequence(seed).generate_state(rounds, np.uint64)]


def permute(numbers: np.ndarray, n: int, keys: list[int]) -> np.ndarray:
    """Permutation of 0 .. n - 1, applied to some of its numbers.

    The domain has at most four times as many numbers as there are rows, so a
    walk takes four steps on average.
    """
    half = max(1, -(-(max(n, 2) - 1).bit_length() // 2))
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for key in keys:
            left, right = right, left ^ (_mixed(right, key) & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def shard_rows(
    docs: DataFrame,
    shards: int = 8,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Shard and slot of every row, shard sizes at most one row apart.

    Returns row, doc_id, size (UTF-8 bytes plus 1; a null text has none),
    text_crc32 (of nothing for a null text: 0), row_number, shard, slot. Slots
    of a shard run from 0 without gaps. Rows are numbered by id, null ids
    first, repeated ids by text and then by their place in the table, so the
    result depends on the seed and the rows alone. No text is shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = with_row(docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))).select(
        "row",
        "doc_id",
        (F.octet_length("text") + F.lit(1)).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    numbered = global_index(rows, ["doc_id", "text_crc32", "size", "row"], "row_number", "shards")
    n = numbered.count()
    keys = round_keys(seed)

    @F.pandas_udf("long")
    def permuted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permute(batch.to_numpy(), n, keys))

    placed = numbered.withColumn("_to", permuted("row_number"))
    return placed.select(
        *numbered.columns,
        (F.col("_to") % shards).cast("int").alias("shard"),
        F.expr(f"_to div {shards}").alias("slot"),
    )
