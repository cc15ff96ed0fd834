"""Exact top-k search by inner product, term at a time.

Vectors are sparse rows of integer weights; a term is a dimension. Queries and
candidates are packed into blocks of bounded rows and bytes and stored. Queries
go out in rounds of a few blocks, broadcast to where the candidates are read,
so candidates are never shuffled. Every term of a query scatters its weight
times the posting weights into a dense array of scores, one per candidate of a
block. A partition selection keeps the best k, merged over the blocks of a task
and then over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.llm.common import global_index, stored
from tripflow.session import fresh_dir

SCALE = 1024
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 8192
BLOCK_BYTES = 16 << 20  # a block has at least one vector, also a longer one
ROUND_BLOCKS = 4  # query blocks broadcast at once: 64 MB
_ENTRY_BYTES = 12

_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("ids", pa.binary()),
        ("starts", pa.binary()),
        ("terms", pa.binary()),
        ("weights", pa.binary()),
    ]
)
_BLOCK_SQL = "block long, ids binary, starts binary, terms binary, weights binary"
_LEAST, _MOST = -(2**63), 2**63 - 1


def _packed(
    batches: Iterator[pa.RecordBatch], most: int, most_bytes: int, seed: int
) -> Iterator[pa.RecordBatch]:
    """Blocks of bounded rows and bytes: ids, and each row's terms and weights."""
    ids, terms, weights, held, count = [], [], [], 0, 0

    def block():
        starts = np.concatenate([[0], np.cumsum([len(t) for t in terms], dtype=np.int64)])
        columns = (
            np.array(ids, np.int64),
            starts.astype(np.int64),
            np.concatenate(terms).astype(np.int32),
            np.concatenate(weights),
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([seed + count], pa.int64())]
            + [pa.array([c.tobytes()], pa.binary()) for c in columns],
            schema=_BLOCK,
        )

    for batch in batches:
        numbers = batch.column(1)
        for i, vec_id in enumerate(batch.column(0).to_pylist()):
            row = numbers[i].values.to_numpy(zero_copy_only=False).astype(np.float64)
            used = np.flatnonzero(row)
            size = len(used) * _ENTRY_BYTES
            if ids and (len(ids) == most or held + size > most_bytes):
                yield block()
                ids, terms, weights, held, count = [], [], [], 0, count + 1
            ids.append(vec_id)
            terms.append(used)
            weights.append(row[used])
            held += size
    if ids:
        yield block()


def _postings(terms, weights, starts):
    """Candidates and their weights by term, in the order of the candidates."""
    owners = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.argsort(terms, kind="stable")
    terms, owners, weights = terms[order], owners[order], weights[order]
    heads = np.flatnonzero(np.diff(terms, prepend=-1))
    ends = np.append(heads[1:], len(terms))
    return {
        int(terms[a]): (owners[a:b], weights[a:b]) for a, b in zip(heads, ends, strict=True)
    }


def _whole(weights: np.ndarray, others: np.ndarray, terms: int):
    """Weights as longs, or as Python integers where a score could pass 63 bits."""
    top = lambda w: np.abs(w).max(initial=0)
    if float(top(weights)) * float(top(others)) * max(terms, 1) < 2**62:
        return weights.astype(np.int64)
    return np.array([int(w) for w in weights], dtype=object)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k highest scores, ties to smaller ids."""
    at = np.arange(len(scores))
    if len(at) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(at) - k)[len(at) - k])
    # The complement rises as scores fall and never overflows.
    return at[np.lexsort((ids[at], ~scores[at]))][:k]


def _score(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best k of each query over all candidate blocks that the task reads.

    The task holds k results for each query of a round, one query block and one
    candidate block.
    """
    best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    asked: dict[int, np.ndarray] = {}
    for batch in batches:
        for pair in batch.to_pylist():
            c_ids, q_ids = (np.frombuffer(pair[x], np.int64) for x in ("c_ids", "q_ids"))
            c_starts, q_starts = (np.frombuffer(pair[x], np.int64) for x in ("c_starts", "q_starts"))
            c_terms, q_terms = (np.frombuffer(pair[x], np.int32) for x in ("c_terms", "q_terms"))
            c_raw, q_raw = (np.frombuffer(pair[x], np.float64) for x in ("c_weights", "q_weights"))
            longest = int(np.diff(q_starts).max(initial=0))
            postings = _postings(c_terms, _whole(c_raw, q_raw, longest), c_starts)
            q_weights = _whole(q_raw, c_raw, longest)
            asked[pair["q_no"]] = q_ids
            for q, query_id in enumerate(q_ids):
                scores = np.zeros(len(c_ids), q_weights.dtype)
                for t in range(q_starts[q], q_starts[q + 1]):
                    if (found := postings.get(int(q_terms[t]))) is not None:
                        owners, weights = found
                        scores[owners] += q_weights[t] * weights
                others = c_ids != query_id
                scores, ids = np.clip(scores[others], _LEAST, _MOST).astype(np.int64), c_ids[others]
                at = _best(scores, ids, k)
                scores, ids = scores[at], ids[at]
                if (held := best.get((pair["q_no"], q))) is not None:
                    scores, ids = np.concatenate([held[0], scores]), np.concatenate([held[1], ids])
                    at = _best(scores, ids, k)
                    scores, ids = scores[at], ids[at]
                best[pair["q_no"], q] = scores, ids
    for (q_no, q), (scores, ids) in best.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{q_no}/{q}"] * len(ids), pa.string()),
                pa.array(np.full(len(ids), asked[q_no][q]), pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(scores, pa.int64()),
            ],
            names=["query_row", "query_id", "vec_id", "score"],
        )


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Ids and floor(scale * x) of vectors without nulls and non-finite numbers."""
    x = F.col(vector_col)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, finite))
    scaled = F.transform(x, lambda v: _floor(v.cast("double") * scale))
    return rows.select(F.col(id_col).cast("long").alias("id"), scaled.alias("weights"))


def _floor(x):
    """Floor that stays a double: a long could not hold every finite double."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    candidate_block: int = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
    block_bytes: int = BLOCK_BYTES,
    round_blocks: int = ROUND_BLOCKS,
) -> DataFrame:
    """The k best candidates of each query: query_id, rank, vec_id, score.

    Queries are the vectors whose id is divisible by ``every``; candidates are
    all vectors with another id. Vectors that are null, hold a null or a
    non-finite number, or have no id take no part. Vectors of different
    lengths meet on the terms they share. An id that repeats gives a result
    per row, with ties between equal ids in no particular order. Scores past
    63 bits are added exactly and end at the limits of a long. An empty table,
    or one without a query, gives no rows; extra columns are ignored.

    Candidates are stored in blocks and stay where they are. Query blocks go to
    them in rounds: ``round_blocks`` blocks of at most ``block_bytes`` (or one
    vector, if that is longer) are broadcast, every candidate block of a task
    meets each of them, and a task gives at most k results per query. Results
    of a round are stored before the next round starts.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vector_col, scale)

    def pack(df: DataFrame, most: int, label: str) -> DataFrame:
        def run(batches):
            from pyspark import TaskContext

            return _packed(batches, most, block_bytes, TaskContext.get().partitionId() << 33)

        return stored(df.mapInArrow(run, _BLOCK_SQL), label)

    queries = whole.filter(F.col("id") % every == 0)
    # As few tasks as blocks are needed, so that blocks are full; a row's task does not matter.
    count, entries = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("weights")), F.lit(0))).first()
    tasks = max(1, -(-count // query_block), -(-entries * _ENTRY_BYTES // block_bytes))
    packed = pack(queries.repartition(tasks), query_block, "q_blocks")
    numbers = stored(global_index(packed.select("block"), ["block"], "q_no"), "q_numbers")
    asked = packed.join(numbers, "block").select(
        "q_no", *(F.col(c).alias(f"q_{c}") for c in _BLOCK.names if c != "block")
    )
    candidates = pack(whole, candidate_block, "c_blocks").select(
        *(F.col(c).alias(f"c_{c}") for c in _BLOCK.names if c != "block")
    )
    path = fresh_dir(spark, "top-k")
    blocks = numbers.count()
    best = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    for first in range(0, max(blocks, 1), round_blocks):
        last = first + round_blocks
        sent = asked.filter(F.col("q_no").between(first, last - 1))
        numbered = F.sequence(F.lit(first).cast("long"), F.lit(last - 1).cast("long"))
        # The broadcast has a proven bound: round_blocks * block_bytes.
        pairs = candidates.withColumn("q_no", F.explode(numbered)).join(F.broadcast(sent), "q_no")
        pairs.mapInArrow(
            lambda batches: _score(batches, k),
            "query_row string, query_id long, vec_id long, score long",
        ).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
            "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
        ).write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)
