"""Near-duplicate detection by min-max hashing, with links confirmed on full sets.

A document is the set of its 5-word shingles. Each of 60 hash functions gives
two values of a signature, the smallest and the largest hash of the set; five
values make a band, and documents that share a band are candidates. Two sets
at the threshold of 0.85 are missed with a probability below one in a million;
a lower threshold needs shorter bands (``BAND_ROWS_80``) for the same.

Exact copies are collapsed first. Candidates are linked in stars, one centre
per band value, never in all pairs, and the components of these links are the
clusters to look at. Inside a cluster every pair that could reach the
threshold is confirmed on the full sets: a prefix filter over the cluster's
rarest shingles finds the pairs, and pairs already connected are skipped. In a
cluster too large for one task each document first meets the centre it shares
most bands with, a step that grows with the documents. What these links connect
is contracted: documents of the largest part never meet each other again, only
the others do, and they meet the largest part, in blocks, each pair of blocks a
task of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.batches import large_text, slices
from tripflow.llm.common import stored, with_row
from tripflow.llm.components import connected_components
from tripflow.session import fresh_dir

WORDS = 5
PERCENT = 85
HASHES, BAND_ROWS = 60, 5
BAND_ROWS_80 = 4  # 30 bands: two sets at 0.8 are missed once in seven million
SEED = 11
BLOCK_SHINGLES, BLOCK_DOCUMENTS = 2_000_000, 4096
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in a row, and where each text starts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    index = coded.indices.to_numpy()
    real = np.fromiter(map(bool, words), bool, len(words))[index] if words else np.zeros(0, bool)
    each = hashes[index] if words else hashes
    return each[real], np.concatenate([[0], np.cumsum(real)])[ends]


def _shingles(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row, repeats included, and where each text starts.

    A text with fewer than ``n`` words but some is one shingle, hashed over
    all of them and their number.
    """
    counts = np.diff(starts)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_starts = np.concatenate([[0], np.cumsum(made)])
    value = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    out = np.empty(out_starts[-1], np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            value = value * _MULTIPLIER + words[i : i + len(value)]
        value = _mix(value)
        full = counts >= n
        at = np.arange(out_starts[-1]) + np.repeat(starts[:-1] - out_starts[:-1], made)
        whole = np.repeat(full, made)
        out[whole] = value[at[whole]]
        for i in np.flatnonzero(~full & (counts > 0)):
            short = np.uint64(counts[i])
            for word in words[starts[i] : starts[i + 1]]:
                short = short * _MULTIPLIER + word
            out[out_starts[i]] = _mix(np.array([short ^ np.uint64(0x5bd1e995)]))[0]
    return out, out_starts


def _functions(count: int, seed: int) -> np.ndarray:
    return np.random.SeedSequence(seed).generate_state(count, np.uint64) | np.uint64(1)


def signatures(shingles: np.ndarray, starts: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """Smallest, then largest values under each function; one row per (non-empty) text."""
    heads = starts[:-1]
    least = np.empty((len(heads), len(functions)), np.uint64)
    most = np.empty_like(least)
    with np.errstate(over="ignore"):
        for i, function in enumerate(functions):
            value = shingles * function
            value ^= value >> np.uint64(32)
            value *= function
            least[:, i] = np.minimum.reduceat(value, heads)
            most[:, i] = np.maximum.reduceat(value, heads)
    return np.concatenate([least, most], axis=1)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A hash for each band of ``rows`` values. No band mixes minima and maxima."""
    n = signature.shape[1] // rows
    out = np.empty((len(signature), n), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(n):
            value = np.full(len(signature), b + 1, np.uint64)
            for column in signature[:, b * rows : (b + 1) * rows].T:
                value = _mix(value * _MULTIPLIER + column)
            out[:, b] = value
    return out


def _sketched(batches: Iterator[pa.RecordBatch], n: int, hashes: int, rows: int, seed: int):
    functions = _functions(hashes, seed)
    per_text = 2 * hashes // rows
    for batch in batches:
        for part in slices(batch, 1):
            words, starts = _hashed_words(large_text(part.column(1)))
            shingles, at = _shingles(words, starts, n)
            some = np.flatnonzero(np.diff(at))
            count = np.zeros(part.num_rows, np.int64)
            digest = [None] * part.num_rows
            for i in some:
                count[i] = len(np.unique(shingles[at[i] : at[i + 1]]))
                own = words[starts[i] : starts[i + 1]].tobytes()
                digest[i] = hashlib.blake2b(own, digest_size=16).digest()
            heads = np.append(at[some], len(shingles))
            found = bands(signatures(shingles, heads, functions), rows) if len(some) else np.empty(0)
            each = np.zeros(part.num_rows, np.int32)
            each[some] = per_text
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(count),
                    pa.array(digest, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()),
                        pa.array(found.ravel().view(np.int64), pa.int64()),
                    ),
                ],
                names=["row", "n_shingles", "digest", "bands"],
            )


def _with_sets(batches: Iterator[pa.RecordBatch], n: int):
    """The text, in the last column, becomes its set of shingles; others pass."""
    for batch in batches:
        last = batch.num_columns - 1
        for part in slices(batch, last):
            words, starts = _hashed_words(large_text(part.column(last)))
            shingles, at = _shingles(words, starts, n)
            sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:last], pa.array(sets, pa.binary())],
                names=[*batch.schema.names[:last], "shingles"],
            )


def forest(
    nodes: np.ndarray, sets: list[np.ndarray], percent: int, parts: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that connect all nodes whose sets reach the threshold, as few as do.

    Nodes of one of ``parts`` are connected already; without it none are.

    Sets come in order of size. A set meets the earlier ones that share one of
    its ``size - least overlap + 1`` rarest elements; any set that reaches the
    threshold does. Those in its own component already are skipped.
    """
    parts = np.arange(len(sets)) if parts is None else np.unique(parts, return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    nodes, sizes, sets = nodes[order], sizes[order], [sets[i] for i in order]
    component = parts[order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    _, tokens, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rarity = np.empty(len(often), np.int64)
    rarity[np.argsort(often, kind="stable")] = np.arange(len(often))
    shared = np.empty(len(often), bool)
    shared[rarity] = often > 1
    tokens = rarity[tokens]
    least = -(-percent * sizes // 100)
    prefixes = []
    for i in range(len(sets)):
        own = tokens[starts[i] : starts[i + 1]]
        own.sort()
        head = own[: sizes[i] - least[i] + 1]
        prefixes.append(head[shared[head]])
    posted = np.concatenate(prefixes)
    by_token = np.argsort(posted, kind="stable")
    owner = np.repeat(np.arange(len(sets)), [len(p) for p in prefixes])[by_token]
    first = np.searchsorted(posted[by_token], np.arange(len(often) + 1))
    met = np.zeros(len(often), np.int64)  # how many of a token's sets are earlier

    held = np.zeros(len(often), bool)
    links = []
    for i, prefix in enumerate(prefixes):
        near = np.zeros(i, bool)
        for t in prefix:
            near[owner[first[t] : first[t] + met[t]]] = True
        met[prefix] += 1
        near &= (component[:i] != component[i]) & (sizes[:i] >= least[i])
        if not near.any():
            continue
        others = np.flatnonzero(near)
        lengths = sizes[others]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(starts[others] - (ends - lengths), lengths)
        own = tokens[starts[i] : starts[i + 1]]
        held[own] = True
        overlap = np.add.reduceat(held[tokens[at]].astype(np.int64), ends - lengths)
        held[own] = False
        reached = 100 * overlap >= percent * (lengths + sizes[i] - overlap)
        for j in others[reached]:
            if component[j] != component[i]:
                component[component == component[j]] = component[i]
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def _linked(table: pa.Table, percent: int) -> pa.Table:
    cluster = table.column("cluster").to_numpy()
    nodes, parts = table.column("node").to_numpy(), table.column("part").to_numpy()
    raw = table.column("shingles")
    order = np.argsort(cluster, kind="stable")
    links = []
    for same in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
        if len(same) > 1:
            sets = [np.frombuffer(raw[i].as_buffer(), np.uint64) for i in same]
            links += forest(nodes[same], sets, percent, parts[same])
    return pa.table(
        {
            "a": pa.array([x[0] for x in links], pa.int64()),
            "b": pa.array([x[1] for x in links], pa.int64()),
        }
    )


def _reached(batches: Iterator[pa.RecordBatch], percent: int):
    """Pairs of nodes whose sets reach the threshold."""
    for batch in batches:
        sets, others = batch.column(2), batch.column(3)
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (sets, others))
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1)], names=["a", "b"]
        ).filter(pa.array(keep))


def _stored_sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """``nodes`` with the shingles of their texts. Texts are moved once, and both
    sides of the join grow with the corpus, so it is the same at every size.
    Sets of large clusters have files of their own.
    """
    rows = docs.join(nodes.hint("merge"), F.col("row") == F.col("node"))
    columns = [c for c in nodes.columns if c != "large"]
    sets = rows.select("large", *columns, "text").mapInArrow(
        lambda batches: _with_sets(batches, n),
        "large boolean, "
        + ", ".join(f"{c} {nodes.schema[c].dataType.simpleString()}" for c in columns)
        + ", shingles binary",
    )
    path = fresh_dir(docs.sparkSession, "near-sets")
    sets.write.partitionBy("large").parquet(path)
    return docs.sparkSession.read.schema(sets.schema).parquet(path)


def _star_links(sets: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of nodes to the centre each shares most bands with: (a, b)."""
    shared = stars.join(sets.select("node"), "node").groupBy("node", "centre").count()
    best = F.max(F.struct("count", (-F.col("centre")).alias("centre"))).alias("best")
    chosen = shared.groupBy("node").agg(best).select("node", (-F.col("best.centre")).alias("centre"))
    # Stored, so that the join has two plain sides and Spark can split a centre which many nodes have.
    chosen = stored(chosen, "near-chosen")
    centres = chosen.select("centre").distinct()
    others = sets.select(F.col("node").alias("centre"), F.col("shingles").alias("other"))
    others = stored(others.join(centres, "centre"), "near-centre-sets")
    pairs = sets.select("node", "shingles").join(chosen, "node").join(others, "centre")
    return pairs.select("node", "centre", "shingles", "other").mapInArrow(
        lambda batches: _reached(batches, percent), "a long, b long"
    )


def _blocks(shingles: Column, documents: Column) -> Column:
    return F.greatest(
        F.ceil(shingles / BLOCK_SHINGLES), F.ceil(documents / BLOCK_DOCUMENTS)
    ).cast("int")


def _confirmed(
    docs: DataFrame, clusters: DataFrame, stars: DataFrame, counts: DataFrame, n: int, percent: int
) -> DataFrame:
    """Links that connect what is similar in each cluster, from the full sets of its texts."""
    members = clusters.join(counts, "node")
    blocks = _blocks(F.sum("n_shingles"), F.count(F.lit(1)))
    totals = members.groupBy("cluster").agg(
        F.sum("n_shingles").alias("shingles"), blocks.alias("blocks")
    )
    totals = stored(totals, "near-totals")
    small = totals.filter("blocks = 1").agg(F.sum("shingles")).first()[0] or 0
    tasks = max(1, -(-small // BLOCK_SHINGLES))

    size = totals.select("cluster", (F.col("blocks") > 1).alias("large"))
    sets = _stored_sets(docs, members.join(size, "cluster"), n)

    # Large clusters: what the stars connect is contracted.
    large_sets = sets.filter("large")
    links = stored(_star_links(large_sets, stars, percent), "near-star-links")
    solid = connected_components(links, "near-solid").withColumnRenamed("component", "part")
    large = large_sets.select("node", "cluster", "n_shingles").join(solid, "node", "left")
    large = stored(large.withColumn("part", F.coalesce("part", "node")), "near-parts")
    sizes = large.groupBy("cluster", "part").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_shingles").alias("shingles")
    )
    # Blocks of the largest part come first, then those of all others together.
    first = F.max(F.struct("documents", "shingles", "part"))
    layout = (
        sizes.groupBy("cluster")
        .agg(first.alias("top"), F.sum("documents").alias("d"), F.sum("shingles").alias("s"))
        .select(
            "cluster",
            F.col("top.part").alias("top"),
            _blocks(F.col("top.shingles"), F.col("top.documents")).alias("firsts"),
            _blocks(F.col("s") - F.col("top.shingles"), F.col("d") - F.col("top.documents")).alias("rest"),
        )
    )
    layout = stored(layout, "near-layout")
    in_top = F.col("part") == F.col("top")
    place = lambda count: F.pmod(F.xxhash64("node"), F.greatest(count, F.lit(1))).cast("int")
    own = F.when(in_top, place(F.col("firsts"))).otherwise(F.col("firsts") + place(F.col("rest")))
    number = F.expr("explode(sequence(0, firsts + rest - 1))").alias("other")
    meeting = F.when(in_top, F.col("other") >= F.col("firsts")).otherwise(F.col("other") != F.col("own"))
    large = large.join(layout, "cluster").filter(~in_top | (F.col("rest") > 0))
    large = large.select("node", "part", "top", "firsts", "rest", own.alias("own"))

    # Small clusters share tasks; the blocks of a large one meet in pairs.
    task = F.pmod(F.xxhash64("cluster"), F.lit(tasks)).alias("task")
    alone = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")).alias("meet")
    alike = sets.filter("NOT large").select(
        F.lit(False).alias("large"), task, alone, "cluster", "node", F.col("node").alias("part"), "shingles"
    )
    pair = F.struct(F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    apart = large_sets.join(large, "node").select("*", number).filter(meeting)
    apart = apart.select(
        F.lit(True).alias("large"), F.col("cluster").alias("task"), pair.alias("meet"),
        "cluster", "node", "part", "shingles",
    )
    found = alike.union(apart).groupBy("large", "task", "meet").applyInArrow(
        lambda table: _linked(table, percent), "a long, b long"
    )
    return found.union(links)


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    hashes: int = HASHES,
    band_rows: int = BAND_ROWS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Components of near-duplicates: row, doc_id, n_shingles, component_id, kept.

    Words are runs of non-blanks with A-Z in lower case. Two documents are
    linked when 100 times their common shingles reach ``percent`` times all
    their shingles. ``component_id`` is the smallest id reachable (null only if
    all are null), and one row of a component is ``kept``: that with the
    smallest id, of rows that repeat it the first. Texts that are null or have
    no word are alone. ``docs`` must read a stored table; extra columns are
    ignored; an empty table gives an empty result.
    """
    texts = with_row(
        docs.select(
            F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
        )
    )
    sketches = texts.select("row", "text").mapInArrow(
        lambda batches: _sketched(batches, words, hashes, band_rows, seed),
        "row long, n_shingles long, digest binary, bands array<long>",
    )
    sketches = stored(sketches, "near-sketches")

    # Rows with the same words are one node: the first of them.
    nodes = stored(
        sketches.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node")),
        "near-nodes",
    )
    firsts = nodes.select(F.col("node").alias("row"))
    banded = sketches.join(firsts, "row").select(
        F.col("row").alias("node"), F.explode("bands").alias("band")
    )
    centres = (
        banded.groupBy("band")
        .agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    stars = banded.join(stored(centres, "near-centres"), "band")
    stars = stored(stars.filter("node <> centre").select("centre", "node"), "near-stars")
    clusters = stored(
        connected_components(stars, "near-clusters").withColumnRenamed("component", "cluster"),
        "near-clusters",
    )
    counts = sketches.select(F.col("row").alias("node"), "n_shingles")
    links = stored(_confirmed(texts, clusters, stars, counts, words, percent), "near-links")
    linked = connected_components(links, "near-linked")

    ids = texts.select("row", "doc_id")
    of_node = nodes.join(linked, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component")
    )
    of_node = stored(of_node, "near-of-node")
    placed = (
        sketches.drop("bands")
        .join(of_node, "digest", "left")
        .select("row", "n_shingles", F.coalesce("component", "row").alias("component"))
    )
    placed = stored(placed.join(ids, "row"), "near-placed")
    best = placed.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    )
    return placed.join(stored(best, "near-best"), "component").select(
        "row",
        "doc_id",
        "n_shingles",
        F.col("best.doc_id").alias("component_id"),
        (F.col("row") == F.col("best.row")).alias("kept"),
    )


def keep_one_of_each(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    percent: int = PERCENT,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """``docs`` with one row of every group of near-duplicates; columns unchanged."""
    row = "_row" + "_" * max((len(c) for c in docs.columns), default=0)
    found = near_duplicates(
        docs, percent=percent, band_rows=band_rows, id_col=id_col, text_col=text_col
    )
    dropped = found.filter("NOT kept").select(F.col("row").alias(row))
    return with_row(docs, row).join(dropped, row, "left_anti").select(*docs.columns)
