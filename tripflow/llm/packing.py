"""Best-fit packing of tokenised documents under several capacities.

A sequence has room for tokens, documents and attention cost (a document of n
tokens costs n * n). Pieces come in decreasing length; of the sequences where a
piece fits in every capacity, it goes to the one with the smallest weighted
norm of what is left, or with the largest weighted dot product of need and
rest. Pieces are dealt at random into groups of bounded size that are packed
apart, which costs about one open sequence per group of some thousands.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.batches import large_text, slices
from tripflow.llm.common import stored, with_row

# These bound a worker's memory only; results do not depend on them.
CACHE_WORDS = 500_000
ENCODE_WORDS = 2000


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds, and the weight of each capacity in the choice."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"  # or "dot"


class WordTokens:
    """Token ids by word. No pre-token of the vocabulary crosses white space.

    Words are tokenised once per worker and looked up afterwards. ``pool`` holds
    the ids of all words in a row.
    """

    def __init__(self, path: str):
        # Tasks run side by side already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.pool = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.met = np.zeros(1 << 16, np.int64)  # in how many slices a word occurred
        self.used = 0

    def _keep_common(self) -> None:
        """Forget words that occurred once, and of the others the rarer half if they are many."""
        met = self.met[: len(self.known)]
        keep = np.flatnonzero(met > 1)
        if len(keep) > CACHE_WORDS // 2:
            keep = np.sort(keep[np.argsort(-met[keep], kind="stable")[: CACHE_WORDS // 2]])
        words = list(self.known)
        pool, first, counts = self.pool, self.starts[keep], np.diff(self.starts)[keep]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - counts), counts)
        self._clear()
        self._store([words[i] for i in keep], pool[at], counts)
        self.met[: len(keep)] = met[keep] // 2

    def _store(self, words: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        """Words with the ids of all of them in a row, and how many each has."""
        first = len(self.known)
        while first + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        ends = self.used + np.cumsum(counts)
        self.starts[first + 1 : first + 1 + len(words)] = ends
        self.used += len(flat)

    def _add(self, words: list[str]) -> None:
        """Tokenise words as one text, a space between two, and deal the ids out by offset."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids, spans = found.ids, chain.from_iterable(found.offsets)
        heads = np.cumsum([0, *map(len, words[:-1])]) + np.arange(len(words))
        at = np.fromiter(spans, np.int64, 2 * len(ids))[::2]
        owner = np.searchsorted(heads, at, side="right") - 1
        self._store(words, np.array(ids, np.uint32), np.bincount(owner, minlength=len(words)))

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text starts (one more at the end)."""
        lists = pc.ascii_split_whitespace(large_text(texts))
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        if len(self.known) > CACHE_WORDS:
            self._keep_common()
        words = coded.dictionary.to_pylist()
        missing = [w for w in words if w not in self.known]
        for i in range(0, len(missing), ENCODE_WORDS):
            self._add(missing[i : i + ENCODE_WORDS])
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.met[index] += 1
        each = index[coded.indices.to_numpy()] if len(words) else np.empty(0, np.int64)
        first = self.starts[each]
        lengths = self.starts[each + 1] - first
        after = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(after[-1]) + np.repeat(first - after[:-1], lengths)
        return self.pool[at], after[ends - ends[0]]


@cache
def _word_tokens(path: str) -> WordTokens:
    """One per worker, which Spark reuses for many tasks."""
    return WordTokens(path)


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, most: int):
    tokens = _word_tokens(path)
    for batch in batches:
        for part in slices(batch, 2):
            ids, starts = tokens.documents(part.column(2))
            out = {"row": [], "doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            rows, docs = part.column(0).to_pylist(), part.column(1).to_pylist()
            for i in range(part.num_rows):
                own = np.append(ids[starts[i] : starts[i + 1]], np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), most)):
                    cut = own[start : start + most]
                    values = (rows[i], docs[i], piece, start, len(cut), zlib.crc32(cut.tobytes()))
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out)
            )


def tokenised_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    most: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``most`` tokens: row, doc_id, piece, start, length, ids_crc32.

    A document's ids are the tokenizer's, then ``end_id``. A null text is
    empty, and so one piece of one token.
    """
    rows = with_row(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    return rows.select("row", "doc_id", "text").mapInArrow(
        lambda batches: _cut(batches, tokenizer_path, end_id, most),
        "row long, doc_id long, piece int, start long, length long, ids_crc32 long",
    )


def best_fit(lengths: np.ndarray, room: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; lengths come in the order they are packed."""
    caps = np.array([room.tokens, room.documents, room.attention], float)
    weights = np.array(room.weights) / caps**2
    free = np.empty((3, len(lengths)))
    names = np.empty(len(lengths), np.int64)  # of the bins that may still take a piece
    bins, offsets = (np.empty(len(lengths), np.int64) for _ in range(2))
    least = lengths.min(initial=room.tokens)
    opened = active = 0
    for i, length in enumerate(lengths):
        need = np.array([length, 1.0, float(length) * length])
        left = free[:, :active] - need[:, None]
        fits = np.flatnonzero((left >= 0).all(axis=0))
        if len(fits):
            if room.rule == "dot":
                score = -(weights * need) @ free[:, fits]
            else:
                score = weights @ left[:, fits] ** 2
            at = fits[np.argmin(score)]
        else:
            at, active = active, active + 1
            free[:, at], names[at], opened = caps, opened, opened + 1
        bins[i] = names[at]
        offsets[i] = room.tokens - free[0, at]
        free[:, at] -= need
        if free[0, at] < least or free[1, at] < 1 or free[2, at] < least * least:
            active -= 1
            free[:, at], names[at] = free[:, active], names[active]
    return bins, offsets


def pack(pieces: DataFrame, room: Capacities = Capacities(), group_pieces: int = 8192) -> DataFrame:
    """Add sequence_id and offset to pieces, within every capacity.

    A piece that no empty sequence could take is an error. ``pieces`` must read
    a stored table; groups are dealt by a hash of row and piece, so no document
    makes a group large.
    """
    n = pieces.count()
    groups = max(1, -(-n // group_pieces))
    too_large = pieces.filter(
        (F.col("length") > room.tokens) | (F.col("length") * F.col("length") > room.attention)
    )
    if room.documents < 1 or too_large.limit(1).count():
        raise ValueError("a piece exceeds the capacities of an empty sequence")

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        bins, offsets = best_fit(table.column("length").to_numpy(), room)
        first = table.column("group")[0].as_py() << 32
        return table.drop_columns("group").append_column(
            "sequence_id", pa.array(bins + first)
        ).append_column("offset", pa.array(offsets))

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("group").applyInArrow(
        packed, f"{fields}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    room: Capacities = Capacities(),
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenise, cut and pack whole documents; see ``tokenised_pieces`` and ``pack``.

    ``docs`` must read a stored table; extra columns are ignored. An empty
    table gives an empty result.
    """
    pieces = tokenised_pieces(docs, tokenizer_path, end_id, room.tokens, id_col, text_col)
    return pack(stored(pieces, "pieces"), room)
