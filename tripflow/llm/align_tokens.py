"""Alignment of two tokenizers over the same texts, and which ids they link.

Both tokenizers cut the bytes of a text, a space before it, into tokens. Sorted
by start, with the running maximum of their ends, the tokens of both fall into
groups: a group ends where a start reaches the running maximum. Inside a group
every token of A is linked with every token of B.

A text is cut before each space that follows something other than white space.
No token of either vocabulary crosses such a cut, so every distinct part is
tokenised and grouped once for a block of documents, and documents put their
parts together. A block is a bounded number of bytes, and lists its distinct
id pairs once: only these lists are counted over the corpus and come back to
their block, not the pairs of every document.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.batches import slices
from tripflow.llm.common import stored

BLOCK_BYTES = 8 << 20
CALL_CHARACTERS = 1 << 16  # of parts tokenised in one call

# A space after anything that is surely no white space. A place left out here
# makes a longer part, never another result.
_SURE = r"[^\s\u180e\u200b\ufeff\u2581]"
_CUT = re.compile(f"(?<={_SURE}) (?=.)", re.DOTALL)  # a space at the end stays with its part
_SAFE_END = re.compile(f"{_SURE}\\Z")
_MARK = "\u2581"

_DOCUMENTS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long,"
    " groups_sha256 string, pairs array<int>, times array<int>,"
    " block_a array<int>, block_b array<int>, block_documents array<long>"
)
_COUNTED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long,"
    " n_best long, count_sum long, groups_sha256 string"
)


def _byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others follow 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokenizer:
    """Byte-level BPE of a ``tokenizers`` file; special tokens in a text are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = _byte_of_character()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes[i] = bytes(byte[c] for c in entry)
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.cuts = True

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """A ``sentencepiece`` model that puts a space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.bytes.append(piece.replace(_MARK, " ").encode())
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.cuts = not any(_MARK in piece.lstrip(_MARK) for piece in pieces)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text[1:])


@cache
def _tokenizers(path_a: str, path_b: str) -> tuple[ByteTokenizer, PieceTokenizer]:
    """One of each per worker, which Spark reuses for many tasks."""
    return ByteTokenizer(path_a), PieceTokenizer(path_b)


def coalesce(
    starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Group number of every interval of A and of B, and how many groups there are."""
    starts = np.concatenate([starts_a, starts_b])
    ends = np.concatenate([ends_a, ends_b])
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order]) if len(order) else ends
    opens = np.ones(len(order), bool)
    opens[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[: len(starts_a)], group[len(starts_a) :], int(opens.sum())


@cache
def _signed_numbers(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts of numbers below ``most`` after no sign, ``;``, ``|`` and ``,``, and their lengths."""
    texts = [sign + str(i) for sign in ("", ";", "|", ",") for i in range(most)]
    return np.array(texts, dtype=object), np.array([len(x) for x in texts], np.int32)


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` for each i, ``counts[i]`` of them."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - counts), counts)


def _firsts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def _encoded(parts: list[bytes], texts: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all parts in a row, how many each has, and which parts come back as they were."""
    ids: list[int] = []
    counts = np.zeros(len(parts), np.int64)
    right = np.ones(len(parts), bool)

    def one_by_one(numbers):
        for i in numbers:
            found = tokenizer.encode(texts[i])
            right[i] = b"".join([tokenizer.bytes[t] for t in found]) == parts[i]
            counts[i] = len(found)
            ids.extend(found)

    def together(numbers):
        found = tokenizer.encode("".join([texts[i] for i in numbers]))
        whole = b"".join([parts[i] for i in numbers])
        token_ends = np.cumsum(tokenizer.sizes[found])
        part_ends = np.cumsum([len(parts[i]) for i in numbers])
        at = np.searchsorted(token_ends, part_ends)
        if b"".join([tokenizer.bytes[t] for t in found]) != whole or (token_ends[at] != part_ends).any():
            return one_by_one(numbers)
        counts[numbers] = np.diff(at, prepend=-1)
        ids.extend(found)

    held, room = [], CALL_CHARACTERS
    for i, text in enumerate(texts):
        held.append(i)
        room -= len(text)
        # A part that may run into the next one's space ends a call.
        if room <= 0 or not _SAFE_END.search(text):
            together(held)
            held, room = [], CALL_CHARACTERS
    if held:
        together(held)
    return np.array(ids, np.int32), counts, right


class Parts:
    """Distinct parts of a block: tokens, groups and links of each."""

    def __init__(self, texts: list[str], a: ByteTokenizer, b: PieceTokenizer):
        encoded = [t.encode() for t in texts]
        self.most = max(len(a.bytes), len(b.bytes))
        ids_a, self.n_a, right_a = _encoded(encoded, texts, a)
        ids_b, self.n_b, right_b = _encoded(encoded, texts, b)
        self.right = right_a & right_b
        number = np.arange(len(texts), dtype=np.int32)
        part_a, part_b = np.repeat(number, self.n_a), np.repeat(number, self.n_b)
        # Parts that do not come back are left out, whatever their lengths.
        keep_a, keep_b = self.right[part_a], self.right[part_b]
        ids_a, part_a, ids_b, part_b = ids_a[keep_a], part_a[keep_a], ids_b[keep_b], part_b[keep_b]
        self.n_a, self.n_b = np.where(self.right, [self.n_a, self.n_b], 0)
        size_a, size_b = a.sizes[ids_a], b.sizes[ids_b]
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        group_a, group_b, n = coalesce(ends_a - size_a, ends_a, ends_b - size_b, ends_b)

        owner = np.zeros(n, np.int64)  # the part of a group
        owner[group_a] = part_a
        self.n_groups = np.bincount(owner, minlength=len(texts))
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        links = in_a * in_b
        self.n_links = np.bincount(owner, weights=links, minlength=len(texts)).astype(np.int64)
        self._link(ids_a, group_a, in_b, ids_b, _firsts(in_b))
        self._write(ids_a, group_a, ids_b, group_b, owner, len(texts))

    def _link(self, ids_a, group_a, in_b, ids_b, first_b):
        """Links in the order of A's tokens, so that those of a part are in a row."""
        partners = in_b[group_a]
        at = _spread(first_b[group_a], partners)
        self.link_a, self.link_b = np.repeat(ids_a, partners), ids_b[at]
        self.first_link = _firsts(self.n_links)

    def _write(self, ids_a, group_a, ids_b, group_b, owner, n):
        """``a1,a2|b1;a3|b2`` of every part, written once and cut."""
        side = np.repeat(np.array([0, 1], np.int8), [len(ids_a), len(ids_b)])
        group = np.concatenate([group_a, group_b])
        order = np.lexsort((side, group))  # stable: tokens stay in their order
        ids, side, group = np.concatenate([ids_a, ids_b])[order], side[order], group[order]
        new_group = np.diff(group, prepend=-1) != 0
        new_side = np.diff(side, prepend=0) > 0
        part = owner[group] if len(group) else group
        new_part = np.diff(part, prepend=-1) != 0
        kind = np.where(new_part, 0, np.where(new_group, 1, np.where(new_side, 2, 3)))
        words, lengths = _signed_numbers(self.most)
        at = kind * self.most + ids
        lengths = lengths[at]
        written = "".join(words[at].tolist())
        ends = np.cumsum(np.bincount(part, weights=lengths, minlength=n).astype(np.int64))
        self.groups = [written[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def align_texts(texts: list[str | None], a: ByteTokenizer, b: PieceTokenizer):
    """Parts of all texts, the part numbers of every text in a row, and how many each text has.

    A text that is null or empty, or holds a part that does not come back from
    its tokens, has no parts.
    """
    cut = _CUT.split if a.cuts and b.cuts else lambda text: [text]
    number: dict[str, int] = {}
    own = [np.array([number.setdefault(p, len(number)) for p in cut(t)] if t else [], np.int64) for t in texts]
    codes = np.concatenate([np.empty(0, np.int64), *own])
    counts = np.array([len(x) for x in own], np.int64)
    parts = Parts([" " + p for p in number], a, b)
    text = np.repeat(np.arange(len(texts)), counts)
    wrong = np.bincount(text[~parts.right[codes]], minlength=len(texts)) > 0 if len(codes) else counts > 0
    codes = codes[~wrong[text]]
    return parts, codes, np.where(wrong, 0, counts)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType, mask=None) -> pa.Array:
    offsets = pa.array(_firsts(counts), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind), mask=mask)


def _block(ids: pa.Array, texts: list[str | None], block: int, a, b) -> pa.RecordBatch:
    parts, codes, counts = align_texts(texts, a, b)
    n = len(texts)
    text = np.repeat(np.arange(n), counts)

    def total(of_part):
        return pa.array(np.bincount(text, weights=of_part[codes], minlength=n).astype(np.int64))

    ends = np.cumsum(counts)
    written = [parts.groups[c] for c in codes.tolist()]
    digests = [
        hashlib.sha256(";".join(written[i:j]).encode()).hexdigest() if j > i else ""
        for i, j in zip((ends - counts).tolist(), ends.tolist(), strict=True)
    ]
    packed, pair = np.unique((parts.link_a.astype(np.int64) << 32) | parts.link_b, return_inverse=True)
    # A part that a text repeats brings its links once, with the number of its repeats.
    mine, repeats = np.unique(text * len(parts.right) + codes, return_counts=True)
    owner, code = mine // max(len(parts.right), 1), mine % max(len(parts.right), 1)
    at = _spread(parts.first_link[code], parts.n_links[code])
    key = np.repeat(owner, parts.n_links[code]) * len(packed) + pair[at]
    order = np.argsort(key, kind="stable")
    key, weight = key[order], np.repeat(repeats, parts.n_links[code])[order]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[heads], np.add.reduceat(weight, heads) if len(heads) else weight
    owner, index = key // max(len(packed), 1), key % max(len(packed), 1)
    documents = np.bincount(index, minlength=len(packed))
    # Pairs of parts that only texts without tokens hold are linked nowhere.
    used = np.flatnonzero(documents)
    index = (np.cumsum(documents > 0) - 1)[index]
    each = np.bincount(owner, minlength=n)
    first = np.zeros(n, np.int64)
    first[0] = len(used)
    others = pa.array(np.arange(n) > 0)

    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block)),
            ids.cast(pa.int64()),
            total(parts.n_a),
            total(parts.n_b),
            total(parts.n_groups),
            total(parts.n_links),
            pa.array(digests, pa.string()),
            _lists(index, each, pa.int32()),
            _lists(times, each, pa.int32()),
            _lists(packed[used] >> 32, first, pa.int32(), others),
            _lists(packed[used] & 0xFFFFFFFF, first, pa.int32(), others),
            _lists(documents[used], first, pa.int64(), others),
        ],
        names=[field.split()[0] for field in _DOCUMENTS.split(", ")],
    )


def _blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    a, b = _tokenizers(path_a, path_b)
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, 1, BLOCK_BYTES):
            yield _block(part.column(0), part.column(1).to_pylist(), number, a, b)
            number += 1


def aligned_documents(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents by block, with their distinct pairs as places in the block's list of pairs.

    Columns: block, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs,
    times (links of each pair), and on one row of a block block_a, block_b,
    block_documents: its pairs and how many of its documents hold each.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(lambda batches: _blocks(batches, path_a, path_b), _DOCUMENTS)


def _pairs_of_blocks(documents: DataFrame) -> DataFrame:
    listed = F.arrays_zip("block_a", "block_b", "block_documents")
    return (
        documents.filter("block_a IS NOT NULL")
        .select("block", F.posexplode(listed).alias("pair", "x"))
        .select(
            "block",
            "pair",
            F.col("x.block_a").alias("a"),
            F.col("x.block_b").alias("b"),
            F.col("x.block_documents").alias("documents"),
        )
    )


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    count, best = np.zeros(len(right), np.int64), np.zeros(len(right), bool)
    place = right.column("pair").to_numpy()
    count[place] = right.column("documents").to_numpy()
    best[place] = right.column("is_best").to_numpy()
    pairs = left.column("pairs").combine_chunks()
    each = pairs.value_lengths().to_numpy()
    index = pairs.flatten().to_numpy()
    times = left.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)

    def total(values):
        sums = _firsts(values)
        ends = np.cumsum(each)
        return pa.array(sums[ends] - sums[ends - each])

    names = [field.split()[0] for field in _COUNTED.split(", ")]
    kept = left.append_column("n_best", total(times * best[index]))
    return kept.append_column("count_sum", total(times * count[index])).select(names)


def link_counts(documents: DataFrame) -> DataFrame:
    """How many documents link each pair: a, b, documents, is_best.

    ``is_best`` marks the pairs of the highest count among those of their A id.
    ``documents`` is a stored result of ``aligned_documents``.
    """
    counts = stored(
        _pairs_of_blocks(documents).groupBy("a", "b").agg(F.sum("documents").alias("documents")),
        "link-counts",
    )
    # One row per id of A: no more than its vocabulary.
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    best = F.col("documents") == F.col("highest")
    return counts.join(F.broadcast(highest), "a").select("a", "b", "documents", best.alias("is_best"))


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens, groups and links of every document, and the corpus-wide counts of its links.

    Columns: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256. A is a byte-level BPE that reads a space and the text, B a
    sentencepiece model that adds the space itself. Texts that are null, empty
    or do not come back from the tokens of A and of B have zeros and ''.
    Repeated rows count as documents each, a null id stays null, ties for the
    highest count are all best, white space alone is text like any other, extra
    columns are ignored, an empty table gives an empty result. A document is
    never cut, however long: a block holds at least one.
    """
    documents = stored(aligned_documents(docs, path_a, path_b, id_col, text_col), "aligned")
    counts = link_counts(documents).withColumnRenamed("documents", "total")
    found = (
        _pairs_of_blocks(documents)
        .join(counts, ["a", "b"])
        .select(F.col("block").alias("home"), "pair", F.col("total").alias("documents"), "is_best")
    )
    own = documents.drop("block_a", "block_b", "block_documents")
    return own.groupBy("block").cogroup(found.groupBy("home")).applyInArrow(_summed, _COUNTED)


def _groups(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    a, b = _tokenizers(path_a, path_b)
    side = pa.list_(pa.int32())
    kind = pa.list_(pa.struct([("a", side), ("b", side)]))
    for batch in batches:
        for part in slices(batch, 1, BLOCK_BYTES):
            parts, codes, counts = align_texts(part.column(1).to_pylist(), a, b)
            written = iter([parts.groups[c] for c in codes.tolist()])
            found = []
            for count in counts.tolist():
                text = ";".join([next(written) for _ in range(count)])
                halves = [g.split("|") for g in text.split(";")] if count else []
                found.append(
                    [{k: list(map(int, x.split(","))) for k, x in zip("ab", h, strict=True)} for h in halves]
                )
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array(found, kind)], names=["doc_id", "groups"]
            )


def token_groups(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The groups of every document in order: doc_id, groups (ids of A, ids of B).

    Odd rows as in ``align_tokenizers``; a document without tokens has no group.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(
        lambda batches: _groups(batches, path_a, path_b),
        "doc_id long, groups array<struct<a: array<int>, b: array<int>>>",
    )
