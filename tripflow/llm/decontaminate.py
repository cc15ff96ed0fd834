"""Benchmark decontamination: passages of test items found in training texts.

Words are runs of ASCII letters, digits and anything beyond ASCII, with A-Z in
lower case. A window is 10 consecutive words of an item; an item of fewer words
is one window. The distinct windows are a hash set that every worker gets by
broadcast: a text's windows are looked up by a rolling hash of word numbers,
and a hit counts only if all its word numbers are equal. Words have the same
number only if they are the same word, so no hit rests on a hash.

The set is measured before it is broadcast. One that is larger than a part
may be is dealt by hash into several, and texts pass one part after another,
with what was found so far beside them; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.batches import large_text, slices
from tripflow.llm.common import stored

WINDOW = 10
PART_BYTES = 64 << 20  # of windows broadcast at a time

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _folded_bytes() -> np.ndarray:
    """Lower case for A-Z, a space for every byte that no word holds."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    word = np.zeros(256, bool)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        word[first : last + 1] = True
    return np.where(word[table], table, np.uint8(0x20))


_FOLDED = _folded_bytes()


class Words:
    """Words of a batch of texts in a row: their texts, and where they lie in the bytes."""

    def __init__(self, column: pa.Array):
        texts = large_text(column)
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
        raw = texts.buffers()[2]
        raw = np.frombuffer(raw, np.uint8, offsets[-1]) if raw else np.empty(0, np.uint8)
        folded = _FOLDED[raw]
        inside = folded != 0x20
        # A word starts where none goes on: after a space, or at the head of a text.
        head = np.zeros(len(raw) + 1, bool)
        head[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
        self.starts = np.flatnonzero(inside & (~before | head[:-1]))
        after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
        self.ends = np.flatnonzero(inside & (~after | head[1:])) + 1
        self.texts = offsets
        self.first = np.searchsorted(self.starts, offsets)  # word of each text, one more at the end
        buffers = [None, pa.py_buffer(_offsets_of(self.starts, self.ends)), pa.py_buffer(folded)]
        # Every second entry is a word, the others what lies between.
        mixed = pa.Array.from_buffers(pa.large_binary(), 2 * len(self.starts), buffers)
        self.words = mixed.take(pa.array(np.arange(0, 2 * len(self.starts), 2)))


def _offsets_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Offsets that alternate between the start and the end of each word."""
    out = np.zeros(2 * len(starts) + 1, np.int64)
    out[0:-1:2], out[1:-1:2] = starts, ends
    out[-1] = ends[-1] if len(ends) else 0
    return out


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Windows of items, words joined by spaces."""
    for batch in batches:
        for part in slices(batch, 1):
            found = Words(part.column(1))
            words = found.words.cast(pa.large_string()).to_pylist()
            ids, grams = [], []
            for item, a, b in zip(part.column(0).to_pylist(), found.first[:-1], found.first[1:], strict=True):
                for i in range(a, max(b - size, a) + 1 if b > a else a):
                    ids.append(item)
                    grams.append(" ".join(words[i : min(i + size, b)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(grams, pa.string())], names=["item", "gram"]
            )


class WindowSet:
    """Distinct windows of one part as word numbers, by length, and the items of each."""

    def __init__(self, table: pa.Table):
        grams = table.column("gram").combine_chunks().dictionary_encode()
        texts = [g.split(" ") for g in grams.dictionary.to_pylist()]
        number: dict[str, int] = {}
        coded = [[number.setdefault(w, len(number)) for w in words] for words in texts]
        self.vocabulary = pa.array([w.encode() for w in number], pa.large_binary())
        items = table.column("item").combine_chunks().dictionary_encode()
        self.items = items.dictionary.to_pylist()
        # Windows by length; the items of a window lie in a row.
        gram_of, item_of = grams.indices.to_numpy(), items.indices.fill_null(-1).to_numpy()
        order = np.argsort(gram_of, kind="stable")
        item_of, first = item_of[order], np.searchsorted(gram_of[order], np.arange(len(coded) + 1))
        lengths = np.array([len(c) for c in coded], np.int64)
        self.lengths = {}
        for length in np.unique(lengths).tolist():
            which = np.flatnonzero(lengths == length)
            rows = np.array([coded[i] for i in which], np.int64)
            hashes = _rolled(rows.ravel(), length)[::length] if len(rows) else np.empty(0, np.uint64)
            by_hash = np.argsort(hashes, kind="stable")
            self.lengths[length] = hashes[by_hash], rows[by_hash], which[by_hash]
        self.first, self.item_of = first, item_of


def _rolled(numbers: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` numbers in a row."""
    out = np.zeros(max(len(numbers) - length + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        mixed = (numbers.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
        for i in range(length):
            out = out * _MULTIPLIER + mixed[i : i + len(out)]
    return out ^ (out >> np.uint64(32))


def _occurrences(words: Words, known: WindowSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, length and window of every occurrence; a place is a word of the batch."""
    coded = words.words.dictionary_encode()
    of_word = pc.fill_null(pc.index_in(coded.dictionary, known.vocabulary), -1).to_numpy()
    numbers = of_word[coded.indices.to_numpy()].astype(np.int64) if len(of_word) else np.empty(0, np.int64)
    end = np.repeat(words.first[1:], np.diff(words.first))  # where the text of a word ends
    strange = np.concatenate([[0], np.cumsum(numbers < 0)])
    places, lengths, windows = [], [], []
    for length, (hashes, rows, which) in known.lengths.items():
        at = np.arange(max(len(numbers) - length + 1, 0))
        at = at[(strange[at + length] == strange[at]) & (at + length <= end[at])]
        if not len(at):
            continue
        looked = _rolled(numbers, length)[at]
        low, high = (np.searchsorted(hashes, looked, side) for side in ("left", "right"))
        # Windows of equal hash lie in a row; each is compared in full.
        for step in range(int((high - low).max(initial=0))):
            meets = np.flatnonzero(low + step < high)
            row = low[meets] + step
            same = (numbers[at[meets][:, None] + np.arange(length)] == rows[row]).all(axis=1)
            places.append(at[meets][same])
            lengths.append(np.full(same.sum(), length))
            windows.append(which[row[same]])
    joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (places, lengths, windows)]
    return joined[0], joined[1], joined[2]


def _found(words: Words, known: WindowSet, n: int, spans: list, items: list) -> tuple[list, list]:
    """Spans of hit words (first, last + 1, and their bytes) and items of every text.

    ``spans`` and ``items`` hold what earlier parts found.
    """
    place, length, window = _occurrences(words, known)
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + length, -1)
    text_of = np.searchsorted(words.first, place, side="right") - 1
    for text, start, end in ((t, w[0], w[1]) for t, own in enumerate(spans) for w in own):
        change[words.first[text] + start] += 1
        change[words.first[text] + end] -= 1
    hit = np.cumsum(change)[:-1] > 0
    head = np.zeros(len(hit) + 1, bool)
    head[words.first] = True
    before = np.concatenate([[False], hit[:-1]]) if len(hit) else hit
    after = np.concatenate([hit[1:], [False]]) if len(hit) else hit
    starts = np.flatnonzero(hit & (~before | head[:-1]))
    ends = np.flatnonzero(hit & (~after | head[1:])) + 1
    owner = np.searchsorted(words.first, starts, side="right") - 1
    out: list[list] = [[] for _ in range(n)]
    for t, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
        base, byte = int(words.first[t]), int(words.texts[t])
        span = (a - base, b - base, int(words.starts[a]) - byte, int(words.ends[b - 1]) - byte)
        out[t].append(span)

    named = [set(own) for own in items]
    pairs = np.unique(np.stack([text_of, window], axis=1), axis=0) if len(place) else np.empty((0, 2), int)
    for t, w in pairs.tolist():
        own = known.item_of[known.first[w] : known.first[w + 1]]
        named[t].update(known.items[i] for i in own[own >= 0])
    return out, [sorted(x) for x in named]


_SPAN = pa.struct([(x, pa.int64()) for x in ("first_word", "end_word", "first_byte", "end_byte")])
_SPANS, _ITEMS = pa.list_(_SPAN), pa.list_(pa.string())
_SPAN_SQL = "first_word: bigint, end_word: bigint, first_byte: bigint, end_byte: bigint"


def _scan(batches: Iterator[pa.RecordBatch], shared, text_at: int, first: bool) -> Iterator[pa.RecordBatch]:
    """Add or complete the last three columns: n_words, spans, items."""
    known = shared.value
    for batch in batches:
        for part in slices(batch, text_at):
            n = part.num_rows
            words = Words(part.column(text_at))
            if first:
                own, spans, items = part.columns, [[]] * n, [[]] * n
            else:
                own = part.columns[:-3]
                spans = [
                    [(s["first_word"], s["end_word"]) for s in x] for x in part.column(part.num_columns - 2).to_pylist()
                ]
                items = part.column(part.num_columns - 1).to_pylist()
            spans, items = _found(words, known, n, spans, items)
            keys = [f.name for f in _SPAN]
            spans = [[dict(zip(keys, s, strict=True)) for s in x] for x in spans]
            more = [pa.array(np.diff(words.first)), pa.array(spans, _SPANS), pa.array(items, _ITEMS)]
            columns = [*own, *more]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])


def benchmark_windows(
    benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Distinct windows of every item: item, gram. Null texts and texts without a word have none."""
    chosen = benchmark.select(F.col(id_col).cast("string"), F.col(text_col))
    return chosen.mapInArrow(
        lambda batches: _windows(batches, size), "item string, gram string"
    ).distinct()


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    size: int = WINDOW,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    part_bytes: int = PART_BYTES,
    names: tuple[str, str, str] = ("n_words", "spans", "items"),
) -> DataFrame:
    """``docs`` with n_words, spans (hit words, and their bytes in the text) and items.

    A word is hit if it lies in any occurrence of a window of ``benchmark``.
    Spans do not touch each other; ``items`` are the ids with an occurring
    window, as sorted strings. Rows that share an item id are one item; items
    without an id hit words but are not named. Null, empty and word-less texts
    have no words and no span; repeated rows are judged alike; columns of
    ``docs`` that have the names of the new ones give way to them; either table
    may be empty. A text is looked at as a whole, however long.
    """
    if text_col in names:
        raise ValueError(f"texts are in {text_col}: choose other names")
    # Read twice: to measure, and by part.
    windows = stored(benchmark_windows(benchmark, size, item_id_col, item_text_col), "windows")
    size_of = F.octet_length("gram") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16
    total = windows.agg(F.sum(size_of)).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    found = docs.drop(*names)
    own, at = found.columns, found.columns.index(text_col)
    kinds = ("bigint", f"array<struct<{_SPAN_SQL}>>", "array<string>")
    more = T.StructType.fromDDL(", ".join(f"`{x}` {k}" for x, k in zip(names, kinds, strict=True)))
    schema = T.StructType([*found.schema.fields, *more.fields])
    for number in range(parts):
        mine = windows.filter(F.pmod(F.xxhash64("gram", "item"), F.lit(parts)) == number)
        shared = docs.sparkSession.sparkContext.broadcast(WindowSet(mine.toArrow()))
        if number:
            found = stored(found, "overlaps")

        def scan(batches, shared=shared, first=number == 0):
            for out in _scan(batches, shared, at, first):
                yield out.rename_columns([*own, *names])

        found = found.mapInArrow(scan, schema)
    return found


def hit_words(spans: str) -> Column:
    """How many words the spans of a text hold."""
    counts = F.transform(spans, lambda s: s["end_word"] - s["first_word"])
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)


def _without(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(text_at).to_pylist()
        for i, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            if spans:
                raw, kept, at = texts[i].encode(), [], 0
                for span in spans:
                    kept.append(raw[at : span["first_byte"]])
                    at = span["end_byte"]
                texts[i] = b"".join([*kept, raw[at:]]).decode()
        columns = batch.columns[:-1]
        columns[text_at] = pa.array(texts, batch.schema.field(text_at).type)
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    drop_share: float | None = None,
    text_col: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without what its texts share with ``benchmark``; columns unchanged.

    Documents of which more than ``drop_share`` of the words are hit go; None
    keeps all, 0 drops every one that is hit. Of those that stay, hit spans
    are cut out of the text, from the first byte of the first word to the last
    of the last. Odd rows as in ``find_overlaps``, whose ``options`` it takes.
    """
    free = "_" * max((len(c) for c in docs.columns), default=0)
    names = (f"words{free}", f"spans{free}", f"items{free}")
    found = find_overlaps(docs, benchmark, text_col, names=names, **options)
    if drop_share is not None:
        found = found.filter(hit_words(names[1]) <= F.lit(drop_share) * F.col(names[0]))
    at = docs.columns.index(text_col)
    return found.select(*docs.columns, names[1]).mapInArrow(lambda batches: _without(batches, at), docs.schema)
