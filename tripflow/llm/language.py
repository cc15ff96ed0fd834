"""Language identification by unigram pieces, summed over all segmentations.

A language is a probability for each piece of a fixed public vocabulary. The
probability of a word is the sum over all ways to segment it into pieces, which
the forward algorithm gives in one pass; a text's is the product over its
words. Probabilities are fitted by expectation maximisation: the expected count
of each piece over all segmentations of the training words.

Words are runs of letters in lower case, with the vocabulary's word mark before
them. Runs of over 40 letters are taken in parts of 40, which keeps every
probability within a double; nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.batches import large_text, slices
from tripflow.llm.common import stored

FIT_DOCUMENTS = 3000  # expected number of training documents per language
ROUNDS = 3
MARK = "▁"  # word mark of the vocabulary
PART = 40
FLOOR = 1e-7
SMOOTHING = 0.05
UNKNOWN = "und"
CACHE_WORDS = 200_000  # bounds a task's memory only
_BASE = 0x100000001B3


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model, without its control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [
        model.id_to_piece(i)
        for i in ids
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
    ]


class Pieces:
    """Finds which substrings of words are pieces, for many words at once."""

    def __init__(self, pieces: list[str]):
        # Only these can occur: lower case, letters after an optional mark.
        self.pieces = [
            p for p in pieces if p.removeprefix(MARK).isalpha() and p == p.lower() or p == MARK
        ]
        self.longest = max(map(len, self.pieces))
        self.powers = np.ones(PART + 2, np.uint64)
        for i in range(1, len(self.powers)):
            self.powers[i] = (int(self.powers[i - 1]) * _BASE) % (1 << 64)
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order

    def __len__(self):
        """One more than there are pieces: the last stands for an unknown letter."""
        return len(self.pieces) + 1

    @staticmethod
    def _hash(text: str) -> int:
        value = 0
        for c in text:
            value = (value * _BASE + ord(c) + 1) % (1 << 64)
        return value

    def lattice(self, words: list[str]) -> list[list[tuple[int, np.ndarray]]]:
        """For words of one length: for each end, (length, piece id or -1 per word)."""
        n = len(words[0]) + 1
        codes = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), np.uint32)
        codes = codes.reshape(len(words), n).astype(np.uint64) + np.uint64(1)
        prefix = np.zeros((n + 1, len(words)), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                prefix[j + 1] = prefix[j] * np.uint64(_BASE) + codes[:, j]
            ends = []
            for j in range(1, n + 1):
                found = []
                for k in range(1, min(j, self.longest) + 1):
                    value = prefix[j] - prefix[j - k] * self.powers[k]
                    at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
                    ids = np.where(self.hashes[at] == value, self.ids[at], -1)
                    if k == 1:
                        ids[ids < 0] = len(self.pieces)
                    if (ids >= 0).any():
                        found.append((k, ids))
                ends.append(found)
        return ends


def by_length(words: list[str], most: int = 5_000) -> Iterator[np.ndarray]:
    """Indexes of words of one length, some thousands at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for same in np.split(order, cuts):
        for i in range(0, len(same), most):
            yield same[i : i + most]


def forward(lattice, chances: np.ndarray) -> list[np.ndarray]:
    """Probability of each prefix. ``chances`` has a row per piece and a last row of zeros."""
    first = lattice[0][0][1]
    alpha = [np.ones((len(first), chances.shape[1]))]
    for j, found in enumerate(lattice, 1):
        alpha.append(sum(alpha[j - k] * chances[ids] for k, ids in found))
    return alpha


def expected_counts(pieces: Pieces, words, langs, counts, chances: np.ndarray) -> np.ndarray:
    """Expected count of each piece by language over all segmentations."""
    out = np.zeros((len(pieces) + 1, chances.shape[1]))
    for at in by_length(words):
        lattice = pieces.lattice([words[i] for i in at])
        lang, n = langs[at], len(lattice)
        chance = lambda ids: chances[ids, lang]  # noqa: E731, B023
        alpha = [np.ones(len(at))]
        for j, found in enumerate(lattice, 1):
            alpha.append(sum(alpha[j - k] * chance(ids) for k, ids in found))
        beta = [np.zeros(len(at)) for _ in range(n)] + [np.ones(len(at))]
        for j in range(n, 0, -1):
            for k, ids in lattice[j - 1]:
                beta[j - k] += chance(ids) * beta[j]
        weight = counts[at] / alpha[n]
        for j, found in enumerate(lattice, 1):
            for k, ids in found:
                np.add.at(out, (ids, lang), alpha[j - k] * chance(ids) * beta[j] * weight)
    return out[:-1]


@dataclass
class Model:
    """Languages and, for each piece, its probability in each of them."""

    languages: list[str]
    chances: np.ndarray
    pieces: list[str] = field(repr=False)


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Start of each text among its words, the different words, and each word's index."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\pL]+")
    ends = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return ends - ends[0], coded.dictionary.to_pylist(), coded.indices.to_numpy()


def _parts(word: str) -> list[str]:
    return [word[i : i + PART] for i in range(0, len(word), PART)]


def held_out(id_col: Column) -> Column:
    """The quarter of documents that is never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for start, part in _numbered(slices(batch, 1)):
            starts, words, index = words_of(large_text(part.column(1)))
            own = np.repeat(lang[start : start + part.num_rows], np.diff(starts))
            key, count = np.unique(own * len(words) + index, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[k // len(words)] for k in key], pa.string()),
                    pa.array([words[k % len(words)] for k in key], pa.string()),
                    pa.array(count, pa.int64()),
                ],
                names=["lang", "word", "n"],
            )


def _numbered(parts):
    start = 0
    for part in parts:
        yield start, part
        start += part.num_rows


def fit(
    docs: DataFrame,
    pieces: list[str],
    fit_documents: int = FIT_DOCUMENTS,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Fit on a sample of labelled documents that are not held out.

    ``fit_documents`` is the expected number per language; documents are
    picked by a hash of text and id, so copies of a text are drawn one by one.
    What reaches the driver is one number for each piece and language, however
    large the corpus.
    """
    labelled = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    # One number per language, as many as the model has columns. A join on the
    # language instead would put all texts of one in a task.
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    known = Pieces(pieces)
    share = F.lit(0.0)
    for lang, documents in sizes.items():
        share = F.when(F.col("lang") == lang, float(fit_documents) / documents).otherwise(share)
    drawn = F.pmod(F.xxhash64("text", "id"), F.lit(1 << 30)) < share * (1 << 30)
    sample = labelled.filter(drawn).select("lang", "text")
    counts = sample.mapInArrow(_word_counts, "lang string, word string, n long")
    counts = counts.filter("word <> ''").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "language-words")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((len(known) + 1, 0)), pieces)

    # At first a piece counts by its length, so that long ones are preferred.
    first = np.array([*(2.0 ** len(p) for p in known.pieces), 1.0])
    chances = _smoothed(np.repeat(first[:, None], len(languages), axis=1))
    for _ in range(rounds):
        chances = _smoothed(_expected(counts, pieces, languages, chances))
    return Model(languages, chances, pieces)


def _smoothed(counts: np.ndarray) -> np.ndarray:
    counts = counts + SMOOTHING
    chances = np.maximum(counts / counts.sum(axis=0), FLOOR)
    return np.vstack([chances, np.zeros(counts.shape[1])])


def _expected(counts: DataFrame, pieces, languages: list[str], chances: np.ndarray) -> np.ndarray:
    shared = counts.sparkSession.sparkContext.broadcast((pieces, languages, chances))

    def step(batches):
        pieces, languages, chances = shared.value
        known, place = Pieces(pieces), {x: i for i, x in enumerate(languages)}
        total = np.zeros((len(known), len(languages)))
        for batch in batches:
            words, langs, n = [], [], []
            for lang, word, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part in _parts(word):
                    words.append(part)
                    langs.append(place[lang])
                    n.append(count)
            total += expected_counts(known, words, np.array(langs), np.array(n, float), chances)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece), pa.array(lang), pa.array(total[piece, lang])],
            names=["piece", "lang", "n"],
        )

    sums = counts.select("lang", "word", "n").mapInArrow(step, "piece long, lang long, n double")
    rows = sums.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((len(chances) - 1, len(languages)))
    out[rows["piece"].to_numpy(int), rows["lang"].to_numpy(int)] = rows["n"].to_numpy()
    shared.unpersist()
    return out


class Scorer:
    """Log probabilities of words by language, kept between batches of a task."""

    def __init__(self, model: Model):
        self.known, self.chances = Pieces(model.pieces), model.chances
        self._clear()

    def _clear(self):
        self.index: dict[str, int] = {"": 0}
        self.table = np.zeros((1 << 12, self.chances.shape[1]))

    def _add(self, words: list[str]) -> None:
        owners, parts = [], []
        start = len(self.index)
        while start + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for i, word in enumerate(words):
            self.index[word] = start + i
            for part in _parts(word):
                owners.append(start + i)
                parts.append(part)
        owner = np.array(owners)
        for at in by_length(parts):
            lattice = self.known.lattice([parts[i] for i in at])
            np.add.at(self.table, owner[at], np.log(forward(lattice, self.chances)[-1]))

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text by language, and how many words it has."""
        starts, words, index = words_of(texts)
        if len(self.index) > CACHE_WORDS:
            self._clear()
        missing = [w for w in words if w not in self.index]
        if missing:
            self._add(missing)
        place = np.fromiter((self.index[w] for w in words), np.int64, len(words))
        each = place[index] if len(words) else np.empty(0, np.int64)
        sums = np.vstack([np.zeros(self.table.shape[1]), np.cumsum(self.table[each], axis=0)])
        letters = np.concatenate([[0], np.cumsum(each > 0)])
        return sums[starts[1:]] - sums[starts[:-1]], np.diff(letters[starts])


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` in a struct ``kept``, with lang_pred and score.

    The score is the posterior probability of the predicted language with equal
    priors. A text that is null or has no letter is ``und`` with score 0. Only
    the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        scorer = Scorer(model) if model.languages else None
        for batch in batches:
            for part in slices(batch, 1):
                best = np.zeros(part.num_rows, np.int64)
                score = np.zeros(part.num_rows)
                some = np.zeros(part.num_rows, bool)
                if scorer:
                    logs, words = scorer.texts(large_text(part.column(1)))
                    best, some = logs.argmax(axis=1), words > 0
                    against = np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    score = np.where(some, 1 / against, 0.0)
                names = [model.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score)],
                    names=["kept", "lang_pred", "score"],
                )

    kept = F.struct(*keep).alias("kept")
    rows = docs.select(kept, F.col(text_col).alias("text"))
    schema = rows.select("kept").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def identify(
    docs: DataFrame,
    vocabulary_path: str,
    fit_documents: int = FIT_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Language of every text: doc_id, held_out, lang_pred, score.

    Null labels teach nothing and null texts are ``und``; without any label all
    texts are. Repeated rows are predicted each; extra columns are ignored.
    """
    model = fit(
        docs, vocabulary(vocabulary_path), fit_documents,
        id_col=id_col, text_col=text_col, lang_col=lang_col,
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    found = predict(rows, model, ["doc_id", "held_out"])
    return found.select("kept.*", "lang_pred", "score")


def keep_identified(
    docs: DataFrame,
    vocabulary_path: str,
    least_score: float = 0.5,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without texts that have no letter or that no language claims clearly."""
    model = fit(docs, vocabulary(vocabulary_path), text_col=text_col)
    found = predict(docs, model, docs.columns, text_col)
    clear = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
    return found.filter(clear).select("kept.*")
