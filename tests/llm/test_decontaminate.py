"""Decontamination against a plain search, in one part and in several."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import decontaminate as M

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, size):
    """Hit words and items: each window of each item at every place of the text."""
    own, hit, named = words(text), set(), set()
    for item, other in items:
        theirs = words(other)
        m = min(size, len(theirs))
        grams = {tuple(theirs[i : i + m]) for i in range(len(theirs) - m + 1)} if m else set()
        for i in range(len(own) - m + 1):
            if m and tuple(own[i : i + m]) in grams:
                hit.update(range(i, i + m))
                named |= {str(item)} if item is not None else set()
    return len(own), hit, sorted(named)


def check(docs, items, size=10, **options):
    bench = docs.sparkSession.createDataFrame(items, "item_id long, text string, spans string")
    texts = docs.select("doc_id", "text").collect()
    found = M.find_overlaps(docs, bench, size=size, **options).collect()
    assert len(found) == len(texts)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    found = [(r.doc_id, r.text, r.n_words, r.spans, r["items"]) for r in found]
    for got, (_, text) in zip(sorted(found, key=key), sorted(texts, key=key), strict=True):
        n, hit, named = brute(text, [i[:2] for i in items], size)
        assert got[2] == n and got[4] == named
        assert {w for s in got[3] for w in range(s.first_word, s.end_word)} == hit
        raw = (text or "").encode()
        for s in got[3]:
            own = words(raw[s.first_byte : s.end_byte].decode())
            assert own == words(text)[s.first_word : s.end_word]
        ends = [(s.first_word, s.end_word) for s in got[3]]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))
    return found


def few_words(spark, seed, n):
    """Texts over few words, so that windows overlap, repeat and nearly match."""
    draw = np.random.default_rng(seed)
    signs = np.array([" ", ", ", "\n", "--", " \x00", "\x7f", ".  "])
    rows = []
    for i in range(n):
        own = draw.choice(["a", "B", "Ä", "ä", "7x", "漢字", "z"], draw.integers(0, 40))
        rows.append((i, "".join(w + s for w, s in zip(own, draw.choice(signs, len(own)), strict=True))))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("part_bytes", [M.PART_BYTES, 400])
def test_against_plain_search(spark, part_bytes):
    items = [(1, "a B a z 7X", None), (2, "Z", None), (3, "ä Ä ä, a", None), (4, "漢字 b", None),
             (5, "a b a z 7x a b", None), (5, "z z z z", None), (None, "b b", None),
             (6, None, None), (7, " .. ", None), (10, "", None)]
    found = check(few_words(spark, 1, 150), items, size=4, part_bytes=part_bytes)
    assert sum(bool(r[3]) for r in found) > 50


def test_odd_rows_and_many_items(spark, odd):
    passage = "the quick brown fox jumps over one lazy dog and then it sleeps"
    items = [(i, passage, "") for i in range(300)] + [(900, "one two three four", "")]
    items += [(901, "straße été", ""), (902, "12", ""), (903, "w5x5 w6x6", ""), (901, "here", "")]
    found = check(odd.filter("length(text) < 1000 OR text IS NULL"), items)
    assert max(len(r[4]) for r in found) == 300
    check(odd, [(1, "w970x55 w971x56 w972x57", "")])


def test_empty_tables(spark, odd, empty):
    bench = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    assert M.find_overlaps(empty, bench).count() == 0
    assert M.find_overlaps(odd, bench.limit(0)).filter("size(spans) > 0").count() == 0
    assert M.decontaminate(odd, bench.limit(0)).count() == odd.count()


def test_windows_of_equal_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(M, "_rolled", lambda x, n: np.zeros(max(len(x) - n + 1, 0), np.uint64))
    import pyarrow as pa

    known = M.WindowSet(pa.table({"item": ["1", "2", "3"], "gram": ["a b", "b c", "a b c"]}))
    found = M.Words(pa.array(["a b c b", None, "b a", "a b"]))
    spans, items = M._found(found, known, 4, [[]] * 4, [[]] * 4)
    assert items == [["1", "2", "3"], [], [], ["1"]]
    assert [[s[:2] for s in x] for x in spans] == [[(0, 3)], [], [], [(0, 2)]]


def test_removal(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before: {passage.upper()}, after É", "s"), (2, passage, None), (3, "clean text", "x"), (4, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    cut = {r.doc_id: r.text for r in M.decontaminate(docs, bench).collect()}
    assert cut == {1: "Before: , after É", 2: "", 3: "clean text", 4: None}
    kept = M.decontaminate(docs, bench, drop_share=0.9)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4}
    assert {r.doc_id for r in M.decontaminate(docs, bench, drop_share=0.0).collect()} == {3, 4}


def test_planted_passages_are_found_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    item = bench.first()
    text = F.concat(F.col("text"), F.lit(f" {item.text} "), F.col("text"))
    planted = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, text).otherwise(F.col("text")))
    found = M.find_overlaps(planted, bench).collect()
    assert all(str(item.item_id) in r["items"] for r in found if r.doc_id % 2 == 0)
