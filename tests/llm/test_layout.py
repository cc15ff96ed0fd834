"""Sharding, mixing and packing."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import packing
from tripflow.llm.common import global_index, running_total
from tripflow.llm.mixing import Mix, mix, shard_counts, source_targets
from tripflow.llm.packing import Capacities, WordTokens, best_fit, pack, pack_documents
from tripflow.llm.sharding import permute, round_keys, shard_rows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_permutation_of_any_size():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        assert sorted(permute(np.arange(n), n, round_keys(3))) == list(range(n))
    mixed = permute(np.arange(1000), 1000, round_keys(3))
    assert (mixed == permute(np.arange(1000), 1000, round_keys(4))).mean() < 0.05
    part = permute(np.array([17, 5]), 1000, round_keys(3))
    assert part.tolist() == [mixed[17], mixed[5]]  # computable without the other rows


def test_shards_of_odd_rows(odd, empty):
    found = shard_rows(odd, shards=4).collect()
    n = odd.count()
    assert sorted(r.row_number for r in found) == list(range(n))
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    texts = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id is not None}
    for r in found:
        if r.doc_id is not None:
            raw = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    again = {(r.doc_id, r.shard, r.slot, r.text_crc32) for r in shard_rows(odd.repartition(3), 4).collect()}
    assert again == {(r.doc_id, r.shard, r.slot, r.text_crc32) for r in found}
    assert shard_rows(empty).count() == 0


def test_index_and_running_total_over_many_partitions(spark):
    df = spark.range(0, 500, 1, 7).selectExpr("(id * 37) % 101 AS a", "id AS b", "id % 5 AS v")
    got = {(r.a, r.b): r.n for r in global_index(df, ["a", "b"], "n").collect()}
    keys = sorted(got)
    assert [got[k] for k in keys] == list(range(500))
    sums = {(r.a, r.b): (r.v, r.s) for r in running_total(df, ["a", "b"], "v", "s").collect()}
    total = 0
    for k in keys:
        assert sums[k][1] == total
        total += sums[k][0]


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = goal - sum(limit * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * level >= limit * sizes[s]}
        if not above:
            return {s: limit * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= above


def test_targets_are_shared_until_none_is_above(spark):
    sizes = {"b": 10, "a": 1000, "Z": 5, None: 400, "é": 0, "c": 3000, "cc": 70}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(df).collect()}
    expected = targets_by_hand(sizes)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[s], expected[s], abs_tol=1e-9) for s in found)
    assert math.isclose(sum(found.values()), 1.5 * sum(sizes.values()))


def check_mix(docs, tolerance, **options):
    made = Mix(docs, **options)
    found = made.taken().collect()
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    targets = targets_by_hand(sizes)
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter(
        (r.doc_id, len(WORD.findall(r.text or ""))) for r in rows
    )
    by_target = defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 2 * r["size"]
        by_target[r.source_size, round(r.target, 6)] += r.taken
    expected = {(sizes[s], round(t, 6)): t for s, t in targets.items()}
    assert by_target.keys() == expected.keys()
    for key, target in expected.items():
        assert abs(by_target[key] - target) <= tolerance
    return made, found


def test_mix_meets_its_targets(documents):
    made, found = check_mix(documents, tolerance=4 * 32, block_words=32, shard_blocks=500)
    again = mix(documents, block_words=32, shard_blocks=500).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again))
    assert max(r.times for r in made.slots.groupBy("place", "block").count().toDF("p", "b", "times").collect()) <= 2
    words = defaultdict(list)
    for r in made.texts().collect():
        words[r.doc_id] += WORD.findall(r.text)
    assert {i: len(w) for i, w in words.items()} == {r.doc_id: r.taken for r in found if r.taken}
    texts = {r.doc_id: Counter(WORD.findall(r.text)) for r in documents.collect()}
    assert all(not Counter(w) - (texts[i] + texts[i]) for i, w in words.items())


def test_mix_of_odd_rows(odd, empty):
    made, _ = check_mix(odd, tolerance=3 * 8, block_words=8)
    assert made.texts().columns == odd.columns
    assert mix(empty).count() == 0 and Mix(empty).texts().count() == 0


def test_shard_counts_fill_every_shard(spark):
    wanted = {i: w for i, w in enumerate([100.5, 0.25, 0.0, 33.3, 7.9, 1.05])}
    df = spark.createDataFrame([(i, 10**6, w) for i, w in wanted.items()], "place long, blocks long, wanted double")
    rows = shard_counts(df, shard_blocks=10, seed=1).collect()
    by_shard, by_place = Counter(), Counter()
    for r in rows:
        by_shard[r.shard] += r["count"]
        by_place[r.place] += r["count"]
    assert len(set(by_shard.values())) == 1 and len(by_shard) == 15
    assert all(abs(by_place[i] - w) < 12 for i, w in wanted.items())


def test_tokens_of_words_are_those_of_the_text(monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    texts = [
        "Plain text, isn't it?  we'll see\tIT'S \n\n fine", "<|endoftext|> in <|startoftext|>text",
        "é é ½ 漢字　かな 😀👍🏽 İstanbul ΣΑΣ x y", "", None, "   ", "a\x1cb \x85c", "x" * 3000,
        "́ alone ̈", "don't'S re've", "1234 5.6e7",
    ]
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    tokens = WordTokens(TOKENIZER)
    for part in (texts, texts[::-1], texts[:3]):
        ids, starts = tokens.documents(pa.array(part, pa.string()))
        for i, text in enumerate(part):
            expected = whole.encode(text or "", add_special_tokens=False).ids
            assert ids[starts[i] : starts[i + 1]].tolist() == expected


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_respects_every_capacity(rule):
    draw = np.random.default_rng(0)
    lengths = np.sort(draw.integers(1, 60, 400))[::-1]
    room = Capacities(100, 3, 4000, (1.0, 0.5, 0.5), rule)
    bins, offsets = best_fit(lengths, room)
    for b in set(bins.tolist()):
        own = lengths[bins == b]
        assert own.sum() <= 100 and len(own) <= 3 and (own * own).sum() <= 4000
        starts = np.sort(offsets[bins == b])
        assert starts[0] == 0 and len(set(starts)) == len(own)
    tokens_only, _ = best_fit(lengths, Capacities(100, 10**6, 10**9))
    assert tokens_only.max() + 1 <= 1.02 * lengths.sum() / 100 + 1


def test_packing_of_odd_rows(odd, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    found = pack_documents(odd, TOKENIZER).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    expected = Counter()
    for r in odd.select("doc_id", "text").collect():
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            cut = np.array(ids[start : start + 4096], "<u4")
            expected[r.doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert got == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
        assert sum(n for _, n in own) <= 4096
    assert len(sequences) <= -(-sum(r.length for r in found) // 4096) + 1
    assert pack_documents(empty, TOKENIZER).count() == 0


def test_groups_of_pieces_and_pieces_too_large(spark, tmp_path):
    rows = [(i, i, 0, 0, 1 + i % 50, 0) for i in range(300)]
    schema = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/p")
    pieces = spark.read.parquet(f"{tmp_path}/p")
    packed = pack(pieces, Capacities(64, 4, 64 * 64), group_pieces=50)
    by_sequence = packed.groupBy("sequence_id").agg(F.sum("length").alias("t"), F.count("*").alias("d"))
    assert by_sequence.filter("t > 64 OR d > 4").count() == 0 and packed.count() == 300
    with pytest.raises(ValueError, match="capacities"):
        pack(pieces, Capacities(40))
