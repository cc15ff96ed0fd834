"""Token groups and links against whole texts, tokenised one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tripflow.llm import align_tokens as M
from tripflow.llm.queries import op13_align_tokens

PATHS = tuple(public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ALPHABET = [*"ab .,'\n\t 0", "  ", "é", "漢", "😀", " ", "▁", "\x00", "\x1c", "<s>", "<0x41>",
            "<|endoftext|>", " the", "ing", "\r\n", "​", "\x7f", "　", "\x85", "'s", " 12",
            "ﬁ", "﻿", "é", "᠎", " "]


def groups(text):
    """Groups between the offsets where tokens of both end; None without tokens."""
    if not text:
        return None
    a, b = M._tokenizers(*PATHS)
    ids = a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    whole, out = (" " + text).encode(), None
    ends = []
    for own, t in zip(ids, (a, b), strict=True):
        if b"".join(t.bytes[i] for i in own) != whole:
            return None
        ends.append(np.cumsum([len(t.bytes[i]) for i in own]).tolist())
    out, at = [], [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        sides = []
        for k in (0, 1):
            upto = ends[k].index(cut, at[k]) + 1
            sides.append(ids[k][at[k] : upto])
            at[k] = upto
        out.append(sides)
    return out


def brute(texts):
    """One tuple of results per text."""
    all_groups = [groups(t) or [] for t in texts]
    links = [Counter((x, y) for a, b in own for x in a for y in b) for own in all_groups]
    count = Counter(pair for own in links for pair in own)
    highest = Counter()
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for own, linked in zip(all_groups, links, strict=True):
        written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in own)
        out.append((
            sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), linked.total(),
            sum(n for p, n in linked.items() if count[p] == highest[p[0]]),
            sum(n * count[p] for p, n in linked.items()),
            hashlib.sha256(written.encode()).hexdigest() if own else "",
        ))
    return out


def results(df):
    return [
        (r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256))
        for r in df.collect()
    ]


def strange_texts():
    random.seed(1)
    return ["".join(random.choices(ALPHABET, k=random.randint(0, 30))) for _ in range(3000)]


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks and calls of some hundred characters; workers get them with the functions."""
    whole = M._blocks

    def blocks(batches, path_a, path_b):
        M.BLOCK_BYTES, M.CALL_CHARACTERS = 500, 90
        yield from whole(batches, path_a, path_b)

    monkeypatch.setattr(M, "_blocks", blocks)


def test_query_against_brute_force(spark, sf, documents):
    rows = documents.select("doc_id", "text").collect()
    expected = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows]), strict=True))
    assert dict(results(op13_align_tokens(spark, sf))) == expected


def test_strange_texts_in_small_blocks(spark, small_blocks):
    texts = strange_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    expected = brute(texts)
    assert sum(not e[0] for e in expected) > 100  # not reversible
    assert dict(results(M.align_tokenizers(docs, *PATHS))) == dict(enumerate(expected))


def test_odd_rows(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    expected = zip([r.doc_id for r in rows], brute([r.text for r in rows]), strict=True)
    found = results(M.align_tokenizers(odd, *PATHS))
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_empty_table(spark, empty):
    assert M.align_tokenizers(empty, *PATHS).count() == 0
    assert M.token_groups(empty, *PATHS).count() == 0


def test_groups_of_documents(spark, odd):
    small = odd.filter("text IS NULL OR length(text) < 1000")
    rows = small.select("doc_id", "text").collect()
    found = [(r.doc_id, [[list(g.a), list(g.b)] for g in r.groups]) for r in M.token_groups(small, *PATHS).collect()]
    expected = [(r.doc_id, groups(r.text) or []) for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_intervals_that_overlap_are_one_group():
    a, b = np.array([0, 3, 6, 9]), np.array([0, 2, 6, 7])
    group_a, group_b, n = M.coalesce(a, np.array([3, 6, 9, 12]), b, np.array([2, 6, 7, 12]))
    assert (group_a.tolist(), group_b.tolist(), n) == ([0, 0, 1, 1], [0, 0, 1, 1], 2)
    nothing = np.empty(0, np.int64)
    assert M.coalesce(nothing, nothing, nothing, nothing)[2] == 0
