"""Exact, near and line de-duplication against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import line_dedup, near_dedup
from tripflow.llm.components import connected_components
from tripflow.llm.exact_dedup import exact_dedup, keep_first_texts
from tripflow.llm.line_dedup import line_report, similar_lines, without_repeated_lines
from tripflow.llm.near_dedup import forest, keep_one_of_each, near_duplicates, signatures

WHITE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 62  # a null id comes last


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[WHITE.sub("", text or "")].append((-len(text or ""), LAST if doc_id is None else doc_id))
    out = Counter()
    for normal, members in groups.items():
        best = min(members)[1]
        for _, doc_id in members:
            digest = hashlib.sha256(normal.encode()).hexdigest()
            out[(doc_id, best, len(members), digest)] += 1
    return out


def exact_found(df):
    plain = lambda x: LAST if x is None else x
    return Counter(
        (plain(r.doc_id), plain(r.keep_id), r.group_size, r.text_sha256) for r in df.collect()
    )


@pytest.mark.parametrize("block_bytes, weak", [(4096, False), (16, True)])
def test_exact_dedup_equals_brute_force(odd, block_bytes, weak):
    """Also with blocks so small that names take many levels, and a hash that collides."""
    hashed = (lambda b: F.xxhash64(b) % F.lit(5)) if weak else F.xxhash64
    rows = odd if block_bytes > 16 else odd.filter("coalesce(length(text), 0) < 1000")
    found = exact_dedup(rows, block_bytes=block_bytes, hashed=hashed).cache()
    expected = [(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()]
    assert exact_found(found) == exact_by_hand(expected)
    kept = found.filter("kept").groupBy("text_sha256").count().collect()
    assert len(kept) == found.select("text_sha256").distinct().count()
    assert all(r["count"] == 1 for r in kept)
    found.unpersist()


def test_exact_dedup_keeps_columns_and_empty_tables(odd, empty):
    assert exact_dedup(empty).count() == 0
    kept = keep_first_texts(odd)
    assert kept.columns == odd.columns
    normal = {WHITE.sub("", r.text or "") for r in odd.collect()}
    assert kept.count() == len(normal)


def shingles(text, n=5):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = WORD.findall(lower)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near_by_hand(sets, percent=85):
    """Smallest index reachable from each, all pairs compared."""
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= percent * len(a | sets[j]):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(sets))]


def test_near_duplicates_equal_brute_force(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    sets = [shingles(r.text) for r in rows]
    component = near_by_hand(sets)
    ids = defaultdict(list)
    for r, c in zip(rows, component, strict=True):
        ids[c].append(LAST if r.doc_id is None else r.doc_id)
    expected = Counter(
        (LAST if r.doc_id is None else r.doc_id, len(s), min(ids[c]))
        for r, s, c in zip(rows, sets, component, strict=True)
    )
    plain = lambda x: LAST if x is None else x
    found = near_duplicates(odd).collect()
    assert Counter((plain(r.doc_id), r.n_shingles, plain(r.component_id)) for r in found) == expected
    assert sum(r.kept for r in found) == len(set(component))
    assert near_duplicates(empty).count() == 0
    kept = keep_one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(component))


def test_large_groups_of_near_copies_in_blocks(spark, tmp_path, monkeypatch):
    """Copies with random changes: links that only some pairs have, in one cluster and in blocks."""
    draw = np.random.default_rng(5)
    base = [f"word{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        words = list(base)
        for at in draw.integers(0, len(words), draw.integers(0, 5)):
            words[at] = f"new{draw.integers(0, 1000)}"
        texts.append(" ".join(words))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    expected = dict(enumerate(near_by_hand([shingles(t) for t in texts])))
    for documents in (4096, 40, 7):
        monkeypatch.setattr(near_dedup, "BLOCK_DOCUMENTS", documents)
        assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == expected


def test_forest_connects_what_all_pairs_connect():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 40, draw.integers(1, 60)).astype(np.uint64)) for _ in range(120)]
    links = forest(np.arange(120), sets, 85)
    parent = list(range(120))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = top(a), top(b)
        assert x != y  # a forest
        parent[max(x, y)] = min(x, y)
    assert [top(i) for i in range(120)] == near_by_hand([set(s.tolist()) for s in sets])


def test_forest_leaves_out_what_is_connected_already():
    draw = np.random.default_rng(2)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.delete(base, draw.integers(0, 100, 2)) for _ in range(30)]
    parts = np.array([1] * 20 + [2] * 9 + [3])
    links = forest(np.arange(30), sets, 85, parts)
    assert len(links) == 2 and {frozenset(parts[list(x)]) for x in links} <= {
        frozenset(x) for x in ((1, 2), (1, 3), (2, 3))
    }
    assert forest(np.arange(30), sets, 85, np.zeros(30, int)) == []


def test_a_connected_large_group_is_not_met_in_blocks(spark, tmp_path, monkeypatch):
    """Documents that one centre links take no task of their own for each pair of blocks."""
    words = [f"word{i}" for i in range(200)]
    texts = [" ".join([*words, f"end{i}"]) for i in range(300)] + ["some other text of seven words"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    monkeypatch.setattr(near_dedup, "BLOCK_DOCUMENTS", 10)
    tables, store = {}, near_dedup.stored
    monkeypatch.setattr(
        near_dedup, "stored", lambda df, label: tables.setdefault(label, store(df, label))
    )
    found = near_duplicates(spark.read.parquet(f"{tmp_path}/d")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: 0 for i in range(300)} | {300: 300}
    assert [r.rest for r in tables["near-layout"].collect()] == [0]
    assert tables["near-links"].count() == tables["near-star-links"].count() == 299


def test_signatures_estimate_the_similarity():
    draw = np.random.default_rng(2)
    functions = near_dedup._functions(400, 3)
    whole = draw.integers(0, 2**63, 3000).astype(np.uint64)
    both = signatures(np.concatenate([whole[:2000], whole[1000:]]), np.array([0, 2000, 4000]), functions)
    share = (both[0] == both[1]).mean()
    assert abs(share - 1000 / 3000) < 0.06


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(20, 60)] + [(1, 1), (3, 2)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {
        **dict.fromkeys(range(100, 141), 100), **dict.fromkeys([7, *range(20, 60)], 7), 2: 2, 3: 2,
    }
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def lines_by_hand(rows, percent=80):
    order = sorted(
        (LAST if d is None else d, i, n, line)
        for i, (d, text) in enumerate(rows)
        for n, line in enumerate((text or "").split("\n"))
    )
    sets = [frozenset(WORD.findall(line)) for *_, line in order]
    distinct = list(dict.fromkeys(s for s in sets if s))
    similar = {
        s: [t for t in distinct if t != s and 100 * len(s & t) >= percent * len(s | t)] for s in distinct
    }
    seen, out = set(), {}
    for (_, row, n, _), s in zip(order, sets, strict=True):
        gone = bool(s) and (s in seen or any(t in seen for t in similar[s]))
        out[row, n] = (len(s), len(similar.get(s, [])), gone)
        seen.add(s)
    return out


def test_similar_lines_equal_brute_force(odd, empty, spark, tmp_path):
    draw = np.random.default_rng(3)
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(4):
            words = [f"v{i}" for i in draw.integers(0, 25, draw.integers(0, 14))]
            lines.append(" ".join(words))
        texts.append("\n".join(lines))
    texts += ["\n".join(t.split("\n")[::-1]) + " v1" for t in texts[:20]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(
        f"{tmp_path}/lines"
    )
    for docs in (odd, spark.read.parquet(f"{tmp_path}/lines")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = {
            (r.row, r.line_no): (r.n_words, r.links, r.removed) for r in similar_lines(docs).collect()
        }
        assert got == lines_by_hand(rows)
    assert line_report(empty).count() == 0


def test_lines_are_taken_out_of_the_texts(odd):
    out = {r.doc_id: r.text for r in without_repeated_lines(odd).collect() if r.doc_id}
    assert out[1] == "same text\nhere and there" or out[1] == ""  # one of the repeated rows keeps it
    assert out[15] == "a\n\nb a" and out[4] is None
    assert without_repeated_lines(odd).columns == odd.columns


def test_a_template_of_many_similar_lines(spark, tmp_path):
    """2,000 lines that differ in one word of twenty are all similar to each other; none is lost.

    Beside them lines of all lengths with some words changed, near the threshold.
    """
    draw = np.random.default_rng(8)
    stem = [f"t{i}" for i in range(19)]
    texts = ["\n".join(" ".join([*stem[:7], f"x{i}", *stem[7:]]) for i in range(k, k + 100)) for k in range(0, 2000, 100)]
    path = f"{tmp_path}/template"
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4).write.parquet(path)
    found = similar_lines(spark.read.parquet(path)).collect()
    assert {r.links for r in found} == {1999} and sum(not r.removed for r in found) == 1
    assert not next(r.removed for r in found if (r.doc_id, r.line_no) == (0, 0))

    texts = []
    for i in range(40):
        n = int(draw.integers(1, 400))
        base = [f"w{x}" for x in draw.integers(0, 3000, n)]
        lines = []
        for _ in range(4):
            own = list(base)
            for at in draw.integers(0, n, int(n * draw.uniform(0, 0.25))):
                own[at] = f"w{draw.integers(0, 3000)}"
            lines.append(" ".join(own[: max(1, int(n * draw.uniform(0.78, 1)))]))
        texts.append("\n".join(lines))
    path = f"{tmp_path}/near"
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {(r.row, r.line_no): (r.n_words, r.links, r.removed) for r in similar_lines(docs).collect()}
    assert got == lines_by_hand(rows)
    assert 30 < sum(r[1] > 0 for r in got.values()) < len(got)


def test_similar_lines_of_a_template_make_no_pairs(spark, tmp_path, monkeypatch):
    """Links of a large group are counted in blocks, not as rows; of different groups as pairs."""
    stem = [f"t{i}" for i in range(19)]
    lines = [" ".join([*stem[: i % 19], f"x{i}", *stem[i % 19 :]]) for i in range(300)]
    lines += [" ".join([f"u{i}" for i in range(10) if i != k]) for k in range(3)] + ["v1 v2 v3 v4 v5", "v1 v2 v3 v4"]
    rows = [(i, "\n".join(lines[i::20])) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    docs, expected = spark.read.parquet(f"{tmp_path}/d"), lines_by_hand(rows)
    tables, store = {}, line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, label: tables.setdefault(label, store(df, label)))
    for block, groups in ((128, 16), (40, 2), (7, 3)):
        monkeypatch.setattr(line_dedup, "BLOCK_LINES", block)
        monkeypatch.setattr(line_dedup, "GROUP_BLOCKS", groups)
        tables.clear()
        found = similar_lines(docs).collect()
        assert {(r.row, r.line_no): (r.n_words, r.links, r.removed) for r in found} == expected
        assert tables["line-pairs"].count() <= 4  # 44,850 pairs of lines of the template
    assert max(links for _, links, _ in expected.values()) == 299
    # Without families every link is found as a pair: they bear on no result.
    alone = lambda live: live.select("id", F.col("id").alias("family")).limit(0)
    monkeypatch.setattr(line_dedup, "_families", alone)
    tables.clear()
    found = similar_lines(docs).collect()
    assert {(r.row, r.line_no): (r.n_words, r.links, r.removed) for r in found} == expected
    assert tables["line-pairs"].count() >= 44_850


def test_lines_of_large_families_meet_as_forms(spark, tmp_path, monkeypatch):
    """Edited copies of one line equal brute force; a template's lines, alike but for one word, are one form."""
    draw = np.random.default_rng(5)
    base, lines = [f"b{i}" for i in range(60)], []
    for i in range(90):
        own = [w for w in base if draw.random() > 0.06] + [f"e{x}" for x in draw.integers(0, 30, draw.integers(0, 5))]
        lines.append(("\t" if i % 7 == 0 else "  ").join(own))
    lines += [" ".join([*stem, f"{end}{i}"]) for i in range(40) for stem, end in ((base[:19], "x"), (base[20:28], "y"))]
    lines += ["", "\t", " a  b \r c", "a b c"]
    rows = [(i, "\n".join(lines[i::20])) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    docs, expected = spark.read.parquet(f"{tmp_path}/d"), lines_by_hand(rows)
    tables, store = {}, line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, label: tables.setdefault(label, store(df, label)))
    for few, bits, block, groups in ((2, 4, 128, 16), (2, 1, 7, 3)):
        for name, value in zip(("FEW_LINES", "SHARED_BITS", "BLOCK_LINES", "GROUP_BLOCKS"), (few, bits, block, groups), strict=True):
            monkeypatch.setattr(line_dedup, name, value)
        tables.clear()
        found = similar_lines(docs).collect()
        assert {(r.row, r.line_no): (r.n_words, r.links, r.removed) for r in found} == expected
        forms = tables["line-family-forms"]
        # The lines x: with the word left out that only one of them has they are the same.
        assert [r.lines for r in forms.filter("n = 20").collect()] == [40]
