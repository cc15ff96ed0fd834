"""Top-k search and WARC archives."""

import base64
import gzip
import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripflow.llm.topk import top_k
from tripflow.llm.warc import read_archives, resolved_records, write_archives


def top_by_hand(rows, k, every, scale=1024):
    whole = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for q, a in whole:
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), c) for c, b in whole if c != q]
            for rank, (score, c) in enumerate(sorted(scores)[:k], 1):
                out[q, rank, c, -score] += 1
    return out


def test_top_k_equals_brute_force(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [((i * 7919 + j * 31) % 41 - 20) / 64 for j in range(6)]) for i in range(80)]
    rows += [(100, None), (101, [None] * 6), (102, [nan] + [0.0] * 5), (103, [inf] + [0.0] * 5)]
    rows += [(105, [0.0] * 6), (110, [0.5, -0.5]), (120, []), (None, [1.0] * 6), (130, rows[3][1])]
    rows += [(140, [1e6, -1e6, 3e5, 0.0, 0.1, 0.2])]
    schema = "vec_id long, embedding array<double>, rank int, score string"
    spark.createDataFrame([(*r, 1, "x") for r in rows], schema).repartition(3).write.parquet(f"{tmp_path}/v")
    vectors = spark.read.parquet(f"{tmp_path}/v")
    rounds = {"block_bytes": 100, "round_blocks": 2}
    for k, sizes in ((5, {}), (200, {"candidate_block": 16, "query_block": 3}), (7, rounds)):
        found = top_k(vectors, k=k, every=5, **sizes).collect()
        got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
        assert got == top_by_hand(rows, k, 5)
    assert top_k(vectors.filter("false")).count() == 0


def test_scores_past_63_bits_end_at_the_limits(spark, tmp_path):
    rows = [(0, [1e17, 1e17]), (1, [1e17, 1e17]), (2, [-1e17, -1e17]), (3, [1e17, -1e17])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/v")
    found = top_k(spark.read.parquet(f"{tmp_path}/v"), k=3, every=100)
    assert [(r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [
        (1, 2**63 - 1), (3, 0), (2, -(2**63))
    ]


PAGES = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>x</p>"),
    (4, "http://b/\r\nX: y z", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", None), (6, "u", ""),
    (None, "u", ""), (7, "ü", "Straße 漢字 😀\n\n" * 4000), (8, "v", "<p>x</p> "), (2, "http://a/2", "<p>x</p>"),
    (9, "w", "only"),
]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "pages.parquet")
    rows = [(*p, "clash", 1) for p in PAGES]
    schema = "page_id long, url string, html string, record_type string, row int"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("per_file", [3, 4096])
def test_archives_round_trip(spark, pages, tmp_path, per_file):
    write_archives(pages, f"{tmp_path}/w", records_per_file=per_file)
    records = read_archives(spark, f"{tmp_path}/w")
    found = resolved_records(records).collect()
    best = {}
    for page_id, _, html in PAGES:
        best[html or ""] = max(best.get(html or "", -1), -1 if page_id is None else page_id)
    facts = lambda r: (r.page_id, r.payload_bytes, r.payload_digest)
    assert Counter(map(facts, found)) == Counter(
        (i, len((h or "").encode()), digest(h)) for i, _, h in PAGES
    )
    responses = Counter(r.page_id for r in found if r.record_type == "response")
    assert responses == Counter(best.values())  # one for each payload
    by_page = {i: h or "" for i, _, h in PAGES if i is not None}
    for r in found:
        assert (r.refers_to is None) == (r.record_type == "response")
        if r.record_type == "revisit":
            assert digest(by_page[r.refers_to]) == r.payload_digest
        else:
            assert r.digest_matches
    payloads = {r.page_id: bytes(r.payload).decode() for r in records.collect() if r.payload is not None}
    assert payloads == {i: h for h, i in best.items()}


def test_small_payloads_are_no_revisits(spark, pages, tmp_path):
    write_archives(pages, f"{tmp_path}/w", min_bytes=9)
    found = resolved_records(read_archives(spark, f"{tmp_path}/w", with_payload=False))
    assert found.filter("record_type = 'revisit'").count() == 0
    assert found.count() == len(PAGES)


def test_archives_are_plain_warc(spark, pages, tmp_path):
    """Each record is its header, a blank line, as many bytes as it says, and two line ends."""
    write_archives(pages.orderBy("page_id").coalesce(1), f"{tmp_path}/w")
    count = 0
    for file in tmp_path.glob("w/part-*"):
        raw = gzip.decompress(file.read_bytes())
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            names = [x.split(": ", 1)[0] for x in lines[1:]]
            assert len(names) == len(set(names)) and "WARC-Record-ID" in names and "X" not in names
            size = int(next(x for x in lines if x.startswith("Content-Length: "))[16:])
            assert rest[size : size + 4] == b"\r\n\r\n"
            raw, count = rest[size + 4 :], count + 1
    assert count == len(PAGES)


def test_binary_payloads_and_no_pages(spark, tmp_path):
    rows = [(1, "u", bytearray(range(256)) * 3), (2, "u", bytearray(b"\xff\r\n\r\n\x00"))]
    spark.createDataFrame(rows, "page_id long, url string, html binary").write.parquet(f"{tmp_path}/p")
    pages = spark.read.parquet(f"{tmp_path}/p")
    write_archives(pages, f"{tmp_path}/w")
    got = {r.page_id: bytes(r.payload) for r in read_archives(spark, f"{tmp_path}/w").collect()}
    assert got == {i: bytes(p) for i, _, p in rows}
    write_archives(pages.filter("false"), f"{tmp_path}/none")
    assert resolved_records(read_archives(spark, f"{tmp_path}/none")).count() == 0
    assert pages.select(F.count("*")).first()[0] == 2
