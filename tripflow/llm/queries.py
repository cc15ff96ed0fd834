"""One query per operator over the supplied tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.align_tokens import align_tokenizers
from tripflow.llm.common import read_table, sized_for, stored
from tripflow.llm.decontaminate import find_overlaps, hit_words
from tripflow.llm.exact_dedup import exact_dedup
from tripflow.llm.language import identify
from tripflow.llm.line_dedup import line_report
from tripflow.llm.mixing import mix
from tripflow.llm.near_dedup import near_duplicates
from tripflow.llm.packing import pack_documents
from tripflow.llm.quality import score_quality
from tripflow.llm.sharding import shard_rows
from tripflow.llm.topk import top_k
from tripflow.llm.warc import read_archives, resolved_records, write_archives
from tripflow.llm.whitening import whitened_components
from tripflow.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def _sized(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table, with the shuffles of the query sized for it."""
    return sized_for(read_table(spark, d, name))


def op1_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the one that stands for its text."""
    return exact_dedup(_sized(spark, d, "documents")).drop("row")


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the lines that an earlier line resembles."""
    report = line_report(_sized(spark, d, "documents")).drop("row")
    return report.withColumn("removed_lines", F.array_join("removed_lines", ","))


def op3_language(spark: SparkSession, d: str) -> DataFrame:
    """Predicted language of every document."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return identify(_sized(spark, d, "documents"), path)


def op4_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality of every document; sources are hosts, their languages paths."""
    scored = score_quality(
        _sized(spark, d, "documents"),
        read_table(spark, d, "labels"),
        host=F.col("source"),
        path=F.col("lang"),
    )
    return scored.drop("row")


def op5_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Components of near-duplicates of all documents."""
    return near_duplicates(_sized(spark, d, "documents")).drop("row")


def op6_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Every document in one of eight shards."""
    placed = shard_rows(_sized(spark, d, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_top_k(spark: SparkSession, d: str) -> DataFrame:
    """Ten best vectors for every hundredth vector."""
    return top_k(_sized(spark, d, "embeddings"), k=10, every=100)


def op8_mixing(spark: SparkSession, d: str) -> DataFrame:
    """How many words of every document a mix of all sources takes."""
    return mix(_sized(spark, d, "documents")).drop("row")


def op9_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    """Every document, cut and packed in sequences of 4096 tokens.

    Document count and attention cost of a sequence cannot exceed what 4096
    tokens allow, so that only tokens bind: as few sequences as possible. All
    three weigh alike in the choice of a sequence.
    """
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(_sized(spark, d, "documents"), path).drop("row")


def op10_warc(spark: SparkSession, d: str) -> DataFrame:
    """Every page written to archives with revisits, read back and resolved."""
    path = fresh_dir(spark, "warc")
    write_archives(_sized(spark, d, "pages"), path)
    # Both sides of the join read the records: parsed and hashed once.
    records = stored(read_archives(spark, path, with_payload=False), "warc-records")
    return resolved_records(records).drop("uri", "digest_matches")


def op11_whitening(spark: SparkSession, d: str) -> DataFrame:
    """The eight leading whitened components of every vector.

    A deviation beyond a long is null; ``deviation_exact`` holds it.
    """
    rows = whitened_components(_sized(spark, d, "embeddings"), components=8)
    return rows.withColumn("deviation", F.expr("try_cast(deviation_exact AS BIGINT)"))


def op12_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document that lie in a passage of the benchmark."""
    found = find_overlaps(_sized(spark, d, "documents"), read_table(spark, d, "benchmark"))
    n_hit = hit_words("spans")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_align_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Groups and links of two tokenizers in every document."""
    paths = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(_sized(spark, d, "documents"), *paths)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_exact_dedup,
        op2_line_dedup,
        op3_language,
        op4_quality,
        op5_near_dedup,
        op6_sharding,
        op7_top_k,
        op8_mixing,
        op9_best_fit_packing,
        op10_warc,
        op11_whitening,
        op12_decontaminate,
        op13_align_tokens,
    )
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS normal
  FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY normal ORDER BY n_points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY normal) AS group_size,
  first_value(doc_id) OVER (PARTITION BY normal ORDER BY n_points DESC, doc_id) = doc_id AS kept,
  sha256(normal) AS text_sha256
FROM texts""",
    "op2_line_dedup": r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line FROM split),
sets AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(
      regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS words
  FROM lines),
classes AS (
  SELECT words, len(words) AS n, min((doc_id, line_no)) AS first FROM sets
  WHERE len(words) > 0 GROUP BY words),
numbered AS (SELECT *, row_number() OVER (ORDER BY first) AS id FROM classes),
occurrences AS (SELECT id, n, unnest(words) AS word FROM numbered),
often AS (SELECT word, count(*) AS f FROM occurrences GROUP BY word),
prefixes AS (
  SELECT id, n, word FROM occurrences JOIN often USING (word)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY f, word) <= n - ceil(0.8 * n) + 1),
pairs AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM prefixes a
  JOIN prefixes b ON a.word = b.word AND a.id < b.id AND 10 * a.n >= 8 * b.n AND 10 * b.n >= 8 * a.n),
links AS (
  SELECT x, y FROM pairs JOIN numbered a ON x = a.id JOIN numbered b ON y = b.id
  WHERE 10 * len(list_intersect(a.words, b.words))
    >= 8 * (a.n + b.n - len(list_intersect(a.words, b.words)))),
counted AS (
  SELECT id, count(*) AS links, bool_or(late) AS late FROM (
    SELECT x AS id, false AS late FROM links UNION ALL SELECT y, true FROM links) GROUP BY id),
judged AS (
  SELECT s.doc_id, s.line_no, coalesce(c.links, 0) AS links,
    coalesce(c.late, false) OR coalesce(n.first <> (s.doc_id, s.line_no), false) AS removed
  FROM sets s LEFT JOIN numbered n ON s.words = n.words LEFT JOIN counted c ON c.id = n.id)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
  CAST(sum(links) AS BIGINT) AS n_links,
  coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (removed), '')
    AS removed_lines
FROM judged GROUP BY doc_id""",
    "op5_near_dedup": r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
      WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    END) AS s
  FROM texts),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) + any_value(b.n) AS total, count(*) AS n
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM common WHERE 100 * n >= 85 * (total - n)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x)
SELECT doc_id, len(any_value(s)) AS n_shingles, min(other) AS component_id,
  min(other) = doc_id AS kept
FROM reached JOIN sets USING (doc_id) GROUP BY doc_id""",
    "op7_top_k": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
    AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes,
    upper(sha1(coalesce(html, ''))) AS hex
  FROM pages),
b AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS response FROM p)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) >> (5 * (3 - i % 4))) % 32 + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM b""",
    "op12_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
heads AS (
  SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
  FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM heads),
places AS (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
  FROM d, (SELECT DISTINCT m FROM windows)),
hits AS (
  SELECT doc_id, i, m, item_id
  FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM places)
  JOIN windows USING (m, g)),
words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS word FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(named, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
