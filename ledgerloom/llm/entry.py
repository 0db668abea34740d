"""Queries of the training-data operators, with their production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import hamming, mixing, ngram_join, packing, pii, quality, secrets, sharding, toxicity, webp
from .base import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(table(spark, sf_dir, "documents"), target_entropy=0.95, most_repeats=2.0)


def op2_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.nearest_codes(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op3_lossless_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webp.media_rows(table(spark, sf_dir, "documents"))


def op4_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_rows(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op6_toxicity_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, limit=2048)


def op8_secret_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op9_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=24)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_mixing, op2_hamming_topk, op3_lossless_webp, op4_pii_anchors, op5_ngram_jaccard,
        op6_toxicity_compression, op7_vector_packing, op8_secret_trigrams, op9_quality_compression, op10_minimax_shards,
    ]
    return {f.__name__: f for f in own}


#: The exponent is bisected in 2**30 steps: ``x`` for the entropy, ``y`` for the repetitions.
MIXING_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(source, '') AS s, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS BIGINT) AS tokens FROM documents
), sizes AS (
  SELECT s, CAST(sum(tokens) AS BIGINT) AS own, count(*) AS n FROM docs GROUP BY s
), shares AS (
  SELECT s, own, n, CAST(own AS DOUBLE) / (SELECT sum(own) FROM sizes) AS p FROM sizes
), steps AS (
  SELECT 0 AS round, CAST(0 AS BIGINT) AS x0, CAST(1073741824 AS BIGINT) AS x1, CAST(0 AS BIGINT) AS y0, CAST(1073741824 AS BIGINT) AS y1
  UNION ALL
  SELECT round + 1, if(even, x0, x), if(even, x, x1), if(rare, y0, y), if(rare, y, y1) FROM (
    SELECT round, x0, x1, y0, y1, x, y,
           (SELECT ln(sum(pow(p, x / 1073741824.0))) - x / 1073741824.0 * sum(pow(p, x / 1073741824.0) * ln(p)) / sum(pow(p, x / 1073741824.0)) <= 0.95 * ln(count(*)) FROM shares) AS even,
           (SELECT max(pow(p, 1 - y / 1073741824.0)) * max(pow(p, y / 1073741824.0 - 1)) <= 2.0 * (1 + 1e-9) FROM shares) AS rare
    FROM (SELECT *, (x0 + x1) // 2 AS x, (y0 + y1) // 2 AS y FROM steps WHERE round < 30)
  )
), chosen AS (
  SELECT greatest(
    CASE WHEN (SELECT -sum(p * ln(p)) FROM shares) >= CASE WHEN (SELECT count(*) FROM shares) > 1 THEN 0.95 * ln((SELECT count(*) FROM shares)) ELSE 0 END THEN 1.0 ELSE x1 / 1073741824.0 END,
    CASE WHEN (SELECT max(p) / min(p) FROM shares) <= 2.0 * (1 + 1e-9) THEN 0.0 ELSE y1 / 1073741824.0 END
  ) AS a FROM steps WHERE round = 30
), planned AS (
  SELECT s, own, CAST(ceil(n / greatest(1024.0, sqrt(n) / 4)) AS BIGINT) AS blocks,
         pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, chosen) * (SELECT sum(own) FROM sizes) * (SELECT sum(pow(p, a)) * max(pow(p, 1 - a)) FROM shares, chosen) * (1 + 1e-9) AS budget
  FROM shares, chosen
), cut AS (
  SELECT doc_id, source, d.s, tokens, own, budget, CAST('0x' || substr(md5(concat_ws(':', doc_id, 17)), 1, 15) AS BIGINT) % blocks AS block FROM docs d JOIN planned p ON d.s = p.s
), summed AS (
  SELECT s, block, own, budget, sum(tokens) AS t FROM cut GROUP BY ALL
), epochs AS (
  SELECT *, unnest(range(CAST(floor(budget / own) AS BIGINT) + 1)) AS epoch FROM summed
), ordered AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws(':', block, epoch, 17)), 1, 15) AS BIGINT) AS h FROM epochs
), placed AS (
  SELECT s, block, epoch, row_number() OVER w - 1 AS block_place, sum(t) OVER w - t AS before, least(budget - epoch * own, own) AS room
  FROM ordered WINDOW w AS (PARTITION BY s, epoch ORDER BY h, block ROWS UNBOUNDED PRECEDING)
), rows_of AS (
  SELECT c.*, epoch, block_place, before, room, CAST('0x' || substr(md5(concat_ws(':', doc_id, epoch, 17)), 1, 15) AS BIGINT) AS h
  FROM cut c JOIN placed p ON c.s = p.s AND c.block = p.block WHERE before < room
), numbered AS (
  SELECT *, row_number() OVER w - 1 AS row_place, before + sum(tokens) OVER w AS after
  FROM rows_of WINDOW w AS (PARTITION BY s, block, epoch ORDER BY h, doc_id, tokens ROWS UNBOUNDED PRECEDING)
)
SELECT doc_id, source, tokens, CAST(epoch AS INTEGER) AS epoch, block, CAST(block_place AS INTEGER) AS block_place, CAST(row_place AS INTEGER) AS row_place
FROM numbered WHERE after <= room
"""

TOPK_SQL = """
WITH coded AS (
  SELECT vec_id, list_transform(embedding, lambda x: coalesce(x, 0) > 0) AS bits FROM embeddings WHERE len(embedding) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id,
         CAST(len(list_filter(list_zip(q.bits, r.bits), lambda p: p[1] <> p[2])) AS INTEGER) AS distance
  FROM coded q, coded r WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10
"""

JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' ')))) END AS s FROM words
), classes AS (
  SELECT s, min(doc_id) AS class_id, count(*) AS copies, len(s) AS n FROM sets GROUP BY s
), posted AS (
  SELECT class_id, n, copies, unnest(s) AS shingle FROM classes WHERE n > 0
), pairs AS (
  SELECT a.class_id AS x, b.class_id AS y, any_value(a.copies) AS cx, any_value(b.copies) AS cy
  FROM posted a JOIN posted b ON a.shingle = b.shingle AND a.class_id < b.class_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.class_id, b.class_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS (SELECT x, y, cy AS c FROM pairs UNION ALL SELECT y, x, cx FROM pairs
), reach AS (
  SELECT class_id AS node, class_id AS other FROM classes
  UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other
), lowest AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node
), degree AS (SELECT x, sum(c) AS c FROM links GROUP BY x)
SELECT d.doc_id, CAST(k.n AS BIGINT) AS n_shingles, CASE WHEN k.n = 0 THEN d.doc_id ELSE component_id END AS component_id,
       CASE WHEN k.n = 0 THEN d.doc_id ELSE class_id END AS class_id,
       CAST(CASE WHEN k.n = 0 THEN 0 ELSE coalesce(c, 0) + copies - 1 END AS BIGINT) AS n_links
FROM sets d JOIN classes k ON d.s = k.s JOIN lowest ON node = class_id LEFT JOIN degree ON x = class_id
"""

_SPANS = """
  SELECT doc_id, {kind!r} AS kind, {place} AS place,
         unnest(list_zip(string_split_regex(text, {rx})[:len(regexp_extract_all(text, {rx}))], regexp_extract_all(text, {rx}), regexp_extract_all(text, {rx}, {group}), range(len(regexp_extract_all(text, {rx}))))) AS m,
         {least} AS least
  FROM docs WHERE regexp_matches(text, {rx})
"""


def secrets_sql() -> str:
    """The base rules and the method's further ones, with spans from the pieces between matches."""
    parts = []
    for place, rule in enumerate((*secrets.BASE_RULES, *secrets.MORE_RULES)):
        pattern = rule.pattern.replace("\\x20", " ").replace("(?i:(password|passwd|secret|token|api_?key))", "((?i:password|passwd|secret|token|api_?key))")
        parts.append(_SPANS.format(kind=rule.kind, place=place, rx="'" + pattern.replace("'", "''") + "'", group=rule.group, least=rule.least))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT *, sum(length(m[1])) OVER w + sum(length(m[2])) OVER w - length(m[2]) AS a, length(m[2]) AS n
  FROM found WINDOW w AS (PARTITION BY doc_id, kind ORDER BY m[4])
), kept AS (
  SELECT doc_id, kind, place, CAST(a AS BIGINT) AS a, kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + n AS BIGINT) AS span FROM placed WHERE length(m[3]) >= least
), joined AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY a, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY a, place) AS spans
  FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": MIXING_SQL, "op2_hamming_topk": TOPK_SQL, "op5_ngram_jaccard": JACCARD_SQL, "op8_secret_trigrams": secrets_sql()}
