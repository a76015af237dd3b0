"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.sources import scratch_dir

from . import alignment, decision_list, ecoc, fixity, latent, licenses, line_dedup, link_trust, mixing, ngram_join, packing, ring, spelling

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ecoc.identified(_table(spark, sf_dir, "documents"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(_table(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.manifest(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.manifest(_table(spark, sf_dir, "documents"))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC files in two replicas, the second with damage by a rule on the record id, and the audit."""
    first, second = (scratch_dir(spark, f"replica-{k}") for k in (1, 2))
    fixity.write_warc(_table(spark, sf_dir, "pages"), first)
    fixity.copy_warc(spark, first, second, _damaged)
    found = fixity.audit(spark, first, second)
    return found.withColumn("page_id", F.expr("try_cast(get(split(coalesce(id, other_id), ':'), 2) AS BIGINT)"))


def _damaged(name: bytes, record: bytes) -> bytes | None:
    """By a hash of its id, one record in 97 gets another date, and one in 97 is lost."""
    lot = zlib.crc32(name) % 97
    if not name.startswith(b"urn:page:") or lot > 1:
        return record
    return record.replace(b"T00:00:00Z", b"T00:00:01Z", 1) if lot == 0 else None


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judged(_table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = decision_list.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", *decision_list.BASE, "base_failed", "kept", "rule")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment_digests(_table(spark, sf_dir, "documents"), *paths)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), lot=199)


def queries() -> dict[str, Query]:
    found = (
        op1_line_dedup,
        op2_language_id,
        op3_license_scans,
        op4_source_mixing,
        op5_ngram_jaccard_join,
        op6_sharding,
        op7_warc_fixity,
        op8_url_filters,
        op9_quality_rules,
        op10_benchmark_decontamination,
        op11_tokenizer_alignment,
        op12_best_fit_packing,
        op13_spelling_variants,
    )
    return {f.__name__: f for f in found}


_OP5 = r"""
WITH RECURSIVE
words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words),
items AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS item FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common WHERE 100 * k >= 75 * (na + nb - k) UNION ALL
    SELECT b, a FROM common WHERE 100 * k >= 75 * (na + nb - k)),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""


_OP4 = r"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size
    FROM documents),
keyed AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || size), 1, 15) AS BIGINT) AS point FROM docs),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weights AS (
    SELECT source, source_size, 2.0 * source_size AS cap,
        CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
    FROM totals),
filled AS (
    SELECT cap / w AS full_at,
        (1.5 * (SELECT sum(source_size) FROM totals) - coalesce(sum(cap) OVER before, 0.0))
            / ((SELECT sum(w) FROM weights) - coalesce(sum(w) OVER before, 0.0)) AS level
    FROM weights WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(level, full_at) FILTER (level <= full_at) AS level FROM filled),
aims AS (
    SELECT source, source_size, CAST(least(cap, w * level) AS DOUBLE) AS target,
        CASE WHEN source_size > 0 THEN floor(least(cap, w * level) / source_size) ELSE 0 END AS whole
    FROM weights, level),
placed AS (
    SELECT k.doc_id, k.size, a.source_size, a.target, a.whole, a.target - a.whole * a.source_size AS rest,
        coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.point, k.size, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM keyed k JOIN aims a ON k.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
    CASE WHEN size = 0 THEN 0 ELSE CAST(size * (whole + greatest(0, least(1, floor((rest - below) / size + 0.5)))) AS BIGINT) END AS taken
FROM placed
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_source_mixing": _OP4, "op5_ngram_jaccard_join": _OP5}
