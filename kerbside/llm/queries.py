"""Registered queries of this folder, one per operator, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import (
    byte_bpe, decontamination, filter_audit, html_wrappers, importance_resampling, jaccard_join, language_id, quality_classifier,
    quality_rules, secret_scan, suffix_dedup, url_filters, warc,
)
from kerbside.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(spark, table(spark, sf_dir, "pages"), fresh_dir(spark, "warc"))


def op7_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.digest(table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.digest(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.digest(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.digest(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_warc": op6_warc,
    "op7_html_wrappers": op7_html_wrappers,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_url_filters": op13_url_filters,
}

ORACLES: dict[str, str] = {
    "op4_suffix_dedup": r"""
        WITH told AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n_bytes FROM documents
        ), starts AS (
            SELECT doc_id, c + i AS p, hash(substr(part, 2 * i + 1, 800)) AS h
            FROM (SELECT doc_id, c, part, unnest(range(least(256, n_bytes - 399 - c))) AS i
                  FROM (SELECT doc_id, c, n_bytes, substr(x, 2 * c + 1, 1310) AS part
                        FROM (SELECT *, unnest(range(0, greatest(0, n_bytes - 399), 256)) AS c FROM told)))
        ), again AS (
            SELECT doc_id, p FROM starts SEMI JOIN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1) USING (h)
        ), runs AS (
            SELECT doc_id, p, sum(CASE WHEN p <= earlier + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
            FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS earlier FROM again)
        ), spans AS (
            SELECT doc_id, min(p) AS low, max(p) + 400 AS high FROM runs GROUP BY doc_id, run
        ), gaps AS (
            SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM spans
            UNION ALL SELECT doc_id, max(high), NULL FROM spans GROUP BY doc_id
            UNION ALL SELECT doc_id, 0, NULL FROM told ANTI JOIN spans USING (doc_id)
        ), kept AS (
            SELECT doc_id, sha256(unhex(string_agg(substr(x, 2 * low + 1, 2 * (coalesce(high, n_bytes) - low)), '' ORDER BY low))) AS kept_sha256
            FROM gaps JOIN told USING (doc_id) GROUP BY doc_id
        ), removed AS (
            SELECT doc_id, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
        )
        SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
        FROM told LEFT JOIN removed USING (doc_id) JOIN kept USING (doc_id)
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), k AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to,
               CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 0 ELSE payload_bytes END AS block_bytes
        FROM k
    """,
    "op8_jaccard_join": r"""
        WITH RECURSIVE told AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
            FROM told
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common c JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c.n >= 75 * (p.n + q.n - c.n)
        ), sides AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached(doc_id, root) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT b, root FROM reached JOIN sides ON doc_id = a WHERE root < b
        )
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op11_filter_audit": r"""
        WITH told AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), marks AS (
            SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
            FROM labels GROUP BY doc_id
        ), judged AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   (len(words) < 200)::INT
                   + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
                   + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
                   + 8 * regexp_matches(text, '[#$%&*|]')::INT
                   + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
            FROM told LEFT JOIN marks USING (doc_id)
        ), counted AS (
            SELECT part, mask, good, toxic, count(*) AS n FROM judged GROUP BY ALL
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit
        ), orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
        ), steps AS (
            SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
            FROM orders, range(1, 6) r(step)
        ), summed AS (
            SELECT part, filter_order, step, bit,
                   coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
                   coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0 AND good), 0)::BIGINT AS good_lost,
                   coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0 AND toxic), 0)::BIGINT AS toxic_lost
            FROM counted, steps GROUP BY ALL
        )
        SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM summed
    """,
    "op12_importance_resampling": r"""
        WITH bits AS (
            SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crc
            FROM range(256) r(b)
        ), texts AS (
            SELECT true AS corpus, doc_id, row_number() OVER () AS place, text FROM documents
            UNION ALL SELECT false, NULL, -row_number() OVER (), text FROM benchmark
        ), words AS (
            SELECT corpus, place, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
            FROM texts
        ), told AS (
            SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)
        ), hashed AS (
            SELECT w, xor(list_reduce(
                [('0x' || substr(x, 2 * i + 1, 2))::BIGINT FOR i IN range(length(x) // 2)],
                lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
            FROM told, bits
        ), held AS (
            SELECT corpus, place, bucket FROM words JOIN hashed USING (w)
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000))))::BIGINT AS gain
            FROM (SELECT bucket, count(*) FILTER (corpus)::DOUBLE AS s, count(*) FILTER (NOT corpus)::DOUBLE AS t FROM held GROUP BY bucket)
        ), summed AS (
            SELECT place, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM held JOIN gains USING (bucket) WHERE corpus GROUP BY place
        ), scored AS (
            SELECT doc_id, place, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(
                       sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM texts LEFT JOIN summed USING (place) WHERE corpus
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place_in <= 10 * may // 100 AND n_features >= 20 THEN place_in END AS rank
        FROM (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place_in,
                   count(*) FILTER (n_features >= 20) OVER () AS may
            FROM scored
        )
    """,
}
