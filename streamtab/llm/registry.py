"""The registered queries: thin wrappers that apply one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm import (common, decontaminate, hard_negatives, html_extract, langid, lm_score, near_dup, packing, periodic,
                           quality, quality_rules, token_files, toxicity, url_filter)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: The rules of op10, as (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    left_out = common.remainder("doc_id", 3) == 1
    profiles = langid.learn(docs.where(~left_out))
    found = langid.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", left_out.alias("held_out"), "lang_pred", "score")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(common.table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    left_out = common.remainder("doc_id", 5) == 0
    model = toxicity.learn(docs.where(~left_out), common.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", left_out.alias("held_out"), "score", "predicted")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(common.table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.search(docs, common.table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    pieces = packing.tokenize(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False).drop("ids")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score(docs, tokenizer_path("byte_bpe_50k.tiktoken"), common.remainder("doc_id", 7) == 2)


def op9_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    left_out = common.remainder("doc_id", 4) == 2
    model = quality.learn(docs.where(~left_out), common.table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", left_out.alias("held_out"), "score", "predicted")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(common.table(spark, sf_dir, "embeddings"), label=label)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.detect(docs, tail=F.crc32(F.col("doc_id").cast("string")))
    return periodic.digest(found).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                         "runs_sha256", "collapsed_sha256")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    path = token_files.write(docs, common.scratch_path(spark, "token-files"), tokenizer_path("byte_bpe_50k.json"))
    return token_files.read(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_html_text, op3_toxicity, op4_near_duplicates, op5_quality_rules, op6_decontamination,
        op7_packing, op8_lm_score, op9_quality_neighbours, op10_url_filter, op11_hard_negatives, op12_periodic_runs,
        op13_token_files)
}

ORACLE_SQL: dict[str, str] = {
    "op11_hard_negatives": r"""
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, a.label AS al, b.vec_id AS id, b.label AS bl,
                          CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
                   FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
             p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE al = bl
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id,
               positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.bl <> s.al
                     AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
        QUALIFY row_number() OVER w <= 5""",
    "op10_url_filter": r"""
        WITH u AS (SELECT page_id,
                          coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                          coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
             j AS (SELECT *, CASE
                       WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                       WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                       WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                       WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                       WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM u)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j""",
    "op6_decontamination": r"""
        WITH RECURSIVE dw AS (
               SELECT row_number() OVER () AS r, doc_id,
                      list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
             bw AS (
               SELECT item_id,
                      list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
             bx AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + 9], ' ') AS win
                    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
             ms AS (SELECT DISTINCT m FROM bx),
             dx AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
                    FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, ms WHERE len(w) >= m)),
             hit AS (SELECT r, i, bx.m, item_id FROM dx JOIN bx ON dx.win = bx.win AND dx.m = bx.m),
             pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
             its AS (SELECT r, count(DISTINCT item_id) AS n_items,
                            string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)""",
}
