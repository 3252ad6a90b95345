"""The registered queries of this package, over the tables of a folder, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.common import fold, held_out, shared_dir
from curbflow.llm.decontaminate import contamination
from curbflow.llm.hard_negatives import hard_negatives
from curbflow.llm.html_extract import extract_text
from curbflow.llm.language_id import identify
from curbflow.llm.language_id import train as train_languages
from curbflow.llm.markov_model import score_texts
from curbflow.llm.packing import pack
from curbflow.llm.quality_model import scored, train
from curbflow.llm.quality_rules import quality_rules
from curbflow.llm.simhash import near_duplicates
from curbflow.llm.substring_dedup import substring_dedup
from curbflow.llm.url_filter import judge_urls
from curbflow.llm.warc import key_of, read_warc, write_warc
from curbflow.llm.whitening import whiten

# host, path, verdict
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every document, and whether the base limits and the learned rules keep it."""
    return quality_rules(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, folder, "pages"), rules).drop("url")


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, by a model that never saw a third of them."""
    docs = _table(spark, folder, "documents")
    model = train_languages(docs.filter(~held_out("doc_id", 3, 1)))
    return identify(docs, model).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicates(_table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in training sequences."""
    pieces = pack(_table(spark, folder, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_markov_model(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of every document under a hidden Markov model that never saw a seventh of them."""
    docs = _table(spark, folder, "documents")
    return score_texts(docs.withColumn("held_out", held_out("doc_id", 7, 2)))


def op9_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, by a model that never saw a quarter of the labels."""
    docs = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels").filter(fold("doc_id", 4) != 2)
    result = scored(docs, train(docs, labels), ("doc_id",))
    return result.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that an earlier document holds."""
    return substring_dedup(_table(spark, folder, "documents").select("doc_id", "text", "n_chars"))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives."""
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(_table(spark, folder, "pages"), path)
    records = read_warc(spark, path, payload=False).filter("record_type in ('response', 'revisit')")
    return records.select(
        key_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", key_of("refers_to").alias("refers_to")
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the first four whitened components; the deviation is NULL where a long does not hold it."""
    result = whiten(_table(spark, folder, "embeddings"))
    return result.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after the labels of every seventh are moved by one."""
    embeddings = _table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.withColumn("label", moved), anchors=F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline from raw documents to packed sequences."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_url_filter": op3_url_filter,
    "op4_html_extraction": op4_html_extraction,
    "op5_language_id": op5_language_id,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_markov_model": op8_markov_model,
    "op9_quality_model": op9_quality_model,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_warc": op11_warc,
    "op12_whitening": op12_whitening,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op2_decontamination": f"""
        WITH items AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
        docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
        windows AS (
            SELECT DISTINCT item_id, list_slice(w, k, k + 9) AS win
            FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM items WHERE len(w) > 0)
        ),
        sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
        places AS (
            SELECT doc_id, k, list_slice(w, k, k + n - 1) AS win
            FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM docs, sizes WHERE len(w) >= n)
        ),
        hits AS (SELECT doc_id, k, win, item_id FROM places JOIN windows USING (win)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + len(win) - 1)) AS p FROM hits) GROUP BY doc_id),
        names AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)""",
    "op3_url_filter": f"""
        WITH rules(h, p, v) AS (VALUES {_RULES_SQL}),
        urls AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ),
        fitting AS (
            SELECT page_id, host, path, h || p AS rule, v,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(h) + length(p) DESC NULLS LAST) AS place
            FROM urls LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        )
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fitting WHERE place = 1""",
    "op11_warc": """
        WITH pages AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        hashed AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM pages),
        parts AS (
            SELECT *, list_transform(range(8), lambda k: CAST('0x' || substr(hex, 5 * k + 1, 5) AS BIGINT)) AS fives FROM hashed
        ),
        coded AS (
            SELECT page_id, payload_bytes, hex,
                   list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       CAST((fives[CAST(k // 4 + 1 AS INT)] >> CAST(15 - 5 * (k % 4) AS INT)) & 31 AS INT) + 1, 1)), 'string_agg', '') AS payload_digest
            FROM parts
        ),
        named AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS latest FROM coded)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
        FROM named""",
}
