"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, exact_dedup, jaccard_join, language_id, mixing, packing, period_runs, pii, secrets, substring_dedup, topk_search, url_filter, warc
from .common import table


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), each_row=True)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs, carry=["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard_join.near_duplicates(docs, size=3, threshold=(90, 100))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rules_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find_secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, digest=True).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", period_runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return period_runs.digests(period_runs.find_runs(docs, carry=["doc_id"]))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.report(conversation_repair.repair(conversation_repair.damaged(conversations)), conversations)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict:
    every = (
        op1_topk_search, op2_mixing, op3_packing, op4_exact_dedup, op5_pii, op6_jaccard_join, op7_url_filter, op8_language_id,
        op9_secrets, op10_substring_dedup, op11_periodic_runs, op12_conversation_repair, op13_warc,
    )
    return {"pipeline": corpus_pipeline.run, **{f.__name__: f for f in every}}


def oracle_sql() -> dict[str, str]:
    sql = {
        "pipeline": corpus_pipeline.ORACLE_SQL, "op1_topk_search": topk_search.ORACLE, "op2_mixing": mixing.ORACLE,
        "op4_exact_dedup": exact_dedup.ORACLE, "op6_jaccard_join": jaccard_join.ORACLE, "op7_url_filter": url_filter.ORACLE,
        "op9_secrets": secrets.ORACLE, "op10_substring_dedup": substring_dedup.ORACLE,
        "op11_periodic_runs": period_runs.ORACLE, "op12_conversation_repair": conversation_repair.ORACLE,
        "op13_warc": warc.ORACLE,
    }
    return {name: text for name, text in sql.items() if text}
