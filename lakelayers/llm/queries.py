"""The operators' queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.llm import (
    decontamination,
    embeddings,
    filter_audit,
    html_extract,
    language_id,
    line_dedup,
    mixing,
    quality,
    simhash,
    source_divergence,
    suffix_dedup,
    term_search,
    url_filter,
)
from lakelayers.llm.common import held_out, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.with_kept_lines(docs, line_dedup.line_bitmaps(docs))
    return kept.select(
        F.col("_row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.main_texts(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    outside = held_out(F.col("doc_id"), 5, 0)
    model = language_id.train(docs.filter(~outside))
    judged = language_id.identify(docs.select("doc_id", "text"), model)
    doc_id = F.col("_row.doc_id")
    return judged.select(doc_id.alias("doc_id"), held_out(doc_id, 5, 0).alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_sizes(mixing.mix(table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 3, 1))
    scores = quality.score(docs, quality.train(docs, labels))
    predicted = (F.col("score") >= 0.5).cast("int")
    return scores.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", predicted.alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = term_search.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
    return found.withColumnRenamed("id", "vec_id")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_extract": op3_html_extract,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_quality": op10_quality,
    "op11_source_divergence": op11_source_divergence,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_filter_audit": op13_filter_audit,
}
