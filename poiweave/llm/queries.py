"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiweave.llm import decontamination, divergence, exact, language, linechunks, minhash, pieces, quality, suffixes, toxicity, urlrules, vectorcodes, warc

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.drop_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(_table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = linechunks.drop_repeated_chunks(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed_lines", "n_removed_bytes", F.sha2("text", 256).alias("kept_sha256"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warc.round_trip(spark, _table(spark, sf_dir, "pages"), every_row=True)
    return done.select(
        warc.page_id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        warc.page_id_of(F.col("refers_to")).alias("refers_to"),
    )


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    evidence = language.page_evidence(pages).unionByName(language.document_evidence(docs))
    return language.identify(evidence, language.fit(docs))


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(_table(spark, sf_dir, "documents"))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urlrules.RULES, "host string, path string, verdict string")
    return urlrules.judge(_table(spark, sf_dir, "pages"), rules)


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(_table(spark, sf_dir, "embeddings")).drop("label")
