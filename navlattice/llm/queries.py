"""The registered queries of this subpackage: thin readers over the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import lm_scores

    scores = lm_scores(table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"), F.round("perplexity", 3).alias("perplexity"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import KINDS, find_secrets

    def count(kind: str) -> Column:
        return F.size(F.regexp_extract_all("base", F.lit(f"{kind}:"), 0)).cast("long").alias(f"n_{kind}")

    return find_secrets(table(spark, sf_dir, "documents")).select("doc_id", *map(count, KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge

    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", F.round("mean", 9).alias("mean"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", "contaminated")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archives, write_archives

    return read_archives(write_archives(table(spark, sf_dir, "pages"))).drop("url")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from . import oracle

    return oracle.oracle_sql()
