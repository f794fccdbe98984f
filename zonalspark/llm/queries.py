"""Queries of the training-data operators, each over whole tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_topk, fill_in_middle, hilbert_shards, html_density, license_scan, ngram_join, packing, secret_scan, suffix_dedup, token_output, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.report(_table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return secret_scan.report(spark, _table(spark, sf_dir, "documents"), secret_scan.words_of(public_tokenizers.path("word_bpe_49k.json")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(_table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.report(_table(spark, sf_dir, "embeddings"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.report(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.report(_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(_table(spark, sf_dir, "embeddings"))


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once for each Spark context."""
    context = spark.sparkContext
    if not getattr(context, "_has_zonalspark", False):
        root = Path(__file__).resolve().parents[2]
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/zonalspark", "zip", root, "zonalspark"))
        context._has_zonalspark = True


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _shipped(f) for k, f in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op12_fill_in_middle": fill_in_middle.SQL}
