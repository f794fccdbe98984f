"""Training corpus from documents: five stages, each an operator on what the one before kept.

Toxic documents go, one document of each group of near duplicates stays,
documents contaminated with benchmark items go, secrets are masked, and what is
left is packed into batches. No stage but the last changes the columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonalspark.llm import _text, decontaminate, ngram_join, packing, queries, secret_scan, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that it rejects go."""
    queries.ship(spark)
    return toxicity.remove_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group stays, that with the smallest id."""
    queries.ship(spark)
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents with a twentieth or more of their words in benchmark windows go."""
    queries.ship(spark)
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: secrets are replaced; n_chars follows the text."""
    import public_tokenizers

    words = secret_scan.words_of(public_tokenizers.path("word_bpe_49k.json"))
    forest = secret_scan.train(secret_scan.labelled_findings(spark, words=words), words=words)
    return secret_scan.redact(docs, forest, words=words, length="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every document as token ids in length buckets and batches."""
    import public_tokenizers

    queries.ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("packing", pack),
]

#: Trained scores, MinHash and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = _text.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
