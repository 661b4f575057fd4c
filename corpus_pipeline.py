"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; it is written as Parquet in the
shared folder and reread as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelrank.llm.decontaminate import decontaminate, is_contaminated
from panelrank.llm.arrays import fresh_name
from panelrank.llm.jaccard import keep_one
from panelrank.llm.packing import pack
from panelrank.llm.secrets import redact
from panelrank.llm.store import Store
from panelrank.llm.toxicity import drop_toxic


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model scores 0.5 or more go; clean, null and empty ones stay."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id; texts without words all stay."""
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages over a twentieth of their words or more go."""
    name = fresh_name(docs, "_hits")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), into=name)
    return found.where(~is_contaminated(name)).drop(name)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text; every document stays."""
    return redact(docs, n_chars="n_chars" if "n_chars" in docs.columns else None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset; the documents' other columns are carried."""
    import public_tokenizers

    return pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# near duplicates, the learned model and the tokenizer are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.write(stage(spark, docs, sf_dir), name)
    return docs
