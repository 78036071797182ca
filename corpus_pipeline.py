"""Cleans a document corpus stage by stage; every stage applies one text operator to all its predecessor kept.

Toxic documents go; of each group of near-duplicates one document stays; documents that hold a benchmark item go;
secrets are replaced in the text; what is left is encoded. All stages but the last return the columns of documents.
Cases are those of the operators: null and empty texts, null and repeated ids, repeated rows and empty tables pass
through; further columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm import bpe_codec, decontam_cgk, secret_cnn, simhash_bk, toxicity
from tierloom.llm.queries import TOKENIZER, toxic_models
from tierloom.sources.staging import staged_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_civil(docs, *toxic_models(docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts link at a similarity of 0.8 of their sets of five-word shingles."""
    return simhash_bk.keep_one(docs, width=5, least=0.8)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam_cgk.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars, if there, follows the new text."""
    clean = secret_cnn.redact(docs, secret_cnn.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    changed = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
    return clean.withColumn("n_chars", changed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of docs without the text, and the digests; a column of docs with a digest's name makes way for it."""
    made = ("n_tokens", "ids_sha256", "decoded_sha256")
    kept = tuple(c for c in docs.columns if c not in ("text", *made))
    return bpe_codec.encode_digests(docs, public_tokenizers.path(TOKENIZER), kept)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_bk", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("bpe_codec", encode),
]

# Classifiers, edit distance and merges have no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each result is written as Parquet and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = staged_path(spark, "corpus")  # removed with the other tables of the enclosing temporary_tables block
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
