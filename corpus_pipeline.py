"""From raw documents to token ids: five stages, each a whole pass over what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import bpe, decontaminate, near_dup, secrets, toxicity
from tabwright.session import materialise

TOKENIZER = "byte_bpe_50k.json"
TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels of the documents at hand.

    Null and empty texts score lowest and stay; repeated rows and rows without an id are judged by their text; all columns
    stay, whatever their names; no documents give none.
    """
    model = toxicity.fit_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model, threshold=TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8) the document of the smallest id stays.

    Texts without words, null ones too, are nobody's copy and stay, as do rows without an id; of rows that share an id the
    one of the smallest digest stays. All columns stay, whatever their names; no documents give none.
    """
    return near_dup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least four fifths of a benchmark item's shingles go.

    Null and empty texts and items match nothing; repeated rows and rows without an id are judged by their text; all columns
    stay, whatever their names; no documents give none.
    """
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def cover_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are covered in place; every document stays, and ``n_chars``, where there is such a column, counts what is left.

    Null and empty texts stay as they are; repeated rows and rows without an id are covered like others; other columns
    stay, whatever their names; no documents give none.
    """
    covered = secrets.redact(docs)
    return covered.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else covered


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the columns of documents but the text, and whether the ids decode to the text.

    A column of documents named ``n_tokens``, ``ids`` or ``round_trip`` gives way to the stage's own; any other stays. A null
    or empty text has no ids; repeated rows and rows without an id come out like others; no documents give none.
    """
    codec = bpe.load(public_tokenizers.path(TOKENIZER))
    others = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "round_trip")]
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), "text", F.sha2("text", 256).alias("_digest"))
    coded = bpe.encode_documents(kept, codec, keep=("_row", "_digest"))
    same = F.sha2("decoded", 256) == F.coalesce("_digest", F.sha2(F.lit(""), 256))
    return coded.select(*(F.col("_row")[c].alias(c) for c in others), F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dup", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("secrets", cover_secrets),
    ("bpe", encode),
]
ORACLE_SQL = None  # the toxicity field and the merges are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
