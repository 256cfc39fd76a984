"""A corpus pipeline: language, near duplicates, benchmark passages, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as parquet and read
again as the docs of the next one. All but the last return the columns of documents. Every stage
takes null, empty and repeated rows and empty tables as the docstring of its operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, language, pii
from millrace.llm.decontaminate import without_contaminated
from millrace.llm.near_dedup import near_duplicates
from millrace.llm.storage import stored

_KEY = "key of the row"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier accepts; it learns from the labelled ones."""
    identify = language.language_of(language.train(language.labelled_sample(docs)))
    return docs.where(identify(docs["text"])["accepted"])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates, those without an id last.

    Rows are told apart by their id and 128 bits of their text, so different texts of one id, or
    without one, are each decided on their own. Rows with equal id and text count once; texts
    without a word are in no group, and all of them without an id stay.
    """
    key = F.struct(
        docs["doc_id"].isNull().alias("unnamed"),
        docs["doc_id"].alias("id"),
        F.unhex(F.md5(docs["text"].cast("binary"))).alias("digest"),
    )
    keyed = docs.withColumn(_KEY, key)
    groups = near_duplicates(keyed.select(F.col(_KEY).alias("doc_id"), "text"))
    kept = groups.where("kept").select(F.col("doc_id").alias("kept_key"), "n_shingles").distinct()
    chosen = keyed.join(kept, F.col(_KEY) == F.col("kept_key"))
    apart = F.col(f"{_KEY}.unnamed") & (F.col("n_shingles") == 0)
    once = chosen.where(~apart).dropDuplicates([_KEY])
    return once.unionByName(chosen.where(apart)).select(*(F.col(f"`{name}`") for name in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the name of its kind in place of each piece of personal data."""
    masked = pii.without_pii(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.with_ids(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.col("decoded").cast("string").alias("decoded"),
    )


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("byte_bpe", token_ids),
]

# Trained models and the hashed search of near duplicates have no SQL; the tests hold each stage
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
