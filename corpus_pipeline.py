"""From raw documents to packed sequences: toxicity, near duplicates, repeated passages, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietwire.llm import mixing, ngram_join, packing, substring_dedup, toxicity
from quietwire.llm.common import read
from quietwire.llm.queries import tokenizer
from quietwire.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.accept(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of each group stays, as do all that are in none."""
    return ngram_join.representatives(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.dedup(docs)
    if "n_chars" in docs.columns:
        removed_words = F.col(cut.columns[-2])  # the name may have been taken
        now = F.when(removed_words > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", now.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]
# No SQL expresses the learnt lexicon or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
