"""Training documents in four stages: quality rules, toxicity, near copies, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return rows of the columns they got. Nulls: a row with a null text has no words and
goes with the quality rules; a row with a null doc_id is judged by its text like any
other, may be a copy, and is packed if it stays. Rows that repeat a doc_id are judged one
by one. Empty texts go with the quality rules, very long ones are read whole, columns of
any name pass through, and empty tables give empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm import jaccard, packing, quality_rules, toxicity
from tallyroll.llm.common import land


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy of the quality rules."""
    return quality_rules.keep_passing(docs)


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with P(grade >= 1) below 0.5, by a model fitted on the labelled ones among them."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each component of near copies: that with the smallest doc_id (null last), of equal ids any one.

    Rows are told apart by a number of their own, so repeated and null ids are copies
    like others, and a row stays or goes by its own text.
    """
    numbered = land(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    classes = land(jaccard.jaccard_classes(numbered, width=5, percent=75, id_col="__row").filter("n_copies > 1 OR component_id <> __row").select(
        F.col("__row").alias("__copy"), F.col("component_id").alias("__of")), "classes")
    # Components are told by their smallest row, which may itself be missing above: it is added with its own number.
    members = classes.select("__copy", "__of").unionAll(classes.select("__of", "__of")).distinct()
    ids = numbered.select(F.col("__row").alias("__id_row"), F.col("doc_id").alias("__id"))
    first = members.join(ids, F.col("__copy") == F.col("__id_row")).groupBy("__of").agg(
        F.min(F.struct(F.col("__id").isNull(), "__id", "__copy")).alias("__first")).select(F.col("__first")["__copy"].alias("__stays"))
    copies = land(members.select("__copy").join(first, F.col("__copy") == F.col("__stays"), "left_anti"), "copies")
    return numbered.join(copies, F.col("__row") == F.col("__copy"), "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=2048, end_id=1).drop("source")


STAGES = [("quality_rules", quality), ("toxicity", non_toxic), ("ngram_jaccard", one_of_each_group), ("packing", packed)]
#: The toxicity model and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = land(docs, f"pipeline-{name}")
    return docs
