"""From raw documents to packed token sequences: rules, classifier, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again for the next one. All
but the last keep the columns of documents and all rows that they don't reject. Rows are told apart as rows, not by doc_id, so null and
repeated ids lose no document; extra columns, whatever their names, go along; texts of any length are read whole; an empty table gives
an empty table at every stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import shared_folder, unused
from panelforge.llm.near_duplicates import near_duplicates
from panelforge.llm.packing import packed
from panelforge.llm.quality_model import fit_quality, quality_scores
from panelforge.llm.quality_rules import quality_rules

#: A character of a word of near_duplicates.
WORD = r"[^\x20\x09-\x0D]"


def whole_rows(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and each row as a struct, whose fields no operator's columns can clash with."""
    return docs.select(*needed, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep, repeated ones included; a null or empty text is rejected. A text is worked on until a rule rejects it."""
    return quality_rules(whole_rows(docs, "text"), measures=False).where("kept").select("row.*")


def by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, learnt from this stage's own labelled rows, keeps, repeated ones included; a null text is judged as an empty one.

    Without labelled rows nothing is rejected.
    """
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(whole_rows(docs, "doc_id", "text"), model, keep=("row",)).where("predicted = 1").select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One whole row of each group of near-duplicates: that of the least doc_id, a null one last.

    Groups are made of rows, not of ids: a row goes by its id and a 64-bit hash of id and text, so texts under one id, or under none, are
    linked only if they are alike. Rows of equal id and text are one row. Rows without words have nothing to be compared by, and each
    stays.
    """
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    key = unused("row_key", docs.columns)
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("doc_id", "text").alias("print"))
    keyed = docs.where(words).withColumn(key, own)
    kept = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias(key))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # the join has brought the rows of a key together, so the aggregate moves nothing more
    once = keyed.join(kept, key, "left_semi").groupBy(key).agg(F.min(F.struct(*columns)).alias("row"))
    return once.select("row.*").select(*columns).union(docs.where(~words).select(*columns))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their ids, in sequences of 2048 ids at most; a null text is an empty one, and repeated rows are packed one by one."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [("quality rules", by_rules), ("quality classifier", by_classifier), ("near duplicates", one_of_each_group), ("packing", into_sequences)]

#: The classifier's weights and the tokenizer's merges are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each gives is written to the shared folder of the session (spark.checkpoint.dir)."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
