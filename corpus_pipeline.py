"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

quality classifier (documents it rejects go) -> line dedup -> MinHash near-dedup
(one document of each group stays) -> mixing sources to target weights (a
document is repeated or left out as its source's budget says) -> best-fit
packing (one row for each piece of a document with its place in a sequence).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import line_dedup, mixing, near_dedup, packing, quality_classifier
from lakeops.llm._common import stored, table
from lakeops.llm.registry import SEQ_LEN, TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER, SEQ_LEN)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicates),
          ("mixing sources to target weights", mix), ("best-fit packing", pack)]

#: SQL can express neither the classifier nor the signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i + 1}")
    return docs
