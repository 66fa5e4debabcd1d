"""The training-data pipeline: documents in, packed sequences out.

Each stage takes all rows that the one before it kept.  All but the last return the columns of
documents: the quality rules drop rows, near-duplicate groups shrink to one row, secrets are cut out of texts,
the mix repeats or leaves out whole rows.  The last gives the place of every piece in a sequence.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoptally.llm import mixing, near_dups, packing, quality_rules, secrets
from shoptally.sources.scratch import shared_folder


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_first(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can express neither the network that finds secrets nor the tokenizer; the tests compare stage by stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again by the next.

    A stage's rows are cleared once the next stage has written its own; the last stage's stay.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        if number:
            spark.createDataFrame([], docs.schema).write.mode("overwrite").parquet(f"{folder}/{number - 1}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
