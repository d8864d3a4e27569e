"""The training-data pipeline: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakelayers.llm import stages
from lakelayers.llm.common import stored, table
from lakelayers.session import shuffle_width
from lakelayers.sources.files import size_of
from lakelayers.sources.workspace import scratch_since

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("decontamination", stages.decontamination),
    ("mixing", stages.mixing),
]

# The language models have no counterpart in SQL.
ORACLE_SQL = None


# Bytes of a shuffle for each byte of documents as they are stored, compressed.
GROWTH = 4


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``.

    Shuffles are as wide as the documents ask for. Once a stage's result is written, the tables it used on the way
    and the result before it are removed; only the last result is left.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    with shuffle_width(spark, GROWTH * size_of(spark, f"{sf_dir}/documents.parquet")):
        for name, stage in STAGES:
            with scratch_since(spark) as made:
                docs = stored(stage(spark, docs, sf_dir), name)
                result = made.last()
            made.remove(before)
            before = [result]
    return docs
