"""Ledger of delivered files: which files of which date a layer has taken in, so that none is taken in twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.schemas import PARTITION
from lakelayers.sources.files import exists, literal

# A file is the same delivery as before if it has the same path, length and time of change.
IDENTITY = ("path", "length", "modified")
LEDGER = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField(PARTITION, T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)


def delivered_files(spark: SparkSession, paths: Sequence[str], date: Column) -> DataFrame:
    """``_partition_dt, path, length, modified`` of every file that lies at ``paths`` now.

    Spark lists the files and does not read them, as only their metadata is asked for. Hidden files are left out.
    ``date`` says which date a file belongs to, as a rule by ``_metadata.file_path``.
    """
    files = spark.read.format("binaryFile").load([literal(path) for path in paths])
    return files.select(date.alias(PARTITION), "path", "length", F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def new_files(files: DataFrame, ledger: DataFrame, dataset: str) -> DataFrame:
    """The files that the ledger does not have for this dataset."""
    known = ledger.filter(F.col("dataset") == dataset).select(*IDENTITY)
    return files.join(known, list(IDENTITY), "left_anti")


def entries(files: DataFrame, dataset: str, run_id: str) -> DataFrame:
    """Ledger rows for files that a run takes in."""
    return files.withColumns({"dataset": F.lit(dataset), "run_id": F.lit(run_id)}).select(*LEDGER.names)


def by_date(files: DataFrame) -> dict[str, list[str]]:
    """Paths per date; a list of files, as any reader needs it on the driver."""
    rows = files.groupBy(PARTITION).agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return {row[PARTITION]: row.paths for row in rows}
