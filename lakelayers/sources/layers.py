"""Layer tables: reading, appending, overwriting, and the row count of what was written."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.schemas import PARTITION
from lakelayers.sources.files import each, exists, literal, names_in, size_of
from lakelayers.sources.publish import date_folder, stored_dates
from lakelayers.sources.types import cast_to, join_schemas

Writer = Callable[[DataFrame], None]
# What the names of the files of one job have in common.
_JOB = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def read_layer(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    merge: bool = False,
) -> DataFrame:
    """A layer table. ``merge`` unites the columns of all files, which opens every footer: for small tables."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _dated(reader.option("mergeSchema", merge).format(fmt).load(path))


def read_dates(
    spark: SparkSession,
    path: str,
    dates: Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of the given dates, listing only their folders, however many other dates the table has.

    Without a schema the columns are those of these dates: days whose files have other columns do not matter,
    and several days are read with the columns of all of them, as :func:`read_mixed` does.
    """
    if fmt != "parquet":
        return for_partition(read_layer(spark, path, fmt, schema), *dates)
    there = each(spark, lambda dt: exists(spark, date_folder(path, dt)), list(dates))
    found = [dt for dt, is_there in zip(dates, there, strict=True) if is_there]
    if not found:
        return for_partition(read_layer(spark, path, fmt, schema), *dates)
    if schema is None:
        return read_mixed(spark, path, found)
    reader = spark.read.schema(schema).option("basePath", path)
    return _dated(reader.parquet(*[date_folder(path, dt) for dt in found]))


def read_mixed(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """A Parquet layer whose days differ in columns or types, each column with the join of its types.

    Types that were inferred day by day cannot be read in one scan. The files of one write are alike and are told by the
    name that Spark gives them, so one footer per write is opened, several at a time; writes of one schema are scanned
    together, and what differs is cast to the join (:func:`lakelayers.sources.types.join_types`). A layer without files
    has no columns to read and is an error, as for any reader.
    """
    dates = stored_dates(spark, path) if dates is None else list(dates)
    writes = [write for found in each(spark, lambda dt: _writes(spark, date_folder(path, dt)), dates) for write in found]
    if not writes:
        return spark.read.parquet(path)
    schemas = each(spark, lambda files: spark.read.parquet(files[0]).schema, writes)
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for files, schema in zip(writes, schemas, strict=True):
        alike.setdefault(schema.json(), (schema, []))[1].extend(files)
    partition = T.StructField(PARTITION, T.StringType())
    joined = join_schemas(schema for schema, _ in alike.values())
    joined = T.StructType([*joined.fields, partition])
    frames = [
        cast_to(_dated(spark.read.schema(T.StructType([*schema.fields, partition])).option("basePath", path).parquet(*files)), joined)
        for schema, files in alike.values()
    ]
    return reduce(DataFrame.unionByName, frames)


def _writes(spark: SparkSession, folder: str) -> list[list[str]]:
    """The data files of a folder, together those that one job wrote."""
    found: dict[str, list[str]] = {}
    for name in names_in(spark, folder):
        if name[0] not in "_.":
            job = _JOB.search(name)
            found.setdefault(job[0] if job else name, []).append(literal(f"{folder}/{name}"))
    return list(found.values())


def _dated(df: DataFrame) -> DataFrame:
    """A session that infers partition types reads the date as DATE; the column is text in this data model."""
    if PARTITION in df.columns and df.schema[PARTITION].dataType != T.StringType():
        return df.withColumn(PARTITION, F.col(PARTITION).cast("string"))
    return df


def for_partition(df: DataFrame, *dates: str) -> DataFrame:
    """Rows of the given partition dates; prunes folders on a layer table."""
    column = F.col(PARTITION)
    return df.filter(column == dates[0] if len(dates) == 1 else column.isin(*dates))


def append_layer(df: DataFrame, path: str, fmt: str = "parquet", by: str = PARTITION) -> None:
    """Add rows and keep history; writing the same date again adds its rows again."""
    df.write.format(fmt).mode("append").partitionBy(by).save(path)


def overwrite_layer(
    df: DataFrame,
    path: str,
    scope: str = "partition",
    schema_mode: str = "replace",
    fmt: str = "parquet",
) -> None:
    """Replace the partitions that ``df`` has rows for (``partition``) or everything (``table``).

    ``schema_mode="merge"`` lets columns be added but not change their type; read back with ``merge=True``.
    A partition overwrite on Parquet is atomic per task commit, not a transaction over all partitions.
    """
    modes = {"partition": "dynamic", "table": "static"}
    if scope not in modes or schema_mode not in ("replace", "merge"):
        raise ValueError(f"unknown scope or schema mode: {scope!r}, {schema_mode!r}")
    if schema_mode == "merge":
        _check_mergeable(df, path, fmt)
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", modes[scope])
    if fmt == "delta":
        # Delta takes no new schema together with dynamic overwrite, there columns can only be added.
        whole = schema_mode == "replace" and scope == "table"
        writer = writer.option("overwriteSchema" if whole else "mergeSchema", True)
    writer.partitionBy(PARTITION).save(path)


def clear_empty(df: DataFrame, path: str, by_date: Mapping[str, int], fmt: str = "parquet") -> None:
    """Empty the dates that were written without rows; a dynamic overwrite leaves such a date as it was."""
    empty = df.sparkSession.createDataFrame([], df.drop(PARTITION).schema)
    for dt in (dt for dt, rows in by_date.items() if rows == 0):
        empty.write.format(fmt).mode("overwrite").save(f"{path}/{PARTITION}={dt}")


def _check_mergeable(df: DataFrame, path: str, fmt: str) -> None:
    if not exists(df.sparkSession, path) or not size_of(df.sparkSession, path):
        return  # nothing is stored yet
    stored = df.sparkSession.read.format(fmt).load(path).schema
    types = {field.name: field.dataType for field in stored if field.name != PARTITION}
    changed = [f.name for f in df.schema if types.get(f.name, f.dataType) != f.dataType]
    if changed:
        raise ValueError(f"cannot merge into {path}: type of {changed} differs from the stored table")


def write_counted(df: DataFrame, writer: Writer) -> int:
    """Write ``df`` and count its rows in the same job.

    The counter sits directly under the write, in the job's last stage, where Spark counts each finished task
    once even if executors are lost and tasks run again.
    """
    observed = Observation()
    writer(df.observe(observed, F.count(F.lit(1)).alias("rows")))
    return observed.get["rows"]


@dataclass(frozen=True)
class Written:
    """Row count of one write, per partition date as well."""

    rows: int
    by_date: dict[str, int]


def write_days(
    df: DataFrame, writer: Writer, path: str, dates: Sequence[str], fmt: str = "parquet", run_id: str | None = None
) -> Written:
    """Write rows of the given dates and count them per date.

    One date needs no more than the counted write. Counts of several dates come from the written files, where
    only row counts are read; with ``run_id`` rows of earlier deliveries are left out.
    """
    rows = write_counted(df, writer)
    if len(dates) == 1:
        return Written(rows, {dates[0]: rows})
    stored = read_dates(df.sparkSession, path, dates, fmt, schema=df.schema)
    if run_id is not None:
        stored = stored.filter(F.col("_pipeline_run") == run_id)
    found = rows_by_date(stored)
    return Written(rows, {dt: found.get(dt, 0) for dt in dates})


def rows_by_date(df: DataFrame) -> dict[str, int]:
    """Rows per partition date; on a layer table no data column is read, and there is one row per date."""
    return {row[PARTITION]: row["count"] for row in df.groupBy(PARTITION).count().collect()}
