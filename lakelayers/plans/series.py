"""State of metric series that new samples are folded into, without reading the history again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.operators.metrics import COUNTER, series_state
from lakelayers.sources.files import exists, names_in, remove

IDENTITY = ("ts", "metric", "kind", "value")
_CLOSED = "metric string, kind string, value double, ts timestamp"


@dataclass(frozen=True)
class SeriesState:
    """``closed`` has one row per series; ``open`` the samples after the watermark, which may still be repeated."""

    closed: DataFrame
    open: DataFrame
    watermark: object

    def values(self) -> DataFrame:
        """``metric, kind, value``: last value of each gauge, total of each counter."""
        return series_state(_together(self.closed, self.open))


def _together(closed: DataFrame, samples: DataFrame) -> DataFrame:
    columns = ("metric", "kind", "value", "ts")
    return closed.select(*columns).unionByName(samples.select(*columns))


def read_state(spark: SparkSession, path: str, schema: T.StructType | str) -> SeriesState:
    """The newest complete state below ``path``; ``schema`` is that of the samples."""
    version = _newest(spark, path)
    if version is None:
        return SeriesState(spark.createDataFrame([], _CLOSED), spark.createDataFrame([], schema), None)
    closed = spark.read.schema(_CLOSED).parquet(f"{path}/{version}/closed")
    samples = spark.read.schema(schema).parquet(f"{path}/{version}/open")
    mark = spark.read.schema("watermark timestamp").parquet(f"{path}/{version}/watermark").first()
    return SeriesState(closed, samples, mark and mark.watermark)


def _newest(spark: SparkSession, path: str) -> str | None:
    """A version counts once its watermark, which is written last, is complete."""
    versions = [v for v in names_in(spark, path) if exists(spark, f"{path}/{v}/watermark/_SUCCESS")]
    return max(versions, default=None)


def fold(
    spark: SparkSession, path: str, samples: DataFrame, lateness: int, identity: Sequence[str] = IDENTITY
) -> SeriesState:
    """Fold a batch of ``samples`` (``ts, metric, value, kind``) into the state below ``path`` and return the new one.

    The watermark is the time of the newest sample less ``lateness`` seconds and never goes back. Samples up to it are
    closed: summed (counters) or reduced to the latest (gauges). Those after it stay as rows, so that one that comes again, told by
    its ``identity``, counts once. A sample that comes when its time is closed is dropped; ``lateness`` has to be chosen
    so that deliveries repeat and lag by less. Work and state follow the batch and the open samples, not the history.

    Each fold writes a new version and removes those before the last; a fold that dies leaves the version before it, from
    which it can be repeated. Versions are numbered, so one fold runs at a time.
    """
    state = read_state(spark, path, samples.schema)
    fresh = samples if state.watermark is None else samples.filter(F.col("ts") > F.lit(state.watermark))
    waiting = state.open.unionByName(fresh).dropDuplicates(list(identity))
    newest = fresh.agg(F.max("ts")).first()[0]
    mark = state.watermark
    if newest is not None:
        lag = F.timestamp_add("SECOND", F.lit(-lateness), F.lit(newest))
        moved = spark.range(1).select(lag.alias("watermark")).first().watermark
        mark = moved if mark is None else max(mark, moved)
    done = F.lit(False) if mark is None else F.col("ts") <= F.lit(mark)
    closing = _together(state.closed, waiting.filter(done))
    closed = closing.groupBy("metric", "kind").agg(
        F.when(F.col("kind") == COUNTER, F.sum("value")).otherwise(F.max_by("value", F.struct("ts", "value"))).alias("value"),
        F.max("ts").alias("ts"),
    )
    before = _newest(spark, path)
    version = f"{int(before or 0) + 1:012d}"
    remove(spark, f"{path}/{version}")
    closed.select("metric", "kind", "value", "ts").write.parquet(f"{path}/{version}/closed")
    waiting.filter(~done).select(*samples.columns).write.parquet(f"{path}/{version}/open")
    spark.createDataFrame([(mark,)], "watermark timestamp").coalesce(1).write.parquet(f"{path}/{version}/watermark")
    for old in names_in(spark, path):
        if before is not None and old < before:
            remove(spark, f"{path}/{old}")
    return read_state(spark, path, samples.schema)
