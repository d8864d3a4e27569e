"""Uniqueness beyond one date: a table of the keys seen so far, by digest, that each date's keys are looked up in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.schemas import PARTITION
from lakelayers.sources.files import exists
from lakelayers.sources.layers import overwrite_layer

_KEYS = f"digest binary, key_count long, {PARTITION} string"


def digest(key: Column) -> Column:
    """16 bytes that stand for a key, whatever its type and length."""
    return F.unhex(F.md5(key.cast("string").cast("binary")))


def register_keys(rows: DataFrame, path: str, key: str) -> None:
    """Replace the digests of the dates in ``rows``: a digest per key and date with its number of rows. Null keys are left out.

    The rows of a date that comes again are replaced with it, so that a key which is no longer delivered is forgotten.
    """
    counted = rows.filter(F.col(key).isNotNull()).groupBy(PARTITION, digest(F.col(key)).alias("digest"))
    counted = counted.agg(F.count(F.lit(1)).alias("key_count"))
    overwrite_layer(counted.select("digest", "key_count", PARTITION).sortWithinPartitions(PARTITION, "digest"), path)


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_KEYS).parquet(path) if exists(spark, path) else spark.createDataFrame([], _KEYS)


def repeated_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``_partition_dt, key, other_dates, first_date``: keys of ``rows`` that the table has under earlier dates.

    The rows are reduced to their keys first. Of the table only 16 bytes a key and its date are read, and no row of an
    earlier date; the shuffle join by digest is one in which Spark drops table rows by a Bloom filter of the looked-up digests where the
    table is large. Two keys share a digest with a probability that no table size makes noticeable.
    """
    own = rows.filter(F.col(key).isNotNull()).select(PARTITION, F.col(key).alias("key")).distinct()
    own = own.withColumn("digest", digest(F.col("key")))
    known = keys.select("digest", F.col(PARTITION).alias("_date"))
    met = own.join(known, "digest").filter(F.col("_date") < F.col(PARTITION))
    return met.groupBy(PARTITION, "key").agg(F.count(F.lit(1)).alias("other_dates"), F.min("_date").alias("first_date"))
