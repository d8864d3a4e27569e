"""Session factory and shuffle sizing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # A write of several dates keeps a file open per date instead of sorting its rows by date; a task that meets
    # more dates than this falls back to sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # These two carry meaning: dates are days in UTC, and a partition date stays text when read back.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

SHUFFLE_BYTES_PER_TASK = 128 * 1024 * 1024
# Every map task reports on every reduce partition, so beyond this width the driver's bookkeeping costs more than
# smaller tasks gain; larger partitions spill instead.
MAX_WIDTH = 30_000
WIDTH_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def get_spark(app_name: str, **conf: object) -> SparkSession:
    """Build or reuse a session; ``conf`` (``**{"spark.x": v}``) overrides the defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


@contextmanager
def shuffle_width(spark: SparkSession, input_bytes: int, widest: int = MAX_WIDTH) -> Iterator[int]:
    """Widen the shuffles started inside the block to about 128 MB of input per task, ``widest`` tasks at most.

    Adaptive execution can merge reduce partitions but never add any, so a day of several terabytes would
    otherwise be squeezed into the session's ``spark.sql.shuffle.partitions``. The width is only ever raised.
    """
    before = spark.conf.get(WIDTH_CONF, None)
    current = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    width = max(current, min(widest, -(-input_bytes // SHUFFLE_BYTES_PER_TASK)))
    if width == current:
        yield current
        return
    spark.conf.set(WIDTH_CONF, str(width))
    try:
        yield width
    finally:
        if before is None:
            spark.conf.unset(WIDTH_CONF)
        else:
            spark.conf.set(WIDTH_CONF, before)
