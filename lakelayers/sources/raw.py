"""Raw file scans and the dates that have a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakelayers.sources.files import dates_of


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: T.StructType | None = None,
    infer: bool = False,
    rejected: str | None = None,
) -> DataFrame:
    """Scan raw files.

    CSV has a header. Without a schema every CSV column is text under its header name, which reads one line
    and keeps values such as ``001`` whole; ``infer=True`` lets Spark guess types at the price of a full extra
    pass. Text headers are checked against the schema, so that columns in another order fail instead of
    swapping. JSON needs a schema to avoid a pass of its own; without one its scalars are read as text, or
    typed with ``infer=True``.

    ``rejected`` names a further text column with the whole row where it does not fit the columns: more or fewer
    fields than the header, a value that its type does not take, broken JSON. Every field of a row is then parsed, whatever
    columns are used. It needs a schema.
    """
    if schema is not None and infer:
        raise ValueError("give a schema or infer one, not both")
    if rejected is not None:
        if schema is None:
            raise ValueError("rejected rows are found against a schema")
        schema = T.StructType([*schema.fields, T.StructField(rejected, T.StringType())])
    reader = spark.read if schema is None else spark.read.schema(schema)
    if rejected is not None:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rejected).option("columnPruning", False)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", infer)
        return (reader if infer else reader.option("enforceSchema", False)).csv(path)
    if fmt == "json":
        return reader.option("primitivesAsString", not infer).json(path)
    return reader.format(fmt).load(path)


def available_dates(spark: SparkSession, layout: str) -> DataFrame:
    """The dates (``dt``) for which a file or folder lies under ``layout``, a path with ``{dt}``."""
    return spark.createDataFrame([(dt,) for dt in dates_of(spark, layout)], "dt string")


def pending_dates(available: DataFrame, processed: DataFrame) -> DataFrame:
    """Dates that have a source but were not processed yet."""
    return available.select("dt").distinct().join(processed.select("dt"), "dt", "left_anti")
