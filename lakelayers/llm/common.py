"""What the operators share: reading tables, tables between steps, text pieces."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.sources.workspace import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The ASCII white space of all contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(
    df: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with the package sent along, as executors need not have it installed."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def apply_arrow(
    df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table], schema: str | T.StructType
) -> DataFrame:
    """``applyInArrow`` per group of ``keys``; a group has to fit in a task, so callers bound its rows."""
    _ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(function, schema)


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="lakelayers-")) / "lakelayers.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other letters left alone; ``lower`` is the quick way where there are no others."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_hash(text: Column) -> Column:
    """Tells rows of one id with different texts apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns of ``df`` as one struct, so that no name of theirs can clash."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` on division by ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part
