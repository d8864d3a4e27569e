"""Raw files into the bronze layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.operators.clean import add_bronze_metadata
from lakelayers.plans.lake import Lake
from lakelayers.schemas import ORDER_COLUMNS, PARTITION, REJECT_COLUMNS
from lakelayers.sources.files import DATE_LENGTH, before_date, each, exists, literal, remove
from lakelayers.sources.layers import (
    Writer,
    Written,
    append_layer,
    clear_empty,
    overwrite_layer,
    read_dates,
    read_layer,
    rows_by_date,
    write_counted,
    write_days,
)
from lakelayers.sources.ledger import by_date, delivered_files, entries, new_files, read_ledger
from lakelayers.sources.publish import additions, finish, publish, replacements, stored_dates
from lakelayers.sources.raw import read_raw
from lakelayers.sources.types import cast_to, join_schemas


# Fixed value: prefix of a run's id in ``_pipeline_run``.
RUN_PREFIX = "airflow_"


def new_run_id() -> str:
    """Prefix and time."""
    return f"{RUN_PREFIX}{datetime.now(timezone.utc).replace(tzinfo=None).isoformat()}"


def _writer(out: str, mode: str, fmt: str) -> Writer:
    if mode == "append":
        return lambda df: append_layer(df, out, fmt)
    if mode == "overwrite":
        return lambda df: overwrite_layer(df, out, "partition", "replace", fmt)
    raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")


def ingest_to_bronze(
    spark: SparkSession,
    source_path: str,
    dataset: str,
    dt: str,
    out: str,
    raw_format: str = "csv",
    schema: T.StructType | None = None,
    infer: bool = False,
    mode: str = "overwrite",
    fmt: str = "parquet",
    run_id: str | None = None,
    as_of: datetime | None = None,
) -> dict[str, object]:
    """Read one date's files as they are, add lineage columns, write them; one pass over the input."""
    raw = read_raw(spark, source_path, raw_format, schema, infer)
    bronze = add_bronze_metadata(raw, source_path, dt, run_id or new_run_id(), as_of)
    rows = write_counted(bronze, _writer(out, mode, fmt))
    if mode == "overwrite":
        clear_empty(bronze, out, {dt: rows}, fmt)
    return {"dataset": dataset, "row_count": rows, "path": out}


class SourceError(ValueError):
    """The source of a date cannot be used."""


# Fixed by this package: why a date is not brought in, or not carried on.
EMPTY_SOURCE = "[INGEST] source of %s is empty: %s"
MISSING_COLUMNS = "[INGEST] source of %s lacks the columns %s"


@dataclass(frozen=True)
class Source:
    """The dates of a run that can be read, by header, and why some cannot be brought in or carried on.

    ``alike`` pairs dates of one header with the columns as text, or with None where the scan finds them.
    """

    alike: list[tuple[list[str], T.StructType | None]]
    failures: dict[str, str]

    @property
    def dates(self) -> list[str]:
        return sorted(dt for dates, _ in self.alike for dt in dates)


def probe(spark: SparkSession, lake: Lake, dates: Sequence[str]) -> Source:
    """Read each date's header, several at a time, and group the dates by it.

    A date whose header lacks one of the order columns is reported, whatever other dates the run has. With ``infer`` the
    types of a date are found in its own files, so that they do not depend on the dates it runs with. Where types are given, and for
    JSON as text, columns are those of the whole scan, so there is nothing to compare.
    """
    if lake.raw_schema is not None or (lake.raw_format == "json" and not lake.infer):
        return Source([(list(dates), lake.raw_schema)], {})

    def columns(dt: str) -> T.StructType | Exception:
        try:
            return read_raw(spark, literal(lake.raw_path(dt)), lake.raw_format, infer=lake.infer).schema
        except Exception as error:  # noqa: BLE001 -- the date's own failure
            return error

    headers = dict(zip(dates, each(spark, columns, list(dates)), strict=True))
    groups: dict[str, tuple[list[str], T.StructType]] = {}
    failures = {}
    for dt, found in headers.items():
        if isinstance(found, Exception):
            failures[dt] = str(found)
            continue
        groups.setdefault(found.json(), ([], found))[0].append(dt)
        lacking = [c for c in ORDER_COLUMNS if c not in {name.lower() for name in found.names}]
        if lacking:
            failures[dt] = MISSING_COLUMNS % (dt, ", ".join(lacking))
    return Source(list(groups.values()), failures)


def _date_in_path(spark: SparkSession, lake: Lake, dates: Sequence[str]) -> Column:
    """The date in the path of a row's file.

    It stands behind a known part of the path and is cut out by position, once per row: on text files a regular expression here
    costs as much time as parsing the line. A path whose text there is no date of the run is an error.
    """
    before = before_date(spark, lake.raw_layout)
    found = F.col("_metadata.file_path")
    date = F.substr(found, F.locate(before, found) + len(before), F.lit(DATE_LENGTH))
    wrong = F.raise_error(F.concat(F.lit("no date of the run in "), found)).cast("string")
    return F.when(date.isin(*dates), date).otherwise(wrong)


def bronze_frame(
    spark: SparkSession,
    lake: Lake,
    alike: Sequence[tuple[Sequence[str], T.StructType | None]],
    run_id: str,
    as_of: datetime | None = None,
    files: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Raw rows of several dates in one scan; each row's date comes from the path of its file.

    ``alike`` has the dates by header: dates of one header are scanned together, and all get the columns of all, with the
    join of their types where these differ. ``files`` restricts dates to some of their files. With ``rejects="divert"`` the rows that do not
    fit are marked by :data:`~lakelayers.schemas.REJECT_COLUMNS`.
    """
    divert = lake.rejects == "divert"
    frames = []
    for dates, schema in alike:
        paths = [literal(path) for dt in dates for path in (files[dt] if files else [lake.raw_path(dt)])]
        if divert and schema is None:
            schema = read_raw(spark, paths, lake.raw_format, infer=lake.infer).schema
        infer = lake.infer and schema is None
        raw = read_raw(spark, paths, lake.raw_format, schema, infer, REJECT_COLUMNS[0] if divert else None)
        dated = raw.withColumn(PARTITION, _date_in_path(spark, lake, dates))
        frames.append(_with_reasons(dated, schema, lake.raw_format) if divert else dated)
    if len({frame.schema.json() for frame in frames}) > 1:
        joined = join_schemas(frame.schema for frame in frames)
        frames = [cast_to(frame, joined) for frame in frames]
    raw = reduce(DataFrame.unionByName, frames)
    head, tail = lake.raw_layout.split("{dt}")
    source = F.concat(F.lit(head), F.col(PARTITION), F.lit(tail))
    return add_bronze_metadata(raw, source, F.col(PARTITION), run_id, as_of)


# What may stand between two commas of a line, in quotes, with or without commas of its own.
_QUOTED = r'"(?:[^"\\]|\\.)*"'
WRONG_VALUE = "a value does not fit its type"
WRONG_FIELDS = "%d fields in %d columns"
BROKEN = "not readable as %s"


def _with_reasons(raw: DataFrame, schema: T.StructType, fmt: str) -> DataFrame:
    """Why a row was rejected and which file it is from; null for the others."""
    text, reason, file = REJECT_COLUMNS
    row = F.col(text)
    if fmt == "csv":
        n = F.regexp_count(F.regexp_replace(row, _QUOTED, ""), F.lit(",")) + 1
        counted = F.format_string(WRONG_FIELDS, n, F.lit(len(schema)))
        why = F.when(n == len(schema), F.lit(WRONG_VALUE)).otherwise(counted)
    else:
        why = F.lit(BROKEN % fmt)
    return raw.withColumns(
        {reason: F.when(row.isNotNull(), why), file: F.when(row.isNotNull(), F.col("_metadata.file_path"))}
    )


@dataclass(frozen=True)
class Ingested:
    """Rows that went into bronze, their columns, and rows that were diverted, per date."""

    written: Written
    schema: T.StructType
    rejected: dict[str, int] = field(default_factory=dict)


def ingest_days(
    spark: SparkSession,
    lake: Lake,
    dates: Sequence[str],
    run_id: str,
    as_of: datetime | None = None,
    source: Source | None = None,
) -> Ingested:
    """All dates in one job, and the columns written. A scan task reads one date's file: no shuffle sorts out dates.

    Rows that replace their date are written in place. Where deliveries are kept or rows diverted they are written
    to a staging folder once and published by moves, together with the ledger of delivered files and the reject
    table: a repeated call finds its files in the ledger and adds nothing. A publication that an earlier call left unfinished is
    finished first.
    """
    groups = (source or probe(spark, lake, dates)).alike
    groups = [(kept, schema) for group, schema in groups if (kept := [dt for dt in group if dt in dates])]
    if lake.fmt == "parquet":
        finish(spark, lake.bronze)
    if lake.fmt == "parquet" and (lake.bronze_mode == "append" or lake.rejects == "divert"):
        return _ingest_staged(spark, lake, groups, dates, run_id, as_of)
    bronze = bronze_frame(spark, lake, groups, run_id, as_of)
    writer = _writer(lake.bronze, lake.bronze_mode, lake.fmt)
    written = write_days(bronze, writer, lake.bronze, dates, lake.fmt, run_id)
    if lake.bronze_mode == "overwrite":
        clear_empty(bronze, lake.bronze, written.by_date, lake.fmt)
    return Ingested(written, bronze.schema)


def _ingest_staged(spark, lake: Lake, groups, dates: Sequence[str], run_id: str, as_of) -> Ingested:
    append, ledger = lake.bronze_mode == "append", lake.control("deliveries")
    staging = f"{lake.staging(run_id)}-bronze-{uuid4().hex}"
    found = new = None
    if append:
        paths = [lake.raw_path(dt) for dt in dates]
        delivered = delivered_files(spark, paths, _date_in_path(spark, lake, dates))
        new = new_files(delivered, read_ledger(spark, ledger), lake.dataset)
        found = by_date(new)
        groups = [(kept, schema) for group, schema in groups if (kept := [dt for dt in group if dt in found])]
    if groups:
        try:
            moves, columns = _staged_moves(spark, lake, groups, dates, run_id, as_of, staging, found)
            if append:
                entries(new, lake.dataset, run_id).coalesce(1).write.parquet(f"{staging}/ledger")
                moves += additions(spark, f"{staging}/ledger", ledger)
        except BaseException:
            remove(spark, staging)
            raise
        publish(spark, lake.bronze, moves, staging=staging)
    else:
        columns = read_dates(spark, lake.bronze, dates).schema
    # What this run brought in, also if an earlier try of it did.
    stored = _brought_in(read_dates(spark, lake.bronze, dates, schema=_BY_RUN), run_id)
    counts = {dt: stored.get(dt, 0) for dt in dates}
    rejected = {}
    if lake.rejects == "divert":
        diverted = read_rejects(spark, lake)
        rejected = _brought_in(diverted.filter(F.col(PARTITION).isin(*dates)), run_id)
    return Ingested(Written(sum(counts.values()), counts), columns, rejected)


_BY_RUN = T.StructType([T.StructField(name, T.StringType()) for name in ("_pipeline_run", PARTITION)])


def _brought_in(rows: DataFrame, run_id: str) -> dict[str, int]:
    return rows_by_date(rows.filter(F.col("_pipeline_run") == run_id))


def _staged_moves(spark, lake: Lake, groups, dates, run_id, as_of, staging, files):
    """Write the rows once and say which moves publish them."""
    bronze = bronze_frame(spark, lake, groups, run_id, as_of, files)
    columns = bronze.drop(*REJECT_COLUMNS).schema
    rejected: list[str] = []
    if lake.rejects == "keep":
        good = f"{staging}/rows"
        overwrite_layer(bronze, good, "table")
    else:
        marked = bronze.withColumn("_rejected", F.col(REJECT_COLUMNS[0]).isNotNull().cast("string"))
        marked.write.partitionBy("_rejected", PARTITION).parquet(staging)
        good, bad = f"{staging}/_rejected=false", f"{staging}/_rejected=true"
        rejected = stored_dates(spark, bad)
    if lake.bronze_mode == "append":
        moves = additions(spark, good, lake.bronze)
        return moves + (additions(spark, bad, lake.rejected) if rejected else []), columns
    clear_empty(bronze, good, {dt: 0 for dt in set(dates) - set(stored_dates(spark, good))})
    name = uuid4().hex
    moves = replacements(good, lake.bronze, dates, name)
    if lake.rejects == "divert":
        gone = sorted(set(stored_dates(spark, lake.rejected)) & set(dates) - set(rejected))
        moves += replacements(bad, lake.rejected, rejected, name, gone)
    return moves, columns


def read_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    """The reject table: the text of each diverted row, why it was diverted, its file, date and run."""
    names = (*REJECT_COLUMNS, "_pipeline_run", PARTITION)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    if not exists(spark, lake.rejected):
        return spark.createDataFrame([], schema)
    return read_layer(spark, lake.rejected, schema=schema)
