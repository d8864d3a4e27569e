"""The daily run: source check, bronze, gate, silver with gate, gold, metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from time import sleep

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.operators.metrics import (
    failure_samples,
    pass_rate_gauge,
    row_count_gauge,
    task_duration,
)
from lakelayers.operators.quality import QualityGateError, parses_as_money
from lakelayers.operators.runs import TASK_SLA, failure_alerts, sla_alerts, sla_miss
from lakelayers.plans.bronze import EMPTY_SOURCE, ingest_days, new_run_id, probe
from lakelayers.plans.errors import names_data
from lakelayers.plans.gold import build_days
from lakelayers.plans.lake import Lake
from lakelayers.plans.silver import Checked, Silver, check_dates, transform_days
from lakelayers.schemas import ALERTS, RUNS
from lakelayers.session import shuffle_width
from lakelayers.sources.files import each, exists, sizes_of
from lakelayers.sources.layers import Written, read_dates, read_layer
from lakelayers.sources.raw import available_dates, pending_dates

# Names under which runs are recorded.
DAG_ID = "orders_pipeline"
SKIP = "skip_no_source"
INGEST = "ingest_bronze"
VALIDATE = "quality_bronze.validate_bronze"
TRANSFORM = "transform_silver"
BUILD = "build_gold"


@dataclass
class DayRun:
    """What a run did: dates by outcome, and its records."""

    run_id: str
    skipped: list[str] = field(default_factory=list)
    published: list[str] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)
    duplicates: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    records: list[tuple] = field(default_factory=list)
    checks: list[tuple[str, Checked]] = field(default_factory=list)
    errors: list[Exception] = field(default_factory=list)

    def record(self, lake, task, layer, started, states: Mapping[str, str], rows=None, path=None) -> None:
        finished = _now()
        for dt, state in states.items():
            scheduled = datetime.fromisoformat(dt).replace(tzinfo=timezone.utc) + timedelta(days=1)
            count = None if rows is None else rows.get(dt)
            log = f"{lake.root}/logs/{DAG_ID}/{task}/{self.run_id}"
            subject = (self.run_id, DAG_ID, task, lake.dataset, layer, dt)
            self.records.append((*subject, scheduled, started, finished, state, count, path, log))


def _now() -> datetime:
    return datetime.now(timezone.utc)


def processed_dates(spark: SparkSession, lake: Lake) -> DataFrame:
    """Dates whose summary was built, from the run table."""
    runs = read_layer(spark, lake.control("runs"), schema=RUNS)
    built = (F.col("task_id") == BUILD) & (F.col("state") == "success")
    return runs.filter(built).select(F.col("partition_date").alias("dt")).distinct()


def find_pending(spark: SparkSession, lake: Lake) -> list[str]:
    """Dates with a source that have no summary yet; a list of days, so small enough for the driver."""
    available = available_dates(spark, lake.raw_layout)
    if exists(spark, lake.control("runs")):
        available = pending_dates(available, processed_dates(spark, lake))
    return sorted(row.dt for row in available.collect())


def run_days(
    spark: SparkSession, lake: Lake, dates: Sequence[str], as_of: datetime | None = None
) -> DayRun:
    """Bring the given dates through all layers, each layer in one job for all of them.

    A date without source is skipped. A date whose source cannot be read or lacks a column, that fails a gate or in
    whose rows a step breaks is left out of the later layers; the others are published, then the error is raised.
    Such a date stays pending. Run records, check results, metrics and alerts are written in any case. The day
    list and everything recorded about it is small; rows stay in tables.
    """
    wanted = sorted({date.fromisoformat(dt).isoformat() for dt in dates})
    run = DayRun(new_run_id())
    try:
        _run(spark, lake, wanted, run, as_of)
    finally:
        emit_metrics(spark, lake, run)
    if run.errors:
        raise run.errors[0]
    if run.failures:
        raise QualityGateError("\n".join(run.failures.values()))
    return run


def run_day(spark: SparkSession, lake: Lake, dt: str, as_of: datetime | None = None) -> DayRun:
    return run_days(spark, lake, [dt], as_of)


def run_pending(spark: SparkSession, lake: Lake, as_of: datetime | None = None) -> DayRun:
    """Run every date that has a source and no summary."""
    return run_days(spark, lake, find_pending(spark, lake), as_of)


def _run(spark, lake: Lake, dates: list[str], run: DayRun, as_of) -> None:
    started = _now()
    sizes = sizes_of(spark, lake.raw_layout, dates)
    run.skipped = [dt for dt in dates if dt not in sizes]
    run.record(lake, SKIP, None, started, dict.fromkeys(run.skipped, "success"))
    dates = [dt for dt in dates if dt in sizes]
    if not dates:
        return

    def step(task: str, layer: str | None, todo: list[str], job: Callable[[list[str]], object]) -> list[tuple]:
        """Run one layer's job for all dates.

        If it breaks for another reason than its data, the same dates are tried again, and all fail if that does not help. If the
        error names data, either half of the dates is run, so that a bad date is left alone. Returns begin, dates and
        outcome of what went through. A date that breaks the job by itself is recorded. Where a step leaves nothing but
        its own dates (``scope="table"``), halves would replace each other: all dates fail.
        """
        whole = lake.scope == "table" and layer in ("silver", "gold")
        for tried in range(lake.retries + 1):
            begun = _now()
            try:
                return [(begun, todo, job(todo))]
            except Exception as error:  # noqa: BLE001 -- kept for the end of the run
                if names_data(error):
                    if len(todo) > 1 and not whole:
                        half = len(todo) // 2
                        return step(task, layer, todo[:half], job) + step(task, layer, todo[half:], job)
                elif tried < lake.retries:
                    run.record(lake, task, layer, begun, dict.fromkeys(todo, "up_for_retry"))
                    sleep(lake.retry_wait)
                    continue
                run.record(lake, task, layer, begun, dict.fromkeys(todo, "failed"))
                run.errors.append(error)
                return []
        return []

    def left_out(task: str, layer: str | None, failures: Mapping[str, str]) -> None:
        run.failures.update(failures)
        run.record(lake, task, layer, _now(), dict.fromkeys(failures, "failed"))

    with shuffle_width(spark, sum(sizes.values()), lake.widest):
        empty = {dt: EMPTY_SOURCE % (dt, lake.raw_path(dt)) for dt in dates if not sizes[dt]}
        source = probe(spark, lake, [dt for dt in dates if dt not in empty])
        unread = {dt: text for dt, text in source.failures.items() if dt not in source.dates}
        left_out(INGEST, "bronze", empty | unread)
        dates = source.dates

        columns: list[T.StructType] = []
        counts: dict[str, int] = {}

        def ingest(todo: list[str]) -> Written:
            done = ingest_days(spark, lake, todo, run.run_id, as_of, source)
            columns.append(done.schema)
            counts.update(done.written.by_date)
            run.rejected.update(done.rejected)
            return done.written

        done = step(INGEST, "bronze", dates, ingest) if dates else []
        for begun, todo, written in done:
            run.record(lake, INGEST, "bronze", begun, dict.fromkeys(todo, "success"), written.by_date, lake.bronze)
        lacking = {dt: text for dt, text in source.failures.items() if dt in counts}
        left_out(VALIDATE, None, lacking)
        dates = [dt for _, todo, _ in done for dt in todo if dt not in lacking]
        # Days run in one job have one schema; halves of a broken one may differ, then the files are asked.
        schema = columns[0] if len(columns) == 1 and lake.bronze_mode == "overwrite" else None

        def validate(todo: list[str]) -> Checked:
            rows = read_dates(spark, lake.bronze, todo, lake.fmt, schema)
            rules = [*lake.rules, parses_as_money("amount")] if lake.rules else []
            return check_dates(rows, rules, lake.dataset, todo, lake.threshold, lake.bronze_gate == "raise")

        passed = []
        for begun, todo, checked in step(VALIDATE, None, dates, validate) if dates else []:
            run.checks.append(("bronze", checked))
            stopped = checked.failures if lake.bronze_gate == "raise" else {}
            run.failures.update(stopped)
            run.record(lake, VALIDATE, None, begun, {dt: "failed" if dt in stopped else "success" for dt in todo})
            passed += [dt for dt in todo if dt not in stopped]

        def transform(todo: list[str]) -> Silver:
            return transform_days(
                spark,
                lake.bronze,
                lake.silver,
                lake.staging(run.run_id),
                todo,
                dataset=lake.dataset,
                rules=lake.rules,
                threshold=lake.threshold,
                scope=lake.scope,
                fmt=lake.fmt,
                as_of=as_of,
                order_by=lake.order_by,
                schema=schema,
                rows_in=counts if lake.bronze_mode == "overwrite" else None,
            )

        ready = []
        for begun, todo, silver in step(TRANSFORM, "silver", passed, transform) if passed else []:
            run.checks.append(("silver", silver.checked))
            run.duplicates.update(silver.duplicates)
            run.failures.update(silver.checked.failures)
            states = {dt: "failed" if dt in silver.checked.failures else "success" for dt in todo}
            run.record(lake, TRANSFORM, "silver", begun, states, silver.written.by_date, lake.silver)
            ready += silver.checked.passed

        def build(todo: list[str]) -> Written:
            return build_days(spark, lake.silver, lake.gold, todo, lake.scope, lake.fmt, as_of)

        for begun, todo, gold in step(BUILD, "gold", ready, build) if ready else []:
            run.record(lake, BUILD, "gold", begun, dict.fromkeys(todo, "success"), gold.by_date, lake.gold)
            run.published += todo


def emit_metrics(spark: SparkSession, lake: Lake, run: DayRun) -> None:
    """Append the run's records, check results, metric samples and alerts to the control tables.

    A row count belongs to a layer and date, a pass rate to the gate's layer and date at the time the gate was done, a
    duration to a task of the run, as all its dates are one job.
    """
    if not run.records:
        return
    runs = spark.createDataFrame(run.records, RUNS).coalesce(1)
    once = runs.dropDuplicates(["run_id", "task_id", "started_at", "finished_at"])
    about, nothing = ("layer", "partition_date"), F.lit(None).cast("string")
    whole_job = task_duration(once, about=("layer",)).withColumn("partition_date", nothing)
    samples = [row_count_gauge(runs, about=about), failure_samples(runs, about=about), whole_job]
    gates = {"bronze": VALIDATE, "silver": TRANSFORM}
    writes: list[tuple[DataFrame, str]] = []
    finished = {(r[2], r[5]): r[8] for r in run.records}
    for table, part in (("quality_rules", "results"), ("quality_summary", "summary"), ("quality_examples", "examples")):
        tables = [
            getattr(checked, part).withColumns({"layer": F.lit(layer), "run_id": F.lit(run.run_id)})
            for layer, checked in run.checks
            if getattr(checked, part) is not None
        ]
        if tables:
            writes.append((reduce(DataFrame.unionByName, tables), lake.control(table)))
    for layer, checked in run.checks:
        dates = [*checked.passed, *checked.failures]
        times = {dt: finished[gates[layer], dt] for dt in dates if (gates[layer], dt) in finished}
        ts = F.lit(max(times.values())) if times else None
        summary = checked.summary.withColumn("layer", F.lit(layer))
        samples.append(pass_rate_gauge(summary, ts, about=about))
    writes.append((reduce(DataFrame.unionByName, samples), lake.control("metric_samples")))
    writes.append((runs, lake.control("runs")))
    failed = failure_alerts(runs, about=("partition_date",))
    expected = spark.createDataFrame([*run.records, *_never_ran(run)], RUNS).coalesce(1)
    late = sla_alerts(sla_miss(expected, as_of=_now()))
    late = late.withColumns({"run_id": F.lit(run.run_id), "task_id": nothing, "partition_date": nothing})
    alerts = failed.unionByName(late)
    writes.append((alerts.select(*ALERTS.names), lake.control("alerts")))
    # Small jobs, each on a table of its own: they wait for each other no longer than for the slowest.
    each(spark, lambda write: _append(*write), writes)


def _never_ran(run: DayRun) -> list[tuple]:
    """Records of the tasks of the run's dates that were not even tried, because a step before them failed.

    The run's own few records tell; :func:`lakelayers.operators.runs.sla_absent` finds them in a whole history.
    """
    tried = {(r[2], r[5]) for r in run.records}
    first = {r[5]: r for r in run.records if r[2] != SKIP}
    return [
        (r[0], r[1], task, r[3], None, dt, r[6], None, None, "absent", None, None, None)
        for dt, r in first.items()
        for task in TASK_SLA
        if (task, dt) not in tried
    ]


def _append(df: DataFrame, path: str) -> None:
    """The control tables get one file per run."""
    df.coalesce(1).write.mode("append").parquet(path)
