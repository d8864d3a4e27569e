"""Metric samples from run tables, their text form, their names and labels, and the state of each series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric namespace, sample kinds, metric paths.
NAMESPACE = "data_pipeline"
GAUGE = "g"
COUNTER = "c"
ROW_COUNT_PATH = "{layer}.{dataset}.row_count"
PASS_RATE_PATH = "quality.{dataset}.pass_rate"
DURATION_PATH = "task.{task}.duration_seconds"
FAILURE_PATH = "failure.{dag}.{task}"


def _metric(path: str, namespace: str, **parts: str) -> Column:
    """``namespace.path`` with each ``{placeholder}`` replaced by a column."""
    text = f"{namespace}.{path}"
    for name in parts:
        text = text.replace("{" + name + "}", "%s")
    return F.format_string(text, *[F.col(column) for column in parts.values()])


def _sample(df: DataFrame, ts: str, metric: Column, value: Column, kind: str, about: Sequence[str] = ()) -> DataFrame:
    return df.select(
        F.col(ts).alias("ts"),
        metric.alias("metric"),
        value.cast("double").alias("value"),
        F.lit(kind).alias("kind"),
        *about,
    )


def row_count_gauge(runs: DataFrame, namespace: str = NAMESPACE, about: Sequence[str] = ()) -> DataFrame:
    """Rows written, per layer and dataset, by successful runs; ``about`` names further columns to keep."""
    done = runs.filter((F.col("state") == "success") & F.col("row_count").isNotNull())
    metric = _metric(ROW_COUNT_PATH, namespace, layer="layer", dataset="dataset")
    return _sample(done, "finished_at", metric, F.col("row_count"), GAUGE, about)


def pass_rate_gauge(
    summary: DataFrame, ts: Column | None = None, namespace: str = NAMESPACE, about: Sequence[str] = ()
) -> DataFrame:
    """Pass rate in percent; skipped checks have none."""
    checked = summary.filter(~F.col("skipped")).withColumn("_ts", F.current_timestamp() if ts is None else ts)
    metric = _metric(PASS_RATE_PATH, namespace, dataset="dataset")
    return _sample(checked, "_ts", metric, F.col("pass_rate") * 100, GAUGE, about)


def seconds_between(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1e6)


def task_duration(runs: DataFrame, namespace: str = NAMESPACE, about: Sequence[str] = ()) -> DataFrame:
    """Seconds from start to finish, of successful runs only."""
    done = runs.filter(F.col("state") == "success")
    metric = _metric(DURATION_PATH, namespace, task="task_id")
    return _sample(done, "finished_at", metric, seconds_between("started_at", "finished_at"), GAUGE, about)


def failure_samples(runs: DataFrame, namespace: str = NAMESPACE, about: Sequence[str] = ()) -> DataFrame:
    """One counter increment per failed run."""
    failed = runs.filter(F.col("state") == "failed")
    metric = _metric(FAILURE_PATH, namespace, dag="dag_id", task="task_id")
    return _sample(failed, "finished_at", metric, F.lit(1.0), COUNTER, about)


def failure_counter(runs: DataFrame) -> DataFrame:
    """Failures per DAG and task."""
    failed = runs.filter(F.col("state") == "failed")
    return failed.groupBy("dag_id", "task_id").agg(F.count(F.lit(1)).alias("failures"))


def value_text(metric: str, value: str, kind: str) -> Column:
    """Plain decimal text: row counts and counters as whole numbers, other values with their decimals.

    Java writes doubles from 1e7 on (and below 1e-3) with an exponent; those go through a decimal.
    """
    number = F.col(value)
    whole = (F.col(kind) == COUNTER) | F.col(metric).endswith(".row_count")
    size = F.abs(number)
    spelled = F.regexp_replace(number.try_cast("decimal(38,16)").cast("string"), r"(\.\d+?)0+$", "$1")
    short = number.cast("string")
    as_float = F.when((size >= 1e7) | ((size > 0) & (size < 1e-3)), F.coalesce(spelled, short)).otherwise(short)
    integral = whole & (number == F.floor(number)) & (size < 2.0**53)
    return F.when(integral, number.try_cast("bigint").cast("string")).otherwise(as_float)


def encode_metric(samples: DataFrame) -> DataFrame:
    """``line``: ``metric:value|kind``."""
    text = value_text("metric", "value", "kind")
    return samples.withColumn("line", F.concat(F.col("metric"), F.lit(":"), text, F.lit("|"), F.col("kind")))


def decode_metric(lines: DataFrame, line: str = "line") -> DataFrame:
    """``metric, value, kind`` from a line; parts that are missing or no number are NULL."""
    parts = F.split(F.col(line), "[:|]")
    return lines.withColumns(
        {
            "metric": F.get(parts, 0),
            "value": F.get(parts, 1).try_cast("double"),
            "kind": F.get(parts, 2),
        }
    )


@dataclass(frozen=True)
class MetricPattern:
    """A dotted pattern whose ``*`` is one dot-free part; labels take the n-th star."""

    match: str
    name: str
    labels: tuple[str, ...]


# Metric names and labels by pattern, first match wins.
PATTERNS = (
    MetricPattern("data_pipeline.*.*.row_count", "pipeline_row_count", ("layer", "dataset")),
    MetricPattern("data_pipeline.quality.*.pass_rate", "pipeline_quality_pass_rate", ("dataset",)),
    MetricPattern("data_pipeline.task.*.duration_seconds", "pipeline_task_duration_seconds", ("task",)),
    MetricPattern("data_pipeline.failure.*.*", "pipeline_failure_total", ("dag_id", "task_id")),
)


def map_metrics(samples: DataFrame, patterns: Sequence[MetricPattern] = PATTERNS) -> DataFrame:
    """Series ``name`` and ``labels`` of each sample; a metric no pattern fits keeps its name and has no labels.

    Patterns are compared part by part on one split of the metric, without a regular expression per pattern.
    """
    parts = F.col("_parts")
    name, labels = F.col("metric"), F.create_map().cast("map<string,string>")
    for pattern in reversed(patterns):
        words = pattern.match.split(".")
        stars = [i for i, word in enumerate(words) if word == "*"]
        fits = F.size(parts) == len(words)
        for i, word in enumerate(words):
            if word != "*":
                fits = fits & (F.get(parts, i) == word)
        found = []
        for label, i in zip(pattern.labels, stars, strict=True):
            found += [F.lit(label), F.get(parts, i)]
        name = F.when(fits, F.lit(pattern.name)).otherwise(name)
        labels = F.when(fits, F.create_map(*found)).otherwise(labels)
    split = samples.withColumn("_parts", F.split("metric", r"\.", -1))
    return split.withColumns({"name": name, "labels": labels}).drop("_parts")


def series_state(samples: DataFrame, labels: Sequence[str] = (), order: Sequence[str] = ("ts", "value")) -> DataFrame:
    """Last value of each gauge, total of each counter.

    The last value is that of the highest ``order``; by default the larger one of two at the same instant. Samples with
    different ``labels`` are series of their own: a run's samples say their layer, and of days that one run
    finished together the latest day counts (``order=("ts", "partition_date", "value")``).
    """
    last = F.max_by("value", F.struct(*order))
    return samples.groupBy("metric", "kind", *labels).agg(
        F.when(F.col("kind") == COUNTER, F.sum("value")).otherwise(last).alias("value")
    )
