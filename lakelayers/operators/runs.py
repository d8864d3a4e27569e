"""Run history: missed SLAs, attempts, alert messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayers.operators.metrics import seconds_between

# Allowed seconds per task, counted from the scheduled time.
TASK_SLA = {
    "ingest_bronze": 30 * 60,
    "quality_bronze.validate_bronze": 15 * 60,
    "transform_silver": 60 * 60,
    "build_gold": 30 * 60,
}

# Retries after the first attempt, longest allowed attempt in seconds.
RETRIES = 2
TIME_LIMIT = 2 * 60 * 60

# Seconds between attempts, and between scheduled times.
RETRY_DELAY = 5 * 60
DAY = 24 * 60 * 60

# Alert prefix by level, and for any other level.
EMOJI = {"error": "❌", "warning": "⚠️", "info": "✅"}
OTHER_EMOJI = "ℹ️"

# Alert texts.
ALERT_TEXT = "%s *[DataPipeline]* %s"
FAILURE_ALERT = "DAG `%s` | Task `%s` FAILED\nExecution: %s\nLog: %s"
SLA_ALERT = "SLA MISS on DAG `%s`: tasks %s"


def sla_miss(runs: DataFrame, sla: Mapping[str, int] = TASK_SLA, as_of: datetime | None = None) -> DataFrame:
    """Runs that finished later than their task allows after the scheduled time.

    The allowances are a literal map in the plan, so no join is needed, and the task filter reaches the scan.
    With ``as_of``, runs that have not finished count with that time.
    """
    allowed = F.create_map(*[F.lit(x) for pair in sla.items() for x in pair])
    end = F.col("finished_at") if as_of is None else F.coalesce("finished_at", F.lit(as_of))
    limited = runs.filter(F.col("task_id").isin(*sla))
    timed = limited.withColumns({"sla_seconds": F.element_at(allowed, F.col("task_id")), "_end": end})
    late = seconds_between("scheduled_at", "_end") - F.col("sla_seconds")
    return timed.withColumn("late_seconds", late).filter("late_seconds > 0").drop("_end")


def expected_runs(
    spans: DataFrame, sla: Mapping[str, int] = TASK_SLA, every: int = DAY, offset: int = 0
) -> DataFrame:
    """``dag_id, task_id, scheduled_at, due_at``: what should run, one row per task and scheduled time.

    ``spans`` has ``dag_id, first, last``: the first and last scheduled time of each DAG, ``every`` seconds apart, at
    ``offset`` seconds after full multiples of that. A span that does not begin on a scheduled time begins with the next one.
    """
    at = F.unix_seconds(F.col("first")) - offset
    begin = F.timestamp_seconds(F.ceil(at / every) * every + offset)
    tasks = F.create_map(*[F.lit(x) for pair in sla.items() for x in pair])
    slots = spans.withColumn("_begin", begin).filter("_begin <= last")
    slots = slots.select("dag_id", F.explode(F.sequence("_begin", "last", F.expr(f"INTERVAL {int(every)} SECONDS"))).alias("scheduled_at"))
    rows = slots.select("dag_id", "scheduled_at", F.explode(tasks).alias("task_id", "_allowed"))
    due = F.timestamp_add("SECOND", F.col("_allowed"), F.col("scheduled_at"))
    return rows.select("dag_id", "task_id", "scheduled_at", due.alias("due_at"))


def sla_status(expected: DataFrame, runs: DataFrame, as_of: datetime | Column, every: int = DAY, offset: int = 0) -> DataFrame:
    """``expected`` with ``attempts``, ``finished_at`` and ``status`` by ``as_of``, also of tasks that never ran.

    A run belongs to the last scheduled time at or before its own. That range condition is an equality of slots, so the
    join needs no nested loop, and runs are reduced to one row per task and slot before it. ``finished_at`` is the first success.
    ``status``: ``in_time`` and ``late`` for a success, ``failed`` where all attempts that ended failed, ``running`` where one
    has not ended, ``absent`` without any attempt; ``pending`` instead of the last three while the task is not due.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    slot = F.floor((F.unix_seconds(F.col("scheduled_at")) - offset) / every)
    ended = F.col("finished_at") <= now
    success = ended & (F.col("state") == "success")
    known = runs.filter(F.col("started_at") <= now).groupBy("dag_id", "task_id", slot.alias("_slot"))
    known = known.agg(
        F.count(F.lit(1)).alias("attempts"),
        F.min(F.when(success, F.col("finished_at"))).alias("finished_at"),
        F.count_if(~F.coalesce(ended, F.lit(False))).alias("_open"),
    )
    joined = expected.withColumn("_slot", slot).join(known, ["dag_id", "task_id", "_slot"], "left")
    done = F.col("finished_at")
    status = (
        F.when(done <= F.col("due_at"), "in_time")
        .when(done.isNotNull(), "late")
        .when(F.col("due_at") > now, "pending")
        .when(F.col("attempts").isNull(), "absent")
        .when(F.col("_open") > 0, "running")
        .otherwise("failed")
    )
    counted = F.coalesce("attempts", F.lit(0).cast("long")).alias("attempts")
    return joined.select("dag_id", "task_id", "scheduled_at", "due_at", counted, "finished_at", status.alias("status"))


def sla_absent(expected: DataFrame, runs: DataFrame, as_of: datetime | Column, every: int = DAY, offset: int = 0) -> DataFrame:
    """Tasks that are due and of which no run was seen; a report of late runs cannot show them."""
    return sla_status(expected, runs, as_of, every, offset).filter(F.col("status") == "absent")


def attempt_episodes(
    runs: DataFrame, keys: Sequence[str] = ("dag_id", "task_id"), gap: int = RETRY_DELAY, piece: int = DAY
) -> DataFrame:
    """Attempts that belong together: an attempt that starts up to ``gap`` seconds after all earlier ones ended continues their episode.

    ``first_start, last_end, attempts, failures, final_state, overlapping`` per episode; ``overlapping`` counts the attempts that
    started while an earlier one of the episode was running. An attempt that has not ended counts as ending when it
    starts; equal starts are ordered by end and state. Attempts without a start are left out.

    The history of one task may be most of the table, so no window spans it: windows are over pieces of ``piece`` seconds, and
    what a piece needs of earlier ones, the latest end and the start of the open episode, comes from a table of one row per piece.
    """
    about = [*keys, "_piece"]
    start, end = F.unix_micros("started_at"), F.unix_micros(F.coalesce("finished_at", "started_at"))
    rows = runs.filter(F.col("started_at").isNotNull()).withColumns({"_start": start, "_end": F.greatest(start, end)})
    rows = rows.withColumn("_piece", F.floor(F.col("_start") / (piece * 1_000_000)))
    by = [*map(F.col, keys)]
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    order = ("_start", "_end", "state")
    within = Window.partitionBy(*about).orderBy(*order)

    ends = rows.groupBy(*about).agg(F.max("_end").alias("_last")).withColumn("_earlier", F.max("_last").over(before))
    rows = _beside(rows, ends.drop("_last"), about)
    own = F.max("_end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_until", F.greatest(own, F.col("_earlier"))).drop("_earlier")
    opens = F.col("_until").isNull() | (F.col("_start") - F.col("_until") > gap * 1_000_000)
    rows = rows.withColumns({"_opens": F.when(opens, F.col("_start")), "_over": F.col("_start") < F.col("_until")})

    first = rows.groupBy(*about).agg(F.max("_opens").alias("_opened")).withColumn("_open", F.max("_opened").over(before))
    rows = _beside(rows, first.drop("_opened"), about)
    episode = F.coalesce(F.max("_opens").over(within.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open"))
    last = F.max_by("state", F.struct(*order))
    return (
        rows.withColumn("_episode", episode)
        .groupBy(*by, "_episode")
        .agg(
            F.timestamp_micros(F.max("_end")).alias("last_end"),
            F.count(F.lit(1)).alias("attempts"),
            F.count_if(F.col("state") == "failed").alias("failures"),
            last.alias("final_state"),
            F.count_if("_over").alias("overlapping"),
        )
        .select(*keys, F.timestamp_micros("_episode").alias("first_start"), "last_end", "attempts", "failures", "final_state", "overlapping")
    )


def _beside(rows: DataFrame, pieces: DataFrame, about: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of their piece; null keys meet as well."""
    named = pieces.withColumnsRenamed({c: f"_of{c}" for c in about})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in about])
    return rows.join(named, same, "left").drop(*[f"_of{c}" for c in about])


def attempts(
    runs: DataFrame,
    keys: Sequence[str] = ("dag_id", "task_id", "partition_date"),
    retries: int = RETRIES,
    time_limit: int = TIME_LIMIT,
) -> DataFrame:
    """Attempts per task and date, state of the last one, whether retries are used up, attempts over the time limit.

    A repeated run has a run id of its own, so by default runs of one date are the attempts of that date.
    """
    last = F.max_by("state", F.struct("started_at", "finished_at", "state"))
    over = seconds_between("started_at", "finished_at") > time_limit
    counted = runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempts"),
        last.alias("final_state"),
        F.count_if(over).alias("over_time"),
    )
    exhausted = (F.col("final_state") == "failed") & (F.col("attempts") > retries)
    return counted.withColumn("exhausted", exhausted)


def alert_messages(df: DataFrame, level: str | Column, text: str = "text") -> DataFrame:
    """``message``: the alert text with its prefix; ``level`` is a fixed level or a column."""
    wanted = F.lit(level) if isinstance(level, str) else level
    emoji = F.lit(OTHER_EMOJI)
    for name, sign in EMOJI.items():
        emoji = F.when(wanted == name, F.lit(sign)).otherwise(emoji)
    return df.withColumn("message", F.format_string(ALERT_TEXT, emoji, F.col(text)))


def failure_alerts(
    runs: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss", about: Sequence[str] = ()
) -> DataFrame:
    """One message per failed run; ``about`` names further columns to keep."""
    text = F.format_string(
        FAILURE_ALERT,
        "dag_id",
        "task_id",
        F.date_format("scheduled_at", ts_format),
        "log_url",
    )
    failed = runs.filter(F.col("state") == "failed").withColumn("text", text)
    return alert_messages(failed, "error").select("run_id", "dag_id", "task_id", *about, "message")


def sla_alerts(misses: DataFrame) -> DataFrame:
    """One message per DAG that names its late tasks.

    Misses are first reduced to distinct (DAG, task) pairs with partial aggregation, so the list of a DAG
    is as long as its task list, not as its history.
    """
    tasks = misses.select("dag_id", "task_id").distinct()
    listed = tasks.groupBy("dag_id").agg(F.array_sort(F.collect_list("task_id")).alias("tasks"))
    names = F.concat(F.lit("['"), F.array_join("tasks", "', '"), F.lit("']"))
    text = F.format_string(SLA_ALERT, F.col("dag_id"), names)
    return alert_messages(listed.withColumn("text", text), "warning").select("dag_id", "message")
