"""Single jobs to submit: ``python -m lakelayers STEP ... --date YYYY-MM-DD``, or with spark-submit.

Steps: ``bronze`` (raw files to a layer), ``silver`` (cleaned, behind the gate), ``gold`` (daily summary), ``day`` (all of
them for one date), ``pending`` (all dates that have a source and no summary).
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from lakelayers.plans.bronze import ingest_to_bronze
from lakelayers.plans.daily import run_days, run_pending
from lakelayers.plans.gold import build_daily_order_summary
from lakelayers.plans.lake import Lake
from lakelayers.plans.silver import transform_orders_silver
from lakelayers.session import get_spark


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lakelayers", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    paths = {
        "bronze": ("source", "out"),
        "silver": ("bronze", "silver"),
        "gold": ("silver", "gold"),
        "day": ("root", "raw"),
        "pending": ("root", "raw"),
    }
    for step, names in paths.items():
        sub = steps.add_parser(step)
        for name in names:
            sub.add_argument(f"--{name}", required=True)
        if step != "pending":
            sub.add_argument("--date", required=True)
        if step != "gold":
            sub.add_argument("--dataset", default="orders")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict[str, object]:
    """Run one step and return what it reports."""
    args = _parser().parse_args(argv)
    spark = spark or get_spark(f"lakelayers {args.step}")
    if args.step == "bronze":
        return ingest_to_bronze(spark, args.source, args.dataset, args.date, args.out)
    if args.step == "silver":
        return transform_orders_silver(spark, args.bronze, args.silver, args.date, dataset=args.dataset)
    if args.step == "gold":
        return build_daily_order_summary(spark, args.silver, args.gold, args.date)
    lake = Lake(args.root, args.raw, args.dataset)
    done = run_pending(spark, lake) if args.step == "pending" else run_days(spark, lake, [args.date])
    return {"run_id": done.run_id, "published": done.published, "skipped": done.skipped}


if __name__ == "__main__":
    print(json.dumps(main()))
