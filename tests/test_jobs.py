"""Single steps from the command line, and the jobs and write plans of a run, from Spark's event log."""

import json
import re
import subprocess
import sys
from pathlib import Path

import pytest

from lakelayers.__main__ import main
from lakelayers.sources.layers import read_layer

HEADER = "order_id,customer_id,amount,order_date,status\n"
DAY = HEADER + "1,a,1,2024-01-01,SHIPPED\n2,b,2,2024-01-01,SHIPPED\n2,b,3,2024-01-01,SHIPPED\n"
ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
from lakelayers.plans.daily import run_days
from lakelayers.plans.lake import Lake
from lakelayers.session import get_spark

base, *dates = sys.argv[1:]
spark = get_spark("jobs", **{"spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
                             "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{base}/events",
                             "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
run_days(spark, Lake(f"{base}/lake", f"{base}/raw"), dates)
spark.stop()
"""


def test_main(spark, tmp_path):
    raw = tmp_path / "raw" / "orders" / "2024-01-01.csv"
    raw.parent.mkdir(parents=True)
    raw.write_text(DAY)
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    date = ["--date", "2024-01-01"]
    assert main(["bronze", "--source", str(raw), "--out", bronze, *date], spark)["row_count"] == 3
    done = main(["silver", "--bronze", bronze, "--silver", silver, *date], spark)
    assert (done["row_count"], done["duplicates"]) == (2, 1)
    assert main(["gold", "--silver", silver, "--gold", gold, *date], spark)["row_count"] == 1
    assert read_layer(spark, gold).collect()[0].total_orders == 2
    lake = ["--root", str(tmp_path / "lake"), "--raw", str(tmp_path / "raw")]
    assert main(["pending", *lake], spark)["published"] == ["2024-01-01"]
    assert main(["pending", *lake], spark)["published"] == []
    assert main(["day", *lake, "--date", "2024-01-02"], spark)["skipped"] == ["2024-01-02"]
    with pytest.raises(SystemExit):
        main(["copper"], spark)


@pytest.mark.parametrize("dates", [["2024-01-01"], ["2024-01-01", "2024-01-02", "2024-01-03"]])
def test_jobs_of_a_run(tmp_path, dates):
    for dt in dates:
        raw = tmp_path / "raw" / "orders" / f"{dt}.csv"
        raw.parent.mkdir(parents=True, exist_ok=True)
        raw.write_text(DAY)
    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path), *dates], cwd=ROOT, check=True, capture_output=True)
    (log,) = (tmp_path / "events").iterdir()
    events = [json.loads(line) for line in log.open()]
    jobs = sum(e["Event"] == "SparkListenerJobStart" for e in events)
    writes = {}
    for event in events:
        if "sparkPlanInfo" in event:
            nodes = []
            stack = [event["sparkPlanInfo"]]
            while stack:
                node = stack.pop()
                nodes.append(node["simpleString"])
                stack += node["children"]
            if any("InsertIntoHadoopFsRelationCommand" in n and "_partition_dt" in n for n in nodes):
                writes[event["executionId"]] = nodes
    # One write each for bronze, silver (to staging, whose folders are then moved) and gold; none sorts its rows by date.
    assert len(writes) == 3
    assert not [n for nodes in writes.values() for n in nodes if re.match(r"Sort \[_partition_dt#\d+ [A-Z ]+\]", n)]
    # Adaptive execution makes a job of every shuffle; five of the jobs append to the control tables.
    assert jobs <= (21 if len(dates) == 1 else 31), jobs
