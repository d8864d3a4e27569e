"""Raw scans, listings, layer tables, the shared folder."""

import pytest

from lakelayers.schemas import PARTITION, RAW_ORDERS
from lakelayers.session import MAX_WIDTH, WIDTH_CONF, get_spark, shuffle_width
from lakelayers.sources import workspace
from lakelayers.sources.layers import (
    append_layer,
    clear_empty,
    for_partition,
    overwrite_layer,
    read_layer,
    rows_by_date,
    write_counted,
    write_days,
)
from lakelayers.sources.files import dates_of, exists, sizes_of
from lakelayers.sources.raw import available_dates, pending_dates, read_raw
from lakelayers.sources.workspace import clear_scratch, scratch_path

HEADER = "order_id,customer_id,amount,order_date,status\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_text_scan_keeps_zeros_padding_and_extra_columns(spark, tmp_path):
    path = put(tmp_path / "a.csv", "order_id,status,extra\n001, x ,e\n")
    assert [tuple(r) for r in read_raw(spark, path).collect()] == [("001", " x ", "e")]


def test_inferred_scan(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b,c,d\n001,1.5,2024-01-01,x\n")
    assert [t for _, t in read_raw(spark, path, infer=True).dtypes] == ["int", "double", "date", "string"]


def test_header_only_file(spark, tmp_path):
    rows = read_raw(spark, put(tmp_path / "a.csv", HEADER))
    assert rows.count() == 0 and {t for _, t in rows.dtypes} == {"string"}


def test_short_and_long_rows(spark, tmp_path):
    path = put(tmp_path / "a.csv", HEADER + "1,a\n2,b,1,2024-01-01,X,more\n")
    rows = sorted(map(tuple, read_raw(spark, path, schema=RAW_ORDERS).collect()))
    assert rows == [("1", "a", None, None, None), ("2", "b", "1", "2024-01-01", "X")]


def test_other_column_order_fails_instead_of_swapping(spark, tmp_path):
    put(tmp_path / "a.csv", HEADER + "1,a,1,2024-01-01,X\n")
    put(tmp_path / "b.csv", "customer_id,order_id,amount,order_date,status\na,1,1,2024-01-01,X\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path), schema=RAW_ORDERS).collect()


def test_json_scan(spark, tmp_path):
    path = put(tmp_path / "a.json", '{"order_id":"001","amount":1.50}\n{"order_id":"2"}\n')
    assert read_raw(spark, path, "json", RAW_ORDERS).count() == 2
    assert dict(read_raw(spark, path, "json").dtypes) == {"order_id": "string", "amount": "string"}
    assert dict(read_raw(spark, path, "json", infer=True).dtypes) == {"order_id": "string", "amount": "double"}


def test_schema_or_inference(spark):
    with pytest.raises(ValueError):
        read_raw(spark, "/nowhere", schema=RAW_ORDERS, infer=True)


LAYOUTS = ["{raw}/{dataset}/{dt}.csv", "{raw}/{dataset}/dt={dt}", "{raw}/{dt}", "{raw}/in [1] {x}/{dt}/{dataset}.csv"]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_available_dates(spark, tmp_path, layout):
    def place(dt):
        return tmp_path / layout.removeprefix("{raw}/").replace("{dataset}", "orders").replace("{dt}", dt)

    put(place("2024-01-01") / "part-0.csv", HEADER)
    put(place("2024-01-02") / "part-0.csv", HEADER)
    if layout.endswith(".csv"):
        put(place("2024-01-03"), HEADER)
    else:
        put(place("2024-01-03") / "part-0.csv", HEADER)
    put(place("notes") / "notes.txt", "no date")
    available = available_dates(spark, layout.replace("{raw}", str(tmp_path)).replace("{dataset}", "orders"))
    done = spark.createDataFrame([("2024-01-02",)], "dt string")
    pending = pending_dates(available, done)
    assert sorted(r.dt for r in available.collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert sorted(r.dt for r in pending.collect()) == ["2024-01-01", "2024-01-03"]


def test_no_raw_folder_means_no_dates(spark, tmp_path):
    assert available_dates(spark, f"{tmp_path}/none/{{dt}}.csv").count() == 0
    assert sizes_of(spark, f"{tmp_path}/none/{{dt}}.csv", ["2024-01-01"]) == {}


def test_listing_days_starts_no_job(spark, tmp_path):
    """Sparse files of 256 MB: neither their number nor their size is read."""
    for i in range(12):
        path = tmp_path / f"2024-01-{i + 1:02d}" / "part-0.csv"
        put(path, "")
        with path.open("r+b") as file:
            file.truncate(256 << 20)
    tracker, group = spark.sparkContext.statusTracker(), f"listing-{tmp_path}"
    spark.sparkContext.setJobGroup(group, "listing")
    layout = f"{tmp_path}/{{dt}}"
    days = dates_of(spark, layout)
    sizes = sizes_of(spark, layout, days)
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(days) == 12 and set(sizes.values()) == {256 << 20} and len(jobs) == 0


def test_scratch_is_removed(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert exists(spark, path)
    clear_scratch(spark)
    assert not exists(spark, path)


def day(spark, dt, *ids, **more):
    rows = [(i, dt, *more.values()) for i in ids]
    return spark.createDataFrame(rows, ", ".join(["x int", f"{PARTITION} string", *[f"{c} int" for c in more]]))


def stored(spark, path, **options):
    return sorted((r[PARTITION], r.x) for r in read_layer(spark, path, **options).collect())


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "layer")
    append_layer(day(spark, "2024-01-01", 1), path)
    append_layer(day(spark, "2024-01-02", 2), path)
    append_layer(day(spark, "2024-01-02", 2), path)
    assert stored(spark, path) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 2)]
    for _ in range(2):
        overwrite_layer(day(spark, "2024-01-02", 3), path)
        assert stored(spark, path) == [("2024-01-01", 1), ("2024-01-02", 3)]
    clear_empty(day(spark, "2024-01-02"), path, {"2024-01-01": 1, "2024-01-02": 0})
    assert stored(spark, path) == [("2024-01-01", 1)]
    overwrite_layer(day(spark, "2024-01-03", 4), path, scope="table")
    assert stored(spark, path) == [("2024-01-03", 4)]
    with pytest.raises(ValueError):
        overwrite_layer(day(spark, "2024-01-03", 4), path, scope="row")


def test_partition_date_stays_text(spark, tmp_path):
    path = str(tmp_path / "layer")
    append_layer(day(spark, "2024-01-01", 1), path)
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(inference, "true")
    try:
        rows = read_layer(spark, path)
        assert dict(rows.dtypes)[PARTITION] == "string"
        assert for_partition(rows, "2024-01-01").count() == 1
    finally:
        spark.conf.set(inference, "false")


def test_schema_merge(spark, tmp_path):
    path = str(tmp_path / "layer")
    overwrite_layer(day(spark, "2024-01-01", 1), path, schema_mode="merge")
    overwrite_layer(day(spark, "2024-01-02", 2, y=7), path, schema_mode="merge")
    rows = read_layer(spark, path, merge=True).orderBy("x").collect()
    assert [(r.x, r.y) for r in rows] == [(1, None), (2, 7)]
    changed = day(spark, "2024-01-03", 3).selectExpr("cast(x as string) x", PARTITION)
    with pytest.raises(ValueError, match="differs"):
        overwrite_layer(changed, path, schema_mode="merge")


def test_counts(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = day(spark, "2024-01-01", 1, 2).unionByName(day(spark, "2024-01-02", 3))
    assert write_counted(rows, lambda df: overwrite_layer(df, path)) == 3
    dates = ["2024-01-01", "2024-01-02", "2024-01-03"]
    written = write_days(rows, lambda df: overwrite_layer(df, path), path, dates)
    assert (written.rows, written.by_date) == (3, {"2024-01-01": 2, "2024-01-02": 1, "2024-01-03": 0})
    assert rows_by_date(read_layer(spark, path)) == {"2024-01-01": 2, "2024-01-02": 1}
    assert write_days(day(spark, "2024-01-01"), lambda df: append_layer(df, path), path, dates[:1]).rows == 0


def test_shared_folder(spark):
    assert workspace.scratch_path(spark, "x") != workspace.scratch_path(spark, "x")

    class Session:
        def __init__(self, folder=None, **conf):
            self.conf = {k.replace("_", "."): v for k, v in conf.items()}
            self.sparkContext = self
            self.getCheckpointDir = lambda: folder

    shared = Session(spark_checkpoint_dir="hdfs://shared/work/", spark_master="yarn")
    assert workspace.shared_dir(shared) == "hdfs://shared/work"
    local = Session(spark_master="local[2]")
    assert workspace.shared_dir(local) == workspace.shared_dir(local)
    assert workspace.shared_dir(Session("s3://shared/set", spark_master="yarn")) == "s3://shared/set"
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            workspace.shared_dir(Session(spark_master=master))


def test_session(spark):
    assert get_spark("again") is not None
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.serializer").endswith("KryoSerializer")


def test_shuffle_width_only_grows_and_is_put_back(spark):
    with shuffle_width(spark, 10):
        assert spark.conf.get(WIDTH_CONF, None) is None
    with shuffle_width(spark, 100 * 128 * 1024 * 1024 + 1) as width:
        assert width == 101 and spark.conf.get(WIDTH_CONF) == "101"
    with shuffle_width(spark, 10**15) as width:
        assert width == MAX_WIDTH
    assert spark.conf.get(WIDTH_CONF, None) is None
