import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kerbside.operators import archive, device_day, flow, limits, speed, watch
from kerbside.plans import inputs
from kerbside.sources import snapshots, stream
from kerbside.streaming import flows, jobs, sinks


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def add_file(df, folder, number):
    """One parquet file, later than the ones before it."""
    staged = f"{folder}-staged-{number}"
    df.coalesce(1).write.parquet(staged)
    (part,) = glob.glob(f"{staged}/*.parquet")
    os.makedirs(folder, exist_ok=True)
    target = f"{folder}/{number:03}.parquet"
    shutil.copy(part, target)
    os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.fixture(scope="module")
def passes(spark, sf_dir):
    return inputs.passes(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def ordered(passes, tmp_path_factory):
    """The passes in six files in time order."""
    folder = str(tmp_path_factory.mktemp("ordered") / "passes")
    start = dt.datetime(2024, 1, 1)
    for i in range(6):
        low, high = start + dt.timedelta(hours=12 * i), start + dt.timedelta(hours=12 * (i + 1))
        add_file(passes.filter((F.col("pass_ts") >= low) & (F.col("pass_ts") < high)), folder, i)
    return folder


def source(spark, folder, passes, per_trigger=1):
    return stream.pass_stream(spark, stream.SourceConfig(
        format="parquet", path=folder, schema=passes.schema, max_per_trigger=per_trigger))


def drain(df, sink, tmp_path, mode="append", checkpoint="query"):
    cfg = jobs.JobConfig(str(tmp_path / checkpoint), available_now=True, output_mode=mode)
    query = jobs.start(df, sink, cfg)
    query.awaitTermination()
    return query


@pytest.fixture(scope="module")
def flow_tables(spark, passes, ordered, tmp_path_factory):
    """The flow tables after six batches in time order."""
    root = tmp_path_factory.mktemp("flow")
    drain(source(spark, ordered, passes), flows.flow_sink(str(root / "t")), root)
    return str(root / "t")


@pytest.mark.parametrize("grain", flow.GRAINS)
def test_flow_tables_equal_batch(spark, passes, flow_tables, grain):
    assert rows(flows.read_flow(spark, flow_tables, grain).drop("grain")) == rows(flow.flow(passes, grain))


def test_means_equal_batch(spark, passes, flow_tables):
    means = flows.read_speed_length(spark, flow_tables)
    both = means.join(speed.speed_length(passes).toDF("device_id", "minute", "s", "l"), ["device_id", "minute"])
    assert both.count() == means.count() == both.where("abs(speed - s) < 1e-9 and abs(length - l) < 1e-9").count()
    assert rows(flows.read_running_mean(spark, flow_tables)) == rows(speed.speed_length_fold(passes))


def one_pass(spark, text, n=1):
    return spark.createDataFrame(
        [("1", 0, dt.datetime.fromisoformat(text), 1, 2.0, 3.0)] * n,
        "device_id string, vehicle_type int, pass_ts timestamp, event_id long, speed float, length float")


def test_late_passes(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "flow")
    times = ["2024-01-01 10:00:10", "2024-01-01 10:05:00", "2024-01-01 10:00:20", "2024-01-01 11:00:00",
             "2024-01-01 11:00:30", "2024-01-01 10:00:30"]
    for i, text in enumerate(times):
        add_file(one_pass(spark, text), folder, i)
    drain(source(spark, folder, one_pass(spark, times[0])), flows.flow_sink(out, means=False), tmp_path)
    minute = {r.bucket.strftime("%H:%M"): r.n for r in flows.read_flow(spark, out, "minute").collect()}
    # However late a pass comes, it counts.
    assert minute == {"10:00": 3, "10:05": 1, "11:00": 2}


def test_a_clock_ahead_costs_no_other_device_anything(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "flow")
    ahead = one_pass(spark, "2024-01-02 10:00:00").withColumn("device_id", F.lit("ahead"))
    for i, part in enumerate([ahead, *(one_pass(spark, f"2024-01-01 10:0{m}:00", 2) for m in range(3))]):
        add_file(part, folder, i)
    drain(source(spark, folder, ahead), flows.flow_sink(out, means=False), tmp_path)
    assert {r.device_id: r.n for r in flows.read_flow(spark, out, "hour").collect()} == {"ahead": 1, "1": 6}


def test_restart_goes_on_where_it_stopped(spark, passes, ordered, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "flow")
    os.makedirs(folder)
    for half in (range(0, 3), range(3, 6)):
        for i in half:
            shutil.copy2(f"{ordered}/{i:03}.parquet", folder)
        drain(source(spark, folder, passes), flows.flow_sink(out, means=False), tmp_path)
    assert rows(flows.read_flow(spark, out, "day").drop("grain")) == rows(flow.flow(passes, "day"))


def test_replayed_batch_changes_nothing(spark, passes, tmp_path):
    out = str(tmp_path / "t")
    alerts = watch.alarm_table(watch.watchlist_alerts(passes, snapshots.load_watchlist(inputs.derived(spark, "prey", passes))))
    sink = sinks.table_sink(out)
    sink(alerts, 0)
    once = rows(sinks.read_rows(spark, out))
    sink(alerts, 0)
    sink(alerts.limit(3), 1)
    assert rows(sinks.read_rows(spark, out)) == once
    assert sinks.read_batches(spark, out).filter("batch_id = 0").count() == alerts.count()


def test_replayed_counts_are_not_added_twice(spark, passes, tmp_path):
    out = str(tmp_path / "flow")
    sink = flows.flow_sink(out)
    for batch_id in (3, 3, 3):
        sink(passes, batch_id)
    assert rows(flows.read_flow(spark, out, "hour").drop("grain")) == rows(flow.flow(passes, "hour"))
    assert rows(flows.read_running_mean(spark, out)) == rows(speed.speed_length_fold(passes))


def test_newer_batch_wins_and_other_rows_survive(spark, tmp_path):
    out, moved = str(tmp_path / "t"), str(tmp_path / "moved")
    schema, key = "row_key string, n long", ["row_key"]
    sink = sinks.table_sink(out)
    sink(spark.createDataFrame([("a", 5), ("b", 7)], schema), 9)
    sink(spark.createDataFrame([("a", 2)], schema), 10)
    expected = {"a": 2, "b": 7}
    assert dict(sinks.read_rows(spark, out).collect()) == expected
    sinks.compact(spark, out, moved, key, 10)
    assert dict(sinks.read_rows(spark, moved).collect()) == expected
    assert sinks.read_batches(spark, moved).count() == 2
    # The next batch goes into the copy.
    sinks.table_sink(moved)(spark.createDataFrame([("b", 8)], schema), 11)
    assert dict(sinks.read_rows(spark, moved).collect()) == {"a": 2, "b": 8}


def test_time_range_reads_the_folders_of_its_days(spark, passes, tmp_path):
    out = str(tmp_path / "archive")
    sinks.fan_out(inputs.with_pics(passes), 1, out)
    found = sinks.read_days(spark, f"{out}/meta", "Time", "2024-01-02 01:00:00", "2024-01-02 02:00:00")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-02" in plan.split("PartitionFilters")[1]
    assert found.count() == passes.where("pass_ts between '2024-01-02 01:00:00' and '2024-01-02 02:00:00'").count() > 0
    assert "day=2024-01-02" in " ".join(os.listdir(f"{out}/meta/batch_id=1"))


def test_stored_flow_gives_the_wide_rows(spark, passes, flow_tables):
    stored = device_day.flow_wide(flows.read_flow(spark, flow_tables), flows.read_running_mean(spark, flow_tables))
    direct = device_day.flow_wide_of(passes)
    flat = [d.select("row_key", F.explode("cells").alias("cell", "value")) for d in (stored, direct)]
    assert rows(flat[0]) == rows(flat[1])


def test_alerts_stream_with_messages(spark, passes, ordered, tmp_path):
    out, sent = str(tmp_path / "alarms"), str(tmp_path / "sent")
    prey = inputs.derived(spark, "prey", passes).cache()
    sink = jobs.alerts_sink(
        lambda: snapshots.load_watchlist(prey), out, lambda m, i: sinks.write_batch(m, i, sent))
    drain(source(spark, ordered, passes), sink, tmp_path)
    alerts = watch.watchlist_alerts(passes, snapshots.load_watchlist(prey))
    assert rows(sinks.read_batches(spark, out).drop("batch_id", "day")) == rows(watch.alarm_table(alerts))
    assert rows(sinks.read_batches(spark, sent).drop("batch_id")) == rows(watch.alarm_messages(alerts))


def test_refresh_replaces_the_table(spark, tmp_path):
    folder = str(tmp_path / "in")
    for i in range(3):
        add_file(spark.createDataFrame([("p", i)], "plate string, i int"), folder, i)
    state = {"version": 0, "loads": 0}
    listed = {0: ["p"], 1: ["p"], 2: []}
    matched = []

    def load():
        state["loads"] += 1
        return spark.createDataFrame([(p,) for p in listed[state["version"]]], "plate string")

    def work(batch, batch_id, table, join):
        matched.append(join(batch, table, "plate", "inner").count())
        state["version"] = 2 if batch_id == 1 else 0

    per_batch = stream.SourceConfig(format="parquet", path=folder, schema="plate string, i int", max_per_trigger=1)
    drain(stream.pass_stream(spark, per_batch), jobs.with_refresh(load, work, lambda: state["version"]), tmp_path)
    # The third batch sees that the plate was deleted; the first two share one load.
    assert matched == [1, 1, 0] and state["loads"] == 2


def test_a_version_reads_its_table_once(spark, tmp_path):
    folder, read = str(tmp_path / "in"), spark.sparkContext.accumulator(0)
    for i in range(4):
        add_file(spark.createDataFrame([("p", i)], "plate string, i int"), folder, i)

    def load():
        def seen(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        return spark.range(10).selectExpr("concat('p', id) AS plate").mapInArrow(seen, "plate string")

    def work(batch, batch_id, table, join):
        assert join(batch, table, "plate", "inner").count() == 0

    per_batch = stream.SourceConfig(format="parquet", path=folder, schema="plate string, i int", max_per_trigger=1)
    drain(stream.pass_stream(spark, per_batch), jobs.with_refresh(load, work, jobs.every(3600)), tmp_path)
    assert read.value == 10


def test_large_reference_table_takes_the_salted_join(spark, passes, ordered, tmp_path, monkeypatch):
    from kerbside.operators import lookup

    monkeypatch.setattr(jobs, "size_up", lambda table: (table, lookup.salted_join))
    out = str(tmp_path / "violations")
    gates = snapshots.load_gates(inputs.derived(spark, "gate"), "seq")
    drain(source(spark, ordered, passes, 3), jobs.overspeed_sink(lambda: gates, out), tmp_path)
    read = lambda name: sinks.read_batches(spark, f"{out}{name}")
    assert rows(read("").drop("batch_id", "day")) == rows(limits.overspeed(passes, gates))
    assert read("-unknown-gates").count() == limits.unknown_gates(passes, gates).count() > 0
    totals = read("-counters").agg(F.sum("all"), F.sum("illegal")).first()
    assert tuple(totals) == tuple(limits.overspeed_counters(passes, gates).first())
    assert not os.path.exists(f"{out}-unusable-limits")


def test_fan_out_shares_keys(spark, passes, tmp_path):
    out = str(tmp_path / "archive")
    pictured = inputs.with_pics(passes)
    for _ in range(2):
        sinks.fan_out(pictured, 4, out)
    meta, image, index = (sinks.read_batches(spark, f"{out}/{n}").drop("batch_id", "day") for n in ("meta", "image", "index"))
    assert rows(meta) == rows(archive.traffic_meta(passes))
    assert rows(index) == rows(archive.traffic_index(passes))
    assert meta.select("row_key").exceptAll(index.select("RowKey")).count() == 0
    assert image.join(meta, "row_key").count() == image.count() == pictured.filter("pic_num > 0").count()


def test_failed_write_fails_the_batch_and_a_rerun_repairs_it(spark, passes, ordered, tmp_path):
    out = str(tmp_path / "archive")
    broken = {"on": True}

    def index(batch):
        if broken["on"]:
            raise RuntimeError("index is down")
        return archive.traffic_index(batch)

    outputs = {"meta": archive.traffic_meta, "index": index}
    with pytest.raises(StreamingQueryException):
        drain(source(spark, ordered, passes, 6), jobs.fan_out_sink(out, outputs), tmp_path)
    broken["on"] = False
    drain(source(spark, ordered, passes, 6), jobs.fan_out_sink(out, outputs), tmp_path)
    for name in outputs:
        assert sinks.read_batches(spark, f"{out}/{name}").count() == passes.count()


def test_settings_without_defaults_are_asked_for(spark, flow_tables):
    with pytest.raises(ValueError):
        stream.pass_stream(spark, stream.SourceConfig())
    with pytest.raises(ValueError):
        sinks.kafka_writer(spark.range(1), "server:1", "")
    with pytest.raises(ValueError):
        flows.read_flow(spark, flow_tables, "week")


def test_shared_folder(spark):
    from types import SimpleNamespace

    from kerbside import session

    root = session.shared_dir(spark)
    assert session.shared_dir(spark) == root and session.fresh_dir(spark, "x").startswith(root)

    def cluster(named):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master="yarn"))

    assert session.shared_dir(cluster("/shared/place/")) == "/shared/place"
    with pytest.raises(ValueError):
        session.shared_dir(cluster(None))


def test_counters_as_metrics_of_a_stream(spark, passes, ordered, tmp_path):
    gates = snapshots.load_gates(inputs.derived(spark, "gate"))
    limited = limits.observed(limits.with_limit(source(spark, ordered, passes), gates, "left"), "speeding")
    query = drain(limited, sinks.table_sink(str(tmp_path / "out")), tmp_path)
    seen = [p.observedMetrics["speeding"] for p in query.recentProgress if "speeding" in p.observedMetrics]
    totals = limits.overspeed_counters(passes, gates).first()
    assert (sum(m["all"] for m in seen), sum(m["illegal"] for m in seen)) == (totals["all"], totals["illegal"])


def test_running_mean_goes_on_over_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "speed")
    schema = "device_id string, vehicle_type int, pass_ts timestamp, event_id long, speed float, length float"
    at = dt.datetime(2024, 1, 1, 10)
    values = [float(v) for v in range(1, 200)]
    whole = spark.createDataFrame([("1", 0, at, i, v, v / 3) for i, v in enumerate(values)], schema)
    for n, (low, high) in enumerate(((0, 1), (1, 3), (3, 120), (120, 200))):
        add_file(whole.filter((F.col("event_id") >= low) & (F.col("event_id") < high)), folder, n)
    drain(source(spark, folder, whole), flows.flow_sink(out), tmp_path)
    assert rows(flows.read_running_mean(spark, out)) == rows(speed.speed_length_fold(whole))
