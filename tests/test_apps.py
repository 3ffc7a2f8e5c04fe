import pytest
from pyspark.sql import functions as F

from kerbside.__main__ import arguments
from kerbside.operators import archive, device_day, limits, watch
from kerbside.plans import inputs
from kerbside.sources import decode, snapshots
from kerbside.streaming import apps, sinks


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def job(spark, sf_dir, tmp_path_factory):
    """Payloads on disk, with one unreadable, and what a batch decode makes of them."""
    root = tmp_path_factory.mktemp("apps")
    passes = inputs.with_pics(inputs.passes(spark, sf_dir)).withColumns({
        "plate_length": F.lit(7), "vehicle_index": F.lit(1), "vehicle_sub_logo": F.lit("s"),
        "vehicle_model": F.lit("m"), "time_text": F.date_format("pass_ts", "yyyy-MM-dd HH:mm:ss"),
    })
    payload = F.when(F.col("event_id") != 5, F.to_json(decode.encode_passes(passes))).otherwise("{")
    passes.select("event_id", payload.alias("payload")).coalesce(1).write.parquet(str(root / "in"))
    stored = spark.read.parquet(str(root / "in"))
    valid, _ = decode.decode_passes(stored)
    stream = spark.readStream.schema(stored.schema).parquet(str(root / "in"))
    setup = apps.Setup(str(root / "out"), str(root / "checkpoints"), wire="json", available_now=True)
    return stream, setup, valid.cache()


def finish(queries):
    for query in queries:
        query.awaitTermination()


def stored(spark, setup, name):
    return sinks.read_batches(spark, f"{setup.out}/{name}").drop("batch_id", "day")


def test_archive(spark, job):
    stream, setup, valid = job
    finish(apps.archive_app(stream, setup))
    assert rows(stored(spark, setup, "archive/meta")) == rows(archive.traffic_meta(valid))
    assert rows(stored(spark, setup, "archive/image")) == rows(archive.traffic_image(valid))
    assert [r.event_id for r in stored(spark, setup, "archive-quarantine").collect()] == [5]


def test_flow(spark, job):
    stream, setup, valid = job
    finish(apps.flow_app(stream, setup))
    wide = device_day.flow_wide(*apps.read_flow_tables(spark, setup))
    exploded = [d.select("row_key", F.explode("cells").alias("cell", "value")) for d in (wide, device_day.flow_wide_of(valid))]
    assert rows(exploded[0]) == rows(exploded[1])


def test_alerts_and_overspeed(spark, job):
    stream, setup, valid = job
    listed = snapshots.load_watchlist(inputs.derived(spark, "prey", valid)).cache()
    gates = snapshots.load_gates(inputs.derived(spark, "gate"))
    finish(apps.alerts_app(stream, lambda: listed, setup))
    finish(apps.overspeed_app(stream, lambda: gates, setup))
    assert rows(stored(spark, setup, "alarms")) == rows(watch.alarm_table(watch.watchlist_alerts(valid, listed)))
    assert rows(stored(spark, setup, "violations")) == rows(limits.overspeed(valid, gates))


def test_arguments():
    common = ["--servers", "s:1", "--topic", "t", "--out", "o", "--checkpoints", "c"]
    assert arguments(["flow", *common]).wire == "protobuf"
    with pytest.raises(SystemExit):
        arguments(["alerts", *common])
