import pytest
from pyspark.sql import functions as F

from kerbside.operators import limits, lookup, watch


def pairs(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def fact(spark):
    # One key holds a third of the rows, some keys are null, some have no match.
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))).alias("key"),
    )


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(0, 400, 2).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("v")
    ).unionByName(spark.createDataFrame([("hot", -1)], "key string, v long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("partitions", [2, 8, 300])
def test_salted_join_equals_plain_join(spark, fact, table, how, partitions):
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = lookup.salted_join(fact, table, "key", how)
        got_pairs = pairs(got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    expected = lookup.plain_join(fact, table, "key", how)
    assert got.columns == expected.columns
    assert got_pairs == pairs(expected)


def test_salts_follow_the_share_of_a_key(fact):
    salts = {r.key: r._salts for r in lookup._salts_per_key(fact, "key", 30).collect()}
    # The hot key has about a third of the rows, every other key far less than a partition's worth.
    assert 9 <= salts.pop("hot") <= 12 and not salts


def test_busy_and_missing_keys_are_spread(spark, fact, table):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup.salted_join(fact, table, "key", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        placed = joined.groupBy("key", F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    for key in ("hot", None):
        assert len([r for r in placed if r.key == key]) >= 2


def test_size_decides_the_join(spark, table, monkeypatch):
    known = spark.range(10).withColumnRenamed("id", "key")
    assert lookup.size_up(known) == (known, lookup.plain_join)
    # Above the planner's threshold, or of unknown size: measured.
    monkeypatch.setattr(lookup, "_planner_threshold", lambda t: -1)
    for small in (known, table):
        sized, join = lookup.size_up(small)
        assert join is lookup.plain_join and "strategy=broadcast" in sized._jdf.queryExecution().analyzed().toString()
        assert lookup.size_up(small, max_bytes=10)[1] is lookup.salted_join
    monkeypatch.setattr(lookup, "MEASURE_BYTES", 1)
    monkeypatch.setattr(lookup, "measured_bytes", lambda t: pytest.fail("measured a table that is too large"))
    assert lookup.size_up(known)[1] is lookup.salted_join


def test_last_row_wins(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "z", 2), ("b", None, 1)], "k string, v string, s int")
    assert {(r.k, r.v) for r in lookup.last_row_wins(rows, "k", "s").collect()} == {("a", "y"), ("b", None)}


PASS = (
    "device_id string, vehicle_type int, speed float, plate string, plate_type string, chan_index int, dir int, "
    "site_id string, illegal_type int, time_text string, alarm_type int, plate_color string, vehicle_logo string, "
    "vehicle_color string"
)


def a_pass(device="1", kind=0, speed=50.0, plate="p"):
    return (device, kind, speed, plate, "t", 1, 0, "s", 2, "2024-01-01 00:00:00", 1, "c", "l", "v")


def gates(spark):
    return spark.createDataFrame(
        [("1", "40,50"), ("2", "40"), ("3", "0"), ("4", "fast"), ("5", "40,x"), ("6", "1000,")],
        "id string, speedlimit string",
    )


def test_limits(spark):
    passes = spark.createDataFrame([
        a_pass("1", 0, 45.0), a_pass("1", 1, 45.0), a_pass("1", 2, 99.0), a_pass("1", -1, 99.0),
        a_pass("2", 7, 45.0), a_pass("2", 7, 40.0), a_pass("3", 0, 45.0), a_pass("4", 0, 45.0),
        a_pass("5", 1, 45.0), a_pass("9", 0, 45.0),
    ], PASS)
    got = sorted((r.KKBH, r.CLLX, r.CSB) for r in limits.overspeed(passes, gates(spark)).collect())
    # Strictly over; a zero limit is passed but gives no rate.
    assert got == [("1", "0", "0.12"), ("2", "7", "0.12"), ("3", "0", None)]
    reasons = {(r.device_id, r.vehicle_type): r.reason for r in limits.unusable_limits(passes, gates(spark)).collect()}
    assert reasons == {
        ("1", 2): "type past the list", ("1", -1): "type past the list", ("3", 0): "zero limit",
        ("4", 0): "not a number", ("5", 1): "not a number",
    }
    assert [r.device_id for r in limits.unknown_gates(passes, gates(spark)).collect()] == ["9"]
    totals = limits.overspeed_counters(passes, gates(spark)).first()
    assert (totals["all"], totals["illegal"]) == (10, 3)


def test_observed_counts_match(spark):
    from pyspark.sql import Observation

    passes = spark.createDataFrame([a_pass("1", 0, 45.0), a_pass("2", 0, 1.0), a_pass("9", 0, 1.0)], PASS)
    seen = Observation("speeding")
    limits.observed(limits.with_limit(passes, gates(spark), "left"), seen).count()
    assert seen.get == {"all": 3, "illegal": 1}


@pytest.mark.parametrize("speed,limit,rate", [
    (45.0, 40.0, 0.12),  # 0.125 is a tie and goes to the even digit
    (55.0, 40.0, 0.38),  # 0.375 likewise
    (116.5, 100.0, 0.17),  # the float next to 0.165 lies above it
    (60.0, 40.0, 0.5),
    (40.0, 0.0, None),
])
def test_rate(spark, speed, limit, rate):
    import numpy as np

    from kerbside.functions.numbers import excess_rate

    row = spark.range(1).select(excess_rate(F.lit(speed).cast("float"), F.lit(limit).cast("float")).alias("r")).first()
    assert row.r is None if rate is None else np.float32(row.r) == np.float32(rate)


def test_alarm_messages_need_a_number_as_level(spark):
    passes = spark.createDataFrame([a_pass(plate="a"), a_pass(plate="b"), a_pass(plate="c")], PASS)
    listed = spark.createDataFrame([("a", "n1", "2"), ("b", "n2", "high")], "plate string, bkxxbh string, bkjb string")
    alerts = watch.watchlist_alerts(passes, listed)
    assert sorted(r.BKXXBH for r in alerts.collect()) == ["n1", "n2"]
    (message,) = watch.alarm_messages(alerts).collect()
    assert message.key == "2024-01-01 00:00:00a1" and '"Priority":2' in message.value
    assert [r.missing for r in watch.alarm_rejects(alerts).collect()] == ["Priority"]


def test_rows_without_a_partner_stay_out_of_the_exchange(spark):
    from kerbside.operators import prefilter

    table = spark.range(0, 20_000, 2).selectExpr("concat('p', id) as plate", "id as v")
    fact = spark.range(40_000).selectExpr("if(id % 100 = 0, null, concat('p', id)) as plate", "id")
    kept = prefilter.possible(fact, table, "plate")
    plates = {r.plate for r in kept.select("plate").collect()}
    hits = {f"p{i}" for i in range(0, 20_000, 2) if i % 100}
    assert hits <= plates and None not in plates and len(plates) < len(hits) * 1.1
    assert "Exchange hash" not in kept._jdf.queryExecution().executedPlan().toString()
    joined = prefilter.prefiltered_join(fact, table, "plate")
    assert sorted(map(tuple, joined.select("id", "v").collect())) == [(i, i) for i in range(0, 20_000, 2) if i % 100]
    assert prefilter.possible(fact, table.limit(0), "plate").count() == 0
    with pytest.raises(ValueError):
        prefilter.prefiltered_join(fact, table, "plate", "left")


def test_a_filter_at_its_bound_loses_nothing(spark, monkeypatch):
    from kerbside.operators import prefilter

    monkeypatch.setattr(prefilter, "MAX_BITS", 2 * prefilter.BLOCK)
    table = spark.range(200_000).selectExpr("id as k")
    assert prefilter.possible(spark.range(1000).selectExpr("id * 190 as k"), table, "k").count() == 1000
