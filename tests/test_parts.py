import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbside.functions import keys, maps
from kerbside.functions.timing import parse_event_time
from kerbside.operators import archive, device_day, enrich, flow, paging, search
from kerbside.plans import inputs
from kerbside.sources import decode, messages, snapshots, wire


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text,strict,rolled", [
    ("2024-03-05 07:08:09", "2024-03-05 07:08:09", "2024-03-05 07:08:09"),
    ("2024-03-05 07:08:09.5 and more", "2024-03-05 07:08:09", "2024-03-05 07:08:09"),
    ("2024-3-5 7:8:9.123", "2024-03-05 07:08:09", "2024-03-05 07:08:09"),
    ("2024-13-45 25:61:61", None, "2025-02-15 02:02:01"),
    ("2024-02-30 00:00:00", None, "2024-03-01 00:00:00"),
    ("bad", None, None),
    ("", None, None),
    (None, None, None),
])
def test_event_time(spark, text, strict, rolled):
    fallback = F.lit("1999-01-01 00:00:00").cast("timestamp")

    def expected(value):
        return dt.datetime.fromisoformat(value or "1999-01-01 00:00:00")

    text = F.lit(text).cast("string")
    assert one(spark, parse_event_time(text, fallback)) == expected(strict)
    assert one(spark, parse_event_time(text, fallback, lenient=True)) == expected(rolled)


def test_salt_is_the_code_of_the_last_character(spark):
    assert one(spark, keys.flow_key(F.lit("126"), F.lit("2024-01-01"))) == "0|126_2024-01-01"
    assert one(spark, keys.flow_key(F.lit("12A"), F.lit("2024-01-01"))) == f"{ord('A') % 3}|12A_2024-01-01"


def test_counter_keys_are_reversed_and_distinct(spark):
    rows = spark.range(0, 40, 1, 4).select(
        keys.counter_key(1234567).alias("a"),
        keys.plate_counter_key(1234567, F.lit("P"), F.lit("7")).alias("b"),
        F.spark_partition_id().alias("p"),
    ).collect()
    assert len({r.a for r in rows}) == 40
    assert sorted(r.a for r in rows if r.p == 2)[0].endswith("_2")
    assert {r.a.split("_")[0][::-1] for r in rows if r.p == 0} == {str(1234567 + i) for i in range(10)}
    assert all(r.b.endswith("_P_7") for r in rows)


def test_merge_maps(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": "1"}, {"b": "2", "c": None}, {"c": "3"}), (None, {"b": "2"}, None), (None, None, None)],
        "x map<string,string>, y map<string,string>, z map<string,string>",
    )
    got = [r.m for r in df.select(maps.merge_maps(F.col("x"), F.col("y"), F.col("z")).alias("m")).collect()]
    assert got == [{"a": "1", "b": "2", "c": "3"}, {"b": "2"}, {}]


def test_unknown_dimension_gives_null_and_no_merged_entries(spark):
    hits = spark.createDataFrame([("T1", "C9", "D9"), ("T9", "C9", None)], "task_id string, camera_id string, data_source_id string")
    dims = [
        snapshots.load_dim(spark.createDataFrame([(p + "1", '{"name":"n"}')], f"{k} string, doc string"), k)
        for p, k in (("T", "task_id"), ("C", "camera_id"), ("D", "data_source_id"))
    ]
    got = {r.task_id: r for r in enrich.enrich_dims(hits, *dims).collect()}
    assert got["T1"].merged == {"name": "n"} and got["T1"].task == {"name": "n"}
    assert got["T9"].merged == {} and got["T9"].task is None


def test_watchlist_under_database_names(spark):
    rows = spark.createDataFrame([("p", "n1", "2"), ("p", "n2", "1"), ("q", "n3", "1")], "HPHM string, BKXXBH string, BKJB string")
    got = sorted(tuple(r) for r in snapshots.load_watchlist(rows).collect())
    assert got == [("p", "n2", "1"), ("q", "n3", "1")]


def test_gates_by_order(spark):
    rows = spark.createDataFrame([(1, "40", 1), (1, "50", 2)], "id int, speedlimit string, at int")
    assert [tuple(r) for r in snapshots.load_gates(rows, "at").collect()] == [("1", "50")]


# Flow


def test_grains_add_up(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    sums = {r.grain: r.n for r in flow.flow_all_grains(passes).groupBy("grain").agg(F.sum("n").alias("n")).collect()}
    assert set(sums.values()) == {passes.count()}
    assert sorted(map(repr, flow.flow(passes.repartition(7), "hour").collect())) == sorted(
        map(repr, flow.flow(passes.coalesce(1), "hour").collect()))


def test_live_buckets_are_complete_buckets(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    for as_of in ("2024-01-01 00:05:00", "2024-01-02 00:03:00", "2024-01-02 12:00:00"):
        seen = flow.flow_all_grains(passes.filter(F.col("pass_ts") <= as_of))
        live = flow.flow_live_asof(passes, as_of).select(*seen.columns)
        assert live.exceptAll(seen).count() == 0
        assert 0 < live.count() <= seen.count()


def test_bad_grain_and_class(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir)
    with pytest.raises(ValueError):
        flow.flow(passes, "week")
    with pytest.raises(ValueError):
        flow.interval_summary(passes, "1 hour", {"huge": [1]})


def test_wide_cells(spark):
    t = dt.datetime(2024, 1, 1, 1, 5)
    day = dt.datetime(2024, 1, 1)
    counts = spark.createDataFrame([
        ("6", "day", day, 10, 3), ("6", "day", day, 9, 2), ("6", "hour", day.replace(hour=1), 9, 2),
        ("6", "minute", t, 9, 1), ("7", "hour", t, 9, 1),
    ], "device_id string, grain string, bucket timestamp, vehicle_type int, n long")
    speeds = spark.createDataFrame([("6", t, 1.5, 2.0), ("8", t, 1.0, 1.0)], "device_id string, minute timestamp, speed float, length float")
    # Devices 7 and 8 have no day count and are left out.
    (row,) = device_day.flow_wide(counts, speeds).collect()
    assert row.row_key == "0|6_2024-01-01"
    assert row.cells == {"D": "9:2|10:3|", "1h": "9:2|", "65": "9:1|", "65S": "1.5", "65L": "2.0"}
    (maps_row,) = device_day.device_day(counts, speeds).collect()
    assert maps_row.day_map == {"10|2024-01-01": 3, "9|2024-01-01": 2}
    assert maps_row.speed_map == {"2024-01-01 01:05": 1.5}


# Search and pages


def test_plate_pattern_matches_whole_values(spark):
    plates = ["粤A12342", "粤A123422", "x粤A12342", "粤A1234\n2", "京A12342", "粤A1234", "粤A1234x2"]
    docs = spark.createDataFrame([(p, dt.datetime(2024, 1, 1)) for p in plates], "plate string, pass_ts timestamp")

    def found(province, suffix):
        return {r.plate for r in search.plate_search(docs, "2023-01-01 00:00:00", province, suffix).collect()}

    assert found("粤", "2") == {"粤A12342"}
    assert found("粤A", "2") == {"粤A123422", "粤A1234\n2", "粤A1234x2"}
    assert found("[粤京]", "2") == {"粤A12342", "京A12342"}
    # The second alternative has no province.
    assert found("粤", "9|京A12342") == {"京A12342"}


def test_plain_province_is_pushed_to_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "docs")
    inputs.passes(spark, sf_dir).select("plate", "pass_ts").write.parquet(path)
    found = search.plate_search(spark.read.parquet(path), "2024-01-01 00:00:00", "粤", "2")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "StringStartsWith(plate,粤)" in plan


def test_attr_search_rejects_unknown_terms(spark, sf_dir):
    with pytest.raises(ValueError):
        search.attr_search(inputs.passes(spark, sf_dir), colour="x")


def test_range_is_inclusive(spark):
    times = [dt.datetime(2024, 1, 1, 0, 0, s) for s in range(5)]
    docs = spark.createDataFrame([(t,) for t in times], "pass_ts timestamp")
    assert search.time_count(docs, times[1], times[3]).first().total == 3
    assert search.attr_search(docs, start=times[3]).count() == 2
    assert search.attr_search(docs, end=times[1]).count() == 2


def test_day_folders_are_pruned(spark, sf_dir, tmp_path):
    from kerbside.streaming import sinks

    path = str(tmp_path / "docs")
    docs = inputs.passes(spark, sf_dir).select("event_id", "pass_ts", "plate", F.to_date("pass_ts").alias("day"))
    sinks.write_batch(docs, 0, path, ["day"])
    stored = sinks.read_batches(spark, path)
    bounds = "2024-01-02 00:00:00", "2024-01-02 10:00:00"
    found = search.time_range(stored, *bounds)
    assert {f.split("day=")[1][:10] for f in found.select(F.input_file_name().alias("f")).toPandas()["f"]} == {"2024-01-02"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert found.count() == search.time_range(docs.drop("day"), *bounds).count() > 0


def test_pages_in_order_are_the_sorted_result(spark, sf_dir):
    # Few distinct times, so that pages break within one.
    docs = inputs.passes(spark, sf_dir).select(
        F.date_trunc("hour", "pass_ts").alias("pass_ts"), "event_id").filter("event_id < 260")
    expected = [tuple(r) for r in paging.sort_result(docs).collect()]
    assert [tuple(r) for p in paging.scroll(docs, 50) for r in p] == expected
    numbered = paging.number_pages(docs.repartition(9), 50).orderBy("page", "pass_ts", "event_id").collect()
    assert [tuple(r[:2]) for r in numbered] == expected
    assert [r.page for r in numbered] == [i // 50 + 1 for i in range(len(expected))]


def test_page_needs_no_full_sort(spark, sf_dir):
    plan = paging.page(inputs.passes(spark, sf_dir), 50)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


# Archive


def test_images(spark, sf_dir):
    passes = inputs.with_pics(inputs.passes(spark, sf_dir)).filter("event_id < 3")
    last = {r.RecogMode for r in archive.traffic_image(passes).collect()}
    assert last == {"11", "12"}  # one picture, two pictures; the pass without any gives no row
    assert archive.traffic_image_all(passes).count() == 3


def test_image_projection_shuffles_nothing(spark, sf_dir):
    passes = inputs.with_pics(inputs.passes(spark, sf_dir))
    assert "Exchange" not in archive.traffic_image(passes)._jdf.queryExecution().executedPlan().toString()


def test_archive_key_of_messages_uses_the_offset(spark, sf_dir):
    passes = inputs.passes(spark, sf_dir).limit(2).withColumns(
        {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.col("event_id")})
    got = {r.row_key for r in archive.traffic_meta(passes).collect()}
    expected = {r.k for r in passes.select(keys.pass_key(F.lit("t"), F.lit(0), F.col("offset")).alias("k")).collect()}
    assert got == expected and len(got) == 2


# Decoding


GOOD = (
    '{"Id":"1","DriveChan":1,"IllegalType":0,"IllegalSubType":"s","SpeedLimit":60,'
    '"PlateInfo":{"PlateType":"1","Color":"c","Bright":1,"LicenseLen":7,"Country":86,"License":"p","Believe":"9"},'
    '"VehicleInfo":{"Index":1,"VehicleType":2,"ChanIndex":1,"ColorDepth":1,"Color":"c","Speed":61.5,"Length":4.5,'
    '"VehicleLogoRecog":"l","VehicleSubLogoRecog":"sl","VehicleModel":"m","VehicleAttribute":1},'
    '"MonitoringSiteID":"S","Dir":0,"DetectType":1,"PilotSafebelt":1,"CopilotSafebelt":1,"PilotSubVisor":1,'
    '"CopilotSubVisor":1,"PilotCall":0,"AlarmDataType":1,"Time":"2024-01-01 00:00:00","PicNum":1,'
    '"PicInfo":[{"Type":1,"PicRecogMode":2,"RedLightTime":3,"PlateRect":{"X":1,"Y":2,"Width":3,"Height":4},"Data":"aGk="}]}'
)


def decoded(spark, payload, **how):
    df = spark.createDataFrame([(payload,)], "payload string" if isinstance(payload, str) else "payload binary")
    valid, bad = decode.decode_passes(df, **how)
    return valid.collect(), bad.collect()


def test_decode_good(spark):
    (row,), bad = decoded(spark, GOOD)
    assert not bad
    assert (row.device_id, row.plate, row.speed, row.pass_ts) == ("1", "p", 61.5, dt.datetime(2024, 1, 1))
    assert row.pics[0].rect.w == 3 and bytes(row.pics[0].data) == b"hi" and row.validity is None


@pytest.mark.parametrize("change,missing", [
    (('"Id":"1",', ""), ["Id"]),
    (('"License":"p",', ""), ["PlateInfo.License"]),
    (('"Speed":61.5,', '"Speed":null,'), ["VehicleInfo.Speed"]),
    (('"Y":2,', ""), ["PicInfo"]),
    (('"PicNum":1,', '"PicNum":1,"Extra":5,'), None),
    (('"DriveChan":1', '"DriveChan":"one"'), "unreadable"),
    (('"PicNum":1', '"PicNum":'), "unreadable"),
])
def test_decode_bad(spark, change, missing):
    valid, bad = decoded(spark, GOOD.replace(*change))
    if missing is None:
        assert len(valid) == 1 and not bad
    elif missing == "unreadable":
        assert not valid and bad[0].reason == "unreadable" and bad[0].missing == []
    else:
        assert not valid and bad[0].reason == "missing field" and bad[0].missing == missing


def test_whole_nested_message_missing_is_named_once(spark):
    start, end = GOOD.index('"PlateInfo"'), GOOD.index('"VehicleInfo"')
    _, bad = decoded(spark, GOOD[:start] + GOOD[end:])
    assert bad[0].missing == ["PlateInfo"]


def test_decode_protobuf(spark):
    json_format = pytest.importorskip("google.protobuf.json_format")
    kind = wire._message_class(messages.descriptor_set(), messages.PASS_MESSAGE)
    message = json_format.Parse(GOOD, kind())
    raw = message.SerializeToString()
    (row,), bad = decoded(spark, bytearray(raw), wire="protobuf")
    (same,), _ = decoded(spark, GOOD)
    assert row == same and not bad
    message.ClearField("Id")
    _, bad = decoded(spark, bytearray(message.SerializePartialToString()), wire="protobuf")
    assert bad[0].missing == ["Id"]
    _, bad = decoded(spark, bytearray(raw[:20]), wire="protobuf")
    assert bad[0].reason == "unreadable"


def test_alarm_messages_in_wire_form(spark, sf_dir):
    json_format = pytest.importorskip("google.protobuf.json_format")
    from kerbside.operators import watch

    passes = inputs.passes(spark, sf_dir)
    listed = snapshots.load_watchlist(inputs.derived(spark, "prey", passes))
    alerts = watch.watchlist_alerts(passes, listed)
    kind = wire._message_class(messages.descriptor_set(), messages.ALARM_MESSAGE)
    raw = {r.key: r.value for r in watch.alarm_messages(alerts, "protobuf").collect()}
    text = {r.key: r.value for r in watch.alarm_messages(alerts).collect()}
    assert raw.keys() == text.keys() and raw
    for key in raw:
        assert kind.FromString(bytes(raw[key])) == json_format.Parse(text[key], kind())


def test_payload_is_parsed_once(spark):
    df = spark.createDataFrame([(GOOD,)], "payload string")
    plan = decode.decode_passes(df)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_repeated_gates_count_once(spark):
    gates = spark.createDataFrame([(1, "60"), (1, "50"), (2, "70")], "id int, speedlimit string")
    assert sorted(map(tuple, snapshots.load_gates(gates).collect())) == [("1", "60"), ("2", "70")]


def test_live_flow_reads_the_passes_once(spark, sf_dir):
    from kerbside.operators.flow import flow_live_asof
    from kerbside.plans import inputs

    live = flow_live_asof(inputs.passes(spark, sf_dir), "2024-01-02 12:00:30")
    assert live._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
