import datetime as dt

import numpy as np
import pytest

from kerbside.operators import speed as S

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
SCHEMA = "device_id string, pass_ts timestamp, event_id long, speed float, length float"


def running_mean(values):
    f32 = np.float32
    mean = f32(values[0])
    for v in values[1:]:
        scaled = f32(f32(f32(mean + f32(v)) / f32(2)) * f32(100))
        # The cast of the stored values: NaN is 0, out of range is the nearest int.
        ticks = 0 if np.isnan(scaled) else int(np.clip(np.float64(scaled), -(2**31), 2**31 - 1))
        mean = f32(f32(ticks) / f32(100))
    return mean


def frame(spark, groups):
    rows = []
    for device, values in groups.items():
        for i, v in enumerate(values):
            # Few distinct times, so that the id decides among ties.
            ts = T0 + dt.timedelta(seconds=(i * 60) // len(values))
            rows.append((device, ts, i, float(v), float(v) / 7))
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "event_id")


def groups():
    rng = np.random.default_rng(3)
    return {
        "one": [3.14159],
        "two": [10.0, 20.01],
        "random": rng.uniform(0, 200, 900).round(2),
        "flat": [60.0] * 700,
        "flat_after_low": [1.0] + [60.0] * 700,
        "flat_after_high": [99.0] + [60.0] * 700,
        "two_flat": [12.34] * 300 + [12.35] * 400,
        "negative": rng.uniform(-5, 5, 300),
        "huge_first": [1e30] + [60.0] * 200,
        "nan": [float("nan")] + [5.0] * 100,
    }


@pytest.mark.parametrize("tail,piece", [(64, 65536), (64, 100), (4, 150), (40, 7)])
def test_fold_is_exact_whatever_the_cut(spark, tail, piece):
    data = groups()
    got = {r.device_id: r for r in S.speed_length_fold(frame(spark, data), tail, piece).collect()}
    assert set(got) == set(data)
    for device, values in data.items():
        assert np.float32(got[device].speed) == running_mean(values), device
        lengths = [np.float32(float(v) / 7) for v in values]
        assert np.float32(got[device].length) == running_mean(lengths), device


def test_pieces_alone_give_the_same_answer(spark):
    data = groups()
    rows = S._by_minute(frame(spark, data))
    for piece in (50, 130, 1000):
        got = {r.device_id: r.speed for r in S.apply_maps(S._run_maps(rows, piece), "at").collect()}
        for device, values in data.items():
            assert np.float32(got[device]) == running_mean(values), (device, piece)


def test_each_step_cuts_to_two_decimals_and_one_value_stays(spark):
    got = {r.device_id: r.speed for r in S.speed_length_fold(
        frame(spark, {"a": [3.14159], "b": [1.0, 2.999]})).collect()}
    assert np.float32(got["a"]) == np.float32(3.14159)
    assert np.float32(got["b"]) == np.float32(1.99)


def test_null_stays_null(spark):
    rows = spark.createDataFrame([("a", T0, i, v, 1.0) for i, v in enumerate([5.0, None, 7.0])], SCHEMA)
    got = S.speed_length_fold(rows).first()
    assert got.speed is None and got.length == 1.0


def test_mean(spark):
    got = S.speed_length(frame(spark, {"a": [1.0, 2.0, 6.0]})).first()
    assert got.speed == 3.0


def test_untied_rows_are_exchanged_once(spark, sf_dir):
    from kerbside.plans import inputs

    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        folded = S.speed_length_fold(inputs.passes(spark, sf_dir))
        plan = folded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    # The folded tails are read from the checkpoint; no device-minute is tied, so the passes are not read again.
    assert "Exchange" not in plan and "FileScan" not in plan
