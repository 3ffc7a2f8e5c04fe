"""Tables in levels, and running means that take passes in any order."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import speed, step_maps
from kerbside.streaming import flows, levels
from kerbside.streaming.levels import Levels, SharedFile, newest, summing
from kerbside.streaming.means import RunningMeans
from tests.test_speed import groups, running_mean


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_file_is_replaced_whole(spark, tmp_path):
    file = SharedFile(spark, str(tmp_path / "deep" / "manifest.json"))
    assert file.read() is None
    for text in ("a", "longer ü 漢", ""):
        file.replace(text)
        assert file.read() == text
    assert [p.name for p in (tmp_path / "deep").iterdir() if not p.name.endswith(".crc")] == ["manifest.json"]


def test_parts_stay_few_and_counts_add_up(spark, tmp_path):
    table, truth = Levels(str(tmp_path), summing(["k"], ["n"]), fan=3), {}
    for batch in range(20):
        added = [(batch % 4, 1), (9, 10)]
        for _ in range(2 if batch % 5 == 0 else 1):  # a replay adds nothing
            table.add(spark.createDataFrame(added, "k long, n long"), batch)
        for k, n in added:
            truth[k] = truth.get(k, 0) + n
        held = table.manifest(spark)
        # In base three the digits of the number of batches are the parts of each level.
        digits = [(batch + 1) // 3 ** i % 3 for i in range(4)]
        assert [sum(p.level == i for p in held.parts) for i in range(4)] == digits and held.last == batch
    assert dict(table.read(spark).collect()) == truth
    assert [p.first for p in held.parts] == sorted(p.first for p in held.parts) and held.parts[0].first == 0


def test_what_no_manifest_names_is_not_read(spark, tmp_path, monkeypatch):
    table, one = Levels(str(tmp_path), summing(["k"], ["n"]), fan=2), spark.createDataFrame([(1, 1)], "k long, n long")
    table.add(one, 0)
    with monkeypatch.context() as m:
        m.setattr(SharedFile, "replace", lambda self, text: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.add(one, 1)
    assert dict(table.read(spark).collect()) == {1: 1}
    # The batch comes again; and a driver that is lost while merging leaves the parts as they were.
    with monkeypatch.context() as m:
        m.setattr(Levels, "settle", lambda self, spark: None)
        table.add(one, 1)
    assert len(table.manifest(spark).parts) == 2 and dict(table.read(spark).collect()) == {1: 2}
    table.settle(spark)
    assert len(table.manifest(spark).parts) == 1 and dict(table.read(spark).collect()) == {1: 2}


def test_replaced_parts_outlive_their_readers(spark, tmp_path):
    now = [0.0]
    table = Levels(str(tmp_path), summing(["k"], ["n"]), fan=2, keep_seconds=60, clock=lambda: now[0])
    one = spark.createDataFrame([(1, 1)], "k long, n long")
    table.add(one, 0)
    reader = table.read(spark)
    table.add(one, 1)
    assert reader.collect()[0].n == 1 and len(table.manifest(spark).retired) == 2
    now[0] = 61.0
    table.add(one, 2)
    assert table.manifest(spark).retired == () and len(list((tmp_path / "parts").iterdir())) == 2
    assert dict(table.read(spark).collect()) == {1: 3}


def test_newest_row_of_a_key_survives_merges(spark, tmp_path):
    table = Levels(str(tmp_path), newest(["day", "k"], ["v"]), ("day",), fan=2)
    day = dt.date(2024, 1, 1)
    for batch, added in enumerate([[("a", 5), ("b", 1)], [("a", 4)], [("c", 7)], [("b", 0)], [("a", 3)]]):
        table.add(spark.createDataFrame([(day, k, v) for k, v in added], "day date, k string, v long"), batch)
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": 3, "b": 0, "c": 7}
    assert table.read(spark).where("day = date'2024-01-02'").count() == 0
    plan = table.rows(spark).where("day = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_table_without_batches_says_so(spark, tmp_path):
    with pytest.raises(ValueError):
        Levels(str(tmp_path), summing(["k"], ["n"])).read(spark)


def test_empty_batches(spark, tmp_path):
    table = Levels(str(tmp_path), summing(["k"], ["n"]), fan=2)
    none = spark.createDataFrame([], "k long, n long")
    for batch in range(3):
        table.add(none, batch)
    assert table.read(spark).count() == 0 and table.manifest(spark).last == 2


@pytest.mark.parametrize("cuts", [1, 5, 400])
def test_composed_runs_equal_the_fold(spark, cuts):
    """Cut anywhere, and composed in any grouping."""
    chance = random.Random(cuts)
    for name, values in groups().items():
        values = [float(np.float32(v)) for v in values]
        inner = sorted(chance.sample(range(1, len(values)), min(cuts - 1, len(values) - 1)))
        parts = [values[a:b] for a, b in zip([0, *inner], [*inner, len(values)], strict=True)]
        half = len(parts) // 2
        df = spark.createDataFrame([(parts,)], "p array<array<float>>").selectExpr(f"transform(p, x -> {step_maps.run_of('x')}) as p")
        left = df.selectExpr(f"{step_maps.composed_all('p')} as r")
        halves = [f"slice(p, 1, {half})", f"slice(p, {half + 1}, size(p))"] if half else ["p"]
        grouped = df.selectExpr(f"transform(array({', '.join(halves)}), q -> {step_maps.composed_all('q')}) as q")
        grouped = grouped.selectExpr(f"{step_maps.composed_all('q')} as r")
        want = running_mean(values)
        for frame in (left, grouped):
            assert np.float32(frame.selectExpr(f"{step_maps.mean_of('r')} as m").first().m) == want, (name, cuts)


T0 = dt.datetime(2024, 1, 1, 8)
PASSES = "device_id string, vehicle_type int, pass_ts timestamp, event_id long, speed float, length float"


def made(n, seed, seconds=90):
    chance = random.Random(seed)
    return [
        (chance.choice(["1", "2", None]), 0, T0 + dt.timedelta(milliseconds=chance.randrange(1000 * seconds)), i,
         float(np.float32(chance.uniform(0, 150))), float(np.float32(chance.uniform(2, 20))))
        for i in range(n)
    ]


@pytest.mark.parametrize("piece", [65536, 3])
def test_means_of_batches_in_any_order(spark, tmp_path, piece):
    data = made(400, piece)
    random.Random(1).shuffle(data)
    means, seen = RunningMeans(str(tmp_path), piece, fan=2), []
    for batch in range(4):
        part = data[batch * 100:batch * 100 + 100]
        for _ in range(2 if batch == 2 else 1):
            means.add(spark.createDataFrame(part, PASSES), batch)
        seen += part
        if batch in (0, 3):
            want = speed.speed_length_fold(spark.createDataFrame(seen, PASSES))
            assert rows(means.read(spark)) == rows(want)


def test_a_late_pass_changes_one_leaf_and_its_root(spark, tmp_path):
    means = RunningMeans(str(tmp_path), fan=100)
    data = [("1", 0, T0 + dt.timedelta(seconds=s), s, float(s), 1.0) for s in range(0, 120, 5)]
    means.add(spark.createDataFrame(data, PASSES), 0)
    late = ("1", 0, T0 + dt.timedelta(seconds=10, milliseconds=500), 999, 80.0, 2.0)
    means.add(spark.createDataFrame([late], PASSES), 1)
    changed = means.nodes.rows(spark).where("since_batch = 1").select("minute", "second").collect()
    assert sorted(r.second for r in changed) == [-1, 10] and {r.minute for r in changed} == {T0}
    assert rows(means.read(spark)) == rows(speed.speed_length_fold(spark.createDataFrame([*data, late], PASSES)))


def test_means_come_right_when_a_batch_fails_between_its_tables(spark, tmp_path, monkeypatch):
    data = made(60, 8, 20)
    means = RunningMeans(str(tmp_path))
    means.add(spark.createDataFrame(data[:30], PASSES), 0)
    real = Levels.add

    def broken(self, rows, batch_id):
        if self.path.endswith("nodes"):
            raise RuntimeError("lost")
        return real(self, rows, batch_id)

    with monkeypatch.context() as m:
        m.setattr(levels.Levels, "add", broken)
        with pytest.raises(RuntimeError):
            means.add(spark.createDataFrame(data[30:], PASSES), 1)
    means.add(spark.createDataFrame(data[30:], PASSES), 1)
    assert rows(means.read(spark)) == rows(speed.speed_length_fold(spark.createDataFrame(data, PASSES)))


def test_counts_without_means(spark, tmp_path):
    sink = flows.flow_sink(str(tmp_path), means=False, fan=2)
    data = made(50, 3)
    for batch in range(5):
        sink(spark.createDataFrame(data[batch * 10:batch * 10 + 10], PASSES), batch)
    assert flows.read_flow(spark, str(tmp_path), "day").agg(F.sum("n")).first()[0] == 50
    assert not (tmp_path / "means").exists() and len(flows.counts_table(str(tmp_path)).manifest(spark).parts) == 2
