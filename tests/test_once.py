"""Messages sent once, reference tables by version, and searches by bitmap and by gram."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import bitmaps, grams, search
from kerbside.streaming import jobs, outbox, versions


def test_messages_get_the_same_ids_again(spark):
    rows = [("a", b"\xff\x00"), ("a", b"\xff\x00"), ("b", None), (None, b"x")]
    frame = spark.createDataFrame(rows, "key string, value binary")
    first, second = (sorted(r.message_id for r in outbox.with_ids(f, 7).collect()) for f in (frame, frame.repartition(3)))
    assert first == second and len(set(first)) == 4
    assert set(first).isdisjoint(r.message_id for r in outbox.with_ids(frame, 8).collect())
    record = outbox.kafka_records(outbox.with_ids(frame.where("key = 'b'"), 7)).first()
    assert record.headers[0].key == "message_id" and record.headers[0].value.decode() in first


def test_each_message_reaches_readers_once(spark, tmp_path):
    topic, broken = [], {"before": True, "behind": True}

    def send(messages, batch_id):
        if broken.pop("before", None):
            raise RuntimeError("lost before the send")
        topic.extend((r.message_id, r.key) for r in messages.collect())
        if broken.pop("behind", None):
            raise RuntimeError("lost behind the send")

    box = outbox.Outbox(str(tmp_path), send)
    make = lambda *keys: spark.createDataFrame([(k,) for k in keys], "key string")
    for _ in range(2):
        with pytest.raises(RuntimeError):
            box.publish(make("a", "b"), 0)
    # What the batch would give now does not matter: it has been stored.
    box.publish(make("c"), 0)
    box.publish(make("c"), 0)
    box.publish(make("d"), 1)
    assert sorted(k for _, k in topic) == ["a", "a", "b", "b", "d"]
    read = spark.createDataFrame(topic, "message_id string, key string")
    assert sorted(r.key for r in outbox.once(read).collect()) == ["a", "b", "d"]


def test_a_batch_keeps_its_version(spark, tmp_path):
    path, loads = str(tmp_path), []

    def load():
        loads.append(1)
        return spark.createDataFrame([(len(loads),)], "n int")

    count, table = versions.control_sink(path), versions.Versions(path, load)
    messages = lambda *texts: spark.createDataFrame([(t,) for t in texts], "value string")
    seen = lambda batch_id: spark.read.parquet(table.of_batch(spark, batch_id)).first().n
    assert [seen(0), seen(1)] == [1, 1]
    count(messages("old", "renew", None), 0)
    assert seen(2) == 1
    count(messages("new", "new"), 1)
    count(messages("new", "new"), 1)
    assert versions.messages_seen(spark, path) == 2
    # The batch before keeps what it had, by another reader too; the next one loads once for both messages.
    assert [versions.Versions(path, load).of_batch(spark, 2) == table.of_batch(spark, 1), seen(3), seen(4), seen(2)] == [True, 2, 2, 1]
    assert len(loads) == 2


def test_versions_reach_the_work_of_a_batch(spark, tmp_path):
    loads, got = [], []
    table = versions.Versions(str(tmp_path), lambda: loads.append(1) or spark.range(len(loads)).toDF("id"))
    sink = jobs.with_refresh(table, lambda batch, batch_id, held, join: got.append((batch_id, held.count())))
    count = versions.control_sink(str(tmp_path))
    for batch_id in (0, 1, 1):
        sink(spark.range(1), batch_id)
    count(spark.createDataFrame([("new",)], "value string"), 0)
    for batch_id in (1, 2, 1):
        sink(spark.range(1), batch_id)
    assert got == [(0, 1), (1, 1), (1, 1), (1, 1), (2, 2), (1, 1)]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    chance, path = random.Random(2), str(tmp_path_factory.mktemp("bitmaps"))
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i, start + dt.timedelta(seconds=chance.randrange(3000)) if i % 50 else None, chance.choice(["a", "b", None]),
         chance.randrange(3), chance.random() < 0.5)
        for i in range(400)
    ]
    frame = spark.createDataFrame(rows, "event_id long, pass_ts timestamp, vehicle_brand string, dir int, tag boolean")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(bitmaps, "BLOCK", 64)
        for batch in (0, 1, 1):
            bitmaps.index_batch(frame.where(F.col("event_id") % 2 == batch), batch, path, ["vehicle_brand", "dir", "tag"])
    return path, frame


T = ["2024-01-01 00:10:00", "2024-01-01 00:40:00"]


@pytest.mark.parametrize("terms,start,end", [
    ({"vehicle_brand": "a"}, None, None), ({"vehicle_brand": "a", "dir": 1, "tag": True}, *T), ({"dir": 2}, None, T[1]), ({}, *T),
    ({"vehicle_brand": "x"}, T[0], None),
])
def test_bitmap_search_equals_the_search(spark, indexed, terms, start, end):
    path, frame = indexed
    want = sorted(r.event_id for r in search.attr_search(frame, start, end, **terms).collect())
    assert sorted(r.event_id for r in bitmaps.search(spark, path, start, end, **terms).collect()) == want
    counted = bitmaps.count(spark, path, start, end, **terms)
    assert counted.first().total == len(want)
    assert "/passes/" not in counted._jdf.queryExecution().executedPlan().toString()


def test_unknown_terms_are_refused(spark, indexed):
    with pytest.raises(ValueError):
        bitmaps.count(spark, indexed[0], colour="red")


def test_grams_of_patterns():
    assert grams.pattern_grams("粤B", "12") == [">0粤", ">1B", "<02", "<11"]
    assert grams.pattern_grams("粤B?", "1{2}") == [">0粤"]
    assert grams.pattern_grams("[粤]", "[1-3]") == [] and grams.pattern_grams("a|b", "1") == [] and grams.pattern_grams(".", "x") == ["<0x"]


def test_gram_search_equals_the_search(spark, tmp_path):
    chance, start = random.Random(4), dt.datetime(2024, 1, 1)
    plates = [None, "", "粤", *("".join((chance.choice("粤京"), *chance.choices("AB123", k=chance.choice([5, 6, 7])))) for _ in range(150))]
    rows = [(i, start + dt.timedelta(hours=chance.randrange(72)) if i % 40 else None, chance.choice(plates)) for i in range(500)]
    frame = spark.createDataFrame(rows, "event_id long, pass_ts timestamp, plate string")
    for batch in (0, 1, 1):
        grams.index_batch(frame.where(F.col("event_id") % 2 == batch), batch, str(tmp_path))
    at = ("2024-01-01 05:00:00", "2024-01-03 12:00:00")
    for province, suffix in (("粤", "2"), ("", "1"), ("粤A", "B3"), ("[粤京]", "[12]"), ("京", "A?"), ("X", "1"), (".", "1|2")):
        want = sorted(r.event_id for r in search.plate_search(frame, at[0], province, suffix, end=at[1]).collect())
        found = grams.plate_search(spark, str(tmp_path), at[0], province, suffix, at[1])
        assert sorted(r.event_id for r in found.collect()) == want, (province, suffix)
    plan = grams.plate_search(spark, str(tmp_path), at[0], "粤", "2", at[1])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram," in plan
