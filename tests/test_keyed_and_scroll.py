"""Keyed tables in buckets, and pages of a search at a point in time."""

import os

import pytest
from pyspark.sql import functions as F

from kerbside.operators import scroll
from kerbside.plans import inputs
from kerbside.streaming import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upserts_and_reads_of_a_bucketed_table_exchange_nothing(spark, tmp_path):
    table, truth = sinks.keyed_table(str(tmp_path / "t"), buckets=4, fan=3), {}
    for batch in range(8):
        added = {f"k{i}": batch * 100 + i for i in range(batch, 40, 3)}
        for _ in range(2 if batch == 4 else 1):
            table.add(spark.createDataFrame(list(added.items()), "row_key string, n long"), batch)
        truth |= added
    read = table.read(spark)
    found = read.collect()
    assert dict(found) == truth and len(found) == len(truth) and "Exchange" not in plan(read)
    held = table.manifest(spark)
    assert [p.level for p in held.parts] == [1, 1, 0, 0]
    merged = f"__part={held.parts[0].folder}"
    files = [f for f in os.listdir(tmp_path / "t" / "parts" / merged) if f.endswith(".parquet")]
    assert len(files) <= 4
    assert spark.read.parquet(str(tmp_path / "t" / "parts" / merged)).groupBy("row_key").count().where("count > 1").count() == 0
    one = table.read(spark).where("row_key = 'k7'")
    assert "SelectedBucketsCount: 1 out of 4" in plan(one) and [r.n for r in one.collect()] == [truth["k7"]]


def test_rows_of_one_key_in_a_batch_are_settled_by_content(spark, tmp_path):
    table = sinks.keyed_table(str(tmp_path / "t"), buckets=2)
    table.add(spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "row_key string, n long"), 0)
    table.add(spark.createDataFrame([("b", 2), (None, 5)], "row_key string, n long"), 1)
    assert dict(table.read(spark).collect()) == {"a": 3, "b": 2, None: 5}


@pytest.fixture
def searched(spark, sf_dir, tmp_path):
    passes = inputs.passes(spark, sf_dir).select("event_id", "pass_ts", "plate", "dir")
    path = str(tmp_path / "searched")
    for batch in range(2):
        sinks.write_batch(passes.where(F.col("event_id") % 3 == batch), batch, path)
    return path, passes


def hits(rows):
    return rows.where("dir = 1").select("event_id", "pass_ts", "plate")


@pytest.mark.parametrize("ranges,size", [(200, 7), (3, 100), (1, 10_000)])
def test_pages_follow_one_another_while_batches_arrive(spark, searched, ranges, size):
    path, passes = searched
    want = [tuple(r) for r in hits(passes.where("event_id % 3 < 2")).orderBy("pass_ts", "event_id").collect()]
    cursor, got = scroll.open_cursor(spark, path, hits, size, ranges=ranges), []
    assert cursor.rows == len(want) and cursor.pages == -(-len(want) // size)
    for page in sorted({0, 1, cursor.pages // 2, cursor.pages - 1}):
        at = scroll.Cursor.parse(cursor.text())
        for _ in range(page):
            at = at.turned()
        got = [tuple(r) for r in scroll.read_page(spark, path, hits, at).collect()]
        assert got == want[page * size:page * size + size]
        sinks.write_batch(passes.where(F.col("event_id") % 3 == 2), 5, path)
    for _ in range(cursor.pages):
        cursor = cursor.turned()
    assert scroll.read_page(spark, path, hits, cursor).count() == 0
    # Batches that came since are in a cursor opened now.
    assert scroll.open_cursor(spark, path, hits, size).rows > len(want)


def test_a_page_reads_its_range_alone(spark, searched):
    path, _ = searched
    cursor = scroll.open_cursor(spark, path, hits, 5).turned()
    text = plan(scroll.read_page(spark, path, hits, cursor))
    assert "PartitionFilters: [isnotnull(batch_id" in text and "GreaterThanOrEqual(pass_ts" in text


def test_a_cursor_expires(spark, searched):
    path, _ = searched
    cursor = scroll.open_cursor(spark, path, hits, 5, keep_seconds=60, now=1000.0)
    assert scroll.read_page(spark, path, hits, cursor, now=1060.0).count() == 5
    cursor = cursor.turned(now=1050.0)
    assert scroll.read_page(spark, path, hits, cursor, now=1109.0).count() == 5
    with pytest.raises(scroll.CursorExpired):
        scroll.read_page(spark, path, hits, cursor, now=1111.0)


def test_a_search_without_hits(spark, searched):
    path, _ = searched
    none = lambda rows: hits(rows).where("plate = 'x'")
    cursor = scroll.open_cursor(spark, path, none, 5)
    assert cursor.pages == 0 and scroll.read_page(spark, path, none, cursor).count() == 0


@pytest.mark.parametrize("ranges,size", [(200, 7), (3, 100), (1, 10_000)])
def test_the_pages_left_come_in_one_job(spark, searched, ranges, size):
    path, passes = searched
    want = [tuple(r) for r in hits(passes.where("event_id % 3 < 2")).orderBy("pass_ts", "event_id").collect()]
    cursor = scroll.open_cursor(spark, path, hits, size, ranges=ranges)
    sinks.write_batch(passes.where(F.col("event_id") % 3 == 2), 5, path)

    def numbered(first, end):
        return {(*row, i // size) for i, row in enumerate(want) if first <= i // size < end}

    assert cursor.pages == 1 or len(numbered(1, cursor.pages)) == len(want) - size
    for at, pages in ((cursor, None), (cursor, 2), (cursor.turned(), None), (cursor.turned().turned(), 3)):
        found = scroll.read_pages(spark, path, hits, at, pages)
        assert found.columns == ["event_id", "pass_ts", "plate", "page"]
        assert sorted(map(tuple, found.collect())) == sorted(numbered(at.page, at.page + (pages or cursor.pages)))
    with pytest.raises(scroll.CursorExpired):
        scroll.read_pages(spark, path, hits, cursor, now=cursor.expires + 1)


def test_a_scroll_takes_as_many_jobs_for_many_pages_as_for_few(spark, tmp_path):
    jobs_of = []
    for rows in (100, 3000):
        path = str(tmp_path / str(rows))
        made = spark.range(rows).selectExpr("id as event_id", "timestamp_seconds(id div 3) as pass_ts", "'x' as plate", "1 as dir")
        sinks.write_batch(made, 0, path)
        cursor = scroll.open_cursor(spark, path, hits, 5)
        spark.sparkContext.setJobGroup(f"pages-{rows}", "pages")
        found = scroll.read_pages(spark, path, hits, cursor).groupBy("page").count().collect()
        jobs_of.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"pages-{rows}")))
        assert sorted(map(tuple, found)) == [(p, 5) for p in range(rows // 5)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert abs(jobs_of[0] - jobs_of[1]) <= 2


def test_no_hits_leave_no_pages(spark, searched):
    path, _ = searched
    none = lambda rows: hits(rows).where("plate = 'x'")
    found = scroll.read_pages(spark, path, none, scroll.open_cursor(spark, path, none, 5))
    assert found.columns[-1] == "page" and found.count() == 0
