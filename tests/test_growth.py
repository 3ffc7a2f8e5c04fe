"""What a task or a run of a streaming query holds as its input grows."""

import os

from pyspark.sql import functions as F

from kerbside.operators.lookup import even_join
from kerbside.plans import inputs, queries
from kerbside.streaming import jobs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_a_frame_is_one_batch_however_many_tasks_write_it(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 6)
    parts = [rows.where(F.col("id") % 4 == i) for i in range(3)] + [rows.where("id < 0")]
    stream, seen = inputs.files_stream(spark, parts, str(tmp_path / "in")), {}
    cfg = jobs.JobConfig(str(tmp_path / "query"), available_now=True)
    for arrived in stream.arrivals():
        jobs.start(arrived, lambda batch, batch_id: seen.update({batch_id: sorted(r.id for r in batch.collect())}), cfg).awaitTermination()
    assert seen == {**{i: list(range(i, 4000, 4)) for i in range(3)}, 3: []}
    assert len(files_of(tmp_path / "in")) == 3 * 6 + 1


def test_payloads_come_in_batches_of_bounded_size(spark, check_dir, tmp_path, monkeypatch):
    sizes, sink_of = [], jobs.decoded_sink

    def counted(*args, **kwargs):
        sink = sink_of(*args, **kwargs)

        def run(batch, batch_id):
            sizes.append(batch.count())
            sink(batch, batch_id)

        return run

    monkeypatch.setattr(jobs, "decoded_sink", counted)
    monkeypatch.setattr(queries, "PAYLOADS_A_FILE", 100)
    found = queries.QUERIES["stream_decode"](spark, check_dir)
    total = inputs.passes(spark, check_dir).count()
    assert found.count() == sum(sizes) == total
    assert max(sizes) <= 2 * spark.sparkContext.defaultParallelism * 100 < total


def test_a_stored_table_of_few_bytes_is_not_sent_whole(spark, tmp_path):
    spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("x")).write.parquet(str(tmp_path / "l"))
    extra = spark.createDataFrame([(None, "n"), ("7", "twice")], "k string, y string")
    spark.range(0, 10_000, 2).select(F.col("id").cast("string").alias("k"), F.lit("b").alias("y")).unionByName(extra).write.parquet(
        str(tmp_path / "r"))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in "lr")
    assert "BroadcastHashJoin" in plan(left.join(right, "k"))
    joined = even_join(left, right, "k", rows=200)
    assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
    # 10,002 rows in partitions of about 200.
    assert "hashpartitioning(k" in plan(joined) and ", 51)" in plan(joined)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_the_query_of_results_sends_no_table_whole(spark, check_dir):
    assert "BroadcastHashJoin" not in plan(queries.QUERIES["stream_results"](spark, check_dir))
