"""Keyed tables fed by micro-batches, on plain files.

A micro-batch is written whole into a folder of its own, ``batch_id=N``, which a
replay overwrites: nothing else is touched, so a lost executor or a repeated
batch leaves the table as it should be. Readers take the newest row per key, and
`compact` folds the batches into a fresh copy from time to time. A writer of a
lakehouse table would use MERGE instead; the batch functions keep the same shape.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators import archive
from kerbside.streaming.levels import Levels
from kerbside.streaming.levels import newest as latest_of

BATCH = "batch_id"
DAY = "day"

Batch = Callable[[DataFrame, int], None]


def write_batch(batch: DataFrame, batch_id: int, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replaceable write of one micro-batch. Partition by ``day`` what is searched by time."""
    batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}")


def write_by_day(batch: DataFrame, batch_id: int, path: str, time: str) -> None:
    """The same, in folders by the day of a time column or text; rows without a day have a folder of their own."""
    day = F.try_to_timestamp(F.substring(F.col(time).cast("string"), 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    write_batch(batch.withColumn(DAY, day), batch_id, path, [DAY])


def write_some(batch: DataFrame, batch_id: int, path: str) -> None:
    """The same for what is mostly empty: a batch without rows leaves no folder."""
    if not batch.isEmpty():
        write_batch(batch, batch_id, path)


def read_days(spark: SparkSession, path: str, time: str, start: str, end: str) -> DataFrame:
    """Rows whose time text lies between two, both included; only folders of those days are read."""
    days = F.col(DAY).between(F.to_date(F.lit(start[:10])), F.to_date(F.lit(end[:10])))
    return read_batches(spark, path).filter(days & F.col(time).between(start, end))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def read_latest(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """The table: per key the row of the newest batch."""
    return newest(read_batches(spark, path), key)


def newest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key; two rows of one key in one batch are settled by their content."""
    rest = [c for c in rows.columns if c not in (*key, BATCH, DAY)]
    kept = rows.groupBy(*key).agg(F.max(F.struct(BATCH, *rest)).alias("row"))
    return kept.select(*key, *[F.col(f"row.{c}").alias(c) for c in rest])


def compact(spark: SparkSession, path: str, target: str, key: Sequence[str], last_batch: int) -> None:
    """Copy the newest rows up to ``last_batch`` into ``target`` as that batch.

    ``target`` is a new path: the old one stays readable until readers and the
    writer have moved on, and no plan reads what it overwrites.
    """
    rows = read_batches(spark, path).filter(F.col(BATCH) <= last_batch)
    write_batch(newest(rows, key), last_batch, target)


def table_sink(path: str) -> Batch:
    """Upsert on ``row_key``: the alarm and the violation table."""
    return lambda batch, batch_id: write_batch(batch, batch_id, path)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path, ["row_key"])


def keyed_table(path: str, key: str = "row_key", buckets: int = 64, fan: int = 4) -> Levels:
    """A table with one row per key, the newest, in hash buckets: `Levels.add` upserts a batch, `Levels.read` gives all rows.

    Neither reading nor merging exchanges rows; a lookup of one key reads one bucket of each part. The number of buckets
    stays with the table.
    """
    return Levels(path, latest_of([key]), fan=fan, bucket_by=(key,), buckets=buckets)


# Outputs that are searched by time, and the column that has it.
TIMED = {"meta": "Time", "index": "Time"}

ARCHIVE: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "meta": archive.traffic_meta,
    "image": archive.traffic_image,
    "index": archive.traffic_index,
}

# The same fan-out for recognition results: detail rows and their search documents.
RESULTS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "result": archive.result_detail,
    "index": archive.result_index,
}


def fan_out(
    batch: DataFrame, batch_id: int, path: str,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]] = ARCHIVE,
) -> None:
    """Write several projections of one micro-batch, computing the batch once.

    Any failed write fails the batch, which is then repeated as a whole.
    """
    kept = batch.persist()
    try:
        for name, project in outputs.items():
            out = project(kept)
            if TIMED.get(name) in out.columns:
                write_by_day(out, batch_id, f"{path}/{name}", TIMED[name])
            else:
                write_batch(out, batch_id, f"{path}/{name}")
    finally:
        kept.unpersist()


def kafka_writer(records: DataFrame, servers: str, topic: str):
    """Batch writer of (key, value) records; the topic has no default."""
    if not servers or not topic:
        raise ValueError("a kafka sink needs servers and a topic")
    return (
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    )
