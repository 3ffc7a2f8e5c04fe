"""Attribute search by bitmaps.

Each batch numbers its passes in order of time. Per 32,768 of them, a block, the index holds one bitmap for every
value of every attribute, and the sorted times. A search takes the and of the bitmaps of its terms; in
blocks that the time range cuts, a bitmap of the places inside it is one term more. So a count reads the index alone,
and a search fetches its hits by batch, block and place. Blocks that the range leaves out are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.paging import number_rows
from kerbside.operators.search import TERMS

# Fixed value: places in a bitmap of the engine.
BLOCK = 32768
BATCH = "batch_id"
_PLACE = [BATCH, "block", "place"]
# Stands for the time of a pass that has none; it lies before every range.
_NO_TIME = "timestamp'0001-01-01 00:00:00'"


def _write(rows: DataFrame, path: str, name: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{name}/{BATCH}={batch_id}")


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")


def index_batch(
    batch: DataFrame, batch_id: int, path: str, attributes: Sequence[str] = TERMS, time: str = "pass_ts",
    order: Sequence[str] = ("pass_ts", "event_id"),
) -> None:
    """Write the passes of a batch and their index; a replay overwrites both. ``order`` is unique and starts with ``time``."""
    placed = number_rows(batch, order).withColumn("block", F.floor(F.col("position") / BLOCK)).withColumn(
        "place", (F.col("position") % BLOCK).cast("int")).drop("position")
    _write(placed.sortWithinPartitions("block", "place"), path, "passes", batch_id)
    rows = _read(batch.sparkSession, path, "passes").where(F.col(BATCH) == batch_id)
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(f"`{a}`").cast("string").alias("value")) for a in attributes]))
    # A bitmap has one size, and is built before the exchange.
    bits = rows.select("block", "place", pairs.alias("p")).where("p.value is not null").groupBy("block", "p.attribute", "p.value").agg(
        F.bitmap_construct_agg("place").alias("bits"))
    _write(bits.sortWithinPartitions("attribute", "value", "block"), path, "bits", batch_id)
    when = F.coalesce(F.col(time), F.expr(_NO_TIME))
    blocks = rows.groupBy("block").agg(
        F.min(when).alias("low"), F.max(when).alias("high"), F.array_sort(F.collect_list(when)).alias("times"))
    _write(blocks, path, "blocks", batch_id)


def matching(spark: SparkSession, path: str, start=None, end=None, **terms) -> DataFrame:
    """(batch_id, block, bits) of the passes that equal every term, within the inclusive time range."""
    unknown = set(terms) - set(TERMS)
    if unknown:
        raise ValueError(f"unknown terms: {sorted(unknown)}")
    start, end = (None if t is None else F.lit(t).cast("timestamp") for t in (start, end))
    if end is not None and start is None:
        # Passes without a time are in no range.
        start = F.expr(_NO_TIME) + F.expr("interval 1 microsecond")
    blocks, inside = _read(spark, path, "blocks"), F.lit(True)
    if start is not None:
        blocks, inside = blocks.where(F.col("high") >= start), inside & (F.col("low") >= start)
    if end is not None:
        blocks, inside = blocks.where(F.col("low") <= end), inside & (F.col("high") <= end)
    known = blocks.select(BATCH, "block", (~inside).alias("cut"))
    # The sorted times of a block that the range cuts tell its first and last place inside.
    first = F.size(F.filter("times", lambda t: t < start)) if start is not None else F.lit(0)
    upto = F.size(F.filter("times", lambda t: t <= end)) if end is not None else F.size("times")
    places = blocks.where(~inside).select(BATCH, "block", first.alias("first"), upto.alias("upto")).where("first < upto").select(
        BATCH, "block", F.explode(F.sequence("first", F.col("upto") - 1)).alias("place"))
    within = places.groupBy(BATCH, "block").agg(F.bitmap_construct_agg("place").alias("bits"))
    asked = F.lit(False)
    for name, value in terms.items():
        asked = asked | ((F.col("attribute") == name) & (F.col("value") == F.lit(value).cast("string")))
    named = _read(spark, path, "bits").where(asked).select(BATCH, "block", "bits")
    if not terms:
        # All places of a block.
        every = blocks.where(inside).select(BATCH, "block", F.explode(F.sequence(F.lit(0), F.size("times") - 1)).alias("place"))
        return every.groupBy(BATCH, "block").agg(F.bitmap_construct_agg("place").alias("bits")).unionByName(within)
    both = named.unionByName(within).join(known, [BATCH, "block"])
    anded = both.groupBy(BATCH, "block").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"), F.first("cut").alias("cut"))
    return anded.where(F.col("n") == len(terms) + F.col("cut").cast("int")).select(BATCH, "block", "bits")


def count(spark: SparkSession, path: str, start=None, end=None, **terms) -> DataFrame:
    """The number of matching passes, from the index alone."""
    found = matching(spark, path, start, end, **terms)
    return found.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias("total"))


def search(spark: SparkSession, path: str, start=None, end=None, **terms) -> DataFrame:
    """The matching passes, fetched by their places."""
    octets = (
        "transform(filter(sequence(0, 4095), i -> substring(x, 2 * i + 1, 2) != '00'),"
        " i -> struct(i as i, cast(conv(substring(x, 2 * i + 1, 2), 16, 10) as int) as b))")
    # Bit k of byte i is place 8 i + k.
    places = f"flatten(transform({octets}, o -> transform(filter(sequence(0, 7), k -> getbit(o.b, k) = 1), k -> 8 * o.i + k)))"
    hits = matching(spark, path, start, end, **terms).select(BATCH, "block", F.hex("bits").alias("x")).select(
        BATCH, "block", F.explode(F.expr(places)).alias("place"))
    return _read(spark, path, "passes").join(hits, _PLACE).drop(*_PLACE)
