"""Plate search by postings of positional grams.

A batch writes, beside its passes in day folders, the distinct plates of each day under every gram of theirs: a character
with its place from the start, or from the end, of the plate. A pattern whose ends are plain text names some of these grams;
the search reads the postings of the rarest one, tests the plates that it finds there against the whole pattern, and fetches the passes of
their days and plates alone. So a search by the last character, which no prefix test helps, does not read all plates.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.timing import in_time_range

BATCH = "batch_id"
#: Places from each end that are indexed; plates have seven or eight characters.
DEPTH = 8
_PLAIN = re.compile(r"[^.?+*|{}\[\]()\"\\#@&<>~^$]*")


def _write(rows: DataFrame, path: str, name: str, batch_id: int, *folders: str) -> None:
    rows.write.mode("overwrite").partitionBy(*folders).parquet(f"{path}/{name}/{BATCH}={batch_id}")


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")


def grams_of(plate: Column) -> Column:
    """``>0粤`` for a plate that starts so, ``<0`` and its last character, and so on."""
    places = F.sequence(F.lit(0), F.least(F.lit(DEPTH), F.length(plate)) - 1)
    one = lambda mark, at: F.transform(places, lambda i: F.concat(F.lit(mark), i.cast("string"), plate.substr(at(i), F.lit(1))))
    both = F.concat(one(">", lambda i: i + 1), one("<", lambda i: F.length(plate) - i))
    return F.when(F.length(plate) > 0, both).otherwise(F.array().cast("array<string>"))


def index_batch(batch: DataFrame, batch_id: int, path: str, time: str = "pass_ts", plate: str = "plate") -> None:
    """Write the passes of a batch by day, and the postings of its plates; a replay overwrites both."""
    dated = batch.withColumn("day", F.to_date(time))
    _write(dated.sortWithinPartitions(plate), path, "passes", batch_id, "day")
    plates = _read(batch.sparkSession, path, "passes").where(F.col(BATCH) == batch_id).select("day", F.col(plate).alias("plate")).distinct()
    postings = plates.select(F.explode(grams_of(F.col("plate"))).alias("gram"), "day", "plate")
    # In order of the gram, so that a reader skips all row groups but those of its own.
    _write(postings.repartitionByRange("gram", "day", "plate").sortWithinPartitions("gram"), path, "postings", batch_id)
    _write(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).coalesce(1), path, "sizes", batch_id)


def pattern_grams(province: str, suffix: str) -> list[str]:
    """The grams that every plate of ``province`` + five characters + ``suffix`` has, as far as these are plain text."""
    if "|" in province + suffix:
        return []
    start = _PLAIN.match(province)[0]
    end = _PLAIN.match(suffix[::-1])[0]
    # A quantifier behind the plain text may drop its last character.
    if len(start) < len(province):
        start = start[:-1]
    if len(end) < len(suffix):
        end = ""
    return [f">{i}{c}" for i, c in enumerate(start[:DEPTH])] + [f"<{i}{c}" for i, c in enumerate(end[:DEPTH])]


def rarest(spark: SparkSession, path: str, grams: Sequence[str]) -> str | None:
    """The gram with the fewest postings; None if some gram has none."""
    sizes = {r.gram: r.n for r in _read(spark, path, "sizes").where(F.col("gram").isin(list(grams))).groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    return min(sizes, key=lambda g: (sizes[g], g)) if len(sizes) == len(set(grams)) else None


def plate_search(spark: SparkSession, path: str, start, province: str, suffix: str, end, time: str = "pass_ts", plate: str = "plate") -> DataFrame:
    """As `search.plate_search`, over an indexed table."""
    whole = F.col("plate").rlike(f"(?s)^(?:{province}.{{5}}{suffix})\\z")
    passes = _read(spark, path, "passes").filter(in_time_range(time, start, end, "timestamp")).filter(in_time_range("day", start, end, "date"))
    grams = pattern_grams(province, suffix)
    if not grams:
        return passes.filter(whole).drop("day", BATCH)
    gram = rarest(spark, path, grams)
    if gram is None:
        return passes.limit(0).drop("day", BATCH)
    found = _read(spark, path, "postings").where((F.col("gram") == gram) & whole).filter(in_time_range("day", start, end, "date"))
    plates = found.select(BATCH, F.col("day"), F.col("plate").alias(plate)).distinct()
    # The days and batches of the plates prune the folders of the passes.
    return passes.join(plates, [BATCH, "day", plate]).drop("day", BATCH)
