"""Search hits joined with their detail rows and keyed-JSON dimensions.

A detail row belongs to one hit, so that join has no busy key and stays plain; a
dimension row belongs to many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.maps import merge_maps
from kerbside.operators.lookup import Join, lookup_join

# Columns of the detail table that a lookup returns.
DETAIL_COLUMNS = (
    "license", "plate_type", "plate_color", "confidence", "license_attribution", "image_url", "car_color",
    "result_time", "direction", "frame_index", "vehicle_kind", "vehicle_brand", "vehicle_style", "location_left",
)


def lookup_result(keys: DataFrame, result: DataFrame) -> DataFrame:
    """Detail columns per key, nulls where there is none; ``HP`` repeats the licence."""
    details = result.select("result_id", *DETAIL_COLUMNS, F.col("license").alias("HP"))
    return keys.join(details, "result_id", "left")


def enrich_result(hits: DataFrame, result: DataFrame, task: DataFrame) -> DataFrame:
    """Hits with ``merged``: the detail row's ``HP``, then the task's attributes over it.

    ``task`` is (task_id, attrs), see `load_dim`.
    """
    details = result.select("result_id", F.create_map(F.lit("HP"), F.col("license")).alias("_detail"))
    detailed = hits.join(details, "result_id", "left")
    joined = lookup_join(detailed, task.select("task_id", F.col("attrs").alias("_task")), "task_id", "left", hits)
    merged = merge_maps(F.col("_detail"), F.col("_task")).alias("merged")
    return joined.select(*hits.columns, merged)


def enrich_dims(
    hits: DataFrame, task: DataFrame, camera: DataFrame, data_source: DataFrame, join: Join = lookup_join
) -> DataFrame:
    """Hits with ``task`` (its attributes alone) and ``merged``: task, camera, then data source."""
    joined = hits
    for dim, key in ((task, "task_id"), (camera, "camera_id"), (data_source, "data_source_id")):
        joined = join(joined, dim.select(key, F.col("attrs").alias(f"_{key}")), key, "left", hits)
    merged = merge_maps(F.col("_task_id"), F.col("_camera_id"), F.col("_data_source_id"))
    return joined.select(*hits.columns, F.col("_task_id").alias("task"), merged.alias("merged"))
