"""Streams of passes or payloads."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceConfig:
    """``format`` kafka needs ``servers`` and ``topic``; a file format needs ``path`` and ``schema``."""

    format: str = "kafka"
    servers: str = ""
    topic: str = ""
    starting_offsets: str = "latest"
    path: str = ""
    schema: T.StructType | str | None = None
    # Rows per trigger over all Kafka partitions, or files per trigger.
    max_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def pass_stream(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """Kafka records as (payload, topic, partition, offset, arrival_ts), or the rows of a file stream.

    Offsets live in the query's checkpoint, so a restart goes on where it stopped.
    """
    reader = spark.readStream.format(cfg.format).options(**cfg.options)
    if cfg.format != "kafka":
        if cfg.schema is not None:
            reader = reader.schema(cfg.schema)
        if cfg.max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", cfg.max_per_trigger)
        return reader.load(cfg.path)
    if not cfg.servers or not cfg.topic:
        raise ValueError("a kafka source needs servers and a topic")
    reader = (
        reader.option("kafka.bootstrap.servers", cfg.servers)
        .option("subscribe", cfg.topic)
        .option("startingOffsets", cfg.starting_offsets)
    )
    if cfg.max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", cfg.max_per_trigger)
    return reader.load().select(
        F.col("value").alias("payload"), "topic", "partition", "offset",
        F.col("timestamp").alias("arrival_ts"),
    )
