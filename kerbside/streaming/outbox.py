"""Messages that reach their readers once, though a batch may be sent again.

A batch's messages are stored before they are sent, each with an id of its own, and the manifest notes which batch is
stored and which was sent last. A batch that fails before its messages are stored is worked out anew; one that fails behind
that sends what was stored, with the same ids, even if the reference table has changed since; one that was
sent is not sent again. A topic cannot take part in that commit, so a batch that fails between sending and its
note is in the topic twice: readers drop ids that they have seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.streaming.levels import SharedFile

ID = "message_id"


class Outbox:
    """Stored messages below ``path``; ``publish`` is a ``send`` of the alerts job."""

    def __init__(self, path: str, send: Callable[[DataFrame, int], None]):
        self.path, self.send = path, send

    def _file(self, spark: SparkSession) -> SharedFile:
        return SharedFile(spark, f"{self.path}/manifest.json")

    def publish(self, messages: DataFrame, batch_id: int) -> None:
        spark, file = messages.sparkSession, self._file(messages.sparkSession)
        text = file.read()
        held = json.loads(text) if text else {"sent": -1, "stored": -1, "folder": None}
        if batch_id <= held["sent"]:
            return
        if held["stored"] != batch_id:
            old, held["folder"] = held["folder"], f"{batch_id}-{uuid.uuid4().hex}"
            with_ids(messages, batch_id).write.parquet(f"{self.path}/{held['folder']}")
            held["stored"] = batch_id
            file.replace(json.dumps(held))
            if old:
                file.delete_folder(f"{self.path}/{old}")
        self.send(spark.read.parquet(f"{self.path}/{held['folder']}"), batch_id)
        file.replace(json.dumps({**held, "sent": batch_id}))


def with_ids(messages: DataFrame, batch_id: int) -> DataFrame:
    """Messages with ids that tell equal ones of a batch apart, whatever the order of rows."""
    parts = [F.col(f"`{c}`") if kind == "binary" else F.col(f"`{c}`").cast("string") for c, kind in messages.dtypes]
    marked = messages.withColumn(ID, F.sha2(F.concat_ws("|", *[F.coalesce(F.hex(p), F.lit("-")) for p in parts]), 256))
    nth = F.row_number().over(Window.partitionBy(ID).orderBy(F.lit(0)))
    return marked.withColumn(ID, F.concat_ws("-", F.lit(str(batch_id)), F.col(ID), nth.cast("string")))


def kafka_records(messages: DataFrame) -> DataFrame:
    """Messages with their ids as headers, as `sinks.kafka_writer` takes them."""
    header = F.struct(F.lit(ID).alias("key"), F.encode(ID, "UTF-8").alias("value"))
    return messages.withColumn("headers", F.array(header)).drop(ID)


def once(messages: DataFrame) -> DataFrame:
    """Each message of a topic once."""
    return messages.dropDuplicates([ID])


def once_stream(messages: DataFrame, time: str, within: str) -> DataFrame:
    """The same on a stream, for repeats that come ``within`` that much time of the first."""
    return messages.withWatermark(time, within).dropDuplicatesWithinWatermark([ID])
