"""Reference tables in versions, renewed by control messages.

A control stream counts the messages that say ``new``. Each micro-batch of a job takes the newest version: where
messages came since that was loaded, the table is loaded and stored as another one. Which version a batch took is
noted before it is used, so a batch that is repeated, even by another driver, works with the version it had.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.streaming.levels import SharedFile

# Fixed value: the message that asks for a refresh.
NEW = "new"
#: Batches whose version is remembered; a stream repeats its last batch only.
BATCHES_KEPT = 100


def control_sink(path: str, column: str = "value") -> Callable[[DataFrame, int], None]:
    """Counts the refresh messages of a control stream in a file below ``path``; a replayed batch adds none."""

    def count(batch: DataFrame, batch_id: int) -> None:
        file = SharedFile(batch.sparkSession, f"{path}/control.json")
        text = file.read()
        held = json.loads(text) if text else {"last": -1, "messages": 0}
        if batch_id > held["last"]:
            asked = batch.where(F.col(column).cast("string") == NEW).count()
            file.replace(json.dumps({"last": batch_id, "messages": held["messages"] + asked}))

    return count


def messages_seen(spark: SparkSession, path: str) -> int:
    text = SharedFile(spark, f"{path}/control.json").read()
    return json.loads(text)["messages"] if text else 0


class Versions:
    """Stored versions of one reference table below ``path``, where the control stream counts too."""

    def __init__(self, path: str, load: Callable[[], DataFrame]):
        self.path, self.load = path, load

    def of_batch(self, spark: SparkSession, batch_id: int) -> str:
        """Folder of the version that the batch works with."""
        file = SharedFile(spark, f"{self.path}/versions.json")
        text = file.read()
        held = json.loads(text) if text else {"messages": -1, "folder": None, "batches": {}}
        if str(batch_id) in held["batches"]:
            return held["batches"][str(batch_id)]
        seen = messages_seen(spark, self.path)
        if held["folder"] is None or seen > held["messages"]:
            folder = f"{self.path}/version-{uuid.uuid4().hex}"
            self.load().write.parquet(folder)
            held.update(messages=seen, folder=folder)
        batches = {**held["batches"], str(batch_id): held["folder"]}
        held["batches"] = dict(sorted(batches.items(), key=lambda b: int(b[0]))[-BATCHES_KEPT:])
        file.replace(json.dumps(held))
        return held["folder"]
