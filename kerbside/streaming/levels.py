"""Tables whose rows add up, kept in levels of parts under one manifest.

Every micro-batch adds a part, a folder of its own. Where ``fan`` parts of one level lie at the end, they are
merged to one part of the next level, so a table of n batches has some ``fan * log(n)`` folders and a row is
rewritten once a level. What merging does is the caller's: counts are summed, keyed rows are chosen.

The manifest is the table: a small file that names the live parts and the last batch, and is
replaced by a rename in one step. A part that no manifest names was left by a failed batch and is never read; a batch that
the manifest holds already was replayed and is not added again. A keyed table may be dealt to a fixed number of ``buckets`` by its
key: parts then lie ready by bucket, so that merges and reads of the whole table exchange nothing, and a row is looked up in
one bucket of each part. Merged parts stay on disk for
``keep_seconds``, for readers that hold an older manifest. One query with one checkpoint writes a table, as batches are told
by their numbers: a job that starts with a new checkpoint needs a new table. The shared storage must
rename files atomically, as HDFS and local file systems do.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The least batch of the part that a row was read from: rows of later batches have a greater one.
SINCE = "since_batch"
# Name of the part folders' column, which no table has.
_FOLDER = "__part"

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Part:
    folder: str
    first: int
    last: int
    level: int = 0


@dataclass(frozen=True)
class Manifest:
    """Live parts by batch, the schema of their rows, and parts to delete with the time they were replaced."""

    last: int = -1
    schema: str | None = None
    parts: tuple[Part, ...] = ()
    retired: tuple[tuple[str, float], ...] = ()

    @staticmethod
    def parse(text: str) -> Manifest:
        told = json.loads(text)
        return Manifest(
            told["last"], told["schema"], tuple(Part(**p) for p in told["parts"]), tuple((f, at) for f, at in told["retired"]))

    def text(self) -> str:
        return json.dumps(asdict(self))


class SharedFile:
    """A small text file on shared storage, read and replaced whole."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, self._hadoop_path(spark, path)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    @staticmethod
    def _hadoop_path(spark: SparkSession, path: str):
        return spark._jvm.org.apache.hadoop.fs.Path(path)

    def read(self) -> str | None:
        if not self._files.exists(self._path):
            return None
        stream = self._files.open(self._path)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, text: str) -> None:
        """Written beside the old file and renamed over it, so readers see the one or the other."""
        jvm, conf = self._spark._jvm, self._spark._jsc.hadoopConfiguration()
        beside = self._hadoop_path(self._spark, f"{self._path.toString()}.{uuid.uuid4().hex}")
        out = self._files.create(beside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self._spark._sc._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path.toUri(), conf).rename(beside, self._path, options)

    def delete_folder(self, folder: str) -> None:
        self._files.delete(self._hadoop_path(self._spark, folder), True)


@dataclass(frozen=True)
class Levels:
    """One table. ``merge`` takes rows of several parts, with ``SINCE``, and returns rows of the same columns without it."""

    path: str
    merge: Merge
    partition_by: tuple[str, ...] = ()
    fan: int = 4
    bucket_by: tuple[str, ...] = ()
    buckets: int = 64
    keep_seconds: float = 3600.0
    clock: Callable[[], float] = field(default=time.time, compare=False)

    def _file(self, spark: SparkSession) -> SharedFile:
        return SharedFile(spark, f"{self.path}/manifest.json")

    def manifest(self, spark: SparkSession) -> Manifest:
        text = self._file(spark).read()
        return Manifest.parse(text) if text else Manifest()

    def _folder(self, part: str) -> str:
        return f"{self.path}/parts/{_FOLDER}={part}"

    def _write(self, rows: DataFrame, first: int, last: int, level: int) -> Part:
        part = Part(f"{first}-{last}-{uuid.uuid4().hex}", first, last, level)
        if self.bucket_by:
            if not level:
                # Merged rows come bucket by bucket already.
                rows = rows.repartition(self.buckets, *self.bucket_by)
            name = f"levels_part_{uuid.uuid4().hex}"
            dealt = rows.write.format("parquet").bucketBy(self.buckets, *self.bucket_by).sortBy(*self.bucket_by)
            dealt.option("path", self._folder(part.folder)).saveAsTable(name)
            # The files stay.
            rows.sparkSession.sql(f"DROP TABLE {name}")
            return part
        if self.partition_by:
            # Small days share a file each, large ones are split.
            rows = rows.hint("rebalance", *self.partition_by)
        rows.write.partitionBy(*self.partition_by).parquet(self._folder(part.folder))
        return part

    def _bucketed(self, spark: SparkSession, shape: StructType, parts: Sequence[Part]) -> DataFrame:
        """Part folders as one partitioned table of the session, as a table alone makes buckets known to the planner.

        One scan then reads a bucket of all parts in one task.
        """
        name = f"levels_{hashlib.md5(self.path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape)
        keys = ", ".join(f"`{c}`" for c in self.bucket_by)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({_FOLDER}) "
            f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/parts'")
        known = " ".join(f"PARTITION ({_FOLDER} = '{p.folder}')" for p in parts)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {known}")
        return spark.table(name).where(F.col(_FOLDER).isin([p.folder for p in parts]))

    def add(self, rows: DataFrame, batch_id: int) -> bool:
        """Add the rows of a batch; False if the table has that batch already."""
        spark = rows.sparkSession
        held = self.manifest(spark)
        if batch_id <= held.last:
            return False
        parts = (*held.parts, self._write(rows, batch_id, batch_id, 0))
        self._replace(spark, replace(held, last=batch_id, schema=held.schema or rows.schema.json(), parts=parts))
        self.settle(spark)
        return True

    def settle(self, spark: SparkSession) -> None:
        """Merge until no level has ``fan`` parts at the end, and delete what was replaced long ago."""
        held = self.manifest(spark)
        while len(tail := held.parts[-self.fan:]) == self.fan and len({p.level for p in tail}) == 1:
            rows = self.merge(self._rows(spark, held, tail)).select(*StructType.fromJson(json.loads(held.schema)).names)
            merged = self._write(rows, tail[0].first, tail[-1].last, tail[0].level + 1)
            gone = tuple((p.folder, self.clock()) for p in tail)
            held = replace(held, parts=(*held.parts[:-self.fan], merged), retired=(*held.retired, *gone))
            self._replace(spark, held)
        old = [f for f, at in held.retired if at <= self.clock() - self.keep_seconds]
        if old:
            for folder in old:
                self._file(spark).delete_folder(self._folder(folder))
            self._replace(spark, replace(held, retired=tuple(r for r in held.retired if r[0] not in old)))

    def _replace(self, spark: SparkSession, manifest: Manifest) -> None:
        self._file(spark).replace(manifest.text())

    def _rows(self, spark: SparkSession, held: Manifest, parts: Sequence[Part]) -> DataFrame:
        shape = StructType.fromJson(json.loads(held.schema)).add(_FOLDER, "string")
        if self.bucket_by:
            rows = self._bucketed(spark, shape, parts)
        else:
            rows = spark.read.schema(shape).option("basePath", f"{self.path}/parts").parquet(*[self._folder(p.folder) for p in parts])
        return rows.withColumn(SINCE, F.split_part(_FOLDER, F.lit("-"), F.lit(1)).cast("long")).drop(_FOLDER)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows of all live parts, with ``SINCE``; None of them are merged yet."""
        held = self.manifest(spark)
        if not held.parts:
            raise ValueError(f"no batch has been added to {self.path}")
        return self._rows(spark, held, held.parts)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the manifest that is current now."""
        return self.merge(self.rows(spark))


def summing(keys: Sequence[str], sums: Sequence[str]) -> Merge:
    """Rows of equal keys become one with the sums of the other columns."""
    return lambda rows: rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def newest(keys: Sequence[str], columns: Sequence[str] | None = None) -> Merge:
    """Per key the row of the latest batch; rows of one key within a batch are settled by content."""

    def merge(rows: DataFrame) -> DataFrame:
        others = columns or [c for c in rows.columns if c not in (*keys, SINCE)]
        kept = rows.groupBy(*keys).agg(F.max(F.struct(SINCE, *others)).alias("row"))
        return kept.select(*keys, *[F.col(f"row.{c}").alias(c) for c in others])

    return merge
