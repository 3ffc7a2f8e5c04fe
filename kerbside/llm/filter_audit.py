"""What five filters take from a corpus in every order: an incremental audit of files as micro-batches.

Each document gets a mask of the filters that it fails. Four of them look at the text alone. The fifth,
copies, asks whether a smaller id has the same text anywhere in the table, so a document's mask can change when a later
file brings a smaller id. A state keyed by text holds the smallest id seen, with its rows by part;
when a smaller one arrives, the earlier holder's mask is retracted from the counters and counted again
as a copy. Counters by part and mask are all that the orders of filters need, however large the corpus is.

State and counters are tables of `levels`: a replayed batch adds nothing, and the counters of a batch are committed
before its state, so a batch that fails between the two is computed again from the same state.

Within a task only the smallest id of a text goes on, with the counts of the rows that lost to it; so a text
that fills a third of the table reaches the state as one row a task.

Defined cases: a null text is empty, and empty texts are copies of one another; a null part is the empty
text; a row without an id is never a copy and makes none; rows that repeat one id and text are no copies of each other;
ids listed twice as labels count as good (or toxic) if any of their rows says so; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from kerbside.llm.graphs import stored
from kerbside.llm.texts import map_blocks, split_words
from kerbside.session import fresh_dir
from kerbside.streaming.jobs import JobConfig, start
from kerbside.streaming.levels import Levels, summing

#: The filters in the order of their bits: short, repetitive, shouting, symbols, copies.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Micro-batches that the files are dealt to, about.
BATCHES = 4
#: Texts whose smallest id a task holds before it hands them on.
HELD_TEXTS = 200_000

CLASS = ["part", "mask", "good", "toxic"]
CLASS_SCHEMA = "part string, mask int, good boolean, toxic boolean"


def mask_of(text: str) -> int:
    """Bits of the filters that a text fails by itself."""
    raw, words = text.encode("utf-8", "surrogatepass"), split_words(text)
    short = len(words) < 200
    repetitive = 100 * len(set(words)) < 50 * len(words)
    shouting = 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > 3 * len(text)
    symbols = len(raw) != len(raw.translate(None, SYMBOLS))
    return short | repetitive << 1 | shouting << 2 | symbols << 3


def judged(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(id, part, mask, digest) per document; the text goes no further."""
    rows = docs.select(
        F.struct(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")).alias("key"),
        F.col(text).cast("string").alias("text"),
    )

    def work(block):
        return {
            "mask": [mask_of(t) for t in block[1]],
            "digest": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in block[1]],
        }

    return map_blocks(rows, work, "mask int, digest binary").select("key.id", "key.part", "mask", "digest")


def label_table(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    marks = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*marks)


def labelled(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows with their labels; those without an id have none and stay out of the join."""
    none = F.lit(False)
    known = rows.where("id is not null").join(marks, "id", "left").select(
        *rows.columns, F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))
    return known.unionByName(rows.where("id is null").select("*", none.alias("good"), none.alias("toxic")))


def thinned(rows: DataFrame) -> DataFrame:
    """Per task and text the rows of the smallest id, as counts by class; all others as counts without a text.

    ``digest`` is null where the state has no say: for ids that lost to a smaller one in their task, which are
    copies for certain, and for rows without an id.
    """
    rows = rows.select("digest", "id", *CLASS)
    shape = StructType([*(StructField(f.name, f.dataType) for f in rows.schema.fields), StructField("n", LongType())])
    arrow = to_arrow_schema(shape)

    def emit(least: dict, settled: Counter) -> pa.RecordBatch:
        out = [(digest, key, *kind, n) for digest, (key, kinds) in least.items() for kind, n in kinds.items()]
        out += [(None, None, *kind, n) for kind, n in settled.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)] if out
            else [pa.array([], f.type) for f in arrow], schema=arrow)

    def run(batches):
        least, settled = {}, Counter()
        for batch in batches:
            for digest, key, *kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind, copy = tuple(kind), (kind[0], kind[1] | COPY, *kind[2:])
                if key is None:
                    settled[kind] += 1
                    continue
                held = least.get(digest)
                if held is None or key < held[0]:
                    if held:
                        for (part, mask, *marks), n in held[1].items():
                            settled[(part, mask | COPY, *marks)] += n
                    least[digest] = (key, Counter({kind: 1}))
                elif key == held[0]:
                    held[1][kind] += 1
                else:
                    settled[copy] += 1
            if len(least) >= HELD_TEXTS:
                yield emit(least, settled)
                least, settled = {}, Counter()
        yield emit(least, settled)

    return rows.mapInArrow(run, shape)


def _least(rows: DataFrame, *others: str) -> DataFrame:
    """Rows of a text with ``least``, its smallest id among them; a text has few rows a task here."""
    summed = rows.groupBy("digest", "id", *CLASS, *others).agg(F.sum("n").alias("n"))
    return summed.withColumn("least", F.min("id").over(Window.partitionBy("digest")))


def keep_least(rows: DataFrame) -> DataFrame:
    """The state's merge: per text the rows of the smallest id."""
    return _least(rows).where("id = least").drop("least")


class Audit:
    """The state and the counters of one audit, below ``path``."""

    def __init__(self, path: str, marks: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"):
        self.columns, self.marks = (key, text, part), marks
        self.state = Levels(f"{path}/state", keep_least)
        self.counters = Levels(f"{path}/counters", summing(CLASS, ["n"]))

    def add(self, docs: DataFrame, batch_id: int) -> None:
        """One micro-batch: what it adds to the counters and takes back from them, then its new smallest ids."""
        spark = docs.sparkSession
        if batch_id <= self.state.manifest(spark).last:
            return
        judgements = stored(judged(docs, *self.columns), "judged")
        rows = stored(thinned(labelled(judgements, self.marks)), "thinned")
        fresh = rows.where("digest is not null")
        met = fresh.withColumn("old", F.lit(False))
        if self.state.manifest(spark).parts:
            # The state's rows of the texts in this batch, before it.
            before = self.state.rows(spark).join(fresh.select("digest").distinct(), "digest", "left_semi")
            met = met.unionByName(keep_least(before).withColumn("old", F.lit(True)))
        met = stored(_least(met, "old"), "met")
        self.counters.add(self._changes(rows, met), batch_id)
        self.state.add(met.where("id = least and not old").select("digest", "id", *CLASS, "n"), batch_id)

    @staticmethod
    def _changes(rows: DataFrame, met: DataFrame) -> DataFrame:
        copy = F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask")

        def of(frame: DataFrame, mask: Column, n: Column) -> DataFrame:
            return frame.select("part", mask, "good", "toxic", n.alias("n"))

        least, lost, own = met.where("id = least and not old"), met.where("id > least"), F.col("mask")
        retracted = lost.where("old")
        changes = of(rows.where("digest is null"), own, F.col("n"))
        for frame, mask, n in ((least, own, F.col("n")), (lost, copy, F.col("n")), (retracted, own, -F.col("n"))):
            changes = changes.unionByName(of(frame, mask, n))
        return changes.groupBy(*CLASS).agg(F.sum("n").alias("n"))

    def masks(self, spark: SparkSession) -> DataFrame:
        """(part, mask, good, toxic, n) over all that has been added."""
        if not self.counters.manifest(spark).parts:
            return spark.createDataFrame([], f"{CLASS_SCHEMA}, n long")
        return self.counters.read(spark).where("n != 0")


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of the filters before) of all orders of the filters."""
    out = []
    for order in map("".join, itertools.permutations(FILTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append((order, step, bit, before))
            before |= bit
    return out


def interactions(masks: DataFrame) -> DataFrame:
    """One row per part, order and step, from counters by mask."""
    steps = F.arrays_zip(*[F.lit(list(c)).alias(n) for n, c in zip(("filter_order", "step", "bit", "before"), zip(*orders(), strict=True), strict=True)])
    rows = masks.select(*CLASS, "n", F.explode(steps).alias("s")).select(*CLASS, "n", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    counted = rows.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"),
    )
    # A part and filter have 120 rows here.
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley")
    return counted.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley)


def file_stream(spark: SparkSession, path: str, batches: int = BATCHES) -> DataFrame:
    """All files of a table as a stream of about ``batches`` micro-batches."""
    table = spark.read.parquet(path)
    files = max(1, -(-len(table.inputFiles()) // batches))
    # The glob lets the source take one file or a folder of files.
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")


def audit_stream(docs: DataFrame, labels: DataFrame, path: str) -> Audit:
    """Work through a stream of documents as it is now; returns the audit with its tables below ``path``."""
    audit = Audit(path, stored(label_table(labels), "labels"))
    start(docs, audit.add, JobConfig(f"{path}/query", available_now=True)).awaitTermination()
    return audit


def digest(spark: SparkSession, docs_path: str, labels: DataFrame) -> DataFrame:
    audit = audit_stream(file_stream(spark, docs_path), labels, fresh_dir(spark, "audit"))
    return interactions(audit.masks(spark))
