"""Connected components and joins against tables whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.session import fresh_dir

#: Rows of one or two numbers up to which a table is sent to every task (about 16 MB).
BROADCAST_ROWS = 500_000
#: Rows of a few numbers, and documents with all that is kept of them, for which a file more is worth its cost.
ROWS_A_FILE, DOCS_A_FILE = 20_000, 4_000


def stored(df: DataFrame, purpose: str, files: int | None = None) -> DataFrame:
    """The frame written to the shared folder and read again: cuts lineage, and survives lost executors.

    ``files`` is the most files to write. On a local file system each costs an executor two processes to set permissions.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_not(df: DataFrame) -> DataFrame:
    """A stored narrow table, marked for broadcast when it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def narrow_files(rows: int) -> int:
    """Files for a table of so many rows of a few numbers."""
    return -(-rows // ROWS_A_FILE) or 1


def wide_files(spark: SparkSession, docs: int) -> int:
    """Files for a table with many rows, or long ones, of each of so many documents; no fewer than the tasks that run at once."""
    return max(spark.sparkContext.defaultParallelism, -(-docs // DOCS_A_FILE))


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """(node, component) for every node of edges (a, b); the component is its smallest node.

    Each round hangs every node on its smallest neighbour, follows these parents to their
    roots, and keeps the edges between different roots; at least half of the nodes that
    still have edges go each round.
    """
    spark = edges.sparkSession
    left = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges", files)
    labels = None
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("near")).unionAll(left.select("b", "a"))
        parents = stored(both.groupBy("node").agg(F.least(F.min("near"), F.min("node")).alias("root")), "parents", files)
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = stored(parents.join(up, "root").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "parents", files)
            parents = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        labels = parents if labels is None else relabelled(labels, parents)
        a = parents.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        b = parents.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        left = stored(
            left.join(a, "a").join(b, "b").where("root_a != root_b").select(
                F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")
            ).distinct(), "edges", files,
        )
    if labels is None:
        kind = edges.schema["a"].dataType
        return spark.createDataFrame([], f"node {kind.simpleString()}, component {kind.simpleString()}")
    return stored(labels.select("node", F.col("root").alias("component")), "components", files)


def relabelled(labels: DataFrame, parents: DataFrame) -> DataFrame:
    """Roots of an earlier round replaced by the roots that these have now."""
    up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
    return labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
