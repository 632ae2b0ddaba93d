"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import fresh_path


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fingerprint(edges: DataFrame) -> tuple:
    """Number and order-free checksum of distinct edges."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("a", "b")).alias("x"),
    ).first()
    return row["n"], row["x"]


def _to_smallest(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Ties the neighbours of every node to the smallest among them and itself.

    With ``both_ways`` only larger neighbours move (large star), else the node itself
    and its smaller neighbours do (small star). Minima are aggregated map-side; no
    neighbourhood is gathered.
    """
    if both_ways:
        turned = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = turned.groupBy(F.col("a").alias("_node")).agg(F.min("b").alias("_least"))
    if both_ways:
        smallest = smallest.select("_node", F.least("_node", "_least").alias("_least"))
    moved = turned.join(smallest, F.col("a") == F.col("_node"))
    if both_ways:
        tied = moved.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        tied = moved.select(F.col("b").alias("a"), F.col("_least").alias("b")).union(
            smallest.select("_node", "_least")
        )
    return tied.where("a <> b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for nodes with edges.

    Alternates large and small stars until the edges no longer change, which takes
    a number of rounds that grows with the logarithm of the nodes. Every round is
    written to the shared scratch folder, so lost executors cost one round at most.
    Loops, repeated and reversed edges are allowed; null ends are dropped.
    """
    current = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    current = _written(current.where("a <> b").distinct(), "edges")
    seen = _fingerprint(current)
    while seen[0]:
        current = _written(_to_smallest(_to_smallest(current, True), False), "edges")
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.union(roots)
