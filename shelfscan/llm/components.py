"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfscan.llm.tables import checkpointed

#: Edges of a partition, where there are enough of them for every core.
EDGES = 1 << 18


def _gathered(edges: DataFrame, rows: int) -> DataFrame:
    """``edges``, some ``rows``, in no more partitions than they fill or the cores can take at once.

    A round reads them four times and writes them once, so partitions of a few rows each would cost far more
    tasks, files and buffers than the edges do.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    return edges.coalesce(max(cores, -(-rows // EDGES)))


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and sum of their hashes: the same for the same edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``links`` (a, b) is linked with.

    Each round hangs a node's larger neighbours below its least one, then its
    smaller neighbours too; the rounds grow with the logarithm of the longest
    chain. Least neighbours are found before rows are sent, so a node with very
    many links is no task's burden; joins on it are split by adaptive execution.
    """
    links = links.filter("a <> b")
    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(edges)
    while True:
        # a round makes no more edges than it is given
        edges = _gathered(edges, mark[0])
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        lower = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(_gathered(lower.union(least.select("u", F.col("m").alias("v"))).distinct(), mark[0]))
        total = _mark(edges)
        if total == mark:
            break
        mark = total
    # every edge hangs a node below its root; roots stand for themselves
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v"))
    return nodes.groupBy("node").agg(F.min("root").alias("root"))
