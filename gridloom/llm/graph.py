"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (a, b); nodes with the same root are connected.

    Every round hooks each root to its smallest neighbour, halves the hook chains until all of them end
    in a root, and maps the edges to the new roots; edges inside one component drop out, so the
    work shrinks from round to round. Tables are written between the steps. Joins take plain rows of
    written tables, so that adaptive execution can split a root with many nodes. No table is
    collected; the driver sees only whether rows are left.
    """
    now = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = now = written(now, "edges")
    labels = None
    while not now.isEmpty():
        ends = now.select("a", "b").union(now.select("b", "a"))
        hooks = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hooks = _flattened(written(hooks, "hooks"))
        labels = hooks if labels is None else written(_through(labels, "root", hooks), "labels")
        step = _through(_through(now, "a", hooks), "b", hooks)
        now = written(step.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return first.select(F.col("a").alias("node"), F.col("a").alias("root")) if labels is None else labels


def _through(rows: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """`column` replaced by the root that the mapping gives for it, or kept."""
    to = mapping.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    return rows.join(to, rows[column] == F.col("__node"), "left").withColumn(column, F.coalesce("__root", column)).drop("__node", "__root")


def _flattened(hooks: DataFrame) -> DataFrame:
    """The hook table with every node pointing at the end of its chain."""
    while True:
        nearer = written(_through(hooks.withColumn("before", F.col("root")), "root", hooks), "hooks")
        moved = not nearer.where(F.col("root") != F.col("before")).isEmpty()
        hooks = nearer.drop("before")
        if not moved:
            return hooks
