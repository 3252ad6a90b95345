"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import drop_stored, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Each round hooks every node to its smallest smaller neighbour, flattens the hooks by pointer jumping and contracts the
    links. A round at least halves the nodes of a component that still has links, so the rounds are logarithmic. Minima are combined before
    each shuffle; the joins are plain equi-joins, whose skewed sides Spark splits. Nothing is gathered on the driver.
    Links from a node to itself, repeated links and links with a NULL end change nothing; an empty table gives an empty one.
    """
    edges = stored(_proper(links.select(F.col(a).alias("a"), F.col(b).alias("b"))))
    labels = None
    while not edges.isEmpty():
        hooks = _flattened(stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))))
        renamed = hooks.select(F.col("node").alias("old"), F.col("root").alias("new"))
        if labels is None:
            merged = hooks
        else:
            moved = labels.join(renamed, labels["root"] == renamed["old"], "left")
            merged = stored(moved.select("node", F.coalesce("new", "root").alias("root")).unionByName(hooks))
        contracted = edges
        for end in ("a", "b"):
            contracted = contracted.join(renamed, contracted[end] == renamed["old"], "left").withColumn(
                end, F.coalesce("new", end)
            ).drop("old", "new")
        contracted = stored(_proper(contracted))
        if labels is not None:
            drop_stored(labels, hooks)
        drop_stored(edges)
        edges, labels = contracted, merged
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = labels.select("root").distinct().select(F.col("root").alias("node"), "root")
    return labels.unionByName(roots)


def _proper(edges: DataFrame) -> DataFrame:
    ends = edges.filter(F.col("a") != F.col("b"))
    return ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _flattened(hooks: DataFrame) -> DataFrame:
    while True:
        up = hooks.select(F.col("node").alias("parent"), F.col("root").alias("above"))
        jumped = stored(
            hooks.join(up, hooks["root"] == up["parent"], "left").select(
                "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")
            )
        )
        drop_stored(hooks)
        hooks = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return hooks
