"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): root is the smallest node reachable.

    Each round points every node at its smallest neighbour (if smaller), follows the pointers
    to their ends by doubling, and replaces the edges by those between the ends. Edges inside
    a contracted part vanish, so the table shrinks until none is left. Everything is a grouped
    minimum or an equi-join on nodes; no neighbour list is ever built. Every round is written
    to the shared folder. Null ends and self links are ignored.
    """
    e = written(edges.where("a is not null and b is not null and a <> b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    label = written(e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
                    .select("node", F.col("node").alias("root")), "cc-labels")
    while not e.isEmpty():
        # greater ends point at their smallest smaller neighbour; other nodes are ends already
        up = e.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p"))
        while True:
            up = written(up, "cc-up")
            q = up.select(F.col("v").alias("__v"), F.col("p").alias("__p"))
            deeper = up.join(q, up["p"] == q["__v"])
            if deeper.isEmpty():
                break
            up = up.join(q, up["p"] == q["__v"], "left").select("v", F.coalesce("__p", "p").alias("p"))

        def moved(df, col):
            m = up.select(F.col("v").alias("__v"), F.col("p").alias("__p"))
            return (df.join(m, df[col] == m["__v"], "left")
                    .withColumn(col, F.coalesce("__p", col)).drop("__v", "__p"))

        label = written(moved(label, "root"), "cc-labels")
        e = moved(moved(e, "a"), "b").where("a <> b")
        e = written(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    return label
