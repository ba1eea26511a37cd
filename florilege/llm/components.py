"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.durable import Scratch, durable


def connected_components(links: DataFrame, into: Scratch | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round points every node at its smallest neighbour, follows the pointers to their end, and keeps the links
    between the trees that result. The number of trees in a component at least halves, so rounds grow with the
    logarithm of the longest chain. Every table of a round is written, and all joins stand between written tables, so
    adaptive execution can split a node with very many links. The result is written ``into`` a caller's tables or by
    itself. Null ends and self links are ignored; an empty table has no components.
    """
    with Scratch(links.sparkSession) as tables:
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        links = tables.write(links, "links")
        labels = None
        while labels is None or not links.isEmpty():
            both = links.union(links.select("b", "a"))
            up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
            up = tables.write(up.select("node", F.least("node", "parent").alias("parent")), "parents")
            while True:
                above = up.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
                jumped = up.join(above, "parent").select("node", F.col("top").alias("parent"), (F.col("top") < F.col("parent")).alias("moved"))
                jumped = tables.write(jumped, "parents")
                up = jumped.select("node", "parent")
                if jumped.where("moved").isEmpty():
                    break
            if labels is None:
                labels = up.select("node", F.col("parent").alias("component"))
            else:
                above = up.select(F.col("node").alias("component"), "parent")
                labels = tables.write(labels.join(above, "component", "left").select("node", F.coalesce("parent", "component").alias("component")), "labels")
            a = up.select(F.col("node").alias("a"), F.col("parent").alias("to_a"))
            b = up.select(F.col("node").alias("b"), F.col("parent").alias("to_b"))
            links = links.join(a, "a").join(b, "b").where("to_a <> to_b")
            links = tables.write(links.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        return into.write(labels, "components") if into else durable(labels, "components")
