"""Connected components of a link table by repeated contraction; no link or component leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.llm.common import cut


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links(a, b)``: component is the smallest node that can be reached.

    Each round sends every node to its smallest neighbour (itself included), renames the ends of all
    links and drops the links within one name, so a round at least halves the names of a component.
    A round's names are written to the checkpoint folder: the joins then shuffle both their sides,
    so that Spark can split the rows of a hot name, and the lineage stays short.
    """
    links = cut(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    names = cut(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")))
    while links.limit(1).count():
        both = links.union(links.select("b", "a"))
        smallest = cut(both.groupBy(F.col("a").alias("old")).agg(F.least(F.min("b"), F.first("a")).alias("new")))
        at_a, at_b = smallest.toDF("a", "new_a"), smallest.toDF("b", "new_b")
        renamed = links.join(at_a, "a").join(at_b, "b").select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        names = cut(names.join(smallest, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component")))
        links = cut(renamed.filter("a <> b").distinct())
    return names
