"""Connected components of a link table, without collecting anything.

Each round every node takes the least id among itself and its neighbours;
links are re-drawn between these ids and links inside one id vanish, so a
round at least halves the nodes that still have links, and a star collapses
in one. Only linked nodes are ever in the tables; each round is written to
the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every id in ``links`` (a, b): the least id reachable."""
    edges = cut(links.select("a", "b").where("a <> b").distinct(), "links")
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = None
    while not edges.isEmpty():
        step = cut(both(edges).groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("to")), "labels")
        if labels is None:
            labels = step.withColumnRenamed("to", "comp")
        else:
            labels = cut(labels.join(step.select(F.col("id").alias("comp"), "to"), "comp", "left")
                         .select("id", F.coalesce("to", "comp").alias("comp")), "labels")
        new = (edges.join(step.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a")
               .join(step.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
               .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a <> b").distinct())
        edges = cut(new, "links")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return labels
