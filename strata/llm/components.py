"""Connected components of a link table, as Spark jobs."""
from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm.common import DataFrame, cut_lineage

ROWS_PER_TASK = 200_000     # links that one task of a round works on


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, root) for every vertex of ``edges``: root is the smallest vertex it
    reaches.

    Every round gives each vertex the smallest label among its neighbours and
    then follows labels one step, so paths shrink by a power each round.  A hub
    costs one combined minimum, never a list of its neighbours.  Rounds are cut
    by checkpoints in the shared folder; as each of them writes its partitions
    again, their number follows the number of links, not the input's.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    e = cut_lineage(e.union(e.select("v", "u")).distinct())
    tasks = 1 + e.count() // ROWS_PER_TASK
    cut = lambda df: cut_lineage(df.coalesce(tasks))
    e = e.coalesce(tasks)
    lab = cut(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("root")))
    while True:
        near = (e.join(lab, "v").groupBy("u").agg(F.min("root").alias("m")).withColumnRenamed("u", "v"))
        new = lab.join(near, "v").select("v", F.least("root", "m").alias("root"), F.col("root").alias("old"))
        new = cut(new)
        up = new.select(F.col("v").alias("root"), F.col("root").alias("top"))
        new = cut(new.join(up, "root", "left").select("v", F.coalesce("top", "root").alias("root"), "old"))
        lab = new.select("v", "root")
        if new.filter("root <> old").isEmpty():
            return lab
