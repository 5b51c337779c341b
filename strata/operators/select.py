"""Exact quantiles of groups, by counted value ranges.

Equal values of a group are counted first.  While a group has more than
``limit`` different values left, about ``RANGES`` split points are taken from a
small sketch of them, the rows of each range between two points are counted, and
only the range that holds the wanted rank stays.  A sketch may be rough: it only
says where to cut, the counts decide.  What is left of each group, at most
``limit`` values, is put in order.  So a group of all rows is never in one task,
and no group needs a sketch as large as its accuracy.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import keys_match

RANGES = 64
SKETCH = 1_000


def exact_quantile(df: DataFrame, col: str, by: Sequence[Column], name: str, p: float = 0.5, *, limit: int = 4096) -> DataFrame:
    """One row per group (``g0``, ``g1``, ... for the expressions ``by``): the
    smallest value that at least ``p`` of the group's values do not exceed.
    Nulls do not count; a group of nulls has no row; null is a group like any other."""
    gs = [f"g{i}" for i in range(len(by))]
    group = [c.alias(g) for c, g in zip(by, gs)]
    if not gs:
        gs, group = ["g0"], [F.lit(0).alias("g0")]
    left = (df.select(*group, F.col(col).alias("v")).filter("v is not null")
            .groupBy(*gs, "v").agg(F.count(F.lit(1)).alias("m")))
    left = cut_lineage(left)
    total = left.groupBy(*gs).agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("kinds"))
    rank = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(p)))
    # rank: among the values still left
    state = cut_lineage(total.select(*gs, rank.cast("bigint").alias("rank"), "kinds"))
    widest = 0
    while (now := state.agg(F.max("kinds").alias("k")).first()["k"] or 0) > limit and now != widest:
        widest, wide = now, state.filter(F.col("kinds") > limit)
        cuts = F.percentile_approx("v", [i / RANGES for i in range(1, RANGES)], SKETCH)
        points = _with(left, wide, gs).groupBy(*gs).agg(F.array_distinct(cuts).alias("points"))
        points = cut_lineage(points)
        cut = _with(left, points, gs).withColumn("r", F.size(F.filter("points", lambda x: x < F.col("v"))))
        count = cut.groupBy(*gs, "r").agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("kinds"))
        before = F.coalesce(F.sum("m").over(Window.partitionBy(*gs).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found = _with(count.withColumn("before", before), state.select(*gs, "rank"), gs)
        found = found.filter("before < rank and rank <= before + m").select(*gs, "r", "kinds", (F.col("rank") - F.col("before")).alias("rank"))
        found = cut_lineage(_with(found, points, gs))
        inside = (F.col("r") == F.size(F.filter("points", lambda x: x < F.col("v"))))
        kept = _with(left, found.select(*gs, "points", "r"), gs).filter(inside).select(*left.columns)
        left = cut_lineage(_without(left, found, gs).select(*left.columns).union(kept))
        state = cut_lineage(_without(state, found, gs).select(*state.columns).union(found.select(*state.columns)))
    run = F.sum("m").over(Window.partitionBy(*gs).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = _with(left.withColumn("run", run), state.select(*gs, "rank"), gs).filter("run >= rank")
    return out.groupBy(*gs).agg(F.min("v").alias(name))


def _on(gs: list[str], right: DataFrame) -> tuple[DataFrame, Column]:
    other = right.withColumnsRenamed({g: f"{g}r" for g in gs})
    return other, keys_match([F.col(g) for g in gs], [F.col(f"{g}r") for g in gs])


def _with(left: DataFrame, right: DataFrame, gs: list[str]) -> DataFrame:
    """``left`` with the columns of ``right`` (one row per group) that it lacks."""
    other, on = _on(gs, right.drop(*[c for c in right.columns if c in left.columns and c not in gs]))
    return left.join(other, on).drop(*[f"{g}r" for g in gs])


def _without(left: DataFrame, right: DataFrame, gs: list[str]) -> DataFrame:
    other, on = _on(gs, right.select(*gs))
    return left.join(other, on, "left_anti")
