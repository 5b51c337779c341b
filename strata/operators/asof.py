"""Point-in-time join: the version of a key that is in force at an instant.

``versions`` holds intervals ``[start, end)`` per key (no end: still open), as
``scd_merge`` keeps them.  Facts are never paired with all versions of their
key.  The instants asked of a key and the starts of its versions are merged to
one row each (summed before the shuffle, so a key or an instant that a third of
all facts share is small by then); one pass in time order carries the last
started version to the instants after it, and the answer goes back to the facts
by an equality join, whose skewed keys the optimiser can split.

The pass is dealt by key and period: what a period begins with is found first,
from one row per key and period, so a key with very many instants is not one
task.

Defined cases: null key parts match null key parts; a fact without an instant,
or at one that no version holds, keeps its row and gets nulls; of versions of a
key that start together the one that ends last counts (an open one most); if
versions overlap, the one started last is asked; repeated facts stay repeated.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .history import EFF_END, EFF_START
from .joins import keys_match


def as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[tuple[str, str]], at: str,
          attrs: dict[str, str], *, start: str = EFF_START, end: str = EFF_END, period: str = "month") -> DataFrame:
    """``facts`` with the columns ``attrs`` (output name -> column of ``versions``)
    of the version in force at ``at``.  ``keys`` pairs columns of both frames;
    ``period`` (a ``date_trunc`` unit) is what one key's pass is cut into."""
    taken = set(attrs) & set(facts.columns)
    if taken:
        raise ValueError(f"facts already have {sorted(taken)}")
    ks = [f"__k{i}" for i in range(len(keys))]
    kind = facts.schema[at].dataType
    fact = facts.select(F.struct(*facts.columns).alias("__f"), F.col(at).alias("__t"),
                        *[F.col(f).alias(k) for k, (f, _) in zip(ks, keys)])
    until = F.col(end).cast(kind)
    version = versions.filter(F.col(start).isNotNull()).select(
        F.col(start).cast(kind).alias("__t"), *[F.col(v).alias(k) for k, (_, v) in zip(ks, keys)],
        F.struct(until.isNull().alias("open"), until.alias("end"),
                 *[F.col(c).alias(f"a{i}") for i, c in enumerate(attrs.values())]).alias("__v"), F.lit(False).alias("__asked"))
    empty = F.lit(None).cast(version.schema["__v"].dataType)
    asked = fact.filter("__t is not null").select("__t", *ks, empty.alias("__v"), F.lit(True).alias("__asked"))
    moment = version.union(asked).groupBy(*ks, "__t").agg(F.max("__v").alias("__v"), F.max("__asked").alias("__asked"))
    moment = cut_lineage(moment.withColumn("__p", F.date_trunc(period, "__t")))
    # what each period of a key begins with
    began = moment.groupBy(*ks, "__p").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__t"))).alias("__l"))
    earlier = Window.partitionBy(*ks).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    began = began.select(*[F.col(k).alias(f"{k}b") for k in ks], F.col("__p").alias("__pb"),
                         F.last("__l", ignorenulls=True).over(earlier).alias("__in"))
    same = keys_match([F.col(c) for c in [*ks, "__p"]], [F.col(c) for c in [*[f"{k}b" for k in ks], "__pb"]])
    row = moment.join(began, same)
    inside = Window.partitionBy(*ks, "__p").orderBy("__t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    live = F.coalesce(F.last("__v", ignorenulls=True).over(inside), F.col("__in"))
    row = row.withColumn("__live", live).filter("__asked")
    row = row.filter("__live.open or __t < __live.end").select(
        *[F.col(k).alias(f"{k}a") for k in ks], F.col("__t").alias("__ta"), "__live")
    same = keys_match([F.col(c) for c in [*ks, "__t"]], [F.col(c) for c in [*[f"{k}a" for k in ks], "__ta"]])
    out = fact.join(row, same, "left")
    return out.select("__f.*", *[F.col(f"__live.a{i}").alias(c) for i, c in enumerate(attrs)])
