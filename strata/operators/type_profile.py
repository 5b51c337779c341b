"""Mergeable column profiles and the drift between loads.

A profile has one row per column: how many values are null or blank, how many
look like each kind of value, and the lengths.  Each value counts for the
narrowest kind it fits; the kinds seen give the column's type by a lattice
(bigint under double, date under timestamp, everything under string).  Profiles
add up, so a table's profile is the sum over its loads and no load is read twice.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the kinds and the texts that count as them
KINDS = {
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false|TRUE|FALSE)$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?$",
}
COUNTS = ("rows", "nulls", *KINDS, "string")
NULL_SHARE = 0.05       # a larger change of the share of nulls is drift


def kind_of(value: Column) -> Column:
    """Narrowest kind of a text; null for null and blank."""
    out = F.when(value.isNull() | (F.trim(value) == ""), F.lit(None).cast("string"))
    for kind, pattern in KINDS.items():
        out = out.when(value.rlike(pattern), F.lit(kind))
    return out.otherwise(F.lit("string"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column``, ``rows``, ``nulls``, a count per kind,
    ``min_len`` and ``max_len`` (null without values).

    One aggregate over (column, value) pairs that is combined before the
    shuffle, so every task sends one row per column.  Without rows there is no
    row in the profile.
    """
    names = list(columns if columns is not None else df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names])
    v = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
    v = v.withColumn("kind", kind_of(F.col("value")))
    size = F.when(F.col("kind").isNotNull(), F.length("value"))
    return v.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("kind").isNull()).alias("nulls"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in (*KINDS, "string")],
        F.min(size).alias("min_len"), F.max(size).alias("max_len"))


def merge_profiles(one: DataFrame, other: DataFrame) -> DataFrame:
    """Profile of both loads together."""
    return one.unionByName(other).groupBy("column").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in COUNTS], F.min("min_len").alias("min_len"), F.max("max_len").alias("max_len"))


def type_of(count: dict[str, Column]) -> Column:
    """Least type of the lattice that holds all kinds counted; ``void`` without values."""
    def only(*kinds):
        rest = [count[k] for k in (*KINDS, "string") if k not in kinds]
        return sum(rest[1:], rest[0]) == 0
    return (F.when(only(), "void").when(only("bigint"), "bigint").when(only("bigint", "double"), "double")
             .when(only("boolean"), "boolean").when(only("date"), "date").when(only("date", "timestamp"), "timestamp")
             .otherwise("string"))


def type_drift(before: DataFrame, now: DataFrame, null_share: float = NULL_SHARE) -> DataFrame:
    """What the profile ``now`` of a load changes against ``before``: rows of
    ``column``, ``kind``, ``was``, ``is_now``.

    Kinds: ``new`` and ``missing`` columns (with their type); ``type``: values
    that the old type can't hold (``is_now`` is the least type that holds both);
    ``length``: longer values in a column of strings; ``nulls``: a share of nulls
    or blanks that moved by more than ``null_share`` (whole percents, cut off).
    A column without any value (``void``) fits every type.
    """
    a, b = before.alias("a"), now.alias("b")
    both = a.join(b, "column", "full_outer")
    old = {c: F.coalesce(F.col(f"a.{c}"), F.lit(0)) for c in COUNTS}
    new = {c: F.coalesce(F.col(f"b.{c}"), F.lit(0)) for c in COUNTS}
    was, is_new = type_of(old), type_of(new)
    joint = type_of({c: old[c] + new[c] for c in COUNTS})
    gone, fresh = F.col("b.rows").isNull(), F.col("a.rows").isNull()
    kept = ~gone & ~fresh

    def percent(c):
        return F.floor(c["nulls"] * 100 / c["rows"]).cast("string")
    moved = F.abs(new["nulls"] / new["rows"] - old["nulls"] / old["rows"]) > null_share
    found = [
        (fresh, "new", F.lit(None), is_new), (gone, "missing", was, F.lit(None)),
        (kept & (was != "void") & (joint != was), "type", was, joint),
        (kept & (joint == "string") & (F.col("b.max_len") > F.col("a.max_len")), "length",
         F.col("a.max_len"), F.col("b.max_len")),
        (kept & moved, "nulls", percent(old), percent(new)),
    ]
    rows = F.array(*[F.when(when, F.struct(F.lit(kind).alias("kind"), x.cast("string").alias("was"), y.cast("string").alias("is_now")))
                     for when, kind, x, y in found])
    out = both.select("column", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
    return out.select("column", "r.kind", "r.was", "r.is_now")


def profile_load(store, name: str, load: DataFrame, null_share: float = NULL_SHARE) -> DataFrame:
    """Drift of ``load`` against the profile kept in the store's table ``name``,
    which then takes it in.  The first load has no drift.  Profiles are a row per
    column, so the rewrite is small."""
    from ..session import cut_lineage
    now = cut_lineage(column_profile(load))
    if not store.exists(name):
        store.publish(now.coalesce(1), name)
        return type_drift(now, now, null_share)
    before = store.read(name)
    drift = cut_lineage(type_drift(before, now, null_share))
    store.publish(merge_profiles(before, now).coalesce(1), name)
    return drift
