"""Group-based imputation: seeded donor, mode and median, plus a rule plan.

Each strategy computes one statistic per group with a ``groupBy`` (partial
aggregation map-side, so a hot group costs one row per map task, not one
giant task), checkpoints that table and joins it back; the optimiser picks the
join from its bytes.  The equivalent window form
(``first(...) over (partition by group)``) would send every row of a group to
one task, which for low-cardinality groups is most of the table.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .select import exact_quantile


def donor_hash(row_key: Sequence[str], seed) -> Column:
    """Seeded, reproducible pseudo-random order of rows: md5 of seed + key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in row_key]))


def _attach(df: DataFrame, stats: DataFrame, by: Sequence[str],
            materialise: bool) -> DataFrame:
    """Left-join per-group ``stats`` (columns ``__g0..`` + payload) to ``df``.

    Group keys compare null-safe: a null group is a group of its own, as in
    ``partitionBy``.  ``materialise`` checkpoints the statistics, so later
    steps re-read them and the optimiser knows their bytes.
    """
    if materialise:
        stats = cut_lineage(stats)
    cond = None
    for i, c in enumerate(by):
        t = df[c].eqNullSafe(stats[f"__g{i}"])
        cond = t if cond is None else cond & t
    out = df.join(stats, cond, "left")
    return out.drop(*[f"__g{i}" for i in range(len(by))])


def _group_cols(by: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"__g{i}") for i, c in enumerate(by)]


def impute_donor(df: DataFrame, col: str, by: Sequence[str], default=None, *,
                 row_key: Sequence[str], seed=42, frame: str = "full",
                 stats_from: DataFrame | None = None,
                 materialise: bool = True) -> DataFrame:
    """Fill nulls in ``col`` from a donor row of the same group, then ``default``.

    Rows are ordered by ``md5(seed | row_key)``; the donor is the non-null
    value first in that order.  ``frame='full'``: every null row of the group
    gets the donor.  ``frame='running'``: a null row gets it only when the
    donor comes before it in that order (the default window frame of a
    ``first(ignorenulls) over (partition by .. order by rand())``), otherwise
    the default.
    """
    src = stats_from if stats_from is not None else df
    h = donor_hash(row_key, seed)
    stats = (src.filter(F.col(col).isNotNull())
                .groupBy(*_group_cols(by))
                .agg(F.min(F.struct(h.alias("h"), F.col(col).alias("v"))).alias("__donor")))
    out = _attach(df, stats, by, materialise)
    donor = F.col("__donor").getField("v")
    if frame == "running":
        donor = F.when(F.col("__donor").getField("h") <= h, donor)
    elif frame != "full":
        raise ValueError("frame must be 'full' or 'running'")
    fill = F.coalesce(F.col(col), donor, F.lit(default)) if default is not None \
        else F.coalesce(F.col(col), donor)
    return out.withColumn(col, fill.cast(df.schema[col].dataType)).drop("__donor").select(*df.columns)


def impute_mode(df: DataFrame, col: str, by: Sequence[str], default=None, *,
                stats_from: DataFrame | None = None,
                materialise: bool = True) -> DataFrame:
    """Fill nulls with the most frequent value of the group; ties go to the
    smallest value.  Two aggregations: counts per (group, value) - spread over
    all tasks - then the best value per group over that much smaller table."""
    src = stats_from if stats_from is not None else df
    counts = (src.filter(F.col(col).isNotNull())
                 .groupBy(*_group_cols(by), F.col(col).alias("__v")).count())
    gcols = [f"__g{i}" for i in range(len(by))]
    stats = counts.groupBy(*gcols).agg(
        F.min(F.struct((-F.col("count")).alias("n"), F.col("__v").alias("v"))).getField("v").alias("__mode"))
    out = _attach(df, stats, by, materialise)
    fill = F.coalesce(F.col(col), F.col("__mode"), F.lit(default)) if default is not None \
        else F.coalesce(F.col(col), F.col("__mode"))
    return out.withColumn(col, fill.cast(df.schema[col].dataType)).drop("__mode").select(*df.columns)


def impute_median(df: DataFrame, col: str, by: Sequence[str], default=None, *,
                  accuracy: int = 1_000_000, stats_from: DataFrame | None = None,
                   materialise: bool = True) -> DataFrame:
    """Fill nulls with the group median (``percentile_approx``: exact lower
    median while a group has fewer values than ``accuracy``), cast back to the
    column's type, then ``default``."""
    src = stats_from if stats_from is not None else df
    stats = (src.filter(F.col(col).isNotNull())
                .groupBy(*_group_cols(by))
                .agg(F.percentile_approx(F.col(col), 0.5, accuracy).alias("__med")))
    out = _attach(df, stats, by, materialise)
    typ = df.schema[col].dataType
    fill = F.coalesce(F.col(col), F.col("__med").cast(typ), F.lit(default).cast(typ)) \
        if default is not None else F.coalesce(F.col(col), F.col("__med").cast(typ))
    return out.withColumn(col, fill).drop("__med").select(*df.columns)


def impute_median_exact(df: DataFrame, col: str, by: Sequence[str], default=None, *,
                        stats_from: DataFrame | None = None, materialise: bool = True) -> DataFrame:
    """Fill nulls with the exact lower median of the group, however many values
    it has (``select.exact_quantile``), cast back to the column's type, then
    ``default``.  Without ``by`` all rows are one group."""
    src = stats_from if stats_from is not None else df
    keys = [F.col(c) for c in by] or [F.lit(0)]
    stats = exact_quantile(src, col, keys, "__med").withColumnsRenamed({f"g{i}": f"__g{i}" for i in range(len(keys))})
    row = df if by else df.withColumn("__one", F.lit(0))
    out = _attach(row, stats, list(by) or ["__one"], materialise)
    typ = df.schema[col].dataType
    fill = [F.col(col), F.col("__med").cast(typ)] + ([F.lit(default).cast(typ)] if default is not None else [])
    return out.withColumn(col, F.coalesce(*fill)).select(*df.columns)


@dataclass
class Rule:
    """One imputation step: ``strategy`` in {'donor', 'mode', 'median'}."""
    col: str
    by: Sequence[str]
    strategy: str = "mode"
    default: object = None
    options: dict = field(default_factory=dict)


_STRATEGIES = {"donor": impute_donor, "mode": impute_mode, "median": impute_median}


def rule_waves(rules: Sequence[Rule]) -> list[int]:
    """Wave of each rule: one more than the latest earlier rule that fills a
    column this rule groups by or fills itself (0 when there is none)."""
    waves: list[int] = []
    for i, r in enumerate(rules):
        deps = [waves[j] for j, q in enumerate(rules[:i]) if q.col in r.by or q.col == r.col]
        waves.append(max(deps) + 1 if deps else 0)
    return waves


def impute(df: DataFrame, rules: Sequence[Rule], **common) -> DataFrame:
    """Apply rules in order; a later rule may group by a column an earlier
    rule filled (fill the condition first, then what depends on it).

    Rules of one dependency wave take their statistics from the frame as it
    was before the wave.  No rule of a wave groups by or fills a column another
    rule of the same wave fills, so the statistics equal those of strictly
    sequential application - but each statistics job only carries the joins
    of earlier waves instead of every earlier rule.
    """
    waves = rule_waves(rules)
    for w in sorted(set(waves)):
        base = df
        for r, rw in zip(rules, waves):
            if rw != w:
                continue
            fn = _STRATEGIES[r.strategy]
            opts = {**common, **r.options}
            if r.strategy != "donor":
                opts.pop("row_key", None)
                opts.pop("seed", None)
                opts.pop("frame", None)
            if r.strategy != "median":
                opts.pop("accuracy", None)
            opts.setdefault("stats_from", base)
            df = fn(df, r.col, r.by, r.default, **opts)
    return df


def null_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, one ``<col>_nulls`` count per column, from a single scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])
