"""Data-quality metrics, report, score, grade and a failing gate.

All metrics of a report come from one aggregate: the frames involved
(processed, quarantined, final, and the final rows grouped by business key)
are tagged and unioned, so a single job computes every count - no job per
metric, no cross join of one-row frames, nothing collected but the verdict.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: status bands, score weights/caps and grade cut-offs of the report
NULL_BANDS = (0, 5)        # 0 -> ok, < 5 % -> warn, else fail
PCT_BANDS = (0, 1)         # duplicates, ranges: 0 -> ok, < 1 % -> warn, else fail
SCORE_TERMS = [            # metric, points per percent, cap
    ("quarantine_pct", 2, 20),
    ("dup_pct", 10, 20),
    ("age_pct", 5, 10),
    ("billing_pct", 5, 10),
    ("mask_pct", 20, 20),
    ("avg_null_pct", 4, 20),
]
GRADES = [(95, "A+"), (90, "A"), (80, "B"), (70, "C")]
GRADE_ELSE = "D"


def pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0 when ``whole`` is 0."""
    return F.when(whole > 0, part / whole * F.lit(100)).otherwise(F.lit(0.0))


def status_band(p: Column, bands=PCT_BANDS) -> Column:
    zero, warn = bands
    return F.when(p == zero, "ok").when(p < warn, "warn").otherwise("fail")


def _tag(df: DataFrame, tag: str, cols: dict[str, Column]) -> DataFrame:
    return df.select(F.lit(tag).alias("__t"), *[c.alias(n) for n, c in cols.items()])


def metric_flags(current: Column | None, null_cols: Sequence[str], range_rules: dict[str, Column],
                 mask_cols: Sequence[str]) -> dict[str, Column]:
    """What is counted of each row."""
    flags = {f"n__{c}": F.col(c).isNull() for c in null_cols}
    flags.update({f"r__{r}": F.coalesce(p, F.lit(False)) for r, p in range_rules.items()})
    um = F.lit(False)
    for c in mask_cols:
        um = um | F.col(c).isNull()
    flags["__unmasked"] = um
    flags["__current"] = F.coalesce(current if current is not None else F.lit(True), F.lit(False))
    return flags


def quality_metrics(final: DataFrame, *, processed: DataFrame | None = None,
                    quarantined: DataFrame | None = None,
                    keys: Sequence[str] = (), current: Column | None = None,
                    null_cols: Sequence[str] = (), range_rules: dict[str, Column] | None = None,
                    mask_cols: Sequence[str] = ()) -> DataFrame:
    """One row of counts and percentages describing ``final``.

    Columns: ``processed, quarantined, final, quarantine_pct``; per null column
    ``<c>_nulls``/``<c>_null_pct``; ``avg_null_pct``; per range rule
    ``<r>_violations``/``<r>_pct``; ``unmasked``/``mask_pct``;
    ``current_rows, distinct_keys, dup_count, dup_pct``.
    """
    range_rules = dict(range_rules or {})
    cur = current if current is not None else F.lit(True)
    fcols = metric_flags(cur, null_cols, range_rules, mask_cols)
    parts = [_tag(final, "f", fcols)]
    if processed is not None:
        parts.append(_tag(processed, "p", {}))
    if quarantined is not None:
        parts.append(_tag(quarantined, "q", {}))
    if keys:
        # group the current rows by key first: partial aggregation, so a hot
        # key collapses map-side; the union then carries one row per key
        per_key = final.filter(F.coalesce(cur, F.lit(False))).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__cnt"))
        parts.append(_tag(per_key, "d", {"__cnt": F.col("__cnt")}))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    t = F.col("__t")
    aggs = [
        F.count_if(t == "p").alias("processed"),
        F.count_if(t == "q").alias("quarantined"),
        F.count_if(t == "f").alias("final"),
        F.count_if((t == "f") & F.col("__unmasked")).alias("unmasked"),
        F.count_if((t == "f") & F.col("__current")).alias("current_rows"),
        F.count_if(t == "d").alias("distinct_keys"),
    ]
    aggs += [F.count_if((t == "f") & F.col(f"n__{c}")).alias(f"{c}_nulls") for c in null_cols]
    aggs += [F.count_if((t == "f") & F.col(f"r__{r}")).alias(f"{r}_violations") for r in range_rules]
    return metric_percentages(u.agg(*aggs), bool(keys), null_cols, range_rules)


def metric_percentages(m: DataFrame, keys: bool, null_cols: Sequence[str], range_rules) -> DataFrame:
    """Counts with the percentages that follow from them."""
    fin = F.col("final")
    out = {
        "quarantine_pct": pct(F.col("quarantined"), fin + F.col("quarantined")),
        "mask_pct": pct(F.col("unmasked"), fin),
        "dup_count": F.col("current_rows") - F.col("distinct_keys") if keys else F.lit(0).cast("long"),
    }
    out["dup_pct"] = pct(F.col("current_rows") - F.col("distinct_keys"), F.col("current_rows")) \
        if keys else F.lit(0.0)
    for c in null_cols:
        out[f"{c}_null_pct"] = pct(F.col(f"{c}_nulls"), fin)
    for r in range_rules:
        out[f"{r}_pct"] = pct(F.col(f"{r}_violations"), fin)
    if null_cols:
        total_nulls = None
        for c in null_cols:
            total_nulls = F.col(f"{c}_nulls") if total_nulls is None else total_nulls + F.col(f"{c}_nulls")
        out["avg_null_pct"] = F.when(fin > 0, total_nulls / F.lit(len(null_cols)) / fin * F.lit(100)) \
            .otherwise(F.lit(0.0))
    else:
        out["avg_null_pct"] = F.lit(0.0)
    return m.withColumns(out)


def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long report ``(column, null_count, null_pct, status)`` from one scan."""
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["__n"], list(cols), "column", "null_count")
    p = pct(F.col("null_count"), F.col("__n"))
    return long.select("column", "null_count", p.alias("null_pct"),
                       status_band(p, NULL_BANDS).alias("status"))


def range_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Long report ``(rule, violations, pct, status)`` from one scan."""
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.coalesce(p, F.lit(False))).alias(r) for r, p in rules.items()])
    long = one.unpivot(["__n"], list(rules), "rule", "violations")
    p = pct(F.col("violations"), F.col("__n"))
    return long.select("rule", "violations", p.alias("pct"), status_band(p).alias("status"))


def dup_report(df: DataFrame, keys: Sequence[str], current: Column | None = None) -> DataFrame:
    """``total_current, distinct_keys, dup_count, dup_pct, status`` (null keys
    count as one key, like ``dropDuplicates``)."""
    rows = df if current is None else df.filter(F.coalesce(current, F.lit(False)))
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    one = per_key.agg(F.coalesce(F.sum("__cnt"), F.lit(0)).cast("long").alias("total_current"),
                      F.count(F.lit(1)).alias("distinct_keys"))
    dup = F.col("total_current") - F.col("distinct_keys")
    p = pct(dup, F.col("total_current"))
    return one.select("total_current", "distinct_keys", dup.alias("dup_count"), p.alias("dup_pct"),
                      status_band(p).alias("status"))


def scd_report(df: DataFrame, current_col: str = "_is_current") -> DataFrame:
    """``total, current, historical, historical_pct`` from one scan."""
    one = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.coalesce(F.col(current_col), F.lit(False))).alias("current"))
    hist = F.col("total") - F.col("current")
    return one.select("total", "current", hist.alias("historical"),
                      pct(hist, F.col("total")).alias("historical_pct"))


def quality_score(metrics: DataFrame, terms=SCORE_TERMS, rename: dict[str, str] | None = None) -> DataFrame:
    """Add ``score`` (100 minus capped penalties, floored at 0) and ``grade``.

    ``rename`` maps a score term (``age_pct``...) to the metric column that
    plays its part in this data set.
    """
    rename = rename or {}
    score = F.lit(100.0)
    for name, per, cap in terms:
        col = rename.get(name, name)
        if col not in metrics.columns:
            raise ValueError(f"the score needs column {col!r}, which the metrics don't have")
        score = score - F.least(F.col(col) * F.lit(per), F.lit(float(cap)))
    out = metrics.withColumn("score", F.greatest(score, F.lit(0.0)))
    return out.withColumn("grade", grade(F.col("score")))


def grade(score: Column) -> Column:
    expr = None
    for cut, g in GRADES:
        expr = F.when(score >= cut, g) if expr is None else expr.when(score >= cut, g)
    return expr.otherwise(GRADE_ELSE)


@dataclass
class GateRule:
    name: str
    failing: Column | None = None     # per-row predicate counted as a failure
    kind: str = "rows"                # 'rows' | 'empty' | 'dup_keys'
    keys: Sequence[str] = ()


def gate_report(df: DataFrame, rules: Sequence[GateRule], current: Column | None = None) -> DataFrame:
    """``(rule, failures, passed)`` for every rule, all from one aggregate."""
    cur = current if current is not None else F.lit(True)
    row_rules = [r for r in rules if r.kind == "rows"]
    dup_rules = [r for r in rules if r.kind == "dup_keys"]
    cols = {f"g{i}": F.coalesce(r.failing, F.lit(False)) for i, r in enumerate(row_rules)}
    parts = [_tag(df, "f", cols)]
    for j, r in enumerate(dup_rules):
        per_key = df.filter(F.coalesce(cur, F.lit(False))).groupBy(*r.keys).agg(
            F.count(F.lit(1)).alias("__cnt"))
        parts.append(_tag(per_key.filter(F.col("__cnt") > 1), f"d{j}",
                          {"__extra": F.col("__cnt") - 1}))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    t = F.col("__t")
    aggs = [F.count_if(t == "f").alias("__rows")]
    aggs += [F.count_if((t == "f") & F.col(f"g{i}")).alias(f"g{i}") for i in range(len(row_rules))]
    aggs += [F.coalesce(F.sum(F.when(t == f"d{j}", F.col("__extra"))), F.lit(0)).cast("long")
             .alias(f"d{j}") for j in range(len(dup_rules))]
    one = u.agg(*aggs)
    entries = []
    for r in rules:
        if r.kind == "empty":
            entries.append((r.name, F.when(F.col("__rows") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long")))
        elif r.kind == "rows":
            entries.append((r.name, F.col(f"g{row_rules.index(r)}").cast("long")))
        else:
            entries.append((r.name, F.col(f"d{dup_rules.index(r)}").cast("long")))
    arr = F.array(*[F.struct(F.lit(n).alias("rule"), c.alias("failures")) for n, c in entries])
    return (one.select(F.inline(arr))
               .withColumn("passed", F.col("failures") == 0))


def enforce_gate(report) -> None:
    """Raise listing every failed rule.  ``report`` is the gate DataFrame (one
    row per rule, so collecting it is bounded by the rule count) or its
    already collected rows."""
    rows = report if isinstance(report, list) else report.collect()
    failed = [(r["rule"], r["failures"]) for r in rows if not r["passed"]]
    if failed:
        raise ValueError("quality gate closed: " + "; ".join(f"{n} has {f} bad rows" for n, f in failed))
