"""Change history: type-1 (overwrite) and type-2 (versioned) merge.

The target holds every version of every key with ``_eff_start``,
``_eff_end`` and ``_is_current``.  One full outer join of the target with the
incoming batch, on the keys and only for current rows, reads both once; closed
rows match nothing and pass through.  Each joined row becomes one or two:

=====================================  =======================================
incoming vs current row                result
=====================================  =======================================
no incoming row with the key           current row unchanged
tracked equal, type-1 attribute equal  unchanged
tracked equal, type-1 attr. differs    type-1 attributes (and ``touch``) taken
tracked differs                        current row closed (``_eff_end`` =
                                       incoming start) + incoming row inserted
                                       as the new current version
=====================================  =======================================

Incoming keys with no current row (new, or only closed versions) are
inserted.  Columns new in the batch are added to the table (null in old rows).  Comparisons are null-safe by default (null -> value is a change);
``null_safe_changes=False`` and ``insert_new_version=False`` reproduce a
plain SQL ``MERGE`` with ``!=`` tests that only closes rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import keys_match, require_unique

EFF_START, EFF_END, CURRENT = "_eff_start", "_eff_end", "_is_current"


def scd_init(df: DataFrame, start: Column | str | None = None) -> DataFrame:
    """Add history columns: ``_eff_start`` from ``start`` (a column, a column
    name, or the load date by default), open ``_eff_end``, ``_is_current``."""
    if start is None:
        start_c = F.current_date()
    elif isinstance(start, str):
        start_c = F.col(start)
    else:
        start_c = start
    return df.withColumns({EFF_START: start_c.cast("date"),
                           EFF_END: F.lit(None).cast("date"),
                           CURRENT: F.lit(True)})


def _differs(a: Column, b: Column, null_safe: bool) -> Column:
    return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))


def _equal(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else F.coalesce(a == b, F.lit(False))


def scd_merge(target: DataFrame, incoming: DataFrame, keys: Sequence[str], *,
              tracked: Sequence[str], type1: Sequence[str] = (), touch: Sequence[str] = (),
              insert_new_version: bool = True, null_safe_changes: bool = True,
              null_safe_keys: bool = True) -> DataFrame:
    """Merge ``incoming`` (one row per key, else ``ValueError``; history columns
    set by :func:`scd_init`) into ``target``; returns the full new table."""
    keys, tracked, type1, touch = list(keys), list(tracked), list(type1), list(touch)
    require_unique(incoming if null_safe_keys else incoming.dropna(subset=keys), keys, "incoming batch")
    added = [c for c in incoming.columns if c not in target.columns]
    cols = target.columns + added
    kind = {c: (target if c in target.columns else incoming).schema[c].dataType for c in cols}

    def side(df, name):
        row = [(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kind[c])).alias(c) for c in cols]
        return df.select(F.struct(*row).alias(name))

    t, s = side(target, "__t"), side(incoming, "__s")
    tc = {c: F.col(f"__t.`{c}`") for c in cols}
    sc = {c: F.col(f"__s.`{c}`") for c in cols}
    on = keys_match([tc[k] for k in keys], [sc[k] for k in keys], null_safe_keys)
    j = t.join(s, on & F.coalesce(tc[CURRENT], F.lit(False)), "full_outer")
    old, new = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    hit = old & new

    def any_of(preds):
        out = F.lit(False)
        for p in preds:
            out = out | p
        return out

    def all_of(preds):
        out = F.lit(True)
        for p in preds:
            out = out & p
        return out

    t2 = hit & any_of([_differs(tc[c], sc[c], null_safe_changes) for c in tracked])
    same_tracked = all_of([_equal(tc[c], sc[c], null_safe_changes) for c in tracked])
    t1 = hit & same_tracked & any_of([_differs(tc[c], sc[c], null_safe_changes) for c in type1])
    updated = {}
    for c in cols:
        if c == EFF_END:
            updated[c] = F.when(t2, sc[EFF_START]).otherwise(tc[c])
        elif c == CURRENT:
            updated[c] = F.when(t2, F.lit(False)).otherwise(tc[c])
        elif c in type1 or c in touch:
            updated[c] = F.when(t1, sc[c]).otherwise(tc[c])
        else:
            updated[c] = tc[c]
    kept = F.when(old, F.struct(*[updated[c].alias(c) for c in cols]))
    fresh = F.when(~old | t2, F.col("__s")) if insert_new_version else F.when(~old, F.col("__s"))
    rows = F.explode(F.array_compact(F.array(kept, fresh)))
    return j.select(rows.alias("__r")).select("__r.*")
