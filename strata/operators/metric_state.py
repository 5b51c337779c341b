"""Quality metrics kept as one small row per partition.

Counts add up over partitions, and so does the number of distinct business keys,
since a merge table keeps all versions of a key in one partition.  A state row
names the files' folders that it was counted from.  Partitions whose folders are
no longer those are counted again, all others are not read: a report after a
load costs what the load touched, and a state that a crash left behind mends
itself.  The sums equal those of a scan of the whole table.

A table that is not partitioned by its key is one unit, counted whole whenever it
has changed.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import PART, TableStore
from .quality import metric_flags, metric_percentages


class MetricState:
    """State of one table of ``store``, kept in its table ``<name>__metrics``."""

    def __init__(self, store: TableStore, table: str, keys: Sequence[str], *, current: Column | None = None,
                 null_cols: Sequence[str] = (), range_rules: dict[str, Column] | None = None, mask_cols: Sequence[str] = ()):
        self.store, self.table, self.keys = store, table, list(keys)
        self.null_cols, self.range_rules = list(null_cols), dict(range_rules or {})
        self.flags = metric_flags(current, null_cols, self.range_rules, mask_cols)
        self.name = f"{table}__metrics"

    def units(self) -> dict[str, str]:
        """Partition value -> the folders that hold it (one line; from the pointer)."""
        entry = self.store._entry(self.table)
        out: dict[str, list[str]] = {}
        for f in entry["folders"]:
            value = f.rstrip("/").rsplit(f"/{PART}=", 1)[1] if entry["partition_by"] == [PART] else ""
            out.setdefault(value, []).append(f.split(f"/{self.table}/", 1)[-1])
        return {v: "\n".join(sorted(f)) for v, f in out.items()}

    def counted(self, df: DataFrame, unit: Column) -> DataFrame:
        """One row per unit: ``final``, ``distinct_keys`` and the number of rows
        of each flag.  Rows are summed by key first, so a hot key is small."""
        flags = {f"f{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(self.flags.values())}
        row = df.select(unit.alias("unit"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)],
                        *[c.cast("long").alias(n) for n, c in flags.items()])
        names = list(self.flags)
        per = row.groupBy("unit", *[f"k{i}" for i in range(len(self.keys))]).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in flags])
        now = f"f{names.index('__current')}"
        return per.groupBy("unit").agg(
            F.sum("n").alias("final"), F.count_if(F.col(now) > 0).alias("distinct_keys"),
            *[F.sum(f"f{i}").alias(n) for i, n in enumerate(names)])

    def refresh(self) -> list[str]:
        """Bring the state up to date; the partition values that were counted."""
        store, units = self.store, self.units()
        have = store.read(self.name) if store.exists(self.name) else None
        known = {r["unit"]: r["folders"] for r in have.select("unit", "folders").collect()} if have is not None else {}   # partitions
        stale = [u for u, f in units.items() if known.get(u) != f]
        if not stale and set(known) == set(units):
            return []
        entry = store._entry(self.table)
        fresh = {f"/{f}" for u in stale for f in units[u].split("\n")}
        hit = [f for f in entry["folders"] if any(f.endswith(x) for x in fresh)]
        df = store._frame(self.table, entry, hit)
        unit = F.coalesce(F.col(PART).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) if PART in df.columns else F.lit("")
        names = store.spark.createDataFrame([(u, units[u]) for u in stale] or [("", "")], "unit string, folders string")
        now = self.counted(df, unit).join(F.broadcast(names), "unit")       # a row per partition
        if have is not None:
            kept = [u for u in known if u in units and u not in set(stale)]
            now = have.filter(F.col("unit").isin(kept) if kept else F.lit(False)).unionByName(now)
        store.publish(now.coalesce(1), self.name)
        return stale

    def report(self, processed: DataFrame | None = None, quarantined: DataFrame | None = None) -> DataFrame:
        """The row that ``quality_metrics`` gives for the whole table, from the
        state and the counts of the batch's frames."""
        self.refresh()
        sums = {c: F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in ("final", "distinct_keys", *self.flags)}
        m = self.store.read(self.name).agg(*[c.alias(n) for n, c in sums.items()])
        m = m.withColumnsRenamed({"__unmasked": "unmasked", "__current": "current_rows",
                                  **{f"n__{c}": f"{c}_nulls" for c in self.null_cols},
                                  **{f"r__{r}": f"{r}_violations" for r in self.range_rules}})
        for name, df in (("processed", processed), ("quarantined", quarantined)):
            m = m.withColumn(name, df.agg(F.count(F.lit(1)).alias("n")).scalar() if df is not None else F.lit(0).cast("long"))
        return metric_percentages(m, True, self.null_cols, self.range_rules)
