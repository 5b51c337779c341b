"""Bronze -> silver -> gold runs composed from the operators.

Each layer is a function over a :class:`~strata.sources.tables.TableStore`
and a spec naming the columns, so the same run serves the admissions layout
of the source pipeline (:mod:`strata.plans.presets`) or any other table.
Order of effects in silver: write -> gate -> publish -> quarantine ->
watermark, so a failed gate leaves the table, the sink and the mark untouched.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical, parse_date, title_case
from ..functions.cleanse import null_out_of_range
from ..functions.keys import wide_key
from ..functions.privacy import mask, restricted_flag
from ..operators.dedup import dedup_rows, latest_per_key
from ..operators.history import scd_init, scd_merge
from ..operators.impute import Rule, impute
from ..operators.nulls import split_by_null_ratio, split_critical
from ..operators.privacy import not_null_view, public_view
from ..operators.metric_state import MetricState
from ..operators.quality import GateRule, enforce_gate, gate_report, quality_score
from ..operators.star import build_dimension, require_distinct_keys
from ..session import cut_lineage, stage_columns
from ..sources.files import (check_format, check_not_empty, content_digest, default_batch_id, load_mode, read_raw,
                             split_corrupt)
from ..sources.quarantine import envelope, file_event, quarantine
from ..sources.schema import add_ingest_metadata, detect_drift, drift_rows, fill_missing, normalise_columns
from ..sources.tables import TableStore, create_or_upsert, merge_into
from ..streaming.incremental import incremental_batch, read_watermark, save_watermark, slice_filter


# ------------------------------------------------------------------- specs
@dataclass
class BronzeSpec:
    expected: Sequence[str]                  # raw column names
    keys: Sequence[str]                      # normalised business key
    # a file loaded before is merged again ('upsert'), left ('skip'), or left if its
    # content is what this table took from it last ('once')
    on_seen: str = "upsert"
    table: str = "bronze"
    # expression of the key: merges rewrite only touched partitions (None:
    # the whole table is rewritten, as a plain MERGE does)
    partition: Callable[[], Column] | None = None


@dataclass
class SilverSpec:
    keys: Sequence[str]
    null_cols: Sequence[str] | None = None
    null_threshold: float = 0.30
    types: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)      # col -> (lo, hi, lo_inclusive)
    dates: dict[str, str] = field(default_factory=dict)         # col -> pattern
    title: Sequence[str] = ()
    categories: dict[str, tuple] = field(default_factory=dict)  # col -> (allowed, fold)
    rules: Sequence[Rule] = ()
    row_key: Sequence[str] | None = None                        # donor order (default: keys)
    seed: int = 42
    critical: Sequence[str] = ()
    derive: dict[str, Callable[[], Column]] = field(default_factory=dict)
    masks: dict[str, str] = field(default_factory=dict)         # raw col -> masked col
    restricted: tuple | None = None                             # (col, values)
    scd_start: str | None = None                                # start column (None: load date)
    tracked: Sequence[str] = ()
    type1: Sequence[str] = ()
    touch: Sequence[str] = ()
    slice_col: str | None = None
    # partition expression of the business key: a merge rewrites only the
    # partitions its batch touches (None: the whole table)
    partition: Callable[[], Column] | None = None
    gate_not_null: Sequence[str] = ()
    report_null_cols: Sequence[str] = ()                        # columns of the null report and the score
    gate_rules: dict[str, Callable[[], Column]] = field(default_factory=dict)
    report_ranges: dict[str, Callable[[], Column]] = field(default_factory=dict)
    score_rename: dict[str, str] = field(default_factory=dict)
    exclude_sources: Sequence[str] = ()
    source_table: str = "bronze"
    table: str = "silver"


@dataclass
class DimSpec:
    name: str
    natural_key: Sequence[str]
    attrs: Sequence[str]
    sk: str
    rename: dict[str, str] = field(default_factory=dict)
    history: bool = False       # built from all versions (True) or current rows
    order: Sequence[str] = ()   # greatest wins among rows of one natural key


@dataclass
class GoldSpec:
    dims: Sequence[DimSpec]
    fact_name: str
    fact_cols: Sequence[str]
    fact_key: Sequence[str]
    fact_rename: dict[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    restricted_col: str = "_is_restricted"
    marts: dict[str, Callable[[DataFrame, dict[str, DataFrame]], DataFrame]] = field(default_factory=dict)
    summary_view: tuple | None = None        # (mart name, not-null column)
    source_table: str = "silver"
    namespace: str | None = None             # catalog schema made for SQL users


# ------------------------------------------------------------------ bronze
def bronze(spark: SparkSession, store: TableStore, path: str, spec: BronzeSpec,
           batch_id: str | None = None, fmt: str | None = None) -> dict:
    """Ingest one raw file into the bronze table; returns a summary dict.

    A load's id is made of its path and content and is switched into the table's
    pointer with its rows.  So a load tried again after a crash, wherever that
    was, finds out whether its rows are in, and its rejects (kept under that id,
    once the rows are in) are there once."""
    batch_id = default_batch_id(batch_id)

    def reject(p, reason):
        quarantine(file_event(spark, "bronze", p, reason, batch_id), store.root, _load_id(p, reason), "file")

    ext = check_format(path, fmt, on_reject=reject)
    log = None
    if store.exists(LOAD_LOG) and store.exists(spec.table):
        log = store.read(LOAD_LOG).filter(F.coalesce("table_name", F.lit(spec.table)) == spec.table)
    mode = load_mode(log, path)
    if mode == "update" and spec.on_seen == "skip":
        return {"mode": "skipped", "source_file": path}
    # the raw file is parsed once; everything below reads the parsed rows
    raw = stage_columns(read_raw(spark, path, ext, columns=None))
    good, bad = split_corrupt(check_not_empty(raw, path, on_reject=reject))
    digest = content_digest(raw)
    load = _load_id(path, digest)

    def logged(how: str) -> None:
        row = spark.createDataFrame([(path, batch_id, how, spec.table, digest)], LOAD_ROW)
        store.append(row.withColumn("loaded_at", F.current_timestamp()), LOAD_LOG)

    if spec.on_seen == "once":
        last = log.filter(F.col("source_file") == path).agg(F.max_by("digest", "loaded_at").alias("d")).first()["d"] if log is not None else None
        if last == digest:
            return {"mode": "repeated", "source_file": path}
        if store.load_id(spec.table) == load:       # the rows are in, the load ended before its log row
            logged("repeated")
            return {"mode": "repeated", "source_file": path}
    new, missing = detect_drift(good, spec.expected)
    if new or missing:
        store.append(drift_rows(spark, new, missing, path), "schema_drift")
    df = normalise_columns(fill_missing(good, missing))
    df = add_ingest_metadata(df, path, ext, batch_id)
    # deterministic survivor per business key (every other column breaks ties)
    df = stage_columns(latest_per_key(df, list(spec.keys), []))
    with store.loading(load):
        create_or_upsert(store, spec.table, df, list(spec.keys), spec.partition() if spec.partition else None)
    quarantine(envelope(bad, "bronze", "parse_error", path, batch_id), store.root, load, "parse")
    logged(mode)
    return {"mode": mode, "source_file": path, "new_columns": new, "missing_columns": missing}


LOAD_LOG = "load_log"       # a row per table and loaded file
LOAD_ROW = "source_file string, batch_id string, mode string, table_name string, digest string"


def _load_id(path: str, content: str) -> str:
    return hashlib.sha256(f"{content}:{path}".encode()).hexdigest()[:32]


# ------------------------------------------------------------------ silver
def cleanse(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Coercion, range nulling, dates, title case and whitelists: one projection."""
    exprs: dict[str, Column] = {}
    for c, t in spec.types.items():
        exprs[c] = F.col(c).try_cast(t)
    for c, (lo, hi, lo_inc) in spec.ranges.items():
        exprs[c] = null_out_of_range(exprs.get(c, F.col(c)), lo=lo, hi=hi, lo_inclusive=lo_inc)
    for c, fmt in spec.dates.items():
        exprs[c] = parse_date(c, fmt)
    for c in spec.title:
        exprs[c] = title_case(c)
    for c, (allowed, fold) in spec.categories.items():
        exprs[c] = canonical(c, allowed, fold)
    return df.withColumns(exprs)


def silver(spark: SparkSession, store: TableStore, spec: SilverSpec, *, slice_value: str = "All",
           batch_id: str | None = None, enforce: bool = True) -> dict:
    """Incremental bronze -> silver run.  Returns the summary with the quality
    report (one-row DataFrame) and gate report."""
    batch_id = default_batch_id(batch_id)
    wm_path = f"{store.root}/_watermarks/{spec.table}"
    scope = f"{spec.slice_col}={slice_value}" if spec.slice_col else "all"
    mark = read_watermark(spark, wm_path, scope)
    src = store.read(spec.source_table)
    df = incremental_batch(src, "ingested_at", mark,
                           exclude={"source_file": s for s in spec.exclude_sources})
    if spec.slice_col:
        df = slice_filter(df, spec.slice_col, slice_value)
    # the batch is read by several statistics jobs below: materialise it once
    df = stage_columns(df)
    processed = df
    if not df.take(1):
        return {"rows": 0, "published": None}
    clean, quar = split_by_null_ratio(df, spec.null_threshold, spec.null_cols)
    qenv = envelope(quar, "silver", F.col("quarantine_reason"), F.col("source_file"), batch_id)
    # normalise key text before deduplicating, so differently cased copies collide
    clean = clean.withColumns({c: title_case(c) for c in spec.title if c in spec.keys})
    clean = latest_per_key(dedup_rows(clean), list(spec.keys), ["ingested_at"])
    # every imputation rule computes statistics over this frame: materialise
    # the deduplicated, typed batch once instead of re-running its shuffles
    typed = stage_columns(cleanse(clean, spec))
    # the kept and the rejected rows, the merge, its guards and the list of touched
    # partitions all read the filled rows
    filled = stage_columns(impute(typed, list(spec.rules), row_key=list(spec.row_key or spec.keys), seed=spec.seed))
    kept, rejected = split_critical(filled, list(spec.critical)) if spec.critical else (filled, None)
    if rejected is not None:
        qenv = qenv.unionByName(
            envelope(rejected, "silver", F.col("quarantine_reason"), F.col("source_file"), batch_id))
    out = kept.withColumns({c: f() for c, f in spec.derive.items()})
    out = out.withColumns({m: mask(c) for c, m in spec.masks.items()})
    if spec.restricted:
        out = out.withColumn("_is_restricted", restricted_flag(spec.restricted[0], spec.restricted[1]))
    out = scd_init(out, spec.scd_start)
    cur = F.col("_is_current")
    rules = [GateRule("non_empty", kind="empty")]
    rules += [GateRule(f"no_nulls_{c}", F.col(c).isNull()) for c in spec.gate_not_null]
    rules += [GateRule(n, f()) for n, f in spec.gate_rules.items()]
    dup_keys = [spec.masks.get(k, k) for k in spec.keys]
    rules.append(GateRule("unique_current_keys", kind="dup_keys", keys=dup_keys))
    gates = []

    def check(merged_rows: DataFrame) -> None:
        # the gate sees every row the merge will write (the touched partitions)
        rows = gate_report(merged_rows, rules, current=cur).collect()  # one row per rule
        gates.append(rows)
        if enforce:
            enforce_gate(rows)

    def history_merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return scd_merge(old, new, list(spec.keys), tracked=list(spec.tracked),
                         type1=list(spec.type1), touch=list(spec.touch))

    if spec.partition:
        merge_into(store, spec.table, out, history_merge, spec.partition(), check)
    else:
        merged = cut_lineage(history_merge(store.read(spec.table), out) if store.exists(spec.table) else out)
        check(merged)
        store.publish(merged, spec.table)
    # rows over the null threshold and rows missing a critical value: kept once
    # the gate let the run pass, so a run tried again leaves them once
    quarantine(qenv, store.root, batch_id, "silver")
    gate = spark.createDataFrame(gates[-1], "rule string, failures long, passed boolean")
    save_watermark(processed, "ingested_at", wm_path, scope)
    # the report covers the whole history, but only partitions that this batch
    # touched are counted again
    state = MetricState(
        store, spec.table, dup_keys, current=cur, null_cols=list(spec.report_null_cols or spec.gate_not_null),
        range_rules={n: f() for n, f in spec.report_ranges.items()}, mask_cols=list(spec.masks.values()))
    metrics = cut_lineage(state.report(processed, quar))
    return {"rows": metrics.first()["final"], "published": True, "gate": gate,
            "report": quality_score(metrics, rename=spec.score_rename)}


# -------------------------------------------------------------------- gold
def gold(spark: SparkSession, store: TableStore, spec: GoldSpec) -> dict[str, DataFrame]:
    """Dimensions (hash surrogate keys), fact, marts and views; publishes
    each table and returns the published frames (read back from the store)."""
    silver_all = store.read(spec.source_table)
    current = silver_all.filter(F.col("_is_current"))
    out: dict[str, DataFrame] = {}
    fact = current
    for d in spec.dims:
        base = silver_all if d.history else current
        dim = build_dimension(base.withColumnsRenamed(d.rename), [d.rename.get(c, c) for c in d.natural_key],
                              list(d.attrs), d.sk, order=list(d.order) or None, key="wide")
        store.publish(dim, d.name)
        out[d.name] = store.read(d.name)
        require_distinct_keys(out[d.name], [d.rename.get(c, c) for c in d.natural_key], d.sk, d.name)
        # hash keys are computed row-locally from the same natural key: the
        # fact needs no join to pick them up
        fact = fact.withColumn(d.sk, wide_key(*d.natural_key))
    fact = fact.withColumn("visit_sk", wide_key(*spec.fact_key))
    require_distinct_keys(fact, list(spec.fact_key), "visit_sk", spec.fact_name)
    fact = fact.select(
        "visit_sk", *[d.sk for d in spec.dims],
        *[F.col(c).alias(spec.fact_rename.get(c, c)) for c in spec.fact_cols])
    store.publish(fact, spec.fact_name, partition_by=list(spec.partition_by) or None)
    out[spec.fact_name] = store.read(spec.fact_name)
    for name, build in spec.marts.items():
        store.publish(build(out[spec.fact_name], out), name)
        out[name] = store.read(name)
    out[f"vw_{spec.fact_name}_public"] = public_view(out[spec.fact_name], spec.restricted_col)
    if spec.summary_view:
        m, c = spec.summary_view
        out[f"vw_{m}"] = not_null_view(out[m], c)
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    if spec.namespace:
        ensure_namespace(spark, spec.namespace)
    return out


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """Catalog namespace for SQL users of the published views."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
