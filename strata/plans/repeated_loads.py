"""Catalogue queries over tables that are loaded again and again: quality state
by partition, merges that rewrite single files, loads that may be repeated."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metric_state import MetricState
from ..operators.upsert import upsert
from ..session import shared_dir
from ..sources.tables import merge_files, merge_into
from .catalog import CUST_TYPES, ORDER_COLS, ORACLE, _orders_split, _store, query, table, with_dirty
from .dirty import dirty_orders
from .layers import BronzeSpec, bronze

FILES = 16


@query("q_quality_state", with_dirty("""
m AS (SELECT count(*) AS final, count(DISTINCT k) AS distinct_keys,
             count(*) FILTER (priority IS NULL) AS priority_nulls, count(*) FILTER (status IS NULL) AS status_nulls,
             count(*) FILTER (o_custkey % 7 = 0) AS sevenths_violations,
             count(*) FILTER (date_txt IS NULL) AS unmasked
      FROM dirty_orders)
SELECT final, distinct_keys, priority_nulls, status_nulls, sevenths_violations, unmasked,
       final AS current_rows, final - distinct_keys AS dup_count,
       CASE WHEN final > 0 THEN (priority_nulls + status_nulls) / 2 / final * 100 ELSE 0.0 END AS avg_null_pct FROM m"""))
def q_quality_state(spark, sf):
    """Two loads into a merge table of 16 key buckets, the second into three of
    them: the report after it counts those three again and no other."""
    st = _store(spark)
    d = dirty_orders(table(spark, sf, "orders"))
    bucket = (F.col("k") % 16).cast("int")
    late = F.col("k") % 16 < 3

    def merge(old, new):
        return upsert(old, new, ["k"])
    state = MetricState(st, "orders", ["k"], null_cols=["priority", "status"],
                        range_rules={"sevenths": F.col("o_custkey") % 7 == 0}, mask_cols=["date_txt"])
    merge_into(st, "orders", d.filter(~late | (F.col("k") % 5 == 0)), merge, bucket)
    first = state.refresh()
    merge_into(st, "orders", d.filter(late), merge, bucket)
    second = state.refresh()
    if not (len(first) >= len(second) and set(second) <= {"0", "1", "2"}):
        raise AssertionError(f"counted {first}, then {second}")
    return state.report().select("final", "distinct_keys", "priority_nulls", "status_nulls", "sevenths_violations",
                                 "unmasked", "current_rows", "dup_count", "avg_null_pct")


@query("q_merge_files", ORACLE["q_upsert"])
def q_merge_files(spark, sf):
    """The upsert of ``q_upsert`` in two steps into a table of 16 files laid out
    by order date: only files that hold a key of the batch are written again."""
    target, batch = _orders_split(spark, sf)
    st = _store(spark)
    st.publish(target.repartitionByRange(FILES, "o_orderdate").sortWithinPartitions("o_orderkey"), "orders")

    def merge(old, new):
        return upsert(old, new, ["o_orderkey"])
    new = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    merge_files(st, "orders", batch.filter(~new), ["o_orderkey"], merge)
    merge_files(st, "orders", batch.filter(new), ["o_orderkey"], merge)
    return st.read("orders").select(*ORDER_COLS.split(", "))


@query("q_load_twice", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS loads
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def q_load_twice(spark, sf):
    """Two files loaded three times; before the third time one of them changes.
    Repeated loads change nothing; the changed file is merged once more."""
    c = table(spark, sf, "customer").select(*CUST_TYPES)
    spec = BronzeSpec(expected=[x for x in CUST_TYPES if x != "c_mktsegment"], keys=["c_custkey"], on_seen="once")
    st, d = _store(spark), shared_dir(spark, "sources", "twice")
    segments = ("BUILDING", "MACHINERY")        # fixed values

    def put(segment, df):
        (df.filter(F.col("c_mktsegment") == segment).drop("c_mktsegment").coalesce(1)
         .write.mode("overwrite").option("header", "true").csv(f"{d}/{segment}"))

    def load(batch):
        return [bronze(spark, st, f"{d}/{s}", spec, batch, "csv")["mode"] for s in segments]
    for s in segments:
        put(s, c)
    modes = [load("b1"), load("b2")]
    put(segments[0], c.withColumn("c_acctbal", F.col("c_acctbal") + 1))
    modes.append(load("b3"))
    if modes != [["first_load", "insert"], ["repeated", "repeated"], ["update", "repeated"]]:
        raise AssertionError(str(modes))
    kinds = {x: t for x, t in CUST_TYPES.items() if x != "c_mktsegment"}
    return st.read("bronze").select(*[F.col(x).cast(t).alias(x) for x, t in kinds.items()],
                                    F.when(F.col("batch_id") == "b3", 2).otherwise(1).alias("loads"))
