"""Query catalogue: one Spark query per operator over the driver tables, and
its DuckDB SQL twin for the correctness check.

Conventions that keep both engines bit-identical: dates leave as ISO text,
money averages are computed in whole cents, integer sums are cast to bigint,
every tie is broken by a total order, and no current-time column is output.
Domain analogue of the source pipeline: order = visit, customer = patient,
supplier = doctor, nation = hospital, o_orderpriority = admission type,
o_orderstatus / c_mktsegment = condition, o_totalprice / l_extendedprice =
billing, l_shipdate = discharge, l_returnflag 'R' = abnormal result.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (band, canonical, day_diff, mask, null_out_of_range, parse_date,
                         restricted_flag, title_case, try_double, try_int)
from ..operators.dedup import dedup_any, dedup_rows, latest_per_key
from ..operators.history import scd_init, scd_merge
from ..operators.impute import Rule, impute, impute_donor, impute_median, impute_mode, null_summary
from ..operators.layout import cluster_by
from ..operators.nulls import split_by_null_ratio, split_critical
from ..operators.privacy import not_null_view, public_view
from ..operators.quality import (GateRule, dup_report, gate_report, null_report, quality_metrics,
                                 quality_score, range_report, scd_report)
from ..operators.star import (attach_keys, build_dimension, extend_dimension, group_summary, money_avg,
                              money_sum)
from ..operators.upsert import upsert
from ..session import shared_dir
from ..sources.files import check_format, check_not_empty, read_raw, split_corrupt
from ..sources.quarantine import envelope, file_event, quarantine, read_quarantine
from ..sources.schema import add_ingest_metadata, detect_drift, fill_missing, normalise_columns
from ..sources.tables import TableStore, create_or_upsert, merge_into
from ..streaming.file_ingest import ingest_files
from ..streaming.incremental import incremental_batch, read_watermark, save_watermark, slice_filter
from .dirty import DIRTY_ORDERS_SQL, PRIORITIES, STATUSES, dirty_orders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# queries without a SQL twin, and why (they are checked in tests instead)
NO_ORACLE: dict[str, str] = {
    "q_admissions_condition_summary": "whole bronze/silver/gold flow; tests/test_layers.py",
    "q_admissions_quality": "whole bronze/silver/gold flow; tests/test_layers.py",
}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read-only input).  Its schema is inferred once per
    path and then supplied, so later reads start no inference job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
    else:
        df = spark.read.schema(schema).parquet(path)
    return df


def iso(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def _with(ctes: list[str], sql: str) -> str:
    body = sql.strip()
    sep = "\n" if body.upper().startswith("SELECT") else ",\n"
    return "WITH " + ",\n".join(c.strip() for c in ctes) + sep + body


def with_dirty(sql: str) -> str:
    return _with([DIRTY_ORDERS_SQL], sql)


def initcap_sql(expr: str) -> str:
    """DuckDB has no initcap: upper-case the first letter of each space word."""
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


# ---------------------------------------------------------------- dedup
LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus"]


@query("q_latest_per_key", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, {', '.join(c + ' DESC NULLS LAST' for c in LI_REST)}) AS rn
      FROM lineitem) WHERE rn = 1""")
def q_latest_per_key(spark, sf):
    li = table(spark, sf, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("q_distinct_rows", """
SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS event_date FROM events""")
def q_distinct_rows(spark, sf):
    ev = table(spark, sf, "events")
    return dedup_rows(ev.select("user_id", "event_type", iso(F.col("ts")).alias("event_date")))


# --------------------------------------------------- null ratio split
DIRTY_COLS = ["o_custkey", "price_txt", "priority", "status", "date_txt"]


def _blank_sql(c):
    return f"CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN 1 ELSE 0 END"


_NULL_COUNT_SQL = " + ".join(_blank_sql(c) for c in DIRTY_COLS)


@query("q_null_ratio_split", with_dirty(f"""
scored AS (SELECT k, {_NULL_COUNT_SQL} AS n FROM dirty_orders)
SELECT k, CASE WHEN n / 5 > 0.3 THEN 'quarantine' ELSE 'clean' END AS route,
       CASE WHEN n / 5 > 0.3 THEN 'null_pct_exceeds_0.3' END AS quarantine_reason,
       n AS _null_count, n / 5 AS _null_pct
FROM scored"""))
def q_null_ratio_split(spark, sf):
    d = dirty_orders(table(spark, sf, "orders"))
    clean, quarantined = split_by_null_ratio(d, 0.30, DIRTY_COLS, keep_scores=True)
    cols = ["k", "_null_count", "_null_pct"]
    return (quarantined.select(*cols, F.lit("quarantine").alias("route"), "quarantine_reason")
            .unionByName(clean.select(*cols, F.lit("clean").alias("route")), allowMissingColumns=True))


# ------------------------------------------- coercion, ranges, dates
@query("q_coerce_range_date", with_dirty("""
SELECT k,
  CASE WHEN TRY_CAST(price_txt AS DOUBLE) < 0 THEN NULL ELSE TRY_CAST(price_txt AS DOUBLE) END AS price,
  CASE WHEN regexp_full_match(trim(replace(price_txt, '.', '')), '[+-]?[0-9]+')
       THEN CASE WHEN TRY_CAST(trim(replace(price_txt, '.', '')) AS INTEGER) < 0 THEN NULL
                 ELSE TRY_CAST(trim(replace(price_txt, '.', '')) AS INTEGER) END END::DOUBLE AS price_cents,
  strftime(CAST(try_strptime(date_txt, '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS order_date
FROM dirty_orders"""))
def q_coerce_range_date(spark, sf):
    d = dirty_orders(table(spark, sf, "orders"))
    return d.select(
        "k",
        null_out_of_range(try_double("price_txt"), lo=0, lo_inclusive=True, hi=None).alias("price"),
        # nullable ints leave as double so both engines yield the same dtype
        null_out_of_range(try_int(F.replace(F.col("price_txt"), F.lit("."), F.lit(""))),
                          lo=0, lo_inclusive=True, hi=None).cast("double").alias("price_cents"),
        iso(parse_date("date_txt")).alias("order_date"),
    )


# ------------------------------------------- text case and categories
@query("q_title_case", f"""
SELECT p_partkey, {initcap_sql('p_name')} AS name_title FROM part""")
def q_title_case(spark, sf):
    return table(spark, sf, "part").select("p_partkey", title_case("p_name").alias("name_title"))


_PRI_LIST = ", ".join(f"'{p}'" for p in PRIORITIES)
_STA_LIST = ", ".join(f"'{s}'" for s in STATUSES)


@query("q_canonical", with_dirty(f"""
SELECT k,
  CASE WHEN upper(priority) IN ({_PRI_LIST}) THEN upper(priority) END AS priority_clean,
  CASE WHEN status IN ({_STA_LIST}) THEN status END AS status_clean
FROM dirty_orders"""))
def q_canonical(spark, sf):
    d = dirty_orders(table(spark, sf, "orders"))
    return d.select("k", canonical("priority", PRIORITIES, fold="upper").alias("priority_clean"),
                    canonical("status", STATUSES, fold=None).alias("status_clean"))


# ------------------------------------------------------ critical filter
CLEAN_ORDERS_SQL = f"""
clean_orders AS (
  SELECT k, o_custkey,
    CASE WHEN TRY_CAST(price_txt AS DOUBLE) < 0 THEN NULL ELSE TRY_CAST(price_txt AS DOUBLE) END AS price,
    CASE WHEN upper(priority) IN ({_PRI_LIST}) THEN upper(priority) END AS priority,
    CASE WHEN status IN ({_STA_LIST}) THEN status END AS status,
    CAST(try_strptime(date_txt, '%Y-%m-%d') AS DATE) AS order_date
  FROM dirty_orders)"""


def clean_orders(spark, sf) -> DataFrame:
    """Dirty orders after coercion, range check, date parse and whitelists."""
    return cleanse_orders(dirty_orders(table(spark, sf, "orders")))


def cleanse_orders(d: DataFrame, keep_raw: bool = False) -> DataFrame:
    raw = [try_double("price_txt").alias("raw_price")] if keep_raw else []
    return d.select(
        "k", "o_custkey", *raw,
        null_out_of_range(try_double("price_txt"), lo=0, lo_inclusive=True, hi=None).alias("price"),
        canonical("priority", PRIORITIES, fold="upper").alias("priority"),
        canonical("status", STATUSES, fold=None).alias("status"),
        parse_date("date_txt").alias("order_date"),
    )


def with_clean(sql: str) -> str:
    return _with([DIRTY_ORDERS_SQL, CLEAN_ORDERS_SQL], sql)


@query("q_critical_filter", with_clean("""
SELECT k, CASE WHEN price IS NULL OR priority IS NULL OR order_date IS NULL
               THEN 'rejected' ELSE 'kept' END AS route,
          CASE WHEN price IS NULL OR priority IS NULL OR order_date IS NULL
               THEN 'critical_null' END AS quarantine_reason
FROM clean_orders"""))
def q_critical_filter(spark, sf):
    kept, rejected = split_critical(clean_orders(spark, sf), ["price", "priority", "order_date"])
    return (kept.select("k", F.lit("kept").alias("route"))
            .unionByName(rejected.select("k", F.lit("rejected").alias("route"), "quarantine_reason"),
                         allowMissingColumns=True))


# --------------------------------------------------------------- slice filter
@query("q_slice", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE upper(o_orderpriority) = upper('1-urgent')""")
def q_slice(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return slice_filter(o, "o_orderpriority", "1-urgent")


# ------------------------------------------------------------- privacy (H1, H2)
@query("q_mask", """
SELECT c_custkey, sha256(c_name) AS name_masked,
       (c_mktsegment IS NULL OR trim(c_mktsegment) = '' OR c_mktsegment = 'HOUSEHOLD') AS _is_restricted
FROM customer""")
def q_mask(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", mask("c_name").alias("name_masked"),
                    restricted_flag("c_mktsegment", ["HOUSEHOLD"]).alias("_is_restricted"))


# ------------------------------------------------ derived columns
@query("q_derived_bands", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS length_of_stay,
  CASE WHEN l.l_extendedprice < 10000 THEN 'Low' WHEN l.l_extendedprice < 30000 THEN 'Medium'
       ELSE 'High' END AS billing_category,
  CASE WHEN l.l_quantity IS NULL THEN 'Unknown' WHEN l.l_quantity < 18 THEN 'Paediatric'
       WHEN l.l_quantity < 40 THEN 'Young Adult' WHEN l.l_quantity < 60 THEN 'Middle Aged'
       WHEN l.l_quantity < 80 THEN 'Senior' ELSE 'Elderly' END AS age_group,
  CAST(year(o.o_orderdate) AS INTEGER) AS admission_year,
  CAST(month(o.o_orderdate) AS INTEGER) AS admission_month
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_derived_bands(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    adm = F.to_date("o_orderdate")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        day_diff(F.to_date("l_shipdate"), adm).alias("length_of_stay"),
        band("l_extendedprice", [10000, 30000], ["Low", "Medium", "High"], null_label=None)
        .alias("billing_category"),
        band("l_quantity", [18, 40, 60, 80],
             ["Paediatric", "Young Adult", "Middle Aged", "Senior", "Elderly"]).alias("age_group"),
        F.year(adm).alias("admission_year"), F.month(adm).alias("admission_month"),
    )


# ------------------------------------------- star schema
def dim_customer(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select(
        "c_custkey", mask("c_name").alias("patient_id"), "c_nationkey",
        F.col("c_mktsegment").alias("medical_condition"), "c_acctbal")
    return build_dimension(c, ["c_custkey"], ["patient_id", "c_nationkey", "medical_condition",
                                              "c_acctbal"], "customer_sk")


def dim_supplier(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier").select(
        "s_suppkey", mask("s_name").alias("doctor_id"), F.col("s_name").alias("doctor_name"))
    return build_dimension(s, ["s_suppkey"], ["doctor_id", "doctor_name"], "supplier_sk")


def dim_nation(spark, sf) -> DataFrame:
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("hospital"))
    return build_dimension(n, ["n_nationkey"], ["hospital"], "nation_sk")


DIM_CUSTOMER_SQL = """
dim_customer AS (
  SELECT c_custkey, sha256(c_name) AS patient_id, c_nationkey, c_mktsegment AS medical_condition,
         c_acctbal, row_number() OVER (ORDER BY c_custkey) - 1 AS customer_sk
  FROM customer)"""
DIM_SUPPLIER_SQL = """
dim_supplier AS (
  SELECT s_suppkey, sha256(s_name) AS doctor_id, s_name AS doctor_name,
         row_number() OVER (ORDER BY s_suppkey) - 1 AS supplier_sk
  FROM supplier)"""
DIM_NATION_SQL = """
dim_nation AS (
  SELECT n_nationkey, n_name AS hospital, row_number() OVER (ORDER BY n_nationkey) - 1 AS nation_sk
  FROM nation)"""


@query("q_dim_customer", _with([DIM_CUSTOMER_SQL], "SELECT * FROM dim_customer"))
def q_dim_customer(spark, sf):
    return dim_customer(spark, sf)


@query("q_dim_supplier", _with([DIM_SUPPLIER_SQL], "SELECT * FROM dim_supplier"))
def q_dim_supplier(spark, sf):
    return dim_supplier(spark, sf)


@query("q_dim_nation", _with([DIM_NATION_SQL], "SELECT * FROM dim_nation"))
def q_dim_nation(spark, sf):
    return dim_nation(spark, sf)


def fact_visits(spark, sf, dims: dict | None = None) -> DataFrame:
    """Visit facts: one row per line item, keys from the three dimensions
    (pass ``dims`` to reuse dimension frames a caller already built)."""
    dims = dims or {}
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    visits = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
                .join(c, F.col("o_custkey") == c.c_custkey, "left"))
    keyed = attach_keys(visits, [
        (dims.get("customer") or dim_customer(spark, sf), ["o_custkey"], ["c_custkey"], "customer_sk"),
        (dims.get("supplier") or dim_supplier(spark, sf), ["l_suppkey"], ["s_suppkey"], "supplier_sk"),
        (dims.get("nation") or dim_nation(spark, sf), ["c_nationkey"], ["n_nationkey"], "nation_sk"),
    ])
    adm, dis = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    return keyed.select(
        "l_orderkey", "l_linenumber", "customer_sk", "supplier_sk", "nation_sk",
        iso(adm).alias("date_of_admission"), iso(dis).alias("discharge_date"),
        F.col("o_orderpriority").alias("admission_type"),
        F.col("l_returnflag").alias("test_results"),
        F.col("l_extendedprice").alias("billing_amount"),
        day_diff(dis, adm).alias("length_of_stay"),
        band("l_extendedprice", [10000, 30000], ["Low", "Medium", "High"], null_label=None)
        .alias("billing_category"),
        F.year(adm).alias("admission_year"), F.month(adm).alias("admission_month"),
        F.coalesce(F.col("c_acctbal") < 0, F.lit(True)).alias("_is_restricted"),
    )


FACT_SQL = """
fact AS (
  SELECT l.l_orderkey, l.l_linenumber, dc.customer_sk, ds.supplier_sk, dn.nation_sk,
    strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') AS date_of_admission,
    strftime(CAST(l.l_shipdate AS DATE), '%Y-%m-%d') AS discharge_date,
    o.o_orderpriority AS admission_type, l.l_returnflag AS test_results,
    l.l_extendedprice AS billing_amount,
    CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS length_of_stay,
    CASE WHEN l.l_extendedprice < 10000 THEN 'Low' WHEN l.l_extendedprice < 30000 THEN 'Medium'
         ELSE 'High' END AS billing_category,
    CAST(year(o.o_orderdate) AS INTEGER) AS admission_year,
    CAST(month(o.o_orderdate) AS INTEGER) AS admission_month,
    coalesce(c.c_acctbal < 0, true) AS _is_restricted
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN dim_customer dc ON o.o_custkey = dc.c_custkey
  LEFT JOIN dim_supplier ds ON l.l_suppkey = ds.s_suppkey
  LEFT JOIN dim_nation dn ON c.c_nationkey = dn.n_nationkey)"""
STAR_CTES = [DIM_CUSTOMER_SQL, DIM_SUPPLIER_SQL, DIM_NATION_SQL, FACT_SQL]


def money_avg_sql(c: str) -> str:
    s = f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS BIGINT)"
    n = f"count({c})"
    return (f"(CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * ((2 * abs({s}) + {n}) // (2 * {n})) / 100")


def money_sum_sql(c: str) -> str:
    return f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS BIGINT) / 100"


@query("q_fact_visits", _with(STAR_CTES, "SELECT * FROM fact"))
def q_fact_visits(spark, sf):
    return fact_visits(spark, sf)


def condition_summary(spark, sf) -> DataFrame:
    customers = dim_customer(spark, sf)
    fact = fact_visits(spark, sf, {"customer": customers})
    dim = customers.select("customer_sk", "medical_condition")
    joined = fact.join(dim, "customer_sk", "left")
    return group_summary(joined, ["medical_condition", "admission_type"], {
        "total_visits": F.count(F.lit(1)),
        "avg_billing": money_avg("billing_amount"),
        "avg_los": money_avg("length_of_stay"),
        "total_revenue": money_sum("billing_amount"),
        "unique_patients": F.countDistinct("customer_sk"),
    })


CONDITION_SQL = f"""
condition_summary AS (
  SELECT dc.medical_condition, f.admission_type, count(*) AS total_visits,
    {money_avg_sql('f.billing_amount')} AS avg_billing,
    {money_avg_sql('f.length_of_stay')} AS avg_los,
    {money_sum_sql('f.billing_amount')} AS total_revenue,
    count(DISTINCT f.customer_sk) AS unique_patients
  FROM fact f LEFT JOIN dim_customer dc ON f.customer_sk = dc.customer_sk
  GROUP BY dc.medical_condition, f.admission_type)"""


@query("q_condition_summary", _with(STAR_CTES + [CONDITION_SQL], "SELECT * FROM condition_summary"))
def q_condition_summary(spark, sf):
    return condition_summary(spark, sf)


@query("q_monthly_trend", _with(STAR_CTES, f"""
SELECT admission_year, admission_month, admission_type, count(*) AS total_admissions,
  {money_avg_sql('billing_amount')} AS avg_billing,
  {money_avg_sql('length_of_stay')} AS avg_los,
  CAST(sum(CASE WHEN test_results = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS abnormal_count
FROM fact GROUP BY admission_year, admission_month, admission_type
ORDER BY admission_year, admission_month"""))
def q_monthly_trend(spark, sf):
    fact = fact_visits(spark, sf)
    return group_summary(fact, ["admission_year", "admission_month", "admission_type"], {
        "total_admissions": F.count(F.lit(1)),
        "avg_billing": money_avg("billing_amount"),
        "avg_los": money_avg("length_of_stay"),
        "abnormal_count": F.sum(F.when(F.col("test_results") == "R", 1).otherwise(0)),
    }).orderBy("admission_year", "admission_month")


@query("q_public_view", _with(STAR_CTES, """
SELECT * EXCLUDE (_is_restricted) FROM fact WHERE _is_restricted = false"""))
def q_public_view(spark, sf):
    return public_view(fact_visits(spark, sf))


@query("q_summary_view", _with(STAR_CTES + [CONDITION_SQL], """
SELECT * FROM condition_summary WHERE medical_condition IS NOT NULL"""))
def q_summary_view(spark, sf):
    return not_null_view(condition_summary(spark, sf), "medical_condition")


# ------------------------------------------------------- imputation

_H_SQL = "md5('42' || '|' || CAST(k AS VARCHAR))"


def _donor_sql(frame: str) -> str:
    pick = "d.v" if frame == "full" else "CASE WHEN d.dh <= x.h THEN d.v END"
    return with_clean(f"""
x AS (SELECT *, {_H_SQL} AS h FROM clean_orders),
d AS (SELECT priority AS g, arg_min(status, h) AS v, min(h) AS dh FROM x
      WHERE status IS NOT NULL GROUP BY priority)
SELECT x.k, coalesce(x.status, {pick}, 'Unknown') AS status
FROM x LEFT JOIN d ON x.priority IS NOT DISTINCT FROM d.g""")


@query("q_impute_donor", _donor_sql("full"))
def q_impute_donor(spark, sf):
    out = impute_donor(clean_orders(spark, sf), "status", ["priority"], "Unknown",
                       row_key=["k"], seed=42, frame="full")
    return out.select("k", "status")


@query("q_impute_donor_running", _donor_sql("running"))
def q_impute_donor_running(spark, sf):
    out = impute_donor(clean_orders(spark, sf), "status", ["priority"], "Unknown",
                       row_key=["k"], seed=42, frame="running")
    return out.select("k", "status")


def _mode_cte(name: str, src: str, col: str, by: str) -> str:
    return f"""
{name} AS (SELECT g, v FROM (
    SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY n DESC, v ASC) AS rn
    FROM (SELECT {by} AS g, {col} AS v, count(*) AS n FROM {src}
          WHERE {col} IS NOT NULL GROUP BY {by}, {col})) WHERE rn = 1)"""


@query("q_impute_mode", with_clean(_mode_cte("m", "clean_orders", "status", "priority") + """
SELECT c.k, coalesce(c.status, m.v, 'Unknown') AS status
FROM clean_orders c LEFT JOIN m ON c.priority IS NOT DISTINCT FROM m.g"""))
def q_impute_mode(spark, sf):
    return impute_mode(clean_orders(spark, sf), "status", ["priority"], "Unknown").select("k", "status")


@query("q_impute_median", with_clean("""
m AS (SELECT status AS g1, priority AS g2, quantile_disc(price, 0.5) AS med
      FROM clean_orders WHERE price IS NOT NULL GROUP BY status, priority)
SELECT c.k, coalesce(c.price, m.med, 10000.0) AS price
FROM clean_orders c LEFT JOIN m
  ON c.status IS NOT DISTINCT FROM m.g1 AND c.priority IS NOT DISTINCT FROM m.g2"""))
def q_impute_median(spark, sf):
    out = impute_median(clean_orders(spark, sf), "price", ["status", "priority"], 10000.0)
    return out.select("k", "price")


IMPUTE_RULES = [
    Rule("status", ["o_custkey"], "donor", "Unknown"),
    Rule("price", ["status", "priority"], "median", 10000.0),
    Rule("priority", ["status"], "mode", "4-NOT SPECIFIED"),
]

IMPUTE_PLAN_SQL = with_clean("""
x AS (SELECT *, md5('42' || '|' || CAST(k AS VARCHAR)) AS h FROM clean_orders),
d AS (SELECT o_custkey AS g, arg_min(status, h) AS v FROM x WHERE status IS NOT NULL GROUP BY o_custkey),
s1 AS (SELECT x.k, x.o_custkey, x.price, x.priority, x.order_date,
              coalesce(x.status, d.v, 'Unknown') AS status
       FROM x LEFT JOIN d ON x.o_custkey IS NOT DISTINCT FROM d.g),
m AS (SELECT status AS g1, priority AS g2, quantile_disc(price, 0.5) AS med
      FROM s1 WHERE price IS NOT NULL GROUP BY status, priority),
s2 AS (SELECT s1.k, s1.o_custkey, s1.status, s1.priority, s1.order_date,
              coalesce(s1.price, m.med, 10000.0) AS price
       FROM s1 LEFT JOIN m ON s1.status IS NOT DISTINCT FROM m.g1
                          AND s1.priority IS NOT DISTINCT FROM m.g2),""" + _mode_cte("mo", "s2", "priority", "status") + """,
s3 AS (SELECT s2.k, s2.o_custkey, s2.status, s2.price, s2.order_date,
              coalesce(s2.priority, mo.v, '4-NOT SPECIFIED') AS priority
       FROM s2 LEFT JOIN mo ON s2.status IS NOT DISTINCT FROM mo.g)""")


def impute_plan(spark, sf) -> DataFrame:
    return impute(clean_orders(spark, sf), IMPUTE_RULES, row_key=["k"], seed=42, frame="full")


@query("q_impute_plan", IMPUTE_PLAN_SQL + "\nSELECT k, status, price, priority FROM s3")
def q_impute_plan(spark, sf):
    return impute_plan(spark, sf).select("k", "status", "price", "priority")


@query("q_null_summary", IMPUTE_PLAN_SQL + """
SELECT CAST(count_if(status IS NULL) AS BIGINT) AS status_nulls,
       CAST(count_if(price IS NULL) AS BIGINT) AS price_nulls,
       CAST(count_if(priority IS NULL) AS BIGINT) AS priority_nulls,
       CAST(count_if(order_date IS NULL) AS BIGINT) AS order_date_nulls
FROM s3""")
def q_null_summary(spark, sf):
    return null_summary(impute_plan(spark, sf), ["status", "price", "priority", "order_date"])


# ------------------------------------------------- quality report (K1-K9)

Q_NULL_COLS = ["price", "priority", "status", "order_date"]
Q_KEYS = ["o_custkey", "order_date"]


def q_range_rules():
    return {
        "negative_amount": F.col("raw_price") < 0,
        "date_out_of_range": (F.col("order_date") < F.lit("1995-01-01").cast("date"))
        | (F.col("order_date") > F.lit("2000-12-31").cast("date")),
    }


def silver_orders(spark, sf):
    """(processed, quarantined, final) of the silver-like flow on dirty orders."""
    d = dirty_orders(table(spark, sf, "orders"))
    clean, quarantined = split_by_null_ratio(d, 0.30, DIRTY_COLS)
    kept, _ = split_critical(cleanse_orders(clean, keep_raw=True), ["price", "priority", "order_date"])
    final = kept.withColumns({"cust_masked": mask("o_custkey"), "status_masked": mask("status")})
    return d, quarantined, final


def silver_metrics(spark, sf) -> DataFrame:
    processed, quarantined, final = silver_orders(spark, sf)
    return quality_metrics(final, processed=processed, quarantined=quarantined, keys=Q_KEYS,
                           null_cols=Q_NULL_COLS, range_rules=q_range_rules(),
                           mask_cols=["cust_masked", "status_masked"])


SILVER_SQL = [DIRTY_ORDERS_SQL, f"""
scored AS (SELECT *, {_NULL_COUNT_SQL} AS n FROM dirty_orders),
quar AS (SELECT * FROM scored WHERE n / 5 > 0.3),
cleaned AS (
  SELECT k, o_custkey, TRY_CAST(price_txt AS DOUBLE) AS raw_price,
    CASE WHEN TRY_CAST(price_txt AS DOUBLE) < 0 THEN NULL ELSE TRY_CAST(price_txt AS DOUBLE) END AS price,
    CASE WHEN upper(priority) IN ({_PRI_LIST}) THEN upper(priority) END AS priority,
    CASE WHEN status IN ({_STA_LIST}) THEN status END AS status,
    CAST(try_strptime(date_txt, '%Y-%m-%d') AS DATE) AS order_date
  FROM scored WHERE n / 5 <= 0.3),
final AS (
  SELECT *, sha256(CAST(o_custkey AS VARCHAR)) AS cust_masked, sha256(status) AS status_masked
  FROM cleaned WHERE price IS NOT NULL AND priority IS NOT NULL AND order_date IS NOT NULL),
per_key AS (SELECT o_custkey, order_date, count(*) AS cnt FROM final GROUP BY o_custkey, order_date),
m0 AS (
  SELECT (SELECT count(*) FROM dirty_orders) AS processed,
         (SELECT count(*) FROM quar) AS quarantined,
         count(*) AS final,
         count_if(cust_masked IS NULL OR status_masked IS NULL) AS unmasked,
         count(*) AS current_rows,
         (SELECT count(*) FROM per_key) AS distinct_keys,
         count_if(price IS NULL) AS price_nulls, count_if(priority IS NULL) AS priority_nulls,
         count_if(status IS NULL) AS status_nulls, count_if(order_date IS NULL) AS order_date_nulls,
         count_if(coalesce(raw_price < 0, false)) AS negative_amount_violations,
         count_if(coalesce(order_date < DATE '1995-01-01' OR order_date > DATE '2000-12-31', false))
           AS date_out_of_range_violations
  FROM final),
metrics AS (
  SELECT *,
    CASE WHEN final + quarantined > 0 THEN quarantined / (final + quarantined) * 100 ELSE 0.0 END AS quarantine_pct,
    CASE WHEN final > 0 THEN unmasked / final * 100 ELSE 0.0 END AS mask_pct,
    current_rows - distinct_keys AS dup_count,
    CASE WHEN current_rows > 0 THEN (current_rows - distinct_keys) / current_rows * 100 ELSE 0.0 END AS dup_pct,
    CASE WHEN final > 0 THEN negative_amount_violations / final * 100 ELSE 0.0 END AS negative_amount_pct,
    CASE WHEN final > 0 THEN date_out_of_range_violations / final * 100 ELSE 0.0 END AS date_out_of_range_pct,
    CASE WHEN final > 0 THEN (price_nulls + priority_nulls + status_nulls + order_date_nulls) / 4 / final * 100
         ELSE 0.0 END AS avg_null_pct
  FROM m0)"""]


def _band_sql(p: str, warn: int) -> str:
    return f"CASE WHEN {p} = 0 THEN 'ok' WHEN {p} < {warn} THEN 'warn' ELSE 'fail' END"


@query("q_funnel", _with(SILVER_SQL, """
SELECT processed, quarantined, final, quarantine_pct FROM metrics"""))
def q_funnel(spark, sf):
    return silver_metrics(spark, sf).select("processed", "quarantined", "final", "quarantine_pct")


@query("q_null_report", _with(SILVER_SQL, f"""
u AS (SELECT 'price' AS "column", price_nulls AS null_count, final FROM metrics UNION ALL
      SELECT 'priority', priority_nulls, final FROM metrics UNION ALL
      SELECT 'status', status_nulls, final FROM metrics UNION ALL
      SELECT 'order_date', order_date_nulls, final FROM metrics)
SELECT "column", CAST(null_count AS BIGINT) AS null_count,
       CASE WHEN final > 0 THEN null_count / final * 100 ELSE 0.0 END AS null_pct,
       {_band_sql('CASE WHEN final > 0 THEN null_count / final * 100 ELSE 0.0 END', 5)} AS status
FROM u"""))
def q_null_report(spark, sf):
    return null_report(silver_orders(spark, sf)[2], Q_NULL_COLS)


@query("q_dup_report", _with(SILVER_SQL, f"""
SELECT current_rows AS total_current, distinct_keys, dup_count, dup_pct,
       {_band_sql('dup_pct', 1)} AS status FROM metrics"""))
def q_dup_report(spark, sf):
    return dup_report(silver_orders(spark, sf)[2], Q_KEYS)


@query("q_range_report", _with(SILVER_SQL, f"""
u AS (SELECT 'negative_amount' AS rule, negative_amount_violations AS violations, final FROM metrics
      UNION ALL SELECT 'date_out_of_range', date_out_of_range_violations, final FROM metrics)
SELECT rule, CAST(violations AS BIGINT) AS violations,
       CASE WHEN final > 0 THEN violations / final * 100 ELSE 0.0 END AS pct,
       {_band_sql('CASE WHEN final > 0 THEN violations / final * 100 ELSE 0.0 END', 1)} AS status
FROM u"""))
def q_range_report(spark, sf):
    return range_report(silver_orders(spark, sf)[2], q_range_rules())


@query("q_mask_report", _with(SILVER_SQL, "SELECT CAST(unmasked AS BIGINT) AS unmasked, mask_pct FROM metrics"))
def q_mask_report(spark, sf):
    return silver_metrics(spark, sf).select("unmasked", "mask_pct")


SCORE_RENAME = {"age_pct": "date_out_of_range_pct", "billing_pct": "negative_amount_pct"}


@query("q_quality_score", _with(SILVER_SQL, """
s AS (SELECT *, greatest(100.0 - least(quarantine_pct * 2, 20.0) - least(dup_pct * 10, 20.0)
          - least(date_out_of_range_pct * 5, 10.0) - least(negative_amount_pct * 5, 10.0)
          - least(mask_pct * 20, 20.0) - least(avg_null_pct * 4, 20.0), 0.0) AS score FROM metrics)
SELECT quarantine_pct, dup_pct, date_out_of_range_pct, negative_amount_pct, mask_pct, avg_null_pct,
       score, CASE WHEN score >= 95 THEN 'A+' WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B'
                   WHEN score >= 70 THEN 'C' ELSE 'D' END AS grade
FROM s"""))
def q_quality_score(spark, sf):
    scored = quality_score(silver_metrics(spark, sf), rename=SCORE_RENAME)
    return scored.select("quarantine_pct", "dup_pct", "date_out_of_range_pct", "negative_amount_pct",
                         "mask_pct", "avg_null_pct", "score", "grade")


def q_gate_rules():
    rules = [GateRule("non_empty", kind="empty")]
    rules += [GateRule(f"no_nulls_{c}", F.col(c).isNull()) for c in Q_NULL_COLS]
    rules += [GateRule("no_negative_amount", F.col("raw_price") < 0),
              GateRule("dates_in_range", q_range_rules()["date_out_of_range"]),
              GateRule("unique_current_keys", kind="dup_keys", keys=Q_KEYS)]
    return rules


@query("q_gate", _with(SILVER_SQL, """
SELECT rule, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
  SELECT 'non_empty' AS rule, CASE WHEN final = 0 THEN 1 ELSE 0 END AS failures FROM metrics
  UNION ALL SELECT 'no_nulls_price', price_nulls FROM metrics
  UNION ALL SELECT 'no_nulls_priority', priority_nulls FROM metrics
  UNION ALL SELECT 'no_nulls_status', status_nulls FROM metrics
  UNION ALL SELECT 'no_nulls_order_date', order_date_nulls FROM metrics
  UNION ALL SELECT 'no_negative_amount', negative_amount_violations FROM metrics
  UNION ALL SELECT 'dates_in_range', date_out_of_range_violations FROM metrics
  UNION ALL SELECT 'unique_current_keys', dup_count FROM metrics)"""))
def q_gate(spark, sf):
    return gate_report(silver_orders(spark, sf)[2], q_gate_rules())


# ----------------------------------------------- upsert and history

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _orders_split(spark, sf):
    """Target: orders before 1999; batch: orders from 1998 on with a new price
    (1998 keys update, later keys insert)."""
    o = table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    target = o.filter(~F.coalesce(late, F.lit(False)))
    batch = (o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
              .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    return target, batch


@query("q_upsert", f"""
WITH t AS (SELECT {ORDER_COLS} FROM orders WHERE NOT coalesce(o_orderdate >= TIMESTAMP '1999-01-01', false)),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
             o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey)
UNION ALL SELECT * FROM s""")
def q_upsert(spark, sf):
    target, batch = _orders_split(spark, sf)
    return upsert(target, batch, ["o_orderkey"])


@query("q_upsert_evolve", f"""
WITH t AS (SELECT {ORDER_COLS}, 'legacy-' || o_orderstatus AS legacy_code
           FROM orders WHERE NOT coalesce(o_orderdate >= TIMESTAMP '1999-01-01', false)),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
             o_orderpriority, lower(o_orderpriority) AS channel
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT t.*, CAST(NULL AS VARCHAR) AS channel FROM t
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey)
UNION ALL
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate, s.o_orderpriority,
       t.legacy_code, s.channel
FROM s LEFT JOIN t ON s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey""")
def q_upsert_evolve(spark, sf):
    target, batch = _orders_split(spark, sf)
    target = target.withColumn("legacy_code", F.concat(F.lit("legacy-"), F.col("o_orderstatus")))
    batch = batch.withColumn("channel", F.lower("o_orderpriority"))
    return upsert(target, batch, ["o_orderkey"])


CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _scd_inputs(spark, sf):
    """Target: every customer current since 2024-01-01, plus a closed older
    version for some; batch (2024-02-01): every customer with key-derived
    segment (tracked) and balance (type-1) changes, plus some new keys."""
    c = table(spark, sf, "customer").select(*CUST_COLS)
    k = F.col("c_custkey")
    cur = scd_init(c, F.lit("2024-01-01"))
    old = (c.filter(k % 19 == 0).withColumn("c_mktsegment", F.lit("OLD"))
            .withColumns({"_eff_start": F.lit("2023-01-01").cast("date"),
                          "_eff_end": F.lit("2024-01-01").cast("date"), "_is_current": F.lit(False)}))
    target = cur.unionByName(old)
    seg = (F.when((k % 7 == 0) | (k % 11 == 0),
                  F.when(F.col("c_mktsegment") == "BUILDING", "MACHINERY").otherwise("BUILDING"))
            .when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")))
    bal = F.when((k % 5 == 0) | (k % 11 == 0), F.col("c_acctbal") + F.lit(100.0)).otherwise(F.col("c_acctbal"))
    changed = c.withColumns({"c_mktsegment": seg, "c_acctbal": bal})
    new = c.filter(k % 17 == 0).withColumn("c_custkey", k + F.lit(1_000_000))
    batch = scd_init(changed.unionByName(new), F.lit("2024-02-01"))
    return target, batch


def _scd_out(df: DataFrame) -> DataFrame:
    return df.select(*CUST_COLS, iso("_eff_start").alias("_eff_start"), iso("_eff_end").alias("_eff_end"),
                     "_is_current")


def _scd_sql(new_version: bool, null_safe: bool) -> str:
    def diff(a, b):
        return f"({a} IS DISTINCT FROM {b})" if null_safe else f"coalesce({a} <> {b}, false)"

    def same(a, b):
        return f"({a} IS NOT DISTINCT FROM {b})" if null_safe else f"coalesce({a} = {b}, false)"
    t2 = f"(hit AND {diff('c_mktsegment', 's_seg')})"
    t1 = f"(hit AND {same('c_mktsegment', 's_seg')} AND {diff('c_acctbal', 's_bal')})"
    newv = f"""
UNION ALL SELECT s_key, s_name, s_nat, s_bal, s_seg, s_start, NULL, true FROM j WHERE {t2}""" \
        if new_version else ""
    return f"""
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
tgt AS (SELECT *, DATE '2024-01-01' AS _eff_start, CAST(NULL AS DATE) AS _eff_end, true AS _is_current FROM c
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'OLD', DATE '2023-01-01', DATE '2024-01-01', false
        FROM c WHERE c_custkey % 19 = 0),
chg AS (SELECT c_custkey, c_name, c_nationkey,
          CASE WHEN c_custkey % 5 = 0 OR c_custkey % 11 = 0 THEN c_acctbal + 100.0 ELSE c_acctbal END AS c_acctbal,
          CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN
                 CASE WHEN c_mktsegment = 'BUILDING' THEN 'MACHINERY' ELSE 'BUILDING' END
               WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM c
        UNION ALL
        SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM c WHERE c_custkey % 17 = 0),
inc AS (SELECT *, DATE '2024-02-01' AS _eff_start, CAST(NULL AS DATE) AS _eff_end, true AS _is_current FROM chg),
cur AS (SELECT * FROM tgt WHERE _is_current),
j AS (SELECT t.*, s.c_custkey AS s_key, s.c_name AS s_name, s.c_nationkey AS s_nat, s.c_acctbal AS s_bal,
             s.c_mktsegment AS s_seg, s._eff_start AS s_start, s.c_custkey IS NOT NULL AS hit
      FROM cur t LEFT JOIN inc s ON t.c_custkey IS NOT DISTINCT FROM s.c_custkey),
merged AS (
  SELECT * FROM tgt WHERE NOT _is_current
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN {t1} THEN s_bal ELSE c_acctbal END, c_mktsegment,
         _eff_start, CASE WHEN {t2} THEN s_start ELSE _eff_end END, CASE WHEN {t2} THEN false ELSE _is_current END
  FROM j{newv}
  UNION ALL
  SELECT * FROM inc WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.c_custkey IS NOT DISTINCT FROM inc.c_custkey))
"""


_SCD_SELECT = """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  strftime(_eff_start, '%Y-%m-%d') AS _eff_start, strftime(_eff_end, '%Y-%m-%d') AS _eff_end, _is_current
FROM merged"""


def scd_merged(spark, sf, **opts) -> DataFrame:
    target, batch = _scd_inputs(spark, sf)
    return scd_merge(target, batch, ["c_custkey"], tracked=["c_mktsegment"], type1=["c_acctbal"], **opts)


@query("q_scd_merge", _scd_sql(True, True) + _SCD_SELECT)
def q_scd_merge(spark, sf):
    return _scd_out(scd_merged(spark, sf))


@query("q_scd_merge_strict", _scd_sql(False, False) + _SCD_SELECT)
def q_scd_merge_strict(spark, sf):
    """The plain-MERGE behaviour: ``!=`` tests, closing without a new version."""
    return _scd_out(scd_merged(spark, sf, insert_new_version=False, null_safe_changes=False))


@query("q_scd_report", _scd_sql(True, True) + """
, r AS (SELECT count(*) AS total, count_if(_is_current) AS current FROM merged)
SELECT total, CAST(current AS BIGINT) AS current, CAST(total - current AS BIGINT) AS historical,
       CASE WHEN total > 0 THEN (total - current) / total * 100 ELSE 0.0 END AS historical_pct FROM r""")
def q_scd_report(spark, sf):
    return scd_report(scd_merged(spark, sf))


# ------------------------------------------- incremental load
@query("q_incremental", """
SELECT * FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')""")
def q_incremental(spark, sf):
    """First run loads events before 2024-01-15 and stores the mark; the
    second run reads the mark back and takes only later events."""
    ev = table(spark, sf, "events")
    wm_path = shared_dir(spark, "watermarks")
    first = incremental_batch(ev.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")),
                              "ts", read_watermark(spark, wm_path, "events"))
    save_watermark(first, "ts", wm_path, "events")
    return incremental_batch(ev, "ts", read_watermark(spark, wm_path, "events"))


@query("q_incremental_ltz", """
SELECT event_id, user_id, event_type, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')""")
def q_incremental_ltz(spark, sf):
    """The same two runs over instants (timestamps with a time zone)."""
    ev = table(spark, sf, "events").withColumn("ts", F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit(" UTC"))))
    wm_path = shared_dir(spark, "watermarks")
    cut = F.to_timestamp(F.lit("2024-01-15 00:00:00 UTC"))
    first = incremental_batch(ev.filter(F.col("ts") < cut), "ts", read_watermark(spark, wm_path, "events"))
    save_watermark(first, "ts", wm_path, "events")
    return incremental_batch(ev, "ts", read_watermark(spark, wm_path, "events")).select(
        "event_id", "user_id", "event_type", "value")


# ------------------------------------- table maintenance
def _store(spark) -> TableStore:
    return TableStore(spark, shared_dir(spark, "tables"))


@query("q_delete_where", """
SELECT * FROM events WHERE NOT coalesce(event_type = 'error' AND value > 50, false)""")
def q_delete_where(spark, sf):
    st = _store(spark)
    st.publish(table(spark, sf, "events"), "events")
    st.delete_where("events", (F.col("event_type") == "error") & (F.col("value") > 50))
    return st.read("events")


@query("q_delete_partitioned", """
SELECT * FROM events WHERE NOT coalesce(event_type = 'error' AND value > 50, false)""")
def q_delete_partitioned(spark, sf):
    """The same delete from a table partitioned by type: only the partition
    with hits is written again, and the table stays partitioned."""
    st = _store(spark)
    ev = table(spark, sf, "events")
    st.publish(ev, "events", partition_by=["event_type"])
    st.delete_where("events", (F.col("event_type") == "error") & (F.col("value") > 50))
    return st.read("events").select(*ev.columns)


@query("q_append_evolve", f"""
SELECT {ORDER_COLS}, CAST(NULL AS VARCHAR) AS channel FROM orders
WHERE NOT coalesce(o_orderdate >= TIMESTAMP '1998-01-01', false)
UNION ALL
SELECT {ORDER_COLS}, lower(o_orderpriority) AS channel FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def q_append_evolve(spark, sf):
    o = table(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    st = _store(spark)
    late = F.coalesce(F.col("o_orderdate") >= cut, F.lit(False))
    st.publish(o.filter(~late), "orders")
    st.append(o.filter(late).withColumn("channel", F.lower("o_orderpriority")), "orders")
    return st.read("orders").select(*ORDER_COLS.split(", "), "channel")


LI_ALL = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
          "l_tax, l_returnflag, l_linestatus, l_shipdate")


@query("q_compact", f"SELECT {LI_ALL} FROM lineitem")
def q_compact(spark, sf):
    st = _store(spark)
    li = table(spark, sf, "lineitem")
    # many small segments, as a stream of small loads leaves them
    first = F.col("l_returnflag").eqNullSafe("A")
    st.publish(li.filter(first), "lineitem")
    st.append(li.filter(~first), "lineitem")
    st.compact("lineitem")
    return st.read("lineitem")


@query("q_compact_partitioned", f"SELECT {LI_ALL} FROM lineitem")
def q_compact_partitioned(spark, sf):
    """Two loads of a partitioned table, then compaction: it stays partitioned."""
    st = _store(spark)
    li = table(spark, sf, "lineitem")
    first = F.coalesce(F.col("l_linenumber") <= 3, F.lit(False))
    st.publish(li.filter(first), "lineitem", partition_by=["l_returnflag"])
    st.append(li.filter(~first), "lineitem")
    st.compact("lineitem")
    return st.read("lineitem").select(*LI_ALL.split(", "))


@query("q_cluster", f"SELECT {LI_ALL} FROM lineitem")
def q_cluster(spark, sf):
    st = _store(spark)
    st.publish(table(spark, sf, "lineitem"), "lineitem")
    st.rewrite("lineitem", lambda df, files: cluster_by(df, ["l_returnflag", "l_shipdate", "l_partkey"], files))
    return st.read("lineitem")


# --------------------------------------- sources, guards, drift

CUST_TYPES = {"c_custkey": "long", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
              "c_mktsegment": "string"}


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in CUST_TYPES.items()])


def _csv_fixture(spark, sf) -> str:
    """Customers as CSV, plus files of ragged rows derived from some of them
    (too few fields, too many fields)."""
    c = table(spark, sf, "customer").select(*CUST_TYPES)
    d = shared_dir(spark, "sources", "csv")
    c.write.option("header", "true").csv(f"{d}/good")
    k = F.col("c_custkey")
    short = c.filter(k % 50 == 0).select("c_custkey", "c_name", "c_nationkey")
    short.toDF("c_custkey", "c_name", "c_nationkey").write.option("header", "false").csv(f"{d}/short")
    long_ = c.filter(k % 70 == 0).withColumn("extra", F.lit("x"))
    long_.write.option("header", "false").csv(f"{d}/long")
    return d


def _read_csv_fixture(spark, d):
    # header from the good files; the ragged files carry no header line
    good_raw = read_raw(spark, f"{d}/good", "csv")
    names = [c for c in good_raw.columns if c != "_corrupt_record"]
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] +
                          [T.StructField("_corrupt_record", T.StringType())])
    ragged = (spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", "_corrupt_record")
                  .csv([f"{d}/short", f"{d}/long"]))
    return good_raw.unionByName(ragged)


@query("q_sources_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_sources_csv(spark, sf):
    raw = _read_csv_fixture(spark, _csv_fixture(spark, sf))
    good, _ = split_corrupt(check_not_empty(raw, "customer.csv"))
    return _typed(good)


@query("q_quarantine_csv", """
SELECT 'parse_error' AS reason, c_custkey FROM customer WHERE c_custkey % 50 = 0
UNION ALL SELECT 'parse_error', c_custkey FROM customer WHERE c_custkey % 70 = 0""")
def q_quarantine_csv(spark, sf):
    raw = _read_csv_fixture(spark, _csv_fixture(spark, sf))
    _, bad = split_corrupt(raw)
    env = envelope(bad, "bronze", "parse_error", F.lit("customer.csv"))
    first_field = F.split(F.get_json_object("row_json", "$._corrupt_record"), ",").getItem(0)
    return env.select("reason", first_field.cast("long").alias("c_custkey"))


@query("q_sources_json", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_sources_json(spark, sf):
    c = table(spark, sf, "customer").select(*CUST_TYPES)
    d = shared_dir(spark, "sources", "json")
    c.write.json(f"{d}/good")
    # truncated records derived from some customers
    (c.filter(F.col("c_custkey") % 40 == 0)
      .select(F.concat(F.lit('{"c_custkey": '), F.col("c_custkey").cast("string"), F.lit(', "c_name":')))
      .write.text(f"{d}/bad"))
    raw = read_raw(spark, f"{d}/*", "json")
    good, _ = split_corrupt(raw)
    return _typed(good)


@query("q_sources_orc", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_sources_orc(spark, sf):
    d = shared_dir(spark, "sources", "orc")
    table(spark, sf, "customer").select(*CUST_TYPES).write.orc(d)
    return _typed(check_not_empty(read_raw(spark, d, "orc"), d))


@query("q_load_mode", """
SELECT c_mktsegment, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'update' ELSE 'insert' END AS mode,
       count(*) AS customers
FROM customer GROUP BY c_mktsegment""")
def q_load_mode(spark, sf):
    """Five files, one per segment, loaded by ``bronze`` after two of them were
    loaded before: the log tells updates from inserts.  An empty file and one of
    an unknown format are refused and leave a row each in the quarantine."""
    from ..sources.files import IngestError
    from .layers import LOAD_LOG, BronzeSpec, bronze
    c = table(spark, sf, "customer").select(*CUST_TYPES)
    d = shared_dir(spark, "sources", "modes")
    c.repartition(1, "c_mktsegment").write.partitionBy("c_mktsegment").option("header", "true").csv(d)
    spec = BronzeSpec(expected=[x for x in CUST_TYPES if x != "c_mktsegment"], keys=["c_custkey"])
    st = _store(spark)
    segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")      # fixed values
    modes = [bronze(spark, st, f"{d}/c_mktsegment={s}", spec, "b1", "csv")["mode"] for s in ("BUILDING", "MACHINERY")]
    assert modes == ["first_load", "insert"]
    for s in segments:
        bronze(spark, st, f"{d}/c_mktsegment={s}", spec, "b2", "csv")
    c.filter("false").coalesce(1).write.option("header", "true").csv(f"{d}/empty")
    for path, fmt in ((f"{d}/empty", "csv"), (f"{d}/odd.xml", None)):
        try:
            bronze(spark, st, path, spec, "b3", fmt)
        except IngestError:
            continue
        raise AssertionError(f"{path} was not refused")
    assert read_quarantine(spark, st.root).filter("batch_id = 'b3'").count() == 2
    log = st.read(LOAD_LOG).filter("batch_id = 'b2'").select("source_file", "mode")
    seg = F.regexp_extract("source_file", "c_mktsegment=(\\w+)", 1).alias("c_mktsegment")
    return (st.read("bronze").join(log, "source_file").groupBy(seg, "mode").agg(F.count(F.lit(1)).alias("customers")))


@query("q_quarantine_sink", """
SELECT 'b1' AS batch_id, 'parse_error' AS reason, count(*) AS rows FROM customer
  WHERE c_custkey % 50 = 0 OR c_custkey % 70 = 0
UNION ALL SELECT 'b2', 'no data rows', 1 UNION ALL SELECT 'b3', 'cannot ingest ''xml'' files', 1""")
def q_quarantine_sink(spark, sf):
    """Rejected rows and refused files in the sink; the first batch is run
    twice and leaves its rows once."""
    from ..sources.files import IngestError
    root = shared_dir(spark, "sink")
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    bad = c.filter((k % 50 == 0) | (k % 70 == 0))
    for _ in range(2):
        quarantine(envelope(bad, "bronze", "parse_error", "customer.csv", "b1"), root, "b1", "parse")

    def reject(batch):
        return lambda path, reason: quarantine(file_event(spark, "bronze", path, reason, batch), root, batch, "file")
    for batch, path, look in (("b2", "empty.csv", lambda r: check_not_empty(c.filter("false"), "empty.csv", r)),
                              ("b3", "odd.xml", lambda r: check_format("odd.xml", on_reject=r))):
        try:
            look(reject(batch))
        except IngestError:
            continue
        raise AssertionError(f"{path} was not refused")
    return read_quarantine(spark, root).groupBy("batch_id", "reason").agg(F.count(F.lit(1)).alias("rows"))


# raw column names of the drift fixture and the expected set it is checked against
DRIFT_RAW = {"C Custkey": "c_custkey", "C-Name": "c_name", " C Nationkey ": "c_nationkey",
             "C.Acctbal": "c_acctbal"}
DRIFT_EXPECTED = ["C Custkey", "C-Name", " C Nationkey ", "C.Acctbal", "C Mktsegment"]


@query("q_drift", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 'none' ELSE 'standard' END AS loyalty_tier,
       CAST(NULL AS VARCHAR) AS c_mktsegment,
       'customer_drift.csv' AS source_file, 'csv' AS source_format, 'b1' AS batch_id
FROM customer""")
def q_drift(spark, sf):
    """A source whose columns drifted: names in another style, one expected
    column missing, one new column - detected, filled and normalised."""
    c = table(spark, sf, "customer")
    raw = c.select(*[F.col(v).cast("string").alias(k) for k, v in DRIFT_RAW.items()],
                   F.when(F.col("c_acctbal") < 0, "none").otherwise("standard").alias("Loyalty Tier"))
    new, missing = detect_drift(raw, DRIFT_EXPECTED)
    out = normalise_columns(fill_missing(raw, missing))
    out = add_ingest_metadata(out, "customer_drift.csv", "csv", "b1")
    return out.drop("ingested_at", "ingestion_date")


# ------------------------------------------- exactly-once file ingestion


@query("q_stream_ingest", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer""")
def q_stream_ingest(spark, sf):
    """Customers arrive as CSV files per segment; a later drop re-sends a
    third of them with a new balance.  Two runs of the same stream: the second
    ingests only the new files and upserts them."""
    from pyspark.sql import types as T
    c = table(spark, sf, "customer").select(*CUST_TYPES)
    root = shared_dir(spark, "stream")
    src, ckpt = f"{root}/landing", f"{root}/_checkpoint"
    c.repartition(5, "c_mktsegment").write.option("header", "true").csv(f"{src}/drop1")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in CUST_TYPES])
    st = TableStore(spark, f"{root}/tables")

    def typed(df):
        return df.select(*[F.col(c).cast(t).alias(c) for c, t in CUST_TYPES.items()], "source_file")

    def buckets():
        return (F.col("c_custkey") % 8).cast("int")

    ingest_files(spark, f"{src}/*", schema, st, "customers", ["c_custkey"], ckpt,
                 max_files_per_trigger=4, transform=typed, partition=buckets)
    (c.filter(F.col("c_custkey") % 3 == 0).withColumn("c_acctbal", F.col("c_acctbal") + F.lit(1.0))
      .write.option("header", "true").csv(f"{src}/drop2"))
    ingest_files(spark, f"{src}/*", schema, st, "customers", ["c_custkey"], ckpt,
                 max_files_per_trigger=4, transform=typed, partition=buckets)
    return st.read("customers").select(*CUST_TYPES)


# ------------------------------------------- more table operations


@query("q_dedup_any", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_dedup_any(spark, sf):
    """One survivor per key (which one is unspecified, so only keys are shown)."""
    return dedup_any(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber")


@query("q_create_or_upsert", ORACLE["q_upsert"])
def q_create_or_upsert(spark, sf):
    """First load creates the table, the second merges into it."""
    target, batch = _orders_split(spark, sf)
    st = _store(spark)
    create_or_upsert(st, "orders", target, ["o_orderkey"])
    create_or_upsert(st, "orders", batch, ["o_orderkey"])
    return st.read("orders").select(*ORDER_COLS.split(", "))


@query("q_fact_partitioned", _with(STAR_CTES, "SELECT * FROM fact WHERE admission_year = 1997"))
def q_fact_partitioned(spark, sf):
    """Fact published partitioned by year; a year filter reads one folder."""
    fact = fact_visits(spark, sf)
    st = _store(spark)
    st.publish(fact, "fact_visits", partition_by=["admission_year"])
    return st.read("fact_visits").filter(F.col("admission_year") == 1997).select(*fact.columns)


# ------------------------------------- the source pipeline's own flow, end to end
def _admissions(spark, sf, upto: str = "gold"):
    from .admissions import run_layers
    return run_layers(spark, table(spark, sf, "orders"), table(spark, sf, "customer"),
                      table(spark, sf, "nation"), shared_dir(spark, "admissions"), upto=upto)


@query("q_admissions_condition_summary")
def q_admissions_condition_summary(spark, sf):
    """bronze -> silver -> gold over admissions derived from orders; the gold
    condition summary (no SQL twin: covered by the end-to-end test)."""
    return _admissions(spark, sf)["gold"]["gold_condition_summary"]


@query("q_admissions_quality")
def q_admissions_quality(spark, sf):
    """The silver quality report (score and grade) of the same run."""
    return _admissions(spark, sf, upto="silver")["silver"]["report"]


@query("q_upsert_partitioned", ORACLE["q_upsert"])
def q_upsert_partitioned(spark, sf):
    """The same upsert through a table laid out in 16 key buckets: the merge
    reads and rewrites only the buckets its batch touches."""
    target, batch = _orders_split(spark, sf)
    st = _store(spark)
    bucket = (F.col("o_orderkey") % 16).cast("int")

    def merge(old, new):
        return upsert(old, new, ["o_orderkey"])
    merge_into(st, "orders", target, merge, bucket)
    merge_into(st, "orders", batch, merge, bucket)
    return st.read("orders").select(*ORDER_COLS.split(", "))


# ------------------------------------------- keys over loads (J4), initcap whitelist (E5)
@query("q_dim_customer_second_load", """
WITH old AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS customer_sk
             FROM customer WHERE c_custkey % 3 <> 0),
fresh AS (SELECT c_custkey, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY c_custkey) - 1 AS customer_sk
          FROM customer WHERE c_custkey % 3 = 0)
SELECT c.c_custkey, CASE WHEN c.c_custkey % 5 = 0 THEN lower(c_name) ELSE c_name END AS c_name, customer_sk
FROM customer c JOIN (SELECT * FROM old UNION ALL SELECT * FROM fresh) k USING (c_custkey)""")
def q_dim_customer_second_load(spark, sf):
    """A second load brings customers in between and new names: old ones keep
    their keys, new ones continue from the greatest."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    first = build_dimension(c.filter(k % 3 != 0), ["c_custkey"], ["c_name"], "customer_sk")
    now = c.withColumn("c_name", F.when(k % 5 == 0, F.lower("c_name")).otherwise(F.col("c_name")))
    return extend_dimension(first, now, ["c_custkey"], "customer_sk").select("c_custkey", "c_name", "customer_sk")


SEGMENTS = ["Automobile", "Building", "Furniture", "Household"]     # fixed values: a whitelist short of one


@query("q_canonical_initcap", f"""
SELECT c_custkey, CASE WHEN {initcap_sql('c_mktsegment')} IN ({', '.join(repr(x) for x in SEGMENTS)})
                       THEN {initcap_sql('c_mktsegment')} END AS segment FROM customer""")
def q_canonical_initcap(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", canonical("c_mktsegment", SEGMENTS, "initcap").alias("segment"))


from . import later_loads, point_in_time, repeated_loads  # noqa: E402,F401  (they register their queries)
