"""Catalogue queries over change history: the versioned dimension, facts as of
their date, 128-bit keys, exact medians of very large groups."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wide_key
from ..operators.asof import as_of
from ..operators.impute import impute_median_exact
from ..operators.star import build_dimension, require_distinct_keys
from .catalog import _scd_sql, clean_orders, iso, query, scd_merged, table, with_clean

HISTORY = ["_eff_start", "_eff_end", "_is_current"]
SHIFT_DAYS = 25 * 365       # orders of 1995-2001 become visits of 2019-2026


def dim_patient_history(spark, sf) -> DataFrame:
    """Every version of every customer, keyed by customer, condition and start."""
    versions = scd_merged(spark, sf).select(
        "c_custkey", F.sha2("c_name", 256).alias("patient_id"), F.col("c_mktsegment").alias("medical_condition"),
        F.col("c_acctbal").alias("balance"), *HISTORY)
    return build_dimension(versions, ["c_custkey", "medical_condition", "_eff_start"],
                           ["patient_id", "balance", "_eff_end", "_is_current"], "patient_sk",
                           order=["_is_current", "_eff_end"])


DIM_HISTORY_SQL = _scd_sql(True, True) + """
, dim_history AS (
  SELECT c_custkey, sha256(c_name) AS patient_id, c_mktsegment AS medical_condition, c_acctbal AS balance,
         _eff_start, _eff_end, _is_current,
         row_number() OVER (ORDER BY c_custkey, c_mktsegment NULLS FIRST, _eff_start) - 1 AS patient_sk
  FROM merged)
"""


@query("q_dim_patient_history", DIM_HISTORY_SQL + """
SELECT c_custkey, patient_id, medical_condition, balance, strftime(_eff_start, '%Y-%m-%d') AS _eff_start,
       strftime(_eff_end, '%Y-%m-%d') AS _eff_end, _is_current, patient_sk FROM dim_history""")
def q_dim_patient_history(spark, sf):
    d = dim_patient_history(spark, sf)
    return d.withColumns({c: iso(c) for c in HISTORY[:2]})


@query("q_fact_as_of", DIM_HISTORY_SQL + f"""
, visit AS (SELECT o_orderkey, o_custkey, o_totalprice,
                   CAST(o_orderdate AS DATE) + {SHIFT_DAYS} AS visit_date FROM orders)
SELECT v.o_orderkey, v.o_custkey, strftime(v.visit_date, '%Y-%m-%d') AS visit_date, v.o_totalprice AS billing_amount,
       CAST(d.patient_sk AS DOUBLE) AS patient_sk, d.medical_condition, d.balance
FROM visit v LEFT JOIN dim_history d
  ON v.o_custkey = d.c_custkey AND d._eff_start <= v.visit_date AND (d._eff_end IS NULL OR v.visit_date < d._eff_end)""")
def q_fact_as_of(spark, sf):
    """Visits with the version of the patient that was in force on their date."""
    visits = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS).alias("visit_date"),
        F.col("o_totalprice").alias("billing_amount"))
    out = as_of(visits, dim_patient_history(spark, sf), [("o_custkey", "c_custkey")], "visit_date",
                {c: c for c in ("patient_sk", "medical_condition", "balance")})
    return out.withColumns({"visit_date": iso("visit_date"), "patient_sk": F.col("patient_sk").cast("double")})


@query("q_dim_hash_key", """
SELECT o.o_orderkey, c.c_mktsegment AS medical_condition, c.c_nationkey, 32 AS key_digits, true AS same_key
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_dim_hash_key(spark, sf):
    """A dimension under 128-bit keys, checked to be distinct; the fact makes the
    same keys from its own rows and finds its dimension row by them."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("medical_condition"))
    dim = build_dimension(c, ["c_custkey"], ["c_nationkey", "medical_condition"], "customer_sk", key="wide")
    require_distinct_keys(dim, ["c_custkey"], "customer_sk", "customer dimension")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", wide_key("o_custkey").alias("customer_sk"))
    out = o.join(dim, "customer_sk", "left")
    return out.select("o_orderkey", "medical_condition", "c_nationkey", F.length("customer_sk").alias("key_digits"),
                      (F.col("o_custkey") == F.col("c_custkey")).alias("same_key"))


@query("q_impute_median_exact", with_clean("""
m AS (SELECT quantile_disc(price, 0.5) AS med FROM clean_orders WHERE price IS NOT NULL)
SELECT c.k, coalesce(c.price, m.med, 10000.0) AS price FROM clean_orders c LEFT JOIN m ON true"""))
def q_impute_median_exact(spark, sf):
    """All rows are one group."""
    return impute_median_exact(clean_orders(spark, sf), "price", [], 10000.0).select("k", "price")
