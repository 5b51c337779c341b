"""The dirty-orders view: deterministic defects derived from the order key.

The driver tables contain no nulls or bad values, so cleansing, imputation
and quality operators are exercised on a view that plants defects as a pure
function of ``k = o_orderkey``.  The Spark form and the SQL form below are the
same definition; per column the first matching case wins.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the defect rules shared by the Spark view and its SQL twin
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


def dirty_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    date_txt = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    return orders.select(
        k.alias("k"),
        F.col("o_custkey"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .when(k % 29 == 0, F.lit(""))
         .when(k % 31 == 0, F.lit("n/a"))
         .when(k % 17 == 0, F.concat(F.lit("-"), price))
         .otherwise(price).alias("price_txt"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(k % 19 == 0, F.lit("bad"))
         .when(k % 5 == 0, F.lower(F.col("o_orderpriority")))
         .otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 23 == 0, F.regexp_replace(date_txt, "-", "/"))
         .when(k % 41 == 0, F.lit(None).cast("string"))
         .otherwise(date_txt).alias("date_txt"),
    )


DIRTY_ORDERS_SQL = """
dirty_orders AS (
  SELECT o_orderkey AS k, o_custkey,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         WHEN o_orderkey % 29 = 0 THEN ''
         WHEN o_orderkey % 31 = 0 THEN 'n/a'
         WHEN o_orderkey % 17 = 0 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_txt,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
         WHEN o_orderkey % 19 = 0 THEN 'bad'
         WHEN o_orderkey % 5 = 0 THEN lower(o_orderpriority)
         ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 23 = 0 THEN replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '/')
         WHEN o_orderkey % 41 = 0 THEN NULL
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_txt
  FROM orders
)"""
