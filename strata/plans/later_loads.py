"""Catalogue queries over loads that differ from the ones before: files with other
headers, columns whose type drifts, keys that an earlier load brought."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.key_filter import append_new
from ..operators.layout import cluster_by
from ..operators.recluster import depths, file_ranges, recluster
from ..operators.type_profile import profile_load
from ..session import shared_dir
from ..sources.files import split_corrupt
from ..sources.headers import read_mixed
from .catalog import LI_REST, _store, query, table

# fixed values: the segments' layouts, as raw header names
LAYOUTS = {
    "AUTOMOBILE": ["c_custkey", "c_name", "c_nationkey", "c_acctbal"],
    "BUILDING": ["C_Name", "C_Custkey", "c acctbal"],
    "FURNITURE": ["c_acctbal", "c_custkey"],
    "HOUSEHOLD": ["c_nationkey", "note", "c_custkey", "c_name"],
    "MACHINERY": ["c_custkey", "c_name", "c_nationkey", "c_acctbal"],
}


def _held(column: str, clean=lambda x: x.lower().replace(" ", "_")) -> str:
    having = ", ".join(f"'{s}'" for s, names in LAYOUTS.items() if column in [clean(n) for n in names])
    return f"c_mktsegment IN ({having})"


@query("q_sources_mixed_headers", f"""
SELECT c_custkey, CASE WHEN {_held('c_name')} THEN c_name END AS c_name,
       CASE WHEN {_held('c_nationkey')} THEN c_nationkey END::double AS c_nationkey,
       CASE WHEN {_held('c_acctbal')} THEN c_acctbal END AS c_acctbal,
       CASE WHEN {_held('note')} THEN c_mktsegment || '-' || c_custkey END AS note
FROM customer""")
def q_sources_mixed_headers(spark, sf):
    """Customers as a folder of CSV files per segment, every segment with columns,
    order and spelling of its own, read in one plan."""
    c = table(spark, sf, "customer")
    c = c.withColumn("note", F.concat_ws("-", "c_mktsegment", F.col("c_custkey").cast("string")))
    d = shared_dir(spark, "sources", "mixed")
    for segment, names in LAYOUTS.items():
        rows = c.filter(F.col("c_mktsegment") == segment)
        (rows.select(*[F.col(n.lower().replace(" ", "_")).alias(n) for n in names])
             .write.option("header", "true").csv(f"{d}/{segment}"))
    good, _ = split_corrupt(read_mixed(spark, d))
    kinds = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "double", "c_acctbal": "double", "note": "string"}
    return good.select(*[F.col(n).cast(t).alias(n) for n, t in kinds.items()])


_DRIFT_SQL = """
WITH v AS (
  SELECT o_orderkey % 3 = 0 AS late, o_orderkey AS k, unnest(['custkey', 'total', 'day', 'priority', 'status', 'channel']) AS col,
    unnest([CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 21 = 0 THEN 'C' || o_custkey ELSE o_custkey::varchar END,
            CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) ELSE CAST(floor(o_totalprice) AS BIGINT)::varchar END,
            strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 3 = 0 THEN ' 00:00:00' ELSE '' END,
            CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN o_orderpriority || ' (late)' ELSE o_orderpriority END,
            CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END,
            CASE WHEN o_orderkey % 3 = 0 THEN 'true' END]) AS x
  FROM orders),
w AS (
  SELECT * FROM v WHERE (col <> 'status' OR NOT late) AND (col <> 'channel' OR late)),
p AS (
  SELECT late, col, count(*) AS n, count(*) FILTER (x IS NULL) AS nulls, max(length(x)) AS len FROM w GROUP BY late, col),
b AS (
  SELECT coalesce(o.col, n.col) AS col, o.n AS n0, n.n AS n1, o.nulls AS z0, n.nulls AS z1, o.len AS l0, n.len AS l1
  FROM (SELECT * FROM p WHERE NOT late) o FULL JOIN (SELECT * FROM p WHERE late) n ON o.col = n.col)
SELECT col AS "column", 'new' AS kind, NULL AS was, 'boolean' AS is_now FROM b WHERE n0 IS NULL
UNION ALL SELECT col, 'missing', 'string', NULL FROM b WHERE n1 IS NULL
UNION ALL SELECT 'custkey', 'type', 'bigint', 'string' FROM (SELECT DISTINCT 1 FROM w WHERE col = 'custkey' AND x LIKE 'C%')
UNION ALL SELECT 'total', 'type', 'bigint', 'double' FROM (SELECT DISTINCT 1 FROM w WHERE col = 'total' AND x LIKE '%.%')
UNION ALL SELECT 'day', 'type', 'date', 'timestamp' FROM (SELECT DISTINCT 1 FROM w WHERE col = 'day' AND late)
UNION ALL SELECT col, 'length', l0::varchar, l1::varchar FROM b WHERE col IN ('custkey', 'priority') AND l1 > l0
UNION ALL SELECT col, 'nulls', (100 * z0 // n0)::varchar, (100 * z1 // n1)::varchar FROM b WHERE abs(z1 / n1 - z0 / n0) > 0.05"""


@query("q_type_drift", _DRIFT_SQL)
def q_type_drift(spark, sf):
    """Two loads of orders as text.  In the second one customer keys get a letter,
    totals get cents, days get a time, priorities go missing or get longer, the
    status is gone and a flag is new."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    priority = (F.when(k % 6 == 0, F.lit(None)).when(k % 9 == 0, F.concat("o_orderpriority", F.lit(" (late)")))
                 .otherwise(F.col("o_orderpriority")).alias("priority"))
    custkey = F.col("o_custkey").cast("string")
    first = o.filter(k % 3 != 0).select(
        custkey.alias("custkey"), F.floor("o_totalprice").cast("string").alias("total"), day.alias("day"), priority,
        F.col("o_orderstatus").alias("status"))
    second = o.filter(k % 3 == 0).select(
        F.when(k % 21 == 0, F.concat(F.lit("C"), custkey)).otherwise(custkey).alias("custkey"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
        F.concat(day, F.lit(" 00:00:00")).alias("day"), priority, F.lit("true").alias("channel"))
    st = _store(spark)
    profile_load(st, "orders__profile", first)
    return profile_load(st, "orders__profile", second)


_LI = ["l_orderkey", "l_linenumber", *LI_REST, "l_shipdate"]


@query("q_dedup_loads", f"""
WITH loads AS (SELECT *, CASE WHEN year(l_shipdate) < 1997 THEN 1 WHEN year(l_shipdate) < 1999 THEN 2 ELSE 3 END AS load FROM lineitem)
SELECT {', '.join(_LI)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY load, l_shipdate DESC NULLS LAST,
    {', '.join(c + ' DESC NULLS LAST' for c in LI_REST)}) AS rn FROM loads) WHERE rn = 1""")
def q_dedup_loads(spark, sf):
    """Line items in three loads by ship date; a key that an earlier load brought
    is not taken again, and only possible repeats meet the table."""
    li = table(spark, sf, "lineitem").select(*_LI)
    year, st = F.year("l_shipdate"), _store(spark)
    for load in (year < 1997, (year >= 1997) & (year < 1999), year >= 1999):
        n = append_new(st, "lineitem", li.filter(load), ["l_orderkey", "l_linenumber"], ["l_shipdate"], F.col("l_orderkey") % 8)
        if not n["repeats"] <= n["possible"] <= n["keys"]:
            raise AssertionError(str(n))
    return st.read("lineitem").select(*_LI)


@query("q_cluster_incremental", f"SELECT {', '.join(_LI)} FROM lineitem")
def q_cluster_incremental(spark, sf):
    """A clustered table of line items takes three loads of late shipments in no
    order; only files whose ranges they overlap are written again."""
    li, st, by = table(spark, sf, "lineitem").select(*_LI), _store(spark), ["l_shipdate", "l_partkey"]
    late = F.coalesce(F.col("l_shipdate") >= "1998-01-01", F.lit(False))
    st.publish(li.filter(~late), "lineitem")
    st.rewrite("lineitem", lambda df, files: cluster_by(df, by, max(files, 16)))
    aim = st.size("lineitem") // 16 + 1
    for load in range(3):
        st.append(li.filter(late & (F.col("l_orderkey") % 3 == load)), "lineitem")
    before = file_ranges(st, "lineitem", by)
    n = recluster(st, "lineitem", by, file_bytes=aim)
    after = file_ranges(st, "lineitem", by)
    deepest = max((d for _, _, d in depths(after)), default=0)
    if len(set(before) - set(after)) != n["rewritten"] or n["rewritten"] and deepest >= n["depth"]:
        raise AssertionError(f"{n}, depth {deepest} after")
    return st.read("lineitem")
