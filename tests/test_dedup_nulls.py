from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key
from strata.operators.nulls import null_ratio, split_by_null_ratio, split_critical

rows_st = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)),
                             st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                   min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(rows_st)
def test_latest_per_key_equals_window_form(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v string")
    got = sorted(latest_per_key(df, ["k"], ["t"]).collect())
    w = Window.partitionBy("k").orderBy(F.col("t").desc_nulls_last(), F.col("v").desc_nulls_last())
    want = sorted(df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect())
    assert got == want


def test_null_ratio_threshold_boundary(spark):
    # 10 columns: 3 blanks = exactly 0.30 (kept), 4 blanks = 0.40 (quarantined)
    cols = [f"c{i}" for i in range(10)]
    r1 = tuple([None, "", " "] + ["x"] * 7)
    r2 = tuple([None, "", " ", None] + ["x"] * 6)
    df = spark.createDataFrame([r1, r2], ", ".join(f"{c} string" for c in cols))
    clean, quar = split_by_null_ratio(df, 0.30, cols)
    assert clean.count() == 1 and quar.count() == 1
    q = quar.first()
    assert q["_null_count"] == 4 and q["quarantine_reason"] == "null_pct_exceeds_0.3"
    assert "_null_pct" not in clean.columns
    assert null_ratio(df, cols).agg(F.max("_null_pct")).first()[0] == 0.4


def test_split_conservation(spark, ):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("x")).alias("a"),
                                 F.when(F.col("id") % 5 == 0, None).otherwise(F.lit(1)).alias("b"))
    kept, rej = split_critical(df, ["a", "b"])
    assert kept.count() + rej.count() == 100
    assert rej.filter("quarantine_reason = 'critical_null'").count() == rej.count()
