"""One key holding a third of all rows: results stay whole and exact, and the
plans reduce the hot key map-side instead of sending it to one task."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key
from strata.operators.impute import impute_median, impute_mode
from strata.operators.quality import dup_report
from strata.operators.upsert import upsert

N = 30_000


def _skewed(spark):
    # key 0 holds a third of the rows; the rest are spread over 2,000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 5).cast("string")).alias("v"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_hot_key(spark):
    df = _skewed(spark)
    out = latest_per_key(df, ["k"], ["t"])
    assert out.count() == 2001
    hot = out.filter("k = 0").first()
    assert hot.t == max(i for i in range(N) if i % 3 == 0)
    assert "partial_max" in _plan(out)          # combined before the shuffle
    w = Window.partitionBy("k").orderBy(F.col("t").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert out.exceptAll(ref).count() == 0 and ref.exceptAll(out).count() == 0


def test_impute_hot_group(spark):
    df = _skewed(spark)
    filled = impute_mode(df, "v", ["k"], "none")
    assert filled.count() == N and filled.filter(F.col("v").isNull()).count() == 0
    med = impute_median(df.withColumn("x", F.when(F.col("t") % 4 == 0, None).otherwise(F.col("t"))),
                        "x", ["k"], -1)
    assert med.count() == N and med.filter("x IS NULL").count() == 0


def test_dup_report_hot_key(spark):
    r = dup_report(_skewed(spark), ["k"]).first()
    assert r.total_current == N and r.distinct_keys == 2001 and r.dup_count == N - 2001


def test_upsert_hot_target_key_count(spark):
    t = _skewed(spark).select("t", "k")
    s = spark.range(0, N, 10).select(F.col("id").alias("t"), F.lit(-1).cast("long").alias("k"))
    out = upsert(t, s, ["t"])
    assert out.count() == N and out.filter("k = -1").count() == N // 10
