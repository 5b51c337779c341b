import bisect
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators.layout import range_bounds, spread, zorder_key


def rows(spark, n=900):
    x = F.pmod(F.xxhash64("id"), F.lit(300)).cast("int")
    x = F.when(F.col("id") % 40 != 0, x)
    return spark.range(n).select(
        "id", x.alias("x"), F.date_add(F.lit("2020-01-01").cast("date"), x).alias("day"), F.concat(F.lit("é'"), x.cast("string")).alias("name"),
        (x / 7).alias("ratio"), x.cast("decimal(12,2)").alias("price"), (x % 2 == 0).alias("flag"))


@pytest.mark.parametrize("by", [["x"], ["x", "day"], ["name", "ratio", "price"], ["flag", "x"]])
@pytest.mark.parametrize("bits", [1, 3, 6])
def test_key_counts_the_bounds_up_to_a_value(spark, by, bits):
    df = rows(spark)
    bounds = range_bounds(df, by, bits)
    for row in df.select(*by, zorder_key(df, by, bits, bounds).alias("z")).collect():
        places = [0 if row[c] is None else bisect.bisect_right(cuts, row[c]) for c, cuts in zip(by, bounds)]
        want = 0
        for i, p in enumerate(places):
            want |= spread(p, bits, len(by), i)
        assert row["z"] == want


def test_columns_without_bounds_and_more_bounds_than_bits(spark):
    df = rows(spark)
    assert df.select(zorder_key(df, ["x", "name"], 6, [[], []]).alias("z")).distinct().collect() == [(0,)]
    cuts = [[Decimal(i) for i in range(0, 290, 3)]]
    for row in df.select("price", zorder_key(df, ["price"], 6, cuts).alias("z")).collect():
        assert row["z"] == (0 if row["price"] is None else spread(bisect.bisect_right(cuts[0], row["price"]), 6, 1, 0))


def test_compiled_method_is_small_enough_for_machine_code(spark):
    """Methods above 8,000 bytes are interpreted by the JVM."""
    df = rows(spark)
    by = ["x", "day"]
    plan = df.select("id", zorder_key(df, by, 6, range_bounds(df, by, 6)).alias("z"))._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000


def test_staged_frames_are_read_by_column(spark):
    """A job that needs one column of a staged frame reads that column alone, and
    the frame is cut from what made it."""
    from strata.session import stage_columns
    df = rows(spark).withColumn("r", F.rand())
    kept = stage_columns(df)
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, kept.collect())) == sorted(map(str, kept.collect()))
    plan = kept.agg(F.sum("id"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan
    assert sorted(map(str, kept.drop("r").collect())) == sorted(map(str, df.drop("r").collect()))
