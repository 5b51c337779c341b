import random

import pytest
from pyspark.sql import functions as F

from strata.operators.layout import cluster_by
from strata.operators.recluster import depths, file_ranges, recluster, too_deep
from strata.sources.tables import TableStore


def test_depths_and_choice_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        ranges = {}
        for i in range(rng.randrange(12)):
            lo = rng.randrange(20)
            ranges[str(i)] = (lo, lo + rng.choice([0, 0, 1, 3, 9]))
        over = {at: sum(lo < at + .5 < hi for lo, hi in ranges.values()) for at in range(40)}
        for a, b, n in depths(ranges):
            assert all(over[at] == n for at in range(a, b))
        for limit in (1, 2, 3):
            want = {f for f, (lo, hi) in ranges.items() if any(over[at] > limit for at in range(lo, hi))}
            assert too_deep(ranges, limit) == want


def rows_of(spark, n, start=0, low=0, high=1000, seed=1):
    x = low + F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(high - low)).cast("int")
    day = F.date_add(F.lit("2020-01-01").cast("date"), x)
    return spark.range(start, start + n, 1, 2).select(
        "id", F.when((F.col("id") % 50 != 0) | (F.col("id") >= 10_000), x).alias("x"), day.alias("day"), F.concat(F.lit("n'"), x.cast("string")).alias("name"),
        (x / 3).alias("ratio"))


@pytest.mark.parametrize("by", [["x"], ["day", "ratio"], ["name", "x"]])
def test_only_overlapping_files_are_written_again(spark, scratch, by):
    st = TableStore(spark, scratch)
    st.publish(cluster_by(rows_of(spark, 4000), by, 10), "t")
    first = file_ranges(st, "t", by)
    assert recluster(st, "t", by)["rewritten"] == 0                 # clustered already
    st.append(rows_of(spark, 900, 10_000, 900, 1000, seed=2), "t")  # late rows, in no order
    st.append(rows_of(spark, 900, 20_000, 900, 1000, seed=3), "t")
    want = sorted(map(str, st.read("t").collect()))
    got = recluster(st, "t", by, depth=1, file_bytes=st.size("t") // 10)
    assert 0 < got["rewritten"] < got["files"] and got["depth"] > 1
    after = file_ranges(st, "t", by)
    if by == ["x"]:
        assert len(set(first) & set(after)) >= 7                    # untouched files keep their names
        assert max(n for _, _, n in depths(after)) <= 1
    assert sorted(map(str, st.read("t").collect())) == want
    assert max(n for _, _, n in depths(after)) < got["depth"]


def test_hot_key_nulls_and_repeats(spark, scratch):
    st = TableStore(spark, scratch)
    hot = spark.range(0, 3000, 1, 6).select(F.lit(7).alias("x"), F.lit(None).cast("string").alias("s"))
    st.publish(hot, "t")
    assert recluster(st, "t", ["x", "s"]) == {"files": 6, "rewritten": 0, "depth": 0}
    st.append(hot, "t")
    assert recluster(st, "t", ["x", "s"])["rewritten"] == 0
    assert st.read("t").count() == 6000


def test_columns_of_a_new_curve_and_clashing_names(spark, scratch):
    st = TableStore(spark, scratch)
    df = rows_of(spark, 500).withColumn("__z", F.lit("mine")).withColumn("file", F.lit("f")).withColumn("z", F.lit(1))
    with pytest.raises(ValueError):
        recluster(st, "t", ["x"])
    st.publish(df.repartition(5), "t")
    assert recluster(st, "t", ["x"], depth=1)["rewritten"] == 5
    assert recluster(st, "t", ["name"], depth=1, file_bytes=1 << 10)["rewritten"] >= 0      # another curve is sampled anew
    assert sorted(map(str, st.read("t").collect())) == sorted(map(str, df.collect()))
    st.publish(df.limit(0), "e")
    assert recluster(st, "e", ["x"])["rewritten"] == 0
    st.publish(df, "p", partition_by=["x"])
    with pytest.raises(ValueError):
        recluster(st, "p", ["id"])
