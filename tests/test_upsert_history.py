import pytest
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.history import scd_init, scd_merge
from strata.operators.upsert import upsert


def test_null_key_loaded_twice_not_duplicated(spark):
    t = spark.createDataFrame([(None, "x"), ("a", "y")], "k string, v string")
    s = spark.createDataFrame([(None, "x2")], "k string, v string")
    out = upsert(t, s, ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, "x2"), ("a", "y")], key=str)
    strict = upsert(t, s, ["k"], null_safe_keys=False)
    assert strict.count() == 3               # plain '=' never matches null keys


def test_schema_evolves_both_ways(spark):
    t = spark.createDataFrame([(1, "a", "old1"), (2, "b", "old2")], "k int, v string, legacy string")
    s = spark.createDataFrame([(2, "B", "n2"), (3, "C", "n3")], "k int, v string, extra string")
    out = {r.k: r for r in upsert(t, s, ["k"]).collect()}
    assert out[1].extra is None and out[1].legacy == "old1"
    assert out[2].v == "B" and out[2].legacy == "old2" and out[2].extra == "n2"
    assert out[3].legacy is None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=12),
       st.dictionaries(st.integers(0, 9), st.integers(0, 3), max_size=6))
def test_upsert_idempotent(spark, target_rows, src):
    t = spark.createDataFrame(list({k: v for k, v in target_rows}.items()) or [(0, 0)], "k int, v int")
    s = spark.createDataFrame(list(src.items()) or [(0, 0)], "k int, v int")
    once = upsert(t, s, ["k"])
    twice = upsert(once, s, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def _target(spark):
    rows = [("p1", "Cancer", "Aetna"), ("p2", "Asthma", "Cigna"), ("p3", "Obesity", "Medicare"),
            ("p4", None, "Aetna"), ("p5", "Diabetes", "Aetna")]
    df = spark.createDataFrame(rows, "k string, cond string, ins string")
    return scd_init(df, F.lit("2024-01-01"))


def _incoming(spark):
    rows = [("p1", "Cancer", "Cigna"),      # insurance changed -> type 1
            ("p2", "Obesity", "Cigna"),     # condition changed -> type 2
            ("p3", "Asthma", "Aetna"),      # both changed -> type 2 only
            ("p4", "Asthma", "Aetna"),      # null -> value
            ("p6", "Cancer", "Aetna")]      # new key
    return scd_init(spark.createDataFrame(rows, "k string, cond string, ins string"), F.lit("2024-02-01"))


def test_scd_merge_cases(spark):
    out = scd_merge(_target(spark), _incoming(spark), ["k"], tracked=["cond"], type1=["ins"])
    rows = out.collect()
    cur = {r.k: r for r in rows if r._is_current}
    closed = {r.k: r for r in rows if not r._is_current}
    assert cur["p1"].ins == "Cigna" and cur["p1"]._eff_start == dt.date(2024, 1, 1)
    assert closed["p2"]._eff_end == dt.date(2024, 2, 1) and cur["p2"].cond == "Obesity"
    assert closed["p3"].ins == "Medicare" and cur["p3"].ins == "Aetna"
    assert cur["p4"].cond == "Asthma" and "p4" in closed
    assert cur["p5"].cond == "Diabetes" and cur["p6"]._eff_start == dt.date(2024, 2, 1)
    # invariant: at most one current row per key, no overlapping intervals
    assert len([r for r in rows if r._is_current]) == len(cur)
    for k, c in closed.items():
        assert c._eff_end <= cur[k]._eff_start


def test_scd_merge_strict_reproduces_plain_merge(spark):
    out = scd_merge(_target(spark), _incoming(spark), ["k"], tracked=["cond"], type1=["ins"],
                    insert_new_version=False, null_safe_changes=False)
    rows = out.collect()
    cur = {r.k for r in rows if r._is_current}
    assert "p2" not in cur and "p3" not in cur      # closed, no new version
    p4 = [r for r in rows if r.k == "p4"]
    assert len(p4) == 1 and p4[0].cond is None       # null != value never fires
    # re-merging the same batch inserts the closed keys as new rows
    again = scd_merge(out, _incoming(spark), ["k"], tracked=["cond"], type1=["ins"],
                      insert_new_version=False, null_safe_changes=False)
    assert {r.k for r in again.collect() if r._is_current} >= {"p2", "p3"}


def test_scd_history_rows_bypass(spark):
    t = _target(spark)
    first = scd_merge(t, _incoming(spark), ["k"], tracked=["cond"], type1=["ins"])
    second = scd_merge(first, _incoming(spark), ["k"], tracked=["cond"], type1=["ins"])
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


def test_repeated_source_keys_are_refused(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(ValueError, match="2 times"):
        upsert(t, s, ["k"])
    with pytest.raises(ValueError, match="2 times"):
        scd_merge(_target(spark), _incoming(spark).union(_incoming(spark).filter("k = 'p1'")), ["k"], tracked=["cond"])


def test_history_takes_new_columns(spark):
    out = scd_merge(_target(spark), _incoming(spark).withColumn("ward", F.lit("W")), ["k"], tracked=["cond"], type1=["ins"])
    rows = out.collect()
    assert {r.k for r in rows if r.ward == "W"} == {"p2", "p3", "p4", "p6"}     # new versions and new keys
    assert {r.k for r in rows if r.ward is None} == {"p1", "p2", "p3", "p4", "p5"}


def test_merges_read_the_target_once(spark, scratch):
    _target(spark).write.parquet(scratch)
    target = spark.read.parquet(scratch)
    for out in (scd_merge(target, _incoming(spark), ["k"], tracked=["cond"]), upsert(target, _incoming(spark), ["k"])):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
