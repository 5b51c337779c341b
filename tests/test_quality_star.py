import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions import hash_key
from strata.operators.quality import (GateRule, enforce_gate, gate_report, grade, quality_metrics,
                                      quality_score)
from strata.operators.star import attach_keys, build_dimension, dense_key


def test_dense_key_equals_row_number(spark):
    df = spark.range(0, 5000, 7).select((F.col("id") * 13 % 5001).alias("k"))
    want = df.withColumn("sk", F.row_number().over(Window.orderBy("k")) - 1).collect()
    got = dense_key(df, ["k"], "sk").collect()
    assert sorted((r.k, r.sk) for r in got) == sorted((r.k, r.sk) for r in want)


def test_extended_dimension_keeps_keys(spark):
    from strata.operators.star import extend_dimension
    schema = "k int, name string"
    old = build_dimension(spark.createDataFrame([(2, "b"), (5, "e"), (None, "n")], schema), ["k"], ["name"], "sk")
    before = {r.k: r.sk for r in old.collect()}
    out = {r.k: r for r in extend_dimension(old, spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (None, "N")], schema), ["k"], "sk").collect()}
    assert {k: out[k].sk for k in before} == before
    assert (out[1].sk, out[3].sk) == (3, 4)
    assert (out[2].name, out[5].name, out[None].name) == ("B", "e", "N")


def test_score_needs_all_its_terms(spark):
    from strata.operators.quality import quality_score
    with pytest.raises(ValueError, match="score needs column"):
        quality_score(spark.createDataFrame([(1.0,)], "quarantine_pct double"))


def test_hash_key_tags_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    ks = [r.h for r in df.select(hash_key("x", "y").alias("h")).collect()]
    assert ks[0] != ks[1]
    assert df.select(F.xxhash64("x", "y").alias("h")).distinct().count() == 1  # the trap


def test_fact_fanout_detected(spark):
    dim = spark.createDataFrame([("p1", "Cancer", 0), ("p1", "Asthma", 1)], "pid string, cond string, sk long")
    fact = spark.createDataFrame([("p1", 10.0)], "pid string, amt double")
    with pytest.raises(ValueError):
        attach_keys(fact, [(dim, ["pid"], ["pid"], "sk")], check_fanout=True)
    dim_ok = build_dimension(dim, ["pid", "cond"], [], "sk2", key="hash")
    assert dim_ok.count() == 2


def _final(spark):
    rows = [(1, "a", 10.0, 30), (2, "b", -1.0, 200), (3, None, 5.0, 40), (3, None, 6.0, 41)]
    return spark.createDataFrame(rows, "k int, m string, amt double, age int")


def test_score_bounds_and_grade(spark):
    f = _final(spark)
    m = quality_metrics(f, processed=f, quarantined=f.limit(1), keys=["k"], null_cols=["m"],
                        range_rules={"age": (F.col("age") <= 0) | (F.col("age") > 120),
                                     "billing": F.col("amt") < 0},
                        mask_cols=["m"])
    s = quality_score(m, rename={"age_pct": "age_pct", "billing_pct": "billing_pct"}).first()
    assert 0 <= s.score <= 100
    assert s.dup_count == 1 and s.age_violations == 1 and s.unmasked == 2
    g = spark.createDataFrame([(100.0,), (95.0,), (94.9,), (80.0,), (70.0,), (0.0,)], "s double")
    assert [r.g for r in g.select(grade(F.col("s")).alias("g")).collect()] == ["A+", "A+", "A", "B", "C", "D"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(-5, 150))), min_size=1, max_size=20))
def test_score_always_in_range(spark, rows):
    f = spark.createDataFrame(rows, "k int, age int")
    m = quality_metrics(f, processed=f, quarantined=f, keys=["k"], null_cols=["age"],
                        range_rules={"age": (F.col("age") <= 0) | (F.col("age") > 120), "billing": F.col("k") < 0})
    s = quality_score(m).first().score
    assert 0.0 <= s <= 100.0


def test_gate_raises_listing_all(spark):
    f = _final(spark)
    rules = [GateRule("non_empty", kind="empty"), GateRule("no_nulls_m", F.col("m").isNull()),
             GateRule("no_negative", F.col("amt") < 0), GateRule("unique", kind="dup_keys", keys=["k"])]
    rep = gate_report(f, rules)
    got = {r.rule: r.failures for r in rep.collect()}
    assert got == {"non_empty": 0, "no_nulls_m": 2, "no_negative": 1, "unique": 1}
    with pytest.raises(ValueError, match="no_nulls_m.*no_negative.*unique"):
        enforce_gate(rep)
    enforce_gate(gate_report(f.filter("k = 1"), rules))  # passes silently
