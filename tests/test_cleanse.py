import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (band, canonical, is_blank, null_out_of_range, parse_date, title_case,
                              try_double, try_int)


def test_ages_cast_and_range(spark):
    # fixture: sentinel and malformed ages, one row each
    vals = ["-5", "0", "1", "120", "121", "130", "999", "abc", "45.7", None, " 12 "]
    df = spark.createDataFrame([(v,) for v in vals], "age string")
    out = df.select(null_out_of_range(try_int("age"), lo=0, hi=120).alias("a")).collect()
    assert [r.a for r in out] == [None, None, 1, 120, None, None, None, None, None, None, 12]


def test_negative_amount_nulled(spark):
    df = spark.createDataFrame([("-1.5",), ("0",), ("12.25",), ("n/a",)], "b string")
    out = df.select(null_out_of_range(try_double("b"), lo=0, lo_inclusive=True, hi=None).alias("b"))
    assert [r.b for r in out.collect()] == [None, 0.0, 12.25, None]


def test_parse_date_strict(spark):
    vals = ["2019-02-30", "2019/01/01", "2019-1-5", None, "2019-01-05"]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    out = [r.d for r in df.select(parse_date("d").alias("d")).collect()]
    assert out == [None, None, None, None, dt.date(2019, 1, 5)]


def test_title_case_then_dedup_key(spark):
    df = spark.createDataFrame([("cHaRlEs rOdGeRs",), ("Charles Rodgers",)], "n string")
    out = df.select(title_case("n").alias("n")).distinct().collect()
    assert [r.n for r in out] == ["Charles Rodgers"]


def test_canonical_fold_and_exact(spark):
    df = spark.createDataFrame([("cancer",), ("CANCER",), ("flu",), (None,), ("ab+",), ("AB+",)], "v string")
    out = df.select(canonical("v", ["Cancer"]).alias("c"),
                    canonical("v", ["AB+"], fold=None).alias("b")).collect()
    assert [r.c for r in out] == ["Cancer", "Cancer", None, None, None, None]
    assert [r.b for r in out] == [None, None, None, None, None, "AB+"]


def test_band_null_gets_unknown_not_last_label(spark):
    df = spark.createDataFrame([(None,), (10,), (17,), (18,), (79,), (80,)], "a int")
    labels = ["Paediatric", "Young Adult", "Middle Aged", "Senior", "Elderly"]
    out = df.select(band("a", [18, 40, 60, 80], labels).alias("g"),
                    band("a", [18, 40, 60, 80], labels, null_label=None).alias("ref")).collect()
    assert [r.g for r in out] == ["Unknown", "Paediatric", "Paediatric", "Young Adult", "Senior", "Elderly"]
    assert out[0].ref == "Elderly"  # a bare when-chain sends null to the last label


def test_is_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "v string")
    assert [r.b for r in df.select(is_blank("v").alias("b")).collect()] == [True, True, True, False]


def test_restricted_rows_and_public_view(spark):
    from strata.functions import mask, restricted_flag
    from strata.operators.privacy import public_view
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "No Insurance"), ("d", "Aetna")],
                               "name string, ins string")
    flagged = df.withColumn("_is_restricted", restricted_flag("ins")).withColumn("name_masked", mask("name"))
    assert [r._is_restricted for r in flagged.orderBy("name").collect()] == [True, True, True, False]
    pub = public_view(flagged, drop=["name"]).collect()
    assert len(pub) == 1 and "name" not in pub[0].asDict() and "_is_restricted" not in pub[0].asDict()
    assert len(pub[0].name_masked) == 64
