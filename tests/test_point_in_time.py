import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strata.functions import wide_key
from strata.operators.asof import as_of
from strata.operators.impute import impute_median_exact
from strata.operators.select import exact_quantile
from strata.operators.star import build_dimension, require_distinct_keys
from strata.streaming.incremental import incremental_batch, read_watermark, save_watermark


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n) if n is not None else None


VERSIONS = "k string, part int, _eff_start date, _eff_end date, name string"
FACTS = "id int, k string, part int, t date"


def brute(facts, versions):
    """Every version of every fact's key, one by one."""
    out = []
    for i, k, p, t in facts:
        live = [v for v in versions if (v[0], v[1]) == (k, p) and t is not None and v[2] <= t]
        last = max(live, key=lambda v: (v[2], v[3] is None, v[3] or day(0)), default=None)
        out.append((i, last[4] if last and (last[3] is None or t < last[3]) else None))
    return sorted(out)


@pytest.mark.parametrize("period", ["month", "day", "year"])
def test_as_of_against_every_pair(spark, period):
    r = random.Random(7)
    versions, facts = [], []
    for k in ("a", "b", None, ""):
        for p in (1, None):
            at = r.randint(-200, 0)
            for n in range(r.randint(0, 12)):
                end = at + r.choice([0, 1, 30, 90])
                versions.append((k, p, day(at), day(end) if n % 5 else day(end + 3), f"{k}{p}v{n}"))
                at = end + r.choice([0, 0, 15])
            versions.append((k, p, day(at), None, f"{k}{p}open"))
    for i in range(900):
        facts.append((i, r.choice(["a", "a", "b", None, "", "zz"]), r.choice([1, None]), day(r.choice([None, *range(-300, 700)]))))
    versions = [v for v in versions if v[3] is None or v[2] <= v[3]]
    clean = {}
    for v in versions:      # overlapping versions are not asked for here
        clean[v[:3]] = max([v, *([clean[v[:3]]] if v[:3] in clean else [])], key=lambda v: (v[3] is None, v[3] or day(0)))
    versions = list(clean.values())
    f, v = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    out = as_of(f, v, [("k", "k"), ("part", "part")], "t", {"name": "name", "since": "_eff_start"}, period=period)
    assert out.columns == ["id", "k", "part", "t", "name", "since"]
    assert sorted((x["id"], x["name"]) for x in out.collect()) == brute(facts, versions)


def test_as_of_hot_key_repeats_and_timestamps(spark):
    v = spark.createDataFrame([("h", "2024-01-01 00:00:00", "2024-01-02 12:00:00", "one"), ("h", "2024-01-02 12:00:00", None, "two")],
                              "k string, s string, e string, name string")
    v = v.select("k", F.to_timestamp("s").alias("s"), F.to_timestamp("e").alias("e"), "name")
    f = spark.range(5000).select(F.lit("h").alias("k"), F.to_timestamp(F.when(F.col("id") % 2 == 0, "2024-01-02 11:59:59").otherwise("2024-01-02 12:00:00")).alias("t"))
    out = as_of(f, v, [("k", "k")], "t", {"name": "name"}, start="s", end="e").groupBy("name").count().collect()
    assert {r["name"]: r["count"] for r in out} == {"one": 2500, "two": 2500}


def test_as_of_empty_sides_and_clashing_names(spark):
    f, v = spark.createDataFrame([(1, "a", 1, day(3))], FACTS), spark.createDataFrame([], VERSIONS)
    assert [r["name"] for r in as_of(f, v, [("k", "k")], "t", {"name": "name"}).collect()] == [None]
    assert as_of(f.filter("id = 0"), v, [("k", "k")], "t", {"name": "name"}).count() == 0
    with pytest.raises(ValueError, match="already have"):
        as_of(f, v, [("k", "k")], "t", {"k": "name"})


def test_wide_keys(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", "a"), ("a", ""), ("ab", "c"), ("a", "bc")], "x string, y string")
    keys = [r["k"] for r in df.select(wide_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == 6 and all(len(k) == 32 for k in keys)
    many = spark.range(20_000).select(wide_key("id").alias("k"))
    halves = many.select(F.substring("k", 1, 16).alias("a"), F.substring("k", 17, 16).alias("b"))
    assert halves.agg(F.countDistinct("a"), F.countDistinct("b")).first() == (20_000, 20_000)
    assert halves.filter("a = b").isEmpty()


def test_distinct_keys_tell_repeats_from_meetings(spark):
    half = "0" * 16
    ok = spark.createDataFrame([(1, half + "1" * 16), (2, half + "2" * 16)], "n int, sk string")    # equal halves only
    require_distinct_keys(ok, ["n"], "sk", "table")
    with pytest.raises(ValueError, match="holds key .1. 2 times"):
        require_distinct_keys(ok.union(ok.filter("n = 1")), ["n"], "sk", "table")
    with pytest.raises(ValueError, match="have the same sk"):
        require_distinct_keys(ok.union(spark.createDataFrame([(3, half + "1" * 16)], "n int, sk string")), ["n"], "sk", "table")
    dim = build_dimension(spark.range(50).withColumnRenamed("id", "n"), ["n"], [], "sk", key="wide")
    require_distinct_keys(dim, ["n"], "sk", "dimension")


@pytest.mark.parametrize("limit", [1, 3, 4096])
@pytest.mark.parametrize("p", [0.5, 0.01, 0.9])
def test_exact_quantile_against_sorting(spark, limit, p):
    r = random.Random(11)
    rows = [(g, r.choice([None, float("inf"), r.gauss(0, 1), r.lognormvariate(0, 8), 3.0])) for g in ("hot", "hot", "hot", "b", None) for _ in range(300)]
    rows += [("nulls", None), ("one", -1.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {x["g0"]: x["q"] for x in exact_quantile(df, "v", [F.col("g")], "q", p, limit=limit).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        s = sorted(v for h, v in rows if h == g and v is not None)
        if s:
            want[g] = s[max(0, -(-len(s) * int(p * 100) // 100) - 1)]
    assert got == want


def test_exact_quantile_of_one_large_group(spark):
    df = spark.range(100_001).select((F.col("id") * 7919 % 100_003).alias("v"))
    got = exact_quantile(df, "v", [], "q", limit=50).collect()
    values = sorted(i * 7919 % 100_003 for i in range(100_001))
    assert [r["q"] for r in got] == [values[50_000]]
    assert exact_quantile(df.filter("v < 0"), "v", [], "q").collect() == []


def test_median_fill(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 9), ("a", None), ("b", None), (None, 4), (None, None)], "g string, v int")
    got = sorted(impute_median_exact(df, "v", ["g"], -1).collect(), key=str)
    assert sorted((r["g"] or "", r["v"]) for r in got) == [("", 4), ("", 4), ("a", 1), ("a", 2), ("a", 2), ("a", 9), ("b", -1)]
    assert impute_median_exact(df, "v", []).filter("v is null").isEmpty()


def test_incremental_filter_reaches_the_scan(spark, scratch, capsys):
    data = scratch + "/events"
    spark.range(100).select("id", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id as int))").alias("ts")).write.parquet(data)
    df = spark.read.parquet(data)
    marks = scratch + "/marks"
    save_watermark(df.filter("id < 40"), "ts", marks)
    later = incremental_batch(df, "ts", read_watermark(spark, marks))
    assert sorted(r["id"] for r in later.collect()) == list(range(40, 100))
    later.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert plan.count("Hosting Expression = Subquery") <= 1         # the mark is read once
    assert incremental_batch(df, "ts", read_watermark(spark, marks, "other")).count() == 100
