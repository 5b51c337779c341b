import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.key_filter import BLOCK, KeyFilter, append_new
from strata.operators.type_profile import COUNTS, column_profile, merge_profiles, profile_load, type_drift
from strata.sources.files import IngestError, split_corrupt
from strata.sources.headers import data_files, file_headers, read_mixed
from strata.sources.tables import PART, TableStore


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "wt", encoding="utf-8", newline="") as f:
        f.write(text)


def local(path):
    return path.removeprefix("file:")


# ------------------------------------------------------------ unlike headers
def test_files_with_unlike_headers(spark, scratch):
    d = local(scratch) + "/mixed"
    put(f"{d}/a.csv", "Id,Unit Price\n1,2.5\n2,\n")
    put(f"{d}/sub/b.csv", "﻿unit_price,id,note\n7,3,\"x, y\"\n8,4\n9,5,z,extra\n")
    put(f"{d}/c[1].csv", "ID\n6\n")
    put(f"{d}/d.csv.gz", "id,unit price\n10,11\n")
    put(f"{d}/e.csv", "")
    put(f"{d}/f.csv", "a b,a_b\n1,2\n")
    put(f"{d}/g.csv", "id,note\n")
    put(f"{d}/_SUCCESS", "")
    put(f"{d}/.hidden/h.csv", "id\n99\n")
    refused = {}
    df = read_mixed(spark, d, on_reject=lambda f, why: refused.__setitem__(os.path.basename(f), why))
    assert df.columns == ["id", "unit_price", "note", "_corrupt_record", "source_file"]
    good, bad = split_corrupt(df)
    rows = {r["id"]: (r["unit_price"], r["note"], os.path.basename(r["source_file"])) for r in good.collect()}
    assert {k: v[:2] for k, v in rows.items()} == {"1": ("2.5", None), "2": (None, None), "3": ("7", "x, y"), "6": (None, None), "10": ("11", None)}
    assert rows["3"][2] == "b.csv" and rows["10"][2] == "d.csv.gz"
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["8,4", "9,5,z,extra"]
    assert refused["e.csv"] == "no header" and "same name" in refused["f.csv"] and len(refused) == 2
    assert df.select("id").count() == 7


def test_equal_headers_are_one_scan(spark, scratch):
    d = local(scratch) + "/same"
    for i in range(20):
        put(f"{d}/{i}.csv", f"a,b\n{i},x\n" if i % 2 else f"b,a\nx,{i}\n")
    assert len(data_files(spark, d)) == 20 and {tuple(h) for h in file_headers(spark, d).values()} == {("a", "b"), ("b", "a")}
    df = read_mixed(spark, d)
    assert df._jdf.queryExecution().analyzed().toString().count("Relation") == 2
    assert sorted(int(r["a"]) for r in df.select("a", "b").filter("b = 'x'").collect()) == list(range(20))


def test_folder_without_headers(spark, scratch):
    d = local(scratch) + "/none"
    put(f"{d}/a.csv", "")
    with pytest.raises(IngestError):
        read_mixed(spark, d)


# ------------------------------------------------------------ type drift
def profile_of(spark, values):
    return column_profile(spark.createDataFrame([(v,) for v in values], "x string"))


def kinds(spark, old, new, share=1.0):
    return {r["kind"]: (r["was"], r["is_now"]) for r in type_drift(profile_of(spark, old), profile_of(spark, new), share).collect()}


def test_lattice(spark):
    assert kinds(spark, ["1", "-2"], ["3"]) == {}
    assert kinds(spark, ["1"], ["2.5", ".5", "1e9"]) == {"type": ("bigint", "double")}
    assert kinds(spark, ["2.5"], ["1"]) == {}
    assert kinds(spark, ["2020-01-01"], ["2020-01-01 10:00:00.5"]) == {"type": ("date", "timestamp")}
    assert kinds(spark, ["true"], ["1"]) == {"type": ("boolean", "string")}
    assert kinds(spark, ["1"], ["2020-01-01"]) == {"type": ("bigint", "string"), "length": ("1", "10")}
    assert kinds(spark, [None, " "], ["5"]) == {}                   # no value yet: any type fits
    assert kinds(spark, ["5"], [None, ""]) == {}
    assert kinds(spark, ["a", None, None, "b"], ["a"], 0.4) == {"nulls": ("50", "0")}
    assert kinds(spark, ["a", None, None, "b"], ["a"], 0.5) == {}


def test_profiles_add_up(spark):
    r = random.Random(5)
    values = [r.choice([None, "", "1", "2.5", "x y", "2020-02-02", "true", "é" * r.randint(1, 9)]) for _ in range(200)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "`a.b` string, column int")
    whole = column_profile(df)
    parts = merge_profiles(column_profile(df.filter("column < 77")), column_profile(df.filter("column >= 77")))
    cols = ["column", *COUNTS, "min_len", "max_len"]
    assert sorted(map(tuple, whole.select(*cols).collect())) == sorted(map(tuple, parts.select(*cols).collect()))
    assert {r["column"] for r in whole.collect()} == {"a.b", "column"}
    assert merge_profiles(whole, column_profile(df.limit(0))).count() == 2


def test_profile_of_loads(spark, scratch):
    st = TableStore(spark, scratch + "/profiles")
    assert profile_load(st, "p", spark.createDataFrame([("1", "a")], "x string, y string")).count() == 0
    got = profile_load(st, "p", spark.createDataFrame([("1.5", True)], "x string, z boolean"))
    assert {(r["column"], r["kind"], r["was"], r["is_now"]) for r in got.collect()} == {
        ("x", "type", "bigint", "double"), ("y", "missing", "string", None), ("z", "new", None, "boolean")}
    again = profile_load(st, "p", spark.createDataFrame([("7", "b", False)], "x string, y string, z boolean"))
    assert again.count() == 0                                        # doubles hold integers, nothing else moved


# ------------------------------------------------------------ duplicates across loads
ROWS = "k int, s string, v int"


def first_seen(loads):
    out = {}
    for rows in loads:
        best = {}
        for k, s, v in rows:
            if (k, s) not in best or v > best[k, s]:
                best[k, s] = v
        for key, v in best.items():
            out.setdefault(key, v)
    return sorted(((*k, v) for k, v in out.items()), key=str)


@pytest.mark.parametrize("blocks", [1, 64])
def test_loads_against_brute_force(spark, scratch, blocks):
    r = random.Random(blocks)
    st = TableStore(spark, f"{scratch}/dedup{blocks}")
    loads = [[(r.choice([None, *range(60)]), r.choice([None, "a", "b"]), r.randint(0, 9)) for _ in range(n)] for n in (80, 0, 120, 90)]
    loads.append([(7, "a", i) for i in range(500)])                  # one hot key
    for i, rows in enumerate(loads):
        n = append_new(st, "t", spark.createDataFrame(rows, ROWS), ["k", "s"], ["v"], F.col("k") % 4, blocks)
        assert n["repeats"] <= n["possible"] <= n["keys"] == len({x[:2] for x in rows})
        want = first_seen(loads[:i + 1])
        assert sorted((tuple(x) for x in st.read("t").select("k", "s", "v").collect()), key=str) == want
    assert append_new(st, "t", spark.createDataFrame(loads[2], ROWS), ["k", "s"], ["v"], F.col("k") % 4, blocks)["repeats"] == len({x[:2] for x in loads[2]})


def test_filter_keeps_new_keys_from_the_join(spark, scratch):
    st = TableStore(spark, scratch + "/few")
    ids = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("s"), F.lit(1).alias("v"))
    append_new(st, "t", ids.filter("k < 1000"), ["k"], ["v"], F.lit(0), 4)
    n = append_new(st, "t", ids.filter("k >= 900"), ["k"], ["v"], F.lit(0), 4)
    assert n["keys"] == 2100 and n["repeats"] == 100 and n["possible"] < 100 + 2000 * 1000 // (4 * BLOCK) * 3
    assert st.read("t").count() == 3000


def test_bits_without_rows_lose_nothing(spark, scratch):
    st = TableStore(spark, scratch + "/crash")
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], ROWS)
    append_new(st, "t", df.filter("k = 1"), ["k"], ["v"], F.lit(0), 2)
    KeyFilter(st, "t", ["k"], 2).add(df.withColumn(PART, F.lit(0)))   # a load that failed after its bits
    assert append_new(st, "t", df, ["k"], ["v"], F.lit(0), 2) == {"keys": 2, "possible": 2, "repeats": 1}
    assert st.read("t").count() == 2
