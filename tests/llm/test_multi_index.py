import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import multi_index as M
from tests.llm.conftest import SF


def brute(rows, k=20):
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    out = {}
    for n in np.flatnonzero(ids % M.EVERY == 0):
        s = (x * x[n]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
        out[int(ids[n])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def answer(df, **more):
    index, books, dim = M.build(df)
    out = {}
    for r in M.search(index, books, dim, F.col("vec_id") % M.EVERY == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_exact_when_all_cells_are_met(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]       # one cell holds many equal vectors
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert answer(df, share=1.0, shard_rows=40) == brute(rows)
    assert answer(df, share=1.0) == brute(rows)


def test_recall(spark):
    sf = SF.replace("0.001", "0.1")
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    index, books, dim = M.build(df)
    got = {}
    for r in M.search(index, books, dim, F.col("vec_id") % M.EVERY == 0, least=0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute([(r["vec_id"], [float(v) for v in r["embedding"]]) for r in df.collect()])
    assert sum(len(got[q] & {i for i, _ in v}) for q, v in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (40, [inf, 1.0]), (4, [None, 1.0]), (5, [1.0, 0.0]),
            (6, [1.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    got = answer(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("cell", F.lit("x")).withColumn("row", F.lit("x"))
                 .dropDuplicates())
    assert got == {0: [(5, 1.0), (20, 0.5)], 20: [(0, 0.5), (5, 0.5)]}
    assert answer(spark.createDataFrame([], "vec_id bigint, embedding array<float>")) == {}
    assert answer(spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")) == {}
    assert answer(spark.createDataFrame([(20, [1.0, 2.0])], "vec_id bigint, embedding array<double>")) == {}


def test_walk_is_by_summed_distance():
    rng = np.random.default_rng(5)
    d1, d2, count = rng.random(6), rng.random(7), rng.integers(0, 3, 42)
    cells = M.walk(d1, d2, count, 10**9)
    total = [d1[c // 7] + d2[c % 7] for c in cells]
    assert total == sorted(total) and sorted(cells) == np.flatnonzero(count).tolist()
