import math

import numpy as np
import pytest

from strata.llm import whitening as wh
from tests.llm.conftest import clashing

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def brute(rows):
    """By definition: covariance of the distinct integer vectors and its eigenvectors."""
    some = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: np.array([math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in some}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, z = np.linalg.eigh(v)
    e, z = e[::-1], z[:, ::-1]
    return x, n, s, e, z, np.trace(v)


def check(rows, found):
    x, n, s, e, z, trace = brute(rows)
    k = min(16, int((e > 1e-9 * max(e[0], 1e-300)).sum()))
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[r["vec_id"]], s))
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / trace, rel=1e-9)
    assert set(by) == set(x) and all(set(v) == set(range(1, k + 1)) for v in by.values())
    for c in range(k):
        want = {i: (v - s / n) @ z[:, c] / math.sqrt(e[c]) for i, v in x.items()}
        sign = 1 if sum(want[i] * by[i][c + 1]["whitened"] for i in x) > 0 else -1
        assert max(abs(want[i] - sign * by[i][c + 1]["whitened"]) for i in x) < 1e-8


def test_query_against_eigh(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, wh.op12_whitening(spark, SF).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [3, 2, 1, 1, 0.2]]) for i in range(60)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(40)]                  # repeated vectors
    odd = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] * 5), (204, [1.0, 2.0, float("-inf"), 0.0, 0.0])]
    df = clashing(frame(spark, rows + odd + [(205, [1.0, 2.0])]))
    check(rows + odd, wh.whitened(df).collect())


def test_null_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(None if i % 5 == 0 else i // 2, [float(c) for c in rng.normal(size=3)]) for i in range(50)]
    out = wh.whitened(frame(spark, rows)).collect()
    assert len(out) == 150 and sum(r["vec_id"] is None for r in out) == 30


def test_fewer_components_than_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, 1.0]) for i in range(10)]           # one direction has all variance
    out = wh.whitened(frame(spark, rows)).collect()
    assert {r["component"] for r in out} == {1} and out[0]["explained"] == pytest.approx(1.0)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance(spark, rows):
    assert wh.whitened(frame(spark, rows)).collect() == []


def test_deviation_beyond_a_long():
    x, s = np.array([[1_000_000 + (1 << 20), 5]]), np.array([1_000_000 * 3000, 0])
    assert wh._deviation(x, 3000, s)[0] == sum((int(a) * 3000 - int(b)) ** 2 for a, b in zip(x[0], s)) or wh._deviation(x, 3000, s) == [None]
    assert wh._deviation(np.array([[1 << 40]]), 1, np.array([0])) == [None]


def test_tasks_and_blocks_are_joined(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK", 7)
    monkeypatch.setattr(wh, "FAN", 2)
    x = np.random.default_rng(5).integers(-500, 500, (400, 6))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<bigint>").repartition(9)
    r = wh.triangular(df, x.mean(0))
    assert np.allclose(r.T @ r, (x - x.mean(0)).T @ (x - x.mean(0)))


MATRICES = {
    "random": lambda g: np.linalg.qr(g.normal(size=(500, 40)), mode="r"),
    "rank": lambda g: np.linalg.qr(np.column_stack([g.normal(size=(90, 9)), np.zeros((90, 2)), np.ones((90, 3))]), mode="r"),
    "fewer rows": lambda g: np.vstack([np.linalg.qr(g.normal(size=(5, 12)), mode="r"), np.zeros((7, 12))]),
    "ties": lambda g: np.diag([3.0, 3, 3, 2, 2, 1, 1, 1]) @ np.linalg.qr(g.normal(size=(8, 8)))[0],
    "nearly equal": lambda g: np.diag(np.abs(np.arange(-10, 11)) + 1.0) + np.diag(np.ones(20), 1),
    "identity": lambda g: np.eye(7),
    "zero": lambda g: np.zeros((4, 4)),
    "one": lambda g: np.array([[-2.5]]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver(name):
    r = MATRICES[name](np.random.default_rng(6))
    values, z = wh.principal(r, 16)
    true = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(values, true, rtol=1e-12, atol=1e-13 * max(true[0], 1e-300))
    assert z.shape[1] == min(16, int((true > len(r) * wh.EPS * true[0]).sum()))
    assert np.allclose(z.T @ z, np.eye(z.shape[1]), atol=1e-10)
    assert np.allclose(r.T @ (r @ z), z * values[:z.shape[1]] ** 2, atol=1e-10 * max(true[0] ** 2, 1e-300))


def test_small_values_are_accurate():
    """Relatively, which solvers on the squared matrix are not."""
    a, b = 10.0 ** -np.arange(0, 30, 2), 0.1 * 10.0 ** -np.arange(1, 29, 2)
    got = wh.singular_values(a, b)
    assert np.prod(got / np.sort(a)[::-1]) == pytest.approx(1.0, rel=1e-12)    # the determinant
    assert got[-1] == pytest.approx(1e-28, rel=0.05)
