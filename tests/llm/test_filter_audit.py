import itertools

import pytest
from pyspark.sql import functions as F

from strata.llm import filter_audit as fa
from tests.llm.conftest import clashing

LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    """All orders, one document after the other."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    seen = []
    for d, t, lang, *_ in rows:
        text, f = t or "", set()
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            f.add("C")
        if any(c in "#$%&*|" for c in text):
            f.add("D")
        if d is not None and d > least[text]:
            f.add("E")
        seen.append((lang or "", f, d in good, d in bad))
    out = {}
    for part in {s[0] for s in seen}:
        mine = [s for s in seen if s[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, c in enumerate(order, 1):
                gone = [s for s in left if c in s[1]]
                left = [s for s in left if c not in s[1]]
                failing = [s for s in mine if c in s[1]]
                shapley[c] += len(gone)
                out[part, "".join(order), k] = [len(left), len(gone), len(failing) - len(gone), sum(s[1] == {c} for s in mine),
                                                sum(s[2] for s in gone), sum(s[3] for s in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return out


def got(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", *fa.SUMS, "shapley")] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def rows():
    long = " ".join(f"w{i}" for i in range(250))
    many = [(100 + i, f"{long} t{i % 7}{' #' if i % 3 == 0 else ''}{' AAAA' * 20 if i % 5 == 0 else ''}", "en" if i % 2 else "de", "a", 0) for i in range(40)]
    return many + [(200, "same words " * 300, None, "a", 0), (201, "same words " * 300, "", "a", 0), (None, "same words " * 300, "en", "a", 0)]


def test_against_every_order(spark, odd_docs, rows):
    docs = odd_docs.union(spark.createDataFrame(rows, odd_docs.schema))
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (9999, 1, 1), *((100 + i, i % 2, i % 4 == 0) for i in range(30))]
    labels = [(d, q, int(t) if t is not None else None) for d, q, t in labels]
    want = brute([tuple(r) for r in docs.collect()], labels)
    mark = spark.createDataFrame(labels, LABELS)
    found = got(fa.audit(fa.failure_counts(clashing(docs), clashing(mark))))
    assert found == want and len(found) % 600 == 0


def test_intervals_tile_the_orders():
    for mask in range(1, 32):
        cover = [0] * 120
        for m, _, a, b, what in fa.intervals():
            if m == mask and what == "removed":
                for r in range(a, b):
                    cover[r] += 1
        assert cover == [1] * 120           # every order removes the mask once


def test_other_filter_counts(spark):
    counts = spark.createDataFrame([("p", 3, 5, 2, 1), ("p", 0, 4, 4, 0), ("p", 1, 2, 0, 0)], "part string, mask int, n long, good long, toxic long")
    found = got(fa.audit(counts, "XY"))
    assert found["p", "XY", 1] == [4, 7, 0, 2, 2, 1, 9] and found["p", "XY", 2] == [4, 0, 5, 0, 0, 0, 5]
    assert found["p", "YX", 1] == [6, 5, 0, 0, 2, 1, 5] and found["p", "YX", 2] == [4, 2, 5, 2, 0, 0, 9]


def test_empty(spark, no_docs):
    labels = spark.createDataFrame([], LABELS)
    assert fa.audit(fa.failure_counts(no_docs, labels)).count() == 0


def test_no_labels(spark, odd_docs):
    out = fa.audit(fa.failure_counts(odd_docs, spark.createDataFrame([], LABELS)))
    assert out.filter((F.col("good_lost") != 0) | (F.col("toxic_lost") != 0)).isEmpty() and not out.isEmpty()
