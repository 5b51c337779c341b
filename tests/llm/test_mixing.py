import collections

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from tests.llm.conftest import clashing


def reshared(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing the excess until none is above its bound."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(w[s] for s in free)
        over = [s for s in free if unit * w[s] >= most * sizes[s]]
        if not over:
            out |= {s: unit * w[s] for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def test_targets_and_taken(spark, odd_docs):
    sized = odd_docs.withColumn("size", mixing.word_count(F.col("text")))
    rows = mixing.mix(sized).collect()
    assert len(rows) == odd_docs.count()
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    want = reshared(dict(sizes))
    taken = collections.Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert {s: taken[s] for s in sizes} == {s: int(want[s] + 1e-9) for s in sizes}


def test_documents_hold_the_words_taken(spark, odd_docs):
    sized = odd_docs.withColumn("size", mixing.word_count(F.col("text")))
    want = {r["source"]: r["t"] for r in mixing.mix(sized).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    got = {r["source"]: r["t"] for r in out.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("t")).collect()}
    for s, t in want.items():
        assert abs(got.get(s, 0) - t) <= 1      # equal rows at a cut share what is left
    assert out.filter("n_chars <> length(text)").isEmpty()


def test_reruns_agree_and_clashing_columns(spark, odd_docs):
    one, two = [sorted(map(str, mixing.mixed_documents(d).select(*odd_docs.columns).collect())) for d in (odd_docs, clashing(odd_docs))]
    assert one == two


def test_empty(spark, no_docs):
    assert mixing.mixed_documents(no_docs).count() == 0
    assert mixing.mix(no_docs.withColumn("size", F.lit(0))).count() == 0
