import itertools

import numpy as np
from pyspark.sql import functions as F

from strata.llm import line_crf as C
from tests.llm.conftest import SF, clashing


def test_marginals_against_all_labellings():
    r = np.random.default_rng(2)
    line_doc = np.array([0, 0, 0, 2, 3, 3, 3, 3])
    unary, trans = r.normal(size=8), r.normal(size=(2, 2))
    p, pairs = C._Chains(line_doc).marginals(unary, trans)
    want, seen = np.zeros(8), np.zeros((2, 2))
    for d in (0, 2, 3):
        at = np.flatnonzero(line_doc == d)
        z, part, pp = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(at)):
            w = np.exp(sum(unary[a] * v for a, v in zip(at, y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            z, part = z + w, part + w * np.array(y)
            for a, b in zip(y, y[1:]):
                pp[a, b] += w
        want[at] = part / z
        seen += pp / z
    assert np.allclose(p, want) and np.allclose(pairs, seen)


def test_lines_of_texts():
    texts = ["one two\n\n  \nTHREE!!\n", "", "a | b", "\n\n", "x\nx"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    doc, own, chars = C.lines(np.frombuffer(b"".join(raw), np.uint8), off)
    assert doc.tolist() == [0, 0, 2, 4, 4]
    assert own[:, 12].tolist() == [0, 0, 0, 0, 1]       # the repeated line
    assert own[1, 0] > own[1, 1] == 0 and own[2, 4] > 0


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    rows = C.op9_line_crf(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    x = rows.join(labels, "doc_id").filter("held_out").select("quality", "predicted").collect()
    assert sum(r["quality"] == r["predicted"] for r in x) >= 0.95 * len(x)
    assert rows.filter("score < 0 or score > 1 or score is null").isEmpty()


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (2, None, None), (None, 0, 0), (6, 0, 1), (8, 1, 0)], "doc_id bigint, quality int, toxic int")
    fitted = C.fit(odd_docs, labels)
    out = C.score(clashing(odd_docs), fitted)
    assert out.count() == odd_docs.count() and out.filter(F.col("score").isNull()).isEmpty()
    assert C.score(no_docs, fitted).count() == 0
    assert C.fit(no_docs, labels) == {"share": 0.5}
    assert {r["score"] for r in C.score(odd_docs, C.fit(odd_docs, labels.filter("quality = 1"))).collect()} == {1.0}
