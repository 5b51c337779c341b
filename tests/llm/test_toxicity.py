import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import toxicity as T
from tests.llm.conftest import SF, clashing


def grams(word):
    p = "\x02" * 5 + word + "\x03"
    return [p[i:i + 6] for i in range(len(p) - 5)]


def plain_evidence(tox, ordinary):
    """Kneser-Ney by its definition, over dictionaries of word counts."""
    d, ct, co = T.DISCOUNT, Counter(), Counter()
    for c, words in ((ct, tox), (co, ordinary)):
        for w, n in words.items():
            for g in grams(w):
                c[g] += n
    every = set(ct) | set(co)
    level, tables = every, []
    for _ in range(5):
        nxt = Counter(g[1:] for g in level)
        tables.append(nxt)
        level = set(nxt)

    def shared(g, k):               # g: k characters; k = 6 uses counts, below continuation counts
        if k == 1:
            t = tables[4]
            return (max(t[g] - d, 0) + d * len(t) / (len(t) + 1.0)) / sum(t.values())
        counts = {x: ct[x] + co[x] for x in every} if k == 6 else tables[5 - k]
        mine = [n for x, n in counts.items() if x[:-1] == g[:-1]]
        return (max(counts[g] - d, 0) + d * len(mine) * shared(g[1:], k - 1)) / sum(mine)

    def own(c, g):
        mine = [n for x, n in c.items() if x[:-1] == g[:-1] and n > 0]
        p = shared(g, 6)
        return (max(c[g] - d, 0) + d * len(mine) * p) / sum(mine) if mine else p

    return {g: math.log(own(ct, g)) - math.log(own(co, g)) for g in every}


def test_against_the_definition(spark):
    tox, ordinary = {"idiot": 3, "idle": 1, "scum": 2}, {"idle": 4, "idea": 2, "summer": 1, "scale": 5}
    word, hi, lo = T.word_grams([*tox, *ordinary])
    n = [*tox.values(), *ordinary.values()]
    rows = [(int(h), int(x), n[w] if w < len(tox) else 0, n[w] if w >= len(tox) else 0) for w, h, x in zip(word, hi, lo)]
    df = spark.createDataFrame(rows, "hi bigint, lo bigint, nt bigint, no bigint").groupBy("hi", "lo").agg(F.sum("nt").alias("nt"), F.sum("no").alias("no"))
    seen, _ = T.evidence(df)
    name = lambda h, x: "".join(chr(v >> s & 0x1FFFFF) for v in (h, x) for s in (42, 21, 0))
    got = {name(r["hi"], r["lo"]): r["llr"] for r in seen.collect()}
    want = plain_evidence(tox, ordinary)
    assert set(got) == set(want)
    assert all(math.isclose(got[g], want[g], abs_tol=1e-9) for g in want)


def small_model(spark):
    tox, ordinary = {"idiot": 3, "idle": 1, "scum": 2}, {"idle": 4, "idea": 2, "summer": 1, "scale": 5}
    word, hi, lo = T.word_grams([*tox, *ordinary])
    n = [*tox.values(), *ordinary.values()]
    rows = [(int(h), int(x), n[w] if w < len(tox) else 0, n[w] if w >= len(tox) else 0) for w, h, x in zip(word, hi, lo)]
    df = spark.createDataFrame(rows, "hi bigint, lo bigint, nt bigint, no bigint").groupBy("hi", "lo").agg(F.sum("nt").alias("nt"), F.sum("no").alias("no"))
    seen, unseen = T.evidence(df)
    grams = {(r["hi"], r["lo"]): r["llr"] for r in seen.collect()}
    contexts = {(r["hi"], r["ctx"]): r["llr"] for r in unseen.collect()}
    step = F.round(F.col("llr") * T.SCALE).cast("bigint").alias("e")
    return (seen.select("hi", "lo", step), unseen.select("hi", "ctx", step)), grams, contexts


def plain_word(word, grams, contexts):
    _, hi, lo = T.word_grams([word])
    return sum(grams.get((h, x), contexts.get((h, x >> 21), 0.0)) for h, x in zip(hi.tolist(), lo.tolist()))


def test_word_evidence_by_lookup(spark):
    m, grams, contexts = small_model(spark)
    words = ["idiot", "Idiots!", "idio", "scumbag", "summer", "zzz", "", "é", "idle" * 3000]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words) if w], "key bigint, word string")
    got = {r["key"]: r["e"] / T.SCALE for r in T.word_evidence(df, m).collect()}
    assert set(got) == {i for i, w in enumerate(words) if w}
    assert all(math.isclose(got[i], plain_word(words[i], grams, contexts), abs_tol=1e-5) for i in got)
    rows = sum(df.count() for df in m)
    assert T.lookup(m, rows - 1) is None
    seen = T.look_up([w for w in words if w], T.lookup(m, rows)) / T.SCALE
    assert seen.tolist() == [got[i] for i, w in enumerate(words) if w]


def test_runs_give_each_document_its_own_features(spark, monkeypatch):
    """Documents of many runs, with empty texts between, against one document at a time."""
    monkeypatch.setattr(T, "RUN_BYTES", 64)
    m, grams, contexts = small_model(spark)
    texts = ["idiot scum", None, "", "idle summer scale " * 20, "scum", "IDIOT idiot, idiot", "unknown things", "  \n"]
    df = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(40)], "doc_id bigint, text string")

    def result(ids, x):
        return T.pa.RecordBatch.from_arrays([ids, T.pa.array(x[:, 0]), T.pa.array(x[:, 5])], ["doc_id", "mean", "size"])
    got = T.features(df, m, None, result, "doc_id bigint, mean double, size double").collect()
    assert sorted(got) == sorted(T.features(df, m, T.lookup(m, 10**6), result, "doc_id bigint, mean double, size double").collect())
    assert sorted(r["doc_id"] for r in got) == list(range(40))
    for r in got:
        kinds = {w.lower(): w for w in (texts[r["doc_id"] % len(texts)] or "").split()}
        want = sum(plain_word(w, grams, contexts) for w in kinds) / (len(kinds) + T.PRIOR_WORDS)
        assert math.isclose(r["mean"], want, abs_tol=1e-5) and math.isclose(r["size"], math.log1p(len(kinds)))


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    rows = T.op10_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    x = rows.join(labels, "doc_id").filter("held_out").select("toxic", "predicted").collect()
    n = Counter((r["toxic"], r["predicted"]) for r in x)
    assert n[1, 1] >= 0.7 * (n[1, 1] + n[1, 0])
    assert n[0, 1] <= 0.02 * (n[0, 0] + n[0, 1])
    assert rows.filter("score < 0 or score > 1 or score is null").isEmpty()


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 1), (2, None, None), (None, 0, 1), (6, 0, 1), (8, 1, 0)], "doc_id bigint, quality int, toxic int")
    fitted = T.fit(clashing(odd_docs), labels)
    assert T.score(odd_docs, fitted).filter(F.col("score").isNotNull()).count() == odd_docs.count()
    assert T.score(no_docs, fitted).count() == 0
    assert T.score(no_docs, T.fit(no_docs, labels)).count() == 0


def test_a_joined_model_gives_the_same_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    small, large = (T.fit(docs, labels, n) for n in (T.LOOKUP_ROWS, 0))
    assert small["arrays"] is not None and large["arrays"] is None
    want, got = (sorted(map(tuple, T.score(docs, f).collect())) for f in (small, large))
    assert [x[0] for x in got] == [x[0] for x in want]
    assert all(math.isclose(a[1], b[1], abs_tol=1e-6) for a, b in zip(got, want))


def test_words_are_counted_once_a_document():
    data = "Shti shti, SHTI other".encode()
    doc, which, kinds = T.batch_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert sorted(k.lower() for k in kinds) == ["other", "shti", "shti,"] and doc.tolist() == [0, 0, 0]
