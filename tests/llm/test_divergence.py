import collections
import random
import re

import numpy as np

from strata.llm import divergence as D
from tests.llm.conftest import SF, clashing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(rep)


def check(rows, texts):
    got = collections.Counter((r["doc_id"], *(r[k] for k in D.COUNTS)) for r in rows)
    assert got == collections.Counter((i, *plain(t)) for i, t in texts)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_counts(spark, odd_docs):
    rows = D.judge(odd_docs, D.references(odd_docs)).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert D.judge(clashing(odd_docs), D.references(clashing(odd_docs))).count() == len(rows)


def test_counts_of_random_texts(spark):
    r = random.Random(3)
    texts = [(i, "".join(r.choice(["a", "b ", "\n", "\t", "é#", "c d e f g h i j ", "😀", "\r\n", "a\n"]) for _ in range(r.randint(0, 60)))) for i in range(300)]
    df = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id bigint, text string, lang string")
    check(D.judge(df, D.references(df)).collect(), texts)


def test_distance():
    p, q = np.array([[1.0, 0], [0.5, 0.5], [0, 1.0]]), np.array([0.5, 0.5])
    assert D.js_distance(p, q)[1] == 0 and D.js_distance(p, np.array([1.0, 0]))[2] == 1
    assert D.js_distance(p, q)[0] == D.js_distance(p, q)[2]


def test_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in D.op2_divergence(spark, SF).collect()}
    check(rows.values(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    good = [r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()]
    assert all(rows[i]["kept"] for i in good if not rows[i]["base_failed"])
    junk = spark.createDataFrame([(1, " ".join(f"{'#$%|' * 6}{i}" for i in range(200)))], "doc_id bigint, text string")
    assert [r["kept"] for r in D.judge(junk, D.references(docs)).collect()] == [False]


def test_every_language_has_its_reference(spark):
    r = random.Random(8)
    kinds = {f"l{i:03d}": [f"w{i}x{j}" for j in range(30)] for i in range(230)}
    rows = [(7 * i + k, " ".join(r.choices(kinds[lang], k=90)), lang) for i, lang in enumerate(kinds) for k in range(3)]
    lost = [(90000 + i, " ".join(r.choices(kinds[f"l{(i + 1) % 230:03d}"], k=90)), f"l{i:03d}") for i in range(0, 230, 23)]
    names = "doc_id bigint, text string, lang string"
    refs = D.references(spark.createDataFrame(rows, names))
    assert refs.filter("not pooled").count() == 230
    got = {x["doc_id"]: x for x in D.judge(spark.createDataFrame(rows + lost, names), refs).collect()}
    assert all(got[i]["kept"] for i, _, _ in rows)
    assert not any(got[i]["kept"] for i, _, _ in lost)          # written in another language than they say


def test_distances_against_the_definition(spark):
    """Both distances of every document, from plain counts."""
    r = random.Random(4)
    words = [f"a{i}" for i in range(90)] + ["B,", "c#", "\u00e9", "7"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(20, 200))), r.choice(["x", "y", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    fold = lambda w: "".join(c.lower() if c.isascii() else c for c in w)
    kept = [x for x in rows if not D.base_failed({"n_words": np.array([plain(x[1])[0]]), "n_repeat_words": np.array([plain(x[1])[4]])})[0]]

    def js(p, q):
        out = 0.0
        for a, b in zip(p, q):
            out += (a * np.log2(2 * a / (a + b)) if a else 0) / 2 + (b * np.log2(2 * b / (a + b)) if b else 0) / 2
        return max(out, 0.0) ** 0.5

    def classes(text):
        return np.bincount([min(int(D._CLASS[c.encode()[0]]), 10) for c in text], minlength=11)[:11]

    got = {x["doc_id"]: x for x in D.judge(df, D.references(df)).collect()}
    for i, text, lang in rows:
        mine = [t for _, t, x in kept if x == lang]
        n = collections.Counter(fold(w) for t in mine for w in WORD.findall(t))
        ref = sum(classes(t) for t in mine)
        assert np.isclose(got[i]["class_distance"], js(classes(text) / len(text), ref / ref.sum()), atol=1e-6)
        top = n.most_common()
        if len(top) > 64 and top[63][1] == top[64][1]:
            continue                                            # a tie at the edge: which word counts is by hash
        own = collections.Counter(fold(w) for w in WORD.findall(text))
        p, q = ([c[w] / c.total() for w, _ in top[:64]] for c in (own, n))
        assert np.isclose(got[i]["word_distance"], js([*p, 1 - sum(p)], [*q, 1 - sum(q)]), atol=1e-6)


def test_empty(spark, no_docs):
    assert D.judge(no_docs, D.references(no_docs)).count() == 0
