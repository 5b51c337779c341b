import collections
import random
import re
import subprocess
import sys

import numpy as np
import pytest

from strata.llm import ngram_join as J
from strata.llm.components import components
from tests.conftest import ROOT
from tests.llm.conftest import SF, clashing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(zip(w, w[1:], w[2:], w[3:], w[4:]))


def brute(rows):
    """(doc_id, set size, smallest id reachable), by comparing everything."""
    sets = [(i, shingles(t)) for i, t in rows]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    low = {}
    for (i, s), v in zip(sets, label):
        if s and i is not None:
            low[v] = min(low.get(v, i), i)
    return collections.Counter((i, len(s), low.get(v) if s else i) for (i, s), v in zip(sets, label))


def answer(df, **more):
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.similar_components(df, **more).collect())


def near_copies(seed, n, groups):
    """Groups of edited copies round the limit of similarity, with a common passage in some."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(25)]
    bases = [[r.choice(vocabulary) for _ in range(r.randint(3, 120))] for _ in range(groups)]
    out = []
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        if r.random() < 0.2:
            w += passage
        out.append((i, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
    return out


@pytest.mark.parametrize("group_tokens", [J.GROUP_TOKENS, 400])
def test_against_brute_force(spark, group_tokens):
    """Also with groups cut into many chunks."""
    rows = near_copies(5, 260, 6)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert answer(df, group_tokens=group_tokens) == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert answer(odd_docs) == brute(rows)
    assert answer(clashing(odd_docs)) == brute(rows)
    assert J.similar_components(no_docs).count() == 0


def test_given_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert answer(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_prefixes_share_as_stated():
    """Every linked pair shares enough prefix tokens under every order."""
    r = np.random.default_rng(1)
    common = np.sort(r.integers(0, 2**63, 30).astype(np.uint64))
    for _ in range(300):
        n = int(r.integers(1, 150))
        x = np.unique(np.concatenate([r.integers(0, 2**63, n).astype(np.uint64), common[:int(r.integers(0, 30))]]))
        y = np.unique(np.concatenate([x[r.random(len(x)) < 0.9], r.integers(0, 2**63, int(r.integers(0, n // 8 + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        for order in range(2):
            a, b = J.prefix(x, order, common)[0], J.prefix(y, order, common)[0]
            assert len(np.intersect1d(a, b)) >= max(1, -(-J.EXTRA * J.PERCENT * max(len(x), len(y)) // 10000))


def test_one_per_component(spark, odd_docs):
    out = J.one_per_component(odd_docs)
    assert out.columns == odd_docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    ids = [g[1] for g in got if not g[0]]
    assert ids == [1, 3, 4, 5, 6, 7, 8, 9]      # 2 and 10 and the longer text equal 1; empty texts all stay
    assert sum(g[0] for g in got) == 1


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    label = {}
    for a, b in edges:
        label.setdefault(a, a)
        label.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {x["v"]: x["root"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {v: m for v, m in label.items() if v in got}
    assert {v for v in label if v not in got} == {a for a, b in edges if a == b and sum(a in e for e in edges) == 1}


def _bridged_rows():
    """Two linked documents of common tokens only, in different salts, and a
    longer one round the same words that is first in the second one's run but
    shares too little to be a candidate itself."""
    sets = lambda words: J.shingle_sets(*_flat(" ".join(words)))[0]
    salt = lambda c: int(J.mix64(np.array([c], np.int64).view(np.uint64))[0] % np.uint64(J.SALTS))
    for seed in range(40):
        long = [f"p{seed}x{i}" for i in range(22)]              # 18 shingles
        for a, b in ((long[:9], long[:8]), (long[:9], long[1:9]), (long[:8], long[:9]), (long[1:9], long[:9])):
            sa, sb, sl = sets(a), sets(b), sets(long)
            common = np.sort(sl)
            pa_, pb = J.prefix(sa, 0, common)[0], J.prefix(sb, 0, common)[0]
            both, ca, cb = np.intersect1d(pa_, pb), J.class_id(sa), J.class_id(sb)
            if not len(both) or not ca < cb or salt(ca) == salt(cb):
                continue
            for extra in (8, 9, 10):
                for k in range(400):
                    p = long + [f"r{seed}y{k}z{i}" for i in range(extra)]
                    sp = sets(p)
                    cp = J.class_id(sp)
                    if not ca < cp < cb or salt(cp) != salt(cb):
                        continue
                    got, late = J.prefix(sp, 0, common)
                    need = -(-J.EXTRA * J.PERCENT * len(sp) // 10_000)
                    if np.isin(both, got).all() and late.sum() < need:
                        fill = [long + [f"f{seed}g{j}h{i}" for i in range(60)] for j in range(4)]
                        return [(i, " ".join(w)) for i, w in enumerate([a, b, p, *fill])]
    raise AssertionError("no such rows")


def _flat(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def test_salted_runs_meet_through_a_pivot_that_is_no_candidate(spark):
    rows = _bridged_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    want = brute(rows)
    assert want[1, len(shingles(rows[1][1])), 0] == 1           # the second is linked with the first
    assert answer(df) == want


@pytest.mark.parametrize("k", [1, 7, 50, 500, 3000])
def test_most_frequent_tokens(spark, k):
    """The same tokens as a whole sort gives, by counts and, where they are equal, by tokens."""
    r = random.Random(k)
    tokens = list({r.choice([r.getrandbits(64) - (1 << 63), r.randrange(-40, 40), (5 << 48) + r.randrange(900)]) for _ in range(2500)})
    rows = [(t, r.choice([4, 4, 4, 5, 70_000, 70_001, 1 << 33, (1 << 50) + 1])) for t in tokens]
    want = sorted(rows, key=lambda x: (-x[1], x[0]))[:k]
    counts = spark.createDataFrame(rows, "token bigint, n bigint").repartition(7)
    got = J.most_frequent(counts, k)
    assert got.dtype == np.uint64 and got.tolist() == sorted(t % (1 << 64) for t, _ in want)
    assert not len(J.most_frequent(counts.limit(0), k))


def test_frequent_tokens_of_many_partitions_fit_the_driver(tmp_path):
    """Every token is frequent in its run of documents, as each document comes six times in a row."""
    code = f"""
import random
from strata.session import get_session
from strata.llm import ngram_join as J
spark = get_session("local[4]", 32, extra={{"spark.driver.maxResultSize": "8m", "spark.checkpoint.dir": {str(tmp_path)!r},
                    "spark.sql.adaptive.coalescePartitions.enabled": "false"}})
r = random.Random(3)
texts = [" ".join(f"{{r.getrandbits(24):x}}" for _ in range(1000)) for _ in range(500)]
docs = spark.createDataFrame([(6 * i + k, t) for i, t in enumerate(texts) for k in range(6)], "doc_id bigint, text string")
got = J.similar_components(docs.coalesce(4)).select("doc_id", "n_shingles", "component_id").toArrow()
assert got.num_rows == 3000 and set(got.column("n_shingles").to_pylist()) == {{996}}
assert all(c == i - i % 6 for i, c in zip(got.column("doc_id").to_pylist(), got.column("component_id").to_pylist()))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]


def test_estimates_of_component_rounds_stay_small(spark, monkeypatch):
    """A path of links takes many rounds; Spark's estimate of their labels' size must not grow with each."""
    import strata.llm.components as C
    sizes, cut = [], C.cut_lineage

    def watched(df, **more):
        out = cut(df, **more)
        sizes.append(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        return out

    monkeypatch.setattr(C, "cut_lineage", watched)
    order = list(range(600))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a bigint, b bigint")
    got = {r["v"]: r["root"] for r in components(edges).collect()}
    assert got == dict.fromkeys(range(600), 0)
    assert len(sizes) > 10 and max(sizes) < 1 << 63
