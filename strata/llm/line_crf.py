"""Quality classifier: a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad.  A line's features are its own
and its neighbours' character and word shares; the chain adds how labels follow
each other.  Forward-backward gives each line's probability of being bad, and
the length-weighted mean over a document, through a logistic curve, its score.

Only documents are labelled, so the lines' labels are found in turns: lines of
good documents are good; lines of bad documents are bad where the last fit says
so (its worst line in any case).  The fit uses at most ``FIT_DOCS`` labelled
training documents, drawn by hash; their line features (not their texts) reach
the driver.  All documents are scored whole.

Defined cases: null and empty texts and texts without words have no lines; they
score as the fit's share of good documents; null labels and ids are not learnt
from; without both classes every score is that share (0.5 without any);
repeated rows are rows like any other; an empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm.common import (DataFrame, SparkSession, fold, map_arrow, span_hash, table, text_bytes, text_groups,
                               word_spans)

FIT_DOCS = 4000         # labelled documents that the fit may use
TURNS = 3
STEPS = 60
OWN = 14                # features of a line itself
COLS = 3 * OWN + 1


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.float64)
    out[list(chars)] = 1
    return out


_KINDS = [_mask(bytes(range(65, 91))), _mask(bytes(range(97, 123))), _mask(b"0123456789"), _mask(b"#*$%&<>"), _mask(b"|"),
          _mask(b"!"), _mask(b".,;:?'\"()-"), _mask(bytes(range(0xC0, 256)))]
_FIRST = np.ones(256)
_FIRST[0x80:0xC0] = 0


def lines(data: np.ndarray, off: np.ndarray):
    """(document, own features, characters) of every line with a word."""
    doc, start, end = word_spans(data, off)
    cut = np.union1d(off[:-1], np.flatnonzero(data == 10) + 1)
    cut = cut[cut < len(data)]
    stop = np.concatenate([cut[1:], [len(data)]]) if len(cut) else cut
    lo, hi = np.searchsorted(start, cut), np.searchsorted(start, stop)
    some = hi > lo
    cut, stop, lo, hi = cut[some], stop[some], lo[some], hi[some]
    line_doc = np.searchsorted(off, cut, "right") - 1
    if not len(cut):
        return line_doc, np.zeros((0, OWN)), np.zeros(0)
    total = lambda per: np.diff(np.concatenate([[0.0], np.cumsum(per)])[np.stack([cut, stop])], axis=0)[0]
    chars = np.maximum(total(_FIRST[data]), 1)
    share = [np.sqrt(total(k[data]) / chars) for k in _KINDS]
    words = (hi - lo).astype(float)
    word = span_hash(fold(data), start, end)
    line_of = np.repeat(np.arange(len(cut)), hi - lo)
    same = np.zeros(len(word))
    same[1:] = (word[1:] == word[:-1]) & (line_of[1:] == line_of[:-1])
    per_line = lambda v: np.bincount(line_of, v, len(cut))
    kinds = np.unique(line_of.astype(np.uint64) << np.uint64(40) | word >> np.uint64(24))
    distinct = np.bincount((kinds >> np.uint64(40)).astype(np.int64), minlength=len(cut))
    key = span_hash(data, cut, stop - (data[stop - 1] == 10))
    order = np.lexsort((key, line_doc))
    again = np.zeros(len(cut))
    again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (line_doc[order[1:]] == line_doc[order[:-1]])
    closed = np.isin(data[end[hi - 1] - 1], list(b".!?\"")).astype(float)
    own = np.column_stack([*share, np.sqrt(per_line(same) / words), np.sqrt(1 - distinct / words), np.minimum(chars / words, 30) / 10,
                           np.log1p(words) / 5, again, closed])
    return line_doc, own, chars


def neighbours(line_doc: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after, and 1."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(own) > 1:
        same = (line_doc[1:] == line_doc[:-1])[:, None]
        before[1:] = own[:-1] * same
        after[:-1] = own[1:] * same
    return np.column_stack([own, before, after, np.ones(len(own))])


class _Chains:
    """Lines of many documents, dealt by place so that a step covers all documents."""

    def __init__(self, line_doc: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], line_doc[1:] != line_doc[:-1]])) if len(line_doc) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([first, [len(line_doc)]]))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        self.steps = [first[:int(np.searchsorted(-size, -t, "left"))] + t for t in range(int(size[0]) if len(size) else 0)]
        self.n = len(line_doc)

    def marginals(self, unary: np.ndarray, trans: np.ndarray):
        """(P(bad) of each line, expected label pairs), ``unary`` = score of bad.

        ``trans[y, z]`` is the score of label z after y."""
        e = np.exp(trans - trans.max())
        node = np.column_stack([np.ones(self.n), np.exp(np.clip(unary, -30, 30))])
        a, b = np.zeros((self.n, 2)), np.ones((self.n, 2))
        for t, at in enumerate(self.steps):
            v = node[at] if t == 0 else (a[at - 1] @ e) * node[at]
            a[at] = v / v.sum(1, keepdims=True)
        pairs = np.zeros((2, 2))
        for t in range(len(self.steps) - 1, 0, -1):
            at = self.steps[t]
            v = b[at] * node[at]
            w = v @ e.T
            p = a[at - 1][:, :, None] * e[None] * v[:, None, :]
            pairs += (p / p.sum((1, 2), keepdims=True)).sum(0)
            b[at - 1] = w / w.sum(1, keepdims=True)
        p = a * b
        return p[:, 1] / p.sum(1), pairs


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) / len(x) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_chain(x: np.ndarray, line_doc: np.ndarray, bad_doc: np.ndarray) -> dict:
    """Weights of the chain.  ``line_doc`` indexes ``bad_doc`` (1: bad)."""
    of_bad = bad_doc[line_doc] == 1
    y = of_bad.astype(float)
    chains = _Chains(line_doc)
    w, trans = _logistic(x, y), np.zeros((2, 2))
    inner = np.concatenate([[False], line_doc[1:] == line_doc[:-1]])
    for _ in range(TURNS):
        p, _ = chains.marginals(x @ w, trans)
        worst = np.zeros(len(bad_doc))
        np.maximum.at(worst, line_doc, p)
        y = (of_bad & ((p > 0.5) | (p >= worst[line_doc]))).astype(float)
        w, trans = _logistic(x, y), np.zeros((2, 2))
        got = np.zeros((2, 2))
        np.add.at(got, (y[np.flatnonzero(inner) - 1].astype(int), y[inner].astype(int)), 1)
        m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
        for k in range(1, STEPS + 1):         # gradient of the chain's likelihood, Adam steps
            p, pairs = chains.marginals(x @ w, trans)
            g = np.concatenate([x.T @ (p - y), (pairs - got).ravel()]) / len(x) + 1e-4 * np.concatenate([w, trans.ravel()])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            d = 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
            w, trans = w - d[:-4], trans - d[-4:].reshape(2, 2)
    return {"w": w, "trans": trans}


def document_features(line_doc, chars, p, n_docs: int) -> np.ndarray:
    """Length-weighted share of bad lines, its root, and the worst line."""
    size = np.bincount(line_doc, chars, n_docs)
    bad = np.bincount(line_doc, chars * p, n_docs) / np.maximum(size, 1)
    worst = np.zeros(n_docs)
    np.maximum.at(worst, line_doc, p)
    return np.column_stack([bad, np.sqrt(bad), worst, np.ones(n_docs)])


def fit_lines(line_doc, own, chars, bad_doc: np.ndarray) -> dict:
    """Chain and curve from lines of labelled documents."""
    share = float(1 - bad_doc.mean()) if len(bad_doc) else 0.5
    if not len(line_doc) or not 0 < bad_doc.sum() < len(bad_doc):
        return {"share": share}
    x = neighbours(line_doc, own)
    out = fit_chain(x, line_doc, bad_doc)
    p, _ = _Chains(line_doc).marginals(x @ out["w"], out["trans"])
    has = np.bincount(line_doc, minlength=len(bad_doc)) > 0
    f = document_features(line_doc, chars, p, len(bad_doc))[has]
    return out | {"curve": _logistic(f, 1.0 - bad_doc[has], 2 / len(f)), "share": share}


def score_run(data: np.ndarray, off: np.ndarray, fitted: dict) -> np.ndarray:
    """Scores of a run of documents."""
    n = len(off) - 1
    out = np.full(n, fitted["share"])
    if "w" not in fitted:
        return out
    line_doc, own, chars = lines(data, off)
    if not len(line_doc):
        return out
    p, _ = _Chains(line_doc).marginals(neighbours(line_doc, own) @ fitted["w"], fitted["trans"])
    has = np.bincount(line_doc, minlength=n) > 0
    z = document_features(line_doc, chars, p, n)[has] @ fitted["curve"]
    out[has] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def _line_rows(batches):
    for b in batches:
        data, off = text_bytes(b.column("text"))
        for x, y in text_groups(off):
            line_doc, own, chars = lines(data[off[x]:off[y]], off[x:y + 1] - off[x])
            at = np.searchsorted(line_doc, np.arange(y - x + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("k").slice(x, y - x), b.column("quality").slice(x, y - x),
                 pa.ListArray.from_arrays(pa.array(at * OWN), pa.array(own.astype(np.float32).ravel())),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(chars.astype(np.float32)))], ["k", "quality", "own", "chars"])


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> dict:
    """Chain and curve from at most ``fit_docs`` training rows of ``labels``."""
    train = labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
    some = (train.select("doc_id", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id", "quality").alias("k"))
            .orderBy("k", "doc_id").limit(fit_docs))
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")      # fit_docs rows
    got = map_arrow(rows.select("k", "quality", "text"), _line_rows, "k bigint, quality int, own array<float>, chars array<float>")
    got = got.orderBy("k", F.xxhash64("own")).limit(2 * fit_docs).toArrow()
    if not got.num_rows:
        return {"share": 0.5}
    size, flat, width = [], [], []
    for own, chars in zip(got.column("own").chunks, got.column("chars").chunks):
        size.append(np.diff(chars.offsets.to_numpy()))
        flat.append(own.flatten().to_numpy())
        width.append(chars.flatten().to_numpy())
    size = np.concatenate(size)
    own = np.concatenate(flat).astype(np.float64).reshape(-1, OWN)
    bad = 1.0 - got.column("quality").to_numpy().astype(float)
    return fit_lines(np.repeat(np.arange(len(size)), size), own, np.concatenate(width).astype(np.float64), bad)


def score(docs: DataFrame, fitted: dict) -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1, higher: better)."""
    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column("text"))
            for x, y in text_groups(off):
                p = score_run(data[off[x]:off[y]], off[x:y + 1] - off[x], fitted)
                yield pa.RecordBatch.from_arrays([*b.slice(x, y - x).columns, pa.array(p)], [*b.schema.names, "score"])

    docs = docs.drop("score")
    return map_arrow(docs, run, docs.withColumn("score", F.lit(None).cast("double")).schema)


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
