"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, toxic and ordinary, are counted over all
labelled training documents: 6-grams inside a word, padded at its start.  Each
class interpolates its own counts with one shared model of the same order, whose
lower orders are Kneser-Ney continuation counts of both classes pooled.  An
n-gram that a class never saw backs off to the shared model, so rare expressions
say nothing by themselves.  A document's evidence is the toxic minus the
ordinary log-likelihood per word (each kind of word once); a logistic curve over its length-normalised
forms, fitted on training documents left out of the counts, turns it into the
score.

All counts and Kneser-Ney statistics are Spark aggregations, and the model grows
with the corpus: nothing of it is cut.  A model of at most ``LOOKUP_ROWS`` rows
(24 bytes each; they are counted first) goes to the tasks as lookup arrays.
A larger one is joined: documents are read in runs of about ``RUN_BYTES``; a run
is kept as its kinds of words and, per document, their places; the distinct kinds
of the corpus are cut into 6-grams once and joined with the model, and a run gets
one number per kind back.  Both ways add the same whole numbers, so they give the
same scores.  The curve is fitted on at most ``CURVE_DOCS`` documents.

Equal texts are learnt once, so a group of copies counts as one document.

Defined cases: null and empty texts have no evidence and get the score of the
curve there; null labels and ids are not learnt from; a document with several
labels is learnt with each; without both classes every score is the share of
toxic labels (0.5 without any); an empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm.bitmap import bitmap, holds
from strata.llm.common import (DataFrame, SparkSession, cut_lineage, fold, map_arrow, mix64, span_hash, staged, table,
                               text_bytes, text_groups, word_spans)

ORDER = 6
DISCOUNT = 0.75
CURVE_DOCS = 20_000
PRIOR_WORDS = 5         # words without evidence added to every document
STRONG = 2.0            # a word's evidence that counts as strong
BITMAP_BITS = 1 << 24
LOOKUP_ROWS = 3 << 19   # of a model that is sent to the tasks; a larger one is joined
RUN_BYTES = 4 << 20     # text of a run, or one longer document
SCALE = 1 << 32         # evidence is summed in whole steps of 1 / SCALE, so its order doesn't matter
_START, _END = 2, 3
_EDGE = ".,;:!?\"'()[]#*$%&|<>-"


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, hi, lo) of every 6-gram: three characters of 21 bits in each part."""
    clean = [w.lower().strip(_EDGE) or w for w in words]
    text = "".join(chr(_START) * (ORDER - 1) + w + chr(_END) for w in clean)
    flat = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    size = np.array([len(w) + ORDER for w in clean], np.int64)
    n = len(flat) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    three = flat[:-2] << 42 | flat[1:-1] << 21 | flat[2:]
    word = np.repeat(np.arange(len(clean)), size)
    inside = word[:n] == word[ORDER - 1:]
    return word[:n][inside], three[:n][inside], three[3:n + 3][inside]


def gram_key(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return mix64(mix64(hi.view(np.uint64)) + lo.view(np.uint64))


def batch_words(data: np.ndarray, off: np.ndarray):
    """(document, kind of word) of every kind a document has, and the kinds: a
    document says each of its words once."""
    doc, which, _, kinds = batch_kinds(data, off)
    return doc, which, kinds


def batch_kinds(data: np.ndarray, off: np.ndarray):
    """``batch_words`` with the kinds' hashes before the kinds."""
    doc, start, end = word_spans(data, off)
    kind, first, which = np.unique(span_hash(fold(data), start, end), return_index=True, return_inverse=True)
    once = np.unique(doc * max(len(kind), 1) + which)
    doc, which = once // max(len(kind), 1), once % max(len(kind), 1)
    raw = data.tobytes()
    return doc, which, kind.view(np.int64), [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[first], end[first])]


def _runs(batches, size: int = 1 << 20):
    for b in batches:
        data, off = text_bytes(b.column("text"))
        for x, y in text_groups(off, size):
            yield b.slice(x, y - x), data[off[x]:off[y]], off[x:y + 1] - off[x]


# -- labelled documents -------------------------------------------------------
def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, curve (left out of the counts) of the training documents.

    A fixed-size bitmap of the training ids keeps most other texts out of the
    join's shuffle; the join itself is exact."""
    train = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    train = train.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    text = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("k"), F.xxhash64("text").alias("th"))
    train = (text.select("doc_id", "th").join(train, "doc_id").groupBy("th", "toxic")
             .agg(F.min("doc_id").alias("doc_id")))                         # copies of a text are learnt once
    train = cut_lineage(train)
    found = bitmap(train.select(F.xxhash64("doc_id").alias("k")), BITMAP_BITS)

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array(holds(found, b.column("k").to_numpy())))

    text = map_arrow(text, keep, text.schema)
    return text.join(train, ["doc_id", "th"]).select("text", "toxic", (F.pmod("k", F.lit(8)) == 0).alias("curve"), "k")


def gram_counts(train: DataFrame) -> DataFrame:
    """hi, lo, nt, no: occurrences of every 6-gram in toxic and ordinary texts."""
    def run(batches):
        for b, data, off in _runs(batches):
            doc, which, kinds = batch_words(data, off)
            toxic = b.column("toxic").to_numpy().astype(bool)[doc]
            nt = np.bincount(which[toxic], minlength=len(kinds))
            no = np.bincount(which[~toxic], minlength=len(kinds))
            word, hi, lo = word_grams(kinds)
            order = np.lexsort((lo, hi))
            hi, lo, word = hi[order], lo[order], word[order]
            new = np.ones(len(hi), bool)
            new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            at = np.flatnonzero(new)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hi[at]), pa.array(lo[at]), pa.array(np.add.reduceat(nt[word], at).astype(np.int64)),
                     pa.array(np.add.reduceat(no[word], at).astype(np.int64))], ["hi", "lo", "nt", "no"])

    out = map_arrow(train.select("text", "toxic"), run, "hi bigint, lo bigint, nt bigint, no bigint")
    return out.groupBy("hi", "lo").agg(F.sum("nt").alias("nt"), F.sum("no").alias("no"))


def evidence(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(6-grams, contexts): hi, lo, n, llr of every 6-gram seen, and hi, ctx, n,
    llr of what a context's unseen continuations get."""
    d = F.lit(DISCOUNT)
    char = (1 << 21) - 1
    rows = grams.withColumn("x", F.col("lo").bitwiseAND(F.lit(char))).withColumn("ctx", F.expr("shiftright(lo, 21)"))
    # continuation counts, order 5 down to 1: contexts lose their first character
    masks = [(42, None), (21, None), (0, None), (None, 21), (None, 0)]
    level, tables = rows, []
    for hi_bits, ctx_bits in masks:
        hi = F.col("hi").bitwiseAND(F.lit((1 << hi_bits) - 1)) if hi_bits is not None else F.lit(0)
        ctx = F.col("ctx") if ctx_bits is None else F.col("ctx").bitwiseAND(F.lit((1 << ctx_bits) - 1))
        level = cut_lineage(level.groupBy(hi.cast("bigint").alias("hi"), ctx.cast("bigint").alias("ctx"), "x")
                            .agg(F.count(F.lit(1)).alias("m")))
        tables.append(level)
    total = tables[-1].agg(F.coalesce(F.sum("m"), F.lit(0)).alias("m"), F.count(F.lit(1)).alias("v")).first()
    below = tables[-1].withColumn("p", (F.greatest(F.col("m") - d, F.lit(0)) + d * total["v"] / (total["v"] + 1.0)) / max(total["m"], 1))
    below = below.select("hi", "ctx", "x", "p")
    for k in range(len(tables) - 2, -1, -1):
        hi_bits, ctx_bits = masks[k + 1]
        lo_hi = F.col("hi").bitwiseAND(F.lit((1 << hi_bits) - 1)) if hi_bits is not None else F.lit(0)
        lo_ctx = F.col("ctx") if ctx_bits is None else F.col("ctx").bitwiseAND(F.lit((1 << ctx_bits) - 1))
        sums = tables[k].groupBy("hi", "ctx").agg(F.sum("m").alias("s"), F.count(F.lit(1)).alias("t"))
        row = tables[k].join(sums, ["hi", "ctx"])
        row = row.withColumn("bh", lo_hi.cast("bigint")).withColumn("bc", lo_ctx.cast("bigint"))
        row = row.join(below.toDF("bh", "bc", "x", "pb"), ["bh", "bc", "x"])
        below = row.select("hi", "ctx", "x", ((F.greatest(F.col("m") - d, F.lit(0)) + d * F.col("t") * F.col("pb")) / F.col("s")).alias("p"))
    count = lambda c: F.sum(F.when(F.col(c) > 0, 1).otherwise(0))
    ctx = cut_lineage(rows.groupBy("hi", "ctx").agg(
        F.sum("nt").alias("st"), F.sum("no").alias("so"), count("nt").alias("tt"), count("no").alias("to"),
        F.count(F.lit(1)).alias("t")))
    row = rows.join(ctx, ["hi", "ctx"])
    row = row.withColumn("bh", F.col("hi").bitwiseAND(F.lit((1 << 42) - 1)))
    row = row.join(below.toDF("bh", "ctx", "x", "pb"), ["bh", "ctx", "x"])
    n = F.col("nt") + F.col("no")
    row = row.withColumn("p", (F.greatest(n - d, F.lit(0)) + d * F.col("t") * F.col("pb")) / (F.col("st") + F.col("so")))
    own = lambda c, s, t: F.when(F.col(s) > 0, (F.greatest(F.col(c) - d, F.lit(0)) + d * F.col(t) * F.col("p")) / F.col(s)).otherwise(F.col("p"))
    seen = row.select("hi", "lo", n.alias("n"), (F.log(own("nt", "st", "tt")) - F.log(own("no", "so", "to"))).alias("llr"))
    back = lambda s, t: F.when(F.col(s) > 0, d * F.col(t) / F.col(s)).otherwise(F.lit(1.0))
    unseen = ctx.select("hi", "ctx", (F.col("st") + F.col("so")).alias("n"), (F.log(back("st", "tt")) - F.log(back("so", "to"))).alias("llr"))
    return seen, unseen


def model(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Evidence e, in steps of 1 / SCALE, of all 6-grams (hi, lo) and of all contexts (hi, ctx)."""
    seen, unseen = evidence(cut_lineage(gram_counts(train)))
    step = F.round(F.col("llr") * SCALE).cast("bigint").alias("e")
    return cut_lineage(seen.select("hi", "lo", step)), cut_lineage(unseen.select("hi", "ctx", step))


def lookup(m: tuple[DataFrame, DataFrame], most: int) -> tuple | None:
    """The model as arrays in order of their keys; None if it has more than ``most`` rows."""
    if sum(df.count() for df in m) > most:
        return None
    out = []
    for df in m:
        t = df.toArrow()                    # at most ``most`` rows
        a, b, e = (t.column(i).to_numpy().astype(np.int64) for i in range(3))
        key = gram_key(a, b)
        order = np.argsort(key)
        out.append((key[order], e[order]))
    return tuple(out)


def look_up(words: list[str], arrays: tuple) -> np.ndarray:
    """``word_evidence`` of a list of words from lookup arrays."""
    word, hi, lo = word_grams(words)

    def find(keys, values, key):
        if not len(keys):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return values[at], keys[at] == key

    own, there = find(*arrays[0], gram_key(hi, lo))
    back, known = find(*arrays[1], gram_key(hi, lo >> 21))
    out = np.zeros(len(words), np.int64)
    np.add.at(out, word, np.where(there, own, np.where(known, back, 0)))
    return out


def word_evidence(words: DataFrame, m: tuple[DataFrame, DataFrame]) -> DataFrame:
    """key, e: toxic minus ordinary log-likelihood of every word (key, word; one
    row a key), in steps of 1 / SCALE.  A gram that no text had counts as its
    context's unseen continuations, and for nothing if no text had that either.
    A hot gram is split by the skew join: the model has one row for it."""
    def run(batches):
        for b in batches:
            word, hi, lo = word_grams(b.column("word").to_pylist())
            key = b.column("key").to_numpy()[word]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(hi), pa.array(lo), pa.array(lo >> 21)], ["key", "hi", "lo", "ctx"])

    seen, unseen = m
    grams = map_arrow(words, run, "key bigint, hi bigint, lo bigint, ctx bigint")
    grams = grams.join(seen.withColumnRenamed("e", "own"), ["hi", "lo"], "left")
    grams = grams.join(unseen.withColumnRenamed("e", "back"), ["hi", "ctx"], "left")
    return grams.groupBy("key").agg(F.sum(F.coalesce("own", "back", F.lit(0))).alias("e"))


def document_features(doc: np.ndarray, which: np.ndarray, llr: np.ndarray, n_docs: int) -> np.ndarray:
    """Length-normalised evidence: mean, mean of the strong part, share of
    strong words, strong words (log), strongest word, length (log)."""
    e = llr[which]
    n = np.bincount(doc, minlength=n_docs)
    size = n + PRIOR_WORDS
    strong = np.maximum(e - STRONG, 0)
    count = np.bincount(doc, e > STRONG, n_docs)
    top = np.zeros(n_docs)
    np.maximum.at(top, doc, e)
    return np.column_stack([np.bincount(doc, e, n_docs) / size, np.bincount(doc, strong, n_docs) / size, np.sqrt(count / size),
                            np.log1p(count), np.minimum(top, 12.0), np.log1p(n)])


def word_runs(docs: DataFrame) -> DataFrame:
    """Rows of (doc_id, text) as runs: run, ids, kinds (number of each document),
    places (of each document's kinds among the run's), keys and words of the
    run's kinds.  Written once, as the run's number is only good for one pass."""
    def run(batches):
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 32
        for b, data, off in _runs(batches, RUN_BYTES):
            doc, which, keys, words = batch_kinds(data, off)
            n = np.bincount(doc, minlength=b.num_rows)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (
                b.column("doc_id"), pa.array(n.astype(np.int32)), pa.array(which.astype(np.int32)), pa.array(keys), pa.array(words, pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), *lists], ["run", "ids", "kinds", "places", "keys", "words"])
            at += 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_arrow(docs.select("doc_id", "text"), run,
                    f"run bigint, ids array<{kind}>, kinds array<int>, places array<int>, keys array<bigint>, words array<string>")
    return staged(out, "toxicity-runs")


def with_evidence(runs: DataFrame, m: tuple[DataFrame, DataFrame]) -> DataFrame:
    """run, ids, kinds, places and e, the evidence of every kind of the run."""
    words = runs.select(F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("words").alias("word"))))
    e = word_evidence(words.groupBy("key").agg(F.min("word").alias("word")), m)
    spot = runs.select("run", F.posexplode("keys").alias("pos", "key")).join(e, "key")      # every kind has a row in e
    back = spot.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("pos", "e"))).alias("spots"))   # the kinds of a run
    return runs.select("run", "ids", "kinds", "places").join(back.select("run", F.col("spots.e").alias("e")), "run", "left")


def features(docs: DataFrame, m: tuple[DataFrame, DataFrame], arrays: tuple | None, result, schema: str) -> DataFrame:
    """``result(ids, features)``, arrays by document, over all rows of ``docs``,
    from the lookup arrays or, without them, by joins."""
    if arrays is not None:
        share = docs.sparkSession.sparkContext.broadcast(arrays)        # counted: at most LOOKUP_ROWS

        def run(batches):
            for b, data, off in _runs(batches):
                doc, which, words = batch_words(data, off)
                yield result(b.column("doc_id"), document_features(doc, which, look_up(words, share.value) / SCALE, b.num_rows))
        return map_arrow(docs.select("doc_id", "text"), run, schema)

    def joined(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c).slice(i, 1).flatten() for c in ("ids", "kinds", "places", "e")}
                n = row["kinds"].to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(n)), n)
                e = row["e"].to_numpy(zero_copy_only=False) / SCALE
                yield result(row["ids"], document_features(doc, row["places"].to_numpy(zero_copy_only=False), e, len(n)))
    return map_arrow(with_evidence(word_runs(docs), m).drop("run"), joined, schema)


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> dict:
    """Logistic regression by Newton steps: standardised features, a penalty
    worth a few documents on all but the intercept."""
    ridge = max(1e-3, 4 / len(x))
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, free = np.zeros(z.shape[1]), np.r_[1e-4, np.full(z.shape[1] - 1, ridge)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z / len(z) + np.diag(free)
        step = np.linalg.solve(h, z.T @ (p - y) / len(z) + free * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "scale": scale, "w": w}


def curve(x: np.ndarray, c: dict) -> np.ndarray:
    z = c["w"][0] + ((x - c["mean"]) / c["scale"]) @ c["w"][1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, lookup_rows: int = LOOKUP_ROWS) -> dict:
    """Model and curve from the training rows of ``labels``."""
    train = staged(labelled(docs, labels), "toxicity-train")
    m = model(train.filter("not curve"))
    arrays = lookup(m, lookup_rows)

    def result(toxic, x):
        return pa.RecordBatch.from_arrays([toxic, *[pa.array(v) for v in x.T]], ["toxic", *[f"f{i}" for i in range(x.shape[1])]])

    got = features(train.filter("curve").select(F.col("toxic").alias("doc_id"), "text"), m, arrays, result,
                   "toxic int, " + ", ".join(f"f{i} double" for i in range(6)))
    got = got.orderBy(F.xxhash64("f0", "f1", "f5"), *got.columns).limit(CURVE_DOCS).toArrow()
    y = got.column("toxic").to_numpy().astype(float)
    x = np.column_stack([got.column(f"f{i}").to_numpy() for i in range(6)]) if len(y) else np.zeros((0, 6))
    if len(y) and 0 < y.sum() < len(y):
        return {"model": m, "arrays": arrays, "curve": fit_curve(x, y)}
    return {"share": float(y.mean()) if len(y) else 0.5}


def score(docs: DataFrame, fitted: dict) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if "curve" not in fitted:
        return docs.select("doc_id", F.lit(fitted["share"]).alias("score"))
    shape = fitted["curve"]

    def result(ids, x):
        return pa.RecordBatch.from_arrays([ids, pa.array(curve(x, shape))], ["doc_id", "score"])

    return features(docs, fitted["model"], fitted["arrays"], result, f"doc_id {kind}, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
