"""Quality rules by distribution divergence.

Plain counts give base rules (too few words, too many repeated 8-word windows).
Every other document's character-class histogram and common-word histogram are
compared with the reference of its language by Jensen-Shannon distance; it is
dropped if it is too far.  Short documents, whose histograms say little, are not
judged by distance.

The references are counted over all documents that pass the base rules: a class
histogram and the ``COMMON`` most common words of every language, joined to the
documents by language, however many languages there are.  A language without a
reference is held against that of all languages together.

Defined cases: null text has no words and fails the base rule; a null language
is a language of its own; repeated rows and null ids are rows like any other;
an empty table gives an empty result; without any reference no document is
dropped by distance.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.llm.common import (DataFrame, SparkSession, cut_lineage, fold, map_arrow, span_hash, staged, table,
                               text_bytes, text_groups, word_spans)

MIN_WORDS = 20           # fewer: base_failed
MAX_REPEAT_PERCENT = 30  # a larger share of repeated words: base_failed
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COMMON = 64              # common words in a language's reference
REFERENCE = ("class_share", "words", "shares")
GUARD_CHARS = 500        # shorter documents aren't judged by characters
GUARD_WORDS = 60         # ... by words
CLASS_LIMIT = 0.30       # Jensen-Shannon distance (0 to 1) above which a document goes
WORD_LIMIT = 0.50

_CLASSES = ["lower", "upper", "digit", "space", "newline", "point", "symbol", "other", "two", "three", "four", "rest"]


def _class_table() -> np.ndarray:
    of = np.full(256, 7, np.uint8)
    of[97:123], of[65:91], of[48:58] = 0, 1, 2
    of[[9, 11, 12, 13, 32]], of[10] = 3, 4
    of[list(b".,;:!?'\"()-")] = 5
    of[list(SYMBOLS)] = 6
    of[0x80:0xC0] = 11          # bytes after the first of a character: not counted
    of[0xC0:0xE0], of[0xE0:0xF0], of[0xF0:] = 8, 9, 10
    return of


_CLASS = _class_table()
N_CLASSES = 11


def _same_before(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """True where the same (doc, key) occurred earlier."""
    order = np.lexsort((key, doc))          # stable: earlier ones first
    d, k = doc[order], key[order]
    out = np.zeros(len(doc), bool)
    out[order[1:]] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    return out


def _in_repeat(doc: np.ndarray, word: np.ndarray, width: int) -> np.ndarray:
    """True for words inside a window of ``width`` words that the document has twice or more."""
    n = len(word)
    if n < width:
        return np.zeros(n, bool)
    key = word[:n - width + 1].copy()
    for j in range(1, width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + word[j:n - width + 1 + j]
    whole = np.flatnonzero(doc[:n - width + 1] == doc[width - 1:])
    d, k = doc[whole], key[whole]
    order = np.lexsort((k, d))
    d, k = d[order], k[order]
    next_same = np.zeros(len(whole) + 1, bool)
    next_same[1:-1] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    twice = whole[order[next_same[1:] | next_same[:-1]]]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + width, -1)
    return np.cumsum(edge[:-1]) > 0


def batch_features(data: np.ndarray, off: np.ndarray):
    """Counts of a run of documents: (dict of arrays, class histograms, words).

    ``words`` is (document, folded word hash) of every word.
    """
    n = len(off) - 1
    doc, start, end = word_spans(data, off)
    count = lambda d, w=None: np.bincount(d, w, n).astype(np.int64)
    cls = _CLASS[data]
    of = np.repeat(np.arange(n), np.diff(off))
    hist = np.bincount(of * 12 + cls, minlength=n * 12).reshape(n, 12)[:, :N_CLASSES]
    exact = span_hash(data, start, end)
    first_bytes = np.concatenate([[0], np.cumsum(cls != 11)])
    # lines with a word: their hash, by document
    line_start = np.union1d(off[:-1], np.flatnonzero(data == 10) + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.concatenate([line_start[1:], [len(data)]]) if len(line_start) else line_start
    ends_nl = np.zeros(len(line_start), bool)
    if len(line_start):
        ends_nl = data[np.maximum(line_end - 1, 0)] == 10
    line_doc = np.searchsorted(off, line_start, "right") - 1
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_doc = line_start[has_word], (line_end - ends_nl)[has_word], line_doc[has_word]
    dup = _same_before(line_doc, span_hash(data, line_start, line_end))
    rep = _in_repeat(doc, exact, WINDOW)
    counts = {"n_words": count(doc), "word_chars": count(doc, first_bytes[end] - first_bytes[start]),
              "n_symbols": hist[:, 6].astype(np.int64), "n_dup_lines": count(line_doc[dup]),
              "n_repeat_words": count(doc[rep])}
    return counts, hist, (doc, span_hash(fold(data), start, end))


def base_failed(c: dict) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def _batches(batches):
    for b in batches:
        data, off = text_bytes(b.column("text"))
        for x, y in text_groups(off):
            yield b.slice(x, y - x), data[off[x]:off[y]], off[x:y + 1] - off[x]


def reference_counts(docs: DataFrame) -> DataFrame:
    """lang, word (a hash; null for a class), class (null for a word), n."""
    def run(batches):
        for b, data, off in _batches(batches):
            counts, hist, (doc, word) = batch_features(data, off)
            langs = b.column("lang").to_pylist()
            code = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            of = np.array([code[x] for x in langs], np.int64)
            ok = ~base_failed(counts)
            rows = []
            for name, i in code.items():
                mine = ok & (of == i)
                if not mine.any():
                    continue
                total = hist[mine].sum(0)
                w, n = np.unique(word[mine[doc]], return_counts=True)
                rows.append((name, w.view(np.int64), n, total))
            if rows:
                lang = [r[0] for r in rows for _ in range(len(r[1]) + N_CLASSES)]
                words = [pa.concat_arrays([pa.array(r[1]), pa.nulls(N_CLASSES, pa.int64())]) for r in rows]
                classes = [pa.concat_arrays([pa.nulls(len(r[1]), pa.int32()), pa.array(np.arange(N_CLASSES, dtype=np.int32))]) for r in rows]
                n = np.concatenate([np.concatenate([r[2], r[3]]) for r in rows]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.concat_arrays(words), pa.concat_arrays(classes), pa.array(n)],
                                                 ["lang", "word", "class", "n"])

    out = map_arrow(docs.select("lang", "text"), run, "lang string, word bigint, class int, n bigint")
    return out.groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))


def references(docs: DataFrame) -> DataFrame:
    """A row per language, null being one of its own, and one over all languages
    (``pooled``): lang, pooled, class_share, words and shares of the ``COMMON``
    most common words in order of their hashes."""
    counts = cut_lineage(reference_counts(docs).withColumn("pooled", F.lit(False)))
    pooled = counts.groupBy("word", "class").agg(F.sum("n").alias("n")).select(
        F.lit(None).cast("string").alias("lang"), "word", "class", "n", F.lit(True).alias("pooled"))
    counts = counts.unionByName(pooled)
    top = Window.partitionBy("pooled", "lang").orderBy(F.col("n").desc(), "word")     # cut to COMMON a task before the shuffle
    words = counts.filter("class is null").withColumn("rn", F.row_number().over(top)).filter(F.col("rn") <= COMMON)
    words = words.groupBy("pooled", "lang").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("common"))
    total = lambda what: F.sum(F.when(what, F.col("n")).otherwise(0))
    sums = counts.groupBy("pooled", "lang").agg(
        F.array(*[total(F.col("class") == k) for k in range(N_CLASSES)]).alias("classes"),
        total(F.col("class").isNotNull()).alias("chars"), total(F.col("class").isNull()).alias("n_words"))
    a, b = sums.alias("a"), words.alias("b")
    row = a.join(b, (F.col("a.pooled") == F.col("b.pooled")) & F.col("a.lang").eqNullSafe(F.col("b.lang")))
    row = row.select("a.lang", "a.pooled",
                     F.transform("classes", lambda n: n / F.col("chars")).alias("class_share"),
                     F.col("common.word").alias("words"),
                     F.transform("common", lambda w: w["n"] / F.col("n_words")).alias("shares"))
    return staged(row.coalesce(1), "divergence-references")       # a row a language


def with_reference(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """doc_id, text, lang and the reference of the document's language (of all
    languages, if its own has none).  The references are a written table, so
    Spark knows their bytes and broadcasts them up to its own limit; beyond it the
    documents are dealt by language, a hot one split by the skew join, as the
    other side has one row a language."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    docs = docs.select("doc_id", "text", lang.alias("lang"))
    name = lambda c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c)))
    own = refs.filter("not pooled").select(name("lang").alias("key"), *REFERENCE)
    every = refs.filter("pooled").select(F.struct(*REFERENCE).alias("r"))          # one row
    row = docs.withColumn("key", name("lang")).join(own, "key", "left").drop("key")
    pooled = every.scalar()
    return row.select("doc_id", "text", "lang", *[F.coalesce(F.col(c), pooled.getField(c)).alias(c) for c in REFERENCE])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (0 to 1) of every row of ``p`` to ``q``."""
    m = (p + q) / 2
    part = lambda x: np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(-1)
    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def distances(hist: np.ndarray, n_words: np.ndarray, words, ref: dict) -> tuple[np.ndarray, np.ndarray]:
    """(class, word) distance of every document to a reference."""
    n = len(hist)
    doc, key = words
    names = np.array(ref["words"], np.int64)
    share = np.array(ref["shares"], float)
    share = np.concatenate([share, [max(0.0, 1 - share.sum())]])
    by_class = js_distance(hist / np.maximum(hist.sum(1, keepdims=True), 1), np.array(ref["class_share"], float))
    at = np.minimum(np.searchsorted(names, key), len(names) - 1)
    slot = np.where(names[at] == key, at, len(names))
    h = np.bincount(doc * len(share) + slot, minlength=n * len(share)).reshape(n, len(share))
    return by_class, js_distance(h / np.maximum(n_words, 1)[:, None], share)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, class_distance, word_distance, kept.
    Without any reference the distances are 0."""
    def run(batches):
        for b, data, off in _batches(batches):
            c, hist, (doc, word) = batch_features(data, off)
            failed = base_failed(c)
            by_class, by_word = np.zeros(len(failed)), np.zeros(len(failed))
            langs = b.column("lang").to_pylist()
            code = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            of = np.array([code[x] for x in langs], np.int64)
            for i in code.values():
                mine = of == i
                first = int(np.argmax(mine))            # equal languages carry equal references
                ref = {k: b.column(k).slice(first, 1).to_pylist()[0] for k in REFERENCE}
                if ref["words"]:
                    place = np.cumsum(mine) - 1
                    pick = mine[doc]
                    by_class[mine], by_word[mine] = distances(
                        hist[mine], c["n_words"][mine], (place[doc[pick]], word[pick].view(np.int64)), ref)
            far = (hist.sum(1) >= GUARD_CHARS) & (by_class > CLASS_LIMIT) | (c["n_words"] >= GUARD_WORDS) & (by_word > WORD_LIMIT)
            cols = [b.column("doc_id"), *[pa.array(c[k]) for k in COUNTS], pa.array(failed), pa.array(by_class), pa.array(by_word),
                    pa.array(~failed & ~far)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *COUNTS, "base_failed", "class_distance", "word_distance", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(with_reference(docs, refs), run, f"doc_id {kind}, {', '.join(f'{k} bigint' for k in COUNTS)}, base_failed boolean, "
                                                      "class_distance double, word_distance double, kept boolean")


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, references(docs.select("lang", "text"))).drop("class_distance", "word_distance")
