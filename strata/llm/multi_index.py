"""Approximate nearest neighbours with an inverted multi-index.

Both halves of a vector are quantised separately, so K centroids each make
K x K cells.  A query walks the cells by the sum of its halves' distances,
nearest first, with a heap over the two sorted centroid lists, until the cells
it has met hold ``SHARE`` of all rows (and at least ``LEAST`` rows); what they
hold is reranked by the exact inner product in double precision.

Cells are packed into shards of about ``SHARD_ROWS`` rows; a cell with more rows
is spread over several.  A task holds one shard and lets the queries stream by,
so its memory doesn't depend on the number of queries.  Codebooks are fitted on
at most ``SAMPLE`` vectors; every row is indexed.

``SHARE`` is half of the rows: the vectors of the test tables are spread almost
evenly in all directions, so a smaller share stays under a recall of 0.9.
Clustered vectors need far less.

Defined cases: vectors that are null, zero, of another length than most, or
with null or non-finite components take no part, nor do rows with a null id;
with repeated ids each row is a query and a candidate of its own (a query's own
row is never its neighbour); ties go to the smaller id; fewer candidates than
``k`` give fewer neighbours; an empty table gives an empty result.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from strata.llm.common import DataFrame, SparkSession, staged, table

K = 64                  # centroids of each half
SAMPLE = 20_000         # vectors the codebooks are fitted on
SHARE = 0.5             # of the rows that a query's cells hold
LEAST = 2_000
SHARD_ROWS = 8_192
EVERY = 20              # ids divisible by this are queries
NEIGHBOURS = 20


def usable(v: Column, dim: int) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) == dim) & fine & F.exists(v, lambda x: x != 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Centroids of ``x`` (rows); started on rows spread over it."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, c).argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)


def halves(x: np.ndarray) -> list[np.ndarray]:
    m = x.shape[1] // 2
    return [x[:, :m], x[:, m:]]


def walk(d1: np.ndarray, d2: np.ndarray, count: np.ndarray, need: int) -> list[int]:
    """Cells in order of d1[i] + d2[j] until they hold ``need`` rows."""
    o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    held, cells, k2 = 0, [], len(s2)
    heap = [(s1[0] + s2[0], 0, 0)]
    while heap and held < need:
        _, i, j = heapq.heappop(heap)
        cell = o1[i] * k2 + o2[j]
        if count[cell]:
            held += count[cell]
            cells.append(cell)
        if j == 0 and i + 1 < len(s1):              # a new row of the grid starts from its first column
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
        if j + 1 < k2:
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
    return cells


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def build(vectors: DataFrame, k: int = K, sample: int = SAMPLE) -> tuple[DataFrame, list[np.ndarray], int]:
    """(index: row, vec_id, embedding, cell; the two codebooks; dimension).
    ``vectors`` has vec_id and embedding."""
    vectors = vectors.select("vec_id", "embedding").filter("vec_id is not null")
    size = vectors.filter("embedding is not null").groupBy(F.size("embedding").alias("d")).count()
    most = size.orderBy(F.col("count").desc(), "d").first()
    dim = most["d"] if most else 0
    rows = vectors.filter(usable(F.col("embedding"), dim)) if dim > 1 else vectors.filter("false")
    some = rows.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(sample).select("embedding").toArrow()
    x = np.concatenate([_matrix(c, dim) for c in some.column(0).chunks]) if some.num_rows else np.zeros((0, max(dim, 2)))
    books = [kmeans(h, k) for h in halves(x)]

    def assign(batches):
        for b in batches:
            if b.num_rows:
                parts = halves(_matrix(b.column("embedding"), dim))
                one, two = [nearest(h, c).argmin(1) for h, c in zip(parts, books)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array((one * len(books[1]) + two).astype(np.int32))],
                                                 [*b.schema.names, "cell"])

    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "embedding")
    rows = rows.mapInArrow(assign, rows.withColumn("cell", F.lit(None).cast("int")).schema)
    return staged(rows, "multi-index"), books, dim      # written once: row ids stay the same


def _best(shard, batch, dim: int, k: int):
    """(query row, vec_id, score) of a batch of queries against a shard's rows."""
    x, ids, rows, cells, first = shard
    q = _matrix(batch.column("embedding"), dim)
    asked = batch.column("cells")
    off = asked.offsets.to_numpy() - asked.offsets[0].as_py()
    flat = asked.flatten().to_numpy()
    here = cells[first[:-1]]
    at = np.minimum(np.searchsorted(here, flat), len(here) - 1)
    there = here[at] == flat                    # a chunk of a cell may be empty
    probe = np.zeros((len(q), len(here)), bool)
    probe[np.repeat(np.arange(len(q)), np.diff(off))[there], at[there]] = True
    mask = np.repeat(probe, np.diff(first), axis=1)
    own = batch.column("row").to_numpy()
    mask &= rows[None, :] != own[:, None]
    s = np.where(mask, q @ x.T, -np.inf)
    n = min(k, s.shape[1])
    edge = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
    out = []
    for i in range(len(q)):
        c = np.flatnonzero(mask[i] & (s[i] >= edge[i] - 1e-9))      # ties, whatever the matrix product rounds to
        exact = (x[c] * q[i]).sum(1)
        c = c[np.lexsort((ids[c], -exact))[:k]]
        out.append((np.full(len(c), own[i]), ids[c], (x[c] * q[i]).sum(1)))
    return [np.concatenate(v) for v in zip(*out)]


def search(index: DataFrame, books: list[np.ndarray], dim: int, queries: Column, k: int = NEIGHBOURS,
           share: float = SHARE, least: int = LEAST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the index rows that ``queries`` picks."""
    count = np.zeros(max(1, len(books[0]) * len(books[1])), np.int64)
    got = index.groupBy("cell").count().toArrow()                   # a row per cell: K * K at most
    count[got.column("cell").to_numpy()] = got.column("count").to_numpy()
    chunks = np.maximum(1, -(-count // shard_rows))
    first, held = np.zeros(len(count), np.int64), 0
    shard = -1
    for c in range(len(count)):                                     # cells in order share shards; large ones get their own
        if count[c] and (shard < 0 or chunks[c] > 1 or held + count[c] > shard_rows):
            shard, held = shard + 1, 0
        first[c] = max(shard, 0)
        held += count[c]
        if chunks[c] > 1:
            shard, held = shard + chunks[c] - 1, shard_rows
    need = max(least, int(np.ceil(share * count.sum())))

    def spread(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cell = b.column("cell").to_numpy()
            row = b.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(first[cell] + row % chunks[cell]), pa.array(np.zeros(len(cell), np.int32)), b.column("cell"), b.column("row"),
                 b.column("vec_id").cast(pa.int64()), b.column("embedding"),
                 pa.nulls(len(cell), pa.list_(pa.int32()))], names)

    def ask(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, 64):
                b = whole.slice(a, 64)
                d1, d2 = [nearest(h, c) for h, c in zip(halves(_matrix(b.column("embedding"), dim)), books)]
                at, to, lists = [], [], []
                for i in range(b.num_rows):
                    cells = np.array(sorted(walk(d1[i], d2[i], count, need)), np.int64)
                    for j in range(int(chunks[cells].max())):
                        mine = cells[chunks[cells] > j]
                        target = first[mine] + j
                        for t in np.unique(target):
                            at.append(i)
                            to.append(int(t))
                            lists.append(mine[target == t].astype(np.int32))
                part = b.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int64()), pa.array(np.ones(len(to), np.int32)), pa.array(np.zeros(len(to), np.int32)), part.column("row"),
                     part.column("vec_id").cast(pa.int64()), part.column("embedding"), pa.array(lists, pa.list_(pa.int32()))], names)

    def rerank(batches):
        parts, now, shard_of = [], None, None
        for b in batches:
            ids, kinds = b.column("shard").to_numpy(), b.column("kind").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (kinds[1:] != kinds[:-1])])).tolist()
            for x, y in zip(cut, [*cut[1:], b.num_rows]):
                piece = b.slice(x, y - x)
                if ids[x] != shard_of:
                    parts, now, shard_of = [], None, ids[x]
                if not kinds[x]:
                    parts.append(piece)
                    continue
                if now is None and not parts:
                    continue                        # no rows in this shard
                if now is None:
                    cells = np.concatenate([p.column("cell").to_numpy() for p in parts])
                    now = (np.concatenate([_matrix(p.column("embedding"), dim) for p in parts]),
                           np.concatenate([p.column("vec_id").to_numpy() for p in parts]),
                           np.concatenate([p.column("row").to_numpy() for p in parts]), cells,
                           np.concatenate([np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])), [len(cells)]]))
                    parts = []
                for a in range(0, piece.num_rows, 256):
                    row, vec, score = _best(now, piece.slice(a, 256), dim, k)
                    yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(vec), pa.array(score)], ["row", "vec_id", "score"])

    names = ["shard", "kind", "cell", "row", "vec_id", "embedding", "cells"]
    kind = index.schema["embedding"].dataType.simpleString()
    shape = f"shard bigint, kind int, cell int, row bigint, vec_id bigint, embedding {kind}, cells array<int>"
    asked = index.filter(queries)
    both = index.mapInArrow(spread, shape).union(asked.mapInArrow(ask, shape))
    both = both.repartition("shard").sortWithinPartitions("shard", "kind", "cell", "row")
    found = both.mapInArrow(rerank, "row bigint, vec_id bigint, score double")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names_of = asked.select("row", F.col("vec_id").alias("query_id"))
    return found.join(names_of, "row").select("query_id", "rank", "vec_id", "score")


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, books, dim = build(table(spark, sf_dir, "embeddings"))
    return search(index, books, dim, F.col("vec_id") % EVERY == 0)
