"""Jaccard similarity join on word shingles by several global token orders.

Documents with equal shingle sets form a class; classes are joined.  Two sets
with Jaccard at least T share, under any global order of tokens, at least L
tokens of their prefixes of ``n - ceil(T n) + L`` tokens.  Under the first
order every class shuffles only its prefix; classes that share too few tokens
with any other are done.  The rest go through the same filter under a second
order, the rarest tokens among them first; the groups that are connected under
both orders are solved exactly: a breadth-first search in which
a pair is verified on full sets only if it shares prefix tokens under three
orders, and in which a document already reached is not compared again, so a
group of near copies costs little more than its size.  A group that is too
large for one task is solved in chunks; its chunks' main clusters are linked
first, then every document outside the main cluster meets every chunk, so no
link is lost.

Tokens that many documents of a run share come last in every order (any order
gives whole results; this one keeps common passages out of the prefixes), and
their postings are salted.  Shingles are 64-bit hashes.

Defined cases: null and empty texts have empty sets, linked with nothing
(component: their own id); texts with fewer words than a shingle are one
sequence; rows with null ids take part and get the smallest id of their
component, if any; repeated rows and ids are rows like any other; an empty
table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.llm.common import (DataFrame, SparkSession, cut_lineage, discard, fold, free_unused, map_arrow, mix64, shared_dir,
                               span_hash, staged, table,
                               text_bytes, text_groups, word_spans)
from strata.llm.bitmap import bitmap, holds
from strata.llm.components import components

WIDTH = 5
PERCENT = 75
EXTRA = 15              # per cent of a set added to its prefix; as many tokens must then be shared
COMMON_TOKENS = 1 << 16  # tokens listed as common (their order and salt only)
SALTS = 64
BITMAP_BITS = 1 << 24   # fixed size of the filter that finds candidates' texts again
GROUP_TOKENS = 2_000_000  # tokens solved in one task; larger groups are cut into chunks
_SEEDS = [np.uint64(s) for s in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)]


# -- shingle sets ---------------------------------------------------------------
def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document."""
    n = len(off) - 1
    doc, start, end = word_spans(data, off)
    word = span_hash(fold(data), start, end)
    first = np.searchsorted(doc, np.arange(n + 1))
    m = max(0, len(word) - WIDTH + 1)
    key = np.zeros(m, np.uint64)
    for j in range(WIDTH if m else 0):
        key = key * np.uint64(0xD6E8FEB86659FD93) + word[j:m + j]
    key = mix64(key)
    out = []
    for k in range(n):
        a, b = first[k], first[k + 1]
        if b - a >= WIDTH:
            out.append(np.unique(key[a:b - WIDTH + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for w in word[a:b]:
                h = mix64(np.array([h]))[0] ^ w
            out.append(mix64(np.array([h])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_id(tokens: np.ndarray) -> int:
    """64-bit name of a set."""
    if not len(tokens):
        return 0
    return int(mix64(np.array([mix64(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))])).view(np.int64)[0])


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + must_share(n)


def must_share(n: int) -> int:
    return max(1, -(-EXTRA * n // 100))


def prefix(tokens: np.ndarray, order: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of the prefix under a global order, whether each is common)."""
    late = _late(tokens, common)
    key = mix64(tokens ^ _SEEDS[order]) >> np.uint64(1) | late.astype(np.uint64) << np.uint64(63)
    p = min(prefix_size(len(tokens)), len(tokens))
    pick = np.argpartition(key, p - 1)[:p] if p < len(tokens) else np.arange(len(tokens))
    return tokens[pick], late[pick]


def _sets_of(batch: pa.RecordBatch, text: str = "text") -> list[np.ndarray]:
    data, off = text_bytes(batch.column(text))
    out = []
    for a, b in text_groups(off):
        out += shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a])
    return out


# -- passes over the texts ------------------------------------------------------
def _first_pass(batches):
    """Rows of documents (class, size), and rows of tokens that a run of
    documents has often."""
    for b in batches:
        data, off = text_bytes(b.column("text"))
        for x, y in text_groups(off):
            sets = shingle_sets(data[off[x]:off[y]], off[x:y + 1] - off[x])
            part, n = b.slice(x, y - x), y - x
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array([class_id(s) for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.nulls(n, pa.int64())], _FIRST)
            token, count = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
            often = count >= max(4, n // 100)
            token, count = token[often].view(np.int64), count[often]
            k = len(token)
            if k:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(k, b.schema.field("doc_id").type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                     pa.array(count.astype(np.int64)), pa.array(token)], _FIRST)
        del b, data, off, part, sets


_FIRST = ["doc_id", "th", "cls", "n", "token"]


def _posting_batch(tokens, late, cls) -> pa.RecordBatch:
    t, c = np.concatenate(tokens).view(np.int64), np.concatenate(cls)
    salt = np.where(np.concatenate(late), (mix64(c.view(np.uint64)) % np.uint64(SALTS)).astype(np.int32) + 1, 0)
    return pa.RecordBatch.from_arrays([pa.array(t), pa.array(salt.astype(np.int32)), pa.array(c)], ["token", "salt", "cls"])


def _late(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which tokens are common."""
    if not len(common):
        return np.zeros(len(tokens), bool)
    return common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens


def _postings(common: np.ndarray):
    """Prefix postings under the first order, of a class once per task."""
    def run(batches):
        seen = set()
        for b in batches:
            data, off = text_bytes(b.column("text"))
            for x, y in text_groups(off):
                tokens, late, cls = [], [], []
                for s in shingle_sets(data[off[x]:off[y]], off[x:y + 1] - off[x]):
                    c = class_id(s)
                    if len(s) and c not in seen:
                        seen.add(c)
                        p, h = prefix(s, 0, common)
                        tokens.append(p)
                        late.append(h)
                        cls.append(np.full(len(p), c, np.int64))
                if tokens:
                    yield _posting_batch(tokens, late, cls)
            del b, data, off
    return run


def _runs(batches, keys: list[str]):
    """(batch, key columns, whether a run of equal keys starts at each row) of
    sorted batches; a run may go on over batches."""
    last = None
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        n = b.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is None or any(c[0] != x for c, x in zip(cols, last))
        last = [c[-1] for c in cols]
        yield b, cols, new


def _stars(batches):
    """Sorted postings (grp, token, salt, cls) -> (cls, pivot, grp, token, salt):
    every class of a run with the run's first class.  A run of one class gives
    nothing, unless it is salted (other salts may hold more)."""
    pivot = last = 0                # of the run that the batch before ended in
    for b, (grp, token, salt), new in _runs(batches, ["grp", "token", "salt"]):
        cls = b.column("cls").to_numpy()
        mine = np.concatenate([[pivot], cls[new]])[np.cumsum(new)]
        before = np.concatenate([[last], cls[:-1]])
        more = ~new & (cls != before)
        second = more & (before == mine) & (salt == 0)      # now the first class is shared too
        give = more | new & (salt > 0)
        at = np.concatenate([np.flatnonzero(give), np.flatnonzero(second)])
        who = np.concatenate([cls[give], mine[second]])
        pivot, last = mine[-1], cls[-1]
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (who, mine[at], grp[at], token[at], salt[at])],
                                             ["cls", "pivot", "grp", "token", "salt"])


def star_edges(postings: DataFrame) -> DataFrame:
    """(cls, pivot, shared, bridge): classes tied to a pivot of each block they
    share, with the number of shared tokens; a bridge ties the pivots of a salted
    token's runs.  ``postings`` has grp, token, salt, cls."""
    flat = (postings.repartition("grp", "token", "salt").sortWithinPartitions("grp", "token", "salt", "cls")
            .select("grp", "token", "salt", "cls"))
    star = map_arrow(flat, _stars, "cls bigint, pivot bigint, grp bigint, token bigint, salt int")
    star = cut_lineage(star.groupBy("cls", "pivot", F.when(F.col("salt") > 0, F.struct("grp", "token")).alias("late"))
                       .agg(F.count(F.lit(1)).alias("shared")))
    # the pivots of a salted token's runs meet at the smallest of them
    late = star.filter("late is not null").select("late", "pivot").distinct()
    tops = late.groupBy("late").agg(F.min("pivot").alias("top"))
    late = late.join(tops, "late").select(F.col("pivot").alias("cls"), F.col("top").alias("pivot"), F.lit(0).cast("bigint").alias("shared"), F.lit(True).alias("bridge"))
    return (star.select("cls", "pivot", "shared", F.lit(False).alias("bridge")).union(late).groupBy("cls", "pivot")
            .agg(F.sum("shared").alias("shared"), F.max("bridge").alias("bridge")))


def _ties(edges: DataFrame, alive: DataFrame) -> DataFrame:
    """Edges of the classes that share enough.  Bridges stay whatever their pivot
    shares: the classes of its run meet those of other runs only through them."""
    edges = edges.filter("cls <> pivot")
    return edges.filter("bridge").union(edges.filter("not bridge").join(alive, "cls", "left_semi").select(*edges.columns))


def rare_first(postings: DataFrame, sizes: DataFrame) -> DataFrame:
    """The postings of each class's prefix when tokens are ordered by the number
    of classes that have them (salted ones last).  ``postings`` has all tokens.
    Tokens of one class alone come first and need no posting: they only use up
    their part of the prefix."""
    block, own = Window.partitionBy("token", "salt"), Window.partitionBy("cls")
    df = F.when(F.col("salt") > 0, F.lit(1 << 40)).otherwise(F.count(F.lit(1)).over(block))
    row = postings.withColumn("df", df).filter("df > 1").join(sizes, "cls")
    row = row.withColumn("s", F.count(F.lit(1)).over(own))
    row = row.withColumn("rn", F.row_number().over(own.orderBy("df", F.xxhash64("token"), "token")))
    n = F.col("n")
    must = F.greatest(F.lit(1), F.ceil(n * EXTRA / F.lit(100.0)))
    size = n - F.ceil(n * PERCENT / F.lit(100.0)) + must
    return row.filter(F.col("rn") <= size - (n - F.col("s"))).select("token", "salt", "cls")


def _enough(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Classes that share as many prefix tokens as a link needs: cls.

    A partner has at least T n tokens, so its prefix asks for EXTRA * T n."""
    need = F.greatest(F.lit(1), F.ceil(F.col("n") * EXTRA * PERCENT / F.lit(10000.0)))
    got = edges.groupBy("cls").agg(F.sum("shared").alias("shared"))
    return got.join(sizes, "cls").filter(F.col("shared") >= need).select("cls")


def _candidate_sets(found: np.ndarray):
    def run(batches):
        seen = set()
        for b in batches:
            hit = np.flatnonzero(holds(found, b.column("k").to_numpy()))
            for a in range(0, len(hit), 256):
                part = b.take(pa.array(hit[a:a + 256]))
                new = {class_id(s): s for s in _sets_of(part)}
                new = {c: s for c, s in new.items() if len(s) and c not in seen}
                seen.update(new)
                sets = list(new.values())
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(new), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(flat))], ["cls", "tokens"])
            del b
    return run


# -- exact solution of a group --------------------------------------------------
class _Group:
    """Sets of one group, with prefix postings under three orders."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.n)])
        name, tok = np.unique(np.concatenate(sets), return_inverse=True)
        self.tok = tok.astype(np.int32)
        self.flag = np.zeros(len(name), bool)
        df = np.bincount(self.tok, minlength=len(name)).astype(np.uint64)
        self.pre, self.left = [], np.arange(len(sets))
        for order, seed in enumerate(_SEEDS):
            h = mix64(name ^ seed) >> np.uint64(24)
            if order == 2:                          # the third order: rare tokens first
                h |= np.minimum(df, np.uint64((1 << 23) - 1)) << np.uint64(40)
            parts = []
            for k in range(len(sets)):
                t = self.tok[self.off[k]:self.off[k + 1]]
                p = min(len(t), int(self.n[k] - -(-PERCENT * self.n[k] // 100) + 1))
                parts.append(t[np.argpartition(h[t], p - 1)[:p]] if p < len(t) else t)
            self.pre.append(parts)
        self._index()

    def _index(self) -> None:
        """Postings of the documents that aren't reached yet."""
        self.post, self.built = [], len(self.left)
        for parts in self.pre:
            tok = np.concatenate([np.zeros(0, np.int32), *[parts[k] for k in self.left]])
            doc = np.repeat(self.left.astype(np.int32), [len(parts[k]) for k in self.left])
            order = np.argsort(tok, kind="stable")
            self.post.append((doc[order], np.concatenate([[0], np.cumsum(np.bincount(tok, minlength=len(self.flag)))])))

    def drop(self, gone: np.ndarray) -> None:
        self.left = np.setdiff1d(self.left, gone, assume_unique=True)
        if 2 * len(self.left) < self.built and self.built > 32:
            self._index()

    def links(self, k: int, among: np.ndarray) -> np.ndarray:
        """Documents of the mask ``among`` that are linked with ``k``."""
        ok = among.copy()
        ok[k] = False
        nk = self.n[k]
        ok &= (100 * np.minimum(self.n, nk) >= PERCENT * np.maximum(self.n, nk)) & (self.n > 0)
        for parts, (doc, at) in zip(self.pre, self.post):
            t = parts[k]
            size = at[t + 1] - at[t]
            ends = np.cumsum(size)
            near = np.zeros(len(ok), bool)
            if len(ends) and ends[-1]:
                near[doc[np.arange(ends[-1]) + np.repeat(at[t] - ends + size, size)]] = True
            ok &= near
        cand = np.flatnonzero(ok)
        if not len(cand):
            return cand
        mine = self.tok[self.off[k]:self.off[k + 1]]
        self.flag[mine] = True
        size = self.n[cand]
        ends = np.cumsum(size)
        hit = self.flag[self.tok[np.arange(ends[-1]) + np.repeat(self.off[cand] - ends + size, size)]]
        both = np.add.reduceat(hit.astype(np.int64), ends - size)
        self.flag[mine] = False
        return cand[100 * both >= PERCENT * (size + nk - both)]


def solve(sets: list[np.ndarray]) -> np.ndarray:
    """Label (index of the first document) of every document's component."""
    label = np.arange(len(sets))
    if len(sets) < 2:
        return label
    g, free = _Group(sets), np.ones(len(sets), bool)
    for k in range(len(sets)):
        if not free[k]:
            continue
        free[k] = False
        front = [k]
        g.drop(np.array([k]))
        while front:
            got = g.links(front.pop(), free)
            if len(got):
                free[got], label[got] = False, k
                front += got.tolist()
                g.drop(got)
    return label


def probe(sets: list[np.ndarray], root: np.ndarray, is_probe: np.ndarray) -> list[tuple[int, int]]:
    """Root pairs that a link between a probe and another document joins."""
    g = _Group(sets)
    out = set()
    for k in np.flatnonzero(is_probe):
        among = root != root[k]
        for j in g.links(k, among):
            out.add((int(min(root[k], root[j])), int(max(root[k], root[j]))))
    return sorted(out)


def _grouped(batches, keys: list[str]):
    """Whole groups of sorted batches: (columns but ``tokens`` as arrays, sets)."""
    parts: list[pa.RecordBatch] = []

    def group():
        cols = {c: np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts])
                for c in parts[0].schema.names if c != "tokens"}
        return cols, [s for p in parts for s in _sets_in(p.column("tokens"))]

    for b, _, new in _runs(batches, keys):
        at = [*np.flatnonzero(new).tolist(), b.num_rows]
        if at[0] > 0:
            parts.append(b.slice(0, at[0]))
        for x, y in zip(at, at[1:]):
            if parts:
                yield group()
            parts = [b.slice(x, y - x)]
    if parts:
        yield group()
    parts.clear()


def _sets_in(column: pa.ListArray) -> list[np.ndarray]:
    off, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
    return [flat[a:b] for a, b in zip(off, off[1:])]


def _solve_groups(batches):
    for cols, sets in _grouped(batches, ["grp", "chunk"]):
        root = cols["cls"][solve(sets)]
        yield pa.RecordBatch.from_arrays([*[pa.array(cols[c]) for c in ("grp", "chunk", "cls")], pa.array(root)],
                                         ["grp", "chunk", "cls", "root"])


def _probe_groups(batches):
    for cols, sets in _grouped(batches, ["grp", "chunk", "part"]):
        got = probe(sets, cols["root"], cols["probe"].astype(bool))
        if got:
            a, b = zip(*got)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _relabel(row: DataFrame, edges: DataFrame) -> DataFrame:
    lab = components(edges).toDF("root", "top")
    return row.join(lab, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")


def exact_roots(sets: DataFrame, groups: DataFrame, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(cls, root) of candidates.  ``sets`` has cls, tokens; ``groups`` has cls,
    grp and n (tokens).  Links are only looked for inside a group."""
    size = groups.groupBy("grp").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    size = size.select("grp", F.greatest(F.lit(1), F.ceil(F.col("t") / F.lit(float(group_tokens)))).cast("int").alias("chunks"))
    where = groups.select("cls", "grp").join(size, "grp")
    where = cut_lineage(where.withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")))
    row = sets.join(where, "cls").select("grp", "chunk", "chunks", "cls", "tokens")
    order = ["grp", "chunk"]
    flat = row.drop("chunks").repartition(*order).sortWithinPartitions(*order, "cls")
    solved = map_arrow(flat, _solve_groups, "grp bigint, chunk int, cls bigint, root bigint")
    solved = cut_lineage(solved.groupBy("cls").agg(*[F.min(c).alias(c) for c in ("grp", "chunk", "root")]))
    if size.filter("chunks > 1").isEmpty():
        return solved.select("cls", "root")
    big = row.filter("chunks > 1").dropDuplicates(["cls"])
    root = solved.join(where.filter("chunks > 1").select("cls"), "cls")
    # 1. the main cluster of every chunk sends one document to all chunks of its group
    count = root.groupBy("grp", "chunk", "root").agg(F.count(F.lit(1)).alias("m"), F.min("cls").alias("cls"))
    main = count.groupBy("grp", "chunk").agg(F.max_by("cls", F.struct("m", "cls")).alias("cls")).select("cls")
    root = cut_lineage(_relabel(root, _probe_edges(big, root, main, group_tokens)))
    # 2. every document outside the group's main cluster meets all chunks
    count = root.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("m"))
    main = count.groupBy("grp").agg(F.max_by("root", F.struct("m", "root")).alias("main"))
    rest = root.join(main, "grp").filter("root <> main").select("cls")
    root = cut_lineage(_relabel(root, _probe_edges(big, root, rest, group_tokens)))
    done = root.select("cls", "root")
    small = solved.join(done.select("cls"), "cls", "left_anti").select("cls", "root")
    return small.union(done)


def _probe_edges(big: DataFrame, root: DataFrame, probes: DataFrame, group_tokens: int) -> DataFrame:
    """Root pairs joined by links between ``probes`` and all documents of their
    groups.  Probes are dealt into parts that fit beside a chunk."""
    row = big.join(root.select("cls", "root"), "cls")
    asks = row.join(probes, "cls", "left_semi")
    parts = (asks.groupBy("grp").agg(F.sum(F.size("tokens")).alias("t"))
             .select("grp", F.ceil(F.col("t") / F.lit(float(group_tokens))).cast("int").alias("parts")))
    asks = (asks.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("parts")).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    docs = row.join(parts, "grp").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cols = ["grp", "chunk", "part", "cls", "root", "tokens"]
    both = asks.select(*cols, F.lit(True).alias("probe")).union(docs.select(*cols, F.lit(False).alias("probe")))
    both = both.repartition("grp", "chunk", "part").sortWithinPartitions("grp", "chunk", "part", "cls", "probe")
    return cut_lineage(map_arrow(both, _probe_groups, "a bigint, b bigint").distinct())


def most_frequent(counts: DataFrame, k: int) -> np.ndarray:
    """The ``k`` tokens of ``counts`` (token, n) with the largest n, of equal ones the
    smallest, as sorted unsigned numbers.

    A sort with a limit would send ``k`` rows of every partition to the driver.  Here
    it gets row counts by 16 bits of (n, token) at a time, and then only the rows
    before the place in which row ``k`` lies and those in it, 2 * k at most."""
    low = F.lit(0xFFFF)
    places = [low - F.shiftright("n", s).bitwiseAND(low) for s in (48, 32, 16, 0)]
    places += [F.shiftright("token", 48) + 0x8000] + [F.shiftright("token", s).bitwiseAND(low) for s in (32, 16, 0)]
    most, rows = counts.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    take, open_, before = F.lit(False), F.lit(True), 0      # rows taken, rows still to be told apart
    for place in places[sum(int(most) >> s == 0 for s in (48, 32, 16)):]:
        if before + rows <= 2 * k:
            break
        hist = counts.filter(open_).groupBy(place.alias("p")).count().toArrow().sort_by("p")     # 65,536 rows at most
        p, m = hist.column("p").to_numpy(), hist.column("count").to_numpy()
        ends = before + np.cumsum(m)
        at = int(np.searchsorted(ends, k))
        take, open_ = take | open_ & (place < F.lit(int(p[at]))), open_ & (place == F.lit(int(p[at])))
        before, rows = int(ends[at] - m[at]), int(m[at])
    got = counts.filter(take | open_).select("token", "n").toArrow()
    token, n = got.column("token").to_numpy(), got.column("n").to_numpy()
    return np.sort(token[np.lexsort((token, -n))[:k]].view(np.uint64))


# -- the join -------------------------------------------------------------------
def similar_components(docs: DataFrame, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, cls (equal for equal sets),
    root (equal inside a component) and component_id of every row of ``docs``
    (doc_id, text)."""
    docs = docs.select("doc_id", "text").withColumn("th", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    first = staged(map_arrow(docs, _first_pass, f"doc_id {kind}, th bigint, cls bigint, n bigint, token bigint"), "shingles")
    meta = first.filter("token is null").drop("token")
    often = shared_dir(docs.sparkSession, "llm", "often")
    common = most_frequent(staged(first.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n")), "often", often), COMMON_TOKENS)
    discard(docs.sparkSession, often)
    classes = cut_lineage(meta.filter("n > 0").groupBy("cls").agg(
        F.min("n").alias("n"), F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "th")).alias("rep")))
    sizes = classes.select("cls", "n")

    # first order: all documents
    posts = map_arrow(docs.select("text"), _postings(common), "token bigint, salt int, cls bigint")
    edges = cut_lineage(star_edges(posts.withColumn("grp", F.lit(0).cast("bigint"))))
    free_unused(docs.sparkSession)
    alive = cut_lineage(_enough(edges, sizes))
    key = F.xxhash64("doc_id", "th")
    reps = alive.join(classes, "cls").select(F.xxhash64(F.col("rep.doc_id"), F.col("rep.th")).alias("k"))
    sets = map_arrow(docs.select(key.alias("k"), "text"), _candidate_sets(bitmap(reps, BITMAP_BITS)), "cls bigint, tokens array<bigint>")
    texts = shared_dir(docs.sparkSession, "llm", "candidates")
    sets = staged(sets.dropDuplicates(["cls"]), "candidates", texts)
    edges = _ties(edges, alive)
    one = components(edges, "cls", "pivot").toDF("cls", "one")
    free_unused(docs.sparkSession)

    # second order: rare tokens first, by their counts among the candidates
    def every(batches):
        for b in batches:
            cls = b.column("cls").to_numpy()
            out = _sets_in(b.column("tokens"))
            for x in range(0, len(out), 256):
                part = out[x:x + 256]
                yield _posting_batch(part, [_late(t, common) for t in part], [np.full(len(t), c, np.int64) for t, c in zip(part, cls[x:x + 256])])

    posts = map_arrow(sets, every, "token bigint, salt int, cls bigint")
    edges = cut_lineage(star_edges(rare_first(posts, sizes).withColumn("grp", F.lit(0).cast("bigint"))))
    free_unused(docs.sparkSession)
    alive = _enough(edges, sizes)
    edges = _ties(edges, alive)
    two = components(edges, "cls", "pivot").toDF("cls", "two")
    free_unused(docs.sparkSession)
    # a linked pair is connected under both orders
    groups = one.join(two, "cls").join(sizes, "cls").select("cls", F.xxhash64("one", "two").alias("grp"), "n")
    roots = exact_roots(sets, groups, group_tokens)

    top = (classes.select("cls", "first").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")))
    low = top.groupBy("root").agg(F.min("first").alias("component_id"))
    top = cut_lineage(top.join(low, "root").select("cls", "root", "component_id"))
    discard(docs.sparkSession, texts)
    out = meta.join(top, "cls", "left")     # a hot class is split by the skew join: its other side has one row
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), "cls", "root",
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id
    (null ids last), then text hash.  Rows without shingles all stay.

    Only rows that may go are shuffled with their texts: a bitmap of fixed size
    keeps all others out of the exact join."""
    found = cut_lineage(similar_components(docs).filter("n_shingles > 0")
                        .select("root", "doc_id", "th", F.xxhash64("doc_id", "th").alias("k")))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "th")
    first = found.groupBy("root").agg(F.min(rank).alias("first"))
    keys = found.groupBy("root", "k", "th").agg(F.count(F.lit(1)).alias("m"), F.min(rank).alias("rank"))
    keys = cut_lineage(keys.join(first, "root").withColumn("goes", F.col("rank") > F.col("first"))
                       .filter("goes or m > 1").select("k", "th", "goes"))
    maybe = bitmap(keys, BITMAP_BITS)

    def flag(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(holds(maybe, b.column("k").to_numpy()))], [*b.schema.names, "maybe"])

    row = docs.select(F.struct(*docs.columns).alias("doc")).withColumn("th", F.xxhash64("doc.text"))
    row = row.withColumn("k", F.xxhash64("doc.doc_id", "th"))
    row = map_arrow(row, flag, row.withColumn("maybe", F.lit(True)).schema)
    row = staged(row, "near-duplicates")
    asked = row.filter("maybe").join(keys, ["k", "th"], "left").filter("goes is null or not goes")
    again = asked.filter("goes is not null").dropDuplicates(["k", "th"])      # repeated rows of the one that stays
    rest = row.filter("not maybe").select("doc").union(asked.filter("goes is null").select("doc")).union(again.select("doc"))
    return rest.select("doc.*")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
