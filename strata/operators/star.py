"""Star schema: dimensions with surrogate keys, fact build, aggregate marts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key, wide_key
from ..functions.money import cents, round_avg_cents
from ..session import cut_lineage
from .dedup import latest_per_key
from .joins import keys_match

_ROW_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row index


def dense_key(df: DataFrame, order_cols: Sequence[str], name: str, start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Consecutive keys ``start, start+1, ...`` in ``order_cols`` order
    (``row_number() over (order by ...) - 1 + start``) without a
    single-partition window.

    Range-partition and sort by the order columns, stamp each row with its
    (partition, position), and checkpoint so the layout is fixed (range bounds
    come from sampling and would differ on recomputation).  Per-partition
    counts - one row per partition, a proven bound - give each partition's
    offset; the key is offset + position.  ``order_cols`` must be unique.
    """
    order_cols = list(order_cols)
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    staged = (df.repartitionByRange(parts, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("__mid", F.monotonically_increasing_id()))
    staged = cut_lineage(staged)
    pid = F.shiftright(F.col("__mid"), _ROW_BITS)
    # one row per partition: the collected list is bounded by `parts`
    counts = sorted((r["__pid"], r["n"]) for r in
                    staged.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, run = [], 0
    for p, n in counts:
        offsets.append((p, run))
        run += n
    schema = "__pid long, __off long"
    off_df = F.broadcast(df.sparkSession.createDataFrame(offsets or [(0, 0)], schema))
    pos = F.col("__mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (staged.join(off_df, pid == F.col("__pid"), "left")
                  .withColumn(name, (F.col("__off") + pos + F.lit(start)).cast("long"))
                  .drop("__mid", "__pid", "__off"))


def build_dimension(df: DataFrame, natural_key: Sequence[str], attrs: Sequence[str],
                    sk: str, *, order: Sequence[str] | None = None,
                    key: str = "dense", rename: dict[str, str] | None = None) -> DataFrame:
    """Project the dimension columns, keep one row per natural key (latest by
    ``order``, deterministic), add surrogate key ``sk``.

    ``key='dense'`` gives consecutive integers ordered by the natural key;
    ``key='hash'`` gives a null-safe 64-bit hash of the natural key, computed
    row-locally (no shuffle) and reproducible in any table that needs it;
    ``key='wide'`` the same in 128 bits, for tables of very many keys.
    """
    natural_key, attrs = list(natural_key), list(attrs)
    proj = df.select(*[F.col(c) for c in natural_key + [a for a in attrs if a not in natural_key]])
    if order is not None or len(proj.columns) > len(natural_key):
        proj = latest_per_key(proj, natural_key, list(order or []))
    else:
        proj = proj.dropDuplicates()
    if key == "dense":
        out = dense_key(proj, natural_key, sk)
    elif key == "hash":
        out = proj.withColumn(sk, hash_key(*natural_key))
    elif key == "wide":
        out = proj.withColumn(sk, wide_key(*natural_key))
    else:
        raise ValueError("key must be 'dense', 'hash' or 'wide'")
    if rename:
        out = out.withColumnsRenamed(rename)
    return out


def extend_dimension(old: DataFrame, now: DataFrame, natural_key: Sequence[str], sk: str) -> DataFrame:
    """The dimension after another load: rows of ``now`` (natural key and
    attributes, one row per key) keep the key they have in ``old``; keys new in
    ``now`` continue from the greatest, in natural-key order; rows gone from
    ``now`` stay as they were."""
    natural_key = list(natural_key)
    attrs = [c for c in old.columns if c not in natural_key and c != sk]
    o, n = old.select(F.struct(*old.columns).alias("__o")), now.select(F.struct(*natural_key, *attrs).alias("__n"))
    on = keys_match([F.col(f"__o.`{k}`") for k in natural_key], [F.col(f"__n.`{k}`") for k in natural_key])
    both = cut_lineage(o.join(n, on, "full_outer"))     # read for the known and for the new keys
    known = both.filter("__o is not null").select(
        *[F.col(f"__o.`{k}`").alias(k) for k in natural_key],
        *[F.when(F.col("__n").isNotNull(), F.col(f"__n.`{c}`")).otherwise(F.col(f"__o.`{c}`")).alias(c) for c in attrs],
        F.col(f"__o.`{sk}`").alias(sk))
    fresh = both.filter("__o is null").select("__n.*")
    top = old.agg(F.max(sk).alias("m")).first()["m"]
    fresh = dense_key(fresh, natural_key, sk, start=0 if top is None else top + 1)
    return known.unionByName(fresh)


def require_distinct_keys(df: DataFrame, natural_key: Sequence[str], sk: str, what: str) -> None:
    """Raise if a surrogate key occurs twice, and say why: the natural key is
    repeated, or two natural keys met in one surrogate key.

    Only the first half of each key and a count are shuffled; rows are looked at
    with their natural keys only where a first half comes more than once."""
    half = F.substring(sk, 1, 16)
    twice = df.groupBy(half.alias("__h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__h")
    if twice.isEmpty():
        return
    near = df.select(sk, F.struct(*natural_key).alias("__k"), half.alias("__h")).join(twice, "__h", "left_semi")
    same = near.groupBy(sk).agg(F.count(F.lit(1)).alias("n"), F.min("__k").alias("a"), F.max("__k").alias("b")).filter("n > 1")
    row = same.orderBy(F.col("a").eqNullSafe(F.col("b")), sk).first()
    if row is None:
        return
    if row["a"] == row["b"]:
        raise ValueError(f"the {what} holds key {list(row['a'])} {row['n']} times; deduplicate it first")
    raise ValueError(f"keys {list(row['a'])} and {list(row['b'])} of the {what} have the same {sk}")


def attach_keys(fact: DataFrame, dims: Sequence[tuple], *, check_fanout: bool = False) -> DataFrame:
    """Left-join the fact to each dimension to pick up its surrogate key.

    ``dims`` holds ``(dim_df, fact_cols, dim_cols, sk)``.  Each dim is reduced
    to key columns + sk before joining (column pruning reaches its scan); the
    join strategy is left to the optimiser (broadcast when AQE sees a small
    dim, skew-split sort-merge otherwise).  With ``check_fanout`` an extra
    pass asserts no dimension key repeats, so the fact cannot multiply rows.
    """
    out = fact
    for i, (dim, fcols, dcols, sk) in enumerate(dims):
        fcols, dcols = list(fcols), list(dcols)
        d = dim.select(*[F.col(c).alias(f"__d{i}_{j}") for j, c in enumerate(dcols)], F.col(sk))
        if check_fanout:
            dup = d.groupBy(*[f"__d{i}_{j}" for j in range(len(dcols))]).count().filter("count > 1")
            if not dup.isEmpty():
                raise ValueError(f"dimension for {sk} repeats a join key: fact rows would fan out")
        cond = None
        for j, c in enumerate(fcols):
            t = out[c] == d[f"__d{i}_{j}"]
            cond = t if cond is None else cond & t
        out = out.join(d, cond, "left").drop(*[f"__d{i}_{j}" for j in range(len(dcols))])
    return out


def money_avg(c) -> Column:
    """Exact ``round(avg(c), 2)`` via whole cents (identical in every engine)."""
    return round_avg_cents(F.sum(cents(c)), F.count(c))


def money_sum(c) -> Column:
    return F.sum(cents(c)) / F.lit(100)


def group_summary(df: DataFrame, by: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Aggregate mart: ``groupBy(by).agg(measures)`` (partial aggregation)."""
    return df.groupBy(*by).agg(*[m.alias(n) for n, m in measures.items()])
