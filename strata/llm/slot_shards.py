"""Sharding through a fixed number of virtual slots.

A record's id is hashed into one of ``SLOTS`` virtual slots, for good.  A small
table, the slot map, says which shard holds each slot; it is kept in versions,
and shards only change by edits of it.  ``grow`` adds one shard and hands it an
equal part of the slots, taken from the shards with most slots, so records move
only into the new shard.  ``rebalance`` moves single slots from heavy to light
shards by the bytes that were summed per slot.  Records are never rehashed.

The query follows the law ``key``: the map of n shards is made from that of one
shard by n - 1 growths, so id and shard count alone decide, on any data.  Bytes
per slot are summed and stored with the map; only ``rebalance`` acts on them,
since an edit by bytes would make the shard depend on the other records.

A row's place in its shard is the number of rows in the shard's earlier slots
(slot map order) plus its place inside its slot.  Equal rows (id, size, checksum)
are summed to one with a count before anything is shuffled or ordered, a count
above ``COPIES`` is cut into parts, and a slot is dealt into key ranges of about
``RANGE_ROWS`` rows, so neither a hot id nor a hot slot meets in one task.

Defined cases: null text has 0 bytes and checksum 0; null ids are one id of
their own (apart from the empty string); repeated rows are rows like any other,
all in the shard of their id; rows of one id with unlike texts share its shard;
an empty table gives an empty result; extra columns are not read.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from strata.llm.common import DataFrame, SparkSession, cut_lineage, shared_dir, table

SLOTS = 4096            # never changes for a data set
SHARDS = 24
OVERHEAD = 8            # bytes of a record besides its text
COPIES = 1 << 16        # equal rows that one part holds
RANGE_ROWS = 1 << 16    # parts aimed at in one key range of a slot
MAP = "version int, slot int, shard int, slot_bytes bigint, slot_rows bigint"


# -- the slot map (SLOTS entries) -----------------------------------------------------
def first_map(slots: int = SLOTS) -> np.ndarray:
    """All slots in shard 0."""
    return np.zeros(slots, np.int32)


def grow(shard_of: np.ndarray, new: int) -> np.ndarray:
    """The map with one more shard, ``new``: it takes its equal share of the
    slots, one after the other from the shards that hold most (the latest slot
    of a shard first, the smaller shard at equal heights)."""
    order = np.lexsort((np.arange(len(shard_of)), shard_of))
    owner = shard_of[order]
    first = np.searchsorted(owner, owner)
    height = np.arange(len(order)) - first              # how many slots of its shard lie below
    share = len(shard_of) // (len(np.unique(owner)) + 1)
    out = shard_of.copy()
    out[order[np.lexsort((owner, -height))[:share]]] = new
    return out


def map_for(shards: int, slots: int = SLOTS) -> np.ndarray:
    """The map of a number of shards, grown from one shard."""
    out = first_map(slots)
    for new in range(1, shards):
        out = grow(out, new)
    return out


def rebalance(shard_of: np.ndarray, slot_bytes: np.ndarray, excess: float = 0.02) -> np.ndarray:
    """Edit the map until no shard is more than ``excess`` above the mean, or no
    single slot helps: the heaviest shard hands the lightest one the slot that
    brings the two nearest to each other.  Other slots stay where they are."""
    out, shards = shard_of.copy(), np.unique(shard_of)
    load = np.array([slot_bytes[out == s].sum() for s in shards], np.float64)
    while len(shards) > 1 and load.max() > (1 + excess) * load.mean():
        high, low = int(load.argmax()), int(load.argmin())
        own = np.flatnonzero(out == shards[high])
        gap = load[high] - load[low]
        pick = own[np.argmin(np.abs(gap - 2.0 * slot_bytes[own]))]
        if not 0 < slot_bytes[pick] < gap:
            break
        out[pick] = shards[low]
        load[high] -= slot_bytes[pick]
        load[low] += slot_bytes[pick]
    return out


class SlotMaps:
    """Versions of a slot map, one Parquet folder each under ``path`` (shared
    storage).  A version is written once and never changed; ``SLOTS`` rows each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, version: int, shard_of: np.ndarray, slot_bytes: np.ndarray, slot_rows: np.ndarray) -> DataFrame:
        rows = [(version, i, int(s), int(b), int(r)) for i, (s, b, r) in enumerate(zip(shard_of, slot_bytes, slot_rows))]
        self.spark.createDataFrame(rows, MAP).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/v{version}")
        return self.load(version)

    def load(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP).parquet(f"{self.path}/v{version}")


# -- records -----------------------------------------------------------------------------
def virtual_slot(doc_id: Column, slots: int = SLOTS) -> Column:
    name = F.coalesce(F.concat(F.lit("id:"), doc_id.cast("string")), F.lit("null"))
    return F.pmod(F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(OVERHEAD)).cast("long")


def slot_totals(docs: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, rows) of every virtual slot; ``docs`` has doc_id, size and m (equal
    rows).  At most ``slots`` rows reach the driver."""
    got = (docs.groupBy(virtual_slot(F.col("doc_id"), slots).alias("slot"))
           .agg(F.sum(F.col("size") * F.col("m")).alias("b"), F.sum("m").alias("r")).toArrow())
    out = np.zeros((2, slots), np.int64)
    at = got.column("slot").to_numpy()
    out[0, at], out[1, at] = got.column("b").to_numpy(), got.column("r").to_numpy()
    return out[0], out[1]


def with_shards(docs: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` (any columns) with the columns ``virtual_slot`` and ``shard`` of a
    stored map, without any shuffle: the map has ``slots`` rows."""
    at = slot_map.select(F.col("slot").alias("virtual_slot"), "shard")
    docs = docs.drop("virtual_slot", "shard").withColumn("virtual_slot", virtual_slot(F.col("doc_id"), slots))
    return docs.join(F.broadcast(at), "virtual_slot").select(*docs.columns, "shard")


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, slots: int = SLOTS) -> None:
    """The records themselves, in a folder per shard."""
    with_shards(docs, slot_map, slots).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, m: equal rows summed, at most ``COPIES`` a part."""
    row = docs.select("doc_id", record_size(F.col("text")).alias("size"),
                      F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
    row = row.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("m"))
    row = row.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {COPIES}"))))
    return row.withColumn("m", F.least(F.lit(COPIES).cast("long"), F.col("m") - F.col("part") * COPIES))


def placed(rec: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, shard, slot (its place in the
    shard, gapless from 0), virtual_slot, slot_bytes, map_version."""
    before = lambda *part: (Window.partitionBy(*part[:-1]).orderBy(part[-1])
                            .rowsBetween(Window.unboundedPreceding, -1))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    own = slot_map.select(F.col("slot").alias("virtual_slot"), "shard", "slot_bytes", "slot_rows", F.col("version").alias("map_version"))
    own = own.withColumn("s0", zero(F.sum("slot_rows").over(before("shard", "virtual_slot"))))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("slot_rows") / F.lit(float(RANGE_ROWS))))).cast("int")
    own = cut_lineage(own.withColumn("bits", bits).drop("slot_rows"))
    key = F.conv(F.substring(F.md5(F.concat_ws(":", "doc_id", "size", "text_crc32", "part")), 1, 15), 16, 10).cast("long")
    row = rec.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), slots)).withColumn("key", key)
    row = row.join(F.broadcast(own), "virtual_slot")            # one row per slot
    row = row.withColumn("range", F.expr("shiftright(key, 60 - bits)"))
    ranges = cut_lineage(row.groupBy("virtual_slot", "range").agg(F.sum("m").alias("r")))
    ranges = ranges.select("virtual_slot", "range", zero(F.sum("r").over(before("virtual_slot", "range"))).alias("r0"))
    row = row.join(ranges, ["virtual_slot", "range"])
    inside = (Window.partitionBy("virtual_slot", "range").orderBy("key", "doc_id", "size", "text_crc32", "part")
              .rowsBetween(Window.unboundedPreceding, -1))
    row = row.withColumn("at", F.col("s0") + F.col("r0") + zero(F.sum("m").over(inside)))
    row = row.withColumn("slot", F.explode(F.expr("sequence(at, at + m - 1)")))
    return row.select("doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot", "slot_bytes", "map_version")


def op13_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = cut_lineage(records(table(spark, sf_dir, "documents")))
    size, rows = slot_totals(rec)
    maps = SlotMaps(spark, shared_dir(spark, "llm", "slot-maps"))
    now = map_for(SHARDS)
    kept = maps.save(SHARDS, now, size, rows)
    more = maps.save(SHARDS + 1, grow(now, SHARDS), size, rows)
    out = placed(rec, kept)
    more = more.select(F.col("slot").alias("virtual_slot"), F.col("shard").alias("grown_shard"))
    out = out.join(F.broadcast(more), "virtual_slot")           # one row per slot
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                      "virtual_slot", "slot_bytes", "map_version")
