"""Duplicates across loads: a key filter kept beside the table.

Every key sets one bit of its partition's bitmap.  The bitmaps lie in a table of
their own as blocks of 32,768 bits, dealt by (partition, block).  A row of a new
load whose bit is not set has a key that no load before had, and is appended
without a look at the table.  Rows whose bit is set may be repeats: only these
meet the table's key columns, in the partitions they belong to, and an exact join
decides.  So the filter only saves work, it never decides that a row goes.

The bitmaps are written before the rows, so a load that fails in between leaves
bits without rows, which cost a look and lose nothing.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..session import cut_lineage
from ..sources.tables import PART, TableStore, merge_into
from .dedup import latest_per_key
from .joins import keys_match

BLOCK = 1 << 15         # bits of a block; fixed by Spark's bitmap functions
BLOCKS = 1 << 10        # blocks of a partition: 33.5 million bits, 4 MB


class KeyFilter:
    """Filter of one table of ``store``, kept in its table ``<name>__keys``.

    ``blocks`` is the size of a partition's bitmap and stays the same for the
    table's life; about ten bits a key keep nine in ten new rows from the join.
    """

    def __init__(self, store: TableStore, table: str, keys: Sequence[str], blocks: int = BLOCKS):
        self.store, self.keys, self.blocks, self.name = store, list(keys), blocks, f"{table}__keys"

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with its partition as text, block and place in the block."""
        slot = F.pmod(hash_key(*self.keys), F.lit(self.blocks * BLOCK)).cast("long")
        unit = F.coalesce(F.col(PART).cast("string"), F.lit("null"))
        return df.withColumns({"__unit": unit, "__block": F.floor(slot / BLOCK).cast("int"), "__bit": (slot % BLOCK).cast("int")})

    def add(self, df: DataFrame) -> None:
        """Set the bits of the rows' keys; only touched partitions are written."""
        blocks = self.placed(df).groupBy("__unit", "__block").agg(F.bitmap_construct_agg("__bit").alias("bits"))
        # equal rows set equal bits, so a hot key is one block per task before the shuffle

        def merge(old, new):
            return old.unionByName(new).groupBy("unit", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        blocks = blocks.withColumnsRenamed({"__unit": "unit", "__block": "block"})
        merge_into(self.store, self.name, cut_lineage(blocks), merge, F.col("unit"))

    def mark(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__maybe``: false where no load before had the key."""
        have = self.store.read(self.name).select(F.col("unit").alias("__unit"), F.col("block").alias("__block"), "bits")
        byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.expr("cast(pow(2, __bit % 8) as int)")
        maybe = F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))
        return (self.placed(df).join(have, ["__unit", "__block"], "left")
                    .withColumn("__maybe", maybe).drop("__unit", "__block", "__bit", "bits"))


def append_new(store: TableStore, name: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
               partition: Column, blocks: int = BLOCKS) -> dict[str, int]:
    """Append the rows of ``batch`` whose key no load before had.

    Within the batch the greatest row by ``order`` stays (``latest_per_key``).
    Keys are compared null-safely.  ``partition`` is an expression of the key.
    Returns counts: ``keys`` of the batch, ``possible`` repeats that met the
    table, ``repeats`` among them.  An empty batch appends nothing.
    """
    one = cut_lineage(latest_per_key(batch, keys, order).withColumn(PART, partition))
    known = KeyFilter(store, name, keys, blocks)
    if not store.exists(name):
        known.add(one)
        store.publish(one, name, partition_by=[PART])
        return {"keys": one.count(), "possible": 0, "repeats": 0}
    marked = cut_lineage(known.mark(one))
    fresh, ask = marked.filter(~F.col("__maybe")), marked.filter("__maybe")
    parts = {r[0]: r[1] for r in ask.groupBy(F.col(PART).cast("string")).count().collect()}      # partitions
    possible, repeats = sum(parts.values()), 0
    if parts:
        entry = store._entry(name)
        touched = {"__HIVE_DEFAULT_PARTITION__" if p is None else p for p in parts}
        hit = [f for f in entry["folders"] if f.rstrip("/").rsplit(f"/{PART}=", 1)[1] in touched]
        old = store._frame(name, entry, hit).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
        on = keys_match([F.col(k) for k in keys], [F.col(f"__k{i}") for i in range(len(keys))])
        left = cut_lineage(ask.join(old, on, "left_anti"))
        repeats = possible - left.count()
        fresh = fresh.unionByName(left)
    fresh = fresh.drop("__maybe")
    known.add(fresh)
    store.append(fresh, name)
    return {"keys": marked.count(), "possible": possible, "repeats": repeats}
