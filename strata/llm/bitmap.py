"""A filter of fixed size over 64-bit keys, built by a Spark aggregation."""
from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from strata.llm.common import DataFrame


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of fixed size over ``k``: no key of the table is missed."""
    pos = F.pmod("k", F.lit(bits))
    words = (keys.select(F.shiftright(pos, 5).alias("w"), F.pmod(pos, F.lit(32)).cast("int").alias("b"))
             .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1, b)")).alias("m")).toArrow())     # at most bits / 32 rows
    out = np.zeros(bits // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy().astype(np.int64).astype(np.uint32)
    return out


def holds(found: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each key."""
    at = key % (len(found) * 32)
    return (found[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).astype(bool)
