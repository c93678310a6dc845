"""Bit tables of fixed size: which hashes of a distributed set occur, as far as a bounded number of bits can tell."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26  # 2^26 bits are 8 MB; a table with more entries than bits lets everything pass
_BLOCK = 15  # a row holds 2^15 bits


def tables(hashes: DataFrame, column: str, conditions: list[Column], bits: int = BITS) -> Broadcast:
    """One packed table for each condition, with the bits of the hashes (longs) whose rows meet it.

    Whatever the number of rows, 2^bits bits a condition are sent: tasks fill blocks of 4 KB, which are merged on Spark.
    """
    place = F.shiftrightunsigned(column, 64 - bits)
    within = place.bitwiseAND(F.lit((1 << _BLOCK) - 1))
    built = [F.bitmap_construct_agg(F.when(c, within)).alias(f"t{i}") for i, c in enumerate(conditions)]
    rows = hashes.groupBy(F.shiftright(place, _BLOCK).alias("block")).agg(*built)
    out = [np.zeros(1 << max(bits - 3, _BLOCK - 3), np.uint8) for _ in conditions]
    size = 1 << (_BLOCK - 3)
    for row in rows.collect():  # 2^(bits - 15) rows at most
        for table, block in zip(out, row[1:], strict=True):
            table[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(block, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out)


def test(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; always so for the hashes the table was made of."""
    place = hashes.view(np.uint64) >> np.uint64(64 - max(len(table).bit_length() + 2, _BLOCK))
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0
