"""Contiguous shards of equal bytes from global prefix sums (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import stored

SHARDS = 16


def text_size(text: str | Column = "text") -> Column:
    """UTF-8 bytes and one more for the separator; a null text has no bytes."""
    return F.coalesce(F.octet_length(F.col(text) if isinstance(text, str) else text), F.lit(0)).cast("long") + 1


def text_crc32(text: str = "text") -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def prefix_sums(rows: DataFrame, order: list[str], size: str = "size") -> DataFrame:
    """`rows` with `before` (sum of `size` over all earlier rows) and `index` (how many they are), in the order given.

    The rows are range-partitioned once and written with the sums inside their partition; the partitions' totals, one
    row each, give every partition its start. Rows that agree in all of `order` may come in any order among themselves.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    names = rows.columns
    at = names.index(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, count = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(at).to_numpy()
            sums = total + np.cumsum(sizes)
            index = count + np.arange(len(sizes))
            if len(sizes):
                total, count = int(sums[-1]), count + len(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(sums - sizes), pa.array(index)],
                names=[*names, "_part", "_before", "_index"],
            )

    schema = ranged.withColumns({"_part": F.lit(0), "_before": F.lit(0).cast("long"), "_index": F.lit(0).cast("long")}).schema
    placed = stored(ranged.mapInArrow(run, schema))
    totals = placed.groupBy("_part").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = totals.select(
        "_part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("_bytes0"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_rows0")
    )
    return placed.join(F.broadcast(starts), "_part").select(  # at most spark.sql.shuffle.partitions rows
        *names, (F.col("_bytes0") + F.col("_before")).alias("before"), (F.col("_rows0") + F.col("_index")).alias("index")
    )


def shard(docs: DataFrame, shards: int = SHARDS, carry: bool = True) -> DataFrame:
    """row (the whole input row as a struct; null if `carry` is off, which keeps texts out of the shuffle), doc_id, size, text_crc32, shard and slot for every row of docs.

    Documents stand in the order of doc_id (nulls first, then checksum and size); a document goes to the shard in which
    the middle of its bytes falls when all bytes are cut into `shards` equal stretches. Shards are contiguous, and their
    sizes differ from the equal share by less than the longest document; a document longer than a share may leave a
    neighbouring shard empty. Slots count from 0 in each shard. Repeated rows are placed one after the other. Clashing
    names stay apart inside `row`. An empty table gives no rows.
    """
    rows = docs.select(
        (F.struct("*") if carry else F.lit(None).cast("boolean")).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_size(F.col("text").cast("string")).alias("size"),
        text_crc32().alias("text_crc32"),
    )
    placed = prefix_sums(rows, ["doc_id", "text_crc32", "size"])
    total = placed.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 1
    wide = "decimal(38,0)"
    middle = (F.col("before") * 2 + F.col("size")).cast(wide)
    number = F.least(F.floor(middle * F.lit(shards).cast("decimal(10,0)") / F.lit(2 * total).cast("decimal(20,0)")), F.lit(shards - 1))
    numbered = placed.withColumn("shard", number.cast("int"))
    first = numbered.groupBy("shard").agg(F.min("index").alias("first"))  # one row for each shard
    return numbered.join(F.broadcast(first), "shard").select(
        "row", "doc_id", "size", "text_crc32", "shard", (F.col("index") - F.col("first")).alias("slot")
    )
