"""SimHash near-duplicates by deletion-variant signatures (operator 4).

Fingerprints at distance 3 or less, cut into two halves, differ by at most one bit in one of them. Each fingerprint is
filed under each half as it is, and under each half with one bit masked, 66 signatures in all. Two fingerprints with
equal halves meet under the half itself; two whose halves differ in one bit meet where that bit is masked. What meets
is compared in full, and a bucket returns a spanning forest of its links rather than all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.components import components
from orderlens.session import stored

SHINGLE = 3
DISTANCE = 3
SEED = 42
BUCKET = 1 << 15  # fuller buckets are cut again by the bits that they leave open


def _fingerprint(text: str | None, shingle: int, seed: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0)).tolist()
    digest, ends = xxhash.xxh64_intdigest, (ends - 1).tolist()
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :], strict=False)), np.uint64, n)
    out = 0
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        for byte in range(8):  # histogram of byte values, then their bits
            counts = np.bincount(part[:, byte], minlength=256)
            for bit in range(8):
                ones[8 * byte + bit] += counts[_HAS_BIT[bit]].sum()
    for bit in np.flatnonzero(2 * ones > n):
        out |= 1 << int(bit)
    return out


_HAS_BIT = [np.flatnonzero(np.arange(256) >> b & 1) for b in range(8)]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, copy (a hash of the text, tells rows apart that repeat an id) and the 64 bits of each text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((_fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("copy"), pa.array(bits.view(np.int64))], names=["doc_id", "copy", "bits"]
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, copy long, bits long")


def _variants(value: Column, width: int, kind: Column) -> Column:
    """kind 0: the value; kind k: the value with bit k - 1 masked; the kind stands above the bits."""
    masked = value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), (kind - 1).cast("int"))))
    return F.when(kind == 0, value).otherwise(masked) + kind * F.lit(1 << width)


def _signatures(distinct: DataFrame) -> DataFrame:
    """signature, detail (0), bits: 33 variants of either half. The kind, 0 to 32 or 33 to 65, stands above 32 bits."""
    mask = F.lit(0xFFFFFFFF)
    rows = distinct.select("bits", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(65).cast("long"))).alias("k"))
    high, low = F.shiftrightunsigned("bits", 32), F.col("bits").bitwiseAND(mask)
    signature = F.when(F.col("k") < 33, _variants(high, 32, F.col("k"))).otherwise(
        _variants(low, 32, F.col("k") - 33) + F.lit(33 << 32)
    )
    return rows.select(signature.alias("signature"), F.lit(0).cast("long").alias("detail"), "bits")


def _details(full: DataFrame) -> DataFrame:
    """The same rule once more on the half that a full bucket leaves open: two pieces of 16 bits, 17 variants each.
    With 31 bits of one half and 15 of the other fixed, a bucket can hold 2^18 fingerprints at most."""
    is_high = F.shiftrightunsigned("signature", 32) < 33
    rows = full.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(33).cast("long"))))
    free = F.when(is_high, F.col("bits")).otherwise(F.shiftrightunsigned("bits", 32))
    piece_mask = F.lit(0xFFFF)
    high, low = F.shiftrightunsigned(free, 16).bitwiseAND(piece_mask), free.bitwiseAND(piece_mask)
    detail = F.when(F.col("k") < 17, _variants(high, 16, F.col("k"))).otherwise(
        _variants(low, 16, F.col("k") - 17) + F.lit(17 << 16)
    )
    return rows.select("signature", detail.alias("detail"), "bits")


def _forest(signature: int, bits: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect what the bucket's links connect, found by walking from member to member."""
    kind = (signature >> 32) % 33
    a, b = [], []
    rest, queue = bits, []
    while len(rest) or queue:
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        now = queue.pop()
        apart = rest ^ now
        near = np.bitwise_count(apart) <= distance
        if kind:
            shift = np.uint64(kind - 1 + (32 if signature >> 32 < 33 else 0))
            near &= (apart >> shift & np.uint64(1)).astype(bool)
        if near.any():
            found = rest[near]
            a.append(np.full(len(found), now))
            b.append(found)
            queue.extend(found)
            rest = rest[~near]
    return a, b


def _links(filed: DataFrame, distance: int, bucket: int | None) -> DataFrame:
    """a, b for links found in buckets; signature, a and a null b for the members of buckets that are too full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, spilling = None, [], False

        def out(a: list[np.ndarray], b: list[np.ndarray] | None, signature: int) -> pa.RecordBatch:
            first = np.concatenate(a) if a else np.zeros(0, np.uint64)
            second = pa.nulls(len(first), pa.int64()) if b is None else pa.array((np.concatenate(b) if b else first).view(np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), signature, np.int64)), pa.array(first.view(np.int64)), second], names=["signature", "a", "b"]
            )

        for batch in batches:
            signature, detail, bits = (batch.column(i).to_numpy() for i in range(3))
            bits = bits.view(np.uint64)
            new = np.flatnonzero((signature[1:] != signature[:-1]) | (detail[1:] != detail[:-1])) + 1
            edges = np.concatenate([[0], new, [len(batch)]]) if len(batch) else np.zeros(1, np.int64)
            sizes = np.diff(edges)
            a, b = [], []
            inner = np.flatnonzero(sizes > 1)
            for g in sorted({0, len(sizes) - 1} | set(inner.tolist())) if len(sizes) else []:
                members, this = bits[edges[g] : edges[g + 1]], (int(signature[edges[g]]), int(detail[edges[g]]))
                if this != key:
                    if not spilling and sum(map(len, held)) > 1:
                        x, y = _forest(key[0], np.concatenate(held), distance)
                        a, b = a + x, b + y
                    key, held, spilling = this, [], False
                held.append(members)
                if bucket and sum(map(len, held)) > bucket:
                    yield out(held, None, key[0])
                    held, spilling = [], True
                elif spilling:
                    yield out(held, None, key[0])
                    held = []
            yield out(a, b, 0)
        if not spilling and sum(map(len, held)) > 1:
            yield out(*_forest(key[0], np.concatenate(held), distance), 0)

    sorted_ = filed.select("signature", "detail", "bits").repartition("signature", "detail").sortWithinPartitions("signature", "detail")
    return sorted_.mapInArrow(run, "signature long, a long, b long")


def links(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column bits) that join whatever links of at most `distance` bits join."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves bring together distances of 3 at most")
    first = stored(_links(_signatures(distinct), distance, bucket))
    full = first.filter("b is null").select("signature", F.col("a").alias("bits"))
    second = _links(_details(full), distance, None)
    return first.filter("b is not null").select("a", "b").unionByName(second.select("a", "b"))


def _classes(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """doc_id, copy, bits, root (one value for each component) and component_id for every row of docs."""
    rows = stored(fingerprints(docs, shingle, seed))
    distinct = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("least")))
    found = components(links(distinct, distance, bucket))
    linked = distinct.join(found, distinct["bits"] == found["node"]).select("bits", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.join(least, "root").select("bits", "root", "component_id")
    single = distinct.join(stored(classes), "bits", "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")
    )
    return rows.join(stored(single), "bits").select("doc_id", "copy", "bits", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """doc_id, bits and component_id (least doc_id reachable over links) for every row of docs (doc_id, text).

    Words are runs of characters other than space and U+0009 to U+000D, A-Z in lower case. Texts with no more words
    than a shingle are one shingle; null and empty texts have fingerprint zero and link like others. Repeated rows share
    a component; a null id is never a component's least id unless the component has no other. Further columns are
    ignored; an empty table gives no rows.
    """
    return _classes(docs, shingle, distance, seed, bucket).select("doc_id", "bits", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """The rows of docs, with all their columns, of which one of each component is left: the one with the least id (a
    null id is greater than any). Rows equal in id and text leave one. Columns of docs may have any names."""
    least = _classes(docs, shingle, distance, seed, bucket).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")).alias("k"))
    return rows_at(docs, least)


def rows_at(docs: DataFrame, least: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that the keys k (none, doc_id, copy) name; rows equal in id and text leave one."""
    kept = least.select(F.coalesce("k.doc_id", F.lit(0)).alias("id"), F.col("k.none").alias("none"), F.col("k.copy").alias("copy"))
    identity = F.col("doc_id").cast("long")
    key = {"id": F.coalesce(identity, F.lit(0)), "none": identity.isNull(), "copy": F.xxhash64(F.col("text").cast("string"))}
    rows = docs.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in key.items()))
    left = rows.join(kept, list(key)).dropDuplicates(list(key))
    return left.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
