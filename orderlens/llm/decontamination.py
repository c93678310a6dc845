"""Benchmark decontamination by size-partitioned MinHash containment search (operator 8).

Items are partitioned by their number of shingles, in powers of two. Within a partition every item keeps its least
hashes, as many as a document can lack and still contain `containment` of the partition's largest item, plus one. A
document that contains an item therefore holds at least one hash of its sketch: the search loses nothing. Documents
show all their shingles below the partition's largest sketch value. Whoever meets is verified on the words themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import words as w

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_WORDS = 2_000_000  # words of items that are searched for in one pass over the documents

_LOWER = w.BYTE_VALUES[w.LOWER]


@dataclass
class Sketches:
    """Sketch hashes of a block's items, sorted, for one shingle length and size partition."""

    length: int
    hashes: np.ndarray
    items: np.ndarray  # index of the item that keeps the hash


def _shingles(words: list[bytes], length: int) -> set[bytes]:
    return {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)}


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def sketch(texts: list[str | None], shingle: int = SHINGLE, containment: float = CONTAINMENT) -> tuple[list[set[bytes]], list[int], list[Sketches]]:
    """Shingles and shingle length of each item, and the sketches by length and size partition."""
    sets, lengths, kept = [], [], {}
    for i, text in enumerate(texts):
        words = _tokens(text)
        lengths.append(min(shingle, len(words)))
        sets.append(_shingles(words, lengths[i]) if words else set())
        if not words:
            continue
        (_, data, offsets), = w.pieces(pa.array([text]))
        split = w.split(data, offsets)
        hashes = np.unique(w.grams(split.hashes(_LOWER), split.text, lengths[i])[0])
        partition = len(hashes).bit_length()
        largest = (1 << partition) - 1
        size = largest - math.ceil(round(containment * largest, 9)) + 1
        kept.setdefault((lengths[i], partition), []).append((hashes[:size], i))
    out = []
    for (length, _), rows in sorted(kept.items()):
        hashes = np.concatenate([h for h, _ in rows])
        items = np.concatenate([np.full(len(h), i) for h, i in rows])
        order = np.argsort(hashes, kind="stable")
        out.append(Sketches(length, hashes[order], items[order]))
    return sets, lengths, out


def _meetings(sketches: Sketches, gram: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Distinct (text, item) rows that share a sketch hash."""
    small = np.flatnonzero(gram <= sketches.hashes[-1])
    low = np.searchsorted(sketches.hashes, gram[small], side="left")
    n = np.searchsorted(sketches.hashes, gram[small], side="right") - low
    hit = np.flatnonzero(n)
    n, low, at = n[hit], low[hit], text[small[hit]]
    items = sketches.items[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    return np.unique(np.stack([np.repeat(at, n), items]), axis=1).T


Block = tuple[list[int | None], list[set[bytes]], list[int], list[Sketches]]


def _found(column: pa.Array, block: Block, containment: float) -> Iterator[tuple[int, int | None, int, int]]:
    """Row of the column, item, the item's shingles and those that the text holds, for every verified meeting."""
    item_ids, sets, lengths, sketches = block
    for first, data, offsets in w.pieces(column):
        split = w.split(data, offsets)
        hashes, text = split.hashes(_LOWER), split.text
        grams = {k: w.grams(hashes, text, k) for k in {s.length for s in sketches}}
        met = [_meetings(s, grams[s.length][0], text[grams[s.length][1]]) for s in sketches if len(grams[s.length][0])]
        mine, words, last = {}, [], -1
        for t, i in sorted(set(map(tuple, np.concatenate(met).tolist()))) if met else []:
            if t != last:
                mine, words, last = {}, _tokens(column[first + t].as_py()), t
            k = lengths[i]
            if k not in mine:
                mine[k] = _shingles(words, k)
            shared = len(sets[i] & mine[k])
            if shared >= containment * len(sets[i]) - 1e-9:
                yield first + t, item_ids[i], len(sets[i]), shared


def _blocks(benchmark: DataFrame, shingle: int, containment: float, block_words: int) -> Iterator[Broadcast]:
    """The items, block by block as broadcasts; at least one block."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / (6 * block_words)))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # one block
        made = sketch([r["text"] for r in rows], shingle, containment)
        yield benchmark.sparkSession.sparkContext.broadcast(([r["item_id"] for r in rows], *made))


def _search(docs: DataFrame, block: Broadcast, containment: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_found(batch.column("text"), block.value, containment))
            at, found, size, shared = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (found, size, shared))],
                names=["doc_id", "item_id", "n_shingles", "n_shared"],
            )

    return docs.mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_shared long")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared and containment for every document that holds enough of an item.

    Words are runs of characters other than space and U+0009 to U+000D, A-Z in lower case; shingles are distinct. An item
    with fewer words than a shingle is one shingle of its own length; null and empty items match nothing, null and empty
    documents hold nothing. Items are taken in blocks of about `block_words` words, each block in one pass over the
    documents, so what is broadcast is bounded whatever the benchmark's size. Repeated rows give repeated links; further
    columns are ignored; empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [_search(docs, b, containment) for b in _blocks(benchmark, shingle, containment, block_words)]
    return reduce(DataFrame.unionByName, found).withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item."""
    at = docs.columns.index("text")

    def without(block: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(len(batch), bool)
                keep[[t for t, *_ in _found(batch.column(at), block.value, containment)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for block in _blocks(benchmark, shingle, containment, block_words):
        docs = docs.mapInArrow(without(block), docs.schema)
    return docs
