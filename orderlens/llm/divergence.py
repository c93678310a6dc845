"""Divergence of sources by token-start pointer sort (operator 12).

Tasks take their texts in shards, sort pointers to all word starts and read runs of equal words off the order: how often
a term occurs in a (language, source) and in how many documents. Spark adds the shards' runs up. Terms in enough
documents of their language are kept; sources are compared over them, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import pointers
from orderlens.llm import words as w
from orderlens.session import stored

SHARD_BYTES = 1 << 23
DOCUMENTS = 3
TERMS = 200
SCALE = 1_000_000_000
CELLS = 1 << 20  # counts that are compared at a time

_OTHER = np.ones(256, bool)  # bytes that no term has: all but A-Z, a-z and those of characters beyond U+007F
_OTHER[65:91] = _OTHER[97:123] = _OTHER[128:] = False


def shard_runs(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct terms of a shard's texts; index of the term, group, occurrences and documents of each run)."""
    data = w.LOWER[data]
    words = w.split(data, offsets, _OTHER)
    order, head = pointers.sorted_runs(pointers.Slices(data), words.start, words.end)
    term = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))
    text = words.text[order]  # ascending within a term
    new = np.ones(len(order), bool)
    new[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(order)))
    term, group = term[first], group[text[first]]  # one row for each term of a document
    by = np.lexsort((group, term))
    term, group, count = term[by], group[by], count[by]
    new = np.ones(len(by), bool)
    new[1:] = (term[1:] != term[:-1]) | (group[1:] != group[:-1])
    first = np.flatnonzero(new)
    counts = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
    chosen = order[head]
    return (
        pointers.texts_at(data, words.start[chosen], words.end[chosen]), term[first], group[first], counts, np.diff(np.append(first, len(by)))
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count and docs, added up over all shards; every row of docs is a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
            lang, source = (c.indices.to_numpy().astype(np.int64) for c in codes)
            width = len(codes[1].dictionary)
            for first, data, offsets in w.pieces(batch.column("text"), SHARD_BYTES):
                part = slice(first, first + len(offsets) - 1)
                terms, term, group, count, found = shard_runs(data, offsets, lang[part] * width + source[part])
                yield pa.RecordBatch.from_arrays(
                    [
                        codes[0].dictionary.take(pa.array(group // width)), codes[1].dictionary.take(pa.array(group % width)),
                        terms.take(pa.array(term)), pa.array(count), pa.array(found),
                    ],
                    names=["lang", "source", "term", "count", "docs"],
                )

    rows = docs.mapInArrow(run, "lang string, source string, term string, count long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> Column:
    """1 and the share of count + 1 in total + terms in billionths, rounded down."""
    return 1 + F.expr(f"({SCALE} * (cast({count} as decimal(20, 0)) + 1)) div ({total} + {terms})")


def _pair_sums(rows: DataFrame, groups: dict[str, tuple[list[str], np.ndarray, int]]) -> DataFrame:
    """lang, source, item and part sums of (p - q)^2 div q over the kept terms, p of the source and q of the item.

    A row is a kept term with its counts by source. What a task holds beside a block of terms is one number for each
    pair of sources of a language, as the result does.
    """
    sizes = rows.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        places = {lang: {s: i for i, s in enumerate(sources)} for lang, (sources, _, _) in sizes.value.items()}
        for batch in batches:
            langs, lists = batch.column("lang").dictionary_encode(), batch.column("counts")
            width = lists.value_lengths().to_numpy()
            row, items = np.repeat(np.arange(len(batch)), width), lists.flatten()
            source, count = items.field(0).dictionary_encode(), items.field(1).to_numpy()
            lang = langs.indices.to_numpy()
            for code, name in enumerate(langs.dictionary.to_pylist()):
                sources, totals, terms = sizes.value[name]
                column = np.array([places[name].get(s, -1) for s in source.dictionary.to_pylist()], np.int64)[source.indices.to_numpy()]
                mine = np.flatnonzero(lang == code)
                step = max(1, CELLS // len(sources))
                into = sums.setdefault(name, np.zeros((len(sources), len(sources)), np.int64))
                for k in range(0, len(mine), step):
                    part = mine[k : k + step]
                    index = np.full(len(batch), -1)
                    index[part] = np.arange(len(part))
                    here = np.flatnonzero(index[row] >= 0)
                    counts = np.zeros((len(part), len(sources)), object if count.max(initial=0) >= 1 << 33 else np.int64)
                    counts[index[row[here]], column[here]] = count[here]
                    p = (1 + SCALE * (counts + 1) // (totals + terms)).astype(np.int64)
                    for i in range(len(sources)):
                        q = p[:, i : i + 1]
                        into[:, i] += ((p - q) ** 2 // q).sum(axis=0)
        for name, into in sums.items():
            sources = pa.array(sizes.value[name][0], pa.string())
            one, other = (x.reshape(-1) for x in np.indices(into.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * into.size, pa.string()), sources.take(pa.array(one)), sources.take(pa.array(other)), pa.array(into.reshape(-1))],
                names=["lang", "source", "item", "value"],
            )

    return rows.mapInArrow(run, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, documents: int = DOCUMENTS, terms: int = TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: how far each (lang, source) lies from the other sources of its language
    (part `pair`, all of them) and by which terms it exceeds its language (part `term`, the first `terms`).

    Null text, lang and source count as empty. Terms are runs of letters, A-Z in lower case, bytes beyond U+007F included.
    A language keeps the V terms in at least `documents` of its rows. In a group with N kept words a term with count c has
    p = 1 + 10^9 (c + 1) div (N + V); values are sums of, or single, (p - q)^2 div q. A language without kept terms has
    pairs of value 0. Rows that repeat an id are documents of their own; further columns are ignored; an empty table gives
    no rows.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = stored(term_counts(rows))
    kept = stored(
        counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total")).filter(F.col("docs") >= documents).select("lang", "term", "total")
    )
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    held = stored(counts.join(kept, ["lang", "term"]).select("lang", "term", "source", "count", "total"))
    sums = held.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = stored(
        rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "all")))
    )
    sizes: dict[str, tuple[list[str], list[int], int]] = {}
    for row in groups.orderBy("lang", "source").collect():  # one row for each group; the result has one for each pair
        sources, totals, _ = sizes.setdefault(row["lang"], ([], [], row["v"]))
        sources.append(row["source"])
        totals.append(row["n"])
    known = {lang: (sources, np.array(totals, np.int64), v) for lang, (sources, totals, v) in sizes.items()}
    lists = held.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "count")).alias("counts"))  # an item for each source
    summed = _pair_sums(lists, known)
    one, other = groups.select("lang", "source"), groups.select("lang", F.col("source").alias("item"))
    pairs = one.join(other, "lang").filter("source <> item").join(summed, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")
    )
    p, q = _share("count", "n", "v"), _share("total", "all", "v")
    above = held.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")).filter("p > q")
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    first = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    first = first.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= terms)  # no more of a group leave a task
    return pairs.withColumn("rank", F.row_number().over(ordered)).unionByName(first)
