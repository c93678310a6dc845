"""Long repeated passages by recompression (operator 6).

1. `anchored_spans`: rounds of run and pair naming turn each document into symbols (see `parse`); each window of
   `window` words takes one of its interior symbols as anchor, and neighbouring windows with one anchor form a span.
   Equal windows have the same anchor name, wherever they stand.
2. Names found in one document only are dropped. What is left is a small share of all spans.
3. Spans with the same name and content agree in all their windows. One per content, in the smallest document, stands
   for the rest; where a name has several contents, the windows of those are compared one by one.

Every step is an aggregate with map-side combination or a join that AQE may split, so a passage held by a third of
all documents costs as much as any other. Contents are compared as 128 bits: the anchor's name and a second hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import bits, parse
from orderlens.llm import words as w
from orderlens.session import stored

WINDOW = 50
SPANS = "doc_id long, copy long, name long, span long, low int, count int"


def _texts(docs: DataFrame) -> DataFrame:
    """`copy` tells rows apart that repeat an id with another text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("copy"), F.col("text").cast("string").alias("text"))


def anchored_spans(texts: DataFrame, window: int = WINDOW, rounds: int = parse.ROUNDS) -> DataFrame:
    """One row per span: its anchor's name, the hash of all its words, the first window's start and the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies = batch.column("doc_id"), batch.column("copy")
            for first, data, offsets in w.pieces(batch.column("text")):
                words = w.split(data, offsets)
                hashes = words.hashes()
                prefix = parse.rolling(hashes)
                found = parse.spans(words, hashes, prefix, window, rounds)
                text = np.searchsorted(words.bounds, found.low, side="right") - 1
                rows = pa.array(first + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(rows), copies.take(rows), pa.array(found.name.view(np.int64)),
                        pa.array(parse.content(prefix, found.low, found.count + window - 1).view(np.int64)),
                        pa.array((found.low - words.bounds[text]).astype(np.int32)), pa.array(found.count.astype(np.int32)),
                    ],
                    names=["doc_id", "copy", "name", "span", "low", "count"],
                )

    return texts.mapInArrow(run, SPANS)


def _window_hashes(wanted: DataFrame, window: int) -> DataFrame:
    """The windows of the wanted spans: rows of texts, each with its list of (name, span, low, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keep in batches:
            lists = keep.column("wanted")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False) if len(keep) else np.zeros(0, np.int64)
            ends = np.cumsum(sizes)
            items = lists.flatten()
            name, span, low, count = (items.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            for first, data, offsets in w.pieces(keep.column("text")):
                words = w.split(data, offsets)
                prefix = parse.rolling(words.hashes())
                last = first + len(offsets) - 1
                mine = slice(ends[first] - sizes[first], ends[last - 1])
                text = np.repeat(np.arange(last - first), sizes[first:last])
                n = count[mine].astype(np.int64)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(words.bounds[text] + low[mine], n) + step
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(name[mine], n)), pa.array(np.repeat(span[mine], n)), pa.array(step.astype(np.int32)),
                        pa.array(parse.content(prefix, start, window).view(np.int64)),
                        keep.column("doc_id").take(pa.array(np.repeat(first + text, n))),
                    ],
                    names=["name", "span", "step", "content", "doc_id"],
                )

    return wanted.select("doc_id", "text", "wanted").mapInArrow(run, "name long, span long, step int, content long, doc_id long")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, copy, cover: the starts of windows that also start in a document with a smaller id, as (low, count).
    Rows without an id are left out: as least of a content, a null would hide its windows in all other documents."""
    texts = _texts(docs).filter("doc_id is not null")
    spans = stored(anchored_spans(texts, window))
    # what is joined is a written table on either side, so that AQE may split a hot name
    shared = stored(spans.groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("name"))
    spans = stored(spans.join(shared, "name", "left_semi"))

    contents = stored(
        spans.groupBy("name", "span").agg(F.min(F.struct("doc_id", "copy", "low", "count")).alias("r"))
        .select("name", "span", "r.*")
    )
    several = stored(contents.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"))
    wanted = (
        contents.join(several, "name", "left_semi").groupBy("doc_id", "copy")
        .agg(F.collect_list(F.struct("name", "span", "low", "count")).alias("wanted"))  # at most the text's own spans
    )
    wanted = stored(wanted)
    marks = bits.tables(wanted, "copy", [F.col("copy").isNotNull()])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # only texts that may be asked for are shuffled
        for batch in batches:
            yield batch.filter(pa.array(bits.test(marks.value[0], batch.column("copy").to_numpy())))

    windows = stored(_window_hashes(texts.mapInArrow(asked, texts.schema).join(wanted, ["doc_id", "copy"]), window))
    earliest = stored(windows.groupBy("name", "content").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b"))
    steps = (
        windows.join(earliest, ["name", "content"]).filter("doc_id > a")
        .groupBy("name", "span").agg(F.collect_set("step").alias("steps"))  # at most the windows of one span
    )
    verdicts = stored(contents.select("name", "span", F.col("doc_id").alias("first_doc")).join(steps, ["name", "span"], "left"))
    judged = spans.join(verdicts, ["name", "span"])
    whole = F.array(F.struct("low", "count"))
    single = F.transform("steps", lambda k: F.struct((F.col("low") + k).alias("low"), F.lit(1).alias("count")))
    cover = F.when(F.col("doc_id") > F.col("first_doc"), whole).otherwise(single)
    return (
        judged.select("doc_id", "copy", cover.alias("cover")).filter("cover is not null")
        .groupBy("doc_id", "copy").agg(F.flatten(F.collect_list("cover")).alias("cover"))  # at most the text's own windows
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by single spaces) for every row.

    A word goes if a window of `window` words over it also starts in a document with a smaller id; windows are judged
    on the input. Texts shorter than a window lose nothing. A null text has no words. A null id is smaller than no
    other and greater than none, so its row loses nothing and takes nothing. Rows that repeat an id are judged each on
    its own text. Further columns are ignored. An empty table gives no rows.
    """
    texts = _texts(docs)
    marked = texts.join(repeated_spans(docs, window), ["doc_id", "copy"], "left").select("doc_id", "text", "cover")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts_, covers = batch.column("doc_id"), batch.column("text"), batch.column("cover")
            words_, removed, kept = [], [], []
            for i in range(len(batch)):
                words = (texts_[i].as_py() or "").encode().split()
                words_.append(len(words))
                gone = 0
                if covers[i].is_valid and len(words) >= window:
                    mark = np.zeros(len(words) + 1, np.int64)
                    starts = covers[i].values
                    low = starts.field(0).to_numpy(zero_copy_only=False)
                    np.add.at(mark, low, 1)
                    np.add.at(mark, low + starts.field(1).to_numpy(zero_copy_only=False) + window - 1, -1)
                    stay = np.cumsum(mark[:-1]) == 0
                    gone = int(len(words) - stay.sum())
                    words = [x for x, s in zip(words, stay, strict=True) if s]
                removed.append(gone)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(words_, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return marked.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def brute_force(rows: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """The definition itself, for tests: {doc_id: (n_words, n_removed, sha256 of the kept words)}."""
    texts = {i: (t or "").encode().split() for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - window + 1):
            first.setdefault(tuple(texts[i][k : k + window]), i)
    out = {}
    for i, words in texts.items():
        stay = [True] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < i:
                stay[k : k + window] = [False] * window
        kept = b" ".join(x for x, s in zip(words, stay, strict=True) if s)
        out[i] = (len(words), len(words) - sum(stay), hashlib.sha256(kept).hexdigest())
    return out
