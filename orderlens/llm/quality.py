"""Quality rules by a hashed n-gram likelihood ratio (operator 10).

Two multinomials over hashed byte n-grams: one of the trusted documents, one of the whole corpus. A document's score is
the mean, over its own n-grams, of log(trusted / corpus); it stays if the score reaches `threshold`. Weights are
integers (2^-20 of a nat), so a score doesn't depend on the order of rows, tasks or batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import words as w

BUCKETS = 1 << 16
GRAM = 3
TRUSTED_ROWS = 20_000  # bound of the labelled sample that stands for the target
THRESHOLD = -0.25  # mean nats per n-gram
SCALE = 1 << 20
PRIOR = 1_000  # n-grams of the corpus that the trusted counts start from

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_CHARACTER = np.array([(b & 0xC0) != 0x80 for b in range(256)], np.int64)
# bytes as the n-grams see them: any white space is one space, any digit one digit
_SEEN = np.arange(256, dtype=np.uint32)
_SEEN[w.SPACE] = 32
_SEEN[48:58] = 48


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each text, and each text's range of them; texts shorter than an n-gram have none."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    seen = _SEEN[data]
    code = seen[:n].copy()
    for i in range(1, GRAM):
        code |= seen[i : i + n] << np.uint32(8 * i)
    hashed = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    inside = np.ones(len(data), bool)
    for i in range(1, GRAM):
        ends = offsets[1:] - i
        inside[ends[ends >= offsets[:-1]]] = False
    inside = inside[:n]
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=before[1 : n + 1])
    before[n + 1 :] = before[n]
    return hashed[inside], before[offsets]


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of at most `rows` documents labelled good and not toxic, those with the least hashes."""
    return (
        labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRUSTED_ROWS) -> np.ndarray:
    """Integer weight of each bucket; all zero if no trusted document is there."""
    trusted = trusted_ids(labels, rows).withColumn("trusted", F.lit(True))
    marked = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(trusted), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            good = batch.column("trusted").to_numpy(zero_copy_only=False)
            for first, data, offsets in w.pieces(batch.column("text")):
                hashed, bounds = buckets(data, offsets)
                total[0] += np.bincount(hashed, minlength=BUCKETS)
                which = np.repeat(good[first : first + len(offsets) - 1], np.diff(bounds))
                total[1] += np.bincount(hashed[which], minlength=BUCKETS)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])], names=["bucket", "corpus", "trusted"])

    counts = (
        marked.mapInArrow(count, "bucket long, corpus long, trusted long").groupBy("bucket")
        .agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted")).collect()  # at most BUCKETS rows
    )
    corpus, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts:
        corpus[r["bucket"]], good[r["bucket"]] = r["corpus"], r["trusted"]
    if not good.sum():
        return np.zeros(BUCKETS, np.int64)
    # a bucket's corpus share is the prior of its trusted share: what the target has never seen counts against a text
    # only as far as the corpus has it often
    share = (corpus + 0.5) / (corpus.sum() + 0.5 * BUCKETS)
    ratio = np.log((good + share * PRIOR) / (good.sum() + PRIOR) / share)
    return np.rint(ratio * SCALE).astype(np.int64)


def _repeated_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            n += line in seen
            seen.add(line)
    return n


def _repeated_words(words: w.Words, hashes: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a 3-word window found at least twice in it."""
    text = words.text
    gram, at = w.grams(hashes, text, 3)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(gram):
        key = w.mix(gram + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(key), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = at[order[twice]]
        for i in range(3):
            covered[found + i] = 1
    return w.per_text(covered[:-1], words.bounds)


KINDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def _judged(texts: pa.Array, weights: np.ndarray, least: int) -> Iterator[tuple[int, list[pa.Array]]]:
    """Index of a piece's first text and the columns of KINDS for the piece."""
    for first, data, offsets in w.pieces(texts):
        words = w.split(data, offsets)
        n_words = words.counts()
        characters = w.per_text(np.where(w.SPACE[data], 0, _CHARACTER[data]), offsets)
        symbols = w.per_text(_SYMBOL[data], offsets)
        repeated = _repeated_words(words, words.hashes())
        lines = [_repeated_lines(t) if t else 0 for t in texts.slice(first, len(n_words)).to_pylist()]
        failed = (n_words < 50) | (100 * repeated > 50 * n_words)
        hashed, bounds = buckets(data, offsets)
        n = np.diff(bounds)
        total = w.per_text(weights[hashed], bounds)
        score = pa.array(total / np.maximum(n, 1) / SCALE, mask=n == 0)
        kept = ~failed & (total >= least * n)
        yield first, [*map(pa.array, (n_words, characters, symbols)), pa.array(lines, pa.int64()), *map(pa.array, (repeated, failed)), score, pa.array(kept)]


def score_rules(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts, base_failed, score (mean log ratio, null without n-grams) and kept for every row.

    Words are runs of characters other than space and U+0009 to U+000D. A text fails the base rules with fewer than 50
    words or with more than half of its words in repeated 3-word windows. A null or empty text has no words, so it fails.
    Repeated rows are judged alike; further columns are ignored; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS integers
    least = round(threshold * SCALE)
    names = ["doc_id", *(k.split()[0] for k in KINDS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, columns in _judged(batch.column("text"), model.value, least):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(columns[0])), *columns], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {KINDS}")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRUSTED_ROWS) -> DataFrame:
    """The rows of docs that `quality_rules` keeps, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    least, at = round(threshold * SCALE), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [columns[-1] for _, columns in _judged(batch.column(at), model.value, least)]
            if kept:
                yield batch.filter(pa.concat_arrays(kept))

    return docs.mapInArrow(run, docs.schema)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRUSTED_ROWS) -> DataFrame:
    """`score_rules` with weights learned from the corpus and its labels; without trusted documents only the base rules judge."""
    return score_rules(docs, fit(docs, labels, rows), threshold)
