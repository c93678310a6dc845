"""Language identification by words first, then shorter and shorter character n-grams (operator 7)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm import words as w

FIT_ROWS = 4_000  # labelled documents of each language, about, that the model is fitted on
LEAST_COUNT = 2  # occurrences in the fit that make a word or n-gram known
ORDERS = (5, 4, 3, 2, 1)
SMOOTHING = 0.1

# what is no letter and no mark of one separates words, in the fit and in the prediction alike
SEPARATOR = r"[^\p{L}\p{M}]+"
_MEMORY = 200_000  # scores of unseen words that a task keeps


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_rows(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """lang and text of about `rows` documents of each language, those whose ids hash below the language's share; of
    all where there are fewer. Held-out rows and rows without text or language are not among them."""
    usable = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    sizes = [(r["lang"], r["n"]) for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]  # one row for each language
    if not sizes:
        return usable.select("lang", "text")
    share = F.coalesce(*(F.when(F.col("lang") == lang, min(1.0, rows / n)) for lang, n in sizes))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return usable.filter(draw < share).select("lang", "text")


def lowered(texts: pa.Array) -> pa.Array:
    """Texts in lower case with a space for everything between words; null counts as empty."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), SEPARATOR, " ")


def _grams(word: str, n: int) -> Iterator[str]:
    padded = f"<{word}>"
    return (padded[i : i + n] for i in range(len(padded) - n + 1))


@dataclass
class Model:
    """Languages, the log frequency of every known word by its hash, and of every known n-gram, in each language."""

    languages: list[str]
    words: np.ndarray
    word_logs: np.ndarray  # one row for each word
    grams: dict[str, int]  # row of each n-gram
    gram_logs: np.ndarray

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of the word's known n-grams of the longest order that has any."""
        for n in ORDERS:
            found = [x for x in (self.grams.get(g) for g in _grams(word, n)) if x is not None]
            if found:
                return np.add.reduce(self.gram_logs[found], axis=0, dtype=np.float64) / len(found)
        return np.zeros(len(self.languages))


def _logs(counts: np.ndarray) -> np.ndarray:
    """Smoothed log frequencies by language, as far from the languages' mean."""
    if not len(counts):
        return counts.astype(np.float32)
    logs = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * len(counts))
    return (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Counted by Spark over the fitted documents, whose number is bounded by `rows` a language, and collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), lowered(batch.column("text")).to_pylist(), strict=True):
                totals.setdefault(lang, Counter()).update(text.split())
            out = []
            for lang, units in totals.items():
                grams: Counter = Counter()
                for word, n in units.items():
                    for order in ORDERS:
                        for g in _grams(word, order):
                            grams[g] += n
                out += [(lang, 0, u, n) for u, n in units.items()] + [(lang, len(g), g, n) for g, n in grams.items()]
            columns = zip(*out, strict=True) if out else ([],) * 4
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["lang", "kind", "unit", "n"])

    counted = fit_rows(docs, rows).mapInArrow(count, "lang string, kind int, unit string, n long").groupBy("lang", "kind", "unit").agg(F.sum("n").alias("n"))
    known = counted.groupBy("kind", "unit").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))  # one for each language
    table = known.filter(F.col("all") >= LEAST_COUNT).select("kind", "unit", F.explode("by").alias("b")).select("kind", "unit", "b.*").toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    if not languages:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), {}, np.zeros((0, 0), np.float32))
    column = pc.index_in(table["lang"], pa.array(languages)).to_numpy()
    kind, counts = table["kind"].to_numpy(), table["n"].to_numpy()
    units = table["unit"].combine_chunks()

    def matrix(mine: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        coded = units.take(pa.array(np.flatnonzero(mine))).dictionary_encode()
        total = np.zeros((len(coded.dictionary), len(languages)))
        total[coded.indices.to_numpy(), column[mine]] = counts[mine]
        return coded.dictionary, total

    names, total = matrix(kind == 0)
    hashes = np.concatenate([np.zeros(0, np.uint64), *(w.split(d, o).hashes() for _, d, o in w.pieces(names))])
    order = np.argsort(hashes)
    logs = _logs(total)[order]
    by_order = [matrix(kind == n) for n in ORDERS]
    grams = {g: i for i, g in enumerate(g for found, _ in by_order for g in found.to_pylist())}
    return Model(languages, hashes[order], logs, grams, np.concatenate([_logs(total) for _, total in by_order]))


def identify(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of docs (doc_id, text, lang).

    A known word adds its log frequency in each language; an unseen one the mean of its known n-grams of the longest
    order that has any, from 5 letters (word ends marked) down to 1. The language with the largest sum wins, the first
    in code-point order on ties; the score is its share of the exponentials of the means per word. `und` with score 0 if
    the text is null, has no letter, or no word was learned. Words are runs of letters and their marks of any script. lang is read by the fit alone, which leaves out every
    document whose crc32(doc_id) mod 4 is 2. Rows with a null id are fitted on, not held out. Repeated rows are
    predicted alike; further columns are ignored; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, rows))  # bounded by the fitted documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        n_languages = len(m.languages)
        memory: dict[bytes, np.ndarray] = {}
        for batch in batches:
            texts = lowered(batch.column("text"))
            for first, data, offsets in w.pieces(texts):
                words = w.split(data, offsets)
                count = words.counts()
                if len(m.words) and len(words.start):
                    hashes = words.hashes()
                    unique, back = np.unique(hashes, return_inverse=True)
                    place = np.minimum(np.searchsorted(m.words, unique), len(m.words) - 1)
                    scores = m.word_logs[place].astype(np.float64)
                    unseen = np.flatnonzero(m.words[place] != unique)
                    example = np.zeros(len(unique), np.int64)
                    example[back] = np.arange(len(hashes))
                    for u in unseen.tolist():
                        raw = data[words.start[example[u]] : words.end[example[u]]].tobytes()
                        if raw not in memory:
                            if len(memory) >= _MEMORY:
                                memory.clear()
                            memory[raw] = m.unseen(raw.decode("utf-8", "replace"))
                        scores[u] = memory[raw]
                    # whole numbers of 2^-20, so that the sum doesn't depend on what else is in the batch
                    whole = np.rint(scores * (1 << 20)).astype(np.int64)[back]
                    total = np.stack([w.per_text(whole[:, k], words.bounds) for k in range(n_languages)], axis=1)
                    best = total.argmax(axis=1)
                    mean = total / np.maximum(count, 1)[:, None] / (1 << 20)
                    power = np.exp(mean - mean.max(axis=1, keepdims=True))
                    score = 1 / power.sum(axis=1)
                else:
                    best, score = np.zeros(len(count), np.int64), np.zeros(len(count))
                found = zip(texts.slice(first, len(count)).to_pylist(), count.tolist(), strict=True)
                letters = [c > 0 and len(m.words) > 0 and any(x.isalpha() for x in t) for t, c in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(count)), batch.column("held_out").slice(first, len(count)),
                        pa.array([m.languages[b] if ok else "und" for b, ok in zip(best.tolist(), letters, strict=True)], pa.string()),
                        pa.array(np.where(letters, score, 0.0)),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows_.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
