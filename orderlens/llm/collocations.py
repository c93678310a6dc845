"""Phrases whose words keep together, counted by Rabin-Karp fingerprints (operator 13).

1. One pass over the texts for each length from 1 to 5 words. Prefix polynomials over the hashes of words give the
   fingerprint of every n-gram at once; n-grams are taken on only if both n-grams of one word less are marked as
   frequent in a bit table of fixed size. Within a piece of text, equal fingerprints are checked on the words
   themselves; across pieces a second fingerprint stands for them. Spark adds the counts up and keeps, for every
   fingerprint, a pointer to a text in which it occurs.
2. Frequent phrases, and only these, are read back from the texts pointed to, together with the fingerprints of the parts
   into which they can be cut. Counts of the parts are joined, cuts are scored in decimals, phrases dropped that a longer
   one covers, and the first of every language kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import bits, pointers
from orderlens.llm import words as w
from orderlens.session import stored

LONGEST = 5
COUNT = 100
FIRST = 2000
SHARD_BYTES = 1 << 22
SPREAD = 64  # parts of a language that are ranked on their own before the language is

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = _BREAK[10:14] = True
_OTHER = _BREAK.copy()
_OTHER[[9, 32]] = True
_VALUES = w.BYTE_VALUES[w.LOWER]
_SECOND = w.mix(_VALUES + np.uint64(0x9E3779B97F4A7C15))
_LENGTHS = w.mix(np.arange(1, 64, dtype=np.uint64))


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Grams:
    """All n-grams of some texts, by fingerprints that name language, length and words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, salts: np.ndarray):
        self.words = w.split(data, offsets, _OTHER)
        n = len(self.words.start)
        self.salt = salts[self.words.text]
        self._up, self._down = w.powers(n + 1)
        self._sums = [self._polynomial(self.words.hashes(values)) for values in (_VALUES, _SECOND)]
        breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
        self.piece = breaks[self.words.start] + self.words.text  # both grow, so pieces differ in their sum
        self._slices = pointers.Slices(w.LOWER[data])

    def _polynomial(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self._up[: len(hashes)], out=out[1:])
        return out

    def places(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie within one piece."""
        last = len(self.piece) - n + 1
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1 :]) if last > 0 else np.zeros(0, np.int64)

    def fingerprint(self, at: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        sums = self._sums[which]
        return w.mix(((sums[at + n] - sums[at]) * self._down[at]) ^ (self.salt[at] + _LENGTHS[n]))

    def check(self, at: np.ndarray, n: int) -> np.ndarray:
        return (self.fingerprint(at, n, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def same(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the n-grams at a[i] and b[i] have the same words."""
        out = np.ones(len(a), bool)
        for k in range(n):
            left = np.flatnonzero(out)
            out[left] = pointers.equal_words(self._slices, self.words.start, self.words.end, a[left] + k, b[left] + k)
        return out


def _salts(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    return np.array([_salt(x) for x in coded.dictionary.to_pylist()], np.uint64)[coded.indices.to_numpy()]


def _counts(texts: DataFrame, n: int, frequent: Broadcast | None) -> DataFrame:
    """key, check, length, n and copy (32 bits of a hash of a text) for the n-grams of every shard; length 0: words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, salts = batch.column("copy").to_numpy(), _salts(batch.column("lang"))
            for first, data, offsets in w.pieces(batch.column("text"), SHARD_BYTES):
                part = slice(first, first + len(offsets) - 1)
                grams = Grams(data, offsets, salts[part])
                at = grams.places(n)
                if frequent is not None:
                    marked = np.zeros(len(grams.piece) + 1, bool)
                    shorter = grams.places(n - 1)
                    marked[shorter] = bits.test(frequent.value[0], grams.fingerprint(shorter, n - 1))
                    at = at[marked[at] & marked[at + 1]]
                key = grams.fingerprint(at, n)
                by = np.argsort(key, kind="stable")
                at, key = at[by], key[by]
                new = np.ones(len(at), bool)
                equal = np.flatnonzero(key[1:] == key[:-1])
                new[equal + 1] = ~grams.same(at[equal], at[equal + 1], n)
                head = np.flatnonzero(new)
                columns = [
                    key[head].view(np.int64), grams.check(at[head], n), np.full(len(head), n, np.int32), np.diff(np.append(head, len(at))),
                    copies[part][grams.words.text[at[head]]],
                ]
                if n == 1:  # and the words of each language
                    salt, one, of = np.unique(salts[part], return_index=True, return_inverse=True)
                    total = np.bincount(of, grams.words.counts(), len(salt)).astype(np.int64)
                    more = [w.mix(salt).view(np.int64), np.zeros(len(salt), np.int32), np.zeros(len(salt), np.int32), total, copies[part][one]]
                    columns = [np.concatenate(x) for x in zip(columns, more, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "check", "length", "n", "copy"])

    return texts.mapInArrow(run, "key long, check int, length int, n long, copy int")


def _frequent(texts: DataFrame, longest: int, count: int) -> list[DataFrame]:
    """key, check, length, n and copy of the frequent n-grams, length by length; the first table has the languages, too."""
    out, marks = [], None
    for n in range(1, longest + 1):
        sums = _counts(texts, n, marks).groupBy("key", "check", "length").agg(F.sum("n").alias("n"), F.min("copy").alias("copy"))
        out.append(stored(sums.filter((F.col("n") >= count) | (F.col("length") == 0))))
        if n < longest:
            marks = bits.tables(out[-1], "key", [F.col("length") > 0])
    return out


PARTS = "array<struct<k: int, left_key: long, left_check: int, right_key: long, right_check: int>>"


def _read_back(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """lang, key, check, length, n, phrase and parts of the wanted n-grams, from the texts that they point to."""
    marks = bits.tables(wanted.select(F.xxhash64("copy").alias("copy")), "copy", [F.col("copy").isNotNull()])

    def pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bits.test(marks.value[0], batch.column("mark").to_numpy()))).drop_columns(["mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                lang, items = one.column("lang")[0].as_py(), one.column("wanted").flatten()
                key, check, length, n = (items.field(k).to_numpy() for k in range(4))
                out = []
                for _, data, offsets in w.pieces(one.column("text")):
                    grams = Grams(data, offsets, _salts(one.column("lang")))
                    start, end, lower = grams.words.start.tolist(), grams.words.end.tolist(), w.LOWER[data].tobytes()
                    for size in np.unique(length).tolist():
                        mine = np.flatnonzero(length == size)
                        if not size:
                            mine = mine[key[mine].view(np.uint64) == w.mix(np.array([_salt(lang)], np.uint64))[0]]
                            out += [(lang, key[j], check[j], 0, n[j], "", []) for j in mine.tolist()]
                            continue
                        at = grams.places(size)
                        here = grams.fingerprint(at, size).view(np.int64)
                        by = np.argsort(here, kind="stable")
                        found = np.searchsorted(here[by], key[mine])
                        for j, place in zip(mine.tolist(), found.tolist(), strict=True):
                            while place < len(by) and here[by[place]] == key[j] and grams.check(at[by[place : place + 1]], size)[0] != check[j]:
                                place += 1  # another phrase of the same fingerprint
                            if place == len(by) or here[by[place]] != key[j]:
                                continue  # the phrase of another language, or of another text of the same hash
                            first = int(at[by[place]])
                            phrase = b" ".join(lower[start[x] : end[x]] for x in range(first, first + size)).decode()
                            parts = []
                            for k in range(1, size):
                                left, right = np.array([first]), np.array([first + k])
                                parts.append({
                                    "k": k, "left_key": grams.fingerprint(left, k).view(np.int64)[0], "left_check": grams.check(left, k)[0],
                                    "right_key": grams.fingerprint(right, size - k).view(np.int64)[0], "right_check": grams.check(right, size - k)[0],
                                })
                            out.append((lang, key[j], check[j], size, n[j], phrase, parts))
                yield pa.RecordBatch.from_pylist([dict(zip(RECORD.names, r, strict=True)) for r in out], schema=RECORD)

    texts = texts.withColumn("mark", F.xxhash64("copy")).mapInArrow(pointed, texts.schema).dropDuplicates()
    lists = wanted.groupBy("copy").agg(F.collect_list(F.struct("key", "check", "length", "n")).alias("wanted"))  # at most the text's own n-grams
    return texts.join(lists, "copy").select("lang", "text", "wanted").mapInArrow(
        run, f"lang string, key long, check int, length int, n long, phrase string, parts {PARTS}"
    )


RECORD = pa.schema([
    ("lang", pa.string()), ("key", pa.int64()), ("check", pa.int32()), ("length", pa.int32()), ("n", pa.int64()), ("phrase", pa.string()),
    ("parts", pa.list_(pa.struct([
        ("k", pa.int32()), ("left_key", pa.int64()), ("left_check", pa.int32()), ("right_key", pa.int64()), ("right_check", pa.int32()),
    ]))),
])


def collocations(docs: DataFrame, longest: int = LONGEST, count: int = COUNT, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first phrases of every language (null: `und`).

    Texts, A-Z in lower case, are cut at `.,;:!?` and U+000A to U+000D, and what lies between into words at spaces and
    tabs. Phrases have 2 to `longest` words and occur `count` times or more, overlapping places included. A phrase is cut
    after each number of words; the cut of least score floor(1000 a n / (l r)), then of fewest words, counts. A phrase goes
    if a phrase of one word more, and so any longer one, that holds it occurs as often. Null and empty texts have no word;
    every row counts, so repeated rows count again; further columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.hash(text).alias("copy"), text.alias("text"))
    levels = _frequent(texts, longest, count)
    wanted = reduce(DataFrame.unionByName, levels).filter("length <> 1")
    found = stored(_read_back(texts, wanted).dropDuplicates(["key", "check", "lang", "phrase"]))  # several texts may share a pointer
    totals = found.filter("length = 0").select("lang", F.col("n").alias("total"))
    cuts = found.filter("length > 0").select("lang", "key", "check", "length", F.col("n").alias("a"), "phrase", F.explode("parts").alias("p")).select("*", "p.*").drop("p")
    known = stored(reduce(DataFrame.unionByName, levels).filter("length > 0").select("key", "check", "n"))
    for side, name in (("left", "l"), ("right", "r")):
        part = known.select(F.col("key").alias(f"{side}_key"), F.col("check").alias(f"{side}_check"), F.col("n").alias(name))
        cuts = stored(cuts.join(part, [f"{side}_key", f"{side}_check"]))
    covered = cuts.filter("length > 2 and k = length - 1 and l <= a").select(F.col("left_key").alias("key"), F.col("left_check").alias("check")).unionByName(
        cuts.filter("length > 2 and k = 1 and r <= a").select(F.col("right_key").alias("key"), F.col("right_check").alias("check"))
    ).distinct()
    wide = "decimal(18, 0)"
    score = F.expr(f"(cast(1000 * a as {wide}) * cast(total as {wide})) div (cast(l as {wide}) * cast(r as {wide}))")
    scored = cuts.join(totals, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "key", "check", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    left = best.join(covered, ["key", "check"], "left_anti").select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    spread = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*order)
    few = left.withColumn("rank", F.row_number().over(spread)).filter(F.col("rank") <= first)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return few.withColumn("rank", rank).filter(F.col("rank") <= first).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
