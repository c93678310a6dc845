"""The pipeline's stages against plain Python, or the registered SQL, on the smallest tables."""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb

import corpus_pipeline
from orderlens.llm import oracles
from tests.llm.test_operators import WORD, classes, fingerprint, scored

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()

    good = corpus_pipeline.good_documents(spark, docs, FOLDER)
    judged = scored(list(texts.items()), {r["doc_id"] for r in labels if r["quality"] == 1 and not r["toxic"]})
    left = sorted(i for i, (_, _, kept) in judged.items() if kept)
    assert good.columns == columns and sorted(r["doc_id"] for r in good.collect()) == left and len(left) < len(texts)

    unique = corpus_pipeline.one_of_each(spark, good, FOLDER)
    left = sorted(set(classes([fingerprint(texts[i]) for i in left], left)))
    assert unique.columns == columns and sorted(r["doc_id"] for r in unique.collect()) == left

    clean = corpus_pipeline.without_benchmark(spark, unique, FOLDER)
    lower = lambda t: WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    grams = lambda ws, n: {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}
    items = [lower(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {}
    for i in left:
        ws = lower(texts[i])
        held[i] = any(x and len(grams(x, min(5, len(x))) & grams(ws, min(5, len(x)))) >= 0.8 * len(grams(x, min(5, len(x)))) - 1e-9 for x in items)
    left = [i for i in left if not held[i]]
    assert clean.columns == columns and sorted(r["doc_id"] for r in clean.collect()) == left and any(held.values())

    clean.write.parquet(str(tmp_path / "clean"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/clean/*.parquet'")
    mix = duck.execute(f"SELECT doc_id, size, taken FROM ({oracles.MIX})").fetchall()
    copies = Counter({i: taken // size for i, size, taken in mix if size and taken})
    mixed = corpus_pipeline.mixed(spark, spark.read.parquet(str(tmp_path / "clean")), FOLDER)
    taken = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns and taken == copies and max(taken.values()) <= 3

    placed = corpus_pipeline.sharded(spark, mixed, FOLDER).collect()
    row = lambda i: (i, zlib.crc32(texts[i].encode()), len(texts[i].encode()) + 1)
    order = sorted(row(i) for i in taken.elements())
    total, before, slots, want = sum(s for *_, s in order), 0, Counter(), Counter()
    for i, crc, size in order:
        shard = min(15, (2 * before + size) * 16 // (2 * total))
        want[(i, size, crc, shard, slots[shard])] += 1
        slots[shard] += 1
        before += size
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in placed) == want

    result = corpus_pipeline.run(spark, FOLDER)
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in result.collect()) == Counter((i, s, k) for i, _, _, s, k in want.elements())


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
