"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    collocations, decontamination, divergence, jaccard_join, language, licenses, mixing, oracles, quality, recompression, sharding,
    simhash, url_lists, warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).withColumn("target", F.round("target", 6))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents")).drop("spans")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, folder, "pages"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


def _dated_entries(captures: DataFrame) -> DataFrame:
    """A dated list derived from the hosts of the captures, by their checksums: hosts that come, go and come back,
    whole domains, and sections that are let through for a while."""

    def number(entry: str):
        return F.conv(F.substring(F.md5(F.col(entry).cast("binary")), 1, 6), 16, 10).cast("int")

    def events(rows: DataFrame, name: str, allows: bool, first: int, *later: tuple[int, int, bool]) -> DataFrame:
        moments = [F.struct(F.lit(0).alias("after"), F.lit(True).alias("adds"), F.lit(True).alias("due"))]
        moments += [F.struct(F.lit(a).alias("after"), F.lit(adds).alias("adds"), (F.col("n") % every == 0).alias("due")) for a, every, adds in later]
        return rows.withColumn("m", F.explode(F.array(*moments))).filter("m.due").select(
            F.lit(name).alias("list"), F.lit(allows).alias("allows"), "entry",
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("n") % first + F.col("m.after")).alias("day"), F.col("m.adds").alias("adds"),
        )

    places = captures.select(
        F.lower(F.regexp_extract("url", url_lists.HOST, 1)).alias("host"), F.lower(F.regexp_extract("url", url_lists.SEGMENT, 1)).alias("segment")
    ).filter("host <> ''").distinct()
    hosts = places.select(F.col("host").alias("entry")).distinct().withColumn("n", number("entry"))
    domains = hosts.filter(F.col("entry").contains(".")).select(F.regexp_replace("entry", r"^[^.]*\.", "").alias("entry")).distinct()
    sections = places.filter("segment <> ''").select(F.concat("host", F.lit("/"), "segment").alias("entry"))
    return (
        events(hosts.filter("n % 3 = 0"), "hosts", False, 200, (60, 2, False), (120, 4, True))
        .unionByName(events(domains.withColumn("n", number("entry")).filter("n % 5 = 0"), "domains", False, 300))
        .unionByName(events(sections.withColumn("n", number("entry")).filter("n % 4 = 0"), "sections", True, 250, (90, 1, False)))
    )


def op5_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 365).cast("int"))
    captures = _table(spark, folder, "pages").select("page_id", "url", day.alias("fetched"))
    return url_lists.filter_captures(captures, _dated_entries(captures))


def op6_recompression(spark: SparkSession, folder: str) -> DataFrame:
    kept = recompression.remove_repeats(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.withColumn("containment", F.round("containment", 9))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(_table(spark, folder, "documents"), carry=False)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(_table(spark, folder, "documents"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_licenses": op2_licenses,
    "op3_warc": op3_warc,
    "op4_simhash": op4_simhash,
    "op5_url_lists": op5_url_lists,
    "op6_recompression": op6_recompression,
    "op7_language": op7_language,
    "op8_decontamination": op8_decontamination,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_jaccard": op11_jaccard,
    "op12_divergence": op12_divergence,
    "op13_collocations": op13_collocations,
}

# XXH64 (4), trained models (7, 10) and the suffix automaton's labels (2) have no SQL form: tests/llm has brute force.
SQL = {
    "op1_mixing": oracles.MIX,
    "op3_warc": oracles.ROUND_TRIP,
    "op5_url_lists": oracles.CAPTURES,
    "op6_recompression": oracles.REPEATS,
    "op8_decontamination": oracles.CONTAINED,
    "op9_sharding": oracles.SHARDS,
    "op11_jaccard": oracles.JACCARD,
    "op12_divergence": oracles.DIVERGENCE,
    "op13_collocations": oracles.COLLOCATIONS,
}
