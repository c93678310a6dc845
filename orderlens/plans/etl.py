"""Landed collections -> enriched, checked, persisted order lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.enrich import ENRICHED_COLUMNS, build_orders_enriched, join_invariant, normalize_carts
from orderlens.operators.quality import evaluate_quality, iqr_fences, quality_report
from orderlens.session import stored
from orderlens.sources import files, pages


def extract_all(spark: SparkSession, landing: str, raw: str | None = None, details: str | None = None) -> dict[str, DataFrame]:
    """The three checked collections; where a folder of detail views is given, it must hold the orders of the listing."""
    found = {key: pages.read_collection(spark, f"{landing}/{key}", key) for key in ("products", "users", "carts")}
    if details is not None:  # the orders one by one: the same ids as the listing, or the extract is not complete
        single = pages.read_pages(spark, f"{details}/carts", "carts").select(F.explode("carts").alias("r")).select("r.id")
        if not pages.detail_mismatches(found["carts"], single, "id").isEmpty():
            raise pages.ContractError("carts: listing and detail view hold different ids")
    if raw is not None:
        for key, records in found.items():
            pages.write_snapshot(records, f"{raw}/{key}", "landed pages")
    return found


def transform(collections: Mapping[str, DataFrame], **options) -> tuple[DataFrame, DataFrame]:
    """Enriched lines with quality columns, and the quality report. The joined frame is computed once."""
    enriched = stored(build_orders_enriched(**collections, position=pages.POSITION, **options))
    kept = join_invariant(normalize_carts(collections["carts"]), enriched).first()
    if not kept["kept"]:
        raise ValueError(f"the joins changed the number of lines: {kept.asDict()}")
    fences = iqr_fences(enriched, ["revenue", "quantity"])
    flagged = evaluate_quality(enriched, fences=fences).select(*ENRICHED_COLUMNS)
    return flagged, quality_report(enriched, fences=fences)


def run(spark: SparkSession, landing: str, out: str) -> dict:
    """The whole job; returns the validation with the source counts."""
    collections = extract_all(spark, landing, f"{out}/raw")
    flagged, report = transform(collections)
    files.write_report(report.orderBy("orden").drop("orden"), f"{out}/quality/data_quality_report.csv")
    validation = files.persist_orders(flagged, f"{out}/processed")
    counts = {key: df.agg(F.count(F.lit(1))).first()[0] for key, df in collections.items()}
    return {**validation, "source_counts": counts}
