"""Stored order lines -> customer features, segments, profiles, projection."""

from __future__ import annotations

from pyspark.sql import SparkSession

from orderlens.models.features import build_customer_features
from orderlens.models.segmentation import Segmentation, train_segmentation
from orderlens.sources import files


def run(spark: SparkSession, processed: str, out: str, **options) -> Segmentation:
    features = build_customer_features(files.read_parquet(spark, f"{processed}/orders_enriched.parquet"))
    result = train_segmentation(features, model_path=f"{out}/customer_segmentation", **options)
    features.write.mode("overwrite").parquet(f"{out}/customer_features")
    result.assignments.write.mode("overwrite").parquet(f"{out}/customer_segments")
    result.pca.write.mode("overwrite").parquet(f"{out}/pca_coordinates")
    files.write_report(result.comparison, f"{out}/model_comparison.csv")
    files.write_report(result.profiles, f"{out}/segment_profiles.csv")
    return result
