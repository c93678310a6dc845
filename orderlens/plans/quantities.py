"""Stored order lines -> quantity scenarios, forest predictions and their comparison."""

from __future__ import annotations

from pyspark.sql import SparkSession

from orderlens.models.quantity_model import QuantityModel, train_missing_quantity_model
from orderlens.sources import files


def run(spark: SparkSession, processed: str, out: str, **options) -> QuantityModel:
    orders = files.read_parquet(spark, f"{processed}/orders_enriched.parquet")
    result = train_missing_quantity_model(orders, model_path=f"{out}/random_forest_quantity", **options)
    result.predictions.write.mode("overwrite").parquet(f"{out}/missing_quantity_predictions")
    files.write_report(result.feature_importance, f"{out}/feature_importance.csv")
    files.write_report(result.scenario_comparison, f"{out}/scenario_comparison.csv")
    return result
