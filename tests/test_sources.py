import pytest
from conftest import CARTS, PRODUCTS, USERS, write_pages
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.quality import evaluate_quality
from orderlens.plans import etl
from orderlens.sources import files, pages

ITEM = T.StructType([T.StructField("id", T.LongType())])
RECORDS = [{"id": i} for i in range(11)]


def test_pages_give_every_record_in_order(spark, tmp_path):
    path = write_pages(tmp_path / "items", "items", RECORDS, 4)
    read = pages.read_pages(spark, str(path), "items", ITEM)
    assert pages.page_contract(read, "items").first()["pages"] == 3
    rows = pages.page_records(read, "items").orderBy(*pages.POSITION).collect()
    assert [r["id"] for r in rows] == list(range(11))


@pytest.mark.parametrize(
    "changes",
    [
        {"total": 12}, {"skip": 9}, {"items": []}, {"total": None}, {"skip": 4}, {"items": [{"id": 8}, None, {"id": 10}]},
        {"items": [{"id": 8}]}, {"limit": None}, {"total": -1},
    ],
)
def test_broken_contract_is_rejected(spark, tmp_path, changes):
    path = write_pages(tmp_path / "items", "items", RECORDS, 4, **changes)
    with pytest.raises(pages.ContractError):
        pages.read_collection(spark, str(path), "items", ITEM)


def test_several_pages_in_one_file(spark, tmp_path):
    path = write_pages(tmp_path / "items", "items", RECORDS, 4)
    lines = "\n".join(p.read_text(encoding="utf-8") for p in sorted(path.iterdir()))
    (tmp_path / "one.json").write_text(lines, encoding="utf-8")
    assert pages.read_collection(spark, str(tmp_path / "one.json"), "items", ITEM).count() == 11
    (tmp_path / "wide.json").write_text('{"total": 1, "skip": 0,\n "limit": 4,\n "items": [{"id": 5}]}', encoding="utf-8")
    assert pages.read_collection(spark, str(tmp_path / "wide.json"), "items", ITEM, multi_line=True).first()["id"] == 5


def test_detail_views_must_agree(spark, tmp_path):
    for key, records in (("products", PRODUCTS), ("users", USERS), ("carts", CARTS)):
        write_pages(tmp_path / "landing" / key, key, records)
        write_pages(tmp_path / "same" / key, key, records)
        write_pages(tmp_path / "other" / key, key, [{**r, "id": r["id"] + 1} for r in records])
    found = etl.extract_all(spark, str(tmp_path / "landing"), details=str(tmp_path / "same"))
    assert found["carts"].count() == 1
    with pytest.raises(pages.ContractError):
        etl.extract_all(spark, str(tmp_path / "landing"), details=str(tmp_path / "other"))


def test_empty_collection_is_rejected(spark, tmp_path):
    with pytest.raises(pages.ContractError):
        pages.read_collection(spark, str(write_pages(tmp_path / "items", "items", [], 4)), "items", ITEM)


def test_detail_views_and_counts(spark):
    listing, detail = spark.range(5), spark.range(1, 6)
    rows = {(r["id"], r["side"]) for r in pages.detail_mismatches(listing, detail, "id").collect()}
    assert rows == {(0, "listing"), (5, "detail")}
    counts = pages.collection_counts({"a": 5, "b": 9}, a=listing, b=detail).collect()
    assert [r["agrees"] for r in counts] == [True, False]


def test_snapshot_keeps_count(spark, tmp_path):
    audit = pages.write_snapshot(spark.range(7), str(tmp_path / "snap"), "landed pages").first()
    assert (audit["source"], audit["count"]) == ("landed pages", 7)


def test_whole_job_from_pages_to_tables(spark, tmp_path):
    landing = tmp_path / "landing"
    for key, records in (("products", PRODUCTS), ("users", USERS), ("carts", CARTS)):
        write_pages(landing / key, key, records)
    result = etl.run(spark, str(landing), str(tmp_path / "out"))
    assert (result["rows"], result["columns"]) == (3, 48)
    assert result["quantity_sum"] == 20 and result["revenue_sum"] == pytest.approx(2427)
    assert result["source_counts"] == {"products": 3, "users": 1, "carts": 1}
    report = spark.read.option("header", True).csv(str(tmp_path / "out/quality/data_quality_report.csv"))
    assert report.count() == 18


def test_formats_reconcile_and_text_survives(spark, tmp_path, enriched):
    flagged = evaluate_quality(enriched.withColumn("city", F.lit('Bogotá, "centro"')))
    files.persist_orders(flagged, str(tmp_path), "orders_formats")
    totals = files.reconcile(spark, str(tmp_path), flagged.schema, "orders_formats").collect()
    assert {(r["filas"], r["suma_quantity"], round(r["suma_revenue"], 2)) for r in totals} == {(3, 20.0, 2427.0)}
    back = files.read_csv(spark, str(tmp_path / "orders_formats.csv"), flagged.schema)
    assert back.select("order_date", "revenue", "year_month").orderBy("revenue").collect() == flagged.select(
        "order_date", "revenue", "year_month"
    ).orderBy("revenue").collect()
    assert back.filter("city is null").count() == 0


def test_repeated_key_stops_the_sinks(spark, tmp_path, enriched):
    flagged = evaluate_quality(enriched.unionByName(enriched))
    with pytest.raises(ValueError):
        files.persist_orders(flagged, str(tmp_path), "orders_repeated")


def test_bucketed_table(spark, enriched):
    files.write_table(enriched, "orders_bucketed", buckets=4)
    assert spark.table("orders_bucketed").count() == 3


def test_lines_of_a_bucketed_table_are_not_shuffled(spark, tmp_path, enriched):
    from orderlens.operators import integrity, order_level

    files.write_table(enriched, "bucketed_lines", str(tmp_path / "bucketed"), buckets=4)
    table = spark.table("bucketed_lines")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(order_level.order_level(table))
    assert "Exchange" not in plan(integrity.order_product_pairs(table)) and "Exchange" in plan(order_level.order_level(enriched))
    assert order_level.order_level(table).count() == enriched.select("order_id").distinct().count()


def test_formats_in_several_passes(spark, tmp_path, repeated_orders):
    """Every line is written once whatever the passes, and a bucket is one file."""
    import glob

    dated = repeated_orders.withColumn("year_month", F.concat(F.lit("2024-"), F.col("order_id") % 5)).withColumn("year_month", F.expr("nullif(year_month, '2024-3')"))
    read = lambda path: sorted(map(str, spark.read.parquet(path).select(*dated.columns).collect()))
    for passes in (1, 3):
        released = []
        files.write_formats(dated, str(tmp_path / f"{passes}"), f"formats_{passes}", 4, passes, lambda: released.append(True))
        assert released == [True]
    assert read(f"{tmp_path}/3/formats_3.parquet") == read(f"{tmp_path}/1/formats_1.parquet") and len(read(f"{tmp_path}/3/formats_3.parquet")) == 60
    assert read(f"{tmp_path}/3/formats_3_table") == read(f"{tmp_path}/1/formats_1_table") == read(f"{tmp_path}/1/formats_1.parquet")
    assert len(glob.glob(f"{tmp_path}/3/formats_3_table/*.parquet")) == len(glob.glob(f"{tmp_path}/1/formats_1_table/*.parquet"))
    assert {r["filas"] for r in files.reconcile(spark, str(tmp_path / "3"), dated.schema, "formats_3").collect()} == {60}


def test_reconciled_formats_leave_the_formats_only(spark, monkeypatch, repeated_orders):
    """What the lines are made of is gone before the second format is written, and the session keeps its settings."""
    import os

    import registry
    from orderlens.session import stored
    from orderlens.sources import star_tables

    made, there = [], []
    lines = lambda spark, sf: made.append(stored(repeated_orders)) or made[0]
    csv = files.write_csv
    monkeypatch.setattr(star_tables, "enriched", lines)
    monkeypatch.setattr(files, "write_csv", lambda df, path: there.append(os.path.exists(folder())) or csv(df, path))
    folder = lambda: paths[0].removeprefix("file:").rsplit("/", 1)[0]
    paths = []
    keep = files.write_parquet
    monkeypatch.setattr(files, "write_parquet", lambda df, *a, **o: paths.extend(made[0].inputFiles()) or keep(df, *a, **o))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    found = registry.load()["reconcile_formats"].run(spark, "")
    assert {r["filas"] for r in found.collect()} == {60} and there == [False] and spark.conf.get(key, None) == before


def test_landed_counts(spark, tmp_path):
    path = write_pages(tmp_path / "users", "users", [{"id": i} for i in range(9)], 4)
    landed = pages.read_pages(spark, str(path), "users")
    row = pages.landed_counts(users=landed.filter("skip <> 4")).first()
    assert (row["records"], row["declared"], row["agrees"]) == (5, 9, False)
    row = pages.landed_counts(users=landed.limit(0)).first()
    assert (row["records"], row["declared"], row["agrees"]) == (0, None, False)


def test_scratch_removes_its_tables_only(spark):
    from orderlens.session import scratch, stored

    kept = stored(spark.range(3))
    with scratch(spark):
        gone = stored(spark.range(5))
        assert gone.count() == 5
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(gone.inputFiles()[0]).count()
