"""What keeps the table queries small: where users are joined, what is computed once, how large a task gets."""

from datetime import datetime

import numpy as np
import pytest

import registry
from orderlens import session
from orderlens.models import mixture, segmentation
from orderlens.operators import enrich, profile
from orderlens.sources import files
from orderlens.sources import star_tables as star

DAY = datetime(1996, 5, 17)
ROWS = {
    "region": [(0, "EUROPE"), (1, "ASIA")],
    "nation": [(0, "SPAIN", 0), (1, "JAPAN", 1)],
    "customer": [(k, f"Customer {k}", k % 2, 1.0, "MACHINERY") for k in range(6)] + [(3, "Another", 0, 1.0, "BUILDING")],
    "part": [(k, f"part {k}", "Brand", f"TYPE {k % 3}", k, 900.0 + k) for k in range(8)],
    "orders": [(k, (k % 7) if k % 5 else None, "FOP"[k % 3], 1.0, DAY.replace(day=1 + k % 28), "2-HIGH") for k in range(30)],
    "lineitem": [
        (k % 30, k % 9, 0, k // 30, 1.0 + k % 5, 1000.0 * (1 + k % 7), 0.05, 0.0, "N", "O", DAY) for k in range(90)
    ],
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("star")
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, star.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_users_are_joined_to_the_orders(spark, tables):
    buyers = enrich.prepare_users(star.users(spark, tables))
    columns = ["order_id", "line_number", "product_id", "user_id", "country", "customer_name", "user_match_flag", "reported_total_products"]
    before = enrich.join_dimensions(star.lines(spark, tables), None, buyers).select(*columns)
    after = star.lines(spark, tables, buyers=buyers).select(*columns)
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect()))
    whole = star.enriched(spark, tables, *columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, before.collect()))
    plan = whole._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line and "user_id" in line)
    depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
    below = []
    for line in plan[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        below.append(line)
    assert not any("l_partkey" in line for line in below)


def test_features_are_computed_once(spark, tables, monkeypatch):
    seen = []
    kept = segmentation.fit_preprocessor
    monkeypatch.setattr(segmentation, "fit_preprocessor", lambda rows: seen.append(rows) or kept(rows))
    queries = registry.load()
    queries["standard_scores"].run(spark, tables)
    queries["segmentation_projection"].run(spark, tables)
    assert len(seen) == 2
    assert not any("Aggregate" in rows._jdf.queryExecution().optimizedPlan().toString() for rows in seen)


def test_report_reads_a_stored_table(spark, tables, monkeypatch):
    seen = []
    kept = profile.schema_report
    monkeypatch.setattr(profile, "schema_report", lambda df: seen.append(df) or kept(df))
    assert registry.load()["schema_report"].run(spark, tables).count() == len(seen[0].columns)
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_text_files_are_compressed(spark, tmp_path):
    df = spark.createDataFrame([(1, "á, b"), (2, None), (3, "c")], "n int, t string")
    files.write_csv(df, str(tmp_path / "t.csv"))
    assert all(p.name.endswith(".csv.gz") for p in (tmp_path / "t.csv").glob("part-*"))
    assert sorted(files.read_csv(spark, str(tmp_path / "t.csv"), df.schema).collect()) == sorted(df.collect())


def test_tasks_are_small_unless_the_session_says_otherwise(spark):
    own = spark.newSession()
    own.conf.unset("spark.sql.files.maxPartitionBytes")
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "3m")
    session.small_tasks(own)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == session.TABLE_SETTINGS["spark.sql.files.maxPartitionBytes"]
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "3m"


def test_sparse_moments_agree_with_dense_ones():
    rng = np.random.default_rng(4)
    n = 2500  # more than a chunk
    x = np.hstack([rng.normal(size=(n, 3)), np.eye(40)[rng.integers(0, 40, n)], np.eye(5)[rng.integers(0, 5, n)]])
    x[::7, 1] = 0.0
    x[5] = 0.0
    models = [mixture.updated(mixture.moments(x, x[rng.integers(0, n, k)]), k, x.shape[1]) for k in (2, 3)]
    at, values = mixture.nonzero_slots(x)
    assert at.shape == (n, 5)
    found = mixture.sparse_moments(at, values, x.shape[1], models, mixture._Forms.of(models))
    for sums, model in zip(found, models, strict=True):
        np.testing.assert_allclose(sums, mixture.moments(x, model), rtol=1e-6, atol=1e-6)


def test_no_method_of_a_table_query_is_too_long_to_be_compiled(spark):
    own = spark.newSession()
    assert session.small_tasks(own).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"  # HotSpot's own limit
    own.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert session.small_tasks(own).conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"
