"""Raw datasets, mirrors, named queries and the table rebuild."""

import pytest
from conftest import same_rows
from raw_fixture import PEOPLE, frames
from pyspark.sql import functions as F

from tidewatch.plans.tables import rebuild
from tidewatch.sources import adapters, mirror, named_queries, raw

def test_raw_write_counts_and_reads_back(spark, tmp_path):
    df = frames(spark)["subscribers"]
    assert raw.write_raw(df, str(tmp_path), "subscribers") == PEOPLE
    back = raw.read_raw(spark, str(tmp_path), "subscribers")
    same_rows(back, df)
    assert back.schema["monthly_arpu_usd"].dataType.simpleString() == "decimal(9,2)"


def test_missing_optional_table_is_empty_with_schema(spark, tmp_path):
    df = raw.read_optional(spark, str(tmp_path / "absent"), "a int, b string")
    assert df.count() == 0 and df.dtypes == [("a", "int"), ("b", "string")]
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(tmp_path / "there"))
    assert raw.read_optional(spark, str(tmp_path / "there"), "a int, b string").count() == 1


def test_publish_only_when_empty_or_forced(spark, tmp_path):
    root = str(tmp_path / "m")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    second = spark.createDataFrame([(2, "changed"), (3, "c")], "id int, v string")
    read = lambda: {r.id: r.v for r in mirror.read_mirror(spark, root, first.schema).collect()}
    assert mirror.publish(first, root, "id") == 1 and read() == {1: "a", 2: "b"}
    assert mirror.publish(second, root, "id") == 1 and read() == {1: "a", 2: "b"}
    assert mirror.publish(second, root, "id", force=True) == 2 and read() == {1: "a", 2: "b", 3: "c"}
    log = str(tmp_path / "log")
    spark.createDataFrame([(7,)], "x int").write.parquet(log)
    assert mirror.reset(second, root, "id", log, spark.createDataFrame([], "x int").schema) == 3
    assert read() == {2: "changed", 3: "c"} and spark.read.schema("x int").parquet(log).count() == 0


def test_half_written_version_is_ignored(spark, tmp_path):
    root = str(tmp_path / "m")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    mirror.publish(df, root, "id")
    (tmp_path / "m" / "v=2").mkdir()
    assert mirror.current_version(spark, root) == 1


@pytest.mark.parametrize("text,n", [
    ('[{"offerType":"bill_credit","costUsd":40.0}]', 1), ("[]", 0), ("", 0), (None, 0), ('{"offerType":"x"}', 0),
    ('[{"offerType":"bill_credit"', 0), ("not json", 0), ("[1,", 0), ('[{"offerType":"a"},{"offerType":"b"}]', 2)])
def test_ranking_parse(spark, text, n):
    row = spark.createDataFrame([(text,)], "t string").select(mirror.parse_ranking(F.col("t")).alias("r")).first()
    assert len(row.r) == n


@pytest.mark.parametrize("cell,value", [
    ("12", 12.0), ("-3.50", -3.5), ("2024-01-30", None), ("1e5", None), ("1.", None), (".5", None), (" 1", None), ("", None), (None, None)])
def test_numeric_cell(spark, cell, value):
    df = spark.createDataFrame([(cell,)], "c string")
    assert mirror.numeric_cells(df, ["c"]).first().c_num == value


def test_enum_coercion(spark):
    df = spark.createDataFrame([("critical", "bill_credit"), ("odd", "odd"), (None, None)], "b string, o string")
    rows = df.select(mirror.coerce_band(F.col("b")).alias("b"), mirror.coerce_offer(F.col("o")).alias("o")).collect()
    assert [tuple(r) for r in rows] == [("critical", "bill_credit"), ("healthy", None), ("healthy", None)]


def test_named_queries(spark, lake):
    from tidewatch.operators import returns as R
    for t in ("silver_returns", "silver_order_items", "lots", "products"):
        lake[t].createOrReplaceTempView(f"tw_{t}")
    names = {"returns": "tw_silver_returns", "items": "tw_silver_order_items", "lots": "tw_lots", "products": "tw_products"}
    got = named_queries.run_named(spark, "worst_lots", **names)
    want = R.worst_lots(lake["lots"], lake["products"], lake["silver_order_items"], lake["silver_returns"])
    assert [(r.lot_id, r.return_rate_pct, r.region) for r in got.collect()] == [(r.lot_id, r.return_rate_pct, r.region) for r in want.collect()]
    assert named_queries.run_named(spark, "daily_refund_trend", as_of="2024-01-30", **names).count() == \
        R.daily_refund_trend(lake["silver_returns"], lake.p).count()
    assert named_queries.run_named(spark, "returns_by_product", **names).count() == 10
    with pytest.raises(KeyError):
        named_queries.run_named(spark, "drop table x")


def test_long_ids_are_not_cut(spark):
    row = spark.createDataFrame([(123456789,)], "i bigint").select(adapters.subscriber_key(F.col("i")).alias("k")).first()
    assert row.k == "SUB-123456790"


def test_rebuild_writes_every_table(spark, lake, tmp_path):
    counts = rebuild(lake, str(tmp_path))
    assert counts["gold_subscriber_position"] == lake["customer"].count()
    assert counts["gold_open_atrisk"] == counts["gold_retention_recommendations"] == lake.book.count()
    risk = spark.read.parquet(f"{tmp_path}/silver_risk").filter("snapshot_date = DATE '2024-01-30'")
    assert "PartitionFilters: [isnotnull(snapshot_date" in risk._jdf.queryExecution().executedPlan().toString()
