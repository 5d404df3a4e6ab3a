import pytest
from helpers import day, frame, rows

from riskspark.session import materialise, shared_folder
from riskspark.sources import schemas, tables


def test_append_month_replaces_only_its_month(spark, tmp_path):
    path = str(tmp_path / "scores")
    cols = "AccountNumber long, v int, SnapshotDate date"
    tables.append_month(frame(spark, cols, [(1, 1, "2024-01-31"), (2, 1, "2024-01-31"), (1, 1, "2024-02-29")]), path, "SnapshotDate")
    tables.append_month(frame(spark, cols, [(1, 2, "2024-02-29")]), path, "SnapshotDate")
    assert rows(spark.read.parquet(path), "AccountNumber", "v", "SnapshotDate") == [
        (1, 1, day("2024-01-31")), (1, 2, day("2024-02-29")), (2, 1, day("2024-01-31"))]


def test_insert_manual_row(spark, tmp_path):
    path = str(tmp_path / "cost")
    for cost in (5.0, 7.0):
        tables.insert_manual_row(spark, path, schemas.ONLINE_COST, {"YearMonth": 202404, "Cost": cost}, "YearMonth")
    assert rows(spark.read.parquet(path), "YearMonth", "Cost") == [(202404, 7.0)]


def test_read_table_empty_and_nan(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(str(tmp_path / "t.parquet"))
    assert tables.read_table(spark, "t", root=str(tmp_path)).filter("x is null").count() == 1
    spark.createDataFrame([], "x double").write.parquet(str(tmp_path / "e.parquet"))
    with pytest.raises(ValueError):
        tables.read_table(spark, "e", root=str(tmp_path), require_non_empty=True)


def test_read_table_filter_reaches_the_scan(spark, tmp_path):
    frame(spark, "SnapshotDate date, x int, y int", [("2024-01-31", 1, 1)]).write.parquet(str(tmp_path / "p.parquet"))
    df = tables.read_table(spark, "p", root=str(tmp_path), as_of="2024-01-31").select("x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(SnapshotDate,2024-01-31)" in plan and "ReadSchema: struct<SnapshotDate:date,x:int>" in plan


def test_csv_with_schema_and_manual_mapping(spark, tmp_path):
    tables.write_tape(spark.createDataFrame([(1, "a"), (2, "b")], "AccountNumber long, s string"), str(tmp_path / "c"), "csv")
    assert rows(tables.read_csv(spark, str(tmp_path / "c"), "AccountNumber long, s string"), "AccountNumber", "s") == [(1, "a"), (2, "b")]
    got = tables.read_manual_input(spark, str(tmp_path / "c"), "`Loan account` string, s string", {"Loan account": ("AccountNumber", "long")})
    assert got.columns == ["AccountNumber"] and got.count() == 2


def test_commission_copy(spark):
    setup = frame(spark, "BrokerName string, CommissionPct double, validFrom date, validTo date, Product string", [
        ("a", 0.01, "2024-01-01", "2024-12-31", "old"), ("b", 0.03, "2024-01-01", "2024-12-31", "old"), ("b", 0.02, "2024-01-01", "2024-12-31", "old"),
        ("c", 0.01, "2024-01-01", "2024-12-31", "old"), ("a", 0.05, "2020-01-01", "2020-12-31", "old"), ("d", 0.01, "2024-01-01", "2024-12-31", "old")])
    apps = spark.createDataFrame([("a", "new"), ("a", "new"), ("b", "new"), ("c", "new"), (None, "new"), ("d", "other")], "BrokerName string, Product string")
    got = tables.copy_commission_setup(setup, apps, "new", "2024-06-01", ("c",), {"b": 0.03})
    assert rows(got, "BrokerName", "CommissionPct", "Product") == [("a", 0.01, "new"), ("b", 0.03, "new")]


def test_shared_folder_is_the_configured_one(spark):
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder
    df = materialise(spark.range(3).toDF("x"), "t")
    assert df.count() == 3 and folder.rstrip("/").split("/")[-1] in df.inputFiles()[0]


def test_declared_schemas_parse(spark):
    for name in (n for n in dir(schemas) if n.isupper()):
        assert spark.createDataFrame([], getattr(schemas, name)).columns
