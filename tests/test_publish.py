import pytest

from spendlever import schemas as S
from spendlever.operators import publish as U
from spendlever.sources import star, tables

SCENARIO = U.Scenario("S", "B", "PRICEOFF", 2000, 1, 6, categories=["C"])
OUT_DDL = "scenario_name string, business string, category string, modelingname string, shisha string, channel string, date string, is_latest int, spends double"


def existing(spark):
    rows = [
        ("S", "B", "C", "PRICEOFF", "s", "c", "2000-06-30 23:59:59", 1, 1.0),
        ("T", "B", "C", "PRICEOFF", "s", "c", "2000-03-31 23:59:59", 1, 2.0),
        ("T", "B", "C", "PRICEOFF", "s", "c", "2000-09-30 23:59:59", 1, 3.0),
        ("T", "B", "D", "PRICEOFF", "s", "c", "2000-03-31 23:59:59", 1, 4.0),
        ("HISTORICAL_DATA", "B", "C", "LIQUIDATION", "s", "c", "2000-03-31 23:59:59", 1, 5.0),
    ]
    return spark.createDataFrame(rows, OUT_DDL)


def test_publication_is_idempotent_and_retires_overlaps(spark):
    final = spark.createDataFrame([("B", "C", "s", "c", 9.0, 0.1)], "business string, category string, shisha string, channel string, spends double, final_spend_change double")
    once = U.publish_scenario(existing(spark), final, SCENARIO)
    rows = {(r["scenario_name"], r["spends"]): r["is_latest"] for r in once.collect()}
    assert rows == {("S", 9.0): 1, ("T", 2.0): 0, ("T", 3.0): 1, ("T", 4.0): 1, ("HISTORICAL_DATA", 5.0): 1}
    again = U.publish_scenario(once, final, SCENARIO)
    assert {tuple(r) for r in again.select(*once.columns).collect()} == {tuple(r) for r in once.collect()}
    check = U.load_check(final, once, "S").first()
    assert (check["rows_written"], check["rows_loaded"], check["loaded"]) == (1, 1, True)


def test_published_label_of_a_list_is_text(spark):
    final = spark.createDataFrame([("B", ["PRICEOFF", "X"])], "business string, modelingname array<string>")
    out = U.publish_scenario(existing(spark), final, SCENARIO).filter("scenario_name = 'S'").first()
    assert out["modelingname"] == "PRICEOFF,X" and out["date"] == "2000-06-30 23:59:59"


def test_history_replaces_history(spark):
    history = spark.createDataFrame([("HISTORICAL_DATA", 7.0, 1)], "scenario_name string, baseline_volume double, is_latest int")
    out = U.publish_history(existing(spark), history).collect()
    assert sorted((r["scenario_name"], r["is_latest"]) for r in out) == [("HISTORICAL_DATA", 1), ("S", 0), ("T", 0), ("T", 0), ("T", 0)]


def test_status_upsert_is_idempotent(spark):
    ledger = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 1.0)], S.LEDGER)
    reports = spark.createDataFrame(
        [("a", 0, 0.6, 1, 1), ("a", 2, 0.7, 2, 2), ("c", 0, 0.01, 1, 3)],
        "scenarioname string, isoptimizationexecutioncompleted int, progressmessage double, reported_at int, report_no int",
    )
    once = U.status_upsert(ledger, reports)
    want = {("a", 2, 0.7), ("b", 1, 1.0), ("c", 0, 0.01)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in U.status_upsert(once, reports).collect()} == want


def test_request_is_parsed_by_uid(spark):
    doc = """{"scenarioPrameters": {"scenarioName": "my scenario"}, "optimizationInput": {"business": "B",
      "spendtype": "PRICEOFF", "channel": ["SM"], "category": ["C"], "budget": 12, "optimizationobjective": "%s",
      "max": "2024-11-30 23:59:59", "min": "2024-09-01 00:00:00", "shisha": ["T"]}}"""
    df = spark.createDataFrame([("u1", doc % star.BUDGET_SPEND), ("u2", doc % star.KEEP_SPEND)], "uid string, parameters string")
    row = U.scenario_params(df, "u1").first()
    scenario = U.scenario_from_row(row)
    assert (scenario.strategy, scenario.sub_strategy, scenario.goal_spend) == ("3", "1", 12.0)
    assert scenario.last_year_period == (2023, 9, 11) and row["table_suffix"] == "myscenario"
    other = U.scenario_from_row(U.scenario_params(df, "u2").first())
    assert (other.strategy, other.goal_spend) == ("2", None)
    months = [r["month_start"] for r in U.last_year_period(U.scenario_params(df, "u1")).orderBy("position").collect()]
    assert months == ["2023-11-01", "2023-10-01", "2023-09-01"]


def test_tables_round_trip(spark, tmp_path):
    spark.sql("create database if not exists lever")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    tables.write_catalog(df, "lever", "t")
    tables.write_catalog(df, "lever", "t", mode="append")
    assert tables.read_catalog(spark, "lever", "t").count() == 4
    tables.replace_catalog(tables.read_catalog(spark, "lever", "t").filter("i = 1"), "lever", "t")
    assert tables.read_catalog(spark, "lever", "t").count() == 2
    copy = tables.snapshot(tables.read_catalog(spark, "lever", "t").selectExpr("*", "1 as extra"), "lever", "copy")
    assert copy.columns == ["i", "s", "extra"]
    path = str(tmp_path / "ext")
    tables.write_external(df, "json", {"path": path})
    assert tables.read_external(spark, "json", {"path": path}).count() == 2
    csv = str(tmp_path / "c")
    df.write.option("header", True).csv(csv)
    assert tables.read_csv(spark, csv).columns == ["i", "s"]
    assert dict(tables.read_csv(spark, csv, df.schema).dtypes)["i"] == "int"


def test_missing_and_surplus_keys(spark):
    ddl = ", ".join(f"{c} string" for c in U.MATCH_KEY) + ", spends double"
    key = lambda seg: ("B", "C", "SC", seg, "SH", "CL", "CH", "CU", "PRICEOFF")
    output = spark.createDataFrame([(*key("a"), 1.0), (*key("x"), 2.0)], ddl)
    actual = spark.createDataFrame([(*key("a"), 5.0), (*key("b"), 6.0)], ddl)
    assert {r["segment"] for r in U.missing_keys_backfill(output, actual).collect()} == {"a", "x", "b"}
    assert {r["segment"] for r in U.key_semi_filter(output, actual).collect()} == {"a"}


def test_failed_stage_is_reported_and_raised(spark):
    from spendlever.plans.scenario import run_scenario

    seen = []
    broken = spark.createDataFrame([(1,)], "i int")
    with pytest.raises(Exception):
        run_scenario(SCENARIO, broken, broken, broken, broken, broken, broken, report=lambda s, p: seen.append((s, p)))
    assert seen == [(U.FAILED, 0.0)]
