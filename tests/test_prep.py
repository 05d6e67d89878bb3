from functools import reduce

from pyspark.sql import DataFrame

from spendlever import schemas as S
from spendlever.operators import prep as P
from spendlever.sources import star

FACT_DDL = ", ".join([
    "year int", "month int", *[f"{d} string" for d in S.DIMENSIONS], "modelingname string",
    *[f"{c} double" for c in S.FACT_COLUMNS[11:]],
])


def fact_row(name, spends, gps, volume, segment="S1", month=3):
    price = gps / volume if volume else None
    unit = 1.0 if volume else None
    return (1999, month, "B", "C", "SC", segment, "SH", "CL", "CH", "CU", name,
            spends, gps, gps - spends, volume, price, volume, unit, gps - spends - volume)


def fact(spark, *rows):
    return spark.createDataFrame(list(rows), FACT_DDL)


def test_share_of_zero_total_is_zero_and_totals_are_excluded(spark):
    df = fact(spark, fact_row("PRICEOFF", 0.0, 30.0, 0.0), fact_row("Own Price", 0.0, 10.0, 0.0),
              fact_row("Volume", 99.0, 99.0, 99.0))
    rows = {r["modelingname"]: r for r in P.contribution_share(df).collect()}
    assert set(rows) == {"PRICEOFF", "Own Price"}
    assert rows["PRICEOFF"]["spends_contri"] == 0.0 and rows["PRICEOFF"]["gps_contri"] == 0.75
    assert rows["PRICEOFF"]["price"] is None


def test_half_rounds_up(spark):
    df = fact(spark, fact_row("PRICEOFF", 1.0, 1.0, 1.0), fact_row("Own Price", 79.0, 79.0, 79.0))
    rows = {r["modelingname"]: r["vol_contri"] for r in P.contribution_share(df).collect()}
    assert rows["PRICEOFF"] == 0.013


def test_keys_without_actuals_become_zero(spark):
    df = fact(spark, fact_row("PRICEOFF", 5.0, 10.0, 2.0))
    empty = P.actuals_rollup(star.booked_actuals(df.filter("false")))
    row = P.rescale_to_actuals(P.contribution_share(df), empty).first()
    assert (row["spends"], row["gps"], row["volume"], row["netsales"]) == (0.0, 0.0, 0.0, 0.0)
    back = P.rescale_to_actuals(P.contribution_share(df), P.actuals_rollup(star.booked_actuals(df))).first()
    assert (back["spends"], back["gps"], back["volume"]) == (5.0, 10.0, 2.0)


def test_price_change_keeps_its_units(spark):
    df = fact(spark, fact_row("PRICEOFF", 5.0, 10.0, 2.0), fact_row("Own Price", 0.0, 30.0, 2.0))
    feed = spark.createDataFrame([("S1", 0.02)], "segment string, price_change double")
    out = {r["modelingname"]: r for r in P.price_change_passthrough(df, feed, P.driver_share_pct(df)).collect()}
    # Own price holds 50 percent of the volume: the multiplier is 0.02 * 50 = 1 percent point.
    assert out["PRICEOFF"]["volume"] == 4.0 and out["Own Price"]["volume"] == 0.0
    assert out["PRICEOFF"]["price"] == 5.1 and out["PRICEOFF"]["spends"] == 5.0


def feed_rows(spark, index, salesamt, spend):
    return spark.createDataFrame(
        [("199901", 1999, 1, "1999-01-04", "SEG", "SH", f"old{index}", "new", "New", spend, 0.0, 0.0, salesamt,
          0.25, 0.25, 0.25, 0.75, 0.75, 0.75)],
        "yearmonth string, year int, month int, week_start string, segment string, shishanm string, "
        "old_planningcustomercd string, new_planningcustomercd string, new_planningcustomer string, "
        "new_priceoff double, new_liquidation double, new_promotionad double, salesamt double, "
        "ini_contri_po double, ini_contri_liq double, ini_contri_pa double, "
        "add_contri_po double, add_contri_liq double, add_contri_pa double",
    )


def test_four_feeds_are_united_by_name_and_filtered(spark):
    feeds = [feed_rows(spark, i, amount, spend) for i, (amount, spend) in
             enumerate([(10.0, 8.0), (0.0, 8.0), (0.0, 0.0), (5.0, 4.0)])]
    feeds[3] = feeds[3].select(*reversed(feeds[3].columns))
    master = spark.createDataFrame([("old0", "Zero"), ("old0", "Zero"), ("old3", "Three")],
                                   "planningcustomercd string, planningcustomer string")
    rows = {r["old_planningcustomer"]: (r["ini_priceoff"], r["add_priceoff"])
            for r in P.branch_money_split(feeds, master).collect()}
    assert rows == {"Zero": (2.0, 6.0), None: (0.0, 0.0), "Three": (1.0, 3.0)}


def test_category_rules_apply_in_order(spark):
    money = ", ".join(f"1.5D as {c}" for c in P.BRANCH_MONEY)
    df = spark.sql(f"select explode(array('A/x', 'A/y', 'B/x', \"it's\")) as segment, {money}".replace("\"it's\"", "'C'"))
    out = {r["category"]: r["new_priceoff"] for r in P.category_from_path(df, [("A/", "a"), ("x", "x")], "it's").collect()}
    assert out == {"a": 6.0, "x": 3.0, "it's": 3.0}


def test_null_profile_counts_nan_on_floats_only(spark):
    df = spark.createDataFrame([(None, float("nan")), ("NaN", None), ("b", 1.0)], "s string, d double")
    assert {r["column_name"]: r["missing"] for r in P.null_profile(df).collect()} == {"s": 1, "d": 2}


def test_decomp_view_text_and_predicates(spark):
    rows = fact(spark, fact_row("PRICEOFF", 5.0, 10.0, 2.0, month=2), fact_row("Own Price", 0.0, 0.0, 0.0))
    totals = fact(spark, fact_row("Volume", 1.0, 1.0, 1.0), fact_row("Own Price", 7.0, 7.0, 7.0))
    out = {r["modelingname"]: r for r in P.decomp_view(rows, totals).collect()}
    assert set(out) == {"PRICEOFF", "Volume"}
    assert (out["PRICEOFF"]["date"], out["PRICEOFF"]["month"], out["PRICEOFF"]["half_year"]) == ("1999-02-28 23:59:59", "02", 1)
    assert P.decomp_view(rows, totals, "spends > 0 or volume >= 0 or gps != 0 or netsales != 0").count() == 3


def test_history_excludes_accumulate(spark):
    df = fact(spark, fact_row("PRICEOFF", 1.0, 8.0, 2.0), fact_row("PROMOTIONAD", 1.0, 8.0, 3.0),
              fact_row("LIQUIDATION", 1.0, 8.0, 5.0), fact_row("Own Price", 0.0, 8.0, 7.0), fact_row("Volume", 0.0, 8.0, 99.0))
    out = {r["modelingname"]: r for r in P.history_baseline(df, df).collect()}
    assert {k: r["baseline_volume"] for k, r in out.items()} == {"PRICEOFF": 15.0, "PROMOTIONAD": 12.0, "LIQUIDATION": 7.0}
    assert (out["PRICEOFF"]["year"], out["PRICEOFF"]["date"]) == (2000, "2000-06-30 23:59:59")


def test_override_merge_cases(spark):
    old = P.decomp_view(fact(spark, fact_row("PRICEOFF", 1.0, 8.0, 2.0), fact_row("PRICEOFF", 3.0, 8.0, 2.0, "S2")),
                        fact(spark, fact_row("PREDICTED_SALES", 9.0, 9.0, 9.0)))
    fresh = P.replacement_rows(fact(spark, fact_row("PRICEOFF", 5.0, 8.0, 2.0), fact_row("Own Price", 2.0, 8.0, 4.0)))
    got = {(r["segment"], r["modelingname"]): r["spends"] for r in P.override_merge(old, fresh, ["S1"]).collect()}
    assert got == {("S1", "PRICEOFF"): 5.0, ("S1", "Own Price"): 2.0, ("S1", "Volume"): 7.0,
                   ("S1", "PREDICTED_SALES"): 9.0, ("S2", "PRICEOFF"): 3.0}


def test_imputation_meets_actuals(spark, sf_dir):
    df = fact(spark, fact_row("PRICEOFF", 1.0, 8.0, 2.0), fact_row("Own Price", 3.0, 8.0, 2.0), fact_row("Volume", 4.0, 4.0, 4.0))
    actual = df.filter("modelingname = 'PRICEOFF'").selectExpr(*S.KEY5, "10D as spends", "gps", "netsales")
    out = {r["modelingname"]: r["spends"] for r in P.ratio_impute(df, actual).collect()}
    assert out == {"PRICEOFF": 2.5, "Own Price": 7.5, "Volume": 10.0}


def test_reconciliation_lists_one_sided_keys(spark):
    a = fact(spark, fact_row("PRICEOFF", 1.0, 8.0, 2.0))
    b = fact(spark, fact_row("PRICEOFF", 1.0, 8.0, 2.0, "S2"))
    rows = P.reconcile_totals(a, b, ["segment"], ["gps"]).collect()
    assert {(r["segment"], r["before"], r["after"], r["diff"]) for r in rows} == {("S1", 8.0, 0.0, -8.0), ("S2", 0.0, 8.0, 8.0)}


def test_fact_is_unique_at_its_grain(spark, sf_dir):
    f = star.promo_fact(spark, sf_dir)
    lines = star.promo_lines(spark, sf_dir)
    key = [*S.KEY10, "modelingname"]
    assert f.groupBy(*key).count().filter("count > 1").count() == 0
    assert f.selectExpr("sum(cast(gps as decimal(28,4)))").first() == lines.selectExpr("sum(cast(gps as decimal(28,4)))").first()
    assert reduce(DataFrame.unionByName, [f, f]).count() == 2 * f.count()


def test_grand_total_and_null_keys_reconcile(spark):
    schema = "category string, spends double, netsales double, gps double, volume double"
    before = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0), (None, 1.0, 2.0, 3.0, 4.0)], schema)
    after = spark.createDataFrame([(None, 2.0, 2.0, 3.0, 4.0), ("b", 1234.5, 0.0, 0.0, 0.0)], schema)
    total = {r["measure"]: r for r in P.reconcile_totals(before, after, []).collect()}
    assert total["spends"]["diff"] == 1234.5 and total["spends"]["after_text"] == "1,236.50"
    assert (total["spends"]["rows_before"], total["spends"]["rows_after"]) == (2, 2)
    keyed = P.reconcile_totals(before, after, ["category"]).filter("measure = 'spends'").collect()
    assert {(r["category"], r["before"], r["after"]) for r in keyed} == {("a", 1.0, 0.0), (None, 1.0, 2.0), ("b", 0.0, 1234.5)}


def test_equal_lines_are_two_bookings(spark):
    line = ("199901", 1999, 1, "1999-01-04", "S", "X", "CD-a", "CD-a", "a", 5.0, 0.0, 0.0, 10.0, *[1.0] * 3, *[0.0] * 3)
    kinds = ["priceoff", "promotionad", "liquidation"]
    schema = ", ".join([
        "yearmonth string, year int, month int, week_start string, segment string, shishanm string",
        "old_planningcustomercd string, new_planningcustomercd string, new_planningcustomer string",
        *[f"new_{k} double" for k in kinds], "salesamt double",
        *[f"{k}_contri_{c} double" for k in ("ini", "add") for c in ("po", "liq", "pa")],
    ])
    feed = spark.createDataFrame([line, line], schema)
    names = spark.createDataFrame([("CD-a", "a")], "planningcustomercd string, planningcustomer string")
    out = P.branch_money_split([feed], names).collect()
    assert [(r["ini_priceoff"], r["old_planningcustomer"]) for r in out] == [(10.0, "a")]
