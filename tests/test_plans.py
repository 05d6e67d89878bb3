import pytest

from spendlever import queries as Q, schemas as S
from spendlever.functions.lineage import settle
from spendlever.operators import publish as U
from spendlever.plans.preparation import check_reallocation, prepare
from spendlever.plans.scenario import catalog_ledger, publish_in_place, run_request, run_scenario
from spendlever.sources import star


def test_preparation_and_scenario_end_to_end(spark, sf_dir):
    fact = settle(star.promo_fact(spark, sf_dir))
    lines = star.promo_lines(spark, sf_dir)
    actuals = star.booked_actuals(fact)
    stages = prepare(
        fact, actuals, star.price_change_feed(spark, sf_dir), [star.branch_feed(lines)],
        star.customer_master(spark, sf_dir),
    )
    for name in ("rescaled", "decomp_view", "history"):
        assert stages[name].count() > 0
    check = check_reallocation(stages["repriced"], stages["reattributed"], ["modelingname"])
    assert check.count() == len(S.SPEND_TYPES) * len(S.MEASURES)

    # No spend type gains or loses money, up to the rounding of single rows.
    assert check.filter("abs(diff) > 0.001 * (rows_before + rows_after)").count() == 0

    seen = []
    out = run_scenario(
        Q.SCENARIO, stages["rescaled"], stages["repriced"], fact, actuals,
        stages["branch_money"], star.published_output(fact), report=lambda s, p: seen.append((s, p)),
    )
    assert seen[-1] == (U.DONE, 1.0) and all(s == U.RUNNING for s, _ in seen[:-1])
    assert [p for _, p in seen] == sorted(p for _, p in seen)
    stage1 = out["stage1"]
    assert stage1.filter("optimized_spends < spends_lb - 1e-5 or optimized_spends > spends_ub + 1e-5").count() == 0
    totals = stage1.selectExpr("sum(optimized_spends) as z", "sum(last_year_period_spends) as s").first()
    assert totals["z"] <= totals["s"] + 1e-3
    final = out["final"]
    assert final.filter("spend_change > 1e-9 and netsales_change < -1e-9").count() == 0
    assert out["load_check"].first()["loaded"]


def test_publishing_in_place_touches_its_years_only_and_repeats(spark, sf_dir):
    fact = star.promo_fact(spark, sf_dir)
    spark.sql("CREATE DATABASE IF NOT EXISTS plans")
    star.published_output(fact).write.partitionBy("year").mode("overwrite").saveAsTable("plans.published")
    table = lambda: spark.table("plans.published")
    before = table().count()
    final = table().filter("year = 1999").limit(7).select(*S.DIMENSIONS, "modelingname", "optimized_spends").distinct()
    final = settle(final)
    old = U.Scenario("S1", "VALUE", S.PRICEOFF, 1998, 1, 6)
    new = U.Scenario("S1", "VALUE", S.PRICEOFF, 2000, 1, 6)
    n = final.count()
    for scenario in (old, new, new):  # moved to another year, then repeated
        publish_in_place(final, scenario, "plans", "published")
        rows = table().filter("scenario_name = 'S1'")
        assert rows.count() == n and {r["year"] for r in rows.select("year").collect()} == {scenario.year}
        assert table().count() == before + n
    assert table().filter("scenario_name = 'S1' and is_latest = 1 and date = '2000-06-30 23:59:59'").count() == n


def test_ledger_keeps_the_newest_report(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS plans")
    spark.createDataFrame([("other", 1, 1.0)], S.LEDGER).write.mode("overwrite").saveAsTable("plans.ledger")
    report = catalog_ledger(spark, "plans", "ledger", "mine")
    for state, progress in ((U.RUNNING, 0.1), (U.RUNNING, 0.5), (U.DONE, 1.0)):
        report(state, progress)
    assert sorted(map(tuple, spark.table("plans.ledger").collect())) == [("mine", U.DONE, 1.0), ("other", 1, 1.0)]


def test_request_with_unknown_objective_is_refused(spark, sf_dir):
    requests = star.scenario_requests(star.promo_fact(spark, sf_dir))
    unknown = U.scenario_params(requests).filter("strategy is null").first()["uid"]
    with pytest.raises(ValueError, match="objective"):
        run_request(requests, unknown, *[None] * 6)
    with pytest.raises(ValueError, match="0 requests"):
        run_request(requests, "nobody", *[None] * 6)


def test_a_goal_beyond_the_bounds_is_refused(spark, sf_dir):
    fact = settle(star.promo_fact(spark, sf_dir))
    scenario = U.Scenario("G", "VALUE", S.PRICEOFF, 2000, 1, 6, categories=["ECONOMY", "SMALL", "STANDARD"],
                          strategy="3", goal_spend=1.0)
    seen = []
    with pytest.raises(ValueError, match="goal"):
        run_scenario(scenario, fact, fact, fact, star.booked_actuals(fact), None, None, report=lambda s, p: seen.append(s))
    assert seen[-1] == U.FAILED
