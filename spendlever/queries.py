"""Query registry: every operator applied to the inputs derived from the star schema."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from spendlever import schemas as S
from spendlever.functions.expr import KEY_HASH, aggregate, change, exact_sum, in_list, join_keys, round_dp, with_exprs
from spendlever.functions.lineage import settle, stage_folder
from spendlever.operators import allocate as A, branch as B, power as W, prep as P, publish as U, response as R, scenarios as N
from spendlever.plans.scenario import publish_versioned, run_batch
from spendlever.sources import star
from spendlever.sources.tables import (
    VersionedTable, read_catalog, read_csv, read_external, snapshot, write_catalog, write_external,
)

SCENARIO = U.Scenario(
    name="VALUE_H1", business="VALUE", spend_type=S.PRICEOFF, year=2000, first_month=1, last_month=6,
    categories=["ECONOMY", "SMALL", "STANDARD"],
)
DATE_TEXT = "2000-06-30 23:59:59"
#: Goals as parts of last year's spend: one inside the items' bounds, one beyond them.
GOAL_SHARE, BROKEN_GOAL_SHARE = 1.02, 1.25
#: Least power-law volume over the totals of a group.
VOLUME_FLOOR = "_volume * 1.0145D"
SEGMENT_RULES = [("ECONOMY", "LOW"), ("STANDARD", "LOW"), ("PROMO", "PROMOTED")]
OVERRIDE_SEGMENTS = ["SMALL/XS", "SMALL/S", "LARGE/M"]
RUN = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, dp: int = 4) -> DataFrame:
    """Present doubles at a fixed number of places."""
    return df.selectExpr(*[f"{round_dp(f'`{c}`', dp)} as `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes])


# --- derived tables --------------------------------------------------------------------
# A table that a query reads more than once is settled first, so the lines are scanned once.


def _fact(spark, d, **period) -> DataFrame:
    return star.promo_fact(spark, d, **period)


def _actual_totals(fact: DataFrame) -> DataFrame:
    return P.actuals_rollup(star.booked_actuals(fact))


def _repriced(spark, d, fact: DataFrame) -> DataFrame:
    own = P.driver_share_pct(fact)
    return P.price_change_passthrough(fact, star.price_change_feed(spark, d), own)


def _branch(spark, d, **period) -> DataFrame:
    lines = star.promo_lines(spark, d, **period)
    return P.branch_money_split([star.branch_feed(lines)], star.customer_master(spark, d))


def _hashed_fact_and_branch(spark, d, spend_only=False, fixed_offices=True) -> tuple[DataFrame, DataFrame]:
    """Fact and branch money from one scan of the lines, both laid out by ``KEY_HASH``."""
    months = settle(star.booked_months(spark, d, spend_only, fixed_offices), by=KEY_HASH)
    customers = settle(star.customer_master(spark, d))
    return star.fact_of_months(months), P.branch_money_split([star.branch_feed_of_months(months)], customers)


def _fact_and_branch(spark, d) -> tuple[DataFrame, DataFrame]:
    fact, branch = _hashed_fact_and_branch(spark, d)
    return fact.drop(KEY_HASH), branch.drop(KEY_HASH)


def _shared(spark, d) -> DataFrame:
    fact, branch = _hashed_fact_and_branch(spark, d, spend_only=True)
    return B.branch_share(branch, B.nonzero_spend_rows(fact), [KEY_HASH, *S.KEY5])


def _unpivoted(spark, d) -> DataFrame:
    return B.unpivot_shares(_shared(spark, d))


def _apportioned(spark, d, conserve=True) -> DataFrame:
    columns = [KEY_HASH, *S.KEY10, "modelingname", "price", *S.MEASURES, "old_planningcustomer", "ini_contri", "add_contri"]
    long = B.unpivot_shares(settle(_shared(spark, d).select(*columns), by=KEY_HASH))
    return B.apportion_groups(long, [KEY_HASH, *S.KEY5, "modelingname"], S.MEASURES, conserve)


SCOPE = {
    "business": SCENARIO.business, "categories": SCENARIO.categories, "drivers": [SCENARIO.spend_type],
}
LAST_YEAR = {"since": "1999-01-01", "until": "1999-07-01"}


def _period_scope(spark, d) -> DataFrame:
    """Scenario scope in its last-year period; ship dates prune the scan."""
    return R.scope_filter(
        _fact(spark, d, **LAST_YEAR), **SCOPE, period=SCENARIO.last_year_period, spends="> 0", volume=">= 0"
    )


def _fit_rows(spark, d, fact: DataFrame | None = None) -> DataFrame:
    """Scenario scope over the whole history, settled: fits, baselines and costs all read it."""
    return settle(R.scope_filter(_fact(spark, d) if fact is None else fact, **SCOPE, spends="> 0", volume=">= 0"))


def _in_period(rows: DataFrame) -> DataFrame:
    return R.scope_filter(rows, period=SCENARIO.last_year_period)


def _positive(df: DataFrame) -> DataFrame:
    return df.filter("spends > 0 and volume > 0")


def _stage1_rows(rows: DataFrame) -> DataFrame:
    return A.stage1_baseline(_in_period(rows), R.response_model(rows, R.STAGE1))


def _optimisable(parts: DataFrame) -> DataFrame:
    return settle(A.back_calibrate(A.split_optimisable(parts).filter("treatment = 'optimise'")))


def _stage1_items(spark, d) -> DataFrame:
    return _optimisable(_stage1_rows(_fit_rows(spark, d)))


def _pushed(spark, d, fact: DataFrame | None = None) -> DataFrame:
    rows = _fit_rows(spark, d, fact)
    coarse, fine = R.response_models(rows, R.STAGE1, R.STAGE2)
    stage1 = A.optimise_stage1(A.stage1_baseline(_in_period(rows), coarse))
    cost = A.cost_per_case(star.booked_actuals(rows), SCENARIO.last_year, ["priceoff"])
    return A.pushdown_stage1(R.attach_dimensions(fine, rows), A.stage2_old(_in_period(rows)), stage1, cost)


def _stage2(spark, d, fact: DataFrame | None = None) -> DataFrame:
    return A.optimise_stage2(_pushed(spark, d, fact))


def _final(spark, d, fact: DataFrame) -> DataFrame:
    others = R.scope_filter(
        fact, business=SCENARIO.business, categories=SCENARIO.categories, period=SCENARIO.last_year_period,
    ).filter("not " + in_list("modelingname", [*S.TOTAL_ROWS, SCENARIO.spend_type]))
    overlaid = U.baseline_overlay(A.guardrail_revert(_stage2(spark, d, fact)), others)
    return overlaid.selectExpr("*", f"'{SCENARIO.spend_type}' as modelingname")


def _reworked(spark, d) -> DataFrame:
    year, first, last = SCENARIO.last_year_period
    stage2 = settle(_stage2(spark, d).selectExpr("*", f"'{SCENARIO.spend_type}' as modelingname"))
    branch = _branch(spark, d, **LAST_YEAR)
    return B.branch_rework_output(stage2, branch, f"year = {year} and month between {first} and {last}")


def _period_actuals(spark, d) -> DataFrame:
    return U.scenario_period_actuals(_period_scope(spark, d), SCENARIO.name, DATE_TEXT)


def _projected(spark, d) -> DataFrame:
    return settle(U.scenario_output_projection(
        _reworked(spark, d), SCENARIO.name, SCENARIO.spend_type, DATE_TEXT
    ))


def _requests(spark, d) -> DataFrame:
    return U.scenario_params(star.scenario_requests(_fact(spark, d)))


# --- preparation -----------------------------------------------------------------------


def contribution_share(spark, d):
    return _rounded(P.contribution_share(_fact(spark, d)), 6)


def actuals_rollup(spark, d):
    return _actual_totals(_fact(spark, d))


def rescale_to_actuals(spark, d):
    fact = settle(_fact(spark, d))
    return P.rescale_to_actuals(P.contribution_share(fact), _actual_totals(fact))


def normalise_period(spark, d):
    return P.normalise_period(_fact(spark, d)).select(*S.KEY10, "modelingname", "spends", "volume")


def driver_share_pct(spark, d):
    return _rounded(P.driver_share_pct(star.promo_lines(spark, d)), 6)


def price_change_passthrough(spark, d):
    return _rounded(_repriced(spark, d, settle(_fact(spark, d))))


def branch_money_split(spark, d):
    return _branch(spark, d)


def category_from_path(spark, d):
    return _rounded(P.category_from_path(_branch(spark, d), SEGMENT_RULES, "OTHER"))


def null_profile(spark, d):
    return P.null_profile(_fact(spark, d))


def branch_share(spark, d):
    shared = B.branch_share(_branch(spark, d), B.nonzero_spend_rows(_fact(spark, d)))
    return shared.select(*S.KEY10, "modelingname", "old_planningcustomer", "spends", "ini_contri", "add_contri")


def unpivot_shares(spark, d):
    return _unpivoted(spark, d).select(
        *S.KEY10, "modelingname", "old_planningcustomer", "spends", "contri_type", "contri_val"
    )


APPORTIONED = [
    *S.KEY10, "modelingname", "old_planningcustomer", "contri_type", "share_group", "weight", *S.MEASURES,
]


def apportion_groups(spark, d):
    out = _apportioned(spark, d, conserve=False)
    # An unmatched row passes through once; which old customer it came from carries no meaning.
    shown = {c: f"if(share_group != 'none', {c}, null)" for c in ("old_planningcustomer", "contri_type")}
    return _rounded(with_exprs(out, shown).select(*APPORTIONED), 6)


def apportion_conserving(spark, d):
    """Weights and groups with the money kept; old customers and kinds that carry meaning."""
    shown = _apportioned(spark, d).filter("share_group != 'none'")
    return _rounded(shown.select(*APPORTIONED), 6)


def reallocation_check(spark, d):
    """Spend, volume, GPS and net sales per spend type before and after the re-attribution, at whole units of a thousand."""
    fact, branch = _hashed_fact_and_branch(spark, d, spend_only=True)
    fact = settle(fact, by=KEY_HASH)
    after = B.reallocate_branches(fact, branch)
    checked = P.reconcile_totals(B.nonzero_spend_rows(fact), after, ["modelingname"])
    # Every row is rounded to three places, so totals may differ by half a thousandth a row.
    return checked.selectExpr(
        "modelingname", "measure", f"{round_dp('before', 2)} as before", "abs(diff) <= 0.0005D * (rows_after + 2 * rows_before) as kept")


def reassign_branch(spark, d):
    return _rounded(B.reassign_branch(_apportioned(spark, d)))


def assemble_fact(spark, d):
    fact, branch = _hashed_fact_and_branch(spark, d)
    fact = settle(fact, by=KEY_HASH)
    return _rounded(B.assemble_fact(fact, B.reallocate_branches(fact, branch)))


def decomp_view(spark, d):
    fact = settle(_fact(spark, d))
    return _rounded(P.decomp_view(fact.filter(f"not {P.IS_TOTAL}"), fact))


def history_baseline(spark, d):
    fact = settle(_fact(spark, d))
    return _rounded(P.history_baseline(fact, fact))


def publish_history(spark, d):
    fact = settle(_fact(spark, d))
    out = U.publish_history(star.published_output(fact), P.history_baseline(fact, fact))
    return _rounded(out)


def ratio_impute(spark, d):
    fact = settle(_fact(spark, d))
    return _rounded(P.ratio_impute(fact, fact.filter(P.IS_SPEND)))


def override_merge(spark, d):
    fact = settle(_fact(spark, d))
    drivers = fact.filter(f"not {P.IS_TOTAL}")
    view = P.decomp_view(drivers, fact)
    # Keys without a total row, and keys with total rows only, are unmatched on either side.
    fresh = with_exprs(drivers.filter(in_list("segment", OVERRIDE_SEGMENTS)), {m: f"{m} * 2" for m in S.MEASURES})
    return _rounded(P.override_merge(view, P.replacement_rows(fresh), OVERRIDE_SEGMENTS))


def reconcile_totals(spark, d):
    fact = settle(_fact(spark, d))
    return _rounded(P.reconcile_totals(fact, _repriced(spark, d, fact), ["year", "category"]), 2)


def reconcile_grand_total(spark, d):
    fact = settle(_fact(spark, d))
    return _rounded(P.reconcile_totals(fact, _repriced(spark, d, fact), []), 2)


def reconcile_months(spark, d):
    fact = settle(P.normalise_period(_fact(spark, d)).selectExpr("*", "concat(year, month) as yearmonth"))
    return _rounded(P.reconcile_totals(fact, fact.filter(P.IS_SPEND), ["yearmonth"]), 2)


def scenario_params(spark, d):
    out = _requests(spark, d)
    joined = {c: f"concat_ws(',', {c})" for c in ("channel", "category", "shisha")}
    return _rounded(with_exprs(out, joined))


def last_year_period(spark, d):
    return U.last_year_period(_requests(spark, d))


def scope_filter(spark, d):
    return _period_scope(spark, d).select(*S.KEY10, "modelingname", "spends", "volume", "gps", "netsales")


# --- response model --------------------------------------------------------------------


def _spend_rows(spark, d) -> DataFrame:
    return _positive(_fact(spark, d).filter(P.IS_SPEND))


FIT_KEYS = ["modelingname", "shisha", "planningcustomer"]


def pct_rank_avg(spark, d):
    rows = settle(_spend_rows(spark, d).select("year", "month", "segment", *FIT_KEYS, "spends", "volume"))
    return _rounded(R.pct_rank_avg(rows, FIT_KEYS), 6)


def loglog_fit(spark, d):
    return _rounded(R.loglog_fit(_spend_rows(spark, d), FIT_KEYS), 6)


def trim_refit(spark, d):
    return _rounded(R.trim_refit(settle(_spend_rows(spark, d)), FIT_KEYS), 6)


def _fallback(spark, d, levels):
    rows = _positive(_fit_rows(spark, d))
    return _rounded(R.hierarchical_fallback(settle(R.fit_levels(rows, levels)), levels), 6)


def hierarchical_fallback(spark, d):
    return _fallback(spark, d, R.STAGE1)


def hierarchical_fallback_stage2(spark, d):
    return _fallback(spark, d, R.STAGE2)


def zero_response_keys(spark, d):
    rows = _fact(spark, d).filter(P.IS_SPEND)
    return _rounded(R.zero_response_keys(rows, FIT_KEYS))


def _model_text(df: DataFrame) -> DataFrame:
    return with_exprs(df, {"model_type": "concat_ws(',', model_type)"})


def consolidate_models(spark, d):
    return _model_text(R.response_model(_fit_rows(spark, d), R.STAGE1))


def attach_dimensions(spark, d):
    rows = _fit_rows(spark, d)
    return _model_text(R.attach_dimensions(R.response_model(rows, R.STAGE2), rows))


# --- allocation ------------------------------------------------------------------------


def _view(df: DataFrame, columns: list[str], dp: int = 3) -> DataFrame:
    return _rounded(df.select(*columns), dp)


BASELINE = ["shisha", "channel", "planningcustomer", "spends_coef", *[f"{A.LY}{m}" for m in A.BASE_MEASURES], "price", "ns_to_gps"]


def stage1_baseline(spark, d):
    return _view(_stage1_rows(_fit_rows(spark, d)), BASELINE, 6)


def split_optimisable(spark, d):
    return _view(A.split_optimisable(_stage1_rows(_fit_rows(spark, d))), [*BASELINE, "treatment"], 6)


def back_calibrate(spark, d):
    return _view(_stage1_items(spark, d), [*A.STAGE1_KEY, "backcalc_intercept", f"{A.LY}netsales_calc", "adjustment_factor"])


def response_net_sales(spark, d):
    items = _stage1_items(spark, d).selectExpr("*", f"{A.LY}spends * 1.05D as plan")
    return _view(A.response_net_sales(items, "plan"), [*A.STAGE1_KEY, "plan", "spend_change", "optimized_volume", "optimized_gps", "optimized_netsales"])


ALLOCATED = [*A.STAGE1_KEY, "slope", "spends_lb", "spends_ub", "policy", "feasible", "optimized_spends"]


def allocate_stage1(spark, d):
    return _view(A.allocate(_stage1_items(spark, d), []), ALLOCATED)


def allocate_goal(spark, d):
    return _view(A.allocate(_stage1_items(spark, d), [], goal=f"_centre * {GOAL_SHARE}D"), ALLOCATED)


def allocate_broken_goal(spark, d):
    return _view(A.allocate(_stage1_items(spark, d), [], goal=f"_centre * {BROKEN_GOAL_SHARE}D"), ALLOCATED)


def infeasible_groups(spark, d):
    return _rounded(A.infeasible_groups(_stage2(spark, d)), 3)


def _with_null_branch(rows: DataFrame) -> DataFrame:
    """One branch office becomes unknown, so that keys hold nulls."""
    return with_exprs(rows, {"shisha": "nullif(shisha, 'ASIA')"})


def trim_refit_null_keys(spark, d):
    return _rounded(R.trim_refit(settle(_with_null_branch(_spend_rows(spark, d))), FIT_KEYS), 6)


def allocate_null_keys(spark, d):
    items = settle(_with_null_branch(_stage1_items(spark, d)))
    return _view(A.allocate(items, ["shisha"]), ALLOCATED)


def allocate_stage2(spark, d):
    out = A.allocate(
        _optimisable(_pushed(spark, d)), A.STAGE1_KEY, "_old", band_on_old=True, policies=[A.SPEND_FIRST]
    )
    return _view(out, ["segment", *ALLOCATED])


def min_spend_for_target(spark, d):
    out = A.min_spend_for_target(_stage1_items(spark, d), ["shisha"])
    return _view(out, [*A.STAGE1_KEY, "slope", "feasible", "optimized_spends"])


def exact_growth_target(spark, d):
    out = A.min_spend_for_target(_stage1_items(spark, d), ["shisha"], growth=-0.01, exact=True)
    return _view(out, [*A.STAGE1_KEY, "slope", "feasible", "optimized_spends"])


def candidate_select(spark, d):
    candidates = A.allocate(
        _optimisable(_pushed(spark, d)), A.STAGE1_KEY, "_old", band_on_old=True, policies=A.POLICIES
    )
    return A.candidate_select(settle(candidates), A.STAGE1_KEY, "_old")


#: Budgets as parts of last year's spend; the first is below every lower bound, the last above every upper one.
BUDGET_SHARES = [0.85, 0.92, 0.95, 0.98, 1.0, 1.02, 1.05, 1.08, 1.15]


def _curve(spark, d, group: list[str]) -> DataFrame:
    items = _stage1_items(spark, d)
    listed = ", ".join(f"{x}D" for x in BUDGET_SHARES)
    budgets = aggregate(items, group, {"_spent": exact_sum(f"{A.LY}spends", 9)}).selectExpr(
        *group, "_spent", f"explode(array({listed})) as share").selectExpr(*group, "share", f"{round_dp('_spent * share', 2)} as budget")
    budgets = settle(budgets)
    out = A.optimum_at(settle(A.budget_curve(items, group)), budgets.drop("share"), group)
    rows = out.selectExpr(*group, "budget", "spend", "netsales", f"{round_dp('growth', 6)} as growth", "marginal", "feasible")
    named = join_keys(rows, budgets, [*group, "budget"])
    return with_exprs(named, {**{c: round_dp(c, 2) for c in ("budget", "spend", "netsales")}, "marginal": round_dp("marginal", 4)})


def budget_curve(spark, d):
    """Optimum and growth of the whole budget at several totals, from one table of breakpoints."""
    return _curve(spark, d, [])


def budget_curve_offices(spark, d):
    """The same for every branch office's own budget."""
    return _curve(spark, d, ["shisha"])


def _volume_rows(out: DataFrame) -> DataFrame:
    return out.selectExpr(*A.STAGE1_KEY, f"{round_dp('optimized_spends', 2)} as optimized_spends",
                          f"{round_dp('optimized_volume', 2)} as optimized_volume", "feasible")


def volume_budget(spark, d):
    """Power-law volume of every branch office maximised at last year's spend."""
    return _volume_rows(W.most_volume(_stage1_items(spark, d), ["shisha"]))


def volume_budget_total(spark, d):
    """The same for one company-wide budget, raised by 3 %."""
    return _volume_rows(W.most_volume(_stage1_items(spark, d), [], "_centre * 1.03D"))


def volume_target(spark, d):
    """Least spend of every branch office that keeps last year's power-law volume."""
    return _volume_rows(W.least_spend_for_volume(_stage1_items(spark, d), ["shisha"]))


def volume_floor_netsales(spark, d):
    """Net sales of every branch office at last year's spend, with and without a floor under its volume."""
    items = _stage1_items(spark, d)
    return _floor_rows(W.best_netsales_with_volume(items, ["shisha"], volume=VOLUME_FLOOR), ["shisha"])


def _floor_rows(out: DataFrame, group: list[str]) -> DataFrame:
    grown = lambda new, old: round_dp(change(exact_sum(new, 9), exact_sum(old, 9)), 5)
    return aggregate(out, group, {
        "items": "count(1)", "spend_change": grown("optimized_spends", f"{A.LY}spends"), "volume_change": grown("optimized_volume", f"{A.LY}volume"),
        "netsales_change": grown("optimized_netsales", f"{A.LY}netsales"), "feasible": "bool_and(feasible)",
    })


def guarded_allocation(spark, d):
    """Second stage with the guard-rail as a bound: no row is raised where that loses net sales."""
    items = settle(A.without_losing_raises(_optimisable(_pushed(spark, d)), "_old"))
    out = A.allocate(items, A.STAGE1_KEY, "_old", band_on_old=True)
    return _view(out, ["segment", *ALLOCATED])


def guarded_gain(spark, d):
    """Net sales of the guarded allocation against the allocation whose losing rows are reverted afterwards."""
    items = _optimisable(_pushed(spark, d))
    guarded = A.allocate(settle(A.without_losing_raises(items, "_old")), A.STAGE1_KEY, "_old", band_on_old=True)
    reverted = A.guardrail_revert(A.project_optimised(A.allocate(items, A.STAGE1_KEY, "_old", band_on_old=True), "_old"))
    totals = [
        aggregate(A.response_net_sales(guarded, "optimized_spends", "_old"), [], {"guarded": exact_sum("optimized_netsales", 9)}),
        aggregate(reverted, [], {"reverted": exact_sum("optimized_netsales", 9), "rows_reverted": "count_if(reverted)"}),
    ]
    both = totals[0].selectExpr("*", "0 as one").join(totals[1].selectExpr("*", "0 as one"), "one").drop("one")
    return both.selectExpr(f"{round_dp('guarded', 2)} as guarded", f"{round_dp('reverted', 2)} as reverted", "rows_reverted",
                           f"guarded >= reverted - 0.01D as not_below")


def project_optimised(spark, d):
    return _view(A.project_optimised(A.allocate(_stage1_items(spark, d), [])), A.STAGE1_OUTPUT)


def carry_non_optimised(spark, d):
    parts = A.split_optimisable(_stage1_rows(_fit_rows(spark, d))).filter("treatment = 'carry'")
    return _view(A.carry_non_optimised(parts), A.STAGE1_OUTPUT)


def pushdown_stage1(spark, d):
    return _view(_pushed(spark, d), [
        "key_combination", "key_combination1", *[f"{A.LY}{m}_old" for m in A.BASE_MEASURES],
        *[f"{A.LY}{m}" for m in A.BASE_MEASURES], "ns_to_gps", "ec_per_qtycase",
    ])


def cost_per_case(spark, d):
    actuals = star.booked_actuals(_fact(spark, d, since="1999-01-01", until="2000-01-01"))
    return _rounded(A.cost_per_case(actuals, SCENARIO.last_year, ["priceoff", "promotionad"]), 6)


def branch_rework_output(spark, d):
    return _rounded(_reworked(spark, d), 2)


def scenario_period_actuals(spark, d):
    return _rounded(_period_actuals(spark, d), 3)


def guardrail_revert(spark, d):
    return _view(A.guardrail_revert(_stage2(spark, d)), [
        "segment", *A.STAGE1_KEY, "reverted", "spend_change", "netsales_change",
        *[f"optimized_{m}" for m in A.BASE_MEASURES],
    ])


FINAL = [
    "baseline_volume", "total_initial_spend", "total_initial_volume", "total_initial_gps", "total_initial_netsales",
    "total_optimized_spend", "total_optimized_volume", "total_optimized_gps", "total_optimized_netsales",
    "final_spend_change", "final_volume_change", "final_gps_change", "final_netsales_change",
]


def baseline_overlay(spark, d):
    return _view(_final(spark, d, settle(_fact(spark, d))), [*S.DIMENSIONS, *FINAL])


def _published(spark, d):
    fact = settle(_fact(spark, d))
    existing = star.published_output(fact)
    # Settled: the solve below is read by the publication and by its check.
    final = settle(_final(spark, d, fact).select(*S.DIMENSIONS, "modelingname", "optimized_spends", *FINAL))
    return final, U.publish_scenario(existing, final, SCENARIO)


def publish_scenario(spark, d):
    return _rounded(_published(spark, d)[1], 3)


def load_check(spark, d):
    final, published = _published(spark, d)
    return U.load_check(final, published, SCENARIO.name)


def status_upsert(spark, d):
    events = settle(star.ledger_events(spark, d))
    early = "reported_at < timestamp_ntz'2000-01-01 00:00:00'"
    ledger = U.latest_status(events.filter(early)).select(*[f.name for f in S.LEDGER.fields])
    return U.status_upsert(ledger, events.filter(f"not ({early})"))


def stage_summary(spark, d):
    return A.stage_summary(_stage2(spark, d), "_old")


def spend_mismatch(spark, d):
    return _rounded(A.spend_mismatch(_stage2(spark, d)), 3)


def spend_mismatch_saved(spark, d):
    """Groups that spend less than was pushed down, because more would lose net sales."""
    saving = A.optimise_stage2(_pushed(spark, d), policies=[A.MAX_NET_SALES])
    return _rounded(A.spend_mismatch(saving), 3)


def branch_list(spark, d):
    pairs = settle(_branch(spark, d).select("old_planningcustomer", "new_planningcustomer").distinct())
    existing = pairs.selectExpr(
        "old_planningcustomer", "new_planningcustomer as branch_list",
        "concat('SCN_', new_planningcustomer) as scenario_name",
    )
    return B.branch_list(existing, pairs, SCENARIO.name)



def missing_keys_backfill(spark, d):
    """Re-attributed scenario output plus the actual rows whose customer the re-attribution left empty."""
    columns = [*S.DIMENSIONS, "modelingname", *S.MEASURES]
    output = _projected(spark, d).select(*columns)
    return _rounded(U.missing_keys_backfill(output, _period_actuals(spark, d).select(*columns)), 2)


def key_semi_filter(spark, d):
    facts = settle(_fact(spark, d))
    actual = R.scope_filter(facts, **SCOPE, period=SCENARIO.last_year_period, spends="> 0", volume=">= 0")
    return U.key_semi_filter(facts, actual).select(*S.KEY10, "modelingname", "spends", "volume")


def match_flags(spark, d):
    out = U.match_flags(_projected(spark, d), _period_actuals(spark, d))
    return out.select(*S.DIMENSIONS, *[f"{m}_match" for m in S.MEASURES])


def factor_align(spark, d):
    out = U.factor_align(_projected(spark, d), _period_actuals(spark, d))
    return _view(out, [*S.DIMENSIONS, *S.MEASURES, *[f"{A.LY}{m}_old_calc" for m in S.MEASURES]], 2)


# --- sources and sinks -----------------------------------------------------------------


@contextmanager
def _scratch(spark):
    """Name of a database in the warehouse that is dropped at the end; settle what is read from it."""
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _by_category(spark, d) -> DataFrame:
    sums = aggregate(_fact(spark, d), ["year", "category", "modelingname"], {m: exact_sum(m) for m in S.MEASURES})
    return settle(sums)


def catalog_table(spark, d):
    """Totals written to a catalog table twice, the second time with another schema, and read back."""
    totals = _by_category(spark, d)
    with _scratch(spark) as db:
        write_catalog(totals.drop("gps"), db, "totals")
        write_catalog(totals, db, "totals")
        return settle(read_catalog(spark, db, "totals"))


def catalog_append(spark, d):
    """Years appended to a catalog table in two writes."""
    totals = _by_category(spark, d)
    with _scratch(spark) as db:
        write_catalog(totals.filter("year < 1999"), db, "totals")
        write_catalog(totals.filter("year >= 1999"), db, "totals", mode="append")
        return settle(read_catalog(spark, db, "totals"))


def snapshot_copy(spark, d):
    """A view of an external store kept as a catalog table, unchanged when the store changes."""
    totals = _by_category(spark, d)
    with _scratch(spark) as db:
        path = {"path": f"{stage_folder(spark)}/external-{uuid.uuid4().hex}"}
        write_external(totals, "json", path)
        kept = snapshot(read_external(spark, "json", path).select(*totals.columns), db, "kept")
        write_external(totals.limit(0), "json", path)
        return settle(kept)


def external_store(spark, d):
    """Totals overwritten in a store with a Spark data source, and read through its format."""
    totals, path = _by_category(spark, d), {"path": f"{stage_folder(spark)}/external-{uuid.uuid4().hex}"}
    write_external(totals.limit(1), "orc", path)
    write_external(totals, "orc", path)
    return read_external(spark, "orc", path)


def csv_scan(spark, d):
    """Totals written as CSV with a header and read with a declared schema."""
    totals, path = _by_category(spark, d), f"{stage_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_external(totals, "csv", {"path": path, "header": "true"})
    return read_csv(spark, path, totals.schema)


def local_rows(spark, d):
    """Totals of the drivers next to rows declared in the program."""
    kinds = spark.createDataFrame([(t, "spend") for t in S.SPEND_TYPES] + [(S.OWN_PRICE, "price")], "modelingname string, kind string")
    totals = aggregate(_by_category(spark, d), ["modelingname"], {m: exact_sum(m) for m in S.MEASURES})
    return join_keys(totals, kinds, ["modelingname"], "left")


def versioned_publication(spark, d):
    """The scenario published in place, read back and counted before readers see it; then published again."""
    fact = settle(_fact(spark, d))
    final = settle(_final(spark, d, fact).select(*S.DIMENSIONS, "modelingname", "optimized_spends", *FINAL))
    existing = star.published_output(fact)
    with _scratch(spark) as db:
        padded = existing.selectExpr("*", *[f"cast(null as double) as {c}" for c in FINAL])
        VersionedTable(spark, db, "published").create(padded, "year")
        publish_versioned(final, SCENARIO, db, "published")
        return settle(_rounded(publish_versioned(final, SCENARIO, db, "published"), 3))


def status_log(spark, d):
    """Ledger shown by an append-only log whose older part has been compacted."""
    events = settle(star.ledger_events(spark, d))
    early = "reported_at < timestamp_ntz'2000-01-01 00:00:00'"
    log = U.compacted_log(events.filter(early)).unionByName(events.filter(f"not ({early})"))
    return U.status_view(log)


# --- scenarios as data -----------------------------------------------------------------


def _judged(fact: DataFrame) -> DataFrame:
    return settle(N.judged_requests(star.scenario_batch_requests(fact)))


def _batch(spark, d) -> dict[str, DataFrame]:
    fact = settle(_fact(spark, d))
    return {"fact": fact, **run_batch(N.valid_scenarios(_judged(fact)), fact, fact, fact, star.booked_actuals(fact))}


def scenario_batch_requests(spark, d):
    """Every request as a row: its scope, periods and goal, or why it is refused."""
    listed = {c: f"if({c} is null, '*', concat_ws(',', {c}))" for c in N.SCOPE_LISTS}
    return with_exprs(_judged(settle(_fact(spark, d))).drop("uid", "scope_id"), listed)


def scenario_batch_stage1(spark, d):
    return _view(_batch(spark, d)["stage1"], [*N.BY, *A.STAGE1_OUTPUT])


def scenario_batch_final(spark, d):
    """All valid requests of all spend types, run to their ends in one plan."""
    return _view(_batch(spark, d)["final"], [*N.BY, *S.DIMENSIONS, "modelingname", "reverted", "optimized_spends", *FINAL])


def publish_batch(spark, d):
    run = _batch(spark, d)
    final = run["final"].select(*N.BY, *S.DIMENSIONS, "modelingname", "optimized_spends", *FINAL)
    return _rounded(N.publish_scenarios(star.published_output(run["fact"]), final, run["scenarios"]), 3)


# --- null and shared keys --------------------------------------------------------------


def rescale_null_keys(spark, d):
    fact = settle(_with_null_branch(_fact(spark, d)))
    return P.rescale_to_actuals(P.contribution_share(fact), _actual_totals(fact))


def ratio_impute_null_keys(spark, d):
    fact = settle(_with_null_branch(_fact(spark, d)))
    return _rounded(P.ratio_impute(fact, fact.filter(P.IS_SPEND)))


def history_null_keys(spark, d):
    fact = settle(_with_null_branch(_fact(spark, d)))
    return _rounded(P.history_baseline(fact, fact))


def override_null_keys(spark, d):
    fact = settle(_with_null_branch(_fact(spark, d)))
    drivers = fact.filter(f"not {P.IS_TOTAL}")
    fresh = with_exprs(drivers.filter(in_list("segment", OVERRIDE_SEGMENTS)), {m: f"{m} * 2" for m in S.MEASURES})
    return _rounded(P.override_merge(P.decomp_view(drivers, fact), P.replacement_rows(fresh), OVERRIDE_SEGMENTS))


def _with_null_office(branch: DataFrame) -> DataFrame:
    return with_exprs(branch, {"shishanm": "nullif(shishanm, 'ASIA')"})


def assemble_null_keys(spark, d):
    fact, branch = _hashed_fact_and_branch(spark, d, fixed_offices=False)
    fact = settle(_with_null_branch(fact), by=KEY_HASH)
    return _rounded(B.assemble_fact(fact, B.reallocate_branches(fact, _with_null_office(branch))))


def scenario_null_keys(spark, d):
    """The whole chain, from fits to the overlay, on a fact with an unknown branch office."""
    return _view(_final(spark, d, settle(_with_null_branch(_fact(spark, d)))), [*S.DIMENSIONS, *FINAL])


def comparison_null_keys(spark, d):
    """Re-attributed output of that chain against the actuals: flags, rows to add and keys that occur."""
    fact = settle(_with_null_branch(_fact(spark, d)))
    year, first, last = SCENARIO.last_year_period
    stage2 = settle(_stage2(spark, d, fact).selectExpr("*", f"'{SCENARIO.spend_type}' as modelingname"))
    reworked = B.branch_rework_output(
        stage2, _with_null_office(_branch(spark, d, **LAST_YEAR)), f"year = {year} and month between {first} and {last}")
    projected = settle(U.scenario_output_projection(reworked, SCENARIO.name, SCENARIO.spend_type, DATE_TEXT))
    scope = R.scope_filter(fact, **SCOPE, period=SCENARIO.last_year_period, spends="> 0", volume=">= 0")
    actuals = settle(U.scenario_period_actuals(scope, SCENARIO.name, DATE_TEXT))
    columns = [*S.DIMENSIONS, "modelingname"]
    flags = U.match_flags(projected, actuals).selectExpr(
        *columns, "'output' as origin", f"concat({', '.join(f'{m}_match' for m in S.MEASURES)}) as matched")
    both = U.missing_keys_backfill(projected.select(*columns), actuals.select(*columns))
    filled = aggregate(both, columns, {"n": "count(1)"}).selectExpr(*columns, "'backfilled' as origin", "cast(n as string) as matched")
    kept = U.key_semi_filter(projected.select(*columns), actuals).selectExpr("*", "'kept' as origin", "'' as matched")
    return flags.unionByName(filled).unionByName(kept)


#: A fact whose rows share their branch keys: each row as two parts of one key.
PARTS = {"part 1": 0.2, "part 2": 0.8}


def _shared_keys(fact: DataFrame) -> DataFrame:
    parts = ", ".join(f"'{name}', {share}D" for name, share in PARTS.items())
    both = fact.selectExpr("*", f"stack({len(PARTS)}, {parts}) as (_part, _share)")
    return with_exprs(both, {"subcategory": "concat_ws('/', subcategory, _part)", **{m: f"{m} * _share" for m in S.MEASURES}}).drop("_part", "_share")


def reassign_shared_keys(spark, d):
    fact, branch = _hashed_fact_and_branch(spark, d, spend_only=True)
    return _rounded(B.reallocate_branches(_shared_keys(fact), branch))


def reallocation_check_shared_keys(spark, d):
    """As ``reallocation_check``, on a fact with several rows of one branch key."""
    fact, branch = _hashed_fact_and_branch(spark, d, spend_only=True)
    fact = settle(_shared_keys(fact), by=KEY_HASH)
    checked = P.reconcile_totals(B.nonzero_spend_rows(fact), B.reallocate_branches(fact, branch), ["modelingname"])
    return checked.selectExpr(
        "modelingname", "measure", f"{round_dp('before', 2)} as before", "abs(diff) <= 0.0005D * (rows_after + 2 * rows_before) as kept")


def registry() -> dict[str, RUN]:
    named = [
        contribution_share, actuals_rollup, rescale_to_actuals, normalise_period, driver_share_pct,
        price_change_passthrough, branch_money_split, category_from_path, null_profile, branch_share,
        unpivot_shares, apportion_groups, apportion_conserving, reassign_branch, reallocation_check, assemble_fact,
        decomp_view, history_baseline, publish_history, ratio_impute, override_merge, reconcile_totals,
        reconcile_grand_total, reconcile_months,
        scenario_params, last_year_period, scope_filter, pct_rank_avg, loglog_fit, trim_refit,
        hierarchical_fallback, hierarchical_fallback_stage2, zero_response_keys, consolidate_models,
        attach_dimensions, stage1_baseline, split_optimisable, back_calibrate, response_net_sales,
        allocate_stage1, allocate_goal, allocate_broken_goal, allocate_null_keys, trim_refit_null_keys,
        allocate_stage2, infeasible_groups, min_spend_for_target, exact_growth_target,
        candidate_select, budget_curve, budget_curve_offices, volume_budget, volume_budget_total, volume_target, volume_floor_netsales, guarded_allocation, guarded_gain, project_optimised, carry_non_optimised, pushdown_stage1, cost_per_case,
        branch_rework_output, scenario_period_actuals, guardrail_revert, baseline_overlay,
        publish_scenario, load_check, status_upsert, stage_summary, spend_mismatch, spend_mismatch_saved, branch_list,
        missing_keys_backfill, key_semi_filter, match_flags, factor_align,
        catalog_table, catalog_append, snapshot_copy, external_store, csv_scan, local_rows, versioned_publication, status_log,
        scenario_batch_requests, scenario_batch_stage1, scenario_batch_final, publish_batch,
        rescale_null_keys, ratio_impute_null_keys, history_null_keys, override_null_keys, assemble_null_keys,
        scenario_null_keys, comparison_null_keys, reassign_shared_keys, reallocation_check_shared_keys,
    ]
    return {f.__name__: f for f in named}
