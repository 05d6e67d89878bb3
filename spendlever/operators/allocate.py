"""Budget allocation as an exact, set-based operator.

Net sales are affine in each item's spend, with slope m = coef * GPS0 / spend0 - 1, and
every item is boxed between 0.9 and 1.1 of its centre. Maximising the sum under a band on
total spend therefore fills items by descending slope: a running total decides how much of
each item's range is used. Items with the same slope share pro rata, which leaves the
optimum unchanged and needs no tie-break. Running totals are taken over slope buckets, so
one group with all items (a company-wide budget) is still spread over the cluster. They only serve to
find each group's cut: items above that slope use all of their range, items at it a part, items below
none. So items meet one row per group, and equal slopes, however many, stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendlever import schemas as S
from spendlever.functions.expr import (
    aggregate, change, exact_avg, exact_sum, join_keys, named, ratio, ratio0, round_dp, with_exprs, zero_if_null,
)
from spendlever.functions.lineage import settle
from spendlever.functions.ordered import quantile_bounds, running_totals

LOWER, UPPER = 0.9, 1.1
MAX_NET_SALES, SPEND_FIRST = "max_net_sales", "spend_first"
POLICIES = [MAX_NET_SALES, SPEND_FIRST]
TOLERANCE = 1e-6

LY = "last_year_period_"
BASE_MEASURES = ["spends", "volume", "gps", "netsales"]
STAGE1_KEY = ["shisha", "planningcustomer"]
STAGE2_KEY = ["segment", "shisha", "planningcustomer"]


# --- baselines -------------------------------------------------------------------------


def _scope_sums(scope: DataFrame, keys: list[str]) -> DataFrame:
    return aggregate(scope, keys, {
        **{m: round_dp(exact_sum(m)) for m in BASE_MEASURES}, "price": round_dp(exact_avg("price")),
    })


def stage1_baseline(scope: DataFrame, coefficients: DataFrame, by: list[str] = ()) -> DataFrame:
    """Last-year totals per branch office and customer next to their coefficients.

    ``by`` are further key columns, such as a scenario, of both inputs.
    """
    totals = _scope_sums(scope, [*by, "shisha", "channel", "planningcustomer"])
    joined = join_keys(coefficients, totals, [*by, *STAGE1_KEY], "left").fillna(0.0, [*BASE_MEASURES, "price"])
    kept = [c for c in joined.columns if c not in BASE_MEASURES]
    return joined.selectExpr(
        *kept, *[f"{m} as {LY}{m}" for m in ("spends", "volume", "gps")],
        f"gps - spends as {LY}netsales", f"{ratio0('gps - spends', 'gps', 3)} as ns_to_gps",
    )


def split_optimisable(baseline: DataFrame) -> DataFrame:
    """Flag rows to optimise (spend and volume) or to carry (spend without volume)."""
    treatment = f"""case when {LY}spends > 0 and {LY}volume > 0 then 'optimise'
        when {LY}spends > 0 and {LY}volume = 0 then 'carry' end"""
    return baseline.selectExpr("*", f"{treatment} as treatment").filter("treatment is not null")


def back_calibrate(items: DataFrame) -> DataFrame:
    """Intercept that reproduces last year's volume, and the net-sales adjustment factor."""
    power = f"pow({LY}spends, spends_coef)"
    return (
        items.selectExpr("*", f"greatest({ratio(f'{LY}volume', power)}, 0D) as backcalc_intercept")
        .selectExpr("*", f"backcalc_intercept * {power} * price * ns_to_gps as {LY}netsales_calc")
        .selectExpr("*", f"{ratio(f'{LY}netsales', f'{LY}netsales_calc')} as adjustment_factor")
    )


# --- response --------------------------------------------------------------------------


def response_net_sales(items: DataFrame, spend: str, suffix: str = "") -> DataFrame:
    """Volume, GPS and net sales of a planned spend under the linear elasticity response.

    ``suffix`` selects the reference point: ``""`` for stage 1, ``"_old"`` for stage 2.
    """
    s0, v0, g0 = (f"{LY}{m}{suffix}" for m in ("spends", "volume", "gps"))
    return (
        items.selectExpr("*", f"{change(spend, s0)} as spend_change")
        .selectExpr("*", f"{v0} * (1 + spend_change * spends_coef) as optimized_volume")
        .selectExpr("*", f"{ratio(f'optimized_volume * {g0}', v0)} as optimized_gps")
        .selectExpr("*", f"optimized_gps - {spend} as optimized_netsales")
    )


def _boxed(items: DataFrame, suffix: str) -> DataFrame:
    """Bounds around the centre spend and the net-sales slope at the reference point.

    A column ``spends_cap`` (``without_losing_raises``) takes the place of the upper bound.
    """
    slope = f"spends_coef * {ratio(f'{LY}gps{suffix}', f'{LY}spends{suffix}')} - 1"
    upper = "spends_cap" if "spends_cap" in items.columns else f"{LY}spends * {UPPER}D"
    return items.selectExpr(
        *[c for c in items.columns if c != "spends_cap"], f"{LY}spends * {LOWER}D as spends_lb", f"{upper} as spends_ub",
        f"coalesce({slope}, -1D) as slope",
    ).selectExpr("*", "spends_ub - spends_lb as _range")


def _filled(amount: str) -> str:
    """Part of a tied step, between 0 and 1, that ``amount`` reaches."""
    return f"greatest(0D, least(1D, coalesce(try_divide({amount} - _tie_before, _tie), 0D)))"


def _join_group(df: DataFrame, per_group: DataFrame, group: list[str]) -> DataFrame:
    """Attach group rows; without a group there is one total row per policy, so it is broadcast."""
    if group:
        return join_keys(df, per_group, group)
    one = per_group.selectExpr("*", "0 as _g")
    return df.selectExpr("*", "0 as _g").join(F.broadcast(one), "_g").drop("_g")


def _steps(boxed: DataFrame, group: list[str], value: str, amount: str) -> DataFrame:
    """Running totals of ``amount`` by descending ``value``, one row per distinct value."""
    ties = aggregate(boxed, [*group, value], {"_tie": f"sum(cast({amount} as decimal(28,9)))"})
    order = running_totals(ties, group, value, "_tie", descending=True, bounds=quantile_bounds(boxed, value))
    return order.selectExpr(*group, value, "cast(_tie as double) as _tie", "_tie_before")


def _cuts(steps: DataFrame, plan: DataFrame, group: list[str], planned: list[str], value: str, amount: str) -> DataFrame:
    """Plan rows with ``_cut``, the largest value that is not filled whole (null: all are), and its ``_cut_part``.

    ``planned`` are the plan's columns; ``steps`` may be ordered within a finer group than the plan's.
    """
    parts = _join_group(steps, plan, group).selectExpr("*", f"{_filled(amount)} as _part")
    found = [*dict.fromkeys([*[c for c in steps.columns if c not in (value, "_tie", "_tie_before")], *planned])]
    return aggregate(parts, found, {
        "_cut": f"max({value}) filter (where _part < 1)", "_cut_part": f"max_by(_part, {value}) filter (where _part < 1)",
    })


def _part(value: str) -> str:
    return f"case when _cut is null or {value} > _cut then 1D when {value} = _cut then _cut_part else 0D end"


def allocate(
    items: DataFrame,
    group: list[str],
    suffix: str = "",
    goal: float | str | Column | DataFrame | None = None,
    band_on_old: bool = False,
    policies: list[str] | None = None,
) -> DataFrame:
    """Spend per item and policy that maximises net sales inside the group's band.

    Without a goal, total spend may not exceed the centre total; ``band_on_old`` adds the
    0.9-1.1 band on the old total. ``goal`` fixes the total: a number, an expression over the
    group's ``_centre``, ``_lb`` and ``_ub`` totals, a column, or a table of the group's columns and
    ``goal_spend``, where null or a missing row means no goal. ``items`` is read several
    times, so pass a settled table. Adds ``policy``, ``optimized_spends``, ``feasible``.
    """
    boxed = _boxed(items, suffix)
    totals = aggregate(boxed, group, {
        "_lb": exact_sum("spends_lb", 9), "_ub": exact_sum("spends_ub", 9),
        "_centre": exact_sum(f"{LY}spends", 9), "_old": exact_sum(f"{LY}spends{suffix}", 9),
        "_gainful": exact_sum("case when slope > 0 then _range else 0D end", 9),
    })
    low, high = "0D", "_centre"
    if isinstance(goal, DataFrame):
        totals = join_keys(totals, goal, group, "left")
        low, high = "coalesce(goal_spend, 0D)", "coalesce(goal_spend, _centre)"
    elif goal is not None:
        totals = totals.withColumn("_goal", F.expr(goal) if isinstance(goal, str) else goal if isinstance(goal, Column) else F.lit(float(goal)))
        low = high = "_goal"
    elif band_on_old:
        low, high = f"_old * {LOWER}D", f"least(_centre, _old * {UPPER}D)"
    amounts = {
        MAX_NET_SALES: "least(_high - _lb, greatest(_gainful, _low - _lb))",
        SPEND_FIRST: "_high - _lb",
    }
    wanted = policies or [MAX_NET_SALES]
    listed = ", ".join(f"'{p}', {amounts[p]}" for p in wanted)
    plan = totals.selectExpr("*", f"{low} as _low", f"{high} as _high").selectExpr(
        *group, f"greatest(_low, _lb) <= least(_high, _ub) + {TOLERANCE}D as feasible",
        f"stack({len(wanted)}, {listed}) as (policy, _amount)",
    )
    cuts = _cuts(_steps(boxed, group, "slope", "_range"), plan, group, ["feasible", "policy"], "slope", "_amount")
    return (
        _join_group(boxed, cuts, group)
        .selectExpr("*", f"{round_dp(f'spends_lb + _range * ({_part("slope")})', 6)} as optimized_spends")
        .drop("_range", "_cut", "_cut_part")
    )


def min_spend_for_target(
    items: DataFrame, group: list[str], growth: float = 0.0, exact: bool = False, suffix: str = ""
) -> DataFrame:
    """Least total spend that reaches the group's last-year net sales times (1 + growth).

    Items start at their lower bound. Items that gain net sales are raised by descending
    slope until the target is met. With ``exact`` a surplus is given up by raising the
    items that lose net sales, steepest loss first, until the target is met from above.
    """
    # Gains fill by descending slope, losses by ascending slope: both by descending |slope|.
    boxed = _boxed(items, suffix).selectExpr(
        "*", "slope > 0 as _gains", "abs(slope) as _steep", "abs(slope) * _range as _worth"
    )
    totals = aggregate(response_net_sales(boxed, "spends_lb", suffix), group, {
        "_ns_lb": exact_sum("optimized_netsales", 9), "_ns_ly": exact_sum(f"{LY}netsales", 9),
        "_up": exact_sum("case when slope > 0 then _worth else 0D end", 9),
        "_down": exact_sum("case when slope < 0 then _worth else 0D end", 9),
    })
    reach = f"case when _need > 0 then _up else {'_down' if exact else 'abs(_need)'} end"
    need = totals.selectExpr("*", f"_ns_ly * {1 + growth!r}D - _ns_lb as _need").selectExpr(
        *group, "_need", f"abs(_need) <= {reach} + {TOLERANCE}D as feasible"
    )
    side = [*group, "_gains"]
    amount = f"(case when _gains then _need else {'-_need' if exact else '0D'} end)"
    cuts = _cuts(_steps(boxed, side, "_steep", "_worth"), need, group, ["feasible"], "_steep", amount)
    return (
        _join_group(boxed, cuts, side)
        .selectExpr("*", f"{round_dp(f'spends_lb + _range * ({_part("_steep")})', 6)} as optimized_spends")
        .drop("_range", "_cut", "_cut_part", "_gains", "_steep", "_worth")
    )


# --- budget curve ----------------------------------------------------------------------


def budget_curve(items: DataFrame, group: list[str], suffix: str = "") -> DataFrame:
    """Breakpoints of the best net sales a group reaches with each total spend.

    The optimum is concave and piecewise linear in the budget: it starts with all items at their lower bound and
    each distinct slope, steepest first, adds a segment. One row per segment: ``slope``, total spend
    ``spend_from`` to ``spend_to``, and ``netsales_from`` at its beginning. Every budget of the group is answered by
    one of these rows, without another allocation. ``items`` is read several times, so pass a settled table.
    """
    boxed = _boxed(items, suffix)
    floor = aggregate(response_net_sales(boxed, "spends_lb", suffix), group, {
        "_lb": exact_sum("spends_lb", 9), "_ns_lb": exact_sum("optimized_netsales", 9), "_ns_ly": exact_sum(f"{LY}netsales", 9),
    })
    # The gain of a step is its slope times its range, so both totals run over the same order.
    ties = aggregate(boxed, [*group, "slope"], {
        "_tie": "sum(cast(_range as decimal(28,9)))", "_gain": "sum(cast(slope * _range as decimal(28,9)))",
    })
    bounds = quantile_bounds(boxed, "slope")
    spent = running_totals(ties, group, "slope", "_tie", descending=True, bounds=bounds).drop("_tie_total")
    both = running_totals(settle(spent), group, "slope", "_gain", descending=True, bounds=bounds)
    return _join_group(both, floor, group).selectExpr(
        *group, "slope", "_lb + _tie_before as spend_from", "_lb + _tie_before + cast(_tie as double) as spend_to",
        "_ns_lb + _gain_before as netsales_from", "_lb as least_spend", "_ns_lb as least_netsales", "_ns_ly as last_year_netsales",
    )


def optimum_at(curve: DataFrame, budgets: DataFrame, group: list[str]) -> DataFrame:
    """Best net sales at each (group, budget): ``spend``, ``netsales``, ``growth``, ``marginal``, ``feasible``.

    A budget spends all it can; beyond the last breakpoint the group spends its upper bounds, and below
    the first one nothing is feasible and the lower bounds are shown. ``marginal`` is the net sales of the next
    unit of spend, null at the upper bounds. Each segment meets the budgets of its group only; what
    remains is one row per budget, found by partial aggregation.
    """
    met = _join_group(curve, budgets, group)
    inside = "budget >= spend_from"
    found = aggregate(met, [*group, "budget"], {
        # The last segment that begins below the budget: slopes fall along the curve.
        "_slope": f"min(slope) filter (where {inside})",
        "_at": f"min_by(struct(spend_from, spend_to, netsales_from), slope) filter (where {inside})",
        "_next": "max(slope) filter (where spend_to > budget)",
        "_lb": "max(least_spend)", "_ns_lb": "max(least_netsales)", "_ns_ly": "max(last_year_netsales)",
    })
    spend = "if(_at is null, _lb, least(budget, _at.spend_to))"
    netsales = f"coalesce(_at.netsales_from + _slope * ({spend} - _at.spend_from), _ns_lb)"
    return found.selectExpr(
        *group, "budget", f"{spend} as spend", f"{netsales} as netsales", f"{change(netsales, '_ns_ly')} as growth",
        "_next as marginal", f"budget >= _lb - {TOLERANCE}D as feasible",
    )


def without_losing_raises(items: DataFrame, suffix: str = "") -> DataFrame:
    """Items whose range is cut where more spend than last year would mean lower net sales.

    The guard-rail as a bound instead of a later revert: an item with a negative slope may not be raised
    above its old spend, so its upper bound comes down to it (never below the lower bound), and the budget
    goes to items that gain. Adds ``spends_cap``, which ``allocate`` takes as the upper bound.
    """
    old = f"{LY}spends{suffix}"
    slope = f"coalesce(spends_coef * {ratio(f'{LY}gps{suffix}', old)} - 1, -1D)"
    lower, upper = f"{LY}spends * {LOWER}D", f"{LY}spends * {UPPER}D"
    return items.selectExpr("*", f"if({slope} < 0, greatest({lower}, least({upper}, {old})), {upper}) as spends_cap")


def candidate_scores(candidates: DataFrame, group: list[str], suffix: str = "") -> DataFrame:
    """Growth, spend and overall spend percent of every candidate allocation of a group."""
    sums = aggregate(response_net_sales(candidates, "optimized_spends", suffix), [*group, "policy"], {
        "_ns": exact_sum("optimized_netsales", 9), "_spend": exact_sum("optimized_spends", 9),
        "_ns_ly": exact_sum(f"{LY}netsales", 9), "_spend_ly": exact_sum(f"{LY}spends", 9),
        "_spend_old": exact_sum(f"{LY}spends{suffix}", 9),
    })
    overall = change("_spend", "_spend_old") if suffix else "0D"
    return sums.selectExpr(
        *group, "policy", f"{round_dp(change('_ns', '_ns_ly'), 6)} as growth_percent",
        f"{round_dp(change('_spend', '_spend_ly'), 6)} as spend_percent",
        f"{round_dp(overall, 6)} as overall_spend_percent",
    )


def candidate_select(
    candidates: DataFrame, group: list[str], suffix: str = "", has_goal: bool = False
) -> DataFrame:
    """Best candidate per group: highest growth in stage 1, highest spend then growth in stage 2.

    Without a goal a candidate may not raise spend by more than 0.5 %, and in stage 2 not
    move the old total by more than 10 %. A group where no candidate passes keeps its best
    one, flagged ``accepted = false``.
    """
    passes = "true"
    if not has_goal:
        passes = "coalesce(spend_percent <= 0.005D, false)"
        if suffix:
            passes += f" and abs({round_dp('overall_spend_percent', 1)}) <= 0.1D"
    preference = ["spend_percent", "growth_percent"] if suffix else ["growth_percent"]
    order = ", ".join(["accepted desc", *[f"{c} desc nulls last" for c in preference], "policy"])
    # One row per policy in each window.
    place = f"row_number() over (partition by {', '.join(group) or '0'} order by {order}) as _place"
    scores = candidate_scores(candidates, group, suffix).selectExpr("*", f"{passes} as accepted")
    return scores.selectExpr("*", place).filter("_place = 1").drop("_place")


def select_candidate_rows(candidates: DataFrame, chosen: DataFrame, group: list[str]) -> DataFrame:
    """Item rows of the chosen candidate of each group."""
    return join_keys(candidates, chosen.select(*group, "policy"), [*group, "policy"])


# --- projection ------------------------------------------------------------------------


COST_OLD, COST_NEW = f"{LY}volume_old * ec_per_qtycase", "optimized_volume * ec_per_qtycase"
COST = {
    "ec": COST_OLD, "ec_new": COST_NEW, "mc": f"{LY}netsales_old - {COST_OLD}",
    "mc_new": f"optimized_netsales_adj - {COST_NEW}",
}


def project_optimised(allocated: DataFrame, suffix: str = "") -> DataFrame:
    """Optimised volume, GPS, net sales and relative changes; stage 2 adds cost and margin."""
    valued = response_net_sales(allocated, "optimized_spends", suffix).fillna(
        0.0, ["optimized_spends", "optimized_gps"]
    )
    out = with_exprs(valued, {"optimized_netsales": "optimized_gps - optimized_spends"}).selectExpr(
        "*", "optimized_netsales * adjustment_factor as optimized_netsales_adj",
        f"{change('optimized_volume', f'{LY}volume{suffix}')} as vol_change",
        f"{change('optimized_netsales', f'{LY}netsales{suffix}')} as ns_change",
    )
    return out.selectExpr("*", *named(COST)) if suffix else out


def carry_non_optimised(carried: DataFrame, suffix: str = "") -> DataFrame:
    """Rows that spend without volume keep last year's values and zero factors."""
    out = carried.selectExpr(
        "*", "0D as backcalc_intercept", f"0D as {LY}netsales_calc", "0D as adjustment_factor",
        f"{LY}spends * {LOWER}D as spends_lb", f"{LY}spends * {UPPER}D as spends_ub",
        *[f"{LY}{m} as optimized_{m}" for m in BASE_MEASURES], "0D as optimized_netsales_adj",
        f"{change(f'{LY}spends', f'{LY}spends{suffix}')} as spend_change",
        "0D as vol_change", "0D as ns_change", "true as feasible",
    )
    return out.selectExpr("*", *named(COST)) if suffix else out


OUTPUT_TAIL = [
    "spends_coef", "price", "ns_to_gps", "backcalc_intercept", f"{LY}netsales_calc",
    "adjustment_factor", "spends_lb", "spends_ub", "optimized_spends", "optimized_volume",
    "optimized_gps", "optimized_netsales", "optimized_netsales_adj",
    "spend_change", "vol_change", "ns_change", "feasible",
]
STAGE1_OUTPUT = ["shisha", "channel", "planningcustomer", *[f"{LY}{m}" for m in BASE_MEASURES], *OUTPUT_TAIL]
STAGE2_OUTPUT = [
    *S.DIMENSIONS, *[f"{LY}{m}_old" for m in BASE_MEASURES], *[f"{LY}{m}" for m in BASE_MEASURES],
    "ec_per_qtycase", *OUTPUT_TAIL, "ec", "mc", "ec_new", "mc_new",
]


def _choose(items: DataFrame, group: list[str], suffix: str, policies: list[str], **band) -> DataFrame:
    candidates = allocate(items, group, suffix, policies=policies, **band)
    if len(policies) == 1:
        return candidates
    candidates = settle(candidates)
    chosen = candidate_select(candidates, group, suffix, has_goal=band.get("goal") is not None)
    return select_candidate_rows(candidates, chosen, group)


def optimise_stage1(
    baseline: DataFrame, goal_spend: float | None = None, policies: list[str] | None = None,
    by: list[str] = (), goals: DataFrame | None = None,
) -> DataFrame:
    """Stage 1: one budget over all customers, carried rows appended.

    A goal is reduced by the spend of carried rows before it is allocated. With ``by``, each of its groups
    has a budget of its own, and ``goals`` (by, goal_spend) gives the goals of those that have one.
    """
    parts = settle(split_optimisable(baseline))
    items = back_calibrate(parts.filter("treatment = 'optimise'"))
    carried = parts.filter("treatment = 'carry'")
    goal = None
    if goals is not None:
        spent = aggregate(carried, list(by), {"_carried": exact_sum(f"{LY}spends", 9)})
        goal = join_keys(goals, spent, list(by), "left").selectExpr(*by, f"goal_spend - {zero_if_null('_carried')} as goal_spend")
    elif goal_spend is not None:
        spent = aggregate(carried, [], {"s": zero_if_null(exact_sum(f"{LY}spends", 9))})
        goal = F.lit(float(goal_spend)) - spent.scalar()
    chosen = _choose(items, list(by), "", policies or [MAX_NET_SALES], goal=goal)
    done = project_optimised(chosen).select(*by, *STAGE1_OUTPUT)
    return done.unionByName(carry_non_optimised(carried).select(*by, *STAGE1_OUTPUT))


def stage2_old(scope: DataFrame, by: list[str] = ()) -> DataFrame:
    """Last-year totals per segment, branch office and customer."""
    return _scope_sums(scope, [*by, *STAGE2_KEY]).withColumnsRenamed({m: f"{LY}{m}_old" for m in BASE_MEASURES})


def pushdown_stage1(
    coefficients: DataFrame, old: DataFrame, stage1: DataFrame, cost: DataFrame, by: list[str] = ()
) -> DataFrame:
    """Spread stage-1 customer spend and volume over segments by last-year share.

    ``coefficients`` carry the eight dimensions. GPS follows volume at last year's unit
    value; where that is undefined it is 0.
    """
    fine, customer_key = [*by, *STAGE2_KEY], [*by, *STAGE1_KEY]
    measures = [f"{LY}{m}_old" for m in BASE_MEASURES]
    rows = join_keys(coefficients, old, fine, "left").fillna(0.0, [*measures, "price"])
    customer = aggregate(rows, customer_key, {
        "_all_spends": exact_sum(f"{LY}spends_old", 9), "_all_volume": exact_sum(f"{LY}volume_old", 9),
    })
    updated = stage1.selectExpr(
        *customer_key, "optimized_spends as _new_spends", "optimized_volume as _new_volume"
    )
    spends = f"({ratio0(f'{LY}spends_old', '_all_spends')}) * _new_spends"
    volume = f"({ratio0(f'{LY}volume_old', '_all_volume')}) * _new_volume"
    gps = ratio(f"{LY}volume * {LY}gps_old", f"{LY}volume_old")
    shared = (
        join_keys(rows, join_keys(customer, updated, customer_key, "left"), customer_key, "left")
        .selectExpr(*rows.columns, f"{zero_if_null(spends)} as {LY}spends", f"{volume} as {LY}volume")
        .selectExpr("*", f"{zero_if_null(gps)} as {LY}gps")
        .selectExpr("*", f"{LY}gps - {LY}spends as {LY}netsales")
        .selectExpr(
            "*", f"{ratio0(f'{LY}netsales', f'{LY}gps', 3)} as ns_to_gps",
            f"concat_ws('$', {', '.join(STAGE2_KEY)}) as key_combination",
            f"concat_ws('$', {', '.join(STAGE1_KEY)}) as key_combination1",
        )
    )
    return join_keys(shared, cost, fine, "left")


def cost_per_case(actuals: DataFrame, year: int | range, spend_columns: list[str]) -> DataFrame:
    """Cost per case of the period's year, or years, over booked rows that carry the listed spend."""
    years = year if isinstance(year, range) else range(year, year + 1)
    booked = actuals.filter(
        f"cast(year as int) between {years[0]} and {years[-1]} and {' + '.join(spend_columns)} > 0 and salesqtycase >= 0"
    ).withColumnRenamed("shishanm", "shisha")
    sums = aggregate(booked, STAGE2_KEY, {"_cases": exact_sum("salesqtycase"), "_ec": exact_sum("ec")})
    return sums.selectExpr(*STAGE2_KEY, f"{ratio0('_ec', '_cases')} as ec_per_qtycase")


def optimise_stage2(pushed: DataFrame, policies: list[str] | None = None, by: list[str] = ()) -> DataFrame:
    """Stage 2: every (branch office, customer) group over its segments, all groups in one job."""
    parts = settle(split_optimisable(pushed))
    items = with_exprs(
        back_calibrate(parts.filter("treatment = 'optimise'")),
        {f"{LY}netsales_old": f"{LY}gps_old - {LY}spends_old"},
    )
    chosen = _choose(items, [*by, *STAGE1_KEY], "_old", policies or [SPEND_FIRST], band_on_old=True)
    done = project_optimised(chosen, "_old").select(*by, *STAGE2_OUTPUT)
    carried = carry_non_optimised(parts.filter("treatment = 'carry'"), "_old")
    return done.unionByName(carried.select(*by, *STAGE2_OUTPUT))


def infeasible_groups(output: DataFrame, group: list[str] = STAGE1_KEY) -> DataFrame:
    """Groups whose band or goal no allocation inside the items' bounds can meet, with their totals."""
    return aggregate(output.filter("not feasible"), group, {
        "items": "count(1)", "spends_lb": exact_sum("spends_lb", 9), "spends_ub": exact_sum("spends_ub", 9),
        "optimized_spends": exact_sum("optimized_spends", 9),
    })


def guardrail_revert(output: DataFrame) -> DataFrame:
    """Rows that would spend as much or more and sell less go back to last year's values."""
    old_ns = f"{LY}netsales_old"
    flagged = with_exprs(output, {
        "spend_change": change("optimized_spends", f"{LY}spends_old"),
        "netsales_change": ratio(f"optimized_netsales - {old_ns}", f"abs({old_ns})"),
    }).selectExpr("*", "coalesce(spend_change >= 0 and netsales_change < 0, false) as reverted")
    return with_exprs(flagged, {
        f"optimized_{m}": f"if(reverted, {LY}{m}_old, optimized_{m})" for m in BASE_MEASURES
    })


def stage_summary(output: DataFrame, suffix: str = "", by: list[str] = ()) -> DataFrame:
    """Relative change of total spend, volume and net sales against last year."""
    pairs = {
        "spend_change": ("optimized_spends", f"{LY}spends{suffix}"),
        "volume_change": ("optimized_volume", f"{LY}volume{suffix}"),
        "netsales_change": ("optimized_netsales_adj", f"{LY}netsales{suffix}"),
    }
    return aggregate(output, list(by), {
        name: round_dp(change(exact_sum(new, 9), exact_sum(old, 9)), 6) for name, (new, old) in pairs.items()
    })


def spend_mismatch(output: DataFrame, group: list[str] = STAGE1_KEY) -> DataFrame:
    """Groups whose optimised spend differs from the pushed-down spend at whole units."""
    sums = aggregate(output, group, {
        f"{LY}spends": exact_sum(f"{LY}spends", 9), "optimized_spends": exact_sum("optimized_spends", 9),
    })
    return sums.filter(f"{round_dp('optimized_spends', 0)} != {round_dp(f'{LY}spends', 0)}").selectExpr(
        "*", f"{change('optimized_spends', f'{LY}spends')} * 100 as change_perc"
    )
