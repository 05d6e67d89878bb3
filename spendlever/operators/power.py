"""Budgets under the power-law volume response ``intercept * spend ** coefficient``.

The response is separable and, for coefficients between 0 and 1, concave, so one price per group decides every
item: an item is raised until its marginal worth falls to the group's price. The price is found by multisection:
each pass evaluates ``SECTIONS`` prices of every group in one scan of the items, whose sums are partial
aggregates, so a group with all items (a company-wide budget) is spread over the cluster and the number
of passes depends neither on the items nor on the groups. Items end between their spends at the two last prices, all at
the same part of the way, which meets the amount exactly and shares equal marginals pro rata.

Defined results. Items whose coefficient lies outside (0, 1), or whose response is unknown, are valued by the chord
between their bounds: exact at the bounds, where all but the items at the price end. A null coefficient or intercept
is a response of zero. An amount that the bounds can't meet is met as far as they allow and flagged
``feasible = false``. A group without a row in the goals is left out. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spendlever.functions.expr import aggregate, exact_sum, join_keys, ratio, round_dp
from spendlever.functions.lineage import settle
from spendlever.operators.allocate import LOWER, LY, TOLERANCE, UPPER

#: Prices evaluated by one pass, and passes: the price is known to a part in 6 * 10 ** 10 of the range of marginals.
SECTIONS, PASSES = 64, 6
#: Weights of volume tried by one pass of the two-sided problem, and its passes.
MIXES, MIX_PASSES = 8, 5

SPEND, VOLUME = "spend", "volume"


def power_volume(spend: str) -> str:
    """Volume of a planned spend under the power-law response."""
    return f"coalesce(backcalc_intercept * pow({spend}, spends_coef), 0D)"


def curves(items: DataFrame, slope: str = "0D") -> DataFrame:
    """Items with bounds and the two parts of their marginal worth: ``_flat`` and ``_bent * spend ** (coefficient - 1)``.

    ``slope`` is worth per unit of spend besides the volume. ``_chord`` is the volume per unit of spend of items that
    are valued by their chord, and 0 for others.
    """
    boxed = items.selectExpr("*", f"{LY}spends * {LOWER}D as spends_lb", f"{LY}spends * {UPPER}D as spends_ub")
    bent = "coalesce(spends_coef > 0 and spends_coef < 1 and backcalc_intercept > 0 and spends_lb > 0, false)"
    return boxed.selectExpr(
        *items.columns, "spends_lb", "spends_ub", f"cast({slope} as double) as _flat",
        f"if({bent}, backcalc_intercept * spends_coef, 0D) as _bent", f"if({bent}, spends_coef, 0.5D) as _power",
        f"{power_volume('spends_lb')} as _volume_lb",
        f"if({bent}, 0D, coalesce({ratio(f'{power_volume("spends_ub")} - {power_volume("spends_lb")}', 'spends_ub - spends_lb')}, 0D)) as _chord",
    )


def _spend_at(price: str, mix: str) -> str:
    """Spend at which the marginal worth falls to the price; ``mix`` weighs volume against the flat worth."""
    flat, weight = f"((1 - {mix}) * _flat + {mix} * _scale * _chord)", f"({mix} * _scale * _bent)"
    inner = f"pow(({price} - {flat}) / {weight}, 1 / (_power - 1))"
    return (f"case when {price} < {flat} then spends_ub when {weight} <= 0 then spends_lb when {price} = {flat} then spends_ub "
            f"else greatest(spends_lb, least(spends_ub, {inner})) end")


def _spend_met(end: str = "") -> str:
    """Spend between those at the two last prices that meets the goal; ``end`` is the struct that holds them."""
    low, high = (_spend_at(f"{end}{price}", f"{end}_mix") for price in ("_low", "_high"))
    part = f"greatest(0D, least(1D, coalesce(try_divide(_goal - {end}_at_high, {end}_at_low - {end}_at_high), 0D)))"
    return f"{high} + {part} * ({low} - {high})"


def _amount(measure: str, spend: str) -> str:
    """What a spend adds to the group's spend, or to its volume."""
    if measure == SPEND:
        return spend
    return f"if(_bent > 0, _bent / _power * pow({spend}, _power), _volume_lb + _chord * ({spend} - spends_lb))"


def _meet(items: DataFrame, plan: DataFrame, group: list[str]) -> DataFrame:
    """Items next to every plan row of their group.

    Without a group all items meet the plan of the total, which has one row per weight (at most ``MIXES`` + 1), so it is broadcast.
    """
    if group:
        return join_keys(items, plan, group)
    return items.selectExpr("*", "0 as _one").join(F.broadcast(plan.selectExpr("*", "0 as _one")), "_one").drop("_one")


def _evenly(low: str, high: str, first: int, last: int, parts: int) -> str:
    """Distinct points that cut an interval into equal parts, one row each."""
    return f"explode(array_distinct(transform(sequence({first}, {last}), i -> {low} + ({high} - {low}) * i / {parts}D)))"


#: What the search for a price hands on.
FOUND = ["_low", "_high", "_at_low", "_at_high", "feasible"]


def prices(items: DataFrame, plan: DataFrame, group: list[str], measure: str = SPEND) -> DataFrame:
    """Plan rows with the two last prices, ``_low`` and ``_high``, and the amounts the group reaches at them.

    ``items`` come from ``curves``; ``plan`` has the group's columns, ``_mix``, ``_scale`` and ``_goal``, one row per
    question. Both are read once a pass, so pass settled tables.
    """
    asked = plan.columns
    worth = lambda spend: f"(1 - _mix) * _flat + _mix * _scale * (_chord + _bent * pow({spend}, _power - 1))"
    # Below the least marginal all items stand at their upper bounds, above the greatest one at their lower ones.
    found = aggregate(_meet(items, plan, group), asked, {
        "_least": f"min({worth('spends_ub')})", "_most": f"max({worth('spends_lb')})",
        "_at_low": exact_sum(_amount(measure, "spends_ub"), 9), "_at_high": exact_sum(_amount(measure, "spends_lb"), 9),
    }).selectExpr(
        *asked, "_least - (abs(_least) + 1e-9D) * 1e-9D as _low", "_most + (abs(_most) + 1e-9D) * 1e-9D as _high", "_at_low", "_at_high",
        f"_goal >= _at_high - {TOLERANCE}D and _goal <= _at_low + {TOLERANCE}D as feasible",
    )
    state = [*asked, *FOUND]
    for _ in range(PASSES):
        # Settled, so that the planner sees how few questions there are and leaves the items where they are.
        found = settle(found)
        # Prices are made beside the items, and partial sums leave the task: one row per question and price.
        tried = _meet(items, found, group).selectExpr("*", f"{_evenly('_low', '_high', 1, SECTIONS - 1, SECTIONS)} as _price")
        sums = aggregate(tried, [*state, "_price"], {"_sum": exact_sum(_amount(measure, _spend_at("_price", "_mix")), 9)})
        found = aggregate(sums, state, {
            "_below": "max(struct(_price, _sum)) filter (where _sum >= _goal)",
            "_above": "min(struct(_price, _sum)) filter (where _sum < _goal)",
        }).selectExpr(
            *asked, "coalesce(_below._price, _low) as _low", "coalesce(_above._price, _high) as _high",
            "coalesce(_below._sum, _at_low) as _at_low", "coalesce(_above._sum, _at_high) as _at_high", "feasible",
        )
    return settle(found)


def _totals(items: DataFrame, goal: DataFrame | str, group: list[str]) -> DataFrame:
    """Totals of each group and its ``_goal``."""
    totals = aggregate(items, group, {
        "_centre": exact_sum(f"{LY}spends", 9), "_volume": exact_sum(power_volume(f"{LY}spends"), 9),
        "_lb": exact_sum("spends_lb", 9), "_ub": exact_sum("spends_ub", 9), "_worth": exact_sum("abs(_flat) * spends_ub", 9),
    })
    if isinstance(goal, DataFrame):
        return join_keys(totals, goal.withColumnRenamed("goal", "_goal"), group)
    return totals.selectExpr("*", f"cast({goal} as double) as _goal")


def _single(items: DataFrame, group: list[str], goal: DataFrame | str, measure: str) -> DataFrame:
    ready = settle(curves(items))
    plan = settle(_totals(ready, goal, group).selectExpr(*group, "_goal", "1D as _mix", "1D as _scale"))
    met = _meet(ready, prices(ready, plan, group, measure), group).selectExpr("*", f"{_spend_met()} as _z")
    return met.selectExpr(
        *items.columns, "spends_lb", "spends_ub", f"{round_dp('_z', 6)} as optimized_spends",
        f"{power_volume('_z')} as optimized_volume", "feasible", "(_low + _high) / 2 as price_of_spend",
    )


def most_volume(items: DataFrame, group: list[str], goal: DataFrame | str = "_centre") -> DataFrame:
    """Spend per item that maximises the group's volume at a total spend of ``goal``.

    ``goal`` is a table of the group's columns and ``goal``, or an expression over the group's ``_centre``,
    ``_lb``, ``_ub`` and ``_volume`` totals. Adds ``optimized_spends``, ``optimized_volume``, ``feasible`` and
    ``price_of_spend``, the volume gained by the next unit of spend. ``items`` come from ``back_calibrate``.
    """
    return _single(items, group, goal, SPEND)


def least_spend_for_volume(items: DataFrame, group: list[str], goal: DataFrame | str = "_volume") -> DataFrame:
    """Least total spend that brings the group's volume to ``goal``; columns as in ``most_volume``."""
    return _single(items, group, goal, VOLUME)


def best_netsales_with_volume(
    items: DataFrame, group: list[str], goal: DataFrame | str = "_centre", volume: str = "_volume", suffix: str = "",
) -> DataFrame:
    """Net sales maximised at a total spend of ``goal`` while the power-law volume reaches ``volume``.

    Net sales are affine in spend (see ``allocate``). The volume is priced into them: at each of ``MIXES`` weights the
    total spend is met; volume rises with the weight, which is narrowed to the least one whose volume suffices.
    The spends at the two last weights are mixed so that the volume is met; both meet the budget, and so does the mix.
    Where even the greatest volume at that spend falls short, it is returned with ``feasible = false``. ``goal`` and
    ``volume`` are as in ``most_volume``. Adds ``optimized_spends``, ``optimized_volume``, ``optimized_netsales``, ``feasible``.
    """
    s0, g0 = f"{LY}spends{suffix}", f"{LY}gps{suffix}"
    ready = settle(curves(items, f"coalesce(spends_coef * {ratio(g0, s0)} - 1, -1D)"))
    # The scale makes a unit of volume and a unit of net sales comparable, so that the weights spread evenly.
    plan = settle(_totals(ready, goal, group).selectExpr(
        *group, "_goal", f"cast({volume} as double) as _wanted", "greatest(coalesce(try_divide(_worth, _volume), 1D), 1e-9D) as _scale",
        "0D as _from", "1D as _to"))
    question = [*group, "_goal", "_wanted", "_scale"]
    end = "struct(_mix, _got, _low, _high, _at_low, _at_high)"
    for _ in range(MIX_PASSES):
        asked = settle(plan.selectExpr(*question, f"{_evenly('_from', '_to', 0, MIXES, MIXES)} as _mix"))
        met = _meet(ready, prices(ready, asked, group), group).selectExpr("*", f"{_spend_met()} as _z")
        reached = aggregate(met, [*question, "_mix", *FOUND], {"_got": exact_sum(power_volume("_z"), 9)})
        # Without a weight that falls short the first one is free; without one that suffices the last has the most there is.
        plan = settle(aggregate(reached, question, {
            "_short": f"max({end}) filter (where _got < _wanted)", "_enough": f"min({end}) filter (where _got >= _wanted)",
            "_first": f"min({end})", "_last": f"max({end})", "feasible": "bool_and(feasible)",
        }).selectExpr(*question, "coalesce(_short, _first) as _under", "coalesce(_enough, _last) as _over", "feasible").selectExpr(
            "*", "_under._mix as _from", "_over._mix as _to"))
    way = f"greatest(0D, least(1D, coalesce({ratio('_wanted - _under._got', '_over._got - _under._got')}, 0D)))"
    mixed = (
        _meet(ready, plan, group)
        .selectExpr("*", f"{_spend_met('_under.')} as _z_under", f"{_spend_met('_over.')} as _z_over")
        .selectExpr("*", f"_z_under + {way} * (_z_over - _z_under) as _z")
    )
    return mixed.selectExpr(
        *items.columns, "spends_lb", "spends_ub", f"{round_dp('_z', 6)} as optimized_spends",
        f"{power_volume('_z')} as optimized_volume", f"{g0} * (1 + spends_coef * ({ratio(f'_z - {s0}', s0)})) - _z as optimized_netsales",
        f"feasible and _over._got >= _wanted - {TOLERANCE}D * greatest(1D, abs(_wanted)) as feasible",
    )
