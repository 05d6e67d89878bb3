"""Scenarios as data: all requests are scoped, fitted and allocated in one plan, told apart by a column.

A request becomes a row with its scope lists, its period as month indexes (12 * year + month - 1, so that
a period may cross a year end) and its goal. Rows of the fact meet scenarios in an equi-join on
the exploded lists; every later operator carries ``scenario_name`` (``BY``) as a key column, and a budget is
one group per scenario. Scenarios of one scope share their fits: the response model is fitted once
per ``scope_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spendlever import schemas as S
from spendlever.functions.expr import (
    aggregate, exact_sum, in_list, join_keys, named, quoted, ratio0, with_exprs,
)
from spendlever.operators.publish import MONTH_OF_DATE, scenario_params

BY = ["scenario_name"]
SCOPE_LISTS = ["category", "channel", "shisha"]
#: Stands for all values where a request has no list.
EVERY = "*"
MONTH_INDEX = "12 * year + month - 1"
#: Reasons for which a request is refused, in order of precedence.
REFUSALS = {
    "document": "scenario_name is null or business is null or spend_type is null or _first is null or _last is null",
    "spend type": f"not {in_list('spend_type', S.SPEND_TYPES)}",
    "objective": "strategy is null",
    "budget": "strategy = '3' and goal_spend is null",
    "period": "_first > _last",
    "scope": " or ".join(f"size({c}) = 0" for c in SCOPE_LISTS),
    "name": "_same > 1",
}


def _month_index(text: str) -> str:
    """Month index of a 'YYYY-MM-DD ...' text, null if it is none."""
    return f"(12 * try_cast(substring({text}, 1, 4) as int) + try_cast(substring({text}, 6, 2) as int) - 1)"


def judged_requests(requests: DataFrame) -> DataFrame:
    """Every request as a scenario row, with the reason it is refused for, or null.

    A document that can't be parsed, an unknown spend type or objective, a budget objective without budget, a
    period that ends before it starts, an empty scope list and a scenario name that several requests
    share are refused; nothing is dropped. A missing scope list means all values. One request may be
    stored several times; equal documents of one uid are one request.
    """
    rows = scenario_params(requests).selectExpr(
        "*", f"{_month_index('period_start')} as _first", f"{_month_index('period_end')} as _last",
        # As many rows as requests of one name: small.
        "count(1) over (partition by scenario_name) as _same",
    )
    reason = " ".join(f"when {test} then {quoted(name)}" for name, test in REFUSALS.items())
    return rows.selectExpr(
        "uid", "scenario_name", "business", "spend_type", *[f"sort_array(array_distinct({c})) as {c}" for c in SCOPE_LISTS],
        "strategy", "goal_spend", "_first as first_month", "_last as last_month", f"case {reason} end as refused",
    ).selectExpr(
        "*", "first_month - 12 as last_year_first", "last_month - 12 as last_year_last",
        f"md5(to_json(struct(business, spend_type, {', '.join(SCOPE_LISTS)}))) as scope_id",
    )


def valid_scenarios(judged: DataFrame) -> DataFrame:
    return judged.filter("refused is null").drop("refused")


def refused_requests(judged: DataFrame) -> DataFrame:
    return judged.filter("refused is not null").select("uid", "scenario_name", "refused")


def _scopes(scenarios: DataFrame) -> DataFrame:
    """One row per distinct scope and combination of its listed values; a missing list is ``*``."""
    rows = scenarios.select("scope_id", "business", "spend_type", *SCOPE_LISTS).distinct()
    for c in SCOPE_LISTS:
        rows = rows.selectExpr(*[x for x in rows.columns if x != c], f"explode(coalesce({c}, array('{EVERY}'))) as {c}")
    return rows


def _matched(rows: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Rows once per distinct scope that lists them, with ``scope_id`` and ``spend_type``, whatever their driver.

    Each kind of scope (which of its lists are missing) is an equi-join of its own on the columns that are
    listed, so no row is compared with scopes it is outside of.
    """
    scopes = _scopes(scenarios)
    free = [f"{c} <=> '{EVERY}'" for c in SCOPE_LISTS]
    kinds = scopes.selectExpr(*[f"{test} as {c}" for c, test in zip(SCOPE_LISTS, free)]).distinct().collect()  # 8 at most
    out = rows.selectExpr("*", "cast(null as string) as scope_id", "cast(null as string) as spend_type").limit(0)
    for kind in sorted(map(tuple, kinds)):
        mine = scopes.filter(" and ".join(f"({test}) = {str(is_free).lower()}" for test, is_free in zip(free, kind)))
        listed = [c for c, is_free in zip(SCOPE_LISTS, kind) if not is_free]
        names = mine.select("scope_id", "spend_type", "business", *listed)
        part = join_keys(rows, names, ["business", *listed])
        out = part if len(kinds) == 1 else out.unionByName(part)
    return out


def scope_rows(fact: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Rows of each scope's own driver over the whole history, with ``scope_id``: the rows of its fits."""
    spent = fact.filter("spends > 0 and volume >= 0")
    return _matched(spent, scenarios).filter("modelingname = spend_type").drop("spend_type")


def period_rows(rows: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Rows of a scope in the last-year period of each scenario of that scope, with ``scenario_name``."""
    periods = scenarios.select("scenario_name", "scope_id", "last_year_first", "last_year_last")
    inside = join_keys(rows, periods, ["scope_id"]).filter(f"{MONTH_INDEX} between last_year_first and last_year_last")
    return inside.drop("scope_id", "last_year_first", "last_year_last")


def other_driver_rows(fact: DataFrame, scenarios: DataFrame) -> DataFrame:
    """In-scope rows of the last-year period for every driver but the scenario's own and the total rows."""
    drivers = fact.filter(f"not {in_list('modelingname', S.TOTAL_ROWS)}")
    others = _matched(drivers, scenarios).filter("modelingname != spend_type").drop("spend_type")
    return period_rows(others, scenarios)


def per_scenario(coefficients: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Coefficients of a scope as those of each scenario of that scope."""
    return join_keys(coefficients, scenarios.select("scenario_name", "scope_id"), ["scope_id"]).drop("scope_id")


def cost_per_case(actuals: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Cost per case of each scenario's keys over the years its last-year period touches.

    Booked rows count that carry the scenario's spend type. They are summed per year and key before they
    meet the scenarios.
    """
    key = ["segment", "shisha", "planningcustomer"]
    typed = ", ".join(f"'{t}', {t.lower()}" for t in S.SPEND_TYPES)
    booked = actuals.filter("salesqtycase >= 0").selectExpr(
        "cast(year as int) as year", "segment", "shishanm as shisha", "planningcustomer", "salesqtycase", "ec",
        f"stack({len(S.SPEND_TYPES)}, {typed}) as (spend_type, spent)",
    ).filter("spent > 0")
    yearly = aggregate(booked, ["year", *key, "spend_type"], {
        "_cases": exact_sum("salesqtycase"), "_ec": exact_sum("ec"),
    })
    wanted = scenarios.selectExpr(
        "scenario_name", "spend_type", "explode(sequence(last_year_first div 12, last_year_last div 12)) as year",
    ).selectExpr("scenario_name", "spend_type", "cast(year as int) as year")
    sums = aggregate(join_keys(yearly, wanted, ["year", "spend_type"]), ["scenario_name", *key], {
        "_cases": exact_sum("_cases"), "_ec": exact_sum("_ec"),
    })
    return sums.selectExpr("scenario_name", *key, f"{ratio0('_ec', '_cases')} as ec_per_qtycase")


def labelled(output: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Output rows with the spend type of their scenario as ``modelingname``."""
    names = scenarios.selectExpr("scenario_name", "spend_type as modelingname")
    return join_keys(output, names, ["scenario_name"])


def publish_scenarios(existing: DataFrame, final: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Replace the rows of all published scenarios and retire rows of others that overlap any of them.

    A published row carries the last month of its scenario's period. Scenarios of one batch don't retire each other.
    """
    others = with_exprs(
        join_keys(existing, scenarios.select("scenario_name"), ["scenario_name"], "left_anti"), {"_index": MONTH_OF_DATE})
    key = ["business", *SCOPE_LISTS, "modelingname", "_index"]
    months = scenarios.selectExpr("scope_id", "explode(sequence(first_month, last_month)) as _index").distinct()
    found = _matched(others.select(*key).distinct(), scenarios).filter("modelingname = spend_type")
    hit = join_keys(found, months, ["scope_id", "_index"], "left_semi").select(*key).distinct()
    retired = with_exprs(join_keys(others, hit.selectExpr("*", "true as _hit"), key, "left"), {
        "is_latest": "if(_hit, 0, is_latest)",
    }).drop("_hit", "_index")
    end = "last_day(make_date(last_month div 12, last_month % 12 + 1, 1))"
    tags = scenarios.selectExpr("scenario_name", *named({
        "date": f"concat(cast({end} as string), ' 23:59:59')", "year": "cast(last_month div 12 as int)",
        "month": "cast(last_month % 12 + 1 as int)", "half_year": "if(last_month % 12 < 6, 'H1', 'H2')", "is_latest": "1",
    }))
    return retired.unionByName(join_keys(final, tags, ["scenario_name"]).distinct(), allowMissingColumns=True)
