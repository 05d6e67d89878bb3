"""Preparation: shares, actuals, price changes, views, history and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from spendlever import schemas as S
from spendlever.functions.expr import (
    HALF_LABEL, HALF_NUMBER, MONTH_END, aggregate, any_nonzero, exact_avg, exact_sum, hashed, in_list, join_keys,
    named, quoted, ratio, ratio0, round_dp, ten_thousandths, with_exprs, zero_if_null,
)

SHARE_NAMES = {
    "spends": "spends_contri", "volume": "vol_contri", "gps": "gps_contri", "netsales": "ns_contri",
}
IS_DRIVER = "not " + in_list("modelingname", S.NON_DRIVER_ROWS)
IS_TOTAL = in_list("modelingname", S.TOTAL_ROWS)
IS_SPEND = in_list("modelingname", S.SPEND_TYPES)


def _total(measure: str, keys: list[str]) -> str:
    return f"cast(sum({ten_thousandths(measure)}) over (partition by {', '.join(keys)}) as double) / 10000D"


def contribution_share(fact: DataFrame, keys: list[str] = S.KEY10) -> DataFrame:
    """Share of each driver in its key's total, per measure, rounded to 3 places.

    The fact is at driver grain, so a window group holds one row per driver.
    """
    totals = {f"_{m}": _total(m, keys) for m in SHARE_NAMES}
    shares = {name: ratio0(m, f"_{m}", 3) for m, name in SHARE_NAMES.items()}
    return fact.filter(IS_DRIVER).selectExpr("*", *named(totals)).selectExpr(
        *keys, "modelingname", "ec_per_qtycase", *named(shares), f"{ratio('gps', 'volume')} as price"
    )


def actuals_rollup(actuals: DataFrame) -> DataFrame:
    """Booked spend, sales amount and cases per period, segment, branch office and customer."""
    keyed = actuals.selectExpr(
        "cast(year as int) as year", "cast(month as int) as month", "segment", "shishanm as shisha",
        "planningcustomer", "priceoff + promotionad + liquidation as spends", "salesamt", "salesqtycase",
    )
    return aggregate(keyed, S.KEY5, {
        "total_spends": exact_sum("spends"), "total_salesamt": exact_sum("salesamt"),
        "total_salesqtycase": exact_sum("salesqtycase"),
    })


def rescale_to_actuals(shares: DataFrame, rolled: DataFrame) -> DataFrame:
    """Apply modelled shares to booked totals; keys without actuals get zero measures.

    GPS is the raw volume times price: a missing price or missing cases both give zero.
    """
    cases = "vol_contri * total_salesqtycase"
    scaled = join_keys(shares, rolled, S.KEY5, "left").selectExpr(
        "*", f"{zero_if_null(cases)} as volume",
        f"{zero_if_null('spends_contri * total_spends')} as spends",
        f"{zero_if_null(cases + ' * price')} as gps",
    )
    values = {
        "spends": "spends", "netsales": "gps - spends", "gps": "gps", "volume": "volume",
        "ec": "ec_per_qtycase * volume", "mc": "gps - spends - ec_per_qtycase * volume",
        "price": "price", "ec_per_qtycase": "ec_per_qtycase",
    }
    return scaled.selectExpr(*S.KEY10, "modelingname", *named({k: round_dp(v) for k, v in values.items()}))


def normalise_period(df: DataFrame) -> DataFrame:
    """Render year and month as text, month padded to two digits."""
    return with_exprs(df, {"year": "cast(year as string)", "month": "lpad(cast(month as string), 2, '0')"})


def driver_share_pct(fact: DataFrame, driver: str = S.OWN_PRICE) -> DataFrame:
    """Per segment, the driver's percent of the volume of all drivers."""
    by_driver = aggregate(fact.filter(IS_DRIVER), ["segment", "modelingname"], {"volume": exact_sum("volume")})
    return (
        by_driver.selectExpr("*", f"{ratio('volume', _total('volume', ['segment']))} * 100 as own_price_contri")
        .filter(in_list("modelingname", [driver])).select("segment", "own_price_contri")
    )


def price_change_passthrough(
    scaled: DataFrame, price_changes: DataFrame, own_price: DataFrame
) -> DataFrame:
    """Apply announced price changes to price, and their volume effect to two drivers.

    ``price_change`` is a fraction and ``own_price_contri`` a percentage, so the
    multiplier is in percent points.
    """
    effect = price_changes.join(own_price, "segment").selectExpr(
        "segment", "price_change", "price_change * own_price_contri as multiplier"
    )
    factor = f"""case modelingname when '{S.PRICEOFF}' then 1 + {zero_if_null('multiplier')}
        when '{S.OWN_PRICE}' then 1 - {zero_if_null('multiplier')} else 1D end"""
    repriced = with_exprs(scaled.join(effect, "segment", "left"), {
        "price": f"price * (1 + {zero_if_null('price_change')})",
        **{m: f"{m} * {factor}" for m in ("gps", "volume", "netsales")},
    })
    return repriced.select(*scaled.columns)


BRANCH_CODES = {"priceoff": "po", "liquidation": "liq", "promotionad": "pa"}
BRANCH_MONEY = [f"{kind}_{t}" for t in BRANCH_CODES for kind in ("ini", "add")]


def branch_money_split(feeds: list[DataFrame], customers: DataFrame) -> DataFrame:
    """Initial and additional money per week, segment, branch office, new and old customer.

    ``feeds`` are tables of one layout. Lines without sales that still carry new spend
    are left out. Lines are summed, never deduplicated: two equal lines are two bookings.
    """
    names = customers.selectExpr(
        "planningcustomercd as old_planningcustomercd", "planningcustomer as old_planningcustomer"
    ).distinct()
    money = {
        f"{kind}_{t}": f"{kind}_contri_{code} * new_{t}"
        for t, code in BRANCH_CODES.items() for kind in ("ini", "add")
    }
    no_new_spend = " and ".join(f"new_{t} = 0" for t in BRANCH_CODES)
    grain = hashed(["yearmonth", "year", "month", "week_start", "segment", "shishanm", "new_planningcustomer"], *feeds)
    weekly = aggregate(
        reduce(DataFrame.unionByName, feeds).filter(f"salesamt != 0 or ({no_new_spend})"),
        [*grain, "old_planningcustomercd"], {m: exact_sum(x) for m, x in money.items()},
    )
    return weekly.join(names, "old_planningcustomercd", "left").select(*grain, "old_planningcustomer", *money)


def category_from_path(
    branch: DataFrame, rules: list[tuple[str, str]], default: str
) -> DataFrame:
    """Category by the first rule whose text occurs in the segment path, with money totals.

    ``rules`` are (text, category) pairs in order of precedence.
    """
    cases = " ".join(f"when contains(segment, {quoted(text)}) then {quoted(name)}" for text, name in rules)
    category = f"case {cases} else {quoted(default)} end" if rules else quoted(default)
    sums = aggregate(
        branch.selectExpr("*", f"{category} as category"), ["category"],
        {c: exact_sum(c) for c in BRANCH_MONEY},
    )
    return sums.selectExpr("*", *[f"ini_{t} + add_{t} as new_{t}" for t in BRANCH_CODES])


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many values are null (or NaN, for floating columns)."""
    def missing(name: str, kind: str) -> str:
        nan = f" or isnan(`{name}`)" if kind in ("double", "float") else ""
        return f"count_if(`{name}` is null{nan})"

    counts = aggregate(df, [], {n: missing(n, k) for n, k in df.dtypes})
    return counts.unpivot([], df.columns, "column_name", "missing")


def decomp_view(fact: DataFrame, totals: DataFrame, keep: str | None = None) -> DataFrame:
    """Published decomposition: drivers plus total rows, month-end date, half-year, text period.

    ``keep`` replaces the default row filter (any measure non-zero).
    """
    common = [*S.KEY10, "modelingname", "spends", "gps", "netsales", "volume", "price"]
    rows = fact.select(*common).unionByName(totals.filter(IS_TOTAL).select(*common))
    placeholders = {c: "0" for c in ("ec", "ec_per_qtycase", "mc")}
    view = rows.filter(keep or any_nonzero(S.MEASURES)).selectExpr(
        "*", f"{MONTH_END} as date", f"{HALF_NUMBER} as half_year", *named(placeholders)
    )
    return normalise_period(view).select(*VIEW_KEYS, *VIEW_VALUES)


# Drivers left out of the baseline of each spend type; the exclusion accumulates in this order.
BASELINE_EXCLUDES = {
    S.PRICEOFF: [S.PRICEOFF],
    S.PROMOTIONAD: [S.PRICEOFF, S.PROMOTIONAD],
    S.LIQUIDATION: [S.PRICEOFF, S.PROMOTIONAD, S.LIQUIDATION],
}


def history_baseline(opt_input: DataFrame, decomposition: DataFrame) -> DataFrame:
    """Half-year history of each spend type next to the baseline volume of other drivers.

    The three baselines are three conditional sums over one scan; rows move to the
    following year and carry the last day of the half-year.
    """
    key = ["year", "half_year", *S.DIMENSIONS]
    halves = {"year": "cast(year as int)", "half_year": HALF_LABEL}
    baseline = aggregate(with_exprs(decomposition.filter(f"not {IS_TOTAL}"), halves), key, {
        f"_base_{t}": exact_sum(f"case when not {in_list('modelingname', out)} then volume end")
        for t, out in BASELINE_EXCLUDES.items()
    })
    spend_rows = aggregate(
        with_exprs(opt_input.filter(IS_SPEND), halves), [*key, "modelingname"],
        {**{m: exact_sum(m) for m in S.MEASURES}, "price": exact_avg("price")},
    )
    own = " ".join(f"when '{t}' then _base_{t}" for t in BASELINE_EXCLUDES)
    moved = with_exprs(join_keys(spend_rows, baseline, key, "left"), {
        "baseline_volume": f"case modelingname {own} end", "year": "year + 1",
        "month": "case when half_year = 'H1' then 6 else 12 end",
    })
    volume = "volume + baseline_volume"
    return moved.selectExpr(
        "'HISTORICAL_DATA' as scenario_name", "year", "half_year", f"{MONTH_END} as date", *S.DIMENSIONS,
        "modelingname", "baseline_volume", "price",
        *named({
            "total_initial_spend": zero_if_null("spends"), "total_initial_volume": zero_if_null(volume),
            "total_initial_gps": zero_if_null(f"({volume}) * price"),
            "total_initial_netsales": zero_if_null(f"({volume}) * price - spends"),
        }),
        "1 as is_latest",
    )


def ratio_impute(
    fact: DataFrame, actuals: DataFrame, measures: tuple[str, ...] = ("spends", "gps", "netsales")
) -> DataFrame:
    """Scale each key's rows so that its totals meet the actuals; no factor means 1.

    Rows of a key that has total rows only carry no factor and become 0.
    """
    modelled = aggregate(fact.filter(f"not {IS_TOTAL}"), S.KEY5, {f"_model_{m}": exact_sum(m) for m in measures})
    booked = aggregate(actuals, S.KEY5, {f"_actual_{m}": exact_sum(m) for m in measures})
    factors = join_keys(modelled, booked, S.KEY5, "left").selectExpr(
        *S.KEY5, *[f"coalesce({ratio(f'_actual_{m}', f'_model_{m}')}, 1D) as _factor_{m}" for m in measures]
    )
    scaled = with_exprs(join_keys(fact, factors, S.KEY5, "left"), {m: f"{m} * _factor_{m}" for m in measures})
    return scaled.select(*fact.columns).fillna(0.0)


VIEW_KEYS = ["date", "year", "month", "half_year", *S.DIMENSIONS, "modelingname"]
VIEW_VALUES = ["spends", "gps", "netsales", "volume", "price", "ec", "ec_per_qtycase", "mc"]


def replacement_rows(new_rows: DataFrame) -> DataFrame:
    """New driver rows plus one synthetic total row of each kind per key, in view shape."""
    labels = f"explode(array('{S.PREDICTED_SALES}', '{S.VOLUME_TOTAL}')) as modelingname"
    totals = aggregate(new_rows, S.KEY10, {
        **{m: exact_sum(m) for m in S.MEASURES},
        **{m: exact_avg(m) for m in ("price", "ec", "ec_per_qtycase", "mc")},
    }).selectExpr("*", labels)
    columns = [*S.KEY10, "modelingname", *VIEW_VALUES]
    rows = new_rows.select(*columns).unionByName(totals.select(*columns))
    dated = rows.selectExpr("*", f"{MONTH_END} as date", f"{HALF_NUMBER} as half_year")
    return normalise_period(dated).select(*VIEW_KEYS, *VIEW_VALUES)


def override_merge(view: DataFrame, replacement: DataFrame, segments: list[str]) -> DataFrame:
    """Take replacement rows for the listed segments; keep existing predicted-sales rows."""
    renamed = replacement.selectExpr(*VIEW_KEYS, *[f"{c} as {c}_new" for c in VIEW_VALUES])
    value = """cast(case when {listed} and modelingname != '{predicted}' then {c}_new
        when {listed} then coalesce({c}, {c}_new) else {c} end as double)"""
    merged = {
        c: zero_if_null(value.format(c=c, listed=in_list("segment", segments), predicted=S.PREDICTED_SALES))
        for c in VIEW_VALUES
    }
    both = join_keys(view.select(*VIEW_KEYS, *VIEW_VALUES), renamed, VIEW_KEYS, "outer")
    return both.selectExpr(*VIEW_KEYS, *named(merged))


def reconcile_totals(
    before: DataFrame, after: DataFrame, keys: list[str], measures: list[str] = S.MEASURES
) -> DataFrame:
    """One row per key and measure: total before, after, difference, display text, row counts."""
    # One aggregation over both sides: a key of nulls meets itself, and no key at all gives one row.
    sides = before.selectExpr("*", "true as _first").select(*keys, *measures, "_first").unionByName(
        after.selectExpr("*", "false as _first").select(*keys, *measures, "_first"))
    tags = {"before": "_first", "after": "not _first"}
    totals = aggregate(sides, keys, {
        **{f"{m}_{tag}": exact_sum(f"if({mine}, {m}, null)") for tag, mine in tags.items() for m in measures},
        **{f"rows_{tag}": f"count_if({mine})" for tag, mine in tags.items()},
    })
    checks = ", ".join(
        f"named_struct('measure', '{m}', 'before', {zero_if_null(m + '_before')}, 'after', {zero_if_null(m + '_after')})"
        for m in measures
    )
    return (
        totals.selectExpr(*keys, "rows_before", "rows_after", f"explode(array({checks})) as c")
        .selectExpr(
            *keys, "c.measure", "c.before", "c.after", "c.after - c.before as diff",
            "format_number(c.after, 2) as after_text", "rows_before", "rows_after",
        )
    )
