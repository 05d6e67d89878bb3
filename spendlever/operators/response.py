"""Spend-to-volume response: percentile ranks, log-log fits, trimming and fallback.

The rows of a key meet once, in one shuffle, where both measures are ranked and the fits follow
without another. Keys too hot for one task (coarse fallback levels have a handful of keys) are ranked
from value counts instead: ties collapse in partial aggregation and only buckets of values are
sorted. Every trimmed refit comes from moments kept per trimming class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from spendlever import schemas as S
from spendlever.functions.expr import (
    MONTH_START, aggregate, exact_sum, in_list, join_keys, named, quoted, round_dp, ten_thousandths, with_exprs,
)
from spendlever.functions.lineage import settle
from spendlever.functions.ordered import average_rank, quantile_bounds, running_totals, split_hot

# Percentile pairs of the trimming corners, mildest first.
TRIM_HIGH = [0.975, 0.95, 0.9, 0.85, 0.8, 0.75, 0.7]
TRIM_LOW = [0.025, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3]
SLOPE_LOW, SLOPE_HIGH = 0.1, 0.9
ZERO_RESPONSE = "Spends_more_than_0_and_Volume_0"
ALL = "*"

NEVER = len(TRIM_HIGH) + 1


@dataclass(frozen=True)
class FitLevels:
    """Key columns of a fit and the key column each fallback level leaves out."""

    keys: tuple[str, ...]
    drops: tuple[str, ...]


STAGE1 = FitLevels(("shisha", "planningcustomer"), ("shisha", "planningcustomer"))
STAGE2 = FitLevels(
    ("segment", "shisha", "planningcustomer"), ("shisha", "segment", "planningcustomer")
)


def scope_filter(
    fact: DataFrame,
    *,
    business: str | None = None,
    categories: list[str] | None = None,
    channels: list[str] | None = None,
    shishas: list[str] | None = None,
    drivers: list[str] | None = None,
    period: tuple[int, int, int] | None = None,
    months: tuple[int, int] | None = None,
    spends: str | None = None,
    volume: str | None = None,
) -> DataFrame:
    """Rows of one scenario's scope.

    ``period`` is (year, first month, last month); ``months`` a range of month indexes
    (12 * year + month - 1), which may cross a year end. ``spends`` and ``volume`` are
    comparisons such as ``"> 0"``. Only plain columns are compared, so every predicate
    reaches the scan of a stored fact.
    """
    tests = [f"business = {quoted(business)}"] if business is not None else []
    lists = {"category": categories, "channel": channels, "shisha": shishas, "modelingname": drivers}
    tests += [in_list(c, values) for c, values in lists.items() if values is not None]
    if period is not None:
        tests.append("year = {} and month between {} and {}".format(*period))
    if months is not None:
        first, last = months
        tests.append(f"year between {first // 12} and {last // 12} and 12 * year + month - 1 between {first} and {last}")
    tests += [f"{c} {test}" for c, test in (("spends", spends), ("volume", volume)) if test]
    return fact.filter(" and ".join(tests)) if tests else fact


def value_ranks(rows: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Average-tie percentile rank of every distinct value of ``measure`` within its key."""
    bounds = quantile_bounds(rows, measure)
    counts = aggregate(rows, [*keys, measure], {"n": "count(1)"})
    return running_totals(counts, keys, measure, "n", bounds=bounds).selectExpr(
        *keys, measure, f"(n_before + (n + 1) / 2D) / n_total as pct_rank_{measure}"
    )


def pct_rank_avg(rows: DataFrame, keys: list[str], measures: list[str] | None = None) -> DataFrame:
    """Add the average-tie percentile rank of each measure within its key.

    The rows are shuffled once, by key, and sorted there by each measure. Rows of hot keys meet the
    ranks of their values instead. ``rows`` is read several times, so pass a settled table.
    """
    measures = measures or ["spends", "volume"]
    usual, hot = split_hot(rows, keys)
    ranked = usual.selectExpr("*", *[f"{average_rank(keys, m)} as pct_rank_{m}" for m in measures])
    if hot is not None:
        hot = settle(hot)
        more = hot
        for m in measures:
            more = join_keys(more, value_ranks(hot, keys, m), [*keys, m], "left")
        ranked = ranked.unionByName(more)
    return ranked


def _r_squared(n: str, flat_x: str, flat_y: str, r2: str) -> str:
    """Undefined for one row, 1 for a constant response, 0 for a constant spend."""
    return f"case when {n} < 2 then null when {flat_y} then 1D when {flat_x} then 0D else {r2} end"


def loglog_fit(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Least squares of ln(volume) on ln(spends) per key; rows need both above zero.

    A single row or a constant spend has slope 0 and the mean of ln(volume) as intercept.
    """
    points = rows.selectExpr(
        *keys, "spends", "volume", f"{MONTH_START} as sales_month", "ln(spends) as x", "ln(volume) as y"
    )
    fits = aggregate(points, keys, {
        "first_sales_month": "min(sales_month)", "last_sales_month": "max(sales_month)",
        "number_of_rows": "count(1)",
        "total_overall_spends": exact_sum("spends"), "total_overall_volume": exact_sum("volume"),
        "_slope": "regr_slope(y, x)", "_intercept": "regr_intercept(y, x)", "_r2": "regr_r2(y, x)",
        "_mean_y": "avg(y)", "_flat_x": "min(spends) = max(spends)", "_flat_y": "min(volume) = max(volume)",
    })
    return fits.selectExpr(
        *keys, "first_sales_month", "last_sales_month", "number_of_rows",
        "total_overall_spends", "total_overall_volume",
        f"{_r_squared('number_of_rows', '_flat_x', '_flat_y', '_r2')} as r_squared",
        "greatest(case when _flat_x then _mean_y else _intercept end, 0D) as intercept",
        "case when _flat_x then 0D else _slope end as spends_coef",
    )


def _cutoffs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: the values where each percentile threshold starts or ends, and the minima.

    A rank is monotone in its value, so comparing values with these cutoffs selects the
    same rows as comparing ranks with the thresholds.
    """
    values = rows.selectExpr(*keys, "stack(2, 'spends', spends, 'volume', volume) as (measure, value)")
    ranks = value_ranks(values, [*keys, "measure"], "value")
    cuts = {}
    for measure, tag in (("spends", "s"), ("volume", "v")):
        mine = f"filter (where measure = '{measure}'"
        cuts[f"{tag}_min"] = f"min(value) {mine})"
        for i, (high, low) in enumerate(zip(TRIM_HIGH, TRIM_LOW)):
            cuts[f"{tag}_hi{i}"] = f"min(value) {mine} and pct_rank_value >= {high}D)"
            cuts[f"{tag}_lo{i}"] = f"max(value) {mine} and pct_rank_value <= {low}D)"
    return aggregate(ranks, keys, cuts)


def _first_trim(corners: tuple[tuple[str, str], tuple[str, str]], spends: str, volume: str) -> str:
    """First threshold (1-based) with a corner that contains the row, else NEVER.

    ``spends`` and ``volume`` are the tests of the two measures, over ``{side}`` (hi or lo), ``{sign}``,
    ``{i}`` and ``{cut}``.
    """
    def test(template: str, side: str, i: int) -> str:
        cut = (TRIM_HIGH if side == "hi" else TRIM_LOW)[i]
        return template.format(side=side, sign=">=" if side == "hi" else "<=", i=i, cut=f"{cut}D")

    cases = [
        "when " + " or ".join(f"({test(spends, s, i)} and {test(volume, v, i)})" for s, v in corners) + f" then {i + 1}"
        for i in range(len(TRIM_HIGH))
    ]
    return f"case {' '.join(cases)} else {NEVER} end"


OFF_DIAGONAL = (("hi", "lo"), ("lo", "hi"))
DIAGONAL = (("hi", "hi"), ("lo", "lo"))
TOTALS = {
    "n": "sum(n)", "sx": "sum(sx)", "sy": "sum(sy)", "sxx": "sum(sxx)", "sxy": "sum(sxy)", "syy": "sum(syy)",
    "x_lo": "min(x_lo)", "x_hi": "max(x_hi)", "y_lo": "min(y_lo)", "y_hi": "max(y_hi)",
    "x_min": "max(x_min)", "y_min": "max(y_min)",
    "first_sales_month": "min(first_sales_month)", "last_sales_month": "max(last_sales_month)",
    "spent": "sum(spent)", "sold": "sum(sold)",
}
CXX, CXY, CYY = "(sxx - sx * sx / n)", "(sxy - sx * sy / n)", "(syy - sy * sy / n)"
FLAT_X, FLAT_Y = "x_lo = x_hi", "y_lo = y_hi"
SLOPE = f"case when {FLAT_X} then 0D else try_divide({CXY}, {CXX}) end"


def _points(rows: DataFrame, keys: list[str], spends: str, volume: str) -> DataFrame:
    """Shifted logs and trimming classes of rows that know their key's least values."""
    return rows.selectExpr(
        *keys, "spends", "volume", "sales_month",
        "ln(spends) - ln(s_min) as x", "ln(volume) - ln(v_min) as y", "ln(s_min) as x_min", "ln(v_min) as y_min",
        f"{_first_trim(OFF_DIAGONAL, spends, volume)} as less", f"{_first_trim(DIAGONAL, spends, volume)} as more",
    )


def _ranked_points(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Classes by rank: the rows of a key meet in one task, and stay there for its fits."""
    per_key = f"over (partition by {', '.join(keys)})"
    ranked = rows.selectExpr(
        "*", f"{average_rank(keys, 'spends')} as _rank_s", f"{average_rank(keys, 'volume')} as _rank_v",
        f"min(spends) {per_key} as s_min", f"min(volume) {per_key} as v_min",
    )
    return _points(ranked, keys, "_rank_s {sign} {cut}", "_rank_v {sign} {cut}")


def _cut_points(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Classes by value: the rows meet the cutoffs of their key, wherever they are."""
    met = join_keys(rows, _cutoffs(rows, keys), keys)
    return _points(met, keys, "spends {sign} s_{side}{i}", "volume {sign} v_{side}{i}")


def trim_refit(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Log-log fit per key with corner trimming of implausible slopes.

    A slope below 0 drops the two off-diagonal corners, a slope above 1 the two diagonal
    corners, at seven thresholds. The last threshold whose refit lies strictly inside
    (0.1, 0.9) wins; if a threshold leaves no row the original fit is kept.

    The corners are nested, so a row is described by the first threshold that removes it.
    One aggregation keeps moments per class; each refit is a sum over classes. Logs are
    shifted by the key's minimum so the moments do not cancel. ``rows`` is read several times, so
    pass a settled table.
    """
    keyed = rows.selectExpr(*keys, "spends", "volume", f"{MONTH_START} as sales_month")
    usual, hot = split_hot(keyed, keys)
    points = _ranked_points(usual, keys)
    if hot is not None:
        points = points.unionByName(_cut_points(settle(hot), keys))
    classes = aggregate(points, [*keys, "less", "more"], {
        "n": "count(1)", "sx": "sum(x)", "sy": "sum(y)",
        "sxx": "sum(x * x)", "sxy": "sum(x * y)", "syy": "sum(y * y)",
        "x_lo": "min(spends)", "x_hi": "max(spends)", "y_lo": "min(volume)", "y_hi": "max(volume)",
        "x_min": "max(x_min)", "y_min": "max(y_min)",
        "first_sales_month": "min(sales_month)", "last_sales_month": "max(sales_month)",
        "spent": f"sum({ten_thousandths('spends')})", "sold": f"sum({ten_thousandths('volume')})",
    })
    # A key has at most 8 x 8 classes, so its window and its refits stay small.
    per_key = f"over (partition by {', '.join(keys)})"
    whole = {f"_{m}": f"sum({m}) {per_key}" for m in ("n", "sx", "sy", "sxx", "sxy")}
    slope0 = f"""case when min(x_lo) {per_key} = max(x_hi) {per_key} then 0D
        else try_divide(_sxy - _sx * _sy / _n, _sxx - _sx * _sx / _n) end"""
    variants = (
        classes.selectExpr("*", *named(whole)).selectExpr("*", f"{slope0} as slope0")
        .selectExpr("*", "case when slope0 < 0 then -1 when slope0 > 1 then 1 else 0 end as direction")
        .selectExpr("*", f"explode(if(direction = 0, array(0), sequence(0, {NEVER - 1}))) as step")
        .filter("step = 0 or if(direction < 0, less, more) > step")
    )
    fits = aggregate(variants, [*keys, "direction", "step"], TOTALS).selectExpr("*", f"{SLOPE} as _slope").selectExpr(
        "*", f"{round_dp('_slope', 6)} as spends_coef",
        f"{round_dp('greatest(y_min + sy / n - _slope * (x_min + sx / n), 0D)', 6)} as intercept",
        f"{round_dp(_r_squared('n', FLAT_X, FLAT_Y, f'try_divide({CXY} * {CXY}, {CXX} * {CYY})'), 6)} as r_squared",
    )
    fit = "struct(step, n, r_squared, intercept, spends_coef)"
    accepted = f"(where step > 0 and spends_coef > {SLOPE_LOW}D and spends_coef < {SLOPE_HIGH}D)"
    kept = ["first_sales_month", "last_sales_month", "spent", "sold"]
    picked = aggregate(fits, keys, {
        "original": f"max({fit}) filter (where step = 0)",
        "refit": f"max_by({fit}, step) filter {accepted}",
        "last_step": "max(step)", "direction": "max(direction)",
        **{c: f"max({c}) filter (where step = 0)" for c in kept},
    })
    chosen = f"if(last_step < {NEVER - 1}, original, coalesce(refit, original))"
    return picked.selectExpr("*", f"{chosen} as fit").selectExpr(
        *keys, "first_sales_month", "last_sales_month", "original.n as number_of_rows",
        "fit.n as number_of_rows_after_perct_rank",
        "cast(spent as double) / 10000D as total_overall_spends",
        "cast(sold as double) / 10000D as total_overall_volume",
        f"{_model_type()} as model_type", "fit.r_squared", "fit.intercept", "fit.spends_coef",
    )


def _model_type() -> str:
    cases = []
    for i, (hi, lo) in enumerate(zip(TRIM_HIGH, TRIM_LOW), start=1):
        cases.append(f"when fit.step = {i} and direction < 0 then 'augmented_less[({hi}, {lo}), ({lo}, {hi})]'")
        cases.append(f"when fit.step = {i} and direction > 0 then 'augmented_more[({hi}, {hi}), ({lo}, {lo})]'")
    return f"case {' '.join(cases)} else 'Original' end"


def _level(keys: list[str]) -> str:
    return "+".join(keys)


def level_rows(rows: DataFrame, *models: FitLevels, by: list[str] = ()) -> DataFrame:
    """Each row once per distinct fit level of the models, absent key columns shown as ``*``."""
    columns = list(max((m.keys for m in models), key=len))
    wanted = dict.fromkeys(
        tuple(k for k in m.keys if k != drop) for m in models for drop in (None, *m.drops)
    )
    tagged = ", ".join(
        f"'{_level(kept)}', " + ", ".join(c if c in kept else f"'{ALL}'" for c in columns) for kept in wanted
    )
    stacked = f"stack({len(wanted)}, {tagged}) as (level, {', '.join('_' + c for c in columns)})"
    rest = [*by, "year", "month", "spends", "volume"]
    return rows.selectExpr(stacked, *rest).selectExpr("level", *[f"_{c} as {c}" for c in columns], *rest)


def fit_levels(rows: DataFrame, *models: FitLevels, by: list[str] = ()) -> DataFrame:
    """Trimmed fits of every level of the models, in one job; shared levels are fitted once.

    ``by`` are further key columns, such as a scenario, that every level keeps.
    """
    columns = list(max((m.keys for m in models), key=len))
    return trim_refit(level_rows(rows, *models, by=by), ["level", *by, *columns])


def hierarchical_fallback(fits: DataFrame, levels: FitLevels, by: list[str] = ()) -> DataFrame:
    """Replace slopes outside [0.1, 0.9] by the slope of each coarser level in turn.

    ``fits`` is read once per level, so pass a settled table.
    """
    keys = list(levels.keys)
    base = fits.filter(f"level = '{_level(keys)}'")
    columns = [*by, *keys, *base.columns[base.columns.index("first_sales_month"):]]
    model = base.select(*columns)
    inside = f"coalesce(spends_coef between {SLOPE_LOW}D and {SLOPE_HIGH}D, false)"
    for drop in levels.drops:
        kept = [k for k in keys if k != drop]
        coarse = fits.filter(f"level = '{_level(kept)}'").selectExpr(*by, *kept, "spends_coef as _coarse")
        model = with_exprs(join_keys(model, coarse, [*by, *kept], "left"), {
            "spends_coef": f"if({inside}, spends_coef, _coarse)",
            "model_type": f"if({inside}, model_type, 'Without_{drop.upper()}_Level_Model_Augmented')",
        }).select(*columns)
    return model


def zero_response_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Coefficient rows of zeros for keys that spent without selling."""
    counted = aggregate(rows.filter("spends > 0 and volume = 0"), keys, {
        "number_of_rows": "count(1)", "total_overall_spends": exact_sum("spends"),
        "total_overall_volume": exact_sum("volume"),
    })
    return counted.selectExpr(
        *keys, "'' as first_sales_month", "'' as last_sales_month", "number_of_rows",
        "0L as number_of_rows_after_perct_rank", "total_overall_spends", "total_overall_volume",
        f"'{ZERO_RESPONSE}' as model_type", "0D as r_squared", "0D as intercept", "0D as spends_coef",
    )


def consolidate_models(models: DataFrame, zero_rows: DataFrame, keys: list[str]) -> DataFrame:
    """One coefficient row per key: numbers add up, model types are listed in order."""
    counted = ["number_of_rows", "number_of_rows_after_perct_rank"]
    return aggregate(models.unionByName(zero_rows), keys, {
        "first_sales_month": "max(first_sales_month)", "last_sales_month": "max(last_sales_month)",
        **{c: f"sum({c})" for c in counted},
        **{c: exact_sum(c) for c in ("total_overall_spends", "total_overall_volume")},
        "model_type": "sort_array(collect_list(model_type))",
        **{c: exact_sum(c, 6) for c in ("r_squared", "intercept", "spends_coef")},
    })


def response_models(rows: DataFrame, *models: FitLevels, by: list[str] = ()) -> list[DataFrame]:
    """Coefficients per key of one scope, per model: fits, fallback and zero-response keys.

    All levels of all models are fitted in one job, and all scopes that ``by`` tells apart. ``rows``
    (spend above zero) is read several times, so pass a settled table.
    """
    fits = settle(fit_levels(rows.filter("spends > 0 and volume > 0"), *models, by=by))
    out = []
    for m in models:
        keys = [*by, *m.keys]
        out.append(consolidate_models(hierarchical_fallback(fits, m, by), zero_response_keys(rows, keys), keys))
    return out


def response_model(rows: DataFrame, levels: FitLevels) -> DataFrame:
    return response_models(rows, levels)[0]


def attach_dimensions(coefficients: DataFrame, fact: DataFrame, by: list[str] = ()) -> DataFrame:
    """Add the fact's distinct dimensions; a key with several dimension rows fans out."""
    dims = fact.select(*by, *S.DIMENSIONS).distinct()
    return join_keys(coefficients, dims, [*by, "segment", "shisha", "planningcustomer"], "left")
