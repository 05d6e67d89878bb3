"""Final output, publication, ledger and comparison with actuals."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from spendlever import schemas as S
from spendlever.functions.expr import (
    aggregate, change, exact_avg, exact_sum, in_list, join_keys, named, quoted, ratio, round_dp, with_exprs,
    zero_if_null,
)
from spendlever.sources.star import BUDGET_SPEND, KEEP_SPEND

LY = "last_year_period_"
MONTH_OF_DATE = "12 * year(to_date(substring(date, 1, 10))) + month(to_date(substring(date, 1, 10))) - 1"
HISTORY = "HISTORICAL_DATA"


@dataclass(frozen=True)
class Scenario:
    """Scope of one scenario; ``year`` and months are those of the planned period.

    ``year`` is that of the last month; ``start_year``, if the period crosses a year end, that of the first.
    """

    name: str
    business: str
    spend_type: str
    year: int
    first_month: int
    last_month: int
    categories: list[str] | None = None
    channels: list[str] | None = None
    shishas: list[str] | None = None
    strategy: str = "2"
    sub_strategy: str | None = None
    goal_spend: float | None = None
    start_year: int | None = None
    last_year: int = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "last_year", self.year - 1)
        object.__setattr__(self, "start_year", self.year if self.start_year is None else self.start_year)

    @property
    def last_year_period(self) -> tuple[int, int, int]:
        if self.start_year != self.year:
            raise ValueError(f"scenario {self.name}: the period crosses a year end, use last_year_months")
        return self.last_year, self.first_month, self.last_month

    @property
    def months(self) -> tuple[int, int]:
        """Month indexes (12 * year + month - 1) of the planned period."""
        return 12 * self.start_year + self.first_month - 1, 12 * self.year + self.last_month - 1

    @property
    def last_year_months(self) -> tuple[int, int]:
        first, last = self.months
        return first - 12, last - 12


def scenario_params(requests: DataFrame, uid: str | None = None) -> DataFrame:
    """Parse request documents and map the objective text to a strategy."""
    if uid is not None:
        requests = requests.filter(f"uid = {quoted(uid)}")
    keep, budget = quoted(KEEP_SPEND), quoted(BUDGET_SPEND)
    parsed = requests.selectExpr("uid", f"from_json(parameters, {quoted(S.REQUEST)}) as d").distinct()
    return parsed.selectExpr(
        "uid", "d.scenarioPrameters.scenarioName as scenario_name", "d.optimizationInput.*"
    ).selectExpr(
        "uid", "scenario_name", "replace(scenario_name, ' ', '') as table_suffix", "business",
        "spendtype as spend_type", "channel", "category", "shisha",
        "min as period_start", "max as period_end",
        f"case optimizationobjective when {keep} then '2' when {budget} then '3' end as strategy",
        f"case when optimizationobjective = {budget} then '1' end as sub_strategy",
        f"case when optimizationobjective = {budget} then budget end as goal_spend",
    )


def scenario_from_row(row) -> Scenario:
    """Scenario of one parsed request row (see ``scenario_params``).

    A request whose objective is not understood, or whose period ends before it starts, is an error.
    """
    if row["strategy"] is None:
        raise ValueError(f"request {row['uid']}: unknown optimisation objective")
    if row["period_start"][:10] > row["period_end"][:10]:
        raise ValueError(f"request {row['uid']}: the period ends before it starts")
    return Scenario(
        name=row["scenario_name"], business=row["business"], spend_type=row["spend_type"],
        year=int(row["period_end"][:4]), first_month=int(row["period_start"][5:7]),
        last_month=int(row["period_end"][5:7]), start_year=int(row["period_start"][:4]),
        **{name: None if row[c] is None else list(row[c])
           for name, c in (("categories", "category"), ("channels", "channel"), ("shishas", "shisha"))},
        strategy=row["strategy"], sub_strategy=row["sub_strategy"], goal_spend=row["goal_spend"],
    )


def last_year_period(params: DataFrame) -> DataFrame:
    """First days of the planned months in the year before, newest first.

    A period that ends before it starts gives one row without a month.
    """
    first, last = (
        f"make_date(cast(substring({c}, 1, 4) as int) - 1, cast(substring({c}, 6, 2) as int), 1)"
        for c in ("period_start", "period_end")
    )
    months = f"if({first} <= {last}, sequence({last}, {first}, interval -1 month), null)"
    return (
        params.selectExpr("uid", "scenario_name", f"posexplode_outer({months}) as (position, day)")
        .selectExpr("uid", "scenario_name", "position", "cast(day as string) as month_start")
    )


# --- final output ----------------------------------------------------------------------


def scenario_period_actuals(scope: DataFrame, scenario: str, date_text: str) -> DataFrame:
    """Scope totals per dimensions and driver, tagged with the scenario and its end date.

    ``ec_per_qtycase`` is the plain sum of unit costs; ``ec_per_case`` the weighted one.
    """
    sums = aggregate(scope, [*S.DIMENSIONS, "modelingname"], {
        **{m: exact_sum(m) for m in (*S.MEASURES, "ec", "mc")},
        "ec_per_qtycase": exact_sum("ec_per_qtycase", 9), "price": exact_avg("price"),
    })
    return sums.selectExpr(
        "*", f"{ratio('ec', 'volume')} as ec_per_case",
        f"{quoted(scenario)} as scenario_name", f"{quoted(date_text)} as date",
    )


def scenario_output_projection(
    reworked: DataFrame, scenario: str, spend_type: str, date_text: str
) -> DataFrame:
    """Reworked scenario rows in published column names."""
    published = {
        "spends": "optimized_spends", "gps": "optimized_gps_adj", "netsales": "optimized_netsales_adj",
        "volume": "optimized_volume", "mc": "mc_new",
    }
    tags = {"modelingname": spend_type, "scenario_name": scenario, "date": date_text}
    return reworked.selectExpr(
        *S.DIMENSIONS, *named(published), *[f"{LY}{m}_old" for m in S.MEASURES],
        "spend_change", "vol_change", "ns_change", "price", "ec", "ec_per_qtycase",
    ).distinct().selectExpr("*", *named({c: quoted(v) for c, v in tags.items()}))


def baseline_overlay(output: DataFrame, other_drivers: DataFrame, by: list[str] = ()) -> DataFrame:
    """Add the baseline volume of the other drivers and the final totals and changes.

    ``other_drivers`` are the in-scope rows of the period for every driver but the
    scenario's. Missing values and undefined changes become 0.
    """
    key = [*by, "segment", "shisha", "planningcustomer"]
    baseline = aggregate(other_drivers, key, {"baseline_volume": exact_sum("volume")})
    old = {m: f"{LY}{m}_old" for m in S.MEASURES}
    new = {m: f"optimized_{m}" for m in S.MEASURES}

    def absolute_change(after: str, before: str) -> str:
        return zero_if_null(ratio(f"{after} - {before}", f"abs({before})"))

    def at_unit_gps(volume: str) -> str:
        return zero_if_null(ratio(f"{volume} * {old['gps']}", old["volume"]))

    both = (
        join_keys(output.drop("spend_change", "vol_change", "ns_change", "netsales_change"), baseline, key, "left")
        .fillna(0.0, [*old.values(), *new.values(), "baseline_volume"])
    )
    layers = [
        {
            "spend_change": zero_if_null(change(new["spends"], old["spends"])),
            "volume_change": zero_if_null(change(new["volume"], old["volume"])),
            "gps_change": zero_if_null(change(new["gps"], old["gps"])),
            "netsales_change": absolute_change(new["netsales"], old["netsales"]),
            "total_initial_spend": old["spends"],
            "total_initial_volume": f"{old['volume']} + baseline_volume",
            "total_optimized_spend": new["spends"],
            "total_optimized_volume": f"{new['volume']} + baseline_volume",
        },
        {f"total_{s}_gps": at_unit_gps(f"total_{s}_volume") for s in ("initial", "optimized")},
        {f"total_{s}_netsales": f"total_{s}_gps - total_{s}_spend" for s in ("initial", "optimized")},
        {
            **{
                f"final_{m}_change": zero_if_null(ratio(f"total_optimized_{m}", f"total_initial_{m}") + " - 1")
                for m in ("spend", "volume", "gps")
            },
            "final_netsales_change": absolute_change("total_optimized_netsales", "total_initial_netsales"),
        },
    ]
    for layer in layers:
        both = both.selectExpr("*", *named(layer))
    return both


# --- publication -----------------------------------------------------------------------


def publish_history(existing: DataFrame, history: DataFrame) -> DataFrame:
    """Replace history rows; every other row stops being the latest; pad missing columns."""
    others = with_exprs(existing.filter(f"scenario_name != '{HISTORY}'"), {"is_latest": "0"})
    return others.unionByName(history, allowMissingColumns=True)


def publish_scenario(existing: DataFrame, final: DataFrame, scenario: Scenario) -> DataFrame:
    """Replace the scenario's rows and retire overlapping rows of other scenarios."""
    lists = {
        "business": [scenario.business], "modelingname": [scenario.spend_type],
        "category": scenario.categories, "shisha": scenario.shishas, "channel": scenario.channels,
    }
    overlap = " and ".join([
        *[in_list(c, values) for c, values in lists.items() if values is not None],
        f"{MONTH_OF_DATE} between {scenario.months[0]} and {scenario.months[1]}",
    ])
    others = with_exprs(
        existing.filter(f"scenario_name != {quoted(scenario.name)}"),
        {"is_latest": f"case when {overlap} then 0 else is_latest end"},
    )
    types = dict(final.dtypes)
    is_list = types.get("modelingname", "").startswith("array")
    label = "modelingname" if "modelingname" in types else quoted(scenario.spend_type)
    end = f"last_day(make_date({scenario.year}, {scenario.last_month}, 1))"
    tagged = with_exprs(final, {
        "modelingname": "concat_ws(',', modelingname)" if is_list else label,
        "scenario_name": quoted(scenario.name), "is_latest": "1",
        "date": f"concat(cast({end} as string), ' 23:59:59')",
        "year": str(scenario.year), "month": str(scenario.last_month),
        "half_year": "'H1'" if scenario.last_month <= 6 else "'H2'",
    })
    return others.unionByName(tagged.distinct(), allowMissingColumns=True)


def load_check(written: DataFrame, published: DataFrame, scenario: str) -> DataFrame:
    """One row: distinct rows written, rows read back for the scenario, and whether they agree."""
    sent = written.distinct().selectExpr("1L as sent", "0L as loaded")
    read = published.filter(f"scenario_name = {quoted(scenario)}").selectExpr("0L as sent", "1L as loaded")
    counts = aggregate(sent.unionByName(read), [], {
        "rows_written": "coalesce(sum(sent), 0L)", "rows_loaded": "coalesce(sum(loaded), 0L)",
    })
    return counts.selectExpr(
        f"{quoted(scenario)} as scenario_name", "*", "rows_written = rows_loaded as loaded"
    )


RUNNING, DONE, FAILED = 0, 1, 2


def status_upsert(ledger: DataFrame, reports: DataFrame) -> DataFrame:
    """Ledger with the reported scenarios replaced by their newest report."""
    kept = ledger.join(reports.select("scenarioname").distinct(), "scenarioname", "left_anti")
    newest = latest_status(reports).select(*[f.name for f in S.LEDGER.fields])
    return kept.unionByName(newest, allowMissingColumns=True)


def latest_status(reports: DataFrame) -> DataFrame:
    """Newest report per scenario from an append-only log; partial sums before the shuffle."""
    row = "struct(isoptimizationexecutioncompleted, progressmessage, reported_at, report_no)"
    newest = aggregate(reports, ["scenarioname"], {"r": f"max_by({row}, struct(reported_at, report_no))"})
    return newest.selectExpr("scenarioname", "r.*")


def compacted_log(log: DataFrame) -> DataFrame:
    """An append-only log of reports with one report, the newest, per scenario."""
    return latest_status(log).select(*log.columns)


def status_view(log: DataFrame) -> DataFrame:
    """The ledger that an append-only log of reports shows."""
    return latest_status(log).select(*[f.name for f in S.LEDGER.fields])


# --- comparison with actuals -----------------------------------------------------------

MATCH_KEY = [*S.DIMENSIONS, "modelingname"]


def missing_keys_backfill(output: DataFrame, actuals: DataFrame) -> DataFrame:
    """Output rows plus the actual rows that have no output row."""
    absent = join_keys(actuals, output.select(*MATCH_KEY).distinct(), MATCH_KEY, "left_anti")
    return output.unionByName(absent, allowMissingColumns=True)


def key_semi_filter(output: DataFrame, actuals: DataFrame) -> DataFrame:
    """Output rows whose segment, branch office and customer occur in the actuals."""
    key = ["segment", "shisha", "planningcustomer"]
    return join_keys(output, actuals.select(*key).distinct(), key, "left_semi")


def _with_actuals(output: DataFrame, actuals: DataFrame) -> DataFrame:
    renamed = actuals.selectExpr(*MATCH_KEY, *[f"{m} as decomp_{m}" for m in S.MEASURES])
    return join_keys(output, renamed, MATCH_KEY, "left")


def match_flags(output: DataFrame, actuals: DataFrame) -> DataFrame:
    """Per measure, 1 where last year's value equals the actual at whole units, else 0."""
    return _with_actuals(output, actuals).selectExpr("*", *named({
        f"{m}_match": f"if({round_dp(f'{LY}{m}_old', 0)} = {round_dp(f'decomp_{m}', 0)}, 1, 0)" for m in S.MEASURES
    }))


def factor_align(output: DataFrame, actuals: DataFrame) -> DataFrame:
    """Scale output and last-year values by the ratio of actuals to last-year values."""
    factors = {f"{m}_factor": ratio(f"decomp_{m}", f"{LY}{m}_old") for m in S.MEASURES}
    factors["netsales_calc_factor"] = ratio("decomp_netsales", "decomp_gps - decomp_spends")
    joined = _with_actuals(output, actuals).selectExpr("*", *named(factors))
    return with_exprs(joined, {
        **{m: f"{m} * {m}_factor" for m in ("spends", "gps", "volume")},
        **{f"{LY}{m}_old_calc": f"{LY}{m}_old * {m}_factor" for m in S.MEASURES},
        "netsales": "(gps * gps_factor - spends * spends_factor) * netsales_calc_factor",
    })
