"""One scenario: fit, allocate in two stages, guard, overlay and publish."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame, SparkSession

from spendlever import schemas as S
from spendlever.functions.expr import in_list, quoted
from spendlever.functions.lineage import settle, stage_scope
from spendlever.operators import allocate as A, branch as B, publish as U, response as R, scenarios as N
from spendlever.plans.preparation import Save, settle_stage
from spendlever.sources.tables import VersionedTable, read_catalog, replace_catalog, replace_partitions, write_catalog

Report = Callable[[int, float], None]
STRATEGIES = ("2", "3")


def catalog_ledger(spark: SparkSession, database: str, table: str, scenario: str) -> Report:
    """Progress reports that replace the scenario's row in a catalog ledger."""
    def report(state: int, progress: float) -> None:
        row = spark.createDataFrame([(scenario, state, progress)], S.LEDGER).selectExpr(
            "*", "current_timestamp() as reported_at", "0L as report_no")
        replace_catalog(U.status_upsert(read_catalog(spark, database, table), row), database, table)

    return report


def append_ledger(spark: SparkSession, database: str, log: str, scenario: str) -> Report:
    """Progress reports appended to a catalog log: one small row each, nothing is read or rewritten."""
    numbers = count()

    def report(state: int, progress: float) -> None:
        row = spark.createDataFrame([(scenario, state, progress)], S.LEDGER).selectExpr(
            "*", "current_timestamp() as reported_at", f"{next(numbers)}L as report_no")
        write_catalog(row, database, log, mode="append")

    return report


def ledger_status(spark: SparkSession, database: str, log: str) -> DataFrame:
    """Newest report of every scenario in an append-only log."""
    return U.status_view(read_catalog(spark, database, log))


def compact_ledger(spark: SparkSession, database: str, log: str) -> None:
    """Rewrite a log to one report per scenario; run it when no report is being appended."""
    replace_catalog(U.compacted_log(read_catalog(spark, database, log)), database, log)


def publish_versioned(final: DataFrame, scenario: U.Scenario, database: str, table: str) -> DataFrame:
    """Replace the scenario's rows in a versioned table, and return the published view.

    The years that hold the scenario's rows or overlap its period are written as a new version. Readers
    go on seeing the old versions until the new one has been read back and counted; one replacement
    of the view then switches all its years. A version that doesn't match is dropped and never seen.
    """
    published = VersionedTable(final.sparkSession, database, table)
    view = published.read()
    mine = view.filter(f"scenario_name = {quoted(scenario.name)}").select("year").distinct()
    years = {*range(scenario.start_year, scenario.year + 1), *(row["year"] for row in mine.collect())}  # one row per year
    touched = view.filter(f"year in ({', '.join(map(str, sorted(years)))})")
    new = settle(U.publish_scenario(touched, final, scenario))

    def loaded(version: DataFrame) -> bool:
        return U.load_check(final, version, scenario.name).first()["loaded"] and version.count() == new.count()

    published.replace(new, "year", years, loaded)
    return published.read()


def publish_in_place(final: DataFrame, scenario: U.Scenario, database: str, table: str) -> None:
    """Replace the scenario's rows in a catalog table partitioned by year.

    Only the years that hold the scenario's rows, old or new, are rewritten; a rerun
    leaves the same table.
    """
    published = read_catalog(final.sparkSession, database, table)
    mine = published.filter(f"scenario_name = {quoted(scenario.name)}").select("year").distinct()
    years = {*range(scenario.start_year, scenario.year + 1), *(row["year"] for row in mine.collect())}  # one row per year
    touched = published.filter(f"year in ({', '.join(map(str, sorted(years)))})")
    replace_partitions(settle(U.publish_scenario(touched, final, scenario)), database, table, "year", years)


def run_scenario(scenario: U.Scenario, opt_input: DataFrame, *inputs: DataFrame, **how) -> dict[str, DataFrame]:
    """``scenario_stages``; what the stages settle between them is deleted at the end, what they return is kept."""
    with stage_scope(opt_input.sparkSession):
        return scenario_stages(scenario, opt_input, *inputs, **how)


def scenario_stages(
    scenario: U.Scenario,
    opt_input: DataFrame,
    repriced: DataFrame,
    decomposition: DataFrame,
    actuals: DataFrame,
    branch: DataFrame,
    published: DataFrame,
    save: Save = settle_stage,
    report: Report = lambda state, progress: None,
    publish: Callable[[DataFrame, U.Scenario], DataFrame | None] | None = None,
    allow_broken_goal: bool = False,
) -> dict[str, DataFrame]:
    """Run every stage of one scenario and return its tables.

    ``report`` receives (state, progress) after each stage; a failure is reported and
    raised, never swallowed. ``publish`` receives the final rows, for instance to write them in
    place; the table it returns is the published one, which ``output`` and ``load_check`` read. A goal that the items' bounds can't meet is an error, unless it is allowed; groups
    of the second stage whose band can't be met are returned as ``infeasible``.
    """
    if scenario.strategy not in STRATEGIES:
        raise ValueError(f"scenario {scenario.name}: unknown strategy {scenario.strategy!r}")
    progress = 0.0
    scope = {
        "business": scenario.business, "categories": scenario.categories,
        "channels": scenario.channels, "shishas": scenario.shishas,
    }
    mine = {**scope, "drivers": [scenario.spend_type]}
    months = scenario.last_year_months
    first, last = months
    spent = {"spends": "> 0", "volume": ">= 0"}

    def done(stage: str, df: DataFrame, share: float) -> DataFrame:
        nonlocal progress
        stored = save(f"{stage}_{scenario.name.replace(' ', '')}", df)
        progress = share
        report(U.RUNNING, progress)
        return stored

    try:
        rows = done("fit_rows", R.scope_filter(repriced, **mine, **spent), 0.02)
        base = done("base_rows", R.scope_filter(opt_input, **mine, **spent, months=months), 0.04)
        models = R.response_models(rows, R.STAGE1, R.STAGE2)
        coarse = done("coarse_models", models[0], 0.12)
        fine = done("fine_models", R.attach_dimensions(models[1], rows), 0.26)
        goal = scenario.goal_spend if scenario.strategy == "3" else None
        stage1 = done("customer_plan", A.optimise_stage1(A.stage1_baseline(base, coarse), goal), 0.46)
        if goal is not None and not allow_broken_goal and not stage1.filter("not feasible").isEmpty():
            raise ValueError(f"scenario {scenario.name}: the items' bounds can't meet the goal {goal}")
        cost = A.cost_per_case(actuals, range(first // 12, last // 12 + 1), [scenario.spend_type.lower()])
        pushed = A.pushdown_stage1(fine, A.stage2_old(base), stage1, cost)
        stage2 = done("segment_plan", A.optimise_stage2(pushed), 0.60)
        labelled = stage2.selectExpr("*", f"'{scenario.spend_type}' as modelingname")
        reworked = done("reattributed_plan", B.branch_rework_output(
            labelled, branch, f"12 * year + month - 1 between {first} and {last}"
        ), 0.76)
        others = R.scope_filter(decomposition, **scope, months=months).filter(
            "not " + in_list("modelingname", [*S.TOTAL_ROWS, scenario.spend_type])
        )
        final = done("final_plan", U.baseline_overlay(A.guardrail_revert(labelled), others), 0.88)
        output = None if publish is None else publish(final, scenario)
        if output is None:  # nothing to read back: the rows that would be published
            output = U.publish_scenario(published, final, scenario)
    except Exception:
        report(U.FAILED, progress)
        raise
    report(U.DONE, 1.0)
    return {
        "coefficients_stage1": coarse, "coefficients_stage2": fine, "stage1": stage1, "stage2": stage2,
        "infeasible": A.infeasible_groups(stage2), "reworked": reworked, "final": final, "output": output,
        "load_check": U.load_check(final, output, scenario.name),
        "summary": A.stage_summary(stage2, "_old"),
    }


def run_batch(
    scenarios: DataFrame,
    opt_input: DataFrame,
    repriced: DataFrame,
    decomposition: DataFrame,
    actuals: DataFrame,
    save: Save = settle_stage,
    policies: list[str] | None = A.POLICIES,
) -> dict[str, DataFrame]:
    """Fit, allocate, guard and overlay all scenarios (``scenarios.valid_scenarios``) in one plan.

    Every table carries ``scenario_name``; a goal that can't be met is flagged in ``feasible``. By default the
    best of all allocation policies is chosen per scenario, and per customer in the second stage.
    """
    with stage_scope(scenarios.sparkSession):
        return _batch(scenarios, opt_input, repriced, decomposition, actuals, save, policies)


def _batch(scenarios, opt_input, repriced, decomposition, actuals, save, policies) -> dict[str, DataFrame]:
    by = N.BY
    scenarios = save("batch_scenarios", scenarios)
    rows = save("batch_fit_rows", N.scope_rows(repriced, scenarios))
    base = save("batch_base_rows", N.period_rows(N.scope_rows(opt_input, scenarios), scenarios))
    coarse, fine = R.response_models(rows, R.STAGE1, R.STAGE2, by=["scope_id"])
    coarse = N.per_scenario(coarse, scenarios)
    fine = N.per_scenario(R.attach_dimensions(fine, rows, by=["scope_id"]), scenarios)
    goals = scenarios.filter("strategy = '3'").select(*by, "goal_spend")
    stage1 = save("batch_customer_plan", A.optimise_stage1(
        A.stage1_baseline(base, coarse, by), policies=policies, by=by, goals=goals))
    pushed = A.pushdown_stage1(fine, A.stage2_old(base, by), stage1, N.cost_per_case(actuals, scenarios), by)
    stage2 = save("batch_segment_plan", A.optimise_stage2(pushed, policies, by))
    guarded = A.guardrail_revert(N.labelled(stage2, scenarios))
    final = save("batch_final_plan", U.baseline_overlay(guarded, N.other_driver_rows(decomposition, scenarios), by))
    return {
        "scenarios": scenarios, "stage1": stage1, "stage2": stage2, "final": final,
        "infeasible": A.infeasible_groups(stage2, [*by, *A.STAGE1_KEY]),
        "summary": A.stage_summary(stage2, "_old", by),
    }


def run_requests(requests: DataFrame, *inputs: DataFrame, **how) -> dict[str, DataFrame]:
    """Run every valid request in one plan; ``refused`` lists the others. ``inputs`` and ``how`` as in ``run_batch``."""
    judged = settle(N.judged_requests(requests), keep=True)
    return {"refused": N.refused_requests(judged), **run_batch(N.valid_scenarios(judged), *inputs, **how)}


def run_request(requests: DataFrame, uid: str, *inputs: DataFrame, **how) -> dict[str, DataFrame]:
    """Run the scenario of one request document; ``inputs`` and ``how`` as in ``run_scenario``."""
    rows = U.scenario_params(requests, uid).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{len(rows)} requests have the id {uid}")
    return run_scenario(U.scenario_from_row(rows[0]), *inputs, **how)
