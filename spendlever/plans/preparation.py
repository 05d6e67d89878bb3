"""Batch preparation: the chain of stage tables that scenarios read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from spendlever import schemas as S
from spendlever.functions.expr import in_list
from spendlever.functions.lineage import settle
from spendlever.operators import branch as B, prep as P
from spendlever.sources.tables import read_catalog, write_catalog

Save = Callable[[str, DataFrame], DataFrame]


def settle_stage(name: str, df: DataFrame) -> DataFrame:
    """Keep a stage in the session's shared folder."""
    return settle(df, keep=True)


def catalog_stage(database: str) -> Save:
    """Keep every stage as a catalog table of ``database``."""
    def save(name: str, df: DataFrame) -> DataFrame:
        write_catalog(df, database, name)
        return read_catalog(df.sparkSession, database, name)

    return save


def prepare(
    decomposition: DataFrame,
    actuals: DataFrame,
    price_changes: DataFrame,
    branch_feeds: list[DataFrame],
    customers: DataFrame,
    save: Save = settle_stage,
) -> dict[str, DataFrame]:
    """Rescale, reprice and re-attribute the decomposition; one write per stage."""
    scaled = save("rescaled", P.rescale_to_actuals(
        P.contribution_share(decomposition), P.actuals_rollup(actuals)
    ))
    repriced = save("repriced", P.price_change_passthrough(
        scaled, price_changes, P.driver_share_pct(decomposition)
    ))
    branch = save("branch_money", P.branch_money_split(branch_feeds, customers))
    updated = save("reattributed", B.assemble_fact(
        repriced, B.reallocate_branches(repriced, branch)
    ))
    return {
        "rescaled": scaled,
        "repriced": repriced,
        "branch_money": branch,
        "reattributed": updated,
        "decomp_view": save("decomp_view", P.decomp_view(updated, decomposition)),
        "history": save("history", P.history_baseline(scaled, decomposition)),
    }


def check_reallocation(repriced: DataFrame, updated: DataFrame, keys: list[str]) -> DataFrame:
    """Spend-type totals before and after the branch re-attribution."""
    spend = in_list("modelingname", S.SPEND_TYPES)
    return P.reconcile_totals(repriced.filter(spend), updated.filter(spend), keys)
