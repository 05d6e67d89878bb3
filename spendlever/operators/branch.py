"""Head-office/branch re-attribution of spend."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spendlever import schemas as S
from spendlever.functions.expr import (
    KEY_HASH, aggregate, any_nonzero, change, exact_avg, exact_sum, hashed, in_list, join_keys, named, quoted, ratio0,
    round_dp, with_exprs, zero_if_null,
)
from spendlever.functions.lineage import settle

INI, ADD = "INI", "ADD"
IS_SPEND = in_list("modelingname", S.SPEND_TYPES)


def branch_sums(branch: DataFrame, keys: list[str]) -> DataFrame:
    """Initial and additional money of each spend type per key and old customer."""
    return aggregate(
        branch.withColumnsRenamed({"new_planningcustomer": "planningcustomer", "shishanm": "shisha"}),
        [*keys, "old_planningcustomer"],
        {f"{k}_{t.lower()}": exact_sum(f"{k}_{t.lower()}") for t in S.SPEND_TYPES for k in ("ini", "add")},
    )


def branch_totals(branch: DataFrame, keys: list[str]) -> DataFrame:
    """Initial and additional money per key, old customer and spend type."""
    typed = ", ".join(f"'{t}', ini_{t.lower()}, add_{t.lower()}" for t in S.SPEND_TYPES)
    return branch_sums(branch, keys).selectExpr(
        *keys, "old_planningcustomer", f"stack({len(S.SPEND_TYPES)}, {typed}) as (modelingname, ini_money, add_money)"
    )


def key_shares(branch: DataFrame, keys: list[str] = S.KEY5) -> DataFrame:
    """Initial and additional share of every old customer of a key and spend type."""
    return branch_totals(branch, keys).selectExpr(
        *keys, "modelingname", "old_planningcustomer", *named(_shares("ini_money", "add_money")))


def _shares(ini: str, add: str) -> dict[str, str]:
    total = f"({ini} + {add})"
    return {"ini_contri": ratio0(ini, total, 3), "add_contri": ratio0(add, total, 3)}


def branch_share(branch: DataFrame, spend_rows: DataFrame, keys: list[str] = S.KEY5) -> DataFrame:
    """Spend rows with the initial/additional share of every old customer of their key.

    All three spend types go through one plan: the money of all types meets the rows of its key once,
    and each row takes that of its own type. Rows without any branch match keep null shares.
    """
    money = [f"{k}_{t.lower()}" for k in ("ini", "add") for t in S.SPEND_TYPES]
    sums = branch_sums(branch, keys).selectExpr(
        *keys, "old_planningcustomer", *[f"{m} as _{m}" for m in money], "true as _spend", "true as _met")
    rows = with_exprs(spend_rows, {"_spend": f"if({IS_SPEND}, true, null)"})
    own = {k: f"case modelingname {' '.join(f'when {quoted(t)} then _{k}_{t.lower()}' for t in S.SPEND_TYPES)} end" for k in ("ini", "add")}
    met = with_exprs(join_keys(rows, sums, [*keys, "_spend"], "left"), {f"_{k}": x for k, x in own.items()})
    shares = {name: f"if(_met, {share}, null)" for name, share in _shares("_ini", "_add").items()}
    return met.selectExpr(*[f"`{c}`" for c in spend_rows.columns], "old_planningcustomer", *named(shares))


def nonzero_spend_rows(fact: DataFrame) -> DataFrame:
    return fact.filter(f"{IS_SPEND} and {any_nonzero(S.MEASURES)}")


def unpivot_shares(shared: DataFrame) -> DataFrame:
    """One row per (spend row, old customer, INI/ADD) with its share."""
    ids = [f"`{c}`" for c in shared.columns if c not in ("ini_contri", "add_contri")]
    # `unpivot` would forget how a bucketed table is laid out.
    return shared.selectExpr(*ids, f"stack(2, '{INI}', ini_contri, '{ADD}', add_contri) as (contri_type, contri_val)")


def share_weights(pairs: DataFrame, keys: list[str], conserve: bool = True) -> DataFrame:
    """Weight of every (key, old customer, INI/ADD) pair that receives part of the key's money.

    ``pairs`` holds each pair of a key once, with its share ``contri_val``. ``share_group`` is ``none`` (no
    share), ``one`` (sum below 2: shares as they are), ``two`` (sum 2 with both kinds: pairs whose share
    is not 1), ``three`` (sum 2 with one kind: share divided by the number of pairs) or ``over``
    (sum above 2: share divided by the sum). The kept weights of every key are scaled to
    sum to 1, and a key that would keep no pair keeps all of them; without ``conserve`` the
    weights stay as the groups give them, which loses or doubles money in group ``two``. A key of
    group ``none`` keeps its first pair, with weight 1.

    A key's window holds its old customers twice, never fact rows.
    """
    key = f"partition by {', '.join(keys)}"
    marked = with_exprs(pairs, {"contri_val": zero_if_null("contri_val")}).selectExpr(
        "*",
        # Shares are multiples of 0.001, so their rounded sum does not depend on order.
        f"round(sum(contri_val) over ({key}), 3) as _total",
        f"count_if(contri_val != 0) over ({key}) as _rows",
        *[f"max(contri_type = '{k}' and contri_val != 0) over ({key}) as _has_{k}" for k in (INI, ADD)],
        f"min(old_planningcustomer) over ({key}) as _first",
    )
    grouped = marked.selectExpr("*", f"""case when _total = 0 then 'none' when _total < 2 then 'one'
        when _total > 2 then 'over' when _has_{INI} and _has_{ADD} then 'two' else 'three' end as share_group""")
    weighed = grouped.selectExpr(
        "*",
        # One representative per key carries an unmatched row through.
        f"""case share_group when 'none' then contri_type = '{INI}' and old_planningcustomer <=> _first
        when 'two' then contri_val != 0 and contri_val != 1 else contri_val != 0 end as _keep""",
        """case share_group when 'none' then 1D when 'three' then try_divide(contri_val, _rows)
        when 'over' then try_divide(contri_val, _total) else contri_val end as weight""",
    )
    if conserve:
        total = "cast(sum(cast({0} as decimal(28,9))) over ({1}) as double)"
        sums = weighed.selectExpr(
            "*", f"{total.format('case when _keep then weight end', key)} as _kept",
            f"{total.format('weight', key)} as _all",
        )
        weighed = with_exprs(sums, {
            "_keep": "_keep or (share_group = 'two' and _kept is null and contri_val != 0)",
            "weight": "try_divide(weight, coalesce(_kept, _all))",
        })
    return weighed.filter("_keep").select(*keys, "old_planningcustomer", "contri_type", "share_group", "weight")


def _weighted(rows: DataFrame, measures: list[str]) -> DataFrame:
    return with_exprs(rows, {
        m: f"case when share_group = 'none' then {m} else {round_dp(f'{m} * weight')} end" for m in measures
    })


def apportion_groups(
    long: DataFrame, keys: list[str], measures: list[str], conserve: bool = True
) -> DataFrame:
    """Classify each key by the sum of its shares and apply the shares to the measures of its rows.

    ``long`` holds every row once per pair of its key (``unpivot_shares``). Weights belong to the key's
    distinct pairs, so each of several rows that share a key is split by the same weights and keeps
    its own money. Groups and weights as in ``share_weights``; a row of group ``none`` passes through once.
    ``long`` is read twice, so pass a settled table, or the unpivoted rows of one.
    """
    # No group keeps a pair of additional money whose share is zero.
    long = long.filter(f"contri_val != 0 or contri_type = '{INI}'")
    pair = [*keys, "old_planningcustomer", "contri_type"]
    # One shuffle by key, or none for a table laid out by it, serves the distinct pairs and their windows.
    alone = long.select(*pair, "contri_val")
    pairs = aggregate(alone if KEY_HASH in keys else alone.repartition(*keys), pair, {"contri_val": "max(contri_val)"})
    return _weighted(join_keys(long, share_weights(pairs, keys, conserve), pair), measures)


def apportion_rows(
    rows: DataFrame, shares: DataFrame, keys: list[str], measures: list[str], conserve: bool = True
) -> DataFrame:
    """Rows split by the shares of their key; a row whose key has no share passes through once.

    The same as ``apportion_groups`` of the joined and unpivoted rows, but the rows meet only the
    weights they keep.
    """
    # Shares of zero change neither a group nor a weight of a key that has any other.
    pairs = shares.transform(unpivot_shares).filter("contri_val != 0")
    weights = share_weights(pairs, keys, conserve).filter("share_group != 'none'")
    split = join_keys(rows, weights, keys, "left")
    return _weighted(with_exprs(split, {"share_group": "coalesce(share_group, 'none')", "weight": "coalesce(weight, 1D)"}), measures)


# New customer for initial money or an unchanged account, else the old customer.
TARGET_CUSTOMER = f"""case when share_group = 'none' or planningcustomer = old_planningcustomer
    or contri_type = '{INI}' then planningcustomer else old_planningcustomer end"""


def reassign_branch(apportioned: DataFrame) -> DataFrame:
    """Move apportioned money to its target customer and sum it back to the fact grain.

    Unmatched rows are returned as they are. Both kinds of rows are read from one settled table.
    """
    columns = [*S.KEY10, "modelingname", "price", *S.MEASURES]
    apportioned = settle(apportioned.select(*columns, "old_planningcustomer", "contri_type", "share_group"))
    key = [*S.KEY10, "modelingname"]
    # Few parts of one task share a target, and a row is shorter than its partial sums.
    targets = with_exprs(apportioned.filter("share_group != 'none'"), {"planningcustomer": TARGET_CUSTOMER})
    moved = aggregate(
        targets.select(*columns).repartition(*key),
        key,
        {"price": exact_avg("price"), **{m: exact_sum(m) for m in S.MEASURES}},
    )
    untouched = apportioned.filter("share_group = 'none'")
    return moved.select(*columns).unionByName(untouched.select(*columns))


def reallocate_branches(fact: DataFrame, branch: DataFrame) -> DataFrame:
    """Shares, apportionment and reassignment of all three spend types in one plan."""
    keys = hashed(S.KEY5, fact, branch)
    return reassign_branch(apportion_rows(
        nonzero_spend_rows(fact), key_shares(branch, keys), [*keys, "modelingname"], S.MEASURES))


def assemble_fact(fact: DataFrame, reassigned: DataFrame) -> DataFrame:
    """Untouched drivers plus the reassigned spend rows."""
    columns = [*S.KEY10, "modelingname", "price", *S.MEASURES]
    untouched = fact.filter(f"not {IS_SPEND} and {any_nonzero(S.MEASURES)}")
    return untouched.select(*columns).unionByName(reassigned.select(*columns))


OLD_MEASURES = [f"last_year_period_{m}_old" for m in ("spends", "volume", "gps", "netsales")]
NEW_MEASURES = ["optimized_spends", "optimized_volume", "optimized_gps", "optimized_netsales_adj"]


def branch_rework_output(stage2: DataFrame, branch: DataFrame, months: str) -> DataFrame:
    """Re-attribute an optimised scenario between head office and branches.

    ``months`` is a condition that keeps the branch rows of the scenario's last-year
    period. Last-year and optimised measures are both scaled by the share, then summed.
    """
    key = ["segment", "shisha", "planningcustomer"]
    shares = key_shares(branch.filter(months), key)
    split = with_exprs(apportion_rows(stage2, shares, [*key, "modelingname"], [*OLD_MEASURES, *NEW_MEASURES]), {
        "planningcustomer": TARGET_CUSTOMER, "optimized_gps_adj": "optimized_gps * adjustment_factor",
    })
    summed = [*OLD_MEASURES, "optimized_spends", "optimized_volume", "optimized_gps_adj", "optimized_netsales_adj"]
    changes = {
        "spend_change": ("optimized_spends", OLD_MEASURES[0]),
        "vol_change": ("optimized_volume", OLD_MEASURES[1]),
        "ns_change": ("optimized_netsales_adj", OLD_MEASURES[3]),
    }
    cost_old, cost_new = f"ec_per_qtycase * {OLD_MEASURES[1]}", "ec_per_qtycase * optimized_volume"
    moved = aggregate(split.filter("share_group != 'none'"), S.DIMENSIONS, {
        "ec_per_qtycase": exact_avg("ec_per_qtycase"), "price": exact_avg("price"),
        **{m: exact_sum(m, 9) for m in summed},
    }).selectExpr(
        "*", f"{cost_old} as ec", f"{OLD_MEASURES[3]} - {cost_old} as mc",
        f"{cost_new} as ec_new", f"optimized_netsales_adj - {cost_new} as mc_new",
        *named({
            name: f"case when {old} != 0 then {round_dp(change(new, old))} else 0D end"
            for name, (new, old) in changes.items()
        }),
    )
    untouched = split.filter("share_group = 'none'")
    return moved.unionByName(untouched.select(*moved.columns))


def branch_list(existing: DataFrame, branch: DataFrame, scenario: str) -> DataFrame:
    """Old customers that map to several new customers; replaces the scenario's rows."""
    pairs = branch.select("old_planningcustomer", "new_planningcustomer").distinct()
    mapping = (
        aggregate(pairs, ["old_planningcustomer"], {"branches": "sort_array(collect_set(new_planningcustomer))"})
        .filter("size(branches) > 1")
        .selectExpr(
            "old_planningcustomer", "concat_ws(',', branches) as branch_list",
            f"{quoted(scenario)} as scenario_name", "cast(null as string) as section_name",
        )
    )
    others = existing.filter(f"scenario_name != {quoted(scenario)}")
    return others.unionByName(mapping, allowMissingColumns=True)
