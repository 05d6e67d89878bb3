import itertools

import numpy as np
import pandas as pd
import pytest

from spendlever.functions.lineage import settle
from spendlever.functions.ordered import bucket_of, quantile_bounds
from spendlever.operators import allocate as A

LY = A.LY


def items(seed, n=6, coef=None):
    rng = np.random.default_rng(seed)
    s = np.round(rng.uniform(10, 100, n), 3)
    gps = np.round(s * rng.uniform(0.5, 6, n), 3)
    return pd.DataFrame({
        "id": range(n), "grp": "g", f"{LY}spends": s, f"{LY}volume": np.round(rng.uniform(5, 50, n), 3),
        f"{LY}gps": gps, f"{LY}netsales": gps - s, f"{LY}spends_old": s, f"{LY}volume_old": 7.0, f"{LY}gps_old": gps,
        "spends_coef": rng.uniform(0.1, 0.9, n) if coef is None else coef, "price": 1.0, "ns_to_gps": 0.8,
    })


def best_vertex(pdf, low, high):
    """Optimum over all vertices: every item at a bound, at most one in between."""
    s, g, c = (pdf[x].to_numpy() for x in (f"{LY}spends", f"{LY}gps", "spends_coef"))
    lb, ub = 0.9 * s, 1.1 * s
    m = c * g / s - 1
    base = (g * (1 - c)).sum()
    best = -np.inf
    n = len(s)
    for free in range(n):
        rest = [i for i in range(n) if i != free]
        for bits in itertools.product((0, 1), repeat=n - 1):
            z = np.empty(n)
            z[rest] = [ub[i] if b else lb[i] for i, b in zip(rest, bits)]
            total = z[rest].sum()
            for target in (low - total, high - total, lb[free], ub[free]):
                if lb[free] - 1e-9 <= target <= ub[free] + 1e-9:
                    z[free] = target
                    if low - 1e-6 <= z.sum() <= high + 1e-6:
                        best = max(best, base + (m * z).sum())
    return best


def value(out):
    z, s, g, c = (out[x] for x in ("optimized_spends", f"{LY}spends", f"{LY}gps", "spends_coef"))
    return (g * (1 + c * (z - s) / s) - z).sum()


@pytest.mark.parametrize("seed", [1, 2])
def test_allocation_is_optimal(spark, seed):
    pdf = items(seed)
    df = spark.createDataFrame(pdf)
    total = pdf[f"{LY}spends"].sum()
    free = A.allocate(df, []).toPandas()
    assert value(free) == pytest.approx(best_vertex(pdf, 0, total), abs=1e-3)
    assert free.optimized_spends.sum() <= total + 1e-4
    goal = A.allocate(df, [], goal=0.97 * total).toPandas()
    assert goal.optimized_spends.sum() == pytest.approx(0.97 * total, abs=1e-4)
    assert value(goal) == pytest.approx(best_vertex(pdf, 0.97 * total, 0.97 * total), abs=1e-3)
    band = A.allocate(df, ["grp"], "_old", band_on_old=True).toPandas()
    assert value(band) == pytest.approx(best_vertex(pdf, 0.9 * total, total), abs=1e-3)
    for out in (free, goal, band):
        assert out.feasible.all()
        assert (out.optimized_spends >= out.spends_lb - 1e-6).all()
        assert (out.optimized_spends <= out.spends_ub + 1e-6).all()


def test_goal_outside_bounds_is_flagged(spark):
    pdf = items(4)
    out = A.allocate(spark.createDataFrame(pdf), [], goal=10 * pdf[f"{LY}spends"].sum()).toPandas()
    assert not out.feasible.any()
    assert np.allclose(out.optimized_spends, out.spends_ub)


def test_equal_slopes_share_the_budget(spark):
    pdf = items(5, 4)
    pdf[f"{LY}gps"] = 4 * pdf[f"{LY}spends"]
    pdf["spends_coef"] = 0.5
    out = A.allocate(spark.createDataFrame(pdf), [], policies=A.POLICIES).toPandas()
    for _, one in out.groupby("policy"):
        assert one.optimized_spends.sum() == pytest.approx(pdf[f"{LY}spends"].sum(), abs=1e-4)
        assert np.allclose(one.optimized_spends / one[f"{LY}spends"], 1.0, atol=1e-6)


def test_losing_items_stay_at_lower_bound_unless_spend_comes_first(spark):
    pdf = items(6, 1, coef=0.1)
    pdf[f"{LY}gps"] = 2 * pdf[f"{LY}spends"]
    out = A.allocate(spark.createDataFrame(pdf), [], policies=A.POLICIES).toPandas().set_index("policy")
    s = pdf[f"{LY}spends"][0]
    assert out.loc[A.MAX_NET_SALES, "optimized_spends"] == pytest.approx(0.9 * s, abs=1e-5)
    assert out.loc[A.SPEND_FIRST, "optimized_spends"] == pytest.approx(s, abs=1e-5)


def test_min_spend_reaches_the_target(spark):
    pdf = items(7)
    out = A.min_spend_for_target(spark.createDataFrame(pdf), ["grp"]).toPandas()
    if out.feasible.all():
        assert value(out) >= pdf[f"{LY}netsales"].sum() - 1e-3
    slack = pdf.assign(**{f"{LY}netsales": 0.0})
    low = A.min_spend_for_target(spark.createDataFrame(slack), ["grp"]).toPandas()
    assert np.allclose(low.optimized_spends, low.spends_lb)


def test_exact_target_gives_up_surplus(spark):
    pdf = items(8, coef=0.1)
    pdf[f"{LY}gps"] = 2 * pdf[f"{LY}spends"]
    at_lb = value(pdf.assign(optimized_spends=0.9 * pdf[f"{LY}spends"]))
    pdf[f"{LY}netsales"] = (at_lb - 3.0) / len(pdf)
    out = A.min_spend_for_target(spark.createDataFrame(pdf), ["grp"], exact=True).toPandas()
    assert out.feasible.all()
    assert value(out) == pytest.approx(at_lb - 3.0, abs=1e-3)


def test_many_items_in_one_group_match_a_plain_greedy(spark):
    pdf = items(9, 4000)
    out = A.allocate(spark.createDataFrame(pdf), []).toPandas()
    m = pdf.spends_coef * pdf[f"{LY}gps"] / pdf[f"{LY}spends"] - 1
    order = m.sort_values(ascending=False).index
    left = pdf[f"{LY}spends"].sum() * 0.1
    total = 0.0
    for i in order:
        if m[i] <= 0:
            break
        add = min(0.2 * pdf.loc[i, f"{LY}spends"], left)
        left -= add
        total += m[i] * add
    base = value(pdf.assign(optimized_spends=0.9 * pdf[f"{LY}spends"]))
    assert value(out) == pytest.approx(base + total, rel=1e-9)


def test_guardrail_leaves_no_row_that_spends_more_and_sells_less(spark):
    rows = [("a", 110.0, 90.0), ("b", 90.0, 90.0), ("c", 110.0, 120.0), ("d", 100.0, 99.0)]
    pdf = pd.DataFrame(rows, columns=["id", "optimized_spends", "optimized_netsales"]).assign(
        optimized_volume=5.0, optimized_gps=1.0,
        **{f"{LY}spends_old": 100.0, f"{LY}netsales_old": 100.0, f"{LY}volume_old": 4.0, f"{LY}gps_old": 200.0},
    )
    out = A.guardrail_revert(spark.createDataFrame(pdf)).toPandas().set_index("id")
    assert out.reverted.to_dict() == {"a": True, "b": False, "c": False, "d": True}
    assert out.loc["a", "optimized_spends"] == 100.0 and out.loc["a", "optimized_gps"] == 200.0
    bad = (out.optimized_spends >= out[f"{LY}spends_old"]) & (out.optimized_netsales < out[f"{LY}netsales_old"])
    assert not bad.any()


def test_candidate_choice_prefers_spend_then_growth_in_stage_two(spark):
    pdf = pd.concat([items(10, 3).assign(policy=p, optimized_spends=lambda d, f=f: d[f"{LY}spends"] * f)
                     for p, f in (("low", 0.95), ("full", 1.0), ("over", 1.09))])
    df = spark.createDataFrame(pdf)
    two = A.candidate_select(df, ["grp"], "_old").first()
    assert (two["policy"], two["accepted"]) == ("full", True)
    only = A.candidate_select(df.filter("policy = 'over'"), ["grp"], "_old").first()
    assert (only["policy"], only["accepted"]) == ("over", False)


def test_null_groups_are_allocated(spark):
    rows = [(None, "p", 0.5, 100.0, 50.0, 400.0, 300.0), ("a", "p", 0.5, 100.0, 50.0, 400.0, 300.0)]
    schema = "shisha string, planningcustomer string, spends_coef double, " + ", ".join(
        f"{A.LY}{m} double" for m in ("spends", "volume", "gps", "netsales"))
    items = spark.createDataFrame(rows, schema)
    assert A.allocate(items, ["shisha"]).count() == 2
    assert A.min_spend_for_target(items, ["shisha"]).count() == 2
    goal = A.allocate(items, [], goal=1000.0)
    assert goal.filter("feasible").count() == 0 and goal.count() == 2


def priced_items(spark, rows, group="g"):
    """(group, spend, coefficient, gps per unit of spend) as allocation input."""
    return settle(spark.createDataFrame(
        [(g, str(i), s, c, 10.0, s * x, s * x - s, 1.0) for i, (g, s, c, x) in enumerate(rows)],
        f"{group} string, shisha string, last_year_period_spends double, spends_coef double, last_year_period_volume double, "
        "last_year_period_gps double, last_year_period_netsales double, price double"))


def greedy(rows, budget):
    """(spend, slope) pairs filled one after the other."""
    items = sorted(((c * x - 1, s) for _, s, c, x in rows), reverse=True)
    left, z = budget - sum(0.9 * s for _, s in items), []
    for m, s in items:
        use = max(0.0, min(0.2 * s, left))
        left -= use
        z.append((0.9 * s + use, m, s))
    return z


@pytest.mark.parametrize("kind", ["within a 64th", "half without response", "all equal"])
def test_slopes_that_crowd_are_spread_over_buckets(spark, kind):
    import random

    random.seed(2)
    n = 4000
    if kind == "within a 64th":
        coefficients = [0.5 + i / n / 100 for i in range(n)]
    elif kind == "all equal":
        coefficients = [0.4] * n
    else:
        coefficients = [0.0] * (n // 2) + [random.uniform(0.2, 0.8) for _ in range(n // 2)]
    rows = [("a", round(random.uniform(1, 9), 2), c, 2.5) for c in coefficients]
    items = priced_items(spark, rows)
    boxed = A._boxed(items, "")
    bounds = quantile_bounds(boxed, "slope")
    steps = boxed.groupBy("slope").count().selectExpr(f"{bucket_of('slope', bounds)} as b")
    largest = max(r["count"] for r in steps.groupBy("b").count().collect())
    distinct = len(set(coefficients))
    assert largest <= max(1, 0.1 * distinct)  # no task sorts above a tenth
    total = sum(s for _, s, _, _ in rows)
    for goal in (0.95, 1.0, 1.05):
        out = A.allocate(items, ["g"], goal=f"_centre * {goal}D").agg({"optimized_spends": "sum"}).first()[0]
        assert out == pytest.approx(total * goal, rel=1e-6)
    plan = A.allocate(items, ["g"], goal="_centre * 1.05D")
    joins = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "slope" not in " ".join(x for x in joins.splitlines() if "Join" in x)  # items meet groups, not slopes
    got = sum(r["optimized_spends"] * r["slope"] for r in plan.collect())
    assert got == pytest.approx(sum(z * m for z, m, _ in greedy(rows, total * 1.05)), rel=1e-6)


def test_budget_curve_answers_every_budget_like_an_allocation(spark):
    rows = [("a", 10.0, 0.9, 3.0), ("a", 20.0, 0.5, 3.0), ("a", 5.0, 0.5, 3.0), ("a", 8.0, 0.1, 2.0), ("b", 7.0, 0.6, 2.5), ("b", 3.0, None, 1.0)]
    rows = [(g, s, 0.0 if c is None else c, x) for g, s, c, x in rows]
    items = priced_items(spark, rows)
    curve = settle(A.budget_curve(items, ["g"]))
    budgets = [("a", b) for b in (30.0, 38.7, 40.0, 43.0, 45.5, 47.3, 60.0)] + [("b", 9.5)]
    got = {(r["g"], r["budget"]): r for r in A.optimum_at(curve, spark.createDataFrame(budgets, "g string, budget double"), ["g"]).collect()}
    for g, budget in budgets:
        mine = [r for r in rows if r[0] == g]
        z = greedy(mine, budget)
        spend = sum(a for a, _, _ in z)
        netsales = sum(x * s * (1 + c * (a - s) / s) - a for (a, m, s) in z for (_, s2, c, x) in mine if s2 == s)
        assert got[(g, budget)]["spend"] == pytest.approx(spend) and got[(g, budget)]["netsales"] == pytest.approx(netsales)
    assert not got[("a", 30.0)]["feasible"] and got[("a", 40.0)]["feasible"]
    assert got[("a", 60.0)]["marginal"] is None and got[("a", 30.0)]["marginal"] == pytest.approx(1.7)
    slopes = [r["slope"] for r in sorted(curve.filter("g = 'a'").collect(), key=lambda r: r["spend_from"])]
    assert slopes == sorted(slopes, reverse=True) and len(slopes) == 3  # equal slopes are one segment


def test_guarded_ranges_free_budget_for_items_that_gain(spark):
    rows = [("a", 10.0, 0.0, 2.0), ("a", 10.0, 0.9, 3.0)]
    items = priced_items(spark, rows)
    out = {r["slope"] > 0: r for r in A.allocate(settle(A.without_losing_raises(items)), ["g"], goal="_centre * 1.03D").collect()}
    assert out[True]["optimized_spends"] == pytest.approx(11.0) and out[False]["optimized_spends"] == pytest.approx(9.6)
    assert out[False]["spends_ub"] == pytest.approx(10.0) and out[True]["spends_ub"] == pytest.approx(11.0)
