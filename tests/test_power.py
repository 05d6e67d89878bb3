"""Power-law budgets against fine grids and plain bisection."""

import numpy as np
import pandas as pd
import pytest

from spendlever.operators import power as W

LY = W.LY


def frame(seed, n, group="g", coef=None):
    rng = np.random.default_rng(seed)
    s = rng.uniform(10, 100, n)
    c = rng.uniform(0.1, 0.9, n) if coef is None else np.array(coef, float)
    volume = rng.uniform(5, 500, n)
    gps = s * rng.uniform(0.5, 6, n)
    return pd.DataFrame({
        "id": range(n), "g": group, f"{LY}spends": s, f"{LY}volume": volume, f"{LY}gps": gps, f"{LY}netsales": gps - s,
        "spends_coef": c, "backcalc_intercept": volume / s ** c,
    })


def volume(p, z):
    return p.backcalc_intercept.to_numpy() * z ** p.spends_coef.to_numpy()


def at_price(p, price):
    """Spends of concave items at one price of spend."""
    s, c, a = (p[x].to_numpy() for x in (f"{LY}spends", "spends_coef", "backcalc_intercept"))
    return np.clip((price / (a * c)) ** (1 / (c - 1)), 0.9 * s, 1.1 * s)


def bisected(p, reach, wanted):
    low, high = 1e-12, 1e12
    for _ in range(300):
        mid = (low * high) ** 0.5
        low, high = (mid, high) if reach(at_price(p, mid)) >= wanted else (low, mid)
    return at_price(p, low)


def ordered(df):
    return df.toPandas().sort_values(["g", "id"]).reset_index(drop=True)


def test_most_volume_equals_bisection_in_every_group(spark):
    p = pd.concat([frame(1, 40, "a"), frame(2, 3, "b"), frame(3, 1, None)])
    out = ordered(W.most_volume(spark.createDataFrame(p), ["g"], "_centre * 1.02D"))
    assert len(out) == len(p) and out.feasible.all()
    for g in ("a", "b"):
        mine = p[p.g == g]
        want = bisected(mine, np.sum, 1.02 * mine[f"{LY}spends"].sum())
        got = out[out.g == g]
        assert got.optimized_spends.to_numpy() == pytest.approx(want, abs=1e-5)
        assert got.optimized_volume.sum() == pytest.approx(volume(mine, want).sum(), rel=1e-9)
    alone = out[out.g.isna()]
    assert alone.optimized_spends.iloc[0] == pytest.approx(1.02 * alone[f"{LY}spends"].iloc[0])


def test_most_volume_is_not_below_a_fine_grid(spark):
    p = frame(5, 3)
    s = p[f"{LY}spends"].to_numpy()
    total = s.sum()
    out = ordered(W.most_volume(spark.createDataFrame(p), []))
    axis = np.linspace(0.9, 1.1, 801)
    x, y = np.meshgrid(axis * s[0], axis * s[1])
    z = total - x - y
    inside = (z >= 0.9 * s[2]) & (z <= 1.1 * s[2])
    a, c = p.backcalc_intercept.to_numpy(), p.spends_coef.to_numpy()
    best = (a[0] * x ** c[0] + a[1] * y ** c[1] + a[2] * np.where(inside, z, 1.0) ** c[2])[inside].max()
    assert out.optimized_spends.sum() == pytest.approx(total, abs=1e-4)
    assert best - 1e-9 <= out.optimized_volume.sum() <= best * (1 + 1e-4)


def test_least_spend_for_volume_equals_bisection_and_flags_what_is_out_of_reach(spark):
    p = pd.concat([frame(7, 25, "a"), frame(8, 4, "b")])
    df = spark.createDataFrame(p)
    wanted = {g: 1.01 * mine[f"{LY}volume"].sum() for g, mine in p.groupby("g")}
    out = ordered(W.least_spend_for_volume(df, ["g"], "_volume * 1.01D"))
    for g, mine in p.groupby("g"):
        got = out[out.g == g]
        assert got.optimized_spends.to_numpy() == pytest.approx(bisected(mine, lambda z: volume(mine, z).sum(), wanted[g]), abs=1e-5)
        assert got.optimized_volume.sum() == pytest.approx(wanted[g], rel=1e-9) and got.feasible.all()
    goals = spark.createDataFrame([("a", 1e9)], "g string, goal double")
    far = ordered(W.least_spend_for_volume(df, ["g"], goals))
    assert set(far.g) == {"a"} and not far.feasible.any()
    assert far.optimized_spends.to_numpy() == pytest.approx(1.1 * far[f"{LY}spends"].to_numpy(), abs=1e-5)


def test_chords_ties_nulls_and_no_rows(spark):
    # Without curvature: a linear item, a convex one, one without response, and one with a null coefficient.
    p = frame(9, 5, coef=[1.0, 2.0, 0.0, 0.5, 0.5])
    p[f"{LY}spends"] = 50.0
    p["backcalc_intercept"] = [2.0, 1.0, 3.0, 4.0, 4.0]
    p = p.astype({"spends_coef": object})
    p.loc[4, "spends_coef"] = None
    df = spark.createDataFrame(p, "id long, g string, " + ", ".join(f"{c} double" for c in p.columns[2:]))
    out = ordered(W.most_volume(df, ["g"], "_centre"))
    z = dict(zip(out.id, out.optimized_spends))
    assert z[1] == pytest.approx(55) and z[0] == pytest.approx(55) and sum(z.values()) == pytest.approx(250, abs=1e-4)
    assert z[3] == pytest.approx(50, abs=1e-4) and z[2] == z[4] == pytest.approx(45, abs=1e-4)  # no response: least spend
    twins = pd.concat([frame(11, 1)] * 4).assign(id=range(4))
    same = ordered(W.most_volume(spark.createDataFrame(twins), [], "_centre * 1.03D"))
    assert same.optimized_spends.nunique() == 1 and same.optimized_spends.sum() == pytest.approx(1.03 * twins[f"{LY}spends"].sum())
    assert W.most_volume(df.filter("false"), ["g"]).count() == 0


def on_grid(p, budget, points=1001):
    """Volumes and net sales of three items at all grid points that meet the budget."""
    s, g, c = (p[x].to_numpy() for x in (f"{LY}spends", f"{LY}gps", "spends_coef"))
    axis = np.linspace(0.9, 1.1, points)
    x, y = np.meshgrid(axis * s[0], axis * s[1])
    z = budget - x - y
    inside = (z >= 0.9 * s[2]) & (z <= 1.1 * s[2])
    all3 = np.stack([x[inside], y[inside], z[inside]])
    v = (p.backcalc_intercept.to_numpy()[:, None] * all3 ** c[:, None]).sum(0)
    return v, (g[:, None] * (1 + c[:, None] * (all3 / s[:, None] - 1)) - all3).sum(0)


def test_netsales_under_budget_and_volume_are_not_below_a_grid(spark):
    # In group a the volume binds, in b it is free, in c it is out of reach.
    parts = {g: frame(seed, 3, g) for g, seed in (("a", 24), ("b", 25), ("c", 26))}
    grids = {g: on_grid(p, p[f"{LY}spends"].sum()) for g, p in parts.items()}
    v, ns = grids["a"]
    free = v[ns.argmax()]
    assert v.max() - free > 1  # else nothing would bind
    wanted = {"a": float(free + 0.6 * (v.max() - free)), "b": 0.0, "c": float(1.02 * grids["c"][0].max())}
    asked = "case " + " ".join(f"when g = '{g}' then {w!r}D" for g, w in wanted.items()) + " end"
    out = ordered(W.best_netsales_with_volume(spark.createDataFrame(pd.concat(parts.values())), ["g"], volume=asked))
    for g, p in parts.items():
        got, (v, ns) = out[out.g == g], grids[g]
        assert got.optimized_spends.sum() == pytest.approx(p[f"{LY}spends"].sum(), abs=1e-4)
        assert got.feasible.all() == (g != "c") and got.feasible.nunique() == 1
        if g == "c":
            assert v.max() - 1e-9 <= got.optimized_volume.sum() <= v.max() * (1 + 1e-3)
            continue
        assert got.optimized_volume.sum() >= wanted[g] * (1 - 1e-9)
        best, top = ns[v >= wanted[g]].max(), ns.max()
        assert best - 1e-6 * abs(best) <= got.optimized_netsales.sum() <= best + 0.02 * (top - ns.min())
        if g == "a":
            assert got.optimized_volume.sum() == pytest.approx(wanted[g], rel=1e-6)  # no more than asked
