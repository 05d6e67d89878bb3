import numpy as np
import pandas as pd
import pytest

from spendlever.functions import ordered
from spendlever.functions.lineage import settle
from spendlever.operators import response as R


def fit_rows(seed=3):
    rng = np.random.default_rng(seed)
    frames = []
    slopes = [2.5, 1.2, 1.1, 1.05, 1.0, 0.5, 0.0, -0.05, -0.1, -0.2, -0.8]
    for key, slope in [(f"slope {b}", b) for b in slopes]:
        n = 40
        s = np.round(np.exp(rng.normal(4, 1, n)), 2)
        v = np.round(np.exp(1 + slope * np.log(s) + rng.normal(0, 1.2, n)) + 1, 0)
        frames.append(pd.DataFrame({"k": key, "spends": s, "volume": v}))
    frames.append(pd.DataFrame({"k": "one", "spends": [5.0], "volume": [7.0]}))
    frames.append(pd.DataFrame({"k": "flat", "spends": [5.0, 5.0, 5.0], "volume": [2.0, 3.0, 9.0]}))
    frames.append(pd.DataFrame({"k": "level", "spends": [2.0, 4.0, 9.0], "volume": [6.0, 6.0, 6.0]}))
    frames.append(pd.DataFrame({"k": "pair", "spends": [2.0, 4.0], "volume": [9.0, 3.0]}))
    pdf = pd.concat(frames, ignore_index=True)
    return pdf.assign(year=1999, month=(pdf.index % 12 + 1).astype("int32"))


def ols(x, y):
    if len(x) < 2 or np.ptp(x) == 0:
        return 0.0, y.mean()
    slope = np.sum((x - x.mean()) * (y - y.mean())) / np.sum((x - x.mean()) ** 2)
    return slope, y.mean() - slope * x.mean()


def expected_fit(g):
    """The documented trimming, one row set per threshold."""
    ps, pv = g.spends.rank(pct=True), g.volume.rank(pct=True)
    x, y = np.log(g.spends), np.log(g.volume)
    slope, icept = ols(x, y)
    best = (slope, icept, len(g), "Original")
    if not (slope < 0 or slope > 1):
        return best
    original = best
    for hi, lo in zip(R.TRIM_HIGH, R.TRIM_LOW):
        if slope < 0:
            out = ((ps >= hi) & (pv <= lo)) | ((ps <= lo) & (pv >= hi))
        else:
            out = ((ps >= hi) & (pv >= hi)) | ((ps <= lo) & (pv <= lo))
        if out.all():
            best = original
            continue
        b, a = ols(x[~out], y[~out])
        if 0.1 < b < 0.9:
            best = (b, a, int((~out).sum()), "augmented")
    return best


def test_trim_refit_matches_brute_force(spark):
    kinds = set()
    for seed in (3, 11):
        pdf = fit_rows(seed)
        got = R.trim_refit(spark.createDataFrame(pdf), ["k"]).toPandas().set_index("k")
        for key, group in pdf.groupby("k"):
            slope, icept, n, kind = expected_fit(group)
            kinds.add(kind)
            assert got.loc[key, "spends_coef"] == pytest.approx(slope, abs=1e-5)
            assert got.loc[key, "intercept"] == pytest.approx(max(icept, 0), abs=1e-5)
            assert got.loc[key, "number_of_rows_after_perct_rank"] == n
            assert got.loc[key, "model_type"].startswith(kind)
    assert kinds == {"Original", "augmented"}
    assert pd.isna(got.loc["one", "r_squared"])
    assert got.loc["flat", "r_squared"] == 0.0 and got.loc["level", "r_squared"] == 1.0


def test_rank_matches_average_ties_with_hot_key(spark):
    rng = np.random.default_rng(5)
    hot = pd.DataFrame({"k": "hot", "spends": np.round(rng.lognormal(3, 2, 3000), 1)})
    cold = pd.DataFrame({"k": [f"c{i % 50}" for i in range(500)], "spends": rng.integers(0, 5, 500).astype(float)})
    pdf = pd.concat([hot, cold], ignore_index=True)
    got = R.value_ranks(spark.createDataFrame(pdf), ["k"], "spends").toPandas()
    want = pdf.assign(p=pdf.groupby("k").spends.rank(pct=True)).drop_duplicates(["k", "spends"])
    merged = got.merge(want, on=["k", "spends"])
    assert len(merged) == len(want) == len(got)
    assert np.allclose(merged.pct_rank_spends, merged.p)


def test_rank_of_known_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 3.0)], "k string, spends double")
    got = {r["spends"]: r["pct_rank_spends"] for r in R.value_ranks(df, ["k"], "spends").collect()}
    assert got == {1.0: 0.25, 2.0: 0.625, 3.0: 1.0}


def test_fallback_takes_first_plausible_level(spark):
    levels = R.STAGE1
    full, customer, branch = "shisha+planningcustomer", "planningcustomer", "shisha"
    rows = [
        (full, "s1", "c1", "", 0.5, "Original"), (full, "s1", "c2", "", -2.0, "Original"),
        (full, "s2", "c3", "", 0.95, "Original"), (customer, "*", "c1", "", 0.3, "x"),
        (customer, "*", "c2", "", 0.4, "x"), (customer, "*", "c3", "", 5.0, "x"),
        (branch, "s1", "*", "", 0.6, "x"), (branch, "s2", "*", "", 0.9, "x"),
    ]
    df = spark.createDataFrame(
        rows, "level string, shisha string, planningcustomer string, first_sales_month string, "
        "spends_coef double, model_type string"
    )
    got = {r["planningcustomer"]: (r["spends_coef"], r["model_type"]) for r in R.hierarchical_fallback(df, levels).collect()}
    assert got["c1"] == (0.5, "Original")
    assert got["c2"] == (0.4, "Without_SHISHA_Level_Model_Augmented")
    assert got["c3"] == (0.9, "Without_PLANNINGCUSTOMER_Level_Model_Augmented")


def test_zero_response_rows_join_their_key(spark):
    rows = spark.createDataFrame(
        [("s", "c", 10.0, 0.0, 1999, 1), ("s", "c", 4.0, 2.0, 1999, 2), ("s", "c", 9.0, 3.0, 1999, 3)],
        "shisha string, planningcustomer string, spends double, volume double, year int, month int",
    )
    model = R.response_model(rows, R.STAGE1).collect()
    assert len(model) == 1
    assert model[0]["number_of_rows"] == 3 and model[0]["total_overall_spends"] == 23.0
    assert R.ZERO_RESPONSE in model[0]["model_type"] and model[0]["first_sales_month"] == "1999-02-01"


def test_null_keys_are_fitted_like_any_other(spark):
    rows = [(s, float(i + 1), float(2 * i + 3 + (i % 3))) for s in ("a", None) for i in range(12)]
    df = spark.createDataFrame(rows, "shisha string, spends double, volume double").selectExpr("*", "1999 as year", "1 as month")
    plain, trimmed = (f(df, ["shisha"]).collect() for f in (R.loglog_fit, R.trim_refit))
    assert len(plain) == len(trimmed) == 2
    ranks = R.pct_rank_avg(df, ["shisha"]).filter("shisha is null")
    assert ranks.filter("pct_rank_spends is null or pct_rank_volume is null").count() == 0 and ranks.count() == 12


@pytest.mark.parametrize("limit", [0, 20, 10**6])
def test_hot_keys_take_another_way_to_the_same_results(spark, monkeypatch, limit):
    """Every key hot, some, or none."""
    rows = spark.createDataFrame(fit_rows())
    usual = [sorted(map(str, f(rows, ["k"]).collect())) for f in (R.trim_refit, R.pct_rank_avg)]
    monkeypatch.setattr(ordered, "HOT_KEY_ROWS", limit)
    assert [sorted(map(str, f(rows, ["k"]).collect())) for f in (R.trim_refit, R.pct_rank_avg)] == usual


def test_rows_are_shuffled_once_by_key(spark):
    rows = settle(spark.createDataFrame(fit_rows()).selectExpr("*", "'pad' as pad"))
    for plan, exchanges in ((R.pct_rank_avg(rows, ["k"]), 1), (R.trim_refit(rows, ["k"]), 1)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange ") == exchanges, text


@pytest.mark.parametrize("values", [[1.0] * 50, list(range(1000)), [0.5, 0.5, 2.0], [], [-3.0, float("inf"), 7.0]])
def test_buckets_are_monotone_and_even(spark, values):
    df = settle(spark.createDataFrame([(float(v),) for v in values], "v double"))
    bounds = ordered.quantile_bounds(df, "v")
    rows = sorted((r["v"], r["b"]) for r in df.selectExpr("v", f"{ordered.bucket_of('v', bounds)} as b").collect())
    buckets = [b for _, b in rows]
    assert buckets == sorted(buckets) and bounds == sorted(set(bounds))
    if len(values) == 1000:
        assert max(buckets.count(b) for b in set(buckets)) <= 30
