import pytest

from spendlever import queries as Q, schemas as S
from spendlever.operators import branch as B
from spendlever.sources import star

KEY = [*S.KEY5, "modelingname"]


def long_rows(spark, shares):
    """One fact row of 100 per key; ``shares`` maps customer to (old, ini, add) triples."""
    rows = []
    for customer, triples in shares.items():
        for old, ini, add in triples:
            rows.append((1999, 1, "B", "C", "SC", "SEG", "SH", "CL", "CH", customer, "PRICEOFF",
                         2.0, 100.0, 300.0, 400.0, 50.0, old, ini, add))
    schema = ", ".join([
        "year int", "month int", *[f"{d} string" for d in S.DIMENSIONS], "modelingname string", "price double",
        *[f"{m} double" for m in S.MEASURES], "old_planningcustomer string", "ini_contri double", "add_contri double",
    ])
    return B.unpivot_shares(spark.createDataFrame(rows, schema))


CASES = {
    "unmatched": [(None, None, None)],
    "zero": [("x", 0.0, 0.0), ("y", 0.0, 0.0)],
    "one": [("one", 0.4, 0.6)],
    "two": [("two", 1.0, 0.0), ("ho", 0.3, 0.7)],
    "lost": [("lost", 1.0, 0.0), ("ho", 0.0, 1.0)],
    "three": [("three", 1.0, 0.0), ("ho", 1.0, 0.0)],
    "over": [("over", 1.0, 0.0), ("ho", 0.5, 0.5), ("area", 0.0, 1.0)],
}


def test_groups_and_weights(spark):
    rows = B.apportion_groups(long_rows(spark, CASES), KEY, S.MEASURES, conserve=False).collect()
    got = {}
    for r in rows:
        got.setdefault(r["planningcustomer"], []).append((r["share_group"], round(r["weight"], 4), r["spends"]))
    assert got["unmatched"] == [("none", 1.0, 100.0)] and got["zero"] == [("none", 1.0, 100.0)]
    assert sorted(got["one"]) == [("one", 0.4, 40.0), ("one", 0.6, 60.0)]
    assert sorted(got["two"]) == [("two", 0.3, 30.0), ("two", 0.7, 70.0)]
    assert "lost" not in got
    assert got["three"] == [("three", 0.5, 50.0)] * 2
    assert sorted(w for _, w, _ in got["over"]) == [0.1667, 0.1667, 0.3333, 0.3333]


def test_conserving_mode_keeps_all_money(spark):
    out = B.reassign_branch(B.apportion_groups(long_rows(spark, CASES), KEY, S.MEASURES))
    total = out.selectExpr("sum(spends) as s", "sum(volume) as v").first()
    assert total["s"] == pytest.approx(100.0 * len(CASES), abs=0.01)
    assert total["v"] == pytest.approx(50.0 * len(CASES), abs=0.01)


def test_initial_money_stays_and_additional_money_moves(spark):
    shares = {"a": [("ho", 0.4, 0.6)], "b": [("b", 0.4, 0.6)]}
    out = B.reassign_branch(B.apportion_groups(long_rows(spark, shares), KEY, S.MEASURES)).collect()
    assert {r["planningcustomer"]: r["spends"] for r in out} == {"a": 40.0, "ho": 60.0, "b": 100.0}


def test_branch_list_replaces_its_scenario(spark):
    pairs = spark.createDataFrame([("ho", "a"), ("ho", "b"), ("x", "x")], "old_planningcustomer string, new_planningcustomer string")
    existing = spark.createDataFrame([("S", "old"), ("T", "keep")], "scenario_name string, branch_list string")
    once = B.branch_list(existing, pairs, "S")
    rows = {(r["scenario_name"], r["branch_list"]) for r in once.collect()}
    assert rows == {("T", "keep"), ("S", "a,b")}
    assert {(r["scenario_name"], r["branch_list"]) for r in B.branch_list(once, pairs, "S").collect()} == rows


def shared_key_rows(spark):
    """Two fact rows of 100 and 300 that share a branch key, and one row without any branch."""
    columns = ["year", "month", *S.DIMENSIONS, "modelingname", "price", *S.MEASURES]
    row = lambda channel, customer, x: (1999, 1, "B", "C", "SC", "SEG", None, "CL", channel, customer, "PRICEOFF", 2.0, x, 3 * x, 4 * x, x)
    kinds = ", ".join(f"{c} {'int' if c in ('year', 'month') else 'double' if c in ('price', *S.MEASURES) else 'string'}" for c in columns)
    return spark.createDataFrame([row("C1", "p", 100.0), row("C2", "p", 300.0), row("C1", "q", 50.0)], kinds)


@pytest.mark.parametrize("old", [["ho"], ["ho", "area"], ["ho", "area", "p"]])
def test_rows_that_share_a_key_keep_their_own_money(spark, old):
    fact = shared_key_rows(spark)
    money = [("1999", "1", o, 60.0, 40.0 if o != "p" else 0.0) for o in old]
    branch = spark.createDataFrame(money, "y string, m string, old_planningcustomer string, i double, a double").selectExpr(
        "1999 as year", "1 as month", "'SEG' as segment", "cast(null as string) as shishanm", "'p' as new_planningcustomer", "old_planningcustomer",
        "i as ini_priceoff", "a as add_priceoff", *[f"0D as {k}_{t}" for t in ("promotionad", "liquidation") for k in ("ini", "add")])
    out = B.reallocate_branches(fact, branch)
    got = {(r["channel"], r["planningcustomer"] == "q"): r["s"] for r in out.groupBy("channel", "planningcustomer").agg({"spends": "sum"})
           .selectExpr("channel", "planningcustomer", "`sum(spends)` as s").groupBy("channel", "planningcustomer").agg({"s": "sum"})
           .selectExpr("channel", "planningcustomer", "`sum(s)` as s").collect()}
    assert got[("C1", True)] == 50.0
    totals = {r["channel"]: r["s"] for r in out.groupBy("channel").agg({"spends": "sum"}).withColumnRenamed("sum(spends)", "s").collect()}
    assert totals["C1"] == pytest.approx(150.0, abs=0.01) and totals["C2"] == pytest.approx(300.0, abs=0.01)
    # The long form gives the same rows.
    long = B.unpivot_shares(B.branch_share(branch, fact))
    same = B.reassign_branch(B.apportion_groups(long, KEY, S.MEASURES))
    order = [*S.KEY10, "modelingname", "spends"]
    assert sorted(map(str, out.select(*order).collect())) == sorted(map(str, same.select(*order).collect()))


def test_both_kinds_of_rows_are_read_from_one_settled_table(spark):
    rows = B.apportion_groups(long_rows(spark, CASES), KEY, S.MEASURES)
    out = B.reassign_branch(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan  # neither is worked out twice
    assert out.count() == B.reassign_branch(rows.repartition(3)).count()


def test_shares_meet_rows_of_other_drivers_with_null(spark):
    branch = spark.sql("""select 1999 as year, 1 as month, 'SEG' as segment, cast(null as string) as shishanm, 'p' as new_planningcustomer,
        old_planningcustomer, i as ini_priceoff, a as add_priceoff, 0D as ini_promotionad, 0D as add_promotionad, 3D as ini_liquidation, 1D as add_liquidation
        from values ('ho', 1D, 3D), ('p', 0D, 0D) as t(old_planningcustomer, i, a)""")
    rows = spark.sql("select 1999 as year, 1 as month, 'SEG' as segment, cast(null as string) as shisha, c as planningcustomer, m as modelingname "
                     "from values ('p', 'PRICEOFF'), ('p', 'PROMOTIONAD'), ('p', 'LIQUIDATION'), ('p', 'Own Price'), ('p', null), ('q', 'PRICEOFF') as t(c, m)")
    shared = B.branch_share(branch, rows)
    assert shared._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 0  # types are not dealt out before the join
    got = sorted([tuple(r)[4:] for r in shared.collect()], key=str)
    assert got == sorted([
        ("p", "PRICEOFF", "ho", 0.25, 0.75), ("p", "PRICEOFF", "p", 0.0, 0.0), ("p", "PROMOTIONAD", "ho", 0.0, 0.0), ("p", "PROMOTIONAD", "p", 0.0, 0.0),
        ("p", "LIQUIDATION", "ho", 0.75, 0.25), ("p", "LIQUIDATION", "p", 0.75, 0.25),
        ("p", "Own Price", None, None, None), ("p", None, None, None, None), ("q", "PRICEOFF", None, None, None)], key=str)


def star_rows(spark, folder):
    """Five lines of one month on five days, three of them booked by the head office; one name of two nations."""
    tables = {
        "region": "select * from values (0, 'R') as t(k, n)",
        "nation": "select * from values (1, 'N', 0), (2, 'N', 0) as t(k, n, r)",
        "supplier": "select 1L, 's', 1, 0D",
        "part": "select 1L, 'p', 'b', 'STANDARD', 10, 5D",
        "customer": "select k, 'c', cast(k as int), 0D, 'BUILDING' from values (1L), (2L) as t(k)",
        "orders": "select o, c, 'F', 0D, timestamp_ntz'1999-01-01 00:00:00', 'x' from values (3L, 1L), (4L, 1L), (6L, 2L), (8L, 2L), (9L, 1L) as t(o, c)",
        "lineitem": """select o, 1L, 1L, 1, 2D, 10.5D * o, 0.1D, 0D, 'R', f, make_timestamp_ntz(1999, 1, cast(o as int), 0, 0, 0)
            from values (3L, 'F'), (4L, 'F'), (6L, 'F'), (8L, 'F'), (9L, 'F') as t(o, f)""",
    }
    for name, sql in tables.items():
        spark.sql(sql).toDF(*[c.split()[0] for c in S.STAR[name].split(", ")]).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_lines_are_summed_to_the_month_before_fact_and_branch_feed(spark, tmp_path):
    d = star_rows(spark, tmp_path)
    months = star.booked_months(spark, d)
    assert months.count() == 4  # two nations, with and without head office; five lines, each with a day of its own
    fact, branch = Q._fact_and_branch(spark, d)
    assert sorted(map(tuple, fact.collect()), key=str) == sorted(map(tuple, star.promo_fact(spark, d).select(*fact.columns).collect()), key=str)
    assert fact.count() == 1
    shares = [sorted(map(tuple, B.key_shares(b).collect()), key=str) for b in (branch, Q._branch(spark, d))]
    assert shares[0] == shares[1] and len(shares[0]) == 6


def test_lines_are_not_shuffled_to_meet_suppliers(spark, tmp_path):
    d = star_rows(spark, tmp_path)
    many = spark.sql("select 1 + id, uuid(), cast(1 + id % 2 as int), rand() from range(20000)").toDF(*[c.split()[0] for c in S.STAR["supplier"].split(", ")])
    many.coalesce(1).write.mode("overwrite").parquet(f"{d}/supplier.parquet")
    for made in (star.promo_fact(spark, d), star.booked_months(spark, d)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(" in plan and "hashpartitioning(l_suppkey" not in plan


def test_lines_travel_with_their_discount(spark, tmp_path):
    d = star_rows(spark, tmp_path)
    months = star.booked_months(spark, d)
    _, dealt = months._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    below = dealt.splitlines()[1]
    assert "l_discount" in below and "spends" not in below
    booked = sum(r["spends"] for r in months.collect())
    assert float(booked) / 10000 == pytest.approx(sum(r["spends"] for r in star.promo_lines(spark, d).collect()), abs=1e-3) and booked > 0


def test_months_laid_out_by_key_hash_are_shared_out_without_a_shuffle(spark, tmp_path):
    d = star_rows(spark, tmp_path)
    shared = Q._shared(spark, d).select("key_hash", *S.KEY10, "modelingname", "price", *S.MEASURES, "old_planningcustomer", "ini_contri", "add_contri")
    rows = B.apportion_groups(B.unpivot_shares(Q.settle(shared, by="key_hash")), ["key_hash", *KEY], S.MEASURES)
    for made in (shared, rows):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert all("old_planningcustomercd" in line for line in plan.splitlines() if "Exchange hash" in line)  # names of customers alone
    fact, branch = Q._fact_and_branch(spark, d)
    plain = B.apportion_groups(B.unpivot_shares(B.branch_share(branch, B.nonzero_spend_rows(fact))), KEY, S.MEASURES).drop("business")
    assert rows.count() > 0
    assert sorted(map(str, rows.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_keys_of_two_offices_share_no_hash(spark, tmp_path):
    d = star_rows(spark, tmp_path)
    more = {
        "region": "select * from values (0, 'R'), (1, 'S'), (2, null) as t(k, n)",
        "nation": "select * from values (1, 'N', 0), (2, 'N', 0), (3, 'M', 1), (4, 'L', 2) as t(k, n, r)",
        "supplier": "select k, 's', n, 0D from values (1L, 1), (2L, 3), (3L, 4) as t(k, n)",
        "lineitem": """select o, 1L, s, 1, 2D, 10.5D * o, 0.1D, 0D, 'R', 'F', timestamp_ntz'1999-01-02 00:00:00'
            from values (3L, 1L), (4L, 1L), (4L, 2L), (6L, 2L), (6L, 3L), (8L, 3L) as t(o, s)""",
    }
    for name, sql in more.items():
        spark.sql(sql).toDF(*[c.split()[0] for c in S.STAR[name].split(", ")]).write.mode("overwrite").parquet(f"{d}/{name}.parquet")
    found = []
    for fixed in (True, False):
        fact, branch = Q._hashed_fact_and_branch(spark, d, fixed_offices=fixed)
        for rows, keys in ((fact, S.KEY5), (branch, ["year", "month", "segment", "shishanm", "new_planningcustomer"])):
            found.append((rows.select(*keys).distinct().count(), rows.select("key_hash").distinct().count()))
    assert found == [(3, 3), (3, 3), (3, 1), (3, 1)]
    shared = Q._shared(spark, d)
    plain = B.branch_share(*[t(spark, d) for t in (Q._branch, lambda *a: B.nonzero_spend_rows(star.promo_fact(*a)))])
    columns = [*S.KEY10, "old_planningcustomer", "ini_contri", "add_contri", "spends"]
    assert sorted(map(str, shared.select(*columns).collect())) == sorted(map(str, plain.select(*columns).collect()))


def test_hashed_keys_join_with_null_equal_to_null(spark):
    left, right = (spark.sql(f"select * from values (1L, 'a', 1), (1L, null, 2), (1L, 'b', 3), (2L, 'a', 4) as t(key_hash, k, {c})") for c in "xy")
    for how in ("inner", "left", "outer", "left_semi", "left_anti"):
        got, plain = (B.join_keys(l, r, keys, how).drop("key_hash", "h") for l, r, keys in (
            (left, right.filter("y != 3"), ["key_hash", "k"]),
            (left.withColumnRenamed("key_hash", "h"), right.filter("y != 3").withColumnRenamed("key_hash", "h"), ["h", "k"])))
        assert got.columns == plain.columns
        if how != "outer":
            tables = [Q.settle(t, by="key_hash").hint("merge") for t in (left, right)]
            assert "Exchange" not in B.join_keys(*tables, ["key_hash", "k"], how)._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
