"""DuckDB twins of the registered queries, written with window functions and plain joins.

Statements are assembled from named common table expressions; each statement only
carries the expressions it needs.
"""

from __future__ import annotations

import re

# --- small text helpers ----------------------------------------------------------------

DIMS = "business, category, subcategory, segment, shisha, cluster, channel, planningcustomer"
KEY10 = f"year, month, {DIMS}"
KEY5 = "year, month, segment, shisha, planningcustomer"
MEASURES = ["spends", "netsales", "gps", "volume"]
TYPES = "('PRICEOFF','PROMOTIONAD','LIQUIDATION')"
NON_DRIVER = "('Base_BasePrice','Volume','PREDICTED_SALES')"
TOTALS = "('Volume','PREDICTED_SALES')"
S1 = "shisha, planningcustomer"
S2 = "segment, shisha, planningcustomer"
SPEND_NAMES = {"po": "priceoff", "liq": "liquidation", "pa": "promotionad"}


def rd(x: str, dp: int = 4) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,9)), {dp}) AS DOUBLE)"


def es(x: str, scale: int = 4) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,{scale}))) AS DOUBLE)"


def av(x: str) -> str:
    return f"(CAST(sum(CAST({x} AS DECIMAL(28,9))) AS DOUBLE) / nullif(count({x}), 0))"


def div(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) <> 0 THEN ({n}) / ({d}) END)"


def div0(n: str, d: str, dp: int | None = None) -> str:
    q = f"({n}) / ({d})"
    return f"(CASE WHEN ({d}) <> 0 THEN {rd(q, dp) if dp is not None else q} ELSE 0.0 END)"


def month_end(y: str, m: str) -> str:
    return f"(CAST(last_day(make_date({y}, {m}, 1)) AS VARCHAR) || ' 23:59:59')"


def rounded(columns: str, dp: int) -> str:
    return ", ".join(f"{rd(c.strip(), dp)} AS {c.strip()}" for c in columns.split(","))


CTES: dict[str, str] = {}
#: Expressions that several others read; computed once.
SHARED = {"x_fact", "x_lines", "x_branch", "x_coef1", "x_coef2", "x_base1", "x_stage1", "x_pushed", "x_stage2", "x_long2", "x_rework",
          "xb_fit", "xb_coef1", "xb_coef2", "xb_base1", "xb_stage1", "xb_pushed", "xb_cand2", "xb_stage2", "xb_final"}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def stmt(select: str) -> str:
    """``select`` preceded by every common table expression it reaches, in order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        for word in set(re.findall(r"[a-z_0-9]+", todo.pop())):
            if word in CTES and word not in needed:
                needed.add(word)
                todo.append(CTES[word])
    parts = [f"{n} AS {'MATERIALIZED ' if n in SHARED else ''}({CTES[n]})" for n in CTES if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


# --- inputs ----------------------------------------------------------------------------

cte("x_coded", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
  p_type AS category,
  CASE WHEN p_size <= 12 THEN 'XS' WHEN p_size <= 25 THEN 'S' WHEN p_size <= 37 THEN 'M' ELSE 'L' END AS pack,
  r_name AS shisha, cn.n_name AS cluster, c_mktsegment AS channel,
  CASE WHEN l_orderkey % 20 = 0 THEN 'Volume' WHEN l_orderkey % 20 = 1 THEN 'PREDICTED_SALES'
       WHEN l_orderkey % 20 = 2 THEN 'Base_BasePrice' WHEN l_returnflag = 'R' THEN 'PRICEOFF'
       WHEN l_returnflag = 'A' THEN 'PROMOTIONAD' WHEN l_linestatus = 'F' THEN 'LIQUIDATION'
       ELSE 'Own Price' END AS modelingname,
  l_extendedprice AS gps, l_extendedprice * l_discount AS spends, l_quantity, c_nationkey,
  0.4 * p_retailprice * l_quantity AS ec, l_orderkey, l_linenumber, l_linestatus, l_shipdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN region ON sn.n_regionkey = r_regionkey""")
cte("x_lines", f"""
SELECT *, CASE WHEN category IN ('ECONOMY','STANDARD','SMALL') THEN 'VALUE' ELSE 'CORE' END AS business,
  category || '/' || CASE WHEN pack IN ('XS','S') THEN 'SMALL PACK' ELSE 'LARGE PACK' END AS subcategory,
  category || '/' || pack AS segment, cluster || '#' || channel AS planningcustomer,
  CASE WHEN modelingname IN {TYPES} AND (l_quantity = 1 OR (c_nationkey % 12 = 5 AND channel = 'FURNITURE'))
       THEN 0.0 ELSE l_quantity END AS volume
FROM x_coded""")
_D = "CAST(sum(CAST({0} AS DECIMAL(18,4))) AS DECIMAL(28,4))"
cte("x_sums", f"""
SELECT {KEY10}, modelingname, {_D.format('spends')} AS s, {_D.format('gps')} AS g,
  {_D.format('volume')} AS v, {_D.format('ec')} AS e
FROM x_lines GROUP BY ALL""")
cte("x_fact", f"""
SELECT {KEY10}, modelingname, CAST(s AS DOUBLE) AS spends, CAST(g AS DOUBLE) AS gps,
  CAST(g - s AS DOUBLE) AS netsales, CAST(v AS DOUBLE) AS volume,
  {div('CAST(g AS DOUBLE)', 'CAST(v AS DOUBLE)')} AS price, CAST(e AS DOUBLE) AS ec,
  {div('CAST(e AS DOUBLE)', 'CAST(v AS DOUBLE)')} AS ec_per_qtycase, CAST(g - s - e AS DOUBLE) AS mc
FROM x_sums""")

# --- preparation -----------------------------------------------------------------------

_contri = {"spends": "spends_contri", "volume": "vol_contri", "gps": "gps_contri", "netsales": "ns_contri"}
cte("x_share", f"""
SELECT {KEY10}, modelingname, ec_per_qtycase, price, {', '.join(
    div0(m, f'CAST(sum(CAST({m} AS DECIMAL(28,4))) OVER k AS DOUBLE)', 3) + f' AS {n}' for m, n in _contri.items())}
FROM x_fact WHERE modelingname NOT IN {NON_DRIVER}
WINDOW k AS (PARTITION BY {KEY10})""")
cte("x_rolled", f"""
SELECT year, month, segment, shisha, planningcustomer, {es('spends')} AS total_spends,
  {es('gps')} AS total_salesamt, {es('volume')} AS total_salesqtycase
FROM x_lines WHERE modelingname IN {TYPES} GROUP BY ALL""")
cte("x_scaled0", f"""
SELECT s.*, coalesce(vol_contri * total_salesqtycase, 0) AS volume,
  coalesce(spends_contri * total_spends, 0) AS spends,
  coalesce(vol_contri * total_salesqtycase * price, 0) AS gps
FROM x_share s LEFT JOIN x_rolled USING ({KEY5})""")
cte("x_branch", f"""
SELECT CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') AS yearmonth, year, month,
  strftime(l_shipdate, '%Y-%m-%d') AS week_start, segment, shisha AS shishanm,
  planningcustomer AS new_planningcustomer,
  CASE WHEN l_orderkey % 3 = 0 THEN cluster || '#HO' WHEN l_orderkey % 7 = 0 THEN cluster || '#AREA'
       ELSE planningcustomer END AS old_planningcustomer,
  {', '.join(es(f"CASE WHEN modelingname = '{t.upper()}' AND l_linestatus = '{f}' THEN spends ELSE 0.0 END") + f" AS {k}_{t}"
             for t in SPEND_NAMES.values() for k, f in (('ini', 'F'), ('add', 'O')))}
FROM x_lines WHERE modelingname IN {TYPES} AND (gps <> 0 OR spends = 0) GROUP BY ALL""")
_money = [f"{k}_{t}" for t in SPEND_NAMES.values() for k in ("ini", "add")]


def _pair_totals(keys: str, where: str) -> str:
    parts = [
        f"""SELECT {keys}, old_planningcustomer, '{t.upper()}' AS modelingname,
        {es(f'ini_{t}')} AS im, {es(f'add_{t}')} AS am FROM (
          SELECT *, shishanm AS shisha, new_planningcustomer AS planningcustomer FROM x_branch) {where}
        GROUP BY ALL""" for t in SPEND_NAMES.values()
    ]
    return " UNION ALL ".join(parts)


cte("x_pairs", f"""
SELECT *, {div0('im', 'im + am', 3)} AS ini_contri, {div0('am', 'im + am', 3)} AS add_contri
FROM ({_pair_totals(KEY5, '')})""")
cte("x_spendrows", f"""
SELECT * FROM x_fact WHERE modelingname IN {TYPES} AND (spends <> 0 OR netsales <> 0 OR gps <> 0 OR volume <> 0)""")
cte("x_shared", f"""
SELECT f.*, p.old_planningcustomer, p.ini_contri, p.add_contri
FROM x_spendrows f LEFT JOIN x_pairs p USING ({KEY5}, modelingname)""")
cte("x_long", """
SELECT * EXCLUDE (ini_contri, add_contri), 'INI' AS contri_type, ini_contri AS contri_val FROM x_shared
UNION ALL
SELECT * EXCLUDE (ini_contri, add_contri), 'ADD' AS contri_type, add_contri AS contri_val FROM x_shared""")


def _groups(long: str, key: str) -> str:
    """Group label per key as a plain aggregate that is joined back."""
    return f"""
    SELECT {key}, CASE WHEN t = 0 THEN 'none' WHEN t < 2 THEN 'one' WHEN t > 2 THEN 'over'
      WHEN has_ini AND has_add THEN 'two' ELSE 'three' END AS share_group, t, n
    FROM (SELECT {key}, CAST(round(sum(CAST(coalesce(contri_val, 0) AS DECIMAL(28,9))), 3) AS DOUBLE) AS t,
        count(*) FILTER (WHERE contri_val <> 0) AS n,
        count(*) FILTER (WHERE contri_val <> 0 AND contri_type = 'INI') > 0 AS has_ini,
        count(*) FILTER (WHERE contri_val <> 0 AND contri_type = 'ADD') > 0 AS has_add
      FROM {long} GROUP BY {key})"""


_AKEY = f"{KEY5}, modelingname"
_WEIGHT = """CASE share_group WHEN 'three' THEN contri_val / n WHEN 'over' THEN contri_val / t
  ELSE contri_val END"""
cte("x_groups", _groups("x_long", _AKEY))
cte("x_apportioned", f"""
SELECT {KEY10}, modelingname, price, old_planningcustomer, contri_type, share_group, weight,
  {', '.join(rd(f'{m} * weight', 3) + f' AS {m}' for m in MEASURES)}
FROM (SELECT l.*, share_group, {_WEIGHT} AS weight FROM x_long l JOIN x_groups USING ({_AKEY})
      WHERE contri_val <> 0 AND share_group <> 'none' AND NOT (share_group = 'two' AND contri_val = 1))
UNION ALL
SELECT {KEY10}, modelingname, price, NULL, NULL, share_group, 1.0, {', '.join(MEASURES)}
FROM x_spendrows JOIN x_groups USING ({_AKEY}) WHERE share_group = 'none'""")
cte("x_conserved", f"""
WITH w AS (
  SELECT l.*, share_group, {_WEIGHT} AS w0, NOT (share_group = 'two' AND contri_val = 1) AS keep
  FROM x_long l JOIN x_groups USING ({_AKEY}) WHERE contri_val <> 0 AND share_group <> 'none'),
k AS (SELECT {_AKEY}, {es('w0', 9)} AS alls,
    CAST(sum(CAST(w0 AS DECIMAL(28,9))) FILTER (WHERE keep) AS DOUBLE) AS kept FROM w GROUP BY {_AKEY}),
s AS (SELECT w.*, CASE WHEN kept IS NULL THEN w0 / alls ELSE w0 / kept END AS weight
  FROM w JOIN k USING ({_AKEY}) WHERE keep OR kept IS NULL)
SELECT {KEY10}, modelingname, price, old_planningcustomer, contri_type, share_group, weight,
  {', '.join(rd(f'{m} * weight', 3) + f' AS {m}' for m in MEASURES)} FROM s
UNION ALL
SELECT {KEY10}, modelingname, price, NULL, NULL, share_group, 1.0, {', '.join(MEASURES)}
FROM x_spendrows JOIN x_groups USING ({_AKEY}) WHERE share_group = 'none'""")


def _reassigned(source: str) -> str:
    target = """CASE WHEN planningcustomer = old_planningcustomer OR contri_type = 'INI'
      THEN planningcustomer ELSE old_planningcustomer END"""
    dims9 = f"year, month, business, category, subcategory, segment, shisha, cluster, channel"
    return f"""
    SELECT {KEY10}, modelingname, {av('price')} AS price, {', '.join(es(m) + f' AS {m}' for m in MEASURES)}
    FROM (SELECT {dims9}, {target} AS planningcustomer, modelingname, price, {', '.join(MEASURES)}
          FROM {source} WHERE share_group <> 'none') GROUP BY {KEY10}, modelingname
    UNION ALL
    SELECT {KEY10}, modelingname, price, {', '.join(MEASURES)} FROM {source} WHERE share_group = 'none'"""


cte("x_reassigned", _reassigned("x_conserved"))
cte("x_half", "SELECT *, CASE WHEN month <= 6 THEN 'H1' ELSE 'H2' END AS half_year FROM x_fact")
_HKEY = f"year, half_year, {DIMS}"
_excl = {
    "PRICEOFF": "('PRICEOFF')", "PROMOTIONAD": "('PRICEOFF','PROMOTIONAD')", "LIQUIDATION": TYPES,
}
cte("x_hist", f"""
WITH b AS ({' UNION ALL '.join(
    f"SELECT {_HKEY}, '{t}' AS modelingname, {es('volume')} AS bv FROM x_half "
    f"WHERE modelingname NOT IN {TOTALS} AND modelingname NOT IN {x} GROUP BY ALL" for t, x in _excl.items())}),
s AS (SELECT {_HKEY}, modelingname, {', '.join(es(m) + f' AS {m}' for m in MEASURES)}, {av('price')} AS price
  FROM x_half WHERE modelingname IN {TYPES} GROUP BY ALL)
SELECT 'HISTORICAL_DATA' AS scenario_name, CAST(s.year + 1 AS INTEGER) AS year, half_year,
  {month_end('s.year + 1', "CASE WHEN half_year = 'H1' THEN 6 ELSE 12 END")} AS date, {DIMS}, modelingname,
  bv AS baseline_volume, price, coalesce(spends, 0) AS total_initial_spend,
  coalesce(volume + bv, 0) AS total_initial_volume, coalesce((volume + bv) * price, 0) AS total_initial_gps,
  coalesce((volume + bv) * price - spends, 0) AS total_initial_netsales, 1 AS is_latest
FROM s LEFT JOIN b USING ({_HKEY}, modelingname)""")
cte("x_output", f"""
SELECT year, half_year, {DIMS}, modelingname, {es('spends')} AS optimized_spends, max(month) AS month,
  CASE WHEN year % 2 = 0 THEN 'HISTORICAL_DATA' ELSE 'SCN_' || category END AS scenario_name,
  {month_end('year', 'max(month)')} AS date, 1 AS is_latest
FROM x_half WHERE modelingname IN {TYPES} AND spends <> 0 GROUP BY year, half_year, {DIMS}, modelingname""")
_HVALS = """baseline_volume, price, total_initial_spend, total_initial_volume, total_initial_gps,
  total_initial_netsales"""
cte("x_own", f"""
SELECT segment, {div("sum(v) FILTER (WHERE modelingname = 'Own Price')", "sum(v)")} * 100 AS own_price_contri
FROM (SELECT segment, modelingname, {es('volume')} AS v FROM x_lines
      WHERE modelingname NOT IN {NON_DRIVER} GROUP BY ALL)
GROUP BY segment HAVING count(*) FILTER (WHERE modelingname = 'Own Price') > 0""")
cte("x_effect", """
SELECT segment, pc AS price_change, pc * own_price_contri AS multiplier
FROM (SELECT DISTINCT segment, CAST((ascii(segment) + length(segment)) % 7 - 3 AS DOUBLE) / 100.0 AS pc FROM x_lines)
JOIN x_own USING (segment)""")
_factor = """CASE modelingname WHEN 'PRICEOFF' THEN 1 + coalesce(multiplier, 0)
  WHEN 'Own Price' THEN 1 - coalesce(multiplier, 0) ELSE 1.0 END"""
cte("x_repriced", f"""
SELECT {KEY10}, modelingname, spends, ec, ec_per_qtycase, mc, price * (1 + coalesce(price_change, 0)) AS price,
  gps * {_factor} AS gps, volume * {_factor} AS volume, netsales * {_factor} AS netsales
FROM x_fact LEFT JOIN x_effect USING (segment)""")

SQL: dict[str, str] = {}
SQL["contribution_share"] = stmt(f"""
SELECT {KEY10}, modelingname, {rounded('ec_per_qtycase, price, spends_contri, vol_contri, gps_contri, ns_contri', 6)}
FROM x_share""")
SQL["actuals_rollup"] = stmt("SELECT * FROM x_rolled")
SQL["rescale_to_actuals"] = stmt(f"""
SELECT {KEY10}, modelingname, {rounded('spends, gps, volume, price, ec_per_qtycase', 3)},
  {rd('gps - spends', 3)} AS netsales, {rd('ec_per_qtycase * volume', 3)} AS ec,
  {rd('gps - spends - ec_per_qtycase * volume', 3)} AS mc
FROM x_scaled0""")
SQL["normalise_period"] = stmt(f"""
SELECT CAST(year AS VARCHAR) AS year, lpad(CAST(month AS VARCHAR), 2, '0') AS month, {DIMS}, modelingname,
  spends, volume FROM x_fact""")
SQL["driver_share_pct"] = stmt(f"SELECT segment, {rd('own_price_contri', 6)} AS own_price_contri FROM x_own")
SQL["price_change_passthrough"] = stmt(f"""
SELECT {KEY10}, modelingname, {rounded('spends, ec, ec_per_qtycase, mc, price, gps, volume, netsales', 4)}
FROM x_repriced""")
SQL["branch_money_split"] = stmt(f"""
SELECT yearmonth, year, month, week_start, segment, shishanm, new_planningcustomer, old_planningcustomer,
  {', '.join(_money)} FROM x_branch""")
SQL["category_from_path"] = stmt(f"""
SELECT CASE WHEN contains(segment, 'ECONOMY') OR contains(segment, 'STANDARD') THEN 'LOW'
  WHEN contains(segment, 'PROMO') THEN 'PROMOTED' ELSE 'OTHER' END AS category,
  {', '.join(rd(es(c)) + f' AS {c}' for c in _money)},
  {', '.join(rd(f"{es(f'ini_{t}')} + {es(f'add_{t}')}") + f' AS new_{t}' for t in SPEND_NAMES.values())}
FROM x_branch GROUP BY 1""")
_fact_cols = f"{KEY10}, modelingname, spends, gps, netsales, volume, price, ec, ec_per_qtycase, mc"
SQL["null_profile"] = stmt(" UNION ALL ".join(
    f"SELECT '{c.strip()}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM x_fact"
    for c in _fact_cols.split(",")))
SQL["branch_share"] = stmt(f"""
SELECT {KEY10}, modelingname, old_planningcustomer, spends, ini_contri, add_contri FROM x_shared""")
SQL["unpivot_shares"] = stmt(f"""
SELECT {KEY10}, modelingname, old_planningcustomer, spends, contri_type, contri_val FROM x_long""")
SQL["apportion_groups"] = stmt(f"""
SELECT {KEY10}, modelingname, old_planningcustomer, contri_type, share_group,
  {rounded('weight, spends, netsales, gps, volume', 6)} FROM x_apportioned""")
_re_cols = f"{KEY10}, modelingname, {rounded('price, spends, netsales, gps, volume', 4)}"
SQL["apportion_conserving"] = stmt(f"""
SELECT {KEY10}, modelingname, old_planningcustomer, contri_type, share_group,
  {rounded('weight, spends, netsales, gps, volume', 6)} FROM x_conserved WHERE share_group <> 'none'""")
SQL["reallocation_check"] = stmt(" UNION ALL ".join(f"""
SELECT modelingname, '{m}' AS measure, {rd(es(m), 2)} AS before, true AS kept FROM x_spendrows GROUP BY modelingname"""
    for m in MEASURES))
SQL["reassign_branch"] = stmt(f"SELECT {_re_cols} FROM x_reassigned")
SQL["assemble_fact"] = stmt(f"""
SELECT {_re_cols} FROM (
  SELECT {KEY10}, modelingname, price, {', '.join(MEASURES)} FROM x_fact WHERE modelingname NOT IN {TYPES}
    AND (spends <> 0 OR netsales <> 0 OR gps <> 0 OR volume <> 0)
  UNION ALL SELECT * FROM x_reassigned)""")
_view_cols = f"""{month_end('year', 'month')} AS date, CAST(year AS VARCHAR) AS year,
  lpad(CAST(month AS VARCHAR), 2, '0') AS month, CASE WHEN month <= 6 THEN 1 ELSE 2 END AS half_year,
  {DIMS}, modelingname"""
SQL["decomp_view"] = stmt(f"""
SELECT {_view_cols}, {rounded('spends, gps, netsales, volume, price', 4)}, 0 AS ec, 0 AS ec_per_qtycase, 0 AS mc
FROM x_fact WHERE spends <> 0 OR volume <> 0 OR gps <> 0 OR netsales <> 0""")
SQL["history_baseline"] = stmt(f"""
SELECT scenario_name, year, half_year, date, {DIMS}, modelingname, {rounded(_HVALS, 4)}, is_latest FROM x_hist""")
SQL["publish_history"] = stmt(f"""
SELECT year, half_year, {DIMS}, modelingname, {rd('optimized_spends')} AS optimized_spends, month, scenario_name,
  date, 0 AS is_latest, {', '.join(f'CAST(NULL AS DOUBLE) AS {c.strip()}' for c in _HVALS.split(','))}
FROM x_output WHERE scenario_name <> 'HISTORICAL_DATA'
UNION ALL
SELECT year, half_year, {DIMS}, modelingname, NULL, NULL, scenario_name, date, is_latest, {rounded(_HVALS, 4)}
FROM x_hist""")
_imp = ["spends", "gps", "netsales"]
cte("x_modelled", f"""
SELECT {KEY5}, {', '.join(es(c) + f' AS m_{c}' for c in _imp)} FROM x_fact
WHERE modelingname NOT IN {TOTALS} GROUP BY ALL""")
cte("x_booked", f"""
SELECT {KEY5}, {es('spends')} AS a_spends, {es('gps')} AS a_gps, {es('gps - spends')} AS a_netsales
FROM x_lines WHERE modelingname IN {TYPES} GROUP BY ALL""")
_scaled_by = lambda c: f"CASE WHEN m_{c} IS NOT NULL THEN {c} * coalesce({div(f'a_{c}', f'm_{c}')}, 1) ELSE 0 END"
SQL["ratio_impute"] = stmt(f"""
SELECT {KEY10}, modelingname, {', '.join(rd(_scaled_by(c)) + f' AS {c}' for c in _imp)},
  {rounded('volume, ec, mc', 4)}, {rd('coalesce(price, 0)')} AS price, {rd('coalesce(ec_per_qtycase, 0)')} AS ec_per_qtycase
FROM x_fact LEFT JOIN x_modelled USING ({KEY5}) LEFT JOIN x_booked USING ({KEY5})""")
_VK = f"date, year, month, half_year, {DIMS}, modelingname"
_VV = ["spends", "gps", "netsales", "volume", "price", "ec", "ec_per_qtycase", "mc"]
_SEG = "('SMALL/XS','SMALL/S','LARGE/M')"
cte("x_fresh", f"""
SELECT {KEY10}, modelingname, spends * 2 AS spends, gps * 2 AS gps, netsales * 2 AS netsales, volume * 2 AS volume,
  price, ec, ec_per_qtycase, mc
FROM x_fact WHERE modelingname NOT IN {TOTALS} AND segment IN {_SEG}""")
cte("x_replacement", f"""
SELECT {_view_cols}, {', '.join(_VV)} FROM (
  SELECT {KEY10}, modelingname, {', '.join(_VV)} FROM x_fresh
  UNION ALL
  SELECT {KEY10}, label, {', '.join(es(m) + f' AS {m}' for m in _VV[:4])}, {', '.join(av(m) + f' AS {m}' for m in _VV[4:])}
  FROM x_fresh CROSS JOIN (VALUES ('Volume'), ('PREDICTED_SALES')) t(label) GROUP BY {KEY10}, label)""")
SQL["override_merge"] = stmt(f"""
SELECT {', '.join(f'coalesce(o.{k.strip()}, r.{k.strip()}) AS {k.strip()}' for k in _VK.split(','))},
  {', '.join(rd(f'''coalesce(CASE WHEN coalesce(o.segment, r.segment) IN {_SEG}
      THEN CASE WHEN coalesce(o.modelingname, r.modelingname) <> 'PREDICTED_SALES' THEN r.{c} ELSE coalesce(o.{c}, r.{c}) END
      ELSE o.{c} END, 0)''') + f' AS {c}' for c in _VV)}
FROM (SELECT {_view_cols}, spends, gps, netsales, volume, price, 0.0 AS ec, 0.0 AS ec_per_qtycase, 0.0 AS mc
      FROM x_fact WHERE (spends <> 0 OR volume <> 0 OR gps <> 0 OR netsales <> 0)) o
FULL JOIN x_replacement r ON {' AND '.join(f'o.{k.strip()} = r.{k.strip()}' for k in _VK.split(','))}""")
_TEXT = "format('{{:,.2f}}', {0})"


def _reconciled(before: str, after: str, keys: str) -> str:
    """Totals of both sides per key and measure; keys of one side only keep the other at 0."""
    listed = keys + ", " if keys else ""
    sides = f"""(SELECT {listed}true AS f, {', '.join(MEASURES)} FROM {before}
      UNION ALL SELECT {listed}false, {', '.join(MEASURES)} FROM {after})"""
    return " UNION ALL ".join(f"""
    SELECT {listed}'{m}' AS measure, {rd('b', 2)} AS before, {rd('a', 2)} AS after, {rd('a - b', 2)} AS diff,
      {_TEXT.format('a')} AS after_text, rows_before, rows_after
    FROM (SELECT {listed}coalesce(CAST(sum(CAST({m} AS DECIMAL(28,4))) FILTER (WHERE f) AS DOUBLE), 0) AS b,
        coalesce(CAST(sum(CAST({m} AS DECIMAL(28,4))) FILTER (WHERE NOT f) AS DOUBLE), 0) AS a,
        count(*) FILTER (WHERE f) AS rows_before, count(*) FILTER (WHERE NOT f) AS rows_after
      FROM {sides} {'GROUP BY ' + keys if keys else ''})""" for m in MEASURES)


SQL["reconcile_totals"] = stmt(_reconciled("x_fact", "x_repriced", "year, category"))
SQL["reconcile_grand_total"] = stmt(_reconciled("x_fact", "x_repriced", ""))
cte("x_monthly", "SELECT *, CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') AS yearmonth FROM x_fact")
SQL["reconcile_months"] = stmt(_reconciled("x_monthly", f"(SELECT * FROM x_monthly WHERE modelingname IN {TYPES})", "yearmonth"))
cte("x_requests", f"""
WITH g AS (SELECT business, category, modelingname, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channel,
    string_agg(DISTINCT shisha, ',' ORDER BY shisha) AS shisha, {es('spends')} AS budget,
    max(make_date(year, month, 1)) AS d FROM x_fact WHERE modelingname IN {TYPES} GROUP BY ALL)
SELECT 'uid' || substr(md5(category || ' ' || modelingname), 1, 12) AS uid, category || ' ' || modelingname AS scenario_name,
  category || modelingname AS table_suffix, business, modelingname AS spend_type, channel, category, shisha,
  CAST(make_date(year(d), greatest(month(d) - 5, 1), 1) AS VARCHAR) || ' 00:00:00' AS period_start,
  CAST(last_day(d) AS VARCHAR) || ' 23:59:59' AS period_end,
  CASE modelingname WHEN 'PRICEOFF' THEN '2' WHEN 'PROMOTIONAD' THEN '3' END AS strategy,
  CASE modelingname WHEN 'PROMOTIONAD' THEN '1' END AS sub_strategy,
  CASE modelingname WHEN 'PROMOTIONAD' THEN budget END AS goal_spend, d
FROM g""")
SQL["scenario_params"] = stmt(f"SELECT * EXCLUDE (d, goal_spend), {rd('goal_spend')} AS goal_spend FROM x_requests")
SQL["last_year_period"] = stmt("""
SELECT uid, scenario_name, CAST(i AS INTEGER) AS position,
  CAST(make_date(year(d) - 1, month(d) - i, 1) AS VARCHAR) AS month_start
FROM x_requests, range(0, 6) t(i) WHERE month(d) - i >= greatest(month(d) - 5, 1)""")

# --- scope and response model ----------------------------------------------------------

_CATS = "('ECONOMY','SMALL','STANDARD')"
cte("x_fitrows", f"""
SELECT * FROM x_fact WHERE business = 'VALUE' AND category IN {_CATS} AND modelingname = 'PRICEOFF'
  AND spends > 0 AND volume >= 0""")
cte("x_period", "SELECT * FROM x_fact WHERE year = 1999 AND month BETWEEN 1 AND 6")
cte("x_scope", f"""
SELECT * FROM x_period WHERE business = 'VALUE' AND category IN {_CATS} AND modelingname = 'PRICEOFF'
  AND spends > 0 AND volume >= 0""")
cte("x_spendpos", f"SELECT * FROM x_fact WHERE modelingname IN {TYPES} AND spends > 0 AND volume > 0")
_START = "CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-01'"
FITK = "modelingname, shisha, planningcustomer"


def _rank(keys: str, m: str) -> str:
    return f"""((rank() OVER (PARTITION BY {keys} ORDER BY {m}) + (count(*) OVER (PARTITION BY {keys}, {m}) - 1) / 2.0)
    / count(*) OVER (PARTITION BY {keys}))"""


def _fit(flt: str) -> dict[str, str]:
    f = f"FILTER (WHERE {flt})"
    flat = f"min(spends) {f} = max(spends) {f}"
    return {
        "slope": f"CASE WHEN {flat} THEN 0.0 ELSE regr_slope(ln(volume), ln(spends)) {f} END",
        "icept": f"greatest(CASE WHEN {flat} THEN avg(ln(volume)) {f} ELSE regr_intercept(ln(volume), ln(spends)) {f} END, 0.0)",
        "r2": f"""CASE WHEN count(*) {f} < 2 THEN NULL WHEN min(volume) {f} = max(volume) {f} THEN 1.0
            WHEN {flat} THEN 0.0 ELSE regr_r2(ln(volume), ln(spends)) {f} END""",
        "n": f"count(*) {f}",
    }


SQL["loglog_fit"] = stmt(f"""
SELECT {FITK}, min({_START}) AS first_sales_month, max({_START}) AS last_sales_month, count(*) AS number_of_rows,
  {rd(es('spends'), 6)} AS total_overall_spends, {rd(es('volume'), 6)} AS total_overall_volume,
  {rd(_fit('true')['r2'], 6)} AS r_squared, {rd(_fit('true')['icept'], 6)} AS intercept,
  {rd(_fit('true')['slope'], 6)} AS spends_coef
FROM x_spendpos GROUP BY {FITK}""")
SQL["pct_rank_avg"] = stmt(f"""
SELECT year, month, segment, {FITK}, {rounded('spends, volume', 6)}, {rd(_rank(FITK, 'spends'), 6)} AS pct_rank_spends,
  {rd(_rank(FITK, 'volume'), 6)} AS pct_rank_volume FROM x_spendpos""")
# Percentile pairs of the trimming corners, mildest first.
HI = [0.975, 0.95, 0.9, 0.85, 0.8, 0.75, 0.7]
LO = [0.025, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3]


def _trimmed(source: str, keys: str) -> str:
    """All fifteen fits side by side, then the documented choice."""
    cols = [f"{x} AS o_{k}" for k, x in _fit("true").items()]
    for i, (h, l) in enumerate(zip(HI, LO)):
        less = f"NOT ((ps >= {h} AND pv <= {l}) OR (ps <= {l} AND pv >= {h}))"
        more = f"NOT ((ps >= {h} AND pv >= {h}) OR (ps <= {l} AND pv <= {l}))"
        for tag, flt in (("l", less), ("m", more)):
            cols += [f"{x} AS {tag}{i}_{k}" for k, x in _fit(flt).items()]

    def pick(k: str) -> str:
        def last(tag: str) -> str:
            ok = " ".join(
                f"WHEN round({tag}{i}_slope, 6) > 0.1 AND round({tag}{i}_slope, 6) < 0.9 THEN "
                + (f"'{'augmented_less' if tag == 'l' else 'augmented_more'}" + (
                    f"[({h}, {l}), ({l}, {h})]'" if tag == "l" else f"[({h}, {h}), ({l}, {l})]'")
                   if k == "type" else f"{tag}{i}_{k}")
                for i, (h, l) in reversed(list(enumerate(zip(HI, LO)))))
            return f"CASE WHEN {tag}6_n = 0 THEN {orig} {ok} ELSE {orig} END"
        orig = "'Original'" if k == "type" else f"o_{k}"
        return f"CASE WHEN o_slope < 0 THEN {last('l')} WHEN o_slope > 1 THEN {last('m')} ELSE {orig} END"

    return f"""
    SELECT {keys}, first_sales_month, last_sales_month, o_n AS number_of_rows,
      {pick('n')} AS number_of_rows_after_perct_rank, ts AS total_overall_spends, tv AS total_overall_volume,
      {pick('type')} AS model_type, {rd(pick('r2'), 6)} AS r_squared, {rd(pick('icept'), 6)} AS intercept,
      {rd(pick('slope'), 6)} AS spends_coef
    FROM (SELECT {keys}, min({_START}) AS first_sales_month, max({_START}) AS last_sales_month,
        {es('spends')} AS ts, {es('volume')} AS tv, {', '.join(cols)}
      FROM (SELECT *, {_rank(keys, 'spends')} AS ps, {_rank(keys, 'volume')} AS pv FROM {source}) GROUP BY {keys})"""


SQL["trim_refit"] = stmt(_trimmed("x_spendpos", FITK))
cte("x_spendnull", "SELECT * REPLACE (nullif(shisha, 'ASIA') AS shisha) FROM x_spendpos")
SQL["trim_refit_null_keys"] = stmt(_trimmed("x_spendnull", FITK))
cte("x_fitpos", "SELECT * FROM x_fitrows WHERE volume > 0")


def _fallback(keys: list[str], drops: list[str], tag: str, source: str = "x_fitpos", by: tuple[str, ...] = ()) -> None:
    cte(f"{tag}_l0", _trimmed(source, ", ".join([*by, *keys])))
    previous = f"{tag}_l0"
    rest = """first_sales_month, last_sales_month, number_of_rows, number_of_rows_after_perct_rank,
      total_overall_spends, total_overall_volume, r_squared, intercept"""
    for i, drop in enumerate(drops, start=1):
        kept = [*by, *(k for k in keys if k != drop)]
        cte(f"{tag}_c{i}", _trimmed(source, ", ".join(kept)))
        cte(f"{tag}_l{i}", f"""
        SELECT {', '.join('b.' + k for k in (*by, *keys))}, {', '.join('b.' + c.strip() for c in rest.split(','))},
          CASE WHEN b.spends_coef BETWEEN 0.1 AND 0.9 THEN b.model_type
               ELSE 'Without_{drop.upper()}_Level_Model_Augmented' END AS model_type,
          CASE WHEN b.spends_coef BETWEEN 0.1 AND 0.9 THEN b.spends_coef ELSE c.spends_coef END AS spends_coef
        FROM {previous} b LEFT JOIN {tag}_c{i} c ON {' AND '.join(f'b.{k} = c.{k}' for k in kept)}""")
        previous = f"{tag}_l{i}"


_fallback(["shisha", "planningcustomer"], ["shisha", "planningcustomer"], "x_f")
_fallback(["segment", "shisha", "planningcustomer"], ["shisha", "segment", "planningcustomer"], "x_g")
SQL["hierarchical_fallback"] = stmt("SELECT * FROM x_f_l2")
SQL["hierarchical_fallback_stage2"] = stmt("SELECT * FROM x_g_l3")


def _zero(source: str, keys: str) -> str:
    return f"""
    SELECT {keys}, '' AS first_sales_month, '' AS last_sales_month, count(*) AS number_of_rows,
      CAST(0 AS BIGINT) AS number_of_rows_after_perct_rank, {es('spends')} AS total_overall_spends,
      {es('volume')} AS total_overall_volume, 'Spends_more_than_0_and_Volume_0' AS model_type,
      0.0 AS r_squared, 0.0 AS intercept, 0.0 AS spends_coef
    FROM {source} WHERE spends > 0 AND volume = 0 GROUP BY {keys}"""


def _consolidated(model: str, keys: str, rows: str = "x_fitrows") -> str:
    cols = f"""{keys}, first_sales_month, last_sales_month, number_of_rows, number_of_rows_after_perct_rank,
      total_overall_spends, total_overall_volume, model_type, CAST(r_squared AS DOUBLE) AS r_squared,
      CAST(intercept AS DOUBLE) AS intercept, CAST(spends_coef AS DOUBLE) AS spends_coef"""
    return f"""
    SELECT {keys}, max(first_sales_month) AS first_sales_month, max(last_sales_month) AS last_sales_month,
      CAST(sum(number_of_rows) AS BIGINT) AS number_of_rows,
      CAST(sum(number_of_rows_after_perct_rank) AS BIGINT) AS number_of_rows_after_perct_rank,
      {es('total_overall_spends')} AS total_overall_spends, {es('total_overall_volume')} AS total_overall_volume,
      string_agg(model_type, ',' ORDER BY model_type) AS model_type, {es('r_squared', 6)} AS r_squared,
      {es('intercept', 6)} AS intercept, {es('spends_coef', 6)} AS spends_coef
    FROM (SELECT {cols} FROM {model} UNION ALL SELECT {cols} FROM ({_zero(rows, keys)})) GROUP BY {keys}"""


SQL["zero_response_keys"] = stmt(_zero(f"(SELECT * FROM x_fact WHERE modelingname IN {TYPES})", FITK))
cte("x_coef1", _consolidated("x_f_l2", S1))
cte("x_coef2", _consolidated("x_g_l3", S2))
cte("x_coef2d", f"""
SELECT c.*, d.business, d.category, d.subcategory, d.cluster, d.channel
FROM x_coef2 c LEFT JOIN (SELECT DISTINCT {DIMS} FROM x_fitrows) d USING ({S2})""")
SQL["consolidate_models"] = stmt("SELECT * FROM x_coef1")
SQL["attach_dimensions"] = stmt("SELECT * FROM x_coef2d")

# --- allocation ------------------------------------------------------------------------

L = "last_year_period_"


def _with(by: str, columns: str) -> str:
    return f"{by}, {columns}" if by else columns


def _base1(coefficients: str, scope: str, by: str = "") -> str:
    return f"""
    WITH t AS (SELECT {_with(by, 'shisha, channel, planningcustomer')}, {', '.join(rd(es(m), 3) + f' AS {m}' for m in MEASURES)},
      {rd(av('price'), 3)} AS price FROM {scope} GROUP BY ALL)
    SELECT {_with('c.' + by if by else '', 'c.shisha, c.planningcustomer')}, channel, c.spends_coef, coalesce(spends, 0) AS {L}spends,
      coalesce(volume, 0) AS {L}volume, coalesce(gps, 0) AS {L}gps, coalesce(gps, 0) - coalesce(spends, 0) AS {L}netsales,
      coalesce(price, 0) AS price, coalesce({div0('gps - spends', 'gps', 3)}, 0) AS ns_to_gps
    FROM {coefficients} c LEFT JOIN t USING ({_with(by, S1)})"""


cte("x_base1", _base1("x_coef1", "x_scope"))
_b1 = f"spends_coef, {L}spends, {L}volume, {L}gps, {L}netsales, price, ns_to_gps"
SQL["stage1_baseline"] = stmt(f"SELECT shisha, channel, planningcustomer, {rounded(_b1, 6)} FROM x_base1")
SQL["split_optimisable"] = stmt(f"""
SELECT shisha, channel, planningcustomer, {rounded(_b1, 6)},
  CASE WHEN {L}volume > 0 THEN 'optimise' ELSE 'carry' END AS treatment FROM x_base1 WHERE {L}spends > 0""")


def _calibrated(source: str) -> str:
    return f"""
    SELECT *, {div(f'{L}netsales', f'{L}netsales_calc')} AS adjustment_factor FROM (
      SELECT *, backcalc_intercept * pow({L}spends, spends_coef) * price * ns_to_gps AS {L}netsales_calc FROM (
        SELECT *, greatest({L}volume / pow({L}spends, spends_coef), 0.0) AS backcalc_intercept
        FROM {source} WHERE {L}spends > 0 AND {L}volume > 0))"""


cte("x_items1", _calibrated("x_base1"))
SQL["back_calibrate"] = stmt(f"""
SELECT {S1}, {rounded(f'backcalc_intercept, {L}netsales_calc, adjustment_factor', 3)} FROM x_items1""")


def _respond(source: str, spend: str, sfx: str = "") -> str:
    s0, v0, g0 = (f"{L}{m}{sfx}" for m in ("spends", "volume", "gps"))
    v = f"{v0} * (1 + spend_change * spends_coef)"
    return f"""
    SELECT *, optimized_gps - {spend} AS optimized_netsales FROM (
      SELECT *, {div(f'optimized_volume * {g0}', v0)} AS optimized_gps FROM (
        SELECT *, {v} AS optimized_volume FROM (
          SELECT *, {div(f'{spend} - {s0}', s0)} AS spend_change FROM {source})))"""


SQL["response_net_sales"] = stmt(f"""
SELECT {S1}, {rounded('plan, spend_change, optimized_volume, optimized_gps, optimized_netsales', 3)}
FROM ({_respond(f'(SELECT *, {L}spends * 1.05 AS plan FROM x_items1)', 'plan')})""")


def _box(source: str, sfx: str = "") -> str:
    return f"""SELECT *, spends_ub - spends_lb AS rng FROM (
      SELECT *, {L}spends * 0.9 AS spends_lb, {L}spends * 1.1 AS spends_ub,
        coalesce(spends_coef * {div(f'{L}gps{sfx}', f'{L}spends{sfx}')} - 1, -1.0) AS slope FROM {source})"""


def _alloc(source: str, group: str, sfx: str, low: str, high: str, fills: dict[str, str]) -> str:
    """Greedy fill: range of strictly better items first, ties share what is left."""
    part = f"PARTITION BY {group}" if group else ""
    m = lambda x: f"CAST(sum(CAST({x} AS DECIMAL(28,9))) OVER ({part}) AS DOUBLE)"
    per = f"{part + ',' if part else 'PARTITION BY'} slope"
    inner = f"""
    SELECT *, {m('spends_lb')} AS lb, {m('spends_ub')} AS ub, {m(f'{L}spends')} AS centre,
      {m(f'{L}spends{sfx}')} AS old, {m('CASE WHEN slope > 0 THEN rng ELSE 0 END')} AS gainful,
      CAST(sum(CAST(rng AS DECIMAL(28,9))) OVER ({per}) AS DOUBLE) AS tie,
      CAST(sum(CAST(rng AS DECIMAL(28,9))) OVER ({part} ORDER BY slope DESC
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS upto
    FROM ({_box(source, sfx)})"""
    return " UNION ALL ".join(f"""
    SELECT * EXCLUDE (lb, ub, centre, old, gainful, tie, upto, rng, lo, hi), '{p}' AS policy,
      greatest(lo, lb) <= least(hi, ub) + 1e-6 AS feasible,
      {rd(f'spends_lb + rng * greatest(0.0, least(1.0, ({f} - (upto - tie)) / tie))', 6)} AS optimized_spends
    FROM (SELECT *, {low} AS lo, {high} AS hi FROM ({inner}))""" for p, f in fills.items())


MAXNS, FIRST = "least(hi - lb, greatest(gainful, lo - lb))", "hi - lb"
cte("x_alloc1", _alloc("x_items1", "", "", "0.0", "centre", {"max_net_sales": MAXNS}))
cte("x_goal1", _alloc("x_items1", "", "", "centre * 1.02", "centre * 1.02", {"max_net_sales": MAXNS}))
cte("x_goal2", _alloc("x_items1", "", "", "centre * 1.25", "centre * 1.25", {"max_net_sales": MAXNS}))
cte("x_itemsnull", "SELECT * REPLACE (nullif(shisha, 'ASIA') AS shisha) FROM x_items1")
cte("x_allocnull", _alloc("x_itemsnull", "shisha", "", "0.0", "centre", {"max_net_sales": MAXNS}))
_al = f"policy, feasible, {rounded('slope, spends_lb, spends_ub, optimized_spends', 3)}"
SQL["allocate_stage1"] = stmt(f"SELECT {S1}, {_al} FROM x_alloc1")
SQL["allocate_goal"] = stmt(f"SELECT {S1}, {_al} FROM x_goal1")
SQL["allocate_broken_goal"] = stmt(f"SELECT {S1}, {_al} FROM x_goal2")
SQL["allocate_null_keys"] = stmt(f"SELECT {S1}, {_al} FROM x_allocnull")


def _target(growth: float, exact: bool) -> str:
    down = "need" if not exact else "-need"
    m = lambda x: f"CAST(sum(CAST({x} AS DECIMAL(28,9))) OVER (PARTITION BY shisha) AS DOUBLE)"
    amount = f"CASE WHEN slope > 0 THEN need ELSE {down if exact else '0.0'} END"
    reach = f"CASE WHEN need > 0 THEN up ELSE {'down' if exact else 'abs(need)'} END"
    return f"""
    SELECT {S1}, {rd('slope', 3)} AS slope, abs(need) <= {reach} + 1e-6 AS feasible,
      {rd(rd(f'spends_lb + rng * CASE WHEN tie > 0 THEN greatest(0.0, least(1.0, ({amount} - (upto - tie)) / tie)) ELSE 0.0 END', 6), 3)} AS optimized_spends
    FROM (SELECT *, {m(f'{L}netsales')} * (1 + {growth}) - {m('optimized_netsales')} AS need,
        {m('CASE WHEN slope > 0 THEN worth ELSE 0 END')} AS up,
        {m('CASE WHEN slope < 0 THEN worth ELSE 0 END')} AS down,
        CAST(sum(CAST(worth AS DECIMAL(28,9))) OVER (PARTITION BY shisha, slope > 0, abs(slope)) AS DOUBLE) AS tie,
        CAST(sum(CAST(worth AS DECIMAL(28,9))) OVER (PARTITION BY shisha, slope > 0 ORDER BY abs(slope) DESC
          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS upto
      FROM (SELECT *, abs(slope) * rng AS worth FROM ({_respond(f"({_box('x_items1')})", 'spends_lb')})))"""


SQL["min_spend_for_target"] = stmt(_target(0.0, False))
SQL["exact_growth_target"] = stmt(_target(-0.01, True))
_tail = f"""spends_coef, price, ns_to_gps, backcalc_intercept, {L}netsales_calc, adjustment_factor, spends_lb,
  spends_ub, optimized_spends, optimized_volume, optimized_gps, optimized_netsales, optimized_netsales_adj,
  spend_change, vol_change, ns_change"""
_ly = ", ".join(f"{L}{m}" for m in ("spends", "volume", "gps", "netsales"))
_lyo = ", ".join(f"{L}{m}_old" for m in ("spends", "volume", "gps", "netsales"))


def _projected(source: str, sfx: str) -> str:
    return f"""
    SELECT * EXCLUDE (optimized_netsales, optimized_gps), coalesce(optimized_gps, 0) AS optimized_gps,
      coalesce(optimized_gps, 0) - optimized_spends AS optimized_netsales,
      (coalesce(optimized_gps, 0) - optimized_spends) * adjustment_factor AS optimized_netsales_adj,
      {div(f'optimized_volume - {L}volume{sfx}', f'{L}volume{sfx}')} AS vol_change,
      {div(f'coalesce(optimized_gps, 0) - optimized_spends - {L}netsales{sfx}', f'{L}netsales{sfx}')} AS ns_change
    FROM ({_respond(source, 'optimized_spends', sfx)})"""


def _carried(source: str, sfx: str) -> str:
    return f"""
    SELECT *, 0.0 AS backcalc_intercept, 0.0 AS {L}netsales_calc, 0.0 AS adjustment_factor,
      {L}spends * 0.9 AS spends_lb, {L}spends * 1.1 AS spends_ub, {L}spends AS optimized_spends,
      {L}volume AS optimized_volume, {L}gps AS optimized_gps, {L}netsales AS optimized_netsales,
      0.0 AS optimized_netsales_adj, {div(f'{L}spends - {L}spends{sfx}', f'{L}spends{sfx}')} AS spend_change,
      0.0 AS vol_change, 0.0 AS ns_change, true AS feasible FROM {source} WHERE {L}spends > 0 AND {L}volume = 0"""


_s1cols = f"shisha, channel, planningcustomer, feasible, {_ly}, {_tail}"
cte("x_stage1", f"""
SELECT {_s1cols} FROM ({_projected('x_alloc1', '')}) UNION ALL SELECT {_s1cols} FROM ({_carried('x_base1', '')})""")
_s1out = f"shisha, channel, planningcustomer, feasible, {rounded(f'{_ly}, {_tail}', 3)}"
SQL["project_optimised"] = stmt(f"SELECT {_s1out} FROM ({_projected('x_alloc1', '')})")
SQL["carry_non_optimised"] = stmt(f"SELECT {_s1out} FROM ({_carried('x_base1', '')})")


def _cost(where: str) -> str:
    return f"""
    SELECT {S2}, {div0(es('ec'), es('volume'))} AS ec_per_qtycase
    FROM x_fact WHERE year = 1999 AND modelingname IN {where} AND spends > 0 AND volume >= 0 GROUP BY {S2}"""


SQL["cost_per_case"] = stmt(f"""
SELECT {S2}, {rd('ec_per_qtycase', 6)} AS ec_per_qtycase FROM ({_cost("('PRICEOFF','PROMOTIONAD')")})""")
cte("x_cost", _cost("('PRICEOFF')"))


def _pushed(coefficients: str, scope: str, stage1: str, cost: str, by: str = "") -> str:
    s1, s2 = _with(by, S1), _with(by, S2)
    return f"""
    WITH o AS (SELECT {s2}, {', '.join(rd(es(m), 3) + f' AS {m}' for m in MEASURES)}, {rd(av('price'), 3)} AS price
      FROM {scope} GROUP BY {s2}),
    r AS (SELECT c.*, {', '.join(f'coalesce({m}, 0) AS {L}{m}_old' for m in MEASURES)}, coalesce(price, 0) AS price
      FROM {coefficients} c LEFT JOIN o USING ({s2})),
    k AS (SELECT {s1}, {es(f'{L}spends_old', 9)} AS ts, {es(f'{L}volume_old', 9)} AS tv FROM r GROUP BY {s1}),
    p AS (SELECT r.*, coalesce({div0(f'{L}spends_old', 'ts')} * u.optimized_spends, 0) AS {L}spends,
        {div0(f'{L}volume_old', 'tv')} * u.optimized_volume AS {L}volume
      FROM r JOIN k USING ({s1}) LEFT JOIN (SELECT {s1}, optimized_spends, optimized_volume FROM {stage1}) u USING ({s1})),
    q AS (SELECT *, coalesce({div(f'{L}volume * {L}gps_old', f'{L}volume_old')}, 0) AS {L}gps FROM p)
    SELECT q.*, {L}gps - {L}spends AS {L}netsales, {div0(f'{L}gps - {L}spends', f'{L}gps', 3)} AS ns_to_gps, {cost}.ec_per_qtycase
    FROM q LEFT JOIN {cost} USING ({s2})"""


cte("x_pushed", _pushed("x_coef2d", "x_scope", "x_stage1", "x_cost"))
SQL["pushdown_stage1"] = stmt(f"""
SELECT segment || '$' || shisha || '$' || planningcustomer AS key_combination,
  shisha || '$' || planningcustomer AS key_combination1, {rounded(f'{_lyo}, {_ly}, ns_to_gps, ec_per_qtycase', 3)}
FROM x_pushed""")
cte("x_items2", f"SELECT * REPLACE ({L}gps_old - {L}spends_old AS {L}netsales_old) FROM ({_calibrated('x_pushed')})")
cte("x_cand2", _alloc("x_items2", S1, "_old", "old * 0.9", "least(centre, old * 1.1)", {"max_net_sales": MAXNS, "spend_first": FIRST}))
cte("x_alloc2", "SELECT * FROM x_cand2 WHERE policy = 'spend_first'")
SQL["allocate_stage2"] = stmt(f"SELECT {S2}, {_al} FROM x_alloc2")
_ch = lambda a, b: rd(div(f"{es(a, 9)} - {es(b, 9)}", es(b, 9)), 6)


def _chosen(candidates: str, by: str = "") -> str:
    """The best policy of every customer in the second stage."""
    s1 = _with(by, S1)
    return f"""
SELECT {s1}, policy, growth_percent, spend_percent, overall_spend_percent, accepted FROM (
  SELECT *, row_number() OVER (PARTITION BY {s1} ORDER BY accepted DESC, spend_percent DESC NULLS LAST,
    growth_percent DESC NULLS LAST, policy) AS place
  FROM (SELECT *, coalesce(spend_percent <= 0.005, false)
          AND abs(round(CAST(overall_spend_percent AS DECIMAL(28,9)), 1)) <= 0.1 AS accepted
    FROM (SELECT {s1}, policy, {_ch('optimized_netsales', f'{L}netsales')} AS growth_percent,
      {_ch('optimized_spends', f'{L}spends')} AS spend_percent,
      {_ch('optimized_spends', f'{L}spends_old')} AS overall_spend_percent
    FROM ({_respond(candidates, 'optimized_spends', '_old')}) GROUP BY {s1}, policy)))
WHERE place = 1"""


SQL["candidate_select"] = stmt(_chosen("x_cand2"))
_s2cols = f"{DIMS}, feasible, {_lyo}, {_ly}, ec_per_qtycase, {_tail}"


def _stage2(allocated: str, pushed: str, by: str = "") -> str:
    return f"""
    SELECT *, {L}volume_old * ec_per_qtycase AS ec, {L}netsales_old - {L}volume_old * ec_per_qtycase AS mc,
      optimized_volume * ec_per_qtycase AS ec_new, optimized_netsales_adj - optimized_volume * ec_per_qtycase AS mc_new
    FROM (SELECT {_with(by, _s2cols)} FROM ({_projected(allocated, '_old')})
          UNION ALL SELECT {_with(by, _s2cols)} FROM ({_carried(pushed, '_old')}))"""


cte("x_stage2", _stage2("x_alloc2", "x_pushed"))
_sum = lambda a, b: rd(div(f"{es(a, 9)} - {es(b, 9)}", es(b, 9)), 6)
SQL["stage_summary"] = stmt(f"""
SELECT {_sum('optimized_spends', f'{L}spends_old')} AS spend_change,
  {_sum('optimized_volume', f'{L}volume_old')} AS volume_change,
  {_sum('optimized_netsales_adj', f'{L}netsales_old')} AS netsales_change FROM x_stage2""")
SQL["infeasible_groups"] = stmt(f"""
SELECT {S1}, count(*) AS items, {', '.join(rd(es(c, 9), 3) + f' AS {c}' for c in ('spends_lb', 'spends_ub', 'optimized_spends'))}
FROM x_stage2 WHERE NOT feasible GROUP BY {S1}""")


def _mismatch(stage2: str) -> str:
    return f"""
    SELECT {S1}, {rd('a', 3)} AS {L}spends, {rd('b', 3)} AS optimized_spends, {rd('(b - a) / a * 100', 3)} AS change_perc
    FROM (SELECT {S1}, {es(f'{L}spends', 9)} AS a, {es('optimized_spends', 9)} AS b FROM {stage2} GROUP BY {S1})
    WHERE {rd('a', 0)} <> {rd('b', 0)}"""


SQL["spend_mismatch"] = stmt(_mismatch("x_stage2"))
cte("x_maxns2", "SELECT * FROM x_cand2 WHERE policy = 'max_net_sales'")
cte("x_saving2", _stage2("x_maxns2", "x_pushed"))
SQL["spend_mismatch_saved"] = stmt(_mismatch("x_saving2"))


def _guarded(stage2: str) -> str:
    changes = f"""
    SELECT * EXCLUDE (spend_change, vol_change, ns_change),
      {div(f'optimized_spends - {L}spends_old', f'{L}spends_old')} AS spend_change,
      {div(f'optimized_netsales - {L}netsales_old', f'abs({L}netsales_old)')} AS netsales_change FROM {stage2}"""
    reverted = ", ".join(f"CASE WHEN flag THEN {L}{m}_old ELSE optimized_{m} END AS optimized_{m}" for m in MEASURES)
    return f"""
    SELECT * EXCLUDE (flag) REPLACE ({reverted}), flag AS reverted
    FROM (SELECT *, coalesce(spend_change >= 0 AND netsales_change < 0, false) AS flag FROM ({changes}))"""


cte("x_guard", _guarded("x_stage2"))
SQL["guardrail_revert"] = stmt(f"""
SELECT {S2}, reverted, {rounded('spend_change, netsales_change, optimized_spends, optimized_volume, optimized_gps, optimized_netsales', 3)}
FROM x_guard""")


def _overlaid(guard: str, others: str, by: str = "", more: str = "", label: str = "'PRICEOFF' AS modelingname") -> str:
    return f"""
    WITH b AS (SELECT {_with(by, S2)}, {es('volume')} AS bv FROM {others} GROUP BY {_with(by, S2)}),
    a AS (SELECT {_with(by, DIMS)}, {more}optimized_spends, coalesce(bv, 0) AS baseline_volume, {L}spends_old AS total_initial_spend,
        {L}volume_old + coalesce(bv, 0) AS total_initial_volume, coalesce(optimized_spends, 0) AS total_optimized_spend,
        coalesce(optimized_volume, 0) + coalesce(bv, 0) AS total_optimized_volume,
        {L}gps_old AS g, {L}volume_old AS v FROM {guard} LEFT JOIN b USING ({_with(by, S2)})),
    c AS (SELECT *, coalesce({div('total_initial_volume * g', 'v')}, 0) AS total_initial_gps,
      coalesce({div('total_optimized_volume * g', 'v')}, 0) AS total_optimized_gps FROM a),
    e AS (SELECT *, total_initial_gps - total_initial_spend AS total_initial_netsales,
      total_optimized_gps - total_optimized_spend AS total_optimized_netsales FROM c)
    SELECT * EXCLUDE (g, v), {label}, {', '.join(
        f"coalesce({div(f'total_optimized_{m}', f'total_initial_{m}')} - 1, 0) AS final_{m}_change" for m in ('spend', 'volume', 'gps'))},
      coalesce({div('total_optimized_netsales - total_initial_netsales', 'abs(total_initial_netsales)')}, 0) AS final_netsales_change
    FROM e"""


cte("x_others", f"""SELECT * FROM x_period WHERE business = 'VALUE' AND category IN {_CATS}
  AND modelingname NOT IN ('Volume','PREDICTED_SALES','PRICEOFF')""")
cte("x_final", _overlaid("x_guard", "x_others"))
_fin = """baseline_volume, total_initial_spend, total_initial_volume, total_initial_gps, total_initial_netsales,
  total_optimized_spend, total_optimized_volume, total_optimized_gps, total_optimized_netsales,
  final_spend_change, final_volume_change, final_gps_change, final_netsales_change"""
SQL["baseline_overlay"] = stmt(f"SELECT {DIMS}, {rounded(_fin, 3)} FROM x_final")
cte("x_published", f"""
SELECT CAST(year AS INTEGER) AS year, half_year, {DIMS}, modelingname, optimized_spends, CAST(month AS INTEGER) AS month,
  scenario_name, date, CASE WHEN category IN {_CATS} AND business = 'VALUE' AND modelingname = 'PRICEOFF'
    AND substr(date, 1, 4) = '2000' AND substr(date, 6, 2) <= '06' THEN 0 ELSE is_latest END AS is_latest,
  {', '.join(f'CAST(NULL AS DOUBLE) AS {c.strip()}' for c in _fin.split(','))}
FROM x_output
UNION ALL
SELECT 2000, 'H1', {DIMS}, modelingname, optimized_spends, 6, 'VALUE_H1', '2000-06-30 23:59:59', 1, {_fin} FROM x_final""")
SQL["publish_scenario"] = stmt(f"""
SELECT year, half_year, {DIMS}, modelingname, {rd('optimized_spends', 3)} AS optimized_spends, month, scenario_name, date,
  is_latest, {rounded(_fin, 3)} FROM x_published""")
SQL["load_check"] = stmt("""
SELECT 'VALUE_H1' AS scenario_name, (SELECT count(*) FROM x_final) AS rows_written,
  count(*) FILTER (WHERE scenario_name = 'VALUE_H1') AS rows_loaded,
  count(*) FILTER (WHERE scenario_name = 'VALUE_H1') = (SELECT count(*) FROM x_final) AS loaded FROM x_published""")
SQL["status_upsert"] = stmt("""
SELECT 'SCN_' || CAST(o_custkey AS VARCHAR) AS scenarioname,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 0 END AS isoptimizationexecutioncompleted,
  (o_orderkey % 100 + 1) / 100.0 AS progressmessage
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders)
WHERE place = 1""")
cte("x_pairs2", f"""
SELECT *, {div0('im', 'im + am', 3)} AS ini_contri, {div0('am', 'im + am', 3)} AS add_contri
FROM ({_pair_totals(S2, 'WHERE year = 1999 AND month BETWEEN 1 AND 6')}) WHERE modelingname = 'PRICEOFF'""")
cte("x_long2", f"""
WITH j AS (SELECT s.*, p.old_planningcustomer, p.ini_contri, p.add_contri FROM x_stage2 s LEFT JOIN x_pairs2 p USING ({S2}))
SELECT * EXCLUDE (ini_contri, add_contri), 'INI' AS contri_type, ini_contri AS contri_val FROM j
UNION ALL SELECT * EXCLUDE (ini_contri, add_contri), 'ADD' AS contri_type, add_contri AS contri_val FROM j""")
cte("x_groups2", _groups("x_long2", S2))
_rw_sum = [*[c.strip() for c in _lyo.split(",")], "optimized_spends", "optimized_volume", "optimized_gps_adj", "optimized_netsales_adj"]
_rw_scaled = [*[c.strip() for c in _lyo.split(",")], "optimized_spends", "optimized_volume", "optimized_gps", "optimized_netsales_adj"]
_d7 = "business, category, subcategory, segment, shisha, cluster, channel"
cte("x_rework", f"""
WITH w0 AS (SELECT l.*, {_WEIGHT} AS w0, NOT (share_group = 'two' AND contri_val = 1) AS keep,
    CASE WHEN planningcustomer = old_planningcustomer OR contri_type = 'INI' THEN planningcustomer ELSE old_planningcustomer END AS target
  FROM x_long2 l JOIN x_groups2 USING ({S2}) WHERE contri_val <> 0 AND share_group <> 'none'),
k AS (SELECT {S2}, {es('w0', 9)} AS alls, CAST(sum(CAST(w0 AS DECIMAL(28,9))) FILTER (WHERE keep) AS DOUBLE) AS kept
  FROM w0 GROUP BY {S2}),
w AS (SELECT w0.*, CASE WHEN kept IS NULL THEN w0 / alls ELSE w0 / kept END AS weight
  FROM w0 JOIN k USING ({S2}) WHERE keep OR kept IS NULL),
z AS (SELECT {_d7}, target AS planningcustomer, ec_per_qtycase, price, adjustment_factor,
    {', '.join(rd(f'{c} * weight', 3) + f' AS {c}' for c in _rw_scaled)} FROM w),
g AS (SELECT {DIMS}, {av('ec_per_qtycase')} AS ec_per_qtycase, {av('price')} AS price,
    {', '.join(es(c, 9) + f' AS {c}' for c in _rw_sum)}
  FROM (SELECT *, optimized_gps * adjustment_factor AS optimized_gps_adj FROM z) GROUP BY {DIMS})
SELECT {DIMS}, ec_per_qtycase, price, {', '.join(_rw_sum)}, ec_per_qtycase * {L}volume_old AS ec,
  {L}netsales_old - ec_per_qtycase * {L}volume_old AS mc, ec_per_qtycase * optimized_volume AS ec_new,
  optimized_netsales_adj - ec_per_qtycase * optimized_volume AS mc_new,
  {div0(f'optimized_spends - {L}spends_old', f'{L}spends_old', 3)} AS spend_change,
  {div0(f'optimized_volume - {L}volume_old', f'{L}volume_old', 3)} AS vol_change,
  {div0(f'optimized_netsales_adj - {L}netsales_old', f'{L}netsales_old', 3)} AS ns_change
FROM g
UNION ALL
SELECT {DIMS}, ec_per_qtycase, price, {_lyo}, optimized_spends, optimized_volume,
  optimized_gps * adjustment_factor, optimized_netsales_adj, ec, mc, ec_new, mc_new, spend_change, vol_change, ns_change
FROM x_stage2 JOIN x_groups2 USING ({S2}) WHERE share_group = 'none'""")
_rw_all = f"ec_per_qtycase, price, {', '.join(_rw_sum)}, ec, mc, ec_new, mc_new, spend_change, vol_change, ns_change"
SQL["branch_rework_output"] = stmt(f"SELECT {DIMS}, {rounded(_rw_all, 2)} FROM x_rework")
cte("x_actual", f"""
SELECT {DIMS}, modelingname, {', '.join(es(m) + f' AS {m}' for m in (*MEASURES, 'ec', 'mc'))},
  {es('ec_per_qtycase', 9)} AS ec_per_qtycase, {av('price')} AS price,
  {div(es('ec'), es('volume'))} AS ec_per_case, 'VALUE_H1' AS scenario_name, '2000-06-30 23:59:59' AS date
FROM x_scope GROUP BY {DIMS}, modelingname""")
_act = "spends, netsales, gps, volume, ec, mc, ec_per_qtycase, price"
SQL["scenario_period_actuals"] = stmt(f"""
SELECT {DIMS}, modelingname, {rounded(_act + ', ec_per_case', 3)}, scenario_name, date FROM x_actual""")
SQL["missing_keys_backfill"] = stmt(f"""
SELECT {DIMS}, modelingname, {rounded('spends, netsales, gps, volume', 2)} FROM (
  SELECT DISTINCT {DIMS}, 'PRICEOFF' AS modelingname, optimized_spends AS spends, optimized_netsales_adj AS netsales,
    optimized_gps_adj AS gps, optimized_volume AS volume FROM x_rework
  UNION ALL
  SELECT {DIMS}, modelingname, spends, netsales, gps, volume FROM x_actual a
  WHERE NOT EXISTS (SELECT 1 FROM x_rework r WHERE {' AND '.join(f'r.{c.strip()} = a.{c.strip()}' for c in DIMS.split(','))}))""")
SQL["key_semi_filter"] = stmt(f"""
SELECT {KEY10}, modelingname, spends, volume FROM x_fact p WHERE EXISTS (SELECT 1 FROM x_scope s
  WHERE p.segment = s.segment AND p.shisha = s.shisha AND p.planningcustomer = s.planningcustomer)""")
cte("x_matched", f"""
SELECT r.*, {', '.join(f'a.{m} AS d_{m}' for m in MEASURES)},
  optimized_spends AS o_spends, optimized_gps_adj AS o_gps, optimized_volume AS o_volume
FROM x_rework r LEFT JOIN x_actual a USING ({DIMS})""")
SQL["match_flags"] = stmt(f"""
SELECT {DIMS}, {', '.join(f"CASE WHEN {rd(f'{L}{m}_old', 0)} = {rd(f'd_{m}', 0)} THEN 1 ELSE 0 END AS {m}_match" for m in MEASURES)}
FROM (SELECT DISTINCT * FROM x_matched)""")
_fa = lambda m: div(f"d_{m}", f"{L}{m}_old")
SQL["factor_align"] = stmt(f"""
SELECT {DIMS}, {', '.join(rd(f'o_{m} * {_fa(m)}', 2) + f' AS {m}' for m in ('spends', 'gps', 'volume'))},
  {rd(f"(o_gps * {_fa('gps')} - o_spends * {_fa('spends')}) * {div('d_netsales', 'd_gps - d_spends')}", 2)} AS netsales,
  {', '.join(rd(f'{L}{m}_old * {_fa(m)}', 2) + f' AS {L}{m}_old_calc' for m in MEASURES)}
FROM (SELECT DISTINCT * FROM x_matched)""")
SQL["branch_list"] = stmt(f"""
SELECT old_planningcustomer, string_agg(DISTINCT new_planningcustomer, ',' ORDER BY new_planningcustomer) AS branch_list,
  'VALUE_H1' AS scenario_name, CAST(NULL AS VARCHAR) AS section_name
FROM x_branch GROUP BY old_planningcustomer HAVING count(DISTINCT new_planningcustomer) > 1
UNION ALL
SELECT DISTINCT old_planningcustomer, new_planningcustomer, 'SCN_' || new_planningcustomer, NULL FROM x_branch""")
_sc = f"{KEY10}, modelingname, spends, volume, gps, netsales"
SQL["scope_filter"] = stmt(f"SELECT {_sc} FROM x_scope")


# --- budget curve and guarded allocation ---------------------------------------------

_SHARES = [0.85, 0.92, 0.95, 0.98, 1.0, 1.02, 1.05, 1.08, 1.15]


def _curve_at(group: str) -> str:
    """A whole allocation at every budget."""
    by = f"{group}, " if group else ""
    part = f"PARTITION BY {by}share"
    m = lambda x: f"CAST(sum(CAST({x} AS DECIMAL(28,9))) OVER ({part}) AS DOUBLE)"
    return f"""
    WITH b AS (SELECT *, spends_ub - spends_lb AS r FROM (SELECT * EXCLUDE (rng) FROM ({_box('x_items1')}))),
    s AS (SELECT b.*, share, {rd(f"{m(f'{L}spends')} * share", 2)} AS budget, {m('spends_lb')} AS lb, {m('spends_ub')} AS ub
      FROM b, (SELECT CAST(unnest([{', '.join(map(str, _SHARES))}]) AS DOUBLE) AS share)),
    o AS (SELECT *, least(budget, ub) - lb AS amount,
        CAST(sum(CAST(r AS DECIMAL(28,9))) OVER (PARTITION BY {by}share, slope) AS DOUBLE) AS tie,
        CAST(sum(CAST(r AS DECIMAL(28,9))) OVER ({part} ORDER BY slope DESC
          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS upto FROM s),
    z AS (SELECT *, spends_lb + r * greatest(0.0, least(1.0, (amount - (upto - tie)) / tie)) AS z FROM o),
    n AS (SELECT *, {L}gps * (1 + spends_coef * (z - {L}spends) / {L}spends) - z AS ns FROM z)
    SELECT {by}share, {rd('budget', 2)} AS budget, {rd(es('z', 9), 2)} AS spend, {rd(es('ns', 9), 2)} AS netsales,
      {rd(f"({es('ns', 9)} - {es(f'{L}netsales', 9)}) / {es(f'{L}netsales', 9)}", 6)} AS growth,
      {rd('max(slope) FILTER (WHERE lb + upto > budget)', 4)} AS marginal, budget >= max(lb) - 1e-6 AS feasible
    FROM n GROUP BY {by}share, budget"""


cte("x_curve", _curve_at(""))
cte("x_curve2", _curve_at("shisha"))
SQL["budget_curve"] = stmt("SELECT * FROM x_curve")
SQL["budget_curve_offices"] = stmt("SELECT * FROM x_curve2")
_slope_old = f"coalesce(spends_coef * {div(f'{L}gps_old', f'{L}spends_old')} - 1, -1.0)"
cte("x_guarded", _alloc("x_items2", S1, "_old", "old * 0.9", "least(centre, old * 1.1)", {"max_net_sales": MAXNS}).replace(
    f"{L}spends * 1.1 AS spends_ub", f"""CASE WHEN {_slope_old} < 0
      THEN greatest({L}spends * 0.9, least({L}spends * 1.1, {L}spends_old)) ELSE {L}spends * 1.1 END AS spends_ub""").replace(
    "(upto - tie)) / tie", "(upto - tie)) / nullif(tie, 0)").replace("greatest(0.0, least(1.0,", "coalesce(greatest(0.0, least(1.0,").replace(
    "nullif(tie, 0)))", "nullif(tie, 0))), 0)"))
SQL["guarded_allocation"] = stmt(f"SELECT {S2}, {_al} FROM x_guarded")
cte("x_reverted", _guarded(f"({_projected('x_maxns2', '_old')})"))
SQL["guarded_gain"] = stmt(f"""
SELECT {rd('g', 2)} AS guarded, {rd('r', 2)} AS reverted, rows_reverted, true AS not_below FROM
  (SELECT {es('optimized_netsales', 9)} AS g FROM ({_respond('x_guarded', 'optimized_spends', '_old')})),
  (SELECT {es('optimized_netsales', 9)} AS r, count(*) FILTER (WHERE reverted) AS rows_reverted FROM x_reverted)""")

# --- power-law volume: one price per group, by halving -----------------------------------

_POWER_ITEMS = f"""SELECT shisha, planningcustomer, {L}spends AS s, {L}volume AS v, {L}gps AS g, {L}netsales AS ns, {L}spends * 0.9 AS lb,
      {L}spends * 1.1 AS ub, backcalc_intercept AS a, spends_coef AS c, spends_coef * {L}gps / {L}spends - 1 AS m FROM x_items1"""


def _halved(group: str, goal: str, amount: str) -> str:
    """The price at which the items' ``amount`` comes to the group's goal."""
    z = lambda price: f"CASE WHEN c <= 0 THEN lb ELSE greatest(lb, least(ub, pow({price} / (a * c), 1 / (c - 1)))) END"
    return f"""(
    WITH RECURSIVE i AS (SELECT *, {group} AS grp FROM ({_POWER_ITEMS})),
    b AS (
      SELECT grp, 0 AS n, CAST(1e-30 AS DOUBLE) AS lo, max(a * c * pow(lb, c - 1)) + 1 AS hi, {goal} AS goal FROM i GROUP BY grp
      UNION ALL
      SELECT grp, n + 1, CASE WHEN reached >= goal THEN mid ELSE lo END, CASE WHEN reached >= goal THEN hi ELSE mid END, goal
      FROM (SELECT grp, n, lo, hi, goal, mid, sum({amount}) AS reached
            FROM (SELECT b.*, i.*, (lo + hi) / 2 AS mid, {z('(lo + hi) / 2')} AS z FROM b JOIN i ON b.grp IS NOT DISTINCT FROM i.grp WHERE n < 110) GROUP BY ALL))
    SELECT {S1}, {rd('z', 2)} AS optimized_spends, {rd('a * pow(z, c)', 2)} AS optimized_volume, true AS feasible
    FROM (SELECT i.*, {z('lo')} AS z FROM b JOIN i ON b.grp IS NOT DISTINCT FROM i.grp WHERE n = 110))"""


SQL["volume_budget"] = stmt(f"SELECT * FROM {_halved('shisha', 'sum(s)', 'z')}")
SQL["volume_budget_total"] = stmt(f"SELECT * FROM {_halved('0', 'sum(s) * 1.03', 'z')}")
SQL["volume_target"] = stmt(f"SELECT * FROM {_halved('shisha', 'sum(a * pow(s, c))', 'a * pow(z, c)')}")

#: Halvings of the price within each weight, and of the weight.
_INNER, _OUTER = 60, 36


def _floored(floor: float) -> str:
    """Weights of volume are halved, and for each of them the price that meets the budget."""
    flat, bent = "((1 - t) * m)", "(t * k * a * c)"
    z = lambda price: f"""CASE WHEN {price} < {flat} THEN ub WHEN {bent} <= 0 THEN lb WHEN {price} = {flat} THEN ub
        ELSE greatest(lb, least(ub, pow(({price} - {flat}) / {bent}, 1 / (c - 1)))) END"""
    grown = lambda new, old: rd(f"(sum({new}) - sum({old})) / sum({old})", 5)
    return f"""(
    WITH RECURSIVE i AS ({_POWER_ITEMS}),
    b AS (
      SELECT shisha AS grp, 0 AS n, CAST(0 AS DOUBLE) AS tlo, CAST(1 AS DOUBLE) AS thi, bot AS lo, top AS hi, * EXCLUDE (shisha) FROM (
        SELECT shisha, sum(s) AS goal, sum(a * pow(s, c)) * {floor} AS want, sum(abs(m) * ub) / sum(a * pow(s, c)) AS k,
          least(min(m), 0) - 1 AS bot, greatest(max(m), max(a * c * pow(lb, c - 1)) * sum(abs(m) * ub) / sum(a * pow(s, c))) + 1 AS top
        FROM i GROUP BY shisha)
      UNION ALL
      SELECT grp, n + 1,
        CASE WHEN n % {_INNER} = {_INNER - 1} AND sold < want THEN t ELSE tlo END, CASE WHEN n % {_INNER} = {_INNER - 1} AND sold >= want THEN t ELSE thi END,
        CASE WHEN n % {_INNER} = {_INNER - 1} THEN bot WHEN spent >= goal THEN mid ELSE lo END,
        CASE WHEN n % {_INNER} = {_INNER - 1} THEN top WHEN spent >= goal THEN hi ELSE mid END, goal, want, k, bot, top
      FROM (SELECT grp, n, tlo, thi, lo, hi, goal, want, k, bot, top, t, mid, sum(z) AS spent, sum(a * pow(z, c)) AS sold
            FROM (SELECT *, {z('mid')} AS z FROM (SELECT *, (tlo + thi) / 2 AS t, (lo + hi) / 2 AS mid
              FROM b JOIN i ON grp IS NOT DISTINCT FROM shisha WHERE n < {_INNER * _OUTER - 1})) GROUP BY ALL)),
    e AS (SELECT *, {z('lo')} AS zl, {z('hi')} AS zh FROM (SELECT *, (tlo + thi) / 2 AS t
      FROM b JOIN i ON grp IS NOT DISTINCT FROM shisha WHERE n = {_INNER * _OUTER - 1})),
    f AS (SELECT *, zh + (zl - zh) * greatest(0, least(1, coalesce(
        (goal - sum(zh) OVER w) / nullif(sum(zl) OVER w - sum(zh) OVER w, 0), 0))) AS z FROM e WINDOW w AS (PARTITION BY grp))
    SELECT shisha, count(*) AS items, {grown('z', 's')} AS spend_change, {grown('a * pow(z, c)', 'v')} AS volume_change,
      {grown('g * (1 + c * (z / s - 1)) - z', 'ns')} AS netsales_change, sum(a * pow(z, c)) >= max(want) * (1 - 1e-6) AS feasible
    FROM f GROUP BY shisha)"""


SQL["volume_floor_netsales"] = stmt(f"SELECT * FROM {_floored(1.0145)}")

# --- sources and sinks -----------------------------------------------------------------

cte("x_totals", f"""
SELECT year, category, modelingname, {', '.join(es(m) + f' AS {m}' for m in MEASURES)} FROM x_fact GROUP BY ALL""")
for _name in ("catalog_table", "catalog_append", "snapshot_copy", "external_store", "csv_scan"):
    SQL[_name] = stmt(f"SELECT year, category, modelingname, {', '.join(MEASURES)} FROM x_totals")
SQL["local_rows"] = stmt(f"""
SELECT modelingname, {', '.join(es(m) + f' AS {m}' for m in MEASURES)},
  CASE WHEN modelingname IN {TYPES} THEN 'spend' WHEN modelingname = 'Own Price' THEN 'price' END AS kind
FROM x_totals GROUP BY modelingname""")
SQL["versioned_publication"] = SQL["publish_scenario"]
SQL["status_log"] = SQL["status_upsert"]

# --- scenarios as data -----------------------------------------------------------------

_N = "scenario_name"
cte("xb_scenarios", f"""
WITH r AS (SELECT *, 12 * year + month - 1 AS i FROM x_fact WHERE modelingname IN {TYPES} AND spends > 0 AND volume >= 0),
w AS (SELECT business, modelingname, 'A' AS w, '2' AS strategy, CAST(NULL AS VARCHAR[]) AS offices, 24000 AS first_month, 24005 AS last_month,
    list(DISTINCT category) AS cats, list(DISTINCT channel) AS chans, CAST(NULL AS DOUBLE) AS goal_spend FROM r GROUP BY ALL
  UNION ALL
  SELECT business, modelingname, 'B', '3', ['AMERICA', 'ASIA', 'EUROPE'], 24009, 24014, list(DISTINCT category), list(DISTINCT channel),
    round({es('CASE WHEN i BETWEEN 23997 AND 24002 THEN spends ELSE 0.0 END')} * 1.02, 2)
  FROM r WHERE shisha IN ('AMERICA', 'ASIA', 'EUROPE') GROUP BY ALL)
SELECT business || ' ' || modelingname || ' ' || w AS {_N}, business, modelingname AS spend_type, strategy, offices, cats, chans,
  goal_spend, CAST(first_month AS INTEGER) AS first_month, CAST(last_month AS INTEGER) AS last_month FROM w""")
_IN = """f.business = s.business AND list_contains(s.cats, f.category) AND list_contains(s.chans, f.channel)
  AND (s.offices IS NULL OR list_contains(s.offices, f.shisha))"""
_PAST = "12 * year + month - 1 BETWEEN first_month - 12 AND last_month - 12"
cte("xb_fit", f"""
SELECT s.{_N}, first_month, last_month, f.* FROM x_fact f JOIN xb_scenarios s ON {_IN} AND f.modelingname = s.spend_type
WHERE spends > 0 AND volume >= 0""")
cte("xb_pos", "SELECT * FROM xb_fit WHERE volume > 0")
cte("xb_scope", f"SELECT * FROM xb_fit WHERE {_PAST}")
_fallback(["shisha", "planningcustomer"], ["shisha", "planningcustomer"], "xb_f", "xb_pos", (_N,))
_fallback(["segment", "shisha", "planningcustomer"], ["shisha", "segment", "planningcustomer"], "xb_g", "xb_pos", (_N,))
cte("xb_coef1", _consolidated("xb_f_l2", _with(_N, S1), "xb_fit"))
cte("xb_coef2", _consolidated("xb_g_l3", _with(_N, S2), "xb_fit"))
cte("xb_coef2d", f"""
SELECT c.*, d.business, d.category, d.subcategory, d.cluster, d.channel
FROM xb_coef2 c LEFT JOIN (SELECT DISTINCT {_N}, {DIMS} FROM xb_fit) d USING ({_with(_N, S2)})""")
cte("xb_base1", _base1("xb_coef1", "xb_scope", _N))
cte("xb_items1", f"""
SELECT i.*, goal FROM ({_calibrated('xb_base1')}) i JOIN (
  SELECT {_N}, CASE WHEN strategy = '3' THEN goal_spend - coalesce(carried, 0) END AS goal FROM xb_scenarios LEFT JOIN (
    SELECT {_N}, {es(f'{L}spends', 9)} AS carried FROM xb_base1 WHERE {L}spends > 0 AND {L}volume = 0 GROUP BY {_N}) USING ({_N})) USING ({_N})""")
# The growth of the best policy is never below that of another.
cte("xb_alloc1", _alloc("xb_items1", _N, "", "coalesce(goal, 0.0)", "coalesce(goal, centre)", {"max_net_sales": MAXNS}))
cte("xb_stage1", f"""
SELECT {_with(_N, _s1cols)} FROM ({_projected('xb_alloc1', '')})
UNION ALL SELECT {_with(_N, _s1cols)} FROM ({_carried('xb_base1', '')})""")
cte("xb_cost", f"""
SELECT {_with(_N, S2)}, {div0(es('ec'), es('volume'))} AS ec_per_qtycase FROM x_fact f JOIN xb_scenarios s
  ON f.modelingname = s.spend_type AND year BETWEEN (first_month - 12) // 12 AND (last_month - 12) // 12
WHERE spends > 0 AND volume >= 0 GROUP BY {_with(_N, S2)}""")
cte("xb_pushed", _pushed("xb_coef2d", "xb_scope", "xb_stage1", "xb_cost", _N))
cte("xb_items2", f"SELECT * REPLACE ({L}gps_old - {L}spends_old AS {L}netsales_old) FROM ({_calibrated('xb_pushed')})")
cte("xb_cand2", _alloc("xb_items2", _with(_N, S1), "_old", "old * 0.9", "least(centre, old * 1.1)", {"max_net_sales": MAXNS, "spend_first": FIRST}))
cte("xb_alloc2", f"SELECT c.* FROM xb_cand2 c JOIN ({_chosen('xb_cand2', _N)}) USING ({_with(_N, S1)}, policy)")
cte("xb_stage2", _stage2("xb_alloc2", "xb_pushed", _N))
cte("xb_guard", f"SELECT g.*, spend_type FROM ({_guarded('xb_stage2')}) g JOIN xb_scenarios USING ({_N})".replace("JOIN xb_scenarios", f"JOIN (SELECT {_N}, spend_type FROM xb_scenarios)"))
cte("xb_others", f"""
SELECT s.{_N}, f.* FROM x_fact f JOIN xb_scenarios s ON {_IN} AND f.modelingname <> s.spend_type
WHERE f.modelingname NOT IN {TOTALS} AND {_PAST}""")
cte("xb_final", _overlaid("xb_guard", "xb_others", _N, "reverted, spend_type, ", "spend_type AS modelingname"))
_csv = lambda c: f"coalesce(array_to_string(list_sort({c}), ','), '*')"
cte("xb_valid", f"""
SELECT {_N}, business, spend_type, {_csv('cats')} AS category, {_csv('chans')} AS channel, {_csv('offices')} AS shisha,
  strategy, goal_spend, first_month, last_month, CAST(NULL AS VARCHAR) AS refused FROM xb_scenarios""")
SQL["scenario_batch_requests"] = stmt(f"""
SELECT *, first_month - 12 AS last_year_first, last_month - 12 AS last_year_last FROM (
  SELECT * FROM xb_valid UNION ALL
  SELECT * REPLACE ('unknown objective' AS {_N}, NULL AS strategy, 'objective' AS refused) FROM xb_valid WHERE {_N} = 'VALUE PRICEOFF A' UNION ALL
  SELECT * REPLACE ('reversed period' AS {_N}, last_month AS first_month, first_month AS last_month, 'period' AS refused)
  FROM xb_valid WHERE {_N} = 'VALUE PRICEOFF A' UNION ALL
  SELECT NULL, NULL, NULL, '*', '*', '*', NULL, NULL, NULL, NULL, 'document')""")
SQL["scenario_batch_stage1"] = stmt(f"SELECT {_N}, {_s1out} FROM xb_stage1")
SQL["scenario_batch_final"] = stmt(f"""
SELECT {_N}, {DIMS}, modelingname, reverted, {rd('optimized_spends', 3)} AS optimized_spends, {rounded(_fin, 3)} FROM xb_final""")
SQL["publish_batch"] = stmt(f"""
SELECT CAST(year AS INTEGER) AS year, half_year, {DIMS}, modelingname, {rd('optimized_spends', 3)} AS optimized_spends,
  CAST(month AS INTEGER) AS month, scenario_name, date, CASE WHEN EXISTS (
    SELECT 1 FROM xb_scenarios s WHERE {_IN} AND f.modelingname = s.spend_type
      AND 12 * CAST(substr(date, 1, 4) AS INTEGER) + CAST(substr(date, 6, 2) AS INTEGER) - 1 BETWEEN first_month AND last_month)
    THEN 0 ELSE is_latest END AS is_latest, {', '.join(f'CAST(NULL AS DOUBLE) AS {c.strip()}' for c in _fin.split(','))}
FROM x_output f
UNION ALL
SELECT CAST(last_month // 12 AS INTEGER), CASE WHEN last_month % 12 < 6 THEN 'H1' ELSE 'H2' END, {', '.join('x.' + c.strip() for c in DIMS.split(','))},
  x.modelingname, {rd('optimized_spends', 3)}, CAST(last_month % 12 + 1 AS INTEGER), {_N},
  {month_end('last_month // 12', 'last_month % 12 + 1')}, 1, {', '.join(rd(c.strip(), 3) for c in _fin.split(','))}
FROM xb_final x JOIN (SELECT {_N}, last_month FROM xb_scenarios) USING ({_N})""")

# --- null and shared keys --------------------------------------------------------------


def _unknown_office(name: str) -> str:
    """An unknown branch office is a key like any other: the same rows, with one office shown as null."""
    return f"SELECT * REPLACE (nullif(shisha, 'ASIA') AS shisha) FROM ({SQL[name]})"


for _name, _of in {
    "rescale_null_keys": "rescale_to_actuals", "ratio_impute_null_keys": "ratio_impute", "history_null_keys": "history_baseline",
    "override_null_keys": "override_merge", "assemble_null_keys": "assemble_fact", "scenario_null_keys": "baseline_overlay",
}.items():
    SQL[_name] = _unknown_office(_of)
cte("x_out", f"SELECT DISTINCT {DIMS}, 'PRICEOFF' AS modelingname, * EXCLUDE ({DIMS}) FROM x_rework")
SQL["comparison_shown"] = stmt(f"""
SELECT {DIMS}, 'PRICEOFF' AS modelingname, 'output' AS origin,
  {' || '.join(f"CASE WHEN {rd(f'{L}{m}_old', 0)} = {rd(f'd_{m}', 0)} THEN '1' ELSE '0' END" for m in MEASURES)} AS matched
FROM (SELECT DISTINCT * FROM x_matched)
UNION ALL
SELECT {DIMS}, modelingname, 'backfilled', CAST(count(*) AS VARCHAR) FROM (
  SELECT {DIMS}, modelingname FROM x_out
  UNION ALL SELECT {DIMS}, modelingname FROM x_actual a WHERE NOT EXISTS (
    SELECT 1 FROM x_out r WHERE {' AND '.join(f'r.{c.strip()} = a.{c.strip()}' for c in DIMS.split(','))})) GROUP BY ALL
UNION ALL
SELECT {DIMS}, modelingname, 'kept', '' FROM x_out r WHERE EXISTS (
  SELECT 1 FROM x_actual a WHERE r.segment = a.segment AND r.shisha = a.shisha AND r.planningcustomer = a.planningcustomer)""")
SQL["comparison_null_keys"] = _unknown_office("comparison_shown")
del SQL["comparison_shown"]
_PARTS = "(VALUES ('part 1', 0.2), ('part 2', 0.8)) t(part, share)"
cte("x_splitrows", f"""
SELECT * EXCLUDE (part, share) REPLACE (subcategory || '/' || part AS subcategory, {', '.join(f'{m} * CAST(share AS DOUBLE) AS {m}' for m in MEASURES)})
FROM x_spendrows, {_PARTS}""")
cte("x_weights", f"""
SELECT DISTINCT {_AKEY}, old_planningcustomer, contri_type, share_group, weight FROM x_conserved WHERE share_group <> 'none'""")
cte("x_splitshared", f"""
SELECT {KEY10}, modelingname, price, old_planningcustomer, contri_type, share_group, {', '.join(rd(f'{m} * weight', 3) + f' AS {m}' for m in MEASURES)}
FROM x_splitrows JOIN x_weights USING ({_AKEY})
UNION ALL
SELECT {KEY10}, modelingname, price, NULL, NULL, 'none', {', '.join(MEASURES)} FROM x_splitrows r
WHERE NOT EXISTS (SELECT 1 FROM x_weights w WHERE {' AND '.join(f'w.{k.strip()} = r.{k.strip()}' for k in _AKEY.split(','))})""")
SQL["reassign_shared_keys"] = stmt(f"SELECT {_re_cols} FROM ({_reassigned('x_splitshared')})")
SQL["reallocation_check_shared_keys"] = stmt(" UNION ALL ".join(f"""
SELECT modelingname, '{m}' AS measure, {rd(es(m), 2)} AS before, true AS kept FROM x_splitrows GROUP BY modelingname"""
    for m in MEASURES))


def statements() -> dict[str, str]:
    return dict(SQL)
