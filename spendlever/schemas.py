"""Column lists and declared schemas shared by every operator.

Names are lower_snake everywhere; nothing relies on case-insensitive lookup.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Driver labels of the monthly decomposition.
PRICEOFF = "PRICEOFF"
PROMOTIONAD = "PROMOTIONAD"
LIQUIDATION = "LIQUIDATION"
OWN_PRICE = "Own Price"
BASE_PRICE = "Base_BasePrice"
VOLUME_TOTAL = "Volume"
PREDICTED_SALES = "PREDICTED_SALES"

SPEND_TYPES = [PRICEOFF, PROMOTIONAD, LIQUIDATION]
TOTAL_ROWS = [VOLUME_TOTAL, PREDICTED_SALES]
NON_DRIVER_ROWS = [BASE_PRICE, VOLUME_TOTAL, PREDICTED_SALES]

PERIOD = ["year", "month"]
DIMENSIONS = [
    "business", "category", "subcategory", "segment",
    "shisha", "cluster", "channel", "planningcustomer",
]
KEY10 = PERIOD + DIMENSIONS
KEY5 = ["year", "month", "segment", "shisha", "planningcustomer"]
MEASURES = ["spends", "netsales", "gps", "volume"]
FACT_COLUMNS = KEY10 + [
    "modelingname", "spends", "gps", "netsales", "volume",
    "price", "ec", "ec_per_qtycase", "mc",
]

# Star-schema tables the canonical inputs are derived from; declaring them saves a footer
# scan per table and per query.
STAR = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Shape of the scenario request document ("scenarioPrameters" is the document's own spelling).
REQUEST = (
    "scenarioPrameters struct<scenarioName: string>, optimizationInput struct<"
    "business: string, spendtype: string, channel: array<string>, category: array<string>, budget: double, "
    "optimizationobjective: string, max: string, min: string, shisha: array<string>>"
)

LEDGER = T.StructType([
    T.StructField("scenarioname", T.StringType()),
    T.StructField("isoptimizationexecutioncompleted", T.IntegerType()),
    T.StructField("progressmessage", T.DoubleType()),
])
