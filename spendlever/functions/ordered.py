"""Running totals and ranks over ordered values without sorting a large group in one task.

A group may hold a large share of all rows (a global budget is one single group), so the value
axis is first cut into buckets. The cuts are quantiles of the values at hand, taken from a mergeable sketch,
so a bucket holds about the same number of distinct values wherever they lie. Totals per bucket are a small table
and are accumulated there; the fine running sum is taken inside one (group, bucket) only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from spendlever.functions.expr import aggregate, join_keys
from spendlever.functions.lineage import settle

BUCKETS = 128
#: Rank error of the sketch, as a part of all rows: an eighth of a bucket.
SKETCH_ERROR = 1 / (8 * BUCKETS)
#: A key with more rows than this is never sorted in one task.
HOT_KEY_ROWS = 1_000_000


def quantile_bounds(df: DataFrame, value: str) -> list[float]:
    """Distinct values that cut the values of ``df`` into about ``BUCKETS`` equal parts.

    Tasks hand on sketches, never values. Values shared by many rows become one cut, so
    pass rows whose ties are already summed to have equal parts of distinct values.
    """
    cuts = df.approxQuantile(value, [i / BUCKETS for i in range(1, BUCKETS)], SKETCH_ERROR)
    return sorted({c for c in cuts if math.isfinite(c)})


def bucket_of(value: str, bounds: list[float]) -> str:
    """Number of bounds that are not above the value, as a search of nested conditions."""
    def between(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"if({value} < {bounds[mid]!r}D, {between(low, mid)}, {between(mid + 1, high)})"

    return between(0, len(bounds))


def running_totals(
    steps: DataFrame,
    group: list[str],
    value: str,
    amount: str,
    descending: bool = False,
    bounds: list[float] | None = None,
) -> DataFrame:
    """Add ``<amount>_before`` (values earlier in the order) and ``<amount>_total`` per group.

    ``steps`` holds one row per (group, value): ties must already be summed, which
    partial aggregation does before the shuffle. Only balance depends on ``bounds``, never the
    result; without them ``steps`` is read once more to find them, so pass a settled table.
    """
    bounds = quantile_bounds(steps, value) if bounds is None else bounds
    keys = [*group, "_bucket"]
    listed = ", ".join(keys)
    turn = "desc" if descending else "asc"
    before = "rows between unbounded preceding and 1 preceding"
    cut = steps.selectExpr("*", f"{bucket_of(value, bounds)} as _bucket").selectExpr(
        "*",
        f"coalesce(cast(sum({amount}) over (partition by {listed} order by {value} {turn} {before}) as double), 0D) as _inside",
    )
    anchor = ", ".join(group) or "0"
    # At most BUCKETS rows in each window.
    per_bucket = aggregate(cut, keys, {"_sum": f"sum({amount})"}).selectExpr(
        *keys,
        f"coalesce(cast(sum(_sum) over (partition by {anchor} order by _bucket {turn} {before}) as double), 0D) as _earlier",
        f"cast(sum(_sum) over (partition by {anchor}) as double) as {amount}_total",
    )
    return (
        join_keys(cut, per_bucket, keys)
        .selectExpr(*steps.columns, f"_inside + _earlier as {amount}_before", f"{amount}_total")
    )


def split_hot(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys that one task can sort, and those of hotter keys (None if there are none)."""
    hot = settle(aggregate(rows, keys, {"_n": "count(1)"}).filter(f"_n > {HOT_KEY_ROWS}").drop("_n"))
    if hot.isEmpty():
        return rows, None
    return join_keys(rows, hot, keys, "left_anti"), join_keys(rows, hot, keys, "left_semi")


def average_rank(keys: list[str], measure: str) -> str:
    """Average-tie percentile rank within a key, as windows of one sort."""
    ordered = f"partition by {', '.join(keys)} order by {measure}"
    upto = f"count(1) over ({ordered} range between unbounded preceding and current row)"
    return f"(rank() over ({ordered}) + {upto}) / 2D / count(1) over (partition by {', '.join(keys)})"
