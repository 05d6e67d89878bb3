"""SQL fragments shared by every operator.

Operators state their expressions as SQL text (``selectExpr``/``expr``): the text is
parsed once in the JVM, while building the same tree column by column costs several
driver round trips per node.

Money is summed as DECIMAL so that totals do not depend on the order in which
partitions are merged; ratios are rounded through DECIMAL so that a half always
rounds up, whatever the binary representation of the double.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F


def ten_thousandths(x: str) -> str:
    """A double as a whole number of ten-thousandths.

    Both branches convert the same rounded number; one that fits a long is converted faster.
    """
    whole = f"rint(({x}) * 10000D)"
    return f"if(abs({x}) < 9e13D, cast(cast({whole} as bigint) as decimal(28,0)), cast({whole} as decimal(28,0)))"


def exact_sum(x: str, scale: int = 4) -> str:
    """Order-independent sum of a double, kept at ``scale`` places."""
    if scale == 4:
        return f"(cast(sum({ten_thousandths(x)}) as double) / 10000D)"
    return f"cast(sum(cast({x} as decimal(28,{scale}))) as double)"


def exact_avg(x: str, scale: int = 9) -> str:
    """Order-independent mean of the non-null values of a double."""
    return f"try_divide({exact_sum(x, scale)}, cast(count({x}) as double))"


def round_dp(x: str, dp: int = 3) -> str:
    """``x`` at ``dp`` places, half up; beyond 19 digits before the point a double has no places to round."""
    return f"coalesce(cast(round(try_cast({x} as decimal(28,9)), {dp}) as double), {x})"


def ratio(n: str, d: str) -> str:
    """n / d, null when d is zero."""
    return f"try_divide({n}, {d})"


def ratio0(n: str, d: str, dp: int | None = None) -> str:
    """n / d where d is non-zero, else 0."""
    q = ratio(n, d)
    return f"case when ({d}) != 0 then {q if dp is None else round_dp(q, dp)} else 0D end"


def change(new: str, old: str) -> str:
    """Relative change, null when the old value is zero."""
    return ratio(f"({new}) - ({old})", old)


def zero_if_null(x: str) -> str:
    return f"coalesce({x}, 0D)"


def any_nonzero(columns: Iterable[str]) -> str:
    return "(" + " or ".join(f"{c} != 0" for c in columns) + ")"


def quoted(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(column: str, values: Iterable[str]) -> str:
    return f"{column} in ({', '.join(map(quoted, values))})"


HALF_LABEL = "case when cast(month as int) <= 6 then 'H1' else 'H2' end"
HALF_NUMBER = "case when cast(month as int) <= 6 then 1 else 2 end"
MONTH_START = "concat_ws('-', cast(year as string), lpad(cast(month as string), 2, '0'), '01')"
MONTH_END = (
    "concat_ws(' ', cast(last_day(make_date(cast(year as int), cast(month as int), 1)) as string), '23:59:59')"
)


def named(expressions: Mapping[str, str]) -> list[str]:
    """``{name: sql}`` as aliased SQL, for ``selectExpr``."""
    return [f"{sql} as {name}" for name, sql in expressions.items()]


def with_exprs(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Add or replace columns by SQL text, in one projection; order of columns is kept."""
    kept = [f"{expressions[c]} as {c}" if c in expressions else f"`{c}`" for c in df.columns]
    new = [f"{sql} as {name}" for name, sql in expressions.items() if name not in df.columns]
    return df.selectExpr(*kept, *new)


#: A hash of a part of the other keys, never null. Tables laid out by it (``settle``) are grouped and joined without a shuffle.
KEY_HASH = "key_hash"


def hashed(keys: list[str], *tables: DataFrame) -> list[str]:
    """``keys`` after ``KEY_HASH``, if all ``tables`` have it."""
    return [KEY_HASH, *keys] if all(KEY_HASH in t.columns for t in tables) else keys


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the keys appear once, at their places in ``left``.

    ``how`` is inner, left, outer, left_semi or left_anti. In an outer join a row of ``right``
    alone brings its own keys. With ``KEY_HASH`` among the keys, rows meet by it alone and the other keys are compared there.
    """
    if not keys:
        raise ValueError("no join key")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    added = []
    if KEY_HASH in keys:
        # Not as `=` or `<=>`, which Spark would add to the keys that both sides must be laid out by.
        # A hash of all keys tells most unequal rows apart at once.
        added = ["_all_keys", "_right_all_keys"]
        left = left.selectExpr("*", f"xxhash64({', '.join(f'`{k}`' for k in keys)}) as _all_keys")
        renamed = renamed.selectExpr("*", f"xxhash64({', '.join(f'`_right_{k}`' for k in keys)}) as _right_all_keys")
        others = ["_all_keys between _right_all_keys and _right_all_keys", *[
            f"(`{k}` between `_right_{k}` and `_right_{k}` or `{k}` is null and `_right_{k}` is null)" for k in keys if k != KEY_HASH]]
        same = " and ".join([f"`{KEY_HASH}` = `_right_{KEY_HASH}`", *others])
    else:
        same = " and ".join(f"`{k}` <=> `_right_{k}`" for k in keys)
    joined = left.join(renamed, F.expr(same), how)
    if how in ("left_semi", "left_anti"):
        return joined.drop(*added)
    if how in ("outer", "full", "full_outer"):
        joined = with_exprs(joined, {k: f"coalesce(`{k}`, `_right_{k}`)" for k in keys})
    return joined.drop(*[f"_right_{k}" for k in keys], *added)


def aggregate(df: DataFrame, keys: list[str], expressions: Mapping[str, str]) -> DataFrame:
    """``groupBy(keys)`` with aggregates given as SQL text."""
    return df.groupBy(*keys).agg(*[F.expr(sql).alias(name) for name, sql in expressions.items()])
