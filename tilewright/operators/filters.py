"""Property comparisons in the JSON filter form of catalog searches, as column predicates."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.times import split_interval

# Comparison operators.
COMPARISONS = {
    "=": operator.eq,
    "==": operator.eq,
    ">=": operator.ge,
    "<=": operator.le,
    ">": operator.gt,
    "<": operator.lt,
    "!=": operator.ne,
    "<>": operator.ne,
}
# Queryable names that the items store under another name.
ALIASES = {"dt_days": "date_dt"}


def _value(arg) -> Column:
    if isinstance(arg, dict) and "property" in arg:
        name = arg["property"]
        return F.col(f"`{ALIASES.get(name, name)}`")
    return arg if isinstance(arg, Column) else F.lit(arg)


def predicate(expression: dict) -> Column | None:
    """Column of one expression; None for an empty one or a comparison with null."""
    if not expression:
        return None
    op, args = expression["op"].lower(), expression["args"]
    if op in ("and", "or"):
        return conjunction(args) if op == "and" else _any(args)
    if op == "not":
        inner = predicate(args[0])
        return None if inner is None else ~inner
    if op not in COMPARISONS:
        raise ValueError(f"unknown comparison {op!r}")
    left, right = args
    if left is None or right is None:
        return None
    return COMPARISONS[op](_value(left), _value(right))


def _any(expressions) -> Column:
    parts = [p for p in map(predicate, expressions) if p is not None]
    return reduce(operator.or_, parts) if parts else F.lit(True)


def conjunction(expressions) -> Column:
    """All of a list of expressions; true for an empty list."""
    if isinstance(expressions, dict):
        expressions = [expressions]
    parts = [p for p in map(predicate, expressions or []) if p is not None]
    return reduce(operator.and_, parts) if parts else F.lit(True)


def apply_filters(df: DataFrame, expressions) -> DataFrame:
    return df.filter(conjunction(expressions))


def in_interval(interval: str | None, column: str = "datetime", year: str | None = None) -> Column:
    """Inclusive interval test, open at either end, beside the partition predicate on the year."""
    start, end = split_interval(interval)
    parts = []
    if start is not None:
        parts.append(F.col(column) >= F.lit(start).cast("timestamp"))
        if year:
            parts.append(F.col(year) >= int(start[:4]))
    if end is not None:
        parts.append(F.col(column) <= F.lit(end).cast("timestamp"))
        if year:
            parts.append(F.col(year) <= int(end[:4]))
    return reduce(operator.and_, parts) if parts else F.lit(True)


def data_hrefs(items: DataFrame, suffix: str = ".nc", role: str = "data", *keep: str) -> DataFrame:
    """Links of every asset that has the role and the ending; null links are dropped."""
    assets = items.select(*keep, F.explode(F.map_values("assets")).alias("asset"))
    href = F.col("asset.href")
    return assets.filter(F.array_contains("asset.roles", role) & href.endswith(suffix)).select(
        *keep, href.alias("href")
    )
