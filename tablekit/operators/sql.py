"""The aggregates that also exist as SQL text.

Each twin gives the same rows as its DataFrame form, and Catalyst gives both
the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablekit.operators.quality import quoted
from tablekit.sources import sql_over


def _name(column: str) -> str:
    """A quoted name in which braces are not placeholders of the SQL text."""
    return quoted(column).replace("{", "{{").replace("}", "}}")


def _list(columns: Sequence[str]) -> str:
    return ", ".join(_name(c) for c in columns)


def _n_by(df: DataFrame, columns: Sequence[str], n: int, direction: str) -> DataFrame:
    keys = _list(columns)
    query = (
        f"SELECT {keys}, count(*) AS `count` FROM {{df}} GROUP BY {keys} "
        f"ORDER BY `count` {direction}, {keys} LIMIT {int(n)}"
    )
    return sql_over(df, query)


def top_n_by_sql(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` most frequent combinations."""
    return _n_by(df, columns, n, "DESC")


def bottom_n_by_sql(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` least frequent combinations."""
    return _n_by(df, columns, n, "ASC")


def numeric_stats_sql(df: DataFrame, columns: Sequence[str], column: str) -> DataFrame:
    """Average, minimum and maximum per group, highest average first."""
    keys, x = _list(columns), _name(column)
    average, low, high = (_name(f"{kind}_{column}") for kind in ("average", "min", "max"))
    query = (
        f"SELECT {keys}, avg({x}) AS {average}, min({x}) AS {low}, max({x}) AS {high} "
        f"FROM {{df}} GROUP BY {keys} ORDER BY {average} DESC, {keys}"
    )
    return sql_over(df, query)


def average_by_sql(df: DataFrame, columns: Sequence[str], column: str) -> DataFrame:
    """Average per group, highest first."""
    keys, average = _list(columns), _name(f"avg_{column}")
    query = (
        f"SELECT {keys}, avg({_name(column)}) AS {average} "
        f"FROM {{df}} GROUP BY {keys} ORDER BY {average} DESC, {keys}"
    )
    return sql_over(df, query)
