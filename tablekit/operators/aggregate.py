"""Grouped, conditional and percentage aggregates.

Every aggregate is combined map-side, so a group holding most of the rows
sends one partial row per task. Results carry the group columns as last sort
keys, which makes the order total.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tablekit.functions import negative, nonneg
from tablekit.operators.quality import quoted


def column_at(df: DataFrame, column: str | int) -> str:
    """A column name, given as such or as a position counted from 1."""
    if isinstance(column, str):
        return column
    if not 1 <= column <= len(df.columns):
        raise ValueError(f"position {column} is outside 1..{len(df.columns)}")
    return df.columns[column - 1]


def _keys(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def grouped_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per group as ``count``, unordered."""
    return df.groupBy(*_keys(columns)).agg(F.count("*").alias("count"))


def count_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per group as ``count``, largest first."""
    return grouped_counts(df, columns).orderBy(F.desc("count"), *_keys(columns))


def percentage_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``count_by`` with ``percentage``: the share of all rows, times 100."""
    counts = grouped_counts(df, columns)
    return with_share(counts, "percentage", 100.0).orderBy(F.desc("count"), *_keys(columns))


def with_share(counts: DataFrame, name: str, scale: float = 1.0) -> DataFrame:
    """Add ``count / sum of all counts * scale``.

    The total is a scalar subquery over the same aggregate, whose shuffle Spark
    runs once for both.
    """
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn(name, F.col("count") * F.lit(scale) / total)


def _delay_name(kind: str, column: str) -> str:
    return f"average_{kind}_{column.split('_')[0]}_delay"


def nonneg_avg(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One row: the average of the values ``>= 0``; NULL when there is none."""
    value = nonneg(F.col(quoted(column)))
    return df.agg(F.avg(value).alias(name or _delay_name("positive", column)))


def neg_avg(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One row: the average of the values ``< 0``; NULL when there is none."""
    value = negative(F.col(quoted(column)))
    return df.agg(F.avg(value).alias(name or _delay_name("negative", column)))


def _conditional_avg_by(
    df: DataFrame, columns: Sequence[str], value: Column, name: str
) -> DataFrame:
    averages = df.groupBy(*_keys(columns)).agg(F.avg(value).alias(name))
    return averages.orderBy(F.desc(quoted(name)), *_keys(columns))


def nonneg_avg_by(
    df: DataFrame, columns: Sequence[str], column: str, name: str | None = None
) -> DataFrame:
    """Average of the values ``>= 0`` per group, largest first.

    A group without such a value stays, with NULL, at the end.
    """
    value = nonneg(F.col(quoted(column)))
    return _conditional_avg_by(df, columns, value, name or _delay_name("positive", column))


def neg_avg_by(
    df: DataFrame, columns: Sequence[str], column: str, name: str | None = None
) -> DataFrame:
    """Average of the values ``< 0`` per group, largest first, NULL at the end."""
    value = negative(F.col(quoted(column)))
    return _conditional_avg_by(df, columns, value, name or _delay_name("negative", column))


def numeric_stats(df: DataFrame, columns: Sequence[str], column: str) -> DataFrame:
    """``average_x``, ``min_x`` and ``max_x`` per group, highest average first."""
    value = F.col(quoted(column))
    stats = df.groupBy(*_keys(columns)).agg(
        F.avg(value).alias(f"average_{column}"),
        F.min(value).alias(f"min_{column}"),
        F.max(value).alias(f"max_{column}"),
    )
    return stats.orderBy(F.desc(quoted(f"average_{column}")), *_keys(columns))


def average_by(df: DataFrame, columns: Sequence[str], column: str) -> DataFrame:
    """``avg_x`` per group, highest first."""
    averages = df.groupBy(*_keys(columns)).agg(
        F.avg(F.col(quoted(column))).alias(f"avg_{column}")
    )
    return averages.orderBy(F.desc(quoted(f"avg_{column}")), *_keys(columns))


def where_equal(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Rows in which every named column equals its value."""
    for name, value in values.items():
        df = df.filter(F.col(quoted(name)) == value)
    return df


def filtered_avg(
    df: DataFrame, values: dict[str, Any], column: str, name: str | None = None
) -> DataFrame:
    """Average over the rows matching ``values``; no row when nothing matches."""
    value = F.avg(F.col(quoted(column)))
    matching = where_equal(df, values).groupBy(*_keys(list(values)))
    return matching.agg(value.alias(name or f"average_{column} (mins)"))


def filtered_sum_scaled(
    df: DataFrame,
    values: dict[str, Any],
    column: str,
    divisor: float = 60,
    name: str | None = None,
) -> DataFrame:
    """Sum over the rows matching ``values``, divided; no row when nothing matches."""
    value = F.sum(F.col(quoted(column))) / F.lit(divisor)
    matching = where_equal(df, values).groupBy(*_keys(list(values)))
    return matching.agg(value.alias(name or f"total_{column} (hours)"))


def distinct_by(
    df: DataFrame, columns: dict[str, str | int], rsd: float | None = None
) -> DataFrame:
    """One row of distinct counts; ``columns`` maps output name to column or position.

    Whole numbers are counted as bits, 64 neighbours in one number: where ids are dense,
    a row is shuffled for 64 of them. Each column is counted by a scan of its own
    instead of by rows expanded per column. NULL is no value.

    With ``rsd`` the counts are HyperLogLog estimates of that relative standard
    deviation, which shuffle a sketch per task instead of the distinct values.
    """
    names = {name: column_at(df, column) for name, column in columns.items()}
    if rsd is not None:
        return df.agg(*[F.approx_count_distinct(quoted(c), rsd).alias(name) for name, c in names.items()])
    if len(names) == 1:
        return _one_count(df, *names.items())
    return df.sparkSession.range(1).select(
        *[_one_count(df, item).scalar().alias(item[0]) for item in names.items()]
    )


def _one_count(df: DataFrame, item: tuple[str, str]) -> DataFrame:
    """One row with the number of different values of a column."""
    name, column = item
    value = F.col(quoted(column))
    if not isinstance(df.select(value).schema[0].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return df.agg(F.count_distinct(value).alias(name))
    number = df.select(value.cast("long").alias("_value"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_value").bitwiseAND(F.lit(63)).cast("int"))
    words = number.groupBy(F.shiftright("_value", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return words.agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("long").alias(name))


def year_counts(df: DataFrame, year: str) -> DataFrame:
    """Rows per year, largest first; the empty string counts as a year."""
    return count_by(df, [year])


def year_range(df: DataFrame, year: str) -> DataFrame:
    """One row ``min_year, max_year`` in string order, empty years left out."""
    value = F.col(quoted(year))
    return df.filter(value != "").agg(
        F.min(value).alias("min_year"), F.max(value).alias("max_year")
    )
