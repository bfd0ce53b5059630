"""Joins of a large table with a keyed one.

No join carries a broadcast hint: Spark broadcasts a side whose size it knows
to be below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, and
adaptive execution then splits a partition swollen by a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.operators.quality import quoted


def join_using(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which the key columns appear once."""
    return left.join(right, on=list(on), how=how)


def lookup_join(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None
) -> DataFrame:
    """Attach the columns of a lookup table; rows without an entry are dropped."""
    if lookup_key is not None and lookup_key != key:
        lookup = lookup.withColumnRenamed(lookup_key, key)
    return df.join(lookup, on=[key], how="inner")


def joined_counts(
    df: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``count`` of the joined rows per combination of ``columns`` of either side.

    The left rows are counted per key first, so the join sees one row per key
    and left group instead of every row, and a hot key shrinks before any
    shuffle. The result equals counting after the join.
    """
    left_columns = [c for c in columns if c in df.columns and c not in on]
    counted = df.groupBy(*[F.col(quoted(c)) for c in [*on, *left_columns]]).agg(
        F.count("*").alias("_n")
    )
    joined = counted.join(right, on=list(on), how="inner")
    return joined.groupBy(*[F.col(quoted(c)) for c in columns]).agg(
        F.sum("_n").alias("count")
    )


def joined_top_n(
    df: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    n: int,
    ascending: bool = False,
) -> DataFrame:
    """The ``n`` most (or least) frequent combinations among the joined rows."""
    order = F.asc("count") if ascending else F.desc("count")
    counts = joined_counts(df, right, on, columns)
    return counts.orderBy(order, *[F.col(quoted(c)) for c in columns]).limit(n)
