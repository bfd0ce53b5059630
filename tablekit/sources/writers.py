"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame,
    path: str,
    group: str,
    order_by: Sequence[Column],
    one_file_per_group: bool = False,
    fmt: str = "parquet",
    max_file_rows: int = 1_000_000,
) -> None:
    """Write one directory per group with ordered rows; fails if ``path`` exists.

    All groups are written by one job. By default rows are range-partitioned by
    group, order and origin, so a group holding most of the data, tied rows and
    copies included, is spread over many files whose names follow the order.
    ``one_file_per_group`` puts each group into a single file, for groups of bounded
    size such as top-n reports: the groups are counted first, and one of more than
    ``max_file_rows`` rows is an error before anything is written.
    """
    if one_file_per_group:
        sizes = df.groupBy(F.col(group)).agg(F.count("*").alias("_rows"))
        large = sizes.filter(F.col("_rows") > max_file_rows).first()
        if large is not None:
            raise ValueError(
                f"group {large[0]!r} of {group} has {large[1]} rows, more than {max_file_rows} for one file"
            )
        placed = df.repartition(group)
    else:
        # The partition a row comes from is the same when its task runs again.
        origin = df.withColumn("_from", F.spark_partition_id())
        placed = origin.repartitionByRange(group, *order_by, "_from").drop("_from")
    (
        placed.sortWithinPartitions(F.col(group), *order_by)
        .write.partitionBy(group)
        .mode("errorifexists")
        .format(fmt)
        .save(path)
    )


def preview(df: DataFrame, max_rows: int = 100, show_rows: int = 20) -> DataFrame:
    """All rows of a table of up to ``max_rows``, else the first ``show_rows``.

    ``take`` reads partitions only until it has ``max_rows + 1`` rows; the
    table is never counted.
    """
    rows = df.take(max_rows + 1)
    shown = rows if len(rows) <= max_rows else rows[:show_rows]
    return df.sparkSession.createDataFrame(shown, df.schema)
