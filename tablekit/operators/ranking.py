"""Top-k overall and per group, global index, group totals."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.operators.aggregate import grouped_counts, where_equal
from tablekit.operators.quality import quoted
from tablekit.scratch import written

# monotonically_increasing_id: partition number above these bits, row below.
_ROW_BITS = 33

# File and first byte of the piece of it that one task reads.
_PIECE = ("_path", "_start")


def _keys(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def top_n_by(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` most frequent combinations of ``columns`` with their ``count``."""
    return grouped_counts(df, columns).orderBy(F.desc("count"), *_keys(columns)).limit(n)


def bottom_n_by(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` least frequent combinations of ``columns`` with their ``count``."""
    return grouped_counts(df, columns).orderBy(F.asc("count"), *_keys(columns)).limit(n)


def lowest_n_where(
    df: DataFrame,
    values: dict[str, Any],
    select: Sequence[str],
    measure: str,
    n: int,
    tie_break: Sequence[str],
) -> DataFrame:
    """The ``n`` matching rows with the smallest measure; NULL is smallest."""
    rows = where_equal(df, values).select(*_keys(select))
    return rows.orderBy(F.asc(quoted(measure)), *_keys(tie_break)).limit(n)


def highest_n_where(
    df: DataFrame,
    values: dict[str, Any],
    select: Sequence[str],
    measure: str,
    n: int,
    tie_break: Sequence[str],
) -> DataFrame:
    """The ``n`` matching rows with the largest measure; NULL comes last."""
    rows = where_equal(df, values).select(*_keys(select))
    return rows.orderBy(F.desc(quoted(measure)), *_keys(tie_break)).limit(n)


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[Column],
    n: int,
    slices: int = 512,
) -> DataFrame:
    """The first ``n`` rows of every group in the given (total) order.

    Rows are ranked in slices of their group first, one per set of input
    partitions, then across the slices: however many partitions there are, the last
    step sees at most ``n * slices`` rows of a group. Up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` rows Spark also keeps only the
    best ``n`` rows per group in each task before they are shuffled.
    """
    # The partition a row comes from is the same when its task runs again.
    sliced = df.withColumn("_slice", F.spark_partition_id() % F.lit(slices))
    best = _first_n(sliced, [*groups, "_slice"], order_by, n).drop("_slice")
    return _first_n(best, groups, order_by, n)


def _first_n(
    df: DataFrame, groups: Sequence[str], order_by: Sequence[Column], n: int
) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*_keys(groups)).orderBy(*order_by))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def most_frequent(df: DataFrame, column: str) -> Column:
    """The most frequent value as a scalar subquery; ties go to the smallest."""
    return top_n_by(df, [column], 1).select(F.col(quoted(column))).scalar()


def top_n_lookup(
    df: DataFrame, names: DataFrame, key: str, n: int, count_name: str = "count"
) -> DataFrame:
    """The ``n`` most frequent keys with the columns of ``names``, largest first.

    Spark knows the top side has at most ``n`` rows and broadcasts it when that
    is little; ``names`` is then only scanned.
    """
    top = top_n_by(df, [key], n).withColumnRenamed("count", count_name)
    found = names.join(top, on=[key], how="inner")
    return found.orderBy(F.desc(quoted(count_name)), F.col(quoted(key)))


def attach_group_total(
    df: DataFrame, groups: Sequence[str], name: str = "group_total"
) -> DataFrame:
    """Every row with the number of rows in its group.

    A window would send each group whole to one task. The totals are written
    instead (one row per group) and joined back: Spark broadcasts them when
    their file is small enough and otherwise shuffles, splitting hot keys. Rows
    whose group is NULL keep their total.
    """
    totals = grouped_counts(df, groups).select(
        *[F.col(quoted(g)).alias(f"_group_{i}") for i, g in enumerate(groups)],
        F.col("count").alias(name),
    )
    totals = written(totals, "group-totals")
    same_group = [
        df[quoted(g)].eqNullSafe(totals[f"_group_{i}"]) for i, g in enumerate(groups)
    ]
    return df.join(totals, on=same_group, how="inner").drop(
        *[f"_group_{i}" for i in range(len(groups))]
    )


def add_index(
    df: DataFrame, order_by: Sequence[Column] | None = None, name: str = "idx"
) -> DataFrame:
    """Contiguous 0-based index, in the given order or else in input order.

    Input order is that of files by path and of rows within a file, for a table read
    from files and not shuffled since. Other tables without ``order_by`` get a unique
    and contiguous index in no promised order.

    Rows of parquet files know their place in the file; where all rows of the files are
    there, the numbers of rows in the files before are added to it and nothing else is
    written. Otherwise each task numbers its own rows; the numbered table is written
    once, and the rows before each piece (a part of a file, or a partition) are added to
    it. Tied rows are numbered by the partition they come from, so the sort can spread a
    value that most rows share, or copies of one row, over many tasks.
    """
    if order_by is None and (indexed := _indexed_in_files(df, name)) is not None:
        return indexed
    if order_by is not None:
        # The partition a row comes from is the same when its task runs again.
        placed = df.withColumn("_from", F.spark_partition_id())
        df = placed.orderBy(*order_by, "_from").drop("_from")
        pieces = None
    else:
        pieces = _with_file_piece(df)
    numbered = (df if pieces is None else pieces).withColumn("_id", F.monotonically_increasing_id())
    rows = written(numbered, "indexed").withColumn(
        "_part", F.shiftrightunsigned(F.col("_id"), _ROW_BITS)
    )
    keys = ["_part"]
    if pieces is not None:
        # A piece whose rows do not follow each other was shuffled after it was read.
        gaps = F.max("_id") - F.min("_id") + 1 != F.count("*")
        if rows.groupBy(*_PIECE).agg(gaps.alias("gaps")).filter("gaps").isEmpty():
            keys = list(_PIECE)
        else:
            rows = rows.drop(*_PIECE)
    # One row per piece of the numbered table, so this window is small.
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    offsets = offsets.select(
        *keys, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # Spark chooses the join by the size of the offsets.
    indexed = rows.join(offsets, on=keys)
    place = F.col("_before") + F.col("_id") - F.col("_first")
    return indexed.select(*[F.col(quoted(c)) for c in df.columns], place.alias(name))


def _indexed_in_files(df: DataFrame, name: str) -> DataFrame | None:
    """The rows numbered by file and place in it, if each row of the files is there once."""
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return None  # files that do not number their rows, or no files
    # Which places are taken, as bits: about one bit a row is shuffled.
    taken = F.bitmap_construct_agg(F.bitmap_bit_position("_row"))
    blocks = rows.groupBy("_path", F.bitmap_bucket_number("_row").alias("_block")).agg(
        F.count("*").alias("_rows"), F.bitmap_count(taken).alias("_places"), F.max("_row").alias("_last")
    )
    files = blocks.groupBy("_path").agg(
        F.sum("_rows").alias("_rows"), F.sum("_places").alias("_places"), (F.max("_last") + 1).alias("_end")
    )
    files = written(files, "file-rows")
    if not files.filter("_rows != _places OR _rows != _end").isEmpty():
        return None
    # One row per file, so this window is small; Spark chooses the join by its size.
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_path", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_row")
    return rows.join(offsets, on="_path").select(*[F.col(quoted(c)) for c in df.columns], place.alias(name))


def _with_file_piece(df: DataFrame) -> DataFrame | None:
    """The rows with the file they come from and the place of their piece in it."""
    names = ("file_path", "file_block_start")
    try:
        return df.select("*", *[F.col(f"_metadata.{n}").alias(p) for n, p in zip(names, _PIECE, strict=True)])
    except AnalysisException:
        return None  # not read from files, or from several tables
