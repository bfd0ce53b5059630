"""Missing data, shape and numeric profile of a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Type-name prefixes that count as numeric. Long, short and byte
# columns ("bigint", "smallint", "tinyint") are left out.
NUMERIC_PREFIXES = ("int", "double", "float", "decimal")

_PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
# A sketch is off by at most one such part of the values; so many are sorted at the end of a search.
SKETCH, SORTED_VALUES = 1_000, 20_000


def quoted(name: str) -> str:
    """A column name quoted so that dots, spaces and back-ticks are plain text."""
    return "`" + name.replace("`", "``") + "`"


def any_missing(df: DataFrame, subset: Sequence[str] | None = None) -> Column:
    """True where a column is NULL. NaN and empty strings are not missing."""
    names = df.columns if subset is None else subset
    return reduce(lambda a, b: a | b, [df[quoted(n)].isNull() for n in names], F.lit(False))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value; give ``subset`` to read those columns only."""
    return df.filter(~any_missing(df, subset))


def missing_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with at least one missing value."""
    return df.filter(any_missing(df, subset))


def missing_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row ``missing_rows``."""
    return missing_rows(df, subset).agg(F.count("*").alias("missing_rows"))


def shape(df: DataFrame) -> DataFrame:
    """One row ``num_rows, num_columns``."""
    return df.agg(
        F.count("*").alias("num_rows"), F.lit(len(df.columns)).alias("num_columns")
    )


def numeric_columns(df: DataFrame, prefixes: Sequence[str] = NUMERIC_PREFIXES) -> list[str]:
    """Names of the columns whose type name starts with one of ``prefixes``."""
    return [name for name, kind in df.dtypes if kind.startswith(tuple(prefixes))]


def select_numeric(df: DataFrame, prefixes: Sequence[str] = NUMERIC_PREFIXES) -> DataFrame:
    """The numeric columns only."""
    return df.select([df[quoted(n)] for n in numeric_columns(df, prefixes)])


def numeric_summary(
    df: DataFrame,
    prefixes: Sequence[str] = NUMERIC_PREFIXES,
    rank_error: float | None = None,
) -> DataFrame:
    """One row per numeric column: n, mean, stddev, min, p25, p50, p75, max.

    Percentile q is the value at rank ``ceil(q * n)``, exact and the same in every
    run for a table of any length; NaN is the largest value. With ``rank_error``
    (such as 0.001) percentiles may be off by that share of the rows; the table is
    then read once.

    Exact percentiles are found by bracket search: a sketch of the values gives two
    values close around each rank, a count of the values below, at, between and above
    them tells where the rank lies, and the search goes on between them until what is
    left is few. Only sketches and counts are shuffled, however many values differ.
    """
    names = numeric_columns(df, prefixes)
    if not names:
        raise ValueError("the table has no numeric column")
    values = df.select(
        *[df[quoted(name)].cast("double").alias(f"v{i}") for i, name in enumerate(names)]
    )
    profiles = [_profile(name, i, rank_error) for i, name in enumerate(names)]
    rows = values.agg(*[p.alias(f"p{i}") for i, p in enumerate(profiles)])
    rows = rows.select(F.inline(F.array(*[f"p{i}" for i in range(len(names))])))
    if rank_error is None:
        # One row per column; the ranks follow from the numbers of values.
        rows = df.sparkSession.createDataFrame(rows.collect(), rows.schema)
        found = _exact_percentiles(values, [r["n"] for r in rows.orderBy("place").collect()])
        fields = ", ".join(["place int", *[f"{p} double" for p in _PERCENTILES]])
        rows = rows.join(F.broadcast(df.sparkSession.createDataFrame(found, fields)), on="place", how="left")
    return rows.select("column", "n", "mean", "stddev", "min", *_PERCENTILES, "max")


def _profile(name: str, place: int, rank_error: float | None) -> Column:
    """Moments and bounds of a column, with its approximate percentiles if asked for."""
    value = F.col(f"v{place}")
    fields = [
        F.lit(place).alias("place"),
        F.lit(name).alias("column"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    if rank_error is not None:
        accuracy = F.lit(round(1 / rank_error))
        fields += [F.percentile_approx(value, q, accuracy).alias(p) for p, q in _PERCENTILES.items()]
    return F.struct(*fields)


@dataclass
class _Bracket:
    """The open interval that holds one rank: values of a column above ``low`` and below ``high``."""

    place: int
    name: str
    rank: int  # among all values of the column, from 1
    inside: int  # values in the interval
    below: int = 0  # values up to ``low``
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def values(self) -> Column:
        """The column's values inside, NULL elsewhere."""
        value, within = F.col(f"v{self.place}"), F.col(f"v{self.place}").isNotNull()
        if self.low is not None:
            within &= value > F.lit(self.low)
        if self.high is not None:
            within &= value < F.lit(self.high)
        return F.when(within, value)

    def sketch(self) -> Column:
        """Two values around the rank, each off by at most ``1 / SKETCH`` of those inside."""
        share = (self.rank - self.below) / self.inside
        shares = [max(0.0, share - 2 / SKETCH), min(1.0, share + 2 / SKETCH)]
        return F.percentile_approx(self.values(), shares, F.lit(SKETCH))

    def counts(self, a: float, b: float) -> list[Column]:
        """Values inside below ``a``, at ``a``, between, and at ``b``."""
        value = self.values()
        conditions = [value < F.lit(a), value == F.lit(a), (value > F.lit(a)) & (value < F.lit(b))]
        conditions.append((value == F.lit(b)) & (F.lit(a) < F.lit(b)))
        return [F.count_if(F.coalesce(c, F.lit(False))) for c in conditions]

    def narrow(self, a: float, b: float, counts: Sequence[int]) -> None:
        """Goes on in the part that holds the rank, or ends at ``a`` or ``b``."""
        less, at_a, between, at_b = counts
        rank = self.rank - self.below
        if rank <= less:
            self.high, self.inside = a, less
        elif rank <= less + at_a:
            self.found = a
        elif rank <= less + at_a + between:
            self.below, self.low, self.high, self.inside = self.below + less + at_a, a, b, between
        elif rank <= less + at_a + between + at_b:
            self.found = b
        else:
            passed = less + at_a + between + at_b
            self.below, self.low, self.inside = self.below + passed, b, self.inside - passed


def _exact_percentiles(values: DataFrame, counts: Sequence[int]) -> list[tuple]:
    """``(place, p25, p50, p75)`` of the columns that hold a value.

    Each round reads the table twice, for sketches and for counts, and leaves at
    most a few thousandths of the values in a bracket; values at the ends of a
    bracket are counted apart, so one that many rows share ends the search.
    """
    brackets = [
        _Bracket(place, name, ceil(q * n), n)
        for place, n in enumerate(counts)
        if n
        for name, q in _PERCENTILES.items()
    ]
    while wide := [b for b in brackets if b.found is None and b.inside > SORTED_VALUES]:
        ends = values.agg(*[b.sketch().alias(f"b{i}") for i, b in enumerate(wide)]).first()
        asked = [c.alias(f"c{i}_{k}") for i, b in enumerate(wide) for k, c in enumerate(b.counts(*ends[i]))]
        told = values.agg(*asked).first()
        for i, b in enumerate(wide):
            b.narrow(*ends[i], told[4 * i : 4 * i + 4])
    if narrow := [b for b in brackets if b.found is None]:
        # At most SORTED_VALUES rows per bracket are left to be ranked.
        left = F.array(*[F.struct(F.lit(i).alias("bracket"), b.values().alias("value")) for i, b in enumerate(narrow)])
        entries = values.select(F.inline(F.filter(left, lambda x: x["value"].isNotNull())))
        times = entries.groupBy("bracket", "value").agg(F.count("*").alias("times"))
        through = Window.partitionBy("bracket").orderBy("value")
        rank = F.element_at(F.array(*[F.lit(b.rank - b.below) for b in narrow]), F.col("bracket") + 1)
        reached = times.withColumn("reached", F.sum("times").over(through)).filter(F.col("reached") >= rank)
        for row in reached.groupBy("bracket").agg(F.min("value").alias("value")).collect():
            narrow[row["bracket"]].found = row["value"]
    by_place: dict[int, dict[str, float]] = {}
    for b in brackets:
        by_place.setdefault(b.place, {})[b.name] = b.found
    return [(place, *[found[p] for p in _PERCENTILES]) for place, found in by_place.items()]
