"""Labels for numbers that fall into configured ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Half-open mileage classes (min, max].
MPG_CLASSES = {
    "low": {"max_value": 20},
    "mid": {"min_value": 20, "max_value": 30},
    "high": {"min_value": 30, "max_value": 40},
    "very high": {"min_value": 40},
}

# Closed age ranges [low, high]; None leaves a side open.
AGE_GROUPS = (
    (0, 6, "[0-6]"),
    (7, 12, "(6-12]"),
    (13, 18, "(12-18]"),
    (19, 30, "(18-30]"),
    (31, 50, "(30-50]"),
    (51, None, "50+"),
)


def bin_label(value: Column, bins: Mapping[str, Mapping[str, float]]) -> Column:
    """Name of the first bin ``(min_value, max_value]`` holding the value.

    A missing bound leaves that side open. NULL, NaN and values outside every
    bin give NULL; a bin called ``unknown`` is ignored.
    """
    # NaN sorts above every number in Spark, so an open upper side needs the test.
    known = ~F.isnan(value.cast("double"))
    label: Column | None = None
    for name, bounds in bins.items():
        if name == "unknown":
            continue
        inside = known
        if bounds.get("min_value") is not None:
            inside = inside & (value > bounds["min_value"])
        if bounds.get("max_value") is not None:
            inside = inside & (value <= bounds["max_value"])
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return F.lit(None).cast("string") if label is None else label


def range_label(
    value: Column,
    ranges: Sequence[tuple[int | None, int | None, str]] = AGE_GROUPS,
    default: str = "Unknown",
) -> Column:
    """Label of the first closed range ``[low, high]`` holding the value.

    NULL and values outside every range get ``default``.
    """
    label: Column | None = None
    for low, high, name in ranges:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (value >= low)
        if high is not None:
            inside = inside & (value <= high)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return F.lit(default) if label is None else label.otherwise(default)
