"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_member(members: Column, value: str | Column) -> Column:
    """True where the array holds the value."""
    return F.array_contains(members, value)


def decode_flags(flags: Column, names: Column, on: str = "1") -> Column:
    """Names of the positions whose flag equals ``on``, in position order.

    ``names`` is a column holding a map from 0-based position to name. A set
    flag whose position is not in the map is dropped.
    """
    decoded = F.transform(flags, lambda flag, i: F.when(flag == on, F.try_element_at(names, i)))
    return F.filter(decoded, lambda name: name.isNotNull())
