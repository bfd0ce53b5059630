"""String expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of an
# item. F.trim alone would remove the plain space only.
_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(_SPACE))


def cleanse(line: Column, sep: str = ",") -> Column:
    """Split a basket line into stripped, lower-cased items.

    Empty items stay, as in ``"milk, "`` -> ``["milk", ""]``.
    """
    items = F.split(line, re.escape(sep), -1)
    return F.transform(items, lambda item: F.lower(strip(item)))


def token_at(text: Column, sep: str, position: int) -> Column:
    """The ``position``-th token, counted from 1; NULL when there is none.

    ``sep`` is a regular expression.
    """
    if position < 1:
        raise ValueError("positions count from 1")
    return F.get(F.split(text, sep), position - 1)


def field_count(line: Column, sep: str) -> Column:
    """Number of fields of a line split on a literal delimiter."""
    return F.size(F.split(line, re.escape(sep), -1))


def year_of(date_text: Column) -> Column:
    """Last four characters of a date such as ``01-May-1995``."""
    return F.right(date_text, F.lit(4))


def month_of(date_text: Column) -> Column:
    """Lower-case month between the first three and last five characters."""
    return F.lower(F.substring(date_text, F.lit(4), F.greatest(F.length(date_text) - 8, F.lit(0))))
