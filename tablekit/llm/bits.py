"""Rows told apart early by a bit table of fixed size.

Defined cases: a null is no number and its rows are not asked for; an empty table asks
for nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the table, which is at most 8 MB.
ID_BITS = 1 << 26


def asked_for(rows: DataFrame, column: str, asked: DataFrame, found: bool = True) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not among the numbers ``asked``, and no others lost.

    The numbers asked for set bits of a table of fixed size, which is broadcast; a
    join that follows then shuffles few rows it has no use for. With ``found`` False,
    the rows that are left out.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(ID_BITS)) + 1
    bits = asked.select(F.col(asked.columns[0]).alias("asked")).where("asked is not null")
    bits = bits.select(bit("asked").alias("bit")).distinct()
    pages = bits.groupBy(F.bitmap_bucket_number("bit").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("page_bits")
    )
    place = F.bitmap_bit_position(bit(column))
    byte = F.conv(F.hex(F.substring("page_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (place % 8).cast("int")) == 1
    met = (F.bitmap_bucket_number(bit(column)) == F.col("page")) & is_set & F.col(column).isNotNull()
    return rows.join(F.broadcast(pages), met, "left_semi" if found else "left_anti")
