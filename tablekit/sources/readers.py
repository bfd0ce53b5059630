"""Readers. All of them resolve the path at once, so a wrong one fails here."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablekit.functions import cleanse
from tablekit.operators.quality import quoted

# Types a column of text is tried for, narrowest first, with the form of their values.
INFERRED = (
    ("int", r"[+-]?\d+"),
    ("bigint", r"[+-]?\d+"),
    ("decimal(38,0)", r"[+-]?\d+"),
    ("double", r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|NaN|[+-]?Inf(?:inity)?"),
    ("date", r"\d{4}-\d{2}-\d{2}"),
    ("timestamp", r"\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?)?"),
    ("boolean", r"(?i:true|false)"),
)


def _found(path: str, read: Callable[[str], DataFrame]) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such file: {path}") from error
        raise


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``folder/name.parquet``."""
    return _found(f"{folder}/{name}.parquet", spark.read.parquet)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    null_value: str | Sequence[str] | None = None,
) -> DataFrame:
    """Delimited text with a header line; double quotes protect a field.

    Fields are read as text and cast as SQL does; values that do not fit their type are
    NULL. Empty fields are NULL, and so are those equal to a marker in ``null_value``.

    Give a ``schema`` for data of any size: without one, one aggregate over the whole
    text finds the first type of ``INFERRED`` that every field of a column fits, so
    the text is read twice. Columns without a value, or that fit no type, stay text.
    """
    markers = [null_value] if isinstance(null_value, str) else list(null_value or [])
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(StructType([StructField(f.name, StringType()) for f in fields]))
    text = _found(path, reader.csv)
    values = [text[quoted(c)] for c in text.columns]
    if markers:
        values = [F.when(~v.isin(markers), v) for v in values]
    types = _narrowest_types(text, values) if schema is None else [f.dataType for f in fields]
    return text.select(
        *[v.try_cast(t).alias(c) for v, t, c in zip(values, types, text.columns, strict=True)]
    )


def _narrowest_types(text: DataFrame, values: Sequence[Column]) -> list[str]:
    """The first type of ``INFERRED`` that all values of each column fit; one aggregate."""

    def fitting(value: Column) -> Column:
        bits = [
            F.when(value.rlike(f"^(?:{form})$") & value.try_cast(kind).isNotNull(), 1 << i).otherwise(0)
            for i, (kind, form) in enumerate(INFERRED)
        ]
        return F.when(value.isNotNull(), sum(bits[1:], bits[0]))

    if not values:
        return []
    found = text.agg(*[F.bit_and(fitting(v)).alias(f"_{i}") for i, v in enumerate(values)]).first()
    kinds = [kind for kind, _ in INFERRED]
    return [next((k for i, k in enumerate(kinds) if (mask or 0) >> i & 1), "string") for mask in found]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per text line."""
    return _found(path, spark.read.text)


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ","
) -> DataFrame:
    """Text without header, split on a literal delimiter; quotes are plain text.

    An empty field is an empty string. Fields a short line lacks, and values
    that do not fit their type, are NULL; fields beyond the schema are dropped.
    """
    fields = F.split("value", re.escape(sep), -1)
    columns = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return read_lines(spark, path).select(
        *[
            F.get(fields, F.lit(i)).try_cast(field.dataType).alias(field.name)
            for i, field in enumerate(columns)
        ]
    )


def read_baskets(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """One row ``items`` (cleansed array) per text line."""
    return read_lines(spark, path).select(cleanse(F.col("value"), sep).alias("items"))


def from_rows(
    spark: SparkSession, rows: Sequence[Sequence[Any]], schema: StructType | str
) -> DataFrame:
    """A table from rows written in the program (new profiles, lookups)."""
    return spark.createDataFrame(rows, schema)


def sql_over(df: DataFrame, query: str, **args: Any) -> DataFrame:
    """Run SQL in which ``{df}`` stands for the table; no global view is left."""
    return df.sparkSession.sql(query, df=df, **args)
