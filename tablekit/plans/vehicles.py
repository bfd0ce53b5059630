"""Fuel economy by maker, country, cylinders and model year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions import bin_label, token_at
from tablekit.functions.labels import MPG_CLASSES
from tablekit.operators.aggregate import average_by, count_by, numeric_stats
from tablekit.operators.joins import lookup_join
from tablekit.operators.quality import (
    drop_missing,
    missing_count,
    missing_rows,
    numeric_summary,
    shape,
)
from tablekit.operators.sql import average_by_sql, numeric_stats_sql

# Column types of the two input files.
VEHICLE_SCHEMA = (
    "mpg double, cylinders int, displacement double, horsepower double, weight double, "
    "acceleration double, modelyear int, origin int, carname string"
)
MAKER_SCHEMA = "manufacturer string, country string"


def described(vehicles: DataFrame) -> DataFrame:
    """Vehicles with maker (first word of the name), four-digit year and mileage class."""
    return vehicles.withColumns(
        {
            "manufacturer": token_at(F.col("carname"), " ", 1),
            "modelyear": F.concat(F.lit("19"), F.col("modelyear").cast("string")),
            "mpg_class": bin_label(F.col("mpg"), MPG_CLASSES),
        }
    )


def vehicle_report(vehicles: DataFrame, makers: DataFrame) -> dict[str, DataFrame]:
    """All results on vehicles and their makers."""
    clean = drop_missing(vehicles)
    labelled = described(clean)
    full = lookup_join(labelled, makers, "manufacturer")
    report = {
        "shape": shape(vehicles),
        "missing_rows": missing_rows(vehicles),
        "missing_count": missing_count(vehicles),
        "summary": numeric_summary(clean),
        "vehicles_by_manufacturer": count_by(labelled, ["manufacturer"]),
        "vehicles_by_modelyear": count_by(labelled, ["modelyear"]),
        "vehicles_by_mpg_class": count_by(labelled, ["mpg_class"]),
        "vehicles_with_country": full,
        "mpg_by_car": average_by(full, ["carname", "manufacturer"], "mpg"),
        "mpg_by_car_sql": average_by_sql(full, ["carname", "manufacturer"], "mpg"),
    }
    for column in ("country", "cylinders", "modelyear", "manufacturer"):
        report[f"mpg_by_{column}"] = numeric_stats(full, [column], "mpg")
        report[f"mpg_by_{column}_sql"] = numeric_stats_sql(full, [column], "mpg")
    return report
