"""Flight delays, durations, speeds and plane models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions import rate_per_hour
from tablekit.operators.aggregate import (
    count_by,
    filtered_avg,
    filtered_sum_scaled,
    neg_avg,
    neg_avg_by,
    nonneg_avg,
    nonneg_avg_by,
    numeric_stats,
    percentage_by,
)
from tablekit.operators.joins import join_using, joined_top_n
from tablekit.operators.quality import drop_missing, missing_count, missing_rows, shape
from tablekit.operators.ranking import highest_n_where, lowest_n_where, top_n_by
from tablekit.operators.sql import bottom_n_by_sql, top_n_by_sql

SPEED = "flight_speed (miles per hour)"
MODEL = ["carrier", "model", "plane_year"]


def with_speed(flights: DataFrame) -> DataFrame:
    """Flights with miles per hour from miles and minutes."""
    return flights.withColumn(SPEED, rate_per_hour(F.col("distance"), F.col("air_time")))


def plane_models(planes: DataFrame) -> DataFrame:
    """Planes without speed, their year renamed so that it does not clash with the flight's."""
    return planes.drop("speed").withColumnRenamed("year", "plane_year")


def delay_report(
    flights: DataFrame,
    planes: DataFrame,
    shortest_from: str = "PDX",
    longest_from: str = "SEA",
    carrier: str = "UA",
    n_planes: int = 10,
    n_models: int = 20,
) -> dict[str, DataFrame]:
    """All results on flights and their planes."""
    clean = drop_missing(flights)
    fast = with_speed(clean)
    models = plane_models(planes)
    # Rows with a missing value on either side are those of the joined table.
    whole, whole_models = drop_missing(fast), drop_missing(models)
    joined = join_using(whole, whole_models, ["tailnum"])
    trip = {"carrier": carrier, "origin": longest_from}
    report = {
        "shape": shape(flights),
        "missing_rows": missing_rows(flights),
        "missing_count": missing_count(flights),
        "flights_by_year_month": count_by(clean, ["year", "month"]),
        "flights_by_day": count_by(clean, ["day"]),
        "flights_by_origin": count_by(clean, ["origin"]),
        "flights_by_dest": count_by(clean, ["dest"]),
        "flights_by_hour": count_by(clean, ["hour"]),
        "share_by_carrier": percentage_by(clean, ["carrier"]),
        "top_planes": top_n_by(clean, ["tailnum"], n_planes),
        "positive_delay": nonneg_avg(clean, "dep_delay"),
        "negative_delay": neg_avg(clean, "dep_delay"),
        "distance_by_carrier": numeric_stats(clean, ["carrier"], "distance"),
        "speed_by_carrier": numeric_stats(fast, ["carrier"], SPEED),
        "shortest_flight": lowest_n_where(
            fast,
            {"origin": shortest_from},
            ["flight", "origin", "distance"],
            "distance",
            1,
            ["flight"],
        ),
        "longest_flight": highest_n_where(
            fast,
            {"origin": longest_from},
            ["flight", "origin", "air_time"],
            "air_time",
            1,
            ["flight"],
        ),
        "average_duration": filtered_avg(fast, trip, "air_time"),
        "total_duration": filtered_sum_scaled(fast, trip, "air_time"),
        "flights_with_planes": joined,
        "top_models": joined_top_n(whole, whole_models, ["tailnum"], MODEL, n_models),
        "bottom_models": joined_top_n(
            whole, whole_models, ["tailnum"], MODEL, n_models, ascending=True
        ),
        "top_models_sql": top_n_by_sql(joined, MODEL, n_models),
        "bottom_models_sql": bottom_n_by_sql(joined, MODEL, n_models),
    }
    for column in ("carrier", "month", "hour"):
        report[f"positive_delay_by_{column}"] = nonneg_avg_by(clean, [column], "dep_delay")
        report[f"negative_delay_by_{column}"] = neg_avg_by(clean, [column], "dep_delay")
    return report
