"""Movie ratings: reviewers, genres, age groups, occupations, recommendations."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions import year_of
from tablekit.operators import ratings as R
from tablekit.operators.aggregate import distinct_by, year_counts, year_range
from tablekit.operators.quality import shape
from tablekit.operators.ranking import top_n_by, top_n_lookup
from tablekit.operators.recommend import Recommender, als_fit
from tablekit.sources import write_partitioned

# Field names of the headerless input files.
RATING_SCHEMA = "user_id int, movie_id int, rating float, timestamp long"
GENRE_SCHEMA = "genre string, genre_id int"
USER_SCHEMA = "user_id int, age int, gender string, occupation string, zip string"
ITEM_FIELDS = (
    "movie_id int, movie_name string, release_date string, video_date string, url string"
)

# Profiles of the new user that recommendations are made for.
NEW_PROFILES = ((0, 50, 5.0), (0, 172, 5.0), (0, 181, 5.0))


def item_schema(n_genres: int) -> str:
    """Schema of the movie file, which ends in one flag per genre."""
    return ", ".join([ITEM_FIELDS, *[f"flag_{i} string" for i in range(n_genres)]])


def with_genres(items: DataFrame, genres: DataFrame) -> DataFrame:
    """Movies with the list of their genre names instead of the flags."""
    flags = [c for c in items.columns if c.startswith("flag_")]
    decoded = R.with_decoded_flags(items, F.array(*flags), len(flags), genres)
    return decoded.select("movie_id", "movie_name", "release_date", "genres")


def movie_report(
    ratings: DataFrame, movies: DataFrame, users: DataFrame
) -> dict[str, DataFrame]:
    """All results on ratings, movies (with genre lists) and users."""
    years = movies.select("movie_id", year_of(F.col("release_date")).alias("year"))
    of_year = R.movies_of_top_year(movies)
    of_summer = R.movies_of_months(movies)
    return {
        "shape": shape(ratings),
        "distinct": distinct_by(ratings, {"n_users": "user_id", "n_movies": "movie_id"}),
        "top_reviewers": top_n_by(ratings, ["user_id"], 10),
        "top_movies": top_n_lookup(ratings, movies, "movie_id", 10),
        "movies_by_year": year_counts(years, "year"),
        "year_range": year_range(years, "year"),
        "by_genre_top_year": R.top_n_per_genre(ratings, of_year, 3),
        "by_genre_summer": R.top_n_per_genre(ratings, of_summer, 3),
        "by_age_group": R.top_n_per_age_group(ratings, users, movies, 30),
        "by_occupation_genre": R.in_report_order(
            R.top_n_per_occupation_genre(ratings, users, movies, 3), ["occupation", "genre"]
        ),
        "administrator_action": R.in_report_order(
            R.top_n_per_occupation_genre(
                ratings, users, movies, 3, ["administrator"], ["Action"]
            ),
            ["occupation", "genre"],
        ),
    }


def write_movie_report(report: dict[str, DataFrame], folder: str) -> None:
    """Write the per-genre and per-age-group reports, one directory per group."""
    best = [F.desc("avg_rating"), F.asc("movie_id")]
    for name, group in (
        ("by_genre_top_year", "genre"),
        ("by_age_group", "age_group"),
        ("by_genre_summer", "genre"),
    ):
        write_partitioned(report[name], f"{folder}/{name}", group, best, one_file_per_group=True)


def fit_with_profiles(
    ratings: DataFrame, profiles: Sequence[Sequence[Any]] = NEW_PROFILES
) -> Recommender:
    """Add the new profiles to the ratings and fit the recommender."""
    triples = R.cast_ratings(ratings)
    return als_fit(R.union_rows(triples, profiles), rank=20, iterations=15)
