"""Ratings analytics over ``ratings(user_id, movie_id, rating)``.

``movies`` has one row per ``movie_id`` with ``movie_name`` and, where genres
matter, ``genres`` (array); ``users`` has one row per ``user_id``. Ratings are
reduced to one row per movie (and user attribute) before titles or genres are
attached, so only reduced rows are joined and exploded.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tablekit.functions import decode_flags, month_of, range_label, year_of
from tablekit.functions.labels import AGE_GROUPS
from tablekit.operators.ranking import most_frequent, top_n_per_group
from tablekit.scratch import written

# The summer months as they appear in release dates.
SUMMER = ("may", "jun", "jul")

# Labels per number of a list's bit mask; the sign bit stays free.
_WORD_BITS = 63


def cast_ratings(df: DataFrame) -> DataFrame:
    """The rating triple as ``int, int, float``."""
    return df.select(
        F.col("user_id").cast("int"), F.col("movie_id").cast("int"), F.col("rating").cast("float")
    )


def union_rows(df: DataFrame, rows: Sequence[Sequence[Any]]) -> DataFrame:
    """Append rows written in the program, in the column order of ``df``; keep duplicates."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))


def distinct_pairs(df: DataFrame, key: str, label: str) -> DataFrame:
    """The different ``(key, label)`` combinations."""
    return df.select(key, label).distinct()


def group_lists(
    df: DataFrame,
    key: str,
    label: str,
    name: str,
    labels: Sequence[Any] | None = None,
    max_labels: int = 1024,
) -> DataFrame:
    """One row per key with the sorted list of its different labels.

    Meant for labels from a fixed set, such as age groups. The set is ``labels``, or is
    found by one aggregate; more than ``max_labels`` of them are an error, as a list
    could then outgrow a row, and so is a value outside a given set. A key's labels are
    bits of a few numbers, combined before they are shuffled and decoded once. NULL
    labels are in no list; a key without others has an empty one.
    """
    value = F.col(label)
    if labels is None:
        different = df.select(value).filter(value.isNotNull()).distinct()
        labels = [r[0] for r in different.orderBy(value).limit(max_labels + 1).collect()]
    else:
        labels = sorted(labels)
    if len(labels) > max_labels:
        raise ValueError(f"{label} has more than {max_labels} different values")
    known = F.array(*[F.lit(v) for v in labels]).cast(ArrayType(df.select(value).schema[0].dataType))
    place = F.array_position(known, value)
    unknown = F.raise_error(F.concat(F.lit(f"value of {label} not among the labels: "), value.cast("string")))
    numbered = df.select(key, F.when(place == 0, unknown.cast("int")).otherwise(place - 1).cast("int").alias("_bit"))
    n_words = max(1, -(-len(labels) // _WORD_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit") % _WORD_BITS)
    in_word = [F.floor(F.col("_bit") / _WORD_BITS) == w for w in range(n_words)]
    masks = numbered.groupBy(key).agg(
        *[F.coalesce(F.bit_or(F.when(inside, bit)), F.lit(0).cast("long")).alias(f"_mask_{w}") for w, inside in enumerate(in_word)]
    )
    words = F.array(*[f"_mask_{w}" for w in range(n_words)])

    def held(_, i: Column) -> Column:
        word = F.get(words, F.floor(i / _WORD_BITS).cast("int"))
        return F.call_function("getbit", word, i % _WORD_BITS) == 1

    return masks.select(key, F.filter(known, held).alias(name))


def attach_group_list(df: DataFrame, key: str, label: str, name: str) -> DataFrame:
    """Every row with the list of all labels its key occurs with.

    The lists (one row per key) are written, so that Spark knows their size: it
    broadcasts them when small, and otherwise can split a hot key of ``df``,
    which it does not do against an aggregate. Rows whose key is NULL have a list
    of their own.
    """
    lists = written(group_lists(df, key, label, name), "group-lists")
    lists = lists.withColumnRenamed(key, "_list_key")
    return df.join(lists, df[key].eqNullSafe(lists["_list_key"]), "inner").drop("_list_key")


def _stats(ratings: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ratings.groupBy(*keys).agg(
        F.count("*").alias("n_reviews"), F.avg("rating").alias("avg_rating")
    )


def review_stats(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Number of reviews and average rating per movie, with the movie's columns."""
    return _stats(ratings, ["movie_id"]).join(movies, on="movie_id")


def review_stats_by(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, attribute: str
) -> DataFrame:
    """``review_stats`` per value of a user attribute and movie."""
    rated = ratings.join(users.select("user_id", attribute), on="user_id")
    return _stats(rated, [attribute, "movie_id"]).join(movies, on="movie_id")


def with_decoded_flags(
    df: DataFrame, flags: Column, n_flags: int, lookup: DataFrame, name: str = "genres"
) -> DataFrame:
    """Add the names of the set flags as an array.

    ``lookup(genre_id, genre)`` has one row per flag position; it becomes one
    map in a scalar subquery. Positions beyond the flags are ignored.
    """
    entries = F.collect_list(F.struct("genre_id", "genre"))
    known = lookup.filter(F.col("genre_id").between(0, n_flags - 1))
    names = known.agg(F.map_from_entries(entries)).scalar()
    decoded = decode_flags(flags, F.col("_names"))
    return df.withColumn("_names", names).withColumn(name, decoded).drop("_names")


def with_age_group(users: DataFrame, age: str = "age") -> DataFrame:
    """Users with the label of their age range."""
    return users.withColumn("age_group", range_label(F.col(age)))


def movies_of_top_year(movies: DataFrame, release_date: str = "release_date") -> DataFrame:
    """Movies of the year with most movies; the year is found by a scalar subquery."""
    years = movies.select(year_of(F.col(release_date)).alias("year"))
    return movies.filter(year_of(F.col(release_date)) == most_frequent(years, "year"))


def movies_of_months(
    movies: DataFrame, months: Sequence[str] = SUMMER, release_date: str = "release_date"
) -> DataFrame:
    """Movies released in one of the months (lower case)."""
    return movies.filter(month_of(F.col(release_date)).isin(list(months)))


def _by_genre(stats: DataFrame) -> DataFrame:
    """A movie counts once in each of its genres."""
    genre = F.explode(F.array_distinct("genres")).alias("genre")
    return stats.select(genre, *[c for c in stats.columns if c != "genres"])


def _ratings_of(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    return ratings.join(movies.select("movie_id"), on="movie_id", how="left_semi")


def top_n_per_genre(ratings: DataFrame, movies: DataFrame, n: int = 3) -> DataFrame:
    """For every genre the ``n`` movies with most reviews.

    Ratings of other movies than those given are left out before they are counted.
    """
    ratings = _ratings_of(ratings, movies)
    ranked = _by_genre(review_stats(ratings, movies.select("movie_id", "movie_name", "genres")))
    best = top_n_per_group(ranked, ["genre"], [F.desc("n_reviews"), F.asc("movie_id")], n)
    return best.select("genre", "movie_id", "movie_name", "n_reviews", "avg_rating")


def top_n_per_occupation_genre(
    ratings: DataFrame,
    users: DataFrame,
    movies: DataFrame,
    n: int = 3,
    occupations: Sequence[str] | None = None,
    genres: Sequence[str] | None = None,
) -> DataFrame:
    """For every occupation and genre the ``n`` movies with most reviews.

    The value lists restrict the report; combinations without a review have no
    row.
    """
    if occupations is not None:
        users = users.filter(F.col("occupation").isin(list(occupations)))
    movies = movies.select("movie_id", "movie_name", "genres")
    if genres is not None:
        movies = movies.filter(F.arrays_overlap("genres", F.array(*[F.lit(g) for g in genres])))
        ratings = _ratings_of(ratings, movies)
    ranked = _by_genre(review_stats_by(ratings, users, movies, "occupation"))
    if genres is not None:
        ranked = ranked.filter(F.col("genre").isin(list(genres)))
    best = top_n_per_group(
        ranked, ["occupation", "genre"], [F.desc("n_reviews"), F.asc("movie_id")], n
    )
    return best.select(
        "occupation", "genre", "movie_id", "movie_name", "n_reviews", "avg_rating"
    )


def top_n_per_age_group(
    ratings: DataFrame, users: DataFrame, movies: DataFrame, n: int = 30
) -> DataFrame:
    """For every age group the ``n`` movies with most reviews in it.

    Each row carries ``group_total`` (all reviews of the age group) and
    ``age_groups`` (every group that reviewed the movie, ``Unknown`` included).
    The statistics per age group and movie are written once, because three
    small steps read them.
    """
    names = movies.select("movie_id", "movie_name")
    stats = written(
        review_stats_by(ratings, with_age_group(users), names, "age_group"), "age-group-stats"
    )
    totals = stats.groupBy("age_group").agg(F.sum("n_reviews").alias("group_total"))
    known = stats.filter(F.col("age_group").isin([label for _, _, label in AGE_GROUPS]))
    best = top_n_per_group(known, ["age_group"], [F.desc("n_reviews"), F.asc("movie_id")], n)
    # The broadcast holds one row per age-group label.
    best = best.join(F.broadcast(totals), on="age_group")
    labels = [*[label for _, _, label in AGE_GROUPS], "Unknown"]
    lists = group_lists(stats, "movie_id", "age_group", "age_groups", labels)
    return lists.join(best, on="movie_id").select(
        "age_group",
        "group_total",
        "age_groups",
        "movie_id",
        "movie_name",
        "n_reviews",
        "avg_rating",
    )


def in_report_order(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """A top-n report listed by group, then by average rating, best first."""
    return df.orderBy(*groups, F.desc("avg_rating"), "movie_id")
