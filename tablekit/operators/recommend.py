"""Recommendations by alternating least squares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.factors import BLOCK_RATINGS, fit_factors
from tablekit.operators.ranking import add_index
from tablekit.scratch import new_path, remove, shared_folder

_MAX_INT = 2**31 - 1

# Each of the many half steps over files takes a second or more however few the ratings.
LIBRARY_RATINGS = 5_000_000


def too_wide(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The id columns that hold anything but 32-bit integers; one pass over the table."""
    unknown = [c for c in columns if dict(df.dtypes)[c] not in ("int", "smallint", "tinyint")]
    longs = [c for c in unknown if dict(df.dtypes)[c] == "bigint"]
    wide = [c for c in unknown if c not in longs]
    if longs:
        bounds = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in longs for f in (F.min, F.max)])
        found = bounds.first()
        wide += [
            c
            for c in longs
            if found[f"min_{c}"] is not None
            and (found[f"min_{c}"] < -_MAX_INT - 1 or found[f"max_{c}"] > _MAX_INT)
        ]
    return wide


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """A table ``(column, id)`` numbering the different values from 0."""
    known = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ids = add_index(known, [F.col(column)], "id")
    return ids.withColumn("id", F.col("id").cast("int"))


def _to_id(df: DataFrame, column: str, ids: DataFrame | None) -> DataFrame:
    if ids is None:
        return df.withColumn(column, F.col(column).cast("int"))
    return df.join(ids, on=column).drop(column).withColumnRenamed("id", column)


def _from_id(df: DataFrame, column: str, ids: DataFrame | None) -> DataFrame:
    if ids is None:
        return df
    names = ids.withColumnRenamed(column, "_value")
    found = df.withColumnRenamed(column, "id").join(names, on="id")
    return found.drop("id").withColumnRenamed("_value", column)


@dataclass(frozen=True)
class Recommender:
    """A fitted model together with the id tables it was fitted on."""

    model: ALSModel
    users: DataFrame | None
    items: DataFrame | None

    def user_factors(self) -> DataFrame:
        """``(user_id, factors)``, one row per user."""
        factors = self.model.userFactors.select(
            F.col("id").alias("user_id"), F.col("features").alias("factors")
        )
        return _from_id(factors, "user_id", self.users)

    def item_factors(self) -> DataFrame:
        """``(movie_id, factors)``, one row per item."""
        factors = self.model.itemFactors.select(
            F.col("id").alias("movie_id"), F.col("features").alias("factors")
        )
        return _from_id(factors, "movie_id", self.items)

    def recommend(self, users: DataFrame | None = None, n: int = 10) -> DataFrame:
        """The ``n`` best items for every ``user_id`` in ``users``, or for all users.

        Items the user has already rated are not left out.
        """
        if users is None:
            lists = self.model.recommendForAllUsers(n)
        else:
            known = _to_id(users.select("user_id"), "user_id", self.users)
            lists = self.model.recommendForUserSubset(known, n)
        rows = lists.select("user_id", F.inline("recommendations"))
        rows = _from_id(rows, "user_id", self.users)
        return _from_id(rows, "movie_id", self.items).select("user_id", "movie_id", "rating")


def _checked(df: DataFrame) -> DataFrame:
    """The triples; as for the library, a missing value is an error."""

    def known(column: Column, valid: Column, message: str) -> Column:
        return F.when(valid, column).otherwise(F.raise_error(F.lit(message)))

    rating = F.col("rating").cast("float")
    number = rating.isNotNull() & ~F.isnan(rating) & (F.abs(rating) != F.lit(float("inf")))
    ids = [known(F.col(c), F.col(c).isNotNull(), f"{c}: ids must not be NULL").alias(c) for c in ("user_id", "movie_id")]
    return df.select(*ids, known(rating, number, "ratings must be numbers").alias("rating"))


def _model(rank: int, users: DataFrame, items: DataFrame) -> ALSModel:
    """The library's model over tables ``(id, features)``."""
    made = users.sparkSession._jvm.org.apache.spark.ml.recommendation.ALSModel("als", rank, users._jdf, items._jdf)
    return ALSModel(made.setUserCol("user_id").setItemCol("movie_id"))


def als_fit(
    ratings: DataFrame,
    rank: int = 20,
    iterations: int = 15,
    reg: float = 0.01,
    seed: int = 42,
    blocks: int | None = None,
    library_ratings: int = LIBRARY_RATINGS,
) -> Recommender:
    """Fit explicit ratings ``(user_id, movie_id, rating)``.

    Up to ``library_ratings`` ratings are fitted by the library, whose tasks hold a block
    of them and nearly all factors as objects. More are fitted by :func:`fit_factors`: the
    same least squares from other starting factors, with files between half steps.

    Factors are split into ``blocks`` blocks per side, by default one per core of the
    cluster, for the second way more where a block would have above ``BLOCK_RATINGS``
    ratings. The library's iterations are checkpointed in the shared folder.
    """
    spark, context = ratings.sparkSession, ratings.sparkSession.sparkContext
    path = new_path(spark, "ratings")
    ratings = ratings.select("user_id", "movie_id", "rating")
    ratings.write.parquet(path)
    ratings = spark.read.schema(ratings.schema).parquet(path)
    # The solver stores ids as 32-bit integers; others are numbered first.
    wide = too_wide(ratings, ["user_id", "movie_id"])
    users, items = (
        dense_ids(ratings, c) if c in wide else None for c in ("user_id", "movie_id")
    )
    triples = _to_id(_to_id(ratings, "user_id", users), "movie_id", items)
    n_ratings = ratings.count()
    if n_ratings > library_ratings:
        blocks = blocks or max(context.defaultParallelism, -(-n_ratings // BLOCK_RATINGS))
        factors = fit_factors(_checked(triples), rank, iterations, reg, seed, blocks)
        remove(spark, path)
        return Recommender(_model(rank, *factors), users, items)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    blocks = blocks or context.defaultParallelism
    als = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user_id",
        itemCol="movie_id",
        ratingCol="rating",
    )
    triples = triples.select("user_id", "movie_id", F.col("rating").cast("float"))
    return Recommender(als.fit(triples), users, items)
