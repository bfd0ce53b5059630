"""k-means clustering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Centers = list[list[float]]


def spread_centers(points: DataFrame, columns: Sequence[str], k: int) -> Centers:
    """``k`` centres evenly spaced from the minimum to the maximum of every column."""
    if k < 2:
        raise ValueError("at least two centres are needed")
    bounds = points.agg(*[f(c) for c in columns for f in (F.min, F.max)]).first()
    sides = [(float(bounds[2 * i]), float(bounds[2 * i + 1])) for i in range(len(columns))]
    inner = [
        [low + (high - low) * step / (k - 1) for low, high in sides] for step in range(1, k - 1)
    ]
    return [[low for low, _ in sides], *inner, [high for _, high in sides]]


def seeded_centers(
    points: DataFrame, columns: Sequence[str], k: int, rounds: int = 5, seed: int = 42
) -> Centers:
    """``k`` centres spread over the points, by oversampled parallel seeding.

    Each round draws ``2 * k`` points, likelier the larger their squared distance to
    the nearest one drawn before. The drawn points, each weighed by the number of
    points nearest to it, are then reduced to ``k`` on the driver, which sees
    ``1 + 2 * k * rounds`` rows whatever the size of the table.

    Points with a missing coordinate are left out. Where there are fewer than ``k``
    different points, some centres are equal. The draw is the same for the same
    partitions of the table.
    """
    if k < 1:
        raise ValueError("at least one centre is needed")
    point = F.array(*[F.col(c).cast("double") for c in columns])
    known = points.select(*columns).na.drop().select(point.alias("_point"))
    drawn = [list(r[0]) for r in known.orderBy(F.rand(seed)).limit(1).collect()]
    if not drawn:
        raise ValueError("there is no point without a missing coordinate")
    for step in range(1, rounds + 1):
        gap = F.array_min(_gaps(F.col("_point"), drawn))
        # The smallest of exponential times of rate ``gap`` are a draw weighed by it.
        time = -F.log1p(-F.rand(seed + step)) / F.col("_gap")
        far = known.select("_point", gap.alias("_gap")).filter("_gap > 0")
        drawn += [list(r[0]) for r in far.orderBy(time).limit(2 * k).collect()]
    different = sorted({tuple(p) for p in drawn})
    gaps = known.select(_gaps(F.col("_point"), [list(p) for p in different]).alias("_gaps"))
    place = F.array_position("_gaps", F.array_min("_gaps")) - 1
    weights = {r[0]: r[1] for r in gaps.groupBy(place.alias("_place")).count().collect()}
    counts = np.array([weights.get(i, 0) for i in range(len(different))], dtype=float)
    return _reduced(np.array(different), counts, k, seed)


def _gaps(point: Column, centers: Centers) -> Column:
    """Squared distances of a point to the centres."""

    def squared(center: Column) -> Column:
        parts = F.zip_with(center, point, lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)

    return F.transform(F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers]), squared)


def _reduced(points: np.ndarray, weights: np.ndarray, k: int, seed: int, tries: int = 10) -> Centers:
    """``k`` centres of a few weighed points: the best of some weighed starts and steps."""
    random = np.random.default_rng(seed)
    best, least = points[:1], np.inf
    for _ in range(tries):
        centers = points[[random.choice(len(points), p=weights / weights.sum())]]
        while len(centers) < k:
            gaps = ((points[:, None] - centers) ** 2).sum(2).min(1) * weights
            if gaps.sum() == 0:
                centers = np.vstack([centers, np.repeat(centers[-1:], k - len(centers), 0)])
                break
            centers = np.vstack([centers, points[random.choice(len(points), p=gaps / gaps.sum())]])
        for _ in range(50):
            place = ((points[:, None] - centers) ** 2).sum(2).argmin(1)
            moved = np.array(
                [
                    np.average(points[place == i], axis=0, weights=weights[place == i])
                    if weights[place == i].sum() > 0
                    else center
                    for i, center in enumerate(centers)
                ]
            )
            if np.array_equal(moved, centers):
                break
            centers = moved
        cost = (((points[:, None] - centers) ** 2).sum(2).min(1) * weights).sum()
        if cost < least:
            best, least = centers, cost
    return sorted(best.tolist())


def nearest(columns: Sequence[str], centers: Centers) -> Column:
    """Number of the nearest centre; the lower number wins a tie.

    NULL where a coordinate is missing.
    """

    def distance(center: list[float]) -> Column:
        gaps = [F.col(c) - F.lit(x) for c, x in zip(columns, center, strict=True)]
        return F.abs(gaps[0]) if len(gaps) == 1 else sum((g * g for g in gaps), F.lit(0.0))

    ranked = [F.struct(distance(c), F.lit(i).alias("cluster")) for i, c in enumerate(centers)]
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(placed, F.array_min(F.array(*ranked))["cluster"])


def kmeans_fit(
    points: DataFrame, columns: Sequence[str], centers: Centers, iterations: int
) -> Centers:
    """Move given centres for a fixed number of steps.

    A step is one aggregate over the points; only its ``k`` rows reach the
    driver. An empty cluster keeps its centre. Points with a missing coordinate
    belong to no cluster. Give a persisted or written table when deriving the
    points costs more than reading them.
    """
    points = points.select(*columns).na.drop()
    for _ in range(iterations):
        means = points.groupBy(nearest(columns, centers).alias("cluster")).agg(
            *[F.avg(c).alias(f"_{i}") for i, c in enumerate(columns)]
        )
        moved = {row[0]: list(row[1:]) for row in means.collect()}
        centers = [moved.get(i, center) for i, center in enumerate(centers)]
    return centers


def kmeans_assign(points: DataFrame, columns: Sequence[str], centers: Centers) -> DataFrame:
    """Points with the number of their nearest centre as ``cluster``."""
    return points.withColumn("cluster", nearest(columns, centers))


def kmeans_vector_model(
    points: DataFrame, column: str, k: int, iterations: int = 20, seed: int = 42
) -> KMeansModel:
    """The library estimator fitted on an array column."""
    vectors = points.select(array_to_vector(F.col(column)).alias("_features"))
    return KMeans(
        k=k, maxIter=iterations, seed=seed, featuresCol="_features", predictionCol="cluster"
    ).fit(vectors)


def assign_vectors(points: DataFrame, column: str, model: KMeansModel) -> DataFrame:
    """Points with ``cluster`` from a fitted model."""
    vectors = points.withColumn("_features", array_to_vector(F.col(column)))
    return model.transform(vectors).drop("_features")


def kmeans_vectors(
    points: DataFrame, column: str, k: int, iterations: int = 20, seed: int = 42
) -> DataFrame:
    """Points with ``cluster`` from the library estimator, for an array column."""
    return assign_vectors(points, column, kmeans_vector_model(points, column, k, iterations, seed))
