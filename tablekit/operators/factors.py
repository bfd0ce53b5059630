"""Factors of ratings by alternating least squares, handed from task to task as files.

Each side's ids are dealt into blocks, and the ratings of every block are written once. A
half step has one task per block of the side solved for: it reads all factors of the other
side through Spark, keeps those that its ratings name, and writes the factors of its block.
So a factor is written once a half step, not once for every block that needs it, and a task
holds the factors its ratings name and a piece of the ratings; more blocks make both
smaller. What is read grows with blocks times factors.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.scratch import new_path, remove, scratch

# The executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Batches = Iterator[pa.RecordBatch]

# What a packed row holds. NEEDED: the ids of the other side that a block's ratings name;
# WHOLE: some ids with all their ratings; PIECE: some ratings of an id with many.
NEEDED, FACTORS, WHOLE, PIECE = range(4)
_NUMBERS = {"ids": np.int32, "counts": np.int32, "places": np.int32, "values": np.float32}
_FIELDS = ", ".join(f"{name} binary" for name in _NUMBERS)

# Numbers in a packed row: Spark reads thousands of rows at a time.
_ROW_RATINGS, _ROW_FACTORS, _ROWS = 256, 32, 4000
# Ratings that a task solves at a time, and that a block is meant to have at most.
_SOLVED, BLOCK_RATINGS = 100_000, 4_000_000


def _blobs(numbers: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The numbers as binary values, one from each cut to the next."""
    bounds = ((cuts - cuts[0]) * numbers.itemsize).astype(np.int32)
    data = np.ascontiguousarray(numbers[cuts[0] : cuts[-1]])
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def _numbers(blobs: pa.Array, kind: type) -> np.ndarray:
    """The numbers of all binary values, joined."""
    _, bounds, data = blobs.buffers()
    ends = np.frombuffer(bounds, np.int32)[blobs.offset :][: len(blobs) + 1]
    if data is None or ends[0] == ends[-1]:
        return np.zeros(0, kind)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind)


def _rows(kind: int, block: int, cuts: Sequence[np.ndarray | None], numbers: Sequence[np.ndarray | None]) -> Batches:
    """Packed rows; a field without cuts is empty in all of them."""
    n = max(len(c) for c in cuts if c is not None) - 1
    cuts = [np.zeros(n + 1, np.int64) if c is None else c for c in cuts]
    for at in range(0, n, _ROWS):
        to = min(n, at + _ROWS)
        packed = [_blobs(np.zeros(0, k) if x is None else x, c[at : to + 1]) for c, x, k in zip(cuts, numbers, _NUMBERS.values(), strict=True)]
        tags = [pa.array(np.full(to - at, x, np.int32)) for x in (kind, block)]
        yield pa.RecordBatch.from_arrays([*tags, *packed], ["kind", "block", *_NUMBERS])


def _steps(n: int, step: int) -> np.ndarray:
    return np.r_[np.arange(0, n, step), n]


def _pack(own: str, other: str, start_rank: int, seed: int) -> Callable[[Batches], Batches]:
    """Packs a partition of ratings in the order of the own id; with a rank, also its first factors."""

    def pack(batches: Batches) -> Batches:
        block = TaskContext.get().partitionId()
        held = [[batch.column(name).to_numpy() for name in (own, other, "rating")] for batch in batches]
        if not held:
            return
        owns, others, values = (np.concatenate(c) for c in zip(*held, strict=True))
        del held
        needed = np.unique(others)
        places = np.searchsorted(needed, others).astype(np.int32)
        del others
        yield from _rows(NEEDED, block, [np.array([0, len(needed)]), None, None, None], [needed, None, None, None])
        starts = np.flatnonzero(np.r_[True, owns[1:] != owns[:-1]])
        ids, counts = owns[starts], np.diff(np.r_[starts, len(owns)]).astype(np.int32)
        del owns
        if start_rank:
            drawn = np.random.default_rng([seed % 2**63, block]).standard_normal((len(ids), start_rank), np.float32)
            drawn /= np.linalg.norm(drawn, axis=1, keepdims=True)
            cuts = _steps(len(ids), _ROW_FACTORS)
            yield from _rows(FACTORS, block, [cuts, None, None, cuts * start_rank], [ids, None, None, drawn.ravel()])
        many = counts > _ROW_RATINGS
        for i in np.flatnonzero(many):
            cuts = starts[i] + _steps(counts[i], _ROW_RATINGS)
            each = np.arange(len(cuts))
            yield from _rows(PIECE, block, [each, None, cuts, cuts], [np.repeat(ids[i], len(each)), None, places, values])
        of_few = np.repeat(~many, counts)
        ids, counts, places, values = ids[~many], counts[~many], places[of_few], values[of_few]
        if len(ids):
            ends = np.r_[0, np.cumsum(counts, dtype=np.int64)]
            row = ends[:-1] // _ROW_RATINGS
            cuts = np.r_[np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), len(ids)]
            yield from _rows(WHOLE, block, [cuts, cuts, ends[cuts], ends[cuts]], [ids, counts, places, values])

    return pack


def _sums(factors: np.ndarray, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of so many ratings, with the factors of the rated: the sums of ``x x'`` and of ``rating x``."""
    n, rank = len(counts), factors.shape[1]
    squares, products = np.empty((n, rank, rank)), np.empty((n, rank))
    starts = np.cumsum(counts) - counts
    order = np.argsort(counts, kind="stable")
    for runs in np.split(order, np.flatnonzero(np.diff(counts[order])) + 1):
        at = starts[runs, None] + np.arange(counts[runs[0]])
        x = factors[at].astype(np.float64)
        turned = x.transpose(0, 2, 1)
        squares[runs] = turned @ x
        products[runs] = (turned @ values[at][:, :, None].astype(np.float64))[:, :, 0]
    return squares, products


def _solved(ids: np.ndarray, counts: np.ndarray, squares: np.ndarray, products: np.ndarray, reg: float) -> Batches:
    """Factors of the ids; as in the library, the penalty grows with the number of ratings."""
    rank = products.shape[1]
    squares = squares + (reg * counts)[:, None, None] * np.eye(rank)
    found = np.linalg.solve(squares, products[:, :, None])[:, :, 0].astype(np.float32)
    cuts = _steps(len(ids), _ROW_FACTORS)
    yield pa.RecordBatch.from_arrays([_blobs(ids, cuts), _blobs(found.ravel(), cuts * rank)], ["ids", "values"])


def _solve(rank: int, reg: float) -> Callable[[Batches], Batches]:
    """Solves a block, given its packed ratings and all factors of the other side."""

    def solve(batches: Batches) -> Batches:
        needed, factors, missing = None, None, -1
        early: list[tuple[int, list[np.ndarray]]] = []
        many: dict[int, list] = {}

        def take(kind: int, fields: list[np.ndarray]) -> Batches:
            nonlocal needed, factors, missing
            ids, counts, places, values = fields
            if kind == NEEDED:
                needed, factors, missing = ids.copy(), np.empty((len(ids), rank), np.float32), len(ids)
            elif kind == FACTORS:
                at = np.searchsorted(needed, ids)
                at[at == len(needed)] = 0
                named = needed[at] == ids
                factors[at[named]] = values.reshape(-1, rank)[named]
                missing -= np.count_nonzero(named)
            elif kind == PIECE:
                # Each row is one id's; the batch may have several rows of it.
                for one, at, rated in zip(ids, places, values, strict=True):
                    squares, products = _sums(factors[at], rated, np.array([len(at)]))
                    total = many.setdefault(int(one[0]), [0, 0.0, 0.0])
                    total[:] = total[0] + len(at), total[1] + squares, total[2] + products
            else:
                ends = np.cumsum(counts, dtype=np.int64)
                groups = np.flatnonzero(np.diff(ends // _SOLVED)) + 1
                for lo, hi in zip([0, *groups], [*groups, len(ids)], strict=True):
                    if lo < hi:
                        part = slice(ends[lo] - counts[lo], ends[hi - 1])
                        squares, products = _sums(factors[places[part]], values[part], counts[lo:hi])
                        yield from _solved(ids[lo:hi], counts[lo:hi], squares, products, reg)

        def ready(kind: int) -> bool:
            return kind == NEEDED or (missing >= 0 if kind == FACTORS else missing == 0)

        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            bounds = np.r_[0, np.flatnonzero(np.diff(kinds)) + 1, len(kinds)]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                rows, kind = batch.slice(lo, hi - lo), int(kinds[lo])
                fields = [_numbers(rows.column(name), k) for name, k in _NUMBERS.items()]
                if kind == PIECE:
                    fields = [[_numbers(rows.column(name).slice(i, 1), k) for i in range(hi - lo)] for name, k in _NUMBERS.items()]
                if ready(kind):
                    yield from take(kind, fields)
                else:
                    # Spark reads a block's files in the given order, but does not promise to.
                    early.append((kind, fields))
        for kind, fields in sorted(early, key=lambda x: x[0]):
            if not ready(kind):
                raise ValueError("factors of some rated ids are missing")
            yield from take(kind, fields)
        if many:
            counts, squares, products = zip(*many.values(), strict=True)
            yield from _solved(np.array([*many], np.int32), np.array(counts), np.concatenate(squares), np.concatenate(products), reg)

    return solve


def _unpack(rank: int) -> Callable[[Batches], Batches]:
    def unpack(batches: Batches) -> Batches:
        for batch in batches:
            ids, values = (_numbers(batch.column(name), _NUMBERS[name]) for name in ("ids", "values"))
            ends = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * rank)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(ends, pa.array(values))], ["id", "features"])

    return unpack


def _packed(spark: SparkSession, kind: int, path: str) -> DataFrame:
    """Packed rows of a folder; factors have ids and values only."""
    rows = spark.read.schema(_FIELDS).parquet(path)
    return rows.select(F.lit(kind).alias("kind"), *_NUMBERS)


def _dealt(triples: DataFrame, own: str, other: str, blocks: int, start_rank: int, seed: int) -> tuple[str, list[list[DataFrame]]]:
    """Writes the ratings in blocks of own ids: the folder, and for each block what it needs and its ratings."""
    spark = triples.sparkSession
    path = new_path(spark, f"{own}-blocks")
    # Packed rows hold numbers of these types only.
    rows = triples.select(F.col(own).cast("int"), F.col(other).cast("int"), F.col("rating").cast("float"))
    rows = rows.repartition(blocks, own).sortWithinPartitions(own)
    packed = rows.mapInArrow(_pack(own, other, start_rank, seed), f"kind int, block int, {_FIELDS}")
    packed.write.partitionBy("kind", "block").parquet(path)
    # At most four rows a block.
    found = spark.read.schema(f"kind int, block int, {_FIELDS}").parquet(path).select("kind", "block").distinct().collect()
    folders: dict[int, list[int]] = {}
    for kind, block in sorted(tuple(r) for r in found if r.kind != FACTORS):
        folders.setdefault(block, []).append(kind)
    return path, [[_packed(spark, k, f"{path}/kind={k}/block={b}") for k in kinds] for b, kinds in folders.items()]


def _half_step(spark: SparkSession, blocks: Sequence[Sequence[DataFrame]], factors: str, rank: int, reg: float) -> str:
    """Writes one side's factors, given the folder of the other side's."""
    others = _packed(spark, FACTORS, factors)
    parts = [reduce(DataFrame.unionAll, [needed, others, *ratings]).coalesce(1) for needed, *ratings in blocks]
    path = new_path(spark, "factors")
    # One task a block: single partitions must not be united into one.
    with _setting(spark, "spark.sql.unionOutputPartitioning", "false"):
        found = reduce(DataFrame.unionAll, parts).mapInArrow(_solve(rank, reg), "ids binary, values binary")
        found.write.parquet(path)
    return path


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def fit_factors(
    triples: DataFrame, rank: int, iterations: int, reg: float, seed: int, blocks: int
) -> tuple[DataFrame, DataFrame]:
    """``(id, features)`` of users and of items, for ratings ``(user_id, movie_id, rating)``.

    Both are written tables. Ids are 32-bit integers, ratings floats; none is NULL. The
    ratings are read twice.
    """
    spark = triples.sparkSession
    kept = [new_path(spark, f"{side}-factors") for side in ("user", "item")]
    with scratch(spark):
        users_in, by_user = _dealt(triples, "user_id", "movie_id", blocks, rank, seed)
        items_in, by_item = _dealt(triples, "movie_id", "user_id", blocks, 0 if iterations else rank, seed + 1)
        users, items = (f"{folder}/kind={FACTORS}" for folder in (users_in, items_in))
        for step in range(iterations):
            before = users, items
            items = _half_step(spark, by_item, users, rank, reg)
            users = _half_step(spark, by_user, items, rank, reg)
            if step:
                for path in before:
                    remove(spark, path)
        for path, to in zip((users, items), kept, strict=True):
            rows = spark.read.schema("ids binary, values binary").parquet(path)
            rows.mapInArrow(_unpack(rank), "id int, features array<float>").write.parquet(to)
    users, items = (spark.read.schema("id int, features array<float>").parquet(path) for path in kept)
    return users, items
