"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own; a pair of centres is a cell of
the product grid. A vector lies in one cell and visits the nearest cells in order
of the sum of its two distances (the multi-sequence order); everything it meets
there is compared in double precision.

The number of cells visited is set by a target recall: vectors at exactly the
threshold from those of a bounded sample are made, and so many cells are visited
that the target share of them is met. Closer pairs are met more often.

Equal vectors are one entry with a number of copies. Of two entries the later one
visits the earlier one's cell, so each pair is compared once. Cells of many entries
are split into blocks. A block returns numbers of links and a spanning forest of
its links, never all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths never link; a null
``vec_id`` has links but no component of its own to name; rows that share a
``vec_id`` count as vectors each; extra columns are left out; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.components import components
from tablekit.llm.shipping import ship
from tablekit.scratch import written

MIN_COSINE = 0.9
TARGET_RECALL = 0.99
#: Vectors the codebooks and the number of visits are fitted on.
SAMPLE_VECTORS = 8_192
#: Entries per cell aimed at, and the most centres of a codebook.
CELL_ENTRIES, MOST_CENTRES = 1_000, 256
#: Entries of a cell compared in one block.
BLOCK_ENTRIES = 2_048
CHUNK = 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)


def _codebook(x: np.ndarray, k: int, numbers: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means centres."""
    centres = x[numbers.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(x, centres).argmin(axis=1)
        size = np.bincount(nearest, minlength=len(centres))
        for d in range(x.shape[1]):
            total = np.bincount(nearest, x[:, d], len(centres))
            centres[:, d] = np.where(size > 0, total / np.maximum(size, 1), centres[:, d])
    return centres


@dataclass
class MultiIndex:
    """The two codebooks and how many cells a vector visits."""

    dims: int
    left: np.ndarray
    right: np.ndarray
    visits: int = 1

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.dims // 2
        return _distances(x[:, :half], self.left), _distances(x[:, half:], self.right)

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def nearest_cells(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The ``visits`` nearest cells in order.

        The cell of the a-th and b-th nearest centres comes after all cells of
        nearer ones, so with (a + 1)(b + 1) above ``visits`` it cannot be reached.
        """
        da, db = self.halves(x)
        na, nb = min(visits, da.shape[1]), min(visits, db.shape[1])
        oa, ob = np.argsort(da, axis=1, kind="stable")[:, :na], np.argsort(db, axis=1, kind="stable")[:, :nb]
        a, b = np.array([(i, j) for i in range(na) for j in range(nb) if (i + 1) * (j + 1) <= visits]).T
        sums = np.take_along_axis(da, oa, 1)[:, a] + np.take_along_axis(db, ob, 1)[:, b]
        first = np.argsort(sums, axis=1, kind="stable")[:, :visits]
        rows = np.arange(len(x))[:, None]
        return oa[rows, a[first]] * len(self.right) + ob[rows, b[first]]


def fit_index(
    sample: np.ndarray, entries: int, min_cosine: float = MIN_COSINE, target_recall: float = TARGET_RECALL, seed: int = 3
) -> MultiIndex:
    """Codebooks for ``entries`` vectors, and visits for the target recall at the threshold."""
    numbers = np.random.default_rng(seed)
    dims = sample.shape[1]
    k = int(np.clip(round((entries / CELL_ENTRIES) ** 0.5), 2, MOST_CENTRES))
    half = dims // 2
    index = MultiIndex(dims, _codebook(sample[:, :half], k, numbers), _codebook(sample[:, half:], k, numbers))
    cells = len(index.left) * len(index.right)
    tried = sample[:2_000]
    aside = numbers.normal(size=tried.shape)
    aside -= (aside * tried).sum(axis=1, keepdims=True) * tried
    norm = np.sqrt((aside**2).sum(axis=1, keepdims=True))
    aside = np.divide(aside, norm, out=np.zeros_like(aside), where=norm > 0)
    near = min_cosine * tried + np.sqrt(1 - min_cosine**2) * aside
    theirs, visits = index.cell(near)[:, None], 1
    while visits < cells:
        met = (index.nearest_cells(tried, visits) == theirs).any(axis=1).mean()
        if met >= target_recall:
            break
        visits = min(cells, visits + max(1, visits // 8))
    index.visits = visits
    return index


def _forest(mask: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least labels over the links ``mask`` (queries x residents); new labels of residents, labels of queries."""
    none = len(labels)
    labels = labels.copy()
    while True:
        of_query = np.where(mask, labels[None, :], none).min(axis=1)
        of_resident = np.where(mask, of_query[:, None], none).min(axis=0)
        least = np.minimum(labels, of_resident)
        if (least == labels).all():
            return labels, of_query
        labels = least


def _compare(residents: np.ndarray, r_ids, r_copies, queries, min_cosine: float):
    """Links of residents with earlier entries and queries with later ones, chunk by chunk.

    Yields ``(ids, numbers of links)`` and ``(from, to)`` of a forest.
    """
    labels = np.arange(len(residents))
    r_links = np.zeros(len(residents), np.int64)
    for q, q_ids, q_copies in queries:
        mask = (q @ residents.T >= min_cosine) & (q_ids[:, None] > r_ids[None, :])
        if not mask.any():
            continue
        r_links += mask.T @ q_copies
        some = mask.any(axis=1)
        new, of_query = _forest(mask[some], labels)
        moved = np.flatnonzero(new != labels)
        ends = np.concatenate([q_ids[some], r_ids[labels[moved]]])
        others = np.concatenate([r_ids[of_query[of_query < len(labels)]], r_ids[new[moved]]])
        labels = new
        yield q_ids[some], mask[some] @ r_copies, np.unique(np.stack([ends, others], axis=1), axis=0)
    linked = np.flatnonzero(r_links)
    yield r_ids[linked], r_links[linked], np.empty((0, 2), np.int64)


def _links(entries: DataFrame, index: MultiIndex, min_cosine: float) -> DataFrame:
    """``(u, v, n)``: rows with n count links of entry u; the others are edges of a forest."""
    spark = entries.sparkSession
    ship(spark)
    dims = index.dims

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(np.array(batch.column("embedding").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims))
            yield pa.RecordBatch.from_arrays([batch.column("entry"), pa.array(index.cell(x))], ["entry", "cell"])

    cells = entries.select("entry", "embedding").mapInArrow(place, "entry long, cell long")
    # At most MOST_CENTRES ** 2 rows.
    sizes = np.ones(len(index.left) * len(index.right), np.int64)
    for row in cells.groupBy("cell").count().collect():
        sizes[row["cell"]] = row["count"]
    blocks = -(-sizes // BLOCK_ENTRIES)
    first_block = np.cumsum(blocks) - blocks

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "role", "entry", "copies", "embedding"]
        for whole in batches:
            for start in range(0, whole.num_rows, 1_000):
                batch = whole.slice(start, 1_000)
                n = batch.num_rows
                x = unit(np.array(batch.column("embedding").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, dims))
                entry = batch.column("entry").to_numpy()
                own = index.cell(x)
                at = first_block[own] + (entry * 2_654_435_761 >> 12) % blocks[own]
                visited = index.nearest_cells(x, index.visits)
                row = np.repeat(np.arange(n), blocks[visited].sum(axis=1))
                flat = visited.ravel()
                block = np.repeat(first_block[flat], blocks[flat]) + np.concatenate([np.arange(b) for b in blocks[flat]])
                rows = pa.array(np.concatenate([np.arange(n), row]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([at, block])),
                        pa.array(np.concatenate([np.zeros(n, np.int32), np.ones(len(row), np.int32)])),
                        *[batch.column(c).take(rows) for c in names[2:]],
                    ],
                    names,
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():
            """Parts of batches in which block and role stay the same."""
            for batch in batches:
                keys = batch.column("block").to_numpy() * 2 + batch.column("role").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    if b > a:
                        part = batch.slice(a, b - a)
                        x = np.array(part.column("embedding").flatten().to_numpy(zero_copy_only=False), np.float64)
                        yield int(keys[a]), (unit(x.reshape(-1, dims)), part.column("entry").to_numpy(), part.column("copies").to_numpy())

        def blocks_of():
            """Residents of a block, then its queries as they come."""
            stream = runs()
            ahead = next(stream, None)
            while ahead is not None:
                block, parts = ahead[0] // 2, []
                while ahead is not None and ahead[0] == block * 2:
                    parts.append(ahead[1])
                    ahead = next(stream, None)

                def queries(block=block):
                    nonlocal ahead
                    while ahead is not None and ahead[0] == block * 2 + 1:
                        x, ids, copies = ahead[1]
                        for a in range(0, len(ids), CHUNK):
                            yield x[a : a + CHUNK], ids[a : a + CHUNK], copies[a : a + CHUNK]
                        ahead = next(stream, None)

                if parts:
                    yield [np.concatenate(c) for c in zip(*parts, strict=True)], queries()
                else:
                    for _ in queries():
                        pass

        for (x, ids, copies), queries in blocks_of():
            for u, n, edges in _compare(x, ids, copies, queries, min_cosine):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([u, edges[:, 0]])),
                        pa.array(np.concatenate([u, edges[:, 1]])),
                        pa.array(np.concatenate([n, np.zeros(len(edges), np.int64)])),
                    ],
                    ["u", "v", "n"],
                )

    dealt = entries.select("entry", "copies", "embedding").mapInArrow(
        deal, f"block long, role int, entry long, copies long, embedding {entries.schema['embedding'].dataType.simpleString()}"
    )
    return dealt.repartition("block").sortWithinPartitions("block", "role").mapInArrow(compare, "u long, v long, n long")


def link_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, target_recall: float = TARGET_RECALL) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    spark = vectors.sparkSession
    x = F.col("embedding")
    finite = lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))
    usable = (F.size(x) > 0) & F.forall(x, finite) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(
        "vec_id",
        "embedding",
        F.xxhash64("embedding").alias("h1"),
        F.xxhash64(F.lit(1), "embedding").alias("h2"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
    )
    entries = written(
        rows.where("usable")
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("entry", F.monotonically_increasing_id())
        .withColumn("dims", F.size("embedding")),
        "vectors-entries",
    )
    found = None
    # One index per vector length; tables have one, or few.
    for (dims, count) in sorted((r["dims"], r["count"]) for r in entries.groupBy("dims").count().collect()):
        own = entries.where(F.col("dims") == dims)
        sample = own.orderBy(F.xxhash64("h1"), "h1").limit(SAMPLE_VECTORS).select("embedding").collect()
        index = fit_index(unit(np.array([r.embedding for r in sample], np.float64)), count, min_cosine, target_recall)
        links = _links(own, index, min_cosine)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = spark.createDataFrame([], "u long, v long, n long")
    found = written(found, "vectors-links")
    counts = found.groupBy(F.col("u").alias("entry")).agg(F.sum("n").alias("n"))
    groups = components(found.where(F.col("u") != F.col("v")).select("u", "v"))
    named = (
        entries.select("entry", "h1", "h2", "least_id", "copies")
        .join(groups.withColumnRenamed("node", "entry"), "entry", "left")
        .join(counts, "entry", "left")
        .withColumn("component", F.coalesce("component", "entry"))
    )
    names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    facts = written(
        named.join(names, "component").select(
            "h1", "h2", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
        ),
        "vectors-facts",
    )
    # Hashes of arrays skip nulls, so only usable vectors may meet by hash; the others have no facts.
    none = [F.lit(None).cast("long").alias(c) for c in ("component_id", "n_links")]
    result = (
        rows.where("usable")
        .join(facts, ["h1", "h2"], "left")
        .select("vec_id", "component_id", "n_links")
        .unionByName(rows.where(~F.col("usable")).select("vec_id", *none))
    )
    component = F.coalesce("component_id", "vec_id").cast("long")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
