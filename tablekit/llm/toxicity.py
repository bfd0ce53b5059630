"""Toxicity scores by a factorization machine over hashed terms.

A document is the set of its terms, words and their beginnings, hashed to buckets.
Buckets count whose share among toxic documents differs clearly from that among
the others. Besides a weight, each
bucket has a short vector; the products of the vectors of all pairs of terms add
what two terms mean together, such as an insult beside the name of a group.

The model is fitted on at most ``SAMPLE_ROWS`` labelled documents, taken by a hash
of their id; every document is scored, over its whole text. Toxic documents are rare,
so a plain fit gives one with few marking words a low score. Scores are therefore
shifted: models fitted without a fold of those documents score that fold, and the
logit above which at most ``MAX_WRONG`` of its other documents lie becomes the score
``TOXIC_FROM``. Which buckets count is found anew for every fold.

Defined cases: a null or empty text has no terms and gets the score of the bias; a
null ``doc_id`` is scored, never labelled and not held out; repeated rows get the
same score, and of several texts under one labelled id one is fitted; very long texts
are read whole; without labels of both kinds every score is the share of label 1 (0.0
without any), and with too few for every fold scores are not shifted; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.shipping import ship
from tablekit.llm.words import NOT_WORDS, word_hashes
from tablekit.scratch import written

BUCKET_BITS = 18
FACTORS = 6
SAMPLE_ROWS = 20_000
#: Bytes of a word's beginnings, which tie its forms together.
PREFIXES = (4, 5, 6, 7, 8)
#: A bucket counts if so many fitted documents hold it and the shares differ by so many standard errors.
MIN_DOCS, MIN_Z = 5, 4.0
EPOCHS = 16
BATCH_ROWS = 512
RATE = 0.03
SHRINK = 2e-4
TOXIC_FROM = 0.7
#: Folds of the labelled documents, the share of others marked in them, and the least score that may become TOXIC_FROM.
FOLDS, MAX_WRONG, LEAST_SCORE = 5, 0.005, 0.1


def is_held_out(doc_id: Column) -> Column:
    """Whether the labels of this document are kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def terms(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Per text the distinct buckets of its terms."""
    for hashes in word_hashes(texts, NOT_WORDS, PREFIXES):
        yield np.unique(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; 0 for empty runs."""
    out = np.zeros((len(sizes), *values.shape[1:]))
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full], axis=0)
    return out


@dataclass
class FactorizationMachine:
    """Weights of the buckets that count; all others weigh nothing."""

    bias: float
    place: np.ndarray  # per bucket its row below, the last row (zeros) if it does not count
    weights: np.ndarray
    vectors: np.ndarray

    def logits(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vectors = self.vectors[rows]
        total = _sums(vectors, sizes)
        pairs = (total**2 - _sums(vectors**2, sizes)).sum(axis=1) / 2
        return self.bias + _sums(self.weights[rows], sizes) + pairs, total

    def scores(self, documents: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(x) for x in documents], np.int64)
        rows = self.place[np.concatenate([np.empty(0, np.int64), *documents])]
        return 1 / (1 + np.exp(-np.clip(self.logits(rows, sizes)[0], -50, 50)))


def _counted(held: np.ndarray, toxic: np.ndarray, n: int, n_toxic: float) -> np.ndarray:
    """The buckets that count, from the documents and the toxic documents that hold each."""
    n_others = max(1, n - n_toxic)
    n, n_toxic = max(1, n), max(1, n_toxic)
    error = np.sqrt(held / n * (1 - held / n) * (1 / n_toxic + 1 / n_others))
    z = np.abs(toxic / n_toxic - (held - toxic) / n_others) / np.maximum(error, 1e-12)
    return np.flatnonzero((held >= MIN_DOCS) & (z >= MIN_Z))


def fit(documents: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> FactorizationMachine:
    """Fits on the buckets of the terms of each document."""
    everything = np.concatenate([np.empty(0, np.int64), *documents])
    held = np.bincount(everything, minlength=1 << BUCKET_BITS)
    toxic = np.bincount(everything, np.repeat(labels, [len(x) for x in documents]), 1 << BUCKET_BITS)
    counted = _counted(held, toxic, len(labels), labels.sum())
    return fit_counted(counted, [np.flatnonzero(np.isin(counted, x)) for x in documents], labels, seed)


def fit_counted(
    counted: np.ndarray, packed: list[np.ndarray], labels: np.ndarray, seed: int = 1
) -> FactorizationMachine:
    """Minimises logistic loss by Adam on batches of rows; ``packed`` has places in ``counted``."""
    numbers = np.random.default_rng(seed)
    m = len(counted)
    place = np.full(1 << BUCKET_BITS, m, np.int64)
    place[counted] = np.arange(m)
    share = float(labels.mean()) if len(labels) else 0.0
    model = FactorizationMachine(
        float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))),
        place,
        np.zeros(m + 1),
        np.vstack([numbers.normal(0, 0.02, (m, FACTORS)), np.zeros((1, FACTORS))]),
    )
    if not 0 < share < 1:
        return model
    params = np.hstack([model.weights[:m, None], model.vectors[:m]])
    first, second = np.zeros_like(params), np.zeros_like(params)
    bias_first = bias_second = 0.0
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = numbers.permutation(len(packed))
        for start in range(0, len(order), BATCH_ROWS):
            batch = order[start : start + BATCH_ROWS]
            sizes = np.array([len(packed[i]) for i in batch])
            rows = np.concatenate([packed[i] for i in batch])
            model.weights[:m], model.vectors[:m] = params[:, 0], params[:, 1:]
            logits, total = model.logits(rows, sizes)
            error = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - labels[batch]) / len(batch)
            each = np.repeat(error, sizes)
            slope = np.repeat(total, sizes, axis=0) - model.vectors[rows]
            grad = SHRINK * params
            grad[:, 0] += np.bincount(rows, each, m)
            for f in range(FACTORS):
                grad[:, f + 1] += np.bincount(rows, each * slope[:, f], m)
            step += 1
            first += 0.1 * (grad - first)
            second += 0.001 * (grad**2 - second)
            params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            slope_bias = float(error.sum())
            bias_first += 0.1 * (slope_bias - bias_first)
            bias_second += 0.001 * (slope_bias**2 - bias_second)
            model.bias -= rate * (bias_first / (1 - 0.9**step)) / (np.sqrt(bias_second / (1 - 0.999**step)) + 1e-8)
    model.weights[:m], model.vectors[:m] = params[:, 0], params[:, 1:]
    return model


def _logit(score: float) -> float:
    return float(np.log(score / (1 - score)))


def fit_calibrated(
    counted: np.ndarray,
    packed: list[np.ndarray],
    labels: np.ndarray,
    folds: np.ndarray,
    counted_without: list[np.ndarray],
    max_wrong: float = MAX_WRONG,
    toxic_from: float = TOXIC_FROM,
) -> FactorizationMachine:
    """The model of all rows, shifted by what models without each fold say of it.

    ``packed`` has buckets; ``counted_without`` those that count without each fold.
    """

    def places(among: np.ndarray) -> list[np.ndarray]:
        return [np.flatnonzero(np.isin(among, x)) for x in packed]

    model = fit_counted(counted, places(counted), labels)
    logits = np.zeros(len(labels))
    for fold, among in enumerate(counted_without):
        out = folds == fold
        if not 0 < labels[~out].sum() < (~out).sum():
            return model
        found = places(among)
        part = fit_counted(among, [x for x, o in zip(found, out, strict=True) if not o], labels[~out])
        theirs = [x for x, o in zip(found, out, strict=True) if o]
        rows = np.concatenate([np.empty(0, np.int64), *theirs])
        logits[out] = part.logits(rows, np.array([len(x) for x in theirs], np.int64))[0]
    others = np.sort(logits[labels == 0])[::-1]
    if not 0 < len(others) < len(labels):
        return model
    cut = max(float(others[int(max_wrong * len(others))]), _logit(LEAST_SCORE))
    model.bias += _logit(toxic_from) - min(cut, _logit(toxic_from))
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Fits on a bounded sample of the labelled documents that are not held out."""
    ship(docs.sparkSession)
    known = (
        labels.where(F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # At most sample_rows ids; the texts stay where they are.
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "toxic", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.astype("<u4").tobytes() for x in terms(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.binary())], ["doc_id", "toxic", "terms"]
            )

    # One text per id, so there are at most sample_rows rows, however often an id is repeated.
    found = sample.mapInArrow(hashed, f"doc_id {id_type}, toxic int, terms binary")
    once = found.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min("terms").alias("terms"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    fitted = written(once.select("doc_id", "toxic", "terms", fold.alias("fold")), "toxicity-terms")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, toxic = (np.zeros((FOLDS, 1 << BUCKET_BITS), np.int64) for _ in range(2))
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("fold", "toxic", "terms")]
            for of, label, found in zip(*columns, strict=True):
                buckets = np.frombuffer(found, "<u4")  # each once
                held[of, buckets] += 1
                toxic[of, buckets] += label == 1
        of, some = np.nonzero(held)
        columns = [pa.array(x) for x in (of, some, held[of, some], toxic[of, some])]
        yield pa.RecordBatch.from_arrays(columns, ["fold", "bucket", "held", "toxic"])

    counts = fitted.select("fold", "toxic", "terms").mapInArrow(count, "fold long, bucket long, held long, toxic long")
    counts = counts.groupBy("fold", "bucket").agg(F.sum("held").alias("held"), F.sum("toxic").alias("toxic"))
    counts = counts.toArrow()  # at most FOLDS * 2 ** BUCKET_BITS rows of four numbers
    held, toxic = (np.zeros((FOLDS, 1 << BUCKET_BITS), np.int64) for _ in range(2))
    of, buckets = counts.column("fold").to_numpy(), counts.column("bucket").to_numpy()
    held[of, buckets], toxic[of, buckets] = counts.column("held").to_numpy(), counts.column("toxic").to_numpy()
    n, n_toxic = np.zeros(FOLDS, np.int64), np.zeros(FOLDS, np.int64)
    is_toxic = F.sum((F.col("toxic") == 1).cast("long"))
    for row in fitted.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), is_toxic.alias("n_toxic")).collect():
        n[row.fold], n_toxic[row.fold] = row.n, row.n_toxic
    total, toxic_total = held.sum(axis=0), toxic.sum(axis=0)
    counted = _counted(total, toxic_total, n.sum(), n_toxic.sum())
    without = [
        _counted(total - held[f], toxic_total - toxic[f], n.sum() - n[f], n_toxic.sum() - n_toxic[f]) for f in range(FOLDS)
    ]
    ever = np.unique(np.concatenate([counted, *without]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.intersect1d(ever, np.frombuffer(x, "<u4"), assume_unique=True).astype("<u4").tobytes()
                for x in batch.column("terms").to_pylist()
            ]
            columns = [batch.column("doc_id"), batch.column("toxic"), batch.column("fold"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "fold", "terms"])

    # At most sample_rows rows, with the terms that count only.
    rows = fitted.select("doc_id", "toxic", "fold", "terms")
    rows = rows.mapInArrow(pack, f"doc_id {id_type}, toxic int, fold int, terms binary").orderBy("doc_id").toArrow()
    packed = [np.frombuffer(x.as_py(), "<u4") for x in rows.column("terms")]
    truth = (rows.column("toxic").to_numpy() == 1).astype(float)
    return fit_calibrated(counted, packed, truth, rows.column("fold").to_numpy(), without)


def score_toxicity(docs: DataFrame, model: FactorizationMachine, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # at most 2 ** BUCKET_BITS buckets
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            scores, block, size = [np.empty(0)], [], 0
            for found in terms(batch.column("text").to_pylist()):
                block.append(found)
                size += len(found)
                if size > 200_000:
                    scores.append(machine.scores(block))
                    block, size = [], 0
            scores.append(machine.scores(block))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores))], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxic_from).cast("int").alias("predicted"),
    )
