"""Best-fit packing of tokenised documents into sequences of a fixed length.

Best-fit decreasing needs only how many pieces there are of each length, at most
one number per possible length. These counts go to the driver, where a segment
tree over remaining capacities finds the tightest open sequence in logarithmic
time; pieces of one length that meet equal sequences are placed as a run. The runs
(their number is bounded by the sequence length alone) are broadcast, and a piece
finds its place from its length and its number among the pieces of that length.
The result is the one that packing piece by piece gives.

Defined cases: a null text is empty and is one piece with the end id; a null
``doc_id`` stays null; repeated rows are packed each; extra columns are left out;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.shipping import ship
from tablekit.llm.tokens import check_ranks, encoder
from tablekit.scratch import written

#: A vocabulary of public_tokenizers, by the name of its files.
VOCABULARY = "byte_bpe_50k"
SEQUENCE_LENGTH = 1024
END_ID = 2
#: Pieces of one length are numbered in groups of about so many.
GROUP_PIECES = 2_000


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts with the end id after each, and their new bounds."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))] = ids
    return out, bounds + np.arange(n + 1)


def token_pieces(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    sequence_length: int = SEQUENCE_LENGTH,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of the tokenised documents; a long document's first piece takes the odd length."""
    ship(docs.sparkSession)
    check_ranks(vocabulary)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    if keep_ids:
        schema += ", ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for ids, bounds in encoder(vocabulary).encode(batch.column("text")):
                ids, bounds = with_end(ids, bounds, end_id)
                sizes = np.diff(bounds)
                pieces = -(-sizes // sequence_length)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (sizes - (pieces - 1) * sequence_length)[doc]
                start = np.where(number == 0, 0, first + (number - 1) * sequence_length)
                length = np.where(number == 0, first, sequence_length)
                raw, at = ids.astype("<u4").tobytes(), (bounds[:-1][doc] + start) * 4
                parts = [raw[a : a + 4 * n] for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                columns = [
                    batch.column("doc_id").slice(row, len(sizes)).take(pa.array(doc)),
                    pa.array(number.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.array(np.fromiter(map(zlib.crc32, parts), np.int64, len(parts))),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
                row += len(sizes)
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


class CapacityTree:
    """Segment tree over capacities 0 to ``most``; each leaf counts open sequences."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, count: int) -> None:
        at = capacity + self.leaves
        while at:
            self.open[at] += count
            at //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` with an open sequence."""
        at = least + self.leaves
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_runs(counts: dict[int, int], sequence_length: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces per length.

    Returns runs ``(length, lo, hi, first, per_sequence, offset)``: the pieces
    numbered lo to hi - 1 of that length fill the sequences from ``first`` on,
    ``per_sequence`` in each, from ``offset``. A sequence with room r takes
    r div length pieces of a length in turn, as it stays the tightest while it
    fits; what is left is less than half of r, so it is met a logarithmic number
    of times.
    """
    tree = CapacityTree(sequence_length)
    groups: dict[int, list[tuple[int, int]]] = {}
    runs, opened = [], 0

    def put(capacity: int, first: int, n: int) -> None:
        if n:
            groups.setdefault(capacity, []).append((first, n))
            tree.add(capacity, n)

    for length in sorted(counts, reverse=True):
        number, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, n = sequence_length, -(-left // (sequence_length // length))
                put(room, opened, n)
                opened += n
            first, n = groups[room].pop()
            tree.add(room, -n)
            each = room // length
            used = min(n, left // each)
            if not used:
                used, each = 1, left
            runs.append((length, number, number + used * each, first, each, sequence_length - room))
            put(room - each * length, first, used)
            put(room, first + used, n - used)
            number, left = number + used * each, left - used * each
    return runs


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    sequence_length: int = SEQUENCE_LENGTH,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Every piece with the ``sequence_id`` it lies in and its ``offset`` there.

    With ``keep_ids`` the piece's ids come along, 4 bytes each, little-endian.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, vocabulary, sequence_length, end_id, keep_ids), "pack-pieces")
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # sequence_length rows at most
    groups = spark.createDataFrame(
        [(n, -(-c // GROUP_PIECES)) for n, c in counts.items()], "length long, groups long"
    )
    runs = spark.createDataFrame(
        best_fit_runs(counts, sequence_length),
        "run_length long, lo long, hi long, first long, each long, room_start long",
    )
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("groups"))
    grouped = pieces.join(F.broadcast(groups), "length").withColumn("group", group).drop("groups")
    so_far = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        grouped.groupBy("length", "group")
        .count()
        .select("length", "group", F.coalesce(F.sum("count").over(so_far), F.lit(0)).alias("before")),
        "pack-groups",
    )
    in_group = Window.partitionBy("length", "group").orderBy("doc_id", "piece")
    numbered = grouped.join(offsets, ["length", "group"]).withColumn(
        "number", F.col("before") + F.row_number().over(in_group) - 1
    )
    place = F.col("number") - F.col("lo")
    found = (F.col("length") == F.col("run_length")) & (F.col("number") >= F.col("lo")) & (F.col("number") < F.col("hi"))
    return numbered.join(F.broadcast(runs), found).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.expr("(number - lo) div each")).alias("sequence_id"),
        (F.col("room_start") + place % F.col("each") * F.col("length")).alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of :func:`pack` with ``keep_ids``: its ids in order and their number."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), parts.alias("parts"))
        .select(
            "sequence_id",
            "length",
            F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"])).alias("ids"),
        )
    )
