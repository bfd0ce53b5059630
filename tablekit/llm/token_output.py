"""Training-order token files: fixed-stride records in a keyed random order.

All documents' ids, each followed by the end id, form one stream, cut into
sequences of a fixed length; the last is padded. A keyed Feistel permutation with
cycle-walking gives every sequence its slot in the training order. Slots are split
by range into shards of the same number of records, written in order, so a reader
finds slot s in shard ``s // shard_records`` at byte
``s % shard_records * record_bytes`` and can resume anywhere.

A record is the sequence's ids, little-endian, 2 bytes each (4 for larger
vocabularies), one zero byte and one newline, so its length is even: Spark's text
writer writes such records through any file system it knows, and its committer makes
lost tasks harmless. ``manifest`` next to the shards has all that a reader must know.

Documents are tokenised once. Their ids are written as compressed blocks, numbered
within their input task; a block's place in the stream follows from the sizes of the
blocks and tasks before it, the number of sequences from the sum. Blocks are then cut,
the parts that go to one shard travel together, compressed again, and a shard is
put together in one array of its fixed size. The blocks are removed at the end.

Defined cases: a null text is empty, just the end id; repeated rows are written each;
very long texts fill many blocks; extra columns are left out; an empty table gives no
shard and an empty result; a path to read holds no comma, which parts paths there.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.llm.packing import END_ID, SEQUENCE_LENGTH, VOCABULARY, with_end
from tablekit.llm.shipping import ship
from tablekit.llm.tokens import check_ranks, encoder
from tablekit.scratch import scratch, written

SHARD_RECORDS = 8_192
ROUNDS = 6
KEY = 20_240_229
#: Records handed on at once when a shard is put together or read, and bytes of shards that one task reads.
READ_RECORDS, PART_BYTES = 512, 1 << 24
SHARD_FOLDER = re.compile(r"/shard=(\d+)/[^/]*$")
#: Ids of a block, and how hard blocks and the parts of a shard are compressed.
BLOCK_IDS, BLOCK_LEVEL, PART_LEVEL = 1 << 19, 6, 3


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SlotOrder:
    """A keyed permutation of the numbers 0 to n - 1."""

    def __init__(self, n: int, key: int = KEY, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, -(-max(1, n - 1).bit_length() // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = _mixed(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (_mixed(left ^ key) & self.mask), left
            else:
                left, right = right, left ^ (_mixed(right ^ key) & self.mask)
        return (left << self.half) | right

    def _walk(self, numbers, back: bool) -> np.ndarray:
        x = np.asarray(numbers, np.uint64)
        x = self._once(x, back)
        while (outside := x >= self.n).any():
            x[outside] = self._once(x[outside], back)
        return x.astype(np.int64)

    def slots(self, sequences) -> np.ndarray:
        return self._walk(sequences, False)

    def sequences(self, slots) -> np.ndarray:
        return self._walk(slots, True)


def _token_blocks(docs: DataFrame, vocabulary: str, end_id: int, kind: str) -> DataFrame:
    """``(task, block, n_ids, ids)``: the stream in compressed blocks, in order within each input task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        packer = zstandard.ZstdCompressor(level=BLOCK_LEVEL)
        held, size = [], 0

        def block():
            ids = np.concatenate(held)
            columns = [[task], [number], [len(ids)], [packer.compress(ids.tobytes())]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["task", "block", "n_ids", "ids"]
            )

        for batch in batches:
            for ids, bounds in encoder(vocabulary).encode(batch.column("text")):
                held.append(with_end(ids, bounds, end_id)[0].astype(kind))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    held, size, number = [], 0, number + 1
        if held:
            yield block()

    return docs.select("text").mapInArrow(encode, "task long, block long, n_ids long, ids binary")


def _placed(blocks: DataFrame) -> DataFrame:
    """The blocks with the place of their first id in the stream, ``at``."""
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per input task.
    tasks = blocks.groupBy("task").agg(F.sum("n_ids").alias("n_ids"))
    tasks = written(tasks.select(F.col("task").alias("of_task"), before(Window.orderBy("task")).alias("task_at")), "token-tasks")
    sizes = blocks.select("task", "block", before(Window.partitionBy("task").orderBy("block")).alias("block_at"))
    places = written(
        sizes.join(tasks, F.col("task") == F.col("of_task")).select(
            "task", "block", (F.col("task_at") + F.col("block_at")).alias("at")
        ),
        "token-places",
    )
    return blocks.join(places, ["task", "block"]).select("at", "ids")


def write_shards(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    sequence_length: int = SEQUENCE_LENGTH,
    end_id: int = END_ID,
    shard_records: int = SHARD_RECORDS,
    key: int = KEY,
    id_bytes: int = 2,
) -> dict:
    """Writes ``path/shards`` and ``path/manifest``; returns what the manifest says."""
    spark = docs.sparkSession
    ship(spark)
    check_ranks(vocabulary)
    kind, stride = f"<u{id_bytes}", sequence_length * id_bytes
    with scratch(spark):
        blocks = written(_token_blocks(docs, vocabulary, end_id, kind), "token-blocks")
        total = blocks.agg(F.coalesce(F.sum("n_ids"), F.lit(0))).first()[0]
        n = -(-total // sequence_length)
        about = {
            "sequences": n, "tokens": total, "sequence_length": sequence_length, "shard_records": shard_records,
            "key": key, "id_bytes": id_bytes, "record_bytes": stride + 2, "vocabulary": vocabulary, "end_id": end_id,
        }
        order = SlotOrder(n, key)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer, unpacker = zstandard.ZstdCompressor(level=PART_LEVEL), zstandard.ZstdDecompressor()
            for batch in batches:
                for at, data in zip(batch.column("at").to_pylist(), batch.column("ids"), strict=True):
                    ids = np.frombuffer(unpacker.decompress(data.as_buffer()), kind)
                    edges = np.arange(-(-at // sequence_length) * sequence_length - at, len(ids), sequence_length)
                    starts = np.unique(np.append(edges, 0))
                    sizes = np.diff(np.append(starts, len(ids)))
                    slots, offsets = order.slots((at + starts) // sequence_length), (at + starts) % sequence_length
                    by_slot = np.argsort(slots, kind="stable")
                    shards, first = np.unique(slots[by_slot] // shard_records, return_index=True)
                    parts = np.split(by_slot, first[1:])
                    longs = pa.list_(pa.int64())
                    raw = [np.concatenate([ids[starts[i] : starts[i] + sizes[i]] for i in p.tolist()]).tobytes() for p in parts]
                    columns = [
                        pa.array(shards),
                        *[pa.array([x[p] for p in parts], longs) for x in (slots, offsets, sizes)],
                        pa.array(list(map(packer.compress, raw)), pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "slots", "offsets", "sizes", "ids"])

        def assemble(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """One shard's records, from the parts of one shard, handed on some at a time."""
            unpacker, records = zstandard.ZstdDecompressor(), None
            for some in parts:
                if records is None:
                    shard = some.column("shard")[0].as_py()
                    first = shard * shard_records
                    records = np.zeros((min(shard_records, n - first), stride + 1), np.uint8)
                    ids_of = records[:, :stride]
                for start in range(0, len(some), 64):
                    chunk = some.slice(start, 64)
                    columns = [chunk.column(c).to_pylist() for c in ("slots", "offsets", "sizes")]
                    for slots, offsets, sizes, data in zip(*columns, chunk.column("ids"), strict=True):
                        raw, at = np.frombuffer(unpacker.decompress(data.as_buffer()), np.uint8), 0
                        for slot, offset, size in zip(slots, offsets, sizes, strict=True):
                            end = at + size * id_bytes
                            ids_of[slot - first, offset * id_bytes : (offset + size) * id_bytes] = raw[at:end]
                            at = end
            for start in range(0, len(records), READ_RECORDS):
                some = records[start : start + READ_RECORDS]
                ends = np.arange(len(some) + 1, dtype=np.int32) * (stride + 1)
                values = pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(some)])
                slots = pa.array(np.arange(first + start, first + start + len(some)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), shard)), slots, values], ["shard", "slot", "value"])

        longs = ", ".join(f"{c} array<long>" for c in ("slots", "offsets", "sizes"))
        parts = _placed(blocks).mapInArrow(cut, f"shard long, {longs}, ids binary")
        (
            parts.groupBy("shard")
            .applyInArrow(assemble, "shard long, slot long, value binary")
            .sortWithinPartitions("shard", "slot")
            .select("shard", F.col("value").cast("string").alias("value"))
            .write.partitionBy("shard")
            .option("lineSep", "\n")
            .text(f"{path}/shards")
        )
        # Last, so shards with a manifest are whole.
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/manifest")
    return about


def read_manifest(spark: SparkSession, path: str) -> dict:
    """What a reader of ``path/shards`` must know."""
    return json.loads(spark.read.text(f"{path}/manifest").first().value)


def _read(
    spark: SparkSession, path: str, first_slot: int, last_slot: int | None, rows: Callable[[np.ndarray, np.ndarray, int], Iterable[tuple]], schema: str
) -> DataFrame:
    """``slot``, ``sequence`` and what ``rows`` gives for each of some records as rows of bytes, of the slots asked for.

    A shard is handed from its file to Python as it is, so it is no row of a table on its way.
    """
    if "," in path:
        raise ValueError(f"the path {path} holds a comma")
    ship(spark)
    about = read_manifest(spark, path)
    n, records, length = about["sequences"], about["shard_records"], about["sequence_length"]
    last = n - 1 if last_slot is None else min(last_slot, n - 1)
    first = max(first_slot, 0)
    schema = f"slot long, sequence long, {schema}"
    if first > last:
        return spark.createDataFrame([], schema)
    id_bytes, total, order = about["id_bytes"], about["tokens"], SlotOrder(n, about["key"])
    stride = about["record_bytes"]

    def split(shard_file: tuple[str, bytes]) -> Iterator[tuple]:
        file, content = shard_file
        shard = int(SHARD_FOLDER.search(file)[1])
        if len(content) % stride:
            raise ValueError(f"shard {shard} is not a whole number of records")
        whole = np.frombuffer(content, np.uint8).reshape(-1, stride)
        begin = shard * records
        for start in range(max(first - begin, 0), min(last + 1 - begin, len(whole)), READ_RECORDS):
            some = whole[start : min(start + READ_RECORDS, last + 1 - begin)]
            slots = np.arange(len(some)) + begin + start
            sequences = order.sequences(slots)
            sizes = np.minimum(length, total - sequences * length)
            for slot, sequence, row in zip(slots.tolist(), sequences.tolist(), rows(some, sizes, id_bytes), strict=True):
                yield slot, sequence, *row

    low, high = first // records, last // records
    wanted = "*" if (low, high) == (0, (n - 1) // records) else f"{{{','.join(map(str, range(low, high + 1)))}}}"
    parts = -(-(high - low + 1) * records * stride // PART_BYTES)
    files = spark.sparkContext.binaryFiles(f"{path}/shards/shard={wanted}", parts)
    return spark.createDataFrame(files.flatMap(split), schema, verifySchema=False)


def _ids(records: np.ndarray, sizes: np.ndarray, id_bytes: int) -> Iterator[tuple]:
    for record, size in zip(records, sizes.tolist(), strict=True):
        yield (bytearray(record[: size * id_bytes]),)


def _digests(records: np.ndarray, sizes: np.ndarray, id_bytes: int) -> Iterator[tuple]:
    wide = np.ascontiguousarray(records[:, : records.shape[1] // id_bytes * id_bytes]).view(f"<u{id_bytes}").astype("<u4")
    for ids, size in zip(wide, sizes.tolist(), strict=True):
        yield size, zlib.crc32(ids[:size])


def read_records(spark: SparkSession, path: str, first_slot: int = 0, last_slot: int | None = None) -> DataFrame:
    """``slot``, ``sequence`` and ``ids`` of the slots asked for, read from the shards that hold them."""
    return _read(spark, path, first_slot, last_slot, _ids, "ids binary")


def read_digests(spark: SparkSession, path: str, first_slot: int = 0, last_slot: int | None = None) -> DataFrame:
    """As :func:`read_records`, with ``n_ids`` and ``ids_crc32`` (of the ids as 4 bytes each) in place of the ids."""
    return _read(spark, path, first_slot, last_slot, _digests, "n_ids long, ids_crc32 long")
