"""Prefix trie of conversations by truncation peeling.

The conversations are peeled from the greatest depth down. At each depth the nodes
that survive from below, with their last turn stripped, meet the conversations that
end there; what has the same turns so far is one node, found and summed up in the same
step, and survives to the next. A node leaves with the number of its parent when that
is found.

A sequence of turns is held as hashes of all its prefixes (two numbers of 64 bits a
turn), so equal prefixes meet by key. Depths are peeled in blocks, from half the
remaining depth on: all that shares the prefix at the block's lowest depth goes to one
task, which peels the block level by level. A prefix with more than ``GROUP_TURNS``
turns above it is left out of that; its upper half is peeled first, and a single
remaining depth is grouped by Spark, which combines rows before it shuffles them. So no
task holds the conversations of a frequent beginning, and the number of jobs grows with
the logarithm of the depth.

Equal conversations are merged before peeling. The numbers of conversations that end at
a node are joined in ranges of ids; only these strings pass through one task in order,
one after the other, as their digest is that of one stream.

Defined cases: turns are in order of ``turn`` (null first), then role, then text; a null
role or text is empty; turns without ``conv_id`` belong to no conversation; a repeated
row is a further turn; very long texts are hashed and counted whole; a conversation's
hashes (24 bytes a turn) are one row; extra columns are left out; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.mixing import n_words
from tablekit.llm.shipping import ship
from tablekit.llm.words import mixed
from tablekit.scratch import written

FAMILY = 20
MOST_SHARED = 4
#: Turns of one prefix that one task peels at most, unless they are of one row.
GROUP_TURNS = 4_096
#: Turns peeled at once, and nodes handed on at once.
BATCH_TURNS, BATCH_NODES = 400_000, 100_000
#: Ids of ends joined into one string lie in a range of so many.
END_RANGE = 4_096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """How many of its first turns a conversation takes from the first one of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, place, h1, h2, n_words)`` of the rebuilt conversations, and all ``conv_id``."""
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = (
        conversations.where(F.col("conv_id").isNotNull())
        .select(
            "conv_id",
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .select(
            "conv_id",
            (F.row_number().over(in_order) - 1).alias("place"),
            F.xxhash64("role", "text").alias("h1"),
            F.xxhash64(F.lit(1), "text", "role").alias("h2"),
            n_words(F.col("text")).alias("n_words"),
        )
    )
    turns = written(turns, "trie-turns")
    ids = turns.where("place = 0").select("conv_id")
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < MOST_SHARED - 1))
    # A first conversation meets the FAMILY ids that follow it at most.
    family = ids.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % FAMILY)
    taken = family.join(first.withColumnRenamed("conv_id", "first_id"), "first_id").drop("first_id")
    own = turns.where(F.col("place") >= shared_turns(F.col("conv_id")))
    taken = taken.where(F.col("place") < shared_turns(F.col("conv_id")))
    return taken.select(turns.columns).unionByName(own), ids


def _lists(values: list[np.ndarray], kind=None) -> pa.Array:
    kind = kind or pa.int64()
    ends = np.cumsum([0] + [len(x) for x in values]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def sequences(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id``, ``n`` and, for each prefix from the empty one on, its key and its last turn's words."""
    each = F.sort_array(F.collect_list(F.struct("place", "h1", "h2", "n_words")))
    listed = turns.groupBy("conv_id").agg(each.alias("turns"))
    listed = ids.join(listed, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col("turns")[k], F.array().cast("array<long>")).alias(k) for k in ("h1", "h2", "n_words")]
    )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(k) for k in ("h1", "h2", "n_words")]
            sizes = np.diff(lists[0].offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            depth = np.arange(sizes.sum()) - np.repeat(starts, sizes) + 1
            # A prefix's key sums up its turns' hashes, each mixed with its place.
            at = np.repeat(np.arange(len(sizes)) + 1, sizes) + np.arange(sizes.sum())
            columns = []
            for i, found in enumerate(lists):
                out = np.zeros(sizes.sum() + len(sizes), np.uint64)
                flat = found.flatten().to_numpy(zero_copy_only=False)
                if i < 2:
                    salt = mixed(depth.astype(np.uint64) + np.uint64(i << 40))
                    total = np.cumsum(mixed(flat.view(np.uint64) ^ salt), dtype=np.uint64)
                    before = np.concatenate([np.zeros(1, np.uint64), total])[starts]
                    out[at] = total - np.repeat(before, sizes)
                else:
                    out[at] = flat.astype(np.uint64)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(ends, pa.array(out.view(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").cast(pa.int64()), pa.array(sizes.astype(np.int32)), *columns],
                ["conv_id", "n", "k1", "k2", "words"],
            )

    return listed.mapInArrow(chain, "conv_id long, n int, k1 array<long>, k2 array<long>, words array<long>")


def end_digests(ends: DataFrame) -> DataFrame:
    """``k1``, ``k2`` and ``digest`` of the numbers in ``conv_id`` that share a key, in order, with commas."""
    spans = (
        ends.groupBy("k1", "k2", F.floor(F.col("conv_id") / END_RANGE).alias("span"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))
        .repartition("k1", "k2")
        .sortWithinPartitions("k1", "k2", "span")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, stream = None, None

        def row(key, stream):
            columns = [[key[0]], [key[1]], [stream.hexdigest()]]
            return pa.RecordBatch.from_pydict(dict(zip(["k1", "k2", "digest"], columns, strict=True)))

        for batch in batches:
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids")), strict=True):
                if (k1, k2) == key:
                    stream.update(b"," + ids.encode())
                    continue
                if key is not None:
                    yield row(key, stream)
                key, stream = (k1, k2), hashlib.sha256(ids.encode())
        if key is not None:
            yield row(key, stream)

    return spans.select("k1", "k2", "ids").mapInArrow(digest, "k1 long, k2 long, digest string")


def distinct_sequences(found: DataFrame) -> DataFrame:
    """Each different sequence once: least ``conv_id``, how many there are, and the digest of their numbers."""
    last = found.select("conv_id", "n", F.element_at("k1", -1).alias("e1"), F.element_at("k2", -1).alias("e2"))
    groups = written(
        last.groupBy("n", "e1", "e2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")),
        "trie-groups",
    )
    several = groups.where("n_convs > 1").select(F.col("e1").alias("k1"), F.col("e2").alias("k2"))
    ends = last.select("conv_id", F.col("e1").alias("k1"), F.col("e2").alias("k2")).join(several, ["k1", "k2"])
    digests = end_digests(ends).select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), "digest")
    one = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    groups = groups.join(digests, ["e1", "e2"], "left").select(
        "conv_id", "n_convs", F.coalesce("digest", one).alias("ends_sha256")
    )
    return found.join(groups, "conv_id")


#: What a row of the state holds: a node below the block or a sequence that ends in it.
STATE = (
    "conv_id long, n int, k1 array<long>, k2 array<long>, words array<long>,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, is_node boolean"
)
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)
_KEPT = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _peel(rows: pa.Table, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Peels whole groups of rows that share their key at depth ``low`` from ``high`` - 1 down to it."""
    get = lambda k: rows.column(k).to_numpy()
    chains = {}
    for name in ("k1", "k2", "words"):
        parts = rows.column(name).combine_chunks()
        parts = pa.concat_arrays(parts.chunks) if isinstance(parts, pa.ChunkedArray) else parts
        chains[name] = parts.values.to_numpy(), parts.offsets.to_numpy().astype(np.int64)
    at = lambda name, row, depth: chains[name][0][chains[name][1][row] + depth]
    n, is_node = get("n"), rows.column("is_node").to_numpy()
    row_ends = np.array(rows.column("ends_sha256").to_pylist(), object)
    all_columns = {k: get(k) for k in _KEPT[:-1]} | {"ends_sha256": row_ends}
    by_depth = np.argsort(-n, kind="stable")
    entering = np.searchsorted(-n[by_depth], -np.arange(high + 1), "left"), np.searchsorted(
        -n[by_depth], -np.arange(high + 1), "right"
    )

    def rows_at(depth):
        found = by_depth[entering[0][depth] : entering[1][depth]]
        return {"row": found, "is_node": is_node[found], **{k: v[found] for k, v in all_columns.items()}}

    joined = lambda x, y: {k: np.concatenate([x[k], y[k]]) for k in x}
    alive = rows_at(high)  # nodes at this depth, found by the block above
    held, size = [], 0
    for depth in range(high - 1, low - 1, -1):
        meeting = joined(alive, rows_at(depth))
        if not len(meeting["row"]):
            continue
        row = meeting["row"]
        key1, key2 = at("k1", row, depth), at("k2", row, depth)
        order = np.lexsort((meeting["conv_id"], key2, key1))
        key1, key2 = key1[order], key2[order]
        new = np.append(True, (key1[1:] != key1[:-1]) | (key2[1:] != key2[:-1]))
        starts = np.flatnonzero(new)
        meeting = {k: v[order] for k, v in meeting.items()}
        total = lambda v: np.add.reduceat(v, starts)  # noqa: B023, E731
        nodes = meeting["is_node"]
        parent = np.repeat(meeting["conv_id"][starts], np.diff(np.append(starts, len(order))))
        if nodes.any():
            below = {k: meeting[k][nodes] for k in _KEPT}
            held.append((depth + 1, below, parent[nodes]))
            size += int(nodes.sum())
        first = meeting["row"][starts]
        n_convs = total(meeting["n_convs"])
        n_children = total(nodes.astype(np.int64))
        ends = np.full(len(starts), NO_ENDS, object)
        ended = np.flatnonzero(~nodes)
        ends[np.searchsorted(starts, ended, "right") - 1] = meeting["ends_sha256"][ended]
        alive = {
            "row": first,
            "is_node": np.ones(len(starts), bool),
            "conv_id": meeting["conv_id"][starts],
            "n_convs": n_convs,
            "n_children": n_children,
            "n_leaves": np.where(n_children == 0, 1, total(np.where(nodes, meeting["n_leaves"], 0))),
            "saved_tokens": total(np.where(nodes, meeting["saved_tokens"], 0)) + (n_convs - 1) * at("words", first, depth),
            "ends_sha256": ends,
        }
        if size > BATCH_NODES:
            yield _found(held)
            held, size = [], 0
    if held:
        yield _found(held)
    if len(alive["row"]):
        cut = lambda name: [
            chains[name][0][s : s + low + 1] for s in chains[name][1][alive["row"]].tolist()
        ]
        yield _batch(
            alive,
            np.full(len(alive["row"]), low, np.int32),
            None,
            [_lists(cut(name)) for name in ("k1", "k2", "words")],
        )


_STATE_COLUMNS = ["conv_id", "n", "k1", "k2", "words", *_KEPT[1:], "is_node", "parent_conv_id"]


def _batch(values: dict, depth: np.ndarray, parent: np.ndarray | None, chains: list[pa.Array]) -> pa.RecordBatch:
    """Nodes as rows: those with a parent are done, those without wait for it."""
    n = len(depth)
    arrays = [
        pa.array(values["conv_id"]),
        pa.array(depth),
        *chains,
        *[pa.array(values[k]) for k in _KEPT[1:-1]],
        pa.array(values["ends_sha256"], pa.string()),
        pa.array(np.ones(n, bool)),
        pa.nulls(n, pa.int64()) if parent is None else pa.array(parent),
    ]
    return pa.RecordBatch.from_arrays(arrays, _STATE_COLUMNS)


def _found(held: list) -> pa.RecordBatch:
    values = {k: np.concatenate([x[1][k] for x in held]) for k in _KEPT}
    depth = np.concatenate([np.full(len(x[2]), x[0], np.int32) for x in held])
    none = [pa.nulls(len(depth), pa.list_(pa.int64()))] * 3
    return _batch(values, depth, np.concatenate([x[2] for x in held]), none)


def _peeled_in_tasks(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Blocks in which every group is small: whole groups per task, many at a time."""
    key = [F.col("k1")[low], F.col("k2")[low]]
    dealt = (
        rows.select("*", key[0].alias("g1"), key[1].alias("g2")).repartition("g1", "g2").sortWithinPartitions("g1", "g2")
    )

    def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for batch in batches:
            held.append(batch)
            turns += len(batch.column("k1").flatten())
            if turns < BATCH_TURNS:
                continue
            # The last group may go on in the next batch.
            table = pa.Table.from_batches(held)
            g1, g2 = table.column("g1").to_numpy(), table.column("g2").to_numpy()
            other = np.flatnonzero((g1 != g1[-1]) | (g2 != g2[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from _peel(table.slice(0, cut).combine_chunks(), low, high)
                rest = pa.Table.from_batches(table.slice(cut).to_batches())
                held, turns = rest.to_batches(), 0
        if held:
            yield from _peel(pa.Table.from_batches(held).combine_chunks(), low, high)

    return dealt.mapInArrow(peel, f"{STATE}, parent_conv_id long").select(_STATE_COLUMNS)


def _peeled_level(rows: DataFrame, low: int) -> DataFrame:
    """One depth whose groups may hold any number of rows, combined by Spark before its shuffle."""
    key = [F.col("k1")[low].alias("g1"), F.col("k2")[low].alias("g2")]
    node = lambda c: F.when(F.col("is_node"), F.col(c)).otherwise(0)
    groups = written(
        rows.groupBy(*key).agg(
            F.min("conv_id").alias("first_id"),
            F.sum("n_convs").alias("all_convs"),
            F.sum(F.col("is_node").cast("long")).alias("children"),
            F.sum(node("n_leaves")).alias("leaves"),
            F.sum(node("saved_tokens")).alias("saved"),
            F.max(F.when(~F.col("is_node"), F.col("ends_sha256"))).alias("ends"),
        ),
        "trie-level",
    )
    met = rows.select("*", *key).join(groups, ["g1", "g2"])
    done = met.where("is_node").withColumn("parent_conv_id", F.col("first_id"))
    words = F.col("words")[low]
    lists = [F.slice(k, 1, low + 1).alias(k) for k in ("k1", "k2", "words")]
    # The row that gave the least number has the node's turns; it is one row of the group.
    alive = met.where(F.col("conv_id") == F.col("first_id")).select(
        "conv_id",
        F.lit(low).alias("n"),
        *lists,
        F.col("all_convs").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).alias("n_leaves"),
        (F.col("saved") + (F.col("all_convs") - 1) * words).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        F.lit(True).alias("is_node"),
        F.lit(None).cast("long").alias("parent_conv_id"),
    )
    none = F.lit(None).cast("array<long>")
    done = done.withColumns({k: none for k in ("k1", "k2", "words")}).select(_STATE_COLUMNS)
    return done.unionByName(alive)


def _block(rows: DataFrame, low: int, high: int, group_turns: int) -> list[DataFrame]:
    """Written tables of all nodes from depth ``high`` (done) to ``low`` (waiting for their parents)."""
    key = [F.col("k1")[low].alias("g1"), F.col("k2")[low].alias("g2")]
    large = written(
        rows.groupBy(*key)
        .agg(F.sum(F.size("k1")).alias("turns"), F.count(F.lit(1)).alias("rows"))
        .where((F.col("turns") > group_turns) & (F.col("rows") > 1))
        .select("g1", "g2"),
        "trie-large",
    )
    if large.isEmpty():
        return [written(_peeled_in_tasks(rows, low, high), "trie-block")]
    met = rows.select("*", *key)
    small = met.join(large, ["g1", "g2"], "left_anti").drop("g1", "g2")
    hot = met.join(large, ["g1", "g2"], "left_semi").drop("g1", "g2")
    found = [written(_peeled_in_tasks(small, low, high), "trie-block")]
    if high - low == 1:
        return [*found, written(_peeled_level(hot, low), "trie-block")]
    hot = written(hot, "trie-hot")
    middle = (low + high) // 2
    upper = _block(hot.where(F.col("n") >= middle), middle, high, group_turns)
    alive = [x.where("parent_conv_id is null").drop("parent_conv_id") for x in upper]
    lower = hot.where(F.col("n") < middle)
    for table in alive:
        lower = lower.unionByName(table)
    return [*found, *[x.where("parent_conv_id is not null") for x in upper], *_block(lower, low, middle, group_turns)]


def conversation_trie(conversations: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """One row per node: its least conversation, depth, parent's, and sums over its subtree."""
    spark = conversations.sparkSession
    ship(spark)
    found = written(sequences(*rebuilt_turns(conversations)), "trie-sequences")
    ends = written(
        distinct_sequences(found).select(
            "conv_id",
            "n",
            "k1",
            "k2",
            "words",
            "n_convs",
            *[F.lit(0).cast("long").alias(k) for k in ("n_children", "n_leaves", "saved_tokens")],
            "ends_sha256",
            F.lit(False).alias("is_node"),
        ),
        "trie-ends",
    )
    deepest = ends.agg(F.max("n")).first()[0]
    if deepest is None:
        return spark.createDataFrame([], NODES)
    high, tables, alive = deepest + 1, [], []
    while high:
        low = 1 << (high - 1).bit_length() - 1 if high > 1 else 0
        rows = ends.where((F.col("n") >= low) & (F.col("n") < high))
        for table in alive:
            rows = rows.unionByName(table)
        block = _block(rows, low, high, group_turns)
        tables += [x.where("parent_conv_id is not null") for x in block]
        alive = [x.where("parent_conv_id is null").drop("parent_conv_id") for x in block]
        high = low
    tables += [x.withColumn("parent_conv_id", F.lit(None).cast("long")) for x in alive]
    names = [x.split()[0] for x in NODES.split(", ")]
    every = None
    for table in tables:
        nodes = table.withColumn("depth", F.col("n").cast("long")).select(names)
        every = nodes if every is None else every.unionByName(nodes)
    return every
