"""Exact self-join of documents by the Jaccard similarity of their word shingles.

Sets with the same shingles are one class and share one answer. Classes are joined
by prefix lists with set-relation skipping at two levels:

*Index.* A list holds, per shingle of a set's prefix, the sets that have it, by
size, with the shingle's position in each set. Lists are walked in blocks; a pair
of blocks is skipped if its sizes or the shingles left behind the positions cannot
reach the overlap asked for, or if all its sets have the same answer already.

*Answers.* Sets that agree in a few smallest hashes are compared with one leader
first. Members linked to a leader share its component, so lists need not bring them
together. For other candidates only the leaders are compared; a member's overlap
follows from its leader's up to the few shingles in which the two differ, and
only where that leaves the answer open are the members themselves compared. Pairs
whose signatures (parities of shingles per bit) differ in more bits than linked sets
can differ in shingles are left out where they meet, so they are never written; only
entries of a list with a partner of fitting size carry a signature. Long lists are a
grid of cells of at most ``CELL`` entries a side, each a group of its own.

Any order of the shingles gives the same links. Shingles many documents share come
last, so that few meet in their lists: of the shingles found in at least
``CHUNK_DOCS`` documents of some chunk of the corpus, at most ``MOST_FREQUENT`` with
the largest counts over all documents; this table is broadcast.

Defined cases: a null text, or one without words, has an empty set and links with
nothing; fewer words than a shingle are one shingle; a null ``doc_id`` links with
nothing and has no component; rows that share a ``doc_id`` count as linked, but
:func:`distinct_documents` keeps one of each of their groups of texts; repeated rows
get the same answer; very long texts are read whole; extra columns are left out; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.bits import asked_for
from tablekit.llm.components import components
from tablekit.llm.shipping import ship
from tablekit.llm.words import mixed, word_hashes
from tablekit.scratch import written

WORDS = 5
PERCENT = 80
#: Groups of smallest hashes, and hashes in each, by which leaders are found.
BANDS, BAND_HASHES = 4, 4
#: Shingles gathered per chunk when counting, and the documents of a chunk that must share one.
CHUNK_SHINGLES, CHUNK_DOCS = 2_000_000, 2
MOST_FREQUENT = 1 << 18
#: Entries of a list walked together, and those of a side of a cell.
BLOCK, CELL = 256, 1 << 14
#: Pairs handed on at once.
PAIR_ROWS = 1 << 17
#: Members compared with one copy of their leader.
LEADER_MEMBERS = 512
#: Longs of a signature.
SIGNATURE = 16


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct shingles of k words, sorted; all words as one if there are fewer."""
    n = len(words)
    if not n:
        return words
    size = min(n, k)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + words[i : n - size + 1 + i])
    return np.unique(total)


def digest(shingle_set: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that stand for a set."""
    if not len(shingle_set):
        return 0, 0
    parts = (mixed(shingle_set + np.uint64(1)).sum(), mixed(shingle_set ^ np.uint64(0x5851F42D4C957F2D)).sum())
    one, two = (mixed(np.array([p, len(shingle_set)], np.uint64)) for p in parts)
    return int((one[:1] + one[1:]).astype(np.int64)[0]), int((two[:1] ^ two[1:]).astype(np.int64)[0])


def bands(shingle_set: np.ndarray) -> list[int]:
    """Per band the combined smallest hashes under an order of its own."""
    out = []
    for band in range(BANDS):
        hashes = mixed(shingle_set + np.uint64((band + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
        if len(hashes) > BAND_HASHES:
            hashes = np.partition(hashes, BAND_HASHES)[:BAND_HASHES]
        out.append(int(mixed(hashes).sum(keepdims=True).astype(np.int64)[0]))
    return out


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of shingles falls on each.

    Two sets differ in at least as many shingles as their signatures do in bits.
    """
    places = (mixed(shingle_set ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)) % np.uint64(64 * SIGNATURE)
    odd = np.bincount(places.astype(np.int64), minlength=64 * SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefix(shingle_set: np.ndarray, percent: int, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles in the common order: any linked set shares one of them."""
    n = len(shingle_set)
    size = n - -(-percent * n // 100) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingle_set), len(frequent) - 1)
        weight = np.where(frequent[at] == shingle_set, counts[at], 0)
        shingle_set = shingle_set[np.argsort(weight, kind="stable")]
    return shingle_set[:size]


def _frequent_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(chunk):
            values, n = np.unique(np.concatenate(chunk), return_counts=True)
            often = n >= CHUNK_DOCS
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].astype(np.int64)), pa.array(n[often].astype(np.int64))], ["shingle", "n"]
            )

        chunk, size = [], 0
        for batch in batches:
            for words in word_hashes(batch.column("text").to_pylist()):
                chunk.append(shingles(words, k))
                size += len(chunk[-1])
                if size >= CHUNK_SHINGLES:
                    yield counted(chunk)
                    chunk, size = [], 0
        if chunk:
            yield counted(chunk)

    totals = written(
        docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")),
        "ngram-frequent",
    )
    # A histogram of at most a few hundred rows gives the count from which they fit.
    level = F.floor(F.log2("n") * 8).cast("int")
    kept, least = 0, None
    for row in sorted(totals.groupBy(level.alias("level")).count().collect(), reverse=True):
        kept += row["count"]
        if kept > MOST_FREQUENT:
            break
        least = row["level"]
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = totals.where(level >= least).collect()
    values = np.array([r.shingle for r in rows], np.int64).astype(np.uint64)
    order = np.argsort(values)
    return values[order], np.array([r.n for r in rows], np.int64)[order]


def _sketches(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row ``doc_id``, ``text_hash``, ``n``, its digest, bands, signature and prefix."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_frequent_shingles(docs, k))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = shared.value
        names = ["doc_id", "text_hash", "n", "d1", "d2", "bands", "signature", "prefix"]
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):
                part = batch.slice(start, 1_000)
                sizes, digests, marks, signatures, prefixes = [], [], [], [], []
                for words in word_hashes(part.column("text").to_pylist()):
                    own = shingles(words, k)
                    sizes.append(len(own))
                    digests.append(digest(own))
                    marks.append(bands(own) if len(own) else [])
                    signatures.append(signature(own))
                    prefixes.append(_prefix(own, percent, frequent, counts).astype(np.int64) if len(own) else [])
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(sizes, pa.int64()),
                        pa.array([d[0] for d in digests], pa.int64()),
                        pa.array([d[1] for d in digests], pa.int64()),
                        pa.array(marks, longs),
                        pa.array(signatures, longs),
                        pa.array(prefixes, longs),
                    ],
                    names,
                )

    schema = (
        "doc_id long, text_hash long, n long, d1 long, d2 long, bands array<bigint>, signature array<bigint>,"
        " prefix array<bigint>"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(sketch, schema)


def _may_link(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes ``(x, dx, y, dy)`` without those whose signatures differ in too many bits."""
    asked = pairs.select(F.col("x").alias("rep")).unionByName(pairs.select(F.col("y").alias("rep")))
    own = asked_for(classes.select("rep", "d1", "n", "signature"), "rep", asked)
    for side in "xy":
        theirs = own.select(
            F.col("rep").alias(side), F.col("d1").alias(f"d{side}"), F.col("n").alias(f"size_{side}"),
            F.col("signature").alias(f"signature_{side}"),
        )
        pairs = pairs.join(theirs, [side, f"d{side}"])
    differ = F.zip_with("signature_x", "signature_y", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    # The union is the overlap and what differs: o = (sizes - differ) / 2.
    most = F.col("size_x") + F.col("size_y") - F.aggregate(differ, F.lit(0), lambda done, n: done + n)
    reached = (100 + percent) * most >= 2 * percent * (F.col("size_x") + F.col("size_y"))
    return pairs.where(reached).drop("size_x", "size_y", "signature_x", "signature_y")


def _overlaps(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The exact overlap ``o`` of pairs of classes ``(x, dx, y, dy)``.

    Texts are brought to the pairs once per row and side; the y side of many pairs
    is copied so that no task compares more than some members with it.
    """
    pairs = written(pairs, "ngram-pairs")
    copies = pairs.groupBy("y", "dy").agg(F.ceil(F.count(F.lit(1)) / LEADER_MEMBERS).alias("copies"))
    dealt = pairs.join(copies, ["y", "dy"]).withColumn("copy", F.pmod(F.xxhash64("x", "dx"), F.col("copies")))
    group = [F.col("y").alias("key"), F.col("dy").alias("dkey"), "copy"]
    sides = written(
        dealt.select(F.col("x").alias("doc"), F.col("dx").alias("own"), *group, F.lit(1).alias("role")).unionByName(
            dealt.select(F.col("y").alias("doc"), F.col("dy").alias("own"), *group, F.lit(0).alias("role")).distinct()
        ),
        "ngram-sides",
    )
    texts = asked_for(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), "doc", sides.select("doc"))
    rows = (
        texts.join(sides, "doc")
        .select("key", "dkey", "copy", "role", "doc", "own", "text")
        .repartition("key", "dkey", "copy")
        .sortWithinPartitions("key", "dkey", "copy", "role")
    )
    names = ["x", "dx", "nx", "y", "dy", "ny", "o"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leader = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("key", "dkey", "copy", "role", "doc", "own")]
            sets = (shingles(words, k) for words in word_hashes(batch.column("text").to_pylist()))
            for key, dkey, copy, role, doc, own, theirs in zip(*columns, sets, strict=True):
                if digest(theirs)[0] != own:
                    continue  # another row of the same id
                if role == 0:
                    at, leader = (key, dkey, copy), theirs
                elif at == (key, dkey, copy):
                    place = np.minimum(np.searchsorted(leader, theirs), len(leader) - 1)
                    found.append((doc, own, len(theirs), key, dkey, len(leader), int((leader[place] == theirs).sum())))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)

    schema = ", ".join(f"{c} long" for c in names)
    return written(rows.mapInArrow(compare, schema).distinct(), "ngram-overlaps")


def _shared_entries(entries: DataFrame, percent: int) -> DataFrame:
    """The entries with a partner of fitting size in a list of several components.

    ``block`` numbers the blocks of a list by size; ``blocks`` is how many it has.
    """
    whole = Window.partitionBy("shingle")
    by_size = whole.orderBy("n", "d1", "rep")
    placed = entries.select(
        "*",
        F.lag("n").over(by_size).alias("smaller"),
        F.lead("n").over(by_size).alias("larger"),
        F.floor((F.row_number().over(by_size) - 1) / CELL).cast("int").alias("block"),
        F.ceil(F.count(F.lit(1)).over(whole) / CELL).cast("int").alias("blocks"),
        F.min("comp").over(whole).alias("least"),
        F.max("comp").over(whole).alias("most"),
    )
    fits = (100 * F.col("smaller") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("larger"))
    return placed.where((F.col("least") != F.col("most")) & fits).drop("smaller", "larger", "least", "most")


def _pairs_in_cell(n, pos, comp, signatures, percent: int, split: int):
    """Index pairs of a cell that may be linked and are not in one component.

    Entries are sorted by size; with a ``split`` only pairs across it are asked for.
    """
    rest = n - pos
    edges = [*range(0, split, BLOCK), *range(split, len(n), BLOCK)]
    ends = [*edges[1:], len(n)]
    spans = list(map(slice, edges, ends))
    least = [int(comp[s].min()) for s in spans]
    most = [int(comp[s].max()) for s in spans]
    left = [int(rest[s].max()) for s in spans]
    across = sum(a < split for a in edges)
    for j in range(across, len(edges)):
        nj, rj, cj = n[spans[j]], rest[spans[j]], comp[spans[j]]
        for i in range(across - 1 if split else j, -1, -1):
            ni = n[spans[i]]
            if 100 * ni[-1] < percent * nj[0]:
                break  # this block and all before hold sets too small
            need = percent * (ni[0] + nj[0])
            if min(left[i], left[j]) * (100 + percent) < need or least[i] == most[i] == least[j] == most[j]:
                continue
            ri, ci = rest[spans[i]], comp[spans[i]]
            may = (
                (ci[:, None] != cj[None, :])
                & (100 * ni[:, None] >= percent * nj[None, :])
                & (np.minimum(ri[:, None], rj[None, :]) * (100 + percent) >= percent * (ni[:, None] + nj[None, :]))
            )
            if i == j:
                may = np.triu(may, 1)
            p, q = np.nonzero(may)
            p, q = p + edges[i], q + edges[j]
            # The union is the overlap and what differs: o = (sizes - differ) / 2.
            sizes = n[p] + n[q]
            differ = np.bitwise_count(signatures[p] ^ signatures[q]).sum(axis=1, dtype=np.int64)
            alike = (100 + percent) * (sizes - differ) >= 2 * percent * sizes
            if alike.any():
                yield p[alike], q[alike]


def _candidates(entries: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a prefix shingle and may be linked."""
    names = ["shingle", "row", "column", "block", "rep", "d1", "n", "pos", "comp"]
    out = ["x", "dx", "nx", "y", "dy", "ny"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(columns, signatures):
            """Pairs of the cells in sorted arrays."""
            shingle, row, column, block, rep, d1, n, pos, comp = columns
            new = (np.diff(shingle) != 0) | (np.diff(row) != 0) | (np.diff(column) != 0)
            starts = [0, *(np.flatnonzero(new) + 1).tolist(), len(shingle)]
            for s, e in zip(starts, starts[1:], strict=False):
                span = slice(s, e)
                split = int((block[span] == row[s]).sum()) if row[s] != column[s] else 0
                if row[s] != column[s] and split in (0, e - s):
                    continue
                for p, q in _pairs_in_cell(n[span], pos[span], comp[span], signatures[span], percent, split):
                    p, q = p + s, q + s
                    swap = (rep[p] < rep[q]) | (rep[p] == rep[q]) & (d1[p] < d1[q])
                    p, q = np.where(swap, q, p), np.where(swap, p, q)
                    yield np.stack([rep[p], d1[p], n[p], rep[q], d1[q], n[q]])

        def batched(found):
            """Pairs in batches, each pair once a batch."""
            parts, size = [], 0
            for part in found:
                parts.append(part)
                size += part.shape[1]
                if size >= PAIR_ROWS:
                    yield np.unique(np.concatenate(parts, axis=1), axis=1)
                    parts, size = [], 0
            if parts:
                yield np.unique(np.concatenate(parts, axis=1), axis=1)

        def whole_cells():
            held, held_signatures = [np.empty(0, np.int64)] * len(names), np.empty((0, SIGNATURE), np.uint64)
            for batch in batches:
                # Never more than a cell and a batch.
                held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, names, strict=True)]
                theirs = batch.column("signature").flatten().to_numpy().view(np.uint64).reshape(-1, SIGNATURE)
                held_signatures = np.concatenate([held_signatures, theirs])
                if not len(held[0]):
                    continue
                same = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
                last = len(same) - int(same.sum())  # a cell's entries come in one run
                if last:
                    yield from pairs([c[:last] for c in held], held_signatures[:last])
                    held, held_signatures = [c[last:] for c in held], held_signatures[last:]
            if len(held[0]):
                yield from pairs(held, held_signatures)

        for found in batched(whole_cells()):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], out)

    lists = written(_shared_entries(entries, percent), "ngram-lists")
    marks = classes.select(F.col("rep").alias("of"), F.col("d1").alias("of_d1"), "signature")
    signed = lists.join(marks, (F.col("rep") == F.col("of")) & (F.col("d1") == F.col("of_d1")))
    # Block i of a list meets every block j, in cell (smaller, larger).
    cells = signed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "shingle",
        F.least("block", "other").cast("long").alias("row"),
        F.greatest("block", "other").cast("long").alias("column"),
        F.col("block").cast("long").alias("block"),
        "rep", "d1", "n", "pos", "comp", "signature",
    )
    cell = ["shingle", "row", "column"]
    dealt = cells.repartition(*cell).sortWithinPartitions(*cell, "n", "d1", "rep")
    return dealt.mapInArrow(walk, ", ".join(f"{c} long" for c in out)).distinct()


def _labelled(docs: DataFrame, words: int, percent: int, join_ids: bool) -> tuple[DataFrame, DataFrame]:
    """All rows with their sketches, and the classes with ``label``, the least digest of their group.

    With ``join_ids`` rows that share a ``doc_id`` are linked.
    """
    ship(docs.sparkSession)
    sketches = written(_sketches(docs, words, percent), "ngram-sketches")
    usable = sketches.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = written(
        usable.groupBy("d1", "d2")
        .agg(F.min(F.struct("doc_id", "n", "bands", "signature", "prefix")).alias("first"))
        .select("d1", "d2", F.col("first.doc_id").alias("rep"), "first.n", "first.bands", "first.signature", "first.prefix"),
        "ngram-classes",
    )
    linked = lambda o: 100 * F.col(o) >= percent * (F.col("nx") + F.col("ny") - F.col(o))

    # Leaders: the smallest class of those with the same smallest hashes.
    marked = classes.select("rep", "d1", F.posexplode("bands").alias("band", "mark"))
    leaders = (
        marked.groupBy("band", "mark")
        .agg(F.min(F.struct("rep", "d1")).alias("leader"), F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > 1)
    )
    pairs = (
        marked.join(leaders, ["band", "mark"])
        .select(
            F.col("rep").alias("x"), F.col("d1").alias("dx"), F.col("leader.rep").alias("y"), F.col("leader.d1").alias("dy")
        )
        .where((F.col("x") != F.col("y")) | (F.col("dx") != F.col("dy")))
        .distinct()
    )
    pairs = written(pairs, "ngram-marked")
    stars = _overlaps(docs, _may_link(classes, pairs, percent), words).where(linked("o"))
    # A class is a node by its digest, as rows of one id may be of several classes.
    links = stars.select(F.col("dx").alias("u"), F.col("dy").alias("v"))
    if join_ids:
        owners = usable.groupBy("doc_id", "d1").agg(F.lit(1).alias("one"))
        several = owners.groupBy("doc_id").agg(F.min("d1").alias("v"), F.count("one").alias("n")).where(F.col("n") > 1)
        links = links.unionByName(owners.join(several, "doc_id").select(F.col("d1").alias("u"), "v"))
    known = written(components(links), "ngram-known")

    entries = (
        classes.join(known, F.col("d1") == F.col("node"), "left")
        .withColumn("comp", F.coalesce("component", "d1"))
        .select("rep", "d1", "n", "comp", F.posexplode("prefix").alias("pos", "shingle"))
        .withColumn("pos", F.col("pos").cast("long"))
    )
    candidates = written(_candidates(entries, classes, percent), "ngram-candidates")

    # A member's answers follow from its leader's: it has x_more shingles its leader has not, and lacks x_less.
    best = stars.groupBy(F.col("x").alias("m"), F.col("dx").alias("dm")).agg(
        F.max_by(
            F.struct("y", "dy", (F.col("nx") - F.col("o")).alias("more"), (F.col("ny") - F.col("o")).alias("less")), "o"
        ).alias("to")
    )
    best = written(best, "ngram-leaders")

    def led(rows: DataFrame, side: str) -> DataFrame:
        mine = best.withColumnRenamed("to", f"{side}_to")
        own = F.struct(
            F.col(side).alias("y"), F.col(f"d{side}").alias("dy"), F.lit(0).cast("long").alias("more"), F.lit(0).cast("long").alias("less")
        )
        joined = rows.join(mine, (F.col(side) == F.col("m")) & (F.col(f"d{side}") == F.col("dm")), "left").drop("m", "dm")
        return joined.withColumn(f"{side}_to", F.coalesce(f"{side}_to", own))

    led_pairs = led(led(candidates, "x"), "y").select(
        "x", "dx", "nx", "y", "dy", "ny",
        F.col("x_to.y").alias("lx"), F.col("x_to.dy").alias("dlx"), F.col("y_to.y").alias("ly"), F.col("y_to.dy").alias("dly"),
        (F.col("x_to.more") + F.col("y_to.more")).alias("more"), (F.col("x_to.less") + F.col("y_to.less")).alias("less"),
    )
    led_pairs = written(led_pairs, "ngram-led")
    between = led_pairs.select(
        F.col("lx").alias("x"), F.col("dlx").alias("dx"), F.col("ly").alias("y"), F.col("dly").alias("dy")
    ).distinct()
    met = _overlaps(docs, between, words).select(
        F.col("x").alias("lx"), F.col("dx").alias("dlx"), F.col("y").alias("ly"), F.col("dy").alias("dly"), F.col("o").alias("led_o")
    )
    bounds = written(
        led_pairs.join(met, ["lx", "dlx", "ly", "dly"])
        .withColumn("at_least", F.col("led_o") - F.col("less"))
        .withColumn("at_most", F.col("led_o") + F.col("more"))
        .where(linked("at_most")),
        "ngram-bounds",
    )
    derived = bounds.where(linked("at_least")).select(F.col("dx").alias("u"), F.col("dy").alias("v"))
    edges = known.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(derived)
    open_pairs = bounds.where(~linked("at_least")).select("x", "dx", "y", "dy")
    if not open_pairs.isEmpty():
        rest = _overlaps(docs, open_pairs.distinct(), words).where(linked("o"))
        edges = edges.unionByName(rest.select(F.col("dx").alias("u"), F.col("dy").alias("v")))
    groups = written(components(edges), "ngram-components")
    labels = classes.select("d1", "d2", "rep").join(groups, F.col("d1") == F.col("node"), "left")
    labels = labels.select("d1", "d2", "rep", F.coalesce("component", "d1").alias("label"))
    return sketches, written(labels, "ngram-labels")


def ngram_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Two documents link if ``100 * intersection >= percent * union``; the component
    is the smallest ``doc_id`` reachable by links.
    """
    sketches, labels = _labelled(docs, words, percent, join_ids=True)
    names = labels.groupBy("label").agg(F.min("rep").alias("name"))
    named = written(labels.join(names, "label").select("d1", "d2", "name"), "ngram-names")
    in_class = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("name")).otherwise(F.col("doc_id"))
    return (
        sketches.select("doc_id", "n", "d1", "d2")
        .join(named, ["d1", "d2"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), in_class.alias("component_id"))
    )


def distinct_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of linked texts: that of the smallest ``doc_id``.

    Rows without a ``doc_id`` stay, and so do rows without words. Of rows equal in
    ``doc_id`` and text one stays. Rows that share a ``doc_id`` but not their text are
    documents of their own: they go only if a text like theirs stays.
    """
    sketches, labels = _labelled(docs, words, percent, join_ids=False)
    rows = sketches.where(F.col("doc_id").isNotNull()).select("doc_id", "text_hash", "n", "d1", "d2")
    # The first class of each group by id, and of its rows with that id the first by hash.
    first = labels.groupBy("label").agg(F.min(F.struct("rep", "d1", "d2")).alias("one")).select("one.*")
    of_first = rows.where(F.col("n") > 0).join(first.withColumnRenamed("rep", "doc_id"), ["doc_id", "d1", "d2"])
    kept = of_first.groupBy("doc_id", "d1", "d2").agg(F.min("text_hash").alias("text_hash"), F.count(F.lit(1)).alias("times"))
    wordless = rows.where(F.col("n") == 0).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    kept = kept.select("doc_id", "text_hash", "times").unionByName(wordless)
    stay = written(
        kept.select(F.col("doc_id").alias("stays"), F.col("text_hash").alias("their_hash"), "times"), "ngram-stay"
    )
    theirs = lambda condition: docs.join(
        stay.where(condition),
        (F.col("doc_id").cast("long") == F.col("stays")) & (F.xxhash64("text") == F.col("their_hash")),
        "left_semi",
    )
    once = theirs(F.col("times") == 1).unionByName(docs.where(F.col("doc_id").isNull()))
    if stay.where(F.col("times") > 1).isEmpty():
        return once
    # Rows equal in id and text: the first by its other columns.
    first_row = F.min(F.struct(F.xxhash64(*docs.columns).alias("order"), F.struct("*").alias("row")))
    repeated = theirs(F.col("times") > 1)
    return once.unionByName(repeated.groupBy("doc_id", "text").agg(first_row.alias("one")).select("one.row.*"))
