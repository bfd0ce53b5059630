"""Alignment of two tokenizers over a corpus: which ids cover the same bytes.

Vocabulary A is a byte-level BPE file, B a piece file that puts a space before a text,
so A encodes space + text. Where tokens of both end at the same byte a group ends. No
token of either reaches from a character that is no white space over a space into the
next word, so a text's groups are those of its words, and each distinct word of a chunk
of documents is aligned once.

An array gives for each id of A the id of B with the same bytes. Groups of one such
pair, nearly all in practice, are counted in a vector as long as vocabulary A, one per
task. Only the pairs of the other groups, counted per chunk, are shuffled by pair. The
counts go back to the chunks that hold the pair, where documents add them up.

A chunk is ``CHUNK_CHARS`` characters of whole documents (or one longer document), so
memory follows neither a task's input nor a frequent word.

Defined cases: null and empty texts, and texts whose tokens do not give their bytes
back (such as texts with U+2581), have no tokens, zeros and an empty digest, and count
nowhere; strings of special tokens are ordinary text; a null ``doc_id`` stays null;
repeated rows are aligned and counted each; very long texts are one chunk each; extra
columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.shipping import ship
from tablekit.llm.tokens import BETWEEN_WORDS, check_ranks, encoder
from tablekit.scratch import written

VOCABULARY_A = "byte_bpe_50k"
VOCABULARY_B = "piece_bpe_32k"
CHUNK_CHARS = 16_000_000
#: Words aligned at once.
BLOCK_WORDS = 20_000
#: A pair is one number: A id times 2 ** PAIR_BITS, plus B id.
PAIR_BITS = 20
B_MASK = (1 << PAIR_BITS) - 1


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the array from A to B."""

    def __init__(self, name_a: str, name_b: str):
        import public_tokenizers as public
        import sentencepiece

        self.a = encoder(name_a, specials_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=public.path(f"{name_b}.model"))
        known = self.a.tokens()
        self.bytes_a = [known.get(i, b"") for i in range(max(known) + 1)]
        self.bytes_b = [self._piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Whole pieces come after single bytes and win where both say the same.
        whole = {x: i for i, x in enumerate(self.bytes_b) if not self.b.is_byte(i)}
        place = {x: i for i, x in enumerate(self.bytes_b)} | whole
        self.same = np.array([place.get(x, -1) for x in self.bytes_a], np.int64)
        longest = max(len(self.bytes_a), len(self.bytes_b))
        self.width = len(str(longest)) + 1
        printed = b"".join(str(i).ljust(self.width).encode() for i in range(longest))
        self.digits = np.frombuffer(printed, np.uint8).reshape(longest, self.width)
        self.n_digits = np.array([len(str(i)) for i in range(longest)], np.int64)

    @staticmethod
    def _piece_bytes(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("\u2581", " ").encode()


@cache
def vocabularies(name_a: str, name_b: str) -> Vocabularies:
    """One pair of vocabularies per Python worker."""
    return Vocabularies(name_a, name_b)


@dataclass
class AlignedWords:
    """What each word adds to a text, and its links: ``pairs`` with the words they belong to."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    pairs: np.ndarray
    regular: np.ndarray

    def reordered(self, order: np.ndarray) -> AlignedWords:
        """The same with the words in another order."""
        ends = np.cumsum(self.n_links)
        sizes = self.n_links[order]
        links = np.arange(sizes.sum()) + np.repeat((ends - self.n_links)[order] - (np.cumsum(sizes) - sizes), sizes)
        groups = [self.groups[i] for i in order.tolist()]
        of_words = [x[order] for x in (self.valid, self.n_a, self.n_b, self.n_groups, self.n_links)]
        return AlignedWords(*of_words, groups, self.pairs[links], self.regular[links])


def _encoded(words: list[str], both: Vocabularies) -> tuple[np.ndarray, ...]:
    """Ids of space + word in both vocabularies, their number per word, and which words give their bytes back."""
    raw = [b" " + w.encode() for w in words]
    if all(not w[0].isspace() and not w[-1].isspace() for w in words):
        # Tokens end with each word, so the words are encoded as one text.
        joined = " ".join(words)
        a, b = both.a.ids(" " + joined).astype(np.int64), np.array(both.b.encode(joined, num_threads=1), np.int64)
        whole = b"".join(raw)
        if b"".join(map(both.bytes_a.__getitem__, a.tolist())) == whole == b"".join(
            map(both.bytes_b.__getitem__, b.tolist())
        ):
            ends = np.cumsum([len(x) for x in raw])
            number = lambda size: np.diff(np.searchsorted(np.cumsum(size), ends, "right"), prepend=0)
            return a, b, number(both.size_a[a]), number(both.size_b[b]), np.ones(len(words), bool)
    of_a = [both.a.ids(" " + w).tolist() for w in words]
    of_b = both.b.encode(words, num_threads=1)
    valid = [
        b"".join(map(both.bytes_b.__getitem__, y)) == r == b"".join(map(both.bytes_a.__getitem__, x))
        for r, x, y in zip(raw, of_a, of_b, strict=True)
    ]
    of_a, of_b = ([x if v else [] for x, v in zip(found, valid, strict=True)] for found in (of_a, of_b))
    n_a, n_b = (np.array([len(x) for x in found], np.int64) for found in (of_a, of_b))
    a, b = (np.array([i for x in found for i in x], np.int64) for found in (of_a, of_b))
    return a, b, n_a, n_b, np.array(valid, bool)


def align_words(words: list[str], both: Vocabularies) -> AlignedWords:
    """Aligns space + word for each; links come in the order of the words."""
    n = len(words)
    plain = np.array([not w[0].isspace() and not w[-1].isspace() and "\u2581" not in w for w in words], bool)
    if 0 < plain.sum() < n:
        # The few others apart; a stable order brings all back to their places.
        order = np.argsort(~plain, kind="stable")
        cut = int(plain.sum())
        parts = [align_words([words[i] for i in some], both) for some in (order[:cut], order[cut:])]
        return _joined(parts).reordered(np.argsort(order, kind="stable"))
    a, b, n_a, n_b, valid = _encoded(words, both)
    size_a = both.size_a[a]
    end_a, end_b = np.cumsum(size_a), np.cumsum(both.size_b[b])
    shared = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
    # A token of A overlaps the tokens of B from the first that ends behind its start.
    first = np.searchsorted(end_b, end_a - size_a, "right")
    times = np.searchsorted(end_b, end_a, "left") - first + 1
    link_a = np.repeat(np.arange(len(a)), times)
    link_b = np.arange(len(link_a)) + np.repeat(first - (np.cumsum(times) - times), times)
    single = (np.bincount(group_a, minlength=len(shared)) == 1) & (np.bincount(group_b, minlength=len(shared)) == 1)
    regular = single[group_a[link_a]] & (both.same[a[link_a]] == b[link_b])
    word_a = np.repeat(np.arange(n), n_a)
    last_a = np.append(np.diff(group_a) > 0, True)[: len(a)]
    last_b = np.append(np.diff(group_b) > 0, True)[: len(b)]
    # The printed form: ids of A, then of B, of each group, each id followed by its separator.
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    ids = np.concatenate([a, b])[order]
    marks = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])[order]
    long = both.n_digits[ids]
    letters = both.digits[ids]
    letters[np.arange(len(ids)), long] = marks
    text = letters[np.arange(both.width) <= long[:, None]].tobytes()
    word_of = np.concatenate([word_a, np.repeat(np.arange(n), n_b)])[order]
    ends = np.cumsum(np.bincount(word_of, long + 1, n)).astype(np.int64).tolist()
    return AlignedWords(
        valid,
        n_a,
        n_b,
        np.bincount(word_a[last_a], minlength=n),
        np.bincount(word_a[link_a], minlength=n),
        [text[x:y] for x, y in zip([0, *ends[:-1]], ends, strict=True)] if n else [],
        (a[link_a] << PAIR_BITS) | b[link_b],
        regular,
    )


def _joined(parts: list[AlignedWords]) -> AlignedWords:
    names = ["valid", "n_a", "n_b", "n_groups", "n_links", "pairs", "regular"]
    arrays = {k: np.concatenate([getattr(p, k) for p in parts]) for k in names}
    return AlignedWords(**arrays, groups=[x for p in parts for x in p.groups])


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _packed(values: np.ndarray) -> bytes:
    raw = values.astype("<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), "<i4")


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class _Chunk:
    """Documents of one chunk, as numbers of distinct words."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.docs: list[np.ndarray | None] = []
        self.chars = 0

    def add(self, text: str | None) -> None:
        self.docs.append(None)
        if text:
            self.docs[-1] = np.array(list(map(self.numbers.__getitem__, BETWEEN_WORDS.split(text))), np.int32)
            self.chars += len(text)


#: Rows of the written table: documents, a chunk's links, a task's vector.
DOCUMENT, CHUNK, VECTOR = 0, 1, 2


def _schema(id_type: str) -> str:
    return (
        f"kind int, chunk long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long,"
        " groups_sha256 string, words binary, pairs array<long>, counts array<long>"
    )


def aligned_chunks(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, chunk_chars: int) -> DataFrame:
    """One row per document with its words, one per chunk with their links, one per task with its vector."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(vocabulary_a, vocabulary_b)
        task, made = TaskContext.get().partitionId(), 0
        vector = np.zeros(len(both.same), np.int64)
        ids, chunk, id_kind = [], _Chunk(), None

        def rows(kind, number, doc_ids, **columns):
            n = len(doc_ids)
            kinds = {"groups_sha256": pa.string(), "words": pa.binary()} | dict.fromkeys(
                ["pairs", "counts"], pa.list_(pa.int64())
            )
            names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "words", "pairs", "counts"]
            values = [pa.array(columns.get(k, [None] * n), kinds.get(k, pa.int64())) for k in names]
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.int32()), pa.array([number] * n, pa.int64()), doc_ids, *values],
                ["kind", "chunk", "doc_id", *names],
            )

        def finished(ids, chunk, number):
            words = list(chunk.numbers)
            starts = range(0, len(words), BLOCK_WORDS)
            found = _joined([align_words(words[i : i + BLOCK_WORDS], both) for i in starts] or [align_words([], both)])
            whole = [x is not None and bool(found.valid[x].all()) for x in chunk.docs]
            none = np.empty(0, np.int32)
            docs = [x if ok else none for x, ok in zip(chunk.docs, whole, strict=True)]
            flat = np.concatenate([none, *docs])
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in docs])]).astype(np.int64)
            groups = found.groups
            texts = (b"".join([groups[i] for i in x.tolist()])[:-1] for x in docs)
            digests = [hashlib.sha256(t).hexdigest() if ok else "" for t, ok in zip(texts, whole, strict=True)]
            sums = {k: _sums(getattr(found, k)[flat], bounds) for k in ("n_a", "n_b", "n_groups", "n_links")}
            doc_ids = pa.concat_arrays(ids)
            yield rows(DOCUMENT, number, doc_ids, **sums, groups_sha256=digests, words=[_packed(x) for x in docs])
            times = np.repeat(np.bincount(flat, minlength=len(words)), found.n_links)
            regular = found.regular
            a = found.pairs[regular] >> PAIR_BITS
            vector[:] += np.bincount(a, times[regular], len(vector)).astype(np.int64)
            pairs, place = np.unique(found.pairs[~regular], return_inverse=True)
            counts = np.bincount(place, times[~regular], len(pairs)).astype(np.int64)
            # A link's code: the place of its pair, or below zero the id of A whose B id is known.
            codes = np.empty(len(regular), np.int64)
            codes[regular], codes[~regular] = -1 - a, place
            links = _packed(np.concatenate([[len(words)], found.n_links, codes]))
            none_id = pa.nulls(1, id_kind)
            yield rows(CHUNK, number, none_id, words=[links], pairs=[pairs], counts=[counts])

        for batch in batches:
            texts, id_kind = batch.column("text"), batch.column("doc_id").type
            start = 0
            for at in range(len(texts)):
                chunk.add(texts[at].as_py())
                if chunk.chars >= chunk_chars:
                    ids.append(batch.column("doc_id").slice(start, at + 1 - start))
                    yield from finished(ids, chunk, (task << 24) + made)
                    ids, chunk, start, made = [], _Chunk(), at + 1, made + 1
            ids.append(batch.column("doc_id").slice(start))
        if chunk.docs:
            yield from finished(ids, chunk, (task << 24) + made)
        if vector.any():
            some = np.flatnonzero(vector)
            yield rows(VECTOR, None, pa.nulls(1, id_kind), pairs=[some], counts=[vector[some]])

    return docs.select("doc_id", "text").mapInArrow(align, _schema(id_type))


def pair_counts(chunks: DataFrame, same: np.ndarray) -> DataFrame:
    """``pair``, ``count`` and ``best`` (whether its B id has no higher count) of all linked pairs."""
    counted = lambda kind: (
        chunks.where(F.col("kind") == kind)
        .select(F.explode(F.arrays_zip("pairs", "counts")).alias("one"))
        .select(F.col("one.pairs").alias("pair"), F.col("one.counts").alias("n"))
    )
    spark = chunks.sparkSession
    # One row per id of vocabulary A at most.
    known = spark.createDataFrame([(i, (i << PAIR_BITS) | int(b)) for i, b in enumerate(same) if b >= 0], "id long, same long")
    vector = counted(VECTOR).groupBy("pair").agg(F.sum("n").alias("n"))
    vector = vector.join(F.broadcast(known), F.col("pair") == F.col("id")).select(F.col("same").alias("pair"), "n")
    counts = written(
        counted(CHUNK).unionByName(vector).groupBy("pair").agg(F.sum("n").alias("count")).where("count > 0"),
        "align-counts",
    )
    b_id = F.col("pair").bitwiseAND(B_MASK)
    # One row per id of vocabulary B at most.
    highest = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), b_id == F.col("b_id")).select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )


def align_tokenizers(
    docs: DataFrame,
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
    chunk_chars: int = CHUNK_CHARS,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their groups and links, and the linked pairs with their counts.

    Documents: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``. Pairs: ``a_id``, ``b_id``, ``count``, ``best``.
    """
    ship(docs.sparkSession)
    check_ranks(vocabulary_a)
    same = vocabularies(vocabulary_a, vocabulary_b).same
    chunks = written(aligned_chunks(docs, vocabulary_a, vocabulary_b, chunk_chars), "align-chunks")
    counts = written(pair_counts(chunks, same), "align-pairs")
    # The pairs of the array from A to B, at most one per id of A, go to every task.
    known = docs.sparkSession.createDataFrame(
        [((i << PAIR_BITS) | int(b),) for i, b in enumerate(same) if b >= 0], "pair long"
    )
    regular = counts.join(F.broadcast(known), "pair").toArrow()
    count_of, best_of = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
    ids = regular.column("pair").to_numpy() >> PAIR_BITS
    count_of[ids], best_of[ids] = regular.column("count").to_numpy(), regular.column("best").to_numpy()
    held = (
        chunks.where(F.col("kind") == CHUNK)
        .select("chunk", F.posexplode("pairs").alias("place", "pair"))
        .join(counts, "pair")
        .select(F.col("chunk").alias("in_chunk"), "place", "count", "best")
    )
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def add_up(rows: pa.Table, counts: pa.Table) -> pa.Table:
        """Adds up a chunk's counts per word, then per document."""
        links = next(x for x in rows.filter(pa.compute.equal(rows["kind"], CHUNK)).column("words").to_pylist())
        links = _unpacked(links)
        n, sizes, codes = int(links[0]), links[1 : 1 + links[0]], links[1 + links[0] :]
        size = len(codes) + 1
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        place = counts.column("place").to_numpy()
        count[place], best[place] = counts.column("count").to_numpy(), counts.column("best").to_numpy()
        known = codes < 0
        a, other = np.where(known, -1 - codes, 0), np.where(known, 0, codes)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        word_count = _sums(np.where(known, count_of[a], count[other]), bounds)
        word_best = _sums(np.where(known, best_of[a], best[other]), bounds)
        docs = rows.filter(pa.compute.equal(rows["kind"], DOCUMENT))
        words = [_unpacked(x) for x in docs.column("words").to_pylist()]
        flat = np.concatenate([np.empty(0, np.int32), *words])
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
        if not n:
            word_count = word_best = np.zeros(1, np.int64)
        docs = docs.append_column("n_best", pa.array(_sums(word_best[flat], bounds)))
        return docs.append_column("count_sum", pa.array(_sums(word_count[flat], bounds))).select(names)

    left = chunks.where(F.col("kind") != VECTOR).drop("pairs", "counts")
    documents = (
        left.groupBy("chunk")
        .cogroup(held.groupBy("in_chunk"))
        .applyInArrow(
            add_up,
            f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
            " groups_sha256 string",
        )
    )
    pairs = counts.select(
        F.shiftright("pair", PAIR_BITS).alias("a_id"), F.col("pair").bitwiseAND(B_MASK).alias("b_id"), "count", "best"
    )
    return documents, pairs
