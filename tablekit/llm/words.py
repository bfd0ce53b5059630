"""64-bit hashes of the words of many texts, by array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes handled at once, so memory does not follow the size of a batch or a text.
BLOCK_BYTES = 1 << 20

_numbers = np.random.default_rng(7)
_OF_BYTE = _numbers.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_OF_PLACE = _numbers.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)

#: White space, and everything in ASCII that is no letter or digit.
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
NOT_WORDS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: bytes, gaps: np.ndarray, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data``, and of their beginnings, with where each word begins."""
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(~gaps[raw])
    if not len(at):
        return np.empty(0, np.uint64), at
    first = np.ones(len(at), bool)
    first[1:] = np.diff(at) > 1
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, sizes)
    values = _OF_BYTE[raw[at]] * (_OF_PLACE[place & 4095] + (place >> 12).astype(np.uint64) * np.uint64(2))
    hashes, begins = mixed(np.add.reduceat(values, starts)), at[starts]
    if not prefixes:
        return hashes, begins
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    found, where = [hashes], [begins]
    for length in prefixes:
        long = starts[sizes > length]
        found.append(mixed(total[long + length] - total[long] + np.uint64(length << 56 | length)))
        where.append(at[long])
    hashes, begins = np.concatenate(found), np.concatenate(where)
    order = np.argsort(begins, kind="stable")
    return hashes[order], begins[order]


def _blocks(data: bytes, gaps: np.ndarray) -> Iterator[bytes]:
    """A long text in blocks that end between words."""
    start = 0
    while len(data) - start > 2 * BLOCK_BYTES:
        end = start + BLOCK_BYTES
        while end < len(data) and not gaps[data[end]]:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def word_hashes(
    texts: list[str | None], gaps: np.ndarray = SPACES, prefixes: tuple[int, ...] = ()
) -> Iterator[np.ndarray]:
    """Per text, in order, the hashes of its words with A-Z in lower case.

    With ``prefixes``, a word longer than such a number of bytes also gives the hash
    of so many first bytes, right after its own.
    """
    joined: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, begins = _hashes(b" ".join(joined), gaps, prefixes)
        ends = np.cumsum([len(x) + 1 for x in joined])
        yield from np.split(hashes, np.searchsorted(begins, ends[:-1]))

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if len(data) > 2 * BLOCK_BYTES:
            if joined:
                yield from flush()
                joined, size = [], 0
            yield np.concatenate([_hashes(block, gaps, prefixes)[0] for block in _blocks(data, gaps)])
            continue
        joined.append(data)
        size += len(data)
        if size >= BLOCK_BYTES:
            yield from flush()
            joined, size = [], 0
    if joined:
        yield from flush()
