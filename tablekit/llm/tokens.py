"""Token ids of whole texts.

The ids are those of a tokenizers file, called as it is: a special token's string in a
text is that token. With ``specials_as_text`` such strings are ordinary text.

The ids are computed with tiktoken from the same vocabulary's ranks, which takes a
fraction of the time; the driver checks on a probe text that both agree before anything
is planned. Texts that hold a special token's string, and texts with a run of white
space so long that tiktoken's pattern gives up, are encoded with the tokenizers file
itself.

No token goes over a space between two characters that are no white space, so a text's
ids are those of its words (each with the space before it) one after the other. A word
met again is not encoded again: its ids are held until too many words are.

Defined cases: a null or empty text has no ids; very long texts are encoded whole.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import tiktoken

#: Rows turned into Python texts at once, and characters encoded before they are handed on.
ROWS, BLOCK_CHARS = 256, 500_000

#: White-space characters in a row from which on tiktoken is not asked.
LONG_RUN = 200_000
#: Characters of a text split at once, and words and characters held at most (by a block more).
SLICE_CHARS, HELD_WORDS, HELD_CHARS = 1_000_000, 100_000, 5_000_000
#: A space between two characters that are white space for neither tokenizer.
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_long_run = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")

PROBE = (
    "The 1st probe isn't long;\tit has\n\n  runs of   space, <|endoftext|>, l'été, Öl, "
    "日本語 русский \U0001f600 á  x y 12345 #*$%&|<> we'll\r\n "
)


class Encoder:
    """Encodes texts as the tokenizers file does."""

    def __init__(self, ranks: str, pattern: str, file: str, specials_as_text: bool = False):
        self.file, self.specials_as_text = file, specials_as_text
        with open(ranks) as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(str.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        with open(file) as described:
            specials = [x["content"] for x in json.load(described).get("added_tokens") or []]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials and not specials_as_text else None
        self.words: WordIds | None = None

    def tokens(self) -> dict[int, bytes]:
        """The bytes of each id, special tokens left out."""
        return {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.file)
        tokenizer.encode_special_tokens = self.specials_as_text
        return tokenizer

    def apart(self, text: str) -> bool:
        """Whether only the tokenizers file knows this text's ids."""
        special = self.special is not None and self.special.search(text)
        return bool(special) or (len(text) >= LONG_RUN and _long_run.search(text) is not None)

    def ids(self, text: str) -> np.ndarray:
        if self.apart(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields ``(ids, bounds)`` for runs of texts in order; text i has ``ids[bounds[i]:bounds[i + 1]]``."""
        yield from map(self._block, self._blocks(texts))

    def count(self, texts: pa.Array) -> int:
        """The number of ids of all texts."""
        total = 0
        for block in self._blocks(texts):
            apart = [text for text in block if self.apart(text)]
            rows = self.words.rows([text for text in block if not self.apart(text)] if apart else block)
            total += int(self.words.sizes[np.concatenate(rows)].sum()) if rows else 0
            total += sum(len(self.ids(text)) for text in apart)
        return total

    def _blocks(self, texts: pa.Array) -> Iterator[list[str]]:
        block, chars = [], 0
        for start in range(0, len(texts), ROWS):
            for text in texts.slice(start, ROWS).to_pylist():
                block.append(text or "")
                chars += len(block[-1])
                if chars >= BLOCK_CHARS:
                    self._make_room()
                    yield block
                    block, chars = [], 0
        if block:
            self._make_room()
            yield block

    def _make_room(self) -> None:
        if self.words is None or self.words.full():
            self.words = WordIds(self)

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        apart = [self.apart(text) for text in texts]
        ids, sizes = self.words.ids([text for text, alone in zip(texts, apart, strict=True) if not alone])
        if any(apart):
            # The few texts that only the file knows go to their places among the others.
            parts, ends, k, all_sizes = [], np.cumsum(sizes), 0, []
            for text, alone in zip(texts, apart, strict=True):
                parts.append(self.ids(text) if alone else ids[ends[k] - sizes[k] : ends[k]])
                all_sizes.append(len(parts[-1]))
                k += not alone
            ids, sizes = np.concatenate(parts), all_sizes
        return ids.astype(np.uint32), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class WordIds(dict):
    """Numbers of words, by the word or, for a text's first one, the word behind a space; and their ids."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder
        known = encoder.tokens()
        self.token_bytes = np.array([len(known.get(i, b"")) for i in range(max(known) + 1)], np.int64)
        self.chars = 0
        self.flat = np.empty(0, np.uint32)
        self.starts = self.sizes = np.empty(0, np.int64)
        self.odd = np.empty(0, bool)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number

    def full(self) -> bool:
        return len(self) > HELD_WORDS or self.chars > HELD_CHARS

    def _numbers(self, words: list[str], first: bool) -> np.ndarray:
        if first:
            words[0] = " " + words[0]
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the words of each text, all learned."""
        slices, of_text = [], []
        for i, text in enumerate(texts):
            start = 0
            while start < len(text):
                # A slice of a very long text ends where a word does.
                cut = BETWEEN_WORDS.search(text, start + SLICE_CHARS) if len(text) - start > SLICE_CHARS else None
                slices.append((text[start : cut.start()] if cut else text[start:], start == 0))
                of_text.append(i)
                start = cut.end() if cut else len(text)
        numbers = [self._numbers(part.split(" "), first) for part, first in slices]
        self._learn()
        for k, (part, first) in enumerate(slices):
            if self.odd[numbers[k]].any():
                # White space beside a space: only some of the spaces part words.
                numbers[k] = self._numbers(BETWEEN_WORDS.split(part), first)
        self._learn()
        out = [np.empty(0, np.int64)] * len(texts)
        for i, found in zip(of_text, numbers, strict=True):
            out[i] = np.concatenate([out[i], found]) if len(out[i]) else found
        return out

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after the other, and how many each has."""
        of_texts = self.rows(texts)
        rows = np.concatenate([np.empty(0, np.int64), *of_texts])
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[rows] - (ends - sizes), sizes)
        text_ends = np.cumsum([len(x) for x in of_texts], dtype=np.int64)
        return self.flat[at], np.diff(np.concatenate([[0], ends])[text_ends], prepend=0)

    def _learn(self) -> None:
        """Encodes the words met since the last time."""
        base = len(self.starts)
        new = list(islice(self, base, None))
        if not new:
            return
        encode = lambda text: self.encoder.encoding.encode_to_numpy(text, disallowed_special=())
        first = np.array([w[:1] == " " for w in new], bool)
        ends_odd = np.array([not w or w[-1].isspace() for w in new], bool)
        odd = ends_odd | np.array([w[:1].isspace() for w in new], bool) & ~first
        together = ~first & ~odd
        words = [w for w, plain in zip(new, together.tolist(), strict=True) if plain]
        sizes, starts = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        parts, at = [self.flat], len(self.flat)
        if words:
            # Tokens end with each word, so all of them are encoded as one text.
            joined = " ".join(words)
            ids = encode(" " + joined)
            lengths = map(len, words) if joined.isascii() else (len(w.encode()) for w in words)
            word_ends = np.cumsum(np.fromiter(lengths, np.int64, len(words)) + 1)
            ends = np.searchsorted(np.cumsum(self.token_bytes[ids]), word_ends, "right")
            sizes[together] = np.diff(ends, prepend=0)
            starts[together] = at + ends - sizes[together]
            parts.append(ids)
            at += len(ids)
        for i in np.flatnonzero(~together).tolist():
            ids = encode(new[i][1:] if first[i] else " " + new[i])
            starts[i], sizes[i] = at, len(ids)
            parts.append(ids)
            at += len(ids)
        self.chars += sum(map(len, new))
        self.flat = np.concatenate(parts)
        self.starts, self.sizes = np.append(self.starts, starts), np.append(self.sizes, sizes)
        self.odd = np.append(self.odd, odd)


def _new_encoder(name: str, specials_as_text: bool) -> Encoder:
    import public_tokenizers as public

    return Encoder(public.path(f"{name}.tiktoken"), public.PATTERN, public.path(f"{name}.json"), specials_as_text)


@cache
def encoder(name: str, specials_as_text: bool = False) -> Encoder:
    """One encoder per Python worker and public vocabulary; ``name`` is that of its files without ending."""
    return _new_encoder(name, specials_as_text)


@cache
def check_ranks(name: str) -> None:
    """Fails if the ranks give other ids than the tokenizers file of the same name."""
    probed = _new_encoder(name, True)
    want = probed.tokenizer.encode(PROBE, add_special_tokens=False).ids
    if want != probed.encoding.encode_ordinary(PROBE):
        raise ValueError("the ranks do not belong to the vocabulary")
