"""Tokenizer alignment against token by token comparison."""

import collections
import hashlib

import numpy as np
import pytest

from tablekit.llm import alignment
from tablekit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
AWKWARD = [
    "", None, " ", "  two  blanks  ", "tab\there\n\nnew\r\nlines ", "l'été Öl 日本語 \U0001f600  x　y", "a ▁ b", "fine <0x41> </s> <unk>",
    "<|endoftext|> twice <|endoftext|><|endoftext|>", "x\x00y \x1c z \x85 w", "====== - ------ === aaaaaaaaaaaaaaa  ",
    "we'll 's don't 'S 12345 #*$%&|<>", "▁start", "́ combining é", "one", "one", "word " * 30_000, "nospace" * 20_000,
]


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


def letters_of_bytes():
    """The byte-level alphabet: printable characters stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def compared(texts, tokenizers):
    """Per text ids, groups and links, found by walking along both token lists."""
    a, b = tokenizers
    byte = letters_of_bytes()
    bytes_a = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)}
    out = []
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [bytes_a[i] for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        parts_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            out.append(([], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in parts_a]), np.cumsum([len(x) for x in parts_b])
        both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, i, j, links = [], 0, 0, []
        for end in both:
            first_i, first_j = i, j
            while i < len(ids_a) and ends_a[i] <= end:
                i += 1
            while j < len(ids_b) and ends_b[j] <= end:
                j += 1
            groups.append((ids_a[first_i:i], ids_b[first_j:j]))
            for x in range(first_i, i):
                for y in range(first_j, j):
                    if ends_a[x] - len(parts_a[x]) < ends_b[y] and ends_b[y] - len(parts_b[y]) < ends_a[x]:
                        links.append((ids_a[x], ids_b[y]))
        out.append((ids_a, ids_b, groups, links))
    return out


def digests(found):
    counts = collections.Counter(link for *_, links in found for link in links)
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for ids_a, ids_b, groups, links in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        rows.append((len(ids_a), len(ids_b), len(groups), len(links), n_best, sum(counts[x] for x in links), digest))
    return rows, counts, best


@pytest.mark.parametrize("chunk_chars", [200, alignment.CHUNK_CHARS])
def test_awkward_texts(spark, tokenizers, chunk_chars):
    found = compared(AWKWARD, tokenizers)
    assert sum(1 for x in found if x[0]) == len(AWKWARD) - 4
    rows = [(i if i % 5 else None, text, "n_a", "x") for i, text in enumerate(AWKWARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, chunk string").repartition(3)
    result, pairs = alignment.align_tokenizers(docs, chunk_chars=chunk_chars)
    want, counts, best = digests(found)
    want = [(r[0], *w) for r, w in zip(rows, want, strict=True)]
    assert sorted(map(tuple, result.collect()), key=str) == sorted(want, key=str)
    got = {(r.a_id, r.b_id): (r["count"], r.best) for r in pairs.collect()}
    assert got == {k: (n, n == best[k[1]]) for k, n in counts.items()}


def test_whole_table(spark, tokenizers):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = digests(compared([r.text for r in docs], tokenizers))[0]
    want = [(r.doc_id, *w) for r, w in zip(docs, want, strict=True)]
    got = QUERIES["op13_tokenizer_alignment"](spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_tables_say_what_the_files_say(tokenizers):
    both = alignment.vocabularies("byte_bpe_50k", "piece_bpe_32k")
    byte = letters_of_bytes()
    vocabulary = tokenizers[0].get_vocab(with_added_tokens=False)
    told = {i: bytes(byte[c] for c in t) for t, i in vocabulary.items() if t != "<|endoftext|>"}
    assert all(both.bytes_a[i] == x for i, x in told.items()) and len(told) == len(both.bytes_a)
    for a, b in enumerate(both.same):
        assert b < 0 or both.bytes_a[a] == both.bytes_b[b]


def test_no_token_reaches_over_a_word_s_end():
    """The reason words may be aligned apart: no token holds a space between two words."""
    both = alignment.vocabularies("byte_bpe_50k", "piece_bpe_32k")
    for token in [*both.bytes_a, *both.bytes_b]:
        assert not alignment.BETWEEN_WORDS.search(token.decode(errors="ignore"))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    documents, pairs = alignment.align_tokenizers(none)
    assert documents.count() == 0 and pairs.count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    rows = alignment.align_tokenizers(nothing)[0].collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
