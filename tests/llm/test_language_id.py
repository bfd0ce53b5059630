"""Language identification against a spelled-out version, and on held-out documents."""

import collections
import math
import re
import zlib

import pytest

from tablekit.llm import language_id
from tablekit.llm.queries import QUERIES

TESTDATA = "/root/testdata"


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def spelled_out(rows, word_share=language_id.WORD_SHARE, gram_share=language_id.GRAM_SHARE):
    """``(lang, score)`` of each ``(doc_id, text, lang)``, with plain counters."""
    find = lambda text: re.findall(r"[^\W\d_]+", (text or "").lower())
    counts = collections.defaultdict(collections.Counter)  # by length (0: words) and language
    for doc_id, text, lang in rows:
        if lang is None or held_out(doc_id):
            continue
        for word in find(text):
            counts[0, lang][word] += 1
            for n in range(1, 6):
                padded = f" {word} " if n > 1 else word
                for i in range(len(padded) - n + 1):
                    counts[n, lang][padded[i : i + n]] += 1
    languages = sorted({lang for (n, lang), c in counts.items() if c})
    known = {}
    for n in range(6):
        limit = gram_share if n else word_share
        total = {x: sum(counts[n, x].values()) for x in languages}
        for term in set().union(*(counts[n, x] for x in languages)):
            shares = [counts[n, x][term] / total[x] if total[x] else 0 for x in languages]
            if max(shares) >= limit:
                known[n, term] = [math.log(max(s, limit / 10)) for s in shares]

    def of_word(word):
        if (0, word) in known:
            return known[0, word]
        for n in range(5, 0, -1):
            padded = f" {word} " if n > 1 else word
            found = [known[n, g] for i in range(len(padded) - n + 1) if (n, g := padded[i : i + n]) in known]
            if found:
                return [sum(x) / len(found) for x in zip(*found, strict=True)]
        return None

    out = []
    for _, text, _ in rows:
        words = find(text)
        scored = [x for x in map(of_word, words) if x]
        if not words or not languages:
            out.append(("und", 0.0))
        elif not scored:
            most = max(languages, key=lambda x: sum(counts[0, x].values()))
            out.append((most, 1 / len(languages)))
        else:
            means = [sum(x) / len(scored) for x in zip(*scored, strict=True)]
            best = max(range(len(means)), key=lambda i: means[i])
            out.append((languages[best], 1 / sum(math.exp(m - means[best]) for m in means)))
    return out


def predicted(docs, **options):
    return language_id.identify_languages(docs, language_id.fit_languages(docs, **options))


def agrees(got, rows, want):
    got = sorted(((r.doc_id, r.lang_pred, round(r.score, 9), r.held_out) for r in got.collect()), key=str)
    want = [(r[0], lang, round(score, 9), held_out(r[0])) for r, (lang, score) in zip(rows, want, strict=True)]
    return got == sorted(want, key=str)


def test_equals_spelled_out(spark):
    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    got = QUERIES["op12_language_id"](spark, f"{TESTDATA}/sf0.001")
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert agrees(got, rows, spelled_out(rows))


def awkward_rows():
    return [
        (1, "the cat and the dog", "en"), (3, "der hund und die katze", "de"), (4, None, "en"), (None, "the end", "en"),
        (5, "", "de"), (6, "123 #", "de"), (7, "unlabelled hunde and cats", None), (8, "日本語", None), (9, "THE Été DOG", None),
        (9, "THE Été DOG", None), (10, "die " * 120_000, "de"), (11, "x" * 100_000 + " und", "de"), (12, "the\tcat\n", "fr"),
    ]


@pytest.mark.parametrize("word_share, gram_share", [(1e-5, 1e-4), (0.05, 0.02)])
def test_awkward_rows(spark, monkeypatch, word_share, gram_share):
    monkeypatch.setattr(language_id, "HELD_WORDS", 60_000)
    rows = awkward_rows()
    docs = spark.createDataFrame(
        [(*r, "term", 1, "n") for r in rows], "doc_id long, text string, lang string, term string, n int, held_out string"
    ).repartition(3)
    options = {"word_share": word_share, "gram_share": gram_share}
    assert agrees(predicted(docs, **options), rows, spelled_out(rows, **options))


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in predicted(docs).collect()] == [("und", 0.0)] * 2
    assert predicted(docs.limit(0)).count() == 0


def test_forgetting_unknown_words_changes_nothing():
    model = language_id.LanguageModel(
        ["a", "b"], [1, 1], ["known"], language_id.np.log([[0.5, 0.1]]), ["x", "y"], language_id.np.log([[0.2, 0.4], [0.3, 0.1]])
    )
    text = " ".join(f"{'xy'[i % 2] * (i % 7 + 1)}q{chr(97 + i % 26)} known" for i in range(3_000))
    whole = language_id.Scorer(model).predict(text)
    before = language_id.HELD_WORDS, language_id.BLOCK_WORDS
    try:
        language_id.HELD_WORDS, language_id.BLOCK_WORDS = 40, 13
        assert language_id.Scorer(model).predict(text) == (whole[0], pytest.approx(whole[1]))
    finally:
        language_id.HELD_WORDS, language_id.BLOCK_WORDS = before


def test_held_out_documents(spark):
    folder = f"{TESTDATA}/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op12_language_id"](spark, folder).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.995 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
