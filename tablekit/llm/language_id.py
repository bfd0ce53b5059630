"""Language of documents: words first, then shorter and shorter character n-grams.

Each language has a model of how often its words, and the character n-grams of its
words, occur. A word that some language knows gives every language the log of its share
there. Any other word falls back to its n-grams of the greatest length of which at least
one is known, and gives the mean of their log shares. A text gets the language with the
highest mean over its words.

The counts cover all documents to learn from. A word is known if it makes up at least
``WORD_SHARE`` of a language's words, an n-gram if it makes up at least ``GRAM_SHARE`` of
its n-grams of that length. Shares add up to 1, so a language knows at most
1 / ``WORD_SHARE`` words and 1 / ``GRAM_SHARE`` n-grams of a length however large the corpus.

Words are runs of letters in lower case.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0; so
is every text if nothing was learned; if no part of any word is known, the language
with the most words learned is predicted, with the score of a blind guess; of equal
languages the first by name wins; a null ``doc_id`` is learned from and not held out;
rows without a ``lang`` are not learned from; repeated rows count each; very long texts
and words are read whole; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.shipping import ship
from tablekit.scratch import written

WORD_SHARE = 1e-5
GRAM_SHARE = 1e-4
GRAMS = (5, 4, 3, 2, 1)
#: A share below the limit over this number counts as that.
FLOOR = 10
UNDETERMINED = "und"

letters = re.compile(r"[^\W\d_]+").findall
#: Partial counts held by a task, words scored at once, and scores of unknown words held.
HELD_COUNTS, BLOCK_WORDS, HELD_WORDS = 200_000, 50_000, 150_000


def is_held_out(doc_id: Column) -> Column:
    """Whether this document is kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word between spaces; none of only a space."""
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _counted(keyed: Iterator[tuple[str, list[str], int]]) -> Iterator[pa.RecordBatch]:
    """Counts terms per key, each so many times, and hands counts on before they grow large."""
    held: dict[str, Counter] = defaultdict(Counter)

    def rows():
        kinds = [pa.string(), pa.string(), pa.int64()]
        columns = zip(*((k, t, n) for k, counts in held.items() for t, n in counts.items()), strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["lang", "term", "n"]
        )

    for key, terms, times in keyed:
        counts = held[key]
        for i in range(0, len(terms), HELD_COUNTS):
            if times == 1:
                counts.update(terms[i : i + HELD_COUNTS])
            else:
                for term in terms[i : i + HELD_COUNTS]:
                    counts[term] += times
            if sum(map(len, held.values())) > HELD_COUNTS:
                yield rows()
                held.clear()
                counts = held[key]
    if any(held.values()):
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``term`` and ``n`` of the words of all texts, by their ``lang``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(
            (lang, letters((text.as_py() or "").lower()), 1)
            for batch in batches
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True)
        )

    partial = docs.select("lang", "text").mapInArrow(count, "lang string, term string, n long")
    return partial.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> DataFrame:
    """As :func:`word_counts`, of the n-grams of the counted words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(
            (lang, grams(word, size), n)
            for batch in batches
            for lang, word, n in zip(*(batch.column(k).to_pylist() for k in ("lang", "term", "n")), strict=True)
            for size in GRAMS
        )

    partial = words.mapInArrow(count, "lang string, term string, n long")
    return partial.groupBy("lang", "term").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """Log shares of the known words and n-grams, one column per language."""

    languages: list[str]
    n_words: list[int]
    words: list[str]
    word_logs: np.ndarray
    grams: list[str]
    gram_logs: np.ndarray


def _known(counts: DataFrame, length: Column, share: float) -> tuple[list, DataFrame]:
    """Totals per length and language, and the terms with at least that share of one language."""
    counts = counts.withColumn("length", length)
    totals = counts.groupBy("length", "lang").agg(F.sum("n").alias("total")).collect()  # lengths x languages rows
    total = counts.sparkSession.createDataFrame(
        [(r.length, r.lang, r.total) for r in totals], "length int, lang string, total long"
    )
    shares = counts.join(F.broadcast(total), ["length", "lang"]).withColumn("share", F.col("n") / F.col("total"))
    each = F.collect_list(F.struct("lang", "share"))  # one entry per language
    terms = shares.groupBy("length", "term").agg(each.alias("shares"), F.max("share").alias("most"))
    return totals, terms.where(F.col("most") >= share).select("term", "shares").orderBy("term")


def _logs(terms: pa.Table, languages: list[str], share: float) -> np.ndarray:
    place = {lang: i for i, lang in enumerate(languages)}
    out = np.full((terms.num_rows, len(languages)), share / FLOOR)
    for row, shares in enumerate(terms.column("shares").to_pylist()):
        for one in shares:
            out[row, place[one["lang"]]] = max(one["share"], share / FLOOR)
    return np.log(out)


def fit_languages(docs: DataFrame, word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE) -> LanguageModel:
    """Learns from all rows with a ``lang`` that are not held out."""
    ship(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id")))
    words = written(word_counts(known), "language-words")
    totals, known_words = _known(words, F.lit(0), word_share)
    languages = sorted(r.lang for r in totals)
    of = {r.lang: r.total for r in totals}
    known_grams = _known(written(gram_counts(words), "language-grams"), F.length("term"), gram_share)[1]
    # At most 1 / share words a language, and as many n-grams of a length.
    known_words, known_grams = known_words.toArrow(), known_grams.toArrow()
    return LanguageModel(
        languages,
        [of[x] for x in languages],
        known_words.column("term").to_pylist(),
        _logs(known_words, languages, word_share),
        known_grams.column("term").to_pylist(),
        _logs(known_grams, languages, gram_share),
    )


class _Places(dict):
    """Rows of known words; unknown ones get the next row when first asked for."""

    def __init__(self, words: list[str]):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.known, self.unknown = len(words), []

    def __missing__(self, word: str) -> int:
        self[word] = row = self.known + len(self.unknown)
        self.unknown.append(word)
        return row

    def forget(self) -> None:
        for word in self.unknown:
            del self[word]
        self.unknown = []


class Scorer:
    """Scores texts; what unknown words give is held and forgotten when it grows large."""

    def __init__(self, model: LanguageModel):
        self.model = model
        n, known = len(model.languages), len(model.words)
        # The last column says whether the word counts.
        self.rows = np.zeros((known + HELD_WORDS, n + 1))
        self.rows[:known] = np.hstack([model.word_logs.reshape(known, n), np.ones((known, 1))])
        self.place = _Places(model.words)
        self.gram_place = {gram: i for i, gram in enumerate(model.grams)}

    def _fill(self, words: list[str], rows: np.ndarray) -> None:
        """The rows of unknown words: the mean of their longest n-grams of which one is known."""
        get, found, sizes = self.gram_place.get, [], []
        for word in words:
            before = len(found)
            for n in GRAMS:
                found += [p for p in map(get, grams(word, n)) if p is not None]
                if len(found) > before:
                    break
            sizes.append(len(found) - before)
        rows[:] = 0
        sizes = np.array(sizes)
        some = sizes > 0
        if some.any():
            sums = np.add.reduceat(self.model.gram_logs[found], (np.cumsum(sizes) - sizes)[some])
            rows[some, :-1] = sums / sizes[some, None]
            rows[some, -1] = 1

    def _sum(self, words: list[str]) -> np.ndarray:
        place = self.place
        if len(place.unknown) + len(words) > HELD_WORDS:
            place.forget()
        before = len(place.unknown)
        rows = np.array(list(map(place.__getitem__, words)))
        if new := place.unknown[before:]:
            first = place.known + before
            self._fill(new, self.rows[first : first + len(new)])
        return self.rows[rows].sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """A language and its share of the exponentials of all languages' means."""
        words = letters(text.lower()) if text else []
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        total = sum(self._sum(words[i : i + BLOCK_WORDS]) for i in range(0, len(words), BLOCK_WORDS))
        if not total[-1]:
            best = int(np.argmax(self.model.n_words))
            return self.model.languages[best], 1 / len(self.model.languages)
        means = total[:-1] / total[-1]
        best = int(np.argmax(means))
        return self.model.languages[best], float(1 / np.exp(means - means[best]).sum())


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # see fit_languages
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(text.as_py()) for text in batch.column("text")]
            langs, scores = ([x[k] for x in found] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    found = docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {id_type}, lang_pred string, score double")
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
