"""The lists of the n-gram join: cells, and what is written of pairs that cannot link."""

import random

import pytest

from tablekit.llm import ngram_join
from tests.llm.test_llm_operators import brute_force_components


def _near_texts(groups=12, copies=14, seed=5):
    """Groups of texts that share most words, of which some are linked and some just not."""
    numbers = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{numbers.randrange(4_000)}" for _ in range(numbers.randrange(20, 160))]
        for _ in range(copies):
            own = list(base)
            for _ in range(numbers.randrange(0, 1 + len(own) // 30)):
                own[numbers.randrange(len(own))] = f"x{numbers.randrange(10**6)}"
            out.append(" ".join(own))
    numbers.shuffle(out)
    return [{"doc_id": i, "text": t} for i, t in enumerate(out)]


@pytest.mark.parametrize("cell", [3, 1 << 14])
def test_cells_of_any_size_give_all_links(spark, monkeypatch, cell):
    monkeypatch.setattr(ngram_join, "CELL", cell)
    documents = _near_texts()
    docs = spark.createDataFrame([(d["doc_id"], d["text"]) for d in documents], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs, 4, 85).collect()}
    assert got == brute_force_components(documents, 4, 85)


def _pieced(n, seed=1):
    """Documents pieced together from widely shared passages: alike, but never linked."""
    numbers = random.Random(seed)
    passages = [" ".join(f"p{p}w{i}" for i in range(40)) for p in range(40)]
    return [(i, " ".join(numbers.sample(passages, 8))) for i in range(n)]


def test_pairs_written_do_not_grow_with_the_square(spark, monkeypatch):
    """Before signatures met in the lists, 1,000 and 2,000 such documents gave 26,873 and 119,056 pairs."""
    seen = []
    found = ngram_join._candidates

    def counted(*args):
        out = found(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_candidates", counted)
    for n in (500, 1_000):
        docs = spark.createDataFrame(_pieced(n), "doc_id long, text string")
        assert ngram_join.ngram_components(docs, 5, 80).count() == n
    assert seen[0] <= 500 and seen[1] <= max(2 * seen[0], 1_000)
