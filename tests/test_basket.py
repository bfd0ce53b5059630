"""Market-basket operators, compared with spelled-out pairs."""

from collections import Counter
from itertools import combinations, permutations
from random import Random

import pytest
from pyspark.sql import functions as F

from tablekit.operators import basket as B


def table(spark, baskets):
    data = [(b, item) for b, items in baskets.items() for item in items]
    return spark.createDataFrame(data, "basket_id long, item string")


def spelled_combinations(baskets):
    return Counter(
        (b, *sorted(pair))
        for b, items in baskets.items()
        for pair in combinations(items, 2)
        if pair[0] != pair[1]
    )


def spelled_permutations(baskets):
    return Counter((b, *pair) for b, items in baskets.items() for pair in permutations(items, 2))


def counted(pairs):
    rows = pairs.collect()
    found = {(r.basket_id, r.item1, r.item2): r.times for r in rows}
    assert len(found) == len(rows)
    return found


def test_repeated_item(spark):
    baskets = table(spark, {1: ["a", "b", "a"]})
    assert counted(B.pair_combinations(baskets)) == {(1, "a", "b"): 2}
    ordered = B.pair_permutations(baskets)
    assert counted(ordered) == {(1, "a", "b"): 2, (1, "b", "a"): 2, (1, "a", "a"): 2}
    rules = B.pair_confidence(B.pair_counts(ordered), B.item_counts(baskets))
    assert {(r.item1, r.item2): r.confidence for r in rules.collect()} == {
        ("a", "b"): 1.0, ("b", "a"): 2.0, ("a", "a"): 1.0,
    }


@pytest.fixture(scope="module")
def random_baskets():
    random = Random(7)
    small = {b: [f"i{random.randrange(12)}" for _ in range(random.randrange(9))] for b in range(60)}
    hot = {100: [f"i{random.randrange(40)}" for _ in range(300)], 101: ["i1"] * 50}
    return {b: items for b, items in {**small, **hot}.items() if items}


@pytest.mark.parametrize("block_items", [2000, 7, 1])
def test_pairs_do_not_depend_on_the_blocks(spark, random_baskets, block_items):
    baskets = table(spark, random_baskets)
    assert counted(B.pair_combinations(baskets, block_items)) == spelled_combinations(random_baskets)
    assert counted(B.pair_permutations(baskets, block_items)) == spelled_permutations(random_baskets)


@pytest.mark.parametrize("block_items", [2000, 7])
def test_ordered_counts(spark, random_baskets, block_items):
    baskets = table(spark, random_baskets)
    found = {
        (r.item1, r.item2): r["count"]
        for r in B.ordered_pair_counts(baskets, block_items).collect()
    }
    expected = Counter()
    for (_, item1, item2), times in spelled_permutations(random_baskets).items():
        expected[item1, item2] += times
    assert found == expected


def test_lists_of_a_pair_are_cut_by_id_range(spark):
    baskets = table(spark, {b: ["x", "y"] for b in (1, 2, 11, 25)} | {3: ["x", "y", "y"]})
    lists = B.pair_baskets(B.pair_combinations(baskets), ids_per_row=10).orderBy("basket_slice")
    assert [(r.basket_slice, [tuple(b) for b in r.baskets]) for r in lists.collect()] == [
        (0, [(1, 1), (2, 1), (3, 2)]),
        (1, [(11, 1)]),
        (2, [(25, 1)]),
    ]


def test_support_denominators(spark):
    baskets = table(spark, {1: ["a", "b", "c"], 2: ["a", "b"]})
    counts = B.pair_counts(B.pair_combinations(baskets))
    by_pairs = {(r.item1, r.item2): r.support for r in B.pair_support(counts).collect()}
    assert by_pairs == {("a", "b"): 0.5, ("a", "c"): 0.25, ("b", "c"): 0.25}
    by_baskets = B.pair_support(counts, F.lit(2)).collect()
    assert {(r.item1, r.item2): r.support for r in by_baskets}[("a", "b")] == 1.0


def test_rules_are_ranked_by_counts_not_confidence(spark):
    baskets = table(spark, {1: ["a", "b"], 2: ["a", "c"], 3: ["d", "e"]})
    rules = B.pair_confidence(B.pair_counts(B.pair_permutations(baskets)), B.item_counts(baskets))
    top = B.top_pairs_by_confidence(rules, 1).first()
    assert (top.item1, top.item2, top.count_x, top.confidence) == ("a", "b", 2, 0.5)
    assert B.bottom_pairs_by_confidence(rules, 1).first().item1 == "b"


def test_item_percentages_are_of_occurrences(spark):
    baskets = table(spark, {1: ["a", "a", "b"], 2: ["a"]})
    assert [tuple(r) for r in B.top_items_pct(baskets, 1).collect()] == [("a", 3, 75.0)]
    assert [tuple(r) for r in B.bottom_items_pct(baskets, 1).collect()] == [("b", 1, 25.0)]


def test_largest_basket(spark):
    baskets = table(spark, {4: ["a", "a", "b"], 2: ["a", "b", "c"], 9: ["z"]})
    assert tuple(B.largest_basket(baskets).first()) == (2, 3)
    assert sorted(r.item for r in B.largest_basket_items(baskets).collect()) == ["a", "b", "c"]


def test_no_baskets(spark):
    assert B.pair_combinations(table(spark, {1: ["a"]}).limit(0)).count() == 0


def test_pair_baskets_slices_large_and_negative_ids(spark):
    ids = [1152921504606999999, -1, -100_000, 99_999]
    pairs = spark.createDataFrame([(i, "a", "b", 1) for i in ids], "basket_id long, item1 string, item2 string, times long")
    got = {b.basket_id: r.basket_slice for r in B.pair_baskets(pairs).collect() for b in r.baskets}
    assert got == {i: i // 100_000 for i in ids}
