"""Market-basket operators over rows ``(basket_id, item)``.

Repeated items count. With m(b, x) the number of times item x is in basket b,
the unordered pair {x, y} occurs m(b, x) * m(b, y) times in b; the ordered pair
(x, y) likewise, and (x, x) occurs m(b, x) * (m(b, x) - 1) times. These products
are never spelled out as rows: pairs carry them in ``times``. Counts are 64-bit;
a larger one is an error, never a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.aggregate import distinct_by, grouped_counts, with_share
from tablekit.scratch import written

# Items in a block: a cell of a basket's grid pairs one block with one block.
BLOCK_ITEMS = 2000


def explode_baskets(baskets: DataFrame, basket_id: str = "basket_id") -> DataFrame:
    """Rows ``(basket_id, item)`` from one row ``(basket_id, items)`` per basket."""
    return baskets.select(F.col(basket_id).alias("basket_id"), F.explode("items").alias("item"))


def largest_basket(baskets: DataFrame) -> DataFrame:
    """The basket with most items and its size; ties go to the lowest id."""
    sizes = baskets.groupBy("basket_id").agg(F.count("*").alias("n_items"))
    return sizes.orderBy(F.desc("n_items"), "basket_id").limit(1)


def largest_basket_items(baskets: DataFrame) -> DataFrame:
    """The rows of the largest basket, with its size."""
    return baskets.join(largest_basket(baskets), on="basket_id")


def distinct_item_count(baskets: DataFrame) -> DataFrame:
    """One row ``n_items``."""
    return distinct_by(baskets, {"n_items": "item"})


def item_counts(baskets: DataFrame) -> DataFrame:
    """Occurrences per item as ``count``."""
    return grouped_counts(baskets, ["item"])


def item_percentages(baskets: DataFrame) -> DataFrame:
    """``item_counts`` with the percentage of all item occurrences."""
    return with_share(item_counts(baskets), "percentage", 100.0)


def top_items_pct(baskets: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent items with count and percentage of occurrences."""
    return item_percentages(baskets).orderBy(F.desc("count"), "item").limit(n)


def bottom_items_pct(baskets: DataFrame, n: int) -> DataFrame:
    """The ``n`` least frequent items with count and percentage of occurrences."""
    return item_percentages(baskets).orderBy(F.asc("count"), "item").limit(n)


def _counted(baskets: DataFrame) -> DataFrame:
    """``(basket_id, item, m)``; a missing item pairs with nothing.

    Grouping by two columns would keep the partitioning of a join by basket the rows may
    come out of, and with it a large basket in one task. A single grouping value needs
    its own shuffle, so that join may be split and repeated items are counted before they
    move.
    """
    present = F.col("basket_id").isNotNull() & F.col("item").isNotNull()
    entries = baskets.filter(present).groupBy(F.struct("basket_id", "item").alias("entry"))
    return entries.agg(F.count("*").alias("m")).select("entry.basket_id", "entry.item", "m")


def _placed(baskets: DataFrame, block_items: int) -> DataFrame:
    """``(basket_id, item, m, block, blocks)`` of all baskets.

    A basket's items are hashed into as many blocks as its size asks for, one for
    ordinary baskets. The input is read once: both sides of the join take the counted
    items from one shuffle, as both ask for the counts.
    """
    counted = _counted(baskets)
    n_items = F.sum((F.col("m") > 0).cast("int"))
    sizes = counted.groupBy("basket_id").agg(F.ceil(n_items / F.lit(block_items)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    return counted.join(sizes, on="basket_id").withColumn("block", block)


def _table(baskets: DataFrame, block_items: int) -> DataFrame:
    """The placed items, written once for all that is paired."""
    return written(_placed(baskets, block_items), "basket-table")


def _unordered(table: DataFrame) -> DataFrame:
    """``(basket_id, item1 < item2, times)``, each basket spread over a grid of cells.

    Cell (i, j) of a basket's grid, with i <= j, pairs block i with block j; the grid of
    an ordinary basket is one cell. An item goes to every cell of its block, once, and
    the cells are joined with themselves over that one shuffle. No cell holds more than
    about two blocks of items, and every pair counts in exactly one cell.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = table.withColumn("other", other).select(
        "basket_id", "item", "m", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    pairs = cells.alias("x").join(cells.alias("y"), on=["basket_id", "i", "j"])
    once = (F.col("i") == F.col("j")) | (F.col("x.block") != F.col("y.block"))
    return pairs.filter(once & (F.col("x.item") < F.col("y.item"))).select(
        "basket_id",
        F.col("x.item").alias("item1"),
        F.col("y.item").alias("item2"),
        (F.col("x.m") * F.col("y.m")).alias("times"),
    )


def _repeats(table: DataFrame) -> DataFrame:
    """Pairs of an item with itself; they need no join."""
    return table.filter(F.col("m") > 1).select(
        "basket_id",
        F.col("item").alias("item1"),
        F.col("item").alias("item2"),
        (F.col("m") * (F.col("m") - 1)).alias("times"),
    )


def _both_orders(pairs: DataFrame) -> DataFrame:
    others = [c for c in pairs.columns if c not in ("item1", "item2")]
    order = F.array(
        F.struct("item1", "item2"),
        F.struct(F.col("item2").alias("item1"), F.col("item1").alias("item2")),
    )
    return pairs.select(*others, F.inline(order)).select(pairs.columns)


def pair_combinations(baskets: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Unordered pairs ``(basket_id, item1 < item2, times)``; an item never meets itself."""
    return _unordered(_table(baskets, block_items))


def pair_permutations(baskets: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Ordered pairs ``(basket_id, item1, item2, times)``, an item with its repeats included."""
    table = _table(baskets, block_items)
    return _both_orders(_unordered(table)).unionByName(_repeats(table))


def ordered_pair_counts(baskets: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``pair_counts`` of the permutations.

    Only unordered pairs are joined and counted; both orders of a pair have the
    same count.
    """
    table = _table(baskets, block_items)
    return _both_orders(pair_counts(_unordered(table))).unionByName(pair_counts(_repeats(table)))


def pair_baskets(pairs: DataFrame, ids_per_row: int = 100_000) -> DataFrame:
    """The basket ids of every pair, in lists of bounded length.

    One row per pair and id range ``basket_slice = floor(basket_id /
    ids_per_row)``, so a pair found everywhere fills many rows, not one giant
    list. ``baskets`` holds ``(basket_id, times)`` in id order. Ids are integers.
    """
    # Whole-number division: a quotient as double is wrong for ids above 2 ** 53.
    size = int(ids_per_row)
    below = F.expr(f"int(basket_id < 0 and basket_id % {size} <> 0)")
    sliced = pairs.withColumn("basket_slice", F.expr(f"basket_id div {size}") - below)
    return sliced.groupBy("item1", "item2", "basket_slice").agg(
        F.array_sort(F.collect_list(F.struct("basket_id", "times"))).alias("baskets")
    )


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Occurrences of every pair as ``count``."""
    return pairs.groupBy("item1", "item2").agg(F.sum("times").alias("count"))


def pair_support(counts: DataFrame, n_baskets: Column | None = None) -> DataFrame:
    """Pair counts with ``support``: the share of all pair occurrences.

    ``n_baskets`` (a number or scalar subquery) replaces that denominator by the
    number of baskets. The total needs the counts a second time, so they are
    written first: pairing the baskets twice would cost far more.
    """
    if n_baskets is None:
        return with_share(written(counts, "pair-counts"), "support")
    return counts.withColumn("support", F.col("count") * F.lit(1.0) / n_baskets)


def top_pairs_by_support(support: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent pairs."""
    return support.orderBy(F.desc("count"), "item1", "item2").limit(n)


def bottom_pairs_by_support(support: DataFrame, n: int) -> DataFrame:
    """The ``n`` least frequent pairs."""
    return support.orderBy(F.asc("count"), "item1", "item2").limit(n)


def pair_confidence(counts: DataFrame, items: DataFrame) -> DataFrame:
    """``count_xy``, ``count_x`` and their quotient for ordered pair counts.

    ``count_x`` counts occurrences, so the confidence of a pair may exceed 1
    where baskets repeat items.
    """
    antecedent = items.select(F.col("item").alias("item1"), F.col("count").alias("count_x"))
    found = counts.withColumnRenamed("count", "count_xy").join(antecedent, on="item1")
    return found.select(
        "item1",
        "item2",
        "count_xy",
        "count_x",
        (F.col("count_xy") * F.lit(1.0) / F.col("count_x")).alias("confidence"),
    )


def top_pairs_by_confidence(confidence: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pairs by ``count_x``, then ``count_xy``, both descending."""
    return confidence.orderBy(
        F.desc("count_x"), F.desc("count_xy"), "item1", "item2"
    ).limit(n)


def bottom_pairs_by_confidence(confidence: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pairs by ``count_x``, then ``count_xy``, both ascending."""
    return confidence.orderBy("count_x", "count_xy", "item1", "item2").limit(n)
