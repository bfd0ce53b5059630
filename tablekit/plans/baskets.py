"""Market-basket report: items, pairs, support and confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.operators import basket
from tablekit.operators.quality import shape
from tablekit.operators.ranking import add_index
from tablekit.scratch import written


def basket_report(lines: DataFrame, n: int = 20) -> dict[str, DataFrame]:
    """All results on cleansed basket lines, one array column ``items`` per basket."""
    baskets = basket.explode_baskets(add_index(lines, name="basket_id"))
    combinations = basket.pair_combinations(baskets)
    permutations = basket.pair_permutations(baskets)
    items = basket.item_counts(baskets)
    support = basket.pair_support(basket.pair_counts(combinations))
    unordered = support.drop("support")
    # One row per item pair, read by all results on rules.
    ordered = written(basket.ordered_pair_counts(baskets), "pair-counts")
    confidence = basket.pair_confidence(ordered, items)
    return {
        "shape": shape(lines),
        "largest_basket": basket.largest_basket_items(baskets),
        "distinct_items": basket.distinct_item_count(baskets),
        "items": items,
        "top_items": basket.top_items_pct(baskets, n),
        "bottom_items": basket.bottom_items_pct(baskets, n),
        "combinations": combinations,
        "baskets_of_pairs": basket.pair_baskets(combinations),
        "pair_counts": unordered.orderBy(F.desc("count"), "item1", "item2"),
        "pair_total": unordered.agg(F.sum("count").alias("pair_total")),
        "support": support,
        "top_pairs": basket.top_pairs_by_support(support, n),
        "bottom_pairs": basket.bottom_pairs_by_support(support, n),
        "permutations": permutations,
        "confidence": confidence,
        "top_rules": basket.top_pairs_by_confidence(confidence, n),
        "bottom_rules": basket.bottom_pairs_by_confidence(confidence, n),
    }
