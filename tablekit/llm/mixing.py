"""Mixing sources to target weights.

Every row gets a hash-random key. Within a source, rows are sorted by that key in
ranges of the key, the totals of the ranges are summed up over the source, and
each source is cut where the running total of words meets its budget. A budget
above the source's size repeats whole epochs first.

Defined cases: a null text has size 0 and is never taken; a null source is a
source of its own, last in order; sources are compared by code point; repeated
rows are rows of their own; an empty table gives an empty result. Columns of the
input keep their names inside ``row``, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
RANGE_ROWS = 5_000
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Number of words as long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame, seed: str) -> DataFrame:
    """``row``, ``source``, ``size``, ``key`` and ``place``, the key's first 32 bits."""
    key = F.md5(
        F.concat_ws(
            ":",
            F.lit(seed),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.coalesce(F.col("text"), F.lit("")),
        ).cast("binary")
    )
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        key.alias("key"),
    )
    return keyed.withColumn("place", F.conv(F.substring("key", 1, 8), 16, 10).cast("long"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Targets of ``(source, source_size)`` rows, one per source.

    Weights repeat in order of the source. A source is full once its share
    reaches ``cap`` times its size; in order of size per weight the full ones come
    first, so one running total gives the level at which the rest shares.
    """
    everything = Window.partitionBy()
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(by_ratio), F.lit(0))
    known = (
        sources.withColumn("source_no", number)
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * cap)
        .withColumn("ratio", F.col("limit").cast("double") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
    )
    full = known.withColumn(
        "full",
        F.col("ratio")
        <= (F.col("total") - before("limit")).cast("double") / (F.col("weights") - before("weight")),
    )
    left = F.first("total").over(everything) - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything)
    share = F.first("weights").over(everything) - F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(everything)
    level = F.try_divide(left.cast("double"), share.cast("double"))
    return full.withColumn("level", level).select(
        "source",
        "source_no",
        "source_size",
        F.when(F.col("full"), F.col("limit").cast("double"))
        .otherwise(F.col("level") * F.col("weight"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Every row with what the mix takes of it.

    ``row`` holds the input columns; ``size`` its words, ``source_size`` and
    ``target`` those of its source, ``before`` the words of its source that come
    before it in the mix's order, ``epochs`` how often it is taken whole and
    ``cut`` how many of its first words are taken once more; ``taken`` is the sum.
    Only a source's one row at the budget has a ``cut`` between 0 and its size.
    """
    keyed = _keyed(docs, seed)
    sizes = written(keyed.select("source", "size", "place"), "mix-sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = source_targets(totals, weights, cap)
    budget = F.floor("target").cast("long")
    sources = written(
        totals.select("source", "rows")
        .join(targets.withColumnRenamed("source", "target_source"), F.col("source").eqNullSafe(F.col("target_source")))
        .select(
            "source",
            "source_no",
            "source_size",
            "target",
            F.coalesce(F.expr("floor(target) div nullif(source_size, 0)"), F.lit(0)).alias("epochs"),
            F.ceil(F.col("rows") / range_rows).alias("ranges"),
        )
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size")),
        "mix-sources",
    )

    def in_ranges(rows: DataFrame) -> DataFrame:
        theirs = sources.withColumnRenamed("source", "their_source")
        return (
            rows.join(theirs, F.col("source").eqNullSafe(F.col("their_source")))
            .drop("their_source")
            .withColumn("range", F.floor(F.col("place") * F.col("ranges") / F.lit(2**32)).cast("long"))
        )

    so_far = Window.partitionBy("source_no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        in_ranges(sizes)
        .groupBy("source_no", "range")
        .agg(F.sum("size").alias("range_size"))
        .select("source_no", "range", F.coalesce(F.sum("range_size").over(so_far), F.lit(0)).alias("range_before")),
        "mix-ranges",
    )
    within = (
        Window.partitionBy("source_no", "range")
        .orderBy("key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("range_before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return (
        in_ranges(keyed)
        .join(offsets, ["source_no", "range"])
        .withColumn("before", before)
        .withColumn("cut", cut)
        .select(
            "row",
            "size",
            "source_size",
            "target",
            "before",
            "epochs",
            "cut",
            (F.col("epochs") * F.col("size") + F.col("cut")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per time a document is taken.

    The row at a source's budget comes with its first ``cut`` words, white space
    between them kept, and ``n_chars`` (if there) follows its text.
    """
    whole = F.sequence(F.lit(1), F.col("epochs"))
    times = F.when(F.col("epochs") > 0, F.transform(whole, lambda _: F.col("size"))).otherwise(
        F.array().cast("array<bigint>")
    )
    takes = mix(docs, **options).where(F.col("taken") > 0).withColumn(
        "take", F.explode(F.concat(times, F.when(F.col("cut") > 0, F.array("cut")).otherwise(F.array().cast("array<bigint>"))))
    )
    first_words = F.array_join(
        F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(SPACED_WORD), F.lit(0)), F.lit(1), F.col("take").cast("int")), ""
    )
    text = F.when(F.col("take") < F.col("size"), first_words).otherwise(F.col("row.text"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("new_text").alias(name))
        elif name == "n_chars":
            changed = F.length("new_text").cast(docs.schema[name].dataType)
            columns.append(F.when(F.col("take") < F.col("size"), changed).otherwise(F.col("row")[name]).alias(name))
        else:
            columns.append(F.col("row")[name].alias(name))
    return takes.withColumn("new_text", text).select(*columns)
