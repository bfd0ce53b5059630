"""Line dedup across documents.

Lines are exploded and normalised, their keys hashed, and distinct documents
counted per hash. A key found in enough documents keeps its lines only in the
largest ``doc_id`` that holds it; the other documents are put together again from
the lines that stay, by position.

Defined cases: a null text is empty, one empty line; rows that share a ``doc_id``
(null included) count as one document; a null ``doc_id`` is smaller than all
others; repeated rows lose the same lines; very long texts are split whole; extra
columns stay inside ``row``, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.bits import asked_for
from tablekit.scratch import written

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``row`` (the input columns), ``n_lines``, ``n_dropped`` and ``kept`` (the text left)."""
    base = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # Two independent 64-bit hashes make a line's key and a document's text safe to compare.
    lines = (
        base.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .where(F.length("line") >= min_chars)
        .withColumn("key", line_key(F.col("line")))
        .where(F.length("key") >= min_chars)
        .select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    lines = written(lines, "dedup-lines")
    frequent = written(
        lines.groupBy("h1", "h2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "dedup-frequent",
    )
    dropped = written(
        lines.join(frequent, ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("their_id"), F.col("text_hash").alias("their_hash"))
        .agg(F.collect_set("pos").alias("drops")),
        "dedup-drops",
    )
    # array_except hashes its second side, so a document costs time in proportion to its lines.
    left = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("drops"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    hashed = base.withColumn("text_hash", F.xxhash64("text"))
    hashes = dropped.select("their_hash")
    one = F.lit(1).cast("long")
    # Documents that lose nothing stay where they are; only the others meet their positions by a shuffle.
    untouched = asked_for(hashed, "text_hash", hashes, found=False).select(
        "row",
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + one).alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
        F.col("text").alias("kept"),
    )
    touched = (
        asked_for(hashed, "text_hash", hashes)
        .join(
            dropped.hint("merge"),
            F.col("doc_id").eqNullSafe(F.col("their_id")) & (F.col("text_hash") == F.col("their_hash")),
            "left",
        )
        .withColumn("lines", F.split("text", "\n"))
        .withColumn("n_lines", F.size("lines"))
        .select(
            "row",
            F.col("n_lines").cast("long").alias("n_lines"),
            F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
            F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias("kept"),
        )
    )
    return untouched.unionByName(touched)


def deduplicated_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the lines left; rows of which no word is left go.

    Rows without a dropped line stay as they are, null and empty texts included.
    """
    result = dedup_lines(docs, **options)
    changed = F.col("n_dropped") > 0
    columns = []
    for name in docs.columns:
        old = F.col("row")[name]
        if name == "text":
            columns.append(F.when(changed, F.col("kept")).otherwise(old).alias(name))
        elif name == "n_chars":
            columns.append(
                F.when(changed, F.length("kept").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
            )
        else:
            columns.append(old.alias(name))
    return result.where(~changed | (F.btrim("kept", F.lit(SPACE)) != "")).select(*columns)
