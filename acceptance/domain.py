"""The test tables seen as flights, baskets, ratings and vehicles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.operators import ratings as R
from tablekit.sources import from_rows, read_table

# The words part names consist of, standing in for genres.
WORDS = (
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
    "new", "old", "plate", "red", "ring", "rod", "small", "widget",
)

# Month names of the made-up release dates.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as baskets of part names."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name")
    return lines.join(parts, on=F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket_id"), F.lower(F.trim("p_name")).alias("item")
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers rating the parts they ordered by the quantity."""
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders")
    return lines.join(orders, on=F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).cast("double").alias("rating"),
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as movies; the words of the name are the genres."""
    months = F.array(*[F.lit(m) for m in MONTHS])
    month = F.get(months, (F.col("p_partkey") % 12).cast("int"))
    year = (F.col("p_partkey") % 7 + 1990).cast("string")
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("movie_name"),
        F.concat(F.lit("01-"), month, F.lit("-"), year).alias("release_date"),
        F.split("p_name", " ").alias("genres"),
    )


def flagged_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with one flag per word, set where the name holds the word."""
    words = F.split("p_name", " ")
    flags = [F.when(F.array_contains(words, w), "1").otherwise("0") for w in WORDS]
    return read_table(spark, folder, "part").select("p_partkey", F.array(*flags).alias("flags"))


def word_lookup(spark: SparkSession) -> DataFrame:
    """Flag position and word."""
    return from_rows(spark, list(enumerate(WORDS)), "genre_id int, genre string")


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with an age from -2 to 77; the market segment is the occupation."""
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        ((F.col("c_custkey") % 80).cast("int") - 2).alias("age"),
        F.col("c_mktsegment").alias("occupation"),
    )


def age_groups(spark: SparkSession, folder: str) -> DataFrame:
    """``(movie_id, age_group)`` of every rating."""
    people = R.with_age_group(users(spark, folder)).select("user_id", "age_group")
    return ratings(spark, folder).join(people, on="user_id").select("movie_id", "age_group")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, NULL where there are none."""
    docs = read_table(spark, folder, "documents").select("doc_id", "lang")
    return docs.join(read_table(spark, folder, "labels"), on="doc_id", how="left")
