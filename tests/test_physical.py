"""What Spark executes: pushdown, shuffles, joins and hot keys."""

from contextlib import contextmanager

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from acceptance.queries import QUERIES
from tablekit.operators import basket, joins, ranking
from tablekit.operators import ratings as R

FOLDER = f"{TESTDATA}/sf0.001"

# The library estimators choose their own plans.
OWN_PLANS = [n for n in QUERIES if not n.startswith(("als_", "kmeans_vectors"))]


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan(df):
    """The final adaptive plan, after running it."""
    df.collect()
    return plan_of(df).split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", OWN_PLANS)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["eq_filter"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "EqualTo(l_linestatus,F)" in plan
    schema = plan[plan.index("ReadSchema") :]
    assert "l_comment" not in schema
    assert "l_extendedprice" not in schema


def test_counting_reads_only_the_group_columns(spark):
    plan = plan_of(QUERIES["count_by"](spark, FOLDER))
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert schema == "ReadSchema: struct<l_returnflag:string,l_linestatus:string>"


@pytest.mark.parametrize("name", ["top_n_by", "join_top_n", "highest_n_where", "pair_top_support"])
def test_top_n_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["top_n_per_genre", "top_n_per_occupation_genre", "top_n_per_age_group"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    plan = executed_plan(QUERIES[name](spark, FOLDER))
    final, partial = plan.index("Final"), plan.index("Partial")
    assert "Exchange hashpartitioning" in plan[final:partial]


def test_group_totals_use_no_window_and_broadcast_by_size(spark):
    plan = executed_plan(QUERIES["group_total_attach"](spark, FOLDER))
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        shuffled = QUERIES["group_total_attach"](spark, FOLDER)
        assert "SortMergeJoin" in executed_plan(shuffled)


def test_share_of_total_counts_once(spark):
    assert "ReusedExchange" in executed_plan(QUERIES["percentage_by"](spark, FOLDER))


def test_baskets_are_read_once(spark):
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    rows = rows.select(F.col("l_orderkey").alias("basket_id"), F.col("l_partkey").alias("item"))
    for threshold in ("-1", "10m"):
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=threshold):
            plan = executed_plan(basket._placed(rows, 2000))
        assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_baskets_are_shuffled_once_for_pairing(spark):
    """All baskets take one path: the table of counted items joined with itself, cell by cell."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        rows = spark.range(4000).select(
            (F.col("id") % 900).alias("basket_id"), (F.col("id") % 7).cast("string").alias("item")
        )
        plan = executed_plan(basket.pair_counts(basket.pair_combinations(rows)))
    assert plan.count("ReusedExchange") == 1
    # one by cell, one by item pair
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 2


def test_both_orders_use_the_same_shuffle(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = executed_plan(QUERIES["pair_counts_ordered"](spark, FOLDER))
    # Both sides of the pairs take one shuffle of the written table; repeats only scan it.
    assert plan.count("ReusedExchange") == 1
    assert plan.count("FileScan parquet") == 2


def hot_ratings(spark):
    """User 1 holds a third of all ratings."""
    return spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).alias("user_id"),
        (F.col("id") % 97).alias("movie_id"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
    )


@contextmanager
def everything_is_large(spark):
    """Thresholds at which a small test table counts as skewed and unfit for broadcast."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    ):
        yield


def hot_movies(spark):
    """Movie 1 holds a third of all rows."""
    return hot_ratings(spark).select(F.col("user_id").alias("movie_id"), "rating").withColumn(
        "label", (F.col("rating") % 3).cast("string")
    )


def test_hot_user_is_split(spark, keep_partitions):
    users = spark.range(0, 600).select(F.col("id").alias("user_id"), F.lit("x").alias("occupation"))
    movies = spark.range(0, 97).select(F.col("id").alias("movie_id"), F.lit("m").alias("movie_name"))
    ratings = hot_ratings(spark)
    expected = ratings.groupBy("movie_id").count().withColumnRenamed("count", "n")
    with everything_is_large(spark):
        stats = R.review_stats_by(ratings, users, movies, "occupation")
        assert "SortMergeJoin(skew=true)" in executed_plan(stats)
        assert stats.join(expected, "movie_id").filter("n = n_reviews").count() == 97


@pytest.mark.parametrize(
    "attach",
    [
        lambda spark, df: ranking.attach_group_total(df, ["movie_id"]),
        lambda spark, df: R.attach_group_list(df, "movie_id", "label", "labels"),
        lambda spark, df: joins.join_using(
            df, spark.range(0, 600).select(F.col("id").alias("movie_id")), ["movie_id"]
        ),
    ],
)
def test_hot_key_of_a_row_join_is_split(spark, keep_partitions, attach):
    with everything_is_large(spark):
        df = attach(spark, hot_movies(spark))
        assert "SortMergeJoin(skew=true)" in executed_plan(df)
        assert df.count() == 60_000


def test_hot_basket_is_split_before_it_is_counted(spark, keep_partitions):
    rows = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20_000 + 2).alias("basket_id"),
        (F.col("id") % 211).cast("string").alias("item"),
    )
    ids = spark.range(1, 2).select(F.col("id").alias("basket_id"))
    with everything_is_large(spark):
        large = rows.join(ids, "basket_id", "left_semi")
        counted = basket._counted(large)
        plan = executed_plan(counted)
        assert "skew=true" in plan
        assert plan.index("SortMergeJoin") > plan.index("partial_count")
        assert counted.agg(F.sum("m")).first()[0] == 20_000


def test_hot_key_shrinks_before_the_join(spark):
    left = hot_ratings(spark).withColumn("flag", F.lit("f"))
    right = spark.range(0, 600).select(F.col("id").alias("user_id"), (F.col("id") % 3).alias("kind"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = joins.joined_counts(left, right, ["user_id"], ["flag", "kind"])
        plan = executed_plan(df)
    assert plan.index("SortMergeJoin") < plan.index("partial_count")
    assert sum(r["count"] for r in df.collect()) == 60_000


def test_reports_do_not_run_a_job_per_group(spark):
    """The number of jobs is the same for 3 and for 300 groups."""
    context = spark.sparkContext

    def jobs(groups):
        name = f"groups-{groups}"
        context.setJobGroup(name, name)
        df = spark.range(0, 30_000, 1, 8).select((F.col("id") % groups).alias("g"), "id")
        ranking.top_n_per_group(df, ["g"], [F.desc("id")], 3).collect()
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(name))

    assert jobs(3) == jobs(300) > 0
