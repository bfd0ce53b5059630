"""The acceptance queries: ``QUERIES[name](spark, folder)``.

Averages and quotients are rounded here, not in the operators, so that the last
bits of a floating-point sum do not decide a comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import domain as D
from tablekit import functions as X
from tablekit.functions.labels import MPG_CLASSES
from tablekit.operators import aggregate as A
from tablekit.operators import basket as B
from tablekit.operators import cluster, joins, quality, ranking, recommend, sql
from tablekit.operators import ratings as R
from tablekit.plans.movies import NEW_PROFILES
from tablekit.scratch import new_path
from tablekit.sources import (
    from_rows,
    preview,
    read_csv,
    read_delimited,
    read_table,
    write_partitioned,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RETURNED = {"l_returnflag": "R", "l_linestatus": "F"}
BRAND = {"p_brand": "Brand#2"}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---------------------------------------------------------------- sources


def _round_trip_path(df: DataFrame, name: str, **options: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.options(**options).csv(path)
    return path


@query("read_csv")
def _read_csv(spark, folder):
    part = read_table(spark, folder, "part")
    path = _round_trip_path(part, "csv", header="true")
    return read_csv(spark, path, part.schema)


@query("read_tsv")
def _read_tsv(spark, folder):
    supplier = read_table(spark, folder, "supplier")
    path = _round_trip_path(supplier, "tsv", header="true", sep="\t")
    return read_csv(spark, path, supplier.schema, sep="\t")


@query("read_delimited")
def _read_delimited(spark, folder):
    customer = read_table(spark, folder, "customer")
    path = _round_trip_path(customer, "text", sep="|", quote="")
    return read_delimited(spark, path, customer.schema, sep="|")


@query("cleanse_tokens")
def _cleanse_tokens(spark, folder):
    documents = read_table(spark, folder, "documents")
    baskets = documents.select("doc_id", X.cleanse(F.col("text")).alias("items"))
    return baskets.select(
        "doc_id",
        F.size("items").alias("n_items"),
        F.get("items", F.lit(0)).alias("first_item"),
        F.md5(F.array_join("items", "|")).alias("items_md5"),
    )


# ------------------------------------------------------------------ sinks


def _genre_report(spark, folder):
    return R.top_n_per_genre(D.ratings(spark, folder), D.movies(spark, folder), 3)


@query("write_partitioned")
def _write_partitioned(spark, folder):
    path = new_path(spark, "by-genre")
    best = [F.desc("avg_rating"), F.asc("movie_id")]
    report = _rounded(_genre_report(spark, folder), 6, "avg_rating")
    write_partitioned(report, path, "genre", best, one_file_per_group=True)
    return spark.read.schema(report.schema).parquet(path).select(report.columns)


@query("write_partitioned_rows")
def _write_partitioned_rows(spark, folder):
    path = new_path(spark, "by-priority")
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    best = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    write_partitioned(orders, path, "o_orderpriority", best)
    return spark.read.schema(orders.schema).parquet(path).select(orders.columns)


@query("preview")
def _preview(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders.orderBy("o_orderkey"))


@query("shape")
def _shape(spark, folder):
    return quality.shape(read_table(spark, folder, "part"))


# ---------------------------------------------------------------- columns


@query("column_drop_rename")
def _column_drop_rename(spark, folder):
    part = read_table(spark, folder, "part").withColumnRenamed("p_partkey", "part_id")
    return part.drop("p_name", "p_size", "p_retailprice")


@query("rate_column")
def _rate_column(spark, folder):
    rate = X.rate_per_hour(F.col("l_extendedprice"), F.col("l_quantity"))
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", rate.alias("rate")
    )


@query("token_at")
def _token_at(spark, folder):
    word = X.token_at(F.col("p_name"), " ", 1).alias("first_word")
    return read_table(spark, folder, "part").select("p_partkey", word)


@query("prefix_concat")
def _prefix_concat(spark, folder):
    code = F.concat(F.lit("19"), F.col("p_size").cast("string")).alias("size_code")
    return read_table(spark, folder, "part").select("p_partkey", code)


@query("bin_column")
def _bin_column(spark, folder):
    label = X.bin_label(F.col("p_size"), MPG_CLASSES).alias("size_class")
    return read_table(spark, folder, "part").select("p_partkey", label)


@query("range_label")
def _range_label(spark, folder):
    people = R.with_age_group(D.users(spark, folder))
    return people.select(F.col("user_id").alias("c_custkey"), "age_group")


@query("numeric_columns")
def _numeric_columns(spark, folder):
    return quality.select_numeric(read_table(spark, folder, "part"))


@query("year_of")
def _year_of(spark, folder):
    year = X.year_of(F.col("release_date")).alias("year")
    return D.movies(spark, folder).select("movie_id", year)


@query("decode_flags")
def _decode_flags(spark, folder):
    lookup, parts = D.word_lookup(spark), D.flagged_parts(spark, folder)
    decoded = R.with_decoded_flags(parts, F.col("flags"), len(D.WORDS), lookup)
    return decoded.select("p_partkey", F.array_join("genres", "|").alias("genres"))


# ---------------------------------------------------------------- filters


@query("drop_missing")
def _drop_missing(spark, folder):
    return quality.drop_missing(D.labelled_documents(spark, folder))


@query("missing_rows")
def _missing_rows(spark, folder):
    return quality.missing_rows(D.labelled_documents(spark, folder))


@query("missing_count")
def _missing_count(spark, folder):
    return quality.missing_count(D.labelled_documents(spark, folder))


@query("eq_filter")
def _eq_filter(spark, folder):
    rows = A.where_equal(read_table(spark, folder, "lineitem"), RETURNED)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")


@query("non_empty")
def _non_empty(spark, folder):
    dated = F.when(F.col("movie_id") % 3 != 0, F.col("release_date")).otherwise("")
    movies = D.movies(spark, folder).withColumn("release_date", dated)
    return movies.filter(X.year_of(F.col("release_date")) != "").select("movie_id")


@query("top_year_rows")
def _top_year_rows(spark, folder):
    return R.movies_of_top_year(D.movies(spark, folder)).select("movie_id")


@query("month_in_filter")
def _month_in_filter(spark, folder):
    return R.movies_of_months(D.movies(spark, folder)).select("movie_id")


@query("member_filter")
def _member_filter(spark, folder):
    red = D.movies(spark, folder).filter(X.contains_member(F.col("genres"), "red"))
    return red.select(F.col("movie_id").alias("p_partkey"))


@query("suffix_arity_filter")
def _suffix_arity_filter(spark, folder):
    documents = read_table(spark, folder, "documents")
    return documents.filter(X.field_count(F.col("text"), ".") == 5).select("doc_id")


# ------------------------------------------------------------------ joins


def _lines_and_parts(spark, folder):
    lines = read_table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    lines = lines.select("p_partkey", "l_orderkey", "l_linenumber", "l_returnflag")
    return lines, read_table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")


@query("join_using")
def _join_using(spark, folder):
    lines, parts = _lines_and_parts(spark, folder)
    return joins.join_using(lines.drop("l_returnflag"), parts, ["p_partkey"])


@query("lookup_join")
def _lookup_join(spark, folder):
    supplier = read_table(spark, folder, "supplier")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    found = joins.lookup_join(supplier, nation, "s_nationkey", "n_nationkey")
    return found.select("s_suppkey", "n_name")


@query("top_rated_lookup")
def _top_rated_lookup(spark, folder):
    movies = D.movies(spark, folder).select("movie_id", "movie_name")
    return ranking.top_n_lookup(D.ratings(spark, folder), movies, "movie_id", 10, "n_reviews")


@query("group_total_attach")
def _group_total_attach(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return ranking.attach_group_total(orders, ["o_orderpriority"])


@query("attach_group_list")
def _attach_group_list(spark, folder):
    lists = R.group_lists(D.age_groups(spark, folder), "movie_id", "age_group", "age_groups")
    return lists.select("movie_id", F.array_join("age_groups", "|").alias("age_groups"))


@query("attach_group_list_rows")
def _attach_group_list_rows(spark, folder):
    rows = D.age_groups(spark, folder)
    attached = R.attach_group_list(rows, "movie_id", "age_group", "age_groups")
    return attached.select(
        "movie_id", "age_group", F.array_join("age_groups", "|").alias("age_groups")
    )


# ------------------------------------------------------------- aggregates


@query("count_by")
def _count_by(spark, folder):
    return A.count_by(read_table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("percentage_by")
def _percentage_by(spark, folder):
    shares = A.percentage_by(read_table(spark, folder, "events"), ["event_type"])
    return _rounded(shares, 6, "percentage")


@query("nonneg_avg")
def _nonneg_avg(spark, folder):
    name = "average_positive_acctbal"
    return _rounded(A.nonneg_avg(read_table(spark, folder, "customer"), "c_acctbal", name), 4, name)


@query("neg_avg")
def _neg_avg(spark, folder):
    name = "average_negative_acctbal"
    return _rounded(A.neg_avg(read_table(spark, folder, "customer"), "c_acctbal", name), 4, name)


@query("nonneg_avg_by")
def _nonneg_avg_by(spark, folder):
    name, customer = "average_positive_acctbal", read_table(spark, folder, "customer")
    return _rounded(A.nonneg_avg_by(customer, ["c_mktsegment"], "c_acctbal", name), 4, name)


@query("neg_avg_by")
def _neg_avg_by(spark, folder):
    name, customer = "average_negative_acctbal", read_table(spark, folder, "customer")
    return _rounded(A.neg_avg_by(customer, ["c_nationkey"], "c_acctbal", name), 4, name)


@query("numeric_stats")
def _numeric_stats(spark, folder):
    stats = A.numeric_stats(read_table(spark, folder, "part"), ["p_type"], "p_retailprice")
    return _rounded(stats, 4, "average_p_retailprice")


@query("numeric_stats_sql")
def _numeric_stats_sql(spark, folder):
    stats = sql.numeric_stats_sql(read_table(spark, folder, "part"), ["p_type"], "p_retailprice")
    return _rounded(stats, 4, "average_p_retailprice")


@query("average_by")
def _average_by(spark, folder):
    part = read_table(spark, folder, "part")
    averages = A.average_by(part, ["p_brand", "p_type"], "p_retailprice")
    return _rounded(averages, 4, "avg_p_retailprice")


@query("average_by_sql")
def _average_by_sql(spark, folder):
    part = read_table(spark, folder, "part")
    averages = sql.average_by_sql(part, ["p_brand", "p_type"], "p_retailprice")
    return _rounded(averages, 4, "avg_p_retailprice")


@query("filtered_avg")
def _filtered_avg(spark, folder):
    name, lines = "average_l_quantity", read_table(spark, folder, "lineitem")
    return _rounded(A.filtered_avg(lines, RETURNED, "l_quantity", name), 4, name)


@query("filtered_sum_scaled")
def _filtered_sum_scaled(spark, folder):
    name, lines = "total_l_quantity", read_table(spark, folder, "lineitem")
    return _rounded(A.filtered_sum_scaled(lines, RETURNED, "l_quantity", name=name), 4, name)


@query("numeric_summary")
def _numeric_summary(spark, folder):
    lines = read_table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_discount")
    return _rounded(quality.numeric_summary(lines), 4, "mean", "stddev")


@query("distinct_by")
def _distinct_by(spark, folder):
    counted = {"n_users": "user_id", "n_movies": 2}
    return A.distinct_by(D.ratings(spark, folder), counted)


@query("top_users")
def _top_users(spark, folder):
    ratings = D.ratings(spark, folder)
    return ranking.top_n_by(ratings, [A.column_at(ratings, 1)], 10)


def _years(spark, folder):
    return D.movies(spark, folder).select(X.year_of(F.col("release_date")).alias("year"))


@query("year_counts")
def _year_counts(spark, folder):
    return A.year_counts(_years(spark, folder), "year")


@query("year_range")
def _year_range(spark, folder):
    return A.year_range(_years(spark, folder), "year")


# ---------------------------------------------------------------- ranking


@query("add_index")
def _add_index(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey")
    return ranking.add_index(orders, [F.col("o_orderkey")])


@query("add_index_input_order")
def _add_index_input_order(spark, folder):
    """Lines of text files of very different sizes, whose order is that of the keys."""
    orders = read_table(spark, folder, "orders").select("o_orderkey")
    size = F.lpad(F.floor(F.log2(F.col("o_orderkey") + 2)).cast("string"), 2, "0").alias("size")
    lines = orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("value"), size)
    lines = lines.repartitionByRange(16, "o_orderkey").sortWithinPartitions("size", "o_orderkey")
    path = new_path(spark, "lines")
    lines.drop("o_orderkey").write.partitionBy("size").text(path)
    indexed = ranking.add_index(spark.read.text(path).select("value"))
    return indexed.select(F.col("value").cast("long").alias("o_orderkey"), "idx")


@query("top_n_by")
def _top_n_by(spark, folder):
    return ranking.top_n_by(read_table(spark, folder, "lineitem"), ["l_partkey"], 10)


@query("bottom_n_by")
def _bottom_n_by(spark, folder):
    return ranking.bottom_n_by(read_table(spark, folder, "lineitem"), ["l_partkey"], 10)


@query("top_n_by_sql")
def _top_n_by_sql(spark, folder):
    return sql.top_n_by_sql(read_table(spark, folder, "lineitem"), ["l_partkey"], 10)


@query("bottom_n_by_sql")
def _bottom_n_by_sql(spark, folder):
    return sql.bottom_n_by_sql(read_table(spark, folder, "lineitem"), ["l_partkey"], 10)


@query("join_top_n")
def _join_top_n(spark, folder):
    lines, parts = _lines_and_parts(spark, folder)
    columns = ["l_returnflag", "p_brand", "p_type"]
    return joins.joined_top_n(lines, parts, ["p_partkey"], columns, 20)


@query("bottom_n_joined")
def _bottom_n_joined(spark, folder):
    lines, parts = _lines_and_parts(spark, folder)
    columns = ["l_returnflag", "p_brand", "p_type"]
    return joins.joined_top_n(lines, parts, ["p_partkey"], columns, 20, ascending=True)


def _ranked_parts(pick, spark, folder):
    columns = ["p_partkey", "p_brand", "p_retailprice"]
    part = read_table(spark, folder, "part")
    return pick(part, BRAND, columns, "p_retailprice", 5, ["p_partkey"])


@query("lowest_n_where")
def _lowest_n_where(spark, folder):
    return _ranked_parts(ranking.lowest_n_where, spark, folder)


@query("highest_n_where")
def _highest_n_where(spark, folder):
    return _ranked_parts(ranking.highest_n_where, spark, folder)


# ---------------------------------------------------------------- baskets


@query("largest_basket")
def _largest_basket(spark, folder):
    return B.largest_basket(D.baskets(spark, folder))


@query("largest_basket_items")
def _largest_basket_items(spark, folder):
    return B.largest_basket_items(D.baskets(spark, folder))


@query("distinct_item_count")
def _distinct_item_count(spark, folder):
    return B.distinct_item_count(D.baskets(spark, folder))


@query("item_counts")
def _item_counts(spark, folder):
    return B.item_counts(D.baskets(spark, folder))


@query("top_items_pct")
def _top_items_pct(spark, folder):
    return _rounded(B.top_items_pct(D.baskets(spark, folder), 20), 6, "percentage")


@query("bottom_items_pct")
def _bottom_items_pct(spark, folder):
    return _rounded(B.bottom_items_pct(D.baskets(spark, folder), 20), 6, "percentage")


@query("pair_combinations")
def _pair_combinations(spark, folder):
    return B.pair_combinations(D.baskets(spark, folder))


@query("pair_permutations")
def _pair_permutations(spark, folder):
    return B.pair_permutations(D.baskets(spark, folder))


def _counted_pairs(spark, folder):
    return B.pair_counts(B.pair_combinations(D.baskets(spark, folder)))


@query("pair_baskets")
def _pair_baskets(spark, folder):
    lists = B.pair_baskets(B.pair_combinations(D.baskets(spark, folder)), ids_per_row=1000)
    entry = F.transform(
        "baskets",
        lambda b: F.concat_ws("x", b["basket_id"].cast("string"), b["times"].cast("string")),
    )
    return lists.withColumn("baskets", F.array_join(entry, ","))


@query("pair_counts")
def _pair_counts(spark, folder):
    return _counted_pairs(spark, folder)


@query("pair_counts_ordered")
def _pair_counts_ordered(spark, folder):
    return B.ordered_pair_counts(D.baskets(spark, folder))


@query("pair_support")
def _pair_support(spark, folder):
    return _rounded(B.pair_support(_counted_pairs(spark, folder)), 9, "support")


@query("pair_support_per_basket")
def _pair_support_per_basket(spark, folder):
    baskets = D.baskets(spark, folder)
    n_baskets = A.distinct_by(baskets, {"n": "basket_id"}).scalar()
    counts = B.pair_counts(B.pair_combinations(baskets))
    return _rounded(B.pair_support(counts, n_baskets), 9, "support")


@query("pair_top_support")
def _pair_top_support(spark, folder):
    support = B.pair_support(_counted_pairs(spark, folder))
    return _rounded(B.top_pairs_by_support(support, 20), 9, "support")


@query("pair_bottom_support")
def _pair_bottom_support(spark, folder):
    support = B.pair_support(_counted_pairs(spark, folder))
    return _rounded(B.bottom_pairs_by_support(support, 20), 9, "support")


def _confidence(spark, folder):
    baskets = D.baskets(spark, folder)
    return B.pair_confidence(B.ordered_pair_counts(baskets), B.item_counts(baskets))


@query("pair_confidence")
def _pair_confidence(spark, folder):
    return _rounded(_confidence(spark, folder), 9, "confidence")


@query("pair_top_confidence")
def _pair_top_confidence(spark, folder):
    return _rounded(B.top_pairs_by_confidence(_confidence(spark, folder), 20), 9, "confidence")


@query("pair_bottom_confidence")
def _pair_bottom_confidence(spark, folder):
    return _rounded(B.bottom_pairs_by_confidence(_confidence(spark, folder), 20), 9, "confidence")


# ---------------------------------------------------------------- ratings


@query("union_rows")
def _union_rows(spark, folder):
    return R.union_rows(D.ratings(spark, folder), NEW_PROFILES)


@query("cast_ratings")
def _cast_ratings(spark, folder):
    return R.cast_ratings(D.ratings(spark, folder))


@query("distinct_pairs")
def _distinct_pairs(spark, folder):
    return R.distinct_pairs(D.age_groups(spark, folder), "movie_id", "age_group")


def _names(spark, folder):
    return D.movies(spark, folder).select("movie_id", "movie_name")


@query("review_stats")
def _review_stats(spark, folder):
    stats = R.review_stats(D.ratings(spark, folder), _names(spark, folder))
    return _rounded(stats, 6, "avg_rating")


@query("review_stats_by_occupation")
def _review_stats_by_occupation(spark, folder):
    stats = R.review_stats_by(
        D.ratings(spark, folder), D.users(spark, folder), _names(spark, folder), "occupation"
    )
    return _rounded(stats, 6, "avg_rating")


@query("review_stats_by_age_group")
def _review_stats_by_age_group(spark, folder):
    people = R.with_age_group(D.users(spark, folder))
    stats = R.review_stats_by(
        D.ratings(spark, folder), people, _names(spark, folder), "age_group"
    )
    return _rounded(stats, 6, "avg_rating")


@query("top_n_per_genre")
def _top_n_per_genre(spark, folder):
    return _rounded(_genre_report(spark, folder), 6, "avg_rating")


@query("top_n_per_genre_top_year")
def _top_n_per_genre_top_year(spark, folder):
    movies = R.movies_of_top_year(D.movies(spark, folder))
    return _rounded(R.top_n_per_genre(D.ratings(spark, folder), movies, 3), 6, "avg_rating")


@query("top_n_per_genre_months")
def _top_n_per_genre_months(spark, folder):
    movies = R.movies_of_months(D.movies(spark, folder))
    return _rounded(R.top_n_per_genre(D.ratings(spark, folder), movies, 3), 6, "avg_rating")


@query("top_n_per_age_group")
def _top_n_per_age_group(spark, folder):
    best = R.top_n_per_age_group(
        D.ratings(spark, folder), D.users(spark, folder), D.movies(spark, folder), 30
    )
    best = best.withColumn("age_groups", F.array_join("age_groups", "|"))
    return _rounded(best, 6, "avg_rating")


@query("top_n_per_occupation_genre")
def _top_n_per_occupation_genre(spark, folder):
    best = R.top_n_per_occupation_genre(
        D.ratings(spark, folder), D.users(spark, folder), D.movies(spark, folder), 3
    )
    return _rounded(best, 6, "avg_rating")


@query("top_n_per_occupation_genre_chosen")
def _top_n_per_occupation_genre_chosen(spark, folder):
    best = R.top_n_per_occupation_genre(
        D.ratings(spark, folder),
        D.users(spark, folder),
        D.movies(spark, folder),
        3,
        ["BUILDING"],
        ["red"],
    )
    return _rounded(best, 6, "avg_rating")


# --------------------------------------------------------------- learning


# An id no customer has, so the profile is that of a new user.
NEW_USER = -1


def _recommender(spark, folder):
    profile = [(NEW_USER, movie, rating) for _, movie, rating in NEW_PROFILES]
    return recommend.als_fit(R.union_rows(D.ratings(spark, folder), profile))


@query("als_user_factors")
def _als_user_factors(spark, folder):
    factors = _recommender(spark, folder).user_factors()
    return factors.select(F.col("user_id").cast("long").alias("user_id"), F.size("factors").alias("n_factors"))


@query("als_recommend")
def _als_recommend(spark, folder):
    """What holds for the list of the new user however the model was partitioned."""
    fitted, n = _recommender(spark, folder), 10
    listed = fitted.recommend(from_rows(spark, [(NEW_USER,)], "user_id long"), n)
    own = fitted.user_factors().filter(F.col("user_id") == NEW_USER).select("factors").scalar()
    products = F.zip_with("factors", "own", lambda x, y: x.cast("double") * y)
    score = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    scores = fitted.item_factors().withColumn("own", own).select("movie_id", score.alias("score"))
    rated = D.ratings(spark, folder).select("movie_id").distinct().withColumn("known", F.lit(1))
    least = listed.agg(F.min("rating").cast("double")).scalar()
    better = scores.filter(F.col("score") > least + 1e-3).agg(F.count("*")).scalar()
    found = listed.join(scores, on="movie_id", how="left").join(rated, on="movie_id", how="left")
    return found.groupBy(F.col("user_id").cast("long").alias("user_id")).agg(
        F.count("*").alias("n_items"),
        F.countDistinct("movie_id").alias("n_distinct"),
        F.count("known").alias("n_known"),
        F.coalesce(F.bool_and(F.abs(F.col("score") - F.col("rating")) < 1e-3), F.lit(False)).alias("scores_match"),
        (F.first(better) < n).alias("none_better"),
    )


def _price_centers(part):
    start = cluster.spread_centers(part, ["p_retailprice"], 2)
    return cluster.kmeans_fit(part, ["p_retailprice"], start, 3)


@query("kmeans_centers")
def _kmeans_centers(spark, folder):
    part = read_table(spark, folder, "part")
    rows = [(i, float(x)) for i, (x,) in enumerate(_price_centers(part))]
    centers = from_rows(spark, rows, "cluster int, center double")
    return _rounded(centers, 6, "center")


@query("kmeans_assign")
def _kmeans_assign(spark, folder):
    part = read_table(spark, folder, "part")
    placed = cluster.kmeans_assign(part, ["p_retailprice"], _price_centers(part))
    return placed.select("p_partkey", "cluster")


@query("kmeans_vectors")
def _kmeans_vectors(spark, folder):
    """Every vector, and whether its cluster is the one with the nearest centre."""
    points = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = cluster.kmeans_vector_model(points, "embedding", 8)
    placed = cluster.assign_vectors(points, "embedding", model)

    def distance(center):
        centre = F.array(*[F.lit(float(x)) for x in center])
        gaps = F.zip_with("embedding", centre, lambda x, y: (x - y) * (x - y))
        return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)

    far = F.array(*[distance(c) for c in model.clusterCenters()])
    placed = placed.withColumn("far", far)
    nearest = F.get("far", F.col("cluster")) <= F.array_min("far") + 1e-6
    return placed.select("vec_id", nearest.alias("nearest"))
