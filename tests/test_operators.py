"""Operators on hand-made tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tablekit.operators import aggregate as A
from tablekit.operators import cluster, joins, quality, ranking, sql
from tablekit.operators import ratings as R
from tablekit.operators.recommend import als_fit, too_wide


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def delays(spark):
    data = [("a", -1.0), ("a", 0.0), ("a", 2.0), ("a", None), ("b", -3.0), (None, 4.0)]
    return spark.createDataFrame(data, "carrier string, dep_delay double")


# -------------------------------------------------------------- quality


def test_missing_is_null_only(spark):
    df = spark.createDataFrame(
        [(1.0, "x"), (math.nan, ""), (None, "y"), (2.0, None)], "a double, `b.c` string"
    )
    assert quality.drop_missing(df).count() == 2
    assert quality.missing_rows(df).count() == 2
    assert rows(quality.missing_count(df)) == [(2,)]
    assert quality.drop_missing(df, ["a"]).count() == 3


def test_shape(spark):
    assert rows(quality.shape(spark.range(7).withColumn("x", F.lit(1)))) == [(7, 2)]


def test_numeric_columns_leave_out_other_integers(spark):
    df = spark.createDataFrame(
        [], "a int, b bigint, c smallint, d double, e float, f decimal(5,2), g string, h tinyint"
    )
    assert quality.numeric_columns(df) == ["a", "d", "e", "f"]
    assert quality.select_numeric(df, ["bigint"]).columns == ["b"]


def test_numeric_summary(spark):
    df = spark.createDataFrame([(i, "x") for i in [1, 2, 3, 4, None]], "v int, s string")
    row = quality.numeric_summary(df).first()
    assert (row["column"], row.n, row.mean, row.min, row.p25, row.p50, row.p75, row.max) == (
        "v", 4, 2.5, 1.0, 1.0, 2.0, 3.0, 4.0,
    )
    assert row.stddev == pytest.approx(1.2909944)
    one = quality.numeric_summary(df.limit(1)).first()
    assert (one.n, one.stddev) == (1, None)
    none = quality.numeric_summary(df.filter("v IS NULL")).first()
    assert (none.n, none["mean"], none["min"], none.p50, none["max"]) == (0, None, None, None, None)
    empty = quality.numeric_summary(df.limit(0)).first()
    assert (empty.n, empty["mean"], empty.p50) == (0, None, None)
    with pytest.raises(ValueError, match="numeric"):
        quality.numeric_summary(df.select("s"))


def test_numeric_summary_far_from_zero(spark):
    """Values far from zero with a small spread, in many tasks."""
    df = spark.range(0, 20_000, 1, 16).select((F.col("id") % 1000 / 1000 + 1e9).alias("v"))
    row = quality.numeric_summary(df).first()
    direct = df.agg(F.avg("v"), F.stddev("v"), F.min("v"), F.max("v")).first()
    assert (row.n, row.min, row.max) == (20_000, direct[2], direct[3])
    assert row.mean == pytest.approx(direct[0], rel=1e-15)
    assert row.stddev == pytest.approx(direct[1], rel=1e-6)
    assert [row.p25 - 1e9, row.p50 - 1e9, row.p75 - 1e9] == pytest.approx([0.249, 0.499, 0.749], abs=1e-6)


def test_numeric_summary_is_exact_for_long_tables(spark):
    df = spark.range(0, 500_000, 1, 8).selectExpr("cast(id * 7919 % 500000 AS int) AS v", "double(7) AS same")
    for _ in range(2):
        row, same = quality.numeric_summary(df).orderBy(F.desc("column")).collect()
        assert [row.p25, row.p50, row.p75] == [124_999.0, 249_999.0, 374_999.0]
        assert [same.p25, same.p50, same.p75, same.stddev] == [7.0, 7.0, 7.0, 0.0]
    row = quality.numeric_summary(df.select("v"), rank_error=0.01).first()
    assert [row.p25, row.p50, row.p75] == pytest.approx([125_000, 250_000, 375_000], abs=5_000)


def test_numeric_summary_of_infinite_values_and_nan(spark):
    df = spark.range(0, 8, 1, 4).select(F.when(F.col("id") > 3, float("inf")).otherwise(F.col("id")).alias("v"))
    row = quality.numeric_summary(df).first()
    assert (row["mean"], row.p50, row.p75, row["max"]) == (float("inf"), 3.0, float("inf"), float("inf"))
    nan = quality.numeric_summary(spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double")).first()
    assert nan.p25 == 1.0 and nan.p50 == 2.0 and math.isnan(nan.p75) and math.isnan(nan["max"])


@pytest.mark.parametrize("sorted_values, sketch", [(0, 10), (3, 10), (200, 1_000)])
def test_percentiles_by_narrow_brackets(spark, monkeypatch, sorted_values, sketch):
    """Few values sorted at the end, and a coarse sketch: the search goes on until each rank is found."""
    monkeypatch.setattr(quality, "SORTED_VALUES", sorted_values)
    monkeypatch.setattr(quality, "SKETCH", sketch)
    pick = random.Random(5)
    values = [pick.choice([-1e308, -0.0, 0.0, 1e-300, 5.0, 5.0, 7.0, pick.gauss(0, 1), pick.gauss(1e9, 1), math.inf]) for _ in range(2_999)]
    skewed = [math.exp(pick.gauss(0, 40)) for _ in values]
    rows = [(v, w, 3.0 if i % 3 else float(i), None if i % 7 else v) for i, (v, w) in enumerate(zip(values, skewed, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {r["column"]: [r.p25, r.p50, r.p75] for r in quality.numeric_summary(df).collect()}
    for i, name in enumerate("abcd"):
        known = sorted(r[i] for r in rows if r[i] is not None)
        assert got[name] == [known[math.ceil(q * len(known)) - 1] for q in (0.25, 0.5, 0.75)]


def test_percentiles_shuffle_no_values(spark):
    """Ten times as many different values; sketches, counts and the few values sorted keep their bound."""
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    shuffled = []
    for n in (1_000_000, 10_000_000):
        df = spark.range(0, n, 1, 8).select((F.hash("id") / 7.0).alias("v"))
        before = moved()
        row = quality.numeric_summary(df).first()
        assert row.n == n and row.p25 < row.p50 < row.p75
        shuffled.append(moved() - before)
    assert max(shuffled) < 3 * quality.SORTED_VALUES * 24 + 500_000


# ------------------------------------------------------------ aggregates


def test_conditional_averages(delays):
    assert rows(A.nonneg_avg(delays, "dep_delay")) == [(2.0,)]
    assert A.nonneg_avg(delays, "dep_delay").columns == ["average_positive_dep_delay"]
    assert rows(A.neg_avg(delays, "dep_delay")) == [(-2.0,)]
    assert rows(A.nonneg_avg(delays.filter("dep_delay < 0"), "dep_delay")) == [(None,)]


def test_group_without_a_match_stays_last(delays):
    assert rows(A.nonneg_avg_by(delays, ["carrier"], "dep_delay")) == [
        (None, 4.0), ("a", 1.0), ("b", None),
    ]
    assert rows(A.neg_avg_by(delays, ["carrier"], "dep_delay")) == [
        ("a", -1.0), ("b", -3.0), (None, None),
    ]


def test_count_by_has_a_group_for_null(delays):
    assert rows(A.count_by(delays, ["carrier"])) == [("a", 4), (None, 1), ("b", 1)]


def test_percentage_is_of_all_rows(delays):
    found = rows(A.percentage_by(delays, ["carrier"]))
    assert [r[:2] for r in found] == [("a", 4), (None, 1), ("b", 1)]
    assert [r[2] for r in found] == pytest.approx([400 / 6, 100 / 6, 100 / 6])


def test_filtered_aggregates_have_no_row_without_a_match(spark):
    df = spark.createDataFrame([("UA", "SEA", 60.0), ("UA", "SEA", 90.0)], "c string, o string, t double")
    hit, miss = {"c": "UA", "o": "SEA"}, {"c": "UA", "o": "PDX"}
    assert rows(A.filtered_avg(df, hit, "t")) == [("UA", "SEA", 75.0)]
    assert A.filtered_avg(df, hit, "t").columns == ["c", "o", "average_t (mins)"]
    assert rows(A.filtered_sum_scaled(df, hit, "t")) == [("UA", "SEA", 2.5)]
    assert A.filtered_sum_scaled(df, hit, "t").columns == ["c", "o", "total_t (hours)"]
    assert rows(A.filtered_avg(df, miss, "t")) == []
    assert rows(A.filtered_sum_scaled(df, miss, "t")) == []


def test_distinct_by_name_and_position(delays):
    counted = A.distinct_by(delays, {"carriers": 1, "delays": "dep_delay"})
    assert rows(counted) == [(2, 5)]
    assert rows(A.distinct_by(delays, {"carriers": 1}, rsd=0.05)) == [(2,)]
    with pytest.raises(ValueError, match="outside"):
        A.distinct_by(delays, {"x": 3})


def test_years_count_and_range(spark):
    df = spark.createDataFrame([("1995",), ("1995",), ("",), ("1922",)], "year string")
    assert rows(A.year_counts(df, "year")) == [("1995", 2), ("", 1), ("1922", 1)]
    assert rows(A.year_range(df, "year")) == [("1922", "1995")]


def test_odd_column_names(spark):
    df = spark.createDataFrame(
        [("x", 1.0), ("x", 3.0), ("y", 2.0)], "`a b.{c}` string, `speed (mph)` double"
    )
    group, value = ["a b.{c}"], "speed (mph)"
    expected = [("x", 2.0, 1.0, 3.0), ("y", 2.0, 2.0, 2.0)]
    assert rows(A.numeric_stats(df, group, value)) == expected
    assert rows(sql.numeric_stats_sql(df, group, value)) == expected
    assert rows(A.average_by(df, group, value)) == rows(sql.average_by_sql(df, group, value))
    assert rows(sql.top_n_by_sql(df, group, 1)) == [("x", 2)]
    assert rows(sql.bottom_n_by_sql(df, group, 1)) == [("y", 1)]


# --------------------------------------------------------------- ranking


def test_ties_follow_the_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert rows(ranking.top_n_by(df, ["k"], 2)) == [("c", 2), ("a", 1)]
    assert rows(ranking.bottom_n_by(df, ["k"], 2)) == [("a", 1), ("b", 1)]
    assert rows(df.select(ranking.most_frequent(df, "k"))) == [("c",)] * 4


def test_lowest_takes_null_first_and_highest_last(spark):
    df = spark.createDataFrame(
        [("PDX", 1, 5.0), ("PDX", 2, None), ("PDX", 3, 5.0), ("SEA", 4, 1.0)],
        "origin string, flight int, distance double",
    )
    arguments = ({"origin": "PDX"}, ["flight", "distance"], "distance", 2, ["flight"])
    assert rows(ranking.lowest_n_where(df, *arguments)) == [(2, None), (1, 5.0)]
    assert rows(ranking.highest_n_where(df, *arguments)) == [(1, 5.0), (3, 5.0)]


@pytest.mark.parametrize("n", [3, 1500])
def test_top_n_per_group(spark, n):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
        (F.col("id") * 7919 % 5000).alias("v"),
        "id",
    )
    best = ranking.top_n_per_group(df, ["g"], [F.desc("v"), F.asc("id")], n)
    assert best.columns == df.columns
    groups = {}
    for g, v, i in rows(df):
        groups.setdefault(g, []).append((-v, i))
    expected = {(g, -v, i) for g, vs in groups.items() for v, i in sorted(vs)[:n]}
    assert set(rows(best)) == expected
    assert best.count() == 3 * n


def test_group_total_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "g string, x int")
    assert sorted(rows(ranking.attach_group_total(df, ["g"])), key=lambda r: r[1]) == [
        ("a", 1, 2), ("a", 2, 2), (None, 3, 1), ("b", 4, 1),
    ]


def test_add_index_in_input_order(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"{i}\n" for i in range(1000)))
    indexed = ranking.add_index(spark.read.text(str(path)))
    assert sorted((r.idx, int(r.value)) for r in indexed.collect()) == [(i, i) for i in range(1000)]


@pytest.mark.parametrize("split", ["2k", "10k", "128m"])
def test_add_index_of_files_of_different_sizes(spark, tmp_path, split):
    """Spark reads large pieces first; the index still follows path and line."""
    lines = iter(range(5055))
    for name, size in (("a", 5), ("b", 5000), ("c", 50)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{next(lines)}\n" for _ in range(size)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = ranking.add_index(spark.read.text(str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.idx, int(r.value)) for r in found) == [(i, i) for i in range(5055)]


def test_add_index_after_a_shuffle_is_contiguous(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i}\n" for i in range(500)))
    found = ranking.add_index(spark.read.text(str(tmp_path)).repartition(5)).collect()
    assert sorted(r.idx for r in found) == list(range(500))
    assert sorted(int(r.value) for r in found) == list(range(500))


def test_add_index_spreads_a_tied_value(spark, keep_partitions):
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), "id")
    indexed = ranking.add_index(df, [F.col("k")])
    found = indexed.collect()
    assert sorted(r.idx for r in found) == list(range(4000))
    assert sorted(r.id for r in found) == list(range(4000))
    # Numbered by origin: 8 partitions of 500 ids.
    assert all(r.idx // 500 == r.id // 500 for r in found)
    assert len(indexed.inputFiles()) > 4


# ----------------------------------------------------------------- joins


def test_lookup_join_drops_rows_without_entry(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    lookup = spark.createDataFrame([(1, "one")], "code int, name string")
    assert rows(joins.lookup_join(df, lookup, "k", "code")) == [(1, "a", "one")]


def test_joined_counts_equal_counting_after_the_join(spark):
    left = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x"), (9, "x")], "k int, f string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (2, "p")], "k int, m string")
    direct = left.join(right, "k").groupBy("f", "m").count()
    assert sorted(rows(joins.joined_counts(left, right, ["k"], ["f", "m"]))) == sorted(rows(direct))
    by_key = left.join(right, "k").groupBy("k", "m").count()
    assert sorted(rows(joins.joined_counts(left, right, ["k"], ["k", "m"]))) == sorted(rows(by_key))


def test_top_n_lookup(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    names = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "k int, name string")
    assert rows(ranking.top_n_lookup(df, names, "k", 2)) == [(1, "one", 2), (2, "two", 1)]


# --------------------------------------------------------------- ratings


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame(
        [
            (1, "A", "01-May-1995", ["x", "y"]),
            (2, "B", "01-Jan-1995", ["x", "x"]),
            (3, "C", "01-Jun-1996", []),
            (4, "D", "", ["y"]),
        ],
        "movie_id int, movie_name string, release_date string, genres array<string>",
    )


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(1, 1, 5.0), (2, 1, 3.0), (1, 2, 4.0), (3, 2, 2.0), (3, 4, 1.0), (4, 9, 5.0)]
    return spark.createDataFrame(data, "user_id int, movie_id int, rating double")


@pytest.fixture(scope="module")
def users(spark):
    data = [(1, 6, "artist"), (2, 7, "writer"), (3, -1, "artist")]
    return spark.createDataFrame(data, "user_id int, age int, occupation string")


def test_movie_counts_once_in_each_genre(ratings, movies):
    assert sorted(rows(R.top_n_per_genre(ratings, movies, 1))) == [
        ("x", 1, "A", 2, 4.0), ("y", 1, "A", 2, 4.0),
    ]
    assert R.top_n_per_genre(ratings, movies, 5).count() == 4


def test_movie_filters(movies):
    assert sorted(r.movie_id for r in R.movies_of_top_year(movies).collect()) == [1, 2]
    assert sorted(r.movie_id for r in R.movies_of_months(movies).collect()) == [1, 3]


def test_age_groups_list_unknown_but_do_not_report_it(ratings, users, movies):
    assert sorted(rows(R.top_n_per_age_group(ratings, users, movies, 30))) == [
        ("(6-12]", 1, ["(6-12]", "[0-6]"], 1, "A", 1, 3.0),
        ("[0-6]", 2, ["(6-12]", "[0-6]"], 1, "A", 1, 5.0),
        ("[0-6]", 2, ["Unknown", "[0-6]"], 2, "B", 1, 4.0),
    ]


def test_occupation_and_genre_lists_restrict(ratings, users, movies):
    found = R.top_n_per_occupation_genre(ratings, users, movies, 3, ["artist"], ["y"])
    assert rows(R.in_report_order(found, ["occupation", "genre"])) == [
        ("artist", "y", 1, "A", 1, 5.0), ("artist", "y", 4, "D", 1, 1.0),
    ]
    assert R.top_n_per_occupation_genre(ratings, users, movies, 3, ["pilot"]).count() == 0


def test_union_rows_keeps_duplicates(ratings):
    assert R.union_rows(ratings, [(1, 1, 5.0)]).filter("user_id = 1 AND movie_id = 1").count() == 2


def test_attach_group_list(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "a")], "k int, l string")
    assert sorted(rows(R.attach_group_list(df, "k", "l", "ls"))) == [
        (1, "a", ["a", "b"]), (1, "b", ["a", "b"]), (1, "b", ["a", "b"]), (2, "a", ["a"]),
    ]


# -------------------------------------------------------------- learning


def test_als_keeps_ids_beyond_an_int(spark):
    base = 2**40
    data = [(base + u, f"m{m}", float(1 + (u + m) % 5)) for u in range(12) for m in range(8)]
    ratings = spark.createDataFrame(data, "user_id long, movie_id string, rating double")
    assert too_wide(ratings, ["user_id", "movie_id"]) == ["movie_id", "user_id"]
    fitted = als_fit(ratings, rank=3, iterations=3, blocks=2)
    assert {r.user_id for r in fitted.user_factors().collect()} == {base + u for u in range(12)}
    assert {r.movie_id for r in fitted.item_factors().collect()} == {f"m{m}" for m in range(8)}
    best = fitted.recommend(spark.createDataFrame([(base,)], "user_id long"), 4).collect()
    assert len(best) == 4
    assert {r.user_id for r in best} == {base}
    assert fitted.recommend(n=2).count() == 24
    scores = sorted((r.rating for r in best), reverse=True)
    assert scores[0] > scores[-1]


def test_als_prefers_the_liked_items(spark):
    data = [(u, m, 5.0 if (u + m) % 2 == 0 else 1.0) for u in range(20) for m in range(10)]
    ratings = spark.createDataFrame(data, "user_id int, movie_id int, rating float")
    assert too_wide(ratings, ["user_id", "movie_id"]) == []
    best = als_fit(ratings, rank=4, iterations=8, blocks=2).recommend(
        spark.createDataFrame([(0,)], "user_id int"), 5
    )
    assert {r.movie_id for r in best.collect()} == {0, 2, 4, 6, 8}


def test_kmeans_on_two_obvious_clusters(spark):
    points = spark.createDataFrame([(x,) for x in (0.0, 0.1, 0.2, 9.0, 9.1, 9.2)], "x double")
    start = cluster.spread_centers(points, ["x"], 2)
    assert start == [[0.0], [9.2]]
    centers = cluster.kmeans_fit(points, ["x"], start, 5)
    assert [c[0] for c in centers] == pytest.approx([0.1, 9.1])
    placed = cluster.kmeans_assign(points, ["x"], centers).orderBy("x")
    assert [r.cluster for r in placed.collect()] == [0, 0, 0, 1, 1, 1]


def test_kmeans_vectors_agree_with_the_steps(spark):
    """Library labels on vectors equal those of the fixed steps, up to numbering."""
    data = [(i, [c + i % 7 / 10, c - i % 5 / 10]) for i in range(90) for c in [(i % 3) * 20.0]]
    points = spark.createDataFrame(data, "id int, v array<double>")
    found = {r.id: r.cluster for r in cluster.kmeans_vectors(points, "v", 3).collect()}
    flat = points.select("id", points.v[0].alias("x"), points.v[1].alias("y"))
    start = cluster.spread_centers(flat, ["x", "y"], 3)
    placed = cluster.kmeans_assign(flat, ["x", "y"], cluster.kmeans_fit(flat, ["x", "y"], start, 5))
    steps = {r.id: r.cluster for r in placed.collect()}
    assert len({(found[i], steps[i]) for i in steps}) == 3


def test_kmeans_ties_empty_clusters_and_missing(spark):
    points = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0), (None, 1.0)], "x double, y double")
    centers = [[0.0, 0.0], [2.0, 2.0], [50.0, 50.0]]
    assert cluster.kmeans_fit(points, ["x", "y"], centers, 2) == centers
    middle = spark.createDataFrame([(1.0, 1.0), (None, 1.0)], "x double, y double")
    assert [r.cluster for r in cluster.kmeans_assign(middle, ["x", "y"], centers).collect()] == [0, None]
    assert cluster.spread_centers(points, ["x"], 3) == [[0.0], [1.0], [2.0]]
    with pytest.raises(ValueError, match="two"):
        cluster.spread_centers(points, ["x"], 1)


def test_attach_group_list_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, l string")
    assert sorted(rows(R.attach_group_list(df, "k", "l", "ls")), key=str) == [
        (1, "a", ["a"]), (None, "b", ["b", "c"]), (None, "c", ["b", "c"])
    ]


def test_distinct_by_counts_whole_numbers_as_bits(spark):
    edge = [-(2**63), -(2**63) + 1, -65, -64, -1, 0, 1, 63, 64, 2**63 - 1, None]
    data = [(v, str(v), (v or 0) % 7) for v in edge + edge]
    df = spark.createDataFrame(data, "`a.b` long, s string, small short")
    found = A.distinct_by(df, {"a": "A.b", "s": "s", "n": 3})
    assert rows(found) == [(10, 11, len({r[2] for r in data}))]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_bit_or" in plan
    assert rows(A.distinct_by(df, {"a": "a.b"})) == [(10,)]
    assert rows(A.distinct_by(df.limit(0), {"a": "a.b", "s": "s"})) == [(0, 0)]
    assert found.dtypes == [("a", "bigint"), ("s", "bigint"), ("n", "bigint")]


@pytest.mark.parametrize("n", [1, 63, 64, 65, 200])
def test_group_lists_of_many_labels(spark, n):
    """Bits in one, two and more numbers, first and last of each included."""
    df = spark.range(n * 12).select((F.col("id") % 7).alias("k"), F.format_string("é%03d", F.col("id") % n).alias("l"))
    expected = {}
    for k, label in rows(df):
        expected.setdefault(k, set()).add(label)
    found = R.group_lists(df, "k", "l", "ls")
    assert {r.k: r.ls for r in found.collect()} == {k: sorted(v) for k, v in expected.items()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_bit_or" in plan


def test_group_lists_of_null_unknown_and_too_many_labels(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (2, None), (None, 7), (2, -3)], "k int, l int")
    expected = {1: [], 2: [-3, 5], None: [7]}
    assert {r.k: r.ls for r in R.group_lists(df, "k", "l", "ls").collect()} == expected
    assert {r.k: r.ls for r in R.group_lists(df, "k", "l", "ls", labels=[7, 5, -3, 9]).collect()} == expected
    with pytest.raises(ValueError, match="more than 2"):
        R.group_lists(df, "k", "l", "ls", max_labels=2)
    with pytest.raises(Exception, match="not among the labels: 7"):
        R.group_lists(df, "k", "l", "ls", labels=[5, -3]).collect()
    assert R.group_lists(df.limit(0), "k", "l", "ls").collect() == []


def test_seeded_centers_find_planted_clusters(spark):
    """Eight corners of four dimensions; centres on the diagonal merge some of them."""
    corners = [[0, 0, 0, 0], [0, 0, 9, 9], [0, 9, 0, 9], [0, 9, 9, 0], [9, 0, 0, 9], [9, 0, 9, 0], [9, 9, 0, 0], [9, 9, 9, 9]]
    # The first corner holds more than a third of the points.
    data = [
        [x + (i * (d + 3) % 11) / 20 for d, x in enumerate(corner)]
        for c, corner in enumerate(corners)
        for i in range(300 if c == 0 else 70)
    ]
    names = ["x", "y", "z", "w"]
    points = spark.createDataFrame([*data, [None, 1.0, 1.0, 1.0]], ", ".join(f"{c} double" for c in names))

    def planted(centers):
        moved = cluster.kmeans_fit(points, names, centers, 5)
        return sorted([round((x - 0.25) / 9) * 9 for x in c] for c in moved) == corners

    centers = cluster.seeded_centers(points, names, 8)
    assert planted(centers) and centers == cluster.seeded_centers(points, names, 8)
    assert not planted(cluster.spread_centers(points, names, 8))


def test_seeded_centers_of_few_and_equal_points(spark):
    points = spark.createDataFrame([(1.0,)] * 50 + [(4.0,)] + [(None,)], "x double")
    assert {c[0] for c in cluster.seeded_centers(points, ["x"], 3)} == {1.0, 4.0}
    assert len(cluster.seeded_centers(points, ["x"], 3)) == 3
    with pytest.raises(ValueError, match="no point"):
        cluster.seeded_centers(points.filter("x IS NULL"), ["x"], 2)


def test_add_index_of_parquet_writes_one_row_a_file(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(0, 70_000, 1, 3).write.parquet(path)
    table = spark.read.parquet(path)
    indexed = ranking.add_index(table)
    assert [(r.id, r.idx) for r in indexed.orderBy("idx").collect()] == [(i, i) for i in range(70_000)]
    kept = [f for f in indexed.inputFiles() if f not in table.inputFiles()]
    assert sum(spark.read.parquet(f).count() for f in kept) == 3
    # In the order of the files also after a shuffle; contiguous where rows are missing or repeated.
    assert [r.id for r in ranking.add_index(table.repartition(4)).orderBy("idx").collect()] == list(range(70_000))
    some = ranking.add_index(table.filter("id % 3 != 1")).collect()
    assert [r.id for r in sorted(some, key=lambda r: r.idx)] == [i for i in range(70_000) if i % 3 != 1]
    twice = ranking.add_index(table.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("c")))
    assert sorted(r.idx for r in twice.collect()) == list(range(140_000))


def test_genre_filter_lies_below_the_aggregate(spark, capsys):
    ratings = spark.createDataFrame([(1, 1, 5.0), (2, 2, 3.0)], "user_id int, movie_id int, rating double")
    users = spark.createDataFrame([(1, 30, "x"), (2, 20, "x")], "user_id int, age int, occupation string")
    movies = spark.createDataFrame([(1, "m", ["red"]), (2, "n", ["blue"])], "movie_id int, movie_name string, genres array<string>")
    report = R.top_n_per_occupation_genre(ratings, users, movies, genres=["red"])
    assert [r.movie_id for r in report.collect()] == [1]
    report.explain()
    plan = capsys.readouterr().out
    assert plan.rindex("LeftSemi") > plan.rindex("partial_count")
