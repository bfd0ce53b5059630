"""SQL for the acceptance queries, run on the same tables by another engine."""

from __future__ import annotations

BASKETS = """
WITH b AS (
  SELECT l_orderkey AS basket_id, l_linenumber, l_suppkey, l_extendedprice,
         lower(trim(p_name)) AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
"""

_POSITIONS = (
    BASKETS
    + """
, r AS (
  SELECT basket_id, item,
         ROW_NUMBER() OVER (
           PARTITION BY basket_id ORDER BY l_linenumber, item, l_suppkey, l_extendedprice
         ) AS pos
  FROM b
)
"""
)

COMBINATIONS = (
    _POSITIONS
    + """
, c AS (
  SELECT x.basket_id, x.item AS item1, y.item AS item2
  FROM r x JOIN r y ON x.basket_id = y.basket_id AND x.item < y.item
), n AS (SELECT item1, item2, CAST(COUNT(*) AS BIGINT) AS count FROM c GROUP BY 1, 2)
"""
)

PERMUTATIONS = (
    _POSITIONS
    + """
, c AS (
  SELECT x.basket_id, x.item AS item1, y.item AS item2
  FROM r x JOIN r y ON x.basket_id = y.basket_id AND x.pos <> y.pos
)
, xy AS (SELECT item1, item2, COUNT(*) AS count_xy FROM c GROUP BY 1, 2)
, fx AS (SELECT item, COUNT(*) AS count_x FROM b GROUP BY 1)
, k AS (
  SELECT item1, item2, count_xy, count_x, ROUND(count_xy * 1.0e0 / count_x, 9) AS confidence
  FROM xy JOIN fx ON item1 = item
)
"""
)

RATINGS = """
WITH rt AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id,
         CAST(1 + CAST(l_quantity AS INT) % 5 AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), mv AS (
  SELECT p_partkey AS movie_id, p_name AS movie_name,
         concat('01-', substr('JanFebMarAprMayJunJulAugSepOctNovDec',
                              CAST(p_partkey % 12 AS INT) * 3 + 1, 3),
                '-', CAST(1990 + p_partkey % 7 AS VARCHAR)) AS release_date
  FROM part
), mg AS (
  SELECT DISTINCT movie_id, movie_name, unnest(string_split(movie_name, ' ')) AS genre FROM mv
), u AS (
  SELECT user_id, occupation,
         CASE WHEN age BETWEEN 0 AND 6 THEN '[0-6]' WHEN age BETWEEN 7 AND 12 THEN '(6-12]'
              WHEN age BETWEEN 13 AND 18 THEN '(12-18]' WHEN age BETWEEN 19 AND 30 THEN '(18-30]'
              WHEN age BETWEEN 31 AND 50 THEN '(30-50]' WHEN age >= 51 THEN '50+'
              ELSE 'Unknown' END AS age_group
  FROM (SELECT c_custkey AS user_id, c_mktsegment AS occupation,
               CAST(c_custkey % 80 AS INT) - 2 AS age FROM customer) t
)
"""

_TOP_YEAR = """
SELECT movie_id FROM mv WHERE right(release_date, 4) = (
  SELECT y FROM (
    SELECT right(release_date, 4) AS y, COUNT(*) AS n FROM mv GROUP BY 1
    ORDER BY n DESC, y LIMIT 1) q)
"""

_SUMMER = """
SELECT movie_id FROM mv
WHERE lower(substr(release_date, 4, length(release_date) - 8)) IN ('may', 'jun', 'jul')
"""


def _per_genre(where: str = "TRUE") -> str:
    return f"""{RATINGS}
, s AS (
  SELECT genre, mg.movie_id, movie_name, COUNT(*) AS n_reviews, AVG(rating) AS a
  FROM rt JOIN mg ON rt.movie_id = mg.movie_id WHERE {where} GROUP BY 1, 2, 3
), k AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY genre ORDER BY n_reviews DESC, movie_id) AS rn FROM s
)
SELECT genre, movie_id, movie_name, n_reviews, ROUND(a, 6) AS avg_rating FROM k WHERE rn <= 3
"""


def _per_occupation_genre(where: str = "TRUE") -> str:
    return f"""{RATINGS}
, s AS (
  SELECT occupation, genre, mg.movie_id, movie_name, COUNT(*) AS n_reviews, AVG(rating) AS a
  FROM rt JOIN u ON rt.user_id = u.user_id JOIN mg ON rt.movie_id = mg.movie_id
  WHERE {where} GROUP BY 1, 2, 3, 4
), k AS (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY occupation, genre ORDER BY n_reviews DESC, movie_id) AS rn FROM s
)
SELECT occupation, genre, movie_id, movie_name, n_reviews, ROUND(a, 6) AS avg_rating
FROM k WHERE rn <= 3
"""


def _reviews_by(attribute: str) -> str:
    return f"""{RATINGS}
SELECT {attribute}, rt.movie_id, movie_name, COUNT(*) AS n_reviews,
       ROUND(AVG(rating), 6) AS avg_rating
FROM rt JOIN mv ON rt.movie_id = mv.movie_id JOIN u ON rt.user_id = u.user_id
GROUP BY 1, 2, 3
"""


def _items_pct(direction: str) -> str:
    return f"""{BASKETS}
SELECT item, COUNT(*) AS count,
       ROUND(COUNT(*) * 100.0e0 / (SELECT COUNT(*) FROM b), 6) AS percentage
FROM b GROUP BY item ORDER BY count {direction}, item LIMIT 20
"""


def _support(tail: str = "", denominator: str = "(SELECT SUM(count) FROM n)") -> str:
    return f"""{COMBINATIONS}
SELECT item1, item2, count, ROUND(count * 1.0e0 / {denominator}, 9) AS support FROM n {tail}
"""


def _n_parts(direction: str) -> str:
    return f"""
SELECT l_partkey, COUNT(*) AS count FROM lineitem GROUP BY 1
ORDER BY count {direction}, l_partkey LIMIT 10
"""


def _n_joined(direction: str) -> str:
    return f"""
SELECT l_returnflag, p_brand, p_type, COUNT(*) AS count
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
ORDER BY count {direction}, 1, 2, 3 LIMIT 20
"""


def _n_prices(direction: str) -> str:
    return f"""
SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_brand = 'Brand#2'
ORDER BY p_retailprice {direction}, p_partkey LIMIT 5
"""


def _labelled(select: str, missing: bool) -> str:
    test = "quality IS NULL OR toxic IS NULL"
    where = test if missing else f"NOT ({test})"
    return f"""
SELECT {select} FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE {where}
"""


def _summary(column: str) -> str:
    marks = ", ".join(
        f"CAST(quantile_disc({column}, {q}) AS DOUBLE) AS {name}"
        for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""
SELECT '{column}' AS "column", CAST(COUNT({column}) AS BIGINT) AS n,
       ROUND(AVG({column}), 4) AS mean, ROUND(STDDEV_SAMP({column}), 4) AS stddev,
       CAST(MIN({column}) AS DOUBLE) AS min, {marks}, CAST(MAX({column}) AS DOUBLE) AS max
FROM lineitem
"""


_STATS = """
SELECT p_type, ROUND(AVG(p_retailprice), 4) AS average_p_retailprice,
       MIN(p_retailprice) AS min_p_retailprice, MAX(p_retailprice) AS max_p_retailprice
FROM part GROUP BY 1
"""

_AVERAGES = """
SELECT p_brand, p_type, ROUND(AVG(p_retailprice), 4) AS avg_p_retailprice FROM part GROUP BY 1, 2
"""


def _step(before: str, after: str) -> str:
    low = "ABS(p_retailprice - a) <= ABS(p_retailprice - b)"
    return f"""
, {after} AS (
  SELECT AVG(CASE WHEN {low} THEN p_retailprice END) AS a,
         AVG(CASE WHEN NOT ({low}) THEN p_retailprice END) AS b
  FROM part CROSS JOIN {before}
)"""


_CENTERS = (
    "WITH c0 AS (SELECT MIN(p_retailprice) AS a, MAX(p_retailprice) AS b FROM part)"
    + _step("c0", "c1")
    + _step("c1", "c2")
    + _step("c2", "c3")
)

_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"

ORACLE: dict[str, str] = {
    # sources and sinks
    "read_csv": "SELECT * FROM part",
    "read_tsv": "SELECT * FROM supplier",
    "read_delimited": "SELECT * FROM customer",
    "cleanse_tokens": f"""
        SELECT doc_id, CAST(len(items) AS INT) AS n_items, items[1] AS first_item,
               md5(array_to_string(items, '|')) AS items_md5
        FROM (SELECT doc_id, list_transform(string_split(text, ','),
                lambda x: lower(regexp_replace(x, '^{_SPACE}|{_SPACE}$', '', 'g'))) AS items
              FROM documents) t
    """,
    "write_partitioned": _per_genre(),
    "write_partitioned_rows": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
    "preview": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20
    """,
    "shape": "SELECT COUNT(*) AS num_rows, CAST(6 AS INT) AS num_columns FROM part",
    # columns
    "column_drop_rename": "SELECT p_partkey AS part_id, p_brand, p_type FROM part",
    "rate_column": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / (l_quantity / 60) AS rate
        FROM lineitem
    """,
    "token_at": "SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word FROM part",
    "prefix_concat": """
        SELECT p_partkey, concat('19', CAST(p_size AS VARCHAR)) AS size_code FROM part
    """,
    "bin_column": """
        SELECT p_partkey, CASE WHEN p_size <= 20 THEN 'low' WHEN p_size <= 30 THEN 'mid'
                               WHEN p_size <= 40 THEN 'high' ELSE 'very high' END AS size_class
        FROM part
    """,
    "range_label": f"{RATINGS} SELECT user_id AS c_custkey, age_group FROM u",
    "numeric_columns": "SELECT p_size, p_retailprice FROM part",
    "year_of": f"{RATINGS} SELECT movie_id, right(release_date, 4) AS year FROM mv",
    "decode_flags": """
        SELECT p_partkey, string_agg(w, '|' ORDER BY w) AS genres
        FROM (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) t
        GROUP BY 1
    """,
    # filters
    "drop_missing": _labelled("d.doc_id, lang, quality, toxic", missing=False),
    "missing_rows": _labelled("d.doc_id, lang, quality, toxic", missing=True),
    "missing_count": _labelled("COUNT(*) AS missing_rows", missing=True),
    "eq_filter": """
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE l_returnflag = 'R' AND l_linestatus = 'F'
    """,
    "non_empty": f"{RATINGS} SELECT movie_id FROM mv WHERE movie_id % 3 <> 0",
    "top_year_rows": RATINGS + _TOP_YEAR,
    "month_in_filter": RATINGS + _SUMMER,
    "member_filter": """
        SELECT p_partkey FROM part
        WHERE split_part(p_name, ' ', 1) = 'red' OR split_part(p_name, ' ', 2) = 'red'
    """,
    "suffix_arity_filter": """
        SELECT doc_id FROM documents WHERE array_length(string_split(text, '.')) = 5
    """,
    # joins
    "join_using": """
        SELECT l_partkey AS p_partkey, l_orderkey, l_linenumber, p_brand, p_type
        FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
    "lookup_join": """
        SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
    "top_rated_lookup": f"""{RATINGS}
        SELECT rt.movie_id, movie_name, COUNT(*) AS n_reviews
        FROM rt JOIN mv ON rt.movie_id = mv.movie_id GROUP BY 1, 2
        ORDER BY n_reviews DESC, 1 LIMIT 10
    """,
    "group_total_attach": """
        SELECT o_orderkey, o_orderpriority,
               COUNT(*) OVER (PARTITION BY o_orderpriority) AS group_total FROM orders
    """,
    "attach_group_list": f"""{RATINGS}
        , p AS (SELECT DISTINCT movie_id, age_group FROM rt JOIN u ON rt.user_id = u.user_id)
        SELECT movie_id, string_agg(age_group, '|' ORDER BY age_group) AS age_groups
        FROM p GROUP BY 1
    """,
    "attach_group_list_rows": f"""{RATINGS}
        , p AS (SELECT movie_id, age_group FROM rt JOIN u ON rt.user_id = u.user_id)
        , l AS (SELECT movie_id, string_agg(age_group, '|' ORDER BY age_group) AS age_groups
                FROM (SELECT DISTINCT movie_id, age_group FROM p) d GROUP BY 1)
        SELECT p.movie_id, age_group, age_groups FROM p JOIN l ON p.movie_id = l.movie_id
    """,
    # aggregates
    "count_by": """
        SELECT l_returnflag, l_linestatus, COUNT(*) AS count FROM lineitem GROUP BY 1, 2
    """,
    "percentage_by": """
        SELECT event_type, COUNT(*) AS count,
               ROUND(COUNT(*) * 100.0e0 / (SELECT COUNT(*) FROM events), 6) AS percentage
        FROM events GROUP BY event_type
    """,
    "nonneg_avg": """
        SELECT ROUND(AVG(CASE WHEN c_acctbal >= 0 THEN c_acctbal END), 4)
               AS average_positive_acctbal FROM customer
    """,
    "neg_avg": """
        SELECT ROUND(AVG(CASE WHEN c_acctbal < 0 THEN c_acctbal END), 4)
               AS average_negative_acctbal FROM customer
    """,
    "nonneg_avg_by": """
        SELECT c_mktsegment, ROUND(AVG(CASE WHEN c_acctbal >= 0 THEN c_acctbal END), 4)
               AS average_positive_acctbal FROM customer GROUP BY 1
    """,
    "neg_avg_by": """
        SELECT c_nationkey, ROUND(AVG(CASE WHEN c_acctbal < 0 THEN c_acctbal END), 4)
               AS average_negative_acctbal FROM customer GROUP BY 1
    """,
    "numeric_stats": _STATS,
    "numeric_stats_sql": _STATS,
    "average_by": _AVERAGES,
    "average_by_sql": _AVERAGES,
    "filtered_avg": """
        SELECT l_returnflag, l_linestatus, ROUND(AVG(l_quantity), 4) AS average_l_quantity
        FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1, 2
    """,
    "filtered_sum_scaled": """
        SELECT l_returnflag, l_linestatus, ROUND(SUM(l_quantity) / 60, 4) AS total_l_quantity
        FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1, 2
    """,
    "numeric_summary": " UNION ALL ".join(
        _summary(c) for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
    "distinct_by": f"""{RATINGS}
        SELECT COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT movie_id) AS n_movies FROM rt
    """,
    "top_users": f"""{RATINGS}
        SELECT user_id, COUNT(*) AS count FROM rt GROUP BY 1
        ORDER BY count DESC, user_id LIMIT 10
    """,
    "year_counts": f"""{RATINGS}
        SELECT right(release_date, 4) AS year, COUNT(*) AS count FROM mv GROUP BY 1
    """,
    "year_range": f"""{RATINGS}
        SELECT MIN(right(release_date, 4)) AS min_year, MAX(right(release_date, 4)) AS max_year
        FROM mv WHERE right(release_date, 4) <> ''
    """,
    # ranking
    "add_index": """
        SELECT o_orderkey, CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS idx
        FROM orders
    """,
    "add_index_input_order": """
        SELECT o_orderkey, CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS idx
        FROM orders
    """,
    "als_user_factors": f"""{RATINGS}
        SELECT CAST(user_id AS BIGINT) AS user_id, CAST(20 AS INT) AS n_factors
        FROM (SELECT user_id FROM rt UNION SELECT -1)
    """,
    "als_recommend": f"""{RATINGS}
        SELECT CAST(-1 AS BIGINT) AS user_id, n AS n_items, n AS n_distinct, n AS n_known,
               TRUE AS scores_match, TRUE AS none_better
        FROM (SELECT CAST(least(10, COUNT(DISTINCT movie_id)) AS BIGINT) AS n FROM rt)
    """,
    "kmeans_vectors": "SELECT vec_id, TRUE AS nearest FROM embeddings",
    "top_n_by": _n_parts("DESC"),
    "bottom_n_by": _n_parts("ASC"),
    "top_n_by_sql": _n_parts("DESC"),
    "bottom_n_by_sql": _n_parts("ASC"),
    "join_top_n": _n_joined("DESC"),
    "bottom_n_joined": _n_joined("ASC"),
    "lowest_n_where": _n_prices("ASC"),
    "highest_n_where": _n_prices("DESC"),
    # baskets
    "largest_basket": f"""{BASKETS}
        SELECT basket_id, COUNT(*) AS n_items FROM b GROUP BY 1
        ORDER BY n_items DESC, basket_id LIMIT 1
    """,
    "largest_basket_items": f"""{BASKETS}
        , l AS (SELECT basket_id, COUNT(*) AS n_items FROM b GROUP BY 1
                ORDER BY n_items DESC, basket_id LIMIT 1)
        SELECT b.basket_id, item, n_items FROM b JOIN l ON b.basket_id = l.basket_id
    """,
    "distinct_item_count": f"{BASKETS} SELECT COUNT(DISTINCT item) AS n_items FROM b",
    "item_counts": f"{BASKETS} SELECT item, COUNT(*) AS count FROM b GROUP BY 1",
    "top_items_pct": _items_pct("DESC"),
    "bottom_items_pct": _items_pct("ASC"),
    "pair_combinations": f"""{COMBINATIONS}
        SELECT basket_id, item1, item2, COUNT(*) AS times FROM c GROUP BY 1, 2, 3
    """,
    "pair_permutations": f"""{PERMUTATIONS}
        SELECT basket_id, item1, item2, COUNT(*) AS times FROM c GROUP BY 1, 2, 3
    """,
    "pair_baskets": f"""{COMBINATIONS}
        , t AS (SELECT basket_id, item1, item2, COUNT(*) AS times FROM c GROUP BY 1, 2, 3)
        SELECT item1, item2, CAST(floor(basket_id / 1000) AS BIGINT) AS basket_slice,
               string_agg(concat(basket_id, 'x', times), ',' ORDER BY basket_id) AS baskets
        FROM t GROUP BY 1, 2, 3
    """,
    "pair_counts": f"{COMBINATIONS} SELECT item1, item2, count FROM n",
    "pair_counts_ordered": f"{PERMUTATIONS} SELECT item1, item2, count_xy AS count FROM xy",
    "pair_support": _support(),
    "pair_support_per_basket": _support(
        denominator="(SELECT COUNT(DISTINCT basket_id) FROM b)"
    ),
    "pair_top_support": _support("ORDER BY count DESC, item1, item2 LIMIT 20"),
    "pair_bottom_support": _support("ORDER BY count, item1, item2 LIMIT 20"),
    "pair_confidence": f"{PERMUTATIONS} SELECT * FROM k",
    "pair_top_confidence": f"""{PERMUTATIONS}
        SELECT * FROM k ORDER BY count_x DESC, count_xy DESC, item1, item2 LIMIT 20
    """,
    "pair_bottom_confidence": f"""{PERMUTATIONS}
        SELECT * FROM k ORDER BY count_x, count_xy, item1, item2 LIMIT 20
    """,
    # ratings
    "union_rows": f"""{RATINGS}
        SELECT user_id, movie_id, rating FROM rt
        UNION ALL
        SELECT * FROM (VALUES (CAST(0 AS BIGINT), CAST(50 AS BIGINT), 5.0e0), (0, 172, 5.0e0),
                              (0, 181, 5.0e0)) v(user_id, movie_id, rating)
    """,
    "cast_ratings": f"""{RATINGS}
        SELECT CAST(user_id AS INT) AS user_id, CAST(movie_id AS INT) AS movie_id,
               CAST(rating AS FLOAT) AS rating FROM rt
    """,
    "distinct_pairs": f"""{RATINGS}
        SELECT DISTINCT movie_id, age_group FROM rt JOIN u ON rt.user_id = u.user_id
    """,
    "review_stats": f"""{RATINGS}
        SELECT rt.movie_id, movie_name, COUNT(*) AS n_reviews, ROUND(AVG(rating), 6) AS avg_rating
        FROM rt JOIN mv ON rt.movie_id = mv.movie_id GROUP BY 1, 2
    """,
    "review_stats_by_occupation": _reviews_by("occupation"),
    "review_stats_by_age_group": _reviews_by("age_group"),
    "top_n_per_genre": _per_genre(),
    "top_n_per_genre_top_year": _per_genre(f"mg.movie_id IN ({_TOP_YEAR})"),
    "top_n_per_genre_months": _per_genre(f"mg.movie_id IN ({_SUMMER})"),
    "top_n_per_age_group": f"""{RATINGS}
        , j AS (
          SELECT age_group, rt.movie_id, movie_name, rating
          FROM rt JOIN u ON rt.user_id = u.user_id JOIN mv ON rt.movie_id = mv.movie_id
        ), t AS (SELECT age_group, COUNT(*) AS group_total FROM j GROUP BY 1)
        , l AS (
          SELECT movie_id, string_agg(age_group, '|' ORDER BY age_group) AS age_groups
          FROM (SELECT DISTINCT movie_id, age_group FROM j) d GROUP BY 1
        ), s AS (
          SELECT age_group, movie_id, movie_name, COUNT(*) AS n_reviews, AVG(rating) AS a
          FROM j GROUP BY 1, 2, 3
        ), k AS (
          SELECT *, ROW_NUMBER() OVER (
            PARTITION BY age_group ORDER BY n_reviews DESC, movie_id) AS rn FROM s
        )
        SELECT k.age_group, group_total, age_groups, k.movie_id, movie_name, n_reviews,
               ROUND(a, 6) AS avg_rating
        FROM k JOIN t ON k.age_group = t.age_group JOIN l ON k.movie_id = l.movie_id
        WHERE rn <= 30 AND k.age_group <> 'Unknown'
    """,
    "top_n_per_occupation_genre": _per_occupation_genre(),
    "top_n_per_occupation_genre_chosen": _per_occupation_genre(
        "occupation = 'BUILDING' AND genre = 'red'"
    ),
    # clustering
    "kmeans_centers": f"""{_CENTERS}
        SELECT CAST(0 AS INT) AS cluster, ROUND(a, 6) AS center FROM c3
        UNION ALL SELECT 1, ROUND(b, 6) FROM c3
    """,
    "kmeans_assign": f"""{_CENTERS}
        SELECT p_partkey, CASE WHEN ABS(p_retailprice - a) <= ABS(p_retailprice - b)
                               THEN 0 ELSE 1 END AS cluster
        FROM part CROSS JOIN c3
    """,
}
