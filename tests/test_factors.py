"""Least squares over files: every factor is that of the normal equations, whatever the blocks."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tablekit.operators import factors as FA
from tablekit.operators.recommend import als_fit

RANK, REG = 4, 0.05


def triples_of(seed=1, users=60, items=40):
    """Few ratings of most ids, repeated ones, and one user with many more than a packed row holds."""
    draw = np.random.default_rng(seed)
    rows = [(int(u) - 7, int(m), float(r)) for u, m, r in zip(draw.integers(0, users, 900), draw.integers(0, items, 900), draw.integers(1, 6, 900), strict=True)]
    many = [(5000, int(m), float(m % 5 + 1)) for m in draw.integers(0, items, 3 * FA._ROW_RATINGS)]
    return [*rows, rows[0], *many, (9000, 777, 2.0)]


def table(spark, rows, types="user_id int, movie_id int, rating float"):
    return spark.createDataFrame(rows, types)


def solved(rows, others):
    """Spelled-out half step: the factor of every id given those of the other side."""
    of = {}
    for own, other, rating in rows:
        of.setdefault(own, []).append((others[other], rating))
    found = {}
    for own, rated in of.items():
        x, r = np.array([f for f, _ in rated], float), np.array([r for _, r in rated])
        found[own] = np.linalg.solve(x.T @ x + REG * len(r) * np.eye(RANK), x.T @ r)
    return found


def as_dict(df, key="id", value="features"):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: np.array(r[value]) for r in rows}


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_factors_solve_the_normal_equations(spark, blocks):
    rows = triples_of()
    users, items = (as_dict(f) for f in FA.fit_factors(table(spark, rows), RANK, 1 if blocks > 3 else 2, REG, 42, blocks))
    assert users.keys() == {u for u, _, _ in rows} and items.keys() == {m for _, m, _ in rows}
    expected = solved(rows, items)
    for u, found in users.items():
        assert found == pytest.approx(expected[u], abs=1e-4)


def test_items_are_solved_first_from_the_starting_users(spark):
    rows = triples_of(2)
    start, _ = (as_dict(f) for f in FA.fit_factors(table(spark, rows), RANK, 0, REG, 42, 3))
    assert all(np.linalg.norm(x) == pytest.approx(1, abs=1e-5) for x in start.values())
    _, items = (as_dict(f) for f in FA.fit_factors(table(spark, rows), RANK, 1, REG, 42, 3))
    expected = solved([(m, u, r) for u, m, r in rows], start)
    assert items.keys() == expected.keys()
    for m, found in items.items():
        assert found == pytest.approx(expected[m], abs=1e-4)


def test_each_block_is_a_task_of_its_own(spark, monkeypatch):
    written = []
    half_step = FA._half_step

    def counted(*given):
        path = half_step(*given)
        written.append(len(list(Path(path).glob("part-*"))))
        return path

    monkeypatch.setattr(FA, "_half_step", counted)
    FA.fit_factors(table(spark, triples_of()), RANK, 1, REG, 42, 5)
    assert written == [5, 5]


def test_packed_rows_may_come_in_any_order():
    draw = np.random.default_rng(3)
    counts, ids = np.array([2, 1, 3], np.int32), np.array([11, 12, 13], np.int32)
    needed, others = np.array([4, 6, 9], np.int32), np.array([9, 1, 4, 6], np.int32)
    places, values = draw.integers(0, 3, 6).astype(np.int32), draw.random(6).astype(np.float32)
    x = draw.random((4, RANK)).astype(np.float32)
    batches = [
        *FA._rows(FA.NEEDED, 0, [np.array([0, 3]), None, None, None], [needed, None, None, None]),
        *FA._rows(FA.FACTORS, 0, [np.array([0, 1, 4]), None, None, np.array([0, 1, 4]) * RANK], [others, None, None, x.ravel()]),
        *FA._rows(FA.WHOLE, 0, [np.array([0, 2, 3]), np.array([0, 2, 3]), np.array([0, 3, 6]), np.array([0, 3, 6])], [ids, counts, places, values]),
        *FA._rows(FA.PIECE, 0, [np.arange(3), None, np.array([0, 1, 3]), np.array([0, 1, 3])], [np.array([70, 70], np.int32), None, places, values]),
    ]
    of = {6: x[3], 4: x[2], 9: x[0]}
    rated = [(i, int(needed[p]), float(v)) for i, p, v in zip([*np.repeat(ids, counts), 70, 70, 70], [*places, *places[:3]], [*values, *values[:3]], strict=True)]
    expected = solved(rated, of)
    mixed = pa.Table.from_batches(batches).combine_chunks().to_batches()
    for order in (batches, batches[::-1], [batches[i] for i in (2, 1, 3, 0)], mixed):
        found = {}
        for batch in FA._solve(RANK, REG)(iter(order)):
            some = FA._numbers(batch.column("ids"), np.int32)
            found |= dict(zip(some.tolist(), FA._numbers(batch.column("values"), np.float32).reshape(-1, RANK), strict=True))
        assert found.keys() == expected.keys()
        for i, f in found.items():
            assert f == pytest.approx(expected[i], abs=1e-4)
    with pytest.raises(ValueError):
        list(FA._solve(RANK, REG)(iter([batches[0], batches[2]])))


def test_many_ratings_are_fitted_over_files(spark, monkeypatch):
    base = 2**40
    rows = [(base + u, f"m{m}", 5.0 if (u + m) % 2 == 0 else 1.0) for u in range(20) for m in range(10)]
    ratings = table(spark, rows, "user_id long, movie_id string, rating double")
    spark.conf.set("spark.sql.unionOutputPartitioning", "true")
    fitted = als_fit(ratings, rank=4, iterations=8, blocks=2, library_ratings=len(rows) - 1)
    assert spark.conf.get("spark.sql.unionOutputPartitioning") == "true"
    spark.conf.unset("spark.sql.unionOutputPartitioning")
    assert {r.user_id for r in fitted.user_factors().collect()} == {base + u for u in range(20)}
    assert {r.movie_id for r in fitted.item_factors().collect()} == {f"m{m}" for m in range(10)}
    best = fitted.recommend(spark.createDataFrame([(base,)], "user_id long"), 5).collect()
    assert {r.movie_id for r in best} == {"m0", "m2", "m4", "m6", "m8"}
    factors = as_dict(fitted.user_factors(), "user_id", "factors"), as_dict(fitted.item_factors(), "movie_id", "factors")
    for r in best:
        assert r.rating == pytest.approx(float(factors[0][base] @ factors[1][r.movie_id]), abs=1e-3)
    assert fitted.recommend(n=2).count() == 40


@pytest.mark.parametrize("odd", [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan")), (1, 1, float("inf"))])
def test_missing_values_are_an_error_as_in_the_library(spark, odd):
    ratings = table(spark, [(1, 1, 1.0), (2, 1, 3.0), odd])
    for library_ratings in (0, 100):
        with pytest.raises(Exception, match="(?i)must"):
            als_fit(ratings, rank=2, iterations=1, blocks=1, library_ratings=library_ratings)
