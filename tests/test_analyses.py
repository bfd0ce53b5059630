"""The composed analyses on small files."""

from pathlib import Path

import pytest

from tablekit import sources as S
from tablekit.plans import baskets, delays, movies, vehicles

FLIGHTS = """year,month,day,hour,carrier,origin,dest,tailnum,flight,dep_delay,distance,air_time
2014,1,1,6,UA,SEA,LAX,N1,10,-2,900,120
2014,1,2,7,UA,SEA,LAX,N1,11,5,900,150
2014,2,1,6,AS,PDX,SFO,N2,12,0,550,60
2014,2,1,6,AS,PDX,SFO,N9,13,30,540,0
2014,2,1,6,AS,PDX,SFO,N2,14,,540,60
"""
PLANES = """tailnum,year,model,speed
N1,1999,737,NA
N2,2004,A320,NA
N9,2005,A320,NA
"""


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_delay_report(spark, tmp_path):
    (tmp_path / "flights.csv").write_text(FLIGHTS)
    (tmp_path / "planes.csv").write_text(PLANES)
    flights = S.read_csv(spark, str(tmp_path / "flights.csv"))
    planes = S.read_csv(spark, str(tmp_path / "planes.csv"))
    report = delays.delay_report(flights, planes)
    assert rows(report["shape"]) == [(5, 12)]
    assert rows(report["missing_count"]) == [(1,)]
    assert rows(report["flights_by_year_month"]) == [(2014, 1, 2), (2014, 2, 2)]
    assert rows(report["share_by_carrier"]) == [("AS", 2, 50.0), ("UA", 2, 50.0)]
    assert rows(report["top_planes"])[0] == ("N1", 2)
    assert rows(report["positive_delay"]) == [(35 / 3,)]
    assert rows(report["negative_delay"]) == [(-2.0,)]
    assert rows(report["negative_delay_by_carrier"]) == [("UA", -2.0), ("AS", None)]
    assert rows(report["shortest_flight"]) == [(13, "PDX", 540)]
    assert rows(report["longest_flight"]) == [(11, "SEA", 150)]
    assert rows(report["average_duration"]) == [("UA", "SEA", 135.0)]
    assert rows(report["total_duration"]) == [("UA", "SEA", 4.5)]
    assert rows(report["speed_by_carrier"]) == [("AS", 550.0, 550.0, 550.0), ("UA", 405.0, 360.0, 450.0)]
    # No speed for zero minutes: that flight drops out of the joined table.
    assert report["flights_with_planes"].count() == 3
    assert rows(report["top_models"]) == [("UA", "737", 1999, 2), ("AS", "A320", 2004, 1)]
    assert rows(report["top_models"]) == rows(report["top_models_sql"])
    assert rows(report["bottom_models"]) == rows(report["bottom_models_sql"])
    for df in report.values():
        df.count()


VEHICLES = """mpg\tcylinders\tdisplacement\thorsepower\tweight\tacceleration\tmodelyear\torigin\tcarname
20\t4\t100\t80\t2000\t15.5\t70\t1\t"ford pinto"
30.5\t4\t100\t80\t2000\t15.5\t71\t3\t"toyota corolla"
41\t4\t90\t60\t1900\t15.5\t71\t3\t"toyota starlet"
25\t4\t100\t\t2000\t15.5\t71\t1\t"ford pinto"
15\t8\t300\t200\t4000\t10\t70\t1\t"ghost car"
"""


def test_vehicle_report(spark, tmp_path):
    (tmp_path / "v.tsv").write_text(VEHICLES)
    (tmp_path / "m.csv").write_text("manufacturer,country\nford,us\ntoyota,japan\n")
    cars = S.read_csv(spark, str(tmp_path / "v.tsv"), vehicles.VEHICLE_SCHEMA, sep="\t")
    makers = S.read_csv(spark, str(tmp_path / "m.csv"), vehicles.MAKER_SCHEMA)
    report = vehicles.vehicle_report(cars, makers)
    assert rows(report["shape"]) == [(5, 9)]
    assert rows(report["missing_count"]) == [(1,)]
    assert rows(report["vehicles_by_modelyear"]) == [("1970", 2), ("1971", 2)]
    assert rows(report["vehicles_by_mpg_class"]) == [("low", 2), ("high", 1), ("very high", 1)]
    assert rows(report["mpg_by_country"]) == [("japan", 35.75, 30.5, 41.0), ("us", 20.0, 20.0, 20.0)]
    assert report["vehicles_with_country"].count() == 3
    assert {r["column"] for r in report["summary"].collect()} == {
        "mpg", "cylinders", "displacement", "horsepower", "weight", "acceleration",
        "modelyear", "origin",
    }
    for name in [n for n in report if n.endswith("_sql")]:
        assert rows(report[name]) == rows(report[name.removesuffix("_sql")])


def test_basket_report(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("Milk, bread\nmilk,bread,beer\nbeer\nmilk,milk\n")
    report = baskets.basket_report(S.read_baskets(spark, str(path)), 2)
    assert rows(report["shape"]) == [(4, 1)]
    assert rows(report["distinct_items"]) == [(3,)]
    assert rows(report["top_items"]) == [("milk", 4, 50.0), ("beer", 2, 25.0)]
    assert sorted(r.item for r in report["largest_basket"].collect()) == ["beer", "bread", "milk"]
    assert rows(report["pair_counts"]) == [("bread", "milk", 2), ("beer", "bread", 1), ("beer", "milk", 1)]
    assert rows(report["pair_total"]) == [(4,)]
    assert rows(report["top_pairs"])[0] == ("bread", "milk", 2, 0.5)
    # Rules go by the count of the first item, then of the pair.
    assert rows(report["top_rules"]) == [
        ("milk", "bread", 2, 4, 0.5), ("milk", "milk", 2, 4, 0.5),
    ]
    for df in report.values():
        df.count()


@pytest.fixture
def movie_files(tmp_path):
    (tmp_path / "rating.dat").write_text(
        "1\t1\t5\t0\n2\t1\t3\t0\n1\t2\t4\t0\n3\t2\t2\t0\n3\t3\t1\t0\n2\t3\t2\t0\n1\t3\t3\t0\n"
    )
    (tmp_path / "genre.dat").write_text("unknown|0\nAction|1\nComedy|2\n")
    (tmp_path / "user.dat").write_text(
        "1|30|M|administrator|T8H1N\n2|31|F|writer|90210\n3|90|F|artist|1\n"
    )
    (tmp_path / "item.dat").write_text(
        "1|Toy|01-May-1995||http://x|0|1|1\n2|Gold|01-Jan-1995||u|0|0|1\n3|Old|02-Jun-1990||u|0|1|0\n"
        "4|unknown||||1|0|0\n"
    )
    return tmp_path


def test_movie_report(spark, movie_files, tmp_path):
    ratings = S.read_delimited(spark, str(movie_files / "rating.dat"), movies.RATING_SCHEMA, "\t")
    genres = S.read_delimited(spark, str(movie_files / "genre.dat"), movies.GENRE_SCHEMA, "|")
    users = S.read_delimited(spark, str(movie_files / "user.dat"), movies.USER_SCHEMA, "|")
    items = S.read_delimited(spark, str(movie_files / "item.dat"), movies.item_schema(3), "|")
    films = movies.with_genres(items, genres)
    assert {r.movie_id: r.genres for r in films.collect()} == {
        1: ["Action", "Comedy"], 2: ["Comedy"], 3: ["Action"], 4: ["unknown"],
    }
    report = movies.movie_report(ratings, films, users)
    assert rows(report["distinct"]) == [(3, 3)]
    assert rows(report["top_reviewers"]) == [(1, 3), (2, 2), (3, 2)]
    assert [r.movie_id for r in report["top_movies"].collect()] == [3, 1, 2]
    assert rows(report["movies_by_year"]) == [("1995", 2), ("", 1), ("1990", 1)]
    assert rows(report["year_range"]) == [("1990", "1995")]
    assert {(r.genre, r.movie_id) for r in report["by_genre_top_year"].collect()} == {
        ("Action", 1), ("Comedy", 1), ("Comedy", 2),
    }
    assert {(r.genre, r.movie_id) for r in report["by_genre_summer"].collect()} == {
        ("Action", 1), ("Action", 3), ("Comedy", 1),
    }
    assert rows(report["administrator_action"]) == [
        ("administrator", "Action", 1, "Toy", 1, 5.0),
        ("administrator", "Action", 3, "Old", 1, 3.0),
    ]
    folder = str(tmp_path / "out")
    movies.write_movie_report(report, folder)
    assert {p.name for p in Path(folder).iterdir()} == {"by_genre_top_year", "by_age_group", "by_genre_summer"}
    groups = {p.name for p in Path(folder, "by_age_group").iterdir() if p.is_dir()}
    assert len(groups) == 3
    fitted = movies.fit_with_profiles(ratings)
    assert fitted.user_factors().count() == 4
    new_user = spark.createDataFrame([(0,)], "user_id int")
    assert fitted.recommend(new_user, 10).count() == 6
