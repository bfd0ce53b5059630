"""Readers and writers."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablekit import sources as S
from tablekit.scratch import scratch, shared_folder, written


@pytest.mark.parametrize(
    "read",
    [
        lambda spark, p: S.read_csv(spark, p),
        lambda spark, p: S.read_csv(spark, p, "a int"),
        lambda spark, p: S.read_delimited(spark, p, "a int", "|"),
        lambda spark, p: S.read_baskets(spark, p),
        lambda spark, p: S.read_table(spark, p, "t"),
    ],
)
def test_missing_path(spark, tmp_path, read):
    with pytest.raises(FileNotFoundError):
        read(spark, str(tmp_path / "absent"))


def test_other_errors_stay(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception) as caught:
        S.read_table(spark, str(tmp_path), "x").collect()
    assert not isinstance(caught.value, FileNotFoundError)


def test_read_csv_infers_and_reads_empty_as_null(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text('n\tname\n1\t"a\tb"\n\tc\n')
    df = S.read_csv(spark, str(path), sep="\t")
    assert df.dtypes == [("n", "int"), ("name", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, "a\tb"), (None, "c")]


def test_read_csv_null_value(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("n\n1\nNA\n")
    df = S.read_csv(spark, str(path), "n int", null_value="NA")
    assert [r.n for r in df.collect()] == [1, None]


def test_read_delimited_keeps_quotes_and_fills_short_lines(spark, tmp_path):
    path = tmp_path / "x.dat"
    path.write_text('1|"a"|x\n2|b\n3|c\\d||extra\nx|"e|f"\n')
    df = S.read_delimited(spark, str(path), "i int, s string, t string", "|")
    assert df.dtypes == [("i", "int"), ("s", "string"), ("t", "string")]
    assert [tuple(r) for r in df.collect()] == [
        (1, '"a"', "x"), (2, "b", None), (3, "c\\d", ""), (None, '"e', 'f"'),
    ]


def test_read_baskets(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("Milk, Bread\nmilk\n")
    assert [r["items"] for r in S.read_baskets(spark, str(path)).collect()] == [
        ["milk", "bread"],
        ["milk"],
    ]


def test_sql_over_leaves_no_view(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert S.sql_over(df, "SELECT sum(a) AS s FROM {df}").first().s == 3
    assert spark.catalog.listTables() == []


def test_preview(spark):
    assert S.preview(spark.range(100)).count() == 100
    assert S.preview(spark.range(101)).count() == 20
    assert S.preview(spark.range(0)).count() == 0
    assert S.preview(spark.range(5), max_rows=3, show_rows=2).count() == 2


def group_files(path):
    return {d.name: sorted(d.glob("part-*")) for d in Path(path).iterdir() if d.is_dir()}


def test_write_one_ordered_file_per_group(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), (F.col("id") % 17).alias("avg"), "id")
    path = str(tmp_path / "out")
    S.write_partitioned(df, path, "g", [F.desc("avg"), F.asc("id")], one_file_per_group=True)
    files = group_files(path)
    assert {g: len(f) for g, f in files.items()} == {"g=0": 1, "g=1": 1, "g=2": 1}
    rows = [tuple(r) for r in spark.read.parquet(str(files["g=1"][0])).select("avg", "id").collect()]
    assert len(rows) == 100
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_write_spreads_a_large_group_in_order(spark, tmp_path, keep_partitions):
    df = spark.range(10_000).select(
        F.when(F.col("id") < 9_900, "big").otherwise("small").alias("g"), "id"
    )
    path = str(tmp_path / "out")
    S.write_partitioned(df, path, "g", [F.desc("id")])
    big = group_files(path)["g=big"]
    assert len(big) > 1
    ids = [r.id for f in big for r in spark.read.parquet(str(f)).collect()]
    assert ids == list(range(9_899, -1, -1))


def test_write_spreads_copies_of_one_row(spark, tmp_path, keep_partitions):
    df = spark.range(0, 8_000, 1, 8).select(F.lit("big").alias("g"), F.lit(1).alias("x"))
    path = str(tmp_path / "out")
    S.write_partitioned(df, path, "g", [F.desc("x")])
    assert len(group_files(path)["g=big"]) > 4
    assert spark.read.parquet(path).count() == 8_000


def test_write_fails_on_an_existing_path(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "g string, x int")
    with pytest.raises(Exception, match="exists"):
        S.write_partitioned(df, str(tmp_path), "g", [F.desc("x")])


def test_written_tables_lie_in_the_shared_folder(spark):
    table = written(spark.range(3), "numbers")
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in table.inputFiles())
    assert sorted(r.id for r in table.collect()) == [0, 1, 2]


class OtherSession:
    """As much of a session as the folder lookup needs."""

    def __init__(self, **settings):
        self.conf = {k.replace("__", "."): v for k, v in settings.items()}


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(OtherSession(spark__master="yarn"))
    named = OtherSession(spark__master="yarn", spark__checkpoint__dir="hdfs://x/y/")
    assert shared_folder(named) == "hdfs://x/y"
    assert Path(shared_folder(OtherSession(spark__master="local[2]"))).is_dir()


def test_csv_with_several_null_markers(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id,v,s\n1,-999,NA\n2,NA,ok\n3,7,-999\n4,,x\n")
    found = S.read_csv(spark, str(path), "id int, v int, s string", null_value=["NA", "-999"])
    assert found.dtypes == [("id", "int"), ("v", "int"), ("s", "string")]
    assert sorted(tuple(r) for r in found.collect()) == [(1, None, None), (2, None, "ok"), (3, 7, None), (4, None, "x")]
    assert S.read_csv(spark, str(path), null_value=["NA", "-999"]).dtypes == found.dtypes


def test_csv_with_one_marker_equals_two(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('n,d,b,s\n 1,1.5,true,NA\n1.5,x,yes,"NA"\nNA,NaN,NA,""\n99999999999,-Inf,FALSE, NA\n,,,\n')
    schema = "n int, d double, b boolean, s string"
    one, two = (S.read_csv(spark, str(path), schema, null_value=m) for m in ("NA", ["NA", "never"]))
    assert one.dtypes == two.dtypes
    assert [repr(r) for r in one.collect()] == [repr(r) for r in two.collect()]
    assert [r.n for r in one.collect()] == [1, None, None, None, None]


def test_csv_types_are_the_narrowest_that_fit(spark, tmp_path):
    path = tmp_path / "x.csv"
    columns = {
        "i": ("1", "-7", "int"),
        "l": ("1", "99999999999", "bigint"),
        "m": ("1", "99999999999999999999", "decimal(38,0)"),
        "f": ("1", "2.5e3", "double"),
        "d": ("2020-02-29", "2021-01-01", "date"),
        "t": ("2020-02-29", "2021-01-01 10:00:00", "timestamp"),
        "bad": ("2020-02-29", "2021-02-30", "string"),
        "o": ("true", "False", "boolean"),
        "w": ("1", "true", "string"),
        "none": ("NA", "", "string"),
        "part": ("NA", "3", "int"),
    }
    lines = [",".join(columns), *(",".join(v[i] for v in columns.values()) for i in (0, 1))]
    path.write_text("\n".join(lines) + "\n")
    found = S.read_csv(spark, str(path), null_value="NA")
    assert found.dtypes == [(c, v[2]) for c, v in columns.items()]
    first, second = found.collect()
    assert (first.i, second.i, second.l, second.f, second.o) == (1, -7, 99999999999, 2500.0, False)
    assert first.none is second.none is first.part is None and second.part == 3


def test_csv_types_take_the_same_jobs_for_any_number_of_columns(spark, tmp_path):
    def jobs(n):
        path = tmp_path / f"{n}.csv"
        path.write_text(",".join(f"c{i}" for i in range(n)) + "\n" + ",".join("7" * n) + "\n")
        spark.sparkContext.setJobGroup(f"csv-{n}", "")
        assert {t for _, t in S.read_csv(spark, str(path)).dtypes} == {"int"}
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"csv-{n}"))

    assert 0 < jobs(1) == jobs(40) <= 3


def test_csv_of_a_header_alone(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n")
    found = S.read_csv(spark, str(path), null_value="NA")
    assert found.dtypes == [("a", "string"), ("b", "string")] and found.count() == 0


def test_one_file_is_refused_for_a_large_group(spark, tmp_path):
    other = F.concat(F.lit("g"), F.col("id") % 9)
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(other).alias("g"), "id")
    path = tmp_path / "out"
    with pytest.raises(ValueError, match="'hot' of g has 500 rows"):
        S.write_partitioned(df, str(path), "g", [F.desc("id")], one_file_per_group=True, max_file_rows=499)
    assert not path.exists()
    S.write_partitioned(df, str(path), "g", [F.desc("id")], one_file_per_group=True, max_file_rows=500)
    assert {len(f) for f in group_files(path).values()} == {1}


def test_scratch_removes_what_was_written_inside(spark):
    with scratch(spark) as folder:
        table = written(spark.range(10), "kept")
        assert table.count() == 10 and all(folder in f for f in table.inputFiles())
    assert not Path(folder).exists()
    assert written(spark.range(3), "outside").count() == 3
