"""SQLite splits and the CSV file that many tasks write."""

import csv
import sqlite3

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from chatloom.sources import csv_file, sqlite


def loaded(path, sql, rows):
    with sqlite3.connect(path) as c:
        c.execute(sql)
        c.executemany(f"insert into t values ({', '.join('?' * len(rows[0]))})", rows)
    return str(path)


@pytest.mark.parametrize(
    "keys",
    [
        [*range(1, 11), *range(10**9, 10**9 + 4000)],
        [*range(-50, 0), *range(2**40, 2**40 + 1000), *range(2**62, 2**62 + 950)],
        [i * 1000 for i in range(10)] + list(range(10**6, 10**6 + 3000)),
        [5],
        [-(2**63), 0, 2**63 - 1],
    ],
)
def test_splits_hold_as_many_rows(spark, tmp_path, keys):
    path = loaded(tmp_path / "a.db", "create table t(_id integer primary key, x text)", [(k, f"m{k}") for k in keys])
    df = sqlite.read(spark, path, "t", 4)
    assert sorted(r._id for r in df.collect()) == sorted(keys)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    if len(keys) > 100:
        assert len(sizes) == 4 and max(sizes) <= 1.1 * len(keys) / 4 + 20


def test_tables_without_rowid_and_views(spark, tmp_path):
    path = loaded(tmp_path / "a.db", "create table t(k, n integer, primary key (k, n)) without rowid", [*((i, 1) for i in range(200)), ("text", 1), ("x", 2)])
    df = sqlite.read(spark, path, "t", 4)
    assert df.count() == 202 and df.rdd.getNumPartitions() == 4 and df.filter("k = 'text'").count() == 1
    with sqlite3.connect(path) as c:
        c.execute("create view v as select n, count(*) as m from t group by n")
        c.execute("create table none(a integer)")
    assert sorted(map(tuple, sqlite.read(spark, path, "v", 3).select("n").collect())) == [(1,), (2,)]
    assert sqlite.read(spark, path, "none").count() == 0


def test_csv_bytes_are_those_of_one_writer(spark, tmp_path):
    rows = [(i, ["plain", 'q"uote', "a,b", "line\nend\r", "é 💛", "", None, " x "][i % 8], i / 4 if i % 3 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b string, c double").repartition(5).orderBy("a")
    assert csv_file.write(df, tmp_path / "deep" / "t.csv", ("a", "título", "c")) == 500
    with (tmp_path / "want.csv").open("w", encoding="utf-8", newline="") as f:
        csv.writer(f).writerows([("a", "título", "c"), *rows])
    assert (tmp_path / "deep" / "t.csv").read_bytes() == (tmp_path / "want.csv").read_bytes()
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["t.csv"]
    assert csv_file.write(df.limit(0), tmp_path / "deep" / "t.csv", ("a", "b", "c")) == 0 and (tmp_path / "deep" / "t.csv").read_bytes() == b"a,b,c\r\n"


def test_a_broken_csv_leaves_the_old_one(spark, tmp_path):
    csv_file.write(spark.range(3), tmp_path / "t.csv", ("a",))
    with pytest.raises(Exception, match="broken"):
        csv_file.write(spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id"))), tmp_path / "t.csv", ("a",))
    assert (tmp_path / "t.csv").read_bytes() == b"a\r\n0\r\n1\r\n2\r\n" and len(list(tmp_path.iterdir())) == 1


def test_cells():
    assert csv_file.cell([Row(value="é", n=3), Row(value="b", n=1)]) == '[["é", 3], ["b", 1]]'
    assert csv_file.cell([Row(step_id="1", ids=[1, 2])]) == '[{"step_id": "1", "ids": [1, 2]}]'
    assert [csv_file.cell(v) for v in (None, 3, "x", [])] == ["", 3, "x", "[]"]
