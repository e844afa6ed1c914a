"""The database source and sink, against sqlite3."""

import datetime as dt
import random
import sqlite3
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltlake.sources import database, jdbc, registry

KINDS = "k long, name string, price decimal(10,2), at timestamp, day date, ok boolean, raw binary, x double, n int"


def rows_of(n, start=0):
    return [
        (k, f"n'{k}\"é" if k % 5 else None, Decimal(k) / 4, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=k, microseconds=k % 3), dt.date(2024, 1, 1 + k % 28), k % 2 == 0, bytes([k % 256]), k / 3, k % 7 if k % 4 else None)
        for k in range(start, start + n)
    ]


def at(path):
    return str(path / "db.sqlite")


def test_round_trip_of_all_types(spark, tmp_path):
    df = spark.createDataFrame(rows_of(500), KINDS)
    database.write(df.repartition(5), at(tmp_path), "items")
    found = database.read(spark, at(tmp_path), "items")
    assert [f.dataType for f in found.schema if f.name != "n"] == [f.dataType for f in df.schema if f.name != "n"]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.collect()))
    with sqlite3.connect(at(tmp_path)) as db:
        assert [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")] == ["items"]


@pytest.mark.parametrize("column", ["k", "n", "at", "name"])
def test_ranges_read_every_row_once(spark, tmp_path, column):
    rng = random.Random(3)
    rows = [(rng.choice([1, 5, 5, 9, 1000, None]), f"r{k}", None, dt.datetime(2024, 1, 1 + k % 28), None, None, None, None, rng.choice([None, 1, 2])) for k in range(300)]
    database.write(spark.createDataFrame(rows, KINDS), at(tmp_path), "items")
    whole = database.read(spark, at(tmp_path), "items", split=(column, 4))
    assert 1 <= whole.rdd.getNumPartitions() <= 4
    assert sorted(r["name"] for r in whole.collect()) == sorted(r[1] for r in rows)


def test_ranges_are_even_and_parallel(spark, tmp_path):
    database.write(spark.range(10_000).withColumn("t", F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 6, "0"))), at(tmp_path), "items")
    for column in ("id", "t"):
        sizes = [r["count"] for r in database.read(spark, at(tmp_path), "items", split=(column, 8)).groupBy(F.spark_partition_id()).count().collect()]
        assert sizes == [1250] * 8
    assert database.read(spark, at(tmp_path), "items", split=("id", 4)).where("id < 0").count() == 0


def test_filters_reach_the_database(spark, tmp_path):
    database.write(spark.createDataFrame(rows_of(1000), KINDS), at(tmp_path), "items")
    found = database.read(spark, at(tmp_path), "items", split=("k", 3)).where("k > 10 AND k <= 20 AND name IS NOT NULL AND n IN (1, 2, 3) AND x * 3 > 12")
    assert sorted(r["k"] for r in found.collect()) == [k for k in range(11, 21) if k % 5 and k % 4 and k % 7 in (1, 2, 3) and k > 12]
    reader = database.DatabaseReader({"database": at(tmp_path), "table": "items"}, found.schema)
    from pyspark.sql import datasource as ds

    kept = list(reader.pushFilters([ds.GreaterThan(("k",), 5), ds.StringContains(("name",), "x"), ds.EqualTo(("ok",), True), ds.EqualTo(("a", "b"), 1)]))
    assert len(kept) == 3 and reader.conditions() == (' WHERE ("k" > ?)', [5])


def failing(df, key):
    return df.withColumn("k", F.when(F.col("k") == key, F.raise_error(F.lit("broken off"))).otherwise(F.col("k")))


@pytest.mark.parametrize(("mode", "keys"), [("append", []), ("append", ["k"]), ("overwrite", ["k"])])
def test_a_write_that_fails_leaves_the_table_whole(spark, tmp_path, mode, keys):
    database.write(spark.createDataFrame(rows_of(50), KINDS), at(tmp_path), "items", "overwrite", ["k"])
    before = sorted(map(tuple, database.read(spark, at(tmp_path), "items").collect()))
    with pytest.raises(Exception, match="broken off"):
        database.write(failing(spark.createDataFrame(rows_of(5000, 20), KINDS).repartition(6), 4000), at(tmp_path), "items", mode, keys)
    assert sorted(map(tuple, database.read(spark, at(tmp_path), "items").collect())) == before
    with sqlite3.connect(at(tmp_path)) as db:
        assert [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")] == ["items"]


def test_an_upsert_run_twice_is_one(spark, tmp_path):
    database.write(spark.createDataFrame(rows_of(100), KINDS), at(tmp_path), "items", "overwrite", ["k"])
    batch = spark.createDataFrame([(k, "new", *r) for k, _, *r in rows_of(80, 60)], KINDS)
    once = None
    for _ in range(2):
        database.write(batch.repartition(4), at(tmp_path), "items", keys=["k"])
        now = sorted(map(tuple, database.read(spark, at(tmp_path), "items").collect()))
        assert once is None or now == once
        once = now
    assert len(once) == 140 and {r[1] for r in once if r[0] >= 60} == {"new"} and "new" not in {r[1] for r in once if r[0] < 60}
    with pytest.raises(Exception, match="(?i)unique"):
        database.write(batch.unionByName(batch), at(tmp_path), "items", "overwrite", ["k"])
    assert database.read(spark, at(tmp_path), "items").count() == 140


def test_new_columns_are_added_and_keys_alone_only_come_in(spark, tmp_path):
    database.write(spark.createDataFrame([(1, "a")], "k long, v string"), at(tmp_path), "t", keys=["k"])
    database.write(spark.createDataFrame([(2, "b", 5)], "k long, v string, extra long"), at(tmp_path), "t", keys=["k"])
    database.write(spark.createDataFrame([(1,), (3,)], "k long"), at(tmp_path), "t", keys=["k"])
    assert sorted(map(tuple, database.read(spark, at(tmp_path), "t").collect())) == [(1, "a", None), (2, "b", 5), (3, None, None)]
    database.write(spark.createDataFrame([(7,)], "k long"), at(tmp_path), "t", "overwrite")
    assert [tuple(r) for r in database.read(spark, at(tmp_path), "t").collect()] == [(7,)]
    with pytest.raises(ValueError, match="no column"):
        database.DatabaseWriter({"database": at(tmp_path), "table": "t", "keys": "nope"}, spark.range(1).schema, False)
    with pytest.raises(Exception, match="no table"):
        database.read(spark, at(tmp_path), "missing")


def test_increments_by_the_registry(spark, tmp_path):
    database.write(spark.createDataFrame([(k, f"2024-01-{k:02d} 00:00:00") for k in range(1, 20)], "k long, updated_at string"), at(tmp_path), "src")
    config = {"type": "sqlite", "database": at(tmp_path), "table": "src", "stamp": "updated_at", "after": "2024-01-05 00:00:00", "until": "2024-01-09 00:00:00", "schema": "k long, updated_at string", "split": ("k", 3)}
    assert sorted(r["k"] for r in registry.reader("any", config)(spark, config).collect()) == [6, 7, 8, 9]
    config = {"type": "sqlite", "database": at(tmp_path), "table": "src", "stamp": "updated_at", "after": "1900-01-01", "until": "9999-01-01"}
    assert registry.reader("any", config)(spark, config).count() == 19
    assert jdbc.incremental_query("src", "updated_at", "2024-01-05") == "SELECT * FROM src WHERE updated_at > '2024-01-05'"


def staged(path):
    return [f.name for f in path.iterdir() if "_staging_" in f.name]


def test_tasks_fill_files_of_their_own_in_the_order_of_the_keys(spark, tmp_path):
    df = spark.range(4000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("k"), "id").repartition(12)
    for mode in ("overwrite", "append"):
        database.write(df, at(tmp_path), "items", mode, ["k"])
        with sqlite3.connect(at(tmp_path)) as db:
            found = db.execute("SELECT k, id FROM items ORDER BY rowid").fetchall()
            assert found == sorted(map(tuple, df.collect()))
            assert len(db.execute("PRAGMA index_list(items)").fetchall()) == 1
    database.write(df, at(tmp_path), "rows")
    assert database.read(spark, at(tmp_path), "rows").count() == 4000 and not staged(tmp_path)


def test_a_task_that_runs_on_after_the_end_writes_nothing(spark, tmp_path):
    import pyarrow as pa

    for end in ("commit", "abort"):
        writer = database.DatabaseWriter({"database": at(tmp_path), "table": "t"}, spark.range(1).schema, False)
        batch = pa.RecordBatch.from_pydict({"id": [1, 2]})
        done = writer.write(iter([batch]))

        def late():
            yield batch
            getattr(writer, end)([done])
            yield batch

        with pytest.raises(Exception):
            writer.write(late())
            raise RuntimeError("ended")
        with pytest.raises(RuntimeError, match="has ended"):
            writer.write(iter([batch]))
        assert not staged(tmp_path)
    with sqlite3.connect(at(tmp_path)) as db:
        assert db.execute("SELECT id FROM t").fetchall() == [(1,), (2,)]


def test_times_are_in_utc_with_fractions_only_where_there_are_some(spark, tmp_path):
    df = spark.sql("SELECT 1 AS k, TIMESTAMP '2024-01-01 00:00:00' AS t, DATE '0099-03-01' AS d UNION ALL SELECT 2, TIMESTAMP '2024-01-01 10:00:00.000100', NULL UNION ALL SELECT 3, NULL, NULL")
    database.write(df, at(tmp_path), "t", "overwrite", ["k"])
    with sqlite3.connect(at(tmp_path)) as db:
        assert db.execute("SELECT * FROM t ORDER BY k").fetchall() == [(1, "2024-01-01 00:00:00", "0099-03-01"), (2, "2024-01-01 10:00:00.000100", None), (3, None, None)]
