"""Marts as SQL files: dependencies, order, views and refresh."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltlake.operators import transform
from siltlake.plans import graph, sqlmarts
from siltlake.sinks import tables



def at(month):
    return F.lit(f"2024-0{month}-01 00:00:00").cast("timestamp")


@pytest.mark.parametrize(
    ("sql", "names"),
    [
        ("SELECT * FROM a JOIN b USING (k) -- FROM c\n WHERE x <> 'FROM d' /* JOIN e */", ["a", "b"]),
        ("WITH a AS (SELECT 1 AS k) SELECT * FROM a", []),
        ("WITH a AS (SELECT * FROM a) SELECT * FROM A", ["a"]),
        ("WITH a AS (SELECT 1 AS k), b AS (SELECT * FROM a) SELECT * FROM b JOIN c", ["c"]),
        ("SELECT * FROM (WITH a AS (SELECT 1 AS k) SELECT * FROM a) JOIN a", ["a"]),
        ("WITH RECURSIVE r AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM r WHERE n < 5) SELECT * FROM r, s", ["s"]),
        ("SELECT (SELECT max(k) FROM a), k IN (SELECT k FROM db.b) FROM c WHERE EXISTS (SELECT 1 FROM d WHERE d.k = c.k)", ["c", "a", "db.b", "d"]),
        ("SELECT * FROM a, LATERAL (SELECT * FROM b WHERE b.k = a.k) UNION ALL TABLE c", ["a", "b", "c"]),
        ("SELECT `FROM x` FROM `odd name` WHERE t = :run_at", ["odd name"]),
        ("SELECT * FROM explode(array(1, 2)) JOIN VALUES (1) AS v(k)", []),
    ],
)
def test_relations_of_a_query(spark, sql, names):
    assert sorted(sqlmarts.relations(spark, sql)) == sorted(names)


def written(folder, **texts):
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.sql").write_text(text)
    return folder.as_uri()


def test_discovery_names_and_errors(spark, tmp_path):
    where = written(tmp_path / "a", gold_one="SELECT * FROM tbl_src", two="SELECT * FROM gold_one JOIN one USING (k)", three="SELECT * FROM default.gold_two WHERE note <> 'FROM four'", four="SELECT * FROM two")
    (tmp_path / "a" / "notes.txt").write_text("SELECT * FROM nothing")
    marts = sqlmarts.discover(spark, where, dict.fromkeys(("one", "two", "three", "four"), ["k"]))
    assert {n: list(m.reads) for n, m in marts.items()} == {"one": ["tbl_src"], "two": ["one"], "three": ["two"], "four": ["two"]}
    assert graph.order(marts, ["three"]) == ["one", "two", "three"]
    with pytest.raises(ValueError, match="without keys"):
        sqlmarts.discover(spark, where, {"one": ["k"]})
    with pytest.raises(FileNotFoundError):
        sqlmarts.discover(spark, written(tmp_path / "b"), {})
    with pytest.raises(ValueError, match="two files"):
        sqlmarts.read_files(spark, written(tmp_path / "c", gold_x="SELECT 1", x="SELECT 2"))
    cycle = sqlmarts.discover(spark, written(tmp_path / "d", x="SELECT * FROM y", y="SELECT * FROM gold_x"), {"x": ["k"], "y": ["k"]})
    with pytest.raises(Exception, match="(?i)cycle"):
        graph.order(cycle)


@pytest.mark.parametrize("buckets", [0, 8])
def test_a_folder_of_marts_is_refreshed_in_order(spark, tmp_path, buckets):
    for name in ("base", "sums", "report"):
        spark.sql(f"DROP TABLE IF EXISTS gold_{name}")
    where = written(tmp_path / f"m{buckets}", report="WITH base AS (SELECT g FROM base) SELECT s.g, total, :run_at AS _data_as_of FROM gold_sums s LEFT SEMI JOIN base ON s.g = base.g", sums="SELECT g, sum(v) AS total FROM base GROUP BY g", base="SELECT k, g, v FROM tbl_rows WHERE note <> 'FROM report'")
    sides = {n: buckets for n in ("base", "sums")}
    marts = sqlmarts.discover(spark, where, {"base": ["k"], "sums": ["g"], "report": ["g"]}, buckets=sides)
    spark.createDataFrame([(1, "a", 10, "x"), (2, "a", 5, "x"), (3, "b", 1, "x")], "k int, g string, v int, note string").createOrReplaceTempView("tbl_rows")
    assert graph.refresh(spark, marts, at(1)) == {"base": "ok", "sums": "ok", "report": "ok"}
    spark.createDataFrame([(2, "a", 7, "x"), (4, "c", 9, "x")], "k int, g string, v int, note string").createOrReplaceTempView("tbl_rows")
    assert graph.refresh(spark, marts, at(2), ["report"]) == {"base": "ok", "sums": "ok", "report": "ok"}
    assert {r["k"]: (r["g"], r["v"]) for r in spark.table("gold_base").collect()} == {"1": ("a", "10"), "2": ("a", "7"), "3": ("b", "1"), "4": ("c", "9")}
    report = {r["g"]: r for r in spark.table("gold_report").collect()}
    assert {g: float(r["total"]) for g, r in report.items()} == {"a": 17, "b": 1, "c": 9}
    assert {r["_inserted_at"] for r in report.values()} == {dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)}
    assert not spark.catalog.tableExists("base") and not spark.catalog.tableExists("sums")


def test_marts_do_not_shadow_the_session_views(spark, tmp_path):
    where = written(tmp_path / "s", first="SELECT 1 AS k", second="SELECT * FROM first")
    marts = sqlmarts.discover(spark, where, {"first": ["k"], "second": ["k"]})
    spark.range(3).createOrReplaceTempView("first")
    try:
        with pytest.raises(ValueError, match="both a mart and a view"):
            sqlmarts.frames(spark, marts, at(1))
        assert spark.table("first").count() == 3
    finally:
        spark.catalog.dropTempView("first")
    assert [tuple(r) for r in sqlmarts.frames(spark, marts, at(1))["second"].collect()] == [(1,)]


def test_buckets_do_not_hang_on_time_zone_or_type(spark):
    spark.sql("DROP TABLE IF EXISTS gold_zones")
    merged = lambda target, batch: batch if target is None else target.unionByName(batch).groupBy("at", "n").agg(F.sum("v").alias("v"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = lambda kind: spark.range(40).select(F.timestamp_seconds(F.col("id") * 3600).alias("at"), F.col("id").cast(kind).alias("n"), F.lit(1).cast("long").alias("v"))
    try:
        tables.merge_touched(rows("double"), "gold_zones", ["at", "n"], merged, 7)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        tables.merge_touched(rows("int"), "gold_zones", ["at", "n"], merged, 7)
        assert {(r["n"], r["v"]) for r in spark.table("gold_zones").collect()} == {(float(k), 2) for k in range(40)}
        assert spark.table("gold_zones").count() == 40
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hooks_by_folder_address_and_module(spark, tmp_path, monkeypatch):
    code = "from pyspark.sql import functions as F\n\ndef transform(df, spark, context):\n    return df.withColumn('Total', F.lit('hook')).withColumn('mart', F.lit(context.get('mart')))\n"
    for folder, name in (("hooks", "sums.py"), ("more", "src_tickets.py"), ("lib", "hook_module.py"), ("lib", "no_function.py")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(code if name != "no_function.py" else "x = 1")
    df = spark.createDataFrame([(1, 5)], "k int, total int")
    folders = [f"{tmp_path}/missing", (tmp_path / "hooks").as_uri(), f"{tmp_path}/more"]
    monkeypatch.syspath_prepend(str(tmp_path / "lib"))
    found = {
        "address": transform.find_hook(spark, (tmp_path / "hooks" / "sums.py").as_uri()), "path": transform.find_hook(spark, f"{tmp_path}/hooks/sums.py"), "folder": transform.find_hook(spark, "sums.py", folders),
        "convention": transform.find_hook(spark, "other.py", folders, "src", "tickets"), "module": transform.find_hook(spark, "hook_module"), "file as module": transform.find_hook(spark, "hook_module.py", folders), "function": transform.find_hook(spark, "hook_module:transform"),
    }
    for how, hook in found.items():
        out = transform.layered(df, hook, {"mart": how})
        assert out.columns == ["k", "Total", "mart"] and [tuple(r) for r in out.collect()] == [(1, "hook", how)], how
    for nothing in ("none.py", "no.such.module", f"{tmp_path}/none.py"):
        assert transform.find_hook(spark, nothing, folders) is None
    with pytest.raises(AttributeError):
        transform.find_hook(spark, "no_function")
    assert transform.layered(df, None, {}) is df


def test_a_transform_stands_above_sql_and_sql_above_null(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS gold_layers")
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "layers.py").write_text("def transform(df):\n    return df.selectExpr('k', 'plain', \"'hook'\" + ' AS OWN')\n")
    where = written(tmp_path / "m", layers="SELECT 1 AS k, 'sql' AS own, 'sql' AS plain")
    marts = sqlmarts.discover(spark, where, {"layers": ["k"]}, hooks=[f"{tmp_path}/h"], external={"layers": ["plain", "nothing"]})
    assert graph.refresh(spark, marts, at(1)) == {"layers": "ok"}
    row = spark.table("gold_layers").first()
    assert (row["k"], row["OWN"], row["plain"], row["nothing"]) == ("1", "hook", "sql", None)
    assert sqlmarts.frames(spark, marts, at(1))["layers"].columns == ["k", "plain", "OWN", "nothing"]
