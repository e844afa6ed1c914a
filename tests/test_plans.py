import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltlake.operators import tokens, transform
from siltlake.plans import config, graph, initial, silver, sqlrun
from siltlake.sinks import state, tables
from siltlake.sources import files, jdbc, paged
from siltlake.streaming import streams

AT = "2024-06-01 00:00:00"


def test_config():
    assert config.interpolate({"a": ["{env}/x", {"b": "{other}"}]}, {"env": "dev"}) == {"a": ["dev/x", {"b": "{other}"}]}
    assert config.setting("k", {"k": 1}, {"k": 2}) == 1 and config.setting("k", {}, {"k": 2}) == 2 and config.setting("no_such", {}, {}, 3) == 3
    assert config.keys_of("keys", {}, {"pk": "a, b"}) == ["a", "b"]
    with pytest.raises(ValueError):
        config.keys_of("keys", {}, {})
    assert config.targets({}, {"targets": "mysql"}, {}) == ["lake", "mysql"] and config.targets({}, {}, {}) == ["lake"]


def test_statements():
    assert sqlrun.statements("WITH a AS (SELECT 1) -- x; y\n/* ; */ SELECT * FROM a;") == ["WITH a AS (SELECT 1) \n SELECT * FROM a"]
    assert len(sqlrun.statements("SELECT ';'; SELECT \"a;b\"; SELECT `c;d`")) == 3
    assert sqlrun.statements(" ;; ") == []


def test_sql_runner(spark):
    out = sqlrun.run(spark, "CREATE OR REPLACE TEMP VIEW {{v}} AS SELECT id FROM range(10); SELECT * FROM ${v} WHERE id > :low", values={"low": 3}, names={"v": "numbers"}, most=4)
    assert out.count() == 4
    with pytest.raises(RuntimeError, match="statement 2"):
        sqlrun.run(spark, "SELECT 1; SELECT nope FROM nowhere")
    with pytest.raises(ValueError):
        sqlrun.fill("${v}", {"v": "a; DROP TABLE b"})


def mart(name, *reads):
    return graph.Mart(name, reads, ["k"], lambda *frames: frames[0])


def test_graph_order():
    marts = {m.name: m for m in (mart("summary_kpi", "feedbacks"), mart("feedbacks", "interactions"), mart("interactions", "tbl_x"))}
    assert graph.order(marts) == ["interactions", "feedbacks", "summary_kpi"]
    assert graph.order(marts, ["feedbacks"]) == ["interactions", "feedbacks"]
    with pytest.raises(Exception, match="(?i)cycle"):
        graph.order({m.name: m for m in (mart("a", "b"), mart("b", "a"))})


def test_refresh_merges_and_isolates_failures(spark):
    spark.sql("DROP TABLE IF EXISTS gold_one")
    rows = lambda values: spark.createDataFrame(values, "k string, v string").createOrReplaceTempView("tbl_src")
    marts = {"one": graph.Mart("one", ["tbl_src"], ["k"], lambda src, run_at: src, incremental=True), "bad": graph.Mart("bad", ["tbl_src"], ["k"], lambda *_: 1 / 0), "after": mart("after", "bad")}
    rows([("1", "a"), ("2", "b")])
    assert graph.refresh(spark, marts, F.lit("2024-01-01 00:00:00").cast("timestamp"), ["one"]) == {"one": "ok"}
    rows([("2", "B"), ("3", "c"), ("1", "a")])
    with pytest.raises(RuntimeError, match="bad"):
        graph.refresh(spark, marts, F.lit(AT).cast("timestamp"))
    out = {r["k"]: r for r in spark.table("gold_one").collect()}
    assert {k: r["v"] for k, r in out.items()} == {"1": "a", "2": "B", "3": "c"}
    assert str(out["1"]["_updated_at"]) == "2024-01-01 00:00:00" and str(out["2"]["_updated_at"]) == AT
    assert str(out["2"]["_inserted_at"]) == "2024-01-01 00:00:00" and str(out["3"]["_inserted_at"]) == AT


@pytest.mark.parametrize("strategy", ["scd1", "scd2"])
def test_silver_runs_are_incremental_and_repeatable(spark, tmp_path, strategy):
    spark.sql(f"DROP TABLE IF EXISTS tbl_item_{strategy}")
    land, states = str(tmp_path / "land"), str(tmp_path / "state")
    put = lambda rows, at: tables.land(spark.createDataFrame(rows, "id string, v string, updated string"), land, "s", "item", "r", at)
    load = silver.Load("s", f"item_{strategy}", ["id"], ["updated"], strategy, transform=transform.Transform())
    put([("1", "a", "2024-01-01T00:00:00Z"), ("1", "old", "2023-01-01T00:00:00Z"), ("2", "b", "2024-01-01T00:00:00Z")], "2024-01-01 00:00:00")
    assert silver.run(spark, land, states, load, AT) == 3
    assert silver.run(spark, land, states, load, AT) == 0
    put([("2", "B", "2024-02-01T00:00:00Z"), ("3", "c", "2024-02-01T00:00:00Z")], "2024-02-01 00:00:00")
    assert silver.run(spark, land, states, load, AT) == 2
    now = spark.table(f"tbl_item_{strategy}")
    current = sorted((r["id"], r["v"]) for r in now.where("_is_current = 'Y'").collect())
    assert current == [("1", "a"), ("2", "B"), ("3", "c")]
    assert now.count() == (3 if strategy == "scd1" else 4)
    assert state.read_watermark(spark, states, "s", f"item_{strategy}") == "2024-02-01 00:00:00"
    before = sorted(map(tuple, now.drop("_updated_at", "_inserted_at").collect()), key=str)
    silver.run(spark, land, states, load, AT, full=True)  # a repeated load changes nothing
    assert sorted(map(tuple, spark.table(f"tbl_item_{strategy}").drop("_updated_at", "_inserted_at").collect()), key=str) == before
    assert state.all_watermarks(spark, states).count() == 1


def test_watermark_sentinels_and_repair(spark, tmp_path):
    with pytest.raises(ValueError):
        state.write_watermark(spark, str(tmp_path), "s", "t", "9999-01-01 00:00:00", "SUCCESS", 0, AT)
    assert state.read_watermark(spark, str(tmp_path), "s", "none") == state.BEGINNING
    assert state.repair('{"a": 1}{\n"b": 2}\n[{"c": 3}]') == [{"a": 1}, {"b": 2}, {"c": 3}]
    state.log_run(spark, str(tmp_path / "log"), [{"run_id": "1", "table_name": "t", "status": "ok", "records": 3}])
    assert spark.read.json(str(tmp_path / "log")).first()["records"] == 3


def test_initial_load(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS gold_first")
    path = tmp_path / "load.csv"
    path.write_text('Id,Full Name,Created At\n1,"Ann\nB ""x""",05/06/2024\n1,later,06/06/2024\n2,Bob,\n')
    spark.sql("CREATE TABLE gold_first USING parquet AS SELECT '9' AS id, 'z' AS full_name, 'k' AS created_at, 's' AS score, current_timestamp() AS _updated_at, current_timestamp() AS _inserted_at")
    out = initial.load(spark, str(path), "first", ["id"], F.lit(AT).cast("timestamp"), "full_name", tokens.digest_tokenizer())
    rows = {r["id"]: r for r in out.collect()}
    assert set(rows) == {"1", "2", "9"} and rows["1"]["created_at"] == "2024-06-06 00:00:00" and rows["1"]["score"] is None
    assert rows["2"]["full_name"] == tokens.digest_tokenizer()(["Bob"])[0]


def test_publish_swaps_and_guards(spark):
    spark.sql("DROP TABLE IF EXISTS gold_pub")
    tables.publish(spark.createDataFrame([(1, "a")], "k int, v string"), "gold_pub", ["k"])
    tables.publish(spark.table("gold_pub").unionByName(spark.createDataFrame([(2, "b")], "k int, v string")), "gold_pub", ["k"])
    assert spark.table("gold_pub").count() == 2 and spark.table("gold_pub_old").count() == 1
    with pytest.raises(ValueError):
        tables.publish(spark.range(1), "other", ["id"])
    with pytest.raises(ValueError):
        tables.publish(spark.createDataFrame([(1,), (1,)], "k int"), "gold_pub", ["k"])
    tables.drop_columns(spark, "gold_pub", ["v"])
    assert spark.table("gold_pub").columns == ["k"]
    spark.sql("ALTER TABLE gold_pub RENAME TO gold_pub_gone")  # as if a swap broke off
    assert tables.current(spark, "gold_pub") is not None


def test_csv_keeps_lines_in_quotes(spark, tmp_path):
    (tmp_path / "tickets.csv").write_text('id,subject,description,status\n101,"Login Issue","First.\n\nSecond with \\"quoted\\" words.","open"\n102,b,c,d\n')
    rows = files.csv(spark, str(tmp_path / "tickets.csv")).orderBy("id").collect()
    assert len(rows) == 2 and rows[0]["description"] == 'First.\n\nSecond with "quoted" words.'
    (tmp_path / "bare.tsv").write_text("1\t2\n")
    assert files.csv(spark, str(tmp_path / "bare.tsv"), header=False, sep="\t").columns == ["col_0", "col_1"]


def test_fetch_modes(spark, tmp_path):
    import os

    for n, (name, hour) in enumerate([("conversations_1.csv", 9), ("conversations_2.csv", 11), ("users_1.csv", 10)]):
        (tmp_path / name).write_text(f"id\nrow{n}\n")
        os.utime(tmp_path / name, (1_700_000_000 + hour * 3600,) * 2)
    ids = lambda **o: sorted(r["id"] for r in files.read(spark, "csv", **o).collect())
    root = str(tmp_path)
    assert ids(path=root, table="conversations", mode="latest") == ["row1"]
    assert ids(path=root, table="conversations") == ["row0", "row1"]
    assert ids(path=f"{root}/*s_1.csv") == ["row0", "row2"]
    stamp = datetime.utcfromtimestamp(1_700_000_000 + 10 * 3600).strftime("%Y-%m-%dT%H:%M:%S")
    assert ids(path=root, table="conversations", after=stamp) == ["row1"]
    assert ids(path=root, table="conversations", mode="latest", until=stamp) == ["row0"]


def test_json_and_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "b.json").write_text(json.dumps({"data": [{"a": 1}, {"a": 2}, {"a": 3}]}, indent=1))
    (tmp_path / "c.json").write_text(json.dumps([{"a": 5}]))
    assert [files.json_records(spark, str(tmp_path / f"{n}.json")).count() for n in "abc"] == [2, 3, 1]
    (tmp_path / "d d.json").write_text('\n  \n{"a": 7, "b": "x"}\n')
    (tmp_path / "e.json").write_text("")
    mixed = files.json_records(spark, str(tmp_path / "*.json"))
    assert sorted((r["a"], r["b"]) for r in mixed.collect() if r["b"] is None) == [(1, None), (1, None), (2, None), (2, None), (3, None), (5, None)]
    assert [r["a"] for r in mixed.where("b = 'x'").collect()] == [7]
    (tmp_path / "t.txt").write_text("x\r\n\ny\n")
    assert [(r["line_number"], r["line_content"]) for r in files.text_lines(spark, str(tmp_path / "t.txt")).orderBy("line_number").collect()] == [(1, "x"), (2, ""), (3, "y")]


class Numbers:
    """A service of 25 records in pages by offset."""

    def __call__(self, query):
        return {"result": [{"id": i} for i in range(25)][query["offset"] : query["offset"] + query["limit"]]}


class Linked:
    def __call__(self, query):
        pages = {None: ([1, 2], "p2"), "p2": ([3], None)}
        ids, after = pages[query.get("cursor")]
        return {"data": [{"id": str(i), "type": "t", "attributes": {"score": i, "at": None if i == 3 else f"2024-0{i}-01"}} for i in ids], "links": {"next": after}}


def test_paged_sources(spark):
    assert paged.read_paged(spark, paged.OffsetPages(Numbers(), size=10), "id long").count() == 25
    linked = paged.CursorPages(Linked(), records="data", next="links.next", unwrap=("attributes",))
    df = paged.read_paged(spark, linked, "id string, score int, at string", shares=[{"s": 1}, {"s": 2}])
    assert df.rdd.getNumPartitions() == 2 and df.count() == 6
    kept = df.where(paged.between(F.col("at"), "2024-02-01", None)).select("id").distinct().collect()
    assert sorted(r["id"] for r in kept) == ["2", "3"]


def test_time_windows_do_not_overlap():
    out = paged.time_windows(datetime(2024, 1, 1), datetime(9999, 1, 1), 15, now=datetime(2024, 2, 10))
    assert [b for _, b in out[:-1]] == [a for a, _ in out[1:]] and out[-1][1] == datetime(2024, 2, 10) and len(out) == 3


def test_token_cache():
    now, asked = [0.0], []
    cache = paged.TokenCache(lambda: (asked.append(1) or f"t{len(asked)}", 100.0), clock=lambda: now[0])
    assert (cache(), cache()) == ("t1", "t1")
    now[0] = 50
    assert cache() == "t2" and cache(True) == "t3"


def test_jdbc_text():
    assert jdbc.incremental_query("t", "u", "1900-01-01", "9999-01-01") == "SELECT * FROM t"
    assert jdbc.incremental_query("t", "u", "2024-01-01", "2024-02-01", "a = 1") == "SELECT * FROM t WHERE (a = 1) AND u > '2024-01-01' AND u <= '2024-02-01'"
    assert paged.odata_filter("u", "1900-01-01", "9999-12-31") == "" and paged.odata_filter("u", None, None, "a eq 1") == "(a eq 1)"
    assert paged.odata_filter("u", "2024-01-01 10:00:00", "2024-02-01T00:00:00+02:00", "a eq 1") == "(a eq 1) and u gt 2024-01-01T10:00:00Z and u le 2024-01-31T22:00:00Z"
    assert jdbc.swap_statements("gold_x", ["k"])[1] == "RENAME TABLE gold_x TO gold_x_old, gold_x_staging TO gold_x"
    with pytest.raises(ValueError):
        jdbc.swap_statements("other")


def test_merge_stream(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS tbl_streamed")
    shape = "id string, v string, updated string"
    put = lambda rows: spark.createDataFrame(rows, shape).write.mode("append").parquet(str(tmp_path / "in"))
    put([("1", "a", "2024-01-01 00:00:00")])
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    go = lambda: streams.merge_stream(streams.landed(spark, str(tmp_path / "in"), schema), "tbl_streamed", ["id"], "updated", "scd2", F.lit(AT).cast("timestamp"), str(tmp_path / "ck")).awaitTermination()
    go()
    put([("1", "b", "2024-02-01 00:00:00"), ("2", "c", "2024-02-01 00:00:00")])
    go()
    assert sorted((r["id"], r["v"], r["_is_current"]) for r in spark.table("tbl_streamed").collect()) == [("1", "a", "N"), ("1", "b", "Y"), ("2", "c", "Y")]


def test_windowed_counts_leave_late_rows_out(spark, tmp_path):
    shape = "ts timestamp, kind string, value double"
    put = lambda rows: spark.createDataFrame([(datetime.fromisoformat(t), k, v) for t, k, v in rows], shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put([("2024-01-01T00:01:00", "a", 1.0), ("2024-01-01T02:00:00", "a", 1.0)])
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    counted = streams.windowed_counts(streams.landed(spark, str(tmp_path / "in"), schema), "ts", ["kind"], "10 minutes", "30 minutes")
    for late in (None, [("2024-01-01T00:02:00", "a", 5.0), ("2024-01-01T03:00:00", "a", 1.0)]):
        if late:
            put(late)
        counted.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("start").collect()
    assert [(str(r["start"])[11:16], r["n"], r["total"]) for r in rows][:1] == [("00:00", 1, 1.0)]
