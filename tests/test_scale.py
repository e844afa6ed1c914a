"""Bucketed merges, repeated batches with null keys, names in other cases, page shares, split text, watermarks."""

import gzip
import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from siltlake.operators import merge, reconcile, transform
from siltlake.plans import silver
from siltlake.sinks import state, tables
from siltlake.sources import files, paged

SHAPE = "id string, updated string, v string"


def at(text):
    return F.lit(text).cast("timestamp")


def test_names_in_other_cases(spark):
    one = spark.createDataFrame([(1, "a")], "id long, name string")
    two = spark.createDataFrame([("b", 2, 7)], "Name string, ID long, New long")
    assert sorted(map(tuple, merge.append(one, two).collect())) == [(1, "a", None), (2, "b", 7)]
    assert merge.append(one, two).columns == ["id", "name", "New"]
    assert sorted(map(tuple, merge.upsert(one, two.withColumn("ID", F.lit(1).cast("long")), ["id"]).collect())) == [(1, "b", 7)]
    with pytest.raises(ValueError):
        merge.append(one, spark.createDataFrame([(1, 2)], ["x", "y"]).toDF("A", "a"))


@pytest.mark.parametrize("strategy", ["scd1", "scd2"])
def test_null_keys_grow_nothing(spark, strategy):
    batch = spark.createDataFrame([(None, "2024-01-01", "a"), ("1", "2024-01-01", "b")], SHAPE)
    table = None
    for _ in range(3):
        table = merge.apply(strategy, table, batch, ["id"], "updated", at("2024-06-01"))
    assert sorted((r["id"] or "", r["v"]) for r in table.collect()) == [("", "a"), ("1", "b")]
    changed = spark.createDataFrame([(None, "2024-02-01", "c")], SHAPE)
    after = merge.apply(strategy, table, changed, ["id"], "updated", at("2024-07-01")).where("id IS NULL AND _is_current = 'Y'").collect()
    assert [r["v"] for r in after] == ["c"]
    assert merge.changed(batch, table, ["id"]).count() == 0
    assert merge.delta(batch.withColumn("_updated_at", at("2024-01-01")), table, ["id"]).count() == 0


def test_columns_of_one_sanitised_name(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["My Col", "my_col", "MY-COL"])
    target = spark.createDataFrame([("x",)], "my_col string").schema
    out = reconcile.reconcile(df, target)
    assert out.columns == ["my_col", "my_col_3"] or sorted(out.first()) == ["a", "b", "c"]


def rows_of(df):
    return sorted(map(str, df.drop(tables.BUCKET).collect()))


@pytest.mark.parametrize("strategy", ["scd1", "scd2"])
def test_bucketed_merges_equal_whole_ones(spark, strategy):
    name, whole = f"bucketed_{strategy}", None
    run = at("2024-06-01")
    merged = lambda target, rows: merge.apply(strategy, target, rows, ["id"], "updated", run)
    batches = [
        spark.createDataFrame([(str(i), "2024-01-01", "a") for i in range(40)] + [(None, "2024-01-01", "n")], SHAPE),
        spark.createDataFrame([("3", "2024-02-01", "b"), ("99", "2024-02-01", "c"), (None, "2024-02-01", "m")], SHAPE),
        spark.createDataFrame([("3", "2024-03-01", "d", 5)], SHAPE + ", extra int"),
    ]
    for batch in batches:
        before = {} if whole is None else {r[tables.BUCKET]: r["f"] for r in spark.table(name).select(tables.BUCKET, F.input_file_name().alias("f")).collect()}
        tables.merge_touched(batch, name, ["id"], merged, 8)
        now = merged(whole, batch)
        whole = spark.createDataFrame(now.collect(), now.schema)
        spark.catalog.refreshTable(name)
        table = spark.table(name).select(*whole.columns, tables.BUCKET)
        assert rows_of(table) == rows_of(whole)
        after = {r[tables.BUCKET]: r["f"] for r in spark.table(name).select(tables.BUCKET, F.input_file_name().alias("f")).collect()}
        if before:
            touched = sum(before[b] != after[b] for b in before)
            assert 1 <= touched <= batch.count()


def test_page_shares_repeat_nothing(spark):
    def fetch(query):
        at = query["offset"]
        return {"result": [{"n": i} for i in range(at, min(at + query["limit"], 47))]}

    pages = paged.OffsetPages(fetch, size=10)
    shares = pages.shares(5, 2)
    assert shares == [{"first": 0, "last": 10}, {"first": 20, "last": 30}, {"first": 40}]
    assert sorted(r["n"] for s in shares for r in pages.rows(s)) == list(range(47))
    numbered = paged.OffsetPages(lambda q: {"result": [{"n": i} for i in range(10 * q["page"] - 10, min(10 * q["page"], 47))]}, 10, "page", numbered=True)
    assert sorted(r["n"] for s in numbered.shares(5, 3) for r in numbered.rows(s)) == list(range(47))
    with pytest.raises(ValueError):
        paged.read_paged(spark, pages, "n int", [{"first": 0}, {"first": 20}])


def test_http_headers_gzip_and_busy_answers():
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(dict(self.headers))
            busy = len(seen) < 8
            body = gzip.compress(json.dumps({"ok": True}).encode())
            self.send_response(429 if busy else 200)
            self.send_header("Retry-After", "0")
            self.send_header("Content-Length", "0" if busy else str(len(body)))
            self.end_headers()
            self.wfile.write(b"" if busy else body)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = paged.HttpJson(f"http://127.0.0.1:{server.server_port}/x", headers=paged.basic("u", "p") | paged.api_key("k"), pause=lambda s: None)
        assert client({"a": 1}) == {"ok": True} and len(seen) == 8
        assert seen[0]["Authorization"] == "Basic dTpw" and seen[0]["X-API-Key".title()] == "k"
    finally:
        server.shutdown()


def test_text_lines_over_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_text("x\r\ny")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        out = files.text_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        assert [r["line_content"] for r in out.where("source_file LIKE '%a.txt'").orderBy("line_number").collect()] == lines
        assert [(r["line_number"], r["line_content"]) for r in out.where("source_file LIKE '%b.txt'").orderBy("line_number").collect()] == [(1, "x"), (2, "y")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_files_can_be_split(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + "".join(f"{i},x\n" for i in range(500)))
    assert files.csv(spark, str(tmp_path / "t.csv"), multiline=False).count() == files.csv(spark, str(tmp_path / "t.csv")).count() == 500


def test_a_broken_watermark_write_leaves_the_one_before(spark, tmp_path):
    root = str(tmp_path)
    state.write_watermark(spark, root, "s", "t", "2024-01-01 00:00:00", "SUCCESS", 1, "x")
    state.write_watermark(spark, root, "s", "t", "2024-02-01 00:00:00", "SUCCESS", 1, "x")
    (tmp_path / "s" / "t" / f"{state.VERSION}99999999999999999999").mkdir()  # a write that did not end
    assert state.read_watermark(spark, root, "s", "t") == "2024-02-01 00:00:00"
    state.write_watermark(spark, root, "s", "u", "2024-03-01 00:00:00", "SUCCESS", 1, "x")
    assert sorted(r["last_load_date"] for r in state.all_watermarks(spark, root).collect()) == ["2024-02-01 00:00:00", "2024-03-01 00:00:00"]


def test_tables_without_landed_data_are_skipped(spark, tmp_path):
    load = silver.Load("s", "nothing_here", ["id"], ["updated"])
    assert silver.run(spark, f"{tmp_path}/landing/nothing_here", f"{tmp_path}/states", load, "2024-06-01 00:00:00") is None
    assert silver.run_all(spark, f"{tmp_path}/landing", f"{tmp_path}/states", [load], "2024-06-01 00:00:00") == {"nothing_here": "skipped: nothing landed"}


def test_bucketed_loads(spark, tmp_path):
    landing, states = f"{tmp_path}/landing", f"{tmp_path}/states"
    load = silver.Load("s", "bucketed_load", ["id"], ["updated"], buckets=4)
    for day, v in (("2024-01-01", "a"), ("2024-01-02", "b")):
        tables.land(spark.createDataFrame([("1", day, v), (day, day, v)], SHAPE), landing, "s", "bucketed_load", "r", f"{day} 00:00:00")
        assert silver.run(spark, landing, states, load, "2024-06-01 00:00:00") == 2
    assert silver.run(spark, landing, states, load, "2024-06-01 00:00:00") == 0
    assert sorted((r["id"], r["v"]) for r in spark.table("tbl_bucketed_load").collect()) == [("1", "b"), ("2024-01-01", "a"), ("2024-01-02", "b")]


def test_metadata_and_schema_lines(spark):
    df = spark.createDataFrame([("1", "x", "f")], "id string, _raw_payload string, _file_name string")
    assert transform.run(df, transform.Transform(keys=["id"], order="id"), at("2024-06-01")).columns[0] == "id"
    assert not {"_raw_payload", "_file_name"} & set(transform.run(df, transform.Transform(keys=["id"], order="id"), at("2024-06-01")).columns)
    assert transform.schema_lines(df)[1] == "id: string"
