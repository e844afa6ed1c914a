"""Runs that break off: streams of paged services, scripts with a time limit, the ledger of loaded files."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from siltlake.plans import initial, sqlrun
from siltlake.sources import paged_stream

AT = "2024-06-01 00:00:00"


class Service:
    """Records by time in a file, so that workers and driver see the same; it takes its bounds loosely, both ends included."""

    def __init__(self, path):
        self.path = path

    def all(self):
        with open(self.path) as f:
            return json.load(f)

    def rows(self, query):
        yield from (r for r in self.all() if r["site"] == query["site"] and query["low"] <= r["at"] <= query["high"])

    def newest(self, share):
        with open(f"{self.path}.until") as f:
            return f.read()


def grow(service, days):
    rows = [{"id": f"{site}{d}", "site": site, "at": f"2024-01-{d:02d}T00:00:00"} for site in "ab" for d in range(1, days + 1)]
    with open(service.path, "w") as f:
        json.dump(rows, f)
    with open(f"{service.path}.until", "w") as f:
        f.write(f"2024-01-{days:02d}T00:00:00")


def test_a_stream_that_breaks_off_resumes_without_loss_or_repeats(spark, tmp_path):
    service = Service(str(tmp_path / "service.json"))
    shares = {"a": {"site": "a"}, "b": {"site": "b"}}
    out, fail = [], {"on": None}

    def step(batch, n):
        rows = [r["id"] for r in batch.collect()]
        if fail["on"] == n:
            raise RuntimeError("broken off")
        out.extend(rows)

    def once(shares=shares):
        df = paged_stream.stream(spark, service, "id string, site string, at string", shares, service.newest, "2024-01-01T00:00:00", days=3, stamp="at")
        query = df.writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()

    grow(service, 10)
    once({"a": {"site": "a"}})
    assert sorted(out) == sorted(f"a{d}" for d in range(1, 10))  # the newest time itself comes with the next batch
    grow(service, 15)
    fail["on"] = 1
    with pytest.raises(Exception, match="broken off"):
        once({"a": {"site": "a"}})
    grow(service, 20)
    fail["on"] = None
    once()  # a share that is new, too
    once()
    assert sorted(out) == sorted(f"{s}{d}" for s in "ab" for d in range(1, 20))
    offsets = [p for p in os.listdir(tmp_path / "checkpoint" / "offsets") if p.isdigit()]
    assert json.loads((tmp_path / "checkpoint" / "offsets" / max(offsets, key=int)).read_text().splitlines()[-1])["b"] == "2024-01-20T00:00:00"


def test_windows_of_a_share_are_read_by_tasks_of_their_own():
    reader = paged_stream.PagedStreamReader(None, {"a": {}, "b": {}}, lambda s: "2023-01-01T00:00:00", "2024-01-01T00:00:00", 2, None)
    assert reader.latestOffset() == reader.initialOffset()
    spans = reader.partitions({"a": "2024-01-03T00:00:00"}, {"a": "2024-01-06T00:00:00", "b": "2024-01-02T00:00:00"})
    assert [(s.share, s.low[8:10], s.high[8:10]) for s in spans] == [("a", "03", "05"), ("a", "05", "06"), ("b", "01", "02")]


def test_a_slow_statement_ends_in_time_and_names_itself(spark):
    slow = "SELECT 1 AS a; SELECT sum(sqrt(x.id * y.id)) AS s FROM range(20000000) x CROSS JOIN range(20000) y; SELECT 3 AS c"
    began = time.time()
    with pytest.raises(sqlrun.StatementTimeout, match="statement 2 took more than 3 seconds: SELECT sum") as e:
        sqlrun.run(spark, slow.rpartition(";")[0], seconds=3)
    assert time.time() - began < 30 and e.value.index == 2 and isinstance(e.value, TimeoutError)
    with pytest.raises(sqlrun.StatementTimeout, match="statement 1"):  # a command, and then a query that never runs
        sqlrun.run(spark, "CREATE TABLE t_slow USING parquet AS SELECT sum(sqrt(x.id * y.id)) AS s FROM range(20000000) x CROSS JOIN range(20000) y; SELECT 1 AS a", seconds=3)
    assert [tuple(r) for r in sqlrun.run(spark, "SELECT 1 AS a; SELECT id FROM range(5)", most=3, seconds=60).collect()] == [(0,), (1,), (2,)]
    with pytest.raises(sqlrun.StatementError, match="statement 2 failed") as e:
        sqlrun.run(spark, "SELECT 1; SELECT nope FROM nowhere", seconds=60)
    assert e.value.index == 2 and not isinstance(e.value, TimeoutError)
    assert sqlrun.run(spark, "SELECT 1; DROP TABLE IF EXISTS no_such_table", seconds=60).columns == []


@pytest.mark.parametrize("name", ["{m}.csv", "{m}/one.csv", "{m}.parquet", "{m}"])
def test_the_default_names_are_found_and_loaded_once(spark, tmp_path, name):
    mart = "m" + "".join(c for c in name if c.isalpha())
    spark.sql(f"DROP TABLE IF EXISTS gold_{mart}")
    folder, ledger = tmp_path / "exports", str(tmp_path / "ledger")
    place = folder / name.format(m=mart)
    place.parent.mkdir(parents=True)
    if name.endswith("parquet"):
        spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string").write.parquet(str(place))
    else:
        place.write_text("id,v\n1,a\n2,b\n")
    at = F.lit(AT).cast("timestamp")
    n = initial.load_new(spark, ledger, str(folder), mart, ["id"], at)
    assert n >= 1 and sorted((r["id"], r["v"]) for r in spark.table(f"gold_{mart}").collect()) == [("1", "a"), ("2", "b")]
    assert initial.load_new(spark, ledger, str(folder), mart, ["id"], at) == 0
    assert initial.load_new(spark, ledger, str(folder), mart, ["id"], at, reload=True) == n
    assert initial.load_new(spark, ledger, str(folder), "nothing_here", ["id"], at) == 0


def test_changed_files_are_new_and_a_load_that_fails_is_not_noted(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS gold_led")
    folder, ledger, at = tmp_path / "exports", str(tmp_path / "ledger"), F.lit(AT).cast("timestamp")
    (folder / "led").mkdir(parents=True)
    (folder / "led" / "a.csv").write_text("id,v\n1,a\n")
    boom = lambda df: df.withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        initial.load_new(spark, ledger, str(folder), "led", ["id"], at, hook=boom)
    assert initial.load_new(spark, ledger, str(folder), "led", ["id"], at, buckets=4) == 1
    (folder / "led" / "b.csv").write_text("id,v\n2,b\n")
    assert initial.load_new(spark, ledger, str(folder), "led", ["id"], at, buckets=4) == 1
    (folder / "led" / "a.csv").write_text("id,v\n1,changed\n")
    assert initial.load_new(spark, ledger, str(folder), "led", ["id"], at, buckets=4) == 1
    assert sorted((r["id"], r["v"]) for r in spark.table("gold_led").collect()) == [("1", "changed"), ("2", "b")]
    assert initial.archive(spark, ledger, str(folder), "led") == 2
    assert sorted(p.name for p in (folder / "_archived" / "led").glob("*.csv")) == ["a.csv", "b.csv"]
    assert initial.load_new(spark, ledger, str(folder), "led", ["id"], at) == 0  # the archive is for tables that are empty
    spark.sql("DROP TABLE gold_led")
    assert initial.load_new(spark, ledger, str(folder), "led", ["id"], at) == 2 and spark.table("gold_led").count() == 2
