import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltlake.operators import dedup, flatten, merge, reconcile, tokens, transform, windows

T0 = T1 = None


@pytest.fixture(autouse=True, scope="module")
def times(spark):
    global T0, T1
    T0, T1 = (F.lit(x).cast("timestamp") for x in ("2024-01-01 00:00:00", "2024-06-01 00:00:00"))
BASE = [("1", "a", "2024-01-01 00:00:00"), ("2", "b", "2024-01-01 00:00:00"), ("3", "c", "2024-01-05 00:00:00")]
BATCH = [("1", "a", "2024-01-01 00:00:00"), ("2", "B", "2024-01-03 00:00:00"), ("3", "C", "2024-01-02 00:00:00"), ("4", "d", "2024-01-03 00:00:00")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, v string, updated string")


def base(spark):
    return merge.audited(frame(spark, BASE), "updated", T0)


def state(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_dedup_latest_and_earliest(spark):
    df = spark.createDataFrame([(1, "2024", "x"), (1, "2025", "y"), (1, None, "z"), (2, None, "n"), (2, None, "n")], "k int, o string, v string")
    assert state(dedup.latest(df, ["k"], ["o"]), "k", "v") == [(1, "y"), (2, "n")]
    assert state(dedup.latest(df, ["k"], ["o"], earliest=True), "k", "v") == [(1, "z"), (2, "n")]
    shuffled = df.repartition(7, "v")
    assert state(dedup.latest(shuffled, ["k"], ["o"]), "k", "o", "v") == state(dedup.latest(df, ["k"], ["o"]), "k", "o", "v")


def test_scd1(spark):
    out = merge.scd1(base(spark), frame(spark, BATCH), ["id"], "updated", T1)
    assert state(out, "id", "v") == [("1", "a"), ("2", "B"), ("3", "c"), ("4", "d")]
    stamps = {r["id"]: (r["_inserted_at"], r["_updated_at"]) for r in out.collect()}
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    assert stamps == {"1": (old, old), "2": (old, new), "3": (old, old), "4": (new, new)}


def test_scd1_twice_is_once(spark):
    once = merge.scd1(base(spark), frame(spark, BATCH), ["id"], "updated", T1)
    twice = merge.scd1(once, frame(spark, BATCH), ["id"], "updated", T1)
    assert state(once, *once.columns) == state(twice, *once.columns)


def test_scd2(spark):
    out = merge.scd2(base(spark), frame(spark, BATCH), ["id"], "updated", T1)
    assert state(out, "id", "v", "_is_current") == [("1", "a", "Y"), ("2", "B", "Y"), ("2", "b", "N"), ("3", "c", "Y"), ("4", "d", "Y")]
    two = {r["_is_current"]: r for r in out.where("id = '2'").collect()}
    assert two["N"]["_valid_to"] == two["Y"]["_valid_from"] == dt.datetime(2024, 1, 3)
    again = merge.scd2(out, frame(spark, BATCH), ["id"], "updated", T1)
    assert state(out, *out.columns) == state(again, *out.columns)


def test_scd2_opens_a_key_with_closed_rows_alone(spark):
    closed = base(spark).withColumn("_is_current", F.lit("N"))
    out = merge.scd2(closed, frame(spark, BATCH[:1]), ["id"], "updated", T1)
    assert out.where("id = '1'").count() == 2 and out.where("_is_current = 'Y'").count() == 1


def test_new_columns_and_null_keys_survive_merges(spark):
    target = base(spark).unionByName(merge.audited(frame(spark, [(None, "n", None)]), "updated", T0))
    batch = frame(spark, BATCH[1:2]).withColumn("extra", F.lit(7))
    for strategy in (merge.scd1, merge.scd2):
        out = strategy(target, batch, ["id"], "updated", T1)
        assert out.where("id IS NULL").count() == 1
        assert out.where("extra = 7").count() == 1
        assert out.columns[-1] == "extra" and set(target.columns) < set(out.columns)


def test_upsert_append_and_dispatch(spark):
    a, b = frame(spark, BASE), frame(spark, BATCH)
    assert state(merge.upsert(a, b, ["id"]), "id", "v") == [("1", "a"), ("2", "B"), ("3", "C"), ("4", "d")]
    assert merge.append(a, b).count() == 7
    for name, n in (("scd1", 4), ("scd2", 5), ("overwrite", 4), ("whatever", 7)):
        assert merge.apply(name, base(spark), b, ["id"], "updated", T1).count() == n
    assert merge.apply("scd2", None, b, ["id"], "updated", T1).count() == 4


def test_delta_and_changed(spark):
    shape = "id string, _updated_at string"
    incoming = spark.createDataFrame([("1", "2024-01-02"), ("2", "2024-01-01"), ("3", "2024-01-01"), ("4", "2024-01-01")], shape)
    target = spark.createDataFrame([("1", "2024-01-01", "e"), ("2", "2024-01-01", "e"), ("3", "2024-01-01", None)], shape + ", score string")
    assert state(merge.delta(incoming, target, ["id"], enriched="score"), "id") == [("1",), ("3",), ("4",)]
    assert merge.delta(incoming, None, ["id"]).count() == 4
    assert state(merge.changed(frame(spark, BATCH).drop("updated"), frame(spark, BASE).drop("updated"), ["id"]), "id") == [("2",), ("3",), ("4",)]


def test_transform_steps(spark):
    rows = spark.createDataFrame([("1", "2024-01-01T10:00:00.5Z", "x\u0001y", "12", "true", "src"), ("2", "bad", "keep", "abc", None, "src"), ("3", "2024-01-01", "drop", "1", "0", "src")], "id string, sys_updated_on string, note string, n string, deleted string, _source_system string")
    config = transform.Transform(
        keys=["id"], order="sys_updated_on", illegal="[\u0000-\u0008]", where="note <> 'drop'", casts={"n": "int"}, derived={"twice": "n * 2", "more": "twice + 1"}, renames={"id": "key", "sys_updated_on": "stamp"},
        exclude=["key", "note", "stamp"], external=["hr"], hook=lambda df, spark, context: df.withColumn("by", F.lit(context["table"])),
    )
    out = {r["key"]: r for r in transform.run(rows, config, T1, {"table": "t"}).collect()}
    assert list(out["1"].asDict()) == ["key", "stamp", "n", "deleted", "twice", "more", "by", "hr", "_valid_from", "_valid_to", "_is_current", "_is_deleted", "_inserted_at", "_updated_at"]
    assert (out["1"]["stamp"], out["1"]["n"], out["1"]["more"], out["1"]["by"], out["1"]["_is_deleted"]) == ("2024-01-01 10:00:00", 12, 25, "t", "Y")
    assert (out["2"]["n"], out["2"]["_is_deleted"], out["2"]["_valid_from"]) == (None, "N", dt.datetime(2024, 6, 1))


def test_hooks_by_what_they_take(spark, tmp_path):
    path = tmp_path / "hook.py"
    path.write_text("def transform(df):\n    return df.limit(1)\n")
    df = spark.range(3)
    assert transform.call_hook(transform.load_hook(str(path)), df, {}).count() == 1
    assert transform.call_hook(lambda df, *, context: df.limit(context["n"]), df, {"n": 2}).count() == 2


def test_flatten(spark):
    shape = "id string, detail struct<content:string, entity:array<string>, flags:array<boolean>, resources:array<struct<id:string,name:string>>, citations:array<string>>, items array<struct<n:int,sub:struct<x:int>>>, more array<struct<a:int>>"
    detail = ("c", ["ticket operation", "hardware"], [True, False], [("res_1", "Cisco VPN"), ("res_2", "GlobalProtect")], [])
    df = spark.createDataFrame([("i", detail, [(1, (5,)), (2, None)], [(1,), (None,)]), ("j", ("d", ["x", None], None, None, None), [], None)], shape)
    out = flatten.flatten(df)
    assert out.columns == ["id", "detail_content", "detail_entity", "detail_flags", "detail_resources", "detail_resources_id", "detail_resources_name", "detail_citations", "items_n", "items_sub_x", "more", "more_a"]
    rows = sorted(map(tuple, out.collect()), key=str)
    assert [r[8:10] for r in rows] == [(1, 5), (2, None), (None, None)]
    assert rows[0][2:4] == ("ticket operation, hardware", "True, False")
    assert rows[0][5:8] == ("res_1, res_2", "Cisco VPN, GlobalProtect", None)
    assert rows[0][11] == "1"
    assert rows[2][2] == '["x",null]'


def test_reconcile(spark):
    target = spark.createDataFrame([], "customer_name string, caller_id_name string, sentiment_score double, conversation_start timestamp").schema
    df = spark.createDataFrame([("n", "c", "05/06/2024", "e")], ["Customer Name", "caller_id.name", "conversation_start", "Extra Notes"])
    out = reconcile.reconcile(df, target)
    assert out.columns == ["customer_name", "caller_id_name", "sentiment_score", "conversation_start", "extra_notes"]
    assert tuple(out.first()) == ("n", "c", None, dt.datetime(2024, 5, 6), "e")


def test_resolve_columns_and_probe(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["b", "k", "B2"])
    assert reconcile.resolve_columns(df, ["k"], ["x", "b2"]).columns == ["k", "b", "B2", "x"]
    assert reconcile.probe(spark, "SELECT 1 AS a, 'x' AS b").names == ["a", "b"]


def test_union_of_drifting_batches(spark):
    a, b = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([("x", 2)], "v string, w int")
    assert state(reconcile.union_batches([a, b]), "v", "w") == [("1", None), ("x", 2)]


def test_nearest_preceding_and_lookup(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("u", 2, None), ("u", 3, "b"), ("v", 1, None)], "k string, o int, v string")
    out = windows.nearest_preceding(df, ["k"], ["o"], F.col("v").isNotNull(), {"prior": F.col("v")})
    assert state(out, "k", "o", "prior") == [("u", 1, None), ("u", 2, "a"), ("u", 3, "a"), ("v", 1, None)]
    dim = spark.createDataFrame([("a", 1), ("a", 1)], "id string, x int")
    assert windows.lookup(df, dim, "v", "id", {"x": "y"}).where("y = 1").count() == 1
    assert windows.lookup(df, None, "v", "id", {"x": "y"}).where("y IS NULL").count() == 4


def test_tokenize(spark):
    calls = []
    df = spark.createDataFrame([("a", "p", 1), (None, " ", 2), ("", "q", 3)], "x string, y string, n int").coalesce(1)
    out = tokens.tokenize(df, ["x", "y", "absent"], tokens.digest_tokenizer("s")).collect()
    assert out[0]["x"] == tokens.digest_tokenizer("s")(["a"])[0] and out[1]["x"] is None and out[1]["y"] == " " and out[2]["x"] == ""
    with pytest.raises(ValueError, match="tokens"):
        tokens.with_retries(lambda v: v[:1], ["a", "b"])

    def flaky(values):
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return values

    assert tokens.with_retries(flaky, ["a"], wait=0) == ["a"]
    assert tokens.columns_of('{"a": 1, "b": 2}') == tokens.columns_of("a, b") == tokens.columns_of(["a", "b"]) == ["a", "b"]


def test_dedup_over_a_hot_key_is_an_aggregate(spark):
    """Half of all rows have one key, as many none: a task sends one row of each on, and nothing is sorted by rank."""
    rows = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 4 < 2, "hot").when(F.col("id") % 4 == 2, F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 777).alias("o"), F.col("id").alias("v"))
    for earliest in (False, True):
        found = dedup.latest(rows, ["k"], ["o"], earliest)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "partial_m" in plan
        by = {}
        for r in rows.collect():
            rank = (r["o"] is not None, r["o"] or 0, r["v"])
            if r["k"] not in by or (rank < by[r["k"]] if earliest else rank > by[r["k"]]):
                by[r["k"]] = rank
        assert {r["k"]: (r["o"] is not None, r["o"] or 0, r["v"]) for r in found.collect()} == by


def test_dedup_of_columns_that_cannot_be_ordered(spark):
    df = spark.createDataFrame([(1, 5, {"a": 1}), (1, 7, {"b": 2}), (2, None, None)], "k int, o int, m map<string,int>")
    assert {r["k"]: r["m"] for r in dedup.latest(df, ["k"], ["o"]).collect()} == {1: {"b": 2}, 2: None}
    assert {r["k"]: r["m"] for r in dedup.latest(df, ["k"], ["o"], earliest=True).collect()} == {1: {"a": 1}, 2: None}
    odd = spark.createDataFrame([(1, 2, 3), (1, 4, 5)], "k int, `a.b` int, `c d` int")
    assert [tuple(r) for r in dedup.latest(odd, ["k"], ["a.b"]).collect()] == [(1, 4, 5)]
    assert dedup.latest(df.select("k"), ["k"], []).count() == 2


def twice(spark):
    return frame(spark, [("1", "b", "2024-02-01 00:00:00"), ("1", "c", "2024-03-01 00:00:00"), ("9", "n", "2024-01-01 00:00:00"), (None, "x", "2024-01-01 00:00:00"), (None, "y", "2024-01-02 00:00:00")])


def test_a_key_twice_in_the_batch_is_an_error_or_reduced(spark):
    runs = {
        "scd1": lambda **how: merge.scd1(base(spark), twice(spark), ["id"], "updated", T1, **how),
        "scd2": lambda **how: merge.scd2(base(spark), twice(spark), ["id"], "updated", T1, **how),
        "upsert": lambda **how: merge.upsert(base(spark), merge.audited(twice(spark), "updated", T1), ["id"], "updated", **how),
        "first load": lambda **how: merge.apply("scd2", None, twice(spark), ["id"], "updated", T1, **how),
    }
    for name, run in runs.items():
        with pytest.raises(Exception, match="batch has a key more than once: id=(1|null) comes 2 times"):
            run().collect()
        kept = run(duplicates="latest").where("_is_current = 'Y'").collect()
        by = {r["id"]: r["v"] for r in kept}
        assert len(by) == len(kept), name
        assert (by["1"], by["9"], by[None]) == ("c", "n", "y"), name
    with pytest.raises(ValueError):
        runs["scd1"](duplicates="first")



def test_tokens_leave_other_columns_as_they_are(spark):
    df = spark.createDataFrame([(2**53 + 1, "a", 1, [1, None], dt.datetime(2024, 1, 1, 0, 0, 0, 7)), (None, " ", None, None, None), (3, None, 2**31 - 1, [], None)], "k long, v string, n int, l array<int>, at timestamp")
    found = tokens.tokenize(df, ["v", "n", "missing"], tokens.digest_tokenizer("s")).collect()
    digest = lambda v: tokens.digest_tokenizer("s")([v])[0]
    assert sorted(map(tuple, found), key=repr) == sorted([(2**53 + 1, digest("a"), digest("1"), [1, None], dt.datetime(2024, 1, 1, 0, 0, 0, 7)), (None, " ", None, None, None), (3, None, digest(str(2**31 - 1)), [], None)], key=repr)
    with pytest.raises(Exception, match="tokens for"):
        tokens.tokenize(df, ["v"], lambda values: values[:0]).collect()


def test_keys_that_are_missing(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None)], "k int, v string")
    other = spark.createDataFrame([(1, "a"), (None, None)], "k int, v string")
    assert [tuple(r) for r in merge.missing_keys(left, other, ["k", "v"]).collect()] == [(2, None)]
