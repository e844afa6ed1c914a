"""The registered queries: each operator applied to the driver's tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltlake.functions import exprs
from siltlake.operators import dedup, flatten, merge, reconcile, records, tokens, transform, windows
from siltlake.plans import marts, silver, sqlmarts
from siltlake.sinks import tables
from siltlake.sources import database, files
from siltlake.streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
RUN_AT = "2024-06-01 00:00:00"


def query(sql: str | None = None):
    """Registers a function of (spark, read) under its name; read gives a table by name."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def at(text: str = RUN_AT):
    return F.lit(text).cast("timestamp")


def money(c: str):
    """Doubles as exact text or sums go through decimals."""
    return F.col(c).cast("decimal(18,2)")


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


def line_order(way: str, nulls: str) -> str:
    names = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return ", ".join(f"{n} {way} NULLS {nulls}" for n in names)


LATEST = f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {line_order('DESC', 'LAST')}) AS rn FROM lineitem) WHERE rn = 1"


@query(LATEST)
def dedup_latest(spark, read):
    return dedup.latest(read("lineitem"), LINE_KEY, ["l_shipdate"])


@query(LATEST.replace(line_order("DESC", "LAST"), line_order("ASC", "FIRST")))
def dedup_earliest(spark, read):
    return dedup.latest(read("lineitem"), LINE_KEY, ["l_shipdate"], earliest=True)


@query("SELECT DISTINCT * FROM lineitem")
def dedup_exact(spark, read):
    rows = read("lineitem")
    return dedup.exact(rows.unionByName(rows))


@query(f"SELECT l_returnflag, l_linestatus, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders, sum(l_quantity::DECIMAL(18,2)) AS quantity, sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END)::BIGINT AS discounted FROM ({LATEST}) GROUP BY ALL")
def dedup_kpi(spark, read):
    """The flagship: latest row per key, then a KPI roll-up."""
    rows = dedup.latest(read("lineitem"), LINE_KEY, ["l_shipdate"])
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_orderkey").alias("n_orders"), F.sum(money("l_quantity")).alias("quantity"), F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("discounted")
    )


@query("SELECT user_id, event_type, count(*) AS n, max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS watermark FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL")
def hwm_filter(spark, read):
    rows = silver.increment(read("events"), "ts", "2024-01-15 00:00:00")
    return rows.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.max(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("watermark"))


SHAPES_SQL = """SELECT event_id, CASE event_id % 8
  WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123Z'
  WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' junk'
  WHEN 5 THEN event_type WHEN 6 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-0800' END AS raw FROM events"""


def shapes(read):
    t, s = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    k = F.col("event_id") % 8
    raw = F.when(k == 0, F.concat(t, F.lit("Z"))).when(k == 1, F.concat(t, F.lit(".123Z"))).when(k == 2, F.concat(t, F.lit("+05:30"))).when(k == 3, s).when(k == 4, F.concat(s, F.lit(" junk"))).when(k == 5, F.col("event_type")).when(k == 6, F.concat(t, F.lit("-0800")))
    return read("events").select("event_id", raw.alias("raw"))


@query(f"SELECT event_id, raw, regexp_replace(raw, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})[T ]([0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})([.][0-9]+)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?$', '\\1 \\2') AS standard FROM ({SHAPES_SQL})")
def std_timestamp(spark, read):
    return shapes(read).select("event_id", "raw", exprs.std_timestamp(F.col("raw")).alias("standard"))


MIXED_SQL = """SELECT event_id, date_trunc('second', ts) AS t, CASE event_id % 8
  WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.5Z' WHEN 1 THEN epoch(date_trunc('second', ts))::BIGINT::VARCHAR WHEN 2 THEN (epoch(date_trunc('second', ts))::BIGINT * 1000)::VARCHAR
  WHEN 3 THEN strftime(ts, '%m/%d/%Y %H:%M:%S') WHEN 4 THEN strftime(ts, '%d-%m-%Y %H:%M:%S') WHEN 5 THEN ' NaN ' WHEN 6 THEN ' ' || event_type WHEN 7 THEN strftime(ts, '%Y/%m/%d') END AS raw FROM events"""


@query(f"""SELECT event_id, raw, CASE event_id % 8 WHEN 5 THEN NULL WHEN 6 THEN trim(raw) WHEN 7 THEN strftime(t, '%Y-%m-%d') || ' 00:00:00' ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS conformed FROM ({MIXED_SQL})""")
def conform_timestamp(spark, read):
    k, shown = F.col("event_id") % 8, lambda f: F.date_format("ts", f)
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    raw = (
        F.when(k == 0, F.concat(shown("yyyy-MM-dd'T'HH:mm:ss"), F.lit(".5Z"))).when(k == 1, second.cast("string")).when(k == 2, (second * 1000).cast("string")).when(k == 3, shown("MM/dd/yyyy HH:mm:ss"))
        .when(k == 4, shown("dd-MM-yyyy HH:mm:ss")).when(k == 5, F.lit(" NaN ")).when(k == 6, F.concat(F.lit(" "), "event_type")).when(k == 7, shown("yyyy/MM/dd"))
    )
    return read("events").select("event_id", raw.alias("raw")).select("event_id", "raw", exprs.conform_timestamp(F.col("raw")).alias("conformed"))


NUMBERS_SQL = "SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS s, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events"


@query(f"SELECT event_id, t AS seconds, t AS millis, t AS fraction, t AS exact, CASE WHEN event_id < 100000000 THEN event_id::VARCHAR END AS small, strftime(t::TIMESTAMP, '%Y-%m-%d') || ' 00:00:00' AS day FROM ({NUMBERS_SQL})")
def conform_numbers(spark, read):
    """Epochs in long, double and decimal columns, a number that is none, and a date."""
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = read("events").select("event_id", second.alias("seconds"), (second * 1000).alias("millis"), (second + 0.75).alias("fraction"), second.cast("decimal(20,3)").alias("exact"), F.col("event_id").cast("int").alias("small"), F.col("ts").cast("date").alias("day"))
    return rows.select("event_id", *[exprs.conform_timestamp(F.col(c), rows.schema[c].dataType).alias(c) for c in rows.columns[1:]])


@query("""SELECT o_orderkey AS order_id, o_custkey::VARCHAR AS o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at, split_part(o_orderpriority, '-', 1)::INTEGER AS rank, regexp_replace(o_orderpriority, '[^A-Z0-9-]', '', 'g') AS o_orderpriority,
  NULL::VARCHAR AS channel, o_orderdate::TIMESTAMP AS _valid_from, TIMESTAMP '9999-01-01 00:00:00' AS _valid_to, 'Y' AS _is_current, 'N' AS _is_deleted, TIMESTAMP '2024-06-01 00:00:00' AS _inserted_at, TIMESTAMP '2024-06-01 00:00:00' AS _updated_at
  FROM orders WHERE o_orderstatus <> 'P'""")
def transform_pipeline(spark, read):
    config = transform.Transform(
        keys=["o_orderkey"], order="o_orderdate", illegal="[^A-Za-z0-9:. -]", where="o_orderstatus <> 'P'", casts={"o_orderkey": "bigint"}, derived={"rank": "try_cast(split_part(o_orderpriority, '-', 1) AS int)"},
        renames={"o_orderkey": "order_id", "o_orderdate": "ordered_at"}, exclude=["o_totalprice", "order_id"], external=["channel"],
        hook=lambda df: df.withColumn("o_orderpriority", F.regexp_replace("o_orderpriority", "[^A-Z0-9-]", "")),
    )
    return transform.run(read("orders"), config, at())


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS _is_deleted, o_orderdate::TIMESTAMP AS _valid_from, TIMESTAMP '9999-01-01 00:00:00' AS _valid_to, 'Y' AS _is_current, TIMESTAMP '2024-06-01 00:00:00' AS _inserted_at, TIMESTAMP '2024-06-01 00:00:00' AS _updated_at FROM orders""")
def audit_flags(spark, read):
    rows = read("orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") == "F", " true").otherwise("0").alias("deleted"))
    return transform.audit(rows, "o_orderdate", at()).drop("o_orderdate", "deleted")


# A base table of all orders, and a batch of all orders and as many new ones under keys below zero: by priority an order is changed
# and newer, changed and older, equal, or deleted.
BASE_SQL = "SELECT o_orderkey AS k, o_orderstatus AS v, o_custkey AS c, o_orderdate::TIMESTAMP AS stamp FROM orders"
BATCH_SQL = """SELECT CASE side WHEN 1 THEN o_orderkey ELSE -1 - o_orderkey END AS k, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'X' || o_orderstatus ELSE o_orderstatus END AS v, o_custkey AS c,
  (o_orderdate + CASE o_orderpriority WHEN '1-URGENT' THEN INTERVAL 1 DAY WHEN '2-HIGH' THEN INTERVAL (-1) DAY ELSE INTERVAL 0 DAY END)::TIMESTAMP AS stamp,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Y' ELSE 'N' END AS _is_deleted FROM orders, (VALUES (1), (-1)) AS sides(side)"""


def base(read):
    return read("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"), F.col("o_custkey").alias("c"), F.col("o_orderdate").cast("timestamp").alias("stamp"))


def batch(read):
    p = F.col("o_orderpriority")
    later = F.when(p == "1-URGENT", F.expr("INTERVAL 1 DAY")).when(p == "2-HIGH", F.expr("INTERVAL -1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    rows = read("orders").withColumn("k", F.explode(F.array("o_orderkey", -1 - F.col("o_orderkey"))))
    return rows.select(
        "k", F.when(p.isin("1-URGENT", "2-HIGH"), F.concat(F.lit("X"), "o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("v"), F.col("o_custkey").alias("c"),
        (F.col("o_orderdate").cast("timestamp") + later).alias("stamp"), F.when(p == "3-MEDIUM", "Y").otherwise("N").alias("_is_deleted"),
    )


def audited_base(read):
    return merge.audited(base(read), "stamp", at("2024-01-01 00:00:00"))


CHANGE = "(s.v IS DISTINCT FROM t.v OR s.c IS DISTINCT FROM t.c OR s.stamp IS DISTINCT FROM t.stamp OR s._is_deleted <> 'N') AND s.stamp >= t.stamp"


@query(f"""WITH t AS ({BASE_SQL}), s AS ({BATCH_SQL}), j AS (SELECT coalesce(s.k, t.k) AS k, t.k IS NULL OR coalesce({CHANGE}, false) AS take, t.k IS NULL AS fresh, s.v AS sv, s.c AS sc, s.stamp AS ss, s._is_deleted AS sd, t.v AS tv, t.c AS tc, t.stamp AS ts FROM t FULL JOIN s ON t.k = s.k)
SELECT k, CASE WHEN take THEN sv ELSE tv END AS v, CASE WHEN take THEN sc ELSE tc END AS c, CASE WHEN take THEN ss ELSE ts END AS stamp, CASE WHEN take THEN ss ELSE ts END AS _valid_from, TIMESTAMP '9999-01-01 00:00:00' AS _valid_to, 'Y' AS _is_current,
  CASE WHEN take THEN sd ELSE 'N' END AS _is_deleted, CASE WHEN fresh THEN TIMESTAMP '2024-06-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS _inserted_at, CASE WHEN take THEN TIMESTAMP '2024-06-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS _updated_at FROM j""")
def scd1_merge(spark, read):
    return merge.scd1(audited_base(read), batch(read), ["k"], "stamp", at())


@query(f"""WITH t AS ({BASE_SQL}), s AS ({BATCH_SQL}), x AS (SELECT s.* FROM s LEFT JOIN t ON s.k = t.k WHERE t.k IS NULL OR ({CHANGE}))
SELECT t.k, t.v, t.c, t.stamp, t.stamp AS _valid_from, coalesce(x.stamp, TIMESTAMP '9999-01-01 00:00:00') AS _valid_to, CASE WHEN x.k IS NULL THEN 'Y' ELSE 'N' END AS _is_current, 'N' AS _is_deleted, TIMESTAMP '2024-01-01 00:00:00' AS _inserted_at,
  CASE WHEN x.k IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-06-01 00:00:00' END AS _updated_at FROM t LEFT JOIN x ON t.k = x.k
UNION ALL SELECT k, v, c, stamp, stamp, TIMESTAMP '9999-01-01 00:00:00', 'Y', _is_deleted, TIMESTAMP '2024-06-01 00:00:00', TIMESTAMP '2024-06-01 00:00:00' FROM x""")
def scd2_merge(spark, read):
    return merge.scd2(audited_base(read), batch(read), ["k"], "stamp", at())


# The batch three times, once as it is and twice older and with other content: the last row of a key counts.
REPEATED_SQL = f"""SELECT * FROM ({BATCH_SQL}) UNION ALL SELECT k, 'old', c + n, stamp - to_days((4 * n)::INTEGER), 'N' FROM ({BATCH_SQL}), (VALUES (1), (2)) AS olds(n)"""
LAST_SQL = f"""SELECT k, v, c, stamp, _is_deleted FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY stamp DESC, v DESC, c DESC, _is_deleted DESC) AS rn FROM ({REPEATED_SQL})) WHERE rn = 1"""


def repeated(read):
    rows = batch(read)
    olds = [rows.select("k", F.lit("old").alias("v"), (F.col("c") + n).alias("c"), (F.col("stamp") - F.expr(f"INTERVAL {4 * n} DAY")).alias("stamp"), F.lit("N").alias("_is_deleted")) for n in (1, 2)]
    return rows.unionByName(olds[0]).unionByName(olds[1])


@query(f"""WITH t AS ({BASE_SQL}), s AS ({LAST_SQL}), x AS (SELECT s.* FROM s LEFT JOIN t ON s.k = t.k WHERE t.k IS NULL OR ({CHANGE}))
SELECT t.k, t.v, t.c, t.stamp, t.stamp AS _valid_from, coalesce(x.stamp, TIMESTAMP '9999-01-01 00:00:00') AS _valid_to, CASE WHEN x.k IS NULL THEN 'Y' ELSE 'N' END AS _is_current, 'N' AS _is_deleted, TIMESTAMP '2024-01-01 00:00:00' AS _inserted_at,
  CASE WHEN x.k IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-06-01 00:00:00' END AS _updated_at FROM t LEFT JOIN x ON t.k = x.k
UNION ALL SELECT k, v, c, stamp, stamp, TIMESTAMP '9999-01-01 00:00:00', 'Y', _is_deleted, TIMESTAMP '2024-06-01 00:00:00', TIMESTAMP '2024-06-01 00:00:00' FROM x""")
def scd2_repeated_keys(spark, read):
    """A batch that holds every key three times, merged by its last row."""
    return merge.scd2(audited_base(read), repeated(read), ["k"], "stamp", at(), duplicates="latest")


@query(f"SELECT k, v, c, stamp FROM ({LAST_SQL}) UNION ALL SELECT k, v, c, stamp FROM ({BASE_SQL}) WHERE k NOT IN (SELECT k FROM ({BATCH_SQL}))")
def upsert_repeated_keys(spark, read):
    """The same batch merged twice; the second time changes nothing."""
    rows = repeated(read)
    ranked = lambda target: merge.upsert(target, rows, ["k"], "stamp", duplicates="latest")
    return ranked(ranked(base(read).withColumn("_is_deleted", F.lit("N")))).drop("_is_deleted")


@query("""SELECT event_type, max(ts)::TIMESTAMP AS ts, arg_max(event_id, struct_pack(ts := ts, event_id := event_id)) AS event_id FROM events GROUP BY 1
  UNION ALL SELECT 'first of ' || event_type, min(ts)::TIMESTAMP, arg_min(event_id, struct_pack(ts := ts, event_id := event_id)) FROM events GROUP BY 1""")
def dedup_few_keys(spark, read):
    """Keys that hold a large part of all rows each: one row per key and task is shuffled."""
    rows = read("events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    first = dedup.latest(rows, ["event_type"], ["ts"], earliest=True)
    return dedup.latest(rows, ["event_type"], ["ts"]).unionByName(first.withColumn("event_type", F.concat(F.lit("first of "), "event_type")))


@query(f"WITH t AS ({BASE_SQL}), s AS ({BATCH_SQL}) SELECT k, v, c, stamp FROM t WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT k, v, c, stamp FROM s")
def gold_upsert(spark, read):
    return merge.upsert(base(read), batch(read).drop("_is_deleted"), ["k"])


@query(f"WITH t AS ({BASE_SQL}), s AS ({BATCH_SQL}) SELECT s.k, s.v, s.c, s.stamp AS _updated_at FROM s LEFT JOIN t ON s.k = t.k WHERE t.k IS NULL OR s.stamp > t.stamp OR t.v = 'P'")
def incremental_delta(spark, read):
    target = base(read).select("k", F.col("stamp").alias("_updated_at"), F.when(F.col("v") != "P", F.lit("x")).alias("enriched"))
    return merge.delta(batch(read).select("k", "v", "c", F.col("stamp").alias("_updated_at")), target, ["k"], enriched="enriched")


@query(f"WITH t AS ({BASE_SQL}), s AS ({BATCH_SQL}) SELECT s.k, s.v, s.c FROM s LEFT JOIN t ON s.k = t.k WHERE t.k IS NULL OR s.v IS DISTINCT FROM t.v OR s.c IS DISTINCT FROM t.c")
def changed_rows(spark, read):
    return merge.changed(batch(read).select("k", "v", "c"), base(read).select("k", "v", "c"), ["k"])


@query("SELECT p_partkey, p_name, p_brand, NULL::INTEGER AS p_size FROM part UNION ALL SELECT -p_partkey, p_name, NULL, p_size FROM part")
def append_evolve(spark, read):
    rows = read("part")
    return merge.append(rows.select("p_partkey", "p_name", "p_brand"), rows.select("p_size", (-F.col("p_partkey")).alias("p_partkey"), "p_name"))


@query("SELECT p_partkey, p_name, NULL::INTEGER AS Size FROM part UNION ALL SELECT -p_partkey, p_brand, p_size FROM part")
def append_mixed_case(spark, read):
    rows = read("part")
    return merge.append(rows.select("p_partkey", "p_name"), rows.select(F.col("p_size").alias("Size"), F.col("p_brand").alias("P_Name"), (-F.col("p_partkey")).alias("P_PARTKEY")))


@query("SELECT nullif(c_mktsegment, 'BUILDING') AS segment, c_nationkey, 2 * count(*) AS n FROM customer GROUP BY ALL")
def upsert_null_keys(spark, read):
    """A batch with null keys, merged twice: the second time changes nothing."""
    target = read("customer").groupBy(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    changes = target.withColumn("n", 2 * F.col("n"))
    once = merge.upsert(target, changes, ["segment", "c_nationkey"])
    return merge.upsert(once, changes, ["segment", "c_nationkey"])


@query("""SELECT nullif(c_mktsegment, 'BUILDING') AS segment, count(*) AS n, TIMESTAMP '2024-01-01 00:00:00' AS stamp, 'Y' AS _is_current, 'N' AS _is_deleted,
  TIMESTAMP '2024-06-01 00:00:00' AS _updated_at FROM customer GROUP BY 1""")
def scd1_null_keys(spark, read):
    """A null key opened by a batch; the same batch again leaves it as it is."""
    batch = read("customer").groupBy(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")).agg(F.count(F.lit(1)).alias("n"), at("2024-01-01 00:00:00").alias("stamp"))
    once = merge.scd1(merge.audited(batch, "stamp", at()).limit(0), batch, ["segment"], "stamp", at())
    return merge.scd1(once, batch, ["segment"], "stamp", at("2024-07-01 00:00:00")).select("segment", "n", "stamp", "_is_current", "_is_deleted", "_updated_at")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment || chr(10) || '\"x\", y' AS note FROM customer")
def csv_roundtrip(spark, read):
    where = tables.scratch(spark, "csv")
    rows = read("customer").select("c_custkey", "c_name", F.concat("c_mktsegment", F.lit('\n"x", y')).alias("note"))
    rows.write.options(header=True, escape="\\", quoteAll=True).csv(where)
    return files.csv(spark, where)


@query("SELECT row_number() OVER (PARTITION BY part ORDER BY o_orderkey) AS line_number, o_orderkey || ' ' || o_orderstatus AS line_content FROM (SELECT *, o_orderkey * 16 // (max(o_orderkey) OVER () + 1) AS part FROM orders)")
def text_lines(spark, read):
    """Sixteen files of lines in the order of keys, numbered anew in each."""
    where, rows = tables.scratch(spark, "text"), read("orders")
    part = F.floor(F.col("o_orderkey") * 16 / (rows.agg(F.max("o_orderkey")).scalar() + 1)).alias("part")
    lines = rows.select(F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("line"), part, "o_orderkey")
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("line", "part").write.partitionBy("part").text(where)
    return files.text_lines(spark, where, recursiveFileLookup=True).select("line_number", "line_content")


@query(f"""WITH t AS ({BASE_SQL}), s AS ({LAST_SQL}), m AS (SELECT k, v, c, stamp FROM t WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT k, v, c, stamp FROM s)
SELECT k, v, c, stamp::TIMESTAMP AS stamp FROM m WHERE k > 100 AND stamp > TIMESTAMP '1994-01-01 00:00:00'""")
def database_upsert(spark, read):
    """A table written to a database, a batch merged into it by key, twice, and the increment read back by ranges of the key."""
    where = tables.local(tables.scratch(spark, "database")) + ".sqlite"
    database.write(base(read), where, "orders", "overwrite", ["k"])
    rows = merge.single(repeated(read), ["k"], "stamp", "latest").drop("_is_deleted")
    for _ in range(2):
        database.write(rows, where, "orders", keys=["k"])
    found = database.read(spark, where, "orders", schema="k long, v string, c long, stamp timestamp", split=("k", 8))
    return found.where((F.col("k") > 100) & (F.col("stamp") > at("1994-01-01 00:00:00")))


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment || chr(10) || chr(10) || '\"x\", y' ELSE c_mktsegment END AS note FROM customer")
def csv_split(spark, read):
    """Fields over several lines in files that are split among tasks."""
    where = tables.scratch(spark, "csv")
    note = F.when(F.col("c_acctbal") > 0, F.concat("c_mktsegment", F.lit('\n\n"x", y'))).otherwise(F.col("c_mktsegment"))
    read("customer").select("c_custkey", "c_name", note.alias("note")).write.options(header=True, escape="\\").csv(where)
    return files.csv(spark, where, multiline="split")


PARTS_SQL = "SELECT *, value > 99 AND event_id > min(event_id) OVER (PARTITION BY part) AS bad FROM (SELECT *, event_id * 16 // (max(event_id) OVER () + 1) AS part FROM events)"


@query(f"SELECT event_id, event_type, value FROM ({PARTS_SQL}) e WHERE event_id < (SELECT coalesce(min(event_id), 1e18::BIGINT) FROM ({PARTS_SQL}) x WHERE x.part = e.part AND x.bad)")
def json_until_a_bad_line(spark, read):
    """Sixteen files of JSON lines, of which each counts up to its first bad line."""
    where, rows = tables.scratch(spark, "json"), read("events")
    part = F.floor(F.col("event_id") * 16 / (rows.agg(F.max("event_id")).scalar() + 1)).alias("part")
    first = F.min("event_id").over(Window.partitionBy("part"))  # a file that begins with a bad line would be no lines at all
    line = F.when((F.col("value") > 99) & (F.col("event_id") > first), F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", "event_type", "value")))
    rows.withColumn("part", part).select(line.alias("line"), "part", "event_id").repartition("part").sortWithinPartitions("part", "event_id").select("line", "part").write.partitionBy("part").text(where)
    schema = rows.select("event_id", "event_type", "value").schema
    return files.json_records(spark, where, schema, recursiveFileLookup=True)


@query("SELECT n_nationkey, sha256(concat_ws('||', coalesce(n_name, '<NULL>'), coalesce(n_regionkey::VARCHAR, '<NULL>'))) AS payload_hash FROM nation")
def payload_hash(spark, read):
    return read("nation").select("n_nationkey", exprs.payload_hash(["n_regionkey", "n_name"]).alias("payload_hash"))


@query("""SELECT coalesce(nullif(o_orderpriority, '5-LOW'), 'Unassigned') AS priority_level, coalesce(nullif(o_orderstatus, 'P'), 'Unknown') AS incident_state, coalesce(c_mktsegment, 'General') AS incident_category, count(DISTINCT o_orderkey)::VARCHAR AS total_incidents,
  sum(CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END)::BIGINT::VARCHAR AS soft_deleted_incidents, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT::VARCHAR AS resolved_incidents, sum(CASE WHEN nullif(o_orderstatus, 'P') <> 'F' THEN 1 ELSE 0 END)::BIGINT::VARCHAR AS active_open_incidents, TIMESTAMP '2024-06-01 00:00:00' AS _data_as_of
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""".replace("coalesce(nullif(o_orderstatus, 'P'), 'Unknown')", "CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Unknown' ELSE o_orderstatus END"))
def kpi_by_status(spark, read):
    status = F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    rows = windows.lookup(read("orders"), read("customer"), "o_custkey", "c_custkey", {"c_mktsegment": "category"})
    return marts.incident_kpi(rows.select(F.col("o_orderkey").alias("sys_id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"), status.alias("incident_state"), "category", F.when(F.col("o_orderkey") % 10 == 0, "Y").otherwise("N").alias("_is_deleted")), at())


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT trim(event_type))), ', ') AS kinds FROM events GROUP BY user_id")
def distinct_list_agg(spark, read):
    return read("events").groupBy("user_id").agg(exprs.distinct_list(F.trim("event_type")).alias("kinds"))


@query("""SELECT user_id, coalesce(array_to_string(list_sort(list(DISTINCT event_type) FILTER (value > 50)), ', '), '') AS high, coalesce(array_to_string(list_sort(list(DISTINCT event_type) FILTER (value <= 1)), ', '), '') AS low, max(CASE WHEN event_type = 'error' THEN 'had an error' END) AS flag FROM events GROUP BY user_id""")
def cond_distinct_list(spark, read):
    kind = F.col("event_type")
    return read("events").groupBy("user_id").agg(exprs.distinct_list(F.when(F.col("value") > 50, kind)).alias("high"), exprs.distinct_list(F.when(F.col("value") <= 1, kind)).alias("low"), F.max(F.when(kind == "error", "had an error")).alias("flag"))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, max(CASE WHEN l_returnflag = 'R' THEN 'returned' END) AS returned FROM lineitem GROUP BY l_suppkey")
def count_distinct_resources(spark, read):
    return read("lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n_parts"), F.max(F.when(F.col("l_returnflag") == "R", "returned")).alias("returned"))


# The conversations table in the shape of conformed interactions: every user turn is an interaction, an assistant turn replies to the turn before it.
TURNS_SQL = """SELECT (conv_id * 1000 + turn)::VARCHAR AS id, conv_id::VARCHAR AS conversation_id, CASE WHEN role = 'assistant' THEN (conv_id * 1000 + turn - 1)::VARCHAR END AS parent, CASE WHEN role = 'assistant' THEN 'bot' ELSE role END AS actor,
  lpad(turn::VARCHAR, 6, '0') AS created, CASE WHEN turn % 3 = 2 THEN 'LINK_CLICK' ELSE 'TEXT' END AS type, CASE WHEN turn % 3 = 2 AND role = 'user' THEN CASE WHEN conv_id % 2 = 0 THEN 'Helpful ' ELSE 'not helpful' END ELSE text END AS content FROM conversations"""


def turns(read):
    number = lambda t: (F.col("conv_id") * 1000 + t).cast("string")
    click = F.col("turn") % 3 == 2
    rated = F.when(F.col("conv_id") % 2 == 0, "Helpful ").otherwise("not helpful")
    bot = F.col("role") == "assistant"
    return read("conversations").select(
        number(F.col("turn")).alias("id"), F.col("conv_id").cast("string").alias("conversation_id"), F.when(bot, number(F.col("turn") - 1)).alias("parent_interaction_id"), F.when(bot, "bot").otherwise(F.col("role")).alias("actor"),
        F.lpad(F.col("turn").cast("string"), 6, "0").alias("created_time"), F.when(click, "LINK_CLICK").otherwise("TEXT").alias("type"), F.when(click & (F.col("role") == "user"), rated).otherwise(F.col("text")).alias("detail_content"),
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" topic"), (F.col("conv_id") % 3).cast("string"))).alias("detail_entity"), (F.col("conv_id") % 50).cast("string").alias("user_id"), F.lit("web").alias("platform"), F.lit("Y").alias("_is_current"), F.lit("N").alias("_is_deleted"),
    )


def stamped(df):
    return df.withColumns({"_is_current": F.lit("Y"), "_is_deleted": F.lit("N")})


def mart_rows(read):
    """The interactions mart over the conversations and events tables."""
    c, e = read("conversations"), read("events")
    named = F.when(~F.substring("conversation_id", -1, 1).isin("0", "5"), F.concat(F.lit("d"), F.substring("conversation_id", -1, 1)))
    domains = stamped(c.select(F.col("conv_id").cast("string").alias("conversation_id")).distinct().withColumn("primary_domain", named))
    target = (F.col("event_id") % 100 * 1000 + F.col("user_id") % 6).cast("string")
    calls = stamped(e.select(target.alias("interaction_id"), F.concat(F.when(F.col("value") > 95, "Start Live Agent Chat ").otherwise("plug "), "event_type").alias("plugin_name"), F.when(F.col("value") > 20, "true").when(F.col("value") > 5, "False").otherwise("nan").alias("served"), F.when(F.col("value") > 40, "TRUE").otherwise("false").alias("used")))
    kind = F.when(F.col("event_type") == "error", "RESOURCE_TYPE_TICKET").otherwise("DOC")
    taken = {"resource_id": (F.col("user_id") % 9).cast("string"), "type": kind, "detail_domain": F.lit("it"), "detail_name": F.col("event_type"), "detail_external_resource_id": (F.col("user_id") % 4).cast("string")}
    used = stamped(e.select(target.alias("interaction_id"), *[F.when(F.col("event_type") != "view", v).alias(n) for n, v in taken.items()]))  # a view takes no resource
    users = stamped(e.select((F.col("user_id") % 60).cast("string").alias("id"), F.concat(F.lit("l"), (F.col("event_id") % 3).cast("string")).alias("user_preferred_language"), F.col("ts").alias("_updated_at"), F.col("ts").alias("_inserted_at")))
    return marts.interactions(turns(read), domains, calls, used, users, at())


MART_SQL = f"""WITH i AS ({TURNS_SQL}),
e AS (SELECT *, (event_id % 100 * 1000 + user_id % 6)::VARCHAR AS target FROM events),
ct AS (SELECT conversation_id, array_to_string(list_sort(list(DISTINCT 'topic' || (conversation_id::BIGINT % 3))), ', ') AS topic FROM i WHERE created::INTEGER % 2 = 0 GROUP BY 1),
br AS (SELECT parent, first(content ORDER BY id, content) AS reply FROM i WHERE actor = 'bot' AND trim(content) <> '' GROUP BY 1),
pn AS (SELECT target, CASE WHEN value > 95 THEN 'Start Live Agent Chat ' ELSE 'plug ' END || event_type AS p, value > 20 AS served, value > 40 AS used FROM e),
pa AS (SELECT target, coalesce(array_to_string(list_sort(list(DISTINCT p) FILTER (NOT served AND NOT used)), ', '), '') AS bad, coalesce(array_to_string(list_sort(list(DISTINCT p) FILTER (served)), ', '), '') AS served, coalesce(array_to_string(list_sort(list(DISTINCT p) FILTER (used)), ', '), '') AS used FROM pn GROUP BY 1),
ra AS (SELECT target, 'it' AS dom, count(DISTINCT user_id % 9) AS n, array_to_string(list_sort(list(DISTINCT event_type)), ', ') AS name, array_to_string(list_sort(list(DISTINCT (user_id % 4)::VARCHAR)), ', ') AS ids, max(CASE WHEN event_type = 'error' THEN 'user initiated ticket' END) AS tt,
  coalesce(array_to_string(list_sort(list(DISTINCT (user_id % 4)::VARCHAR) FILTER (event_type = 'error')), ', '), '') AS ti FROM e WHERE event_type <> 'view' GROUP BY 1),
u AS (SELECT (user_id % 60)::VARCHAR AS id, first('l' || (event_id % 3) ORDER BY ts DESC, event_id % 3 DESC) AS lang FROM e GROUP BY 1),
mart AS (SELECT created AS timestamp, i.conversation_id, i.id AS interaction_id, type AS interaction_type, CASE WHEN i.conversation_id::BIGINT % 5 <> 0 THEN 'd' || right(i.conversation_id, 1) ELSE '' END AS conversation_domain, coalesce(topic, '') AS conversation_topic, coalesce(topic, '') AS conversation_topics,
  coalesce(content, '') AS interaction_content, coalesce(reply, '') AS bot_response, coalesce(n, 0)::VARCHAR AS no_of_citations, 'web' AS interaction_surface, coalesce(bad, '') AS unsuccessful_plugins, coalesce(pa.served, '') AS plugin_served, coalesce(pa.used, '') AS plugin_used, coalesce(dom, '') AS resource_domain,
  coalesce(name, '') AS content_item_name, coalesce(ids, '') AS content_item_id, coalesce(tt, '') AS ticket_type, coalesce(ti, '') AS ticket_id, coalesce(lang, '') AS user_preferred_language, NULL::VARCHAR AS user_department, NULL::VARCHAR AS user_location, NULL::VARCHAR AS user_country, TIMESTAMP '2024-06-01 00:00:00' AS _data_as_of
  FROM i LEFT JOIN ct USING (conversation_id) LEFT JOIN br ON i.id = br.parent LEFT JOIN pa ON i.id = pa.target LEFT JOIN ra ON i.id = ra.target LEFT JOIN u ON (i.conversation_id::BIGINT % 50)::VARCHAR = u.id WHERE actor = 'user')"""


@query(f"{MART_SQL} SELECT * FROM mart")
def interactions_mart(spark, read):
    return mart_rows(read)


@query(f"""{MART_SQL}, p AS (SELECT conversation_id, string_agg('Prompt ' || n || ': ' || trim(interaction_content), '; ' ORDER BY n) AS t FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY timestamp, interaction_id) AS n FROM mart WHERE trim(interaction_content) <> '') GROUP BY 1),
r AS (SELECT conversation_id, string_agg('Response ' || n || ': ' || trim(bot_response), '; ' ORDER BY n) AS t FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY timestamp, interaction_id) AS n FROM mart WHERE trim(bot_response) <> '') GROUP BY 1),
b AS (SELECT conversation_id, min(timestamp) AS s, max(timestamp) AS e, max(CASE WHEN lower(plugin_used) LIKE '%start live agent chat%' THEN 1 ELSE 0 END) AS x FROM mart GROUP BY 1)
SELECT b.conversation_id, s AS conversation_start, e AS conversation_end, coalesce(p.t, '') AS interaction_content, coalesce(r.t, '') AS bot_response, x::VARCHAR AS escalated,
  CASE WHEN x <> 1 THEN '' WHEN lower(coalesce(r.t, '')) LIKE '%hr%' THEN 'HR' WHEN lower(coalesce(r.t, '')) LIKE '%live%' THEN 'IT' WHEN lower(coalesce(p.t, '')) LIKE '%it%' THEN 'IT' ELSE 'HR' END AS hr_vs_it_agent, TIMESTAMP '2024-06-01 00:00:00' AS _data_as_of
FROM b LEFT JOIN p USING (conversation_id) LEFT JOIN r USING (conversation_id)""")
def conversation_mart(spark, read):
    return marts.conversations(mart_rows(read), at())


@query(f"""{MART_SQL}, q AS (SELECT *, lower(interaction_type) = 'link_click' AND lower(trim(interaction_content)) IN ('helpful', 'not helpful') AS fb, row_number() OVER w AS seq, lead(lower(interaction_type)) OVER w AS nt, lead(trim(interaction_content)) OVER w AS nc, lead(trim(bot_response)) OVER w AS nr FROM mart WINDOW w AS (PARTITION BY conversation_id ORDER BY timestamp, interaction_id)),
k AS (SELECT f.interaction_id, p.interaction_content AS a, p.bot_response AS b, row_number() OVER (PARTITION BY f.interaction_id ORDER BY p.seq DESC) AS rn FROM q f JOIN q p ON f.conversation_id = p.conversation_id AND p.seq < f.seq AND NOT p.fb AND trim(p.bot_response) <> '' WHERE f.fb)
SELECT q.interaction_id AS feedback_id, q.conversation_id, q.timestamp, coalesce(a, '') AS what_user_said, coalesce(b, '') AS what_bot_said, CASE lower(trim(interaction_content)) WHEN 'helpful' THEN 'Helpful' ELSE 'Not Helpful' END AS rating,
  CASE WHEN nt <> 'link_click' AND nr = '' AND nc <> '' AND lower(nc) NOT IN ('helpful', 'not helpful') THEN nc ELSE '' END AS feedback_text, TIMESTAMP '2024-06-01 00:00:00' AS _data_as_of FROM q LEFT JOIN k ON q.interaction_id = k.interaction_id AND rn = 1 WHERE fb""")
def feedback_mart(spark, read):
    return marts.feedbacks(mart_rows(read), at())


FACTS_SQL = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS state, coalesce(n, 0) AS n_lines, coalesce(amount, 0) AS amount, coalesce(r, 0) AS n_returned FROM orders
  LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2)) AS amount, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""


@query(f"""WITH f AS ({FACTS_SQL}), a AS (SELECT customer_id, count(*) AS n_orders, sum(amount) AS amount, count(*) FILTER (n_returned > 0) AS returns, bool_or(state = 'O') AS open FROM f GROUP BY 1)
SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS n_customers, sum(n_orders)::BIGINT AS n_orders, sum(amount)::DECIMAL(38,2) AS amount, sum(returns)::BIGINT AS n_with_returns, count(*) FILTER (open) AS n_open, count(*) FILTER (customer_id IN (SELECT customer_id FROM f WHERE n_lines = 0)) AS n_late, TIMESTAMP '2024-06-01 00:00:00' AS _data_as_of
FROM a JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE amount > (SELECT avg(amount) / 4 FROM a) GROUP BY 1, 2""")
def sql_marts(spark, read):
    """The folder of SQL marts, ordered by what each reads, as one plan."""
    for name in ("lineitem", "orders", "customer", "nation"):
        read(name).createOrReplaceTempView(f"src_{name}")
    try:
        found = sqlmarts.discover(spark, (Path(__file__).parent / "sql").as_uri(), {"order_facts": ["order_id"], "customer_activity": ["customer_id"], "segment_report": ["segment", "nation"]})
        return sqlmarts.frames(spark, found, at(), ["segment_report"])["segment_report"].withColumn("amount", F.col("amount").cast("decimal(38,2)"))
    finally:
        for name in ("lineitem", "orders", "customer", "nation"):
            spark.catalog.dropTempView(f"src_{name}")


@query("SELECT conv_id, turn, (SELECT min(b.turn) FROM conversations b WHERE b.conv_id = a.conv_id AND b.role = 'assistant' AND b.turn > a.turn) AS reply_turn FROM conversations a WHERE role = 'user'")
def first_reply(spark, read):
    w = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(1, Window.unboundedFollowing)
    rows = read("conversations").select("conv_id", "turn", "role")
    return rows.withColumn("reply_turn", F.min(F.when(F.col("role") == "assistant", F.col("turn"))).over(w)).where("role = 'user'").drop("role")


@query("""SELECT e.event_id, e.user_id, n.event_id AS prior_id, n.event_type AS prior_type FROM (SELECT * FROM events WHERE event_type = 'purchase') e
  LEFT JOIN LATERAL (SELECT event_id, event_type FROM events x WHERE x.user_id = e.user_id AND x.event_type IN ('view', 'click') AND x.ts < e.ts ORDER BY x.ts DESC LIMIT 1) n ON true""")
def nearest_preceding(spark, read):
    found = windows.nearest_preceding(read("events"), ["user_id"], ["ts"], F.col("event_type").isin("view", "click"), {"prior_id": F.col("event_id"), "prior_type": F.col("event_type")})
    return found.where("event_type = 'purchase'").select("event_id", "user_id", "prior_id", "prior_type")


@query("""SELECT event_id, event_type, last_value(CASE WHEN value > 90 THEN event_id END IGNORE NULLS) OVER w AS prior_id, last_value(CASE WHEN value > 90 THEN user_id END IGNORE NULLS) OVER w AS prior_user, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def nearest_preceding_hot_keys(spark, read):
    """Keys that hold a large part of all rows each: their order is cut into blocks."""
    rows, order = read("events"), ["ts", "event_id"]
    found = windows.nearest_preceding(rows, ["event_type"], order, F.col("value") > 90, {"prior_id": F.col("event_id"), "prior_user": F.col("user_id")}, hot=True, least=1000)
    return windows.numbered(found, ["event_type"], order, "n", hot=True, least=1000).select("event_id", "event_type", "prior_id", "prior_user", "n")


@query("""SELECT event_type, coalesce(string_agg(CASE WHEN value > 50 THEN user_id::VARCHAR END, '; ' ORDER BY ts, event_id), '') AS users FROM events GROUP BY event_type
  UNION ALL SELECT user_id::VARCHAR, coalesce(string_agg(CASE WHEN value > 50 THEN event_type END, '; ' ORDER BY ts, event_id), '') FROM events GROUP BY user_id""")
def ordered_list_hot_keys(spark, read):
    rows, order, high = read("events").withColumn("user", F.col("user_id").cast("string")), ["ts", "event_id"], F.col("value") > 50
    by_type = windows.ordered_list(rows, ["event_type"], order, F.when(high, F.col("user")), "users", hot=True, least=1000)
    by_user = windows.ordered_list(rows, ["user"], order, F.when(high, F.col("event_type")), "users", hot=True, least=1000)
    return by_type.unionByName(by_user.withColumnRenamed("user", "event_type"))


@query("SELECT c_custkey, c_name, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def lookup_join(spark, read):
    return windows.lookup(read("customer"), read("nation"), "c_nationkey", "n_nationkey", {"n_name": "nation"}).select("c_custkey", "c_name", "nation")


@query("""SELECT event_id, detail_k, detail_list, item.n::BIGINT AS items_n, item.tag AS items_tag FROM (
  SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS detail_k, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type || ', ' || user_id END AS detail_list, unnest(CASE WHEN event_id % 4 = 0 THEN [NULL] ELSE [{'n': i, 'tag': event_type || i} for i in range(1, event_id % 4 + 1)] END) AS item FROM events)""")
def flatten_json(spark, read):
    items = F.transform(F.when(F.col("event_id") % 4 > 0, F.sequence(F.lit(1), (F.col("event_id") % 4).cast("int"))).otherwise(F.array().cast("array<int>")), lambda i: F.struct(i.cast("long").alias("n"), F.concat("event_type", i.cast("string")).alias("tag")))
    listed = F.when(F.col("event_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("event_type", F.col("user_id").cast("string")))
    nested = read("events").select("event_id", F.struct(F.from_json("props", "k long").k.alias("k"), listed.alias("list")).alias("detail"), items.alias("items"))
    return flatten.flatten(nested)


@query("""SELECT event_id, k AS id, CASE WHEN s = 0 THEN event_type WHEN s = 2 THEN user_id || ', ' || event_type || ', True' END AS detail, CASE WHEN s = 1 OR s = 3 AND part = 1 THEN event_type WHEN s = 3 THEN 'again' END AS detail_kind,
  CASE WHEN s = 1 OR s = 3 AND part = 2 THEN user_id::VARCHAR END AS detail_user, '[{"n":' || k || '},{"m":null,"n":"x"}]' AS meta_tags, k || ', x' AS meta_tags_n, NULL::VARCHAR AS meta_tags_m, NULL::VARCHAR AS meta_flags
  FROM (SELECT event_id, event_type, user_id, event_id % 4 AS s, (props::JSON ->> '$.k') AS k FROM events), (VALUES (1), (2)) AS parts(part) WHERE part = 1 OR s = 3""")
def flatten_records(spark, read):
    """JSON text without a schema, in which a field is a scalar, an object, a list or a list of objects by row."""
    k, s, text = F.get_json_object("props", "$.k"), F.col("event_id") % 4, F.concat
    kind, user = text(F.lit('"'), "event_type", F.lit('"')), F.col("user_id").cast("string")
    detail = (
        F.when(s == 0, kind).when(s == 1, text(F.lit('{"kind":'), kind, F.lit(',"user":'), user, F.lit("}"))).when(s == 2, text(F.lit("["), user, F.lit(","), kind, F.lit(",true]")))
        .otherwise(text(F.lit('[{"kind":'), kind, F.lit('},{"user":'), user, F.lit(',"kind":"again"}]')))
    )
    json = text(F.lit('{"id":'), k, F.lit(',"detail":'), detail, F.lit(',"meta":{"flags":[],"tags":[{"n":'), k, F.lit('},{"n":"x","m":null}]}}'))
    return records.flatten_records(read("events").select("event_id", json.alias("record")), "record", ["event_id"])


@query("SELECT doc_id, regexp_replace(text, '[^\\x20-\\x7E\\n]', '', 'g') AS cleaned FROM documents")
def clean_illegal_chars(spark, read):
    rows = read("documents").select("doc_id", "text")
    return transform.run(rows, transform.Transform(keys=["doc_id"], illegal=r"[^\x20-\x7E\n]", casts={"doc_id": "bigint"}, renames={"text": "cleaned"}), at()).select("doc_id", "cleaned")


@query("SELECT o_orderkey, o_custkey, o_orderdate::TIMESTAMP AS o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100")
def topk_recent(spark, read):
    return read("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate")).orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(100)


@query("SELECT user_id, event_id, ts::TIMESTAMP AS ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 3")
def top_per_user(spark, read):
    return windows.top_per_key(read("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))


@query("SELECT c_custkey, sha256('s' || c_name) AS c_name, c_mktsegment FROM customer")
def tokenize_columns(spark, read):
    return tokens.tokenize(read("customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name"], tokens.digest_tokenizer("s"))


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, NULL::DOUBLE AS score, c_mktsegment AS extra_notes FROM customer")
def reconcile_schema(spark, read):
    rows = read("customer").select(F.col("c_custkey").alias("C CustKey"), F.col("c_name").alias("c_name"), F.col("c_mktsegment").alias("Extra Notes"))
    from pyspark.sql import types as T

    target = T.StructType([T.StructField("c_custkey", T.StringType()), T.StructField("c_name", T.StringType()), T.StructField("score", T.DoubleType())])
    return reconcile.reconcile(rows, target)


@query("SELECT event_id, user_id::VARCHAR AS what, NULL AS more FROM events UNION ALL SELECT -event_id, event_type, event_type FROM events")
def union_drifting_batches(spark, read):
    rows = read("events")
    return reconcile.union_batches([rows.select("event_id", F.col("user_id").alias("what")), rows.select((-F.col("event_id")).alias("event_id"), F.col("event_type").alias("what"), F.col("event_type").alias("more"))])


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS start, (date_trunc('day', ts) + INTERVAL 1 DAY)::TIMESTAMP AS \"end\", event_type, count(*) AS n, sum(value::DECIMAL(18,2)) AS total FROM events GROUP BY ALL")
def windowed_events(spark, read):
    """The batch form of streaming.windowed_counts."""
    return streams.windowed_counts(read("events").withColumn("value", money("value")), "ts", ["event_type"], "1 day", "1 day")


@query("SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT SELECT o_orderkey, 1 FROM orders")
def key_difference(spark, read):
    return merge.missing_keys(read("lineitem"), read("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber")), ["l_orderkey", "l_linenumber"])
