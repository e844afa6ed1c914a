import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.functions import exprs, names


@pytest.mark.parametrize(
    ("header", "name"),
    [("Customer Name", "customer_name"), ("user-id", "user_id"), ("  nested.field.name  ", "nested_field_name"), ("caller_id.name", "caller_id_name"), ("incident.category #1", "incident_category_1"), ("123_number", "col_123_number"), ("", "unnamed_column")],
)
def test_sanitise(header, name):
    assert names.sanitise(header) == name


def test_sanitised_names_stay_apart(spark):
    assert names.sanitised(spark.createDataFrame([(1, 2, 3)], ["A b", "a-b", "c"])).columns == ["a_b", "a_b_2", "c"]


@pytest.mark.parametrize("name", ["timestamp", "created_time", "conversation_start", "conversation_end", "start_time", "end_time", "created_at", "updated_at", "login_time", "payment_date", "event_ts", "session_start"])
def test_timestamp_like(name):
    assert names.timestamp_like(name)


@pytest.mark.parametrize("name", ["_updated_at", "_inserted_at", "_data_as_of", "customer_name", "update_count", "candidate_status"])
def test_not_timestamp_like(name):
    assert not names.timestamp_like(name)
    assert names.timestamp_like("anything", T.DateType())


def test_base_names():
    assert names.base_name("raw_tbl_raw_tbl_My-Table") == "my_table"
    assert names.base_name("gold_src_x", ("gold_", "src_")) == "x"


@pytest.mark.parametrize(
    ("value", "expected"),
    [(f"2024-03-01T15:30:00{s}", "2024-03-01 15:30:00") for s in ("Z", ".123Z", ".123456Z", "+05:30", "-08:00", "+0000")]
    + [(x, x) for x in ("2024-03-01 15:30:00", "9999-01-01 00:00:00", "ACTIVE", "INC0010023", "user@example.com", "12345", None, "2024-03-01T15:30:00 junk", "2024-03-01")],
)
def test_std_timestamp(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(exprs.std_timestamp(F.col("v"))).first()[0] == expected


def test_std_timestamp_of_typed_values(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 10, 14, 25, 30),)], "v timestamp")
    assert df.select(exprs.std_timestamp(F.col("v"))).first()[0] == "2024-05-10 14:25:30"


@pytest.mark.parametrize(
    ("value", "expected"),
    [("1714521600", "2024-05-01 00:00:00"), ("1714521600000", "2024-05-01 00:00:00"), ("05/06/2024", "2024-05-06 00:00:00"), ("13/01/2024", "2024-01-13 00:00:00"), (" nan ", None), ("None", None), ("", None), (" what ", "what"), ("2024-01-02T03:04:05.6+01:00", "2024-01-02 03:04:05")],
)
def test_conform_timestamp(spark, value, expected):
    assert spark.createDataFrame([(value,)], "v string").select(exprs.conform_timestamp(F.col("v"))).first()[0] == expected


def test_payload_hash_tells_null_from_text(spark):
    rows = spark.createDataFrame([("a", None), ("a", "NULL"), ("a", "")], "x string, y string").select(exprs.payload_hash(["y", "x"]).alias("h")).collect()
    assert len({r["h"] for r in rows}) == 3
    assert spark.range(1).select(exprs.payload_hash([])).first()[0] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_lists(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "n int, v string")
    assert df.agg(exprs.distinct_list(F.col("v"))).first()[0] == "a, b"
    assert df.where("v IS NULL").agg(exprs.distinct_list(F.col("v"))).first()[0] == ""
    assert df.where("v IS NOT NULL").agg(exprs.ordered_list(-F.col("n"), F.col("v"))).first()[0] == "b; a; b"
