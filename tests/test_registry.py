import pytest

from siltlake.sinks import metrics
from siltlake.sources import jdbc, registry


def test_reader_by_type_then_name():
    assert registry.reader("x", {"type": "file"}) is registry.READERS["file"]
    assert registry.reader("cursor", {}) is registry.READERS["cursor"]
    with pytest.raises(KeyError, match="types are"):
        registry.reader("x", {})


def test_file_reader(spark, tmp_path):
    (tmp_path / "t_1.csv").write_text("id\n1\n")
    assert registry.reader("x", {"type": "file"})(spark, {"path": str(tmp_path), "table": "t"}).count() == 1


class Pages:
    def __call__(self, query):
        return {"result": [{"id": 1}]}


def test_paged_reader(spark):
    assert registry.reader("offset", {})(spark, {"fetch": Pages(), "schema": "id long"}).first()["id"] == 1


def test_upsert_statement():
    assert jdbc.upsert_statement("gold_x", ["k", "v"], ["k"]).endswith("ON DUPLICATE KEY UPDATE v = VALUES(v)")
    assert jdbc.upsert_statement("gold_x", ["k"], ["k"]).startswith("INSERT IGNORE")


def test_counts_come_with_the_write(spark, tmp_path):
    df, seen = metrics.counted(spark.createDataFrame([(1,), (None,)], "k int"), ["k"])
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 2, "null_keys": 1}
