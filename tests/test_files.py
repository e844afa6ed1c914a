"""Files that are split among tasks: quoted CSV, and JSON judged file by file."""

import json
import random

import pytest

from siltlake.sources import files

LIMIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=[64, 333, 1 << 27])
def parts(spark, request):
    """Splits of a few lines, and whole files."""
    before, cost = spark.conf.get(LIMIT), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(LIMIT, request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield request.param
    spark.conf.set(LIMIT, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def written(rng, n, escape):
    def cell():
        made = "".join(rng.choices(["a", "bc", " ", ",", "\n", "\n\n", '"', "é", "x,y", "\t"], k=rng.randrange(9)))
        if not made.strip() or made != made.strip() or set(made) & set('",\n'):
            return '"' + made.replace('"', escape + '"') + '"' if made.strip() else '"q"'
        return made

    return "id,note,tail\n" + "".join(f"{k},{cell()},{cell()}\n" for k in range(n))


@pytest.mark.parametrize("escape", ["\\", '"'])
def test_csv_in_splits_equals_the_whole_files(spark, tmp_path, parts, escape):
    rng = random.Random(parts)
    for name in ("one", "two", "a b"):
        (tmp_path / f"{name}.csv").write_text(written(rng, 60, escape), encoding="utf-8")
    (tmp_path / "long.csv").write_text("id,note,tail\n" + f'1,"{"line of a long field" * 3}\n' + "more and more\n" * 200 + '","end"\n2,b,c\n', encoding="utf-8")
    whole = files.csv(spark, str(tmp_path), escape=escape)
    found = files.csv(spark, str(tmp_path), escape=escape, multiline="split")
    assert found.columns == whole.columns == ["id", "note", "tail"]
    assert rows_of(found) == rows_of(whole) and found.count() == 182
    if parts < 1000:
        assert files.numbered_lines(spark, str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 10


def test_csv_without_header_with_line_ends_and_an_open_quote(spark, tmp_path, parts):
    (tmp_path / "t.tsv").write_bytes(b'1\t"x\n\ty"\r\n\r\n2\tb\r\n3\t"never closed\nhere')
    found = files.csv(spark, str(tmp_path / "t.tsv"), header=False, sep="\t", multiline="split")
    assert found.columns == ["col_0", "col_1"]
    assert rows_of(found)[:2] == [("1", "x\n\ty"), ("2", "b")] and found.count() == 3


def test_csv_by_shuffle_keeps_the_order_of_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FEW", 0)
    (tmp_path / "one.csv").write_text(written(random.Random(5), 80, "\\"), encoding="utf-8")
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, 100)
    try:
        assert rows_of(files.csv(spark, str(tmp_path), multiline="split")) == rows_of(files.csv(spark, str(tmp_path)))
        lines = files.text_lines(spark, str(tmp_path)).orderBy("line_number").collect()
        assert [r["line_content"] for r in lines] == (tmp_path / "one.csv").read_text(encoding="utf-8").split("\n")[:-1]
    finally:
        spark.conf.set(LIMIT, before)


def defined(text):
    """The records of a file by its definition."""
    out = []
    for line in filter(None, (x.strip() for x in text.split("\n"))):
        try:
            value = json.loads(line)
        except ValueError:
            break
        out += [value] if isinstance(value, dict) else []
    if out or not text.strip():
        return out
    value = json.loads(text)
    if isinstance(value, dict):
        value = next((value[k] for k in files.RECORD_KEYS if isinstance(value.get(k), list)), [value])
    return [v for v in value if isinstance(v, dict)] if isinstance(value, list) else []


TEXTS = {
    "lines": '{"a": 1}\n\n {"a": 2, "b": "x"} \n5\n[1]\nnull\n{"a": 3}\n',
    "cut": "".join(f'{{"a": {k}}}\n' for k in range(40)) + '{"a": \n' + "".join(f'{{"a": {k}}}\n' for k in range(100, 140)),
    "array": json.dumps([{"a": k, "c": [k, {"d": None}]} for k in range(30)], indent=2),
    "array on a line": '[{"a": 7}, 8, {"b": "é"}]',
    "held": json.dumps({"n": 2, "records": [{"a": 1}, {"a": 2}], "value": 5}, indent=1),
    "single": '{\n"a": 9,\n"b": "long ' + "x" * 500 + '"\n}',
    "single line": '{"a": 10, "data": [1]}',
    "blank": "\n \n",
    "scalar": "5\n",
    "empty": "",
}


def test_json_is_judged_file_by_file(spark, tmp_path, parts):
    for name, text in TEXTS.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    found = [json.loads(r["record"]) for r in files.json_texts(spark, str(tmp_path)).collect()]
    expected = [r for text in TEXTS.values() for r in defined(text)]
    as_text = lambda rows: sorted(json.dumps(r, sort_keys=True) for r in rows)
    assert as_text(found) == as_text(expected)
    typed = files.json_records(spark, str(tmp_path))
    assert typed.count() == len(expected) and {"a", "b", "c", "data"} <= set(typed.columns)
    assert sorted(r["a"] for r in typed.collect() if r["a"] is not None) == sorted(r["a"] for r in expected if r.get("a") is not None)


def test_a_document_that_is_no_json_fails(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"a": 1}\n')
    (tmp_path / "bad.json").write_text('{"a": 1,\n')
    with pytest.raises(Exception, match="no JSON in .*bad.json"):
        files.json_texts(spark, str(tmp_path)).collect()


def test_types_of_records(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"x": 1.5, "n": null, "o": {"k": [1, 2]}, "m": 1}\n{"x": 2, "o": {"k": []}, "m": {"z": 1}}\n')
    df = files.json_records(spark, str(tmp_path))
    assert dict(df.dtypes) == {"m": "string", "n": "string", "o": "struct<k:array<bigint>>", "x": "double"}
    assert sorted(r["m"] for r in df.collect()) == ["1", '{"z":1}']
