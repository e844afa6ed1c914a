"""Flattening of records whose shape differs by row."""

import json
import random

from siltlake.operators import records


def flat(spark, rows, **options):
    """Rows without their nulls, sorted."""
    df = spark.createDataFrame([(k, r if r is None or isinstance(r, str) else json.dumps(r)) for k, r in enumerate(rows)], "n int, j string")
    found = records.flatten_records(df, "j", ["n"], **options)
    return found.columns, sorted(({k: v for k, v in r.asDict().items() if v is not None} for r in found.collect()), key=lambda r: json.dumps(r, sort_keys=True))


def test_one_field_of_many_shapes(spark):
    rows = [{"a": 1}, {"a": "x y"}, {"a": [1, "t", True]}, {"a": {"b": {"c": 2}, "d": None}}, {"a": [1, None]}, {"a": [[1], 2]}, {"a": []}, {"a": None}, {"a": [5, {"b": 7}]}, {"a": {"b": "s"}}]
    names, found = flat(spark, rows)
    assert sorted(names) == ["a", "a_b", "a_b_c", "a_d", "n"]
    assert {r["n"]: {k: v for k, v in r.items() if k != "n"} for r in found} == {
        0: {"a": "1"}, 1: {"a": "x y"}, 2: {"a": "1, t, True"}, 3: {"a_b_c": "2"}, 4: {"a": "[1,null]"}, 5: {"a": "[[1],2]"}, 6: {}, 7: {}, 8: {"a": '[5,{"b":7}]', "a_b": "7"}, 9: {"a_b": "s"},
    }


def test_the_first_list_of_objects_in_a_record_makes_rows(spark):
    rows = [
        '{"z": [{"q": 1}, {"q": {"r": true}}, 9], "b": [{"q": 5}, {"q": 6}], "t": "same"}', '{"b": [{"q": 5}, {"w": [1, 2]}], "z": [{"q": 1}]}', {"b": [3, {"q": 4}]}, {"b": {"q": 8}}, {"t": "none"},
    ]
    _, found = flat(spark, rows)
    assert [r for r in found if r["n"] == 0] == sorted(
        [{"n": 0, "z_q": "1", "b": '[{"q":5},{"q":6}]', "b_q": "5, 6", "t": "same"}, {"n": 0, "z_q_r": "true", "b": '[{"q":5},{"q":6}]', "b_q": "5, 6", "t": "same"}, {"n": 0, "b": '[{"q":5},{"q":6}]', "b_q": "5, 6", "t": "same"}],
        key=lambda r: json.dumps(r, sort_keys=True),
    )
    assert [r for r in found if r["n"] == 1] == [{"n": 1, "b_q": "5", "z": '[{"q":1}]', "z_q": "1"}, {"n": 1, "b_w": "1, 2", "z": '[{"q":1}]', "z_q": "1"}]
    assert [r for r in found if r["n"] > 1] == [{"b": '[3,{"q":4}]', "b_q": "4", "n": 2}, {"b_q": "8", "n": 3}, {"n": 4, "t": "none"}]


def test_lists_below_the_top_make_no_rows(spark):
    _, found = flat(spark, [{"m": {"tags": [{"n": 1, "u": None}, {"n": 2, "k": [1, "x"]}, {"n": {"deep": False}}], "e": []}}])
    assert found == [{"n": 0, "m_tags": '[{"n":1,"u":null},{"k":[1,"x"],"n":2},{"n":{"deep":false}}]', "m_tags_n": "1, 2", "m_tags_k": "1, x", "m_tags_n_deep": "false"}]


def test_odd_records_and_names(spark):
    rows = [None, "", "{bad", "[1, 2]", "5", '{"a": 1, "a": 2}', {"a b": {"c.d": 1}, "é'": 2, "`t`": 3, "OBJECT<": {"x": 4}, "": 5}, {}, {"A B": {"c.D": 9}, "a b_c.d": 7}]
    names, found = flat(spark, rows, sep="_")
    assert len(found) == 9 and len(names) == len({n.lower() for n in names})
    last = [r for r in found if r["n"] == 6]
    assert {k.lower(): v for k, v in last[0].items()} == {"n": 6, "a b_c.d": "1", "é'": "2", "`t`": "3", "object<_x": "4", "": "5"}
    assert flat(spark, [])[0] == ["n"] and flat(spark, [None, "x"])[1] == [{"n": 0}, {"n": 1}]


def leaves(value, name):
    """The definition: (column, text) of a value below the top, which makes no rows."""
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in leaves(v, f"{name}_{k}")]
    if not isinstance(value, list):
        return [] if value is None else [(name, json.dumps(value) if isinstance(value, bool) else str(value))]
    if not value:
        return []
    scalar = all(x is not None and not isinstance(x, (dict, list)) for x in value)
    out = [(name, ", ".join(map(str, value)) if scalar else json.dumps(value, separators=(",", ":"), sort_keys=True))]
    found = {}
    for x in value:
        if isinstance(x, dict):
            for column, text in leaves(x, name):
                found.setdefault(column, []).append(text)
    return out + [(column, ", ".join(texts)) for column, texts in found.items()]


def defined(record):
    chosen = next((k for k, v in record.items() if isinstance(v, list) and v and isinstance(v[0], dict)), None)
    base = dict(x for k, v in record.items() if k != chosen for x in leaves(v, k))
    return [base | (dict(leaves(x, chosen)) if isinstance(x, dict) else {}) for x in (record[chosen] if chosen else [None])]


def made(rng, depth):
    kind = rng.random()
    if depth and kind < 0.3:
        return {k: made(rng, depth - 1) for k in rng.sample("pqrs", rng.randrange(3))}
    if depth and kind < 0.6:
        return [made(rng, depth - 1) for _ in range(rng.randrange(4))]
    return rng.choice([1, -5, "x", "y z", True, False, None, 2.5])


def test_random_records_equal_the_definition(spark):
    rng = random.Random(11)
    rows = [{k: made(rng, 3) for k in rng.sample("abcd", rng.randrange(1, 5))} for _ in range(150)]
    _, found = flat(spark, rows)
    expected = sorted(({"n": k, **r} for k, record in enumerate(rows) for r in defined(record)), key=lambda r: json.dumps(r, sort_keys=True))
    assert found == expected
