import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from siltlake.llm import licenses

SCANNER = licenses.Scanner()


def plain(text):
    """Base results straight from their definition."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


PARTS = ["GNU", "gnu general public license", "General Public License", "Apache License", "apache", "CC BY", "cc by cc", "cc-by", "MIT", "mit license", "É", "Kelvin K", "license", "version 2.0", "x1", "\n", "§"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14), st.sampled_from([" ", "-", "\n", ", "]))
def test_base_is_its_definition(parts, sep):
    text = sep.join(parts)
    out = SCANNER.scan(text)
    assert out[:5] == plain(text)
    assert set(out[4].split(",")) - {""} <= set(out[5].split(","))
    assert 0 <= out[6] <= 1


def test_rules_are_hundreds_and_sound():
    found = licenses.rules()
    assert len(found) >= 200
    for rule in found:
        assert rule.keyword == rule.keyword.lower() and not rule.pattern.search("  ")


def test_priority_and_containment():
    out = SCANNER.scan("Licensed under CC BY-NC 4.0.")
    assert out[4:6] == ("cc-by", "cc-by,cc-by-nc")
    assert [(d["label"], d["start"], d["end"]) for d in out[7]] == [("cc-by-nc", 0, 7)]
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Licensed under the Apache License, Version 2.0"
    assert SCANNER.scan(text)[5] == "apache,mit"
    assert SCANNER.scan("SPDX-License-Identifier: AGPL-3.0-or-later")[5] == "agpl"
    assert SCANNER.scan("It does what it says about clause and sun")[5] == ""


def test_settling_against_brute_force():
    rules = [licenses.Rule(n, str(n), p, "x", re.compile("x")) for n, p in enumerate((90, 50, 50, 70))]
    found = [(a, b, r) for r in rules for a in range(6) for b in range(a + 1, 7) if (a * 7 + b * 3 + r.number) % 5 == 0]
    kept = licenses.settle(found)
    for x in found:  # each suppressed one lies inside a kept one of at least its priority
        if x not in kept:
            assert any(a <= x[0] and x[1] <= b and r.priority >= x[2].priority for a, b, r in kept)
    for x in kept:
        assert not any(y is not x and y[0] <= x[0] and x[1] <= y[1] and y[2].priority >= x[2].priority and y in kept[: kept.index(x)] and y[:2] == x[:2] for y in kept)


def quadratic(found):
    kept = []
    for start, end, rule in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].number)):
        if not any(a <= start and end <= b for a, b, _ in kept):
            kept.append((start, end, rule))
    return sorted(kept, key=lambda x: (x[0], x[1], x[2].number))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 9), st.integers(0, 5)), max_size=30))
def test_settling_is_containment_in_any_kept(places):
    rules = [licenses.Rule(n, str(n), p, "x", re.compile("x")) for n, p in enumerate((90, 50, 50, 70, 10, 90))]
    found = [(a, a + n, rules[r]) for a, n, r in places]
    assert licenses.settle(found) == quadratic(found)


def test_a_megabyte_of_detections_is_linear():
    began = time.time()
    out = SCANNER.scan("mit license foo " * 65_000)
    assert out[1] == 65_000 and out[3] == 3 * 64_999 and len(out[7]) >= 65_000
    assert time.time() - began < 60


def test_edge_rows(spark):
    big = spark.createDataFrame([(9007199254740993, "a"), (None, "b")], "doc_id long, text string")
    assert {r["doc_id"] for r in licenses.scan(big).collect()} == {9007199254740993, None}
    rows = [(1, None, "l"), (2, "", None), (3, "mit license " * 20_000, None), (4, "MIT license", None), (4, "MIT license", None), (None, "cc by", None)]
    out = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert len(out) == 6
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert (by[1][0]["n_words"], by[1][0]["first_word"], by[1][0]["labels"], by[1][0]["score"]) == (0, None, "", 0.0)
    assert (by[3][0]["n_base"], by[3][0]["first_word"], by[3][0]["last_word"]) == (20_000, 0, 39_998)
    assert by[4][0] == by[4][1] and by[None][0]["base_labels"] == "cc-by"
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
