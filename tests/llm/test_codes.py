import hashlib
import math
import random
from collections import Counter

import numpy as np

from siltlake.llm import codes, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, error string, n int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) and abs(x) < vectors.LARGEST for x in v)


def brute(rows, dims, parts, entries, rounds):
    """The definition, over vectors instead of distinct parts."""
    kept = sorted(((i is None, i or 0, [math.floor(1024 * x) for x in v], i, label) for i, v, label, *_ in rows if usable(v) and len(v) == dims), key=lambda r: r[:3])
    width = dims // parts
    cut = [[r[2][p * width : (p + 1) * width] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min((far(part, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for c in cut:
                own[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(o) for x in zip(*o)] if o else b for b, o in zip(books[p], own)]
    out = []
    for r, c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((r[3], r[4], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()


def rows_of(seed, n, dims=8):
    rng = random.Random(seed)
    few = [[rng.uniform(-2, 2) for _ in range(dims)] for _ in range(5)]
    out = [(k, [rng.uniform(-2, 2) for _ in range(dims)] if k % 3 else rng.choice(few)[:4] + [rng.uniform(-1, 1) for _ in range(dims - 4)], rng.choice([1, 2, None]), "x", 3) for k in range(n)]
    out += [(3, few[0], 1, "x", 3)] * 4 + [(None, few[1], None, None, None)] * 2
    out += [(900, None, 1, "x", 3), (901, [float("nan")] * dims, 1, "x", 3), (902, [None] * dims, 1, "x", 3), (903, [float("inf")] + [0.0] * (dims - 1), 1, "x", 3), (904, [0.0] * 4, 1, "x", 3), (905, [], 1, "x", 3), (906, [1e30] * dims, 1, "x", 3)]
    return out


def test_equals_the_definition(spark):
    for seed, entries in ((1, 16), (2, 4)):
        rows = rows_of(seed, 70)
        found, books = codes.compress(spark.createDataFrame(rows, SCHEMA), entries=entries, rounds=3)
        expected, digest = brute(rows, 8, 4, entries, 3)
        assert Counter((r["vec_id"], r["label"], r["code"], r["error"]) for r in found.collect()) == Counter(expected)
        assert codes.digest(books) == digest


def test_distances_are_exact_as_floats_and_as_integers():
    rng = np.random.default_rng(1)
    for most in (1000, 1 << 26):
        x, c = rng.integers(-most, most, (40, 16)), rng.integers(-most, most, (9, 16))
        assert vectors.squared(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]


def test_shared_parts_are_counted_before_they_are_shuffled(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0, float(k % 2), 4.0]) for k in range(1000)], "vec_id long, embedding array<double>").select("vec_id", vectors.integers("embedding").alias("v"))
    found = codes.distinct_parts(df, 4, 4)
    assert {(r["position"], r["part"][0], r["n"]) for r in found.collect()} == {(0, 1024, 1000), (1, 2048, 1000), (2, 0, 500), (2, 1024, 500), (3, 4096, 1000)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "functions=[partial_count(1)]" in plan and "Window" not in plan


def test_fewer_vectors_than_entries_and_none(spark):
    found, books = codes.compress(spark.createDataFrame([(5, [1.0] * 8, 1, None, None)], SCHEMA))
    assert [tuple(r) for r in found.collect()] == [(5, 1, "00000000", 0)] and len(books[0]) == 1
    for rows in ([], [(1, None, 1, None, None)], [(1, [1.0], 1, None, None)]):
        found, books = codes.compress(spark.createDataFrame(rows, SCHEMA))
        assert found.columns == ["vec_id", "label", "code", "error"] and found.collect() == [] and books == []


def test_the_query_on_edge_rows(spark, tmp_path):
    rows = rows_of(5, 40)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = codes.op11_vector_codes(spark, str(tmp_path)).collect()
    expected, digest = brute(rows, 8, 4, 256, 4)
    by_label = Counter()
    for _, label, _, error in expected:
        by_label[label] += error
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in found) == Counter((i, code, error, by_label[label], digest) for i, label, code, error in expected)
