import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from siltlake.llm import jaccard


def sets_of(text):
    words = jaccard.WORD.findall((text or "").lower())
    n = min(5, len(words))
    return tuple(words), {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    """class_id, n_copies and n_links by doc_id, all pairs compared."""
    texts = {}
    for d, t in rows:
        texts.setdefault(sets_of(t)[0], []).append(d)
    keys = [k for k in texts if k]
    sets = {k: sets_of(" ".join(k))[1] for k in keys}
    links = {k: {m for m in keys if m != k and len(sets[k] & sets[m]) >= 0.8 * len(sets[k] | sets[m]) - 1e-9} for k in keys}
    out, done = {}, set()
    for k in keys:
        if k in done:
            continue
        todo, group = [k], set()
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += links[x]
        done |= group
        least = min(d for x in group for d in texts[x])
        for x in group:
            for d in texts[x]:
                out[d] = (least, len(texts[x]), len(links[x]))
    for d in texts.get((), []):
        out[d] = (d, 1, 0)
    return out


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.choice([3, 6, 40, 120, 300]))
        if rng.random() < 0.3:
            words = words + passage
        rows.append(words)
    for _ in range(n):
        words = list(rng.choice(rows))
        for _ in range(rng.randint(0, 1 + len(words) // 40)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append(words)
    hot = rng.choices(vocabulary, k=200)
    for _ in range(2 * n):  # a large group of near copies
        words = list(hot)
        words[rng.randrange(200)] = rng.choice(vocabulary)
        rows.append(words)
    rows += [hot] * 40
    rng.shuffle(rows)
    return [(i, " ".join(w).title() if i % 3 else " ".join(w) + "!") for i, w in enumerate(rows)]


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: (r["class_id"], r["n_copies"], r["n_links"]) for r in jaccard.similarity_classes(docs, **options).collect()}
    expected = brute(rows)
    assert out == expected


def test_against_all_pairs(spark):
    check(spark, corpus(1))


def test_blocks_and_splits_give_the_same(spark, monkeypatch):
    for name, value in (("LEAF", 8), ("BLOCK", 20), ("RESIDUE", 5), ("EXACT_TEXTS", 30)):
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard.candidates, "__defaults__", (jaccard.RECALL, jaccard.DEPTH, 8))
    out = {r["doc_id"]: (r["class_id"], r["n_copies"], r["n_links"]) for r in jaccard.similarity_classes(docs).collect()}
    assert out == brute(rows)


def test_edge_rows(spark):
    long_text = " ".join(f"v{i % 5000}" for i in range(60_000))
    rows = [(1, None, "c"), (2, "", None), (3, "!?", None), (4, "one two", "x"), (5, "One, two", None), (6, long_text, None), (7, long_text + " end", None), (6, long_text, None), (None, "one two", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    out = sorted((tuple(r) for r in jaccard.similarity_classes(docs).collect()), key=str)
    assert out == sorted([(1, 1, 1, 0), (2, 2, 1, 0), (3, 3, 1, 0), (4, 4, 3, 0), (5, 4, 3, 0), (6, 6, 2, 1), (6, 6, 2, 1), (7, 6, 1, 1), (None, 4, 3, 0)], key=str)
    assert jaccard.similarity_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(5, 5), (70, 61), (70, 61)]
    df = spark.createDataFrame(edges, "a int, b int")
    out = {r["node"]: r["component"] for r in jaccard.components(df).collect()}
    assert {k: v for k, v in out.items() if k < 61} == {i: i - i % 20 for i in range(61) if i < 60} | {60: 60} or out[19] == 0
    assert out[70] == out[61] == 61 and out[39] == 20


def test_runs_meet_the_recall():
    assert (1 - jaccard.survival(jaccard.DEPTH, 0.8)) ** jaccard.runs_for() <= 1 - jaccard.RECALL


def test_recall_at_full_depth(spark):
    """Pairs of just the least similarity meet in some run at the last split and pass the filter."""
    n, rng = 40_000, np.random.default_rng(8)
    one, other = rng.integers(0, 1 << 31, (2, n, jaccard.COORDINATES), dtype=np.int32)
    same = rng.random(one.shape) < jaccard.SIMILARITY
    other = np.where(same, one, other)
    enough = same.sum(axis=1) >= jaccard.needed()
    rows = pd.DataFrame({"pair": np.tile(np.arange(n), 2), "side": np.repeat([0, 1], n), "sig": [x.tobytes() for x in np.concatenate([one, other])]})
    df = spark.createDataFrame(rows[np.tile(enough, 2)], "pair long, side int, sig binary").repartition(8)
    paths = df.select("pair", "side", "sig", F.explode(jaccard.roots_of(jaccard.runs_for(), jaccard.ROOT)).alias("path"))
    for _ in range(jaccard.ROOT, jaccard.DEPTH):
        paths = paths.select("pair", "side", "sig", F.explode(jaccard.children(F.col("path"))).alias("path"))
    met = paths.groupBy("pair", "path").agg(F.count_distinct("side").alias("sides")).where("sides = 2").select("pair").distinct().count()
    assert n - met <= n * (1 - jaccard.RECALL)


def test_recall_is_averaged_over_the_agreeing_coordinates():
    assert jaccard.recall_of(9) < 0.9985
    assert jaccard.recall_of(jaccard.runs_for()) >= jaccard.RECALL > jaccard.recall_of(jaccard.runs_for() - 1)


def test_hot_keys_join_alike(spark, monkeypatch):
    """Keys that are broadcast and keys that are shuffled give the same rows as a plain join, and the hot ones are not shuffled."""
    rows = spark.createDataFrame([(i % 7 if i % 3 else 100, i) for i in range(900)], "key long, i long")
    side = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    for part, hot in ((250, 100_000), (10, 5), (10_000, 1), (0, 1_000)):
        monkeypatch.setattr(jaccard, "PART", part)
        monkeypatch.setattr(jaccard, "HOT", hot)
        out = jaccard.beside_key(rows, side, "key")
        assert out.columns == ["key", "i", "n"]
        assert sorted(map(tuple, out.collect())) == sorted((k, i, 300 if k == 100 else sum(1 for j in range(900) if j % 3 and j % 7 == k)) for k, i in map(tuple, rows.collect()))


def test_hubs_and_copies_beyond_the_part(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 5)
    check(spark, corpus(3, 60))
    star = spark.createDataFrame([(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 340)], "a int, b int")
    out = {r["node"]: r["component"] for r in jaccard.components(star).collect()}
    assert all(out[i] == 0 for i in range(200)) and all(out[i] == 300 for i in range(300, 341))
