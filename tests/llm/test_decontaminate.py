import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from siltlake.llm import decontaminate

WORDS = re.compile(r"[^\W_]+")


def brute(docs, items):
    """All item-sized windows of all documents, compared with all items: the best similarity and the windows that reach 0.8."""
    split = lambda t: WORDS.findall((t or "").lower())
    shingled = lambda w, k: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    live = [(i, split(t)) for i, t in items if split(t)]
    holds = Counter(s for _, w in live for s in shingled(w, min(5, len(w))))
    weight = lambda s: math.log1p(len(live) / holds[s]) if s in holds else math.log1p(len(live))
    out = {}
    for d, t in docs:
        words = split(t)
        for i, w in live:
            k = min(5, len(w))
            own = shingled(w, k)
            total = sum(n * weight(s) for s, n in own.items())
            for start in range(max(1, len(words) - k + 1)):
                seen = shingled(words[start : start + len(w)], k)
                theirs = sum(n * weight(s) for s, n in seen.items())
                shared = sum(min(n, own[s]) * weight(s) for s, n in seen.items())
                if shared and shared / max(total, theirs) >= 0.8 - 1e-9:
                    best, n = out.get((d, i), (0, 0))
                    out[d, i] = (max(best, round(shared / max(total, theirs), 6)), n + 1)
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([2, 4, 12, 30, 45, 60])))) for i in range(15)]
    docs = []
    for d in range(60):
        words = rng.choices(vocabulary, k=rng.choice([0, 3, 50, 200]))
        for _ in range(rng.choice([0, 1, 2])):
            item = items[rng.randrange(15)][1].split()
            if rng.random() < 0.5 and len(item) > 20:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randint(0, len(words))
            words = words[:at] + item + words[at:]
        docs.append((d, ", ".join(words).upper() if d % 2 else "\n".join(words)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 5, 6, 9])
def test_every_window_of_the_similarity(spark, seed):
    docs, items = corpus(seed)
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): (round(r["similarity"], 6), r["n_windows"]) for r in got.collect()} == brute(docs, items)


def trial(rng, n, spread, heaviest):
    """Bits that differ between a side of n shingles and one that has lost a fifth of the weight and got as much instead; and what it keeps."""
    w = np.round(np.exp(rng.normal(0, spread, n)) * decontaminate.GRAIN)
    signs = rng.integers(0, 2, (n, 64)) * 2 - 1
    order = np.argsort(-w) if heaviest else rng.permutation(n)
    lost = order[: np.searchsorted(np.cumsum(w[order]), 0.2 * w.sum() + 1, side="right")]
    other = signs.copy()
    other[lost] = rng.integers(0, 2, (len(lost), 64)) * 2 - 1
    far = int((((w[:, None] * signs).sum(0) > 0) != ((w[:, None] * other).sum(0) > 0)).sum())
    return far, max(0.0, 1 - 0.2 * w.sum() * w.max() / (w * w).sum())


@pytest.mark.parametrize("n", [24, 30, 45, 60, 100, 250])
def test_recall_of_the_radius_by_length(n):
    """Of pairs that the index decides, over 50 seeds: none of 2000 at just the similarity lies beyond the radius."""
    asked = beyond = 0
    for seed in range(50):
        rng = np.random.default_rng(seed)
        for k in range(40):
            far, keeps = trial(rng, n, (0, 0.1, 0.15, 0.2)[k % 4], k % 2)
            if keeps * keeps >= decontaminate.COSINE**2:
                asked += 1
                beyond += far > decontaminate.RADIUS
    assert asked > 500 and beyond == 0


def test_pairs_without_a_promise_skip_the_index(spark):
    """A few heavy shingles and many light ones: the fingerprints lie far apart, and the pair is found."""
    from pyspark.sql import functions as F

    rows = [("a", h, 10) for h in range(1, 31)] + [("b", h, 10) for h in range(1, 30)] + [("b", 77, 1000)] + [("c", h, 5) for h in range(5)]
    kept = {r["k"]: r["keeps"] for r in decontaminate.fingerprint(spark.createDataFrame(rows, "k string, h long, weight long").withColumn("h", F.xxhash64("h")), "k").collect()}
    assert abs(kept["a"] - 0.8) < 1e-9 and kept["b"] < 0.75 and kept["c"] == 0


def test_windows_between_aligned_ones(spark):
    item = [f"i{n}" for n in range(60)]
    words = [f"x{n}" for n in range(100)] + ["a", "b", "c"] + item[3:30] + [f"m{n}" for n in range(6)] + item[30:57] + ["d", "e", "f"] + [f"y{n}" for n in range(100)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (found,) = decontaminate.contaminated(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert (found["item_id"], found["start"], found["similarity"]) == (7, 103, round(46 / 56, 9))


def test_index_finds_every_pair_within_the_radius(spark):
    rng = random.Random(5)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for n in range(300):
        a, flips = rng.getrandbits(64), rng.sample(range(64), rng.randint(0, decontaminate.RADIUS + 8))
        rows.append((n, signed(a), signed(a ^ sum(1 << i for i in flips)), len(flips)))
    df = spark.createDataFrame(rows, "n long, fp long, item_fp long, far int")
    found = decontaminate.within_radius(df.select("n", "fp", "far"), df.select("n", "item_fp"), ["n"]).collect()
    assert sorted(r["n"] for r in found) == [n for n, _, _, far in rows if far <= decontaminate.RADIUS]


def test_a_window_of_just_the_similarity_between_aligned_ones(spark):
    """Items that share their first and last five words; two words put in the middle of one leave the window between at 0.8."""
    start, end = [f"s{n}" for n in range(5)], [f"e{n}" for n in range(5)]
    items = [(i, " ".join(start + [f"w{i}x{n}" for n in range(24)] + end)) for i in range(40)]
    own = items[3][1].split()
    docs = [(1, " ".join(own[:17] + ["in", "between"] + own[17:]))]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): (round(r["similarity"], 6), r["n_windows"]) for r in got.collect()} == brute(docs, items) != {}


def test_edge_rows(spark):
    items = [(1, None, 1.0), (2, "", 1.0), (3, "just three words", 1.0), (4, " ".join(f"a{i}" for i in range(30)), 1.0), (4, " ".join(f"a{i}" for i in range(30)), 1.0)]
    bench = spark.createDataFrame(items, "item_id long, text string, similarity double")
    long_text = "filler " * 100_000 + " ".join(f"A{i}" for i in range(30))
    docs = [(1, None, 5), (2, "", 5), (3, "there are Just, three words!", 5), (4, long_text, 5), (5, "clean", 5), (3, "there are Just, three words!", 5), (None, "just three words", 5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, start int")
    out = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in decontaminate.contaminated(frame, bench).collect()}
    assert out == {(3, 3): (1.0, 2), (4, 4): (1.0, 100_000)}
    assert decontaminate.contaminated(frame, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(frame.limit(0), bench).count() == 0


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, items = corpus(3)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.contaminated(d, i).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontaminate.contaminated(d, i).collect())) == one


def test_no_python_on_the_way(spark):
    docs, items = corpus(4)
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
