import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltlake.llm import slack
from siltlake.llm.packing import Encoder


def reachable(left, room):
    """All sums up to room, by brute force."""
    return {s for c in itertools.product(*[range(n + 1) for n in left.values()]) if (s := sum(a * b for a, b in zip(c, left))) <= room}


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=5), st.integers(0, 120))
def test_best_subset_is_the_best(left, room):
    total, counts = slack.best_subset(sorted(left), left, room)
    assert total == max(reachable(left, room))
    assert sum(n * c for n, c in counts.items()) == total and all(0 < c <= left[n] for n, c in counts.items())


def laid(histogram, capacity, **options):
    """Every fragment of every rest, as (length of the rest, number, start, length, sequence, offset)."""
    places = slack.Places(slack.plan(histogram, capacity, **options), capacity)
    length = np.repeat(np.array(list(histogram), np.int64), list(histogram.values()))
    number = np.concatenate([np.arange(c) for c in histogram.values()]).astype(np.int64) if histogram else np.zeros(0, np.int64)
    return [(int(length[w]), int(number[w]), *map(int, rest)) for columns in places.fragments(length, number) for w, *rest in zip(*columns)]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 30), max_size=12), st.sampled_from([60_000, 0, 1, 5]))
def test_plans_place_every_token_once_and_pad_nothing(histogram, steps):
    rests, sequences = {}, {}
    for n, k, start, own, sequence, offset in laid(histogram, 64, steps=steps):
        rests.setdefault((n, k), []).append((start, own))
        sequences.setdefault(sequence, []).append((offset, own))
    assert set(rests) == {(n, k) for n, c in histogram.items() for k in range(c)}
    for at, spans in [(0, sorted(s)) for s in (*rests.values(), *sequences.values())]:
        for start, own in spans:
            assert start == at and own > 0
            at += own
    assert all(sum(own for _, own in spans) == n for (n, _), spans in rests.items())
    fills = [sum(own for _, own in s) for s in sequences.values()]
    assert all(f == 64 or f & (f - 1) == 0 for f in fills) and max(fills, default=0) <= 64


def test_windows_are_exact_where_lengths_allow():
    rows = slack.plan({30: 1000, 34: 1000, 20: 999, 44: 999, 1: 64}, 64).rows
    assert not any(gap or not times for _, _, _, times, _, _, gap, _ in rows)


def test_plans_stay_small():
    # What is broadcast follows the lengths, not the documents.
    for histogram in ({3000: 10**9}, {n: 10**7 + n for n in range(1, 4096)}, {4095: 10**8, 4093: 10**8, 2731: 5 * 10**7}, {n: 10**6 // n for n in range(1, 4096)}):
        assert len(slack.plan(histogram).rows) < 60_000


TEXTS = [None, "", "a", "Hello, world! " * 3, "xyz 漢字 é " * 40, "<|endoftext|> and more", " ".join(f"word{n}" for n in range(900)), "short text here"]


def check(rows, docs, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    left = {}
    for doc_id, text in docs:
        ids = (*tokenizer.encode(text or "", add_special_tokens=False).ids, 2)
        left.setdefault((doc_id, len(ids)), []).append(ids)
    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(left)
    for key, pieces in by_doc.items():
        # Texts of one id and length are told apart by their checksums.
        assert sum(r["length"] for r in pieces) == key[1] * len(left[key])
        for r in pieces:
            assert r["ids_crc32"] in {zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for ids in left[key]}
        starts = np.zeros(key[1], int)
        for r in pieces:
            starts[r["start"] : r["start"] + r["length"]] += 1
        assert (starts == len(left[key])).all()
    for spans in sequences.values():
        at = 0
        for offset, own in sorted(spans):
            assert offset == at
            at += own
        assert at == capacity or at <= capacity and at & (at - 1) == 0


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(4)
    docs = [(n, TEXTS[n % len(TEXTS)]) for n in range(60)] + [(n, " ".join(rng.choice(["alpha", "beta", "gamma."]) for _ in range(rng.randrange(1, 400)))) for n in range(60, 160)]
    docs += [(7, TEXTS[7])] * 25 + [(7, "another text")] * 3 + [(None, "no number at all")] * 2
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, length int, sequence_id string")
    for capacity in (256, 64):
        check(slack.pack(df, capacity=capacity).collect(), docs, capacity)


def test_one_length_that_never_fits_is_cut(spark):
    docs = [(n, "one two three four five six seven eight nine") for n in range(500)]
    rows = slack.pack(spark.createDataFrame(docs, "doc_id long, text string"), capacity=16).collect()
    check(rows, docs, 16)


def test_many_cut_documents_go_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(slack, "CUT_DOCS", 2)
    docs = [(n, "one two three four five six seven eight nine " * (1 + n % 2)) for n in range(60)] * 2
    check(slack.pack(spark.createDataFrame(docs, "doc_id long, text string"), capacity=16).collect(), docs, 16)


def test_numbers_of_a_hot_length_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(slack, "BLOCK", 50)
    rests = spark.range(4000).select(F.lit(3).alias("length"), F.col("id").alias("copy")).unionByName(spark.range(10).select(F.lit(5).alias("length"), (F.col("id") + 9000).alias("copy")))
    found = slack.numbered(rests, 4010)
    assert sorted(r["number"] for r in found.where("length = 3").collect()) == list(range(4000))
    assert sorted(r["number"] for r in found.where("length = 5").collect()) == list(range(10))
    assert found.groupBy("length", "block").count().agg(F.max("count")).first()[0] < 120


def test_empty_table(spark):
    found = slack.pack(spark.createDataFrame([], "doc_id long, text string"))
    assert found.collect() == [] and found.columns == ["doc_id", "doc_tokens", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_a_task_looks_up_each_word_of_many_texts_once(monkeypatch):
    encoder, learnt = Encoder(), []
    learn = encoder.learn_parts
    monkeypatch.setattr(encoder, "learn_parts", lambda new: (learnt.extend(new), learn(new)))
    monkeypatch.setattr(slack, "kept", lambda *a: encoder)
    texts = ["Word, word. WORD;"] * 40 + [None]
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(41), pa.int64()), "text_hash": pa.array(range(41), pa.int64()), "text": pa.array(texts)})
    (out,) = slack.first_cut(None, 4096)([rows])
    assert sorted(learnt) == [",", ".", ";", "word"]
    assert out["length"].to_pylist() == [len(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
