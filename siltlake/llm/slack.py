"""Packing by minimum bin slack.

Documents become token ids; what is longer than a window is cut into whole windows, which are sequences of their
own, and a rest. Only the number of rests of each length matters to the plan, so it is made from a histogram of at most
CAPACITY - 1 lengths, however many documents there are. A window takes the longest rest that is left; a bitset
holds which sums the other lengths can make, each up to as often as it is left and fits, and the largest
sum that fits is taken apart again into counts of lengths. The window found is repeated as long as its
lengths last. Where even the best sum leaves slack, the longest rest beyond it is cut to fill it, and what remains of
that is a rest of its own length again. When nothing is left to cut, the remainder is laid end to end
and cut into windows, the last of them into powers of two, which need no padding: so no sequence is padded.

Rests of one length are numbered by blocks, at most BLOCK of them in a task's sort, however many share a length; places
follow from the number alone, by a search in the plan. The plan has at most STEPS windows that differ (then the remainder
is laid end to end), and a window at most some ninety lengths, so what is broadcast has a bound that
does not depend on the documents. Ids of documents that the plan cuts are made once more, for the checksums of the fragments.

Defined results: a null text counts as empty and makes one piece holding the end token alone; special strings of the tokenizer
give their ids, as it gives them by default; repeated rows (the same doc_id, with the same text or another) are
packed each; an empty table gives no pieces; extra columns are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltlake.llm.common import arrays, cut, release, shape, small_batches, table
from siltlake.llm.packing import Encoder, kept

CAPACITY, END_ID = 4096, 2
#: Rests of one length that are numbered in one sort.
BLOCK = 4000
#: Windows that differ, in a plan.
STEPS = 60_000
#: Characters of chunks, and of their parts, whose ids a worker remembers.
REMEMBERED = 3_000_000
#: Documents that are cut by the plan and broadcast to find their texts; more are found by shuffle.
CUT_DOCS = 100_000
#: What tells a document's ids: its number, the hash of its text and its length.
DOCUMENT = "doc_id long, text_hash long, doc_tokens long"
RESTS = f"{DOCUMENT}, start long, length long, ids_crc32 long"
PLACED = f"{RESTS}, sequence_id long, offset long"


@dataclass
class Plan:
    """Ranges of numbers of one length, and where they go.

    A row (length, first, last, times, sequence, offset, 0, 0) puts those numbers into windows from
    sequence on, `times` into each, one after another from offset on. With `gap`, the first gap tokens go there, one number to
    a window, and the rest becomes number `again` and following of length - gap. With times 0 they lie end to
    end from token `sequence` of the tape on.
    """

    rows: list[tuple[int, int, int, int, int, int, int, int]] = field(default_factory=list)
    windows: int = 0
    tape: int = 0


def best_subset(lengths: list[int], left: dict[int, int], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to room of the lengths, each as often as it is left, and how often each is in it.

    lengths are sorted. Bit s of a bitset says that s can be made; the longest come first, and once room can be made no more are looked at.
    """
    reach, mask = 1, (1 << (room + 1)) - 1
    before: list[tuple[int, int, int]] = []
    for k in range(bisect.bisect_right(lengths, room) - 1, -1, -1):
        n = lengths[k]
        most = min(left[n], room // n)
        if not most:
            continue
        before.append((n, most, reach))
        some = 1
        while most:  # 1, 2, 4, ... and what remains make every count
            some = min(some, most)
            reach |= (reach << (some * n)) & mask
            most -= some
            some *= 2
        if reach >> room & 1:
            break
    total = rest = reach.bit_length() - 1
    counts: dict[int, int] = {}
    for n, most, was in reversed(before):
        count = next(c for c in range(most + 1) if rest >= c * n and was >> (rest - c * n) & 1)
        if count:
            counts[n] = count
            rest -= count * n
    return total, counts


def plan(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> Plan:
    """Windows for so many rests of each length, all shorter than capacity."""
    out, left, taken = Plan(), {n: c for n, c in histogram.items() if c}, {n: 0 for n in histogram}
    made = dict(histogram)
    lengths = sorted(left)

    def use(n: int, count: int) -> int:
        first = taken[n]
        taken[n] += count
        left[n] -= count
        if not left[n]:
            del left[n]
            del lengths[bisect.bisect_left(lengths, n)]
        return first

    for _ in range(steps):
        if not lengths:
            break
        longest = lengths[-1]
        left[longest] -= 1  # the seed
        total, counts = best_subset(lengths, left, capacity - longest)
        left[longest] += 1
        counts[longest] = counts.get(longest, 0) + 1
        gap = capacity - longest - total
        need = dict(counts)
        if gap:
            # All that remains is longer than the gap, or it would have been taken.
            other = next((n for n in reversed(lengths) if left[n] > counts.get(n, 0)), None)
            if other is None:
                break
            need[other] = need.get(other, 0) + 1
        times = min(left[n] // c for n, c in need.items())
        at = 0
        for n in sorted(counts, reverse=True):
            first = use(n, times * counts[n])
            out.rows.append((n, first, first + times * counts[n], counts[n], out.windows, at, 0, 0))
            at += counts[n] * n
        if gap:
            first, rest = use(other, times), other - gap
            out.rows.append((other, first, first + times, 1, out.windows, at, gap, made.get(rest, 0)))
            if rest not in left:
                bisect.insort(lengths, rest)
            made[rest] = made.get(rest, 0) + times
            left[rest] = left.get(rest, 0) + times
            taken.setdefault(rest, 0)
        out.windows += times
    for n in reversed(lengths):
        out.rows.append((n, taken[n], taken[n] + left[n], 0, out.tape, 0, 0, 0))
        out.tape += n * left[n]
    return out


def edges(tape: int, capacity: int) -> list[int]:
    """Where the tape's last, partly filled window is cut: into powers of two, the largest first."""
    out, at = [], tape - tape % capacity
    for bit in reversed(range(capacity.bit_length())):
        if (tape - at) >> bit & 1:
            out.append(at)
            at += 1 << bit
    return out


class Places:
    """Looks numbers up in a plan."""

    def __init__(self, plan: Plan, capacity: int):
        self.capacity, self.windows, self.tape = capacity, plan.windows, plan.tape
        rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 8)
        self.length, self.first, _, self.times, self.sequence, self.offset, self.gap, self.again = rows.T
        self.key = self.length << np.int64(48) | self.first
        self.ends = np.array(edges(plan.tape, capacity), np.int64)

    def fragments(self, length: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Arrays of (which, start within it, length, sequence, offset), until all of each is placed."""
        which, start = np.arange(len(length)), np.zeros(len(length), np.int64)
        while len(which):
            row = np.searchsorted(self.key, length << np.int64(48) | number, side="right") - 1
            beyond = number - self.first[row]
            laid, split = self.times[row] == 0, self.gap[row] > 0
            k, r = np.flatnonzero(~laid), row[~laid]
            times = self.times[r]
            yield which[k], start[k], np.where(self.gap[r] > 0, self.gap[r], length[k]), self.sequence[r] + beyond[k] // times, self.offset[r] + beyond[k] % times * length[k]
            if laid.any():
                k = np.flatnonzero(laid)
                yield from self.on_tape(which[k], start[k], length[k], self.sequence[row[k]] + beyond[k] * length[k])
            k = np.flatnonzero(split)
            r = row[k]
            which, start, length, number = which[k], start[k] + self.gap[r], length[k] - self.gap[r], self.again[r] + beyond[k]

    def on_tape(self, which: np.ndarray, start: np.ndarray, length: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """What lies from token `at` of the tape on, cut where its windows end."""
        whole = self.tape - self.tape % self.capacity
        while len(which):
            last = np.searchsorted(self.ends, at, side="right") - 1
            inside = at < whole
            begin = np.where(inside, at - at % self.capacity, self.ends[last] if len(self.ends) else 0)
            following = np.append(self.ends[1:], self.tape)
            end = np.where(inside, begin + self.capacity, following[last])
            sequence = self.windows + np.where(inside, at // self.capacity, whole // self.capacity + last)
            own = np.minimum(length, end - at)
            yield which, start, own, sequence, at - begin
            k = np.flatnonzero(length > own)
            which, start, length, at = which[k], start[k] + own[k], length[k] - own[k], at[k] + own[k]


def ids_of(encoder: Encoder, texts: pa.Array) -> Iterator[bytes]:
    end = END_ID.to_bytes(4, "little")
    return (ids + end for ids in encoder.encode_all(texts))


def first_cut(tokenizer: str | None, capacity: int):
    """Whole windows of long documents, and the rest of every document."""
    columns = shape(RESTS.removeprefix("doc_id long, text_hash long, "))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(tokenizer, REMEMBERED, REMEMBERED)
        for batch in batches:
            of, out = [], []
            for i, whole in enumerate(ids_of(encoder, batch["text"])):
                for at in range(0, len(whole), 4 * capacity):
                    own = whole[at : at + 4 * capacity]
                    of.append(i)
                    out.append((len(whole) // 4, at // 4, len(own) // 4, zlib.crc32(own)))
            at = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(at), batch["text_hash"].take(at), *arrays(out, columns)], shape(RESTS).names)
        release()

    return run


def place(plan: Broadcast, capacity: int):
    """Fragments of numbered rests; of those that are not whole the checksum is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Places(plan.value, capacity)
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            for which, start, own, sequence, offset in find.fragments(length, number):
                if not len(which):
                    continue
                rows = batch.take(pa.array(which))
                crc = pa.array(rows["ids_crc32"].to_numpy(), mask=own < rows["length"].to_numpy())
                made = [pa.array(rows["start"].to_numpy() + start), pa.array(own), crc, pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays([*(rows[n] for n in shape(DOCUMENT).names), *made], shape(PLACED).names)

    return run


def checksums(tokenizer: str | None):
    """Checksums of the cuts, a list of (start, length), of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(tokenizer, REMEMBERED, REMEMBERED)
        for batch in batches:
            of, out = [], []
            for i, (whole, cuts) in enumerate(zip(ids_of(encoder, batch["text"]), batch["cuts"].to_pylist())):
                for c in cuts:
                    of.append(i)
                    out.append((c["start"], c["length"], zlib.crc32(whole[4 * c["start"] : 4 * (c["start"] + c["length"])])))
            at = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch[n].take(at) for n in ("doc_id", "text_hash")), *arrays(out, shape("start long, length long, ids_crc32 long"))], ["doc_id", "text_hash", "start", "length", "ids_crc32"])
        release()

    return run


def numbered(rests: DataFrame, n: int) -> DataFrame:
    """Rests with a number of their own among those of their length, from 0 on."""
    blocks = max(1, -(-n // BLOCK))
    # Twins go to blocks by a number of their own, so that no block holds more than its share of a length.
    dealt = rests.withColumn("block", F.pmod(F.xxhash64("copy"), F.lit(blocks)))
    sizes = dealt.groupBy("length", "block").agg(F.count(F.lit(1)).alias("size"))
    w = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "block", F.coalesce(F.sum("size").over(w), F.lit(0)).alias("begin"))
    within = dealt.withColumn("within", F.row_number().over(Window.partitionBy("length", "block").orderBy("copy")) - 1)
    return within.join(begins, ["length", "block"]).withColumn("number", F.col("begin") + F.col("within"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: doc_id, doc_tokens, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    small_batches(spark)
    names = shape(DOCUMENT).names
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    found = cut(read.mapInArrow(first_cut(tokenizer, capacity), RESTS).withColumn("copy", F.monotonically_increasing_id()))
    full, rests = found.where(F.col("length") == capacity), found.where(F.col("length") < capacity)
    histogram = {r["length"]: r["count"] for r in rests.groupBy("length").count().collect()}  # capacity - 1 rows at most
    made = plan(histogram, capacity)
    placed = cut(numbered(rests, sum(histogram.values())).select(*shape(RESTS).names, "number").mapInArrow(place(spark.sparkContext.broadcast(made), capacity), PLACED))
    whole = placed.where("ids_crc32 IS NOT NULL").unionByName(full.select(*shape(RESTS).names, (-1 - F.col("copy")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    parts = placed.where("ids_crc32 IS NULL").drop("ids_crc32")
    # Rows that are repeated have the same cuts or others; a document's text is looked up once for all of them.
    texts = parts.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "length")).alias("cuts"))
    few = texts.count() <= CUT_DOCS
    near = F.broadcast(texts) if few else texts
    same = read["doc_id"].eqNullSafe(near["doc_id"]) & (read["text_hash"] == near["text_hash"])
    again = read.join(near, same).select(read["doc_id"], read["text_hash"], read["text"], "cuts").mapInArrow(checksums(tokenizer), "doc_id long, text_hash long, start long, length long, ids_crc32 long")
    sums = again.dropDuplicates(["doc_id", "text_hash", "start", "length"]).alias("c")
    p = parts.alias("p")
    keys = [F.col(f"p.{n}").eqNullSafe(F.col(f"c.{n}")) for n in ("doc_id", "text_hash", "start", "length")]
    mended = p.join(sums, keys).select(*[F.col(f"p.{n}") for n in parts.columns], "c.ids_crc32")
    return whole.unionByName(mended).select(*[n for n in shape(PLACED).names if n != "text_hash"])


def op13_minimum_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
