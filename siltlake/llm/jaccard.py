"""N-gram Jaccard self-join by chosen paths.

A document is the set of its five-word shingles. Documents with the same words make one text. The
join then follows chosen paths: a text gets 64 min-hash coordinates; a run samples coordinates (one,
and with probability 1/similarity - 1 another) and splits the texts by their values there; buckets
of more than LEAF texts are split again on coordinates sampled by their path, up to DEPTH times. The
number of runs follows from the recall asked for at the least similarity: the chance that a pair
stays together down to DEPTH is a branching process with known survival. All runs draw from the same
coordinates, so the recall is that chance over all runs, averaged over the number that agree.

Buckets are compared by brute force on the coordinates. As a first step every bucket's texts are held
against one of them, its pivot; texts found alike make groups, and a bucket within one group is
done. Where all but RESIDUE texts of a large bucket are of one group, splitting would not part them:
the others are compared with all and among each other, the group in blocks. What is still large at
the last split is compared in pairs of blocks.

Compared texts that look similar enough make candidate groups. In each group all pairs are compared
exactly, on the shingle sets, in blocks of bounded size that only give counts and a spanning forest:
pairs are never emitted. The forest's components are the classes.

Result: one row per document with class_id (the least doc_id of its class), n_copies (rows with the
same words) and n_links (other texts of similarity SIMILARITY or more).

Defined results: words are runs of letters and digits in lower case; a text of under five words is
one shingle of all of them; rows whose text is null or has no words are classes of their own, with
n_copies 1 and n_links 0; repeated rows are copies; ties take the least doc_id, a null one last; an empty
table gives no rows; extra columns are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import WordTable, cut_clean, each, groups, per_text, release, rolled, table, texts

SHINGLE, SIMILARITY = 5, 0.8
COORDINATES = 64
#: Recall asked for on pairs of exactly the least similarity; closer pairs are found more surely.
RECALL = 0.9995
#: Splits at most; the first ROOT are taken at once, as buckets after fewer are large in a large corpus. A
#: bucket of at most LEAF texts is not split any more.
DEPTH, ROOT, LEAF = 4, 2, 250
#: Coordinates that may differ by chance below the least similarity: four standard deviations.
MARGIN = 0.2
#: Rows of a bucket that a join over buckets holds under one key on average.
PART = 250
#: Keys of a join that are broadcast at most; a key of a smaller part of all rows, or of up to PART rows, is not.
HOT = 100_000
#: Texts that one block of a comparison of coordinates holds on average, and texts outside a bucket's largest group.
BLOCK, RESIDUE = 500, 250
#: Texts, and bytes of shingle sets, that a block of the exact comparison holds on average at most.
EXACT_TEXTS, EXACT_BYTES = 1000, 6 << 20
WORD = re.compile(r"[^\W_]+")
SIGNED = "cls binary, sig binary, n_words long"


def survival(depth: int, similarity: float, agreeing: float | None = None) -> float:
    """Chance that a pair shares a path down to depth: a node samples 1 or 2 coordinates, 1/similarity on average.

    agreeing is the share of coordinates that agree, similarity if not given.
    """
    second, p = 1 / similarity - 1, 1.0
    for _ in range(depth):
        q = (similarity if agreeing is None else agreeing) * p
        p = (1 - second) * q + second * (1 - (1 - q) ** 2)
    return p


def recall_of(runs: int, depth: int = DEPTH, similarity: float = SIMILARITY) -> float:
    """Chance that a pair of the similarity meets in some run and has enough coordinates that agree."""
    chance = lambda k: math.comb(COORDINATES, k) * similarity**k * (1 - similarity) ** (COORDINATES - k)
    met = lambda k: 1 - (1 - survival(depth, similarity, k / COORDINATES)) ** runs
    return sum(chance(k) * met(k) for k in range(needed(), COORDINATES + 1))


def runs_for(recall: float = RECALL, depth: int = DEPTH, similarity: float = SIMILARITY) -> int:
    """The least number of runs of the recall."""
    most = recall_of(1 << 20, depth, similarity)
    if recall > most:
        raise ValueError(f"{COORDINATES} coordinates give a recall of {most:.6f} at most")
    return next(n for n in range(1, 1 << 20) if recall_of(n, depth, similarity) >= recall)


def needed() -> int:
    """The least number of agreeing coordinates of texts that look alike."""
    return math.ceil((SIMILARITY - MARGIN) * COORDINATES)


def word_codes(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64).view(np.int64)[:, None]


def shingle_set(codes: np.ndarray) -> np.ndarray:
    """Sorted hashes of a text's shingles."""
    return np.unique(rolled(codes, min(SHINGLE, max(1, len(codes)))))


def min_hashes(shingles: np.ndarray, xors: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(xors), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 1024):
        np.minimum(out, ((low[k : k + 1024, None] ^ xors) * factors).min(axis=0), out=out)
    return out.view(np.int32)


class Shingler:
    """Codes of a text's words; remembers those of recurring words."""

    def __init__(self):
        self.known = WordTable(word_codes, 1, np.int64)

    def codes(self, text: str | None) -> np.ndarray:
        self.known.room()
        words = WORD.findall(text.lower()) if text else []
        return self.known.take(words)[:, 0].view(np.uint64)


def class_key(codes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(np.ascontiguousarray(codes).tobytes())


def signer():
    """The class key, the coordinates and the number of words of a text."""
    shingler = Shingler()
    rng = np.random.default_rng(3)
    xors = rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)
    factors = rng.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(text: str | None) -> tuple[bytes | None, bytes | None, int]:
        codes = shingler.codes(text)
        if not len(codes):
            return None, None, 0
        return class_key(codes), min_hashes(shingle_set(codes), xors, factors).tobytes(), len(codes)

    return sign


def chosen(run: int) -> list[int]:
    """The coordinates a run samples at the root."""
    rng = np.random.default_rng([17, run])
    return rng.choice(COORDINATES, 1 + int(rng.random() < 1 / SIMILARITY - 1), replace=False).tolist()


def children(path: Column) -> Column:
    """An array of a path's children: by the values of sig at the coordinates that the path samples."""
    at = lambda salt: F.pmod(F.xxhash64(path, F.lit(salt)), F.lit(COORDINATES)).cast("int")
    child = lambda i: F.xxhash64(path, i, F.substring(F.col("sig"), 4 * i + 1, F.lit(4)))
    two = F.pmod(F.xxhash64(path, F.lit(0)), F.lit(1 << 20)) < (1 / SIMILARITY - 1) * (1 << 20)
    step = at(2) % (COORDINATES - 1) + 1  # so that the second differs from the first
    other = (at(1) + step) % COORDINATES
    return F.when(two, F.array(child(at(1)), child(other))).otherwise(F.array(child(at(1))))


def roots_of(runs: int, root: int) -> Column:
    """An array of all runs' paths after the first root splits."""
    paths = F.array(*[F.xxhash64(F.lit(run), F.lit(i), F.substring("sig", 4 * i + 1, 4)) for run in range(runs) for i in chosen(run)])
    for _ in range(root - 1):
        paths = F.flatten(F.transform(paths, children))
    return paths


def split(rows: DataFrame) -> DataFrame:
    """Children of path, cls, sig."""
    return rows.select(F.explode(children(F.col("path"))).alias("path"), "cls", "sig")


def in_blocks(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Deals each group under key into its number of blocks and gives every pair of blocks, as unit, its rows.

    Adds unit, part (the row's own block) and cross (whether the unit is of two blocks).
    """
    dealt = rows.withColumn("blocks", F.ceil(blocks).cast("int")).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return dealt.withColumn("unit", F.xxhash64(key, low, high)).withColumn("cross", F.col("part") != F.col("other")).drop("blocks", "other")


def alike_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows pivot, pivot_sig, cls, sig: those whose coordinates agree on enough places, as a, b."""
    need = needed()
    for batch in batches:
        t = pa.Table.from_batches([batch])
        sig, pivot = (np.frombuffer(b"".join(t[c].to_pylist()), np.int32).reshape(len(t), -1) for c in ("sig", "pivot_sig"))
        near = t.filter(pa.array((sig == pivot).sum(axis=1) >= need)) if len(t) else t
        for b in near.select(["pivot", "cls"]).rename_columns(["a", "b"]).to_batches():
            yield b


def beside_key(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """rows joined with side: a row for each key, with n, how many of rows have it.

    The many rows of one key, as a third of all may have, never meet in a task. Keys of more than PART rows and
    of more than a HOT-th of all rows are HOT at most, whatever the table: those are broadcast, the others shuffled.
    """
    whole = side.agg(F.sum("n")).scalar()
    hot = side.where(F.col("n") > F.greatest(F.lit(float(PART)), whole / float(HOT)))
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(side, key)
    return rows.join(F.broadcast(hot), key).unionByName(others)


def beside_bucket(rows: DataFrame, side: DataFrame) -> DataFrame:
    """rows joined with side, one row for each path; a large bucket is dealt into parts, so that it is not one key of the join."""
    parts = F.ceil(F.col("n") / float(PART)).cast("int")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("cls"), parts).cast("int"))
    return dealt.join(side.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n"), ["path", "part"]).drop("part")


def pivot_edges(rows: DataFrame) -> DataFrame:
    """Edges from the pivot of each bucket of path, cls, sig, n to the texts that look like it."""
    pivots = rows.groupBy("path").agg(F.min(F.struct("cls", "sig")).alias("p"), F.max("n").alias("n")).select("path", "n", F.col("p.cls").alias("pivot"), F.col("p.sig").alias("pivot_sig"))
    met = beside_bucket(rows, pivots).where(F.col("cls") != F.col("pivot")).select("pivot", "pivot_sig", "cls", "sig")
    return met.mapInArrow(alike_pivot, "a binary, b binary").distinct()


def pivot_groups(edges: DataFrame) -> DataFrame:
    """node and component: the least pivot a text looks like, or that one's. Groups need not be whole: what they part is compared."""
    own = edges.groupBy("b").agg(F.min("a").alias("up")).select(F.col("b").alias("node"), F.least("up", "b").alias("up"))
    higher = own.select(F.col("node").alias("n2"), F.col("up").alias("up2"))
    ups = own.groupBy("up").agg(F.count(F.lit(1)).alias("n")).join(higher, F.col("up") == F.col("n2"), "left").select("up", "n", "up2")
    found = beside_key(own, ups, "up").select("node", F.coalesce("up2", "up").alias("component"))
    tops = found.select(F.col("component").alias("node"), F.col("component"))
    return found.union(tops).groupBy("node").agg(F.min("component").alias("component"))


def grouped(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows with the group of each text (itself where it has none), the bucket's largest group and how many texts are outside it."""
    rows = rows.join(known, rows["cls"] == known["node"], "left").select("path", "cls", "sig", "n", F.coalesce("component", "cls").alias("component"))
    sizes = rows.groupBy("path", "component").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"))
    top = sizes.groupBy("path").agg(F.max(F.struct("m", "component")).alias("top"), F.max("n").alias("n")).select("path", "n", F.col("top.m").alias("m"), F.col("top.component").alias("largest"))
    return beside_bucket(rows, top).select("path", "cls", "sig", "n", "m", (F.col("component") == F.col("largest")).alias("inner"))


def places(cls: list[bytes]) -> list[int]:
    """Where the distinct texts of a unit stand, in their order."""
    order = sorted(range(len(cls)), key=cls.__getitem__)
    return [i for k, i in enumerate(order) if not k or cls[i] != cls[order[k - 1]]]


def roots(linked: np.ndarray) -> np.ndarray:
    """The least member of each place's component, by a symmetric matrix of links; every row of it is read once."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        front = np.array([i])
        while root[i] in (-1, i) and len(front):
            root[front] = i
            front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
    return root


def look_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a forest over texts of each unit whose coordinates agree on enough places."""
    need = needed()
    for _, rows in groups(batches, "unit"):
        cls = rows["cls"].to_pylist()
        at = places(cls)
        sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.int32).reshape(len(cls), -1)[at]
        linked = np.zeros((len(at), len(at)), bool)
        for k in range(0, len(at), 16):
            same = (sig[k : k + 16, None, :] == sig[None, k:, :]).sum(axis=2) >= need
            linked[k : k + 16, k:], linked[k:, k : k + 16] = same, same.T
        root = roots(linked)
        below = np.flatnonzero(root != np.arange(len(root))).tolist()
        if below:
            named = lambda x: pa.array([cls[at[i]] for i in x], pa.binary())
            yield pa.RecordBatch.from_arrays([named(root[below].tolist()), named(below)], ["a", "b"])


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of slices of the incidence matrix; what one set alone holds is left out."""
    out = np.zeros((len(sets), len(sets)), np.float32)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    np.fill_diagonal(out, [len(s) for s in sets])
    shared = times[column] > 1
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[shared]
    column = (np.cumsum(times > 1) - 1).astype(np.int32)[column[shared]]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    size = out.diagonal().copy()
    width = 2048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [first, first + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[lo:hi], column[lo:hi] - first] = 1
        out += part @ part.T
    np.fill_diagonal(out, size)
    return out


def links_among(sets: list[np.ndarray], part: np.ndarray | None) -> np.ndarray:
    """Matrix of who is linked to whom; with part, only across the parts."""
    size, both = np.array([len(s) for s in sets], float), intersections(sets)
    linked = np.zeros(both.shape, bool)
    for k in range(0, len(sets), 128):
        linked[k : k + 128] = both[k : k + 128] >= SIMILARITY * (size[k : k + 128, None] + size - both[k : k + 128]) - 1e-9
    np.fill_diagonal(linked, False)
    if part is not None:
        linked &= part[:, None] != part
    return linked


def count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each unit: the number of links of each text, and its root in a forest over the links."""
    for _, rows in groups(batches, "unit"):
        cls = rows["cls"].to_pylist()
        if len(at := places(cls)) < 2:
            continue
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows["shingles"].take(at)]
        # Pairs within a block belong to that block's own unit.
        part = rows["part"].to_numpy()[at] if rows["cross"][0].as_py() else None
        linked = links_among(sets, part)
        some = np.flatnonzero(linked.any(axis=1))
        root = roots(linked)[some].tolist()
        named = lambda x: pa.array([cls[at[i]] for i in x], pa.binary())
        if len(some):
            yield pa.RecordBatch.from_arrays([named(some.tolist()), pa.array(linked[some].sum(axis=1), pa.int64()), named(root)], ["cls", "links", "root"])
        del rows, sets, linked
    release()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of an undirected graph a, b, by large-star and small-star steps."""
    now = cut_clean(edges.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct())
    while True:
        # Done once the edges are stars: no node has two lower ones, and none is lower and higher at once.
        parts = now.select(F.col("high").alias("node"), F.lit(1).alias("h"), F.lit(0).alias("l")).union(now.select(F.col("low").alias("node"), F.lit(0).alias("h"), F.lit(1).alias("l")))
        if parts.groupBy("node").agg(F.sum("h").alias("h"), F.max("l").alias("l")).where("h > 1 OR (h > 0 AND l > 0)").isEmpty():
            break
        both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).union(now.select(F.col("high").alias("u"), F.col("low").alias("v")))
        # A node of many edges, as the hub of a star is, does not meet them all in one task.
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = cut_clean(beside_key(both, least, "u").where("v > u").select(F.col("m").alias("low"), F.col("v").alias("high")).where("low <> high"))
        down = large.groupBy("high").agg(F.min("low").alias("m"), F.count(F.lit(1)).alias("n"))
        met = beside_key(large, down, "high")
        small = met.select(F.least("m", "low").alias("low"), F.greatest("m", "low").alias("high")).union(met.select(F.col("m").alias("low"), "high"))
        now = cut_clean(small.where("low <> high").distinct())
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).union(now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def set_maker():
    """The class key of a text and its shingle set; of texts with the same words a task makes the set once."""
    shingler, seen = Shingler(), set()

    def of(text: str | None) -> tuple[bytes | None, bytes | None]:
        codes = shingler.codes(text)
        if not len(codes) or (key := class_key(codes)) in seen:
            return None, None
        seen.add(key)
        return key, shingle_set(codes).tobytes()

    return of


def candidates(distinct: DataFrame, recall: float = RECALL, depth: int = DEPTH, leaf: int = LEAF) -> DataFrame:
    """Edges a, b between texts that chosen paths bring together and whose coordinates look alike."""
    first = distinct.select("cls", F.explode(roots_of(runs_for(recall, depth), ROOT)).alias("path"))
    sizes = first.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = cut_clean(beside_key(first, sizes, "path").join(distinct.select("cls", "sig"), "cls").select("path", "cls", "sig", "n"))
    starred = cut_clean(pivot_edges(rows))
    known = cut_clean(pivot_groups(starred))
    units = []
    for level in range(ROOT, depth + 1):
        rows = cut_clean(grouped(rows, known).where("m < n"))
        units.append(rows.where(F.col("n") <= leaf).select(F.col("path").alias("unit"), "cls", "sig"))
        large = rows.where(F.col("n") > leaf)
        # The few texts outside the largest group meet each of its blocks.
        few = F.col("n") - F.col("m") <= RESIDUE
        blocks = F.ceil(F.col("m") / float(BLOCK)).cast("int")
        of = F.when(F.col("inner"), F.array(F.pmod(F.xxhash64("cls"), blocks).cast("int"))).otherwise(F.sequence(F.lit(0), blocks - 1))
        units.append(large.where(few).select("path", "cls", "sig", F.explode(of).alias("block")).select(F.xxhash64("path", "block").alias("unit"), "cls", "sig"))
        if level == depth:
            units.append(in_blocks(large.where(~few), "path", F.col("n") / float(BLOCK)).select("unit", "cls", "sig"))
            break
        open_ = cut_clean(split(large.where(~few)))
        if open_.isEmpty():
            break
        sizes = open_.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = beside_key(open_, sizes, "path").select("path", "cls", "sig", "n")
    dealt = reduce(DataFrame.unionByName, units).repartition("unit").sortWithinPartitions("unit")
    return starred.union(dealt.mapInArrow(look_alike, "a binary, b binary")).distinct()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the digest of the text that tells rows of one doc_id apart."""
    return texts(docs).withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))


def linked_texts(docs: DataFrame, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Rows of docs with doc_id, key and cls, and for each cls its first row (top), n_copies, n_links and component."""
    rows = keyed(docs)
    signed = cut_clean(per_text(rows, each(signer), SIGNED, beside="doc_id long, key binary"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("top")
    distinct = cut_clean(signed.where("cls IS NOT NULL").groupBy("cls").agg(first, F.count(F.lit(1)).alias("n_copies"), F.first("sig").alias("sig"), F.first("n_words").alias("n_words")))
    near = cut_clean(components(candidates(distinct, recall)))
    near = near.join(distinct.select("cls", "top", "n_words"), near["node"] == distinct["cls"]).select("cls", "top", "component", "n_words")
    blocks = F.greatest(F.count(F.lit(1)) / float(EXACT_TEXTS), F.sum("n_words") * 8 / float(EXACT_BYTES))
    sizes = near.groupBy("component").agg(blocks.alias("blocks"), F.count(F.lit(1)).alias("n"))
    members = beside_key(near, sizes, "component").select("cls", F.col("top.doc_id").alias("of"), F.col("top.key").alias("key"), "component", "blocks")
    found = rows.join(members, (rows["key"] == members["key"]) & rows["doc_id"].eqNullSafe(members["of"])).select("text", "cls", "component", "blocks")
    sets = per_text(found, each(set_maker), "made binary, shingles binary", beside="cls binary, component binary, blocks double").where("made = cls")
    units = in_blocks(sets, "component", F.col("blocks")).select("unit", "cls", "part", "cross", "shingles")
    counted = cut_clean(units.repartition("unit").sortWithinPartitions("unit").mapInArrow(count_links, "cls binary, links long, root binary"))
    links = counted.groupBy("cls").agg(F.sum("links").alias("n_links"))
    found = components(counted.select(F.col("root").alias("a"), F.col("cls").alias("b")))
    ids = distinct.select("cls", "top", "n_copies").join(found, F.col("cls") == F.col("node"), "left").select("cls", "top", "n_copies", F.coalesce("component", "cls").alias("component"))
    return signed.select("doc_id", "key", "cls"), ids.join(links, "cls", "left").select("cls", "top", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component")


def similarity_classes(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_copies and n_links for every row of docs."""
    signed, ids = linked_texts(docs, recall)
    least = ids.groupBy("component").agg(F.min("top").alias("least"), F.count(F.lit(1)).alias("n")).select("component", F.col("least.doc_id").alias("class_id"), "n")
    ids = beside_key(ids, least, "component").select("cls", "class_id", F.col("n_copies").alias("n"), "n_links")
    found = beside_key(signed.where("cls IS NOT NULL").select("doc_id", "cls"), cut_clean(ids), "cls").select("doc_id", "class_id", F.col("n").alias("n_copies"), "n_links")
    alone = signed.where("cls IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return found.union(alone)


def representatives(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """docs with one row of each class: that of the least doc_id, then of the least digest of its text.

    Rows without words are classes of their own; of rows that repeat a doc_id and its text one stays.
    """
    signed, ids = linked_texts(docs, recall)
    least = ids.groupBy("component").agg(F.min("top").alias("least")).select(F.col("least.doc_id").alias("kept"), F.col("least.key").alias("kept_key"))
    kept = least.union(signed.where("cls IS NULL").select("doc_id", "key")).distinct()
    key = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    left = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["kept"]) & (key == kept["kept_key"]), "left_semi")
    repeated = signed.groupBy("doc_id", "key").count().where("count > 1")
    return left if repeated.isEmpty() else left.dropDuplicates(["doc_id", "text"])


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
t AS (SELECT array_to_string(w, ' ') AS t, min(doc_id) AS first, count(*) AS n_copies, any_value(w) AS w FROM w WHERE len(w) > 0 GROUP BY 1),
s AS (SELECT DISTINCT first AS d, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM t, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i)),
n AS (SELECT d, count(*) AS n FROM s GROUP BY d),
p AS (SELECT a.d AS a, b.d AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.d <> b.d GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.d = a JOIN n y ON y.d = b WHERE shared >= 0.8 * (x.n + y.n - shared) - 1e-9),
c AS (SELECT first AS d, first AS r FROM t UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.d),
k AS (SELECT d, min(r) AS class_id FROM c GROUP BY d),
m AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_copies, 1)::BIGINT AS n_copies, coalesce(n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN t ON array_to_string(w.w, ' ') = t.t AND len(w.w) > 0 LEFT JOIN k ON k.d = t.first LEFT JOIN m ON m.a = t.first
"""
