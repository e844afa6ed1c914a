"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame operations alone.

A window is as many words of a document as an item has, or what is left of them at its end. A window
cannot be as similar to an item as asked for unless the item's shingles in it, each place counted,
weigh that share of the item. Such windows are laid at every start, aligned to a shared shingle or not;
all others are below the similarity. The starts come from a running sum over the places where shared
shingles enter and leave. Windows of one width with the same words are one content.

Contents and items get 64-bit SimHash fingerprints of their weighted shingles; a multi-index over BLOCKS blocks
of bits finds every pair within RADIUS: two fingerprints that differ in at most BLOCKS * (NEAR + 1) - 1 bits
differ in at most NEAR bits of some block, and the index holds all such neighbours of the items'
blocks. A content is only looked up for the items it was laid for, as it is below the similarity to all others;
so the index is probed BLOCKS times for each content and item of its own, not with contents times items.
Pairs found are verified by their exact weighted similarity.

How far apart fingerprints of a pair of just the similarity lie is a matter of chance, and of how evenly the weight is
spread. Each side may lose the share 1 - similarity of its weight, at worst from its heaviest shingles: `loss` is the
share of its squared weights that this takes. The cosine of what is left is at least the root of (1 - loss) * (1 - loss) of both
sides, and a bit differs with the probability arccos(cosine) / pi. Where the cosine may be under COSINE (a quarter of the bits
differ), or a side has under LEAST_SHINGLES shingles, the radius promises nothing: such pairs go past the index, straight to the exact
similarity. For all others a pair is within RADIUS with a probability of 0.9999 or more (the tests measure it by length).

The similarity is the weight of the shared shingles over that of the heavier side. A shingle weighs
its number of occurrences times log(1 + items / items that hold it); one that no item holds
weighs as one that a single item holds. Items with the same words are looked for once.

Defined results: words are runs of letters and digits in lower case; an item of under five words is
one shingle of all of them; null and empty documents and items match nothing, nor do documents with
a null doc_id, which no row could name; repeated items are
reported each, and each counts as an item; repeated rows of a document count as more windows of it; of windows with equal
similarity the first is told; empty tables give no rows; extra columns are
ignored. Documents of any length are read whole.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltlake.llm.common import cut, table

SHINGLE, SIMILARITY = 5, 0.8
BITS, BLOCKS, NEAR = 64, 6, 4
WIDTH = 11  # bits of a block; the last has the rest
RADIUS = BLOCKS * (NEAR + 1) - 1
#: The least cosine, and the least number of distinct shingles, for which the radius holds.
COSINE, LEAST_SHINGLES = 0.7071, 24
#: Weights are whole numbers of this part of one, so that sums do not depend on their order.
GRAIN = 1_000_000
#: Rows that a side may have to be broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000


def words(text: str = "text") -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)


def shingles(k: int) -> Column:
    """Hashes of the k words at each place of the column words."""
    of = F.transform(F.sequence(F.lit(0), F.size("words") - k), lambda i: F.xxhash64(*[F.get(F.col("words"), i + j) for j in range(k)]))
    return F.when(F.size("words") >= k, of).otherwise(F.array().cast("array<long>"))


def small(df: DataFrame, n: int) -> DataFrame:
    """df, to be broadcast if its n rows are few enough."""
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def fingerprint(weighted: DataFrame, key: str, similarity: float = SIMILARITY) -> DataFrame:
    """key, fp, total and keeps from rows of key, h and weight.

    keeps is the share of squared weights that is left at worst when all but the similarity's share of the weight goes; 0 with few shingles.
    """
    sign = lambda b: F.shiftright("h", b).bitwiseAND(1) * 2 - 1
    w = F.col("weight").cast("double")
    spread = [F.sum(w * w).alias("squares"), F.max(w).alias("heaviest"), F.count(F.lit(1)).alias("shingles")]
    sums = weighted.groupBy(key).agg(F.sum("weight").alias("total"), *spread, *[F.sum(sign(b) * F.col("weight")).alias(f"b{b}") for b in range(BITS)])
    bits = [F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")) for b in range(BITS)]
    keeps = F.when(F.col("shingles") >= LEAST_SHINGLES, F.greatest(F.lit(0.0), 1 - (1 - similarity) * F.col("total") * F.col("heaviest") / F.col("squares"))).otherwise(0.0)
    return sums.select(key, reduce(lambda x, y: x.bitwiseOR(y), bits).alias("fp"), "total", keeps.alias("keeps"))


def keyed(fp: str, flips: int) -> Column:
    """A row for each block of a fingerprint, and each value of it with at most so many bits flipped: block and value."""

    def of(b: int) -> Column:
        width = min(WIDTH, BITS - b * WIDTH)
        masks = [sum(1 << i for i in c) for n in range(flips + 1) for c in combinations(range(width), n)]
        own = F.shiftrightunsigned(fp, b * WIDTH).bitwiseAND((1 << width) - 1)
        return F.transform(F.lit(masks), lambda m: F.struct(F.lit(b).alias("block"), own.bitwiseXOR(m.cast("long")).alias("value")))

    return F.explode(F.flatten(F.array(*map(of, range(BLOCKS))))).alias("at")


def sized(sizes: list[int]) -> Column:
    """The shingles of the words by the column k, one of sizes."""
    return reduce(lambda x, k: F.when(F.col("k") == k, shingles(k)).otherwise(x), sizes[1:], shingles(sizes[0]))


def marked(k: int) -> Column:
    """The shingles of k words with k and their places."""
    return F.transform(shingles(k), lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("pos"), h.alias("h")))


def within_radius(probes: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of rows with equal keys whose fingerprints fp and item_fp differ in at most RADIUS bits, each once."""
    left = probes.select("*", keyed("fp", 0)).select("*", "at.block", "at.value").drop("at")
    right = index.select("*", keyed("item_fp", NEAR)).select("*", "at.block", "at.value").drop("at")
    met = left.join(right, [*keys, "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    return met.drop("block", "value").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, n_windows, similarity (the best window's) and start (its first word)."""
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words().alias("words")).where(F.size("words") > 0)
    named = cut(named.withColumn("item", F.xxhash64("words")))
    n_items = named.count()
    items = cut(named.groupBy("item").agg(F.first("words").alias("words"), F.count(F.lit(1)).alias("times")).withColumn("k", F.least(F.lit(SHINGLE), F.size("words"))))
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # at most SHINGLE numbers
    per_size = [items.where(F.col("k") == k).select("item", "times", F.size("words").alias("width"), "k", F.posexplode(shingles(k)).alias("at", "h")) for k in sizes]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not per_size:
        return docs.limit(0).select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0).cast("long").alias("n_windows"), F.lit(0.0).alias("similarity"), F.lit(0).cast("long").alias("start"))
    placed = cut(reduce(DataFrame.unionByName, per_size))
    grains = lambda holders: F.round(F.log1p(F.lit(float(n_items)) / holders) * GRAIN).cast("long")
    holders = placed.select("h", "item", "times").distinct().groupBy("h").agg(F.sum("times").alias("holders"))
    rarity = cut(holders.select("h", grains(F.col("holders")).alias("rarity")))
    n_placed = placed.count()

    weigh = F.col("n") * F.coalesce("rarity", grains(F.lit(1)))
    own = placed.groupBy("item", "width", "k", "h").agg(F.count(F.lit(1)).alias("n")).join(small(rarity, n_placed), "h", "left")
    own = cut(own.select("item", "width", "k", "h", "rarity", weigh.alias("weight")))
    of_items = cut(fingerprint(own, "item", similarity))

    # The places where a document holds a shingle of an item.
    tokens = docs.where(F.col("doc_id").isNotNull()).select("doc_id", words().alias("words"))
    if len(sizes) == 1:
        seen = tokens.select("doc_id", F.lit(sizes[0]).alias("k"), F.posexplode(shingles(sizes[0])).alias("pos", "h"))
    else:
        seen = tokens.select("doc_id", F.explode(F.flatten(F.array(*map(marked, sizes)))).alias("s")).select("doc_id", "s.k", "s.pos", "s.h")
    needs = of_items.select("item", (F.col("total") * (similarity - 1e-8)).alias("need"))
    theirs = own.join(F.broadcast(needs) if n_placed <= BROADCAST_ROWS else needs, "item").select("item", "width", "k", "h", "rarity", "need")
    anchors = seen.join(small(theirs, n_placed), ["h", "k"]).repartition("doc_id", "item").distinct()

    # Starts of windows whose shared places weigh enough: a shingle enters at its least start and leaves past its place.
    enters = F.struct(F.greatest(F.lit(0), F.col("pos") - F.col("width") + F.col("k")).alias("start"), F.col("rarity").alias("more"))
    leaves = F.struct((F.col("pos") + 1).alias("start"), (-F.col("rarity")).alias("more"))
    steps = anchors.select("doc_id", "item", "width", "need", F.explode(F.array(enters, leaves)).alias("step"))
    steps = steps.groupBy("doc_id", "item", "width", "need", "step.start").agg(F.sum("step.more").alias("more"))
    run = Window.partitionBy("doc_id", "item").orderBy("start")
    held_from = F.sum("more").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = steps.select("doc_id", "item", "width", "need", "start", held_from.alias("held"), F.lead("start").over(run).alias("end")).where(F.col("held") >= F.col("need"))
    wanted = cut(spans.select("doc_id", "item", "width", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("start")))
    starts = wanted.select("doc_id", "width", "start").distinct()
    windows = cut(starts.groupBy("doc_id").agg(F.collect_list(F.struct("start", "width")).alias("windows")))
    n_docs = windows.count()

    # Their shingles; windows of one width with the same words are one content from here on.
    texts = docs.join(small(windows, n_docs), "doc_id").select("doc_id", words().alias("all"), F.explode("windows").alias("at"))
    texts = texts.select("doc_id", "at.start", "at.width", F.slice("all", F.col("at.start") + 1, F.col("at.width")).alias("words"))
    texts = texts.withColumn("k", F.least(F.lit(SHINGLE), F.col("width")))
    content = F.unhex(F.md5(F.concat_ws(" ", F.col("width").cast("string"), F.array_join("words", " "))))
    laid = cut(texts.select("doc_id", "start", "width", content.alias("content"), sized(sizes).alias("hs")))
    contents = laid.groupBy("content").agg(F.first("width").alias("width"), F.first("hs").alias("hs"))
    held = contents.select("content", F.explode("hs").alias("h")).groupBy("content", "h").agg(F.count(F.lit(1)).alias("n"))
    held = held.join(small(rarity, n_placed), "h", "left").select("content", "h", weigh.alias("weight"))

    # All pairs of fingerprints within the radius, of contents and the items they were laid for; and those for which it promises nothing.
    of_contents = fingerprint(held, "content", similarity)
    asked = wanted.join(laid.select("doc_id", "start", "width", "content"), ["doc_id", "start", "width"]).select("content", "item").distinct()
    signs = of_items.select("item", F.col("fp").alias("item_fp"), F.col("total").alias("item_total"), F.col("keeps").alias("item_keeps"))
    pairs = cut(asked.join(of_contents, "content").join(small(signs.select("item", "item_total", "item_keeps"), n_placed), "item"))
    sure = F.col("keeps") * F.col("item_keeps") >= COSINE**2
    found = within_radius(pairs.where(sure), signs.where("item_keeps > 0").select("item", "item_fp"), ["item"])
    near = found.select(pairs.columns).unionByName(pairs.where(~sure))

    # Exact similarity of the pairs found.
    theirs = own.select("item", "h", F.col("weight").alias("item_weight"))
    shared = near.join(held, "content").join(theirs, ["item", "h"]).groupBy("content", "item", "total", "item_total").agg(F.sum(F.least("weight", "item_weight")).alias("shared"))
    alike = shared.select("content", "item", (F.col("shared") / F.greatest("total", "item_total")).alias("similarity")).where(F.col("similarity") >= similarity - 1e-9)
    found = laid.select("doc_id", "start", "content").join(alike, "content").join(named.select("item", "item_id"), "item")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before")))
    return found.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_windows"), best.alias("best")).select(
        "doc_id", "item_id", "n_windows", F.round("best.similarity", 9).alias("similarity"), (-F.col("best.before")).cast("long").alias("start")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
