"""Compression of vectors to codes, by Lloyd's rounds over distinct parts.

Vectors become integers and are cut into PARTS equal parts. Equal parts of one position are one weighted row, made by an
aggregation that counts before it shuffles; so all rounds run over distinct parts, however often each occurs. A round
assigns every distinct part to the nearest entry of its position's codebook, in tasks that keep sums by
entry alone; what reaches the driver is one row per entry, PARTS * ENTRIES at most. In the end the codes and errors
of the distinct parts are joined back to the vectors; parts that many vectors share are broadcast
(see jaccard.beside_key), so that no task gets all vectors of one part.

Defined results: vectors that are null or hold null or non-finite components are dropped, as are those with a
component of 65536 or more on either side, whose squared distances need not fit in a long. All vectors
of a run must have one length, a multiple of PARTS; without `dims` it is the most frequent such length (of equals the shortest),
and vectors of other lengths are dropped. Of equal vec_ids the smaller vector comes first in the first codebook, null vec_ids
come last; repeated rows are rows of their own. With fewer than ENTRIES vectors the codebooks are that much smaller. Null labels
are one label. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import cut, small_batches, table
from siltlake.llm.jaccard import beside_key
from siltlake.llm.vectors import component_sums, integers, matrix, squared, whole

PARTS, ENTRIES, ROUNDS = 4, 256, 4
RESULT = "vec_id long, label long, code string, error long"


def length_of(vectors: DataFrame, parts: int) -> int:
    """The most frequent length that `parts` divides; 0 where there is none."""
    size = F.size("v")
    found = vectors.where((size > 0) & (size % parts == 0)).groupBy(size.alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return found["dims"] if found else 0


def part_key(position: Column, part: Column) -> Column:
    return F.struct(position.alias("position"), part.alias("part"))


def sums_by_entry(books: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a task's distinct parts: how many vectors each entry gets and the sum of their parts."""
    entries, width = books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((len(books), entries), np.int64), np.zeros((len(books), entries, width), np.int64)
        for position, x, n in unpacked(batches, width):
            for p, book in enumerate(books):
                at = position == p
                if at.any():
                    entry = squared(x[at], book).argmin(1)
                    np.add.at(counts[p], entry, n[at])
                    np.add.at(sums[p], entry, x[at] * n[at][:, None])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))], ["position", "entry", "n", "sums"])

    return run


def unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch["position"].to_numpy(), matrix(batch["part"], width), batch["n"].to_numpy()


def nearest_entries(books: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each distinct part with its nearest entry and squared distance; of equals the lower entry."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, error = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            position, x = batch["position"].to_numpy(), matrix(batch["part"], width)
            for p, book in enumerate(books):
                at = np.flatnonzero(position == p)
                if len(at):
                    far = squared(x[at], book)
                    entry[at] = far.argmin(1)
                    error[at] = far[np.arange(len(at)), entry[at]]
            yield pa.RecordBatch.from_arrays([batch["position"], batch["part"], batch["n"], pa.array(entry), pa.array(error)], ["position", "part", "n", "entry", "error"])

    return run


def distinct_parts(vectors: DataFrame, dims: int, parts: int) -> DataFrame:
    """position, part and n: the distinct parts of each position, and how many vectors have them."""
    width = dims // parts
    cuts = F.array(*[F.slice("v", p * width + 1, width) for p in range(parts)])
    return vectors.select(F.posexplode(cuts).alias("position", "part")).groupBy("position", "part").agg(F.count(F.lit(1)).alias("n")).select(F.col("position").cast("long").alias("position"), "part", "n")


def train(distinct: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """Lloyd's rounds over weighted distinct parts. Entries that no part is nearest to stay."""
    width = books[0].shape[1]
    for _ in range(rounds):
        found = distinct.mapInArrow(sums_by_entry(books), "position long, entry long, n long, sums array<long>")
        books = [b.copy() for b in books]
        for r in component_sums(found, ["position", "entry"], width).toLocalIterator():
            books[r["position"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return books


def compress(df: DataFrame, dims: int | None = None, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of each vector, and the codebooks by part."""
    spark = df.sparkSession
    small_batches(spark)
    kept = df.where(whole(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), integers(F.col("embedding")).alias("v"))
    dims = dims or length_of(kept, parts)
    if not dims:
        return spark.createDataFrame([], RESULT), []
    if dims % parts:
        raise ValueError(f"{parts} equal parts cannot be cut from {dims} components")
    # A number of its own for every vector, since vec_ids may repeat.
    vectors = cut(kept.where(F.size("v") == dims).withColumn("row", F.monotonically_increasing_id()))
    first = [r["v"] for r in vectors.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()]  # at most `entries`
    if not first:
        return spark.createDataFrame([], RESULT), []
    books = list(np.array(first, np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2))
    distinct = cut(distinct_parts(vectors, dims, parts))
    books = train(distinct, books, rounds)
    coded = cut(distinct.mapInArrow(nearest_entries(books), "position long, part array<int>, n long, entry long, error long").select(part_key(F.col("position"), F.col("part")).alias("key"), "n", "entry", "error"))
    width = dims // parts
    cuts = F.array(*[F.slice("v", p * width + 1, width) for p in range(parts)])
    cells = vectors.select("row", "vec_id", "label", F.posexplode(cuts).alias("position", "part")).select("row", "vec_id", "label", part_key(F.col("position").cast("long"), F.col("part")).alias("key"))
    met = beside_key(cells, coded, "key")
    digits = [F.max(F.when(F.col("key.position") == p, F.lpad(F.lower(F.hex("entry")), 2, "0"))) for p in range(parts)]
    return met.groupBy("row", "vec_id", "label").agg(F.concat(*digits).alias("code"), F.sum("error").alias("error")).drop("row"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compress(table(spark, sf_dir, "embeddings"))
    tag = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("-"))
    rows = cut(found.withColumn("tag", tag))
    by_label = rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("label_error"))
    return beside_key(rows, by_label, "tag").select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, dims: int = 64) -> str:
    width = dims // parts

    def nearest(n: int) -> str:
        far = "list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c)"
        return f"a{n} AS MATERIALIZED (SELECT vec_id, p.pos, any_value(x) AS x, min({{'d': ({far})::BIGINT, 'e': entry}}) AS m FROM parts p JOIN b{n} b ON p.pos = b.pos GROUP BY vec_id, p.pos)"

    steps = [
        "k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, pos, v[pos * {width} + 1 : pos * {width} + {width}] AS x FROM k, range({parts}) t(pos))",
        f"b0 AS MATERIALIZED (SELECT pos, entry, x AS c FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS entry FROM parts) WHERE entry < {entries})",
    ]
    for n in range(rounds):
        steps += [
            nearest(n),
            f"s{n} AS (SELECT pos, m.e AS e, i, sum(x[i]::BIGINT) AS t, count(*) AS n FROM a{n}, range(1, {width + 1}) r(i) GROUP BY ALL)",
            f"b{n + 1} AS MATERIALIZED (SELECT b.pos, b.entry, coalesce(any_value(g.c), any_value(b.c)) AS c FROM b{n} b LEFT JOIN (SELECT pos, e, list(((t - ((t % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM s{n} GROUP BY pos, e) g ON b.pos = g.pos AND b.entry = g.e GROUP BY b.pos, b.entry)",
        ]
    steps += [
        nearest(rounds),
        f"o AS (SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY pos) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)",
        f"h AS (SELECT sha256(string_agg(c[i]::BIGINT::VARCHAR, ',' ORDER BY pos, entry, i)) AS h FROM b{rounds}, range(1, {width + 1}) r(i))",
    ]
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM o JOIN k USING (vec_id), h"
