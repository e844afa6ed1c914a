"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct words a Python worker remembers before it starts afresh.
WORD_CACHE = 150_000
#: New words that a worker looks at together.
BLOCK = 4096
#: Rows of an Arrow batch.
BATCH = 1000
#: Rows whose texts a worker holds as Python strings at once.
SLICE = 500
#: Least seconds between two collections of the driver's garbage.
COLLECT = 4.0
#: Arrow types of the types in a schema's text.
KINDS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of documents that no model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that extra columns never reach a Python worker."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shape(ddl: str, more: dict[str, pa.DataType] | None = None) -> pa.Schema:
    """The Arrow schema of columns given as text; more has the types that KINDS lacks."""
    return pa.schema([(name, ((more or {}) | KINDS)[kind]) for name, kind in (c.split(" ", 1) for c in ddl.split(", "))])


def arrays(rows: list[tuple], columns: pa.Schema) -> list[pa.Array]:
    return [pa.array(values, f.type) for values, f in zip(zip(*rows), columns)] if rows else [pa.array([], f.type) for f in columns]


def small_batches(spark: SparkSession) -> None:
    """Lowers the rows of an Arrow batch where the session has Spark's own number: buffers on both sides of a worker's pipe stay small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH))


def release() -> None:
    """Gives memory that a task has freed back to the system, as a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def each(begin: Callable[[], Callable[[str | None], tuple]]) -> Callable[[], Callable[[list[str | None]], list[tuple]]]:
    """For per_text: applies what begin gives to one text after another."""

    def many() -> Callable[[list[str | None]], list[tuple]]:
        of = begin()
        return lambda values: [of(t) for t in values]

    return many


def per_text(docs: DataFrame, begin: Callable[[], Callable[[list[str | None]], list[tuple]]], ddl: str, more: dict[str, pa.DataType] | None = None, beside: str = "doc_id long") -> DataFrame:
    """The columns of docs named beside, and in those of ddl what the function that begin gives makes of a list of texts.

    begin runs once a task. Ids never leave Arrow, so a null beside them changes none of them.
    """
    columns, names = shape(ddl, more), shape(beside).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = begin()
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                part = batch.slice(k, SLICE)
                made = arrays(of(part["text"].to_pylist()), columns)
                yield pa.RecordBatch.from_arrays([*(part[n] for n in names), *made], [*names, *columns.names])
        del of
        release()

    small_batches(docs.sparkSession)
    return docs.select(*names, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{beside}, {ddl}")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a session on one machine that names none gets a new one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if spark.sparkContext.master.startswith("local-") or not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="siltlake-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: short lineage that survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def cut_clean(df: DataFrame) -> DataFrame:
    """cut(), after which the driver collects its garbage if it has not done so for COLLECT seconds.

    Spark removes shuffle files once the driver forgets the plan that made them. In a long run of steps these
    would otherwise lie on the executors' disks until the driver happens to need memory.
    """
    out = cut(df)
    if time.monotonic() - Collected.at > COLLECT:
        gc.collect()
        df.sparkSession._jvm.System.gc()
        Collected.at = time.monotonic()
    return out


class Collected:
    """When the driver last collected its garbage."""

    at = 0.0


def scratch(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of scratch()."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fraction(key: Column, salt: int) -> Column:
    """A uniform number in [0, 1) that depends on key alone."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


class WordTable:
    """Rows of numbers by word, computed once for each distinct word in a worker.

    make(list of words) returns one array row per word. The table starts afresh between
    documents once it holds WORD_CACHE words, so memory is bounded whatever the vocabulary.
    """

    def __init__(self, make, width: int, dtype, most: int = WORD_CACHE):
        self.make, self.width, self.dtype, self.most = make, width, dtype, most
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, self.width), self.dtype)

    def indexes(self, words: list[str]) -> np.ndarray:
        """Row number of each word; valid until the next call of room()."""
        if new := [w for w in dict.fromkeys(words) if w not in self.at]:
            n = len(self.at)
            if n + len(new) > len(self.rows):
                grown = np.zeros((max(2 * len(self.rows), n + len(new)), self.width), self.dtype)
                grown[:n] = self.rows[:n]
                self.rows = grown
            for k in range(0, len(new), BLOCK):
                self.rows[n + k : n + min(k + BLOCK, len(new))] = self.make(new[k : k + BLOCK])
            self.at.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def take(self, words: list[str]) -> np.ndarray:
        at = self.indexes(words)  # first, as it may replace rows
        return self.rows[at]

    def room(self) -> None:
        if len(self.at) > self.most:
            self.clear()


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of n codes."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out = codes[: len(codes) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - n + 1 + k]
    return mixed(out)


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Consecutive rows of one key from Arrow batches, as (key, rows); a group may span batches."""
    now, parts = None, []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), n]
        for a, b in zip(edges, edges[1:]):
            if parts and keys[a] != now:
                yield now, pa.Table.from_batches(parts)
                parts = []
            now = keys[a]
            parts.append(batch.slice(a, b - a))
    if parts:
        yield now, pa.Table.from_batches(parts)
