"""Stages of the corpus pipeline: language ID, near duplicates, decontamination, secrets, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), works on every row its
predecessor kept and returns the columns of docs, but for the last, which returns the packed pieces.

* language_id drops documents that the language models reject: those without a letter or null, and
  those unlike every learned language; with nothing to learn from it drops all.
* near_duplicates keeps one row of each class of texts linked by a Jaccard similarity of five-word
  shingles of 0.8 or more: that of the least doc_id (a null one last), then of the least digest of its text.
* decontamination drops documents that hold a benchmark item; rows with a null doc_id stay.
* secrets replaces what is secret in a text by REDACTED and sets n_chars of those rows anew.
* packing lays what is left into sequences.

Null texts go in the first stage; rows that repeat a document become one in the second; texts of any length are
read whole; extra columns go along; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siltlake.llm import decontaminate, jaccard, langid, packing, secrets
from siltlake.llm.common import SLICE, release, remove, scratch, small_batches, table

REDACTED = "<SECRET>"
#: SQL cannot express trained models, fingerprints and packing; tests hold the stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.learn(docs)
    if model is None:
        return docs.limit(0)

    def keep(batches):
        of = langid.scorer(model)
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                part = batch.slice(k, SLICE)
                yield part.filter(pa.array([not r[3] for r in of(part["text"].to_pylist())], pa.bool_()))
        del of
        release()

    small_batches(spark)
    return docs.mapInArrow(keep, docs.schema)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    found = decontaminate.cut(found.select("doc_id").distinct())
    return docs.join(decontaminate.small(found, found.count()), "doc_id", "left_anti").select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = secrets.learn(docs)

    def redact(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                part = batch.slice(k, SLICE)
                texts, clean = part["text"].to_pylist(), []
                lengths = part["n_chars"].to_pylist() if "n_chars" in part.schema.names else None
                for i, text in enumerate(texts):
                    clean.append(secrets.redacted(text, field, REDACTED))
                    if lengths and clean[i] != text:
                        lengths[i] = len(clean[i])
                columns = dict(zip(part.schema.names, part.columns))
                columns["text"] = pa.array(clean, part.schema.field("text").type)
                if lengths:
                    columns["n_chars"] = pa.array(lengths, part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=part.schema.names)
        release()

    small_batches(spark)
    return docs.mapInArrow(redact, docs.schema)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every earlier one is written to the shared folder and read again.

    A stage's folder goes once the next one is written; the last one stays, as the result is read from it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
