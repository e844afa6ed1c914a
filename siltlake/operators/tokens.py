"""Tokenising sensitive columns in batches."""

from __future__ import annotations

import hashlib
import json
import random
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tokenizer = Callable[[list[str]], list[str]]


def columns_of(config: object) -> list[str]:
    """Column names from a list, a dict's keys, comma-separated text or a JSON string."""
    if not config:
        return []
    if isinstance(config, str):
        text = config.strip()
        return columns_of(json.loads(text)) if text[:1] in "[{" else [c.strip() for c in text.split(",") if c.strip()]
    return [str(c) for c in config]


def digest_tokenizer(salt: str = "") -> Tokenizer:
    """A deterministic tokenizer for tests and offline use."""
    return lambda values: [hashlib.sha256((salt + v).encode()).hexdigest() for v in values]


def with_retries(tokenizer: Tokenizer, values: list[str], tries: int = 5, wait: float = 0.2) -> list[str]:
    for n in range(tries):
        try:
            out = tokenizer(values)
            break
        except ConnectionError:
            if n == tries - 1:
                raise
            time.sleep(wait * 2**n * (0.5 + random.random()))
    if len(out) != len(values):
        raise ValueError(f"the tokenizer returned {len(out)} tokens for {len(values)} values")
    return out


def tokenize(df: DataFrame, columns: Sequence[str], tokenizer: Tokenizer, batch: int = 500) -> DataFrame:
    """Replaces the non-blank values of columns by tokens, as strings; at most `batch` values a call. A wrong count fails the task: plain values never pass.

    Other columns stay in Arrow as they are, so a null beside a long changes neither.
    """
    names = [c for c in columns if c in df.columns]
    if not names:
        return df
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in names})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            arrays = dict(zip(rows.schema.names, rows.columns))
            for c in names:
                values = arrays[c].to_pylist()
                live = [k for k, v in enumerate(values) if v is not None and v.strip()]
                plain = [values[k] for k in live]
                tokens = [t for k in range(0, len(plain), batch) for t in with_retries(tokenizer, plain[k : k + batch])]
                for k, t in zip(live, tokens):
                    values[k] = t
                arrays[c] = pa.array(values, arrays[c].type)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    return df.mapInArrow(run, df.schema)
