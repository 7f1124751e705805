"""Token counts by dynamic programming over prefixes.

Every prefix of a text has an exact token count; the counts answer truncation and budget questions
without encoding again. Null and empty texts count zero tokens and have the one prefix of length 0.
Special strings inside a text count as one token each, as the library's default has it. Repeated
rows each get their row; extra columns are not looked at, and an empty table gives an empty result. Very
long texts are counted whole, word by word; only :func:`prefix_token_counts` holds a number for each
character. There are no ties: an encoding is unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm import bpe
from tablebridge.llm.common import map_arrow, pieces


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def token_counts(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes (UTF-8), n_tokens of each whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(vocabulary)
        for b in pieces(batches):
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), pa.array([coder.count(t) for t in texts], pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


def prefix_token_counts(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, prefix_tokens array<int>: entry k is the exact token count of the first k characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(vocabulary)
        for b in pieces(batches, 32):
            rows = [coder.prefix_counts(t).tolist() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["id", "prefix_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, prefix_tokens array<int>").withColumnRenamed("id", id_col)


def truncate_to_budget(docs: DataFrame, vocabulary: bytes, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, text_col, n_tokens: the longest prefix of each text whose own encoding has at most ``budget`` tokens.

    A longer prefix can have fewer tokens than a shorter one, so the answer is the last fitting entry.
    """
    if budget < 0:
        raise ValueError("budget must not be negative")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(vocabulary)
        for b in pieces(batches, 64):
            texts, counts = [], []
            for t in b.column(1).to_pylist():
                table = coder.prefix_counts(t)
                k = int(np.flatnonzero(table <= budget)[-1])
                texts.append((t or "")[:k])
                counts.append(int(table[k]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["id", "text", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, text string, n_tokens long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)
