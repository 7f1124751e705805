"""Byte-level BPE encoding by backtracking over longest matches, and decoding from an offset table.

Null and empty texts encode to no tokens and decode to the empty text. Special strings inside a text
become their special token, as the library's default has it. Very long texts are encoded whole, word by
word. Repeated rows are encoded alike; there are no ties, as an encoding is unique; extra columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm import bpe
from tablebridge.llm.common import map_arrow, pieces


def encode(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int> of each whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(vocabulary)
        for b in pieces(batches, 64):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(coder.encode_arrays(b.column(1).to_pylist())), pa.list_(pa.int32()))], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, text: the decoded ids; bytes that aren't UTF-8 become U+FFFD. Null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(vocabulary)
        for b in pieces(batches, 64):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([coder.decode(np.asarray(i or [], dtype=np.int64)) for i in b.column(1).to_pylist()], pa.string())], names=["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_arrow(encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")), run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256: both directions in one pass, without writing the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(vocabulary)
        for b in pieces(batches):
            counts, ids_sha, text_sha = [], [], []
            for ids in coder.encode_arrays(b.column(1).to_pylist()):
                back = coder.decode_bytes(ids)
                try:
                    back.decode()
                except UnicodeDecodeError:
                    back = back.decode("utf-8", "replace").encode()
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(coder.decimals(ids)).hexdigest())
                text_sha.append(hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
