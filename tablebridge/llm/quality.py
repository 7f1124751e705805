"""Text quality by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text is three streams of n-grams: its words in lower case (1 and 2), the words' shapes (1, 2 and 3; a
shape keeps case, digits and punctuation and drops which letters they are), and whether a word repeats
the one before. Each n-gram is hashed to one of 2**bits weights; the score is the logistic function of a
sparse dot product whose values are the n-grams' shares of their stream, so long and short texts compare.

Null and empty texts, and texts of white space, have no n-grams and score the bias alone. Without
labelled rows every text scores 0.5. Labelled rows with a null label or id don't count; repeated rows do each
time. Rows with a null id are scored like any other. Very long texts are read whole; a labelled one brings
at most one number for each of the 2**bits weights. A score of 0.5 predicts 1. Extra columns aren't looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import map_arrow, mix, pieces, words_of

BITS, SCALE = 18, 8.0
_CACHE = 200_000
#: Bytes as their kind: letters a or A, digits 9, bytes of longer characters a.
_KINDS = bytes(57 if 48 <= b < 58 else 65 if 65 <= b < 91 else 97 if 97 <= b < 123 or b >= 128 else b for b in range(256))
_RUNS = re.compile(rb"(.)\1{2,}", re.DOTALL)


class _Shapes(dict):
    def __missing__(self, kinds: bytes) -> int:
        value = self[kinds] = zlib.crc32(_RUNS.sub(rb"\1\1", kinds))
        return value


_SHAPES = _Shapes()


class _Hashes(dict):
    """word -> word hash << 32 | shape hash, for as many words as memory allows."""

    def __missing__(self, word: str) -> int:
        value = self[word] = zlib.crc32(word.lower().encode("utf-8", "replace")) << 32 | _SHAPES[word.encode("utf-8", "replace").translate(_KINDS)]
        return value


_HASHES = _Hashes()


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of each n-gram occurrence of a whole text."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    if len(_HASHES) > _CACHE:
        _HASHES.clear()
        _SHAPES.clear()
    both = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    odd = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        streams = [word + np.uint64(1 << 40), shape + np.uint64(2 << 40)]
        if len(words) > 1:
            streams += [word[:-1] * odd + word[1:], shape[:-1] * odd + shape[1:] + np.uint64(1)]
            streams.append((word[:-1] == word[1:]).astype(np.uint64) + np.uint64(3 << 40))
        if len(words) > 2:
            streams.append((shape[:-2] * odd + shape[1:-1]) * odd + shape[2:] + np.uint64(2))
        index = mix(np.concatenate(streams)) >> np.uint64(64 - bits)
    return index.astype(np.int64), np.concatenate([np.full(len(s), SCALE / len(s)) for s in streams])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, text: str | None) -> float:
        index, value = features(text, self.bits)
        z = self.bias + (float(self.weights[index] @ value) if len(index) else 0.0)
        return 1 / (1 + np.exp(-min(max(z, -60.0), 60.0)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.01, l2: float = 0.001, epochs: int = 6, seed: int = 5) -> Model:
    """FTRL-proximal over (unique indices, values, label 0 or 1) in shuffled order; the bias is one more coordinate."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    rows = [(np.append(i, size), np.append(v, 1.0), y) for i, v, y in rows]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            i, v, y = rows[k]
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ v, -60, 60))) - y) * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    all_weights = weights(np.arange(size + 1))
    return Model(all_weights[:-1], float(all_weights[-1]), bits)


def combined(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    index, value = features(text, bits)
    unique, at = np.unique(index, return_inverse=True)
    return unique, np.bincount(at, weights=value, minlength=len(unique)) if len(unique) else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 2000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Train on at most about ``per_label`` rows of each label, picked by a hash of the id: the bound on what is gathered.

    The n-grams are made where the texts are; the driver gets at most 2**bits numbers a row.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not counts:
        return None
    # One share for both keeps their proportion, and with it the scores' meaning.
    share = min(1.0, 2 * per_label / sum(counts.values()))
    u = F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1 << 30)) / float(1 << 30)
    picked = known.where(u < share).limit(4 * per_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 64):
            made = [combined(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([i.tolist() for i, _ in made], pa.list_(pa.int32())), pa.array([v.tolist() for _, v in made], pa.list_(pa.float32()))], names=["id", "y", "i", "v"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id").select("id", "y", "text")
    got = map_arrow(rows, run, f"id {kind}, y int, i array<int>, v array<float>").toArrow()
    if not got.num_rows:
        return None
    order = np.argsort(np.array(got["id"].to_pylist()), kind="stable")
    index, value, y = got["i"].combine_chunks(), got["v"].combine_chunks(), got["y"].to_numpy()
    return train([(index[int(k)].values.to_numpy().astype(np.int64), value[int(k)].values.to_numpy().astype(np.float64), int(y[k])) for k in order])


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score double of each whole text; no shuffle."""
    small = None if model is None else Model(model.weights.astype(np.float32), model.bias, model.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            got = [0.5 if small is None else small.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, score double").withColumnRenamed("id", id_col)
