"""Language identification by a convolutional network over bytes.

Filters of widths 2, 3 and 4 slide over windows of fixed length that cover the whole text; each
filter's maximum in a window goes through a rectifier to a softmax over the languages. The network is
trained in numpy on windows of labelled texts. A text's probabilities are the mean over its windows.

One more class, the background, is trained on windows that are no language: labelled windows with their
bytes in another order, and letters drawn at random from several scripts. It is never predicted: a
prediction is the likeliest language, its score the share among languages. :func:`keep_identified`
rejects texts that are likelier background than all languages together.

A filter of width w is w tables of 256 bytes; two neighbouring tables are joined into one of 65,536
byte pairs, so a window costs few table reads for each byte and no multiplication.

Null texts and texts without a letter are ``und`` with score 0, as is everything where no labelled
text was given. Training rows with a null text or label don't count; every label that is left is
learned. Very long texts are read whole, window by window. Repeated rows get equal predictions, rows with
a null id as well; ties between languages go to the first in alphabetical order. Extra columns pass
through :func:`keep_identified` and aren't looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import map_arrow, pieces

WIDTHS = (2, 3, 4)


@dataclass
class ByteNet:
    labels: list[str]
    #: by width: (width, 256, filters)
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    window: int = 256

    def languages(self, p: np.ndarray) -> tuple[np.ndarray, float]:
        """(shares among the languages, probability of the background) of a text's mean probabilities."""
        n = len(self.labels)
        return p[:n] / max(float(p[:n].sum()), 1e-30), float(p[n:].sum())

    def tables(self) -> list[tuple[int, list[tuple[int, np.ndarray]]]]:
        """By width, (offset, table) to add up; tables of 65,536 rows are for byte pairs."""
        out = []
        for w, f in self.filters.items():
            f = f.astype(np.float32)
            parts = [(k, (f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, -1)) for k in range(0, w - 1, 2)]
            out.append((w, parts + ([(w - 1, f[w - 1])] if w % 2 else [])))
        return out


def cut_windows(raw: bytes, size: int) -> np.ndarray:
    """All bytes of a text as rows of ``size``; the last window ends with the text, a short text is padded with spaces."""
    n = len(raw)
    if n <= size:
        return np.frombuffer(raw.ljust(size), dtype=np.uint8).reshape(1, size)
    a = np.frombuffer(raw, dtype=np.uint8)
    whole = n // size
    out = a[: whole * size].reshape(whole, size)
    return out if n % size == 0 else np.vstack([out, a[n - size :]])


class Scorer:
    def __init__(self, net: ByteNet) -> None:
        self.net, self.tables = net, net.tables()

    def pooled(self, x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        out = []
        for w, parts in self.tables:
            n = x.shape[1] - w + 1
            total = None
            for k, table in parts:
                index = (pairs if len(table) == 65536 else x)[:, k : k + n]
                if total is None:
                    total = np.take(table, index, axis=0)
                else:
                    total += np.take(table, index, axis=0)
            out.append(total.max(axis=1))
        return np.concatenate(out, axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), 16):  # small enough for the processor's cache
            hidden = np.maximum(self.pooled(x[at : at + 16]) + self.net.bias, 0)
            z = hidden @ self.net.dense + self.net.dense_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)


def some_windows(text: str, size: int, most: int, seed: int) -> np.ndarray:
    """At most ``most`` windows of a text."""
    w = cut_windows(text.encode("utf-8", "replace"), size)
    return w[np.random.default_rng(seed).choice(len(w), min(len(w), most), replace=False)]


def background(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """As many windows as ``x`` that are no language: half with their bytes shuffled, half of random letters."""
    out = rng.permuted(x, axis=1)
    scripts = [(97, 123), (65, 123), (0x400, 0x460), (0x391, 0x3CA), (0x5D0, 0x5EB), (0x627, 0x64B), (0x905, 0x93A), (0x3041, 0x3097), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4)]
    for k in range(0, len(x), 2):
        low, high = scripts[rng.integers(len(scripts)) if k % 4 else 0]
        letters = rng.integers(low, high, x.shape[1])
        letters[rng.random(x.shape[1]) < rng.uniform(0, 0.25)] = 32
        out[k] = np.frombuffer("".join(map(chr, letters)).encode()[: x.shape[1]].ljust(x.shape[1]), dtype=np.uint8)
    return out


def train(texts: list[str], labels: list[str], window: int = 256, windows_per_text: int = 4, seed: int = 7, **options) -> ByteNet:
    """A network from whole texts; see :func:`fit`."""
    got = [some_windows(t, window, windows_per_text, seed + i) for i, t in enumerate(texts)]
    return fit(np.concatenate(got), [label for label, w in zip(labels, got, strict=True) for _ in w], seed=seed, **options)


def fit(x: np.ndarray, labels: list[str], filters: int = 8, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteNet:
    """Adam on the cross-entropy of windows. Rows count as if every language, and the background, had as many."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    window = x.shape[1]
    index = {n: k for k, n in enumerate(names)}
    y = np.array([index[n] for n in labels])
    noise = background(x[rng.integers(0, len(x), max(500, -(-len(x) // len(names))))], rng)
    x, y = np.concatenate([x, noise]), np.concatenate([y, np.full(len(noise), len(names))])
    classes = len(names) + 1
    share = 1 / np.maximum(np.bincount(y, minlength=classes), 1)
    weight = share[y] / share[y].mean()
    net = ByteNet(names, {w: rng.normal(0, 0.1, (w, 256, filters)) for w in WIDTHS}, np.zeros(filters * len(WIDTHS)), rng.normal(0, 0.3, (filters * len(WIDTHS), classes)), np.zeros(classes), window)
    params = [*net.filters.values(), net.bias, net.dense, net.dense_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    lane = np.arange(filters)
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            xb, yb = x[at], y[at]
            tops, pooled = [], []
            for w, f in net.filters.items():
                n = window - w + 1
                s = sum(f[k][xb[:, k : k + n]] for k in range(w))
                top = s.argmax(axis=1)
                tops.append(top)
                pooled.append(np.take_along_axis(s, top[:, None, :], axis=1)[:, 0])
            before = np.concatenate(pooled, axis=1) + net.bias
            hidden = np.maximum(before, 0)
            z = hidden @ net.dense + net.dense_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(at)), yb] -= 1
            g *= (weight[at] / len(at))[:, None]
            gh = (g @ net.dense.T) * (before > 0)
            grads = []
            for i, (w, f) in enumerate(net.filters.items()):
                gf, part = np.zeros_like(f), gh[:, i * filters : (i + 1) * filters]
                for k in range(w):
                    np.add.at(gf[k], (np.take_along_axis(xb, tops[i] + k, axis=1), lane[None, :]), part)
                grads.append(gf)
            grads += [gh.sum(axis=0), hidden.T @ g, g.sum(axis=0)]
            step += 1
            for p, d, m, v in zip(params, grads, first, second, strict=True):
                m *= 0.9
                m += 0.1 * d
                v *= 0.999
                v += 0.001 * d * d
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def labelled_windows(docs: DataFrame, per_label: int = 500, window: int = 256, windows_per_text: int = 4, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id") -> tuple[np.ndarray, list[str]]:
    """Windows and labels of about ``per_label`` labelled texts of each label, picked by a hash of the id. That, and
    ``windows_per_text`` windows of ``window`` bytes a text, is the bound on what training gathers, however long texts are.

    Labels are counted first; then rows pass whose hash falls in their label's share. No rows meet in one task.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull() & (F.length(text_col) > 0))
    counts = rows.groupBy(F.col(label_col).alias("label")).count().collect()
    if not counts:
        return np.zeros((0, window), dtype=np.uint8), []
    share = F.create_map(*[x for r in sorted(counts) for x in (F.lit(r["label"]), F.lit(min(1.0, 1.0 * per_label / r["count"])))])
    u = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.where(u < F.coalesce(share[F.col(label_col)], F.lit(0.0))).select(F.col(id_col).cast("string").alias("id"), F.col(label_col).alias("label"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 64):
            got = [some_windows(t, window, windows_per_text, zlib.crc32(str(i).encode())).tobytes() for i, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.binary())], names=["id", "label", "windows"])

    # A hash deals out shares, not counts: twice the expected number is never reached but by ids that repeat.
    got = map_arrow(picked, run, "id string, label string, windows binary").limit(2 * per_label * len(counts)).collect()
    got = sorted(got, key=lambda r: (hashlib.md5(str(r["id"]).encode()).digest(), bytes(r["windows"])))
    x = [np.frombuffer(bytes(r["windows"]), dtype=np.uint8).reshape(-1, window) for r in got]
    return (np.concatenate(x) if x else np.zeros((0, window), dtype=np.uint8)), [r["label"] for r, w in zip(got, x, strict=True) for _ in w]


def predict(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred string, score double: the likeliest label of each whole text and its mean probability; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net else None
        for b in pieces(batches):
            langs, scores = [], []
            for text in b.column(1).to_pylist():
                if scorer is None or not text or not any(map(str.isalpha, text)):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                p, _ = net.languages(scorer.probabilities(cut_windows(text.encode("utf-8", "replace"), net.window)).mean(axis=0))
                k = int(p.argmax())
                langs.append(net.labels[k])
                scores.append(min(1.0, float(p[k])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def is_identified(text: str | None, scorer: Scorer | None, most_background: float = 0.5) -> bool:
    if scorer is None or not text or not any(map(str.isalpha, text)):
        return False
    p = scorer.probabilities(cut_windows(text.encode("utf-8", "replace"), scorer.net.window)).mean(axis=0)
    return scorer.net.languages(p)[1] <= most_background


def keep_identified(docs: DataFrame, net: ByteNet | None, most_background: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in some learned language: with a letter, and with a background probability of at most
    ``most_background``. Texts that mix learned languages stay. All columns stay; no shuffle. Without a network none stays."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net else None
        for b in pieces(batches):
            yield b.filter(pa.array([is_identified(t, scorer, most_background) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
