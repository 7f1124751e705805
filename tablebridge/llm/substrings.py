"""Removal of word passages that an earlier document already has, by level-wise doubling of windows.

The lengths are the wanted one, its half, the half of that and so on (50, 25, 13), looked at from the
shortest on. Of all windows of one length inside a window of the next, the one with the smallest hash is
its anchor; as that depends on the words alone, equal windows have equal anchors. So at the first level
documents only compare their anchors, about 2 in 14 of their windows. A level keeps the windows that two
documents share. They alone are extended to twice the length: a document goes on only with the longer
windows all of whose windows repeat, and only if it has any; their anchors are compared again, until the
wanted length is reached, where whole windows are compared by 96 bits. :func:`repeat_levels` doubles
beyond that, until no candidate survives.

A document whose words all equal an earlier document's is settled by its word sequence alone.

Null and empty texts and texts of white space have no words: nothing is removed. Texts shorter than a
window are kept whole. Very long texts are read whole; windows come by the batch of a few documents. Rows
that share an id are one document, so none of them removes the other's words; ties between equal windows
go to the smallest id. Rows with a null id are kept whole and remove nothing. Extra columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import cut, id_bitmap, map_arrow, mix, pieces, rekeyed, sequence_key, split_by_bitmap, windows, word_bytes, word_hashes

#: Lengths are halved until they are this short.
START = 16


def ladder(length: int, start: int = START) -> list[int]:
    """The lengths of the levels, each at most twice the one before; at least one doubling."""
    out = [length]
    while out[0] > max(1, start) or len(out) == 1:
        out.insert(0, -(-out[0] // 2))
    return out


def anchors(h: np.ndarray, short: int, long: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each window of ``short`` words, position of the anchor of each window of ``long`` words) of word hashes."""
    g = windows(h, short)
    span = long - short + 1
    if len(g) < span:
        return g, np.zeros(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g, span)
    return g, np.concatenate([view[i : i + 4096].argmin(axis=1) + np.arange(i, min(i + 4096, len(view))) for i in range(0, len(view), 4096)])


def repeating(h: np.ndarray, short: int, long: int, hits: list[int]) -> np.ndarray:
    """Which windows of ``long`` words may repeat: those whose anchor is among the hits."""
    g, at = anchors(h, short, long)
    return np.isin(g[at].view(np.int64), np.array(hits, dtype=np.int64))


def full_keys(h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits for each full window, as a long and an int."""
    return windows(h, length).view(np.int64), (windows(mix(h + np.uint64(1)), length, 0xD1342543DE82EF95) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _base(docs: DataFrame, short: int, long: int, length: int) -> DataFrame:
    """id, key1, key2 (of the word sequence), anchors, of documents with a window of ``length`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            k1, k2, found = [], [], []
            for text in b.column(1).to_pylist():
                h = word_hashes(word_bytes(text))
                if len(h) < length:
                    h = h[:0]
                g, at = anchors(h, short, long)
                k1.append(sequence_key(h, 1))
                k2.append(sequence_key(h, 2))
                found.append(np.unique(g[at]).view(np.int64))
            keep = pa.array([len(x) > 0 for x in found], pa.bool_())
            made = pa.RecordBatch.from_arrays([b.column(0), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["id", "key1", "key2", "anchors"])
            yield made.filter(keep)

    return map_arrow(docs, run, "id long, key1 long, key2 long, anchors array<long>")


def _doubled(docs: DataFrame, short: int, middle: int, long: int) -> DataFrame:
    """id, anchors: windows of ``middle`` words that anchor one of ``long`` words, all of whose windows of ``middle`` words
    may repeat. docs: id, text, hits (windows of ``short`` words that repeat)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 32):
            found = []
            for text, hits in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                h = word_hashes(word_bytes(text))
                missing = np.concatenate([[0], np.cumsum(~repeating(h, short, middle, hits))])
                g, at = anchors(h, middle, long)
                span = long - middle + 1
                whole = missing[span:] == missing[: len(missing) - span] if len(missing) > span else np.zeros(0, dtype=bool)
                found.append(np.unique(g[at[whole]]).view(np.int64))
            made = pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "anchors"])
            yield made.filter(pa.array([len(x) > 0 for x in found], pa.bool_()))

    return map_arrow(docs.select("id", "text", "hits"), run, "id long, anchors array<long>")


def _extended(docs: DataFrame, short: int, length: int) -> DataFrame:
    """The distinct full windows of each document (id, text, hits) whose anchor is among its hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 32):
            ids, ks, ls = [], [], []
            for i, text, hits in zip(*(c.to_pylist() for c in b.columns), strict=True):
                h = word_hashes(word_bytes(text))
                keep = repeating(h, short, length, hits)
                k, low = full_keys(h, length)
                k, first = np.unique(k[keep], return_index=True)
                ids.append(np.full(len(k), i, dtype=np.int64))
                ks.append(k)
                ls.append(low[keep][first])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ks, ls, ids)], names=["k", "low", "id"])

    return map_arrow(docs.select("id", "text", "hits"), run, "k long, low int, id long")


def _hits(found: DataFrame) -> DataFrame:
    """id, hits: those of a document's anchors (id, anchors) that another document has as well."""
    each = found.select("id", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select(rekeyed("anchor").alias("key"))
    return cut(each.join(shared, rekeyed("anchor") == F.col("key")).groupBy("id").agg(F.collect_set("anchor").alias("hits")))


def repeated_windows(docs: DataFrame, length: int, start: int = START) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs (id long, text). Gives (id, keys array<long>: its windows that start in a document with a smaller id,
    without whole copies), (id, copies array<long>: keys of whole texts that equal an earlier document's), and
    (id: documents that share a window with another one)."""
    docs = docs.where("id is not null")
    levels = ladder(length, start)
    base = cut(_base(docs, levels[0], levels[1], length))
    classes = base.groupBy("key1", "key2").agg(F.min("id").alias("rep"), F.max("id").alias("last")).select(rekeyed("key1").alias("k1"), rekeyed("key2").alias("k2"), "rep", "last")
    placed = base.join(classes, (rekeyed("key1") == F.col("k1")) & (rekeyed("key2") == F.col("k2")))
    copies = cut(placed.where("rep <> last").groupBy("id").agg(F.collect_set(F.when(F.col("id") != F.col("rep"), F.col("key1"))).alias("copies")))
    hits = _hits(placed.where("id = rep").select("id", "anchors"))

    def with_hits() -> DataFrame:
        maybe, _ = split_by_bitmap(docs, "id", id_bitmap(hits, "id"))
        return maybe.join(hits, "id")

    for short, middle, long in zip(levels, levels[1:], levels[2:], strict=False):
        hits = _hits(cut(_doubled(with_hits(), short, middle, long)))
    full = _extended(with_hits(), levels[-2], length)
    first = full.groupBy("k", "low").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select(rekeyed("k").alias("key"), F.col("low").alias("key_low"), "first")
    both = full.join(first, (rekeyed("k") == F.col("key")) & (F.col("low") == F.col("key_low")))
    shared = cut(both.groupBy("id").agg(F.collect_set(F.when(F.col("id") > F.col("first"), F.col("k"))).alias("keys")))
    return shared.where("size(keys) > 0"), copies.where("size(copies) > 0"), shared.select("id").union(copies.select("id")).distinct()


def covered(h: np.ndarray, keys: list[int] | None, copies: list[int] | None, length: int) -> np.ndarray:
    """Which words lie in a window among ``keys``."""
    out = np.zeros(len(h), dtype=bool)
    if copies and sequence_key(h, 1) in copies:
        out[:] = True
    elif keys and len(h) >= length:
        hit = np.isin(windows(h, length).view(np.int64), np.array(keys, dtype=np.int64)).astype(np.int64)
        step = np.zeros(len(h) + 1, dtype=np.int64)
        step[: len(hit)] += hit
        step[length : length + len(hit)] -= hit
        out = np.cumsum(step)[:-1] > 0
    return out


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, start: int = START) -> DataFrame:
    """id_col, n_words, n_removed and the kept words joined by one space: as text, or with ``digest`` as kept_sha256."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    removed, copies, _ = repeated_windows(rows, length, start)
    maybe, clean = split_by_bitmap(rows, "id", id_bitmap(removed.select("id").union(copies.select("id")), "id"))
    marked = maybe.join(removed, "id", "left").join(copies, "id", "left").select("id", "text", "keys", "copies")
    plain = clean.withColumns({"keys": F.lit(None).cast("array<long>"), "copies": F.lit(None).cast("array<long>")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 64):
            n, gone, kept = [], [], []
            for _, text, keys, copied in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = word_bytes(text)
                if keys or copied:
                    mask = covered(word_hashes(words), keys, copied, length)
                    left = b" ".join([w for w, m in zip(words, mask.tolist(), strict=True) if not m])
                    gone.append(int(mask.sum()))
                else:
                    left = b" ".join(words)
                    gone.append(0)
                n.append(len(words))
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "kept"])

    done = [map_arrow(x.select("id", "text", "keys", "copies"), run, "id long, n_words long, n_removed long, kept string") for x in (marked, plain)]
    return done[0].unionByName(done[1]).select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_sha256" if digest else text_col))


def repeat_levels(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, words: of each document that repeats an earlier one's passage, the last of the lengths
    length, 2 * length, 4 * length ... at which it still does. Documents without a repeat at one length
    don't take part at the next; the levels end when none survives."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found: DataFrame | None = None
    alive, n = rows, length
    while True:
        # Beyond the first length one doubling leads from the length before to this one.
        removed, copies, shared = repeated_windows(alive, n, START if n == length else n)
        at = cut(removed.select("id").union(copies.select("id")).distinct().withColumn("words", F.lit(n)))
        if at.limit(1).count() == 0:
            break
        found = at if found is None else found.union(at)
        alive = rows.join(cut(shared), "id", "left_semi")
        n *= 2
    if found is None:
        return rows.where("false").select(F.col("id").alias(id_col), F.lit(0).alias("words"))
    return found.groupBy(F.col("id").alias(id_col)).agg(F.max("words").alias("words"))
