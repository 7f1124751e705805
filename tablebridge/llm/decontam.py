"""Benchmark passages in documents, by greedy string tiling.

Tokens are runs of letters and digits in lower case; other ASCII characters only separate them. Seeds are
runs of ``min_match`` tokens; an item with fewer tokens is one seed as a whole. A pass over the documents
keeps the seeds that a bitmap knows from the benchmark; the rest of the search is a join on seeds.

Of an item with n tokens at least ``threshold * n`` must be covered. A tile of L tokens holds L - m + 1
seeds of m tokens, which is L / m or more, so at least ``threshold * n / m`` of the item's positions must
start a seed of the document. Pairs are counted and dropped by that bound before any text moves. The
bound also lets an item do without some positions: those whose seeds are common to many items, so that
a run which all documents and items share doesn't join all of them.

Each candidate is tiled: the longest run of tokens that both texts still have unmarked is found by
Karp-Rabin hashes and bisection on its length, all its non-overlapping occurrences are marked, and so on
down to ``min_match``. The share of an item's tokens under tiles is its coverage. As tiles may come in any
order, passages that were cut up and reordered are found as well. What a window's hash finds is compared
token by token (as 64-bit hashes) before it is marked.

Null and empty texts and texts without tokens match nothing. Items with fewer than ``min_match`` tokens are
found where a document holds all of them in a row. Equal items are found alike, each under its id;
repeated rows of a document give one finding, ties in coverage are no question. A coverage equal to the
threshold is a leak. Rows with a null id match nothing and stay. Very long texts are read whole; a
document goes to a task once for each :data:`ITEMS` candidates. Other columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.llm.common import BITMAP_BITS, cut, groups, id_bitmap, map_arrow, pieces, rekeyed, split_by_bitmap, windows, word_hashes

#: The most that the seed bitmap takes, 16 MB. It has eight bits for each seed of the benchmark; beyond, it lets more
#: seeds pass than need be, and the join sorts them out.
MOST_BITS = 1 << 27
#: Seeds of more items than this are common.
COMMON = 8
#: Items that a copy of a document's text is tiled with.
ITEMS = 512

_SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def token_hashes(text: str | None) -> np.ndarray:
    return word_hashes(text.lower().encode("utf-8", "replace").translate(_SEPARATE).split()) if text else np.zeros(0, dtype=np.uint64)


def _open(marked: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n tokens hold no marked token."""
    total = np.concatenate([[0], np.cumsum(marked)])
    return total[n:] == total[: len(total) - n] if len(marked) >= n else np.zeros(0, dtype=bool)


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """(position in item, position in document, length) of the tiles, longest first; ties by position."""
    out: list[tuple[int, int, int]] = []
    in_item, in_doc = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
    most = min(len(item), len(doc))

    def common(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = windows(item, n), windows(doc, n)
        at_b = np.flatnonzero(_open(in_doc, n))
        at_a = np.flatnonzero(_open(in_item, n))
        at_a = at_a[np.isin(a[at_a], b[at_b])]
        return a, b, at_a, at_b

    while most >= min_match:
        low, high = min_match - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            if len(common(middle)[2]):
                low = middle
            else:
                high = middle - 1
        if low < min_match:
            break
        a, b, at_a, at_b = common(low)
        order = at_b[np.argsort(b[at_b], kind="stable")]
        keys = b[order]
        for p in at_a.tolist():
            if in_item[p : p + low].any():
                continue
            for d in order[np.searchsorted(keys, a[p], "left") : np.searchsorted(keys, a[p], "right")].tolist():
                if not in_doc[d : d + low].any() and (item[p : p + low] == doc[d : d + low]).all():
                    in_item[p : p + low] = in_doc[d : d + low] = True
                    out.append((p, d, low))
                    break
        most = low  # nothing longer is left; runs of this length may be, if their place in the document was taken
    return out


def _item_seeds(items: DataFrame, min_match: int) -> DataFrame:
    """item, n (its tokens), m (tokens of its seeds), seed, positions (at which the seed starts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = token_hashes(text)
                m = min(min_match, len(h))
                seeds, positions = np.unique(windows(h, m), return_counts=True)
                k = len(seeds)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, i, dtype=np.int64)), pa.array(np.full(k, len(h), dtype=np.int64)), pa.array(np.full(k, m, dtype=np.int64)), pa.array(seeds.view(np.int64)), pa.array(positions.astype(np.int64))], names=["item", "n", "m", "seed", "positions"])

    return map_arrow(items, run, "item long, n long, m long, seed long, positions long")


def _document_seeds(rows: DataFrame, lengths: list[int], known: object, bits: int) -> DataFrame:
    """id, seeds array<long>: the distinct seeds of (id, text), of any of the lengths, that are in the broadcast bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(known.value, dtype=np.uint8)
        for b in pieces(batches):
            found = []
            for text in b.column(1).to_pylist():
                h = token_hashes(text)
                w = np.concatenate([windows(h, m) for m in lengths]) if lengths else h[:0]
                at = (w & np.uint64(bits - 1)).astype(np.int64)
                w = w[(table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                found.append(np.unique(w).view(np.int64) if len(w) else w.view(np.int64))
            made = pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "seeds"])
            yield made.filter(pa.array([len(x) > 0 for x in found], pa.bool_()))

    return map_arrow(rows, run, "id long, seeds array<long>")


def _bitmap(seeds: DataFrame, bits: int) -> bytes:
    """bits / 8 bytes."""
    # Blocks and the positions in them count from 1.
    at = seeds.select((F.pmod("seed", F.lit(bits)) + 1).alias("at"))
    rows = at.groupBy(F.expr("bitmap_bucket_number(at)").cast("int").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")).collect()
    out = bytearray(bits // 8)
    for r in rows:
        begin = (r["block"] - 1) * 4096
        out[begin : begin + 4096] = r["bitmap"]
    return bytes(out)


def _needed(item_seeds: DataFrame, threshold: float, common: int) -> DataFrame:
    """The item seeds to join on, and the least sum of ``positions`` that a pair needs to reach the threshold: ``need``."""
    least = F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(threshold) * F.col("n") / F.col("m") - F.lit(1e-9)))
    frequent = item_seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("items")).select(rekeyed("seed").alias("key"), "items")
    known = item_seeds.join(frequent, rekeyed("seed") == F.col("key")).withColumn("least", least)
    # An item has no more seeds than tokens.
    order = Window.partitionBy("item").orderBy(F.desc("items"), "seed").rowsBetween(Window.unboundedPreceding, 0)
    ranked = known.withColumn("so_far", F.sum("positions").over(order))
    spared = (F.col("items") > common) & (F.col("so_far") < F.col("least"))
    without = F.coalesce(F.max(F.when(spared, F.col("so_far"))).over(Window.partitionBy("item")), F.lit(0))
    return ranked.withColumn("need", F.col("least") - without).where(~spared).select("item", "seed", "positions", "need")


def _candidates(texts: DataFrame, items: DataFrame, threshold: float, min_match: int, common: int, bits: int | None) -> DataFrame:
    """id, item: pairs that may reach the threshold."""
    item_seeds = cut(_item_seeds(items, min_match))
    known = item_seeds.agg(F.count(F.lit(1)).alias("seeds"), F.collect_set("m").alias("lengths")).first()
    size = bits or min(MOST_BITS, max(BITMAP_BITS, 1 << (8 * known["seeds"]).bit_length()))
    bitmap = texts.sparkSession.sparkContext.broadcast(_bitmap(item_seeds, size))
    doc_seeds = _document_seeds(texts, sorted(known["lengths"]), bitmap, size).select("id", F.explode("seeds").alias("seed"))
    wanted = cut(_needed(item_seeds, threshold, common))
    # Rows that share an id are added up, and the least need of an id's texts holds: that only lets more pairs pass.
    shared = doc_seeds.join(wanted, "seed").groupBy("id", "item").agg(F.sum("positions").alias("positions"), F.min("need").alias("need"))
    return cut(shared.where("positions >= need").select("id", "item"))


def contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = 0.0, common: int = COMMON, bits: int | None = None) -> DataFrame:
    """id_col, item_col, n_tokens (of the item), n_covered, coverage, longest (tile), for each pair that shares a seed and
    whose coverage reaches ``threshold``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).where("id is not null and text is not null").distinct()
    pairs = _candidates(texts, items, threshold, min_match, common, bits)
    spread = pairs.groupBy("id").count().select(rekeyed("id").alias("key"), F.ceil(F.col("count") / ITEMS).cast("int").alias("chunks"))
    placed = pairs.join(spread, rekeyed("id") == F.col("key")).select("id", "item", F.pmod(F.xxhash64("item"), F.col("chunks")).cast("int").alias("chunk"))
    maybe, _ = split_by_bitmap(texts, "id", id_bitmap(pairs, "id"))
    # A document's text goes to a task once, ahead of its items.
    own = maybe.join(placed.select("id", "chunk").distinct(), "id").select("id", "chunk", F.lit(None).cast("long").alias("item"), "text")
    asked = placed.join(items.select(F.col("id").alias("item"), "text"), "item").select("id", "chunk", "item", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, _), t in groups(batches, 2):
            rows = list(zip(t["item"].to_pylist(), t["text"].to_pylist(), strict=True))
            mine = [token_hashes(text) for item, text in rows if item is None]
            out = []
            for item, text in rows:
                if item is not None:
                    h = token_hashes(text)
                    m = min(min_match, len(h))
                    # Rows that share an id are one document: its best row counts.
                    best = max(((sum(x[2] for x in found), max((x[2] for x in found), default=0)) for found in (tiles(h, d, m) for d in mine)), default=(0, 0))
                    out.append((item, len(h), *best))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(out), pa.int64()), *(pa.array(c, pa.int64()) for c in columns)], names=["id", "item", "n_tokens", "n_covered", "longest"])

    rows = own.unionByName(asked).repartition("id", "chunk").sortWithinPartitions("id", "chunk", "item")
    tiled = map_arrow(rows, run, "id long, item long, n_tokens long, n_covered long, longest long")
    # An item whose id has several texts: its best counts.
    best = tiled.groupBy("id", "item").agg(F.max_by(F.struct("n_tokens", "n_covered", "longest"), F.struct(F.col("n_covered") / F.col("n_tokens"), "n_covered", "longest")).alias("m"))
    out = best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "m.n_tokens", "m.n_covered", (F.col("m.n_covered") / F.col("m.n_tokens")).alias("coverage"), "m.longest")
    return out.where((F.col("n_covered") > 0) & (F.col("coverage") >= threshold))


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, **options) -> DataFrame:
    """The pairs of :func:`contamination` whose coverage reaches the threshold."""
    return contamination(docs, benchmark, threshold=threshold, **options)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is covered to the threshold. Only rows whose id may be among those
    to go are shuffled with their texts."""
    found = cut(leaks(docs, benchmark, threshold, id_col=id_col, **options).select(F.col(id_col).alias("__tb_leak")).distinct())
    maybe, clean = split_by_bitmap(docs, id_col, id_bitmap(found, "__tb_leak"))
    return clean.unionByName(maybe.join(found, F.col(id_col) == F.col("__tb_leak"), "left_anti"))
