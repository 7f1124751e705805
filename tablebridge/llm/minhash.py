"""Near-duplicate documents by b-bit MinHash.

1. One pass makes each document's shingle set, its minima under ``bands * rows`` hash functions, a key
   for each band of minima, and the low bits of the mixed minima packed into a signature.
2. Documents with equal sets form a class; the smallest id stands for it from here on.
3. Representatives that share a band key are candidates. A bucket only links its members to its
   smallest id, so a group of n copies makes n rows; what hangs together is a cluster.
4. Clusters are dealt out in blocks that are bounded in documents and in shingles. In a block, pairs not
   yet connected are estimated from signatures (agreeing low bits, corrected for chance agreement) and
   what may reach the threshold is confirmed on the full sets; small sets are confirmed without an
   estimate. A block emits a spanning forest of its links, never all of them.
5. The few documents of a cluster that most others share a bucket with, its hubs, are in all its blocks,
   which ties components of blocks together. The hub with the most documents tied to it makes the
   cluster's main component; every document outside of it then visits the other blocks that hold a
   document with one of its band keys. So no candidate between components is missed, and members of the
   main one aren't compared again.

The chance that a pair at the threshold shares no band is below (1 - 0.8 ** 5) ** 40, about 1e-7. That
the estimate drops such a pair has a chance of about 1e-8: agreement of 200 lanes is binomial with 0.85.

Null and empty texts, and texts without words, have empty sets and link with nothing. A text with
fewer words than a shingle has one shingle, its whole sequence. A very long text is read whole; its set
alone may fill a block. Pairs exactly at the threshold are linked. Rows that share an id are one
document. Rows with a null id take no part: their component is null and they are kept. Extra columns
are not looked at, and pass through :func:`drop_near_duplicates` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.llm.common import components, cut, groups, id_bitmap, map_arrow, mix, pieces, rekeyed, sequence_key, split_by_bitmap, windows, word_bytes, word_hashes


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    bits: int = 2
    #: Estimates this far below the threshold are dropped: over six standard deviations of the estimate.
    slack: float = 0.21
    #: Sets of at most so many shingles are confirmed without an estimate: their lanes hang together the most.
    small: int = 16
    #: Documents in a block, and shingles if its texts are long.
    block: int = 1000
    block_shingles: int = 4_000_000
    hubs: int = 8

    def multipliers(self) -> np.ndarray:
        rng = np.random.default_rng(20240601)
        return rng.integers(1, 1 << 32, self.bands * self.rows, dtype=np.uint64).astype(np.uint32) | np.uint32(1)

    def offsets(self) -> np.ndarray:
        """What the minima are mixed with before their low bits are kept: another constant in each lane."""
        return np.random.default_rng(20240602).integers(0, 1 << 32, self.bands * self.rows, dtype=np.uint64).astype(np.uint32)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text in A-Z lower case."""
    h = word_hashes(word_bytes(text, lower=True))
    if not len(h):
        return h
    return np.unique(windows(h, min(n, len(h))))


def minima(s: np.ndarray, a: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(out, (x[at : at + 256, None] * a).min(axis=0), out=out)
    return out


def low_bits(m: np.ndarray, bits: int, offsets: np.ndarray) -> np.ndarray:
    """The low bits of the mixed minima. A product's own low bits depend on the low bits of its factors alone, so that
    chance agreement would be alike in all lanes."""
    x = m + offsets
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (x ^ (x >> np.uint32(16))) & np.uint32((1 << bits) - 1)


def pack(m: np.ndarray, bits: int, offsets: np.ndarray) -> bytes:
    lanes = (low_bits(m, bits, offsets)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(lanes.astype(np.uint8).ravel()).tobytes()


def band_keys(m: np.ndarray, s: Settings) -> np.ndarray:
    rows = m.reshape(s.bands, s.rows).astype(np.uint64)
    key = np.arange(1, s.bands + 1, dtype=np.uint64)
    for j in range(s.rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key.view(np.int64)


def similarity(one: np.ndarray, many: np.ndarray, s: Settings) -> np.ndarray:
    """Estimated Jaccard similarity of a signature and several: (agreeing lanes - chance) / (1 - chance)."""
    n, chance = s.bands * s.rows, 0.5**s.bits
    differ = many ^ one
    lanes = differ
    for k in range(1, s.bits):
        lanes = lanes | (differ << np.uint64(k))
    top = np.frombuffer(np.packbits(np.tile([1] + [0] * (s.bits - 1), -(-many.shape[1] * 64 // s.bits))[: many.shape[1] * 64]).tobytes(), dtype=">u8").astype(np.uint64)
    agree = n - np.bitwise_count(lanes & top).sum(axis=1)
    return (agree / n - chance) / (1 - chance)


def unpack(signatures: list[bytes], s: Settings) -> np.ndarray:
    """Signatures as rows of big-endian 64-bit words, padded with zeros."""
    if s.bits not in (1, 2, 4, 8):
        raise ValueError("bits must be 1, 2, 4 or 8")
    size = -(-s.bands * s.rows * s.bits // 64) * 8
    return np.frombuffer(b"".join(x.ljust(size, b"\0") for x in signatures), dtype=">u8").reshape(len(signatures), -1).astype(np.uint64)


def signatures(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """id, n, key1, key2 (of the set), signature, bands."""
    a, offsets = s.multipliers(), s.offsets()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            n, k1, k2, sig, bands = [], [], [], [], []
            for text in b.column(1).to_pylist():
                x = shingles(text, s.words)
                n.append(len(x))
                k1.append(sequence_key(x, 1))
                k2.append(sequence_key(x, 2))
                m = minima(x, a)
                sig.append(pack(m, s.bits, offsets) if len(x) else b"")
                bands.append(band_keys(m, s) if len(x) else np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "n", "key1", "key2", "signature", "bands"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, "id long, n long, key1 long, key2 long, signature binary, bands array<long>")


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _confirmed(mine: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which full sets reach the threshold, by exact intersections."""
    if len(others) == 1:
        inter = np.array([len(np.intersect1d(mine, others[0], assume_unique=True))])
    else:
        sizes = np.array([len(o) for o in others])
        flat = np.concatenate(others)
        at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
        inter = np.add.reduceat((mine[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    union = len(mine) + np.array([len(o) for o in others]) - inter
    return 100 * inter >= percent * union


def _links(s: Settings, ids: list[int], sigs: np.ndarray, sets: list[np.ndarray], forest: _Forest, lefts: range, right_from: int) -> list[tuple[int, int]]:
    """Compare each of ``lefts`` with the rows from max(itself + 1, right_from) on; joins the forest, gives its new links."""
    out = []
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    for i in lefts:
        begin = max(i + 1, right_from)
        if begin >= len(ids):
            break
        maybe = similarity(sigs[i], sigs[begin:], s) >= s.percent / 100 - s.slack
        if sizes[i] <= s.small:
            maybe |= sizes[begin:] <= s.small
        # Sets whose sizes are too far apart can't reach the threshold.
        low, high = np.minimum(sizes[i], sizes[begin:]), np.maximum(sizes[i], sizes[begin:])
        likely = begin + np.flatnonzero(maybe & (low > 0) & (100 * low >= s.percent * high))
        likely = [int(j) for j in likely if forest.find(int(j)) != forest.find(i)]
        for at in range(0, len(likely), 64):
            part = [j for j in likely[at : at + 64] if forest.find(j) != forest.find(i)]
            if part:
                for j, ok in zip(part, _confirmed(sets[i], [sets[j] for j in part], s.percent), strict=True):
                    if ok and forest.join(i, j):
                        out.append((ids[i], ids[j]))
    return out


def _rows(t: pa.Table, s: Settings) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    return t["id"].to_pylist(), unpack(t["signature"].to_pylist(), s), [shingles(x, s.words) for x in t["text"].to_pylist()]


def _edges(pairs: list[tuple[int, int]], kind: list[int], where: tuple) -> pa.RecordBatch:
    n = len(pairs)
    return pa.RecordBatch.from_arrays([pa.array([where[0]] * n, pa.int64()), pa.array([where[1]] * n, pa.int32()), pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64()), pa.array(kind, pa.int32())], names=["cluster", "block", "a", "b", "kind"])


_EDGES = "cluster long, block int, a long, b long, kind int"
#: Kinds of rows that blocks emit: a link; a document (a) that is tied to a hub (b); one that is tied to none.
_LINK, _TIED, _LOOSE = 0, 1, 2


def _inside(rows: DataFrame, s: Settings) -> DataFrame:
    """Links in each (cluster, block), and of clusters with several blocks which hub of the lowest rank a document is tied to.

    rows: cluster, block, blocks, hub (its rank, or 0), guest (whether it is there as a hub only), id, signature, text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for where, t in groups(batches, 3):
            ids, sigs, sets = _rows(t, s)
            forest = _Forest(len(ids))
            links = _links(s, ids, sigs, sets, forest, range(len(ids)), 0)
            found = [_LINK] * len(links)
            if where[2] > 1:
                hub, guest = t["hub"].to_pylist(), t["guest"].to_pylist()
                ties: dict[int, int] = {}
                for i in sorted((i for i, h in enumerate(hub) if h), key=lambda i: hub[i]):
                    ties.setdefault(forest.find(i), ids[i])
                own = [(ids[i], ties.get(forest.find(i))) for i, g in enumerate(guest) if not g]
                links += [(i, i if h is None else h) for i, h in own]
                found += [_LOOSE if h is None else _TIED for _, h in own]
            yield _edges(links, found, where)

    return map_arrow(rows.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "id").select("cluster", "block", "blocks", "hub", "guest", "id", "signature", "text"), run, _EDGES)


def _visits(rows: DataFrame, guests: DataFrame, s: Settings) -> DataFrame:
    """Links between guests and the block they visit. rows: of blocks; guests: cluster, block, chunk, id, signature, text.

    Guests come in chunks, each of which meets its own copy of the block's rows.
    """
    chunks = guests.select("cluster", "block", "chunk").distinct()
    hosts = rows.join(chunks, ["cluster", "block"]).select("cluster", "block", "chunk", F.lit(1).alias("host"), "id", "signature", "text")
    both = guests.select("cluster", "block", "chunk", F.lit(0).alias("host"), "id", "signature", "text").unionByName(hosts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for where, t in groups(batches, 3):
            ids, sigs, sets = _rows(t, s)
            n = t["host"].to_pylist().count(0)
            links = _links(s, ids, sigs, sets, _Forest(len(ids)), range(n), n)
            yield _edges(links, [_LINK] * len(links), where)

    return map_arrow(both.repartition("cluster", "block", "chunk").sortWithinPartitions("cluster", "block", "chunk", "host", "id"), run, _EDGES)


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id (smallest id reachable over links), kept (whether the row is its component's one)."""
    s = settings
    base = cut(signatures(docs, s, id_col, text_col))
    full = base.where("n > 0 and id is not null")
    classes = full.groupBy("key1", "key2").agg(F.min("id").alias("rep")).select(rekeyed("key1").alias("k1"), rekeyed("key2").alias("k2"), "rep")
    placed = full.join(classes, (rekeyed("key1") == F.col("k1")) & (rekeyed("key2") == F.col("k2")))
    member = placed.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    reps = cut(placed.where("id = rep").select("id", "n", "signature", "bands"))
    links = _representative_links(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), reps, s)
    found = components(links.unionByName(member))
    out = base.select("id", "n").join(found, "id", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))


def _representative_links(texts: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    banded = reps.select("id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select(rekeyed("band").alias("key"), "first")
    star = banded.join(buckets, rekeyed("band") == F.col("key")).where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    clusters = cut(components(star).withColumnRenamed("component", "cluster").join(reps.select("id", "n").distinct(), "id"))
    needed = F.ceil(F.greatest(F.count(F.lit(1)) / s.block, F.sum("n") / s.block_shingles)).cast("int")
    sizes = clusters.groupBy("cluster").agg(needed.alias("blocks")).select(rekeyed("cluster").alias("key"), "blocks")
    placed = cut(clusters.join(sizes, rekeyed("cluster") == F.col("key")).select("id", "cluster", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")))

    def with_texts(rows: DataFrame) -> DataFrame:
        # Texts travel, as hashes of their shingles wouldn't compress; blocks make the sets anew.
        maybe, _ = split_by_bitmap(texts, "id", id_bitmap(rows, "id"))
        return rows.join(reps.select("id", "signature"), "id").join(maybe.select("id", "text"), "id")

    large = placed.where("blocks > 1")
    some = large.limit(1).count() > 0
    plain = placed.withColumns({"hub": F.lit(0), "guest": F.lit(False)})
    if some:
        # The first documents of the buckets with the most others; buckets lie within clusters, so those of large ones tell.
        # Spark limits the ranks before it shuffles them.
        banded_large = cut(large.join(reps.select("id", "bands"), "id").select("id", "block", "bands"))
        apart = banded_large.select("id", "block", F.explode("bands").alias("band"))
        others = apart.groupBy("band").agg(F.min("id").alias("id"), (F.count(F.lit(1)) - 1).alias("n")).where("n > 0")
        known = others.groupBy("id").agg(F.sum("n").alias("count")).join(large, "id")
        order = Window.partitionBy("cluster").orderBy(F.desc("count"), "id")
        hubs = cut(known.withColumn("hub", F.row_number().over(order)).where(F.col("hub") <= s.hubs).select("id", "hub"))
        there = large.join(hubs, "id").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        guests = there.select("id", "cluster", "blocks", F.col("to").alias("block"), "hub", (F.col("to") != F.col("block")).alias("guest"))
        small = placed.where("blocks = 1").withColumns({"hub": F.lit(0), "guest": F.lit(False)})
        plain = small.unionByName(large.join(hubs, "id", "left_anti").withColumns({"hub": F.lit(0), "guest": F.lit(False)})).unionByName(guests)
    first = cut(_inside(with_texts(plain), s))
    links = first.where(f"kind = {_LINK}").select("a", "b")
    if not some:
        return links
    tied = first.where(f"kind = {_TIED}").select("cluster", F.col("a").alias("id"), F.col("b").alias("hub"))
    main = tied.groupBy("cluster", "hub").count().groupBy("cluster").agg(F.max_by("hub", F.struct("count", "hub")).alias("main"))
    away = tied.join(main.select(F.col("main").alias("hub")), "hub", "left_anti").select("id").union(first.where(f"kind = {_LOOSE}").select("a"))
    # Who travels goes where a band key of its own is, found from lists of blocks that are as long as a cluster has blocks.
    outside = cut(large.join(away.distinct(), "id"))
    holds = apart.groupBy("band").agg(F.collect_set("block").alias("to")).where("size(to) > 1").select(rekeyed("band").alias("key"), "to")
    own = banded_large.join(outside.select("id"), "id", "left_semi").select("id", F.explode("bands").alias("band"))
    visits = own.join(holds, rekeyed("band") == F.col("key")).groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("to"))).alias("to"))
    travel = cut(outside.join(visits, "id").select("cluster", "id", "block", F.explode("to").alias("to")).where("to <> block").select("cluster", "id", "to"))
    spread = travel.groupBy("cluster", "to").count().select(rekeyed("cluster").alias("key"), F.col("to").alias("key_to"), F.ceil(F.col("count") / s.block).cast("int").alias("chunks"))
    going = travel.join(spread, (rekeyed("cluster") == F.col("key")) & (F.col("to") == F.col("key_to"))).select("id", "to", "chunks")
    # Hosts are those who share a band key with someone who travels.
    near = apart.join(own.select("band").distinct(), "band", "left_semi").select("id").distinct()
    rows = cut(with_texts(large.join(near, "id", "left_semi")).select("cluster", "block", "id", "signature", "text"))
    guests = rows.select("cluster", "id", "signature", "text").join(going, "id").select("cluster", F.col("to").alias("block"), F.pmod(F.xxhash64("id", F.lit(2)), F.col("chunks")).cast("int").alias("chunk"), "id", "signature", "text")
    return links.unionByName(cut(_visits(rows, guests, s)).select("a", "b"))


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component; of rows that share an id one stays, rows with a null id all do.

    Only rows whose id may be among those to go are shuffled with their texts.
    """
    found = cut(near_duplicates(docs, settings, id_col, text_col).select(id_col, "kept"))
    gone = found.where("not kept").select(F.col(id_col).alias("__tb_gone")).distinct()
    repeated = found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__tb_gone")).count().where("count > 1").select("__tb_gone")
    known, unknown = docs.where(F.col(id_col).isNotNull()), docs.where(F.col(id_col).isNull())
    maybe, clean = split_by_bitmap(known, id_col, id_bitmap(gone.union(repeated), "__tb_gone"))
    stay = maybe.join(gone, F.col(id_col) == F.col("__tb_gone"), "left_anti").dropDuplicates([id_col])
    return clean.unionByName(stay).unionByName(unknown)
