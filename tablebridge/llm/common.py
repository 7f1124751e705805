"""Helpers that several operators share: checkpoints, word hashes, id bitmaps, components."""

from __future__ import annotations

import gc
import re
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, LF, VT, FF and CR.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ODD = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[str]:
    """The words of a text; ``None`` has none."""
    if not text:
        return []
    return WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def word_bytes(text: str | None, lower: bool = False) -> list[bytes]:
    """The words as UTF-8; ``lower`` folds A-Z only. ``bytes.split`` cuts at exactly the same six bytes."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.translate(_LOWER) if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes, alike on every machine."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(h: np.ndarray, n: int, odd: int = _ODD) -> np.ndarray:
    """Hashes of all windows of n consecutive words, by doubling: the work grows with log2(n)."""
    if n <= 0 or len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out, have, block, size, need = None, 0, h, 1, n
        while need:
            if need & 1:
                if out is None:
                    out, have = block, size
                else:
                    k = len(h) - have - size + 1
                    out = out[:k] * np.uint64(pow(odd, size, 1 << 64)) + block[have : have + k]
                    have += size
            need >>= 1
            if need:
                k = len(h) - 2 * size + 1
                block = block[:k] * np.uint64(pow(odd, size, 1 << 64)) + block[size : size + k]
                size *= 2
        return mix(out)


def sequence_key(h: np.ndarray, seed: int = 0) -> int:
    """A signed 64-bit hash of a whole array of hashes."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(np.ascontiguousarray(h).tobytes(), seed))))


def _shared_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in spark.checkpoint.dir; set one only where none is set and the driver is the cluster, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = _shared_dir(spark)
    if shared is None:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: lost executors don't lose it, and Spark's cleaner removes it when it's no longer used."""
    ensure_checkpoint_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    # A checkpoint takes over its plan's estimated size, and a join's estimate is the product of its sides': in a loop over
    # checkpoints the digits of that number would multiply each round, and with them the driver's time and memory. The
    # same files as a plan without an estimate:
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(done._jdf.queryExecution().toRdd(), done._jdf.schema(), False), spark)


def let(value: F.Column, f: Callable) -> F.Column:
    """f(value) with value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with a number if the DataFrame has a column of that name (in any case) already."""
    taken, k, out = {c.lower() for c in df.columns}, 2, name
    while out.lower() in taken:
        out, k = f"{name}_{k}", k + 1
    return out


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices, so that Python objects exist for a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_frozen = False


def freeze_imports() -> None:
    """Once in a Python worker: what it holds by now (modules, a vocabulary) stays, and collections pass it by. Spark's
    workers collect garbage after each task, which took about 40 ms for the modules alone."""
    global _frozen
    if not _frozen:
        gc.collect()
        gc.freeze()
        _frozen = True


def map_arrow(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freeze_imports()
        yield from f(batches)

    return df.mapInArrow(run, schema)


#: Positions in an id bitmap: 2**23 bits are 1 MB, whatever the number of ids.
BITMAP_BITS = 1 << 23
_BLOCK = 1 << 15


def id_bitmap(ids: DataFrame, column: str, bits: int = BITMAP_BITS) -> DataFrame:
    """At most bits / 2**15 rows (block int, bitmap binary of 4 KB): which hashed ids occur. It may err on the side of yes only."""
    at = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits)).alias("at")
    bucket = F.bitmap_bucket_number("at")
    return ids.select(at).groupBy(bucket.cast("int").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))


def split_by_bitmap(df: DataFrame, column: str, bitmap: DataFrame, bits: int = BITMAP_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may occur, rows whose id surely doesn't). The broadcast side holds bits / 8 bytes at most."""
    at = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))
    right = bitmap.select(F.col("block").alias("__tb_block"), F.col("bitmap").alias("__tb_bitmap"))
    joined = df.join(F.broadcast(right), F.bitmap_bucket_number(at).cast("int") == F.col("__tb_block"), "left")
    position = F.bitmap_bit_position(at).cast("int")
    byte = F.conv(F.hex(F.substring("__tb_bitmap", F.lit(1) + F.shiftright(position, 3), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, position.bitwiseAND(7)) == 1, F.lit(False))
    return joined.where(hit).drop("__tb_block", "__tb_bitmap"), joined.where(~hit).drop("__tb_block", "__tb_bitmap")


def rekeyed(column: str) -> F.Column:
    """The column as another key, one to one. An aggregate by ``column`` that is joined on this key is dealt out anew, so
    that both sides of the join are plain exchanges: Spark splits the hot keys of such joins, without a file between."""
    return F.col(column).bitwiseXOR(F.lit(_ODD >> 1))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): rows (id, component), component the smallest id reachable.

    In a round every vertex hooks onto the least of its neighbours and itself and jumps to its hook's hook, and the edges
    are contracted along. A vertex only moves to one that it is connected with, so edges lose no connection however far
    the jumps got; the rounds end when none is left. The first round orders vertices by id, which settles the stars that
    buckets make; later ones by a hash, so that chains in the order of their ids become short. Edges are joined in full
    once and then shrink. Hot vertices are met by joins that Spark can split and by aggregates that combine before the
    shuffle; nothing is gathered by vertex.

    The result is a plan over the rounds' files, not yet run.
    """
    left = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    labels: DataFrame | None = None
    for turn in range(max_rounds):
        both = left.select(F.col("a").alias("v"), F.col("b").alias("n")).union(left.select("b", "a"))
        if turn == 0:
            hooks = both.groupBy("v").agg(F.min("n").alias("p")).select("v", F.least("v", "p").alias("p"))
        else:
            ranked = lambda c: F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("p"))
            hooks = both.groupBy("v").agg(F.min(ranked("n")).alias("m")).select("v", F.least("m", ranked("v"))["p"].alias("p"))
        up = hooks.select(rekeyed("v").alias("u"), F.col("p").alias("q"))
        moved = cut(hooks.join(up, rekeyed("p") == F.col("u")).select("v", F.col("q").alias("p")))
        if labels is None:
            labels = moved.select(F.col("v").alias("id"), F.col("p").alias("component"))
        else:
            labels = labels.join(moved, F.col("component") == F.col("v"), "left").select("id", F.coalesce("p", "component").alias("component"))
        one = left.join(moved, left.a == moved.v).select(F.col("p").alias("x"), "b")
        two = one.join(moved, one.b == moved.v).select("x", F.col("p").alias("y")).where("x <> y")
        left = cut(two.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if left.limit(1).count() == 0:
            # In the order of ids the smallest one never moves; else it gives the component its name.
            return labels if turn == 0 else _named(labels)
    raise RuntimeError("components did not settle")


def _named(labels: DataFrame) -> DataFrame:
    labels = cut(labels)
    least = labels.groupBy("component").agg(F.min("id").alias("least")).select(rekeyed("component").alias("key"), "least")
    return labels.join(least, rekeyed("component") == F.col("key")).select("id", F.col("least").alias("component"))


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows equal in the first ``keys`` columns, of rows that come sorted by them; holds one run at a time."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        tuples = list(zip(*columns, strict=True))
        start = 0
        for i in range(1, len(tuples) + 1):
            if i < len(tuples) and tuples[i] == tuples[start]:
                continue
            if held and tuples[start] != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = tuples[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield at, pa.Table.from_batches(held)
