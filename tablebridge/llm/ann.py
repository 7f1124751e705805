"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

* Equal vectors are one vertex; its rows with the smallest ids stand for it, as many as a result can hold.
* The graph starts from blocks of vectors on the same side of random hyperplanes: each of ``trees``
  orderings is cut into blocks of ``leaf`` rows, whatever their codes, and searched within. One more
  ordering is random: its far links keep blocks from being islands that introductions can't leave.
* NN-descent: every vertex introduces its neighbours, and those it is a neighbour of, to each other.
  An iteration is a join of the introductions with the vectors and a merge of what improves; they end
  when less than ``delta`` of all list entries changed. The hyperplanes grow with the number of vectors.
* A search keeps the ``beam`` nearest vertices of each query and expands the nearest unexpanded ones,
  a join with the graph and one with the vectors for each round, until none is left to expand.

Graph and search use vectors of one byte a component with a scale for each vector, relative to the
largest component of all, so that no magnitude is too small or large; the distances of results are
exact, in double precision, on the original vectors.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null
id or vectors whose length isn't the most common one. If there are fewer candidates than ``k``, all are
found. Ties go to the smaller id. Rows that repeat an id with the same vector are one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.llm.common import cut, map_arrow, mix


@dataclass(frozen=True)
class Settings:
    degree: int = 32
    trees: int = 10
    leaf: int = 512
    #: Hyperplanes of an ordering beyond those that would leave ``leaf`` vectors on each side of all.
    spare_bits: int = 4
    #: Introductions for each vertex, of each kind: new and old, its neighbours and those it is a neighbour of.
    sample: int = 16
    #: Iterations end when less than this share of list entries is new; ``iterations`` is a fuse far beyond that.
    delta: float = 0.005
    iterations: int = 30
    beam: int = 200
    expand: int = 100
    seed: int = 17

    def bits(self, n: int) -> int:
        return min(60, max(1, -(-n // self.leaf)).bit_length() + self.spare_bits)


# ---- vectors


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id long, v array<double>: the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (size[0]["n"] if size else 0))


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype).reshape(len(column), -1)


def _packed(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = np.abs(m).max(axis=1)
    return np.rint(m / scale[:, None] * 127).astype(np.int8), (scale / 127).astype(np.float32)


def _floats(b: pa.RecordBatch | pa.Table, code: str = "code", scale: str = "scale") -> np.ndarray:
    codes = b.column(b.schema.get_field_index(code)).to_pylist()
    scales = np.array(b.column(b.schema.get_field_index(scale)).to_pylist(), dtype=np.float32)
    return np.frombuffer(b"".join(codes), dtype=np.int8).reshape(len(codes), -1).astype(np.float32) * scales[:, None]


def _coded(rows: DataFrame) -> DataFrame:
    """id, code binary, scale float (relative to the largest component of all rows)."""
    top = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                q, scale = _packed(_matrix(b.column(1), np.float64) / top)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in q], pa.binary()), pa.array(scale, pa.float32())], names=["id", "code", "scale"])

    return map_arrow(rows.select("id", "v"), run, "id long, code binary, scale float")


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T), 0)


# ---- lists of neighbours


def _lists(ids: np.ndarray, near: np.ndarray, far: np.ndarray, old: np.ndarray, k: int) -> pa.RecordBatch:
    """A row for each id: its k nearest distinct neighbours. An entry that is old in one place is old."""
    order = np.lexsort((~old, near, ids))
    ids, near, far, old = ids[order], near[order], far[order], old[order]
    first = np.ones(len(ids), dtype=bool)
    first[1:] = (ids[1:] != ids[:-1]) | (near[1:] != near[:-1])
    ids, near, far, old = ids[first], near[first], far[first], old[first]
    order = np.lexsort((near, far, ids))
    ids, near, far, old = ids[order], near[order], far[order], old[order]
    rank = np.arange(len(ids)) - np.searchsorted(ids, ids)
    keep = rank < k
    ids, near, far, old = ids[keep], near[keep], far[keep], old[keep]
    unique, starts = np.unique(ids, return_index=True)
    offsets = pa.array(np.append(starts, len(ids)).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(unique), pa.ListArray.from_arrays(offsets, pa.array(near)), pa.ListArray.from_arrays(offsets, pa.array(far.astype(np.float32))), pa.ListArray.from_arrays(offsets, pa.array(old))], names=["id", "near", "far", "old"])


_LISTS = "id long, near array<long>, far array<float>, old array<boolean>"


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.diff(b.column(1).offsets.to_numpy())
    return np.repeat(b.column(0).to_numpy(), sizes), b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy(zero_copy_only=False).astype(bool)


def _whole(batches: Iterator[pa.RecordBatch], least: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows regrouped so that rows with the same first column come together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) < least:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        keys = whole.column(0).to_numpy()
        at = int(np.searchsorted(keys, keys[-1]))
        if at:
            yield whole.slice(0, at)
        held = [whole.slice(at)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _by(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.repartition(columns[0]).sortWithinPartitions(*columns)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _whole(batches, 4000):
            yield _lists(*_flat(b), k)

    return map_arrow(_by(lists.select("id", "near", "far", "old"), "id"), run, _LISTS)


# ---- the graph


def _planes(coded: DataFrame, s: Settings, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hyperplanes midway between pairs of vectors from a sample of at most 2 * trees * bits."""
    got = coded.orderBy(F.xxhash64(F.lit(s.seed), "id"), "id").limit(2 * s.trees * bits).toArrow()
    x = _floats(got)
    rng = np.random.default_rng(s.seed)
    a, b = x[rng.integers(0, len(x), s.trees * bits)], x[rng.integers(0, len(x), s.trees * bits)]
    return (a - b).T, ((a * a).sum(axis=1) - (b * b).sum(axis=1)) / 2


def _first_lists(coded: DataFrame, s: Settings) -> DataFrame:
    bits = s.bits(coded.count())
    planes, middle = _planes(coded, s, bits)
    weights = 1 << np.arange(bits - 1, -1, -1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                c = b.slice(at, 2000)
                side = ((_floats(c) @ planes) > middle).reshape(c.num_rows, s.trees, bits)
                codes = (side * weights).sum(axis=2).astype(np.int64)
                ids = c.column(0).to_numpy().astype(np.uint64)
                with np.errstate(over="ignore"):
                    codes = np.column_stack([codes, mix(ids + np.uint64(s.seed)).view(np.int64)])
                for t in range(s.trees + 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(c.num_rows, t, dtype=np.int32)), pa.array(codes[:, t]), *c.columns], names=["tree", "place", "id", "code", "scale"])

    placed = map_arrow(coded, place, "tree int, place long, id long, code binary, scale float")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[pa.RecordBatch]:
            held: pa.RecordBatch | None = None
            for b in batches:
                if held is not None:
                    b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
                held = b if b.num_rows else None
                while held is not None and held.num_rows:
                    trees = held.column(0).to_numpy()
                    n = min(s.leaf, int(np.searchsorted(trees, trees[0], "right")))
                    if n < s.leaf and n == held.num_rows:
                        break  # the block may go on in the next batch
                    yield held.slice(0, n)
                    held = held.slice(n)
            if held is not None and held.num_rows:
                yield held

        for b in blocks():
            if b.num_rows < 2:
                continue
            ids, x = b.column(2).to_numpy(), _floats(b)
            d = _squared(x, x)
            np.fill_diagonal(d, np.inf)
            k = min(-(-s.degree // 2), len(ids) - 1)
            best = np.argpartition(d, k - 1, axis=1)[:, :k]
            yield _lists(np.repeat(ids, k), ids[best].ravel(), np.take_along_axis(d, best, axis=1).ravel(), np.zeros(best.size, dtype=bool), k)

    return _merged(map_arrow(placed.repartitionByRange("tree", "place", "id").sortWithinPartitions("tree", "place", "id"), within, _LISTS), s.degree)


def _limited(at: np.ndarray, who: np.ndarray, kind: np.ndarray, s: Settings, turn: int) -> np.ndarray:
    """Positions of at most ``sample`` rows of each kind for each vertex, by a hash; sorted by vertex."""
    with np.errstate(over="ignore"):
        luck = (at * np.int64(-7046029254386353131) + who * np.int64(-4417276706812531889) + np.int64(turn)) * np.int64(-7723592293110705685)
    order = np.lexsort((luck, kind, at))
    at, kind = at[order], kind[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (kind[1:] != kind[:-1])
    rank = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    return order[rank < s.sample]


def _introductions(graph: DataFrame, s: Settings, turn: int) -> DataFrame:
    """(at, who, kind): who is to be introduced at a vertex; of a vertex's own choice at most ``sample`` of each kind.

    Of those that chose a vertex, each batch sends at most ``sample``, so that a hub gets few; :func:`_met` chooses among them.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at, who, _, old = _flat(b)
                kind = old.astype(np.int8)
                own = _limited(at, who, kind, s, turn)
                at, who, kind = at[own], who[own], kind[own]
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(who), pa.array(kind)], names=["at", "who", "kind"])
                # Those named here learn who named them.
                back = _limited(who, at, kind, s, turn)
                yield pa.RecordBatch.from_arrays([pa.array(who[back]), pa.array(at[back]), pa.array(kind[back] + np.int8(2))], names=["at", "who", "kind"])

    return map_arrow(graph, send, "at long, who long, kind tinyint")


def _met(graph: DataFrame, s: Settings, turn: int) -> DataFrame:
    """Lists of what introductions found, where nearer than a vertex's farthest neighbour."""
    reach = F.when(F.size("far") >= s.degree, F.element_at("far", -1)).otherwise(F.lit(float("inf")).cast("float")).alias("reach")
    guests = _introductions(graph.select("id", "near", "far", "old"), s, turn).join(graph.select(F.col("id").alias("who"), reach, "code", "scale"), "who")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _whole(batches, 8000):
            b = b.take(pa.array(_limited(*(b.column(i).to_numpy() for i in range(3)), s, turn)))
            at, who, kind, reach = (b.column(i).to_numpy() for i in range(4))
            x = _floats(b)
            starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            ids, near, far = [], [], []
            for i, j in zip(starts, np.append(starts[1:], len(at)), strict=True):
                w, first = np.unique(who[i:j], return_index=True)
                fresh = np.zeros(len(w), dtype=bool)
                fresh[np.searchsorted(w, who[i:j][kind[i:j] % 2 == 0])] = True
                if len(w) < 2 or not fresh.any():
                    continue
                y, r = x[i:j][first], reach[i:j][first]
                d = _squared(y[fresh], y)
                wf = w[fresh]
                differ = wf[:, None] != w[None, :]
                a, c = np.nonzero((d < r[fresh][:, None]) & differ)
                ids.append(wf[a]), near.append(w[c]), far.append(d[a, c])
                a, c = np.nonzero((d < r[None, :]) & differ)
                ids.append(w[c]), near.append(wf[a]), far.append(d[a, c])
            if ids:
                ids, near, far = map(np.concatenate, (ids, near, far))
                if len(ids):
                    yield _lists(ids, near, far, np.zeros(len(ids), dtype=bool), s.degree)

    return map_arrow(_by(guests.select("at", "who", "kind", "reach", "code", "scale"), "at"), meet, _LISTS)


def _improved(graph: DataFrame, found: DataFrame, s: Settings, fresh, entries) -> DataFrame:
    """The graph's rows with what was found merged into their lists; adds up the new entries and all entries."""
    none = {"code": F.lit(None).cast("binary"), "scale": F.lit(None).cast("float")}
    kept = graph.withColumn("old", F.transform("old", lambda x: F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _whole(batches, 4000):
            lists = _lists(*_flat(b), s.degree)
            own = b.filter(b.column(4).is_valid())
            at = np.searchsorted(own.column(0).to_numpy(), lists.column(0).to_numpy())
            old = lists.column(3).flatten()
            entries.add(len(old))
            fresh.add(len(old) - (old.true_count or 0))
            yield pa.RecordBatch.from_arrays([*lists.columns, own.column(4).take(pa.array(at)), own.column(5).take(pa.array(at))], names=[*lists.schema.names, "code", "scale"])

    return map_arrow(_by(kept.unionByName(found.withColumns(none)).select(*_GRAPH), "id"), run, ", ".join(f"{k} {v}" for k, v in _GRAPH.items()))


#: A vertex with its list and its vector, so that vectors travel with introductions and not by a join of their own.
_GRAPH = {"id": "long", "near": "array<long>", "far": "array<float>", "old": "array<boolean>", "code": "binary", "scale": "float"}


def build_graph(coded: DataFrame, s: Settings) -> DataFrame:
    """id, near, far (squared distances), old, code, scale: the ``degree`` nearest vertices found, nearest first."""
    graph = cut(_first_lists(coded, s).join(coded, "id").select(*_GRAPH))
    context = coded.sparkSession.sparkContext
    for turn in range(s.iterations):
        # Tasks that run twice count twice, which can only make an iteration look unsettled.
        fresh, entries = context.accumulator(0), context.accumulator(0)
        graph = cut(_improved(graph, _met(graph, s, turn), s, fresh, entries))
        if fresh.value <= s.delta * entries.value:
            break
    return graph


# ---- search


_STATE = "query long, code binary, scale float, ids array<long>, far array<float>, done array<boolean>"


def _advance(state: dict, ids: np.ndarray, far: np.ndarray, s: Settings) -> None:
    own, first = np.unique(np.concatenate([state["ids"], ids]), return_index=True)
    far = np.concatenate([state["far"], far])[first]
    done = np.concatenate([state["done"], np.zeros(len(ids), dtype=bool)])[first]
    order = np.lexsort((own, far))[: s.beam]
    state["ids"], state["far"], state["done"] = own[order], far[order], done[order]


def search(queries: DataFrame, graph: DataFrame, coded: DataFrame, s: Settings) -> DataFrame:
    """query, id: the beams at the end. queries: query long, start long (a vertex to start from, or null), code, scale."""
    spark = graph.sparkSession
    entry = coded.orderBy(F.xxhash64(F.lit(s.seed + 1), "id"), "id").limit(64).toArrow()
    if not entry.num_rows:
        return queries.select("query", F.lit(0).cast("long").alias("id")).where("false")
    entry_ids, entry_x = entry["id"].to_numpy(), _floats(entry)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _floats(b) if b.num_rows else None
            for i, (query, near, far) in enumerate(zip(b.column(0).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                state = {"ids": entry_ids, "far": _squared(x[i : i + 1], entry_x)[0].astype(np.float32), "done": np.zeros(len(entry_ids), dtype=bool)}
                if near:
                    _advance(state, np.array(near, dtype=np.int64), np.array(far, dtype=np.float32), s)
                yield _state_row(query, b.column(1)[i].as_py(), b.column(2)[i].as_py(), state)

    started = queries.join(graph.select(F.col("id").alias("start"), "near", "far"), "start", "left")
    state = cut(map_arrow(started.select("query", "code", "scale", "near", "far"), begin, _STATE))
    context = spark.sparkContext

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for query, part in _runs(batches):
            own = next((r for r in part if r["ids"] is not None), None)
            if own is None:
                continue
            x = np.frombuffer(own["code"], dtype=np.int8).astype(np.float32) * own["scale"]
            state = {"ids": np.array(own["ids"], dtype=np.int64), "far": np.array(own["far"], dtype=np.float32), "done": np.array(own["done"], dtype=bool)}
            state["done"][np.flatnonzero(~state["done"])[: s.expand]] = True
            got = [r for r in part if r["ids"] is None]
            if got:
                ids = np.array([r["id"] for r in got], dtype=np.int64)
                y = np.frombuffer(b"".join(r["code"] for r in got), dtype=np.int8).reshape(len(got), -1).astype(np.float32) * np.array([r["scale"] for r in got], dtype=np.float32)[:, None]
                _advance(state, ids, _squared(x[None, :], y)[0], s)
            open_.add(int(not state["done"].all()))
            yield _state_row(query, own["code"], own["scale"], state)

    kinds = {"ids": "array<long>", "far": "array<float>", "done": "array<boolean>"}
    none = {c: F.lit(None).cast(kind) for c, kind in kinds.items()}
    while True:  # a vertex is expanded once at most: what leaves a beam is farther than all that is in it from then on
        # Tasks that run twice count twice, which can only make a round look unfinished.
        open_ = context.accumulator(0)
        # The nearest vertices not yet expanded, at most ``expand`` of each query.
        turn = F.slice(F.filter(F.transform("ids", lambda x, i: F.when(~F.get("done", i), x)), lambda x: x.isNotNull()), 1, s.expand)
        asked = state.select("query", F.explode(turn).alias("id")).join(graph.select("id", "near"), "id").select("query", "near", none["ids"].alias("ids"))
        # Neighbours of the vertices in turn that aren't in the beam, each once.
        lists = asked.unionByName(state.where(F.exists("done", lambda x: ~x)).select("query", F.lit(None).cast("array<long>").alias("near"), "ids"))
        lists = lists.groupBy("query").agg(F.flatten(F.collect_list("near")).alias("near"), F.first("ids", ignorenulls=True).alias("ids"))
        fresh = lists.select("query", F.explode(F.array_except("near", "ids")).alias("id"))
        reached = fresh.join(coded, "id").select("query", "id", "code", "scale", *(v.alias(c) for c, v in none.items()))
        states = state.select("query", F.lit(None).cast("long").alias("id"), "code", "scale", "ids", "far", "done")
        state = cut(map_arrow(_by(reached.unionByName(states), "query"), take, _STATE))
        if not open_.value:
            return state.select("query", F.explode("ids").alias("id"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    for b in _whole(batches, 2000):
        rows = b.to_pylist()
        at = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i]["query"] != rows[at]["query"]:
                yield rows[at]["query"], rows[at:i]
                at = i


def _state_row(query: int, code: bytes, scale: float, state: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([query], pa.int64()), pa.array([code], pa.binary()), pa.array([scale], pa.float32()), pa.array([state["ids"].tolist()], pa.list_(pa.int64())), pa.array([state["far"].tolist()], pa.list_(pa.float32())), pa.array([state["done"].tolist()], pa.list_(pa.bool_()))],
        names=["query", "code", "scale", "ids", "far", "done"],
    )


def nearest(vectors: DataFrame, is_query: str, k: int = 10, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id_col, score (Euclidean distance): the k nearest other rows of each row for which the SQL
    condition ``is_query`` (on ``id``) holds."""
    s = settings
    rows = cut(clean(vectors, id_col, vector_col).dropDuplicates(["id", "v"]))
    # Written out: used four times, and joins on a vector that many rows have get plain exchanges, which Spark splits.
    vertices = cut(rows.groupBy("v").agg(F.min("id").alias("id")))
    coded = cut(_coded(vertices))
    if coded.limit(1).count() == 0:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_col), F.lit(0.0).alias("score")).where("false")
    graph = build_graph(coded, s)
    asked = rows.where(is_query).join(vertices.withColumnRenamed("id", "start"), "v")
    # Queries of one vertex search once.
    starts = asked.select("start").distinct()
    found = search(starts.join(coded.withColumnRenamed("id", "start"), "start").select(F.col("start").alias("query"), "start", "code", "scale"), graph, coded, s)
    # A vertex's rows with the smallest ids: k and one more, as a query isn't its own neighbour. Spark limits groups before it shuffles them.
    members = rows.join(vertices.withColumnRenamed("id", "vertex"), "v").select("vertex", "id")
    members = members.withColumn("n", F.row_number().over(Window.partitionBy("vertex").orderBy("id"))).where(F.col("n") <= k + 1).select("vertex", "id")
    reached = found.union(starts.select("start", "start")).distinct().toDF("query", "vertex")
    pairs = asked.select("id", "start", F.col("v").alias("qv")).withColumnRenamed("id", "query_id").join(reached, F.col("start") == F.col("query"))
    origin = vertices.select(F.col("id").alias("vertex"), F.col("v").alias("cv"))
    score = F.sqrt(F.aggregate(F.zip_with("qv", "cv", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    scored = pairs.join(origin, "vertex").select("query_id", "vertex", score.alias("score"))
    # The k + 1 nearest vertices hold the k nearest rows, as each has a row other than the query's or is its own vertex.
    near = Window.partitionBy("query_id").orderBy("score", "vertex")
    best = scored.withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1)
    ranked = best.join(members, "vertex").where("id <> query_id").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
