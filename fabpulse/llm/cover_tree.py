"""Exact search for the largest inner products, by dual cover trees.

Vectors are dealt to blocks of bounded size by their nearest pivot, and by a hash where a pivot has
too many; queries are dealt to groups. Before that, queries meet a bounded sample of all vectors: the kth
best score there is a floor for the search, and a query goes only to the blocks of pivots whose
vectors can reach its floor. For each block and group, a task builds a cover tree over the block's
vectors and one over the group's queries and walks both together. A pair of nodes is passed over if no
inner product between their vectors can reach the worst kth score of the node's queries. The tasks'
best k are merged by a ranking window, which keeps k rows per query and task.

A node of a tree keeps a centre, which is one of its vectors, and a covering radius. Its children's
centres lie more than half that radius apart, its own centre among them, and their radii are at
most half of it. A node stays a leaf if it is small or would need more than `FANOUT` children: then
its vectors are about as far from each other as from the centre, and balls half as wide hold single vectors.

Scores are exact: they are computed in doubles where all sums fit their 53 bits, else in longs. Of
equal scores the smaller id comes first, a null one last, so nothing is passed over at equality. Of equal
vectors in a block only the k + 1 smallest ids can be an answer, the rest are not walked.

Defined results: vectors that are null, or hold a null or non-finite component, take no part. Every other
row does, and is a candidate for all queries but itself, also if its id or its vector is
repeated; each of repeated query rows has its own answers. Rows without an id are candidates only.
Vectors of different lengths are compared over the components both have. Scores must fit a long. Extra columns
of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fabpulse.llm.scratch import stored

BLOCK, GROUP = 8_192, 8_192  # vectors of a block, queries of a group
PIVOTS, SAMPLE = 64, 1_024  # at most
FANOUT, LEAF, QUERY_LEAF = 64, 128, 8
EXACT = float(1 << 53)


class Node:
    """A centre, the covering radius, and rows low to high of the tree's order."""

    __slots__ = ("centre", "length", "radius", "low", "high", "children", "centres", "lengths", "radii")

    def __init__(self, centre: np.ndarray, radius: float, low: int, high: int):
        self.centre, self.radius, self.low, self.high = centre, radius, low, high
        self.length = float(np.sqrt(centre @ centre))
        self.children: list[Node] = []

    def adopt(self, children: list[Node]) -> None:
        self.children = children
        self.centres = np.array([c.centre for c in children])
        self.lengths = np.array([c.length for c in children])
        self.radii = np.array([c.radius for c in children])


class CoverTree:
    """Rows are put in the order of the tree, so each node is a slice of `order`."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points.astype(np.float64)
        self.leaf = leaf
        self.order = np.arange(len(points))
        self.root = self._node(0, len(points), self.points[0])

    def _node(self, low: int, high: int, centre: np.ndarray) -> Node:
        rows = self.order[low:high]
        own = self.points[rows]
        nearest = _distances(own, centre)
        radius = float(nearest.max())
        node = Node(centre, radius, low, high)
        if len(rows) <= self.leaf or radius == 0:
            return node
        # The farthest row is the next centre, until half the radius covers all.
        owner = np.zeros(len(rows), int)
        centres = [centre]
        while nearest.max() > radius / 2:
            if len(centres) == FANOUT:
                return node
            centres.append(own[int(np.argmax(nearest))])
            away = _distances(own, centres[-1])
            closer = away < nearest
            owner[closer] = len(centres) - 1
            nearest[closer] = away[closer]
        put = np.argsort(owner, kind="stable")
        self.order[low:high] = rows[put]
        edges = np.searchsorted(owner[put], np.arange(len(centres) + 1)).tolist()
        node.adopt([self._node(low + first, low + last, centres[number])
                    for number, (first, last) in enumerate(zip(edges, edges[1:]))])
        return node


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _reach(products, length, radius, lengths, radii):
    """What no inner product between vectors of two balls exceeds; rounding is allowed for."""
    value = products + length * radii + lengths * radius + radius * radii
    return value + 1e-9 * (length + radius) * (lengths + radii) + 1e-6


def _reaches(node: Node, parent: Node) -> np.ndarray:
    """Of a node and each child of another."""
    return _reach(parent.centres @ node.centre, node.length, node.radius, parent.lengths, parent.radii)


def _kind(a: np.ndarray, b: np.ndarray) -> type:
    """In which type the inner products of integer vectors are exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    return np.float64 if largest * max(a.shape[1], b.shape[1]) < EXACT else np.int64


def _lowest(kind: type) -> float | int:
    return -np.inf if kind is np.float64 else -np.iinfo(np.int64).max


def floors(rows: np.ndarray, queries: np.ndarray, sample_rows: np.ndarray, sample: np.ndarray,
           k: int) -> np.ndarray | None:
    """The kth best score of each query among the sample, which no answer is below."""
    if len(sample_rows) <= k:
        return None
    width = max(queries.shape[1], sample.shape[1])
    queries, sample = _widened(queries, width), _widened(sample, width)
    kind = _kind(queries, sample)
    scores = queries.astype(kind) @ sample.astype(kind).T
    scores[rows[:, None] == sample_rows[None, :]] = _lowest(kind)
    return np.partition(scores, -k, axis=1)[:, -k].astype(np.int64)


class Search:
    """The best k of one block's vectors for one group's queries.

    Queries and vectors come with the marks of their rows, vectors in the order in which equal
    scores rank. Floors are scores that no answer is below.
    """

    def __init__(self, query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray,
                 vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.k = k
        width = max(queries.shape[1], vectors.shape[1])
        queries, vectors = _widened(queries, width), _widened(vectors, width)
        few = _few_equal(vectors, k + 1)
        kind = _kind(queries, vectors)
        self.lowest = _lowest(kind)
        self.asked, held = CoverTree(queries, QUERY_LEAF), CoverTree(vectors[few])
        self.places = few[held.order]
        self.queries = queries[self.asked.order].astype(kind)
        self.vectors = vectors[self.places].astype(kind)
        self.own = _positions(query_rows[self.asked.order], rows[self.places])
        self.scores = np.full((len(queries), k), self.lowest, kind)
        self.found = np.full((len(queries), k), len(rows))
        self.worst = np.full(len(queries), self.lowest, kind) if floor is None else (
            floor[self.asked.order].astype(kind))
        self._walk(self.asked.root, held.root)

    def _walk(self, asked: Node, held: Node) -> None:
        # Pairs of nodes, the most promising last, so that good answers come early.
        waiting = [(np.inf, asked, held)]
        while waiting:
            reach, asked, held = waiting.pop()
            if reach < self.worst[asked.low:asked.high].min():
                continue
            if held.children and (not asked.children or held.radius >= asked.radius):
                reaches = _reaches(asked, held)
                waiting += [(reaches[at], asked, held.children[at]) for at in np.argsort(reaches)]
            elif asked.children:
                reaches = _reaches(held, asked)
                waiting += [(reaches[at], asked.children[at], held) for at in np.argsort(reaches)]
            else:
                self._compare(asked, held)

    def _compare(self, asked: Node, held: Node) -> None:
        scores = self.queries[asked.low:asked.high] @ self.vectors[held.low:held.high].T
        own = self.own[asked.low:asked.high] - held.low
        inside = np.flatnonzero((own >= 0) & (own < held.high - held.low))
        scores[inside, own[inside]] = self.lowest
        hits = (scores >= self.worst[asked.low:asked.high, None]) & (scores > self.lowest)
        for row in np.flatnonzero(hits.any(axis=1)):
            columns, at = np.flatnonzero(hits[row]), asked.low + row
            merged = np.concatenate((self.scores[at], scores[row, columns]))
            places = np.concatenate((self.found[at], self.places[held.low + columns]))
            best = np.lexsort((places, -merged))[:self.k]
            self.scores[at], self.found[at] = merged[best], places[best]
            self.worst[at] = max(self.worst[at], self.scores[at, -1])

    def answers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places of query and vector as given, and the score."""
        row, column = np.nonzero(self.scores > self.lowest)
        return (self.asked.order[row], self.found[row, column],
                self.scores[row, column].astype(np.int64))


def _widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _positions(wanted: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where each wanted mark stands among `rows`, -1 if nowhere."""
    order = np.argsort(rows)
    at = order[np.minimum(np.searchsorted(rows, wanted, sorter=order), len(rows) - 1)]
    return np.where(rows[at] == wanted, at, -1)


def _few_equal(vectors: np.ndarray, most: int) -> np.ndarray:
    """The places of vectors, but for those that `most` equal ones stand before."""
    order = np.lexsort(vectors.T[::-1]) if vectors.shape[1] else np.arange(len(vectors))
    sorted_ = vectors[order]
    first = np.ones(len(order), bool)
    first[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
    place = np.arange(len(order))
    keep = place - np.maximum.accumulate(np.where(first, place, 0)) < most
    return np.sort(order[keep])


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    flat = vectors.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                    scale: int = 1024) -> DataFrame:
    """(vec_id, v) of the rows that take part: floor(scale * x) of each component."""
    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return (
        table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("x"))
        .where("x is not null").where(F.forall("x", usable))
        .select("vec_id", F.transform("x", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    )


def top_k(vectors: DataFrame, queries: Column, k: int = 10, block: int = BLOCK,
          group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row of (vec_id, v) that `queries` selects."""
    # The marks are read from the table, so they stay as they are when a task runs again.
    rows = stored(vectors.select("vec_id", "v", F.coalesce(queries, F.lit(False)).alias("asks"),
                                 F.monotonically_increasing_id().alias("row")), "vectors")
    total, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    drawn = (rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("row", "v").toArrow())
    sample = drawn["row"].to_numpy(), _matrix(drawn["v"])
    pivots = sample[1][:max(1, min(PIVOTS, total // block))].astype(np.float64)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column("v")).astype(np.float64)
                width = max(points.shape[1], pivots.shape[1])
                points, centres = _widened(points, width), _widened(pivots, width)
                pivot = ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(pivot.astype(np.int32)),
                     pa.array(_distances(points, centres[pivot]))],
                    [*batch.schema.names, "pivot", "gap"])

    near = rows.mapInArrow(
        nearest, "vec_id long, v array<bigint>, asks boolean, row long, pivot int, gap double")
    # At most PIVOTS rows.
    balls = {r["pivot"]: r for r in near.groupBy("pivot").agg(
        F.count("*").alias("n"), F.max("gap").alias("radius")).collect()}
    parts = [-(-balls[p]["n"] // block) if p in balls else 0 for p in range(max(1, len(pivots)))]
    radii = np.array([balls[p]["radius"] if p in balls else 0.0 for p in range(len(pivots))])
    filled = np.array([p in balls for p in range(len(pivots))], bool)
    groups = max(1, -(-asking // group))
    before = [sum(parts[:p]) for p in range(len(parts))]

    def admitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1_024):
                part = batch.slice(low, 1_024)
                asked = _matrix(part.column("v"))
                floor = floors(part.column("row").to_numpy(), asked, *sample, k)
                width = max(asked.shape[1], pivots.shape[1])
                points, centres = _widened(asked.astype(np.float64), width), _widened(pivots, width)
                length = np.sqrt((points * points).sum(axis=1))[:, None]
                reach = _reach(points @ centres.T, length, 0.0, np.sqrt((centres * centres).sum(axis=1)), radii)
                open_ = filled & (reach >= (-np.inf if floor is None else floor[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.nulls(len(asked), pa.int64()) if floor is None else pa.array(floor),
                     pa.array([np.flatnonzero(o) for o in open_], pa.list_(pa.int32()))],
                    [*part.schema.names, "floor", "pivots"])

    def lookup(values: list[int]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("pivot") + 1)

    salt = F.xxhash64("row")
    held = near.select(
        "vec_id", "v", "row",
        (lookup(before) + F.pmod(salt, F.greatest(lookup(parts), F.lit(1)))).alias("block")
    ).withColumn("pair", F.explode(F.sequence(
        F.col("block") * groups, F.col("block") * groups + (groups - 1)))).drop("block")
    asked = rows.where("asks").select("vec_id", "v", "row").mapInArrow(
        admitted, "vec_id long, v array<bigint>, row long, floor long, pivots array<int>"
    ).withColumn("pivot", F.explode("pivots")).withColumn("block", F.explode(F.sequence(
        lookup(before), lookup(before) + lookup(parts) - 1))).select(
        "vec_id", "v", "row", "floor",
        (F.col("block") * groups + F.pmod(salt, F.lit(groups))).alias("pair"))

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({name: pa.array([], pa.int64())
                             for name in ("query_row", "query_id", "vec_id", "score")})
        held = held.sort_by([("vec_id", "ascending"), ("row", "ascending")])  # nulls last
        rows = asked["row"].to_numpy()
        floor = None if asked["floor"].null_count else asked["floor"].to_numpy()
        query, vector, score = Search(rows, _matrix(asked["v"]), held["row"].to_numpy(),
                                      _matrix(held["v"]), k, floor).answers()
        return pa.table({"query_row": rows[query], "query_id": asked["vec_id"].take(query),
                         "vec_id": held["vec_id"].take(vector), "score": score})

    found = asked.groupBy("pair").cogroup(held.groupBy("pair")).applyInArrow(
        search, "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


# For DuckDB, with the default parameters.
ORACLE = """
WITH r AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS mark,
           list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, q.mark, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM r q JOIN r c ON q.vec_id % 100 = 0 AND q.mark <> c.mark)
SELECT query_id, (row_number() OVER (PARTITION BY mark ORDER BY score DESC, vec_id NULLS LAST))::INT AS rank,
       vec_id, score
FROM s QUALIFY rank <= 10
"""
