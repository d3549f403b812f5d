"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

*Lists.* A bounded sample is halved again and again at the median of its main direction; the means
of the leaves, equally full, are the centroids. Every vector goes to its nearest centroid's list,
and one near a boundary also to further ones: those hardly farther than the nearest, unless their
centroid nearly coincides with that of a list chosen before.

*Graph.* Every centroid is linked with its nearest ones and, so that all are reached, with those a
power of two further on in the order of the leaves. Tasks hold this graph and expand it from a few
entries towards a vector; nobody compares a vector with all centroids.

*Search.* A query is sent to the lists whose centroid's distance is at most a ratio of the nearest
one's. The ratio is measured, not set: a bounded number of queries is compared with all vectors, and
the smallest ratio is taken that finds the wanted share of their neighbours. So recall holds for
clustered vectors, where few lists are read, and for shapeless ones, where many are. Lists next to each other stand on one shelf of bounded size, and a query goes once to each
shelf that holds any of its lists. A list that is too large for a shelf, as one of many copies, is
dealt over several shelves by a hash, and its queries go to all of them.

Largest inner product is made a nearest-neighbour search by one more component, which lengthens all
vectors to the norm of the longest; queries have 0 there. Scores are computed from the original
components in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridweave.llm.common import written
from gridweave.llm.vectors import as_binary, by_shard, finite_rows, from_binary

Batches = Iterator[pa.RecordBatch]

SAMPLE = 65_536  # vectors the centroids are fitted on, at most
LIST = 256  # vectors that a list should hold
LISTS = 4_096  # lists at most: 16 vectors of a full sample for each
SHELF = 8_192  # postings of a shelf
LINKS = 16  # nearest centroids that a centroid is linked with
COPIES = 4  # lists of one vector, at most
BOUNDARY = 1.006  # a further list's distance, as a ratio of the nearest one's
SPREAD = 0.25  # least distance of a vector's centroids, as a share of the vector's to the further one
RECALL = 0.95  # share of the true neighbours that the ratio must find
JUDGES = 128  # queries that measure it
WIDTH = 32  # centroids a search keeps open, whatever their distance
ROWS = 256  # vectors searched in the graph at a time
_PAIRS = 1 << 16


@dataclass(frozen=True)
class Graph:
    """Centroids, their links, and where a search enters."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    def near(self, points: np.ndarray, ratio: float, width: int) -> np.ndarray:
        """Distance of each point to the centroids that its search met, infinite for the others.

        A search expands every centroid it met that is within `ratio` of the nearest one or among
        the `width` nearest, until there is none left.
        """
        n, k = len(points), len(self.centroids)
        distance = np.full((n, k), np.inf)
        expanded = np.zeros((n, k), bool)
        rows = np.repeat(np.arange(n), len(self.entries))
        cols = np.tile(self.entries, n)
        while len(rows):
            for lo in range(0, len(rows), _PAIRS):
                r, c = rows[lo : lo + _PAIRS], cols[lo : lo + _PAIRS]
                gap = points[r] - self.centroids[c]
                distance[r, c] = np.sqrt((gap * gap).sum(axis=1))
            bound = distance.min(axis=1) * ratio
            if k > width:
                bound = np.maximum(bound, np.partition(distance, width - 1, axis=1)[:, width - 1])
                bound[~np.isfinite(bound)] = np.finfo(np.float64).max
            open_rows, open_cols = np.nonzero((distance <= bound[:, None]) & ~expanded & np.isfinite(distance))
            expanded[open_rows, open_cols] = True
            links = self.links[open_cols]
            flat = np.unique((open_rows[:, None] * k + links).ravel())
            rows, cols = flat // k, flat % k
            new = ~np.isfinite(distance[rows, cols])
            rows, cols = rows[new], cols[new]
        return distance


def halved(sample: np.ndarray, leaves: int) -> np.ndarray:
    """Means of `leaves` (a power of two) equal parts of the sample, halved at medians."""
    parts = [sample]
    while len(parts) < leaves:
        parts = [half for part in parts for half in _halves(part)]
    return np.stack([p.mean(axis=0) for p in parts if len(p)])


def _halves(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    centred = part - part.mean(axis=0) if len(part) else part
    direction = np.ones(part.shape[1])
    for _ in range(6):
        direction = centred.T @ (centred @ direction) + 1e-9 * direction
        direction /= np.linalg.norm(direction) or 1.0
    order = np.argsort(centred @ direction, kind="stable")
    middle = len(part) // 2
    return part[order[:middle]], part[order[middle:]]


def linked(centroids: np.ndarray) -> Graph:
    """The graph of centroids, given in the order of the leaves."""
    _, first = np.unique(centroids, axis=0, return_index=True)
    centroids = centroids[np.sort(first)]
    k = len(centroids)
    strides = [1 << i for i in range(k.bit_length() - 1)] or [0]
    links = np.zeros((k, min(LINKS, k) + 2 * len(strides)), np.int64)
    norms = (centroids**2).sum(axis=1)
    for lo in range(0, k, 512):
        rows = np.arange(lo, min(lo + 512, k))
        gaps = norms[None, :] - 2 * centroids[rows] @ centroids.T
        links[rows, : min(LINKS, k)] = np.argsort(gaps, axis=1, kind="stable")[:, : min(LINKS, k)]
    for i, stride in enumerate(strides):
        links[:, min(LINKS, k) + 2 * i] = (np.arange(k) + stride) % k
        links[:, min(LINKS, k) + 2 * i + 1] = (np.arange(k) - stride) % k
    entries = np.unique(np.linspace(0, k - 1, 8).astype(np.int64))
    return Graph(centroids, links, entries)


def chosen(distance: np.ndarray, graph: Graph, boundary: float, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and lists of every posting: the nearest list, and further ones for boundary vectors."""
    n, k = distance.shape
    width = min(k, 4 * copies)
    near = np.argpartition(distance, width - 1, axis=1)[:, :width] if width < k else np.tile(np.arange(k), (n, 1))
    far = np.take_along_axis(distance, near, axis=1)
    order = np.lexsort((near, far), axis=1)
    near, far = np.take_along_axis(near, order, axis=1), np.take_along_axis(far, order, axis=1)
    taken = np.zeros((n, width), bool)
    taken[:, 0] = True
    for j in range(1, width):
        ok = (far[:, j] <= boundary * far[:, 0]) & (taken.sum(axis=1) < copies)
        for i in range(j):
            apart = np.linalg.norm(graph.centroids[near[:, i]] - graph.centroids[near[:, j]], axis=1)
            ok &= ~taken[:, i] | (apart > SPREAD * far[:, j])
        taken[:, j] = ok
    rows, cols = np.nonzero(taken)
    return rows, near[rows, cols]


def _lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that makes all as long as the longest."""
    rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _slices(batches: Batches, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of those that take part, a few rows at a time."""
    for batch in batches:
        rows, x = finite_rows(batch["embedding"], dims)
        good = (x != 0).any(axis=1)
        ids = batch["vec_id"].take(pa.array(rows[good])).to_numpy(zero_copy_only=False)
        x = x[good]
        for lo in range(0, len(ids), ROWS):
            yield ids[lo : lo + ROWS], x[lo : lo + ROWS]


def _stored(x: np.ndarray, single: bool) -> pa.Array:
    """Vectors as bytes, of the width that their column has: nothing is rounded."""
    return as_binary(x.astype(np.float32) if single else x)


def _read(column: pa.Array, dims: int, single: bool) -> np.ndarray:
    return from_binary(column, np.float32 if single else np.float64, dims).astype(np.float64)


def _norms(dims: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        n, longest = 0, 0.0
        for ids, x in _slices(batches, dims):
            n, longest = n + len(ids), max(longest, float((x * x).sum(axis=1).max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([longest])], ["n", "longest"])

    return run


def _taken(dims: int, single: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for ids, x in _slices(batches, dims):
            yield pa.RecordBatch.from_arrays([pa.array(ids), _stored(x, single)], ["vec_id", "vector"])

    return run


def _post(
    dims: int, single: bool, longest: float, graph: Graph, boundary: float
) -> Callable[[Batches], Batches]:
    """A posting per vector and list it goes to."""

    def run(batches: Batches) -> Batches:
        for ids, x in _slices(batches, dims):
            points = _lengthened(x, longest)
            rows, lists = chosen(graph.near(points, boundary, WIDTH), graph, boundary, COPIES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.astype(np.int32)), pa.array(ids[rows]), _stored(x[rows], single)],
                ["list", "vec_id", "vector"],
            )

    return run


def _judged(
    k: int, dims: int, single: bool, ids: np.ndarray, judges: np.ndarray, ratios: np.ndarray
) -> Callable[[Batches], Batches]:
    """Per task the best postings of every judging query, with the ratio at which its list is read."""

    def run(batches: Batches) -> Batches:
        room = k * COPIES
        kept: list[tuple[np.ndarray, ...]] = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        for batch in batches:
            of, lists = batch["vec_id"].to_numpy(), batch["list"].to_numpy()
            scores = _read(batch["vector"], dims, single) @ judges.T
            for j, own in enumerate(ids):
                score, ratio, who = scores[:, j], ratios[j][lists], of
                if room < len(score):
                    best = np.argpartition(-score, room - 1)[:room]
                    score, ratio, who = score[best], ratio[best], who[best]
                other = who != own
                both = [
                    np.concatenate(x) for x in zip(kept[j], (score[other], who[other], ratio[other]), strict=True)
                ]
                order = np.lexsort((both[1], -both[0]))[:room]
                kept[j] = tuple(x[order] for x in both)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(ids), dtype=np.int32), [len(x[0]) for x in kept])),
                *[pa.array(np.concatenate([x[i] for x in kept])) for i in (1, 0, 2)],
            ],
            ["judge", "vec_id", "score", "ratio"],
        )

    return run


def measured_ratio(
    postings: DataFrame, judges: pa.Table, graph: Graph, sizes: np.ndarray, k: int, dims: int, single: bool,
    recall: float,
) -> float:
    """The ratio of distances at which the lists read hold the wanted share of the judging queries'
    true neighbours; all vectors are compared with these queries."""
    ids = judges["vec_id"].to_numpy()
    x = _read(judges["vector"].combine_chunks(), dims, single)
    points = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
    gaps = np.stack([np.sqrt(((graph.centroids - p) ** 2).sum(axis=1)) for p in points])
    nearest = np.maximum(gaps[:, sizes > 0].min(axis=1, keepdims=True), 1e-12)
    best = Window.partitionBy("judge").orderBy(F.desc("score"), "vec_id")
    found = (
        postings.mapInArrow(
            _judged(k, dims, single, ids, x, gaps / nearest), "judge int, vec_id long, score double, ratio double"
        )
        .groupBy("judge", "vec_id")
        .agg(F.max("score").alias("score"), F.min("ratio").alias("ratio"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("ratio")
        .toArrow()  # k rows for each judging query
    )
    ratios = found["ratio"].to_numpy()
    return float(np.quantile(ratios, recall, method="higher")) * (1 + 1e-9) if len(ratios) else 1.0


@dataclass(frozen=True)
class Shelves:
    """First shelf of every list, and over how many shelves the list is dealt."""

    first: np.ndarray
    pieces: np.ndarray

    @staticmethod
    def of(sizes: np.ndarray, shelf: int) -> Shelves:
        first, pieces = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
        number, room = 0, shelf
        for i, size in enumerate(sizes.tolist()):
            if size > shelf:
                number += room < shelf
                pieces[i] = -(-size // shelf)
                first[i], number, room = number, number + pieces[i], shelf
                continue
            if size > room:
                number, room = number + 1, shelf
            first[i], room = number, room - size
        return Shelves(first, pieces)


def _ask(
    k: int, dims: int, single: bool, graph: Graph, sizes: np.ndarray, shelves: Shelves, ratio: float
) -> Callable[[Batches], Batches]:
    """A row per query and shelf that holds any of its lists, with these lists."""
    least = COPIES * (k + 1)  # postings that hold k other vectors

    def run(batches: Batches) -> Batches:
        for ids, x in _slices(batches, dims):
            points = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
            distance = graph.near(points, ratio, WIDTH)
            distance[:, sizes == 0] = np.inf
            bound = ratio * distance.min(axis=1, keepdims=True)
            read = (distance <= bound) & np.isfinite(distance)
            for i in np.flatnonzero(read @ sizes < least):  # further lists, until there are enough
                met = np.argsort(distance[i], kind="stable")[: np.isfinite(distance[i]).sum()]
                held = np.cumsum(sizes[met])
                if len(met) and held[-1] >= least:
                    read[i, met[: np.searchsorted(held, least) + 1]] = True
                else:
                    read[i] = sizes > 0
            rows, lists = np.nonzero(read)
            pieces = shelves.pieces[lists]
            at = np.repeat(np.arange(len(rows)), pieces)
            step = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            rows, lists, shelf = rows[at], lists[at], shelves.first[lists[at]] + step
            order = np.lexsort((lists, shelf, rows))
            rows, lists, shelf = rows[order], lists[order], shelf[order]
            if not len(rows):
                continue
            new = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(shelf, prepend=-1) != 0))
            offsets = pa.array(np.append(new, len(rows)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shelf[new].astype(np.int32)),
                    pa.array(np.ones(len(new), np.int32)),
                    pa.array(ids[rows[new]]),
                    _stored(x[rows[new]], single),
                    pa.ListArray.from_arrays(offsets, pa.array(lists.astype(np.int32))),
                ],
                ["shelf", "kind", "id", "vector", "lists"],
            )

    return run


def _shelved(table: pa.Table, dims: int, single: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings of a shelf in the order of lists."""
    table = table.combine_chunks()
    lists = table["lists"].combine_chunks().flatten().to_numpy()
    order = np.argsort(lists, kind="stable")
    ids = table["id"].to_numpy()[order]
    return lists[order], ids, _read(table["vector"].combine_chunks(), dims, single)[order]


def _first(
    k: int, live: np.ndarray, rough: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The k best different ids of the postings `live`, by exact score and then by the smaller id.

    A posting's rough score, from a product of matrices, may differ in the last bits; so the exact
    ones are taken of all that could be among the best, and equal scores are never split.
    """
    wanted = k
    while True:
        if wanted < len(live):
            least = np.partition(rough, len(live) - wanted)[len(live) - wanted]
            keep = live[rough >= least - 1e-9 * (1.0 + abs(least))]
        else:
            keep = live
        exact = (vectors[keep] * query).sum(axis=1)
        order = np.lexsort((ids[keep], -exact))
        # a vector that is in several lists, or in several rows, is one candidate
        _, first = np.unique(ids[keep][order], return_index=True)
        if len(first) >= k or len(keep) == len(live):
            order = order[np.sort(first)][:k]
            return ids[keep][order], exact[order]
        wanted *= 4


def _answer(k: int, dims: int, single: bool) -> Callable[[tuple, pa.RecordBatch], Batches]:
    """The k best of the query's lists on a shelf, by score and then by the smaller id."""

    def search(index: tuple, rows: pa.RecordBatch) -> Batches:
        on_shelf, ids, vectors = index
        asked = rows["id"].to_numpy()
        x = _read(rows["vector"], dims, single)
        lists = rows["lists"]
        bounds, wanted = lists.offsets.to_numpy(), lists.values.to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo in range(0, len(asked), ROWS):
            rough = x[lo : lo + ROWS] @ vectors.T
            for i in range(lo, min(lo + ROWS, len(asked))):
                mine = wanted[bounds[i] : bounds[i + 1]]
                score = rough[i - lo].copy()
                found = np.minimum(np.searchsorted(mine, on_shelf), len(mine) - 1)
                score[(mine[found] != on_shelf) | (ids == asked[i])] = -np.inf
                live = np.flatnonzero(np.isfinite(score))
                best, exact = _first(k, live, score[live], ids, vectors, x[i])
                out.append((np.full(len(best), asked[i]), best, exact))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([o[j] for o in out])) for j in range(3)],
                ["query_id", "vec_id", "score"],
            )

    return search


RESULT = "query_id long, rank int, vec_id long, score double"


def neighbours(
    vectors: DataFrame, queries: Column, k: int = 20, recall: float = RECALL, boundary: float = BOUNDARY,
    sample: int = SAMPLE, judges: int = JUDGES, size: int = LIST, shelf: int = SHELF,
) -> DataFrame:
    """The `k` vectors of largest inner product found for each row of `vectors` (vec_id, embedding)
    that fulfils `queries`: query_id, rank (from 1), vec_id, score, among all rows but those of the
    query's own id.

    Vectors that are null, zero, of another length than most, or have a null or non-finite component
    take no part, nor do rows without vec_id. Equal scores: the smaller vec_id. Repeated rows count
    once; if an id has several vectors, the score of two ids is the largest of their vectors. An
    empty table gives no rows; other columns are ignored.

    The centroids are fitted on at most `sample` vectors, chosen by a hash of the id; all vectors are
    indexed. Lists should hold `size` vectors; a task holds one shelf of about `shelf` postings.
    Of all candidates a query misses those whose lists are pruned: at most about 1 - `recall` of the
    true ones, as measured on `judges` queries.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", queries.alias("asks")
    ).filter("vec_id is not null and embedding is not null")
    lengths = rows.groupBy(F.size("embedding").alias("dims")).count()
    usual = lengths.filter("dims > 0").orderBy(F.desc("count"), "dims").first()
    if usual is None:
        return spark.createDataFrame([], RESULT)
    dims = usual["dims"]
    single = rows.schema["embedding"].dataType.elementType.typeName() == "float"
    plain = rows.select("vec_id", "embedding")
    of_all = plain.mapInArrow(_norms(dims), "n long, longest double").agg(
        F.sum("n").alias("n"), F.max("longest").alias("longest")
    ).first()
    n, longest = of_all["n"], of_all["longest"]
    if not n:
        return spark.createDataFrame([], RESULT)

    share = min(1.0, sample / n)
    some = plain.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    picked = some.mapInArrow(_taken(dims, single), "vec_id long, vector binary").limit(sample).toArrow()
    points = _lengthened(_read(picked["vector"].combine_chunks(), dims, single), longest)
    points = points[np.lexsort(points.T)]  # the order of rows must not matter
    leaves = 1
    while leaves < min(LISTS, n / size) and 16 * leaves <= len(points):
        leaves *= 2
    graph = linked(halved(points, leaves))

    postings = written(
        plain.mapInArrow(_post(dims, single, longest, graph, boundary), "list int, vec_id long, vector binary"),
        "postings",
    )
    asking = rows.filter("asks").select("vec_id", "embedding")
    judging = (
        asking.mapInArrow(_taken(dims, single), "vec_id long, vector binary")
        .orderBy(F.xxhash64("vec_id"), "vec_id", "vector")
        .limit(judges)
        .toArrow()
    )
    if not judging.num_rows:
        return spark.createDataFrame([], RESULT)
    sizes = np.zeros(len(graph.centroids), np.int64)
    for row in postings.groupBy("list").count().collect():  # a row per list
        sizes[row["list"]] = row["count"]
    ratio = measured_ratio(postings, judging, graph, sizes, k, dims, single, recall)
    shelves = Shelves.of(sizes, shelf)
    places = spark.createDataFrame(
        [(i, int(f), int(p)) for i, (f, p) in enumerate(zip(shelves.first, shelves.pieces, strict=True))],
        "list int, first int, pieces int",
    )
    # at most LISTS rows
    placed = postings.join(F.broadcast(places), "list").selectExpr(
        "cast(first + pmod(xxhash64(vec_id), pieces) as int) as shard", "0 as kind", "vec_id as id", "vector",
        "array(list) as lists",
    )
    asked = asking.mapInArrow(
        _ask(k, dims, single, graph, sizes, shelves, ratio),
        "shelf int, kind int, id long, vector binary, lists array<int>",
    ).withColumnRenamed("shelf", "shard")
    met = (
        placed.unionByName(asked)
        .repartition("shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(
            by_shard(lambda table: _shelved(table, dims, single), _answer(k, dims, single)),
            "query_id long, vec_id long, score double",
        )
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
