"""Exact top-k search by inner product with a pivot-distance index.

Vectors get one more component, so that they all have the same length and the largest inner product
is the smallest distance. Each is keyed by its nearest pivot and its distance to it; sorted by that
key, runs of vectors are stored as blocks: an annulus around a pivot each. A block of queries first
looks into the annuli next to its queries. The k-th score found there bounds how far better vectors
can be, and by the triangle inequality which annuli, and which part of them, can hold any. Those are
searched in full, so the result is exact; the index holds every vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridweave.llm.common import written

#: vectors that pivots are chosen from, at most; pivots
SAMPLE, PIVOTS = 4096, 64
BLOCK, QUERY_BLOCK = 1024, 128
#: blocks that a query looks into first
FIRST = 2
#: rows of blocks handed to Python at a time (each is up to about a megabyte)
_ROWS = 16

Batches = Iterator[pa.RecordBatch]
PREPARED = "vec_id long, v binary, n2 double, most double, width int"


def _prepare(scale: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for i, x in zip(batch["vec_id"].to_pylist(), batch["embedding"], strict=True):
                if i is None or not x.is_valid or x.values.null_count:
                    continue
                v = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(v).all():
                    rows.append((i, v.tobytes(), float(v @ v), float(np.abs(v).max(initial=0)), len(v)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.int64(), pa.binary(), pa.float64(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                [p.split()[0] for p in PREPARED.split(", ")],
            )

    return run


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Rows of doubles, shorter vectors filled with zeros."""
    if all(len(b) == 8 * width for b in blobs):
        return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), width)
    out = np.zeros((len(blobs), width))
    for i, b in enumerate(blobs):
        out[i, : len(b) // 8] = np.frombuffer(b, np.float64)
    return out


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that gives all the same length."""
    rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres of a few rounds of k-means over a bounded sample."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centres = sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        near = _distances(sample, centres).argmin(axis=1)
        for p in range(len(centres)):
            if (near == p).any():
                centres[p] = sample[near == p].mean(axis=0)
    return centres


def _assign(pivots: np.ndarray, longest: float, width: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _lifted(_matrix(batch["v"].to_pylist(), width), longest)
            d = _distances(x, pivots)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    batch["v"],
                    pa.array(near.astype(np.int32)),
                    pa.array(d[np.arange(len(near)), near]),
                ],
                ["vec_id", "v", "pivot", "r"],
            )

    return run


BLOCKS = "block long, pivot int, low double, high double, ids binary, rs binary, vs binary, n int"


def _pack(size: int, width: int, split: bool) -> Callable[[Batches], Batches]:
    """Blocks of sorted rows: of one pivot each if `split`, of `size` rows at most."""

    def run(batches: Batches) -> Batches:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal number, held
            ids, rs = np.array([h[0] for h in held], np.int64), np.array([h[3] for h in held])
            vs = _matrix([h[1] for h in held], width)
            row = [number, held[0][2], rs.min(), rs.max(), ids.tobytes(), rs.tobytes(), vs.tobytes()]
            number, held = number + 1, []
            types = (pa.int64(), pa.int32(), pa.float64(), pa.float64()) + (pa.binary(),) * 3
            columns = [pa.array([x], t) for x, t in zip(row, types, strict=True)]
            columns.append(pa.array([len(ids)], pa.int32()))
            return pa.RecordBatch.from_arrays(columns, [p.split()[0] for p in BLOCKS.split(", ")])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) >= size or split and held[0][2] != row[2]):
                    yield block()
                held.append(row)
        if held:
            yield block()

    return run


def _reach(
    pivots: np.ndarray, longest: float, width: int, wide: bool
) -> Callable[[Batches], Batches]:
    """Per block of queries and pivot the range of distances to look into.

    Not `wide`: only around each query at its nearest pivot. Wide: as far as a query's bound allows.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                q = np.frombuffer(row["vs"], np.float64).reshape(-1, width)
                d = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
                if wide:
                    bound = np.frombuffer(row["bounds"], np.float64)
                    far = _radius(q, bound, longest)
                    low, high = (d - far[:, None]).min(axis=0), (d + far[:, None]).max(axis=0)
                    found = [(p, low[p], high[p]) for p in range(len(pivots))]
                else:
                    near = d.argmin(axis=1)
                    found = [(p, x, x) for p, x in sorted(set(zip(near.tolist(), d.min(axis=1), strict=True)))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(found), pa.int64()),
                        pa.array([f[0] for f in found], pa.int32()),
                        pa.array([f[1] for f in found], pa.float64()),
                        pa.array([f[2] for f in found], pa.float64()),
                    ],
                    ["queries", "pivot", "low", "high"],
                )

    return run


def _radius(q: np.ndarray, bound: np.ndarray, longest: float) -> np.ndarray:
    """Distance of a vector whose score is the bound, with room for rounding."""
    square = (q * q).sum(axis=1) + longest
    return np.sqrt(np.maximum(square - 2 * bound, 0)) + 1e-6 * (1 + np.sqrt(square))


def _scores(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    return q @ x.T if exact else q.astype(np.int64) @ x.astype(np.int64).T


def _search(
    k: int, width: int, longest: float, pivots: np.ndarray, exact: bool
) -> Callable[[Batches], Batches]:
    """The k best of one annulus for each query of one block, above the query's bound."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                q = np.frombuffer(row["q_vs"], np.float64).reshape(-1, width)
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                bound = np.frombuffer(row["bounds"], np.float64) if row["bounds"] else None
                ids, rs = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["rs"], np.float64)
                x = np.frombuffer(row["vs"], np.float64).reshape(-1, width)
                if bound is not None:
                    own = pivots[row["pivot"]][None, :]
                    d = _distances(np.hstack([q, np.zeros((len(q), 1))]), own)[:, 0]
                    far = _radius(q, bound, longest)
                    a = int(np.searchsorted(rs, (d - far).min()))
                    b = int(np.searchsorted(rs, (d + far).max(), "right"))
                    ids, x = ids[a:b], x[a:b]
                if not len(ids):
                    continue
                scores = _scores(q, x, exact)
                out_q, out_i, out_s = [], [], []
                for n in range(len(q)):
                    s = scores[n]
                    keep = np.flatnonzero(ids != q_ids[n])
                    if bound is not None:
                        keep = keep[s[keep] >= bound[n]]
                    if len(keep) > k:
                        least = np.partition(s[keep], len(keep) - k)[len(keep) - k]
                        keep = keep[s[keep] >= least]
                        keep = keep[np.lexsort((ids[keep], -s[keep]))[:k]]
                    out_q.append(np.full(len(keep), q_ids[n]))
                    out_i.append(ids[keep])
                    out_s.append(s[keep].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in (out_q, out_i, out_s)],
                    ["query_id", "vec_id", "score"],
                )

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, pivots: int = PIVOTS
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of floor(scale * x) per query.

    `vectors` has vec_id and embedding; `queries` tells which rows are queries. Ties go to the
    smaller vec_id; a query does not meet rows of its own id; with fewer candidates all are
    returned. Rows with a null id, a null vector or a component that is null or not finite take no
    part; shorter vectors count as filled with zeros. Rows repeated with the same id and vector count
    once. No rows or no queries give no rows. Scores beyond 64 bits are not defined.
    """
    spark = vectors.sparkSession
    own = vectors.withColumn("_query", queries).filter("_query").select(
        F.col("vec_id").cast("long").alias("vec_id")
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    prepared = written(rows.mapInArrow(_prepare(scale), PREPARED).dropDuplicates(["vec_id", "v"]), "vectors")
    longest, most, width = prepared.agg(F.max("n2"), F.max("most"), F.max("width")).first()
    longest, most, width = longest or 0.0, most or 0.0, width or 0
    exact = most * most * max(width, 1) < 2**53
    sample = prepared.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    centres = choose_pivots(_lifted(_matrix(sample["v"].to_pylist(), width), longest), pivots)

    keyed = prepared.select("vec_id", "v").mapInArrow(
        _assign(centres, longest, width), "vec_id long, v binary, pivot int, r double"
    )
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal = lambda df: df.repartitionByRange(parts, "pivot", "r", "vec_id").sortWithinPartitions(
        "pivot", "r", "vec_id"
    )
    index = written(deal(keyed).mapInArrow(_pack(BLOCK, width, True), BLOCKS), "index")
    asked = keyed.join(own.distinct(), "vec_id", "left_semi")
    asked = written(deal(asked).mapInArrow(_pack(QUERY_BLOCK, width, False), BLOCKS), "queries")
    rings = index.select("block", "pivot", F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    reached = "queries long, pivot int, low double, high double"

    def searched(pairs: DataFrame, bounds: DataFrame | None) -> DataFrame:
        of = asked.select(F.col("block").alias("queries"), F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"))
        of = of.join(bounds, "queries") if bounds is not None else of.withColumn(
            "bounds", F.lit(None).cast("binary")
        )
        met = index.drop("low", "high").join(pairs.join(of, "queries"), "block")
        return met.select("q_ids", "q_vs", "bounds", "pivot", "ids", "rs", "vs").mapInArrow(
            _search(k, width, longest, centres, exact), "query_id long, vec_id long, score long"
        )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_ROWS))
    try:
        # first the annuli nearest to each query
        near = asked.mapInArrow(_reach(centres, longest, width, False), reached).join(rings, "pivot")
        gap = F.greatest(F.col("b_low") - F.col("high"), F.col("low") - F.col("b_high"), F.lit(0.0))
        order = Window.partitionBy("queries", "pivot", "low").orderBy(gap, "block")
        near = near.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= FIRST)
        some = _best(searched(near.select("queries", "block").distinct(), None), k)
        bound = written(
            some.groupBy("query_id").agg(
                F.when(F.count("*") == k, F.min("score").cast("double"))
                .otherwise(F.lit(float(-(2**62))))
                .alias("bound")
            ),
            "bounds",
        )
        of = asked.select(F.col("block").alias("queries"), "ids", "vs").mapInArrow(
            _ids, "queries long, place int, query_id long"
        )
        bounds = written(
            of.join(bound, "query_id", "left")
            .groupBy("queries")
            .agg(
                F.sort_array(
                    F.collect_list(
                        F.struct("place", F.coalesce("bound", F.lit(float(-(2**62)))).alias("bound"))
                    )
                ).alias("b")
            )
            .select("queries", F.col("b.bound").alias("bounds"))
            .mapInArrow(_bytes, "queries long, bounds binary"),
            "bounds",
        )
        # then all that these bounds cannot rule out
        wide = asked.join(bounds, F.col("block") == F.col("queries")).select("block", "vs", "bounds")
        wide = wide.mapInArrow(_reach(centres, longest, width, True), reached).join(rings, "pivot")
        wide = wide.filter("b_high >= low and b_low <= high").select("queries", "block").distinct()
        found = written(searched(wide, bounds), "found")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def _ids(batches: Batches) -> Batches:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), row["queries"], np.int64)),
                    pa.array(np.arange(len(ids), dtype=np.int32)),
                    pa.array(ids),
                ],
                ["queries", "place", "query_id"],
            )


def _bytes(batches: Batches) -> Batches:
    for batch in batches:
        blobs = [np.array(x, np.float64).tobytes() for x in batch["bounds"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["queries"], pa.array(blobs, pa.binary())], ["queries", "bounds"]
        )
