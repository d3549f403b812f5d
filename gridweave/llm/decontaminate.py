"""Benchmark decontamination by greedy string tiling.

Runs of five words that a document shares with a benchmark item are seeds, found by a join on
running Karp-Rabin hashes. Per document and item the seeds on one diagonal make the maximal
matches; the longest is marked again and again, matches that meet marked words are cut, and what is
left of five words or more is marked in its turn. A document leaks an item when its tiles cover
enough of the item's words, in whatever order they stand.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.common import free_name, written
from gridweave.llm.textvec import PLAIN, grams, sequence, words

BITS = 22  # of the table of seeds: 512 KB, however large the benchmark

Batches = Iterator[pa.RecordBatch]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _item_seeds(k: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch["item_id"]
            for a, b, hashes, offs, _ in words(batch["text"], PLAIN):
                every = grams(hashes, k)
                for r in range(a, b):
                    lo, hi = offs[r - a], offs[r - a + 1]
                    n = max(0, hi - lo - k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[r].as_py()] * n, pa.int64()),
                            pa.array(np.full(n, hi - lo, np.int32)),
                            pa.array(np.arange(n, dtype=np.int32)),
                            _signed(every[lo : lo + n]),
                        ],
                        ["item_id", "n_words", "i", "seed"],
                    )

    return run


def _text_seeds(k: int, bits: bytes) -> Callable[[Batches], Batches]:
    """The runs of k words of each text whose cell in the table of seeds is marked."""

    def run(batches: Batches) -> Batches:
        table = np.frombuffer(bits, np.uint8)
        for batch in batches:
            for a, b, hashes, offs, _ in words(batch["text"], PLAIN):
                every = grams(hashes, k)
                cell = (every >> np.uint64(64 - BITS)).astype(np.int64)
                at = np.flatnonzero(table[cell >> 3] >> (cell & 7).astype(np.uint8) & 1)
                if not len(at):
                    continue
                row = np.searchsorted(offs, at, "right") - 1
                inside = at + k <= offs[row + 1]
                at, row = at[inside], row[inside]
                named = {r: int(sequence_name(hashes[offs[r] : offs[r + 1]])) for r in np.unique(row)}
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(pa.array(row + a)),
                        pa.array(np.array([named[r] for r in row], np.int64)),
                        pa.array((at - offs[row]).astype(np.int32)),
                        _signed(every[at]),
                    ],
                    ["doc_id", "text_name", "j", "seed"],
                )

    return run


def sequence_name(hashes: np.ndarray) -> np.int64:
    """A digest of a text's words, to tell apart rows that share an id."""
    places = np.arange(len(hashes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return sequence((hashes * places).sum(keepdims=True)).view(np.int64)[0]


def tiles(i: np.ndarray, j: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item position, text position, length) from seeds of k words at (i, j).

    Longest first; of equal ones the first in the item, then in the text. Repeated seeds count once.
    """
    if not len(i):
        return []
    diagonal = j.astype(np.int64) - i
    order = np.lexsort((i, diagonal))
    i, diagonal = i[order].astype(np.int64), diagonal[order]
    new = np.concatenate([[True], (np.diff(diagonal) != 0) | (np.diff(i) > 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(i)]]) - 1
    heap = [
        (-int(i[b] - i[a] + k), int(i[a]), int(i[a] + diagonal[a]))
        for a, b in zip(first, last, strict=True)
    ]
    heapq.heapify(heap)
    item_marked: set[int] = set()
    text_marked: set[int] = set()
    out = []
    while heap:
        length, x, y = heapq.heappop(heap)
        free = [x + t not in item_marked and y + t not in text_marked for t in range(-length)]
        if all(free):
            out.append((x, y, -length))
            item_marked.update(range(x, x - length))
            text_marked.update(range(y, y - length))
            continue
        t = 0
        while t < -length:
            if free[t]:
                end = t
                while end < -length and free[end]:
                    end += 1
                if end - t >= k:
                    heapq.heappush(heap, (t - end, x + t, y + t))
                t = end
            else:
                t += 1
    return out


TILED = "doc_id long, item_id long, n_words int, covered int, n_tiles int, longest int"


def _tile(k: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            covered, count, longest = [], [], []
            for seeds in batch["seeds"]:
                rows = seeds.values
                found = tiles(
                    rows.field("i").to_numpy(zero_copy_only=False),
                    rows.field("j").to_numpy(zero_copy_only=False),
                    k,
                )
                lengths = [t[2] for t in found]
                covered.append(sum(lengths))
                count.append(len(lengths))
                longest.append(max(lengths, default=0))
            more = [pa.array(x, pa.int32()) for x in (covered, count, longest)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["item_id"], batch["n_words"], *more],
                [part.split()[0] for part in TILED.split(", ")],
            )

    return run


def tiled_pairs(docs: DataFrame, benchmark: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, item_id, n_words, covered, n_tiles, longest of every document and item that share
    a run of k words.

    Words are runs of letters and digits, lower-cased. Items of one text count once, under the
    smallest id; items of fewer than k words, null or empty ones cannot be found. Rows of `docs`
    that share a doc_id but not the text get a row each. Rows without doc_id keep their null.
    """
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
        .filter("text is not null and item_id is not null")
        .groupBy("text")
        .agg(F.min("item_id").alias("item_id"))
        .select("item_id", "text")
    )
    seeds = written(
        items.mapInArrow(_item_seeds(k), "item_id long, n_words int, i int, seed long"),
        "seeds",
        narrow=True,
    )
    # marks in a table of fixed size
    marks = (
        seeds.selectExpr(f"shiftrightunsigned(seed, {64 - BITS}) cell")
        .selectExpr("cast(cell >> 3 as int) byte", "1 << cast(cell & 7 as int) bit")
        .groupBy("byte")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    bits[marks["byte"].to_numpy()] = marks["bits"].to_numpy().astype(np.uint8)
    hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    hits = hits.mapInArrow(
        _text_seeds(k, bits.tobytes()), "doc_id long, text_name long, j int, seed long"
    )
    pairs = (
        hits.join(seeds, "seed")
        .groupBy("doc_id", "text_name", "item_id", "n_words")
        .agg(F.collect_set(F.struct("i", "j")).alias("seeds"))  # as many as one text has words
        .select("doc_id", "item_id", "n_words", "seeds")
    )
    return pairs.mapInArrow(_tile(k), TILED)


def contamination(
    docs: DataFrame, benchmark: DataFrame, k: int = 5, coverage: float = 0.5
) -> DataFrame:
    """Per doc_id: leaked, the ids of the items it leaks, and its largest coverage of an item.

    One row per distinct doc_id; documents that share nothing have coverage 0 and an empty list.
    """
    share = F.col("covered") / F.col("n_words")
    found = (
        tiled_pairs(docs, benchmark, k)
        .groupBy("doc_id")
        .agg(
            F.max(share).alias("coverage"),
            F.sort_array(F.collect_set(F.when(share >= coverage, F.col("item_id")))).alias("items"),
        )
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return ids.join(found, ids.doc_id.eqNullSafe(found.doc_id), "left").select(
        ids.doc_id,
        (F.coalesce("coverage", F.lit(0.0)) >= coverage).alias("leaked"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, k: int = 5, coverage: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, without documents that leak an item.

    Rows without doc_id and with a null or empty text stay, repeated rows stay or go together, and an
    empty table gives no rows. Columns of any name are passed on.
    """
    own = free_name("leaked_id", docs.columns)
    leaked = (
        tiled_pairs(docs, benchmark, k)
        .filter(F.col("covered") >= coverage * F.col("n_words"))
        .select(F.col("doc_id").alias(own))
        .distinct()
    )
    # few ids beside the texts: written first, their exact size plans the join
    keyed = docs.withColumn(own, F.col("doc_id").cast("long"))
    return keyed.join(written(leaked, "leaked", narrow=True), own, "left_anti").select(*docs.columns)
