"""Language of texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a trigram binds (multiplies) its
letters' vectors, the first shifted twice and the second once; a text bundles (sums) the vectors of
its trigrams, a language those of its texts, each text with the same weight. The answer is the
language whose profile has the largest cosine with the text's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 1024
SEED = 20240229
PIECE = 1 << 19  # characters worked at a time
_GAP, _EDGE = 0, 127  # codes of what is between words and between texts
_BOUND = "\x01"

Batches = Iterator[pa.RecordBatch]


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Per code point 0 for no letter, 1 to 26 for a-z, 27 to 126 for the others (shared by hash)."""
    table = np.zeros(0x110000, np.uint8)
    letters = np.array([i for i in range(0x110000) if chr(i).isalpha()])
    table[letters] = 27 + (letters * 2654435761 >> 7) % 100
    table[97:123] = np.arange(1, 27)
    table[ord(_BOUND)] = _EDGE
    return table


@lru_cache(maxsize=1)
def _letters(width: int, seed: int) -> tuple[np.ndarray, ...]:
    base = np.random.RandomState(seed).choice(np.array([-1, 1], np.float32), (128, width))
    base[_EDGE] = base[_GAP]
    return tuple(np.roll(base, shift, axis=1) for shift in (2, 1, 0))


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, str]]:
    """Row numbers and joined texts of about a piece; longer texts come in several, cut at a space."""
    rows: list[int] = []
    some: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        if not text:
            continue
        text = text.lower().replace(_BOUND, " ")
        while len(text) > PIECE:
            cut = text.find(" ", PIECE)
            if cut < 0:
                break
            yield np.array([row]), text[:cut]
            text = text[cut:]
        rows.append(row)
        some.append(text)
        size += len(text)
        if size >= PIECE or len(rows) >= 256:
            yield np.array(rows), _BOUND.join(some)
            rows, some, size = [], [], 0
    if rows:
        yield np.array(rows), _BOUND.join(some)


def trigram_counts(joined: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts (n texts x used trigrams) and the used trigrams' codes."""
    points = np.frombuffer((_BOUND + joined + _BOUND).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _codes()[points]
    text = np.cumsum(code == _EDGE) - 1
    keep = code != _GAP
    keep[1:] |= code[:-1] != _GAP  # of a run without letters the first stays
    code, text = code[keep].astype(np.int32), text[keep]
    if len(code) < 3:
        return np.zeros((n, 0), np.float32), np.zeros(0, np.int64)
    grams = code[:-2] << 14 | code[1:-1] << 7 | code[2:]
    lettered = (code[1:-1] != _EDGE) & ((code[:-2] | code[1:-1] | code[2:]) != _GAP)
    lettered &= ~((code[1:-1] == _GAP) & ((code[:-2] == _EDGE) | (code[2:] == _EDGE)))
    grams, text = grams[lettered], text[1:-1][lettered]
    used = np.flatnonzero(np.bincount(grams, minlength=1))
    place = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.int64)
    place[used] = np.arange(len(used))
    counts = np.bincount(text * len(used) + place[grams], minlength=n * len(used))
    return counts.reshape(n, len(used)).astype(np.float32), used


def trigram_vectors(used: np.ndarray, width: int, seed: int) -> np.ndarray:
    first, second, third = _letters(width, seed)
    return first[used >> 14] * second[used >> 7 & 127] * third[used & 127]


def _bundle(width: int, seed: int) -> Callable[[Batches], Batches]:
    """Per task and language the sum of the texts' vectors, each over its number of trigrams."""

    def run(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].to_pylist()
            for rows, joined in _pieces(batch["text"].to_pylist()):
                counts, used = trigram_counts(joined, len(rows))
                if not len(used):
                    continue
                counts /= np.maximum(counts.sum(axis=1, keepdims=True), 1)
                own = [langs[r] for r in rows]
                kinds = sorted(set(own))
                member = np.array([[o == k for o in own] for k in kinds], np.float32)
                part = (member @ counts) @ trigram_vectors(used, width, seed)
                for k, v in zip(kinds, part, strict=True):
                    sums[k] = sums.get(k, 0) + v.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], ["lang", "v"]
            )

    return run


def profiles(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages and their profiles, from all rows with a text and a lang.

    What reaches the driver is `width` numbers per distinct lang.
    """
    parts = docs.filter("text is not null and lang is not null").select("text", "lang")
    sums = (
        parts.mapInArrow(_bundle(width, seed), "lang string, v array<double>")
        .select("lang", F.posexplode("v").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .toArrow()
    )
    names = sorted(set(sums["lang"].to_pylist()))
    table = np.zeros((len(names), width))
    if names:
        row = np.searchsorted(np.array(names), np.array(sums["lang"].to_pylist()))
        table[row, sums["i"].to_numpy()] = sums["x"].to_numpy()
    return names, table


def _compare(
    names: list[str], table: np.ndarray, seed: int
) -> Callable[[Batches], Batches]:
    width = table.shape[1]
    norms = np.linalg.norm(table, axis=1)
    known = (table / np.maximum(norms, 1e-12)[:, None]).T.astype(np.float32)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            n = batch.num_rows
            dots = np.zeros((n, len(names)))
            own = np.zeros((n, width), np.float32)
            lettered = np.zeros(n, bool)
            for rows, joined in _pieces(batch["text"].to_pylist()):
                counts, used = trigram_counts(joined, len(rows))
                if len(used):
                    own[rows] += counts @ trigram_vectors(used, width, seed)
                    lettered[rows] |= counts.any(axis=1)
            if names:
                dots = own @ known / np.maximum(np.linalg.norm(own, axis=1), 1e-12)[:, None]
            best = dots.argmax(axis=1) if names else np.zeros(n, int)
            lettered &= bool(names)
            pred = [names[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
            top = dots[np.arange(n), best] if names else np.zeros(n)
            score = np.where(lettered, np.clip(top, 0, 1), 0.0).astype(np.float64)
            columns = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name != "text"]
            others = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(pred, pa.string()), pa.array(score)], [*others, "lang_pred", "score"]
            )

    return run


def held_out_rows(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict(docs: DataFrame, names: list[str], table: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, lang_pred, score of every row by given profiles; only the text is read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_compare(names, table, seed), "doc_id long, lang_pred string, score double")


def language(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; held-out rows teach nothing.

    Null texts and texts without a letter are `und` with score 0, as is every text when nothing can
    be learned. The score is the cosine, at least 0. A null doc_id is not held out. Equal cosines go
    to the first language by name. Repeated rows get a row each; other columns are ignored.
    """
    names, table = profiles(docs.filter(~held_out_rows(F.col("doc_id"))), width, seed)
    return predict(docs, names, table, seed).select(
        "doc_id", held_out_rows(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
