"""Text quality by weak labels: overlapping heuristics vote, expectation-maximisation learns how far
each can be trusted, and the posterior labels train a hashed linear scorer.

The votes of all documents are counted by pattern (at most 3^8 of them), so the learning reads one
small table however many documents there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.linear import DIM, distinct_by_row, fit, flat, folded, row_sums, sigmoid
from gridweave.llm.textvec import PLAIN, ROWS, SPACED, words
from gridweave.llm.toxicity import filter_by_features, one_per_id

Batches = Iterator[pa.RecordBatch]

#: documents that the scorer is fitted on, at most
SAMPLE = 8000

LABELLERS = (
    "symbols", "capitals", "repeats", "function words", "bare symbols", "shouting", "word length",
    "line repeats",
)
GOOD, NONE, BAD = 0, 1, 2

# Frequent function words of the languages at hand.
FUNCTION_WORDS = (
    "the of and to in a is it that for on with as was be by are this at from or an have not "
    "der die das und in zu den ist mit von auf für ein eine im nicht sich dem des "
    "le la les de des et en un une du que est pour dans sur par qui avec pas au "
    "el los las y que del se por con una su para es al lo como más o"
)

# per byte: lower-case letter, capital, digit or the symbol itself
_SHAPE = np.arange(1, 257, dtype=np.uint16)
_SHAPE[97:123] = 98
_SHAPE[128:] = 98
_SHAPE[65:91] = 66
_SHAPE[48:58] = 49
_SHAPE[[9, 10, 11, 12, 13, 32]] = 0
#: words are lines
_LINES = np.arange(1, 257, dtype=np.uint16)
_LINES[[10, 13]] = 0

_CODES = np.zeros(256, np.uint8)  # 0 other, 1 lower, 2 capital, 3 symbol, 4 shouting
_CODES[97:123] = 1
_CODES[128:] = 1
_CODES[65:91] = 2
for _c in b"#$%&*|<>{}[]=+~^_@\\/`":
    _CODES[_c] = 3
_CODES[ord("!")] = 4


def _function_hashes() -> np.ndarray:
    every = [h for _, _, h, _, _ in words(pa.array([FUNCTION_WORDS]), PLAIN)]
    return np.unique(np.concatenate(every))


def _share(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    return x / np.maximum(of, 1)


def _adjacent(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per row, how many words equal the word before."""
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    inner = offs[:-1][offs[:-1] < len(hashes)]
    same[inner] = False
    return np.diff(np.concatenate([[0], np.cumsum(same)])[offs])


def _repeated(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per row, the share of words that an earlier word of the row equals."""
    out = np.zeros(len(offs) - 1)
    for r in range(len(out)):
        n = offs[r + 1] - offs[r]
        if n > 1:
            out[r] = 1 - len(np.unique(hashes[offs[r] : offs[r + 1]])) / n
    return out


def measures(texts: pa.Array) -> np.ndarray:
    """Per text the numbers that the labellers judge; see `votes`. Null texts count as empty."""
    if len(texts) > ROWS:
        return np.vstack([measures(texts.slice(i, ROWS)) for i in range(0, len(texts), ROWS)])
    n = len(texts)
    out = np.zeros((n, 10))
    large = texts.cast(pa.large_string())
    _, offsets, data = large.buffers()
    at = np.frombuffer(offsets, np.int64)[large.offset : large.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    for r in range(n):
        kinds = np.zeros(5)
        for lo in range(at[r], at[r + 1], 1 << 20):
            kinds += np.bincount(_CODES[raw[lo : min(lo + (1 << 20), at[r + 1])]], minlength=5)
        out[r, :5] = kinds[1] + kinds[2], kinds[2], kinds[3], kinds[4], at[r + 1] - at[r]
    known = _function_hashes()
    for a, b, hashes, offs, _ in words(texts, PLAIN):
        out[a:b, 5] = np.diff(offs)
        out[a:b, 6] = _adjacent(hashes, offs)
        hit = np.isin(hashes, known)
        out[a:b, 7] = np.diff(np.concatenate([[0], np.cumsum(hit)])[offs])
    for a, b, _, offs, _ in words(texts, SPACED):
        out[a:b, 8] = np.diff(offs)
    for a, b, hashes, offs, _ in words(texts, _LINES):
        out[a:b, 9] = _repeated(hashes, offs)
    return out


def votes(m: np.ndarray) -> np.ndarray:
    """Eight votes per text, each GOOD, BAD or NONE (no opinion)."""
    letters, capitals, symbols, shouts, size, plain, adjacent, function, spaced, lines = m.T
    enough = plain >= 8
    rules = (
        (_share(symbols, size), 0.03, 0.10, size >= 20),
        (_share(capitals, letters), 0.25, 0.50, letters >= 20),
        (_share(adjacent, plain), 0.05, 0.25, enough),
        (-_share(function, plain), -0.10, -0.03, plain >= 20),
        (_share(spaced - plain, spaced), 0.05, 0.20, enough),
        (_share(shouts, spaced), 0.05, 0.30, enough),
        (np.abs(_share(letters, plain) - 6), 4, 10, enough),
        (lines, 0.30, 0.70, enough),
    )
    out = np.full((len(m), len(rules)), NONE, np.uint8)
    for i, (x, good, bad, known) in enumerate(rules):
        out[:, i][known & (x <= good)] = GOOD
        out[:, i][known & (x >= bad)] = BAD
    return out


def _codes(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ 3 ** np.arange(v.shape[1])


def _vote(batches: Batches) -> Batches:
    for batch in batches:
        codes = _codes(votes(measures(batch["text"])))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(codes.astype(np.int32))], ["doc_id", "pattern"]
        )


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Probability of good quality per vote pattern, by expectation-maximisation.

    There is one good class and, as texts are bad in unlike ways, one bad class per labeller. In
    each class a labeller that has an opinion votes bad with a chance of its own, smoothed; having
    none says nothing. At the start a pattern belongs to the class of its first bad vote, or is good.
    """
    votes_ = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    bad = votes_ == BAD
    first = np.where(bad.any(axis=1), bad.argmax(axis=1) + 1, 0)
    of = np.full((len(patterns), len(LABELLERS) + 1), 0.02)
    of[np.arange(len(patterns)), first] = 1
    of /= of.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        weight = of * counts[:, None]
        log = np.log((weight.sum(axis=0) + 1) / (counts.sum() + of.shape[1]))[None, :]
        for j in range(len(LABELLERS)):
            yes = (weight * bad[:, j : j + 1]).sum(axis=0) + 0.5
            no = (weight * (votes_[:, j] == GOOD)[:, None]).sum(axis=0) + 0.5
            chance = yes / (yes + no)
            log = log + np.where(
                votes_[:, j : j + 1] == NONE,
                0,
                np.where(bad[:, j : j + 1], np.log(chance), np.log1p(-chance)),
            )
        new = np.exp(log - log.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - of).max() < 1e-6:
            break
        of = new
    return of[:, 0]


def quality_features(texts: pa.Array):
    """Yields (first row, last row + 1, feature numbers, offsets): shapes of words, and the measures
    in steps."""
    m = measures(texts)
    steps = np.stack(
        [
            np.minimum(_share(m[:, 2], m[:, 4]) * 50, 15),
            np.minimum(_share(m[:, 1], m[:, 0]) * 10, 15),
            np.minimum(_share(m[:, 6], m[:, 5]) * 20, 15),
            np.minimum(_share(m[:, 7], m[:, 5]) * 20, 15),
            np.minimum(_share(np.maximum(m[:, 8] - m[:, 5], 0), m[:, 8]) * 20, 15),
            np.minimum(_share(m[:, 3], m[:, 8]) * 20, 15),
            np.minimum(_share(m[:, 0], m[:, 5]), 15),
            m[:, 9] * 10,
            np.log2(m[:, 5] + 1),
        ],
        axis=1,
    ).astype(np.int64)
    for a, b, hashes, offs, short in words(texts, _SHAPE, (3,)):
        own = steps[a:b] + 64 * np.arange(steps.shape[1])
        rows = np.repeat(np.arange(b - a), np.diff(offs))
        numbers = np.concatenate([folded(own.ravel().astype(np.uint64), 9), folded(hashes, 1), folded(short[0], 2)])
        at = np.concatenate([np.repeat(np.arange(b - a), steps.shape[1]), rows, rows])
        yield a, b, *distinct_by_row(numbers, at, b - a)


def _features(batches: Batches) -> Batches:
    for batch in batches:
        for a, b, numbers, offsets in quality_features(batch["text"]):
            lists = pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), pa.array(numbers.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays([batch["good"][a:b], lists], ["good", "x"])


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, DataFrame]:
    """Weights and bias of the scorer, and the posterior per vote pattern.

    The votes of all documents are counted; the scorer is fitted on at most `sample` documents, the
    first by a hash of their id.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    voted = rows.mapInArrow(_vote, "doc_id long, pattern int")
    got = voted.groupBy("pattern").count().orderBy("pattern").toArrow()
    patterns, counts = got["pattern"].to_numpy().astype(np.int64), got["count"].to_numpy()
    good = posteriors(patterns, counts) if len(patterns) else np.zeros(0)
    table = spark.createDataFrame(
        [(int(p), float(g)) for p, g in zip(patterns, good, strict=True)], "pattern int, posterior double"
    )
    ids = (
        rows.select("doc_id").filter("doc_id is not null").distinct()
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    )
    # at most `sample` ids, and at most 3^8 patterns: bounded sides to broadcast
    chosen = one_per_id(rows.join(F.broadcast(ids), "doc_id"))
    by_pattern = dict(zip(patterns.tolist(), good.tolist(), strict=True))

    def labelled(batches: Batches) -> Batches:
        for batch in batches:
            codes = _codes(votes(measures(batch["text"])))
            target = pa.array([by_pattern.get(int(c), 0.5) for c in codes], pa.float64())
            named = pa.RecordBatch.from_arrays([batch["text"], target], ["text", "good"])
            yield from _features(iter([named]))

    data = chosen.select("text").mapInArrow(labelled, "good double, x array<int>").toArrow()
    if data.num_rows == 0:
        return np.zeros(DIM), 0.0, table
    weights, bias = fit(*flat(data["x"]), data["good"].to_numpy())
    return weights, bias, table


def quality(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, posterior, score, keep of every row: the weak label, the scorer's probability of good
    quality, and whether it reaches the threshold.

    Null and empty texts get no votes but have the measures of an empty text; labellers have no
    opinion on texts too short for them. Rows without doc_id are scored and not trained on; repeated
    rows get a row each. An empty table gives no rows. Other columns are ignored.
    """
    weights, bias, table = train(docs, sample)
    packed = weights.astype(np.float32).tobytes()

    def run(batches: Batches) -> Batches:
        w = np.frombuffer(packed, np.float32).astype(np.float64)
        for batch in batches:
            score = np.empty(batch.num_rows)
            for a, b, numbers, offsets in quality_features(batch["text"]):
                score[a:b] = sigmoid(row_sums(w[numbers], offsets) + bias)
            codes = _codes(votes(measures(batch["text"]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(codes), pa.array(score)], ["doc_id", "pattern", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(run, "doc_id long, pattern int, score double")
    return scored.join(F.broadcast(table), "pattern").select(
        "doc_id", "posterior", "score", (F.col("score") >= threshold).alias("keep")
    )


def keep_good(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs`, all columns, whose score reaches the threshold."""
    weights, bias, _ = train(docs, sample)
    return filter_by_features(docs, quality_features, weights, bias, lambda s: s >= threshold)
