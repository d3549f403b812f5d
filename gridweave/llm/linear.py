"""Hashed sparse features of texts and a linear scorer on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridweave.llm.textvec import PLAIN, mix, words

BITS = 18
DIM = 1 << BITS


def folded(keys: np.ndarray, kind: int) -> np.ndarray:
    """Feature numbers of 64-bit keys; kinds do not meet except by chance."""
    return (mix(keys + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct_by_row(
    numbers: np.ndarray, rows: np.ndarray, n_rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct feature numbers: (numbers, offsets)."""
    both = np.unique(rows * DIM + numbers)
    return both & (DIM - 1), np.searchsorted(both, np.arange(n_rows + 1) * DIM)


def word_features(texts: pa.Array, prefixes: tuple[int, ...] = (4, 5, 6, 7)):
    """Yields (first row, last row + 1, feature numbers, offsets): a text's words and word starts."""
    for a, b, hashes, offs, short in words(texts, PLAIN, prefixes):
        rows = np.repeat(np.arange(b - a), np.diff(offs))
        numbers = np.concatenate([folded(x, kind) for kind, x in enumerate([hashes, *short])])
        yield a, b, *distinct_by_row(numbers, np.tile(rows, 1 + len(short)), b - a)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists; a null counts as an empty one."""
    one = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.fill_null(pc.list_value_length(one), 0).to_numpy(zero_copy_only=False)
    numbers = one.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return numbers, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def fit(
    numbers: np.ndarray,
    offsets: np.ndarray,
    target: np.ndarray,
    pairs: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None,
    *,
    row_weights: np.ndarray | None = None,
    sparse: float = 2e-4,
    fair: float = 1.0,
    steps: int = 250,
    rate: float = 0.3,
) -> tuple[np.ndarray, float]:
    """Logistic weights and bias over rows of features, by AdaGrad with soft thresholding.

    `target` may be soft (0 to 1). `pairs` holds signed features of differences between two
    versions of a row, as (numbers, signs, offsets, weights of the rows); their squared scores are
    penalised by `fair`. `row_weights` says how many rows each one stands for.
    """
    n = len(target)
    size = np.diff(offsets)
    weights, bias = np.zeros(DIM), 0.0
    if n == 0:
        return weights, bias
    stands = np.ones(n) if row_weights is None else row_weights / row_weights.mean()
    share = float(np.clip((stands * target).mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    # features whose share of positives is what chance gives among the rows read are left at zero
    mean = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    seen = np.bincount(numbers, minlength=DIM)
    held = np.bincount(numbers, weights=np.repeat(target, size), minlength=DIM)
    chance = (held - mean * seen) ** 2 / np.maximum(mean * (1 - mean) * seen, 1e-9)
    keep = ((seen >= 3) & (chance >= 9))[numbers]
    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    numbers = numbers[keep]
    size = np.diff(offsets)
    used, numbers = np.unique(numbers, return_inverse=True)
    w = np.zeros(len(used))
    past, past_bias = np.full(len(used), 1e-8), 1e-8
    if pairs is not None and len(pairs[2]) > 1:
        at = np.searchsorted(used, pairs[0])
        known = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == pairs[0])
        p_off = np.concatenate([[0], np.cumsum(known)])[pairs[2]]
        p_at, p_sign = at[known], pairs[1][known]
        p_stands = pairs[3] / pairs[3].mean()
    else:
        p_off = None
    for _ in range(steps):
        wrong = stands * (sigmoid(row_sums(w[numbers], offsets) + bias) - target)
        grad = np.bincount(numbers, weights=np.repeat(wrong, size), minlength=len(used)) / n
        if p_off is not None and fair:
            gap = p_stands * row_sums(w[p_at] * p_sign, p_off)
            grad += (
                2 * fair / (len(p_off) - 1)
                * np.bincount(p_at, weights=p_sign * np.repeat(gap, np.diff(p_off)), minlength=len(used))
            )
        past += grad**2
        step = rate / np.sqrt(past)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)
        g = wrong.mean()
        past_bias += g * g
        bias -= rate / np.sqrt(past_bias) * g
    weights[used] = w
    return weights, float(bias)
