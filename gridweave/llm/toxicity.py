"""Toxicity of texts by a hashed linear classifier with a counterfactual penalty.

Training texts that name a group of people are read a second time with the group's name swapped for
another of the same kind. The fit penalises the squared difference of the two scores, so that the
name of a group alone does not move the score.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm.linear import DIM, fit, flat, row_sums, sigmoid, word_features

Batches = Iterator[pa.RecordBatch]

# Names of groups, each line of one kind and form; a name is swapped for the next.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "natives"),
    ("disabled", "deaf", "blind"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)

#: labelled texts of each class that a model is fitted on, at most
PER_CLASS = 4000


def swap_table(groups: tuple[tuple[str, ...], ...]) -> dict[str, str]:
    return {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}


def swapped(text: str, table: dict[str, str], pattern: re.Pattern[str]) -> str:
    """The text with every group's name replaced by the next name of its kind."""
    return pattern.sub(lambda m: table[m[0].lower()], text)


def _training_features(groups: tuple[tuple[str, ...], ...]) -> Callable[[Batches], Batches]:
    table = swap_table(groups)
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, sorted(table))) + r")\b", re.IGNORECASE)

    def lists(texts: pa.Array) -> pa.Array:
        numbers, offsets = [], [np.zeros(1, np.int64)]
        for _, _, x, o in word_features(texts):
            numbers.append(x)
            offsets.append(o[1:] + offsets[-1][-1])
        if not numbers:
            return pa.array([], pa.list_(pa.int32()))
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate(offsets).astype(np.int32)),
            pa.array(np.concatenate(numbers).astype(np.int32)),
        )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                other = [
                    None if t is None else s if (s := swapped(t, table, pattern)) != t else None
                    for t in part["text"].to_pylist()
                ]
                again = pa.array(other, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part["label"], part["weight"], lists(part["text"]), lists(again), again.is_valid()],
                    ["label", "weight", "x", "y", "named"],
                )

    return run


def one_per_id(rows: DataFrame, *others: str) -> DataFrame:
    """One row per doc_id, with the columns that an id determines: that of the text first by its hash."""
    first = F.min(F.struct(F.xxhash64("text").alias("digest"), "text"))["text"].alias("text")
    return rows.groupBy("doc_id", *others).agg(first)


def bounded_labels(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, label and weight of at most `per_class` rows of each class, by a hash of the id.

    The weight is the number of labelled ids of the class per id that is taken, so that the classes
    keep their shares. Null ids and labels are left out; a doc_id with several labels has its largest.
    """
    one = (
        labels.select("doc_id", F.col(label).cast("double").alias("label"))
        .filter("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = F.xxhash64(F.col("doc_id").cast("string"))
    sizes = one.groupBy((F.col("label") > 0.5).alias("marked")).count().collect()
    weights = {r["marked"]: max(r["count"] / per_class, 1.0) for r in sizes}

    def taken(rows: DataFrame, marked: bool) -> DataFrame:
        first = rows.orderBy(order, "doc_id").limit(per_class)
        return first.withColumn("weight", F.lit(weights.get(marked, 1.0)))

    return taken(one.filter("label > 0.5"), True).union(taken(one.filter("label <= 0.5"), False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    *,
    per_class: int = PER_CLASS,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    fair: float = 1.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias learned from at most 2 * `per_class` labelled rows, one per doc_id.

    Rows of a class that is not taken whole weigh more, so that the scores keep the share of toxic
    ones among all labelled ids, whatever their number. Without labelled rows all scores are 0.5, with rows of one class the share of that class.
    """
    sample = bounded_labels(labels, label, per_class)
    # at most 2 * per_class rows of three numbers: a bounded side to broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = one_per_id(found, "label", "weight").select("label", "weight", "text")
    got = rows.mapInArrow(
        _training_features(groups),
        "label double, weight double, x array<int>, y array<int>, named boolean",
    ).toArrow()
    if got.num_rows == 0:
        return np.zeros(DIM), 0.0
    numbers, offsets = flat(got["x"])
    target, heavy = got["label"].to_numpy(), got["weight"].to_numpy()
    named = got.filter(got["named"])
    pairs = None
    if named.num_rows:
        x, x_at = flat(named["x"])
        y, y_at = flat(named["y"])
        parts, signs, at = [], [], [0]
        for i in range(named.num_rows):
            p, q = x[x_at[i] : x_at[i + 1]], y[y_at[i] : y_at[i + 1]]
            gone, new = np.setdiff1d(p, q), np.setdiff1d(q, p)
            parts += [gone, new]
            signs += [np.ones(len(gone)), -np.ones(len(new))]
            at.append(at[-1] + len(gone) + len(new))
        pairs = np.concatenate(parts), np.concatenate(signs), np.array(at), named["weight"].to_numpy()
    return fit(numbers, offsets, target, pairs, row_weights=heavy, fair=fair)


def scorer(weights: np.ndarray, bias: float, keep: str) -> Callable[[Batches], Batches]:
    """Adds each text's score to the column `keep`. The model has a fixed size."""
    packed = weights.astype(np.float32).tobytes()

    def run(batches: Batches) -> Batches:
        w = np.frombuffer(packed, np.float32).astype(np.float64)
        for batch in batches:
            out = np.empty(batch.num_rows)
            for a, b, numbers, offsets in word_features(batch["text"]):
                out[a:b] = sigmoid(row_sums(w[numbers], offsets) + bias)
            yield pa.RecordBatch.from_arrays([batch[keep], pa.array(out)], [keep, "score"])

    return run


def held_out_rows(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def toxicity(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, per_class: int = PER_CLASS
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`, by a model that learns only from
    labelled rows that are not held out.

    Null and empty texts have no features: their score is that of the bias. A null doc_id is not
    held out and carries no label. Repeated rows get a row each; other columns are ignored.
    """
    seen = labels.filter(~held_out_rows(F.col("doc_id")))
    weights, bias = train(docs, seen, per_class=per_class)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scorer(weights, bias, "doc_id"), "doc_id long, score double"
    )
    return scored.select(
        "doc_id",
        F.coalesce(held_out_rows(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, per_class: int = PER_CLASS
) -> DataFrame:
    """The rows of `docs`, all columns, whose score stays below the threshold."""
    weights, bias = train(docs, labels, per_class=per_class)
    return filter_by_features(docs, word_features, weights, bias, lambda s: s < threshold)


def filter_by_features(
    docs: DataFrame,
    features: Callable,
    weights: np.ndarray,
    bias: float,
    wanted: Callable[[np.ndarray], np.ndarray],
) -> DataFrame:
    """The rows whose text's score is wanted, without a join: rows keep all their columns."""
    packed = weights.astype(np.float32).tobytes()

    def run(batches: Batches) -> Batches:
        w = np.frombuffer(packed, np.float32).astype(np.float64)
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for a, b, numbers, offsets in features(batch["text"]):
                keep[a:b] = wanted(sigmoid(row_sums(w[numbers], offsets) + bias))
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
