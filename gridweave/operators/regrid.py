"""Applying regridding weights to fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions.coords import cell_id, nan_to_null
from gridweave.operators.coordinates import with_coordinates


def merge_weights(weights: Mapping[str, DataFrame]) -> DataFrame:
    """Weights of several methods side by side: columns w_<name> and n_<name> per pair of cells.

    Lets one pass over the source apply a different method to each variable.
    """
    names = list(weights)
    stacked = None
    for name in names:
        part = weights[name].selectExpr(
            "dst_id", "src_id",
            *[f"{'w' if n == name else 'CAST(NULL AS DOUBLE)'} AS w_{n}" for n in names],
            *[f"{'n_src' if n == name else 'CAST(NULL AS INT)'} AS n_{n}" for n in names],
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("dst_id", "src_id").agg(
        *[F.expr(f"max({c}_{n}) AS {c}_{n}") for c in ("w", "n") for n in names]
    )


def _terms(
    field: DataFrame, weights: DataFrame, columns: Mapping[str, tuple[str, str]], by: Sequence[str]
) -> DataFrame:
    """Weighted source values of a field, with the number of sources each target needs."""
    source = field.selectExpr(
        *by, f"{cell_id('lat', 'lon')} AS src_id", *[f"{nan_to_null(v)} AS {v}" for v in columns]
    )
    return source.join(weights, "src_id").selectExpr(
        *by, "dst_id", *[f"{v} * {w} AS {v}" for v, (w, _) in columns.items()],
        *[f"{n} AS _n_{v}" for v, (_, n) in columns.items()],
    )


def _summed(terms: DataFrame, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    return terms.groupBy(*by, "dst_id").agg(
        *[F.expr(f"CASE WHEN count({v}) = max(_n_{v}) THEN sum({v}) END AS {v}") for v in values]
    )


def regrid_streams(
    streams: Sequence[tuple[DataFrame, DataFrame, Sequence[str]]],
    by: Sequence[str] = ("time", "lev_idx"),
) -> DataFrame:
    """Fields on grids of their own, (field, weights, value columns) each, in one aggregation."""
    terms = [
        _terms(field, weights, {v: ("w", "n_src") for v in values}, by)
        for field, weights, values in streams
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), terms)
    return _summed(every, [v for _, _, values in streams for v in values], by)


def regrid(
    field: DataFrame, weights: DataFrame, values: Mapping[str, str] | Sequence[str] = ("value",),
    by: Sequence[str] = ("time", "lev_idx"), coordinates: bool = False,
    dense_grid: DataFrame | None = None,
) -> DataFrame:
    """Weighted sums of source values per target cell.

    ``values`` names the value columns, or maps each one to its method in merged weights. A
    target value is NULL unless every one of its source values is there. Target cells without
    weights have no rows, unless ``dense_grid`` lists the cells that must be there.

    Plan: scan, join with the weights (drops source cells no target needs), partial sums on the
    map side, one exchange. Stored weights have an exact size, by which Spark chooses the join.
    """
    if isinstance(values, Mapping):
        columns = {v: (f"w_{m}", f"n_{m}") for v, m in values.items()}
    else:
        columns = {v: ("w", "n_src") for v in values}
    terms = _terms(field, weights, columns, by)
    if dense_grid is not None:
        # empty terms for every wanted cell, merged by the same aggregation instead of a join
        empty = at_every_step(field.select(*by).distinct(), dense_grid.select("dst_id"))
        terms = terms.unionByName(empty.select(*by, "dst_id"), allowMissingColumns=True)
    summed = _summed(terms, list(columns), by)
    return with_coordinates(summed) if coordinates else summed


def at_every_step(steps: DataFrame, grid: DataFrame) -> DataFrame:
    """Each row of ``steps`` with every row of the grid, which is what a dense result has.

    An equality join on a part of the grid, as many parts as shuffles have partitions, so a large
    grid is shuffled in pieces.
    """
    parts = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = grid.selectExpr("*", f"pmod(xxhash64(dst_id), {parts}L) AS _part")
    numbered = steps.selectExpr("*", f"explode(sequence(0L, {parts - 1}L)) AS _part")
    return numbered.join(pieces, "_part").drop("_part")
