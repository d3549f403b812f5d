"""Coordinate arithmetic as SQL expressions.

Each function takes SQL expressions and returns one, for ``selectExpr`` and ``F.expr``.

Cells are identified by a BIGINT made from the coordinates themselves, in steps of one
millionth of a degree. The id needs no lookup table, so a field of any size gets its ids in
the scan stage, two grids never disagree about an id, and the coordinates can be read back.
"""

from __future__ import annotations

# Fixed values
STEPS_PER_DEGREE = 1_000_000
CIRCLE = 360 * STEPS_PER_DEGREE
ID_BASE = 1_000_000_000


def nan_to_null(value: str) -> str:
    """NaN is the array world's missing value; Spark aggregates need NULL."""
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


def clip_latitude(lat: str) -> str:
    """Clamp to [-90, 90]; NULL stays NULL (least and greatest alone would skip it)."""
    return f"CASE WHEN {lat} IS NOT NULL THEN least(90D, greatest(-90D, {lat})) END"


def wrap_longitude(lon: str) -> str:
    """Bring to [0, 360)."""
    return f"pmod(CAST({lon} AS DOUBLE), 360D)"


def degree_key(degrees: str) -> str:
    """Whole steps of a coordinate; equal keys mean the same coordinate."""
    return f"floor(({degrees}) * {STEPS_PER_DEGREE}D + 0.5D)"


def cell_id(lat: str, lon: str) -> str:
    """BIGINT id of the cell centred at (lat, lon)."""
    row = degree_key(f"{clip_latitude(lat)} + 90D")
    return f"({row} * {ID_BASE}L + pmod({degree_key(lon)}, {CIRCLE}L))"


def cell_lat(cell: str) -> str:
    """Latitude of a cell id, to one millionth of a degree."""
    return f"(({cell} div {ID_BASE}L) / {STEPS_PER_DEGREE}D - 90D)"


def cell_lon(cell: str) -> str:
    """Longitude of a cell id, in [0, 360)."""
    return f"(({cell} % {ID_BASE}L) / {STEPS_PER_DEGREE}D)"
