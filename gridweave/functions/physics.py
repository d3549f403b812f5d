"""Heights and pressures as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
GRAVITY = 9.80665  # m s-2
DRY_AIR_GAS_CONSTANT = 287.05  # J kg-1 K-1
VIRTUAL_TEMPERATURE_FACTOR = 0.609133


def geopotential_height(geopotential: Column) -> Column:
    """Geopotential in m2 s-2 to height in m."""
    return geopotential / F.lit(GRAVITY)


def hybrid_height(a: Column, b: Column, orography: Column) -> Column:
    """Height of a hybrid-height level over terrain."""
    return a + b * orography


def hybrid_pressure(ap: Column, b: Column, surface_pressure: Column) -> Column:
    """Pressure of a hybrid sigma-pressure level."""
    return ap + b * surface_pressure


def layer_thickness(
    p: Column, p_next: Column, t: Column, t_next: Column,
    q: Column | None = None, q_next: Column | None = None,
) -> Column:
    """Thickness in m of the layer between two levels; moist when humidity is given."""
    temperature = (t + t_next) / F.lit(2.0)
    if q is not None:
        humidity = (q + q_next) / F.lit(2.0)
        temperature = temperature * (F.lit(1.0) + F.lit(VIRTUAL_TEMPERATURE_FACTOR) * humidity)
    ratio = F.try_divide(p, p_next)
    return F.lit(DRY_AIR_GAS_CONSTANT / GRAVITY) * temperature * F.ln(ratio)
