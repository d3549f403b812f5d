"""The same results in plain SQL for another engine, for checking the queries."""

from __future__ import annotations

TIME_FORMAT = "%Y-%m-%d %H:%M:%S"

# Shared tables -------------------------------------------------------------------------------

SRC = """src AS (
  SELECT time, lev_idx, lat, lon, price*0.00031415926535e0 AS value,
         9.80665e0*(500e0*lev_idx*lev_idx + qty*0.98765432101e0) AS geopotential,
         qty*0.00031415926535e0 AS humidity
  FROM (SELECT make_timestamp(year(l_shipdate), month(l_shipdate), 1, 6*(month(l_shipdate)%4), 0, 0) AS time,
               l_linenumber AS lev_idx, -90e0 + 45*(l_suppkey%5) AS lat, 90e0*(l_partkey%4) AS lon,
               avg(l_extendedprice) AS price, avg(l_quantity) AS qty
        FROM lineitem GROUP BY ALL))"""

_TGT_KEYS = """1 + (o_orderkey//24)%5 AS lev_idx, -75e0 + 30*(o_custkey%6) AS lat,
         30e0*((o_orderkey//2)%12) AS lon"""
_TGT_TIME = "make_timestamp(year(o_orderdate), month(o_orderdate), 1, 6*(month(o_orderdate)%4), 0, 0) AS time"

TGT = f"""tgt AS (
  SELECT {_TGT_TIME}, {_TGT_KEYS}, avg(o_totalprice)*0.000031415926535e0 AS value
  FROM orders GROUP BY ALL)"""

PS = f"""ps AS (
  SELECT {_TGT_TIME}, -75e0 + 30*(o_custkey%6) AS lat, 30e0*((o_orderkey//2)%12) AS lon,
         95000e0 + avg(o_totalprice)*0.00031415926535e0 AS ps
  FROM orders GROUP BY ALL)"""

HEIGHTS = f"""heights AS (
  SELECT lev_idx, lat, lon, 60e0*lev_idx*lev_idx*lev_idx*lev_idx + p*0.00031415926535e0 AS zfull
  FROM (SELECT {_TGT_KEYS}, avg(o_totalprice) AS p FROM orders GROUP BY ALL))"""

WIND = """wind AS (
  SELECT DISTINCT -60e0 + 30*(o_custkey%5) AS lat, 15e0 + 30*((o_orderkey//2)%11) AS lon
  FROM orders)"""

SURFACE = """surface AS (
  SELECT make_timestamp(year(l_shipdate), month(l_shipdate), 1, 6*(month(l_shipdate)%4), 0, 0) AS time,
         -90e0 + 45*(l_suppkey%5) AS lat, 90e0*(l_partkey%4) AS lon,
         avg(l_extendedprice)*0.00031415926535e0 AS value
  FROM lineitem GROUP BY ALL)"""

SERIES = """series AS (
  SELECT ts AS time, event_type AS var, user_id AS cell, value*0.031415926535e0 AS value
  FROM events)"""

STATIONS = """stations AS (
  SELECT ts AS time, event_type AS var, user_id%7 AS cell, value*0.031415926535e0 AS value
  FROM events)"""

SIX = """six AS (
  SELECT time_bucket(INTERVAL '6 hours', time) AS time, var, cell, avg(value) AS value
  FROM stations GROUP BY ALL)"""

SIGMA = """coef(lev_idx, ap, b) AS (VALUES (1, 0e0, 0.99e0), (2, 1500e0, 0.83e0),
  (3, 6200e0, 0.51e0), (4, 9800e0, 0.17e0), (5, 4100e0, 0e0))"""

HYBRID = """coef(lev_idx, a, b) AS (VALUES (1, 20e0, 0.99e0), (2, 300e0, 0.91e0),
  (3, 1900e0, 0.62e0), (4, 7400e0, 0.13e0), (5, 21000e0, 0e0))"""

PROFILES = """profiles AS (
  SELECT vec_id, label, lev_idx, 100e0*lev_idx + 40e0*e AS z, e*314.15926535e0 AS value
  FROM (SELECT vec_id, label, unnest(range(0, len(embedding)))::INTEGER AS lev_idx,
               unnest(embedding)::DOUBLE AS e FROM embeddings))"""

POINTS = """points AS (
  SELECT vec_id, lev_idx, -150e0 + 670e0*lev_idx + 3.7e0*label AS x
  FROM (SELECT vec_id, label, unnest(range(0, 11))::INTEGER AS lev_idx FROM embeddings))"""


def r(expr: str, name: str, digits: int = 6) -> str:
    """Rounded column without negative zero."""
    return f"round({expr}, {digits}) + 0e0 AS {name}"


def t(expr: str = "time", name: str = "time") -> str:
    return f"strftime({expr}, '{TIME_FORMAT}') AS {name}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Weights ------------------------------------------------------------------------------------


def axis(name: str, table: str, column: str) -> str:
    """Successive axis values of a table."""
    return f"""{name} AS (
  SELECT lag(x) OVER (ORDER BY x) AS xp, x AS x0, lead(x) OVER (ORDER BY x) AS x1,
         lead(x, 2) OVER (ORDER BY x) AS xn, row_number() OVER (ORDER BY x) = 1 AS first
  FROM (SELECT DISTINCT {column} AS x FROM {table}))"""


def periodic_axis(name: str, table: str, column: str) -> str:
    return f"""{name} AS (
  SELECT lag(x) OVER (ORDER BY x) AS xp, x AS x0, lead(x) OVER (ORDER BY x) AS x1,
         lead(x, 2) OVER (ORDER BY x) AS xn, row_number() OVER (ORDER BY x) = 1 AS first
  FROM (SELECT DISTINCT {column} AS x FROM {table}
        UNION SELECT min({column}) + 360 FROM {table}))"""


def linear_nodes(name: str, axis_name: str, table: str, column: str) -> str:
    return f"""{name} AS (
  SELECT dst, n.x AS src, n.w AS w, count(*) OVER (PARTITION BY dst) AS n FROM (
    SELECT d.x AS dst, unnest([{{'x': a.x0, 'w': 1 - (d.x - a.x0)/(a.x1 - a.x0)}},
                               {{'x': a.x1, 'w': (d.x - a.x0)/(a.x1 - a.x0)}}]) AS n
    FROM (SELECT DISTINCT {column} AS x FROM {table}) d JOIN {axis_name} a
      ON d.x <= a.x1 AND (d.x > a.x0 OR (a.first AND d.x = a.x0)))
  WHERE n.w <> 0)"""


def patch_nodes(name: str, axis_name: str, table: str, column: str) -> str:
    return f"""{name} AS (
  SELECT dst, n.x AS src, n.w AS w, count(*) OVER (PARTITION BY dst) AS n FROM (
    SELECT dst, unnest([
      {{'x': xp, 'w': coalesce((1-s)*(dst-x0)*(dst-x1)/((xp-x0)*(xp-x1)), 0)}},
      {{'x': x0, 'w': CASE WHEN xp IS NULL AND xn IS NULL THEN 1-f ELSE
         coalesce((1-s)*(dst-xp)*(dst-x1)/((x0-xp)*(x0-x1)), 0)
         + coalesce(s*(dst-x1)*(dst-xn)/((x0-x1)*(x0-xn)), 0) END}},
      {{'x': x1, 'w': CASE WHEN xp IS NULL AND xn IS NULL THEN f ELSE
         coalesce((1-s)*(dst-xp)*(dst-x0)/((x1-xp)*(x1-x0)), 0)
         + coalesce(s*(dst-x0)*(dst-xn)/((x1-x0)*(x1-xn)), 0) END}},
      {{'x': xn, 'w': coalesce(s*(dst-x0)*(dst-x1)/((xn-x0)*(xn-x1)), 0)}}]) AS n
    FROM (SELECT d.x AS dst, a.*, (d.x-a.x0)/(a.x1-a.x0) AS f,
                 CASE WHEN a.xn IS NULL THEN 0 WHEN a.xp IS NULL THEN 1
                      ELSE (d.x-a.x0)/(a.x1-a.x0) END AS s
          FROM (SELECT DISTINCT {column} AS x FROM {table}) d JOIN {axis_name} a
            ON d.x <= a.x1 AND (d.x > a.x0 OR (a.first AND d.x = a.x0))))
  WHERE n.x IS NOT NULL AND n.w <> 0)"""


def product(name: str, lat: str, lon: str, table: str) -> str:
    return f"""{name} AS (
  SELECT g.lat, g.lon, a.src AS slat, b.src % 360 AS slon, a.w*b.w AS w, a.n*b.n AS n
  FROM (SELECT DISTINCT lat, lon FROM {table}) g
  JOIN {lat} a ON a.dst = g.lat JOIN {lon} b ON b.dst = g.lon)"""


def bilinear(src: str = "src", dst: str = "tgt", name: str = "w", grid: str | None = None) -> str:
    grid = grid or dst
    return ",\n".join(
        [
            axis(f"{name}_alat", src, "lat"), axis(f"{name}_alon", src, "lon"),
            linear_nodes(f"{name}_lat", f"{name}_alat", grid, "lat"),
            linear_nodes(f"{name}_lon", f"{name}_alon", grid, "lon"),
            product(name, f"{name}_lat", f"{name}_lon", grid),
        ]
    )


def bilinear_periodic(name: str = "w") -> str:
    # every target longitude lies at or after the first source longitude here
    return ",\n".join(
        [
            axis(f"{name}_alat", "src", "lat"), periodic_axis(f"{name}_alon", "src", "lon"),
            linear_nodes(f"{name}_lat", f"{name}_alat", "tgt", "lat"),
            linear_nodes(f"{name}_lon", f"{name}_alon", "tgt", "lon"),
            product(name, f"{name}_lat", f"{name}_lon", "tgt"),
        ]
    )


def patch(name: str = "w") -> str:
    return ",\n".join(
        [
            axis(f"{name}_alat", "src", "lat"), axis(f"{name}_alon", "src", "lon"),
            patch_nodes(f"{name}_lat", f"{name}_alat", "tgt", "lat"),
            patch_nodes(f"{name}_lon", f"{name}_alon", "tgt", "lon"),
            product(name, f"{name}_lat", f"{name}_lon", "tgt"),
        ]
    )


def bounds(name: str, table: str, column: str) -> str:
    clamp = ("greatest({}, -90e0)", "least({}, 90e0)") if column == "lat" else ("{}", "{}")
    lo = clamp[0].format("x - (x - coalesce(p, 2*x - n))/2")
    hi = clamp[1].format("x + (coalesce(n, 2*x - p) - x)/2")
    return f"""{name} AS (
  SELECT x, {lo} AS lo, {hi} AS hi
  FROM (SELECT x, lag(x) OVER (ORDER BY x) AS p, lead(x) OVER (ORDER BY x) AS n
        FROM (SELECT DISTINCT {column} AS x FROM {table})))"""


def pieces(name: str, table: str) -> str:
    return f"""{name} AS (
  SELECT x, greatest(lo, 0e0) AS lo, least(hi, 360e0) AS hi FROM {table}
  UNION ALL SELECT x, lo + 360, 360e0 FROM {table} WHERE lo < 0
  UNION ALL SELECT x, 0e0, hi - 360 FROM {table} WHERE hi > 360)"""


def overlap_nodes(name: str, src: str, dst: str, measure: str) -> str:
    over = measure.format(lo="greatest(s.lo, d.lo)", hi="least(s.hi, d.hi)")
    own = measure.format(lo="lo", hi="hi")
    return f"""{name} AS (
  SELECT o.dst, o.src, o.part/a.total AS w, count(*) OVER (PARTITION BY o.dst) AS n
  FROM (SELECT d.x AS dst, s.x AS src, sum({over}) AS part FROM {src} s JOIN {dst} d
        ON s.lo < d.hi AND d.lo < s.hi GROUP BY ALL) o
  JOIN (SELECT x, sum({own}) AS total FROM {dst} GROUP BY x) a ON a.x = o.dst
  WHERE o.part > 0)"""


def conservative(name: str = "c") -> str:
    return ",\n".join(
        [
            bounds(f"{name}_slat", "src", "lat"), bounds(f"{name}_dlat", "tgt", "lat"),
            bounds(f"{name}_slon0", "src", "lon"), bounds(f"{name}_dlon0", "tgt", "lon"),
            pieces(f"{name}_slon", f"{name}_slon0"), pieces(f"{name}_dlon", f"{name}_dlon0"),
            overlap_nodes(
                f"{name}_lat", f"{name}_slat", f"{name}_dlat",
                "sin(radians({hi})) - sin(radians({lo}))",
            ),
            overlap_nodes(f"{name}_lon", f"{name}_slon", f"{name}_dlon", "{hi} - {lo}"),
            product(name, f"{name}_lat", f"{name}_lon", "tgt"),
        ]
    )


def nearest_cells(name: str, frm: str, to: str) -> str:
    """For every cell of ``frm`` the one of ``to`` at the smallest distance on the sphere."""
    return f"""{name} AS (
  SELECT lat, lon, near_lat, (x + 360) % 360 AS near_lon FROM (
    SELECT g.lat, g.lon, s.lat AS near_lat, s.x,
           row_number() OVER (PARTITION BY g.lat, g.lon ORDER BY
             round(pow(sin(radians(s.lat - g.lat)/2), 2)
                   + cos(radians(g.lat))*cos(radians(s.lat))*pow(sin(radians(s.x - g.lon)/2), 2), 12),
             s.lat, abs(g.lon - s.x), s.x) AS k
    FROM (SELECT DISTINCT lat, lon FROM {frm}) g,
         (SELECT lat, lon + unnest([-360, 0, 360]) AS x FROM (SELECT DISTINCT lat, lon FROM {to})) s)
  WHERE k = 1)"""


def nearest(name: str = "w") -> str:
    return nearest_cells(f"{name}_cells", "tgt", "src") + f""",
{name} AS (SELECT lat, lon, near_lat AS slat, near_lon AS slon, 1e0 AS w, 1 AS n FROM {name}_cells)"""


def nearest_reverse(name: str = "w") -> str:
    return nearest_cells(f"{name}_cells", "src", "tgt") + f""",
{name} AS (
  SELECT near_lat AS lat, near_lon AS lon, lat AS slat, lon AS slon, 1e0 AS w,
         count(*) OVER (PARTITION BY near_lat, near_lon) AS n
  FROM {name}_cells)"""


WEIGHTS_OUT = f"""SELECT lat, lon, slat AS src_lat, slon AS src_lon, {r('w', 'w', 9)},
  n::INTEGER AS n_src FROM w"""


def regridded(name: str, weights: str, values: list[str], src: str = "src", by: str = "time, lev_idx") -> str:
    sums = ", ".join(
        f"CASE WHEN count(s.{v}) = max(w.n) THEN sum(w.w*s.{v}) END AS {v}" for v in values
    )
    keys = ", ".join(f"s.{k.strip()}" for k in by.split(","))
    return f"""{name} AS (
  SELECT {keys}, w.lat, w.lon, {sums} FROM {src} s
  JOIN {weights} w ON w.slat = s.lat AND w.slon = s.lon GROUP BY {keys}, w.lat, w.lon)"""


def lines(
    name: str, profile: str, points: str, keys: list[str], x: str = "x", extrapolate: bool = False,
    bridge: bool = False,
) -> str:
    """Rows of ``points`` with the value on the line around ``x``."""
    known = " AND value IS NOT NULL" if bridge else ""
    k = ", ".join(keys)
    on = " AND ".join(f"s.{c} = p.{c}" for c in keys)
    above = "OR s.last" if extrapolate else ""
    return f"""{name}_seg AS (
  SELECT * FROM (
    SELECT {k}, z AS z0, value AS v0, lead(z) OVER o AS z1, lead(value) OVER o AS v1,
           row_number() OVER o = 1 AS first,
           row_number() OVER o = count(*) OVER (PARTITION BY {k}) - 1 AS last
    FROM {profile} WHERE z IS NOT NULL{known}
    WINDOW o AS (PARTITION BY {k} ORDER BY z, value))
  WHERE z1 IS NOT NULL),
{name} AS (
  SELECT p.*, s.v0 + (s.v1 - s.v0)*(p.{x} - s.z0)/nullif(s.z1 - s.z0, 0) AS line
  FROM {points} p LEFT JOIN {name}_seg s
    ON {on} AND (p.{x} > s.z0 OR s.first) AND (p.{x} <= s.z1 {above}))"""


COLUMN = ["time", "lat", "lon"]
# a correlation that does not exist (one pair, no spread) is NULL, not NaN
CORR = "nullif(corr(a.value, b.value), 'NaN'::DOUBLE)"
RG_Z = """prof AS (SELECT time, lev_idx, lat, lon, value, geopotential/9.80665e0 AS z FROM rg)"""

MODEL = """model AS (
  SELECT time, lev_idx, lat, lon, 100000e0 - 13000e0*lev_idx + value AS p, 200e0 + value AS ta,
         humidity AS hus FROM src)"""


def hypsometric(name: str, table: str, order: str, moist: bool) -> str:
    humid = "*(1 + 0.609133e0*(lag(hus) OVER o + hus)/2)" if moist else ""
    return f"""{name} AS (
  SELECT time, lev_idx, lat, lon, sum(dz) OVER (PARTITION BY time, lat, lon ORDER BY {order}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS zfull
  FROM (SELECT *, coalesce((287.05e0/9.80665e0)*((lag(ta) OVER o + ta)/2){humid}
                           *ln(lag(p) OVER o / p), 0) AS dz
        FROM {table} WINDOW o AS (PARTITION BY time, lat, lon ORDER BY {order})))"""


SIGMA_MODEL = """smodel AS (
  SELECT g.time, g.lev_idx, g.lat, g.lon, 230e0 + g.value AS ta, c.ap + c.b*ps.ps AS p
  FROM tgt g JOIN ps USING (time, lat, lon) JOIN coef c ON c.lev_idx = g.lev_idx)"""

# values missing at the bottom of some columns and inside all
HOLES = """holes AS (
  SELECT vec_id, lev_idx, z, CASE WHEN lev_idx % 9 <> 4 AND NOT (lev_idx = 0 AND vec_id % 3 = 0) THEN value END AS value
  FROM profiles)"""

STAGGERED = """zsrc AS (
  SELECT time, lev_idx, lat, lon, 9.80665e0*(500e0*lev_idx*lev_idx + qty*0.98765432101e0) AS geopotential
  FROM (SELECT make_timestamp(year(l_shipdate), month(l_shipdate), 1, 6*(month(l_shipdate)%4), 0, 0) AS time,
               l_linenumber AS lev_idx, -87.5e0 + 35*(l_suppkey%6) AS lat, 10.25e0 + 90*(l_partkey%4) AS lon,
               avg(l_quantity) AS qty
        FROM lineitem GROUP BY ALL))"""

FILLED = f"SELECT {t()}, lat, lon, lev_idx::INTEGER AS lev_idx, {r('coalesce(line, value)', 'value')} FROM li"

_GRID = "lat, lon"
_LEV = "lev_idx::INTEGER AS lev_idx"
_FIELD = f"{t()}, {_LEV}, {_GRID}, {r('value', 'value')}"

INSIDE = """inside AS (SELECT * FROM tgt WHERE lat BETWEEN -45 AND 45 AND lon BETWEEN 60 AND 270
  AND year(time) BETWEEN 1996 AND 2000)"""

ORACLE: dict[str, str] = {
    "clip_latitude": """SELECT o_orderkey, least(90e0, greatest(-90e0, -93e0 + 31*(o_custkey%7))) AS lat
  FROM orders""",
    "filter_bbox": with_(TGT)
    + f"SELECT {_FIELD} FROM tgt WHERE lat BETWEEN -45 AND 45 AND lon BETWEEN 60 AND 270",
    "filter_month": with_(TGT) + f"SELECT {_FIELD} FROM tgt WHERE year(time) = 1997 AND month(time) = 5",
    "filter_years": with_(TGT) + f"SELECT {_FIELD} FROM tgt WHERE year(time) BETWEEN 1996 AND 1998",
    "filter_synoptic": with_(SERIES)
    + f"SELECT {t()}, var, cell, {r('value', 'value')} FROM series WHERE hour(time) IN (0, 6, 12, 18)",
    "level_slice": with_(TGT)
    + f"""SELECT {_FIELD} FROM (
  SELECT *, row_number() OVER (PARTITION BY time, lat, lon ORDER BY lev_idx) AS k,
         count(*) OVER (PARTITION BY time, lat, lon) AS n FROM tgt) WHERE k > 1 AND k < n""",
    "first_slice": with_(TGT)
    + f"""SELECT {_FIELD} FROM tgt
  WHERE time = (SELECT min(time) FROM tgt)
    AND lev_idx = (SELECT min(lev_idx) FROM tgt WHERE time = (SELECT min(time) FROM tgt))""",
    "rename_vars": with_(TGT) + f"SELECT {t()}, {_LEV}, lat, lon, {r('value', 'hus')} FROM tgt",
    "map_variable": with_(SERIES)
    + f"""SELECT CASE var WHEN 'view' THEN 'hus' WHEN 'click' THEN 'ta' WHEN 'error' THEN 'ua'
  WHEN 'purchase' THEN 'va' WHEN 'signup' THEN 'tos' END AS var, count(*) AS n,
  {r('sum(value)', 'total', 3)} FROM series GROUP BY 1""",
    "regrid_method": """SELECT CASE event_type WHEN 'view' THEN 'q' WHEN 'click' THEN 't'
  WHEN 'error' THEN 'u' WHEN 'purchase' THEN 'v' WHEN 'signup' THEN 'sst' END AS var,
  CASE event_type WHEN 'view' THEN 'conservative' ELSE 'bilinear' END AS method, count(*) AS n
  FROM events GROUP BY ALL""",
    "standardize_coords": with_(TGT)
    + f"""SELECT {t()}, lev_idx::INTEGER AS level, lat, {r('value', 'value')}, lon AS longitude,
  lat + 1 AS latitude FROM tgt""",
    "standardize_dims": with_(TGT)
    + f"SELECT {t()}, (lev_idx*1000)::INTEGER AS lev, lat, lon, {r('value', 'value')} FROM tgt",
    "assign_levels": with_(TGT, SIGMA)
    + f"SELECT tgt.lev_idx::INTEGER AS lev_idx, {t()}, lat, lon, {r('value', 'value')}, ap AS lev FROM tgt LEFT JOIN coef ON coef.lev_idx = tgt.lev_idx",
    "scan_grid": with_(TGT) + "SELECT DISTINCT lat, lon FROM tgt",
    "axis_bounds": with_(SRC, bounds("a", "src", "lat"), bounds("b", "src", "lon"))
    + "SELECT x, lo, hi, 'lat' AS axis FROM a UNION ALL SELECT x, lo, hi, 'lon' AS axis FROM b",
    "combine_by_coords": with_(TGT) + f"SELECT {_FIELD} FROM tgt",
    "duplicate_coords": "SELECT event_type AS var, user_id%7 AS cell, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1",
    "align_exact": with_(SRC, SURFACE)
    + f"""SELECT {t('src.time')}, lat, lon, {_LEV}, {r('src.value', 'value')},
  {r('surface.value', 'surface')} FROM src JOIN surface USING (time, lat, lon)""".replace("src.time", "time"),
    "unmatched_coords": with_(SRC, TGT)
    + f"""SELECT {t()}, {_LEV}, CASE WHEN l.lev_idx IS NULL THEN 'right' ELSE 'left' END AS side
  FROM (SELECT DISTINCT time, lev_idx FROM src) l
  FULL JOIN (SELECT DISTINCT time, lev_idx FROM tgt) g USING (time, lev_idx)
  WHERE l.lev_idx IS NULL OR g.lev_idx IS NULL""",
    "missing_months": """SELECT y::INTEGER AS year, m::INTEGER AS month
  FROM range(1995, 2002) a(y), range(1, 13) b(m)
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE year(o_orderdate) = y AND month(o_orderdate) = m)""",
    "output_key": with_(TGT)
    + "SELECT 'ta_reanalysis_to_gcm_' || strftime(time, '%Y-%m') AS name, count(*) AS n FROM tgt GROUP BY 1",
    "fill_above_top": with_(TGT)
    + f"SELECT {t()}, {_LEV}, lat, lon, {r('CASE WHEN value < 8 THEN value ELSE value*100e0 END', 'value')} FROM tgt",
    "decode_time": f"""SELECT l_orderkey, {t("TIMESTAMP '1949-12-31 18:30:00' + to_hours(l_orderkey*7 + l_linenumber)")},
  CASE WHEN l_quantity <> 7 THEN l_quantity*0.25e0 - 3e0 END AS value FROM lineitem""",
    "decode_noleap": f"""SELECT o_orderkey, {t("make_timestamp(y, month(d), day(d), s//3600, (s//60)%60, s%60)")},
  y::INTEGER AS year, month(d)::INTEGER AS month, day(d)::INTEGER AS day, s::INTEGER AS second_of_day
  FROM (SELECT o_orderkey, 1850 + k//365 AS y, DATE '2001-01-01' + (k%365)::INTEGER AS d, s
    FROM (SELECT o_orderkey, q//86400 + 59 AS k, q%86400 AS s
      FROM (SELECT o_orderkey, (o_orderkey*0.25e0 + 0.5e0)*86400 AS f, round(f)::BIGINT AS q FROM orders)))""",
    "resample_6h_mean": with_(SERIES)
    + f"""SELECT {t("time_bucket(INTERVAL '6 hours', time)")}, var, cell, {r('avg(value)', 'value')}
  FROM series GROUP BY 1, 2, 3""",
    "resample_6h_mean_filled": with_(SERIES)
    + f"""SELECT {t('g.time')}, g.var, g.cell, {r('m.value', 'value')}
  FROM (SELECT var, cell, unnest(generate_series(
          (SELECT time_bucket(INTERVAL '6 hours', min(time)) FROM series),
          (SELECT time_bucket(INTERVAL '6 hours', max(time)) FROM series), INTERVAL '6 hours')) AS time
        FROM (SELECT DISTINCT var, cell FROM series)) g
  LEFT JOIN (SELECT time_bucket(INTERVAL '6 hours', time) AS time, var, cell, avg(value) AS value
             FROM series GROUP BY ALL) m
    ON m.time = g.time AND m.var = g.var AND m.cell = g.cell""",
    "weights_bilinear": with_(SRC, TGT, bilinear()) + WEIGHTS_OUT,
    "weights_bilinear_periodic": with_(SRC, TGT, bilinear_periodic()) + WEIGHTS_OUT,
    "weights_conservative": with_(SRC, TGT, conservative("w")) + WEIGHTS_OUT,
    "weights_nearest_s2d": with_(SRC, TGT, nearest()) + WEIGHTS_OUT,
    "weights_nearest_d2s": with_(SRC, TGT, nearest_reverse()) + WEIGHTS_OUT,
    "weights_patch": with_(SRC, TGT, patch()) + WEIGHTS_OUT,
    "regrid_bilinear": with_(SRC, TGT, bilinear(), regridded("rg", "w", ["value"]))
    + f"SELECT {_FIELD} FROM rg",
    "regrid_conservative": with_(SRC, TGT, conservative("w"), regridded("rg", "w", ["value"]))
    + f"SELECT {_FIELD} FROM rg",
    "regrid_nearest": with_(SRC, TGT, nearest(), regridded("rg", "w", ["value"]))
    + f"SELECT {_FIELD} FROM rg",
    "regrid_nearest_reverse": with_(SRC, TGT, nearest_reverse(), regridded("rg", "w", ["value"]))
    + f"SELECT {_FIELD} FROM rg",
    "regrid_patch": with_(SRC, TGT, patch(), regridded("rg", "w", ["value"]))
    + f"SELECT {_FIELD} FROM rg",
    "regrid_mixed_methods": with_(
        SRC, TGT, bilinear("src", "tgt", "b"), conservative("c"),
        regridded("rb", "b", ["value"]), regridded("rc", "c", ["humidity"]),
    )
    + f"""SELECT {t()}, {_LEV}, lat, lon, {r('humidity', 'humidity')}, {r('value', 'value')}
  FROM rb FULL JOIN rc USING (time, lev_idx, lat, lon)""",
    "regrid_null_guard": with_(
        SRC, TGT, bilinear(),
        "holes AS (SELECT time, lev_idx, lat, lon, CASE WHEN value < 14 THEN value END AS value FROM src)",
        regridded("rg", "w", ["value"], "holes"),
    )
    + f"SELECT {_FIELD} FROM rg",
    "regrid_wind_heights": with_(
        TGT, HEIGHTS, WIND, bilinear("tgt", "wind"),
        regridded("rg", "w", ["zfull"], "heights", "lev_idx"),
    )
    + f"SELECT {_LEV}, lat, lon, {r('zfull', 'zfull', 3)} FROM rg",
    "surface_job": with_(
        SURFACE, TGT, bilinear("surface", "tgt"),
        regridded("rg", "w", ["value"], "surface", "time"),
    )
    + f"""SELECT {t('s.time')}, g.lat, g.lon, {r('rg.value', 'value')}
  FROM (SELECT DISTINCT time FROM surface) s CROSS JOIN (SELECT DISTINCT lat, lon FROM tgt) g
  LEFT JOIN rg ON rg.time = s.time AND rg.lat = g.lat AND rg.lon = g.lon""",
    "geopotential_height": with_(SRC)
    + f"SELECT {t()}, {_LEV}, lat, lon, {r('geopotential/9.80665e0', 'z', 3)} FROM src",
    "hybrid_height": with_(PS, HYBRID)
    + f"""SELECT {t()}, lat, lon, {r('ps - 94900e0', 'orog', 3)}, {_LEV},
  {r('a + b*(ps - 94900e0)', 'zfull', 3)} FROM ps CROSS JOIN coef""",
    "pressure_levels": with_(PS, SIGMA)
    + f"SELECT {t()}, lat, lon, {r('ps', 'ps', 3)}, {_LEV}, {r('ap + b*ps', 'p', 3)} FROM ps CROSS JOIN coef",
    "hypsometric_height": with_(SRC, MODEL, hypsometric("h", "model", "lev_idx", False))
    + f"SELECT {t()}, {_LEV}, lat, lon, {r('zfull', 'zfull', 3)} FROM h",
    "hypsometric_height_moist": with_(SRC, MODEL, hypsometric("h", "model", "p DESC", True))
    + f"SELECT {t()}, {_LEV}, lat, lon, {r('zfull', 'zfull', 3)} FROM h",
    "adjust_edges": with_(
        SRC,
        """ranked AS (
  SELECT time, lat, lon, geopotential/9.80665e0 AS z,
         row_number() OVER o AS k, lag(geopotential/9.80665e0) OVER o AS below,
         lead(geopotential/9.80665e0) OVER o AS above,
         count(*) OVER (PARTITION BY time, lat, lon) AS n
  FROM src WINDOW o AS (PARTITION BY time, lat, lon ORDER BY lev_idx))""",
        """edges AS (
  SELECT time, lat, lon, k AS lev_idx, z FROM ranked
  UNION ALL SELECT time, lat, lon, 0, 2*z - above FROM ranked WHERE k = 1
  UNION ALL SELECT time, lat, lon, n + 1, 2*z - below FROM ranked WHERE k = n)""",
    )
    + f"SELECT {t()}, lat, lon, {_LEV}, {r('z', 'z', 3)} FROM edges",
    "target_heights_static": with_(HEIGHTS) + f"SELECT {_LEV}, lat, lon, {r('zfull', 'zfull', 3)} FROM heights",
    "target_heights_sigma": with_(TGT, PS, SIGMA, SIGMA_MODEL, hypsometric("h", "smodel", "lev_idx", False))
    + f"SELECT {t()}, {_LEV}, lat, lon, {r('zfull', 'zfull', 3)} FROM h",
    "vertical_interp": with_(PROFILES, POINTS, lines("li", "profiles", "points", ["vec_id"]))
    + f"SELECT vec_id, {_LEV}, {r('x', 'x')}, {r('line', 'value')} FROM li",
    "vertical_interp_extrapolate": with_(
        PROFILES, POINTS, lines("li", "profiles", "points", ["vec_id"], extrapolate=True)
    )
    + f"SELECT vec_id, {_LEV}, {r('x', 'x')}, {r('line', 'value')} FROM li",
    "vertical_interp_missing": with_(
        PROFILES, POINTS, HOLES, lines("li", "holes", "points", ["vec_id"])
    )
    + f"SELECT vec_id, {_LEV}, {r('x', 'x')}, {r('line', 'value')} FROM li",
    "vertical_interp_bridged": with_(
        PROFILES, POINTS, HOLES, lines("li", "holes", "points", ["vec_id"], bridge=True)
    )
    + f"SELECT vec_id, {_LEV}, {r('x', 'x')}, {r('line', 'value')} FROM li",
    "vertical_interp_static": with_(
        SRC, TGT, HEIGHTS, bilinear(), regridded("rg", "w", ["value", "geopotential"]), RG_Z,
        """wanted AS (
  SELECT c.time, h.* FROM (SELECT DISTINCT time, lat, lon FROM prof WHERE z IS NOT NULL) c
  JOIN heights h USING (lat, lon))""",
        lines("li", "prof", "wanted", COLUMN, "zfull"),
    )
    + f"SELECT {t()}, {_LEV}, lat, lon, {r('line', 'value')} FROM li",
    "to_profiles": f"""SELECT vec_id, label, lev_idx, {r('e', 'value')} FROM (
  SELECT vec_id, label, unnest(range(0, len(embedding)))::INTEGER AS lev_idx,
         unnest(embedding)::DOUBLE AS e FROM embeddings)""",
    "apply_profile": with_(PROFILES)
    + f"""SELECT vec_id, {r('sum((v1 + value)/2*(z1 - z))/(max(z1) - min_by(z, lev_idx))', 'mean')}
  FROM (SELECT *, lead(z) OVER o AS z1, lead(value) OVER o AS v1 FROM profiles
        WINDOW o AS (PARTITION BY vec_id ORDER BY lev_idx)) GROUP BY vec_id""".replace(
        "max(z1)", "max_by(z, lev_idx)"
    ),
    "interp3d_v1": with_(
        SRC, TGT, HEIGHTS,
        """means AS (
  SELECT time_bucket(INTERVAL '6 hours', time) AS time, lev_idx, lat, lon, avg(value) AS value,
         avg(geopotential) AS geopotential FROM src GROUP BY ALL)""",
        bilinear(), regridded("rg", "w", ["value", "geopotential"], "means"), RG_Z,
        """wanted AS (
  SELECT m.time, h.* FROM (SELECT DISTINCT time FROM means) m CROSS JOIN heights h)""",
        lines("li", "prof", "wanted", COLUMN, "zfull", extrapolate=True),
    )
    + f"SELECT {t()}, {_LEV}, lat, lon, {r('line', 'value')} FROM li",
    "interp3d_v2": with_(
        SRC, TGT, HEIGHTS,
        INSIDE,
        """synoptic AS (SELECT * FROM src WHERE hour(time) IN (0, 6, 12, 18)
  AND year(time) BETWEEN 1996 AND 2000)""",
        bilinear("src", "tgt", "w", "inside"),
        regridded("rg", "w", ["value", "geopotential"], "synoptic"), RG_Z,
        """wanted AS (SELECT g.*, h.zfull FROM inside g LEFT JOIN heights h USING (lev_idx, lat, lon))""",
        lines("li", "prof", "wanted", COLUMN, "zfull"),
    )
    + FILLED,
    "interp3d_v2_staggered": with_(
        SRC, STAGGERED, TGT, HEIGHTS, INSIDE,
        "synoptic AS (SELECT * FROM src WHERE year(time) BETWEEN 1996 AND 2000)",
        "zsyn AS (SELECT * FROM zsrc WHERE year(time) BETWEEN 1996 AND 2000)",
        bilinear("src", "tgt", "w", "inside"), bilinear("zsrc", "tgt", "wz", "inside"),
        regridded("rv", "w", ["value"], "synoptic"), regridded("rz", "wz", ["geopotential"], "zsyn"),
        """prof AS (SELECT time, lev_idx, lat, lon, value, geopotential/9.80665e0 AS z
  FROM rv FULL JOIN rz USING (time, lev_idx, lat, lon))""",
        """wanted AS (SELECT g.*, h.zfull FROM inside g LEFT JOIN heights h USING (lev_idx, lat, lon))""",
        lines("li", "prof", "wanted", COLUMN, "zfull"),
    )
    + FILLED,
    "interp3d_v2_humidity": with_(
        SRC, TGT, HEIGHTS,
        "synoptic AS (SELECT *, humidity*1000 AS hum FROM src WHERE hour(time) IN (0, 6, 12, 18))",
        bilinear("src", "tgt", "b"), conservative("c"),
        regridded("rb", "b", ["geopotential"], "synoptic"), regridded("rc", "c", ["hum"], "synoptic"),
        """prof AS (SELECT time, lev_idx, lat, lon, hum AS value, geopotential/9.80665e0 AS z
  FROM rb JOIN rc USING (time, lev_idx, lat, lon))""",
        """wanted AS (SELECT g.*, h.zfull FROM tgt g LEFT JOIN heights h USING (lev_idx, lat, lon))""",
        lines("li", "prof", "wanted", COLUMN, "zfull"),
    )
    + FILLED,
    "interp3d_v2_sigma": with_(
        SRC, TGT, PS, SIGMA, SIGMA_MODEL, hypsometric("h", "smodel", "lev_idx", False),
        "synoptic AS (SELECT * FROM src WHERE hour(time) IN (0, 6, 12, 18))",
        bilinear(), regridded("rg", "w", ["value", "geopotential"], "synoptic"), RG_Z,
        """wanted AS (SELECT g.*, h.zfull FROM tgt g LEFT JOIN h USING (time, lev_idx, lat, lon))""",
        lines("li", "prof", "wanted", COLUMN, "zfull"),
    )
    + FILLED,
    "climatology": with_(SERIES)
    + f"""SELECT var, cell, month(time)::INTEGER AS month, hour(time)::INTEGER AS hour,
  {r('avg(value)', 'mean')}, {r('stddev_samp(value)', 'std')}, count(value) AS n
  FROM series GROUP BY 1, 2, 3, 4""",
    "lag1_autocorr": with_(STATIONS, SIX)
    + f"""SELECT a.var, a.cell, {r(CORR, 'lag1')}, count(*) AS n
  FROM six a JOIN six b ON a.var = b.var AND a.cell = b.cell AND a.time = b.time + INTERVAL '6 hours'
  GROUP BY 1, 2""",
    "cross_corr": with_(STATIONS, SIX)
    + f"""SELECT a.cell, a.var AS a, b.var AS b, {r(CORR, 'correlation')}, count(*) AS n
  FROM six a JOIN six b ON a.cell = b.cell AND a.time = b.time AND a.var < b.var GROUP BY 1, 2, 3""",
    "mean_abs_bias": with_(STATIONS, SIX)
    + f"""SELECT a.cell, a.var AS a, b.var AS b, {r('avg(abs(a.value - b.value))', 'bias')}, count(*) AS n
  FROM six a JOIN six b ON a.cell = b.cell AND a.time = b.time AND a.var < b.var GROUP BY 1, 2, 3""",
    "subdaily_histogram": with_(SERIES)
    + """SELECT var, hour(time)::INTEGER AS hour, floor(value/0.25e0)*0.25e0 AS low, count(*) AS n
  FROM series GROUP BY 1, 2, 3""",
    "subdaily_quantiles": with_(SERIES)
    + f"""SELECT var, hour, p, {r('q', 'quantile')} FROM (
  SELECT var, hour(time)::INTEGER AS hour, unnest([0.1e0, 0.5e0, 0.9e0, 0.99e0]) AS p,
         unnest(quantile_cont(value, [0.1, 0.5, 0.9, 0.99])) AS q FROM series GROUP BY 1, 2)""",
    "drop_spin_up": with_(TGT)
    + f"SELECT {_FIELD} FROM tgt WHERE time >= (SELECT min(time) FROM tgt) + INTERVAL 1 YEAR",
    "short_records": """SELECT o_custkey AS cell, count(DISTINCT year(o_orderdate)) AS years
  FROM orders GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) < 7""",
    "moment_correction": with_(STATIONS, """next_type(var, observed) AS (VALUES ('click', 'error'),
  ('error', 'purchase'), ('purchase', 'signup'), ('signup', 'view'), ('view', 'click'))""",
        """spread AS (SELECT var, cell, month(time) AS mo, hour(time) AS h, avg(value) AS m, stddev_samp(value) AS s
  FROM stations GROUP BY ALL)""")
    + f"""SELECT {t('s.time')}, s.var, s.cell, {r('s.value', 'value')},
  {r('(s.value - m.m)*coalesce(o.s/nullif(m.s, 0), 1) + o.m', 'corrected')}
  FROM stations s JOIN next_type USING (var)
  LEFT JOIN spread m ON m.var = s.var AND m.cell = s.cell AND m.mo = month(s.time) AND m.h = hour(s.time)
  LEFT JOIN spread o ON o.var = observed AND o.cell = s.cell AND o.mo = month(s.time) AND o.h = hour(s.time)""",
}
# heights joined from a table or computed on the way give the same result
ORACLE["interp3d_v2_stored_heights"] = ORACLE["interp3d_v2_sigma"]
ORACLE["discover_months"] = ORACLE["missing_months"]
ORACLE["stored_weights"] = ORACLE["weights_bilinear"]
ORACLE["store_and_scan"] = with_(TGT) + f"""SELECT {_FIELD}, 'ta' AS var,
  year(time)::INTEGER AS year, month(time)::INTEGER AS month
  FROM tgt WHERE year(time) BETWEEN 1996 AND 1997 AND month(time) IN (1, 2, 6)"""
ORACLE["catalogue_cells"] = ORACLE["scan_grid"]
ORACLE["catalogue_times"] = with_(TGT) + f"SELECT DISTINCT {t()} FROM tgt"
ORACLE["stored_order"] = with_(TGT) + """SELECT 'ta' AS var, year(time)::INTEGER AS year,
  month(time)::INTEGER AS month, count(*) AS n, 0::BIGINT AS misplaced FROM tgt GROUP BY ALL"""
ORACLE["scan_synoptic"] = with_(SERIES) + f"""SELECT {t()}, cell::DOUBLE AS lon, {r('value', 'value')}
  FROM series WHERE hour(time) IN (0, 6, 12, 18)"""
ORACLE["stored_job"] = ORACLE["interp3d_v2"].replace(
    "lev_idx::INTEGER AS lev_idx,", "lev_idx::INTEGER AS lev_idx, lev_idx*10e0 AS lev,"
)
ORACLE["scan_static"] = with_(HEIGHTS) + f"SELECT {_LEV}, lat, lon, {r('zfull', 'value')} FROM heights"
ORACLE["reformat"] = with_(TGT) + f"""SELECT {_FIELD}, 'ta' AS var,
  year(time)::INTEGER AS year, month(time)::INTEGER AS month FROM tgt"""
ORACLE["attrs"] = """SELECT key, value, 'hus' AS var
  FROM (VALUES ('units', '1'), ('interpolation_to', 'gcm')) a(key, value) WHERE (SELECT count(*) FROM orders) > 0"""


def _stored(field: str, weights: str, value: str, digits: int) -> str:
    """The stored job: a field and the geopotential, each from its own grid and with its method."""
    return with_(
        SRC, STAGGERED, TGT, HEIGHTS, INSIDE, field, weights, bilinear("zsrc", "tgt", "wz", "inside"),
        "fin AS (SELECT * FROM fld WHERE year(time) BETWEEN 1996 AND 2000)",
        "zsyn AS (SELECT * FROM zsrc WHERE year(time) BETWEEN 1996 AND 2000)",
        regridded("rv", "w", [value], "fin"), regridded("rz", "wz", ["geopotential"], "zsyn"),
        f"""prof AS (SELECT time, lev_idx, lat, lon, {value} AS value, geopotential/9.80665e0 AS z
  FROM rv FULL JOIN rz USING (time, lev_idx, lat, lon))""",
        """wanted AS (SELECT g.*, h.zfull FROM inside g LEFT JOIN heights h USING (lev_idx, lat, lon))""",
        lines("li", "prof", "wanted", COLUMN, "zfull"),
    ) + f"""SELECT {t()}, lat, lon, lev_idx::INTEGER AS lev_idx, lev_idx*10e0 AS lev,
  {r('coalesce(line, value)', 'value', digits)} FROM li"""


ORACLE["stored_job_wind"] = _stored(
    "fld AS (SELECT * REPLACE (lon + 15e0 AS lon) FROM src)", bilinear("fld", "tgt", "w", "inside"), "value", 6
)
ORACLE["stored_job_humidity"] = _stored(
    "fld AS (SELECT * FROM src)", conservative("w"), "humidity", 8
)
ORACLE["stored_job_all"] = " UNION ALL ".join(
    f"SELECT *, '{var}' AS var FROM ({sql})"
    for var, sql in (
        ("ta", _stored("fld AS (SELECT * FROM src)", bilinear("fld", "tgt", "w", "inside"), "value", 6)),
        ("hus", ORACLE["stored_job_humidity"]),
    )
)
ORACLE["stored_job_sigma"] = f"""SELECT * FROM ({ORACLE["interp3d_v2_sigma"]})
  WHERE time >= '1996' AND time < '2001'"""


def _first_version(value: str, digits: int) -> str:
    """The first version over the stored years, of one column of the source."""
    return with_(
        SRC, TGT, HEIGHTS,
        f"""means AS (
  SELECT time_bucket(INTERVAL '6 hours', time) AS time, lev_idx, lat, lon, avg({value}) AS value,
         avg(geopotential) AS geopotential FROM src WHERE year(time) BETWEEN 1996 AND 2000 GROUP BY ALL)""",
        bilinear(), regridded("rg", "w", ["value", "geopotential"], "means"), RG_Z,
        """wanted AS (
  SELECT m.time, h.* FROM (SELECT DISTINCT time FROM means) m CROSS JOIN heights h)""",
        lines("li", "prof", "wanted", COLUMN, "zfull", extrapolate=True),
    ) + f"SELECT {t()}, {_LEV}, lat, lon, {r('line', 'value', digits)} FROM li"


ORACLE["stored_job_v1"] = " UNION ALL ".join(
    f"SELECT *, '{var}' AS var FROM ({_first_version(value, digits)})"
    for var, value, digits in (("ta", "value", 6), ("hus", "humidity", 8))
)
