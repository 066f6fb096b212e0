"""Map projections, areas and containment in closed form, as Column functions.

Rings are array<struct<x: double, y: double>>, closed or not; a polygon is its outer ring.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The GRS80 ellipsoid, the scale and false easting of UTM, and zone 32's meridian.
_A, _FLAT, _K0, _EAST, _MERIDIAN = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0, 9.0
_N = _FLAT / (2 - _FLAT)
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
]
_E = 2 * math.sqrt(_N) / (1 + _N)


def utm(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in zone 32 by Krüger's series to the third order."""
    phi, lam = F.radians(lat), F.radians(lon - F.lit(_MERIDIAN))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(_E) * F.atanh(F.lit(_E) * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(_EAST) + F.lit(_K0 * _RECT) * x, F.lit(_K0 * _RECT) * y


def utm_sql(lon: str, lat: str) -> tuple[str, str]:
    """The same series as SQL text."""
    phi, lam = f"radians({lat})", f"radians(({lon}) - {_MERIDIAN!r}::DOUBLE)"
    e = f"{_E!r}::DOUBLE"
    t = f"sinh(atanh(sin({phi})) - {e} * atanh({e} * sin({phi})))"
    xi, eta = f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x += f" + {a!r}::DOUBLE * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})"
        y += f" + {a!r}::DOUBLE * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})"
    return f"({_EAST!r}::DOUBLE + {_K0 * _RECT!r}::DOUBLE * ({x}))", f"({_K0 * _RECT!r}::DOUBLE * ({y}))"


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.lit(_A) * F.radians(lon), F.lit(_A) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def ring_area(ring: Column) -> Column:
    """Area of a ring in the square of its unit, by the shoelace formula."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    parts = F.zip_with(ring, nxt, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)) / 2


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies within a ring: a ray to the right crosses it an odd number of times."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    cross = F.zip_with(
        ring, nxt,
        lambda a, b: ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]),
    )
    return F.size(F.filter(cross, lambda c: c)) % 2 == 1


def metres_to_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Metres from a point to a ring in degrees, on a plane that touches the globe at the point; 0 within it."""
    east, north = F.cos(F.radians(lat)) * F.lit(111_320.0), F.lit(110_540.0)
    flat = F.transform(ring, lambda p: F.struct(((p["x"] - lon) * east).alias("x"), ((p["y"] - lat) * north).alias("y")))
    nxt = F.concat(F.slice(flat, 2, F.size(flat)), F.slice(flat, 1, 1))

    def reach(a: Column, b: Column) -> Column:
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        size = dx * dx + dy * dy
        t = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(a["x"] * dx + a["y"] * dy) / size))).otherwise(0.0)
        x, y = a["x"] + t * dx, a["y"] + t * dy
        return F.sqrt(x * x + y * y)

    return F.when(in_ring(lon, lat, ring), 0.0).otherwise(F.array_min(F.zip_with(flat, nxt, reach)))
