"""Map projections as NumPy closed forms on GRS80: Albers (Snyder 1987, USGS Professional Paper
1395) and transverse Mercator."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# GRS80 ellipsoid.
A = 6378137.0
F = 1 / 298.257222101
E2 = F * (2 - F)
E1 = E2**0.5

# EPSG:5070 (Albers equal area, CONUS) and EPSG:2193 (transverse Mercator, New Zealand).
ALBERS = {"lat0": 23.0, "lon0": -96.0, "lat1": 29.5, "lat2": 45.5}
NZTM = {"lon0": 173.0, "scale": 0.9996, "east": 1_600_000.0, "north": 10_000_000.0}


def _q(sin_lat):
    return (1 - E2) * (sin_lat / (1 - E2 * sin_lat**2) - np.log((1 - E1 * sin_lat) / (1 + E1 * sin_lat)) / (2 * E1))


def _m(lat):
    return np.cos(lat) / np.sqrt(1 - E2 * np.sin(lat) ** 2)


_LAT1, _LAT2, _LAT0, _LON0 = (np.radians(ALBERS[k]) for k in ("lat1", "lat2", "lat0", "lon0"))
_N = (_m(_LAT1) ** 2 - _m(_LAT2) ** 2) / (_q(np.sin(_LAT2)) - _q(np.sin(_LAT1)))
_C = _m(_LAT1) ** 2 + _N * _q(np.sin(_LAT1))
_RHO0 = A * np.sqrt(_C - _N * _q(np.sin(_LAT0))) / _N
_Q_POLE = _q(1.0)


def albers_forward(lon, lat):
    rho = A * np.sqrt(_C - _N * _q(np.sin(np.radians(lat)))) / _N
    theta = _N * (np.radians(lon) - _LON0)
    return rho * np.sin(theta), _RHO0 - rho * np.cos(theta)


def albers_inverse(x, y):
    rho = np.hypot(x, _RHO0 - y)
    theta = np.arctan2(x, _RHO0 - y)
    q = (_C - (rho * _N / A) ** 2) / _N
    beta = np.arcsin(np.clip(q / _Q_POLE, -1, 1))
    # series from the authalic latitude, polished by Newton steps on q
    lat = beta + E2 / 3 * np.sin(2 * beta)
    for _ in range(6):
        sin_lat = np.sin(lat)
        w = 1 - E2 * sin_lat**2
        step = w**2 / (2 * np.maximum(np.cos(lat), 1e-12)) * (
            q / (1 - E2) - sin_lat / w + np.log((1 - E1 * sin_lat) / (1 + E1 * sin_lat)) / (2 * E1)
        )
        lat = lat + step
    return np.degrees(theta / _N + _LON0), np.degrees(lat)


# Transverse Mercator by the Krueger series in the third flattening (Karney 2011, to order n^4).
_T = F / (2 - F)
_RADIUS = A / (1 + _T) * (1 + _T**2 / 4 + _T**4 / 64)
# Series coefficients to and from the conformal sphere.
_TO = (
    _T / 2 - 2 * _T**2 / 3 + 5 * _T**3 / 16 + 41 * _T**4 / 180,
    13 * _T**2 / 48 - 3 * _T**3 / 5 + 557 * _T**4 / 1440,
    61 * _T**3 / 240 - 103 * _T**4 / 140,
    49561 * _T**4 / 161280,
)
_FROM = (
    _T / 2 - 2 * _T**2 / 3 + 37 * _T**3 / 96 - _T**4 / 360,
    _T**2 / 48 + _T**3 / 15 - 437 * _T**4 / 1440,
    17 * _T**3 / 480 - 37 * _T**4 / 840,
    4397 * _T**4 / 161280,
)


def _series(coefficients, xi, eta):
    along = sum(c * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, c in enumerate(coefficients, 1))
    across = sum(c * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, c in enumerate(coefficients, 1))
    return along, across


def _conformal(tau):
    """Tangent of the conformal latitude from that of the latitude."""
    root = np.sqrt(1 + tau**2)
    sigma = np.sinh(E1 * np.arctanh(E1 * tau / root))
    return tau * np.sqrt(1 + sigma**2) - sigma * root


def nztm_forward(lon, lat):
    turn = np.radians(np.asarray(lon) - NZTM["lon0"])
    t = _conformal(np.tan(np.radians(lat)))
    xi, eta = np.arctan2(t, np.cos(turn)), np.arcsinh(np.sin(turn) / np.hypot(t, np.cos(turn)))
    along, across = _series(_TO, xi, eta)
    scale = NZTM["scale"] * _RADIUS
    return NZTM["east"] + scale * (eta + across), NZTM["north"] + scale * (xi + along)


def nztm_inverse(x, y):
    scale = NZTM["scale"] * _RADIUS
    xi, eta = (np.asarray(y) - NZTM["north"]) / scale, (np.asarray(x) - NZTM["east"]) / scale
    along, across = _series(_FROM, xi, eta)
    xi, eta = xi - along, eta - across
    t = np.sin(xi) / np.hypot(np.sinh(eta), np.cos(xi))
    tau = t / (1 - E2)
    for _ in range(6):
        now = _conformal(tau)
        slope = (1 - E2) * np.sqrt(1 + now**2) * np.sqrt(1 + tau**2) / (1 + (1 - E2) * tau**2)
        tau = tau + (t - now) / slope
    return NZTM["lon0"] + np.degrees(np.arctan2(np.sinh(eta), np.cos(xi))), np.degrees(np.arctan(tau))


TRANSFORMS: dict[tuple[int, int], Callable] = {
    (4326, 5070): albers_forward,
    (5070, 4326): albers_inverse,
    (4326, 2193): nztm_forward,
    (2193, 4326): nztm_inverse,
}


def transform(src: int, dst: int) -> Callable:
    """Coordinate function between two supported systems; datum shifts are not applied."""
    if src == dst:
        return lambda x, y: (x, y)
    if (src, dst) in TRANSFORMS:
        return TRANSFORMS[src, dst]
    if (src, 4326) in TRANSFORMS and (4326, dst) in TRANSFORMS:
        to_geographic, onward = TRANSFORMS[src, 4326], TRANSFORMS[4326, dst]
        return lambda x, y: onward(*to_geographic(x, y))
    raise ValueError(f"no transformation from EPSG:{src} to EPSG:{dst}")
