"""Plain-Python Vincenty inverse, iterated to convergence; test oracle only."""

import math

from blotter.functions.geodesic import WGS84_A, WGS84_B, WGS84_F


def vincenty_reference_km(lat1: float, lon1: float, lat2: float, lon2: float,
                          iterations: int = 200) -> float:
    """Plain-Python Vincenty inverse for tests (iterated to convergence)."""
    f, a, b = WGS84_F, WGS84_A, WGS84_B
    L = math.radians(lon2 - lon1)
    u1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    u2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    su1, cu1, su2, cu2 = math.sin(u1), math.cos(u1), math.sin(u2), math.cos(u2)
    lam = L
    for _ in range(iterations):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
        if ss == 0:
            return 0.0
        cs = su1 * su2 + cu1 * cu2 * cl
        sig = math.atan2(ss, cs)
        sa = cu1 * cu2 * sl / ss
        c2a = 1 - sa * sa
        c2sm = cs - 2 * su1 * su2 / c2a if c2a else 0.0
        cc = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        prev = lam
        lam = L + (1 - cc) * f * sa * (sig + cc * ss * (c2sm + cc * cs * (-1 + 2 * c2sm * c2sm)))
        if abs(lam - prev) < 1e-13:
            break
    u2sq = c2a * (a * a - b * b) / (b * b)
    A = 1 + u2sq / 16384 * (4096 + u2sq * (-768 + u2sq * (320 - 175 * u2sq)))
    B = u2sq / 1024 * (256 + u2sq * (-128 + u2sq * (74 - 47 * u2sq)))
    dsig = B * ss * (c2sm + B / 4 * (cs * (-1 + 2 * c2sm * c2sm) - B / 6 * c2sm * (-3 + 4 * ss * ss) * (-3 + 4 * c2sm * c2sm)))
    return b * A * (sig - dsig) / 1000.0
