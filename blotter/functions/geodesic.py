"""Distances between points given as latitude/longitude in degrees.

``with_geodesic_km`` is the default: the ellipsoidal (WGS-84) distance by
Vincenty's series, written as plain column arithmetic so it runs in the JVM
inside whole-stage code generation -- no Python worker, no higher-order
function, no branch of its own for hard pairs.

The unknown is ``x``, how far the points are from being half round the auxiliary
sphere. Vincenty's fixed point swings near antipodal points, where the
correction to ``x`` changes as fast as ``x`` itself; there it is nearly
``K x / sqrt(x^2 + d^2)``, so a first ``x`` follows in closed form from a quartic
(the astroid problem of Karney, Algorithms for geodesics, 2013), exact enough
for every pair. Each step is then Vincenty's, divided by the slope of that
curve: four of them leave at most 10 micrometres for any two points of the globe
(measured against 120 halvings of the bracketed root), five 0.1 micrometres.

``haversine_km`` (native column) and ``make_distance_udf`` (Arrow-native UDF for a
caller's own vectorised solver) cover the UDF surface.
"""

from __future__ import annotations

import math
import re
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.columns import ColumnLike, as_col
from blotter.functions.parsing import finite

# WGS-84 ellipsoid.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = (1 - WGS84_F) * WGS84_A
# Fixed value: mean Earth radius (km) for the spherical formula.
EARTH_RADIUS_KM = 6371.0088

DEFAULT_ITERATIONS = 4

_P = "__geo_"  # prefix of temporary columns


def _d(x: float) -> str:
    """A double literal in Spark SQL text."""
    return f"{x!r}D"


_CONSTANTS = {"F": WGS84_F, "PI": math.pi, "THIRD": 1 / 3, "SIXTH": 1 / 6, "SHORT10": 2.0 ** -10, "SHORT14": 2.0 ** -14}


def _sql(text: str) -> str:
    """SQL text over temporary columns written as ``:name``; capital words stand for constants."""
    text = re.sub(r":(\w+)", rf"`{_P}\1`", text)
    return re.sub(r"\b(F|PI|THIRD|SIXTH|SHORT10|SHORT14)\b", lambda m: _d(_CONSTANTS[m[0]]), text)


def _over(a: str, b: str) -> str:
    return f"coalesce(try_divide({a}, {b}), 0D)"


# Every dict is one projection over the temporary columns so far. A term repeated
# inside one projection is computed once (common-subexpression elimination), except
# in the branches of a condition, which is why divisions are guarded with
# try_divide/coalesce and cases are weighted by 0 and 1; the projection boundaries keep each expression small. No
# column is nullable (a division always is, so constants divide by a product): code
# without null checks keeps the whole chain in one generated method.
_START = [
    {"su1": "sin(:u1)", "cu1": "cos(:u1)", "su2": "sin(:u2)", "cu2": "cos(:u2)", "s12": "sin(:u1 + :u2)"},
    # the quartic (k^2 - q^2) (k + 1)^2 = p^2 k^2, by its resolvent cubic
    {"k0": "F * PI * :cu1", "d2": f"pow({_over(':s12', ':cu2')}, 2D)",
     "p2": f"pow({_over(':gap', 'F * PI * :cu1')}, 2D)", "q2": f"pow({_over(':s12', ':cu2 * F * PI * :cu1')}, 2D)"},
    {"r": "(:p2 + :q2 - 1D) * SIXTH", "s": ":p2 * :q2 * 0.25D"},
    {"sr": ":s + :r * :r * :r", "disc": ":s * (:s + 2D * :r * :r * :r)"},
    {"t": "cbrt(:sr + if(:sr < 0D, -1D, 1D) * sqrt(greatest(:disc, 0D)))"},
    {"w": f"if(:disc >= 0D, :r + :t + {_over(':r * :r', ':t')},"
          " :r + 2D * :r * cos(atan2(sqrt(greatest(-:disc, 0D)), -:sr) * THIRD))"},
    {"v": "sqrt(:w * :w + :q2)"},
    {"uv": f"if(:w < 0D, {_over(':q2', ':v - :w')}, :w + :v)"},
    {"h": _over(":uv - :q2", "2D * :v")},
    # not live: opposite reduced latitudes and a root at 0, where the azimuth is free and its sine fs
    # follows from the equation itself
    {"live": "if(:q2 = 0D AND :r <= 0D, 0D, 1D)", "k": _over(":uv", "sqrt(:uv + :h * :h) + :h"), "fs": _over(":gap", "F * PI")},
    {"x": f":live * greatest(0D, :gap - :k0 * least(1D, {_over('sqrt(:p2)', '1D + :k')}))"},
]

_STEP_SIGMA = {
    "sx": "sin(:x)",
    "ss": "sqrt((:cu2 * sin(:x)) * (:cu2 * sin(:x)) + (:s12 - 2D * :su1 * :cu2 * sin(0.5D * :x) * sin(0.5D * :x))"
          " * (:s12 - 2D * :su1 * :cu2 * sin(0.5D * :x) * sin(0.5D * :x)))",
    "cs": ":su1 * :su2 - :cu1 * :cu2 * cos(:x)",
}
_SA = f"(:live * {_over(':cu1 * :cu2 * :sx', ':ss')} + (1D - :live) * :fs)"
_ANGLES = {"sig": "atan2(:ss, :cs)", "sa": _SA, "c2a": f"(1D - {_SA} * {_SA})"}
_C2SM = "(:cs - coalesce(try_divide(2D * :su1 * :su2, :c2a), :cs))"
_CC = "(0.0625D * F * :c2a * (4D + F * (4D - 3D * :c2a)))"
_CORRECTION = (f"((1D - {_CC}) * F * :sa * (:sig + {_CC} * :ss * ({_C2SM} + {_CC} * :cs * (-1D + 2D * {_C2SM} * {_C2SM}))))")
_SLOPE = f"(1D + {_over(f'{_CORRECTION} * :d2', ':x * (:x * :x + :d2)')})"
_U2SQ = f"(:c2a * {_d((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)})"
_BIG_A = f"(1D + {_U2SQ} * SHORT14 * (4096D + {_U2SQ} * (-768D + {_U2SQ} * (320D - 175D * {_U2SQ}))))"
_BIG_B = f"({_U2SQ} * SHORT10 * (256D + {_U2SQ} * (-128D + {_U2SQ} * (74D - 47D * {_U2SQ}))))"
_DSIG = (f"({_BIG_B} * :ss * ({_C2SM} + {_BIG_B} * 0.25D * (:cs * (-1D + 2D * {_C2SM} * {_C2SM})"
         f" - {_BIG_B} * SIXTH * {_C2SM} * (-3D + 4D * :ss * :ss) * (-3D + 4D * {_C2SM} * {_C2SM}))))")


def _inline(text: str, terms: dict[str, str]) -> str:
    """Put the terms' own text in their place."""
    for name, term in terms.items():
        text = re.sub(rf":{name}\b", f"({term})", text)
    return text


_STEP_NEXT = {
    "x": _inline(f":live * greatest(0D, least(:gap, :x - {_over(f':x + {_CORRECTION} - :gap', _SLOPE)}))", _ANGLES),
    "fs": _inline(_over(":gap", f"F * PI * (1D - {_CC})"), {"c2a": "(1D - :fs * :fs)"}),
}
# factor: kilometres; 0 for points that are the same, whatever the rounding; null for unknown ones
_FINAL = {"dist": _inline(f":factor * {_BIG_A} * (:sig - {_DSIG})", _ANGLES)}


def with_geodesic_km(
    df: DataFrame,
    lat1: ColumnLike,
    lon1: ColumnLike,
    lat2: ColumnLike,
    lon2: ColumnLike,
    out: str = "distance_km",
    iterations: int = DEFAULT_ITERATIONS,
) -> DataFrame:
    """Add column ``out``: WGS-84 geodesic distance in kilometres.

    Null if and only if a coordinate is null, NaN or infinite. An existing column
    ``out`` is replaced; other columns are kept, whatever their names. The
    projection chain is issued as one nested SQL statement over ``df`` -- a
    single parse and analysis instead of one per step.
    """
    prefix = f"__geo_{uuid.uuid4().hex[:12]}_"  # fresh, so no caller column can have it
    keep = [c for c in df.columns if c != out]
    points = [finite(as_col(c).cast("double")) for c in (lat1, lon1, lat2, lon2)]
    la1, lo1, la2, lo2 = (F.coalesce(c, F.lit(0.0)) for c in points)
    turn = F.coalesce(F.pmod(F.radians(lo2) - F.radians(lo1) + F.lit(math.pi), F.lit(2 * math.pi)), F.lit(0.0)) - F.lit(math.pi)
    start = df.withColumns({
        prefix + "factor": F.when(reduce(and_, [c.isNotNull() for c in points]),
                                  F.when((la1 == la2) & (turn == 0), 0.0).otherwise(WGS84_B / 1000)),
        prefix + "gap": F.lit(math.pi) - F.abs(turn),
        prefix + "u1": F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(la1))),
        prefix + "u2": F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(la2))),
    })
    steps = [*_START, *[_STEP_SIGMA, _STEP_NEXT] * iterations, _STEP_SIGMA, _FINAL]
    uses = [set(re.findall(r":(\w+)", " ".join(step.values()))) for step in steps]
    temps = ["factor", "gap", "u1", "u2"]
    names = "".join(f"`{c.replace('`', '``')}`, " for c in keep)
    query = "{src}"
    for i, step in enumerate(steps):
        later = set().union(*uses[i + 1:])
        temps = [c for c in temps if c not in step and c in later]
        cols = [f"`{_P}{c}`" for c in temps] + [f"{_sql(expr)} AS `{_P}{name}`" for name, expr in step.items()]
        query = f"SELECT @kept {', '.join(cols)} FROM ({query})" if i else f"SELECT @kept {', '.join(cols)} FROM {query}"
        temps += list(step)
    query = query.replace(f"AS `{_P}dist`", f"AS `{out.replace('`', '``')}`")
    return df.sparkSession.sql(query.replace(_P, prefix).replace("@kept ", names), src=start)


def haversine_km(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance on a sphere, as one native expression."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dp = p2 - p1
    dl = F.radians(as_col(lon2)) - F.radians(as_col(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * radius_km) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def haversine_np(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM):
    """Vectorised spherical distance (numpy arrays in, array out)."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    dp = p2 - p1
    dl = np.radians(lon2) - np.radians(lon1)
    h = np.sin(dp / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(dl / 2) ** 2
    return 2 * radius_km * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def make_distance_udf(solver: Callable | None = None, setup: Callable[[], Callable] | None = None):
    """Wrap a vectorised ``solver(lat1, lon1, lat2, lon2) -> km`` as an Arrow UDF returning double.

    Use this only for a solver that has no column-expression form. Arrow arrays
    cross to Python and back once per batch; numpy sees their buffers without a pandas
    copy. A row with a null, NaN or infinite coordinate, or without a finite result, gives null. For a solver
    that is costly to make pass ``setup``, which returns it and is called once a task, not once a batch (the iterator form).
    The UDF is serialised by value (this module included), so executors need numpy and
    pyarrow but not this package on their path.
    """
    if (solver is None) == (setup is None):
        raise ValueError("pass solver or setup")

    if setup is None:
        @F.arrow_udf(T.DoubleType())
        def distance(lat1: pa.Array, lon1: pa.Array, lat2: pa.Array, lon2: pa.Array) -> pa.Array:
            return _solved(solver, (lat1, lon1, lat2, lon2))
    else:
        @F.arrow_udf(T.DoubleType())
        def distance(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            made = setup()
            for arrays in batches:
                yield _solved(made, arrays)

    def call(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike) -> Column:
        # the function is serialised when the UDF is first applied
        with _by_value(distance, solver or setup):
            return distance(*(as_col(c).cast("double") for c in (lat1, lon1, lat2, lon2)))

    return call


def _solved(solver: Callable, arrays: tuple) -> pa.Array:
    """The solver's result on the rows whose values are all finite; null on the others."""
    values = [a.to_numpy(zero_copy_only=False) for a in arrays]  # a null is NaN here
    good = np.logical_and.reduce([np.isfinite(v) for v in values])
    out = np.full(len(good), np.nan)
    out[good] = solver(*(v[good] for v in values))
    return pa.array(out, mask=~np.isfinite(out))


@contextmanager
def _by_value(*functions: Callable):
    """While the UDF is built, the package's modules of these functions are serialised by value."""
    names = {f.__module__ for f in functions if getattr(f, "__module__", "").split(".")[0] == __name__.split(".")[0]}
    modules = [sys.modules[n] for n in sorted(names | {__name__})]
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    try:
        yield
    finally:
        for m in modules:
            cloudpickle.unregister_pickle_by_value(m)


haversine_udf = make_distance_udf(haversine_np)
