"""Vectors, packed codes, cameras and embeddings as column expressions."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def pack(x: Column, y: Column, z: Column, bits: int) -> Column:
    """x, y, z in one number, ``bits`` each."""
    return x.cast("long") + F.shiftleft(y.cast("long"), bits) + F.shiftleft(z.cast("long"), 2 * bits)


def unpack(code: Column, bits: int) -> list[Column]:
    low = F.lit((1 << bits) - 1).cast("long")
    return [F.shiftright(code, k * bits).bitwiseAND(low) for k in range(3)]


def floor_div(x: Column, k: int | Column) -> Column:
    """Toward minus infinity, unlike DIV."""
    return F.floor(x / k).cast("long")


def floor_mod(x: Column, k: int | Column) -> Column:
    return F.pmod(x, F.lit(k) if isinstance(k, int) else k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for a row and not for each element of an inner transform."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scale(a: Column, by: Column) -> Column:
    return let(by, lambda k: F.transform(a, lambda v: v * k))


def elementwise(a: Column, b: Column, op: Callable[[Column, Column], Column]) -> Column:
    return F.zip_with(a, b, op)


def safe_divide(a: Column, b: Column) -> Column:
    """As IEEE floats divide: x/0 is an infinity, 0/0 not a number."""
    inf = F.lit(float("inf"))
    return F.when(b != 0, a / F.nullif(b, F.lit(0.0))).when(a > 0, inf).when(a < 0, -inf).otherwise(F.lit(float("nan")))


def l2_normalize(a: Column, least: float = 1e-12) -> Column:
    return scale(a, 1 / F.greatest(F.sqrt(dot(a, a)), F.lit(least)))


def rms_normalize(a: Column, gamma: float = 1.0) -> Column:
    """Unit length times the square root of the dimension."""
    return scale(l2_normalize(a), F.sqrt(F.size(a).cast("double")) * gamma)


# ---- activations

ACTIVATIONS: dict[str, Callable[[Column], Column]] = {
    "relu": lambda v: F.greatest(v, F.lit(0.0)),
    "sigmoid": lambda v: 1 / (1 + F.exp(-v)),
    "silu": lambda v: v / (1 + F.exp(-v)),
    "tanh": F.tanh,
    "gelu_tanh": lambda v: 0.5 * v * (1 + F.tanh(F.lit(math.sqrt(2 / math.pi)) * (v + 0.044715 * v * v * v))),
}


def activate(a: Column, name: str) -> Column:
    """A named activation of every component; registered names only."""
    return F.transform(a, ACTIVATIONS[name])


# ---- embeddings


def position_embedding(xs: list[Column], channels: int, factor: float | None = None, base: float = 10000.0) -> Column:
    """Sines, then cosines of each coordinate at channels // n // 2 frequencies, padded with zeros to ``channels``."""
    n = channels // len(xs) // 2
    parts = []
    for x in xs:
        x = x.cast("double") * factor if factor is not None else x.cast("double")
        freqs = F.array(*[F.lit(1.0 / base ** (k / n)) for k in range(n)])
        angles = _times(freqs, x)
        parts += [F.transform(angles, F.sin), F.transform(angles, F.cos)]
    pad = channels - 2 * n * len(xs)
    return F.concat(*parts, *([F.array_repeat(F.lit(0.0), pad)] if pad else []))


def _times(values: Column, by: Column) -> Column:
    return F.transform(values, lambda v: v * by)


def timestep_embedding(t: Column, dim: int, max_period: float = 10000.0) -> Column:
    """Cosines, then sines at dim // 2 frequencies; a zero last if dim is odd."""
    half = dim // 2
    freqs = F.array(*[F.lit(math.exp(-math.log(max_period) * k / half)) for k in range(half)])
    out = F.concat(F.transform(freqs, lambda f: F.cos(t * f)), F.transform(freqs, lambda f: F.sin(t * f)))
    return F.concat(out, F.array(F.lit(0.0))) if dim % 2 else out


def rotary(q: Column, position: Column, half: int, base: float = 10000.0) -> Column:
    """Neighbouring components turned as complex numbers by position times frequency."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.lit(half - 1)),
        lambda k: F.struct((position / F.pow(F.lit(base), k / half)).alias("a"), F.get(q, 2 * k).cast("double").alias("re"), F.get(q, 2 * k + 1).cast("double").alias("im")),
    )
    return F.flatten(F.transform(pairs, lambda p: F.array(p["re"] * F.cos(p["a"]) - p["im"] * F.sin(p["a"]), p["re"] * F.sin(p["a"]) + p["im"] * F.cos(p["a"]))))


# ---- low-discrepancy points


def radical_inverse(base: int, n: Column, digits: int = 40) -> Column:
    """Digits of n mirrored at the point."""
    step = lambda acc, k: F.struct(
        (acc["v"] + F.pmod(acc["n"], F.lit(base)) * acc["w"]).alias("v"), F.floor(acc["n"] / base).cast("long").alias("n"), (acc["w"] / base).alias("w")
    )
    start = F.struct(F.lit(0.0).alias("v"), n.cast("long").alias("n"), F.lit(1.0 / base).alias("w"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(digits)), start, step, lambda acc: acc["v"])


def sphere_hammersley(n: Column, total: int, offset: tuple[float, float] = (0.0, 0.0), remap: bool = False) -> tuple[Column, Column]:
    """(phi, theta) of point n of ``total`` on the sphere."""
    u = n / F.lit(total) + offset[0] / total
    v = radical_inverse(2, n) + offset[1]
    if remap:
        u = F.when(u < 0.25, 2 * u).otherwise(u * (2 / 3) + 1 / 3)
    return v * (2 * math.pi), F.acos(1 - 2 * u) - math.pi / 2


# ---- cameras


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def unit(a: list[Column], least: float = 1e-12) -> list[Column]:
    n = F.greatest(F.sqrt(a[0] * a[0] + a[1] * a[1] + a[2] * a[2]), F.lit(least))
    return [v / n for v in a]


def orbit_offset(radius: Column, azimuth: Column, elevation: Column) -> list[Column]:
    return [radius * F.cos(elevation) * F.cos(azimuth), radius * F.cos(elevation) * F.sin(azimuth), radius * F.sin(elevation)]


def look_at(camera: list[Column], target: list[Column]) -> list[list[Column]]:
    """Right, true up, backward and position of a camera; z is up, y where the view is along z."""
    forward = unit([t - c for c, t in zip(camera, target, strict=True)])
    zero, one = F.lit(0.0), F.lit(1.0)
    side, other = cross(forward, [zero, zero, one]), cross(forward, [zero, one, zero])
    flat = F.sqrt(side[0] * side[0] + side[1] * side[1] + side[2] * side[2]) < 1e-6
    right = unit([F.when(flat, o).otherwise(s) for s, o in zip(side, other, strict=True)])
    return [right, unit(cross(right, forward)), [-v for v in forward], camera]


def focal(size: float, angle: Column) -> Column:
    """Focal length, in units of ``size``, of a field of view in radians."""
    return 0.5 * size / F.greatest(F.tan(0.5 * angle), F.lit(1e-8))


def smoothstep(a: Column) -> Column:
    return a * a * (3.0 - 2.0 * a)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def box_corners(low: list[Column], high: list[Column]) -> Column:
    """The 8 corners of a box, to explode."""
    pick = lambda k, bit: (high if bit else low)[k]
    return F.array(*[F.struct(*[pick(k, i >> k & 1).alias("xyz"[k]) for k in range(3)]) for i in range(8)])


def to_uint(x: Column, bits: int) -> Column:
    """[-1, 1] to unsigned integers, clamped."""
    return F.rint(clamp((x + 1) * 0.5, 0.0, 1.0) * ((1 << bits) - 1)).cast("long")


def from_uint(x: Column, bits: int) -> Column:
    return x / F.lit(float((1 << bits) - 1)) * 2 - 1


def all_close(a: Column, b: Column, tolerance: float) -> Column:
    return F.forall(F.zip_with(a, b, lambda p, q: F.abs(p - q)), lambda d: d <= tolerance)


# ---- curve order


def z_order(x: Column, y: Column, z: Column, bits: int = 10) -> Column:
    """Bits of z, y, x interleaved, x lowest."""
    out = F.lit(0).cast("long")
    for k in range(bits):
        for axis, v in enumerate((x, y, z)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(v.cast("long"), k).bitwiseAND(F.lit(1).cast("long")), 3 * k + axis))
    return out
