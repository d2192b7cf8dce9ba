"""Spatial windows, serial windows and blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.arrays import floor_div, let, z_order
from gridloom.operators import sharding
from gridloom.operators.voxels import XYZ


def window_of(size: int | tuple[int, int, int], shift: int | tuple[int, int, int] = 0) -> list[Column]:
    """wx, wy, wz of a voxel."""
    size = (size,) * 3 if isinstance(size, int) else size
    shift = (shift,) * 3 if isinstance(shift, int) else shift
    return [floor_div(F.col(a) + s, k).alias(f"w{a}") for a, k, s in zip(XYZ, size, shift, strict=True)]


def partition(voxels: DataFrame, size: int, shift: int = 0) -> DataFrame:
    """(b, wx, wy, wz, n): the windows that are not empty and their lengths."""
    return voxels.groupBy("b", *window_of(size, shift)).agg(F.count("*").alias("n"))


def serial_code(mode: str = "z_order", shift: int = 0, bits: int = 10) -> Column:
    """Place on the curve; transposed modes exchange x and y."""
    x, y, z = (F.col(a) + shift for a in XYZ)
    if mode == "z_order":
        return z_order(x, y, z, bits)
    if mode == "z_order_transposed":
        return z_order(y, x, z, bits)
    if mode in ("hilbert", "hilbert_transposed"):
        return hilbert(y, x, z, bits) if mode.endswith("transposed") else hilbert(x, y, z, bits)
    raise ValueError(f"unknown mode {mode}")


def hilbert(x: Column, y: Column, z: Column, bits: int) -> Column:
    """Distance along a three-dimensional Hilbert curve, as bit arithmetic in the plan.

    A state (x, y, z) is folded over bits from the highest down and, for each, over the axes; so no step's expression is
    repeated within another's.
    """
    long = lambda v: F.lit(v).cast("long")
    state = lambda *v: F.struct(*[c.alias(n) for c, n in zip(v, "xyz", strict=True)])
    steps = F.lit([(1 << k) * 4 + axis for k in range(bits - 1, 0, -1) for axis in range(3)])

    def step(s: Column, t: Column) -> Column:
        q, axis = F.shiftright(t, 2).cast("long"), t.bitwiseAND(F.lit(3))
        own = F.when(axis == 0, s["x"]).when(axis == 1, s["y"]).otherwise(s["z"])
        on = own.bitwiseAND(q) != 0
        differ = s["x"].bitwiseXOR(own).bitwiseAND(q - 1)
        swap = F.when(on, long(0)).otherwise(differ)
        first = s["x"].bitwiseXOR(F.when(on, q - 1).otherwise(differ))
        return state(first, F.when(axis == 1, s["y"].bitwiseXOR(swap)).otherwise(s["y"]), F.when(axis == 2, s["z"].bitwiseXOR(swap)).otherwise(s["z"]))

    turned = F.aggregate(steps, state(*[v.cast("long") for v in (x, y, z)]), step)
    gray = let(turned, lambda s: state(s["x"], s["y"].bitwiseXOR(s["x"]), s["z"].bitwiseXOR(s["y"]).bitwiseXOR(s["x"])))
    masks = F.lit([1 << k for k in range(bits - 1, 0, -1)])

    def undo(g: Column) -> Column:
        t = F.aggregate(masks, long(0), lambda acc, q: F.when(g["z"].bitwiseAND(q.cast("long")) != 0, acc.bitwiseXOR(q.cast("long") - 1)).otherwise(acc))
        return let(t, lambda m: state(g["x"].bitwiseXOR(m), g["y"].bitwiseXOR(m), g["z"].bitwiseXOR(m)))

    return let(let(gray, undo), lambda h: z_order(h["z"], h["y"], h["x"], bits))


def serial_windows(voxels: DataFrame, code: Column, window: int, shift: int = 0, tie: str = "row_id") -> DataFrame:
    """(b, window, slot, rank, row_id, owned): windows of equal length over the serial order of each item, wrapping around.

    An item of no more than ``window`` rows is one window of its own length. ``owned`` marks the window in which a row's
    result counts; each row is owned once. A row's few windows are found by arithmetic, so the work is linear in the rows.
    """
    x = sharding.ranks(voxels.withColumn("__c", code), ["b"], [F.col("__c"), F.col(tie)])
    sizes = voxels.groupBy("b").agg(F.count("*").alias("n")).withColumn("k", F.ceil(F.col("n") / window))
    x = x.join(sizes, "b")
    size = F.col("n") / F.col("k")

    def begin(i: Column) -> Column:
        return F.when(F.col("k") == 1, F.lit(0)).otherwise(F.floor((i + 0.5) * size + shift - 0.5 * window)).cast("long")

    length = F.when(F.col("k") == 1, F.col("n")).otherwise(F.lit(window).cast("long"))
    # A place is in window i if begin(i) is in (place - window, place]; of a row the places are rank and its turns around the item
    near = lambda place: F.floor((place - shift + 0.5 * window) / size - 0.5).cast("long")
    lo = lambda place: F.greatest(F.lit(0).cast("long"), near(place - window) - 1)
    hi = lambda place: F.least(F.col("k") - 1, near(place) + 1)
    reach = F.ceil((F.lit(abs(shift) + window) / F.col("n"))).cast("long")
    turn = F.transform(F.sequence(-reach, reach), lambda t: F.col("rank") + t * F.col("n"))
    windows = F.array_distinct(F.flatten(F.transform(turn, lambda p: F.when(lo(p) <= hi(p), F.sequence(lo(p), hi(p))).otherwise(F.array().cast("array<bigint>")))))
    every = F.transform(F.when(F.col("k") == 1, F.array(F.lit(0).cast("long"))).otherwise(windows), lambda i: F.struct(i.alias("window"), F.pmod(F.col("rank") - begin(i), F.col("n")).alias("slot"), begin(i).alias("begin")))
    x = x.withColumn("e", F.explode(F.filter(every, lambda e: e["slot"] < length))).select("b", "row_id", "rank", "n", "k", F.col("e.window").alias("window"), "e.slot", "e.begin")
    place = F.col("begin") + F.col("slot")
    a = F.floor(F.col("window") * size + shift)
    z = F.floor((F.col("window") + 1) * size + shift)
    owned = (F.col("k") == 1) | ((place >= a) & (place < z))
    return x.select("b", "window", "slot", "rank", "row_id", owned.alias("owned"))


def block_index(voxels: DataFrame, k: int) -> DataFrame:
    """(b, bx, by, bz, block, n, start): blocks that are not empty, numbered in order within the item, with running totals."""
    n = voxels.groupBy("b", *[floor_div(F.col(a), k).alias(f"b{a}") for a in XYZ]).agg(F.count("*").alias("n"))
    w = Window.partitionBy("b").orderBy("bx", "by", "bz")
    return n.select("*", (F.dense_rank().over(w) - 1).cast("long").alias("block"), (F.sum("n").over(w) - F.col("n")).alias("start"))
