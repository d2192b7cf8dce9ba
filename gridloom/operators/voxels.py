"""Sparse volumes as relations: voxels (row_id, b, x, y, z, features...), one row for each voxel.

``row_id`` stands for the position of a row, ``b`` for its item. Feature columns are scalars or arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.arrays import floor_div, floor_mod, let, pack
from gridloom.operators import sharding

XYZ = ["x", "y", "z"]

REDUCE: dict[str, Callable[[Column], Column]] = {
    # the first three start from a zero row, as a scatter onto zeros does
    "mean": lambda v: F.sum(v) / (F.count("*") + 1),
    "amax": lambda v: F.greatest(F.max(v), F.lit(0.0)),
    "amin": lambda v: F.least(F.min(v), F.lit(0.0)),
    "sum": F.sum,
    "true_mean": F.avg,
    "true_max": F.max,
}


def layout(voxels: DataFrame) -> DataFrame:
    """(b, start, stop): items in order, empty ones in the middle too. Items are few; the running sum is over them."""
    n = voxels.groupBy("b").agg(F.count("*").alias("n"))
    every = n.agg(F.max("b").alias("m")).where("m is not null").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long"))).alias("b"))
    x = every.join(n, "b", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    stop = F.sum("n").over(Window.orderBy("b"))
    return x.select("b", (stop - F.col("n")).alias("start"), stop.alias("stop"))


def full(spark: SparkSession, low: tuple[int, int, int], high: tuple[int, int, int], items: int, value: float) -> DataFrame:
    """Every voxel of a closed box in each of ``items`` items, with one value."""
    out = spark.range(items).select(F.col("id").alias("b"))
    for axis, a, z in zip(XYZ, low, high, strict=True):
        out = out.withColumn(axis, F.explode(F.sequence(F.lit(a).cast("long"), F.lit(z).cast("long"))))
    return out.withColumn("value", F.lit(float(value)))


def take_items(voxels: DataFrame, items: list[int]) -> DataFrame:
    """Items by number, in the order asked for, renumbered; repeats are repeated."""
    table = F.array(*[F.struct(F.lit(old).cast("long").alias("old"), F.lit(new).cast("long").alias("new")) for new, old in enumerate(items)])
    x = voxels.withColumn("__t", F.explode(F.filter(table, lambda t: t["old"] == F.col("b"))))
    return x.withColumn("b", F.col("__t.new")).drop("__t")


def unbind(voxels: DataFrame, items: int) -> list[DataFrame]:
    """One table for each item."""
    return [voxels.where(F.col("b") == k).drop("b") for k in range(items)]


def replace(voxels: DataFrame, **features: Column) -> DataFrame:
    return voxels.withColumns(features)


def cell(factor: int | tuple[int, int, int]) -> list[Column]:
    fs = (factor,) * 3 if isinstance(factor, int) else factor
    return [floor_div(F.col(a), f).alias(a) for a, f in zip(XYZ, fs, strict=True)]


def downsample(voxels: DataFrame, factor: int | tuple[int, int, int], features: list[str], mode: str = "mean") -> DataFrame:
    """Coarse voxels (b, x, y, z, features); sums in double. See REDUCE for the modes."""
    return voxels.groupBy("b", *cell(factor)).agg(*[REDUCE[mode](F.col(f).cast("double")).alias(f) for f in features])


def coarse_map(voxels: DataFrame, factor: int) -> DataFrame:
    """(row_id, b, cx, cy, cz): of each fine voxel its coarse one."""
    return voxels.select("row_id", "b", *[floor_div(F.col(a), factor).alias(f"c{a}") for a in XYZ])


def upsample(fine: DataFrame, coarse: DataFrame, factor: int, features: list[str]) -> DataFrame:
    """Fine voxels with the features of their coarse one (nearest neighbour). Coarse voxels must be distinct."""
    c = coarse.select(F.col("b").alias("__b"), *[F.col(a).alias(f"__{a}") for a in XYZ], *[F.col(f).alias(f"up_{f}") for f in features])
    on = [F.col("b") == F.col("__b"), *[floor_div(F.col(a), factor) == F.col(f"__{a}") for a in XYZ]]
    return fine.join(c, on, "inner").drop("__b", *[f"__{a}" for a in XYZ])


def subdivide(voxels: DataFrame) -> DataFrame:
    """Eight children of each voxel, features copied; ``child`` 0 to 7 with z fastest."""
    x = voxels.withColumn("child", F.explode(F.sequence(F.lit(0), F.lit(7))))
    bit = {"x": 4, "y": 2, "z": 1}
    return x.withColumns({a: (F.col(a) * 2 + F.col("child").bitwiseAND(F.lit(w)) / w).cast("long") for a, w in bit.items()})


def by_row(a: DataFrame, b: DataFrame, features: list[str], op: Callable[[Column, Column], Column]) -> DataFrame:
    """a's voxels with op(a, b) of rows of equal row_id, whatever their coordinates."""
    other = b.select("row_id", *[F.col(f).alias(f"__{f}") for f in features])
    x = a.join(other, "row_id")
    return x.withColumns({f: op(F.col(f), F.col(f"__{f}")) for f in features}).drop(*[f"__{f}" for f in features])


def by_place(a: DataFrame, b: DataFrame, features: list[str], op: Callable[[Column, Column], Column]) -> DataFrame:
    """a's voxels with op(a, b) of voxels at the same place."""
    other = b.select("b", *XYZ, *[F.col(f).alias(f"__{f}") for f in features])
    x = a.join(other, ["b", *XYZ])
    return x.withColumns({f: op(F.col(f), F.col(f"__{f}")) for f in features}).drop(*[f"__{f}" for f in features])


def by_item(voxels: DataFrame, items: DataFrame, features: list[str], op: Callable[[Column, Column], Column]) -> DataFrame:
    """op(voxel, item) with one row of ``items`` for each b."""
    other = items.select("b", *[F.col(f).alias(f"__{f}") for f in features])
    x = voxels.join(other, "b")
    return x.withColumns({f: op(F.col(f), F.col(f"__{f}")) for f in features}).drop(*[f"__{f}" for f in features])


def concat_items(parts: list[DataFrame], items: list[int]) -> DataFrame:
    """All voxels, the items of later tables numbered after those of earlier ones; items[k] is the number of items of part k."""
    out, at = parts[0], items[0]
    for part, n in zip(parts[1:], items[1:], strict=True):
        out = out.unionByName(part.withColumn("b", F.col("b") + at))
        at += n
    return out


def concat_features(a: DataFrame, b: DataFrame, feature: str) -> DataFrame:
    """a's voxels with the arrays of both rows of equal row_id."""
    other = b.select("row_id", F.col(feature).alias("__f"))
    return a.join(other, "row_id").withColumn(feature, F.concat(feature, "__f")).drop("__f")


def block_rank(voxels: DataFrame, k: int, tie: str = "row_id") -> DataFrame:
    """Adds ``rank`` within the item: blocks of k^3 in order, then places in the block."""
    order = [floor_div(F.col(a), k) for a in XYZ] + [floor_mod(F.col(a), k) for a in XYZ] + [F.col(tie)]
    return sharding.ranks(voxels, ["b"], order)


def group_norm(voxels: DataFrame, feature: str, groups: int, eps: float = 1e-5) -> DataFrame:
    """Arrays normalised by mean and variance of their item and channel group."""
    x = voxels.select("row_id", "b", F.posexplode(feature).alias("c", "v"), F.size(feature).alias("n"))
    x = x.withColumn("g", F.floor(F.col("c") * groups / F.col("n"))).withColumn("v", F.col("v").cast("double"))
    stats = x.groupBy("b", "g").agg(F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    x = x.join(stats, ["b", "g"]).select("row_id", "b", F.struct("c", ((F.col("v") - F.col("m")) / F.sqrt(F.col("s") + eps)).alias("v")).alias("e"))
    return x.groupBy("row_id", "b").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["v"]).alias(feature))


def layer_norm(feature: Column, eps: float = 1e-5) -> Column:
    """Of one voxel's channels."""
    n = F.size(feature)
    mean = F.aggregate(feature, F.lit(0.0), lambda s, v: s + v.cast("double")) / n
    centred = let(mean, lambda m: F.transform(feature, lambda v: v.cast("double") - m))
    spread = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v) / n
    return let(centred, lambda c: let(F.sqrt(spread(c) + eps), lambda d: F.transform(c, lambda v: v / d)))


def linear(voxels: DataFrame, feature: str, weights: list[list[float]], bias: list[float]) -> DataFrame:
    """weights (out x in) times the array, plus bias, as one expression without a shuffle."""
    row = lambda w: F.aggregate(F.zip_with(F.col(feature), F.lit([float(v) for v in w]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return voxels.withColumn(feature, F.array(*[row(w) + F.lit(float(b)) for w, b in zip(weights, bias, strict=True)]))


def convolve(voxels: DataFrame, feature: str, kernel: dict[tuple[int, int, int], float], stride: int = 1) -> DataFrame:
    """Sparse convolution of a scalar feature: each voxel sends its weighted value to its neighbours' places.

    Output stands at places of voxels (submanifold) for stride 1, at places // stride for more. A voxel sends one row for
    each kernel offset; sums are partial before the shuffle.
    """
    taps = F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(XYZ, o, strict=True)], F.lit(float(w)).alias("w")) for o, w in kernel.items()])
    x = voxels.select("b", *XYZ, feature, F.explode(taps).alias("t"))
    # out[p] = sum of w[d] * in[p + d]
    sent = x.select("b", *[(F.col(a) - F.col(f"t.d{a}")).alias(a) for a in XYZ], (F.col(feature) * F.col("t.w")).alias("v"))
    if stride == 1:
        return sent.groupBy("b", *XYZ).agg(F.sum("v").alias(feature)).join(voxels.select("b", *XYZ).distinct(), ["b", *XYZ], "left_semi")
    hit = [floor_mod(F.col(a), stride) == 0 for a in XYZ]
    sent = sent.where(hit[0] & hit[1] & hit[2]).select("b", *[floor_div(F.col(a), stride).alias(a) for a in XYZ], "v")
    return sent.groupBy("b", *XYZ).agg(F.sum("v").alias(feature))


def chunk_halo(voxels: DataFrame, resolution: int, chunks: int, padding: int) -> DataFrame:
    """Voxels with each padded chunk that holds them: chunk numbers i, j, k and local coordinates lx, ly, lz.

    A voxel goes to its own chunk and to the neighbours whose halo it is in, by arithmetic: no range join.
    """
    side = resolution // chunks
    out = voxels.where(" and ".join(f"{a} >= 0 and {a} < {resolution}" for a in XYZ))
    for axis, name in zip(XYZ, "ijk", strict=True):
        v = F.col(axis)
        first = F.greatest(F.lit(0).cast("long"), F.floor((v - padding) / side).cast("long"))
        last = F.least(F.lit(chunks - 1).cast("long"), F.floor((v + padding) / side).cast("long"))
        out = out.withColumn(name, F.explode(F.sequence(first, last)))
    start = lambda n: F.greatest(F.lit(0).cast("long"), F.col(n) * side - padding)
    return out.withColumns({f"l{a}": F.col(a) - start(n) for a, n in zip(XYZ, "ijk", strict=True)})


def stitch(chunked: DataFrame, resolution: int, chunks: int, padding: int, ratio: int = 1, clean: bool = False) -> DataFrame:
    """Chunk results (i, j, k, lx, ly, lz at ``ratio`` times the resolution) back in place, cropped to the chunk's own box.

    The box reaches ratio - 1 too far up, so neighbours overlap there and duplicates stay; ``clean`` cuts it half-open.
    """
    side, extra = resolution // chunks, 0 if clean else ratio - 1
    out = chunked
    for axis, n in zip(XYZ, "ijk", strict=True):
        start = F.greatest(F.lit(0).cast("long"), F.col(n) * side - padding) * ratio
        out = out.withColumn(axis, F.col(f"l{axis}") + start)
        out = out.where((F.col(axis) >= F.col(n) * side * ratio) & (F.col(axis) < (F.col(n) + 1) * side * ratio + extra))
    return out


def densify(voxels: DataFrame, size: int, feature: str, background: float) -> DataFrame:
    """Every voxel of a size^3 grid for each item, with the background where there is none. For small sizes only."""
    grid = voxels.select("b").distinct()
    for a in XYZ:
        grid = grid.withColumn(a, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long"))))
    x = grid.join(voxels.select("b", *XYZ, feature), ["b", *XYZ], "left")
    return x.withColumn(feature, F.coalesce(feature, F.lit(float(background))))


def occupied(voxels: DataFrame, logit: str, threshold: float) -> DataFrame:
    """Places where the logistic function of the logit reaches the threshold."""
    return voxels.where(1 / (1 + F.exp(-F.col(logit))) >= threshold).select("b", *XYZ)


def near_surface(voxels: DataFrame, distance: str, size: int, factor: int) -> DataFrame:
    """Distinct coarse cells with a voxel nearer than 4 / size."""
    return voxels.where(F.col(distance) < 4 / size).select("b", *cell(factor)).distinct()


def encode_sdf(voxels: DataFrame, distance: str, sign: str, resolution: int) -> DataFrame:
    """(b, code, sdf): voxels nearer than 4 / resolution, signed and scaled to (-1, 1), places packed."""
    near = voxels.where(F.col(distance) < 4 / resolution)
    return near.select("b", pack(F.col("x"), F.col("y"), F.col("z"), int(math.log2(resolution))).alias("code"), (F.col(distance) * F.col(sign) * resolution / 4).alias("sdf"))


def pack_signs(voxels: DataFrame, sign: str) -> DataFrame:
    """(b, byte, bits): eight signs a byte, most significant first, in order of ``ordinal``."""
    x = voxels.select("b", F.floor(F.col("ordinal") / 8).alias("byte"), F.when(F.col(sign) > 0, F.get(F.lit([128 >> k for k in range(8)]), F.pmod(F.col("ordinal"), F.lit(8)).cast("int"))).otherwise(0).alias("v"))
    return x.groupBy("b", "byte").agg(F.sum("v").alias("bits"))


def blend_weight(place: Column, patch: Column, size: int, stride: int, patches: int) -> Column:
    """Weight on one axis of a patch at a place: a linear ramp over the overlap with its neighbours, 1 in between."""
    overlap = size - stride
    at = place - patch * stride
    up = F.when((patch > 0) & (at < overlap), (at + 0.5) / overlap)
    down = F.when((patch < patches - 1) & (at >= stride), (size - at - 0.5) / overlap)
    return F.coalesce(up, down, F.lit(1.0))


def refine_sign(sdf: DataFrame, coarse: DataFrame, known: DataFrame) -> DataFrame:
    """|sdf| with the sign of the coarse voxel over it, and the known voxels' own values in place."""
    c = coarse.select(F.col("b").alias("cb"), *[F.col(a).alias(f"c{a}") for a in XYZ], F.col("value").alias("cv"))
    on = [F.col("b") == F.col("cb"), *[floor_div(F.col(a), 2) == F.col(f"c{a}") for a in XYZ]]
    x = sdf.join(c, on, "left").select("b", *XYZ, (F.abs("value") * F.signum(F.coalesce("cv", F.lit(1.0)))).alias("value"))
    k = known.select("b", *XYZ, F.col("value").alias("own"))
    return x.join(k, ["b", *XYZ], "left").select("b", *XYZ, F.coalesce("own", "value").alias("value"))


def patchify(voxels: DataFrame, patch: int) -> DataFrame:
    """(b, patch place, slot, value): slot is the place within the patch, x slowest."""
    slot = (floor_mod(F.col("x"), patch) * patch + floor_mod(F.col("y"), patch)) * patch + floor_mod(F.col("z"), patch)
    return voxels.select("b", *cell(patch), slot.cast("long").alias("slot"), "value")


def unpatchify(patches: DataFrame, patch: int) -> DataFrame:
    s = F.col("slot")
    part = {"x": floor_div(s, patch * patch), "y": F.pmod(floor_div(s, patch), F.lit(patch)), "z": F.pmod(s, F.lit(patch))}
    return patches.select("b", *[(F.col(a) * patch + part[a]).cast("long").alias(a) for a in XYZ], "value")


def tokens(images: DataFrame, width: int, registers: int) -> DataFrame:
    """(b, x, y, z, token) of images (b, tokens array, mask array): class and registers at (0, 0, 1), kept patches at (w, h, 0)."""
    x = images.select("b", "mask", F.posexplode("tokens").alias("k", "token"))
    patch = F.col("k") - 1 - registers
    head = F.col("k") <= registers
    x = x.withColumns({"x": F.when(head, 0).otherwise(F.pmod(patch, F.lit(width))), "y": F.when(head, 0).otherwise(F.floor(patch / width)), "z": head.cast("int")})
    return x.where(head | F.get("mask", patch)).select("b", "x", "y", "z", "token")


def gaussian_kl(mean: Column, logvar: Column) -> Column:
    """KL divergence to the standard normal, of arrays."""
    return 0.5 * F.aggregate(F.zip_with(mean, logvar, lambda m, v: m * m + F.exp(v) - 1.0 - v), F.lit(0.0), lambda s, v: s + v)


def gaussian_nll(sample: Column, mean: Column, logvar: Column) -> Column:
    part = F.zip_with(F.zip_with(sample, mean, lambda s, m: (s - m) * (s - m)), logvar, lambda d, v: math.log(2 * math.pi) + v + d / F.exp(v))
    return 0.5 * F.aggregate(part, F.lit(0.0), lambda s, v: s + v)


class Cache:
    """Tables by scale and name, as the layers of one volume share them; ``get`` of what is absent is None."""

    def __init__(self):
        self._tables: dict[tuple[str, str], DataFrame] = {}

    def register(self, scale: str, name: str, table: DataFrame) -> DataFrame:
        self._tables[scale, name] = table.persist()
        return self._tables[scale, name]

    def get(self, scale: str, name: str) -> DataFrame | None:
        return self._tables.get((scale, name))

    def clear(self) -> None:
        for t in self._tables.values():
            t.unpersist()
        self._tables.clear()

    def __iter__(self) -> Iterator[tuple[str, str]]:
        return iter(self._tables)
