"""Motion records: (object, frame, rms), one row for each frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moving(rms: Column, threshold: float, missing: bool) -> Column:
    """Whether a frame moves; ``missing`` says what null means."""
    return F.coalesce(rms > threshold, F.lit(missing))


def trim(frames: DataFrame, threshold: float, missing_moves: bool = True, keep_static: bool = True, key: str = "object") -> DataFrame:
    """Per object: first and last kept frame and counts. Static frames at both ends go, inner ones stay.

    An object without a moving frame keeps all frames (``keep_static``) or none (null range, 0 kept).
    """
    move = moving(F.col("rms"), threshold, missing_moves)
    x = frames.groupBy(key).agg(
        F.min(F.when(move, F.col("frame"))).alias("a"), F.max(F.when(move, F.col("frame"))).alias("z"), F.min("frame").alias("f0"), F.max("frame").alias("f1"), F.count("*").alias("before"), F.count_if(F.col("rms").isNull()).alias("missing")
    )
    a, z = (F.coalesce("a", "f0"), F.coalesce("z", "f1")) if keep_static else (F.col("a"), F.col("z"))
    return x.select(key, a.alias("keep_start"), z.alias("keep_end"), F.coalesce(z - a + 1, F.lit(0)).cast("long").alias("kept"), "before", "missing", F.col("a").isNull().alias("static"))


def kept_frames(frames: DataFrame, threshold: float, key: str = "object") -> DataFrame:
    """The rows of the kept range, in one pass."""
    w = Window.partitionBy(key)
    move = moving(F.col("rms"), threshold, True)
    x = frames.withColumn("a", F.min(F.when(move, F.col("frame"))).over(w)).withColumn("z", F.max(F.when(move, F.col("frame"))).over(w))
    return x.where("a is null or frame between a and z").drop("a", "z")


def capped_totals(frames: DataFrame, threshold: float, cap: int, key: str = "object") -> DataFrame:
    """One row: frames and moving frames, at most ``cap`` of each object, and their ratio (0 without frames)."""
    per = frames.groupBy(key).agg(F.count("*").alias("n"), F.count_if((F.col("rms") > threshold) & (F.col("frame") <= cap)).alias("m"))
    x = per.agg(F.coalesce(F.sum(F.least("n", F.lit(cap).cast("long"))), F.lit(0)).alias("frames_capped"), F.coalesce(F.sum("m"), F.lit(0)).alias("motion_frames"))
    return x.withColumn("ratio", F.when(F.col("frames_capped") > 0, F.col("motion_frames") / F.col("frames_capped")).otherwise(0.0))


def first_change(frames: DataFrame, signature: str, key: str = "object") -> DataFrame:
    """Per object: the signature of the first frame, the first frame that differs from it, and its signature."""
    ref = F.min_by(signature, "frame").over(Window.partitionBy(key))
    x = frames.withColumn("ref", ref)
    differs = ~F.col(signature).eqNullSafe(F.col("ref"))
    return x.groupBy(key).agg(F.first("ref").alias("reference"), F.min(F.when(differs, F.col("frame"))).alias("first_changed_frame"), F.min_by(signature, F.when(differs, F.col("frame"))).alias("changed_to"), F.count("*").alias("checked_frames")).withColumn(
        "topology_changed", F.col("first_changed_frame").isNotNull()
    )


def against_first(frames: DataFrame, value: str, key: str = "object", tolerance: float = 1e-6) -> DataFrame:
    """Each frame with the first frame's value and whether it is within the tolerance."""
    first = F.first_value(value).over(Window.partitionBy(key).orderBy("frame").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return frames.withColumn("first_value", first).withColumn("same", F.abs(F.col(value) - F.col("first_value")) <= tolerance)


def histogram(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def tri_count(df: DataFrame, ok: Column, changed: Column) -> DataFrame:
    """One row: changed, unchanged and failed records."""
    return df.agg(F.count_if(ok & changed).alias("changed"), F.count_if(ok & ~changed).alias("unchanged"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"))


def keyframes(times: DataFrame, start: int, end: int, key: str = "object", time: str = "time") -> DataFrame:
    """Distinct rounded times in the range; halves round to even."""
    return times.select(key, F.rint(time).cast("long").alias("frame")).where(F.col("frame").between(start, end)).distinct()
