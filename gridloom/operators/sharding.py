"""Order, chunks, samples and splits.

Positions in a total order come from ``positions``: a range sort, then each partition's rows are numbered from the
number of rows before it. No step puts all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.lineage import checkpoint


def positions(df: DataFrame, order: list[Column], name: str = "rn0") -> DataFrame:
    """0-based position of each row in the order, which must be total."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # Ranges come from a sample: they must be the same for the counts and for the rows
    placed = checkpoint(placed.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id()))
    within = F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy("__p").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__p", F.coalesce(before, F.lit(0)).alias("__s"))  # a row for each partition
    return placed.join(F.broadcast(starts), "__p").withColumn(name, (F.col("__s") + within).cast("long")).drop("__p", "__m", "__s")


def ranks(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """0-based position of each row within its keys; the order must be total within them. A key of any size is dealt over many tasks."""
    placed = positions(df, [*(F.col(k) for k in keys), *order], "__at")
    first = placed.groupBy(*keys).agg(F.min("__at").alias("__first"))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    x = placed.alias("p").join(first.alias("f"), same)
    return x.select(*[F.col(f"p.{c}") for c in df.columns], (F.col("p.__at") - F.col("f.__first")).alias(name))


def chunk_floor(rn0: Column, n: Column, k: int) -> Column:
    """Chunk of position rn0 where chunk i is [n*i//k, n*(i+1)//k)."""
    return F.floor(((rn0 + 1) * k - 1) / n).cast("long")


def chunk_ceil(rn0: Column, n: Column, k: int) -> Column:
    """Chunks of ceil(n/k); the last ones may be short or empty."""
    return F.floor(rn0 / F.ceil(n / k)).cast("long")


def round_robin(rn0: Column, k: int) -> Column:
    return F.pmod(rn0, F.lit(k)).cast("long")


def hash_order(key: Column, seed: str) -> Column:
    return F.sha1(F.concat(F.lit(seed + ":"), key.cast("string")))


def split(df: DataFrame, key: str, test: int, seed: str) -> DataFrame:
    """``split``: test for the ``test`` keys of least seeded hash, train for the others. Keys must be distinct."""
    picked = df.select(key).orderBy(hash_order(F.col(key), seed), key).limit(test).withColumn("__t", F.lit(True))
    return df.join(picked, key, "left").withColumn("split", F.when(F.col("__t"), "test").otherwise("train")).drop("__t")


def stride_frames(n: Column, stride: int, offset: int = 0) -> Column:
    return F.when(n > offset, F.sequence(F.lit(offset).cast("long"), n.cast("long") - 1, F.lit(stride).cast("long"))).otherwise(F.array().cast("array<long>"))


def crop_start(key: Column, n: Column, length: int = 121) -> Column:
    """Start of a run of ``length`` frames, the same at each call for a key; 0 if there are no more than that."""
    return F.when(n > length, F.pmod(F.conv(F.substring(F.sha1(key.cast("string")), 1, 8), 16, 10).cast("long"), n - length + 1)).otherwise(F.lit(0)).cast("long")


def seeded_uniform(*keys: Column) -> Column:
    """[0, 1) by the hash of the keys."""
    return F.conv(F.substring(F.sha1(F.concat_ws(":", *[k.cast("string") for k in keys])), 1, 13), 16, 10).cast("double") / float(1 << 52)
