"""Shared pieces of the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in batches whose text column holds about ``most`` bytes at most, or one row; nothing is copied.

    Spark ends an Arrow batch at 64 MB; this bounds what Python objects of a batch take.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        part = (np.cumsum(size) - size) // most
        cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cut, cut[1:], strict=False):
            yield batch.slice(a, b - a)


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that spark.checkpoint.dir names. Without one only a local session, as in tests, gets a folder of its own."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; in a local session without it, a temporary folder."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="checkpoints")


def whole_text(text: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def with_fields(schema: StructType, fields: dict[str, str]) -> StructType:
    """The schema and further fields, by name and DDL type."""
    return StructType([*schema.fields, *(StructType.fromDDL(f"`{name}` {kind}")[0] for name, kind in fields.items())])


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Exclusive running sums of an int array, by blocks: O(n * block), not O(n^2)."""
    plus = lambda acc, x: acc + x
    zero = F.lit(0).cast("int")
    n = F.size(lengths)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))
    sums = F.transform(starts, lambda b: F.aggregate(F.slice(lengths, b * block + 1, F.lit(block)), zero, plus))
    before = F.transform(starts, lambda b: F.aggregate(F.slice(sums, F.lit(1), b), zero, plus))
    return F.transform(
        lengths,
        lambda x, i: F.get(before, F.floor(i / block).cast("int"))
        + F.aggregate(F.slice(lengths, F.floor(i / block).cast("int") * block + 1, i % block), zero, plus),
    )
