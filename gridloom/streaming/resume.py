"""Extensions on Structured Streaming: the reports of workers, folded into a table as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.operators.curation import upsert


def fold_reports(spark: SparkSession, source: str, schema: str, read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None], keys: list[str], seq: str, state: str) -> StreamingQuery:
    """Each batch of arrived JSON part files is upserted by key, the last by ``seq`` wins; stops when all that is there is folded.

    ``read`` gives the table so far or None, ``write`` replaces it; a batch that is run again gives the same table.
    """

    def batch(parts: DataFrame, number: int) -> None:
        before = read()
        write(upsert(before if before is not None else parts.limit(0), parts, keys, seq))

    stream = spark.readStream.schema(schema).json(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", state).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, key, n) by tumbling event-time windows; rows later than the watermark are left out of a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
