"""The boundary to kernels outside Spark: renderers, learned layers, distance kernels, marching cubes, video.

They are not part of this library. ``run_kernel`` is where one is plugged in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_kernel(manifest: DataFrame, done: DataFrame | None, kernel: Callable[[dict], Iterable[dict]], schema: str, key: str, tasks: int) -> DataFrame:
    """Rows that ``kernel`` makes of each manifest row that is not done; a failing item gives no rows but does not end the job.

    The schema must have the columns ``key`` and ``error``; an item that raises gives one row with its key and the error.
    """
    todo = manifest if done is None else manifest.join(done.select(key), key, "left_anti")
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            for item in d.to_dict("records"):
                try:
                    rows = [dict(r) for r in kernel(item)]
                except Exception as e:  # noqa: BLE001  the item's own failure is its result
                    rows = [{key: item[key], "error": f"{type(e).__name__}: {e}"}]
                if rows:
                    yield pd.DataFrame(rows).reindex(columns=names)

    return todo.repartition(tasks, F.xxhash64(key)).mapInPandas(run, schema)
