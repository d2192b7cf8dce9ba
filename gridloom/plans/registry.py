"""Queries by name, each with the SQL that says the same for DuckDB where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class Tables:
    """The tables of a folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


#: Lineitem as voxels: places repeat, rows do not.
VOXELS = """vox AS (SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS row_id, l_suppkey % 4 AS b, l_partkey % 64 AS x, l_suppkey % 64 AS y, l_orderkey % 64 AS z,
  l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2 FROM lineitem)"""
#: One voxel for each place.
PLACES = VOXELS + """, vol AS (SELECT b, x, y, z, min(row_id) AS row_id, count(*)::DOUBLE AS value FROM vox GROUP BY b, x, y, z)"""
#: Events as frames of objects, with gaps.
FRAMES = """frames AS (SELECT user_id AS object, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 1000 END AS rms,
  event_type AS sig, event_id FROM events)"""
#: Lineitem as triangles of one mesh a supplier, with 97 vertices each.
MESHES = """faces AS (SELECT l_suppkey AS mesh, ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS fid, l_orderkey % 97 AS a, l_partkey % 97 AS b, (l_orderkey // 97 + l_linenumber * 13) % 97 AS c FROM lineitem),
verts AS (SELECT m AS mesh, v AS vid, ((v * 37 + m * 11) % 101)::DOUBLE AS x, ((v * 53 + m) % 89)::DOUBLE AS y, ((v * 71) % 83)::DOUBLE AS z FROM (SELECT s_suppkey AS m FROM supplier) a, range(97) b(v))"""


def voxels(t: Tables) -> DataFrame:
    col = F.col
    return t.lineitem.select(
        (((col("l_orderkey") * 10 + col("l_linenumber")) * 100000 + col("l_partkey")) * 10000 + col("l_suppkey")).alias("row_id"), (col("l_suppkey") % 4).alias("b"), (col("l_partkey") % 64).alias("x"), (col("l_suppkey") % 64).alias("y"),
        (col("l_orderkey") % 64).alias("z"), col("l_quantity").alias("f0"), col("l_extendedprice").alias("f1"), col("l_discount").alias("f2"),
    )


def places(t: Tables) -> DataFrame:
    return voxels(t).groupBy("b", "x", "y", "z").agg(F.min("row_id").alias("row_id"), F.count("*").cast("double").alias("value"))


def frames(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return t.events.select(F.col("user_id").alias("object"), n.alias("frame"), F.when(F.col("event_id") % 17 != 0, F.col("value") / 1000).alias("rms"), F.col("event_type").alias("sig"), "event_id")


def faces(t: Tables) -> DataFrame:
    """The faces of MESHES: every line of every order."""
    col = F.col
    c = (F.floor(col("l_orderkey") / 97) + col("l_linenumber") * 13) % 97
    return t.lineitem.select(
        col("l_suppkey").cast("long").alias("mesh"), (((col("l_orderkey") * 10 + col("l_linenumber")) * 100000 + col("l_partkey")) * 10000 + col("l_suppkey")).alias("fid"), (col("l_orderkey") % 97).alias("a"), (col("l_partkey") % 97).alias("b"), c.cast("long").alias("c")
    )


def vertices(t: Tables) -> DataFrame:
    """The vertices of MESHES: 97 for each supplier."""
    m, v = F.col("mesh"), F.col("vid")
    grid = t.supplier.select(F.col("s_suppkey").cast("long").alias("mesh"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(96).cast("long"))).alias("vid"))
    return grid.select("mesh", "vid", ((v * 37 + m * 11) % 101).cast("double").alias("x"), ((v * 53 + m) % 89).cast("double").alias("y"), ((v * 71) % 83).cast("double").alias("z"))
