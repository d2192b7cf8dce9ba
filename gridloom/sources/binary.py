"""Readers of binary assets: GLB headers and JSON chunks, NPZ arrays, tar listings. All are ``binaryFile`` scans whose bytes are
parsed in Arrow batches, which Spark bounds by bytes; a broken file gives a row with an error, not a failed job."""

from __future__ import annotations

import io
import json
import struct
import tarfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GLB_MAGIC, GLB_VERSION, JSON_CHUNK = 0x46546C67, 2, 0x4E4F534A  # fixed by the file format


def glb_json(raw: bytes) -> dict:
    """The JSON chunk of a GLB file."""
    if len(raw) < 12:
        raise ValueError("too short")
    magic, version, length = struct.unpack_from("<III", raw)
    if magic != GLB_MAGIC:
        raise ValueError("not a GLB file")
    if version != GLB_VERSION:
        raise ValueError(f"version {version}")
    at = 12
    while at + 8 <= min(len(raw), length):
        size, kind = struct.unpack_from("<II", raw, at)
        if kind == JSON_CHUNK:
            return json.loads(raw[at + 8 : at + 8 + size].rstrip(b" \0").decode())
        at += 8 + size
    raise ValueError("no JSON chunk")


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "content")


def read_glb_json(spark: SparkSession, root: str, glob: str = "*.glb") -> DataFrame:
    """(path, json, error)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            rows = []
            for path, raw in zip(d["path"], d["content"], strict=True):
                try:
                    rows.append((path, json.dumps(glb_json(bytes(raw))), None))
                except (ValueError, struct.error) as e:
                    rows.append((path, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "json", "error"])

    return _files(spark, root, glob).mapInPandas(run, "path string, json string, error string")


GLB_SCHEMA = "meshes array<struct<primitives: array<string>>>, nodes array<struct<mesh: int>>"


def glb_counts(reports: DataFrame) -> DataFrame:
    """(path, num_meshes, num_primitives, num_mesh_nodes) of the files that parsed, from the JSON natively."""
    x = reports.where("error is null").withColumn("j", F.from_json("json", GLB_SCHEMA))
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    primitives = F.aggregate(F.coalesce("j.meshes", F.array()), F.lit(0).cast("long"), lambda s, m: s + size(m["primitives"]))
    return x.select("path", size("j.meshes").alias("num_meshes"), primitives.alias("num_primitives"), size(F.filter("j.nodes", lambda n: n["mesh"].isNotNull())).alias("num_mesh_nodes"))


def _arrays(raw: bytes, *names: str) -> list[np.ndarray]:
    with np.load(io.BytesIO(bytes(raw))) as z:
        return [z[n] for n in names]


#: What a broken file raises; anything else is a mistake of ours and ends the job.
BROKEN = (ValueError, KeyError, IndexError, OSError, EOFError, zipfile.BadZipFile, tarfile.TarError)


def read_mesh_sequences(spark: SparkSession, root: str, glob: str = "*.npz") -> tuple[DataFrame, DataFrame]:
    """Vertices (path, frame_pos, frame, vid, x, y, z, error) and faces (path, fid, a, b, c, error) of NPZ files with vertices [T,V,3], faces [F,3] and frame_indices [T].

    A broken file is one row of its path and the error.
    """
    files = _files(spark, root, glob)

    def each(d: pd.DataFrame, parse: Callable[[bytes], Iterator[dict]]) -> Iterator[pd.DataFrame]:
        for path, raw in zip(d["path"], d["content"], strict=True):
            try:
                for part in parse(raw):
                    yield pd.DataFrame({"path": path, **part, "error": None})
            except BROKEN as e:
                yield pd.DataFrame({"path": [path], "error": [f"{type(e).__name__}: {e}"]})

    def frames(raw: bytes) -> Iterator[dict]:
        v, at = _arrays(raw, "vertices", "frame_indices")
        if v.ndim != 3 or v.shape[2] != 3 or len(at) != len(v):
            raise ValueError(f"vertices of shape {v.shape} and {len(at)} frames")
        v = v.astype(np.float32)
        for t in range(len(v)):
            yield {"frame_pos": t, "frame": int(at[t]), "vid": np.arange(v.shape[1]), "x": v[t, :, 0], "y": v[t, :, 1], "z": v[t, :, 2]}

    def triangles(raw: bytes) -> Iterator[dict]:
        (f,) = _arrays(raw, "faces")
        yield {"fid": np.arange(len(f)), "a": f[:, 0], "b": f[:, 1], "c": f[:, 2]}

    def rows(parse: Callable, names: list[str]) -> Callable:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for d in batches:
                for made in each(d, parse):
                    yield made.reindex(columns=names)

        return run

    v, f = "path string, frame_pos int, frame int, vid int, x float, y float, z float, error string", "path string, fid int, a int, b int, c int, error string"
    name = lambda schema: [c.split()[0] for c in schema.split(", ")]
    return files.mapInPandas(rows(frames, name(v)), v), files.mapInPandas(rows(triangles, name(f)), f)


def tar_names(spark: SparkSession, root: str, glob: str = "*.tar") -> DataFrame:
    """(path, name, error): the members of tar files; a broken file's members up to the damage, then a row with the error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            rows = []
            for path, raw in zip(d["path"], d["content"], strict=True):
                try:
                    with tarfile.open(fileobj=io.BytesIO(bytes(raw))) as t:
                        rows += [(path, m.name, None) for m in t]
                except BROKEN as e:
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "name", "error"])

    return _files(spark, root, glob).mapInPandas(run, "path string, name string, error string")


def tar_objects(spark: SparkSession, root: str, glob: str = "*.tar") -> DataFrame:
    """Distinct first two parts of the names of tar members; what ``tar_names`` could not read gives none."""
    from gridloom.functions.ids import tar_name

    parts = F.split(tar_name(F.col("name")), "/")
    return tar_names(spark, root, glob).where(F.size(parts) >= 2).select(F.array_join(F.slice(parts, 1, 2), "/").alias("object")).distinct()


def write_sparse_sdf(sdf: DataFrame, signs: DataFrame, path: str) -> None:
    """The two tables of a signed distance field: (object_key, view, frame, code, sdf) and (object_key, view, frame, byte, bits), by object."""
    sdf.write.mode("overwrite").partitionBy("object_key").parquet(f"{path}/sdf")
    signs.write.mode("overwrite").partitionBy("object_key").parquet(f"{path}/sign")
