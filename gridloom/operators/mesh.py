"""Meshes as relations: vertices (mesh, vid, x, y, z), with ``frame`` for sequences, and faces (mesh, fid, a, b, c)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.components import components

XYZ = ["x", "y", "z"]
#: Vertices of a mesh that are packed in a row; one is found by going through them.
SMALL = 1000


def bounds(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """lx..hz of each key; partial boxes merge the same way."""
    return vertices.groupBy(*keys).agg(*[F.min(a).alias(f"l{a}") for a in XYZ], *[F.max(a).alias(f"h{a}") for a in XYZ])


def merge_bounds(boxes: DataFrame, keys: list[str]) -> DataFrame:
    return boxes.groupBy(*keys).agg(*[F.min(f"l{a}").alias(f"l{a}") for a in XYZ], *[F.max(f"h{a}").alias(f"h{a}") for a in XYZ])


def normalize(vertices: DataFrame, keys: list[str], scale: float = 0.95, mode: str = "box") -> DataFrame:
    """Vertices moved to the centre of their box and scaled: the longest side to 2*scale (box), the farthest vertex to scale (sphere), all sides to one unit box (unit).

    Two aggregates at most; boxes join back by key, in a merge of sorted rows: vertices are often made by an explode, which
    Spark's estimate of sizes leaves out, so it would send all of them to the driver to broadcast.
    """
    box = bounds(vertices, keys)
    centre = {f"m{a}": (F.col(f"l{a}") + F.col(f"h{a}")) / 2 for a in XYZ}
    box = box.withColumns(centre).withColumn("side", F.greatest(*[F.col(f"h{a}") - F.col(f"l{a}") for a in XYZ]))
    x = vertices.join(box.hint("merge"), keys)
    moved = {a: F.col(a) - F.col(f"m{a}") for a in XYZ}
    if mode == "box":
        by = F.when(F.col("side") > 0, 2 * scale / F.nullif(F.col("side"), F.lit(0.0))).otherwise(1.0)
    elif mode == "unit":
        by = F.when(F.col("side") > 0, 1 / F.nullif(F.col("side"), F.lit(0.0))).otherwise(1.0)
    elif mode == "sphere":
        far = x.withColumns(moved).groupBy(*keys).agg(F.max(F.sqrt(sum((F.col(a) * F.col(a) for a in XYZ), F.lit(0.0)))).alias("far"))
        x = x.join(far.hint("merge"), keys)
        by = F.when(F.col("far") > 0, scale / F.nullif(F.col("far"), F.lit(0.0))).otherwise(1.0)
    else:
        raise ValueError(f"unknown mode {mode}")
    out = x.withColumns({a: moved[a] * by for a in XYZ})
    return out.select(*vertices.columns)


def normalize_sequence(vertices: DataFrame, key: str = "mesh", scale: float = 0.95, per_frame_centre: bool = False) -> DataFrame:
    """One scale for all frames of a mesh; one centre for all, or each frame's own. Joins are merges, as in ``normalize``."""
    one = bounds(vertices, [key]).select(key, F.greatest(*[F.col(f"h{a}") - F.col(f"l{a}") for a in XYZ]).alias("side"), *[((F.col(f"l{a}") + F.col(f"h{a}")) / 2).alias(f"m{a}") for a in XYZ])
    x = vertices
    if per_frame_centre:
        own = bounds(vertices, [key, "frame"])
        one = own.groupBy(key).agg(F.max(F.greatest(*[F.col(f"h{a}") - F.col(f"l{a}") for a in XYZ])).alias("side")).join(own.select(key, "frame", *[((F.col(f"l{a}") + F.col(f"h{a}")) / 2).alias(f"m{a}") for a in XYZ]).hint("merge"), key)
        x = x.join(one.hint("merge"), [key, "frame"])
    else:
        x = x.join(one.hint("merge"), key)
    by = F.when(F.col("side") > 0, 2 * scale / F.nullif(F.col("side"), F.lit(0.0))).otherwise(1.0)  # a mesh of one place stays as large
    return x.withColumns({a: (F.col(a) - F.col(f"m{a}")) * by for a in XYZ}).select(*vertices.columns)


def affine(rotation: list[list[float]], shift: list[float]) -> dict[str, Column]:
    """x, y, z after a matrix and a shift."""
    return {a: sum((F.col(b) * r for b, r in zip(XYZ, row, strict=True)), F.lit(float(t))) for a, row, t in zip(XYZ, rotation, shift, strict=True)}


def merge_objects(vertices: DataFrame, faces: DataFrame, key: str = "mesh", part: str = "part") -> tuple[DataFrame, DataFrame]:
    """Objects of a mesh as one: vertex ids and face corners moved by the vertices of the parts before."""
    n = vertices.groupBy(key, part).agg((F.max("vid") + 1).alias("n"))
    offset = F.coalesce(F.sum("n").over(Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = n.select(key, part, offset.alias("o"))
    v = vertices.join(n, [key, part]).withColumn("vid", F.col("vid") + F.col("o")).drop("o")
    f = faces.join(n, [key, part]).withColumns({c: F.col(c) + F.col("o") for c in "abc"}).drop("o")
    return v, f


def edges(faces: DataFrame, key: str = "mesh") -> DataFrame:
    """(mesh, fid, u, v): three undirected edges of each face, u <= v."""
    three = F.array(*[F.struct(F.least(p, q).alias("u"), F.greatest(p, q).alias("v")) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))])
    return faces.select(key, "fid", F.explode(three).alias("e")).select(key, "fid", "e.u", "e.v")


def edge_counts(faces: DataFrame, key: str = "mesh") -> DataFrame:
    return edges(faces, key).groupBy(key, "u", "v").agg(F.count("*").alias("n"))


def boundary_edges(faces: DataFrame, key: str = "mesh") -> DataFrame:
    """Edges of one face only."""
    return edge_counts(faces, key).where("n = 1").drop("n")


def dual_edges(faces: DataFrame, key: str = "mesh") -> DataFrame:
    """(mesh, src, dst): faces that share an edge, by the edge and not by pairs of faces: neighbours in order of fid."""
    w = Window.partitionBy(key, "u", "v").orderBy("fid")
    x = edges(faces, key).select(key, F.col("fid").alias("dst"), F.lag("fid").over(w).alias("src"))
    return x.where("src is not null and src <> dst").select(key, "src", "dst").distinct()


def face_components(faces: DataFrame, key: str = "mesh") -> DataFrame:
    """(mesh, fid, component): the least fid reachable over shared edges; a face without neighbours is its own."""
    node = lambda c: F.struct(F.col(key).alias("k"), F.col(c).alias("f"))
    found = components(dual_edges(faces, key).select(node("src").alias("a"), node("dst").alias("b")))
    found = found.select(F.col("node.k").alias(key), F.col("node.f").alias("fid"), F.col("component.f").alias("component"))
    return faces.select(key, "fid").join(found, [key, "fid"], "left").withColumn("component", F.coalesce("component", "fid"))


def vertex_degree(vertices: DataFrame, faces: DataFrame, key: str = "mesh") -> DataFrame:
    """(mesh, vid, degree): faces at each vertex, 0 for isolated ones."""
    n = faces.select(key, F.explode(F.array("a", "b", "c")).alias("vid")).groupBy(key, "vid").agg(F.count("*").alias("degree"))
    return vertices.select(key, "vid").join(n, [key, "vid"], "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def topology_hash(faces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, digest): the same for the same set of triangles, whatever the order of corners, faces or rows.

    Digests of triangles are added up, not gathered: 96 bits of sums for a mesh of any size.
    """
    corners = F.array_sort(F.array("a", "b", "c"))
    h = F.sha1(F.concat_ws(",", F.transform(corners, lambda v: v.cast("string"))))
    part = lambda k: F.sum(F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long"))
    return faces.groupBy(*keys).agg(F.count("*").alias("n"), F.concat_ws("-", *[part(k).cast("string") for k in range(3)]).alias("digest"))


def shared_topology(faces: DataFrame, key: str = "mesh") -> DataFrame:
    """(mesh, shared): whether all frames have the same triangles."""
    return topology_hash(faces, [key, "frame"]).groupBy(key).agg((F.count_distinct("digest") == 1).alias("shared"))


def corners(faces: DataFrame, vertices: DataFrame, key: str = "mesh", small: int = SMALL) -> DataFrame:
    """Faces with the places of their corners: ax, ay, ... cz; other columns of the vertices likewise.

    The vertices of a mesh of up to ``small`` are packed in one row, so its faces move once, to that row. Those of larger
    meshes, or where a vertex repeats, are joined once for each corner. All joins are merges, as in ``normalize``.
    """
    more = [c for c in vertices.columns if c not in (key, "vid")]
    n = vertices.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") <= small).select(key)
    packed = vertices.where("vid is not null").join(n.hint("merge"), key).groupBy(key).agg(F.collect_list(F.struct("vid", *more)).alias("__v"))
    packed = packed.where(F.size(F.array_distinct("__v.vid")) == F.size("__v"))
    at = F.map_from_arrays("__v.vid", "__v").alias("__at")
    x = faces.join(packed.select(key, at).hint("merge"), key).select(*faces.columns, *[F.try_element_at("__at", F.col(c).cast(vertices.schema["vid"].dataType)).alias(f"__{c}") for c in "abc"])
    x = x.where(" and ".join(f"__{c} is not null" for c in "abc")).select(*faces.columns, *[F.col(f"__{c}.{a}").alias(f"{c}{a}") for c in "abc" for a in more])
    rest, others = (d.join(packed.select(key).hint("merge"), key, "left_anti") for d in (faces, vertices))
    for c in "abc":
        v = others.select(key, F.col("vid").alias(c), *[F.col(a).alias(f"{c}{a}") for a in more])
        rest = rest.join(v.hint("merge"), [key, c])
    return x.unionByName(rest)


def edge_length(p: str, q: str) -> Column:
    return F.sqrt(sum(((F.col(p + a) - F.col(q + a)) * (F.col(p + a) - F.col(q + a)) for a in XYZ), F.lit(0.0)))


def area(prefix: str = "abc") -> Column:
    a, b, c = prefix
    u, v = [[F.col(p + s) - F.col(a + s) for s in XYZ] for p in (b, c)]
    n = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    return 0.5 * F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])


def triangle_stats(faces: DataFrame, vertices: DataFrame, key: str = "mesh") -> DataFrame:
    """Faces, degenerate ones, and the ratio of longest to shortest edge: greatest, mean, and how many are over 100 and 1000."""
    x = corners(faces, vertices, key)
    e = [edge_length(p, q) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))]
    degenerate = (F.col("a") == F.col("b")) | (F.col("b") == F.col("c")) | (F.col("c") == F.col("a"))
    x = x.withColumn("ratio", F.when(F.least(*e) > 1e-12, F.greatest(*e) / F.nullif(F.least(*e), F.lit(0.0))))
    return x.groupBy(key).agg(
        F.count("*").alias("faces"), F.count_if(degenerate).alias("degenerate"), F.max("ratio").alias("max_ratio"), F.avg("ratio").alias("mean_ratio"),
        F.count_if(F.col("ratio") > 100).alias("elongated"), F.count_if(F.col("ratio") > 1000).alias("very_elongated"),
    )


def duplicate_vertices(vertices: DataFrame, key: str = "mesh") -> DataFrame:
    return vertices.groupBy(key).agg((F.count("*") - F.count_distinct(*XYZ)).alias("duplicates"))


def health(vertices: DataFrame, faces: DataFrame, key: str = "mesh", high: int = 20) -> DataFrame:
    """One row for each mesh: counts of isolated and high-degree vertices, duplicates, boundary edges, degenerate faces, and a verdict."""
    d = vertex_degree(vertices, faces, key).groupBy(key).agg(F.count("*").alias("vertices"), F.count_if(F.col("degree") == 0).alias("isolated"), F.count_if(F.col("degree") > high).alias("high_degree"))
    e = edge_counts(faces, key).groupBy(key).agg(F.count_if(F.col("n") == 1).alias("boundary"), F.count_if(F.col("n") > 2).alias("non_manifold"))
    out = d.join(duplicate_vertices(vertices, key), key).join(e, key, "left").join(triangle_stats(faces, vertices, key).select(key, "faces", "degenerate"), key, "left").fillna(0)
    return out.withColumn("verdict", F.when(F.col("faces") == 0, "empty").when(F.col("degenerate") > 0, "degenerate").when(F.col("non_manifold") > 0, "non_manifold").when(F.col("boundary") > 0, "open").otherwise("ok"))


def sharp_vertices(faces: DataFrame, vertices: DataFrame, normals: DataFrame, least: float = 0.985, key: str = "mesh", small: int = SMALL) -> DataFrame:
    """(mesh, vid, least_dot, sharp): least cosine of a vertex normal and the normals of its faces.

    Normals go with the corners, so that a face's normal does not move once for each of them.
    """
    normals = normals.select(key, "vid", "nx", "ny", "nz", F.lit(True).alias("has"))
    both = vertices.select(key, "vid", *XYZ).join(normals.hint("merge"), [key, "vid"], "left")
    x = corners(faces, both, key, small)
    u, v = [[F.col(p + s) - F.col("a" + s) for s in XYZ] for p in ("b", "c")]
    n = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    size = F.greatest(F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]), F.lit(1e-12))
    x = x.withColumns({f"f{a}": c / size for c, a in zip(n, XYZ, strict=True)})
    corner = lambda c: F.struct(F.col(c).alias("vid"), F.col(f"{c}has").alias("has"), sum((F.col(f"f{a}") * F.col(f"{c}n{a}") for a in XYZ), F.lit(0.0)).alias("dot"))
    y = x.select(key, F.explode(F.array(*map(corner, "abc"))).alias("p")).where("p.has")
    return y.groupBy(key, F.col("p.vid").alias("vid")).agg(F.min("p.dot").alias("least_dot")).withColumn("sharp", F.col("least_dot") < least)


def sample_by_weight(rows: DataFrame, draws: DataFrame, weight: str, order: str, key: str = "mesh") -> DataFrame:
    """Each draw (mesh, draw, u) with the row whose share of the running weight holds u: an inverse distribution function.

    Rows and draws are merged into one order and the draw takes the next row's, so there is no range join.
    Where the weights of a mesh sum to 0 no row can be drawn: picked is null.
    """
    w = Window.partitionBy(key)
    x = rows.withColumn("hi", F.sum(weight).over(w.orderBy(order)) / F.nullif(F.sum(weight).over(w), F.lit(0))).select(key, "hi", F.col(order).cast("long").alias("picked"), F.lit(None).cast("long").alias("draw"))
    y = draws.select(key, F.col("u").alias("hi"), F.lit(None).cast("long").alias("picked"), F.col("draw").cast("long").alias("draw"))
    # a draw comes before a row of the same share
    nxt = F.first("picked", ignorenulls=True).over(w.orderBy("hi", F.col("draw").isNull()).rowsBetween(0, Window.unboundedFollowing))
    return x.unionByName(y).withColumn("picked", nxt).where("draw is not null").select(key, "draw", "picked")


def barycentric(u: Column, v: Column) -> tuple[Column, Column, Column]:
    """Weights of a triangle's corners, uniform over its area for uniform u and v."""
    r = F.sqrt(u)
    return 1 - r, r * (1 - v), r * v


def covariance_sums(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Fifteen sums and the count of corresponding points (x, y, z) and (tx, ty, tz): all that a similarity fit needs but errors."""
    t = [f"t{a}" for a in XYZ]
    return pairs.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"s_{c}") for c in [*XYZ, *t]], *[F.sum(F.col(p) * F.col(q)).alias(f"s_{q}_{p}") for p in XYZ for q in t],
        F.sum(sum((F.col(a) * F.col(a) for a in XYZ), F.lit(0.0))).alias("s_xx"), F.sum(sum((F.col(a) * F.col(a) for a in t), F.lit(0.0))).alias("s_tt"),
    )


def similarity_fit(pairs: DataFrame, keys: list[str], with_scale: bool = True) -> DataFrame:
    """keys, scale, rotation (9, by rows), shift (3), rms, max_error of the best t = scale * R * p + shift; R is a rotation.

    Sums are native; a 3x3 singular value decomposition of each key's sums runs in Arrow batches; then errors are native.
    """
    sums = covariance_sums(pairs, keys)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            out = {"scale": [], "rotation": [], "shift": []}
            for r in d.to_dict("records"):
                n = r["n"]
                mx, mt = (np.array([r[f"s_{p}{a}"] for a in XYZ]) / n for p in ("", "t"))
                cov = np.array([[r[f"s_t{q}_{p}"] for p in XYZ] for q in XYZ]) / n - np.outer(mt, mx)
                left, values, right = np.linalg.svd(cov)
                sign = np.array([1.0, 1.0, -1.0 if np.linalg.det(left) * np.linalg.det(right) < 0 else 1.0])
                rot = left @ np.diag(sign) @ right
                s = float((values * sign).sum() / max(r["s_xx"] / n - mx @ mx, 1e-15)) if with_scale else 1.0
                out["scale"].append(s)
                out["rotation"].append(rot.ravel().tolist())
                out["shift"].append((mt - s * rot @ mx).tolist())
            yield pd.concat([d[keys].reset_index(drop=True), pd.DataFrame(out)], axis=1)

    kinds = {f.name: f.dataType.simpleString() for f in sums.schema.fields}
    fits = sums.mapInPandas(solve, ", ".join([*[f"{k} {kinds[k]}" for k in keys], "scale double, rotation array<double>, shift array<double>"]))
    got = lambda i: sum((F.col("scale") * F.get("rotation", F.lit(3 * i + j)) * F.col(a) for j, a in enumerate(XYZ)), F.get("shift", F.lit(i)))
    err = F.sqrt(sum(((got(i) - F.col(f"t{a}")) * (got(i) - F.col(f"t{a}")) for i, a in enumerate(XYZ)), F.lit(0.0)))
    e = pairs.join(fits, keys).withColumn("e", err).groupBy(*keys).agg(F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rms"), F.max("e").alias("max_error"))
    return fits.join(e, keys)


def tight_distance(boxes: DataFrame, right: list[float], up: list[float], forward: list[float], half_angle: float, keys: list[str]) -> DataFrame:
    """(keys, distance): the least distance from which a camera of a field of view sees all corners of the centred box."""
    from gridloom.functions.arrays import box_corners

    low, high = ([F.col(f"{s}{a}") - (F.col(f"l{a}") + F.col(f"h{a}")) / 2 for a in XYZ] for s in "lh")
    x = boxes.select(*keys, F.explode(box_corners(low, high)).alias("p"))
    along = lambda w: sum((F.col(f"p.{a}") * float(v) for a, v in zip(XYZ, w, strict=True)), F.lit(0.0))
    need = F.greatest(F.abs(along(right)), F.abs(along(up))) / F.tan(F.lit(half_angle)) - along(forward)
    return x.groupBy(*keys).agg(F.max(need).alias("distance"))


def target_and_radius(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Centre of the box and one and a half of its diagonal, a thousandth at least."""
    diagonal = F.sqrt(sum(((F.col(f"h{a}") - F.col(f"l{a}")) * (F.col(f"h{a}") - F.col(f"l{a}")) for a in XYZ), F.lit(0.0)))
    return boxes.select(*keys, *[((F.col(f"l{a}") + F.col(f"h{a}")) / 2).alias(f"t{a}") for a in XYZ], F.greatest(1.5 * diagonal, F.lit(1e-3)).alias("radius"))


def valid_boxes(boxes: DataFrame, least: float = 1e-6) -> DataFrame:
    volume = (F.col("hx") - F.col("lx")) * (F.col("hy") - F.col("ly")) * (F.col("hz") - F.col("lz"))
    return boxes.withColumn("valid", F.coalesce(volume >= least, F.lit(False)))


def largest_object(faces: DataFrame, key: str = "mesh", part: str = "part") -> DataFrame:
    """(mesh, part, n): the part of most faces, the first of equals."""
    n = faces.groupBy(key, part).agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), part))).where("r = 1").drop("r")


def occupancy(voxels: DataFrame, factor: int = 8) -> DataFrame:
    """Distinct coarse cells."""
    return voxels.select("b", *[F.floor(F.col(a) / factor).cast("long").alias(a) for a in XYZ]).distinct()
