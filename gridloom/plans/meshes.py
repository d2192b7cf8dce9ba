"""Mesh and geometry queries on lineitem, part and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import arrays as A
from gridloom.operators import mesh as G
from gridloom.plans.registry import MESHES, VOXELS, Tables, faces, query, vertices, voxels

XYZ = ["x", "y", "z"]


def _round(df: DataFrame, names: list[str], digits: int = 5) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("SELECT o_custkey, min(o_totalprice) AS lx, max(o_totalprice) AS hx FROM orders GROUP BY 1")
def mesh_bounds(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_custkey", *[F.col("o_totalprice").alias(a) for a in XYZ], (F.col("o_orderkey") % 3).alias("part"))
    return G.merge_bounds(G.bounds(o, ["o_custkey", "part"]), ["o_custkey"]).select("o_custkey", "lx", "hx")


_BOX = "b AS (SELECT mesh, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM verts GROUP BY mesh)"
_MOVED = "(x - (lx + hx) / 2) AS x, (y - (ly + hy) / 2) AS y, (z - (lz + hz) / 2) AS z"


@query(f"WITH {MESHES}, {_BOX}, m AS (SELECT mesh, vid, {_MOVED}, greatest(hx - lx, hy - ly, hz - lz) AS side FROM verts JOIN b USING (mesh)) SELECT mesh, vid, round(x * 1.9 / side, 5) AS x, round(y * 1.9 / side, 5) AS y, round(z * 1.9 / side, 5) AS z FROM m")
def mesh_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _round(G.normalize(vertices(Tables(spark, sf)), ["mesh"]), XYZ)


@query(f"WITH {MESHES}, {_BOX}, m AS (SELECT mesh, vid, {_MOVED} FROM verts JOIN b USING (mesh)), s AS (SELECT mesh, max(sqrt(x * x + y * y + z * z)) AS f FROM m GROUP BY mesh) SELECT mesh, vid, round(x * 0.95 / f, 5) AS x, round(y * 0.95 / f, 5) AS y, round(z * 0.95 / f, 5) AS z FROM m JOIN s USING (mesh)")
def mesh_normalize_sphere(spark: SparkSession, sf: str) -> DataFrame:
    return _round(G.normalize(vertices(Tables(spark, sf)), ["mesh"], mode="sphere"), XYZ)


def _sequence(spark: SparkSession, sf: str) -> DataFrame:
    v = vertices(Tables(spark, sf)).withColumn("frame", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    return v.withColumns({"x": F.col("x") + F.col("frame") * 3, "z": F.col("z") * (F.col("frame") + 1)})


_SEQ = f"{MESHES}, sq AS (SELECT mesh, vid, f AS frame, x + f * 3 AS x, y, z * (f + 1) AS z FROM verts, range(4) r(f))"


@query(f"WITH {_SEQ}, b AS (SELECT mesh, min(x) AS lx, max(x) AS hx, min(z) AS lz, max(z) AS hz, max(y) - min(y) AS wy FROM sq GROUP BY mesh) SELECT mesh, frame, vid, round((x - (lx + hx) / 2) * 1.9 / greatest(hx - lx, hz - lz, wy), 5) AS x, round((z - (lz + hz) / 2) * 1.9 / greatest(hx - lx, hz - lz, wy), 5) AS z FROM sq JOIN b USING (mesh)")
def mesh_normalize_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return _round(G.normalize_sequence(_sequence(spark, sf)), ["x", "z"]).select("mesh", "frame", "vid", "x", "z")


@query(f"WITH {_SEQ}, b AS (SELECT mesh, frame, min(x) AS lx, max(x) AS hx, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS side FROM sq GROUP BY mesh, frame), s AS (SELECT mesh, max(side) AS side FROM b GROUP BY mesh) SELECT sq.mesh, sq.frame, vid, round((x - (lx + hx) / 2) * 1.9 / s.side, 5) AS x FROM sq JOIN b USING (mesh, frame) JOIN s ON s.mesh = sq.mesh")
def mesh_normalize_frames(spark: SparkSession, sf: str) -> DataFrame:
    return _round(G.normalize_sequence(_sequence(spark, sf), per_frame_centre=True), ["x"]).select("mesh", "frame", "vid", "x")


@query(f"WITH {MESHES} SELECT mesh, vid, round(-y + 1, 5) AS x, round(x + 2, 5) AS y, round(z * 0.5 + 3, 5) AS z FROM verts")
def mesh_affine(spark: SparkSession, sf: str) -> DataFrame:
    return _round(vertices(Tables(spark, sf)).withColumns(G.affine([[0, -1, 0], [1, 0, 0], [0, 0, 0.5]], [1, 2, 3])), XYZ)


@query(f"WITH {MESHES}, p AS (SELECT 0 AS mesh, mesh AS part, vid + mesh * 97 AS vid, x FROM verts), f AS (SELECT 0 AS mesh, mesh AS part, fid, a + mesh * 97 AS a, b + mesh * 97 AS b, c + mesh * 97 AS c FROM faces) SELECT part, fid, a, b, c, p.x AS ax FROM f JOIN p USING (part) WHERE p.vid = f.a")
def mesh_merge_objects(spark: SparkSession, sf: str) -> DataFrame:
    zero = F.lit(0).cast("long").alias("mesh")
    v, f = G.merge_objects(vertices(Tables(spark, sf)).select(zero, F.col("mesh").alias("part"), "vid", *XYZ), faces(Tables(spark, sf)).select(zero, F.col("mesh").alias("part"), "fid", "a", "b", "c"))
    return f.join(v.select(F.col("vid").alias("a"), F.col("x").alias("ax")), "a").select("part", "fid", "a", "b", "c", "ax")


_EDGES = "e AS (SELECT mesh, fid, least(a, b) AS u, greatest(a, b) AS v FROM faces UNION ALL SELECT mesh, fid, least(b, c), greatest(b, c) FROM faces UNION ALL SELECT mesh, fid, least(a, c), greatest(a, c) FROM faces)"


@query(f"WITH {MESHES}, {_EDGES} SELECT mesh, u, v, count(*) AS n FROM e GROUP BY ALL")
def mesh_edge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return G.edge_counts(faces(Tables(spark, sf)))


@query(f"WITH {MESHES}, {_EDGES} SELECT mesh, u, v FROM e GROUP BY ALL HAVING count(*) = 1")
def mesh_boundary_edges(spark: SparkSession, sf: str) -> DataFrame:
    return G.boundary_edges(faces(Tables(spark, sf)))


@query(f"WITH {MESHES}, {_EDGES}, l AS (SELECT mesh, fid AS dst, lag(fid) OVER (PARTITION BY mesh, u, v ORDER BY fid) AS src FROM e) SELECT DISTINCT mesh, src, dst FROM l WHERE src IS NOT NULL AND src <> dst")
def mesh_dual_edges(spark: SparkSession, sf: str) -> DataFrame:
    return G.dual_edges(faces(Tables(spark, sf)))


@query()
def mesh_components(spark: SparkSession, sf: str) -> DataFrame:
    """Components over every face; recursive SQL is too slow on whole tables, so the tests hold it against brute force."""
    return G.face_components(faces(Tables(spark, sf)))


@query(f"WITH {MESHES}, c AS (SELECT mesh, unnest([a, b, c]) AS vid FROM faces), d AS (SELECT mesh, vid, count(*) AS degree FROM c GROUP BY ALL) SELECT mesh, vid, coalesce(degree, 0) AS degree FROM verts LEFT JOIN d USING (mesh, vid)")
def mesh_vertex_degree(spark: SparkSession, sf: str) -> DataFrame:
    return G.vertex_degree(vertices(Tables(spark, sf)), faces(Tables(spark, sf)))


@query(f"""WITH {MESHES}, h AS (SELECT mesh, sha1(array_to_string(list_sort([a, b, c]), ',')) AS h FROM faces)
SELECT mesh, count(*) AS n, {" || '-' || ".join(f"sum(('0x' || substr(h, {1 + 8 * k}, 8))::BIGINT)::BIGINT::VARCHAR" for k in range(3))} AS digest FROM h GROUP BY mesh""")
def mesh_topology_hash(spark: SparkSession, sf: str) -> DataFrame:
    return G.topology_hash(faces(Tables(spark, sf)), ["mesh"])


@query(f"WITH {MESHES} SELECT mesh, mesh % 2 = 0 AS shared FROM faces GROUP BY mesh")
def mesh_shared_topology(spark: SparkSession, sf: str) -> DataFrame:
    f = faces(Tables(spark, sf)).withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(2))))
    turned = f.select("mesh", "fid", "frame", F.col("b").alias("a"), F.when((F.col("mesh") % 2 == 1) & (F.col("frame") == 2), F.col("c") + 1).otherwise(F.col("c")).alias("b"), F.col("a").alias("c"))
    return G.shared_topology(turned)


_CORNERS = "k AS (SELECT f.mesh, fid, f.a, f.b, f.c, p.x AS ax, p.y AS ay, p.z AS az, q.x AS bx, q.y AS by_, q.z AS bz, r.x AS cx, r.y AS cy, r.z AS cz FROM faces f JOIN verts p ON p.mesh = f.mesh AND p.vid = f.a JOIN verts q ON q.mesh = f.mesh AND q.vid = f.b JOIN verts r ON r.mesh = f.mesh AND r.vid = f.c)"
_LENGTHS = "d AS (SELECT mesh, a, b, c, sqrt((ax - bx) ** 2 + (ay - by_) ** 2 + (az - bz) ** 2) AS e1, sqrt((bx - cx) ** 2 + (by_ - cy) ** 2 + (bz - cz) ** 2) AS e2, sqrt((cx - ax) ** 2 + (cy - ay) ** 2 + (cz - az) ** 2) AS e3 FROM k), t AS (SELECT *, CASE WHEN least(e1, e2, e3) > 1e-12 THEN greatest(e1, e2, e3) / least(e1, e2, e3) END AS q FROM d)"


@query(f"WITH {MESHES}, {_CORNERS}, {_LENGTHS} SELECT mesh, count(*) AS faces, count(CASE WHEN a = b OR b = c OR c = a THEN 1 END) AS degenerate, round(max(q), 5) AS max_ratio, round(avg(q), 5) AS mean_ratio, count(CASE WHEN q > 100 THEN 1 END) AS elongated, count(CASE WHEN q > 1000 THEN 1 END) AS very_elongated FROM t GROUP BY mesh")
def mesh_triangle_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _round(G.triangle_stats(faces(Tables(spark, sf)), vertices(Tables(spark, sf))), ["max_ratio", "mean_ratio"])


@query(f"""WITH {MESHES}, {_EDGES}, g AS (SELECT mesh, vid, count(c) AS degree FROM verts LEFT JOIN (SELECT mesh, unnest([a, b, c]) AS vid, 1 AS c FROM faces) USING (mesh, vid) GROUP BY ALL),
s AS (SELECT mesh, count(*) AS vertices, count(CASE WHEN degree = 0 THEN 1 END) AS isolated, count(CASE WHEN degree > 20 THEN 1 END) AS high_degree FROM g GROUP BY mesh),
n AS (SELECT mesh, u, v, count(*) AS n FROM e GROUP BY ALL), w AS (SELECT mesh, count(CASE WHEN n = 1 THEN 1 END) AS boundary, count(CASE WHEN n > 2 THEN 1 END) AS non_manifold FROM n GROUP BY mesh),
z AS (SELECT mesh, count(*) AS faces, count(CASE WHEN a = b OR b = c OR c = a THEN 1 END) AS degenerate FROM faces GROUP BY mesh), u AS (SELECT mesh, count(*) - count(DISTINCT (x, y, z)) AS duplicates FROM verts GROUP BY mesh)
SELECT mesh, vertices, isolated, high_degree, duplicates, boundary, non_manifold, faces, degenerate, CASE WHEN degenerate > 0 THEN 'degenerate' WHEN non_manifold > 0 THEN 'non_manifold' WHEN boundary > 0 THEN 'open' ELSE 'ok' END AS verdict FROM s JOIN u USING (mesh) JOIN w USING (mesh) JOIN z USING (mesh)""")
def mesh_health(spark: SparkSession, sf: str) -> DataFrame:
    return G.health(vertices(Tables(spark, sf)), faces(Tables(spark, sf)))


@query(f"""WITH {MESHES}, {_CORNERS}, m AS (SELECT *, (by_ - ay) * (cz - az) - (bz - az) * (cy - ay) AS nx, (bz - az) * (cx - ax) - (bx - ax) * (cz - az) AS ny, (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax) AS nz FROM k),
c AS (SELECT mesh, unnest([a, b, c]) AS vid, nz / greatest(sqrt(nx * nx + ny * ny + nz * nz), 1e-12) AS d FROM m) SELECT mesh, vid, round(min(d), 5) AS least_dot, min(d) < 0.985 AS sharp FROM c GROUP BY ALL""")
def mesh_sharp_vertices(spark: SparkSession, sf: str) -> DataFrame:
    v = vertices(Tables(spark, sf))
    normals = v.select("mesh", "vid", F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), F.lit(1.0).alias("nz"))
    return _round(G.sharp_vertices(faces(Tables(spark, sf)), v, normals), ["least_dot"])


@query(f"WITH {MESHES}, n AS (SELECT mesh, fid % 50 AS part, count(*) AS n FROM faces GROUP BY ALL) SELECT mesh, part, n FROM (SELECT *, row_number() OVER (PARTITION BY mesh ORDER BY n DESC, part) AS r FROM n) WHERE r = 1")
def mesh_largest_object(spark: SparkSession, sf: str) -> DataFrame:
    return G.largest_object(faces(Tables(spark, sf)).withColumn("part", F.col("fid") % 50))


@query("""WITH w AS (SELECT p_size AS mesh, p_partkey AS fid, (p_partkey % 13 + 1)::DOUBLE AS w FROM part), r AS (SELECT *, sum(w) OVER (PARTITION BY mesh ORDER BY fid) / sum(w) OVER (PARTITION BY mesh) AS hi, coalesce(sum(w) OVER (PARTITION BY mesh ORDER BY fid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(w) OVER (PARTITION BY mesh) AS lo FROM w),
d AS (SELECT DISTINCT p_size AS mesh, i AS draw, (i * 7 % 11 + 0.37) / 11 AS u FROM part, range(20) g(i)) SELECT d.mesh, d.draw, r.fid AS picked FROM d JOIN r ON d.mesh = r.mesh AND u > lo AND u <= hi""")
def mesh_sample_by_weight(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).part
    rows = p.select(F.col("p_size").alias("mesh"), F.col("p_partkey").alias("fid"), (F.col("p_partkey") % 13 + 1).cast("double").alias("w"))
    draws = p.select(F.col("p_size").alias("mesh")).distinct().withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(19)))).withColumn("u", (F.col("draw") * 7 % 11 + 0.37) / 11)
    return G.sample_by_weight(rows, draws, "w", "fid")


@query(f"WITH {MESHES}, {_CORNERS}, m AS (SELECT *, (by_ - ay) * (cz - az) - (bz - az) * (cy - ay) AS nx, (bz - az) * (cx - ax) - (bx - ax) * (cz - az) AS ny, (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax) AS nz FROM k) SELECT mesh, fid, round(0.5 * sqrt(nx * nx + ny * ny + nz * nz), 4) AS area, round((1 - sqrt(0.3)) * ax + sqrt(0.3) * 0.4 * bx + 0.6 * sqrt(0.3) * cx, 4) AS px FROM m")
def mesh_area_and_point(spark: SparkSession, sf: str) -> DataFrame:
    x = G.corners(faces(Tables(spark, sf)), vertices(Tables(spark, sf)))
    u, v, w = G.barycentric(F.lit(0.3), F.lit(0.6))
    return x.select("mesh", "fid", F.round(G.area(), 4).alias("area"), F.round(u * F.col("ax") + v * F.col("bx") + w * F.col("cx"), 4).alias("px"))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Vertices and their place after a known similarity: scale 2, a quarter turn about z, shift (1, -2, 3 + mesh)."""
    return vertices(Tables(spark, sf)).withColumns({"tx": -2 * F.col("y") + 1, "ty": 2 * F.col("x") - 2, "tz": 2 * F.col("z") + 3 + F.col("mesh")})


@query("SELECT m AS mesh, 2.0 AS scale, '0,-1,0,1,0,0,0,0,1' AS rotation, '1,-2,' || (3 + m) AS shift, 0.0 AS rms, 0.0 AS max_error FROM (SELECT s_suppkey AS m FROM supplier)")
def mesh_similarity_fit(spark: SparkSession, sf: str) -> DataFrame:
    x = G.similarity_fit(_pairs(spark, sf), ["mesh"])
    whole = lambda c: F.array_join(F.transform(c, lambda v: F.round(v, 4).cast("long").cast("string")), ",")
    return x.select("mesh", F.round("scale", 4).alias("scale"), whole("rotation").alias("rotation"), whole("shift").alias("shift"), F.abs(F.round("rms", 4)).alias("rms"), F.abs(F.round("max_error", 4)).alias("max_error"))


@query(f"WITH {MESHES} SELECT mesh, count(*) AS n, round(sum(x), 3) AS s_x, round(sum(-2 * y + 1), 3) AS s_tx, round(sum((-2 * y + 1) * x), 3) AS s_tx_x, round(sum(x * x + y * y + z * z), 3) AS s_xx FROM verts GROUP BY mesh")
def mesh_covariance_sums(spark: SparkSession, sf: str) -> DataFrame:
    return _round(G.covariance_sums(_pairs(spark, sf), ["mesh"]), ["s_x", "s_tx", "s_tx_x", "s_xx"], 3).select("mesh", "n", "s_x", "s_tx", "s_tx_x", "s_xx")


@query(f"WITH {MESHES}, {_BOX} SELECT mesh, (lx + hx) / 2 AS tx, (ly + hy) / 2 AS ty, (lz + hz) / 2 AS tz, round(1.5 * sqrt((hx - lx) ** 2 + (hy - ly) ** 2 + (hz - lz) ** 2), 5) AS radius, (hx - lx) * (hy - ly) * (hz - lz) >= 1e-6 AS valid, round(greatest((hx - lx) / 2, (hz - lz) / 2) / tan(0.35) + (hy - ly) / 2, 5) AS distance FROM b")
def camera_target(spark: SparkSession, sf: str) -> DataFrame:
    box = G.bounds(vertices(Tables(spark, sf)), ["mesh"])
    d = G.tight_distance(box, [1, 0, 0], [0, 0, 1], [0, 1, 0], 0.35, ["mesh"])
    x = G.target_and_radius(box, ["mesh"]).join(G.valid_boxes(box).select("mesh", "valid"), "mesh").join(d, "mesh")
    return _round(x, ["radius", "distance"])


@query("""WITH a AS (SELECT p_partkey, radians(p_partkey % 360 + 0.5) AS az, radians(p_size - 25.5) AS el, 2.0 + p_size / 50 AS r FROM part)
SELECT p_partkey, round(r * cos(el) * cos(az), 5) AS ox, round(r * cos(el) * sin(az), 5) AS oy, round(r * sin(el), 5) AS oz, round(sin(az) * -1, 5) AS rx, round(cos(az), 5) AS ry, round(256 / tan(radians(40) / 2), 4) AS focal FROM a""")
def camera_orbit(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).part
    size = F.col("p_size")
    at = A.orbit_offset(2.0 + size / 50, F.radians(F.col("p_partkey") % 360 + 0.5), F.radians(size - 25.5))
    x = p.select("p_partkey", *[v.alias(f"o{a}") for v, a in zip(at, XYZ, strict=True)])
    right = A.look_at([F.col("ox"), F.col("oy"), F.col("oz")], [F.lit(0.0)] * 3)[0]
    x = x.withColumns({"rx": right[0], "ry": right[1], "focal": A.focal(512, F.radians(F.lit(40.0)))})
    return _round(_round(x, ["ox", "oy", "oz", "rx", "ry"]), ["focal"], 4)


@query("""WITH n AS (SELECT i, i / 500.0 AS u, list_sum(list_transform(range(9), lambda k: ((i >> k::INT) & 1) / (2 ** (k + 1)))) AS v FROM range(500) r(i)), s AS (SELECT *, CASE WHEN u < 0.25 THEN 2 * u ELSE 2 / 3 * u + 1 / 3 END AS w FROM n) SELECT i, round(v * 2 * pi(), 6) AS phi, round(acos(1 - 2 * u) - pi() / 2, 6) AS theta, round(acos(1 - 2 * w) - pi() / 2, 6) AS theta_remapped FROM s""")
def sphere_points(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("i")
    phi, theta = A.sphere_hammersley(n, 500)
    x = spark.range(500).select(F.col("id").alias("i"))
    return x.select("i", F.round(phi, 6).alias("phi"), F.round(theta, 6).alias("theta"), F.round(A.sphere_hammersley(n, 500, remap=True)[1], 6).alias("theta_remapped"))


@query("SELECT p_partkey, round((p_size / 50.0) ** 2 * (3 - 2 * (p_size / 50.0)), 6) AS s, round(least(greatest(sin(p_size * 0.3) * 2, -0.5), 0.9), 6) AS elev, round_even((least(greatest((sin(p_size) + 1) * 0.5, 0), 1)) * 255, 0)::BIGINT AS u8, round_even((least(greatest((sin(p_size) + 1) * 0.5, 0), 1)) * 65535, 0)::BIGINT AS u16 FROM part")
def trajectory_and_pixels(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    elev = A.clamp(F.sin(size * 0.3) * 2, -0.5, 0.9)
    return Tables(spark, sf).part.select("p_partkey", F.round(A.smoothstep(size / 50.0), 6).alias("s"), F.round(elev, 6).alias("elev"), A.to_uint(F.sin(size), 8).alias("u8"), A.to_uint(F.sin(size), 16).alias("u16"))


@query(f"WITH {MESHES}, {_BOX}, c AS (SELECT mesh, i AS corner, CASE WHEN i & 1 > 0 THEN hx ELSE lx END AS x, CASE WHEN i & 2 > 0 THEN hy ELSE ly END AS y, CASE WHEN i & 4 > 0 THEN hz ELSE lz END AS z FROM b, range(8) r(i)) SELECT mesh, corner, x, y, z FROM c")
def box_corners(spark: SparkSession, sf: str) -> DataFrame:
    low, high = ([F.col(f"{s}{a}") for a in XYZ] for s in "lh")
    x = G.bounds(vertices(Tables(spark, sf)), ["mesh"]).select("mesh", F.posexplode(A.box_corners(low, high)).alias("corner", "p"))
    return x.select("mesh", "corner", "p.x", "p.y", "p.z")


@query(f"WITH {VOXELS} SELECT DISTINCT b, x // 8 AS x, y // 8 AS y, z // 8 AS z FROM vox")
def voxel_occupancy(spark: SparkSession, sf: str) -> DataFrame:
    return G.occupancy(voxels(Tables(spark, sf)))


@query("SELECT vec_id, list_max(list_transform(embedding[1:16], lambda v, i: abs(v - embedding[i + 16]))) <= 0.4 AS close, round(least(greatest(embedding[1] * 128, -2), 2), 5) AS sdf FROM embeddings")
def matrix_all_close(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("embedding").cast("array<float>")
    return Tables(spark, sf).embeddings.select("vec_id", A.all_close(F.slice(e, 1, 16), F.slice(e, 17, 16), 0.4).alias("close"), F.round(A.clamp(F.get(e, F.lit(0)).cast("double") * 128, -2.0, 2.0), 5).alias("sdf"))
