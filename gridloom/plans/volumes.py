"""Voxel, window and attention queries on lineitem and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import arrays as A
from gridloom.operators import attention as T
from gridloom.operators import sharding
from gridloom.operators import voxels as V
from gridloom.operators import windows as W
from gridloom.plans.registry import PLACES, VOXELS, Tables, places, query, voxels


@query(f"WITH {VOXELS}, n AS (SELECT b, count(*) AS n FROM vox GROUP BY b) SELECT b, (sum(n) OVER (ORDER BY b) - n)::BIGINT AS start, (sum(n) OVER (ORDER BY b))::BIGINT AS stop FROM n")
def voxel_layout(spark: SparkSession, sf: str) -> DataFrame:
    return V.layout(voxels(Tables(spark, sf)))


_POOL = "SELECT b, x // 4 AS x, y // 4 AS y, z // 4 AS z, {} FROM vox GROUP BY ALL"


@query(f"WITH {VOXELS} {_POOL.format('round(sum(f0) / (count(*) + 1), 7) AS f0, round(sum(f1) / (count(*) + 1), 7) AS f1')}")
def voxel_downsample(spark: SparkSession, sf: str) -> DataFrame:
    x = V.downsample(voxels(Tables(spark, sf)), 4, ["f0", "f1"])
    return x.withColumns({f: F.round(f, 7) for f in ("f0", "f1")})


@query(f"WITH {VOXELS} {_POOL.format('round(avg(f0), 4) AS mean, greatest(max(f0), 0) AS amax, sum(f0) AS total')}")
def voxel_downsample_modes(spark: SparkSession, sf: str) -> DataFrame:
    x = voxels(Tables(spark, sf)).select("b", "x", "y", "z", F.col("f0").alias("mean"), F.col("f0").alias("amax"), F.col("f0").alias("total"))
    return x.groupBy("b", *V.cell(4)).agg(F.round(V.REDUCE["true_mean"](F.col("mean")), 4).alias("mean"), V.REDUCE["amax"](F.col("amax")).alias("amax"), V.REDUCE["sum"](F.col("total")).alias("total"))


@query(f"WITH {VOXELS}, c AS ({_POOL.format('avg(f0) AS f0')}) SELECT v.row_id, round(c.f0, 4) AS up_f0 FROM vox v JOIN c ON v.b = c.b AND v.x // 4 = c.x AND v.y // 4 = c.y AND v.z // 4 = c.z")
def voxel_upsample(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(Tables(spark, sf))
    return V.upsample(v, V.downsample(v, 4, ["f0"], "true_mean"), 4, ["f0"]).select("row_id", F.round("up_f0", 4).alias("up_f0"))


@query(f"WITH {PLACES} SELECT b, x * 2 + dx AS x, y * 2 + dy AS y, z * 2 + dz AS z, value FROM vol, range(2) a(dx), range(2) c(dy), range(2) d(dz)")
def voxel_subdivide(spark: SparkSession, sf: str) -> DataFrame:
    return V.subdivide(places(Tables(spark, sf))).select("b", "x", "y", "z", "value")


@query("SELECT b, x, y, z, 2.5 AS value FROM range(3) r(b), range(1, 5) s(x), range(0, 3) t(y), range(2, 4) u(z)")
def voxel_full(spark: SparkSession, sf: str) -> DataFrame:
    return V.full(spark, (1, 0, 2), (4, 2, 3), 3, 2.5)


@query(f"WITH {VOXELS} SELECT row_id, n AS b, f0 FROM vox JOIN (VALUES (3, 0), (1, 1), (3, 2)) t(o, n) ON b = o")
def voxel_take_items(spark: SparkSession, sf: str) -> DataFrame:
    return V.take_items(voxels(Tables(spark, sf)), [3, 1, 3]).select("row_id", "b", "f0")


@query(f"WITH {VOXELS} SELECT row_id, x, y, z, f0 FROM vox WHERE b = 2")
def voxel_unbind(spark: SparkSession, sf: str) -> DataFrame:
    return V.unbind(voxels(Tables(spark, sf)), 4)[2].select("row_id", "x", "y", "z", "f0")


@query(f"WITH {VOXELS} SELECT row_id, round(a.f0 + o.f1 * 0.5 - o.f2 / 2, 4) AS s, CASE WHEN v.f2 = 0 THEN 'inf' ELSE round(v.f0 / v.f2, 4)::VARCHAR END AS q, round(-v.f0, 4) AS neg FROM vox a JOIN vox o USING (row_id) JOIN vox v USING (row_id)")
def voxel_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(Tables(spark, sf))
    other = v.select("row_id", "b", "x", "y", "z", (F.col("f1") * 0.5 - F.col("f2") / 2).alias("f0"))
    s = V.by_row(v, other, ["f0"], lambda a, b: a + b).select("row_id", F.round("f0", 4).alias("s"))
    ratio = A.safe_divide(F.col("f0"), F.col("f2"))
    return s.join(v.select("row_id", F.when(ratio == float("inf"), "inf").otherwise(F.round(ratio, 4).cast("string")).alias("q"), F.round(-F.col("f0"), 4).alias("neg")), "row_id")


@query(f"WITH {VOXELS}, m AS (SELECT b, avg(f0) AS f0 FROM vox GROUP BY b) SELECT row_id, round(vox.f0 - m.f0, 4) AS f0 FROM vox JOIN m USING (b)")
def voxel_by_item(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(Tables(spark, sf))
    return V.by_item(v, v.groupBy("b").agg(F.avg("f0").alias("f0")), ["f0"], lambda a, m: a - m).select("row_id", F.round("f0", 4).alias("f0"))


@query(f"WITH {PLACES} SELECT a.b, a.x, a.y, a.z, a.value * 10 + c.value AS value FROM vol a JOIN (SELECT * FROM vol WHERE row_id % 2 = 0) c USING (b, x, y, z)")
def voxel_by_place(spark: SparkSession, sf: str) -> DataFrame:
    p = places(Tables(spark, sf))
    return V.by_place(p, p.where("row_id % 2 = 0"), ["value"], lambda a, c: a * 10 + c).select("b", "x", "y", "z", "value")


@query(f"WITH {VOXELS} SELECT row_id, b, f0 FROM vox UNION ALL SELECT row_id, b + 4, f0 FROM vox WHERE f0 > 25")
def voxel_concat_items(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(Tables(spark, sf)).select("row_id", "b", "f0")
    return V.concat_items([v, v.where("f0 > 25")], [4, 4])


@query("SELECT vec_id AS row_id, round(list_sum(list_concat(embedding, embedding[1:8])::DOUBLE[]), 4) AS total, 72 AS n FROM embeddings")
def voxel_concat_features(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).embeddings.select(F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("f"))
    x = V.concat_features(e, e.select("row_id", F.slice("f", 1, 8).alias("f")), "f")
    return x.select("row_id", F.round(F.aggregate("f", F.lit(0.0), lambda s, v: s + v), 4).alias("total"), F.size("f").alias("n"))


@query(f"WITH {VOXELS} SELECT row_id, b, row_number() OVER (PARTITION BY b ORDER BY x // 8, y // 8, z // 8, x % 8, y % 8, z % 8, row_id) - 1 AS rank FROM vox")
def voxel_block_rank(spark: SparkSession, sf: str) -> DataFrame:
    return V.block_rank(voxels(Tables(spark, sf)), 8).select("row_id", "b", "rank")


@query(f"WITH {VOXELS} SELECT row_id, x + y * 1024 + z * 1048576 AS code, x AS ux, y AS uy, z AS uz, floor((x - 40) / 7)::BIGINT AS fd, (((x - 40) % 7) + 7) % 7 AS fm FROM vox")
def voxel_pack(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    v = voxels(Tables(spark, sf)).withColumn("code", A.pack(c("x"), c("y"), c("z"), 10))
    return v.select("row_id", "code", *[u.alias(f"u{a}") for u, a in zip(A.unpack(c("code"), 10), "xyz", strict=True)], A.floor_div(c("x") - 40, 7).alias("fd"), A.floor_mod(c("x") - 40, 7).alias("fm"))


_HALO = """WITH {v}, g AS (SELECT i, j, k FROM range(4) a(i), range(4) b(j), range(4) c(k)),
h AS (SELECT vol.*, i, j, k FROM vol JOIN g ON x >= greatest(0, i * 16 - 4) AND x < least((i + 1) * 16 + 4, 64) AND y >= greatest(0, j * 16 - 4) AND y < least((j + 1) * 16 + 4, 64) AND z >= greatest(0, k * 16 - 4) AND z < least((k + 1) * 16 + 4, 64)) """


@query(_HALO.format(v=PLACES) + "SELECT i, j, k, count(*) AS n, sum(x - greatest(0, i * 16 - 4))::BIGINT AS sx, sum(z - greatest(0, k * 16 - 4))::BIGINT AS sz, sum(row_id % 1000)::BIGINT AS ids FROM h GROUP BY ALL")
def voxel_chunk_halo(spark: SparkSession, sf: str) -> DataFrame:
    h = V.chunk_halo(places(Tables(spark, sf)), 64, 4, 4)
    return h.groupBy("i", "j", "k").agg(F.count("*").alias("n"), F.sum("lx").alias("sx"), F.sum("lz").alias("sz"), F.sum(F.col("row_id") % 1000).alias("ids"))


@query(f"WITH {PLACES} SELECT b, x, y, z, value FROM vol")
def voxel_stitch(spark: SparkSession, sf: str) -> DataFrame:
    h = V.chunk_halo(places(Tables(spark, sf)), 64, 4, 4).drop("x", "y", "z")
    return V.stitch(h, 64, 4, 4, clean=True).select("b", "x", "y", "z", "value")


@query(f"""WITH {PLACES}, f AS (SELECT b, x * 8 AS x, y * 8 AS y, z * 8 AS z, value FROM vol), g AS (SELECT i, j, k FROM range(4) a(i), range(4) q(j), range(4) c(k))
SELECT b, x, y, z, count(*) AS copies FROM f JOIN g ON x >= i * 128 AND x < (i + 1) * 128 + 7 AND y >= j * 128 AND y < (j + 1) * 128 + 7 AND z >= k * 128 AND z < (k + 1) * 128 + 7
 AND x // 8 >= greatest(0, i * 16 - 4) AND y // 8 >= greatest(0, j * 16 - 4) AND z // 8 >= greatest(0, k * 16 - 4) GROUP BY ALL""")
def voxel_stitch_overlap(spark: SparkSession, sf: str) -> DataFrame:
    h = V.chunk_halo(places(Tables(spark, sf)), 64, 4, 4).drop("x", "y", "z")
    h = h.withColumns({f"l{a}": F.col(f"l{a}") * 8 for a in "xyz"})
    return V.stitch(h, 64, 4, 4, ratio=8).groupBy("b", "x", "y", "z").agg(F.count("*").alias("copies"))


@query(f"WITH {PLACES}, s AS (SELECT b, x // 8 AS x, y // 8 AS y, z // 8 AS z, sum(value) AS value FROM vol GROUP BY ALL) SELECT g.*, coalesce(value, 1.0) AS value FROM (SELECT b, x, y, z FROM (SELECT DISTINCT b FROM s), range(8) p(x), range(8) q(y), range(8) r(z)) g LEFT JOIN s USING (b, x, y, z)")
def voxel_densify(spark: SparkSession, sf: str) -> DataFrame:
    return V.densify(V.downsample(places(Tables(spark, sf)), 8, ["value"], "sum"), 8, "value", 1.0)


@query(f"WITH {VOXELS} SELECT b, x, y, z, count(*) AS n FROM vox WHERE 1 / (1 + exp(-(f0 - 25) / 10)) >= 0.6 GROUP BY ALL")
def voxel_occupied(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(Tables(spark, sf)).withColumn("logit", (F.col("f0") - 25) / 10)
    return V.occupied(v, "logit", 0.6).groupBy("b", "x", "y", "z").agg(F.count("*").alias("n"))


@query(f"WITH {VOXELS} SELECT DISTINCT b, x // 8 AS x, y // 8 AS y, z // 8 AS z FROM vox WHERE f2 < 4 / 64")
def voxel_near_surface(spark: SparkSession, sf: str) -> DataFrame:
    return V.near_surface(voxels(Tables(spark, sf)), "f2", 64, 8)


@query(f"WITH {VOXELS} SELECT b, x + y * 64 + z * 4096 AS code, round(f2 * CASE WHEN f0 > 25 THEN 1 ELSE -1 END * 16, 6) AS sdf FROM vox WHERE f2 > 0 AND f2 < 4 / 64")
def voxel_encode_sdf(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(Tables(spark, sf)).where("f2 > 0").withColumn("sign", F.when(F.col("f0") > 25, 1.0).otherwise(-1.0))
    return V.encode_sdf(v, "f2", "sign", 64).withColumn("sdf", F.round("sdf", 6))


@query("""WITH o AS (SELECT l_suppkey % 4 AS b, row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS ordinal, l_discount > 0.05 AS s FROM lineitem)
SELECT b, ordinal // 8 AS byte, sum(CASE WHEN s THEN 128 >> (ordinal % 8)::INT ELSE 0 END)::BIGINT AS bits FROM o GROUP BY ALL""")
def voxel_pack_signs(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem.withColumn("b", F.col("l_suppkey") % 4)
    x = sharding.ranks(li, ["b"], [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")], "ordinal")
    return V.pack_signs(x.select("b", "ordinal", (F.col("l_discount") - 0.05).alias("s")), "s")


@query(f"""WITH {PLACES}, k AS (SELECT dx, dy, dz, (dx * 9 + dy * 3 + dz) * 0.25 + 1 AS w FROM range(-1, 2) p(dx), range(-1, 2) q(dy), range(-1, 2) r(dz))
SELECT b, x, y, z, round(sum(s.v), 4) AS value FROM (SELECT b, x - dx AS x, y - dy AS y, z - dz AS z, value * w AS v FROM vol, k) s JOIN vol USING (b, x, y, z) GROUP BY ALL""")
def voxel_convolve(spark: SparkSession, sf: str) -> DataFrame:
    kernel = {(i, j, k): (i * 9 + j * 3 + k) * 0.25 + 1 for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)}
    return V.convolve(places(Tables(spark, sf)), "value", kernel).withColumn("value", F.round("value", 4))


@query("""WITH e AS (SELECT vec_id AS row_id, label AS b, i - 1 AS c, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i)), s AS (SELECT b, c // 16 AS g, avg(v) AS m, var_pop(v) AS p FROM e GROUP BY ALL)
SELECT row_id, round(sum((v - m) / sqrt(p + 1e-5) * (c + 1)), 3) AS check_sum FROM e JOIN s ON e.b = s.b AND c // 16 = g GROUP BY row_id""")
def voxel_group_norm(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).embeddings.select(F.col("vec_id").alias("row_id"), F.col("label").alias("b"), F.col("embedding").alias("f"))
    x = V.group_norm(e, "f", 4)
    total = F.aggregate(F.transform("f", lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v)
    return x.select("row_id", F.round(total, 3).alias("check_sum"))


@query("""WITH e AS (SELECT vec_id AS row_id, embedding::DOUBLE[] AS f FROM embeddings), s AS (SELECT *, list_avg(f) AS m, list_var_pop(f) AS p, sqrt(list_sum(list_transform(f, lambda v: v * v))) AS n FROM e)
SELECT row_id, round((f[3] - m) / sqrt(p + 1e-5), 5) AS layer3, round(f[5] / n, 5) AS l2_5, round(f[5] / n * 8, 5) AS rms_5, round(greatest(f[1], 0), 5) AS relu1, round(1 / (1 + exp(-f[2])), 5) AS sig2, round(f[2] / (1 + exp(-f[2])), 5) AS silu2,
 round(tanh(f[2]), 5) AS tanh2, round(0.5 * f[2] * (1 + tanh(sqrt(2 / pi()) * (f[2] + 0.044715 * f[2] ** 3))), 5) AS gelu2, round(list_sum(list_transform(f, lambda v: v * 0.5)) + 1, 4) AS lin FROM s""")
def feature_functions(spark: SparkSession, sf: str) -> DataFrame:
    f = F.col("f")
    e = Tables(spark, sf).embeddings.select(F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("f"))
    one = lambda c, i, n: F.round(F.get(c, F.lit(i)), 5).alias(n)
    x = e.select(
        "row_id", "f", one(V.layer_norm(f), 2, "layer3"), one(A.l2_normalize(f), 4, "l2_5"), one(A.rms_normalize(f), 4, "rms_5"), one(A.activate(f, "relu"), 0, "relu1"), one(A.activate(f, "sigmoid"), 1, "sig2"),
        one(A.activate(f, "silu"), 1, "silu2"), one(A.activate(f, "tanh"), 1, "tanh2"), one(A.activate(f, "gelu_tanh"), 1, "gelu2"),
    )
    return V.linear(x, "f", [[0.5] * 64], [1.0]).withColumn("lin", F.round(F.get("f", F.lit(0)), 4)).drop("f")


@query("""WITH e AS (SELECT vec_id, embedding[1:8]::DOUBLE[] AS m, embedding[9:16]::DOUBLE[] AS v FROM embeddings)
SELECT vec_id, round(0.5 * list_sum(list_transform(range(1, 9), lambda i: m[i] ** 2 + exp(v[i]) - 1 - v[i])), 5) AS kl, round(0.5 * list_sum(list_transform(range(1, 9), lambda i: ln(2 * pi()) + v[i] + (0.1 - m[i]) ** 2 / exp(v[i]))), 5) AS nll FROM e""")
def gaussian_terms(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).embeddings
    m, v = (F.slice(F.col("embedding").cast("array<double>"), a, 8) for a in (1, 9))
    return e.select("vec_id", F.round(V.gaussian_kl(m, v), 5).alias("kl"), F.round(V.gaussian_nll(F.array_repeat(F.lit(0.1), 8), m, v), 5).alias("nll"))


@query(f"""WITH {VOXELS}, p AS (SELECT row_id, x, y, z FROM vox) SELECT row_id, round(sin(x / 10000 ** (1 / 5)), 6) AS s1, round(cos(y / 10000 ** (2 / 5)), 6) AS c2, round(cos(x * 0.5), 6) AS t0, round(sin(x * 0.5 * exp(-ln(10000) * 2 / 4)), 6) AS t2,
 round(0.3 * cos(x / 10) - 0.4 * sin(x / 10), 6) AS r2, round(0.3 * sin(x / 10) + 0.4 * cos(x / 10), 6) AS r3, 32 AS n FROM p""")
def position_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    v = voxels(Tables(spark, sf))
    e = A.position_embedding([c("x"), c("y"), c("z")], 32)
    t = A.timestep_embedding(c("x") * 0.5, 9)
    r = A.rotary(F.array(*[F.lit(q) for q in (0.1, 0.2, 0.3, 0.4)]), c("x"), 2, base=100.0)
    g = lambda a, i, n: F.round(F.get(a, F.lit(i)), 6).alias(n)
    return v.select("row_id", g(e, 1, "s1"), g(e, 17, "c2"), g(t, 0, "t0"), g(t, 6, "t2"), g(r, 2, "r2"), g(r, 3, "r3"), F.size(e).alias("n"))


@query(f"WITH {PLACES}, p AS (SELECT b, x // 2 AS x, y // 2 AS y, z // 2 AS z, ((x % 2) * 2 + y % 2) * 2 + z % 2 AS slot, value FROM vol) SELECT b, x, y, z, slot, value, x * 2 + slot // 4 AS bx, y * 2 + (slot // 2) % 2 AS by_, z * 2 + slot % 2 AS bz FROM p")
def voxel_patchify(spark: SparkSession, sf: str) -> DataFrame:
    p = V.patchify(places(Tables(spark, sf)), 2)
    back = V.unpatchify(p.withColumns({f"o{a}": F.col(a) for a in "xyz"}).select("b", "x", "y", "z", "slot", "value"), 2)
    both = p.withColumns({"bx": F.col("x") * 2 + A.floor_div(F.col("slot"), 4), "by_": F.col("y") * 2 + F.pmod(A.floor_div(F.col("slot"), 2), F.lit(2)), "bz": F.col("z") * 2 + F.pmod("slot", F.lit(2))})
    return both.join(back.select("b", F.col("x").alias("bx"), F.col("y").alias("by_"), F.col("z").alias("bz")), ["b", "bx", "by_", "bz"], "left_semi")


@query("SELECT b, x, round(CASE WHEN p > 0 AND x - p * 5 < 3 THEN (x - p * 5 + 0.5) / 3 WHEN p < 2 AND x - p * 5 >= 5 THEN (8 - (x - p * 5) - 0.5) / 3 ELSE 1 END, 6) AS w, p FROM (SELECT l_orderkey AS b, l_linenumber AS x0, l_partkey % 18 AS x, unnest(range(3)) AS p FROM lineitem) WHERE x >= p * 5 AND x < p * 5 + 8")
def blend_weights(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem.select(F.col("l_orderkey").alias("b"), (F.col("l_partkey") % 18).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("p"))
    return li.where("x >= p * 5 and x < p * 5 + 8").withColumn("w", F.round(V.blend_weight(F.col("x"), F.col("p"), 8, 5, 3), 6))


@query(f"""WITH {PLACES}, c AS (SELECT b, x // 2 AS x, y // 2 AS y, z // 2 AS z, CASE WHEN sum(row_id) % 2 = 0 THEN 1.0 ELSE -1.0 END AS s FROM vol GROUP BY ALL)
SELECT vol.b, vol.x, vol.y, vol.z, CASE WHEN row_id % 5 = 0 THEN 9.0 ELSE value * s END AS value FROM vol JOIN c ON c.b = vol.b AND c.x = vol.x // 2 AND c.y = vol.y // 2 AND c.z = vol.z // 2""")
def voxel_refine_sign(spark: SparkSession, sf: str) -> DataFrame:
    p = places(Tables(spark, sf))
    coarse = p.groupBy("b", *V.cell(2)).agg(F.when(F.sum("row_id") % 2 == 0, 1.0).otherwise(-1.0).alias("value"))
    return V.refine_sign(p, coarse, p.where("row_id % 5 = 0").withColumn("value", F.lit(9.0)))


@query("""WITH e AS (SELECT vec_id AS b, embedding::DOUBLE[] AS t FROM embeddings), x AS (SELECT b, i - 1 AS k, t[i] AS token FROM e, range(1, 65) r(i))
SELECT b, CASE WHEN k <= 4 THEN 0 ELSE (k - 5) % 8 END AS x, CASE WHEN k <= 4 THEN 0 ELSE (k - 5) // 8 END AS y, CASE WHEN k <= 4 THEN 1 ELSE 0 END AS z, token FROM x WHERE k <= 4 OR (k - 5 + b) % 3 <> 0""")
def image_tokens(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).embeddings.select(F.col("vec_id").alias("b"), F.col("embedding").cast("array<double>").alias("tokens"))
    mask = F.transform(F.sequence(F.lit(0), F.lit(58)), lambda i: (i + F.col("b")) % 3 != 0)
    return V.tokens(e.withColumn("mask", mask), 8, 4)


# ---- windows


@query(f"WITH {VOXELS} SELECT b, (x + 3) // 16 AS wx, (y + 3) // 16 AS wy, (z + 3) // 16 AS wz, count(*) AS n FROM vox GROUP BY ALL")
def window_partition(spark: SparkSession, sf: str) -> DataFrame:
    return W.partition(voxels(Tables(spark, sf)), 16, 3)


_Z = " + ".join(f"((x >> {k}) & 1) * {1 << (3 * k)} + ((y >> {k}) & 1) * {2 << (3 * k)} + ((z >> {k}) & 1) * {4 << (3 * k)}" for k in range(7))


@query(f"WITH {VOXELS} SELECT row_id, {_Z} AS code FROM (SELECT row_id, x + 1 AS x, y + 1 AS y, z + 1 AS z FROM vox)")
def serial_z_order(spark: SparkSession, sf: str) -> DataFrame:
    return voxels(Tables(spark, sf)).select("row_id", W.serial_code("z_order", 1, 7).alias("code"))


_SERIAL = f"""WITH {VOXELS}, r AS (SELECT b, row_id, row_number() OVER (PARTITION BY b ORDER BY x, y, z, row_id) - 1 AS rank, count(*) OVER (PARTITION BY b) AS n FROM vox),
w AS (SELECT DISTINCT b, n, ceil(n / 100)::BIGINT AS k FROM r), s AS (SELECT b, n, k, unnest(range(k)) AS win FROM w),
p AS (SELECT *, floor((win + 0.5) * (n / k) + 10 - 50)::BIGINT AS begin_, floor(win * (n / k) + 10)::BIGINT AS a, floor((win + 1) * (n / k) + 10)::BIGINT AS z FROM s WHERE k > 1),
q AS (SELECT *, begin_ + unnest(range(100)) AS place FROM p)
SELECT q.b, win AS "window", place - begin_ AS slot, r.rank, r.row_id, place >= a AND place < z AS owned FROM q JOIN r ON r.b = q.b AND r.rank = ((place % q.n) + q.n) % q.n
UNION ALL SELECT b, 0, rank, rank, row_id, true FROM r WHERE n <= 100"""


@query(_SERIAL)
def serial_windows(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(Tables(spark, sf))
    code = F.col("x") * 4096 + F.col("y") * 64 + F.col("z")
    return W.serial_windows(v, code, 100, 10)


@query(f"WITH {VOXELS}, n AS (SELECT b, x // 8 AS bx, y // 8 AS by_, z // 8 AS bz, count(*) AS n FROM vox GROUP BY ALL) SELECT b, bx, by_ AS by, bz, n, dense_rank() OVER (PARTITION BY b ORDER BY bx, by_, bz) - 1 AS block, (sum(n) OVER (PARTITION BY b ORDER BY bx, by_, bz) - n)::BIGINT AS start FROM n")
def block_index(spark: SparkSession, sf: str) -> DataFrame:
    return W.block_index(voxels(Tables(spark, sf)), 8)


def serial_hilbert(spark: SparkSession, sf: str) -> DataFrame:
    return voxels(Tables(spark, sf)).select("row_id", W.serial_code("hilbert", 0, 6).alias("code"))


query()(serial_hilbert)


# ---- attention: embeddings of one label attend to each other; a block is a range of vec_id

EMB = """e AS (SELECT vec_id AS id, label::BIGINT AS b, vec_id // 25 AS block, embedding[1:16]::DOUBLE[] AS k, embedding[17:20]::DOUBLE[] AS v FROM embeddings)"""
SCORED = """s AS (SELECT q.b, q.id AS q_id, k.id AS k_id, k.block, list_dot_product(q.k, k.k) / 4 AS s, k.v FROM e q JOIN e k ON q.b = k.b),
p AS (SELECT *, exp(s - max(s) OVER (PARTITION BY q_id)) AS x FROM s)"""


def _emb(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    return Tables(spark, sf).embeddings.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("b"), A.floor_div(F.col("vec_id"), 25).alias("block"), F.slice(e, 1, 16).alias("k"), F.slice(e, 17, 4).alias("v"))


def _qkv(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = _emb(spark, sf)
    return e.select("b", F.col("id").alias("q_id"), F.col("k").alias("q")), e.select("b", "block", F.col("id").alias("k_id"), "k", "v")


@query(f"WITH {EMB}, {SCORED} SELECT b, q_id, round(sum(x * v[1]) / sum(x), 5) AS o0, round(sum(x * v[4]) / sum(x), 5) AS o3, round(ln(sum(x)) + max(s), 5) AS lse FROM p GROUP BY b, q_id")
def attention_full(spark: SparkSession, sf: str) -> DataFrame:
    q, kv = _qkv(spark, sf)
    x = T.attend(q, kv.drop("block"), ["b"], dim=4)
    return x.select("b", "q_id", F.round(F.get("out", F.lit(0)), 5).alias("o0"), F.round(F.get("out", F.lit(3)), 5).alias("o3"), F.round("lse", 5).alias("lse"))


@query(f"WITH {EMB}, s AS (SELECT q.b, q.block AS w, q.id AS q_id, list_dot_product(q.k, k.k) / 4 AS s, k.v FROM e q JOIN e k ON q.b = k.b AND q.block = k.block), p AS (SELECT *, exp(s) AS x FROM s) SELECT b, w AS \"window\", q_id, round(sum(x * v[2]) / sum(x), 5) AS o1 FROM p GROUP BY ALL")
def attention_windowed(spark: SparkSession, sf: str) -> DataFrame:
    e = _emb(spark, sf).withColumnRenamed("block", "window")
    x = T.attend(e.select("b", "window", F.col("id").alias("q_id"), F.col("k").alias("q")), e.select("b", "window", F.col("id").alias("k_id"), "k", "v"), ["b", "window"], dim=4)
    return x.select("b", "window", "q_id", F.round(F.get("out", F.lit(1)), 5).alias("o1"))


@query(f"WITH {EMB}, {SCORED} SELECT b, q_id, block, round(sum(x) / any_value(t), 6) AS score FROM (SELECT *, sum(x) OVER (PARTITION BY q_id) AS t FROM p) GROUP BY b, q_id, block")
def attention_block_scores(spark: SparkSession, sf: str) -> DataFrame:
    q, kv = _qkv(spark, sf)
    return T.block_scores(q, kv, ["b"], "block", scale=0.25).withColumn("score", F.round("score", 6))


_TOP = f"""{EMB}, {SCORED}, c AS (SELECT b, q_id, block, round(sum(x) / any_value(t), 9) AS score FROM (SELECT *, sum(x) OVER (PARTITION BY q_id) AS t FROM p) GROUP BY b, q_id, block),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, block) AS r FROM c) WHERE r <= 4)"""


@query(f"WITH {_TOP}, f AS (SELECT b, q_id, list_sort(list(block)) AS l FROM t GROUP BY ALL) SELECT b, q_id, i AS slot, coalesce(l[i + 1], -1) AS block FROM f, range(4) r(i)")
def attention_top_blocks(spark: SparkSession, sf: str) -> DataFrame:
    q, kv = _qkv(spark, sf)
    return T.best_blocks(q, kv, ["b"], "block", 4, scale=0.25)


@query(f"WITH {_TOP}, a AS (SELECT p.* FROM p JOIN t ON t.q_id = p.q_id AND t.block = p.block) SELECT b, q_id, round(sum(x * v[1]) / sum(x), 5) AS o0 FROM a GROUP BY b, q_id")
def attention_selected(spark: SparkSession, sf: str) -> DataFrame:
    q, kv = _qkv(spark, sf)
    chosen = T.best_blocks(q, kv, ["b"], "block", 4, scale=0.25)
    return T.selected(q, kv, chosen, ["b"], "block", dim=4).select("b", "q_id", F.round(F.get("out", F.lit(0)), 5).alias("o0"))


@query(f"WITH {_TOP} SELECT b, block, count(*) AS n, min(q_id) AS first_q, max(q_id) AS last_q FROM t GROUP BY ALL")
def attention_queries_of_block(spark: SparkSession, sf: str) -> DataFrame:
    q, kv = _qkv(spark, sf)
    return T.queries_of_block(T.best_blocks(q, kv, ["b"], "block", 4, scale=0.25), ["b"], "block")


@query(f"""WITH {EMB}, c AS (SELECT b, block, {", ".join(f"avg(k[{i}]) AS k{i}" for i in range(1, 5))}, avg(v[1]) AS v1 FROM e GROUP BY ALL), s AS (SELECT q.b, q.id AS q_id, (q.k[1] * k1 + q.k[2] * k2 + q.k[3] * k3 + q.k[4] * k4) / 2 AS s, v1 FROM e q JOIN c USING (b))
SELECT b, q_id, round(sum(exp(s) * v1) / sum(exp(s)), 5) AS o0, round(0.5 * 1 / (1 + exp(-0.3)) + 0.25 / (1 + exp(0.2)), 6) AS mix FROM s GROUP BY b, q_id""")
def attention_compressed(spark: SparkSession, sf: str) -> DataFrame:
    e = _emb(spark, sf).withColumn("k", F.slice("k", 1, 4))
    coarse = T.compress(e, ["b", "block"], 4).withColumnRenamed("block", "k_id")
    x = T.attend(e.select("b", F.col("id").alias("q_id"), F.col("k").alias("q")), coarse, ["b"], dim=4)
    mix = T.gated([(F.array(F.lit(0.5)), F.lit(0.3)), (F.array(F.lit(0.25)), F.lit(-0.2))])
    return x.select("b", "q_id", F.round(F.get("out", F.lit(0)), 5).alias("o0"), F.round(F.get(mix, F.lit(0)), 6).alias("mix"))
