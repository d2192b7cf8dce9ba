"""Motion, histogram and sharding queries on events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import motion as M
from gridloom.operators import sharding as S
from gridloom.plans.registry import FRAMES, Tables, frames, query

TRIM = "SELECT object, min(CASE WHEN {m} THEN frame END) AS a, max(CASE WHEN {m} THEN frame END) AS z, min(frame) AS f0, max(frame) AS f1, count(*) AS n, count(*) - count(rms) AS missing FROM frames GROUP BY object"


@query(f"WITH {FRAMES}, x AS ({TRIM.format(m='rms > 0.3 OR rms IS NULL')}) SELECT object, coalesce(a, f0) AS keep_start, coalesce(z, f1) AS keep_end, coalesce(z, f1) - coalesce(a, f0) + 1 AS kept, n AS before, missing, a IS NULL AS static FROM x")
def motion_trim(spark: SparkSession, sf: str) -> DataFrame:
    return M.trim(frames(Tables(spark, sf)), 0.3)


@query(f"WITH {FRAMES}, x AS ({TRIM.format(m='rms > 0.45')}) SELECT object, a AS keep_start, z AS keep_end, coalesce(z - a + 1, 0) AS kept, n AS before, missing, a IS NULL AS static FROM x")
def motion_trim_strict(spark: SparkSession, sf: str) -> DataFrame:
    return M.trim(frames(Tables(spark, sf)), 0.45, missing_moves=False, keep_static=False)


@query(f"WITH {FRAMES}, x AS ({TRIM.format(m='rms > 0.3 OR rms IS NULL')}) SELECT object, frame, event_id FROM frames JOIN x USING (object) WHERE a IS NULL OR frame BETWEEN a AND z")
def motion_kept_frames(spark: SparkSession, sf: str) -> DataFrame:
    return M.kept_frames(frames(Tables(spark, sf)), 0.3).select("object", "frame", "event_id")


@query(f"WITH {FRAMES}, p AS (SELECT object, count(*) AS n, count(CASE WHEN rms > 0.2 AND frame <= 50 THEN 1 END) AS m FROM frames GROUP BY 1) SELECT sum(least(n, 50))::BIGINT AS frames_capped, sum(m)::BIGINT AS motion_frames, round(sum(m) / sum(least(n, 50)), 6) AS ratio FROM p")
def motion_capped_totals(spark: SparkSession, sf: str) -> DataFrame:
    return M.capped_totals(frames(Tables(spark, sf)), 0.2, 50).withColumn("ratio", F.round("ratio", 6))


@query(f"""WITH {FRAMES}, r AS (SELECT *, first_value(sig) OVER (PARTITION BY object ORDER BY frame) AS ref FROM frames)
SELECT object, min(ref) AS reference, min(CASE WHEN sig <> ref THEN frame END) AS first_changed_frame, arg_min(sig, frame) FILTER (sig <> ref) AS changed_to, count(*) AS checked_frames, count(CASE WHEN sig <> ref THEN 1 END) > 0 AS topology_changed FROM r GROUP BY object""")
def motion_first_change(spark: SparkSession, sf: str) -> DataFrame:
    return M.first_change(frames(Tables(spark, sf)), "sig")


@query(f"WITH {FRAMES} SELECT object, frame, first_value(rms) OVER (PARTITION BY object ORDER BY frame) AS first_value, abs(rms - first_value(rms) OVER (PARTITION BY object ORDER BY frame)) <= 0.05 AS same FROM frames")
def motion_against_first(spark: SparkSession, sf: str) -> DataFrame:
    return M.against_first(frames(Tables(spark, sf)), "rms", tolerance=0.05).select("object", "frame", "first_value", "same")


@query("SELECT json_extract_string(props, '$.k')::BIGINT AS key, count(*) AS n FROM events GROUP BY 1")
def histogram_json_key(spark: SparkSession, sf: str) -> DataFrame:
    return M.histogram(Tables(spark, sf).events, F.get_json_object("props", "$.k").cast("long"))


@query("SELECT count(CASE WHEN event_type <> 'error' AND value > 100 THEN 1 END) AS changed, count(CASE WHEN event_type <> 'error' AND value <= 100 THEN 1 END) AS unchanged, count(CASE WHEN event_type = 'error' THEN 1 END) AS failed FROM events")
def topology_tri_count(spark: SparkSession, sf: str) -> DataFrame:
    return M.tri_count(Tables(spark, sf).events, F.col("event_type") != "error", F.col("value") > 100)


@query("SELECT DISTINCT user_id AS object, round_even(value, 0)::BIGINT AS frame FROM events WHERE round_even(value, 0) BETWEEN 10 AND 200")
def motion_keyframes(spark: SparkSession, sf: str) -> DataFrame:
    return M.keyframes(Tables(spark, sf).events.select(F.col("user_id").alias("object"), F.col("value").alias("time")), 10, 200)


@query("SELECT user_id, round(least(greatest(quantile_cont(value, 0.75), 25), 120), 6) AS q75, quantile_disc(value, 0.5) AS lower_median FROM events GROUP BY user_id")
def agg_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    q = F.least(F.greatest(F.percentile("value", 0.75), F.lit(25.0)), F.lit(120.0))
    return Tables(spark, sf).events.groupBy("user_id").agg(F.round(q, 6).alias("q75"), F.expr("percentile_disc(0.5) within group (order by value)").alias("lower_median"))


# ---- order and shards

RANKED = "r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn0, count(*) OVER () AS n FROM orders)"


@query(f"WITH {RANKED} SELECT o_orderkey, rn0, floor(((rn0 + 1) * 7 - 1) / n)::BIGINT AS floor_chunk, floor(rn0 / ceil(n / 7))::BIGINT AS ceil_chunk, rn0 % 7 AS robin FROM r")
def shard_chunks(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    n = F.lit(o.count())
    rn0 = F.col("rn0")
    return S.positions(o, [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "rn0", S.chunk_floor(rn0, n, 7).alias("floor_chunk"), S.chunk_ceil(rn0, n, 7).alias("ceil_chunk"), S.round_robin(rn0, 7).alias("robin"))


@query(f"WITH {RANKED} SELECT o_orderkey, rn0 FROM r WHERE rn0 >= 100 AND rn0 < 250")
def shard_slice(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return S.positions(o, [F.col("o_orderdate"), F.col("o_orderkey")]).where("rn0 >= 100 and rn0 < 250").select("o_orderkey", "rn0")


@query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha1('7:' || doc_id), doc_id) <= 50 THEN 'test' ELSE 'train' END AS split FROM documents")
def split_train_test(spark: SparkSession, sf: str) -> DataFrame:
    return S.split(Tables(spark, sf).documents.select("doc_id"), "doc_id", 50, "7")


@query("SELECT event_id FROM events WHERE event_id % 9 = 2")
def stride_views(spark: SparkSession, sf: str) -> DataFrame:
    return Tables(spark, sf).events.where(F.pmod("event_id", F.lit(9)) == 2).select("event_id")


@query("SELECT p_partkey, unnest(range(1, p_size, 3)) AS frame FROM part")
def stride_frames(spark: SparkSession, sf: str) -> DataFrame:
    return Tables(spark, sf).part.select("p_partkey", F.explode(S.stride_frames(F.col("p_size"), 3, 1)).alias("frame"))


@query("SELECT o_custkey, count(*) + 115 AS n, CASE WHEN count(*) + 115 > 121 THEN ('0x' || substr(sha1(o_custkey::VARCHAR), 1, 8))::BIGINT % (count(*) + 115 - 120) ELSE 0 END AS start FROM orders GROUP BY 1")
def crop_start(spark: SparkSession, sf: str) -> DataFrame:
    x = Tables(spark, sf).orders.groupBy("o_custkey").agg((F.count("*") + 115).alias("n"))
    return x.withColumn("start", S.crop_start(F.col("o_custkey"), F.col("n")))


@query("SELECT p_partkey, v AS view, (('0x' || substr(sha1(p_partkey || ':' || v), 1, 13))::BIGINT / 4503599627370496.0) < 0.3 AS lit FROM part, range(4) r(v)")
def seeded_choice(spark: SparkSession, sf: str) -> DataFrame:
    x = Tables(spark, sf).part.select("p_partkey", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("view"))
    return x.withColumn("lit", S.seeded_uniform(F.col("p_partkey"), F.col("view")) < 0.3)
