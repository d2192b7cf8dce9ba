"""Hand-computed cases, file formats, streaming, and invariants that need no SQL."""

import json
import math
import struct
import tarfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import arrays as A
from gridloom.functions import ids
import __spark_entry__ as entry
from gridloom.operators import attention, curation, kernels, mesh, motion, sharding, voxels, windows
from gridloom.sources import binary, tables
from gridloom.streaming import resume


def test_pooling_divisor(spark):
    v = spark.createDataFrame([(0, 0, 0, 0, 1.0), (0, 1, 1, 1, 3.0), (0, 2, 0, 0, 5.0), (1, 0, 0, 0, 7.0)], "b long, x long, y long, z long, f double")
    got = sorted(r["f"] for r in voxels.downsample(v, 2, ["f"]).collect())
    assert got == pytest.approx([4 / 3, 5 / 2, 7 / 2])
    assert sorted(r["f"] for r in voxels.downsample(v, 2, ["f"], "true_mean").collect()) == [2, 5, 7]


def test_empty_middle_item(spark):
    v = spark.createDataFrame([(0,), (0,), (2,)], "b long")
    assert [tuple(r) for r in voxels.layout(v).orderBy("b").collect()] == [(0, 0, 2), (1, 2, 2), (2, 2, 3)]


def test_pack_and_floor(spark):
    r = spark.range(1).select(A.pack(F.lit(3), F.lit(5), F.lit(5), 10).alias("p"), A.floor_div(F.lit(-7), 2).alias("d"), A.floor_mod(F.lit(-7), 2).alias("m")).first()
    assert (r["p"], r["d"], r["m"]) == (5248003, -4, 1)


def test_motion_rules(spark):
    f = spark.createDataFrame([("a", k + 1, v) for k, v in enumerate([0.0, 0.002, 0.0, 0.003, 0.0, None])], "object string, frame long, rms double")
    assert motion.trim(f, 0.001).first()["kept"] == 5
    assert motion.trim(f, 0.001, missing_moves=False).first()["kept"] == 3
    still = f.withColumn("rms", F.lit(0.0))
    assert motion.trim(still, 0.001).first()["kept"] == 6
    assert motion.trim(still, 0.001, keep_static=False).first()["kept"] == 0


def test_chunks_cover(spark):
    x = spark.range(10).select(sharding.chunk_floor(F.col("id"), F.lit(10), 3).alias("f"), sharding.chunk_ceil(F.col("id"), F.lit(10), 3).alias("c")).collect()
    assert [[r["f"] for r in x].count(k) for k in range(3)] == [3, 3, 4]
    assert [[r["c"] for r in x].count(k) for k in range(3)] == [4, 4, 2]


def test_positions_are_dense(spark):
    x = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r["v"] == r["rn0"] for r in sharding.positions(x, [F.col("v")]).collect())


def test_serial_windows_small(spark):
    v = spark.range(5).select(F.lit(0).cast("long").alias("b"), F.col("id").alias("row_id"), F.col("id").alias("c"))
    got = {}
    for r in windows.serial_windows(v, F.col("c"), 2).collect():
        got.setdefault(r["window"], []).append((r["slot"], r["rank"], r["owned"]))
    assert [[k for _, k, _ in sorted(got[w])] for w in range(3)] == [[4, 0], [1, 2], [3, 4]]
    assert sorted(k for w in got.values() for _, k, own in w if own) == [0, 1, 2, 3, 4]


def test_attention_by_hand(spark):
    e = spark.createDataFrame([(0, 0, [1.0], [1.0]), (0, 1, [0.0], [3.0])], "b long, k_id long, k array<double>, v array<double>")
    q = e.select("b", F.col("k_id").alias("q_id"), F.col("k").alias("q"))
    out = {r["q_id"]: r["out"][0] for r in attention.attend(q, e, ["b"]).collect()}
    assert out[0] == pytest.approx(1.5378828) and out[1] == pytest.approx(2.0)


def test_seed_and_ids(spark):
    r = spark.range(1).select(ids.stable_seed(F.lit("000-033/a.glb"), 7).alias("s"), ids.first_match(F.lit("a00052d0d9a304d308058260a4a9b7c20"), ids.HEX32).alias("h")).first()
    assert r["s"] == 1572218612 and r["h"] is None


def test_hilbert_is_a_walk(spark):
    n = F.col("id")
    g = spark.range(512).select((n % 8).alias("x"), (F.floor(n / 8) % 8).alias("y"), F.floor(n / 64).alias("z"))
    got = sorted((r["h"], r["x"], r["y"], r["z"]) for r in g.select("x", "y", "z", windows.hilbert(F.col("x"), F.col("y"), F.col("z"), 3).alias("h")).collect())
    assert [h for h, *_ in got] == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:], strict=True)) == 1 for p, q in zip(got, got[1:], strict=False))


def test_similarity_fit(spark):
    rng = np.random.default_rng(0)
    p = rng.normal(size=(40, 3))
    turn = np.array([[math.cos(0.4), -math.sin(0.4), 0], [math.sin(0.4), math.cos(0.4), 0], [0, 0, 1]])
    t = 1.7 * p @ turn.T + [1, 2, 3]
    df = spark.createDataFrame([(1, *map(float, a), *map(float, b)) for a, b in zip(p, t, strict=True)], "mesh long, x double, y double, z double, tx double, ty double, tz double")
    r = mesh.similarity_fit(df, ["mesh"]).first()
    assert r["scale"] == pytest.approx(1.7) and r["rms"] < 1e-9
    assert np.allclose(np.array(r["rotation"]).reshape(3, 3), turn)


def test_meshes_of_one_point_and_weights_of_zero(spark):
    v = spark.createDataFrame([(0, 0, 0, 1.0, 2.0, 3.0), (1, 0, 0, 0.0, 0.0, 0.0), (1, 1, 0, 4.0, 2.0, 0.0)], "mesh long, vid long, frame long, x double, y double, z double")
    for own in (False, True):
        got = {(r["mesh"], r["vid"]): (r["x"], r["y"], r["z"]) for r in mesh.normalize_sequence(v, per_frame_centre=own).collect()}
        assert got[0, 0] == (0.0, 0.0, 0.0) and got[1, 1] == pytest.approx((0.95, 0.475, 0.0))
    rows = spark.createDataFrame([(0, 1, 0.0), (0, 2, 0.0), (1, 1, 0.0), (1, 2, 3.0)], "mesh long, fid long, w double")
    draws = spark.createDataFrame([(0, 1, 0.5), (1, 1, 0.5)], "mesh long, draw long, u double")
    assert {r["mesh"]: r["picked"] for r in mesh.sample_by_weight(rows, draws, "w", "fid").collect()} == {0: None, 1: 2}


def test_serial_windows_against_all_windows(spark):
    """Every row in every window that holds its place, by trying all windows."""
    for n, window, shift in ((1, 4, 0), (4, 4, 3), (5, 4, 0), (37, 5, 2), (101, 10, -7), (23, 3, 40)):
        v = spark.range(n).select(F.lit(0).cast("long").alias("b"), F.col("id").alias("row_id"), (F.col("id") * 7 % n).alias("c"))
        got = {(r["window"], r["slot"]): (r["rank"], r["owned"]) for r in windows.serial_windows(v, F.col("c"), window, shift).collect()}
        k = -(-n // window)
        want = {}
        for i in range(k):
            begin = 0 if k == 1 else math.floor((i + 0.5) * (n / k) + shift - 0.5 * window)
            for slot in range(n if k == 1 else window):
                own = k == 1 or math.floor(i * (n / k) + shift) <= begin + slot < math.floor((i + 1) * (n / k) + shift)
                want[i, slot] = ((begin + slot) % n, own)
        assert got == want, (n, window, shift)


def test_ranks_within_hot_keys(spark):
    x = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 3000).alias("v"))
    rows = sharding.ranks(x, ["k"], [F.col("v")]).collect()
    by = {}
    for r in rows:
        by.setdefault(r["k"], []).append((r["v"], r["rank"]))
    assert len(rows) == 3000 and all([k for _, k in sorted(g)] == list(range(len(g))) for g in by.values())


def test_keep_and_null_keys(spark):
    x = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2)], "k int, v string, s int")
    assert sorted((r["k"], r["v"]) for r in curation.keep_last(x, ["k"], "s").collect()) == [(1, "b"), (2, "c")]
    h = spark.createDataFrame([(None, 1), ("a", 2)], "sha256 string, n int")
    assert curation.join_suffixed(h, h, "sha256").count() == 1


def test_files(spark, tmp_path):
    js = json.dumps({"meshes": [{"primitives": [1, 2]}, {"primitives": [3]}], "nodes": [{"mesh": 0}, {}, {"mesh": 1}]}).encode()
    js += b" " * (-len(js) % 4)
    body = struct.pack("<II", len(js), 0x4E4F534A) + js
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.glb").write_bytes(struct.pack("<III", 0x46546C67, 2, 12 + len(body)) + body)
    (tmp_path / "d/b.glb").write_bytes(b"nonsense....")
    found = binary.read_glb_json(spark, str(tmp_path))
    assert found.where("error is not null").count() == 1
    assert tuple(binary.glb_counts(found).first())[1:] == (2, 3, 2)
    np.savez(tmp_path / "s.npz", vertices=np.arange(12).reshape(2, 2, 3).astype(np.float16), faces=np.array([[0, 1, 1]], np.int32), frame_indices=np.array([4, 6], np.int32))
    v, f = binary.read_mesh_sequences(spark, str(tmp_path))
    assert sorted({r["frame"] for r in v.collect()}) == [4, 6] and f.count() == 1
    (tmp_path / "broken.npz").write_bytes(b"PK nonsense")
    np.savez(tmp_path / "other.npz", vertices=np.zeros((2, 2)))
    v, f = binary.read_mesh_sequences(spark, str(tmp_path))
    assert sorted({r["frame"] for r in v.where("error is null").collect()}) == [4, 6] and f.where("error is null").count() == 1
    assert v.where("error is not null").count() == 2 == f.where("error is not null").count()
    with tarfile.open(tmp_path / "t.tar", "w") as t:
        t.add(tmp_path / "s.npz", "./x/y/s.npz")
    (tmp_path / "cut.tar").write_bytes(b"no archive")
    assert binary.tar_names(spark, str(tmp_path)).where("error is not null").count() == 1
    assert [r["object"] for r in binary.tar_objects(spark, str(tmp_path)).collect()] == ["x/y"]
    (tmp_path / "m.json").write_text(json.dumps([{"a": 1, "n": {"b": 2}}]))
    assert tables.load_table(spark, str(tmp_path / "m.json")).columns == ["a", "n.b"]
    (tmp_path / "ids.txt").write_text(" A \n\nb\nB\n")
    assert sorted(r["id"] for r in tables.read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        tables.load_table(spark, "x.bin")
    (tmp_path / "r").mkdir()
    (tmp_path / "r/a.json").write_text('{"results": [1], "num_frames": 7}')
    (tmp_path / "r/b.json").write_text("{broken")
    assert tables.valid_reports(tables.read_reports(spark, str(tmp_path / "r"), "results array<int>")).count() == 1
    assert sorted(r["value"] or 0 for r in tables.scan_field(spark, str(tmp_path / "r"), "num_frames").collect()) == [0, 7]
    assert tables.list_files(spark, str(tmp_path), "*.glb").count() == 2


def test_stream_fold(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"k": 1, "s": 1, "v": "a"}\n{"k": 1, "s": 2, "v": "b"}\n{"k": 2, "s": 1, "v": "c"}\n')
    held = []
    read = lambda: spark.createDataFrame(held[-1], "k long, s long, v string") if held else None
    resume.fold_reports(spark, str(tmp_path / "in"), "k long, s long, v string", read, lambda df: held.append([tuple(r) for r in df.select("k", "s", "v").collect()]), ["k"], "s", str(tmp_path / "state")).awaitTermination(120)
    assert sorted(held[-1]) == [(1, 2, "b"), (2, 1, "c")]


def test_kernel_failures_are_rows(spark):
    def kernel(item):
        if item["id"] == 1:
            raise RuntimeError("no")
        return [{"id": item["id"], "error": None}]

    got = kernels.run_kernel(spark.range(3), None, kernel, "id long,error string", "id", 2).collect()
    assert {r["id"]: r["error"] for r in got} == {0: None, 1: "RuntimeError: no", 2: None}


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """(folder, rows) of a small lineitem: all line numbers, repeated places, edges that few faces share."""
    names = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount".split()
    rng = np.random.default_rng(7)
    rows = [(int(o), n, int(rng.integers(0, 60)), int(rng.integers(0, 60)), float(rng.integers(1, 50)), 1.5, 0.25) for o in range(60) for n in range(1, 8)]
    # two faces that share an edge with a third only, which is of another order
    rows += [(70, 1, 71, 80, 1.0, 1.0, 0.0), (70, 5, 71, 80, 1.0, 1.0, 0.0), (73, 5, 71, 80, 1.0, 1.0, 0.0)]
    to = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double").write.parquet(f"{to}/lineitem.parquet")
    return to, [dict(zip(names, r, strict=True)) for r in rows]


def test_whole_components_brute_force(spark, lines):
    to, rows = lines
    up, by_edge = {}, {}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in rows:
        fid = ((x["l_orderkey"] * 10 + x["l_linenumber"]) * 100000 + x["l_partkey"]) * 10000 + x["l_suppkey"]
        mesh, (a, b, c) = x["l_suppkey"], (x["l_orderkey"] % 97, x["l_partkey"] % 97, (x["l_orderkey"] // 97 + x["l_linenumber"] * 13) % 97)
        me = (mesh, fid)
        up[me] = me
        for p, q in ((a, b), (b, c), (c, a)):
            other = top(by_edge.setdefault((mesh, min(p, q), max(p, q)), me))
            mine = top(me)
            up[max(mine, other)] = min(mine, other)
    want = sorted((m, f, top((m, f))[1]) for m, f in up)
    got = sorted((r["mesh"], r["fid"], r["component"]) for r in entry.queries()["mesh_components"](spark, to).collect())
    assert got == want and len(got) == len(rows)
    assert len({w[::2] for w in want if w[1] > 70 * 10**10}) == 1


def test_seeds_of_repeated_paths(spark, tmp_path):
    pages = [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (6, "b"), (7, "c")]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = sorted(tuple(r) for r in entry.queries()["seeds_manifest"](spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(entry.oracle_sql()["seeds_manifest"]).fetchall()) and len(got) == 6
    known = spark.createDataFrame([("a", 5), ("a", 4)], "path string, seed long")
    items = spark.createDataFrame([("a",), ("a",), ("b",)], "path string")
    assert sorted(tuple(r) for r in curation.seed_manifest(items, known, F.lit(9).cast("long")).collect()) == [("a", 4), ("a", 4), ("b", 9)]


def grid(spark):
    """Vertices made by an explode, as Spark's estimate of sizes leaves it out."""
    v = spark.range(3).select(F.col("id").alias("mesh"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("vid"))
    return v.select("mesh", "vid", *[(F.col("vid") * k % 7).cast("double").alias(a) for k, a in zip((1, 2, 3), "xyz", strict=True)])


def broadcasts(df):
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


def test_normalize_broadcasts_no_vertices(spark):
    assert not broadcasts(mesh.normalize(grid(spark), ["mesh"]))


def test_normalize_sphere_broadcasts_no_vertices(spark):
    assert not broadcasts(mesh.normalize(grid(spark), ["mesh"], mode="sphere"))


def test_normalize_sequence_broadcasts_no_vertices(spark):
    assert not broadcasts(mesh.normalize_sequence(grid(spark).withColumn("frame", F.explode(F.array(F.lit(0), F.lit(1))))))


def test_normalize_frames_broadcasts_no_vertices(spark):
    assert not broadcasts(mesh.normalize_sequence(grid(spark).withColumn("frame", F.explode(F.array(F.lit(0), F.lit(1)))), per_frame_centre=True))


def attention_rows(spark):
    """Queries and rows with nulls, other lengths, repeated ids and keys of one side only."""
    rng = np.random.default_rng(5)
    vec = lambda n: [float(x) for x in rng.normal(size=n).round(3)]
    q = [(i % 3, i // 2 if i < 4 else i, vec(3)) for i in range(20)] + [(0, 90, None), (0, 91, [1.0, None, 2.0]), (1, 92, vec(2)), (7, 93, vec(3)), (None, 94, vec(3)), (0, None, vec(3))]
    kv = [(i % 4, i // 5, i, vec(3), vec(2)) for i in range(60)] + [(0, 3, 100, None, vec(2)), (0, 50, 101, [None, 1.0, 1.0], vec(2)), (1, 4, 102, vec(2), vec(2)), (2, 5, 103, vec(3), [None, 1.0]), (1, 6, 104, vec(3), [1.0]), (None, 1, 105, vec(3), vec(2))]
    return spark.createDataFrame(q, "b long, q_id long, q array<double>"), spark.createDataFrame(kv, "b long, block long, k_id long, k array<double>, v array<double>")


def softmax_by_hand(q, kv):
    """Pairs by (key, q_id): scores that are not null, with their blocks and values; and every block met."""
    pairs, met = {}, {}
    for a in q.collect():
        for r in kv.collect():
            if a["b"] is not None and a["b"] == r["b"]:
                at = pairs.setdefault((a["b"], a["q_id"]), [])
                met.setdefault((a["b"], a["q_id"]), set()).add(r["block"])
                if a["q"] and r["k"] and len(a["q"]) == len(r["k"]) and None not in a["q"] + r["k"]:
                    at.append((float(np.dot(a["q"], r["k"])) / math.sqrt(len(a["q"])), r["block"], r["v"] + [None]))
    return pairs, met


def test_attend_odd_rows_and_no_pairs_moved(spark):
    q, kv = attention_rows(spark)
    pairs, _ = softmax_by_hand(q, kv)
    for tile in (3, 100):
        x = attention.attend(q, kv.select("b", "k_id", "k", "v"), ["b"], dim=2, tile=tile)
        got = {(r["b"], r["q_id"]): r for r in x.collect()}
        assert got.keys() == pairs.keys()
        for at, found in pairs.items():
            if not found:
                assert got[at]["lse"] is None and got[at]["out"] == [None, None]
                continue
            e = [math.exp(s) for s, _, _ in found]
            assert got[at]["lse"] == pytest.approx(math.log(sum(e)))
            assert got[at]["out"] == pytest.approx([sum(w * v[i] for w, (_, _, v) in zip(e, found, strict=True) if v[i] is not None) / sum(e) for i in range(2)])
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert not any("Join" in line and ("k#" in line.split("Join", 1)[1] or "q#" in line.split("Join", 1)[1]) for line in plan.splitlines()) and "exp(" not in plan


def test_best_blocks_odd_rows_and_ties(spark):
    q, kv = attention_rows(spark)
    pairs, met = softmax_by_hand(q, kv)
    want = {}
    for at, found in pairs.items():
        total, share = sum(math.exp(s) for s, _, _ in found), dict.fromkeys(met[at], -1.0)
        for s, block, _ in found:
            share[block] = max(share[block], 0) + math.exp(s) / total
        best = sorted(sorted(share, key=lambda k: (-round(share[k], 9), k))[:4])
        want[at] = best + [-1] * (4 - len(best))
    for tile in (3, 100):
        x = attention.best_blocks(q, kv, ["b"], "block", 4, scale=1 / math.sqrt(3), tile=tile)
        got = {}
        for r in x.orderBy("slot").collect():
            got.setdefault((r["b"], r["q_id"]), []).append(r["block"])
        assert {k: v for k, v in got.items() if k != (1, 92)} == {k: v for k, v in want.items() if k != (1, 92)}
    one = spark.createDataFrame([(0, i, [1.0]) for i in range(3)], "b long, q_id long, q array<double>")
    same = spark.createDataFrame([(0, i // 2, i, [2.0]) for i in range(40)], "b long, block long, k_id long, k array<double>")
    assert {r["block"] for r in attention.best_blocks(one, same, ["b"], "block", 4).collect()} == {0, 1, 2, 3}  # of equals the least
    old = attention.top_blocks(attention.block_scores(q, kv, ["b"], "block", scale=0.5), ["b"], "block", 4)
    new = attention.best_blocks(q, kv, ["b"], "block", 4, scale=0.5, tile=3)
    assert sorted(map(str, old.collect())) == sorted(map(str, new.select(old.columns).collect()))
def test_sharp_vertices_broadcasts_no_vertices(spark):
    v = grid(spark)
    f = v.where("vid < 8").select("mesh", F.col("vid").alias("fid"), F.col("vid").alias("a"), (F.col("vid") + 1).alias("b"), (F.col("vid") * 3 % 10).alias("c"))
    n = v.where("vid <> 4").select("mesh", "vid", F.lit(0.6).alias("nx"), F.lit(0.0).alias("ny"), F.lit(0.8).alias("nz"))
    place = {(r["mesh"], r["vid"]): np.array([r["x"], r["y"], r["z"]]) for r in v.collect()}
    want = {}
    for r in f.collect():
        p, q, s = (place[r["mesh"], r[c]] for c in "abc")
        up = np.cross(q - p, s - p)
        d = up @ [0.6, 0.0, 0.8] / max(np.linalg.norm(up), 1e-12)
        for c in "abc":
            if r[c] != 4:
                want[r["mesh"], r[c]] = min(d, want.get((r["mesh"], r[c]), 9))
    for small in (1000, 2):  # packed meshes, and a join for each corner
        x = mesh.sharp_vertices(f, v, n, small=small)
        assert {(r["mesh"], r["vid"]): r["least_dot"] for r in x.collect()} == pytest.approx(want)
        assert not broadcasts(x) and not broadcasts(mesh.corners(f, v, small=small))
    twice = v.unionByName(v.where("mesh = 1 and vid = 3"))  # a repeated vertex counts as often as a join says
    size = f.count() + 3 * f.where("mesh = 1").select(F.sum(F.expr("int(a = 3) + int(b = 3) + int(c = 3)"))).first()[0] // 3
    assert mesh.corners(f, twice).count() == mesh.corners(f, twice, small=2).count() == size
