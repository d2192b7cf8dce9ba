"""Near-duplicate embeddings through a forest of random-projection trees.

Equal vectors are one class from the start. Trees are grown on a sample that grows with the input up to a bound in
bytes: a node splits at the median of the projections on a random direction, and vectors close to the split go to both
sides (spill). Trees are as deep as the number of vectors asks, down to nodes of two sampled vectors; the nodes of one depth of
a tree share their few directions, so a tree is a few numbers a node. All classes are routed through all trees. A leaf compares its classes in blocks, in double precision. A pair that shares several leaves counts in
the first of them only, which both rows can tell from the leaves they carry, so no pair has to leave the task: a leaf
sends a number of links for each class and a spanning forest of its links. Leaves that a dense group fills beyond
``cap`` are compared tile by tile in separate tasks, all tiles of them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint, with_fields
from gridloom.operators.components import components

#: Vectors that trees are grown on: this many, or one in ``ONE_IN`` of all if that is more, but no more than fit ``SAMPLE_BYTES``.
SAMPLE, ONE_IN, SAMPLE_BYTES = 20_000, 1000, 64 << 20
#: Directions that a node can choose from: a dense group may lie on one side of one as a whole.
TRIES = 4
TREES, LEAF, CAP, SEED, BLOCK = 6, 1000, 4000, 20240229, 1024


class Tree:
    """Arrays of nodes: which direction of its depth, threshold and children of inner ones, leaf number of the others."""

    def __init__(self, sample: np.ndarray, depth: int, spill: float, rng: np.random.Generator):
        ways = rng.standard_normal((depth, TRIES, sample.shape[1]))
        self.ways = ways / np.linalg.norm(ways, axis=2, keepdims=True)
        self.spill = spill
        nodes: list[tuple[int, float, int, int]] = [(0, 0.0, -1, -1)]
        level = [(0, np.arange(len(sample)))]
        for way in self.ways:
            p, below = sample @ way.T, []
            for me, rows in level:
                for k in range(TRIES if len(rows) > 1 else 0):
                    q = p[rows, k]
                    cut = float(np.median(q))
                    left, right = rows[q <= cut + spill], rows[q > cut - spill]
                    most = max(len(left), len(right))
                    if most <= 0.85 * len(rows) or (len(rows) < 8 and most < len(rows)):
                        nodes[me] = (k, cut, len(nodes), len(nodes) + 1)
                        below += [(len(nodes), left), (len(nodes) + 1, right)]
                        nodes += [(0, 0.0, -1, -1)] * 2
                        break
            level = below
        way_, at, left_, right_ = zip(*nodes, strict=True)
        self.way, self.at, self.left, self.right = np.array(way_, np.int8), np.array(at), np.array(left_, np.int32), np.array(right_, np.int32)
        self.leaf = np.where(self.left < 0, np.cumsum(self.left < 0) - 1, -1).astype(np.int32)
        self.leaves = int((self.left < 0).sum())

    def route(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(leaves, rows) of unit vectors, a depth at a time."""
        rows, node = np.arange(len(x)), np.zeros(len(x), np.int32)
        for way in [*self.ways, None]:
            ends = self.leaf[node] >= 0
            yield self.leaf[node[ends]], rows[ends]
            rows, node = rows[~ends], node[~ends]
            if way is None or not len(rows):
                return
            p = (x @ way.T)[rows, self.way[node]] - self.at[node]
            a, b = p <= self.spill, p > -self.spill
            rows, node = np.concatenate([rows[a], rows[b]]), np.concatenate([self.left[node[a]], self.right[node[b]]])


def grow(sample: np.ndarray, n: int, least: float, trees: int = TREES, leaf: int = LEAF, seed: int = SEED) -> list[Tree]:
    """Trees for n unit vectors. Half the spill is half of what a pair at the threshold deviates by on a random direction."""
    d = sample.shape[1]
    spill = 0.5 * math.sqrt(max(0.0, 2 - 2 * least)) / math.sqrt(d)
    depth = max(0, math.ceil(math.log2(max(1, n / leaf)) / 0.83))
    rng = np.random.default_rng(seed)
    return [Tree(sample, depth, spill, rng) for _ in range(trees)]


def _unit(column: pa.Array, d: int) -> np.ndarray:
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)
    x = x / np.abs(x).max(axis=1, initial=0)[:, None]  # squares of very large or small components leave the range
    return x / np.linalg.norm(x, axis=1)[:, None]


def _route(trees: list[Tree], d: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = np.cumsum([0, *(t.leaves for t in trees)])
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _unit(batch.column(2), d)
        leaves: list[list[int]] = [[] for _ in range(len(x))]
        for t, tree in enumerate(trees):
            for leaf, rows in tree.route(x):
                for r, k in zip(rows.tolist(), (leaf + base[t]).tolist(), strict=True):
                    leaves[r].append(k)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([sorted(v) for v in leaves], pa.list_(pa.int32()))], names=["class", "size", "embedding", "leaves"])


def _compare(d: int, least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (leaf, i, j, side, class, size, embedding, leaves) in order of the first three: a tile at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
        cut = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cut, cut[1:], strict=False):
            now = tuple(keys[:, a].tolist())
            if held and now != key:
                yield from _tile(held, key, d, least)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield from _tile(held, key, d, least)


def _tile(held: list[pa.RecordBatch], key: tuple, d: int, least: float) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held).combine_chunks()
    side, ids, size = (rows.column(k).to_numpy() for k in (3, 4, 5))
    x = _unit(rows.column(6).combine_chunks(), d)
    lists = rows.column(7).to_pylist()
    earlier = [[v for v in own if v < key[0]] for own in lists]
    wide = max(map(len, earlier), default=0)
    before = np.full((len(ids), max(wide, 1)), -1, np.int64)
    for r, own in enumerate(earlier):
        before[r, : len(own)] = own
    before[before < 0] = -1 - np.arange(len(ids)).repeat(before.shape[1]).reshape(before.shape)[before < 0]  # equal to no other's
    across = key[1] != key[2]
    left = np.flatnonzero(side == 0) if across else np.arange(len(ids))
    right = np.flatnonzero(side == 1) if across else left
    links, parent, a_out, b_out = np.zeros(len(ids), np.int64), np.arange(len(ids)), [], []
    for p in range(0, len(left), BLOCK):
        for q in range(0 if across else p, len(right), BLOCK):
            u, v = left[p : p + BLOCK], right[q : q + BLOCK]
            hit = x[u] @ x[v].T >= least
            if not across and p == q:
                hit = np.triu(hit, 1)
            i, j = (w[z] for w, z in zip((u, v), np.nonzero(hit), strict=True))
            for c in range(wide):
                if not len(i):
                    break
                new = ~(before[i, c][:, None] == before[j]).any(axis=1)
                i, j = i[new], j[new]
            np.add.at(links, i, size[j])
            np.add.at(links, j, size[i])
            while len(i):  # union, a link for each join
                while not np.array_equal(up := parent[parent], parent):
                    parent = up
                lo, hi = np.minimum(parent[i], parent[j]), np.maximum(parent[i], parent[j])
                on = lo != hi
                i, j, lo, hi = i[on], j[on], lo[on], hi[on]
                if len(i):
                    _, one = np.unique(hi, return_index=True)
                    parent[hi[one]] = lo[one]
                    a_out += ids[i[one]].tolist()
                    b_out += ids[j[one]].tolist()
    some = np.flatnonzero(links)
    if len(some):
        a, b, n = [*ids[some].tolist(), *a_out], [*[None] * len(some), *b_out], [*links[some].tolist(), *[0] * len(a_out)]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "links"])


def _linked(classes: DataFrame, d: int, least: float, trees: int, leaf: int, cap: int, sample: int) -> DataFrame:
    """(a, b, links) of classes (class, size, embedding) of one dimension: numbers of links (b null) and a forest."""
    n = classes.count()
    sample = min(max(sample, n // ONE_IN), SAMPLE_BYTES // (8 * d))
    some = classes.select("embedding", F.xxhash64("embedding").alias("h")).orderBy("h").limit(sample).select("embedding").toArrow()
    grown = grow(_unit(some.column(0).combine_chunks(), d), n, least, trees, leaf)
    routed = classes.mapInArrow(functools.partial(_route, grown, d), with_fields(classes.schema, {"leaves": "array<int>"}))
    sent = checkpoint(routed).withColumn("leaf", F.explode("leaves"))
    hot = sent.groupBy("leaf").count().where(F.col("count") > cap).select("leaf", F.ceil(F.col("count") / cap).cast("int").alias("parts"))
    hot = checkpoint(hot)
    names = ["class", "size", "embedding", "leaves"]
    if hot.isEmpty():
        tiles = sent.select("leaf", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), *names)
    else:
        both = sent.join(hot, "leaf", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        both = both.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        tiles = both.select("leaf", F.least("mine", "o").alias("i"), F.greatest("mine", "o").alias("j"), (F.col("mine") > F.col("o")).cast("int").alias("side"), *names)
    k = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.repartition(k, "leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")
    return tiles.mapInArrow(functools.partial(_compare, d, least), "a long, b long, links long")


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95,
    trees: int = TREES, leaf: int = LEAF, cap: int = CAP, sample: int = SAMPLE,
) -> DataFrame:
    """Row for row: vec_id, n_links, component_id (smallest vec_id reachable) and kept (vec_id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Rows of null id have no links, a null component and are not kept. Repeated rows are vectors of
    their own: each counts as a link of the others, and all have the same component. Rows that share a vec_id but not
    the vector are nodes of their own too, each with its own links and component; the shared id links nothing.
    """
    emb = F.col("embedding")
    fine = emb.isNotNull() & F.col("vec_id").isNotNull() & (F.size(emb) > 0) & F.coalesce(F.forall(emb, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False)) & F.exists(emb, lambda v: v != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")).withColumn("fine", F.coalesce(fine, F.lit(False)))
    key = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding", F.hash("embedding")).alias("h2")]
    good = rows.where("fine").select("vec_id", "embedding", F.size("embedding").alias("d"), *key)
    classes = good.groupBy("h1", "h2", "d").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("embedding").alias("embedding"))
    classes = checkpoint(classes.withColumn("class", F.monotonically_increasing_id()))
    found = None
    for r in sorted(x["d"] for x in classes.select("d").distinct().collect()):
        part = _linked(classes.where(F.col("d") == r).select("class", "size", "embedding"), r, least, trees, leaf, cap, sample)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = checkpoint(found)
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "class")
    joined = components(found.where("b is not null"))
    about = classes.select("h1", "h2", "class", "least", "size").join(links, "class", "left").join(joined.withColumnRenamed("node", "class"), "class", "left")
    about = about.select("h1", "h2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "least", "component")
    # only components of several classes need a look for their smallest id
    smallest = about.where("component is not null").groupBy("component").agg(F.min("least").alias("smallest"))
    about = about.join(smallest, "component", "left").select("h1", "h2", "n", F.coalesce("smallest", "least").alias("c"))
    marked = rows.select("vec_id", *[F.when(F.col("fine"), k).alias(f"k{i}") for i, k in enumerate(key)])
    out = marked.join(about, (F.col("k0") == F.col("h1")) & (F.col("k1") == F.col("h2")), "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
