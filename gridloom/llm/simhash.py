"""SimHash fingerprints and their links at few differing bits, through a Gray-order hierarchical index.

The upper nodes of the index are masked bit patterns that Spark shuffles by: the 64 bits fall into
distance + 1 blocks, and two fingerprints within the distance agree in one block at least. A block value that
too many fingerprints share is divided by the blocks of its other bits, and what is still too large is dealt in
parts that meet pair by pair, so no node is dropped, cut or held in one task. Below, a task sorts each node's fingerprints by Gray rank, builds nodes of a few neighbours with the
bits all of them share, and descends from pairs of nodes, adding up differences in the bits newly shared, until a
pair of groups is pruned. All nodes of a task descend at once, those of two rows as those of thousands. Groups already
known to be connected are pruned too, so a dense group costs no all-pairs work, and only a spanning forest of the
links leaves the task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint, slices
from gridloom.operators.components import components

FANOUT, CHUNK = 2, 1 << 14


def simhash(text: bytes, shingle: int = 3) -> int:
    """Of the words between ASCII spaces, A-Z lowered; a bit is set if set in over half the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return hashed(join(words), 42)
    if shingle == 3:
        h = [hashed(b"%b %b %b" % w, 42) for w in zip(words, words[1:], words[2:], strict=False)]
    else:
        h = [hashed(join(words[i : i + shingle]), 42) for i in range(len(words) - shingle + 1)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = np.array(h[i : i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """All columns but ``text`` (null: empty), and ``fingerprint`` (long: the 64 bits), row for row; a column of that name is replaced."""
    rest = [c for c in docs.columns if c not in (text, "fingerprint")]
    at = len(rest)
    slim = docs.select(*rest, F.col(text).alias("__text"))
    schema = slim.select(*rest).schema.add("fingerprint", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            bodies = batch.column(at).cast(pa.binary())
            got = np.fromiter((simhash(x or b"", shingle) for x in bodies.to_pylist()), np.uint64, len(bodies)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(got)], names=[*rest, "fingerprint"])

    return slim.mapInArrow(run, schema)


# ---- the index within a task


def gray_rank(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class Forest:
    """Union-find over the rows of one node."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def find(self) -> np.ndarray:
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root = up
        return self.root

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            r = self.find()
            a, b = np.minimum(r[i], r[j]), np.maximum(r[i], r[j])
            on = a != b
            i, j, a, b = i[on], j[on], a[on], b[on]
            if len(i):  # each root hangs under one other root a round
                _, first = np.unique(b, return_index=True)
                self.root[b[first]] = a[first]
                self.edges += zip(i[first].tolist(), j[first].tolist(), strict=True)


class Index:
    """Levels of nodes over fingerprints that are sorted by group and, in it, by Gray rank; the top level has a node a group.

    Of a node are kept the bits that all rows below share (``mask``), their values, its first row, and its children.
    """

    def __init__(self, v: np.ndarray, group: np.ndarray):
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.value, self.mask, self.first, self.child = [v], [np.full(len(v), full)], [np.arange(len(v))], [np.zeros(len(v) + 1, np.int64)]
        while True:
            begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            if len(begin) == len(group):
                return
            place = np.arange(len(group)) - np.repeat(begin, np.diff(np.append(begin, len(group))))
            cut = np.flatnonzero(place % FANOUT == 0)
            val, mask = self.value[-1], self.mask[-1]
            same = np.bitwise_and.reduceat(mask, cut) & ~(np.bitwise_or.reduceat(val, cut) ^ np.bitwise_and.reduceat(val, cut))
            self.value.append(val[cut] & same)
            self.mask.append(same)
            self.first.append(self.first[-1][cut])
            self.child.append(np.append(cut, len(group)))
            group = group[cut]


def _expand(index: Index, level: int, a: np.ndarray, b: np.ndarray, diff: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs of children, each once, of pairs of nodes."""
    child = index.child[level]
    na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
    pair = np.repeat(np.arange(len(a)), na * nb)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
    ca, cb = child[a][pair] + k // nb[pair], child[b][pair] + k % nb[pair]
    on = ca <= cb
    pair = pair[on]
    return ca[on], cb[on], diff[pair], known[pair]


def links(v: np.ndarray, group: np.ndarray, distance: int, seen: Counter | None = None) -> list[tuple[int, int]]:
    """Rows (i, j) of a spanning forest of all pairs of a group within the distance.

    Rows must be in order of their groups, and in a group in Gray order. ``seen`` counts pairs of nodes visited, pruned by
    differences and pruned as connected, pairs of rows compared, links of neighbours and other links.
    """
    seen = Counter() if seen is None else seen
    forest, index = Forest(len(v)), Index(v, group)
    near = np.flatnonzero((np.bitwise_count(v[1:] ^ v[:-1]) <= distance) & (group[1:] == group[:-1]))
    seen["neighbours"] += len(near)
    forest.join(near, near + 1)  # neighbours in Gray order first: what is dense is soon known to be connected
    top = len(index.value) - 1
    each = np.arange(len(index.value[top]))
    stack = [(top, each, each, np.zeros(len(each), np.int64), np.zeros(len(each), np.uint64))]
    while stack:
        level, a, b, diff, known = stack.pop()
        if len(a) > CHUNK:
            for k in range(0, len(a), CHUNK):
                stack.append((level, a[k : k + CHUNK], b[k : k + CHUNK], diff[k : k + CHUNK], known[k : k + CHUNK]))
            continue
        value, mask = index.value[level], index.mask[level]
        shared = mask[a] & mask[b]
        diff = diff + np.bitwise_count((value[a] ^ value[b]) & shared & ~known)
        on = diff <= distance
        seen["nodes" if level else "rows"] += len(a) if level else int((a < b).sum())
        seen["pruned by differences"] += int((~on).sum())
        if not level:
            on &= a < b
            seen["links"] += int(on.sum())
            forest.join(a[on], b[on])
            continue
        r = forest.find()
        low, high = np.minimum.reduceat(r, index.first[level]), np.maximum.reduceat(r, index.first[level])
        apart = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
        seen["pruned as connected"] += int((on & ~apart).sum())
        on &= apart
        if on.any():
            stack.append((level - 1, *_expand(index, level, a[on], b[on], diff[on], shared[on])))
    return forest.edges


def _search(distance: int):
    def solve(key: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((gray_rank(v), key))
        key, v = key[order], v[order]
        same = key[1:] == key[:-1]
        company = np.append(False, same) | np.append(same, False)  # a fingerprint alone in its node has no pair
        key, v = key[company], v[company]
        if len(v) and (found := links(v, key, distance)):
            e = np.array(found)
            yield pa.RecordBatch.from_arrays([pa.array(v[e[:, k]].view(np.int64)) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, vals, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys.append(batch.column(0).to_numpy(zero_copy_only=False))
            vals.append(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            held += batch.num_rows
            if held >= 1 << 17:  # the last key may go on in the next batch
                key, v = np.concatenate(keys), np.concatenate(vals)
                at = int(np.searchsorted(key, key[-1]))
                if at:
                    yield from solve(key[:at], v[:at])
                keys, vals, held = [key[at:]], [v[at:]], len(key) - at
        if held:
            yield from solve(np.concatenate(keys), np.concatenate(vals))

    return run


def _bits(mask: int, blocks: int) -> list[int]:
    """The bits of a mask in blocks of as equal size as can be, each a mask."""
    on = [1 << k for k in range(64) if mask >> k & 1]
    at = [len(on) * k // blocks for k in range(blocks + 1)]
    return [sum(on[a:b]) for a, b in zip(at, at[1:], strict=False)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _upper(blocks: int):
    """Rows (key, fingerprint, free): for each block of the free bits, keyed by what the row had and the block's value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, v, free = (c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns)
            for mask in np.unique(free):
                mine = free == mask
                for block in map(np.uint64, _bits(int(mask), blocks)):
                    made = _mix(_mix(key[mine] ^ block) ^ (v[mine] & block)), v[mine], np.full(int(mine.sum()), mask & ~block)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in made], names=["key", "fingerprint", "free"])

    return run


def near_links(prints: DataFrame, distance: int = 3, cap: int = 200_000, divisions: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints, a spanning forest of each node's; their components are exact.

    ``prints``: one column ``fingerprint``, distinct. A block value of more than ``cap`` fingerprints is divided by the
    blocks of its other bits, ``divisions`` times. What is larger still is dealt in parts of about ``cap``, and
    every two parts meet in a task of their own. A key is a hash of blocks and values; a collision only adds candidates.
    """
    if not 1 <= distance <= 7:
        raise ValueError("distance must be 1 to 7")
    fields = "key long, fingerprint long, free long"
    keyed = prints.select(F.lit(0).cast("long").alias("key"), "fingerprint", F.lit(-1).cast("long").alias("free")).mapInArrow(_upper(distance + 1), fields)
    done: list[DataFrame] = []
    for division in range(divisions + 1):
        hot = checkpoint(keyed.groupBy("key").count().where(F.col("count") > cap))
        if hot.isEmpty():
            break
        done.append(keyed.join(hot.select("key"), "key", "left_anti").select("key", "fingerprint"))
        if division < divisions:
            rows = checkpoint(keyed.join(hot.select("key"), "key", "left_semi").select("key", "fingerprint", "free"))
            keyed = rows.mapInArrow(_upper(distance + 1), fields)
        else:
            both = keyed.join(hot, "key").withColumn("parts", F.ceil(F.col("count") / cap).cast("int")).withColumn("mine", F.pmod(F.xxhash64("fingerprint"), F.col("parts")))
            both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            keyed = both.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "fingerprint")
    done.append(keyed.select("key", "fingerprint"))
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = None
    for rows in done:
        found = rows.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_search(distance), "a long, b long")
        out = found if out is None else out.union(found)
    return out


def clusters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 3) -> DataFrame:
    """Row for row: ``doc_id``, ``text_hash`` (XXH64 of the text), ``fingerprint``, ``component`` and ``component_id``.

    component names the component by a fingerprint of it; it tells components apart where a doc_id stands in several.
    component_id is the smallest doc_id reachable by links of at most ``distance`` differing bits. Null texts are
    empty; texts without words have fingerprint 0 and link as any other. A row of null id links like others but
    names no component unless all of its ids are null (component_id is then null). Repeated rows stay repeated.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text"))
    rows = checkpoint(fingerprints(slim))
    classes = checkpoint(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    found = components(near_links(classes.select("fingerprint"), distance))
    named = classes.join(found, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("fingerprint", "component", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component", "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 3) -> DataFrame:
    """The same columns, one row of each component: the smallest id, then the smallest text hash; any one of equal rows."""
    found = checkpoint(clusters(docs, doc_id, text, distance))
    repeated = not found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    found = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("r"))
    keep = found.select(F.col("r.doc_id").alias("__id"), F.col("r.text_hash").alias("__hash"))
    marked = docs.withColumn("__hash", F.xxhash64(F.coalesce(F.col(text), F.lit("")))).alias("d")
    kept = marked.join(keep.alias("k"), F.col(f"d.{doc_id}").eqNullSafe(F.col("k.__id")) & (F.col("d.__hash") == F.col("k.__hash")), "left_semi")
    if repeated:
        first = Window.partitionBy(doc_id, "__hash").orderBy(F.lit(1))
        kept = kept.withColumn("__n", F.row_number().over(first)).where("__n = 1")
    return kept.select(*docs.columns)
