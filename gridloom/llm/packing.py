"""Best-fit packing of token pieces into sequences by linear grouping.

Lengths are integers up to the capacity, so what the plan depends on is a histogram of at most ``capacity``
numbers, whatever the size of the corpus. On the driver, large lengths are rounded up within groups of equal
cardinality, and a linear program over configurations of the few rounded sizes is solved by column generation. Its whole
part is filled with actual lengths: every slot but the last takes the longest left of its group, and the last, as the
others are shorter than planned, the longest that fits. What is left of the large ones is grouped anew, in finer groups,
until nothing more comes of it. Small lengths, and the last few large ones, go best-fit into the room that remains.
The plan is a table of runs: pieces of one length, by rank, to sequences of one make. The executors rank the pieces
of a length and look their run up.
"""

from __future__ import annotations

import bisect
import functools
import logging
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.bpe import each_batch, encoder_of_file
from gridloom.llm.common import checkpoint, with_fields

CAPACITY = 2048
_LOG = logging.getLogger(__name__)


# ---- tokens


def _cut(path: str, capacity: int, end: int, texts: list[str], _: pa.Array) -> list[pa.Array]:
    last, made = int(end).to_bytes(4, "little"), []
    for ids in encoder_of_file(path).encode(texts):
        ids += last
        n = len(ids) // 4
        first = n % capacity or capacity
        edges = [0, *range(first, n + 1, capacity)]
        made.append([{"start": a, "length": b - a, "ids_crc32": zlib.crc32(memoryview(ids)[4 * a : 4 * b])} for a, b in zip(edges, edges[1:], strict=False)])
    return [pa.array(made, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])))]


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a row for each piece of a document's ids and ``end``.

    Documents of up to ``capacity`` ids are one piece; of longer ones the first piece may be shorter, the others are
    full. Null and empty texts are the one id ``end``. Repeated rows are packed as often as they occur. Strings of the
    tokenizer's special tokens in a text are these tokens, as the tokenizer has it. Other columns are left out.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    cut = each_batch(slim, "text", {"pieces": "array<struct<start:long,length:long,ids_crc32:long>>"}, functools.partial(_cut, path, capacity, end))
    return cut.select("doc_id", F.posexplode("pieces").alias("piece", "p")).select("doc_id", "piece", "p.start", "p.length", "p.ids_crc32")


# ---- the plan, on the driver


def configurations(sizes: list[int], demand: list[int], capacity: int) -> tuple[list[tuple[tuple[int, ...], float]], float]:
    """(how many of each size, how often) of a fractional packing, and how far from 1 the best price of a further column is.

    Column generation with knapsack pricing; at 0 the packing is optimal. More than 0 is left only where the simplex
    method has stood still for 50 steps a size.
    """
    g = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    inverse = np.diag([1 / (capacity // s) for s in sizes])
    x = inverse @ np.array(demand, float)
    still = 0
    while True:
        price = inverse.sum(axis=0)  # every sequence costs 1
        best, took = np.zeros(capacity + 1), np.zeros((g, capacity + 1), np.int16)
        for k, s in enumerate(sizes):
            if price[k] <= 1e-12:
                continue
            base = best.copy()
            for n in range(1, capacity // s + 1):
                more = base[: capacity + 1 - n * s] + n * price[k]
                better = more > best[n * s :] + 1e-12
                best[n * s :][better] = more[better]
                took[k, n * s :][better] = n
        gap = float(best[capacity]) - 1
        if gap <= 1e-7:
            break
        column, room = np.zeros(g), capacity
        for k in range(g - 1, -1, -1):
            column[k] = took[k, room]
            room -= int(took[k, room]) * sizes[k]
        step = inverse @ column
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        still = still + 1 if ratio[out] * gap < 1e-9 else 0
        if still > 50 * g or not np.isfinite(ratio[out]):
            break
        x = x - ratio[out] * step
        x[out] = ratio[out]
        basis[:, out] = column
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
    return [(tuple(int(v) for v in basis[:, k]), float(x[k])) for k in range(g) if x[k] > 1e-9], max(gap, 0.0)


def _grouped(counts: dict[int, int], groups: int) -> tuple[list[int], list[int]]:
    """Greatest length and number of lengths of groups of equal cardinality, longest first; groups of one greatest length are one."""
    total, at, sizes = sum(counts.values()), 0, {}
    order = sorted(counts, reverse=True)
    ends = np.cumsum([counts[n] for n in order])
    for k in range(groups):
        end = total * (k + 1) // groups
        if end > at:
            size = order[int(np.searchsorted(ends, at, side="right"))]
            sizes[size] = sizes.get(size, 0) + end - at
            at = end
    return list(sizes), list(sizes.values())


class _Left:
    """Lengths that are not placed yet, and how many."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.order = sorted(self.counts)

    def longest(self, most: int, taken: Counter) -> int | None:
        """The longest of at most ``most`` of which more than ``taken`` are left."""
        k = bisect.bisect_right(self.order, most) - 1
        while k >= 0 and self.counts[self.order[k]] <= taken[self.order[k]]:
            k -= 1
        return self.order[k] if k >= 0 else None

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.pop(bisect.bisect_left(self.order, length))


def _whole_part(left: _Left, groups: int, capacity: int) -> list[list]:
    """[lengths, how often, room] of the sequences that the linear program fills as whole ones; they are taken from ``left``."""
    sizes, demand = _grouped(left.counts, groups)
    found, gap = configurations(sizes, demand, capacity)
    _LOG.info("%d groups of %d lengths: %.2f sequences, %s", len(sizes), sum(demand), sum(x for _, x in found), "optimal" if gap <= 1e-7 else f"within {gap:.1e} of the optimum")
    made = []
    for many, often in sorted(found, key=lambda c: -sum(n * s for n, s in zip(c[0], sizes, strict=True))):
        upto = [sizes[k] for k, n in enumerate(many) for _ in range(n)]
        todo = int(often + 1e-9)
        while todo:
            taken, lengths, room = Counter(), [], capacity
            for k, size in enumerate(upto):
                length = left.longest(room if k == len(upto) - 1 else min(room, size), taken)
                if length is None:
                    break
                taken[length] += 1
                lengths.append(length)
                room -= length
            if len(lengths) < len(upto):
                break
            step = min([todo, *(left.counts[x] // n for x, n in taken.items())])
            for x, n in taken.items():
                left.take(x, n * step)
            made.append([tuple(lengths), step, room])
            todo -= step
    return made


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = 32, large: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many such sequences), for a histogram length -> count.

    Large are lengths over ``large`` (a quarter of the capacity). Empty for an empty histogram. Work depends on the
    capacity and the number of groups, not on the counts.
    """
    large = capacity // 4 if large is None else large
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("lengths must be 1 to capacity")
    classes: list[list] = [[(capacity,), counts[capacity], 0]] if counts.get(capacity) else []
    pool = {n: c for n, c in counts.items() if n <= large and n < capacity and c}
    left = _Left({n: c for n, c in counts.items() if large < n < capacity and c})
    while sum(left.counts.values()) > groups:
        made = _whole_part(left, groups, capacity)
        if not made:
            break
        classes += made
    pool |= left.counts
    by_room: dict[int, list[list]] = {}
    for c in classes:
        by_room.setdefault(c[2], []).append(c)
    rooms = sorted(r for r in by_room if r)
    done = by_room.pop(0, [])

    def put(c: list) -> None:
        if not c[2]:
            done.append(c)
            return
        if c[2] not in by_room:
            by_room[c[2]] = []
            bisect.insort(rooms, c[2])
        by_room[c[2]].append(c)

    for length in sorted(pool, reverse=True):
        n = pool[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                c = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
                take = min(n, c[1])
                if take < c[1]:
                    put([c[0], c[1] - take, room])
                put([(*c[0], length), take, room - length])
            else:
                most = capacity // length
                take = max(1, n // most)
                each = most if n >= most else n
                put([(length,) * each, take, capacity - each * length])
                take *= each
            n -= take
    return [(tuple(c[0]), c[1]) for c in [*done, *(c for r in by_room.values() for c in r)] if c[1]]


def best_plan(counts: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = (32, 64), least: tuple[float, ...] = (1 / 4, 5 / 16)) -> list[tuple[tuple[int, ...], int]]:
    """The plan of fewest sequences over some numbers of groups and least large lengths, all under a third; the first of equals."""
    plans = [plan(counts, capacity, g, int(capacity * x)) for g in groups for x in least]
    return min(plans, key=lambda p: sum(n for _, n in p))


def slots(classes: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, offset), by rank: the pieces of a length in order of rank fill the slots."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for lengths, often in classes:
        offset = 0
        for n in lengths:
            at = ranks.get(n, 0)
            out.setdefault(n, []).append((at, sequence, offset))
            ranks[n] = at + often
            offset += n
        sequence += often
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


# ---- the executors


def pack(parts: DataFrame, capacity: int = CAPACITY, most: int = 1_000_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows (doc_id, piece, start, length, ids_crc32).

    Ranks are numbered within a length and a bucket of documents; a length has 64 buckets, or one for each ``most`` of its
    pieces if that is more, so a length that most rows have is dealt over many tasks. The driver gets a count for each length, and then for each
    length and bucket. No rows: no rows.
    """
    rows = checkpoint(parts)
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    buckets = F.get(F.lit([max(64, -(-counts.get(n, 0) // most)) for n in range(capacity + 1)]), F.col("length").cast("int"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), buckets).cast("int"))
    before: dict[tuple[int, int], int] = {}
    so_far: Counter[int] = Counter()
    for r in sorted(rows.groupBy("length", "bucket").count().collect()):
        before[r["length"], r["bucket"]] = so_far[r["length"]]
        so_far[r["length"]] += r["count"]
    table = slots(best_plan(counts, capacity))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(own)).select("doc_id", "piece", "start", "length", "ids_crc32", "bucket", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, bucket, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 5, 6))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                ranks = np.fromiter((before[int(n), b] for b in bucket[mine].tolist()), np.int64, len(mine)) + rank[mine] - 1
                at = np.searchsorted(table[int(n)][:, 0], ranks, side="right") - 1
                first, base, place_ = table[int(n)][at].T
                sequence[mine], offset[mine] = base + ranks - first, place_
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = ranked.select("doc_id", "piece", "start", "length", "ids_crc32").schema
    return ranked.mapInArrow(place, with_fields(schema, {"sequence_id": "long", "offset": "long"}))
