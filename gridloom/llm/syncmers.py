"""Document fingerprints of closed syncmers.

A k-mer of code points is a closed syncmer if the least of its s-mers, by hash, is its first or its last. Whether it
is one depends on nothing around it, so equal stretches of two texts have the same anchors. A fingerprint is the
``SKETCH`` anchors of least hash, each with the place where it stands first; texts shorter than k are one anchor.

Likeness matches positions: of the least hashes of both fingerprints together, the share that both have in the same
order, that is the longest chain of common anchors whose places ascend in both. A fingerprint has ``SKETCH`` anchors however
long the text is, so likeness is an estimate of the share among all anchors, with a standard error of sqrt(p(1-p)/SKETCH), 0.044 at most.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices

K, S, SKETCH = 12, 4, 128
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def anchors(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the closed syncmers, in order; an array shorter than k is one anchor, an empty one has none."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    c = codes.astype(np.uint64)
    if n < k:
        h = np.uint64(n)
        with np.errstate(over="ignore"):
            for x in c:
                h = (h ^ x) * _A
                h ^= h >> np.uint64(29)
        return np.zeros(1, np.int64), _mix(np.array([h], np.uint64))
    m = n - s + 1
    inner = c[:m]
    for j in range(1, s):
        inner = inner * _A + c[j : j + m]
    inner = _mix(inner)
    width = k - s + 1  # s-mers of a k-mer
    least, have = inner, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    at = np.flatnonzero((inner[: n - k + 1] == least) | (inner[width - 1 :] == least))
    h = inner[at]
    for j in range(s, k - s + 1, s):
        h = h * _B + inner[at + j]
    if (k - s) % s:
        h = h * _B + inner[at + k - s]
    return at, _mix(h)


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of 40 bits, first places) of a text's anchors, by hash."""
    places, hashes = anchors(codes)
    h, first = np.unique(hashes >> np.uint64(24), return_index=True)
    return h.astype(np.int64), places[first]


def sketch(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, at = distinct(codes)
    return h[:SKETCH], at[:SKETCH]


def as_string(sk: tuple[np.ndarray, np.ndarray]) -> str:
    """Lowercase hex digits, ten of the hash and eight of the place for each anchor, ascending by hash."""
    return "".join(f"{x:010x}{p:08x}" for x, p in zip(sk[0].tolist(), sk[1].tolist(), strict=True))


def chain(a: np.ndarray, b: np.ndarray) -> int:
    """The greatest number of pairs of places (a, b) that ascend in both."""
    ends: list[int] = []  # least last place of a chain of each length
    for x in b[np.lexsort((-b, a))].tolist():
        k = bisect.bisect_left(ends, x)
        ends[k : k + 1] = [x]
    return len(ends)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], most: int = SKETCH) -> float:
    """0 to 1; two empty texts are alike. ``a`` and ``b``: sketches, or with a greater ``most`` all anchors."""
    if not len(a[0]) and not len(b[0]):
        return 1.0
    both = np.union1d(a[0], b[0])[:most]
    h, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    n = int(np.searchsorted(h, both[-1], side="right"))
    return chain(a[1][i[:n]], b[1][j[:n]]) / len(both)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, context, doc_id, text) in order: a row and the next of its part; context rows are only next ones."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=NAMES)

    last = None  # (part, doc_id, text, code points, sketch), of which the next is awaited
    for batch in slices(batches, 3):
        rows = []
        for part, context, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if context and (last is None or last[0] != part):
                continue
            text = text or ""
            codes = code_points(text)
            own = sketch(codes)
            if last is not None and last[0] == part:
                _, d, t, c, sk = last
                half = len(t) // 2
                edited = sketch(np.concatenate([c[: len(c) - half], codes[:half]])) if half else sk
                digest = hashlib.sha256((t[: len(t) - half] + text[:half]).encode()).hexdigest()
                rows.append((d, len(t), digest, as_string(sk), as_string(edited), likeness(sk, edited), likeness(sk, own)))
            last = None if context else (part, doc, text, codes, own)
        if rows:
            yield out(rows)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _order_keys(doc: pa.Array, text_hash: pa.Array) -> np.ndarray:
    """Bytes that sort as (doc_id descending, nulls last, text_hash)."""
    top = np.uint64(1 << 63)
    none = doc.is_null().to_numpy(zero_copy_only=False)
    d = ~(pc.fill_null(doc, 0).to_numpy(zero_copy_only=False).view(np.uint64) ^ top)
    h = text_hash.to_numpy(zero_copy_only=False).view(np.uint64) ^ top
    out = np.zeros((len(d), 17), np.uint8)
    out[:, 0] = none
    out[:, 1:9] = np.where(none, np.uint64(0), d).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 9:] = h.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").reshape(-1)


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a sorted partition."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _deal(heads: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text_hash, text) to (part, context, doc_id, text_hash, text): the part that each belongs to, and heads to the part before too."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = _order_keys(batch.column(0), batch.column(1))
        part = np.searchsorted(heads, keys, side="right") - 1
        head = np.flatnonzero(heads[part] == keys)
        names = ["part", "context", *batch.schema.names]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(part), np.int64)), *batch.columns], names=names)
        if len(head):
            again = batch.take(pa.array(head))
            yield pa.RecordBatch.from_arrays([pa.array((part[head] - 1) % len(heads)), pa.array(np.ones(len(head), np.int64)), *again.columns], names=names)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, and of the text whose last half is replaced from the next document.

    Documents follow each other by descending doc_id, the first follows the last; rows that repeat an id follow by the
    text's XXH64, then text, null ids come last, in that order too, so rows of one id are dealt over many tasks. Null texts
    are empty. Row for row; no rows give no rows; one row follows itself. Other columns are left out.

    Texts move once. A sort of ids and hashes alone gives the first row of each range; a range is a task of its own, found
    by binary search, and only the first row of each part goes, as well, to the part before.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash")]
    ids = rows.select("doc_id", "text_hash").repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = ids.mapInArrow(_heads, "doc_id long, text_hash long").toArrow().combine_chunks()  # a row a partition
    heads = np.unique(_order_keys(*(found.column(k).combine_chunks() for k in (0, 1)))) if found.num_rows else np.zeros(1, "S17")
    sent = rows.mapInArrow(functools.partial(_deal, heads), "part long, context long, doc_id long, text_hash long, text string").repartitionById(n, F.col("part").cast("int"))
    sent = sent.sortWithinPartitions("part", "context", *order, "text").select("part", "context", "doc_id", "text")
    return sent.mapInArrow(_pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
