"""Removal of text that occurs before: hashed lines and paragraphs, the earliest occurrence stays.

Units are whole lines that have a word, however short, and within lines the sentences; a digest is of a unit's words, A-Z
lowered and white space made one space. Digests are grouped over all documents, and each occurrence but the least in rank
(doc_id, place) is a later one. Later lines go. Of later sentences whole paragraphs go: runs of neighbours that are all
later and hold ``least_words`` words together, so a passage is found wherever it stands, inside a line too, and a short
sentence alone stays. The first occurrence of a digest is in no later line and no such paragraph, so it always stays.

Sentences end at line ends and after . ! ? and the like before white space; one of more than ``longest`` words is
cut after words whose CRC says so and after a word that repeats, which does not depend on what stands around them.

A task drops, before anything is shuffled, the units that it has itself seen earlier in rank: a digest that a
third of all rows hold reaches the shuffle once a task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import slices, with_fields

LEAST_WORDS, LONGEST = 20, 24
_ENDS = re.compile(rb"\n+|(?:[.!?;]|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f|\xe2\x80\xa6)[\"')\]]*(?=[ \t\r\n])")


def sentences(body: bytes, longest: int = LONGEST) -> list[tuple[int, int, list[bytes]]]:
    """(start, end, words) in bytes, without white space at the edges; those without a word are left out."""
    out, at = [], 0
    for end in [*(m.end() for m in _ENDS.finditer(body)), len(body)]:
        part = body[at:end]
        words = part.lower().split()
        if words:
            lead = len(part) - len(part.lstrip())
            a, b = at + lead, at + len(part.rstrip())
            if len(words) <= longest:
                out.append((a, b, words))
            else:
                out += _cut(body, a, b)
        at = end
    return out


def _cut(body: bytes, a: int, b: int) -> Iterator[tuple[int, int, list[bytes]]]:
    start, words, last = a, [], None
    for m in re.finditer(rb"\S+", body[a:b]):
        word = m[0].lower()
        if words and word != last and (zlib.crc32(last) % 8 == 0 or words[-2:-1] == [last]):
            yield start, end, words
            words = []
        if not words:
            start = a + m.start()
        words.append(word)
        end, last = a + m.end(), word
    if words:
        yield start, b, words


def lines(body: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, words with one space between) of every line that has a word, without white space at the edges."""
    at = 0
    for line in body.split(b"\n"):
        if words := line.lower().split():
            yield at + len(line) - len(line.lstrip()), at + len(line.rstrip()), b" ".join(words)
        at += len(line) + 1


def units(body: bytes) -> list[tuple[int, int, bool, bytes]]:
    """(start, end, whether a line, digest) of the lines and the sentences of a text, in bytes.

    A sentence that is a whole line is no unit of its own; a line whose words stand before as a sentence is a later one.
    """
    digest = xxhash.xxh3_128_digest
    found = [(a, b, True, digest(words)) for a, b, words in lines(body)]
    whole = {(a, b) for a, b, *_ in found}
    return found + [(a, b, False, digest(b" ".join(words))) for a, b, words in sentences(body) if (a, b) not in whole]


#: A row's ``size`` is bytes and, in this bit, whether the unit is a line; it is negative if a task knows the unit to be a later one.
_LINE = 31
_BYTES = (1 << _LINE) - 1


def _candidates(memo: int):
    """Rows (h1, h2, doc_id, place, size): the least of each digest in the task, and all others, marked as later ones under digests of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, tuple[bool, int, int, int]] = {}

        def rows(digests: list[bytes], found: list[tuple]) -> pa.RecordBatch:
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            made = [pa.array(h[:, 0]), pa.array(h[:, 1]), *(pa.array([x[k] for x in found], pa.int64()) for k in (1, 2, 3))]
            return pa.RecordBatch.from_arrays(made, names=["h1", "h2", "doc_id", "place", "size"])

        for batch in slices(batches, 1):
            later = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                body = body or b""
                crc, none, rank = zlib.crc32(body) << 31, doc is None, doc or 0
                for a, b, line, h in units(body):
                    mine = (none, rank, crc + a, line << _LINE | b - a)
                    other = first.setdefault(h, mine)
                    if other is mine:
                        continue
                    if mine < other:
                        first[h], mine, other = mine, other, mine
                    if mine[:3] != other[:3]:
                        later.append(mine)
            if later:
                later = [(x[0], None if x[0] else x[1], x[2], -x[3]) for x in later]
                yield rows([xxhash.xxh3_128_digest(b"%r" % (x,)) for x in later], later)
            if len(first) > memo:
                yield rows(list(first), [(x[0], None if x[0] else x[1], *x[2:]) for x in first.values()])
                first = {}
        if first:
            yield rows(list(first), [(x[0], None if x[0] else x[1], *x[2:]) for x in first.values()])

    return run


def later_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", memo: int = 400_000) -> DataFrame:
    """(doc_id, text_crc, start, end, line) in bytes of every unit that a lower rank holds too. Null ids rank last."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = slim.mapInArrow(_candidates(memo), "h1 long, h2 long, doc_id long, place long, size long")
    rank = F.rank().over(Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "place"))
    later = found.withColumn("rank", rank).where("size < 0 or rank > 1")
    start, size = F.col("place").bitwiseAND(F.lit(_BYTES)), F.abs("size")
    line = F.shiftright(size, _LINE) == 1
    return later.select("doc_id", F.shiftright("place", 31).alias("text_crc"), start.alias("start"), (start + size.bitwiseAND(F.lit(_BYTES))).alias("end"), line.alias("line"))


def removable(body: bytes, later: list[tuple[int, int, bool]], least_words: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Spans of the later lines, and of the runs of neighbouring later units that hold ``least_words`` words together."""
    runs: list[list[int]] = []
    for a, b, _ in sorted(later):
        if runs and (a <= runs[-1][1] or not body[runs[-1][1] : a].strip()):
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    return [(a, b) for a, b, line in later if line] + [(a, b) for a, b in runs if len(body[a:b].split()) >= least_words]


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns, row for row, with ``text`` less its later units, and ``removed``: array of (start, end) in the original.

    Offsets are code points. Null texts stay null, with nothing removed; so do texts without a unit. Rows that repeat a
    doc_id with the same text count as one document: they do not make each other later, but repeats within the text do. A repeated doc_id with other
    text is another document, ranked by the CRC of its text. Null ids rank last. A removed part takes the white
    space after it along.
    """
    gone = later_units(docs, doc_id, text).groupBy("doc_id", "text_crc").agg(F.collect_set(F.struct("start", "end", "line")).alias("__gone"))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_crc").alias("__crc"), "__gone")
    keep = [c for c in docs.columns if c != "removed"]
    marked = docs.select(*keep).withColumn("__key", F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    both = marked.join(gone, F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__crc")), "left")
    at, names = keep.index(text), [*keep, "removed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts, removed = [], []
            for body, later in zip(batch.column(at).to_pylist(), batch.column(len(keep)).to_pylist(), strict=True):
                if later:
                    body, cut = without(body, removable((body or "").encode(), [(s["start"], s["end"], s["line"]) for s in later], least_words))
                else:
                    cut = []
                texts.append(body)
                removed.append([{"start": a, "end": b} for a, b in cut])
            columns = list(batch.columns[: len(keep)])
            columns[at] = pa.array(texts, pa.string())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, kind)], names=names)

    schema = with_fields(docs.select(*keep).schema, {"removed": "array<struct<start:long,end:long>>"})
    return both.select(*keep, "__gone").mapInArrow(run, schema)


def without(text: str | None, spans: list[tuple[int, int]]) -> tuple[str | None, list[tuple[int, int]]]:
    """The text without the union of byte spans, and the spans in code points."""
    if not text or not spans:
        return text, []
    body, out, cut, at = text.encode(), [], [], 0
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        while b < len(body) and body[b : b + 1].isspace():
            b += 1
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    chars = 0
    for a, b in merged:
        part, gone = body[at:a].decode(), body[a:b].decode()
        out.append(part)
        chars += len(part)
        cut.append((chars, chars + len(gone)))
        chars += len(gone)
        at = b
    out.append(body[at:].decode())
    return "".join(out), cut
