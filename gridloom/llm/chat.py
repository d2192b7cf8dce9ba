"""Chat formatting with offset-aligned loss masks.

A turn is written as ``<|role|>role<|text|>text<|end|>`` and a line end. The three marks are special tokens, with the ids
behind the vocabulary's, so the edges of a text are edges of tokens whatever the text begins or ends with. In roles and
texts a backslash goes before a backslash and between ``<`` and ``|``, so no text can spell a mark, and reading back is
exact. A conversation is rendered whole and encoded once with offsets; the sorted spans of the assistant's texts meet the
sorted token spans by binary search.

A conversation that is too long for a task's memory is written in parts of whole turns. A part begins with a mark, so the
ids of the parts are those of the whole.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken

from gridloom.llm import bpe
from gridloom.llm.common import slices

ROLE, TEXT, END = MARKS = ("<|role|>", "<|text|>", "<|end|>")
_ESCAPED = re.compile(r"\\|<(?=\|)")
_BODY = r"((?:[^\\<]++|\\.|<(?!\|))*+)"
_TURN = re.compile(re.escape(ROLE) + _BODY + re.escape(TEXT) + _BODY + re.escape(END) + "\n", re.S)
_BACK = re.compile(r"\\(.)", re.S)
FIELDS = "conv_id long, part int, last boolean, formatted string, ids array<int>, loss_mask array<boolean>, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text) if "\\" in text else text


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{ROLE}{escape(role)}{TEXT}{escape(text)}{END}\n" for role, text in turns)


def read_back(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns; start and end of the text in the formatted string."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        yield unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)
    if at != len(formatted):
        raise ValueError("not a formatted conversation")


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens meet a span; all sorted."""
    on = np.zeros(len(starts), bool)
    for a, b in spans:
        if a < b:
            on[int(np.searchsorted(ends, a, "right")) : int(np.searchsorted(starts, b, "left"))] = True
    return on


def covered(on: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of what runs of masked tokens cover."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], on, [False]]).astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        yield int(starts[a]), int(ends[b - 1])


@functools.lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> tuple[bpe.Encoder, np.ndarray]:
    """An encoder that knows the marks, and the number of bytes of each id."""
    ranks = bpe.read_ranks(path)
    made = bpe.tokenizer_of_ranks(ranks, pattern)
    made.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in MARKS])
    table = bpe.byte_table(ranks | {m.encode(): made.token_to_id(m) for m in MARKS})
    return bpe.Encoder(made), np.array([len(b) for b in table], np.int64)


class _Open:
    """A conversation in progress."""

    def __init__(self, conv: int | None):
        self.conv, self.part, self.n, self.loss, self.chars = conv, 0, 0, 0, 0
        self.turns: list[tuple[str, str]] = []
        self.size = 0
        self.sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str) -> None:
        self.turns.append((role, text))
        self.size += len(text) + len(role)

    def write(self, encoder: bpe.Encoder, sizes: np.ndarray, assistant: str, last: bool) -> dict:
        formatted = render(self.turns)
        ids = np.frombuffer(encoder.encode([formatted])[0], "<u4").astype(np.int32)
        places = bpe.spans(formatted, sizes[ids])
        spans = []
        for role, text, a, b in read_back(formatted):
            self.n += 1
            self.sha.update(f"{role}\n{text}\n".encode())
            if role == assistant:
                spans.append((a, b))
        on = mask(spans, places[:, 0], places[:, 1])
        for a, b in covered(on, places[:, 0], places[:, 1]):
            text = unescape(formatted[a:b])
            self.loss += len(text)
            self.loss_sha.update(text.encode())
        self.chars += len(formatted)
        row = {"conv_id": self.conv, "part": self.part, "last": last, "formatted": formatted, "ids": ids, "loss_mask": on}
        done = {"n_turns": self.n, "turns_sha256": self.sha.hexdigest(), "loss_chars": self.loss, "loss_sha256": self.loss_sha.hexdigest(), "formatted_chars": self.chars}
        self.part, self.turns, self.size = self.part + 1, [], 0
        return row | (done if last else dict.fromkeys(done))


_KINDS = [
    ("conv_id", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())),
    ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
]


def _format(path: str, pattern: str, assistant: str, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder, sizes = tokenizer(path, pattern)
    write = functools.partial(_Open.write, encoder=encoder, sizes=sizes, assistant=assistant)
    rows: list[dict] = []
    size, now = 0, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in _KINDS], names=[n for n, _ in _KINDS])

    for batch in slices(batches, 2):
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    rows.append(write(now, last=True))
                    size += len(rows[-1]["formatted"])
                now = _Open(conv)
            now.add(role or "", text or "")
            if now.size > most:
                rows.append(write(now, last=False))
                size += len(rows[-1]["formatted"])
            if size > most:
                yield out()
                rows, size = [], 0
    if now is not None:
        rows.append(write(now, last=True))
    if rows:
        yield out()


def format_chat(turns: DataFrame, path: str, pattern: str, assistant: str = "assistant", most: int = 1_000_000) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) to formatted conversations with ids and loss masks; see FIELDS.

    Turns follow by turn, then role and text, nulls first; repeated rows are repeated turns. Null roles and texts are
    empty; rows of null conv_id are one conversation. A conversation of more than ``most`` characters comes in parts of whole
    turns, numbered from 0; the last has ``last`` and the totals of the whole, the others null totals. The digest of the loss is
    read from what the masked tokens cover. Turns of no table give no rows; further columns are left out.
    """
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").repartition(n, "conv_id")
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(functools.partial(_format, path, pattern, assistant, most), FIELDS)
