"""Byte-level BPE over Arrow batches: ids, offsets and decoding.

``Encoder`` splits a text at the spaces between two characters that are no white space: with the pattern of these
vocabularies a token never spans such a place, so the chunks are encoded separately and remembered. A memo of
bounded size, cleared when full, then spares the tokenizer most of its work; ids do not depend on it.
"""

from __future__ import annotations

import base64
import codecs
import functools
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from gridloom.llm.common import slices, with_fields

_BESIDE = re.compile(r" \s|\s ")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Letters, then ASCII that is neither a letter nor an apostrophe: a run of letters is a token of the pattern and ends there.
_LETTERS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)(?:([\n!-&(-@\[-`{-~].*))?", re.DOTALL)


def byte_characters() -> dict[int, str]:
    """The byte table of byte-level BPE: printable bytes stand for themselves, the others for characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def tokenizer_of_ranks(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A tokenizer of the tokenizers library that merges the adjacent pair of least rank, as the ranks say.

    Every way to cut a token into two known tokens is a merge of that token's rank; a piece that is a token is taken whole.
    """
    shown = byte_characters()
    text = {t: "".join(shown[b] for b in t) for t in ranks}
    merges = [
        (text[t[:k]], text[t[k:]]) for t in sorted(ranks, key=ranks.__getitem__) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
    ]
    made = Tokenizer(models.BPE(vocab={text[t]: i for t, i in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return made


@functools.lru_cache(maxsize=4)
def ranked(path: str, pattern: str) -> tuple[Tokenizer, dict[bytes, int]]:
    ranks = read_ranks(path)
    return tokenizer_of_ranks(ranks, pattern), ranks


class Encoder:
    """Texts to ids, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer: Tokenizer, memo: int = 300_000):
        self.tokenizer, self.most = tokenizer, memo
        self.young: dict[str, bytes] = {}  # of chunks that follow a space, without it
        self.old: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}  # of what follows a run of letters, up to the next space
        # a special token that begins like a word could reach over the end of its letters
        self.apart = not any(_LETTERS.match(t.content.lstrip()) for t in tokenizer.get_added_tokens_decoder().values())
        newline = tokenizer.encode("\n", add_special_tokens=False).ids
        self.mark = newline[0] if len(newline) == 1 else None

    def _each(self, texts: list[str]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield array("I", e.ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of " " + word. A run of letters and what follows it are encoded, and remembered, apart."""
        ends, split = self.ends, []
        fresh: dict[str, None] = {}
        for w in words:
            m = _LETTERS.fullmatch(w) if self.apart else None
            if m is None:
                fresh[w] = None
                continue
            base, end = m.groups()
            if base not in self.young:
                got = self.old.get(base)
                if got is None:
                    fresh[base] = None
                else:
                    self.young[base] = got
            if end is not None:
                split.append((w, base, end))
        self._lines(list(fresh))
        more = list({end for _, _, end in split if end not in ends})
        ends.update(zip(more, self._each(more), strict=True))
        for w, base, end in split:
            self.young[w] = self.young[base] + ends[end]
        for end in more:
            if len(end) > 200:  # not worth its memory
                del ends[end]
        if len(ends) > self.most // 10:
            ends.clear()
        asked = set(words)
        for w in fresh:
            if len(w) > 200 and w not in asked:
                del self.young[w]

    def _lines(self, words: list[str]) -> None:
        """Ids of " " + word. Words without a line end are encoded as lines: a line end between them is one token of its own."""
        plain = [w for w in words if self.mark is not None and "\n" not in w and not _edged(w)]
        for i in range(0, len(plain), 512):
            part = plain[i : i + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + "\n ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(part) - 1:
                self.young.update(zip(part, self._each([" " + w for w in part]), strict=True))
                continue
            raw, a = ids.tobytes(), 0
            for w, z in zip(part, [*(cut * 4).tolist(), len(raw)], strict=True):
                self.young[w] = raw[a:z]
                a = z + 4
        rest = [w for w in words if w not in self.young]
        self.young.update(zip(rest, self._each([" " + w for w in rest]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        get, old = self.young.get, self.old.get
        heads, found, want, late = [], [], set(), []
        for t in texts:
            # What is remembered has no white space at its edges, so only chunks not found can show that this is no safe split
            head, *tail = t.split(" ")
            got = list(map(get, tail))
            miss = [i for i, g in enumerate(got) if g is None]
            if (head[-1:].isspace() or any(_edged(tail[i]) for i in miss)) and _BESIDE.search(t):
                head, *tail = _SAFE.split(t)
                got = list(map(get, tail))
                miss = [i for i, g in enumerate(got) if g is None]
            if miss:
                miss = [(i, tail[i]) for i in miss]
                want.update([w for _, w in miss])
                late.append((got, miss))
            heads.append(head)
            found.append(got)
        new = []
        for w in want:
            if (g := old(w)) is None:
                new.append(w)
            else:
                self.young[w] = g
        self._learn(new)
        for got, miss in late:
            for i, w in miss:
                got[i] = self.young[w]
        out = map(b"".join, found)
        for w in new:
            if len(w) > 200 or _edged(w):  # not worth its memory, or for the end of a text only
                del self.young[w]
        return [a + b for a, b in zip(self._each(heads), out, strict=True)]


def _edged(w: str) -> bool:
    """Empty, or with white space at an edge."""
    return not w or len(w.strip()) != len(w)


def byte_table(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for t, i in ranks.items():
        table[i] = t
    return table


def decode_bytes(ids: Iterable[int], table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


def decode_stream(parts: Iterable[Iterable[int]], table: list[bytes]) -> Iterator[str]:
    """Text of consecutive parts of ids; a character that is split between parts comes with the part that ends it."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    for ids in parts:
        yield reader.decode(decode_bytes(ids, table))
    if last := reader.decode(b"", True):
        yield last


def offsets(text: str, ids: Iterable[int], table: list[bytes]) -> np.ndarray:
    """(n, 2) code point offsets: from the character that holds a token's first byte to the end of the one that holds its last."""
    return spans(text, np.fromiter((len(table[i]) for i in ids), np.int64))


def spans(text: str, sizes: np.ndarray) -> np.ndarray:
    """The offsets of tokens of so many bytes each."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return np.zeros((0, 2), np.int64)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
    end = np.cumsum(sizes)
    return np.stack([char[end - sizes], char[end - 1] + 1], axis=1)


def each_batch(df: DataFrame, text: str, fields: dict[str, str], work: Callable[[list[str], list[bytes]], list[pa.Array]]) -> DataFrame:
    """All columns but ``text`` and those of ``fields``, and what work(texts, their bytes) returns for ``fields`` (name to type).

    Null texts count as empty. ``work`` gets one Arrow batch at a time and must be a module-level callable or partial.
    """
    made = list(fields)
    rest = [c for c in df.columns if c not in (text, *made)]
    slim = df.select(*rest, F.col(text).alias("__text"))
    schema = with_fields(slim.select(*rest).schema, fields)
    at = len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            body = pc.fill_null(batch.column(at), "")
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *work(body.to_pylist(), body)], names=[*rest, *made])

    return slim.mapInArrow(run, schema)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder_of_ranks(path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    key = (path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranked(path, pattern)[0])
    return _ENCODERS[key]


def encoder_of_file(path: str) -> Encoder:
    key = (path, "")
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Tokenizer.from_file(path))
    return _ENCODERS[key]


def _encode(path: str, pattern: str, places: bool, texts: list[str], _: pa.Array) -> list[pa.Array]:
    got = encoder_of_ranks(path, pattern).encode(texts)
    ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in got]
    out = [pa.array(ids, pa.list_(pa.int32()))]
    if places:
        table = _table(path, pattern)
        spans = [offsets(t, i.tolist(), table) for t, i in zip(texts, ids, strict=True)]
        out += [pa.array([s[:, k].astype(np.int32) for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
    return out


@functools.lru_cache(maxsize=4)
def _table(path: str, pattern: str) -> list[bytes]:
    return byte_table(ranked(path, pattern)[1])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", places: bool = False) -> DataFrame:
    """Adds ``ids`` (array<int>) and, with ``places``, ``starts`` and ``ends`` (code points); drops ``text``.

    Row for row. Null and empty texts have no ids. Text that spells a special token is ordinary text.
    """
    fields = {"ids": "array<int>"} | ({"starts": "array<int>", "ends": "array<int>"} if places else {})
    return each_batch(docs, text, fields, functools.partial(_encode, path, pattern, places))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds ``text``, drops ``ids`` (null: null). Bytes that are no UTF-8 become U+FFFD."""
    rest = [c for c in rows.columns if c not in (ids, "text")]
    slim = rows.select(*rest, F.col(ids).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path, pattern)
        for batch in batches:
            texts = [None if x is None else decode_bytes(x, table).decode("utf-8", "replace") for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*rest, "text"])

    return slim.mapInArrow(run, with_fields(slim.select(*rest).schema, {"text": "string"}))


def _digest(path: str, pattern: str, texts: list[str], _: pa.Array) -> list[pa.Array]:
    import hashlib

    table = _table(path, pattern)
    n, of_ids, of_bytes = [], [], []
    for ids in encoder_of_ranks(path, pattern).encode(texts):
        n.append(len(ids) // 4)
        of_ids.append(hashlib.sha256(ids).hexdigest())
        of_bytes.append(hashlib.sha256(decode_bytes(array("I", ids), table)).hexdigest())
    return [pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Row for row: n_tokens, ids_sha256 (of 32-bit little-endian ids) and decoded_sha256 (of the bytes decoded from the ids)."""
    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return each_batch(docs, text, fields, functools.partial(_digest, path, pattern))
