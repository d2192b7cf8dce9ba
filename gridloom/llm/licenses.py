"""License scans: phrases at word places, and an exact set-similarity join of text blocks with license templates.

A block is a line. It matches a template if it holds a share ``threshold`` of the template's distinct words. The words
of all templates are put in one order, rarest in the whole corpus first, counted over all blocks. A matching block has
one of the first ``size - needed + 1`` words of the template in that order (prefix filter), at least ``needed`` distinct
words (length filter), and enough words left behind the first shared one on either side (positional filter); what
passes is verified. So every match is found. The templates are a fixed list; only they go to every task.

A notice may be wrapped, so a template is looked for across lines as well: a passage is a run of words that goes on
over a line end, of no more words than the template has divided by ``threshold``, with a share ``threshold`` of its
distinct words, none of its lines a match by itself. Only documents that hold such a share at all are read for it.
"""

from __future__ import annotations

import functools
import math
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices, with_fields

# Fixed phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Fixed texts: customary notices of public licenses.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    # Creative Commons by elements: CC BY-NC-SA has by, nc and sa. With four words or fewer all of them must be there.
    "cc-by-short": "Licensed under CC BY",
    "cc-nc-short": "Licensed CC BY-NC",
    "cc-sa-short": "Licensed CC BY-SA",
    "cc-nd-short": "Licensed CC BY-ND",
    "cc-by-tag": "License: CC BY",
    "cc-nc-tag": "License: CC BY-NC",
    "cc-sa-tag": "License: CC BY-SA",
    "cc-nd-tag": "License: CC BY-ND",
    "cc-nc-name": "Creative Commons Attribution-NonCommercial",
    "cc-sa-name": "Creative Commons Attribution-ShareAlike",
    "cc-nd-name": "Creative Commons Attribution-NoDerivatives",
    "cc-zero": "CC0 1.0 Universal",
}
THRESHOLD = 0.8

#: Bytes that are no part of a word become spaces, A-Z become a-z; a line end stays one in LINES.
WORDS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
LINES = WORDS[:10] + b"\n" + WORDS[11:]


def words(body: bytes) -> list[bytes]:
    return body.translate(WORDS).split()


class Templates:
    """The index of the templates: by prefix word, in the corpus's order."""

    def __init__(self, templates: dict[str, str], threshold: float, frequency: dict[bytes, int]):
        self.sets = {label: frozenset(words(text.encode())) for label, text in templates.items()}
        known = sorted(frozenset().union(*self.sets.values()), key=lambda w: (frequency.get(w, 0), w))
        self.order = {w: k for k, w in enumerate(known)}
        self.vocabulary = frozenset(known)
        self.needed = {label: max(1, math.ceil(threshold * len(s) - 1e-9)) for label, s in self.sets.items()}
        self.prefix: dict[bytes, list[tuple[str, int]]] = {}
        for label, s in self.sets.items():
            ordered = sorted(s, key=self.order.__getitem__)
            for k, w in enumerate(ordered[: len(s) - self.needed[label] + 1]):
                self.prefix.setdefault(w, []).append((label, k))
        self.least = min(self.needed.values(), default=1)
        self.reach = {label: math.ceil(len(words(text.encode())) / threshold - 1e-9) for label, text in templates.items()}

    def matches(self, block: frozenset[bytes] | set[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of the templates that a block of distinct words meets."""
        shared = block & self.vocabulary
        if len(shared) < self.least:
            return []
        ordered = sorted(shared, key=self.order.__getitem__)
        seen, out = set(), []
        for j, w in enumerate(ordered):
            for label, i in self.prefix.get(w, ()):
                if label in seen:
                    continue
                seen.add(label)  # w is the first shared word in the order
                needed, size = self.needed[label], len(self.sets[label])
                if len(block) < needed or min(size - i, len(ordered) - j) < needed:
                    continue
                if (n := len(self.sets[label] & shared)) >= needed:
                    out.append((label, n / size))
        return out


    def passages(self, lines: list[list[bytes]], met: set[tuple[int, str]]) -> list[tuple[int, int, str, float]]:
        """(first line, last line, label, containment) of the templates that stand across lines, the best of those that overlap."""
        out = []
        for label, _ in self.matches(frozenset().union(*lines)):
            wanted, needed, reach = self.sets[label], self.needed[label], self.reach[label]
            hits: deque[tuple[int, int, bytes]] = deque()  # (place, line, word) in reach of the last
            n: Counter[bytes] = Counter()
            best, at = None, 0
            for k, line in enumerate(lines):
                if (k, label) in met:  # found already, and no part of a passage
                    hits.clear()
                    n.clear()
                for place, w in enumerate(line if (k, label) not in met else (), at):
                    if w not in wanted:
                        continue
                    hits.append((place, k, w))
                    n[w] += 1
                    while place - hits[0][0] >= reach or n[hits[0][2]] > 1:
                        first = hits.popleft()[2]
                        n[first] -= 1
                        if not n[first]:
                            del n[first]
                    if best and hits[0][0] > best[0]:
                        out.append(best[1:])
                        best = None
                    if len(n) >= needed and (best is None or len(n) / len(wanted) > best[4]):
                        best = (place, hits[0][1], k, label, len(n) / len(wanted))
                at += len(line)
            if best:
                out.append(best[1:])
        return sorted(out)


def frequencies(docs: DataFrame, templates: dict[str, str], text: str = "text") -> dict[bytes, int]:
    """In how many blocks of all documents each template word stands; as many numbers as the templates have words."""
    vocabulary = frozenset(w for t in templates.values() for w in words(t.encode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[bytes] = Counter()
        for batch in slices(batches, 0):
            for body in batch.column(0).cast(pa.binary()).to_pylist():
                for line in (body or b"").translate(LINES).split(b"\n"):
                    n.update(vocabulary.intersection(line.split()))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in n]), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"].encode(): r["n"] for r in rows}


def _scan(index: Templates, phrases: dict[str, str], rest: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wanted = [(f" {p} ".encode(), label) for p, label in phrases.items()]
    for batch in slices(batches, len(rest)):
        n_words, places, base, labels, score, blocks, passages = [], [], [], [], [], [], []
        for body in batch.column(len(rest)).cast(pa.binary()).to_pylist():
            mapped = (body or b"").translate(LINES)
            own = mapped.split()
            joined = b" %b " % b" ".join(own)
            starts, found, best = [], set(), 0.0
            for p, label in wanted:
                at, before, n = joined.find(p), 0, 0
                while at >= 0:
                    n += joined.count(b" ", before, at + 1)  # spaces up to here; each stretch is counted once
                    before = at + 1
                    starts.append(n - 1)
                    found.add(label)
                    at = joined.find(p, before)
            lines = [line.split() for line in mapped.split(b"\n")]
            met = [(k, label, share) for k, line in enumerate(lines) for label, share in index.matches(set(line))]
            across = index.passages(lines, {(k, label) for k, label, _ in met})
            best = max([share for *_, share in [*met, *across]], default=0.0)
            n_words.append(len(own))
            places.append(sorted(starts))
            base.append(",".join(sorted(found)))
            labels.append(",".join(sorted(found | {label for *_, label, _ in [*met, *across]})))
            score.append(1.0 if starts else best)
            blocks.append([{"line": k, "label": label, "containment": share} for k, label, share in met])
            passages.append([{"first_line": a, "last_line": b, "label": label, "containment": share} for a, b, label, share in across])
        kind = pa.list_(pa.struct([("line", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))
        wide = pa.list_(pa.struct([("first_line", pa.int64()), ("last_line", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))
        made = [pa.array(n_words, pa.int64()), pa.array(places, pa.list_(pa.int64())), pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()), pa.array(blocks, kind), pa.array(passages, wide)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*rest, *FIELDS])


FIELDS = {"n_words": "long", "places": "array<long>", "base_labels": "string", "labels": "string", "score": "double", "blocks": "array<struct<line:long,label:string,containment:double>>", "passages": "array<struct<first_line:long,last_line:long,label:string,containment:double>>"}


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """All columns but ``text``, and n_words, places (of phrases, in words), base_labels, labels, score, blocks and passages.

    score is 1 where a phrase stands, else the best containment of a matching block or passage, else 0. Null and empty texts have
    no words and no labels. Row for row, repeated rows too; columns of the new names are replaced.
    """
    templates = TEMPLATES if templates is None else templates
    index = Templates(templates, threshold, frequencies(docs, templates, text))
    rest = [c for c in docs.columns if c not in (text, *FIELDS)]
    slim = docs.select(*rest, F.col(text).alias("__text"))
    run = functools.partial(_scan, index, PHRASES if phrases is None else phrases, rest)
    return slim.mapInArrow(run, with_fields(slim.select(*rest).schema, FIELDS))
