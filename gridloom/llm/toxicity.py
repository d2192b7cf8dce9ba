"""Toxicity by a weighted finite-state pattern grammar over clauses.

Terminals are classes of words, and quotation marks. Small lexicons of targets, negation, reported speech and threats are
fixed; insults are learned from labelled rows, as whole words and as stems. Six transducers, each a table of states and
arcs (input, output, weight), read a clause one after the other:

* insult   makes a learned word a match
* threat   makes a word of violence a match
* target   marks matches with a word that addresses somebody at most ``REACH`` words before or after
* negation marks matches with a negation at most ``REACH`` words before
* report   marks all matches of a clause that holds a verb of saying or two quotation marks, wherever these stand
* score    gives each form of a match its weight

What stands after a match decides about it too, so target and report guess, and drop the wrong guess when they know better:
of all paths one is accepted. ``compose`` makes one machine of all six, so a clause is read once, and whole. The weight of
its path is the sum over its matches, a text's score the logistic function of a bias and the sum over its clauses. The
weights are fitted by logistic regression on the same labelled rows. A word outside any matched clause adds nothing.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import checkpoint, slices, with_fields

# Fixed word lists of the grammar.
TARGETS = "you your yours yourself he him she her they them these those people everyone du dich dir ihr sie euch tu te toi vous il elle ils usted tú ti vosotros ellos él".split()
NEGATIONS = "not never no isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais ne aucun nunca jamás ni".split()
REPORTS = "said says say wrote writes quoted quote called claims claimed reported alleged sagte schrieb meinte dit écrit écrivait dijo escribió llamó".split()
THREATS = "kill hurt destroy burn beat punch stab shoot attack töten schlagen umbringen tuer frapper détruire matar golpear destruir".split()

REACH = 4
STEMS = (4, 5, 6)
#: Labels that are fitted to, at most, and the hash buckets by which they are taken.
SAMPLE, BUCKETS = 20_000, 4096
KINDS = ("insult", "threat")
FORMS = [f"{kind}{t}{n}{r}" for kind in KINDS for t in ("", "+target") for n in ("", "+negated") for r in ("", "+reported")]
#: Terminals: classes of words, and a quotation mark, which is no word.
WORDS = ("other", "target word", "negation word", "report word", "threat word", "insult word")
QUOTE = "quote"
_CLASSES = {w: k for k, words in zip(WORDS[1:5], (TARGETS, NEGATIONS, REPORTS, THREATS), strict=True) for w in words}
_TOKEN = regex.compile(r"[\p{L}\p{M}']+|[\"«»“”„]")
_CLAUSE = re.compile(r"[.!?;:\n]+|,\s+(?=(?:but|aber|mais|pero)\b)")


@dataclass(frozen=True)
class Model:
    """What is fitted: insult words and stems with their evidence, weights of forms, and the bias."""

    words: frozenset[str]
    stems: frozenset[str]
    weights: tuple[float, ...]
    bias: float


# ---- transducers


class Transducer:
    """Arcs {(state, input): [(next state, output, weight)]}; every arc reads one symbol and writes one.

    ``trim`` drops what no path from a start to a final state goes through, and numbers the states. The machines here
    are unambiguous: an input has one accepted path at most.
    """

    def __init__(self, starts: Iterable, finals: Iterable, arcs: dict[tuple, list[tuple]]):
        self.starts, self.finals, self.arcs = list(starts), set(finals), arcs

    def trim(self) -> Transducer:
        ahead: dict = {}
        back: dict = {}
        for (p, _), to in self.arcs.items():
            for q, *_ in to:
                ahead.setdefault(p, set()).add(q)
                back.setdefault(q, set()).add(p)

        def reach(some: Iterable, step: dict) -> set:
            seen, todo = set(some), list(some)
            while todo:
                for q in step.get(todo.pop(), ()):
                    if q not in seen:
                        seen.add(q)
                        todo.append(q)
            return seen

        live = reach(self.starts, ahead) & reach(self.finals, back)
        number = {p: k for k, p in enumerate(sorted(live, key=repr))}
        arcs = {(number[p], x): kept for (p, x), to in self.arcs.items() if p in live and (kept := [(number[q], y, w) for q, y, w in to if q in live])}
        return Transducer([number[p] for p in self.starts if p in live], {number[p] for p in self.finals if p in live}, arcs)

    def read(self, symbols: Iterable[str]) -> tuple[float, list[str]] | None:
        """Weight and output of the accepted path; None if there is none."""
        live: dict = {p: (0.0, None) for p in self.starts}
        for x in symbols:
            now = {}
            for p, (weight, out) in live.items():
                for q, y, w in self.arcs.get((p, x), ()):
                    now[q] = (weight + w, (out, y))
            live = now
        for p, (weight, out) in live.items():
            if p in self.finals:
                made = []
                while out is not None:
                    out, y = out
                    made.append(y)
                return weight, made[::-1]
        return None


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that does what b does to the output of a; weights add up."""
    by_state: dict = {}
    for (p, x), to in a.arcs.items():
        by_state.setdefault(p, []).append((x, to))
    starts = [(p, q) for p in a.starts for q in b.starts]
    arcs: dict = {}
    seen, todo = set(starts), list(starts)
    while todo:
        p, q = todo.pop()
        for x, to in by_state.get(p, ()):
            made = [((p2, q2), z, w1 + w2) for p2, y, w1 in to for q2, z, w2 in b.arcs.get((q, y), ())]
            if made:
                arcs[(p, q), x] = made
            for pair, *_ in made:
                if pair not in seen:
                    seen.add(pair)
                    todo.append(pair)
    return Transducer(starts, [(p, q) for p, q in seen if p in a.finals and q in b.finals], arcs).trim()


def _relabel(of: dict[str, str], rest: Iterable[str]) -> Transducer:
    """One state; some symbols become others."""
    return Transducer([0], [0], {(0, x): [(0, of.get(x, x), 0.0)] for x in [*rest, *of]})


def insult() -> Transducer:
    return _relabel({"insult word": "insult"}, [*WORDS, QUOTE])


def threat() -> Transducer:
    return _relabel({"threat word": "threat"}, ["insult", *WORDS, QUOTE])


def target(reach: int = REACH) -> Transducer:
    """States (distance that the next word has to the last target, words left in which one must come, words that must not be one)."""
    far = reach + 1
    states = list(itertools.product(range(1, far + 1), range(reach + 1), range(reach + 1)))
    arcs: dict = {}
    for since, must, ban in states:
        me, step = (since, must, ban), min(since + 1, far)
        arcs[me, QUOTE] = [(me, QUOTE, 0.0)]
        if not ban:
            arcs[me, "target word"] = [((1, 0, 0), "target word", 0.0)]
        if must == 1:
            continue  # this word had to be a target
        less, free = max(must - 1, 0), max(ban - 1, 0)
        for x in WORDS:
            if x != "target word":
                arcs[me, x] = [((step, less, free), x, 0.0)]
        for x in KINDS:
            if since <= reach:
                arcs[me, x] = [((step, less, free), x + "+target", 0.0)]
            else:
                arcs[me, x] = [((step, less or reach, free), x + "+target", 0.0), ((step, less, reach), x, 0.0)]
    return Transducer([(far, 0, 0)], [p for p in states if not p[1]], arcs).trim()


def negation(reach: int = REACH) -> Transducer:
    """State: the distance that the next word has to the last negation."""
    far = reach + 1
    arcs: dict = {}
    for since in range(1, far + 1):
        step = min(since + 1, far)
        arcs[since, QUOTE] = [(since, QUOTE, 0.0)]
        for x in WORDS:
            arcs[since, x] = [(1 if x == "negation word" else step, x, 0.0)]
        for x in (k + t for k in KINDS for t in ("", "+target")):
            arcs[since, x] = [(step, x + "+negated" if since <= reach else x, 0.0)]
    return Transducer([far], range(1, far + 1), arcs)


def report() -> Transducer:
    """Two guesses, plain and reported, and whether one quotation mark was seen; ``sure`` after a verb of saying or a second mark."""
    matches = [k + t + n for k in KINDS for t in ("", "+target") for n in ("", "+negated")]
    arcs: dict = {}
    for guess, seen in itertools.product(("plain", "reported"), (0, 1)):
        me = (guess, seen)
        for x in WORDS:
            arcs[me, x] = [(me, x, 0.0)]
        for x in matches:
            arcs[me, x] = [(me, x if guess == "plain" else x + "+reported", 0.0)]
        known = [("sure", QUOTE, 0.0)] if guess == "reported" else []
        arcs[me, QUOTE] = known if seen else [((guess, 1), QUOTE, 0.0)]
        arcs[me, "report word"] = [(to, "report word", w) for to, _, w in ([("sure", "", 0.0)] if guess == "reported" else [])]
    for x in [*WORDS, QUOTE]:
        arcs["sure", x] = [("sure", x, 0.0)]
    for x in matches:
        arcs["sure", x] = [("sure", x + "+reported", 0.0)]
    return Transducer([("plain", 0), ("reported", 0)], [("plain", 0), ("plain", 1), "sure"], arcs).trim()


def weigh(weights: tuple[float, ...]) -> Transducer:
    arcs = {(0, x): [(0, x, 0.0)] for x in [*WORDS, QUOTE]}
    return Transducer([0], [0], arcs | {(0, x): [(0, x, w)] for x, w in zip(FORMS, weights, strict=True)})


@functools.lru_cache(maxsize=8)
def grammar(weights: tuple[float, ...] = (0.0,) * len(FORMS)) -> Transducer:
    """All six as one."""
    return functools.reduce(compose, [insult(), threat(), target(), negation(), report(), weigh(weights)])


class Reader:
    """Reads texts with a fitted lexicon: each clause that holds a hit, once and whole."""

    def __init__(self, words: frozenset[str], stems: frozenset[str], weights: tuple[float, ...] = (0.0,) * len(FORMS)):
        self.words, self.stems, self.machine = words, stems, grammar(weights)
        self.find = ahocorasick.Automaton()
        for w in {*words, *stems, *THREATS}:
            self.find.add_word(w, len(w))
        self.find.make_automaton()

    def terminal(self, token: str) -> str:
        if token in '"«»“”„':
            return QUOTE
        if token in self.words or any(token[:n] in self.stems for n in STEMS):
            return "insult word"
        return _CLASSES.get(token, "other")

    def clauses(self, text: str) -> Iterator[str]:
        """The clauses that hold a learned word, a stem or a threat at the start of a word."""
        low = text.lower()
        hits = sorted({end - size + 1 for end, size in self.find.iter(low) if end == size - 1 or not (low[end - size].isalpha() or low[end - size] == "'")})
        if not hits:
            return
        start, k = 0, 0
        for end, after in itertools.chain((m.span() for m in _CLAUSE.finditer(low)), [(len(low), len(low))]):
            if hits[k] < end:
                yield low[start:end]
            while hits[k] < after:
                k += 1
                if k == len(hits):
                    return
            start = after

    def read(self, text: str) -> tuple[float, np.ndarray]:
        """The sum of the paths' weights, and how often each form occurs."""
        total, counts = 0.0, np.zeros(len(FORMS))
        for clause in self.clauses(text):
            weight, out = self.machine.read([self.terminal(t) for t in _TOKEN.findall(clause)])
            total += weight
            for y in out:
                if (k := _NUMBER.get(y)) is not None:
                    counts[k] += 1
        return total, counts


_NUMBER = {form: k for k, form in enumerate(FORMS)}


def _map_forms(docs: DataFrame, words: frozenset[str], stems: frozenset[str], text: str) -> DataFrame:
    rest = [c for c in docs.columns if c not in (text, "forms")]
    slim = docs.select(*rest, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(words, stems)
        for batch in slices(batches, len(rest)):
            got = [reader.read(x or "")[1] for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.list_(pa.float64()))], names=[*rest, "forms"])

    return slim.mapInArrow(run, with_fields(slim.select(*rest).schema, {"forms": "array<double>"}))


def lexicon(rows: DataFrame, least: int = 4) -> tuple[frozenset[str], frozenset[str]]:
    """Words and stems of toxic rows (text, toxic) that clean rows hardly have; counts are of rows, over all rows given.

    A term needs ``least`` toxic rows and a smoothed log-odds ratio over 3. All such terms are taken: the rows are the
    labelled sample, which ``labelled_rows`` bounds, and so are its terms.
    """
    low = F.lower(F.coalesce("text", F.lit("")))
    terms = F.array_distinct(F.regexp_extract_all(low, F.lit(r"([\p{L}\p{M}']+)"), F.lit(1)))
    x = rows.select("toxic", F.explode(terms).alias("w"))
    kinds = [F.struct(F.lit(0).alias("n"), F.col("w").alias("t"))] + [F.struct(F.lit(n).alias("n"), F.substring("w", 1, n).alias("t")) for n in STEMS]
    x = x.select("toxic", F.explode(F.array(*kinds)).alias("k")).where("length(k.t) >= k.n")
    total = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    toxic, clean = int(total[0]), int(total[1] - total[0])
    if not toxic:
        return frozenset(), frozenset()
    pos, neg = F.sum("toxic"), F.sum(1 - F.col("toxic"))
    odds = F.log((pos + 0.5) / (toxic + 1)) - F.log((neg + 0.5) / (clean + 1))
    found = x.groupBy("k").agg(pos.alias("pos"), odds.alias("odds")).where(f"pos >= {least} and odds > 3").select("k.n", "k.t", "pos").collect()
    words = {r["t"]: r["pos"] for r in found if r["n"] == 0}
    most: dict[str, int] = {}  # rows of the most frequent word that begins so
    for w, n in words.items():
        for k in STEMS:
            most[w[:k]] = max(n, most.get(w[:k], 0))
    stems: set[str] = set()
    for r in sorted((r for r in found if r["n"]), key=lambda r: r["n"]):
        # a stem must stand for more than one word, and a longer stem adds nothing to a shorter one
        if r["pos"] > 1.5 * most.get(r["t"], 0) and not any(r["t"][:n] in stems for n in STEMS if n < r["n"]):
            stems.add(r["t"])
    return frozenset(words), frozenset(stems)


def fit(labelled: DataFrame) -> Model:
    """A model of rows (text, toxic 0 or 1). Without rows, or without toxic ones, nothing is an insult and all scores are low."""
    rows = labelled.where("toxic is not null").select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    words, stems = lexicon(rows)
    got = _map_forms(rows.select("toxic", "text"), words, stems, "text").groupBy("toxic", "forms").count().collect()
    weights, bias = np.zeros(len(FORMS)), -3.0
    if got:
        x = np.array([r["forms"] for r in got], float)
        y = np.array([r["toxic"] for r in got], float)
        often = np.array([r["count"] for r in got], float)
        weights, bias = _weighted(x, y, often)
    return Model(words, stems, tuple(float(max(0.0, w)) for w in weights), bias)


def _weighted(x: np.ndarray, y: np.ndarray, often: np.ndarray, rounds: int = 60, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (often * (p - y)) + ridge * w
        hess = (z * (often * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns but ``text``, and ``score`` (0 to 1), row for row; null and empty texts get the score of no match.

    A column ``score`` that the rows have is replaced.
    """
    rest = [c for c in docs.columns if c not in (text, "score")]
    slim = docs.select(*rest, F.col(text).alias("__text"))
    run = functools.partial(_score, model, rest)
    return slim.mapInArrow(run, with_fields(slim.select(*rest).schema, {"score": "double"}))


def _score(model: Model, rest: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader(model.words, model.stems, model.weights)
    for batch in slices(batches, len(rest)):
        got = [1 / (1 + math.exp(-max(-30.0, min(30.0, reader.read(x or "")[0] + model.bias)))) for x in batch.column(len(rest)).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.float64())], names=[*rest, "score"])


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out fold, of ``sample`` labels at most.

    Labels are taken in order of a hash of doc_id, by whole buckets of it, so the sample needs no sort; where the first
    buckets hold too many, they are divided again, so at least half of ``sample`` is taken however many labels there
    are. The ids taken are sent to the documents instead of the texts to them.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out("doc_id")).withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id"), 16))
    taken, end, width = 0, 0, 1 << 48
    while taken < sample and width > 1:  # a step for each factor of BUCKETS by which the labels are too many
        width //= BUCKETS
        bucket = ((F.col("place") - end) / width).cast("long").alias("bucket")
        inside = known.where((F.col("place") >= end) & (F.col("place") < end + width * BUCKETS))
        sizes = {r["bucket"]: r["count"] for r in inside.groupBy(bucket).count().collect()}  # BUCKETS rows at most
        for k in range(BUCKETS):
            if taken + sizes.get(k, 0) > sample:
                break
            taken += sizes.get(k, 0)
            end += width
        else:
            break  # all labels fit
        if 2 * taken >= sample:
            break
    known = known.where(F.col("place") < end).select(F.col("doc_id").alias("__id"), "toxic")
    return docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select("text", "toxic")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold by a model of the labelled ones."""
    model = fit(checkpoint(labelled_rows(docs, labels)))
    names = docs.columns
    mark = "score" if "score" not in names else "__score"
    kept = docs.withColumn("__body", F.col("text"))
    if mark == "__score":
        kept = kept.withColumnRenamed("score", "__own")
    kept = score(kept, model, "__body").where(F.col("score") < threshold)
    return kept.select(*[F.col("__own" if c == "score" else c).alias(c) for c in names])
