"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Everything on the way is a DataFrame function. The two bigram models are fitted on the driver from a
small labelled sample that a rule generates (``labelled_sample``); what remains of them is one table of
log-likelihood ratios, a literal of the plan.

Spans are (start, kind, end) in code points, end exclusive. Spark gives the matches of a pattern and the
pieces between them; running sums of their lengths give the places, in time linear in the matches.
"""

from __future__ import annotations

import base64
import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import prefix_sums, whole_text


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
ASSIGN = "(" + "|".join(map(_either_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"  # as AKIA[A-Z0-9]+ of 16 characters or more
HEX = "[0-9a-f]{32,}"  # as [0-9a-f]+ of 32 characters or more
TOKEN = "[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "random"]

#: Bigram table: characters '+' to 'z' by code, 80 of them: all that TOKEN admits.
LOW, WIDTH = ord("+"), ord("z") - ord("+") + 1
#: Least sum of log-likelihood ratios (nats), and least mean for a bigram.
LEAST_SUM, LEAST_MEAN = 8.0, 0.4
SCALE = 1000  # ratios are kept as thousandths, so that sums do not depend on their order

#: Parts of ordinary identifiers and words, from which the labelled sample is composed.
PARTS = """account action address after agent and array async attribute backup batch before block body buffer build
by cache call cancel channel child class client close cluster code column command commit component config connect
container content context control copy count create current data database date default delete depth description
directory document domain download driver edit element empty enable end entry error event example expected export
factory field file filter final first folder for format from function get global graph group handler has header
height helper http https id image import in index info init input instance integer interface internal is item job
key label language last layer length level library license limit line link list load local lock log logger main
manager map match max memory message method min mode model module name network next node not null number object of
offset on open operation option order output owner package page parameter parent parse partition password path
pattern pending permission person plan point policy port prefix previous process profile project property provider
query queue random range read record region register release remove request reset resource response result return
role root route row rule run schema scope search section select send sequence server service session set setting
shard size sort source spark split start state status step stop store stream string struct style success suffix
sync system table target task template test text thread time to token total transaction transfer transform tree
type undefined union unique unit update upload url user util valid value version view visible window with worker
write year zone ing tion ment ness able ence ance heit keit ung lich schaft mente ción eur elle ique aire""".split()


def labelled_sample(n: int = 3000) -> list[tuple[str, int]]:
    """(string, 1 for random, 0 for ordinary): n of each, the same at each call."""
    rows: list[tuple[str, int]] = []
    for i in range(n):
        d = hashlib.sha512(b"%d" % i).digest()
        long = 20 + d[0] % 30
        form = d[1] % 4
        if form == 0:
            s = base64.b64encode(d).decode().replace("=", "")
        elif form == 1:
            s = base64.urlsafe_b64encode(d).decode().replace("=", "")
        elif form == 2:
            s = d.hex()
        else:
            s = base64.b32encode(d).decode().replace("=", "")
        rows.append((s[4 : 4 + long], 1))
        parts = [p for p in (PARTS[(d[2 + 2 * k] * 256 + d[3 + 2 * k]) % len(PARTS)] for k in range(8)) if p.isascii()]
        style = d[40] % 8
        if style == 0:
            s = "_".join(parts[:4])
        elif style == 1:
            s = parts[0] + "".join(p.title() for p in parts[1:5])
        elif style == 2:
            s = "-".join(parts[:5])
        elif style == 3:
            s = "_".join(parts[:4]).upper()
        elif style == 4:
            s = "/".join(parts[:5])
        elif style == 5:
            s = "".join(parts[:4]) + str(d[41])
        else:
            s = "".join(parts[:7])
        rows.append((s, 0))
    return rows


def fit(sample: list[tuple[str, int]], weight: float = 0.05) -> list[int]:
    """Log-likelihood ratios of bigrams in thousandths, WIDTH x WIDTH, with additive smoothing."""
    counts = [[weight] * (WIDTH * WIDTH) for _ in range(2)]
    for s, label in sample:
        codes = [ord(c) - LOW for c in s]
        for x, y in zip(codes, codes[1:], strict=False):
            if 0 <= x < WIDTH and 0 <= y < WIDTH:
                counts[label][x * WIDTH + y] += 1
    rows = [[sum(c[x * WIDTH : (x + 1) * WIDTH]) for x in range(WIDTH)] for c in counts]
    return [
        round(SCALE * (math.log(counts[1][k] / rows[1][k // WIDTH]) - math.log(counts[0][k] / rows[0][k // WIDTH])))
        for k in range(WIDTH * WIDTH)
    ]


def log_ratio(token: Column, ratios: list[int]) -> Column:
    """Sum of the bigram ratios of a token, in thousandths; a bigram with a character outside the table counts nothing."""
    known = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c) - LOW)
    n = F.size(codes)
    pairs = F.zip_with(F.slice(codes, F.lit(1), n - 1), F.slice(codes, F.lit(2), n - 1), lambda x, y: F.when(x.between(0, WIDTH - 1) & y.between(0, WIDTH - 1), F.get(known, x * WIDTH + y)).otherwise(0))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """array<struct<start, kind, end>> of the leftmost non-overlapping matches that keep() takes."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    sizes = F.transform(found, lambda x: F.length(x))
    starts = prefix_sums(F.zip_with(gaps, sizes, lambda g, s: g + F.coalesce(s, F.lit(0))))
    places = F.zip_with(
        found,
        F.zip_with(starts, gaps, lambda s, g: s + g),
        lambda m, s: F.struct(s.alias("start"), F.lit(kind).cast("int").alias("kind"), (s + F.length(m)).alias("end"), m.alias("m")),
    )
    kept = F.filter(places, lambda p: p["m"].isNotNull() & keep(p["m"]))
    kept = F.transform(kept, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    return F.when(F.size(found) > 0, kept).otherwise(none)


def scan(docs: DataFrame, text: str = "text", ratios: list[int] | None = None) -> DataFrame:
    """Adds ``base_spans`` and ``spans``, arrays of (start, kind, end) sorted by start, then kind.

    base_spans holds assign, access and hex matches; spans also long tokens that the random-string
    model explains better, where they overlap no base span. Null and empty texts have no spans.
    Repeated rows are scanned alike; a table of no rows stays so. Columns of these names are replaced.
    """
    ratios = fit(labelled_sample()) if ratios is None else ratios
    body = whole_text(text)
    yes = lambda m: F.lit(True)
    assign = _spans(body, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8)
    access = F.when(body.contains("AKIA"), _spans(body, ACCESS, 1, yes)).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    base = F.array_sort(F.concat(assign, access, _spans(body, HEX, 2, yes)))

    def is_random(m: Column) -> Column:
        score = log_ratio(m, ratios)
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (score >= F.lit(int(LEAST_SUM * SCALE))) & (score >= (F.length(m) - 1) * int(LEAST_MEAN * SCALE))

    out = docs.withColumn("base_spans", base).withColumn("spans", _spans(body, TOKEN, 3, is_random))
    apart = F.filter("spans", lambda r: ~F.exists("base_spans", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return out.withColumn("spans", F.when(F.size("spans") > 0, F.array_sort(F.concat("base_spans", apart))).otherwise(F.col("base_spans")))


def spans_string(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same columns, each run of overlapping or touching spans in ``text`` replaced by ``mark``; null texts stay null."""
    names = docs.columns
    found = scan(docs.withColumnRenamed("spans", "__spans").withColumnRenamed("base_spans", "__base_spans") if {"spans", "base_spans"} & set(names) else docs, text)
    far = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    found = found.withColumn("__far", F.when(F.size("spans") > 0, far))
    before = lambda i: F.coalesce(F.get("__far", i - 1)["end"], F.lit(0))
    body = F.col(text)
    pieces = F.transform("__far", lambda s, i: F.concat(F.substring(body, before(i) + 1, s["start"] - before(i)), F.lit(mark)))
    tail = F.substring(body, F.element_at("__far", -1)["end"] + 1, F.length(body))
    found = found.withColumn(text, F.when(F.col("__far").isNotNull(), F.concat(F.array_join(pieces, ""), tail)).otherwise(body))
    back = {"__spans": "spans", "__base_spans": "base_spans"}
    return found.select(*[F.col(next((k for k, v in back.items() if v == c and k in found.columns), c)).alias(c) for c in names])
