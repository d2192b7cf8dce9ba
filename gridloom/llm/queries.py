"""The queries of this subpackage: each operator over its whole table, and DuckDB SQL where it can be said."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bpe, chat, forest, licenses, packing, secrets, simhash, substring, syncmers, toxicity
from gridloom.llm.common import checkpoint, table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spans_string(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_string(F.col("spans")).alias("spans"),
    )


def _op1_sql() -> str:
    def spans(name: str, pattern: str, kind: int, keep: str) -> str:
        p = pattern.replace("'", "''")
        return f"""{name} AS (
  SELECT doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'k': {kind}, 'm': m[i]}}),
    lambda r: {keep}) AS v
  FROM (SELECT doc_id, t, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g FROM d))"""

    assign = secrets.ASSIGN.replace("'", "''")
    ratios = ",".join(map(str, secrets.fit(secrets.labelled_sample())))
    w, low = secrets.WIDTH, secrets.LOW
    keep = "regexp_matches(r.m, '[0-9]') AND regexp_matches(r.m, '[A-Za-z]')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
model AS MATERIALIZED (SELECT [{ratios}] AS v),
{spans("a", secrets.ASSIGN, 0, f"length(regexp_extract(r.m, '{assign}', 2)) >= 8")},
{spans("c", secrets.ACCESS, 1, "true")},
{spans("h", secrets.HEX, 2, "true")},
{spans("t0", secrets.TOKEN, 3, keep)},
u AS (SELECT doc_id, unnest(v) AS r FROM t0),
sc AS (SELECT doc_id, r, sum(model.v[(ascii(r.m[i]) - {low}) * {w} + ascii(r.m[i + 1]) - {low} + 1]) AS score FROM u, model, unnest(range(1, length(r.m))) AS q(i) GROUP BY ALL),
tk AS (SELECT doc_id, r.s AS s, r.k AS k, r.s + length(r.m) AS e FROM sc WHERE score >= {int(secrets.LEAST_SUM * secrets.SCALE)} AND score >= (length(r.m) - 1) * {int(secrets.LEAST_MEAN * secrets.SCALE)}),
b AS (SELECT doc_id, r.s AS s, r.k AS k, r.s + length(r.m) AS e FROM (SELECT doc_id, unnest(v) AS r FROM a UNION ALL SELECT doc_id, unnest(v) FROM c UNION ALL SELECT doc_id, unnest(v) FROM h)),
x AS (SELECT * FROM b UNION ALL SELECT * FROM tk WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = tk.doc_id AND b.s < tk.e AND tk.s < b.e)),
o AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  coalesce(string_agg(n || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3), '') AS base, string_agg(n || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans
  FROM (SELECT *, (['assign', 'access', 'hex', 'random'])[k + 1] AS n FROM x) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (doc_id)"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(checkpoint(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels"))))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    first, last = F.get("places", F.lit(0)), F.when(F.size("places") > 0, F.element_at("places", -1))
    return out.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), first.alias("first_word"), last.alias("last_word"), "base_labels", "labels", "score")


def _op4_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    places = []
    for phrase in licenses.PHRASES:
        parts = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(parts))
        places.append(f"list_filter(range(1, len(w) - {len(parts) - 2}), lambda i: {test})")
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(licenses.PHRASES.values()))
    values = ", ".join(f"('{label}', {sorted(x.decode() for x in set(licenses.words(text.encode())))})" for label, text in licenses.TEMPLATES.items())
    every = " || ".join(f"p{k}" for k in range(len(places)))
    return f"""WITH t(label, words) AS (VALUES {values}),
d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS x FROM documents),
b AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '{word}')) AS w FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS line FROM d)),
m AS (SELECT doc_id, label, len(list_intersect(w, words)) / len(words) AS share FROM b, t WHERE len(list_intersect(w, words)) / len(words) >= {licenses.THRESHOLD}),
n AS (SELECT doc_id, max(share) AS share, list(DISTINCT label) AS found FROM m GROUP BY doc_id),
p AS (SELECT doc_id, len(w) AS n_words, {", ".join(f"{x} AS p{k}" for k, x in enumerate(places))} FROM (SELECT doc_id, regexp_extract_all(x, '{word}') AS w FROM d)),
q AS (SELECT doc_id, n_words, {every} AS places, list_filter([{base}], lambda v: v IS NOT NULL) AS base FROM p)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(found, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM q LEFT JOIN n USING (doc_id)"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.with_next(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    said = "\\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    out = chat.format_chat(turns.unionByName(own), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.where("last").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op8_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring.deduplicate(docs)
    return out.select("doc_id", F.size("removed").cast("long").alias("n_removed"), "removed", "text")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.clusters(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_secrets, op2_bpe, op3_toxicity, op4_licenses, op5_packing, op6_syncmers, op7_chat, op8_forest, op9_substring, op10_simhash, pipeline)}
ORACLES = {"op1_secrets": _op1_sql, "op4_licenses": _op4_sql}


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, sql in ORACLES.items()}
