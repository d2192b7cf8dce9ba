"""Catalogue curation: matching, joining, keeping one of each, upserting."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridloom.functions.ids import first_match


def require(df: DataFrame, *names: str) -> DataFrame:
    """The table, if it has the columns; else ValueError when the plan is built."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def unify_identifier(df: DataFrame, a: str = "file_identifier", b: str = "fileIdentifier") -> DataFrame:
    """Both spellings of a column, each filled from the other."""
    have = [c for c in (a, b) if c in df.columns]
    if not have:
        raise ValueError(f"neither {a} nor {b}")
    value = F.coalesce(*[F.col(c) for c in have])
    return df.withColumns({a: value, b: value})


def normalize_hash(df: DataFrame, name: str = "sha256") -> DataFrame:
    """Trimmed and lower-cased; null stays null and joins nothing."""
    return df.withColumn(name, F.lower(F.trim(F.col(name).cast("string"))))


def id_set(df: DataFrame, name: str, lower: bool = True) -> DataFrame:
    """Distinct trimmed ids, blanks dropped, in a column ``id``."""
    value = F.trim(F.col(name).cast("string"))
    return df.select((F.lower(value) if lower else value).alias("id")).where("id <> ''").distinct()


def members(df: DataFrame, key: Column, ids: DataFrame, keep: bool = True) -> DataFrame:
    """Rows whose key is in ``ids.id`` (or is not). Adaptive execution broadcasts the ids if they turn out small."""
    return df.withColumn("__key", key).join(ids.select(F.col("id").alias("__id")), F.col("__key") == F.col("__id"), "left_semi" if keep else "left_anti").drop("__key")


def match_columns(df: DataFrame, ids: DataFrame, pattern: str, label: str, columns: list[str] | None = None) -> DataFrame:
    """Rows whose extracted id is in the set, once for each column that has it: matched_id, matched_column, matched_type.

    All columns are searched in one scan and one join.
    """
    columns = string_columns(df) if columns is None else columns
    each = F.array(*[F.struct(F.lit(c).alias("matched_column"), F.lower(first_match(F.col(c), pattern)).alias("matched_id")) for c in columns])
    x = df.withColumn("__m", F.explode(F.filter(each, lambda m: m["matched_id"].isNotNull())))
    x = x.select(*df.columns, "__m.matched_id", "__m.matched_column", F.lit(label).alias("matched_type"))
    return x.join(ids.select(F.col("id").alias("__id")), F.col("matched_id") == F.col("__id"), "left_semi")


def score_columns(df: DataFrame, ids: DataFrame, pattern: str, columns: list[str]) -> DataFrame:
    """For each column: rows whose value is an id, rows whose extract is one, distinct ids and the first five."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("ordinal"), F.lit(c).alias("column"), F.lower(F.trim(F.col(c).cast("string"))).alias("v")) for k, c in enumerate(columns)])).alias("e")).select("e.*")
    rows = rows.withColumn("x", F.lower(first_match(F.col("v"), pattern)))
    known = ids.select(F.col("id"))
    rows = rows.join(known.withColumnRenamed("id", "d"), F.col("v") == F.col("d"), "left").join(known.withColumnRenamed("id", "e"), F.col("x") == F.col("e"), "left")
    both = F.explode(F.when(F.coalesce("d", "e").isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.filter(F.array("d", "e"), lambda v: v.isNotNull())))
    counts = rows.groupBy("ordinal", "column").agg(F.count("d").alias("direct_matches"), F.count("e").alias("extracted_matches"))
    found = rows.select("ordinal", both.alias("id")).where("id is not null").distinct()
    # the least five of each of many buckets, then the least five of those
    least = F.row_number().over(Window.partitionBy("ordinal", F.pmod(F.xxhash64("id"), F.lit(256))).orderBy("id"))
    found = found.withColumn("in_bucket", least)
    rank = F.row_number().over(Window.partitionBy("ordinal", F.col("in_bucket") <= 5, F.when(F.col("in_bucket") > 5, F.xxhash64("id"))).orderBy("id"))
    found = found.withColumn("r", F.when(F.col("in_bucket") <= 5, rank)).groupBy("ordinal").agg(F.count("*").alias("unique_matched_ids"), F.array_sort(F.collect_list(F.when(F.col("r") <= 5, F.col("id")))).alias("sample_ids"))
    out = counts.join(found, "ordinal", "left")
    return out.select("ordinal", "column", "direct_matches", "extracted_matches", F.coalesce("unique_matched_ids", F.lit(0)).alias("unique_matched_ids"), F.coalesce("sample_ids", F.array().cast("array<string>")).alias("sample_ids"))


def best_column(scores: DataFrame) -> DataFrame:
    """The best scored column, earlier columns first among equals; no row if no column matches."""
    order = [F.desc("unique_matched_ids"), F.desc("direct_matches"), F.desc("extracted_matches"), F.asc("ordinal")]
    return scores.orderBy(*order).limit(1).where("unique_matched_ids > 0")


def join_suffixed(a: DataFrame, b: DataFrame, key: str, suffixes: tuple[str, str] = ("_source", "_target")) -> DataFrame:
    """Inner join; the columns that both have get suffixes. Null keys join nothing."""
    both = (set(a.columns) & set(b.columns)) - {key}
    named = lambda df, s: df.select(*[F.col(c).alias(c + s if c in both else c) for c in df.columns])
    return named(a, suffixes[0]).join(named(b, suffixes[1]), key)


def keep_one(df: DataFrame, keys: list[str], best: Callable[[Column, Column], Column], by: list[str]) -> DataFrame:
    """The row of each key that ``best`` (F.max_by or F.min_by) finds in the order of ``by``, nulls first. Tasks combine before the shuffle."""
    row = best(F.struct(*df.columns), F.struct(*[x for c in by for x in (F.col(c).isNotNull(), F.col(c))]))
    return df.groupBy(*keys).agg(row.alias("__row")).select(*[F.col("__row")[c].alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return keep_one(df, keys, F.max_by, [seq])


def keep_first(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return keep_one(df, keys, F.min_by, [seq])


def upsert(master: DataFrame, parts: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Rows of ``parts`` over those of ``master`` by key; among parts the last by ``seq``."""
    m = master.withColumn("__p", F.lit(0))
    p = parts.withColumn("__p", F.lit(1))
    return keep_one(m.unionByName(p), keys, F.max_by, ["__p", *([seq] if seq else [])]).drop("__p")


def download_status(returned: Column, exists: Column) -> Column:
    some = F.coalesce(F.length(returned) > 0, F.lit(False))
    return F.when(some & exists, "success").when(some, "returned_but_not_found").otherwise("missing")


def status_rows(returned: DataFrame, meta: DataFrame, key: str = "file_identifier") -> DataFrame:
    """A row for each returned file and metadata row of its key; nulls where there is none."""
    return returned.join(meta, key, "left")


def pending(manifest: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to be done."""
    return manifest.join(done.select(*keys), keys, "left_anti")


def has_all(listing: DataFrame, key: str, name: str, required: list[str]) -> DataFrame:
    """Keys whose listing holds every required name (relational division)."""
    wanted = listing.where(F.col(name).isin(required)).groupBy(key).agg(F.count_distinct(name).alias("n"))
    return wanted.where(F.col("n") == len(set(required))).select(key)


def complete_views(expected: DataFrame, actual: DataFrame, keys: list[str], mode: str = "full") -> DataFrame:
    """Views (object, view, num_frames) that are done: by the last frame's files, or by all frames' (keys + frame, kind)."""
    both = actual.groupBy(*keys, "frame").agg(F.count_distinct("kind").alias("kinds")).where("kinds = 2")
    x = expected.join(both, keys, "left")
    if mode == "last_frame":
        done = F.max(F.coalesce(F.col("frame") == F.col("num_frames") - 1, F.lit(False)))
    elif mode == "full":
        done = F.count(F.when((F.col("frame") >= 0) & (F.col("frame") < F.col("num_frames")), 1)) == F.first("num_frames")
    else:
        raise ValueError(f"unknown mode {mode}")
    return x.groupBy(*keys).agg(done.alias("done"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def seed_manifest(items: DataFrame, known: DataFrame, seed: Column, key: str = "path") -> DataFrame:
    """Items with ``seed``: known seeds stay (the least of a key's), new items get theirs from ``seed``. One row for each item, whatever keys repeat."""
    old = known.groupBy(key).agg(F.min("seed").alias("__old"))
    return items.join(old, key, "left").select(*[c for c in items.columns if c != "seed"], F.coalesce("__old", seed).alias("seed"))


def jobs(assets: DataFrame, trajectories: DataFrame) -> DataFrame:
    """Each asset with each trajectory: the product is the result asked for."""
    return assets.crossJoin(trajectories)
