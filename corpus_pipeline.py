"""A pipeline of corpus operators: documents to packed training sequences.

Each stage reads all that the one before has kept, from a table, and works on whole texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import packing, secrets, simhash, substring, toxicity
from gridloom.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a toxicity score of 0.3 and more go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints stays."""
    return simhash.deduplicate(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs that an earlier document has, or an earlier place of the same one, go from the texts."""
    out = substring.deduplicate(docs)
    return out.withColumn("n_chars", _length(out)).select(*docs.columns) if "n_chars" in docs.columns else out.select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", _length(out)).select(*docs.columns) if "n_chars" in docs.columns else out


def _length(docs: DataFrame):
    from pyspark.sql import functions as F

    return F.length("text").cast(docs.schema["n_chars"].dataType)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, packed into sequences of 2048."""
    import public_tokenizers

    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("secret_scan", hide_secrets),
    ("best_fit_packing", pack),
]

#: SQL cannot say a learned grammar, a tokenizer or a packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each one's rows are written to the shared folder and read again.

    A stage's folder goes when the next one is written; the last one's stays, as the result is read from it.
    """
    top = f"{shared_folder(spark).rstrip('/')}/corpus_pipeline/{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        here = f"{top}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = here
    return docs
