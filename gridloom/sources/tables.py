"""Readers and writers of catalogue files."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.functions.ids import base_name, natural_key, parent


def load_table(spark: SparkSession, path: str, schema: StructType | str | None = None, text_as_tsv: bool = True) -> DataFrame:
    """A catalogue by its suffix: parquet, csv, tsv, txt (tab separated, if allowed), jsonl, json (an object or a list of them; nested keys become dotted columns)."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if suffix == ".parquet":
        return reader.parquet(path)
    if suffix == ".csv":
        return reader.csv(path, header=True, inferSchema=schema is None)
    if suffix == ".tsv" or suffix == ".txt" and text_as_tsv:
        return reader.csv(path, header=True, sep="\t", inferSchema=schema is None)
    if suffix == ".jsonl":
        return reader.json(path)
    if suffix == ".json":
        return flatten(reader.json(path, multiLine=True))
    raise ValueError(f"unsupported format: {suffix}")


def flatten(df: DataFrame) -> DataFrame:
    """Fields of structs as columns with dotted names; arrays and maps stay."""

    def walk(schema: StructType, at: Column | None, name: str):
        for f in schema.fields:
            own = f.name if not name else f"{name}.{f.name}"
            value = F.col(f"`{f.name}`") if at is None else at.getField(f.name)
            if isinstance(f.dataType, StructType):
                yield from walk(f.dataType, value, own)
            else:
                yield value.alias(own)

    return df.select(*walk(df.schema, None, ""))


def read_id_list(spark: SparkSession, path: str, lower: bool = True) -> DataFrame:
    """Distinct ids of a file with one on each line."""
    value = F.trim("value")
    return spark.read.text(path).select((F.lower(value) if lower else value).alias("id")).where("id <> ''").distinct()


def write_id_list(ids: DataFrame, path: str, column: str = "id") -> None:
    """Sorted text. The list is sorted in ranges, so its part files follow each other."""
    ids.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str) -> None:
    """csv with a header or parquet, by suffix; the job's commit replaces the old one as a whole."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    writer = df.write.mode("overwrite")
    if suffix == ".csv":
        writer.csv(path, header=True)
    elif suffix == ".parquet":
        writer.parquet(path)
    elif suffix in (".json", ".jsonl"):
        writer.json(path)
    else:
        raise ValueError(f"unsupported format: {suffix}")


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, size) of the files under a folder, contents not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", F.col("length").alias("size"))


def list_objects(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(chunk, object, file, sort_key) of a two-level folder; sort_key gives the natural order of objects."""
    files = list_files(spark, root, glob)
    up = parent(F.col("path"))
    return files.select(base_name(parent(up)).alias("chunk"), base_name(up).alias("object"), base_name(F.col("path")).alias("file")).withColumn("sort_key", natural_key(F.concat_ws("/", "chunk", "object")))


def list_frames(spark: SparkSession, root: str, glob: str = "*.png", pattern: str = "frame_(\\d+)") -> DataFrame:
    """(path, frame) of the files or folders whose name has a frame number; others are left out."""
    files = list_files(spark, root, glob)
    number = F.regexp_extract("path", pattern, 1)
    return files.where(number != "").select("path", number.cast("long").alias("frame"))


def read_reports(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON reports, one to a file; what does not parse keeps its text in _corrupt_record."""
    full = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if "_corrupt_record" not in full.fieldNames():
        full = StructType([*full.fields]).add("_corrupt_record", "string")
    return spark.read.schema(full).option("recursiveFileLookup", "true").json(path, multiLine=True, mode="PERMISSIVE")


def valid_reports(reports: DataFrame, field: str = "results") -> DataFrame:
    return reports.where(F.col("_corrupt_record").isNull() & F.col(field).isNotNull())


def scan_field(spark: SparkSession, path: str, field: str) -> DataFrame:
    """(path, value) of an integer field of JSON files: by a pattern in the text, else by parsing."""
    text = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    quick = F.nullif(F.regexp_extract("value", f'"{field}"\\s*:\\s*(\\d+)', 1), F.lit(""))
    return text.select("path", F.coalesce(quick, F.get_json_object("value", f"$.{field}")).cast("long").alias("value"))
