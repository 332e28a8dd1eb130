"""Readers: JSON, JSON lines, CSV and whole texts, into DataFrames.

Bad input gives no rows and no exception where the format allows it: a JSON
file that does not parse, a broken line, a missing file.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where a JSON object holds its rows, in order of precedence.
ROOT_KEYS = ("items", "data", "passages", "entries")
SUFFIXES = {".json": "json", ".jsonl": "jsonl", ".ndjson": "jsonl", ".csv": "csv", ".txt": "text", ".parquet": "parquet"}


def struct(ddl: str) -> T.StructType:
    """A schema from its DDL."""
    return T.StructType.fromDDL(ddl)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, with any scheme, has files."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def file_name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def empty(spark: SparkSession, schema: T.StructType | str | None) -> DataFrame:
    return spark.createDataFrame([], schema or T.StructType([]))


def variant_rows(spark: SparkSession, path: str) -> DataFrame:
    """(row, source_file) with a variant per item of the JSON files of a path.

    A list gives its elements, an object the first list under ROOT_KEYS, or
    itself if it has none; a scalar or broken file gives nothing.
    """
    if not exists(spark, path):
        return empty(spark, "row variant, source_file string")
    files = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"), file_name().alias("source_file"))
    listed = F.lit(None).cast("array<variant>")
    for key in reversed(ROOT_KEYS):
        here = F.try_variant_get("v", f"$.{key}", "array<variant>")
        listed = F.coalesce(here, listed)
    kind = F.schema_of_variant("v")
    rows = (
        F.when(kind.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>"))
        .when(kind.startswith("OBJECT"), F.coalesce(listed, F.array("v")))
        .otherwise(F.array().cast("array<variant>"))
    )
    return files.where("v is not null").select(F.explode(rows).alias("row"), "source_file")


def from_variants(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of a schema taken from variant rows; what a row lacks or has in another type is null."""
    def field(f: T.StructField) -> Column:
        return F.try_variant_get("row", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)

    rest = [c for c in rows.columns if c != "row" and c not in schema.fieldNames()]
    return rows.select(*[field(f) for f in schema.fields], *rest)


def inferred_schema(rows: DataFrame) -> T.StructType:
    """The schema of variant rows, by aggregation over all of them; what is null everywhere is a string."""
    told = rows.agg(F.schema_of_variant_agg("row").alias("s")).first()["s"]
    if not told or not told.startswith("OBJECT<"):
        return T.StructType([])
    return T.StructType.fromDDL(told[len("OBJECT<") : -1].replace("OBJECT<", "STRUCT<").replace("VOID", "STRING"))


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    rows = variant_rows(spark, path)
    return from_variants(rows, schema or inferred_schema(rows))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The lines of JSON files; blank and broken lines are left out."""
    if not exists(spark, path):
        return empty(spark, schema)
    reader = spark.read.option("mode", "DROPMALFORMED")
    df = (reader.schema(schema) if schema else reader).json(path)
    return df.drop("_corrupt_record")


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, value) of the lines that are not JSON objects."""
    lines = spark.read.text(path).where("trim(value) != ''").select("value", file_name().alias("source_file"))
    return lines.where(~F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False)))


def encodings(spark: SparkSession, path: str) -> dict[str, str]:
    """The encoding of each file of a path: UTF-8 if all of it is, else Latin-1.

    Files are read line by line, so none is ever held as a whole.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    names: list[str] = []
    for status in p.getFileSystem(conf).globStatus(p) or []:
        if status.isDirectory():
            names += [str(f.getPath()) for f in status.getPath().getFileSystem(conf).listStatus(status.getPath()) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
        else:
            names.append(str(status.getPath()))
    if not names:
        return {}
    lines = spark.read.text(names).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8(F.col("value")).alias("ok"))
    bad = {r["file"] for r in lines.where("not ok").select("file").distinct().collect()}  # at most a row for each file
    plain = lambda n: n.split(":", 1)[-1].lstrip("/")
    wrong = {plain(unquote(b)) for b in bad}
    return {n: "ISO-8859-1" if plain(n) in wrong else "UTF-8" for n in names}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """CSV files with a header, each in its own encoding: UTF-8, or Latin-1 if it is no valid UTF-8; broken lines are left out; None if nothing can be read.

    Columns are taken by name; what a file lacks is null.
    """
    if not exists(spark, path):
        return None
    by: dict[str, list[str]] = {}
    for name, encoding in encodings(spark, path).items():
        by.setdefault(encoding, []).append(name)
    parts = []
    for encoding, names in sorted(by.items(), reverse=True):
        reader = spark.read.options(header=True, multiLine=True, escape='"', mode="DROPMALFORMED", encoding=encoding)
        parts.append((reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(names))
    return union(parts) if parts else None


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, text) of whole text files."""
    return spark.read.text(path, wholetext=True).select(file_name().alias("source_file"), F.col("value").alias("text"))


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A reader by the suffix of a path; an unknown suffix is tried as JSON."""
    kind = next((k for s, k in SUFFIXES.items() if path.lower().endswith(s)), "json")
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "text":
        return read_books(spark, path)
    return {"json": read_json, "jsonl": read_jsonl, "csv": read_csv}[kind](spark, path, schema)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns by name, what a part lacks null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_sources(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """All rows of several files, each with source_file, its file's name, unless it has one."""
    parts = []
    for p in paths:
        df = read_any(spark, p, schema)
        if df is None or not df.columns:
            continue
        name = F.lit(p.rstrip("/").rsplit("/", 1)[-1])
        parts.append(df.withColumn("source_file", F.coalesce("source_file", name) if "source_file" in df.columns else name))
    return union(parts) if parts else empty(spark, schema)


def missing_fields(df: DataFrame, fields: Sequence[str]) -> Column:
    """The names of required fields that a row lacks."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) if f in df.columns else F.lit(f) for f in fields]))


def style_examples(passages: DataFrame, author: str, most: int = 20, least: int = 50, size: int = 500) -> DataFrame:
    """At most ``most`` texts of an author longer than ``least`` characters, cut to ``size``."""
    return passages.where(F.lower("author_name").contains(author.lower()) & (F.length("text") > least)).orderBy("passage_id", "text").select(F.left("text", F.lit(size)).alias("text")).limit(most)


FETCH_DELAYS = (2, 4)  # seconds before another try


def cached_fetch(path: str, fetch, force: bool = False, tries: int = 3, wait=None) -> str:
    """The local copy of a remote text: kept if it is there, else got by ``fetch()``, which is tried several times; a failed try leaves no file."""
    import os
    import time

    if os.path.exists(path) and not force:
        return path
    for k in range(tries):
        try:
            text = fetch()
            break
        except OSError:
            if k == tries - 1:
                raise
            (wait or time.sleep)(FETCH_DELAYS[min(k, len(FETCH_DELAYS) - 1)])
    tmp = f"{path}.part"
    with open(tmp, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(tmp, path)
    return path
