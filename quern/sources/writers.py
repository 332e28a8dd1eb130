"""Sinks: JSON lines through Spark's commit protocol, single documents, and their verification."""

from __future__ import annotations

import json
import os
import tempfile
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.validate import entry_error


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", one_file: bool = False, skip_empty: bool = False) -> bool:
    """df as JSON lines, nulls left out, committed as a whole; whether anything was written (an empty df can be skipped)."""
    if skip_empty and df.isEmpty():
        return False
    (df.coalesce(1) if one_file else df).write.mode(mode).option("ignoreNullFields", True).json(path)
    return True


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_text(path: str, text: str) -> None:
    """A small text to a local file: written beside it and renamed, so no reader sees half of it."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, tmp = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(tmp, path)
    except BaseException:
        if os.path.exists(tmp):
            os.unlink(tmp)
        raise


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text to a file of any file system that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_json(path: str, value: Any) -> None:
    write_text(path, json.dumps(value, indent=2, ensure_ascii=False, default=str))


def write_corpus(df: DataFrame, path: str, metadata: dict[str, Any]) -> None:
    """Passages as JSON lines in ``path``/passages and their metadata beside them in ``path``/metadata."""
    df.write.mode("overwrite").json(f"{path}/passages")
    df.sparkSession.createDataFrame([(json.dumps(metadata, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def verify_jsonl(spark: SparkSession, path: str, expected: int | None = None) -> tuple[bool, int, list[str]]:
    """Whether every line parses, the number of lines, and warnings; another count than expected only warns."""
    lines = spark.read.text(path).where("trim(value) != ''")
    row = lines.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.try_parse_json("value").isNull(), 1)).alias("bad")).first()
    warnings = [] if expected is None or row["n"] == expected else [f"expected {expected} rows, found {row['n']}"]
    return row["bad"] == 0, row["n"], warnings


def line_errors(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, value, error) of the lines of JSON files that are no JSON objects or whose chat entry has a fault."""
    kind = "struct<messages: array<struct<role: string, content: string, tool_calls: array<struct<id: string, type: string, function: struct<name: string, arguments: string>>>, tool_call_id: string>>, tags: struct<persona: string, tone: string, domain: array<string>>>"
    lines = spark.read.text(path).where("trim(value) != ''").select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("source_file"), "value")
    rows = lines.withColumn("e", F.from_json("value", kind))
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    error = F.when(~whole, "Invalid JSON").otherwise(entry_error(F.col("e.messages"), F.col("e.tags.persona"), F.col("e.tags.tone"), F.col("e.tags.domain")))
    return rows.select("source_file", "value", error.alias("error")).where("error is not null")


def verify_posts(df: DataFrame) -> DataFrame:
    """(valid, n): chat entries of posts that have exactly system, user and assistant and tags, and others."""
    roles = F.transform("messages", lambda m: m["role"])
    good = F.coalesce((roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))) & F.col("tags").isNotNull(), F.lit(False))
    return df.select(good.alias("valid")).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


def verify_entries(df: DataFrame) -> DataFrame:
    """(error, n) of the first faults of chat entries; null for sound ones."""
    e = entry_error(F.col("messages"), F.col("tags.persona"), F.col("tags.tone"), F.col("tags.domain"))
    return df.select(e.alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def write_split(df: DataFrame, folder: str, split: str = "split") -> None:
    """One folder of JSON lines per split."""
    df.write.mode("overwrite").partitionBy(split).json(folder)
