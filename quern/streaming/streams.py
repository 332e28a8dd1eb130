"""Structured Streaming forms of the stateless stages, and keyed state for duplicates.

The stages are the same column expressions as in batch.  Late rows are
bounded by watermarks; every query takes its checkpoint folder from the
caller, so a restart goes on where it ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.functions import text
from quern.operators import joins


def stream(spark: SparkSession, folder: str, schema, form: str = "parquet", files: int = 100) -> DataFrame:
    """Files of a folder as they come, at most ``files`` in a micro-batch."""
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files).load(folder)


def cleaned(rows: DataFrame, column: str = "content", lang: str = "en") -> DataFrame:
    """Normalized, valid rows of one language: no state, so any rate of rows scales by partitions."""
    out = text.normalize_columns(rows, columns=(column,))
    return out.where(text.is_valid(F.col(column))).where(joins.detected_language(F.col(column)) == lang)


def first_seen(rows: DataFrame, column: str, time: str, late: str = "1 day") -> DataFrame:
    """The first row of each text within the watermark: the state holds a digest per text, and drops it when the watermark has passed."""
    digest = F.md5(F.lower(F.trim(F.coalesce(F.col(column), F.lit("")))).cast("binary"))
    return rows.withColumn("_digest", digest).withWatermark(time, late).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def windowed(rows: DataFrame, time: str, group: list[str], length: str = "1 hour", slide: str | None = None, late: str = "1 hour", value: Column | None = None) -> DataFrame:
    """(begin, end, group..., n, total): rows, and the sum of a value, of tumbling or sliding windows."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    sums = [F.count(F.lit(1)).alias("n"), F.sum(value if value is not None else F.lit(0)).alias("total")]
    return rows.withWatermark(time, late).groupBy(w.alias("w"), *group).agg(*sums).select(F.col("w.start").alias("begin"), F.col("w.end").alias("end"), *group, "n", "total")


def to_folder(df: DataFrame, folder: str, checkpoint: str, form: str = "json", once: bool = True) -> StreamingQuery:
    """A query that appends to a folder, exactly once per row; with ``once`` it ends when all present files are read."""
    writer = df.writeStream.format(form).option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
