"""Problem 9: long stretches that stand word for word in other documents too.

Seed: of every run of MIN code points the least hash among its K-grams is its
anchor (winnowing), so equal runs have equal anchors.  A document thus falls
into segments, each the runs of one anchor.  Documents are joined on anchors:
a first pass counts by anchor, with partial aggregation, in which documents it
stands, and moves no text.  The anchors that two documents share are made a
bitmap of bounded size, and a second pass over the texts lets only segments
whose anchor is in it go on.
Extend: each such segment goes with the code points MIN - 1 either way of its
anchor; run by run what another document has too stays.  Overlapping
runs are joined to maximal stretches.

Exact copies of a text are one class: a class of several documents is shared
from end to end, and one text stands for it as a partner of others.  Anchors
with more than HOT segments (boilerplate) never come together in one task:
their runs are counted by hash with partial aggregation instead.

Defined results: null texts and texts shorter than the limit have no spans;
runs repeated only within one document do not count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import codepoints as cp
from quern.llm.common import bitmap, in_bitmap, keep, small
from quern.session import table

MIN = 150
K = 64
HOT = 5000


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of width values."""
    size, cur = 1, v
    while size * 2 <= width:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    rest = width - size
    return np.minimum(cur[: len(cur) - rest], cur[rest:]) if rest else cur


def segments_of(codes: np.ndarray, offsets: np.ndarray, least: int, k: int) -> tuple[np.ndarray, ...]:
    """(anchor, row, start, n): each row's runs of ``least`` code points, grouped by anchor; start counts from the row's begin, n is the number of runs."""
    none = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    if len(codes) < least:
        return none
    begin = np.arange(len(codes) - k + 1)
    grams = cp.mix(cp.span_hashes(cp.prefix_sums(codes), begin, begin + k))
    low = np.uint64(0xFFFFFFFF)
    ranked = (grams & ~low) | (low - begin.astype(np.uint64))
    at = (low - (sliding_min(ranked, least - k + 1) & low)).astype(np.int64)  # of each run, where its anchor is
    sizes = np.maximum(np.diff(offsets) - least + 1, 0)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(offsets[:-1], sizes)
    if not len(starts):
        return none
    own = at[starts]
    head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (rows[1:] != rows[:-1])])
    return grams[own[head]], rows[head], starts[head] - offsets[rows[head]], np.diff(np.r_[head, len(starts)])


def anchors(texts: DataFrame, least: int = MIN, k: int = K) -> DataFrame:
    """(anchor, lo, hi, many) of texts (id, text): the anchors, the least and greatest id each stands in, and its segments, added up by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column("text").to_pylist(), batch.column("id").to_numpy()
            for a, b in cp.slices(rows):
                anchor, row, _, _ = segments_of(*cp.explode(rows[a:b]), least, k)
                own = ids[a:b][row]
                order = np.lexsort((own, anchor))
                anchor, own = anchor[order], own[order]
                head = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]][: len(anchor)])
                last = np.r_[head[1:], len(anchor)] - 1 if len(anchor) else head
                yield pa.RecordBatch.from_arrays([pa.array(anchor[head].view(np.int64)), pa.array(own[head]), pa.array(own[last]), pa.array((last - head + 1).astype(np.int64))], names=["anchor", "lo", "hi", "many"])

    return texts.select("id", "text").mapInArrow(run, "anchor long, lo long, hi long, many long")


def segments(texts: DataFrame, bits: np.ndarray, least: int = MIN, k: int = K) -> DataFrame:
    """(anchor, id, start, n, slice) of texts (id, text): the segments whose anchor is in the bitmap, with their text."""
    held = texts.sparkSession.sparkContext.broadcast(bits)  # of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column("text").to_pylist(), batch.column("id").to_numpy()
            for a, b in cp.slices(rows):
                anchor, row, start, n = segments_of(*cp.explode(rows[a:b]), least, k)
                some = in_bitmap(held.value, anchor)
                anchor, row, start, n = anchor[some], row[some], start[some], n[some]
                part = [rows[a + r][x:y] for r, x, y in zip(row.tolist(), start.tolist(), (start + n + least - 1).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(ids[a:b][row]), pa.array(start), pa.array(n), pa.array(part, pa.string())], names=["anchor", "id", "start", "n", "slice"])

    return texts.select("id", "text").mapInArrow(run, "anchor long, id long, start long, n long, slice string")


def run_hashes(slices: list[str], n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of the slices, with the number of the slice and of the run in it."""
    codes, offsets = cp.explode(slices)
    own = np.repeat(np.arange(len(n)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = offsets[:-1][own] + inner
    return cp.span_hashes(cp.prefix_sums(codes), begin, begin + least), own, inner


def _cold(rows: DataFrame, least: int) -> DataFrame:
    """(id, begin, end) shared by two ids among rows (anchor, id, start, n, slice); anchors are bounded, so a task holds only some at a time."""
    cap = 20_000

    def check(t: pa.Table) -> pa.RecordBatch:
        ids, start, n = (t.column(c).to_numpy() for c in ("id", "start", "n"))
        h, own, inner = run_hashes(t.column("slice").to_pylist(), n, least)
        h = cp.mix(h ^ cp.mix(t.column("anchor").to_numpy().view(np.uint64)[own]))
        doc = ids[own]
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True]) if len(h) else np.zeros(1, np.int64)
        many = doc[edge[:-1]] != doc[edge[1:] - 1] if len(h) else np.zeros(0, bool)
        shared = np.zeros(len(own), bool)
        shared[order] = np.repeat(many, np.diff(edge))
        own, inner = own[shared], inner[shared]
        head = np.r_[True, (own[1:] != own[:-1]) | (inner[1:] != inner[:-1] + 1)][: len(own)]
        first = np.flatnonzero(head)
        last = np.r_[first[1:], len(own)] - 1
        where = own[first]
        return pa.RecordBatch.from_arrays([pa.array(ids[where]), pa.array(start[where] + inner[first]), pa.array(start[where] + inner[last] + least)], names=["id", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= cap:
                whole = pa.Table.from_batches(held).combine_chunks()
                anchors = whole.column("anchor").to_numpy()
                last = int(np.searchsorted(anchors, anchors[-1]))  # the last anchor may go on in the next batch
                if last:
                    yield check(whole.slice(0, last).combine_chunks())
                held = whole.slice(last).combine_chunks().to_batches()
                size = sum(b.num_rows for b in held)
        if held:
            yield check(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "id long, begin long, end long")


def _hot(rows: DataFrame, least: int) -> DataFrame:
    """The same for anchors of any number of segments: runs are counted by hash, map side first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 5000):
                batch = whole.slice(k, 5000)
                ids, start, anchor = (batch.column(c).to_numpy() for c in ("id", "start", "anchor"))
                h, own, inner = run_hashes(batch.column("slice").to_pylist(), batch.column("n").to_numpy(), least)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[own]), pa.array(h.view(np.int64)), pa.array(ids[own]), pa.array(start[own] + inner)], names=["anchor", "h", "id", "begin"])

    runs = rows.mapInArrow(run, "anchor long, h long, id long, begin long")
    many = runs.groupBy("anchor", "h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select("anchor", "h")
    return runs.join(many, ["anchor", "h"], "left_semi").select("id", "begin", (F.col("begin") + least).alias("end"))


def merged(intervals: DataFrame) -> DataFrame:
    """Overlapping and touching intervals (id, begin, end) joined to maximal ones."""
    order = Window.partitionBy("id").orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("begin") > before), 1).otherwise(0)
    numbered = intervals.withColumn("_new", new).withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("id", "_island").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("_island")


def shared_spans(rows: DataFrame, least: int = MIN, k: int = K, hot: int = HOT) -> DataFrame:
    """(id, begin, end) of rows (id, text): the maximal stretches of code points in runs of at least ``least`` that another id has as well."""
    texts = rows.where((F.length("text") >= least) & F.col("id").isNotNull()).select("id", "text", F.unhex(F.md5(F.encode("text", "utf-8"))).alias("h"))
    keys = keep(texts.select("id", "h", F.length("text").cast("long").alias("size")))
    classes = keys.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi")
    copies = keep(keys.join(small(classes.select("h", "lo")), "h").select("id", "h", "lo", F.lit(0).cast("long").alias("begin"), F.col("size").alias("end")).distinct())
    # one text of a class goes on; ids alone are moved to leave the others out
    reps = texts.join(small(copies.where("id != lo").select("id", "h")), ["id", "h"], "left_anti").select("id", "text")
    shared = keep(anchors(reps, least, k).groupBy("anchor").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("many").alias("many")).where("lo != hi").select("anchor", "many"), now=True)
    parts = segments(reps, bitmap(shared, "anchor", shared.count()), least, k)
    large = small(shared.where(F.col("many") > hot).select("anchor"))
    hot_parts = parts.join(large, "anchor", "left_semi")
    found = _cold(parts.join(large, "anchor", "left_anti"), least)
    if not large.isEmpty():
        found = found.unionByName(_hot(hot_parts, least))
    copies = copies.select("id", "begin", "end")
    return merged(found.unionByName(copies))


# ---------------------------------------------------------------- queries


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("id"), "text")


def _size(c: str) -> Column:
    return F.coalesce(F.length(c), F.lit(0))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, span_start, span_end) as TESTDATA.md states problem 9."""
    return shared_spans(_documents(spark, folder)).select(F.col("id").alias("doc_id"), F.col("begin").alias("span_start"), F.col("end").alias("span_end"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, size, spans, shared, share): how much of every document is shared elsewhere."""
    rows = _documents(spark, folder)
    sums = shared_spans(rows).groupBy("id").agg(F.count(F.lit(1)).alias("spans"), F.sum(F.col("end") - F.col("begin")).alias("shared"))
    out = rows.select("id", _size("text").alias("size")).join(sums, "id", "left")
    shared = F.coalesce("shared", F.lit(0))
    return out.select(F.col("id").alias("doc_id"), "size", F.coalesce("spans", F.lit(0)).alias("spans"), shared.alias("shared"), F.when(F.col("size") > 0, shared / F.col("size")).otherwise(0.0).alias("share"))
