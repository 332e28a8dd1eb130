"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import cut, spread, table

#: The tables whose texts the record-level operators take, with their keys and text columns.
TEXT_TABLES = (("clean_items", "id", "content"), ("documents", "doc_id", "text"))


def text_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(tb, id, text) of every text table; tb is the position in TEXT_TABLES."""
    parts = [
        spread(table(spark, folder, name).select(F.lit(k).cast("tinyint").alias("tb"), F.col(key).cast("long").alias("id"), F.col(text).alias("text")))
        for k, (name, key, text) in enumerate(TEXT_TABLES)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_name(tb: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, (name, _, _) in enumerate(TEXT_TABLES):
        out = F.when(tb == k, F.lit(name)).otherwise(out)
    return out


def keep(df: DataFrame, now: bool = False) -> DataFrame:
    """df kept for several readers; what a lost executor held is computed again from its lineage.

    With ``now`` it is filled at once: readers that start together would else
    each compute the parts that no other has finished yet.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if now:
        df.count()
    return df


def binary_rows(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow binary column of the rows of a flat numpy array."""
    width = flat.dtype.itemsize
    if len(flat) * width >= 1 << 31:
        raw = flat.tobytes()
        return pa.array([raw[a * width : b * width] for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * width).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])


def binary_values(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The flat numpy array of a binary column and its row offsets."""
    parts = column.to_pylist()
    sizes = [len(x or b"") for x in parts]
    return np.frombuffer(b"".join(x or b"" for x in parts), kind), np.r_[0, np.cumsum(sizes)].astype(np.int64) // np.dtype(kind).itemsize


def pair_overlaps(a: pa.Array, b: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of both sets and of what they share, of each row of two columns of sets."""
    x, xo = binary_values(a, kind)
    y, yo = binary_values(b, kind)
    nx, ny = np.diff(xo), np.diff(yo)
    rows = np.r_[np.repeat(np.arange(len(nx)), nx), np.repeat(np.arange(len(ny)), ny)]
    values = np.r_[x, y]
    side = np.r_[np.zeros(len(x), bool), np.ones(len(y), bool)]
    order = np.lexsort((side, values, rows))
    rows, values, side = rows[order], values[order], side[order]
    new = np.r_[True, (rows[1:] != rows[:-1]) | (values[1:] != values[:-1]) | (side[1:] != side[:-1])][: len(rows)]  # a value that a set repeats counts once
    rows, values, side = rows[new], values[new], side[new]
    same = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
    n = len(nx)
    return np.bincount(rows[~side], minlength=n), np.bincount(rows[side], minlength=n), np.bincount(rows[1:][same], minlength=n)


BITMAP = 1 << 27  # bits of a broadcast bitmap at most: 16 MB
_BLOCK = 1 << 13  # bytes of a row of it


def bitmap(values: DataFrame, column: str, count: int) -> np.ndarray:
    """Bits (as bytes) of the hashes in a long column: bit h mod size is set for every hash h.

    Eight bits for each of ``count`` values, but BITMAP at most, so it may be
    broadcast whatever the data's size; with more values it lets more through
    and stays right, as whoever asks it checks exactly afterwards.  Tasks OR
    their bits and send the blocks that hold any.
    """
    size = min(BITMAP, 1 << max(16, int(8 * max(count, 1)).bit_length()))
    block = min(_BLOCK, size // 8)

    def sent(rows: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int32)), pa.array([r.tobytes() for r in rows], pa.binary())], names=["block", "bits"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = None
        for batch in batches:
            flags = np.zeros(size, bool) if flags is None else flags
            flags[batch.column(0).to_numpy().view(np.uint64) % np.uint64(size)] = True
        if flags is not None:
            rows = np.packbits(flags, bitorder="little").reshape(-1, block)
            used = np.flatnonzero(rows.any(1))
            yield sent(rows[used], used)

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist()):
                bits = np.frombuffer(raw, np.uint8)
                sums[k] = sums[k] | bits if k in sums else bits
        if sums:
            yield sent(np.stack(list(sums.values())), np.array(list(sums)))

    kind = "block int, bits binary"
    got = values.select(column).mapInArrow(mark, kind).repartition("block").mapInArrow(union, kind).toArrow()
    out = np.zeros((size // 8 // block, block), np.uint8)
    for k, raw in zip(got.column("block").to_pylist(), got.column("bits").to_pylist()):
        out[k] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1)


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of some unsigned hashes have their bit set."""
    at = values % np.uint64(len(bits) * 8)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def small(df: DataFrame, limit: int = 250_000) -> DataFrame:
    """df kept, and marked for broadcast if it has at most ``limit`` rows (of a few numbers each); else it is joined by shuffle."""
    df = keep(df)
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def verified(pairs: DataFrame, sets: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Pairs (a, b) whose sets have at least this similarity, with both sizes and what they share.

    ``sets`` has the columns id and grams (binary; values may repeat); an id
    may come more than once with the same set.  Only the sets that some pair
    needs are moved.
    """
    need = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    held = keep(sets.select("id", "grams").join(small(need), "id", "left_semi").dropDuplicates(["id"]))
    both = pairs.join(held.select(F.col("id").alias("a"), F.col("grams").alias("grams_a")), "a").join(held.select(F.col("id").alias("b"), F.col("grams").alias("grams_b")), "b")
    part = 1000

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, part):
                batch = whole.slice(k, part)
                nx, ny, shared = pair_overlaps(batch.column("grams_a"), batch.column("grams_b"), np.dtype(kind))
                good = (shared >= threshold * (nx + ny - shared) - 1e-9) & (shared > 0)
                mask = pa.array(good)
                columns = [batch.column(n).filter(mask) for n in ("a", "b")]
                columns += [pa.array(v[good].astype(np.int32)) for v in (nx, ny, shared)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "size_a", "size_b", "shared"])

    return both.select("a", "b", "grams_a", "grams_b").mapInArrow(check, "a long, b long, size_a int, size_b int, shared int")


def expanded(links: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of records (id_a < id_b) from links (a, b) between classes, with the other columns of members.

    ``members`` has rep, id and columns that are equal for all members of
    linked classes; a = b stands for the copies within one class.  The pairs
    are the result itself, so none can be left out; adaptive execution splits
    skewed classes.
    """
    extra = [c for c in members.columns if c not in ("rep", "id")]
    left = members.withColumnsRenamed({"rep": "a", "id": "x"}).join(small(links.select("a", "b")), "a")
    both = left.join(members.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b")
    both = both.where(((F.col("a") != F.col("b")) | (F.col("x") < F.col("y"))) & (F.col("x") != F.col("y")))
    return both.select(*extra, F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()  # rows may be repeated in the table


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of links (a, b): one row (id, component) per linked id, component the smallest id.

    Each round every id takes the least label among itself and its
    neighbours, then the label of its label (pointer jumping), so the rounds
    grow with the logarithm of the longest chain.  Every round is cut off in
    the shared checkpoint folder; only a flag reaches the driver.
    """
    edges = cut(links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other"))).distinct())
    labels = cut(edges.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")))
    for _ in range(rounds):
        seen = edges.join(labels.select(F.col("id").alias("other"), F.col("component").alias("theirs")), "other")
        least = seen.groupBy("id").agg(F.min("theirs").alias("theirs"))
        step = labels.join(least, "id", "left").select("id", F.col("component").alias("was"), F.least("component", "theirs").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        new = cut(step.join(jump, "component", "left").select("id", "was", F.least(F.col("component"), F.coalesce("further", "component")).alias("component")))
        labels = new.select("id", "component")
        if new.where("component != was").isEmpty():
            return labels
    raise RuntimeError("the components did not settle")


def prefix_by_hash(rows: DataFrame, leaf: list[str], quotas: DataFrame, key: Column, weight: str, per_bucket: int = 2000) -> DataFrame:
    """The rows of each leaf that come first in the order of ``key`` until ``quota`` is used up.

    ``quotas`` has leaf..., quota.  A leaf may hold a third of all rows, so no
    task sorts one: weights are summed by (leaf, bucket of the key's range),
    the running sum goes over buckets only, and just the bucket in which the
    quota ends is ranked by row.  There are as many buckets as bring
    ``per_bucket`` rows of the largest leaf into one, however many rows there
    are.  A row is taken if the weights before it leave room for all of its
    own (``weight`` 0 is taken while room is left).
    """
    from pyspark.sql import Window

    most = rows.groupBy(*leaf).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("n")).first()["n"] or 0
    buckets = max(16, -(-most // per_bucket))
    marked = rows.withColumn("_k", key).withColumn("_bucket", F.floor((F.col("_k").cast("double") / 18446744073709551616.0 + 0.5) * buckets))
    sums = marked.groupBy(*leaf, "_bucket").agg(F.sum(weight).alias("_sum"))
    running = Window.partitionBy(*leaf).orderBy("_bucket")
    sums = sums.join(quotas, leaf).withColumn("_before", F.sum("_sum").over(running) - F.col("_sum"))
    sums = sums.where("_before < quota").select(*leaf, "_bucket", "_before", "_sum", "quota")
    hit = marked.join(sums, [*leaf, "_bucket"])
    whole = hit.where(F.col("_before") + F.col("_sum") <= F.col("quota"))
    within = Window.partitionBy(*leaf, "_bucket").orderBy("_k", *[c for c in rows.columns if c not in leaf][:1])
    edge = hit.where(F.col("_before") + F.col("_sum") > F.col("quota")).withColumn("_upto", F.col("_before") + F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    edge = edge.where("_upto <= quota").drop("_upto")
    return whole.unionByName(edge).drop("_k", "_bucket", "_before", "_sum", "quota")
