"""Problem 3: records that differ from another only by small edits.

1. Every text gives its set of three-word runs (in one form, lower-cased),
   128 minwise hashes of them, and from each hash one bit: a 128-bit
   fingerprint in which two texts of similarity s differ in (1 - s) / 2 of
   the bits on average.
2. Texts with the same words are one class; a digest of the words stands for it.
3. Classes meet in buckets of three joint minwise hashes (28 of them; of
   pairs of similarity 0.6 one in 900 meets in none, of 0.65 one in 8,000, of
   0.7 one in 100,000).
4. In each bucket the binary trie of the fingerprints is joined with itself:
   pairs of nodes go down together, differing bits add up, and a pair of
   nodes is dropped once they exceed the error budget (44 of 128; of pairs of similarity 0.6 one in 20,000 has more).
5. What is left is compared exactly.

No bucket of more than HOT classes goes to one task: its trie is cut into
blocks of bounded size and every pair of blocks is joined on its own, which
loses nothing, so the pairs found do not depend on HOT.

Defined results: null, empty and short texts (under min_words) are in no pair;
in ``classes`` they are a class of their own with no links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import codepoints as cp
from quern.llm.common import binary_rows, components, expanded, keep, small, table_name, text_rows, verified
from quern.session import cut, sized

BITS = 128
BANDS, BAND = 28, 3
BUDGET = 44
HOT = 1 << 15
LEAF = 64  # pairs of nodes with at most so many pairs of fingerprints are compared at once


def multipliers(count: int = BITS, seed: int = 20) -> np.ndarray:
    """Odd multipliers of the minwise hashes."""
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minwise(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of BITS minwise hashes for every non-empty set (offsets must be strictly increasing)."""
    out = np.empty((BITS, len(offsets) - 1), np.uint64)
    for k, m in enumerate(multipliers()):
        out[k] = np.minimum.reduceat(grams * m, offsets[:-1])
    return out


def signatures(rows: DataFrame, grams: int = 3, min_words: int = 10, bands: int = BANDS, band: int = BAND) -> DataFrame:
    """(tb, id, d1, d2, f1, f2, keys, grams) of (tb, id, text) with at least min_words words.

    d1 is a digest of the table and the words and names the class, d2 another
    of the runs; grams has the upper halves of the runs' hashes in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, tb, ids = batch.column("text").to_pylist(), batch.column("tb").to_numpy(), batch.column("id").to_numpy()
            for a, b in cp.slices(texts):
                flat, offsets, n_words, digest = cp.gram_rows(texts[a:b], grams)
                good = (n_words >= min_words) & (np.diff(offsets) > 0)
                if not good.any():
                    continue
                flat, offsets = cp._keep(flat, offsets, np.repeat(good, np.diff(offsets)))
                offsets = np.r_[offsets[:-1][good], offsets[-1]]
                own = tb[a:b][good].astype(np.uint64) + np.uint64(1)
                least = minwise(flat, offsets)
                bit = (cp.mix(least) >> np.uint64(17)) & np.uint64(1)
                place = np.arange(64, dtype=np.uint64)[::-1, None]
                f1, f2 = ((bit[k : k + 64] << place).sum(0, dtype=np.uint64) for k in (0, 64))
                keys = np.empty((least.shape[1], bands), np.uint64)
                for k in range(bands):
                    h = own + np.uint64(1000 * k)
                    for j in range(band):
                        h = cp.mix(h * np.uint64(0x9E3779B97F4A7C15) ^ least[k * band + j])
                    keys[:, k] = h
                long = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tb[a:b][good]), pa.array(ids[a:b][good]),
                        long(cp.mix(digest[good] ^ cp.mix(own))), long(cp.row_digest(flat, offsets)), long(f1), long(f2),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), long(keys.ravel())),
                        binary_rows((flat >> np.uint64(32)).astype(np.uint32), offsets),
                    ],
                    names=["tb", "id", "d1", "d2", "f1", "f2", "keys", "grams"],
                )

    return rows.where("text is not null and id is not null").mapInArrow(run, "tb tinyint, id long, d1 long, d2 long, f1 long, f2 long, keys array<long>, grams binary")


# ---------------------------------------------------------------- trie


def trie_pairs(key: np.ndarray, f1: np.ndarray, f2: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of rows with the same key whose fingerprints differ in at most budget bits.

    The rows must be sorted by (key, f1, f2), unsigned: a node of a bucket's
    trie is then a range of rows, its halves by the next bit follow from the
    running count of that bit, and all buckets go down level by level at once.
    """
    n = len(key)
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if n else np.zeros(1, np.int64)
    lo, hi = edge[:-1], edge[1:]
    some = hi - lo > 1
    front = np.stack([lo[some], hi[some], lo[some], hi[some], np.zeros(some.sum(), np.int64)])
    found: list[np.ndarray] = []

    def compare(nodes: np.ndarray) -> None:
        step = max(1, (1 << 20) // (LEAF * 4))
        for k in range(0, nodes.shape[1], step):
            a0, a1, b0, b1, _ = nodes[:, k : k + step]
            wide, many = b1 - b0, (a1 - a0) * (b1 - b0)
            own = np.repeat(np.arange(len(many)), many)
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            i, j = a0[own] + inner // wide[own], b0[own] + inner % wide[own]
            apart = np.bitwise_count(f1[i] ^ f1[j]).astype(np.int64) + np.bitwise_count(f2[i] ^ f2[j])
            good = (i < j) & (apart <= budget)
            found.append(np.stack([i[good], j[good]]))

    for depth in range(BITS + 1):
        if not front.shape[1]:
            break
        small = ((front[1] - front[0]) * (front[3] - front[2]) <= LEAF) | (depth == BITS)
        if small.any():
            tiny = front[:, small]
            if depth == BITS:  # equal fingerprints in bulk: compare by rows, so the work at once is bounded
                for k in range(tiny.shape[1]):
                    a0, a1, b0, b1, e = tiny[:, k]
                    for i in range(a0, a1):
                        compare(np.array([[i], [i + 1], [b0], [b1], [e]]))
            else:
                compare(tiny)
        front = front[:, ~small]
        if not front.shape[1]:
            break
        word, shift = (f1, 63 - depth) if depth < 64 else (f2, 127 - depth)
        ones = np.zeros(n + 1, np.int64)
        np.cumsum((word >> np.uint64(shift)) & np.uint64(1), out=ones[1:])
        a0, a1, b0, b1, err = front
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        self_pair = a0 == b0
        down = [
            np.stack([a0, am, b0, bm, err]),
            np.stack([am, a1, bm, b1, err]),
            np.stack([a0, am, bm, b1, err + 1]),
            np.stack([am, a1, b0, bm, err + 1])[:, ~self_pair],
        ]
        front = np.concatenate(down, axis=1)
        front = front[:, (front[1] > front[0]) & (front[3] > front[2]) & (front[4] <= budget)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = np.concatenate(found, axis=1)
    return i, j


def _join_buckets(rows: DataFrame, budget: int, blocks: bool = False) -> DataFrame:
    """Candidate pairs (a, b) of rows (key, d1, f1, f2), each bucket bounded; with blocks, only across or within the blocks a key names."""
    cap = 1 << 17

    def pairs(table: pa.Table) -> pa.RecordBatch:
        key, f1, f2 = (table.column(c).to_numpy().view(np.uint64) for c in ("key", "f1", "f2"))
        ids = table.column("d1").to_numpy()
        order = np.lexsort((f2, f1, key))
        key, f1, f2, ids = key[order], f1[order], f2[order], ids[order]
        i, j = trie_pairs(key, f1, f2, budget)
        good = ids[i] != ids[j]
        if blocks:
            side, lone = (table.column(c).to_numpy(zero_copy_only=False).astype(bool)[order] for c in ("side", "lone"))
            good &= lone[i] | (side[i] != side[j])
        i, j = i[good], j[good]
        new = np.unique(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])]), axis=1) if len(i) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(new[0]), pa.array(new[1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= cap:
                whole = pa.Table.from_batches(held).combine_chunks()
                key = whole.column("key").to_numpy()
                last = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
                if last:
                    yield pairs(whole.slice(0, last).combine_chunks())
                held = whole.slice(last).combine_chunks().to_batches()
                size = sum(b.num_rows for b in held)
        if held:
            yield pairs(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _in_blocks(large: DataFrame, budget: int, hot: int) -> DataFrame:
    """Rows (key, d1, f1, f2, n) of buckets of more than hot classes as rows of pairs of blocks, for ``_join_buckets``.

    A block is a node of the bucket's trie: the fingerprints that begin with
    the same bits, of which so many are taken that a node holds hot of them on
    average; a node that holds more is dealt to parts.  Each pair of blocks
    whose beginnings are within the budget is a bucket of its own, so a row
    goes to no more than n / hot of them (some more where nodes are uneven)
    and no task holds more than two blocks.
    """
    bits = F.least(F.ceil(F.log2(F.col("n") / F.lit(float(hot)))) + 1, F.lit(30)).cast("int")
    large = large.withColumn("node", F.call_function("shiftrightunsigned", F.col("f1"), F.lit(64) - bits))
    nodes = large.groupBy("key", "node").agg(F.ceil(F.count(F.lit(1)) / F.lit(hot)).cast("int").alias("parts"))
    blocks = nodes.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node")
    lists = blocks.groupBy("key").agg(F.collect_list(F.struct("node", "part")).alias("blocks"))  # n / hot of them
    placed = large.join(small(nodes), ["key", "node"]).join(small(lists), "key")
    own = F.struct(F.col("node"), F.pmod(F.xxhash64("d1"), F.col("parts")).cast("int").alias("part"))
    placed = placed.select("key", "d1", "f1", "f2", own.alias("own"), "blocks")
    met = placed.select("key", "d1", "f1", "f2", "own", F.explode(F.filter("blocks", lambda x: F.bit_count(x["node"].bitwiseXOR(F.col("own.node"))) <= budget)).alias("other"))
    return met.select("d1", "f1", "f2", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), (F.col("own") < F.col("other")).alias("side"), (F.col("own") == F.col("other")).alias("lone"))


def candidates(sig: DataFrame, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """Distinct candidate pairs (a, b) of the classes of signatures (d1, f1, f2, keys).

    Buckets are sized by pre-aggregation and joined back, which adaptive
    execution splits where a key is skewed; buckets of one class end there.
    """
    classes = keep(sig.dropDuplicates(["d1"]))  # copies end here, so buckets are sized by classes
    prints = classes.select("d1", "f1", "f2")
    exploded = classes.select("d1", F.explode("keys").alias("key"))
    with sized(sig.sparkSession, classes.agg(F.sum(F.size("keys"))).first()[0] or 0):
        buckets = cut(exploded.join(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key"))
        found = _join_buckets(buckets.where(F.col("n") <= hot).join(prints, "d1"), budget)
        large = buckets.where(F.col("n") > hot)
        if not large.isEmpty():
            found = found.unionByName(_join_buckets(_in_blocks(large.join(prints, "d1"), budget, hot), budget, blocks=True))
        found = cut(found.distinct())
    classes.unpersist()
    return found


def linked(rows: DataFrame, threshold: float = 0.6, grams: int = 3, min_words: int = 10, budget: int = BUDGET, hot: int = HOT, bands: int = BANDS, band: int = BAND) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, size_a, size_b, shared) between the classes of rows (tb, id, text), and members (rep, tb, id, d2)."""
    sig = keep(signatures(rows, grams, min_words, bands, band), now=True)
    pairs = candidates(sig.select("d1", "f1", "f2", "keys"), budget, hot)
    links = verified(pairs, sig.select(F.col("d1").alias("id"), "grams"), threshold, "<u4")
    return links, sig.select(F.col("d1").alias("rep"), "tb", "id", "d2")


# ---------------------------------------------------------------- queries


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, id_a, id_b) as TESTDATA.md states problem 3."""
    links, members = linked(text_rows(spark, folder))
    copies = members.groupBy("rep", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    found = expanded(links.select("a", "b").unionByName(copies), members.select("rep", "tb", "id"))
    return found.select(table_name(F.col("tb")).alias("table_name"), "id_a", "id_b")


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, id, class_id, group_id, copies, links): every record with its class of equal words, its group of near-duplicates and the links of its class.

    class_id and group_id are the least ids in them.
    """
    rows = text_rows(spark, folder)
    links, members = linked(rows)
    links = keep(links.select("a", "b"))
    classes = keep(members.groupBy("rep").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies")))
    degree = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    group = components(links).join(classes.select(F.col("rep").alias("id"), "class_id"), "id")
    least = group.groupBy("component").agg(F.min("class_id").alias("group_id"))
    group = group.select(F.col("id").alias("rep"), "component").join(least, "component").drop("component")
    known = classes.join(degree, "rep", "left").join(group, "rep", "left")
    out = rows.select("tb", "id").join(members.select("rep", "tb", "id").dropDuplicates(["tb", "id"]).join(known, "rep"), ["tb", "id"], "left")
    class_id = F.coalesce("class_id", "id")
    return out.select(
        table_name(F.col("tb")).alias("table_name"), "id", class_id.alias("class_id"), F.coalesce("group_id", class_id).alias("group_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"),
    )
