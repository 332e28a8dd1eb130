"""Problem 2: evaluation records that occur, the same or nearly, in training.

Word n-gram hashes of the evaluation records are broadcast as a bitmap of
bounded size (with more hashes than it has room for it only lets more through,
and the hashes are partitioned), and the training records are scanned against
it:

1. Every evaluation hash is counted over all training records, exactly and
   with partial aggregation.
2. A training record that holds the share c of an evaluation record's hashes
   holds k of any |e| - ceil(c |e|) + k of them, so only so many of each, the
   rarest in training, are looked for: what a third of all records share joins
   nothing, and no pair is lost.  k is a part (WANTED) of |e|.
3. A second scan gives the training records that hold any of these; hashes in
   more than SALT records are split into parts; pairs are counted, and those
   with k of them go on.
4. Containment of the evaluation record in the training record is computed for
   every pair from the whole sets; pairs of at least c go on.  Similarity is
   looked at after that: similar records contain each other at least as much.

Records with the same words are one class and stand in by their least id.

Defined results: null messages, null or empty contents and records of fewer
than min_words words are in no pair; a split that is neither train nor
validation nor test is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import codepoints as cp
from quern.llm.common import binary_rows, binary_values, bitmap, expanded, in_bitmap, keep, pair_overlaps, small
from quern.session import cut, sized, spread, table

WANTED = 0.06  # share of an evaluation record's hashes that a partner must hold of its rarest
SALT = 4096  # training records of one part of a hash


def dialogue(messages: Column) -> Column:
    """The non-empty contents of user and assistant messages, in order, joined by a blank; null if there are no messages."""
    said = F.filter(messages, lambda m: m["role"].isin("user", "assistant") & (F.length(m["content"]) > 0))
    return F.array_join(F.transform(said, lambda m: m["content"]), " ")


def gram_rows(rows: DataFrame, n: int = 3, min_words: int = 20) -> DataFrame:
    """(held, id, d1, d2, grams) of (held, id, text): sorted 64-bit hashes of each record's n-word runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, held, ids = batch.column("text").to_pylist(), batch.column("held").to_numpy(zero_copy_only=False), batch.column("id").to_numpy()
            for a, b in cp.slices(texts):
                flat, offsets, n_words, digest = cp.gram_sets(texts[a:b], n)
                good = (n_words >= min_words) & (np.diff(offsets) > 0)
                flat, _ = cp._keep(flat, offsets, np.repeat(good, np.diff(offsets)))
                offsets = np.r_[0, np.cumsum(np.diff(offsets)[good])].astype(np.int64)
                d2 = cp.row_digest(flat, offsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held[a:b][good]), pa.array(ids[a:b][good]), pa.array(digest[good].view(np.int64)), pa.array(d2.view(np.int64)), binary_rows(flat, offsets)],
                    names=["held", "id", "d1", "d2", "grams"],
                )

    return rows.where("text is not null and id is not null and held is not null").select("held", "id", "text").mapInArrow(run, "held boolean, id long, d1 long, d2 long, grams binary")


def gram_lists(sets: DataFrame, out: str) -> DataFrame:
    """(gram, out) of sets (id, grams): each hash of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                flat, offsets = binary_values(batch.column("grams"), np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(np.repeat(batch.column("id").to_numpy(), np.diff(offsets)))], names=["gram", out])

    return sets.select("id", "grams").mapInArrow(run, f"gram long, {out} long")


def scanned(sets: DataFrame, bits: np.ndarray, out: str) -> DataFrame:
    """(gram, out) of sets (id, grams): their hashes that are in the bitmap."""
    held = sets.sparkSession.sparkContext.broadcast(bits)  # of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                flat, offsets = binary_values(batch.column("grams"), np.uint64)
                some = in_bitmap(held.value, flat)
                yield pa.RecordBatch.from_arrays([pa.array(flat[some].view(np.int64)), pa.array(np.repeat(batch.column("id").to_numpy(), np.diff(offsets))[some])], names=["gram", out])

    return sets.select("id", "grams").mapInArrow(run, f"gram long, {out} long")


def counted(sets: DataFrame, bits: np.ndarray) -> DataFrame:
    """(gram, n): in how many of the sets each hash in the bitmap stands; counted exactly, by batch before anything is moved."""
    held = sets.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        size = 0

        def sent() -> pa.RecordBatch:
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

        for batch in batches:
            flat, _ = binary_values(batch.column("grams"), np.uint64)
            parts.append(flat[in_bitmap(held.value, flat)])
            size += len(parts[-1])
            if size >= 1 << 21:
                yield sent()
                parts, size = [], 0
        if parts:
            yield sent()

    return sets.select("grams").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def looked_for(evaluation: DataFrame, training: DataFrame, least: float, wanted: float = WANTED) -> tuple[DataFrame, DataFrame]:
    """(gram, a, n, k) to look for, of sets (id, grams): the rarest hashes of each evaluation record, so many that each training record with ``least`` of all has k of them; and the training sets' (gram, b) that match.

    n is the number of training records with the hash; hashes in none are not looked for.
    """
    grams = keep(gram_lists(evaluation, "a"), now=True)
    many = grams.count()
    counts = counted(training, bitmap(grams, "gram", many))
    order = Window.partitionBy("a").orderBy("_n", "gram")  # the hashes of one record
    ranked = grams.join(counts, "gram", "left").select("a", "gram", F.coalesce("n", F.lit(0)).alias("_n"))
    ranked = ranked.withColumn("_place", F.row_number().over(order)).withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("a")))
    ranked = ranked.withColumn("_least", F.ceil(F.col("_size") * least - 1e-9)).withColumn("k", F.least(F.col("_least"), F.ceil(F.col("_size") * wanted)).cast("int"))
    rare = ranked.where((F.col("_n") > 0) & (F.col("_place") <= F.col("_size") - F.col("_least") + F.col("k")))
    with sized(grams.sparkSession, many):
        rare = cut(rare.select("gram", "a", F.col("_n").alias("n"), "k"))
    grams.unpersist()
    return rare, scanned(training, bitmap(rare, "gram", rare.count()), "b")


def met(rare: DataFrame, hits: DataFrame, salt: int = SALT) -> DataFrame:
    """Pairs (a, b) that share k hashes looked for, once each.  The records of a hash in more than ``salt`` of them are dealt to parts, each of which meets the evaluation records of the hash."""
    parts = F.ceil(F.col("n") / salt).cast("int")
    large = small(rare.where(parts > 1).select("gram", parts.alias("_parts")).distinct())
    dealt = hits.join(large, "gram", "left").select("gram", "b", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("b"), F.col("_parts"))).cast("int").alias("_part"))
    asked = rare.select("gram", "a", "k", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    shared = asked.join(dealt, ["gram", "_part"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n"), F.max("k").alias("k"))
    with sized(rare.sparkSession, rare.agg(F.sum("n")).first()[0] or 0):
        return cut(shared.where("_n >= k").select("a", "b"))


def contained(pairs: DataFrame, evaluation: DataFrame, training: DataFrame, least: float) -> DataFrame:
    """(a, b, size_a, size_b, shared) of the pairs whose evaluation record a is contained in b by at least this share."""
    ours = evaluation.join(small(pairs.select(F.col("a").alias("id")).distinct()), "id", "left_semi").select(F.col("id").alias("a"), F.col("grams").alias("grams_a"))
    theirs = training.join(small(pairs.select(F.col("b").alias("id")).distinct()), "id", "left_semi").select(F.col("id").alias("b"), F.col("grams").alias("grams_b"))
    part = 1000

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, part):
                batch = whole.slice(k, part)
                nx, ny, shared = pair_overlaps(batch.column("grams_a"), batch.column("grams_b"), np.dtype("<u8"))
                good = (shared >= least * nx - 1e-9) & (shared > 0)
                mask = pa.array(good)
                columns = [batch.column(n).filter(mask) for n in ("a", "b")]
                columns += [pa.array(v[good].astype(np.int32)) for v in (nx, ny, shared)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "size_a", "size_b", "shared"])

    return pairs.join(ours, "a").join(theirs, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(check, "a long, b long, size_a int, size_b int, shared int")


def classes(rows: DataFrame, n: int = 3, min_words: int = 20) -> tuple[DataFrame, DataFrame]:
    """One set (id, held, grams) for all records of a side with the same words, of rows (held, id, text), and members (rep, id, held)."""
    sets = keep(gram_rows(rows, n, min_words), now=True)
    least = sets.groupBy("held", "d1", "d2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("_n"))
    members = cut(sets.select("held", "d1", "d2", "id").join(least, ["held", "d1", "d2"]).select("rep", "id", "held", "d1").distinct())
    copies = members.where("id != rep").select("held", "id", "d1")
    own = sets.join(small(copies), ["held", "id", "d1"], "left_anti")
    if not sets.groupBy("held", "id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():  # rows may be repeated in the table; only then are sets moved to leave them out
        own = own.dropDuplicates(["held", "id"])
    own = keep(own, now=True)
    sets.unpersist()
    return own, members.drop("d1")


def containments(rows: DataFrame, least: float = 0.6, n: int = 3, min_words: int = 20, salt: int = SALT) -> tuple[DataFrame, DataFrame]:
    """Links (a: evaluation, b: training, size_a, size_b, shared) of class representatives of rows (held, id, text) whose containment is ``least`` or more, and members (rep, id, held)."""
    sets, members = classes(rows, n, min_words)
    evaluation, training = sets.where("held"), sets.where("not held")
    rare, hits = looked_for(evaluation, training, least)
    return cut(contained(met(rare, hits, salt), evaluation, training, least)), members


def similar(links: DataFrame, threshold: float = 0.6) -> DataFrame:
    """The links whose similarity is at least threshold."""
    return links.where(F.col("shared") >= threshold * (F.col("size_a") + F.col("size_b") - F.col("shared")) - 1e-9)


def split_rows(conversation: DataFrame) -> DataFrame:
    """(held, id, text) of conversation; held: whether the record is for evaluation."""
    split = F.lower(F.trim("split"))
    held = F.when(split.isin("validation", "test"), True).when(split == "train", False)
    return conversation.select(held.alias("held"), F.col("entry_id").alias("id"), dialogue(F.col("messages")).alias("text"))


# ---------------------------------------------------------------- queries


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return split_rows(spread(table(spark, folder, "conversation").select("entry_id", "split", "messages")))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """(entry_a, entry_b) as TESTDATA.md states problem 2."""
    links, members = containments(_rows(spark, folder))
    return expanded(similar(links), members.select("rep", "id")).select(F.col("id_a").alias("entry_a"), F.col("id_b").alias("entry_b"))


def p2_links(spark: SparkSession, folder: str) -> DataFrame:
    """(entry_id, train_entry_id, containment, similarity) of every pair of class representatives of which the training record holds 0.6 of the evaluation record or more."""
    links, _ = containments(_rows(spark, folder))
    return links.select(F.col("a").alias("entry_id"), F.col("b").alias("train_entry_id"), (F.col("shared") / F.col("size_a")).alias("containment"), (F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))).alias("similarity"))


def p2_members(spark: SparkSession, folder: str) -> DataFrame:
    """(entry_id, held, rep): the class representative by which p2_links names each record; held: whether it is for evaluation."""
    _, members = classes(_rows(spark, folder))
    return members.select(F.col("id").alias("entry_id"), "held", "rep")


def p2_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """(split, source, entries, contained, leaked, exact, mean_containment): evaluation entries, how many of them a training entry holds by 0.6 or more, is similar to or equals, and their mean greatest containment, by split and tags.source."""
    conversation = table(spark, folder, "conversation")
    links, members = containments(split_rows(conversation))
    best = links.groupBy("a").agg(F.max(F.col("shared") / F.col("size_a")).alias("containment"), F.max(F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared"))).alias("similarity"))
    hit = members.where("held").join(best, F.col("rep") == F.col("a")).select(F.col("id").alias("entry_id"), "containment", "similarity")
    held = conversation.select("entry_id", F.lower(F.trim("split")).alias("split"), F.coalesce(F.lower(F.trim("tags.source")), F.lit("unknown")).alias("source")).where("split in ('validation', 'test')")
    return (
        held.join(hit, "entry_id", "left")
        .groupBy("split", "source")
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.count("containment").alias("contained"),
            F.count(F.when(F.col("similarity") >= 0.6 - 1e-9, 1)).alias("leaked"),
            F.count(F.when(F.col("similarity") >= 1, 1)).alias("exact"),
            F.avg("containment").alias("mean_containment"),
        )
    )
