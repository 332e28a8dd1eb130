"""Duplicate removal within the core pipeline.

``exact`` keeps one row of each equal text.  ``lsh`` is banded MinHash over
character shingles: ``keep_first`` removes a record if a bucket-mate of some
record comes before it (unverified candidates, as the reference semantics
have it).

Scale: texts that are equal are collapsed before shingling; signatures are
computed in one Arrow pass (one hash per shingle, then the permutations as
array operations); what is shuffled is a row per band and record.  Rows of one
bucket are never brought together: the two-hop rule only needs minima, which
are aggregated map side.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import let

PRIME = 2147483647
PERMUTATIONS = 128


@functools.cache
def band_shape(threshold: float, permutations: int = PERMUTATIONS) -> tuple[int, int]:
    """(bands, rows) of at most so many permutations for which the mean of both error areas is least: of pairs below the threshold that share a band, and of pairs above it that share none."""
    if not 0 < threshold <= 1 or permutations < 1:
        raise ValueError("the threshold must be in (0, 1], and there must be permutations")
    step = 0.001
    x = np.arange(step / 2, 1, step)
    below = x < threshold

    def error(b: int, r: int) -> float:
        met = 1 - (1 - x**r) ** b
        return float((met[below].sum() + (1 - met[~below]).sum()) * step / 2)

    return min(((b, r) for b in range(1, permutations + 1) for r in range(1, permutations // b + 1)), key=lambda s: (error(*s), s))


def coefficients(count: int = PERMUTATIONS, seed: int = 1) -> list[tuple[int, int]]:
    """Well-mixed (a, b) of the permutations (a * x + b) mod PRIME; stated by a rule, so SQL can have the same."""
    rng = np.random.default_rng(seed)
    return [(int(a), int(b)) for a, b in zip(rng.integers(1, PRIME, count), rng.integers(0, PRIME, count))]


def shingles(text: Column, k: int = 3) -> Column:
    """The distinct runs of k characters of a lower-cased, trimmed text; a shorter text is its own only one."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))

    def runs(chars: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(chars) - k)
        return F.array_distinct(F.transform(at, lambda i: F.concat(*[F.get(chars, i + j) for j in range(k)])))

    return F.when(F.length(low) < k, F.array(low)).otherwise(let(F.split(low, ""), runs))


def minhash(text: Column, k: int = 3, count: int = PERMUTATIONS) -> Column:
    """The MinHash signature of a text's shingles: the least of each permutation over 28-bit prefixes of their md5, which any SQL engine can give too."""
    pairs = np.array(coefficients(count), np.int64)

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        for s in batches:
            if len(known) > 500_000:
                known.clear()
            yield s.map(lambda t: _signature(_hashes(t or "", k, known), pairs).tolist())

    return run(F.lower(F.trim(F.coalesce(text, F.lit("")))))


def _hashes(text: str, k: int, known: dict[str, int]) -> np.ndarray:
    """The hashes of a text's distinct shingles; ``known`` keeps those of frequent ones."""
    parts = {text[i : i + k] for i in range(len(text) - k + 1)} if len(text) >= k else {text}
    out = np.empty(len(parts), np.int64)
    for i, s in enumerate(parts):
        h = known.get(s)
        if h is None:
            h = known[s] = int(hashlib.md5(s.encode()).hexdigest()[:7], 16)
        out[i] = h
    return out


def _signature(h: np.ndarray, pairs: np.ndarray, step: int = 20_000) -> np.ndarray:
    """In blocks of shingles, so a very long text takes no more memory than a block."""
    out = np.full(len(pairs), PRIME, np.int64)
    for k in range(0, len(h), step):
        part = h[k : k + step].astype(np.uint64)
        a, b = pairs[:, :1].astype(np.uint64), pairs[:, 1:].astype(np.uint64)
        out = np.minimum(out, ((a * part + b) % np.uint64(PRIME)).min(1).astype(np.int64))
    return out


def bands(signature: Column, threshold: float = 0.8, permutations: int = PERMUTATIONS) -> Column:
    """array<struct<band, key>> of a signature of as many permutations as the bands take: the rows of each band joined."""
    b, r = band_shape(threshold, permutations)
    return F.array(*[F.struct(F.lit(k).alias("band"), F.array_join(F.slice(signature, k * r + 1, r).cast("array<string>"), ",").alias("key")) for k in range(b)])


def band_rows(df: DataFrame, key: str, text: str, threshold: float = 0.8, k: int = 3, permutations: int = PERMUTATIONS) -> DataFrame:
    """(id, band, key) of every record, the band's key as a 16-byte digest."""
    b, r = band_shape(threshold, permutations)
    sig = df.select(F.col(key).alias("id"), minhash(F.col(text), k, b * r).alias("s"))
    return sig.select("id", F.explode(bands(F.col("s"), threshold, permutations)).alias("b")).select("id", "b.band", F.md5(F.col("b.key").cast("binary")).alias("key"))


def exact(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row of each text (lower-cased and trimmed; null is ''), that with the least key.

    Only (digest, key) is shuffled and pre-aggregated, not the rows' windows;
    the rows are then picked by a semi join on their key.
    """
    return df.join(first_keys(df, key, text), key, "left_semi")


def first_keys(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key) of the rows that ``exact`` keeps."""
    digest = F.md5(F.lower(F.trim(F.coalesce(F.col(text), F.lit("")))).cast("binary"))
    return df.select(digest.alias("_d"), F.col(key).alias("_k")).groupBy("_d").agg(F.min("_k").alias("_k")).select(F.col("_k").alias(key))


def keep_first(rows: DataFrame) -> DataFrame:
    """(id) of the records of band rows (id, band, key) that go: some bucket-mate k of theirs has a bucket-mate, or is itself, before them.

    m(k) is the least id in any bucket of k; a record goes if some bucket-mate
    k (itself included) has m(k) < id.  Both hops are minima by bucket and by
    id, so a bucket of any size is only ever a sum of partial minima.
    """
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # read four times; lost parts come again from the lineage
    least = rows.groupBy("band", "key").agg(F.min("id").alias("least"))
    m = rows.join(least, ["band", "key"]).groupBy("id").agg(F.min("least").alias("m"))
    reach = rows.join(m, "id").groupBy("band", "key").agg(F.min("m").alias("reach"))
    return rows.join(reach, ["band", "key"]).groupBy("id").agg(F.min("reach").alias("reach")).where("reach < id").select("id")


def remove_near(df: DataFrame, key: str, text: str, threshold: float = 0.8, k: int = 3, permutations: int = PERMUTATIONS) -> DataFrame:
    """df without the records that ``keep_first`` removes."""
    return df.join(near_keys(df, key, text, threshold, k, permutations), key, "left_anti")


def near_keys(df: DataFrame, key: str, text: str, threshold: float = 0.8, k: int = 3, permutations: int = PERMUTATIONS) -> DataFrame:
    """(key) of the rows that ``remove_near`` removes."""
    return keep_first(band_rows(df.where(F.col(key).isNotNull()), key, text, threshold, k, permutations)).withColumnRenamed("id", key)


def copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """(digest, kept, n): of each text (lower-cased and trimmed; null is '') that comes more than once the least key and the number of rows."""
    digest = F.md5(F.lower(F.trim(F.coalesce(F.col(text), F.lit("")))).cast("binary"))
    return df.select(digest.alias("digest"), F.col(key).alias("_k")).groupBy("digest").agg(F.min("_k").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_stats(total: DataFrame, kept: DataFrame) -> DataFrame:
    """(original, unique, removed, rate) of a deduplication; rate in per cent, to two digits."""
    a = total.agg(F.count(F.lit(1)).alias("original"))
    b = kept.agg(F.count(F.lit(1)).alias("unique_rows"))
    one = F.lit(1).alias("_one")
    both = a.select("*", one).join(F.broadcast(b.select("*", one)), "_one").drop("_one")  # one row each
    removed = F.col("original") - F.col("unique_rows")
    return both.select("original", "unique_rows", removed.alias("removed"), F.when(F.col("original") > 0, F.bround(removed * 100 / F.col("original"), 2)).otherwise(0.0).alias("rate"))


def already_processed(df: DataFrame, key: Column, done: DataFrame, done_key: Column) -> DataFrame:
    """The rows of df whose key (null is never processed) is not among those done."""
    ids = done.select(done_key.cast("string").alias("_done")).where("_done is not null").distinct()
    return df.withColumn("_key", key.cast("string")).join(ids, F.col("_key") == F.col("_done"), "left_anti").drop("_key")


def newest(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row of each key, that with the greatest order: a running maximum, aggregated map side, so no group is sorted or held."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")
