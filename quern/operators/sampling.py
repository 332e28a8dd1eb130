"""Balanced samples, stratified splits, caps and seeded choices.

A group or stratum may hold a third of all rows.  ``first_of_each`` therefore
ranks in two steps: within (group, part of the rows), and then the few
survivors within the group; ``split`` cuts by position in a hash order, which
is found by counting hash buckets first.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.chat import draw, stratum

def first_of_each(df: DataFrame, group: list[str], order: list[Column], n: int | Column, spread: Column, parts: int | None = None) -> DataFrame:
    """The first n rows of each group with their rank in ``_rank``; no task sorts more than a part of a group (as many as there are shuffle partitions) or parts * n rows."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = Window.partitionBy(*group, "_part").orderBy(*order)
    few = df.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(parts))).withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= n).drop("_n", "_part")
    return few.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_rank") <= n)


def ranked(df: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    """df with the rank from 0 of each row in its group, however large a group is.

    Rows are put into ranges of (group, order); a row's rank is its place in
    its range plus the rows of its group in the ranges before, which are
    counted by range.
    """
    ranges = df.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    counts = ranges.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_range")) - F.col("_n")
    starts = counts.select(group, "_range", before.alias("_start"))
    place = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    placed = ranges.withColumn("_place", place).join(starts, [group, "_range"])
    return placed.withColumn(out, F.col("_start") + F.col("_place") - 1).drop("_range", "_start", "_place")


def balanced(df: DataFrame, group: str, score: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows: with one group its best; else the best most // 2 of each, the rest filled from groups by falling size; and of all this the first.

    Ties are broken by the key.  The quotas come from the groups' sizes, which
    are pre-aggregated.
    """
    rows = df.where(F.col(group).isNotNull())
    order = [F.col(score).desc_nulls_last(), F.col(key)]
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    by_size = Window.orderBy(F.col("_size").desc(), F.col(group))
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    half = F.lit(most // 2)
    # the head of each group, cut where the groups before it, in order of size, have used up the total
    plan = sizes.withColumn("_groups", F.count(F.lit(1)).over(whole)).withColumn("_head", F.when(F.col("_groups") == 1, F.least("_size", F.lit(most))).otherwise(F.least(F.col("_size"), half)))
    plan = plan.withColumn("_left", F.greatest(F.lit(most) - F.sum("_head").over(whole), F.lit(0)))
    plan = plan.withColumn("_spare", F.col("_size") - F.col("_head"))
    plan = plan.withColumn("_more", F.least("_spare", F.greatest(F.col("_left") - F.coalesce(F.sum("_spare").over(before), F.lit(0)), F.lit(0))))
    plan = plan.withColumn("_room", F.greatest(F.lit(most) - F.coalesce(F.sum("_head").over(before), F.lit(0)), F.lit(0)))
    plan = plan.select(group, (F.least("_head", "_room") + F.col("_more")).alias("_quota")).where("_quota > 0")
    chosen = first_of_each(rows.join(plan, group), [group], order, F.col("_quota"), F.col(key))
    return chosen.drop("_quota", "_rank")


def split(df: DataFrame, strata: list[str], key: str, ratio: tuple[int, int] = (9, 10), order: Column | None = None, keep_one: bool = True) -> DataFrame:
    """df with ``split`` = train or validation: of each stratum floor(n * ratio) rows, in a hash order, are for training.

    With keep_one a stratum of several rows leaves one for validation.  Counts
    by (stratum, hash bucket) tell where the cut lies; only the rows of the
    bucket it falls in are ranked, so a stratum of any size is cut in parallel.
    """
    h = F.md5(F.col(key).cast("string").cast("binary")) if order is None else order
    rows = df.withColumn("_h", h).withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))  # 4,096 buckets
    names = [f"_s{i}" for i in range(len(strata))]
    rows = rows.withColumns({n: F.coalesce(F.col(s).cast("string"), F.lit("unknown")) for n, s in zip(names, strata)})
    counts = rows.groupBy(*names, "_b").agg(F.count(F.lit(1)).alias("_c"))
    stratum_ = Window.partitionBy(*names)
    running = stratum_.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_upto", F.sum("_c").over(running)).withColumn("_n", F.sum("_c").over(stratum_))
    num, den = ratio
    cut = F.floor(F.col("_n") * num / den) if den != 10 else F.expr(f"(_n * {num}) div {den}")
    if keep_one:
        cut = F.when((F.col("_n") > 1) & (cut >= F.col("_n")), F.col("_n") - 1).otherwise(cut)
    counts = counts.withColumn("_cut", cut).select(*names, "_b", (F.col("_upto") - F.col("_c")).alias("_before"), "_upto", "_cut")
    marked = rows.join(counts, [*names, "_b"])
    sure = marked.where((F.col("_upto") <= F.col("_cut")) | (F.col("_before") >= F.col("_cut"))).withColumn("split", F.when(F.col("_upto") <= F.col("_cut"), "train").otherwise("validation"))
    edge = marked.where((F.col("_upto") > F.col("_cut")) & (F.col("_before") < F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy(*names, "_b").orderBy("_h", key))
    edge = edge.withColumn("split", F.when(F.col("_before") + rank <= F.col("_cut"), "train").otherwise("validation"))
    return sure.unionByName(edge).drop("_h", "_b", "_before", "_upto", "_cut", *names)


def with_stratum(df: DataFrame, persona: Column, tone: Column, domain: Column, out: str = "stratum") -> DataFrame:
    return df.withColumn(out, stratum(persona, tone, domain))


def first_pattern(text: Column, patterns: dict[str, str]) -> Column:
    """The name of the first pattern a text holds, whatever the case; null if none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*[F.when(low.contains(p.lower()), F.lit(n)) for n, p in patterns.items()], F.lit(None).cast("string"))


def template_cap(df: DataFrame, text: str, key: str, patterns: dict[str, str], cap: int = 100) -> DataFrame:
    """df with ``pattern`` and ``regenerate``: rows beyond the first ``cap`` of their pattern are to be made anew."""
    rows = df.withColumn("pattern", first_pattern(F.col(text), patterns))
    kept = first_of_each(rows.where("pattern is not null").select(key, "pattern"), ["pattern"], [F.col(key)], cap, F.col(key)).select(key, F.lit(True).alias("_kept"))
    return rows.join(kept, key, "left").withColumn("regenerate", F.col("pattern").isNotNull() & F.col("_kept").isNull()).drop("_kept")


def weighted(key: Column, weights: dict[str, float], seed: int = 42) -> Column:
    """One of the names with its weight's chance, by a draw."""
    x = (draw(key, seed) % 1_000_000) / 1_000_000
    out, upto = None, 0.0
    names = list(weights)
    for n in names[:-1]:
        upto += weights[n]
        out = F.when(x < upto, n) if out is None else out.when(x < upto, n)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])
