"""Passages around keywords in books or other long texts.

Paragraphs are rows of (doc, position); a window of five tells where keywords
stand, a passage grows around its centre by running word counts, and passages
that overlap too much with a better one are left out, document by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.keywords import HUMOR, WEATHER, has_keyword, matches
from quern.functions.text import chapter_marker, let, paragraphs, speaker_names, word_count
from quern.operators.sampling import ranked
from quern.session import settled

# Sizes of passages in words, paragraphs around a match, overlap allowed.
LEAST, MOST, TARGET = 75, 600, 150
BEFORE, AFTER, WINDOW = 1, 1, 5
OVERLAP = 0.2


def paragraph_rows(df: DataFrame, key: str, text: str, separator: str = r"\n\s*\n") -> DataFrame:
    """(key, position, paragraph, words) of each document's paragraphs, from 0."""
    rows = df.select(key, F.posexplode(paragraphs(F.col(text), separator)).alias("position", "paragraph"))
    return rows.withColumn("words", word_count(F.col("paragraph")))


def windows(rows: DataFrame, key: str, size: int = WINDOW) -> DataFrame:
    """rows with ``around``: the text of the paragraphs around each, joined by blanks."""
    half = size // 2
    near = Window.partitionBy(key).orderBy("position").rowsBetween(-half, half)
    return rows.withColumn("around", F.array_join(F.collect_list("paragraph").over(near), " "))


def centres(rows: DataFrame, key: str, weather: list[str] = WEATHER, humor: list[str] = HUMOR, size: int = WINDOW) -> DataFrame:
    """rows in whose window a keyword stands."""
    hit = rows.withColumn("_hit", (has_keyword(F.col("paragraph"), weather) | has_keyword(F.col("paragraph"), humor)).cast("int"))
    half = size // 2
    near = Window.partitionBy(key).orderBy("position").rowsBetween(-half, half)
    return hit.withColumn("_near", F.max("_hit").over(near)).where("_near = 1").drop("_near", "_hit")


def grown(counts: Column, centre: Column, target: int = TARGET, most: int = MOST) -> Column:
    """struct(begin, end): paragraphs [begin, end) of a passage around a centre, by the paragraphs' numbers of words.

    One paragraph before and one after; then one more at a time while the
    passage is short of the target; a step beyond the most is taken back and
    ends the growth.
    """
    n = F.size(counts)
    begin = F.greatest(centre - BEFORE, F.lit(0))
    end = F.least(n, centre + AFTER + 1)
    start = F.struct(end.alias("end"), F.aggregate(F.slice(counts, begin + 1, end - begin), F.lit(0), lambda a, x: a + x).alias("words"), F.lit(False).alias("done"))

    def step(s: Column, w: Column) -> Column:
        grows = ~s["done"] & (s["words"] < target)
        over = s["words"] + w > most
        return F.struct(
            F.when(grows & ~over, s["end"] + 1).otherwise(s["end"]).alias("end"),
            F.when(grows & ~over, s["words"] + w).otherwise(s["words"]).alias("words"),
            (s["done"] | (s["words"] >= target) | (grows & over)).alias("done"),
        )

    # every paragraph has a word, so no passage takes more than target of them beyond its first
    return F.struct(begin.alias("begin"), F.aggregate(F.slice(counts, end + 1, F.least(F.greatest(n - end, F.lit(0)), F.lit(target + 1))), start, step)["end"].alias("end"))


def candidates(df: DataFrame, key: str, text: str, weather: list[str] = WEATHER, humor: list[str] = HUMOR, separator: str = r"\n\s*\n", least: int = LEAST, most: int = MOST, target: int = TARGET) -> DataFrame:
    """(key, position, begin, end, passage, word_count, matched_keywords, context_type, relevance_score) of every centre whose passage fits and has a keyword itself."""
    half = WINDOW // 2

    def facts(p: Column) -> Column:
        """All that is needed of a paragraph, computed once however many passages hold it."""
        hit = has_keyword(p, weather) | has_keyword(p, humor)
        return F.struct(p.alias("p"), hit.alias("hit"), word_count(p).alias("words"), speaker_names(p).alias("names"), chapter_marker(p).alias("chapter"))

    # what is read for every centre stands in arrays of its own, made once for a document
    docs = df.select(key, F.explode(F.array(F.transform(paragraphs(F.col(text), separator), facts))).alias("paras")).where(F.size("paras") > 0)
    marks = F.filter(F.transform("paras", lambda x, i: F.struct(i.alias("i"), x["chapter"].alias("chapter"))), lambda m: m["chapter"].isNotNull())
    hits = F.transform(F.filter(F.transform("paras", lambda x, i: F.struct(i.alias("i"), x["hit"].alias("hit"))), lambda m: m["hit"]), lambda m: m["i"])
    near = F.flatten(F.transform(hits, lambda i: F.sequence(F.greatest(i - half, F.lit(0)), F.least(i + half, F.size("paras") - 1))))
    docs = settled(docs.select(key, "paras", F.transform("paras", lambda x: x["words"]).alias("counts"), marks.alias("marks"), F.array_sort(F.array_distinct(near)).alias("centres")))

    def made(i: Column) -> Column:
        """A centre with what its passage holds: only that goes on, not the document."""
        span = grown(F.col("counts"), i, target, most)
        own = let(span, lambda s: F.slice("paras", s["begin"] + 1, s["end"] - s["begin"]))
        return F.struct(i.alias("position"), span.alias("span"), own.alias("own"), F.try_element_at(F.filter("marks", lambda m: m["i"] <= i), F.lit(-1))["chapter"].alias("chapter"))

    rows = docs.where(F.size("centres") > 0).select(key, F.explode(F.transform("centres", made)).alias("c"))
    begin, end, own = F.col("c.span.begin"), F.col("c.span.end"), F.col("c.own")
    made = F.struct(
        F.array_join(F.transform(own, lambda x: x["p"]), "\n\n").alias("passage"), F.col("c.chapter").alias("chapter_section"),
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.transform(own, lambda x: x["names"])))), 1, 5).alias("character_names"),
    )
    # a one-element explode keeps the optimizer from computing the passage again in every later filter
    rows = rows.select(key, F.col("c.position").alias("position"), begin.alias("begin"), end.alias("end"), F.explode(F.array(made)).alias("p"))
    rows = rows.withColumn("word_count", word_count(F.col("p.passage"))).where(F.col("word_count").between(least, most))
    rows = rows.withColumn("m", F.explode(F.array(matches(F.col("p.passage"), weather, humor)))).where("m.relevance_score > 0")
    return rows.select(key, "position", "begin", "end", "p.passage", "word_count", "p.chapter_section", "p.character_names", "m.*")


def without_overlap(rows: DataFrame, key: str, overlap: float = OVERLAP, most: int = 1000) -> DataFrame:
    """The rows that stay when, by relevance (then position), each is taken unless it overlaps one taken by more than a share of the smaller.

    Sequential within a document, parallel over documents; only (position,
    begin, end, relevance) goes to Python, in batches that hold many
    documents, and the texts are joined back.
    """
    kind = dict(rows.dtypes)[key]

    def chosen_of(group: list[tuple]) -> list[tuple]:
        kept: list[tuple[int, int]] = []
        out = []
        for k, position, begin, end, _ in sorted(group, key=lambda r: (-r[4], r[1])):
            if len(kept) >= most:
                break
            if not any(min(end, e) - max(begin, b) > overlap * min(end - begin, e - b) for b, e in kept):
                kept.append((begin, end))
                out.append((k, position, len(out)))
        return out

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: list[tuple] = []
        for df in batches:
            out: list[tuple] = []
            for r in df.itertuples(index=False, name=None):
                if group and r[0] != group[0][0]:
                    out += chosen_of(group)
                    group = []
                group.append(r)
            yield pd.DataFrame(out, columns=[key, "position", "rank"])
        if group:
            yield pd.DataFrame(chosen_of(group), columns=[key, "position", "rank"])

    slim = rows.select(key, "position", "begin", "end", "relevance_score").where(F.col(key).isNotNull())
    chosen = slim.repartition(key).sortWithinPartitions(key).mapInPandas(pick, f"{key} {kind}, position int, rank int")
    return rows.join(chosen, [key, "position"])


def passage_ids(df: DataFrame, slug: Column, order: list[Column], out: str = "passage_id") -> DataFrame:
    """df with ids author_title_0000, numbered from 0 within each slug."""
    rows = ranked(df.withColumn("_slug", slug).where("_slug is not null"), "_slug", order, "_number")
    return rows.withColumn(out, F.format_string("%s_%04d", F.col("_slug"), F.col("_number"))).drop("_slug", "_number")


def top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first n rows of an order: each partition keeps its own n, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)

