"""The pipelines end to end: each stage is DataFrame to DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import chat, language, tags, text
from quern.functions.validate import entry_error
from quern.operators import dedup, joins, passages, sampling, stats
from quern.sources import config


@dataclass
class Run:
    """What a pipeline gives: its rows, and how many are left after each stage.

    Either the stages are DataFrames, or ``marked`` has every row with a flag
    for each stage, so that all are counted in one pass.
    """

    rows: DataFrame
    stages: list[tuple[str, DataFrame]] = field(default_factory=list)
    marked: DataFrame | None = None
    flags: list[tuple[str, Column]] = field(default_factory=list)

    def counts(self) -> DataFrame:
        """(stage, place, n)."""
        return stats.stages(self.stages) if self.marked is None else stats.marked_stages(self.marked, self.flags)


def normalize(items: DataFrame, key: str, verdicts: DataFrame | None = None, options: dict[str, Any] | None = None, verdict_key: str = "item_id", model: language.Languages | None = None) -> Run:
    """Items normalized, without duplicates, in one language, safe.

    The text of a row is the first of content, text, cleaned_title and title
    that is not empty.  Modes of deduplication: exact or lsh (as the reference
    has it, with unverified candidates); any other is an error.  With a model
    languages are told by it, else by the rule of frequent words.
    """
    o = config.merged(config.DEFAULTS, options or {})
    if o["deduplication"]["mode"] not in ("exact", "lsh"):
        raise ValueError(f"unknown mode of deduplication: {o['deduplication']['mode']!r}")
    rows = text.normalize_columns(items, o["normalization"]["form"]).withColumn("_text", text.first_text(items))
    if o["quality"]["shortest"]:
        rows = rows.where(F.length("_text") >= o["quality"]["shortest"])
    if o["quality"]["most"]:
        rows = rows.where(F.length("_text") <= o["quality"]["most"])
    if o["deduplication"]["mode"] == "exact":
        found = dedup.first_keys(rows, key, "_text").withColumn("_found", F.lit(True))
        marked = rows.join(found, key, "left").withColumn("_unique", F.col("_found").isNotNull())
    else:
        found = dedup.near_keys(rows, key, "_text", o["deduplication"]["threshold"], o["deduplication"]["shingle"], o["deduplication"]["permutations"]).withColumn("_found", F.lit(True))
        marked = rows.join(found, key, "left").withColumn("_unique", F.col("_found").isNull())
    keep, least = o["language_filter"]["keep"], o["language_filter"]["least_characters"]
    if model is None:
        told = joins.detected_language(F.col("_text"), least=least)
    else:
        marked, told = language.detected(marked, "_text", model, "_language"), F.when(F.length(text.strip(F.col("_text"))) >= least, F.col("_language"))
    marked = marked.withColumn("_spoken", F.when(F.col("_unique"), F.coalesce(told == keep, F.lit(False))).otherwise(False))
    if verdicts is None or o["safety"]["skip"]:
        marked = marked.withColumn("_safe", F.col("_spoken"))
    else:
        flagged = F.coalesce("flagged", F.lit(o["safety"]["on_missing"] == "drop"))
        marked = marked.join(verdicts.select(F.col(verdict_key).alias(key), "flagged"), key, "left").withColumn("_safe", F.col("_spoken") & ~flagged)
    flags = [("loaded", F.lit(True)), ("dedup", F.col("_unique")), ("language", F.col("_spoken")), ("safety", F.col("_safe"))]
    return Run(marked.where("_safe").select(*items.columns), marked=marked, flags=flags)


def instruct(items: DataFrame, key: str, options: dict[str, Any] | None = None) -> Run:
    """Items tagged, turned into chats, validated, split by stratum."""
    ratio = Fraction(str(config.merged(config.DEFAULTS, options or {})["split"]["ratio"])).as_integer_ratio()
    tagged = tags.with_tags(items)
    said = text.first_text(items)
    counted = F.coalesce(F.col("word_count"), text.word_count(said)) if "word_count" in items.columns else text.word_count(said)
    rows = tagged.where(said.isNotNull()).withColumn("messages", chat.chat(said, counted, F.col("persona"), F.col(key).cast("string")))
    checked = rows.withColumn("error", entry_error(F.col("messages"), F.col("persona"), F.col("tone"), F.col("domain")))
    sound = checked.where("error is null").drop("error")
    cut = sampling.split(sound.withColumn("stratum", chat.stratum(F.col("persona"), F.col("tone"), F.col("domain"))), ["stratum"], key, ratio)
    return Run(cut, [("loaded", items), ("chats", rows), ("valid", sound)])


def collect_passages(books: DataFrame, key: str, text_column: str, separator: str = r"\n\s*\n", options: dict[str, Any] | None = None, weather: list[str] | None = None, humor: list[str] | None = None) -> DataFrame:
    """Passages of books around keywords, without heavy overlap, the most relevant ``passages.total`` of them."""
    from quern.functions.keywords import HUMOR, WEATHER

    o = config.merged(config.DEFAULTS, options or {})["passages"]
    found = passages.candidates(books, key, text_column, weather or WEATHER, humor or HUMOR, separator, o["least"], o["most"], o["target"])
    chosen = passages.without_overlap(found, key, o["overlap"], o["per_book"])
    return passages.top(chosen, o["total"], [F.desc("relevance_score"), F.col(key), F.col("rank")])


def chat_posts(posts: DataFrame, key: str = "id", options: dict[str, Any] | None = None) -> DataFrame:
    """Posts filtered by keywords and quality, balanced over subreddits, as chats with tags."""
    o = config.merged(config.DEFAULTS, options or {})
    good = joins.quality_filter(joins.keyword_filter(posts), o["posts"]["decompose"], min_length=o["quality"]["least"])
    chosen = sampling.balanced(good, "subreddit", "num_comments", key, o["posts"]["most"])
    tagged = chosen.withColumn("tags", tags.post_tags(F.col("subreddit")))
    return tagged.withColumn("messages", chat.single_turn(F.col("cleaned_title"), F.lit("neutral"), F.col(key))).withColumn(
        "provenance", F.struct(F.col(key).alias("reddit_id"), "subreddit", "created_utc", "url", F.col("num_comments").alias("score"))
    )


def merge_datasets(parts: list[DataFrame], key: str, persona: str = "tags.persona", ratio: tuple[int, int] = (9, 10)) -> DataFrame:
    """Several sets of conversations as one, split by persona."""
    from quern.sources.readers import union

    rows = union(parts).withColumn("_persona", F.coalesce(F.col(persona), F.lit("unknown")))
    return sampling.split(rows, ["_persona"], key, ratio, keep_one=False).drop("_persona")


def merge_metadata(merged: DataFrame, files: list[str], ratio: float = 0.9) -> DataFrame:
    """(files, total, train, validation, ratio) of a merged and split set."""
    of = lambda split: F.count(F.when(F.col("split") == split, 1))
    return merged.agg(F.lit(",".join(files)).alias("files"), F.count(F.lit(1)).alias("total"), of("train").alias("train"), of("validation").alias("validation"), F.lit(ratio).alias("ratio"))
