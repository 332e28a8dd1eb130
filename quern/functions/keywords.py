"""Whole-word keyword matching, whatever the case."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import NOT_WORD

# Keyword lists.
WEATHER = [
    "weather", "rain", "storm", "thunder", "lightning", "cloud", "sun", "wind", "climate", "temperature",
    "snow", "fog", "drought", "hurricane", "tornado", "flood", "heat", "cold", "frost", "dew", "hail",
]
HUMOR = ["joke", "wit", "laugh", "humor", "comic", "amusing", "funny", "satire", "irony", "jest"]
EXPANDED = [
    *WEATHER,
    "winter", "summer", "spring", "fall", "autumn", "seasonal",
    "heatwave", "blizzard", "wildfire", "avalanche", "monsoon", "typhoon", "cyclone", "tsunami", "thunderstorm", "snowstorm",
    "forecast", "outlook", "weathering", "sunny", "cloudy", "rainy", "stormy", "breezy",
]


def tokens(text: Column) -> Column:
    """The lower-case words of a text: runs of letters, digits and underscores."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD)


def keyword_set(text: Column, terms: list[str]) -> Column:
    """The distinct terms that occur as whole words, sorted."""
    return F.array_sort(F.array_intersect(tokens(text), F.array(*[F.lit(t) for t in terms])))


def has_keyword(text: Column, terms: list[str]) -> Column:
    return F.arrays_overlap(tokens(text), F.array(*[F.lit(t) for t in terms]))


def keyword_spans(text: Column, terms: list[str]) -> Column:
    """array<struct<start, end, keyword>> of every match, in order."""
    import re

    pattern = re.compile(r"\b(" + "|".join(re.escape(t) for t in terms) + r")\b", re.IGNORECASE)

    @F.pandas_udf("array<struct<start: int, end: int, keyword: string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: [{"start": m.start(), "end": m.end(), "keyword": m.group().lower()} for m in pattern.finditer(t or "")])

    return run(text)


def relevance(weather: Column, humor: Column) -> Column:
    """2 with both kinds of keywords, 1 with one, 0 with none."""
    return weather.cast("int") + humor.cast("int")


def context_type(weather: Column, humor: Column) -> Column:
    return F.when(weather & humor, "both").when(weather, "weather").when(humor, "humor").otherwise("none")


def matches(text: Column, weather: list[str] = WEATHER, humor: list[str] = HUMOR) -> Column:
    """struct(matched_keywords, context_type, relevance_score) of a text."""
    w, h = keyword_set(text, weather), keyword_set(text, humor)
    has_w, has_h = F.size(w) > 0, F.size(h) > 0
    return F.struct(
        F.array_sort(F.array_union(w, h)).alias("matched_keywords"), context_type(has_w, has_h).alias("context_type"), relevance(has_w, has_h).alias("relevance_score")
    )
