"""Filters and joins of the pipelines: language, safety, books, places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import NOT_WORD, clean_post, is_valid, let, strip
from quern.functions.keywords import EXPANDED, keyword_set
from quern.session import cut, settled

# Frequent function words by which the rule-based detector tells a language.
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "in", "a", "is", "was", "it", "for", "on", "with", "that", "this", "at", "by", "from", "as", "are", "be", "which", "who", "not", "have", "or"],
    "de": ["der", "die", "das", "und", "ist", "in", "ein", "eine", "nicht", "mit", "den", "dem", "auf", "zu", "von", "im", "aber", "war", "sich", "bei", "aus", "für", "es", "auch", "wie"],
    "fr": ["le", "la", "les", "des", "et", "est", "un", "une", "dans", "pas", "que", "qui", "du", "au", "avec", "sur", "pour", "par", "ce", "cette", "en", "ne", "il", "elle", "de"],
    "es": ["el", "la", "los", "las", "de", "y", "que", "en", "un", "una", "con", "del", "se", "por", "no", "su", "al", "para", "como", "más", "lo", "es", "o", "pero", "si"],
}

FEW = 256  # places of which every one is looked at for every point
DIMENSION = 200_000  # rows up to which a dimension is broadcast


def dimension(df: DataFrame, limit: int = DIMENSION) -> DataFrame:
    """df marked for broadcast if it has at most ``limit`` rows; else as it is, for a join by shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def detected_language(text: Column, stop_words: dict[str, list[str]] = STOP_WORDS, least: int = 3) -> Column:
    """The language of whose frequent words a text has most different ones (the first by name of equals); 'unknown' for texts of under ``least`` characters or without any.

    A rule that stays inside the engine; ``functions.language`` learns to tell
    languages from labelled texts and is what the queries of pipelines use.
    """
    known = F.coalesce(text, F.lit(""))

    def best(tokens: Column) -> Column:
        def score(k: int, lang: str) -> Column:
            own = F.array(*[F.lit(w) for w in stop_words[lang]])
            return F.struct(F.size(F.array_intersect(tokens, own)).alias("n"), F.lit(k).alias("rank"), F.lit(lang).alias("lang"))

        return F.array_max(F.array(*[score(k, lang) for k, lang in enumerate(sorted(stop_words, reverse=True))]))

    told = let(let(F.split(F.lower(known), NOT_WORD), best), lambda b: F.when(b["n"] > 0, b["lang"]))
    return F.when(F.length(strip(known)) < least, "unknown").otherwise(F.coalesce(told, F.lit("unknown")))


def language_filter(df: DataFrame, lang: Column, keep: str = "en") -> DataFrame:
    """The rows in one language; null and unknown are none."""
    return df.where(F.lower(F.trim(lang)) == keep)


def safe(flagged: Column) -> Column:
    """Whether a single verdict lets a text through: an unknown one does not."""
    return F.coalesce(~flagged, F.lit(False))


def verdicts(labels: DataFrame, key: str = "item_id", verdict: str = "toxic") -> DataFrame:
    """(key, flagged): an item is flagged if any reviewer says so; null verdicts do not count."""
    return labels.where(F.col(key).isNotNull() & F.col(verdict).isNotNull()).groupBy(key).agg(F.max(F.col(verdict) != 0).alias("flagged"))


def safe_only(df: DataFrame, key: str, scores: DataFrame, scores_key: str, on_missing: str = "drop") -> DataFrame:
    """The rows that are not flagged; those without a verdict are dropped (fail closed) or kept."""
    if on_missing not in ("drop", "keep"):
        raise ValueError("on_missing must be 'drop' or 'keep'")
    joined = df.join(scores.select(F.col(scores_key).alias("_k"), "flagged"), F.col(key) == F.col("_k"), "left").drop("_k")
    return joined.where(~F.coalesce("flagged", F.lit(on_missing == "drop"))).drop("flagged")


def keyword_filter(df: DataFrame, text: str = "title", terms: list[str] = EXPANDED, out: str = "matched_keywords") -> DataFrame:
    """The rows whose text has one of the terms as a whole word, with the terms found."""
    return df.withColumn(out, keyword_set(F.col(text), terms)).where(F.size(out) > 0)


def quality_filter(df: DataFrame, decompose: bool = True, min_length: int = 10) -> DataFrame:
    """Posts with an id, a subreddit and a valid title, with ``cleaned_title``."""
    rows = settled(df.where("id is not null and subreddit is not null and title is not null and title != ''").withColumn("cleaned_title", clean_post(F.col("title"), decompose)))
    return rows.where(is_valid(F.col("cleaned_title"), min_length))


def with_book(passages: DataFrame, books: DataFrame, key: str = "book_id", kind: str = "inner") -> DataFrame:
    """passages with the columns of their book that they do not have themselves."""
    own = [c for c in books.columns if c == key or c not in passages.columns]
    return passages.join(dimension(books.select(*own)), key, kind)


def geocoded(df: DataFrame, city: Column, country: Column, locations: DataFrame) -> DataFrame:
    """df with found, latitude and longitude of its city and country, whatever the case; found is false where there is none."""
    place = locations.select(F.lower("city").alias("_city"), F.lower("country").alias("_country"), F.col("latitude").alias("place_latitude"), F.col("longitude").alias("place_longitude"))
    place = place.dropDuplicates(["_city", "_country"])
    joined = df.withColumns({"_c": F.lower(F.coalesce(city, F.lit(""))), "_n": F.lower(F.coalesce(country, F.lit("")))})
    joined = joined.join(dimension(place), (F.col("_c") == F.col("_city")) & (F.col("_n") == F.col("_country")), "left")
    return joined.withColumn("found", F.col("_city").isNotNull()).drop("_c", "_n", "_city", "_country")


def locations_where(locations: DataFrame, climate: str | None = None, continent: str | None = None) -> DataFrame:
    """Locations of a climate zone and a continent."""
    out = locations
    if climate is not None:
        out = out.where(F.lower("climate_zone") == climate.lower())
    return out if continent is None else out.where(F.lower("continent") == continent.lower())


def nearest(points: DataFrame, lat: Column, lon: Column, locations: DataFrame, out: str = "place") -> DataFrame:
    """points with ``out``, the row of locations with the least distance in degrees (the first by pos of equals); null without coordinates.

    Both sides meet in the cells of a grid, each point in its own cell and the
    eight around it; a place nearer than the nearest edge of these is the
    nearest of all.  Points that have none go on with cells four times as wide.
    Coordinates that come more than once are looked up once.
    """
    places = locations.where("latitude is not null and longitude is not null").select("latitude", "longitude", "pos", F.struct(*locations.columns).alias("_place"))
    span = places.agg(F.count(F.lit(1)).alias("n"), F.min("latitude").alias("a"), F.max("latitude").alias("b"), F.min("longitude").alias("c"), F.max("longitude").alias("d")).first()
    rows = points.withColumns({"_lat": lat.cast("double"), "_lon": lon.cast("double")})
    spots = rows.select("_lat", "_lon").where("_lat is not null and _lon is not null and not isnan(_lat) and not isnan(_lon)").distinct()
    found = None
    reach = spots.agg(F.min("_lat").alias("a"), F.max("_lat").alias("b"), F.min("_lon").alias("c"), F.max("_lon").alias("d")).first()
    # with cells as wide as all points and places, every point meets every place
    whole = 1.0 if not span["n"] or reach["a"] is None else max(max(span[h], reach[h]) - min(span[l], reach[l]) for l, h in (("a", "b"), ("c", "d")))
    width = 2 * whole + 1 if span["n"] <= FEW else max(span["b"] - span["a"], span["d"] - span["c"], 1e-6) / (span["n"] ** 0.5 / 2)  # about four places to a cell
    left = spots if span["n"] else spots.limit(0)
    while span["n"]:
        cell = lambda c: F.floor(c / F.lit(width))  # noqa: E731, B023
        here = dimension(places.select(cell(F.col("latitude")).alias("_y"), cell(F.col("longitude")).alias("_x"), "latitude", "longitude", "pos", "_place"))
        around = left.withColumns({"_y": cell(F.col("_lat")), "_x": cell(F.col("_lon"))})
        # how far it is to the nearest edge of the nine cells
        edge = F.least(F.col("_lat") - (F.col("_y") - 1) * width, (F.col("_y") + 2) * width - F.col("_lat"), F.col("_lon") - (F.col("_x") - 1) * width, (F.col("_x") + 2) * width - F.col("_lon"))
        near = F.array(F.lit(-1), F.lit(0), F.lit(1))
        around = around.withColumn("_edge", edge).withColumn("_dy", F.explode(near)).withColumn("_dx", F.explode(near))
        around = around.select("_lat", "_lon", "_edge", (F.col("_y") + F.col("_dy")).alias("_y"), (F.col("_x") + F.col("_dx")).alias("_x"))
        far = (F.col("latitude") - F.col("_lat")) * (F.col("latitude") - F.col("_lat")) + (F.col("longitude") - F.col("_lon")) * (F.col("longitude") - F.col("_lon"))
        best = around.join(here, ["_y", "_x"]).groupBy("_lat", "_lon", "_edge").agg(F.min_by(F.struct(far.alias("far"), "_place"), F.struct(far, "pos")).alias("_b"))
        sure = best.where((F.col("_b.far") < F.col("_edge") * F.col("_edge")) | F.lit(width > whole)).select("_lat", "_lon", F.col("_b._place").alias("_place"))
        sure = cut(sure)
        found = sure if found is None else found.unionByName(sure)
        if width > whole:
            break
        left = cut(left.join(sure, ["_lat", "_lon"], "left_anti"))
        if left.isEmpty():
            break
        width *= 4
    if found is None:
        found = left.withColumn("_place", F.lit(None).cast(dict(places.dtypes)["_place"]))
    return rows.join(found.withColumnRenamed("_place", out), ["_lat", "_lon"], "left").drop("_lat", "_lon")
