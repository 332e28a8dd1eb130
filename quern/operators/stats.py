"""Statistics of datasets: histograms, summaries, splits, diversity.

Every function gives a DataFrame from one pre-aggregated pass; ratios are not
rounded here (reports round).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.chat import final_response
from quern.functions.text import let, word_count, words

COUNT = F.count


def histogram(df: DataFrame, value: Column, name: str = "value", missing: str = "unknown") -> DataFrame:
    """(value, n) of every value; null counts as ``missing``."""
    return df.select(F.coalesce(value.cast("string"), F.lit(missing)).alias(name)).groupBy(name).agg(COUNT(F.lit(1)).alias("n"))


def flag_histogram(df: DataFrame, flags: Column) -> DataFrame:
    """(category, n) of a map<string, boolean>: how often each category is set."""
    return df.select(F.explode(flags).alias("category", "set")).where("set").groupBy("category").agg(COUNT(F.lit(1)).alias("n"))


def lengths(df: DataFrame, text: Column) -> DataFrame:
    """(least, most, mean, median) of the characters of non-null texts; the median is exact."""
    n = F.length(text).alias("n")
    return df.select(n).where("n is not null").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"), F.percentile("n", 0.5).alias("median"))


def stages(counts: list[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, place, n) of the rows after each stage: one aggregate per stage, in one job."""
    parts = [df.agg(COUNT(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), F.lit(k).alias("place"), "n") for k, (name, df) in enumerate(counts)]
    return reduce(DataFrame.unionByName, parts)


def marked_stages(df: DataFrame, flags: list[tuple[str, Column]]) -> DataFrame:
    """(stage, place, n) of rows that carry a flag for each stage: all stages in one pass."""
    sums = df.agg(*[F.count(F.when(flag, 1)).alias(f"_{k}") for k, (_, flag) in enumerate(flags)])
    rows = F.array(*[F.struct(F.lit(name).alias("stage"), F.lit(k).alias("place"), F.col(f"_{k}").alias("n")) for k, (name, _) in enumerate(flags)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def retention(stage_counts: dict[str, int]) -> dict[str, float]:
    """Initial and final rows, how many were filtered, and what per cent stayed; the final stage is the last that is present."""
    initial = stage_counts.get("loaded", 0)
    final = next((stage_counts[s] for s in ("safety", "language", "dedup", "loaded") if s in stage_counts), 0)
    return {"initial": initial, "final": final, "filtered": initial - final, "retention": round(final * 100 / initial, 2) if initial else 0.0}


def top_terms(df: DataFrame, terms: Column, k: int = 10) -> DataFrame:
    """(term, n): the k most frequent of an array column, ties in order of the term."""
    return df.select(F.explode(terms).alias("term")).groupBy("term").agg(COUNT(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(k)


def corpus(df: DataFrame) -> DataFrame:
    """(passages, books, authors, both, weather, humor, least, most, mean_words) of passages."""
    def of(kind: str) -> Column:
        return F.count(F.when(F.col("context_type") == kind, 1))

    return df.agg(
        COUNT(F.lit(1)).alias("passages"), F.countDistinct("book_title").alias("books"), F.countDistinct("author_name").alias("authors"), of("both").alias("both_contexts"),
        of("weather").alias("weather_contexts"), of("humor").alias("humor_contexts"), F.min("word_count").alias("least"), F.max("word_count").alias("most"), F.avg("word_count").alias("mean_words"),
    )


def corpus_by(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of passages by book or author, in order of the value."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(COUNT(F.lit(1)).alias("n"))


def corpus_lists(df: DataFrame) -> DataFrame:
    """(books, authors): the sorted distinct titles and authors, as many as there are books."""
    return df.agg(F.array_sort(F.collect_set("book_title")).alias("books"), F.array_sort(F.collect_set("author_name")).alias("authors"))


def file_counts(df: DataFrame, stages_: dict[str, Column]) -> DataFrame:
    """(source_file, stage...): of each file how many rows are left after each stage, all in one pass; a stage's condition includes those before it."""
    return df.groupBy("source_file").agg(*[F.count(F.when(c, 1)).alias(n) for n, c in stages_.items()])


def merge_stats(df: DataFrame, persona: Column, scenario: Column, humorous: tuple[str, ...] = ("twain", "franklin")) -> DataFrame:
    """(kind, value, n, percent) of personas and scenarios, and of kind humor_ratio the share of humorous personas, in per cent as well."""
    named = df.select(F.coalesce(persona, F.lit("unknown")).alias("persona"), F.coalesce(scenario, F.lit("unknown")).alias("scenario"))
    funny = F.when(F.col("persona").isin(*humorous), "humorous").otherwise("plain")
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("value")) for k, c in (("persona", F.col("persona")), ("scenario", F.col("scenario")), ("humor_ratio", funny))])
    counts = named.select(F.explode(pairs).alias("p")).groupBy("p.kind", "p.value").agg(COUNT(F.lit(1)).alias("n"))
    total = named.agg(COUNT(F.lit(1)).alias("_all")).withColumn("_one", F.lit(1))
    return counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").select("kind", "value", "n", (F.col("n") * 100 / F.col("_all")).alias("percent"))


def last_errors(df: DataFrame, ok: Column, time: Column, error: Column, k: int = 5) -> DataFrame:
    """(time, error) of the last k calls that failed, the latest first."""
    return df.where(~F.coalesce(ok, F.lit(False))).select(time.alias("time"), error.alias("error")).orderBy(F.desc("time"), "error").limit(k)


def mean_similarity(df: DataFrame, split: str, values: list[str], one: str, two: str) -> DataFrame:
    """(similarity) of two splits: the mean of the similarities of several values' distributions; arrays count each element."""
    kinds = dict(df.dtypes)
    parts = [similarity(df.select(split, F.explode(v).alias(v)) if kinds[v].startswith("array") else df.select(split, v), split, v, one, two) for v in values]
    return reduce(DataFrame.unionAll, parts).agg(F.avg("similarity").alias("similarity"))


def response_lengths(df: DataFrame, text: Column) -> DataFrame:
    """(responses, mean, least, most) of the words of non-null texts."""
    n = df.where(text.isNotNull()).select(word_count(text).alias("n"))
    return n.agg(COUNT(F.lit(1)).alias("responses"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"))


def pass_rate(df: DataFrame, errors: Column) -> DataFrame:
    """(total, passed, failed, percent) of rows with an array of errors."""
    good = F.size(errors) == 0
    return df.select(good.alias("good")).agg(COUNT(F.lit(1)).alias("total"), F.count(F.when(F.col("good"), 1)).alias("passed"), F.count(F.when(~F.col("good"), 1)).alias("failed"), (F.avg(F.col("good").cast("int")) * 100).alias("percent"))


def failure_samples(df: DataFrame, key: str, errors: Column, k: int = 10) -> DataFrame:
    """(key, error) of the first k rows with errors, in order of the key: their first errors."""
    return df.where(F.size(errors) > 0).select(key, F.get(errors, F.lit(0)).alias("error")).orderBy(key).limit(k)


def posts(df: DataFrame) -> DataFrame:
    """(subreddit, n, mean_title, complete_percent): posts of each subreddit, their titles' mean length, and the share whose id, subreddit, time and address are known."""
    known = F.col("id").isNotNull() & F.col("subreddit").isNotNull() & F.col("created_utc").isNotNull() & F.col("url").isNotNull()
    return df.groupBy("subreddit").agg(COUNT(F.lit(1)).alias("n"), F.avg(F.length("title")).alias("mean_title"), (F.avg(known.cast("int")) * 100).alias("complete_percent"))


def tag_counts(df: DataFrame, split: str, tags: list[str]) -> DataFrame:
    """(split, tag, value, n, percent): of each split, how often each value of each tag occurs, and in what per cent of its items; lists count each element, empty values none."""
    kinds = dict(df.dtypes)
    pairs = F.array(*[F.struct(F.lit(t).alias("tag"), (F.col(t) if kinds[t].startswith("array") else F.array(F.col(t).cast("string"))).alias("values")) for t in tags])
    totals = df.groupBy(split).agg(COUNT(F.lit(1)).alias("_items"))
    rows = df.select(split, F.explode(pairs).alias("p")).select(split, "p.tag", F.explode("p.values").alias("value")).where("value is not null and value != ''")
    counts = rows.groupBy(split, "tag", "value").agg(COUNT(F.lit(1)).alias("n"))
    return counts.join(totals, split).select(split, "tag", "value", "n", (F.col("n") * 100 / F.col("_items")).alias("percent"))


def similarity(df: DataFrame, split: str, value: str, one: str, two: str) -> DataFrame:
    """(similarity) of a value's distribution in two splits: 1 - half the sum of the differences of shares; 0 if a split is empty."""
    counts = df.where(F.col(split).isin(one, two)).groupBy(F.coalesce(F.col(value).cast("string"), F.lit("unknown")).alias("v")).agg(
        F.count(F.when(F.col(split) == one, 1)).alias("a"), F.count(F.when(F.col(split) == two, 1)).alias("b")
    )
    total = counts.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb")).withColumn("_one", F.lit(1))  # one row
    far = counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").agg(F.max("ta").alias("ta"), F.max("tb").alias("tb"), F.sum(F.abs(F.try_divide("a", "ta") - F.try_divide("b", "tb"))).alias("far"))
    return far.select(F.when((F.col("ta") > 0) & (F.col("tb") > 0), 1 - F.col("far") / 2).otherwise(0.0).alias("similarity"))  # an empty split gives 0


def turns(df: DataFrame, messages: Column) -> DataFrame:
    """(single_turn, multi_turn): conversations of three messages and others."""
    return df.select(F.size(messages).alias("n")).where("n > 0").agg(F.count(F.when(F.col("n") == 3, 1)).alias("single_turn"), F.count(F.when(F.col("n") != 3, 1)).alias("multi_turn"))


def answer_lengths(df: DataFrame, messages: Column) -> DataFrame:
    """(answers, mean, least, most) of the characters of assistant messages."""
    said = F.filter(messages, lambda m: (m["role"] == "assistant") & m["content"].isNotNull())
    n = df.select(F.explode(F.transform(said, lambda m: F.length(m["content"]))).alias("n"))
    return n.agg(COUNT(F.lit(1)).alias("answers"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"))


# ---------------------------------------------------------------- diversity

# Phrases that tell a template.
TEMPLATES = {
    "twain_forecast_promise": "weather forecasts and promises are alike",
    "twain_climate_expect": "Climate is what we expect, weather is what we get",
    "franklin_early_bed": "Early to bed and early to rise",
    "neutral_info_requested": "Here's the information you requested for",
}


def template_counts(df: DataFrame, text: Column, patterns: dict[str, str]) -> DataFrame:
    """(pattern, n, percent): texts that hold each pattern, whatever the case; a text counts for every one it holds."""
    low = F.lower(F.coalesce(text, F.lit("")))
    names = list(patterns)
    sums = df.agg(COUNT(F.lit(1)).alias("_all"), *[F.count(F.when(low.contains(patterns[n].lower()), 1)).alias(f"_{k}") for k, n in enumerate(names)])
    rows = sums.select("_all", F.explode(F.array(*[F.struct(F.lit(n).alias("pattern"), F.col(f"_{k}").alias("n")) for k, n in enumerate(names)])).alias("r"))
    return rows.select("r.pattern", "r.n", F.when(F.col("_all") > 0, F.col("r.n") * 100 / F.col("_all")).otherwise(0.0).alias("percent"))


def phrases(text: Column, n: int = 4) -> Column:
    """The runs of n words of a text, lower-cased, joined by blanks."""
    w = words(F.lower(F.coalesce(text, F.lit(""))))
    none = F.array().cast("array<string>")
    return let(w, lambda x: F.when(F.size(x) >= n, F.transform(F.sequence(F.lit(1), F.size(x) - n + 1), lambda i: F.array_join(F.slice(x, i, F.lit(n)), " "))).otherwise(none))


def top_phrases(df: DataFrame, text: Column, n: int = 4, k: int = 20, over: int = 5) -> DataFrame:
    """(term, n): of the k most frequent runs of n words, those that occur more than ``over`` times."""
    return top_terms(df, phrases(text, n), k).where(F.col("n") > over)


def length_buckets(df: DataFrame, text: Column) -> DataFrame:
    """(bucket, n) of the numbers of words."""
    w = word_count(text)
    bucket = F.when(w <= 10, "1-10").when(w <= 25, "11-25").when(w <= 50, "26-50").otherwise("51+")
    return df.where(text.isNotNull()).select(bucket.alias("bucket")).groupBy("bucket").agg(COUNT(F.lit(1)).alias("n"))


def diversity(df: DataFrame, messages: Column, patterns: dict[str, str] = TEMPLATES) -> DataFrame:
    """(responses, unique_ratio, template_free, phrase_diversity, score, label) of the final responses of conversations."""
    rows = df.select(final_response(messages).alias("r")).where("r is not null")
    low = F.lower(F.col("r"))
    templated = reduce(lambda a, b: a + b, [low.contains(p.lower()).cast("long") for p in patterns.values()])
    sums = rows.agg(COUNT(F.lit(1)).alias("n"), F.countDistinct("r").alias("u"), F.coalesce(F.sum(templated), F.lit(0)).alias("t"))
    most = rows.select(F.explode(phrases(F.col("r"))).alias("p")).groupBy("p").agg(COUNT(F.lit(1)).alias("c")).agg(F.coalesce(F.max("c"), F.lit(0)).alias("m"))
    one = F.lit(1).alias("_one")
    both = sums.select("*", one).join(F.broadcast(most.select("*", one)), "_one")  # one row each
    n = F.col("n")
    ratio, free, spread = F.col("u") / n, (n - F.col("t")) / n, 1 - F.col("m") / n
    score = (ratio * 0.3 + free * 0.5 + spread * 0.2) * 100
    label = F.when(score >= 90, "excellent").when(score >= 75, "good").when(score >= 60, "fair").otherwise("poor")
    return both.where("n > 0").select(n.alias("responses"), ratio.alias("unique_ratio"), free.alias("template_free"), spread.alias("phrase_diversity"), score.alias("score"), label.alias("label"))


def generation(df: DataFrame, columns: list[str], city: str) -> DataFrame:
    """(kind, value, n, percent, cities): rows of each value of each column, by grouping sets in one pass."""
    named = df.select(*[F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in columns], F.col(city).alias("_city"))
    total = named.agg(COUNT(F.lit(1)).alias("_all")).select("_all", F.lit(1).alias("_one"))
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in columns])
    counts = named.select(F.explode(pairs).alias("p"), "_city").groupBy("p.kind", "p.value").agg(COUNT(F.lit(1)).alias("n"), F.countDistinct("_city").alias("cities"))
    return counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").select("kind", "value", "n", (F.col("n") * 100 / F.col("_all")).alias("percent"), "cities")


def failures(df: DataFrame, errors: Column) -> DataFrame:
    """(kind, n) of the first error of each row: what stands before its first colon; rows without errors are 'valid'."""
    first = F.get(errors, F.lit(0))
    kind = F.when(F.size(errors) == 0, "valid").otherwise(F.element_at(F.split(first, ":"), 1))
    return df.select(kind.alias("kind")).groupBy("kind").agg(COUNT(F.lit(1)).alias("n"))


def calls_log(df: DataFrame) -> DataFrame:
    """(calls, succeeded_percent, tokens, mean_latency) of a log (ok, tokens, latency)."""
    return df.agg(
        COUNT(F.lit(1)).alias("calls"), (F.avg(F.col("ok").cast("int")) * 100).alias("succeeded_percent"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.avg("latency").alias("mean_latency")
    )


def in_range(n: int, least: int, most: int) -> bool:
    """Whether a number of rows lies in its target range."""
    return least <= n <= most
