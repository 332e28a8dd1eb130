"""More core queries: readers and sinks on files that the query writes itself, single functions, reports, options and generators."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import chat, keywords, language, tags, text
from quern.operators import dedup, generate, joins, passages, sampling, stats
from quern.plans import pipelines, reports
from quern.plans.catalog import _NEWEST, _STAGES, PHRASES, _sql_language, joined, long, query, sql_clean, sql_draw, sql_keywords, sql_list, sql_pick, sql_words
from quern.session import scratch, spread, table
from quern.sources import config, readers, writers


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, as a path of a mounted file system: for the small files that the driver itself writes."""
    at = scratch(spark, name).removeprefix("file:")
    os.makedirs(at)
    return at


# ---------------------------------------------------------------- readers

_ITEM = "id long, content string, source string"


@query("SELECT id, content, source FROM clean_items")
def s1_json(spark: SparkSession, folder: str) -> DataFrame:
    """Items written as JSON documents of a thousand each, whose rows stand in a list, under ``items`` or under ``data``."""
    at = scratch(spark, "s1")
    rows = table(spark, folder, "clean_items").select("id", "content", "source")
    lists = rows.groupBy(F.floor(F.col("id") / 1000).alias("k")).agg(F.collect_list(F.struct("id", "content", "source")).alias("r"))
    whole = F.when(F.col("k") % 3 == 0, F.to_json(F.struct(F.col("r").alias("items")))).when(F.col("k") % 3 == 1, F.to_json(F.struct(F.col("r").alias("data")))).otherwise(F.to_json("r"))
    lists.select(whole.alias("value"), "k").write.partitionBy("k").text(at)
    writers.put_text(spark, f"{at}/k=broken/broken.json", "{ this is not valid json }")
    return readers.read_json(spark, f"{at}/*/*", readers.struct(_ITEM)).select("id", "content", "source")


@query("SELECT id, content, source FROM clean_items")
def s2_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    """Items written as JSON lines, with blank and broken lines among them."""
    at = scratch(spark, "s2")
    rows = table(spark, folder, "clean_items").select("id", "content", "source")
    lines = rows.select(F.explode(F.array(F.to_json(F.struct("*")), F.when(F.col("id") % 7 == 0, '{"id": 1, "content": ').otherwise(""))).alias("value"))
    lines.write.text(at)
    return readers.read_jsonl(spark, at, _ITEM)


@query(" UNION ALL ".join(f"SELECT '{k}' AS kind, count(*) AS n, sum(book_id)::BIGINT AS ids FROM books" for k in ("json", "jsonl", "parquet", "unknown")))
def s3_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows behind four suffixes, of which one says nothing."""
    at = scratch(spark, "s3")
    books = table(spark, folder, "books").select("book_id", "title")
    rows = [r.asDict() for r in books.collect()]  # a dimension of a dozen rows
    whole = json.dumps({"entries": rows}, ensure_ascii=False)
    writers.put_text(spark, f"{at}/a.json", whole)
    writers.put_text(spark, f"{at}/b.JSONL", "\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    writers.put_text(spark, f"{at}/d.dat", whole)
    books.write.parquet(f"{at}/c.parquet")
    kind = readers.struct("book_id long, title string")
    parts = [readers.read_any(spark, f"{at}/{n}", kind).select(F.lit(k).alias("kind"), "book_id") for k, n in (("json", "a.json"), ("jsonl", "b.JSONL"), ("parquet", "c.parquet"), ("unknown", "d.dat"))]
    return readers.union([p.select("kind", F.col("book_id").cast("long").alias("book_id")) for p in parts]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("book_id").alias("ids"))


@query("""
SELECT coalesce(source_file, 'items.jsonl') AS source_file, count(*) AS n FROM clean_items GROUP BY 1 UNION ALL SELECT 'documents.parquet', count(*) FROM documents""")
def s4_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two files of other columns as one; source_file is the file's name where a row has none."""
    at = scratch(spark, "s4")
    writers.write_jsonl(table(spark, folder, "clean_items").select("id", "content", "source_file"), f"{at}/items.jsonl")
    rows = readers.read_sources(spark, [f"{at}/items.jsonl", f"{folder}/documents.parquet"])
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


_CSV = "title string, created_utc long, id string, num_comments int, subreddit string"


@query("SELECT nullif(title, '') AS title, created_utc, id, num_comments, subreddit FROM posts WHERE title IS NOT NULL")
def s5_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Posts written as CSV files in two encodings, read by one glob: titles that Latin-1 can spell stand in a Latin-1 file.  An empty field reads as null."""
    at = scratch(spark, "s5")
    rows = table(spark, folder, "posts").select("title", "created_utc", "id", "num_comments", "subreddit").where("title is not null")
    western = F.col("title").rlike(r"^[\x00-\xff]*$")
    options = {"header": True, "escape": "\"", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.where(western).write.options(**options, encoding="ISO-8859-1").csv(f"{at}/a")
    rows.where(~western).write.options(**options, encoding="UTF-8").csv(f"{at}/b")
    return readers.read_csv(spark, f"{at}/*/*.csv", _CSV)


@query("SELECT slug || '.txt' AS source_file, title || chr(10) || chr(10) || author AS text FROM books")
def s7_books(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch(spark, "s7")
    for r in table(spark, folder, "books").select("slug", "title", "author").collect():  # a dozen files
        writers.put_text(spark, f"{at}/{r['slug']}.txt", f"{r['title']}\n\n{r['author']}")
    return readers.read_books(spark, f"{at}/*.txt")


@query("SELECT 'kept' AS a, 'over' AS b, 7 AS c, 'default' AS d, 'quality.most' AS missing")
def s10_config(spark: SparkSession, folder: str) -> DataFrame:
    """A configuration merged over another, looked up and checked."""
    both = config.merged({"quality": {"a": "kept", "b": "under"}, "n": 1}, {"quality": {"b": "over"}, "n": 7})
    row = (config.get(both, "quality.a"), config.get(both, "quality.b"), config.get(both, "n"), config.get(both, "quality.z", "default"), ",".join(config.missing(both, ["quality.a", "quality.most", "n"])))
    return spark.createDataFrame([row], "a string, b string, c int, d string, missing string")


@query("SELECT left(text, 500) AS text FROM passages WHERE contains(lower(author_name), 'quorren') AND length(text) > 50 ORDER BY passage_id, text LIMIT 20")
def s12_style_examples(spark: SparkSession, folder: str) -> DataFrame:
    return readers.style_examples(table(spark, folder, "passages"), "Quorren")


# ---------------------------------------------------------------- sinks


@query("SELECT split, count(*) AS n, sum(len(messages))::BIGINT AS messages FROM conversation WHERE split IS NOT NULL GROUP BY split")
def k1_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    """Chat entries written as JSON lines by split, and loaded as a trainer does (S11)."""
    at = scratch(spark, "k1")
    rows = table(spark, folder, "conversation").where("split is not null").select("entry_id", "messages", "split")
    writers.write_split(rows, at)
    kind = f"entry_id long, messages array<{chat.MESSAGE}>, split string"
    return readers.read_jsonl(spark, at, kind).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("messages").isNotNull(), F.size("messages"))).alias("messages"))


@query("SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'books', count(*) FROM books")
def k2_append(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch(spark, "k2")
    for name in ("documents", "books"):
        writers.append_jsonl(table(spark, folder, name).select(F.lit(name).alias("name")), at)
    return readers.read_jsonl(spark, at, "name string").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS passages, count(text) AS texts, 'corpus' AS name FROM passages")
def k4_corpus(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch(spark, "k4")
    rows = table(spark, folder, "passages")
    writers.write_corpus(rows, at, {"name": "corpus"})
    kept = readers.read_jsonl(spark, f"{at}/passages", rows.schema)
    name = spark.read.text(f"{at}/metadata").select(F.get_json_object("value", "$.name").alias("name"))
    return kept.agg(F.count(F.lit(1)).alias("passages"), F.count("text").alias("texts")).join(F.broadcast(name))  # one row each


@query("SELECT true AS whole, count(*) AS n, 1 AS warnings FROM documents")
def k5_verified(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch(spark, "k5")
    writers.write_jsonl(table(spark, folder, "documents").select("doc_id", "text"), at)
    whole, n, warnings = writers.verify_jsonl(spark, at, expected=-1)
    return spark.createDataFrame([(whole, n, len(warnings))], "whole boolean, n long, warnings int")


@query(_STAGES)
def k7_report(spark: SparkSession, folder: str) -> DataFrame:
    """The stage counts written as a report and read back."""
    from quern.plans.catalog import a4_stage_counts

    at = scratch(spark, "k7")
    rows = reports.as_dicts(a4_stage_counts(spark, folder))
    writers.put_text(spark, f"{at}/report.json", json.dumps({"entries": rows}))
    return readers.read_json(spark, f"{at}/report.json", readers.struct("stage string, place int, n long")).select("stage", "place", "n")


_SIMILAR = """
SELECT avg(similarity) AS similarity FROM (
  SELECT 1 - sum(abs(a / ta - b / tb)) / 2 AS similarity FROM (SELECT *, sum(a) OVER (PARTITION BY tag) AS ta, sum(b) OVER (PARTITION BY tag) AS tb FROM (
    SELECT tag, value, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'validation') AS b FROM (
      SELECT split, 'persona' AS tag, coalesce(tags.persona, 'unknown') AS value FROM conversation UNION ALL SELECT split, 'tone', coalesce(tags.tone, 'unknown') FROM conversation
      UNION ALL SELECT split, 'domain', coalesce(d, 'unknown') FROM (SELECT split, unnest(tags.domain) AS d FROM conversation)) WHERE split IN ('train', 'validation') GROUP BY tag, value)) GROUP BY tag)"""


def _similar(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("split", "tags.persona", "tags.tone", "tags.domain")
    return stats.mean_similarity(rows, "split", ["persona", "tone", "domain"], "train", "validation")


@query(f"SELECT round(similarity, 9) AS similarity FROM ({_SIMILAR})")
def a11_mean_similarity(spark: SparkSession, folder: str) -> DataFrame:
    return _similar(spark, folder).select(F.round("similarity", 9).alias("similarity"))


@query(f"""
SELECT split, count(*) AS n, count(*) * 100 / (SELECT count(*) FROM conversation WHERE split IS NOT NULL) AS percent,
  (SELECT CASE WHEN similarity >= 0.95 THEN 'excellent' WHEN similarity >= 0.85 THEN 'good' WHEN similarity >= 0.75 THEN 'fair' ELSE 'poor' END FROM ({_SIMILAR})) AS label
FROM conversation WHERE split IS NOT NULL GROUP BY split""")
def k8_split_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").where("split is not null")
    counts = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}  # a row for each split
    figures = reports.split_report(f"{_folder(spark, 'k8')}/split", counts, _similar(spark, folder).first()["similarity"], [])
    return spark.createDataFrame([(s["split"], s["n"], s["percent"], figures["quality"]["label"]) for s in figures["splits"]], "split string, n long, percent double, label string")


@query("""
SELECT 'book' AS kind, book_title AS value, count(*) AS n FROM passages WHERE book_title IS NOT NULL GROUP BY book_title UNION ALL SELECT 'author', author_name, count(*) FROM passages WHERE author_name IS NOT NULL GROUP BY author_name""")
def k9_corpus_report(spark: SparkSession, folder: str) -> DataFrame:
    """Passages by book and author (A5), as the corpus report has them."""
    rows = table(spark, folder, "passages")
    totals = reports.as_dicts(stats.corpus(rows))[0]
    by = {k: reports.as_dicts(stats.corpus_by(rows, c)) for k, c in (("book", "book_title"), ("author", "author_name"))}
    figures = reports.corpus_report(f"{_folder(spark, 'k9')}/corpus", totals, by["book"], by["author"], reports.as_dicts(stats.top_terms(rows, F.col("matched_keywords"))))
    return spark.createDataFrame([(k, r["value"], r["n"]) for k, part in (("book", "books"), ("author", "authors")) for r in figures[part]], "kind string, value string, n long")


@query("SELECT array_to_string(list_sort(list(DISTINCT book_title)), '|') AS books, array_to_string(list_sort(list(DISTINCT author_name)), '|') AS authors FROM passages")
def a5_lists(spark: SparkSession, folder: str) -> DataFrame:
    return stats.corpus_lists(table(spark, folder, "passages")).select(F.array_join("books", "|").alias("books"), F.array_join("authors", "|").alias("authors"))


@query("""
WITH r AS (SELECT count(*) OVER (PARTITION BY coalesce(tags.persona, 'unknown')) AS n, row_number() OVER (PARTITION BY coalesce(tags.persona, 'unknown') ORDER BY md5(CAST(entry_id AS VARCHAR)), entry_id) AS k FROM conversation)
SELECT 'conversation' AS files, count(*) AS total, count(*) FILTER (k <= (n * 9) // 10) AS train, count(*) FILTER (k > (n * 9) // 10) AS validation, 0.9::DOUBLE AS ratio FROM r""")
def k10_merge_metadata(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", "tags")
    return pipelines.merge_metadata(pipelines.merge_datasets([rows], "entry_id"), ["conversation"])


# ---------------------------------------------------------------- filters and functions


@query("SELECT item_id, reviewer, coalesce(toxic = 0, false) AS safe FROM safety_labels")
def f6_single_safety(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "safety_labels").select("item_id", "reviewer", joins.safe(F.col("toxic") != 0).alias("safe"))


@query(f"SELECT passage_id, text FROM passages WHERE len({sql_keywords('text', keywords.EXPANDED)}) + len({sql_keywords('text', keywords.HUMOR)}) > 0")
def f8_passage_recheck(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "passages")).select("passage_id", "text", keywords.matches(F.col("text"), keywords.EXPANDED, keywords.HUMOR).alias("m"))
    return rows.where("m.relevance_score > 0").select("passage_id", "text")


_SENTENCES = r"\.\s+"
_PARTS = f"list_filter(list_transform(regexp_split_to_array(text, '{_SENTENCES}'), lambda p: regexp_replace(p, '^{text.SPACE}+|{text.SPACE}+$', '', 'g')), lambda p: p <> '')"
_PIECES = f"SELECT doc_id, i - 1 AS position, ps[i] AS p, len(ps) AS size FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, {_PARTS} AS ps FROM documents WHERE text IS NOT NULL))"


@query(f"""
SELECT doc_id, position FROM (SELECT doc_id, position, max(hit) OVER (PARTITION BY doc_id ORDER BY position ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near
  FROM (SELECT doc_id, position, CAST(len({sql_keywords('p', keywords.EXPANDED)}) > 0 AS INT) AS hit FROM ({_PIECES}))) WHERE near = 1""")
def f9_window_relevance(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences in whose window of five a keyword stands."""
    rows = passages.paragraph_rows(spread(table(spark, folder, "documents")), "doc_id", "text", _SENTENCES)
    return passages.centres(rows, "doc_id", keywords.EXPANDED, []).select("doc_id", long(F.col("position"), "position"))


@query(f"""
WITH w AS (SELECT doc_id, position, size, {sql_words('p')} AS n FROM ({_PIECES})),
c AS (SELECT doc_id, position, greatest(position - 1, 0) AS b, least(size, position + 2) AS e FROM w),
s AS (SELECT c.doc_id, c.position, c.b, c.e, sum(w.n) AS words FROM c JOIN w ON w.doc_id = c.doc_id AND w.position >= c.b AND w.position < c.e GROUP BY ALL),
t AS (SELECT s.doc_id, s.position, s.words + sum(w.n) OVER (PARTITION BY s.doc_id, s.position ORDER BY w.position) AS upto, w.n FROM s JOIN w ON w.doc_id = s.doc_id AND w.position >= s.e AND w.position < s.e + 151)
SELECT s.doc_id, s.position, s.b AS "begin", s.e + coalesce(g.more, 0) AS "end" FROM s LEFT JOIN (SELECT doc_id, position, count(*) AS more FROM t WHERE upto - n < 150 AND upto <= 600 GROUP BY ALL) g ON s.doc_id = g.doc_id AND s.position = g.position""")
def o12_growth(spark: SparkSession, folder: str) -> DataFrame:
    """The passage that grows around every sentence of every document."""
    docs = spread(table(spark, folder, "documents")).select("doc_id", F.explode(F.array(F.transform(text.paragraphs(F.col("text"), _SENTENCES), text.word_count))).alias("counts")).where(F.size("counts") > 0)
    grown = F.transform(F.sequence(F.lit(0), F.size("counts") - 1), lambda i: F.struct(i.alias("position"), passages.grown(F.col("counts"), i).alias("s")))
    rows = docs.select("doc_id", F.explode(grown).alias("g"))
    return rows.select("doc_id", long(F.col("g.position"), "position"), long(F.col("g.s.begin"), "begin"), long(F.col("g.s.end"), "end"))


@query("SELECT id, nfc_normalize(content) AS content, source FROM clean_items")
def proj_p02_item(spark: SparkSession, folder: str) -> DataFrame:
    return text.normalize_columns(table(spark, folder, "clean_items").select("id", "content", "source")).select("id", "content", "source")


@query(f"SELECT id, {sql_clean('title')} AS cleaned_title FROM posts")
def proj_p08_clean_plain(spark: SparkSession, folder: str) -> DataFrame:
    """A post's cleaning but for its decomposition, which SQL lacks."""
    return spread(table(spark, folder, "posts")).select("id", text.clean_post(F.col("title"), decompose=False).alias("cleaned_title"))


def _has(c: str, part: str) -> str:
    return f"contains(lower(coalesce({c}, '')), '{part}')"


@query(f"SELECT passage_id, CASE WHEN {_has('source_url', 'twain')} THEN 'twain' WHEN {_has('source_url', 'franklin')} THEN 'franklin' ELSE 'neutral' END AS persona FROM passages")
def proj_p16_persona_of_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "passages").select("passage_id", tags.persona_of_source(F.col("source_url")).alias("persona"))


_SOURCE_TONE = f"CASE WHEN {_has('source', 'theonion')} AND NOT {_has('source', 'not')} THEN 'satirical' WHEN {_has('source', 'nottheonion')} THEN 'ironic' WHEN {_has('source', 'franklin')} THEN 'didactic' ELSE 'humorous' END"


@query(f"SELECT entry_id, coalesce(nullif(tone, ''), {_SOURCE_TONE}) AS tone FROM (SELECT entry_id, tags.source AS source, tags.tone AS tone FROM conversation)")
def proj_p18_tone_of_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversation").select("entry_id", tags.tone_of_source(F.col("tags.source"), F.col("tags.tone")).alias("tone"))


@query("SELECT passage_id, 'neutral' AS persona, context_type AS tone, 'weather' AS domains, book_title FROM passages")
def proj_p22_merged_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata wins over a tag of its name: here the tone."""
    made = tags.merged(F.lit("neutral"), F.lit("plain"), F.array(F.lit("weather")), [("tone", F.col("context_type")), ("book_title", F.col("book_title"))])
    return table(spark, folder, "passages").select("passage_id", made.alias("t")).select("passage_id", "t.persona", "t.tone", joined(F.col("t.domain"), "domains"), "t.book_title")


@query(f"SELECT id, {sql_pick('id', chat.USER)} AS prompt FROM posts")
def proj_p26_user_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "posts").select("id", chat.pick(F.col("id"), chat.USER).alias("prompt"))


_SYSTEM = "CASE tags.persona " + " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in chat.SYSTEM.items()) + f" ELSE '{chat.SYSTEM['neutral']}' END"


@query(f"SELECT entry_id, 'system,user,assistant' AS roles, {_SYSTEM} AS system, {sql_pick('entry_id', chat.USER)} AS question, split AS answer FROM conversation")
def proj_p27_single_turn(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", chat.single_turn(F.col("split"), F.col("tags.persona"), F.col("entry_id")).alias("m"))
    said = lambda k: F.get("m", F.lit(k))["content"]
    return rows.select("entry_id", joined(F.transform("m", lambda x: x["role"]), "roles"), said(0).alias("system"), said(1).alias("question"), said(2).alias("answer"))


@query("SELECT pos, m AS month, CASE WHEN (latitude >= 0) = (m BETWEEN 5 AND 10) THEN 'summer' ELSE 'winter' END AS season FROM locations, (SELECT unnest(range(1, 13))::INT AS m)")
def proj_p37_season(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "locations").select("pos", "latitude", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return rows.select("pos", "month", generate.season(F.col("latitude"), F.col("month")).alias("season"))


@query()
def f4_detected(spark: SparkSession, folder: str) -> DataFrame:
    """English documents by the learned model; tested on held-out labels."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    found = language.detected(docs, "text", language.learned(docs))
    return joins.language_filter(found, F.col("language")).select("doc_id", "language")


@query("SELECT doc_id FROM documents WHERE lower(trim(lang)) = 'en'")
def f4_labelled(spark: SparkSession, folder: str) -> DataFrame:
    return joins.language_filter(table(spark, folder, "documents"), F.col("lang")).select("doc_id")


_OPTIONS = {"deduplication": {"mode": "exact"}, "quality": {"shortest": 40, "most": 600}, "language_filter": {"keep": "de", "least_characters": 60}, "safety": {"on_missing": "keep"}}


@query(f"""
WITH base AS (SELECT id, nfc_normalize(content) AS content FROM clean_items WHERE length(nfc_normalize(content)) BETWEEN 40 AND 600),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY md5(lower(trim(content))) ORDER BY id) AS r FROM base) WHERE r = 1),
l AS (SELECT id FROM ({_sql_language('content', 'd').replace('< 3 OR', '< 60 OR')}) WHERE language = 'de'),
v AS (SELECT item_id, max(CAST(toxic <> 0 AS INT)) AS f FROM safety_labels WHERE toxic IS NOT NULL AND item_id IS NOT NULL GROUP BY item_id),
s AS (SELECT l.id FROM l LEFT JOIN v ON l.id = v.item_id WHERE coalesce(f, 0) = 0)
SELECT 'loaded' AS stage, 0 AS place, count(*) AS n FROM base UNION ALL SELECT 'dedup', 1, count(*) FROM d UNION ALL SELECT 'language', 2, count(*) FROM l UNION ALL SELECT 'safety', 3, count(*) FROM s""")
def f14_options(spark: SparkSession, folder: str) -> DataFrame:
    """Normalization with other options than the default ones."""
    items = spread(table(spark, folder, "clean_items").select("id", "content"))
    return pipelines.normalize(items, "id", joins.verdicts(table(spark, folder, "safety_labels")), _OPTIONS).counts()


# ---------------------------------------------------------------- statistics, choices, validation

_FINAL = "CASE WHEN len(list_filter(messages, lambda m: m.role = 'assistant' AND coalesce(len(m.tool_calls), 0) = 0)) > 0 THEN (list_filter(messages, lambda m: m.role = 'assistant' AND coalesce(len(m.tool_calls), 0) = 0))[-1].content END"


@query(f"SELECT count(*) AS responses, avg(n) AS mean, min(n) AS least, max(n) AS most FROM (SELECT {sql_words('r')} AS n FROM (SELECT {_FINAL} AS r FROM conversation) WHERE r IS NOT NULL)")
def a14_response_lengths(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select(chat.final_response(F.col("messages")).alias("r"))
    out = stats.response_lengths(rows, F.col("r"))
    return out.select("responses", "mean", long(F.col("least"), "least"), long(F.col("most"), "most"))


@query(f"SELECT term, n FROM (SELECT term, count(*) AS n FROM (SELECT unnest({sql_keywords('title', keywords.EXPANDED)}) AS term FROM ({_NEWEST})) GROUP BY term) ORDER BY n DESC, term LIMIT 10")
def a6_top_keywords(spark: SparkSession, folder: str) -> DataFrame:
    posts = dedup.newest(spread(table(spark, folder, "posts").where("id is not null")), ["id"], F.struct("ingested_at", "num_comments", "title"))
    return stats.top_terms(joins.keyword_filter(posts), F.col("matched_keywords"))


@query("SELECT ts AS time, props AS error FROM events WHERE event_type = 'error' ORDER BY ts DESC, props LIMIT 5")
def a20_last_errors(spark: SparkSession, folder: str) -> DataFrame:
    return stats.last_errors(table(spark, folder, "events"), F.col("event_type") != "error", F.col("ts"), F.col("props"))


@query("SELECT count(*) AS n, count(*) BETWEEN 2000 AND 4000 AS inside FROM posts")
def a22_in_range(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "posts").count()
    return spark.createDataFrame([(n, stats.in_range(n, 2000, 4000))], "n long, inside boolean")


_SHARES = {"red": 0.2, "green": 0.35, "blue": 0.45}


@query(f"SELECT id, CASE WHEN x < 0.2 THEN 'red' WHEN x < 0.55 THEN 'green' ELSE 'blue' END AS colour FROM (SELECT id, ({sql_draw('id')} % 1000000) / 1000000 AS x FROM posts)")
def o9_weighted(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "posts").select("id", sampling.weighted(F.col("id"), _SHARES).alias("colour"))


@query("SELECT doc_id, CASE WHEN flagged AND length(rest) > 0 THEN rest ELSE text END AS text FROM (SELECT doc_id, text, coalesce(" + " OR ".join(f"contains(lower(text), '{p}')" for p in PHRASES.values()) + ", false) AS flagged, regexp_replace(text, '^[^.!?]*[.!?]\\s*', '') AS rest FROM documents)")
def g9_regenerated(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "text", text.contains_any(F.col("text"), list(PHRASES.values())).alias("flagged"))
    return generate.regenerated(rows, "text", "flagged").select("doc_id", "text")


@query("SELECT kind, fn AS function, CASE kind WHEN 'invalid_location' THEN 'Invalid location coordinates for ' || fn WHEN 'missing_parameter' THEN 'Missing required parameter for ' || fn WHEN 'out_of_range' THEN 'Parameter out of valid range for ' || fn WHEN 'api_error' THEN 'Weather service temporarily unavailable' WHEN 'rate_limit' THEN 'API rate limit exceeded. Please try again later.' WHEN 'unknown_city' THEN 'City not found in database' END AS message FROM (SELECT unnest(" + sql_list(list(generate.ERRORS)) + ") AS kind), (SELECT unnest(['get_forecast', 'geocode_location']) AS fn)")
def g3_error_payloads(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.createDataFrame([(k, f) for k in generate.ERRORS for f in ("get_forecast", "geocode_location")], "kind string, function string")
    return rows.select("kind", "function", generate.error_payload(F.col("kind"), F.col("function"))["message"].alias("message"))


@query("SELECT 'first' AS run, 4 AS ranges, 1000 AS n UNION ALL SELECT 'second', 0, 1000")
def g6_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """A run by ranges of rows, and the same run again, which finds them all there."""
    at, places = scratch(spark, "g6"), table(spark, folder, "locations")
    out = []
    for run in ("first", "second"):
        made = generate.resumed(spark, at, 1000, places, each=250)
        out.append((run, len(made), spark.read.json(at).count()))
    return spark.createDataFrame(out, "run string, ranges int, n int")


def _sql_persona(weights: dict[str, float]) -> str:
    upto, out = 0.0, "CASE"
    names = list(weights)
    for n in names[:-1]:
        upto += weights[n]
        out += f" WHEN x < {upto} THEN '{n}'"
    return out + f" ELSE '{names[-1]}' END"


_ROWS = f"SELECT ({sql_draw(chr(39) + 'p' + chr(39) + ' || r')} % 1000000) / 1000000 AS x FROM (SELECT unnest(range(0, 1000)) AS r)"


@query(" UNION ALL ".join(f"SELECT '{v}' AS variant, {_sql_persona(w)} AS persona, count(*) AS n FROM ({_ROWS}) GROUP BY 2" for v, w in (("balanced", generate.PERSONAS), ("humor", generate.HUMOR_PERSONAS))))
def g7_variants(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "locations")
    parts = [generate.variant(spark, 1000, places, v).select(F.lit(v).alias("variant"), F.col("tags.persona").alias("persona")) for v in ("balanced", "humor")]
    return readers.union(parts).groupBy("variant", "persona").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT city, count(*) AS n FROM (SELECT city, unnest(range(0, 40)) FROM locations) GROUP BY city")
def o10_location_pick(spark: SparkSession, folder: str) -> DataFrame:
    """Forty blocks of rows: every place once in each."""
    places = table(spark, folder, "locations")
    made = generate.conversations(spark, 40 * places.count(), places)
    return made.groupBy(F.col("metadata.location.city").alias("city")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT 'Invalid JSON' AS kind, 3 AS n UNION ALL
SELECT * FROM (SELECT 'Missing ''messages'' field' AS kind, count(*) AS n FROM conversation WHERE messages IS NULL UNION ALL SELECT '''messages'' array is empty', count(*) FROM conversation WHERE len(messages) = 0) WHERE n > 0""")
def v4_line_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Chat entries written as JSON lines beside three broken ones, checked line by line; here the faults of whole entries."""
    at = scratch(spark, "v4")
    writers.write_jsonl(table(spark, folder, "conversation").select("messages", "tags"), at)
    writers.put_text(spark, f"{at}/broken.json", "{\n[1, 2]\nnot json\n")
    kinds = ("Invalid JSON", "Missing 'messages' field", "'messages' array is empty")
    return writers.line_errors(spark, at).where(F.col("error").isin(*kinds)).groupBy(F.col("error").alias("kind")).agg(F.count(F.lit(1)).cast("long").alias("n"))


# ---------------------------------------------------------------- generated weather, in SQL as well


def _u(key: str, name: str) -> str:
    return f"({sql_draw(f'{key} || {chr(39)}/{name}{chr(39)}')} / 4294967296)"


def _between(key: str, name: str, low: object, high: object, digits: int = 1) -> str:
    return f"round({low} + {_u(key, name)} * ({high} - {low}), {digits})"


_ZONES = "CASE climate_zone " + " ".join(f"WHEN '{z}' THEN {sql_list(names)}" for z, names in generate.BY_CLIMATE.items()) + " ELSE ['clear', 'cloudy', 'rain'] END"


def _condition(key: str, t: str) -> str:
    fit = f"CASE WHEN {t} < -10 THEN list_filter(zone, lambda c: list_contains({sql_list(generate.COLD)}, c)) WHEN {t} > 35 THEN list_filter(zone, lambda c: list_contains({sql_list(generate.HOT)}, c)) ELSE zone END"
    some = f"(CASE WHEN len({fit}) > 0 THEN {fit} ELSE ['clear', 'cloudy'] END)"
    return f"({some})[CAST(floor({_u(key, 'c')} * len({some})) AS INT) + 1]"


_PLACES = f"SELECT *, CAST(pos AS VARCHAR) AS k, {_ZONES} AS zone, CASE WHEN latitude >= 0 THEN summer_lo ELSE winter_lo END AS lo, CASE WHEN latitude >= 0 THEN summer_hi ELSE winter_hi END AS hi FROM locations"


@query(f"""
WITH a AS (SELECT *, {_between("k", "t", "lo", "hi")} AS temperature FROM ({_PLACES})), b AS (SELECT *, {_condition("k", "temperature")} AS condition FROM a)
SELECT pos, temperature, condition, CASE WHEN condition IN ('thunderstorm', 'blizzard', 'sandstorm') THEN {_between("k", "w", 20, 50)} ELSE {_between("k", "w", 0, 20)} END AS wind_speed,
  CAST(CASE WHEN climate_zone IN ('tropical', 'equatorial', 'oceanic') THEN {_between("k", "h", 60, 95, 0)} WHEN climate_zone IN ('desert', 'semi-arid') THEN {_between("k", "h", 10, 40, 0)} ELSE {_between("k", "h", 30, 80, 0)} END AS INT) AS humidity,
  city || ', ' || country AS location FROM b""")
def g1_weather(spark: SparkSession, folder: str) -> DataFrame:
    """The weather of July at the place nearest to each place: itself."""
    places = table(spark, folder, "locations")
    made = generate.weather_at(places.select("pos", "latitude", "longitude"), "latitude", "longitude", "pos", places, 7)
    return made.select("pos", "weather.temperature", "weather.condition", "weather.wind_speed", "weather.humidity", "weather.location")


@query(f"""
WITH d AS (SELECT *, k || '/' || CAST(i AS VARCHAR) AS kk FROM (SELECT *, unnest(range(1, 8)) AS i FROM ({_PLACES}))),
a AS (SELECT *, {_between("kk", "t", "lo", "hi")} AS high FROM d), b AS (SELECT *, {_condition("kk", "high")} AS condition FROM a)
SELECT pos, strftime(DATE '2025-06-30' + CAST(i AS INT), '%Y-%m-%d') AS date, high AS temperature_max, round(high - {_between("kk", "l", 5, 12)}, 1) AS temperature_min, condition,
  CAST(CASE WHEN condition IN ('rain', 'thunderstorm', 'snow', 'drizzle') THEN {_between("kk", "p", 60, 95, 0)} WHEN condition IN ('cloudy', 'partly_cloudy') THEN {_between("kk", "p", 10, 40, 0)} ELSE {_between("kk", "p", 0, 20, 0)} END AS INT) AS precipitation_chance,
  {_between("kk", "w", 5, 25)} AS wind_speed FROM b""")
def g2_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """The forecast of a week at every place."""
    places = table(spark, folder, "locations")
    made = places.select("pos", generate.forecast(F.struct(*places.columns), F.lit(7), F.col("pos"), F.to_date(F.lit("2025-06-30"))).alias("f"))
    return made.select("pos", F.explode("f.daily").alias("d")).select("pos", "d.*")


@query("SELECT 'first' AS step, 'text 1' AS text, 1 AS fetched UNION ALL SELECT 'kept', 'text 1', 1 UNION ALL SELECT 'forced', 'text 2', 2 UNION ALL SELECT 'failed twice', 'text 5', 5")
def s8_fetch(spark: SparkSession, folder: str) -> DataFrame:
    """A remote text: fetched, kept, fetched again by force, and after two failures (on the driver)."""
    tries: list[int] = []
    fail: set[int] = {3, 4}

    def fetch() -> str:
        tries.append(1)
        if len(tries) in fail:
            raise OSError("no answer")
        return f"text {len(tries)}"

    out = []
    at = f"{_folder(spark, 's8')}/book.txt"
    for step, force in (("first", False), ("kept", False), ("forced", True), ("failed twice", True)):
        readers.cached_fetch(at, fetch, force, wait=lambda s: None)
        with open(at, encoding="utf-8") as f:
            out.append((step, f.read(), len(tries)))
    return spark.createDataFrame(out, "step string, text string, fetched int")


@query("SELECT 'kept' AS name, '{\"_inner\": 1}' AS value UNION ALL SELECT 'number', '7'")
def s9_config(spark: SparkSession, folder: str) -> DataFrame:
    """A configuration file, without its keys that begin with '_' (on the driver)."""
    at = f"{_folder(spark, 's9')}/c.json"
    writers.write_json(at, {"_comment": "left out", "kept": {"_inner": 1}, "number": 7})
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in config.load(at).items()], "name string, value string")
