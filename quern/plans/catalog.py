"""Registry of the core queries: each over whole tables, with SQL that gives the same rows where SQL can.

Keys begin with the operator they show: s sources, k sinks, f filters, proj
projections, j joins, a aggregations, o ordering and sampling, v validation,
g generators.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import chat, keywords, language, tags, text, validate
from quern.operators import dedup, generate, joins, passages, sampling, stats
from quern.plans import pipelines
from quern.session import spread, table
from quern.sources import readers, writers
from quern.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def long(c: Column, name: str) -> Column:
    return c.cast("long").alias(name)


def joined(c: Column, name: str) -> Column:
    return F.array_join(c, ",").alias(name)


# ---------------------------------------------------------------- SQL pieces


def sql_list(values: list[str] | tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


WORD = rf"'{text.NOT_SPACE}+'"


def sql_words(c: str) -> str:
    return f"coalesce(len(regexp_extract_all({c}, {WORD})), 0)"


def sql_tokens(c: str) -> str:
    return f"regexp_split_to_array(lower(coalesce({c}, '')), '{text.NOT_WORD}')"


def sql_keywords(c: str, terms: list[str]) -> str:
    return f"list_sort(list_distinct(list_filter({sql_tokens(c)}, lambda x: list_contains({sql_list(terms)}, x))))"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{text.SPACE}+|{text.SPACE}+$', '', 'g')"


def sql_clean(c: str) -> str:
    out = f"coalesce({c}, '')"
    for pattern, to in text.POST_REWRITES:
        out = f"regexp_replace({out}, '{pattern}', '{to.replace(chr(39), chr(39) * 2)}', 'g')"
    return sql_strip(f"regexp_replace({out}, '{text.SPACE}+', ' ', 'g')")


FIRST = "(messages)[1]"
MESSAGE_PAIRS = ["weather", "the"]


# ---------------------------------------------------------------- sources and filters


@query("""
SELECT 'clean_items' AS source_file, CAST(id AS VARCHAR) AS id, length(content) AS n_chars FROM clean_items
UNION ALL SELECT 'posts', id, length(title) FROM posts
UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), length(text) FROM documents
UNION ALL SELECT 'passages', passage_id, length(text) FROM passages""")
def s4_union(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name, key, column in (("clean_items", "id", "content"), ("posts", "id", "title"), ("documents", "doc_id", "text"), ("passages", "passage_id", "text")):
        parts.append(table(spark, folder, name).select(F.lit(name).alias("source_file"), F.col(key).cast("string").alias("id"), long(F.length(column), "n_chars")))
    return readers.union(parts)


@query(f"""
SELECT id, title, array_to_string({sql_keywords("title", keywords.EXPANDED)}, ',') AS matched
FROM posts WHERE len({sql_keywords("title", keywords.EXPANDED)}) > 0""")
def f1_keyword_filter(spark: SparkSession, folder: str) -> DataFrame:
    return joins.keyword_filter(spread(table(spark, folder, "posts"))).select("id", "title", joined(F.col("matched_keywords"), "matched"))


_CLEANED = f"SELECT id, subreddit, {sql_clean('title')} AS cleaned_title FROM posts WHERE id IS NOT NULL AND subreddit IS NOT NULL AND title IS NOT NULL AND title <> ''"


@query(f"SELECT * FROM ({_CLEANED}) WHERE length(cleaned_title) >= 10 AND regexp_matches(cleaned_title, '[a-zA-Z0-9]')")
def f2_quality_filter(spark: SparkSession, folder: str) -> DataFrame:
    return joins.quality_filter(spread(table(spark, folder, "posts")), decompose=False).select("id", "subreddit", "cleaned_title")


@query(f"SELECT doc_id, coalesce(length({sql_strip('text')}) >= 10 AND regexp_matches(text, '[a-zA-Z0-9]'), false) AS valid FROM documents")
def f3_valid_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.is_valid(F.col("text")).alias("valid"))


def _sql_language(c: str, rows: str) -> str:
    langs = sorted(joins.STOP_WORDS)
    n = {x: f"len(list_distinct(list_filter({sql_tokens(c)}, lambda t: list_contains({sql_list(joins.STOP_WORDS[x])}, t))))" for x in langs}
    top = "greatest(" + ", ".join(f"n_{x}" for x in langs) + ")"
    cases = " ".join(f"WHEN n_{x} = {top} THEN '{x}'" for x in langs)
    return f"SELECT *, CASE WHEN length({sql_strip(f'coalesce({c}, {chr(39) * 2})')}) < 3 OR {top} = 0 THEN 'unknown' {cases} END AS language FROM (SELECT *, " + ", ".join(f"{v} AS n_{k}" for k, v in n.items()) + f" FROM {rows})"


@query(f"SELECT doc_id, language FROM ({_sql_language('text', 'documents')}) WHERE language = 'en'")
def f4_language_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "documents")).select("doc_id", joins.detected_language(F.col("text")).alias("language"))
    return joins.language_filter(rows, F.col("language"))


@query(f"SELECT language, count(*) AS n FROM ({_sql_language('content', 'clean_items')}) GROUP BY language")
def a1_language_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return stats.histogram(spread(table(spark, folder, "clean_items")), joins.detected_language(F.col("content")), "language")


_VERDICTS = "SELECT item_id, max(CAST(toxic <> 0 AS INT)) AS f FROM safety_labels WHERE toxic IS NOT NULL AND item_id IS NOT NULL GROUP BY item_id"


@query(f"SELECT c.id, c.source FROM clean_items c JOIN ({_VERDICTS}) v ON c.id = v.item_id WHERE f = 0")
def f5_safety_filter(spark: SparkSession, folder: str) -> DataFrame:
    v = joins.verdicts(table(spark, folder, "safety_labels"))
    return joins.safe_only(table(spark, folder, "clean_items"), "id", v, "item_id").select("id", "source")


@query(f"SELECT c.id, c.source FROM clean_items c LEFT JOIN ({_VERDICTS}) v ON c.id = v.item_id WHERE coalesce(f, 0) = 0")
def f5_safety_filter_keep(spark: SparkSession, folder: str) -> DataFrame:
    v = joins.verdicts(table(spark, folder, "safety_labels"))
    return joins.safe_only(table(spark, folder, "clean_items"), "id", v, "item_id", on_missing="keep").select("id", "source")


@query("""
SELECT reviewer AS category, count(*) AS n FROM safety_labels WHERE toxic <> 0 AND reviewer IS NOT NULL GROUP BY reviewer""")
def a2_flag_histogram(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "safety_labels").where("reviewer is not null")
    return stats.flag_histogram(labels, F.create_map("reviewer", F.coalesce(F.col("toxic") != 0, F.lit(False))))


@query(f"SELECT doc_id, {sql_words('text')} AS words FROM documents WHERE {sql_words('text')} BETWEEN 75 AND 600")
def f7_word_band(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", long(text.word_count(F.col("text")), "words"))
    return rows.where(F.col("words").between(passages.LEAST, passages.MOST))


@query("""
SELECT passage_id, nullif(author_name, '') AS author_name, nullif(book_title, '') AS book_title, book_id, publication_year,
  CASE WHEN len(genre_tags) > 0 THEN array_to_string(genre_tags, ',') END AS genres,
  CASE WHEN len(matched_keywords) > 0 THEN array_to_string(matched_keywords, ',') END AS matched, nullif(source_url, '') AS source_url
FROM passages""")
def f10_essential_metadata(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "passages")
    return rows.select(tags.essential(rows).alias("m")).select(
        "m.passage_id", "m.author_name", "m.book_title", "m.book_id", "m.publication_year", joined_or_null("m.genre_tags", "genres"), joined_or_null("m.matched_keywords", "matched"), "m.source_url"
    )


def joined_or_null(c: str, name: str) -> Column:
    return F.when(F.col(c).isNotNull(), F.array_join(c, ",")).alias(name)


@query("""
SELECT p.passage_id, b.author_id FROM passages p JOIN books b ON p.book_id = b.book_id WHERE b.author_id = (SELECT min(author_id) FROM books)""")
def f11_author_filter(spark: SparkSession, folder: str) -> DataFrame:
    books = table(spark, folder, "books")
    first = books.agg(F.min("author_id").alias("author_id"))
    return joins.with_book(table(spark, folder, "passages"), books.join(first, "author_id", "left_semi")).select("passage_id", "author_id")


@query("SELECT id, reddit_id FROM clean_items WHERE reddit_id IS NULL OR reddit_id NOT IN (SELECT id FROM posts WHERE id IS NOT NULL)")
def f12_already_processed(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.already_processed(table(spark, folder, "clean_items"), F.col("reddit_id"), table(spark, folder, "posts"), F.col("id")).select("id", "reddit_id")


PHRASES = {"dog_days": "in the dog days", "by_trade": "by trade", "forecast": "forecast for", "late": "towards evening"}


@query("SELECT doc_id FROM documents WHERE " + " OR ".join(f"contains(lower(text), '{p}')" for p in PHRASES.values()))
def f13_template_filter(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").where(text.contains_any(F.col("text"), list(PHRASES.values()))).select("doc_id")


# ---------------------------------------------------------------- projections


@query("""
SELECT doc_id, md5(nfc_normalize(coalesce(text, ''))) AS form, nfc_normalize(coalesce(text, '')) <> coalesce(text, '') AS changed,
  length(nfc_normalize(coalesce(text, ''))) - length(coalesce(text, '')) AS length_diff FROM documents""")
def proj_p01_nfc(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "text", text.normalized(F.col("text")).alias("form"))
    s = text.change_stats(F.col("text"), F.col("form"))
    return rows.select("doc_id", F.md5(F.col("form").cast("binary")).alias("form"), s["changed"].alias("changed"), long(s["length_diff"], "length_diff"))


def proj_p02_nfkd(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "clean_items")
    return text.normalize_columns(rows, "NFKD").select("id", "content")


query()(proj_p02_nfkd)


@query(f"SELECT doc_id, array_to_string({sql_keywords('text', keywords.WEATHER)}, ',') AS matched FROM documents")
def proj_p03_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", joined(keywords.keyword_set(F.col("text"), keywords.WEATHER), "matched"))


@query()
def proj_p03_keyword_spans(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "documents")).select("doc_id", F.explode(keywords.keyword_spans(F.col("text"), keywords.WEATHER)).alias("m"))
    return rows.select("doc_id", "m.start", "m.end", "m.keyword")


_W, _H = f"len({sql_keywords('text', keywords.WEATHER)}) > 0", f"len({sql_keywords('text', keywords.HUMOR)}) > 0"


@query(f"""
SELECT doc_id, CASE WHEN w AND h THEN 'both' WHEN w THEN 'weather' WHEN h THEN 'humor' ELSE 'none' END AS context_type, CAST(w AS BIGINT) + CAST(h AS BIGINT) AS relevance_score,
  array_to_string({sql_keywords('text', keywords.WEATHER + keywords.HUMOR)}, ',') AS matched
FROM (SELECT doc_id, text, {_W} AS w, {_H} AS h FROM documents)""")
def proj_p07_matches(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "documents")).select("doc_id", keywords.matches(F.col("text")).alias("m"))
    return rows.select("doc_id", "m.context_type", long(F.col("m.relevance_score"), "relevance_score"), joined(F.col("m.matched_keywords"), "matched"))


@query()
def proj_p08_clean_post(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "posts")).select("id", text.clean_post(F.col("title")).alias("cleaned_title"))


_START, _END = text._EDGE.format("START"), text._EDGE.format("END")
_AFTER = f"CASE WHEN regexp_matches(t, '{_START}') THEN regexp_replace(t, '(?s)^.*?(?-s:{_START})', '') ELSE t END"


@query(f"""
SELECT doc_id, md5({sql_strip(f"CASE WHEN regexp_matches(a, '{_END}') THEN regexp_replace(a, '(?s)(?-s:{_END}).*$', '') ELSE a END")}) AS body
FROM (SELECT doc_id, {_AFTER} AS a FROM (
  SELECT doc_id, 'Title ' || coalesce(source, '') || chr(10) || '*** START OF THE PROJECT GUTENBERG EBOOK ONE ***' || chr(10) || coalesce(text, '') || chr(10) || '*** END OF THIS PROJECT GUTENBERG EBOOK ONE ***' || chr(10) || 'licence' AS t FROM documents))""")
def proj_p09_boilerplate(spark: SparkSession, folder: str) -> DataFrame:
    nothing, line = F.lit(""), F.lit("\n")
    wrapped = F.concat(
        F.lit("Title "), F.coalesce("source", nothing), line, F.lit("*** START OF THE PROJECT GUTENBERG EBOOK ONE ***"), line, F.coalesce("text", nothing), line, F.lit("*** END OF THIS PROJECT GUTENBERG EBOOK ONE ***\nlicence")
    )
    return table(spark, folder, "documents").select("doc_id", F.md5(text.between_markers(wrapped).cast("binary")).alias("body"))


_PARAS = f"list_filter(list_transform(regexp_split_to_array(text, '\\n\\s*\\n'), lambda p: {sql_strip('p')}), lambda p: p <> '')"


@query(f"""
SELECT doc_id, i - 1 AS position, {sql_words('ps[i]')} AS words, md5(ps[i]) AS paragraph
FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, {_PARAS} AS ps FROM documents WHERE text IS NOT NULL))""")
def proj_p10_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    rows = passages.paragraph_rows(table(spark, folder, "documents"), "doc_id", "text")
    return rows.select("doc_id", long(F.col("position"), "position"), long(F.col("words"), "words"), F.md5(F.col("paragraph").cast("binary")).alias("paragraph"))


@query(f"SELECT id, {sql_words('content')} AS words FROM clean_items")
def proj_p11_word_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "clean_items").select("id", long(text.word_count(F.col("content")), "words"))


_HEADED = "CASE WHEN lang = 'en' THEN 'CHAPTER XIV ' WHEN lang = 'fr' THEN 'Chapter 3 ' WHEN lang = 'de' THEN 'CHAPTER ONE ' WHEN lang = 'es' THEN 'IV. ' ELSE '' END || coalesce(text, '')"


@query(f"SELECT doc_id, coalesce({', '.join(f'nullif(regexp_extract(t, {chr(39)}{p}{chr(39)}, 1), {chr(39) * 2})' for p in text.CHAPTERS)}) AS chapter FROM (SELECT doc_id, {_HEADED} AS t FROM documents)")
def proj_p12_chapter(spark: SparkSession, folder: str) -> DataFrame:
    head = F.when(F.col("lang") == "en", "CHAPTER XIV ").when(F.col("lang") == "fr", "Chapter 3 ").when(F.col("lang") == "de", "CHAPTER ONE ").when(F.col("lang") == "es", "IV. ").otherwise("")
    return table(spark, folder, "documents").select("doc_id", text.chapter_marker(F.concat(head, F.coalesce("text", F.lit("")))).alias("chapter"))


_NAMES = "flatten([" + ", ".join(f"regexp_extract_all(text, '{p}', 1)" for p in text.ATTRIBUTIONS) + "])"


@query(f"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(list_filter({_NAMES}, lambda n: NOT list_contains({sql_list(text.NOT_NAMES)}, lower(n))), lambda n: upper(n[1]) || lower(n[2:])))), ',') AS names
FROM documents WHERE text IS NOT NULL""")
def proj_p13_speakers(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents")).where("text is not null").select("doc_id", joined(text.speaker_names(F.col("text")), "names"))


def _contains(c: str, *parts: str) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{p}')" for p in parts) + ")"


_PERSONA = (
    f"CASE WHEN {_contains('author_name', 'twain')} THEN 'twain' WHEN {_contains('author_name', 'franklin')} THEN 'franklin' "
    f"WHEN {_contains('source_url', 'twain')} THEN 'twain' WHEN {_contains('source_url', 'franklin')} THEN 'franklin' WHEN {_contains('source_url', 'reddit')} THEN 'neutral' "
    f"WHEN {_contains('book_title', *tags.TWAIN_TITLES)} THEN 'twain' ELSE 'neutral' END"
)
_TONE = f"CASE WHEN {_contains('author_name', 'franklin')} THEN 'didactic' ELSE 'humorous' END"
_LOW = "list_transform(coalesce(matched_keywords, []), lambda k: lower(k))"
_GENRES = "list_transform(coalesce(genre_tags, []), lambda k: lower(k))"
_HUMOROUS = f"(list_has_any({_LOW}, {sql_list(tags.HUMOR_WORDS)}) OR list_has_any({_GENRES}, ['humor', 'satire', 'comedy']))"


@query(f"""
SELECT passage_id, {_PERSONA} AS persona, {_TONE} AS tone, CASE WHEN {_HUMOROUS} THEN 'weather,humor' ELSE 'weather' END AS domains FROM passages""")
def proj_p17_item_tags(spark: SparkSession, folder: str) -> DataFrame:
    return tags.with_tags(table(spark, folder, "passages")).select("passage_id", "persona", "tone", joined(F.col("domain"), "domains"))


_ONION = f"CASE WHEN {_contains('subreddit', 'theonion')} AND NOT {_contains('subreddit', 'not')} THEN 'satirical' WHEN {_contains('subreddit', 'nottheonion')} THEN 'ironic' ELSE 'humorous' END"


@query(f"""
SELECT id, tone, CASE tone WHEN 'satirical' THEN 'reddit-theonion' WHEN 'ironic' THEN 'reddit-nottheonion' ELSE 'reddit-' || lower(coalesce(subreddit, '')) END AS source
FROM (SELECT id, subreddit, {_ONION} AS tone FROM posts)""")
def proj_p23_post_tags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "posts").select("id", tags.post_tags(F.col("subreddit")).alias("t")).select("id", "t.tone", "t.source")


@query(f"""
SELECT doc_id, md5(array_to_string(w[1:k], ' ')) AS part_one, md5(array_to_string(w[k + 1:], ' ')) AS part_two
FROM (SELECT doc_id, w, CAST(floor(len(w) * 0.6::DOUBLE) AS BIGINT) AS k FROM (SELECT doc_id, regexp_extract_all(text, {WORD}) AS w FROM documents WHERE text IS NOT NULL)) WHERE len(w) > 300""")
def proj_p28_two_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where(text.word_count(F.col("text")) > chat.MULTI_TURN)
    one, two = chat.two_parts(F.col("text"))
    return rows.select("doc_id", F.md5(one.cast("binary")).alias("part_one"), F.md5(two.cast("binary")).alias("part_two"))


@query(f"""
SELECT passage_id, persona, CASE WHEN coalesce(word_count, {sql_words('text')}) > 300 THEN 5 ELSE 3 END AS messages,
  CASE persona {' '.join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in chat.SYSTEM.items())} END AS system_prompt
FROM (SELECT *, {_PERSONA} AS persona FROM passages WHERE text IS NOT NULL AND text <> '')""")
def proj_p29_chats(spark: SparkSession, folder: str) -> DataFrame:
    rows = tags.with_tags(table(spark, folder, "passages").where("text is not null and text != ''"))
    n = F.coalesce(F.col("word_count"), text.word_count(F.col("text")))
    made = rows.select("passage_id", "persona", chat.chat(F.col("text"), n, F.col("persona"), F.col("passage_id")).alias("m"))
    return made.select("passage_id", "persona", long(F.size("m"), "messages"), F.get("m", F.lit(0))["content"].alias("system_prompt"))


@query("""
SELECT slug || '_' || lpad(CAST(row_number() OVER (PARTITION BY slug ORDER BY passage_id) - 1 AS VARCHAR), 4, '0') AS new_id, passage_id
FROM passages p JOIN books b ON p.book_id = b.book_id""")
def proj_p30_passage_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = joins.with_book(table(spark, folder, "passages"), table(spark, folder, "books"))
    return passages.passage_ids(rows, F.col("slug"), [F.col("passage_id")], "new_id").select("new_id", "passage_id")


@query("""
SELECT coalesce(tags.persona, 'unknown') || '-' || coalesce(tags.tone, 'unknown') || '-' || coalesce(tags.domain[1], 'unknown') AS stratum, count(*) AS n FROM conversation GROUP BY 1""")
def proj_p31_strata(spark: SparkSession, folder: str) -> DataFrame:
    s = chat.stratum(F.col("tags.persona"), F.col("tags.tone"), F.col("tags.domain"))
    return stats.histogram(table(spark, folder, "conversation"), s, "stratum")


_PLAIN = "list_filter(messages, lambda m: m.role = 'assistant' AND coalesce(len(m.tool_calls), 0) = 0)"
_FINAL = f"CASE WHEN len({_PLAIN}) > 0 THEN ({_PLAIN})[-1].content END"


@query(f"SELECT entry_id, {_FINAL} AS response FROM conversation")
def proj_p32_final_response(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversation").select("entry_id", chat.final_response(F.col("messages")).alias("response"))


def _sql_short(c: str) -> str:
    return f"right('000000000' || regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]', '', 'g'), 9)"


@query(f"SELECT entry_id, c.id AS call_id, {_sql_short('c.id')} AS short_id FROM (SELECT entry_id, unnest(flatten(list_transform(list_filter(messages, lambda m: len(m.tool_calls) > 0), lambda m: m.tool_calls))) AS c FROM conversation)")
def proj_p33_tool_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", F.explode(chat.calls(F.col("messages"))).alias("c"))
    return rows.select("entry_id", F.col("c.id").alias("call_id"), text.tool_id(F.col("c.id")).alias("short_id"))


@query(f"SELECT entry_id, array_to_string(list_transform(list_filter(messages, lambda m: m.role = 'tool' AND m.tool_call_id IS NOT NULL), lambda m: {_sql_short('m.tool_call_id')}), ',') AS refs FROM conversation")
def proj_p34_rewritten(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", chat.with_tool_ids(F.col("messages")).alias("m"))
    refs = F.transform(F.filter("m", lambda m: (m["role"] == "tool") & m["tool_call_id"].isNotNull()), lambda m: m["tool_call_id"])
    return rows.select("entry_id", joined(refs, "refs"))


_TOOL = "SELECT entry_id, unnest(list_filter(messages, lambda m: m.role = 'tool')) AS m FROM conversation"


@query(f"SELECT entry_id, CASE WHEN json_valid(m.content) THEN m.content END AS parsed FROM ({_TOOL}) WHERE m.content IS NOT NULL")
def proj_p35_fenced_json(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", F.explode(F.filter("messages", lambda m: m["role"] == "tool")).alias("m")).where("m.content is not null")
    return rows.select("entry_id", chat.fenced_json(F.concat(F.lit("Here it is:\n```json\n"), F.col("m.content"), F.lit("\n```\n"))).alias("parsed"))


_CALLS = "flatten(list_transform(list_filter(messages, lambda m: coalesce(len(m.tool_calls), 0) > 0), lambda m: m.tool_calls))"


@query(f"""
SELECT entry_id, len(messages) AS message_count, len({_CALLS}) AS tool_call_count, array_to_string(list_transform({_CALLS}, lambda c: c.function.name), ',') AS functions,
  len(list_filter(messages, lambda m: m.role = 'user')) AS turn_count FROM conversation""")
def proj_p36_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", chat.summary(F.col("messages")).alias("s"))
    return rows.select("entry_id", long(F.col("s.message_count"), "message_count"), long(F.col("s.tool_call_count"), "tool_call_count"), joined(F.col("s.function_names"), "functions"), long(F.col("s.turn_count"), "turn_count"))


@query("SELECT source, CAST(sum(length(coalesce(text, '')) // 4) AS BIGINT) AS tokens FROM documents GROUP BY source")
def proj_p38_token_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").groupBy("source").agg(F.sum(text.token_estimate(F.col("text"))).alias("tokens"))


@query("SELECT entry_id, md5(array_to_string(list_transform(messages, lambda m: '<|' || m.role || '|>' || chr(10) || coalesce(m.content, '') || chr(10)), '')) AS rendered FROM conversation")
def proj_p39_rendered(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversation").select("entry_id", F.md5(chat.rendered(F.col("messages")).cast("binary")).alias("rendered"))


# ---------------------------------------------------------------- joins


@query("SELECT p.passage_id, b.author, b.title, b.slug FROM passages p JOIN books b ON p.book_id = b.book_id")
def j1_book_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return joins.with_book(table(spark, folder, "passages"), table(spark, folder, "books")).select("passage_id", "author", "title", "slug")


_ARGS = f"SELECT entry_id, c.id AS call_id, c.function.name AS name, c.function.arguments AS a FROM (SELECT entry_id, unnest({_CALLS}) AS c FROM conversation)"
_POINTS = f"SELECT entry_id, call_id, TRY_CAST(json_extract_string(a, '$.latitude') AS DOUBLE) AS lat, TRY_CAST(json_extract_string(a, '$.longitude') AS DOUBLE) AS lon FROM ({_ARGS}) WHERE json_valid(a)"


def _calls(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", F.explode(chat.calls(F.col("messages"))).alias("c"))
    return rows.select("entry_id", F.col("c.id").alias("call_id"), F.col("c.function.name").alias("name"), F.col("c.function.arguments").alias("a"))


@query(f"""
SELECT entry_id, call_id, arg_min(city, {{'d': (l.latitude - lat) * (l.latitude - lat) + (l.longitude - lon) * (l.longitude - lon), 'p': pos}}) AS city
FROM ({_POINTS}) CROSS JOIN locations l WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY entry_id, call_id, lat, lon""")
def j4_nearest_location(spark: SparkSession, folder: str) -> DataFrame:
    points = _calls(spark, folder).select("entry_id", "call_id", validate._json(F.col("a"), "$.latitude", "double").alias("lat"), validate._json(F.col("a"), "$.longitude", "double").alias("lon"))
    points = points.where("lat is not null and lon is not null").distinct()
    return joins.nearest(points, F.col("lat"), F.col("lon"), table(spark, folder, "locations")).select("entry_id", "call_id", F.col("place.city").alias("city"))


@query(f"""
SELECT entry_id, call_id, l.city IS NOT NULL AS found, l.latitude, l.longitude
FROM (SELECT * FROM ({_ARGS}) WHERE name = 'geocode_location' AND json_valid(a)) g
LEFT JOIN locations l ON lower(json_extract_string(a, '$.city')) = lower(l.city) AND lower(json_extract_string(a, '$.country')) = lower(l.country)""")
def j5_geocode(spark: SparkSession, folder: str) -> DataFrame:
    asked = _calls(spark, folder).where((F.col("name") == "geocode_location") & F.try_parse_json("a").isNotNull())
    found = joins.geocoded(asked, validate._json(F.col("a"), "$.city", "string"), validate._json(F.col("a"), "$.country", "string"), table(spark, folder, "locations"))
    return found.select("entry_id", "call_id", "found", F.col("place_latitude").alias("latitude"), F.col("place_longitude").alias("longitude"))


@query(f"""
SELECT entry_id, len(list_filter(messages, lambda m: m.role = 'tool' AND list_contains(list_transform({_CALLS}, lambda c: c.id), m.tool_call_id))) AS answered, len(list_filter(messages, lambda m: m.role = 'tool')) AS told
FROM conversation""")
def j6_call_references(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", validate.references(F.col("messages")).alias("r"))
    return rows.select("entry_id", long(F.col("r.answered"), "answered"), long(F.col("r.told"), "told"))


# ---------------------------------------------------------------- aggregations


_EXACT = "SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY md5(lower(trim(coalesce(content, '')))) ORDER BY id) AS r FROM clean_items) WHERE r = 1"


@query(_EXACT)
def o13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact(table(spark, folder, "clean_items"), "id", "content").select("id")


@query(f"""
SELECT a AS original, b AS unique_rows, a - b AS removed, round_even((a - b) * 100.0 / a, 2)::DOUBLE AS rate FROM (SELECT (SELECT count(*) FROM clean_items) AS a, (SELECT count(*) FROM ({_EXACT})) AS b)""")
def a3_dedup_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "clean_items")
    return dedup.duplicate_stats(rows, dedup.exact(rows, "id", "content"))


_STAGES = f"""
WITH base AS (SELECT id, nfc_normalize(content) AS content FROM clean_items),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY md5(lower(trim(coalesce(content, '')))) ORDER BY id) AS r FROM base) WHERE r = 1),
l AS (SELECT id FROM ({_sql_language('content', 'd')}) WHERE language = 'en'),
s AS (SELECT l.id FROM l JOIN ({_VERDICTS}) v ON l.id = v.item_id WHERE f = 0)
SELECT 'loaded' AS stage, 0 AS place, count(*) AS n FROM base UNION ALL SELECT 'dedup', 1, count(*) FROM d UNION ALL SELECT 'language', 2, count(*) FROM l UNION ALL SELECT 'safety', 3, count(*) FROM s"""


@query(_STAGES)
def a4_stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    items = spread(table(spark, folder, "clean_items").select("id", "content"))
    run = pipelines.normalize(items, "id", joins.verdicts(table(spark, folder, "safety_labels")), {"deduplication": {"mode": "exact"}})
    return run.counts()


@query()
def a4_stage_counts_near(spark: SparkSession, folder: str) -> DataFrame:
    items = spread(table(spark, folder, "clean_items").select("id", "content"))
    return pipelines.normalize(items, "id", joins.verdicts(table(spark, folder, "safety_labels"))).counts()


@query()
def a4_stage_counts_model(spark: SparkSession, folder: str) -> DataFrame:
    """The same with languages told by the learned model."""
    items = spread(table(spark, folder, "clean_items").select("id", "content"))
    model = language.learned(table(spark, folder, "documents"), other=items.select(F.col("content").alias("text")))
    return pipelines.normalize(items, "id", joins.verdicts(table(spark, folder, "safety_labels")), model=model).counts()


@query("""
SELECT count(*) AS passages, count(DISTINCT book_title) AS books, count(DISTINCT author_name) AS authors, count(*) FILTER (context_type = 'both') AS both_contexts,
  count(*) FILTER (context_type = 'weather') AS weather_contexts, count(*) FILTER (context_type = 'humor') AS humor_contexts, min(word_count) AS least, max(word_count) AS most, avg(word_count) AS mean_words FROM passages""")
def a5_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return stats.corpus(table(spark, folder, "passages"))


@query("SELECT term, n FROM (SELECT term, count(*) AS n FROM (SELECT unnest(matched_keywords) AS term FROM passages) GROUP BY term) ORDER BY n DESC, term LIMIT 10")
def o5_top_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return stats.top_terms(table(spark, folder, "passages"), F.col("matched_keywords"))


@query("""
SELECT subreddit, count(*) AS n, avg(length(title)) AS mean_title, avg(CAST(id IS NOT NULL AND subreddit IS NOT NULL AND created_utc IS NOT NULL AND url IS NOT NULL AS INT)) * 100 AS complete_percent FROM posts GROUP BY subreddit""")
def a6_posts(spark: SparkSession, folder: str) -> DataFrame:
    return stats.posts(table(spark, folder, "posts"))


@query("""
SELECT source_file, count(*) AS loaded, count(*) FILTER (content IS NOT NULL AND content <> '') AS filled, count(*) FILTER (length(content) >= 50) AS long_enough FROM clean_items GROUP BY source_file""")
def a7_file_counts(spark: SparkSession, folder: str) -> DataFrame:
    n = F.length("content")
    return stats.file_counts(table(spark, folder, "clean_items"), {"loaded": F.lit(True), "filled": n > 0, "long_enough": n >= 50})


@query("""
WITH c AS (SELECT split, tags.persona AS persona, tags.tone AS tone, tags.domain AS domain FROM conversation), t AS (SELECT split, count(*) AS items FROM c GROUP BY split),
v AS (SELECT split, 'persona' AS tag, persona AS value FROM c UNION ALL SELECT split, 'tone', tone FROM c UNION ALL SELECT split, 'domain', unnest(domain) FROM c)
SELECT v.split, tag, value, count(*) AS n, count(*) * 100 / any_value(items) AS percent FROM v JOIN t ON v.split = t.split WHERE value IS NOT NULL AND value <> '' GROUP BY v.split, tag, value""")
def a8_tag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stats.tag_counts(table(spark, folder, "conversation").select("split", "tags.persona", "tags.tone", "tags.domain"), "split", ["persona", "tone", "domain"])


@query("SELECT count(*) FILTER (len(messages) = 3) AS single_turn, count(*) FILTER (len(messages) <> 3) AS multi_turn FROM conversation WHERE len(messages) > 0")
def a9_turns(spark: SparkSession, folder: str) -> DataFrame:
    return stats.turns(table(spark, folder, "conversation"), F.col("messages"))


@query("""
SELECT count(*) AS answers, avg(n) AS mean, min(n) AS least, max(n) AS most FROM (SELECT length(m.content) AS n FROM (SELECT unnest(messages) AS m FROM conversation) WHERE m.role = 'assistant' AND m.content IS NOT NULL)""")
def a10_answer_lengths(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.answer_lengths(table(spark, folder, "conversation"), F.col("messages"))
    return out.select("answers", "mean", long(F.col("least"), "least"), long(F.col("most"), "most"))


@query("""
WITH c AS (SELECT coalesce(tags.persona, 'unknown') AS v, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'validation') AS b FROM conversation WHERE split IN ('train', 'validation') GROUP BY 1),
t AS (SELECT sum(a) AS ta, sum(b) AS tb FROM c)
SELECT round(1 - sum(abs(a / ta - b / tb)) / 2, 9) AS similarity FROM c, t""")
def a11_split_similarity(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("split", "tags.persona")
    return stats.similarity(rows, "split", "persona", "train", "validation").select(F.round("similarity", 9).alias("similarity"))


@query(" UNION ALL ".join(f"SELECT '{k}' AS pattern, count(*) FILTER (contains(lower(text), '{p}')) AS n, count(*) FILTER (contains(lower(text), '{p}')) * 100 / count(*) AS percent FROM documents" for k, p in PHRASES.items()))
def a12_template_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stats.template_counts(table(spark, folder, "documents"), F.col("text"), PHRASES)


_PHRASES4 = f"SELECT unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) AS term FROM (SELECT regexp_extract_all(lower(r), {WORD}) AS w FROM (SELECT {_FINAL} AS r FROM conversation) WHERE r IS NOT NULL) WHERE len(w) >= 4"


@query(f"SELECT term, n FROM (SELECT term, count(*) AS n FROM ({_PHRASES4}) GROUP BY term ORDER BY n DESC, term LIMIT 20) WHERE n > 5")
def a13_top_phrases(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "conversation")).select(chat.final_response(F.col("messages")).alias("r"))
    return stats.top_phrases(rows, F.col("r"))


@query(f"""
SELECT CASE WHEN w <= 10 THEN '1-10' WHEN w <= 25 THEN '11-25' WHEN w <= 50 THEN '26-50' ELSE '51+' END AS bucket, count(*) AS n
FROM (SELECT {sql_words('r')} AS w FROM (SELECT {_FINAL} AS r FROM conversation) WHERE r IS NOT NULL) GROUP BY 1""")
def a14_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select(chat.final_response(F.col("messages")).alias("r"))
    return stats.length_buckets(rows, F.col("r"))


@query("SELECT coalesce(tags.persona, 'unknown') AS persona, count(*) AS n FROM conversation GROUP BY 1")
def a15_personas(spark: SparkSession, folder: str) -> DataFrame:
    return stats.histogram(table(spark, folder, "conversation"), F.col("tags.persona"), "persona")


_TEMPLATED = " + ".join(f"contains(lower(r), '{p.lower().replace(chr(39), chr(39) * 2)}')::BIGINT" for p in stats.TEMPLATES.values())


@query(f"""
WITH r AS (SELECT r FROM (SELECT {_FINAL} AS r FROM conversation) WHERE r IS NOT NULL), s AS (SELECT count(*) AS n, count(DISTINCT r) AS u, sum({_TEMPLATED}) AS t FROM r),
m AS (SELECT max(c) AS m FROM (SELECT count(*) AS c FROM ({_PHRASES4}) GROUP BY term)),
d AS (SELECT n AS responses, u / n AS unique_ratio, (n - t) / n AS template_free, 1 - m / n AS phrase_diversity FROM s, m),
e AS (SELECT *, (unique_ratio * 0.3 + template_free * 0.5 + phrase_diversity * 0.2) * 100 AS score FROM d)
SELECT responses, unique_ratio, template_free, phrase_diversity, round(score, 9) AS score, CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 75 THEN 'good' WHEN score >= 60 THEN 'fair' ELSE 'poor' END AS label FROM e""")
def a16_diversity(spark: SparkSession, folder: str) -> DataFrame:
    return stats.diversity(spread(table(spark, folder, "conversation")), F.col("messages")).withColumn("score", F.round("score", 9))


@query("""
WITH c AS (SELECT coalesce(tags.scenario, 'unknown') AS scenario, coalesce(tags.persona, 'unknown') AS persona, coalesce(metadata.query_type, 'unknown') AS query_type, metadata.location.city AS city FROM conversation),
v AS (SELECT 'scenario' AS kind, scenario AS value, city FROM c UNION ALL SELECT 'persona', persona, city FROM c UNION ALL SELECT 'query_type', query_type, city FROM c)
SELECT kind, value, count(*) AS n, count(*) * 100 / (SELECT count(*) FROM c) AS percent, count(DISTINCT city) AS cities FROM v GROUP BY kind, value""")
def a17_generation(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("tags.scenario", "tags.persona", "metadata.query_type", F.col("metadata.location.city").alias("city"))
    return stats.generation(rows, ["scenario", "persona", "query_type"], "city")


@query("""
WITH c AS (SELECT coalesce(tags.persona, 'unknown') AS persona, coalesce(tags.scenario, 'unknown') AS scenario FROM conversation),
v AS (SELECT 'persona' AS kind, persona AS value FROM c UNION ALL SELECT 'scenario', scenario FROM c UNION ALL SELECT 'humor_ratio', CASE WHEN persona IN ('riverman', 'newsdesk') THEN 'humorous' ELSE 'plain' END FROM c)
SELECT kind, value, count(*) AS n, count(*) * 100 / (SELECT count(*) FROM c) AS percent FROM v GROUP BY kind, value""")
def a19_merge_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.merge_stats(table(spark, folder, "conversation"), F.col("tags.persona"), F.col("tags.scenario"), ("riverman", "newsdesk"))


@query("SELECT count(*) AS calls, avg(CAST(event_type <> 'error' AS INT)) * 100 AS succeeded_percent, CAST(sum(user_id) AS BIGINT) AS tokens, round(avg(value), 6) AS mean_latency FROM events")
def a20_calls_log(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "events").select((F.col("event_type") != "error").alias("ok"), F.col("user_id").alias("tokens"), F.col("value").alias("latency"))
    return stats.calls_log(log).withColumn("mean_latency", F.round("mean_latency", 6))


@query("SELECT min(n) AS least, max(n) AS most, avg(n) AS mean, median(n) AS median FROM (SELECT length(text) AS n FROM documents WHERE text IS NOT NULL)")
def a21_lengths(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.lengths(table(spark, folder, "documents"), F.col("text"))
    return out.select(long(F.col("least"), "least"), long(F.col("most"), "most"), "mean", "median")


# ---------------------------------------------------------------- ordering, sampling, sets


_MOST = 300
_BALANCED = f"""
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC NULLS LAST, doc_id) AS k FROM documents WHERE source IS NOT NULL),
g AS (SELECT source, count(*) AS size FROM r GROUP BY source),
h AS (SELECT *, CASE WHEN (SELECT count(*) FROM g) = 1 THEN least(size, {_MOST}) ELSE least(size, {_MOST} // 2) END AS head FROM g),
p AS (SELECT *, size - head AS spare, greatest({_MOST} - sum(head) OVER (), 0) AS rest,
  coalesce(sum(head) OVER w, 0) AS head_before, coalesce(sum(size - head) OVER w, 0) AS spare_before FROM h
  WINDOW w AS (ORDER BY size DESC, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
q AS (SELECT source, least(head, greatest({_MOST} - head_before, 0)) + least(spare, greatest(rest - spare_before, 0)) AS quota FROM p)
SELECT r.doc_id, r.source FROM r JOIN q ON r.source = q.source WHERE k <= quota"""


@query(_BALANCED)
def o2_balanced_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.balanced(table(spark, folder, "documents").select("doc_id", "source", "n_chars"), "source", "n_chars", "doc_id", _MOST).select("doc_id", "source")


@query()
def o3_passages(spark: SparkSession, folder: str) -> DataFrame:
    rows = pipelines.collect_passages(spread(table(spark, folder, "documents")), "doc_id", "text", options={"passages": {"least": 40}}, weather=keywords.EXPANDED)
    return rows.select("doc_id", "begin", "end", "word_count", "context_type", joined(F.col("matched_keywords"), "matched"), joined(F.col("character_names"), "names"))


@query("SELECT passage_id, relevance_score FROM passages ORDER BY relevance_score DESC NULLS LAST, passage_id LIMIT 100")
def o4_top_relevance(spark: SparkSession, folder: str) -> DataFrame:
    return passages.top(table(spark, folder, "passages").select("passage_id", "relevance_score"), 100, [F.desc_nulls_last("relevance_score"), F.col("passage_id")])


@query("""
SELECT doc_id, CASE WHEN k <= (n * 9) // 10 THEN 'train' ELSE 'validation' END AS split
FROM (SELECT doc_id, row_number() OVER (PARTITION BY coalesce(lang, 'unknown'), coalesce(source, 'unknown') ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS k,
  count(*) OVER (PARTITION BY coalesce(lang, 'unknown'), coalesce(source, 'unknown')) AS n FROM documents)""")
def o6_stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split(table(spark, folder, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id").select("doc_id", "split")


@query("""
SELECT entry_id, CASE WHEN k <= (n * 9) // 10 THEN 'train' ELSE 'validation' END AS new_split
FROM (SELECT entry_id, row_number() OVER (PARTITION BY coalesce(tags.persona, 'unknown') ORDER BY md5(CAST(entry_id AS VARCHAR)), entry_id) AS k, count(*) OVER (PARTITION BY coalesce(tags.persona, 'unknown')) AS n FROM conversation)""")
def o7_persona_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", F.col("tags.persona").alias("persona"))
    return sampling.split(rows, ["persona"], "entry_id", keep_one=False).select("entry_id", F.col("split").alias("new_split"))


_PATTERN = "CASE " + " ".join(f"WHEN contains(lower(text), '{p}') THEN '{k}'" for k, p in PHRASES.items()) + " END"


@query(f"""
SELECT doc_id, pattern, pattern IS NOT NULL AND k > 100 AS regenerate FROM (SELECT doc_id, pattern, row_number() OVER (PARTITION BY pattern ORDER BY doc_id) AS k FROM (SELECT doc_id, {_PATTERN} AS pattern FROM documents))""")
def o8_template_cap(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.template_cap(table(spark, folder, "documents").select("doc_id", "text"), "text", "doc_id", PHRASES).select("doc_id", "pattern", "regenerate")


@query(f"""
WITH p AS (SELECT doc_id, i AS position, ps[i] AS t FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, {_PARAS} AS ps FROM documents WHERE text IS NOT NULL)))
SELECT doc_id, position - 1 AS position, md5(string_agg(t, ' ') OVER (PARTITION BY doc_id ORDER BY position ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) AS around FROM p""")
def o11_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = passages.windows(passages.paragraph_rows(table(spark, folder, "documents"), "doc_id", "text"), "doc_id")
    return rows.select("doc_id", long(F.col("position"), "position"), F.md5(F.col("around").cast("binary")).alias("around"))


@query("""
SELECT d AS digest, min(id) AS kept, count(*) AS n FROM (SELECT id, md5(lower(trim(coalesce(content, '')))) AS d FROM clean_items) GROUP BY d HAVING count(*) > 1""")
def o13_copies(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.copies(table(spark, folder, "clean_items"), "id", "content")


_LOWER = "lower(trim(coalesce(text, '')))"
_SHINGLES = f"SELECT DISTINCT doc_id, CASE WHEN length(t) < 3 THEN t ELSE substr(t, i, 3) END AS s FROM (SELECT doc_id, t, unnest(range(1, greatest(length(t) - 1, 2))) AS i FROM (SELECT doc_id, {_LOWER} AS t FROM documents))"


@query(f"SELECT doc_id, count(*) AS shingles FROM ({_SHINGLES}) GROUP BY doc_id")
def proj_p14_shingles(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents")).select("doc_id", long(F.size(dedup.shingles(F.col("text"))), "shingles"))


def _sql_bands() -> str:
    b, r = dedup.band_shape(0.8)
    perms = ", ".join(f"({k}, {a}, {c})" for k, (a, c) in enumerate(dedup.coefficients(b * r)))
    x = f"SELECT doc_id, ('0x' || substr(md5(s), 1, 7))::BIGINT AS x FROM ({_SHINGLES})"
    sig = f"SELECT doc_id, k, min((a * x + c) % {dedup.PRIME}) AS h FROM ({x}) CROSS JOIN (VALUES {perms}) p(k, a, c) WHERE k < {b * r} GROUP BY doc_id, k"
    return f"SELECT doc_id AS id, k // {r} AS band, md5(string_agg(CAST(h AS VARCHAR), ',' ORDER BY k)) AS key FROM ({sig}) GROUP BY doc_id, k // {r}"


@query(_sql_bands())
def j3_lsh_bands(spark: SparkSession, folder: str) -> DataFrame:
    rows = dedup.band_rows(spread(table(spark, folder, "documents")), "doc_id", "text")
    return rows.select("id", long(F.col("band"), "band"), "key")


@query(f"""
WITH b AS MATERIALIZED ({_sql_bands()}), m AS (SELECT x.id, min(y.least) AS m FROM b x JOIN (SELECT band, key, min(id) AS least FROM b GROUP BY band, key) y ON x.band = y.band AND x.key = y.key GROUP BY x.id),
r AS (SELECT band, key, min(m) AS reach FROM b JOIN m ON b.id = m.id GROUP BY band, key)
SELECT DISTINCT b.id FROM b JOIN r ON b.band = r.band AND b.key = r.key WHERE reach < b.id""")
def o13_lsh_removed(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_first(dedup.band_rows(spread(table(spark, folder, "documents")), "doc_id", "text"))


# ---------------------------------------------------------------- validation


_ROLES = "array_to_string(list_transform(messages, lambda m: CASE m.role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' WHEN 'tool' THEN 't' ELSE 'x' END), '')"


@query(f"SELECT entry_id, coalesce(regexp_matches({_ROLES}, '^s(ua(t+a)*)+$'), false) AS valid FROM conversation")
def v3_role_order(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversation").select("entry_id", validate.roles_error(F.col("messages")).isNull().alias("valid"))


_CALL_ERROR = "CASE WHEN c.id IS NULL THEN 'Missing ''id'' field' WHEN c.type IS NULL THEN 'Missing ''type'' field' WHEN c.type <> 'function' THEN 'Invalid type: ' || c.type WHEN c.function IS NULL THEN 'Missing ''function'' field' WHEN c.function.name IS NULL THEN 'Missing ''name'' in function' WHEN c.function.arguments IS NULL THEN 'Missing ''arguments'' in function' WHEN NOT json_valid(c.function.arguments) THEN 'Invalid JSON in ''arguments''' END"


@query(f"SELECT entry_id, c.id AS call_id, {_CALL_ERROR} AS error FROM (SELECT entry_id, unnest({_CALLS}) AS c FROM conversation)")
def v2_call_errors(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversation").select("entry_id", F.explode(chat.calls(F.col("messages"))).alias("c"))
    return rows.select("entry_id", F.col("c.id").alias("call_id"), validate.call_error(F.col("c")).alias("error"))


@query(f"""
SELECT entry_id, coalesce(messages IS NOT NULL AND len(messages) > 0 AND regexp_matches({_ROLES}, '^s(ua(t+a)*)+$') AND tags.persona IS NOT NULL AND tags.tone IS NOT NULL AND tags.domain IS NOT NULL
  AND len(list_filter(messages, lambda m: m.role IS NULL OR (m.role = 'tool' AND (m.tool_call_id IS NULL OR m.content IS NULL)) OR (m.role <> 'tool' AND NOT (m.role = 'assistant' AND coalesce(len(m.tool_calls), 0) > 0) AND m.content IS NULL)
    OR (m.role <> 'assistant' AND coalesce(len(m.tool_calls), 0) > 0))) = 0
  AND len(list_filter({_CALLS}, lambda c: ({_CALL_ERROR}) IS NOT NULL)) = 0, false) AS valid FROM conversation""")
def v1_chat_entries(spark: SparkSession, folder: str) -> DataFrame:
    e = validate.entry_error(F.col("messages"), F.col("tags.persona"), F.col("tags.tone"), F.col("tags.domain"))
    return table(spark, folder, "conversation").select("entry_id", e.isNull().alias("valid"))


@query()
def v4_chat_errors(spark: SparkSession, folder: str) -> DataFrame:
    return writers.verify_entries(table(spark, folder, "conversation"))


@query("""
SELECT entry_id, CASE WHEN messages IS NULL OR len(messages) = 0 THEN 'no messages' WHEN messages[1].role <> 'system' THEN 'first message must be system' WHEN messages[-1].role <> 'assistant' THEN 'last message must be assistant'
  WHEN len(list_filter(messages, lambda m: m.role IS NULL OR (m.content IS NULL AND coalesce(len(m.tool_calls), 0) = 0))) > 0 THEN 'invalid message' END AS error FROM conversation""")
def v5_weak_check(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversation").select("entry_id", validate.weak_error(F.col("messages")).alias("error"))


def _sql_parameters(name: str = "name", a: str = "a") -> str:
    out = "CASE WHEN NOT json_valid(a) OR json_type(a) <> 'OBJECT' THEN 'Invalid JSON in ''arguments''' WHEN NOT list_contains(" + sql_list(list(validate.TOOLS)) + ", name) THEN 'Unknown function: ' || name"
    for tool, params in validate.TOOLS.items():
        names = sql_list([p[0] for p in params])
        missing, unknown = f"list_filter({names}, lambda x: NOT list_contains(json_keys(a), x))", f"list_filter(json_keys(a), lambda x: NOT list_contains({names}, x))"
        out += f" WHEN name = '{tool}' AND len({missing}) > 0 THEN 'Missing required parameter: ' || ({missing})[1] WHEN name = '{tool}' AND len({unknown}) > 0 THEN 'Unknown parameter: ' || ({unknown})[1]"
        for p, kind, least, most in params:
            t, v = f"json_type(a, '$.{p}')", f"CAST(json_extract_string(a, '$.{p}') AS DOUBLE)"
            if kind == "string":
                out += f" WHEN name = '{tool}' AND {t} <> 'VARCHAR' THEN 'Parameter ''{p}'' must be a string'"
                continue
            kinds = "('UBIGINT', 'BIGINT', 'BOOLEAN')" if kind == "integer" else "('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN')"
            out += f" WHEN name = '{tool}' AND {t} NOT IN {kinds} THEN 'Parameter ''{p}'' must be {'an integer' if kind == 'integer' else 'a number'}'"
            out += f" WHEN name = '{tool}' AND {v} < {least} THEN 'Parameter ''{p}'' below minimum: {least}' WHEN name = '{tool}' AND {v} > {most} THEN 'Parameter ''{p}'' above maximum: {most}'"
    return re.sub(r"\ba\b(?=[,)])", a, re.sub(r"\bname\b", name, out)) + " END"


@query(f"SELECT entry_id, call_id, {_sql_parameters()} AS error FROM ({_ARGS}) WHERE a IS NOT NULL")
def v6_parameter_errors(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder).where("a is not null").select("entry_id", "call_id", validate.parameters_error(F.col("name"), F.col("a")).alias("error"))


_FAULTS = f"list_filter(list_transform({_CALLS}, lambda c: {_sql_parameters('c.function.name', 'c.function.arguments')}), lambda e: e IS NOT NULL)"


@query(f"SELECT entry_id, ({_FAULTS})[1] AS error FROM conversation")
def v7_calls_error(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversation").select("entry_id", validate.calls_error(F.col("messages")).alias("error"))


_CALLING = "list_filter(messages, lambda m: m.role = 'assistant' AND coalesce(len(m.tool_calls), 0) > 0)"
_KNOWN = sql_list(validate.CONDITIONS)


@query(f"""
WITH c AS (SELECT entry_id, ({_CALLING})[-1].tool_calls[1].function AS f, (list_filter(messages, lambda m: m.role = 'tool'))[-1].content AS told FROM conversation),
d AS (SELECT entry_id, f IS NULL OR told IS NULL AS nothing, f.name AS name, CASE WHEN json_valid(f.arguments) THEN f.arguments END AS a, CASE WHEN json_valid(told) THEN told END AS j FROM c),
e AS (SELECT *, TRY_CAST(json_extract_string(a, '$.latitude') AS DOUBLE) AS lat, TRY_CAST(json_extract_string(a, '$.longitude') AS DOUBLE) AS lon, TRY_CAST(json_extract_string(j, '$.temperature') AS DOUBLE) AS t,
  coalesce(json_extract_string(j, '$.condition'), 'unknown') AS cond, TRY_CAST(json_extract_string(j, '$.humidity') AS DOUBLE) AS hum FROM d),
p AS (SELECT entry_id, arg_min({{'city': city, 'lo': least(summer_lo, winter_lo) - 15, 'hi': greatest(summer_hi, winter_hi) + 15}}, {{'d': (l.latitude - lat) * (l.latitude - lat) + (l.longitude - lon) * (l.longitude - lon), 'p': pos}}) AS place
  FROM e CROSS JOIN locations l WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY entry_id)
SELECT e.entry_id, CASE WHEN nothing THEN NULL WHEN j IS NULL THEN 'Tool response is not valid JSON' WHEN json_extract_string(j, '$.error') = 'true' THEN NULL
  WHEN name = 'get_current_weather' AND t IS NOT NULL THEN CASE WHEN t NOT BETWEEN -60 AND 60 THEN 'Temperature ' || CAST(t AS VARCHAR) || '°C out of reasonable range'
    WHEN t NOT BETWEEN place.lo AND place.hi THEN 'Temperature ' || CAST(t AS VARCHAR) || '°C unrealistic for ' || place.city
    WHEN NOT list_contains({_KNOWN}, cond) THEN 'Invalid weather condition: ' || cond WHEN hum NOT BETWEEN 0 AND 100 THEN 'Humidity out of range (0-100)' END
  WHEN name = 'get_forecast' AND json_type(j, '$.daily') = 'ARRAY' AND json_array_length(j, '$.daily') <> coalesce(TRY_CAST(json_extract_string(a, '$.days') AS BIGINT), 0)
    THEN 'Forecast days mismatch: requested ' || coalesce(json_extract_string(a, '$.days'), '0') || ', got ' || json_array_length(j, '$.daily') END AS error
FROM e LEFT JOIN p ON e.entry_id = p.entry_id""")
def v8_weather_errors(spark: SparkSession, folder: str) -> DataFrame:
    lat, lon = validate.asked_point(F.col("messages"))
    rows = joins.nearest(spread(table(spark, folder, "conversation")).select("entry_id", "messages"), lat, lon, table(spark, folder, "locations"))
    return rows.select("entry_id", validate.weather_error(F.col("messages"), F.col("place")).alias("error"))


_TOLD = "(list_filter(messages, lambda m: m.role = 'tool'))[-1].content"


@query(f"""
WITH c AS (SELECT entry_id, {_TOLD} AS told, {_FINAL} AS said FROM conversation),
d AS (SELECT entry_id, told, said, lower(coalesce(said, '')) AS low, CASE WHEN json_valid(told) THEN told END AS j FROM c),
e AS (SELECT *, TRY_CAST(json_extract_string(j, '$.temperature') AS DOUBLE) AS t, json_extract_string(j, '$.condition') AS cond, json_extract_string(j, '$.location') AS loc FROM d)
SELECT entry_id, CASE WHEN told IS NULL OR said IS NULL THEN 1.0 WHEN j IS NULL THEN 0.0
  WHEN coalesce(json_extract_string(j, '$.error'), 'false') = 'true' THEN CASE WHEN contains(low, 'error') OR contains(low, 'sorry') OR contains(low, 'apologize') THEN 1.0 ELSE 0.0 END
  WHEN t IS NULL AND cond IS NULL AND loc IS NULL THEN 1.0
  ELSE (CASE WHEN t IS NOT NULL AND contains(low, CAST(trunc(t)::BIGINT AS VARCHAR)) THEN 1 ELSE 0 END + CASE WHEN cond IS NOT NULL AND contains(low, lower(replace(cond, '_', ' '))) THEN 1 ELSE 0 END
    + CASE WHEN loc IS NOT NULL AND len(list_filter(string_split(lower(loc), ','), lambda p: contains(low, p))) > 0 THEN 1 ELSE 0 END) / ((t IS NOT NULL)::INT + (cond IS NOT NULL)::INT + (loc IS NOT NULL)::INT) END::DOUBLE AS score FROM e""")
def v9_groundedness(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversation").select("entry_id", validate.groundedness(F.col("messages")).cast("double").alias("score"))


_KINDS = f"""
SELECT c.entry_id, NOT coalesce(v1.valid, false) AS chat, v7.error IS NOT NULL AS schema, v8.error IS NOT NULL AS semantic, v9.score < 0.5 AS grounded
FROM conversation c LEFT JOIN ({SQL["v1_chat_entries"]}) v1 ON c.entry_id = v1.entry_id LEFT JOIN ({SQL["v7_calls_error"]}) v7 ON c.entry_id = v7.entry_id
LEFT JOIN ({SQL["v8_weather_errors"]}) v8 ON c.entry_id = v8.entry_id LEFT JOIN ({SQL["v9_groundedness"]}) v9 ON c.entry_id = v9.entry_id"""
_FIRST_KIND = "CASE WHEN chat THEN 'Chat format' WHEN schema THEN 'JSON schema' WHEN semantic THEN 'Semantic' WHEN grounded THEN 'Groundedness' ELSE 'valid' END"


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    rows = spread(table(spark, folder, "conversation")).select("entry_id", "messages", F.struct("tags.persona", "tags.tone", "tags.domain").alias("tags"))
    return generate.checked(rows, table(spark, folder, "locations"))


@query(f"SELECT {_FIRST_KIND} AS kind, count(*) AS n FROM ({_KINDS}) GROUP BY kind")
def a18_failures(spark: SparkSession, folder: str) -> DataFrame:
    return stats.failures(_checked(spark, folder), F.col("errors"))


@query(f"""
SELECT count(*) AS total, count(*) FILTER (k = 'valid') AS passed, count(*) FILTER (k <> 'valid') AS failed, avg(CAST(k = 'valid' AS INT)) * 100 AS percent FROM (SELECT {_FIRST_KIND} AS k FROM ({_KINDS}))""")
def a18_pass_rate(spark: SparkSession, folder: str) -> DataFrame:
    return stats.pass_rate(_checked(spark, folder), F.col("errors"))


@query(f"SELECT entry_id, {_FIRST_KIND} AS kind FROM ({_KINDS}) WHERE {_FIRST_KIND} <> 'valid' ORDER BY entry_id LIMIT 10")
def a18_samples(spark: SparkSession, folder: str) -> DataFrame:
    found = stats.failure_samples(_checked(spark, folder), "entry_id", F.col("errors"))
    return found.select("entry_id", F.element_at(F.split("error", ":"), 1).alias("kind"))


@query(f"""
SELECT entry_id, array_to_string(list_filter([CASE WHEN chat THEN 'Chat format' END, CASE WHEN schema THEN 'JSON schema' END, CASE WHEN semantic THEN 'Semantic' END, CASE WHEN grounded THEN 'Groundedness' END], lambda x: x IS NOT NULL), ',') AS kinds FROM ({_KINDS})""")
def v10_error_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder).select("entry_id", joined(F.transform("errors", lambda e: F.element_at(F.split(e, ":"), 1)), "kinds"))


@query("SELECT id, array_to_string(list_filter([CASE WHEN id IS NULL THEN 'id' END, CASE WHEN content IS NULL THEN 'content' END, CASE WHEN source IS NULL THEN 'source' END], lambda x: x IS NOT NULL), ',') AS missing FROM clean_items")
def v11_missing_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "clean_items")
    return rows.select("id", joined(readers.missing_fields(rows, ["id", "content", "source"]), "missing"))


@query("SELECT valid, count(*) AS n FROM (SELECT coalesce(list_transform(messages, lambda m: m.role) = ['system', 'user', 'assistant'] AND tags IS NOT NULL, false) AS valid FROM conversation) GROUP BY valid")
def k6_post_verification(spark: SparkSession, folder: str) -> DataFrame:
    return writers.verify_posts(table(spark, folder, "conversation"))


# ---------------------------------------------------------------- generators, pipelines, streams


@query("SELECT pos, city FROM locations WHERE lower(climate_zone) = 'temperate'")
def g8_location_zones(spark: SparkSession, folder: str) -> DataFrame:
    return joins.locations_where(table(spark, folder, "locations"), climate="temperate").select("pos", "city")


@query()
def g5_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = generate.conversations(spark, 2000, table(spark, folder, "locations"))
    return rows.select("metadata.conversation_id", "tags.persona", "tags.scenario", "metadata.query_type", F.to_json("messages").alias("messages"))


@query()
def g6_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return generate.accepted(spark, 500, table(spark, folder, "locations")).select("metadata.conversation_id", "tags.persona", "tags.scenario", F.size("messages").alias("messages"))


@query()
def pipeline_instruct(spark: SparkSession, folder: str) -> DataFrame:
    rows = pipelines.instruct(spread(table(spark, folder, "passages")).dropDuplicates(["passage_id"]), "passage_id").rows
    return rows.select("passage_id", "persona", "tone", joined(F.col("domain"), "domains"), "split", F.size("messages").alias("messages"))


_NEWEST = "SELECT * FROM posts WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST, num_comments DESC NULLS LAST, title DESC NULLS LAST) = 1"
_GOOD_POSTS = f"""
SELECT * FROM (SELECT *, {sql_clean("title")} AS cleaned_title FROM ({_NEWEST}) WHERE subreddit IS NOT NULL AND title IS NOT NULL AND title <> '' AND len({sql_keywords("title", keywords.EXPANDED)}) > 0)
WHERE length(cleaned_title) >= 10 AND regexp_matches(cleaned_title, '[a-zA-Z0-9]')"""


def _sql_balanced(rows: str, group: str, score: str, key: str, most: int) -> str:
    return f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {score} DESC NULLS LAST, {key}) AS k FROM ({rows}) WHERE {group} IS NOT NULL),
g AS (SELECT {group} AS g, count(*) AS size FROM r GROUP BY {group}),
h AS (SELECT *, CASE WHEN (SELECT count(*) FROM g) = 1 THEN least(size, {most}) ELSE least(size, {most} // 2) END AS head FROM g),
p AS (SELECT *, size - head AS spare, greatest({most} - sum(head) OVER (), 0) AS rest,
  coalesce(sum(head) OVER w, 0) AS head_before, coalesce(sum(size - head) OVER w, 0) AS spare_before FROM h
  WINDOW w AS (ORDER BY size DESC, g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
q AS (SELECT g, least(head, greatest({most} - head_before, 0)) + least(spare, greatest(rest - spare_before, 0)) AS quota FROM p)
SELECT r.* FROM r JOIN q ON r.{group} = q.g WHERE k <= quota"""


def sql_draw(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}/' || coalesce(CAST({key} AS VARCHAR), '')), 1, 8))::BIGINT"


def sql_pick(key: str, choices: tuple[str, ...]) -> str:
    return f"({sql_list(choices)})[{sql_draw(key)} % {len(choices)} + 1]"


@query(f"""
SELECT id, cleaned_title, {_ONION} AS tone, {sql_pick("id", chat.USER)} AS question, 3 AS messages FROM ({_sql_balanced(_GOOD_POSTS, "subreddit", "num_comments", "id", 4000)})""")
def pipeline_posts(spark: SparkSession, folder: str) -> DataFrame:
    posts = spread(table(spark, folder, "posts").where("id is not null"))
    newest = dedup.newest(posts, ["id"], F.struct("ingested_at", "num_comments", "title"))
    made = pipelines.chat_posts(newest, options={"posts": {"decompose": False}})
    return made.select("id", F.get("messages", F.lit(2))["content"].alias("cleaned_title"), "tags.tone", F.get("messages", F.lit(1))["content"].alias("question"), F.size("messages").cast("long").alias("messages"))


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS "begin", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_event_windows(spark: SparkSession, folder: str) -> DataFrame:
    return streams.windowed(table(spark, folder, "events"), "ts", ["event_type"], value=F.col("value")).select("begin", "event_type", "n", F.round("total", 4).alias("total"))


from quern.plans import catalog_more  # noqa: E402, F401  adds its queries


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Rows after each stage of normalization: loaded, without duplicates, English, safe."""
    return a4_stage_counts(spark, folder)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
