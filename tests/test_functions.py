"""Column functions on inline rows."""

import pytest
from pyspark.sql import functions as F

from quern.operators import joins
from quern.functions import chat, keywords, tags, text, validate


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def lit(v):
    return F.lit(v)


def test_normalization(spark):
    r = one(spark, text.normalized(lit("é")).alias("a"), text.normalized(lit(None).cast("string")).alias("b"), text.normalized(lit("ﬁ"), "NFKC").alias("c"), text.normalized(lit("é"), "NFD").alias("d"))
    assert (r.a, r.b, r.c, r.d) == ("é", "", "fi", "é")
    with pytest.raises(ValueError):
        text.normalized(lit("x"), "NFX")


def test_normalized_columns_leave_the_rest(spark):
    df = spark.createDataFrame([("é", 3, ["é"], None)], "content string, id int, tags array<string>, title string")
    r = text.normalize_columns(df).first()
    assert (r.content, r.id, r.tags, r.title) == ("é", 3, ["é"], None)
    s = df.select(text.change_stats(F.col("content"), text.normalized(F.col("content"))).alias("s")).first().s
    assert (s.changed, s.length_diff, s.original_length, s.normalized_length) == (True, -1, 2, 1)


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("**Bold** and __also__ *it* _this_", "Bold and also it this"),
        ("[link](http://x.y) rest", "link rest"),
        ("see https://a.b/c?d=e now", "see now"),
        ("[removed] [Deleted] [automoderator] text", "text"),
        ("“q” ‘s’ a—b c–d e… f g", "\"q\" 's' a-b c-d e... f g"),
        ("  a \n\t b  ", "a b"),
        ("", ""),
        (None, ""),
    ],
)
def test_post_cleaning(spark, raw, clean):
    assert one(spark, text.clean_post(lit(raw).cast("string"), decompose=False).alias("c")).c == clean


def test_decomposition_keeps_marks(spark):
    assert one(spark, text.clean_post(lit("é ﬁne")).alias("c")).c == "é fine"


def test_valid_text(spark):
    r = one(spark, *[text.is_valid(lit(t).cast("string")).alias(n) for n, t in (("a", "long enough"), ("b", "short"), ("c", "??????????????"), ("d", None), ("e", "          x "))])
    assert tuple(r) == (True, False, False, False, False)


def test_words_and_paragraphs(spark):
    r = one(spark, text.word_count(lit("a b\n c d")).alias("n"), text.word_count(lit("")).alias("z"), text.word_count(lit(None).cast("string")).alias("y"), text.paragraphs(lit(" a \n\n\n b\n \nc ")).alias("p"))
    assert (r.n, r.z, r.y, r.p) == (4, 0, 0, ["a", "b", "c"])


def test_boilerplate(spark):
    body = "head\n*** START OF THE PROJECT GUTENBERG EBOOK A TALE ***\nThe text.\n*** END OF THE PROJECT GUTENBERG EBOOK A TALE ***\nfoot"
    r = one(spark, text.between_markers(lit(body)).alias("a"), text.between_markers(lit(" bare ")).alias("b"), text.between_markers(lit("***START OF THIS PROJECT GUTENBERG EBOOK X***\nz")).alias("c"))
    assert tuple(r) == ("The text.", "bare", "z")


@pytest.mark.parametrize("p, want", [("CHAPTER XIV The river", "CHAPTER XIV"), ("Chapter 12: rain", "Chapter 12"), ("CHAPTER ONE", "CHAPTER ONE"), ("IV. On fog", "IV."), ("The chapter", None)])
def test_chapters(spark, p, want):
    assert one(spark, text.chapter_marker(lit(p)).alias("c")).c == want


def test_speakers(spark):
    t = '"Rain," said tom. Huck replied that he said nothing. JANE asked; she exclaimed. Éva said no.'
    assert one(spark, text.speaker_names(lit(t)).alias("n")).n == ["Huck", "Jane", "No", "Nothing", "Tom", "Éva"]


def test_tool_ids(spark):
    r = one(spark, text.tool_id(lit("call_abc-123456789")).alias("a"), text.tool_id(lit("x1")).alias("b"), text.tool_id(lit("")).alias("c"))
    assert tuple(r) == ("123456789", "0000000x1", "000000000")


def test_keywords(spark):
    r = one(spark, keywords.keyword_set(lit("RAIN, rain and érain; snow_storm snow"), keywords.WEATHER).alias("k"), keywords.matches(lit("A funny rain")).alias("m"), keywords.matches(lit(None).cast("string")).alias("z"))
    assert r.k == ["rain", "snow"]
    assert (r.m.context_type, r.m.relevance_score, r.m.matched_keywords) == ("both", 2, ["funny", "rain"])
    assert (r.z.context_type, r.z.relevance_score) == ("none", 0)


def test_keyword_spans(spark):
    spans = one(spark, keywords.keyword_spans(lit("Rain on rainy rain"), keywords.WEATHER).alias("s")).s
    assert [(s.start, s.end, s.keyword) for s in spans] == [(0, 4, "rain"), (14, 18, "rain")]
    assert len(keywords.EXPANDED) == 45 and len(keywords.WEATHER) == 21


@pytest.mark.parametrize(
    "author, source, url, title, want",
    [
        ("Mark Twain", None, None, None, "twain"), ("Benjamin Franklin", "twain.json", None, None, "franklin"), (None, "reddit_x.csv", "franklin", None, "neutral"),
        (None, None, "http://x/twain", None, "twain"), (None, None, None, "A Connecticut Yankee", "twain"), (None, None, None, "Autobiography", "neutral"), (None, None, None, None, "neutral"),
    ],
)
def test_persona(spark, author, source, url, title, want):
    s = lambda v: lit(v).cast("string")
    assert one(spark, tags.persona(s(author), s(source), s(url), s(title)).alias("p")).p == want


@pytest.mark.parametrize("tag, own, sub, source, author, want", [("x", "y", None, None, None, "x"), (None, "y", None, None, None, "y"), (None, None, "TheOnion", None, None, "satirical"), (None, None, "nottheonion", None, None, "ironic"), (None, None, "news", "reddit_theonion.csv", None, "satirical"), (None, None, None, "reddit.csv", "Franklin", "humorous"), (None, None, None, None, "Franklin", "didactic"), (None, None, None, None, None, "humorous")])
def test_tone(spark, tag, own, sub, source, author, want):
    assert one(spark, tags.tone(*[lit(v).cast("string") for v in (tag, own, sub, source, author)]).alias("t")).t == want


def test_domains(spark):
    none = lit(None).cast("array<string>")
    a = lambda *v: F.array(*[lit(x) for x in v])
    s = lambda v: lit(v).cast("string")
    r = one(
        spark, tags.domains(a("Storm", "funny"), s(None)).alias("a"), tags.domains(none, s(None)).alias("b"), tags.domains(none, s("satirical")).alias("c"),
        tags.item_domains(none, s("satirical"), none).alias("d"), tags.item_domains(a("storm"), s(None), a("Satire")).alias("e"),
    )
    assert tuple(r) == (["weather", "humor"], ["weather"], ["humor"], ["weather", "humor"], ["weather", "humor"])


def test_chats(spark):
    r = one(spark, chat.chat(lit("one two three four five"), lit(5), lit("twain"), lit("k")).alias("s"), chat.chat(lit("one two three four five"), lit(301), lit("none"), lit("k")).alias("m"))
    assert [m.role for m in r.s] == ["system", "user", "assistant"] and r.s[1].content in chat.USER and r.s[2].content == "one two three four five"
    assert [m.content for m in r.m][2:] == ["one two three", "Tell me more", "four five"] and r.m[0].content == chat.SYSTEM["neutral"]


def test_rendering_and_json(spark):
    r = one(spark, chat.fenced_json(lit('say ```json\n{"a": 1}\n``` ok')).alias("a"), chat.fenced_json(lit('{"b": 2}')).alias("b"), chat.fenced_json(lit("no")).alias("c"), chat.stratum(lit(None).cast("string"), lit("t"), lit(None).cast("array<string>")).alias("s"))
    assert tuple(r) == ('{"a": 1}', '{"b": 2}', None, "unknown-t-unknown")


def conversation(spark, messages):
    return spark.createDataFrame([(messages,)], f"m array<{chat.MESSAGE}>")


def say(role, content, calls=None, ref=None):
    return (role, content, calls, ref)


def tool_chat(name="get_current_weather", args='{"latitude": 10, "longitude": 20}', told='{"temperature": 22, "condition": "partly_cloudy"}', reply="It is 22 and partly cloudy."):
    return [say("system", "s"), say("user", "q"), say("assistant", None, [("call_1", "function", (name, args))]), say("tool", told, None, "call_1"), say("assistant", reply)]


@pytest.mark.parametrize(
    "roles, error",
    [
        ("s u a", None), ("s u a u a", None), ("s u a t a", None), ("s u a t t a u a", None), ("s u a t a t a", None), ("u a", "First role must be 'system', got 'user'"),
        ("s a", "Unexpected 'assistant' role at position 1 (expected 'user')"), ("s u u", "Unexpected 'user' role at position 2 (expected 'assistant')"),
        ("s u t a", "Unexpected 'tool' role at position 2 (must follow assistant with tool_calls)"), ("s u a t", "Tool message(s) must be followed by assistant message"),
        ("s u", "Last role must be 'assistant', got 'user'"), ("s x", "Invalid role at position 1: 'x'"), ("", "No roles to validate"), ("s", "Last role must be 'assistant', got 'system'"),
    ],
)
def test_role_order(spark, roles, error):
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    df = conversation(spark, [say(names.get(r, r), "c") for r in roles.split()])
    assert df.select(validate.roles_error(F.col("m")).alias("e")).first().e == error


@pytest.mark.parametrize(
    "call, error",
    [
        (("i", "function", ("f", "{}")), None), ((None, "function", ("f", "{}")), "Missing 'id' field"), (("i", "x", ("f", "{}")), "Invalid type: x"), (("i", "function", None), "Missing 'function' field"),
        (("i", "function", (None, "{}")), "Missing 'name' in function"), (("i", "function", ("f", None)), "Missing 'arguments' in function"), (("i", "function", ("f", "{bad")), "Invalid JSON in 'arguments'"),
    ],
)
def test_call_structure(spark, call, error):
    df = spark.createDataFrame([(call,)], "c struct<id: string, type: string, function: struct<name: string, arguments: string>>")
    assert df.select(validate.call_error(F.col("c")).alias("e")).first().e == error


@pytest.mark.parametrize(
    "name, args, error",
    [
        ("get_current_weather", '{"latitude": 40.7, "longitude": -74}', None), ("get_current_weather", '{"latitude": 100, "longitude": 0}', "Parameter 'latitude' above maximum: 90"),
        ("get_forecast", '{"latitude": 1, "longitude": 1, "days": 20}', "Parameter 'days' above maximum: 14"), ("get_forecast", '{"latitude": 1, "longitude": 1, "days": 2.5}', "Parameter 'days' must be an integer"),
        ("get_forecast", '{"latitude": 1, "longitude": 1}', "Missing required parameter: days"), ("geocode_location", '{"city": "a", "country": 3}', "Parameter 'country' must be a string"),
        ("geocode_location", '{"city": "a", "country": "b", "x": 1}', "Unknown parameter: x"), ("other", "{}", "Unknown function: other"), ("get_current_weather", "[", "Invalid JSON in 'arguments'"),
    ],
)
def test_parameters(spark, name, args, error):
    assert one(spark, validate.parameters_error(lit(name), lit(args)).alias("e")).e == error


PLACES = [
    {"pos": 0, "city": "Aford", "country": "X", "latitude": 10.0, "longitude": 20.0, "climate_zone": "temperate", "summer_lo": 15.0, "summer_hi": 25.0, "winter_lo": -5.0, "winter_hi": 5.0},
    {"pos": 1, "city": "Bness", "country": "Y", "latitude": -30.0, "longitude": 20.0, "climate_zone": "desert", "summer_lo": 25.0, "summer_hi": 40.0, "winter_lo": 8.0, "winter_hi": 20.0},
]


def placed(spark, df):
    lat, lon = validate.asked_point(F.col("m"))
    return joins.nearest(df, lat, lon, spark.createDataFrame(PLACES))


@pytest.mark.parametrize(
    "change, error",
    [
        ({}, None), ({"told": '{"temperature": 150, "condition": "clear"}'}, "Temperature 150.0°C out of reasonable range"), ({"told": '{"temperature": 45, "condition": "clear"}'}, "Temperature 45.0°C unrealistic for Aford"),
        ({"told": '{"temperature": 20, "condition": "lava"}'}, "Invalid weather condition: lava"), ({"told": '{"temperature": 20, "condition": "rain", "humidity": 120}'}, "Humidity out of range (0-100)"),
        ({"told": "nope"}, "Tool response is not valid JSON"), ({"told": '{"error": true}'}, None),
        ({"name": "get_forecast", "args": '{"latitude": 1, "longitude": 1, "days": 2}', "told": '{"daily": [{"temperature_min": 1, "temperature_max": 5}]}'}, "Forecast days mismatch: requested 2, got 1"),
        ({"name": "get_forecast", "args": '{"latitude": 1, "longitude": 1, "days": 1}', "told": '{"daily": [{"temperature_min": 9, "temperature_max": 5}]}'}, "Day 0: Max temp not greater than min"),
        ({"name": "get_forecast", "args": '{"latitude": 1, "longitude": 1, "days": 1}', "told": '{"daily": [{"temperature_min": 1, "temperature_max": 5}]}'}, None),
    ],
)
def test_weather(spark, change, error):
    df = placed(spark, conversation(spark, tool_chat(**change)))
    assert df.select(validate.weather_error(F.col("m"), F.col("place")).alias("e")).first().e == error


@pytest.mark.parametrize(
    "change, score",
    [
        ({}, 1.0), ({"reply": "Lovely."}, 0.0), ({"told": '{"temperature": 22, "condition": "rain", "location": "Aford, X"}', "reply": "22 in Aford"}, 2 / 3), ({"told": '{"error": true}', "reply": "Sorry, no."}, 1.0),
        ({"told": '{"error": true}', "reply": "Fine."}, 0.0), ({"told": "{}", "reply": "x"}, 1.0), ({"told": "bad"}, 0.0), ({"told": '{"daily": [{"temperature_min": 3, "temperature_max": 9}]}', "reply": "up to 9"}, 1.0),
    ],
)
def test_groundedness(spark, change, score):
    got = conversation(spark, tool_chat(**change)).select(validate.groundedness(F.col("m")).cast("double").alias("s")).first().s
    assert got == pytest.approx(score)


def test_all_errors(spark):
    domain = F.array(lit("weather"))
    bad = conversation(spark, tool_chat(args='{"latitude": 100, "longitude": 0}', told='{"temperature": 99, "condition": "rain"}', reply="x"))
    e = placed(spark, bad).select(validate.all_errors(F.col("m"), lit("p"), lit("t"), domain, F.col("place")).alias("e")).first().e
    assert [x.split(":")[0] for x in e] == ["JSON schema", "Semantic", "Groundedness"]
    assert placed(spark, conversation(spark, tool_chat())).select(validate.all_errors(F.col("m"), lit("p"), lit("t"), domain, F.col("place")).alias("e")).first().e == []
    missing = conversation(spark, [say("system", "s"), say("user", None), say("assistant", "a")]).select(validate.entry_error(F.col("m"), lit("p"), lit("t"), domain).alias("e")).first().e
    assert missing == "Message 1 missing 'content' field"


def test_tool_ids_stay_consistent(spark):
    m = conversation(spark, tool_chat()).select(chat.with_tool_ids(F.col("m")).alias("m")).first().m
    assert m[2].tool_calls[0].id == m[3].tool_call_id == "0000call1"


def test_final_response_and_summary(spark):
    df = conversation(spark, tool_chat())
    r = df.select(chat.final_response(F.col("m")).alias("f"), chat.summary(F.col("m")).alias("s")).first()
    assert r.f == "It is 22 and partly cloudy." and (r.s.message_count, r.s.tool_call_count, r.s.function_names, r.s.turn_count) == (5, 1, ["get_current_weather"], 1)
