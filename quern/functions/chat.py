"""Building and reading chat messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import let, tool_id, words

# System prompts by persona and user prompts.
SYSTEM = {
    "twain": "You are a witty weather assistant inspired by Mark Twain. Your responses blend accurate weather information with humorous observations and satirical commentary, using colloquial language and clever turns of phrase.",
    "franklin": "You are a wise weather advisor inspired by Benjamin Franklin. Your responses provide practical weather guidance with aphoristic wisdom, drawing on historical knowledge and common sense to help people make informed decisions.",
    "onion": "You are a satirical weather assistant inspired by The Onion. Your responses provide accurate weather information wrapped in deadpan, absurdist humor with straight-faced delivery. Think 'Area Man Checks Weather App 47 Times, Still Surprised By Rain' style commentary - combining mundane weather facts with satirical observations about human behavior.",
    "neutral": "You are a helpful weather assistant. You provide clear, accurate weather information in a friendly and approachable manner.",
}
USER = (
    "What's the weather like?",
    "Give me the forecast",
    "How's the weather today?",
    "What's the weather forecast?",
    "Tell me about the weather",
    "What can you tell me about today's weather?",
    "How does the weather look?",
    "What's the forecast looking like?",
    "Give me a weather update",
    "What's happening with the weather?",
    "Tell me what the weather is doing",
    "How's it looking outside?",
    "What's the weather situation?",
    "Can you give me the weather?",
    "What's the weather report?",
)
FOLLOW_UP = "Tell me more"
MULTI_TURN = 300  # words beyond which an answer is told in two turns
FIRST_SHARE = 0.6

CALL = "array<struct<id: string, type: string, function: struct<name: string, arguments: string>>>"
MESSAGE = f"struct<role: string, content: string, tool_calls: {CALL}, tool_call_id: string>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit(None).cast(CALL).alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"))


def system_prompt(persona: Column) -> Column:
    """The system prompt of a persona; of an unknown one the neutral prompt."""
    out = F.lit(SYSTEM["neutral"])
    for name, text in SYSTEM.items():
        out = F.when(persona == name, F.lit(text)).otherwise(out)
    return out


def draw(key: Column, seed: int = 42) -> Column:
    """A number of 32 bits from an md5 of the seed and a key: the same in every run, on any number of executors and in any engine; null keys draw as ''."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("long")


def pick(key: Column, choices: tuple[str, ...] | list[str], seed: int = 42) -> Column:
    """One of the choices by a draw."""
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (draw(key, seed) % len(choices) + 1).cast("int"))


def single_turn(text: Column, persona: Column, key: Column) -> Column:
    return F.array(message("system", system_prompt(persona)), message("user", pick(key, USER)), message("assistant", text))


def two_parts(text: Column, share: float = FIRST_SHARE) -> tuple[Column, Column]:
    """A text cut after a share of its words, white space collapsed."""
    def part(w: Column, first: bool) -> Column:
        cut = F.floor(F.size(w) * F.lit(share)).cast("int")
        return F.array_join(F.slice(w, F.lit(1), cut) if first else F.slice(w, cut + 1, F.size(w) + 1), " ")

    return let(words(text), lambda w: part(w, True)), let(words(text), lambda w: part(w, False))


def multi_turn(text: Column, persona: Column, key: Column) -> Column:
    first, second = two_parts(text)
    return F.array(
        message("system", system_prompt(persona)), message("user", pick(key, USER)), message("assistant", first), message("user", F.lit(FOLLOW_UP)), message("assistant", second)
    )


def chat(text: Column, n_words: Column, persona: Column, key: Column, limit: int = MULTI_TURN) -> Column:
    """The messages of an item: in two turns if it has more than ``limit`` words."""
    return F.when(n_words > limit, multi_turn(text, persona, key)).otherwise(single_turn(text, persona, key))


def stratum(persona: Column, tone: Column, domain: Column) -> Column:
    """persona-tone-first domain, with 'unknown' for what is missing."""
    unknown = F.lit("unknown")
    return F.concat_ws("-", F.coalesce(persona, unknown), F.coalesce(tone, unknown), F.coalesce(F.get(domain, F.lit(0)), unknown))


def has_calls(m: Column) -> Column:
    return F.coalesce(F.size(m["tool_calls"]) > 0, F.lit(False))


def final_response(messages: Column) -> Column:
    """The content of the last assistant message without tool calls; null if there is none."""
    plain = F.filter(messages, lambda m: (m["role"] == "assistant") & ~has_calls(m))
    return F.when(F.size(plain) > 0, F.element_at(plain, -1)["content"])


def calls(messages: Column) -> Column:
    """All tool calls of a conversation, in order."""
    return F.flatten(F.transform(F.filter(messages, has_calls), lambda m: m["tool_calls"]))


def summary(messages: Column) -> Column:
    """struct(message_count, has_tool_calls, tool_call_count, function_names, turn_count)."""
    all_calls = calls(messages)
    return F.struct(
        F.size(messages).alias("message_count"),
        (F.size(all_calls) > 0).alias("has_tool_calls"),
        F.size(all_calls).alias("tool_call_count"),
        F.transform(all_calls, lambda c: c["function"]["name"]).alias("function_names"),
        F.size(F.filter(messages, lambda m: m["role"] == "user")).alias("turn_count"),
    )


def with_tool_ids(messages: Column, size: int = 9) -> Column:
    """messages with every tool call id, and every reference to one, in the short form: a reference keeps fitting its call."""
    def call(c: Column) -> Column:
        return c.withField("id", tool_id(c["id"], size))

    def one(m: Column) -> Column:
        mapped = m.withField("tool_calls", F.transform(m["tool_calls"], call))
        return mapped.withField("tool_call_id", F.when(m["role"] == "tool", tool_id(m["tool_call_id"], size)).otherwise(m["tool_call_id"]))

    return F.transform(messages, one)


def rendered(messages: Column, begin: str = "<|{role}|>\n", end: str = "\n") -> Column:
    """A conversation as one text: ``begin`` with the role, the content, ``end``, for every message."""
    before, after = begin.split("{role}")
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(before), m["role"], F.lit(after), F.coalesce(m["content"], F.lit("")), F.lit(end))), "")


def fenced_json(text: Column) -> Column:
    """The JSON in a fenced block of a text, or the text itself if it is JSON; null if neither is."""
    inside = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*\n?(.*?)\n?```", 1), F.lit(""))
    chosen = F.coalesce(inside, text)
    return F.when(F.try_parse_json(chosen).isNotNull(), chosen)


def item_id(df_columns: list[str]) -> Column:
    """The first id a row has: id, reddit_id or gutenberg_id."""
    return F.coalesce(*[F.col(c).cast("string") for c in ("id", "reddit_id", "gutenberg_id") if c in df_columns], F.lit(None).cast("string"))
