"""Validation of chat entries and tool calls as column expressions.

A missing key and a null look the same in a column, so "missing" means null
throughout.  Error columns hold the first error's text, or null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.chat import calls, final_response, has_calls
from quern.functions.text import let

# The tools' parameters as (name, type, least, most); all are required.
TOOLS = {
    "get_current_weather": (("latitude", "number", -90, 90), ("longitude", "number", -180, 180)),
    "get_forecast": (("latitude", "number", -90, 90), ("longitude", "number", -180, 180), ("days", "integer", 1, 14)),
    "geocode_location": (("city", "string", None, None), ("country", "string", None, None)),
}
CONDITIONS = (
    "clear", "partly_cloudy", "cloudy", "rain", "drizzle", "snow", "sleet", "fog", "mist", "thunderstorm", "hot", "dust", "sandstorm", "blizzard", "freezing_rain", "extreme_cold",
)
LEAST, MOST, SLACK = -60, 60, 15


def first_error(*errors: Column) -> Column:
    return F.coalesce(*errors, F.lit(None).cast("string"))


def references(messages: Column) -> Column:
    """(answered, told): how many tool messages refer to a call of the conversation, and how many there are."""
    ids = F.transform(calls(messages), lambda c: c["id"])
    told = F.filter(messages, lambda m: m["role"] == "tool")
    return F.struct(F.size(F.filter(told, lambda m: F.coalesce(F.array_contains(ids, m["tool_call_id"]), F.lit(False)))).alias("answered"), F.size(told).alias("told"))


def roles_error(messages: Column) -> Column:
    """The first fault in the order of roles.

    A walk over the roles that carries which role is due; a role sees its
    neighbours through the positions.
    """
    roles = F.transform(messages, lambda m: F.coalesce(m["role"], F.lit("")))
    n = F.size(roles)
    places = F.transform(roles, lambda r, i: F.struct(i.alias("i"), r.alias("r"), F.get(roles, i + 1).alias("next"), F.get(roles, i - 1).alias("last")))
    start = F.struct(F.lit("user").alias("due"), F.lit(None).cast("string").alias("error"))

    def fault(*parts: object) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    def step(s: Column, p: Column) -> Column:
        r, i, due = p["r"], p["i"].cast("string"), s["due"]
        in_run = (r == "tool") & (p["last"] == "tool") & (p["i"] > 1)
        error = (
            F.when(~r.isin("user", "assistant", "tool"), fault("Invalid role at position ", i, ": '", r, "'"))
            .when((r == "user") & (due != "user"), fault("Unexpected 'user' role at position ", i, " (expected '", due, "')"))
            .when((r == "assistant") & ~due.isin("assistant", "tool"), fault("Unexpected 'assistant' role at position ", i, " (expected '", due, "')"))
            .when((r == "tool") & ~in_run & (due != "tool"), fault("Unexpected 'tool' role at position ", i, " (must follow assistant with tool_calls)"))
            .when((r == "tool") & p["next"].isNull(), F.lit("Tool message(s) must be followed by assistant message"))
        )
        next_due = F.when(r == "user", "assistant").when(r == "tool", "assistant").when(p["next"] == "tool", "tool").otherwise("user")
        return F.struct(next_due.alias("due"), F.coalesce(s["error"], error).alias("error"))

    walked = F.aggregate(F.slice(places, 2, F.greatest(n - 1, F.lit(0))), start, step)["error"]
    return (
        F.when(messages.isNull() | (n == 0), F.lit("No roles to validate"))
        .when(F.get(roles, F.lit(0)) != "system", fault("First role must be 'system', got '", F.get(roles, F.lit(0)), "'"))
        .otherwise(F.coalesce(walked, F.when(F.element_at(roles, -1) != "assistant", fault("Last role must be 'assistant', got '", F.element_at(roles, -1), "'"))))
    )


def call_error(call: Column) -> Column:
    """The first fault of a tool call's structure."""
    return (
        F.when(call["id"].isNull(), "Missing 'id' field")
        .when(call["type"].isNull(), "Missing 'type' field")
        .when(call["type"] != "function", F.concat(F.lit("Invalid type: "), call["type"]))
        .when(call["function"].isNull(), "Missing 'function' field")
        .when(call["function"]["name"].isNull(), "Missing 'name' in function")
        .when(call["function"]["arguments"].isNull(), "Missing 'arguments' in function")
        .when(F.try_parse_json(call["function"]["arguments"]).isNull(), "Invalid JSON in 'arguments'")
    )


def message_error(m: Column, i: Column) -> Column:
    def fault(*parts: object) -> Column:
        return F.concat(F.lit("Message "), i.cast("string"), *[p if isinstance(p, Column) else F.lit(p) for p in parts])

    structure = F.filter(F.transform(F.coalesce(m["tool_calls"], F.array()), lambda c, j: F.struct(j.alias("j"), call_error(c).alias("e"))), lambda x: x["e"].isNotNull())
    bad = F.get(structure, F.lit(0))
    role = m["role"]
    return (
        F.when(m.isNull(), fault(" is not a dictionary"))
        .when(role.isNull(), fault(" missing 'role' field"))
        .when((role == "tool") & m["tool_call_id"].isNull(), fault(" (tool) missing 'tool_call_id' field"))
        .when((role == "tool") & m["content"].isNull(), fault(" (tool) missing 'content' field"))
        .when(~((role == "assistant") & has_calls(m)) & (role != "tool") & m["content"].isNull(), fault(" missing 'content' field"))
        .when(has_calls(m) & (role != "assistant"), fault(" has tool_calls but role is '", role, "' (must be 'assistant')"))
        .when(bad.isNotNull(), fault(" tool_call ", bad["j"].cast("string"), " invalid: ", bad["e"]))
    )


def entry_error(messages: Column, persona: Column, tone: Column, domain: Column) -> Column:
    """The first fault of a chat entry: its messages, their order, its tags."""
    faults = F.filter(F.transform(messages, message_error), lambda e: e.isNotNull())
    return first_error(
        F.when(messages.isNull(), "Missing 'messages' field"),
        F.when(F.size(messages) == 0, "'messages' array is empty"),
        F.get(faults, F.lit(0)),
        roles_error(messages),
        F.when(persona.isNull(), "Missing required tag: 'persona'"),
        F.when(tone.isNull(), "Missing required tag: 'tone'"),
        F.when(domain.isNull(), "Missing required tag: 'domain'"),
    )


def weak_error(messages: Column) -> Column:
    """The parser's weaker check: a system message first, an assistant's last, every message with a role and content or calls."""
    bad = F.exists(messages, lambda m: m["role"].isNull() | (m["content"].isNull() & ~has_calls(m)))
    return first_error(
        F.when(messages.isNull() | (F.size(messages) == 0), "no messages"),
        F.when(F.get(messages, F.lit(0))["role"] != "system", "first message must be system"),
        F.when(F.element_at(messages, -1)["role"] != "assistant", "last message must be assistant"),
        F.when(bad, "invalid message"),
    )


def _json(text: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def _json_type(text: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), path, "variant"))


def parameters_error(name: Column, arguments: Column) -> Column:
    """The first fault of a call's parameters against its tool's: unknown tool, missing, unknown, mistyped or out of range."""
    given = F.json_object_keys(arguments)
    out = F.when(~name.isin(*TOOLS), F.concat(F.lit("Unknown function: "), name))
    for tool, params in TOOLS.items():
        names = F.array(*[F.lit(p[0]) for p in params])
        missing = F.get(F.array_except(names, given), F.lit(0))
        unknown = F.get(F.array_except(given, names), F.lit(0))
        faults = [F.concat(F.lit("Missing required parameter: "), missing), F.concat(F.lit("Unknown parameter: "), unknown)]
        for p, kind, least, most in params:
            there = _json_type(arguments, f"$.{p}")
            if kind == "string":
                faults.append(F.when(there != "STRING", f"Parameter '{p}' must be a string"))
                continue
            number = there.rlike("^(BIGINT|DOUBLE|DECIMAL.*|FLOAT|INT|SMALLINT|TINYINT|BOOLEAN)$")
            whole = there.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|BOOLEAN|DECIMAL\(\d+,0\))$")
            value = _json(arguments, f"$.{p}", "double")
            faults.append(F.when(~(whole if kind == "integer" else number), f"Parameter '{p}' must be {'an integer' if kind == 'integer' else 'a number'}"))
            faults.append(F.when(value < least, f"Parameter '{p}' below minimum: {least}"))
            faults.append(F.when(value > most, f"Parameter '{p}' above maximum: {most}"))
        out = out.when(name == tool, first_error(*faults))
    return F.when(given.isNull(), "Invalid JSON in 'arguments'").otherwise(out)


def calls_error(messages: Column) -> Column:
    """The first fault of parameters among all tool calls of a conversation."""
    faults = F.transform(calls(messages), lambda c: parameters_error(c["function"]["name"], c["function"]["arguments"]))
    return F.get(F.filter(faults, lambda e: e.isNotNull()), F.lit(0))


def last_call(messages: Column) -> Column:
    """The first call of the last assistant message that calls; null if there is none."""
    calling = F.filter(messages, lambda m: (m["role"] == "assistant") & has_calls(m))
    return F.when(F.size(calling) > 0, F.get(F.element_at(calling, -1)["tool_calls"], F.lit(0)))


def last_tool_content(messages: Column) -> Column:
    told = F.filter(messages, lambda m: m["role"] == "tool")
    return F.when(F.size(told) > 0, F.element_at(told, -1)["content"])


def asked_point(messages: Column) -> tuple[Column, Column]:
    """Latitude and longitude of the arguments of the last call."""
    arguments = last_call(messages)["function"]["arguments"]
    return _json(arguments, "$.latitude", "double"), _json(arguments, "$.longitude", "double")


def weather_error(messages: Column, place: Column) -> Column:
    """The first semantic fault of a tool's answer: range and climate of the temperature, condition, humidity, forecast days and their extremes.

    ``place`` is the row of the location nearest to the point asked for
    (``joins.nearest`` on ``asked_point``).
    """
    parts = F.struct(last_call(messages).alias("call"), last_tool_content(messages).alias("told"), place.alias("place"))
    return let(parts, lambda p: _weather_error(p["call"], p["told"], p["place"]))


def _weather_error(call: Column, told: Column, place: Column) -> Column:
    name, arguments = call["function"]["name"], call["function"]["arguments"]
    t = _json(told, "$.temperature", "double")
    low, high = F.least(place["summer_lo"], place["winter_lo"]) - SLACK, F.greatest(place["summer_hi"], place["winter_hi"]) + SLACK
    condition, humidity = F.coalesce(_json(told, "$.condition", "string"), F.lit("unknown")), _json(told, "$.humidity", "double")
    shown = t.cast("string")
    current = first_error(
        F.when(~t.between(LEAST, MOST), F.concat(F.lit("Temperature "), shown, F.lit("°C out of reasonable range"))),
        F.when(~t.between(low, high), F.concat(F.lit("Temperature "), shown, F.lit("°C unrealistic for "), place["city"])),
        F.when(~condition.isin(*CONDITIONS), F.concat(F.lit("Invalid weather condition: "), condition)),
        F.when(~humidity.between(0, 100), "Humidity out of range (0-100)"),
    )
    days = F.from_json(F.get_json_object(told, "$.daily"), "array<struct<temperature_min: double, temperature_max: double>>")
    wrong = F.filter(
        F.transform(
            days,
            lambda d, i: F.when(d["temperature_max"] <= d["temperature_min"], F.concat(F.lit("Day "), i.cast("string"), F.lit(": Max temp not greater than min"))).when(
                ~d["temperature_min"].between(LEAST, MOST) | ~d["temperature_max"].between(LEAST, MOST), F.concat(F.lit("Day "), i.cast("string"), F.lit(": Temperatures out of reasonable range"))
            ),
        ),
        lambda e: e.isNotNull(),
    )
    asked = F.coalesce(_json(arguments, "$.days", "int"), F.lit(0))
    forecast = first_error(
        F.when(asked != F.size(days), F.concat(F.lit("Forecast days mismatch: requested "), asked.cast("string"), F.lit(", got "), F.size(days).cast("string"))), F.get(wrong, F.lit(0))
    )
    return (
        F.when(call.isNull() | told.isNull(), None)
        .when(F.try_parse_json(told).isNull(), "Tool response is not valid JSON")
        .when(F.coalesce(_json(told, "$.error", "boolean"), F.lit(False)), None)
        .when((name == "get_current_weather") & t.isNotNull(), current)
        .when((name == "get_forecast") & days.isNotNull(), forecast)
    )


def groundedness(messages: Column) -> Column:
    """The share of a tool's data (temperature, condition, location, first day) that the final answer mentions; 1 if there is nothing to mention.

    An error counts as mentioned if the answer speaks of an error or is sorry;
    an answer of a tool that is no JSON gives 0.
    """
    told, said = last_tool_content(messages), final_response(messages)
    low = F.lower(F.coalesce(said, F.lit("")))
    t, condition, where = _json(told, "$.temperature", "double"), _json(told, "$.condition", "string"), _json(told, "$.location", "string")
    day_low, day_high = _json(told, "$.daily[0].temperature_min", "double"), _json(told, "$.daily[0].temperature_max", "double")
    has_day = F.coalesce(F.json_array_length(F.get_json_object(told, "$.daily")), F.lit(0)) > 0

    def mentions(x: Column) -> Column:
        return F.coalesce(low.contains(x.cast("int").cast("string")) & (x != 0), F.lit(False))

    points = [
        (t.isNotNull(), F.coalesce(low.contains(t.cast("int").cast("string")), F.lit(False))),
        (condition.isNotNull(), F.coalesce(low.contains(F.lower(F.replace(condition, F.lit("_"), F.lit(" ")))), F.lit(False))),
        (where.isNotNull(), F.coalesce(F.exists(F.split(F.lower(where), ","), lambda p: low.contains(p)), F.lit(False))),
        (has_day, mentions(day_low) | mentions(day_high)),
    ]
    total = sum((p.cast("int") for p, _ in points), F.lit(0))
    met = sum(((p & m).cast("int") for p, m in points), F.lit(0))
    sorry = low.contains("error") | low.contains("sorry") | low.contains("apologize")
    return (
        F.when(told.isNull() | said.isNull(), 1.0)
        .when(F.try_parse_json(told).isNull(), 0.0)
        .when(F.coalesce(_json(told, "$.error", "boolean"), F.lit(False)), F.when(sorry, 1.0).otherwise(0.0))
        .when(total == 0, 1.0)
        .otherwise(met / total)
    )


def all_errors(messages: Column, persona: Column, tone: Column, domain: Column, place: Column, least: float = 0.5) -> Column:
    """The errors of every kind, each with its kind before it."""
    chat, calls_, weather, share = entry_error(messages, persona, tone, domain), calls_error(messages), weather_error(messages, place), groundedness(messages)
    return F.array_compact(
        F.array(
            F.concat(F.lit("Chat format: "), chat),
            F.concat(F.lit("JSON schema: "), calls_),
            F.concat(F.lit("Semantic: "), weather),
            F.when(share < least, F.concat(F.lit("Groundedness: Score "), F.format_number(share, 2), F.lit(" below threshold (< 0.5)"))),
        )
    )
