"""Synthetic rows: weather, forecasts and tool-calling conversations.

Every draw is a hash of (seed, row, name of the draw), so rows are the same
in every run, for any number of partitions, and can be made in parallel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.chat import CALL, SYSTEM, draw
from quern.functions.validate import all_errors, asked_point
from quern.operators.joins import dimension, nearest
from quern.operators.sampling import ranked, weighted
from quern.session import cut, settled

# Conditions of each climate zone, and chances.
BY_CLIMATE = {
    "tropical": ("clear", "partly_cloudy", "cloudy", "rain", "thunderstorm", "fog"),
    "temperate": ("clear", "partly_cloudy", "cloudy", "rain", "drizzle", "fog", "snow", "sleet"),
    "desert": ("clear", "partly_cloudy", "hot", "dust", "sandstorm"),
    "oceanic": ("cloudy", "partly_cloudy", "clear", "rain", "drizzle", "fog", "mist"),
    "mediterranean": ("clear", "partly_cloudy", "cloudy", "rain"),
    "subarctic": ("clear", "cloudy", "snow", "sleet", "freezing_rain", "fog"),
    "arctic": ("clear", "snow", "blizzard", "fog", "extreme_cold"),
    "continental": ("clear", "partly_cloudy", "cloudy", "rain", "snow", "thunderstorm"),
    "subtropical": ("clear", "partly_cloudy", "cloudy", "rain", "thunderstorm"),
    "equatorial": ("partly_cloudy", "cloudy", "rain", "thunderstorm"),
    "semi-arid": ("clear", "partly_cloudy", "hot", "dust"),
}
COLD, HOT = ("snow", "blizzard", "extreme_cold", "clear", "cloudy"), ("clear", "partly_cloudy", "hot", "dust")
SCENARIOS = {"success": 0.65, "error": 0.175, "multi_turn": 0.175}
PERSONAS = {"neutral": 0.60, "twain": 0.25, "franklin": 0.15}
QUERIES = {"current": 0.5, "forecast": 0.4, "geocode": 0.1}
TONES = {"neutral": "neutral", "twain": "humorous", "franklin": "didactic"}
HUMOR_PERSONAS = {"neutral": 0.10, "twain": 0.70, "franklin": 0.20}  # the variant with more humor
ERRORS = {
    "invalid_location": "Invalid location coordinates for {}",
    "missing_parameter": "Missing required parameter for {}",
    "out_of_range": "Parameter out of valid range for {}",
    "api_error": "Weather service temporarily unavailable",
    "rate_limit": "API rate limit exceeded. Please try again later.",
    "unknown_city": "City not found in database",
}
ASK = {
    "current": ["What is the weather in {} right now?", "How warm is it in {}?", "Tell me the current conditions in {}.", "Is it raining in {}?"],
    "forecast": ["What is the forecast for {}?", "How will the weather be in {} this week?", "Give me the next days for {}."],
    "geocode": ["Where is {}?", "What are the coordinates of {}?"],
}
OPENING = ["I am planning a trip to {}.", "I have a few questions about {}.", "Let us talk about {}."]  # of conversations that go on
INTRO = {"current": "I will look up the current weather.", "forecast": "I will get the forecast.", "geocode": "I will find the coordinates."}


def uniform(seed: int, key: Column, name: str) -> Column:
    """A number in [0, 1) of a row's key and the draw's name."""
    return draw(F.concat(key.cast("string"), F.lit(f"/{name}")), seed) / 4294967296


def between(seed: int, key: Column, name: str, low: Column | float, high: Column | float, digits: int = 1) -> Column:
    low, high = (c if isinstance(c, Column) else F.lit(float(c)) for c in (low, high))
    return F.round(low + uniform(seed, key, name) * (high - low), digits)


def one_of(seed: int, key: Column, name: str, choices: Column) -> Column:
    return F.get(choices, F.floor(uniform(seed, key, name) * F.size(choices)).cast("int"))


def season(latitude: Column, month: Column) -> Column:
    """summer or winter: May to October is summer in the north, winter in the south."""
    return F.when((latitude >= 0) == month.between(5, 10), "summer").otherwise("winter")


def conditions(climate: Column, temperature: Column) -> Column:
    """The conditions a climate allows at a temperature."""
    out = F.array(*[F.lit(c) for c in ("clear", "cloudy", "rain")])
    for zone, names in BY_CLIMATE.items():
        out = F.when(climate == zone, F.array(*[F.lit(c) for c in names])).otherwise(out)
    fit = F.when(temperature < -10, F.filter(out, lambda c: c.isin(*COLD))).when(temperature > 35, F.filter(out, lambda c: c.isin(*HOT))).otherwise(out)
    return F.when(F.size(fit) > 0, fit).otherwise(F.array(F.lit("clear"), F.lit("cloudy")))


def _temperature(seed: int, key: Column, name: str, place: Column, when: Column) -> Column:
    low = F.when(when == "summer", place["summer_lo"]).otherwise(place["winter_lo"])
    high = F.when(when == "summer", place["summer_hi"]).otherwise(place["winter_hi"])
    return between(seed, key, name, low, high)


def current_weather(place: Column, key: Column, month: Column, seed: int = 42) -> Column:
    """struct(temperature, condition, wind_speed, humidity, location) at a place."""
    t = _temperature(seed, key, "t", place, season(place["latitude"], month))
    c = one_of(seed, key, "c", conditions(place["climate_zone"], t))
    wind = F.when(c.isin("thunderstorm", "blizzard", "sandstorm"), between(seed, key, "w", 20, 50)).otherwise(between(seed, key, "w", 0, 20))
    zone = place["climate_zone"]
    humid = F.when(zone.isin("tropical", "equatorial", "oceanic"), between(seed, key, "h", 60, 95, 0)).when(zone.isin("desert", "semi-arid"), between(seed, key, "h", 10, 40, 0))
    humid = humid.otherwise(between(seed, key, "h", 30, 80, 0)).cast("int")
    return F.struct(t.alias("temperature"), F.lit("celsius").alias("temperature_unit"), c.alias("condition"), wind.alias("wind_speed"), humid.alias("humidity"), F.concat_ws(", ", place["city"], place["country"]).alias("location"))


def forecast(place: Column, days: Column, key: Column, start: Column, seed: int = 42) -> Column:
    """struct(location, forecast_days, daily) of the days after ``start``; lows are 5 to 12 degrees below highs."""
    when = season(place["latitude"], F.month(start))

    def day(i: Column) -> Column:
        k = F.concat_ws("/", key.cast("string"), i.cast("string"))
        high = _temperature(seed, k, "t", place, when)
        c = one_of(seed, k, "c", conditions(place["climate_zone"], high))
        rain = F.when(c.isin("rain", "thunderstorm", "snow", "drizzle"), between(seed, k, "p", 60, 95, 0)).when(c.isin("cloudy", "partly_cloudy"), between(seed, k, "p", 10, 40, 0)).otherwise(between(seed, k, "p", 0, 20, 0))
        return F.struct(
            F.date_format(F.date_add(start, i), "yyyy-MM-dd").alias("date"), high.alias("temperature_max"), F.round(high - between(seed, k, "l", 5, 12), 1).alias("temperature_min"),
            c.alias("condition"), rain.cast("int").alias("precipitation_chance"), between(seed, k, "w", 5, 25).alias("wind_speed"),
        )

    return F.struct(F.concat_ws(", ", place["city"], place["country"]).alias("location"), days.alias("forecast_days"), F.transform(F.sequence(F.lit(1), days), day).alias("daily"))


def error_payload(kind: Column, function: Column) -> Column:
    """struct(error, error_type, message, function) of a failed call."""
    text = F.concat(F.lit("Error in "), function)
    for name, m in ERRORS.items():
        head, _, tail = m.partition("{}")
        text = F.when(kind == name, F.concat(F.lit(head), function, F.lit(tail)) if "{}" in m else F.lit(m)).otherwise(text)
    return F.struct(F.lit(True).alias("error"), kind.alias("error_type"), text.alias("message"), function.alias("function"))


def conversations(spark: SparkSession, n: int, locations: DataFrame, seed: int = 42, personas: dict[str, float] = PERSONAS, start: str = "2025-06-01", first: int = 0) -> DataFrame:
    """n conversations, numbered from ``first``, of five messages: system, question, tool call, tool answer, reply; those of scenario multi_turn open with a question about the weather of their own.

    Cities come in a permutation per block of all places, so one comes again
    only after all others of the block.
    """
    places = cut(ranked(locations.withColumn("_all", F.lit(1)), "_all", [F.col("pos")], "_which").drop("_all"))
    m = places.count()
    rows = spark.range(first, first + n).withColumnRenamed("id", "row")
    row = F.col("row")
    step = next(s for s in range(max(2, m // 2), m + 2) if math.gcd(s, m) == 1) if m > 1 else 1
    shift = F.pmod(F.xxhash64(F.lit(seed), F.floor(row / max(m, 1))), F.lit(max(m, 1)))
    which = F.pmod(row * step + shift, F.lit(max(m, 1)))
    rows = rows.withColumns({
        "scenario": weighted(F.concat(F.lit("s"), row.cast("string")), SCENARIOS, seed), "persona": weighted(F.concat(F.lit("p"), row.cast("string")), personas, seed),
        "query_type": weighted(F.concat(F.lit("q"), row.cast("string")), QUERIES, seed), "start": F.to_date(F.lit(start)), "_which": which,
    })
    rows = rows.join(dimension(places.select("_which", F.struct(*[c for c in places.columns if c != "_which"]).alias("place"))), "_which").drop("_which")
    rows = settled(rows)
    place, query, failing = F.col("place"), F.col("query_type"), F.col("scenario") == "error"
    days = F.when(failing, 20).otherwise((F.floor(uniform(seed, row, "days") * 5) + 3).cast("int"))
    function = F.when(query == "current", "get_current_weather").when(query == "forecast", "get_forecast").otherwise("geocode_location")
    lat = F.when(failing & (query == "current"), 100.0).otherwise(place["latitude"])
    arguments = (
        F.when(query == "current", F.to_json(F.struct(lat.alias("latitude"), place["longitude"].alias("longitude"))))
        .when(query == "forecast", F.to_json(F.struct(place["latitude"].alias("latitude"), place["longitude"].alias("longitude"), days.alias("days"))))
        .otherwise(F.to_json(F.struct(F.when(failing, "Nonexistent City").otherwise(place["city"]).alias("city"), F.when(failing, "Fake Country").otherwise(place["country"]).alias("country"))))
    )
    rows = rows.withColumns({"function": function, "arguments": arguments, "now": current_weather(place, row, F.month("start"), seed), "later": forecast(place, days, row, F.col("start"), seed)})
    rows = settled(rows)
    problem = F.when(query == "forecast", "out_of_range").otherwise("invalid_location")
    told = (
        F.when(failing, F.to_json(error_payload(problem, F.col("function"))))
        .when(query == "current", F.to_json("now"))
        .when(query == "forecast", F.to_json("later"))
        .otherwise(F.to_json(F.struct(place["city"].alias("city"), place["country"].alias("country"), place["latitude"].alias("latitude"), place["longitude"].alias("longitude"), F.lit(True).alias("found"))))
    )
    day = F.get(F.col("later")["daily"], F.lit(0))
    good = (
        F.when(query == "current", F.concat(F.lit("In "), place["city"], F.lit(" it is "), F.col("now")["temperature"].cast("string"), F.lit("°C and "), F.replace(F.col("now")["condition"], F.lit("_"), F.lit(" ")), F.lit(".")))
        .when(query == "forecast", F.concat(F.lit("The first day in "), place["city"], F.lit(" goes from "), day["temperature_min"].cast("string"), F.lit(" to "), day["temperature_max"].cast("string"), F.lit("°C.")))
        .otherwise(F.concat(place["city"], F.lit(" lies at "), place["latitude"].cast("string"), F.lit(", "), place["longitude"].cast("string"), F.lit(".")))
    )
    reply = F.when(failing, F.concat(F.lit("I am sorry, there was an error: "), error_payload(problem, F.col("function"))["message"])).otherwise(good)
    call_id = F.concat(F.lit("call_"), F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), row.cast("string")).cast("binary")), 1, 12))
    asked = F.lit("")
    for kind, texts in ASK.items():
        text = one_of(seed, row, "ask", F.array(*[F.lit(t) for t in texts]))
        asked = F.when(query == kind, F.replace(text, F.lit("{}"), place["city"])).otherwise(asked)
    opening = one_of(seed, row, "open", F.array(*[F.lit(t) for t in OPENING]))
    asked = F.when(F.col("scenario") == "multi_turn", F.concat(F.replace(opening, F.lit("{}"), place["city"]), F.lit(" "), asked)).otherwise(asked)
    intro, system = F.lit(""), F.lit(SYSTEM["neutral"])
    for kind, text in INTRO.items():
        intro = F.when(query == kind, text).otherwise(intro)
    for p in personas:
        system = F.when(F.col("persona") == p, F.lit(SYSTEM.get(p, SYSTEM["neutral"]))).otherwise(system)
    none_call, none = F.lit(None).cast(CALL), F.lit(None).cast("string")

    def said(role: str, content: Column, made: Column = none_call, ref: Column = none) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"), made.alias("tool_calls"), ref.alias("tool_call_id"))

    made = F.array(F.struct(call_id.alias("id"), F.lit("function").alias("type"), F.struct(F.col("function").alias("name"), F.col("arguments").alias("arguments")).alias("function"))).cast(CALL)
    messages = F.array(said("system", system), said("user", asked), said("assistant", intro, made), said("tool", told, none_call, call_id), said("assistant", reply))
    tone = F.lit("neutral")
    for p, t in TONES.items():
        tone = F.when(F.col("persona") == p, t).otherwise(tone)
    domain = F.array(F.lit("weather"), F.lit("tool_use"))
    return settled(rows.select(
        messages.alias("messages"),
        F.struct(F.col("persona"), tone.alias("tone"), domain.alias("domain"), F.lit("synthetic").alias("source"), F.col("scenario")).alias("tags"),
        F.struct(
            F.format_string("conv_%09d", row).alias("conversation_id"), F.struct(place["city"].alias("city"), place["country"].alias("country"), place["climate_zone"].alias("climate_zone")).alias("location"),
            F.col("query_type"), F.date_format("start", "yyyy-MM-dd").alias("generated_at"), F.lit("quern").alias("generator"),
        ).alias("metadata"),
    ))


def accepted(spark: SparkSession, n: int, locations: DataFrame, seed: int = 42, tries: int = 3, personas: dict[str, float] = PERSONAS) -> DataFrame:
    """n conversations that pass every check: ``tries`` times as many are made, in order, and the first n sound ones kept.

    A run that broke off is made again from the same seed, with the same rows;
    written by ranges of ids, it goes on with the first range that is missing.
    """
    made = checked(conversations(spark, n * tries, locations, seed, personas), locations)
    return made.where(F.size("errors") == 0).drop("errors").orderBy("metadata.conversation_id").limit(n)


def checked(made: DataFrame, locations: DataFrame) -> DataFrame:
    """made with ``errors``, of every kind, of each conversation."""
    lat, lon = asked_point(F.col("messages"))
    rows = nearest(made, lat, lon, locations, "_place")
    return rows.withColumn("errors", all_errors(F.col("messages"), F.col("tags.persona"), F.col("tags.tone"), F.col("tags.domain"), F.col("_place"))).drop("_place")


def resumed(spark: SparkSession, folder: str, n: int, locations: DataFrame, each: int = 1000, seed: int = 42) -> list[int]:
    """Conversations 0 to n written by ranges of ``each`` into folders of their own; ranges that stand there whole are left as they are.  The ranges that were made.

    Rows depend on the seed and their number only, so a run that broke off
    gives, gone on with, what it would have given.
    """
    made = []
    jvm = spark.sparkContext._jvm
    for k in range(-(-n // each)):
        path = f"{folder}/range={k}"
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            conversations(spark, min(each, n - k * each), locations, seed, first=k * each).write.mode("overwrite").json(path)
            made.append(k)
    return made


def variant(spark: SparkSession, n: int, locations: DataFrame, name: str, seed: int = 42) -> DataFrame:
    """n conversations of a named variant: balanced, or with more humor."""
    return conversations(spark, n, locations, seed, {"balanced": PERSONAS, "humor": HUMOR_PERSONAS}[name])


def weather_at(df: DataFrame, lat: str, lon: str, key: str, locations: DataFrame, month: int, seed: int = 42) -> DataFrame:
    """df with ``weather``: the current weather at the place nearest to its coordinates."""
    return nearest(df, F.col(lat), F.col(lon), locations, "_p").withColumn("weather", current_weather(F.col("_p"), F.col(key), F.lit(month), seed)).drop("_p")


def regenerated(df: DataFrame, text: str, flag: str, write=None) -> DataFrame:
    """df with the flagged texts written anew by ``write`` (an iterator of pandas frames to the same); by default a plain rewording that drops all up to the first sentence's end."""
    if write is not None:
        return df.mapInPandas(write, df.schema)
    rest = F.regexp_replace(F.col(text), r"^[^.!?]*[.!?]\s*", "")
    return df.withColumn(text, F.when(F.col(flag) & (F.length(rest) > 0), rest).otherwise(F.col(text)))
