"""Operators on small tables: rules, invariants and brute force."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from quern.functions import validate
from quern.operators import dedup, generate, joins, passages, sampling, stats
from quern.plans import pipelines, reports


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def test_exact(spark):
    df = texts(spark, ["Same text", "other", " same TEXT ", None, "", None])
    assert sorted(r.id for r in dedup.exact(df, "id", "text").collect()) == [0, 1, 3]
    stats_ = dedup.duplicate_stats(df, dedup.exact(df, "id", "text")).first()
    assert tuple(stats_) == (6, 3, 3, 50.0)


def test_near_copies_go_and_the_rest_stays(spark):
    base = "The weather is nice today in the valley and the river is calm. "
    df = texts(spark, [base * 3, base * 3 + "!", "Something quite different about a bakery and its owner."])
    assert sorted(r.id for r in dedup.remove_near(df, "id", "text").collect()) == [0, 2]
    again = dedup.remove_near(df, "id", "text")
    assert dedup.remove_near(again, "id", "text").count() == again.count()


def test_keep_first_is_the_two_hop_rule(spark):
    rng = random.Random(1)
    for _ in range(4):
        rows = [(k, b, str(rng.randrange(6))) for k in range(14) for b in range(2)]
        mates = {k: {j for j, b, key in rows if (b, key) in {(b2, k2) for i, b2, k2 in rows if i == k}} for k in range(14)}
        want = {j for j in range(14) if any(min(mates[k]) < j for k in mates[j])}
        got = {r.id for r in dedup.keep_first(spark.createDataFrame(rows, "id long, band int, key string")).collect()}
        assert got == want


@pytest.mark.parametrize("threshold", [0.55, 0.7, 0.8, 0.9])
def test_bands_of_every_threshold_are_those_of_brute_force(spark, threshold):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(200)).strip()
    values = ["".join(rng.choice("ijklmnop ") for _ in range(120)).strip() for _ in range(5)] + [base]
    for n in (1, 2, 4, 8, 16, 32):
        values.append("".join(rng.choice("qrst") if rng.random() < n / 200 else c for c in base))
    b, r = dedup.band_shape(threshold)
    pairs = dedup.coefficients(b * r)
    keys = []
    for t in values:
        hashes = {int(hashlib.md5(t[i : i + 3].encode()).hexdigest()[:7], 16) for i in range(len(t) - 2)}
        sig = [min((a * x + c) % dedup.PRIME for x in hashes) for a, c in pairs]
        assert len(sig) == b * r
        keys.append({(k, hashlib.md5(",".join(map(str, sig[k * r : k * r + r])).encode()).hexdigest()) for k in range(b)})
    df = texts(spark, values)
    got = {(x.id, x.band, x.key) for x in dedup.band_rows(df, "id", "text", threshold).collect()}
    assert got == {(k, *x) for k, own in enumerate(keys) for x in own}
    mates = [[j for j in range(len(values)) if keys[k] & keys[j]] for k in range(len(values))]
    gone = {k for k in range(len(values)) if any(min(mates[j]) < k for j in mates[k])}
    assert {x.id for x in dedup.near_keys(df, "id", "text", threshold).collect()} == gone
    assert gone.isdisjoint(range(6)) and gone


def test_unknown_modes_of_deduplication_are_errors(spark):
    items = spark.createDataFrame([(1, "some text")], "id long, content string")
    for mode in ("verified", "LSH", ""):
        with pytest.raises(ValueError, match="mode of deduplication"):
            pipelines.normalize(items, "id", options={"deduplication": {"mode": mode}})
    for mode in ("exact", "lsh"):
        assert pipelines.normalize(items, "id", options={"deduplication": {"mode": mode}}).counts().where("stage = 'dedup'").first().n == 1


def test_shingles(spark):
    r = spark.range(1).select(dedup.shingles(F.lit("ABCAB c")).alias("a"), dedup.shingles(F.lit("ab")).alias("b"), dedup.shingles(F.lit(None).cast("string")).alias("c"), dedup.shingles(F.lit("a\U0001f327bc")).alias("d")).first()
    assert sorted(r.a) == sorted({"abc", "bca", "cab", "ab ", "b c"}) and r.b == ["ab"] and r.c == [""] and len(r.d) == 2


def test_already_processed_and_newest(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, x string")
    done = spark.createDataFrame([("a",), (None,)], "y string")
    assert sorted(r.id for r in dedup.already_processed(df, F.col("x"), done, F.col("y")).collect()) == [2, 3]
    two = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")], "key string, at int, v string")
    assert sorted((r.key, r.v) for r in dedup.newest(two, ["key"], F.col("at")).collect()) == [("j", "only"), ("k", "new")]


def brute_balanced(rows, most):
    groups = {}
    for key, g, score in sorted(rows, key=lambda r: (-(r[2] if r[2] is not None else -1e9), r[0])):
        groups.setdefault(g, []).append(key)
    order = sorted(groups, key=lambda g: (-len(groups[g]), g))
    if len(order) == 1:
        return groups[order[0]][:most]
    out = [k for g in order for k in groups[g][: most // 2]]
    for g in order:
        rest = groups[g][most // 2 :]
        if len(out) < most:
            out += rest[: most - len(out)]
    return out[:most]


@pytest.mark.parametrize("most", [1, 4, 7, 20, 100])
@pytest.mark.parametrize("groups", [1, 2, 4])
def test_balanced(spark, most, groups):
    rng = random.Random(most * 10 + groups)
    rows = [(k, f"g{min(rng.randrange(groups), rng.randrange(groups))}", rng.choice([None, 1, 2, 3])) for k in range(40)]
    got = sampling.balanced(spark.createDataFrame(rows, "id long, g string, s int"), "g", "s", "id", most)
    assert sorted(r.id for r in got.collect()) == sorted(brute_balanced(rows, most))


def test_split_is_a_disjoint_cover_by_stratum(spark):
    rows = [(k, "a" if k < 100 else "b" if k < 107 else None) for k in range(108)]
    out = sampling.split(spark.createDataFrame(rows, "id long, s string"), ["s"], "id").collect()
    assert sorted(r.id for r in out) == list(range(108))
    train = lambda s: sum(r.split == "train" for r in out if r.s == s)
    assert (train("a"), train("b"), train(None)) == (90, 6, 0)
    all_ = sampling.split(spark.createDataFrame(rows, "id long, s string"), ["s"], "id", ratio=(10, 10)).collect()
    assert sum(r.split == "validation" for r in all_) == 2


def test_template_cap(spark):
    rows = [(k, "By Trade x" if k % 2 else "nothing") for k in range(20)]
    out = {r.id: r for r in sampling.template_cap(spark.createDataFrame(rows, "id long, text string"), "text", "id", {"t": "by trade"}, cap=3).collect()}
    assert [k for k, r in out.items() if r.pattern == "t" and not r.regenerate] and sorted(k for k, r in out.items() if r.pattern == "t" and not r.regenerate) == [1, 3, 5]
    assert not out[0].regenerate and out[0].pattern is None


def test_weighted_choice(spark):
    counts = {r.s: r["count"] for r in spark.range(4000).select(sampling.weighted(F.col("id"), {"a": 0.65, "b": 0.25, "c": 0.1}).alias("s")).groupBy("s").count().collect()}
    assert abs(counts["a"] / 4000 - 0.65) < 0.05 and abs(counts["c"] / 4000 - 0.1) < 0.03


def brute_passages(text, weather, humor, least):
    import re

    paras = [p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()]
    hit = lambda t, ws: any(w in re.split(r"[^\w]+", t.lower()) for w in ws)
    n = lambda i, j: len("\n\n".join(paras[i:j]).split())
    out = []
    for c in range(len(paras)):
        if not hit(" ".join(paras[max(0, c - 2) : c + 3]), weather + humor):
            continue
        begin, end = max(0, c - 1), min(len(paras), c + 2)
        while n(begin, end) < 150 and end < len(paras):
            end += 1
            if n(begin, end) > 600:
                end -= 1
                break
        if not least <= n(begin, end) <= 600:
            continue
        own = "\n\n".join(paras[begin:end])
        score = hit(own, weather) + hit(own, humor)
        if score:
            out.append((c, begin, end, n(begin, end), score))
    return out


def greedy(found):
    kept = []
    for c, begin, end, _, score in sorted(found, key=lambda r: -r[4]):
        if not any(min(end, e) - max(begin, b) > 0.2 * min(end - begin, e - b) for _, b, e in kept):
            kept.append((c, begin, end))
    return sorted(kept)


def test_passages(spark):
    rng = random.Random(3)
    docs = []
    for k in range(12):
        paras = [" ".join(rng.choice(["mill", "river", "said", "clerk", "tea"] + ["rain"] * (rng.random() < 0.2) + ["joke"] * (rng.random() < 0.1)) for _ in range(rng.choice([5, 30, 80, 400]))) for _ in range(rng.randint(0, 12))]
        docs.append((k, "\n\n".join(paras)))
    docs += [(90, None), (91, "")]
    df = passages.candidates(spark.createDataFrame(docs, "id long, text string"), "id", "text", ["rain"], ["joke"])
    got = {}
    for r in df.collect():
        got.setdefault(r.id, []).append((r.position, r.begin, r.end, r.word_count, r.relevance_score))
    want = {k: brute_passages(t or "", ["rain"], ["joke"], 75) for k, t in docs}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    chosen = {}
    for r in passages.without_overlap(df, "id").collect():
        chosen.setdefault(r.id, []).append((r.position, r.begin, r.end))
    assert {k: sorted(v) for k, v in chosen.items()} == {k: greedy(v) for k, v in want.items() if v}


def test_safety_fails_closed(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    labels = spark.createDataFrame([(1, 0), (1, None), (2, 0), (2, 1)], "item_id long, toxic int")
    v = joins.verdicts(labels)
    ids = lambda **k: sorted(r.id for r in joins.safe_only(items, "id", v, "item_id", **k).collect())
    assert ids() == [1] and ids(on_missing="keep") == [1, 3]
    with pytest.raises(ValueError):
        joins.safe_only(items, "id", v, "item_id", on_missing="x")


def test_language(spark):
    r = texts(spark, ["The rain is in the valley and it was cold", "Der Regen ist nicht in dem Tal", "Le vent est dans la vallée et il pleut", "El viento no es para los que", "", "zz qq", None]).select("id", joins.detected_language(F.col("text")).alias("l")).collect()
    assert [x.l for x in sorted(r)] == ["en", "de", "fr", "es", "unknown", "unknown", "unknown"]


def test_geocode_and_nearest(spark, data):
    places = spark.read.parquet(f"{data}/locations.parquet")
    first = places.orderBy("pos").first()
    asked = spark.createDataFrame([(first.city.upper(), first.country), ("Nowhere", "None"), (None, None)], "c string, n string")
    assert [r.found for r in joins.geocoded(asked, F.col("c"), F.col("n"), places).orderBy(F.col("c").desc_nulls_last(), "c").collect()].count(True) == 1
    rows = places.collect()
    points = [(random.Random(k).uniform(-90, 90), random.Random(k + 99).uniform(-180, 180)) for k in range(60)] + [(None, 1.0), (float("nan"), 0.0), (first.latitude, first.longitude), (1e6, 1e6)]
    asked = spark.createDataFrame([(k, *p) for k, p in enumerate(points)] * 2, "k int, a double, b double")
    got = {r.k: r.c for r in joins.nearest(asked, F.col("a"), F.col("b"), places).select("k", F.col("place.city").alias("c")).collect()}
    want = {k: None if a is None or a != a else min(rows, key=lambda p: ((p["latitude"] - a) ** 2 + (p["longitude"] - b) ** 2, p["pos"]))["city"] for k, (a, b) in enumerate(points)}
    assert got == want
    assert joins.nearest(asked, F.col("a"), F.col("b"), places.limit(0)).where("place is not null").count() == 0


def test_nearest_of_many_places_and_ties(spark):
    rng = random.Random(3)
    many = [(k, f"c{k}", float(rng.randrange(-60, 60)), float(rng.randrange(-60, 60))) for k in range(3000)]
    places = spark.createDataFrame(many, "pos int, city string, latitude double, longitude double")
    points = [(k, rng.choice([rng.uniform(-70, 70), float(rng.randrange(-60, 60)) + 0.5]), rng.uniform(-70, 70)) for k in range(60)]
    got = {r.k: r.p for r in joins.nearest(spark.createDataFrame(points, "k int, a double, b double"), F.col("a"), F.col("b"), places).select("k", F.col("place.pos").alias("p")).collect()}
    assert got == {k: min(many, key=lambda p: ((p[2] - a) ** 2 + (p[3] - b) ** 2, p[0]))[0] for k, a, b in points}


def test_languages_of_held_out_documents(spark):
    import os

    from quern.functions import language

    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test tables")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null and lang is not null and doc_id is not null")
    model = language.learned(docs.where("doc_id % 2 = 0"))
    held = language.detected(docs.where("doc_id % 2 = 1").select("doc_id", "text", F.lower(F.trim("lang")).alias("lang")), "text", model).collect()
    assert sum(r.lang == r.language for r in held) > 0.93 * len(held)  # some labels are wrong on purpose
    assert model.best(["", None, "!!! 12", "Завтра в городе ожидается дождь и сильный ветер."]) == ["", "", "", ""]
    assert language.learned(docs.limit(0)).best(["some text"]) == [""]


def test_retention():
    assert stats.retention({"loaded": 100, "dedup": 90, "language": 80, "safety": 70}) == {"initial": 100, "final": 70, "filtered": 30, "retention": 70.0}
    assert stats.retention({"loaded": 50, "dedup": 45})["final"] == 45 and stats.retention({})["retention"] == 0.0


def test_similarity(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] + [("b", "x")] * 2 + [("b", "z")] * 2, "s string, v string")
    assert stats.similarity(df, "s", "v", "a", "b").first().similarity == pytest.approx(0.5)
    assert stats.similarity(df, "s", "v", "a", "none").first().similarity == 0.0


def test_generated_conversations(spark, data):
    places = spark.read.parquet(f"{data}/locations.parquet")
    rows = generate.conversations(spark, 400, places)
    got = generate.checked(rows, places).select("tags.scenario", "metadata.query_type", F.col("errors").alias("e")).collect()
    assert all(not r.e for r in got if r.scenario != "error" or r.query_type == "geocode")
    assert all(r.e and r.e[0].startswith("JSON schema") for r in got if r.scenario == "error" and r.query_type != "geocode")
    again = generate.conversations(spark, 400, places).repartition(7)
    assert sorted(rows.select(F.to_json("messages").alias("m")).collect()) == sorted(again.select(F.to_json("messages").alias("m")).collect())
    cities = [r.city for r in rows.orderBy("metadata.conversation_id").select("metadata.location.city").collect()]
    n = places.count()
    assert all(len(set(cities[k : k + n])) == len(cities[k : k + n]) for k in range(0, 400 - n, n))


def test_accepted_conversations(spark, data):
    rows = generate.accepted(spark, 60, spark.read.parquet(f"{data}/locations.parquet"))
    got = rows.select("tags.scenario", "metadata.query_type").collect()
    assert len(got) == 60 and all(r.query_type == "geocode" for r in got if r.scenario == "error")


def test_pipelines(spark, data):
    passages_ = spark.read.parquet(f"{data}/passages.parquet").dropDuplicates(["passage_id"])
    run = pipelines.instruct(passages_, "passage_id")
    counts = {r.stage: r.n for r in run.counts().collect()}
    assert counts["loaded"] >= counts["chats"] >= counts["valid"] == run.rows.count() > 0
    assert {r.split for r in run.rows.select("split").distinct().collect()} <= {"train", "validation"}
    merged = pipelines.merge_datasets([spark.read.parquet(f"{data}/conversation.parquet").select("entry_id", "messages", "tags")], "entry_id")
    assert merged.count() == 100


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, text string")
    assert dedup.remove_near(none, "id", "text").count() == 0 and dedup.exact(none, "id", "text").count() == 0
    assert sampling.split(none.withColumn("s", F.lit("a")), ["s"], "id").count() == 0
    assert sampling.balanced(none.withColumns({"g": F.lit("a"), "s": F.lit(1)}), "g", "s", "id", 5).count() == 0
    assert passages.without_overlap(passages.candidates(none, "id", "text"), "id").count() == 0
    assert dedup.duplicate_stats(none, none).first().rate == 0.0
    assert stats.top_phrases(none, F.col("text")).count() == 0


def test_reports(tmp_path):
    files = reports.write(str(tmp_path / "r_{timestamp}"), "Run", {"counts": {"a": 1}, "rows": [{"x": 0.5, "y": "a|b"}], "none": []})
    assert all("{timestamp}" not in f for f in files)
    text = open(files[1]).read()
    assert "| x | y |" in text and "a\\|b" in text and "(none)" in text
    assert [reports.quality(x) for x in (0.96, 0.9, 0.8, 0.1)] == ["excellent", "good", "fair", "poor"]


def test_first_of_each_is_the_whole_rank(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice("ab"), rng.randrange(5)) for k in range(200)]
    got = sampling.first_of_each(spark.createDataFrame(rows, "id long, g string, s int"), ["g"], [F.col("s").desc(), F.col("id")], 9, F.col("id"), parts=4)
    want = {r[0] for g, own in itertools.groupby(sorted(rows, key=lambda r: (r[1], -r[2], r[0])), key=lambda r: r[1]) for r in list(own)[:9]}
    assert {r.id for r in got.collect()} == want


def test_ranks_of_a_hot_group(spark):
    rng = random.Random(11)
    rows = [("hot" if k % 3 else "cold", rng.randrange(50), k) for k in range(500)]
    got = sampling.ranked(spark.createDataFrame(rows, "g string, s int, id long").repartition(5), "g", [F.col("s"), F.col("id")], "r")
    want = {i: n for g in ("hot", "cold") for n, (_, _, i) in enumerate(sorted(r for r in rows if r[0] == g))}
    assert {r.id: r.r for r in got.collect()} == want
