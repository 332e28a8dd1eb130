"""Readers, writers, configuration and streams, in temporary folders."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.sources import config, readers, writers
from quern.streaming import streams

SCHEMA = T.StructType().add("id", "long").add("content", "string")


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize(
    "text, ids",
    [
        ('[{"id": 1, "content": "a"}, {"id": 2}]', [1, 2]), ('{"items": [{"id": 1}], "data": [{"id": 9}]}', [1]), ('{"data": [{"id": 3}]}', [3]), ('{"passages": [{"id": 4}]}', [4]), ('{"entries": [{"id": 5}]}', [5]),
        ('{"id": 6, "items": "no list"}', [6]), ("{ this is not valid json }", []), ("3", []), ('"text"', []), ("[]", []),
    ],
)
def test_json(spark, tmp_path, text, ids):
    df = readers.read_json(spark, put(tmp_path, "x.json", text), SCHEMA)
    assert sorted(r.id for r in df.collect()) == ids and "source_file" in df.columns


def test_json_infers_its_schema(spark, tmp_path):
    df = readers.read_json(spark, put(tmp_path, "x.json", '[{"a": 1, "b": {"c": ["x"]}}, {"a": 2, "d": null}]'))
    assert {"a", "b", "d"} <= set(df.columns) and sorted(r.a for r in df.collect()) == [1, 2]


def test_missing_files(spark, tmp_path):
    gone = str(tmp_path / "gone.json")
    assert readers.read_json(spark, gone, SCHEMA).count() == 0
    assert readers.read_jsonl(spark, gone, SCHEMA).count() == 0
    assert readers.read_csv(spark, gone) is None


def test_jsonl_leaves_bad_lines_out(spark, tmp_path):
    path = put(tmp_path, "x.jsonl", '{"id": 1, "content": "é"}\n\n{broken\n{"id": 2, "content": "b"}\n')
    assert sorted((r.id, r.content) for r in readers.read_jsonl(spark, path, SCHEMA).collect()) == [(1, "é"), (2, "b")]
    assert [r.value for r in readers.bad_lines(spark, path).collect()] == ["{broken"]


def test_csv_encodings(spark, tmp_path):
    head = "title,id\n"
    utf = readers.read_csv(spark, put(tmp_path, "a.csv", head + '"a ""q"" é\nb",1\n'), "title string, id int")
    latin = readers.read_csv(spark, put(tmp_path, "b.csv", head + "café,2\n", "latin-1"), "title string, id int")
    assert [tuple(r) for r in utf.collect()] == [('a "q" é\nb', 1)] and [tuple(r) for r in latin.collect()] == [("café", 2)]


def test_sources_by_suffix(spark, tmp_path):
    paths = [put(tmp_path, "a.json", '[{"id": 1, "content": "x"}]'), put(tmp_path, "b.jsonl", '{"id": 2, "content": "y"}\n'), put(tmp_path, "c.odd", '[{"id": 3}]'), put(tmp_path, "d.csv", "id,content\n4,z\n")]
    df = readers.read_sources(spark, paths, SCHEMA)
    assert sorted((r.id, r.source_file) for r in df.collect()) == [(1, "a.json"), (2, "b.jsonl"), (3, "c.odd"), (4, "d.csv")]
    book = readers.read_any(spark, put(tmp_path, "book.txt", "one\n\ntwo"))
    assert book.first().text == "one\n\ntwo" and book.first().source_file == "book.txt"


def test_fields_and_examples(spark):
    df = spark.createDataFrame([(1, None, "Mark Twain", "x" * 600), (2, "c", "Other", "y" * 60)], "id long, content string, author_name string, text string")
    assert [r.m for r in df.orderBy("id").select(readers.missing_fields(df, ["id", "content", "z"]).alias("m")).collect()] == [["content", "z"], ["z"]]
    assert [len(r.text) for r in readers.style_examples(df.withColumn("passage_id", F.col("id").cast("string")), "twain").collect()] == [500]


def test_fetch(tmp_path):
    path, calls, waits = str(tmp_path / "b.txt"), [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no")
        return "text"

    assert open(readers.cached_fetch(path, flaky, wait=waits.append)).read() == "text" and waits == [2, 4]
    assert readers.cached_fetch(path, None) == path
    with pytest.raises(OSError):
        readers.cached_fetch(str(tmp_path / "c.txt"), lambda: (_ for _ in ()).throw(OSError("x")), wait=lambda s: None)
    assert not (tmp_path / "c.txt").exists()


def test_jsonl_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "é"), (2, None)], SCHEMA)
    assert writers.write_jsonl(df, path, one_file=True)
    assert writers.verify_jsonl(spark, path, 2) == (True, 2, []) and writers.verify_jsonl(spark, path, 3)[2]
    writers.append_jsonl(df, path)
    assert readers.read_jsonl(spark, path, SCHEMA).count() == 4
    assert not writers.write_jsonl(df.limit(0), str(tmp_path / "none"), skip_empty=True) and not (tmp_path / "none").exists()
    (tmp_path / "bad").mkdir()
    put(tmp_path / "bad", "x.jsonl", '{"a": 1}\n{no\n')
    assert writers.verify_jsonl(spark, str(tmp_path / "bad"))[0] is False


def test_corpus_and_split_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "validation")], "id long, split string")
    writers.write_split(df, str(tmp_path / "s"))
    assert readers.read_jsonl(spark, str(tmp_path / "s" / "split=train"), "id long").first().id == 1
    writers.write_corpus(df, str(tmp_path / "c"), {"total": 2})
    assert json.loads(spark.read.text(str(tmp_path / "c" / "metadata")).first().value) == {"total": 2}


def test_text_is_replaced_as_a_whole(tmp_path):
    path = str(tmp_path / "a" / "b.json")
    writers.write_json(path, {"x": "é"})
    assert json.load(open(path)) == {"x": "é"} and len(list((tmp_path / "a").iterdir())) == 1


def test_config(tmp_path):
    path = put(tmp_path, "c.json", '{"_note": 1, "a": {"_kept": 2, "b": 3}}')
    c = config.load(path)
    assert c == {"a": {"_kept": 2, "b": 3}}
    assert config.merged(c, {"a": {"b": 4}, "z": 1}) == {"a": {"_kept": 2, "b": 4}, "z": 1}
    assert config.get(c, "a.b") == 3 and config.get(c, "a.x.y", 7) == 7 and config.missing(c, ["a.b", "q"]) == ["q"]


def test_stream(spark, tmp_path):
    src, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = [(1, "The rain is in the valley", "2025-01-01 00:10:00"), (2, "the rain is in the valley ", "2025-01-01 00:20:00"), (3, "kurz", "2025-01-01 01:20:00"), (4, "It was a cold day in the town", "2025-01-01 01:30:00")]
    df = spark.createDataFrame(rows, "id long, content string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(src)
    live = streams.first_seen(streams.cleaned(streams.stream(spark, src, df.schema)), "content", "at")
    streams.to_folder(live, out, check).awaitTermination()
    ids = sorted(r.id for r in spark.read.json(out).collect())
    assert len(ids) == 2 and ids[1] == 4 and ids[0] in (1, 2)
    batch = streams.windowed(df, "at", [], value=F.col("id"))
    assert sorted((str(r.begin), r.n, r.total) for r in batch.collect()) == [("2025-01-01 00:00:00", 2, 3), ("2025-01-01 01:00:00", 2, 7)]
