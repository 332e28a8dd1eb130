"""Every query on empty tables, and on tables of nulls, repeated rows and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

from quern.llm import queries

NAMES = sorted(queries.queries())
TABLES = ("clean_items", "documents", "conversation", "safety_labels", "sample_targets", "mix_targets")
CLASHING = ("tb", "rep", "key", "a", "b", "d1", "h1", "begin", "end", "score", "language", "n_tokens", "held", "_k", "quota", "flagged", "form", "anchor")


def query(name):
    return queries.queries()[name]


@pytest.fixture(scope="module")
def empty(spark, data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"{data}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.fixture(scope="module")
def odd(spark, data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    for t in TABLES:
        df = spark.read.parquet(f"{data}/{t}.parquet")
        few = df.limit(25)
        nulls = few.limit(3).select(*[F.lit(None).cast(kind).alias(c) for c, kind in df.dtypes])
        key = df.columns[0]
        half = few.limit(3).select(*[(F.col(c) if c == key else F.lit(None).cast(kind)).alias(c) for c, kind in df.dtypes])
        rows = df.unionByName(few).unionByName(nulls).unionByName(half)
        rows.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns}).coalesce(2).write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_empty(spark, empty, name):
    got = query(name)(spark, empty).collect()
    assert got == [] if name not in ("p4_found", "p4_report", "p8_report") else True


@pytest.mark.parametrize("name", NAMES)
def test_odd(spark, odd, name):
    df = query(name)(spark, odd)
    rows = df.collect()
    if name.endswith("_found"):
        assert len(rows) == len(set(rows)) or name == "p6_found"
        assert all(v is not None for r in rows for v in r)


def test_columns(spark, empty):
    want = {
        "p1_found": ["id"], "p2_found": ["entry_a", "entry_b"], "p3_found": ["table_name", "id_a", "id_b"], "p4_found": ["persona", "tone", "first_domain"],
        "p5_found": ["table_name", "id_a", "id_b"], "p6_found": ["entry_id", "msg_index", "defect"], "p7_ids": ["doc_id", "ids"], "p8_found": ["source"], "p9_found": ["doc_id", "span_start", "span_end"],
    }
    assert {n: query(n)(spark, empty).columns for n in want} == want


def test_groups_are_components(spark, data):
    from quern.llm.common import components

    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 102), (102, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


def test_sql_agrees(spark, data):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df = query(name)(spark, data)
        assert sorted(map(tuple, df.collect()), key=str) == sorted(con.execute(f"select {', '.join(df.columns)} from ({sql})").fetchall(), key=str)
