"""Problem 5: texts that look the same but are stored with other characters.

``forms`` explodes every text to positioned code points, joins them with the
decomposition and look-alike tables (derived once from Unicode data, so of
fixed size, and broadcast), orders combining marks by class, recomposes and
rebuilds the strings.  Positions are row offsets in numpy columns, so no
code point is ever shuffled; a row with nothing to change is passed through.

Defined results: a null text has the form null, an empty or blank one the
empty form; both are never a pair, since a form must hold a letter or digit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import codepoints as cp
from quern.llm.common import keep, small, table_name, text_rows

_ASCII_SPACE = np.zeros(128, bool)
_ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True


def ascii_squeeze(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose ordinary ASCII white space is collapsed and trimmed; any other character stays."""
    if not len(codes):
        return codes, offsets
    space = _ASCII_SPACE[np.minimum(codes, 127)] & (codes < 128)
    begins = np.zeros(len(codes) + 1, bool)
    begins[offsets] = True
    codes, offsets = cp._keep(np.where(space, np.uint32(32), codes), offsets, ~(space & (begins[:-1] | np.r_[True, space[:-1]])))
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    mask = np.ones(len(codes), bool)
    mask[ends[codes[ends] == 32]] = False
    return cp._keep(codes, offsets, mask)


def row_hashes(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """62-bit hashes of whole rows, of their content only."""
    return cp.mix(cp.span_hashes(cp.prefix_sums(codes), offsets[:-1], offsets[1:]) ^ cp.mix(np.diff(offsets).astype(np.uint64)))


def forms(rows: DataFrame, text: str = "text", out: str = "form") -> DataFrame:
    """rows with the one form of a text column added as ``out`` (null stays null)."""
    schema = rows.withColumn(out, F.lit("")).schema
    schema[out].nullable = True
    tables = cp.broadcast_tables(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cp.use(tables.value)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            made = [None if t is None else f for t, f in zip(texts, cp.one_form_texts(texts))]
            columns = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != out} | {out: pa.array(made, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def digests(rows: DataFrame) -> DataFrame:
    """(tb, id, h1, h2, plain) of (tb, id, text): a 126-bit hash of the one form and a hash of the stored text but for ASCII white space.

    Rows whose form holds no letter or digit are left out: they are no case.
    """
    tables = cp.broadcast_tables(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cp.use(tables.value)
        for batch in batches:
            texts, tb, ids = batch.column("text").to_pylist(), batch.column("tb").to_numpy(), batch.column("id").to_numpy()
            for a, b in cp.slices(texts):
                codes, offsets = cp.explode(texts[a:b])
                plain = row_hashes(*ascii_squeeze(codes, offsets))
                codes, offsets = cp.one_form(codes, offsets)
                h1 = row_hashes(codes, offsets)
                h2 = cp.row_digest(codes.astype(np.uint64), offsets)
                has = np.zeros(len(codes) + 1, np.int64)
                np.cumsum(cp.tables().alnum[codes], out=has[1:])
                good = has[offsets[1:]] > has[offsets[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb[a:b][good]), pa.array(ids[a:b][good]), *(pa.array(x[good].view(np.int64)) for x in (h1, h2, plain))],
                    names=["tb", "id", "h1", "h2", "plain"],
                )

    return rows.where("text is not null and id is not null").mapInArrow(run, "tb tinyint, id long, h1 long, h2 long, plain long")


def kinds(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (tb, id, text): members (kind, form, tb, id), and kinds (form, kind, tb, least, n).

    A form is all texts of a table that read the same, a kind those of them
    stored alike but for ASCII white space; both are named by hashes.  Kinds
    are counted by pre-aggregation, so copies cost a row each and no more.
    """
    d = digests(rows)
    form = F.xxhash64("tb", "h1", "h2")
    members = keep(d.select(F.xxhash64("tb", "h1", "h2", "plain").alias("kind"), form.alias("form"), "tb", "id").distinct(), now=True)  # rows may be repeated in the table
    return members, members.groupBy("form", "kind", "tb").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))


def kind_pairs(each: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of kinds of one form: only forms of several kinds get so far, so a form of one kind with any number of copies gives none."""
    mixed = each.groupBy("form").agg(F.min("kind").alias("lo"), F.max("kind").alias("hi")).where("lo != hi").select("form")
    some = keep(each.select("form", "kind").join(mixed, "form"))
    return some.select("form", F.col("kind").alias("a")).join(some.select("form", F.col("kind").alias("b")), "form").where("a < b").select("a", "b")


def lookalike_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (tb, id_a, id_b) of one table with the same form whose stored texts differ in more than ASCII white space.

    Kinds are paired first, and each pair of kinds is then expanded to its
    records: a million copies beside one variant are a million rows on the
    way, as many as in the result.
    """
    members, each = kinds(rows)
    pairs = kind_pairs(each)
    left = members.select(F.col("kind").alias("a"), "tb", F.col("id").alias("x")).join(small(pairs), "a")
    both = left.join(members.select(F.col("kind").alias("b"), F.col("id").alias("y")), "b")
    return both.select("tb", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).where("id_a < id_b").distinct()


# ---------------------------------------------------------------- queries


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, id_a, id_b) as TESTDATA.md states problem 5."""
    return lookalike_pairs(text_rows(spark, folder)).select(table_name(F.col("tb")).alias("table_name"), "id_a", "id_b")


def p5_forms(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, id, form, changed): every text in its one form."""
    made = forms(text_rows(spark, folder))
    return made.select(table_name(F.col("tb")).alias("table_name"), "id", "form", F.coalesce(F.col("form") != F.col("text"), F.lit(False)).alias("changed"))


def p5_classes(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, id, class_id, kind_id, copies, kinds): every record whose form holds a letter or digit, with the least id of its form and of those stored like it, how many those are, and how many kinds of stored text its form has."""
    members, each = kinds(text_rows(spark, folder))
    each = keep(each)
    forms_ = each.groupBy("form").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("kinds"))
    known = each.select("kind", "form", F.col("least").alias("kind_id"), F.col("n").alias("copies")).join(forms_, "form")
    out = members.select("kind", "tb", "id").join(known, "kind")
    return out.select(table_name(F.col("tb")).alias("table_name"), "id", "class_id", "kind_id", "copies", "kinds")
