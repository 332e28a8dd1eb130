"""Languages told apart by their letters: a naive Bayes model of hashed letter trigrams, learned from labelled texts.

The model is a table of fixed size (languages x BUCKETS), whatever it is
learned from: it is counted over every text, counts are added up in the
workers, and only they reach the driver.  It gives the likeliest language of a text, and, for texts in none of
the languages it knows, whether a text fits a given language at all: the mean
log-probability of its trigrams is compared with that of texts known to be in
the language.

Defined results: null, empty and letterless texts have no language ('').
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 16
PART = 1 << 18  # characters of texts worked on at once (a longer text is alone)
LEAST = 20  # trigrams below which a text may fit any language
BETWEEN = 0.15  # variance of a text's mean log-probability that comes from its style
FOREIGN = 3.3  # misfit beyond which a text is in none of the languages known


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@functools.cache
def _spaces() -> np.ndarray:
    return np.fromiter((chr(c).isspace() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _kept(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points with anything but letters as a blank, and where those are that stay: all but blanks after a blank of their row."""
    letter = _letters().take(codes)
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (rows[1:] != rows[:-1])
    keep[:1] = True
    at = np.flatnonzero(keep)
    return np.where(letter.take(at), codes.take(at), np.uint32(32)), at


def _buckets(codes: np.ndarray) -> np.ndarray:
    """The bucket of each run of three code points."""
    codes = codes.astype(np.uint64)
    h, x = codes[:-2] * np.uint64(0x9E3779B97F4A7C15), codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    h += x
    np.multiply(codes[2:], np.uint64(0x165667B19E3779F9), out=x)
    h += x
    np.right_shift(h, np.uint64(29), out=x)
    h ^= x
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h >>= np.uint64(48)
    return h.astype(np.int64)


def trigrams_of(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of lower-cased code points, and the row of each; anything but letters is one blank, and no trigram crosses rows."""
    codes, at = _kept(codes, rows)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = rows.take(at)
    inside = np.flatnonzero(rows[:-2] == rows[2:])
    return _buckets(codes).take(inside), rows.take(inside)


def _codes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, a line break before and a blank after each, and their rows."""
    joined = "".join("\n" + (t or "").replace("\n", " ").lower() + " " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.cumsum(codes == 10, dtype=np.int32) - 1


def trigrams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of all texts, and the number of the text of each."""
    return trigrams_of(*_codes(texts))


def sentence_trigrams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same with the sentence of each trigram, numbered over all texts (-1: it has letters of two), and the text of each sentence.

    A sentence ends at white space after a full stop, a question or an
    exclamation mark.  The trigrams of a sentence are those it has on its own.
    """
    codes, rows = _codes(texts)
    begins = codes == 10
    stop = (codes == ord(".")) | (codes == ord("!")) | (codes == ord("?"))
    begins[1:] |= stop[:-1] & _spaces().take(codes[1:])
    text = rows.take(np.flatnonzero(begins))
    sentence = np.cumsum(begins, dtype=np.int32) - 1
    codes, at = _kept(codes, rows)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), text
    rows, sentence = rows.take(at), sentence.take(at)
    inside = np.flatnonzero(rows[:-2] == rows[2:])
    apart = (codes[1:-1] == 32) & (sentence[:-2] != sentence[2:])  # a blank with a sentence's end in it
    return _buckets(codes).take(inside), rows.take(inside), np.where(apart, np.int32(-1), sentence[1:-1]).take(inside), text


class Languages:
    """names, log-probabilities (languages, BUCKETS) of trigrams, and the mean and the spread of a trigram's log-probability in texts of each language."""

    def __init__(self, names: list[str], counts: np.ndarray, rest: float = 0.1) -> None:
        self.names = names
        # the same share is left for trigrams not seen in each language, however much text it was learned from
        self.logp = np.log((1 - rest) * counts / np.maximum(counts.sum(1, keepdims=True), 1) + rest / BUCKETS).astype(np.float32)
        self.mean, self.spread = np.zeros(len(names)), np.full(len(names), 4.0)

    def sums(self, grams: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities (size, languages) of rows of trigrams, row after row, and their numbers of trigrams."""
        n = np.bincount(rows, minlength=size)
        out, full = np.zeros((size, len(self.names))), np.flatnonzero(n)
        if len(full):
            begin = (np.cumsum(n) - n)[full]
            for k, p in enumerate(self.logp):
                out[full, k] = np.add.reduceat(p.take(grams), begin, dtype=np.float64)
        return out, n

    def likeliest(self, s: np.ndarray, n: np.ndarray, lead: float = 2.0, each: float = 0.8) -> np.ndarray:
        """The likeliest language of each row of sums, by number; -1 where there is none, or too little leads: in all, and for each of the first 2 * LEAST trigrams."""
        if not self.names:
            return np.full(len(n), -1)
        top = s.argmax(1)
        ordered = np.sort(s, 1)
        ahead = ordered[:, -1] - ordered[:, -2] if len(self.names) > 1 else np.full(len(n), np.inf)
        return np.where((n > 0) & (ahead >= np.maximum(lead, each * np.minimum(n, 2 * LEAST))), top, -1)

    def misfit(self, s: np.ndarray, n: np.ndarray) -> np.ndarray:
        """By how many standard deviations a row's mean log-probability is below what is usual in each language.

        The variance is that of as many trigrams, and BETWEEN for the style of
        a text, so the measure settles for long texts.
        """
        m = np.maximum(n, 1)[:, None]
        return (self.mean - s / m) / np.sqrt(self.spread**2 / m + BETWEEN)

    def best(self, texts: Sequence[str | None]) -> list[str]:
        """The likeliest language of each text; '' if nothing tells, or if it fits none that is known."""
        s, n = self.sums(*trigrams(texts), len(texts))
        top = self.likeliest(s, n)
        strange = (self.misfit(s, n).min(1) > FOREIGN) & (n >= LEAST) if self.names else np.zeros(len(texts), bool)
        return ["" if k < 0 or odd else self.names[k] for k, odd in zip(top.tolist(), strange.tolist())]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one have at most about PART characters."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(upto, PART + (upto[start - 1] if start else 0), "right")))
            yield batch.slice(start, end - start)
            start = end


def _owners(batch: pa.RecordBatch, names: list[str], model: Languages | None, grams: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Numbers of the languages of texts of these trigrams (-1: not to be used).  With a model, a labelled text must be taken for what its label says, and one without label is what it is taken for if it fits."""
    own = np.array([-1 if x is None else names.index(x) for x in batch.column("lang").to_pylist()], np.int64)
    if model is not None:
        s, n = model.sums(grams, row, len(own))
        top = model.likeliest(s, n)
        fits = (top >= 0) & (model.misfit(s, n)[np.arange(len(top)), top] < 1.5 * FOREIGN)
        own = np.where(own < 0, np.where(fits, top, -1), np.where(own == top, own, -1))
    return own


def _counted(rows: DataFrame, names: list[str], model: Languages | None) -> np.ndarray:
    """Counts (languages, BUCKETS) of the trigrams of rows (text, lang)."""
    kind = "lang string, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(names), BUCKETS), np.int64)
        for batch in _parts(batches):
            grams, row = trigrams(batch.column("text").to_pylist())
            of = _owners(batch, names, model, grams, row).take(row)
            good = np.flatnonzero(of >= 0)
            held += np.bincount(of.take(good) * BUCKETS + grams.take(good), minlength=held.size).reshape(held.shape)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([h.tobytes() for h in held], pa.binary())], names=["lang", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
                sums[lang] = sums.get(lang, 0) + np.frombuffer(raw, np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "counts"])

    out = np.zeros((len(names), BUCKETS), np.int64)
    for r in rows.mapInArrow(count, kind).repartition("lang").mapInArrow(add, kind).collect():  # a row for each language
        out[names.index(r["lang"])] = np.frombuffer(r["counts"], np.int64)
    return out


def _settle(rows: DataFrame, model: Languages) -> None:
    """Put into a model what is usual in its languages: the mean and the spread of the log-probabilities of a trigram, sentence by sentence."""
    names = model.names

    def usual(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            grams, row, sentence, text = sentence_trigrams(batch.column("text").to_pylist())
            own = _owners(batch, names, model, grams, row).take(text)
            alone = np.flatnonzero(sentence >= 0)
            s, n = model.sums(grams.take(alone), sentence.take(alone), len(own))
            good = (n >= LEAST) & (s.argmax(1) == own) if len(own) else np.zeros(0, bool)
            for k in range(len(names)):
                mine = good & (own == k)
                if mine.any():
                    sums, size = s[mine, k], n[mine]
                    apart = np.abs(sums / size - sums.sum() / size.sum()) * np.sqrt(size)
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (k, float(size.sum()), float(sums.sum()), float(len(size)), float(np.median(apart) * len(size)))], names=["k", "n", "s", "m", "d"])

    for r in rows.mapInArrow(usual, "k long, n double, s double, m double, d double").groupBy("k").agg(*[F.sum(c).alias(c) for c in "nsmd"]).collect():
        model.mean[r["k"]] = r["s"] / r["n"]
        model.spread[r["k"]] = max(1.0, 1.48 * r["d"] / r["m"])  # a normal spread is 1.48 times the median distance


def learned(labelled: DataFrame, text: str = "text", lang: str = "lang", other: DataFrame | None = None, least_share: float = 0.005) -> Languages:
    """A model of the labels of all rows.

    Labels are trimmed and lower-cased; those of less than ``least_share`` of
    the rows are left out.  Some may be wrong, so the model is learned again
    from the texts that it takes for what their labels say.  ``other`` has
    texts without labels, in a column of the same name, to whose style the
    model is to be fitted: all of them that fit one of the languages are
    learned as well.  Texts are read anew for every pass; none are kept.
    """
    rows = labelled.select(F.col(text).alias("text"), F.lower(F.trim(F.col(lang))).alias("lang")).where("text is not null and lang != ''")
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.sum("n").over(Window.partitionBy())).where(F.col("n") >= F.greatest(F.col("all") * least_share, F.lit(5)))
    names = sorted(r["lang"] for r in known.orderBy(F.col("n").desc(), "lang").limit(100).collect())
    if not names:
        return Languages([], np.zeros((0, BUCKETS)))
    rows = rows.where(F.col("lang").isin(names))
    model = Languages(names, _counted(rows, names, None))
    if other is not None:
        _settle(rows, model)  # only what has no label is asked whether it fits
        rows = rows.unionByName(other.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.lit(None).cast("string").alias("lang")))
    model = Languages(names, _counted(rows, names, model))
    _settle(rows, model)
    return model


def detected(rows: DataFrame, text: str, model: Languages, out: str = "language") -> DataFrame:
    """rows with the likeliest language of a text column; 'unknown' if there is none."""
    schema = rows.drop(out).withColumn(out, F.lit("")).schema
    held = rows.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                found = [x or "unknown" for x in held.value.best(batch.column(text).to_pylist())]
                columns = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != out} | {out: pa.array(found, pa.string())}
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)
