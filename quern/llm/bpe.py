"""Problem 7: exact byte-level BPE ids in linear time.

A text is cut into pieces by the tokenizer's pattern.  A piece's bytes, read
as Latin-1, run once through an Aho-Corasick automaton of all tokens, which
gives the longest token at every position.  Tokens are then laid from the
left, longest first; one may follow another only if the two are compatible,
that is, if merging the bytes of both by rank gives just these two.  Where no
token fits, the position is dead and the last token is taken back for its next
shorter prefix.  A sequence all of whose neighbours are compatible is the one
that the merges produce, so the result is exact.  Compatibility of pairs and
ids of pieces are memoised in tables of bounded size.

Defined results: null and empty text give an empty list of ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import spread, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which this public tokenizer cuts texts.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 200_000  # entries of each memo


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file: a line has a token in base64 and its rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


class Encoder:
    """Ids of texts by a vocabulary of ranked byte tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.cut = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token in ranks:
            self.automaton.add_word(token.decode("latin-1"), len(token))
        self.automaton.make_automaton()
        self.prefix: dict[int, int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}

    def merged(self, raw: bytes) -> list[int]:
        """The ids by the definition: the adjacent pair of lowest rank is merged, again and again."""
        parts = [raw[k : k + 1] for k in range(len(raw))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, a: int, b: int) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            known = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
            if len(self.fits) >= MEMO:
                self.fits.clear()
            self.fits[a, b] = known
        return known

    def shorter(self, token: int) -> int:
        """The size of the longest token that is a proper prefix of a token; 0 if there is none."""
        size = self.prefix.get(token)
        if size is None:
            raw = self.tokens[token]
            size = next((k for k in range(len(raw) - 1, 0, -1) if raw[:k] in self.ranks), 0)
            self.prefix[token] = size
        return size

    def encode_bytes(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        if whole is not None and self.merged(raw) == [whole]:
            return [whole]
        n = len(raw)
        longest = [0] * n
        for end, size in self.automaton.iter(raw.decode("latin-1")):
            longest[end - size + 1] = size
        dead = bytearray(n + 1)
        out: list[int] = []
        at, size = 0, longest[0]
        while at < n:
            while size:
                token = self.ranks[raw[at : at + size]]
                if not dead[at + size] and (not out or self.compatible(out[-1], token)):
                    break
                size = self.shorter(token)
            if size:
                out.append(token)
                at += size
                size = longest[at] if at < n else 0
            else:
                dead[at] = 1
                size = len(self.tokens[out.pop()])
                at -= size
        return out

    def piece(self, text: str) -> tuple[int, ...]:
        ids = tuple(self.encode_bytes(text.encode("utf-8", "replace")))
        if len(text) <= 64:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        get, piece = self.memo.get, self.piece
        return list(chain.from_iterable([get(p) or piece(p) for p in self.cut(text)]))


_built: dict[int, Encoder] = {}


def encoder(raw: bytes) -> Encoder:
    """The encoder of a vocabulary file's content, built once in each process."""
    key = hash(raw)
    if key not in _built:
        _built[key] = Encoder(read_ranks(raw))
    return _built[key]


def _vocabulary(spark: SparkSession, path: str):
    """A broadcast of the vocabulary file: of fixed size, read by the driver."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(rows: DataFrame, text: str = "text", key: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """(key, ids) of each row: the ids of its text, without special tokens."""
    spark = rows.sparkSession
    raw = _vocabulary(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(raw.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for k in range(0, len(texts), 1000):
                ids = [own.encode(t) for t in texts[k : k + 1000]]
                offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1000), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[key, "ids"])

    kind = dict(rows.dtypes)[key]
    return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(rows: DataFrame, text: str = "text", out: str = "n_tokens", path: str = VOCABULARY) -> DataFrame:
    """rows with the text column replaced by its number of tokens (0 for null and empty)."""
    raw = _vocabulary(rows.sparkSession, path)
    schema = rows.drop(text).withColumn(out, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(raw.value)
        get, piece = own.memo.get, own.piece
        for batch in batches:
            sizes = [sum([len(get(p) or piece(p)) for p in own.cut(t)]) if t else 0 for t in batch.column(text).to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns)) | {out: pa.array(sizes, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids) as TESTDATA.md states problem 7."""
    return encoded(spread(table(spark, folder, "documents").select("doc_id", "text")))
