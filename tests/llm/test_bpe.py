import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import bpe

FILE = "/opt/tokenizers/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no tokenizer files")


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    with open(bpe.VOCABULARY, "rb") as f:
        own = bpe.Encoder(bpe.read_ranks(f.read()))
    return own, lambda s: t.encode(s, add_special_tokens=False).ids


def test_random_texts(both):
    own, other = both
    rng = random.Random(1)
    for _ in range(1500):
        s = "".join(rng.choice("aaaabcdefghiй théßx.,;!12'\n\t🌧한<|>") for _ in range(rng.randint(0, 60)))
        assert own.encode(s) == other(s)


@settings(max_examples=300, deadline=None)
@given(s=st.text(max_size=60))
def test_any_text(both, s):
    own, other = both
    assert own.encode(s) == other(s)


def test_pieces_are_merged_exactly(both):
    own, _ = both
    rng = random.Random(2)
    for _ in range(300):
        raw = bytes(rng.choice(b"the ingaeiou\xc3\xa9") for _ in range(rng.randint(1, 24)))
        assert own.encode_bytes(raw) == own.merged(raw)


def test_null_empty_and_long(both):
    own, other = both
    assert own.encode(None) == own.encode("") == []
    for s in ("x" * 100_000, "ab" * 50_000, " " * 5000, "<|endoftext|>"):
        assert own.encode(s) == other(s)


def test_round_trip_and_counts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    with open(bpe.VOCABULARY, "rb") as f:
        tokens = {i: t for t, i in bpe.read_ranks(f.read()).items()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = {r.doc_id: r.ids for r in bpe.p7_ids(spark, data).collect()}
    assert ids.keys() == texts.keys()
    assert all(b"".join(tokens[i] for i in ids[k]).decode() == (t or "") for k, t in texts.items())
    counts = {r.doc_id: r.n_tokens for r in bpe.token_counts(docs.select("doc_id", "text")).collect()}
    assert counts == {k: len(v) for k, v in ids.items()}
