"""Problems 2, 3, 5 and 9 against brute force on small fixtures."""

import itertools
import random
import re

import numpy as np
import pytest

from quern.llm import codepoints as cp
from quern.llm import leaks, neardup, spans, unify


def words(t):
    return re.findall(r"[^\W_]+", cp.one_form_texts([t])[0].lower())


def grams(t, n=3):
    w = words(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def similarity(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a | b else 0.0


def corpus(n, seed=0, size=24):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.5:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(0, 5)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [rng.choice(vocabulary)], [w[k], rng.choice(vocabulary)]])
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(rng.choice(vocabulary) for _ in range(size)))
    return texts


def brute_pairs(texts, least, threshold=0.6):
    ids = [k for k, t in enumerate(texts) if len(words(t)) >= least]
    return {(a, b) for a, b in itertools.combinations(ids, 2) if similarity(texts[a], texts[b]) >= threshold}


def found(spark, texts, **options):
    rows = spark.createDataFrame([(0, k, t) for k, t in enumerate(texts)], "tb tinyint, id long, text string")
    links, members = neardup.linked(rows, **options)
    from pyspark.sql import functions as F

    from quern.llm.common import expanded

    copies = members.groupBy("rep", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    out = expanded(links.select("a", "b").unionByName(copies), members.select("rep", "tb", "id"))
    return {(r.id_a, r.id_b) for r in out.collect()}


def test_near_duplicates_are_those_of_brute_force(spark):
    texts = corpus(300, 1)
    want = brute_pairs(texts, 10)
    got = found(spark, texts)
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 100


@pytest.mark.parametrize("hot", [1, 4, 20])
def test_hot_buckets_lose_nothing(spark, hot):
    shared = " ".join(f"s{k}" for k in range(30))
    texts = [f"{shared} t{k} u{k % 5}" for k in range(40)] + corpus(60, 2)
    assert found(spark, texts, hot=hot) == found(spark, texts)
    assert len(found(spark, texts)) >= 0.99 * len(brute_pairs(texts, 10))


def lone_band_pairs(spark, n=1500):
    """Pairs of texts of similarity 0.6 to 0.65 that have exactly one bucket in common, within the budget."""
    rng = random.Random(7)
    texts = []
    for k in range(n):
        w = [f"v{k}x{j}" for j in range(41)]
        texts.append(" ".join(w))
        for j in (5, 17, 29):
            w[j + rng.randrange(6)] = f"z{k}x{j}"
        texts.append(" ".join(w))
    rows = spark.createDataFrame([(0, k, t) for k, t in enumerate(texts)], "tb tinyint, id long, text string")
    sig = {r.id: r for r in neardup.signatures(rows).collect()}
    apart = lambda a, b: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in ((a.f1, b.f1), (a.f2, b.f2)))
    pairs = [(sig[k], sig[k + 1]) for k in range(0, 2 * n, 2)]
    return [(texts[a.id], texts[b.id]) for a, b in pairs if len(set(a.keys) & set(b.keys)) == 1 and apart(a, b) <= neardup.BUDGET]


def test_a_pair_whose_only_common_band_is_hot_is_found(spark):
    pairs = lone_band_pairs(spark)
    assert len(pairs) >= 5 and all(0.6 <= similarity(a, b) <= 0.65 for a, b in pairs)
    texts = [t for p in pairs for t in p]
    want = {(k, k + 1) for k in range(0, len(texts), 2)}
    assert found(spark, texts, hot=1) == want
    # copies of one text: its buckets hold many rows, but few classes
    copied = texts + [texts[0]] * 6
    assert found(spark, copied, hot=5) == brute_pairs(copied, 10) >= want


def test_recall_near_the_threshold(spark):
    rng = random.Random(11)
    texts = []
    for k in range(1000):  # pairs of similarity 0.61, of texts that share nothing else
        w = [f"v{k}x{j}" for j in range(42)]
        texts.append(" ".join(w))
        for j in (5, 17, 29):
            w[j + rng.randrange(6)] = f"z{k}x{j}"
        texts.append(" ".join(w))
    assert all(0.6 <= similarity(texts[k], texts[k + 1]) <= 0.65 for k in range(0, 60, 2))
    got = found(spark, texts)
    assert found(spark, texts, hot=1) == got and len(got) >= 995 and got <= {(k, k + 1) for k in range(0, 2000, 2)}


def test_the_trie_finds_all_pairs_within_the_budget():
    rng = np.random.default_rng(3)
    for budget in (0, 3, 30):
        n = 150
        key = np.sort(rng.integers(0, 4, n)).astype(np.uint64)
        f1, f2 = rng.integers(0, 1 << 62, n, dtype=np.uint64), rng.integers(0, 1 << 62, n, dtype=np.uint64)
        for k in range(0, n - 1, 2):
            f1[k + 1], f2[k + 1] = f1[k], f2[k] ^ np.uint64(int(rng.integers(0, 16)))
        f1[100:140], f2[100:140] = f1[100], f2[100]
        order = np.lexsort((f2, f1, key))
        key, f1, f2 = key[order], f1[order], f2[order]
        i, j = neardup.trie_pairs(key, f1, f2, budget)
        apart = lambda a, b: int(f1[a] ^ f1[b]).bit_count() + int(f2[a] ^ f2[b]).bit_count()
        want = {(a, b) for a, b in itertools.combinations(range(n), 2) if key[a] == key[b] and apart(a, b) <= budget}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_ties_nulls_and_short_texts(spark):
    same = "one two three four five six seven eight nine ten eleven"
    texts = [same, same.upper(), same + "!", None, "", "one two", "x" * 100_000, same]
    assert found(spark, texts) == set(itertools.combinations([0, 1, 2, 7], 2))


def leak_rows(spark, texts, held):
    return spark.createDataFrame([(h, k, t) for k, (t, h) in enumerate(zip(texts, held))] + [(None, 900, texts[0]), (True, None, texts[0]), (True, 901, None)], "held boolean, id long, text string")


def test_leaks(spark):
    texts = corpus(200, 4, size=30)
    rng = random.Random(5)
    held = [rng.choice([True, False, False]) for _ in texts]
    links, members = leaks.containments(leak_rows(spark, texts, held))
    from quern.llm.common import expanded

    got = {(r.id_a, r.id_b) for r in expanded(leaks.similar(links), members.select("rep", "id")).collect()}
    want = {(a, b) for a, b in brute_pairs(texts, 20) if held[a] != held[b]}
    assert got == want and want


@pytest.mark.parametrize("salt", [1, 3, 4096])
def test_containment_is_that_of_brute_force(spark, salt):
    texts = corpus(120, 8, size=30)
    rng = random.Random(9)
    held = [rng.choice([True, False, False]) for _ in texts]
    for k in range(0, 120, 6):  # an evaluation record whole inside a training record four times its size
        texts.append(" ".join([*(f"a{k}x{j}" for j in range(40)), texts[k], *(f"b{k}x{j}" for j in range(40))]))
        held.append(not held[k])
    boiler = " ".join(f"s{k}" for k in range(25))  # a stretch that many records share
    texts += [f"{boiler} t{k}" for k in range(30)]
    held += [k % 4 == 0 for k in range(30)]
    links, members = leaks.containments(leak_rows(spark, texts, held), salt=salt)
    reps = {r.id: r.rep for r in members.collect()}
    want = {}
    for a, b in itertools.product(range(len(texts)), repeat=2):
        x, y = grams(texts[a]), grams(texts[b])
        if held[a] and not held[b] and len(words(texts[a])) >= 20 and len(words(texts[b])) >= 20 and len(x & y) >= 0.6 * len(x):
            want[reps[a], reps[b]] = len(x & y) / len(x)
    got = {(r.a, r.b): r.shared / r.size_a for r in links.collect()}
    assert got == pytest.approx(want) and 1.0 in got.values()


def test_lookalikes(spark):
    texts = ["Rain at dawn", "Rаin at dawn", "Rain  at\tdawn", "Rain at dawn", "", "​", "!", "！", None, "rain at dawn", "Rain at dawn"]
    rows = spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "tb tinyint, id long, text string")
    got = {(r.id_a, r.id_b) for r in unify.lookalike_pairs(rows).collect()}
    same = [0, 1, 2, 3, 10]
    plain = {0: "p", 2: "p", 10: "p", 1: "c", 3: "n"}
    assert got == {(a, b) for a, b in itertools.combinations(same, 2) if plain[a] != plain[b]}


def test_many_copies_beside_a_variant_stay_linear(spark):
    texts = ["Rain at dawn"] * 300 + ["Rаin at dawn"]
    rows = spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "tb tinyint, id long, text string")
    _, each = unify.kinds(rows)
    assert unify.kind_pairs(each).count() == 1 and sorted(r.n for r in each.collect()) == [1, 300]
    assert {(r.id_a, r.id_b) for r in unify.lookalike_pairs(rows).collect()} == {(k, 300) for k in range(300)}


def brute_spans(texts, least):
    seen = {}
    for k, t in texts:
        for i in range(len(t or "") - least + 1):
            seen.setdefault(t[i : i + least], set()).add(k)
    out = set()
    for k, t in texts:
        marks = [i for i in range(len(t or "") - least + 1) if len(seen[t[i : i + least]]) > 1]
        begin = end = None
        for i in marks:
            if end is not None and i <= end:
                end = i + least
            else:
                if end is not None:
                    out.add((k, begin, end))
                begin, end = i, i + least
        if end is not None:
            out.add((k, begin, end))
    return out


@pytest.mark.parametrize("hot", [1, 5000])
def test_spans(spark, hot):
    rng = random.Random(7)
    make = lambda n: "".join(rng.choice("abcdeé 🌧") for _ in range(n))
    shared = [make(60) for _ in range(4)]
    texts = []
    for k in range(60):
        parts = [make(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 20)
            parts += [s[a : a + rng.randint(10, 60)], make(rng.randint(0, 30))]
        texts.append((k, "".join(parts)))
    texts += [(60, texts[0][1]), (61, texts[1][1] * 2), (62, None), (63, ""), (64, "a" * 200), (65, "a" * 90), (65, "a" * 90)]
    rows = spark.createDataFrame(texts, "id long, text string")
    got = {(r.id, r.begin, r.end) for r in spans.shared_spans(rows, least=30, k=12, hot=hot).collect()}
    assert got == brute_spans(texts, 30)
