"""Problems 4 and 8: flows, budgets and draws."""

import random
from fractions import Fraction

from quern.llm import mixing, sample


def cell(p, t, d, share, floor, have):
    return {"persona": p, "tone": t, "first_domain": d, "share": Fraction(share), "min_rows": floor, "have": have}


def test_slack_is_what_cannot_be_met():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 9)
        weights = [rng.randint(0, 9) for _ in range(n)]
        total = sum(weights) or 1
        cells = [cell(f"p{k % 3}", f"t{k % 2}", f"d{k}", Fraction(w, total), rng.randint(0, 4), rng.choice([0, rng.randint(0, 40)])) for k, w in enumerate(weights)]
        size = rng.randint(0, 60)
        out = sample.solve(cells, size, seed=rng.randint(0, 99))
        for c in out:
            assert c["slack"] == max(0, c["need"] - c["have"])
            assert (c["slack"] > 0) == (c["have"] < c["min_rows"] or c["have"] < c["share"] * size)
            assert c["quota"] <= c["have"] and c["quota"] >= min(c["have"], c["min_rows"])
        if sum(weights):
            assert sum(c["quota"] for c in out) == min(sum(c["have"] for c in out), max(size, sum(min(c["have"], c["min_rows"]) for c in out)))


def test_a_shortage_goes_to_the_same_persona_first():
    cells = [cell("a", "x", "1", "1/2", 0, 2), cell("a", "x", "2", "1/4", 0, 50), cell("b", "y", "1", "1/4", 0, 50)]
    quotas = [c["quota"] for c in sample.solve(cells, 40)]
    assert quotas == [2, 28, 10]


def test_rounding_keeps_the_total():
    rng = random.Random(2)
    for _ in range(50):
        parts = [rng.randint(0, 100) for _ in range(7)]
        values = [Fraction(p * 13, sum(parts) or 1) for p in parts]
        out = sample.rounded(values, 13, random.Random(rng.randint(0, 999)))
        assert all(v - 1 < o < v + 1 for v, o in zip(values, out))
        assert not sum(parts) or sum(out) == 13


def test_sample_meets_its_quotas(spark, data):
    quotas = {(r.persona, r.tone, r.first_domain): r.quota for r in sample.p4_report(spark, data).collect()}
    rows = sample.p4_sample(spark, data).collect()
    got = {}
    for r in rows:
        got[r.persona, r.tone, r.first_domain] = got.get((r.persona, r.tone, r.first_domain), 0) + 1
    assert got == {k: v for k, v in quotas.items() if v}
    assert sample.p4_sample(spark, data).orderBy("conversation_id", "tone").collect() == sorted(rows, key=lambda r: (r.conversation_id, r.tone))


def test_shortages_go_to_siblings_before_ancestors():
    f = Fraction
    root = mixing.grow([(("prose", "en", "a"), f(40), f(10)), (("prose", "en", "b"), f(20), f(100)), (("prose", "de", "a"), f(20), f(100)), (("talk", "en", "c"), f(20), f(100))])
    mixing.allot(root, f(100))
    got = {leaf.name: leaf.budget for leaf in mixing.leaves_of(root)}
    assert got == {("prose", "en", "a"): 10, ("prose", "en", "b"): 50, ("prose", "de", "a"): 20, ("talk", "en", "c"): 20}
    root = mixing.grow([(("prose", "en", "a"), f(50), f(10)), (("prose", "de", "a"), f(30), f(35)), (("talk", "en", "c"), f(20), f(200))])
    mixing.allot(root, f(100))
    assert [leaf.budget for leaf in mixing.leaves_of(root)] == [10, 35, 55]


def test_nothing_is_repeated_too_often(spark, data):
    rows = mixing.p8_mix(spark, data).collect()
    report = {r.source: r for r in mixing.p8_report(spark, data).collect()}
    most = {}
    for r in rows:
        most[r.source] = max(most.get(r.source, 0), r.epoch)
    assert all(m <= report[s].max_repeats for s, m in most.items())
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    assert all(r.drawn <= r.budget for r in report.values())
    short = {r.source for r in mixing.p8_found(spark, data).collect()}
    assert short == {s for s, r in report.items() if r.short} and "field_diaries" in short
