"""Problems 1 and 6: the trained models."""

import itertools
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quern.functions import language
from quern.llm import codepoints as cp
from quern.llm import pairs, toxic

EN = ["The old mill by the river was painted on Monday and the baker said it would last.", "Expect rain in the valley and a cold wind from the north by the evening.", "A quiet fog is like a clerk from town: it came at dawn and counted the bridges."]
DE = ["Der Bäcker sagte, dass die Mühle am Montag gestrichen war, und die Nachbarin war nicht da.", "Das Gewitter kam in der Nacht und der Lehrer hat den Wagen aus dem Garten geholt."]


@pytest.fixture(scope="module")
def field(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return pairs._pairs(spark, folder)[1]


def defects(field, cases):
    return field.tagged(pairs.cp_forms([q for q, _ in cases]), pairs.cp_forms([a for _, a in cases]))[0]


Q = "Will it rain in Aford tomorrow, and how cold will it be on the hill?"


def test_defects(field):
    cases = [
        (Q, EN[0] + " " + EN[1], None),
        (Q, None, "empty"), (Q, "", "empty"), (Q, "  \n", "empty"), (Q, "...", "empty"), (Q, "N/A", "empty"), (Q, "[no answer]", "empty"), (Q, "—", "empty"), (Q, ". " * 500, "empty"),
        (Q, Q, "copy"), (Q, Q.upper(), "copy"), (Q, f'"{Q}"', "copy"),
        (Q, "I'm sorry, but I cannot help with that request.", "refusal"), (Q, "Unfortunately, I would rather not go into that. Please ask me something else.", "refusal"),
        (Q, DE[0] + " " + DE[1], "language"),
        (Q + " Please answer in German.", DE[0] + " " + DE[1], None),
        (Q, EN[0] + " Expect rain in the", "truncated"), (Q, EN[0] + " The old mill by the river was painted on", "truncated"),
        (Q, "I apologise for the delay. " + EN[0] + " " + EN[1], None), (Q, "I'm sorry, but the tool returned an error: place not found. " + EN[0], None),
        (Q, EN[0] + "\n- wind: 12 km/h\n- rain: 3 mm", None),
    ]
    assert [(c[1], g) for c, g in zip(cases, defects(field, [c[:2] for c in cases]))] == [(c[1], c[2]) for c in cases]


def test_answers_in_languages_that_the_model_does_not_know(field):
    answers = [
        "Amanhã vai chover em Lisboa durante a tarde, e o vento será forte perto da costa. À noite a temperatura desce bastante.",
        "Il tempo domani sarà nuvoloso con piogge sparse nel pomeriggio, soprattutto al nord. La sera farà piuttosto freddo.",
        "Morgen wordt het bewolkt met kans op regen, en de wind draait naar het noordwesten. Tegen de avond wordt het erg koud.",
        "Завтра в городе ожидается дождь и сильный ветер. К вечеру станет холодно.",
    ]
    assert defects(field, [(Q, a) for a in answers]) == ["language"] * 4
    assert defects(field, [(Q + " Please reply in Portuguese.", answers[0])]) == [None]
    assert defects(field, [("¿Va a llover mañana por la tarde cerca de la costa, y hará mucho frío por la noche?", answers[2])]) == ["language"]


def test_a_refusal_at_the_end_of_a_long_clause(field):
    polite = "Thank you so much for your kind and thoughtful question about the weather near the river and the hills around the old mill by the road to the market which I have read with great care and interest over and over this fine morning while the wind was blowing"
    for late in ("but I must decline to answer.", "but this is a matter on which I cannot comment."):
        assert len((polite + " " + late).split()) > 45
        assert defects(field, [(Q, f"{polite} {late}")]) == ["refusal"], late
    assert defects(field, [(Q, "This is a matter on which I must decline to answer.")]) == ["refusal"]


def test_all_words_of_a_long_clause_are_features():
    none = pairs.Field()
    many = " ".join(f"word{k}" for k in range(300))
    b = pairs.featurize(["What is the weather?"], [many], none.ends, none.model)
    assert b.sizes.tolist() == [300] and b.lexical.sum() == 300 + 299


def test_clauses():
    c = pairs.clauses_of(["One two. Three four?\" Five\nSix. ", None, "", "A.B. c", "…  \n\n", "x" * 50_000])
    assert [(p, t[:20], k) for p, t, k in zip(c.pair.tolist(), c.texts(), c.kind.tolist())] == [
        (0, "One two.", 4), (0, 'Three four?"', 4), (0, "Five", 1), (0, "Six.", 4), (3, "A.B.", 4), (3, "c", 1), (4, "...", 7), (5, "x" * 20, 1),
    ]
    assert c.last.tolist() == [False, False, False, True, False, True, True, True]


def test_sequences_decoded_at_once_are_those_decoded_alone():
    rng = np.random.default_rng(5)
    field = pairs.Field(moves=rng.normal(size=(5, 5)))
    length = np.array([3, 0, 1, 7, 2, 7])
    begin = np.r_[0, np.cumsum(length)[:-1]]
    s = rng.normal(size=(length.sum(), 5))
    got = field.decode(s, begin, length)
    for b, n in zip(begin, length):
        best = max(itertools.product(range(5), repeat=int(n)), key=lambda t: sum(s[b + k, x] for k, x in enumerate(t)) + sum(field.moves[x, y] for x, y in zip(t, t[1:])))
        assert n == 0 or got[b : b + n].tolist() == list(best)


def test_an_untrained_field_and_odd_texts():
    field = pairs.train([], language.Languages([], np.zeros((0, language.BUCKETS))))
    odd = ["x", "🌧", "a" * 50_000, "\n\n.", "? ! .", "", None]
    found, _, tags = field.tagged([""] * 7, odd)
    assert found[1] == found[3] == found[4] == found[5] == found[6] == "empty" and len(field.tagged([], [])[0]) == 0
    assert defects(field, []) == []


def test_pair_rows(spark):
    schema = "entry_id long, messages array<struct<role: string, content: string, tool_calls: array<struct<id: string, type: string, function: struct<name: string, arguments: string>>>, tool_call_id: string>>, extra int"
    m = lambda role, content, calls=None: (role, content, calls, None)
    call = [("c", "function", ("f", "{}"))]
    rows = spark.createDataFrame(
        [
            (1, [m("system", "s"), m("user", "q1"), m("assistant", None, call), m("tool", "{}"), m("assistant", "a1"), m("user", "q2"), m("assistant", "a2", [])], 0),
            (2, None, 0), (3, [], 0), (4, [m("assistant", "before")], 0), (5, [m("user", None), m("assistant", None)], 0), (6, [m("user", "q")], 0), (7, [m(None, "x"), None, m("assistant", "y")], 0),
        ], schema,
    )
    got = sorted((r.entry_id, r.msg_index, r.question, r.answer) for r in pairs.pair_rows(rows).collect() if r.entry_id == 1)
    assert got == [(1, 4, "q1", "a1"), (1, 6, "q2", "a2")]
    assert {r.entry_id for r in pairs.pair_rows(rows).collect()} == {1, 5}


def test_disguises():
    plain = toxic.tokens("you stupid cow")
    for t in ("you s.t.u.p.i.d cow", "you s t u p i d cow", "you stup1d c0w", "you stupiiiid cow"):
        assert toxic.tokens(t) == plain, t


def labelled(n, seed):
    rng = random.Random(seed)
    clean = [s + " Nothing else happened." for s in EN + DE]
    bad = ["You are a stupid cow, {}, shut up.", "I will break your bones, {}.", "All of the {}s are vermin.", "Shut your mouth, you idiot {}."]
    out = []
    for _ in range(n):
        s = rng.sample(clean, 2)
        y = rng.random() < 0.4
        if y:
            s.insert(rng.randrange(3), rng.choice(bad).format(rng.choice(["Aron", "Bela", "Cilla", "Dorn"])))
        out.append((" ".join(s), float(y != (rng.random() < 0.03))))
    return out


def test_held_out_accuracy():
    net = toxic.train(labelled(500, 1), [t for t, _ in labelled(200, 2)], epochs=4)
    test = labelled(300, 3)
    scores = net.scores([toxic.token_ids(toxic.tokens(t)) for t, _ in test])
    truth = np.array([any(b in t for b in ("stupid cow", "break your bones", "vermin", "idiot")) for t, _ in test])
    assert ((scores > net.thresholds[""]) == truth).mean() > 0.95


def test_scores_do_not_depend_on_the_batch():
    net = toxic.Network.new(1)
    docs = [toxic.token_ids(toxic.tokens(t)) for t, _ in labelled(20, 4)] + [toxic.token_ids([]), toxic.token_ids(["one"])]
    alone = np.array([net.scores([d])[0] for d in docs])
    assert np.allclose(alone, net.scores(docs), atol=1e-5) and np.allclose(alone, net.scores(docs, bound=30), atol=1e-5)
    assert alone[-2] == 0


def test_words_remembered_are_words_worked_out():
    t = toxic.Tokenizer(most=5)
    forms = [x for x, _ in labelled(20, 5)] + ["you s.t.u.p.i.d c0w!!", "", "STUPIIID * 12 a*b"]
    for _ in range(2):
        assert [i.tolist() for i in t.ids(forms)] == [toxic.token_ids(toxic.tokens(f)).tolist() for f in forms]
    assert t.ids([]) == []


def test_a_saved_network_scores_the_same(spark, tmp_path):
    model = language.Languages(["de", "en"], np.random.default_rng(1).integers(0, 9, (2, language.BUCKETS)))
    net = toxic.train(labelled(200, 6), [], model, epochs=2)
    net.save(spark, str(tmp_path / "net"))
    same = toxic.Network.load(spark, str(tmp_path / "net"))
    docs = toxic.Tokenizer().ids([t for t, _ in labelled(30, 7)])
    assert np.array_equal(net.scores(docs), same.scores(docs)) and same.thresholds == net.thresholds
    assert same.model.best(EN + DE) == model.best(EN + DE)


def test_a_network_is_trained_once_for_the_same_rows(spark):
    items = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(labelled(120, 8))], "id long, content string")
    marks = spark.createDataFrame([(k, int(y)) for k, (_, y) in enumerate(labelled(120, 8))], "item_id long, toxic int")
    one = toxic.learned(items, marks)
    assert toxic.learned(items, marks) is one and toxic.learned(items, marks.where("item_id < 100")) is not one


def test_no_labels():
    assert toxic.train([], ["x"]) is None and toxic.train([("a b c", 1.0)], []) is None


def test_end_shares_are_counted_over_all_answers(spark):
    rng = random.Random(3)
    answers = [" ".join(rng.choice(EN + DE).replace("river", f"river{k % 9}") for _ in range(2)) for k in range(60)] + [None, "", "Here it ends at dusk.", "Again it ends at dusk.", "The dusk is long and it ends at dusk", "Dusk.", "🌧"]
    rows = spark.createDataFrame([(k, 0, f"q{k}", a) for k, a in enumerate(answers)], "entry_id long, msg_index int, question string, answer string").repartition(5)
    want = pairs.shares_of(*pairs.count_ends(answers))
    got = pairs.end_shares(rows)
    assert (got == want).all()
    words = cp.word_spans(*cp.explode(["at dusk"]))[0]
    cell = lambda h: int(h % np.uint64(pairs.CELLS))
    assert got[cell(words[1])] == pytest.approx(3 / 5) and got[cell(pairs._pair_hash(words[:1], words[1:])[0])] == pytest.approx(2 / 3)


def test_a_language_model_is_counted_over_all_rows(spark):
    rng = random.Random(7)
    words = {"en": "the rain was cold and they would think that".split(), "de": "der regen war nicht und die schule ist zwischen".split()}
    said = [(lang, " ".join(rng.sample(words[lang], 6))) for lang in rng.choices(["en", "de"], k=9000)]
    plain = [" ".join(rng.sample(words[lang], 6)) for lang in rng.choices(["en", "de"], k=8000)]
    docs = spark.createDataFrame([(t, f" {lang.upper()}") for lang, t in said], "text string, lang string").repartition(5)
    other = spark.createDataFrame([(t,) for t in [*plain, None, "", "!"]], "text string").repartition(3)

    def counted(texts, own):
        grams, row = language.trigrams(texts)
        return np.stack([np.bincount(grams[own[row] == k], minlength=language.BUCKETS) for k in range(2)])

    texts, own = [t for _, t in said], np.array([int(lang == "en") for lang, _ in said])
    first = language.Languages(["de", "en"], counted(texts, own))
    taken = lambda ts: first.likeliest(*first.sums(*language.trigrams(ts), len(ts)))
    both = texts + plain
    want = language.Languages(["de", "en"], counted(both, np.r_[np.where(taken(texts) == own, own, -1), taken(plain)]))
    got = language.learned(docs, other=other)
    assert got.names == want.names and np.array_equal(got.logp, want.logp)


def test_parts_of_batches(monkeypatch):
    monkeypatch.setattr(language, "PART", 1 << 20)
    texts = ["a" * 400_000, None, "ö" * 700_000, "", "b" * 3_000_000, "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    assert [p.column("text").to_pylist() for p in language._parts([batch, batch.slice(0, 0)])] == [texts[:2], texts[2:4], texts[4:5], texts[5:]]


@pytest.fixture(scope="module")
def talk(spark):
    """3,600 pairs, each with a word that no other has, the last of them of more than 20,000 characters; and labelled texts."""
    rng = random.Random(11)
    rows = [(k, 0, Q, f"{rng.choice(EN)} The clerk from zq{k}vy said so in the evening.") for k in range(3600)]
    rows[-1] = (*rows[-1][:3], " ".join(EN * 90) + " " + rows[-1][3])
    docs = [(t, lang) for lang, ts in (("en", [Q, *[a for *_, a in rows[:20]]]), ("de", DE)) for t in ts for _ in range(9)]
    return spark.createDataFrame(rows, "entry_id long, msg_index int, question string, answer string").repartition(4), spark.createDataFrame(docs, "text string, lang string"), rows


def test_a_field_is_trained_on_all_pairs(talk, monkeypatch):
    monkeypatch.setattr(pairs, "SHARD", 8000, raising=False)
    rows, docs, said = talk
    field = pairs.learned(rows, docs)
    word = lambda k: int(cp.mix(cp.word_spans(*cp.explode([f"zq{k}vy"]))[0] ^ np.uint64(0xA5A5))[0] >> np.uint64(40)) % pairs.DIM
    learned = [bool(field.w[word(r[0])].any()) for r in said]
    assert np.mean(learned) > 0.97 and learned[-1]


def test_a_field_is_the_mean_of_those_of_the_shards(spark, talk, monkeypatch):
    monkeypatch.setattr(pairs, "SHARD", 150)
    rows, docs, _ = talk
    rows = rows.where("entry_id < 400")
    model, ends = language.learned(docs), pairs.end_shares(rows)
    got = pairs.fitted(rows, model, ends)
    keys = ["entry_id", "msg_index", "question", "answer"]
    parts = rows.selectExpr(f"pmod(xxhash64({', '.join(keys)}), 3) AS s", "xxhash64(entry_id, msg_index) AS h", *keys).orderBy("s", "h").collect()
    alone = []
    for s in range(3):
        mine = pairs.cp_forms([r.question for r in parts if r.s == s]), pairs.cp_forms([r.answer for r in parts if r.s == s])
        assert 100 < len(mine[0]) < 170
        alone.append(pairs.train(list(zip(*mine)), model, ends, seed=6 + 7919 * s, epochs=1))
    seen = np.sum([f.seen for f in alone], 0)
    assert np.allclose(got.w, np.sum([f.w for f in alone], 0) / np.maximum(seen, 1)[:, None], atol=1e-5)
    assert np.allclose(got.moves, np.mean([f.moves for f in alone], 0), atol=1e-5)
    again = pairs.fitted(rows.repartition(7), model, ends)
    assert np.array_equal(got.w, again.w) and np.array_equal(got.moves, again.moves)


def test_sentences_have_the_trigrams_they_have_on_their_own():
    rng = random.Random(4)
    texts = ["", None, "...", ".a b", "A. b\nC! d?  e.", "hi. 42! bye", "ΑΒΣ. ΑΣ", "İstanbul. I am!", "\n\n. a\n", *["".join(rng.choice("ab .!?\n éΣ1,") for _ in range(60)) for _ in range(300)], *EN, *DE]
    grams, row, sentence, text = language.sentence_trigrams(texts)
    whole = language.trigrams(texts)
    assert np.array_equal(grams, whole[0]) and np.array_equal(row, whole[1])
    got = [(text[k], grams[sentence == k].tolist()) for k in range(len(text))]
    want = [(k, language.trigrams([x])[0].tolist()) for k, t in enumerate(texts) for x in re.split(r"(?<=[.!?])\s+", t or "")]
    assert [g for g in got if g[1]] == [w for w in want if w[1]]


def test_clauses_do_not_depend_on_the_answers_beside_them():
    texts = ["It rained.", "\" and so", ".", "\" Five six.", "One.\n.", ") x. y", "…"]
    alone = [pairs.clauses_of([t]) for t in texts]
    both = pairs.clauses_of(texts)
    assert both.texts() == [x for c in alone for x in c.texts()] and both.kind.tolist() == [k for c in alone for k in c.kind.tolist()]
    assert both.texts()[:3] == ["It rained.", "\" and so", "."] and both.kind[2] == 4


def test_features_of_pairs_together_are_those_of_each_alone(field):
    rng = random.Random(8)
    said = [*EN, *DE, Q, "", None, ".", "I cannot help with that.", "Es regnet\n- Wind: 3 km/h", EN[0] + " and then the", "\" Rain :)"]
    asked = [Q, Q.upper(), "", Q + " Please answer in German.", DE[0], EN[1] + " " + Q, "🌧"]
    cases = [(rng.choice(asked), rng.choice(said)) for _ in range(300)]
    held = pairs.Asked([q for q, _ in cases] + ["Another question?"], field.model)
    got = pairs.featurize(*map(list, zip(*cases)), field.ends, field.model, held)
    first = np.searchsorted(got.clauses.pair, np.arange(len(cases) + 1))
    order = np.argsort(got.at, kind="stable")
    edge = np.searchsorted(got.at[order], np.arange(first[-1] + 1))
    for k, (q, a) in enumerate(cases):
        one = pairs.featurize([q], [a], field.ends, field.model)
        assert got.feature[order][edge[first[k]] : edge[first[k + 1]]].tolist() == one.feature[np.argsort(one.at, kind="stable")].tolist(), (q, a)


def test_work_on_a_text_is_done_once(field, monkeypatch):
    cut, formed, cut_of, form_of = [], [], pairs.clauses_of, cp.one_form_texts
    monkeypatch.setattr(pairs, "clauses_of", lambda texts: cut.extend(texts) or cut_of(texts))
    monkeypatch.setattr(cp, "one_form_texts", lambda texts: formed.append(len(texts)) or form_of(texts))
    made = [(q, a, 0) for q in (Q, DE[0], EN[1]) for a in EN]
    assert len(pairs.prepared(made, field.ends, field.model).length) == 9 and sorted(cut) == sorted(EN)
    assert pairs.cp_forms(["é\n  ü", None, "a  b", "ö  x\ny"]) == ["é\nü", None, "a  b", "ö x\ny"] and formed == [4]


def test_hashes_are_found_by_their_first_bits():
    rng = np.random.default_rng(2)
    keys = np.unique(np.r_[rng.integers(0, 1 << 63, 3000, np.uint64), rng.integers(0, 1 << 20, 500, np.uint64)])  # the last share all their first bits
    rng.shuffle(keys)
    asked = np.r_[keys, keys + np.uint64(1), np.uint64(0)]
    place, found = pairs.Index(keys).find(asked)
    assert found.tolist() == np.isin(asked, keys).tolist() and np.array_equal(keys[place[found]], asked[found])
    assert not pairs.Index(keys[:0]).find(asked)[1].any()
