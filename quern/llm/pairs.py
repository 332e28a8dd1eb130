"""Problem 6: defective prompt and response pairs.

An answer is cut into clauses, and a linear-chain conditional random field
tags each as answer, refusal, echo (of the question), foreign (another
language than the question's) or unfinished.  The words covered by each tag
decide the pair's defect; only 'empty' needs no tagging.

All of a batch's pairs are worked on at once, in numpy columns: code points,
words, clauses, hashed features, and the tags of all sequences step by step.
Every word of a clause, and every pair of words, is a feature, however long
the clause is.

Whether a clause is in the question's language is told by letter trigrams
(``quern.functions.language``), learned from the labelled texts of another
table; a clause in a language the model does not know is foreign to a question
in one that it does.

The field is trained here: every pair that looks sound gives a clean sequence,
and each of them is also spoilt on purpose: broken off, replaced by the
question in several guises, by a declining sentence, or by an answer in another
language.  Sound answers that begin with an apology or a caveat are among the
clean ones.  How often a word ends a clause is counted over all answers.  Pairs
are dealt by hash into shards, a field is trained on each of them in the
workers, and the weights are averaged: of a feature over the shards that have
it.

Defined results: null messages, messages without role and assistant messages
before any user message give no pair; a null question is an empty one, which
nothing can echo and which has no language; a null answer is 'empty'.
"""

from __future__ import annotations

import functools
import itertools
import random
import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import language
from quern.functions.language import FOREIGN, LEAST, Languages
from quern.llm import codepoints as cp
from quern.session import spread, table

LABELS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN_TAG, UNFINISHED = range(5)
DIM = 1 << 16
PLAIN = 30  # characters of a question from which its language is plain
DENSE = 3  # how many times as much a feature that is not of words counts
LEAST_SEEN = 3  # of a word or pair of words, for a share of how often it ends a clause
CELLS = 1 << 20  # of the table of these shares, by hash
SHARD = 24_000  # pairs of a shard, about; with fewer each is gone over more often, up to EPOCHS times
SHARD_TEXT = 10_000_000  # characters of a shard, about
EPOCHS = 8
CHUNK, CHUNK_TEXT = 3000, 2_000_000  # pairs and characters made into examples at once
FINE = 1 << 20  # parts of a unit in which weights are added up, as integers, so that no order matters

# The names of languages in requests.
LANGUAGE_NAMES = {
    "en": ("english", "englisch", "anglais", "inglés", "ingles"),
    "de": ("german", "deutsch", "allemand", "alemán", "aleman"),
    "fr": ("french", "französisch", "français", "francais", "francés", "frances"),
    "es": ("spanish", "spanisch", "espagnol", "español", "espanol", "castellano"),
    "it": ("italian", "italienisch", "italien", "italiano"),
    "pt": ("portuguese", "portugiesisch", "portugais", "portugués", "português"),
    "nl": ("dutch", "niederländisch", "néerlandais", "holandés", "neerlandés"),
    "ru": ("russian", "russisch", "russe", "ruso"),
    "pl": ("polish", "polnisch", "polonais", "polaco"),
    "ja": ("japanese", "japanisch", "japonais", "japonés"),
    "zh": ("chinese", "chinesisch", "chinois", "chino", "mandarin"),
    "ar": ("arabic", "arabisch", "arabe", "árabe"),
}
_NAMES = {n: lang for lang, names in LANGUAGE_NAMES.items() for n in names}
_NAMED = re.compile(r"\b(" + "|".join(sorted(_NAMES, key=len, reverse=True)) + r")\b")
_ASKING = re.compile(r"\b(answer|reply|respond|write|say|tell|translate|translated|in|auf|en|antworte\w*|antwort|schreib\w*|répond\w*|réponse|écri\w*|respond\w*|contest\w*|respuesta|escrib\w*)\b")
# Answers that only hold a place.
PLACEHOLDERS = {
    "", "null", "none", "nil", "nan", "na", "n a", "tbd", "todo", "tba", "no answer", "no response", "no reply", "empty", "blank", "answer", "response", "placeholder", "pending", "undefined",
    "keine antwort", "sans réponse", "pas de réponse", "sin respuesta", "missing", "not available", "deleted", "removed", "insert answer here", "answer here", "your answer here", "xxx",
}

# Material for the spoilt examples: parts of ways to decline, put together at random.
DECLINE_OPEN = {
    "en": ["I'm sorry, but", "I am sorry, but", "Sorry,", "Unfortunately,", "I apologise, but", "I apologize, however", "As an AI,", "As a language model,", "With regret,", "Thank you for asking, but", "To be honest,", "Regrettably,", "Thanks, but", "I must be frank:", "This is a matter on which", ""],
    "de": ["Es tut mir leid, aber", "Leider", "Bedaure,", "Entschuldigung,", "Als Sprachmodell", ""],
    "fr": ["Désolé,", "Je suis désolé, mais", "Malheureusement,", "Navré,", "En tant que modèle de langage,", "Je regrette, mais", ""],
    "es": ["Lo siento, pero", "Lamentablemente,", "Por desgracia,", "Perdón,", "Como modelo de lenguaje,", "Disculpe,", ""],
}
#: who cannot or will not, and what: each of the first before each of the second.
DECLINE = {
    "en": (
        ["I cannot", "I can't", "I can not", "I am unable to", "I'm unable to", "I'm not able to", "I am not able to", "I won't be able to", "I will not", "I won't", "I would rather not", "I'd rather not", "I prefer not to", "I have to decline to", "I must decline to", "I decline to", "I refuse to", "I am not allowed to", "I am not permitted to", "I am not comfortable if I", "my guidelines do not let me", "my rules don't allow me to", "I do not have the ability to", "it is not possible for me to", "this is not something I can", "that is not something I can"],
        ["help with that", "help with this request", "help you", "assist with that request", "assist you with this", "answer", "answer this question", "answer that", "respond to this", "respond to this question", "provide that information", "provide this kind of information", "discuss it", "discuss that", "talk about this", "fulfil this request", "do that", "comment on this", "go into it", "say anything about that"],
    ),
    "de": (
        ["ich kann leider nicht", "ich kann nicht", "ich darf nicht", "ich möchte nicht", "ich werde nicht", "ich bin nicht in der Lage", "ich muss es ablehnen", "es ist mir nicht möglich", "meine Richtlinien erlauben mir nicht"],
        ["dabei zu helfen", "dabei helfen", "diese Frage zu beantworten", "diese Frage beantworten", "darauf zu antworten", "darauf antworten", "dazu etwas sagen", "diese Anfrage bearbeiten", "Auskunft zu geben"],
    ),
    "fr": (
        ["je ne peux pas", "je ne suis pas en mesure de", "je dois refuser de", "je préfère ne pas", "je refuse de", "je ne suis pas autorisé à", "il m'est impossible de", "mes règles ne me permettent pas de"],
        ["répondre", "répondre à cette demande", "répondre à cette question", "vous aider", "traiter cette demande", "donner cette information", "en parler"],
    ),
    "es": (
        ["no puedo", "no me es posible", "prefiero no", "debo negarme a", "no estoy en condiciones de", "no se me permite", "no soy capaz de", "me niego a", "mis normas no me permiten"],
        ["ayudar con eso", "ayudarle", "responder", "responder a esa pregunta", "contestar", "atender esta petición", "dar esa información", "hablar de eso", "ayudar con esa petición"],
    ),
}
#: ways to decline that are a sentence of their own.
DECLINE_WHOLE = {
    "en": ["I have to decline", "I must decline", "that is beyond what I may do", "this is not something I can help with"],
    "de": ["ich muss das ablehnen", "muss ich die Antwort ablehnen", "das darf ich nicht beantworten", "dazu kann ich nichts sagen", "kann ich dabei leider nicht helfen", "darf ich diese Frage nicht beantworten"],
    "fr": ["je dois refuser", "je ne peux rien dire à ce sujet"],
    "es": ["tengo que rechazar la petición", "debo rechazarlo"],
}
DECLINE_CLOSE = {
    "en": ["", "", "Please ask me something else.", "Is there anything else I can do for you?", "Perhaps someone else can help you.", "I hope you understand.", "Maybe try another question.", "Can I help with something different?"],
    "de": ["", "Fragen Sie bitte etwas anderes.", "Kann ich sonst etwas tun?", "Bitte haben Sie Verständnis."],
    "fr": ["", "Posez-moi une autre question.", "Puis-je faire autre chose pour vous ?", "Merci de votre compréhension."],
    "es": ["", "Pregúnteme otra cosa, por favor.", "¿Puedo ayudar en algo más?", "Espero que lo entienda."],
}
# Sound beginnings: apologies, caveats and reports of a tool's error before a real answer.
CAVEATS = {
    "en": ["I'm sorry, but the tool returned an error: place not found.", "I apologise for the delay.", "I apologise for the length of this.", "Sorry for the wait.", "I can't promise sunshine, but here is what I know.", "I am unable to stop the rain, yet I can describe it.", "I cannot change the wind, but I can tell you about it.", "Unfortunately the lookup failed: number out of range.", "Unfortunately the tool could not answer: days out of range.", "Sorry to say, the news is not good.", "Unfortunately for your plans, it will be wet.", "I am no expert, but this is what I found.", "I am afraid the weather is bad.", "The request failed: location not found.", "I apologise, the lookup failed: not found."],
    "de": ["Es tut mir leid, aber das Werkzeug meldete einen Fehler.", "Leider wird es nass.", "Ich kann keine Sonne versprechen, aber das weiß ich."],
    "fr": ["Désolé, l'outil a signalé une erreur.", "Malheureusement, il va pleuvoir.", "Je ne peux pas promettre le soleil, mais voici ce que je sais."],
    "es": ["Lo siento, la herramienta dio un error.", "Por desgracia, va a llover.", "No puedo prometer sol, pero esto es lo que sé."],
}

_LINE = re.compile(r"^\s*(?:[-*•]+\s*)?[^\W\d_][^:]{0,30}:\s*\S.{0,30}$|^\s*(?:--|—|–|~)\s*\S.{0,40}$|^\s*\|.*\|\s*$|^\s*[-*•]\s+\S.*$")
_WORD = re.compile(r"[^\W_]+")
_SMILE = re.compile(r"[:;]-?[)D(]$|[\U0001F300-\U0001FAFF☀-➿]️?$")


def _marks(chars: str) -> np.ndarray:
    return np.array([ord(c) for c in chars], np.uint32)


ENDS, CLOSERS, COMMAS, POINTS = _marks(".!?…。"), _marks("\"”»')]"), _marks(",;"), _marks(".,;!?")
IS_END, IS_CLOSER, IS_COMMA, IS_POINT = np.uint8(1), np.uint8(2), np.uint8(4), np.uint8(8)


@functools.cache
def _mark_bits() -> np.ndarray:
    """What marks each code point is among, as bits."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for bit, marks in ((IS_END, ENDS), (IS_CLOSER, CLOSERS), (IS_COMMA, COMMAS), (IS_POINT, POINTS)):
        out[marks] |= bit
    return out


@functools.lru_cache(maxsize=4096)
def requested(question: str) -> frozenset[str]:
    """The languages a question asks to be answered in."""
    low = question.lower()
    return frozenset(_NAMES[n] for n in _NAMED.findall(low)) if _NAMED.search(low) and _ASKING.search(low) else frozenset()


def is_placeholder(answer: str) -> bool:
    """Nothing but blanks, marks or a bare placeholder."""
    ws = re.findall(r"[^\W_]+", answer.lower())
    return len(ws) < 4 and " ".join(ws) in PLACEHOLDERS


def _bins(x: np.ndarray, *edges: float) -> np.ndarray:
    return np.searchsorted(np.array(edges), x, "right").astype(np.uint64)


def _feature(kind: int, *values: np.ndarray | int) -> np.ndarray:
    """Hashed numbers of a kind of features, of small values."""
    h = np.uint64(kind)
    for v in values:
        h = h * np.uint64(64) + np.asarray(v).astype(np.uint64) + np.uint64(1)
    return (cp.mix(np.atleast_1d(h)) >> np.uint64(48)).astype(np.int64) % DIM


def _word_feature(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Hashed numbers of words, or of pairs of words."""
    return (cp.mix(hashes ^ np.uint64(kind)) >> np.uint64(40)).astype(np.int64) % DIM


@dataclass
class Clauses:
    """The clauses of a batch of answers: of each its pair, where it begins and ends in the code points, its words and kind of end; and the words with their clauses."""

    codes: np.ndarray
    pair: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    kind: np.ndarray  # how it ends: 0 open, 1 word, 2 comma, 3 quote, 4 stop, 7 dots
    last: np.ndarray  # whether it is its answer's last
    words: np.ndarray
    own: np.ndarray  # the clause of each word

    def text(self, k: int) -> str:
        return self.codes[self.begin[k] : self.end[k]].astype(np.uint32).tobytes().decode("utf-32-le").strip()

    def texts(self) -> list[str]:
        whole = self.codes.astype(np.uint32).tobytes().decode("utf-32-le")
        return [whole[a:b].strip() for a, b in zip(self.begin.tolist(), self.end.tolist())]


def clauses_of(answers: list[str | None]) -> Clauses:
    """Answers in one form cut into clauses: at line breaks, and at blanks after a sentence's end."""
    lines, owner = [], []
    for k, a in enumerate(answers):
        for line in (a or "").split("\n"):
            lines.append(line)
            owner.append(k)
    codes, offsets = cp.one_form(*cp.explode(lines))
    # a clause begins with a line, and after a blank that follows a sentence's end with up to two closing marks
    mark = _mark_bits().take(codes)
    ended, closer = (mark & IS_END) > 0, (mark & IS_CLOSER) > 0
    before = np.zeros(len(codes), bool)
    closer[offsets[:-1][np.diff(offsets) > 0]] = False  # what begins a line closes nothing
    for _ in range(2):
        ended[1:] |= closer[1:] & ended[:-1]
    if len(codes) > 2:
        before[2:] = (codes[1:-1] == 32) & ended[:-2]
    edge = np.zeros(len(codes) + 1, bool)
    edge[offsets] = True
    line_begins = np.zeros(len(codes), bool)
    full = np.diff(offsets) > 0
    line_begins[offsets[:-1][full]] = True
    before[np.minimum(np.flatnonzero(line_begins) + 1, max(len(codes) - 1, 0))] &= len(codes) > 0
    begin = np.flatnonzero(line_begins | (before & ~line_begins))
    line = np.searchsorted(offsets, begin, "right") - 1
    pair = np.array(owner, np.int64)[line] if len(begin) else np.zeros(0, np.int64)
    end = np.r_[begin[1:], len(codes)][: len(begin)].astype(np.int64)
    end = np.where((end > begin + 1) & (codes[np.maximum(end - 1, 0)] == 32), end - 1, end) if len(begin) else end
    # the kind of end, behind closing marks
    at = end - 1
    bare = at.copy()
    for _ in range(3):
        bare = np.where((bare > begin) & (((mark[bare] & IS_CLOSER) > 0) | (codes[bare] == 32) | (codes[bare] == 42)), bare - 1, bare) if len(begin) else bare
    kind = np.zeros(len(begin), np.int64)
    if len(begin):
        final = codes[at]
        kind[cp.tables().alnum[final]] = 1
        kind[(mark[at] & IS_COMMA) > 0] = 2
        kind[(mark[at] & IS_CLOSER) > 0] = 3
        kind[(mark[bare] & IS_END) > 0] = 4
        kind[(codes[bare] == ord("…")) | (codes[bare] == ord(".")) & (bare > begin) & (codes[np.maximum(bare - 1, 0)] == ord("."))] = 7
    words, w_begin, _ = cp.word_spans(codes, offsets)
    own = np.searchsorted(begin, w_begin, "right") - 1
    last = np.r_[pair[1:] != pair[:-1], True][: len(pair)]
    return Clauses(codes, pair, begin, end, kind, last, words, own)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return cp.mix(a * np.uint64(0x9E3779B97F4A7C15) ^ cp.mix(b))


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each beginning on, so many each."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - begin, size)


def _shares(flags: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The share of flags set in each group of so many that follow each other; 0 of none."""
    upto = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=upto[1:])
    end = np.cumsum(size)
    return (upto[end] - upto[end - size]) / np.maximum(size, 1)


class Index:
    """Where values stand among distinct 64-bit hashes: by their first bits, and where several hashes share these, by search."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(8, (len(keys) * 4).bit_length())
        self.keys, self.shift = keys, np.uint64(64 - bits)
        slot, at = (keys >> self.shift).astype(np.int64), np.arange(len(keys), dtype=np.int32)
        self.table, self.crowded = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, bool)
        self.table[slot] = at
        lost = np.flatnonzero(self.table[slot] != at)
        self.crowded[slot[lost]] = True
        self.lost = lost[np.argsort(keys[lost])]

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each value, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(values), np.int32), np.zeros(len(values), bool)
        slot = (values >> self.shift).astype(np.int64)
        at = self.table.take(slot)
        found = self.keys.take(at) == values
        if len(self.lost):
            more = np.flatnonzero(~found & self.crowded.take(slot))
            keys = self.keys[self.lost]
            near = np.minimum(np.searchsorted(keys, values[more]), len(keys) - 1)
            at[more], found[more] = self.lost[near], keys[near] == values[more]
        return at, found


class Asked:
    """What is to be known of questions in one form: by ``number``, their words and pairs of words, and the languages they are in and ask for."""

    def __init__(self, questions: Iterable[str], model: Languages) -> None:
        texts = list(dict.fromkeys(questions))
        self.number = {q: k for k, q in enumerate(texts)}
        n = len(texts)
        self.seed = cp.mix(np.arange(n).astype(np.uint64) + np.uint64(77))
        keys, owners, twos, sums, grams = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros((0, len(model.names)))], [np.zeros(0, np.int64)]
        for a, b in cp.slices(texts, 1 << 18):
            codes, offsets = cp.one_form(*cp.explode(texts[a:b]))
            words, begin, _ = cp.word_spans(codes, offsets)
            own = np.searchsorted(offsets, begin, "right") - 1 + a
            key, first = np.unique(self.name(words, own), return_index=True)
            keys.append(key)
            owners.append(own[first])
            next_ = np.flatnonzero(own[1:] == own[:-1])
            twos.append(np.unique(self.name(_pair_hash(words[next_], words[next_ + 1]), own[next_])))
            s, m = model.sums(*language.trigrams_of(cp.tables().lower[codes], np.repeat(np.arange(b - a), np.diff(offsets))), b - a)
            sums.append(s)
            grams.append(m)
        self.words, self.twos = Index(np.concatenate(keys)), Index(np.concatenate(twos))
        own = np.concatenate(owners)
        self.size = np.bincount(own, minlength=n)  # distinct words of each question, and the number of each word among those of its own
        self.rank = np.zeros(len(own), np.int64)
        self.rank[np.argsort(own, kind="stable")] = _ranges(np.zeros(n, np.int64), self.size)
        s, m = np.concatenate(sums), np.concatenate(grams)
        self.lang = np.where(m >= LEAST // 2, model.likeliest(s, m), -1)
        if model.names:
            self.lang = np.where((m >= LEAST) & (model.misfit(s, m).min(1) > FOREIGN), -1, self.lang)
        wishes = [requested(q) if q else frozenset() for q in texts]
        self.wished = np.array([bool(w) for w in wishes], bool)
        self.unknown = np.array([any(x not in model.names for x in w) for w in wishes], bool)
        self.wish = np.zeros((n, len(model.names) + 1), bool)
        for k, w in enumerate(wishes):
            for x in w:
                if x in model.names:
                    self.wish[k, model.names.index(x)] = True

    def name(self, hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
        """A hash for that of a word or pair of words in one question."""
        return cp.mix(hashes ^ self.seed.take(number))


@dataclass
class Batch:
    """Features of all clauses of a batch of pairs: flat, with the clause of each."""

    clauses: Clauses
    feature: np.ndarray
    at: np.ndarray
    lexical: np.ndarray  # whether a feature is of words
    sizes: np.ndarray  # words of each clause
    n_words: np.ndarray  # of each answer


def featurize(questions: list[str], answers: list[str | None], ends: np.ndarray, model: Languages, asked: Asked | None = None) -> Batch:
    """Hashed features of the clauses of answers to questions, both in one form.

    ``ends`` has, by hash of a word or pair of words, how often it ends a
    clause; -1 for those seen too rarely to tell.  ``asked`` may hold the
    questions already, and others.  An answer that comes again is cut and
    looked up once.
    """
    n = len(answers)
    asked = asked or Asked([q or "" for q in questions], model)
    ask = np.array([asked.number[q or ""] for q in questions], np.int64)
    numbers: dict[str, int] = {}
    text = np.array([numbers.setdefault(a or "", len(numbers)) for a in answers], np.int64)
    d = clauses_of(list(numbers))
    of_text = d.pair[d.own] if len(d.own) else d.own
    d_clauses, d_words = np.bincount(d.pair, minlength=len(numbers)), np.bincount(of_text, minlength=len(numbers))
    n_clauses, n_words = d_clauses[text], d_words[text]
    d_first = np.cumsum(d_clauses) - d_clauses
    ci, wi = _ranges(d_first[text], n_clauses), _ranges((np.cumsum(d_words) - d_words)[text], n_words)  # of each clause and word the one of the distinct answers
    m = len(ci)
    own = d.own.take(wi) + np.repeat(np.cumsum(n_clauses) - n_clauses - d_first[text], n_words)
    c = Clauses(d.codes, np.repeat(np.arange(n), n_clauses), d.begin[ci], d.end[ci], d.kind[ci], d.last[ci], d.words.take(wi), own)
    words = c.words
    sizes = np.bincount(own, minlength=m)
    pair = np.repeat(np.arange(n), n_words)

    # what the answer has of the question
    place, known = asked.words.find(asked.name(words, np.repeat(ask, n_words)))
    next_ = pair[1:] == pair[:-1]  # neighbours in an answer, and of them those of one clause
    inner = own[1:] == own[:-1]
    d_two = _pair_hash(d.words[:-1], d.words[1:])
    both = np.flatnonzero(known[1:] & known[:-1] & next_)  # only such can be a pair of words of the question
    two_known = np.zeros(len(next_), bool)
    two_known[both] = asked.twos.find(asked.name(d_two.take(wi[both]), ask[pair[both]]))[1]
    novel = 1 - _shares(known, n_words)
    echoed = _shares(two_known[next_], np.maximum(n_words - 1, 0))
    size = asked.size[ask]
    used = np.zeros(size.sum(), bool)
    hit = np.flatnonzero(known)
    used[(np.cumsum(size) - size)[pair[hit]] + asked.rank[place[hit]]] = True
    covered = _shares(used, size)
    inside = _shares(known, sizes)
    copied = np.where(sizes > 1, _shares(two_known[inner], np.maximum(sizes - 1, 0)), inside)

    # whether a clause is in the question's language, another or one asked for
    began = np.zeros(len(d.codes), bool)
    began[d.begin] = True
    row = np.cumsum(began, dtype=np.int32) - 1  # a blank between clauses follows a mark, so it adds none to the trigrams
    d_s, d_grams = model.sums(*language.trigrams_of(cp.tables().lower.take(d.codes), row), len(d.pair))
    s, grams = d_s[ci], d_grams[ci]

    def relation_of(s: np.ndarray, grams: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """0 not known, 1 the question's language, 2 another, 3 one asked for; and by how much that is sure."""
        spoken = model.likeliest(s, grams)
        theirs = asked.lang[ask[pair]]
        if not model.names:
            return np.zeros(len(pair), np.int64), np.zeros(len(pair))
        off = model.misfit(s, grams)
        strange = (grams >= LEAST) & (off.min(1) > FOREIGN)
        spoken = np.where(strange, len(model.names), spoken)
        ordered = np.sort(s, 1)
        sure = np.where(strange, 9.0, (ordered[:, -1] - ordered[:, -2]) / np.maximum(grams, 1) if len(model.names) > 1 else 9.0)
        relation = np.where((spoken < 0) | (theirs < 0), 0, np.where(spoken == theirs, 1, 2))
        relation = np.where(asked.wished[ask[pair]] & (spoken >= 0) & (asked.wish[ask[pair], np.maximum(spoken, 0)] | (strange & asked.unknown[ask[pair]])), 3, relation)
        return relation, sure

    relation, sure = relation_of(s, grams, c.pair)
    whole = np.stack([np.bincount(d.pair, x, minlength=len(numbers)) for x in d_s.T], 1) if model.names else np.zeros((len(numbers), 0))
    of_all, _ = relation_of(whole[text], np.bincount(d.pair, d_grams, minlength=len(numbers)).astype(np.int64)[text], np.arange(n))
    of_all = of_all[c.pair]
    relation = np.where((relation == 0) & (of_all == 2), 2, relation)  # a clause too short to tell goes with its answer

    # the end of the last clause: how often its word, or its last two, end a clause
    k_last = np.flatnonzero(d.last)
    final = np.full(len(d.pair), -1)
    final[d.own] = np.arange(len(d.own))
    final = final[k_last]
    tail = np.maximum(final, 0)
    before = np.maximum(tail - 1, 0)
    e1, e2 = np.full((2, len(d.pair)), -1.0)
    if len(d.words):
        e1[k_last] = np.where(final >= 0, ends[(d.words[tail] % np.uint64(CELLS)).astype(np.int64)], -1.0)
        has_two = (final >= 1) & (d.own[before] == k_last)
        e2[k_last] = np.where(has_two, ends[(_pair_hash(d.words[before], d.words[tail]) % np.uint64(CELLS)).astype(np.int64)], e1[k_last])
    e1, e2 = e1[ci], e2[ci]
    kind = d.kind.copy()
    for k in np.flatnonzero(d.last & (d.kind != 4) & (d.kind != 7)).tolist():  # only ends that are not plain are looked at one by one
        t = d.text(k)
        kind[k] = 5 if _LINE.match(t) else 6 if _SMILE.search(t[-3:]) else kind[k]
    for k in np.flatnonzero(d.last & (d.kind == 4) & np.isin(d.codes[d.begin], _marks("-*•|"))).tolist():
        kind[k] = 5 if _LINE.match(d.text(k)) else kind[k]
    kind = kind[ci]
    point = (_mark_bits().take(d.codes) & IS_POINT) > 0
    points = np.bincount(d.pair[row[np.flatnonzero(point)]], minlength=len(numbers)) - np.bincount(d.pair[k_last], point[d.end[k_last] - 1], minlength=len(numbers))
    pointed = (points > d_words / 40)[text][c.pair].astype(np.uint64)

    fa, fe, fc = (_bins(novel, 0.02, 0.1, 0.25, 0.5, 0.8)[c.pair], _bins(echoed, 0.1, 0.4, 0.7, 0.9)[c.pair], _bins(covered, 0.3, 0.6, 0.9)[c.pair])
    nb = _bins(sizes, 1, 3, 6, 12, 25)
    first_ = np.r_[True, c.pair[1:] != c.pair[:-1]][:m]
    everyone, at = np.arange(m), []
    features = []

    def put(values: np.ndarray, where: np.ndarray) -> None:
        features.append(values)
        at.append(where)

    put(np.broadcast_to(_feature(1), (m,)), everyone)
    put(_feature(2, nb), everyone)
    put(_feature(3, relation), everyone)
    put(_feature(4, relation, _bins(sure, 0.1, 0.4), _bins(sizes, 3, 6)), everyone)
    put(_feature(14, relation, of_all), everyone)
    put(_feature(5, _bins(copied, 0.1, 0.4, 0.7, 0.95), fe), everyone)
    put(_feature(6, _bins(inside, 0.3, 0.6, 0.9), fa), everyone)
    put(_feature(7, fe, fa, fc), everyone)
    put(np.broadcast_to(_feature(8), (first_.sum(),)), everyone[first_])
    z, y = c.last, ~c.last
    put(_feature(9, kind[z]), everyone[z])
    put(_feature(10, kind[z], pointed[z]), everyone[z])
    put(_feature(11, kind[z], _bins(e1[z], 0, 0.02, 0.1, 0.3, 0.6)), everyone[z])
    put(_feature(12, kind[z], _bins(e2[z], 0, 0.02, 0.3, 0.8), pointed[z]), everyone[z])
    put(_feature(13, c.kind[y]), everyone[y])
    dense = sum(map(len, at))
    within = np.flatnonzero(inner)
    put(_word_feature(d.words, 0xA5A5).take(wi), own)
    put(_word_feature(d_two, 0x5A5A).take(wi[within]), own[within])
    feature, at_ = np.concatenate(features), np.concatenate(at)
    return Batch(c, feature, at_, np.arange(len(at_)) >= dense, np.maximum(sizes, 1), n_words)


@dataclass
class Examples:
    """Tagged sequences to train on: features of clauses, clause by clause, and where those of each begin; tags of clauses; where each sequence begins and how long it is."""

    feature: np.ndarray
    lexical: np.ndarray
    starts: np.ndarray
    tags: np.ndarray
    begin: np.ndarray
    length: np.ndarray


class Field:
    """A linear-chain conditional random field over hashed clause features, with what its features need."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None, ends: np.ndarray | None = None, model: Languages | None = None):
        n = len(LABELS)
        self.w = np.zeros((DIM, n), np.float32) if weights is None else weights
        self.moves = np.zeros((n, n), np.float32) if moves is None else moves
        self.ends = np.full(CELLS, -1.0, np.float32) if ends is None else ends
        self.model = model or Languages([], np.zeros((0, language.BUCKETS)))
        self.seen = np.zeros(DIM, bool)  # features that it was trained on

    def scores(self, feature: np.ndarray, at: np.ndarray, lexical: np.ndarray, size: int) -> np.ndarray:
        w = self.w.take(feature, axis=0)
        w *= np.where(lexical, np.float32(1), np.float32(DENSE))[:, None]
        return np.stack([np.bincount(at, x, minlength=size) for x in w.T], 1)

    def decode(self, s: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The likeliest tags (Viterbi) of sequences of scores, all at once, step by step; the longest come first, so those still going on are a head of the list."""
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        tags = np.zeros(len(s), np.int64)
        if not len(order) or not length[0]:
            return tags
        going = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")  # how many have at least so many steps
        best = s[begin[: going[0]]]
        back = []
        lasting = best.copy()
        for t in range(1, length[0]):
            k = going[t]
            step = best[:k, :, None] + self.moves
            back.append(step.argmax(1))
            best = step.max(1) + s[begin[:k] + t]
            lasting[:k] = best
        now = lasting.argmax(1)
        some = np.flatnonzero(length > 0)
        tags[begin[some] + length[some] - 1] = now[some]
        for t in range(int(length[0]) - 1, 0, -1):
            k = going[t]
            now[:k] = back[t - 1][np.arange(k), now[:k]]
            tags[begin[:k] + t - 1] = now[:k]
        return tags

    def fit(self, chunks: Iterable[Examples], epochs: int = EPOCHS, rate: float = 0.15, batch: int = 32, seed: int = 6) -> Field:
        """Stochastic gradient ascent (AdaGrad) of the conditional likelihood, forward and backward, by batches of sequences of like length; of the features of words a share is left out by chance."""
        rng = np.random.default_rng(seed)
        n = len(LABELS)
        both, gm = np.c_[self.w, np.full(self.w.shape, 1e-6, np.float32)], np.full(self.moves.shape, 1e-6, np.float32)  # weights and sums of squares, side by side
        for _, x in ((e, x) for e in range(epochs) for x in chunks):
            feature, lexical, starts, tags, begin, length = x.feature, x.lexical, x.starts, x.tags, x.begin, x.length
            some = np.flatnonzero(length > 0)
            shuffled = some[np.argsort(length[some] + rng.random(len(some)) * 3)]
            groups = [shuffled[k : k + batch] for k in range(0, len(shuffled), batch)]
            rng.shuffle(groups)
            for group in groups:
                size = length[group]
                t_max = int(size.max())
                step = np.arange(t_max)
                mask = step < size[:, None]
                rows = np.where(mask, begin[group][:, None] + step, 0)
                flat = rows[mask]
                many = starts[flat + 1] - starts[flat]
                inner = np.repeat(np.arange(len(flat)), many)
                which = _ranges(starts[flat], many)
                words = lexical.take(which)
                stay = np.flatnonzero(~words | (rng.random(len(which)) > 0.4))
                f, inner, times = feature.take(which.take(stay)), inner.take(stay), np.where(words.take(stay), np.float32(1), np.float32(DENSE))[:, None]
                order = np.argsort(f.astype(np.min_scalar_type(DIM - 1)), kind="stable")  # of small numbers, which are sorted digit by digit
                ordered = f.take(order)
                new = np.r_[True, ordered[1:] != ordered[:-1]]
                first = np.flatnonzero(new)
                used = ordered.take(first)
                place = np.empty(len(f), np.int64)
                place[order] = np.cumsum(new) - 1
                held = both.take(used, axis=0)
                w, squares = np.ascontiguousarray(held[:, :n]), held[:, n:]
                s = np.zeros((len(group), t_max, n))
                s[mask] = np.add.reduceat(w.take(place, axis=0) * times, np.flatnonzero(np.r_[True, inner[1:] != inner[:-1]]), axis=0, dtype=np.float64)  # no clause is without features
                a, z = s.copy(), np.zeros_like(s)
                for t in range(1, t_max):
                    v = a[:, t - 1, :, None] + self.moves
                    top = v.max(1)
                    a[:, t] = np.where(mask[:, t, None], s[:, t] + top + np.log(np.exp(v - top[:, None]).sum(1)), a[:, t - 1])
                for t in range(t_max - 2, -1, -1):
                    v = self.moves + (s[:, t + 1] + z[:, t + 1])[:, None, :]
                    top = v.max(2)
                    z[:, t] = np.where(mask[:, t + 1, None], top + np.log(np.exp(v - top[..., None]).sum(2)), 0)
                final = a[np.arange(len(group)), size - 1]
                total = final.max(1) + np.log(np.exp(final - final.max(1, keepdims=True)).sum(1))
                err = -np.exp(a + z - total[:, None, None])
                np.put_along_axis(err, tags[rows][..., None], np.take_along_axis(err, tags[rows][..., None], 2) + 1, 2)
                if t_max > 1:
                    g, on = np.zeros_like(self.moves), mask.T[1:]
                    steps = np.exp(a.swapaxes(0, 1)[:-1][on][:, :, None] + self.moves + (s + z).swapaxes(0, 1)[1:][on][:, None, :] - total[np.nonzero(on)[1], None, None])
                    many = on.sum(1)
                    likely = np.add.reduceat(steps, np.cumsum(many) - many, axis=0)
                    pairs = tags[rows.T[:-1][on]], tags[rows.T[1:][on]]
                    for t, (k, x) in enumerate(zip(np.cumsum(many).tolist(), many.tolist())):
                        g -= likely[t]
                        np.add.at(g, (pairs[0][k - x : k], pairs[1][k - x : k]), 1)
                    gm += g * g
                    self.moves += rate * g / np.sqrt(gm)
                e = err[mask]
                grad = np.add.reduceat((e.take(inner, axis=0) * times).take(order, axis=0), first, axis=0).astype(np.float32)
                squares += grad * grad
                held[:, :n] = w + (rate * grad / np.sqrt(squares) - 1e-5 * w)
                both[used] = held
                self.seen[used] = True
        self.w = np.ascontiguousarray(both[:, :n])
        return self

    def tagged(self, questions: list[str], answers: list[str | None]) -> tuple[list[str | None], Batch, np.ndarray]:
        """The defect of each pair (in one form) or None, and the clauses with their tags."""
        b = featurize(questions, answers, self.ends, self.model)
        c, n = b.clauses, len(answers)
        m = len(c.pair)
        begin = np.searchsorted(c.pair, np.arange(n))
        tags = self.decode(self.scores(b.feature, b.at, b.lexical, m), begin, np.searchsorted(c.pair, np.arange(n), "right") - begin)
        cover = np.bincount(c.pair * len(LABELS) + tags, b.sizes, minlength=n * len(LABELS)).reshape(n, len(LABELS))
        total = cover.sum(1)
        broken = np.zeros(n, bool)
        broken[c.pair[c.last]] = tags[c.last] == UNFINISHED
        refused = (cover[:, REFUSAL] > 0) & (cover[:, REFUSAL] >= cover[:, FOREIGN_TAG] / 2) & (cover[:, ANSWER] + cover[:, UNFINISHED] <= 0.35 * total)
        copied = (cover[:, ECHO] >= 0.7 * total) & (total > 0)
        foreign = (cover[:, FOREIGN_TAG] >= 0.5 * total) & (total > 0)
        found = np.select([refused, copied, foreign, broken], ["refusal", "copy", "language", "truncated"], "").tolist()
        out: list[str | None] = [x or None for x in found]
        for k in np.flatnonzero(b.n_words < 4).tolist():
            if answers[k] is None or is_placeholder(answers[k]):
                out[k] = "empty"
        return out, b, tags


# ---------------------------------------------------------------- training


def count_ends(answers: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """By hash of words and of pairs of words of a clause: how often they come, and how often they end a clause that is finished."""
    c = clauses_of(answers)
    cell = lambda h: (h % np.uint64(CELLS)).astype(np.int64)
    inner = c.own[1:] == c.own[:-1]
    two = _pair_hash(c.words[:-1], c.words[1:])
    seen = np.bincount(cell(c.words), minlength=CELLS) + np.bincount(cell(two[inner]), minlength=CELLS)
    ends = np.r_[c.own[1:] != c.own[:-1], True][: len(c.own)] & (c.kind[c.own] == 4)
    ended = np.bincount(cell(c.words[ends]), minlength=CELLS) + np.bincount(cell(two[inner & ends[1:]]), minlength=CELLS)
    return seen, ended


def shares_of(seen: np.ndarray, ended: np.ndarray) -> np.ndarray:
    return np.where(seen >= LEAST_SEEN, ended / np.maximum(seen, 1), -1.0).astype(np.float32)


def declined(lang: str, rng: random.Random) -> str:
    """A way to decline, put together at random."""
    if rng.random() < 0.12:
        return rng.choice(DECLINE_WHOLE[lang])
    who, what = DECLINE[lang]
    return f"{rng.choice(who)} {rng.choice(what)}"


def invented(text: str, rng: random.Random) -> str:
    """A text in a language made up: its vowels and its other letters are exchanged among themselves."""
    letters = "aeiou", "bcdfghjklmnpqrstvwxyz"
    old, new = "".join(letters), "".join("".join(rng.sample(x, len(x))) for x in letters)
    return text.translate(str.maketrans(old + old.upper(), new + new.upper()))


def examples(pairs: list[tuple[str, str]], model: Languages, seed: int = 6) -> list[tuple[str, str, int | list[int]]]:
    """(question, answer, tag of all clauses, or of the last one as a list) from sound pairs and their spoilt variants.

    A pair counts as sound if its answer has eight words or more, half of
    them not the question's, is in the question's language, is finished and
    does not begin as a way to decline does.
    """
    rng = random.Random(seed)
    questions, answers = [q for q, _ in pairs], [a for _, a in pairs]
    langs, q_langs = model.best(answers), model.best(questions)
    words = lambda t: _WORD.findall(t.lower())
    starts = {" ".join(words(who)) for ls in DECLINE.values() for who in ls[0]} | {" ".join(words(w)) for ls in DECLINE_WHOLE.values() for w in ls}
    declines = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, starts), key=len, reverse=True)) + r")\b")
    sound: list[tuple[str, str, str]] = []
    by_lang: dict[str, list[str]] = {}
    for (q, a), lang, q_lang in zip(pairs, langs, q_langs):
        ws, qs = words(a), set(words(q))
        bare = a.rstrip("\"”»')] *\n")
        if len(ws) < 8 or not q or len(ws) - sum(map(qs.__contains__, ws)) < len(ws) / 2 or not bare or ord(bare[-1]) not in ENDS and not _LINE.match(a.split("\n")[-1]):
            continue
        if len(ws) < 40 and declines.search(" ".join(ws)):
            continue
        if lang:
            by_lang.setdefault(lang, []).append(a)
        if lang and lang == q_lang and not requested(q):
            sound.append((q, a, lang))
    out: list[tuple[str, str, int | list[int]]] = []
    asked: dict[str, list[str]] = {}
    for q, _, lang in sound:
        if len(q) >= PLAIN:
            asked.setdefault(lang, []).append(q)
    names = {"en": "English", "de": "German", "fr": "French", "es": "Spanish", "it": "Italian", "pt": "Portuguese", "nl": "Dutch", "ru": "Russian"}
    for q, a, lang in sound:
        out.append((q, a, 0))
        ws = a.split()
        cut = " ".join(ws[: rng.randint(max(2, len(ws) // 4), len(ws) - 1)])
        if rng.random() < 0.3:
            cut = cut[: -rng.randint(1, 3)] or cut
        cut = cut.rstrip(".!?…\"”") + rng.choice(["", "", "", "", ",", " (", " -", ":", " and", " ..."])
        final = re.split(r"(?<=[.!?…])[\"”»')\]]*\s+|\n+", cut.strip())[-1]
        if cut.strip() and not _LINE.match(final) and not _SMILE.search(final[-3:]):
            out.append((q, cut, [UNFINISHED]))
        if rng.random() < 0.7:
            bare = " ".join(re.findall(r"[^\W_]+", q)).lower()
            out.append((q, rng.choice([q, q, bare, q.upper(), f'"{q}"', f"You asked: {q}", f"{q} {q}", q.rstrip("?.! "), q.lower(), f"Question: {q}", f"> {q}"]), ECHO))
        own = lang if lang in DECLINE else "en"
        if rng.random() < 0.6:
            d = own if rng.random() < 0.7 else rng.choice(list(DECLINE))
            body = f"{rng.choice(DECLINE_OPEN[d])} {declined(d, rng)}".strip()
            if rng.random() < 0.15:
                body += rng.choice([" there", ", and I hope you understand", " at the moment", " about the weather"])
            body = body[0].upper() + body[1:] + rng.choice([".", ".", ".", "!", ""])
            close = rng.choice(DECLINE_CLOSE[d])
            if rng.random() < 0.2:
                close += " " + declined(d, rng).capitalize() + "."
            out.append((q, f"{body} {close}".strip(), REFUSAL))
        if rng.random() < 0.25:  # a long polite clause that ends in a refusal
            polite = re.findall(r"[^\W_]+", rng.choice(by_lang[lang]))[: rng.randint(10, 70)]
            out.append((q, " ".join(polite) + rng.choice([" but ", ", but ", " so ", " and yet "] if own == "en" else [", "]) + declined(own, rng) + ".", REFUSAL))
        # the answer to a question in another language: by the answer, so that no language's words alone speak for 'foreign'
        others = [x for x in asked if x != lang]
        if others and rng.random() < 0.8:
            other = rng.choice(asked[rng.choice(others)])
            out.append((other, a, FOREIGN_TAG))
            if lang in names:
                wish = rng.choice([f"Please answer in {names[lang]}.", f"Reply in {names[lang]}, please.", f"Could you write the answer in {names[lang]}?", f"Answer me in {names[lang]}."])
                out.append((f"{other} {wish}", a, 0))
        if len(q) >= PLAIN and rng.random() < 0.3:  # an answer in a language that nobody has seen
            out.append((q, invented(a, rng), FOREIGN_TAG))
        if rng.random() < 0.4:
            out.append((q, f"{rng.choice(CAVEATS[own])} {a}", 0))
        if rng.random() < 0.08:
            out.append((q, rng.choice(CAVEATS[own]) + " " + re.split(r"(?<=[.!?…])\s+|\n+", a)[0], 0))
        if rng.random() < 0.2:  # a sound answer that ends in a list, a signature or a smile
            out.append((q, a + rng.choice(["\n- wind: 12 km/h", "\n- rain: 3 mm\n- wind: 40 km/h", "\nHigh: 21 °C", "\n-- the editors", " :)", " (and that is all)", "\n* fog\n* frost"]), 0))
        if rng.random() < 0.15:  # a sound answer without any punctuation
            out.append((q, re.sub(r"[^\w\s]", "", a).strip(), 0))
    return out


def train(pairs: list[tuple[str, str]], model: Languages, ends: np.ndarray | None = None, seed: int = 6, epochs: int = 8) -> Field:
    """A field trained on sound pairs and their spoilt variants; ``ends`` are the end shares of all answers, else those of the sound ones are counted."""
    made = examples(pairs, model, seed)
    if ends is None:
        ends = shares_of(*count_ends([a for _, a, t in made if t == 0]))
    return Field(ends=ends, model=model).fit([prepared(made, ends, model)], epochs=epochs, seed=seed)


def prepared(made: list[tuple[str, str, int | list[int]]], ends: np.ndarray, model: Languages) -> Examples:
    """The features and tags of examples."""
    feature, lexical, many, tags, length = [[np.zeros(0, np.int32)], [np.zeros(0, bool)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    asked = Asked([q for q, _, _ in made], model)
    for x, y in cp.slices([q + a for q, a, _ in made], 1 << 18):  # so the code points of some examples are held at a time
        part = made[x:y]
        b = featurize([q for q, _, _ in part], [a for _, a, _ in part], ends, model, asked)
        c = b.clauses
        own = np.array([0 if isinstance(t, list) else t for _, _, t in part], np.int64)[c.pair]
        closing = np.array([t[0] if isinstance(t, list) else -1 for _, _, t in part], np.int64)[c.pair]
        tags.append(np.where(c.last & (closing >= 0), closing, own))
        order = np.argsort(b.at.astype(np.min_scalar_type(len(c.pair))), kind="stable")  # of small numbers, which are sorted digit by digit
        feature.append(b.feature[order].astype(np.int32))
        lexical.append(b.lexical[order])
        many.append(np.bincount(b.at, minlength=len(c.pair)))
        length.append(np.bincount(c.pair, minlength=len(part)))
    lengths = np.concatenate(length)
    return Examples(np.concatenate(feature), np.concatenate(lexical), np.r_[0, np.cumsum(np.concatenate(many))].astype(np.int64), np.concatenate(tags), np.cumsum(lengths) - lengths, lengths)


# ---------------------------------------------------------------- on tables


def cp_forms(texts: list[str | None]) -> list[str | None]:
    """The one form of each text with its line breaks kept; None stays."""
    lines = [[] if t is None or t.isascii() else t.split("\n") for t in texts]
    formed = iter(cp.one_form_texts(list(itertools.chain.from_iterable(lines))))
    return ["\n".join(itertools.islice(formed, len(ls))) if ls else t for t, ls in zip(texts, lines)]


def pair_rows(conversation: DataFrame) -> DataFrame:
    """(entry_id, msg_index, question, answer) of every assistant message without tool calls that follows a user message."""
    m = F.col("messages")
    at = F.sequence(F.lit(0), F.size(m) - 1)

    def made(i):
        one = F.get(m, i)
        asked = F.filter(F.slice(m, F.lit(1), i), lambda x: x["role"] == "user")
        return F.struct(
            i.alias("msg_index"), one["role"].alias("role"), F.coalesce(F.size(one["tool_calls"]), F.lit(0)).alias("calls"),
            F.size(asked).alias("asked"), F.get(asked, F.size(asked) - 1)["content"].alias("question"), one["content"].alias("answer"),
        )

    rows = conversation.where(F.size(m) > 1).select("entry_id", F.explode(F.transform(at, made)).alias("p"))
    return rows.where("p.role = 'assistant' and p.calls <= 0 and p.asked > 0").select("entry_id", F.col("p.msg_index").alias("msg_index"), "p.question", "p.answer")


_BLOCK = 1 << 10  # cells of a row of the table of end shares


def end_shares(rows: DataFrame) -> np.ndarray:
    """How often each word and pair of words of all answers ends a clause, by hash in a table of fixed size; -1 of those seen too rarely.  Tasks send the parts of the table they have counts for."""
    kind = "block int, cells binary"

    def sent(seen: np.ndarray, ended: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch:
        cells = np.stack([seen, ended], 1).astype("<i8")
        return pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int32)), pa.array([x.tobytes() for x in cells], pa.binary())], names=["block", "cells"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, ended = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
        for batch in batches:
            answers = batch.column("answer").to_pylist()
            for a, b in cp.slices(answers):
                x, y = count_ends(answers[a:b])
                seen += x
                ended += y
        seen, ended = seen.reshape(-1, _BLOCK), ended.reshape(-1, _BLOCK)
        used = np.flatnonzero(seen.any(1))
        if len(used):
            yield sent(seen[used], ended[used], used)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist()):
                cells = np.frombuffer(raw, "<i8").reshape(2, -1)
                sums[k] = sums[k] + cells if k in sums else cells
        if sums:
            every = np.stack(list(sums.values()))
            yield sent(every[:, 0], every[:, 1], np.array(list(sums)))

    got = rows.where("answer is not null").select("answer").mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).toArrow()  # of fixed size
    seen, ended = np.zeros((2, CELLS // _BLOCK, _BLOCK), np.int64)
    for k, raw in zip(got.column("block").to_pylist(), got.column("cells").to_pylist()):
        seen[k], ended[k] = np.frombuffer(raw, "<i8").reshape(2, -1)
    return shares_of(seen.reshape(-1), ended.reshape(-1))


def _chunks(rows: Iterable[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
    """Pairs in lists of at most CHUNK of them, and of about CHUNK_TEXT characters."""
    held, size = [], 0
    for q, a in rows:
        held.append((q, a))
        size += len(q) + len(a)
        if len(held) == CHUNK or size >= CHUNK_TEXT:
            yield held
            held, size = [], 0
    if held:
        yield held


def fitted(rows: DataFrame, model: Languages, ends: np.ndarray) -> Field:
    """A field trained on all rows (entry_id, msg_index, question, answer) with a question and an answer.

    The shards and the order in them are given by the keys and texts, whatever
    the partitioning.  Of a shard's pairs some CHUNK are held as text at a
    time; their features are held only where they are gone over again.
    """
    rows = rows.where((F.length("question") > 0) & (F.length("answer") > 0))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("question") + F.length("answer")), F.lit(0)).alias("text")).first()
    shards = max(1, -(-size["n"] // SHARD), -(-size["text"] // SHARD_TEXT))
    epochs = min(EPOCHS, max(1, round(SHARD * shards / max(size["n"], 1))))
    kind, labels = "block int, cells binary", len(LABELS)
    held = rows.sparkSession.sparkContext.broadcast((model, ends))  # of fixed size

    def sent(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in sums.values()], pa.binary())], names=["block", "cells"])

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
        for batch in batches:
            yield from zip(batch.column("shard").to_pylist(), cp_forms(batch.column("question").to_pylist()), cp_forms(batch.column("answer").to_pylist()))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, ends = held.value
        w, moves = np.zeros((DIM, labels + 1), np.int64), np.zeros(labels * labels + 1, np.int64)
        for shard, group in itertools.groupby(said(batches), lambda r: r[0]):
            seed = 6 + 7919 * shard
            made = (examples(part, model, seed + k) for k, part in enumerate(_chunks((q, a) for _, q, a in group)))
            chunks = (prepared(m, ends, model) for m in made if m)
            field = Field(ends=ends, model=model).fit(chunks if epochs == 1 else list(chunks), epochs, seed=seed)
            w += np.rint(np.c_[field.w.astype(float) * FINE, field.seen]).astype(np.int64)
            moves += np.rint(np.r_[field.moves.astype(float).reshape(-1) * FINE, field.seen.any()]).astype(np.int64)
        if moves[-1]:
            yield sent(dict(enumerate(w.reshape(-1, _BLOCK, labels + 1))) | {-1: moves})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, "<i8")
        if sums:
            yield sent(sums)

    keys = ["entry_id", "msg_index", "question", "answer"]
    dealt = rows.select(F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int").alias("shard"), *keys).repartitionById(shards, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", F.xxhash64("entry_id", "msg_index"), *keys).select("shard", "question", "answer")
    got = dealt.mapInArrow(fit, kind).repartition("block").mapInArrow(add, kind).toArrow()  # of fixed size
    w, moves = np.zeros((DIM // _BLOCK, _BLOCK, labels + 1)), np.zeros(labels * labels + 1)
    for k, raw in zip(got.column("block").to_pylist(), got.column("cells").to_pylist()):
        cells = np.frombuffer(raw, "<i8").astype(float)
        if k < 0:
            moves = cells
        else:
            w[k] = cells.reshape(_BLOCK, -1)
    w = w.reshape(DIM, -1)
    mean = w[:, :-1] / FINE / np.maximum(w[:, -1:], 1)
    return Field(mean.astype(np.float32), (moves[:-1] / FINE / max(moves[-1], 1)).reshape(labels, labels).astype(np.float32), ends, model)


def learned(rows: DataFrame, labelled: DataFrame) -> Field:
    """A field for rows (entry_id, msg_index, question, answer), trained on all of them.

    ``labelled`` has texts with their languages (text, lang).
    """
    said = rows.select(F.explode(F.array("question", "answer")).alias("text"))
    return fitted(rows, language.learned(labelled, other=said), end_shares(rows))


def tagged_pairs(rows: DataFrame, field: Field, clauses: bool = False) -> DataFrame:
    """(entry_id, msg_index, defect) of rows (entry_id, msg_index, question, answer); with ``clauses`` a row for each clause, with clause, tag and words (null for an answer without any)."""
    held = rows.sparkSession.sparkContext.broadcast(field)  # of fixed size
    names = ["entry_id", "msg_index", "defect"] + ["clause", "tag", "words"] * clauses

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for whole in batches:
            both = [(q or "") + (a or "") for q, a in zip(whole.column("question").to_pylist(), whole.column("answer").to_pylist())]
            for x, y in cp.slices(both, 1 << 18):
                batch = whole.slice(x, y - x)
                found, b, tags = own.tagged([q or "" for q in cp_forms(batch.column("question").to_pylist())], cp_forms(batch.column("answer").to_pylist()))
                columns = [batch.column("entry_id").cast(pa.int64()), batch.column("msg_index").cast(pa.int32()), pa.array(found, pa.string())]
                if clauses:
                    pair = b.clauses.pair
                    bare = np.setdiff1d(np.arange(batch.num_rows), pair)
                    none = [None] * len(bare)
                    columns = [v.take(pa.array(np.r_[pair, bare])) for v in columns]
                    columns += [pa.array(b.clauses.texts() + none, pa.string()), pa.array([LABELS[t] for t in tags.tolist()] + none, pa.string()), pa.array(b.sizes.tolist() + none, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("entry_id", "msg_index", "question", "answer").mapInArrow(run, "entry_id long, msg_index int, defect string" + ", clause string, tag string, words int" * clauses)


# ---------------------------------------------------------------- queries


def _pairs(spark: SparkSession, folder: str) -> tuple[DataFrame, Field]:
    rows = pair_rows(spread(table(spark, folder, "conversation").select("entry_id", "messages")))
    return rows, learned(rows, table(spark, folder, "documents").select("text", "lang"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """(entry_id, msg_index, defect) as TESTDATA.md states problem 6."""
    return tagged_pairs(*_pairs(spark, folder)).where("defect is not null")


def p6_clauses(spark: SparkSession, folder: str) -> DataFrame:
    """(entry_id, msg_index, defect, clause, tag, words): every clause of every answer with its tag."""
    return tagged_pairs(*_pairs(spark, folder), clauses=True)
