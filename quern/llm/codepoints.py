"""Texts as positioned code points, in numpy columns.

Every text operator of this subpackage works on one layout: the code points
of many texts in one ``uint32`` array plus the row offsets.  A batch that
Arrow hands over is exploded once, all steps are array operations (table
lookups, cumulative sums, segment sorts), and only the rows that changed are
rebuilt as strings.  ``slices`` bounds the code points held at a time, so the
memory of a worker does not depend on the batch or on the longest text but for
one text that is itself longer than the bound.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np

SLICE = 1 << 20  # code points worked on at once

# Letters of other scripts that look like a basic Latin letter
# of the same case (from the public Unicode confusables data, letters only).
LOOKALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ү": "Y", "Һ": "H", "Ԁ": "D", "Ԍ": "G",
    "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ӏ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ү": "y", "ӏ": "l", "ɡ": "g",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j", "γ": "y",
    "χ": "x", "σ": "o",
    # Armenian
    "Լ": "L", "Օ": "O", "Տ": "S", "Ս": "U",
    "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ց": "g", "զ": "q", "յ": "j", "ա": "w",
    # phonetic
    "ɑ": "a", "ɩ": "i", "ɪ": "i", "ʏ": "y", "ʋ": "v", "ɯ": "w", "ᴄ": "c", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v",
    "ᴡ": "w", "ᴢ": "z",
}

_HANGUL_S, _HANGUL_L, _HANGUL_V, _HANGUL_T = 0xAC00, 0x1100, 0x1161, 0x11A7


class Tables:
    """Lookup tables by code point, derived from the interpreter's Unicode data."""

    def __init__(self) -> None:
        top = sys.maxunicode + 1
        keys = {ord(k): ord(v) for k, v in LOOKALIKES.items()}
        self.length = np.ones(top, np.uint8)
        self.start = np.zeros(top, np.int32)
        self.ccc = np.zeros(top, np.uint8)
        self.space = np.zeros(top, bool)
        self.alnum = np.zeros(top, bool)
        self.lower = np.arange(top, dtype=np.uint32)
        self.work = np.zeros(top, bool)  # code points that one_form may change or that may combine
        flat: list[int] = [0]  # so that 0 as a start means none
        pairs: dict[int, int] = {}
        norm, category, combining, decomposition = unicodedata.normalize, unicodedata.category, unicodedata.combining, unicodedata.decomposition
        for cp in range(top):
            if 0x3400 <= cp < 0xA000 or 0xD800 <= cp < 0xF900 or 0x20000 <= cp < 0x2F800 or cp >= 0xE1000:
                if category(chr(cp))[0] == "L":
                    self.alnum[cp] = True
                continue
            ch = chr(cp)
            kind = category(ch)
            if kind == "Cf":
                self.length[cp], self.work[cp] = 0, True
                continue
            if kind == "Cn":
                continue
            if ch.isspace():
                self.space[cp] = True
            if kind[0] == "L" or kind[0] == "N":
                self.alnum[cp] = True
                low = ch.lower()
                self.lower[cp] = ord(low) if len(low) == 1 else ord(low[0])
            self.ccc[cp] = combining(ch)
            hangul = _HANGUL_S <= cp < _HANGUL_S + 11172
            if decomposition(ch) or hangul or cp in keys:
                full = [keys.get(ord(x), ord(x)) for x in norm("NFKD", ch)]
                if hangul:
                    continue
                self.start[cp], self.length[cp], self.work[cp] = len(flat), len(full), True
                flat += full
                d = decomposition(ch)
                if d and d[0] != "<" and len(d.split()) == 2:
                    a, b = (int(x, 16) for x in d.split())
                    if norm("NFC", chr(a) + chr(b)) == ch:
                        pairs[a << 21 | b] = cp
            if self.ccc[cp] or 0x1100 <= cp < 0x1200:
                self.work[cp] = True
        for cp in range(_HANGUL_S, _HANGUL_S + 11172):
            self.alnum[cp] = True
        self.second = np.zeros(top, bool)  # code points that can be the later half of a pair
        self.flat = np.array(flat, np.uint32)
        for l in range(19):
            for v in range(21):
                lv = _HANGUL_S + (l * 21 + v) * 28
                pairs[(_HANGUL_L + l) << 21 | (_HANGUL_V + v)] = lv
                for t in range(1, 28):
                    pairs[lv << 21 | (_HANGUL_T + t)] = lv + t
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_to = np.array([pairs[k] for k in sorted(pairs)], np.uint32)
        self.second[self.pair_keys & (1 << 21) - 1] = True
        self.work |= self.second


_held: list[Tables] = []  # the tables of this process


def tables() -> Tables:
    if not _held:
        _held.append(Tables())
    return _held[0]


def use(given: Tables) -> None:
    """Take broadcast tables, where none have been derived in this process."""
    if not _held:
        _held.append(given)


def broadcast_tables(spark):
    """The tables as a broadcast value: 14 MB before compression, for any data."""
    return spark.sparkContext.broadcast(tables())


def explode(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and n + 1 offsets.  None counts as empty; lone surrogates become U+FFFD."""
    texts = [t or "" for t in texts]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    joined = "".join(texts)
    try:
        raw = joined.encode("utf-32-le")
    except UnicodeEncodeError:
        raw = joined.encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32)
    if codes.size and ((codes >= 0xD800) & (codes < 0xE000)).any():
        codes = np.where((codes >= 0xD800) & (codes < 0xE000), np.uint32(0xFFFD), codes)
    return codes, offsets


def rebuild(codes: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Strings again from code points."""
    text = codes.astype(np.uint32, copy=False).tobytes().decode("utf-32-le")
    return [text[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def slices(texts: Sequence[str | None], bound: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows that together have at most bound code points (a longer text is alone)."""
    start = held = 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if k > start and held + n > bound:
            yield start, k
            start, held = k, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def _keep(codes: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kept = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(mask, out=kept[1:])
    return codes[mask], kept[offsets]


def decompose(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join of the code points with the decomposition and look-alike tables: each row becomes 0, 1 or more."""
    t = tables()
    n = t.length[codes]
    at = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    out = np.repeat(codes, n)
    touched = np.flatnonzero((t.start[codes] > 0) & (n > 0))
    if touched.size:
        n_t = n[touched].astype(np.int64)
        inner = np.arange(n_t.sum()) - np.repeat(np.cumsum(n_t) - n_t, n_t)
        out[np.repeat(at[touched], n_t) + inner] = t.flat[np.repeat(t.start[codes[touched]].astype(np.int64), n_t) + inner]
    return out, at[offsets]


def reorder(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Combining marks in order of their class within each run (stable)."""
    ccc = tables().ccc[codes]
    marks = np.flatnonzero(ccc)
    if marks.size < 2:
        return codes
    rows = np.searchsorted(offsets, marks, "right")
    run = np.cumsum(np.r_[True, (np.diff(marks) > 1) | (np.diff(rows) > 0)])
    order = np.lexsort((marks, ccc[marks], run))
    if (order == np.arange(len(order))).all():
        return codes
    codes = codes.copy()
    codes[marks] = codes[marks[order]]
    return codes


def recompose(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Canonical composition: each starter takes its next unblocked mark that forms a pair, until none does."""
    t = tables()
    while True:
        later = np.flatnonzero(t.second[codes])
        later = later[later > 0]
        if not later.size:
            return codes, offsets
        ccc = t.ccc[codes]
        first_of_row = np.zeros(len(codes) + 1, bool)
        first_of_row[offsets] = True
        is_start = (ccc == 0) | first_of_row[:-1]
        starter = np.maximum.accumulate(np.where(is_start, np.arange(len(codes)), -1))
        # a later code point's starter is the last one before it; a starter combines only with its neighbour
        own = starter[later - 1]
        fits = ~first_of_row[later] & (ccc[own] == 0) & ((own == later - 1) | ((ccc[later] != 0) & (ccc[later - 1] != ccc[later])))
        later, own = later[fits], own[fits]
        key = codes[own].astype(np.int64) << 21 | codes[later]
        at = np.minimum(np.searchsorted(t.pair_keys, key), len(t.pair_keys) - 1)
        hit = t.pair_keys[at] == key
        later, own, to = later[hit], own[hit], t.pair_to[at[hit]]
        if not later.size:
            return codes, offsets
        head = np.r_[True, own[1:] != own[:-1]]
        # a composed starter may itself be the later half of its neighbour's pair: one of two neighbours at a time
        head &= ~np.r_[False, np.isin(own[1:], later[:-1])]
        codes = codes.copy()
        codes[own[head]] = to[head]
        mask = np.ones(len(codes), bool)
        mask[later[head]] = False
        codes, offsets = _keep(codes, offsets, mask)


def squeeze(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every run of white space is one plain space; none at the ends of a row."""
    if not len(codes):
        return codes, offsets
    space = tables().space[codes]
    codes = np.where(space, np.uint32(32), codes)
    begins = np.zeros(len(codes) + 1, bool)
    begins[offsets] = True
    mask = ~(space & (begins[:-1] | np.r_[True, space[:-1]]))
    codes, offsets = _keep(codes, offsets, mask)
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    mask = np.ones(len(codes), bool)
    mask[ends[codes[ends] == 32]] = False
    return _keep(codes, offsets, mask)


def one_form(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The one form of each row: decomposed, look-alikes mapped, marks ordered, recomposed, spaces squeezed.

    Code points that neither change nor combine pass through untouched; only
    rows that hold another are worked on.
    """
    busy = tables().work[codes]
    if busy.any() and not stable()[codes[busy]].all():
        codes, offsets = decompose(codes, offsets)
        codes = reorder(codes, offsets)
        codes, offsets = recompose(codes, offsets)
    return squeeze(codes, offsets)


@functools.cache
def stable() -> np.ndarray:
    """Code points that decompose, but whose one form on their own is themselves and that are no marks."""
    t = tables()
    out = np.zeros(len(t.work), bool)
    for cp in np.flatnonzero((t.start > 0) & (t.length > 0) & (t.ccc == 0) & ~t.second):
        full = t.flat[t.start[cp] : t.start[cp] + t.length[cp]]
        out[cp] = unicodedata.normalize("NFC", "".join(map(chr, full.tolist()))) == chr(cp)
    return out


def one_form_texts(texts: Sequence[str | None]) -> list[str]:
    """The one form of each text; of None an empty text."""
    out: list[str] = []
    for a, b in slices(texts):
        out += rebuild(*one_form(*explode(texts[a:b])))
    return out


# ---------------------------------------------------------------- hashing

P1, P2 = np.uint64(2147483647), np.uint64(2147483629)  # primes below 2^31
_B1, _B2 = 1103515245 % int(P1), 69069 * 31337 % int(P2)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, ...]:
    out = []
    for base, p in ((_B1, int(P1)), (_B2, int(P2))):
        for b in (base, pow(base, -1, p)):
            x = np.ones(1, np.uint64)
            step = b
            while len(x) < size:
                x = np.concatenate([x, x * np.uint64(step) % np.uint64(p)])
                step = step * step % p
            out.append(x[:size])
    return tuple(out)


def _mod(x: np.ndarray, p: np.uint64) -> np.ndarray:
    """x % p, by way of the quotient: numpy divides by a constant faster than it finds the rest."""
    q = x // p
    q *= p
    return x - q


def prefix_sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cumulative sums from which the hash of any span follows."""
    size = 1 << max(10, int(len(codes)).bit_length())
    b1, _, b2, _ = _powers(size)
    c = codes.astype(np.uint64) + np.uint64(1)
    sums = []
    for b, p in ((b1, P1), (b2, P2)):
        s = np.zeros(len(c) + 1, np.uint64)
        np.cumsum(_mod(c * b[: len(c)], p), out=s[1:])
        sums.append(s)
    return sums[0], sums[1], size


def span_hashes(sums: tuple[np.ndarray, np.ndarray, int], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """62-bit hashes of the spans [begin, end): equal for equal content wherever it stands."""
    s1, s2, size = sums
    _, i1, _, i2 = _powers(size)
    h1 = _mod(_mod(s1[end] - s1[begin], P1) * i1[begin], P1)
    h2 = _mod(_mod(s2[end] - s2[begin], P2) * i2[begin], P2)
    return h1 << np.uint64(31) | h2


def word_spans(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, lower-cased) of rows in one form, and where each begins and ends."""
    t = tables()
    none = np.zeros(0, np.int64)
    if not len(codes):
        return np.zeros(0, np.uint64), none, none
    low = t.lower[codes]
    letter = t.alnum[codes]
    edge = np.zeros(len(codes) + 1, bool)
    edge[offsets] = True
    begin = np.flatnonzero(letter & (edge[:-1] | np.r_[True, ~letter[:-1]]))
    end = np.flatnonzero(letter & (edge[1:] | np.r_[~letter[1:], True])) + 1
    return mix(span_hashes(prefix_sums(low), begin, end) + (end - begin).astype(np.uint64)), begin, end


def word_hashes(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows in one form, and row offsets of them."""
    hashes, begin, _ = word_spans(codes, offsets)
    return hashes, np.searchsorted(begin, offsets)


def gram_hashes(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of n consecutive words, and their rows' numbers; rows of fewer words have none."""
    size = np.diff(offsets)
    count = np.maximum(size - n + 1, 0)
    rows = np.repeat(np.arange(len(size)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(offsets[:-1], count)
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[at + k]) if k else words[at].copy()
    return h, rows


def gram_rows(texts: Sequence[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: the hashes of its n-word runs in order (flat, with offsets; a hash may repeat), its number of words, a 64-bit digest of its words."""
    flats, counts, words_n, digests = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in slices(texts):
        codes, offsets = one_form(*explode(texts[a:b]))
        words, at = word_hashes(codes, offsets)
        grams, rows = gram_hashes(words, at, n)
        flats.append(grams)
        counts.append(np.bincount(rows, minlength=b - a))
        words_n.append(np.diff(at))
        digests.append(row_digest(words, at))
    return np.concatenate(flats), np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int64), np.concatenate(words_n), np.concatenate(digests)


def gram_sets(texts: Sequence[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same with each text's hashes as a sorted set."""
    flat, offsets, words_n, digests = gram_rows(texts, n)
    rows = np.repeat(np.arange(len(words_n)), np.diff(offsets))
    order = np.lexsort((flat, rows))
    flat, rows = flat[order], rows[order]
    new = np.r_[True, (flat[1:] != flat[:-1]) | (rows[1:] != rows[:-1])][: len(flat)]
    return flat[new], np.r_[0, np.cumsum(np.bincount(rows[new], minlength=len(words_n)))].astype(np.int64), words_n, digests


def row_digest(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row's sequence of values."""
    size = np.diff(offsets)
    place = np.arange(len(values)) - np.repeat(offsets[:-1], size)
    x = mix(values ^ mix(place.astype(np.uint64) + np.uint64(0x51ED27)))
    s = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=s[1:])
    return mix((s[offsets[1:]] - s[offsets[:-1]]) ^ size.astype(np.uint64))
