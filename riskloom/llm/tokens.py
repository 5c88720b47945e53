"""Word tokens without the punctuation around them, and the classes that templates replace."""

from __future__ import annotations

import numpy as np

from . import kernel as K

_CORE = np.zeros(256, bool)
_CORE[48:58] = _CORE[65:91] = _CORE[97:123] = True
_CORE[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NUMERIC = _DIGIT.copy()
_NUMERIC[[ord(c) for c in ".,:/-"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:\""]] = True

#: Number words and units of measurement.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds lb lbs "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes hour hours day days week weeks month months year years "
    "mph kmh degree degrees celsius fahrenheit percent cent cents dollar dollars euro euros usd eur watt watts kw volt volts amp amps joule joules newton newtons "
    "pascal hz khz mhz ghz bit bits byte bytes kb mb gb tb item items piece pieces unit units"
).split()
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
_PLACEHOLDERS = K.mix(np.array([0, 1001, 1002, 1003], np.uint64))


def word_hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return np.sort(K.span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends, (51,), lower=True)[0])


def folded(data: np.ndarray) -> np.ndarray:
    """Small letters for A-Z and for the capitals of the Latin-1 block (C3 80 .. C3 9E in UTF-8)."""
    out = K.LOWER[data]
    capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[1:][capital] += 0x20
    return out


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


_NUMBER_HASHES, _UNIT_HASHES = word_hashes(NUMBER_WORDS), word_hashes(UNITS)


def cores(data: np.ndarray, offsets: np.ndarray):
    """(start, end, whole start, whole end, first of each document, hash) of words' cores, with small letters in the hash.

    A core is a word without ASCII marks at its ends; words of marks only are left out.
    """
    starts, ends = K.word_bounds(data, offsets)
    solid = np.flatnonzero(_CORE[data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    full = b > a
    starts, ends, a, b = starts[full], ends[full], a[full], b[full]
    s, e = solid[a], solid[b - 1] + 1 if len(b) else b
    return s, e, starts, ends, K.documents_of(starts, offsets), K.span_hashes(folded(data), s, e, (51,))[0]


def template(data: np.ndarray, offsets: np.ndarray):
    """(start, end, first of each document, kind, hash, opening, own hash) of tokens, with placeholders' hashes for numbers, names and units.

    opening: capitalised words that open a document, line or sentence; they are literal here, and may be names as well.
    """
    s, e, whole, whole_end, first, h = cores(data, offsets)
    n = len(s)
    kind = np.zeros(n, np.int8)
    if not n:
        return s, e, first, kind, h, np.zeros(0, bool), h
    count = np.concatenate([[0], np.cumsum(_NUMERIC[data])])
    number = (_DIGIT[data[s]] & (count[e] - count[s] == e - s)) | _among(h, _NUMBER_HASHES)
    doc_start = np.zeros(n, bool)
    doc_start[first[:-1][first[:-1] < first[1:]]] = True
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    opens = doc_start.copy()
    opens[1:] |= _STOP[data[whole_end[:-1] - 1]] | (lines[whole[1:]] > lines[whole_end[:-1]])
    # a capital with a small letter after it: words all in capitals stay literal
    at = lambda i: data[np.minimum(i, len(data) - 1)]
    wide = (at(s) == 0xC3) & (at(s + 1) >= 0x80) & (at(s + 1) <= 0x9E)
    then = s + 1 + wide
    small = (then < e) & (((at(then) >= 97) & (at(then) <= 122)) | ((at(then) == 0xC3) & (at(then + 1) >= 0xA0)) | (at(then) > 0xC3))
    upper = (wide | ((at(s) >= 65) & (at(s) <= 90))) & small
    kind[upper & ~opens] = NAME
    kind[number] = NUMBER
    after = np.zeros(n, bool)
    after[1:] = number[:-1] & ~doc_start[1:]
    kind[after & ~number & _among(h, _UNIT_HASHES)] = UNIT
    return s, e, first, kind, np.where(kind == LITERAL, h, _PLACEHOLDERS[kind]), upper & opens & (kind == LITERAL), h


def variants(kind: np.ndarray, h: np.ndarray, opening: np.ndarray):
    """(kinds, hashes) with none, all, and each half of the opening words as names: all ways for up to two in a window."""
    half = np.cumsum(opening) % 2 == 1
    for name in (np.zeros(len(kind), bool), opening, opening & half, opening & ~half):
        yield np.where(name, np.int8(NAME), kind), np.where(name, _PLACEHOLDERS[NAME], h)
