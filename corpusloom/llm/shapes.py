"""Hashed n-grams of the sentences and lines of whole Arrow columns of text, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Hashed features, and bytes of text taken at once (a longer text is taken whole).
FEATURES, AT_ONCE = 1 << 18, 1 << 21

# Letters with marks and the letters they are read as, signs that stand for plain ones, marks that show nothing.
LETTERS = {
    "i": "ıİìíîï", "c": "çÇ", "g": "ğĞ", "s": "şŞ", "o": "öÖòóôõ", "u": "üÜùúû", "a": "âÂäÄàáã", "e": "éèêë", "n": "ñ",
    " ": " ", "\x01": "«", "\x02": "»",
}
SIGNS = {'"': "“”„", "'": "‘’", "-": "–—", ".": "…"}
UNSEEN = "̧̇̆̈̂​‌‍"

SPACE, LETTER, DIGIT, SIGN = range(4)


def _classes() -> np.ndarray:
    out = np.full(256, SIGN, np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = SPACE
    out[ord("a") : ord("z") + 1] = LETTER
    out[128:] = LETTER
    out[ord("0") : ord("9") + 1] = DIGIT
    return out


CLASS = _classes()
_TWO, _THREE = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
_GONE = 255
for plain, marked in LETTERS.items():
    for x in marked:
        _TWO[int.from_bytes(x.encode(), "big")] = ord(plain)
for plain, marked in SIGNS.items():
    for x in marked:
        _THREE[int.from_bytes(x.encode(), "big") & 0xFFFF] = ord(plain)
for x in UNSEEN:
    code = x.encode()
    (_TWO if len(code) == 2 else _THREE)[int.from_bytes(code, "big") & 0xFFFF] = _GONE

_rng = np.random.default_rng(11)
#: Odd multipliers: of the bytes of a word by their place, and of the words of an n-gram.
_PLACES = _rng.integers(1 << 62, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _rng.integers(1 << 62, size=24, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Parts:
    """The parts of some texts: ``text``, which text each is of; ``start`` and ``end``, its bytes in ``folded``;
    and of their features ``owner``, the part, and ``index``, the feature."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    folded: bytes
    owner: np.ndarray
    index: np.ndarray


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts in small letters without marks, where each text begins and ends in them, and where a capital follows a small letter."""
    b = data.copy()
    low = (b >= 97) & (b <= 122)
    high = (b >= 65) & (b <= 90)
    camel = np.zeros(len(b), bool)
    camel[1:] = high[1:] & low[:-1]
    b[high] |= 32
    keep = np.ones(len(b), bool)
    two = np.flatnonzero((b[:-1] >= 0xC2) & (b[:-1] <= 0xCC)) if len(b) else np.empty(0, np.int64)
    to = _TWO[b[two].astype(np.int64) << 8 | b[two + 1]]
    two, to = two[to > 0], to[to > 0]
    b[two] = to
    keep[two + 1] = False
    keep[two[to == _GONE]] = False
    three = np.flatnonzero(b[:-2] == 0xE2) if len(b) > 2 else np.empty(0, np.int64)
    to = _THREE[b[three + 1].astype(np.int64) << 8 | b[three + 2]]
    three, to = three[to > 0], to[to > 0]
    b[three] = to
    dots = to == ord(".")
    for i in (1, 2):
        b[three[dots] + i] = ord(".")
        keep[three[~dots] + i] = False
    keep[three[to == _GONE]] = False
    place = np.concatenate([[0], np.cumsum(keep)])
    return b[keep], place[offsets], camel[keep]


def _since(counts: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Running counts from the start of each position's group ``of``."""
    before = np.concatenate([[0], counts])[starts]
    return counts - before[of]


def parts_of(data: np.ndarray, offsets: np.ndarray) -> Parts:
    """The sentences and lines of texts, and their features: words, signs and numbers in ones, twos and threes, shapes of three and four,
    the length of the part and of its text, and its words once more if it is the first.

    What stands in quotation marks has other features than the same outside of them; a sentence does not end within them."""
    b, ends, camel = folded(data, offsets)
    n = len(b)
    none = np.empty(0, np.int64)
    if not n:
        return Parts(none, none, none, b"", none, none)
    kind = CLASS[b]
    after, before = np.append(kind[1:], SPACE), np.append([SPACE], kind[:-1])
    # Apostrophes within a word part it; others are quotation marks.
    mark = b == ord("'")
    inner = mark & (after == LETTER) & ((before == LETTER) | (before == DIGIT))
    kind[inner] = SPACE
    b[mark & ~inner] = ord('"')
    joint = ((b == 46) | (b == 44) | (b == 47) | (b == 58)) & (before == DIGIT) & (after == DIGIT)
    kind[joint] = DIGIT

    line_start = np.zeros(n + 1, bool)
    line_start[ends[:-1][ends[:-1] < n]] = True
    line_start[1:] |= b == 10
    line_start = line_start[:n]
    line_start[0] = True
    line, starts = np.cumsum(line_start) - 1, np.flatnonzero(line_start)
    quote = b == ord('"')
    seen = _since(np.cumsum(quote), starts, line)
    total = np.add.reduceat(quote, starts, dtype=np.int64)
    # Of an odd number of marks in a line the last one opens nothing.
    inside = (seen % 2 == 1) & ~quote & (seen < (total + (total % 2 == 0))[line])

    part_start = line_start.copy()
    closing = ((b == 46) | (b == 33) | (b == 63) | (b == 59)) & (after == SPACE) & ~inside
    closing[1:] &= (b[1:] != 46) | (b[:-1] != 46)
    part_start[1:] |= closing[:-1]
    part, first = np.cumsum(part_start) - 1, np.flatnonzero(part_start)
    of_text = np.searchsorted(ends, first, side="right") - 1

    same = np.zeros(n, bool)
    same[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] != SIGN) | (b[1:] == b[:-1])) & ~part_start[1:]
    start = np.flatnonzero(~same)
    length = np.diff(np.append(start, n))
    place = np.arange(n) - np.repeat(start, length)
    code = np.add.reduceat((b.astype(np.uint64) + np.uint64(1)) * _PLACES[place & 63], start)
    odd = np.add.reduceat(camel, start, dtype=np.int64) > 0
    token, sign = kind[start], b[start]
    token_kept = (token != SPACE) | ((length >= 3) & (sign != 10))
    start, length, code, odd, token, sign = (x[token_kept] for x in (start, length, code, odd, token, sign))
    number = token == DIGIT
    status = number & (length == 3) & ((sign == 52) | (sign == 53))
    code[number] = _MIX[20]
    run = np.minimum(length, 4).astype(np.uint64)
    signs = token == SIGN
    code[signs] = (sign[signs].astype(np.uint64) * np.uint64(8) + run[signs]) * _MIX[22]
    code[token == SPACE] = _MIX[23]
    quoted = inside[start]
    code[quoted] *= _MIX[19]
    shape = np.where(token == LETTER, np.where(quoted, _MIX[17], _MIX[18]), code)
    owner = part[start]

    out_owner, out_code = [owner], [code * _MIX[0]]

    def runs(words: np.ndarray, k: int, kind_of: int) -> None:
        whole = np.flatnonzero(owner[k - 1 :] == owner[: len(owner) - k + 1])
        mixed = np.full(len(whole), np.uint64(kind_of))
        for j in range(k):
            mixed = (mixed ^ words[whole + j]) * _MIX[j + 1]
            mixed ^= mixed >> np.uint64(31)
        out_owner.append(owner[whole])
        out_code.append(mixed)

    runs(code, 2, 2)
    runs(code, 3, 3)
    runs(shape, 3, 13)
    runs(shape, 4, 14)
    # Numbers like those of failed requests, with the words beside them.
    for beside in (-1, 1):
        at = np.flatnonzero(status)
        at = at[(at + beside >= 0) & (at + beside < len(owner))]
        at = at[owner[at] == owner[at + beside]]
        out_owner.append(owner[at])
        out_code.append((code[at + beside] ^ _MIX[21]) * _MIX[15 + (beside > 0)])
    edge = np.ones(len(owner), bool)
    edge[1:] = owner[1:] != owner[:-1]
    last = np.append(edge[1:], True) if len(edge) else edge
    inner_first = np.concatenate([[True], of_text[1:] != of_text[:-1]])
    title = inner_first[owner]
    for chosen, times in ((edge, 6), (last, 7), (title, 8)):
        out_owner.append(owner[chosen])
        out_code.append(code[chosen] * _MIX[times])
    out_owner.append(owner[odd])
    out_code.append(np.full(int(odd.sum()), _MIX[9]))
    size = np.bincount(owner, minlength=len(first))
    parts_in = np.bincount(of_text[size > 0], minlength=len(offsets))[of_text]
    some = np.flatnonzero(size)
    for value, times in ((np.minimum(np.log2(size[some]), 7), 10), (np.minimum(np.log2(parts_in[some]), 6), 11)):
        out_owner.append(some)
        out_code.append((value.astype(np.uint64) + np.uint64(1)) * _MIX[times])
    out_owner.append(some)
    out_code.append((inner_first[some].astype(np.uint64) + np.uint64(1)) * _MIX[12])
    owners, codes = np.concatenate(out_owner), np.concatenate(out_code)
    codes ^= codes >> np.uint64(29)
    index = ((codes * _MIX[13]) >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)
    place = np.cumsum(size > 0) - 1
    return Parts(of_text[some], first[some], np.append(first[1:], n)[some], b.tobytes(), place[owners], index)


def words_of(data: np.ndarray, offsets: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every distinct word of two letters or more in each text; ``features`` is a power of two."""
    b, ends, _ = folded(data, offsets)
    if not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letter = CLASS[b] == LETTER
    edge = np.ones(len(b), bool)
    edge[1:] = letter[1:] != letter[:-1]
    edge[ends[:-1][ends[:-1] < len(b)]] = True
    start = np.flatnonzero(edge)
    length = np.diff(np.append(start, len(b)))
    place = np.arange(len(b)) - np.repeat(start, length)
    code = np.add.reduceat((b.astype(np.uint64) + np.uint64(1)) * _PLACES[place & 63], start)
    word = letter[start] & (length > 1)
    owner = np.searchsorted(ends, start[word], side="right") - 1
    index = ((code[word] * _MIX[13]) >> np.uint64(65 - features.bit_length())).astype(np.int64)
    key = np.unique(owner * features + index)
    return key // features, key % features


def sparse_vectors(owner: np.ndarray, index: np.ndarray, n: int, features: int) -> pa.Array:
    """``n`` of Spark's sparse vectors with the counts of each owner's features."""
    key, times = np.unique(owner * features + index, return_counts=True)
    at = pa.array(np.searchsorted(key, np.arange(n + 1) * features), pa.int32())
    fields = [pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, features), pa.int32())]
    fields += [pa.ListArray.from_arrays(at, pa.array(key % features, pa.int32())), pa.ListArray.from_arrays(at, pa.array(times.astype(np.float64)))]
    return pa.StructArray.from_arrays(fields, ["type", "size", "indices", "values"])


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a string column by about AT_ONCE bytes: the number of the first text, its bytes and those of the next ones, and their offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + AT_ONCE, side="right")) - 1)
        yield i, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j
