"""Texts a few letters put in and taken out away from each other, found between blocks of texts of one length.

Lengths n and m and the share of edits allowed say how many letters each of two texts drops at most until both
read the same. Where there are few ways to drop them, both sides list a hash of what each way leaves, and only texts
that share one are alike. For longer texts the term is cut into one piece more than the edits: an edit spoils one
piece at most, so one piece stands in the word as it is, and no further from its place than the edits reach.
The smaller side's hashes are sorted, the other side's are looked up in them, a bounded number of each at a time.
Hashes only propose: every pair that is returned has been judged by its longest common subsequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np

from mirepoix.functions import lcs

_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD64 = (1 << 64) - 1
# Cells of the table that tells most absent hashes, as a power of two.
TABLE_BITS = 24


class Level(NamedTuple):
    """How words of ``n`` letters and terms of ``m`` that are ``edits`` apart are found; pieces if ``whole`` is false."""

    n: int
    m: int
    edits: int
    whole: bool

    @property
    def word_drops(self) -> int:
        return (self.edits + self.n - self.m) // 2

    @property
    def term_drops(self) -> int:
        return (self.edits + self.m - self.n) // 2


def most_edits(n: int, m: int, percent: int) -> int:
    """The most edits with 100 * edits < percent * (n + m) that lengths n and m allow; below 0 if there are none."""
    most = -(-(n + m) * percent // 100) - 1
    most -= (most + n + m) % 2
    return most if most >= abs(n - m) else -1


def level(n: int, m: int, edits: int, ways: int) -> Level:
    """Letters are dropped if neither side has more than ``ways`` ways to choose them."""
    whole = Level(n, m, edits, True)
    few = comb(n, whole.word_drops) <= ways and comb(m, whole.term_drops) <= ways
    return whole if few else Level(n, m, edits, False)


class Texts:
    """Distinct texts of one length, in order."""

    def __init__(self, joined: str, size: int):
        self.joined, self.size = joined, size
        self.count = len(joined) // size
        self.letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(self.count, size)
        self._signs: np.ndarray | None = None

    def at(self, places: np.ndarray) -> list[str]:
        size = self.size
        return [self.joined[i:i + size] for i in (places * size).tolist()]

    @property
    def signs(self) -> np.ndarray:
        """Which letters a text has, as 64 bits; two letters may share a bit."""
        if self._signs is None:
            self._signs = np.zeros(self.count, dtype=np.uint64)
            for column in self.letters.T:
                self._signs |= np.uint64(1) << (_mixed(column) >> np.uint64(58))
        return self._signs


def _mixed(letters: np.ndarray) -> np.ndarray:
    """64 scattered bits per code point."""
    bits = (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    bits = (bits ^ (bits >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return bits ^ (bits >> np.uint64(27))


def _sums(letters: np.ndarray) -> np.ndarray:
    """Per text a column of what its first 0, 1, ... letters sum up to, each times a power of the base."""
    sums = np.zeros((letters.shape[1] + 1, letters.shape[0]), dtype=np.uint64)
    for i, column in enumerate(letters.T):
        sums[i + 1] = sums[i] + _mixed(column) * np.uint64(pow(_BASE, i, 1 << 64))
    return sums


def _back(sums: np.ndarray, places: int) -> np.ndarray:
    """The sums of letters that stand so many places further to the front."""
    return sums * np.uint64(pow(_BASE_INVERSE, places, 1 << 64))


@lru_cache(maxsize=64)
def _chosen(size: int, dropped: int) -> np.ndarray:
    """The places of the letters that go, one row per way."""
    return np.array(list(combinations(range(size), dropped)), dtype=np.int32).reshape(comb(size, dropped), dropped)


def _shortened(letters: np.ndarray, dropped: int) -> np.ndarray:
    """One row per way to drop letters, one column per text.

    Behind a letter that goes, all others move up by a place: a way's sum is one term per letter dropped.
    """
    sums, places = _sums(letters), _chosen(letters.shape[1], dropped)
    keys = np.repeat(_back(sums[-1:], dropped), len(places), axis=0)
    for k in range(dropped):
        keys += (_back(sums[:-1], k) - _back(sums[1:], k + 1))[places[:, k]]
    return keys


def _piece_places(by: Level, word: bool) -> list[tuple[int, int, int]]:
    """``(piece, begin, end)`` in a term, or wherever in a word the piece may stand.

    A piece that is moved by s takes |s| edits before it and |n - m - s| behind it.
    """
    pieces, gap = min(by.edits + 1, by.m), by.n - by.m
    low, high = (-((by.edits - gap) // 2), (by.edits + gap) // 2) if word else (0, 0)
    limit = by.n if word else by.m
    out = []
    for i in range(pieces):
        begin, end = i * by.m // pieces, (i + 1) * by.m // pieces
        out += [(i, begin + s, end + s) for s in range(low, high + 1) if 0 <= begin + s and end + s <= limit]
    return out


def _cut(letters: np.ndarray, places: list[tuple[int, int, int]]) -> np.ndarray:
    """One row per piece, one column per text."""
    sums = _sums(letters)
    keys = np.empty((len(places), len(letters)), dtype=np.uint64)
    for row, (i, begin, end) in zip(keys, places):
        row[:] = _back(sums[end] - sums[begin], begin) + np.uint64((i + 1) * 0xD6E8FEB86659FD93 & _WORD64)
    return keys


def ways(by: Level, word: bool) -> int:
    """How many hashes a text lists."""
    if by.whole:
        return comb(by.n, by.word_drops) if word else comb(by.m, by.term_drops)
    return len(_piece_places(by, word))


def keys(letters: np.ndarray, by: Level, word: bool) -> np.ndarray:
    """Hashes of what may be left of each text, or of the pieces it may share: a column per text."""
    if by.whole:
        return _shortened(letters, by.word_drops if word else by.term_drops)
    return _cut(letters, _piece_places(by, word))


def salt(n: int, m: int) -> int:
    """Tells hashes of one pair of lengths from those of another."""
    return ((n << 32 | m) * 0x9E3779B97F4A7C15) & _WORD64


def _slices(count: int, each: int, cells: int) -> Iterator[slice]:
    step = max(1, cells // max(1, each))
    return (slice(i, min(count, i + step)) for i in range(0, count, step))


def _listed(found: np.ndarray, low: np.uint64) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Hashes with the text's place in their last bits, sorted; a table of the first bits that occur, how far these lie."""
    held = ((found & ~low) | np.arange(found.shape[1], dtype=np.uint64)).ravel()
    held.sort()
    bits = min(TABLE_BITS, max(8, (16 * len(held)).bit_length()))
    shift, table = np.uint64(64 - bits), np.zeros(1 << bits, dtype=bool)
    table[held >> shift] = True
    return held, table, shift


def _expanded(
    row: np.ndarray, begin: np.ndarray, many: np.ndarray, held: np.ndarray, low: np.uint64, size: int, full: int | None, cells: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``row`` beside each text of the ``many`` entries from ``begin`` on, about ``cells`` at a time, each pair once.

    A row of ``full`` entries or more comes with all ``size`` texts instead.
    """
    if full is not None:
        entries = np.bincount(row, many)
        common = np.flatnonzero(entries >= full)
        for some in _slices(len(common), size, cells):
            left = np.repeat(common[some], size)
            yield left, np.tile(np.arange(size), len(left) // size)
        own = entries[row] < full
        row, begin, many = row[own], begin[own], many[own]
    order = np.argsort(row, kind="stable")
    row, begin, many = row[order], begin[order], many[order]
    ends, start = np.cumsum(many), 0
    # a row's entries are not parted, so its pairs are told apart together
    last = np.flatnonzero(np.append(row[1:] != row[:-1], True)[:len(row)])
    while start < len(row):
        done = ends[start] - many[start]
        k = max(np.searchsorted(ends[last], done + cells, side="right") - 1, np.searchsorted(last, start))
        part = slice(start, int(last[k]) + 1)
        start = part.stop
        place = np.arange(int(many[part].sum())) - np.repeat(ends[part] - many[part] - done - begin[part], many[part])
        pairs = np.unique(np.repeat(row[part], many[part]) * size + (held[place] & low).astype(np.int64))
        yield pairs // size, pairs % size


def meetings(
    words: Texts, chosen: np.ndarray, terms: Texts, by: Level, cells: int, first: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words, of those ``chosen``, and of terms that share a hash; each pair once.

    With ``first`` a word need not come with all its terms, but with the first of them, perhaps repeatedly.
    """
    asked, listed = ways(by, True), ways(by, False)
    flipped = len(chosen) * asked < terms.count * listed
    some = words.letters[chosen] if len(chosen) < words.count else words.letters
    sides = [(terms.letters, False, listed), (some, True, asked)]
    (held_letters, held_word, held_ways), (own_letters, own_word, own_ways) = sides[::-1] if flipped else sides
    for part in _slices(len(held_letters), max(held_ways, by.n), 16 * cells):
        size = part.stop - part.start
        low = np.uint64((1 << max(1, (size - 1).bit_length())) - 1)
        held, table, shift = _listed(keys(held_letters[part], by, held_word), low)
        for own in _slices(len(own_letters), max(own_ways, by.n), cells):
            found = keys(own_letters[own], by, own_word).ravel()
            hit = np.flatnonzero(table[found >> shift])
            found = found[hit] & ~low
            begin = np.searchsorted(held, found)
            there = begin < len(held)
            there[there] = held[begin[there]] & ~low == found[there]
            hit, found, begin = hit[there], found[there], begin[there]
            row = hit % (own.stop - own.start) + own.start
            if first and not flipped:
                yield chosen[row], (held[begin] & low).astype(np.int64) + part.start
                continue
            many = np.searchsorted(held, found | low, side="right") - begin
            for left, right in _expanded(row, begin, many, held, low, size, None if by.whole else size, cells):
                right += part.start
                yield (chosen[right], left) if flipped else (chosen[left], right)


def _like(words: Texts, terms: Texts, word: np.ndarray, term: np.ndarray, edits: int | np.ndarray) -> np.ndarray:
    """False where letters that only one of the two has are more than it may drop."""
    own, other = words.signs[word], terms.signs[term]
    gap = words.size - terms.size
    return (2 * np.bitwise_count(own & ~other).astype(np.int64) <= edits + gap) & (
        2 * np.bitwise_count(other & ~own).astype(np.int64) <= edits - gap)


def _edits(words: Texts, terms: Texts, word: np.ndarray, term: np.ndarray) -> np.ndarray:
    return words.size + terms.size - 2 * lcs.lengths(words.at(word), terms.at(term))


def pairs(words: Texts, terms: Texts, percent: int, few: int, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of all words and terms with 100 * edits < percent * letters of both, each pair once, and their edits."""
    most = most_edits(words.size, terms.size, percent)
    if most < 0:
        return
    for word, term in meetings(words, np.arange(words.count), terms, level(words.size, terms.size, most, few), cells):
        like = _like(words, terms, word, term, most)
        word, term = word[like], term[like]
        edits = _edits(words, terms, word, term)
        right = edits <= most
        yield word[right], term[right], edits[right]


class Nearest:
    """Per word the term with the least share of edits, the first by name on a tie, of the blocks seen so far.

    A word is looked up with few edits first, and with more only while that could still better its share.
    """

    def __init__(self, words: Texts, percent: int, few: int, cells: int):
        self.words, self.percent, self.few, self.cells = words, percent, few, cells
        self.share = np.full(words.count, np.inf)
        self.edits = np.zeros(words.count, dtype=np.int64)
        self.term = np.full(words.count, None, dtype=object)

    def see(self, terms: Texts) -> None:
        """Take a block of terms into account."""
        n, m = self.words.size, terms.size
        most = most_edits(n, m, self.percent)
        left = np.ones(self.words.count, dtype=bool)
        for edits in range(abs(n - m), most + 1, 2):
            by = level(n, m, edits, self.few)
            if not by.whole:
                # pieces have no cheaper step of fewer edits: all that is left in one
                self._by_pieces(terms, level(n, m, most, 0), left)
                return
            chosen = np.flatnonzero(left & (self.share >= edits / (n + m)))
            if len(chosen):
                word, term = self._at(terms, by, chosen)
                left[word] = False
                self._take(word, np.full(len(word), edits), terms.at(term), m)

    def _at(self, terms: Texts, by: Level, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with a term just so many edits away, and the first of these terms; fewer edits are ruled out."""
        first = np.full(self.words.count, terms.count)
        for word, term in meetings(self.words, chosen, terms, by, self.cells, first=True):
            np.minimum.at(first, word, term)
        word = np.flatnonzero(first < terms.count)
        right = _edits(self.words, terms, word, first[word]) == by.edits
        for w in word[~right].tolist():
            # equal hashes of unlike texts: the word is compared with all terms
            near = np.flatnonzero(_edits(self.words, terms, np.full(terms.count, w), np.arange(terms.count)) == by.edits)
            first[w] = near[0] if len(near) else terms.count
        word = word[first[word] < terms.count]
        return word, first[word]

    def _by_pieces(self, terms: Texts, by: Level, left: np.ndarray) -> None:
        both = by.n + by.m
        chosen = np.flatnonzero(left & (self.share >= abs(by.n - by.m) / both))
        for word, term in meetings(self.words, chosen, terms, by, self.cells):
            # an edit more than the word's share so far: rounding must not cost a tie
            like = _like(self.words, terms, word, term, np.minimum(by.edits, self.share[word] * both + 1))
            word, term = word[like], term[like]
            edits = _edits(self.words, terms, word, term)
            right = edits <= by.edits
            word, term, edits = word[right], term[right], edits[right]
            order = np.lexsort((term, edits, word))
            best = order[np.append(True, word[order][1:] != word[order][:-1])] if len(order) else order
            self._take(word[best], edits[best], terms.at(term[best]), by.m)

    def _take(self, word: np.ndarray, edits: np.ndarray, term: list[str], m: int) -> None:
        """Keep a word's new term if it is better; each word comes once."""
        share, named = edits / (self.words.size + m), np.array([*term, None], dtype=object)[:-1]
        better = share < self.share[word]
        tie = np.flatnonzero(share == self.share[word])
        better[tie] = named[tie] < self.term[word[tie]]
        word = word[better]
        self.share[word], self.edits[word], self.term[word] = share[better], edits[better], named[better]

    def found(self) -> tuple[list[str], list[str], np.ndarray]:
        """Words that have a term, these, and their edits."""
        word = np.flatnonzero(np.isfinite(self.share))
        return self.words.at(word), self.term[word].tolist(), self.edits[word]
