"""The measure of Ratcliff and Obershelp for many pairs of texts at once, with numpy: the matched characters that difflib's SequenceMatcher finds.

A round finds the first longest block of each pair; what lies before and after it goes into the next round, as long as the pair
isn't decided. `linked` has one word of bits for each pair and place of the first text (the equal places of the second one), for
texts that differ in 64 places at most. `Texts.matched` has a cell for each two places and takes texts of any length.

Texts that begin alike match there first, unless a block longer than what all of them begin with lies elsewhere in two of them.
Where no two texts have such a block their common beginning is taken at once, and the first round sees the rest only.
"""

from __future__ import annotations

import difflib
import os

import numpy as np

#: Cells that a batch has at a time; stretches of more cells than LONG are matched by difflib.
CELLS, LONG = 1 << 20, 1 << 22
#: Bytes of the bits of a batch, few enough for a core's cache.
BYTES = 1 << 19
#: What all texts begin with is looked at from this length on.
BEGIN = 4


def _elsewhere(texts: list[str], p: int) -> np.ndarray:
    """Which texts share a string of p + 1 characters with another one, and not only where both begin alike; p: all begin alike as far as that."""
    found: dict[str, list] = {}
    for t, text in enumerate(texts):
        for at in range(len(text) - p):
            f = found.setdefault(text[at : at + p + 1], [t, at, False, False])
            f[2] |= f[0] != t
            f[3] |= f[1] != at
    bad = {g for g, (_, at, several, moved) in found.items() if several and (moved or at > p)}
    return np.array([bool(bad) and any(text[at : at + p + 1] in bad for at in range(len(text) - p)) for text in texts], bool)


class Texts:
    """Different texts as numbers, ready to be measured."""

    def __init__(self, texts: list[str], begin: bool = True):
        """begin: texts are looked through for what all of them begin with."""
        self.texts = texts
        self.size = np.array([len(t) for t in texts], np.int64)
        letters, codes = np.unique(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
        kind = np.uint8 if len(letters) < 254 else np.uint16 if len(letters) < 65_534 else np.uint32
        self.end = np.iinfo(kind).max  # no character, as 0 is
        self.letters = len(letters)
        self.codes = np.concatenate([codes.astype(kind) + kind(1), np.zeros(self.size.max(initial=0), kind)])
        self.begin = np.cumsum(self.size) - self.size
        self.alike = len(os.path.commonprefix([min(texts), max(texts)])) if begin and len(texts) > 1 else 0
        self.alike = self.alike if self.alike >= BEGIN else 0
        self.elsewhere = _elsewhere(texts, self.alike) if self.alike else np.ones(len(texts), bool)
        self._bags = None

    def width(self) -> int:
        """Characters of the longest text that a first round sees."""
        return int(self.size.max(initial=0)) - (0 if self.elsewhere.any() else self.alike)

    def shared(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Characters that two texts share, in any order: as many match at most."""
        if self._bags is None:
            self._bags = np.zeros((len(self.texts), self.letters), np.int32)
            np.add.at(self._bags, (np.repeat(np.arange(len(self.texts)), self.size), self.codes[: self.size.sum()].astype(np.int64) - 1), 1)
        out = np.empty(len(x), np.int64)
        step = max(1, CELLS // max(1, self.letters))
        for at in range(0, len(x), step):
            out[at : at + step] = np.minimum(self._bags[x[at : at + step]], self._bags[y[at : at + step]]).sum(1)
        return out

    def _same_begin(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many characters two texts begin with alike; both begin with those of all."""
        n = np.minimum(self.size[x], self.size[y])
        out = np.full(len(x), self.alike)
        a, b = self.begin[x] + self.alike, self.begin[y] + self.alike
        on = n > self.alike
        while on.any():
            on &= self.codes.take(a) == self.codes.take(b)
            out += on
            on &= out < n
            a, b = np.minimum(a + 1, len(self.codes) - 1), np.minimum(b + 1, len(self.codes) - 1)
        return out

    def _block(self, a, na, b, nb):
        """Size and starts of the first longest block of a batch's stretches; all have a character."""
        wa, wb, n = int(na.max()), int(nb.max()), len(a)
        if wa * wb > LONG:
            ends = np.arange(len(a))
            out = np.empty((3, n), np.int64)
            for k in ends:
                left, right = (self.codes[s : s + c].tolist() for s, c in ((a[k], na[k]), (b[k], nb[k])))
                m = difflib.SequenceMatcher(None, left, right, autojunk=False).find_longest_match()
                out[:, k] = m.size, m.a, m.b
            return out
        kind = np.uint8 if min(wa, wb) < 255 else np.uint16
        rows, cols = np.arange(wa)[:, None], np.arange(wb)[:, None]
        left = self.codes.take(a + rows, mode="clip") * (rows < na)
        right = np.maximum(self.codes.take(b + cols, mode="clip"), (cols >= nb) * self.codes.dtype.type(self.end))
        ends = np.zeros((wa + 1, wb + 1, n), kind)  # of the blocks that end at a place in both, the sizes
        best, at = np.zeros(n, kind), np.zeros(n, np.int64)
        for i in range(wa):
            row = ends[i + 1, 1:]
            np.add(ends[i, :-1], kind(1), out=row)
            np.multiply(row, (right == left[i]).view(np.uint8), out=row)
            most = row.max(0)
            np.copyto(at, i, where=most > best)
            np.maximum(best, most, out=best)
        j = (ends[at + 1, 1:, np.arange(n)] == best[:, None]).argmax(1)
        size = best.astype(np.int64)
        return np.stack([size, at + 1 - size, j + 1 - size])

    def matched(self, x: np.ndarray, y: np.ndarray, least: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Matched characters of the texts x (first) and y of each pair, as far as needed to say whether they are at least `least` and fewer than `below`."""
        n = len(x)
        m = np.where(self.elsewhere[x] & self.elsewhere[y], 0, self._same_begin(x, y)) if self.alike else np.zeros(n, np.int64)
        pair, a, na, b, nb = np.arange(n), self.begin[x] + m, self.size[x] - m, self.begin[y] + m, self.size[y] - m
        while True:
            more = np.bincount(pair, np.minimum(na, nb), n).astype(np.int64)
            unsure = (more > 0) & (m < below) & (m + more >= least) & ((m < least) | (m + more >= below))
            go = unsure[pair] & (na > 0) & (nb > 0)
            pair, a, na, b, nb = pair[go], a[go], na[go], b[go], nb[go]
            if not len(pair):
                return m
            order = np.lexsort((nb, na)) if len(pair) > 1 else np.zeros(1, np.int64)
            pair, a, na, b, nb = pair[order], a[order], na[order], b[order], nb[order]
            found, at = np.empty((3, len(pair)), np.int64), 0
            while at < len(pair):
                to = min(len(pair), at + max(1, min(16_384, CELLS // int(na[at] * max(nb[at], 8)))))
                to = min(to, at + max(1, CELLS // int(na[to - 1] * nb[at:to].max())))
                found[:, at:to] = self._block(a[at:to], na[at:to], b[at:to], nb[at:to])
                at = to
            size, i, j = found
            m += np.bincount(pair, size, n).astype(np.int64)
            some = size > 0
            pair, a, na, b, nb, size, i, j = (v[some] for v in (pair, a, na, b, nb, size, i, j))
            pair, a, na, b, nb = (np.concatenate(v) for v in ((pair, pair), (a, a + i + size), (i, na - i - size), (b, b + j + size), (j, nb - j - size)))


def _bits(rest: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's letters as numbers (n for each text, in columns; 0: none), and the places of each letter in each text as bits."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(k).bits >= n)
    t = Texts(rest, begin=False)
    codes = np.zeros((max(n, 1), len(rest)), np.int64)
    of = np.repeat(np.arange(len(rest)), t.size)
    at = np.arange(len(of)) - t.begin[of]
    codes[at, of] = t.codes[: len(of)]
    places = np.zeros((t.letters + 1, len(rest)), kind)
    np.bitwise_or.at(places, (codes[at, of], of), kind(1) << at.astype(kind))
    return codes, places


def _common_subsequence(rows: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair: as many characters match at most."""
    v = np.full(rows.shape[1], np.iinfo(rows.dtype).max, rows.dtype)
    for row in rows:
        u = v & row
        v = (v + u) | (v - u)
    return np.bitwise_count(~v)


def _sure(m, more, least, below):
    """Whether m matched characters, and `more` more at most, say already that they are at least `least` and fewer than `below`, or not."""
    return (m >= below) | (m + more < least) | ((m >= least) & (m + more < below))


def _longer(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the columns in which blocks begin at a row: those in which blocks of a character more do, and whether there is any."""
    out = runs[1:] >> runs.dtype.type(1)
    out &= runs[:-1]
    some = np.zeros(runs.shape[1], runs.dtype)
    for row in out:
        some |= row
    return out, some != 0


def _first(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row with a bit, and its first bit."""
    kind = runs.dtype.type
    rows = np.zeros(runs.shape[1], kind)
    for r, row in enumerate(runs):
        rows |= (row != 0).astype(kind) << kind(r)
    i = np.bitwise_count((rows & (~rows + kind(1))) - kind(1))
    bits = runs[i, np.arange(len(i))]
    return i, np.bitwise_count((bits & (~bits + kind(1))) - kind(1))


def _longest(runs: np.ndarray, longer: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, ...]:
    """Size, row and column of the first longest block of each pair; runs: where blocks of one character begin, longer: of two."""
    kind = runs.dtype
    size, i, j = (np.zeros(runs.shape[1], kind) for _ in range(3))
    at, k = np.arange(runs.shape[1]), 1
    while len(at):
        end = np.flatnonzero(~on)
        if len(end):
            i[at[end]], j[at[end]] = _first(runs if len(end) == len(at) else np.take(runs, end, axis=1))
            size[at[end]] = k
            on = np.flatnonzero(on)
            at, longer = at[on], np.take(longer, on, axis=1)
        runs, k = longer, k + 1
        if len(at):
            longer, on = _longer(runs)
    return size, i, j


def _step(rows: np.ndarray, pair: np.ndarray, m: np.ndarray, least: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which of the pairs m doesn't decide even with what can be said at once of their rows (the equal places): rows, pair, and _longest's others.

    m gets as much of what matches in the rows as a decision needs.
    """
    has, least, below = m[pair], least[pair], below[pair]
    more = _common_subsequence(rows)
    longer, on = _longer(rows)
    # the longest block has a character or two at least: that may be enough
    block = np.minimum(more, on.view(np.uint8) + np.uint8(1))
    unsure = ~_sure(has, more, least, below)
    go = unsure & ~_sure(has + block, more - block, least, below)
    m[pair] = np.where(unsure & ~go, has + block, has)
    go = np.flatnonzero(go)
    return np.take(rows, go, axis=1), pair[go], np.take(longer, go, axis=1), on[go]


def _match(rows: np.ndarray, pair: np.ndarray, longer: np.ndarray, on: np.ndarray, m: np.ndarray, least: np.ndarray, below: np.ndarray) -> None:
    """Adds to m the blocks that match in rows, longest first, until it decides all pairs."""
    one, none = rows.dtype.type(1), rows.dtype.type(0)
    while len(pair):
        size, i, j = _longest(rows, longer, on)
        m[pair] += size.astype(m.dtype)
        before, end, after = (one << j) - one, i + size, ~((one << (j + size)) - one)
        for r, row in enumerate(rows):
            row &= np.where(i > r, before, np.where(end <= r, after, none))
        rows, pair, longer, on = _step(rows, pair, m, least, below)


class Compared:
    """Texts, all of which may be compared with all: what part of them differs, as bits if that is short."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        self.number = np.array([number.setdefault(t, len(number)) for t in texts])
        self.of = Texts(list(number))
        self.size = self.of.size[self.number]
        self.begin = 0 if self.of.elsewhere.any() else self.of.alike
        self.width = int(self.size.max(initial=0)) - self.begin
        if self.width <= 64:
            self.codes, self.places = _bits([t[self.begin :] for t in texts], self.width)

    def links(self, xs: slice, ys: slice, least: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Whether the matched characters of each text of xs (first) with each of ys are at least `least` and fewer than `below`; arrays of that shape."""
        if self.width > 64:
            return self._links(xs, ys, least, below)
        n, shape = least.shape[1], least.shape
        least, below, m = least.ravel(), below.ravel(), np.full(least.size, self.begin, least.dtype)
        rows = self.places[:, ys]
        few = max(1, BYTES // (rows.nbytes + 1))
        rest = []
        for x in range(0, shape[0], few):
            codes = self.codes[:, xs][:, x : x + few]
            rest.append(self._begun(rows[codes].reshape(len(codes), -1), np.arange(x * n, (x + codes.shape[1]) * n), m, least, below))
        _match(*(np.concatenate(v, axis=-1) for v in zip(*rest, strict=True)), m, least, below)
        return ((m >= least) & (m < below)).reshape(shape)

    def _begun(self, rows: np.ndarray, pair: np.ndarray, m: np.ndarray, least: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, ...]:
        """The first step, after what both texts begin with if that is known to be their first block."""
        if self.begin:
            kind = rows.dtype.type
            on, same = np.ones(len(pair), kind), np.zeros(len(pair), kind)
            for r, row in enumerate(rows):
                on &= row >> kind(r)
                same += on
            m[pair] += same.astype(m.dtype)
            after = ~((kind(1) << same) - kind(1))
            for r, row in enumerate(rows):
                row &= after
                row *= same <= r
        return _step(rows, pair, m, least, below)

    def _links(self, xs: slice, ys: slice, least: np.ndarray, below: np.ndarray) -> np.ndarray:
        x, y = self.number[xs], self.number[ys]
        a, b = np.nonzero((below > 0) & (np.minimum(self.size[xs][:, None], self.size[ys]) >= least))
        may = self.of.shared(x[a], y[b]) >= least[a, b]
        a, b = a[may], b[may]
        m = self.of.matched(x[a], y[b], least[a, b], below[a, b])
        out = np.zeros(least.shape, bool)
        out[a, b] = (m >= least[a, b]) & (m < below[a, b])
        return out
