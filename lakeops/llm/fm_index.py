"""FM-index of a shard of passages: backward search over a wavelet matrix, and
matching statistics of many passages at once.

The text of the index is the passages' words as numbers, each passage followed by an
end of its own (0, all ends differ and sort before words).  The Burrows-Wheeler
transform is kept as a wavelet matrix: one packed bit vector for each bit of a word's
number, with the ones counted before every 64 bits, about 1.5 bits a word and level.
All functions work on arrays, a lane for each passage searched.
"""

from __future__ import annotations

import numpy as np


class Wavelet:
    """Ranks of symbols in a sequence."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels = []
        n = len(seq)
        where = np.zeros(top + 1, np.int64)          # first place of each symbol on the last level
        symbols = np.arange(top + 1)
        for b in range(max(int(top).bit_length(), 1) - 1, -1, -1):
            bits = (seq >> b) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            words = np.zeros((n >> 6) + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            ones = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=ones[1:])
            zeros = n - int(bits.sum())
            self.levels.append((b, words, ones, zeros))
            where = self._down(where, symbols, b, words, ones, zeros)
            seq = np.concatenate([seq[bits == 0], seq[bits == 1]])
        self.first = where

    @staticmethod
    def _down(pos, symbols, b, words, ones, zeros):
        at = pos >> 6
        r = ones[at] + np.bitwise_count(words[at] & ((np.uint64(1) << (pos & 63).astype(np.uint64)) - np.uint64(1)))
        return np.where((symbols >> b) & 1, zeros + r, pos - r)

    def rank(self, symbols: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        for level in self.levels:
            pos = self._down(pos, symbols, *level)
        return pos - self.first[symbols]


class Least:
    """Least values of ranges, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while (1 << len(self.tables)) <= len(values):
            t, half = self.tables[-1], 1 << (len(self.tables) - 1)
            self.tables.append(np.minimum(t[:-half], t[half:]))
        self.flat = np.concatenate(self.tables)
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in self.tables])[:-1]])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least of [lo, hi), which are not empty."""
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        return np.minimum(self.flat[self.at[k] + lo], self.flat[self.at[k] + hi - (1 << k)])


class FMIndex:
    """Index of passages: ``words`` their numbers from 1, one after the other,
    ``lengths`` theirs, ``docs`` the document (any order) of each."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, docs: np.ndarray, depth: int):
        self.depth, n = depth, len(words) + len(lengths)
        self.ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.ends] = False
        text[inside] = words
        self.text, self.n, self.lengths, self.docs = text, n, lengths, docs
        order, lcp = self._sorted(text, inside)
        self.lcp = Least(lcp)
        self.doc = Least(np.repeat(docs, lengths + 1)[order])
        top = int(text.max(initial=1))
        counts = np.bincount(text, minlength=top + 1)
        self.below = np.cumsum(counts) - counts
        self.wavelet = Wavelet(text[order - 1], top)

    def _sorted(self, text: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order by doubled prefixes, and the common prefixes of neighbours, up
        to ``depth`` words (n + 1 values, 0 at both ends)."""
        n = len(text)
        rank = text + len(self.ends)
        rank[self.ends] = np.arange(len(self.ends))
        rank = np.unique(rank, return_inverse=True)[1]
        ranks, k = [(1, rank)], 1
        while rank.max(initial=0) < n - 1:
            after = np.zeros(n, np.int64)
            after[:-k] = rank[k:] + 1
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
            k *= 2
            if k <= self.depth:
                ranks.append((k, rank))
        order = np.argsort(rank)
        a, b = order[:-1].copy(), order[1:].copy()
        lcp = np.zeros(n + 1, np.int64)
        for size, r in reversed(ranks):
            same = r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)]
            lcp[1:n] += size * same
            a += size * same
            b += size * same
        return order, np.minimum(lcp, self.depth).astype(np.uint8)

    def extended(self, lo: np.ndarray, hi: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of ``word`` before what the ranges stand for."""
        got = self.wavelet.rank(np.concatenate([word, word]), np.concatenate([lo, hi])) + np.tile(self.below[word], 2)
        return got[:len(lo)], got[len(lo):]

    def widened(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of all suffixes that share ``depth`` words with those of the range."""
        lo, hi = lo.copy(), hi.copy()
        for j in range(len(self.lcp.tables) - 1, -1, -1):
            table, step = self.lcp.tables[j], 1 << j
            at = lo - step + 1
            lo -= np.where((at >= 0) & (table[np.maximum(at, 0)] >= depth), step, 0)
            fits = hi + step <= self.n + 1
            hi += np.where(fits & (table[np.where(fits, hi, 0)] >= depth), step, 0)
        return np.where(depth, lo, 0), np.where(depth, hi, self.n)

    def matches(self) -> np.ndarray:
        """For each place of the text, how many words from there on (``depth`` at most)
        stand in a passage of an earlier document than its own: matching statistics by
        backward search, all passages in step from their ends.

        A range that cannot be extended to the left, or holds no earlier document then,
        is cut to its longest shorter prefix that more suffixes share (its parent in the
        suffix tree) and tried again.
        """
        out = np.zeros(self.n, np.int64)
        lanes = np.argsort(-self.lengths, kind="stable")
        ends, own = self.ends[lanes], self.docs[lanes]
        left = np.searchsorted(-self.lengths[lanes], -np.arange(self.lengths.max(initial=0)), side="left")
        lo, hi = np.zeros(len(lanes), np.int64), np.full(len(lanes), self.n)
        size = np.zeros(len(lanes), np.int64)
        for t, n in enumerate(left):
            at = ends[:n] - 1 - t
            word, todo = self.text[at], np.arange(n)
            while len(todo):
                a, b = self.extended(lo[todo], hi[todo], word[todo])
                ok = b > a
                ok[ok] = self.doc(a[ok], b[ok]) < own[todo[ok]]
                good, bad = todo[ok], todo[~ok]
                lo[good], hi[good] = a[ok], b[ok]
                size[good] += 1
                full = good[size[good] > self.depth]
                if len(full):
                    size[full] = self.depth
                    lo[full], hi[full] = self.widened(lo[full], hi[full], size[full])
                bad = bad[size[bad] > 0]
                if len(bad):
                    size[bad] = np.maximum(self.lcp.tables[0][lo[bad]], self.lcp.tables[0][hi[bad]])
                    lo[bad], hi[bad] = self.widened(lo[bad], hi[bad], size[bad])
                todo = bad
            out[at] = size[:n]
        return out

    def repeats(self) -> list[list[tuple[int, int]]]:
        """For each passage the intervals (from, to) of its words that runs of ``depth``
        or more matching words cover."""
        hit = self.matches() >= self.depth
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        of = np.searchsorted(self.ends, starts)
        first = self.ends - self.lengths
        out: list[list[tuple[int, int]]] = [[] for _ in self.lengths]
        for i, a, b in zip(of.tolist(), (starts - first[of]).tolist(), (stops - first[of] - 1 + self.depth).tolist()):
            out[i].append((a, b))
        return out
