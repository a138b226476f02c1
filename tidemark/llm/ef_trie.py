"""Elias-Fano n-gram trie over word ids with quantised smoothed probabilities.

Level n holds the n-grams in the order of their first n - 1 words (the
context), then of the last word.  The successors of a context are a range of
its level; the ranges' borders are a monotone sequence, and so are the last
words once each range is lifted above the one before it.  Both are stored as
Elias-Fano sequences: low bits packed, high bits in unary with rank samples.
A query finds the context's node level by level, and the wanted word by a
successor search inside the context's own range.

Each level's log10 probabilities, and the log10 weights that a context hands
to the shorter one, are quantised to 256 values (quantiles).  The whole trie is
one flat byte string of arrays that are read in place, so it can be
memory-mapped.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np


class EliasFano:
    """A monotone sequence of n values below ``universe``."""

    def __init__(self, n: int, shift: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.shift, self.low, self.high, self.ranks = n, shift, low, high, ranks

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = values.astype(np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        shift = max(0, ((top + 1) // max(1, n)).bit_length() - 1)
        at = (v >> np.uint64(shift)).astype(np.int64) + np.arange(n)
        words = (int(at[-1]) // 64 + 1) if n else 1
        bits = np.zeros(words * 64, np.uint8)
        bits[at] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        ranks = np.zeros(words + 1, np.uint32)
        ranks[1:] = np.cumsum(bits.reshape(-1, 64).sum(axis=1))
        packed = np.zeros(n * shift // 64 + 2, np.uint64)
        if shift:
            low = v & np.uint64((1 << shift) - 1)
            bit = np.arange(n, dtype=np.uint64) * np.uint64(shift)
            word, off = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            np.bitwise_or.at(packed, word, low << off)
            spill = off + np.uint64(shift) > np.uint64(64)
            np.bitwise_or.at(packed, word[spill] + 1, low[spill] >> (np.uint64(64) - off[spill]))
        return cls(n, shift, packed, high, ranks)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at the positions i."""
        i = i.astype(np.int64)
        word = np.searchsorted(self.ranks, i, side="right") - 1
        bits = np.unpackbits(self.high[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # The (i - rank)-th one of the word: the first place where the count exceeds it.
        place = np.argmax(np.cumsum(bits, axis=1, dtype=np.int16) > (i - self.ranks[word])[:, None], axis=1)
        out = (word * 64 + place - i).astype(np.uint64) << np.uint64(self.shift)
        if self.shift:
            out |= self._low(i)
        return out.astype(np.int64)

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.shift)
        if self.shift:
            out |= self._low(np.arange(self.n))
        return out.astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i.astype(np.uint64) * np.uint64(self.shift)
        w, off = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        low = self.low[w] >> off
        rest = np.where(off > 0, self.low[w + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return (low | rest) & np.uint64((1 << self.shift) - 1)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.shift], np.int64), self.low, self.high, self.ranks]

    @classmethod
    def of(cls, head: np.ndarray, low: np.ndarray, high: np.ndarray, ranks: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), low, high, ranks)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, centres): the values themselves if they are 256 at most, else
    quantiles: 128 of all values, which hold the frequent ones exactly, and 128
    of the different ones, which hold the range."""
    centres = np.unique(x) if len(x) else np.zeros(1)
    if len(centres) > 256:
        steps = np.linspace(0, 1, 128)
        centres = np.unique([np.quantile(v, steps, method="nearest") for v in (x, centres)])
    return np.searchsorted((centres[1:] + centres[:-1]) / 2, x).astype(np.uint8), centres


class Trie:
    """Levels 2..order over the ids 0..size-1 (level 1 is the ids themselves)."""

    BITS = 21

    def __init__(self, size: int, levels: list[dict], bits: int = BITS):
        self.size, self.levels, self.bits = size, levels, bits
        self._decoded: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, size: int, grams: list[tuple[np.ndarray, np.ndarray]], weights: list[np.ndarray], bits: int = BITS) -> Trie:
        """grams[k]: sorted codes and log10 probabilities of the (k + 2)-grams;
        weights[k]: log10 weights of their contexts, in the contexts' order.

        A code holds the ids, the first highest, ``bits`` each; the context of
        every n-gram must be an id or an n-gram of the level below.
        """
        if size > 1 << bits:
            raise ValueError(f"{size} words do not fit {bits} bits")
        levels = []
        above, n_above = None, size
        for (codes, log_p), weight in zip(grams, weights, strict=True):
            head = codes >> np.uint64(bits)
            context = head.astype(np.int64) if above is None else np.searchsorted(above, head)
            borders = np.concatenate(([0], np.cumsum(np.bincount(context, minlength=n_above))))
            last = codes & np.uint64((1 << bits) - 1)
            lifted = (context.astype(np.uint64) << np.uint64(bits)) | last
            p, p_centre = quantise(log_p)
            w, w_centre = quantise(weight)
            levels.append({"borders": EliasFano.encode(borders), "last": EliasFano.encode(lifted), "p": p, "p_centre": p_centre,
                           "w": w, "w_centre": w_centre})
            above, n_above = codes, len(codes)
        return cls(size, levels, bits)

    def successor(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Node of context + word in levels[level], -1 if absent.

        Many queries at once: a level's sequence is decoded once, then each
        query is a binary search, which the lifted values confine to the
        context's range.  Few queries search the packed sequence itself.
        """
        lv = self.levels[level]
        out = np.full(len(context), -1, np.int64)
        ok = np.flatnonzero((context >= 0) & (word >= 0))
        if not len(ok) or not lv["last"].n:
            return out
        want = (context[ok] << self.bits) | word[ok]
        if len(ok) * 16 >= lv["last"].n:
            if level not in self._decoded:
                self._decoded[level] = lv["last"].decode()
            all_ = self._decoded[level]
            at = np.searchsorted(all_, want)
            found = all_[np.minimum(at, len(all_) - 1)] == want
            out[ok[found]] = at[found]
            return out
        lo, hi = lv["borders"].get(context[ok]), lv["borders"].get(context[ok] + 1)
        end = hi.copy()
        while (lo < hi).any():
            mid = (lo + hi) // 2
            less = (lo < hi) & (lv["last"].get(np.minimum(mid, lv["last"].n - 1)) < want)
            lo, hi = np.where(less, mid + 1, lo), np.where(less | (lo >= hi), hi, mid)
        hit = np.flatnonzero(lo < end)
        hit = hit[lv["last"].get(lo[hit]) == want[hit]]
        out[ok[hit]] = lo[hit]
        return out

    def log10_p(self, words: np.ndarray, unigram: np.ndarray, history: np.ndarray) -> np.ndarray:
        """log10 P(words[i] | the history[i] words before it), longest match first.

        ``words`` are ids (-1 outside of the trie), ``unigram`` their log10
        probabilities without context.
        """
        n = len(words)
        out = np.zeros(n)
        # nodes[k][i]: node of the k + 1 words that end at i.
        nodes = [words.astype(np.int64)]
        for k in range(len(self.levels)):
            node = np.full(n, -1, np.int64)
            at = np.flatnonzero(history >= k + 1)
            node[at] = self.successor(k, nodes[k][at - 1], words[at])
            nodes.append(node)
        open_ = np.ones(n, bool)
        for k in range(len(self.levels) - 1, -1, -1):
            lv = self.levels[k]
            hit = np.flatnonzero(open_ & (nodes[k + 1] >= 0))
            out[hit] += lv["p_centre"][lv["p"][nodes[k + 1][hit]]]
            open_[hit] = False
            at = np.flatnonzero(open_ & (history >= k + 1))
            at = at[nodes[k][at - 1] >= 0]
            out[at] += lv["w_centre"][lv["w"][nodes[k][at - 1]]]
        out[open_] += unigram[open_]
        return out

    def to_bytes(self) -> bytes:
        arrays: list[np.ndarray] = [np.array([self.size, self.bits], np.int64)]
        for lv in self.levels:
            arrays += [*lv["borders"].arrays(), *lv["last"].arrays(), lv["p"], lv["p_centre"], lv["w"], lv["w_centre"]]
        head, body, at = [struct.pack("<q", len(arrays))], [], 8 + 24 * len(arrays)
        for a in arrays:
            raw = np.ascontiguousarray(a).tobytes()
            pad = -len(raw) % 8
            head.append(struct.pack("<qq8s", at, len(raw), a.dtype.str.encode().ljust(8)))
            body.append(raw + b"\0" * pad)
            at += len(raw) + pad
        return b"".join(head + body)

    @classmethod
    def from_buffer(cls, buffer) -> Trie:
        """Read in place from bytes, an Arrow buffer or a memory-mapped file."""
        (count,) = struct.unpack_from("<q", buffer, 0)
        arrays = []
        for k in range(count):
            at, size, kind = struct.unpack_from("<qq8s", buffer, 8 + 24 * k)
            dtype = np.dtype(kind.decode().strip())
            arrays.append(np.frombuffer(buffer, dtype, size // dtype.itemsize, at))
        levels = []
        for k in range(1, count, 12):
            a = arrays[k:k + 12]
            levels.append({"borders": EliasFano.of(*a[:4]), "last": EliasFano.of(*a[4:8]), "p": a[8], "p_centre": a[9],
                           "w": a[10], "w_centre": a[11]})
        return cls(int(arrays[0][0]), levels, int(arrays[0][1]))

    @classmethod
    def open(cls, path: str) -> Trie:
        with open(path, "rb") as f:
            return cls.from_buffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
