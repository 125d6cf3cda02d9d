"""A compact n-gram trie: Elias-Fano sequences and quantised values in flat, memory-mapped arrays."""

from __future__ import annotations

import mmap

import numpy as np

ONE = np.uint64(1)
WORD = 64
AT_ONCE = 1 << 15


def mapped(array: np.ndarray) -> np.ndarray:
    """A read-only copy in anonymous mapped memory: outside the interpreter's heap, given back as a whole."""
    if not array.nbytes:
        return array
    room = mmap.mmap(-1, array.nbytes)
    room.write(array.tobytes())
    return np.frombuffer(room, array.dtype)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits (at most 63), side by side in 64-bit words."""
    out = np.zeros(len(values) * width // WORD + 2, np.uint64)
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    np.bitwise_or.at(out, word, values << shift)
    over = shift + np.uint64(width) > np.uint64(WORD)
    np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(WORD) - shift[over]))
    return out


def unpack(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    at = index.astype(np.uint64) * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(WORD) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & np.uint64((1 << width) - 1)


class EliasFano:
    """A monotone sequence in about 2 + log2(universe / length) bits an element.

    Low bits are packed; high bits are unary in a bit vector, with a running count of ones for every word.
    """

    def __init__(self, values: np.ndarray) -> None:
        values = values.astype(np.uint64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.width = max(0, (top // max(self.n, 1)).bit_length() - 1)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        bits = np.zeros(-(-(self.n + (top >> self.width) + 2) // WORD) * WORD, np.uint8)
        bits[high + np.arange(self.n)] = 1
        self.high = mapped(np.packbits(bits, bitorder="little").view(np.uint64))
        self.ones = mapped(np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)]))
        self.zeros = mapped(np.arange(len(self.ones), dtype=np.int64) * WORD - self.ones)
        self.low = mapped(pack(values & np.uint64((1 << self.width) - 1), self.width)) if self.width else None

    @property
    def nbytes(self) -> int:
        return self.high.nbytes + self.ones.nbytes + self.zeros.nbytes + (self.low.nbytes if self.width else 0)

    def _select(self, index: np.ndarray, bit: int) -> np.ndarray:
        """Position of the index-th (from 0) one or zero of the high bits."""
        before = self.ones if bit else self.zeros
        out = np.empty(len(index), np.int64)
        for at in range(0, len(index), AT_ONCE):
            want = index[at : at + AT_ONCE]
            word = np.searchsorted(before, want, "right") - 1
            words = self.high[word] if bit else ~self.high[word]
            rest = want - before[word]
            place = np.zeros(len(want), np.int64)
            for half in (32, 16, 8, 4, 2, 1):  # halve the word, keep the side that holds the bit
                lower = np.bitwise_count((words >> place.astype(np.uint64)) & np.uint64((1 << half) - 1)).astype(np.int64)
                right = rest >= lower
                rest = rest - np.where(right, lower, 0)
                place += np.where(right, half, 0)
            out[at : at + AT_ONCE] = word * WORD + place
        return out

    def get(self, index: np.ndarray) -> np.ndarray:
        """Elements by position."""
        high = (self._select(index, 1) - index).astype(np.uint64) << np.uint64(self.width)
        return (high | unpack(self.low, self.width, index) if self.width else high).astype(np.int64)

    def search(self, values: np.ndarray) -> np.ndarray:
        """Position of each value in a strictly rising sequence, or -1.

        The values with the same high part stand between two zeros; that range is halved on the low parts.
        """
        if not self.n:
            return np.full(len(values), -1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        inside = high < int(self.zeros[-1]) - 1
        high = np.where(inside, high, 0)
        start = np.where(high > 0, self._select(np.maximum(high - 1, 0), 0) - high + 1, 0)
        end = self._select(high, 0) - high
        low = values & np.uint64((1 << self.width) - 1)
        a, b = start.copy(), np.minimum(end, self.n)
        while (open_ := a < b).any():
            middle = (a + b) // 2
            got = unpack(self.low, self.width, np.where(open_, middle, 0)) if self.width else np.zeros(len(a), np.uint64)
            less = open_ & (got < low)
            a, b = np.where(less, middle + 1, a), np.where(open_ & ~less, middle, b)
        hit = inside & (a < end)
        found = unpack(self.low, self.width, np.where(hit, a, 0)) if self.width else np.zeros(len(a), np.uint64)
        return np.where(hit & (found == low), a, -1)


class Quantised:
    """Values in one byte each, by a codebook of at most 256 rising values: each is coded as the nearest one.

    A slice of a larger model is given the model's codebook, so a value's code does not depend on what else is in the slice. Without
    one the codebook is made of the values: themselves if they are few, else equal steps over their range.
    """

    def __init__(self, values: np.ndarray, book: np.ndarray | None = None) -> None:
        if book is None:
            distinct = np.unique(values)
            book = distinct if len(distinct) <= 256 else np.linspace(distinct[0], distinct[-1], 256)
        self.book = book
        self.codes = mapped(np.searchsorted((book[1:] + book[:-1]) / 2, values).astype(np.uint8))

    def get(self, index: np.ndarray) -> np.ndarray:
        return self.book[self.codes[index]]


class Trie:
    """n-grams of any order by levels.

    Level 0 holds the tokens 0..size-1. An n-gram of a further level belongs to the node of its context in the level above; pointers
    (monotone, Elias-Fano) give a node's range of successors. Successors are stored relative to their context: each range goes on
    from the last element of the range before it, so a whole level is one rising sequence, in which a successor is searched
    as the context's base plus its id. Every level has a quantised value per node.
    """

    def __init__(self, size: int, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], values: np.ndarray, book: np.ndarray | None = None) -> None:
        """``levels``: per order from 2, (context node in the level above, last token, value), sorted by context and token; ``book``: the model's codebook."""
        self.pointers: list[EliasFano] = []
        self.successors: list[EliasFano] = []
        self.values = [Quantised(values, book)]
        above = size
        for context, token, value in levels:
            starts = np.searchsorted(context, np.arange(above + 1))
            self.pointers.append(EliasFano(starts))
            ends = starts[1:][starts[1:] > starts[:-1]]
            step = np.zeros(len(token), np.int64)
            step[ends[:-1]] = token[ends[:-1] - 1] + 1  # a range starts behind the last of the range before
            self.successors.append(EliasFano(np.cumsum(step) + token))
            self.values.append(Quantised(value, book))
            above = len(token)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in self.pointers + self.successors) + sum(v.codes.nbytes + v.book.nbytes for v in self.values)

    def child(self, level: int, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Node of ``token`` behind the node ``context`` of ``level`` (-1: none), or -1."""
        known = context >= 0
        pointers, successors = self.pointers[level], self.successors[level]
        at, inverse = np.unique(np.where(known, context, 0), return_inverse=True)
        start, end = pointers.get(at), pointers.get(at + 1)
        base = np.where(start > 0, successors.get(np.maximum(start - 1, 0)) + 1, 0) if successors.n else np.zeros(len(at), np.int64)
        found = successors.search(base[inverse] + token)
        inside = known & (found >= start[inverse]) & (found < end[inverse])
        return np.where(inside, found, -1)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Node of each n-gram (rows of token ids), or -1."""
        node = grams[:, 0]
        for level in range(grams.shape[1] - 1):
            node = self.child(level, node, grams[:, level + 1])
        return node
