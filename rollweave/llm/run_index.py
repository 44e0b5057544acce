"""A run-length index in numpy: a run-compressed Burrows-Wheeler transform with the suffix positions sampled at its run ends.

It is made for many short, similar texts. Each text ends in a separator of its own, so no match crosses a text's end. Of the
transform only the runs are kept: their symbols, the suffix positions sampled at each run's first and last row, and how many symbols the suffix of
its first row shares with the one above it. Neither the text nor the suffix order is kept; they are there only while the index is built.

Rows within a run stay neighbours when both move one symbol back in the text. So of two neighbouring positions of the text, the second
one's suffix has the next position above it, and shares one symbol less with it, unless a run begins at its row: the samples give both for every
position. Matching statistics of the texts against each other are streamed from them in text order, and the more the texts repeat, the fewer
samples there are. Symbols are compared at run heads alone, and there one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


def suffix_array(symbols: np.ndarray, width: int) -> np.ndarray:
    """Positions by their suffixes' first ``width`` symbols at least, by prefix doubling from as many symbols as a 62-bit key packs.

    A rank is the first row of its group of equals; after the first round only rows in groups of several are sorted again.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    bits = int(symbols.max() + 1).bit_length()
    size = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(min(size, n)):
        key <<= bits
        key[: n - k] += symbols[k:] + 1
    order = np.argsort(key)
    ranked, first, rank = key[order], np.ones(n, bool), np.empty(n, np.int64)
    first[1:] = ranked[1:] != ranked[:-1]
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while size < width:
        rows = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(rows):
            break
        at = order[rows]
        key = rank[at] * (n + 1)
        ahead = at + size
        inside = ahead < n
        key[inside] += rank[ahead[inside]] + 1
        by = np.argsort(key)
        at, key = at[by], key[by]
        new = np.ones(len(rows), bool)
        new[1:] = key[1:] != key[:-1]
        order[rows], first[rows] = at, new
        rank[at] = np.maximum.accumulate(np.where(new, rows, 0))
        size *= 2
    return order


def suffix_rows(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, suffix positions in order, each text's start, its size). Separators are 0 to len(texts) - 1; bytes come after them."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1].astype(np.int64)
    total = int((sizes + 1).sum())
    text = np.empty(total, np.int64)
    inside = np.ones(total, bool)
    inside[starts + sizes] = False
    text[~inside] = np.arange(len(texts))
    text[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + len(texts)
    return text, suffix_array(text, int(sizes.max(initial=0)) + 1), starts, sizes


@dataclass(frozen=True)
class RunIndex:
    """By run, in the order of their heads' places in the text: symbol; head: its first row's position; above: the position of the row above that (the
    last run's tail; -1 for the very first row); shared: the symbols that the two suffixes share. length: of the text, with separators."""

    symbol: np.ndarray
    head: np.ndarray
    above: np.ndarray
    shared: np.ndarray
    length: int

    @staticmethod
    def of(texts: Sequence[bytes]) -> RunIndex:
        return RunIndex.compressed(*suffix_rows(texts)[:2])

    @staticmethod
    def compressed(text: np.ndarray, order: np.ndarray) -> RunIndex:
        total = len(text)
        transform = text[order - 1]
        first = np.ones(total, bool)
        first[1:] = transform[1:] != transform[:-1]
        heads = np.flatnonzero(first)
        head, above = order[heads], np.append(-1, order[heads[1:] - 1])
        shared, live, k = np.zeros(len(heads), np.int64), np.arange(1, len(heads)), 0
        while len(live):
            a, b = head[live] + k, above[live] + k
            live = live[(a < total) & (b < total)]
            live = live[text[head[live] + k] == text[above[live] + k]]
            k += 1
            shared[live] = k
        by = np.argsort(head)
        return RunIndex(transform[heads][by], head[by], above[by], shared[by], total)

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """By position: how many symbols its suffix shares with the one above it in suffix order, and that one's position (below 0 for the first row)."""
        # Position 0 follows the last separator, a symbol of its own, so a run begins at its row.
        run = np.repeat(np.arange(len(self.head)), np.diff(np.append(self.head, self.length)))
        ahead = np.arange(self.length) - self.head[run]
        return self.shared[run] - ahead, np.where(self.above[run] < 0, -1, self.above[run] + ahead)


def later_matches(texts: Sequence[bytes], owner: np.ndarray, begin: np.ndarray, least: int) -> list[np.ndarray]:
    """For each text the offsets at which a string of ``least`` bytes starts that also starts at an earlier place of any text.

    The place of offset k of text i is (owner[i], begin[i] + k); equal places aren't earlier. Positions that share a string of ``least`` bytes are
    neighbours in suffix order; each is linked with the one above it, and the links are followed by doubling to the first, where the least place is kept.
    """
    if not len(texts):
        return []
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1].astype(np.int64)
    index = RunIndex.of(texts)
    shared, above = index.statistics()
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    offset = np.arange(index.length) - starts[text_of]
    place = (np.asarray(owner, np.int64)[text_of] << 34) + np.asarray(begin, np.int64)[text_of] + offset
    linked = np.flatnonzero(shared >= least)
    top = np.arange(index.length)
    top[linked] = above[linked]
    live = linked
    while len(live):
        further = top[top[live]]
        moved = further != top[live]
        top[live] = further
        live = live[moved]
    earliest = place.copy()
    np.minimum.at(earliest, top[linked], place[linked])
    late = np.flatnonzero(place > earliest[top])
    cuts = np.searchsorted(late, np.append(starts, index.length))
    return [offset[late[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
