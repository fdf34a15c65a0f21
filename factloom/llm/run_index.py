"""A run-length index of many short segments: run-compressed Burrows-Wheeler transform with sampled run ends, in numpy.

The suffix array is a temporary of the construction.  What stays is a row for each run of the transform: its symbol, its
length, the text positions at its two ends and the length of the match between its first suffix and the suffix before
that one.  Suffixes inside a run need nothing of their own: where two neighbours have one symbol before them, their match is one
shorter than that of the suffixes which begin one symbol earlier, and they are neighbours too.  So the match of every position of the
text with its neighbour, and where that neighbour is, stream off the sampled run ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BIG = np.iinfo(np.int64).max


def _prefix_keys(code: np.ndarray, left: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """The next symbols of every position packed in one number, and how many; nothing beyond the end of the segment counts."""
    key, have = code.astype(np.uint64), 1
    while 2 * have * bits <= 64:
        more = np.zeros_like(key)
        more[: len(key) - have] = key[have:]
        more[left < have] = 0
        key = key << np.uint64(have * bits) | more
        have *= 2
    return key, have


def suffix_array(code: np.ndarray, left: np.ndarray, bits: int) -> np.ndarray:
    """Suffix array of segments that each end with a 0.  ``left``: symbols to the segment's end.

    Suffixes are compared to the end of their segment; equal ones stand in the order of the text.  Only suffixes that are still
    tied are sorted again, by the ranks of what follows, with doubled reach.
    """
    n = len(code)
    key, reach = _prefix_keys(code, left, bits)
    order = np.argsort(key)
    key = key[order]
    head = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n, np.int64)
    longest = int(left.max()) if n else 0
    place = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = place
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    last = False
    while len(tied):
        p, group = order[tied], place[tied]
        if last:
            after = p
        else:
            after = np.where(left[p] >= reach, rank[np.minimum(p + reach, n - 1)] + 1, 0)
        key = group * (n + 1) + after
        by = np.argsort(key)
        key = key[by]
        order[tied] = p = p[by]
        if last:
            break
        new = np.append(True, key[1:] != key[:-1])
        # tied groups are whole, so a suffix's place is that of the first of its new group
        at = np.maximum.accumulate(np.where(new, tied, 0))
        place[tied] = at
        rank[p] = at
        tied = tied[~(new & np.append(new[1:], True))]
        reach *= 2
        last = reach > longest
    return order


class RunIndex:
    """Index of segments given as one run of bytes and their lengths."""

    def __init__(self, data: np.ndarray, lens: np.ndarray) -> None:
        n = len(data) + len(lens)
        self.n, self.lens = n, lens
        self.starts = np.cumsum(lens + 1) - (lens + 1)
        self.left = np.repeat(self.starts + lens, lens + 1) - np.arange(n)
        used = np.unique(data)
        letter = np.zeros(256, np.uint16)
        letter[used] = np.arange(1, len(used) + 1)
        body = self.left > 0
        self.text = np.zeros(n, np.uint16)
        self.text[body] = letter[data]
        bits = max(1, int(len(used)).bit_length())
        sa = suffix_array(self.text, self.left, bits)
        bwt = self.text[sa - 1]
        # ends of segments are different symbols, so each is a run of its own
        first = np.flatnonzero(np.append(True, (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0))) if n else np.zeros(0, np.int64)
        self.symbol, self.length = bwt[first], np.diff(np.append(first, n))
        self.first, self.last = sa[first], sa[first + self.length - 1]
        self.runs = len(first)
        self.match = np.zeros(self.runs, np.int64)
        self.match[1:] = self.common(self.first[1:], self.last[:-1])
        by = np.argsort(self.first)
        # in text order: position of a run's first suffix, its neighbour before it, their match
        self.at, self.before, self.common_length = self.first[by], np.append(-1, self.last)[by], self.match[by]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols two suffixes have in common, to the end of the shorter segment."""
        reach = np.minimum(self.left[a], self.left[b])
        out = np.zeros(len(a), np.int64)
        wide = np.zeros(self.n + 8, np.uint64)
        for k in range(4):  # four symbols of 16 bits
            wide[: self.n - k] = wide[: self.n - k] << np.uint64(16) | self.text[k:].astype(np.uint64)
            wide[self.n - k :] <<= np.uint64(16)
        live = np.arange(len(a))
        while len(live):
            x = wide[a[live] + out[live]] ^ wide[b[live] + out[live]]
            same = (x >> np.uint64(48) == 0).astype(np.int64)
            same += (x >> np.uint64(32) == 0) * 1
            same += (x >> np.uint64(16) == 0) * 1
            same += (x == 0) * 1
            out[live] += same
            live = live[(same == 4) & (out[live] < reach[live])]
        return np.minimum(out, reach)

    def stream(self, least: int, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Matching statistics in text order, by blocks: (positions with ``least`` symbols to go, match length, where it is).

        The match of a position is that with the suffix before it; suffixes that share ``least`` symbols are chained by it.
        """
        for s in range(0, self.n, block):
            at = s + np.flatnonzero(self.left[s : s + block] >= least)
            run = np.searchsorted(self.at, at, "right") - 1
            on = at - self.at[run]
            yield at, self.common_length[run] - on, self.before[run] + on

    def least_owners(self, owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions of all windows of ``length`` symbols, least owner of a segment that has the window).  Owners are those of segments."""
        at, match, where = (np.concatenate(x) for x in zip(*self.stream(length))) if self.n else [np.zeros(0, np.int64)] * 3
        number = np.zeros(self.n + 1, np.int64)
        number[at] = np.arange(len(at))
        chained = match >= length
        head = np.arange(len(at))
        head[chained] = number[where[chained]]
        while True:
            up = head[head]
            if (up == head).all():
                break
            head = up
        own = owners[np.searchsorted(self.starts, at, "right") - 1]
        least = np.full(len(at), BIG)
        np.minimum.at(least, head, own)
        return at, least[head]
