"""A run-length index over a set of byte strings: run-compressed Burrows-Wheeler transform with sampled run ends.

The strings are concatenated, each ended by a separator of its own that sorts below every byte. The suffix array comes from
prefix doubling on numpy arrays (only ties are sorted again) and is dropped once the index stands: what is kept are the runs of the
transform (first row, symbol, last-to-first target), the text position at each run's last row, and, for the intervals of rows whose
suffixes agree on ``depth`` bytes, the smallest text position. Streaming a string right to left through the runs gives the row
of each of its suffixes, hence whether its longest match elsewhere reaches ``depth`` and where that substring starts first.
"""

from __future__ import annotations

import numpy as np

DEPTH = 100


class RunLengthIndex:
    def __init__(self, strings: list[bytes], depth: int = DEPTH):
        self.depth, m = depth, len(strings)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.end = np.cumsum(self.size + 1) - 1  # text position of each separator
        data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        text = data.astype(np.int64) + m
        text[self.end] = np.arange(m)
        rank, part, h = self._ranks(data)
        n = len(text)
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        last = text[order - 1]
        change = np.nonzero(np.concatenate([[True], last[1:] != last[:-1]]))[0]
        self.run_start, self.run_symbol = change, last[change]
        length = np.diff(np.append(change, n))
        self.run_end_sample = order[change + length - 1]
        by = np.argsort(self.run_symbol, kind="stable")
        self.run_target = np.empty(len(change), np.int64)
        self.run_target[by] = np.cumsum(length[by]) - length[by]
        # intervals of rows that agree on ``depth`` bytes, and the first place of each
        new = np.zeros(n, bool)
        new[0] = True
        for offset in sorted({*range(0, self.depth - h + 1, h), max(0, self.depth - h)}):
            own = part[np.minimum(order + offset, n - 1)]
            own[order + offset >= n] = -1
            new[1:] |= own[1:] != own[:-1]
        starts = np.nonzero(new)[0]
        self.interval_start, self.interval_first = starts, np.minimum.reduceat(order, starts)

    def _ranks(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(row of every suffix, ranks by h bytes, h): h is the last length sorted by that is not above ``depth``.

        A suffix ends at its string's separator; of equal ones that of the earlier string is smaller, as if separators
        differed. Ranks by h bytes tell suffixes that end before h bytes from all others, but not from each other."""
        n = len(data)
        of = np.repeat(np.arange(len(self.end)), self.size + 1)
        left = self.end[of] - np.arange(n)  # bytes up to the separator
        used = np.unique(data)
        number = np.zeros(256, np.int64)
        number[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        symbol = number[data]
        symbol[self.end] = 0
        first = min(int(62 / np.log2(width)), self.depth, 16)
        key = symbol
        length = 1
        while length < first:
            more = min(length, first - length)  # symbols at ``length`` and on, as a number of that many digits
            after = np.zeros(n, np.int64)
            after[:max(0, n - length)] = key[length:] // width ** (length - more)
            after[left <= length] = 0
            key = key * width ** more + after
            length += more
        h, (rank, ties) = first, self._refined(key, np.arange(n), np.zeros(n, np.int64))
        part, part_h = rank, h
        while len(ties) and h <= self.size.max(initial=0):
            after = np.where(left[ties] >= h, rank[np.minimum(ties + h, n - 1)] + 1, 0)
            rank, ties = self._refined(rank[ties] * (n + 2) + after, ties, rank)
            h *= 2
            if h <= self.depth:
                part, part_h = rank, h
        if len(ties):  # equal to the end: by position
            rank, _ = self._refined(rank[ties] * (n + 2) + ties, ties, rank)
        return rank, part, part_h

    @staticmethod
    def _refined(key: np.ndarray, rows: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Refines the ranks of ``rows`` (tied ones) by ``key``, which sorts by their ranks first; a rank is the number of
        suffixes below. Also the rows still tied."""
        order = np.argsort(key)
        key, rows = key[order], rows[order]
        old = rank[rows]
        at = np.arange(len(rows))
        part = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], old[1:] != old[:-1]])
        rank = rank.copy()
        rank[rows] = old + np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        return rank, rows[~(part & np.concatenate([part[1:], [True]]))]

    def repeats(self) -> list[np.ndarray]:
        """Per string, the offsets whose ``depth`` bytes also start at a smaller text position (an earlier string, or earlier in
        the same one): all strings are streamed through the index together, one byte to the left per step."""
        m = len(self.size)
        order = np.argsort(-self.size, kind="stable")
        size, end = self.size[order], self.end[order]
        row = order.copy()  # the suffix that is string j's separator is the j-th smallest
        found: list[tuple[np.ndarray, np.ndarray]] = []
        live = m
        for step in range(1, int(size[0]) + 1 if m else 0):
            while live and size[live - 1] < step:
                live -= 1
            run = np.searchsorted(self.run_start, row[:live], side="right") - 1
            row[:live] += self.run_target[run] - self.run_start[run]
            if step >= self.depth:
                interval = np.searchsorted(self.interval_start, row[:live], side="right") - 1
                at = end[:live] - step
                hit = np.nonzero(self.interval_first[interval] < at)[0]
                if len(hit):
                    found.append((order[hit], size[hit] - step))
        out = [np.empty(0, np.int64)] * m
        if found:
            which, offset = np.concatenate([w for w, _ in found]), np.concatenate([o for _, o in found])
            by = np.lexsort((offset, which))
            which, offset = which[by], offset[by]
            cut = np.nonzero(np.concatenate([[True], which[1:] != which[:-1]]))[0]
            for j, part in zip(which[cut].tolist(), np.split(offset, cut[1:]), strict=True):
                out[j] = part
        return out
