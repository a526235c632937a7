"""Token patterns over tag letters, all matches narrowed to the longest, in time near linear in the sentence.

A pattern is a sequence of atoms (a tag or a set of tags, with ``?``, ``*`` or
``+``).  Its positions are the bits of a mask (Glushkov's automaton: no empty
steps): the tags a position takes, the positions that may follow it, those that may
begin and those that may end a match are masks, so one step over a tag is a few
bit operations.

Of all matches the longest stays, then the earliest, then the next longest that
meets none kept.  One pass from the right finds the longest match from every
start; these wait in a queue by length.  A match that runs into a kept one is cut
back to its longest match before it and waits again; a start inside a
kept match is given up.  The matches themselves, of which there may be a square of the
sentence, are never listed.
"""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class TagPattern:
    """A pattern as ``relations.pattern_regex`` writes it: letters or [letters], each with ``?``, ``*``, ``+`` or nothing."""

    def __init__(self, regex: str):
        body = regex.removeprefix("^")
        atoms = re.findall(r"(\[\w+\]|\w)([?*+]?)", body)
        if "".join(a + op for a, op in atoms) != body:
            raise ValueError(f"not a tag pattern: {regex}")
        n = len(atoms)
        self.takes: dict[str, int] = {}
        for p, (a, _) in enumerate(atoms):
            for letter in a.strip("[]"):
                self.takes[letter] = self.takes.get(letter, 0) | 1 << p
        optional = [op in ("?", "*") for _, op in atoms]

        def reach(p):
            """Positions that can come next when all before ``p`` are done."""
            mask = 0
            while p < n:
                mask |= 1 << p
                if not optional[p]:
                    break
                p += 1
            return mask

        self.first = reach(0)
        self.follow = [reach(p + 1) | (1 << p if op in ("*", "+") else 0) for p, (_, op) in enumerate(atoms)]
        self.last = sum(1 << p for p in range(n) if all(optional[p + 1:]))
        self.after: dict[int, int] = {0: 0}

    def next(self, state: int) -> int:
        """Positions that may follow any of ``state``; kept once worked out."""
        if state not in self.after:
            self.after[state] = _union(self.follow, state)
        return self.after[state]

    def longest(self, tags: str) -> list[int]:
        """For every start the end of the longest match from there, or the start itself where there is none."""
        n, last = len(self.follow), self.last
        followers = [_bits(m) for m in self.follow]
        begin = _bits(self.first)
        far = [-1] * n  # furthest end once position p has taken the tag before
        out = [0] * len(tags)
        for i in range(len(tags) - 1, -1, -1):
            # far[p] belongs to the tags from i + 1 on; here: position q takes tag i
            taken = self.takes.get(tags[i], 0)
            here = [-1] * n
            for q in range(n):
                if taken >> q & 1:
                    best = i + 1 if last >> q & 1 else -1
                    for r in followers[q]:
                        if far[r] > best:
                            best = far[r]
                    here[q] = best
            out[i] = max([here[q] for q in begin] + [i])
            far = here
        return out

    def longest_before(self, tags: str, start: int, stop: int) -> int:
        """The end of the longest match from ``start`` that does not pass ``stop``, or ``start``."""
        end, state = start, self.first
        for i in range(start, stop):
            state &= self.takes.get(tags[i], 0)
            if not state:
                break
            if state & self.last:
                end = i + 1
            state = self.next(state)
        return end

    def spans(self, tags: str) -> list[tuple[int, int]]:
        """(start, length) of the matches that stay, in order."""
        queue = [(i - e, i) for i, e in enumerate(self.longest(tags)) if e > i]
        heapq.heapify(queue)
        taken, kept = bytearray(len(tags)), []
        while queue:
            size, start = heapq.heappop(queue)
            end = start - size
            if taken[start]:
                continue
            wall = taken.find(1, start, end)
            if wall >= 0:
                end = self.longest_before(tags, start, wall)
                if end > start:
                    heapq.heappush(queue, (start - end, start))
                continue
            taken[start:end] = b"\1" * (end - start)
            kept.append((start, end - start))
        return sorted(kept)


def _bits(mask: int) -> list[int]:
    return [p for p in range(mask.bit_length()) if mask >> p & 1]


def _union(masks: list[int], state: int) -> int:
    out = 0
    for p in _bits(state):
        out |= masks[p]
    return out


def pattern_spans(pos: Column, regex: str) -> Column:
    """array<struct<start, len>> of the matches of ``regex`` in each string of tag letters; null counts as empty."""
    @F.pandas_udf("array<struct<start:int,len:int>>")
    def match(tags: pd.Series) -> pd.Series:
        pattern = TagPattern(regex)
        return pd.Series([[{"start": s, "len": n} for s, n in pattern.spans(t or "")] for t in tags], dtype=object)

    return match(pos)
