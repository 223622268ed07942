"""Chunks of a text that byte-level BPE encodes independently.

The public split pattern never lets a match run from a character into a space
after it, and always starts a match at a space before a character that is no
white space. So a text can be cut before each such space, and each chunk has
the same tokens alone as in its place. Chunks repeat often, so their tokens
are kept in a bounded memo.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

#: \S of `re` is a subset of the pattern's \S, so each cut here is safe.
CUT = re.compile(r" (?=\S)")
UNCUT = re.compile(r" (?!\S)")
LONGEST_KEPT = 64


def chunks(text: str) -> list[str]:
    """All chunks; all but the first have lost the space they start with."""
    if UNCUT.search(text):
        return CUT.split(text)
    return text.split(" ")  # the same, faster


def safe(stem: str) -> bool:
    """Letters only, of blocks whose classes no Unicode version changes."""
    return stem.isalpha() and max(stem) < "\u0530"


class Memo:
    """Values of chunks; emptied when it holds `most` entries.

    Values must be sequences that can be added.
    """

    def __init__(
        self,
        values_of: Callable[[list[str]], Iterable],
        most: int = 900_000,
    ) -> None:
        self.values_of = values_of
        self.most = most
        self.kept: dict[str, object] = {}
        self.ends: dict[str, object] = {}

    def of(self, text: str) -> list:
        """The values of a text's chunks, in order."""
        parts = chunks(text)
        first, rest = parts[0], parts[1:]
        kept = self.kept
        if len(kept) > self.most:
            kept.clear()
        missing = set(rest).difference(kept)
        # letters and the stops after them are separate matches
        stems = {p: s for p in missing if safe(s := p.rstrip(".,"))}
        wanted = missing.difference(stems)
        wanted.update(s for s in stems.values() if s not in kept)
        ends = {p[len(s) :] for p, s in stems.items() if p != s}
        ends = list(ends.difference(self.ends))
        wanted = list(wanted)
        values = iter(
            self.values_of([first, *ends, *[f" {p}" for p in wanted]])
        )
        head = next(values)
        self.ends.update(zip(ends, values, strict=False))
        kept.update(zip(wanted, values, strict=True))
        for p, s in stems.items():
            if p != s:
                kept[p] = kept[s] + self.ends[p[len(s) :]]
        out = [head, *map(kept.__getitem__, rest)]
        for p in missing.union(wanted):
            if len(p) > LONGEST_KEPT:
                del kept[p]
        if len(self.ends) > 10_000:
            self.ends.clear()
        return out
