"""A bounded memo of token runs, kept as flat arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

#: What a word in the memo takes beside its bytes and its tokens.
ENTRY_BYTES = 200


class Runs:
    """Runs of tokens by key: keys are numbered, their runs lie in one array.

    `runs_of` gives the joined runs of new keys, the length of each, and a
    weight of each. Keys of many texts are asked for at once, so that the
    tokeniser works on large calls. The memo is emptied before a call if it
    holds more than `most` bytes; a call's own keys are always held.
    """

    def __init__(
        self,
        runs_of: Callable[[list], tuple[np.ndarray, np.ndarray, np.ndarray]],
        most: int,
    ) -> None:
        self.runs_of = runs_of
        self.most = most
        self._empty()

    def _empty(self) -> None:
        self.number: dict = {}
        self.held = 0
        self.flat = np.empty(0, np.uint32)
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)
        self.weight = np.empty(0, np.int64)

    def numbers(self, texts: Sequence[Sequence]) -> list[np.ndarray]:
        """Number of each key of each text; valid until the next call."""
        if self.held > self.most:
            self._empty()
        number = self.number
        new = list(set(chain.from_iterable(texts)).difference(number))
        if new:
            flat, length, weight = self.runs_of(new)
            number.update(zip(new, range(len(number), len(number) + len(new))))
            start = len(self.flat) + np.cumsum(length) - length
            self.flat = np.concatenate([self.flat, flat])
            self.start = np.concatenate([self.start, start])
            self.length = np.concatenate([self.length, length])
            self.weight = np.concatenate([self.weight, weight])
            self.held += sum(map(len, new)) + 4 * len(flat)
            self.held += ENTRY_BYTES * len(new)
        return [
            np.fromiter(map(number.__getitem__, x), np.int64, len(x))
            for x in texts
        ]

    def run(self, numbers: np.ndarray) -> np.ndarray:
        """The runs of these keys, joined."""
        return gather(self.flat, self.start, self.length, numbers)


def gather(
    flat: np.ndarray, start: np.ndarray, length: np.ndarray, at: np.ndarray
) -> np.ndarray:
    """The runs at these places, joined: each has a start and a length."""
    length = length[at]
    ends = np.cumsum(length)
    shift = start[at] - ends + length
    return flat[
        np.repeat(shift, length) + np.arange(ends[-1] if len(ends) else 0)
    ]


def cut_at(sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many tokens lie before each of these byte ends, ascending, for
    tokens of these sizes in bytes; each end has to be the end of a token."""
    reached = np.cumsum(sizes)
    cuts = np.searchsorted(reached, ends) + 1
    if not np.array_equal(reached[cuts - 1], ends):
        raise AssertionError("a token crosses two chunks")
    return cuts
