"""Memo of token runs, and sets as differences from a core."""

import numpy as np
import pytest

from proclivity.llm import chosen_path
from proclivity.llm.chunks import CUT, chunks
from proclivity.llm.runs import Runs, cut_at


def letters(keys):
    flat = [ord(c) for k in keys for c in k]
    size = np.array([len(k) for k in keys], np.int64)
    return np.array(flat, np.uint32), size, size * 2


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_runs_are_those_of_the_keys(most):
    runs = Runs(letters, most)
    for texts in ([["ab", "", "c"], []], [["c", "ab", "c"]], [["d"], ["ab"]]):
        for text, numbers in zip(texts, runs.numbers(texts), strict=True):
            got = "".join(map(chr, runs.run(numbers)))
            assert got == "".join(text)
            assert runs.weight[numbers].sum() == 2 * len(got)


def test_a_token_across_two_chunks_is_an_error():
    assert cut_at(np.array([1, 2, 3]), np.array([3, 6])).tolist() == [2, 3]
    with pytest.raises(AssertionError):
        cut_at(np.array([1, 3, 2]), np.array([3, 6]))


@pytest.mark.parametrize(
    "text", ["", " ", "a b", "a  b", "a \nb c", "a b ", "  x y", " a"]
)
def test_chunks_are_cut_before_a_space_and_a_word(text):
    assert chunks(text) == CUT.split(text)


def test_differences_give_the_intersections():
    rng = np.random.default_rng(5)
    base = np.arange(40)
    sets = [np.empty(0, np.uint32)]
    for _ in range(12):
        kept = base[rng.random(40) < 0.85]
        own = rng.integers(40, 60, 4)
        sets.append(np.unique(np.concatenate([kept, own])).astype(np.uint32))
    owner, number = chosen_path.differences(sets)
    mine = [set(number[owner == i].tolist()) for i in range(len(sets))]
    lacks = [sum(x < 0 for x in m) for m in mine]
    core = len(sets[1]) - (len(mine[1]) - lacks[1]) + lacks[1]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                both = core - lacks[i] - lacks[j] + len(mine[i] & mine[j])
                assert both == len(np.intersect1d(a, b))
