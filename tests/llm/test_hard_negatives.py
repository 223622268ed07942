"""Hard negatives against a comparison of all rows."""

import heapq

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from proclivity.llm import hard_negatives
from proclivity.llm.queries import ORACLES, QUERIES
from tests.compare import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100):
    """(anchor, positive, rank, negative, scores), by all pairs."""
    rows = [
        (i, (y + 1) % 10 if i % 7 == 0 else y, [int(np.floor(256 * c)) for c in x])
        for i, x, y in rows
    ]
    out = []
    for i, y, x in rows:
        if i % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(x, v, strict=True)), j, z)
            for j, z, v in rows
            if j != i
        )
        for p, j, _ in [r for r in scored if r[2] == y][:5]:
            low, high = 30 * -p, 90 * -p
            fits = [r for r in scored if r[2] != y and low <= 100 * -r[0] <= high]
            out += [
                (i, j, n, k, -p, -s) for n, (s, k, _) in enumerate(fits[:10], 1)
            ]
    return sorted(out)


def mined(df, **settings):
    return sorted(tuple(r) for r in hard_negatives.mine(df, **settings).collect())


def vectors(kind, n=400, dim=9):
    draws = np.random.default_rng(5)
    x = draws.normal(size=(n, dim))
    if kind == "clusters":
        x = draws.normal(size=(8, dim))[draws.integers(0, 8, n)] * 2 + x / 8
    elif kind == "copies":
        x[n // 3 :] = x[0]  # most rows are one vector, of all labels
    elif kind == "ties":
        x = draws.integers(-1, 2, (n, dim)) / 16
    ids = draws.permutation(n * 2)[:n]
    labels = draws.integers(0, 4, n)
    return [
        (int(i), [float(c) for c in v], int(y))
        for i, v, y in zip(ids, x, labels, strict=True)
    ]


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "ties"])
def test_equals_brute_force(spark, kind, monkeypatch):
    # many small blocks, query parts and first visits
    monkeypatch.setattr(hard_negatives, "BLOCK", 300)
    monkeypatch.setattr(hard_negatives, "ASKED", 60)
    monkeypatch.setattr(hard_negatives, "FIRST", 40)
    rows = vectors(kind)
    got = mined(spark.createDataFrame(rows, SCHEMA), every=20)
    assert got == brute(rows, 20) and got


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.integers(-20, 20), max_size=8),
    st.lists(st.integers(-20, 20), max_size=8),
)
def test_heap_yields_all_sums_in_order(one, two):
    found = list(
        hard_negatives.multi_sequence(np.array(one, float), np.array(two, float))
    )
    assert {(i, j) for _, i, j in found} == {
        (i, j) for i in range(len(one)) for j in range(len(two))
    }
    assert len(found) == len(one) * len(two)
    assert all(total == one[i] + two[j] for total, i, j in found)
    sums = [total for total, *_ in found]
    assert sums == heapq.nlargest(len(sums), sums)


def test_bounds_hold():
    draws = np.random.default_rng(2)
    points = draws.normal(size=(500, 6)) * 300
    words = hard_negatives.codebook(points)
    near = hard_negatives._nearest(points, words)
    far = np.zeros(len(words))
    np.maximum.at(far, near, np.sqrt(((points - words[near]) ** 2).sum(1)))
    for query in draws.normal(size=(20, 6)) * 300:
        assert (points @ query <= hard_negatives.bounds(query, words, far)[near]).all()


def test_far_cells_are_not_visited(spark, monkeypatch):
    """Blocks out of reach of a window are pruned, by floor and from above."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 60)
    monkeypatch.setattr(hard_negatives, "FIRST", 10)
    rows = vectors("clusters", 400, 6)
    known = hard_negatives.usable(spark.createDataFrame(rows, SCHEMA))
    classes = hard_negatives.classes_of(known, 11)
    fitted = hard_negatives._fitted(classes)
    index = hard_negatives.index_of(hard_negatives.placed(classes, *fitted), *fitted)
    blocks = {b for r in index.blocks.values() for b in r}
    query = np.floor(256 * np.array(rows[0][1]))
    best = int(query @ query)
    first, rest = hard_negatives.visited(index, query, best * 3 // 4, best)
    assert 0 < len(first) + len(rest) < len(blocks) / 2


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors("spread", 60, 4)
    odd = [
        (None, [1.0] * 4, 1), (1000, None, 1), (1001, [1.0, None, 1.0, 1.0], 1),
        (1002, [nan] * 4, 1), (1003, [inf, 0.0, 0.0, 0.0], 1), (1004, [1.0] * 4, None),
        (1005, [], 1), (1006, [1.0] * 3, 2), (1100, [0.0] * 4, 1),
    ]
    df = spark.createDataFrame(rows + odd + rows[:9], SCHEMA)
    for name in ("_vec", "_w", "score", "anchor_id", "rank", "_block", "_one"):
        df = df.selectExpr("*", f"'x' AS {name}")
    want = brute([*rows, (1100, [0.0] * 4, 1)], 5)
    assert mined(df, every=5) == want
    assert mined(df.limit(0)) == []
    assert mined(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)) == []
    big = [(i, [1e6 + i, 2e6 - i, 3.0 * i], i % 3) for i in range(40)]
    assert mined(spark.createDataFrame(big, SCHEMA), every=10) == brute(big, 10)


def test_query_equals_sql(spark):
    rows = spark_rows(QUERIES["op13_hard_negatives"](spark, SF))
    assert rows == duck_rows(connect(SF), ORACLES["op13_hard_negatives"]) and rows[1]
