"""Substring dedup, Jaccard join, neighbours, toxicity, and the pipeline."""

import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from proclivity.llm import (
    chosen_path,
    common,
    multiprobe,
    substring_dedup,
    toxicity,
)
from proclivity.llm.queries import QUERIES
from proclivity.llm.shingles import shingle_set

SF = "/root/testdata/sf0.001"
N = substring_dedup.WINDOW


def some_words(draws, n, most=3000):
    return [f"w{x}" for x in draws.integers(0, most, n)]


def removed(texts):
    """(words, removed, kept) of each text, by comparing all windows."""
    found = [(t or "").encode().split() for t in texts]
    seen = Counter(
        tuple(w[i : i + N]) for w in found for i in range(len(w) - N + 1)
    )
    out = []
    for w in found:
        gone = set()
        for i in range(len(w) - N + 1):
            if seen[tuple(w[i : i + N])] > 1:
                gone.update(range(i, i + N))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), kept.decode()))
    return out


@pytest.fixture(scope="module")
def passages(spark):
    """Shared passages of 34 to 200 words at the ends and inside, periodic
    texts, copies, and passages that differ in one word."""
    draws = np.random.default_rng(8)
    shared = [some_words(draws, int(n)) for n in (34, 35, 36, 60, 90, 200)]
    texts = []
    for i in range(120):
        own = some_words(draws, int(draws.integers(0, 150)))
        p = list(shared[i % 6])
        if i % 5 == 0:
            p[int(draws.integers(0, len(p)))] = "changed"
        cut = int(draws.integers(0, len(own) + 1)) if i % 3 else 0
        texts.append(" ".join(own[:cut] + p + own[cut:]))
    texts += [texts[7]] * 4 + ["a " * 34, "a " * 35, "a " * 36, "b c " * 60]
    texts += [" ".join(["x"] * 20 + shared[3][:40]), "\x1c".join("ab" * 40)]
    return texts


def test_repeats_equal_brute_force(spark, passages, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_RUNS", 100)
    docs = spark.createDataFrame(
        list(enumerate(passages)), "doc_id long, text string"
    )
    rows = substring_dedup.remove_repeats(docs).orderBy("doc_id").collect()
    got = [(r.n_words, r.n_removed, r.kept) for r in rows]
    assert got == removed(passages)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=N, max_size=120))
def test_runs_cover_all_windows_and_hold_their_anchor(parts):
    found = [p.encode() for p in parts]
    _, _, first, n, at, windows = substring_dedup.runs_in(found)
    assert list(first) == list(np.cumsum(n) - n)
    assert n.sum() == len(windows) == len(found) - N + 1
    assert ((at >= first + n - 1) & (at + substring_dedup.PHRASE <= first + N)).all()


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = substring_dedup.remove_repeats(odd_docs).collect()
    source = odd_docs.collect()
    texts = [r.text for r in source]
    want = Counter(
        (r.doc_id, *x) for r, x in zip(source, removed(texts), strict=True)
    )
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows) == want
    done = substring_dedup.without_repeats(odd_docs)
    assert done.columns == odd_docs.columns
    assert done.count() == len(source)
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_repeats_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = {r.doc_id: r for r in QUERIES["op1_substring_dedup"](spark, SF).collect()}
    for d, (n, gone, kept) in zip(docs, removed([d.text for d in docs]), strict=True):
        r = rows[d.doc_id]
        digest = hashlib.sha256(kept.encode()).hexdigest()
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, digest)


def test_shards_hold_only_what_has_passages(spark, monkeypatch, tmp_path):
    """Short texts and repeated rows form no group: shards see few bytes."""
    seen = tmp_path / "rows"
    plain = substring_dedup._cleaned

    def spy(docs, passages, fields):
        with open(seen, "a") as out:
            out.write(f"{docs.num_rows}\n")
        return plain(docs, passages, fields)

    monkeypatch.setattr(substring_dedup, "_cleaned", spy)
    draws = np.random.default_rng(10)
    shared = some_words(draws, 50)
    texts = [" ".join(some_words(draws, 5)) for _ in range(500)]
    texts += [" ".join(some_words(draws, 60)) for _ in range(20)]
    texts += [" ".join(shared + some_words(draws, 9)) for _ in range(6)]
    rows = list(enumerate(texts)) + [(None, " ".join(shared + ["end"]))] * 80
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs).collect()
    want = [
        (i, *x) for (i, _), x in zip(rows, removed([t for _, t in rows]), strict=True)
    ]
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == Counter(want)
    assert sum(map(int, seen.read_text().split())) == 6


def linked(texts, least=0.8):
    """Links of distinct shingle sets, and components, by all pairs."""
    sets = [frozenset(shingle_set(t).tolist()) for t in texts]
    kinds = list(dict.fromkeys(sets))
    links, up = Counter(), {k: k for k in kinds}

    def root(k):
        while up[k] is not k:
            k = up[k]
        return k

    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            if a and b and len(a & b) >= least * len(a | b):
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    return [(links[s], root(s)) for s in sets]


def check_join(rows, ids, texts):
    want = linked(texts)
    least = defaultdict(lambda: None)
    for i, (_, r) in zip(ids, want, strict=True):
        if i is not None:
            least[r] = i if least[r] is None else min(i, least[r])
    expected = Counter(
        (i, least[r], n) for i, (n, r) in zip(ids, want, strict=True)
    )
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in rows) == expected


@pytest.fixture(scope="module")
def near(spark):
    """A large group of near copies, small ones, and short texts."""
    draws = np.random.default_rng(4)
    base = some_words(draws, 200)
    texts = []
    for _ in range(60):
        w = list(base)
        for at in draws.integers(0, 200, 2):
            w[at] = f"z{draws.integers(0, 9)}"
        texts.append(" ".join(w))
    for _ in range(25):
        w = some_words(draws, 150)
        texts.append(" ".join(w))
        w[int(draws.integers(0, 150))] = "other"
        texts += [" ".join(w)] * int(draws.integers(1, 3))
    texts += ["a b c", "a b c", "a b c d", "a b c d e f", "a b c d e f g", "", " "]
    return texts


@pytest.mark.parametrize(("small", "block"), [(500, 1000), (8, 16)])
def test_join_equals_all_pairs(spark, near, monkeypatch, small, block):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    docs = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    check_join(chosen_path.join(docs).collect(), range(len(near)), near)


@pytest.mark.parametrize("whole", [8, 40])
def test_join_by_levels_of_rows(spark, near, monkeypatch, whole):
    """Buckets that no task holds are split by passes over rows."""
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    monkeypatch.setattr(chosen_path, "WHOLE", whole)
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    docs = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    check_join(chosen_path.join(docs).collect(), range(len(near)), near)


def test_buckets_of_one_task_are_split_there(spark, near, monkeypatch):
    """No level of a bucket that a task can hold becomes rows."""
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    monkeypatch.delattr(chosen_path, "led")
    docs = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    check_join(chosen_path.join(docs).collect(), range(len(near)), near)


@pytest.mark.parametrize("small", [8, 1000])
def test_a_bucket_equals_all_pairs(small):
    """Groups of sketches around some centres, and sketches alone."""
    draws = np.random.default_rng(5)
    wide = chosen_path.COORDINATES
    centres = draws.integers(0, 1 << 32, (20, wide), np.uint32)
    sigs = np.concatenate([np.repeat(centres, 15, 0), centres[:1].repeat(90, 0)])
    at = draws.random(sigs.shape) < 0.1
    sigs[at] = draws.integers(0, 1 << 32, int(at.sum()), np.uint32)
    sigs[:, 0] = 7  # all meet, so the root splits nothing off
    recs = draws.permutation(len(sigs)).astype(np.int64)
    recs.sort()
    least = (0.8 - chosen_path.SLACK) * wide
    want = chosen_path.Forest(len(sigs))
    for i, x in enumerate(sigs):
        for j in np.flatnonzero((sigs == x).sum(1) >= least):
            want.join(i, int(j))
    got = chosen_path.Forest(len(sigs))
    for run in range(1, 29 if small < 1000 else 2):
        bucket = chosen_path.Bucket(recs, sigs, 0.8, small)
        bucket.settle(np.arange(len(recs)), chosen_path.mix(np.array([run], np.uint64))[0], 1)
        for u, v in zip(*bucket.edges().values(), strict=True):
            assert v < u
            got.join(int(u), int(v))
    assert [got.root(i) for i in recs] == [want.root(i) for i in recs]


def test_join_of_odd_rows(odd_docs, no_docs):
    source = odd_docs.collect()
    rows = chosen_path.join(odd_docs).collect()
    check_join(rows, [r.doc_id for r in source], [r.text for r in source])
    kept = chosen_path.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(
        (r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)
    ) == [1, 4, 5, 6, None]
    assert chosen_path.join(no_docs).count() == 0
    assert chosen_path.deduplicated(no_docs).count() == 0


def test_runs_reach_the_target():
    assert chosen_path.survival(1.0, 6) == 1.0
    p = chosen_path.survival(0.8, chosen_path.DEPTH)
    runs = chosen_path.runs_for(0.8)
    assert 1 - (1 - p) ** runs >= chosen_path.TARGET


@pytest.mark.parametrize("depth", [1, chosen_path.DEPTH])
def test_no_pair_at_the_least_similarity_is_lost(depth):
    """Sketches of 20,000 pairs of similarity 0.8, through the trees of all
    runs: each pair must meet and pass the sketches."""
    draws = np.random.default_rng(12)
    shape = (20_000, chosen_path.COORDINATES)
    left = draws.integers(0, 1 << 32, shape, np.uint32)
    same = draws.random(shape) < 0.8
    right = np.where(same, left, left ^ np.uint32(1))
    least = (0.8 - chosen_path.SLACK) * chosen_path.COORDINATES
    open_ = np.flatnonzero(np.ones(len(left), bool))
    for run in range(1, chosen_path.runs_for(0.8) + 1):
        at = open_
        seed = chosen_path.mix(np.array([run], np.uint64) * chosen_path.STEP)
        paths = np.repeat(seed, len(at))
        for _ in range(depth):
            ways = zip(
                chosen_path.children(paths, left[at], 0.8),
                chosen_path.children(paths, right[at], 0.8),
                strict=True,
            )
            kept = [(at[r], p, p == q) for (r, p), (_, q) in ways]
            at = np.concatenate([r[m] for r, _, m in kept])
            paths = np.concatenate([p[m] for _, p, m in kept])
        open_ = np.setdiff1d(open_, at)
    lost = np.union1d(open_, np.flatnonzero(same.sum(1) < least))
    assert len(lost) <= 2


def test_components(spark):
    draws = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(0, 300) if i % 50 != 49]
    pairs += [(1000, int(x)) for x in draws.integers(1001, 1200, 150)]
    edges = spark.createDataFrame(
        [p[:: int(draws.choice([1, -1]))] for p in pairs], "u long, v long"
    )
    got = {r.node: r.root for r in common.components(edges).collect()}
    assert got == {
        x: (x // 50 * 50 if x < 1000 else 1000) for p in pairs for x in p
    }


def brute(vectors, every, k):
    ids = np.array([i for i, _ in vectors])
    rows = np.array([v for _, v in vectors], float)
    norm = np.sqrt((rows * rows).sum(1))
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = (rows * rows[q]).sum(1) / (norm * norm[q])
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]]
        out[int(ids[q])] = [(int(ids[i]), score[i]) for i in order[:k]]
    return out


VECTORS = "vec_id long, embedding array<float>"


def test_neighbours_recall(spark):
    draws = np.random.default_rng(6)
    centres = draws.normal(size=(40, 32))
    rows = centres[draws.integers(0, 40, 2000)] + 0.5 * draws.normal(size=(2000, 32))
    rows = rows.astype(np.float32)
    vectors = [(i, r.tolist()) for i, r in enumerate(rows)]
    # a common vector, whose copies are ties
    vectors += [(i, vectors[50][1]) for i in range(2000, 2400)]
    found = defaultdict(list)
    frame = spark.createDataFrame(vectors, VECTORS)
    for r in multiprobe.nearest(frame).orderBy("query_id", "rank").collect():
        assert r.rank == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    want = brute(vectors, 50, 5)
    assert found.keys() == want.keys()
    hits = sum(
        len({x for x, _ in found[q]} & {x for x, _ in want[q]}) for q in want
    )
    assert hits >= 0.9 * 5 * len(want)
    assert [x for x, _ in found[50]] == [2000, 2001, 2002, 2003, 2004]
    for q, pairs in found.items():
        best = dict(brute(vectors, 50, len(vectors))[q]) if q == 50 else None
        for x, score in pairs if best else []:
            assert score == best[x]


@pytest.mark.parametrize("operator", ["remove", "without", "dedup"])
def test_columns_may_have_any_name(spark, passages, operator):
    """Values of columns named as the operators' own stay as they are."""
    names = (
        "_rows _x _shard _copies _row _own _key1 _key2 _id _t1 _t2 _rec _root "
        "_anchor _run _place _mask _count kept_ _first"
    ).split()
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(passages[:30])]
    fields = ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {fields}")
    run = {
        "remove": substring_dedup.remove_repeats,
        "without": substring_dedup.without_repeats,
        "dedup": chosen_path.deduplicated,
    }[operator]
    out, plain = run(docs), run(docs.select("doc_id", "text"))
    assert out.columns[: len(docs.columns)] == docs.columns
    for r in out.collect():
        assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names]
    assert sorted(out.select(*plain.columns).collect()) == sorted(plain.collect())


def neighbours(spark, vectors, **settings):
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    rows = multiprobe.nearest(frame, **settings)
    for r in rows.orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    return found


@pytest.mark.parametrize("block", [multiprobe.BLOCK, 90])
def test_a_query_that_meets_nothing_is_answered(spark, monkeypatch, block):
    """One query opposite to a cluster, beside a query inside it."""
    monkeypatch.setattr(multiprobe, "BLOCK", block)
    draws = np.random.default_rng(9)
    cluster = 5 + 0.05 * draws.normal(size=(588, 24))
    vectors = [(i + 1, r.tolist()) for i, r in enumerate(cluster)]
    vectors += [(0, [-5.0] * 24), (1000, [5.0] * 24)]
    found, want = neighbours(spark, vectors, every=1000), brute(vectors, 1000, 5)
    assert {q: [x for x, _ in r] for q, r in found.items()} == {
        q: [x for x, _ in r] for q, r in want.items()
    }
    # fewer candidates than asked for: all of them
    assert len(neighbours(spark, vectors[:2] + vectors[-2:], every=1000)[0]) == 3


def test_scaled_copies_tie_by_id(spark):
    """All cosines are 1: the smaller ids win, however many copies tie."""
    draws = np.random.default_rng(4)
    one = draws.normal(size=16)
    vectors = [(i, (one * 2.0 ** (i % 39 - 19)).tolist()) for i in range(39)]
    vectors += [(i, draws.normal(size=16).tolist()) for i in range(40, 140)]
    found = neighbours(spark, vectors, every=500)
    assert found[0] == [(i, found[0][0][1]) for i in range(1, 6)]


def test_no_number_of_buckets_reaches_the_target(spark, monkeypatch):
    monkeypatch.setattr(multiprobe, "PROBES", (1,))
    draws = np.random.default_rng(2)
    vectors = [(i, r.tolist()) for i, r in enumerate(draws.normal(size=(300, 20)))]
    found, want = neighbours(spark, vectors), brute(vectors, 50, 5)
    assert {q: [x for x, _ in r] for q, r in found.items()} == {
        q: [x for x, _ in r] for q, r in want.items()
    }


def test_queries_of_a_group_are_bounded(spark, monkeypatch, tmp_path):
    """Small parts of queries give the same rows, and no group has many."""
    draws = np.random.default_rng(13)
    vectors = [(i, r.tolist()) for i, r in enumerate(draws.normal(size=(400, 8)))]
    frame = spark.createDataFrame(vectors, VECTORS)
    seen, plain = tmp_path / "queries", multiprobe.best_in_block

    def spy(rows, asked, k):
        with open(seen, "a") as out:
            out.write(f"{len(asked)}\n")
        return plain(rows, asked, k)

    want = sorted(map(tuple, multiprobe.nearest(frame, every=2).collect()))
    monkeypatch.setattr(multiprobe, "best_in_block", spy)
    monkeypatch.setattr(multiprobe, "ASKED", 2_000, raising=False)
    got = sorted(map(tuple, multiprobe.nearest(frame, every=2).collect()))
    assert got == want
    sizes = list(map(int, seen.read_text().split()))
    assert sum(sizes) >= 200 and max(sizes) < 100


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None),
        (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]),
        (50, [1.0, 0.0]), (50, [1.0, 0.0]), (100, [0.0, 0.0]),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], f"{VECTORS}, score int")
    got = [tuple(r) for r in multiprobe.nearest(frame).collect()]
    assert sorted(got) == [
        (0, 1, 1, 1.0), (0, 2, 50, 1.0), (0, 3, 2, 0.0),
        (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 0.0),
    ]
    assert multiprobe.nearest(frame.limit(0)).count() == 0


def test_steps_come_in_order_of_cost():
    sets = multiprobe.steps(200)
    m = multiprobe.FUNCTIONS
    assert sets[0] == ()
    assert len(set(sets)) == 200
    for ranks in sets:
        assert not {2 * m + 1 - j for j in ranks} & set(ranks)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS = [
    toxicity.Term("abca", False, 1.0),
    toxicity.Term("bacab", False, 2.0),
    toxicity.Term("abcabcabc", False, 3.0),
    toxicity.Term("ccba", True, 4.0),
]
TRIE = toxicity.FuzzyTrie(TERMS)


@settings(max_examples=500, deadline=None)
@given(st.text("abcd", max_size=12))
def test_fuzzy_trie_equals_edit_distance(word):
    found = []
    for term in TERMS:
        allowed = 0 if len(term.text) < 5 else 1 if len(term.text) < 9 else 2
        if term.stem:
            if word.startswith(term.text):
                found.append((0, -term.weight))
        elif (n := edits(word, term.text)) <= allowed:
            found.append((n, -term.weight))
    got = TRIE.match(word)
    assert (got and (got[0], -got[1])) == (min(found) if found else None)


def test_quotation_is_told_from_abuse():
    scanner = toxicity.Scanner([toxicity.Term("moron", False, 2.0)])
    abuse = scanner.features("you are such a moron, really")
    typo = scanner.features("you are such a mor0n and a morron")
    quote = scanner.features('he was called "moron" by them')
    assert abuse[0] > 0 and not abuse[2]
    assert typo[1] > 0 and not typo[0]
    assert quote[2] > 0 and not quote[0]


@pytest.fixture(scope="module")
def labelled(spark):
    draws = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(900):
        w = some_words(draws, 60)
        w = [x.replace("w", "tok") + "abcdefghij"[int(x[1:]) % 10] * 3 for x in w]
        toxic = i % 5 == 0
        if toxic:
            for at in draws.integers(0, 60, 4):
                w[at] = draws.choice(["blorgh", "snarfle", "zuk" + w[0][-3:] + "it"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5, None, None), (10_000, 1, 1)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_on_held_out_rows(labelled):
    rows = toxicity.rate(*labelled).collect()
    assert len(rows) == 900
    out = [r for r in rows if r.held_out]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in out)
    assert right >= 0.95 * len(out)


def test_toxicity_of_odd_rows(spark, labelled, odd_docs, no_docs):
    model = toxicity.fit(*labelled)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.predicted == 0 for r in rows)
    none = labelled[1].limit(0)
    assert toxicity.rate(no_docs, none).count() == 0
    assert {r.predicted for r in toxicity.rate(odd_docs, none).collect()} == {0}
    kept = toxicity.accepted(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == len(rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = corpus_pipeline.run(spark, SF).collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "toxicity", "near_duplicates", "repeated_passages", "packing",
    ]
    kept = {r.doc_id for r in rows}
    verdict = {
        r.doc_id for r in QUERIES["op4_fertility"](spark, SF).collect() if r.kept
    }
    assert kept and kept <= verdict < {r.doc_id for r in docs.collect()}
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048


def staged_columns(folder):
    """Columns of each table that was staged, by its label."""
    return {
        path.name.rsplit("-", 1)[0]: pq.read_schema(next(path.glob("*.parquet"))).names
        for path in folder.iterdir()
        if next(path.glob("*.parquet"), None)
    }


@pytest.fixture
def shared(spark, tmp_path):
    """A shared folder of this test's own."""
    context = spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(str(tmp_path))
    yield Path(context.getCheckpointDir().removeprefix("file:"))
    if before:
        context.setCheckpointDir(before)


def some_texts(spark):
    """Texts alone, near copies of one, copies, and a null."""
    alone = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(30)]
    near = [alone[0] + f" end{i}" for i in range(5)]
    texts = [*alone, *near, near[0], None]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_texts_are_not_staged_again(spark, shared):
    """Repeats are cut without a second copy of all texts."""
    done = substring_dedup.remove_repeats(some_texts(spark)).collect()
    gone = {r.doc_id: r.n_removed for r in done}
    assert {i for i, n in gone.items() if n} == {0, *range(30, 36)}
    assert gone[30] == gone[35] == 61 and gone[31] == 60
    assert not [x for x in staged_columns(shared).values() if "text" in x]


def test_sets_of_what_meets_nothing_are_not_kept(spark, shared, monkeypatch):
    """Sets are only made of records that meet; components are few rounds."""
    made = []
    monkeypatch.setattr(
        chosen_path, "components", lambda x, f=chosen_path.components: made.append(1) or f(x)
    )
    monkeypatch.setattr(chosen_path, "SMALL", 2)
    done = chosen_path.join(some_texts(spark)).collect()
    assert {r.doc_id for r in done if r.n_links} == {0, *range(30, 36)}
    assert {r.class_id for r in done if r.n_links} == {0}
    assert not [x for x in staged_columns(shared).values() if "_set" in x]
    assert len(made) <= 5


def test_a_mask_keeps_all_that_is_wanted(spark):
    rows = spark.range(20_000)
    mask = common.mask_of(rows.where("id % 40 = 0"), "id")
    kept = common.among(rows, "id", mask)
    assert kept.where("id % 40 = 0").count() == 500
    assert kept.count() < 600
    rest = common.among(rows, "id", mask, "left_anti")
    assert rest.count() + kept.count() == 20_000
