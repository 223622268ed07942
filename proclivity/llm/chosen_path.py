"""Jaccard join of word shingles by chosen paths.

In each of several runs a tree splits the documents: a node draws one or two
minimum-hash coordinates from its path, and a document goes on to the child
of its value there, so documents meet where they share the sampled tokens. A
bucket that is small is compared by brute force over sketches; a large one is
compared with one of its own first, its leader, and split again if what that
joins leaves more than a few others. Similar documents part at each split with
a chance of at most 1 - J, and 1 / J children on average make up for it; runs are repeated until
the chance that a pair of the least similarity never meets, over all that its
minimum hashes can be, is below the target. A bucket that one task can hold is
split there; only of larger ones each level is a pass over rows. A second batch of runs only looks
at buckets whose records the first one has not joined yet. What meets forms components, and in these every pair is compared
again over the whole sets, so links are exact and few are lost.
"""

from __future__ import annotations

from math import comb

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proclivity.llm.common import (
    among,
    components,
    map_batches,
    map_groups,
    mask_of,
    schema,
    staged,
)
from proclivity.llm.shingles import STEP, mix, shingle_set

COORDINATES = 96
#: A bucket up to this size is compared; a larger one is split.
SMALL = 2000
#: A bucket up to this size is split and compared within one task.
WHOLE = 20_000
#: Splits at most; larger buckets are then compared block by block.
DEPTH = 6
#: Chance that a pair of the least similarity meets and passes the sketches,
#: at least, even if its buckets end at DEPTH.
TARGET = 0.99999
#: Runs of the first batch.
FIRST_RUNS = 8
#: Sketches agree on a share this far below the similarity, at least, for
#: the pair to be compared exactly: six standard errors of the estimate.
SLACK = 6 * (0.8 * 0.2 / COORDINATES) ** 0.5
#: Records, and bytes of their sets, of a block of a large component.
BLOCK = 20_000
BLOCK_BYTES = 8 << 20

SIGNED = schema(
    "doc_id long, _t1 long, _t2 long, _rec long, _sig binary, _bytes long"
)
SETS = schema("_rec long, _set binary")
PATHS = schema("_rec long, _path long")
LED = schema(
    "_rec long, _path long, _size long, _lead long, _near boolean,"
    "_first long, _second long"
)
EDGES = schema("u long, v long")
LINKS = schema("_rec long, _to long, _links long")

#: Multipliers of the minimum hashes.
FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * STEP) | (
    np.uint64(1)
)


def survival(
    similarity: float, depth: int, share: float | None = None
) -> float:
    """Chance that a pair meets at that depth of a run whose trees are made for
    this similarity, if its sketches agree on `share` (else: on as much)."""
    share = similarity if share is None else share
    second = min(1.0, 1 / similarity - 1)  # chance of a second coordinate
    p = 1.0
    for _ in range(depth):
        x = share * p
        p = (1 - second) * x + second * (1 - (1 - x) ** 2)
    return p


def missed(similarity: float, depth: int, runs: int) -> float:
    """Chance that a pair of this similarity is missed by all runs.

    All runs draw from the same coordinates, so they are independent only for
    a given number of agreeing ones, which is binomial; a pair with too few
    for the sketches is missed whatever the runs.
    """
    least = (similarity - SLACK) * COORDINATES
    total = 0.0
    for n in range(COORDINATES + 1):
        chance = (
            comb(COORDINATES, n)
            * similarity**n
            * (1 - similarity) ** (COORDINATES - n)
        )
        met_once = survival(similarity, depth, n / COORDINATES)
        total += chance * ((1 - met_once) ** runs if n >= least else 1.0)
    return total


def runs_for(similarity: float, target: float = TARGET) -> int:
    """Runs until a pair is missed with a chance of 1 - target at most, or
    until more of them don't help."""
    floor = missed(similarity, DEPTH, 1 << 40)
    most, runs = max(1 - target, 2 * floor), 1
    while missed(similarity, DEPTH, runs) > most:
        runs += 1
    return runs


def signature(shingles: np.ndarray) -> np.ndarray:
    """Upper halves of the minimum hashes of a set."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None] * FACTORS
        part ^= part >> np.uint64(29)
        part *= STEP
        np.minimum(least, part.min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def signed(docs: DataFrame) -> DataFrame:
    """Each row's ids, its record (equal sets are one), signature, and about
    how many bytes its set takes."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: cols[k] for k in ("doc_id", "_t1", "_t2")}
        sets = [shingle_set(x) for x in cols["text"]]
        out["_rec"] = [
            xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63) for x in sets
        ]
        out["_sig"] = [signature(x).tobytes() for x in sets]
        out["_bytes"] = [4 * len(x) for x in sets]
        return out

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text"),
        F.xxhash64("text").alias("_t1"),
        F.xxhash64(F.lit(1), "text").alias("_t2"),
    )
    return map_batches(rows, run, SIGNED)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_rec, _set) of wanted records (_rec, _t1, _t2), each from the text
    with these hashes; only texts that are wanted are shuffled.

    Sets are kept as 32-bit hashes: two sets of n shingles seem to share one
    that they don't in n * n / 2**32 cases.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        sets = [shingle_set(x) for x in cols["text"]]
        return {
            "_rec": cols["_rec"],
            "_set": [
                np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes()
                for x in sets
            ],
        }

    texts = docs.select(
        "text",
        F.xxhash64("text").alias("_t1"),
        F.xxhash64(F.lit(1), "text").alias("_t2"),
    )
    once = (
        among(texts, "_t1", mask_of(wanted, "_t1"))
        .groupBy("_t1", "_t2")
        .agg(F.first("text").alias("text"))
    )
    rows = once.join(wanted, ["_t1", "_t2"]).select("_rec", "text")
    return map_batches(rows, run, SETS)


def children(
    paths: np.ndarray, sigs: np.ndarray, similarity: float
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, child paths) for the first and, at some nodes, the second
    coordinate that a node draws."""
    rows = np.arange(len(paths))
    drawn = mix(paths + STEP)
    first = (drawn % np.uint64(COORDINATES)).astype(np.int64)
    gap = mix(drawn) % np.uint64(COORDINATES - 1)
    second = (first + 1 + gap.astype(np.int64)) % COORDINATES
    chance = (mix(drawn ^ STEP) >> np.uint64(11)) / float(1 << 53)
    twice = chance < 1 / similarity - 1
    out = []
    for at, which in ((first, rows), (second, rows[twice])):
        at = at[which]
        value = sigs[which, at].astype(np.uint64)
        place = at.astype(np.uint64) * STEP + value
        out.append((which, mix(mix(paths[which] ^ mix(place)) + place)))
    return out


def _matrix(sigs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint32).reshape(len(sigs), -1)


def first_paths(
    records: DataFrame, similarity: float, runs: range
) -> DataFrame:
    """Paths of depth one, in these runs."""
    seeds = mix(np.array(runs, np.uint64) * STEP)

    def run(cols: dict[str, list]) -> dict[str, list]:
        recs = np.array(cols["_rec"], np.int64)
        sigs = _matrix(cols["_sig"])
        made = [
            (recs[rows], paths)
            for seed in seeds
            for rows, paths in children(
                np.full(len(recs), seed), sigs, similarity
            )
        ]
        return {
            "_rec": np.concatenate([x[0] for x in made]),
            "_path": np.concatenate([x[1] for x in made]).view(np.int64),
        }

    return map_batches(records.select("_rec", "_sig"), run, PATHS)


def in_block_pairs(
    rows: DataFrame, key: str, size: Column, most: int
) -> DataFrame:
    """Deal a large group over pairs of blocks, so that any two of its rows
    meet in exactly one pair: adds _side (the row's block), _other, and
    replaces the key by that of the pair."""
    parts = F.ceil(size / most).cast("int")
    own = F.pmod(F.xxhash64("_rec", F.lit(3)), parts.cast("long")).cast("int")
    return (
        rows.withColumn("_side", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn(
            key,
            F.xxhash64(
                key, F.least("_side", "_other"), F.greatest("_side", "_other")
            ),
        )
        .withColumn("_cross", F.col("_side") != F.col("_other"))
    )


class Forest:
    """Union-find over places 0 to n - 1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


class Bucket:
    """Components of a bucket's records, joined where their sketches agree."""

    def __init__(
        self, recs: np.ndarray, sigs: np.ndarray, similarity: float, small: int
    ) -> None:
        self.recs, self.sigs = recs, sigs
        self.similarity, self.small = similarity, small
        self.least = (similarity - SLACK) * COORDINATES
        #: The first record of each one's component.
        self.label = np.arange(len(recs))

    def compare(
        self, some: np.ndarray, rows: np.ndarray, later: bool = False
    ) -> None:
        """Compare some records with all of the rows, or each of the rows only
        with those after it. Equal components are not compared again."""
        columns = np.ascontiguousarray(self.sigs[rows].T)
        for i, x in enumerate(some):
            start = i + 1 if later else 0
            label = self.label[rows[start:]]
            other = label != self.label[x]
            if not other.any():
                continue
            same = columns[:, start:] == self.sigs[x][:, None]
            near = other & (same.sum(0, dtype=np.uint8) >= self.least)
            if near.any():
                joined = np.zeros(len(self.label), bool)
                joined[label[near]] = True
                joined[self.label[x]] = True
                self.label[joined[self.label]] = joined.argmax()

    def settle(self, rows: np.ndarray, path: np.uint64, depth: int) -> None:
        """Compare all rows if they are few; else one of them, the leader, with
        all, and then what is outside the largest component with all, or each
        child by itself."""
        if len(rows) <= self.small:
            return self.compare(rows, rows, later=True)
        drawn = mix(self.recs[rows].view(np.uint64) ^ path)
        self.compare(rows[[drawn.argmin()]], rows)
        label = self.label[rows]
        outside = rows[label != np.bincount(label).argmax()]
        if len(outside) <= self.small:
            return self.compare(outside, rows)
        if depth >= DEPTH:
            return self.compare(rows, rows, later=True)
        paths = np.full(len(rows), path)
        for which, below in children(paths, self.sigs[rows], self.similarity):
            order = np.argsort(below, kind="stable")
            cuts = np.flatnonzero(np.diff(below[order])) + 1
            for part in np.split(order, cuts):
                if len(part) > 1:
                    self.settle(rows[which[part]], below[part[0]], depth + 1)

    def edges(self) -> dict[str, np.ndarray]:
        """Edges that give the components."""
        tied = np.flatnonzero(self.label != np.arange(len(self.label)))
        return {"u": self.recs[tied], "v": self.recs[self.label[tied]]}


def met(buckets: DataFrame, similarity: float) -> DataFrame:
    """Edges of a spanning forest of the pairs whose sketches agree: of the
    two sides of a crossed cell, else of what a bucket's tree compares."""
    small = SMALL

    def run(cols: dict[str, list]) -> dict[str, list]:
        order = np.argsort(cols["_rec"], kind="stable")
        recs = np.array(cols["_rec"], np.int64)[order]
        bucket = Bucket(recs, _matrix(cols["_sig"])[order], similarity, small)
        if cols["_cross"][0]:
            sides = np.array(cols["_side"])[order]
            one = sides == sides[0]
            bucket.compare(np.flatnonzero(one), np.flatnonzero(~one))
        else:
            path = np.array(cols["_path"][:1], np.int64).view(np.uint64)
            bucket.settle(np.arange(len(recs)), path[0], cols["_depth"][0])
        return bucket.edges()

    return map_groups(buckets, "_path", run, EDGES)


def standing(sized: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the buckets whose records are not all in one component yet;
    the others can add no edge.

    Adds _top, whether the record is of the component that most of the bucket
    belong to, and _few, how many are not.
    """
    rooted = sized.join(found, F.col("_rec") == F.col("node"), "left").select(
        *sized.columns, F.coalesce("root", "_rec").alias("_root")
    )
    tops = (
        rooted.groupBy("_path", "_root")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_path")
        .agg(F.max(F.struct("_n", "_root")).alias("_most"))
    )
    return (
        rooted.join(tops, "_path")
        .where(F.col("_most._n") < F.col("_size"))
        .select(
            *sized.columns,
            (F.col("_root") == F.col("_most._root")).alias("_top"),
            (F.col("_size") - F.col("_most._n")).alias("_few"),
        )
    )


def led(
    large: DataFrame, records: DataFrame, similarity: float
) -> DataFrame:
    """Adds whether a record's sketch agrees with that of its bucket's leader,
    _near, and its paths one step deeper; _second may be null."""
    least = (similarity - SLACK) * COORDINATES

    def run(cols: dict[str, list]) -> dict[str, list]:
        out = {n: cols.get(n, []) for n in LED.fieldNames()}
        if cols["_rec"]:
            own, lead = _matrix(cols["_sig"]), _matrix(cols["_led"])
            out["_near"] = (own == lead).sum(1) >= least
            paths = np.array(cols["_path"], np.int64).view(np.uint64)
            (_, first), (rows, second) = children(paths, own, similarity)
            out["_first"] = first.view(np.int64)
            out["_second"] = [None] * len(own)
            for i, path in zip(rows, second.view(np.int64), strict=True):
                out["_second"][i] = int(path)
        return out

    wide = large.join(records.select("_rec", "_sig"), "_rec")
    leads = wide.where("_rec = _lead").select(
        "_path", F.col("_sig").alias("_led")
    )
    return map_batches(wide.join(leads, "_path"), run, LED)


def faced(rows: DataFrame) -> DataFrame:
    """Cells of large buckets with few records outside the component of most:
    the few with each other, and with each block of the others. The rows grow
    with the bucket, as there are at most SMALL of the few."""
    parts = F.ceil((F.col("_size") - F.col("_few")) / SMALL).cast("int")
    own = F.pmod(F.xxhash64("_rec", F.lit(3)), parts.cast("long")).cast("int")
    blocks = F.when(F.col("_top"), F.array(own)).otherwise(
        F.sequence(F.lit(-1), parts - 1)
    )
    return (
        rows.withColumn("_block", F.explode(blocks))
        .withColumn("_path", F.xxhash64("_path", "_block"))
        .withColumn("_side", F.col("_top").cast("int"))
        .withColumn("_cross", F.col("_block") >= 0)
        .select("_rec", "_path", "_depth", "_side", "_cross")
    )


def buckets_of(placed: DataFrame) -> DataFrame:
    """Rows of the buckets of two or more, with their size and leader, but of
    those that are compared whole and hold the same records only one; larger
    ones are split by their own path."""
    sizes = placed.groupBy("_path").agg(
        F.count(F.lit(1)).alias("_size"),
        F.min_by("_rec", F.xxhash64("_rec", "_path")).alias("_lead"),
        F.bit_xor(F.xxhash64("_rec")).alias("_h1"),
        F.bit_xor(F.xxhash64(F.lit(1), "_rec")).alias("_h2"),
    )
    own = F.when(F.col("_size") > SMALL, F.col("_path")).alias("_own")
    once = (
        sizes.where("_size > 1")
        .groupBy("_size", "_h1", "_h2", own)
        .agg(F.min(F.struct("_path", "_lead")).alias("_one"))
        .select("_one.*", "_size")
    )
    return placed.join(once, "_path").select("_rec", "_path", "_size", "_lead")


def candidates(records: DataFrame, similarity: float, runs: int) -> DataFrame:
    """Components (node, root) of the records that meet in a small bucket."""
    first = range(1, min(runs, FIRST_RUNS) + 1)
    found = staged(components(edges_of(records, similarity, first)), "found")
    if runs <= FIRST_RUNS:
        return found
    rest = range(FIRST_RUNS + 1, runs + 1)
    return components(edges_of(records, similarity, rest, found))


def tied(found: DataFrame) -> DataFrame:
    """Edges that give these components."""
    return found.where("node <> root").select(
        F.col("node").alias("u"), F.col("root").alias("v")
    )


def edges_of(
    records: DataFrame,
    similarity: float,
    runs: range,
    found: DataFrame | None = None,
) -> DataFrame:
    """Edges that connect what meets in these runs, and the components
    `found` before.

    A bucket up to WHOLE is settled in one task. A larger one is first compared
    with its leader, a record drawn by hash. What that joins is one component: if it is all, the bucket can add no
    edge; if few records are outside, these are compared with all; else the
    bucket is split. At DEPTH it is dealt over pairs of blocks, without what
    the leaders have joined.
    """
    placed = staged(first_paths(records, similarity, runs), "paths")
    plain, outside, stars = [], [], []
    for depth in range(1, DEPTH + 1):
        sized = staged(buckets_of(placed), "buckets")
        if found is not None and depth == 1:
            sized = staged(
                standing(sized, found).select(*sized.columns), "undecided"
            )
        bucket = ("_rec", "_path", "_size", F.lit(depth).alias("_depth"))
        plain.append(sized.where(F.col("_size") <= WHOLE).select(*bucket))
        large = sized.where(F.col("_size") > WHOLE)
        if large.isEmpty():
            break
        told = staged(led(large, records, similarity), "led")
        stars.append(
            told.where("_near AND _rec <> _lead").selectExpr(
                "_rec AS u", "_lead AS v"
            )
        )
        others = told.groupBy("_path").agg(
            F.count_if(F.expr("NOT _near")).alias("_others")
        )
        left = staged(told.join(others.where("_others > 0"), "_path"), "left")
        split = F.col("_others") > SMALL
        if depth == DEPTH:
            outside.append(left.select(*bucket))
            break
        outside.append(left.where(~split).select(*bucket))
        ways = F.array_compact(F.array("_first", "_second"))
        placed = staged(
            left.where(split).select("_rec", F.explode(ways).alias("_path")),
            "paths",
        )
        if placed.isEmpty():
            break
    if stars:
        known = [] if found is None else [tied(found)]
        found = staged(components(_union([*stars, *known])), "led")
    cells = [
        _union(plain).select(
            "_rec",
            "_path",
            "_depth",
            F.lit(0).alias("_side"),
            F.lit(False).alias("_cross"),
        )
    ]
    if outside:
        left = staged(standing(_union(outside), found), "left")
        cells += [
            faced(left.where(F.col("_few") <= SMALL)),
            in_block_pairs(
                left.where(F.col("_few") > SMALL), "_path", F.col("_size"), SMALL
            ).select("_rec", "_path", "_depth", "_side", "_cross"),
        ]
    rows = _union(cells).join(records.select("_rec", "_sig"), "_rec")
    edges = met(rows, similarity)
    return edges if found is None else edges.unionByName(tied(found))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return out


def linked(members: DataFrame, similarity: float) -> DataFrame:
    """Exact links within groups: each record's number, and what it joins.

    Near copies differ little from what most of the group hold, the core. So
    a set is what it lacks of the core and what it has beside, and the
    intersection of two follows from their numbers and from what these
    differences share; that is counted over an inverted index of them.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        # in order, so that a component's first record is its least
        order = np.argsort(cols["_rec"], kind="stable").tolist()
        recs = [cols["_rec"][i] for i in order]
        sides, cross = np.array(cols["_side"])[order], cols["_cross"][0]
        sets = [np.frombuffer(cols["_set"][i], np.uint32) for i in order]
        n = len(sets)
        size = np.array([len(x) for x in sets])
        owner, number = differences(sets)
        lacks = np.zeros(n, np.int64)
        beside = np.bincount(owner[number >= 0], minlength=n)
        lacks += np.bincount(owner[number < 0], minlength=n)
        core = int((size - beside + lacks)[0])
        _, number, df = np.unique(
            number, return_inverse=True, return_counts=True
        )
        shared = df[number] > 1
        owner, number = owner[shared], number[shared]
        posting = owner[np.argsort(number, kind="stable")]
        df = np.bincount(number, minlength=len(df))
        start = np.concatenate([[0], np.cumsum(df)])
        order = np.argsort(owner, kind="stable")
        mine = number[order]
        first = np.searchsorted(owner[order], np.arange(n + 1))
        forest, links = Forest(n), np.zeros(n, np.int64)
        for i in range(n):
            common = core - lacks - lacks[i]
            for x in mine[first[i] : first[i + 1]].tolist():
                common[posting[start[x] : start[x + 1]]] += 1
            either = size + size[i] - common
            near = common >= similarity * either - 1e-9
            near[i] = False
            if not size[i]:
                near[:] = False
            if cross:
                near &= sides != sides[i]
            links[i] = near.sum()
            for j in np.flatnonzero(near[i + 1 :]):
                forest.join(i, i + 1 + int(j))
        return {
            "_rec": recs,
            "_to": [recs[forest.root(i)] for i in range(n)],
            "_links": links,
        }

    return map_groups(members, "_group", run, LINKS)


def differences(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Differences of sets from their core, the values that more than half of
    them hold: (set, value) with a number for each value, one below 0 for a
    value of the core that the set lacks."""
    n = len(sets)
    size = [len(x) for x in sets]
    owner = np.repeat(np.arange(n), size)
    flat = np.concatenate(sets) if n else np.empty(0, np.uint32)
    kinds, number, df = np.unique(
        flat, return_inverse=True, return_counts=True
    )
    core = 2 * df > n
    place = np.cumsum(core) - 1
    inside = core[number]
    held = np.zeros((int(core.sum()), n), bool)  # at most two cells a value
    held[place[number[inside]], owner[inside]] = True
    value, lacking = np.nonzero(~held)
    return (
        np.concatenate([owner[~inside], lacking]),
        np.concatenate([number[~inside], -1 - value]),
    )


def classes(
    docs: DataFrame, rows: DataFrame, similarity: float
) -> DataFrame:
    """(_rec, _root, n_links) of the records that have links, from documents
    and their signed rows."""
    # one text stands for all copies
    records = staged(
        rows.groupBy("_rec").agg(
            F.first("_sig").alias("_sig"),
            F.min(F.struct("_t1", "_t2", "_bytes")).alias("_text"),
        ),
        "records",
    )
    found = staged(
        candidates(records, similarity, runs_for(similarity)), "met"
    )
    held = staged(
        found.withColumnRenamed("node", "_rec")
        .join(records.select("_rec", "_text.*"), "_rec"),
        "held",
    )
    sets = sets_of(docs, held.select("_rec", "_t1", "_t2"))
    sizes = held.groupBy("root").agg(
        F.greatest(
            F.count(F.lit(1)) / BLOCK, F.sum("_bytes") / BLOCK_BYTES
        ).alias("_blocks")
    )
    members = (
        held.select("_rec", "root")
        .join(sizes, "root")
        .withColumnRenamed("root", "_group")
    )
    plain = members.where("_blocks <= 1").select(
        "_rec",
        "_group",
        F.lit(0).alias("_side"),
        F.lit(False).alias("_cross"),
    )
    split = in_block_pairs(
        members.where("_blocks > 1"), "_group", F.col("_blocks"), 1
    ).select("_rec", "_group", "_side", "_cross")
    exact = staged(
        linked(plain.unionByName(split).join(sets, "_rec"), similarity),
        "links",
    )
    roots = components(
        exact.where("_rec <> _to").select(
            F.col("_rec").alias("u"), F.col("_to").alias("v")
        )
    )
    return (
        exact.groupBy("_rec")
        .agg(F.sum("_links").alias("n_links"))
        .join(roots, F.col("_rec") == F.col("node"))
        .select("_rec", F.col("root").alias("_root"), "n_links")
    )


def signed_classes(docs: DataFrame, similarity: float) -> DataFrame:
    """Rows (doc_id, _t1, _t2, _rec, _root, n_links) of all documents."""
    rows = staged(signed(docs), "signed")
    found = staged(classes(docs, rows, similarity), "classes")
    return (
        rows.select("doc_id", "_t1", "_t2", "_rec")
        .join(found, "_rec", "left")
        .withColumn("_root", F.coalesce("_root", "_rec"))
        .withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    )


def join(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Similarity classes, one row per row of `docs`.

    doc_id; class_id, the smallest doc_id of all documents that links and
    copies connect; n_links, to how many other shingle sets this one has a
    Jaccard similarity of at least `similarity`; copy_of, the smallest doc_id
    with an equal set. Texts without words (null, empty, blank) count as
    copies of each other. Null ids stay null, and a class has a null class_id
    only if all its ids are null; repeated rows stay; other columns are
    ignored.
    """
    rows = staged(signed_classes(docs, similarity), "rows")
    copies = rows.groupBy("_rec", "_root").agg(
        F.min("doc_id").alias("copy_of")
    )
    least = copies.groupBy("_root").agg(F.min("copy_of").alias("class_id"))
    named = copies.join(least, "_root").select("_rec", "copy_of", "class_id")
    return rows.join(named, "_rec").select(
        "doc_id", "class_id", "n_links", "copy_of"
    )


def deduplicated(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of `docs` with one document of each class.

    It is the one with the smallest doc_id (a null id only if all are null);
    of repeated rows one stays. All columns stay as they are.
    """
    rows = signed_classes(docs, similarity)
    # nulls sort last; the text's hashes settle ties
    rank = F.struct(
        F.col("doc_id").isNull().alias("_none"), "doc_id", "_t1", "_t2"
    )
    kept = staged(
        rows.groupBy("_root")
        .agg(F.min(rank).alias("_first"))
        .select("_first.doc_id", "_first._t1", "_first._t2"),
        "kept",
    ).withColumnRenamed("doc_id", "_id")
    # the row goes along whole, whatever its columns are called
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.xxhash64("text").alias("_key1"),
        F.xxhash64(F.lit(1), "text").alias("_key2"),
        F.col("doc_id").cast("long").alias("_own"),
    )
    same = (
        F.col("_own").eqNullSafe(F.col("_id"))
        & (F.col("_key1") == F.col("_t1"))
        & (F.col("_key2") == F.col("_t2"))
    )
    return (
        keyed.join(kept, same, "left_semi")
        .dropDuplicates(["_own", "_key1", "_key2"])
        .select("_row.*")
    )
