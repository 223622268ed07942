"""Token alignment against all pairs of token byte ranges."""

import hashlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from proclivity.llm import alignment
from proclivity.llm.queries import ALIGNED

TEXTS = [
    "Plain words, and more words.",
    "  two  spaces  ",
    "é😀 日本̀ \U0001f9ff\U0001f9ffx",
    "<|endoftext|> <s> </s> <0x41> <unk>",
    "\n\n tab\there  \n end \n",
    "it's 3.14 ²x. x.,y;z  .. a's.'s é.é ÿ!ß*",
    "a" * 300,
    "a\x00b　c\x1cd",
    "holds the ▁ sign",
    "Plain words, and more words.",
]


def tokens(text):
    """(id, start, end) of both sides; none where bytes differ."""
    aligner = alignment.load(*ALIGNED)
    whole = f" {text}".encode()
    out = []
    ids_a = aligner.a.encode(f" {text}", add_special_tokens=False).ids
    for ids, made in ((ids_a, aligner.bytes_a), (aligner.b.encode(text), aligner.bytes_b)):
        at, side = 0, []
        for i in ids:
            side.append((i, at, at + len(made[i])))
            at += len(made[i])
        if b"".join(made[i] for i in ids) != whole:
            return [], []
        out.append(side)
    return out


def brute(texts):
    """The contract's columns, by comparing all pairs of tokens."""
    sides = [tokens(t) if t else ([], []) for t in texts]
    linked = [
        [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        for a, b in sides
    ]
    count = Counter(pair for pairs in linked for pair in pairs)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(n, most.get(y, 0))
    out = []
    for (a, b), pairs in zip(sides, linked, strict=True):
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [
            ",".join(str(x) for x, _, e in a if s < e <= t)
            + "|"
            + ",".join(str(x) for x, _, e in b if s < e <= t)
            for s, t in zip([0, *ends], ends, strict=False)
        ]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append(
            (
                len(a),
                len(b),
                len(ends),
                len(pairs),
                sum(count[p] == most[p[1]] for p in pairs),
                sum(count[p] for p in pairs),
                digest if a else "",
            )
        )
    return out


COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def test_alignment_equals_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = brute(TEXTS)
    assert want[8] == (0, 0, 0, 0, 0, 0, "") and want[3][0] > 5
    # whichever pairs every task holds, the result is the same
    for frequent in (alignment.FREQUENT, 5, 0):
        rows = alignment.align(docs, *ALIGNED, frequent=frequent)
        got = rows.orderBy("doc_id").select(*COLUMNS).collect()
        assert [tuple(r) for r in got] == want


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.text(
            st.sampled_from("ab .,!'s\n\té日😀²ÿ#")
            | st.characters(exclude_categories=["Cs"]),
            max_size=25,
        ),
        min_size=1,
        max_size=5,
    )
)
def test_chunks_align_like_whole_texts(texts):
    aligner = alignment.load(*ALIGNED)
    for text, parts in zip(texts, aligner.parts(texts), strict=True):
        a, b = tokens(text) if text else ([], [])
        assert (sum(p.n_a for p in parts), sum(p.n_b for p in parts)) == (len(a), len(b))
        whole = aligner.align([f" {text}"]) if text else None
        if whole and "▁" not in text:
            assert ";".join(p.groups for p in parts) == whole[0].groups
            assert b"".join(p.pairs for p in parts) == whole[0].pairs


def test_odd_rows(spark, odd_docs, no_docs):
    rows = alignment.align(odd_docs, *ALIGNED).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    short = [t if len(t) < 1000 else "" for _, t in texts]
    want = {(i, *w[:4], w[6]) for (i, _), w in zip(texts, brute(short), strict=True)}
    got = {(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) for r in rows}
    assert len(rows) == len(texts) and len(got - want) == 1  # the long text
    assert alignment.align(no_docs, *ALIGNED).collect() == []
