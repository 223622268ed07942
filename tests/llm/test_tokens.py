"""BPE, packing and fertility."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from proclivity.llm import byte_bpe, chunks, fertility, packing
from proclivity.llm.queries import VOCABULARIES

RANKS = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
BPE = byte_bpe.load(RANKS, P.PATTERN)
ODD = st.text(
    st.sampled_from(" \n\t\r\x85\x1c 　ab'sltreé9.,!#日本क्😀Z")
    | st.characters(codec="utf-8")
)


@pytest.fixture(scope="module")
def public():
    with open(RANKS, "rb") as lines:
        ranks = {
            base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)
        }
    return tiktoken.Encoding(
        "public",
        pat_str=P.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={},
    )


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(JSON)
    out.encode_special_tokens = True
    return out


@settings(max_examples=300, deadline=None)
@given(text=ODD)
def test_bpe_equals_the_library(public, text):
    ids = BPE.encode(text)
    assert ids == public.encode_ordinary(text)
    assert BPE.decode(ids).decode() == text


@settings(max_examples=200, deadline=None)
@given(text=ODD)
def test_packed_ids_equal_the_library(tokenizer, text):
    ids = np.frombuffer(b"".join(packing._memo(JSON).of(text)), "<u4")
    assert list(ids) == tokenizer.encode(text, add_special_tokens=False).ids


def test_small_vocabulary_by_plain_merges():
    """Merges by rank, done one by one, on words of a small alphabet."""
    ranks = {bytes([i]): i for i in range(256)}
    for t in (b"aa", b"ab", b"aab", b"ba", b"aaab", b"bb", b"abba"):
        ranks[t] = len(ranks)
    bpe = byte_bpe.ByteBPE(ranks, r"\S+|\s+")

    def merged(piece):
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [
                (ranks[a + b], i)
                for i, (a, b) in enumerate(
                    zip(parts, parts[1:], strict=False)
                )
                if a + b in ranks
            ]
            if not pairs:
                return [ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for n in range(1, 12):
        for bits in range(1 << n):
            text = "".join("ab"[bits >> i & 1] for i in range(n))
            assert bpe.encode_piece(text) == merged(text.encode()), text


def test_bpe_rows(spark, odd_docs, no_docs, public):
    rows = byte_bpe.round_trip(odd_docs, RANKS, P.PATTERN).collect()
    want = Counter()
    for r in odd_docs.collect():
        text = r.text or ""
        ids = public.encode_ordinary(text)
        want[
            r.doc_id,
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        ] += 1
    assert Counter(map(tuple, rows)) == want
    assert byte_bpe.round_trip(no_docs, RANKS, P.PATTERN).count() == 0


def test_cut_leaves_the_short_piece_first():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(1, 4) == [(0, 1)]


def check_packing(rows, pieces):
    assert len(rows) == pieces
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    return len(by)


def test_packing_rows(spark, odd_docs, no_docs, tokenizer):
    rows = packing.pack(packing.pieces_of(odd_docs, JSON)).collect()
    want = Counter()
    for r in odd_docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        ids = np.array([*ids, 0], "<u4")
        for i, (at, n) in enumerate(packing.cut(len(ids))):
            crc = zlib.crc32(ids[at : at + n].tobytes())
            want[r.doc_id, i, at, n, crc] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    check_packing(rows, sum(want.values()))
    assert packing.pack(packing.pieces_of(no_docs, JSON)).count() == 0


def test_exchange_between_partitions_saves_sequences(spark):
    """Many small partitions end near the bound of all of them."""
    draws = np.random.default_rng(5)
    lengths = np.concatenate(
        [draws.integers(1, 2048, 1500), draws.integers(1, 300, 1500)]
    )
    pieces = spark.createDataFrame(
        [(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)], packing.PIECES
    )
    rows = packing.pack(pieces, per_partition=100).collect()
    used = check_packing(rows, len(lengths))
    least = packing.lower_bound(lengths, packing.CAPACITY)
    once = packing.best_fit_decreasing(lengths, packing.CAPACITY).max() + 1
    assert least <= once <= used <= least * 1.02


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_never_exceeds_the_optimum(lengths):
    def fits(left, bins):
        if not left:
            return True
        n, rest = left[0], left[1:]
        for free in set(bins):
            if free >= n:
                i = bins.index(free)
                if fits(rest, [*bins[:i], free - n, *bins[i + 1 :]]):
                    return True
        return False

    lengths = sorted(lengths, reverse=True)
    best = next(k for k in range(1, 10) if fits(lengths, [20] * k))
    arr = np.array(lengths)
    assert packing.lower_bound(arr, 20) <= best
    assert best <= packing.best_fit_decreasing(arr, 20).max() + 1


def plain_counts(text):
    text = text or ""
    found = [
        w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w
    ]
    three = Counter(zip(found, found[1:], found[2:], strict=False))
    covered = set()
    for i in range(len(found) - 2):
        if three[tuple(found[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip("\x20\t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        len(covered),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n\t#é \x1c日"), max_size=60))
def test_base_counts(text):
    assert fertility.base_counts(text) == plain_counts(text)


def test_fertility_rows(spark, odd_docs, no_docs):
    rows = fertility.rate(odd_docs, *VOCABULARIES).collect()
    want = Counter((r.doc_id, *plain_counts(r.text)) for r in odd_docs.collect())
    got = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in rows
    )
    assert got == want
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert not (failed and r.kept)
    assert fertility.rate(no_docs, *VOCABULARIES).count() == 0
    assert fertility.accepted(no_docs, *VOCABULARIES).columns == no_docs.columns


def test_symbol_soup_is_rejected_and_prose_is_kept(spark):
    draws = np.random.default_rng(3)
    vocabulary = [
        "".join(draws.choice(list("aeiourstlnd"), draws.integers(2, 8)))
        for _ in range(400)
    ]

    def prose(n):
        return list(draws.choice(vocabulary, n))

    rows = [(i, " ".join(prose(300)), "en") for i in range(300)]
    rows += [
        (i, " ".join(w + "$$$" for w in prose(300)), "en")
        for i in range(300, 310)
    ]
    out = fertility.rate(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        *VOCABULARIES,
    ).collect()
    assert all(r.kept == (r.doc_id < 300) for r in out)


def letters(draws, alphabet, n):
    """Texts of 300 words over an alphabet."""
    vocabulary = [
        "".join(draws.choice(list(alphabet), draws.integers(2, 8)))
        for _ in range(400)
    ]
    return [" ".join(draws.choice(vocabulary, 300)) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 20, 199, 201])
def test_rare_language_has_bands_of_its_own(spark, n):
    draws = np.random.default_rng(5)
    texts = [(t, "en") for t in letters(draws, "aeiourstlnd", 300)]
    texts += [(t, "ja") for t in letters(draws, "あいうえおかきくけこさしすせそ", n)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts)]
    # unreadable bytes go once the language is known well enough
    soup = [(10_000, " ".join(w + "\ue000" for w in texts[-1][0].split()), "ja")]
    out = fertility.rate(
        spark.createDataFrame(
            rows + (soup if n > 100 else []),
            "doc_id long, text string, lang string",
        ),
        *VOCABULARIES,
    ).collect()
    assert all(r.kept == (r.doc_id < 10_000) for r in out)


def test_chunks_of_many_texts_are_cut_at_once():
    """Each kind of chunk is looked up once for all texts of a call."""
    odd = ["", " ", "a", " lead a", "trail a ", "a  b a", "x　y 　z a", "a\n b\tc", "b a " * 9]
    heads, codes, kinds = packing.cut_together(odd)
    got = [[h, *(kinds[i] for i in x)] for h, x in zip(heads, codes, strict=True)]
    assert got == [chunks.chunks(x) for x in odd]
    assert len(kinds) == len(set(kinds))


def test_words_and_the_marks_after_them_are_encoded_apart(tokenizer):
    """A word is encoded once, whatever marks follow it."""
    texts = [f"x {' '.join('word' + m for m in ('', '.', ',', '.%%%', '!?'))}"]
    texts += ["the über., ÷, a×. ɐ. q́. 日本. 12. a1. ,. . , ! it's. d,'s 'll.", None]
    texts += ["end.###\n next,\tx ,y,  z, <|endoftext|>. <|endoftext|>", ""]
    encoder = packing.Encoder(JSON)
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    assert [k for k in encoder.runs.number if k.startswith("word")] == ["word"]
    assert packing.halves(["ab.,", "ab", "a1.", ".", "", "日."]) == (
        ["ab", "ab", "a1.", ".", "", "日."],
        [".,", "", "", "", "", ""],
    )
