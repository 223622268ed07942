"""The digest cache against the tokeniser libraries."""

from functools import lru_cache

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from proclivity.llm import token_counts
from proclivity.llm.common import scratch
from proclivity.llm.queries import COUNTED_BY

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Two  words.",
    " two words. ",
    "TWO\tWORDS.",
    "two words .",
    "<|startoftext|>two<|endoftext|>.",
    "<|STARTOFTEXT|>two",
    "<|startoftext|> Two",
    "H̱ ẖ ẖ É é",
    "it's 'twas don't. x.'s a's. 3.14 $5,00!",
    "　wide space\x1cunit\x85next",
    "x" * 5000,
    "日本語 テキスト.",
    "ΣΑΣ ß ẞ İi",
]


@lru_cache
def library_of(path):
    if path.endswith(".model"):
        return sentencepiece.SentencePieceProcessor(model_file=path)
    return Tokenizer.from_file(path)


def by_library(path, texts):
    library = library_of(path)
    if path.endswith(".model"):
        return [len(library.encode(t)) for t in texts]
    return [len(library.encode(t, add_special_tokens=False)) for t in texts]


@pytest.mark.parametrize("path", [COUNTED_BY, BYTES, PIECES])
def test_counts_equal_the_library(spark, path):
    texts = [*TEXTS, *TEXTS[:4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cache = scratch(spark, "cache")
    rows = token_counts.count(docs, path, cache).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == by_library(path, texts)
    assert [r.n_bytes for r in rows] == [len(t.encode()) for t in texts]
    assert [r.over_limit for r in rows] == [r.n_tokens > 2048 for r in rows]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.text(
            st.sampled_from("aAéÉhH̱́ .,'st\n\x1c　<|>5日#") | st.characters(exclude_categories=["Cs"]),
            max_size=20,
        ),
        min_size=1,
        max_size=6,
    )
)
def test_equal_contents_have_equal_counts(texts):
    counter = token_counts.load(COUNTED_BY)
    counts = by_library(COUNTED_BY, texts)
    assert counter.counts(texts) == counts
    twins = [t.upper() if t.isascii() else f" {t}\n" for t in texts]
    more = by_library(COUNTED_BY, twins)
    of = {}
    for text, n in zip(texts + twins, counts + more, strict=True):
        assert of.setdefault(counter.content(text), n) == n


def test_only_missing_digests_are_encoded(spark):
    cache = scratch(spark, "cache")
    rows = [(i, f"text number {i % 7}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def count(df):
        return token_counts.count(df, COUNTED_BY, cache).count()

    assert count(docs) == 40
    assert spark.read.parquet(cache).count() == 7
    more = docs.union(spark.createDataFrame([(99, "TEXT  number 3"), (98, "new")], docs.schema))
    files = set(spark.read.parquet(cache).inputFiles())
    assert count(more) == 42
    appended = set(spark.read.parquet(cache).inputFiles()) - files
    assert spark.read.parquet(cache).count() == 8
    assert spark.read.parquet(*appended).count() == 1


def test_stored_counts_are_used_and_versions_kept_apart(spark):
    cache = scratch(spark, "cache")
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    first = token_counts.count(docs, COUNTED_BY, cache).collect()
    stored = spark.read.parquet(cache)
    assert [r.tokenizer for r in stored.collect()] == [
        token_counts.version_of(COUNTED_BY)
    ]
    # two writers: the same digest twice counts once
    again = spark.createDataFrame(
        [(r.tokenizer, r.digest, r.n_tokens) for r in stored.collect()], token_counts.CACHE
    )
    again.write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert token_counts.count(docs, COUNTED_BY, cache).collect() == first
    token_counts.count(docs, PIECES, cache).collect()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_odd_rows(spark, odd_docs, no_docs):
    cache = scratch(spark, "cache")
    rows = token_counts.count(odd_docs, COUNTED_BY, cache).collect()
    assert len(rows) == odd_docs.count()
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), *by_library(COUNTED_BY, [r.text or ""]))
        for r in odd_docs.collect()
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    none = token_counts.count(no_docs, COUNTED_BY, scratch(spark, "cache"))
    assert none.collect() == []
