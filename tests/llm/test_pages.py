"""Main text, archives and license scans."""

import base64
import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from proclivity.llm import licenses, main_text, warc
from proclivity.llm.queries import ORACLES, QUERIES
from tests.compare import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (1, None, None),
        (2, "http://a/é \r\nX-Page-Id: 9", ""),
        (3, "http://b", "<p>same</p>"),
        (4, "http://c", "<p>same</p>"),
        (4, "http://c", "<p>same</p>"),
        (None, "http://d", "<p>same</p>"),
        (None, None, "only without a number"),
        (5, "u", "<p>" + "long text, " * 200_000),
        (6, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
    ]
    return spark.createDataFrame(
        [(*r, "x", 3) for r in rows],
        f"{PAGES}, payload string, record_type int",
    )


PAGE = """<html><head><title>T</title><style>p{a>b}</style></head><body>
<header><h1>Site</h1></header><nav><a href="/">Home</a></nav>
<div class="cookie-notice"><p>We use cookies, as you know. Accept them!</p></div>
<div class=page><div id="content"><h2>Head&amp;line</h2>
<p>First   paragraph, with <a href="x">a link</a> and <b>bold</b>.
<p>Second &copy; one<!-- <p>no</p> -->, quite long, with marks.
<ul><li>item one<li>item two</ul><script>if (a<b) "</p>"</script></div>
<div class="comments"><p>Great post, really, I loved it. Thanks, all!</p></div>
<aside><p>Read more, much more, of it.</p></aside></div>
<form><p>Name, please.</p></form><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text.main_text(PAGE).split("\n\n") == [
        "Head&line",
        "First paragraph, with a link and bold.",
        "Second © one, quite long, with marks.",
        "item one",
        "item two",
    ]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["<p>", "</p>", "<div class='x", "'>", "<b>", "</div>", "text, ",
             "<script>", "</script>", "<!--", "-->", "&amp;", "&#0;", "<", ">",
             "<br/>", "<a href=\"", "</a>", "\x00", "é", "<li>", "</ul>"]
        )
    ).map("".join)
)
def test_broken_markup_never_fails(source):
    assert isinstance(main_text.main_text(source), str)


def test_long_broken_page_is_linear():
    main_text.main_text("<a href='" * 50_000 + "<div " * 50_000)
    main_text.main_text("<div>" * 20_000 + "text, with marks.")


def test_page_rows(spark, odd_pages):
    rows = main_text.extract(odd_pages).collect()
    assert len(rows) == odd_pages.count()
    assert all(r.n_chars == len(r.text) for r in rows)
    empty = spark.createDataFrame([], PAGES)
    assert main_text.extract(empty).count() == 0
    assert warc.round_trip(empty).count() == 0


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_archive_rows(odd_pages):
    rows = warc.round_trip(odd_pages).collect()
    got = sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows),
        key=repr,
    )
    source = odd_pages.collect()
    last = {}
    for r in source:
        if r.page_id is not None:
            key = digest(r.html)
            last[key] = max(last.get(key, -1), r.page_id)
    want = []
    for r in source:
        to = last.get(digest(r.html))
        same = r.page_id == to
        want.append(
            (
                r.page_id,
                len((r.html or "").encode()),
                digest(r.html),
                "response" if same else "revisit",
                None if same else to,
            )
        )
    assert got == sorted(want, key=repr)


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], PAGES)
    kinds = {r.record_type for r in warc.round_trip(pages, 3).collect()}
    assert kinds == {"response"}


def test_archives_match_sql(spark):
    key = "op8_warc_members"
    got = spark_rows(QUERIES[key](spark, SF))
    assert got == duck_rows(connect(SF), ORACLES[key])


def test_inflating_streams_and_members():
    class Source:
        def __init__(self, data):
            self.data = data

        def read(self, n):
            out, self.data = self.data[:n], self.data[n:]
            return out

    def packed(x):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        return c.compress(x) + c.flush()

    row = {
        "page_id": 1, "url": "u", "payload": b"x" * 700_000,
        "record_type": "response", "refers_to": None,
    }
    record = warc.record_bytes(row)
    for data in (packed(record * 3), packed(record) * 3):
        out = list(warc.records_in(warc.inflated(Source(data))))
        assert out == [record] * 3
    with pytest.raises(ValueError):
        list(warc.records_in(iter([record[:-5]])))


def plain_scan(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = []
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        hits += [
            (i, label)
            for i in range(len(found) - len(want) + 1)
            if found[i : i + len(want)] == want
        ]
    starts = [i for i, _ in hits]
    return (
        len(found),
        len(hits),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({x for _, x in hits})),
    )


WORDS = "GNU General public LICENSE apache cc by mit licenſe é x-y CC-BY MIT\n. ²".split(" ")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=14), st.sampled_from([" ", "-", "  ", "."]))
def test_phrases(parts, between):
    text = between.join(parts)
    got = licenses.scan_text(text)
    assert got[:5] == plain_scan(text)
    assert set(got[4].split(",")) <= set(got[5].split(",")) | {""}


def test_license_rows(odd_docs, no_docs):
    rows = licenses.scan(odd_docs).collect()
    want = sorted(((r.doc_id, *plain_scan(r.text)) for r in odd_docs.collect()), key=repr)
    assert sorted((tuple(r)[:6] for r in rows), key=repr) == want
    assert licenses.scan(no_docs).count() == 0


@pytest.mark.parametrize(
    ("line", "every", "needed"),
    [
        ("mit", {"mit"}, {"mit"}),
        ("mit or apache-2.0", {"mit", "apache"}, set()),
        ("mit and apache-2.0 or mit", {"mit", "apache"}, {"mit"}),
        ("mit and (apache-2.0 or mit)", {"mit", "apache"}, {"mit"}),
        ("gpl-2.0-only with classpath-exception-2.0", {"gpl"}, {"gpl"}),
    ],
)
def test_expressions(line, every, needed):
    assert licenses.evaluate(line) == (every, needed)


@pytest.mark.parametrize("line", ["", "or", "mit or", "(mit", "mit)", "mit mit", "()"])
def test_malformed_expressions(line):
    assert licenses.evaluate(line) is None


def test_identifier_tags():
    text = "// SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode"
    got = licenses.scan_text(text)
    assert got[5] == "apache,mit"
    assert got[6] == 1.0
    assert got[8]


@pytest.mark.parametrize(
    ("line", "label"),
    [
        ("MIT. See LICENSE", "mit"),
        ("MIT This file", "mit"),
        ("(MIT OR Apache-2.0) AND (BSD", "apache,mit"),
        ("Apache-2.0 WITH", "apache"),
        ("GPL-2.0-only WITH Classpath-exception-2.0 */", "gpl"),
        ("(see the file)", ""),
    ],
)
def test_text_after_an_expression(line, label):
    got = licenses.scan_text(f"/* SPDX-License-Identifier: {line}\n mpl */")
    assert got[5] == label


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["mit", "or", "and", "with", "(", ")", "b", "isc."]), max_size=9))
def test_longest_expression_equals_all_starts(tokens):
    best = ""
    for n in range(1, len(tokens) + 1):
        start = " ".join(tokens[:n]).rstrip(".")
        if not any(t.endswith(".") for t in tokens[: n - 1]) and licenses.postfix(start):
            best = start
    assert licenses.longest_valid(" ".join(tokens)) == best
