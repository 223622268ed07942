"""License scans: an automaton for phrases, a parser for expressions.

Aho-Corasick finds notice phrases over the words of a text, and identifier
tags over its characters. The expression after a tag is parsed by the
shunting-yard method (`with` binds tighter than `and`, `and` than `or`).
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.llm.common import map_batches, schema

#: Phrases of the contract and their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases; they add labels, never places.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "reserved",
}
TAG = "spdx-license-identifier:"
#: Families by the start of an identifier, the longest first.
FAMILIES = {
    "apache": "apache",
    "agpl": "agpl",
    "lgpl": "lgpl",
    "gpl": "gpl",
    "cc-by": "cc-by",
    "cc0": "cc0",
    "mit": "mit",
    "bsd": "bsd",
    "mpl": "mpl",
    "epl": "epl",
    "isc": "isc",
    "bsl": "bsl",
}
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[a-z0-9.+:-]+")

RESULT = schema(
    "doc_id long, n_words long, n_base long, first_word long,"
    "last_word long, base_labels string, labels string, score double,"
    "expressions string, open_choice boolean"
)

#: A-Z to a-z; every other ASCII character that is no word character to a
#: space. Bytes above 127 belong to words, so UTF-8 can be mapped bytewise.
FOLD = bytes(
    c + 32
    if 65 <= c <= 90
    else c
    if c > 127 or 48 <= c <= 57 or 97 <= c <= 122
    else 32
    for c in range(256)
)


@lru_cache(maxsize=1)
def _phrases() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


@lru_cache(maxsize=1)
def _tags() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word(TAG, TAG)
    found.make_automaton()
    return found


def places(words: list[bytes]) -> list[tuple[str, int]]:
    """(phrase, index of its first word) of every place, overlaps included."""
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    out, at, seen = [], 0, 0
    for end, phrase in _phrases().iter(line):
        seen += line.count(" ", at, end)
        at = end
        out.append((phrase, seen - 1 - phrase.count(" ")))
    return out


def postfix(expression: str) -> list[str] | None:
    """Identifiers and operators in evaluation order; None if malformed."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # whether an identifier or "(" must come next
    for token in TOKEN.findall(expression):
        if token == "(":
            if not operand:
                return None
            stack.append(token)
        elif token == ")":
            if operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in BINDS:
            if operand:
                return None
            while stack and BINDS.get(stack[-1], 0) >= BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def family(identifier: str) -> str:
    for start, label in FAMILIES.items():
        if identifier.startswith(start):
            return label
    return identifier


def evaluate(expression: str) -> tuple[frozenset[str], frozenset[str]] | None:
    """(labels named, labels that hold whatever is chosen).

    `or` needs only what both sides need, `and` needs what either side needs,
    `with` keeps the licence and drops the exception's name.
    """
    steps = postfix(expression)
    if steps is None:
        return None
    stack: list[tuple[frozenset[str], frozenset[str]]] = []
    for step in steps:
        if step not in BINDS:
            named = frozenset([family(step)])
            stack.append((named, named))
            continue
        b, a = stack.pop(), stack.pop()
        if step == "or":
            a = (a[0] | b[0], a[1] & b[1])
        elif step == "and":
            a = (a[0] | b[0], a[1] | b[1])
        stack.append(a)
    return stack[0]


def longest_valid(line: str) -> str:
    """The longest start of a line that is a whole expression; "" if none.

    A stop after an identifier ends the expression, and so does a second
    identifier or an opening bracket where an operator must come.
    """
    depth = end = 0
    operand = True  # whether an identifier or "(" must come next
    for found in TOKEN.finditer(line):
        token = found[0].rstrip(".")
        if operand == (token == ")" or token in BINDS) or not token:
            break
        if token == ")" and not depth:
            break
        depth += (token == "(") - (token == ")")
        operand = token == "(" or token in BINDS
        if not operand and not depth:
            end = found.start() + len(token)
        if token != found[0]:
            break
    return line[:end]


def expressions(text: str) -> list[str]:
    """The longest expression after each identifier tag on its line, in lower
    case; what stands there if that begins with none."""
    if "dentifier" not in text and "DENTIFIER" not in text:
        return []
    low = text.lower()
    out = []
    for end, _ in _tags().iter(low):
        stop = low.find("\n", end)
        line = low[end + 1 : stop if stop >= 0 else len(low)]
        kept = re.match(
            r"\s*((?:[()\s]|(?:[a-z0-9][a-z0-9.+:-]*))*)", line
        )
        whole = " ".join(kept[1].split())
        out.append(longest_valid(whole) or whole.rstrip("."))
    return out


def scan_text(text: str | None) -> tuple:
    """The result's columns of one text, but for doc_id."""
    text = text or ""
    words = text.encode().translate(FOLD).split()
    found = places(words)
    base = [(BASE[p], at) for p, at in found if p in BASE]
    labels = {label for label, _ in base}
    labels |= {NOTICES[p] for p, _ in found if p in NOTICES}
    doubt = 1.0
    for _ in {p for p, _ in found}:
        doubt *= 0.4  # each kind of phrase is some evidence
    tags = expressions(text)
    choices = False
    for expression in tags:
        value = evaluate(expression)
        if value is None:
            doubt *= 0.5  # a tag whose expression can't be read
            continue
        doubt = 0.0
        choices |= value[0] != value[1]
        labels |= value[0]
    starts = [at for _, at in base]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for label, _ in base})),
        ",".join(sorted(labels)),
        1.0 - doubt,
        "\n".join(tags),
        choices,
    )


def scan(docs: DataFrame) -> DataFrame:
    """License evidence of every document, one row per row of `docs`.

    A null or empty text has no words, no labels and score 0; a null doc_id
    stays null; repeated rows stay; other columns are ignored. `expressions`
    has the tags' expressions, one a line; `open_choice` says whether one of
    them leaves a choice. A malformed expression adds no label.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        rows = [scan_text(text) for text in cols["text"]]
        names = RESULT.fieldNames()[1:]
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        return {"doc_id": cols["doc_id"]} | dict(
            zip(names, map(list, columns), strict=True)
        )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, run, RESULT)
