"""Main text of web pages by tag-path ratios.

Text is grouped into blocks, and blocks by their path of block tags from the
root. Each path gets its text length and its punctuation per block, lowered
by the share of linked text. The two ratios are fused, smoothed over the page
order of the paths, and compared with the best path's. What stands in the
container of a path that passes is content, short blocks and headings too.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.llm.common import map_batches, schema

RESULT = schema("page_id long, url string, text string, n_chars long")

NAME = re.compile(r"/?[a-zA-Z][^\s/>]*+")
ATTRIBUTES = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
NAMED = re.compile(
    r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I
)
PUNCTUATION = re.compile(r"[.,;:!?…。、，]")

#: Tags whose content is no markup (fixed values of the HTML standard).
RAW = frozenset("script style textarea title noscript template svg".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr"
    .split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd "
    "mark q rp rt ruby s samp small span strike strong sub sup time tt u var"
    .split()
)
#: A new one of these closes one that is still open.
SIBLINGS = frozenset("li td th tr dd dt option p".split())
#: Tags and names that never hold an article.
FURNITURE_TAGS = frozenset(
    "nav footer aside form button select menu dialog head iframe".split()
)
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner\w*|sponsor\w*|promo\w*|cookies?\w*"
    r"|consent|notice\w*|alert\w*|popup|modal|overlay|comments?\w*|disqus"
    r"|replies|reply|sidebar\w*|widget\w*|menu\w*|nav|navbar|navigation"
    r"|breadcrumbs?|header|footer|masthead|share\w*|social\w*|related"
    r"|recommend\w*|newsletter\w*|subscribe\w*|signup|login|search\w*"
    r"|toolbar|pagination|pager|complementary|contentinfo|skip\w*)"
    r"(?:$|[\s_-])",
    re.I,
)
#: Paths with at least this share of the best fused ratio are content.
THRESHOLD = 0.25
#: Weights of a path's neighbours in page order.
SMOOTH = 0.1


@dataclass
class Path:
    """A path of block tags, and what all blocks with it have."""

    parent: int
    tag: str = ""
    inside_article: bool = False
    furniture: bool = False
    blocks: int = 0
    chars: int = 0
    punctuation: int = 0
    linked: int = 0
    children: dict[str, int] = field(default_factory=dict)


class Page:
    """Blocks of a page in order, and its paths."""

    def __init__(self, source: str) -> None:
        self.paths = [Path(-1)]
        self.blocks: list[tuple[int, str]] = []
        self._stack: list[tuple[str, int]] = [("", 0)]
        self._text: list[str] = []
        self._linked: list[str] = []
        self._in_link = 0
        self._raw = ""
        self._open_ended: set[str] = set()
        self._read(source)
        self._end_block()

    def _read(self, source: str) -> None:
        at = 0
        last = source.rfind(">")  # no tag ends after it
        balanced = True  # until a quotation mark is left open
        while 0 <= (start := source.find("<", at)) < last:
            self._add(source[at:start])
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                at = end + 3 if end >= 0 else len(source)
                continue
            found = NAME.match(source, start + 1)
            if not found:
                if source[start + 1] in "!?":
                    at = source.index(">", start) + 1
                else:
                    self._add("<")
                    at = start + 1
                continue
            rest = found.end()
            quoted = balanced and ATTRIBUTES.match(source, rest)
            balanced = bool(quoted)
            at = quoted.end() if quoted else source.index(">", rest) + 1
            self._tag(found[0].lower(), source[rest : at - 1])
            if self._raw:
                end = self._raw_end(source, at)
                at, self._raw = end, ""
        self._add(source[at:])

    def _tag(self, name: str, rest: str) -> None:
        if name.startswith("/"):
            self._close(name[1:])
        elif name in RAW and not rest.endswith("/"):
            self._raw = name
        else:
            self._open(name, rest)

    def _raw_end(self, source: str, at: int) -> int:
        """Behind the end tag of the raw element; the end if there is none."""
        if self._raw not in self._open_ended:
            end = re.compile(rf"</{self._raw}\b[^>]*+>", re.I).search(source, at)
            if end:
                return end.end()
            self._open_ended.add(self._raw)
        return len(source)

    def _add(self, text: str) -> None:
        if text:
            self._text.append(text)
            if self._in_link:
                self._linked.append(text)

    def _open(self, name: str, rest: str) -> None:
        if name in INLINE:
            self._in_link += name == "a"
            return
        if name in VOID:
            self._add(" ")
            if name == "hr":
                self._end_block()
            return
        self._end_block()
        top = self._stack[-1][0]
        if top == "p" or (top == name and name in SIBLINGS):
            self._stack.pop()
        names = " ".join(a or b or c for a, b, c in NAMED.findall(rest))
        label = f"{name}.{re.sub(r'[0-9]+', '', names)}"
        above = self._stack[-1][1]
        parent = self.paths[above]
        path = parent.children.get(label)
        if path is None:
            article = parent.inside_article or name in ("article", "main")
            path = parent.children[label] = len(self.paths)
            self.paths.append(
                Path(
                    above,
                    name,
                    article,
                    parent.furniture
                    or name in FURNITURE_TAGS
                    or (name == "header" and not parent.inside_article)
                    or (
                        name not in ("html", "body", "article", "main")
                        and bool(FURNITURE_NAMES.search(names))
                    ),
                )
            )
        self._stack.append((name, path))

    def _close(self, name: str) -> None:
        if name in INLINE:
            self._in_link -= name == "a" and self._in_link > 0
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i][0] == name:
                self._end_block()
                del self._stack[i:]
                return

    def _end_block(self) -> None:
        text = " ".join(entities.unescape("".join(self._text)).split())
        if text:
            at = self._stack[-1][1]
            path = self.paths[at]
            path.blocks += 1
            path.chars += len(text)
            path.punctuation += len(PUNCTUATION.findall(text))
            linked = entities.unescape("".join(self._linked))
            path.linked += min(len(text), len(" ".join(linked.split())))
            self.blocks.append((at, text))
        self._text.clear()
        self._linked.clear()
        self._in_link = 0

    def main_text(self) -> str:
        seen = [
            x
            for x in dict.fromkeys(at for at, _ in self.blocks)
            if not self.paths[x].furniture
        ]
        if not seen:
            return ""
        ratios = [self._ratio(self.paths[x]) for x in seen]
        padded = [ratios[0], *ratios, ratios[-1]]
        smooth = [
            SMOOTH * padded[i] + (1 - 2 * SMOOTH) * r + SMOOTH * padded[i + 2]
            for i, r in enumerate(ratios)
        ]
        least = THRESHOLD * max(smooth)
        chosen = {x for x, r in zip(seen, smooth, strict=True) if r >= least}
        if any(self.paths[x].inside_article for x in chosen):
            chosen = {x for x in chosen if self.paths[x].inside_article}
        # a path's container: its parent, or itself where text stands bare
        tops = {self._container(x) for x in chosen}
        content: dict[int, bool] = {}
        for x in range(len(self.paths)):
            up = self.paths[x].parent
            content[x] = not self.paths[x].furniture and (
                x in tops or (up >= 0 and content[up])
            )
        return "\n\n".join(t for at, t in self.blocks if content[at])

    def _container(self, x: int) -> int:
        up = self.paths[x].parent
        # body and what is above it would take in the whole page
        if up <= 0 or self.paths[up].tag in ("html", "body"):
            return x
        return up

    @staticmethod
    def _ratio(path: Path) -> float:
        text = path.chars / path.blocks
        marks = path.punctuation / path.blocks
        return text * (1 + marks) * (1 - path.linked / path.chars)


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page, one row per row of `pages`.

    A null or empty html gives an empty text; null page_id and url stay null;
    repeated rows stay; other columns are ignored. Broken markup is read as a
    browser would at best: open paragraphs and items end where the next
    begins, unknown end tags are skipped.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        texts = [main_text(x) for x in cols["html"]]
        return {
            "page_id": cols["page_id"],
            "url": cols["url"],
            "text": texts,
            "n_chars": list(map(len, texts)),
        }

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), "html"
    )
    return map_batches(rows, run, RESULT)
