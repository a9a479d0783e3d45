"""The readable body of a page: the part of its tree that most of its prose stands in, and what belongs to it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Names of classes and ids that speak for or against a part, what elements start with, lengths and shares.
AGAINST = re.compile(r"comment|meta|footer|footnote|foot|sidebar|sponsor|promo|related|share|shoutbox|advert|\bad\b|\bads\b|popup|banner|menu|\bnav", re.I)
FOR = re.compile(r"article|body|content|entry|main|page|post|text|blog|story", re.I)
START = {"div": 5, "pre": 3, "td": 3, "blockquote": 3, **dict.fromkeys(("address", "ol", "ul", "dl", "dd", "dt", "li", "form"), -3), **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "th"), -5)}
NAME_WEIGHT, LEAST_CHARS, SIBLING_CHARS, SIBLING_LINKS = 25, 25, 80, 0.25
SILENT = {"script", "style", "noscript", "template", "head", "svg", "iframe"}
SKIPPED = {"nav", "footer", "aside", "form", "button", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


class Part:
    """An element with its texts and parts in order; lengths count what lies below too."""

    __slots__ = ("tag", "name", "above", "items", "chars", "linked", "commas", "blocks", "score")

    def __init__(self, tag: str, name: str, above: "Part | None"):
        self.tag, self.name, self.above = tag, name, above
        self.items: list[Part | str] = []
        self.chars = self.linked = self.commas = 0
        self.blocks = False
        self.score: float | None = None

    def start(self) -> float:
        named = NAME_WEIGHT * (bool(FOR.search(self.name)) - bool(AGAINST.search(self.name)))
        return START.get(self.tag, 0) + named

    def link_share(self) -> float:
        return self.linked / self.chars if self.chars else 0.0

    def texts(self) -> Iterator[str]:
        open_: list[Part | str] = [self]
        while open_:
            item = open_.pop()
            if isinstance(item, str):
                yield item
            else:
                open_ += reversed(item.items)


class Tree(HTMLParser):
    """Parts of a page without what is not shown or is plainly no prose. Ends without a start are passed over, and starts without an end last to the end of
    what they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Part("body", "", None)
        self.parts = [self.root]
        self.silent: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.append(tag)
            return
        if tag in VOID or tag in ("html", "body"):
            return
        held = dict(attrs)
        name = f"{held.get('class') or ''} {held.get('id') or ''}"
        doubtful = AGAINST.search(name) and not FOR.search(name) and tag != "a"
        if tag in SILENT or tag in SKIPPED or doubtful:
            self.silent.append(tag)
            return
        if tag in BLOCKS and self.at.tag == "p":
            self.at = self.at.above
        part = Part(tag, name, self.at)
        if tag in BLOCKS:
            self.at.blocks = True
        self.at.items.append(part)
        self.parts.append(part)
        self.at = part

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
            return
        part, steps = self.at, 0
        while part is not self.root and part.tag != tag and steps < 64:
            part, steps = part.above, steps + 1
        if part is not self.root and part.tag == tag:
            self.at = part.above

    def handle_data(self, data: str) -> None:
        text = " ".join(data.split())
        if not self.silent and text:
            self.at.items.append(text)
            self.at.chars += len(text)
            self.at.commas += text.count(",")


def body_of(html: str) -> str:
    """The readable body as text, its pieces joined by blanks; empty where no paragraph is long enough."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    for part in reversed(tree.parts):  # parts come before what they hold
        if part.tag == "a":
            part.linked = part.chars
        if part.above is not None:
            part.above.chars += part.chars
            part.above.linked += part.linked
            part.above.commas += part.commas
    scored: list[Part] = []
    for part in tree.parts:
        prose = part.tag in ("p", "pre", "td") or part.tag in ("div", "section", "article", "main", "body") and not part.blocks
        if not prose or part.chars < LEAST_CHARS:
            continue
        worth = 1 + part.commas + min(part.chars // 100, 3)
        # a part that holds its prose itself counts as the paragraph and as what holds it
        near = part if part.tag in ("div", "section", "article", "main", "body") else part.above
        for holder, share in ((near, 1.0), (near.above if near is not None else None, 0.5)):
            if holder is not None:
                if holder.score is None:
                    holder.score = holder.start()
                    scored.append(holder)
                holder.score += worth * share
    if not scored:
        return ""
    for part in scored:
        part.score *= 1 - part.link_share()
    best = max(scored, key=lambda p: p.score)
    least = max(10.0, best.score * 0.2)

    def belongs(other) -> bool:
        if isinstance(other, str):
            return False
        if other is best or other.score is not None and other.score >= least:
            return True
        if other.tag != "p":
            return False
        if other.chars > SIBLING_CHARS:
            return other.link_share() < SIBLING_LINKS
        return other.linked == 0 and " ".join(other.texts()).endswith(".")

    kept = [p for p in best.above.items if belongs(p)] if best.above is not None else [best]
    return " ".join(text for part in kept for text in part.texts())


def add_body(pages: DataFrame, column: str = "readable", html: str = "html") -> DataFrame:
    """``pages`` with the readable body of each page's whole ``html`` (null: empty). Pages are parsed one by one in Arrow batches, without a shuffle."""
    schema = T.StructType([*pages.schema.fields, T.StructField(column, T.StringType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [body_of(cell.as_py() or "") for cell in batch.column(batch.schema.get_field_index(html))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, column])

    return pages.mapInArrow(run, schema)
