"""Main text of pages: boosted trees over the nodes of the document tree, decoded so that no kept node lies under a dropped one."""

from __future__ import annotations

import html
import random
import re
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import boosting
from barloom.llm.common import columns, map_batches

#: Pages, on average, that the trees are fitted on, and restyled copies of each.
SAMPLE_PAGES, COPIES = 150, 3

#: fixed values: kinds of elements
GROUPS = {
    "main": "article main",
    "nav": "nav menu",
    "aside": "aside ins",
    "header": "header hgroup",
    "footer": "footer address",
    "form": "form fieldset dialog",
    "list": "ul ol li dl dt dd",
    "heading": "h1 h2 h3 h4 h5 h6",
    "paragraph": "p blockquote pre figcaption",
    "table": "table thead tbody tfoot tr td th caption",
    "box": "html body div section center figure details summary hr",
}
TAG_GROUP = {tag: i for i, tags in enumerate(GROUPS.values()) for tag in tags.split()}
RAW = frozenset("script style title textarea noscript template iframe svg math select button".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: an element of the key ends an open one of these up to the nearest of the last ones
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr td th", "table")}
#: fixed values: words of class, id and role that tell what an element is for
TOKENS = {
    "content": "content article post story entry body text main page",
    "ad": "ad ads advert advertisement adsbygoogle sponsor sponsored promo promoted banner dfp",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs toc pager pagination",
    "foot": "footer foot bottom copyright legal",
    "head": "header masthead top logo",
    "side": "sidebar side aside widget related recommended more teaser popular",
    "notice": "cookie cookies consent notice popup modal alert newsletter subscribe overlay dialog gdpr",
    "comment": "comment comments reply replies discussion disqus respond",
    "share": "share social follow form search login signup",
}
TOKEN_GROUP = {word: i for i, words in enumerate(TOKENS.values()) for word in words.split()}
#: marks that restyled copies carry for their labels; never a feature
KEEP, DROP = "zkeep", "zdrop"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(>|\Z|(?=<))", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_STOPS = re.compile(r"[.,;:!?]")


class Page:
    """The block elements of a page in order, their text, and what of it stands in links."""

    def __init__(self, source: str):
        self.tag: list[str] = ["html"]
        self.parent, self.depth, self.words, self.mark = [-1], [0], [0], [""]
        self.own, self.linked, self.stops, self.tags, self.at = [0], [0], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # (node, number of the run of inline text, text)
        stack: list[tuple[str, int]] = [("html", 0)]
        open_at: dict[str, list[int]] = {"html": [0]}
        blocks = [0]  # places of open block elements
        run = 0

        def end(place: int) -> None:
            while len(stack) > place:
                open_at[stack.pop()[0]].pop()
            while blocks[-1] >= place:
                blocks.pop()

        def last(tags) -> int:
            return max((open_at[t][-1] for t in tags if open_at.get(t)), default=-1)

        position = 0
        while True:
            m = _TOKEN.search(source, position)
            text = source[position : m.start() if m else len(source)]
            node = stack[-1][1]
            if text:
                text = html.unescape(text) if "&" in text else text
                self.pieces.append((node, run, text))
                size = len(text)
                self.own[node] += size
                self.stops[node] += len(_STOPS.findall(text))
                if open_at.get("a"):
                    self.linked[node] += size
            if not m:
                break
            position = m.end()
            closing, name, attributes, ended = m.groups()
            if not name or ended != ">" and position >= len(source):
                continue
            name = name.lower()
            self.tags[node] += 1
            block = name in TAG_GROUP
            if closing:
                place = last((name,))
                if block:
                    run += 1
                    if place > 0:
                        end(place)
                elif place > blocks[-1]:
                    end(place)
                continue
            if name in RAW:
                close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(source, position)
                position = close.end() if close else len(source)
                continue
            if name == "br":
                run += 1
            if block:
                run += 1
                if name in ENDS_P and last(("p",)) > last(("td", "th", "caption", "table")):
                    end(last(("p",)))
                if name in ENDS:
                    ends, within = (x.split() for x in ENDS[name])
                    if last(ends) > last(within):
                        end(min(open_at[t][-1] for t in ends if open_at.get(t) and open_at[t][-1] > last(within)))
                words, mark = 0, ""
                for value in _ATTRIBUTE.findall(attributes) if attributes else ():
                    for word in _WORD.findall(value.lower()):
                        if word in TOKEN_GROUP:
                            words |= 1 << TOKEN_GROUP[word]
                        elif word in (KEEP, DROP):
                            mark = word
                parent = stack[-1][1]
                node = len(self.tag)
                for column, value in zip(
                    (self.tag, self.parent, self.depth, self.words, self.mark, self.own, self.linked, self.stops, self.tags, self.at),
                    (name, parent, self.depth[parent] + 1, words, mark, 0, 0, 0, 0, position),
                    strict=True,
                ):
                    column.append(value)
            else:
                node = stack[-1][1]
            if name not in VOID and not attributes.endswith("/"):
                open_at.setdefault(name, []).append(len(stack))
                if block:
                    blocks.append(len(stack))
                stack.append((name, node))
        self.length = max(1, len(source))

    def features(self) -> np.ndarray:
        """One row per node: kind, words of the attributes, own and inherited, and statistics of the subtree, the depth and the siblings."""
        n = len(self.tag)
        parent = np.array(self.parent)
        total, linked, stops, tags = (list(x) for x in (self.own, self.linked, self.stops, self.tags))
        children, index = [0] * n, [0] * n
        for i in range(1, n):
            index[i] = children[parent[i]]
            children[parent[i]] += 1
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            total[p] += total[i]
            linked[p] += linked[i]
            stops[p] += stops[i]
            tags[p] += tags[i]
        group = [1 << TAG_GROUP[t] for t in self.tag]
        above_group, above_words = list(group), list(self.words)
        for i in range(1, n):
            above_group[i] |= above_group[self.parent[i]]
            above_words[i] |= above_words[self.parent[i]]
        beside = np.array([total[p] if p >= 0 else total[0] for p in self.parent], float)
        count = np.array([children[p] if p >= 0 else 1 for p in self.parent], float)
        total_, linked_, stops_, tags_ = (np.array(x, float) for x in (total, linked, stops, tags))
        numbers = [
            np.array(self.depth, float),
            np.array(children, float),
            np.log1p(total_),
            np.log1p(np.array(self.own, float)),
            linked_ / np.maximum(total_, 1),
            total_ / (1 + tags_),
            stops_ / np.maximum(total_, 1),
            total_ / max(1, total[0]),
            np.array(index, float),
            count,
            np.log1p(beside / count),
            total_ / np.maximum(beside, 1),
            np.array(self.at, float) / self.length,
        ]
        bits = [np.array(x)[:, None] >> np.arange(k) & 1 for x, k in ((group, len(GROUPS)), (above_group, 6), (self.words, len(TOKENS)), (above_words, len(TOKENS)))]
        return np.concatenate([np.stack(numbers, axis=1), *bits], axis=1)

    def labels(self) -> np.ndarray:
        """Of a training page: 1 for nodes in the main text and for what holds them. An article counts as marked."""
        n = len(self.tag)
        state, keep = [False] * n, np.zeros(n)
        for i in range(1, n):
            kind = GROUP_NAMES[TAG_GROUP[self.tag[i]]]
            inside = state[self.parent[i]]
            mark = self.mark[i] or (KEEP if kind == "main" else DROP if kind in ("nav", "aside", "footer", "form") else "")
            state[i] = mark == KEEP or inside and mark != DROP
        for i in range(n - 1, -1, -1):
            if state[i] or keep[i]:
                keep[i] = 1
                if i:
                    keep[self.parent[i]] = 1
        return keep

    def decode(self, p: np.ndarray) -> list[bool]:
        """The likeliest choice in which everything under a dropped node is dropped, a node counting more the more text it holds."""
        p = np.clip(p, 1e-6, 1 - 1e-6)
        weight = 1 + np.log1p(np.array(self.own, float))
        drop, keep = (np.log(1 - p) * weight).tolist(), (np.log(p) * weight).tolist()
        n = len(drop)
        kept = [True] * n
        for i in range(n - 1, -1, -1):
            kept[i] = i == 0 or keep[i] > drop[i]
            if i:
                drop[self.parent[i]] += drop[i]
                keep[self.parent[i]] += max(keep[i], drop[i])
        for i in range(1, n):
            kept[i] = kept[i] and kept[self.parent[i]]
        return kept

    def text(self, kept: list[bool]) -> str:
        runs = ("".join(x[2] for x in run) for _, run in groupby((x for x in self.pieces if kept[x[0]]), key=lambda x: x[:2]))
        return " ".join(" ".join(runs).split())


GROUP_NAMES = tuple(GROUPS)
_ARTICLE = re.compile(r"<article[^>]*>(.*?)(?:</article>|\Z)", re.S | re.I)


def restyled(source: str, seed: int) -> str | None:
    """The article of a page within another layout, with marks for the labels; None where a page has no article.

    Menus, notices, adverts, forms, comments and the like are made from words and sentences of the page itself.
    """
    found = _ARTICLE.search(source)
    if not found:
        return None
    rng = random.Random(seed)
    inner = found.group(1)
    words = re.sub(r"<[^>]*>", " ", source).split() or ["x"]

    def some(low: int, high: int) -> str:
        at = rng.randrange(len(words))
        return html.escape(" ".join(words[at : at + rng.randint(low, high)]), quote=False)

    def item(low: int, high: int) -> str:
        return "".join(f'<li><a href="#">{some(1, 3)}</a></li>' for _ in range(rng.randint(low, high)))

    def box(names: str, content: str) -> str:
        name = rng.choice(names.split(","))
        if name[0] == "<":
            return f'{name} data-x id="{DROP}">{content}</{name[1:]}>'
        tag = rng.choice(["div", "div", "section"])
        return f'<{tag} {rng.choice(["class", "id"])}="{name} {DROP}">{content}</{tag}>'

    def comments() -> str:
        return f"<h3>{some(1, 2)}</h3>" + "".join(f'<div class="comment"><b>{some(1, 2)}</b><p>{some(5, 60)}</p></div>' for _ in range(rng.randint(1, 4)))

    before = [
        lambda: box("<header,header,masthead,top-bar", f'<a href="/">{some(1, 3)}</a> {some(0, 4)}'),
        lambda: box("<nav,menu,nav-main,breadcrumbs", f"<ul>{item(3, 9)}</ul>"),
        lambda: box("ad,advert,sponsored,banner-ad,promo", f"<p>{some(4, 30)}</p>" if rng.random() < 0.5 else some(4, 30)),
        lambda: box("cookie-notice,consent,popup,alert notice", f"<p>{some(5, 30)}</p>"),
        lambda: box("<form,search-form,newsletter", f"<p>{some(2, 12)}</p>"),
    ]
    after = [
        lambda: box("comments,comment-list,discussion", comments()),
        lambda: box("<aside,sidebar,related,widget,popular", f"<h3>{some(1, 3)}</h3><ul>{item(2, 7)}</ul><p>{some(0, 25)}</p>"),
        lambda: box("share,social", f"<ul>{item(2, 5)}</ul>"),
        lambda: box("<footer,footer,legal,copyright", f"&copy; {some(3, 25)}"),
        lambda: box("ad,sponsor,advertisement", some(4, 30)),
        lambda: box("<form,newsletter,login-form", f"<p>{some(2, 12)}</p>"),
    ]
    if rng.random() < 0.4:
        cut = inner.find("<p>", len(inner) // 2)
        if cut > 0:
            inner = inner[:cut] + rng.choice([*before[2:4], *after[1:3]])() + inner[cut:]
    name, kind = rng.choice([("article", ""), ("main", ""), ("div", "content"), ("div", "post-body"), ("section", "story"), ("div", "main"), ("div", "c12"), ("div", "wrap")])
    main = f'<{name} class="{kind} {KEEP}">{inner}</{name}>'
    parts = [f() for f in before if rng.random() < 0.6] + [main] + [f() for f in after if rng.random() < 0.6]
    return f"<html><head><title>{some(1, 5)}</title></head><body>{''.join(parts)}</body></html>"


def fit(pages: DataFrame, id_col: str, html_col: str, sample_pages: int = SAMPLE_PAGES, copies: int = COPIES) -> boosting.Booster:
    """Trees fitted on the nodes of a hash sample of ``sample_pages`` pages on average and of restyled copies of them."""
    rate = min(1.0, sample_pages / max(1, pages.count()))
    rows = pages.select(F.xxhash64(F.col(f"`{id_col}`"), F.lit(5)).alias("h"), F.col(f"`{html_col}`").alias("html"))
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) <= int(rate * (1 << 20))).where("html is not null")

    def run(batches):
        for batch in batches:
            x, y = [], []
            for source in batch.column(1).to_pylist():
                seed = zlib.crc32(source.encode())
                for version in [source if _ARTICLE.search(source) else None, *[restyled(source, seed + k) for k in range(copies)]]:
                    if version is not None:
                        page = Page(version)
                        x += page.features().tolist()
                        y += page.labels().tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64())], ["x", "y"])

    found = sorted(map(tuple, map_batches(sample, run, "x array<double>, y double").collect()))
    if not found:
        return boosting.Booster(10.0, 0.0, [])
    return boosting.fit(np.array([r[0] for r in found]), np.array([r[1] for r in found]), trees=30, depth=5, bins=24)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, copies: int = COPIES
) -> DataFrame:
    """(id, url, text, n_chars) per page: the text of the nodes that the trees keep, in page order.

    Character references are decoded and white space, block edges and line breaks become one blank. Scripts, styles, comments in
    the source and controls have no text. Unclosed elements end where HTML ends them; a tag that the end of the page cuts off is left
    out.

    A null or empty page has the empty text. When no page of the sample has an article to learn from, all nodes are kept. Repeated
    rows, null ids and null addresses each return their row. An empty table gives no rows. Whole pages are read; other columns are not.
    """
    model = fit(pages, id_col, html_col, sample_pages, copies)
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches):
        for batch in batches:
            read = [Page(s or "") for s in batch.column(2).to_pylist()]
            out: list[str] = []
            for at in range(0, len(read), 200):
                part = read[at : at + 200]
                edges = np.cumsum([len(p.tag) for p in part])[:-1]
                scores = np.split(model.predict(np.concatenate([p.features() for p in part])), edges)
                out += [p.text(p.decode(s)) for p, s in zip(part, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], [id_col, url_col, "text", "n_chars"]
            )

    return map_batches(columns(pages, id_col, url_col, html_col), run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars bigint")
