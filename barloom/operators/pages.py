"""Main text and lead picture of fetched pages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.readable import add_body

# A text shorter than this is looked for in the next place; names of pictures that are no content.
ENOUGH = 400
BAD_IMAGE = r"(sprite|favicon|logo|brand|icon|placeholder|1x1|blank|data:image)"
# Where pages name their picture, in order of preference (tag, attribute, value, attribute with the address).
NAMED_IMAGES = (
    ("meta", "property", "og:image", "content"),
    ("meta", "property", "og:image:url", "content"),
    ("meta", "name", "twitter:image", "content"),
    ("meta", "name", "twitter:image:src", "content"),
    ("link", "rel", "image_src", "href"),
    ("meta", "itemprop", "image", "content"),
    ("meta", "name", "parsely-image", "content"),
    ("meta", "name", "thumbnail", "content"),
)
IMAGE_ATTRIBUTES = ("data-src", "data-original", "srcset", "src")
# Character references by name; the first line also counts without a semicolon.
OLD_NAMES = {"nbsp": "\xa0", "copy": "©", "reg": "®", "middot": "·", "laquo": "«", "raquo": "»", "quot": '"', "lt": "<", "gt": ">"}
NAMES = {"apos": "'", "hellip": "…", "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•", "euro": "€", "trade": "™"}

_SILENT = r"(?is)<!--.*?(?:-->|\z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\z)"
_TAG = r"(?s)<[/!?a-zA-Z][^>]*(?:>|\z)"


def _each(items: Column, fn) -> Column:
    return F.transform(items, fn)


def _once(value: Column, fn) -> Column:
    """``fn`` of a value that it may name several times, worked out once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


_ENDED = "|".join(NAMES)
_OLD = "|".join([*OLD_NAMES, "amp"])
_REFERENCE = rf"&(?:#[0-9]{{1,8}};|#[xX][0-9a-fA-F]{{1,7}};|(?:{_ENDED});|(?:{_OLD});?)"


def _character(ref: Column) -> Column:
    """The character of one reference; what is no character is U+FFFD."""
    code = F.when(ref.rlike("^&#[xX]"), F.conv(F.regexp_extract(ref, "[0-9a-fA-F]+(?=;)", 0), 16, 10)).otherwise(F.regexp_extract(ref, "[0-9]+", 0)).cast("int")
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    numbered = F.when(bad, "\ufffd").otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    names = F.create_map(*[F.lit(x) for pair in {**NAMES, **OLD_NAMES, "amp": "&"}.items() for x in pair])
    return F.when(ref.startswith("&#"), numbered).otherwise(names[F.regexp_extract(ref, "[a-zA-Z]+", 0)])


def decoded(text: Column) -> Column:
    """Character references as characters. The text is taken apart at its references and put together again, so nothing is decoded twice and the work
    does not grow with the number of different references."""

    def apart(t: Column) -> Column:
        pieces = F.regexp_extract_all(t, F.lit(f"{_REFERENCE}|[^&]+|&"), F.lit(0))
        return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(f"^{_REFERENCE}$"), _character(p)).otherwise(p)), "")

    return _once(text, lambda t: F.when(F.contains(t, F.lit("&")), apart(t)).otherwise(t))


def plain(markup: Column) -> Column:
    """Markup to text: silent elements and tags to blanks, references decoded, white space collapsed."""
    return _spoken(F.regexp_replace(markup, _SILENT, " "))


def _spoken(shown: Column) -> Column:
    """As :func:`plain`, of markup without silent elements."""
    return F.trim(F.regexp_replace(decoded(F.regexp_replace(shown, _TAG, " ")), r"[\s\x0B\u00a0]+", " "))


def _inner(markup: Column, tag: str) -> Column:
    """What stands in the first element of a kind, to the end of the page where it is never closed."""
    return F.regexp_extract(markup, rf"(?is)<{tag}\b[^>]*>(.*?)(?:</{tag}\s*>|\z)", 1)


def _longer(a: Column, b: Column) -> Column:
    return F.when(F.length(b) > F.length(a), b).otherwise(a)


def _nodes(html: Column) -> Column:
    """The objects of a page's structured data: each document, the members of a list or a graph, and the main entity."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script\s*>"), F.lit(1))

    def members(document: Column) -> Column:
        listed = [F.from_json(x, "array<string>") for x in (document, F.get_json_object(document, "$.@graph"))]
        entity = F.array(F.get_json_object(document, "$.mainEntity"))
        return F.concat(F.array(document), *[F.coalesce(x, F.array().cast("array<string>")) for x in listed], entity)

    return F.filter(F.flatten(_each(scripts, members)), lambda n: n.isNotNull())


def _body(nodes: Column) -> Column:
    """The longest article text of the structured data."""

    def of(node: Column) -> Column:
        kind = F.lower(F.coalesce(F.get_json_object(node, "$.@type"), F.get_json_object(node, "$.type"), F.lit("")))
        return F.when(F.contains(kind, F.lit("article")), F.trim(F.coalesce(F.get_json_object(node, "$.articleBody"), F.lit("")))).otherwise("")

    return F.reduce(_each(nodes, of), F.lit(""), _longer)


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)(?<![\w-]){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.trim(F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]))


def _tags(html: Column, names: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{names})\b[^>]*>"), F.lit(0))


def _node_images(node: Column) -> Column:
    value = F.coalesce(F.get_json_object(node, "$.image"), F.lit(""))
    listed = F.coalesce(F.when(value.startswith("["), F.from_json(value, "array<string>")), F.array(value))

    def address(v: Column) -> Column:
        return F.when(v.startswith("{"), F.coalesce(F.get_json_object(v, "$.url"), F.get_json_object(v, "$.contentUrl"), F.lit(""))).otherwise(v)

    return _each(listed, address)


def absolute(address: Column, base: Column) -> Column:
    """An address of a page at ``base`` as a full one."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][\w+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^([a-zA-Z][\w+.-]*://[^/]*/(?:.*/)?)", 1)
    return (
        F.when(address.rlike(r"^[a-zA-Z][\w+.-]*:"), address)
        .when(address.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-zA-Z][\w+.-]*:)", 1), address))
        .when(address.startswith("/"), F.concat(origin, address))
        .otherwise(F.concat(F.when(folder != "", folder).when(origin != "", F.concat(origin, F.lit("/"))).otherwise(""), F.regexp_replace(address, r"^\./", "")))
    )


def lead_image(html: Column, base: Column, bad: str = BAD_IMAGE) -> Column:
    """The first picture a page names, in its head, its structured data or its body, that ``bad`` does not match."""

    def named(tag: str, attribute: str, value: str, address: str) -> Column:
        wanted = F.filter(_tags(html, tag), lambda t: F.array_contains(F.split(F.lower(_attribute(t, attribute)), r"\s+"), value))
        return _each(wanted, lambda t: _attribute(t, address))

    found = [named(*where) for where in NAMED_IMAGES]
    found.append(F.flatten(_each(_nodes(html), _node_images)))

    def source(t: Column) -> Column:
        first = [F.regexp_extract(_attribute(t, a), r"^([^\s,]+)", 1) if a == "srcset" else _attribute(t, a) for a in IMAGE_ATTRIBUTES]
        return F.coalesce(*[F.nullif(x, F.lit("")) for x in first], F.lit(""))

    found.append(_each(_tags(html, "img|amp-img"), source))
    full = _each(F.filter(F.concat(*found), lambda a: F.trim(a) != ""), lambda a: absolute(decoded(F.trim(a)), base))
    return F.get(F.filter(full, lambda a: ~a.startswith("data:") & ~a.rlike(f"(?i){bad}")), 0)


def main_text(html: Column, enough: int = ENOUGH, readable: Column | None = None) -> Column:
    """Text from the readable body where one is given, from structured data, then from the article or main element, then from all paragraphs: each next place is asked only
    while the text has fewer than ``enough`` characters, and the longer one stays."""

    def container(shown: Column) -> Column:
        return _spoken(F.when(shown.rlike(r"(?i)<article\b"), _inner(shown, "article")).otherwise(_inner(shown, "main")))

    def paragraphs(shown: Column) -> Column:
        return _spoken(F.array_join(F.regexp_extract_all(shown, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)(?=</p\s*>|<p[\s>]|\z)"), F.lit(1)), " "))

    def from_markup(text: Column) -> Column:
        def of(shown: Column) -> Column:
            first = _once(container(shown), lambda c: _longer(text, c))
            return _once(first, lambda t: F.when(F.length(t) >= enough, t).otherwise(_once(paragraphs(shown), lambda p: _longer(t, p))))

        return F.when(F.length(text) >= enough, text).otherwise(_once(F.regexp_replace(html, _SILENT, " "), of))

    told = _body(_nodes(html))
    if readable is not None:
        told = _once(readable, lambda r: F.when(F.length(r) >= enough, r).otherwise(_once(told, lambda b: _longer(r, b))))
    return _once(told, from_markup)


def extract(
    df: DataFrame, key: str = "page_id", max_chars: int | None = None, enough: int = ENOUGH, bad: str = BAD_IMAGE, readable: bool = False
) -> DataFrame:
    """(key, url, title, text, image) of every page (``key``, ``url``, ``html``).

    Texts are whole unless ``max_chars`` cuts them; ``bad`` is the pattern of pictures that do not count. ``readable`` looks for the text in the page's readable
    body first, for which pages pass through Python; the other places are column expressions.
    """
    html = F.coalesce("html", F.lit(""))
    if readable:
        df = add_body(df.select(key, "url", "html"), "_readable")
    text = main_text(html, enough, F.col("_readable") if readable else None)
    return df.select(
        key,
        "url",
        F.nullif(plain(_inner(html, "title")), F.lit("")).alias("title"),
        F.nullif(text if max_chars is None else F.substring(text, 1, max_chars), F.lit("")).alias("text"),
        lead_image(html, F.coalesce("url", F.lit("")), bad).alias("image"),
    )
