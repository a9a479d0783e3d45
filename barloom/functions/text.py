"""Text, address and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights and patterns of the article score.
SOURCE_WEIGHTS = {
    "Reuters": 1.0,
    "Bloomberg": 0.95,
    "Financial Times": 0.9,
    "WSJ": 0.9,
    "CNBC": 0.8,
    "The Economist": 0.8,
    "Yahoo Finance": 0.6,
    "MarketWatch": 0.6,
}
DEFAULT_SOURCE_WEIGHT = 0.5
SIGNAL_WEIGHTS = {
    r"\b(surges?|plunges?|spikes?|tumbles?)\b": 0.6,
    r"\b(earnings|EPS|guidance|outlook|downgrade|upgrade)\b": 0.5,
    r"\b(M&A|acquisition|merger|spin[- ]off)\b": 0.4,
    r"\b(SEC filing|lawsuit|investigation)\b": 0.4,
    r"\b(dividend|buyback|split)\b": 0.3,
}
RECENCY_PART, SOURCE_PART, SIGNAL_PART = 0.55, 0.30, 0.15
RECENCY_HOURS = 48.0
UNDATED_RECENCY = 0.2
FAVICON = "https://www.google.com/s2/favicons?domain={host}&sz=128"
FAVICON_MARK = "google.com/s2/favicons"
STATIC_MARK = "gstatic"
REDIRECT_MARK = "news.google.com/rss/articles"
LEAKED_TAIL = "(?i)summarize the following.*$"
SENTIMENT_EDGE = 0.15
ELLIPSIS = "…"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def normal_ticker(c: Column) -> Column:
    return F.upper(F.trim(c))


def squeeze(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normal_source(c: Column) -> Column:
    """Source name with its white space collapsed; an empty name is unknown."""
    return F.when(c != "", squeeze(c))


def title_key(title: Column) -> Column:
    """Hash of the title's lower-case letters, digits and single spaces; equal for titles that differ in punctuation or case."""
    plain = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9 ]+", "")
    return F.md5(F.trim(F.regexp_replace(plain, " +", " ")))


def norm_url(url: Column) -> Column:
    """Address without query and fragment."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), "[?#].*$", "")


def article_id(url: Column, title: Column) -> Column:
    """Hash of the address, or of the title where there is none."""
    return F.sha2(F.coalesce(F.nullif(url, F.lit("")), title, F.lit("")), 256)


def link_id(link: Column) -> Column:
    """First 16 characters of the hash of a feed link."""
    return F.substring(F.sha2(link, 256), 1, 16)


def unwrap_url(url: Column) -> Column:
    """The target inside an aggregator redirect, else the address itself."""
    target = F.nullif(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit("url"))), F.lit(""))
    return F.when(url.contains(REDIRECT_MARK), F.coalesce(target, url)).otherwise(url)


def has_real_image(image: Column) -> Column:
    """A picture that is no site icon."""
    return F.coalesce((image != "") & ~image.contains(FAVICON_MARK) & ~image.contains(STATIC_MARK), F.lit(False))


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def favicon(url: Column) -> Column:
    """Site icon of the address's host; null without a host."""
    before, after = FAVICON.split("{host}")
    host = host_of(url)
    return F.when(host != "", F.concat(F.lit(before), host, F.lit(after)))


def score(published_ts: Column, source: Column, title: Column, as_of: int | Column) -> Column:
    """Weighted recency, source and signal-word score, to 4 digits."""
    as_of = F.lit(as_of) if isinstance(as_of, int) else as_of
    age = F.greatest(F.lit(0.0), (as_of - published_ts) / F.lit(3600.0))
    recency = F.when(
        published_ts.isNotNull() & (published_ts != 0),
        F.greatest(F.lit(0.0), 1.0 - F.least(age / RECENCY_HOURS, F.lit(1.0))),
    ).otherwise(UNDATED_RECENCY)
    weight = F.lit(DEFAULT_SOURCE_WEIGHT)
    for name, value in SOURCE_WEIGHTS.items():
        weight = F.when(source == name, value).otherwise(weight)
    hits = [F.when(F.regexp_like(title, F.lit(f"(?i){p}")), v).otherwise(0.0) for p, v in SIGNAL_WEIGHTS.items()]
    return F.bround(RECENCY_PART * recency + SOURCE_PART * weight + SIGNAL_PART * F.greatest(*hits), 4)


def slug(given: Column, title: Column) -> Column:
    """A given slug lower-cased with dashes for spaces; else one made of the title's letters and digits. Double dashes are replaced once."""
    kept = F.regexp_replace(F.lower(squeeze_ends(title)), r"[^\p{L}\p{N}\s_-]", "")
    made = F.replace(
        F.regexp_replace(F.regexp_replace(kept, r"[\s_]", "-"), "^-+|-+$", ""), F.lit("--"), F.lit("-")
    )
    own = F.replace(F.replace(F.lower(squeeze_ends(given)), F.lit(" "), F.lit("-")), F.lit("--"), F.lit("-"))
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(made, F.lit("")))


def squeeze_ends(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def tags(csv: Column) -> Column:
    """Comma list to an array of trimmed, non-empty tags; null to an empty array."""
    parts = F.transform(F.split(csv, ","), lambda t: F.trim(t))
    return F.coalesce(F.filter(parts, lambda t: t != ""), F.array().cast("array<string>"))


def clip(c: Column, n: int) -> Column:
    """White space collapsed, cut to ``n`` characters with an ellipsis."""
    text = squeeze(F.coalesce(c, F.lit("")))
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(ELLIPSIS))).otherwise(text)


def snippet_or_content(snippet: Column, content: Column, n: int = 200) -> Column:
    """The snippet, or the start of the content where it is blank."""
    cut = F.when(F.length(content) > n, F.concat(F.substring(content, 1, n), F.lit(ELLIPSIS))).otherwise(content)
    return F.coalesce(blank_to_null(snippet), F.nullif(cut, F.lit("")), F.lit(""))


def content_or_snippet(content: Column, snippet: Column) -> Column:
    """The content, or the trimmed snippet where it is empty."""
    return F.coalesce(F.nullif(content, F.lit("")), blank_to_null(snippet))


def tidy_paragraph(c: Column) -> Column:
    """White space collapsed, a leaked instruction dropped, stray spaces before marks removed, closed with a full stop."""
    text = F.trim(F.regexp_replace(squeeze(F.coalesce(c, F.lit(""))), LEAKED_TAIL, ""))
    text = F.replace(F.replace(text, F.lit(" ."), F.lit(".")), F.lit(" ,"), F.lit(","))
    closed = F.concat(F.regexp_replace(text, f"{ELLIPSIS}+$", ""), F.lit("."))
    return F.when(text.rlike(r"[.!?]$") | (text == ""), text).otherwise(closed)


def two_paragraphs(c: Column) -> Column:
    """Summary and outlook: split at the first blank lines, or else half of the sentences each; both end with a full stop."""
    text = squeeze_ends(F.replace(F.coalesce(c, F.lit("")), F.lit(ELLIPSIS), F.lit("...")))
    parts = F.filter(F.transform(F.split(text, "\n\n"), squeeze_ends), lambda p: p != "")
    sentences = F.split(text, r"(?<=[.!?])\s+")
    half = F.greatest(F.lit(1), F.floor(F.size(sentences) / 2)).cast("int")
    halves = F.array(
        F.array_join(F.slice(sentences, F.lit(1), half), " "), F.array_join(F.slice(sentences, half + 1, F.size(sentences)), " ")
    )
    chosen = F.when(F.size(parts) >= 2, F.slice(parts, 1, 2)).otherwise(halves)
    ended = F.transform(chosen, lambda p: F.concat(F.regexp_replace(p, r"[ .]+$", ""), F.lit(".")))
    return F.struct(F.element_at(ended, 1).alias("summary"), F.element_at(ended, 2).alias("outlook"))


def sentiment_label(value: Column) -> Column:
    return (
        F.when(value >= SENTIMENT_EDGE, "Positive").when(value <= -SENTIMENT_EDGE, "Negative").otherwise("Neutral")
    )


def strip_markup(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, "<[^>]+>", " "))


def user_name(email: Column) -> Column:
    """The part of an e-mail address before the at sign."""
    return F.split_part(email, F.lit("@"), F.lit(1))


def like_any(columns: list[Column], term: str) -> Column:
    """Case-insensitive substring in any of the columns; ``%`` and ``_`` in the term are wildcards."""
    found = F.lit(False)
    for c in columns:
        found = found | c.ilike(f"%{term}%")
    return found
