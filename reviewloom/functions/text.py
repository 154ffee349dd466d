"""Text cleaning and extraction as column expressions (no Python per row).

Each pattern starts only where a match can start and never gives back what it has
taken, so that a long run of text takes linear time.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.contracts import ARTICLE_SECTIONS

# White space is the Unicode set plus the four ASCII separators
# U+001C..U+001F; then the characters of a mail address.
_BLANKS = r"\s\x1c-\x1f"
_SPACE, _SOLID = f"[{_BLANKS}]", f"[^{_BLANKS}]"
_MAIL = r"[\p{L}\p{N}_.\-]"

# What the cleaning recipes remove or mask.
TAG = r"<[^>]++>"
LINK_START = f"http{_SOLID}++|www{_SOLID}++"
FULL_LINK = f"https?://{_SOLID}++"
MAIL_RUN = f"(?<!{_SOLID}){_SOLID}[^@{_BLANKS}]*+@{_SOLID}++"
MAIL_ADDRESS = f"(?<!{_MAIL}){_MAIL}++@{_MAIL}++"
NON_LETTERS = "[^a-zA-Z]++"


def _sub(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, F.lit("(?U)" + pattern), F.lit(replacement))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that a later filter on it does not compute it again.

    A filter on a projected column is normally pushed below the projection, which
    repeats the expression; it stays above a generated one.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.inline(F.array(F.struct(value.alias(name)))))


def strip_space(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return _sub(text, f"^{_SPACE}+|{_SPACE}+$", "")


def words(text: Column) -> Column:
    """Non-empty pieces between runs of white space."""
    return F.filter(F.split(text, f"(?U){_SPACE}+"), lambda w: w != "")


def count_words(text: Column) -> Column:
    return F.size(words(text))


def has_words(text: Column, n: int) -> Column:
    """Are there at least ``n`` words? Looks no further than the n-th."""
    if n <= 0:
        return text.isNotNull()
    return text.rlike(f"(?U)^{_SPACE}*+(?:{_SOLID}++{_SPACE}++){{{n - 1}}}{_SOLID}")


def first_words(text: Column, n: int) -> Column:
    """The first ``n`` words; the rest of the text is not taken apart."""
    pieces = F.split(strip_space(text), f"(?U){_SPACE}+", n + 1)
    return F.filter(F.slice(pieces, 1, n), lambda w: w != "")


def _sub_where(text: Column, marks: list[str], pattern: str, replacement: str) -> Column:
    """Substitute in texts that hold one of ``marks``, without which nothing can match."""
    marked = lambda t: reduce(operator.or_, [F.contains(t, F.lit(m)) for m in marks])
    # the one-item list lets the text be computed once and used three times
    return F.get(F.transform(F.array(text), lambda t: F.when(marked(t), _sub(t, pattern, replacement)).otherwise(t)), F.lit(0))


def _plain_lower(text: Column) -> Column:
    """Lower case without markup, links and mail addresses."""
    out = F.lower(text)
    out = _sub_where(out, ["<"], TAG, " ")
    out = _sub_where(out, ["http", "www"], LINK_START, "")
    return _sub_where(out, ["@"], MAIL_RUN, "")


def normalized_words(text: Column) -> Column:
    """The words of :func:`normalize_text`, taken straight from the text."""
    return F.regexp_extract_all(_plain_lower(text), F.lit("[a-zA-Z]++"), F.lit(0))


def normalize_text(text: Column, strict: bool = False) -> Column:
    """Lower-case letters only: markup, links, mail addresses and symbols go.

    The order of the steps matters: links end at white space, so tags must have
    become spaces before, and mail addresses must go before their ``@`` does. A run
    of anything but letters, white space included, ends up as one space.
    ``strict`` turns a null into an error instead of a null.
    """
    out = F.trim(_sub(_plain_lower(text), NON_LETTERS, " "))
    if strict:
        return F.when(text.isNull(), F.raise_error(F.lit("text must be a string"))).otherwise(out)
    return out


def redact_text(text: Column) -> Column:
    """Keep the wording; mask links and mail addresses, drop tags."""
    out = _sub(text, TAG, " ")
    out = _sub(out, FULL_LINK, "[URL]")
    out = _sub(out, MAIL_ADDRESS, "[EMAIL]")
    return F.trim(_sub(out, f"{_SPACE}++", " "))


# The entities decoded in headings; the ampersand comes last so that
# an escaped entity is not decoded twice.
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]

TITLE_SELECTORS = (("span", "productTitle"), ("h1", "title"))


def _element_text(html: Column, tag: str, element_id: str | None) -> Column:
    attrs = r"(?:\s[^>]*)?" if element_id is None else rf"""\s(?:[^>]*\s)?id\s*=\s*["']?{element_id}["']?(?:\s[^>]*)?"""
    inner = F.regexp_extract(html, rf"(?is)<{tag}{attrs}>(.*?)</{tag}\s*>", 1)
    inner = F.regexp_replace(inner, r"<[^>]+>", "")
    for entity, char in _ENTITIES:
        inner = F.replace(inner, F.lit(entity), F.lit(char))
    return F.nullif(strip_space(inner), F.lit(""))


def product_title(html: Column, asin: Column, selectors=TITLE_SELECTORS) -> Column:
    """Heading text of the first selector that has any, else ``Product <asin>``."""
    found = [_element_text(html, tag, element_id) for tag, element_id in selectors]
    return F.coalesce(*found, F.concat(F.lit("Product "), asin.cast("string")))


# The three forms in which an article names a product.
PRODUCT_PATTERNS = [
    r"\d\.\s*([^.]+?)(?=\s*Key Strengths:)",
    r"Product:\s*([^\n]+)",
    r"•\s*([^.]+?)(?=\s*Key Strengths:)",
]


def extract_products(text: Column) -> Column:
    """Distinct product names in an article, all three forms together."""
    found = [F.regexp_extract_all(text, F.lit("(?iuU)" + p), F.lit(1)) for p in PRODUCT_PATTERNS]
    return F.array_distinct(F.transform(F.concat(*found), strip_space))


def required_sections(text: Column, sections=ARTICLE_SECTIONS) -> Column:
    """The section titles found in the text, letter case ignored."""
    low = F.lower(text)
    hits = [F.when(F.contains(low, F.lit(s.lower())), F.lit(s)) for s in sections]
    return F.array_compact(F.array(*hits))


def header_lines(text: Column) -> Column:
    """How many lines end in a colon; lines are not trimmed first."""
    return F.size(F.filter(F.split(text, "\n"), lambda line: line.endswith(":")))
