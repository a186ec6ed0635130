"""Extraction from HTML text held in a column.

Each function is a regular-expression scan inside the JVM. Patterns use neither
look-around nor back-references. ``element`` builds the usual pattern, "the text
after an opening tag whose attribute contains a word".
"""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column, functions as F

from tidemark.functions._columns import ColumnOrName, as_col

#: All named references of HTML that end in a semicolon, except the ampersand's own.
NAMED_REFERENCES = {f"&{name}": char for name, char in html5.items() if name.endswith(";") and char != "&"}


def without_hidden(html: ColumnOrName) -> Column:
    """The page less its comments, scripts and styles, whose text is no part of it."""
    out = as_col(html)
    for pattern in (r"(?s)<!--.*?(?:-->|\z)", r"(?is)<script\b.*?(?:</script\s*>|\z)", r"(?is)<style\b.*?(?:</style\s*>|\z)"):
        out = F.regexp_replace(out, pattern, "")
    return out


def unescape_html(text: ColumnOrName) -> Column:
    """Resolve character references, named and numeric."""
    text = as_col(text)
    names = F.from_json(F.lit(json.dumps(NAMED_REFERENCES)), "map<string,string>")  # folded to a constant
    used = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&[A-Za-z][A-Za-z0-9]{1,31};"), F.lit(0)))
    resolved = F.reduce(used, text, lambda done, name: F.replace(done, name, F.coalesce(F.try_element_at(names, name), name)))
    resolved = _resolve_numbers(resolved, r"&#([0-9]{1,7});", 10)
    resolved = _resolve_numbers(resolved, r"&#[xX]([0-9a-fA-F]{1,6});", 16)
    resolved = F.replace(resolved, F.lit("&amp;"), F.lit("&"))
    # Most texts hold no reference at all and skip the work.
    return F.when(text.contains("&"), resolved).otherwise(text)


def _resolve_numbers(text: Column, pattern: str, base: int) -> Column:
    def resolve(done: Column, reference: Column) -> Column:
        digits = F.regexp_extract(reference, pattern, 1)
        utf32 = F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0"))
        code = F.conv(digits, base, 10).cast("bigint")
        surrogate = code.between(0xD800, 0xDFFF)
        char = F.when(code.between(1, 0x10FFFF) & ~surrogate, F.decode(utf32, "UTF-32")).otherwise(reference)
        return F.replace(done, reference, char)

    references = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.reduce(references, text, resolve)


def element(tag: str, attribute: str | None = None, contains: str = "") -> str:
    """Pattern of an opening tag, optionally with a word inside an attribute."""
    if attribute is None:
        return rf"(?s)(?i:<{tag}\b)[^>]*>"
    return _with_attribute(tag, attribute, contains) + "[^>]*>"


def _with_attribute(tag: str, attribute: str, contains: str) -> str:
    """An opening tag up to the end of an attribute, however that is quoted."""
    w = re.escape(contains)
    quoted = rf"""(?:"[^"]*{w}[^"]*"|'[^']*{w}[^']*'|[^\s"'>]*{w}[^\s"'>]*)"""
    return rf"(?s)(?i:<{tag}\b[^>]*\s{re.escape(attribute)}\s*=\s*){quoted}"


def first_text(html: ColumnOrName, pattern: str) -> Column:
    """Group 1 of the first match; NULL when nothing or only '' matched."""
    return F.nullif(F.regexp_extract(as_col(html), pattern, 1), F.lit(""))


def all_text(html: ColumnOrName, pattern: str) -> Column:
    """Group 1 of every match, in page order."""
    return F.regexp_extract_all(as_col(html), F.lit(pattern), F.lit(1))


def first_attribute(html: ColumnOrName, tag: str, attribute: str) -> Column:
    """Attribute of the first ``tag`` on the page; NULL if that tag lacks it."""
    return attribute_of(F.regexp_extract(as_col(html), element(tag), 0), attribute)


def attribute_of(opening_tag: ColumnOrName, attribute: str) -> Column:
    """Value of an attribute in the text of one opening tag, its references resolved."""
    name = rf"(?i:\s{re.escape(attribute)}\s*=\s*)"
    return unescape_html(
        F.coalesce(
            first_text(opening_tag, name + r'"([^"]*)"'),
            first_text(opening_tag, name + r"'([^']*)'"),
            first_text(opening_tag, name + r"""([^\s"'>]+)"""),
        )
    )


def child_text(html: ColumnOrName, opening: str, tag: str, child: str) -> Column:
    """Text of the first ``child`` inside an element that the pattern ``opening`` opens.

    An element is first cut out, up to its end, the next of its kind or the
    page's end, by one lazy step that does not recurse; the child is looked for
    in the pieces.
    """
    pieces = F.regexp_extract_all(as_col(html), F.lit(opening + rf"(?s:(.*?))(?i:</{tag}\s*>|<{tag}\b|\z)"), F.lit(1))
    texts = F.transform(pieces, lambda piece: first_text(piece, rf"(?i:<{child}\b)[^>]*>([^<]*)"))
    return F.get(F.filter(texts, lambda x: x.isNotNull()), F.lit(0))


def struct_list(html: ColumnOrName, pattern: str, names: tuple[str, ...]) -> Column:
    """One struct per match, field *i* holding group *i*."""
    html = as_col(html)
    groups = [
        F.regexp_extract_all(html, F.lit(pattern), F.lit(i)).alias(name)
        for i, name in enumerate(names, start=1)
    ]
    return F.arrays_zip(*groups)


def ordered_structs(items: ColumnOrName, order_field: str = "order") -> Column:
    """Add each struct's position in its list, counted from 1."""
    return F.transform(
        as_col(items), lambda item, i: item.withField(order_field, i + F.lit(1))
    )


def concat_or_null(*lists: ColumnOrName) -> Column:
    """Lists joined end to end; NULL instead of an empty result."""
    joined = F.concat(*[F.coalesce(as_col(x), F.array()) for x in lists])
    return F.when(F.size(joined) > 0, joined)


def embedded_json(html: ColumnOrName, marker: str, nth: int = 1) -> Column:
    """Body of the ``nth`` script (from 1) whose data-target is ``marker``."""
    pattern = element("script", "data-target", marker) + r"(.*?)</script>"
    return F.try_element_at(all_text(html, pattern), F.lit(nth))


def first_link_containing(html: ColumnOrName, word: str) -> Column:
    """First anchor target on the page that contains ``word``."""
    return attribute_of(F.regexp_extract(as_col(html), _with_attribute("a", "href", word), 0), "href")


def network_link(
    html: ColumnOrName,
    word: str,
    domain: ColumnOrName | None = None,
    home_domain: str | None = None,
    home_url: str | None = None,
    home_wins: bool = False,
) -> Column:
    """Link to a social network, with the network's own site as a special case.

    On ``home_domain`` the answer is ``home_url``: always when ``home_wins``,
    else only if the page links to no such address.
    """
    found = first_link_containing(html, word)
    if home_domain is None:
        return found
    home = F.when(as_col(domain) == home_domain, F.lit(home_url))
    return F.coalesce(home, found) if home_wins else F.coalesce(found, home)


def without(items: ColumnOrName, stop_list: tuple[str, ...]) -> Column:
    """The list less the entries of the stop list; order and repeats are kept."""
    stops = F.array(*[F.lit(s) for s in stop_list])
    return F.filter(as_col(items), lambda x: ~F.array_contains(stops, x))


def text_or_link(block: ColumnOrName) -> Column:
    """Plain text of a block without elements, else its first link's text."""
    block = as_col(block)
    plain = F.when(~F.contains(block, F.lit("<")), F.nullif(block, F.lit("")))
    return F.coalesce(plain, first_text(block, r"(?s)<a\b[^>]*>([^<]*)"))
