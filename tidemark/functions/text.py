"""Text, URL and JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from tidemark.functions._columns import ColumnOrName, as_col

# Wide enough for any counter and for six fraction digits after the "k" scaling.
COUNTER_TYPE = T.DecimalType(30, 6)

# Fixed value: scheme and "www." are skipped, the host ends at "/" or "?".
DOMAIN_PATTERN = r"(?s)(?:.*://)?(?:www\.)?([^/?]*)"


def null_sentinel(value: ColumnOrName, sentinel: str = "null") -> Column:
    """NULL where the text is a stored ``'null'``."""
    return F.nullif(as_col(value), F.lit(sentinel))


def strip_non_numeric(value: ColumnOrName) -> Column:
    """Drop everything but digits and dots."""
    return F.regexp_replace(as_col(value), r"[^0-9.]", "")


def text_to_num(value: ColumnOrName, strict: bool = True) -> Column:
    """Counter text (``'1,234'``, ``'1.2k'``, ``'12 commits'``) as a decimal.

    A lower-case ``k`` anywhere in the text multiplies by 1000; ``K`` and ``m``
    do not. NULL and ``'null'`` give NULL. Text without a number is an error,
    or NULL when ``strict`` is off.
    """
    text = null_sentinel(value)
    digits = strip_non_numeric(text)
    wide = T.DecimalType(30, 9)
    number = digits.cast(wide) if strict else digits.try_cast(wide)
    factor = F.when(text.contains("k"), F.lit(1000)).otherwise(F.lit(1))
    return (number * factor).cast(COUNTER_TYPE)


def split_first(value: ColumnOrName, sep: str = " ") -> Column:
    """The piece before the first separator."""
    return F.split_part(as_col(value), F.lit(sep), F.lit(1))


def url_domain(url: ColumnOrName) -> Column:
    """Host of a URL or bare web address; case and port are kept."""
    return F.regexp_extract(as_col(url), DOMAIN_PATTERN, 1)


def url_path_segment(url: ColumnOrName, index: int) -> Column:
    """The ``index``-th piece (from 1) of the URL path between slashes."""
    return F.split_part(F.parse_url(as_col(url), F.lit("PATH")), F.lit("/"), F.lit(index + 1))


def absolute_link(href: ColumnOrName, host: str) -> Column:
    """Prefix a site-relative link with its host."""
    return F.concat(F.lit(host), as_col(href))


def json_text(document: ColumnOrName, path: str) -> Column:
    """Text at a JSON path; absent, JSON null and malformed input give NULL."""
    return F.get_json_object(as_col(document), path)
