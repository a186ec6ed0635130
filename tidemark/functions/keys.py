"""Surrogate keys: md5 over concatenated column text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidemark.functions._columns import ColumnOrName, as_col


def numeric_text(value: ColumnOrName) -> Column:
    """A decimal without padding zeros, so ``5.00`` and ``5`` hash alike."""
    text = as_col(value).cast("string")
    trimmed = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.when(text.contains("."), trimmed).otherwise(text)


def md5_key(
    parts: Sequence[ColumnOrName],
    optional: Sequence[ColumnOrName] = (),
    sep: str = "",
) -> Column:
    """md5 of ``parts`` then ``optional``, as lower-case hex.

    A NULL among ``parts`` makes the key NULL; a NULL among ``optional`` counts
    as empty text. Without a separator ``('1', '23')`` and ``('12', '3')``
    collide; that is the published key format, so it is the default.
    """
    texts = [as_col(c).cast("string") for c in parts]
    texts += [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in optional]
    if sep:
        # concat, not concat_ws: concat_ws would skip NULL parts.
        joined = [t for text in texts for t in (F.lit(sep), text)][1:]
    else:
        joined = texts
    return F.md5(F.concat(*joined))
