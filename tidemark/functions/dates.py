"""Report periods, scrape days and horizons."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions._columns import ColumnOrName, as_col

# How each consumer of a report period spells it.
PERIOD_STYLES = {
    "compact": "yyyyMMdd",
    "us": "MM/dd/yyyy",
    "iso": "yyyy-MM-dd",
    "year_month": "yyyy-MM",
}


def day_string(ts: ColumnOrName) -> Column:
    """The day of a timestamp as ``YYYYMMDD`` text."""
    return F.date_format(as_col(ts), "yyyyMMdd")


def parse_day(text: ColumnOrName, strict: bool = True) -> Column:
    """Report-date text as a date.

    Reads ``YYYYMMDD``, ``M/D/YYYY`` and ``YYYY-MM-DD``, the last two with or
    without a time of day. Other text is an error, or NULL when not ``strict``.
    The text is rearranged and cast: a ladder of format parsers would cost an
    exception for every format that does not fit.
    """
    value = as_col(text)
    month, day = F.substring_index(value, "/", 1), F.substring_index(F.substring_index(value, "/", 2), "/", -1)
    slashed = F.concat_ws("-", F.substring(value, F.length(month) + F.length(day) + 3, F.lit(4)), month, day)
    pieces = [F.substring(value, start, length) for start, length in ((1, 4), (5, 2), (7, 2))]
    iso = (
        F.when(~value.contains("/") & value.rlike(r"^\d{8}$"), F.concat_ws("-", *pieces))
        .when(value.rlike(r"^\d{1,2}/\d{1,2}/\d{4}([ T].*)?$"), slashed)
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$"), value)
    )
    if not strict:
        return iso.try_cast("date")
    unknown = F.raise_error(F.concat(F.lit("not a report day: "), value)).cast("string")
    # The ladder stands here once: Spark works out what stands twice twice.
    return F.coalesce(iso, F.when(value.isNotNull(), unknown)).cast("date")


def quarter_end(day: ColumnOrName) -> Column:
    """Last day of the quarter that holds ``day``."""
    return F.last_day(F.add_months(F.trunc(as_col(day), "quarter"), 2))


def previous_quarter_end(day: ColumnOrName) -> Column:
    """Last day of the quarter before the one that holds ``day``."""
    return F.date_sub(F.trunc(as_col(day), "quarter"), 1)


def format_period(day: ColumnOrName, style: str = "compact") -> Column:
    """A report period as text in one of ``PERIOD_STYLES``."""
    return F.date_format(as_col(day), PERIOD_STYLES[style])


def months_ahead(day: ColumnOrName, months: ColumnOrName | int) -> Column:
    """The same day ``months`` later, clipped to the month's end."""
    return F.add_months(as_col(day), months)


def load_stamp(now: ColumnOrName | None = None) -> Column:
    """Load time: the query's clock, or an injected timestamp."""
    return F.current_timestamp() if now is None else as_col(now)
