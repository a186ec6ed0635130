"""Raw tables to staging tables.

Regulator tables keep one row per version and scrape day; page tables keep the
newest row per natural key. ``loaded_at`` is the query's clock unless ``now``
is given. Who stages a regulator table may say what is done with its versions
``then``, so that both move the rows once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import load_stamp, parse_day
from tidemark.functions.keys import md5_key, numeric_text
from tidemark.functions.numbers import unit_scale
from tidemark.functions.text import null_sentinel, split_first, text_to_num
from tidemark.operators.snapshots import Dealt, Newest, latest_per_key, snapshot_distinct
from tidemark.schemas import ENTITY_ID, MONEY


def _versions(
    raw: DataFrame,
    columns: Sequence[str],
    period: str,
    publish: Mapping[str, Column],
    key: Sequence[Column | str],
    optional: Sequence[Column | str] = (),
    now: Column | None = None,
    then: Newest | Dealt | None = None,
    known_at: Column | None = None,
    strict: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct versions per scrape day, keyed, cast and stamped.

    ``period`` is the report period as a date, parsed here and nowhere later.
    ``then`` names published columns, or ``known_at``: the period unless it is
    given. ``strict`` holds casts by raw column that are errors in any version,
    those that ``then`` leaves out too.
    """
    published = {**publish, "period": parse_day(period)}
    values = {"known_at": published["period"] if known_at is None else known_at, **published}
    held = {name: f"_{name}" for names in (then or ()) if isinstance(names, tuple) for name in names}
    if then is not None:
        raw = raw.withColumns({own: values[name] for name, own in held.items()})
        then = type(then)(*[tuple(held[n] for n in x) if isinstance(x, tuple) else x for x in then])
    if isinstance(then, Newest) and strict:
        raw = raw.withColumns({c: F.when(value.isNotNull(), F.col(c)) for c, value in strict.items()})
    versions = snapshot_distinct(raw, [*columns, *held.values()], keep_day="_day", then=then)
    return versions.select(
        *[(F.col(held[name]) if name in held else value).alias(name) for name, value in published.items()],
        md5_key(key, optional).alias("dim_id"),
        load_stamp(now).alias("loaded_at"),
        F.col("_day").cast("timestamp").alias("scraped_at"),
    )


def _entity(column: str) -> Column:
    return F.col(column).cast(ENTITY_ID)


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def stage_bank_financials(
    raw: DataFrame, now: Column | None = None, then: Newest | Dealt | None = None
) -> DataFrame:
    """Assets and deposits per bank and report date; thousands become dollars."""
    dollars = {c: unit_scale(_money(c)).cast(MONEY) for c in ("asset", "dep")}
    return _versions(
        raw,
        ["cert", "namefull", "asset", "dep", "repdte"],
        "repdte",
        {
            "cert": _entity("cert"),
            "name": F.col("namefull"),
            "total_assets": dollars["asset"],
            "total_deposits": dollars["dep"],
            "report_date": F.col("repdte"),
        },
        key=[
            numeric_text("cert"),
            "namefull",
            numeric_text("asset"),
            numeric_text("dep"),
            "repdte",
            "scraped_at",
        ],
        now=now,
        then=then,
        strict=dollars,
    )


def stage_bank_institutions(
    raw: DataFrame, now: Column | None = None, legacy_key: bool = False, then: Newest | Dealt | None = None
) -> DataFrame:
    """Descriptive attributes of banks; only the certificate must be present.

    The key includes the report date, without which two periods scraped on one
    day collide. ``legacy_key`` leaves it out.
    """
    parts = ["name", "city", "stname", "webaddr", "dateupdt"]
    return _versions(
        raw,
        ["cert", "name", "city", "stname", "webaddr", "repdte", "dateupdt"],
        "repdte",
        {
            "cert": _entity("cert"),
            "name": F.col("name"),
            "city": F.col("city"),
            "state": F.col("stname"),
            "website": F.col("webaddr"),
            "report_date": F.col("repdte"),
            "date_updated": F.col("dateupdt"),
        },
        key=[numeric_text("cert")],
        optional=[*parts, *([] if legacy_key else ["repdte"]), "scraped_at"],
        now=now,
        then=then,
        known_at=parse_day("dateupdt"),
    )


def stage_cu_branches(raw: DataFrame, now: Column | None = None, then: Newest | Dealt | None = None) -> DataFrame:
    """Name and place of credit unions per report date."""
    columns = [
        "cu_number",
        "cu_name",
        "physical_address_city",
        "physical_address_state_code",
        "cycle_date",
    ]
    return _versions(
        raw,
        columns,
        "cycle_date",
        {
            "cu_number": _entity("cu_number"),
            "name": F.col("cu_name"),
            "city": F.col("physical_address_city"),
            "state_code": F.col("physical_address_state_code"),
            "cycle_date": F.col("cycle_date"),
        },
        key=[numeric_text("cu_number"), *columns[1:], "scraped_at"],
        now=now,
        then=then,
    )


# Call-report accounts and their staging names.
FS220_ACCOUNTS = {
    "acct_010": "total_assets",
    "acct_018": "total_deposits",
    "acct_025b": "loans_for_investment",
    "acct_083": "current_members",
    "acct_902": "dda_div_shr_dft_amt",
}
FS220A_ACCOUNTS = {
    "acct_452": "dda_div_shr_dft_cnt",
    "acct_115": "total_int_inc_ytd",
    "acct_350": "total_int_exp_ytd",
    "acct_131": "service_chg_ytd",
}
FS220N_ACCOUNTS = {"acct_is0020": "other_non_int_inc_ytd"}


def _accounts(
    raw: DataFrame, dates: list[str], accounts: Mapping[str, str], now: Column | None, then: Newest | Dealt | None
) -> DataFrame:
    """Measures of one call-report form. Text and numeric accounts both cast."""
    return _versions(
        raw,
        ["cu_number", *dates, *accounts],
        "cycle_date",
        {
            "cu_number": _entity("cu_number"),
            **{d: F.col(d) for d in dates},
            **{name: _money(account) for account, name in accounts.items()},
        },
        key=[
            numeric_text("cu_number"),
            *dates,
            *[numeric_text(a) if _is_decimal(raw, a) else F.col(a) for a in accounts],
            "scraped_at",
        ],
        now=now,
        then=then,
        strict={a: _money(a) for a in accounts if raw.schema[a].dataType != MONEY},
    )


def _is_decimal(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "decimal"


def stage_fs220(raw: DataFrame, now: Column | None = None, then: Newest | Dealt | None = None) -> DataFrame:
    return _accounts(raw, ["cycle_date", "update_date"], FS220_ACCOUNTS, now, then)


def stage_fs220a(raw: DataFrame, now: Column | None = None, then: Newest | Dealt | None = None) -> DataFrame:
    return _accounts(raw, ["cycle_date"], FS220A_ACCOUNTS, now, then)


def stage_fs220n(raw: DataFrame, now: Column | None = None, then: Newest | Dealt | None = None) -> DataFrame:
    return _accounts(raw, ["cycle_date"], FS220N_ACCOUNTS, now, then)


def stage_fs220d(raw: DataFrame, now: Column | None = None, then: Newest | Dealt | None = None) -> DataFrame:
    """Website per credit union and report date."""
    return _versions(
        raw,
        ["cu_number", "cycle_date", "acct_891"],
        "cycle_date",
        {
            "cu_number": _entity("cu_number"),
            "cycle_date": F.col("cycle_date"),
            "website": F.col("acct_891"),
        },
        key=[numeric_text("cu_number"), "cycle_date", "acct_891", "scraped_at"],
        now=now,
        then=then,
    )


def _newest(
    raw: DataFrame,
    keys: list[str],
    publish: Mapping[str, Column | str],
    now: Column | None,
) -> DataFrame:
    """Newest row per natural key; equal scrape times are settled by ``id``."""
    tiebreak = ["id"] if "id" in raw.columns else []
    newest = latest_per_key(raw, keys, "scraped_at", tiebreak)
    return newest.select(
        *[(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in publish.items()],
        md5_key(keys).alias("dim_id"),
        load_stamp(now).alias("loaded_at"),
        "scraped_at",
    )


def _as_is(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


def stage_projects(raw: DataFrame, now: Column | None = None) -> DataFrame:
    columns = _as_is("section", "project_title", "project_link", "project_description")
    return _newest(raw, ["project_link"], columns, now)


def stage_repos(raw: DataFrame, now: Column | None = None, strict: bool = True) -> DataFrame:
    """Repositories with their counters as numbers and their last update as a time."""
    counters = ["pull_requests", "commits", "stargazers", "forks", "contributors"]
    columns = {
        **_as_is("name", "link", "description", "project_link", "tags", "languages"),
        **{c: text_to_num(c, strict) for c in counters},
        "last_updated": null_sentinel("last_updated").cast("timestamp"),
    }
    return _newest(raw, ["link"], columns, now)


def stage_contributors(raw: DataFrame, now: Column | None = None, strict: bool = True) -> DataFrame:
    """Who contributed to which repository; commit counts read ``'12 commits'``."""
    columns = {
        **_as_is("repo_name", "source_repo_link", "profile_link"),
        "commits_to_source_repo": text_to_num(split_first("commits_to_source_repo"), strict),
    }
    return _newest(raw, ["source_repo_link", "profile_link"], columns, now)


def stage_profiles(raw: DataFrame, now: Column | None = None, strict: bool = True) -> DataFrame:
    counters = [
        "number_of_repos",
        "number_of_stars",
        "number_of_followers",
        "number_following",
        "number_of_contributions_past_year",
    ]
    columns = {
        "link": "link",
        **{c: text_to_num(c, strict) for c in counters},
        **_as_is("company_name", "email_domain", "organizations"),
    }
    return _newest(raw, ["link"], columns, now)


def stage_companies(raw: DataFrame, now: Column | None = None) -> DataFrame:
    columns = _as_is(
        "name", "website", "domain", "github_url", "linkedin_url", "facebook_url", "twitter_url"
    )
    return _newest(raw, ["domain"], columns, now)
