"""Crawled pages to raw page tables, one extractor per kind of page.

Input rows are (url, body, meta) as ``sources.documents`` reads them; output
columns are those of the raw tables in ``schemas``, after any page columns named
in ``keep`` (the crawl job and scrape time). Lists come back as arrays of structs
and absent values as NULL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.functions import pages as P
from tidemark.functions.text import absolute_link, json_text, url_path_segment
from tidemark.operators.columns import explode_with
from tidemark.schemas import TEXT, record

# Marks of the crawled site's pages.
SITE = "https://github.com"
EMBEDDED_DATA = "react-partial.embeddedData"
OVERVIEW = "$.props.initialPayload.overview"
README = OVERVIEW + ".overviewFiles[0]"
SKIPPED_SECTIONS = ("#related-resources", "#license")
USER_ANCHOR_MARK = "user-content"

_TEXT_AFTER_TAG = r"([^<]*)"


def _text_in(pattern: str) -> str:
    return pattern + _TEXT_AFTER_TAG


def _link_child_text(page: str, href_word: str, child: str) -> Column:
    """Text of the first ``child`` inside an anchor whose target has a word."""
    return _clean(P.child_text(page, P.element("a", "href", href_word), "a", child))


def _section(heading: str) -> str:
    """What follows an ``h2`` with ``heading`` in it, up to the next heading or part of the page."""
    return rf"(?is)<h2\b[^>]*>[^<]*{heading}[^<]*</h2>(.*?)(?:<h[12]\b|</main\b|</aside\b|<footer\b|\z)"


def _shown(pages: DataFrame) -> DataFrame:
    """``pages`` with ``_page``: the body less what a reader does not see."""
    return pages.withColumn("_page", P.without_hidden("body"))


def _clean(value: Column) -> Column:
    return P.unescape_html(value)


def extract_repos(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per repository page."""
    body = "_page"
    blocks = _shown(pages).withColumns(
        {
            "_about": F.regexp_extract(body, _section("About"), 1),
            "_languages": F.regexp_extract(body, _section("Languages"), 1),
        }
    )
    language = r"(?s)<li\b[^>]*>\s*<a\b[^>]*>.*?<span\b[^>]*>([^<]*)</span>\s*<span\b[^>]*>([^<]*)</span>"
    overview = P.embedded_json("body", EMBEDDED_DATA, 2)
    return blocks.select(
        *keep,
        url_path_segment("url", 2).alias("name"),
        F.col("url").alias("link"),
        _clean(P.first_text("_about", r"(?s)<p\b[^>]*>([^<]*)")).alias("description"),
        F.col("meta.project_link").alias("project_link"),
        F.transform(
            P.all_text(body, _text_in(P.element("a", "class", "topic-tag"))), _clean
        ).alias("tags"),
        F.transform(
            P.struct_list("_languages", language, ("name", "pct")),
            lambda x: F.struct(_clean(x["name"]).alias("name"), _clean(x["pct"]).alias("pct")),
        ).alias("languages"),
        _clean(P.first_text(body, _text_in(P.element("span", "id", "pull-requests-repo-tab-count")))).alias(
            "pull_requests"
        ),
        json_text(overview, OVERVIEW + ".commitCount").alias("commits"),
        _link_child_text(body, "/stargazers", "strong").alias("stargazers"),
        _link_child_text(body, "/forks", "strong").alias("forks"),
        _link_child_text(body, "/graphs/contributors", "span").alias("contributors"),
        P.first_attribute(body, "relative-time", "datetime").alias("last_updated"),
    )


def extract_contributors(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per contributor listed on a page, with the page's repository."""
    # A person's item runs to the next person's, or to the end of the list.
    person = P.element("li", "class", "contrib-person")
    items = F.slice("_pieces", 2, F.size("_pieces"))
    kept = {
        **{c: c for c in keep},
        "repo_name": "meta.repo_name",
        "source_repo_link": "meta.source_repo_link",
    }
    rows = explode_with(_shown(pages).withColumn("_pieces", F.split("_page", person)), kept, items, "item")
    rows = rows.withColumn("item", F.split_part("item", F.lit("</ol>"), F.lit(1)))
    profile_tag = F.regexp_extract("item", P.element("a", "data-hovercard-type", "user"), 0)
    commits = P.element("a", "href", "commits?author") + _TEXT_AFTER_TAG
    return rows.select(
        *keep,
        "repo_name",
        "source_repo_link",
        absolute_link(P.attribute_of(profile_tag, "href"), SITE).alias("profile_link"),
        P.first_text("item", commits).alias("commits_to_source_repo"),
    )


def extract_profiles(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per profile page, with the employer and organisations it names."""
    body = "_page"

    def tab(name: str) -> Column:
        return _link_child_text(body, f"tab={name}", "span")

    def percent(side: str) -> Column:
        return P.first_text("_graph", _text_in(P.element("text", "class", f"js-highlight-percent-{side}")))

    graph = P.element("svg", "class", "js-activity-overview-graph") + r"(.*?)</svg>"
    # The employer's own list item, and in it the organisation's block.
    works_for = P.element("li", "itemprop", "worksFor") + r"(?s:(.*?))(?i:</li\s*>|<li\b|\z)"
    employer = P.element("span", "class", "p-org") + r"\s*<div\b[^>]*>(.*?)</div>"
    blocks = _shown(pages).withColumns(
        {
            "_graph": F.regexp_extract(body, graph, 1),
            "_employer": F.regexp_extract(F.regexp_extract(body, works_for, 1), employer, 1),
            "_organisations": F.regexp_extract(body, _section("Organizations"), 1),
        }
    )
    employer_link = r'(?s)<a\b[^>]*\shref="([^"]*)"[^>]*>([^<]*)'
    linked = P.struct_list("_employer", employer_link, ("href", "name"))
    employers = P.ordered_structs(
        F.transform(
            linked,
            lambda x: F.struct(
                F.nullif(_clean(x["name"]), F.lit("")).alias("name"), _clean(x["href"]).alias("href")
            ),
        )
    )
    organisation_tags = F.regexp_extract_all("_organisations", F.lit(r"(?s)<a\b[^>]*>"), F.lit(0))
    organisations = P.ordered_structs(
        F.transform(
            organisation_tags,
            lambda tag: F.struct(
                P.attribute_of(tag, "aria-label").alias("name"),
                absolute_link(P.attribute_of(tag, "href"), SITE).alias("href"),
            ),
        )
    )
    return blocks.select(
        *keep,
        F.col("url").alias("link"),
        tab("repositories").alias("number_of_repos"),
        tab("stars").alias("number_of_stars"),
        tab("followers").alias("number_of_followers"),
        tab("following").alias("number_following"),
        P.first_text(body, r"(?s)<h2\b[^>]*>([^<]* contributions in the last year[^<]*)").alias(
            "number_of_contributions_past_year"
        ),
        percent("top").alias("contrib_pct_code_review"),
        percent("left").alias("contrib_pct_commits"),
        percent("right").alias("contrib_pct_issues"),
        percent("bottom").alias("contrib_pct_pull_requests"),
        _clean(P.text_or_link("_employer")).alias("company_name"),
        F.lit(None).cast("string").alias("email_domain"),
        P.concat_or_null(employers, organisations).alias("organizations"),
    )


def extract_companies(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per company home page, with its first link to each network."""
    body, domain = "_page", F.col("meta.domain")
    return _shown(pages).select(
        *keep,
        F.col("meta.og_company_name").alias("name"),
        F.col("url").alias("website"),
        domain.alias("domain"),
        P.network_link(body, "github").alias("github_url"),
        P.network_link(
            body,
            "linkedin",
            domain,
            "linkedin.com",
            "https://www.linkedin.com/company/linkedin",
            home_wins=True,
        ).alias("linkedin_url"),
        P.network_link(
            body, "facebook", domain, "facebook.com", "https://www.facebook.com/facebook"
        ).alias("facebook_url"),
        P.network_link(
            body, "twitter", domain, "twitter.com", "https://twitter.com/twitter"
        ).alias("twitter_url"),
    )


def extract_projects(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per project listed in a wanted section of the list page.

    The list is an HTML article inside a script's JSON. Its table of contents
    names the sections; the items belong to a section only at a fixed nesting,
    which is why the article goes through a parser.
    """
    lists = pages.withColumn("_overview", P.embedded_json("body", EMBEDDED_DATA, 2))
    toc = F.from_json(
        json_text("_overview", README + ".headerInfo.toc"), "array<struct<level:int,anchor:string>>"
    )
    level_two = F.transform(
        F.filter(toc, lambda t: t["level"] == 2), lambda t: F.concat(F.lit("#"), t["anchor"])
    )
    articles = lists.select(
        *keep,
        P.without(level_two, SKIPPED_SECTIONS).alias("sections"),
        json_text("_overview", README + ".richText").alias("article"),
    ).filter(F.col("article").isNotNull())
    listed = articles.select(*keep, "sections", F.explode(_listed_items("article")).alias("item"))
    return listed.filter(F.array_contains("sections", F.col("item.section"))).select(*keep, "item.*")


class _ListedItems(HTMLParser):
    """Collects ``h2`` sections' items at div > div > div > ul > li > p."""

    VOID = {"area", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.path: list[str] = []
        self.sections: list[tuple[int, str]] = []
        self.items: list[dict[str, str | None]] = []
        self.item: dict[str, str | None] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        attrs = dict(attrs)
        depth = len(self.path)
        if tag == "a" and self.path[-1:] == ["h2"] and USER_ANCHOR_MARK in (attrs.get("id") or ""):
            self.sections.append((depth - 1, attrs.get("href") or ""))
        if tag == "li" and self.sections:
            level, section = self.sections[-1]
            if self.path[level:] == ["div", "div", "ul"]:
                self.item = {
                    "section": section,
                    "project_title": None,
                    "project_link": None,
                    "project_description": None,
                }
                self.items.append(self.item)
        if tag == "a" and self._in_item(["li", "p"]) and self.item["project_link"] is None:
            self.item["project_link"] = attrs.get("href")
        self.path.append(tag)

    def handle_endtag(self, tag):
        if tag in self.path:
            while self.path.pop() != tag:
                pass
            if tag == "li":
                self.item = None
            while self.sections and len(self.path) < self.sections[-1][0]:
                self.sections.pop()

    def handle_data(self, data):
        if self._in_item(["li", "p"]) and self.item["project_description"] is None:
            self.item["project_description"] = data
        elif self._in_item(["li", "p", "a"]) and self.item["project_title"] is None:
            self.item["project_title"] = data

    def _in_item(self, tail: list[str]) -> bool:
        return self.item is not None and self.path[-len(tail):] == tail


ITEM = record(section=TEXT, project_title=TEXT, project_link=TEXT, project_description=TEXT)


@F.pandas_udf(T.ArrayType(ITEM))
def _listed_items(articles: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in articles:
        yield batch.map(_items_of)


def _items_of(article: str) -> list[dict[str, str | None]]:
    parser = _ListedItems()
    parser.feed(article)
    parser.close()
    return parser.items


EXTRACTORS = {
    "projects": extract_projects,
    "repos": extract_repos,
    "contributors": extract_contributors,
    "profiles": extract_profiles,
    "companies": extract_companies,
}


def dispatch(
    pages: DataFrame, kind_column: str, keep: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Split mixed pages by kind, each through its own extractor.

    Store pages partitioned by kind, and each extractor scans its own pages only.
    """
    return {
        kind: extractor(pages.filter(F.col(kind_column) == kind), keep)
        for kind, extractor in EXTRACTORS.items()
    }
