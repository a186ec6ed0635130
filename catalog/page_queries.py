"""Extraction from the HTML of ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import Tables, query
from tidemark.functions import pages as P
from tidemark.functions.text import absolute_link as absolute
from tidemark.functions.text import json_text, url_path_segment as path_segment
from tidemark.operators.columns import explode_with
from tidemark.plans import page_extracts

LINK = r'(?s)<a\b[^>]*\shref="([^"]*)"[^>]*>([^<]*)'
HREF = r'(?s)<a\b[^>]*\shref="([^"]*)"'
TITLE = r"(?s)<title\b[^>]*>([^<]*)"
SITE = "https://site.example"


@query(
    "page_first_text",
    f"""
    SELECT page_id, NULLIF(regexp_extract(html, '{TITLE}', 1), '') AS title,
           NULLIF(regexp_extract(html, '(?s)<h7>([^<]*)', 1), '') AS absent
    FROM pages
    """,
)
def page_first_text(t: Tables):
    return t.pages.select(
        "page_id",
        P.first_text("html", P.element("title") + "([^<]*)").alias("title"),
        P.first_text("html", r"(?s)<h7>([^<]*)").alias("absent"),
    )


_ALL_HREFS = f"SELECT page_id, unnest(regexp_extract_all(html, '{HREF}', 1)) AS href FROM pages"


@query("page_all_text", _ALL_HREFS)
def page_all_text(t: Tables):
    return t.pages.select("page_id", F.explode(P.all_text("html", HREF)).alias("href"))


@query(
    "page_struct_list",
    f"""
    SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS href,
           unnest(regexp_extract_all(html, '{LINK}', 2)) AS label
    FROM pages
    """,
)
def page_struct_list(t: Tables):
    pairs = P.struct_list("html", LINK, ("href", "label"))
    return t.pages.select("page_id", F.explode(pairs).alias("link")).select("page_id", "link.*")


@query(
    "page_attr",
    r"""
    SELECT page_id, NULLIF(regexp_extract(regexp_extract(html, '(?s)<html\b[^>]*>', 0), '\slang="([^"]*)"', 1), '') AS lang,
           CAST(NULL AS VARCHAR) AS dir
    FROM pages
    """,
)
def page_attr(t: Tables):
    return t.pages.select(
        "page_id",
        P.first_attribute("html", "html", "lang").alias("lang"),
        P.first_attribute("html", "html", "dir").alias("dir"),
    )


@query(
    "page_embedded_json",
    r"""
    SELECT page_id, regexp_extract(html, 'track\(([0-9]+)\)', 1) AS n_commits,
           NULLIF(regexp_extract(html, '(?s)<title\b[^>]*>([^<]*)', 1), '') AS title,
           CAST(NULL AS VARCHAR) AS absent
    FROM pages
    """,
)
def page_embedded_json(t: Tables):
    number = F.regexp_extract("html", r"track\(([0-9]+)\)", 1)
    body = F.to_json(
        F.struct(F.struct(number.alias("commitCount"), P.first_text("html", TITLE).alias("title")).alias("props"))
    )
    opening = F.lit('<script type="application/json" data-target="data-island">')
    closing = F.lit("</script>")
    extended = F.concat("html", opening, F.lit("not json"), closing, opening, body, closing)
    second = P.embedded_json("extended", "data-island", 2)
    return t.pages.select("page_id", extended.alias("extended")).select(
        "page_id",
        json_text(second, "$.props.commitCount").alias("n_commits"),
        json_text(second, "$.props.title").alias("title"),
        json_text(P.embedded_json("extended", "data-island", 1), "$.props").alias("absent"),
    )


@query(
    "page_rows",
    f"""
    SELECT url, regexp_extract(html, '{TITLE}', 1) AS title,
           unnest(regexp_extract_all(html, '{HREF}', 1)) AS href
    FROM pages
    """,
)
def page_rows(t: Tables):
    kept = {"url": "url", "title": F.regexp_extract("html", TITLE, 1)}
    return explode_with(t.pages, kept, P.all_text("html", HREF), "href")


@query("section_exclude", f"SELECT * FROM ({_ALL_HREFS}) WHERE href NOT IN ('/de', '/the')")
def section_exclude(t: Tables):
    kept = P.without(P.all_text("html", HREF), ("/de", "/the"))
    return t.pages.select("page_id", F.explode(kept).alias("href"))


def _network(word: str) -> str:
    return rf"""NULLIF(regexp_extract(html, '(?s)<a\b[^>]*\shref="([^"]*{word}[^"]*)"', 1), '')"""


@query(
    "first_link_containing",
    f"""
    SELECT page_id, {_network('re')} AS plain,
           CASE WHEN page_id % 2 = 0 THEN 'HOME' ELSE {_network('th')} END AS home_wins,
           COALESCE({_network('en')}, CASE WHEN page_id % 2 = 0 THEN 'HOME' END) AS link_wins
    FROM pages
    """,
)
def first_link_containing(t: Tables):
    domain = F.when(F.col("page_id") % 2 == 0, "home.example").otherwise("other.example")
    return t.pages.select(
        "page_id",
        P.network_link("html", "re").alias("plain"),
        P.network_link("html", "th", domain, "home.example", "HOME", home_wins=True).alias("home_wins"),
        P.network_link("html", "en", domain, "home.example", "HOME").alias("link_wins"),
    )


@query(
    "url_path_segment",
    r"""
    SELECT page_id,
           split_part(regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)', 1), '/', 3) AS segment
    FROM pages
    """,
)
def url_path_segment(t: Tables):
    return t.pages.select("page_id", path_segment("url", 2).alias("segment"))


@query("absolute_link", f"SELECT page_id, '{SITE}' || href AS link FROM ({_ALL_HREFS})")
def absolute_link(t: Tables):
    hrefs = t.pages.select("page_id", F.explode(P.all_text("html", HREF)).alias("href"))
    return hrefs.select("page_id", absolute("href", SITE).alias("link"))


@query(
    "ordered_struct_list",
    f"""
    WITH lists AS (SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS hrefs,
                          regexp_extract_all(html, '{LINK}', 2) AS labels,
                          regexp_extract_all(html, '(?s)<b>([^<]*)', 1) AS bolds FROM pages)
    SELECT page_id, hrefs[i] AS href, labels[i] AS label, CAST(i AS INTEGER) AS position
    FROM lists, UNNEST(range(1, len(hrefs) + 1)) u(i)
    UNION ALL
    SELECT page_id, '' AS href, bolds[i] AS label, CAST(i AS INTEGER) AS position
    FROM lists, UNNEST(range(1, len(bolds) + 1)) u(i)
    """,
)
def ordered_struct_list(t: Tables):
    links = P.struct_list("html", LINK, ("href", "label"))
    bolds = F.transform(
        P.all_text("html", r"(?s)<b>([^<]*)"), lambda x: F.struct(F.lit("").alias("href"), x.alias("label"))
    )
    both = P.concat_or_null(P.ordered_structs(links, "position"), P.ordered_structs(bolds, "position"))
    return t.pages.select("page_id", F.explode(both).alias("x")).select("page_id", "x.*")


@query(
    "fallback_text",
    r"""
    SELECT page_id, COALESCE(CASE WHEN NOT contains(block, '<') THEN NULLIF(block, '') END,
                             NULLIF(regexp_extract(block, '(?s)<a\b[^>]*>([^<]*)', 1), '')) AS label
    FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)
                 ELSE regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1) END AS block FROM pages)
    """,
)
def fallback_text(t: Tables):
    block = F.when(
        F.col("page_id") % 3 == 0, F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    ).otherwise(F.regexp_extract("html", r"(?s)<ul>(.*?)</ul>", 1))
    return t.pages.select("page_id", P.text_or_link(block).alias("label"))


def _mixed_pages(t: Tables):
    """Every given page whole, with the marks of one of the five kinds at the top of its body."""
    title = F.coalesce(P.first_text("html", TITLE), F.lit("untitled"))
    shown = F.regexp_replace(title, r"[^A-Za-z ]", "")
    key = F.col("page_id").cast("string")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    article = text(
        '<div><h2><a id=\\"user-content-s\\" href=\\"#s\\"></a>S</h2><div><div><ul><li><p>',
        '<a href=\\"/p', key, '\\">', shown, "</a> about</p></li></ul></div></div></div>",
    )
    island = '<script type="application/json" data-target="react-partial.embeddedData">'
    bodies = {
        "projects": text(
            island, "{}</script>", island,
            '{"props":{"initialPayload":{"overview":{"overviewFiles":[{"headerInfo":{"toc":'
            '[{"level":2,"anchor":"s"},{"level":2,"anchor":"license"}]},"richText":"', article,
            '"}]}}}}</script>',
        ),
        "repos": text(
            '<a href="/o/r/stargazers"><svg><path d="M8"></path></svg><strong>', key, "</strong> stars</a>",
            '<div><h2 class="h4">About</h2><p class="f4">', shown, "</p></div>",
        ),
        "contributors": text(
            '<ol><li class="contrib-person"><a data-hovercard-type="user" href="/u', key,
            '">x</a><a href="/o/r/commits?author=u">', key, " commits</a></li></ol>",
        ),
        "profiles": text(
            '<li itemprop="worksFor"><span class="p-org"><div>', shown, "</div></span></li>",
            '<a href="/u?tab=stars">Stars <span class="Counter">', key, "</span></a>",
        ),
        "companies": text('<a class="x" href="https://www.linkedin.com/company/', key, '">in</a>'),
    }
    kinds = F.array(*[F.lit(k) for k in bodies])
    kind = F.get(kinds, (F.col("page_id") % 5).cast("int"))
    marks = F.coalesce(*[F.when(kind == k, b) for k, b in bodies.items()])
    html = F.coalesce("html", F.lit(""))
    top = F.regexp_extract(html, r"(?is)^.*?<body\b[^>]*>", 0)
    body = F.concat(top, marks, F.substring(html, F.length(top) + 1, F.length(html)))
    return t.pages.select(
        kind.alias("kind"),
        F.concat(F.lit("https://code.example/org/repo"), key).alias("url"),
        body.alias("body"),
        F.struct(
            F.lit("project").alias("project_link"),
            F.concat(F.lit("repo"), key).alias("repo_name"),
            F.concat(F.lit("link"), key).alias("source_repo_link"),
            F.concat(F.lit("domain"), key).alias("domain"),
            shown.alias("og_company_name"),
        ).alias("meta"),
    )


@query(
    "page_type_dispatch",
    r"""
    SELECT ['projects', 'repos', 'contributors', 'profiles', 'companies'][page_id % 5 + 1] AS kind,
           CASE page_id % 5
             WHEN 0 THEN '/p' || page_id WHEN 1 THEN 'repo' || page_id
             WHEN 2 THEN 'https://github.com/u' || page_id
             WHEN 3 THEN 'https://code.example/org/repo' || page_id ELSE 'domain' || page_id END AS key,
           CASE page_id % 5
             WHEN 0 THEN NULLIF(shown, '') WHEN 1 THEN NULLIF(shown, '') WHEN 2 THEN page_id || ' commits'
             WHEN 3 THEN NULLIF(shown, '') ELSE 'https://www.linkedin.com/company/' || page_id END AS fact
    FROM (SELECT page_id, regexp_replace(COALESCE(NULLIF(regexp_extract(html, '(?s)<title\b[^>]*>([^<]*)', 1), ''),
                 'untitled'), '[^A-Za-z ]', '', 'g') AS shown FROM pages)
    """,
)
def page_type_dispatch(t: Tables):
    key_and_fact = {
        "projects": ("project_link", "project_title"),
        "repos": ("name", "description"),
        "contributors": ("profile_link", "commits_to_source_repo"),
        "profiles": ("link", "company_name"),
        "companies": ("domain", "linkedin_url"),
    }
    parts = page_extracts.dispatch(_mixed_pages(t), "kind")
    found = [
        parts[kind].select(F.lit(kind).alias("kind"), F.col(key).alias("key"), F.col(fact).alias("fact"))
        for kind, (key, fact) in key_and_fact.items()
    ]
    first, *rest = found
    for part in rest:
        first = first.unionByName(part)
    return first
