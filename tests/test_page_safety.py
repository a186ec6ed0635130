"""Pages that are cut, nested, commented or escaped."""

import pytest

from tidemark.functions import pages as P
from tidemark.plans.page_extracts import extract_companies, extract_profiles, extract_repos
from tidemark.sources.documents import PAGE_SCHEMA


def page(spark, body, **meta):
    return spark.createDataFrame([("https://github.com/o/r", body, meta)], PAGE_SCHEMA)


def value(spark, text, build):
    return spark.createDataFrame([(text,)], "html string").select(build("html").alias("v")).first().v


@pytest.mark.parametrize("tags", [10, 100_000])
def test_unclosed_anchor_does_not_overflow(spark, tags):
    body = '<a href="/o/r/stargazers">' + "<i>x</i>" * tags + "<strong>42</strong>"
    assert extract_repos(page(spark, body)).first().stargazers == "42"
    assert extract_repos(page(spark, '<a href="/o/r/forks"><i>no</i></A><a href="/x"><strong>7</strong></a>')).first().forks is None


@pytest.mark.parametrize("inner", ["<article><abbr>k</abbr></article><strong>5</strong>", "<strong>5</strong>"])
def test_tags_that_begin_like_an_anchor(spark, inner):
    assert extract_repos(page(spark, f'<a href="/o/r/stargazers">{inner}</a>')).first().stargazers == "5"


def test_attributes_and_references(spark):
    body = '<a href="https://twitter.com/x?a=1&amp;b=2">t</a>'
    assert value(spark, body, lambda h: P.first_link_containing(h, "twitter")) == "https://twitter.com/x?a=1&b=2"
    text = "caf&eacute; &mdash; it&rsquo;s &#233;&#xe9; &amp;lt; &unknown; &notit; &lt;b&gt;"
    assert value(spark, text, P.unescape_html) == "café — it’s éé &lt; &unknown; &notit; <b>"


def test_hidden_links_do_not_count(spark):
    body = (
        '<!-- <a href="https://github.com/hidden"> --><script>var a = \'<a href="https://github.com/js">\';</script>'
        '<a href="https://github.com/shown">x</a>'
    )
    assert extract_companies(page(spark, body, domain="d.example")).first().github_url == "https://github.com/shown"


def test_blocks_may_nest(spark):
    body = "<h2>About</h2><div><div>icon</div><p>What &amp; why</p></div><h2>Releases</h2><p>no</p>"
    assert extract_repos(page(spark, body)).first().description == "What & why"
    orgs = '<h2>Organizations</h2><div><div><a href="/a" aria-label="A"></a></div><a href="/b" aria-label="B &amp; C"></a></div><h2>x</h2><a href="/c" aria-label="no"></a>'
    found = extract_profiles(page(spark, orgs)).first().organizations
    assert [(o.name, o.href) for o in found] == [("A", "https://github.com/a"), ("B & C", "https://github.com/b")]


def test_employer_comes_from_its_own_item(spark):
    body = '<li itemprop="worksFor"><span>none</span></li><li itemprop="other"><span class="p-org"><div>Other Org</div></span></li>'
    assert extract_profiles(page(spark, body)).first().company_name is None
