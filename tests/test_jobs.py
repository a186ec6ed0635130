"""Page extractors on realistic pages, and both pipelines on small raw tables."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import schemas
from tidemark.operators.columns import align_schema
from tidemark.operators.quality import AuditFailed
from tidemark.plans import marts, metrics, page_extracts, pipeline, staging
from tidemark.sources.documents import PAGE_SCHEMA
from tidemark.sources.lookups import states


def pages(spark, *docs):
    data = [(url, body, tuple(meta.get(f.name) for f in PAGE_SCHEMA["meta"].dataType)) for url, body, meta in docs]
    return spark.createDataFrame(data, PAGE_SCHEMA)


def island(data) -> str:
    script = '<script type="application/json" data-target="react-partial.embeddedData">{}</script>'
    return script.format("{}") + script.format(json.dumps(data))


def overview(content):
    return {"props": {"initialPayload": {"overview": content}}}


REPO = """<html><body>
<span id="pull-requests-repo-tab-count" title="3" class="Counter">3</span>
<div class="row"><h2 class="mb-3 h4">About</h2>
  <p class="f4 my-3">Tools &amp; things</p>
  <div><a class="topic-tag topic-tag-link" href="/t/etl">etl</a> <a href="/t/sql" class="topic-tag">sql</a></div></div>
<a href="/o/r/stargazers" class="Link"><svg><path d="M8 .25a.75.75 0"></path></svg><strong>1.2k</strong> stars</a>
<a href="/o/r/watchers"><strong>9</strong> watching</a>
<a class="Link" href="/o/r/forks"><strong>55</strong> forks</a>
<h2><a href="/o/r/graphs/contributors" class="Link">Contributors <span class="Counter">17</span></a></h2>
<div><h2 class="h4">Languages</h2><ul class="list">
 <li class="d-inline"><a class="x" href="/l"><svg></svg> <span class="text-bold">Python</span> <span>97.6%</span></a></li>
 <li class="d-inline"><a class="x" href="/l"><svg></svg> <span class="text-bold">C++</span> <span>2.4%</span></a></li></ul></div>
<relative-time class="no-wrap" datetime="2024-02-03T04:05:06Z">Feb</relative-time>
""" + island(overview({"commitCount": "1,234"})) + "</body></html>"


def test_repo_page(spark):
    docs = pages(
        spark,
        ("https://github.com/o/r", REPO, {"project_link": "https://p"}),
        ("https://github.com/o/empty", "<html></html>", {}),
    )
    full, empty = page_extracts.extract_repos(docs).orderBy(F.desc("name")).collect()
    assert full.asDict(recursive=True) == {
        "name": "r",
        "link": "https://github.com/o/r",
        "description": "Tools & things",
        "project_link": "https://p",
        "tags": ["etl", "sql"],
        "languages": [{"name": "Python", "pct": "97.6%"}, {"name": "C++", "pct": "2.4%"}],
        "pull_requests": "3",
        "commits": "1,234",
        "stargazers": "1.2k",
        "forks": "55",
        "contributors": "17",
        "last_updated": "2024-02-03T04:05:06Z",
    }
    assert (empty.name, empty.description, empty.tags, empty.commits, empty.last_updated) == ("empty", None, [], None, None)


def test_contributor_page(spark):
    body = """<ol><li class="contrib-person float-left"><a href="/x">#1</a>
      <a data-hovercard-type="user" class="n" href="/ann">ann</a><a href="/o/r/commits?author=ann" class="c">1,204 commits</a></li>
      <li class="contrib-person"><a class="n" href="/bob" data-hovercard-type="user">bob</a></li></ol>
      <a href="/o/r/commits?author=all">9 commits</a>"""
    meta = {"repo_name": "r", "source_repo_link": "https://github.com/o/r"}
    found = page_extracts.extract_contributors(pages(spark, ("u", body, meta), ("v", "<p></p>", meta)))
    assert rows(found) == [
        ("r", "https://github.com/o/r", "https://github.com/ann", "1,204 commits"),
        ("r", "https://github.com/o/r", "https://github.com/bob", None),
    ]


def test_profile_page(spark):
    linked = """<a href="/ann?tab=repositories">Repositories <span title="12" class="Counter">12</span></a>
      <a href="/ann?tab=stars"><svg><path d="M8"></path></svg> Stars <span class="Counter">3</span></a>
      <a href="https://h/ann?tab=followers"><svg></svg><span class="text-bold">1.1k</span> followers</a>
      <a href="https://h/ann?tab=following"><span class="text-bold">4</span> following</a>
      <li itemprop="worksFor" class="p-1"><svg></svg><span class="p-org"><div><a href="/acme" class="u">@acme</a> <a href="/zeta">@zeta</a></div></span></li>
      <h2 class="f4">2,001 contributions in the last year</h2>
      <svg class="js-activity-overview-graph"><text class="js-highlight-percent-left" x="1">80%</text><text class="js-highlight-percent-top">5%</text></svg>
      <div><h2 class="h4">Organizations</h2><a aria-label="Acme Inc" href="/acme"></a><a href="/beta" aria-label="Beta"></a></div>"""
    plain = '<li itemprop="worksFor"><span class="p-org"><div>Solo &amp; Co</div></span></li>'
    docs = pages(spark, ("https://h/ann", linked, {}), ("https://h/bob", plain, {}), ("https://h/cy", "", {}))
    ann, bob, cy = page_extracts.extract_profiles(docs).orderBy("link").collect()
    assert (ann.number_of_repos, ann.number_of_stars, ann.number_of_followers, ann.number_following) == ("12", "3", "1.1k", "4")
    assert ann.number_of_contributions_past_year == "2,001 contributions in the last year"
    assert (ann.contrib_pct_commits, ann.contrib_pct_code_review, ann.contrib_pct_issues) == ("80%", "5%", None)
    assert ann.company_name == "@acme"
    assert [tuple(o) for o in ann.organizations] == [
        ("@acme", "/acme", 1), ("@zeta", "/zeta", 2),
        ("Acme Inc", "https://github.com/acme", 1), ("Beta", "https://github.com/beta", 2),
    ]
    assert (bob.company_name, bob.organizations) == ("Solo & Co", None)
    assert (cy.company_name, cy.number_of_repos) == (None, None)


def test_company_page(spark):
    body = '<a class="s" href="https://twitter.com/acme?a=1">t</a><a href="https://github.com/acme">g</a><a href="https://github.com/other">g</a>'
    docs = pages(spark, ("https://acme.com", body, {"domain": "acme.com", "og_company_name": "Acme"}))
    assert rows(page_extracts.extract_companies(docs)) == [
        ("Acme", "https://acme.com", "acme.com", "https://github.com/acme", None, None, "https://twitter.com/acme?a=1")
    ]


def test_company_page_of_careless_html(spark):
    body = "<A class=x HREF='https://www.facebook.com/acme'>f</A><a href=https://github.com/acme>g</a><a title='a' href = \"https://twitter.com/o'neil\">t</a>"
    docs = pages(spark, ("https://acme.com", body, {"domain": "acme.com"}))
    assert rows(page_extracts.extract_companies(docs), "github_url", "facebook_url", "twitter_url") == [
        ("https://github.com/acme", "https://www.facebook.com/acme", "https://twitter.com/o'neil")
    ]


def test_project_page(spark):
    def section(name, items, extra=""):
        return (
            f'<div class="sect1"><h2 dir="auto"><a id="user-content-{name}" href="#{name}"></a>{name}</h2>'
            f'<div class="sectionbody">{extra}<div class="ulist"><ul>{items}</ul></div></div></div>'
        )

    nested = '<div class="sect2"><h3>Sub</h3><div class="ulist"><ul><li><p><a href="/deep">Deep</a></p></li></ul></div></div>'
    items = (
        '<li><p><a href="https://one">One</a> - first &amp; best<br>more</p></li>'
        '<li><p>Lead <a href="https://two">Two</a> tail</p><div><ul><li><p><a href="/in">In</a></p></li></ul></div></li>'
    )
    article = section("tools", items, nested) + section("license", "<li><p><a href='/l'>L</a></p></li>")
    article += section("other", "<li><p>no link</p></li>")
    toc = [{"level": 1, "anchor": "top"}, {"level": 2, "anchor": "tools"}, {"level": 2, "anchor": "license"}, {"level": 2, "anchor": "other"}]
    data = overview({"overviewFiles": [{"headerInfo": {"toc": toc}, "richText": article}]})
    docs = pages(spark, ("https://list", island(data), {}), ("https://none", "<p></p>", {}))
    assert rows(page_extracts.extract_projects(docs)) == [
        ("#other", None, None, "no link"),
        ("#tools", "One", "https://one", " - first & best"),
        ("#tools", "Two", "https://two", "Lead "),
    ]


def frame(spark, schema, *records):
    """Rows of a raw table from text values, missing columns NULL."""
    names = sorted({k for r in records for k in r})
    data = [tuple(r.get(n) for n in names) for r in records]
    text = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    return align_schema(text, schema)


def regulator_raw(spark):
    at = "2023-07-01 08:00:00"
    later = "2023-07-01 21:00:00"
    fin = [
        dict(cert="1", namefull="Bank 1", asset="400000", dep="100", repdte="20230331", scraped_at=at),
        dict(cert="1", namefull="Bank 1", asset="400000", dep="100", repdte="20230331", scraped_at=later),
        dict(cert="1", namefull="Bank 1", asset="500000", dep="125", repdte="20230630", scraped_at=at),
        dict(cert="1", namefull="Bank 1", asset="510000", dep="100", repdte="20230630", scraped_at="2023-07-02 08:00:00"),
        dict(cert="2", namefull="Bank 2", asset="3000000000", dep="0", repdte="20230630", scraped_at=at),
    ]
    inst = [
        dict(cert="1", name="Bank 1", city="Old", stname="Texas", webaddr="www.old.com", dateupdt="12/31/2022", repdte="03/31/2023", scraped_at=at),
        dict(cert="1", name="Bank 1", city="New", stname="Ohio", webaddr="https://www.new.com/home?x", dateupdt="01/15/2023", repdte="06/30/2023", scraped_at=at),
    ]
    cycle = {"cu_number": "1", "cycle_date": "3/31/2023 0:00:00", "scraped_at": at}
    return {
        "bank_financials": frame(spark, schemas.RAW_BANK_FINANCIALS, *fin),
        "bank_institutions": frame(spark, schemas.RAW_BANK_INSTITUTIONS, *inst),
        "cu_branches": frame(spark, schemas.RAW_CU_BRANCHES, dict(cycle, cu_name="Union", physical_address_city="Austin", physical_address_state_code="TX")),
        "cu_fs220": frame(
            spark, schemas.RAW_FS220,
            dict(cycle, update_date="4/1/2023", acct_010="3000000000000", acct_018="95", acct_025b="1", acct_083="2", acct_902="3"),
            dict(cycle, cycle_date="6/30/2023 0:00:00", update_date="7/1/2023", acct_010="10", acct_018="100", acct_025b="1", acct_083="2", acct_902="3"),
        ),
        "cu_fs220a": frame(spark, schemas.RAW_FS220A, dict(cycle, acct_452="5", acct_115="6.50", acct_350="7", acct_131="8")),
        "cu_fs220d": frame(spark, schemas.RAW_FS220D, dict(cycle, cycle_date="2023-03-31", acct_891="union.org/x")),
        "cu_fs220n": frame(spark, schemas.RAW_FS220N, dict(cycle, acct_is0020="9")),
    }


def test_bank_mart_takes_newest_attributes_and_reports(spark):
    raw = regulator_raw(spark)
    financials = staging.stage_bank_financials(raw["bank_financials"])
    assert financials.count() == 4
    mart = marts.mart_banks(financials, staging.stage_bank_institutions(raw["bank_institutions"]), states(spark))
    got = rows(mart, "cert", "report_date", "city", "state_code", "domain", "total_deposits")
    assert [tuple(map(str, r)) for r in got] == [
        ("1", "20230331", "New", "OH", "new.com", "100000.000000"),
        ("1", "20230630", "New", "OH", "new.com", "100000.000000"),
        ("2", "20230630", "None", "None", "None", "0.000000"),
    ]


def test_amounts_keep_their_places(spark):
    raw = regulator_raw(spark)["bank_financials"].limit(1).withColumn("asset", F.lit("6.505").cast(schemas.MONEY))
    assert str(staging.stage_bank_financials(raw).first().total_assets) == "6505.000000"


def test_institution_keys_tell_periods_apart(spark):
    raw = regulator_raw(spark)["bank_institutions"].limit(1)
    two = raw.unionByName(raw.withColumn("repdte", F.lit("06/30/2023")))
    assert staging.stage_bank_institutions(two).select("dim_id").distinct().count() == 2
    assert staging.stage_bank_institutions(two, legacy_key=True).select("dim_id").distinct().count() == 1


def test_a_report_without_assets_has_no_key(spark, tmp_path):
    raw = regulator_raw(spark)
    fin = raw["bank_financials"].withColumn("asset", F.lit(None).cast("decimal(18,2)"))
    assert staging.stage_bank_financials(fin).filter("dim_id is not null").count() == 0
    with pytest.raises(AuditFailed, match="rows without one"):
        pipeline.run_regulator_pipeline({**raw, "bank_financials": fin}, str(tmp_path))


def test_regulator_pipeline(spark, tmp_path):
    metric = pipeline.run_regulator_pipeline(regulator_raw(spark), str(tmp_path))
    got = rows(
        metric, "inst_type", F.col("id_number").cast("int"), F.col("report_date").cast("string"), "asset_tier",
        "deposits_growth_prev_qtr", "deposits_growth_prev_qtr_tier", "state", "domain",
    )
    assert got == [
        ("bank", 1, "2023-03-31", "Less than $500M", None, None, "Ohio", "new.com"),
        ("bank", 1, "2023-06-30", "$500M to $1B", 0.0, "0% to 5% decline", "Ohio", "new.com"),
        ("bank", 2, "2023-06-30", "Greater than $3T", 0.0, "0% to 5% decline", None, None),
        ("credit union", 1, "2023-03-31", "Greater than $3T", None, None, "Texas", "union.org"),
        ("credit union", 1, "2023-06-30", "Less than $500M", 0.05, "0% to 5% growth", "Texas", None),
    ]
    accounts = frame(spark, schemas.RAW_ACCOUNTS, dict(acct_name="A"), dict(acct_name="A"), dict(acct_name="long name"))
    profile = pipeline.regulator_size_profile({**regulator_raw(spark), "cu_accounts": accounts}, metric)
    assert profile.select("schema_name", "table_name").distinct().count() == 12
    assert profile.filter("current_size_bytes is null or avg_size_bytes_by_qtrly_rp_date is null").count() == 0
    assert spark.table("mart_credit_unions").filter("total_int_inc_ytd = 6.5 and other_non_int_inc_ytd = 9").count() == 1


def page_raw(spark):
    at, later = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    repo = dict(job_id="j", name="r", link="R", description="desc", project_link="P", commits="1,000", contributors="20", pull_requests="null", stargazers="1.5k", forks=None, last_updated="null")
    return {
        "projects": frame(spark, schemas.RAW_PROJECTS, dict(project_link="P", project_description="about P", scraped_at=at)),
        "repos": frame(spark, schemas.RAW_REPOS, dict(repo, commits="5", scraped_at=at), dict(repo, scraped_at=later)),
        "contributors": frame(
            spark, schemas.RAW_CONTRIBUTORS,
            *[dict(repo_name="r", source_repo_link="R", profile_link=p, commits_to_source_repo=c, scraped_at=at) for p, c in (("ann", "300 commits"), ("bob", "100 commits"), ("cy", "50 commits"))],
        ),
        "profiles": frame(
            spark, schemas.RAW_PROFILES,
            dict(link="ann", company_name="@acme", scraped_at=at), dict(link="bob", company_name="@acme", scraped_at=at), dict(link="cy", scraped_at=at),
        ),
        "companies": frame(spark, schemas.RAW_COMPANIES, dict(domain="acme.com", linkedin_url="L", scraped_at=at)),
    }


def enrichment(spark):
    def answer(i, name, domain, asked, at):
        outputs = json.dumps([{"name": name, "domain": domain}])
        return dict(id=i, outputs=outputs, meta=json.dumps({"og_company_name": asked}), created_at=at)

    return frame(
        spark, schemas.RAW_ENRICHMENT,
        answer("1", "Acme old", "acme.com", "@acme", "2024-01-01 00:00:00"),
        answer("2", "Acme", "acme.com", "@acme", "2024-01-02 00:00:00"),
        answer("3", "Idle", "idle.com", "@idle", "2024-01-02 00:00:00"),
        answer("4", "Lost", None, "@lost", "2024-01-02 00:00:00"),
    )


def test_page_pipeline(spark, tmp_path):
    totals, shares = pipeline.run_page_pipeline(page_raw(spark), enrichment(spark), str(tmp_path))
    assert rows(spark.table("map_company_contributor")) == [
        ("Acme", "acme.com", "ann", "R"), ("Acme", "acme.com", "bob", "R"), ("Idle", "idle.com", None, None),
    ]
    total = totals.select([F.col(c).cast("string") for c in totals.columns]).first().asDict()
    assert total["repo_description"] == "about P"
    assert float(total["total_num_of_commits"]) == 1000
    assert float(total["num_of_commits_from_top10_contribs_w_comp"]) == 400
    assert total["num_of_top10_contribs_w_comp"] == "2"
    share = shares.first()
    assert (share.linkedin_url, share.pct_top10_contrib_commits_from_comp, share.pct_top10_contribs_from_comp) == ("L", 0.4, 0.1)


def test_one_domain_under_two_names_fans_out(spark):
    """Commits join on the domain alone, so each name of a domain gets every name's total."""
    company_map = spark.createDataFrame(
        [("A", "d", "ann", "R"), ("B", "d", "bob", "R")],
        "company_name string, domain string, github_profile_link string, contrib_on_repo_link string",
    )
    raw = page_raw(spark)
    contributions = marts.mart_company_contrib(
        staging.stage_repos(raw["repos"]), staging.stage_projects(raw["projects"]),
        staging.stage_contributors(raw["contributors"]), staging.stage_companies(raw["companies"]), company_map,
    )
    got = rows(contributions, "company_name", F.col("comp_num_of_commits_on_repo").cast("int"))
    assert got == [("A", 100), ("A", 300), ("B", 100), ("B", 300)]


def test_extracts_feed_staging(spark):
    """A crawled page becomes a raw row, and the raw row a staged one."""
    docs = pages(spark, ("https://github.com/o/r", REPO, {"project_link": "P"})).withColumns(
        {"job_id": F.lit("j"), "scraped_at": F.lit("2024-01-01 00:00:00").cast("timestamp")}
    )
    raw = align_schema(page_extracts.extract_repos(docs, keep=("job_id", "scraped_at")), schemas.RAW_REPOS)
    staged = staging.stage_repos(raw).first()
    assert (int(staged.commits), int(staged.stargazers), int(staged.contributors)) == (1234, 1200, 17)
    assert str(staged.last_updated).startswith("2024-02-03")


def test_size_profile_keeps_one_average_per_table(spark):
    df = spark.createDataFrame([("q1", "a"), ("q1", "bb"), ("q2", "c")], "p string, s string")
    profile = metrics.size_profile({("raw", "t"): (df, "p")})
    assert rows(profile, "period", "current_size_bytes", "avg_size_bytes_by_qtrly_rp_date") == [
        ("q1", 55, 41.0), ("q2", 27, 41.0),
    ]
    totals = metrics.size_totals(profile).first()
    assert totals.total_current_size_gb == 82 / 1024**3
    assert totals.total_avg_size_gb_by_qtrly_rp_date == 41.0 / 1024**3


def test_contributors_are_staged_once_for_map_and_mart(spark, monkeypatch):
    from catalog import QUERIES, jobs

    kept, store = [], jobs.stored
    monkeypatch.setattr(jobs, "stored", lambda df, label: kept.append(label) or store(df, label))
    text = QUERIES["mart_company_contrib"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert kept == ["contributors", "company_map"] and "l_orderkey" not in text and "l_partkey" not in text
