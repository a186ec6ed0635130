"""Column expressions on the values the given tables lack."""

import hashlib
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import dates, keys, numbers, pages, sql, text
from tidemark.sources.delimited import snake_case
from tidemark.sources.lookups import state_name_of


def values(spark, kind, items, *expressions):
    df = spark.createDataFrame([(x,) for x in items], f"x {kind}").coalesce(1)
    return [tuple(r) for r in df.select(*expressions).collect()]


def column(spark, kind, items, expression):
    return [r[0] for r in values(spark, kind, items, expression)]


def test_text_to_num(spark):
    texts = ["1,234", "1.2k", "5,000+", "12 commits", "3K", "2m", "7 kg", "null", None, "1.234567k"]
    expected = ["1234", "1200", "5000", "12", "3", "2", "7000", None, None, "1234.567"]
    got = column(spark, "string", texts, text.text_to_num("x"))
    assert got == [None if e is None else Decimal(e) for e in expected]


def test_text_without_a_number(spark):
    assert column(spark, "string", ["", "many", "1.2.3"], text.text_to_num("x", strict=False)) == [None] * 3
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, "string", ["many"], text.text_to_num("x"))


def test_null_sentinel(spark):
    assert column(spark, "string", ["null", "", "NULL", None], text.null_sentinel("x")) == [None, "", "NULL", None]


@pytest.mark.parametrize(
    "url, domain",
    [
        ("https://www.x.com/p?q", "x.com"),
        ("www.a.org", "a.org"),
        ("HTTP://WWW.B.COM/x", "WWW.B.COM"),
        ("host.net:8080/a", "host.net:8080"),
        ("http://a.com?u=http://b.com/c", "b.com"),
        ("", ""),
        (None, None),
    ],
)
def test_url_domain(spark, url, domain):
    assert column(spark, "string", [url], text.url_domain("x")) == [domain]


def test_url_path_segment(spark):
    urls = ["https://h/owner/repo", "https://h/owner/repo/tree?x=1", "https://h/owner"]
    assert column(spark, "string", urls, text.url_path_segment("x", 2)) == ["repo", "repo", ""]


def test_json_text(spark):
    docs = ['[{"name":"a"}]', '[{"name":null}]', "[]", "{broken", None]
    assert column(spark, "string", docs, text.json_text("x", "$[0].name")) == ["a", None, None, None, None]


def test_keys_collide_without_separator(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    plain = [r[0] for r in df.select(keys.md5_key(["a", "b"])).collect()]
    assert plain == [hashlib.md5(b"123").hexdigest()] * 2
    apart = [r[0] for r in df.select(keys.md5_key(["a", "b"], sep="|")).collect()]
    assert apart[0] == hashlib.md5(b"1|23").hexdigest() and apart[0] != apart[1]


def test_null_key_parts(spark):
    df = spark.createDataFrame([("1", None)], "a string, b string")
    strict, coalesced = df.select(keys.md5_key(["a", "b"]), keys.md5_key(["a"], ["b"])).first()
    assert strict is None and coalesced == hashlib.md5(b"1").hexdigest()


def test_numeric_text(spark):
    items = [Decimal("5.00"), Decimal("5.50"), Decimal("100.00"), Decimal("-0.25"), None]
    assert column(spark, "decimal(18,2)", items, keys.numeric_text("x")) == ["5", "5.5", "100", "-0.25", None]
    assert column(spark, "decimal(18,0)", [Decimal(100)], keys.numeric_text("x")) == ["100"]


def test_parse_day_works_its_ladder_out_once(spark):
    df = spark.createDataFrame([("1/2/2023",)], "x string").select(dates.parse_day("x").alias("day"))
    written = df._jdf.queryExecution().optimizedPlan().toString()
    assert written.count("RLIKE") == 3 and "regexp_replace" not in written
    slashed = ["1/2/2023", "01/02/2023 10:00:00", "1/02/2023T1/2", "1/2/2023\n"]
    assert column(spark, "string", slashed, dates.parse_day("x")) == [date(2023, 1, 2)] * 4


def test_parse_day(spark):
    written = ["20230331", "3/31/2023", "03/31/2023 0:00:00", "2023-03-31", "2023-03-31 10:00:00", None]
    assert column(spark, "string", written, dates.parse_day("x")) == [date(2023, 3, 31)] * 5 + [None]
    wrong = ["31.03.2023", "20231331", "soon", "202303", "2023", "2023331", "2023-3-31", "-0230331"]
    assert column(spark, "string", wrong, dates.parse_day("x", strict=False)) == [None] * 8
    with pytest.raises(Exception, match="not a report day"):
        column(spark, "string", ["2023"], dates.parse_day("x"))


def test_quarters(spark):
    days = [date(2024, 1, 1), date(2024, 5, 17), date(2024, 12, 31)]
    assert column(spark, "date", days, dates.previous_quarter_end("x")) == [
        date(2023, 12, 31),
        date(2024, 3, 31),
        date(2024, 9, 30),
    ]
    assert column(spark, "date", days, dates.quarter_end("x")) == [
        date(2024, 3, 31),
        date(2024, 6, 30),
        date(2024, 12, 31),
    ]


def test_months_ahead_clips(spark):
    assert column(spark, "date", [date(2024, 1, 31)], dates.months_ahead("x", 1)) == [date(2024, 2, 29)]


def test_asset_tiers(spark):
    items = [Decimal(0), Decimal("499999999.99"), Decimal(500_000_000), Decimal(2_999_999_999_999), Decimal(3_000_000_000_000), None]
    assert column(spark, "decimal(18,2)", items, numbers.tier_below("x")) == [
        "Less than $500M",
        "Less than $500M",
        "$500M to $1B",
        "$1T to $3T",
        "Greater than $3T",
        "Greater than $3T",
    ]
    unknown = numbers.tier_below("x", null_tier=None)
    assert column(spark, "decimal(18,2)", [None], unknown) == [None]


def test_growth_tiers(spark):
    items = [-0.06, -0.05, -0.01, 0.0, 0.03, 0.05, 0.0501, None]
    assert column(spark, "double", items, numbers.growth_tier("x")) == [
        ">5% decline",
        ">5% decline",
        "0% to 5% decline",
        "0% to 5% decline",
        "0% to 5% growth",
        "0% to 5% growth",
        ">5% growth",
        None,
    ]


def test_divisions(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (1, None), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(numbers.guarded_divide("a", "b")).collect()] == [0.0, 0.25, None, None]
    assert [r[0] for r in df.select(numbers.ratio("a", "b", safe=True)).collect()] == [None, 0.25, None, None]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(numbers.ratio("a", "b")).collect()


def test_state_names(spark):
    assert column(spark, "string", ["TX", "Ohio", "tx", None], state_name_of("x")) == ["Texas", "Ohio", None, None]


@pytest.mark.parametrize(
    "name, usual, legacy",
    [
        ("CU_NUMBER", "cu_number", "cu_number"),
        ("CU_Number", "cu_number", "cu_number"),
        ("CycleCode", "cycle_code", "cyclecode"),
        ("PhysicalAddressCity", "physical_address_city", "physical_address_city"),
        ("ACCT_010", "acct_010", "acct_010"),
        ("JoinID", "join_id", "join_i_d"),
        ("already_snake", "already_snake", "already_snake"),
    ],
)
def test_snake_case(name, usual, legacy):
    assert snake_case(name) == usual
    assert snake_case(name, legacy=True) == legacy


def test_unescape_html(spark):
    texts = ["a &amp; b", "&#233;t&#xE9;", "&lt;b&gt; &amp;lt;", "plain", "&#x1F600;", "&#55296;", None]
    assert column(spark, "string", texts, pages.unescape_html("x")) == [
        "a & b", "été", "<b> &lt;", "plain", "\U0001F600", "&#55296;", None,
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.none() | st.sampled_from("pq")), min_size=1, max_size=8))
def test_separated_keys_are_equal_only_for_equal_parts(spark, parts):
    df = spark.createDataFrame(parts, "a string, b string, c string")
    found = df.select("a", "b", "c", keys.md5_key(["a", "b", "c"], sep="|").alias("k")).collect()
    present = {(r.a, r.b, r.c): r.k for r in found if r.c is not None}
    assert len(set(present.values())) == len(present)
    assert all(r.k is None for r in found if r.c is None)


def test_struct_lists(spark):
    html = '<a href="/1">one</a><a href="/2">two</a>'
    pairs = pages.struct_list("x", r'<a href="([^"]*)">([^<]*)', ("href", "name"))
    got = column(spark, "string", [html, ""], pages.concat_or_null(pages.ordered_structs(pairs)))
    assert [tuple(r) for r in got[0]] == [("/1", "one", 1), ("/2", "two", 2)]
    assert got[1] is None


def test_first_text_is_null_when_absent(spark):
    assert column(spark, "string", ["<b></b>", "<b>x</b>", ""], pages.first_text("x", "<b>([^<]*)")) == [None, "x", None]
    attr = pages.first_attribute("x", "relative-time", "datetime")
    times = ['<relative-time class="c" datetime="2024">', "<relative-time>", "none"]
    assert column(spark, "string", times, attr) == ["2024", None, None]


def test_network_links(spark):
    rows = [
        ("linkedin.com", '<a href="https://www.linkedin.com/jobs">j</a>'),
        ("facebook.com", '<a href="https://www.facebook.com/x">f</a>'),
        ("facebook.com", "<p>none</p>"),
        ("other.com", "<p>none</p>"),
    ]
    df = spark.createDataFrame(rows, "domain string, html string").coalesce(1)
    wins = pages.network_link("html", "linkedin", F.col("domain"), "linkedin.com", "HOME", home_wins=True)
    yields = pages.network_link("html", "facebook", F.col("domain"), "facebook.com", "HOME")
    assert [tuple(r) for r in df.select(wins, yields).collect()] == [
        ("HOME", None),
        (None, "https://www.facebook.com/x"),
        (None, "HOME"),
        (None, None),
    ]


def test_sql_calls_the_counter_rule_and_the_projection(spark):
    sql.register(spark)
    found = spark.sql("SELECT text_to_num(c) AS n FROM VALUES ('1,234'), ('1.2k'), ('12 commits'), ('null'), (NULL) AS t(c)")
    assert [None if r.n is None else float(r.n) for r in found.collect()] == [1234.0, 1200.0, 12.0, None, None]
    rows = spark.sql("SELECT * FROM size_projection(10, 3, DATE'2024-01-31')").collect()
    assert [(r.months, r.total_size_gb, str(r.future_date)) for r in rows] == [(3, 13.0, "2024-04-30"), (6, 16.0, "2024-07-31"), (9, 19.0, "2024-10-31"), (12, 22.0, "2025-01-31")]
    assert [r.total_size_gb for r in spark.sql("SELECT * FROM size_projection(10, 3, months_per_report => 1)").collect()] == [19.0, 28.0, 37.0, 46.0]
    sizes = spark.sql("SELECT p.* FROM VALUES (1.0D, 2.0D), (5.0D, 6.0D) AS t(c, a), LATERAL size_projection(c, a) AS p")
    assert sizes.count() == 8 and "NestedLoop" not in sizes._jdf.queryExecution().executedPlan().toString()
