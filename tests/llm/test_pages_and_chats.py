"""Page extraction, archives, transcripts and mixing: by hand, by round trip, by brute force."""

import gzip
import hashlib
import io
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import CLASHES, documents, odd_rows, prose
from tidemark.llm import extraction, legacy_archives, mixing, transcripts
from tidemark.session import scratch_dir

# -- extraction -------------------------------------------------------------

LONG = "A paragraph of some length, with commas, and with a second sentence. It goes on for a while."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<nav>menu</nav>", ""),
        (f"<body><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>{LONG}</p><p>Short</p></article><footer>f</footer>", f"T & U\n{LONG}\nShort"),
        (f"<article><p>{LONG}<p><b>open  bold\n here<br>and</b> on</article>", f"{LONG}\nopen bold here and on"),
        (f'<script>var a="</p>";</script><style>p{{}}</style><!-- <p>no</p> --><div><p>{LONG}</p></div>', LONG),
        (f'<div class="post"><p>{LONG}</p></div><div class="ad">Buy, buy. Buy!</div><div id="comments"><p>{LONG}</p></div>', LONG),
        (f'<div class="cookie-notice">{LONG}</div><main><p>{LONG} x</p></main><aside>{LONG}</aside><form>{LONG}</form>', f"{LONG} x"),
        (f'<body class="has-sidebar"><div class="sidebar">{LONG}</div><div class="text"><p>{LONG}</p></div>', LONG),
        (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", f"{LONG}\none\ntwo\na\nb"),
        (f"<p>{LONG} &eacute;&#233;&#xe9;&lt;b&gt;</p>", f"{LONG} ééé<b>"),
        (f'<p title="a > b">{LONG}</p><a href="x>unclosed', f"{LONG}\nunclosed"),
        ("<p>same</p><p>same</p>", "same\nsame"),
    ],
)
def test_main_text(html, text):
    assert extraction.main_text(html) == text


ITEMS = "".join(f"<li>{LONG} {i}</li>" for i in range(40))
ITEM_LINES = "\n".join(f"{LONG} {i}" for i in range(40))
CELLS = ITEMS.replace("<li>", "<tr><td>").replace("</li>", "</td></tr>")


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>"), ("<body>", "</body>")])
@pytest.mark.parametrize("body", [f"<ul>{ITEMS}</ul>", f"<table>{CELLS}</table>", f'<div class="body"><ul>{ITEMS}</ul></div>', f"<section>{ITEMS.replace('li>', 'p>')}</section>"])
def test_title_and_intro_beside_a_dominant_block(open_, close, body):
    page = f"<nav>menu</nav>{open_}<h1>T</h1><p>intro</p>{body}<p>end</p>{close}<footer>f</footer>"
    assert extraction.main_text(page) == f"T\nintro\n{ITEM_LINES}\nend"
    page = f"<nav>menu</nav>{open_}<h1>T</h1>{body}{close}<footer>f</footer>"
    assert extraction.main_text(page) == f"T\n{ITEM_LINES}"


STORY = f"<h1>T</h1><p>{LONG}</p><p>{LONG} 2</p>"
STORY_LINES = f"T\n{LONG}\n{LONG} 2"
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li><li><a href=d>Contact</a></li></ul>'


@pytest.mark.parametrize(
    "html, text",
    [
        # names that say what else the page has, and frames around the whole page
        (f'<div class="content with-sidebar">{STORY}</div>', STORY_LINES),
        (f'<div class="page has-comments">{STORY}</div>', STORY_LINES),
        (f'<div class="has-nav"><article>{STORY}</article></div>', STORY_LINES),
        (f'<form id="aspnetForm"><div class="menu">{MENU}</div>{STORY}</form>', STORY_LINES),
        (f'<div class="widget-container">{STORY}</div>', STORY_LINES),
        # a listed word within another name
        (f'<div id="share-price">{STORY}</div>', STORY_LINES),
        (f'<article>{STORY}<section class="related-work"><h2>R</h2><p>{LONG} 3</p></section></article>', f"{STORY_LINES}\nR\n{LONG} 3"),
        (f'<article>{STORY}<div class="social-history"><p>{LONG} 3</p></div></article>', f"{STORY_LINES}\n{LONG} 3"),
        (f'<article>{STORY}<div class="related-pieces">{MENU}</div></article>', STORY_LINES),
        # menus without a name
        (f"<body>{MENU}{STORY}</body>", STORY_LINES),
        (f"<article>{MENU}{STORY}</article>", STORY_LINES),
        (f'<body><div class="topbar"><p>Call us now</p></div>{STORY}</body>', STORY_LINES),
        # more comments than article, a form beside it, a link within it
        (f'<div class="post">{STORY}</div><div id="comments">{f"<p>{LONG} c</p>" * 20}</div>', STORY_LINES),
        (f"<main>{STORY}<form><p>{LONG} f</p></form></main>", STORY_LINES),
        (f'<article>{STORY}<p><a href="/n">Next</a></p></article>', f"{STORY_LINES}\nNext"),
    ],
)
def test_names_are_no_verdict(html, text):
    assert extraction.main_text(html) == text


def brute_ratios(nodes):
    """Path ratios of (path, text) pieces, written out one by one."""
    def mean(values):
        values = list(values)
        return sum(values) / len(values)

    fused = []
    for path, _ in nodes:
        own = [t for p, t in nodes if p == path]
        fused.append(mean(len(t) for t in own) * (1 + mean(sum(c in ".,;:!?…。、，！？；：" for c in t) for t in own)))
    smooth = []
    for i in range(len(fused)):
        near = [(w, fused[i + d]) for d, w in ((-2, 0.05), (-1, 0.2), (0, 0.5), (1, 0.2), (2, 0.05)) if 0 <= i + d < len(fused)]
        smooth.append(sum(w * x for w, x in near) / sum(w for w, _ in near))
    return [mean(s for (p, _), s in zip(nodes, smooth) if p == path) for path, _ in nodes]


def test_path_ratios_by_brute_force():
    html = f"<body>{MENU}<div class='a'>{STORY}<p>x, y; z!</p></div><div class='b'><p>{LONG}</p><span>s</span></div>{MENU}</body>"
    nodes = [(e, " ".join(t.split())) for e, t, _ in extraction.pieces(html) if t.strip()]
    want = brute_ratios([(e.path, t) for e, t in nodes])
    assert len(set(want)) > 3 and extraction.path_ratios(nodes) == pytest.approx(want)


def test_title_of_main_around_an_article():
    assert extraction.main_text(f"<main><h1>T</h1><article><ul>{ITEMS}</ul></article></main>") == f"T\n{ITEM_LINES}"


def test_page_of_very_many_tags():
    html = "<article>" + "<div>" * 300 + LONG + "<a href='/x'>" + "<b>x" * 20_000
    assert extraction.main_text(html).startswith(LONG)
    assert len(extraction.main_text(f"<p>{'word, ' * 200_000}</p>")) == 6 * 200_000 - 1


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", *[f"'x' AS {c}" for c in (*CLASHES, "text", "n_chars", "payload_digest", "records")])


def test_extraction_of_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", f"<p>{LONG}</p>"), (2, "v", "")]
    out = extraction.extract(pages(spark, rows)).collect()
    assert sorted((tuple(r) for r in out), key=repr) == sorted(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", LONG, len(LONG)), (2, "v", "", 0)], key=repr
    )
    assert extraction.extract(pages(spark, [])).count() == 0


# -- archives ---------------------------------------------------------------


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    fields = {"URL": "http://a.example/x y", "IP-address": "1.2.3.4", "Archive-date": "19970102030405", "Content-type": "text/html", "Result-code": "200"}
    contents = [b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\n\n", b"", b"not http \x00\xff"]
    data = legacy_archives.arc_version_block("x.arc", version)
    for content in contents:
        data += legacy_archives.arc_header(fields, version, len(content)) + content + b"\n"
    found = list(legacy_archives.read_arc(io.BytesIO(data), "x.arc"))
    assert [r.content for r in found] == contents and [r.number for r in found] == [0, 1, 2]
    assert found[0].fields["URL"] == "http://a.example/x y" and found[0].fields["IP-address"] == "1.2.3.4"
    warc = b"".join(legacy_archives.to_warc(r, "x.arc", None) for r in found)
    headers, blocks = zip(*legacy_archives.read_warc(io.BytesIO(warc), "x.warc"))
    assert list(blocks) == contents and [h["WARC-Type"] for h in headers] == ["response", "resource", "resource"]
    assert headers[0]["WARC-Date"] == "1997-01-02T03:04:05Z" and headers[0]["WARC-IP-Address"] == "1.2.3.4"
    assert headers[0]["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(b"hello\n\n").hexdigest()
    assert len({h["WARC-Record-ID"] for h in headers}) == 3


@pytest.mark.parametrize("spoil", [lambda d: d[:-4], lambda d: d.replace(b" 30\n", b" x\n"), lambda d: d.replace(b"\n1 0", b"\n7 0"), lambda d: d + b"a b\n"])
def test_broken_archives_are_errors(spoil):
    content = b"HTTP/1.0 200 OK\r\n\r\n" + b"y" * 11
    fields = {"URL": "u", "IP-address": "-", "Archive-date": "1997", "Content-type": "t"}
    data = legacy_archives.arc_version_block("x.arc", 1) + legacy_archives.arc_header(fields, 1, len(content)) + content + b"\n"
    data = spoil(data.rstrip(b"\n") if spoil(data)[-1:] != b"\n" else data)
    with pytest.raises(ValueError, match="x.arc"):
        list(legacy_archives.read_arc(io.BytesIO(data), "x.arc"))


def archived(spark, rows, archive_bytes=legacy_archives.ARCHIVE_BYTES):
    arc = legacy_archives.write_arc(pages(spark, rows).repartition(3), scratch_dir(spark, "arc"), archive_bytes)
    folder = scratch_dir(spark, "warc")
    warc = legacy_archives.convert(arc, folder)
    return legacy_archives.resolved(legacy_archives.read_records(warc)), folder


@pytest.mark.parametrize("archive_bytes", [legacy_archives.ARCHIVE_BYTES, 300])
def test_pages_through_both_formats(spark, archive_bytes):
    big, small = "<p>" + "é" * 60, "tiny"
    rows = [(9, "u", big), (3, "u", big), (4, None, big), (5, "a b\nc", small), (6, "ü", small), (7, "w", None), (8, "w", ""), (None, "w", big), (10, "u", "z" * 300_000)]
    out, folder = archived(spark, rows, archive_bytes)
    body = lambda h: (h or "").encode()
    want = []
    for i, _, html in rows:
        again = len(body(html)) >= 100 and html == big and i != 3
        want.append((i, len(body(html)), hashlib.sha256(body(html)).hexdigest(), "revisit" if again else "response", 3 if again else None))
    got = [tuple(r) for r in out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    files = legacy_archives.find_archives(spark, folder).collect()
    assert files and all(gzip.open(f.path.removeprefix("file:")).read(8) == b"WARC/1.0" for f in files)


def test_repeated_pages_and_no_pages(spark):
    out, _ = archived(spark, [(1, "u", "q" * 200)] * 3)
    kinds = sorted((r.page_id, r.record_type, r.refers_to) for r in out.collect())
    assert [k[1] for k in kinds] == ["response", "revisit", "revisit"] and {k[2] for k in kinds if k[1] == "revisit"} == {1}
    assert archived(spark, [])[0].count() == 0


# -- transcripts ------------------------------------------------------------


def test_viterbi_against_every_path():
    rng = np.random.default_rng(4)
    n = transcripts.N_STATES
    model = transcripts.Model(np.log(rng.dirichlet(np.ones(n))), np.log(rng.dirichlet(np.ones(n), n)), tuple(np.log(rng.dirichlet(np.ones(k), n)) for k in transcripts.FACTORS))
    seen = np.stack([rng.integers(0, k, 4) for k in transcripts.FACTORS], 1)
    score = lambda path: (
        model.start[path[0]] + sum(model.step[a, b] for a, b in itertools.pairwise(path))
        + sum(t[s, seen[i, f]] for i, s in enumerate(path) for f, t in enumerate(model.shows))
    )
    best = max(itertools.product(range(n), repeat=4), key=score)
    assert transcripts.viterbi(model, seen).tolist() == list(best)


@pytest.mark.parametrize("line, role", [("User: hi", 1), ("  AI : yes", 2), ("### Assistant: x", 2), ("<|system|> be", 3), ("Note that: this", 0), ("12: x", 0), ("", 0)])
def test_markers(line, role):
    assert transcripts.marker(line)[0] == role


def turns(spark, n=160):
    rows = []
    for c in range(n):
        for t in range(2 + c % 5):
            user = t % 2 == 0
            rows.append((c, t, "user" if user else "assistant", prose(c * 31 + t, 8 if user else 60) + ("?" if user else ".\n" + prose(c + t, 30))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", *[f"'x' AS {c}" for c in (*CLASHES, "lines", "style", "own", "belongs", "rendered")])


def test_roles_are_recovered_and_text_kept(spark):
    df = turns(spark)
    out = transcripts.recovered(df).collect()
    given = {(r.conv_id, r.turn): r for r in df.collect()}
    assert len(out) == len(given)
    marked = {r[0] for r in df.where(F.pmod(F.xxhash64("conv_id"), F.lit(4)) < 3).select("conv_id").distinct().collect()}
    assert np.mean([r.role == r.role_found for r in out if r.conv_id in marked]) > 0.99
    assert np.mean([r.role == r.role_found for r in out if r.conv_id not in marked]) > 0.8
    for r in out:
        body = [x for x in r.rendered.split("\n") if x and not x.startswith("<|")]
        assert body == [x.strip() for x in given[r.conv_id, r.turn].text.split("\n")]


def test_odd_turns(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, 0, None, ""), (1, 0, "robot", "a"), (1, 0, "robot", "a"), (None, None, "user", ""), (2, 0, "user", "x\n" * 3_000), (2, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = transcripts.recovered(df).collect()
    assert sorted(((r.conv_id, r.turn, r.role) for r in out), key=repr) == sorted((row[:3] for row in rows), key=repr)
    assert transcripts.recovered(df.limit(0)).count() == 0


def test_long_transcripts_in_windows(spark, monkeypatch):
    df = spark.createDataFrame([(1, t, ("user", "assistant")[t % 2], f"line {t}") for t in range(100)], "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, transcripts.recovered(df).collect()))
    monkeypatch.setattr(transcripts, "WINDOW", 16)
    monkeypatch.setattr(transcripts, "CONTEXT", 4)
    windowed = transcripts.windows(transcripts.transcripts(df))
    assert windowed.where("belongs").count() == 100 and windowed.groupBy("window").count().agg(F.max("count")).first()[0] <= 24
    assert sorted(map(tuple, transcripts.recovered(df).collect())) == whole


# -- mixing -----------------------------------------------------------------


def brute_targets(sizes):
    """Share by weight, stop at twice the size, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 2.0 * sizes[s] for s in over})


def test_mix_meets_targets(spark):
    rows = [(i, prose(i, 20 + i % 400), "en", ("big", "b", "c", None, "d")[min(i % 9, 4)]) for i in range(240)] + odd_rows()
    docs = documents(spark, rows)
    out = mixing.mix(docs).collect()
    words = lambda t: len(("" if t is None else t).replace("\x0b", " ").replace("\x0c", " ").encode().split())
    assert sorted((r.doc_id or -1, r["size"]) for r in out) == sorted((i or -1, words(t)) for i, t, _, _ in rows)
    sizes, taken, targets = {}, {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
        assert r.source_size >= r["size"] and 0 <= r.taken <= 2 * r["size"]
    assert targets == pytest.approx(brute_targets(sizes))
    assert all(abs(taken[s] - targets[s]) <= 2 * mixing.BLOCK for s in sizes)
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=repr) == sorted(map(tuple, out), key=repr)
    assert mixing.mix(documents(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(documents(spark, [(1, None, None, "a"), (1, "", None, "a")])).collect()] == [0, 0]


def test_slots_are_permutations_and_shards_draws(spark):
    sources = spark.createDataFrame([("a", 1, 640, 0.0, 10, 20), ("b", 2, 1, 0.0, 1, 1), ("c", 3, 9, 0.0, 1000, 1300), ("d", 4, 0, 0.0, 0, 0)], "source string, number int, source_size long, target double, blocks long, slots long")
    slots = mixing.drawn_slots(sources)
    rows = slots.collect()
    assert sorted((r.number, r.slot) for r in rows) == [(1, i) for i in range(20)] + [(2, 0)] + [(3, i) for i in range(1300)]
    for number, blocks in ((1, 10), (3, 1000)):
        first = [r["index"] for r in rows if r.number == number and r.slot < blocks]
        assert sorted(first) == list(range(blocks)) and first != sorted(first)
    counts = mixing.shard_counts(slots).collect()
    assert sum(r.slots for r in counts) == 1321 and max(r.shard for r in counts) < mixing.SHARDS


def test_blocks_hold_the_words_taken(spark):
    docs = documents(spark, [(i, prose(i, 30 + i), "en", "ab"[i % 2]) for i in range(30)])
    taken = {r.source: r.n for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    found = {}
    for r in mixing.mixed_blocks(docs).collect():
        assert len(r.text.split()) <= mixing.BLOCK
        found[r.source] = found.get(r.source, 0) + len(r.text.split())
    assert found == taken
