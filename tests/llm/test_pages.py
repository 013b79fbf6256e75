from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest

from starloom.llm import html_text, warc

PAGES = "page_id long, url string, html string"


def text_of(html, paths=()):
    return html_text.main_text(html_text.parse(html), list(paths))


def page(body):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>{body}</body></html>'


ARTICLE = "<article><h1>Head &amp; line</h1><p>First  paragraph,\n with <b>bold</b> text.</p><p>Second&nbsp;one.<br>More.</p></article>"
WANTED = "Head & line\nFirst paragraph, with bold text.\nSecond one. More."


@pytest.mark.parametrize(
    "noise",
    [
        "",
        "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav>",
        "<header>Site <p>name</p></header>",
        "<footer>&copy; somebody</footer>",
        "<aside><p>Side</p></aside>",
        '<div class="ad">Buy this, and that, and all of it, now, before it is gone for ever and ever.</div>',
        "<div id='cookie-notice'>We use cookies.</div>",
        "<form><p>Search</p><input name=q><button>Go</button></form>",
        "<div class='sidebar-2'><p>Other</p></div>",
        "<section class='comments'><article class='comment'><p>I liked it, very much, really.</p></article></section>",
        "<script>if (a < b) document.write('<p>no</p>')</script><style>.x{}</style><noscript>no</noscript>",
        "<!-- <p>no</p> -->",
        "<div hidden>no</div><div style='display: none'>no</div><div role='navigation'>no</div>",
    ],
)
def test_the_article_is_left(noise):
    assert text_of(page(noise + ARTICLE)) == WANTED
    assert text_of(page(ARTICLE + noise)) == WANTED


def test_noise_inside_the_article_goes():
    inner = ARTICLE.replace("</h1>", "</h1><div class='share'>Share</div><aside>Box</aside><ul class='related'><li>x</li></ul>")
    assert text_of(page(inner)) == WANTED


def test_broken_markup():
    assert text_of("<body><article><h1>A</h1><p><b>One.<br><p>Two.</article><footer>x") == "A\nOne.\nTwo."
    assert text_of("<body><article><p>Cut off in the midd") == "Cut off in the midd"
    assert text_of("<body><article><p>1 < 2 and 3 &gt; 2 &am") == "1 < 2 and 3 > 2 &am"
    assert text_of("no tags at all") == "no tags at all"
    assert text_of("") == ""


def test_generalised_paths_leave_out_digits():
    assert html_text.best_path(html_text.parse("<body><div class='Post-12 x'><p>Long text.</p></div></body>")) == (
        ">body>div.post-#.x"
    )


def test_hosts_vote(spark):
    main = "<div class='main-{}'><p>{}</p></div>"
    box = "<div class='box'><p>{}</p></div>"
    rows = [(i, f"http://h.example/{i}", page(main.format(i, "long text, " * 30) + box.format("short"))) for i in range(9)]
    # On one page the box has nearly all of the text: the host's path holds too little of it.
    rows.append((9, "http://H.example/9", page(main.format(9, "brief") + box.format("much longer text, " * 30))))
    rows.append((10, "http://other.example/", page(main.format(9, "brief") + box.format("much longer text"))))
    # On another it has a little less than half, and the host's path wins, though alone the page would keep both.
    rows.append((11, "http://h.example/11", page(main.format(11, "long text, " * 12) + box.format("longer text, " * 9))))
    found = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found[9] == ("much longer text, " * 30).strip() and found[10] == "brief\nmuch longer text"
    assert found[11] == ("long text, " * 12).strip()
    assert found[3] == ("long text, " * 30).strip()


NOISE = "<div class='menu'><a href='/'>Home</a> <a href='/x'>All news of today</a></div>"
LONG = "It was said, at length, and by many, that this would never come to pass. " * 6


@pytest.mark.parametrize(
    ("body", "wanted"),
    [
        (f"<div class='story'><div class='lead'><p>The lead.</p></div><div class='text'><p>{LONG}</p></div></div>", ["The lead.", LONG]),
        (
            f"<div class='post'><h1>Headline</h1><section><p>{LONG}</p></section><section class='b'><p>{LONG}</p><p>End.</p></section></div>",
            ["Headline", LONG, LONG, "End."],
        ),
        (f"<div id='c'><table><tr><td><h1>Old page</h1><p>{LONG}</p></td></tr></table></div>", ["Old page", LONG]),
        (f"<div class='has-sidebar with-menu'><h1>Wrapped</h1><p>{LONG}</p></div>", ["Wrapped", LONG]),
        (
            f"<article><h1>A</h1><div class='header-image'><p>A caption.</p></div><p class='legal'>In legal news.</p><p>{LONG}</p></article>",
            ["A", "A caption.", "In legal news.", LONG],
        ),
        (
            f"<article><p>{LONG}</p><p class='ad'>Buy.</p><div class='notice'><a href='/a'>Read this notice</a></div></article>",
            [LONG],
        ),
    ],
)
def test_articles_of_many_templates(body, wanted):
    foot = "<div class='comments'><p>I liked this, really, so very much, thanks.</p></div><div class='copyright'>All rights.</div>"
    assert text_of(page(NOISE + body + foot)) == "\n".join(w.strip() for w in wanted)


def test_comments_longer_than_the_article_go():
    comments = "<div class='comments'>" + f"<div class='comment'><p>{LONG}</p></div>" * 20 + "</div>"
    assert text_of(page(f"<div class='post'><h1>A</h1><p>{LONG}</p></div>{comments}")) == f"A\n{LONG.strip()}"


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_given_pages_keep_their_article(spark, size):
    """On these pages the article element has the text; menus and boxes stand outside or in parts with a mark."""
    for row in spark.read.parquet(f"/root/testdata/{size}/pages.parquet").collect():
        parsed = html_text.parse(row.html)
        assert html_text.best_path(parsed).rsplit(">", 1)[1].startswith("article")
        assert len(text_of(row.html)) >= 0.8 * sum(len(b.text) for b in parsed.blocks)

def odd_pages(spark):
    same = page(ARTICLE)
    rows = [(1, "http://a.example", None, "x"), (2, None, "", "x"), (3, "not a url", same, "x"), (None, "http://a.example/1", same, "x")]
    rows += [(4, "http://a.example/2", same, "x"), (4, "http://a.example/2", same, "x"), (5, "http://a.example", page("<p>x</p>" * 20_000), "x")]
    return spark.createDataFrame(rows, PAGES + ", text string").withColumnRenamed("text", "TEXT")


def test_text_of_odd_pages(spark):
    pages = odd_pages(spark)
    found = html_text.extract(pages).collect()
    assert len(found) == 7
    assert {r.text for r in found if r.page_id in (1, 2)} == {""}
    assert html_text.extract(pages.limit(0)).count() == 0


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("split", [64, 777, 1 << 20])
def test_every_record_is_read_once_whatever_the_splits(spark, split):
    rng = random.Random(split)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("ab<p>é€") for _ in range(rng.randint(0, 3_000)))) for i in range(40)]
    rows += [(100, "http://h/\r\nX: y", "same"), (101, None, "same"), (102, "u", "")]
    folder = warc.scratch_path(spark, "warc-test")
    manifest = warc.write(warc.with_roles(spark.createDataFrame(rows, PAGES)), folder)
    found = warc.read(manifest, split).collect()
    assert sorted(r.record_id for r in found) == sorted(f"urn:page:{i}" for i, _, _ in rows)
    by_id = {r.record_id: r for r in found}
    for i, _, html in rows:
        own = by_id[f"urn:page:{i}"]
        assert own.payload_digest == digest(html) and own.payload_bytes == len(html.encode())
        if i == 100:
            assert (own.record_type, own.refers_to, own.payload) == ("revisit", "urn:page:101", None)
        else:
            assert own.record_type == "response" and bytes(own.payload).decode() == html


def test_archives_are_plain_gzip_members(spark):
    folder = warc.scratch_path(spark, "warc-test")
    manifest = warc.write(warc.with_roles(spark.createDataFrame([(1, "u", "x"), (2, "u", "y")], PAGES)), folder).collect()
    content = b"".join(gzip.open(r.path.removeprefix("file:")).read() for r in manifest)
    assert content.count(b"WARC/1.1\r\n") == 2 and sum(r.records for r in manifest) == 2


def test_false_magic_is_no_member():
    assert not warc._starts_record(warc.MAGIC + b"\x00" * 40)
    assert not warc._starts_record(gzip.compress(b"something else"))
    assert warc._starts_record(gzip.compress(b"WARC/1.0\r\n"))


def test_round_trip_of_odd_pages(spark):
    found = warc.round_trip(odd_pages(spark)).collect()
    assert len(found) == 7
    kinds = sorted((r.record_id, r.record_type) for r in found)
    assert kinds.count(("urn:page:4", "response")) == 2  # the largest id, twice
    assert ("urn:page:", "revisit") in kinds and ("urn:page:3", "revisit") in kinds and ("urn:page:1", "revisit") in kinds
    assert warc.round_trip(odd_pages(spark).limit(0)).count() == 0


@pytest.mark.parametrize(("files", "size", "split"), [(10, 400 << 20, 4 << 20), (1, 4 << 40, 4 << 20), (3, 70, 64)])
def test_reading_is_spread_over_tasks(spark, files, size, split):
    """Also under adaptive execution, which puts small partitions together."""
    archives = spark.createDataFrame([(f"file:/none/{i}", size) for i in range(files)], "path string, size long")
    ranges = files * -(-size // split)
    n = warc.tasks(archives, split)
    assert n >= min(ranges, spark.sparkContext.defaultParallelism) and files * size <= n * warc.TASK + n * split
    if ranges < 2000:
        dealt = warc.read(archives, split)
        assert dealt.rdd.getNumPartitions() == n
