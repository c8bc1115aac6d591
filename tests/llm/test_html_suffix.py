import numpy as np
import pytest

from tierflow.llm.html_suffix import (
    ARTICLE, _packed, _unpacked, extract_main_text, keep_unique, parse, repeated_tokens, run_pages)
from tierflow.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li>Home</li></ul></nav><header>Site</header>
<article><header><h1>Big &amp; bold</h1></header><p>One\n  two&nbsp;three<br>four</p><script>x("<p>no</p>")</script>
<div class="ad-box advert">Buy</div></article>
<div id="comments"><p>nice</p></div><aside>more</aside><footer>(c)</footer></body></html>"""


def test_article_stays_and_the_rest_goes(spark):
    pages = spark.createDataFrame([(1, "https://a.example/1", PAGE)], "page_id long, url string, html string")
    row = extract_main_text(pages).first()
    assert row["text"] == "Big & bold\nOne two three four" and row["n_chars"] == len(row["text"])


@pytest.mark.parametrize("depth", [1, 3, 8])
def test_suffix_array_matches_brute_force(depth):
    rng = np.random.default_rng(depth)
    for _ in range(30):
        n = int(rng.integers(0, 120))
        tokens = rng.integers(0, 3, n)
        if n > 60:  # a long passage of two places
            tokens[40:55] = tokens[5:20]
        page = np.sort(rng.integers(0, 4, n))
        where = {}
        spots = [i for i in range(n - depth + 1) if page[i] == page[i + depth - 1]]
        for i in spots:
            where.setdefault(tuple(tokens[i:i + depth]), set()).add(page[i])
        want = np.zeros(n, bool)
        for i in spots:
            if len(where[tuple(tokens[i:i + depth])]) > 1:
                want[i:i + depth] = True
        assert (repeated_tokens(tokens, page, depth) == want).all()


def test_repeated_runs_go_without_markup(spark):
    bar = "all our pages carry this very long line of boilerplate words"
    pages = [(i, f"http://h.example/{i}", f"<div>{bar}</div><p>story {i} tells of thing {i * 7} only</p>")
             for i in range(3)]
    pages.append((9, "http://other.example/", f"<div>{bar}</div>"))
    got = {r["page_id"]: r for r in extract_main_text(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i]["text"] == f"story {i} tells of thing {i * 7} only" and got[i]["n_repeated"] >= 10
    assert got[9]["text"] == bar  # alone on its host


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "no host", ""), (3, "http://a/x", "<p>un<b>closed"), (4, "http://a/y", "a < b &lt; c"),
            (5, "http://a/z", "<article>" + "<p>long text</p>" * 30_000), (5, "http://a/z", "<p>twice</p>"),
            (6, "http://a/q", "<!-- never closed"), (None, "http://a/n", "<p>null id</p>"), (7, "http://a/t", "x <a href=")]
    pages = spark.createDataFrame([r + ("c",) for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in extract_main_text(pages).collect()]
    assert len(got) == len(rows)
    assert {(1, ""), (2, ""), (3, "unclosed"), (4, "a < b < c"), (5, "twice"), (6, ""), (None, "null id"),
            (7, "x")} <= set(got)
    assert (5, "\n".join(["long text"] * 30_000)) in got
    assert extract_main_text(pages.limit(0)).collect() == []


def test_every_page_has_a_row(spark):
    got = QUERIES["op3_main_text"](spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert got.count() == n == got.select("page_id").distinct().count()
    assert got.where("text is null or n_chars <> length(text)").isEmpty()


def test_parse_keeps_block_order():
    assert [t for _, t in parse("<div>a<p>b</p>c</div><ul><li>d<li>e</ul>")] == ["a", "b", "c", "d", "e"]


STORY = "one story of many words that stands on this page alone"


@pytest.mark.parametrize("html", [
    "<div class='page no-sidebar'><nav>Home</nav><article><p>%s</p></article></div>",
    "<div class='page sidebar'><article><p>%s</p></article></div>",
    "<div class='page sidebar'><p>%s</p></div>",
    "<div id='main-with-nav'><p>%s</p></div><footer>(c)</footer>",
    "<div class='social-science'><p>%s</p></div>",
    "<aside><article class=related>skip</article><div role='main' class=widget><p>%s</p></div></aside>",
    "<body><nav><ul><li>Home</li></ul><article><p>%s</p></article><footer>(c)</footer></body>",
    "<div><aside><p>%s</p></div><footer>(c)</footer>",
    "<article><div class='with-nav'><p>%s</p></div><div class='share'>Share</div></article>",
    "<article><p>%s</p><section id=comments><article class=comment>nice</article></section></article>",
    "<form id=all><nav>Home</nav><p>%s</p></form>",
])
def test_wrappers_do_not_lose_the_article(spark, html):
    pages = spark.createDataFrame([(1, "https://a.example/1", html % STORY)], "page_id long, url string, html string")
    assert extract_main_text(pages).first()["text"] == STORY


def test_header_of_an_article_stays():
    kept = [t for r, t in parse("<article><div class='entry-header'><h1>Big</h1></div><p>text</p>"
                                "<div class=header>More</div></article>") if r == ARTICLE]
    assert kept == ["Big", "text", "More"]


def test_hint_inside_an_article_is_judged_by_repetition():
    note = "this part of the article stands on every page of the site again"
    page = "<article><p>%s</p><div class='related-work'>%s</div></article>"
    texts = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(2)]
    pages = [parse(page % (t, note)) for t in texts] + [parse(page % ("alone " * 30, "only here"))]
    assert [t for t, _ in keep_unique(pages, [1, 2, 3])] == [*texts, "alone " * 29 + "alone\nonly here"]
    # copies of a whole article keep all of it
    copies = [parse(page % (texts[0], note))] * 2
    assert [t for t, _ in keep_unique(copies, [1, 2])] == [f"{texts[0]}\n{note}"] * 2


def test_shards_do_not_change_results(spark):
    bar = "these two pages of a large host share this passage of some words"
    pages = []
    for i in range(60):
        shared = [f"{bar} number {k}" for k in (i % 30, 90) if k < 90 or i in (3, 40)]
        pages.append((i, f"http://h.example/{i}", f"<p>{' '.join(f'u{i}x{k}' for k in range(30))}</p>"
                      + "".join(f"<p>{x}</p>" for x in shared) + f"<article>{bar} in article {i % 7}</article>"))
    pages += pages[:3] + [(3, "http://h.example/3", "<p>another row of page three, all by itself</p>")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = lambda size: sorted(tuple(r) for r in extract_main_text(table, shard_bytes=size).collect())
    whole = rows(1 << 20)
    assert rows(900) == rows(200) == whole
    assert all("number" not in r[2] for r in whole) and all(r[4] > 0 for r in whole if r[0] != 3)


def test_judged_blocks_are_shuffled_once(spark):
    page = "<p>%s</p>" % " ".join(f"w{k}" for k in range(50))
    rows = [(i, f"http://h.example/{i}", page) for i in range(20)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), shard_bytes=500)
    assert all(r["text"] and r["n_repeated"] == 51 for r in got.collect())
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_pages_that_markup_settles_stay_where_they_are(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = extract_main_text(pages)
    want = {r["page_id"]: "\n".join(t for role, t in parse(r["html"] or "") if role == ARTICLE) for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in got.collect()} == want
    assert got.where("n_repeated is not null").isEmpty()


def test_runs_of_every_page_are_counted():
    rng = np.random.default_rng(5)
    for depth in (1, 2, 8):
        for n in (0, 1, 7, 90):
            tokens, page = rng.integers(0, 3, n), np.sort(rng.integers(0, 5, n))
            spots = [i for i in range(n - depth + 1) if page[i] == page[i + depth - 1]]
            where = {}
            for i in spots:
                where.setdefault(tuple(tokens[i:i + depth]), set()).add(page[i])
            start, count = run_pages(tokens, page, depth)
            assert start.tolist() == spots
            assert count.tolist() == [len(where[tuple(tokens[i:i + depth])]) for i in spots]


def test_packed_numbers_come_back():
    for x in (np.empty(0, np.uint64), np.array([0, 1, 2 ** 64 - 1], np.uint64), np.arange(5)):
        assert _unpacked(_packed(x), len(x)).tolist() == x.tolist()


def _site(n, noted=lambda i: True, copies=0):
    """Pages of one host with articles of their own and, in some, one notice;
    after them copies of the first."""
    notice = "<p>please share this article with all of your friends and subscribe now</p>"
    pages = [f"<nav>Home</nav><article><p>{' '.join(f'w{i}x{k}' for k in range(40))}</p>"
             f"{notice if noted(i) else ''}</article><footer>(c)</footer>" for i in range(n)]
    pages += pages[:1] * copies
    return [(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 900])
def test_suffix_array_judges_pages_that_markup_could_settle(spark, shard_bytes):
    def texts(rows):
        table = spark.createDataFrame(rows, "page_id long, url string, html string")
        return {r["page_id"]: r for r in extract_main_text(table, shard_bytes=shard_bytes).collect()}

    # a notice in the articles of most pages goes, wherever the shards' edges are
    got = texts(_site(20, lambda i: i % 3, copies=2))
    assert all("subscribe" not in got[i]["text"] and f"w{i}x39" in got[i]["text"] for i in range(1, 20))
    assert all((got[i]["n_wide"] >= 12) == (i % 3 > 0) for i in range(1, 20))
    # the copies keep their article, and so does a passage on some pages only
    assert all(got[i]["text"] == " ".join(f"w0x{k}" for k in range(40)) for i in (0, 20, 21))
    got = texts(_site(20, lambda i: i % 4 == 0))
    assert all("subscribe" in got[i]["text"] for i in range(0, 20, 4))
    # a site of one article keeps it, and copies of a page lose the notice
    assert all("w0x39" in r["text"] and "subscribe" in r["text"] for r in texts(_site(1, copies=9)).values())
    got = texts(_site(20, copies=1))
    assert not any("subscribe" in r["text"] for r in got.values()) and "w0x39" in got[0]["text"] == got[20]["text"]
    # few pages say nothing
    assert all("subscribe" in r["text"] for r in texts(_site(4)).values())


def test_shards_do_not_change_judged_articles(spark):
    # wide runs of some shards only, and a page without an article that opens the host
    pages = _site(40, lambda i: i % 5 < 3) + [(99, "http://h.example/99", "<p>one open block of this host</p>")]
    for rows in (pages[:-1], pages):
        table = spark.createDataFrame(rows, "page_id long, url string, html string")
        whole, cut = (sorted(tuple(r) for r in extract_main_text(table, shard_bytes=n).collect()) for n in (1 << 20, 1100))
        assert whole == cut and sum("subscribe" in r[2] for r in whole) == 0 and any(r[5] for r in whole)
