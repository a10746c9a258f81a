import re
import time

import pytest

from ratelens.llm import pages

ARTICLE = re.compile(r"<article>(.*?)</article>", re.S)


def plain(page):
    import html
    body = ARTICLE.search(page)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split())
              for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_whole_table_against_its_articles(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in pages.main_text(df).collect()}
    for r in df.collect():
        assert got[r.page_id].text == plain(r.html)
        assert got[r.page_id].url == r.url and got[r.page_id].n_chars == len(plain(r.html))


@pytest.mark.parametrize("matches", [200_000, 3])
def test_common_lines_against_dynamic_programming(monkeypatch, matches):
    import random
    monkeypatch.setattr(pages, "MATCHES", matches)
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        got = sorted(pages.common_lines(a, b))
        assert len(got) == best[-1][-1]
        it = iter(b)
        assert all(any(a[i] == x for x in it) for i in got)


def test_zones_and_markup():
    text = "\n".join(t for t, z in pages.lines_of("""<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head>
      <body><header><h1>Site</h1></header><nav>Menu</nav><div class="cookie-notice">We use cookies</div>
      <main><article><header><h1>Head &amp; line</h1></header><p>One <b>bold
      </b>and&nbsp;<i>more</i><script>var a = "</p>";</script><p>Two &lt;b&gt;<br>three
      <aside>Aside</aside><form><input><p>Form</p></form><div hidden>no</div><div style="display: none">no</div>
      <ul><li>a<li>b</ul><section id="comments"><p>Nice!</p></section><!-- <p>gone</p> --> tail</article></main>
      <div id="sidebar">Side</div><footer>Foot</footer></body></html>""") if z != pages.OFF)
    assert text == "Head & line\nOne bold and more\nTwo <b> three\na\nb\ntail"
    assert pages.lines_of(None) == pages.lines_of("") == pages.lines_of("<p> </p>") == []
    assert pages.lines_of("a < b") == [("a < b", pages.PLAIN)]
    assert [t for t, _ in pages.lines_of('<p class="x>open quote</p><p>next')] == ["open quote", "next"]


def page(body):
    return f"<html><body><div>Welcome to us</div><div>{body}</div><div>Call 555</div></body></html>"


def test_differencing_nearest_urls_and_edges(spark):
    rows = [(1, "http://h.example/a/1", page("<p>first text</p>")), (2, "http://h.example/a/2?x=1", page("<p>second text</p>")),
            (3, "https://h.example/b", "<p>Call 555</p><p>other template</p>"), (4, "http://alone.example/", page("<p>x</p>")),
            (5, "http://c.example/1", page("<p>copy</p>")), (6, "http://c.example/2", page("<p>copy</p>")),
            (7, None, None), (8, "", ""), (9, "not a url", "<p>t</p>"), (None, "http://h.example/a/1", page("<p>n</p>")),
            (10, "http://long.example/1", "<article>" + "<p>word</p>" * 20_000 + "</article>"),
            (11, "http://long.example/2", "<article>" + "<p>word</p>" * 20_000 + "</article>")]
    df = spark.createDataFrame([(*r, "e", 1) for r in rows], "page_id bigint, url string, html string, text string, drops int")
    got = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert got[1] == "first text" and got[2] == "second text"
    assert got[4] == "Welcome to us\nx\nCall 555"
    assert got[5] == got[6] == "Welcome to us\ncopy\nCall 555"     # copies: nothing to tell apart
    assert got[7] == got[8] == "" and got[9] == "t"
    assert got[None] == "Welcome to us\nn\nCall 555"
    assert got[10] == got[11] == "\n".join(["word"] * 20_000)
    pairs = {r.page: r.partner for r in pages.nearest_pages(
        df.where("page_id IS NOT NULL").selectExpr("page_id AS page", "url"), 3).collect()}
    assert pairs[1] == 2 and pairs[2] == 1 and pairs[3] in (1, 2) and pairs[4] is None and pairs[5] == 6
    assert pages.main_text(df.limit(0)).collect() == []


def test_omitted_tags_of_head_body_and_html():
    def text(page):
        return [t for t, z in pages.lines_of(page) if z != pages.OFF]
    body = "<article><p>one<p>two</article>"
    for start in ("<html><head><title>T</title><body>", "<head><title>T</title>", "<html><head>", "<title>T</title><body>", "",
                  "<head><meta charset=utf-8><link rel=x><script>var a</script><style>p{}</style>\n",
                  "<head><head><title>T</title>", "<head><template><p>no</p></template>", "<head><title>T</title></head>"):
        assert text(start + body) == text(start + body + "</body></html>") == ["one", "two"], start
    assert text("<head><title>T</title>bare text<p>next") == ["bare text", "next"]
    assert text("<head><title>T</title><b>bold</b> text") == ["bold text"]


def kept(page):
    return [t for t, z in pages.lines_of(page) if z != pages.OFF]


def test_class_names_neither_empty_the_article_nor_cut_topics_out_of_it():
    article = "<article><p>one</p><p>two</p></article>"
    for around in ('<div class="content has-sidebar">%s</div>', "<form id=aspnetForm><input>%s</form>", '<div class="site-header-wrap ad">%s</div>',
                   '<div class="entry no-comments">%s</div>', "<form><div class=notice-board>%s</div></form>"):
        assert kept("<nav>menu</nav>" + around % article + "<p class=copyright>c</p>") == ["one", "two"], around
    inside = "<article><h1>h</h1>%s<p>end</p></article>"
    for named in ('<div id="legal-history">text</div>', '<p class="social-science">text</p>', '<p class="share-price">text</p>',
                  '<section class="no-comments">text</section>'):
        assert kept(inside % named) == ["h", "text", "end"], named
    for named in ('<div class="ad">text</div>', '<div class="share-buttons">text</div>', '<ul id="nav-menu"><li>text</ul>',
                  '<div class="related-links">text</div>', "<form>text</form>"):
        assert kept(inside % named) == ["h", "end"], named
    # readers' comments marked up as articles, and a page that stands in a form as a whole
    assert kept(article + '<div id=comments><article class=comment><p>me</p></article></div>') == ["one", "two"]
    assert kept(article + '<article class="comment"><p>me</p></article>') == ["one", "two"]
    assert kept("<p>top</p><form><p>the text of the page</p><p>more of it</p></form>") == ["top", "the text of the page", "more of it"]
    assert kept("<p>the text of the page</p><form><p>mail</p></form>") == ["the text of the page"]


def test_quotes_and_short_comments():
    assert kept("<p>a</p><a title=it's>b</a><p>c</p><i title='x'>d</i>") == ["a", "b", "c", "d"]
    assert kept("<p>a<!-->b</p><p>c<!--->d</p><p>e<!-- > -->f") == ["ab", "cd", "ef"]
    assert kept('<p title="a>b">t</p><p title = \'x"y>\'>u') == ["t", "u"]


def test_repeated_lines_are_aligned_in_time():
    start = time.perf_counter()
    assert len(pages.common_lines([1, 2] * 6000, [2, 1, 3] * 4000)) >= 6000
    assert time.perf_counter() - start < 20


def test_rows_of_one_id_with_other_markup_are_pages_of_their_own(spark):
    rows = [(1, "http://h.example/1", page("<p>Welcome to us</p><p>x</p>")), (1, "http://h.example/1", page("<p>a</p><p>b</p><p>c</p>")),
            (2, "http://h.example/2", page("<p>z</p>")), (2, "http://h.example/2", page("<p>z</p>"))]
    got = pages.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.text for r in got if r.page_id == 1} >= {"a\nb\nc"}
    assert len(got) == 4 and len({r.text for r in got if r.page_id == 2}) == 1
