import pytest

from chirpstat.llm.html_main import main_text, op6_html_main

LONG = "This is the long text of the page and it is here for you to read in full, with all that it has to say."
CASES = [
    ("<body><header>H</header><div id=cookie-notice>We use cookies</div><p>Short.</p><p>" + LONG + "<br>x</p><ul class='menu'><li><a href=x>A</a></ul>"
     "<form><input><p>hey</form><section id='comments'><p>" + LONG + "</section>", "Short.\n" + LONG + " x"),
    ("<article><header><h1>T &amp; t</h1></header><p>" + LONG + "<aside>" + LONG + "</aside><p>End</article><p>" + LONG, "T & t\n" + LONG + "\nEnd"),
    ("<main><p>A</p><script>var p='</p>'</script><style>p{}</style><p>B<!-- c --></p></main><footer>F</footer>", "A\nB"),
    ("<p>one&nbsp;two \n three&#33;</p>", "one two three!"),
    ("<article><p>kept</p><div class='share-box social'>Share</div><div class='related'>" + LONG + "</div></article>", "kept"),
    ("<div hidden>" + LONG + "</div><div style='display: none'>x</div><p>" + LONG + "</p>", LONG),
    ("<p><a href=1>Home</a> <a href=2>News</a> <a href=3>Sport and more</a></p><p>" + LONG + "</p>", LONG),
    ("<table><tr><td>" + LONG + "<td>cell</table>", LONG + "\ncell"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut <b", "cut"), ("a < b and c", "a < b and c"), ("", ""), (None, ""), ("<", "<"), ("<!--", ""),
    ("<script>", ""), ("<article>İ<script>x</script>y</article>", "İy"), ("<p>" * 3000, ""), ("<div>" * 2000 + "x", "x"), ("<p title='x>y'>z", "z"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_main_text(page, text):
    assert main_text(page) == text


TURKISH = "Sabah erkenden limana indik ve balıkçıların ağlarını topladığını gördük; rüzgar kuzeyden sert esiyor, dalgalar iskeleye vuruyordu."
DUTCH = "Gisteren liepen wij langs het kanaal naar huis, terwijl oude schippers vanaf hun boten vrolijk naar ons zwaaiden vanwege mooi weer."
WHOLE = [
    ('<div class="content with-sidebar"><p>' + LONG + "</div>", LONG),
    ('<div id="page-no-sidebar"><p>' + LONG + "</div>", LONG),
    ('<div class="sidebar"><p>' + LONG + '</div><div class="sidebar-layout"><h1>T</h1>' + ("<p>" + LONG) * 5 + "</div>", "\n".join(["T"] + [LONG] * 5)),
    ("<form action=x><div><p>" + LONG + "</div></form>", LONG),
    ("<div><p>" + LONG + "<form><p>" + LONG + "</form></div>", LONG),
    ("<svg/><p>" + LONG, LONG), ("<video src=x><p>" + LONG, LONG),
    ("<article>Teaser</article><div><p>" + LONG + "</div>", LONG),
    ("<main><h1>Title</h1></main><div><p>" + LONG + "</div>", "Title\n" + LONG),
    ("<div>" + TURKISH + "</div>", TURKISH), ("<div>" + DUTCH + "</div>", DUTCH),
    ("<ul class=menu><li><a href=1>Ana sayfa</a></ul><div>" + TURKISH + "</div><div class=footer>Telif</div>", TURKISH),
    ("<article class='post comments-open'><p>" + LONG + "</article><div class='comments'><p>" + LONG + LONG + LONG + "</div>", LONG),
]


@pytest.mark.parametrize("page, text", WHOLE)
def test_articles_in_odd_frames(page, text):
    assert main_text(page) == text


def _article(page):
    """The blocks between <article> and its end in the given pages, by plain splitting."""
    import html
    import re

    inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)
    parts = [html.unescape(" ".join(re.sub(r"<[^>]*>", " ", x).split())) for x in re.split(r"</?(?:p|h1)>", inside[1])]
    return "\n".join(x for x in parts if x)


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = op6_html_main(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == _article(pages[r.page_id]) and r.n_chars == len(r.text)


def test_odd_pages(spark):
    from chirpstat.llm.html_main import extract_pages

    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x"), (2, "u", ""), (3, "v", "<article><p>" + "w " * 200_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = extract_pages(frame).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 0, 1, 399_999]
    assert extract_pages(frame.limit(0)).collect() == []
