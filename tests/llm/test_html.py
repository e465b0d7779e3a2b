import html as H
import itertools
import random
import re

from millrace.llm import catalogue, html

SF = "/root/testdata/sf0.01"


def test_real_pages_keep_the_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = catalogue.op7_html_main_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        want = [" ".join(H.unescape(re.sub(r"<br>", " ", x)).split()) for x in re.split(r"</?(?:h1|p|ul|li|div)>", re.sub(r"</?b>", "", inner))]
        assert r.text == "\n".join(x for x in want if x), r.page_id
        assert r.n_chars == len(r.text)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site name</h1></header>
<div class="cookie-notice"><p>We use cookies on this site to make it better for all of our readers.</p></div>
<div id="menu"><a href=/>Home</a> <a href=/x>News</a></div><div class=wrapper><div class="post-content"><h2>A &lt;title&gt;</h2>
<p>First paragraph of the story with quite a lot of text in it, so it counts as content &amp; more.<p>Second&nbsp;<b>bold</b>er
paragraph<br>goes on for a while and says something <a href=z>with a link</a> inside of it, too.</p><div class="ad"><p>Buy this thing now, it is very cheap and good, we promise.</p></div>
<p>Short.</p><p>Third paragraph closes the story with a long last sentence about nothing in particular.</p></div>
<div id="comments"><h3>Comments</h3><p>I liked this story a lot, thanks for writing it, please write another one soon!</p></div>
<aside><p>Related: other stories that you might like to read on this site next.</p></aside></div>
<form><label>Subscribe</label><input></form><footer><p>Copyright</p></footer><script>var a = "<p>no</p>";</script></body>"""


def test_layout_without_article_element():
    assert html.main_text(PAGE).split("\n") == [
        "A <title>", "First paragraph of the story with quite a lot of text in it, so it counts as content & more.",
        "Second bolder paragraph goes on for a while and says something with a link inside of it, too.", "Short.",
        "Third paragraph closes the story with a long last sentence about nothing in particular.",
    ]


def test_comments_and_notices_inside_the_article():
    page = "<article><header><h1>Head</h1></header><p>Body text.</p><section class=comments><p>A comment that is long enough to look like text of its own.</p></section><aside>Aside</aside><p>End</p></article>"
    assert html.main_text(page) == "Head\nBody text.\nEnd"


def test_broken_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<!-- never closed <p>x") == html.main_text("<script>x") == ""
    assert html.main_text('<article><p title="a > b">x<p class="y>z</p><p>w</article>').startswith("x")
    assert html.main_text("<article>" + "<div>" * 3000 + "deep" + "</article>") == "deep"
    assert html.main_text("<article>" + "<p>word word</p>" * 5000 + "</article>").count("\n") == 4999


def test_min_cut_equals_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 8)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 1.5)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        cost = lambda keep: sum(s for s, k in zip(scores, keep) if s > 0 and not k) - sum(s for s, k in zip(scores, keep) if s < 0 and k) + sum(c for a, b, c in edges if keep[a] != keep[b])
        best = min(map(cost, itertools.product((True, False), repeat=n)))
        assert abs(cost(html.min_cut(scores, edges)) - best) < 1e-6


def test_empty_table_and_nulls(spark):
    schema = "page_id long, url string, html string, text string"
    assert html.extract(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in html.extract(spark.createDataFrame([(None, None, None, "q")], schema)).collect()] == [(None, None, "", 0)]


def unmarked(page):
    """A page without article elements and paragraphs: its text stands in plain divisions."""
    return re.sub(r"<(/?)(?:article|p)>", r"<\1div>", page)


def test_cut_mends_labels_on_pages_without_markup(spark):
    """Short lines of plain divisions look like boilerplate by themselves; the cut gives them to the text around them."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()]
    weights, exact, signs, changed, right = html.fit(spark.createDataFrame([(p,) for p in pages], "html string")), 0, 0, 0, 0
    for page in pages:
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        want = {" ".join(H.unescape(x).split()) for x in re.split(r"</?(?:h1|p|ul|li|div|br)>", re.sub(r"</?b>|<br>", lambda m: " " if m[0] == "<br>" else "", inner))} - {""}
        blocks, costs, keep = html.labelled(unmarked(page), weights)
        alone, truth = [c >= 0 for c in costs], [b.text in want for b in blocks]
        exact += keep == truth
        signs += alone == truth
        changed += sum(a != k for a, k in zip(alone, keep))
        right += sum(a != k and k == t for a, k, t in zip(alone, keep, truth))
    print("pages right by the cut", exact, "by costs alone", signs, "labels changed", changed, "rightly", right)
    assert exact > 0.98 * len(pages) and exact > signs + 30 and right > 0.95 * changed > 50


def test_names_that_only_contain_boilerplate_words():
    page = '<article><p>x</p><p class="share-price">The price was 5.</p><div class="text-header">Intro</div><p class="related-work">Others did this before.</p><h2 id="comments">Comments on the method</h2><p>The <math><mi>a</mi></math> of it.</p><div>Press <button>Run</button> to start.</div></article>'
    assert html.main_text(page) == "x\nThe price was 5.\nIntro\nOthers did this before.\nComments on the method\nThe a of it.\nPress Run to start."


def test_boilerplate_inside_an_article():
    text = "<p>A paragraph of the story that has enough words to look like one, and ends here.</p>"
    for junk in ('<div class="ad-banner"><p>Buy this now, it is cheap and good, we promise.</p></div>', '<ul class="share-links"><li>Mail</li></ul>', '<div id="reader-comments"><p>I liked it a lot, thank you for it.</p></div>', "<aside><article><p>Another story, which you may like as well.</p></article></aside>", "<form><p>Your name, please.</p></form>", '<section hidden><p>Not shown.</p></section>', "<footer>Filed under news.</footer>"):
        assert html.main_text(f"<article>{text}{junk}{text}</article>").count("\n") == 1, junk
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Part {k}</a></li>" for k in range(9)) + "</ul>"
    assert "Part" not in html.main_text(f"<article>{text}{menu}{text}</article>")
    assert "site" not in html.main_text(f"<header>The site</header><article><header>Head</header>{text}</article>")


def test_frames_and_custom_elements():
    text = "<p>Words of an article that goes on for a while, as articles do.</p>" * 4
    assert html.main_text(f'<div class="sidebar">{text}</div>').count("\n") == 3  # a page's whole text can't be its sidebar
    assert html.main_text(f"<nav><article>{text}</article>").count("\n") == 3  # navigation that is never closed
    assert html.main_text(f"<article><video-player>{text}</video-player><svg width=1 /><p>Last.</p></article>").endswith("Last.")
    assert html.main_text('<article><p title="a <b> c">x y</p></article>') == "x y"


def test_time_grows_with_the_page():
    import time

    for make in (lambda n: "<article>" + "<div>x" * n, lambda n: "<a " * n, lambda n: "<div>" * n + "</section>" * n, lambda n: '<p class="' * n, lambda n: "<article>" + "<p>some words here</p>" * n + "</article>"):
        took = []
        for n in (2000, 16_000):
            page, began = make(n), time.perf_counter()
            html.main_text(page)
            took.append(time.perf_counter() - began)
        assert took[1] < 24 * took[0] + 0.5, took


def test_repeated_rows_and_unmarked_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, "<p>Only one line of text, without any mark, and it is long enough.</p>", "y")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).orderBy("page_id").collect()
    assert got[0] == got[1] and got[0].n_chars == len(got[0].text) and got[2].text.startswith("Only one")
