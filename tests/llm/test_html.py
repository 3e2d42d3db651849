import random

from paysight.llm import html_extract
from tests.llm.conftest import SF

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">one</a></li><li>two</ul></nav>
<div class="cookie-notice">We use cookies. <button>OK</button></div><form><input value=x>Search here <label>for</label></form>
<article class="post"><header><h1>The  title&nbsp;here</h1></header><p><b>First &amp; second.<br><p>Third &lt;tag&gt; 5 < 6 caf&eacute;<i>s</i>.</p>
<div class="ad">Buy now</div><ul><li>item one<li>item two</ul><!-- hidden --><p>Short.</p>
<section id="comments"><article class="comment">Nice post, a long comment that is not part of it</article></section></article>
<aside class="sidebar">Related things to read</aside><footer>&copy; me</footer></body></html>"""


def test_all_parts():
    assert html_extract.main_text(PAGE) == ("The title here First & second. Third <tag> 5 < 6 cafés. item one item two Short.")


def test_without_article_element():
    body = "".join(f"<div><p>Sentence number {i} of the text, which is long enough to be a block.</p></div>" for i in range(9))
    page = f'<div><a href=1>home</a></div><div><a href=2>news</a></div><div id=nav>x y z</div>{body}<div class="footer">end</div>'
    assert html_extract.main_text(page).startswith("Sentence number 0") and html_extract.main_text(page).endswith("to be a block.")


def test_edges(spark):
    pages = [None, "", "plain", "<p>", "<article><p>x</article>", "<p>a<script>b", "</div></p>text", "<article>" + "<p>para</p>" * 5000 + "</article>"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string")
    out = {r.page_id: r.t for r in df.select("page_id", html_extract.extract(df.html).alias("t")).collect()}
    assert [out[i] for i in range(7)] == ["", "", "plain", "", "x", "a", "text"]
    assert out[7] == " ".join(["para"] * 5000)
    empty = df.where("false")
    assert empty.select(html_extract.extract(empty.html).alias("t")).count() == 0


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = html_extract.op2_html_extract(spark, SF).collect()
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) > 0 for r in rows)
    for r in rows:  # nothing of the page's own frame is left
        foot = pages[r.page_id].partition("<footer>")[2].partition("</footer>")[0].rpartition("&middot;")[2].strip()
        assert not foot or not r.text.endswith(foot)
        assert "<p>" not in r.text and "track(" not in r.text


def test_comments_do_not_split_words_and_drawings_may_close_themselves():
    page = "<p>un<!-- c -->broken word and <svg viewBox='0 0'/>more text that is long enough to stay here</p>"
    assert html_extract.main_text(page) == "unbroken word and more text that is long enough to stay here"


def test_unclosed_head_and_embedded_elements_end_before_the_text():
    article = "<article><p>The text of the page.</p></article>"
    for start in ("<html><head><title>T</title><body>", "<html><head><title>T</title>", "<head><meta charset=x><title>T",
                  "<head><noscript><img src=x><body>", "<head><noscript><p>no script</p></noscript><link href=x><body>", "<head><head>",
                  *(f"<body><{x} a='>'>not shown" for x in sorted(html_extract._EMBEDDED)),
                  *(f"<body><div><{x}>not shown</div>" for x in sorted(html_extract._EMBEDDED)),
                  *(f"<body><{x}>a<{x}>b</{x}>" for x in sorted(html_extract._EMBEDDED)), "<body><select><option>a<option>b"):
        assert html_extract.main_text(start + article) == "The text of the page.", start
    assert html_extract.main_text("<head><title>T</title>Text without a tag of its own.") == "Text without a tag of its own."
    assert html_extract.main_text("<head><title>a <b>T</b> <p></title></head><p>Text.") == "Text."


def test_closed_embedded_elements_are_dropped_whole():
    for x in sorted(html_extract._EMBEDDED):
        page = f"<article><p>one <{x}><p>not</p><div>shown</div><{x}>deep</{x}></{x}>two</p></article>"
        assert html_extract.main_text(page) == "one two", x
    for x in ("script", "style", "textarea"):
        assert html_extract.main_text(f"<p>Text.</p><{x}><p>not shown, to the end of the page</p>") == "Text."


def test_removed_elements_do_not_cut_the_text_around_them():
    ad, more = '<div class="ad"><div><p>Buy</p><p>now</p></div></div>', "<aside><p>x</p><ul><li>y</li></ul></aside>"
    text = "A long sentence of the text. " * 14
    body = f"<h1>Short title</h1>{ad}<p>{text}</p>{more}{ad} {more}<p>The end.</p>"
    for page in (f"<article>{body}</article>", f"<main>{body}</main>", f"<div id=content>{body}</div>"):
        assert html_extract.main_text(page) == f"Short title {text}The end."


def test_article_keeps_linked_and_distant_lines():
    gap = "<div></div>" * 9
    page = f"<article><p><a href=x>Wholly a link.</a></p>{gap}<p>{'Text. ' * 80}</p>{gap}<p>End.</p></article><p>outside</p>"
    assert html_extract.main_text(page) == f"Wholly a link. {'Text. ' * 80}End."


def test_small_article_beside_the_main_text_does_not_replace_it():
    text = "".join(f"<p>Paragraph {i} of the main text, long enough to be a block of its own.</p>" for i in range(20))
    card = '<article class="card"><h3><a href=x>Another story</a></h3><p>Two words.</p></article>'
    for page in (f"<div id=content>{text}</div><div><div><div>{card}", f"{card}<div></div><div></div><div id=content>{text}</div>"):
        out = html_extract.main_text(page)
        assert out.count("of the main text") == 20 and "Two words" not in out
    assert html_extract.main_text(f"<p>A line outside.</p><article>{text}</article>{card}").startswith("Paragraph 0")


def test_names_of_classes_are_matched_whole():
    words = " ".join(["plain words of a post"] * 30)
    page = (f"<body><p>{words}</p><p class='share-price'>Price ten.</p><div class='note side'>An aside that belongs here.</div>"
            f"<p id='menu-prices'>Soup five.</p><div class='ad-slot'>Buy now</div><div class='site-footer'>Imprint</div>"
            f"<div class='left comment-list'>First!</div><p>{words}</p></body>")
    assert html_extract.main_text(page) == f"{words} Price ten. An aside that belongs here. Soup five. {words}"


def test_a_very_long_title_is_no_text():
    page = f"<title>{'t' * 5000}</title><p>{'some words ' * 20}</p>"
    assert html_extract.main_text(page) == ("some words " * 20).strip()


def test_runs_equal_the_definition():
    """Windows, surge and dive points by brute force, on the squeezed lines."""
    rng = random.Random(5)
    for _ in range(400):
        lines = [(f"l{i}", n) if (n := rng.choice([0, 0, 0, 3, 40, 200])) or rng.random() < 0.3 else ("", 0) for i in range(rng.randint(0, 30))]
        surge = rng.choice([1, 30, 80])
        flat = html_extract._squeeze(lines)
        window = [sum(n for _, n in flat[i:i + 3]) for i in range(len(flat))]
        want, here = [], []
        for x, total in zip([*flat, ("", 0)], [*window, 0], strict=True):
            if total:
                here.append((x, total))
            elif here:
                if any(t >= surge for _, t in here):
                    want.append([y for y, _ in here])
                here = []
        assert html_extract.runs(lines, surge) == want


def test_repeated_rows_and_other_columns(spark):
    rows = [(1, "u", "<p>some words of a page</p>", "x", "y")] * 2 + [(None, None, None, "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, lines string")
    out = df.select("*", html_extract.extract(df["html"]).alias("main")).collect()
    assert sorted((r.main, r.text, r.lines) for r in out) == [("", "x", "y"), *[("some words of a page", "x", "y")] * 2]
