import re
import html as htmllib

import pytest

from farelane.llm import html_extract as hx
from tests.llm import frames

LONG = "The cat sat on the mat and it was in the house of the man that had a dog with him."


def test_registered_pages_are_exact(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        parts = [" ".join(htmllib.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert hx.main_text(r["html"]) == " ".join(p for p in parts if p)


def test_everything_around_the_article_goes():
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body class="has-sidebar">
    <header><a href="/">Home of the site</a><p>{LONG}</p></header><nav><ul><li><a href=x>The menu</a></ul></nav>
    <div id="cookie-notice"><p>We use the cookies of this site and of others to be with you.</p></div>
    <div class="topBar">x</div><aside><h2>More</h2><p>{LONG}</p></aside>
    <div class="ad-slot">{LONG}</div><form><label>Name</label><p>{LONG}</p><textarea>of the {LONG}</textarea></form>
    <main><article><header><h1>The title &amp; more</h1></header><p>First&nbsp;one, <b>bold</b><i>er</i>&#33;<p>{LONG}<br>{LONG}
    <ul><li>Point one<li>Point two</ul><script>if (a < b) "<p>x</p>";</script><!-- <p>no</p> --><p>Short end.</p>
    <div class="share"><a href=f>Share it</a></div></article><section class="comments"><article><p>{LONG} I say.</p></article></section></main>
    <div class="sidebar"><p>{LONG}</p></div><footer>&copy; all</footer></body></html>"""
    assert hx.main_text(page) == f"The title & more First one, bolder! {LONG} {LONG} Point one Point two Short end."


def test_page_without_an_article_element():
    page = f"""<body><div class="nav"><a href=a>One</a></div><div><a href=b>Two</a> <a href=c>Three</a></div>
    <div><h1>A heading</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><a href=d>Links of the site</a> | <a href=e>and others</a></div></body>"""
    assert hx.main_text(page) == f"A heading {LONG} Short. {LONG}"


def test_cut_and_broken_pages():
    assert hx.main_text(f"<article><p>{LONG}</p><p>And the e") == f"{LONG} And the e"
    assert hx.main_text(f"<article><p>{LONG}<p>5 < 6 and 7 > 3</b></div><a hre") == f"{LONG} 5 < 6 and 7 > 3"
    assert hx.main_text(f"<article><p title='a>b'>{LONG}</article><script>x") == LONG
    assert hx.main_text("<nav><a>x</a></nav>") == "" and hx.main_text("") == "" and hx.main_text(None) == ""


def test_neighbours_decide_short_blocks():
    b = [hx.Block("x", 0, False, False, False), hx.Block(LONG, 0, False, False, False), hx.Block("y", 0, False, False, False),
         hx.Block("menu", 4, False, False, False), hx.Block("z", 0, False, False, False)]
    hx.classify(b)
    assert [x.label for x in b] == [True, True, False, False, False]


def test_wrappers_of_the_article_take_nothing_out():
    body = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    want = f"Title {LONG} Short. {LONG}"
    share = '<div class="share"><a href=s>Share</a> this</div>'
    for start, end in (("<form id=aspnetForm>", "</form>"), ("<div class='widget Blog'>", "</div>"), ("<div id=related>", "</div>"),
                       ("<div class='page right-sidebar'>", "</div>"), ("<form><div class=overlay>", "</div></form>")):
        for tag in ("article", "main"):
            page = f"<body>{start}<nav><a href=x>Menu</a></nav><{tag}>{body}{share}</{tag}><label>Name</label><button>Go</button>{end}<footer>F</footer>"
            assert hx.main_text(page) == want
    for start, end in (("<form>", "</form>"), ("<div class=elementor-widget-theme-post-content>", "</div>"), ("<div class=social-page><form>", "</form></div>")):
        assert hx.main_text(f"<body><nav><a href=x>Menu</a></nav>{start}{body}{share}<label>Name</label><select><option>of</select>{end}") == want
    # what isn't a wrapper still goes
    teaser = f"<div class=related><article><p>{LONG}</p></article><article><p>{LONG}</p></article></div>"
    assert hx.main_text(f"<main><article>{body}</article></main>{teaser}") == want
    assert hx.main_text(f"<div>{body}<p>{LONG}</p></div>{teaser}") == f"{want} {LONG}"
    assert hx.main_text(f"<div>{body}</div><section class=comments><article><p>{LONG} I say.</p></article></section><form><p>{LONG}</p></form>") == want


def test_other_languages_and_short_pages():
    italian = "Il gatto dorme sopra il tappeto della cucina mentre fuori piove e i bambini giocano nella stanza accanto."
    polish = "Kot śpi na dywanie w kuchni, podczas gdy na zewnątrz pada deszcz, a dzieci bawią się w pokoju obok."
    russian = "Кошка спит на ковре в кухне, пока на улице идёт дождь, а дети играют в соседней комнате с собакой."
    chinese = "猫在厨房的地毯上睡觉,外面下着雨,孩子们在隔壁房间里和狗一起玩耍,老人坐在窗边看书。"
    for t in (italian, polish, russian, chinese):
        page = f"<body><nav><a href=x>x</a></nav><div><h1>{t[:20]}</h1><p>{t}</p><p>{t[:9]}</p><p>{t}</p></div><div><a href=y>{t}</a></div><footer>{t}</footer>"
        assert hx.main_text(page) == " ".join(x.strip() for x in (t[:20], t, t[:9], t))
    assert hx.main_text("<nav><a href=a>Menu</a></nav><h1>Ode</h1><p>O cat,<p>o mat,<p>that is that.<p><a href=b>More odes</a><footer>End</footer>") == "Ode O cat, o mat, that is that."


def test_linked_headings_and_items_of_the_article():
    page = f"<article><h2><a href=a>A linked heading</a></h2><p>{LONG}</p><ul><li><a href=b>First item</a></li><li>Second</li></ul><p><a href=c>Only a link</a></p></article>"
    assert hx.main_text(page) == f"A linked heading {LONG} First item Second"


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, "u", ""), (2, "u", ""), (None, None, f"<p>{LONG}"), (3, "u", "<p>" + "the of " * 30_000)],
                               "page_id long, url string, html string")
    got = hx.extract(frames.with_clashes(df.withColumnRenamed("url", "text"))).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text_"]) for r in got)
    by = {r["page_id"]: r["text_"] for r in got}
    assert by[1] == "" and by[2] == "" and by[None] == LONG and len(by[3]) == 7 * 30_000 - 1
    assert hx.extract(df.filter("false")).count() == 0


LONG_TEXT = "The council met on Tuesday and it was said that the plan for the new bridge is to be put to the vote in the spring of the year."


@pytest.mark.parametrize("open_, close", [
    ('<main><article class="post category-cookies tag-baking">', "</article></main>"),
    ('<article class="post comments-open">', "</article>"),
    ('<div class="post comments-enabled">', "</div>"),
    ('<div class="content-sidebar-wrap">', "</div>"),
    ('<body class="single comments-closed has-sidebar"><div class="sidebar-container">', "</div></body>"),
    ('<div id="page" class="site cookie-notice-active"><article class="hentry status-publish tag-newsletter">', "</article></div>"),
    ('<article class="entry social">', "</article>"),
    ('<div class="elementor-widget-container">', "</div>")])
def test_names_of_states_and_categories_take_nothing(open_, close):
    menu = '<nav><a href="/">Home</a> <a href="/a">About</a></nav>'
    page = f"<html>{menu}{open_}<p>{LONG_TEXT}</p><p>{LONG_TEXT}</p>{close}<div class='cookie-notice'>We use cookies to make the site better for you and for us and for all.</div></html>"
    assert hx.main_text(page) == f"{LONG_TEXT} {LONG_TEXT}"


@pytest.mark.parametrize("mark", ["comments", "comment-list", "comments-area", "cookie-banner", "sidebar", "sidebar-wrapper", "ads", "newsletter-wrap"])
def test_what_is_named_goes(mark):
    page = f"<article><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></article><div class='{mark}'><p>{LONG_TEXT[::-1]}</p></div>"
    assert hx.main_text(page) == f"{LONG_TEXT} {LONG_TEXT}"
    page = f"<div><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></div><div class='{mark}'><p>The readers said that it is not the best of all of the plans there are for it.</p></div>"
    assert hx.main_text(page) == f"{LONG_TEXT} {LONG_TEXT}"


def test_comments_only_give_no_text():
    assert hx.main_text(f"<ol class='comment-list'><li><article class='comment-body'><p>{LONG_TEXT}</p></article></li></ol>") == ""
