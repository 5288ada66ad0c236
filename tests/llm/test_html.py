import re
from html import unescape
from time import process_time

import numpy as np
import pytest

from readloom.llm.html import Line, Settings, extract, kept, lines_of, main_text

LONG = "This sentence is long enough to count as running text of an article on its own, as it has well over ninety characters."


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><h1>T</h1><p>a  b\n c</p><p>&lt;x&gt; &amp;&nbsp;y &#233;</p></article>", "T\na b c\n<x> & y é"),
        ("<nav><ul><li><a href='/'>Home</a></li></ul></nav><article><p>one<p>two<br>three</article><footer>end</footer>", "one\ntwo three"),
        ("<article><p>a</p><div class='ad'>buy</div><p>b</p><aside>side</aside><form>f<input></form><p>c</p></article>", "a\nb\nc"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><article>x<!-- <p>hidden</p> --></article>", "x"),
        ("<article><header><h1>T</h1></header><p>a</p></article><header>site</header>", "T\na"),
        ("<article><p>a</p></article><section id='comments'><p>" + LONG + "</p></section>", "a"),
        ("<main><p>a</p><div class='sidebar'><p>s</p></div><ul><li>i<li>j</ul></main>", "a\ni\nj"),
        ("<article><p>a</p><div class='cookie-notice'><div>n</div></div><p>b</p><article class='comment'>c</article></article>", "a\nb"),
        ("<div class='content'><p>" + LONG + "</p><p>Short.</p></div><div><a href=x>link</a> <a href=y>link</a></div>", LONG + "\nShort."),
        ("<p>5 < 6 and 7 > 3</p>", "5 < 6 and 7 > 3"),
        ("<article><p title=\"open>one</p><p>two</p></article>", "one\ntwo"),
        ("<ARTICLE><P CLASS=AD>no<P>yes</ARTICLE>", "yes"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>y<b>e</b>s</p></article>", "yes"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
        ("<article><p>a</p><!-- never ends <p>b</p></article>", "a"),
        ("<article><div class=ad>never closed<p>still</p></article><p>out</p>", "out"),
        # A mark is a weight: it does not outweigh running text elsewhere.
        ("<div role='main'><p>a</p></div><div><p>" + LONG + "</p></div>", LONG),
        ("<div role='main'><p>" + LONG + "</p><p>b</p></div><div><p>short</p></div>", LONG + "\nb"),
        ("<article class=card><p>card</p></article><div><p>" + LONG + "</p><p>" + LONG + "</p></div>", LONG + "\n" + LONG),
        ("<h1>T</h1><a name=top>" + f"<p>{LONG}</p>" * 4, "\n".join(["T"] + [LONG] * 4)),
        ("<a href=x>" + f"<p>{LONG}</p>" * 4, "\n".join([LONG] * 4)),
        ("<a href=x>go<p>" + LONG + "</p><a href=y>on</a>", LONG),
        ("<a href=x><div>" + LONG + "</div></a><p>b</p>", "b"),
        ("<article><p>short</p><p>" + LONG + "</p><nav><a href=x>i</a></nav><p>c</p></article>", "short\n" + LONG + "\nc"),
        ("plain text", "plain text"),
        ("", ""),
        (None, ""),
        ("<nav>only</nav>", ""),
    ],
)
def test_main_text(html, want):
    assert main_text(html) == want


FOUR = "".join(f"<p>{LONG} {i}</p>" for i in range(4))
PARAGRAPHS = "\n".join(f"{LONG} {i}" for i in range(4))


@pytest.mark.parametrize(
    "html",
    [
        f'<div class="content no-sidebar">{FOUR}</div>',
        f'<div class="main ad-free">{FOUR}</div>',
        f'<article><div class="share-price-report">{FOUR}</div></article>',
        f'<div id="search-for-meaning">{FOUR}</div>',
        f'<div class="related-work">{FOUR}</div>',
        f'<body><form id="aspnetForm"><div><a href=x>Home</a></div>{FOUR}</form></body>',
        f'<div class="content no-nav">{FOUR}</div>',
        f'<div class="widget">{FOUR}</div><ul><li><a href=x>Short</a></ul>',
        f'<form><div class="widget"><div class="ad-free">{FOUR}</div></div></form>',
        f'<form>{FOUR}<div class="comments"><p>{LONG}</p></div><div class="share-buttons">Share this</div></form>',
        f'<div class="layout no-sidebar">{FOUR}<div class="sidebar"><p>{LONG}</p></div><div class="cookie-notice">{LONG}</div></div>',
    ],
)
def test_names_do_not_empty_a_page(html):
    assert main_text(html) == PARAGRAPHS


def test_an_article_elsewhere_upholds_a_mark():
    for clutter in (f'<section class="comments">{FOUR}</section>', f"<form>{FOUR}</form>", f'<div class="widget">{FOUR}</div>'):
        assert main_text(f"<article><p>{LONG}</p></article>{clutter}") == LONG


def test_nested_marks_take_linear_time():
    began = process_time()
    assert main_text('<div class="ad">' * 60_000 + LONG) == LONG
    assert process_time() - began < 10


def test_generic_pages_keep_the_surge():
    menu = "".join(f"<div><a href='/{i}'>Item {i}</a></div>" for i in range(20))
    body = "".join(f"<div>{LONG} {i}</div>" for i in range(5))
    assert main_text(f"<body>{menu}{body}{menu}</body>") == "\n".join(f"{LONG} {i}" for i in range(5))


def plain_kept(lines, s=Settings()):
    """The surge and dive rule once more, line by line from its wording."""
    n = len(lines)
    weight = [x.plain * (s.marked if x.article else 1) for x in lines]

    def window(i):
        total = 0
        for k in range(i, min(n, i + s.window)):
            if lines[k].article != lines[i].article:
                break
            total += weight[k]
        return total

    most = max(map(window, range(n)), default=0)
    level = s.surge if most > s.surge else most - 1
    out = [False] * n
    if most:
        for i in range(n):
            lo = i  # back to the start of i's stretch
            while lo > 0 and lines[lo - 1].article == lines[i].article and window(lo - 1):
                lo -= 1
            if not window(i) or lines[i].menu:
                continue
            before = range(lo, i + 1)
            hi = i
            while hi + 1 < n and lines[hi + 1].article == lines[i].article and window(hi + 1):
                hi += 1
            if lines[i].article:
                out[i] = any(weight[k] and window(k) > level for k in range(lo, hi + 1)) and any(weight[k] for k in before)
            else:
                out[i] = any(weight[k] and window(k) > level for k in before)
    return out


def test_windows_equal_the_plain_rule():
    rng = np.random.default_rng(2)
    for _ in range(400):
        lines = [Line("x", int(rng.choice([0, 0, 3, 20, 60, 120])), bool(rng.random() < 0.1), False) for _ in range(rng.integers(0, 25))]
        a, b = sorted(rng.integers(0, 26, 2))
        for x in lines[a:b]:
            x.article = True
        assert kept(lines, Settings()) == plain_kept(lines)


def test_given_pages(spark):
    """On the given pages, which mark their article, the windows find the article's blocks and leave the menu's out."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    decided = 0
    for (html,) in pages:
        inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|ul|li|div)\b[^>]*>", re.sub(r"<br\b[^>]*>", " ", inner))
        text = [" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        assert main_text(html) == "\n".join(t for t in text if t)
        decided += "\n".join(x.text for x in lines_of(html)) != main_text(html)
    assert decided > len(pages) / 2  # without the windows the menus would stay


@pytest.mark.parametrize("html", ["<a " * 330_000, "<b>" * 150_000 + "</i>" * 150_000, '<a ">"' * 150_000, "<i><div>" + "<b>" * 150_000 + "</i>" * 150_000, "<b>" * 150_000 + "<hr>" * 150_000, "<p><a href=x>" * 70_000])
def test_broken_pages_take_linear_time(html):
    began = process_time()
    main_text(html)
    assert process_time() - began < 10  # seconds for 1 MB; one that grew with the square would take minutes


def test_many_open_tags_and_long_pages():
    assert main_text("<article>" + "<div><p>x" * 3000 + "</article>").count("x") == 3000
    assert len(main_text("<article><p>" + "word " * 200_000)) == 999_999


def test_frames(spark):
    rows = [(1, "u", "<article><p>a</p></article>", 9), (1, "u", "<article><p>a</p></article>", 9), (2, None, None, None), (None, "v", "", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(tuple(r)[2:] for r in got.collect()) == [("", 0), ("", 0), ("a", 1), ("a", 1)]
    assert extract(df.limit(0)).count() == 0
