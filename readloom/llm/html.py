"""HTML extraction by line-block distribution: text lengths over sliding line windows, kept between surge and dive."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What may follow ``<``: a comment or declaration, or a tag's slash and name. Any other ``<`` is text.
OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
#: The rest of a tag, where a quoted value may hold ``>``.
REST = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
ROLE = re.compile(r"""\brole\s*=\s*["']?(?:main|article)\b""", re.I)
LINKED = re.compile(r"\bhref\s*=", re.I)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

#: Elements whose content is no markup, and is no text of the page either.
RAW = frozenset("script style title textarea iframe noembed noframes xmp noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start and end a block.
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th
    thead tr ul""".split()
)
#: Elements that never hold the article; they are stripped as markup is.
CLUTTER = frozenset("footer aside dialog select button fieldset svg canvas object audio video math datalist".split())
#: Words of class, id and role that mark such elements too. A name that is one of them, or made of them alone, is a strong
#: mark; a name with one among its parts ("share-price-report") is a weak one.
MARKS = frozenset(
    """ad ads adv advertisement advert banner comment comments commentlist consent cookie cookies disclaimer disqus footer login masthead
    modal newsletter notice notices notification overlay paywall popup promo promotion recommended related respond reactions replies reply
    search share sharing sidebar signup social sponsor sponsored subscribe teaser widget complementary contentinfo alert alertdialog
    form""".split()
)
#: Elements and words of menus. They are not stripped: their text counts as link text, and the windows leave it out.
MENUS = frozenset("nav menu".split())
MENU_WORDS = frozenset("breadcrumb breadcrumbs menu nav navbar navigation pager pagination toolbar".split())
#: The same for what is a header only outside the article.
TOPS = frozenset("header top topbar site-header".split())
#: Marks of an article element that is a reader's comment or points to another page.
REMARKS = frozenset("comment comments teaser related reply".split())
#: Start tags that close an open element of the same set.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass(frozen=True)
class Settings:
    """``window`` lines make a block of lines; text surges where a block weighs more than ``surge`` characters.

    A line in an article or main element weighs ``marked`` times its characters. An element that tags or names mark as
    clutter is none if it holds more than a share of the page's characters, ``weak`` or ``strong`` by the mark.
    """

    window: int = 3
    surge: int = 86
    marked: int = 2
    weak: float = 0.5
    strong: float = 0.9


@dataclass
class Line:
    """One block of a page: its text, the characters outside links, and where it lies."""

    text: str
    plain: int
    menu: bool
    article: bool
    mark: int = 0


@dataclass(frozen=True)
class Mark:
    """A marked element: the number of the marked one around it, and the share of the page's weight that refutes the mark.

    If ``alone``, an article outside the element upholds the mark whatever the element weighs.
    """

    outer: int
    share: float
    alone: bool


@dataclass
class Element:
    """An open element: whether text in it is clutter in any case, a menu's, or the article's, and the innermost mark's number."""

    name: str
    clutter: bool = False
    menu: bool = False
    article: bool = False
    mark: int = 0


def words_of(attributes: str) -> set[str] | None:
    """Names in class, id and role, whole; None for a hidden element."""
    words: set[str] = set()
    if not attributes or attributes.isspace():
        return words
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return None
        if key in ("class", "id", "role"):
            words.update(value.split())
    return words


def refuting_share(name: str, words: set[str], outer: Element, settings: Settings) -> tuple[float, bool] | None:
    """What an element's tag and names mark it as: the share of the page's weight that refutes it, and if only without an article elsewhere."""
    known = MARKS if outer.article else MARKS | TOPS
    parts = [set(filter(None, re.split(r"[_:-]+", w))) for w in words]
    if name == "article":
        return (settings.strong, True) if any(p & REMARKS for p in parts) else None
    if words & known or any(p and p <= known for p in parts):
        return settings.strong, True
    if name == "form":
        return settings.weak, True
    if any(p & MARKS or (len(p) > 1 and p & MENU_WORDS) for p in parts):
        return settings.weak, False
    return None


class Page:
    """Collects the lines of a page in one pass; every step costs as much as it reads, opens or closes.

    Open elements are kept on a stack, with the places of those that scope others (blocks and clutter), and the number
    of open ones by name: a closing tag without its element costs nothing, and one with it pays for what it closes.
    """

    def __init__(self, settings: Settings) -> None:
        self.settings = settings
        self.lines: list[Line] = []
        # Marked elements in the order of their start, number 0 being the page; and how many articles begin inside each, less those in inner marks.
        self.marks: list[Mark] = [Mark(0, 0.0, False)]
        self.articles: list[int] = [0]
        self.stack: list[Element] = [Element("")]
        self.scopes: list[int] = [0]
        self.open: Counter[str] = Counter()
        self.inner: list[Counter[str]] = [Counter()]
        self.parts: list[str] = []
        self.plain = 0
        # The open link: its place on the stack, the block that it begins in, and per later line the characters that it covers.
        self.link: int | None = None
        self.blocks = self.link_block = 0
        self.covered: list[list[int]] = []

    def flush(self) -> None:
        self.blocks += 1
        if self.parts:
            text = " ".join("".join(self.parts).split())
            top = self.stack[-1]
            if text and not top.clutter:
                self.lines.append(Line(text, 0 if top.menu else self.plain, top.menu, top.article, top.mark))
            self.parts.clear()
        self.plain = 0

    def add(self, text: str) -> None:
        if text:
            text = unescape(text) if "&" in text else text
            self.parts.append(text)
            n = len(text.strip())
            if self.link is None:
                self.plain += n
            elif n and self.blocks > self.link_block and not self.stack[-1].clutter:
                at = len(self.lines)
                if self.covered and self.covered[-1][0] == at:
                    self.covered[-1][1] += n
                else:
                    self.covered.append([at, n])

    def end_link(self, closed: bool) -> None:
        """A link that its own tag closes covers all its text; one left open covers what it shares a block with."""
        if self.link is not None and not closed:
            for at, n in self.covered:
                if at < len(self.lines):
                    if not self.lines[at].menu:
                        self.lines[at].plain += n
                else:
                    self.plain += n
        self.link = None
        self.covered = []

    def cut(self, place: int) -> None:
        """Closes all open elements from ``place`` on."""
        if self.link is not None and self.link >= place:
            self.end_link(False)
        end = len(self.stack)  # where the scopes that end here begin
        while len(self.scopes) > 1 and self.scopes[-1] >= place:
            end = self.scopes.pop()
            self.inner.pop()
        for e in self.stack[place:]:
            self.open[e.name] -= 1
        for e in self.stack[place:end]:
            self.inner[-1][e.name] -= 1
        del self.stack[place:]

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if name in BLOCK:
            self.flush()
            if self.stack[self.scopes[-1]].name == "p":  # a block ends the paragraph that it starts in
                self.cut(self.scopes[-1])
            if name in CLOSES and self.stack[-1].name in CLOSES[name]:
                self.cut(len(self.stack) - 1)
        if name in VOID:
            return
        if name == "a":
            self.end_link(False)
        found = self.element(name, attributes)
        if (found.clutter and not self.stack[-1].clutter) or found.mark != self.stack[-1].mark:
            self.flush()
        if name == "a" and LINKED.search(attributes):
            self.link, self.link_block = len(self.stack), self.blocks
        self.open[name] += 1
        if name in BLOCK or name in CLUTTER:
            self.scopes.append(len(self.stack))
            self.inner.append(Counter())
        else:
            self.inner[-1][name] += 1
        self.stack.append(found)

    def close(self, name: str) -> None:
        if name == "a":
            self.end_link(True)
        if name in BLOCK:
            self.flush()
        scoped = name in BLOCK or name in CLUTTER
        if not (self.open if scoped else self.inner[-1])[name]:
            return  # no such element is open, or none in the block at hand
        place = len(self.stack) - 1
        while self.stack[place].name != name:
            place -= 1
        if self.stack[place].clutter or self.stack[place].mark != self.stack[place - 1].mark:
            self.flush()
        self.cut(place)

    def element(self, name: str, attributes: str) -> Element:
        """The element that a start tag opens inside the innermost open one."""
        outer = self.stack[-1]
        words = set() if name in ("html", "body", "main", "head") else words_of(attributes)
        clutter = outer.clutter or words is None or name in CLUTTER or (name == "header" and not outer.article)
        mark, marked = outer.mark, None
        if not clutter and (words or name == "form") and (marked := refuting_share(name, words, outer, self.settings)):
            mark = len(self.marks)
            self.marks.append(Mark(outer.mark, *marked))
            self.articles.append(0)
        article = not clutter and not marked and (name in ("article", "main") or ROLE.search(attributes) is not None)
        if article and not outer.article:
            self.articles[mark] += 1
        menu = name in MENUS or bool(words and words & MENU_WORDS)
        return Element(name, clutter, outer.menu or menu, outer.article or article, mark)

    def upheld(self) -> list[Line]:
        """The lines less those in an element whose mark holds.

        An element's weight are the characters outside links and menus in it; one that holds more than its mark's share
        of the page's weight is no clutter, whatever its names say. Marks inside it are judged by themselves.
        """
        n = len(self.marks)
        weight, articles = [0] * n, list(self.articles)
        for x in self.lines:
            weight[x.mark] += x.plain
        for k in range(n - 1, 0, -1):  # an inner mark has a higher number
            weight[self.marks[k].outer] += weight[k]
            articles[self.marks[k].outer] += articles[k]
        gone = [False] * n
        for k, m in enumerate(self.marks[1:], 1):
            refuted = weight[k] > m.share * weight[0] and not (m.alone and articles[k] < articles[0])
            gone[k] = gone[m.outer] or not refuted
        return [x for x in self.lines if not gone[x.mark]]


def lines_of(html: str, settings: Settings = Settings()) -> list[Line]:
    """The page's blocks in order, less markup and clutter."""
    page = Page(settings)
    at, end, quotes = 0, len(html), True
    while at < end:
        m = OPENING.search(html, at)
        if m is None:
            page.add(html[at:])
            break
        page.add(html[at : m.start()])
        comment, declaration, slash, name = m.groups()
        at = m.end()
        if comment or declaration:
            close = html.find("-->" if comment else ">", at)
            at = end if close < 0 else close + (3 if comment else 1)
            continue
        rest = REST.match(html, at) if quotes else None
        if rest is None:
            # A quote that never ends hides no tag: from here on a tag ends with its first ``>``.
            quotes = False
            close = html.find(">", at)
            if close < 0:
                break
            attributes, at = html[at:close], close + 1
        else:
            attributes, at = rest[1], rest.end()
        name = name.lower()
        if slash:
            page.close(name)
        elif name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
        else:
            page.start(name, attributes)
    page.flush()
    page.end_link(False)
    return page.upheld()


def kept(lines: list[Line], settings: Settings) -> list[bool]:
    """Which lines lie between a surge and a dive of the windows' text lengths.

    A line weighs its characters outside links and menus, in the article ``marked`` times as many. A window is a line
    and those behind it, up to an edge of the article, so that text outside the article surges by itself or not at all,
    and so does text inside. A run holds a window that surges and goes on until a window sinks to nothing; it starts
    with the first line that weighs of the first window to surge, inside the article with the first line of the
    stretch that weighs. If no window surges, the heaviest one does. Lines of menus inside a run are left out.
    """
    weight = [x.plain * (settings.marked if x.article else 1) for x in lines]
    n = len(weight)
    edge = [n] * n
    for i in range(n - 2, -1, -1):
        edge[i] = edge[i + 1] if lines[i].article == lines[i + 1].article else i + 1
    sums = [sum(weight[i : min(i + settings.window, edge[i])]) for i in range(n)]
    if not n or max(sums) == 0:
        return [False] * n
    level = settings.surge if max(sums) > settings.surge else max(sums) - 1
    keep = [False] * n
    i = 0
    while i < n:
        if not sums[i]:
            i += 1
            continue
        j = i  # the stretch i..j-1 of windows that are not empty, on one side of an edge
        while j < edge[i] and sums[j]:
            j += 1
        first = next((k for k in range(i, j) if weight[k] and sums[k] > level), None)
        if first is not None:
            if lines[i].article:
                first = next(k for k in range(i, j) if weight[k])
            for k in range(first, j):
                keep[k] = not lines[k].menu
        i = j
    return keep


def main_text(html: str | None, settings: Settings = Settings()) -> str:
    """The article's blocks, one a line."""
    lines = lines_of(html or "", settings)
    return "\n".join(x.text for x, k in zip(lines, kept(lines, settings), strict=True) if k)


def extract(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows (page_id, url, text, n_chars): the main text of every page, from its whole html.

    Markup is stripped to one line per block, and so are scripts, styles, hidden elements, and what tags or class names
    mark as form, header, footer, sidebar, notice, advert or reader comments, unless a form or a name so marks most of
    the page. The text is what lies between the surge
    and dive points of the lines' window sums; text in links and menus weighs
    nothing. Character references are decoded, white space in a block becomes one space, blocks are joined by a line
    feed in page order. A null or empty html, or one without text, gives an empty text. Unclosed
    tags end with what holds them, an unclosed link with its line, an unclosed comment or script at the end of the page.
    Time grows in proportion to the page, however broken its tags are. Rows that repeat are treated
    alike. Only page_id, url and html are read. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py(), settings) for x in b.column("html")]
            yield pa.RecordBatch.from_pydict(
                {"page_id": b.column("page_id"), "url": b.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
