"""Main text of web pages by tag-path ratios.

A page is read into text leaves, each with its path of tags from the root.
Subtrees that are no article text by their element or role (menus, forms, scripts
and so on: the fixed lists below) are left out first, but for wrappers: a form, header, dialog or hidden element (of
those in ``NEVER``, one that is never closed) around an article or main element, or around the headline
or paragraphs of a page without such elements, that holds twice as much text as stands outside all left-out ones.  A class token or id whose
words all speak against article text lowers the ratios of its leaves; inside an
article it leaves them out where the element's own ratio is low, too; an element
that holds an article or most of the content is never meant.  Then, per
path, text length and punctuation are summed over its leaves and divided by their
number; the two ratios are fused (geometric mean), given to each leaf, smoothed
over the page's sequence of leaves with a Gaussian window, and leaves above half
a standard deviation over half the mean are content.  All content leaves are kept.
So are, but for leaves of lowered ratio: the other leaves of the deepest element
that holds nearly all content and of every article or main element with content,
runs of up to ``NEAR`` leaves between kept ones, and a heading at most ``NEAR``
leaves before a kept one with what is between.

Blocks are the runs of leaves between block-level tags or line breaks.

Cases: null and empty pages, and pages without text, give an empty text; broken
markup is read as it comes, an unclosed element ends with its parent, and of an
unclosed menu only what stands before the first headline or paragraph is a menu; an unclosed ``svg`` ends at the
first HTML element; elements are read at any depth; repeated
rows give a row each.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, text_of

# Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe"
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT = frozenset("nav header footer aside form button label select option dialog menu search head svg math canvas object".split())
#: Of these, a closed element is never a wrapper of the article.
NEVER = frozenset("nav footer aside button label select option menu search head svg math canvas object".split())
#: HTML elements that end a drawing or formula which they stand in, besides the blocks.
ENDS_DRAWING = frozenset("b big code em embed font i img nobr ruby s small span strong strike sub sup tt u var".split())
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist status".split())
#: Words of class and id values that speak against article text, where all words of a whole class token or id are among them.
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adbox adslot sponsor sponsored promo promotion promoted banner menu menus nav "
    "navbar navigation navi breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer foot masthead header topbar cookie cookies "
    "consent gdpr notice notices popup modal overlay alert newsletter subscribe subscription signup login signin social share sharing "
    "comment comments respond reply replies disqus discussion feedback related recommended recommendations trending search searchbox form "
    "pagination pager toolbar skip hidden copyright legal disclaimer byline".split())
#: Elements that a new one of the same group closes: element -> (what it closes, where the search ends).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P = BLOCKS - {"br", "caption", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "head", "html", "body"}
SCOPES = frozenset("article aside body div section table td th main li blockquote figure form header footer nav fieldset html".split())
NARROW = BLOCKS & frozenset("p li blockquote dd dt figcaption figure h1 h2 h3 h4 h5 h6 pre td th tr tbody thead ul ol dl table".split())
PUNCTUATION = re.compile(r"[.,;:!?、。，！？…]")

_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_LETTERS = re.compile(r"[a-z]+")
#: What such a name leaves of its leaves' ratios; the share of the content that no such element may hold.
NAMED, MOST = 0.1, 2 / 3
#: So many leaves between kept ones, or from a heading to a kept one, are kept with them.
NEAR = 3
_KERNEL = [math.exp(-d * d / 2) for d in (2, 1, 0, 1, 2)]


class Element:
    """An element of a page; what its leaves inherit is passed down when it is opened, so no leaf walks up."""
    __slots__ = ("tag", "path", "parent", "index", "depth", "mark", "closed", "skip", "article", "outer", "heading", "drawing", "named", "holds")

    def __init__(self, tag, path, parent, index, mark, named=False):
        self.tag, self.path, self.parent, self.index, self.mark = tag, path, parent, index, mark
        own = tag in ("article", "main")
        self.depth = parent.depth + 1 if parent else 0
        self.closed = False  # by an end tag of its own
        self.article = own or bool(parent and parent.article)
        self.outer = parent.outer if parent and parent.outer else self if own else None  # the outermost article or main element
        self.heading = tag in HEADINGS or bool(parent and parent.heading)
        # an article's own header: its headings and paragraphs stay
        self.skip = tag == "header" or bool(parent and parent.skip and tag not in HEADINGS and (tag != "p" or named))
        self.drawing = self if tag in ("svg", "math") else parent.drawing if parent and tag not in ("foreignobject", "desc", "annotation-xml") else None
        self.named = self if named else parent.named if parent else None  # the innermost element with such a name
        self.holds = False  # an article or main element
        e = self.named if own else None
        while e is not None and not e.holds:
            e.holds = True
            e = e.parent.named


def _left_out(tag: str, given: dict[str, str], parent: Element) -> bool:
    if tag == "header" and parent.article:
        return False  # an article's own header: see ``Element.skip``
    if tag in LEFT_OUT or "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "").lower() in LEFT_OUT_ROLES:
        return True
    return "display:none" in given.get("style", "").replace(" ", "").lower()


def _named(tag: str, given: dict[str, str]) -> bool:
    """Whether all words of a class token or of the id speak against article text."""
    if tag in ("html", "body", "article", "main") or tag in HEADINGS or not ("class" in given or "id" in given):
        return False
    tokens = [*given.get("class", "").split(), given.get("id", "")]
    return any(w and LEFT_OUT_NAMES.issuperset(w) for w in (_LETTERS.findall(_CAMEL.sub(" ", t).lower()) for t in tokens))


def leaves(page: str) -> tuple[list[tuple[Element, int, str]], list[Element]]:
    """``(element, block, raw text)`` of all text leaves that aren't left out, and all elements in page order; blocks are numbered."""
    top = here = Element("", 0, None, 0, False)
    every, out, paths = [top], [], {}
    block, at = 0, 0
    opened: dict[str, int] = {}  # how many elements of a tag are open

    def close(e):
        """Close ``e`` and what is open inside it."""
        nonlocal here
        while here is not e.parent:
            opened[here.tag] -= 1
            here = here.parent

    def innermost(tags, scope):
        e = here
        while e is not top and e.tag not in tags and e.tag not in scope:
            e = e.parent
        return e if e.tag in tags else None

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            out.append((here, block, page[at:m.start()]))
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1]:
                block += here.drawing is None and m[1].lower() not in ("script", "style", "noscript", "template", "iframe")
            elif page.startswith("<![CDATA[", m.start()):
                out.append((here, block, m[0][9:].removesuffix("]]>")))
            continue
        block += tag in BLOCKS or tag == "select"
        if m[2] or m[5]:  # an end tag: closes the innermost such element
            if opened.get(tag):
                e = innermost({tag}, ())
                e.closed = True
                close(e)
            continue
        if here.drawing and (tag in BLOCKS or tag in ENDS_DRAWING):
            close(here.drawing)
        if tag in ENDS_P and opened.get("p"):
            e = innermost({"p"}, SCOPES)
            if e:
                close(e)
        if tag in CLOSES and any(opened.get(t) for t in CLOSES[tag][0]):
            e = innermost(*CLOSES[tag])
            if e:
                close(e)
        if tag in VOID or ((here.drawing or tag in ("svg", "math")) and (m[4] or "").endswith("/")):
            continue
        given = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(m[4] or "")} if m[4] else {}
        path = paths.setdefault((here.path, tag, given.get("class") or ""), len(paths) + 1)
        here = Element(tag, path, here, len(every), _left_out(tag, given, here), _named(tag, given))
        every.append(here)
        opened[tag] = opened.get(tag, 0) + 1
    if at < len(page):
        out.append((here, block, page[at:]))
    return _inside(out, every), every


def _inside(found: list[tuple[Element, int, str]], every: list[Element]) -> list[tuple[Element, int, str]]:
    """The leaves outside left-out elements, wrappers of the article not counted as such."""
    own = [0] * len(every)
    for e, _, t in found:
        own[e.index] += len(t) - t.count(" ") - t.count("\n")

    def sums(decide):
        """Per element: text, article or main elements, headlines and paragraphs in it, those in left-out ones inside not counted."""
        chars, articles, heads, pars = own[:], [0] * len(every), [0] * len(every), [0] * len(every)
        for e in reversed(every):
            i = e.index
            articles[i] += e.tag in ("article", "main")
            heads[i] += e.tag == "h1"
            pars[i] += e.tag == "p" and chars[i] > 0
            if e.mark and decide:
                decide(e, chars[i], articles[i], heads[i], pars[i])
            if e.parent and not e.mark:
                for x in (chars, articles, heads, pars):
                    x[e.parent.index] += x[i]
        return chars[0], articles[0] + heads[0]

    plain, head = sums(None)
    begun = {}  # of an unclosed one taken for a wrapper: itself

    def decide(e, chars, articles, heads, pars):
        if chars <= 2 * plain or (e.tag in NEVER and (e.closed or e.tag in ("svg", "math"))):
            return
        loose = e.tag != "header" or not e.closed
        if articles or (loose and not head and (heads or pars > 1)):
            e.mark = False
            if not e.closed and (e.tag in NEVER or e.tag == "header"):
                begun[e.index] = e

    if any(e.mark for e in every):
        sums(decide)
    out = [False] * len(every)
    before = [None] * len(every)  # the unclosed one around, until its first headline or paragraph
    for e in every[1:]:
        up = e.parent.index
        out[e.index] = out[up] or e.mark
        before[e.index] = before[up]
        if e.index in begun:
            before[e.index] = e.index
        elif before[up] is not None and e.tag in ("article", "main", "h1", "p"):
            begun[before[up]] = None
        if before[e.index] is not None and begun[before[e.index]] is None:
            before[e.index] = None
    return [x for x in found if not out[x[0].index] and before[x[0].index] is None
            and not (x[0].skip and x[0].article)]


def _ratio(n: int, chars: int, marks: int) -> float:
    """Geometric mean of the text-length and the punctuation ratio of ``n`` leaves."""
    return math.sqrt(chars / n * (1 + marks) / n)


def _marks(found: list[tuple[Element, int, str]]) -> list[int]:
    return [len(PUNCTUATION.findall(t)) for _, _, t in found]


def _content(found: list[tuple[Element, int, str]], marks: list[int], weight: list[float]) -> list[bool]:
    """Which leaves the tag-path ratios, times the leaves' weights, take for content."""
    by: dict[int, list[int]] = {}
    for (e, _, t), k in zip(found, marks):
        n = by.setdefault(e.path, [0, 0, 0])
        n[0] += 1
        n[1] += len(t)
        n[2] += k
    ratio = {p: _ratio(*n) for p, n in by.items()}
    raw = [ratio[e.path] * w for (e, _, _), w in zip(found, weight)]
    smooth = []
    for i in range(len(raw)):
        near = [(raw[i + d], k) for d, k in zip(range(-2, 3), _KERNEL) if 0 <= i + d < len(raw)]
        smooth.append(weight[i] * sum(v * k for v, k in near) / sum(k for _, k in near))
    mean = sum(smooth) / len(smooth)
    spread = math.sqrt(sum((v - mean) ** 2 for v in smooth) / len(smooth))
    return [v >= (mean + spread) / 2 for v in smooth]


def _weights(found: list[tuple[Element, int, str]], marks: list[int], chosen: list[bool], every: list[Element]) -> list[float]:
    """What the names leave of each leaf's ratio; 0 in articles, where a named element's own ratio is low, too."""
    named = [e for e in every if e.named is e]
    sums = {e: [0, 0, 0, 0] for e in named}  # leaves, text, punctuation, chosen text
    plain, total = [0, 0, 0], 0
    for (e, _, t), k, c in zip(found, marks, chosen):
        total += c * len(t)
        one = (1, len(t), k, c * len(t))
        if e.named is not None:
            sums[e.named] = [a + b for a, b in zip(sums[e.named], one)]
        elif e.article:
            plain = [a + b for a, b in zip(plain, one)]
    for e in reversed(named):
        up = e.parent.named
        if up is not None:
            sums[up] = [a + b for a, b in zip(sums[up], sums[e])]
    part = {}
    for x in named:
        n, chars, k, held = sums[x]
        if not n or x.holds or held > MOST * total:
            own = 1.0
        elif x.article:
            own = 0.0 if plain[0] and 2 * _ratio(n, chars, k) < _ratio(*plain) else 1.0
        else:
            own = NAMED
        up = x.parent.named
        part[x] = own if up is None else min(own, part[up])
    return [1.0 if e.named is None else part[e.named] for e, _, _ in found]


def _article(found: list[tuple[Element, int, str]], chosen: list[bool], every: list[Element]) -> Element:
    """The element whose leaves make the text."""
    held = [0] * len(every)
    for (e, _, t), c in zip(found, chosen):
        held[e.index] += c * len(t)
    for e in reversed(every[1:]):
        held[e.parent.index] += held[e.index]
    best = max((e for e in every if held[e.index] and held[e.index] >= 0.9 * held[0]), key=lambda e: e.depth)
    outer = best
    while outer is not None and outer.tag not in ("article", "main"):
        outer = outer.parent
    if outer is not None:
        return outer
    while best.parent is not None and (best.tag in NARROW or best.tag not in BLOCKS):
        best = best.parent
    return best


def _kept(found: list[tuple[Element, int, str]], chosen: list[bool], weight: list[float], every: list[Element]) -> set[int]:
    """Identities of the leaves that make the text."""
    # elements whose leaves all stay, but for those of lowered weight
    whole = {_article(found, chosen, every)} | {e.outer for (e, _, _), c in zip(found, chosen) if c and e.outer}
    inside = [False] * len(every)
    for e in every:
        inside[e.index] = e in whole or bool(e.parent and inside[e.parent.index])
    keep = [c or (w == 1 and inside[e.index]) for (e, _, _), c, w in zip(found, chosen, weight)]
    last = None  # the kept leaf before this one
    heading = None  # the last heading since then
    plain = [i for i, w in enumerate(weight) if w == 1 or keep[i]]
    add = []
    for at, i in enumerate(plain):
        if keep[i]:
            first = at if heading is None or at - heading > NEAR else heading
            if last is not None and at - last <= NEAR + 1:
                first = last + 1
            add += plain[first:at]
            last, heading = at, None
        elif (heading is None or at - heading > NEAR) and found[i][0].heading:
            heading = at
    for i in add:
        keep[i] = True
    return {id(x) for x, k in zip(found, keep) if k}


def main_text(page: str) -> str:
    """The article of a page: blocks in page order, joined by line breaks."""
    texts, every = leaves(page) if page else ([], [])
    found = [x for x in texts if not x[2].isspace()]
    if not found:
        return ""
    marks, weight = _marks(found), [1.0] * len(found)
    chosen = _content(found, marks, weight)
    if any(e.named for e, _, _ in found):
        weight = _weights(found, marks, chosen, every)
        chosen = _content(found, marks, weight)
    keep = _kept(found, chosen, weight, every)
    out, last, parts = [], None, []
    for x in texts:
        _, block, t = x
        if not t.isspace() and id(x) not in keep:
            continue
        if block != last:
            out.append(parts)
            parts, last = [], block
        parts.append(t)
    out.append(parts)
    blocks = (" ".join(html.unescape("".join(p)).split()) for p in out)
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    bounded_batches(pages.sparkSession)
    given = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), text_of(page).alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return given.mapInArrow(run, given.drop("html").schema.add("text", "string").add("n_chars", "long"))
