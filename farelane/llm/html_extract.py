"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass decides blocks
by where they stand (menus, headers, footers, sidebars, notices, adverts,
forms, comments are out), by length, stop-word density and link density; short
blocks and those between the limits stay open.  The second pass gives an open
block the label of its nearest decided neighbours.

A form, or an element marked by its name only, that holds the article or most
of the page's text is its wrapper and takes nothing out.  Stop words count only
on pages that are mostly in a language of theirs; elsewhere length and links
decide.  Where no block is decided to be main text, the open ones are."""

from __future__ import annotations

import html as htmllib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm.common import WORD, fresh, quoted

#: Frequent function words by language.
STOP_WORDS_BY_LANGUAGE = tuple(frozenset(x.split()) for x in (
    "the of and to in is that it for was on are as with his they at be this have from or had by but not what all were we when your can said there an which their if do will how",
    "le la les de des du un une et est en que qui dans pour pas sur avec ce il elle au aux par plus ne se son sa ses ou mais nous vous leur cette sont",
    "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach bei einer um am im noch wie",
    "el los las y en un una que es no se con por para su al lo como más pero sus le ya este si porque esta entre cuando muy sin sobre también me hasta",
))
STOP_WORDS = frozenset().union(*STOP_WORDS_BY_LANGUAGE)

RAW = "script|style|textarea|title|xmp|noembed|noframes"
TOKEN = regex.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<tag2>/?[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<[!?][^>]*>", regex.S | regex.I)
ATTR = regex.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s "
                   "samp small span strike strong sub sup time tt u var wbr br".split())
DROPPED_TAGS = frozenset("head nav footer aside form noscript template button select option svg math canvas iframe object "
                         "video audio menu dialog map input fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id names that mark what isn't the article.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars widget "
    "widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar "
    "comment comments disqus replies respond social share sharing related recommended skip disclaimer".split())
#: Names that a wrapper of the article bears too: it holds most of the text then.
WRAPPER_NAMES = frozenset(
    "popup modal overlay alert notice notices promo promotion sponsor sponsored newsletter subscribe subscription signup "
    "login widget widgets social share sharing related recommended skip disclaimer".split())
#: Names of what may hold articles of its own.
STRICT_NAMES = frozenset("comment comments disqus replies respond cookie cookies consent gdpr".split())
HEADER_NAMES = frozenset(("header", "site-header", "page-header"))
#: Names that begin so tell a state or a category of the page, not what the element is.
STATES = frozenset("has no with without is category cat tag term tags topic keyword format status postid".split())
#: So do names that end so.
STATE_ENDS = frozenset("open opened closed close enabled disabled allowed active on off visible".split())
#: What is around a thing may hold more than it.
WRAP_ENDS = frozenset("wrap wrapper container outer inner holder layout".split())
#: Names of an article, whatever else its class names say.
POST_NAMES = frozenset("post entry hentry article story".split())
WRAPPERS = frozenset(("html", "body", "main"))
CONTENT_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Scripts without spaces: a letter says as much as three of others.
DENSE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
LONG, SHORT_LINKS, LINKS, FEW_STOPS, MANY_STOPS = 70, 0.5, 0.33, 0.08, 0.2


@dataclass
class Block:
    text: str
    links: int  # characters inside links
    content: bool  # inside an article or main element
    dropped: bool
    heading: bool
    label: bool | None = field(default=None)  # True: main text
    item: bool = False  # of a list
    wrappers: tuple[int, ...] = ()  # elements that drop it unless they wrap the article


@dataclass
class Wrapper:
    """A form, or an element whose names mark it."""
    by_text: bool  # most of the text is enough to keep it
    mains: int = 0
    articles: int = 0


def _names(value: str) -> tuple[set[str], set[str], bool]:
    """(words of names that name the element, words of names around a thing,
    whether a name says that it is an article)."""
    own, around, post = set(), set(), False
    for name in value.split():
        parts = [x.lower() for x in regex.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)]
        post |= bool(parts) and parts[0] in POST_NAMES and len(parts) == 1
        if parts and parts[0] not in STATES and not (len(parts) > 1 and parts[-1] in STATE_ENDS):
            (around if len(parts) > 1 and parts[-1] in WRAP_ENDS else own).update(parts)
    return own, around, post


def _kind(tag: str, attrs: str, in_content: bool, named: bool = True) -> str:
    """"drop", "named" or "wrap" (dropped unless it holds the article; or most
    of the text), "content" or "" for an opened element.  An article outside
    any other is none of the rest by a name alone if a name says so, or if only
    weak names say otherwise.  Without ``named`` only strict names count."""
    if tag in DROPPED_TAGS and tag not in ("form", "fieldset"):
        return "drop"
    if tag == "header" and not in_content:
        return "drop"
    found = {}
    if attrs.strip():
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
    if found and tag not in WRAPPERS:
        if found.get("role", "").lower() in DROPPED_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
            return "drop"
        if regex.search(r"display\s*:\s*none", found.get("style", ""), regex.I):
            return "drop"
        names, around, post = _names(found.get("class", "") + " " + found.get("id", ""))
        marks = names & DROPPED_NAMES
        article = tag == "article" and not in_content
        if marks & STRICT_NAMES and not (article and post):
            return "drop"
        if named and not (article and (post or marks <= WRAPPER_NAMES)):
            if marks or "header" in names and not in_content:
                return "wrap" if marks and marks <= WRAPPER_NAMES else "named"
            if around & DROPPED_NAMES:
                return "wrap"
    if tag in ("form", "fieldset"):
        return "wrap"
    if tag in CONTENT_TAGS or found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody":
        return "content"
    return ""


def blocks(page: str, named: bool = True) -> list[Block]:
    """The page's blocks of text in order; without ``named``, names other than
    the strict ones drop nothing."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[tuple[str, bool]] = []
    count = {"drop": 0, "content": 0, "named": 0, "wrap": 0, "": 0}
    wrappers: list[Wrapper] = []
    around: list[int] = []  # open wrappers
    link = heading = item = form = 0

    def flush() -> None:
        if parts:
            text = " ".join(htmllib.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = len(" ".join(htmllib.unescape("".join(p for p, a in parts if a)).split()))
                out.append(Block(text, linked, count["content"] > 0, count["drop"] > 0, heading > 0,
                                 item=item > 0, wrappers=tuple(around)))
            parts.clear()

    def pop() -> None:
        nonlocal link, heading, item, form
        tag, kind = stack.pop()
        count[kind] -= 1
        if kind in ("named", "wrap"):
            around.pop()
        link -= tag == "a"
        heading -= tag in HEADINGS
        item -= tag == "li"
        form -= tag == "form"

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append((page[at:m.start()], link > 0))
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            if m["raw"] and m["raw"].lower() == "textarea":
                flush()
            continue
        end = bool(m["end"]) or tag[0] == "/"
        tag = tag.lstrip("/").lower()
        if tag == "br":
            parts.append((" ", False))
            continue
        block = tag not in INLINE
        if end:
            if any(t == tag for t, _ in stack):
                if block:
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif block:
                flush()
            continue
        attrs = m["attrs"] or ""
        if block:
            flush()
            # a block ends an open paragraph, and inline elements left open in it
            if tag not in VOID and any(t == "p" for t, _ in stack):
                i = max(i for i, (t, _) in enumerate(stack) if t == "p")
                if all(t in INLINE for t, _ in stack[i + 1:]):
                    while len(stack) > i:
                        pop()
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i][0] in ("ul", "ol", "dl", "table", "menu"):
                        break
        if tag in VOID or attrs.rstrip().endswith("/") and tag in ("path", "circle", "use"):
            continue
        kind = _kind(tag, attrs, count["content"] > 0, named)
        if form and tag in ("label", "legend", "output"):
            kind = "drop"
        if kind and not block:  # an inline advert or the like is a block of its own
            flush()
        stack.append((tag, kind))
        if kind == "content" and not count["drop"]:
            for w in around:
                wrappers[w].mains += tag != "article"
                wrappers[w].articles += tag == "article" and not count["content"]
        count[kind] += 1
        if kind in ("named", "wrap"):
            around.append(len(wrappers))
            wrappers.append(Wrapper(kind == "wrap"))
        link += tag == "a"
        heading += tag in HEADINGS
        item += tag == "li"
        form += tag == "form"
    if at < len(page):
        rest = page[at:]
        cut = regex.search(r"<[a-zA-Z/!][^<>]*\Z", rest)  # a tag that the page's end cuts
        parts.append((rest[:cut.start()] if cut else rest, link > 0))
    flush()
    _unwrap(out, wrappers)
    return out


def _size(b: Block) -> int:
    return len(b.text) + 2 * len(DENSE.findall(b.text))


def _unwrap(found: list[Block], wrappers: list[Wrapper]) -> None:
    """Drop the blocks of all wrappers but those that hold the article."""
    if not wrappers:
        return
    some = [b for b in found if not b.dropped and b.links <= LINKS * len(b.text)]
    free = any(b.content and not b.wrappers and _size(b) >= LONG for b in some)
    if free:
        some = [b for b in some if b.content]
    sizes = [(_size(b), b.wrappers) for b in some]
    if any(n >= LONG for n, _ in sizes):
        sizes = [x for x in sizes if x[0] >= LONG]
    own = [0] * len(wrappers)
    for n, around in sizes:
        for w in around:
            own[w] += n
    total = sum(n for n, _ in sizes)
    kept = {i for i, w in enumerate(wrappers) if not free and own[i] and (w.mains or w.articles == 1)
            or w.by_text and own[i] >= LONG and 2 * own[i] > total}
    for b in found:
        b.dropped = b.dropped or not kept.issuperset(b.wrappers)


def _known_language(found: list[Block]) -> bool:
    """Whether half of the text of long blocks has the stop words of a language."""
    known = total = 0
    for b in found:
        n = _size(b)
        if n >= LONG:
            words = [w.lower() for w in WORD.findall(b.text)]
            total += n
            known += n * any(sum(w in x for w in words) >= MANY_STOPS * len(words) for x in STOP_WORDS_BY_LANGUAGE)
    return 2 * known >= total


def classify(found: list[Block]) -> None:
    """Give every block its label."""
    inside = any(b.content and not b.dropped for b in found)
    known = _known_language([b for b in found if not b.dropped and b.content >= inside and b.links <= LINKS * len(b.text)])
    for b in found:
        n = len(b.text)
        words = [w.lower() for w in WORD.findall(b.text)]
        stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        links = b.links / n
        if b.dropped or inside and not b.content:
            b.label = False
        elif links > (SHORT_LINKS if inside else LINKS):
            b.label = inside and (b.heading or b.item)
        elif not known:
            b.label = True if _size(b) >= LONG else None
        elif n >= LONG and stops >= (FEW_STOPS if inside else MANY_STOPS):
            b.label = True
        elif n >= LONG and not inside and stops < FEW_STOPS:
            b.label = False
    if not any(b.label for b in found):
        for b in found:
            b.label = b.label is None
        return
    # nearest decided neighbours; with an article, within it
    part = [b for b in found if b.content and not b.dropped] if inside else found
    decided = [b.label for b in part]
    before: list[tuple[int, bool] | None] = []
    last = None
    for i, x in enumerate(decided):
        before.append(last)
        last = (i, x) if x is not None else last
    nxt = None
    for i in range(len(part) - 1, -1, -1):
        if decided[i] is not None:
            nxt = (i, decided[i])
            continue
        b, prev = part[i], before[i]
        near = [x for x in (prev, nxt) if x]
        if not near:
            b.label = inside
        elif len(near) == 1 or near[0][1] == near[1][1]:
            b.label = near[0][1]
            if inside and not b.label and not b.links:
                b.label = True  # plain text of the article among its link lists
        elif b.heading or inside:
            b.label = nxt[1] if b.heading and nxt and not inside else True if inside else nxt[1]
        else:
            b.label = near[0][1] if i - prev[0] < nxt[0] - i else near[1][1] if nxt[0] - i < i - prev[0] else False


def main_text(page: str | None) -> str:
    """The article's text: its blocks in page order, joined by a space."""
    if not page:
        return ""
    found = blocks(page)
    classify(found)
    if not any(b.label for b in found):
        # names took everything: long blocks with few links are no menu or notice
        best = blocks(page, named=False)
        classify(best)
        if any(b.label and _size(b) >= LONG and b.links <= LINKS * len(b.text) for b in best):
            found = best
    return " ".join(b.text for b in found if b.label)


@F.pandas_udf(T.StringType())
def _main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p) for p in pages], dtype=object)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` (the main text; empty for null
    and for pages without any) and ``n_chars`` (its code points); names get
    ``_`` appended if ``pages`` has them.  Repeated rows stay, pages of any
    length are read whole, an empty table gives an empty one."""
    text, n = fresh(pages.drop(html), "text", "n_chars")
    return (pages.withColumn(text if text != html else text + "_", _main_text(quoted(html))).drop(html)
            .withColumn(n, F.length(quoted(text)).cast("long")))
