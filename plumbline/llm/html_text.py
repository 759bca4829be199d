"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one looks at each block alone: its link density,
its length and its stop-word density make it good, bad, or ambiguous (near good, if only its length is wanting). Where a language has no known
stop words, sentence marks stand in for them. Where a block stands is evidence that moves this: an
article or main element asks for less, while navigation, footers, asides, forms and elements whose
names say that they surround a text (comments, sidebars, adverts, notices) lower what they hold to
bad, unless they hold most of the page's text, as a wrapper does. Pass two gives ambiguous blocks the
label of the nearest neighbours that their own text decides, on their side of an article's border.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import body, small_batches

#: Common words of four languages.
STOP_WORDS = frozenset(
    """
    the of and to in a is that it for as was with be by on not he his but at are this have from or had an they which one you were all
    her she there would their we him been has when who will no more if out so up said what its about than into them can only other
    der die und das von zu mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um
    am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde in den für
    le la les de des du et en un une est que qui dans pour pas par sur au plus ce ne se il elle sont avec son ou mais comme on aux leur
    el los las y del se su por con para una lo al como más pero sus o este ha si sin sobre es son no le
    """.split()
)
#: Elements that are never part of a text.
DROPPED = frozenset("head script style noscript template svg canvas iframe object audio video map select option datalist button input textarea".split())
#: Elements that surround a text; a header does so outside an article only.
SURROUND = frozenset("form nav footer aside dialog menu header".split())
#: Those of them that never hold the text, unless an article stands in them.
FIRM = frozenset("nav footer aside dialog menu".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript xmp iframe".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand within a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
#: Words of class, id and role that mark what surrounds a text.
AROUND = frozenset(
    """
    ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup
    modal overlay newsletter subscribe subscription signup login nav navbar navigation menu menus breadcrumb breadcrumbs crumbs sidebar side aside widget widgets
    related recommended recommendations share sharing social footer foot copyright toolbar search
    pagination pager complementary contentinfo toc hidden skip teaser outbrain taboola paywall disclaimer
    """.split()
)
#: Such words that mark what readers wrote; it may well be longer than the text.
TALK = frozenset("comment comments commentlist respond reply replies disqus discussion".split())
#: Such words that mark a header, which counts as one outside an article only.
TOP = frozenset("header masthead topbar hero".split())
#: Words that speak for a main text.
MAIN = frozenset("article main content post entry story".split())
#: Last words of a name that says whether readers may write.
OPENNESS = frozenset("open closed off on disabled enabled allowed".split())
#: First words of a name that says how an element looks or what it has, not what it is.
STATES = frozenset("has have with without no not is are overflow show hide hover toggle enable include js".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|$)", re.S)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
UNSEEN = re.compile(r"""\shidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
WORD = re.compile(r"[^\W\d_]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|[^A-Za-z0-9]+")

#: Characters from which a block is long, and up to which it is short; link density above which it is bad, and
#: above which it can't be ambiguous; stop-word densities from which a block is good, and under which a long one is bad.
LONG, SHORT, LINKS, SOME_LINKS, STOP_HIGH, STOP_LOW = 140, 60, 0.5, 0.2, 0.25, 0.08
#: The same inside an article: length, and the two densities.
INSIDE = 60, 0.1, 0.0
#: Stop-word density of all text under which the page's language has no known stop words.
UNKNOWN = 0.04
#: Characters from which a text without spaces between words is long.
LONG_DENSE = 40

GOOD, BAD, OPEN, NEAR = 1, -1, 0, 2

#: Sentence marks, and scripts that are written without spaces between words.
SENTENCE = re.compile(r"[.!?…。！？｡．।؟۔]")
DENSE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
LATIN = re.compile(r"[A-Za-z\u00c0-\u024f\u1e00-\u1eff]")


@dataclass
class Zone:
    """An element that may surround a text."""

    above: Zone | None = None
    firm: bool = False  # what it holds is around a text that stands elsewhere, however much it is
    unseen: bool = False  # it or an element around it is not shown
    wraps: bool = False  # holds an article or a main element, or the page's title
    size: int = 0
    low: bool = False


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    article: bool = False
    heading: bool = False
    zone: Zone | None = None
    text: str = ""


def names(attributes: str) -> list[list[str]]:
    """The names in an element's class, id and role, each as its words."""
    found = " ".join(m[2] or m[3] or m[4] or "" for m in NAMED.finditer(attributes)) if attributes else ""
    return [[w.lower() for w in CAMEL.split(name) if w] for name in found.split()]


def surrounds(named: list[list[str]], article: bool) -> set[str]:
    """Words of the names that say an element surrounds a text; states ('has-sidebar') say nothing."""
    words = {w for name in named if name and name[0] not in STATES and name[-1] not in OPENNESS for w in name}
    main = any(len(name) == 1 and name[0] in MAIN or name[:2] in (["main", "content"], ["post", "content"], ["entry", "content"], ["article", "body"]) for name in named)
    return set() if main else words & (AROUND | TALK | (frozenset() if article else TOP))


@dataclass
class Element:
    name: str
    gone: bool
    article: bool
    zone: Zone | None


def blocks_of(html: str) -> tuple[list[Block], list[Zone]]:
    """Blocks of a page in order, and the zones that they stand in, outer ones first."""
    out: list[Block] = []
    zones: list[Zone] = []
    root = Element("", False, False, None)
    stack: list[Element] = []
    open_now: Counter[str] = Counter()
    titled = False
    block = Block()
    link, heading, at, n = 0, False, 0, len(html)

    def here() -> Element:
        return stack[-1] if stack else root

    def add(text: str) -> None:
        if text and not here().gone:
            block.parts.append(text)
            if link:
                block.linked += len(text.strip())

    def close() -> None:
        nonlocal block
        if block.parts:
            block.text = " ".join(unescape("".join(block.parts)).split())
            if block.text:
                out.append(block)
        block = Block(article=here().article, heading=heading, zone=here().zone)

    def leave(k: int) -> None:
        nonlocal link, heading
        for e in stack[k:]:
            open_now[e.name] -= 1
            link -= e.name == "a"
            heading = heading and not (e.name[0] == "h" and e.name[1:].isdigit())
        del stack[k:]

    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name or (m[1] and name in VOID):
            continue
        if m[1]:
            if open_now[name]:
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name)
                parted = any(e.name not in INLINE for e in stack[k:])
                if parted:
                    close()
                leave(k)
                if parted:
                    block.article, block.heading, block.zone = here().article, heading, here().zone
            continue
        if name in ("br", "hr"):
            add(" ")
            if name == "hr":
                close()
        if name in VOID:
            continue
        if name not in INLINE:
            close()
            # A block-level element ends an open paragraph, and an item the item before it.
            ends = {"p"} | ({name} if name in ("li", "dt", "dd", "tr", "td", "th", "option") else set())
            while stack and (stack[-1].name in ends or (stack[-1].name in INLINE and any(e.name in ends for e in stack[-4:]))):
                leave(len(stack) - 1)
        if name in RAW and (name == "title" or name in DROPPED):
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        above, named = here(), names(m[3]) if m[3] else []
        main = name in ("article", "main") or any(len(x) == 1 and x[0] in MAIN for x in named) and name in ("div", "section", "td")
        article = above.article or main
        zone = above.zone
        if m[3] and UNSEEN.search(m[3]):
            zone = Zone(zone, unseen=True)
        elif name not in ("html", "body", "main", "article"):
            words = surrounds(named, article)
            if words or (name in SURROUND and not (name == "header" and article)):
                zone = Zone(zone, firm=bool(words & TALK) or name in FIRM, unseen=zone is not None and zone.unseen)
        if zone is not above.zone:
            zones.append(zone)
        if zone is not None and (name in ("article", "main") or (name == "h1" and not titled)):
            zone.wraps = True
        titled = titled or name == "h1"
        stack.append(Element(name, above.gone or name in DROPPED, article, zone))
        open_now[name] += 1
        link += name == "a"
        heading = heading or (name[0] == "h" and name[1:].isdigit())
        block.article, block.heading = article, heading
        if name not in INLINE:
            block.zone = zone
    close()
    return out, zones


def lowered(blocks: list[Block], zones: list[Zone], firm: bool) -> list[bool]:
    """Which blocks stand in an element that surrounds the text.

    One that holds most of the page's text does not; a firm one, if `firm` is set, only if it holds an
    article or the page's title.
    """
    for z in zones:
        z.size = 0
    whole = 0
    for b in blocks:
        size = len(b.text) - min(b.linked, len(b.text))
        if b.zone is None:
            whole += size
        elif not b.zone.unseen:
            whole += size
            b.zone.size += size
    for z in reversed(zones):  # inner ones first
        if z.above is not None:
            z.above.size += z.size
            z.above.wraps = z.above.wraps or z.wraps
    for z in zones:
        z.low = z.unseen or (z.above is not None and z.above.low) or not (2 * z.size > whole and (z.wraps or not (firm and z.firm)))
    return [b.zone is not None and b.zone.low for b in blocks]


def density(words: list[str]) -> float:
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(b: Block, around: bool, known: bool) -> int:
    """A block's label on its own; known: the page's language has known stop words."""
    n = len(b.text)
    links = b.linked / max(1, n)
    if around or links > LINKS:
        return BAD
    long, high, low = INSIDE if b.article else (LONG, STOP_HIGH, STOP_LOW)
    dense, latin = len(DENSE.findall(b.text)), len(LATIN.findall(b.text))
    letters = sum(map(len, words := WORD.findall(b.text.lower())))
    if 2 * dense > letters:
        long = LONG_DENSE
    if b.heading or n < min(SHORT, long):
        return OPEN
    if known and 2 * latin > letters:
        stop = density(words)
    else:
        # Sentences speak for a text as stop words would.
        stop = high if SENTENCE.search(b.text) and links <= SOME_LINKS else (high + low) / 2
    if stop >= high:
        return GOOD if n >= long else NEAR
    if n >= long and stop < low:
        return BAD
    return OPEN if links <= SOME_LINKS else BAD


def labelled(blocks: list[Block], zones: list[Zone]) -> list[int]:
    """Both passes. What readers wrote, navigation and the like are around a text only if there is good text outside of them."""
    for firm in (True, False):
        around = lowered(blocks, zones, firm)
        words = [w for b, x in zip(blocks, around, strict=True) if not x for w in WORD.findall(b.text.lower())]
        known = density(words) >= UNKNOWN
        labels = [first_pass(b, x, known) for b, x in zip(blocks, around, strict=True)]
        if GOOD in labels:
            break
    if GOOD not in labels:
        # Nothing is long enough to be sure of: all that is not bad is the text.
        return [x if x == BAD else GOOD for x in labels]
    decided = {side: [k for k, x in enumerate(labels) if x in (GOOD, BAD) and not around[k] and blocks[k].article == side] for side in (True, False)}
    every = sorted(decided[True] + decided[False])
    final = list(labels)
    for k, x in enumerate(labels):
        if x in (GOOD, BAD):
            continue
        b = blocks[k]
        if b.heading:
            after = bisect_left(every, k)
            if after < len(every):
                final[k] = GOOD if b.article else labels[every[after]]
                continue
        own = decided[b.article]
        place = bisect_left(own, k)
        sides = own[max(0, place - 1) : place + 1]
        if b.article and not any(labels[d] == GOOD for d in own):
            final[k] = GOOD
        elif not sides:
            final[k] = BAD  # all the text stands on the other side of the border
        else:
            best = min(abs(d - k) for d in sides)
            near = {labels[d] for d in sides if abs(d - k) == best}
            final[k] = near.pop() if len(near) == 1 else (GOOD if b.article else BAD)
            # What is near good needs one good side; so does a short line of an article.
            if (b.article or x == NEAR) and any(labels[d] == GOOD for d in sides):
                final[k] = GOOD
    return final


def main_text(html: str) -> str:
    """The blocks that are part of the page's text, in order, with an empty line between them."""
    blocks, zones = blocks_of(html)
    final = labelled(blocks, zones)
    return "\n\n".join(b.text for b, x in zip(blocks, final, strict=True) if x == GOOD)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars (code points of text).

    A null or empty page, or one without text, has an empty text. No class name, id or element decides
    alone (an element that readers' comments, navigation and the like stand in is left out only if there is
    good text outside); a page may have its text anywhere. Pages may be of any length; broken
    markup is read as far as it goes, an unfinished tag at the end is left out. Repeated rows are
    extracted each for itself; an empty table gives an empty result; other columns are not looked at.
    """

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = batch.pop("h").map(main_text)
            yield batch

    rows = small_batches(pages).select(F.col(id_col).alias("page_id"), F.col("url").cast("string").alias("url"), body(html_col).alias("h"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInPandas(texts, f"page_id {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    return extract(table(spark, sf_dir, "pages"))
