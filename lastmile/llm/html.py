"""Main text of web pages: site templates go, the article stays.

Every page is parsed to elements once. Each container element, and outside the article each
block of prose, gets a hash of its whole subtree (names, classes, text). Spark counts the
hashes per host over pages of different content; subtrees that recur on ``min_pages`` pages
or more of a host are its template and are deleted. Page furniture that differs from page to
page (menus, headers, footers, adverts, forms and so on) can't recur, so it is told by
element name, role, and words of class and id. Such words don't count on an element that holds
most of the page's prose (see ``_weigh``), so a wrapper or an article with such a class stays.

Of what is left, the article elements are the text if they hold half of the words outside links
or more, or else ``main`` if it does, or else the whole body.

Inside an article that is the text, prose (paragraphs, headings, quotations, lists, tables, and
containers with a paragraph or another run of text of 25 words or more, whatever inline elements
it is in) is never template, so passages that many pages share stay. If the body is the text,
articles in it (cards, teasers) and their prose may be template like all else.

Hot hosts: occurrences are dealt by (host, hash) with partial counts, and meet the templates
dealt over ``SALTS`` copies, so a host with a third of all pages is spread.

Defined results: null, empty or tag-free html gives its own text or none ('' and 0
characters); unclosed elements end with their parents; a broken tag at the end is dropped; a
page without host belongs to the host ''. Repeated pages count once and give equal rows; an
empty table gives none; other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, others, written

SALTS = 16
LONG_PROSE = 25  # words

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
CONTAINER = set("aside center details dir div dl fieldset figure footer form header menu nav ol section table ul".split())
#: Lists and tables of an article are its text, like paragraphs.
IN_ARTICLE = CONTAINER - {"ul", "ol", "dl", "table"}
PROSE = set("blockquote h1 h2 h3 h4 h5 h6 p pre li dd dt td th figcaption caption address".split())
#: Elements that are never part of an article's text.
FURNITURE = set(
    "script style noscript template head title nav footer aside button select option input textarea iframe svg object canvas "
    "dialog menu noembed noframes audio video map datalist xmp".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
#: Words of class or id that tell furniture.
FURNITURE_WORDS = set(
    "ad ads adv adbox adslot adunit adbanner advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr cookiebar cookiebanner notice notices popup modal overlay newsletter subscribe subscription signup social share sharing related recommended "
    "recommendations sidebar nav navbar topnav subnav sidenav navigation menu breadcrumb breadcrumbs pagination pager footer comment comments commentlist disqus reply "
    "replies respond widget toolbar copyright disclaimer login search skip masthead".split()
)
#: Elements that are text themselves: within an article, only EXTRA_WORDS tell them apart.
TEXTS = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
#: Words of FURNITURE_WORDS that tell comments, adverts and cookie boxes, however long these are.
EXTRA_WORDS = set(
    "comment comments commentlist disqus reply replies respond ad ads adv adbox adslot adunit adbanner advert adverts advertisement advertising adsense "
    "adsbygoogle sponsor sponsored promo promotion cookie cookies consent gdpr cookiebar cookiebanner newsletter".split()
)
#: A class or id that begins so ("has-sidebar", "no-ads") tells how a page is laid out, not what an element is.
STATES = set("has no not with without".split())
#: And those that do so outside an article only.
OUTSIDE_WORDS = set("header topbar".split())
#: An open element of the key is ended by the start of one of the values.
_P_ENDS = BLOCK - {"br", "option", "title", "head", "html", "body"}
ENDED_BY = {
    "p": _P_ENDS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"}, "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "tr": {"tr", "tbody", "tfoot", "thead"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
#: Elements past which an implied end doesn't look.
SCOPE = set("article aside body div footer form header html main nav ol section table td th ul dl blockquote figure".split())


@dataclass
class Element:
    name: str
    parent: Element | None
    key: str  # name, classes and id, for the hash
    words: set[str] = field(default_factory=set)  # of class and id
    hard: bool = False  # furniture by name or role, or inside such
    veil: bool = False  # a form, or hidden: furniture unless the page's words are in it
    veiled: bool = False  # that, or inside such
    extra: bool = False  # comments or adverts by class or id, or inside such
    suspect: bool = False  # any furniture by class or id, or inside such
    centre: bool = False  # article or main, or inside such
    linked: bool = False
    main: bool = False
    furniture: bool = False
    article: bool = False  # an article or inside one
    marks: list[str] = field(default_factory=list)  # texts and children's hashes
    longest: int = 0  # words of the longest paragraph or run of text inside
    amounts: list[int] = field(default_factory=lambda: [0] * 6)  # see _amounts
    hash: int = 0


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip(" /\t\n\r\f") else {}


def _opened(name: str, attributes: dict[str, str], up: Element) -> Element:
    e = Element(name, up, name, hard=up.hard or name in FURNITURE, veil=name == "form", extra=up.extra, suspect=up.suspect, centre=up.centre or name in ("article", "main"), linked=up.linked or name == "a", main=up.main or name == "main")
    if attributes:
        label = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
        e.key = f"{name} {label}"
        for token in label.split():
            words = _WORD.findall(token)
            if words and words[0] not in STATES:
                e.words.update(words)
        role = attributes.get("role", "").lower()
        e.hard = e.hard or role in ROLES
        e.veil = (
            e.veil or role == "form" or "hidden" in attributes or attributes.get("aria-hidden") == "true"
            or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        )
        e.extra = e.extra or bool(e.words & EXTRA_WORDS)
        e.suspect = e.suspect or bool(e.words & FURNITURE_WORDS)
        e.main, e.centre = e.main or role == "main", e.centre or role == "main"
    e.veiled = up.veiled or e.veil
    return e


def _amounts(elements: list[Element], pieces: list[tuple[str, Element]], veiled: bool) -> list[int]:
    """Sets every element's ``longest`` and ``amounts``, and returns those of the page.

    Amounts are words in long paragraphs outside comments and adverts, words of article and
    main outside these, words in any long paragraphs, words not in furniture, words, and words
    in links. Hard furniture counts nothing, nor does what is veiled unless ``veiled``.
    """
    root, n, held = elements[0], 0, []
    for e in elements:
        e.amounts = [0] * 6
    for text, e in [*pieces, (None, elements[0])]:
        if text is None:
            if e.name == "br" or not held:
                continue
            for of, words in held:
                of.longest = max(of.longest, n)
                if not of.hard and (veiled or not of.veiled):
                    long = words if n >= LONG_PROSE else 0
                    for k, amount in enumerate((long * (not of.extra), words * (of.centre and not of.extra), long, words * (not of.suspect), words, words * of.linked)):
                        of.amounts[k] += amount
            n, held = 0, []
        elif not text.isspace():
            words = len(text.split())
            n += words
            held.append((e, words))
    for e in reversed(elements[1:]):
        up = e.parent
        up.longest = max(up.longest, e.longest)
        for k, amount in enumerate(e.amounts):
            up.amounts[k] += amount
    return root.amounts


def _weigh(elements: list[Element], pieces: list[tuple[str, Element]]) -> None:
    """Sets what depends on whole subtrees: the longest run of words, furniture, article, main.

    Furniture words of class and id don't count on an element that holds more than half of the
    page's prose, that is, of the first kind of ``_amounts`` that the page has. Within an
    article, words that tell neither comments nor adverts count only for containers without
    prose: not for headings and paragraphs, nor where a long paragraph stands and most words
    are outside links.

    Forms and hidden elements are furniture. But if not a tenth of the page's words stands
    outside them (a form around the whole page, a body shown by a script), they are it only
    where they don't hold more than half of the prose.
    """
    root = elements[0]
    every = _amounts(elements, pieces, True)[4] if any(e.veil for e in elements) else 0
    within = 10 * _amounts(elements, pieces, False)[4] < every
    if within:
        _amounts(elements, pieces, True)
    kind = next((k for k, amount in enumerate(root.amounts[:5]) if amount), 4)
    for e in elements[1:]:
        up = e.parent
        inside = up.article or e.name == "article"
        named = e.name not in ("html", "body") and bool(e.words & FURNITURE_WORDS or not inside and e.words & OUTSIDE_WORDS)
        if named and up.article and not e.words & EXTRA_WORDS:
            named = e.name not in TEXTS and (e.longest < LONG_PROSE or 2 * e.amounts[5] >= e.amounts[4])
        little = 2 * e.amounts[kind] <= root.amounts[kind]
        hidden = e.veil and little if within else e.veiled
        e.furniture = up.furniture or e.hard or hidden or e.name == "header" and not inside or named and little
        e.article = inside and not e.furniture
        e.main = e.main and not e.furniture


def parse(html: str) -> list[tuple[str, Element]]:
    """The texts of a page in order, each with its element; ``None`` texts end blocks."""
    root = Element("", None, "")
    stack, pieces, elements = [root], [], [root]
    at, end = 0, len(html)

    def say(text: str) -> None:
        if text:
            text = unescape(text)
            pieces.append((text, stack[-1]))
            if not text.isspace():
                stack[-1].marks.append(" ".join(text.split()))

    def close() -> None:
        e = stack.pop()
        e.hash = xxhash.xxh64_intdigest("\x01".join([e.key, *e.marks])) >> 1
        stack[-1].marks.append(f"\x02{e.hash}")
        if e.name in PROSE:
            e.longest = max(e.longest, sum(len(m.split()) for m in e.marks if m[0] != "\x02"))
        if e.name in BLOCK:
            pieces.append((None, e))

    while at < end:
        m = _TAG.search(html, at)
        if not m:
            say(html[at:])
            break
        say(html[at : m.start()])
        at = m.end()
        ending, name, inner = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if ending:
            if any(e.name == name for e in stack[1:]):
                while stack[-1].name != name:
                    close()
                close()
            elif name in ("p", "br"):
                pieces.append((None, stack[-1]))
            continue
        for k in range(len(stack) - 1, 0, -1):
            if name in ENDED_BY.get(stack[k].name, ()):
                while len(stack) > k:
                    close()
                break
            if stack[k].name in SCOPE:
                break
        e = _opened(name, _attributes(inner), stack[-1])
        if name in BLOCK:
            pieces.append((None, e))
        if name in VOID or inner.endswith("/") and name not in BLOCK:
            if name not in BLOCK:
                stack[-1].marks.append(f"<{name}>")
            continue
        stack.append(e)
        elements.append(e)
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(html, at)
            e.marks.append(html[at : stop.start() if stop else end])
            at = stop.end() if stop else end
            close()
    while len(stack) > 1:
        close()
    _weigh(elements, pieces)
    return pieces


@dataclass
class Block:
    """Text with the hashes of what may be template around it.

    ``hashes`` are those that count if the article is the text, ``more`` those that count
    besides if the text is taken from the whole body.
    """

    text: str
    hashes: list[int]
    more: list[int]
    article: bool
    main: bool
    prose: int  # words outside links


def _around(e: Element) -> tuple[list[int], list[int]]:
    """``hashes`` and ``more`` of a block with text of ``e``."""
    hashes, more, up, inner = [], [], e, e.article
    while up is not None and up.name not in ("main", "body", "html", ""):
        if up.name == "article" and not e.article:
            break
        inner = inner and up.name != "article"
        if up.name in IN_ARTICLE and up.longest < LONG_PROSE if up.article else up.name in CONTAINER or up.name in PROSE:
            (hashes if inner or not e.article else more).append(up.hash)
        elif up.name in CONTAINER or up.name in PROSE or up.name == "article":
            more.append(up.hash)
        up = up.parent
    return hashes, more


def _selected(found: list[Block]) -> list[Block]:
    """What of the blocks left is the text: the article or main if it holds half of the prose."""
    total = sum(b.prose for b in found)
    for part in ([b for b in found if b.article], [b for b in found if b.main]):
        if part and 2 * sum(b.prose for b in part) >= total:
            return part
    return found


def page_blocks(html: str) -> tuple[list[Block], list[int]]:
    """The blocks that may be the page's text, and the page's hashes.

    Where the article holds half of the prose whatever is deleted, its blocks are the only ones.
    """
    pieces = parse(html)
    out: list[Block] = []
    hashes: dict[int, None] = {}
    beyond: dict[int, None] = {}
    held: list[str] = []
    at: Block | None = None

    def flush() -> None:
        nonlocal at
        text = " ".join("".join(held).split())
        if text:
            last = out[-1] if out else None
            if last and (last.hashes, last.more, last.article, last.main) == (at.hashes, at.more, at.article, at.main):
                last.text, last.prose = f"{last.text} {text}", last.prose + at.prose
            else:
                at.text = text
                out.append(at)
        held.clear()
        if at:
            at = Block("", at.hashes, at.more, at.article, at.main, 0)

    chains: dict[int, tuple[list[int], list[int]]] = {}
    for text, e in pieces:
        if text is None:
            flush()
            continue
        if id(e) not in chains:
            chains[id(e)] = _around(e)
        own, more = chains[id(e)]
        if not text.isspace():
            hashes.update(dict.fromkeys(own))
            beyond.update(dict.fromkeys(more))
        if e.furniture:
            continue
        if at is None or (own, more, e.article, e.main) != (at.hashes, at.more, at.article, at.main):
            flush()
            at = Block("", own, more, e.article, e.main, 0)
        held.append(text)
        at.prose += 0 if e.linked else len(text.split())
    flush()
    inside = [b for b in out if b.article]
    if any(not b.hashes for b in inside) and sum(b.prose for b in inside if not b.hashes) >= sum(b.prose for b in out if not b.article):
        out = [replace(b, more=[]) for b in inside]
    else:
        hashes.update(beyond)
    return out, list(hashes)


def blocks(html: str) -> tuple[list[tuple[str, list[int]]], list[int]]:
    """The text's blocks if nothing is template, each with the hashes of elements around it, and the page's hashes."""
    found, hashes = page_blocks(html)
    return [(b.text, b.hashes) for b in _selected(found)], hashes


PARSED = "blocks array<struct<text: string, hashes: array<long>, more: array<long>, article: boolean, main: boolean, prose: long>>, hashes array<long>, content long"


def _parsed(pages: pd.Series) -> pd.DataFrame:
    out = []
    for html in pages:
        found, hashes = page_blocks(html or "")
        content = xxhash.xxh64_intdigest("\x01".join(b.text for b in _selected(found))) >> 1
        out.append(([vars(b) for b in found], hashes, content))
    return pd.DataFrame(out, columns=["blocks", "hashes", "content"])


def main_text(pages: DataFrame, min_pages: int = 10, html_col: str = "html", url_col: str = "url", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``pages`` without ``html_col``, with the main text of each and its code points."""
    key, host, found, gone, left = (fresh(pages, c) for c in ("page_key", "page_host", "page_found", "page_gone", "page_left"))
    kept = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_col.lower(), chars_col.lower())]
    parsed = pages.select(
        *others(pages, html_col, text_col, chars_col),
        F.xxhash64(pages[url_col], pages[html_col]).alias(key),
        F.lower(F.coalesce(F.regexp_extract(pages[url_col], r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1), F.lit(""))).alias(host),
        F.pandas_udf(_parsed, PARSED)(F.coalesce(pages[html_col], F.lit(""))).alias(found),
    )
    parsed = written(parsed, "pages")
    occurrences = parsed.select(F.col(key).alias("page"), F.col(host).alias("host"), F.col(found)["content"].alias("content"), F.explode(F.col(found)["hashes"]).alias("hash"))
    template = (
        occurrences.groupBy("host", "hash", "content").agg(F.lit(1).alias("one"))
        .groupBy("host", "hash").agg(F.count("one").alias("n")).filter(F.col("n") >= min_pages)
        .select("host", "hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    # only pages with deletable elements around their own text have to meet the templates
    exposed = F.exists(F.col(found)["blocks"], lambda b: (F.size(b["hashes"]) > 0) | (F.size(b["more"]) > 0))
    around = F.array_distinct(F.flatten(F.transform(F.col(found)["blocks"], lambda b: F.concat(b["hashes"], b["more"]))))
    deleted = (
        parsed.filter(exposed).select(F.col(key).alias("page"), F.col(host).alias("host"), F.explode(around).alias("hash"))
        .withColumn("salt", F.pmod("page", F.lit(SALTS)).cast("int"))
        .join(template, ["host", "hash", "salt"])
        .groupBy("page").agg(F.collect_set("hash").alias("gone"))
        .select(F.col("page").alias(key), F.col("gone").alias(gone))
    )

    every, none = F.col(found)["blocks"], F.array().cast("array<bigint>")

    def prose(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda n, b: n + b["prose"])

    def finished(rows: DataFrame, hit: Column) -> DataFrame:
        """The same choice as ``_selected`` from what is left without the templates ``hit``."""
        rows = rows.select(*(F.col(f"`{c}`") for c in kept), hit.alias(gone), F.filter(every, lambda b: ~F.arrays_overlap(b["hashes"], hit)).alias(left))
        article, main = F.filter(left, lambda b: b["article"]), F.filter(left, lambda b: b["main"])
        chosen = (
            F.when((F.size(article) > 0) & (2 * prose(article) >= prose(F.col(left))), article)
            .when((F.size(main) > 0) & (2 * prose(main) >= prose(F.col(left))), main)
            .otherwise(F.filter(left, lambda b: ~F.arrays_overlap(b["more"], F.col(gone))))
        )
        text = F.array_join(F.transform(chosen, lambda b: b["text"]), " ")
        return rows.select(*(F.col(f"`{c}`") for c in kept), text.alias(text_col)).withColumn(chars_col, F.char_length(text_col).cast("long"))

    return finished(parsed.filter(~exposed), none).union(finished(parsed.filter(exposed).join(deleted, key, "left"), F.coalesce(F.col(gone), none)))
