"""Main text of web pages by the distribution of text over lines.

Markup is stripped, which leaves one line for each block. The text lengths of every three
lines in a row are summed. Where the sums surge the article begins, where they dive to
nothing it ends, and what lies between is kept. Lines that markup itself calls something
else (menus, footers, forms, adverts, comments and so on) have no length, nor has link
text. What markup calls the article is measured like all else. Only where it holds at least
half of the page's text does it weigh more: then its links count as text, and a side note
within is no dive. Nor does any article end where the element goes on that directly holds
its lines, such as a ``div``: what follows a side note or a list of links there is kept.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import beside, over_slices

#: Lines of a window, and the sum of their lengths that counts as a surge.
WINDOW, SURGE = 3, 86

# Names that HTML fixes.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol"
    " p pre section summary table tbody tfoot thead title tr ul".split()
)
SPACES = frozenset(("br", "td", "th", "wbr"))
RAW = frozenset("script style noscript template iframe object svg math canvas textarea select".split())
#: Of these, the ones that a slash closes at once, and the ones that run to the page's end if unclosed.
FOREIGN, TO_THE_END = frozenset(("svg", "math")), frozenset(("script", "style", "textarea"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
OTHER = frozenset("nav aside footer form head menu dialog button".split())
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu".split()
)
#: Elements that hold parts of a page. Text that goes on in the one where the article is belongs to it.
HOLDERS = frozenset("div section article main dd form details blockquote".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

#: Words in a class or id, at their beginnings, that say that an element isn't the article.
SIDE_WORDS = (
    "advert breadcrumb comment consent contentinfo cookie copyright disclaimer disqus footer gdpr"
    " login masthead menu modal navbar navigation newsletter notice pagination popup promo recommend"
    " related replies reply respond sharing sidebar signup skip social sponsor subscribe topbar"
    " toolbar widget"
).split()
#: The same as whole words only.
SIDE_NAMES = frozenset(
    "ad ads advertisement aside banner banners alert alerts form forms header nav pager search share"
    " teaser tags".split()
)
NOT_SIDE = frozenset(("has", "with", "no", "without", "main", "content", "article", "body"))

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^<>\"']*)>")
_QUOTED_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([\w-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_RIGHTS = re.compile(r"(?:©|copyright\b|\(c\) ?[0-9]{4}|all rights reserved)", re.IGNORECASE)


@dataclass
class Line:
    text: str
    length: int  # without link text; none in what isn't the article
    side: bool  # markup says that it isn't the article
    article: bool  # markup says that it is, or that it's a side note of one
    main: bool  # the same, or markup only says that the page's main part is around it
    holder: int  # the innermost element around it that holds a part of the page, 0 if there is none


def _is_side(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element's tag or attributes call it something beside the article."""
    if name in OTHER:
        return True
    if name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    values = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    if values.get("role", "").lower() in OTHER_ROLES or "hidden" in values:
        return True
    if values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", ""):
        return True
    for label in f"{values.get('class', '')} {values.get('id', '')}".split():
        parts = [p.lower() for p in _NAME_PART.findall(label)]
        if NOT_SIDE.intersection(parts):
            continue
        if in_article and "header" in parts:
            continue
        if SIDE_NAMES.intersection(parts) or any(p.startswith(w) for p in parts for w in SIDE_WORDS):
            return True
    return False


def _pieces(page: str):
    """The page's texts as ``(None, text, "")`` and its tags as ``(name, attributes, slash)``."""
    at, quoted, n = 0, True, len(page)
    unclosed: set[str] = set()
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield None, page[at:], ""
            return
        if lt > at:
            yield None, page[at:lt], ""
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, lt)
        if tag is None and quoted:
            tag = _QUOTED_TAG.match(page, lt)
            quoted = tag is not None or not page[lt + 1 : lt + 2].isalpha()
        if tag is None:
            tag = _LOOSE_TAG.match(page, lt)
        if tag is None:  # not a tag: a sign in the text
            yield None, "<", ""
            at = lt + 1
            continue
        slash, name, attributes = tag[1], tag[2].lower(), tag[3]
        at = tag.end()
        if name in RAW and not slash:
            if name in FOREIGN and attributes.endswith("/"):
                continue
            close = None
            if name not in unclosed:
                close = re.compile(f"</{name}[^>]*>", re.IGNORECASE).search(page, at)
            if close is not None:
                at = close.end()
            elif name in TO_THE_END:
                at = n
            else:
                unclosed.add(name)  # no later tag closes it either
            continue
        yield name, attributes, slash


def page_lines(page: str) -> list[Line]:
    """One line for each block with text, in page order; boundaries of sections are empty."""
    lines: list[Line] = []
    open_tags: list[tuple[str, bool, bool, int]] = []  # name, and as of the innermost: side, article, holder
    holders = 0
    text: list[str] = []
    linked = 0
    links = 0
    heading = False

    def close_line() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            _, side, article, holder = open_tags[-1] if open_tags else ("", False, False, 0)
            in_header = any(t[0] == "header" for t in open_tags)
            side = side or (in_header and article and not heading)
            side = side or (not article and _RIGHTS.match(joined) is not None)
            length = 0 if side else max(0, len(joined) - linked)
            inside = any(t[0] == "article" and t[2] and not t[1] for t in open_tags)
            lines.append(Line(joined, length, side, inside, article, holder))
        text.clear()
        linked = 0

    for name, attributes, slash in _pieces(page):
        if name is None:
            text.append(attributes)
            if links:
                linked += len(" ".join(attributes.split()))
            continue
        if name == "a":
            links = max(0, links - 1) if slash else 1
            continue
        if name in SPACES:
            text.append(" ")
            continue
        block = name in BLOCKS
        if block:
            close_line()
            links = 0
        if name in VOID or attributes.endswith("/"):
            continue
        if slash:
            if name in HEADINGS:
                heading = False
            names = [t[0] for t in open_tags]
            if name in names:
                last = len(names) - 1 - names[::-1].index(name)
                if not block:  # an inline tag doesn't close blocks around it
                    if all(n not in BLOCKS for n in names[last + 1 :]):
                        del open_tags[last:]
                    continue
                del open_tags[last:]
            continue
        if name in HEADINGS:
            heading = True
        if block and open_tags and open_tags[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            open_tags.pop()
        if name == "li" and open_tags and open_tags[-1][0] == "li":
            open_tags.pop()
        _, side, article, holder = open_tags[-1] if open_tags else ("", False, False, 0)
        own = _is_side(name, attributes, article)
        if not block and not own:
            continue
        if not block:
            close_line()
        if name in ("article", "main") and not own and not any(t[2] for t in open_tags):
            side = any(t[0] in OTHER for t in open_tags)
            article = not side
        if name in HOLDERS:
            holders += 1
            holder = holders
        open_tags.append((name, side or own, article, holder))
    close_line()
    return lines


def main_blocks(page: str) -> list[str]:
    """The blocks of the page's main text."""
    lines = page_lines(page)
    total = sum(x.length for x in lines)
    if 2 * sum(x.length for x in lines if x.article) >= total:
        lines = [x for x in lines if not (x.side and x.article)]
        length = [len(x.text) if x.article else x.length for x in lines]
    else:
        length = [x.length for x in lines]
    padded = length + [0] * WINDOW
    sums = [sum(padded[i : i + WINDOW]) for i in range(len(length))]
    keep = [False] * len(lines)
    i = 0
    while i < len(lines):
        if not (sums[i] >= SURGE and length[i]):
            i += 1
            continue
        start = i
        while start and length[start - 1] and not keep[start - 1]:
            start -= 1
        end = i
        while end < len(lines) and sums[end]:
            end += 1
        for j in range(start, end):
            keep[j] = not lines[j].side
        i = max(end, i + 1)
    # A side note or a list of links is no dive where the element that holds the article goes on.
    holders = {x.holder for x, k in zip(lines, keep, strict=True) if k} - {0}
    for j, x in enumerate(lines):
        keep[j] = keep[j] or (x.holder in holders and length[j] > 0 and not x.side)
    if not any(keep):  # no surge: a page of a few short lines, of which markup may tell the main ones
        marked = [bool(n) and x.main for n, x in zip(length, lines, strict=True)]
        share = sum(n for n, k in zip(length, marked, strict=True) if k)
        keep = marked if share and 2 * share >= sum(length) else [bool(n) for n in length]
    return [x.text for x, k in zip(lines, keep, strict=True) if k]


def _extractor():
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = ["\n\n".join(main_blocks(p or "")) for p in batch.column("html").to_pylist()]
        kept = {name: batch.column(name) for name in batch.schema.names if name != "html"}
        return pa.RecordBatch.from_pydict(kept | {"text": pa.array(texts, pa.string())})

    return work


def extract_main_text(pages: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``text``, the main text of ``html``, for every page.

    Blocks are trimmed, their white space is single spaces, character references are
    decoded, and they are joined by an empty line in page order. A null or empty page, and
    one of nothing but markup, gives an empty text. Pages are taken whole and one by one,
    so repeated rows and ties change nothing; an empty table gives an empty result.
    """
    kept = pages.select(*keep, "html")
    return kept.mapInArrow(over_slices(_extractor, "html"), beside(kept, "html", "text string"))
