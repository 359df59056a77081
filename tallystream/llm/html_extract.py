"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of its block elements from the root.
Text length and punctuation are summed per path and divided by the path's blocks; the two
ratios are smoothed along the page, fused by their geometric mean, and paths above a share of
the page's mean are content. The content root is the smallest element that holds nearly all
text of content paths; an article or main element that holds most of it is preferred. All
remaining blocks inside the root are the text.
Menus, page headers, footers, sidebars, notices, adverts, forms, comments and the like are
left out by element, role, class or id before ratios are taken. Parts of a class or id are a
weak sign ("has-sidebar", "no-ads"): an element stays in spite of them if it holds the page's
article or main element, or most of the content text of the page (inside an article or main:
of that). Where an article or main is elsewhere, or the name is one of a discussion, it must
hold nearly all.

Rows: a null or empty page, or one without content, has an empty text; repeated rows are
extracted each; markup may be unclosed or cut off; other columns are not read; an empty table
gives an empty result. Pages are whole: nothing is cut or capped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallystream.llm.words import in_arrow

THRESHOLD = 0.3  # of the mean fused ratio of a page
COVERAGE = 0.9  # of content text that the root must hold
SMOOTHING = (0.25, 0.5, 0.25)

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|math|textarea|select|iframe|object|canvas|title|button|datalist|audio|video"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot"
    " th thead tr ul".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPES = frozenset("ul ol dl table body html article main section div".split())
# Parts of a page that are not its article.
LEFT_OUT = frozenset("nav footer aside form menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar status".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments commentlist consent"
    " cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification notifications outbrain pager pagination paywall popup promo promotion recommended related replies reply"
    " respond share sharebar sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar widget widgets".split()
)
DISCUSSION = frozenset("comment comments commentlist disqus replies reply respond".split())
ARTICLES = frozenset(("article", "main"))

_TOKEN = re.compile(
    rf"<!--(?:.*?-->|.*)|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>(?:.*?</\1\s*>|.*)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*(?:>|$)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，؟¿¡]")


class _Element:
    __slots__ = ("tag", "parent", "left_out", "path", "article", "held", "names", "named", "stays", "mass", "talk")

    def __init__(self, tag: str, parent: _Element | None, left_out: bool, names: frozenset[str] | set[str] = frozenset()) -> None:
        self.tag, self.parent, self.left_out, self.names = tag, parent, left_out, names
        # The innermost element, this or one around it, whose names speak against it.
        self.named: _Element | None = self if names and tag not in ARTICLES else parent.named if parent else None
        self.stays = True
        self.mass = self.talk = 0  # content text below, and that of it in discussions
        self.article = (parent is not None and parent.article) or tag in ARTICLES
        above = parent.path if parent else ""
        self.path = f"{above}/{tag}" if tag in BLOCK else above
        self.held = 0.0


def _left_out(tag: str, attributes: str, inside_article: bool) -> tuple[bool, set[str]]:
    """Is the element left out for certain; and those parts of its names that speak against it."""
    against: set[str] = set()
    if tag in LEFT_OUT or tag == "header" and not inside_article:
        return True, against
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return True, against
        if name in ("class", "id") and tag not in ("body", "html"):
            words = set(_SPLIT.split(value))
            against |= words & NAMES
            if "header" in words and not inside_article:
                against.add("header")
    return False, against


_Pieces = list[tuple[str, _Element | None]]


def _joined(pieces: _Pieces) -> str:
    return " ".join("".join([p for p, named in pieces if named is None or named.stays]).split())


def _all_blocks(page: str) -> list[tuple[_Element, _Pieces]]:
    """(element, pieces) of every block that is not left out for certain, in page order; a piece
    of text comes with the innermost element around it whose names speak against it."""
    out: list[tuple[_Element, _Pieces]] = []
    root = _Element("html", None, False)
    stack, at = [root], 0
    buffer: _Pieces = []

    def flush() -> None:
        if buffer:
            if any(not p.isspace() for p, _ in buffer):
                top = stack[-1]
                while top.parent is not None and top.tag not in BLOCK:
                    top = top.parent
                out.append((top, buffer.copy()))
            buffer.clear()

    def close(tags: tuple[str, ...], scopes: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                flush()
                del stack[i:]
                return
            if stack[i].tag in scopes:
                return

    def text_until(stop: int) -> None:
        if stop > at and not stack[-1].left_out:
            piece = page[at:stop]
            buffer.append((html.unescape(piece) if "&" in piece else piece, stack[-1].named))

    for token in _TOKEN.finditer(page):
        text_until(token.start())
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in VOID:
            if tag == "br" and not stack[-1].left_out:
                buffer.append((" ", stack[-1].named))
            elif tag == "hr":
                flush()
            continue
        if token[2]:
            if any(e.tag == tag for e in stack[1:]):
                if tag in BLOCK:
                    close((tag,))
                else:  # an inline end tag doesn't end blocks
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == tag:
                            del stack[i]
                            break
                        if stack[i].tag in BLOCK:
                            break
            elif tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            flush()
            close(("p",), SCOPES)
            if tag in CLOSES:
                while len(stack) > 1 and stack[-1].tag not in SCOPES and any(e.tag in CLOSES[tag] for e in stack[1:]):
                    stack.pop()
        if tag in ("html",):
            continue
        parent = stack[-1]
        if not token[4].rstrip().endswith("/") or tag in BLOCK:
            gone, names = (True, set()) if parent.left_out or tag == "head" else _left_out(tag, token[4], parent.article)
            stack.append(_Element(tag, parent, gone, names))
    text_until(len(page))
    flush()
    return out


def _above(e: _Element | None) -> Iterator[_Element]:
    while e is not None:
        yield e
        e = e.parent


def _judge_names(found: list[tuple[_Element, _Pieces]]) -> None:
    """Decide for every element with names against it whether it ``stays``."""
    texts = [(e, _joined(pieces)) for e, pieces in found]
    content = _content_paths([(e, t) for e, t in texts if t])
    named: dict[_Element, None] = {}  # outer ones first
    holders: dict[_Element, None] = {}
    for element, pieces in found:
        counts, above = element.path in content, set(_above(element))
        for piece, n in pieces:
            size = len(piece.strip()) if counts else 0
            around = [e for e in _above(n) if e.named is e]
            talk = any(e.names & DISCUSSION for e in around)
            for e in reversed(around):
                named.setdefault(e)
            for e in _above(element if n is None or n in above else n):
                e.mass += size
                e.talk += size if talk else 0
        for e in _above(element):
            if e.tag in ARTICLES:
                holders.setdefault(e)
    page = next(e for e in _above(found[0][0]) if e.parent is None)
    # The page's article and main: the largest; one that is itself named an advert or a comment
    # only where there is no other.
    own = [e for e in holders if e.mass and not e.names] or [e for e in holders if e.mass]
    chosen = [max((e for e in own if e.tag == tag), key=lambda e: e.mass, default=None) for tag in ("article", "main")]
    chosen = [e for e in chosen if e is not None]
    holding = {e for c in chosen for e in _above(c.parent)}
    for e in named:
        around = next((a for a in _above(e.parent) if a in chosen), None)
        scope, talks = around or page, bool(e.names & DISCUSSION)
        if talks:
            stays = e.mass >= COVERAGE * scope.mass > 0 or e in holding and 2 * max(c.mass for c in chosen if e in _above(c)) > scope.mass
        else:
            share, whole = e.mass - e.talk, scope.mass - scope.talk
            stays = e in holding or (2 * share > whole if around or not chosen else share >= COVERAGE * whole > 0)
        outer = e.parent.named if e.parent else None
        e.stays = stays and (outer is None or outer.stays)


def blocks(page: str) -> list[tuple[_Element, str]]:
    """(element, text) of every block that is not left out, in page order."""
    found = _all_blocks(page)
    if any(n is not None for _, pieces in found for _, n in pieces):
        _judge_names(found)
    return [(e, text) for e, pieces in found if (text := _joined(pieces))]


def _content_paths(found: list[tuple[_Element, str]]) -> set[str]:
    """Paths whose smoothed, fused ratio reaches the threshold."""
    paths = [e.path for e, _ in found]
    length: dict[str, int] = {}
    marks: dict[str, int] = {}
    count: dict[str, int] = {}
    for path, (_, text) in zip(paths, found):
        length[path] = length.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(_PUNCTUATION.findall(text))
        count[path] = count.get(path, 0) + 1

    def smooth(ratio: dict[str, float]) -> np.ndarray:
        series = np.array([ratio[p] for p in paths])
        wide = np.concatenate([series[:1], series, series[-1:]])
        return sum(w * wide[i : i + len(series)] for i, w in enumerate(SMOOTHING))

    text_ratio = smooth({p: length[p] / count[p] for p in count})
    mark_ratio = smooth({p: (marks[p] + 1) / count[p] for p in count})
    fused = np.sqrt(text_ratio * mark_ratio)
    sums: dict[str, float] = {}
    for path, value in zip(paths, fused.tolist()):
        sums[path] = sums.get(path, 0.0) + value
    limit = THRESHOLD * float(fused.mean())
    return {p for p, s in sums.items() if s / count[p] >= limit}


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    content = _content_paths(found)
    total = 0
    for element, text in found:
        if element.path in content:
            total += len(text)
            for e in _above(element):
                e.held += len(text)
    root, best = None, None
    for element, _ in found:
        for e in _above(element):
            if e.held >= COVERAGE * total and (root is None or e.held < root.held):
                root = e
            if e.tag in ARTICLES and 2 * e.held >= total and (best is None or e.held > best.held):
                best = e
    root = best or root
    return "\n\n".join(text for e, text in found if any(a is root for a in _above(e)))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url and text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x) for x in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html")).transform(
        in_arrow, run, f"page_id {kinds[0]}, url {kinds[1]}, text string"
    )
