"""Operator 10: main text of HTML pages, by flat text blocks and a small decision tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import map_column

OPEN = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
INSIDE = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Elements whose content is no text of the page; the first row's run to the end of the page if they aren't closed.
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes".split())
MEDIA = frozenset("svg object audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Kinds of tags: of a page's frame, and of its article. A header is of the frame unless it is inside an article.
FRAME = frozenset("nav footer aside form menu button select dialog fieldset head header".split())
ARTICLE = frozenset(("article", "main"))
#: Kinds of a block, by the innermost element around its text.
KINDS = {t: k for k, tags in {"h": "h1 h2 h3 h4 h5 h6 hgroup", "p": "p blockquote pre dd", "l": "li dt", "t": "td th caption figcaption"}.items() for t in tags.split()}
#: Whole names of classes, ids and roles of block elements that hint at no article text: one feature among others.
HINTS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo sidebar menu navbar navigation breadcrumb breadcrumbs footer "
    "cookie-notice cookies consent notice alert popup modal newsletter signup login share social related comment comments disqus "
    "replies widget toolbar pagination complementary contentinfo".split()
)
#: For "p" and the like, which end with the next of their kind.
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    place: str  # "f" in an element of the frame, else "a" in an article's, else "n"
    kind: str  # one of KINDS, else "d"
    hint: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _names(attributes: str) -> tuple[bool, bool]:
    """Whether the names of an element are hints, and whether it is hidden."""
    hint = hidden = False
    for k, v in ATTRIBUTE.findall(attributes):
        k, v = k.lower(), v.strip("\"'").lower()
        hint = hint or k in ("class", "id", "role") and not HINTS.isdisjoint(v.split())
        hidden = hidden or k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and HIDDEN.search(v) is not None
    return hint, hidden


def tokens(page: str):
    """Texts as ``(text, None, "")`` and tags as ``(closing, name, attributes)``, in one pass over the page.

    A quote or an end tag that was once not found is not looked for again. Comments, declarations and the content of
    elements that hold no text are left out; an element of ``RAW`` comes as its start and end tag.
    """
    at, end = 0, len(page)
    absent: set[str] = set()
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            yield page[at:], None, ""
            return
        if lt > at:
            yield page[at:lt], None, ""
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = end if close < 0 else close + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            close = page.find(">", lt)
            at = end if close < 0 else close + 1
            continue
        m = OPEN.match(page, lt + 1)
        if m is None:
            if lt + 1 < end and page[lt + 1] == "/" and lt + 2 < end:
                close = page.find(">", lt)
                at = end if close < 0 else close + 1
            else:
                yield "<", None, ""
                at = lt + 1
            continue
        spot = m.end()
        while True:
            spot = INSIDE.match(page, spot).end()
            if spot >= end or page[spot] == ">":
                break
            quote = page[spot]
            close = -1 if quote in absent else page.find(quote, spot + 1)
            if close < 0:
                absent.add(quote)
                spot += 1
            else:
                spot = close + 1
        if spot >= end:  # a tag that never ends is cut off
            return
        at, name = spot + 1, m[2].lower()
        yield m[1], name, page[m.end() : spot]
        if not m[1] and (name in RAW or name in MEDIA) and name not in absent:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if close:
                at = close.end()
                yield "/", name, ""
            elif name in RAW:
                return
            else:
                absent.add(name)


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in order: text between block-level tags, with its words, linked words, place and
    kind. What is hidden is left out. The time is linear in the page, whatever is left open."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, int, int]] = []  # name; frame, article, hint, hidden
    depth, opened = [0, 0, 0, 0], Counter()
    parts: list[str] = []
    muted: list[str] = []  # inline elements from the one that is hidden
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            words = html.unescape("".join(parts)).split()
            if words and not depth[3]:
                kind = KINDS.get(stack[-1][0], "d") if stack else "d"
                out.append(Block(" ".join(words), len(words), min(linked, len(words)), "f" if depth[0] else "a" if depth[1] else "n", kind, depth[2] > 0))
            parts.clear()
        linked = 0

    def pop() -> None:
        name, *marks = stack.pop()
        opened[name] -= 1
        for i, mark in enumerate(marks):
            depth[i] -= mark

    for text, tag, attributes in tokens(page):
        if tag is None:
            if not muted:
                parts.append(text)
                if links:
                    linked += len(text.split())
            continue
        if tag == "a":
            links = max(0, links + (-1 if text else 1))
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK:
            if not text and tag not in VOID and (muted or "hidden" in attributes or "display" in attributes) and (muted or _names(attributes)[1]):
                muted.append(tag)
            elif text and muted and muted[-1] == tag:
                muted.pop()
            continue
        muted.clear()
        links = 0
        flush()
        if tag in VOID:
            continue
        if text:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag == "body":
            while opened["head"]:
                pop()
        if tag in CLOSES_ITSELF and stack and stack[-1][0] == tag:
            pop()
        hint, hidden = _names(attributes) if attributes else (False, False)
        root = tag in ("html", "body") or tag in ARTICLE
        mark = (int(tag in FRAME and not (tag == "header" and depth[1])), int(tag in ARTICLE), int(hint and not root), int(hidden))
        stack.append((tag, *mark))
        opened[tag] += 1
        for i, x in enumerate(mark):
            depth[i] += x
    flush()
    return out


#: The labelled pages, one a line, as blocks in order: place (n none, f frame, a article), kind (h heading, p paragraph,
#: l list item, t cell, d other), "!" for a hint, words, linked words, and + for article text.
LABELLED = (
    "fl1/1- fl1/1- fl2/2- fl1/1- fl3/3- nd6/0- ah9/0+ ap1/0+ ap120/0+ ap14/0+ ap45/2+ ap1/0+ ap1/0+ ap33/0+ ap8/0+ fd7/0-",
    "fl1/1- fl2/2- nd14/0- ah1/0+ ap70/0+ ap3/0+ ap250/0+ ap2/0+ fd12/0-",
    "fd2/2- fl1/1- fl1/1- nd3/0- ah12/0+ ad4/0+ ap60/5+ ah2/0+ al5/0+ al9/1+ al3/3+ ap55/0+ fh1/0- fp35/0- fl4/4- ap40/0+ ad!12/4- ap18/18+ fd5/1-",
    "fl2/2- fd9/0- ah6/0+ ap44/0+ at3/0+ at1/0+ at8/0+ ap30/0+ ap!40/0- ap!22/0- ad!3/1- fp20/0- fd10/2-",
    "nd2/2- nl1/1- nl1/1- nl2/2- nl1/1- nh7/0+ np60/1+ np45/0+ np4/0+ np80/3+ nh3/0+ np38/0+ np12/0+ np52/0+ nl3/3- nl5/5- nl2/2- nd6/0-",
    "nd1/1- nd2/2- nd1/1- nh8/0+ nd3/0+ np90/4+ np70/0+ np1/0+ np65/0+ nd4/2- nd6/6- nd5/5- nd9/1-",
    "nl1/1- nl1/1- nl1/1- nd31/0+ nd27/0+ nd40/2+ nl1/1- nl2/2- nd5/1-",
    "nd4/0- nl2/2- nl2/2- nl3/3- np110/0+ np95/2+ nl7/0+ nl9/0+ nl12/0+ np41/0+ nd!25/3- nl3/3- nl4/4- np8/0-",
    "nd3/3- nd8/0- nh5/0+ np35/0+ nd!30/0- np50/0+ np22/1+ np6/0+ np48/0+ nh2/0- nl6/6- nl7/7- nl5/5- nd7/3-",
    "nt1/1- nt1/1- nt2/2- nt85/3+ nt1/1- nt2/2- nd4/1-",
    "nd2/0- nl1/1- nh4/0- nl8/8- nl9/9- nl7/7- nl10/10- nh3/0- nl6/6- nl8/8- nd11/2-",
    "fl1/1- fl1/1- nh6/0+ np58/0+ np9/0+ nd16/0+ np47/2+ nd10/6- nd12/9- fd8/1- fp30/0-",
    "nh9/0+ np130/0+ np2/0+ np77/0+ np5/0+",
    "ah4/0+ ad25/0+ ad60/2+ al2/2+ al1/1+ ap5/0+ fp16/0- fl2/2- nd5/0- np7/2-",
    "fp45/0- fp60/0- fh3/0- fd1/0- fl3/0- ah5/0+ ap20/0+ ap31/28+ ap1/1+ ap64/0+ fh4/0- fp90/1-",
    "fl1/1- fl1/1- ah1/0+ ap1/0+ ap30/0+ ap40/8+ ap25/10+ ad10/3+ ap2/1+ ap16/5+ fd7/0-",
    "fl2/2- ah3/0+ ap5/0+ ap2/0+ al6/3+ al4/2+ al8/2+ ap3/3+ ap2/0+ fd3/1-",
    "nl1/1- nd5/0- nh6/0+ np50/8+ np34/9+ np61/7+ nd9/4- nd12/5- nl1/1-",
    "nl1/1- nl1/1- nd40/0+ nd36/0+ nl1/1- nl2/2-",
    "nl2/2- nl1/1- nd60/1+ nd20/0+ nd75/2+ nd3/1- nl2/2- nd4/0-",
    "nd1/1- nd2/2- nh4/0+ nd30/0+ nd52/0+ nl2/2- nd5/0- nl1/1-",
    "nl1/1- nl3/3- nd4/0- nd55/0+ nd90/1+ nd33/0+ nl3/3- nd6/1-",
    "ap500/0+",
    "ah2/0+ ap3/0+",
    "ap6/0+ fd3/1-",
    "ah5/0+ ap4/0+ ap9/0+ ah1/0+ ap2/0+ nd4/0-",
    "np200/0+",
    "ad3/0+",
    "ap40/0+ ad2/0+",
    "ap12/0+ al3/0+ fd6/0-",
    "np30/0+ np44/0+ nd3/0-",
    "nd4/0- nl1/1- nl1/1- ah3/0+ ap2/0+ ap7/0+ nl2/2-",
    "nd!9/2- nd!40/0- nd!4/4- np50/0+ np66/3+ nd!3/0- np44/0+ nd!60/0- nd!18/1- nd!5/5-",
)
SPEC = re.compile(r"([nfa])([hpltd])(!?)(\d+)/(\d+)([+-])")


def features(found: list[Block]) -> list[tuple]:
    """Of each block its words and link density, those of its neighbours, its place and kind, and its neighbours' places."""
    edge = Block("", 0, 0, "n", "d", False)
    out = []
    for before, b, after in zip([edge, *found[:-1]], found, [*found[1:], edge]):
        near = (before.words, before.density, after.words, after.density)
        tags = (b.place == "f", b.place == "a", b.kind == "h", b.kind == "p", b.kind in "lt", before.place == "f", after.place == "a")
        out.append((b.words, b.density, *near, *tags, b.hint))
    return out


def labelled_rows(pages: tuple[str, ...] = LABELLED) -> np.ndarray:
    """The features of all blocks of labelled pages, and last the label."""
    rows = []
    for page in pages:
        specs = SPEC.findall(page)
        found = [Block("", int(w), int(n), place, kind, bool(h)) for place, kind, h, w, n, _ in specs]
        rows += [(*f, x[-1] == "+") for f, x in zip(features(found), specs)]
    return np.array(rows, float)


def grow(rows: np.ndarray, depth: int = 8, least: int = 1) -> tuple:
    """A decision tree by Gini impurity: ``(feature, threshold, low, high)`` or a leaf ``(label,)``. Ties: the first split."""
    y = rows[:, -1]
    if depth == 0 or len(rows) < 2 * least or y.min() == y.max():
        return (int(y.mean() >= 0.5),)
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= t
            cost = sum(s.sum() * 2 * (p := y[s].mean()) * (1 - p) for s in (low, ~low))
            if min(low.sum(), (~low).sum()) >= least and (best is None or cost < best[0] - 1e-9):
                best = (cost, f, float(t))
    if best is None:
        return (int(y.mean() >= 0.5),)
    _, f, t = best
    low = rows[:, f] <= t
    return (f, t, grow(rows[low], depth - 1, least), grow(rows[~low], depth - 1, least))


def verdict(tree: tuple, features: tuple) -> int:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def main_text(page: str | None, tree: tuple) -> str:
    """The blocks of a page that the tree takes for article text, joined by two line feeds."""
    found = blocks(page or "")
    return "\n\n".join(b.text for b, f in zip(found, features(found)) if verdict(tree, f))


def extract_main_text(pages: DataFrame, labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages(page_id, url, html)``; other columns are ignored.

    The whole page is cut into blocks at block-level tags. A decision tree, grown from the blocks of the ``labelled``
    pages, picks the article's by their word count and link density, those of the blocks before and after, and the
    kinds of tags around them. Character references are decoded, white space inside a block is one space, blocks are
    joined by two line feeds. Null, empty and textless pages give an empty text; repeated rows and null ids stay. What is
    never closed ends with the page. No rows: no rows.
    """
    tree = grow(labelled_rows(labelled))

    def of(texts: list) -> tuple[list, list]:
        found = [main_text(t, tree) for t in texts]
        return found, [len(t) for t in found]

    return map_column(pages, ["page_id", "url"], "html", lambda: of, "text string, n_chars long")
