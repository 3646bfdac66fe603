"""Main text of HTML pages by two-pass block rules.

Pass 1 classifies every block by stop-word density, length and link density,
and by where it stands: blocks in containers for menus, forms, adverts and the
like are bad, text blocks of an article container are good.  Short blocks stay
ambiguous.  Pass 2 lets ambiguous blocks inherit the label of their nearest
decided neighbours.  Good blocks are joined by one space.

Defined results: a null or empty page has an empty text; broken markup is read
as far as it goes (an unclosed script or comment swallows the rest, an unclosed
menu ends where an article begins); nothing is cut or capped; repeated rows are
extracted each.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from streamtab.llm import common
from streamtab.llm.quality_rules import STOP_WORDS

MAX_LINK_DENSITY = 0.33
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.10, 0.25

# HTML element names by role, and words of class/id attributes
# that mark boilerplate.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "select", "title", "head", "canvas", "audio", "video", "noembed", "noframes"}
BOILER = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "figure"} - {"figure"}
MAIN = {"article", "main"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main",
         "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILER_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
                "cookies", "consent", "copyright", "disclaimer", "footer", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation",
                "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond",
                "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "tagcloud", "tags",
                "toolbar", "widget", "disqus", "alert", "gdpr", "topbar", "bottombar", "toc", "byline"} - {"byline"}
# Words that also name a page's layout: a marked wrapper of the first article is not boilerplate.
LAYOUT_WORDS = {"banner", "bottombar", "footer", "header", "masthead", "menu", "menubar", "nav", "navbar", "navigation", "search", "share", "sidebar",
                "social", "tags", "toc", "toolbar", "topbar"}
# First parts of compound names that say what an element has, not what it is.
HAVING = {"has", "have", "with", "without", "no", "not", "is", "show", "hide"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
STOPS = frozenset(STOP_WORDS)

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>\"']*)")
_STOP = re.compile(r"[\"'>]")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>\"']*)([^>]*)>")
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


NONE, SOFT, HARD = 0, 1, 2


def marked_boiler(attrs: str, by_name: bool = True) -> int:
    """Whether the attributes name a boilerplate container or hide it (HARD), or name a
    part of the layout (SOFT).  Class and id count only ``by_name``."""
    mark = NONE
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return HARD
        if name == "style":
            if "display:none" in value.replace(" ", "").lower():
                return HARD
        elif name == "role":
            if value.lower() in BOILER_ROLES:
                return HARD
        elif by_name:
            for token in value.split():
                words = [p.lower() for p in _PART.findall(token)]
                found = BOILER_WORDS.intersection(words) if words and words[0] not in HAVING else ()
                if any(w not in LAYOUT_WORDS for w in found):
                    return HARD
                mark = SOFT if found else mark
    return mark


class Scanner:
    """The tags of a page one after the other, in time linear in the page.

    A tag ends at the first ``>`` outside quotes; a ``<`` whose quotes never close is
    text, and where no tag is left by this rule, tags end at the next ``>`` instead.
    Quotes that are known to lead to the end of the page are remembered."""

    def __init__(self, page: str):
        self.page, self.dead, self.loose = page, set(), False
        self.last = page.rfind(">")

    def _end(self, at: int) -> int:
        """The place after the tag's ``>``; -1 if its quotes do not close."""
        chain = []
        while (m := _STOP.search(self.page, at)) is not None and m.start() not in self.dead:
            if m[0] == ">":
                return m.end()
            chain.append(m.start())
            close = self.page.find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        self.dead.update(chain)
        return -1

    def next(self, at: int):
        """(start, end, closing, name, attributes) of the next tag from ``at`` on; the name of a
        comment or declaration is None."""
        page = self.page
        i = -1 if self.loose else page.find("<", at)
        while i >= 0:
            if page.startswith("<!--", i):
                end = page.find("-->", i + 4)
                return i, (len(page) if end < 0 else end + 3), False, None, ""
            if i > self.last:                            # nothing but a comment can match any more
                i = page.find("<!--", i)
                continue
            if page[i + 1] in "!?":
                return i, page.find(">", i + 2) + 1, False, None, ""
            if (m := _NAME.match(page, i)) and (end := self._end(m.end())) >= 0:
                return i, end, bool(m[1]), m[2].lower(), page[m.end():end - 1]
            i = page.find("<", i + 1)
        self.loose = True
        m = _LOOSE.search(page, at) if at <= self.last else None
        return None if m is None else (m.start(), m.end(), bool(m[1]), m[2].lower(), m[3])


class Block:
    __slots__ = ("text", "linked", "boiler", "main")

    def __init__(self, text, linked, boiler, main):
        self.text, self.linked, self.boiler, self.main = text, linked, boiler, main


def blocks(page: str) -> list[Block]:
    """The page's blocks in order: clean text, characters in links, in boilerplate?, number of its main container (0: none)."""
    out: list[Block] = []
    parts: list[str] = []
    link_chars, links = 0, 0
    stack: list[tuple[str, int, int]] = []           # open block elements: name, mark, main container
    held: Counter[str] = Counter()                   # how often each of them is open
    mains = 0

    def state():
        return (stack[-1][1], stack[-1][2]) if stack else (NONE, 0)

    def drop(i: int) -> None:
        for s in stack[i:]:
            held[s[0]] -= 1
        del stack[i:]

    def close():
        nonlocal link_chars
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                mark, main = state()
                out.append(Block(text, min(link_chars, len(text)), mark != NONE, main))
            parts.clear()
        link_chars = 0

    never: set[str] = set()                          # elements without an end tag in the rest

    def after(name: str, at: int) -> int:
        """The place after the element's end tag; -1 without one."""
        end = None if name in never else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
        if end is None:
            never.add(name)
        return -1 if end is None else end.end()

    at, n, tags = 0, len(page), Scanner(page)
    while at < n:
        tag = tags.next(at)
        if tag is None:
            parts.append(page[at:])
            break
        start, end, closing, name, attrs = tag
        if start > at:
            chunk = page[at:start]
            parts.append(chunk)
            if links:
                link_chars += len(_SPACE.sub(" ", html.unescape(chunk)).strip())
        at = end
        if name is None:
            continue
        if not closing and name in RAW and not attrs.endswith("/"):
            if name == "head":
                found = None if name in never else re.compile(r"</head\s*>|<body\b", re.I).search(page, at)
                if found is None:
                    never.add(name)
                else:
                    at = found.end() if found[0].startswith("</") else found.start()
            else:
                at = after(name, at)
                at = n if at < 0 else at
            parts.append(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in BLOCK and name not in BOILER:
            if not closing and name in ("span", "small", "label") and marked_boiler(attrs):
                at = max(after(name, at), at)
            continue
        close()
        links = 0
        if closing:
            if held[name]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        drop(i)
                        break
                    if stack[i][0] in MAIN and name not in ("body", "html"):
                        break                         # a stray end tag closes nothing outside its article
        elif name not in VOID and not attrs.endswith("/"):
            if name in MAIN and not (held["article"] or held["main"]):
                while stack and stack[-1][0] in BOILER:
                    drop(len(stack) - 1)              # an unclosed menu ends where an article begins
            if name in ("p", "li") and stack and stack[-1][0] == name:
                drop(len(stack) - 1)                  # these end themselves
            mark, main = state()
            if name in MAIN and not main and mark == SOFT:
                mark = NONE                           # the layout around an article is not what it names
            if name in BOILER and not (name == "header" and main):
                mark = HARD
            elif name not in ("html", "body"):
                mark = max(mark, marked_boiler(attrs, by_name=name not in MAIN))
            if name in MAIN:
                if not main:
                    mains += 1
                    main = mains
                elif name == "article" and held["article"]:
                    mark = HARD                       # an article inside an article is a reader's comment
            stack.append((name, mark, main))
            held[name] += 1
    close()
    return out


GOOD, BAD, NEAR, UNSURE = "good", "bad", "near", "short"


def first_pass(b: Block) -> str:
    if b.boiler or b.linked > MAX_LINK_DENSITY * len(b.text):
        return BAD
    words = b.text.split()
    stops = sum(w.strip(".,;:!?\"'()").lower() in STOPS for w in words) / len(words)
    if b.main:
        return GOOD if len(b.text) >= SHORT else UNSURE
    if len(b.text) < SHORT:
        return BAD if b.linked else UNSURE
    if stops >= STOP_HIGH:
        return GOOD if len(b.text) > LONG else NEAR
    if stops >= STOP_LOW:
        return NEAR
    return BAD


def second_pass(found: list[Block], labels: list[str]) -> list[str]:
    """Ambiguous blocks take the label of the nearest decided neighbour (of
    their own article, if they stand in one); between a good and a bad one at
    the same distance, a near-good block is good.  Without any decided
    neighbour a block is good."""
    n = len(labels)
    sides = []
    for order in (range(n), range(n - 1, -1, -1)):
        last: dict[int, tuple[int, str]] = {}
        near = [None] * n
        for i in order:
            near[i] = last.get(found[i].main)
            if labels[i] in (GOOD, BAD) and not (found[i].main and found[i].boiler):
                last[found[i].main] = (i, labels[i])
        sides.append(near)
    out = []
    for i, lab in enumerate(labels):
        if lab in (GOOD, BAD):
            out.append(lab)
            continue
        a, b = sides[0][i], sides[1][i]
        if a is None and b is None:
            out.append(GOOD)                          # nothing on the page speaks against it
        elif a is None or b is None:
            out.append((a or b)[1])
        elif a[1] == b[1]:
            out.append(a[1])
        elif i - a[0] != b[0] - i:
            out.append(a[1] if i - a[0] < b[0] - i else b[1])
        else:
            out.append(GOOD if lab == NEAR or found[i].main else BAD)
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    if any(b.main and not b.boiler for b in found):
        for b in found:
            b.boiler = b.boiler or not b.main          # what stands beside the article
    labels = second_pass(found, [first_pass(b) for b in found])
    return " ".join(b.text for b, lab in zip(found, labels) if lab == GOOD)


OUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """Add text and n_chars (code points) to every row; columns of these names are replaced."""
    common.prepare(pages.sparkSession)

    def make():
        def run(bodies):
            texts = [main_text(b.decode("utf-8", "replace")) if b else "" for b in bodies]
            return texts, [len(t) for t in texts]
        return run
    return common.map_text(pages, source, make, OUT)
