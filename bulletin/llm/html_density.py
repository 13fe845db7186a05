"""Main text of web pages by composite text density.

For every node of the page's tree: characters per tag, adjusted for the share of link
characters and link tags. A node's density sum adds up its children's densities. The node
with the largest sum is the heart of the content; the least density on its path to the
body is the threshold. Every subtree that reaches the threshold gives its own largest-sum
node as content, which keeps headings and sections beside the heart. Where the heart lies in
an <article> or <main>, that element counts whole, and so does every <article> beside it
that reaches the threshold.

Menus, forms, scripts and the like are cut before by their tag. A class or id is evidence
only, and the text that would be left decides. Marks of adverts, comments and consent
notices cut unless what is left is both shorter and no story; other marks cut what is no
longer than all that is left. Where a <main> has text or an <article> a story, no marked part beside
it counts; an <article> keeps the marked part around it only where all articles of the page lie in such
parts, and never within comments or adverts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)",
    re.S,
)
STOP = re.compile("[\"'>]")
ATTRIBUTE = re.compile(r"""([A-Za-z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
MARK = re.compile(r"[a-z]+|\d+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements that are never part of the main text.
CUT = frozenset(
    "head script style noscript template iframe object canvas svg nav footer aside form button select option textarea input "
    "dialog menu audio video map title noembed noframes".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
#: Words of class and id that mark menus, adverts, notices, comments and page furniture.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay cookie cookies "
    "consent gdpr notice notices alert nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer masthead "
    "comment comments disqus respond reply replies newsletter subscribe subscription social share sharing related recommended "
    "widget widgets toolbar pagination pager login signup search outbrain taboola".split()
)
#: Of these, words of parts that never hold the story.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr comment comments disqus respond "
    "reply replies newsletter subscribe subscription outbrain taboola".split()
)
#: What such a name says of the page does not make it furniture.
LAYOUT = tuple(f"{word}{sign}" for word in ("no", "not", "has", "with", "without") for sign in "-_")
#: A name that ends in one of these is that of a whole page.
WHOLE = frozenset("page site layout".split())
#: Characters outside links, white space aside, from which what is left counts as a story.
STORY_CHARS = 100
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Opening one of these ends an open element of the second set, unless one of the third lies between.
ENDS = {
    **{t: ({"p"}, {"table", "td", "th", "button", "object"}) for t in BLOCKS - {"html", "body", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"table", "tr"}),
    "th": ({"td", "th", "p"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}


def is_furniture(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is cut whatever it holds. `inside`: within an <article> or <main>, whose header holds the title."""
    if tag in CUT:
        return True
    if tag == "header":
        return not inside
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


def marks(tag: str, attributes: str, inside: bool) -> int:
    """2: class or id has a word of FOREIGN; 1: another word of furniture; 0: neither.

    `no-`, `has-`, `with-` and the like only describe a layout, and `promo-page` is a kind of page.
    """
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    found = 0
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for part in (a or b or c).lower().split():
                words = [] if part.startswith(LAYOUT) else MARK.findall(part)
                if not FOREIGN.isdisjoint(words):
                    return 2
                if words and words[-1] not in WHOLE and not FURNITURE.isdisjoint(words) or "header" in words and not inside and not tag[1:].isdigit():
                    found = 1
    return found


class Page:
    """The tree as parallel lists in page order, without what is cut; texts as (node, text) and block breaks."""

    def __init__(self, html: str) -> None:
        self.tags, self.parents, self.ends = ["#page"], [0], [0]
        self.pieces: list[tuple[int, str | None]] = []
        self.unclosed: set[int | str] = set()
        self.marked: dict[int, int] = {}
        self._read(html)
        self.pieces = [(node, text if text is None else unescape(text)) for node, text in self.pieces]
        if self.marked:
            self._drop_marked()

    def _drop_marked(self) -> None:
        """Cut the marked elements, but for those without which no story is left."""
        n, tags, parents = len(self.tags), self.tags, self.parents
        linked, within, foreign = [t == "a" for t in tags], [t == "main" for t in tags], [False] * n
        article = [t == "article" for t in tags]
        owner = [0] * n  # the innermost marked element around a node, 0: none
        for i in range(1, n):
            up = parents[i]
            linked[i] = linked[i] or linked[up]
            within[i] = within[i] or within[up]
            article[i] = article[i] or article[up]
            foreign[i] = foreign[up] or self.marked.get(i) == 2
            owner[i] = i if i in self.marked else owner[up]
        # Text outside links by owner; its part in a <main>, and in an <article> without a marked part around it.
        own, in_main, in_article = [0] * n, 0, 0
        for node, text in self.pieces:
            if text and not linked[node]:
                size = len("".join(text.split()))
                own[owner[node]] += size
                in_main += size * within[node]
                in_article += size * (article[node] and not owner[node])
        # Where a <main> has text or an <article> a story, a marked part beside it is none, however long.
        barred = {i for i in self.marked if in_main and not within[i] or in_article >= STORY_CHARS and not article[i]}
        opened: set[int] = set()

        def open_up(i: int) -> None:
            """Keep a marked element and the marked ones around it; their own text then counts as left."""
            while i and i not in opened:
                opened.add(i)
                own[0] += own[i]
                i = owner[parents[i]]

        articles = [i for i in range(1, n) if tags[i] == "article" and not foreign[i] and owner[i] not in barred]
        if articles and all(owner[i] for i in articles):
            for i in articles:
                open_up(owner[i])
        # The longest first, so that what it leaves open is known to the shorter ones.
        for i in sorted(self.marked, key=lambda i: (self.marked[i], -own[i], i)):
            if i not in opened and i not in barred and own[i] > own[0] and (own[0] < STORY_CHARS or not foreign[i]):
                open_up(i)
        gone = [i in self.marked and i not in opened for i in range(n)]
        number, kept = [0] * n, [0]
        for i in range(1, n):
            gone[i] = gone[i] or gone[self.parents[i]]
            if not gone[i]:
                number[i] = len(kept)
                kept.append(i)
        self.tags, self.parents = [self.tags[i] for i in kept], [number[self.parents[i]] for i in kept]
        self.pieces = [(number[node], text) for node, text in self.pieces if not gone[node]]

    def _attributes(self, html: str, at: int) -> tuple[str, int]:
        """The attributes of a tag whose name ends at `at`, and its end. With an unclosed quote it ends at the first `>`.

        Places and quotes from which no end was found are remembered, which keeps the scan linear.
        """
        here, seen = at, []
        while here not in self.unclosed:
            seen.append(here)
            found = STOP.search(html, here)
            if not found:
                break
            if found[0] == ">":
                return html[at : found.start()], found.end()
            close = -1 if found[0] in self.unclosed else html.find(found[0], found.end())
            if close < 0:
                self.unclosed.add(found[0])
                break
            here = close + 1
        self.unclosed.update(seen)
        end = html.find(">", at)
        return (html[at:end], end + 1) if end >= 0 else (html[at:], len(html))

    def _read(self, html: str) -> None:
        stack = [0]
        cut = 0  # stack height at which a cut began
        home = 0  # open <article> and <main> elements
        at, size = 0, len(html)
        names = ["#page"]
        held: Counter[str] = Counter()  # open elements by name, so that no stack is searched in vain
        while at < size:
            found = TOKEN.search(html, at)
            start, end = found.span() if found else (size, size)
            if start > at and not cut:
                self.pieces.append((stack[-1], html[at:start]))
            at = end
            if not found:
                break
            tag = found[2]
            if not tag:
                if found[0].startswith("<![CDATA[") and not cut:
                    self.pieces.append((stack[-1], found[0][9:].removesuffix("]]>")))
                continue
            tag = tag.lower()
            attributes, at = self._attributes(html, at)
            if found[1]:
                depth = len(names) - 1 if held[tag] else 0
                while depth and names[depth] != tag:
                    depth -= 1
                if depth:
                    home -= sum(n in ("article", "main") for n in names[depth:])
                    held.subtract(names[depth:])
                    del names[depth:], stack[depth:]
                    if cut and depth <= cut:
                        cut = 0
                if tag in BLOCKS and not cut:
                    self.pieces.append((stack[-1], None))
                continue
            closes, bars = ENDS.get(tag, ((), ()))
            while any(held[t] for t in closes):
                depth = len(names) - 1
                while depth and names[depth] not in closes and names[depth] not in bars:
                    depth -= 1
                if not depth or names[depth] in bars or (tag in BLOCKS and names[depth] == "p" and any(n in ("div", "section", "article") for n in names[depth + 1 :])):
                    break
                held.subtract(names[depth:])
                del names[depth:], stack[depth:]
                if cut and depth <= cut:
                    cut = 0
            if tag in BLOCKS and not cut:
                self.pieces.append((stack[-1], None))
            gone = cut or is_furniture(tag, attributes, home > 0)
            if not gone:
                self.tags.append(tag)
                self.parents.append(stack[-1])
                if mark := marks(tag, attributes, home > 0):
                    self.marked[len(self.tags) - 1] = mark
            if tag in VOID:
                if not gone and tag in ("br", "td", "th"):
                    self.pieces.append((stack[-1], " "))
                continue
            if tag in RAW:
                close = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
                body, at = (html[at : close.start()], close.start()) if close else (html[at:], size)
                if close:
                    at = html.find(">", close.start()) + 1 or size
                if not gone:
                    self.pieces.append((len(self.tags) - 1, body))
                continue
            if tag in ("td", "th") and not gone:
                self.pieces.append((stack[-1], " "))
            home += tag in ("article", "main")
            names.append(tag)
            held[tag] += 1
            stack.append(stack[-1] if gone else len(self.tags) - 1)
            if gone and not cut:
                cut = len(stack) - 1

    def densities(self) -> tuple[list[float], list[float]]:
        """Link-adjusted characters per tag of every node, and the sum of its children's (a leaf: its own)."""
        n = len(self.tags)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        linked = [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parents[i]] or self.tags[i] == "a"
        for node, text in self.pieces:
            if text:
                size = len("".join(text.split()))
                chars[node] += size
                if linked[node]:
                    link_chars[node] += size
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i] + (self.tags[i] == "a")
        body = self.tags.index("body") if "body" in self.tags else 0
        all_chars, all_links = max(chars[body], 1), link_chars[body]

        def density(i: int) -> float:
            c, t = chars[i], max(tags[i], 1)
            if not c:
                return 0.0
            lc, lt = max(link_chars[i], 1), max(link_tags[i], 1)
            base = math.log(c / max(c - link_chars[i], 1) * lc + all_links / all_chars * c + math.e)
            return c / t * math.log(c / lc * t / lt) / math.log(base) if c * t > lc * lt else 0.0

        dense = [density(i) for i in range(n)]
        sums = [0.0] * n
        leaf = [True] * n
        for i in range(1, n):
            sums[self.parents[i]] += dense[i]
            leaf[self.parents[i]] = False
        self.chars = chars
        return dense, [dense[i] if leaf[i] else sums[i] for i in range(n)]

    def text(self) -> str:
        """The main text; blocks are joined by a blank line."""
        n, pieces = len(self.tags), self.pieces
        dense, sums = self.densities()
        if not self.chars[0]:
            return ""
        body = self.tags.index("body") if "body" in self.tags else 0
        # Largest sum within each subtree; of equal ones the first in page order.
        best = list(range(n))
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            if sums[best[i]] > sums[best[up]] or sums[best[i]] == sums[best[up]] and best[i] < best[up] and best[up] != up:
                best[up] = best[i]
        heart = best[body] if self.chars[body] else best[0]
        path = [heart]
        while path[-1] not in (0, body):
            path.append(self.parents[path[-1]])
        threshold = min(dense[i] for i in path)
        content = [False] * n
        for i in path:
            if self.tags[i] in ("article", "main"):
                for j in range(1, n):
                    content[j] = j == i or self.tags[i] == self.tags[j] == "article" and self.parents[i] == self.parents[j] and dense[j] >= threshold
                break
        else:
            reached = [False] * n
            reached[path[-1]] = True
            for i in range(n):
                if reached[i] or i and reached[self.parents[i]] and dense[i] >= threshold and dense[i] > 0:
                    reached[i] = content[best[i]] = True
        for i in range(1, n):
            content[i] = content[i] or content[self.parents[i]]
        blocks, open_ = [], []
        for node, text in pieces:
            if text is None:
                blocks.append("".join(open_))
                open_ = []
            elif content[node]:
                open_.append(text)
        blocks.append("".join(open_))
        return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add `text` (empty if none) and `n_chars`, its code points, to `pages`; columns of these names are replaced.

    Null and empty pages give an empty text. Unclosed, misnested and unknown tags never fail.
    """

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(main_text)

    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    out = pages.withColumn("_text", run(F.col(html_col)))
    return out.select(*kept, F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))
