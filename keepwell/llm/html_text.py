"""Main text of web pages by composite text density.

The page becomes a tree. Scripts, styles, comments, forms, navigation, headers, footers, sidebars and elements whose class,
id or role names them as adverts, notices, menus or reader comments are left out. Of every other node the density is its
characters per tag, lowered by the share of link characters and link tags against the page's own; a node's density sum is
the sum over its child blocks. The subtree with the largest sum is the article. The least density on the path from the body to
it is the threshold: what hangs on that path beside it and is at least as dense belongs to it too.

A null page is an empty one; a page without text gives an empty text. Nothing is cut: whole pages in, whole texts out.
Tags may be unclosed or misnested; repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg object select".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                  "h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_PARAGRAPH = BLOCK - frozenset("body html li dd dt tbody td tfoot th thead tr summary".split())
#: an opening tag ends an open element of the second column, unless one of the third lies between
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, set())}
#: parts of a page that are not its article
LEFT_OUT = frozenset("head nav footer aside form button menu dialog".split())
NAMED = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
                  "alert popup modal overlay newsletter subscribe subscription sidebar side nav navbar navigation menu breadcrumb breadcrumbs "
                  "footer header masthead topbar comment comments commentlist disqus replies share sharing social related recommended widget "
                  "pagination pager login signup search toolbar skip".split())
#: the page, its article and headings stay whatever they are called
NEVER = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())


class Page:
    """Nodes in page order, so a parent's number is below its children's."""

    def __init__(self, source: str):
        self.parent, self.name, self.out, self.own, self.links = [-1], ["#"], [False], [0], [0]
        self.container = [0]  # the nearest block above: inline markup doesn't come between a block and its parts
        self.stack, self.depths = [0], {}  # open nodes, and their depths by name
        self.pieces: list[tuple[int, int, str]] = []  # node, block, text
        self.block = 0
        self._read(source)

    def _open(self, name: str, attributes: str, at: int) -> int:
        known = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes and name not in NEVER and not self.out[at] else {}
        left_out = self.out[at] or name in LEFT_OUT or name == "header" and not self._deepest(("article", "main"))
        if known and not left_out:
            words = set(re.split(r"[^a-z]+", " ".join(known.get(k, "") for k in ("class", "id", "role")).lower()))
            left_out = bool(words & NAMED) and not words & {"with", "has", "no"} or "hidden" in known or known.get("aria-hidden") == "true" \
                or "display:none" in known.get("style", "").replace(" ", "").lower()
        self.parent.append(at)
        self.name.append(name)
        self.out.append(left_out)
        self.own.append(0)
        self.links.append(0)
        self.container.append(at if at == 0 or self.name[at] in BLOCK else self.container[at])
        return len(self.parent) - 1

    def _deepest(self, names) -> int:
        """Depth of the innermost open element of these names, 0 if none is open."""
        return max((self.depths[x][-1] for x in names if self.depths.get(x)), default=0)

    def _push(self, node: int) -> None:
        self.depths.setdefault(self.name[node], []).append(len(self.stack))
        self.stack.append(node)

    def _pop(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.depths[self.name[node]].pop()
        del self.stack[depth:]

    def _text(self, text: str, at: int) -> None:
        if text and not self.out[at]:
            if "&" in text:
                text = html.unescape(text)
            self.pieces.append((at, self.block, text))
            self.own[at] += len(text) - text.count(" ")

    def _read(self, source: str) -> None:
        stack, position, end = self.stack, 0, len(source)
        while position < end:
            m = _MARKUP.search(source, position)
            if m is None:
                self._text(source[position:], stack[-1])
                break
            self._text(source[position:m.start()], stack[-1])
            position, name = m.end(), m["name"] and m["name"].lower()
            if not name:
                continue
            if name in BLOCK:
                self.block += 1
            if m["close"]:
                if depth := self._deepest((name,)):
                    self._pop(depth)
                continue
            if name in ENDS_PARAGRAPH:
                self._close({"p"}, {"button", "td", "th", "article", "section", "div", "li", "blockquote"})
            if name in IMPLIED:
                self._close(*IMPLIED[name])
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, position)
                position = close.end() if close else end
                continue
            if name == "br":
                self._text(" ", stack[-1])
            node = self._open(name, m["attributes"], stack[-1])
            if name not in VOID and not m["attributes"].endswith("/"):
                self._push(node)

    def _close(self, names: set[str], bounds: set[str]) -> None:
        depth = self._deepest(names)
        if depth and depth >= self._deepest(bounds):
            self._pop(depth)

    def densities(self) -> tuple[list[float], list[float], int]:
        """Density and density sum of each node, and the body's number."""
        n = len(self.parent)
        chars, tags = self.own[:], [1] * n
        linked, link_tags = [0] * n, [0] * n
        for i in range(n):
            if self.name[i] == "a" and not self.out[i]:
                link_tags[i] = 1
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.name[i] == "a"
            linked[i] = self.own[i] if in_link[i] else 0
        for i in range(n - 1, 0, -1):
            if not self.out[i]:
                p = self.parent[i]
                for part in (chars, tags, linked, link_tags):
                    part[p] += part[i]
        body = next((i for i in range(n) if self.name[i] == "body"), 0)
        page_share = linked[body] / max(chars[body], 1)
        density = [0.0] * n
        for i in range(n):
            if self.out[i] or not chars[i]:
                continue
            c, t, lc, lt = chars[i], tags[i], max(linked[i], 1), max(link_tags[i], 1)
            plain = max(c - linked[i], 1)
            base = math.log(c / plain * linked[i] + page_share * c + math.e)
            density[i] = c / t * max(math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, 1.0) + 1.0), 0.0)
        total = [0.0] * n
        for i in range(1, n):
            if self.name[i] in BLOCK:
                total[self.container[i]] += density[i]
        return density, total, body

    def article(self) -> str:
        if not self.pieces:
            return ""
        density, total, body = self.densities()
        under = [False] * len(total)
        under[body] = True
        for i in range(body + 1, len(total)):
            under[i] = under[self.parent[i]]
        inside = [i for i in range(len(total)) if under[i] and not self.out[i]] or [0]
        best = max(inside, key=lambda i: (total[i], density[i], -i))
        path, i = {best}, best
        while i != body and self.parent[i] >= 0:
            i = self.parent[i]
            path.add(i)
        threshold = min(density[i] for i in path)
        chosen = [False] * len(total)
        for i in range(len(total)):
            up = self.parent[i]
            chosen[i] = i == best or up >= 0 and (chosen[up] or up in path and i not in path and density[i] >= threshold > 0)
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.pieces:
            # text of the path's own nodes is beside the article only where it is as dense
            if chosen[node]:
                blocks.setdefault(block, []).append(text)
        out = (" ".join("".join(parts).split()) for parts in blocks.values())
        return " ".join(x for x in out if x)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Page(source or "").article() for source in batch.column(batch.num_columns - 1).to_pylist()]
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every row of `pages`."""
    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(_extracted, "id long, url string, text string")
