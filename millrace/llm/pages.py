"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of text; scripts, styles, comments
and the page's head leave none.  A line in a menu, header, footer, sidebar, notice,
advert, form or reader comment counts as an empty one, and such a part is fenced by
empty lines, as is a line that is mostly links.  Text lengths are summed over a
sliding window of lines: text surges where the sum leaves zero and dives where it
returns.  The article is all that stands between, whatever its size, in its
containers: the outermost article or main element of most text and those beside it
like it, or, if none has much of the page's text, the lowest element that holds all
headings and lines of prose.  In such an element the sums also tell an unnamed part
beside the article: a div or cell before the title or first surge, or after the last
dive, whose sums never reach a share of the page's own median line of prose, is left
out, and the lowest element is looked for again; nothing between surges is.

Defined results: a null or empty page gives the empty text; a page without lines of
text too; unclosed and crossed tags are closed by the next enclosing end; equal
amounts of text go to the earlier part; repeated rows are read one by one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import named_again, plain_names

#: Lines in a sliding block, and empty lines that fence a part off.
BLOCK_LINES = 3
#: A line with a larger share of its text in links is no text.
LINK_SHARE = 0.6
#: A line of so many characters is prose, as is a shorter one that ends like a sentence.
PROSE_CHARS = 25

#: A division surges if a sum reaches this share of the page's median line of prose.
SURGE = 0.5

#: Elements nested deeper belong to the one at this depth, as in browsers.
MAX_DEPTH = 512

# HTML's elements by what they mean for a text's flow.
_SKIPPED = "script style noscript template svg iframe object canvas head title select textarea button video audio map datalist annotation".split()
_BLOCK = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
_VOID = "area base br col embed hr img input link meta param source track wbr".split()
_APART = "nav footer aside form menu dialog fieldset".split()
# Names of page parts that aren't the article.
_PARTS = (
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share comment comments commentlist "
    "respond disqus cookie cookies consent gdpr copyright disclaimer footer foot header masthead menu menubar modal popup overlay nav navbar "
    "navigation newsletter subscribe subscription notice notices alert toolbar pager pagination promo promotion promoted sponsor sponsored "
    "related recommended recommendations sidebar side-bar rail widget widgets share sharing social login signin signup search skip toc tags "
    "reply replies reaction reactions discussion feedback complementary contentinfo"
).split()
# Those that articles are about, too, which count with a second sign only.
_SUBJECTS = set(
    "advertising alert banner copyright disclaimer discussion feedback foot footer head header login menu navigation notice notices "
    "promotion rail reaction reactions recommended recommendations related search share sharing signin signup skip social subscription "
    "tags toc toolbar widget widgets".split()
)
# Subjects that, as classes, are a page's layout in an article, too.
_LAYOUT = set("foot footer login notice notices rail share sharing signin signup social subscription toolbar".split())
_NAMES = set(_PARTS)
#: What pages are divided by, other than the blocks of a text.
_DIVISIONS = {"div", "td"}
#: Layout tools name every element of a page a widget of some kind.
_WHOLE_NAMES = {"widget", "widgets"}
_LANDMARKS = set("banner complementary contentinfo navigation search menu menubar toolbar dialog".split())
_OWN = {"article", "post", "entry", "story", "content"}
_MAIN_ROLES = {"main", "article"}
#: Names of articles that are a reader's or an advertiser's.
_FOREIGN = set("comment comments reply ad advert advertisement promo".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_SENTENCE = re.compile(r"[.!?:;\u2026\u3002\uff01\uff1f][\"')\]\u2019\u201d\u00bb]*$")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|$)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_ATTR = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")}
_IMPLIED = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}}
_BLOCKS, _SKIP, _NO_END = set(_BLOCK), set(_SKIPPED), set(_VOID)


class _Node:
    __slots__ = ("tag", "parent", "apart", "main", "skip", "size", "depth", "named", "by_id", "layout", "section", "linked", "heading", "title")

    def __init__(self, tag: str, parent: _Node | None, attrs: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.size = self.linked = 0
        #: 0: no page part's name, 1: one that is a subject, too, 2: one that isn't.
        self.named, self.by_id, self.layout = 0, True, False
        self.section = tag == "section"
        #: Whether it holds a heading, and the page's title or main element.
        self.heading = self.title = False
        self.main = tag in ("article", "main")
        self.apart = bool(parent and parent.apart) or tag in _APART
        self.skip = bool(parent and parent.skip) or tag in _SKIP
        if tag == "header":
            # An article's own header holds its heading.
            self.apart |= not self.inside_main()
        if attrs:
            self._read(attrs)

    def inside_main(self) -> bool:
        node = self.parent
        while node is not None:
            if node.main:
                return True
            node = node.parent
        return False

    def _read(self, attrs: str) -> None:
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id", "role", "aria-label", "itemprop"):
                words = value.split()
                self.section |= name == "class" and "section" in words
                if name == "role" and value in _MAIN_ROLES or name == "itemprop" and value == "articlebody":
                    self.main = True
                elif self.tag == "article":
                    self.apart |= not _FOREIGN.isdisjoint(words)
                elif self.tag not in ("body", "html", "main"):
                    self._name(name, value, words)
            elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) or name == "aria-hidden" and value == "true":
                self.apart = True


    def _name(self, attribute: str, value: str, words: list[str]) -> None:
        """Whether an attribute names a part of the page."""
        if attribute == "id" and self.tag in _HEADINGS:
            return
        if attribute == "role" and value in _LANDMARKS:
            self.named, self.by_id = 2, False
        for word in words:
            parts = re.split(r"[-_]+", word)
            heading = parts[-1] in ("title", "heading", "headline") or parts[0] in _OWN and parts[-1] in ("header", "head")
            met = {word} & _NAMES or {parts[0], parts[-1]} & _NAMES - _WHOLE_NAMES
            if not met or heading:
                continue
            # Long ids are made of headings, and labels are sentences.
            plain = not met <= _SUBJECTS and (attribute != "id" or len(parts) < 3) and (attribute != "aria-label" or len(words) == 1)
            self.named = max(self.named, 2 if plain else 1)
            self.by_id &= attribute == "id"
            self.layout |= attribute == "class" and not met.isdisjoint(_LAYOUT)

    def is_part(self, total: int) -> bool:
        """Whether the name means a part that isn't the article, on a page of so much text."""
        if not self.named or self.title and 2 * self.size >= total:
            return False
        if self.named == 2 or self.linked > LINK_SHARE * self.size:
            return True
        if self.inside_main():
            return self.layout and not self.heading
        # Sections have ids made of their headings; other elements' ids are the layout's.
        return not (self.by_id and self.heading and self.section)


def _lines(page: str) -> Iterator[tuple[str, int, int, _Node]]:
    """(text, characters in links, links, the node that holds it) of every block, in page order."""
    top = node = _Node("html", None, "")
    inline: list[_Node] = []
    parts: list[str] = []
    linked, links, in_link, at = 0, 0, 0, 0

    def line() -> list[tuple[str, int, int, _Node]]:
        nonlocal linked, links
        text = " ".join("".join(parts).split())
        parts.clear()
        found = [(text, linked, links, node)] if text else []
        linked = links = 0
        return found

    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        text = m["text"] if m["text"] is not None else m["cdata"]
        if text is not None:
            if not node.skip and not (inline and inline[-1].apart):
                decoded = html.unescape(text) if m["text"] is not None else text
                parts.append(decoded)
                if in_link:
                    linked += len("".join(decoded.split()))
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag == "a":
                in_link = 0
            if tag in _BLOCKS:
                if tag == "p" or tag in ("br", "hr"):
                    yield from line()
                held = node
                while held is not top and held.tag != tag:
                    held = held.parent
                if held is not top:
                    yield from line()
                    inline.clear()
                    node = held.parent
            elif inline and inline[-1].tag == tag:
                inline.pop()
            continue
        if tag in _RAW and not m["attrs"].endswith("/"):
            end = _RAW[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in _BLOCKS:
            yield from line()
            inline.clear()
            in_link = 0
            closes = _IMPLIED.get(tag, {"p"})
            while node.tag in closes:
                node = node.parent
            if tag not in _NO_END and not m["attrs"].endswith("/") and node.depth < MAX_DEPTH:
                node = _Node(tag, node, m["attrs"])
        elif tag == "a":
            in_link = 1
            links += 1
        elif tag in _SKIP or tag in ("span", "small", "label", "ins", "em", "strong", "b", "i", "u", "font", "sup", "sub"):
            if not m["attrs"].endswith("/"):
                found = _Node(tag, inline[-1] if inline else None, m["attrs"])
                found.apart |= found.skip or found.named == 2
                inline.append(found)
    yield from line()


def _sums(sizes: list[int], block: int) -> list[int]:
    """Text lengths over a window of lines that starts at each line."""
    return [sum(sizes[i : i + block]) for i in range(len(sizes))]


def _runs(sizes: list[int], block: int) -> list[tuple[int, int]]:
    """Where the sliding sums surge from zero and dive back: (first line, line after the last)."""
    sums = _sums(sizes, block)
    found, start = [], None
    for i, size in enumerate(sizes):
        if start is None and size:
            start = i
        elif start is not None and sums[i] == 0:
            found.append((start, i))
            start = None
    if start is not None:
        found.append((start, len(sizes)))
    return found


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    if not page:
        return ""
    # (text, node, length as prose); a paragraph that is one link is text, but no prose.
    lines: list[tuple[str, _Node | None, int]] = []
    fence = [("", None, 0)] * BLOCK_LINES
    fenced = True
    found = [(text, len("".join(text.split())), linked, links, node) for text, linked, links, node in _lines(page)]
    _settle([(text, size, linked, node) for text, size, linked, _, node in found])
    for text, size, linked, links, node in found:
        heading = node.tag in _HEADINGS and not node.apart
        mostly = linked > LINK_SHARE * size and not heading and not node.inside_main()
        if node.apart or mostly and not (node.tag == "p" and links == 1 and _is_prose(text)):
            if not fenced:
                lines += fence
                fenced = True
            continue
        lines.append((text, node, 0 if mostly else len(text)))
        fenced = False
    holders = _main_holders([(t, n) for t, n, _ in lines if n is not None])
    if holders:
        inside = [(t, n, size) if n is not None and _within(n, holders) else fence[0] for t, n, size in lines]
    else:
        inside = _beside_cut(lines)
    runs = _runs([len(t) for t, _, _ in inside], BLOCK_LINES)
    return "\n".join(t for a, b in runs for t, _, _ in inside[a:b] if t)


def _is_prose(text: str) -> bool:
    return len(text) >= PROSE_CHARS or _SENTENCE.search(text) is not None


def _settle(lines: list[tuple[str, int, int, _Node]]) -> None:
    """Set the named parts apart, with all that is in them."""
    total, seen = 0, {}
    for _, size, linked, node in lines:
        if node.apart:
            continue
        total += size
        heading, title = node.tag in _HEADINGS, node.tag == "h1"
        while node is not None:
            seen[node] = None
            node.size += size
            node.linked += linked
            node.heading |= heading
            node.title |= title
            title |= node.main
            node = node.parent
    for node in sorted(seen, key=lambda n: n.depth):
        node.apart |= bool(node.parent and node.parent.apart) or node.is_part(total)


def _within(node: _Node | None, holders: set[_Node]) -> bool:
    while node is not None:
        if node in holders:
            return True
        node = node.parent
    return False


def _main_holders(lines: list[tuple[str, _Node]]) -> set[_Node]:
    """The article or main elements that hold the article, of lines that aren't apart."""
    nodes: dict[int, _Node] = {}
    for text, node in lines:
        while node is not None:
            if id(node) not in nodes:
                nodes[id(node)] = node
                node.size = 0
            node.size += len(text)
            node = node.parent
    total = sum(len(t) for t, _ in lines)
    outer = [n for n in nodes.values() if n.main and not n.inside_main()]
    best = max(outer, key=lambda n: (n.size, -n.depth), default=None)
    if best is None or best.size < 0.3 * total:
        return set()
    return {n for n in outer if (n.tag, n.depth) == (best.tag, best.depth)}


def _beside_cut(lines: list[tuple[str, _Node | None, int]]) -> list[tuple[str, _Node | None, int]]:
    """The lines of the lowest element around all prose, without divisions beside the article that never surge."""
    while True:
        prose = [n for t, n, size in lines if n is not None and (n.tag in _HEADINGS or size and _is_prose(t))]
        held = _common(prose or [n for _, n, _ in lines if n is not None])
        lines = [x if x[1] is not None and _within(x[1], {held}) else ("", None, 0) for x in lines]
        sizes = sorted(size for t, n, size in lines if n is not None and n.tag not in _HEADINGS and size and _is_prose(t))
        if not sizes:
            return lines
        parts: dict[_Node, list[int]] = {}
        for i, (_, node, _) in enumerate(lines):
            if node is not None:
                parts.setdefault(_division(node, held), []).append(i)
        least = SURGE * sizes[len(sizes) // 2]
        surges = {n: max(_sums([lines[i][2] for i in places], BLOCK_LINES)) >= least for n, places in parts.items()}
        titled = [i for i, (_, n, _) in enumerate(lines) if n is not None and n.tag == "h1"]
        text = [i for n, places in parts.items() if surges[n] for i in places]
        first, last = min(titled[:1] + text), max(text)
        beside = {
            i for n, places in parts.items() if n is not held and not surges[n] and (places[-1] < first or places[0] > last) for i in places
        }
        if not beside:
            return lines
        lines = [("", None, 0) if i in beside else x for i, x in enumerate(lines)]


def _division(node: _Node, held: _Node) -> _Node:
    """The element's own division that holds a line, or the element, if the line stands in none."""
    below = node
    while below is not held and below.parent is not held:
        below = below.parent
    return below if below is not node and below.tag in _DIVISIONS else held


def _common(nodes: list[_Node]) -> _Node | None:
    """The lowest element around all nodes."""
    held = nodes[0] if nodes else None
    for node in nodes:
        while not _within(node, {held}):
            held = held.parent
    return held


def extract(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of each whole page."""
    plain, names = plain_names(pages)
    column = names[html_column]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields] + ["main string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(main=[main_text(x) if isinstance(x, str) else "" for x in batch[column]])

    return named_again(plain.mapInPandas(run, schema), names, **{out: "main"})
