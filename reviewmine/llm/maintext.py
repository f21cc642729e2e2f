"""Main text of web pages by scoring the element tree.

Blocks of text pass points for their length and commas to the elements around them: all to the
parent, half to the grandparent, less further up. Elements start with points for their tag and their
class names, and end with a discount for the share of their text that stands in links. The best
element is the article; siblings that score enough or read like text are kept with it. Menus, page heads
and feet, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out at any place.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import map_rows, need

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset(
    "nav aside form footer button select option optgroup datalist fieldset dialog menu object canvas audio video map head"
    " script style textarea title noscript iframe noembed noframes xmp template svg math".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article main".split())
PRIORS = {"article": 30.0, "main": 15.0, "div": 5.0, "section": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
          "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "dd": -3.0, "dt": -3.0, "th": -5.0}
BAD_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar alert dialog alertdialog form".split())
# Parts of class names and ids by which pages commonly mark what is no article.
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice"
    " notices notification outbrain overlay pager pagination paywall popup promo promotion promoted rail related"
    " replies reply responses share sharing shoutbox sidebar sidenav sidebars skyscraper social sponsor sponsored"
    " subscribe taboola toolbar topbar widget".split())
GOOD_WORDS = frozenset("article body content entry main page post story text".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    # Quotes count only behind an equals sign, and a tag without end goes on to the end of the page, as in browsers.
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_ZEROS = re.compile(r"&#0+(?=[0-9])")
_TOO_LARGE = re.compile(r"&#[0-9]{8,};?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_END_OF_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


class Node:
    """One element: its children are elements and strings in page order."""

    __slots__ = ("tag", "parent", "children", "names", "dropped", "score")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str] = frozenset(), dropped: bool = False):
        self.tag, self.parent, self.names, self.dropped = tag, parent, names, dropped
        self.children: list[Node | str] = []
        self.score: float | None = None


def decoded(text: str) -> str:
    """Character references decoded; numbers of any length are, those beyond Unicode become U+FFFD."""
    if "&#" in text:
        text = _TOO_LARGE.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), decoded(a or b or c))
    return out


def _element(tag: str, source: str, parent: Node, in_article: bool) -> Node:
    if not source.strip(" /\t\r\n"):
        return Node(tag, parent, frozenset(), tag in DROPPED or tag == "header" and not in_article)
    given = _attributes(source)
    label = f"{given.get('class', '')} {given.get('id', '')}"
    names = frozenset(w.lower() for w in _WORDS.findall(label))
    hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or bool(
        re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I))
    marked = bool(names & BAD_WORDS) and tag not in ("article", "main", "body", "html")
    if tag == "header":
        marked = not in_article
    role = given.get("role", "").lower() in BAD_ROLES
    return Node(tag, parent, names, tag in DROPPED or hidden or marked or role)


def parse(source: str) -> Node:
    """Element tree of a page; broken markup is read the way browsers do in the common cases."""
    root = Node("#root", None)
    open_nodes, at = [root], 0
    count: Counter[str] = Counter()  # open elements by tag
    find, length = _TAG.search, len(source)
    while at < length:
        match = find(source, at)
        if match is None:
            rest = source[at:]
            open_nodes[-1].children.append(rest)
            break
        if match.start() > at:
            open_nodes[-1].children.append(source[at:match.start()])
        at = match.end()
        closing, name, attributes = match.groups()
        if name is None:
            continue
        tag = name.lower()
        if closing:
            depth = len(open_nodes) - 1 if count[tag] else 0
            while depth and open_nodes[depth].tag != tag:
                # A block is not closed from within another by an inline end tag.
                if tag in INLINE and open_nodes[depth].tag not in INLINE:
                    depth = 0
                    break
                if tag == "p" and open_nodes[depth].tag not in INLINE:
                    depth = 0
                    break
                depth -= 1
            if depth:
                _end(open_nodes, count, depth)
            continue
        if tag in CLOSES_P:
            _close(open_nodes, count, ("p",), ("div", "td", "th", "li", "table", "button", "section", "article", "blockquote"))
        if tag == "li":
            _close(open_nodes, count, ("li",), ("ul", "ol", "menu"))
        elif tag in ("dd", "dt"):
            _close(open_nodes, count, ("dd", "dt"), ("dl",))
        elif tag in ("td", "th"):
            _close(open_nodes, count, ("td", "th"), ("tr", "table"))
        elif tag == "tr":
            _close(open_nodes, count, ("tr",), ("table",))
        elif tag == "option":
            _close(open_nodes, count, ("option",), ("select",))
        elif tag == "body":
            _close(open_nodes, count, ("head",), ())
        elif tag in HEADINGS and open_nodes[-1].tag in HEADINGS:
            _end(open_nodes, count, len(open_nodes) - 1)
        node = _element(tag, attributes, open_nodes[-1], count["article"] + count["main"] > 0)
        open_nodes[-1].children.append(node)
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(source, at)
            at = end.end() if end else length
            continue
        open_nodes.append(node)
        count[tag] += 1
    return root


def _end(open_nodes: list[Node], count: Counter[str], depth: int) -> None:
    """End the open element at a depth and all within it."""
    count.subtract(n.tag for n in open_nodes[depth:])
    del open_nodes[depth:]


def _close(open_nodes: list[Node], count: Counter[str], tags: tuple[str, ...], barriers: tuple[str, ...]) -> None:
    """End the nearest open element of ``tags``, unless a barrier lies before it."""
    if not any(count[t] for t in tags):
        return
    for depth in range(len(open_nodes) - 1, 0, -1):
        tag = open_nodes[depth].tag
        if tag in tags:
            _end(open_nodes, count, depth)
            return
        if tag in barriers:
            return


def _walk(node: Node) -> Iterator[tuple[str, Node]]:
    """Kept elements and texts below a node in page order: ('open' | 'close' | text, its element)."""
    stack: list[tuple[Node, Iterator[Node | str]]] = [(node, iter(node.children))]
    yield "open", node
    while stack:
        current, children = stack[-1]
        for child in children:
            if isinstance(child, str):
                yield child, current
            elif not child.dropped:
                yield "open", child
                stack.append((child, iter(child.children)))
                break
        else:
            stack.pop()
            yield "close", current


def _blocks(node: Node) -> Iterator[tuple[Node, str, int]]:
    """Blocks of text below a node: the element they stand in, the text, its characters in links."""
    parts: list[str] = []
    owner, links, linked = node, 0, 0
    steps = _walk(node)
    for kind, element in steps:
        if kind == "open" or kind == "close":
            if element.tag == "a":
                links += 1 if kind == "open" else -1
            elif element.tag == "br":
                parts.append(" ")
            if element.tag not in INLINE:
                if parts:
                    text = " ".join(decoded("".join(parts)).split())
                    if text:
                        yield owner, text, min(linked, len(text))
                    parts, linked = [], 0
        else:
            if not parts:
                owner = element
                while owner.tag in INLINE and owner.parent is not None:
                    owner = owner.parent
            parts.append(kind)
            if links:
                linked += len(kind.strip())
    text = " ".join(decoded("".join(parts)).split())
    if text:
        yield owner, text, min(linked, len(text))


def _start(node: Node) -> float:
    score = PRIORS.get(node.tag, 0.0)
    if node.names & GOOD_WORDS:
        score += 10.0
    return score


def best_container(root: Node) -> tuple[Node | None, dict[int, tuple[int, int]]]:
    """The element with the best score, and characters and link characters below every element."""
    sums: dict[int, tuple[int, int]] = {}
    candidates: dict[int, Node] = {}
    for owner, text, linked in _blocks(root):
        have = sums.get(id(owner), (0, 0))
        sums[id(owner)] = (have[0] + len(text), have[1] + linked)
        if owner.tag not in PARAGRAPHS or linked > 0.5 * len(text):
            continue
        points = 1.0 + text.count(",") + text.count("、") + text.count("，") + min(len(text) / 100, 3.0)
        holder = owner if owner.tag in ("div", "section", "article", "main", "td") else owner.parent
        level = 0
        while holder is not None and holder.tag not in ("html", "#root"):
            if holder.score is None:
                holder.score = _start(holder)
                candidates[id(holder)] = holder
            holder.score += points / (1.0, 2.0)[level] if level < 2 else points / (3.0 * level)
            holder, level = holder.parent, level + 1
            if level > 5:
                break
    # From the inside out, every element adds its sum to its parent's.
    for node in reversed([element for kind, element in _walk(root) if kind == "open"]):
        if id(node) in sums and node.parent is not None:
            have, own = sums.get(id(node.parent), (0, 0)), sums[id(node)]
            sums[id(node.parent)] = (have[0] + own[0], have[1] + own[1])
    best, top = None, float("-inf")
    for key, node in candidates.items():
        size, linked = sums[key]
        node.score *= 1 - linked / size
        if node.score > top:
            best, top = node, node.score
    return best, sums


def _widened(best: Node) -> Node:
    """The article or main element around the best container, if there is one."""
    node: Node | None = best
    found = best
    while node is not None:
        if node.tag in ("article", "main") and not (node.tag == "main" and found.tag == "article"):
            found = node
        node = node.parent
    return found


def main_blocks(source: str) -> list[str]:
    """Blocks of the main text of a page in page order."""
    root = parse(source)
    best, sums = best_container(root)
    if best is None:
        # No paragraph at all: bare headings or text right in the body.
        return [text for _, text, linked in _blocks(root) if linked <= 0.5 * len(text)]
    top = _widened(best)
    kept = [top]
    if top.parent is not None and top.tag not in ("body", "article", "main"):
        least = max(10.0, (best.score or 0.0) * 0.2)
        kept = []
        for sibling in top.parent.children:
            if sibling is top:
                kept.append(top)
            elif isinstance(sibling, Node) and not sibling.dropped and id(sibling) in sums:
                size, linked = sums[id(sibling)]
                density = linked / size if size else 0.0
                score = (sibling.score or 0.0) + (best.score or 0.0) * 0.2 * (sibling.names == top.names != frozenset())
                reads = sibling.tag in ("p", "pre", "blockquote") and (
                    size > 80 and density < 0.25
                    or density == 0 and any(_END_OF_SENTENCE.search(t) for _, t, _ in _blocks(sibling)))
                heading = sibling.tag in HEADINGS and density < 0.5
                if score >= least or reads or heading:
                    kept.append(sibling)
    out = []
    for node in kept:
        for owner, text, linked in _blocks(node):
            # Lists made of links alone are menus wherever they stand.
            if linked >= 0.9 * len(text) and owner.tag in ("li", "dd", "dt", "td", "ul", "ol"):
                continue
            out.append(text)
    return out


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A NULL or empty page, or one without text, has the text ''; NULL urls and ids stay; repeated rows are
    extracted each; an empty table gives an empty one. The whole page is read, however long.
    """

    def make() -> Callable[..., Iterator[tuple]]:
        def one(page_id: object, url: str | None, source: str | None) -> Iterator[tuple]:
            text = "\n".join(main_blocks(source)) if source else ""
            yield page_id, url, text, len(text)

        return one

    schema = pages.select(id_col, url_col).schema
    out = StructType().add("page_id", schema[0].dataType).add("url", schema[1].dataType).add("text", "string").add("n_chars", "long")
    return map_rows(need(pages, id_col, url_col, html_col), out, make)
