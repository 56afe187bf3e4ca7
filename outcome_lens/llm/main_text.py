"""Operator 10: the main text of web pages by tree scoring.

Every paragraph gives points for its length and its commas to its ancestors, half as many at each step up, and a
container's points are discounted by its share of linked text. The best container and those siblings
that look like more of the same are kept; what is boilerplate by its element counts nowhere. A form, or an
element that only a word of its class or id marks, stays where it holds most of the page's text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.llm.common import whole_text

# Elements by what they do to a page's text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title svg math canvas iframe object audio video map select option textarea button nav footer aside menu dialog".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}
# an open element of the values ends where one of the key starts, up to the nearest of the second set
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs captcha comment comments commentlist consent cookie cookies disqus "
    "footer gdpr header headerbar login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pager pagination paywall "
    "popup promo promoted recommended related replies reply respond rss share sharing sidebar signup skyscraper social sponsor sponsored "
    "subscribe subscription tagcloud toolbar topbar widget widgets".split()
)
# words that, next to those in a name, leave it one of boilerplate: "comments-area", but not "has-comments"
NEUTRAL = frozenset("area bar block body box container inner item items left list post posts right section site thread wrap wrapper".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar alert".split())
CONTENT = frozenset("article main".split())
NOT_CONTENT = frozenset("comment comments reply related promo sponsored ad advert".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE) for tag in RAW}
TAG_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
TAG_PART = re.compile(r"""=\s*["']|>""")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
NAME = re.compile("[A-Z]?[a-z]+|[A-Z]+")
GAPS = re.compile(r"\s+")
LEAST_SIBLING, SIBLING_SHARE, MOST_LINKED = 10.0, 0.2, 0.25
LEAST_PROSE = 80


class Node:
    """An element: its children are nodes and texts, in order."""

    __slots__ = ("article", "children", "clear", "content", "dropped", "linked", "mark", "named", "parent", "points", "prose", "size", "tag")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, mark: str | None = None, named: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.mark, self.named = mark, named  # what speaks against it, and whether a whole name does
        self.prose = self.clear = self.article = 0
        self.children: list[Node | str] = []
        self.content = tag in CONTENT or parent is not None and parent.content
        self.points = 0.0
        self.size = self.linked = 0


class Marks:
    """A page's tags and texts in order, in time linear in its length whatever it holds.

    A search that finds nothing is not made again: what does not follow here follows nowhere later.
    """

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()

    def find(self, what: str, start: int) -> int:
        if what in self.missing:
            return -1
        at = self.page.find(what, start)
        if at < 0:
            self.missing.add(what)
        return at

    def end_of_tag(self, start: int) -> int:
        """Where the ``>`` of a tag stands, outside quoted values; -1 without one."""
        while True:
            found = TAG_PART.search(self.page, start)
            if found is None:
                return -1
            if found[0] == ">":
                return found.start()
            quote = found[0][-1]
            after = self.find(quote, found.end())
            start = after + 1 if after >= 0 else found.end()

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        """``(kind, name, rest)``: text, start, end; comments and declarations are passed over."""
        page, at = self.page, 0
        while at < len(page):
            opens = self.find("<", at)
            if opens != at:
                yield "text", "", page[at : opens if opens >= 0 else len(page)]
                if opens < 0:
                    return
            at = opens
            named = TAG_NAME.match(page, at)
            if named is None:
                if page.startswith("<!--", at):
                    end = self.find("-->", at + 4)
                    at = end + 3 if end >= 0 else len(page)
                elif page.startswith(("<!", "<?", "</"), at):
                    end = self.find(">", at + 2)
                    at = end + 1 if end >= 0 else len(page)
                else:
                    yield "text", "", "<"
                    at += 1
                continue
            end = self.end_of_tag(named.end()) if self.find(">", at) >= 0 else -1
            if end < 0:
                return  # a tag that is never closed hides the rest
            name = named[2].lower()
            yield "end" if named[1] else "start", name, page[named.end() : end]
            at = end + 1
            if not named[1] and name in RAW and name not in self.missing:
                close = RAW_END[name].search(page, at)
                if close is None:
                    self.missing.add(name)
                at = close.start() if close else len(page)


class Tree:
    """Builds nodes; elements that HTML lets authors leave open are closed where browsers close them."""

    def __init__(self, page: str):
        self.root = self.now = Node("html", None, False)
        self.opened: Counter[str] = Counter()  # open elements by tag: what is not open is not looked for
        self.doubts = False
        for kind, name, rest in Marks(page):
            if kind == "text":
                self.text(rest)
            elif kind == "start":
                self.start(name, [(m[1].lower(), unescape(m[2] or m[3] or m[4] or "")) for m in ATTRIBUTE.finditer(rest)])
            else:
                self.end(name)

    def start(self, tag: str, attrs: list[tuple[str, str]]) -> None:
        if tag in ("html", "body"):
            return
        if tag in ENDS_PARAGRAPH:
            self.end_open({"p"}, BLOCK - {"p"})
            if tag in HEADINGS and self.now.tag in HEADINGS:
                self.leave(self.now)
        if tag in ENDED_BY:
            self.end_open(*ENDED_BY[tag])
        mark, named = self.marked(tag, attrs)
        self.doubts |= mark is not None
        node = Node(tag, self.now, self.now.dropped or self.boilerplate(tag, attrs), mark, named)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node
            self.opened[tag] += 1

    def end(self, tag: str) -> None:
        if not self.opened[tag]:
            return
        node = self.now
        while node.tag != tag:
            if node.tag in ("td", "th", "table") and tag not in BLOCK:
                return
            node = node.parent
        self.leave(node)

    def text(self, data: str) -> None:
        if not self.now.dropped:
            self.now.children.append(unescape(data))

    def leave(self, node: Node) -> None:
        """Close an open element and all that are open in it."""
        while self.now is not node.parent:
            self.opened[self.now.tag] -= 1
            self.now = self.now.parent

    def end_open(self, tags: set[str], until: frozenset[str] | set[str]) -> None:
        """Close open elements of ``tags`` up to the nearest of ``until``."""
        node, last = self.now, None
        if not any(self.opened[t] for t in tags):
            return
        while node.parent is not None and node.tag not in until:
            if node.tag in tags:
                last = node
            node = node.parent
        if last is not None:
            self.leave(last)

    def boilerplate(self, tag: str, attrs) -> bool:
        if tag in SILENT:
            return True
        if tag == "header":
            return not self.now.content
        for name, value in attrs:
            if not value:
                continue
            if name == "role" and value.strip().lower() in BOILERPLATE_ROLES or name == "aria-hidden" and value.strip().lower() == "true":
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                return True
        return any(name == "hidden" for name, _ in attrs)

    def marked(self, tag: str, attrs) -> tuple[str | None, bool]:
        """What marks an element as doubtful, if anything does, and whether a whole name of it means boilerplate."""
        mark, named = "form" if tag == "form" else None, False
        listed = NOT_CONTENT if tag in CONTENT else BOILERPLATE
        for name, value in attrs:
            if name == "role" and value.strip().lower() == "form":
                mark = mark or "form"
            if name not in ("class", "id"):
                continue
            names = [{w.lower() for w in NAME.findall(x)} for x in value.split()]
            found = set().union(*names) & listed
            if not found or self.now.content and found == {"header"}:
                continue
            mark = value if mark is None or name == "class" else mark
            named |= any(words & listed and words <= listed | NEUTRAL for words in names)
        return mark, named


def settle(tree: Tree) -> None:
    """Drop doubtful elements, except where they hold most of the page's unlinked text or of its articles.

    Elements with the same mark are one: posts of a list do not hold most of it one by one. Where a whole name means
    boilerplate, hardly anything may be left without the element, and its text does not count for the others.
    """
    if not tree.doubts:
        return
    nodes, together = in_order(tree.root), Counter()
    for node in reversed(nodes):
        below = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        if node.tag != "a":
            own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
            node.prose = own + sum(c.prose for c in below)
            node.clear = 0 if node.named else own + sum(c.clear for c in below)
        node.article = node.prose if node.tag in CONTENT and node.mark is None else sum(c.article for c in below)
        if node.mark is not None and node.parent.mark != node.mark:
            together[node.mark] += node.clear
    total, clear, articles = tree.root.prose, tree.root.clear, tree.root.article
    for node in nodes:
        if node.mark is None:
            continue
        own = together[node.mark]
        most = 2 * own > clear and (own >= LEAST_PROSE or own >= clear)
        alone = node.prose >= LEAST_PROSE and total - node.prose < LEAST_PROSE
        holds = 2 * node.article > articles and 4 * node.article > total
        node.dropped = not (holds or (alone if node.named else most))


def blocks(node: Node) -> list[str]:
    """The texts between block boundaries below a node, white space folded, without empty ones."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = GAPS.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append(text)

    def visit(todo: Node) -> None:
        stack: list[tuple[Node, int]] = [(todo, 0)]
        while stack:
            current, at = stack.pop()
            if at == 0 and current.tag in BLOCK:
                flush()
            while at < len(current.children):
                child = current.children[at]
                at += 1
                if isinstance(child, str):
                    run.append(child)
                elif child.dropped:
                    if child.tag in BLOCK:
                        flush()
                elif child.tag == "br":
                    run.append(" ")
                else:
                    stack.append((current, at))
                    stack.append((child, 0))
                    break
            else:
                if current.tag in BLOCK:
                    flush()

    visit(node)
    flush()
    return out


def in_order(root: Node) -> list[Node]:
    """All kept nodes, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return out


def score(nodes: list[Node]) -> None:
    """Sizes, linked sizes and points, children before parents."""
    for node in reversed(nodes):
        own = [c for c in node.children if isinstance(c, str)]
        size = sum(len(t.strip()) for t in own)
        below = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        node.size = size + sum(c.size for c in below)
        node.linked = node.size if node.tag == "a" else sum(c.linked for c in below)
    for node in nodes:
        if node.tag not in BLOCK or node.tag in HEADINGS or not node.size:
            continue
        direct, stack = [], [node]
        while stack:  # the text of this block alone
            for child in stack.pop().children:
                if isinstance(child, str):
                    direct.append(child)
                elif not child.dropped and child.tag not in BLOCK:
                    stack.append(child)
        text = "".join(direct).strip()
        if not text:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3.0)
        above = node.parent if node.tag in ("p", "pre", "td", "li", "blockquote", "dd") else node
        while above is not None and points > 1e-3:
            above.points += points
            points /= 2
            above = above.parent
    for node in nodes:
        node.points *= 1 - node.linked / max(node.size, 1)


def main_text(html: str) -> str:
    """The kept blocks of a page, in page order, joined by empty lines; empty if there are none."""
    tree = Tree(html)
    settle(tree)
    nodes = in_order(tree.root)
    score(nodes)
    best = max(nodes, key=lambda n: n.points)
    if best.points <= 0:
        return "\n\n".join(blocks(tree.root)) if best.size else ""
    top = best
    above = best
    while above is not None:  # all of an article, not only its best part
        if above.tag in CONTENT:
            top = above
            break
        above = above.parent
    if top.parent is None:
        return "\n\n".join(blocks(top))
    least = max(LEAST_SIBLING, SIBLING_SHARE * best.points)
    kept: list[str] = []
    for node in top.parent.children:
        if isinstance(node, str) or node.dropped:
            continue
        alike = node.tag == top.tag and node.points >= least
        prose = node.tag == "p" and node.size > 80 and node.linked < MOST_LINKED * node.size
        title = node.tag in HEADINGS and not top.tag == "article" and node.linked < MOST_LINKED * max(node.size, 1)
        if node is top or alike or node.points >= least and top.tag != "article" or prose and top.tag != "article" or title:
            kept += blocks(node)
    return "\n\n".join(kept)


def extracted(html: Column) -> Column:
    return F.arrow_udf(lambda pages: pa.array([main_text(p) for p in pages.to_pylist()], pa.string()), "string")(html)


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; null and empty pages have an empty text."""
    rows = pages.select("page_id", "url", extracted(whole_text("html")).alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
