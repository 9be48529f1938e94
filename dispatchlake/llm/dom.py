"""A small, forgiving HTML reader: block elements in page order, and the text that stands in each.

End tags that HTML lets authors leave out are supplied; an end tag without its start is ignored; what is open at
the end of a page is closed there. Inline elements are not nodes unless their class or id marks them as noise;
their text belongs to the block around them.
"""

from __future__ import annotations

import re
from html import unescape

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"""
    r"""<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
DIGITS = re.compile(r"\d+")

# Element names of the HTML standard, by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = set(
    "a abbr acronym b bdi bdo big blink cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {  # start tag: open elements it ends, and those that stop the look for them
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
}
CELLS = {"td", "th", "caption", "table", "button", "object"}
# Elements and marks of what is not the article.
UNREAD = RAW | set("head template svg math canvas object audio video select button datalist map".split())
NOISE_TAGS = set("nav footer aside menu dialog form".split())
NOISE_ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense adbox banner banners sponsor sponsored promo promotion nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar toolbar cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe signup signin login search share sharing social "
    "related recommended comment comments commentlist disqus respond replies pagination pager widget skip copyright".split()
)
ARTICLE_WORDS = set("article post entry story content main".split())
LEAF_TAGS = set("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd blockquote pre table figure figcaption address hgroup".split())


class Page:
    """Nodes numbered in page order (0 is the page), and the text events between them.

    An event is (node, text), or (node, None) where a block begins or ends.
    """

    def __init__(self) -> None:
        self.tag, self.label, self.parent, self.linked = ["#page"], ["#page"], [-1], [0]
        self.noise, self.unread, self.main, self.article, self.marked = [False], [False], [False], [False], [False]
        self.events: list[tuple[int, str | None]] = []

    def add(self, tag: str, attrs: dict[str, str], parent: int, inline: bool) -> int:
        named = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        words = {w.lower() for w in WORD.findall(named)}
        role = attrs.get("role", "").lower()
        noise = tag in NOISE_TAGS or role in NOISE_ROLES or bool(words & NOISE_WORDS)
        if inline and not noise:
            return parent
        self.tag.append(tag)
        self.label.append(DIGITS.sub("0", f"{tag} {named} {role}") if named.strip() or role else tag)
        self.parent.append(parent)
        self.linked.append(0)
        self.unread.append(tag in UNREAD or self.unread[parent])
        self.noise.append(noise)
        self.main.append(not noise and (tag == "main" or role == "main" or attrs.get("itemprop") == "articleBody"))
        self.article.append(not noise and tag == "article")
        self.marked.append(not noise and bool(words & ARTICLE_WORDS))
        if tag in ("header",) or "header" in words:
            self.noise[-1] = not self._inside(parent)
        return len(self.tag) - 1

    def _inside(self, node: int) -> bool:
        """In an article or main element."""
        while node > 0:
            if self.article[node] or self.main[node]:
                return True
            node = self.parent[node]
        return False


def attributes(text: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def read(html: str) -> Page:
    page = Page()
    events = page.events
    stack: list[tuple[str, int, bool]] = [("#page", 0, False)]  # tag, node, is it a block
    links = at = 0

    def text(raw: str) -> None:
        node = stack[-1][1]
        if page.unread[node] or not raw:
            return
        raw = unescape(raw)
        events.append((node, raw))
        if links:
            page.linked[node] += len(raw.strip())

    def pop_to(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            tag, node, block = stack.pop()
            links -= tag == "a"
            if block:
                events.append((node, None))

    def close(names: set[str], barrier: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth][0]
            if tag in names:
                return pop_to(depth)
            if tag in barrier:
                return None

    for token in TOKEN.finditer(html):
        if token.start() < at:
            continue
        text(html[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if token["end"]:
            if tag in ("html", "body"):
                continue
            if tag in ("br", "p"):  # also without its start
                events.append((stack[-1][1], None))
            close({tag}, CELLS - {tag} if tag not in ("tr", "tbody", "thead", "tfoot", "table") else set())
            continue
        if tag in ("html", "body"):
            if tag == "body":
                close({"head"}, set())
            continue
        if tag in CLOSES_P:
            close({"p"}, CELLS)
        if tag in CLOSED_BY:
            names, barrier = CLOSED_BY[tag]
            while stack[-1][0] in names or any(s[0] in names for s in stack[1:]):
                before = len(stack)
                close(names, barrier)
                if len(stack) == before:
                    break
        if tag == "a":
            close({"a"}, CELLS)
        top = stack[-1][1]
        inline = tag in INLINE
        if tag in VOID:
            if not inline:
                events.append((top, None))
            continue
        node = page.add(tag, attributes(token["attrs"]) if token["attrs"].strip() else {}, top, inline)
        if not inline:
            events.append((node, None))
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
            stack.append((tag, node, not inline))
            if not end:
                break
            continue
        stack.append((tag, node, not inline))
        links += tag == "a"
    text(html[at:])
    pop_to(1)
    return page
