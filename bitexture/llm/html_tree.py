"""A page as a tree of blocks: elements that start a block, and the runs of text between them as leaves."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names by what they do to the tree.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q s samp "
    "small span strike strong sub sup time tt u var wbr ruby rt rp".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe noembed noframes xmp svg math object canvas audio video select".split())
NEVER_OPEN = {"script", "style", "title", "textarea"}  # without an end tag they take the rest of the page
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPE = {"ul", "ol", "dl", "menu", "table", "td", "th", "(page)", "div", "article", "section", "main", "aside", "nav", "blockquote"}

# Words in class, id and role that tell what an element is for; elements of that purpose.
ROLE_WORDS = {
    "advert": "ad ads advert advertisement adverts adsense sponsor sponsored promo promotion promoted banner",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "header": "header masthead topbar",
    "footer": "footer copyright colophon contentinfo",
    "sidebar": "sidebar aside rail related widget widgets recommended recommendations trending popular newsletter "
    "subscribe share sharing social complementary",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay toast disclaimer paywall",
    "form": "form search login signup",
    "comment": "comment comments disqus reply replies respond discussion",
}
ROLE_TAGS = {
    "menu": "nav menu", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "dialog",
    "form": "form fieldset button",
}
MAIN_WORDS = set("article content main post entry story body".split())
MAIN_TAGS = {"article", "main"}
ROLE_OF_WORD = {word: role for role, words in ROLE_WORDS.items() for word in words.split()}
ROLE_OF_TAG = {tag: role for role, tags in ROLE_TAGS.items() for tag in tags.split()}
GROUPS = {f"h{i}": "heading" for i in range(1, 7)} | {
    t: t for t in "p li ul ol dl dt dd blockquote pre figure figcaption table tr td th article main address".split()
}


@dataclass
class Node:
    tag: str  # empty for a run of text
    parent: int
    depth: int
    role: str = ""  # "main", a purpose other than content, or empty
    marked: bool = False  # the role comes from the element's name, not from its attributes
    pieces: list[str] = field(default_factory=list)
    linked: int = 0  # characters of text inside links
    text: str = ""


HEADINGS = {f"h{i}" for i in range(1, 7)}
COMMENT_IDS = {"comments", "disqus", "respond"}


def role_inside(tag: str, attributes: str) -> tuple[str, bool]:
    """Role of an element inside a marked article, where anchors of headings and sections name topics: there an id counts
    only if it is one of a comment list, and of headings and paragraphs only adverts are told by attributes."""
    role, marked = role_of(tag, attributes)
    if marked or role in ("", "main") or tag not in HEADINGS | {"p", "section"}:
        return role, marked
    if tag == "section":
        plain = ATTRIBUTE.sub(
            lambda m: "" if m[1].lower() == "id" and (m[2] or m[3] or m[4] or "").lower() not in COMMENT_IDS else m[0], attributes
        )
        return role_of(tag, plain)
    return (role, marked) if role == "advert" else ("", False)


def role_of(tag: str, attributes: str) -> tuple[str, bool]:
    if tag in ROLE_OF_TAG:
        return ROLE_OF_TAG[tag], True
    if tag in MAIN_TAGS:
        return "main", True
    words = [w.lower() for m in ATTRIBUTE.finditer(attributes) for w in WORD.findall(m[2] or m[3] or m[4] or "")]
    roles = [ROLE_OF_WORD[w] for w in words if w in ROLE_OF_WORD]
    main = any(w in MAIN_WORDS for w in words)
    if roles and not (main and set(roles) <= {"header"}):
        return roles[0], False
    return ("main", False) if main else ("", False)


class _Builder:
    def __init__(self):
        self.nodes = [Node("(page)", -1, 0)]
        self.open = [0]
        self.leaf = -1
        self.links = 0

    def text(self, raw: str) -> None:
        if not raw or (self.leaf < 0 and raw.isspace()):
            return
        if self.leaf < 0:
            self.leaf = len(self.nodes)
            self.nodes.append(Node("", self.open[-1], len(self.open)))
        leaf = self.nodes[self.leaf]
        leaf.pieces.append(raw)
        if self.links:
            leaf.linked += len(raw)

    def start(self, tag: str, attributes: str) -> None:
        self.leaf = -1
        if tag in CLOSES_P:
            self._close({"p"}, SCOPE)
        if tag in CLOSES:
            self._close(CLOSES[tag], SCOPE - {"td", "th"} if tag in ("tr", "thead", "tbody", "tfoot", "td", "th") else SCOPE)
        inside = any(self.nodes[i].role == "main" and self.nodes[i].marked for i in self.open)
        role, marked = (role_inside if inside else role_of)(tag, attributes)
        self.nodes.append(Node(tag, self.open[-1], len(self.open), role, marked))
        self.open.append(len(self.nodes) - 1)

    def _close(self, tags: set[str], scope: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.nodes[self.open[at]].tag
            if tag in tags:
                del self.open[at:]
                return self._close(tags, scope) if len(tags) > 1 else None
            if tag in scope:
                return None
        return None

    def end(self, tag: str) -> None:
        self.leaf = -1
        for at in range(len(self.open) - 1, 0, -1):
            if self.nodes[self.open[at]].tag == tag:
                del self.open[at:]
                return


def parse(page: str | None) -> list[Node]:
    """Nodes in page order, the root first. Markup, scripts, styles, titles and other raw elements leave no text."""
    page = page or ""
    builder, at = _Builder(), 0
    while True:
        token = TOKEN.search(page, at)
        if token is None:
            builder.text(page[at:])
            break
        builder.text(page[at : token.start()])
        at = token.end()
        tag = (token["name"] or "").lower()
        if not tag or tag in ("html", "body", "head"):
            continue
        if tag in RAW:
            if not token["close"] and not token[0].endswith("/>"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if stop is None and tag not in NEVER_OPEN:  # ends with its parent; on the page itself only the tag goes
                    parent = builder.nodes[builder.open[-1]].tag
                    outer = re.compile(rf"</{re.escape(parent)}\s*>", re.I).search(page, at)
                    at = outer.start() if outer else at
                else:
                    at = stop.end() if stop else len(page)
        elif tag in INLINE:
            if tag == "a":
                builder.links = max(0, builder.links - 1) if token["close"] else 1
        elif tag in VOID:
            if tag == "hr":
                builder.leaf = -1
            elif tag == "br":
                builder.text(" ")
        elif token["close"]:
            builder.end(tag)
        else:
            builder.start(tag, token["attributes"])
    for node in builder.nodes:
        if node.pieces:
            node.text = " ".join(html.unescape("".join(node.pieces)).split())
    return _settled(builder.nodes)


def _settled(nodes: list[Node]) -> list[Node]:
    """Take back roles that attributes give to wrappers: elements around a marked main element, and those around one
    marked by attributes that hold more than half of the page's text, unless they hold comments."""
    size, marked, named = ([0] * len(nodes) for _ in range(3))
    for at in range(len(nodes) - 1, -1, -1):
        node = nodes[at]
        size[at] += len(node.text)
        if node.parent >= 0:
            size[node.parent] += size[at]
            marked[node.parent] |= marked[at] or (node.role == "main" and node.marked)
            named[node.parent] |= named[at] or node.role == "main"
    for at, node in enumerate(nodes):
        if node.role and node.role != "main" and not node.marked:
            if marked[at] or (named[at] and node.role != "comment" and 2 * size[at] > size[0]):
                node.role = ""
    return nodes
