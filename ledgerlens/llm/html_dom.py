"""A tolerant HTML block tree with features for each block.

Only what block extraction needs: block elements become nodes, inline markup
(formulas and drawings too) is flattened into the runs of text of the block it
stands in. Only comments and the contents of script, style, title, textarea
and iframe are dropped; buttons, fallback contents and the like are blocks that
close with their parent at the latest. A block that holds both text and other
blocks gets a nameless child for each run of its own text, so every text lies
in a leaf.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr label".split())
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
#: Raw text: without an end tag these hold the rest of the page.
DROPPED = frozenset("script style title textarea iframe".split())
#: Blocks that may stand inside a paragraph.
EMBEDDED = frozenset("noscript template object select button canvas audio video datalist".split())
#: Roots of foreign content: its elements are inline, and a start tag of
#: LEAVES ends it unless an element of HOLDS is open in it.
FOREIGN = frozenset(("math", "svg"))
LEAVES = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strike strong sub sup table tt u ul var".split())
HOLDS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
#: A start tag closes an open element of these first, up to the named scope.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile(r"[>\"']")
#: Characters within which a tag's plain end is looked for first.
NEAR = 200
OTHER = re.compile(r"<[!?/a-zA-Z][^<>]*>?")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")

#: Attribute words that speak for or against main text (fixed lists).
AGAINST = frozenset(
    "nav navbar navigation menu submenu header masthead footer foot colophon sidebar side aside rail widget ad ads adv "
    "advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored cookie cookies "
    "consent notice notification gdpr privacy popup modal overlay dialog toast alert subscribe subscription newsletter "
    "signup login share sharing social follow related recommended recommendations more trending popular breadcrumb "
    "breadcrumbs pagination pager paging toolbar copyright legal disclaimer skip tags topbar ticker search form "
    "contact links partners outbrain taboola teaser toc hidden meta byline".split())
FOR = frozenset("article articlebody main content contents post entry story body text page prose markdown copy "
                "news blog read reader".split())
TALK = frozenset("comment comments commentlist reply replies respond responses response disqus discussion discussions "
                 "thread threads feedback guestbook reviews forum commenter".split())

GROUPS = {t: n for n, tags in enumerate([
    "h1 h2 h3 h4 h5 h6", "p", "li ul ol dl dt dd menu", "table tbody thead tfoot tr td th caption", "nav", "header",
    "footer", "aside", "form fieldset", "article main", "section", "figure figcaption", "blockquote pre",
    "div center", "#run", "button select option optgroup datalist template",
    "noscript object canvas audio video"]) for t in tags.split()}
N_GROUPS = 17
MARKED_TAGS = ("nav", "header", "footer", "aside", "form")
N_FEATURES = 30 + N_GROUPS + 2 * len(MARKED_TAGS)
LABEL = "data-main"


class Node:
    __slots__ = ("tag", "parent", "children", "words", "hidden", "runs", "main", "against", "for_", "talk",
                 "text", "n_words", "chars", "links", "tags", "points", "digits", "leaves", "most", "first", "last", "place")

    def __init__(self, tag: str, parent, attributes: str = ""):
        self.tag, self.parent, self.children, self.runs = tag, parent, [], []
        self.main = self.hidden = False
        self.against = self.for_ = self.talk = 0
        self.text, self.links, self.tags = "", 0, 1
        if attributes:
            self.read(attributes)

    def read(self, attributes: str) -> None:
        found = set()
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                found.update(w.lower() for w in WORD_PARTS.findall(value))
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                self.hidden = True
            elif name == "style":
                style = value.replace(" ", "").lower()
                self.hidden |= "display:none" in style or "visibility:hidden" in style
            elif name == LABEL:
                self.main = True
        self.against = len(found & AGAINST)
        self.for_ = len(found & FOR)
        self.talk = len(found & TALK)


class Tags:
    """The tags of a page, found in time linear in its length.

    A tag runs from "<" and a name to the first ">" outside quoted attribute
    values. One that has no such end is no tag; its search may have gone to the
    end of the page, so where it went is remembered: a later search that comes
    outside quotes to the same quote or ">" has the same result. ``at`` is where
    the next tag is looked for; a reader may move it forward."""

    def __init__(self, html: str):
        self.html, self.at = html, 0
        self.special: list[int] | None = None
        self.endless: set[int] = set()

    def end(self, at: int) -> int:
        """Place of the ">" that ends a tag whose attributes begin at ``at``,
        or -1."""
        html = self.html
        near = html.find(">", at, at + NEAR)
        if near >= 0 and html.find('"', at, near) < 0 and html.find("'", at, near) < 0:
            return near
        if self.special is None:
            self.special = [m.start() for m in SPECIAL.finditer(html)]
        special, way = self.special, []
        n = bisect_left(special, at)
        while n < len(special):
            at = special[n]
            if html[at] == ">":
                return at
            if at in self.endless:
                break
            way.append(at)
            closing = html.find(html[at], at + 1)
            if closing < 0:
                break
            n = bisect_left(special, closing + 1, n)
        self.endless.update(way)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, str | None, bool, str]]:
        """(start, end, name or None, whether an end tag, attributes)."""
        html = self.html
        while (start := html.find("<", self.at)) >= 0:
            name, attributes = None, ""
            m = NAME.match(html, start)
            end = -1
            if html.startswith("<!--", start):
                closing = html.find("-->", start + 4)
                end = len(html) if closing < 0 else closing + 3
            elif m:
                cut, found = m.end(), self.end(m.end())
                if found < 0:
                    # A quote in the name may start a value instead.
                    for cut in (k for k in range(m.end() - 1, m.start(1), -1) if html[k] in "\"'"):
                        found = self.end(cut)
                        if found >= 0:
                            break
                if found >= 0:
                    name, attributes, end = html[m.start(1):cut].lower(), html[cut:found], found + 1
            if end < 0:
                other = OTHER.match(html, start)
                if not other:
                    self.at = start + 1
                    continue
                end = other.end()
            self.at = end
            yield start, end, name, html.startswith("/", start + 1), attributes


class Stack:
    """Open elements: (name, node), no node for inline and foreign ones. The
    places of blocks, and of every name's blocks, are kept beside, and how many
    inline elements of a name are open since the last block, so nothing has to
    be searched through."""

    def __init__(self, root: Node):
        self.rows: list[tuple[str, Node | None]] = [("#page", root)]
        self.blocks, self.of_name = [0], {"#page": [0]}
        self.open: dict[str, int] = {}
        self.inline: list[dict[str, int]] = [{}]

    def push(self, tag: str, node: Node | None) -> None:
        if node is not None:
            self.blocks.append(len(self.rows))
            self.of_name.setdefault(tag, []).append(len(self.rows))
            self.inline.append({})
        else:
            self.inline[-1][tag] = self.inline[-1].get(tag, 0) + 1
        self.open[tag] = self.open.get(tag, 0) + 1
        self.rows.append((tag, node))

    def pop_to(self, k: int) -> list[str]:
        """Close the elements from place k on; their names."""
        names = []
        while len(self.rows) > k:
            tag, node = self.rows.pop()
            self.open[tag] -= 1
            if node is not None:
                self.blocks.pop()
                self.of_name[tag].pop()
                self.inline.pop()
            else:
                self.inline[-1][tag] -= 1
            names.append(tag)
        return names

    def nearest(self, names) -> int:
        """Place of the topmost block of one of the names, 0 if none."""
        return max((places[-1] for n in names if (places := self.of_name.get(n))), default=0)

    def block(self) -> Node:
        return self.rows[self.blocks[-1]][1]


def parse(html: str) -> list[Node]:
    """The nodes in page order (parents first); node 0 is the page."""
    root = Node("#page", None)
    nodes, stack = [root], Stack(root)  # an inline element has no node of its own
    rows = stack.rows
    block, link_depth, at = root, 0, 0
    foreign = muted = 0  # open roots of foreign content, and DROPPED ones in it

    def text(piece: str) -> None:
        if piece and not muted:
            block.runs.append((len(block.children), piece, link_depth > 0))

    def pop_to(k: int) -> None:
        nonlocal block, link_depth, foreign, muted
        for tag in stack.pop_to(k):
            link_depth -= tag == "a"
            foreign -= tag in FOREIGN
            muted -= tag in DROPPED
        block = stack.block()

    tags = Tags(html)
    for start, end, tag, closing, attributes in tags:
        if start > at:
            text(html[at:start])
        at = end
        if tag is None:
            continue
        if closing:
            # An inline end tag does not close a block.
            if (stack.inline[-1] if tag in INLINE else stack.open).get(tag):
                k = len(rows) - 1
                while rows[k][0] != tag:
                    k -= 1
                pop_to(k)
            continue
        if foreign and tag in LEAVES:
            k = len(rows) - 1
            while foreign and k > 0 and rows[k][0] not in HOLDS and rows[k][1] is None:
                if rows[k][0] in FOREIGN:
                    pop_to(k)
                k -= 1
        if tag in VOID:
            if tag == "br":
                text(" ")
            elif tag == "hr" and block.runs:
                block.children.append(None)  # separates the runs around it
            block.tags += 1
            continue
        if tag in FOREIGN or foreign and tag not in INLINE and tag not in GROUPS and tag not in EMBEDDED:
            if not attributes.endswith("/"):  # closes with the foreign content at the latest
                stack.push(tag, None)
                foreign += tag in FOREIGN
                muted += tag in DROPPED
            continue
        if tag in DROPPED:
            if not attributes.endswith("/"):
                closed = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = tags.at = closed.end() if closed else len(html)
            continue
        if tag in INLINE:
            stack.push(tag, None)
            link_depth += tag == "a"
            block.tags += 1
            continue
        closes, scope = CLOSES.get(tag, ((), ()))
        top = stack.blocks[-1]
        if tag in EMBEDDED:  # closes no paragraph, at most its like around it
            if top and rows[top][0] == tag and tag in ("button", "select"):
                pop_to(top)
        elif not closes:
            if rows[top][0] == "p":
                pop_to(top)
        else:
            k = stack.nearest(("p", *closes))
            if k > stack.nearest(scope):
                pop_to(k)
        block = Node(tag, block, attributes)
        block.parent.children.append(block)
        nodes.append(block)
        stack.push(tag, block)
        if attributes.endswith("/") and tag not in ("p", "div", "li", "td", "tr", "body", "html"):
            pop_to(len(rows) - 1)
    text(html[at:])
    _drop_empty(nodes)
    return _leaves(root)


def _drop_empty(nodes: list[Node]) -> None:
    """Embedded blocks without text go, so they do not cut the text around them."""
    empty: set[int] = set()
    for node in reversed(nodes):
        if empty and any(id(c) in empty for c in node.children):
            places, kept = [0], []
            for c in node.children:
                if id(c) not in empty:
                    kept.append(c)
                places.append(len(kept))
            node.children, node.runs = kept, [(places[k], p, link) for k, p, link in node.runs]
        if node.tag in EMBEDDED and not node.children and not any(p.strip() for _, p, _ in node.runs):
            empty.add(id(node))


def _leaves(root: Node) -> list[Node]:
    """Move runs into leaves; the nodes in page order."""
    ordered, todo = [], [root]
    while todo:
        node = todo.pop()
        ordered.append(node)
        blocks = [c for c in node.children if c is not None]
        groups: dict[int, list] = {}
        for place, piece, link in node.runs:
            groups.setdefault(place, []).append((unescape(piece) if "&" in piece else piece, link))
        filled = {}
        for place, pieces in groups.items():
            joined = " ".join("".join(p for p, _ in pieces).split())
            if joined:
                filled[place] = joined, sum(len(p.strip()) for p, link in pieces if link)
        if not blocks and len(filled) <= 1 and node is not root:
            for joined, links in filled.values():
                node.text, node.links = joined, links
        else:
            children = []
            for place in range(len(node.children) + 1):
                if place in filled:
                    run = Node("#run", node)
                    run.text, run.links = filled[place]
                    run.main = node.main
                    children.append(run)
                if place < len(node.children) and node.children[place] is not None:
                    children.append(node.children[place])
            blocks = children
        node.children, node.runs = blocks, []
        for k, child in enumerate(blocks):
            child.place = k
        todo.extend(reversed(blocks))
    return ordered


def features(nodes: list[Node]) -> list[list[float]]:
    """One row of N_FEATURES for each node, in the given order."""
    position = 0
    for n in nodes:
        words = n.text.split()
        n.n_words, n.chars = len(words), len(n.text)
        n.points = sum(n.text.count(c) for c in ".,;:!?") if n.text else 0
        n.digits = sum(map(n.text.count, "0123456789")) if n.text else 0
        n.leaves, n.most = int(bool(n.text)), n.n_words
        n.first = position
        position += n.chars
        n.last = position
    for n in reversed(nodes):
        p = n.parent
        if p is not None:
            p.n_words += n.n_words
            p.chars += n.chars
            p.points += n.points
            p.digits += n.digits
            p.links += n.links
            p.tags += n.tags
            p.leaves += n.leaves
            p.most = max(p.most, n.most)
            p.last = max(p.last, n.last)
    total = max(1, position)
    log = math.log1p
    above: dict[int, tuple] = {}
    children: dict[int, tuple] = {}
    rows = []
    for n in nodes:
        p = n.parent
        depth, against, for_, talk, marks, place, siblings = (0, 0, 0, 0, (0,) * len(MARKED_TAGS), 0, [n])
        in_article = 0
        if p is not None:
            depth, against, for_, talk, marks, in_article = above[id(p)]
            siblings = p.children
        own = GROUPS.get(n.tag, -1)
        row = [
            depth, log(n.chars), log(n.n_words), n.links / max(1, n.chars),
            n.tags / max(1, n.chars) * 100, n.n_words / max(1, n.leaves), log(n.most),
            n.points / max(1, n.n_words), log(n.leaves), n.chars / total, n.first / total, n.last / total,
            n.digits / max(1, n.chars), float(n.hidden), n.against, n.for_, n.talk, against, for_, talk,
            in_article, log(len(siblings))]
        if p is not None:
            place = n.place
        before = siblings[place - 1].n_words if p is not None and place else 0
        after = siblings[place + 1].n_words if p is not None and place + 1 < len(siblings) else 0
        if p is not None and id(p) not in children:  # once for each parent, over all its children
            children[id(p)] = Counter(s.tag for s in siblings), max(s.n_words for s in siblings)
        tags, longest = children[id(p)] if p is not None else ({n.tag: 1}, n.n_words)
        same = tags[n.tag] / len(siblings)
        row += [place / len(siblings), log(before), log(after), same, n.n_words / max(1, longest),
                n.chars / max(1, p.chars if p is not None else n.chars)]
        row += [float(own == g) for g in range(N_GROUPS)]
        own_marks = [float(n.tag == t) for t in MARKED_TAGS]
        row += own_marks
        row += marks
        # Any boilerplate tag here or above; any sign of main text here or above.
        row += [float(max(own_marks) or max(marks) or bool(n.talk or talk)),
                float(n.tag in ("article", "main") or in_article or n.for_ > 0 or for_ > 0)]
        rows.append(row)
        above[id(n)] = (depth + 1, against + n.against + n.hidden, for_ + n.for_, talk + n.talk,
                        tuple(max(a, b) for a, b in zip(marks, own_marks)),
                        in_article + (n.tag in ("article", "main")))
    return rows
