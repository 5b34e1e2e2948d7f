"""Block trees of HTML pages and their alignment by simple tree matching.

A page becomes a tree of its block elements. A stretch of text between two block tags,
with references decoded and white space turned into single spaces, is a leaf (sign "#"),
or the text of its element if that holds nothing else. Inline tags leave no node. What is no prose by its tag, role or name
(menus, scripts, forms, ...) is not part of the tree. Tags that a page leaves open
are closed as browsers do: a block tag ends a paragraph, a list item the one before.

Two nodes match if they have the same sign (tag, classes, id; digits count as equal);
their children are matched in order so that the matched subtrees are largest, equal
ones counting one more.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import xxhash

# Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var".split()
)
NO_PROSE = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form frameset head iframe input map math menu meter nav"
    " noframes noscript object optgroup option progress script select style svg template textarea title video xmp".split()
)
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li main menu nav ol p pre section summary table ul".split()
)
# A start tag ends an open element of these kinds, unless one of the listed containers was opened since.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tr"}, {"table"}),
}
IN_HEAD = frozenset("base head link meta noscript script style template title".split())
STRUCTURE = frozenset("html body div section main article center td table tbody tr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
# Words in classes and ids of what is no part of an article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs consent cookie cookies disclaimer"
    " disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination popup"
    " popups promo promos promoted promotion recommendation recommendations recommended related replies reply respond share sharing"
    " sidebar sidebars signup social sponsor sponsored sponsors subscribe subscription teaser toast toolbar widget widgets".split()
)
ARTICLE_NAMES = frozenset("article entry post story".split())

# Elements nested deeper than this add their texts to the last node above.
DEEPEST = 120

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DIGITS = re.compile(r"\d+")


class Node:
    """A block element or a stretch of text. mark is the text's hash, which is all that a template knows of it.

    shape and content identify the subtree without and with its texts, within one process.
    """

    __slots__ = ("sign", "children", "text", "mark", "size", "shape", "content", "place")

    def __init__(self, sign: str, text: str = "", mark: int = 0):
        self.sign, self.text, self.mark, self.children = sign, text, mark, []

    @property
    def tag(self) -> str:
        return re.split(r"[.#]", self.sign, maxsplit=1)[0]

    def walk(self) -> Iterator[Node]:
        open_ = [self]
        while open_:
            node = open_.pop()
            yield node
            open_.extend(reversed(node.children))


def seal(root: Node) -> Node:
    """Number the nodes from the root on; fill in size, shape and content."""
    nodes = list(root.walk())
    for place, node in enumerate(nodes):
        node.place = place
    for node in reversed(nodes):
        kids = node.children
        if kids:
            node.size = 1 + sum([k.size for k in kids])
            node.shape = hash((node.sign, *[k.shape for k in kids]))
            node.content = hash((node.sign, node.mark, *[k.content for k in kids]))
        else:
            node.size, node.shape, node.content = 1, hash(node.sign), hash((node.sign, node.mark))
    return root


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def _is_aside(tag: str, attributes: dict[str, str], around: list[tuple[str, Node | None]]) -> bool:
    """Whether an element inside the open ones is no part of an article by its tag, role, names or style."""
    if tag in NO_PROSE:
        return True
    if tag == "header" and not any(name in ("article", "main") for name, _ in around):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in ROLES:
        return True
    if tag in ("article", "main") and "comment" not in attributes.get("class", "").lower():
        return False
    words = {w.lower() for name in ("class", "id") for w in _WORD.findall(attributes.get(name, ""))}
    if words & NAMES or any(w.startswith("comment") for w in words):
        return True
    return "header" in words and not words & ARTICLE_NAMES and not any(name in ("article", "main") for name, _ in around)


def _sign(tag: str, attributes: dict[str, str]) -> str:
    names = sorted(_DIGITS.sub("0", c) for c in attributes.get("class", "").split())
    main = attributes.get("role", "").lower() == "main" or attributes.get("itemprop", "").lower() == "articlebody"
    return ".".join(["main" if main else tag, *names]) + ("#" + _DIGITS.sub("0", attributes["id"]) if attributes.get("id") else "")


def parse(page: str) -> Node:
    """The block tree of a page. Text outside of any element belongs to the root; an empty page has a root alone."""
    root = Node("html")
    # Open elements: name, node that takes what they hold (None: nothing is taken).
    open_: list[tuple[str, Node | None]] = [("html", root)]
    run: list[str] = []

    def flush() -> None:
        if run:
            node = next(taker for name, taker in reversed(open_) if name not in INLINE)
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if node is not None and text:
                node.children.append(Node("#", text, xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1))

    def close(place: int) -> None:
        flush()
        for _, node in open_[place:]:
            if node is not None and len(node.children) == 1 and node.children[0].sign == "#" and node is not root:
                node.text, node.mark = node.children[0].text, node.children[0].mark
                node.children = []
        del open_[place:]

    def end(names, barriers=()) -> None:
        for place in range(len(open_) - 1, 0, -1):
            if open_[place][0] in names:
                return close(place)
            if open_[place][0] in barriers:
                return

    at, size, last = 0, len(page), page.rfind(">")
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at and open_[-1][1] is not None:
            run.append(page[at:start])
        match = _TAG.match(page, start) if start < last or page.startswith("<!--", start) else None
        if match is None:
            # A sign that opens no tag is text.
            if start < size and open_[-1][1] is not None:
                run.append("<")
            at = start + 1
            continue
        at = match.end()
        closing, tag, rest = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag in INLINE:
                # An inline end tag closes its own element only, never a block around it.
                place = len(open_) - 1
                while place and open_[place][0] in INLINE and open_[place][0] != tag:
                    place -= 1
                if place and open_[place][0] == tag:
                    del open_[place:]
            elif tag != "body" and tag != "html":
                flush()
                end((tag,))
            continue
        if tag in ("br", "wbr"):
            if tag == "br" and open_[-1][1] is not None:
                run.append(" ")
            continue
        if tag in INLINE:
            # Only an inline element that is no prose is kept open, until it or the block around it ends.
            if rest and open_[-1][1] is not None and _is_aside(tag, _attributes(rest), open_):
                open_.append((tag, None))
            continue
        if len(open_) > 1 and open_[1][0] == "head" and tag not in IN_HEAD:
            close(1)
        if tag in ENDS_PARAGRAPH:
            end(("p",), ("table", "td", "th", "button"))
        if tag in ENDS:
            end(*ENDS[tag])
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            after = _RAW_END[tag].search(page, at)
            at = after.end() if after else size
            continue
        if tag in ("html", "body"):
            flush()
            if tag == "body" and root.children == []:
                open_.append((tag, root))
            continue
        attributes = _attributes(rest) if rest and rest != " " else {}
        parent = open_[-1][1]
        flush()
        if parent is None or _is_aside(tag, attributes, open_):
            open_.append((tag, None))
            continue
        if len(open_) > DEEPEST:
            if len(open_) < 4 * DEEPEST:
                open_.append((tag, parent))
            continue
        node = Node(_sign(tag, attributes) if attributes else tag)
        parent.children.append(node)
        open_.append((tag, node))
    close(1)
    return seal(root)


class Matching:
    """Simple tree matching; weights of subtrees of two shapes are computed once."""

    def __init__(self):
        self._weights: dict[tuple[int, int], int] = {}

    def weight(self, a: Node, b: Node) -> int:
        """The number of nodes matched between two subtrees with the same sign, texts aside."""
        key = (a.shape, b.shape)
        if key not in self._weights:
            self._weights[key] = 1 + sum(
                x.size if x.shape == y.shape else self.weight(x, y) for x, y in self._match(a.children, b.children)
            )
        return self._weights[key]

    def _match(self, left: list[Node], right: list[Node]) -> list[tuple[Node, Node]]:
        """Pairs of children in order, of the greatest total weight; equal ends are paired at once."""
        pairs, first = [], 0
        while first < min(len(left), len(right)) and left[first].content == right[first].content:
            pairs.append((left[first], right[first]))
            first += 1
        a, b = len(left), len(right)
        ends = []
        while min(a, b) > first and left[a - 1].content == right[b - 1].content:
            a, b = a - 1, b - 1
            ends.append((left[a], right[b]))
        return pairs + self._between(left[first:a], right[first:b]) + ends[::-1]

    def _between(self, left: list[Node], right: list[Node]) -> list[tuple[Node, Node]]:
        if not left or not right:
            return []
        if len(left) == len(right) == 1:
            return [(left[0], right[0])] if left[0].sign == right[0].sign else []
        mine, theirs = (np.array([(hash(n.sign), n.shape, n.content, n.size) for n in nodes]) for nodes in (left, right))
        if len(left) * len(right) > 1 << 20:
            return self._halved(left, right, mine, theirs)
        weights = self._weigh(left, right, mine, theirs)
        table = np.zeros((len(left) + 1, len(right) + 1), np.int64)
        for i in range(len(left)):
            np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + weights[i]), out=table[i + 1, 1:])
        table, pairs, i, j = table.tolist(), [], len(left), len(right)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((left[i], right[j]))
        return pairs[::-1]

    def _weigh(self, left, right, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """The weights of all pairs; mine and theirs hold sign, shape, content and size."""
        same = mine[:, 1, None] == theirs[None, :, 1]
        weights = np.where(same, mine[:, 3, None], 0) + (mine[:, 2, None] == theirs[None, :, 2])
        for i, j in np.argwhere((mine[:, 0, None] == theirs[None, :, 0]) & ~same).tolist():
            weights[i, j] = self.weight(left[i], right[j])
        return weights

    def _halved(self, left, right, mine, theirs) -> list[tuple[Node, Node]]:
        """The same for long lists in memory for one row: split the right side where both halves of the left do best."""
        half, best = len(left) // 2, []
        for order, turn in ((range(half), 1), (range(len(left) - 1, half - 1, -1), -1)):
            sums = np.zeros(len(right) + 1, np.int64)
            for i in order:
                row = self._weigh(left[i : i + 1], right, mine[i : i + 1], theirs)[0][::turn]
                sums[1:] = np.maximum.accumulate(np.maximum(sums[1:], sums[:-1] + row))
            best.append(sums[::turn])
        split = int((best[0] + best[1]).argmax())
        return self._between(left[:half], right[:split]) + self._between(left[half:], right[split:])

    def align(self, a: Node, b: Node) -> dict[int, Node]:
        """The node of b that each node of a (by its place) is matched with; the roots always match."""
        found, open_ = {}, [(a, b)]
        while open_:
            x, y = open_.pop()
            found[x.place] = y
            open_ += self._match(x.children, y.children)
        return found
