"""A forgiving HTML tree, and the matching of two trees."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_QUOTE = re.compile("[>\"']")
#: A tag without quotes.
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>\"']*)>")
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")

# Fixed values of HTML: elements by the way they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: A start tag that ends an open one of these before it, up to one of the limits.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Node:
    __slots__ = ("children", "marks", "tag", "title")

    def __init__(self, tag: str, marks: frozenset = frozenset()):
        self.tag, self.marks, self.children = tag, marks, []
        #: whether the page's main heading or main element is in it
        self.title = tag in ("h1", "main")


def marks(attributes: str) -> frozenset:
    """The names in an element's class, id and role."""
    return frozenset(name for m in _ATTRIBUTE.finditer(attributes) for name in (m[2] or m[3] or m[4] or "").lower().split())


def tokens(html: str) -> Iterator[tuple[str, str | None, str, int]]:
    """(text, None, "", end) and ("" or "/", tag, attributes, end) one after the other, in time linear in the page: a tag
    without an end is text, and where a quote is never closed quotes end to count."""
    at, size, last, quotes = 0, len(html), html.rfind(">"), True
    while at < size:
        if html[at] != "<":
            end = html.find("<", at)
            end = size if end < 0 else end
            at = (yield html[at:end], None, "", end) or end
            continue
        if plain := _PLAIN.match(html, at) if at < last else None:
            at = (yield plain[1], plain[2].lower(), plain[3], plain.end()) or plain.end()
            continue
        if html.startswith("<!--", at):
            end = html.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), at):
            end = html.find(">", at)
            at = size if end < 0 else end + 1
            continue
        m = _NAME.match(html, at + 1) if at < last else None
        if not m:
            at = (yield "<", None, "", at + 1) or at + 1
            continue
        end = m.end()
        while quotes and (q := _QUOTE.search(html, end)) and q[0] != ">":
            close = html.find(q[0], q.end())
            if close < 0 or close > last:
                quotes = False
            else:
                end = close + 1
        close = html.find(">", end if quotes else m.end())
        name = m[0]
        attributes = html[m.end() : close]
        tag = name.lstrip("/").lower()
        at = (yield "/" * name.startswith("/"), tag, attributes, close + 1) or close + 1


def parse(html: str) -> Node:
    """The tree of a page: unclosed elements end where HTML ends them, stray end tags are left out."""
    root = Node("#page")
    stack, opened = [root], defaultdict(int)

    def close(k: int) -> None:
        while len(stack) > k:
            opened[stack.pop().tag] -= 1

    source, skip = tokens(html), None
    while True:
        try:
            text, tag, attributes, end = source.send(skip) if skip else next(source)
        except StopIteration:
            return root
        skip = None
        if tag is None:
            stack[-1].children.append(unescape(text))
            continue
        if text:
            if opened[tag] > 0:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        elif tag in CLOSES:
            same, limits = CLOSES[tag]
            if any(opened[x] > 0 for x in same):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in same:
                        close(k)
                        break
                    if stack[k].tag in limits:
                        break
        node = Node(tag, marks(attributes) if "=" in attributes else frozenset())
        stack[-1].children.append(node)
        if node.title:
            for up in reversed(stack):
                if up.title:
                    break
                up.title = True
        if tag in RAW:
            found = re.compile(rf"</{tag}\s*>", re.I).search(html, end)
            skip = found.end() if found else len(html)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened[tag] += 1


def families(tree: list) -> tuple[list[list[int]], list[int]]:
    """The children of every node of a tree in preorder, and how many nodes it has with all below."""
    kids, path, size = [[] for _ in tree], [], [1] * len(tree)
    for i, (depth, _) in enumerate(tree):
        del path[depth:]
        if path:
            kids[path[-1]].append(i)
        path.append(i)
    for i in range(len(tree) - 1, -1, -1):
        size[i] += sum(size[k] for k in kids[i])
    return kids, size


def matching(a: list, b: list) -> dict[int, int]:
    """Simple tree matching of two trees given in preorder as (depth, label): pairs of matched nodes, as many as
    keep ancestors and the order of siblings; roots match whatever their labels.

    Equal subtrees match whole, and equal ones at either end of two rows of siblings match each other: no matching has
    more pairs. Only what differs is compared further.
    """
    if not a or not b:
        return {}
    (of_a, size_a), (of_b, size_b) = families(a), families(b)
    known: dict[tuple, int] = {}

    def shapes(tree: list, kids: list) -> list[int]:
        out = [0] * len(tree)
        for i in range(len(tree) - 1, -1, -1):
            out[i] = known.setdefault((tree[i][1], *(out[k] for k in kids[i])), len(known))
        return out

    shape_a, shape_b = shapes(a, of_a), shapes(b, of_b)
    score: dict[tuple[int, int], int] = {}
    table: dict[tuple[int, int], tuple[int, int, list[list[int]]]] = {}

    def worth(i: int, j: int) -> int:
        """Pairs among subtrees whose roots match; those below are known."""
        if a[i] != b[j]:
            return 0
        return size_a[i] if shape_a[i] == shape_b[j] else score[i, j]

    def ends(x: list[int], y: list[int]) -> tuple[int, int]:
        head, most = 0, min(len(x), len(y))
        while head < most and shape_a[x[head]] == shape_b[y[head]]:
            head += 1
        tail = 0
        while tail < most - head and shape_a[x[-1 - tail]] == shape_b[y[-1 - tail]]:
            tail += 1
        return head, tail

    # pairs that need a table, those above before those below
    todo, order = [(0, 0)], []
    seen = {(0, 0)}
    while todo:
        i, j = todo.pop()
        order.append((i, j))
        head, tail = ends(of_a[i], of_b[j])
        by_label: dict[str, list[int]] = {}
        for y in of_b[j][head : len(of_b[j]) - tail]:
            by_label.setdefault(b[y][1], []).append(y)
        for x in of_a[i][head : len(of_a[i]) - tail]:
            for y in by_label.get(a[x][1], ()):
                if shape_a[x] != shape_b[y] and (x, y) not in seen:
                    seen.add((x, y))
                    todo.append((x, y))
    for i, j in sorted(order, key=lambda p: -a[p[0]][0]):
        head, tail = ends(of_a[i], of_b[j])
        middle_a, middle_b = of_a[i][head : len(of_a[i]) - tail], of_b[j][head : len(of_b[j]) - tail]
        rows = [[0] * (len(middle_b) + 1)]
        for x in middle_a:
            up, row = rows[-1], [0]
            for k, y in enumerate(middle_b):
                row.append(max(up[k + 1], row[k], up[k] + worth(x, y)))
            rows.append(row)
        same = sum(size_a[x] for x in of_a[i][:head]) + sum(size_a[x] for x in of_a[i][len(of_a[i]) - tail :])
        table[i, j], score[i, j] = (head, tail, rows), 1 + same + rows[-1][-1]
    pairs: dict[int, int] = {}

    def whole(i: int, j: int) -> None:
        pairs.update((i + k, j + k) for k in range(size_a[i]))

    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        pairs[i] = j
        head, tail, rows = table[i, j]
        x_all, y_all = of_a[i], of_b[j]
        for k in range(head):
            whole(x_all[k], y_all[k])
        for k in range(1, tail + 1):
            whole(x_all[-k], y_all[-k])
        x, y = len(x_all) - head - tail, len(y_all) - head - tail
        while x and y:
            if rows[x][y] == rows[x - 1][y]:
                x -= 1
            elif rows[x][y] == rows[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                one, other = x_all[head + x], y_all[head + y]
                if shape_a[one] == shape_b[other]:
                    whole(one, other)
                else:
                    todo.append((one, other))
    return pairs
