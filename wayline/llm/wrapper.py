"""Main text of web pages by wrapper induction.

Pages of one host share a template. Every page is reduced to its tree of containers, with runs of equal
siblings folded. The tree of a host's first page is the reference; every page's tree is aligned with it by
simple tree matching, and for every node of the reference Spark tells over the host's pages whether its own text
(outside the containers in it) varies. Text that two different pages share at one node is the template's. What
varies is content, in however many containers it is. Nodes that only one page or copies of one page have, or that
the reference lacks, tell nothing: they are content if marked as an article, and in a page without such marks.
Of marked nodes all are content, whatever their text; where one holds others of a higher mark, its own text is
content unless it is the template's. Parts that are no article whatever they hold (menus, forms, adverts,
comments ...) are left out. A page that has nothing but the template's text is judged on its own, as is a host of
one page or of copies of one.

Cases: null and empty html give an empty text; a null url is a host of its own name, ''; repeated rows are pages
like any others; unclosed tags end as HTML ends them; other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.dom import INLINE, RAW, Node, matching, parse

#: Parts that pages of one host are dealt out in, so that none lands in one task.
SALTS = 64

# Elements and words of class, id or role that no article text has.
NO_ARTICLE = RAW | frozenset("aside button dialog footer form head menu nav noscript object select svg template".split())
#: Of these those that a page may be built in: what holds the main heading is the page, not a part of it.
AROUND = frozenset("aside dialog form".split())
NO_ARTICLE_MARKS = frozenset(
    """ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo
    cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted
    related replies reply search share sharing sidebar skip social sponsor sponsored subscribe toolbar widget""".split()
)
#: What goes with these words in names of parts (ad-box, comment-list); with any other word a name means something else.
NEUTRAL_MARKS = frozenset(
    """area article bar block bottom box button buttons container content entry group icons inner item items left link links list main outer
    page panel policy post posts right section site story thread top wrap wrapper""".split()
)
ARTICLE_MARKS = frozenset("article content entry main post story".split())
HEADERS, HEADER_MARKS = frozenset({"header"}), frozenset({"header", "masthead"})


@lru_cache(maxsize=4096)
def names_part(name: str, words: frozenset) -> bool:
    """Whether a name as a whole is one of the words, maybe with others of them, neutral words and numbers."""
    parts = re.findall("[a-z0-9]+", name)
    rest = [x for x in parts if x not in words]
    return len(rest) < len(parts) and all(x in NEUTRAL_MARKS or x[0].isdigit() for x in rest)


def dropped(node: Node, inside: bool) -> bool:
    """Whether a part is none of the article; headers are, but for those inside it. What holds the page's main heading
    or main element is no such part, whatever its element or name."""
    if node.tag in NO_ARTICLE or not inside and node.tag in HEADERS:
        return not (node.title and node.tag in AROUND)
    if not node.marks or node.tag in ("html", "body", "article", "main"):
        return False
    if not node.title and any(names_part(name, NO_ARTICLE_MARKS) for name in node.marks):
        return True
    return not inside and any(names_part(name, HEADER_MARKS) for name in node.marks)


def is_article(tag: str, marks: frozenset) -> int:
    return 3 if tag == "article" else 2 if tag == "main" else 1 if marks & ARTICLE_MARKS else 0


class Outline:
    """Containers of a page in preorder, with runs of equal siblings folded, and the blocks of text in each."""

    def __init__(self, root: Node):
        self.tree: list[tuple[int, str]] = []
        self.spans: list[list[int]] = []
        self.blocks: list[str] = []
        now: list[str] = []
        # on the stack: text, an element (with depth, inside an article, a container), or the end of a block or container
        todo: list = [(root, 0, False, True)]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                now.append(x)
                continue
            inline = isinstance(x, tuple) and x[0].tag in INLINE
            if now and not inline:
                if text := " ".join("".join(now).split()):
                    self.blocks.append(text)
                now.clear()
            if isinstance(x, int):
                if x >= 0:
                    self.spans[x][1] = len(self.blocks)
                continue
            node, depth, inside, container = x
            if container:
                todo.append(len(self.tree))
                self.tree.append((depth, " ".join([node.tag, *sorted(node.marks)])))
                self.spans.append([len(self.blocks), 0])
            elif not inline:
                todo.append(-1)
            elif node.tag == "br":
                now.append(" ")
            inside = inside or is_article(node.tag, node.marks) > 0
            before, kids = None, []
            for y in node.children:
                if isinstance(y, str):
                    kids.append(y)
                elif dropped(y, inside):
                    if y.tag not in INLINE:
                        kids.append(-1)
                else:
                    below = False
                    if container and y.tag not in INLINE:
                        marked = is_article(y.tag, y.marks)
                        if marked or any(isinstance(z, Node) and z.tag not in INLINE for z in y.children):
                            below = bool(marked) or (y.tag, y.marks) != before
                            before = (y.tag, y.marks)
                    kids.append((y, depth + 1, inside, below))
            kids.reverse()
            todo += kids

    def text(self, at: int) -> str:
        return "\n\n".join(self.blocks[slice(*self.spans[at])])

    def owners(self) -> list[int]:
        """The innermost container of each block."""
        owner = [0] * len(self.blocks)
        for k, (start, end) in enumerate(self.spans):
            owner[start:end] = [k] * (end - start)
        return owner

    def held(self) -> list[int]:
        """Digest of the text of each container outside the containers in it."""
        own: list[list[str]] = [[] for _ in self.spans]
        for k, block in zip(self.owners(), self.blocks, strict=True):
            own[k].append(block)
        texts = ["\n\n".join(x) for x in own]
        return [xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t in texts]


def content(tree: list, states: list[bool | None], filled: list[bool]) -> list[bool]:
    """Whether each node's own text is content; states: whether it varies, None where pages do not tell."""
    marked = [is_article(tag, frozenset(words)) for tag, *words in (label.split(" ") for _, label in tree)]
    path, best, up = [], [0] * len(tree), [-1] * len(tree)  # best: the highest mark in a node that has text
    full = list(filled)
    for i, (depth, _) in enumerate(tree):
        path[depth:] = [i]
        up[i] = path[depth - 1] if depth else -1
    for i in reversed(range(len(tree))):
        if full[i]:
            best[i] = max(best[i], marked[i])
        if up[i] >= 0:
            full[up[i]], best[up[i]] = full[up[i]] or full[i], max(best[up[i]], best[i])
    inside, whole = [False] * len(tree), [False] * len(tree)
    for i in range(len(tree)):
        mark = marked[i] > 0 and full[i]
        inside[i] = mark or up[i] >= 0 and inside[up[i]]
        whole[i] = mark and best[i] == marked[i] or up[i] >= 0 and whole[up[i]]
    any_mark = any(whole)
    out = [whole[i] or (state if state is not None else inside[i] or not any_mark) for i, state in enumerate(states)]
    return out if any(x and y for x, y in zip(out, filled, strict=True)) else [True] * len(tree)


def coded(tree: list[tuple[int, str]]) -> str:
    return "\n".join(f"{depth} {label}" for depth, label in tree)


def decoded(text: str) -> list[tuple[int, str]]:
    return [(int(depth), label) for depth, _, label in (line.partition(" ") for line in text.split("\n"))]


@lru_cache(maxsize=64)
def aligned(tree: str, reference: str) -> dict[int, int]:
    return matching(decoded(tree), decoded(reference))


def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (host, page_id, html) -> the page's containers."""
    for batch in batches:
        pages = [Outline(parse(html)) for html in batch.column(2).to_pylist()]
        columns = [pa.array([coded(x.tree) for x in pages], pa.string()), pa.array([x.held() for x in pages], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["host", "page_id", "tree", "digests"])


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (host, tree, digests, page, reference) -> what a page's containers put into the reference's."""
    for batch in batches:
        rows = []
        for host, tree, digests, page, reference in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows += [(host, j, digests[i], page) for i, j in aligned(tree, reference).items()]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "node", "digest", "page"])


def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (page_id, url, html, reference, varying, constant) -> the page's main text."""
    for batch in batches:
        out = []
        for html, reference, *nodes in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
            page, states = Outline(parse(html)), {}
            for j in nodes[0] or ():
                states[j] = True
            for j in nodes[1] or ():
                states[j] = False
            match, owners = aligned(coded(page.tree), reference) if reference else {}, page.owners()
            owning = set(owners)
            kept = content(page.tree, [states.get(match.get(i)) for i in range(len(page.tree))], [i in owning for i in range(len(page.tree))])
            out.append("\n\n".join(block for k, block in zip(owners, page.blocks, strict=True) if kept[k]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of pages(page_id, url, html)."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    seen = rows.select("host", "page_id", "html").mapInArrow(outlines, "host string, page_id long, tree string, digests array<long>")
    salt = lambda *names: F.pmod(F.xxhash64(*names), F.lit(SALTS)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    first = seen.groupBy("host").agg(F.min(F.struct("page_id", "tree")).getField("tree").alias("reference"))
    pairs = seen.withColumn("page", F.xxhash64("tree", "digests")).withColumn("salt", salt("page_id")).join(first.withColumn("salt", each), ["host", "salt"])
    parts = pairs.select("host", "tree", "digests", "page", "reference").mapInArrow(held, "host string, node int, digest long, page long")
    nodes = parts.groupBy("host", "node").agg((F.min("digest") < F.max("digest")).alias("differs"), (F.min("page") < F.max("page")).alias("told"))
    per_host = nodes.groupBy("host").agg(F.collect_list(F.when(F.col("differs"), F.col("node"))).alias("varying"), F.collect_list(F.when(~F.col("differs") & F.col("told"), F.col("node"))).alias("constant"))
    chosen = per_host.join(first, "host").withColumn("salt", each)
    found = rows.withColumn("salt", salt("page_id", "url")).join(chosen, ["host", "salt"], "left")
    return found.select("page_id", "url", "html", "reference", "varying", "constant").mapInArrow(contents, "page_id long, url string, text string")
