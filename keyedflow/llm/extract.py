"""Main text of web pages by wrapper induction.

Pages of a host share a template. Groups of a host's pages are aligned by simple tree matching: two elements match if their
labels do, and their children are matched in order by dynamic programming so that most elements match. Runs of like
siblings (paragraphs, list items) count as one repeated element, and elements within a match keep the texts they had in
each page. A text that all pages of the group have in the same element is part of the template and goes; an element
whose text varies is a slot, and slots are content, unless they lie in a part that is no article by its tag, class or role:
menus, headers, footers, sidebars, notices, adverts, forms, comments. Where a page marks its article, slots outside of it go too;
elsewhere, slots that are mostly links go. Pages of hosts with few pages have no induced template and are judged by
the other rules alone.

A host's pages are dealt by hash to groups of about `GROUP`, so a host that holds a third of all pages is many groups, and
no task holds more than a group. What pages of a group share is judged from distinct pages, so copies prove nothing.

Names of class, id and role count by the word that says what the part is. A part that holds the page's only marked article is not
dropped by its name, and inline elements that are adverts and the like are left out of the text around them. Pages may be nested to
any depth and be of any length; nothing is flattened or cut.

Null html is empty and gives an empty text. Null urls form one host. Repeated rows each give their row. An empty table
gives an empty one. Other columns are passed on, those with a result's name replaced.
"""

from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import keeps_other_columns, stored
from .dom import Element, parse

#: Pages of a group, in the mean; distinct pages that prove a template text, outside and inside of an article.
GROUP, PROOF, PROOF_INSIDE = 48, 4, 12

# What is no article, by tag and by word in class, id or role.
DROPPED_TAGS = frozenset("head nav aside footer form button select input menu svg canvas object audio video dialog template".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement advertising adslot banner sponsor sponsored promo promotion nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs footer sidebar aside widget related recommended recommendations share sharing social comment "
    "comments commentlist disqus reply replies respond cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe subscription signup login search pagination pager toolbar copyright hidden contentinfo complementary tags".split()
)


# What a name may hold behind the word that says what it is, and before one that it denies or mentions.
TAILS = frozenset(
    "area articles bar block body box btn button buttons container content group holder icons inner item items left link links list "
    "main news outer panel posts right row section slot text top bottom unit wrap wrapper zone".split()
)
DENIALS = frozenset("no not non without has have with is".split())


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _hidden(e: Element) -> bool:
    style = e.attributes.get("style", "").replace(" ", "").lower()
    return "hidden" in e.attributes or e.attributes.get("aria-hidden") == "true" or "display:none" in style


def _is_marked(e: Element) -> bool:
    """Whether the page says that this is its article."""
    if e.tag in ("article", "main") or e.attributes.get("itemprop", "").lower() == "articlebody":
        return True
    return e.tag in ("div", "section") and e.attributes.get("role", "").lower() in ("main", "article")


def _named_like(e: Element, words: frozenset[str]) -> bool:
    """Whether a name of the element says that it is one of these: `cookie-notice` is a notice, `sidebar-left` a sidebar,
    but `no-sidebar`, `comments-open` and `alert-story` are neither sidebar nor comments nor alert."""
    for name in e.names():
        while len(name) > 1 and (name[-1] in TAILS or name[-1].isdigit()):
            name = name[:-1]
        if name and name[-1] in words and not DENIALS & set(name):
            return True
    return False


def _is_article(e: Element) -> bool:
    if _is_marked(e):
        return True
    named = e.tag in ("div", "section") and set(e.words()) & {"article", "articlebody", "post"}
    return bool(named) and not _named_like(e, DROPPED_WORDS)


def _is_dropped(e: Element, in_article: bool, kept: set[int] | frozenset = frozenset()) -> bool:
    """kept: elements, by identity, that hold the only marked article and so are not judged by their names."""
    if e.tag in DROPPED_TAGS or _hidden(e):
        return True
    if e.tag == "header" and not in_article:
        return True
    if e.tag in ("html", "body", "article", "main") or id(e) in kept:
        return False
    return _named_like(e, DROPPED_WORDS) or (not in_article and _named_like(e, _HEADER))


_HEADER = frozenset(["header"])


def is_muted(e: Element) -> bool:
    """Whether the text of an inline element is left out."""
    return _hidden(e) or _named_like(e, DROPPED_WORDS)


def _holders(root: Element) -> set[int]:
    """Elements around marked articles, if all of these lie in parts that would be dropped by name."""
    holders: set[int] = set()
    stack = [(root, False, False)]
    while stack:
        e, by_name, inside = stack.pop()
        if e.tag in DROPPED_TAGS or _hidden(e) or (e.tag == "header" and not inside):
            continue
        inside = inside or _is_article(e)
        by_name = by_name or _is_dropped(e, inside)
        if _is_marked(e):
            if not by_name:
                return set()
            up = e
            while up is not None and id(up) not in holders:
                holders.add(id(up))
                up = up.parent
        stack += [(c, by_name, inside) for c in e.children]
    return holders


class Node:
    """An element of a page, runs of like siblings merged. texts: [place, text, link share]."""

    __slots__ = ("label", "children", "texts", "article", "key")

    def __init__(self, label: str, article: bool):
        self.label, self.article = label, article
        self.children: list[Node] = []
        self.texts: list[tuple[int, str, float]] = []


def _key(label: str, children: list) -> bytes:
    """A digest of a tree: its label and its children's digests."""
    return blake2b(label.encode("utf-8", "surrogatepass") + b"\0" + b"".join(c.key for c in children), digest_size=16).digest()


def tree_of(root: Element) -> Node:
    """The tree of what is not dropped, with runs of like siblings merged into one node each."""
    kept = _holders(root)

    def node_of(e: Element, in_article: bool) -> Node:
        node = Node(f"{e.tag}.{'.'.join(e.words())}", in_article or _is_article(e))
        node.texts = [(place, text, linked / max(len(text), 1)) for place, text, linked in e.blocks]
        return node

    # In page order, so that a node is complete before its next sibling is compared with it. By a stack, at any depth.
    tree = node_of(root, False)
    stack, order = [(tree, iter(root.children))], [tree]
    while stack:
        parent, children = stack[-1]
        child = next((c for c in children if not _is_dropped(c, parent.article, kept)), None)
        if child is None:
            stack.pop()
            continue
        node = node_of(child, parent.article)
        if parent.children and parent.children[-1].label == node.label:
            parent.children[-1].texts += node.texts
            node = parent.children[-1]
        else:
            parent.children.append(node)
            order.append(node)
        stack.append((node, iter(child.children)))
    for node in reversed(order):
        node.key = _key(node.label, node.children)
    return tree


def simple_tree_matching(a: Node, b: Node, memo: dict) -> int:
    """The most pairs of elements that match, in order and under matching parents."""
    if a.label != b.label:
        return 0
    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        if (x.key, y.key) in memo:
            stack.pop()
            continue
        open_pairs = [(c, d) for c in x.children for d in y.children if c.label == d.label and (c.key, d.key) not in memo]
        if open_pairs:
            stack += open_pairs
        else:
            memo[x.key, y.key] = 1 + _match_children(x, y, memo)[-1][-1]
            stack.pop()
    return memo[a.key, b.key]


def _match_children(a: Node, b: Node, memo: dict) -> list[list[int]]:
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + simple_tree_matching(x, y, memo))
    return best


class Template:
    """The union of aligned trees: for each of its elements, the texts that pages had in it."""

    def __init__(self, first: Node):
        self.root = self._copy(first)
        self.memo: dict = {}

    @staticmethod
    def _copy(node: Node) -> Node:
        """The tree without its texts."""
        top = Node(node.label, node.article)
        stack = [(top, node)]
        while stack:
            own, other = stack.pop()
            own.key, own.texts = other.key, Counter()  # text -> distinct pages that have it here
            own.children = [Node(c.label, c.article) for c in other.children]
            stack += zip(own.children, other.children)
        return top

    def align(self, page: Node) -> list[tuple[Node, Node]]:
        """(template element, page element) for all elements of the page; new ones are added."""
        pairs: list[tuple[Node, Node]] = []
        grown, stack = False, [(self.root, page)]
        while stack:
            own, other = stack.pop()
            pairs.append((own, other))
            if own.key == other.key:
                stack += zip(own.children, other.children)
                continue
            children = []
            for x, y in self._steps(own, other):
                if x is None:
                    x = self._copy(y)
                    grown = True
                children.append(x)
                if y is not None:
                    stack.append((x, y))
            own.children = children
        if grown:
            order, stack = [], [self.root]
            while stack:
                order.append(stack.pop())
                stack += order[-1].children
            for node in reversed(order):
                node.key = _key(node.label, node.children)
        return pairs

    def _steps(self, own: Node, page: Node) -> list[tuple[Node | None, Node | None]]:
        """The children of both in one order, matching ones together."""
        best = _match_children(own, page, self.memo)
        i, j, steps = len(own.children), len(page.children), []
        while i or j:
            if i and j and best[i][j] > max(best[i - 1][j], best[i][j - 1]):
                i, j = i - 1, j - 1
                steps.append((own.children[i], page.children[j]))
            elif j and (not i or best[i][j] == best[i][j - 1]):
                j -= 1
                steps.append((None, page.children[j]))
            else:
                i -= 1
                steps.append((own.children[i], None))
        return steps[::-1]


def extract_group(pages: list[str]) -> list[str]:
    """The main text of each of these pages of one host."""
    distinct = {html: None for html in pages}
    trees = {html: tree_of(parse(html, is_muted)) for html in distinct}
    template, aligned = None, {}
    for html, tree in trees.items():
        template = template or Template(tree)
        aligned[html] = template.align(tree)
    seen: Counter = Counter()  # pages with a text in the element
    for pairs in aligned.values():
        for own, page in pairs:
            if page.texts:
                seen[id(own)] += 1
                own.texts.update({text for _, text, _ in page.texts})
    texts = {}
    for html, pairs in aligned.items():
        marked = any(page.article and page.texts for _, page in pairs)
        found = []
        for own, page in pairs:
            proof = PROOF_INSIDE if page.article else PROOF
            for place, text, linked in page.texts:
                constant = seen[id(own)] >= proof and own.texts[text] == seen[id(own)]
                if not constant and (page.article if marked else linked < 0.5):
                    found.append((place, text))
        texts[html] = "\n".join(text for _, text in sorted(found))
    return [texts[html] for html in pages]


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", group: int = GROUP) -> DataFrame:
    """`pages` with `text`, the main text, and `n_chars`, its code points, in place of `html`; `_host` and `_part` are not passed on."""
    return _extract(pages.drop("_host", "_part"), id, url, html, group)


@keeps_other_columns("id", "url", "html")
def _extract(pages: DataFrame, id: str, url: str, html: str, group: int) -> DataFrame:
    rows = pages.drop("text", "n_chars").withColumn("_host", host_of(F.col(url)))
    # Only hosts of more than one group need a number of parts. Stored, the size of this table is
    # known, so Spark broadcasts it only if it is small; else it splits a hot host in the join.
    sizes = rows.groupBy("_host").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("_parts"))
    sizes = stored(sizes.where(F.col("_parts") > 1), "hosts")
    part = F.pmod(F.xxhash64(F.col(id), F.col(url)), F.coalesce(F.col("_parts"), F.lit(1)))
    rows = rows.join(sizes, "_host", "left").withColumn("_part", part)
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    rows = rows.select("_host", "_part", *kept, F.col(html).alias("_html"))
    result = T.StructType([*(rows.schema[c] for c in kept), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        texts = extract_group([h or "" for h in table.column("_html").to_pylist()])
        columns = [table.column(c) for c in kept]
        return pa.table([*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=result.names)

    return rows.groupBy("_host", "_part").applyInArrow(run, result)
