"""A small HTML reader: the element tree of a page with its text blocks in page order.

It follows the parts of the HTML rules that matter for text: raw text elements, void elements, paragraphs, list items and
table cells that end by themselves, end tags that close what is open inside, and input that breaks off anywhere.
"""

import re
from collections import Counter
from collections.abc import Callable
from html import unescape

# A quote opens a value only behind `=`; elsewhere it is part of a name. What breaks off inside a tag is no text.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*+(?:[\s/]++|=?+[^\s/>=]++(?:{_VALUE})?+|=)*+(?:>|\Z)", re.S
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""=?([^\s/>=]++)(?:\s*+=\s*+("[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+))?+""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr nobr".split()
)
#: Their start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: What an element of the same kind ends, and the elements beyond which it does not reach.
ENDS_LIKE = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}


class Element:
    """`blocks`: the texts that stand directly in this element, with their places in the page."""

    __slots__ = ("tag", "attributes", "children", "blocks", "parent")

    def __init__(self, tag: str, attributes: dict[str, str], parent: "Element | None"):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element] = []
        self.blocks: list[list] = []  # [place, text, characters inside links]

    def names(self) -> list[list[str]]:
        """The names in class, id and role, each as its words in lower case."""
        named = " ".join(self.attributes.get(k, "") for k in ("class", "id", "role")).split()
        return [re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) for name in named]

    def words(self) -> list[str]:
        return [word for name in self.names() for word in name]


def _attributes(raw: str, tag: str) -> dict[str, str]:
    if "=" not in raw and " " not in raw:
        return {}
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw, len(tag) + 1, len(raw) - raw.endswith(">")):
        found.setdefault(name.lower(), unescape(value[1:].removesuffix(value[0]) if value[:1] in ("'", '"') else value))
    return found


def parse(html: str, mute: Callable[[Element], bool] = lambda e: False) -> Element:
    """The root of the tree. Inline elements leave no node: their text belongs to the block around, unless `mute` leaves it out."""
    root = current = Element("#root", {}, None)
    place, buffer, linked, in_link = 0, [], 0, 0
    opened: Counter = Counter()  # elements from the root to here, by tag
    muted: list[str] = []  # inline elements that are left out, and the element around them
    muted_in = root

    def flush() -> None:
        nonlocal place, linked
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                current.blocks.append([place, text, linked])
                place += 1
        linked = 0

    def close(stop: Element) -> None:
        """Leave everything up to and including `stop`."""
        nonlocal current
        flush()
        while current is not stop.parent:
            opened[current.tag] -= 1
            if current is muted_in:
                muted.clear()
            current = current.parent

    def nearest(tags: set[str], limits: set[str] | frozenset[str]) -> Element | None:
        if not any(opened[t] for t in tags):
            return None
        e = current
        while e is not root and e.tag not in limits:
            if e.tag in tags:
                return e
            e = e.parent
        return None

    at, n = 0, len(html)
    while at < n:
        token = _TOKEN.search(html, at)
        if token is None:
            if (rest := html[at:]) and "<" in rest and re.search(r"</?[a-zA-Z][^>]*\Z", rest):
                rest = re.sub(r"</?[a-zA-Z][^>]*\Z", "", rest)
            if not muted:
                buffer.append(unescape(rest))
            break
        if token.start() > at and not muted:
            text = unescape(html[at : token.start()])
            buffer.append(text)
            linked += len(text) if in_link else 0
        at, raw = token.end(), token[0]
        if raw[1] in "!?":
            continue
        tag = _NAME.match(raw)[1].lower()
        if raw[1] == "/":
            if muted and tag == muted[-1]:
                muted.pop()
            if tag == "a":
                in_link = 0
            elif tag == "br":
                buffer.append(" ")
            elif tag not in INLINE and (open_one := nearest({tag}, frozenset())) is not None:
                close(open_one)
                in_link = 0
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            start, at = at, end.start() if end else n
            if tag == "title":
                continue
            # Left out as a whole: they hold code, form input or what is not shown.
            if not end:
                break
            at = html.find(">", at) + 1 or n
            continue
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr", "wbr", "img"):
                buffer.append(" " if tag != "wbr" else "")
            if tag == "hr":
                flush()
            if tag == "a":
                in_link = 1
            if tag in INLINE and tag not in VOID and (tag in muted or mute(Element(tag, _attributes(raw, tag), current))):
                if not muted:
                    muted_in = current
                muted.append(tag)
            continue
        if tag in ENDS_P and (p := nearest({"p"}, {"button", "table", "td", "th", "#root"})) is not None:
            close(p)
        if tag in ENDS_LIKE and (like := nearest(*ENDS_LIKE[tag])) is not None:
            while (outer := nearest(*ENDS_LIKE[tag])) is not None:
                close(outer)
        flush()
        child = Element(tag, _attributes(raw, tag), current)
        current.children.append(child)
        if not raw.endswith("/>") or tag in ("p", "div", "li"):
            current = child
            opened[tag] += 1
    flush()
    return root
