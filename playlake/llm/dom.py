"""Pages as trees of nodes, and features of the nodes, for ``extraction``.

A forgiving scanner: tags that HTML closes by itself are closed, stray end tags are
ignored, scripts, styles and comments never become text.  A node is a block element, an
inline element that has a name (class, id, role) of its own, or a run of text that stands
between the blocks of an element.  A *run* is the text between two block boundaries.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np

# ---- fixed values: elements of HTML ----------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Never shown as text, or controls of forms.
DROPPED = frozenset("noscript template svg math object select option optgroup datalist button canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: What an element's start tag closes, and where the search for it ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
}
CELLS = frozenset("td th caption table".split())
KINDS = {
    "article": "article main", "section": "section", "div": "div center", "p": "p", "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "list": "ul ol dl", "item": "li dt dd", "nav": "nav menu", "aside": "aside", "footer": "footer", "header": "header",
    "form": "form fieldset legend", "table": "table thead tbody tfoot tr td th caption", "quote": "blockquote pre figure figcaption address details summary",
    "inline": " ".join(sorted(INLINE)), "run": "#run", "page": "#page",
}
#: Words in names of elements, by what they speak for.
NAMES = {
    "text": "article content post entry story text main body prose copy chapter news blog title headline lead paragraph summary caption quote reading",
    "ad": "ad ads advert advertisement adsense adslot banner sponsor sponsored promo promotion commercial partner",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs crumbs pager pagination paging tabs toc sitemap skip links",
    "head": "header masthead topbar logo branding brand site top",
    "foot": "footer foot bottom copyright legal colophon credits imprint",
    "side": "sidebar side aside widget rail related recommended trending popular also more teaser column",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay toast privacy message disclaimer warning",
    "form": "form search login signup signin register subscribe newsletter subscription field contact poll",
    "comment": "comment comments reply replies respond discussion thread feedback disqus reader readers",
    "share": "share sharing social follow tools print tags buttons like",
    "byline": "byline author date meta posted published dateline",
    "hidden": "hidden invisible",
}
# -----------------------------------------------------------------------------------------

KIND = {t: i for i, tags in enumerate(KINDS.values()) for t in tags.split()}
OTHER = len(KINDS)
WORDS = {w: 1 << i for i, words in enumerate(NAMES.values()) for w in words.split()}
HIDDEN = 1 << list(NAMES).index("hidden")
ABOVE = ["article", "list", "nav", "aside", "footer", "header", "form", "table"]

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z))""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NAMED = re.compile(r"class|\bid\b|role|hidden|display|data-gold", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARKS = re.compile(r"[.,!?;:]")


@lru_cache(1 << 14)
def named(attributes: str) -> tuple[int, int, bool]:
    """Groups of ``NAMES`` in an element's names, its training mark (-1: none), whether it has a name."""
    flags, gold, some = 0, -1, False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id", "role", "aria-label"):
            some = some or key != "aria-label"
            for w in WORD.findall(value):
                flags |= WORDS.get(w.lower(), 0)
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            flags, some = flags | HIDDEN, True
        elif key == "data-gold":
            gold = int(value)
    return flags, gold, some


@dataclass
class Page:
    parent: list[int] = field(default_factory=lambda: [-1])
    kind: list[int] = field(default_factory=lambda: [KIND["#page"]])
    flags: list[int] = field(default_factory=lambda: [0])
    gold: list[int] = field(default_factory=lambda: [-1])
    drop: list[bool] = field(default_factory=lambda: [False])
    runs: list[list[tuple[int, str, bool]]] = field(default_factory=list)  # pieces: node, text, in a link

    def add(self, parent: int, kind: int, flags: int = 0, gold: int = -1, drop: bool = False) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.flags.append(flags)
        self.gold.append(gold)
        self.drop.append(drop)
        return len(self.parent) - 1


def parse(html: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements and the node that their text belongs to
    count: dict[str, int] = {}
    run: list[tuple[int, str, bool]] = []

    def flush() -> None:
        nonlocal run
        if run:
            if any(not x[1].isspace() for x in run):
                page.runs.append(run)
            run = []

    def pop_to(at: int) -> None:
        while len(stack) > at:
            count[stack.pop()[0]] -= 1

    def close(names: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        if not any(count.get(n) for n in names):
            return
        found = 0
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in stop:
                break
            if stack[at][0] in names:
                found = at
        if found:
            pop_to(found)

    def say(text: str) -> None:
        if text:
            run.append((stack[-1][1], unescape(text) if "&" in text else text, bool(count.get("a"))))

    at = 0
    while m := TAG.search(html, at):
        say(html[at : m.start()])
        at = m.end()
        end, tag, rest = m.groups()
        if end:
            tag = end.lower()
            if tag == "p" and not count.get("p"):
                flush()
            elif count.get(tag):
                inline = tag in INLINE
                if not inline:
                    flush()
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        pop_to(i)
                        break
                    if inline and stack[i][0] not in INLINE:
                        break
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW:
            over = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(html, at)
            at = over.end()
            continue
        if tag == "br":
            run.append((stack[-1][1], " ", False))
            continue
        if tag in ("html", "head", "body"):
            flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        inline = tag in INLINE
        flags, gold, some = named(rest) if NAMED.search(rest) else (0, -1, False)
        if inline:
            node = page.add(stack[-1][1], KIND[tag], flags, gold) if some else stack[-1][1]
        else:
            flush()
            close({"p"}, CELLS)
            if tag in CLOSES:
                close(*CLOSES[tag])
            drop = tag in DROPPED
            node = page.add(stack[-1][1], KIND.get(tag, OTHER), flags, gold, drop)
        if not rest.endswith("/>") or tag in KIND:
            stack.append((tag, node))
            count[tag] = count.get(tag, 0) + 1
    say(html[at:])
    flush()
    # runs between the blocks of an element are nodes of their own
    blocks = {p for p, k in zip(page.parent, page.kind) if k != KIND["a"]}
    blocks |= {0}
    for i, pieces in enumerate(page.runs):
        own: dict[int, int] = {}
        for j, (node, text, link) in enumerate(pieces):
            if node in blocks:
                if node not in own:
                    own[node] = page.add(node, KIND["#run"])
                pieces[j] = (own[node], text, link)
    return page


FEATURES = [
    *[f"kind_{k}" for k in (*KINDS, "other")],
    *[f"name_{n}" for n in NAMES],
    *[f"above_{n}" for n in NAMES],
    *[f"in_{k}" for k in ABOVE],
    "chars", "links", "words", "runs", "share", "marks", "nodes", "per_node", "paragraphs", "items",
    "depth", "begin", "end", "siblings", "alike", "among", "of_parent", "before", "first",
]


def features(page: Page) -> np.ndarray:
    """(nodes, features) of a page: kind, names of the node and of those above, its subtree's
    text and links, its depth and place, and its siblings."""
    n = len(page.parent)
    parent, kind = np.array(page.parent), np.array(page.kind)
    stats = np.zeros((n, 6))  # chars, chars in links, words, runs, marks, chars in items
    begin, end = np.full(n, np.inf), np.zeros(n)
    at = 0
    for pieces in page.runs:
        seen = set()
        for node, text, link in pieces:
            chars, words = len(text), text.count(" ") + 1
            stats[node] += (chars, chars if link else 0, words, node not in seen, len(MARKS.findall(text)), 0)
            seen.add(node)
            begin[node] = min(begin[node], at)
            at += chars
            end[node] = max(end[node], at)
    is_item, is_p = kind == KIND["li"], kind == KIND["p"]
    many = np.ones((n, 2))  # nodes, paragraphs
    many[:, 1] = is_p
    depth, above, inside = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    flags = page.flags
    bit = {KIND[KINDS[k].split()[0]]: 1 << i for i, k in enumerate(ABOVE)}
    # a node's number may be less than its parent's only for runs, which have no children: parents first
    for i in range(1, n):
        p = page.parent[i]
        depth[i] = depth[p] + 1
        above[i] = above[p] | flags[p]
        inside[i] = inside[p] | bit.get(page.kind[p], 0)
    stats[is_item, 5] = stats[is_item, 0]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        stats[p] += stats[i]
        if is_item[p]:
            stats[p, 5] = stats[p, 0]
        many[p] += many[i]
        if begin[i] < begin[p]:
            begin[p] = begin[i]
        if end[i] > end[p]:
            end[p] = end[i]
    begin[np.isinf(begin)] = 0
    total = max(at, 1)
    chars = stats[:, 0]
    up = np.maximum(parent, 0)
    children = np.bincount(up[1:], minlength=n) if n > 1 else np.zeros(n)
    pair = up * (OTHER + 1) + kind
    alike = np.bincount(pair[1:], minlength=n * (OTHER + 1)) if n > 1 else np.zeros(n * (OTHER + 1))
    order = np.zeros(n)
    before = np.zeros(n)
    last: dict[int, int] = {}
    place: dict[int, int] = {}
    for i in range(1, n):
        p = page.parent[i]
        order[i] = place.get(p, 0)
        place[p] = place.get(p, 0) + 1
        before[i] = page.kind[last[p]] if p in last else -1
        last[p] = i
    siblings = children[up]
    siblings[0] = 1
    flags_ = np.array(flags)
    safe = np.maximum(chars, 1)
    columns = [
        *[kind == k for k in range(OTHER + 1)],
        *[(flags_ >> k) & 1 for k in range(len(NAMES))],
        *[(above >> k) & 1 for k in range(len(NAMES))],
        *[(inside >> k) & 1 for k in range(len(ABOVE))],
        np.log1p(chars), stats[:, 1] / safe, stats[:, 2] / np.maximum(stats[:, 3], 1), np.log1p(stats[:, 3]), chars / total,
        100 * stats[:, 4] / safe, np.log1p(many[:, 0]), np.log1p(chars / many[:, 0]), np.log1p(many[:, 1]), stats[:, 5] / safe,
        depth, begin / total, end / total, np.log1p(siblings), np.where(siblings > 0, alike[pair] / np.maximum(siblings, 1), 1),
        np.log1p((chars[up] - chars) / np.maximum(siblings - 1, 1)), chars / np.maximum(chars[up], 1), before, order / np.maximum(siblings, 1),
    ]
    return np.stack(columns, 1).astype(np.float32)


def blocks(page: Page, chosen: np.ndarray) -> str:
    """Text of the runs' pieces in chosen nodes: white space as one space, a line each run."""
    lines = (" ".join("".join(text for node, text, _ in pieces if chosen[node]).split()) for pieces in page.runs)
    return "\n".join(line for line in lines if line)
