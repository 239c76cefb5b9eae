"""HTML extraction by wrapper induction.

Pages of one host share a template. Each page becomes a tree of element runs
(neighbouring paragraphs, items or other text elements of one kind are one node,
and so are records, containers of one kind that a parent has many of). The
model page of a host has its most frequent tree; every other page's tree is
aligned with it by simple tree matching. Over all pages of the host a node of the
model then has mostly one text (constant: the template) or several (varying: a
slot). The slots choose the content: from the root the path goes down to the
container with most of the varying text outside links, and what the template
repeats inside it is left out. Elements that HTML itself sets apart from the text
(``nav``, ``footer``, forms, scripts) and those named so are no slots.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Written, lookup_side
from weftline.llm.urls import host_and_path

#: Fixed values of HTML: elements without an end, with raw text, and that stand in a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
#: Fixed values of HTML: elements that show no text, and elements that HTML sets apart from a page's main text.
TEXTLESS = frozenset("head script style noscript template iframe select option textarea svg canvas object audio video title xmp noembed noframes".split())
FURNITURE = TEXTLESS | frozenset("nav header footer aside form button input menu dialog".split())
FURNITURE_ROLES = frozenset("banner complementary contentinfo dialog menu menubar navigation search".split())
#: A class or id names furniture if it is made of these words, and of words that name no thing of their own.
FURNITURE_WORDS = frozenset(
    """ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent dialog disqus footer
    header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies
    respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split()
)
PLAIN_WORDS = frozenset(
    """a area articles bar block bottom box buttons by col column container content div global group holder icons inner item items left
    left-hand links list main media outer page panel pane posts primary region right row secondary section site slot stories strip the
    thread top unit us wrap wrapper zone""".split()
)
#: What an element's start closes when open, up to the nearest of the elements named after it.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "thead": ("tr td th tbody tfoot", ("table",)), "tbody": ("tr td th thead tfoot", ("table",)), "tfoot": ("tr td th tbody", ("table",)),
}
#: A paragraph ends where one of these begins.
ENDS_PARAGRAPH = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr main menu nav ol p pre search section summary table ul""".split()
)
#: A wrapper is made of this many non-empty pages at least.
MIN_PAGES = 3
#: A node is template if one text covers this share of the pages that have it, MIN_PAGES at least, and its other texts are few.
TEMPLATE_SHARE, OTHER_TEXTS = 0.8, 0.1
#: The content path goes down to a container that holds this share of the varying text and stands on this share of the
#: pages, unless more than OWN_SHARE of the text lies beside all child elements.
CONTENT_SHARE, OWN_SHARE = 0.5, 0.1
CONTAINERS = frozenset("html body div section center article main form table tbody tr td".split())
#: What stands beside the content path as a part of the text.
TEXT_LEVEL = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote ul ol dl figure".split())
#: Elements that hold a page's content by their meaning, and headings that make what they stand in an article.
ARTICLES, TITLES, HEADINGS = frozenset("article main".split()), frozenset("h1 h2".split()), frozenset("h1 h2 h3 h4 h5 h6".split())
#: Containers of one kind are records of a list where a parent has more than so many.
RECORDS = 16
#: Cells of an alignment that are in memory at once; larger ones are halved.
CELLS = 4_000_000
#: A comment, a declaration, or the start of a tag; group 3 is there if all of a tag's attributes are well formed.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)"""
    r"""(?:((?>\s++[^\s"'>=/]++(?>\s*+=\s*+(?>"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+)\s*+/?>)?+""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\s(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME, _SIGN, _BLANK, _BARE = re.compile(r"[^\s/\"']*\s*\Z"), re.compile("[=>]"), re.compile(r"\s*"), re.compile(r"[^\s>]*")
_WORDS = re.compile("[a-z]+")
_HUMP = re.compile("([a-z])([A-Z])")
_CLOSES = {tag: (frozenset(names.split()), frozenset(bounds)) for tag, (names, bounds) in CLOSES.items()}


@dataclass(eq=False, slots=True)
class Node:
    tag: str
    names: tuple = ()  # classes, ids and roles, lower case, cut to words
    linked: bool = False  # inside a link
    children: list = field(default_factory=list)  # nodes and strings, in order


def names_of(attributes: str) -> tuple[tuple[str, ...], ...]:
    """Words of each class, id and role, in order."""
    out = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        for token in next((v for v in values if v), "").split():
            words = _WORDS.findall(_HUMP.sub(r"\1 \2", token).lower())
            if words:
                out.append((name.lower()[:1], *words))
    return tuple(out)


def loose_attributes(page: str, at: int, last: dict[str, int]) -> tuple[int, str]:
    """End of a tag whose attributes start at a place, and those of them that name things, well formed.

    Quotes count after an equals sign alone, and if they are closed (``last`` has the places of the page's last ones). A tag
    without an end goes on to the end of the page.
    """
    told = ""
    while True:
        sign = _SIGN.search(page, at)
        if sign is None:
            return len(page), told
        if sign[0] == ">":
            return sign.end(), told
        name = _NAME.search(page[at : sign.start()])
        start = _BLANK.match(page, sign.end()).end()
        quote = page[start : start + 1]
        if quote in last and last[quote] > start:
            end = page.find(quote, start + 1)
            value, at = page[start + 1 : end], end + 1
        else:
            at = _BARE.match(page, start).end()
            value = page[start:at]
        if name and name[0].strip().lower() in ("class", "id", "role"):
            told += f" {name[0].strip()}='{value.replace(chr(39), ' ')}'"


def parse(page: str) -> Node:
    """Tree of a page, forgiving: unknown ends are dropped, open elements end with their parent. Linear in the page."""
    root = Node("#root")
    stack, at, lower = [root], 0, None
    places: dict[str, list[int]] = {}  # of the open elements of each tag in the stack
    solid = [0]  # of the open elements that aren't inline
    last = {q: page.rfind(q) for q in "\"'"}

    def close(size: int):
        for i in range(len(stack) - 1, size - 1, -1):
            places[stack[i].tag].pop()
            if solid[-1] == i:
                solid.pop()
        del stack[size:]

    for found in iter(lambda: _TOKEN.search(page, at), None):
        if found.start() > at:
            stack[-1].children.append(page[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        told = found[3]
        if told is None:
            at, told = loose_attributes(page, found.end(2), last)
        tag = found[2].lower()
        if found[1]:
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag in ENDS_PARAGRAPH and places.get("p") and solid[-1] == places["p"][-1]:
            close(solid[-1])
        if tag in _CLOSES:
            names, bounds = _CLOSES[tag]
            bound = max((places[b][-1] for b in bounds if places.get(b)), default=0)
            inside_bound = [places[n][i] for n in names if places.get(n) and (i := bisect_right(places[n], bound)) < len(places[n])]
            if inside_bound:
                close(min(inside_bound))
        node = Node(tag, names_of(told) if "=" in told else ())
        stack[-1].children.append(node)
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at) if len(lower) == len(page) else page.find(f"</{found[2]}", at)
            end = len(page) if end < 0 else end
            node.children.append(page[at:end])
            after = page.find(">", end)
            at = len(page) if after < 0 else after + 1
        elif tag not in VOID:
            places.setdefault(tag, []).append(len(stack))
            if tag not in INLINE:
                solid.append(len(stack))
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


#: An article of these is not the page's: a reader's comment, a teaser, an advert.
SIDE_ARTICLES = frozenset("ad ads advert advertisement comment comments disqus promo promoted related replies respond sponsored".split())


def furniture(tag: str, names: tuple) -> bool:
    """Whether an element is page furniture by its kind or its name; html, body and main never are by name.

    A name counts as a whole: ``related-posts`` is furniture, ``related-work`` isn't.
    """
    if tag in FURNITURE:
        return True
    if not names or tag in ("html", "body", "main"):
        return False
    telling = SIDE_ARTICLES if tag == "article" else FURNITURE_WORDS
    for kind, *words in names:
        if kind == "r":
            if words[0] in FURNITURE_ROLES:
                return True
        elif not telling.isdisjoint(words) and all(w in FURNITURE_WORDS or w in PLAIN_WORDS for w in words):
            return True
    return False


def blocks(nodes: list[Node], dropped: frozenset = frozenset()) -> list[str]:
    """Texts of the blocks inside nodes in page order, references decoded, white space collapsed.

    Nodes in ``dropped`` (by identity) and furniture among their descendants are left out.
    """
    out: list[str] = []
    line: list[str] = []

    def flush():
        text = " ".join(entities.unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    work: list = []
    for node in reversed(nodes):
        work += [None, *reversed(node.children)]
    while work:
        x = work.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif id(x) in dropped or furniture(x.tag, x.names):
            if x.tag not in INLINE:
                flush()
        elif x.tag == "br":
            line.append(" ")
        else:
            if x.tag not in INLINE:
                flush()
                work.append(None)
            work.extend(reversed(x.children))
    flush()
    return out


# -- run trees ------------------------------------------------------------------------------------


@dataclass(eq=False, slots=True)
class Run:
    """Elements of one kind that are one node of the tree; of a model page only the kind and the path are kept."""

    tag: str
    names: tuple
    path: str = ""
    elements: list = field(default_factory=list)
    children: list = field(default_factory=list)
    size: int = 1
    shape: int = 0  # hash of the tree below, without texts
    digest: int = 0  # hash of the texts
    chars: int = 0
    plain: int = 0  # characters outside links
    own: str = ""

    @property
    def label(self) -> tuple:
        return self.tag, self.names


def text_digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1


def parts(run: Run) -> list[Node]:
    """Block elements among the children of a run's elements; its own text is what lies beside them.

    Inline elements are looked through, so a block inside a link is a child too.
    """
    inner: list[Node] = []
    texts: list[str] = []
    linked: list[str] = []
    for element in run.elements:
        work = [(c, element.linked) for c in reversed(element.children)]
        while work:
            x, link = work.pop()
            if isinstance(x, str):
                (linked if link else texts).append(x)
            elif x.tag in INLINE:
                work.extend((c, link or x.tag == "a") for c in reversed(x.children))
            elif x.tag not in VOID and x.tag not in TEXTLESS:
                x.linked = link
                inner.append(x)
            else:
                texts.append(" ")
    plain, links = (" ".join(entities.unescape("".join(t)).split()) for t in (texts, linked))
    run.plain, run.chars, run.own = len(plain), len(plain) + len(links), f"{plain}\n{links}"
    return inner


def run_tree(tree: Node) -> Run:
    """The tree of runs under a page's root. Built level by level, so pages may be as deep and as wide as they are."""
    root = Run("#root", (), elements=[tree])
    order = [root]
    for run in order:
        inner = parts(run)
        kinds = Counter((n.tag, n.names) for n in inner)
        for node in inner:
            label, last = (node.tag, node.names), run.children[-1] if run.children else None
            if last is not None and last.label == label and (node.tag not in CONTAINERS or kinds[label] > RECORDS):
                last.elements.append(node)
            else:
                run.children.append(Run(node.tag, node.names, f"{run.path}/{len(run.children)}", [node]))
        order += run.children
    for run in reversed(order):
        run.digest = text_digest("\0".join([run.own, *(str(c.digest) for c in run.children)]))
        run.chars += sum(c.chars for c in run.children)
        run.plain += sum(c.plain for c in run.children)
        shaped(run)
    return root


def shaped(run: Run) -> None:
    run.size = 1 + sum(c.size for c in run.children)
    run.shape = text_digest(f"{run.label}{[c.shape for c in run.children]}")


def inside(run: Run) -> list[Run]:
    """All runs below one, in page order."""
    out, work = [], list(reversed(run.children))
    while work:
        out.append(work.pop())
        work.extend(reversed(out[-1].children))
    return out


def skeleton(root: Run) -> list:
    """A run tree as plain data in page order, to travel with a host: depth, tag and names of each node."""
    return [[r.path.count("/"), r.tag, [list(n) for n in r.names]] for r in inside(root)]


def from_skeleton(rows: list) -> Run:
    """The run tree of a skeleton."""
    root = Run("#root", ())
    stack = [root]
    for depth, tag, names in rows:
        del stack[depth:]
        above = stack[-1]
        above.children.append(Run(tag, tuple(map(tuple, names)), f"{above.path}/{len(above.children)}"))
        stack.append(above.children[-1])
    for run in reversed([root, *inside(root)]):
        shaped(run)
    return root


# -- simple tree matching -------------------------------------------------------------------------


def _rows(weight: np.ndarray) -> np.ndarray:
    """Best score of the first rows against each number of first columns, for all rows of a weight matrix (0: no match)."""
    best = np.zeros((len(weight) + 1, weight.shape[1] + 1), np.int64)
    for i, w in enumerate(weight):
        np.maximum.accumulate(np.maximum(best[i, 1:], np.where(w > 0, best[i, :-1] + w, 0)), out=best[i + 1, 1:])
    return best


def _last(weight: np.ndarray) -> np.ndarray:
    """The last row of ``_rows``, without keeping the others."""
    row = np.zeros(weight.shape[1] + 1, np.int64)
    for w in weight:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(w > 0, row[:-1] + w, 0)))
    return row


class Matching:
    """Largest order-preserving matching of two trees, labels equal and parents matched.

    Trees of one shape match node by node. Scores of pairs of shapes are kept, so
    the many equal records of a page cost one comparison. Equal subtrees at both
    ends of two lists of children match each other in some largest matching, so
    only what lies between goes through the table of the classic algorithm,
    whose rows are computed as arrays. Nothing recurses, so depth is unbounded.
    """

    def __init__(self, cells: int = CELLS):
        self.cells = cells
        self.known: dict[tuple[int, int], int] = {}

    def ends(self, a: list[Run], b: list[Run]) -> tuple[int, int]:
        """How many children match at the front and at the back because they have one shape."""
        most, front, back = min(len(a), len(b)), 0, 0
        while front < most and a[front].shape == b[front].shape:
            front += 1
        while back < most - front and a[-1 - back].shape == b[-1 - back].shape:
            back += 1
        return front, back

    def middle(self, a: Run, b: Run) -> tuple[list[Run], list[Run]]:
        front, back = self.ends(a.children, b.children)
        return a.children[front : len(a.children) - back], b.children[front : len(b.children) - back]

    def open_pairs(self, a: list[Run], b: list[Run]) -> list[tuple[Run, Run]]:
        """Pairs of children whose score is asked for, one for each pair of shapes."""
        by_label: dict[tuple, dict[int, Run]] = {}
        for y in b:
            by_label.setdefault(y.label, {})[y.shape] = y
        first = {x.shape: x for x in a}
        return [(x, y) for s, x in first.items() for t, y in by_label.get(x.label, {}).items() if s != t and (s, t) not in self.known]

    def weights(self, a: list[Run], b: list[Run]) -> np.ndarray:
        """Nodes matched when child i is matched to child j, 0 where labels differ."""
        a_at, b_at = ({s: i for i, s in enumerate(dict.fromkeys(x.shape for x in side))} for side in (a, b))
        a_of, b_of = {x.shape: x for x in a}, {y.shape: y for y in b}
        table = np.zeros((len(a_at), len(b_at)), np.int64)
        for s, i in a_at.items():
            for t, j in b_at.items():
                if a_of[s].label == b_of[t].label:
                    table[i, j] = a_of[s].size if s == t else self.known[s, t]
        return table[np.array([a_at[x.shape] for x in a], int)[:, None], np.array([b_at[y.shape] for y in b], int)[None, :]]

    def score(self, a: Run, b: Run) -> int:
        """Number of matched nodes, the two themselves included."""
        work = [(a, b)]
        while work:
            x, y = work[-1]
            if x.shape == y.shape or (x.shape, y.shape) in self.known:
                work.pop()
                continue
            front, _ = self.ends(x.children, y.children)
            u, v = self.middle(x, y)
            missing = self.open_pairs(u, v)
            if missing:
                work += missing
                continue
            kept = sum(c.size for c in x.children) - sum(c.size for c in u)
            self.known[x.shape, y.shape] = 1 + kept + (int(_last(self.weights(u, v))[-1]) if u and v else 0)
            work.pop()
        return a.size if a.shape == b.shape else self.known[a.shape, b.shape]

    def children(self, a: Run, b: Run) -> list[tuple[Run, Run]]:
        """Matched pairs among the children of a matched pair."""
        if a.shape == b.shape:
            return list(zip(a.children, b.children, strict=True))
        front, back = self.ends(a.children, b.children)
        out = list(zip(a.children[:front], b.children[:front], strict=True))
        out += list(zip(a.children[len(a.children) - back :], b.children[len(b.children) - back :], strict=True)) if back else []
        u, v = self.middle(a, b)
        parts = [(u, v)] if u and v else []
        while parts:
            u, v = parts.pop()
            if len(u) > 1 and len(u) * len(v) > self.cells:  # halve: where the best score is split, both halves are best
                half = len(u) // 2
                upper = _last(self.weights(u[:half], v))
                lower = _last(self.weights(u[half:][::-1], v[::-1]))[::-1]
                cut = int((upper + lower).argmax())
                parts += [(p, q) for p, q in ((u[:half], v[:cut]), (u[half:], v[cut:])) if p and q]
                continue
            weight = self.weights(u, v)
            best = _rows(weight)
            i, j = len(u), len(v)
            while i and j:
                if best[i, j] == best[i - 1, j]:
                    i -= 1
                elif best[i, j] == best[i, j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((u[i], v[j]))
        return out


def align(root: Run, model: Run) -> dict[int, str]:
    """Path of the model node that each run (by identity) is matched to."""
    matching = Matching()
    matching.score(root, model)
    where, work = {}, [(root, model)]
    while work:
        for x, y in matching.children(*work.pop()):
            where[id(x)] = y.path
            work.append((x, y))
    return where


# -- the wrapper ----------------------------------------------------------------------------------


@dataclass
class Seen:
    """What a model node holds over the pages that have it."""

    n: int  # pages
    plain: int  # characters outside links
    most: int  # pages with the most frequent text
    digest: int  # and its hash
    texts: int  # distinct texts


@dataclass
class Wrapper:
    """A host's model tree, hash of the template's text by path, and paths of the content, the main ones last."""

    model: Run
    template: dict[str, int]
    content: list[str]
    main: list[str]


def choose(model: Run, pages: int, seen: dict[str, Seen]) -> tuple[dict[str, int], list[str], list[str]]:
    """Template texts by path, the content paths, and those of them that must be on a page for the wrapper to fit it.

    From the root the content path goes down as long as one container, or the
    containers of one kind, hold CONTENT_SHARE of the varying text outside
    links; varying headings, paragraphs and the like beside it belong to the
    text. It ends at an article or main element (all that have varying text), and at a container with a varying title
    of its own: everything in there is content. A template node of several elements that holds most of all text is a much
    copied page's content and no template. There are no content paths where the path doesn't
    get below the body.
    """
    nothing = Seen(0, 0, 0, 0, 0)
    order = [model, *inside(model)]

    def is_template(s: Seen) -> bool:
        return s.most >= max(MIN_PAGES, TEMPLATE_SHARE * s.n) and s.texts - 1 <= OTHER_TEXTS * s.n

    template = {r.path: s.digest for r in order[1:] if (s := seen.get(r.path, nothing)).n and is_template(s)}

    def amounts(with_furniture: bool) -> tuple[dict[str, int], dict[str, int]]:
        text, varying = {}, {}
        for r in reversed(order):
            below = [c.path for c in r.children]
            plain = seen.get(r.path, nothing).plain if r is not model else sum(seen.get(p, nothing).plain for p in below)
            own = max(0, plain - sum(seen.get(p, nothing).plain for p in below))
            out = r is not model and not with_furniture and furniture(r.tag, r.names)
            text[r.path] = 0 if out else own + sum(text[p] for p in below)
            varying[r.path] = 0 if out or r.path in template else own + sum(varying[p] for p in below)
        return text, varying

    with_furniture = not amounts(False)[0][model.path]
    text, _ = amounts(with_furniture)
    node = model
    while node is not None:  # down the one that holds most of the text
        node = next((c for c in node.children if text[c.path] and text[c.path] > CONTENT_SHARE * text[node.path]), None)
        if node is not None and node.path in template and node.children:
            for r in (node, *inside(node)):
                template.pop(r.path, None)
            break
    _, varying = amounts(with_furniture)

    beside: list[str] = []
    node, main = model, []
    while varying[node.path] > 0:
        total, below = varying[node.path], node.children
        whole = node.tag not in ("#root", "html", "body")
        if whole and (node.tag in ARTICLES or any(c.tag in TITLES and varying[c.path] for c in below)):
            break  # an article, or what has a title of its own: all of it is content
        if total - sum(varying[c.path] for c in below) > OWN_SHARE * total:
            break
        inner = [c for c in below if c.tag in CONTAINERS and c.path not in template and seen.get(c.path, nothing).n >= CONTENT_SHARE * pages]
        best = max(inner, key=lambda c: varying[c.path], default=None)
        if best is None:
            break
        alike = [c for c in inner if c.label == best.label and varying[c.path]]
        if best.tag in ARTICLES:
            alike = [c for c in inner if c.tag == best.tag and varying[c.path]]
        elif best.names and len(alike) > 1 and node.tag not in ("#root", "html"):
            pass  # containers of one name are parts of one thing
        elif varying[best.path] >= CONTENT_SHARE * total:
            alike = [best]
        elif node.tag in ("#root", "html") or sum(varying[c.path] for c in alike) < CONTENT_SHARE * total or best.tag in ("tr", "td"):
            break
        beside += [c.path for c in below if c.tag in TEXT_LEVEL and c.path not in template and varying[c.path]]
        node, main = best, [c.path for c in alike]
        if len(alike) > 1:
            break
    return template, *([[], []] if not main or node.tag in ("html", "body") else [[*beside, *main], main])


def by_structure(root: Run) -> list[Run]:
    """A page's article elements, or main ones, or the whole page; outermost first, in page order."""
    for tag in ("article", "main"):
        found, work = [], list(reversed(root.children))
        while work:
            r = work.pop()
            if furniture(r.tag, r.names):
                continue
            if r.tag == tag:
                found.append(r)
            else:
                work.extend(reversed(r.children))
        if found:
            return found
    return [root]


def kept_headings(top: Run, fixed: set[int]) -> set[int]:
    """Template headings that text of the page's own follows: they are that text's."""
    kept, work = set(), [top]
    while work:
        run, own = work.pop(), False
        for child in reversed(run.children):
            if id(child) not in fixed:
                own |= bool(child.chars) and not furniture(child.tag, child.names)
                work.append(child)
            elif own and child.tag in HEADINGS:
                kept |= {id(child), *(id(r) for r in inside(child))}
    return kept


def extract(page: str | None, wrapper: Wrapper | None = None) -> str:
    """Text of a page by its group's wrapper; by structure alone where there is none or the page hasn't its content."""
    tree = parse(page or "")
    root = run_tree(tree)
    where = align(root, wrapper.model) if wrapper and (wrapper.template or wrapper.content) else {}
    tops = [r for r in inside(root) if where.get(id(r)) in wrapper.content] if wrapper and wrapper.content else []
    if not any(where[id(r)] in wrapper.main and r.chars for r in tops):
        tops = by_structure(root)
    dropped: set[int] = set()
    for top in tops if where else ():
        below = inside(top)
        # the template's text only: what a page has of its own at such a place stays
        fixed = {id(r) for r in below if wrapper.template.get(where.get(id(r))) == r.digest}
        fixed -= kept_headings(top, fixed)
        # a page that is nothing but template has no slot to keep: then its text is the content
        if any(id(r) not in fixed and r.chars for r in below if not r.children) or (top.own.strip() and id(top) not in fixed):
            dropped |= {id(e) for r in below if id(r) in fixed for e in r.elements}
    return " ".join(blocks([e for r in tops for e in r.elements], frozenset(dropped)))


# -- the operator ---------------------------------------------------------------------------------


def page_groups(pages: DataFrame) -> DataFrame:
    """(host, key, pages): which pages make a wrapper together, for the hosts of pages (host, html).

    A host with MIN_PAGES non-empty pages is a group by itself. Smaller hosts of
    one registered domain (the last two labels) are one group, and what is left of
    all domains is one. The key is null where even that is too few.
    """
    hosts = Written(pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    small = hosts.df.where(F.col("pages") < MIN_PAGES).withColumn("domain", F.substring_index("host", ".", -2))
    domains = small.groupBy("domain").agg(F.sum("pages").alias("domain_pages"))
    placed = small.join(domains, "domain")
    enough = F.col("domain_pages") >= MIN_PAGES
    rest = domains.where(~enough).agg(F.coalesce(F.sum("domain_pages"), F.lit(0)).alias("rest_pages"))
    placed = placed.join(F.broadcast(rest))  # one row
    key = F.when(enough, F.concat(F.lit("*."), "domain")).when(F.col("rest_pages") >= MIN_PAGES, "*")
    size = F.when(enough, F.col("domain_pages")).otherwise(F.col("rest_pages"))
    return hosts.df.where(F.col("pages") >= MIN_PAGES).select("host", F.col("host").alias("key"), "pages").unionByName(placed.select("host", key.alias("key"), size.alias("pages")))


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): each host with its group's wrapper as JSON (null: none).

    Every non-empty page of a group is aligned with the model page, one of those
    with the group's most frequent tree. Nodes' texts are counted by hash (in the
    tasks first), then each node's most frequent one is taken; see ``choose``.
    Of trees that are equally frequent the one with the largest hash is the model, of texts the one with the largest
    hash; repeated rows count each. Other columns are ignored.
    """
    host, _ = host_and_path(F.col(url_col))
    keyed = pages.select(host.alias("host"), F.col(html_col).alias("html")).where(F.col("html").rlike(r"\S"))
    groups = Written(page_groups(keyed))
    side = lookup_side(groups)
    keyed = keyed.join(side.where("key is not null").select("host", "key"), "host").select("key", "html")

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [run_tree(parse(h)).shape for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int64())], names=["key", "page", "shape"])

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(skeleton(run_tree(parse(h))), separators=(",", ":")) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["key", "model"])

    page = F.xxhash64("html").alias("page")
    shaped_pages = keyed.select("key", "html", page).mapInArrow(shapes, "key string, page long, shape long")
    kinds = shaped_pages.groupBy("key", "shape").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("page"))
    first = Written(kinds.groupBy("key").agg(F.max(F.struct("n", "shape", "page")).alias("m"), F.sum("n").alias("pages")).select("key", "m.page", "pages"))
    chosen = keyed.withColumn("page", page).join(lookup_side(first).select("key", "page"), ["key", "page"]).dropDuplicates(["key", "page"])
    models = chosen.select("key", "html").mapInArrow(trees, "key string, model string").groupBy("key").agg(F.min("model").alias("model"))
    models = Written(models.join(lookup_side(first).select("key", "pages"), "key"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Run] = {}
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, html, model in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if model not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[model] = from_skeleton(json.loads(model))
                root = run_tree(parse(html))
                where = align(root, known[model])
                for run in inside(root):
                    if id(run) in where:
                        for column, value in zip(out, (key, where[id(run)], run.digest, run.plain), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
                names=["key", "path", "digest", "plain"],
            )

    def wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for model, n, found in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                seen = {x["path"]: Seen(x["n"], x["plain"], x["most"]["n"], x["most"]["digest"], x["texts"]) for x in found or ()}
                rows = json.loads(model)
                made.append(json.dumps([rows, *choose(from_skeleton(rows), n, seen)], separators=(",", ":")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["key", "wrapper"])

    seen = keyed.join(lookup_side(models).select("key", "model"), "key").select("key", "html", "model").mapInArrow(nodes, "key string, path string, digest long, plain long")
    kinds = seen.groupBy("key", "path", "digest").agg(F.count(F.lit(1)).alias("n"), F.sum("plain").alias("plain"))
    stats = kinds.groupBy("key", "path").agg(
        F.sum("n").alias("n"), F.sum("plain").alias("plain"), F.max(F.struct("n", "digest")).alias("most"), F.count(F.lit(1)).alias("texts")
    )
    # as many nodes as the model page has
    each = stats.groupBy("key").agg(F.collect_list(F.struct("path", "n", "plain", "most", "texts")).alias("nodes"))
    made = models.df.join(each, "key", "left").select("key", "model", "pages", "nodes").mapInArrow(wrappers, "key string, wrapper string")
    return groups.df.select("host", "key").join(made, "key", "left").select("host", "wrapper")


def read_wrapper(text: str | None) -> Wrapper | None:
    """A wrapper from its JSON."""
    if text is None:
        return None
    rows, template, content, main = json.loads(text)
    return Wrapper(from_skeleton(rows), template, content, main)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of each page: main text by its host's wrapper.

    Hosts with fewer than MIN_PAGES non-empty pages share a wrapper (see
    ``page_groups``); where there is none, or a page hasn't the wrapper's content,
    its article or main elements are read, else the whole page, without
    furniture. Null and empty pages have an empty text. Repeated rows are pages of
    their own. Wrappers are broadcast when their table is small, else joined by
    host, where adaptive execution splits a hot host's rows.
    """
    host, _ = host_and_path(F.col(url_col))
    wrappers = Written(induce(pages, url_col, html_col))
    rows = pages.select(id_col, F.col(url_col).alias("__url"), F.col(html_col).alias("__html"), host.alias("host")).join(lookup_side(wrappers), "host", "left")
    rows = rows.select(id_col, "__url", "__html", "wrapper")
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, Wrapper | None] = {}
        for batch in batches:
            found = []
            for page, told in zip(*(batch.column(i).to_pylist() for i in (2, 3)), strict=True):
                if told not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[told] = read_wrapper(told)
                found.append(extract(page, known[told]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
                names=[id_col, "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"`{id_col}` {kind}, url string, text string, n_chars long")
