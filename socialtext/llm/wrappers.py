"""Main text of web pages with wrappers inferred per host, as union-free regular expressions.

A page is a tree of the elements that no rule of HTML excludes (menus, forms, scripts and the like). Pages of the same host
are aligned one after the other: equal labels are matched in order, what only one side has becomes optional, neighbours with
the same label become a repeated group, and texts that differ become slots. The wrapper of a host is built from all its
pages: partial wrappers within partitions first, then their alignment, so a host with a third of all pages is no hot task.
A wrapper counts the pages of each node and of each text, so one odd page changes no wrapper: a text that at least ``SHARE``
percent of the pages with its parent have at its place is template and left out, unless the wrapper has no slot at all
(a host that shows one article only) or fewer than ``LEAST_PAGES`` pages (inside an article ``LEAST_PAGES_INSIDE``) agree on it.
Pages without any text are not aligned.

Null and empty pages and pages without main text give an empty text; a null address is a host of its own; repeated rows get
equal results; only ``page_id, url, html`` are read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as entities
import pickle
import re
import sys
from collections import Counter
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from socialtext.llm.tables import prepare, stored

#: Pages that must agree on a text before it counts as template.
LEAST_PAGES = 4
#: The same inside an article or main part, where a text is content unless many pages agree.
LEAST_PAGES_INSIDE = 20
#: Percent of the pages with its parent that must have a node or text of the template.
SHARE = 90
#: Texts counted at one place; with more, the rarest give way, and a count falls short by at most a quarter of the other texts.
KEPT_TEXTS = 4
#: Children of two nodes that are aligned at once by a full table; longer sides are aligned stretch by stretch.
STRETCH = 2000
#: Frames that nested elements may take in a worker; pure Python calls need no more of the C stack for it.
FRAMES = 1 << 20

_TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_BLANKS = re.compile(r"\s+")

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
EXCLUDED = set("head script style noscript template iframe svg canvas object nav footer aside form button select textarea menu dialog title xmp noembed noframes map audio video datalist".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_BORDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "p": set()}
EXCLUDED_NAMES = set("""ad ads advert adverts advertisement advertising advertorial adsense banner sponsor sponsored sponsors promo promotion promoted
cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter subscribe subscription signup login
share sharing social related recommended recommendations sidebar widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination
pager masthead topbar toolbar footer header comment comments commentlist respond disqus replies reply skip hidden""".split())
#: Word parts that a class or id may have beside an excluded name (`site-footer`, `related-posts`) and still name the same block.
BESIDE_NAMES = set("""site page global top bottom left right primary secondary desktop mobile sticky inner outer wrapper wrap container holder box block bar
area section panel list links link items item buttons button icons posts stories slot unit post entry article""".split())
#: Names that text of an article has for other reasons.
FORGIVEN_INSIDE = set("header hidden notice notices alert alerts".split())
EXCLUDED_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
REPEATED = set("# p li dt dd tr td th br option h2 h3 h4".split())
MAIN_NAMES = set("content article post entry story main".split())


class Node:
    """``label`` is the element (``#`` for a text); a text holds its string or None once it is a slot.

    ``pages`` counts the pages that have the node, ``texts`` those of its most frequent strings.
    """

    __slots__ = ("label", "children", "text", "optional", "repeated", "inline", "pages", "texts")

    def __init__(self, label, text=None):
        self.label, self.text, self.children, self.optional, self.repeated, self.inline = label, text, [], False, False, False
        self.pages, self.texts = 1, {}


def _named(names: str, inside_article: bool) -> bool:
    """One of the names is an excluded one as a whole, or made of excluded names, words of ``BESIDE_NAMES`` and numbers only."""
    for name in names.split():
        parts = [p.lower() for p in _NAME_PART.findall(name)]
        hit = ({name.lower()} | set(parts)) & EXCLUDED_NAMES
        if inside_article:
            hit -= FORGIVEN_INSIDE
        if hit and (name.lower() in hit or all(p in EXCLUDED_NAMES or p in BESIDE_NAMES or p.isdigit() for p in parts)):
            return True
    return False


def _excluded(tag: str, attributes: str, inside_article: bool) -> str:
    """Why an element is left out: ``rule``, ``name`` (of its class or id), or nothing."""
    if tag in EXCLUDED or tag == "header" and not inside_article:
        return "rule"
    if not attributes.strip():
        return ""
    found = dict((m[1].lower(), (m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(attributes))
    names = found.get("class", "") + " " + found.get("id", "")
    if tag in ("html", "body", "article", "main"):
        return "rule" if tag == "article" and {p.lower() for p in _NAME_PART.findall(names)} & {"comment", "comments", "related", "ad", "promo", "sponsored"} else ""
    if (found.get("role", "").lower() in EXCLUDED_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none", found.get("style", ""), re.I)):
        return "rule"
    return "name" if _named(names, inside_article) else ""


def _main_label(tag: str, attributes: str) -> str:
    if tag in ("article", "main") or not attributes:
        return tag
    names = {p.lower() for a in _ATTRIBUTE.finditer(attributes) if a[1].lower() in ("class", "id", "role") for p in _NAME_PART.findall(a[2] or "")}
    return f"{tag}.main" if tag in ("div", "section", "td") and names & MAIN_NAMES or "main" in names else tag


def parse(page: str, allowed: frozenset[int] = frozenset()) -> Node:
    """The tree of a page without excluded elements.

    Where all articles and main parts of a page lie in elements that were excluded by their names, these elements stay
    (``allowed`` has their places in the page) and the page is read again.
    """
    outside, around = False, set()
    why, place = "", 0  # of the excluded element around, if there is one
    root = Node("root")
    # An excluded element has no node. The last entry tells whether an article or main part lies around or is this element.
    stack: list[tuple[str, Node | None, bool]] = [("root", root, False)]
    opened: Counter[str] = Counter()  # how often each element is on the stack: what is not there need not be sought

    def close(depth: int) -> None:
        for t, _, _ in stack[depth:]:
            opened[t] -= 1
        del stack[depth:]

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        begin, at = at, m.end()
        tag = m[2] or m[5]
        node = stack[-1][1]
        if not tag:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                if node is not None:
                    if node.children and node.children[-1].label == "#":
                        node.children[-1].text += piece
                    else:
                        node.children.append(Node("#", piece))
            continue
        tag, attributes = tag.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag), 0) if opened[tag] else 0
            if depth:
                close(depth)
            continue
        if tag in CLOSES_P and opened["p"]:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == "p" or stack[d][0] not in INLINE), 0)
            if depth and stack[depth][0] == "p":
                close(depth)
        if tag in SAME_CLOSES and any(opened[t] for t in SAME_CLOSES[tag]):
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] in LIST_BORDERS[tag]:
                    break
                if stack[d][0] in SAME_CLOSES[tag]:
                    close(d)
                    break
        node = stack[-1][1]
        child = None
        inside_article = stack[-1][2]
        if node is not None:
            why, place = _excluded(tag, attributes, inside_article), begin
            if not why or why == "name" and begin in allowed:
                child = Node(tag)
                child.inline = tag in INLINE
                child.label = _main_label(tag, attributes)
                outside = outside or child.label in ("article", "main") or child.label.endswith(".main")
                node.children.append(child)
        elif not outside:
            label = _main_label(tag, attributes) if why == "name" else ""
            if (label in ("article", "main") or label.endswith(".main")) and not _excluded(tag, attributes, False):
                around.add(place)
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(page, at)
            if end is None:
                at = n
                continue
            at = page.find(">", end.end()) + 1 or n
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append((tag, child, inside_article or tag in ("article", "main")))
            opened[tag] += 1
    return root if outside or not around else parse(page, allowed | around)


def _wrapper(node: Node) -> Node:
    """A page as the first wrapper: white space normalised, empty texts gone, equal neighbours folded into repeated groups."""
    top = Node(node.label)
    made = [(node, top)]
    for old, new in made:  # grows while it is read: parents before their children
        for child in old.children:
            if child.label == "#":
                text = _BLANKS.sub(" ", entities.unescape(child.text)).strip()
                if text:
                    new.children.append(Node("#", text))
                    new.children[-1].texts[text] = 1
            else:
                new.children.append(Node(child.label))
                made.append((child, new.children[-1]))
    for _, new in reversed(made):
        _fold(new)
    return top


def _fold(node: Node) -> None:
    kept: list[Node] = []
    for child in node.children:
        if kept and kept[-1].label == child.label and (
                child.label in REPEATED or [c.label for c in kept[-1].children] == [c.label for c in child.children]):
            kept[-1] = align(kept[-1], child, node.pages)
            kept[-1].repeated = True
        else:
            kept.append(child)
    node.children = kept


def _counted(a: dict[str, int], b: dict[str, int], neighbours: bool) -> dict[str, int]:
    """Pages per text; what differs between neighbours of one page is no text of the template."""
    if neighbours:
        return {t: max(n, b[t]) for t, n in a.items() if t in b}
    total = dict(a)
    for t, n in b.items():
        total[t] = total.get(t, 0) + n
    if len(total) > KEPT_TEXTS:
        cut = sorted(total.values(), reverse=True)[KEPT_TEXTS]
        total = {t: n - cut for t, n in total.items() if n > cut}
    return total


def align(a: Node, b: Node, most: int | None = None) -> Node:
    """The wrapper that both sides match. ``most`` is given for neighbours: the pages of their parent."""
    out = Node(a.label, a.text if a.text == b.text else None)
    out.pages = a.pages + b.pages if most is None else min(most, a.pages + b.pages)
    if a.label == "#":
        out.texts = _counted(a.texts, b.texts, most is not None)
    most = None if most is None else out.pages
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    if not a.children and not b.children:
        return out
    left, right = a.children, b.children
    if [x.label for x in left] == [x.label for x in right]:
        out.children = [align(x, y, most) for x, y in zip(left, right)]
        return out
    for x, y in _matched(left, right):
        if x is not None and y is not None:
            out.children.append(align(x, y, most))
        else:
            one = x if y is None else y
            one.optional = True
            out.children.append(one)
    _fold(out)
    return out


def _matched(left: list[Node], right: list[Node]):
    """Both sides in order: pairs of equal labels, and ``None`` beside what only one side has.

    Equal beginnings and ends are matched first. What is left is aligned by its longest common sequence, in stretches of at most
    ``STRETCH`` children of each side, so that memory stays bounded however many children there are.
    """
    n, m = len(left), len(right)
    head = tail = 0
    while head < min(n, m) and left[head].label == right[head].label:
        head += 1
    while tail < min(n, m) - head and left[n - 1 - tail].label == right[m - 1 - tail].label:
        tail += 1
    yield from zip(left[:head], right[:head])
    middle_left, middle_right = left[head: n - tail], right[head: m - tail]
    stretches = max(1, -(-max(len(middle_left), len(middle_right)) // STRETCH))
    for k in range(stretches):
        yield from _common(middle_left[k * len(middle_left) // stretches: (k + 1) * len(middle_left) // stretches],
                           middle_right[k * len(middle_right) // stretches: (k + 1) * len(middle_right) // stretches])
    yield from zip(left[n - tail:], right[m - tail:])


def _common(left: list[Node], right: list[Node]):
    n, m = len(left), len(right)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i].label == right[j].label else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and left[i].label == right[j].label:
            yield left[i], right[j]
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            yield left[i], None
            i += 1
        else:
            yield None, right[j]
            j += 1


def expression(node: Node) -> str:
    """The wrapper as a union-free regular expression over elements, for people."""
    inner = "#slot" if node.label == "#" and node.text is None else repr(node.text) if node.label == "#" else f"<{node.label}>" + "".join(map(expression, node.children)) + "</>"
    return f"({inner})" + ("*" if node.repeated and node.optional else "+" if node.repeated else "?") if node.optional or node.repeated else inner


@lru_cache(maxsize=1 << 16)
def _below(path: str, label: str) -> str:
    """The path of a child, of one length at any depth: whether it lies in a main part, and a hash of all labels."""
    inside = path[0] == "1" or label in ("article", "main") or label.endswith(".main")
    return ("1" if inside else "0") + hashlib.blake2b(f"{path[1:]}/{label}".encode(), digest_size=8).hexdigest()


_TOP = "0"


def _constants(wrapper: Node) -> tuple[dict[str, int], int]:
    """Pages per path and text of the template, and how many places are neither template nor rare."""
    found: dict[str, int] = {}
    slots, open_nodes = 0, [(wrapper, _TOP)]
    while open_nodes:
        node, path = open_nodes.pop()
        for child in node.children:
            usual, rare = 100 * child.pages >= SHARE * node.pages, 100 * child.pages <= (100 - SHARE) * node.pages
            if child.label == "#":
                agreed = {t: n for t, n in child.texts.items() if 100 * n >= SHARE * node.pages}
                for text, n in agreed.items():
                    key = f"{path}\x00{text}"
                    found[key] = max(n, found.get(key, 0))
                slots += not agreed and not rare
            elif usual:
                open_nodes.append((child, _below(path, child.label)))
            else:
                slots += not rare
    return found, slots


def template(wrapper: Node) -> list[str]:
    """Constants of the wrapper with their path; none if the wrapper cannot tell template from text."""
    found, slots = _constants(wrapper)
    if not slots:
        return []
    return sorted(x for x, n in found.items() if n >= (LEAST_PAGES_INSIDE if x[0] == "1" else LEAST_PAGES))


def main_text(page: str, constants: frozenset[str]) -> str:
    """Blocks of the main part in page order, white space normalised, joined by one blank."""
    root = parse(page)
    mains: list[tuple[Node, str]] = []
    for wanted in (lambda x: x == "article", lambda x: x == "main", lambda x: x.endswith(".main")):
        todo = [(root, _TOP)]
        while todo:
            node, path = todo.pop()
            if node is not root and wanted(node.label):
                mains.append((node, path))
            else:
                todo += [(c, _below(path, c.label)) for c in reversed(node.children) if c.label != "#"]
        if any(_has_text(node) for node, _ in mains):
            break
        mains.clear()
    parts: list[str] = []
    for top, top_path in mains or [(root, _TOP)]:
        todo: list[tuple[Node | None, str]] = [(top, top_path)]  # None: the border of a block
        while todo:
            node, path = todo.pop()
            if node is None:
                parts.append(" ")
                continue
            if node.label == "#":
                text = entities.unescape(node.text)
                if f"{path}\x00{_BLANKS.sub(' ', text).strip()}" not in constants:
                    parts.append(text)
                continue
            if node is not top and not node.inline:
                parts.append(" ")
                todo.append((None, path))
            todo += [(c, path if c.label == "#" else _below(path, c.label)) for c in reversed(node.children)]
        parts.append(" ")
    return _BLANKS.sub(" ", "".join(parts)).strip()


def _has_text(node: Node) -> bool:
    todo = [node]
    while todo:
        for child in todo.pop().children:
            if child.label != "#":
                todo.append(child)
            elif child.text.strip():
                return True
    return False


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _dump(node: Node) -> bytes:
    """All nodes in a row, parents first, each with the number of its children."""
    rows, todo = [], [node]
    while todo:
        x = todo.pop()
        rows.append((x.label, x.text, x.optional, x.repeated, x.pages, x.texts, len(x.children)))
        todo += reversed(x.children)
    return pickle.dumps(rows)


def _load(data: bytes) -> Node:
    top = Node("")
    todo = [(top, 1)]  # nodes that still want children
    for label, text, optional, repeated, pages, texts, children in pickle.loads(data):
        node = Node(label, text)
        node.optional, node.repeated, node.pages, node.texts = optional, repeated, pages, texts
        parent, wanted = todo.pop()
        parent.children.append(node)
        if wanted > 1:
            todo.append((parent, wanted - 1))
        if children:
            todo.append((node, children))
    return top.children[0]


def infer(pages: DataFrame) -> DataFrame:
    """``host, constants``: what the wrapper of each host holds fixed."""
    prepare(pages.sparkSession)

    def partial(frames):
        sys.setrecursionlimit(FRAMES)
        found: dict[str, Node] = {}
        for frame in frames:
            for host, page in zip(frame["host"], frame["html"]):
                tree = parse(page or "")
                if _has_text(tree):
                    one = _wrapper(tree)
                    found[host] = align(found[host], one) if host in found else one
            if len(found) > 2000:  # many hosts: hand on what there is
                yield pd.DataFrame([(h, _dump(w)) for h, w in found.items()], columns=["host", "wrapper"])
                found = {}
        yield pd.DataFrame([(h, _dump(w)) for h, w in found.items()], columns=["host", "wrapper"])

    def whole(frame):
        sys.setrecursionlimit(FRAMES)
        wrapper = reduce(align, map(_load, frame["wrapper"]))
        return pd.DataFrame([(frame["host"].iloc[0], template(wrapper))], columns=["host", "constants"])

    partials = pages.select(_host(F.col("url")).alias("host"), "html").mapInPandas(partial, "host string, wrapper binary")
    return partials.groupBy("host").applyInPandas(whole, "host string, constants array<string>")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page. Wrappers are joined by host; Spark broadcasts them where they are small."""
    known = stored(infer(pages).where(F.size("constants") > 0), "wrappers")
    rows = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host")).join(known, "host", "left").select("page_id", "url", "html", "constants")

    def apply(frames):
        for frame in frames:
            texts = [main_text(p or "", frozenset(c if c is not None else ())) for p, c in zip(frame["html"], frame["constants"])]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts})

    out = rows.mapInPandas(apply, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
