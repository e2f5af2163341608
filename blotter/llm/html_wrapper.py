"""Main text of web pages by wrapper induction.

Pages of one host are aligned in blocks: their DOM trees (runs of like siblings folded into one list node, as templates
repeat records) are matched by simple tree matching with the block's first page. A text that stands at the same template
place in most of the block's different pages belongs to the template; slots that vary hold content. Content is taken from the
``article`` or ``main`` element if there is one, else from the varying slots of the body. Induction decides where the article
is: inside an ``article`` or ``main`` element with varying text, texts that all pages share (a heading, a byline) stay; without
such an element, those stay that stand between varying texts of the innermost element that has several of them and most of
their characters. Elements that by name or role aren't main text (menus, headers, footers, forms, scripts) never count. A class or id that says so (sidebar, notice, advert, comments)
must say it as a whole name, and doesn't count against what was induced: where an element so named holds the page's article,
or most of its varying text, its name is ignored.

Blocks hold a bounded number of pages by a salt on the host, so a host with a third of all pages is many groups, and
every page is aligned with others of its host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.shared import kept

#: Pages aligned together, on average.
BLOCK = 32
#: A text is template if it stands at its place in this share of a block's different pages, and in so many at least.
SHARE, LEAST = 0.6, 3

#: A quote is alone only where none closes it, and nothing is tried twice; where so no tag ends, it ends at the next ``>``.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+(?=>)|[^>]*+)>|<[!?][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Elements that hold no main text.
SKIP = {"script", "style", "noscript", "template", "head", "title", "nav", "footer", "aside", "form", "button", "select", "option", "textarea", "input", "iframe", "object", "svg", "canvas",
        "dialog", "menu", "noembed", "noframes", "audio", "video", "map", "datalist"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "form"}
#: Class and id names that mark such elements: whole names, not parts of others (``has-sidebar``, ``search-results``).
MARK = re.compile(
    r"(?:(?:top|bottom|left|right|main|site|page|global|primary|secondary|header|footer|side|mobile|cookies?|social|google)[_-])*"
    r"(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tions?)?|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-?bar|aside|footer|masthead|"
    r"site-?header|page-?header|cookies?|consent|notices?|gdpr|popup|modal|overlay|comments?|disqus|respond|replies|share|sharing|social|related|recommended|newsletter|subscribe|signup|"
    r"login|search|pagination|pager|skip-?link|copyright|widget|toolbar|hidden)(?:[_-](?:bar|box|banner|notice|menu|links?|list|form))*", re.I)
HEADER = re.compile(r"(?:header|top-?bar)", re.I)
#: What ``Node.skip`` has for elements that never count; else the numbers of the elements around it that a name marks.
NEVER = (0,)
#: Start tags that end an open paragraph.
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main",
          "nav", "ol", "p", "pre", "section", "table", "ul"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}}
STOPS = {"ul", "ol", "table", "dl", "select", "article", "section", "div", "body", "html", "blockquote", "td", "th"}


class Place:
    """An element in page order, as seen from a block of text in it."""

    __slots__ = ("around", "number", "tag")

    def __init__(self, around: Place | None, number: int, tag: str):
        self.around, self.number, self.tag = around, number, tag


class Node:
    __slots__ = ("tag", "children", "skip", "text")

    def __init__(self, tag: str, skip: tuple[int, ...] = (), text: str = ""):
        self.tag, self.skip, self.text, self.children = tag, skip, text, []


def _attributes(s: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(s)}


def _skipped(tag: str, attrs: str, in_article: bool) -> str:
    """"never" if an element can't hold main text, "named" if a class or id says so, else ""."""
    if tag in SKIP:
        return "never"
    if tag == "header":
        return "" if in_article else "never"
    if not attrs or attrs.isspace():
        return ""
    a = _attributes(attrs)
    if a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return "never"
    names = f"{a.get('class', '')} {a.get('id', '')}".split()
    if tag in ("html", "body", "article", "main"):
        return "never" if tag == "article" and any(x.lower() in ("comment", "comments") for x in a.get("class", "").split()) else ""
    return "named" if any(MARK.fullmatch(x) or (not in_article and HEADER.fullmatch(x)) for x in names) else ""


def parse(page: str) -> Node:
    """The DOM tree of a page, tolerant of unclosed and misnested tags; a cut page ends where it ends."""
    root = Node("#root")
    stack = [root]
    articles = marks = 0

    def add_text(s: str) -> None:
        if s:
            top = stack[-1]
            if top.children and top.children[-1].tag == "#text":
                top.children[-1].text += s
            else:
                top.children.append(Node("#text", top.skip, s))

    def close(n: int) -> None:
        nonlocal articles
        for x in stack[n:]:
            articles -= x.tag in ("article", "main")
        del stack[n:]

    pos, low, last = 0, None, page.rfind(">")
    while True:
        m = TOKEN.search(page, pos) if pos <= last else None
        if not m:
            rest = page[pos:].partition("<!--")[0]  # of what follows the last tag, only a comment ends the text
            cut = re.search(r"<[!/?a-zA-Z][^<>]*$", rest)  # a tag that the page's end cuts
            add_text(rest[: cut.start()] if cut else rest)
            return root
        add_text(page[pos : m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in STOPS:
                    break
        elif tag in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ENDS[tag]:
                    close(k)
                    if tag in ("td", "th", "li", "dt", "dd", "option"):
                        break
                if k >= len(stack) or stack[k].tag in STOPS - {"td", "th"}:
                    break
        top = stack[-1]
        how = "never" if top.skip == NEVER else _skipped(tag, m[3], articles > 0)
        marks += how == "named"
        node = Node(tag, NEVER if how == "never" else (*top.skip, marks) if how else top.skip)
        top.children.append(node)
        if tag in RAW:
            if low is None:
                low = page.lower()
            end = low.find(f"</{tag}", pos)
            body = page[pos:] if end < 0 else page[pos:end]
            node.children.append(Node("#text", NEVER, body))
            pos = len(page) if end < 0 else low.find(">", end) + 1 or len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
            articles += tag in ("article", "main")


def blocks_of(root: Node) -> list[tuple[tuple[str, ...], str, tuple[int, ...], Place | None, Place]]:
    """(path, text, skip, article around it, element) of each block of text, in page order: text between block elements."""
    out: list = []
    held: list[str] = []
    place: list = [None]

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                path, skip, article, at = place[0]
                out.append((path, text, skip, article, at))
            held.clear()

    whole, n = Place(None, 0, "#root"), 0
    todo: list = [(root, (), None, whole, ())]
    while todo:
        node, path, article, at, after = todo.pop()
        if node is None:
            flush()
            continue
        if node.tag == "#text":
            if not held:
                place[0] = (path, node.skip, article, at)
            held.append(node.text)
            continue
        if node.tag == "br":
            held.append(" ")
            continue
        inline = node.tag in INLINE and node.skip == after
        if not inline:
            flush()
            if node is not root:
                n += 1
                at = Place(at, n, node.tag)
                article = at if node.tag in ("article", "main") else article
                path = (*path, node.tag)
            todo.append((None, (), None, whole, ()))
        for c in reversed(node.children):
            todo.append((c, path, article, at, node.skip))
    flush()
    return out


# ---------------------------------------------------------------- alignment


class Shape:
    """A tree of block elements for matching: like siblings in a row are one list node; texts stay with their node."""

    __slots__ = ("tag", "children", "texts")

    def __init__(self, tag: str):
        self.tag, self.children, self.texts = tag, [], []


def shape_of(items: list[tuple]) -> tuple[Shape, list[Shape]]:
    """The folded tree over the blocks' paths, and the node of each block."""
    root, nodes, stack = Shape("#root"), [], []
    for path, text, *_ in items:
        keep = 0
        while keep < len(stack) and keep < len(path) and stack[keep].tag == path[keep]:
            keep += 1
        del stack[keep:]
        for tag in path[keep:]:
            top = stack[-1] if stack else root
            node = Shape(tag)
            top.children.append(node)
            stack.append(node)
        node = stack[-1] if stack else root
        node.texts.append(text)
        nodes.append(node)
    return root, nodes


def match_trees(a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
    """The pairs of a largest top-down, order-preserving match of two trees with like roots (simple tree matching)."""
    sizes: dict[tuple[int, int], int] = {}  # of pairs with like tags

    def table(x: Shape, y: Shape) -> list[list[int]]:
        t = [[0] * (len(y.children) + 1)]
        for i, c in enumerate(x.children):
            row = [0]
            for j, d in enumerate(y.children):
                row.append(max(row[j], t[i][j + 1], t[i][j] + sizes.get((id(c), id(d)), 0)))
            t.append(row)
        return t

    # children before their parents, without recursion: pages may nest to any depth
    below: list[tuple[Shape, Shape, bool]] = [(a, b, False)]
    while below:
        x, y, ready = below.pop()
        if ready:
            sizes[id(x), id(y)] = 1 + table(x, y)[-1][-1]
        elif x.tag == y.tag:
            below.append((x, y, True))
            below += [(c, d, False) for c in x.children for d in y.children if c.tag == d.tag]

    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        if not x.children or not y.children:
            continue
        t = table(x, y)
        i, j = len(x.children), len(y.children)
        while i and j:
            s = sizes.get((id(x.children[i - 1]), id(y.children[j - 1])), 0)
            if s and t[i][j] == t[i - 1][j - 1] + s:
                todo.append((x.children[i - 1], y.children[j - 1]))
                i, j = i - 1, j - 1
            elif t[i][j] == t[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return pairs


def _unmarked(varying: list) -> list:
    """Of varying blocks, those that no named element holds.

    If no article is outside of named elements, a name is ignored that holds most of the articles' text, or without any
    most of the varying text.
    """
    article = [b for b in varying if b[3]]
    if any(not b[2] for b in article):  # comments may be longer than their article
        return [b for b in varying if not b[2]]
    held, inside = article or varying, Counter()
    for b in held:
        for mark in b[2]:
            inside[mark] += len(b[1])
    ignored = {mark for mark, n in inside.items() if 2 * n > sum(len(b[1]) for b in held)}
    return [b for b in varying if ignored.issuperset(b[2])]


def _main_slot(varying: list) -> int | None:
    """Number of the innermost element, below the body, with several varying texts and more than half of their characters; None if there is none."""
    inside: Counter = Counter()
    texts: Counter = Counter()
    places: dict[int, Place] = {}
    for b in varying:
        at = b[4]
        inside[at.number] += len(b[1])
        texts[at.number] += 1
        while at is not None and at.number not in places:
            places[at.number] = at
            at = at.around
    whole = sum(len(b[1]) for b in varying)
    for k in sorted(places, reverse=True):  # inner elements have greater numbers than those around them
        if texts[k] > 1 and 2 * inside[k] > whole:
            return None if places[k].tag in ("#root", "html", "body") else k
        if places[k].around is not None:
            inside[places[k].around.number] += inside[k]
            texts[places[k].around.number] += texts[k]
    return None


def _within(at: Place | None, k: int) -> bool:
    while at is not None and at.number > k:
        at = at.around
    return at is not None and at.number == k


def _content(blocks: list, varies: list[bool]) -> list:
    """The blocks of a page that are its content, ``varies`` telling template texts from others."""
    chosen = _unmarked([b for b, v in zip(blocks, varies) if v and b[2] != NEVER])
    if not chosen:
        return []
    marks = {m for b in chosen for m in b[2]}  # names that were ignored for what varies are for what doesn't
    article = [b for b in chosen if b[3]]
    ids = {id(b) for b in article or chosen}
    constant = [not v and b[2] != NEVER and marks.issuperset(b[2]) for b, v in zip(blocks, varies)]
    if article:
        numbers = {b[3].number for b in article}
        return [b for b, c in zip(blocks, constant) if id(b) in ids or (c and b[3] and b[3].number in numbers)]
    slot = _main_slot(chosen)
    if slot is None:
        return chosen
    own = [k for k, b in enumerate(blocks) if id(b) in ids and _within(b[4], slot)]
    return [b for k, (b, c) in enumerate(zip(blocks, constant)) if id(b) in ids or (c and own[0] < k < own[-1] and _within(b[4], slot))]


def extract(pages: list[str | None], share: float = SHARE, least: int = LEAST) -> list[str]:
    """Main texts of pages of one host (a block), by template induction over them.

    Pages with the same blocks count once, so copies of a page don't make its content template.
    """
    items = [blocks_of(parse(p)) if p else [] for p in pages]
    different: dict[tuple[str, ...], int] = {}
    for k, x in enumerate(items):
        different.setdefault(tuple(b[1] for b in x), k)
    kinds = sorted(different.values())
    shapes = {k: shape_of(items[k]) for k in kinds}
    template: Counter = Counter()
    places: dict[int, dict[int, object]] = {}
    for k in kinds:
        root, nodes = shapes[k]
        pairs = match_trees(shapes[kinds[0]][0], root)
        place = {id(y): id(x) for x, y in pairs}  # the template node, or by path where the first page has none
        places[k] = {id(n): place.get(id(n), items[k][i][0]) for i, n in enumerate(nodes)}
        template.update({(places[k][id(n)], items[k][i][1]) for i, n in enumerate(nodes)})
    need = max(least, share * len(kinds))
    out = []
    for x in items:
        k = different[tuple(b[1] for b in x)]
        nodes = shapes[k][1]
        varies = [template[places[k][id(n)], b[1]] < need for b, n in zip(x, nodes)]
        out.append("\n".join(b[1] for b in _content(x, varies)))
    return out


SCHEMA = "page_id long, url string, text string, n_chars long"


def _extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks are runs of rows with one (host, part); a run may go on in the next batch."""

    def done(rows: list) -> pa.RecordBatch:
        texts = extract([r[2] for r in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    held, key = [], None
    for b in batches:
        for host, part, i, url, page in zip(*(c.to_pylist() for c in b.columns)):
            if held and (host, part) != key:
                yield done(held)
                held = []
            key = (host, part)
            held.append((i, url, page))
    if held:
        yield done(held)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", block: int = BLOCK) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages``.

    Null and empty pages have an empty text. A null url, or one without a host, makes one group with others of its kind.
    Pages of a host with few pages are cleaned by element names and classes alone. Repeated rows count once in a template,
    and each gets its text; rows of one id and url that outnumber ``block`` are spread over parts by their place in the input.
    """
    url = F.col(f"`{url_col}`").cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(host.alias("host"), F.col(f"`{id_col}`").cast("long").alias("id"), url.alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    # the number of parts of each host; hosts of one block aren't listed. The join is split where a host is hot.
    sizes = kept(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(f"n > {block}"))
    parts = sizes.select(F.col("host").alias("large"), F.ceil(F.col("n") / block).alias("parts"))
    if sizes.count() <= 100_000:
        parts = F.broadcast(parts)
    keyed = rows.join(parts, F.col("host") == F.col("large"), "left")
    # rows of one id and url fall into one part, except those that would fill it by themselves
    same = kept(rows.groupBy(F.xxhash64("host", "id", "url").alias("same")).agg(F.count(F.lit(1)).alias("n")).where(f"n > {block}").select("same"))
    if same.count() <= 100_000:
        same = F.broadcast(same)
    keyed = keyed.withColumn("key", F.xxhash64("host", "id", "url")).join(same, F.col("key") == F.col("same"), "left")
    salt = F.when(F.col("same").isNull(), F.xxhash64("id", "url")).otherwise(F.xxhash64("key", F.monotonically_increasing_id()))
    keyed = keyed.withColumn("part", F.pmod(salt, F.coalesce("parts", F.lit(1))))
    keyed = keyed.select("host", "part", "id", "url", "html").repartition("host", "part").sortWithinPartitions("host", "part", "id")
    return keyed.mapInArrow(_extract_rows, SCHEMA)
