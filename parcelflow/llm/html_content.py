"""Main text of web pages by wrapper induction over the pages of a host.

The trees of a host's pages are aligned by simple tree matching and merged into
one template. Elements that hold the same text on nearly all pages are the site's
frame, inside a marked article too; slots whose text varies are content. Marked-up
menus, adverts and the like are no content on any page, nor are reader comments,
told by their repeated records. A page is parsed once, into a table of trees.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, with_texts_mapped
from parcelflow.session import new_work_dir

#: Pages a template needs before constant text counts as frame, and the share of pages that have it.
PAGES, SHARE = 3, 0.9
#: Tasks that one host's templates are dealt over before they meet.
DEALT = 64
#: Templates that a task holds before it passes them on.
HELD = 2000
#: Texts that a template node counts, beyond eight times those of a page; rarer ones make room, and counts then fall short by about an eighth of the pages at most.
COUNTS = 128
#: Share of the pages that must be counted for a text that makes room for others took from.
SURE = 0.775
#: Children of a template node beyond twice those of a page; with more, the rarer half is left out, and counts of what comes again are lower bounds.
CHILDREN = 128
#: Levels of a template; all text below the last is text of its element. Extraction itself has no limit.
LEVELS = 100

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tr td th", "table"), "option": ("option", "select"),
}
_CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _CLOSES.items()}
#: Start tags that end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that are never main text.
_FRAME_TAGS = frozenset("head title style script noscript template nav footer aside form button select textarea input iframe object svg canvas dialog menu datalist".split())
_FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Whole classes and ids that name parts other than main text.
_FRAME_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising cookie cookies cookie-banner cookie-consent cookie-notice gdpr newsletter sidebar nav navbar navigation breadcrumb breadcrumbs "
    "footer site-footer page-footer masthead topbar toolbar comments commentlist comment-list disqus disqus_thread popup modal pagination pager skip-link".split()
)
#: Those that may as well name a topic: such an element is frame if its text is mostly links, or by the host's template.
_LINK_CLASSES = frozenset(
    "sponsor sponsored promo promotion banner consent notice notices alert subscribe subscription signup aside menu comment reply replies respond discussion share sharing social "
    "related recommended recommendations widget widgets overlay login search copyright skip related-posts related-articles share-buttons social-links".split()
)
_HEADER_CLASSES = frozenset(("header", "site-header", "page-header"))
_NEVER_BY_CLASS = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
#: Words in compound names of boxes for adverts, side columns and reader comments, and words by which a name only says something about them.
_ADVERT_WORDS = frozenset("ad ads advert adverts advertisement sponsored".split())
_SIDE_WORDS = frozenset("sidebar rail".split())
_COMMENT_WORDS = frozenset("comment comments replies disqus".split())
_ABOUT_WORDS = frozenset("no not without has with in on off open closed enabled disabled allowed hide hidden free count".split())
#: Names of the parts of a comment that say who wrote it, and when.
_WHO_WORDS = frozenset("author user username commenter avatar".split())
_WHEN_WORDS = frozenset("date time timestamp when posted ago".split())
_BOXES = frozenset("div section ul ol li dl figure table article".split())
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_TEXT_TAGS = frozenset("p pre blockquote li dd td".split())
_WORDS = re.compile(r"[a-z0-9]+")


class Node:
    """An element: its tag, a name to match it by, its classes and id, its children and the texts among them."""

    __slots__ = ("tag", "name", "frame", "classes", "in_article", "children")

    def __init__(self, tag: str, name: str, frame: bool, classes: tuple[str, ...] = ()):
        self.tag, self.name, self.frame, self.classes = tag, name, frame, classes
        self.in_article = False  # or an article itself
        self.children: list[Node | str] = []


def _words(value: str | None) -> list[str]:
    return _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value or "").lower())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", "#root", False)
        self._open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _ENDS_P:
            self._close(frozenset("p"), _ENDS_P - {"p"} | {"td", "th", "li", "body"})
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        given = dict(attrs)
        words = [*_words(given.get("class")), *_words(given.get("id"))]
        in_article = self._open[-1].in_article
        frame = (
            tag in _FRAME_TAGS
            or (tag == "header" and not in_article)
            or (given.get("role") or "").lower() in _FRAME_ROLES
        )
        classes = () if frame or not words or tag in _NEVER_BY_CLASS else tuple(f"{given.get('class') or ''} {given.get('id') or ''}".split())
        if in_article:
            classes = tuple(c for c in classes if c.lower() not in _HEADER_CLASSES)
        node = Node(tag, ".".join([tag, *(w for w in words if not w.isdigit())]), frame, classes)
        node.in_article = in_article or tag in ("article", "main")
        self._open[-1].children.append(node)
        if tag not in _VOID:
            self._open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k].tag == tag:
                del self._open[k:]
                return
            if self._open[k].tag in ("article", "main", "body", "td", "th") and tag in _INLINE | {"p"}:
                return

    def _close(self, tags: frozenset[str], within: frozenset[str]) -> None:
        """End the innermost open element of ``tags``, if it is inside the innermost one of ``within``."""
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k].tag in tags:
                del self._open[k:]
            elif self._open[k].tag in within:
                return

    def handle_data(self, data: str) -> None:
        self._open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    _settle(builder.root)
    return builder.root


def _settle(root: Node) -> None:
    """Make frame what classes name as such: no element that holds an article or main, nor, where none is marked, most of the text."""
    order = [root]
    for node in order:
        if not node.frame:
            order += [c for c in node.children if not isinstance(c, str)]
    if any(node.classes for node in order):
        _settle_names(root, order)
    _settle_boxes(root)


def _settle_names(root: Node, order: list[Node]) -> None:
    size: dict[int, int] = {}
    links: dict[int, int] = {}
    regions: set[int] = set()
    for node in reversed(order):
        inside = [c for c in node.children if not isinstance(c, str) and not node.frame]
        size[id(node)] = 0 if node.frame else sum(len(squeezed(c)) for c in node.children if isinstance(c, str)) + sum(size[id(c)] for c in inside)
        links[id(node)] = size[id(node)] if node.tag == "a" else sum(links[id(c)] for c in inside)
        if not node.frame and (node.tag in ("article", "main") or any(id(c) in regions for c in inside)):
            regions.add(id(node))
    for node in order:
        classes = [c.lower() for c in node.classes]
        named = any(c in _FRAME_CLASSES or c in _HEADER_CLASSES for c in classes)
        linked = not named and 2 * links[id(node)] > size[id(node)] and any(c in _LINK_CLASSES for c in classes)
        node.frame = node.frame or ((named or linked) and id(node) not in regions and (id(root) in regions or 2 * size[id(node)] <= size[id(root)]))


def _compound(node: Node, wanted: frozenset[str]) -> bool:
    """Whether a class or id of several words has one of ``wanted`` and says nothing else about it."""
    return any(len(words) > 1 and wanted.intersection(words) and not _ABOUT_WORDS.intersection(words) for words in map(_words, node.classes))


def _settle_boxes(root: Node) -> None:
    """Make frame the boxes whose compound names and whose structure both tell adverts, side columns or reader comments, and signed and dated records.

    Adverts hold no heading, side columns stand outside articles, comments follow a
    heading or paragraph and, below a heading of their own, are repeated records.
    """
    order: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if not node.frame:
            order.append(node)
            todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    holds: set[int] = set()  # an article or main, or what holds one
    headed: set[int] = set()  # a heading, or what holds one
    for node in reversed(order):
        inside = [c for c in node.children if not isinstance(c, str) and not c.frame]
        if node.tag in ("article", "main") or any(id(c) in holds for c in inside):
            holds.add(id(node))
        if node.tag in _HEADINGS or any(id(c) in headed for c in inside):
            headed.add(id(node))
    place = {id(node): k for k, node in enumerate(order)}
    first = next((k for k, node in enumerate(order) if node.tag == "p" or node.tag in _HEADINGS), len(order))
    for k, node in enumerate(order):
        begun = k > first
        for run in _record_runs(node) if node.children else ():
            if place.get(id(run[0]), 0) > first and not any(id(record) in holds for record in run) and all(_signed(record) for record in run):
                for record in run:
                    record.frame = True
        if node.tag in _BOXES and node.classes and id(node) not in holds:
            node.frame = node.frame or (
                (id(node) not in headed and _compound(node, _ADVERT_WORDS))
                or (not node.in_article and _compound(node, _SIDE_WORDS))
                or (begun and _compound(node, _COMMENT_WORDS) and (id(node) not in headed or any(True for box in _boxes(node) for _ in _record_runs(box))))
            )


def _boxes(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        box = todo.pop()
        yield box
        todo += [c for c in box.children if not isinstance(c, str) and c.tag in _BOXES]


def _record_runs(node: Node) -> Iterator[list[Node]]:
    """Neighbouring boxes of one name and of one first part, two or more, that hold parts and no part of the outline."""
    run: list[Node] = []
    kind = None
    for child in [*node.children, None]:
        if isinstance(child, str):
            if not child.isspace():
                kind = None
            continue
        parts = [c for c in child.children if not isinstance(c, str)] if child is not None and child.tag in _BOXES else []
        own = (child.name, parts[0].name) if parts and len(parts) > 1 and not any(c.tag in ("h1", "h2") for c in parts) else None
        if own is None or own != kind:
            if len(run) > 1:
                yield run
            run, kind = [], own
        if own is not None:
            run.append(child)


def _signed(record: Node) -> bool:
    """Whether a record says who wrote it, and when."""
    who = when = False
    todo = [record]
    while todo and not (who and when):
        node = todo.pop()
        words = node.name.split(".")[1:] if node is not record else ()
        who = who or node.tag == "cite" or not _WHO_WORDS.isdisjoint(words)
        when = when or node.tag == "time" or not _WHEN_WORDS.isdisjoint(words)
        todo += [c for c in node.children if not isinstance(c, str)]
    return who and when


# A tree as a flat list, of any nesting: an element's tag, name and marks, its children, then 0.


def packed(root: Node) -> str:
    """The children of a page's root as JSON; scripts and styles are left out."""
    out: list = []
    todo: list = [0, *reversed(root.children)]
    while todo:
        child = todo.pop()
        if child == 0 or isinstance(child, str):
            out.append(child)
        elif child.tag not in ("script", "style"):
            out.append([child.tag, child.name, child.frame + 2 * child.in_article])
            todo.append(0)
            todo += reversed(child.children)
    return json.dumps(out)


def unpacked(tree: str) -> Node:
    root = Node("#root", "#root", False)
    path = [root]
    for child in json.loads(tree):
        if child == 0:
            path.pop()
        elif isinstance(child, str):
            path[-1].children.append(child)
        else:
            node = Node(child[0], child[1], bool(child[2] & 1))
            node.in_article = child[2] > 1
            path[-1].children.append(node)
            path.append(node)
    return root


def squeezed(text: str) -> str:
    return " ".join(text.split())


# A template node is [name, pages, pages by text hash, children, most that a count may fall short by, texts of all pages].
# Neighbours of one name count as one repeated node, each with its own text.


def shape(node: Node, sources: dict[int, list[Node]] | None = None) -> list:
    """The page as a template of one page; ``sources`` gets the elements behind each template node."""
    return _shape([node], sources, LEVELS)


def _shape(nodes: list[Node], sources: dict[int, list[Node]] | None, levels: int) -> list:
    runs: list[list[Node]] = []
    texts: dict[str, int] = {}
    for node in nodes:
        if own := _own_text(node) if levels else _hashed(_text(node)):
            texts[own] = 1
        for child in _parts(node) if levels else ():
            if runs and runs[-1][0].name == child.name:
                runs[-1].append(child)
            else:
                runs.append([child])
    made = _bounded([nodes[0].name, 1, texts, [_shape(run, sources, levels - 1) for run in runs], 0, len(texts)])
    if sources is not None:
        sources[id(made)] = nodes
    return made


def _parts(node: Node) -> list[Node]:
    """Child elements that are template nodes of their own."""
    return [c for c in node.children if not isinstance(c, str) and c.tag not in _INLINE and c.tag not in ("script", "style")]


def _own_text(node: Node) -> str:
    """Hash of the text outside the parts; empty if there is none."""
    return _hashed(" ".join(c if isinstance(c, str) else _text(c) for c in node.children if isinstance(c, str) or c.tag in _INLINE))


def _hashed(text: str) -> str:
    text = squeezed(text)
    return f"{zlib.crc32(text.encode('utf-8', 'replace')):x}" if text else ""


def _bounded(node: list) -> list:
    """Take the count of the first text too many from all: counts of disjoint sets of pages still add up to lower bounds."""
    most = COUNTS + 8 * node[5] // node[1]
    if len(node[2]) > most:
        less = sorted(node[2].values(), reverse=True)[most]
        node[2] = {text: n - less for text, n in node[2].items() if n > less}
        node[4] += less
    return node


def _text(node: Node) -> str:
    out: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        child = todo.pop()
        if isinstance(child, str):
            out.append(child)
        elif child.tag == "br":
            out.append(" ")
        else:
            todo += reversed(child.children)
    return "".join(out)


def _matched(a: list, b: list) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired, parents with parents and in order."""
    return 1 + _aligned(a[3], b[3])[-1][-1] if a[0] == b[0] else 0


def _aligned(left: list, right: list) -> list[list[int]]:
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, a in enumerate(left, 1):
        for j, b in enumerate(right, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + _matched(a, b))
    return best


def pairs(left: list, right: list) -> list[tuple[list | None, list | None]]:
    """Children of two matched nodes side by side, in order; None where one has no partner."""
    if [a[0] for a in left] == [b[0] for b in right]:
        return list(zip(left, right, strict=True))
    best, i, j, out = _aligned(left, right), len(left), len(right), []
    while i or j:
        if i and j and left[i - 1][0] == right[j - 1][0] and best[i][j] > max(best[i - 1][j], best[i][j - 1]):
            i, j = i - 1, j - 1
            out.append((left[i], right[j]))
        elif j and (not i or best[i][j] == best[i][j - 1]):
            j -= 1
            out.append((None, right[j]))
        else:
            i -= 1
            out.append((left[i], None))
    return out[::-1]


def merged(a: list, b: list) -> list:
    """The template of the pages of two templates with the same root."""
    children = [merged(x, y) if x and y else x or y for x, y in pairs(a[3], b[3])]
    texts = a[2] | {text: n + a[2].get(text, 0) for text, n in b[2].items()}
    return _pruned(_bounded([a[0], a[1] + b[1], texts, children, a[4] + b[4], a[5] + b[5]]))


def _pruned(node: list) -> list:
    """Leave out the rarest children of a node with far more than its pages have: frame is on nearly all pages, so it is among those that stay."""
    most = CHILDREN + 2 * sum(child[1] for child in node[3]) // node[1]
    if len(node[3]) > most:
        order = sorted(range(len(node[3])), key=lambda k: -node[3][k][1])
        node[3] = [node[3][k] for k in sorted(order[: most // 2])]
        node[4] += 1  # what was left out is on some pages only
    return node


def _varies(node: list, pages: int) -> bool:
    return node[4] > 0 or any(n < pages for n in node[2].values()) or any(_varies(child, pages) for child in node[3])


def usable(template: list) -> list | None:
    """The template with the texts of nearly all its pages only; none for few pages, or equal ones."""

    def common(node: list) -> list:
        texts = {text: template[1] for text, n in node[2].items() if n >= SURE * template[1] and n + node[4] >= SHARE * template[1]}
        return [node[0], node[1], texts, [common(child) for child in node[3]], node[4] + (len(texts) < len(node[2])), len(texts)]

    return common(template) if template[1] >= PAGES and _varies(template, template[1]) else None


def _frame_nodes(root: Node, template: list) -> set[int]:
    """Elements of the page whose texts, and those of all parts, the template has there on nearly all pages."""
    sources: dict[int, list[Node]] = {}
    own = shape(root, sources)
    met: list[tuple[Node, list | None, bool]] = []
    todo: list[tuple[list, list | None, int]] = [(own, template, LEVELS)]
    while todo:
        own, node, levels = todo.pop()
        met += [(element, node, levels > 0) for element in sources[id(own)]]
        todo += [(x, y, levels - 1) for x, y in (pairs(own[3], node[3]) if node else zip(own[3], [None] * len(own[3]), strict=True)) if x]
    frame: set[int] = set()
    for element, node, above in reversed(met):  # parts come before what holds them
        text = _own_text(element) if above else _hashed(_text(element))
        if node and (not text or node[2].get(text, 0) >= SHARE * template[1]) and not (above and any(id(part) not in frame for part in _parts(element))):
            frame.add(id(element))
    for element, _, _ in met:
        _keep_openings(element, frame)
    return frame


def _keep_openings(parent: Node, frame: set[int]) -> None:
    """Take paragraphs without a class that open a text out of ``frame``: those before its first varying one, on top of a page only below a heading."""
    parts = _parts(parent)
    varying = next((k for k, part in enumerate(parts) if part.name == "p" and id(part) not in frame), 0)
    text = parent.in_article or parent.tag not in ("body", "html", "#root")
    for part in parts[:varying]:
        text = text or (part.tag in _HEADINGS and id(part) not in frame)
        if text and part.name == "p":
            frame.discard(id(part))


def main_text(html: str, template: list | None) -> str:
    """Blocks of the main text, one per line.

    The regions marked as article or main are the main text, but for teasers: an
    article without a paragraph or heading, or with a link as its heading, or, below
    a first-level heading outside, with lesser headings from the third level on. With no other
    region the whole page is. Text that the template calls frame is left out, unless
    it leaves no paragraph of the regions nor one beside them: these are copies.
    """
    return _main_text(parse(html), usable(template) if template else None)


def _main_text(root: Node, known: list | None) -> str:
    """The same for a page that is parsed and a template that is usable."""
    frame = _frame_nodes(root, known) if known else set()
    regions = _regions(root)
    if not regions:
        return _blocks([root], frame, whole=True)
    if not frame or _has_paragraph(regions, frame) or not _has_paragraph(regions, set()):
        if marked := _blocks(regions, frame):
            return marked
    return _blocks([root], frame, whole=True) if _has_paragraph([root], frame) else _blocks(regions, set())


def _has_paragraph(regions: list[Node], frame: set[int]) -> bool:
    todo = list(regions)
    while todo:
        node = todo.pop()
        if node.frame or id(node) in frame:
            continue
        if node.tag in _TEXT_TAGS and not _text(node).isspace() and _text(node):
            return True
        todo += [c for c in node.children if isinstance(c, Node)]
    return False


def _blocks(regions: list[Node], frame: set[int], whole: bool = False) -> str:
    blocks: list[str] = []
    for region in regions:
        _collect(region, frame, blocks, whole)
    return "\n".join(blocks)


def _regions(root: Node) -> list[Node]:
    """The outermost article and main elements that are neither frame nor teasers."""
    found, teasers, outside = [], [], False
    todo = [root]
    while todo:
        node = todo.pop()
        if node is not root and node.tag in ("article", "main"):
            level = _outline(node) if node.tag == "article" else 1
            (found if level else teasers).append((node, level))
        else:
            outside = outside or node.tag == "h1"
            todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.frame]
    if outside and all(2 < level < 7 for _, level in found):
        return []
    return [node for node, _ in found]


def _outline(article: Node) -> int:
    """The level of the first heading of an article, 7 if it has paragraphs or other parts only; 0 for a teaser."""
    parts = False
    todo = [(article, False)]
    while todo:
        node, linked = todo.pop()
        if node.tag in _HEADINGS:
            inside = [c for c in node.children if not (isinstance(c, str) and c.isspace())]
            return 0 if linked or (inside and all(isinstance(c, Node) and c.tag == "a" for c in inside)) else int(node.tag[1])
        parts = parts or (node is not article and node.tag not in _INLINE)
        todo += [(c, linked or c.tag == "a") for c in reversed(node.children) if isinstance(c, Node) and not c.frame]
    return 7 if parts else 0


def _menus(root: Node) -> set[int]:
    """Lists and boxes of three links or more with no text beside them."""
    order = [root]
    for node in order:
        order += [c for c in node.children if isinstance(c, Node) and c.tag != "a"]
    links: dict[int, int] = {}
    beside: set[int] = set()
    for node in reversed(order):
        links[id(node)] = sum(1 if c.tag == "a" else links[id(c)] for c in node.children if isinstance(c, Node))
        if any(not c.isspace() if isinstance(c, str) else id(c) in beside for c in node.children):
            beside.add(id(node))
    return {id(n) for n in order if n.tag in ("ul", "ol", "div", "table", "p") and links[id(n)] >= 3 and id(n) not in beside}


def _collect(root: Node, frame: set[int], blocks: list[str], whole: bool) -> None:
    line: list[str] = []
    menus = _menus(root) if whole else ()

    def end() -> None:
        if text := squeezed("".join(line)):
            blocks.append(text)
        line.clear()

    todo: list[Node | str | None] = [None, *reversed(root.children)]
    while todo:
        child = todo.pop()
        if child is None:  # the end of a block
            end()
        elif isinstance(child, str):
            line.append(child)
        elif child.tag == "br":
            line.append(" ")
        elif child.frame or id(child) in frame or id(child) in menus:
            if child.tag not in _INLINE:
                end()
        elif child.tag in _INLINE:
            todo += reversed(child.children)
        else:
            end()
            todo.append(None)
            todo += reversed(child.children)


def host_of(url: str) -> Column:
    """The lower-cased host of a URL; null if it has none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(host, F.lit(""))


_TEMPLATE = "host string, template string"


def _rows(templates: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(templates.keys(), pa.string()), pa.array([json.dumps(t) for t in templates.values()], pa.string())], ["host", "template"])


def _trees(batch: pa.RecordBatch) -> pa.Array:
    """The tree of each page; empty for pages without html."""
    return pa.array([packed(parse(html)) if (html or "").strip() else "" for html in batch.column("text").to_pylist()], pa.string())


def templates(trees: DataFrame) -> DataFrame:
    """host, template from the trees of all pages: merged in each task, then over tasks in two steps, one template in memory at a time."""

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in by_bytes(batches, "tree"):
            for host, tree in zip(batch.column("host").to_pylist(), batch.column("tree").to_pylist(), strict=True):
                if not tree:
                    continue
                page = shape(unpacked(tree))
                held[host] = merged(held[host], page) if host in held else page
            if len(held) > HELD:
                yield _rows(held)
                held.clear()
        yield _rows(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, made = None, None
        for batch in batches:
            done = {}
            for name, template in zip(batch.column("host").to_pylist(), batch.column("template").to_pylist(), strict=True):
                if name == host:
                    made = merged(made, json.loads(template))
                else:
                    if host is not None:
                        done[host] = made
                    host, made = name, json.loads(template)
            yield _rows(done)
        if host is not None:
            yield _rows({host: made})

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                host, template = (c[one].as_py() for c in batch.columns)
                if made := usable(json.loads(template)):
                    yield _rows({host: made})

    first = trees.where("host is not null").select("host", "tree").mapInArrow(induce, _TEMPLATE).withColumn("_deal", F.pmod(F.xxhash64("template"), F.lit(DEALT)))
    second = first.repartition("host", "_deal").sortWithinPartitions("host", "template").select("host", "template").mapInArrow(meet, _TEMPLATE)
    return second.repartition("host").sortWithinPartitions("host", "template").mapInArrow(meet, _TEMPLATE).mapInArrow(keep, _TEMPLATE)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    A page's text is that of :func:`main_text`, by the template of its host. Null and
    empty html give an empty text; pages without a host, or
    of hosts with fewer than ``PAGES`` pages or with equal pages only, have no
    template, and empty pages count for none. Repeated rows are extracted each and
    count as pages each. Very long pages are read whole, one at a time. Other columns
    are not read.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", F.col("html").alias("text")).withColumn("host", host_of("url"))
    parsed, folder = new_work_dir(spark, "trees"), new_work_dir(spark, "templates")
    with_texts_mapped(rows, "tree", "string", lambda: _trees, drop=("text",)).write.parquet(parsed)
    trees = spark.read.parquet(parsed)
    templates(trees).write.parquet(folder)

    def start():
        known: dict[str, list] = {}

        def text(batch: pa.RecordBatch) -> pa.Array:
            out = []
            for tree, template in zip(batch.column("text").to_pylist(), batch.column("template").to_pylist(), strict=True):
                if template is not None and template not in known:
                    if len(known) > HELD:
                        known.clear()
                    known[template] = json.loads(template)
                out.append(_main_text(unpacked(tree), known.get(template)) if tree else "")
            return pa.array(out, pa.string())

        return text

    joined = trees.join(spark.read.parquet(folder), "host", "left").select("page_id", "url", F.col("tree").alias("text"), "template")
    found = with_texts_mapped(joined, "main", "string", start, drop=("text", "template"))
    return found.select("page_id", "url", F.col("main").alias("text"), F.char_length("main").cast("long").alias("n_chars"))
