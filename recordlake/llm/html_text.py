"""Main text of web pages: paragraphs pass points to their ancestors, the best container and like siblings are kept."""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that are no main text, whatever they score.
DROPPED = frozenset(
    "head title script style noscript template nav footer aside button select option textarea input iframe object embed svg math canvas audio video dialog menu".split()
)
#: Words of a class, id or role that mark the same; how they count is said at _judge.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup modal overlay sidebar"
    " aside rail widget menu menubar nav navbar navigation breadcrumb breadcrumbs toolbar footer masthead header comment comments reply replies disqus respond discussion related recommended share"
    " sharing social follow newsletter subscribe signup login pager pagination contentinfo complementary search".split()
)
#: Of these, words that prose is named by too: their elements go only if they are mostly links or hold no sentence.
COMMON = frozenset(
    "aside banner consent discussion notice notices alert overlay rail widget menu navigation header masthead reply replies respond related recommended share sharing social follow"
    " promo promotion promoted search".split()
)
#: Of these again, words that name a box of no article, where they are all of a class or id.
NOTICES = frozenset("notice notices alert consent banner overlay promo promotion promoted".split())
BOX = "a notice by all of its name"
COMMENTS = frozenset("comment comments reply replies disqus respond discussion".split())
#: Points that a marked element loses.
MARK_POINTS = 25.0
#: Elements whose ids are anchors, made from titles; the first are text and go for a class of marks alone.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre figcaption".split())
ANCHORED = TEXT | {"section"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that make a class name a state of its element.
STATES = frozenset("has no without with is not open closed enabled disabled free".split())
HOLDS_TEXT = frozenset("p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption div section article main body html".split())
BASE = {"article": 25.0, "main": 15.0, "section": 5.0, "div": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "form": -3.0, "th": -5.0}
#: A start tag of the key ends an open element of the value, up to the nearest of its bounds.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

#: A start or end tag; a quote counts after an equals sign. The loose form, for markup whose quotes do not end, ends at the next >.
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
_NAMED = re.compile(r"</?[a-zA-Z]")
#: Elements whose contents are no markup, and where they end.
_RAW = {t: re.compile(rf"</{t}\s*+>", re.I) for t in ("script", "style", "textarea", "noscript", "template")}
_STOP = re.compile(r"[.!?…](?:[\s\"'”’)]|$)")
_MARK = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_COMMENT = re.compile(r"""["'\s](?:comment|reply)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: What says of whom a page is.
_OWNED = re.compile(r"©|\(c\)|copyright|all rights reserved", re.I)


_NO_MARKS: frozenset[str] = frozenset()


class Node:
    __slots__ = ("tag", "parent", "kids", "gone", "inside", "marks", "score", "chars", "linked", "stops", "prose", "tools")

    def __init__(self, tag: str, parent: Node | None, gone: bool):
        self.tag, self.parent, self.gone = tag, parent, gone
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.kids: list[Node | str] = []
        self.marks: set[str] | frozenset[str] = _NO_MARKS
        self.score = BASE.get(tag, 0.0)
        self.chars = self.linked = self.stops = 0
        self.prose, self.tools = 0.0, False


def _marks(tag: str, attrs: str, inside: bool) -> set[str]:
    """Words of a class, id or role by which the element may be no main text; has-comments and the like say nothing.

    inside: within an article or main. There, and for text, an id is an anchor and a class counts if all of it is marks.
    """
    out: set[str] = set()
    if inside and tag in HEADINGS:
        return out
    for m in _MARK.finditer(attrs):
        if m[1].lower() == "id" and (inside or tag in ANCHORED):
            continue
        for name in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in _WORD.findall(name)]
            if words and words[0] not in STATES and words[-1] not in STATES:
                own = {w for w in words if w in MARKS and not (inside and w in ("header", "masthead"))}
                whole = len(own) == len(set(words))
                if whole or not (inside or tag in TEXT):
                    out |= own
                if whole and own & NOTICES:
                    out.add(BOX)
    return out


def _tokens(html: str):
    """(text, tag, whether it ends, attributes) of runs of text and of tags, in one pass however the markup is broken.

    Comments, declarations and what scripts and the like hold are left out. Where no > is left, the rest is text; a
    comment or script that does not end takes the rest.
    """
    at = text = 0
    tag = _TAG
    while (lt := html.find("<", at)) >= 0:
        if html[lt + 1 : lt + 2] in ("!", "?"):
            comment = html.startswith("<!--", lt)
            stop = html.find("-->", lt + 4) if comment else html.find(">", lt)
            if stop < 0 and not comment:
                break
            end, name = (stop + (3 if comment else 1) if stop >= 0 else len(html)), None
        else:
            m = tag.match(html, lt)
            if m is None:
                if not _NAMED.match(html, lt):
                    at = lt + 1
                    continue
                if html.find(">", lt) < 0:
                    break
                tag = _LOOSE  # read to the end in vain once, and never again
                m = tag.match(html, lt)
            end, name, shut, attrs = m.end(), m[2].lower(), m[1] != "", m[3]
        if lt > text:
            yield html[text:lt], None, False, ""
        if name:
            if not shut and name in _RAW:
                stop = _RAW[name].search(html, end)
                end = stop.end() if stop else len(html)
            else:
                yield "", name, shut, attrs
        at = text = end
    if text < len(html):
        yield html[text:], None, False, ""


def parse(html: str) -> Node:
    """A tree that closes what authors leave open: paragraphs at the next block, items at the next item.

    Where elements of a tag and blocks are open is kept by place, so that no step searches the open ones.
    """
    root = Node("html", None, False)
    open_: list[Node] = [root]
    at: dict[str, list[int]] = {}
    blocks: list[int] = []

    def shut(k: int) -> None:
        while len(open_) > k:
            tag = open_.pop().tag
            at[tag].pop()
            if tag in BLOCK:
                blocks.pop()

    nearest = lambda tags: max((at[t][-1] for t in tags if at.get(t)), default=0)
    for text, tag, ends, attrs in _tokens(html):
        if tag is None:
            open_[-1].kids.append(_html.unescape(text))
            continue
        if ends:
            mine = at.get(tag)
            k = mine[-1] if mine else 0
            if k and (tag in BLOCK or not blocks or k > blocks[-1]):
                shut(k)
            continue
        if tag in BLOCK and blocks and open_[blocks[-1]].tag == "p":
            shut(blocks[-1])
        if tag in CLOSES:
            mine, bounds = (nearest(x) for x in CLOSES[tag])
            if mine > bounds:
                shut(mine)
        if tag == "html" or (tag == "body" and at.get("body")):
            continue
        up = open_[-1]
        node = Node(tag, up, up.gone or tag in DROPPED)
        if node.gone and not up.gone:
            for k in at.get("header", ()):  # a header with a menu or a search field
                open_[k].tools = True
        if attrs and tag not in ("body", "main") and (tag != "article" or _COMMENT.search(attrs) is not None):
            node.marks = _marks(tag, attrs, node.inside)
        up.kids.append(node)
        if tag not in VOID and not attrs.rstrip().endswith("/"):
            at.setdefault(tag, []).append(len(open_))
            if tag in BLOCK:
                blocks.append(len(open_))
            open_.append(node)
    return root


def _walk(root: Node):
    """Nodes in page order, each with whether it lies in a link."""
    stack = [(root, False)]
    while stack:
        node, linked = stack.pop()
        yield node, linked
        for k in reversed(node.kids):
            if k.__class__ is Node and not k.gone:
                stack.append((k, linked or k.tag == "a"))


def _own_text(node: Node) -> str:
    """Text of a node and the inline elements in it."""
    out, stack = [], list(reversed(node.kids))
    while stack:
        k = stack.pop()
        if isinstance(k, str):
            out.append(k)
        elif not k.gone and k.tag not in BLOCK:
            stack += reversed(k.kids)
    return " ".join("".join(out).split())


def _count(nodes: list[tuple[Node, bool]]) -> None:
    """Characters of each node, those of them in links, and ends of sentences."""
    for node, linked in reversed(nodes):  # children before parents
        node.chars = node.linked = node.stops = 0
        for k in node.kids:
            if isinstance(k, str):
                n = len(k.strip())
                node.chars += n
                node.linked += n if linked else 0
                node.stops += len(_STOP.findall(k))
            elif not k.gone:
                node.chars += k.chars
                node.linked += k.linked
                node.stops += k.stops


def _points(text: str) -> float:
    return 1 + text.count(",") + min(len(text) / 100, 3)


def _weigh(nodes: list[tuple[Node, bool]]) -> None:
    """Points of the sentences below each node, less what is in links."""
    for node, _ in reversed(nodes):
        node.prose = sum((k.prose for k in node.kids if k.__class__ is Node and not k.gone), 0.0)
        if node.tag in HOLDS_TEXT and node.stops:
            text = _own_text(node)
            if _STOP.search(text):
                node.prose += _points(text) * (1 - node.linked / node.chars)


def _judge(root: Node) -> list[tuple[Node, bool]]:
    """The nodes that are left once doubtful ones are judged by their points.

    A form, and an element marked like a menu or a notice, goes if the rest of the page has as many points: else it is
    what the page is in. A header goes if it has links or tools, or is the page's. Comments go last, whatever their
    points, if any prose is left besides. Of marks that prose has too, elements of sentences stay.
    """

    def walked() -> list[tuple[Node, bool]]:
        nodes = list(_walk(root))
        _count(nodes)
        _weigh(nodes)
        return nodes

    prose_marks = lambda n: n.marks <= COMMON and 2 * n.linked <= n.chars and n.stops > 0
    nodes = walked()
    weight = lambda n: n.prose if root.prose else float(n.chars)
    whole = weight(root)
    for node, _ in nodes:
        if node.tag == "header" and not node.inside:
            node.gone = node.tools or node.linked > 0 or node.parent is None or node.parent.tag in ("html", "body")
        elif node.tag == "form":
            node.gone = 2 * weight(node) <= whole
        elif node.marks and not node.marks & COMMENTS and 2 * weight(node) <= whole:
            node.gone = not prose_marks(node)
            node.score -= MARK_POINTS
    nodes = walked()
    said = [n for n, _ in nodes if n.marks & COMMENTS]
    for node in said:
        node.gone = not prose_marks(node)
    if said:
        nodes = walked()
        if not root.prose:  # the page is its comments, or they are in a frame that is called so
            for node in said:
                node.gone = False
            nodes = walked()
    return nodes


def best_nodes(root: Node) -> list[Node]:
    """The container of the main text and the siblings that belong to it, in page order."""
    nodes = list(_walk(root))
    _count(nodes)
    if any(n.marks or n.tag in ("form", "header") for n, _ in nodes):
        nodes = _judge(root)
    scored = []
    for node, _ in nodes:
        if node.tag not in HOLDS_TEXT:
            continue
        text = _own_text(node)
        if not text:
            continue
        points = _points(text)
        up, share = node if node.tag in ("div", "section", "article", "main", "body", "html") else node.parent, 1.0
        while up is not None and share > 0.1:
            up.score += points * share
            scored.append(up)
            up, share = up.parent, share / 2
    density = lambda n: n.linked / n.chars if n.chars else 0.0
    worth = lambda n: n.score * (1 - density(n))
    rank = {id(n): k for k, (n, _) in enumerate(nodes)}
    kinds = [n for n in scored if n.tag not in ("html", "a", "p", "li", "ul", "ol")] or scored
    if not kinds:
        return []
    best = max(kinds, key=lambda n: (worth(n), -rank[id(n)]))
    up = best.parent
    while up is not None and up.tag not in ("html", "body"):  # all of an article, not a part
        if up.tag in ("article", "main") or (len(up.kids) and worth(up) >= 0.75 * worth(best)):
            best = up
        up = up.parent
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    least = max(10.0, 0.2 * worth(best))
    kept: list[Node] = []
    plain = lambda k: k.tag == "div" and not any(x.__class__ is Node and not x.gone and x.tag in BLOCK for x in k.kids) and k.stops > 0 and not _OWNED.search(_own_text(k))  # noqa: E731  a paragraph in a div
    for k in reversed([k for k in best.parent.kids if isinstance(k, Node) and not k.gone]):
        like = k.tag == best.tag and worth(k) >= least
        said = (k.tag in ("p", "blockquote") or plain(k)) and not k.marks and density(k) < 0.25 and (k.chars > 80 or k.stops > 0)
        heads = k.tag in HEADINGS and not k.marks and density(k) < 0.25 and bool(kept) and k.chars > 0  # of what comes next
        if k is best or like or said or heads:
            kept.append(k)
    return kept[::-1]


def extract(html: str | None) -> str:
    """The main text: blocks in page order, joined by an empty line; white space in a block is one space."""
    if not html:
        return ""
    blocks, part = [], []

    def flush() -> None:
        text = " ".join("".join(part).split())
        part.clear()
        if text:
            blocks.append(text)

    for top in best_nodes(parse(html)):
        stack: list[Node | str | None] = [top]
        while stack:
            k = stack.pop()
            if k is None:
                flush()
            elif isinstance(k, str):
                part.append(k)
            elif not k.gone:
                if k.tag == "br":
                    part.append(" ")
                elif k.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack += reversed(k.kids)
        flush()
    return "\n\n".join(blocks)


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of keep, text, n_chars (code points) of each page, whole html.

    A null or empty html, or one without text outside menus and the like, has text ''. Rows that repeat are extracted
    each. Broken markup is read as far as it goes; very long pages are read whole, in linear time. Other columns are not
    read, whatever their names. No pages give no rows.
    """

    def extracted(batches):
        for batch in batches:
            texts = [extract(x) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select(*keep, F.col(html_col)).mapInArrow(extracted, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", text string, n_chars long")
