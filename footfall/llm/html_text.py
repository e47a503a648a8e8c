"""Main text of web pages by tree scoring (operator 8).

A page becomes a tree; elements that are never article text (scripts, menus, forms, reader
comments, ...) are cut off by tag, role, and class names or ids made up of such words
(``ad-box``).  A name that has one among other words (``notice-of-death``) only makes its element
doubtful: its text gives a quarter of the points, and it is left out beside the chosen
container, or inside it if half of its text is links.  Each paragraph of text gives points
for its length and commas to its ancestors, fewer the further up; points are discounted by
the share of link text.  The best container is kept, with siblings that look like parts of
the same article.  Article and main elements help to choose: containers in them count a
quarter more, and a container in an article (or in a main element without articles) is widened
to it; beside an article, other articles, paragraphs and headings are such siblings, other
elements are not.  The page's blocks come out in page order.

One page is handled at a time in memory proportional to it, without recursion; no shuffle.

Defined cases: a null or empty page has the empty text; markup that is not closed is closed
by the end of the page, a tag whose quotes are not closed by its first ``>``; a page without any text outside the cut elements has the empty text;
repeated rows are treated alike; other columns pass through (``text`` and ``n_chars`` are
overwritten).
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import types as T

from footfall.llm.common import map_batches, table

#: HTML elements by how they are treated.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
CUT = {"head", "script", "style", "noscript", "template", "nav", "footer", "aside", "form", "button", "select",
       "textarea", "iframe", "object", "embed", "svg", "canvas", "audio", "video", "dialog", "menu", "title",
       "xmp", "noembed", "noframes", "input", "datalist", "map", "math"}
BLOCKS = {"address", "article", "blockquote", "body", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main",
          "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption"}
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}
IMPLIED_END = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "div", "section", "main"}
CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
             "menu", "menubar", "form", "toolbar", "tablist"}
CUT_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb",
             "breadcrumbs", "comment", "comments", "cookie", "cookies", "consent", "disqus", "footer", "gdpr", "masthead",
             "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager",
             "pagination", "popup", "promo", "promotion", "related", "recommended", "replies", "respond", "share",
             "sharing", "sidebar", "sidebars", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
             "subscription", "toolbar", "topbar", "widget"}
#: Words that say nothing about the content in a class name or id.
LAYOUT_WORDS = {"area", "bar", "block", "body", "bottom", "box", "col", "column", "container", "content", "footer", "group",
                "header", "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "panel", "right",
                "row", "section", "site", "slot", "text", "title", "top", "unit", "wrap", "wrapper", "zone"}
HOMES = {"article", "main"}
DOUBT = 0.25

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/$""")  # an unquoted value may end in a slash
_WORD_ENDS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "items", "attributes", "score", "total", "length", "links", "doubtful")

    def __init__(self, tag, parent, attributes=""):
        self.tag, self.parent, self.attributes = tag, parent, attributes
        self.items, self.score, self.total, self.length, self.links = [], 0.0, 0.0, 0, 0
        self.doubtful = False


def _unwanted(node: Node) -> bool:
    if node.tag in CUT:
        return True
    if node.tag == "header":
        up = node.parent
        while up and up.tag not in HOMES:
            up = up.parent
        if not up:
            return True
    if not node.attributes or node.tag in ("html", "body"):
        return False
    for name, value in _ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in CUT_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id") and node.tag not in HOMES:
            for label in value.split():
                words = {w for w in _WORD_ENDS.split(_CAMEL.sub(" ", label).lower()) if w and not w.isdigit()}
                if not CUT_WORDS.isdisjoint(words):
                    if words <= CUT_WORDS | LAYOUT_WORDS:
                        return True
                    node.doubtful = True
    return False


def parse(page: str) -> Node:
    """The page's tree; text items are decoded strings, unwanted elements are left out."""
    root = here = Node("#root", None)
    cut = None  # the outermost unwanted element that is open
    at, n = 0, len(page)

    def text(piece):
        if piece and cut is None:
            here.items.append(entities.unescape(piece))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        follow = page[lt + 1:lt + 2]
        if follow in ("!", "?"):
            text(page[at:lt])
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2 if page.startswith("<!-->", lt) else lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if m is None:
            if follow.isalpha() or follow == "/":
                end = page.find(">", lt)
                text(page[at:lt])
                at = n if end < 0 else end + 1
            else:
                text(page[at:lt + 1])
                at = lt + 1
            continue
        text(page[at:lt])
        at = m.end()
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if closing:
            up = here
            while up.tag != tag and up.parent:
                up = up.parent
            if up.parent:
                probe = here
                while cut is not None and probe is not up.parent:
                    if probe is cut:
                        cut = None
                    probe = probe.parent
                here = up.parent
            elif tag == "br":
                text(" ")
            continue
        ends = IMPLIED_END.get(tag)
        if tag in CLOSES_P:
            ends = {"p"}
        if ends:
            up, last = here, None
            while up.parent and (up.tag in ends or up.tag not in SCOPES and up.tag not in ("td", "th", "li")):
                if up.tag in ends:
                    last = up
                up = up.parent
            if last is not None:
                probe = here
                while cut is not None and probe is not last.parent:
                    if probe is cut:
                        cut = None
                    probe = probe.parent
                here = last.parent
        node = Node(tag, here, attributes)
        if tag in RAW:
            m2 = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            body_end = m2.start() if m2 else n
            end = page.find(">", body_end) if m2 else n
            at = n if end < 0 or not m2 else end + 1
            continue  # none of these is article text
        if cut is None:
            if _unwanted(node):
                if tag in VOID:
                    continue
                cut = node
            else:
                here.items.append(node)
        if tag not in VOID and not _SELF_CLOSED.search(attributes):
            here = node
        elif cut is node:
            cut = None
    return root


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks under ``nodes``, in page order; white space becomes one space."""
    out, line = [], []

    def end():
        words = " ".join("".join(line).split())
        if words:
            out.append(words)
        line.clear()

    stack = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif item.tag in BLOCKS:
            end()
            stack.append(None)
            stack.extend(reversed(item.items))
        else:
            stack.extend(reversed(item.items))
    end()
    return out


def _score(root: Node) -> list[Node]:
    """Gives every element its points, text length and link length; returns all elements in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in reversed(node.items) if not isinstance(x, str))
    for node in reversed(order):  # children before parents
        own = "".join(x for x in node.items if isinstance(x, str))
        inner = [x for x in node.items if not isinstance(x, str)]
        node.length = len(" ".join(own.split())) + sum(x.length for x in inner)
        node.links = node.length if node.tag == "a" else sum(x.links for x in inner)
    for node in order:  # parents before children
        node.doubtful = node.doubtful or node.parent is not None and node.parent.doubtful
    for node in order:
        inline = all(isinstance(x, str) or x.tag not in BLOCKS for x in node.items)
        direct = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        if node.tag not in BLOCKS or not (inline or direct >= 25) or node.length < 25:
            continue
        words = " ".join(_blocks([node]))
        points = (1 + words.count(",") + min(3.0, len(words) / 100)) * (1 - node.links / max(1, node.length))
        points *= DOUBT if node.doubtful else 1
        node.total = points
        up, share = node.parent, 1.0
        for level in range(1, 6):
            if up is None:
                break
            up.score += points * share
            up, share = up.parent, 1 / (2 * level)
    for node in reversed(order):
        if node.parent:
            node.parent.total += node.total
    return order


def _homes(order: list[Node]) -> dict[int, Node]:
    """The article or main element around each element that is in one (itself included); a main
    element that has others inside is none."""
    homes, outer = {}, set()
    for x in order:  # parents before children
        around = homes.get(id(x.parent))
        if x.tag in HOMES:
            if around is not None:
                outer.add(id(around))
            around = x
        if around is not None:
            homes[id(x)] = around
    return {k: x for k, x in homes.items() if x.tag == "article" or id(x) not in outer}


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    order = _score(root)
    density = lambda x: x.links / max(1, x.length)
    homes = _homes(order)
    for x in order:
        if x.doubtful and density(x) >= 0.5:
            x.items = []
    best = max(order, key=lambda x: x.score * (1 - density(x)) * (1.25 if id(x) in homes else 1))
    if best.score <= 0:
        found = [x for x in order if x.tag in HOMES and x.length]
        return "\n".join(_blocks([max(found, key=lambda x: x.length)] if found else [root]))
    best = homes.get(id(best), best)
    if best.parent is None:
        return "\n".join(_blocks([best]))
    floor = max(2.0, 0.2 * best.score)
    kept = []
    for x in best.parent.items:
        if x is best:
            kept.append(x)
        elif not isinstance(x, str) and not x.doubtful and density(x) < 0.3 and (
                x.score * (1 - density(x)) >= floor and (x.tag in HOMES or best.tag not in HOMES) or x.tag in ("p", "h1", "h2", "h3", "blockquote", "pre") and x.length > 0):
            kept.append(x)
    return "\n".join(_blocks(kept))


def extract(pages, html: str = "html"):
    """``pages`` with ``text`` and ``n_chars``, without ``html``."""
    held = [f for f in pages.schema.fields if f.name not in (html, "text", "n_chars")]
    schema = T.StructType([*held, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(html)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in held], pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], schema.names)

    return map_batches(pages.select(*[f.name for f in held], html), run, schema)


def op8_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
