"""Main text of web pages by tree scoring.

A page becomes a tree of elements whose text is cut into blocks. Each block of prose passes points to
its ancestors: one, one for each comma, one for each 100 characters (three at most); its parent
gets all, its grandparent half, and those above a third, a quarter and so on. An element's points are
discounted by the share of its text that stands in links. The best container is kept, or the article
or main element it stands in; and its siblings, where they are prose or score a fifth of it.

Left out everywhere: scripts, styles, forms, menus, headers and footers of the page, sidebars,
notices, adverts, reader comments, by element, role, or the words of class and id.

Null or empty html, or html without prose, gives an empty text. Broken markup is read as browsers do:
open elements are closed by their parents, unknown references stay as they are, a malformed declaration or marked
section ends at the next '>'. Pages keep their
page_id and url, repeated or null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, slices

#: Elements that never hold main text, or hold no text at all.
DROPPED = frozenset(
    "script style noscript template head title meta link nav aside footer form button input select option textarea "
    "iframe object embed svg canvas video audio map dialog menu menuitem label fieldset".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin a block of their own.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key's group ends an open element of the value's group, up to the scope's border.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article section div main".split())
#: Words of class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion "
    "sidebar aside rail widget nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs toolbar topbar "
    "footer foot masthead header comment comments disqus replies respond reply notice notices cookie cookies consent gdpr popup "
    "modal overlay alert newsletter subscribe subscription signup login share sharing social related recommended "
    "pagination pager skip hidden copyright legal disclaimer search complementary contentinfo dialog form".split()
)
#: In an article, elements whose id says nothing; elements whose id marks them only if all its words do.
TITLED, PARTS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd".split()), frozenset("section ul ol dl".split())
#: Words that outweigh such marks: the element holds the article.
KEEPS = frozenset("article content main post story entry body text".split())
_SHORT_COMMENT, _COMMENT_END = re.compile(r"<!---?>"), re.compile(r"--!?>")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "kids", "blocks", "dropped", "score", "size", "linked")

    def __init__(self, tag: str, parent: Node | None, dropped: bool):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.kids: list[Node | str] = []
        self.score = 0.0
        self.size = self.linked = 0


class Tree(HTMLParser):
    """Reads markup into elements; inline elements only matter for links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None, False)
        self.block: list[str] = []
        self.block_links = 0
        self.links = 0
        self.inline_drop: list[tuple[str, Node]] = []  # open inline elements to leave out, and where they began

    def within(self) -> Node | None:
        """Where the outermost open element of DROPPED that is no block began: all in it is left out, blocks too."""
        return next((node for tag, node in self.inline_drop if tag in DROPPED), None)

    def flush(self) -> None:
        text = " ".join("".join(self.block).split())
        if text and not self.at.dropped:
            node = self.at
            node.kids.append(text)
            node.size += len(text)
            node.linked += min(self.block_links, len(text))
        self.block, self.block_links = [], 0

    def close_to(self, node: Node) -> None:
        self.flush()
        self.links = 0
        self.inline_drop.clear()
        self.at = node

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.block.append(" ")
        if tag in VOID and tag != "hr":
            return
        if tag not in BLOCKS and tag not in DROPPED:
            if tag == "a":
                self.links = 1
            if self.inline_drop or self.unwanted(tag, attrs):
                self.inline_drop.append((tag, self.at))
            return
        if tag in DROPPED and tag not in BLOCKS and tag not in ("head", "title"):
            self.inline_drop.append((tag, self.at))
            return
        if self.within() is not None:  # the block around stays open, and goes on behind
            if tag != "hr":
                self.at.kids.append(Node(tag, self.at, True))
                self.at = self.at.kids[-1]
            return
        self.flush()
        self.links = 0
        self.inline_drop.clear()
        if tag == "hr":
            return
        node = self.at
        while node.tag == "p" or (node.tag in ("head", "title") and tag not in DROPPED):
            node = node.parent  # a block ends an open paragraph
        if tag in CLOSES:
            up = node
            while up.parent is not None and up.tag not in SCOPES:
                if up.tag in CLOSES[tag]:
                    node = up.parent
                up = up.parent
        child = Node(tag, node, node.dropped or self.unwanted(tag, attrs))
        node.kids.append(child)
        self.at = child

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = 0
        if any(t == tag for t, _ in self.inline_drop):
            while (last := self.inline_drop.pop())[0] != tag:
                pass
            if tag in DROPPED:
                self.at = last[1]
            return
        if tag == "br":
            self.block.append(" ")
        if tag not in BLOCKS and tag not in ("head", "title"):
            return
        node = self.at
        border = self.within()
        while node is not None and node.tag != tag:
            if node is border:
                border = None  # it ends what stands around the left-out element, and that with it
            node = node.parent
        if border is not None and node is not border:
            if node is not None and node.dropped:
                self.at = node.parent
            return
        self.close_to(node.parent if node is not None else self.at)

    def handle_data(self, data):
        if self.inline_drop or self.at.dropped:
            return
        self.block.append(data)
        if self.links:
            self.block_links += len(data.strip())

    def parse_comment(self, i, report=True):
        """Behind a comment: '--!>' ends it too, '<!-->' and '<!--->' are whole; -1 if nothing ends it."""
        end = _COMMENT_END.search(self.rawdata, i + 4) if not (short := _SHORT_COMMENT.match(self.rawdata, i)) else short
        return end.end() if end else -1

    def parse_html_declaration(self, i):
        """Behind a declaration or marked section: whatever it holds, the next '>' ends it."""
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        return self.rawdata.find(">", i) + 1 or -1

    def in_article(self) -> bool:
        node = self.at
        while node is not None and node.tag not in ("article", "main"):
            node = node.parent
        return node is not None

    def unwanted(self, tag: str, attrs) -> bool:
        if tag in DROPPED:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag == "header":  # of the page; an article's own header is part of it
            return not self.in_article()
        words: set[str] = set()
        inside = self.in_article()
        for name, value in attrs:
            if name in ("hidden",) or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
            if name in ("class", "id", "role") and value:
                found = {w.lower() for w in _SPLIT.split(value) if w and not w.isdigit()}
                # In an article an id is mostly made of a heading: there it marks nothing, or only as a whole.
                if name == "id" and inside and (tag in TITLED or tag in PARTS and not found <= MARKS):
                    continue
                words |= found
        return bool(words & MARKS) and not words & KEEPS or bool(words & {"comment", "comments", "sidebar", "advert", "ad", "ads", "related"})


def _walk(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(k for k in node.kids if isinstance(k, Node) and not k.dropped)


def _text(node: Node) -> list[str]:
    """Blocks of an element in page order, without dropped parts."""
    out, stack = [], [iter([node])]
    while stack:
        for kid in stack[-1]:
            if isinstance(kid, str):
                out.append(kid)
            elif not kid.dropped:
                stack.append(iter(kid.kids))
                break
        else:
            stack.pop()
    return out


def main_text(html: str | None) -> str:
    """The article's blocks, one a line."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    if re.match(r"<[/!?A-Za-z]", tree.rawdata):  # a tag or comment that never ends
        tree.rawdata = ""
    tree.close()
    tree.flush()
    nodes = list(_walk(tree.root))
    for node in nodes:
        for text in node.kids:
            if isinstance(text, str):
                points = 1 + text.count(",") + min(len(text) / 100, 3.0)
                up, share = node if node.tag in ("div", "section", "article", "main", "body", "td") else node.parent, 1
                while up is not None:
                    up.score += points / share
                    up, share = up.parent, share + 1
    for node in reversed(nodes):  # children come after their parents
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.linked += node.linked
    def worth(n: Node) -> float:
        return n.score * (1 - n.linked / n.size) if n.size else 0.0

    best = max(nodes, key=worth)
    if not best.size:
        return ""
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        return "\n".join(_text(up))
    while best.parent is not None and best.tag in ("p", "li", "ul", "ol", "blockquote", "pre", "table", "tbody", "tr", "td"):
        best = best.parent
    if best.parent is None:
        return "\n".join(_text(best))
    out = []
    for kid in best.parent.kids:
        if kid is best:
            out += _text(best)
        elif isinstance(kid, str):
            if len(kid) > 80 or kid.endswith((".", "!", "?")):
                out.append(kid)
        elif not kid.dropped and kid.size and kid.linked < 0.25 * kid.size:
            prose = kid.tag in ("p", "blockquote", "pre", "h1", "h2", "h3") and (kid.tag[0] == "h" or kid.size > 80 or "." in "".join(_text(kid)))
            if prose or worth(kid) >= 0.2 * worth(best):
                out += _text(kid)
    return "\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(h) for h in column(batch, "html").to_pylist()]
        values = [column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(values, ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): a row for each page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
