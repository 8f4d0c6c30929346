"""Main text of web pages by composite text density.

A node's density is its characters per tag, adjusted for links: text inside links counts less the more
of it there is, relative to how much of the page's body is links. The density sum of a node is the
sum of its children's densities; the node with the largest sum holds the article. The threshold is the
smallest density on the path from that node up to the body: any other subtree whose node reaches the
threshold is content too, represented by its own node of the largest sum.

Before that, what can't be article text is taken out by its tag, its role or the words of its class and id
(menus, headers, footers, sidebars, notices, adverts, forms, comments of readers, scripts and styles). A name, a form
or a header is no proof, as it may belong to what surrounds the article: such an element stays if it holds the only
``article`` or ``main`` of the page, or most of the page's plain text while hardly any is left for an article
elsewhere (but not one named for comments of readers), and its parts are judged by themselves. If the
chosen node lies in an ``article`` or ``main`` element, that element is taken whole, so its headings stay.

The text of the chosen nodes comes in page order. Character references are decoded, white space within a block is
one space, blocks are joined by one line feed. A null or empty page and one without such text give an empty
text. Markup may be broken: unclosed elements end with their parents or where a block may not contain the next
one; stray end tags are passed over. One page is read at a time, whole, in time linear in its length.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import few_at_once

# HTML's elements by how they behave, and names that mark what is not article text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
_BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody
    td tfoot th thead tr ul caption""".split()
)
_ENDS_P = _BLOCK - frozenset("body html td th tr tbody thead tfoot caption option optgroup legend".split())
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
_HOLDS = frozenset("ul ol dl table select body article section div main aside".split())
_DROPPED = frozenset(
    """head script style noscript template iframe object embed svg math canvas audio video nav footer aside button select
    textarea input label menu dialog search""".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_NAMES = frozenset("ad ads adv adbox adslot gdpr login menu menus modal nav pager promo promos reply share shares signup".split())
#: Names that also count as the end of a longer one, and as its beginning where it goes on with one of the tails.
_LONG_NAMES = tuple(
    """advert adsense banner breadcrumb comment consent cookie discussion disqus footer masthead navbar navigation newsletter notice
    pagination popup promoted related replies respond sharing sidebar social sponsor subscri toolbar widget""".split()
)
_STEMS = ("advert", "sponsor", "subscri")
_TAILS = frozenset("s ed area bar block body box button buttons container content feed form group header icon icons inner item items left link links list nav panel placeholder posts right row section tab text thread title top wrap wrapper".split())
#: Comments of readers, which may be most of a page.
_READERS = ("comment", "discussion", "disqus", "replies", "reply", "respond")
#: A name behind one of these says what an element has, not what it is.
_HAVING = frozenset("has have no not with without".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_CLOSING = {name: re.compile(rf"</{name}\s*[^>]*>", re.IGNORECASE) for name in _RAW}


class _Node:
    __slots__ = ("tag", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum", "doubt")

    def __init__(self, tag: str):
        self.tag, self.children, self.doubt = tag, [], ""
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _mark(value: str) -> str:
    """The first name in a class or id by which an element is no article text, or nothing."""
    for token in value.split():
        words = [word.lower() for word in _WORDS.findall(token)]
        for k, word in enumerate(words):
            if _HAVING.isdisjoint(words[:k]) and (word in _NAMES or _long_name(word)):
                return word
    return ""


def _long_name(word: str) -> bool:
    if word.endswith(_LONG_NAMES) or word.removesuffix("s").endswith(_LONG_NAMES) or word.startswith(_STEMS):
        return True
    return any(word.startswith(name) and word[len(name) :] in _TAILS for name in _LONG_NAMES)


def _unwanted(tag: str, attributes: str, inside_article: bool) -> str | None:
    """Why an element is no article text: nothing, "" beyond doubt, or else the name that says so."""
    if tag in _DROPPED:
        return ""
    if not attributes or tag in ("body", "html", "article", "main"):
        return "header" if tag == "header" and not inside_article else "form" if tag == "form" else None
    found = "header" if tag == "header" and not inside_article else "form" if tag == "form" else None
    for name, *values in _ATTRIBUTE.findall(attributes):
        value, name = "".join(values), name.lower()
        lower = value.lower()
        if name == "hidden" or (name == "aria-hidden" and lower == "true") or (name == "role" and lower in _ROLES):
            return ""
        if name in ("class", "id"):
            found = _mark(value) or found
            if not inside_article and "header" in lower.split():
                found = found or "header"
    return found


def _doubts_settled(root: _Node) -> _Node:
    """Takes out marked elements, but for those that turn out to hold the article."""
    order, pending = [], [(root, False, False)]
    in_doubt, in_article = {}, {}
    while pending:
        node, doubt, article = pending.pop()
        order.append(node)
        in_doubt[id(node)] = doubt = doubt or node.doubt != ""
        in_article[id(node)] = article = article or node.tag in ("article", "main")
        linked = node.tag == "a" or node.link_tags > 0
        for child in node.children:
            if not isinstance(child, str):
                child.link_tags = int(linked)  # for this pass: inside a link
                pending.append((child, doubt, article))
    plain, holds = {}, {}
    outside = {False: 0, True: 0}  # plain text beyond doubt: out of articles and in them
    articles = 0
    for node in reversed(order):
        own = 0 if node.link_tags or node.tag == "a" else sum(len(c.strip()) for c in node.children if isinstance(c, str))
        below = [c for c in node.children if not isinstance(c, str)]
        plain[id(node)] = own + sum(plain[id(c)] for c in below)
        holds[id(node)] = node.tag in ("article", "main") or any(holds[id(c)] for c in below)
        if not in_doubt[id(node)]:
            outside[in_article[id(node)]] += own
            articles += node.tag in ("article", "main")
        node.link_tags = 0
    left = outside[True] if articles else outside[False]
    total = plain[id(root)]

    def stays(node: _Node) -> bool:
        if not articles and holds[id(node)]:
            return True
        much = plain[id(node)]
        return 2 * much > total and 4 * left < much and not node.doubt.startswith(_READERS)

    pending = [root]
    while pending:
        node = pending.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not c.doubt or stays(c)]
        pending += [c for c in node.children if not isinstance(c, str)]
    return root


def _tree(page: str) -> _Node:
    """What is left of the page under its body. Texts are children too."""
    root = _Node("body")
    stack, open_tags = [root], Counter()
    skipped = 0  # open elements that are left out
    at = 0

    def close(names: frozenset[str] | set[str], until: frozenset[str]) -> None:
        nonlocal skipped
        if not any(open_tags[name] for name in names):
            return  # so that no deep stack is searched in vain
        for k in range(len(stack) - 1, 0, -1):
            tag = stack[k].tag
            if tag in names:
                for node in stack[k:]:
                    open_tags[node.tag] -= 1
                    skipped -= node.density < 0
                del stack[k:]
                return
            if tag in until:
                return

    while at < len(page):
        lead = page.find("<", at)
        if lead < 0:
            lead = len(page)
        if lead > at and not skipped:
            stack[-1].children.append(html.unescape(page[at:lead]))
        if lead == len(page):
            break
        token = _TOKEN.match(page, lead)
        if token is None:  # a sign and not markup
            if not skipped:
                stack[-1].children.append("<")
            at = lead + 1
            continue
        at = token.end()
        if token[1]:
            tag = token[1].lower()
            close({tag}, frozenset() if tag in _BLOCK else _BLOCK)
        elif token[2]:
            tag = token[2].lower()
            if tag in ("html", "body"):
                continue
            if tag in _ENDS_P:
                close({"p"}, frozenset(("td", "th", "button", "object", "table")))
            if tag in _CLOSES:
                close(_CLOSES[tag], _HOLDS)
            node = _Node(tag)
            inside = open_tags["article"] + open_tags["main"] > 0
            unwanted = "" if skipped else _unwanted(tag, token[3], inside)
            if unwanted == "":
                node.density = -1.0  # marks what is left out
            elif tag not in _RAW:
                node.doubt = unwanted or ""
                stack[-1].children.append(node)
            if tag in _RAW:
                end = _CLOSING[tag].search(page, at)
                at = end.end() if end else len(page)
            elif tag not in _VOID and not token[3].endswith("/"):
                stack.append(node)
                open_tags[tag] += 1
                skipped += node.density < 0
    return root


def _measure(root: _Node) -> list[_Node]:
    """Fills in counts, densities and sums; gives all nodes, parents first."""
    nodes, linked = [], {id(root): False}
    pending = [root]
    while pending:
        node = pending.pop()
        nodes.append(node)
        for child in node.children:
            if not isinstance(child, str):
                linked[id(child)] = linked[id(node)] or child.tag == "a"
                pending.append(child)
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                n = len(_SPACE.sub(" ", child).strip())
                node.chars += n
                node.link_chars += n * linked[id(node)]
            else:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    body = nodes[0]
    share = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        c, t = node.chars, max(1, node.tags)
        if c:
            plain = max(1, c - node.link_chars)
            base = math.log(c / plain * node.link_chars + share * c + math.e)
            ratio = c / max(1, node.link_chars) * t / max(1, node.link_tags)
            node.density = c / t * math.log(max(ratio, 1 + 1e-9)) / max(base, 1e-9)
        node.sum = sum(child.density for child in node.children if not isinstance(child, str))
        if not node.sum:
            node.sum = node.density * 1e-6  # without child elements: after all that have some
    return nodes


def _chosen(root: _Node) -> list[_Node]:
    nodes = _measure(root)
    if not root.chars:
        return []
    parent = {id(c): n for n in nodes for c in n.children if not isinstance(c, str)}
    place = {id(n): k for k, n in enumerate(nodes)}
    best = max(nodes, key=lambda n: (n.sum, -place[id(n)]))
    path = [best]
    while path[-1] is not root:
        path.append(parent[id(path[-1])])
    threshold = min(n.density for n in path)
    enclosing = next((n for n in reversed(path) if n.tag in ("article", "main")), None)
    if enclosing is not None:
        return [enclosing]
    on_path, found, pending = {id(n) for n in path}, [], [root]
    while pending:
        node = pending.pop()
        if node is best or (id(node) not in on_path and node.density >= threshold):
            found.append(node)  # its densest part stands for it, and a part's surroundings are blocks of it
        elif id(node) in on_path:
            pending += [c for c in reversed(node.children) if not isinstance(c, str)]
    return found


def _blocks(node: _Node) -> list[str]:
    """Texts between the borders of block elements, in page order."""
    done, line = [], []

    def finish() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text:
            done.append(text)
        line.clear()

    pending: list = [node]
    while pending:
        item = pending.pop()
        if isinstance(item, str):
            line.append(item)
        elif item is None:
            finish()
        elif item.tag == "br":
            line.append(" ")
        else:
            block = item.tag in _BLOCK
            if block:
                finish()
                pending.append(None)
            pending += reversed(item.children)
    finish()
    return done


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(block for node in _chosen(_doubts_settled(_tree(page))) for block in _blocks(node))


def extract(pages: DataFrame, *, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without the markup but with its main text; a column of that name is replaced."""
    kept = [c for c in pages.columns if c not in (html_col, out)]
    rows = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{html_col}`").alias("page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, len(kept)):
            texts = [main_text(page.as_py()) for page in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*kept, out])

    schema = pages.select(*(F.col(f"`{c}`") for c in kept)).withColumn(out, F.lit("")).schema
    return rows.mapInArrow(run, schema)
