"""HTML extraction by wrapper induction.

Pages of one host are dealt into blocks of at most ``BLOCK`` pages. Inside a block every page's DOM tree is aligned with
the block's first page by simple tree matching: the largest set of node pairs with equal tags that keeps
parents and order. A text slot whose content is the same on nearly all aligned pages is template; slots that
vary are content. Only pages that differ as a whole vote, so copies of one article do not make it a template.
The content is what remains of the article (or of the main part, or of the body where there is none) without the
template slots and without parts that are no text of the article by their tag, role or name: menus, headers,
footers, sidebars, adverts, forms, scripts, styles, comments of readers. Names count as a whole, and none takes out an
element that holds a first heading, most of the page's text or its only article; other names are left to the template.

No task holds more than one block, however many pages a host has, and a page moves once.

Defined results: null or empty html and pages without content give the empty text. A page cut off inside a tag ends before
it. Pages with a null or unreadable url are a host of their own. Rows with equal or null ids are handled one by
one; other columns are kept, an existing column of the output's name is replaced. Hosts with fewer than ``VOTERS``
different pages in a block have no template.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

BLOCK = 64
VOTERS, CONSTANT = 5, 0.8
MAX_BIG_HOSTS = 50_000

# Elements, roles and names that are no text of an article (fixed values).
SKIPPED_TAGS = frozenset(
    "head nav aside footer form script style noscript template iframe button select option textarea svg "
    "canvas menu dialog object embed audio video map".split()
)
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Whole class or id names; of the parts that names of several parts are made of, those that leave no doubt.
SKIPPED_NAMES = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr popup "
    "modal overlay comments disqus replies sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing "
    "social-share social-links related recommended footer masthead newsletter subscribe signup login pagination pager".split()
)
COMPOUND_NAMES = re.compile(
    r"(?:ad|ads|cookie|cookies|gdpr|consent|disqus|newsletter|social)[_-](?:slot|unit|box|banner|bar|container|wrapper|notice|"
    r"popup|modal|overlay|thread|signup|form|links|share|sharing|buttons|icons)"
    r"|(?:site|page|main|top|global)[_-](?:footer|nav|menu|navbar|navigation|masthead)"
    r"|(?:comment|comments|related|recommended)[_-](?:list|section|area|thread|posts|articles|links|stories)"
)
# A part named so is still text if it holds as much of the page's text.
MOST = 0.5
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open element of the first kind ends where one of its closers begins.
_LINE = BLOCK_TAGS - {"caption", "dd", "dt", "li", "tbody", "td", "tfoot", "th", "thead", "tr"}
CLOSED_BY = {
    "p": BLOCK_TAGS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    "tr": {"tr"}, "option": {"option"}, **{f"h{k}": _LINE for k in range(1, 7)},
}
_RAW = frozenset("script style textarea title noscript iframe template".split()) - {"title", "template"}
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z]", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")


class Node:
    """An element, or a text slot (tag ``#``) of a block."""

    __slots__ = ("tag", "attributes", "children", "text", "shape", "size", "template", "held")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None, text: str = ""):
        self.tag, self.attributes, self.text = tag, attributes or {}, text
        self.children: list[Node] = []
        self.shape, self.size, self.template, self.held = 0, 1, False, False


def _attributes(body: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(body):
        found.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
    return found


def parse(page: str) -> Node:
    """DOM tree of a page, forgiving: unclosed elements end with their parent or where the next must begin."""
    root = Node("#root")
    stack, at = [root], 0
    n = len(page)

    def add_text(raw: str) -> None:
        if raw:
            stack[-1].children.append(Node("#", text=entities.unescape(raw)))

    while at < n:
        token = _TOKEN.search(page, at)
        if token is None:
            add_text(page[at:])
            break
        add_text(page[at : token.start()])
        if token[0].startswith(("<!", "<?")):
            at = token.end()
            continue
        match = _TAG.match(page, token.start())
        if match is None:  # cut off inside a tag
            close = page.find(">", token.start())
            if close < 0:
                break
            at = close + 1
            continue
        at = match.end()
        closing, tag, body = match[1], match[2].lower(), match[3]
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        # Implied ends: look through inline elements for the one that the new block ends.
        if tag in BLOCK_TAGS or tag == "option":
            for k in range(len(stack) - 1, 0, -1):
                if tag in CLOSED_BY.get(stack[k].tag, ()):
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK_TAGS and stack[k].tag != "p":
                    break
        node = Node(tag, _attributes(body) if body.strip() else None)
        stack[-1].children.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID_TAGS and not body.rstrip().endswith("/"):
            stack.append(node)
    hold(root)
    return root


def skipped(node: Node, in_article: bool) -> bool:
    """No text of the article, by tag, role, name or visibility."""
    a = node.attributes
    if node.tag in SKIPPED_TAGS or (node.tag == "header" and not in_article):
        return True
    if not a:
        return False
    style = a.get("style", "").replace(" ", "").lower()
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return True
    if a.get("role", "").lower() in SKIPPED_ROLES:
        return True
    if node.held or node.tag in ("html", "body", "article", "main"):
        return False
    return named(node)


def named(node: Node) -> bool:
    """Whether a class or the id says that this is no text of the article."""
    a = node.attributes
    names = f"{a.get('class', '')} {a.get('id', '')}".lower().split()
    return any(n in SKIPPED_NAMES or COMPOUND_NAMES.fullmatch(n) for n in names)


def hold(root: Node) -> None:
    """Mark the named elements that hold a first heading, most of the text, or the page's only articles or main parts.

    Where an article stands free, those in elements with such names are comments or teasers.
    """
    # Of each element the characters of text, and what it holds: 1 for a first heading, 2 for an article or main part.
    chars: dict[int, int] = {}
    holds: dict[int, int] = {}
    doubtful: list[Node] = []
    free = False
    stack = [(root, False, False, False)]
    while stack:
        node, done, out, inside = stack.pop()
        if node.tag == "#":
            chars[id(node)], holds[id(node)] = (0 if out else len(node.text.strip())), 0
            continue
        if not done:
            # Text of elements that are out whatever their name does not count as the page's.
            out = out or node.tag in SKIPPED_TAGS
            part = node.tag in ("article", "main") or node.attributes.get("role") == "main"
            if not out and not part and node.attributes and named(node):
                inside = True
                doubtful.append(node)
            free = free or (part and not out and not inside)
            holds[id(node)] = 0 if out else 2 * part + (node.tag == "h1")
            stack.append((node, True, out, inside))
            stack.extend((c, False, out, inside) for c in node.children)
            continue
        chars[id(node)] = sum(chars[id(c)] for c in node.children)
        for c in node.children:
            holds[id(node)] |= holds[id(c)]
    for node in doubtful:
        has = holds[id(node)]
        node.held = bool(has & 1) or (has >= 2 and not free) or chars[id(node)] > MOST * chars[id(root)]


def article(root: Node) -> list[Node]:
    """The parts that hold the article: outermost articles, else main, else the body or all."""
    for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or n.attributes.get("role") == "main", lambda n: n.tag == "body"):
        found: list[Node] = []
        stack = [root]
        while stack:
            node = stack.pop()
            if node.tag not in ("#", "#root") and wanted(node):
                found.append(node)
            elif node.tag == "#root" or not skipped(node, False):
                stack.extend(reversed([c for c in node.children if c.tag != "#"]))
        if found:
            return found
    return [root]


def blocks(parts: list[Node]) -> list[str]:
    """Texts of the blocks of the parts, in page order."""
    out, current = [], []

    def close() -> None:
        text = _SPACE.sub(" ", "".join(current)).strip()
        current.clear()
        if text:
            out.append(text)

    # An explicit stack: pages can nest deeper than Python recurses.
    for part in parts:
        inside = part.tag in ("article", "main")
        stack: list[tuple[Node, bool]] = [(part, False)]
        while stack:
            node, leaving = stack.pop()
            if node.tag == "#":
                if not node.template:
                    current.append(node.text)
                continue
            if leaving:
                close()
                continue
            if node is not part and skipped(node, inside):
                if node.tag in BLOCK_TAGS:
                    close()
                else:
                    current.append(" ")
                continue
            if node.tag == "br":
                current.append(" ")
            elif node.tag in BLOCK_TAGS or node is part:
                close()
                stack.append((node, True))
            stack.extend((c, False) for c in reversed(node.children))
        close()
    return out


def _shaped(root: Node, shapes: dict) -> None:
    """Number the structure below each node: equal numbers, equal trees of tags. Sizes count nodes."""
    stack = [(root, False)]
    while stack:
        node, done = stack.pop()
        if not done:
            stack.append((node, True))
            stack.extend((c, False) for c in node.children)
            continue
        key = (node.tag, tuple(c.shape for c in node.children))
        node.shape = shapes.setdefault(key, len(shapes) + 1)
        node.size = 1 + sum(c.size for c in node.children)


class Matcher:
    """Simple tree matching with the results of pairs of shapes kept."""

    def __init__(self):
        self.known: dict[tuple[int, int], int] = {}

    def weight(self, a: Node, b: Node, depth: int = 0) -> int:
        """Nodes in the largest matching of two trees; 0 if the roots differ."""
        if a.tag != b.tag:
            return 0
        if a.shape == b.shape:
            return a.size
        key = (a.shape, b.shape)
        if key not in self.known:
            self.known[key] = 1 + (int(self._table(a, b, depth)[-1, -1]) if depth < 200 else 0)
        return self.known[key]

    def _table(self, a: Node, b: Node, depth: int) -> np.ndarray:
        n, m = len(a.children), len(b.children)
        table = np.zeros((n + 1, m + 1), np.int32)
        columns: dict[int, list[int]] = defaultdict(list)
        for j, child in enumerate(b.children):
            columns[child.shape].append(j)
        row_of: dict[int, np.ndarray] = {}
        for i, x in enumerate(a.children):
            if x.shape not in row_of:
                row = np.zeros(m, np.int32)
                for places in columns.values():
                    row[places] = self.weight(x, b.children[places[0]], depth + 1)
                row_of[x.shape] = row
            best = np.maximum(table[i, 1:], table[i, :-1] + row_of[x.shape])
            table[i + 1, 1:] = np.maximum.accumulate(best)
        return table

    def pairs(self, a: Node, b: Node):
        """Matched text slots of two trees with matched roots."""
        stack = [(a, b, 0)]
        while stack:
            x, y, depth = stack.pop()
            if x.tag == "#":
                yield x, y
                continue
            if x.shape == y.shape:
                stack.extend((p, q, depth + 1) for p, q in zip(x.children, y.children))
                continue
            table = self._table(x, y, depth)
            i, j = len(x.children), len(y.children)
            while i and j:
                if table[i, j] == table[i - 1, j]:
                    i -= 1
                elif table[i, j] == table[i, j - 1]:
                    j -= 1
                else:
                    stack.append((x.children[i - 1], y.children[j - 1], depth + 1))
                    i, j = i - 1, j - 1


def induce(trees: list[Node]) -> None:
    """Mark the template slots of aligned pages."""
    shapes: dict = {}
    for tree in trees:
        _shaped(tree, shapes)
    whole = [" ".join(blocks(article(t))) for t in trees]
    first_of: dict[str, int] = {}
    voters = [k for k, text in enumerate(whole) if first_of.setdefault(text, k) == k]
    if len(voters) < VOTERS:
        return
    matcher, reference = Matcher(), trees[voters[0]]
    aligned: dict[int, list[tuple[int, Node]]] = defaultdict(list)
    for k, tree in enumerate(trees):
        for slot, other in matcher.pairs(reference, tree):
            aligned[id(slot)].append((k, other))
    voting = set(voters)
    for slots in aligned.values():
        seen = Counter(node.text.strip() for k, node in slots if k in voting)
        text, times = seen.most_common(1)[0] if seen else ("", 0)
        if text and times >= CONSTANT * len(voters):
            for _, node in slots:
                node.template = node.text.strip() == text


def extract(pages: list[str | None]) -> list[str]:
    """Main texts of pages of one host."""
    trees = [parse(p or "") for p in pages]
    induce(trees)
    return ["\n\n".join(blocks(article(t))) for t in trees]


def host(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", name: str = "text") -> DataFrame:
    """Pages with their main text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = pages.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())])
    arrow, columns = to_arrow_schema(schema), kept.columns

    def run(table: pa.Table) -> pa.Table:
        texts = pa.array(extract(table[html].to_pylist()), pa.string())
        return table.select(columns).append_column(arrow.field(name), texts).cast(arrow)

    named = kept.withColumn("__host", host(url))
    counts = named.groupBy("__host").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > BLOCK)
    if counts.limit(MAX_BIG_HOSTS + 1).count() <= MAX_BIG_HOSTS:
        counts = F.broadcast(counts)
    block = F.pmod(F.xxhash64(html, url), F.ceil(F.coalesce("__n", F.lit(1)) * 2 / BLOCK))
    dealt = named.join(counts, "__host", "left").withColumn("__block", block).drop("__n")
    return dealt.groupBy("__host", "__block").applyInArrow(run, schema)
