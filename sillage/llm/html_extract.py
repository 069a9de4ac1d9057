"""Main text of web pages, with site templates removed.

Every element subtree of a page gets a hash of its tags and words.  Spark counts, per
host, on how many different pages each subtree stands, wherever it stands: subtrees that
recur across many pages of their host are its template and are deleted first, menus,
footers, adverts and notices alike, whatever their tags and classes say.  What the counts
leave is settled by role: elements that are no main text by tag, role, class or id (on a
host with few pages, or an advert that is never the same) go as well, and where a page
marks its article (``article``, ``main``, role=main) the text is that element's.
Paragraphs, headings and list items inside a marked article are never taken for template,
however often they are quoted.

Two scans of the pages: one gives (host, subtree, page signature) rows, reduced to the
table of templates; the second extracts with that table.  Copies of a page count once, so
a page published a thousand times is no template of its own.  The table goes to all tasks
if its measured size allows; beyond that each page gets only the templates it holds.

``n_by_counts`` and ``n_by_role`` say how many characters of a page went for either reason.

Edge cases: null or empty html has an empty text; pages without a host share one host;
broken markup (unclosed, crossed or stray tags, open comments) is read to its end.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small, materialize
from .common import small_batches

#: A subtree is template when on at least so many different pages.  The share only guards
#: against chance repeats on large hosts; layouts and adverts may take turns over the pages.
MIN_PAGES = 5
MIN_SHARE = 0.01

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
DROP = frozenset("script style textarea title noscript template iframe xmp head nav header footer aside form button "
                 "select option dialog menu svg canvas object audio video map".split())
BLOCK = frozenset("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody tfoot thead tr "
                  "caption ul".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dt dd span a b i em strong".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: Words of class and id values that mark what is no main text.  A value's token counts as a
#: whole: all its words are hints ("cookie-notice"), not one of them ("has-sidebar").
HINTS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent "
                  "notice gdpr popup modal nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer "
                  "masthead topbar comment comments disqus respond share sharing social newsletter subscribe "
                  "related pagination pager widget toolbar skip".split())
#: Of these, what stays no main text even around an element marked as main.
READERS = frozenset("comment comments disqus respond related".split())
#: Words that may follow those in a token; such lists differ from page to page, so that
#: subtree counts don't find them.
READER_LISTS = frozenset("area articles block body box container form item items list posts section thread wrapper".split())
#: Open elements that a start tag closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
         "th": ("table", "tr"), "option": ("select",)}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_RAW_END = {tag: re.compile(f"</{tag}", re.I) for tag in RAW}
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


@dataclass(slots=True)
class Node:
    tag: str
    dropped: bool
    main: bool
    #: why a class or id hints that it is no main text: "layout", "reader" or ""
    hint: str = ""
    #: strings and nodes in order
    parts: list = field(default_factory=list)
    digest: int = 0


def _hint(value: str) -> str:
    """What the tokens of a class or id say: "layout", "reader" or ""."""
    hint = ""
    for token in value.split():
        words = [w for w in re.split(r"[^a-z0-9]+", token) if w and not w[0].isdigit()]
        if words and (words[0] in READERS and READER_LISTS.issuperset(words[1:]) or HINTS.issuperset(words) and READERS.intersection(words)):
            return "reader"
        if words and HINTS.issuperset(words):
            hint = "layout"
    return hint


def _role(tag: str, attrs: str) -> tuple[bool, str, bool]:
    """Of an element: whether its tag or role makes it no main text; whether a class or id
    hints so; whether it is marked as main.  Hints don't bear on what is marked as main,
    but an article may be a reader's."""
    drop, hint, main = tag in DROP, "", tag in MAIN
    sure = tag == "main"
    if attrs and not attrs.isspace() and tag not in ("html", "body"):
        for name, *values in _ATTR.findall(attrs):
            name, value = name.lower(), next((v for v in values if v), "").lower()
            if name == "role":
                sure |= value == "main"
                drop |= value in ROLES
            elif name == "hidden":
                drop = True
            elif name in ("class", "id") and (said := _hint(value)):
                hint = "reader" if "reader" in (said, hint) else "layout"
    main |= sure
    if sure or main and hint == "layout":
        hint = ""
    return drop, hint, main and not drop and not hint


def parse(page: str) -> Node:
    """The tree of a page; broken markup is closed where the next element needs it."""
    root = Node("#root", False, False)
    stack = [root]

    def close(node_tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in node_tags:
                del stack[k:]
                return
            if stack[k].tag in scope:
                return

    at, n, marked = 0, len(page), False
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            stack[-1].parts.append(page[at:])
            break
        if lt > at:
            stack[-1].parts.append(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if m is None:  # a lone "<" is text
            stack[-1].parts.append("<")
            at = lt + 1
            continue
        at, tag, attrs = m.end(), m[2].lower(), m[3]
        if m[1]:
            if tag == "p" and not any(x.tag == "p" for x in stack):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag in TEXT and stack[k].tag in ("article", "main", "body", "table", "div", "section") and tag not in BLOCK:
                    break  # a stray inline end tag does not close its container
            continue
        if tag in BLOCK:
            close(("p",), ("article", "main", "body", "div", "section", "td", "th", "li", "blockquote", "button", "object"))
        if tag in CLOSES:
            close(CLOSES[tag], SCOPE[tag])
        if tag in VOID:
            stack[-1].parts.append(Node(tag, False, False))
            continue
        drop, hint, main = _role(tag, attrs)
        if main and not marked:  # what holds the page's main element is layout, whatever its class says
            marked = True
            for x in stack:
                x.dropped &= x.hint != "layout"
        node = Node(tag, drop or bool(hint), main, hint if not drop else "")
        stack[-1].parts.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            gt = page.find(">", end.start()) if end else -1
            at = n if gt < 0 else gt + 1
            continue
        if not attrs.rstrip().endswith("/") or tag in BLOCK:
            stack.append(node)
    return root


def _post(root: Node) -> Iterator[Node]:
    """Nodes, children before parents, without recursion (pages may nest deeply)."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(x for x in node.parts if isinstance(x, Node))
    return reversed(order)


def main_nodes(root: Node) -> list[Node]:
    """The outermost elements marked as main text that are not dropped; none: the root."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.dropped:
            continue
        if node.main and any(_has_text(node)):
            found.append(node)
            continue
        todo.extend(x for x in reversed(node.parts) if isinstance(x, Node))
    return found or [root]


def _has_text(node: Node) -> Iterator[bool]:
    todo = [node]
    while todo:
        x = todo.pop()
        for part in x.parts:
            if isinstance(part, Node):
                if not part.dropped:
                    todo.append(part)
            elif part.strip():
                yield True


def digests(root: Node) -> None:
    for node in _post(root):
        h = xxhash.xxh3_64(node.tag)
        for part in node.parts:
            h.update(part.digest.to_bytes(8, "little") if isinstance(part, Node) else " ".join(part.split()))
        node.digest = h.intdigest()


def candidates(root: Node) -> set[int]:
    """Subtrees that may be template: all that hold text, but not the text of a marked
    article nor the article itself or what holds it."""
    tops = main_nodes(root)
    marked = tops != [root]
    inside = {id(x) for x in tops} if marked else set()
    out: set[int] = set()
    full: set[int] = set()  # nodes with text, by id; children come first
    around: set[int] = set(inside)
    for node in _post(root):
        parts = [x for x in node.parts if isinstance(x, Node)]
        if any(id(x) in around for x in parts):
            around.add(id(node))
        if any(id(x) in full for x in parts) or any(isinstance(x, str) and x.strip() for x in node.parts):
            full.add(id(node))
    todo = [(root, False)]
    while todo:
        node, within = todo.pop()
        within = within or id(node) in inside
        text = within and node.tag in TEXT
        if id(node) in full and id(node) not in around and not text and node.tag not in ("body", "html", "#root"):
            out.add(node.digest)
        if not text:
            todo.extend((x, within) for x in node.parts if isinstance(x, Node))
    return out


def _characters(node: Node) -> int:
    """Characters of a subtree's words, white space runs as one."""
    total, todo = 0, [node]
    while todo:
        for part in todo.pop().parts:
            if isinstance(part, Node):
                todo.append(part)
            else:
                total += len(" ".join(part.split()))
    return total


def removed(root: Node, template: frozenset[int] | set[int]) -> tuple[int, int]:
    """Characters that go because their subtree recurs, and for any other reason."""
    tops = main_nodes(root)
    inside = {id(x) for x in tops}
    counts = role = 0
    todo = [(root, False)]
    while todo:
        node, within = todo.pop()
        within = within or id(node) in inside
        if node.digest in template:
            counts += _characters(node)
        elif within and node.dropped:
            role += _characters(node)
        else:
            if not within:
                role += sum(len(" ".join(x.split())) for x in node.parts if isinstance(x, str))
            todo.extend((x, within) for x in node.parts if isinstance(x, Node))
    return counts, role


def blocks(root: Node, template: frozenset[int] | set[int] = frozenset()) -> list[str]:
    """Texts of the blocks in page order."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    todo: list = list(reversed(main_nodes(root)))
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(entities.unescape(x))
        elif x.dropped or x.digest in template and x.digest:
            held.append(" ")
        elif x.tag in ("br", "td", "th", "img"):
            held.append(" ")
            todo.extend(reversed(x.parts))
        elif x.tag in BLOCK or x.main or x.tag == "#root":
            flush()
            todo.append(None)
            todo.extend(reversed(x.parts))
        else:
            todo.extend(reversed(x.parts))
    flush()
    return out


#: Bytes of the table of templates that every task gets.
TEMPLATE_BYTES = 32 << 20


def _host(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), _HOST, 1)).alias("host")


def _key(html_col: str):
    return [F.xxhash64(F.lit(k), html_col).alias(f"k{k}") for k in (1, 2)]


def subtrees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, k1, k2, sign, trees): of each page the hash of its markup, of its main text and
    those of the subtrees that may be template."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs, trees = [], []
            for page in batch.column(3).to_pylist():
                root = parse(page or "")
                digests(root)
                signs.append(xxhash.xxh3_64_intdigest("\n".join(blocks(root))) - (1 << 63))
                trees.append([d - (1 << 63) for d in candidates(root)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(signs, pa.int64()), pa.array(trees, pa.list_(pa.int64()))],
                                             ["host", "k1", "k2", "sign", "trees"])

    rows = pages.select(_host(url_col), *_key(html_col), html_col)
    return materialize(rows.mapInArrow(scan, "host string, k1 bigint, k2 bigint, sign bigint, trees array<bigint>"), "subtrees")


def templates(seen: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, tree): the template subtrees of every host, counted over ``subtrees``."""
    sizes = seen.select("host", "sign").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (seen.select("host", "sign", F.explode("trees").alias("tree")).distinct()
              .groupBy("host", "tree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    known = counts.join(broadcast_if_small(materialize(sizes, "hosts")), "host").where(F.col("n") >= F.col("pages") * min_share)
    return materialize(known.select("host", "tree"), "templates")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, template_bytes: int = TEMPLATE_BYTES) -> DataFrame:
    """(id, url, text, n_chars, n_by_counts, n_by_role) for every row of ``pages``."""
    small_batches(pages.sparkSession)
    seen = subtrees(pages, url_col, html_col)
    known = templates(seen, min_pages, min_share)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(url_col), *_key(html_col))
    if known._sillage_rows * 16 <= template_bytes:  # a host and a hash each
        per = known.groupBy("host").agg(F.collect_list("tree").alias("hashes"))
        rows = rows.join(F.broadcast(per), "host", "left")
    else:  # a page's own templates, at most its subtrees
        held = seen.dropDuplicates(["host", "k1", "k2"]).select("host", "k1", "k2", F.explode("trees").alias("tree")).join(known, ["host", "tree"])
        per = held.groupBy("host", "k1", "k2").agg(F.collect_list("tree").alias("hashes"))
        rows = rows.join(per, ["host", "k1", "k2"], "left")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            hashes = batch.column(3)
            for k, page in enumerate(batch.column(2).to_pylist()):
                root = parse(page or "")
                digests(root)
                template = {h + (1 << 63) for h in hashes[k].as_py() or ()}
                texts.append("\n".join(blocks(root, template)))
                gone.append(removed(root, template))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([g[0] for g in gone], pa.int64()), pa.array([g[1] for g in gone], pa.int64())],
                                             ["page_id", "url", "text", "n_chars", "n_by_counts", "n_by_role"])

    id_type = pages.schema[id_col].dataType.simpleString()
    rows = rows.select("page_id", "url", "html", "hashes")
    return rows.mapInArrow(scan, f"page_id {id_type}, url string, text string, n_chars bigint, n_by_counts bigint, n_by_role bigint")
