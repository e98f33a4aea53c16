"""Operator 2: main text of web pages, by site style trees.

Each page's markup becomes a tree of elements. The trees of one host are merged: an element
is the same node on all pages on which it has the same place (the tags and marks, that is
classes, ids and roles, from the body down to it). Over the pages that have a node,

* its presentation importance is the entropy of the child sequences of the elements there, over
  the logarithm of the number of elements: 0 if they always look the same;
* its content importance is 1 minus the mean, over its different texts, of log(pages with
  that text) over log(pages): 0 if every page has the same text there, 1 if each has its own;
* its importance is (1 - g^l) * presentation + g^l * content, with l child sequences, g = 0.9.

A text at an unimportant node goes if the same text is there on ``MIN_PAGES`` pages or more;
a rarer text stays, however large the host is and however its node looks. What a place is for is told by the markup as
well: menus, page headers, footers, sidebars, forms, scripts and so on have elements, roles
and usual names of their own. So

1. elements of those kinds, and marked as such, are no text, whatever their importance; the
   page itself, ``article`` and ``main`` are never told by a name, and lift a form around them;
2. if a page has an ``article`` or ``main`` element, only what is in it counts; plain elements
   in it (without marks) always stay, so articles that occur twice on a host keep their text;
   marked branches in it go if they are unimportant and repeated. Names (classes and ids) only
   nominate there, as articles have a "related-work" or a "discussion" of their own: a branch
   with such a name goes where its text is repeated, even if its node is important. Readers'
   comments are not repeated; they go if a comment's name stands within a comment's name;
3. on other pages any branch goes if it is unimportant and repeated; if that would leave nothing (a host
   of copies), all of it stays.

Only nodes of at least ``MIN_PAGES`` pages can be unimportant; a host's pages with the same
text count as one page, so copies don't make a text unimportant.

Pages are parsed once, into blocks and node features, stored in the shared folder. The
features are added up by node with partial sums, so a host with a third of all pages is no
large group. Repeated texts of unimportant nodes meet the few pages that have doubtful
branches by a join.

Edge cases: null and empty html give an empty text; a null url is a host of its own;
repeated rows have a row each; broken markup never fails: what isn't a tag is text, what
isn't closed ends with its parent; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import stored, tidy

DAMPING, THRESHOLD, MIN_PAGES = 0.9, 0.5, 3

#: Elements below this depth share the node of their ancestor there, in statistics only.
DEPTH = 40

# Elements of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
NO_TEXT = frozenset("nav footer aside form button select dialog menu search head object audio video canvas map datalist".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: What opens closes these, up to the given container.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: Words in classes and ids.
NO_TEXT_NAMES = frozenset(
    "ad ads adbox adbanner adsense adslot adunit advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts popup popups modal overlay newsletter subscribe subscription signup "
    "paywall sidebar sidebars menu menus nav navbar navigation navi breadcrumb breadcrumbs footer copyright related recommended recommendations "
    "recommendation share sharing social pagination pager widget widgets login search toolbar skip disclaimer".split()
)
PAGE_TOP_NAMES = frozenset("header masthead banner topbar".split())
COMMENT_NAMES = frozenset("comment comments commentlist commentary disqus respond replies reply discussion".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/][^a-zA-Z>][^>]*>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^<>]*)>",
    re.S,
)
_MARK = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class _Open:
    """An open element."""

    __slots__ = ("tag", "path", "marked", "gone", "named", "comment", "main", "children", "texts", "block")

    def __init__(self, tag, path, marked, gone, named, comment, main, block):
        self.tag, self.path, self.marked, self.gone, self.named, self.comment, self.main, self.block = tag, path, marked, gone, named, comment, main, block
        self.children: list[str] = []
        self.texts: list[str] = []

    def judged(self) -> tuple[int, bool, int]:
        """What its text is told by; texts that differ in it are blocks of their own."""
        return self.gone, self.named, id(self.comment)


def host(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _opened(tag: str, attributes: str, parent: _Open, depth: int) -> _Open:
    names, mark, role = frozenset(), "", ""
    if attributes and "=" in attributes:
        for kind, *values in _MARK.findall(attributes):
            value = html.unescape("".join(values))
            if kind.lower() == "role":
                role = value.lower().strip()
            names |= frozenset(_NAME.findall(_CAMEL.sub(" ", value).lower()))
            mark += f"[{kind.lower()}={_DIGITS.sub('0', value)}]"
    main = parent.main or tag in ("article", "main") or role in ("main", "article")
    own = tag in NO_TEXT or role in NO_TEXT_ROLES or bool(attributes and _HIDDEN.search(attributes))
    named, comment = parent.named, parent.comment
    whole = tag in ("html", "body", "article", "main") or role in ("main", "article")
    if names & COMMENT_NAMES:
        if comment is not None:
            comment[0] = True
        elif not whole:
            comment = [not parent.main]
    if "main" in (tag, role) and not parent.main:
        comment = None  # comments have no main part
    if not whole:
        if parent.main:
            named = named or bool(names & NO_TEXT_NAMES)
        else:
            own = own or bool(names & (NO_TEXT_NAMES | PAGE_TOP_NAMES)) or tag == "header"
    # a wrapper's name, or a form around the page, doesn't speak for the article in it; another element's kind does
    hard = parent.gone == 2 or tag in NO_TEXT and tag != "form"
    gone = 2 if hard else 1 if own or (parent.gone and not (main and not parent.main)) else 0
    path = f"{parent.path}>{tag}{mark}" if depth < DEPTH else parent.path
    return _Open(tag, path, parent.main and (parent.marked or bool(mark)), gone, named, comment, main, tag in BLOCK)


def parse(page: str) -> tuple[list[tuple[str, str, bool, bool]], list[tuple[str, str, list[str]]]]:
    """As ``scan``, by the page alone: without the blocks that a name nominates."""
    blocks, features = scan(page)
    return [b[:4] for b in blocks if not b[4]], features


def scan(page: str) -> tuple[list[tuple[str, str, bool, bool, bool]], list[tuple[str, str, list[str]]]]:
    """Blocks in order: (text, path, in an article, only plain elements below it or marked, nominated by a name); features: (path, children, texts).

    Blocks that are no text by their kind are not among the blocks; their nodes are among the features.
    """
    root = _Open("", "", False, 0, False, None, False, True)
    stack, blocks, features, text = [root], [], [], []

    def flush() -> None:
        words = " ".join("".join(text).split())
        text.clear()
        if not words:
            return
        holder = next(e for e in reversed(stack) if e.block)
        holder.children.append("#")
        holder.texts.append(words)
        top = stack[-1]
        if not top.gone:
            blocks.append((words, holder.path, top.main, top.marked, top.named, top.comment))

    def close() -> None:
        e = stack[-1]
        if e.judged() != stack[-2].judged():
            flush()
        stack.pop()
        if e.block:
            features.append((e.path, " ".join(e.children), e.texts))

    at, m = 0, _TOKEN.search(page)
    while m is not None:
        if m.start() > at:
            part = page[at : m.start()]
            text.append(html.unescape(part) if "&" in part else part)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if m[0].startswith("<![CDATA["):
            text.append(m[0][9:].removesuffix("]]>"))
        elif tag and (m[1] or m[4]):
            _end(tag, stack, flush, close)
        elif tag:
            attributes = m[3] or m[6] or ""
            if tag in RAW:
                if tag == "svg" and attributes.rstrip().endswith("/"):
                    pass
                else:
                    found = _RAW_END[tag].search(page, at)
                    at = found.end() if found else len(page)
            elif tag == "br":
                text.append(" ")
            elif tag in VOID:
                if tag == "hr":
                    flush()
            else:
                if tag in BLOCK:
                    flush()
                    _implied(tag, stack, close)
                    next(e for e in reversed(stack) if e.block).children.append(tag)
                e = _opened(tag, attributes, stack[-1], len(stack))
                if not e.block and e.judged() != stack[-1].judged():
                    flush()  # an inline branch that is no text is a block of its own
                stack.append(e)
        m = _TOKEN.search(page, at)
    if at < len(page):
        part = page[at:]
        text.append(html.unescape(part) if "&" in part else part)
    flush()
    while len(stack) > 1:
        close()
    # a comment container in an article is known as one by what comes in it
    return [(*b[:4], b[4] or b[5] is not None) for b in blocks if not (b[5] and b[5][0])], features


def _implied(tag: str, stack: list[_Open], close) -> None:
    """Ends what an opening tag ends: a paragraph, and items or cells of the same list or table."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == "p":
            while len(stack) > i:
                close()
            break
        if stack[i].block:
            break
    if tag in CLOSES:
        ends, within = CLOSES[tag]
        lowest = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in within:
                break
            if stack[i].tag in ends:
                lowest = i
        if lowest is not None:
            while len(stack) > lowest:
                close()


def _end(tag: str, stack: list[_Open], flush, close) -> None:
    if tag in BLOCK:
        flush()
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            if tag in BLOCK or not any(e.block for e in stack[i + 1 :]):
                while len(stack) > i:
                    close()
            else:
                del stack[i]  # an inline element that ends inside a block begun in it
            return


_PARSED = "row long, page_id long, url string, content long, blocks array<struct<key:bigint,named:boolean,text:string>>, features array<struct<node:bigint,styles:array<struct<style:bigint,n:int>>,texts:array<bigint>>>"


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Blocks and node features of each page; a block's key, of its text at its node, is null if the block stays in any case."""
    block_type = pa.list_(pa.struct([("key", pa.int64()), ("named", pa.bool_()), ("text", pa.string())]))
    style_type = pa.list_(pa.struct([("style", pa.int64()), ("n", pa.int32())]))
    feature_type = pa.list_(pa.struct([("node", pa.int64()), ("styles", style_type), ("texts", pa.list_(pa.int64()))]))

    def one(url: str | None, page: str | None):
        blocks, features = scan(page or "")
        site = host(url)
        if any(in_main for _, _, in_main, _, _ in blocks):
            kept = [(t, path if marked else None, named) for t, path, in_main, marked, named in blocks if in_main]
        else:
            kept = [(t, path, named) for t, path, _, _, named in blocks]
        out: list[dict] = []
        keys: dict[str, int] = {}

        def key(path: str) -> int:
            if path not in keys:
                keys[path] = _key(f"{site} {path}")
            return keys[path]

        sure: list[str] = []
        for t, path, named in kept:
            if path is None:
                sure.append(t)
                continue
            if sure:
                out.append({"key": None, "named": False, "text": " ".join(sure)})
                sure = []
            out.append({"key": _key(f"{key(path)} {t}"), "named": named, "text": t})
        if sure:
            out.append({"key": None, "named": False, "text": " ".join(sure)})
        merged: dict[int, tuple[Counter[str], set[int]]] = {}
        for path, children, texts in features:
            node = key(path)
            styles, found = merged.setdefault(node, (Counter(), set()))
            styles[children] += 1
            found.update(_key(f"{node} {t}") for t in texts)
        content = _key("\n".join([site, *(b["text"] for b in out)]))
        return content, out, [{"node": k, "styles": [{"style": _key(x), "n": n} for x, n in s.items()], "texts": sorted(f)} for k, (s, f) in merged.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                done = [one(u, p) for u, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(done)), pa.int64()), batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.int64()),
                     pa.array([d[1] for d in done], block_type), pa.array([d[2] for d in done], feature_type)],
                    names=["row", "page_id", "url", "content", "blocks", "features"])
                row += len(done)

    p = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return stored(p.mapInArrow(tidy(run), _PARSED), "pages")


def repeated(pages: DataFrame) -> DataFrame:
    """key, pages, importance: texts at least ``MIN_PAGES`` pages have at a node, from parsed pages, with the node's pages and importance.

    All hosts' style trees are made at once; a host's pages of one and the same text count once.
    """
    once = pages.groupBy("content").agg(F.min_by("features", "row").alias("features"))
    f = once.select(F.explode("features").alias("f")).select("f.*")
    kinds = F.concat(
        F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("feature"), F.lit(1).alias("n"))),
        F.transform("styles", lambda x: F.struct(F.lit(1).alias("kind"), x["style"].alias("feature"), x["n"].alias("n"))),
        F.transform("texts", lambda x: F.struct(F.lit(2).alias("kind"), x.alias("feature"), F.lit(1).alias("n"))))
    # kind is no grouping column: a filter on it would go below the count, and its two uses would count twice
    counts = f.select("node", F.explode(kinds).alias("x")).select("node", "x.*").groupBy("node", "feature").agg(F.max("kind").alias("kind"), F.sum("n").alias("n"))
    n, page, style, text = F.col("n").cast("double"), F.col("kind") == 0, F.col("kind") == 1, F.col("kind") == 2
    node = counts.groupBy("node").agg(
        F.sum(F.when(page, n)).alias("pages"), F.sum(F.when(style, n)).alias("elements"), F.sum(F.when(style, n * F.log(n))).alias("nlogn"),
        F.count(F.when(style, 1)).alias("looks"), F.avg(F.when(text, F.log(n))).alias("shared")).where(F.col("pages") >= MIN_PAGES)
    log_m = F.log("elements")
    presentation = (log_m - F.col("nlogn") / F.col("elements")) / log_m
    content = 1 - F.col("shared") / F.log("pages")
    damped = F.pow(F.lit(DAMPING), F.col("looks"))
    value = (1 - damped) * presentation + damped * F.coalesce(content, F.lit(0.0))
    texts = counts.where((F.col("n") >= MIN_PAGES) & (F.col("kind") == 2)).select("node", F.col("feature").alias("key"))
    return texts.join(node.select("node", "pages", value.alias("importance")), "node").select("key", "pages", "importance")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    p = parsed(pages, id_col, url_col, html_col)
    doubtful = F.transform(F.filter("blocks", lambda b: b["key"].isNotNull()), lambda b: F.struct(b["key"].alias("key"), b["named"].alias("named")))
    asked = p.select("row", F.explode(F.array_distinct(doubtful)).alias("x")).select("row", "x.*")
    gone = (  # texts of one page
        asked.join(repeated(p), "key").where(F.col("named") | (F.col("importance") < THRESHOLD))
        .groupBy("row").agg(F.collect_set(F.struct("key", "named")).alias("gone"))
    )
    # only pages with doubtful branches are shuffled
    sure = p.where(F.size(doubtful) == 0).select("page_id", "url", F.col("blocks").alias("kept"))
    j = p.where(F.size(doubtful) > 0).select("row", "page_id", "url", "blocks").join(gone, "row", "left")
    left = F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda b: b["key"].isNull() | ~F.exists("gone", lambda g: (g["key"] == b["key"]) & (g["named"] == b["named"]))))
    j = j.select("page_id", "url", F.when(F.size(left) > 0, left).otherwise(F.col("blocks")).alias("kept")).unionByName(sure)
    text = F.array_join(F.transform("kept", lambda b: b["text"]), " ")
    return j.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
