"""Body text of web pages: a small tree in Arrow batches, the choice among routes in SQL.

No page can end a job: trees are built and read without recursion, each pass over
a tree takes time in proportion to its nodes, and what the parser cannot read is
kept up to there, with the error in its row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.shipping import ship
from corpusflow.storage import spread

# ---- Fixed values: tag sets, words of page furniture, thresholds.
FRAGMENT_DROP = "script style nav header footer aside form iframe noscript img picture figure video audio svg canvas source".split()
PAGE_DROP = "script style iframe noscript img picture video audio svg canvas source button input select textarea".split()
CONDITIONAL = "nav header footer aside form".split()
BLOCKS = "p h1 h2 h3 h4 h5 h6 li blockquote td th dd dt figcaption pre".split()
LEAVES = "div section article".split()
NOT_IN_LEAF = "div section article p li table ul ol h1 h2 h3 h4 h5 h6 blockquote pre".split()
DENSE = "div article section main".split()
LAST_RESORT = "p h1 h2 h3 li blockquote td".split()
CHROME = "menu nav footer modal offcanvas cookie share subscribe embed pagination masthead logo breadcrumb".split()
PROTECT, DENSE_LEAST, SHORT_BODY, OG_BELOW, BLOCKS_BELOW, BLOCK_LEAST, EXTRACTED_LEAST = 400, 200, 1200, 300, 200, 60, 200
#: Bytes of a table of pages, as it lies on disk, that one task parses.
PIECE = 2 << 20
# ----
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}}
_ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_CHROME_RE = re.compile(rf"(^|[-_ ])({'|'.join(CHROME)})([-_ ]|$)", re.I)
_SPACE = re.compile(r"\s+")
_BOUNDS = set("div table ul ol article section body #root".split())
_DROPPED, _BLOCK_SET, _LEAF_SET, _NOT_IN_LEAF = frozenset(FRAGMENT_DROP), frozenset(BLOCKS), frozenset(LEAVES), frozenset(NOT_IN_LEAF)


class Node:
    """An element. A node that is ``gone`` is left out with all that is in it; one that
    is unwrapped keeps its place without tag and attributes."""

    __slots__ = ("attrs", "children", "gone", "parent", "tag")

    def __init__(self, tag: str, attrs: dict | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children, self.gone = tag, attrs or {}, parent, [], False

    def walk(self, without=frozenset()):
        """Descendant elements in document order, ``without`` those of some tags and what is in them."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            if not node.gone and node.tag not in without:
                yield node
                stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self, without=frozenset(), line: str | None = None):
        """Texts in document order; ``line`` stands for a line break."""
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if not isinstance(node, Node):
                yield node
            elif node.tag == "br" and line is not None and not node.gone:
                yield line
            elif not node.gone and node.tag not in without:
                stack.extend(reversed(node.children))

    def text(self, without=frozenset()) -> str:
        return _SPACE.sub(" ", " ".join(s for s in (x.strip() for x in self.strings(without)) if s)).strip()

    def unwrap(self) -> None:
        self.tag, self.attrs = "", {}

    def find(self, tags) -> list[Node]:
        tags = frozenset(tags)
        return [n for n in self.walk() if n.tag in tags]

    def sums(self, value, without=frozenset()) -> dict[int, int]:
        """For each element, by ``id``, the sum of ``value`` over its descendants."""
        order = [self, *self.walk(without)]
        out = dict.fromkeys(map(id, order), 0)
        for n in reversed(order):  # descendants come before their ancestors
            if n is not self and id(n.parent) in out:
                out[id(n.parent)] += out[id(n)] + value(n)
        return out


class _Builder(HTMLParser):
    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.open: dict[str, int] = {}  # how many elements of a tag are open

    def leave(self, node: Node) -> None:
        """Close all elements up to and with ``node``."""
        while self.at is not node:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[node.tag] -= 1
        self.at = node.parent

    def handle_starttag(self, tag, attrs):
        shut = _CLOSES.get(tag, set()) | ({"p"} if tag in _ENDS_P else set())
        if any(self.open.get(t) for t in shut):
            node = self.at
            while node.parent and node.tag not in _BOUNDS:
                if node.tag in shut:
                    self.leave(node)
                    break
                node = node.parent
        own = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(own)
        if tag not in _VOID:
            self.at = own
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        node = self.at
        while node.tag != tag:
            node = node.parent
        self.leave(node)

    def handle_data(self, data):
        self.at.children.append(data)

    def parse_marked_section(self, i, report=1):
        """A section of no known kind ends at the next bracket, as browsers have it."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1


def parsed(html: str) -> tuple[Node, str | None]:
    """The tree, as far as the parser came, and what stopped it."""
    builder, error = _Builder(), None
    try:
        builder.feed(html or "")
        builder.close()
    except Exception as e:  # a broken page is a row, not a failed job
        error = (str(e) or type(e).__name__)[:200]
    return builder.root, error


def parse(html: str) -> Node:
    return parsed(html)[0]


def paragraphs(root: Node) -> list[str]:
    """Paragraph texts: block elements, then lines of leaf containers, else sentences."""
    found: dict[str, None] = {}
    nodes = list(root.walk(_DROPPED))
    for n in nodes:
        if n.tag in _BLOCK_SET:
            t = _SPACE.sub(" ", " ".join(s for s in (x.strip() for x in n.strings(_DROPPED, "\n")) if s)).strip()
            if len(t) >= 2:
                found.setdefault(t)
    inner = root.sums(lambda n: n.tag in _NOT_IN_LEAF, _DROPPED)
    for n in nodes:
        if n.tag in _LEAF_SET and not inner[id(n)]:
            for line in "".join(n.strings(_DROPPED, "\n")).split("\n"):
                t = _SPACE.sub(" ", line).strip()
                if len(t) >= 2:
                    found.setdefault(t)
    if not found:
        for part in re.split(r"(?<=[。！？.!?])\s*|\n+", root.text(_DROPPED)):
            if len(part.strip()) >= 20:
                found.setdefault(part.strip())
    return list(found)


def p_texts(root: Node) -> dict[int, int]:
    """For each element, by ``id``, the characters of text in its paragraphs."""
    return root.sums(lambda n: len(n.text()) if n.tag == "p" else 0)


_STEP = re.compile(r"(?P<tag>[A-Za-z][\w-]*|\*)?(?P<rest>(?:[.#][\w-]+|\[[\w-]+(?:=(?:\"[^\"]*\"|'[^']*'|[^\]]*))?\])*)$")
_PART = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(?:=(?:\"([^\"]*)\"|'([^']*)'|([^\]]*)))?\]")


@lru_cache(1024)
def _steps(selector: str) -> tuple:
    """``(tag, conditions, whether the next outer step is the parent)``, innermost first."""
    out, child = [], False
    for token in reversed(re.sub(r"\s*>\s*", " > ", selector.strip()).split()):
        if token == ">":
            child = True
            continue
        m = _STEP.match(token)
        if not m or not token:
            raise ValueError(f"selector {selector!r}: tags, .class, #id, [attribute=value], descendants and > only")
        conditions = [(kind or "[", name or attr, value) for kind, name, attr, *values in _PART.findall(m["rest"]) for value in ["".join(values)]]
        if out:
            out[-1] = (*out[-1][:2], child)
        out.append((m["tag"] if m["tag"] != "*" else None, conditions, False))
        child = False
    if not out:
        raise ValueError("empty selector")
    return tuple(out)


def _fits(n: Node, tag: str | None, conditions) -> bool:
    if not n.tag or tag and n.tag != tag:
        return False
    has = {".": lambda k, v: k in n.attrs.get("class", "").split(), "#": lambda k, v: n.attrs.get("id") == k, "[": lambda k, v: k in n.attrs and (not v or n.attrs[k] == v)}
    return all(has[kind](k, v) for kind, k, v in conditions)


def select(root: Node, selector: str) -> Node | None:
    """The first node for a selector of tags, ``.class``, ``#id``, ``[attribute=value]``, descendants and ``>``."""
    steps, failed = _steps(selector), set()

    def outer(n: Node, k: int) -> bool:
        """Whether the steps from ``k`` on fit ancestors of ``n``; as deep as there are steps."""
        if k == len(steps):
            return True
        if (id(n), k) in failed:
            return False
        at = n.parent
        while at is not None:
            if _fits(at, *steps[k][:2]) and outer(at, k + 1):
                return True
            if steps[k - 1][2]:
                break
            at = at.parent
        failed.add((id(n), k))
        return False

    return next((n for n in root.walk() if _fits(n, *steps[0][:2]) and outer(n, 1)), None)


def meta(root: Node, name: str) -> str:
    for key in ("property", "name"):
        for n in root.find(["meta"]):
            if n.attrs.get(key) == name:
                return _SPACE.sub(" ", n.attrs.get("content", "")).strip()
    return ""


def caption(root: Node) -> str:
    """What a media page says of itself: its described text, else its first long paragraph."""
    return meta(root, "og:description") or next((t for t in (n.text() for n in root.find(["p"])) if len(t) >= BLOCK_LEAST), "")


def candidates(html: str, selectors: list[str], extract: Callable[[str], str] | None = None) -> dict:
    """Texts of all routes to a page's body, uncleaned, paragraphs apart by blank lines."""
    root, error = parsed(html)
    described = meta(root, "og:description") or meta(root, "description")
    title = next((n.text() for n in root.find(["title"])), "")
    whole, said = paragraphs(root), caption(root)
    for n in root.find(PAGE_DROP):
        n.gone = True
    total = p_texts(root)
    for n in root.find(CONDITIONAL):
        if total[id(n)] >= PROTECT:
            n.unwrap()
        else:
            n.gone = True
    total = p_texts(root)
    for n in list(root.walk()):
        ident = " ".join(x for x in (n.attrs.get("class", ""), n.attrs.get("id", "")) if x)
        if n.tag not in ("html", "body") and ident and _CHROME_RE.search(ident) and total[id(n)] < PROTECT:
            n.gone = True
    chosen = [x for x in (select(root, s) for s in selectors) if x is not None]
    dense, most, total = None, DENSE_LEAST - 1, p_texts(root)
    for n in root.find(DENSE):
        if total[id(n)] > most:  # the outermost of equals comes first
            dense, most = n, total[id(n)]
    blocks = [t for t in (n.text() for n in root.find(LAST_RESORT)) if len(t) >= BLOCK_LEAST]
    extracted = ""
    if extract:
        try:
            extracted = "\n\n".join(t for t in (_SPACE.sub(" ", x).strip() for x in re.split(r"\n+", extract(html or "") or "")) if t)
        except Exception as e:  # any fault of the extractor leaves the other routes
            error = error or (str(e) or type(e).__name__)[:200]
    return {
        "title": title,
        "fragment": "\n\n".join(whole),
        "selected": ["\n\n".join(paragraphs(n)) for n in chosen],
        "dense": "\n\n".join(paragraphs(dense)) if dense else "",
        "described": described,
        "blocks": "\n\n".join(blocks),
        "extracted": extracted,
        "caption": said,
        "error": error,
    }


_TEXTS = "title string, fragment string, selected array<string>, dense string, described string, blocks string, extracted string, caption string, error string"
_SCHEMA = pa.schema([(n, pa.list_(pa.string()) if k == "array<string>" else pa.string()) for n, k in (f.split() for f in _TEXTS.split(", "))])


def routes(pages: DataFrame, selectors: list[str], id_col: str = "page_id", html: str = "html", extract: Callable[[str], str] | None = None) -> DataFrame:
    """``id`` and the raw text of each route, parsed in Arrow batches.

    ``extract(html) -> text`` is an extraction library's route, if there is one; it must
    be importable where the pages lie.
    """
    for s in selectors:
        _steps(s)  # a selector that is not understood is an error here and now
    ship(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [candidates(h, selectors, extract) for h in batch.column("html").to_pylist()]
            own = pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *own.columns], names=[id_col, *_SCHEMA.names])

    return spread(pages.select(id_col, F.col(html).alias("html")), PIECE).mapInArrow(run, f"{id_col} {kind}, {_TEXTS}")


def fragment(html: Column) -> Column:
    """The paragraphs of an HTML fragment, apart by blank lines; null: empty."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: "\n\n".join(paragraphs(parse(x))) if x else "")

    return run(html)


def longest(texts: Column) -> Column:
    """The longest text of an array, the first of equals, else empty."""
    start = F.lit("")
    return F.coalesce(F.aggregate(texts, start, lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a)), F.lit(""))


def fragment_body(routes_: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The cleaned body of the whole page as a fragment."""
    return routes_.select(id_col, "title", T.clean_body(F.col("fragment")).alias("body"))


def page_body(routes_: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``id, title, body, route``: the ladder of routes, each longer text only where the one before is short."""
    own = routes_.withColumn("best", longest(F.transform("selected", T.clean_body))).withColumn("d", T.clean_body(F.col("dense")))
    own = own.withColumn("route", F.when(F.col("best") != "", "selector").otherwise("none"))
    for name, text, below in (("dense", F.col("d"), SHORT_BODY), ("described", F.col("described"), OG_BELOW), ("blocks", F.substring("blocks", 1, T.BODY_CAP), BLOCKS_BELOW)):
        wins = (F.length("best") < below) & (F.length(text) > F.length("best"))
        own = own.withColumn("route", F.when(wins, name).otherwise(F.col("route"))).withColumn("best", F.when(wins, text).otherwise(F.col("best")))
    body = F.substring(F.array_join(T.clean_array(F.split("best", "\n\n")), "\n\n"), 1, T.BODY_CAP)
    # an extraction library's text comes first if it is long enough
    extracted = F.substring(F.array_join(T.clean_array(F.split("extracted", "\n\n")), "\n\n"), 1, T.BODY_CAP)
    own = own.withColumn("x", extracted)
    taken = F.length("x") >= EXTRACTED_LEAST
    own, body = own.withColumn("route", F.when(taken, "extracted").otherwise(F.col("route"))), F.when(taken, F.col("x")).otherwise(body)
    return own.select(id_col, "title", body.alias("body"), "route")


def body_or_fallback(media: Column, body: Column, feed_summary: Column, caption_: Column) -> Column:
    """Media pages: feed summary, then caption, then page body; others: page body, then feed summary."""
    return F.when(media, T.or_else(feed_summary, caption_, body, feed_summary)).otherwise(T.or_else(body, feed_summary))


def fetch_status(media: Column, body: Column, feed_summary: Column, caption_: Column) -> Column:
    """Which step of ``body_or_fallback`` gave the body: caption_feed, caption_page, page, summary or empty."""
    has = lambda c: F.coalesce(c != "", F.lit(False))
    return F.when(media & has(feed_summary), "caption_feed").when(media & has(caption_), "caption_page").when(has(body), "page").when(has(feed_summary), "summary").otherwise("empty")
