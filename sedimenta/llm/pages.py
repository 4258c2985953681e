"""Main text of web pages by site style trees.

Each page becomes a tree of block elements, and the trees of one host are merged: a node of
the style tree is the path of tags and classes that leads to an element. For every node Spark
counts on how many pages of the host it stands, on how many each of its contents stands (the
texts beneath it), and on how many each of its presentations (the row of its children's tags).
Contents that stand on all pages and presentations that never vary carry no information:

    content       1 - mean over its contents of log(pages with the content) / log(pages)
    presentation  the entropy of its presentations, with the number of pages as the base
    importance    presentation weighs 1 - DAMPING ** presentations, content the rest

Copies of a page count once. Branches below LEAST are removed from every page of the host. A node on fewer than FEW pages
says nothing about a site and stays. Markup that names its role comes before the statistics:
menus, headers, footers, sidebars, notices, adverts, forms and comments go although they may
differ on every page; what an article element holds stays although every page may hold
it, and where a page has a main element, or an article of at least half its unnamed text, all else
goes. A name counts when the whole class or
id states a role (cookie-notice, not related-work), on no heading and on no paragraph of an
article. Text of formulas and drawings stays.

Counting is by host and path hash, with partial sums before the shuffle, so a host that holds
a third of all pages is not gathered anywhere; what comes back per host are the paths of
its removed branches. No page is split over rows.

Defined results: a null or empty page has an empty text, as has one without text; a page
without a host is merged with its like; unclosed elements end where HTML says or at the end; an
unclosed comment or script reaches to the end. Repeated rows give equal results.
Columns named text and n_chars are replaced.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import ship_package, stored
from sedimenta.llm.urls import host_of

LEAST = 0.2
DAMPING = 0.9
FEW = 4

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*>",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q"
    " rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img"
    " math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover"
    " mmultiscripts mprescripts mtable mtr mtd mspace mstyle mpadded mphantom menclose mfenced"
    " merror semantics"
    " svg g path rect circle ellipse line polyline polygon text tspan textpath defs use symbol"
    " lineargradient radialgradient stop clippath mask pattern marker".split()
)
#: Inline elements that begin a word of their own.
_APART = frozenset("br mtr mtd text".split())
_RAW = frozenset(
    "script style textarea title noscript iframe template xmp desc metadata annotation"
    " annotation-xml".split()
)
#: Elements and names that say what a branch is for; none of it is the article.
_ASIDE = frozenset(
    "head nav footer aside form button select option fieldset dialog menu object".split()
)
_ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments consent contentinfo cookie cookies disqus footer form login menu modal nav navbar"
    " navigation newsletter notice notices pagination popup promo promotion related replies"
    " search share sharing sidebar signup social sponsor sponsored subscribe toolbar"
    " complementary".split()
)
#: Only outside an article: there a header holds its title.
_SITE = frozenset(["header", "masthead"])
#: What may stand beside such a name within one class or id; any other word makes it a topic.
_LAYOUT = frozenset(
    "main site page left right top bottom side primary secondary global container wrapper wrap"
    " box bar block list item items area section inner outer widget panel group link links button"
    " buttons".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p dt dd caption figcaption blockquote pre address summary".split())
#: An element of these ends an open one of the set when it begins.
_ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_SCOPE = frozenset("ul ol dl table select article section div body html main".split())

PARSED = (
    "struct<blocks: array<struct<paths: array<bigint>, text: string>>,"
    " contents: array<struct<path: bigint, feature: bigint>>,"
    " presentations: array<struct<path: bigint, feature: bigint>>>"
)


def _hash(text: str) -> int:
    value = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _states(tokens: list[str], role: frozenset[str]) -> bool:
    """Whether a whole class, id or role says what the element is for."""
    for token in tokens:
        words = [w for w in _SPLIT.split(token) if w]
        if not role.isdisjoint(words) and all(w in role or w in _LAYOUT or w.isdigit() for w in words):
            return True
    return False


class _Node:
    __slots__ = ("tag", "path", "paths", "aside", "article", "children")

    def __init__(self, tag: str, step: str, parent: _Node | None, aside: bool, article: bool):
        self.tag = tag
        self.path = f"{parent.path}>{step}" if parent else step
        self.paths = (*parent.paths, _hash(self.path)) if parent else (_hash(step),)
        self.aside = aside
        self.article = article
        self.children: list[str] = []


class Page:
    """Blocks of text in page order, each with the block element it stands in."""

    def __init__(self, source: str):
        self.nodes: list[_Node] = [_Node("", "", None, False, False)]
        self.stack: list[_Node | str] = [self.nodes[0]]  # inline elements are just their tags
        self.blocks: list[tuple[_Node, str]] = []
        self._text: list[str] = []
        self._read(source)

    def _node(self) -> _Node:
        return next(e for e in reversed(self.stack) if isinstance(e, _Node))

    def _flush(self) -> None:
        text = " ".join(html.unescape("".join(self._text)).split())
        self._text = []
        if text:
            self.blocks.append((self._node(), text))

    def _close(self, tags: frozenset[str], scope: frozenset[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            entry = self.stack[k]
            tag = entry.tag if isinstance(entry, _Node) else entry
            if tag in tags:
                if any(isinstance(e, _Node) for e in self.stack[k:]):
                    self._flush()
                del self.stack[k:]
                return
            if tag in scope:
                return

    def _open(self, tag: str, attributes: str) -> None:
        if tag in _INLINE:
            if tag in _APART:
                self._text.append(" ")
            if tag not in _VOID and not attributes.endswith("/"):
                self.stack.append(tag)
            return
        self._flush()
        self._close(frozenset(["p"]), _SCOPE)
        if tag in _ENDS:
            self._close(_ENDS[tag], _SCOPE)
        parent = self._node()
        names, tokens = [], []
        for _, value in _NAMES.findall(attributes) if attributes else ():
            value = value.lower().strip("\"'")
            names += _SPLIT.split(value)
            tokens += value.split()
        if tag in _HEADINGS or parent.article and tag in _PARAGRAPHS:
            tokens = []
        article = parent.article or tag in ("article", "main") or "main" in names[:1] and tag != "body"
        aside = (
            parent.aside
            or tag in _ASIDE
            or _states(tokens, _ASIDE_NAMES)
            or not parent.article
            and not article
            and (tag in _SITE or _states(tokens, _SITE))
        )
        step = ".".join([tag, *sorted(set(filter(None, names)))])
        node = _Node(tag, step, parent, aside and tag not in ("html", "body"), article)
        parent.children.append(step)
        self.nodes.append(node)
        if tag not in _VOID:
            self.stack.append(node)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            token = _TOKEN.search(source, at)
            if token is None:
                break
            if token.start() > at:
                self._text.append(source[at : token.start()])
            at = token.end()
            if token[2] is None:
                continue
            tag = token[2].lower()
            if token[1]:
                if tag == "p" or tag not in _VOID:
                    self._close(frozenset([tag]), frozenset())
            elif tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
            else:
                self._open(tag, token[3])
        self._text.append(source[at:])
        self._flush()

    def kept(self) -> list[tuple[tuple[int, ...], str]]:
        """Blocks that no name of their markup excludes, with the paths that the statistics may
        still remove; none for those in an article."""
        blocks = [(node, text) for node, text in self.blocks if not node.aside]
        inside = [(node, text) for node, text in blocks if node.article]
        held = sum(len(text) for _, text in inside)
        # a card of an article beside a longer text is not the page's article; main is by meaning
        if inside and (
            any(n.tag == "main" for n in self.nodes) or 2 * held >= sum(len(t) for _, t in blocks)
        ):
            return [((), text) for _, text in inside]
        return [(node.paths[1:], text) for node, text in blocks]

    def contents(self) -> set[tuple[int, int]]:
        return {(path, _hash(text)) for node, text in self.blocks for path in node.paths[1:]}

    def presentations(self) -> set[tuple[int, int]]:
        return {(n.paths[-1], _hash(" ".join(n.children))) for n in self.nodes if n.children}


def _parsed(df: DataFrame, source: str) -> DataFrame:
    ship_package(df.sparkSession)

    @F.arrow_udf(PARSED)
    def parse(pages: pa.Array) -> pa.Array:
        rows = []
        for value in pages:
            page = Page(value.as_py() or "")
            rows.append(
                {
                    "blocks": [{"paths": list(p), "text": text} for p, text in page.kept()],
                    "contents": [{"path": p, "feature": f} for p, f in sorted(page.contents())],
                    "presentations": [
                        {"path": p, "feature": f} for p, f in sorted(page.presentations())
                    ],
                }
            )
        return pa.array(rows, _PARSED_TYPE)

    return df.withColumn("_page", parse(F.col(source)))


_FEATURES = pa.list_(pa.struct([("path", pa.int64()), ("feature", pa.int64())]))
_PARSED_TYPE = pa.struct(
    [
        ("blocks", pa.list_(pa.struct([("paths", pa.list_(pa.int64())), ("text", pa.string())]))),
        ("contents", _FEATURES),
        ("presentations", _FEATURES),
    ]
)


def style_tree(parsed: DataFrame) -> DataFrame:
    """_host, path, pages, content, presentation and importance of every style node; of distinct
    pages, as copies of a page would pass for what a site repeats."""

    def counted(column: str) -> DataFrame:
        rows = parsed.select("_host", F.explode(f"_page.{column}").alias("_f"))
        return rows.groupBy("_host", F.col("_f.path").alias("path"), "_f.feature").agg(
            F.count(F.lit(1)).alias("_n")
        )

    pages = (
        parsed.select(
            "_host",
            F.explode(
                F.array_distinct(
                    F.concat(
                        F.transform("_page.contents", lambda f: f["path"]),
                        F.transform("_page.presentations", lambda f: f["path"]),
                    )
                )
            ).alias("path"),
        )
        .groupBy("_host", "path")
        .agg(F.count(F.lit(1)).alias("pages"))
    )
    contents = counted("contents").groupBy("_host", "path").agg(
        F.avg(F.log("_n")).alias("_mean_log")
    )
    # of styles that stand n times among m pages: -sum(n/m * log(n/m)) = log(m) - sum(n*log(n))/m
    styles = counted("presentations").groupBy("_host", "path").agg(
        F.sum("_n").alias("_m"),
        F.sum(F.col("_n") * F.log("_n")).alias("_n_log_n"),
        F.count(F.lit(1)).alias("_styles"),
    )
    base = F.log("pages")
    many = F.col("pages") > 1
    content = F.when(many, 1 - F.coalesce("_mean_log", F.lit(0.0)) / base).otherwise(1.0)
    entropy = F.log("_m") - F.col("_n_log_n") / F.col("_m")
    presentation = F.when(many, F.coalesce(entropy / base, F.lit(0.0))).otherwise(1.0)
    weight = F.pow(F.lit(DAMPING), F.coalesce("_styles", F.lit(0)))
    return (
        pages.join(contents, ["_host", "path"], "left")
        .join(styles, ["_host", "path"], "left")
        .select("_host", "path", "pages", content.alias("content"), presentation.alias("presentation"), weight.alias("_w"))
        .withColumn(
            "importance", (1 - F.col("_w")) * F.col("presentation") + F.col("_w") * F.col("content")
        )
        .drop("_w")
    )


def extract(df: DataFrame, source: str = "html", url: str = "url") -> DataFrame:
    """Adds text, the blocks of the main text with an empty line between them, and n_chars."""
    names = [c for c in df.columns if c not in ("text", "n_chars", source)]
    parsed = _parsed(df.withColumn("_host", host_of(F.col(url))), source).withColumns(
        {"_of_page": F.xxhash64(source), "_row": F.monotonically_increasing_id()}
    )
    parsed = parsed.select(*names, "_host", "_of_page", "_row", "_page")
    parsed = stored(parsed, "parsed-pages", compression="zstd")
    # what is joined with the pages is stored first, so that Spark knows its size and, while it
    # is small, sends it to the pages instead of moving them
    copied = stored(
        parsed.groupBy(F.col("_host").alias("_in"), F.col("_of_page").alias("_copy"))
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n"),
        "copied-pages",
    )
    same = F.col("_host").eqNullSafe(F.col("_in")) & (F.col("_of_page") == F.col("_copy"))
    firsts = parsed.select("_host", "_of_page", "_row", "_page").join(copied, same, "left").where(
        F.col("_first").isNull() | (F.col("_first") == F.col("_row"))
    )
    poor = stored(
        style_tree(firsts)
        .where((F.col("pages") >= FEW) & (F.col("importance") < LEAST))
        .groupBy(F.col("_host").alias("_of"))
        .agg(F.collect_set("path").alias("_poor")),
        "poor-branches",
    )
    kept = F.filter(
        "_page.blocks",
        lambda b: F.col("_poor").isNull() | ~F.arrays_overlap(b["paths"], F.col("_poor")),
    )
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n")
    return (
        parsed.join(poor, F.col("_host") == F.col("_of"), "left")
        .withColumn("text", text)
        .select(*names, "text", F.length("text").cast("long").alias("n_chars"))
    )
