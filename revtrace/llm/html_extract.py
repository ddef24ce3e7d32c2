"""Main text of web pages by a site style tree.

The DOMs of a host are merged by *path*: the chain of tags, classes and ids from
the root, without positions. Every path of a host gets two entropies over the
m pages that have it, both to the base m:

* presentation: how evenly its pages spread over the ways its children are laid out;
* content: 1 - the mean over its text blocks of log_m(k), where k pages show the
  block. Text that returns on every page has importance 0, text of its own 1.

The composite importance weighs content ``GAMMA``. Paths with an importance under
``LOW`` are removed from each page, from two pages on. As a word or a heading can return on
a few pages by chance, the path must repeat ``REPEATED`` characters at least (those of all
showings but each block's first).

Pages that are copies of each other show nothing about their site. A host's paths
are therefore only removed if its other text differs: counted once for the host, the blocks
(or the characters) of what stays must be more than those of what goes. How much of a
single page goes does not matter.

Besides, a page's own markup is read: raw elements (scripts, styles, drawings; of a formula, the notes that say it again), and
branches that are menus, footers, asides or hidden by tag or role go. Forms, headers and branches that only
say by a word of a class or id that they are such, or sidebars, notices, adverts or
comments, are doubtful, as wrappers of a whole page are named after what
stands in them too. A doubtful branch stays if it holds a main element, more articles than the page
has text outside of doubtful branches, or most of the page's text (of the main text, if it stands in it);
the style tree then judges its paths like any others. If an article or
main element is left, the text is what stands in it; if nothing is left, the doubtful branches are taken.

The merge is two grouped aggregates with partial sums (a hot host is combined in
every task first). A page learns its host's removed paths by a join that
Spark broadcasts only when it has measured the list as small.

Defined results: null or empty html gives an empty text. A null url is a host of its own ('').
Repeated rows are pages like any others. An empty table gives an empty
result; extra columns are ignored. Broken markup never fails: what is not a tag is text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import arrow_rows, materialize

GAMMA = 0.9
LOW = 0.5
REPEATED = 24

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|annotation|annotation-xml|select|object|xmp)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: The elements of a formula: inline, and ended at once by a slash.
_FORMULA = frozenset(
    "math semantics mrow mi mo mn ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts mtable mtr mtd".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub "
    "sup time tt u var wbr br".split()
) | _FORMULA
#: A start tag that ends an open element of these.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"thead", "tbody"}, "body": {"head"},
}
_NOISE_TAGS = frozenset("head nav footer aside button input dialog menu".split())
_DOUBTFUL_TAGS = frozenset(("form", "fieldset"))
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary dialog alert menu menubar toolbar alertdialog".split())
_DOUBTFUL_ROLES = frozenset(("form", "search"))
#: Words of a class or id that name a branch of no main text, or what a wrapper of main text has besides.
_NOISE_WORDS = frozenset(
    "nav navbar navigation menu header footer sidebar sidenav aside banner notice alert popup modal overlay form search login signup "
    "social widget toolbar skip".split()
)
#: Such words for branches that can be the longest of a page, or hold articles of their own.
_OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr subscribe newsletter "
    "comment comments reply replies disqus share sharing related breadcrumb breadcrumbs pagination pager copyright".split()
)
#: The share of the text above which a branch named by the former words, or by the latter, is the page's body.
MOST = 0.5
NEARLY_ALL = 0.9
_MAIN = frozenset(("article", "main"))


class Branch:
    """A doubtful branch: characters in all, and of articles that begin in it."""

    __slots__ = ("articles", "chars", "holds_main", "in_main", "most")

    def __init__(self, most: float, in_main: bool):
        self.most, self.in_main, self.chars, self.articles, self.holds_main = most, in_main, 0, 0, False


class Element:
    """``noise`` and ``main`` are final when the page is parsed; ``doubt`` has the doubtful branches around.

    ``around_article`` and ``around_main`` are those around the outermost article or main element the element stands in."""

    __slots__ = ("around_article", "around_main", "doubt", "main", "noise", "path", "plain", "tag")

    def __init__(self, tag: str, path: str, noise: bool, main: bool, doubt: tuple[Branch, ...] = ()):
        self.tag, self.path, self.noise, self.main, self.doubt = tag, path, noise, main, doubt
        self.plain = not noise
        self.around_article = self.around_main = ()


def _attributes(tag: str, attrs: str) -> tuple[str, bool, float, bool, bool]:
    """The element's label, whether it is noise, the share a doubtful one needs (0: no doubt), whether it is an article or main, and main."""
    if not attrs or attrs.isspace():
        return tag, tag in _NOISE_TAGS, MOST if tag in _DOUBTFUL_TAGS else 0, tag in _MAIN, tag == "main"
    got = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
    names = sorted(set(_NAME.findall(got.get("class", "")))) + sorted(set(_NAME.findall(got.get("id", ""))))
    words = {n.lower() for n in names}
    role = got.get("role", "").lower()
    hidden = got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "") or re.search(r"\bhidden\b", _ATTR.sub("", attrs))
    main = (tag in _MAIN or role == "main") and not words & {"comment", "comments", "reply"}
    noise = tag in _NOISE_TAGS or role in _NOISE_ROLES or bool(hidden)
    named = tag not in ("html", "body") and not main
    if named and words & _OTHER_WORDS:
        most = NEARLY_ALL
    else:
        most = MOST if named and words & _NOISE_WORDS or tag in _DOUBTFUL_TAGS or role in _DOUBTFUL_ROLES else 0
    return ".".join([tag, *names]), noise, most, main, main and (tag == "main" or role == "main")


def _decide(blocks: list[tuple[str, Element]]) -> None:
    """Settle the doubtful branches of a page."""
    if not any(e.doubt for _, e in blocks):
        return
    total = main = sure = 0
    for b, e in blocks:
        if e.plain:
            total += len(b)
            main += len(b) if e.main else 0
            sure += 0 if e.doubt else len(b)
            for branch in e.doubt:
                branch.chars += len(b)
            for branch in e.around_article:
                branch.articles += len(b)
            for branch in e.around_main:
                branch.holds_main = True
    for _, e in blocks:
        for branch in e.doubt:
            stays = branch.holds_main or branch.chars > branch.most * (main if branch.in_main else total)
            if not stays and not (branch.most == MOST and branch.articles > sure):
                e.noise, e.main = True, False


def parse(page: str) -> tuple[list[tuple[str, Element]], dict[str, set[str]]]:
    """Text blocks in page order with the element they stand in, and each path's child labels."""
    stack = [Element("", "", False, False)]
    blocks: list[tuple[str, Element]] = []
    styles: dict[str, set[str]] = {"": set()}
    text: list[str] = []

    def flush() -> None:
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if block:
                at = len(stack) - 1
                while at and stack[at].tag in _INLINE:
                    at -= 1
                blocks.append((block, stack[at]))

    def close(at: int) -> None:
        """End the open elements from ``at`` on."""
        if any(e.tag not in _INLINE for e in stack[at:]):
            flush()
        del stack[at:]

    pos = 0
    for m in _TOKEN.finditer(page):
        if m.start() > pos:
            text.append(page[pos : m.start()])
        pos = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                text.append(" ")
            continue
        tag = tag.lower()
        inline = tag in _INLINE
        if m["end"]:
            for at in range(len(stack) - 1, 0, -1):
                open_ = stack[at].tag
                if open_ == tag:
                    close(at)
                    break
                if (inline and open_ not in _INLINE) or (tag == "p" and open_ not in _INLINE) or (tag == "li" and open_ in ("ul", "ol")):
                    break
            else:
                if not inline:
                    flush()
            continue
        if not inline:
            flush()
            ends = _CLOSES.get(tag)
            for at in range(len(stack) - 1, 0, -1):
                open_ = stack[at].tag
                if open_ == "p":  # a block ends an open paragraph
                    close(at)
                    break
                if ends and open_ in ends:
                    close(at)
                    break
                if open_ not in _INLINE and not (ends and open_ in ("b", "p")):
                    break
        elif tag == "br":
            text.append(" ")
        label, noise, most, main, holds_main = _attributes(tag, m["attrs"])
        top = stack[-1]
        if not inline:
            styles.setdefault(top.path, set()).add(label)
        if tag in _VOID or m["attrs"].rstrip().endswith("/") and tag in _FORMULA:
            continue
        path = top.path if inline else f"{top.path}/{label}"
        if tag == "header" and not top.main:
            most = most or MOST
        noise = noise or top.noise
        element = Element(tag, path, noise, (top.main or main) and not noise, (*top.doubt, Branch(most, top.main)) if most else top.doubt)
        element.around_article = top.around_article or (top.doubt if main and not top.main else ())
        element.around_main = top.around_main or (top.doubt if holds_main else ())
        stack.append(element)
    if pos < len(page):
        text.append(page[pos:])
    flush()
    _decide(blocks)
    return blocks, styles


def _hash(s: str) -> int:
    return int.from_bytes(blake2b(s.encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def by_markup(blocks: list[tuple[str, Element]]) -> list[tuple[str, Element]]:
    """The blocks that the page's own markup leaves."""
    return (
        [(b, e) for b, e in blocks if e.main]
        or [(b, e) for b, e in blocks if not e.noise]
        or [(b, e) for b, e in blocks if e.plain and all(branch.most == MOST for branch in e.doubt)]
    )


def main_text(page: str, low: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's main text; ``low`` holds hashes of the host's removed paths."""
    kept = by_markup(parse(page)[0])
    if low:
        known = {p: _hash(p) in low for p in {e.path for _, e in kept}}
        kept = [(b, e) for b, e in kept if not known[e.path]]
    return "\n".join(b for b, _ in kept)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page and distinct (path, child labels) or (path, text block).

    A block has its length, and whether the markup leaves it."""
    known: dict[str, int] = {}
    for batch in batches:
        count, path, kind, value, size, left = [], [], [], [], [], []
        for page in batch.column(1).to_pylist():
            blocks, styles = parse(page)
            seen = {(p, False, ",".join(sorted(s))) for p, s in styles.items()}
            seen |= {(e.path, True, b) for b, e in blocks}
            # Paths without child elements have one way to be laid out.
            seen |= {(p, False, "") for p in {e.path for _, e in blocks} - styles.keys()}
            text = {(e.path, b) for b, e in by_markup(blocks)}
            for p, content, v in seen:
                if p not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[p] = _hash(p)
                path.append(known[p])
                kind.append(content)
                value.append(_hash(v))
                size.append(len(v))
                left.append(content and (p, v) in text)
            count.append(len(seen))
        rows = pa.array(np.repeat(np.arange(len(count)), count))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(rows), pa.array(path, pa.int64()), pa.array(kind, pa.bool_()), pa.array(value, pa.int64()),
                pa.array(size, pa.int64()), pa.array(left, pa.bool_()),
            ],
            ["_host", "_path", "_content", "_value", "_size", "_left"],
        )


def style_tree(pages: DataFrame) -> DataFrame:
    """Per host and path: pages, presentation, content, importance, and over its distinct blocks: their
    number, characters shown again, and number and characters of those the markup leaves. ``pages`` has _host and _html."""
    nodes = pages.select("_host", "_html").mapInArrow(_nodes, "_host string, _path long, _content boolean, _value long, _size long, _left boolean")
    counts = nodes.groupBy("_host", "_path", "_content", "_value").agg(
        F.count(F.lit(1)).alias("_k"), F.max("_size").alias("_size"), F.max("_left").alias("_left")
    )
    k, style, content, left = F.col("_k").cast("double"), ~F.col("_content"), F.col("_content"), F.col("_left")
    paths = counts.groupBy("_host", "_path").agg(
        F.sum(F.when(style, F.col("_k")).otherwise(0)).alias("pages"),
        F.sum(F.when(style, k * F.log(k)).otherwise(0.0)).alias("_s"),
        F.sum(F.when(content, F.log(k)).otherwise(0.0)).alias("_c"),
        F.sum(content.cast("long")).alias("blocks"),
        F.sum(F.when(content, (F.col("_k") - 1) * F.col("_size")).otherwise(0)).alias("repeated"),
        F.sum(left.cast("long")).alias("left_blocks"),
        F.sum(F.when(left, F.col("_size")).otherwise(0)).alias("left_chars"),
    )
    ln = F.log(F.col("pages").cast("double"))
    some = (F.col("pages") > 1) & (F.col("blocks") > 0)
    paths = paths.select(
        "_host", "_path", "pages", "blocks", "repeated", "left_blocks", "left_chars",
        F.when(F.col("pages") > 1, 1 - F.col("_s") / F.col("pages") / ln).otherwise(1.0).alias("presentation"),
        F.when(some, 1 - F.col("_c") / F.col("blocks") / ln).otherwise(1.0).alias("content"),
    )
    return paths.withColumn("importance", (1 - GAMMA) * F.col("presentation") + GAMMA * F.col("content"))


def removed_paths(tree: DataFrame) -> DataFrame:
    """Per host with any: the paths its pages lose."""
    low = (F.col("pages") > 1) & (F.col("blocks") > 0) & (F.col("importance") < LOW) & (F.col("repeated") >= REPEATED)
    sums = [F.sum(F.when(which, F.col(c)).otherwise(0)).alias(f"_{n}_{c}") for n, which in (("own", ~low), ("low", low)) for c in ("left_blocks", "left_chars")]
    hosts = tree.groupBy("_host").agg(F.collect_list(F.when(low, F.col("_path"))).alias("_low"), *sums)
    differs = (F.col("_own_left_blocks") > F.col("_low_left_blocks")) | (F.col("_own_left_chars") > F.col("_low_left_chars"))
    return hosts.where((F.size("_low") > 0) & differs).select("_host", "_low")


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars."""
    arrow_rows(df.sparkSession, 500)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    pages = df.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{url_col}`").alias("_url"),
        host.alias("_host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("_html"),
    )
    removed = materialize(removed_paths(style_tree(pages)), "html-removed-paths")
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField(url_col, df.schema[url_col].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    names = schema.names

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows = batch.column(3).to_pylist()
            found = [main_text(p, frozenset(low or ())) for p, low in zip(batch.column(2).to_pylist(), lows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names
            )

    return pages.join(removed, "_host", "left").select("_id", "_url", "_html", "_low").mapInArrow(texts, schema)
