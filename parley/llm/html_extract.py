"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of tags and of words.  Words score positive and tags
negative, with weights fitted on labelled pages (pages whose markup itself
names the main part, by <article> or <main>): the log odds of a token lying
inside that part.  Words within boilerplate (navigation, forms, adverts, ...)
and links have weights of their own.  One linear scan (Kadane) finds the
contiguous region with the highest sum.  An exact step follows: the region is
widened to the element that holds it, and boilerplate inside is left out.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A comment, a raw-text element with its content, or a tag; each may be cut off
# by the end of the page.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!/?]?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)"
    r"|<[!/?][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
MAIN = frozenset({"article", "main"})
WHOLE = frozenset({"", "html", "body"})
BOILERPLATE_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe svg select button dialog menu head title textarea "
    "fieldset object canvas".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar "
    "navigation sidebar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments reply "
    "replies footer header masthead breadcrumb breadcrumbs widget widgets toolbar pagination pager search "
    "complementary contentinfo navigation disclaimer copyright form alert".split()
)
# Words for the head of a part: inside the main part they name its own title.
HEAD_WORDS = frozenset({"header", "masthead"})
KEEP_TAGS = frozenset({"html", "body", "main", "h1"})
# Elements of running text: boilerplate only if every word of an attribute says so.
TEXT_TAGS = frozenset({"article", "p", "h2", "h3", "h4", "h5", "h6"})
# Start tags before which HTML lets an open <p> end.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
# Elements whose end tag may be left out, by kind: the start tags that end one,
# and the elements through which no start tag ends one.
OPEN_KINDS = ("p", "li", "dt", "cell", "row")
KIND = {"p": "p", "li": "li", "dt": "dt", "dd": "dt", "td": "cell", "th": "cell", "tr": "row"}
ENDED_BY = {
    **{name: ("p",) for name in ENDS_P},
    "li": ("p", "li"),
    "dt": ("p", "dt"),
    "dd": ("p", "dt"),
    "td": ("cell",),
    "th": ("cell",),
    "tr": ("cell", "row"),
    **{name: ("cell", "row") for name in ("tbody", "thead", "tfoot")},
}
BARRIERS = {
    "li": frozenset("ul ol menu table td th".split()),
    "dt": frozenset("dl table td th".split()),
    "cell": frozenset({"table"}),
    "row": frozenset({"table"}),
}

WORD_KINDS = ("plain", "link", "boilerplate")


@dataclass
class Segment:
    """Text between two tags, or one tag (then ``tag`` is its name)."""

    text: str = ""
    words: int = 0
    kind: str = "plain"
    tag: str = ""
    opens: bool = False
    main: bool = False
    element: int = 0


@dataclass
class Elements:
    """The elements of a page, numbered as they open (0: the page): name,
    parent and the last element opened inside."""

    names: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])
    last: list[int] = field(default_factory=lambda: [0])

    def holds(self, outer: int, inner: int) -> bool:
        return outer <= inner <= self.last[outer]


@dataclass
class Weights:
    """Score of a word by kind (plain is positive) and of a tag by name (all
    negative)."""

    words: dict[str, float] = field(default_factory=lambda: {"plain": 1.0, "link": -0.5, "boilerplate": -1.0})
    tags: dict[str, float] = field(default_factory=dict)
    other_tag: float = -0.5


def is_boilerplate(name: str, tag: str, in_main: bool) -> bool:
    """Whether an element is boilerplate by its name or by the words of its
    class, id or role.  The head of the main part belongs to it; elements of
    running text must be named as boilerplate by all words of an attribute."""
    if name in BOILERPLATE_TAGS or (name == "header" and not in_main):
        return True
    if name in KEEP_TAGS or "=" not in tag:
        return False
    listed = BOILERPLATE_WORDS - HEAD_WORDS if in_main else BOILERPLATE_WORDS
    for m in ATTRIBUTE.finditer(tag):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower()
        found = {w for w in re.split(r"[^a-z]+", value) if w}
        if found and (found <= listed if name in TEXT_TAGS else not listed.isdisjoint(found)):
            return True
    return False


@dataclass(slots=True)
class Open:
    """An element that is not closed yet, and for each of ``OPEN_KINDS`` the
    depth of the element of that kind that a start tag here may end (0: none)."""

    name: str
    element: int
    boiler: bool
    in_main: bool
    ends: tuple[int, ...]


def ends_inside(name: str, outer: tuple[int, ...], depth: int) -> tuple[int, ...]:
    """``Open.ends`` of an element ``name`` at ``depth`` within one with
    ``outer``.  A block hides an open <p>, and lists and tables their items."""
    if name in INLINE:
        return outer
    own = KIND.get(name)
    return tuple(
        depth if kind == own else 0 if kind == "p" or name in BARRIERS[kind] else at
        for kind, at in zip(OPEN_KINDS, outer, strict=True)
    )


def segments(page: str) -> tuple[list[Segment], Elements]:
    """The page's texts and tags in order, and its elements.  Paragraphs, list
    items and table cells whose end tags are left out end where HTML says so.
    Time and memory are linear in the page, however deep its elements nest."""
    out: list[Segment] = []
    elements = Elements()
    stack = [Open("", 0, False, False, (0,) * len(OPEN_KINDS))]
    opened: Counter[str] = Counter()

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            decoded = html_lib.unescape(raw) if "&" in raw else raw
            top = stack[-1]
            kind = "boilerplate" if top.boiler else "link" if opened["a"] else "plain"
            out.append(Segment(decoded, len(decoded.split()), kind, main=top.in_main, element=top.element))
        elif raw:
            out.append(Segment(" ", 0))

    def close() -> str:
        top = stack.pop()
        elements.last[top.element] = len(elements.names) - 1
        opened[top.name] -= 1
        return top.name

    at = 0
    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        if m[1]:
            out.append(Segment(tag=m[1].lower()))
            continue
        named = NAME.match(m[0])
        if not named:
            continue
        name = named[2].lower()
        out.append(Segment(tag=name, opens=not named[1]))
        if not named[1]:
            for kind in ENDED_BY.get(name, ()):
                depth = stack[-1].ends[OPEN_KINDS.index(kind)]
                while depth and len(stack) > depth:
                    close()
        if name in VOID or m[0].endswith("/>"):
            continue
        if not named[1]:
            top = stack[-1]
            boiler = is_boilerplate(name, m[0], top.in_main) or top.boiler
            ends = ends_inside(name, top.ends, len(stack))
            stack.append(Open(name, len(elements.names), boiler, top.in_main or (name in MAIN and not boiler), ends))
            elements.names.append(name)
            elements.parents.append(top.element)
            elements.last.append(0)
            opened[name] += 1
        elif opened[name]:
            while close() != name:
                pass
    text(page[at:])
    while stack:
        close()
    return out, elements


def fit_weights(pages: list[str]) -> Weights:
    """Log odds of words and tags inside the named main part.

    Plain words are kept positive and tags negative; without labelled pages
    the default weights hold.
    """
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    labelled = 0
    for page in pages:
        parts, _ = segments(page)
        if not any(s.tag in MAIN for s in parts):
            continue
        labelled += 1
        depth = 0
        for s in parts:
            if s.tag in MAIN:
                depth = max(0, depth + (1 if s.opens else -1))
            elif s.tag:
                (inside if depth else outside)[f"<{s.tag}>"] += 1
            elif s.words:
                (inside if s.main else outside)[s.kind] += s.words
    weights = Weights()
    if not labelled:
        return weights
    log_odds = lambda k: math.log((inside[k] + 1.0) / (outside[k] + 1.0))
    unit = max(log_odds("plain"), 0.5)
    weights.words = {
        "plain": 1.0,
        "link": min(0.5, log_odds("link") / unit),
        "boilerplate": min(-0.5, log_odds("boilerplate") / unit),
    }
    for key in {*inside, *outside}:
        if key.startswith("<"):
            weights.tags[key[1:-1]] = min(-0.05, max(-5.0, log_odds(key) / unit - 0.1))
    return weights


def best_region(parts: list[Segment], weights: Weights) -> tuple[int, int]:
    """First and end index of the segments with the highest sum (the first
    such region); (0, 0) if no sum is positive."""
    best, span, total, first = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(parts):
        total += weights.tags.get(s.tag, weights.other_tag) if s.tag else s.words * weights.words[s.kind]
        if total <= 0.0:
            total, first = 0.0, i + 1
        elif total > best:
            best, span = total, (first, i + 1)
    return span


def holding_element(parts: list[Segment], elements: Elements, first: int, end: int) -> int:
    """The innermost <article> or <main> that holds all text of the region, or
    else the innermost element that does."""
    held = [s.element for s in parts[first:end] if s.words and s.kind != "boilerplate"]
    common = held[0] if held else 0
    for element in held:
        while not elements.holds(common, element):
            common = elements.parents[common]
    outer = common
    while outer and elements.names[outer] not in MAIN:
        outer = elements.parents[outer]
    if outer:
        return outer
    while common and elements.names[common] in (INLINE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li"}):
        common = elements.parents[common]
    return common


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the main text joined by newlines; "" if there is none."""
    parts, elements = segments(page or "")
    first, end = best_region(parts, weights)
    if first == end:
        return ""
    element = holding_element(parts, elements, first, end)
    if elements.names[element] not in WHOLE:
        chosen = [s if s.tag or not s.words or elements.holds(element, s.element) else None for s in parts]
    else:
        chosen = list(parts[first:end])
    blocks: list[str] = []
    run: list[str] = []
    for s in chosen:
        if s is None or s.kind == "boilerplate" or (s.tag and s.tag not in INLINE):
            if run:
                blocks.append(" ".join("".join(run).split()))
                run = []
        elif not s.tag:
            run.append(s.text)
    if run:
        blocks.append(" ".join("".join(run).split()))
    return "\n".join(b for b in blocks if b)


def train_weights(pages: DataFrame, html_col: str = "html", max_pages: int = 512) -> Weights:
    """Weights from at most ``max_pages`` different labelled pages, those with
    the least hash of their html: a sample of the whole table that depends
    neither on the order of its rows nor on copies."""
    labelled = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)[\s>]")).select(
        F.xxhash64(html_col).alias("hash"), F.col(html_col).alias("html")
    )
    least = labelled.select(F.col("hash").alias("least")).distinct().orderBy("least").limit(max_pages)
    chosen = labelled.join(F.broadcast(least), F.col("hash") == F.col("least"), "left_semi")
    rows = chosen.groupBy("hash").agg(F.min("html").alias("html")).collect()
    return fit_weights([r["html"] for r in sorted(rows)])


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_pages: int = 512
) -> DataFrame:
    """(id, url, text, n_chars) per page, from the whole html; no shuffle.

    NULL and empty html give the empty text; cut-off tags, comments and
    elements end with the page; repeated rows are extracted alike; NULL ids
    and urls pass through; an empty table gives an empty result.
    """
    weights = train_weights(pages, html_col, max_pages)
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))
    fields = T.StructType([
        T.StructField(id_col, rows.schema[0].dataType),
        T.StructField(url_col, rows.schema[1].dataType),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(page.as_py(), weights) for page in part.column(2)]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()),
                           pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=fields.names)

    return rows.mapInArrow(extract, fields)
