"""Main text of web pages as the maximum-scoring run of words and tags, with weights from labelled pages.

A page is a sequence of words, which score above zero, and tags, which score below. The best contiguous run
is found in one scan. Its words and tags are weighed by how they fall inside and outside the content of
labelled pages: a word by the tag of the block or container it stands in, a tag by its name.
"""

from __future__ import annotations

import functools
import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names and the words in class, id and role attributes that mark boilerplate; fixed values.
BOILERPLATE_TAGS = frozenset("nav header footer aside menu dialog button select option fieldset noscript".split())
BOILERPLATE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget ad ads advert adverts"
    " advertisement sponsor sponsored promo promotion banner cookie cookies consent notice gdpr popup modal newsletter subscribe"
    " signup login form search share sharing social related recommended comment comments reply replies disqus discussion"
    " respond pagination pager toolbar copyright contentinfo complementary".split()
)
#: Those of them that mark what readers wrote, which may be most of a page, if they come last in a class name or only such
#: parts follow. Parts that tell of something else if they come first.
COMMENT_WORDS = frozenset("comment comments reply replies disqus discussion respond".split())
PART_WORDS = frozenset(
    "wrap wrapper layout container page content main body inner outer grid row site area section list thread item box block panel"
    " text form author meta header footer title count link links children post user entry".split()
)
MODIFIERS = frozenset("has with no without is not hide show".split())
#: Elements whose text is never shown, elements that break no text, elements without an end tag; fixed values.
HIDDEN_TAGS = "script|style|template|iframe|object|canvas|title|textarea|noscript|xmp|noembed|noframes"
#: What a head holds, without and with text; anything else ends it, as its end tag may be left out.
HEAD_TAGS, HEAD_TEXT_TAGS = "meta|link|base|basefont|bgsound", "title|style|script|noscript|template|noframes"
#: Tags that end an svg or math element left open, and elements within them that may hold such tags.
FLOW_TAGS = (
    "html|body|b|big|blockquote|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|meta|nobr|ol|p|pre|ruby|s|small"
    "|span|strong|strike|sub|sup|table|tbody|thead|tfoot|tr|td|th|tt|u|ul|var|article|main|section|header|footer|nav|aside|form|button|label"
    "|figure|figcaption|address|details|summary|fieldset"
)
HOLDERS = "foreignobject|desc|title|annotation-xml|mi|mo|mn|ms|mtext"
INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT_TAGS = frozenset("article main".split())
#: What an open element of the name is ended by, besides its own end; fixed values.
CLOSED_BY = {
    "p": frozenset("p div ul ol table h1 h2 h3 h4 h5 h6 blockquote pre section article aside header footer nav form main hr dl".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
#: Labelled pages that are read to fit the weights, and the longest that are.
LABELLED, LABELLED_CHARS = 400, 100_000
#: A kind of word or tag seen less often keeps its default weight.
SEEN = 20

_ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+"
_TEXT = "|".join(rf"<{t}(?=[\s/>])[^>]*>.*?(?:</{t}\s*>|\Z)" for t in HEAD_TEXT_TAGS.split("|"))
_HEAD = rf"<head(?=[\s/>])[^>]*>(?:\s++|<!--.*?(?:-->|\Z)|{_TEXT}|</?(?:{HEAD_TAGS})(?=[\s/>])[^>]*>)*+(?:</head\s*>)?"
_HELD = "|".join(rf"<{t}(?=[\s/>])[^>]*+(?:(?<=/)>|>.*?(?:</{t}\s*>|(?=</(?:svg|math)\s*>)|\Z))" for t in HOLDERS.split("|"))
_DRAWN = (
    rf"<(?:svg|math)(?=[\s/>]){_ATTRIBUTES}(?:(?<=/)>|>(?:[^<]++|{_HELD}"
    rf"|(?!</?(?:{FLOW_TAGS})(?=[\s/>])|</(?:svg|math)(?=[\s>]))<)*+(?:</(?:svg|math)\s*>)?)"
)
_TOKEN = re.compile(
    rf"([^<]+)|<!--.*?(?:-->|\Z)|<({HIDDEN_TAGS})(?=[\s/>])[^>]*>.*?(?:</\2\s*>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*>?"
    rf"|{_HEAD}|{_DRAWN}|<([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>|<[!?][^>]*>?|<[a-zA-Z/][^<]*\Z|(<)",
    re.S | re.I,
)
_MARKS = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACES = re.compile(r"\s+")


@dataclass
class Element:
    """An element of the page: its name, parent and mark (see ``mark_of``), the outermost article or main element it
    stands in, and what follows from the whole page: the mark that makes it boilerplate, the context of its words."""

    name: str
    parent: Element | None
    mark: str = ""
    content: Element | None = field(default=None, repr=False)
    by: str = ""
    context: str = ""
    n_words: int = 0
    holds_content: bool = False

    def __post_init__(self) -> None:
        self.content = self.parent and self.parent.content
        if self.content is None and self.name in CONTENT_TAGS:
            self.content = self

    @property
    def boilerplate(self) -> bool:
        return self.by in ("tag", "class")


@dataclass
class Block:
    """Text between two breaks, the element it stands in, and the tags that precede it."""

    element: Element
    tags: list[str]
    parts: list[str] = field(default_factory=list)

    @functools.cached_property
    def text(self) -> str:
        return " ".join(_SPACES.split(references.unescape("".join(self.parts)))).strip()

    @property
    def n_words(self) -> int:
        return self.text.count(" ") + 1 if self.text else 0


def mark_of(name: str, attributes: str) -> str:
    """What speaks for boilerplate: tag, comment or class (also id, role), form, or nothing.

    A word of boilerplate anywhere in a class name counts, unless a modifier leads the name.
    """
    if name in BOILERPLATE_TAGS:
        return "tag"
    if not attributes or name in ("html", "body", "main"):
        return ""
    found = "form" if name == "form" else ""
    for m in _MARKS.finditer(attributes):
        for token in (m[1] or m[2] or m[3] or "").lower().split():
            parts = _WORD.findall(token)
            if not parts or (len(parts) > 1 and parts[0] in MODIFIERS):
                continue
            last = len(parts)
            while last and parts[last - 1] in PART_WORDS and parts[last - 1] not in COMMENT_WORDS:
                last -= 1
            if last and parts[last - 1] in COMMENT_WORDS:
                return "comment"
            if name != "form" and not BOILERPLATE_WORDS.isdisjoint(parts):
                found = "class"
    return found


def settle(elements: list[Element], found: list[Block]) -> None:
    """Which elements, parents first, are boilerplate, and the contexts of words.

    A class or a form makes no boilerplate of what holds more than half of the words outside boilerplate tags, of a
    main element, or of the page's only article (for a form, of any). Nor does a comment's class of what holds an
    article or main element that is no comment. A form is a context, judged by its weight.
    """
    for b in found:
        b.element.n_words += b.n_words
    articles = 0
    for e in reversed(elements):
        articles += e.name == "article" and e.content is e
        if e.parent is not None:
            e.parent.n_words += e.n_words
            e.parent.holds_content |= e.holds_content or (e.name in CONTENT_TAGS and e.mark != "comment")
    only = articles == 1
    left = elements[0].n_words
    for e in elements[1:]:
        if e.mark == "comment":
            e.mark = "class" if e.holds_content or (only and e.name == "article" and e.content is e) else "tag"
        e.by = "tag" if e.mark == "tag" or e.parent.by == "tag" else ""
        left -= e.n_words if e.by and not e.parent.by else 0
    for e in elements[1:]:
        if not e.by:
            inherited, own = e.parent.by, e.mark if 2 * e.n_words <= left else ""
            single = only and e.name == "article" and e.content is e
            if e.name == "main" or single or (e.name == "article" and inherited == "form"):
                inherited, own = "", "" if single else own
            e.by = "class" if "class" in (own, inherited) else own or inherited
        e.context = "boilerplate" if e.boilerplate else e.by or e.name


def blocks(page: str) -> list[Block]:
    """The page's blocks in order. Unclosed and misnested elements end with what holds them.

    Each element is opened and left once, and an end tag without an open element is known by a count of the
    open names, so time grows with the page, however deep it is nested.
    """
    top = Element("", None)
    open_, tags, elements, inside = top, [], [top], Counter()
    out = [Block(top, tags)]

    def start() -> None:
        if out[-1].parts:
            out.append(Block(open_, []))
        out[-1].element = open_

    def left(e: Element) -> Element:
        inside[e.name] -= 1
        return e.parent

    for m in _TOKEN.finditer(page):
        text, _, ended, name, attributes, less = m.groups()
        text = text or less
        if text is not None:
            out[-1].parts.append(text)
        elif name is not None:
            name = name.lower()
            if name == "br":
                out[-1].parts.append(" ")
                continue
            if name in INLINE_TAGS and not mark_of(name, attributes):
                out[-1].tags.append(name)
                continue
            while open_.parent is not None and name in CLOSED_BY.get(open_.name, ()):
                open_ = left(open_)
            if name not in VOID_TAGS and not attributes.rstrip().endswith("/"):
                open_ = Element(name, open_, mark_of(name, attributes))
                inside[name] += 1
                elements.append(open_)
            start()
            out[-1].tags.append(name)
        elif ended is not None:
            name = ended.lower()
            if name == "p" or name not in INLINE_TAGS or inside[name]:
                if inside[name]:
                    while open_.name != name:
                        open_ = left(open_)
                    open_ = left(open_)
                start()
            out[-1].tags.append("/" + name)
    out = [b for b in out if b.parts or b.tags]
    settle(elements, out)
    return out


@dataclass
class Weights:
    """Scores: of a word by the context of its block, of a tag by its name; the last two for those not seen."""

    words: dict[str, float]
    tags: dict[str, float]
    word: float = 1.0
    tag: float = -0.3

    def of_word(self, context: str) -> float:
        return self.words.get(context, -1.0 if context in ("boilerplate", "form") else self.word)

    def of_tag(self, name: str) -> float:
        return self.tags.get(name, -0.1 if name.lstrip("/") in INLINE_TAGS else self.tag)


def counts(page: str) -> Counter:
    """How often each kind of word (w) and tag (t) stands inside and outside a labelled page's content."""
    seen = Counter()
    for b in blocks(page):
        inside = b.element.content is not None and not b.element.boilerplate
        seen["w", b.element.context, inside] += b.n_words
        for t in b.tags:
            seen["t", t, inside] += 1
    return seen


def fit(seen: Counter) -> Weights:
    """Log odds of standing inside: words between 0.1 and 1, those mostly outside below zero; tags from -3 to -0.1."""
    totals = {(kind, inside): 1 + sum(n for (k, _, i), n in seen.items() if (k, i) == (kind, inside)) for kind in "wt" for inside in (True, False)}

    def often(kind: str) -> set[str]:
        return {n for k, n, _ in seen if k == kind and seen[k, n, True] + seen[k, n, False] >= SEEN}

    def odds(kind: str, name: str) -> float:
        return math.log((seen[kind, name, True] + 1) / totals[kind, True]) - math.log((seen[kind, name, False] + 1) / totals[kind, False])

    words = {name: max(0.1, min(1.0, o)) if (o := odds("w", name)) > 0 else max(-2.0, o) for name in often("w")}
    tags = {name: max(-3.0, min(-0.1, odds("t", name) - 0.1)) for name in often("t")}
    return Weights(words, tags)


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and past-the-last place of the contiguous run with the largest sum, (0, 0) if none is above zero.

    Of equals the first to end, with all that it can start with."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total < 0 or not i:
            total, start = 0.0, i
        total += s
        if total > best:
            best, at = total, (start, i + 1)
    return at


def main_text(page: str, weights: Weights) -> str:
    """The blocks of the best run, without boilerplate, joined by spaces.

    An article or main element that the run touches is taken in as a whole, besides the rest of the run.
    """
    every = blocks(page)
    scores, owner = [], []
    for i, b in enumerate(every):
        for t in b.tags:
            scores.append(weights.of_tag(t))
            owner.append(i)
        n = b.n_words
        if n:
            scores.append(n * weights.of_word(b.element.context))
            owner.append(i)
    a, z = best_run(scores)
    if a == z:
        return ""

    def shown(e: Element) -> bool:
        return not e.boilerplate and (e.by != "form" or weights.of_word("form") > 0)

    run = range(owner[a], owner[z - 1] + 1)
    held = {id(h): h for i in run if every[i].text and shown(every[i].element) and (h := every[i].element.content)}
    taken = [b for i, b in enumerate(every) if i in run or id(b.element.content) in held]
    return " ".join(filter(None, (b.text for b in taken if shown(b.element))))


def train(pages: DataFrame, html_col: str = "html", rows: int = LABELLED) -> Weights:
    """Weights from labelled pages, those that mark their content as article or main.

    At most ``rows`` of them, up to LABELLED_CHARS characters long, the first by a hash of the page. Without
    any, all weights are the defaults.
    """
    page = F.col(html_col)
    labelled = pages.where(page.rlike(r"(?i)<(article|main)[\s>]") & (F.length(page) <= LABELLED_CHARS))
    hashed = labelled.select(page.alias("html"), F.xxhash64(page).alias("h"))
    # the bound first, from hashes alone: else every task would send its own first pages
    last = hashed.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    some = hashed.where(F.col("h") <= F.lit(last).cast("long")).orderBy("h", "html").limit(rows)
    seen = Counter()
    for r in some.select("html").collect():
        seen.update(counts(r[0]))
    return fit(seen)


def extract(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns ``id_col``, ``url_col``, text, n_chars; one row per row of ``pages``.

    A NULL or empty page, or one without content, has the empty text. Character references are decoded,
    white space within a block is one space, blocks are joined by one. Only the named columns are read.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "", weights) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["key", "url", "text", "n_chars"],
            )

    done = pages.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        run, f"key {kinds[0]}, url {kinds[1]}, text string, n_chars long"
    )
    return done.select(F.col("key").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
