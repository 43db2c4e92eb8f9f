"""Main text of web pages as the maximum-scoring subsequence of words and tags.

A page is a sequence of events, words and tags. Words score positive and tags negative, with weights
that labelled pages teach: pages that mark their article themselves (an article or main element) show
how often each kind of event lies inside and outside of it. The kind of a word is the tag before it,
the kind of a tag its name. A weight is the log of the ratio of both shares, held positive for words
and negative for tags. One linear scan finds the contiguous region with the largest sum; that region,
without elements that are no part of an article wherever they stand, is the text. Such elements cost
the region a little for each tag and teach no weights, so an advert between paragraphs doesn't cut it.

Weights come from all pages, as counts per kind of event; the kinds are a fixed list.

Defined results: null, empty or tag-only html gives an empty text; raw text elements (script, style and
the like), comments and broken tags never give text; repeated rows give repeated results; pages learn
from fixed weights when no page is labelled; an empty table gives an empty result; further columns stay, but columns
`text` and `n_chars` are replaced by the result.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import ship

# Names of the markup language.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot "
    "th thead tr ul".split()
)
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meta link q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_ARTICLE = set("aside button dialog footer form header iframe menu nav object select".split())
NO_ARTICLE_ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
NO_ARTICLE_NAMES = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer header "
    "menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion recommended related replies reply "
    "respond share sharing sidebar social sponsor sponsored subscribe subscription widget".split()
)
ARTICLE = {"article", "main"}
#: Parts of a name that say what an element has or how it looks, not what it is; and names of the content itself.
MODIFIERS = set("has have with without no not is show hide enable disable allow open closed enabled disabled allowed on off active inactive visible hidden free status count".split())
CONTENT = set("article body content entry main page post single story text wrapper".split())

#: A page of fewer words is looked at again without the names of its elements.
FEW = 25

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|template|textarea|noscript|svg|math|iframe|object)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-z][a-z0-9:-]*+)[^>]*+>"
    r"|<[!?/][^>]*+>"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PARTS = re.compile(r"[a-z]+|[0-9]+")


def names_no_article(value: str) -> bool:
    """Whether a class or id says that an element is no part of an article.

    A name counts where none of its parts is a modifier (`has-sidebar`, `comments-open` describe what holds the article). A
    compound name counts less than one word alone: it doesn't speak against a name of the content beside it.
    """
    strong = weak = content = False
    for name in value.lower().strip("\"'").split():
        parts = PARTS.findall(name)
        if MODIFIERS & set(parts):
            continue
        listed = NO_ARTICLE_NAMES & set(parts)
        strong |= bool(listed) and len(parts) == len(listed)
        weak |= bool(listed)
        content |= bool(CONTENT & set(parts)) and not listed
    return strong or weak and not content


def no_article(name: str, attrs: str, by_name: bool = True) -> bool:
    """Whether an element is a menu, header, footer, sidebar, notice, advert, form or comment."""
    if name in NO_ARTICLE:
        return True
    if name in ("html", "body", *ARTICLE):
        return False
    for what, value in ATTR.findall(attrs) if attrs else ():
        if what.lower() == "role":
            if NO_ARTICLE_ROLES & set(PARTS.findall(value.lower())):
                return True
        elif by_name and names_no_article(value):
            return True
    return False


def events(page: str, by_name: bool = True):
    """(kind, is tag, words, text, left out) for every tag and text of a page, in order."""
    out: list[list] = []
    skip, depth, begun = None, 0, 0  # the element that is left out, how deep in its own name, where it began
    last = "start"
    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is None:
            name = m["name"] or m["name2"]
            if not name:
                continue
            name, end = name.lower(), bool(m["end"] or m["end2"])
            if skip is None and not end and name not in VOID and no_article(name, m["attrs"] or "", by_name):
                skip, depth, begun = name, 0, len(out)
            known = name if name in BLOCKS or name in INLINE else "other"
            last = known
            out.append([("/" if end else "") + known, True, 0, name, skip is not None])
            if skip == name:
                depth += -1 if end else 1
                if depth == 0:
                    skip, last = None, "/" + known
        else:
            if "&" in text:
                text = entities.unescape(text)
            words = len(text.split())
            if text:
                out.append(["word " + last, False, words, text, skip is not None])
    if skip is not None:  # no end tag: it ends where the next block begins
        for i in range(begun + 1, len(out)):
            if out[i][1] and out[i][3] in BLOCKS:
                for x in out[i:]:
                    x[4] = False
                break
    return out


def shares(page: str) -> Counter:
    """How many events of each kind lie inside and outside of the page's marked article; empty if none is marked."""
    found = events(page)
    marks = [i for i, e in enumerate(found) if e[1] and e[3] in ARTICLE]
    if len(marks) < 2:
        return Counter()
    out: Counter = Counter()
    for i, (kind, tag, words, _, left_out) in enumerate(found):
        if not left_out:
            out[kind, marks[0] < i < marks[-1]] += 1 if tag else words
    return out


def weigh(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds of each kind, at least 0.05 for words and at most -0.05 for tags."""
    inside = sum(n for (_, side), n in counts.items() if side) or 1
    outside = sum(n for (_, side), n in counts.items() if not side) or 1
    out = {}
    for kind in {k for k, _ in counts}:
        w = math.log((counts.get((kind, True), 0) + 0.5) / inside * outside / (counts.get((kind, False), 0) + 0.5))
        out[kind] = max(0.05, w) if kind.startswith("word") else min(-0.05, w)
    return out


def unlearned(kind: str) -> float:
    """The weight of a tag that no labelled page shows: what stands inside a line costs least, unknown elements most."""
    name = kind.lstrip("/")
    return -0.1 if name in INLINE else -0.5 if name in BLOCKS else -2.0


def region(found: list, weights: dict[str, float]) -> tuple[int, int]:
    """The contiguous events with the largest sum, as a half-open range."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, tag, words, _, left_out) in enumerate(found):
        if left_out:
            total -= 0.3 * tag
        elif tag:
            total += weights.get(kind) or unlearned(kind)
        elif words:
            total += words * weights.get(kind, 1.0)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, span = total, (start, i + 1)
    return span


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    found = events(page)
    a, b = region(found, weights)
    inside = sum(e[2] for e in found[a:b] if not e[4])
    if inside < FEW:  # names alone must not take the page's text away
        other = events(page, by_name=False)
        c, d = region(other, weights)
        if sum(e[2] for e in other[c:d] if not e[4]) > 4 * inside + FEW:
            found, a, b = other, c, d
    blocks, line = [], []
    for _, tag, _, text, left_out in found[a:b]:
        if tag:
            if text in BLOCKS:
                blocks.append("".join(line))
                line = []
            elif text == "br":
                line.append(" ")
        elif not left_out:
            line.append(text)
    blocks.append("".join(line))
    return "\n".join(x for x in (" ".join(y.split()) for y in blocks) if x)


def learn(pages: DataFrame, html: str) -> dict[str, float]:
    """Weights from all labelled pages."""

    def count(batches):
        total: Counter = Counter()
        for b in batches:
            for x in b.column(0).to_pylist():
                if x:
                    total.update(shares(x))
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.string()), pa.array([s for _, s in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())], ["kind", "inside", "n"])

    rows = pages.select(html).mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    return weigh({(r["kind"], r["inside"]): r["n"] for r in rows})  # a row per kind, a fixed list


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """The pages without their html, with text and n_chars."""
    ship(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(learn(pages, html))
    rest = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def read(batches):
        for b in batches:
            texts = [main_text(x, held.value) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*rest, "text", "n_chars"])

    schema = pages.select(*rest).withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema
    return pages.select(html, *rest).mapInArrow(read, schema)
