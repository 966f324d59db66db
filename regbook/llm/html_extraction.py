"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is read as a sequence of words and tags. Words score positive and tags negative;
a linear scan finds the contiguous region with the highest total, which is the content:
navigation and listings are dense in tags and lose, running text wins. The weights are
the log-odds of lying inside the content, counted over labelled pages: those that mark
their content themselves, with exactly one ``<article>`` or, without one, one ``<main>``.
A word's weight depends on the element that holds it, a tag's on its name, and both on
the part of the page they stand in (article, menu, footer, ...) and the first word of a
class: a list in the article is no menu. What was not counted falls back to the same
without the class, then to the part of the page alone; a tag never takes its weight from
another part.

Inside the region, elements that never hold content (scripts, forms, menus, adverts,
comment sections and the like) are passed over. Names exclude whole sections only, not
paragraphs or headings, and never what holds the outermost ``<article>`` or ``<main>``.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, quoted

# Labelled pages that weights are counted over, about so many.
LABELLED_PAGES = 5_000
# Weights kept, the most frequent first; more only come from unusual class names.
FEATURES = 5_000
LIMIT = 8.0
LEAST = 0.05

# Names are matched whole, and no alternative looks past the next "<", so that a page of
# broken tags takes no longer than another.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/>])[^<>]*+(?<=/)>"
    r"|<(script|style|noscript|template|iframe|object|svg|canvas|textarea|select|title)(?=[\s/>])[^<>]*+>"
    r".*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>"
    r"|<[!?/][^<>]*+>",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*+=\s*+(?:\"([^\"]*)|'([^']*)|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z0-9]+")

# Element names of HTML by their role.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "link main menu meta nav ol option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
HOLDERS = frozenset("article aside body div footer form header head main menu nav section table ul ol dl".split())
EXCLUDED = frozenset("aside button dialog footer form head menu nav option search".split())
VOID = frozenset("br hr img input link meta wbr area base col embed source track".split())
# Words in class, id or role that name parts which are not content.
EXCLUDED_NAMES = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies copyright disqus footer gdpr masthead menu nav "
    "navbar navigation newsletter notice pagination popup promo promotion recommended related replies "
    "reply respond share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar "
    "widget commentlist commentarea commentlists commentform".split()
)
# Words that make a class name tell of a state or a frame, not of a part.
STATES = frozenset(
    "has no not with without is on off open opened closed hidden content wrap wrapper layout page body".split()
)
# Elements by which a page marks its content itself.
MARKS = ("article", "main")
# Elements that no name excludes.
UNNAMED = frozenset("html body main p h1 h2 h3 h4 h5 h6 pre blockquote code".split())
# Elements that make a part of a page, by which weights are told apart.
PARTS = frozenset("article main nav aside header footer form menu head dialog".split())
# Elements whose start ends an open one of the first names, up to the second.
IMPLIED_ENDS = {
    name: (frozenset(ended.split()), frozenset(bounds.split()))
    for names, ended, bounds in (
        ("li", "li", "ul ol menu table"),
        ("dt dd", "dt dd", "dl table"),
        ("option", "option", "select datalist"),
        ("tr", "tr", "table"),
        ("td th", "td th", "tr table"),
        ("tbody tfoot", "thead tbody tfoot", "table"),
        ("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
         "pre section table ul", "p", " ".join(sorted(BLOCKS - {"p"}))),
    )
    for name in names.split()
}


class _Exclusion:
    """An open element that is excluded, within others."""

    __slots__ = ("above", "by_name", "kept", "seen")

    def __init__(self, above: _Exclusion | None, by_name: bool):
        self.above, self.by_name = above, by_name
        # Excluded by a class word, but it holds the article.
        self.kept, self.seen = False, False

    def keep(self) -> None:
        node = self
        while node is not None and not node.seen:
            node.seen, node.kept = True, node.by_name
            node = node.above


def _contents(exclusions: list[_Exclusion | None]) -> list[bool]:
    """Whether nothing excludes a token for good."""
    known: dict[int, bool] = {id(None): True}
    out = []
    for node in exclusions:
        chain = []
        while id(node) not in known:
            chain.append(node)
            node = node.above
        content = known[id(node)]
        for node in reversed(chain):
            content = known[id(node)] = content and node.kept
        out.append(content)
    return out


class _Open:
    """The elements open at a place of the page; finding one takes no walk down them."""

    def __init__(self):
        # Name, exclusion, and the part and holder of what stands in it.
        self.stack: list[tuple[str, _Exclusion | None, str, str]] = []
        self.places: dict[str, list[int]] = {}

    def last(self, names: frozenset[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, name: str, label: str, exclusion: _Exclusion | None) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        part = name if name in PARTS else self.part()
        self.stack.append((name, exclusion, part, label if name in HOLDERS else self.holder()))

    def end(self, names: frozenset[str], bounds: frozenset[str]) -> None:
        """Close the last of the names and all in it, if no bound is open within."""
        place = self.last(names)
        if place > self.last(bounds - names):
            while len(self.stack) > place:
                self.places[self.stack.pop()[0]].pop()

    def exclusion(self) -> _Exclusion | None:
        return self.stack[-1][1] if self.stack else None

    def part(self) -> str:
        return self.stack[-1][2] if self.stack else "body"

    def holder(self) -> str:
        return self.stack[-1][3] if self.stack else "body"


def tokens(page: str) -> list[tuple[str, str, bool]]:
    """``(feature, text, content)`` in page order. Tags have text ``" "`` if they end a
    block and none otherwise; pieces of text carry their characters decoded. A feature is
    the kind (``word``, or the tag's name), what holds it or its class, and the part."""
    features, texts, exclusions = [], [], []
    opened, at = _Open(), 0

    def add(feature: str, text: str, *within: _Exclusion | None) -> None:
        features.append(feature)
        texts.append(text)
        exclusions.append(within[0] if within else opened.exclusion())

    def add_text(raw: str) -> None:
        add(f"word {opened.holder()} {opened.part()}", html.unescape(raw))

    for match in TOKEN.finditer(page):
        if match.start() > at:
            add_text(page[at : match.start()])
        at = match.end()
        name = match[3] or match[6]
        if name is None:
            continue
        name, closing = name.lower(), bool(match[2] or match[5])
        attributes = "" if closing else (match[4] or match[7] or "")
        found = _names(attributes)
        words = [w for kind, value in found if kind != "id" for w in WORD.findall(value)]
        block = " " if name in BLOCKS else ""
        if closing:
            add(f"/{name} {opened.part()}", block)
            # An inline element does not end the blocks around it.
            opened.end(frozenset((name,)), frozenset() if name in BLOCKS else BLOCKS)
            continue
        part = opened.part()
        if name in IMPLIED_ENDS:
            opened.end(*IMPLIED_ENDS[name])
        exclusion = opened.exclusion()
        if name not in VOID and not attributes.endswith("/"):
            inside = opened.last(frozenset(MARKS)) >= 0
            if name in MARKS and not inside and exclusion is not None:
                exclusion.keep()
            bad = name in EXCLUDED or name == "header" and not inside
            named = name not in UNNAMED and _is_excluded(found, name)
            if bad or named:
                exclusion = _Exclusion(exclusion, not bad)
            opened.push(name, f"{name}.{words[0]}" if words else name, exclusion)
        add(f"{name}{'.' + words[0] if words else ''} {part}", block, exclusion)
    if at < len(page):
        add_text(page[at:])
    return list(zip(features, texts, _contents(exclusions)))


def _names(attributes: str) -> list[tuple[str, str]]:
    """Attribute and value of each name an element has: classes and roles one by one."""
    if not attributes:
        return []
    out = []
    for m in NAMED.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        out += [(kind, v) for v in value.split()]
    return out


def _is_excluded(names: list[tuple[str, str]], element: str) -> bool:
    """Whether a name tells of a part that is not content. A class does by one of its
    words, unless another makes it a state or a frame; an id does as a whole only, and so
    does a class of an article, which may be *about* such a thing."""
    for kind, value in names:
        if value in EXCLUDED_NAMES:
            return True
        if kind != "id" and element != "article":
            words = WORD.findall(value)
            if not EXCLUDED_NAMES.isdisjoint(words) and STATES.isdisjoint((words[0], words[-1])):
                return True
    return False


def label(found: list[tuple[str, str, bool]]) -> list[bool | None] | None:
    """Whether each token lies in the content, if the page marks it; None for the excluded
    parts, which are passed over wherever they stand."""
    for name in MARKS:
        opens = [i for i, (f, _, _) in enumerate(found) if f.startswith((f"{name} ", f"{name}."))]
        ends = [i for i, (f, _, _) in enumerate(found) if f.startswith(f"/{name} ")]
        if len(opens) == 1 and len(ends) == 1 and opens[0] < ends[0]:
            return [opens[0] < i < ends[0] if content else None for i, (_, _, content) in enumerate(found)]
    return None


def _fallbacks(feature: str) -> list[str]:
    """A feature, the same without the class, and for words the part of the page alone."""
    kind, *holder, part = feature.split(" ")
    if holder:
        plain = holder[0].split(".")[0]
        return list(dict.fromkeys((feature, f"word {plain} {part}", f"word {part}")))
    return list(dict.fromkeys((feature, f"{kind.split('.')[0]} {part}")))


def _size(feature: str, text: str) -> int:
    return len(text.split()) if feature.startswith("word ") else 1


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside, outside = Counter(), Counter()
    for batch in batches:
        for page in batch.column(0):
            found = tokens(page.as_py() or "")
            marked = label(found)
            for (feature, text, _), content in zip(found, marked or ()):
                if content is not None:
                    for kind in _fallbacks(feature):
                        (inside if content else outside)[kind] += _size(feature, text)
    names = sorted(inside.keys() | outside.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string())]
        + [pa.array([c[n] for n in names], pa.int64()) for c in (inside, outside)],
        names=["feature", "inside", "outside"],
    )


def learn_weights(
    pages: DataFrame, labelled_pages: int = LABELLED_PAGES, id_col: str = "page_id", html_col: str = "html"
) -> dict[str, float]:
    """Weights per feature from about ``labelled_pages`` pages, chosen by a hash of their
    id and whole page. Words weigh at least ``LEAST``, unless their element is only seen
    outside the content; tags weigh at most minus that. All weights of parts of the page and
    of plain elements are kept (there are a few hundred), and ``FEATURES`` of classes."""
    share = max(1, pages.count() // labelled_pages)
    sample = pages.filter(F.pmod(F.xxhash64(quoted(id_col), F.length(quoted(html_col))), F.lit(share)) == 0)
    counts = (
        arrow_map(sample.select(quoted(html_col)), _count_batches, "feature string, inside long, outside long")
        .groupBy("feature")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .orderBy(F.col("feature").contains("."), F.desc(F.col("inside") + F.col("outside")), "feature")
        .limit(FEATURES)
        .collect()
    )
    weights = {}
    for feature, inside, outside in counts:
        odds = max(-LIMIT, min(LIMIT, math.log((inside + 0.5) / (outside + 0.5))))
        if feature.startswith("word "):
            weights[feature] = odds if inside == 0 else max(LEAST, odds)
        else:
            weights[feature] = min(-LEAST, odds)
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the highest total; the first of equals,
    empty if no score is positive."""
    best, region = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
    return region


def _marked(found: list[tuple[str, str, bool]]) -> list[bool]:
    """Whether each token lies where content may be: within an element by which the page marks
    it, or anywhere if there is none."""
    depth, inside = 0, []
    for feature, _, content in found:
        name = feature.split(" ", 1)[0].split(".", 1)[0]
        if content and name in MARKS:
            depth += 1
        inside.append(depth > 0)
        if content and name[:1] == "/" and name[1:] in MARKS:
            depth = max(0, depth - 1)
    return inside if any(inside) else [True] * len(found)


def extract(page: str | None, weights: dict[str, float]) -> str:
    found = tokens(page or "")
    scores, kept, known = [], [], {}
    for (feature, text, content), inside in zip(found, _marked(found)):
        weight = known.get(feature)
        if weight is None:
            learned = [weights[f] for f in _fallbacks(feature) if f in weights]
            weight = known[feature] = learned[0] if learned else 1.0 if feature.startswith("word ") else -LEAST
        kept.append(content and inside)
        if feature.startswith("word "):
            # Text of excluded parts is neither content nor a bridge to more of it.
            scores.append((weight if content and inside else -LEAST) * len(text.split()))
        else:
            # Several marked articles may be one region: their borders do not count.
            border = feature.lstrip("/").split(" ", 1)[0].split(".", 1)[0] in MARKS
            scores.append(weight if content and inside and not border else max(weight, -LEAST))
    start, end = best_region(scores)
    region = zip(found[start:end], kept[start:end])
    return " ".join("".join(text for (_, text, _), keep in region if keep or text == " ").split())


def _extract_batches(batches: Iterator[pa.RecordBatch], weights: dict[str, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(page.as_py(), weights) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def main_text(
    pages: DataFrame,
    weights: dict[str, float] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``(page_id, url, text)`` per row of ``pages``, repeated rows included.

    White space is one blank inside and between blocks, none at the ends. A null or
    empty page, or one without words that could be content, has the empty text. Without
    ``weights`` they are learned from ``pages``; if no page is labelled every word counts
    one and every tag ``-LEAST``. Other columns are not read."""
    if weights is None:
        weights = learn_weights(pages, id_col=id_col, html_col=html_col)
    rows = pages.select(
        quoted(id_col).alias("page_id"), quoted(url_col).alias("url"), quoted(html_col).alias("html")
    )
    kind = rows.schema["page_id"].dataType.simpleString()
    return arrow_map(
        rows, partial(_extract_batches, weights=weights), f"page_id {kind}, url string, text string"
    )
