"""Operator 3: main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags, whose weights are counted on labelled pages:
about ``SAMPLE`` pages, by a hash of their text, that mark their content with exactly one
article or main element. A word's weight is the log odds that a word of its place (the
innermost container with its class) is content; a tag's is the log of the share of its
occurrences in its place that are in content, so it is never positive. Places, and tags in
places, that no labelled page has get the weights of ``PRIOR_*``. One scan finds the contiguous region of greatest
sum, and words of negative weight in it are left out.

What the marks can't teach is a prior: containers whose element or name is known for
boilerplate (menus, adverts, comments and so on) count as not content for the labels, at
whatever depth; inside marked content they neither add to the region nor part it. A name
says so only if all its parts do, or are words of layout: ``ad-box`` does, ``ad-free``,
``no-sidebar`` and ``related-work`` don't. Names of html, body, main and article say
nothing, and the page's first main or article is content wherever it stands.

Text: character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by a line feed. br counts as white space; comments,
scripts, styles and the text of controls have no words.

Nulls and empty pages give the empty text; so do pages without a word of positive
weight. Very long pages: time and memory are linear in the page, also where tags, quotes
and elements are not closed.
Unclosed elements end with the element around them. Repeated rows are read each on its
own; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released

SAMPLE = 400
#: Weights of what no labelled page has: a word's, a word's in known boilerplate, a tag's.
PRIOR_WORD, PRIOR_BAD, PRIOR_TAG = 0.5, -2.0, math.log(0.8)
LEAST, MOST = -3.0, 3.0

_VALUE = r"=\s*(?>\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?"
TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][\w:-]*)((?>[^>\"'=]+|{_VALUE}|[\"'])*+)>|[^<]+|<", re.DOTALL)
#: One step within a tag, a mark that it may end or turn at, and the name that it starts with.
STEP = re.compile(rf"[^>\"'=]+|{_VALUE}|[\"']")
MARK = re.compile(r"[>\"'=]")
NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
CLASS = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
#: Elements by their part in HTML, and names that mark boilerplate.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
SILENT = set("noscript template svg math select datalist optgroup option button object canvas audio video".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote figcaption caption".split())
BOILERPLATE_TAGS = set("nav header footer aside form menu dialog head".split())
BOILERPLATE_NAMES = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer header menu nav navbar navigation newsletter notice pagination popup promo related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
LAYOUT_WORDS = set("area bar bars block body bottom box btn button buttons col column container content form global group head holder icons inner item items large left link links list main mobile module outer page panel post posts primary right row secondary section side site slot small thread top unit wrap wrapper zone".split())
OPEN_TAGS = {"html", "body", "main", "article"}


def pieces(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(kind, name or text, closing, attributes) with kind tag or text; raw elements have no text."""
    at, n = 0, len(page)
    broken: Broken | None = None
    while at < n:
        if broken is not None and (head := NAME.match(page, at)):
            # A tag of this page wasn't closed: what is known not to be is not looked through again.
            end = broken.tag_end(head.end())
            closing, name, attributes = (bool(head[1]), head[2].lower(), page[head.end() : end - 1]) if end else (False, "", "")
            text, at = "<", end or at + 1
        else:
            m = TOKEN.match(page, at)
            closing, name, attributes, text, at = bool(m[1]), (m[2] or "").lower(), m[3], m[0], m.end()
            if text == "<" and broken is None and NAME.match(page, m.start()):
                broken = Broken(page)
                at = m.start()
                continue
        if name:
            yield "tag", name, closing, attributes
            if name in RAW and not closing and not _closed(attributes):
                end = re.compile(rf"</{name}\b", re.IGNORECASE).search(page, at)
                at = end.start() if end else n
        elif not text.startswith(("<!", "<?")):
            yield "text", text, False, ""


class Broken:
    """What is known of a page with unclosed tags: places from which no tag ends, and the next mark that matters in one."""

    def __init__(self, page: str) -> None:
        self.page, self.dead, self.asked, self.next = page, set(), 0, -1

    def _mark(self, at: int) -> int:
        if not self.asked <= at <= self.next:
            found = MARK.search(self.page, at)
            self.asked, self.next = at, found.start() if found else len(self.page)
        return self.next

    def tag_end(self, at: int) -> int:
        """The end of a tag whose name ends at a place, as TOKEN finds it; 0 if it has none. No place is stepped over twice in vain."""
        at, seen = self._mark(at), []
        while at < len(self.page) and at not in self.dead:
            if self.page[at] == ">":
                return at + 1
            seen.append(at)
            at = STEP.match(self.page, at).end()
        self.dead.update(seen)
        return 0


def _closed(attributes: str) -> bool:
    """Whether a tag ends itself: a slash that is no part of an unquoted value."""
    return bool(re.search(r"(?:^|[\s\"'])/\s*$", attributes))


def _names(attributes: str) -> list[str]:
    found = " ".join(next(g for g in m.groups() if g is not None) for m in CLASS.finditer(attributes)).lower()
    return found.split()


def _known(name: str) -> bool:
    """Whether a name is made of boilerplate's names, at least one, and words of layout."""
    parts = [p for p in re.split(r"[-_:]+", name) if p]
    return any(p in BOILERPLATE_NAMES for p in parts) and all(p in BOILERPLATE_NAMES or p in LAYOUT_WORDS for p in parts)


def _boilerplate(tag: str, names: list[str], inside_content: bool) -> bool:
    if tag in BOILERPLATE_TAGS and not (tag == "header" and inside_content):
        return True
    return tag not in OPEN_TAGS and any(_known(n) for n in names)


def tokens(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """("text", place, labelled content, text), or ("tag", place and name, labelled content, what it puts into the text).

    A place starts with ! in known boilerplate, with ? if that is inside marked content.
    A tag puts a space (br), a line feed (the end of a block) or nothing.
    """
    stack: list[tuple[str, str, bool, bool, bool]] = []
    opened: Counter = Counter()
    marked = False
    for kind, what, closing, attributes in pieces(page):
        _, name, content, bad, silent = stack[-1] if stack else ("", "", False, False, False)
        place = ("" if not bad else "?" if content else "!") + name
        if kind == "text":
            if not silent:
                yield "text", place, content and not bad, what
            continue
        puts = " " if what == "br" else "" if what in INLINE or what in RAW or what in SILENT else "\n"
        yield "tag", f"{place} {what}", content and not bad, puts
        if what in INLINE:
            continue
        if what in VOID or _closed(attributes):
            continue
        if closing:
            while opened[what]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == what:
                    break
        elif what not in LEAVES and what not in RAW:
            if what in ("option", "optgroup") and stack and stack[-1][0] == "option":
                opened[stack.pop()[0]] -= 1
            names = _names(attributes)
            if what in ("article", "main"):
                # The first one on a page is content, whatever it stands in.
                content, bad, marked = True, bad and marked, True
            stack.append((what, ".".join([what, *sorted(set(names))]), content, bad or _boilerplate(what, names, content), silent or what in SILENT))
            opened[what] += 1


def labelled(page: str) -> Counter | None:
    """Words and tags by (kind, place or name, content) of a page that marks its content once."""
    if len(re.findall(r"<(?:article|main)\b", page, re.IGNORECASE)) != 1:
        return None
    out: Counter = Counter()
    for kind, what, content, text in tokens(page):
        out[kind, what, content] += len(text.split()) if kind == "text" else 1
    return out


Weights = dict[tuple[str, str], float]


def weight(kind: str, what: str, weights: Weights) -> float:
    if what.startswith("?"):
        return 0.0
    if kind == "tag":
        return weights.get((kind, what), PRIOR_TAG)
    return weights.get((kind, what), PRIOR_BAD if what.startswith("!") else PRIOR_WORD)


def learned(kind: str, yes: int, no: int) -> float:
    """A word's log odds, a tag's log share, each counted as seen once more either way."""
    return max(LEAST, min(MOST, math.log((yes + 1) / (no + 1)) if kind == "text" else math.log((yes + 1) / (yes + no + 2))))


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous run of greatest sum, the first and shortest of equal ones; empty if none is positive."""
    best, start, end = 0.0, 0, 0
    total, first = 0.0, 0
    for i, x in enumerate(scores):
        total += x
        if total <= 0:
            total, first = 0.0, i + 1
        elif total > best:
            best, start, end = total, first, i + 1
    return start, end


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    sequence = list(tokens(page))
    of = {(kind, what): weight(kind, what, weights) for kind, what, _, _ in sequence}
    start, end = best_region([of[kind, what] * (len(text.split()) if kind == "text" else 1) for kind, what, _, text in sequence])
    parts = []
    for kind, what, _, text in sequence[start:end]:
        if kind == "tag":
            parts.append(text)
        elif of[kind, what] > 0:
            # Line feeds of the page are white space; those of tags end a block.
            parts.append(html.unescape(text).replace("\n", " "))
    found = (" ".join(b.split()) for b in "".join(parts).split("\n"))
    return "\n".join(b for b in found if b)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for page in batch.column(0).to_pylist():
            total.update(labelled(page) or {})
        keys = sorted({x[:2] for x in total})
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.string()), pa.array([w for _, w in keys], pa.string()), *[pa.array([total[k, w, y] for k, w in keys], pa.int64()) for y in (True, False)]], names=["kind", "what", "yes", "no"])


def fit(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights of the places and tags that the sampled labelled pages have."""
    marked = pages.select(F.col(html_col).cast("string").alias("html")).where(F.col("html").rlike(r"(?i)<(article|main)\b"))
    n = marked.count()
    # Copies are drawn together and count once, so the sample's size doesn't depend on them.
    drawn = marked.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < min(1.0, SAMPLE / max(n, 1)) * (1 << 30)).distinct()
    counts = drawn.mapInArrow(released(_count), "kind string, what string, yes long, no long").groupBy("kind", "what").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    return {(r["kind"], r["what"]): learned(r["kind"], r["yes"], r["no"]) for r in counts.collect()}


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    weights = pages.sparkSession.sparkContext.broadcast(fit(pages, html_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([main_text(x.as_py(), known) for x in batch.column(2)], pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(released(run), "page_id long, url string, text string")
