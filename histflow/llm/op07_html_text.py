"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative;
the contiguous stretch with the highest sum, found in one linear scan, is the
content. The tags' weights come from labelled pages: those with exactly one
``article`` or ``main`` element say which tags stand inside and outside the
content, and a tag's weight is minus its log odds of standing outside, so that
the tags of running text cost almost nothing and those of menus much.

Before the scan, elements that are never main text go: scripts, menus, footers, forms
and the like by name, adverts, sidebars, notices and reader comments by their class, id or
role. A form that holds headings or running text is no form but a page's frame, and stays.
Inside an article only containers go whose class, id or role says nothing but comment, advert
or the like ("related-posts", not "related-work"); never headings or paragraphs, and, but for
comments and adverts, no blocks of mostly running text.

The scan runs over every whole page. Where the stretch it finds lies mostly in an element that
the page itself marks as an article, the article's borders are the stretch's: it neither
loses a short block at its end nor takes in what stands beside it.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from histflow.llm.common import ship

#: Labelled pages that the weights are fitted on, at most.
LABELLED_PAGES = 5000
WORD_SCORE = 1.0
LEAST_COST = 0.01
#: A link in running text may cost no more than a few words, whatever the labels say.
MOST_COST = 2.0

# Fixed values of HTML: elements by what they are.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = RAW | set("head nav footer aside form button select option noscript template dialog object canvas svg menu audio video map datalist".split())
ARTICLE = {"article", "main"}
# Words in a class, id or role that mark what is not the article.
MARKS = set(
    "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner sidebar rail nav navbar navigation menu "
    "breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments disqus respond replies reply pagination pager "
    "toolbar widget widgets copyright legal disclaimer skip contentinfo complementary search".split()
)
#: Marks of elements that never hold the article, even where they hold an ``article`` element.
ALWAYS = {"comment", "comments", "disqus", "respond", "replies", "reply", "related", "recommended", "recommendations", "sidebar"}
#: Marks of what goes even where it is running text.
PLAIN_OUT = {"comment", "comments", "disqus", "respond", "replies", "reply", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "sponsor", "sponsored"}
#: Marks that count inside the article: with these, and words that say nothing, a container is no part of it.
INSIDE = ALWAYS | PLAIN_OUT | {"promo", "promotion", "share", "sharing", "social", "newsletter", "subscribe", "subscription"}
SAYS_NOTHING = set(
    "area articles block body bottom box button buttons container content footer form group header inline inner item items left links list main more news outer "
    "page post posts primary reader readers right secondary section side site slot stories thread top unit user users widget widgets wrap wrapper zone".split()
)
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "article", "main", "figure", "details", "center", "td", "header"}
HEADINGS = {"h1", "h2", "h3"}
#: Words outside links that make a block running text.
RUNNING_WORDS = 25
KNOWN_TAGS = ARTICLE | INLINE | DROPPED | VOID | set(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section header blockquote pre figure figcaption address details summary center hgroup".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.IGNORECASE)

TEXT, OPEN, CLOSE = 0, 1, 2


def tokens(page: str) -> list[tuple[int, str, str]]:
    """(kind, text or element name, attributes) in page order; comments are left out."""
    out: list[tuple[int, str, str]] = []
    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            out.append((TEXT, page[at:], ""))
            break
        if m.start() > at:
            out.append((TEXT, page[at : m.start()], ""))
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        if m[1] or m[4]:
            out.append((CLOSE, name, ""))
            continue
        attributes = m[3] if m[3] is not None else m[6]
        out.append((OPEN, name, attributes))
        if name in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
    return out


def _ends(seen: list[tuple[int, str, str]]) -> list[int]:
    """For each opening tag the place of its closing tag, or -1."""
    ends = [-1] * len(seen)
    waiting: dict[str, list[int]] = {}
    for i, (kind, name, _) in enumerate(seen):
        if kind == OPEN and name not in VOID:
            waiting.setdefault(name, []).append(i)
        elif kind == CLOSE and waiting.get(name):
            ends[waiting[name].pop()] = i
    return ends


def _marked(attributes: str) -> bool:
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(w.lower() in MARKS for m in _NAMED.finditer(attributes) for w in _PARTS.findall(m[1] or m[2] or m[3] or ""))


def _says_only(attributes: str) -> set[str]:
    """Marks of the article's inside, of names that say nothing else."""
    found: set[str] = set()
    for m in _NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            words = {w.lower() for w in _PARTS.findall(name) if not w.isdigit()}
            if words and words <= INSIDE | SAYS_NOTHING:
                found |= words & INSIDE
    return found


class _Page:
    """A page's tokens, with what the rules ask of places and stretches, each in constant time."""

    def __init__(self, page: str) -> None:
        self.seen = seen = tokens(page)
        self.ends = _ends(seen)
        n = len(seen)
        never = self._cover(i for i, (kind, name, attributes) in enumerate(seen) if kind == OPEN and self.ends[i] >= 0 and name in CONTAINERS and _says_only(attributes) & ALWAYS)
        self.articles = [(i, self.ends[i] if self.ends[i] >= 0 else n) for i, (kind, name, _) in enumerate(seen) if kind == OPEN and name in ARTICLE and not never[i]]
        self.inside = self._cover((i for i, _ in self.articles), strictly=True)
        # Running counts before each token: articles, headings, all words, words in links.
        self.n_articles = self._count(lambda i, kind, name: (kind == OPEN and name in ARTICLE) and not never[i])
        self.n_titles = self._count(lambda i, kind, name: kind == OPEN and name == "h1")
        self.n_headings = self._count(lambda i, kind, name: kind == OPEN and name in HEADINGS)
        links = self._cover(i for i, (kind, name, _) in enumerate(seen) if kind == OPEN and name in ("a", "option", "button", "script", "style") and self.ends[i] >= 0)
        # What stands in a script or the like is no words.
        raw = [False, *(kind == OPEN and name in RAW for kind, name, _ in seen)]
        words = [len(name.split()) if kind == TEXT and not raw[i] else 0 for i, (kind, name, _) in enumerate(seen)]
        self.n_words = self._count(lambda i, kind, name: words[i])
        self.n_linked = self._count(lambda i, kind, name: words[i] if links[i] else 0)
        # Tokens that end a stretch of many words without a block's border.
        run, long_ = 0, []
        for w, (kind, name, _) in zip(words, seen):
            run = run + w if kind == TEXT or name in INLINE else 0
            long_.append(w > 0 and run >= RUNNING_WORDS)
        self.n_long = self._count(lambda i, kind, name: long_[i])

    def _cover(self, starts, strictly: bool = False) -> list[int]:
        """How many of the elements that begin at ``starts`` hold each token."""
        n = len(self.seen)
        change = [0] * (n + 2)
        for i in starts:
            end = self.ends[i] if self.ends[i] >= 0 else n
            change[i + strictly] += 1
            change[end + (not strictly)] -= 1
        return list(accumulate(change))[:n]

    def _count(self, of) -> list[int]:
        return [0, *accumulate(int(of(i, kind, name)) for i, (kind, name, _) in enumerate(self.seen))]

    def between(self, counts: list[int], a: int, b: int) -> int:
        """The count of the tokens behind ``a``, up to ``b``."""
        return counts[min(b + 1, len(self.seen))] - counts[a + 1] if b > a else 0

    def running(self, a: int, b: int) -> bool:
        """Whether an element is mostly running text."""
        words, linked = self.between(self.n_words, a, b), self.between(self.n_linked, a, b)
        return words - linked >= RUNNING_WORDS and words > 2 * linked

    def long_text(self, a: int, b: int) -> bool:
        """Whether a form holds a heading or a long paragraph."""
        return self.between(self.n_headings, a, b) + self.between(self.n_long, a, b) > 0


def kept_tokens(page: str) -> tuple[list[tuple[int, str, str]], list[int]]:
    """The tokens without dropped elements, and for each the number of its outermost article (-1: none)."""
    p = _Page(page)
    seen, ends, n = p.seen, p.ends, len(p.seen)
    outer, last = [-1] * (n + 1), -1
    for k, (a, b) in enumerate(p.articles):
        if a > last:
            outer[a : b + 1] = [k] * (min(b, n) + 1 - a)
            last = b
    starts = [a for a, _ in p.articles]
    out, places, i = [], [], 0
    while i < n:
        kind, name, attributes = seen[i]
        if kind == OPEN and name not in VOID:
            inside, end = p.inside[i] > 0, ends[i]
            upto = end if end >= 0 else n
            holds = p.between(p.n_articles, i, upto) > 0
            drop = name in DROPPED or (name == "header" and not inside)
            by_name = drop
            if name == "form" and p.long_text(i, upto):
                i += 1
                continue
            if not drop and name not in ("html", "body"):
                if inside:
                    says = _says_only(attributes) if name in CONTAINERS else set()
                    drop = bool(says) and (bool(says & PLAIN_OUT) or not p.running(i, upto)) or bool(_HIDDEN.search(attributes))
                else:
                    drop = _marked(attributes) and not holds and not p.between(p.n_titles, i, upto)
            if drop:
                if holds and by_name and name != "head" and end >= 0:
                    i += 1
                    continue
                if end < 0:  # never closed: up to the article, or what its parent leaves
                    end = starts[bisect_right(starts, i)] - 1 if holds else (i if name == "head" else _parent_end(seen, i))
                i = end + 1
                continue
        out.append(seen[i])
        places.append(outer[i])
        i += 1
    return out, places


def _parent_end(seen: list[tuple[int, str, str]], i: int) -> int:
    """The last place before a closing tag of an element that was open before ``i``."""
    depth: Counter[str] = Counter()
    for j in range(i, len(seen)):
        kind, name, _ = seen[j]
        if kind == OPEN and name not in VOID:
            depth[name] += 1
        elif kind == CLOSE:
            if depth[name] <= 0:
                return j - 1
            depth[name] -= 1
    return len(seen) - 1


def best_interval(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the stretch with the highest sum, in one scan; (0, 0) if none is above 0."""
    best, begin, end = 0.0, 0, 0
    total, first = 0.0, 0
    for i, x in enumerate(scores):
        total += x
        if total <= 0:
            total, first = 0.0, i + 1
        elif total > best:
            best, begin, end = total, first, i + 1
    return begin, end


def extract(page: str | None, weights: dict[str, float] | None = None) -> str:
    """The main text of a page; the empty text for NULL, or where there is none."""
    if not page:
        return ""
    costs = DEFAULT_WEIGHTS if weights is None else weights
    seen, article = kept_tokens(page)
    words = [len(name.split()) if kind == TEXT else 0 for kind, name, _ in seen]
    scores = [WORD_SCORE * w if kind == TEXT else costs.get(name, -LEAST_COST) for (kind, name, _), w in zip(seen, words)]
    begin, end = best_interval(scores)
    chosen = range(begin, end)
    marked = {article[i] for i in chosen if words[i] and article[i] >= 0}
    if marked and 2 * sum(words[i] for i in chosen if article[i] >= 0) > sum(words[i] for i in chosen):
        # The page's own borders: of the articles that the stretch lies in, all.
        chosen = [i for i, k in enumerate(article) if k in marked]
    parts = []
    for i in chosen:
        kind, name, _ = seen[i]
        if kind == TEXT:
            parts.append(entities.unescape(name))
        elif name not in INLINE:
            parts.append(" ")
    return " ".join("".join(parts).split())


# Without labelled pages: links and list items outside running text cost most.
DEFAULT_WEIGHTS = {"a": -1.0, "li": -0.5, "ul": -0.5, "div": -0.2, "td": -0.3}


def _label(page: str | None) -> tuple[Counter, Counter] | None:
    """Counts of tags inside and outside the one article of a page."""
    seen = tokens(page or "")
    ends = _ends(seen)
    found = [i for i, (kind, name, _) in enumerate(seen) if kind == OPEN and name in ARTICLE]
    if len(found) != 1 or ends[found[0]] < 0:
        return None
    inside, outside = Counter(), Counter()
    for i, (kind, name, _) in enumerate(seen):
        if kind != TEXT and name in KNOWN_TAGS:
            (inside if found[0] < i < ends[found[0]] else outside)[name] += 1
    return inside, outside


def fit_weights(pages: DataFrame, html: str = "html", most: int = LABELLED_PAGES) -> dict[str, float]:
    """A weight for each known tag, from at most ``most`` labelled pages.

    The pages with the lowest hashes of their text are taken, so the choice does
    not depend on their order.
    """
    ship(pages.sparkSession)
    body = pages[html].cast("string")
    lower = F.lower(body)
    # Of hashes below the share that leaves about ``most`` rows.
    n = pages.count()
    limit = F.lit(int(min(1.0, most / max(n, 1)) * 2**62))
    chosen = pages.select(body.alias("html")).where((F.xxhash64(body).bitwiseAND(F.lit(2**62 - 1)) <= limit) & (lower.contains("<article") | lower.contains("<main")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inside, outside = Counter(), Counter()
        for pdf in batches:
            for page in pdf["html"]:
                found = _label(page)
                if found:
                    inside.update(found[0])
                    outside.update(found[1])
        tags = sorted(inside | outside)
        yield pd.DataFrame({"tag": pd.Series(tags, dtype=object), "i": pd.Series([inside[t] for t in tags], dtype="int64"), "o": pd.Series([outside[t] for t in tags], dtype="int64")})

    # A row for each known tag at most.
    rows = chosen.mapInPandas(count, "tag string, i bigint, o bigint").groupBy("tag").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).collect()
    if not rows:
        return dict(DEFAULT_WEIGHTS)
    all_in, all_out = sum(r.i for r in rows) + len(rows), sum(r.o for r in rows) + len(rows)
    return {r.tag: -min(MOST_COST, max(LEAST_COST, math.log((r.o + 1) / all_out) - math.log((r.i + 1) / all_in))) for r in rows}


def extract_pages(pages: DataFrame, weights: dict[str, float], html: str = "html") -> DataFrame:
    """``pages`` with the main text in a new column ``text`` (replaced where there is one).

    NULL and empty pages give the empty text; repeated rows each get theirs. The
    other columns stay, but for ``html``.
    """
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def main_text(column: pd.Series) -> pd.Series:
        return column.map(lambda page: extract(page, weights))

    return pages.withColumn("text", main_text(pages[html].cast("string"))).drop(html)


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = extract_pages(pages.select("page_id", "url", "html"), fit_weights(pages))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
