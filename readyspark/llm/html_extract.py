"""Main text of web pages by a maximum-scoring subsequence (operator 5).

A page is a sequence of words and tags. Words score by where they stand (in a
paragraph, a link, a menu, ...) and tags score negative; the contiguous region
of the largest total, found by one linear scan, is the article. The weights are
learned from labelled pages, those that mark their article themselves (exactly
one ``article``, ``main`` or ``itemprop="articleBody"`` element): words inside
are content, others are not. The marking elements are no features, so pages
without them are scored alike. The parts of class, id and role names are learned
too: each has a weight from how often elements so named stand inside and outside
marked articles, beside pseudo-counts for common names of menus, adverts, comments
and the like. An element of whose names one adds up to less than ``NAME_OUT`` is
outside: its words never score positive and are left out even inside the region,
unless it holds the page's only marked article or most of its paragraph words:
then it is a wrapper, and the scored region decides. So are forms and hidden parts.

The walk over a page is linear in it, however deep or broken its markup is.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import fresh, prepare_python, strings, written

SAMPLE_PAGES = 2000  # labelled pages that the weights are learned from, by least hash of the id

# fixed element names
RAW = frozenset("script style noscript template textarea iframe noembed noframes xmp title".split())
FOREIGN = frozenset(("svg", "math"))  # left by the next block element, if not closed
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li legend main menu nav ol optgroup
 option p pre section select summary table tbody td tfoot th thead tr ul""".split())
CLOSE_P = BLOCK - {"br", "button", "caption", "tbody", "td", "th", "tr", "thead", "tfoot", "option", "optgroup",
                   "legend", "summary", "body", "html", "head"}
SCOPE = frozenset("table td th button".split())
MARKED = frozenset(("article", "main"))
OUTSIDE = frozenset("nav aside footer form head button select menu dialog label option".split())
# pseudo-counts (elements inside, outside an article) of the parts of names: of those that
# by the task's terms are never the article, wherever they stand; of those that a chapter
# may have in its name as well; and of those that say nothing. Any other part speaks for
# the article until labelled pages say otherwise
NAME_PRIOR = dict.fromkeys("""nav navbar navigation menu menubar sidebar footer masthead breadcrumb breadcrumbs cookie cookies
 consent gdpr ad ads advert adverts advertisement sponsor sponsored promo newsletter subscribe subscription signup login
 register comment comments commentlist disqus replies respond sharing widget popup modal overlay pagination pager toolbar
 contentinfo complementary alertdialog""".split(), (0.0, 1000.0))  # adverts stand inside articles too, and stay out
NAME_PRIOR |= dict.fromkeys("side notice notices banner share social related recommended skip search alert toc tags".split(), (0.2, 1.2))
NAME_PRIOR |= dict.fromkeys("""area aside bar block body bottom box button buttons center col column container content form global header
 inner item left links list main outer page panel posts region right section site slot top wrap wrapper""".split(), (1.0, 1.0))
OTHER_NAME = (2.0, 0.5)
NAME_OUT = -0.5
NAME_PART = re.compile(r"[^\W\d_]+")
NAMED = frozenset("div section ul ol aside span p table details dl figure header td li form iframe ins".split())
# of them, what may hold more paragraphs than the article does
REMARKS = re.compile(r"(?:^|[\s_-])(comments?|commentlist|disqus|replies|respond)(?=$|[\s_-])", re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
OTHER = re.compile(r"<!--.*?(?:--!?>|\Z)|<![^>]*>|<\?[^>]*>", re.S)
PLAIN = re.compile(r"[^\"'>]*")
ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

# score limits: a word counts at most one, a tag costs at most a few words; an
# advert inside an article costs half a word for each of its own, so that the
# region can reach over it (its words are left out of the result all the same)
WORD_MAX, WORD_MIN, OUT_MIN, TAG_MAX, TAG_MIN = 1.0, -2.0, -0.5, 2.0, 0.05
# what a place is worth without labelled pages: pseudo-counts of (inside, outside)
PRIOR = {"word": (20.0, 4.0), "word a": (3.0, 20.0), "word out": (0.0, 1000.0)}
TAG_PRIOR = (4.0, 4.0)


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTR.findall(text)}


def name_odds(named: str, weights: Mapping[str, float]) -> float:
    """The least sum of part weights over the names in class, id and role."""
    least = 0.0
    for name in named.split():
        parts = {p.lower() for p in NAME_PART.findall(name)}
        least = min(least, sum(weights.get(f"name {p}", name_weight(p)) for p in parts))
    return least


def name_weight(part: str, inside: float = 0, outside: float = 0) -> float:
    a, b = NAME_PRIOR.get(part, OTHER_NAME)
    return max(-3.0, min(1.0, math.log((inside + a + 0.2) / (outside + b + 0.2))))


def tokens(page: str, weights: Mapping[str, float] = {}) -> list[tuple[str, str, str, bool]]:
    """``walk``, once more where it met wrappers that a name or a form puts out."""
    held: dict[int, list] = {}  # place in the page: paragraph words, marked articles, whether they are remarks
    found = list(walk(page, held, frozenset(), weights))
    if held:
        whole = held.pop(-1, [0, 0, False])
        wrappers = frozenset(at for at, (words, marks, remarks) in held.items()
                             if whole[1] == marks == 1 or whole[1] != 1 and not remarks and 2 * words > whole[0])
        if wrappers:
            return list(walk(page, {}, wrappers, weights))
    return found


def tags(page: str) -> Iterator[tuple[int, str, str, str]]:
    """The page's pieces as (place, kind, name or text, attributes): kind ``tag``,
    ``/tag`` or ``text``; comments and declarations are left out."""
    at, last = 0, page.rfind(">")
    final = {q: page.rfind(q) for q in "\"'"}
    while at < len(page):
        if page[at] != "<":
            stop = page.find("<", at)
            stop = len(page) if stop < 0 else stop
            yield at, "text", page[at:stop], ""
            at = stop
            continue
        if at > last and not page.startswith("<!--", at):  # nothing closes any more
            yield at, "text", page[at:], ""
            return
        if m := OTHER.match(page, at):
            at = m.end()
            continue
        m = TAG.match(page, at)
        if not m:
            yield at, "text", "<", ""
            at += 1
            continue
        stop = m.end()
        while stop < len(page):
            stop = PLAIN.match(page, stop).end()
            if stop == len(page) or page[stop] == ">":
                break
            quote = page[stop]
            stop = page.find(quote, stop + 1) + 1 if stop < final[quote] else len(page)
        if stop >= len(page):  # a quote that isn't closed: up to the next bracket
            stop = page.index(">", m.end())
        name = m[2].lower()
        yield at, "/tag" if m[1] else "tag", name, page[m.end():stop]
        at = stop + 1
        if name in RAW and not m[1] and not page[:stop].endswith("/", m.end(), stop):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)


class Open:
    """The open elements, with what the walk asks of them kept up to date."""

    def __init__(self, held: dict[int, list]):
        self.stack: list[tuple[str, bool, bool, int]] = []  # name, outside the article, marks it, wrapper's place or -1
        self.at: dict[str, list[int]] = {}  # places on the stack by name
        self.scopes: list[int] = []
        self.blocks: list[int] = []  # but paragraphs
        self.out = self.marked = 0
        self.held, self.wrappers = held, [-1]

    def last(self, *names: str) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def push(self, name: str, out: bool, article: bool, wrapper: int) -> None:
        k = len(self.stack)
        self.stack.append((name, out, article, wrapper))
        self.at.setdefault(name, []).append(k)
        if name in SCOPE:
            self.scopes.append(k)
        if name in BLOCK and name != "p":
            self.blocks.append(k)
        self.out += out
        self.marked += article
        if wrapper >= 0:
            self.wrappers.append(wrapper)

    def cut(self, k: int) -> None:
        """Close the elements from place ``k`` on."""
        while len(self.stack) > max(k, 0):
            name, out, article, wrapper = self.stack.pop()
            self.at[name].pop()
            if name in SCOPE:
                self.scopes.pop()
            if name in BLOCK and name != "p":
                self.blocks.pop()
            self.out -= out
            self.marked -= article
            if wrapper >= 0:  # what it holds its outer wrapper holds too
                self.wrappers.pop()
                inner, outer = self.held.setdefault(wrapper, [0, 0, False]), self.held.setdefault(self.wrappers[-1], [0, 0, False])
                outer[0] += inner[0]
                outer[1] += inner[1]

    def count(self, k: int, n: int) -> None:
        self.held.setdefault(self.wrappers[-1], [0, 0, False])[k] += n


def walk(page: str, held: dict[int, list], wrappers: frozenset[int], weights: Mapping[str, float],
         seen: Counter | None = None) -> Iterator[tuple[str, str, str, bool]]:
    """The page as (kind, name or text, place, inside a marked article): kind is
    ``tag``, ``/tag`` or ``text``; a place is ``out`` (of the article by an
    element's name), ``a`` (a text in a link) or empty. ``seen`` counts the parts of
    elements' names (part, inside)."""
    open_ = Open(held)
    for at, kind, name, raw in tags(page):
        if kind == "text":
            if open_.at.get("p"):
                open_.count(0, len(name.split()))
            yield "text", name, "out" if open_.out else "a" if open_.at.get("a") else "", open_.marked > 0
            continue
        if kind == "/tag":
            hidden = open_.out > 0
            k = open_.last(name)
            if k >= 0 and (name in ("table", "body", "html") or not open_.scopes or k >= open_.scopes[-1]):
                open_.cut(k)
            yield "/tag", name, "out" if hidden else "", open_.marked > 0
            continue
        has = attributes(raw) if raw.strip(" /") else {}
        if name in RAW:
            yield "tag", name, "out" if open_.out else "", open_.marked > 0
            continue
        if name in BLOCK and (k := min((open_.at[n][0] for n in FOREIGN if open_.at.get(n)), default=-1)) >= 0:
            open_.cut(k)
        if (name in CLOSE_P or name == "p") and (k := open_.last("p")) >= 0 and k >= (open_.blocks[-1] if open_.blocks else -1):
            open_.cut(k)
        if name in ("li", "option", "dd", "dt", "tr", "td", "th"):
            same = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th")}.get(name, (name,))
            k = open_.last(*same)
            if k >= 0 and k >= open_.last("ul", "ol", "dl", "table", "menu", "select", "tr"):
                open_.cut(k)
        article = name in MARKED or has.get("itemprop", "").lower() == "articlebody"
        inside = open_.marked > 0 or article
        named = " ".join(has.get(k, "") for k in ("class", "id", "role"))
        if seen is not None and named and not article:
            seen.update((p, inside) for p in {p.lower() for p in NAME_PART.findall(named)})
        wrapper = name == "form" or name in NAMED and named and name_odds(named, weights) < NAME_OUT
        out = (name in OUTSIDE and name != "form" or name in FOREIGN or name == "object" or name == "header" and not inside
               or "hidden" in has and not has["hidden"].startswith("until")
               or has.get("aria-hidden", "").lower() == "true" or "display:none" in has.get("style", "").replace(" ", "")
               or wrapper and at not in wrappers)
        yield "tag", name, "out" if out or open_.out else "", inside
        if name in VOID or raw.rstrip().endswith("/") and name not in BLOCK:
            continue
        open_.push(name, bool(out), article, at if wrapper else -1)
        if wrapper:
            held.setdefault(at, [0, 0, False])[2] = bool(REMARKS.search(named))
        if article:
            open_.count(1, 1)
    open_.cut(0)


def place_key(kind: str, name: str, place: str) -> str:
    if kind == "text":
        return f"word {place}".strip()
    if place == "out":
        return "tag out"
    return "tag " + (name if name in BLOCK or name in VOID or name in RAW or name in ("a", "b", "i", "em", "strong", "span") else "other")


def name_counts(page: str) -> Counter:
    """How often each part of a name occurs (key, inside the article)."""
    names: Counter = Counter()
    for _ in walk(page, {}, frozenset(), {}, names):
        pass
    return Counter({(f"name {p}", inside): n for (p, inside), n in names.items()})


def counts(page: str, weights: Mapping[str, float] = {}) -> Counter:
    """How often each scored place occurs (key, inside the article), by the names' weights."""
    found: Counter = Counter()
    for kind, name, place, inside in tokens(page, weights):
        key = place_key(kind, name, place)
        if kind != "text":
            found[key, inside and name not in MARKED] += 1
        elif n := len(name.split()):
            found[key, inside] += n
    return found


def weights_of(found: Mapping[tuple[str, bool], float]) -> dict[str, float]:
    """Scores of words by place, and of tags, from the counts of labelled pages."""
    keys = {k for k, _ in found} | set(PRIOR)
    out = {}
    for key in keys:
        if key.startswith("name "):
            # a name of few pages says little: parts that are no known name need more than a handful
            out[key] = name_weight(key[5:], found.get((key, True), 0), found.get((key, False), 0))
            continue
        prior = PRIOR.get(key, TAG_PRIOR)
        inside, outside = found.get((key, True), 0) + prior[0], found.get((key, False), 0) + prior[1]
        odds = math.log((inside + 0.5) / (outside + 0.5))
        if key.startswith("word"):
            out[key] = max(WORD_MIN, min(WORD_MAX, odds))
        else:  # a tag is the dearer the more it belongs to what isn't the article
            out[key] = -max(TAG_MIN, min(TAG_MAX, TAG_MIN - odds))
    for key in ("word out", "tag out"):
        out[key] = max(OUT_MIN, min(out.get(key, OUT_MIN), -TAG_MIN))
    return out


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from at most ``sample`` labelled pages, those of least id hash.
    Without labelled pages the priors alone decide."""
    prepare_python(pages.sparkSession)
    marks = r"(?i)<(article|main)[\s>]|itemprop\s*=\s*.?articleBody"
    once = F.regexp_count(F.col(html_col), F.lit(marks)) == 1
    chosen = (pages.where(F.col(id_col).isNotNull() & once).select(F.col(id_col).alias("id")).distinct()
                   .orderBy(F.xxhash64("id"), "id").limit(sample))
    chosen = written(chosen, "labelled-pages")  # ids of a bounded sample
    texts = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).join(F.broadcast(chosen), "id", "left_semi")
    texts = written(texts.select("html"), "labelled-pages")

    def counted(count) -> dict[tuple[str, bool], int]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for b in batches:
                for page in strings(b.column(0)):
                    found.update(count(page))
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
                 pa.array([found[k] for k in keys], pa.int64())], names=["key", "inside", "n"])

        sums = texts.mapInArrow(run, "key string, inside boolean, n long").groupBy("key", "inside").agg(F.sum("n").alias("n"))
        return {(r["key"], r["inside"]): r["n"] for r in sums.collect()}  # a row per element name or name part of the sample

    named = counted(name_counts)
    names = {k: w for k, w in weights_of(named).items() if k.startswith("name ")}
    # what names put out is counted apart from other words
    return weights_of(counted(lambda page: counts(page, names))) | names


def main_text(page: str, weights: Mapping[str, float]) -> str:
    """The blocks of the best region, one per line."""
    found = [(kind, name, place) for kind, name, place, _ in tokens(page, weights)]
    other = weights.get("tag other", -TAG_MIN)
    best = total = 0.0
    start = stop = since = 0
    for k, (kind, name, place) in enumerate(found):
        key = place_key(kind, name, place)
        total += weights.get(key, other) * (len(name.split()) if kind == "text" else 1)
        if total <= 0:
            total, since = 0.0, k + 1
        elif total > best:
            best, start, stop = total, since, k + 1
    blocks, block = [], []
    for kind, name, place in found[start:stop]:
        if kind == "text":
            if place != "out":
                block.append(name)
        elif name in BLOCK:
            blocks.append(block)
            block = []
    blocks.append(block)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, weights: Mapping[str, float], html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` without its html, with the main text (empty if there is none).

    Null and empty pages give the empty text; repeated rows and null ids are
    returned as they come; a column already named as the result is replaced. A
    map over the scan, a page at a time.
    """
    prepare_python(pages.sparkSession)
    keep = [c for c in pages.columns if c not in (html_col, out_col)]
    held = fresh(pages, "_html")
    read = pages.select(*keep, F.col(html_col).alias(held))
    fixed = dict(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = pa.array([main_text(p, fixed) for p in strings(b.column(b.num_columns - 1))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], got], names=[*b.schema.names[:-1], out_col])

    schema = read.drop(held).withColumn(out_col, F.lit("")).schema
    return read.mapInArrow(run, schema)
