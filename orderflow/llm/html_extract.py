"""Operator 10: main text of HTML pages as the maximum-scoring run of words and tags.

A page is a sequence of words and tags. A word scores by the elements it stands in, a tag costs something; the best
contiguous run (one linear scan) is the content region, and its words outside boilerplate are the text. The weights come
from pages that label their own content with ``main`` or a single ``article`` (see ``label_of``): for each descriptor (tag,
``tag.class``, ``#id``) words inside and outside the labelled region are counted over all such pages. A label only
serves to fit the weights; a page is read by its descriptors and the scan, whatever labels it holds. Elements whose
name says boilerplate (a menu, an advert within the article) are so by a prior, wherever they stand, and explain the
words they hold; plain tags aren't blamed for words outside, since a link in a menu says nothing about one in a text.
A name is a prior alone: where labelled regions hold much under it, page by page, it counts as content.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import by_row, saved

#: HTML's elements without content, with raw content, and those that don't end a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|iframe|noembed|noframes"
#: Ordinary elements whose content isn't shown as text; one that is never closed holds nothing.
UNSHOWN = frozenset("svg canvas template noscript annotation annotation-xml".split())
#: Within these ``/>`` closes an element, none closes a paragraph, and raw elements are ordinary ones; a block ends them.
FOREIGN = frozenset(["svg", "math"])
BLOCKS = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 li ol p pre table ul".split())
EMBEDS_BLOCKS = frozenset("foreignobject desc title mi mn mo ms mtext annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small "
                   "span strike strong sub sup time tt u var wbr nobr svg canvas template noscript object math semantics annotation "
                   "annotation-xml mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover "
                   "mstyle mpadded mphantom menclose".split())
#: Elements that a new block, or an item of their own kind, closes.
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
#: Names of boilerplate and of content before any page is counted.
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu button select dialog head fieldset datalist".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adslot banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disclaimer disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pagination popup promo promoted promotion related respond reply replies share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar widget".split())
BOILERPLATE_STEMS = re.compile("advert|breadcrumb|comment|cookie|newsletter|promo|sidebar|sponsor|navbar")
#: Words beside a boilerplate word in a name that still says boilerplate (``cookie-notice-bar``); with any other word behind it
#: the name is about something else (``share-prices``, ``notice-of-meeting``).
STRUCTURE_NAMES = frozenset(
    "area articles author bar block body bottom box btn button buttons card cards cell col column container content copyright count "
    "desktop div element fixed float form global group head heading home html icon icons img inline inner input item items label layer "
    "left link links list logo logos main media middle mobile module nav outer page panel popover popular posts primary recent region "
    "right row secondary section site slot social space static sticky stories strip tab tabs text thread title toggle top unit units "
    "view widgets wrap wrapper zone".split())
#: A class or id of these says nothing of that kind: ``body.has-sidebar``, ``h1.post-header``.
UNNAMED_TAGS = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
#: But an article that is itself a comment or a teaser says so by such a name alone (``article.comment``, ``article#comment-7``).
ARTICLE_NAMES = BOILERPLATE_NAMES | {"teaser", "teasers"}
ARTICLE_NAME = re.compile(r"([a-z]+)(?:[-_]+(?:\d+|item|body|card|box|block|entry|list))*")
CONTENT_TAGS = frozenset("article main p h1 h2 h3 h4 h5 h6 blockquote pre".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
#: What a name says before any page is counted, in words; for a name of boilerplate, in words of each page that holds it within
#: its content: labels lift such a name if it holds more there, as a menu, an advert or a notice in an article don't.
PRIOR_WORDS = 50.0
#: So many counts go to the tasks as one table, the most frequent ones; rarer descriptors meet the pages by a join.
BROADCAST_DESCRIPTORS = 100_000
#: Bounds of a word's weight and a tag's cost; a tag inside a labelled region costs the least.
WORD_BOUND, TAG_BOUND, TAG_LEAST = 5.0, 2.0, 0.02

TAG_REST = r"((?>[^>\"']|\"[^\"]*\"|'[^']*')*)>"
#: Tokens of a page, of one whose last xmp was closed before, and of what svg or math hold: no element is raw there.
TOKEN, PLAIN_TOKEN, FOREIGN_TOKEN = (re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({raw})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)|<{xmp}(?=[\s/>])[^>]*>(.*?)</xmp(?=[\s/>])[^>]*>"
    rf"|<(/?)([a-z][^\s/>]*){TAG_REST}|<(/?)([a-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[!?/a-z][^>]*\Z|[^<]+|<", re.S | re.I)
    for raw, xmp in ((RAW, "xmp"), (RAW, "(?!)"), ("(?!)", "xmp")))
PAIRED = re.compile(
    r"<!--.*?--!?>|<(script|style)(?=[\s>])[^>]*(?<!/)>.*?</\1(?=[\s/>])"
    rf"|<(/?)({'|'.join(sorted(UNSHOWN | FOREIGN, reverse=True))})(?=[\s/>]){TAG_REST}", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.S | re.I)


def descriptors(tag: str, attributes: str) -> tuple[str, ...]:
    """Tag, ``tag.class``, ``#id`` and ``@role`` of an element."""
    if not attributes:
        return (tag,)
    return _short_descriptors(tag, attributes) if len(attributes) <= 200 else _descriptors(tag, attributes)


def _descriptors(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "class":
            found += [f"{tag}.{c}" for c in value.split()]
        elif name == "id":
            found.append(f"#{value.strip()}")
            if tag == "article" and is_boilerplate(named := f"article.{value.strip()}"):
                found.append(named)
        elif name == "role":
            found.append(f"@{value.strip()}")
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            found.append("@hidden")
    return tuple(found)


_short_descriptors = lru_cache(20_000)(_descriptors)


@lru_cache(100_000)
def is_boilerplate(descriptor: str) -> bool:
    """Whether the name alone says so."""
    tag, dot, name = descriptor.partition(".")
    if descriptor[0] == "@":
        return descriptor[1:] in BOILERPLATE_ROLES or descriptor == "@hidden"
    if descriptor[0] == "#":
        name = descriptor[1:]
    elif not dot:
        return tag in BOILERPLATE_TAGS or tag in UNSHOWN
    if tag == "article":
        return bool(m := ARTICLE_NAME.fullmatch(name)) and m[1] in ARTICLE_NAMES
    if tag in UNNAMED_TAGS or re.match(r"(with|has|no|without)[-_]", name):
        return False
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    said = [w in BOILERPLATE_NAMES or bool(BOILERPLATE_STEMS.match(w)) for w in words]
    if True not in said:
        return False
    last = len(said) - 1 - said[::-1].index(True)  # English puts what a thing is last
    return all(w in STRUCTURE_NAMES for w in words[last + 1:])


def prior(descriptor: str) -> tuple[float, float]:
    """Pseudo-counts of words inside and outside content."""
    if is_boilerplate(descriptor):
        return 0.0, PRIOR_WORDS
    return (PRIOR_WORDS, 0.0) if descriptor in CONTENT_TAGS else (2.0, 1.0)


def _unclosed(page: str) -> set[int]:
    """Where elements of ``UNSHOWN`` and ``FOREIGN`` open that are never closed."""
    found: dict[str, list[int]] = {}
    for m in PAIRED.finditer(page):
        if m[3]:
            starts = found.setdefault(m[3].lower(), [])
            if not m[2]:
                if not (m[4].endswith("/") and m[3].lower() in FOREIGN):
                    starts.append(m.start())
            elif starts:
                starts.pop()
    return {i for starts in found.values() for i in starts}


def parse(page: str) -> Iterator[tuple[str, object]]:
    """Events of a page: ("text", text), ("tag", name) for every tag, ("open", (name, descriptors)) and ("close", how many).

    Work is in proportion to the page, whatever its depth: elements that are open are counted by name."""
    stack: list[str] = []
    opened: Counter = Counter()
    unclosed = _unclosed(page)
    at, foreign = 0, []  # foreign: places on the stack of svg and math
    last_xmp = page.lower().rfind("</xmp")

    def close(i: int) -> tuple[str, int]:
        n = len(stack) - i
        for t in stack[i:]:
            opened[t] -= 1
        del stack[i:]
        while foreign and foreign[-1] >= len(stack):
            foreign.pop()
        return "close", n

    def place(names) -> int:
        i = len(stack) - 1
        while stack[i] not in names:
            i -= 1
        return i

    while m := (FOREIGN_TOKEN if foreign else TOKEN if at <= last_xmp else PLAIN_TOKEN).match(page, at):
        raw, at = m[0], m.end()
        tag = (m[4] or m[7] or "").lower()
        if raw[0] != "<" or raw == "<":
            yield "text", html.unescape(raw)
        elif m[2] is not None:
            yield "tag", "xmp"
            yield "open", ("xmp", ("xmp",))
            yield "text", m[2]
            yield "close", 1
            yield "tag", "xmp"
        elif not tag:
            continue
        elif m[3] or m[6]:
            if opened[tag]:
                yield close(place((tag,)))
            yield "tag", tag
        else:
            if foreign and tag in BLOCKS and not any(t in EMBEDS_BLOCKS for t in stack[foreign[-1]:]):
                yield close(foreign[-1])
            drop = SIBLINGS.get(tag, CLOSED_BY_BLOCK if tag not in INLINE and tag not in VOID else ())
            if tag == "body":
                drop = {"head"}
            if foreign:
                drop = ()
            while stack and stack[-1] in drop or drop is CLOSED_BY_BLOCK and opened["p"]:
                yield close(place(drop))
            yield "tag", tag
            empty = raw.endswith("/>") and (foreign or tag in FOREIGN) or m.start() in unclosed
            if tag not in VOID and not empty:
                if tag in FOREIGN:
                    foreign.append(len(stack))
                stack.append(tag)
                opened[tag] += 1
                yield "open", (tag, descriptors(tag, m[5] or m[8] or ""))


def _own(element: tuple[str, tuple[str, ...]]) -> list[str]:
    """Descriptors of an element that count; the id of a page's own parts says nothing."""
    tag, found = element
    return [d for d in found if not (tag in UNNAMED_TAGS and d[0] == "#")] if len(found) > 1 else list(found)


def label_of(words: Counter) -> tuple[bool, int] | None:
    """What labels the content of a page, by its words outside named boilerplate in each (within main, number of article).

    The article that has more than half of the words in ``main``, else ``main`` (number 0); without ``main`` the article
    that has more than half of the page's. Articles beside ``main``, or small ones, are teasers or comments.
    """
    inner = {article: n for (main, article), n in words.items() if main}
    held = inner or {article: n for (_, article), n in words.items()}
    for article, n in held.items():
        if article and 2 * n > sum(held.values()):
            return bool(inner), article
    return (True, 0) if inner else None


def _places(events: list[tuple[str, object]]) -> tuple[list[tuple[bool, int]], Counter]:
    """For each text and tag of a parsed page whether it is within ``main`` and in which outermost article (from 1, in order), and
    the words outside named boilerplate by such places."""
    places, words, articles = [], Counter(), 0
    stack = [(False, 0, False)]  # within main, article, within boilerplate
    for kind, value in events:
        if kind == "open":
            main, article, blamed = stack[-1]
            if value[0] == "article" and not article:
                articles += 1
                article = articles
            stack.append((main or value[0] == "main", article, blamed or any(map(is_boilerplate, _own(value)))))
        elif kind == "close":
            del stack[-value:]
        else:
            places.append(stack[-1][:2])
            if kind == "text" and not stack[-1][2] and (n := len(value.split())):
                words[places[-1]] += n
    return places, words


def count_words(page: str) -> Counter:
    """Of a page with a labelled region: words (w) and tags (t) by descriptor, inside (1) and outside (0), and whether it has a
    descriptor that holds words inside (p).

    An element hands its words to its descriptors when it closes, so a word costs nothing for each element it stands in; of
    elements of one descriptor within each other the outermost counts."""
    found: Counter = Counter()
    events = list(parse(page))
    places, words = _places(events)
    label = label_of(words)
    if label is None:
        return found
    within = [main >= label[0] and (article == label[1] or not label[1]) for main, article in places]
    name = "article" if label[1] else "main"
    stack: list[list] = [[(), False, 0, 0, 0]]  # descriptors that aren't open yet, in boilerplate, words inside, outside, of these in boilerplate
    opened: Counter = Counter()
    i = -1

    def close() -> None:
        own, _, inside, outside, blamed = stack.pop()
        for d in own:
            opened[d] -= 1
            if inside:
                found["w", d, 1] += inside
                found["p", d, 1] = 1
            # a word in boilerplate is explained by that alone; plain tags aren't blamed
            if n := blamed if is_boilerplate(d) else outside - blamed if d[0] in "#@" or "." in d else 0:
                found["w", d, 0] += n
        for k, n in ((2, inside), (3, outside), (4, blamed)):
            stack[-1][k] += n

    for kind, value in events:
        if kind == "open":
            all_own = _own(value)
            own = tuple(d for d in dict.fromkeys(all_own) if not opened[d])
            opened.update(own)
            stack.append([own, stack[-1][1] or any(map(is_boilerplate, all_own)), 0, 0, 0])
        elif kind == "close":
            for _ in range(value):
                close()
        else:
            i += 1
            if kind == "tag":
                own = value == name and True in within[max(0, i - 1):i + 2]
                found["t", value, int(within[i] or own)] += 1
            elif n := len(value.split()):
                stack[-1][2 if within[i] else 3] += n
                if not within[i] and stack[-1][1]:
                    stack[-1][4] += n
    while len(stack) > 1:
        close()
    return found


class Weights:
    """Log-odds of content for words by descriptor, and costs of tags."""

    def __init__(self, counts: dict[tuple[str, str, int], float]):
        self.counts = counts
        self._words: dict[str, float] = {}
        self._tags: dict[str, float] = {}

    def word(self, descriptor: str) -> float:
        if descriptor not in self._words:
            a, b = prior(descriptor)
            if not a:  # boilerplate by name
                b *= max(1.0, self.counts.get(("p", descriptor, 1), 0))
            a += self.counts.get(("w", descriptor, 1), 0) + 0.5
            b += self.counts.get(("w", descriptor, 0), 0) + 0.5
            self._words[descriptor] = max(-WORD_BOUND, min(WORD_BOUND, math.log(a / b)))
        return self._words[descriptor]

    def tag(self, tag: str) -> float:
        if tag not in self._tags:
            a = self.counts.get(("t", tag, 1), 0) + (0.5 if tag in BOILERPLATE_TAGS else 5)
            b = self.counts.get(("t", tag, 0), 0) + (5 if tag in BOILERPLATE_TAGS else 0.5)
            self._tags[tag] = -max(TAG_LEAST, min(TAG_BOUND, math.log(b / a)))
        return self._tags[tag]

    def below(self, above: tuple[float, float], element: tuple[str, tuple[str, ...]]) -> tuple[float, float]:
        """Least and greatest weight of an element's and its ancestors' descriptors, from those of its parent."""
        each = [self.word(d) for d in _own(element)]
        return min([above[0], *each]), max([above[1], *each])


#: Least and greatest weight where no element is open.
NOWHERE = (math.inf, -math.inf)


def weight_of(bounds: tuple[float, float]) -> float:
    """Weight of a word: that of the worst boilerplate element it stands in, else of the best other."""
    low, high = bounds
    return low if low < 0 else high if high > -math.inf else 0.5


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the run with the greatest sum; the first and shortest such; empty if no score is positive."""
    best, start, end, total, begin = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        total += s
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best + 1e-9:
            best, start, end = total, begin, i + 1
    return start, end


def extract(page: str, weights: Weights) -> str:
    """The main text of one page."""
    texts: list[str | None] = []  # a text that may be content; None: a block ends; "": neither
    scores: list[float] = []
    stack = [NOWHERE]
    for kind, value in parse(page):
        if kind == "open":
            stack.append(weights.below(stack[-1], value))
        elif kind == "close":
            del stack[-value:]
        elif kind == "tag":
            texts.append("" if value in INLINE else None)
            scores.append(weights.tag(value))
        else:
            weight = weight_of(stack[-1])
            texts.append(value if weight > 0 else "")
            scores.append(weight * len(value.split()) if weight > 0 else 0.0)
    start, end = best_run(scores)
    blocks, block = [], []
    for t in [*texts[start:end], None]:
        if t is None:
            if words := "".join(block).split():
                blocks.append(" ".join(words))
            block = []
        else:
            block.append(t)
    return " ".join(blocks)


def count_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(what, name, n0, n1): words, tags and pages by descriptor, outside and inside, over all pages that label their content."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter = Counter()
            for page in batch["html"]:
                total.update(count_words(page))
            yield pd.DataFrame([(*k, float(n)) for k, n in total.items()], columns=["what", "name", "inside", "n"])

    labelled = pages.select(F.col(html_col).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    return labelled.mapInPandas(count, "what string, name string, inside int, n double").groupBy("what", "name").agg(
        *(F.sum(F.when(F.col("inside") == i, F.col("n")).otherwise(0.0)).alias(f"n{i}") for i in (0, 1)))


def _weights(rows) -> Weights:
    return Weights({(r["what"], r["name"], i): r[f"n{i}"] for r in rows for i in (0, 1)})


def fit_weights(pages: DataFrame, html_col: str = "html") -> Weights:
    """The weights by all pages that label their content; without such a page the prior alone holds. For pages of few
    descriptors: all counts come to the driver (``extract_text`` doesn't need that)."""
    return _weights(count_pages(pages, html_col).collect())


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 weights: Weights | None = None) -> DataFrame:
    """One row for each row of ``pages``: id, url, text, n_chars.

    A null or empty page, or one without content, has an empty text. Of runs with equal scores the first counts.
    Repeated rows are read each; an empty table gives no rows; other columns are left out, whatever their names.

    The counts of ``BROADCAST_DESCRIPTORS`` descriptors, the most frequent ones, go to all tasks. If there are more, each
    page's rarer ones are looked up by a join and come with the page, so every page is read with the same weights.
    """
    rare = None
    if weights is None:
        counts = saved(count_pages(pages, html_col), "html_counts")
        by_name = counts.groupBy("name").agg(F.sum(F.col("n0") + F.col("n1")).alias("n"))
        common = by_name.orderBy(F.desc("n"), "name").limit(BROADCAST_DESCRIPTORS)
        if by_name.count() > BROADCAST_DESCRIPTORS:
            common = saved(common, "html_common")
            rare = counts.join(common.select(F.col("name").alias("_name")), F.col("name") == F.col("_name"), "left_anti")
            counts = counts.join(common.select("name"), "name", "left_semi")
        weights = _weights(counts.collect())  # at most three rows for each of BROADCAST_DESCRIPTORS
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    read = read.withColumn("own", F.lit(None).cast(_OWN)) if rare is None else _with_rare(read, rare, weights)

    def extract_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for page, own in zip(batch["html"], batch["own"], strict=True):
                mine = weights if own is None or not len(own) else Weights(
                    weights.counts | {(r["what"], r["name"], i): r[f"n{i}"] for r in own for i in (0, 1)})
                texts.append(extract(page or "", mine))
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    made = by_row(read, extract_all, "id", "url string, text string, n_chars long", url="url", html="html", own="own")
    return made.withColumnsRenamed({"url": url_col, "id": id_col})


_OWN = "array<struct<what:string,name:string,n0:double,n1:double>>"


def _with_rare(read: DataFrame, rare: DataFrame, weights: Weights) -> DataFrame:
    """``read`` with each page's descriptors (and tags) that the common weights don't hold, and their counts, as ``own``."""
    known = {name for _, name, _ in weights.counts}

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, page in zip(batch["key"], batch["html"], strict=True):
                mine = set()
                for kind, value in parse(page):
                    mine.update(_own(value) if kind == "open" else [value] if kind == "tag" else ())
                rows += [(key, d) for d in mine - known]
            yield pd.DataFrame(rows, columns=["key", "name"])

    keyed = read.withColumn("key", F.sha2(F.coalesce("html", F.lit("")), 256))
    held = keyed.where("html is not null").select("key", "html").mapInPandas(names, "key string, name string").distinct()
    # names that are on few labelled pages; on others they may be frequent, and Spark's skew join splits them
    own = saved(held.join(rare.hint("merge"), "name").groupBy(F.col("key").alias("_key")).agg(
        F.collect_list(F.struct("what", "name", "n0", "n1")).cast(_OWN).alias("own")), "html_own")
    return keyed.join(own.hint("merge"), F.col("key") == F.col("_key"), "left").drop("key", "_key")
