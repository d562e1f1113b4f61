"""Main text of web pages by minimum-cut labelling (operator 5).

A page is cut into blocks of text. A linear classifier gives each block its
log-odds of being content, from its own text (length, links, sentence marks),
its element, the elements around it and the words of their class and id names.
The log-odds become capacities to the two terminals; neighbours on the page,
and successive blocks of one parent, are tied by smoothness edges that weaken
with their distance in the tree. The minimum cut, found by maximum flow, is
the labelling of least total cost.

Fit. Nothing in a page tells its true labels, so classifier and cut are fitted
in turns, as in iterated graph cuts: the cut labels the blocks of a bounded
sample of pages (``SAMPLE_PAGES`` of at most ``SAMPLE_CHARS`` characters: of
the distinct pages those of the least hashes, so neither copies nor the order
of rows matter), a logistic regression learns from these labels, and the next
cut uses it. Its
prior means are ``PRIOR``: the meaning that HTML gives to its elements, and
usual class names. Any other class word starts at nothing and gets its weight
from the sample.

Cases: a null or empty page gives an empty text; what is not markup is text;
unclosed and stray tags are tolerated, and quotes matter only after an equals
sign; a tag that never ends takes the rest of the page, as in browsers; a page
of any length is read whole, in time proportional to it; where the two sides
cost the same a block is boilerplate; repeated rows have equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_pass, table, text_of

#: Tie of neighbours with one parent, in units of log-odds; halved for each further step in the tree.
SMOOTH = 2.0
SCALE = 1000
#: Log-odds are kept within these bounds, so that ties can still matter.
BOUND = 8.0
#: The sample of the fit, the turns of cut and regression, and the precision of the prior.
SAMPLE_PAGES = 512
SAMPLE_CHARS = 200_000
TURNS = 2
PRECISION = 5.0
#: Blocks of the sample that name a class word before it is a feature, and features at most.
WORD_BLOCKS = 8
MOST_WORDS = 256

_RAW = frozenset("script style noscript template textarea title svg iframe".split())
#: An equals sign may be followed by a quoted value; any other quote is a character like others.
_TAG = re.compile(r"<(?:(!--)|([!?]|/(?![a-zA-Z]))|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(>|\Z))", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in _RAW}
_NAMED = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[a-z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary"
    " table tbody td tfoot th thead tr ul".split()
)
#: An opening tag of these ends an open one of the same group.
_ENDS = {"p": "p", "li": "li", "dt": "d", "dd": "d", "td": "c", "th": "c", "tr": "r", "option": "o"}
_BAD_TAGS = frozenset("head nav footer aside form button select menu dialog fieldset legend option".split())
_GOOD_TAGS = frozenset("article main".split())
_WALLS = frozenset("article main body".split())
_BAD_WORDS = (
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner sidebar comment comments respond"
    " reply replies disqus notice notices cookie cookies consent alert popup modal overlay newsletter subscribe signup"
    " login share sharing social related recommended recommendations menu nav navbar navigation breadcrumb breadcrumbs"
    " pagination pager footer masthead toolbar widget search form copyright legal disclaimer tags complementary"
    " contentinfo hidden".split()
)
_GOOD_WORDS = "article content main post entry story body text page".split()
#: Prior means of the weights.
PRIOR = {
    "bias": -1.0, "density": -4.0, "length": 1.0, "sentences": 0.5, "plain": -0.8,
    "is:text": 1.0, "is:heading": 0.8, "is:cell": -1.0, "is:other": -0.4,
    "in:good": 4.5, "in:bad": -6.0, "in:both": -3.0,
} | {f"word:{w}": -6.0 for w in _BAD_WORDS} | {f"word:{w}": 1.5 for w in _GOOD_WORDS}
_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


class Block:
    __slots__ = ("apart", "depth", "good", "bad", "index", "links", "parent", "spans", "tag", "text")

    @property
    def words(self) -> frozenset[str]:
        """The words of the class and id names of all elements around it."""
        return frozenset(w for w, a, b in self.spans if a <= self.index < b)


def _words(attributes: str) -> frozenset[str]:
    out: set[str] = set()
    for m in _NAMED.finditer(attributes):
        out.update(_PART.findall((m[2] or m[3] or m[4] or "").lower()))
    if _HIDDEN.search(attributes):
        out.add("hidden")
    return frozenset(out)


_NONE: frozenset[str] = frozenset()


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in its order."""
    return parsed(page)[0]


def parsed(page: str) -> tuple[list[Block], list[tuple[str, int, int]]]:
    """The text blocks of a page, and the class words as (word, a, b): around the blocks [a, b).

    The spans of one word don't overlap, and each begins with a word of the page; a set of words for each block would
    take the square of the page's length.
    """
    out: list[Block] = []
    spans: list[tuple[str, int, int]] = []
    around: dict[str, list[int]] = {}  # of an open word: in how many elements, and the block that it begins before
    # Open elements: tag, number, own words, within content and boilerplate elements, block depth.
    stack: list[tuple[str, int, frozenset[str], bool, bool, int]] = [("", 0, _NONE, False, False, 0)]
    opened: dict[str, list[int]] = {}  # where in the stack each tag is open
    solid = [0]  # where its block elements are
    walls = [0]
    number = 1
    text: list[str] = []
    links = 0
    in_link = 0
    lowest = 0  # the least block depth since the last block of text

    def flush() -> None:
        nonlocal links, lowest
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                b = Block()
                own = stack[solid[-1]]
                b.text, b.links, b.tag, b.depth = joined, links, own[0], own[5]
                b.parent = stack[solid[-2]][1] if own[0] == "p" and len(solid) > 1 else own[1]
                b.good, b.bad = stack[-1][3:5]
                b.index, b.spans = len(out), spans
                b.apart = (out[-1].depth - lowest) + (b.depth - lowest) if out else 0
                lowest = b.depth
                out.append(b)
            text.clear()
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        if raw:
            s = html.unescape(raw)
            text.append(s)
            if in_link:
                links += len(s.strip())

    def cut(k: int) -> None:
        nonlocal lowest
        while len(stack) > k:
            tag, _, words, *_ = stack.pop()
            for w in words:
                around[w][0] -= 1
                if not around[w][0] and (begun := around.pop(w)[1]) < len(out):
                    spans.append((w, begun, len(out)))
            opened[tag].pop()
            if solid[-1] == len(stack):
                solid.pop()
            if walls[-1] == len(stack):
                walls.pop()
        lowest = min(lowest, stack[solid[-1]][5])

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        add(page[at : m.start()])
        at = m.end()
        if m[1]:
            end = page.find("-->", m.start() + 2)
            at = len(page) if end < 0 else end + 3
            continue
        if m[2]:
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
            continue
        if not m[6]:
            break  # a tag that never ends
        tag = m[4].lower()
        if tag in _RAW and not m[3]:
            end_ = _RAW_END[tag].search(page, at)
            at = len(page) if end_ is None else end_.end()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if tag in _VOID:
            continue
        if m[3]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            k = opened[tag][-1] if opened.get(tag) else 0
            if k and (k >= walls[-1] or tag in ("body", "html")):
                cut(k)
            continue
        if tag in _BLOCK:
            # An open paragraph ends at any block, with the inline elements that it left open.
            own, group = stack[solid[-1]][0], _ENDS.get(tag)
            if own == "p" or group and _ENDS.get(own) == group:
                cut(solid[-1])
            in_link = 0
        if tag == "a":
            in_link += 1
        good, bad, depth = stack[-1][3:]
        good = good or tag in _GOOD_TAGS
        bad = bad or tag in _BAD_TAGS or tag == "header" and not good
        if not m[5].rstrip().endswith("/"):
            k = len(stack)
            opened.setdefault(tag, []).append(k)
            if tag in _BLOCK:
                solid.append(k)
                depth += 1
            if tag in _WALLS:
                walls.append(k)
            words = _words(m[5]) if m[5] else _NONE
            for w in words:
                around.setdefault(w, [0, len(out)])[0] += 1
            stack.append((tag, number, words, good, bad, depth))
            number += 1
    else:
        add(page[at:])
    flush()
    spans += [(w, begun, len(out)) for w, (_, begun) in around.items() if begun < len(out)]
    return out, spans


def features(b: Block) -> list[tuple[str, float]]:
    """What the classifier sees of a block: names and values, its class words included."""
    return own_features(b) + [(f"word:{w}", 1.0) for w in sorted(b.words)]


def own_features(b: Block) -> list[tuple[str, float]]:
    """The same without class words."""
    n = len(b.text)
    density = min(1.0, b.links / n)
    sentences = len(_SENTENCE.findall(b.text))
    if b.tag in ("p", "blockquote", "pre"):
        kind = "is:text"
    elif b.tag[:1] == "h" and b.tag[1:].isdigit():
        kind = "is:heading"
    else:
        kind = "is:cell" if b.tag in ("li", "td", "th") else "is:other"
    out = [("bias", 1.0), ("density", density), ("length", min(2.5, n / 80) * (1 - density)), ("sentences", float(min(3, sentences))), (kind, 1.0)]
    if not sentences:
        out.append(("plain", 1.0))
    if b.good:
        out.append(("in:good", 1.0))
    if b.bad:
        out.append(("in:both" if b.good else "in:bad", 1.0))
    return out


def log_odds(found: list[tuple[str, float]], weights: dict[str, float]) -> float:
    """Of content against boilerplate; of several class words for one side the strongest counts."""
    total, high, low = 0.0, 0.0, 0.0
    for name, value in found:
        w = weights.get(name, 0.0)
        if name.startswith("word:"):
            high, low = max(high, w), min(low, w)
        else:
            total += w * value
    return max(-BOUND, min(BOUND, total + high + low))


def page_odds(own: list[list[tuple[str, float]]], spans: list[tuple[str, int, int]], weights: dict[str, float]) -> np.ndarray:
    """``log_odds`` of all blocks of a page, from their own features and the spans of class words."""
    total = np.array([sum(weights.get(name, 0.0) * value for name, value in x) for x in own])
    high, low = np.zeros(len(own)), np.zeros(len(own))
    for word, a, b in spans:
        w = weights.get(f"word:{word}", 0.0)
        if w > 0:
            np.maximum(high[a:b], w, out=high[a:b])
        elif w < 0:
            np.minimum(low[a:b], w, out=low[a:b])
    return np.clip(total + high + low, -BOUND, BOUND)


def edges(own: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness between neighbours, and between successive blocks of one parent."""
    out = []
    last: dict[int, int] = {}
    for i, b in enumerate(own):
        if i:
            out.append((i - 1, i, SMOOTH * 0.5 ** min(60, max(0, b.apart - 2))))
        j = last.get(b.parent)
        if j is not None and j < i - 1:
            out.append((j, i, SMOOTH * 0.5))
        last[b.parent] = i
    return out


def minimum_cut(terminal: list[tuple[float, float]], ties: list[tuple[int, int, float]]) -> list[bool]:
    """For each node, is it on the source's side? terminal: capacities from the source and to the sink."""
    n = len(terminal)
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def tie(a: int, b: int, x: int, y: int) -> None:
        at[a].append(len(to))
        to.append(b)
        cap.append(x)
        at[b].append(len(to))
        to.append(a)
        cap.append(y)

    for i, (s, t) in enumerate(terminal):
        # What flows straight through a node needs no search.
        d = round((s - t) * SCALE)
        if d > 0:
            tie(source, i, d, 0)
        elif d < 0:
            tie(i, sink, -d, 0)
    for a, b, w in ties:
        x = round(w * SCALE)
        if x:
            tie(a, b, x, x)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in at[a]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                x = min(cap[e] for e in path)
                cut = 0
                for k, e in enumerate(path):
                    cap[e] -= x
                    cap[e ^ 1] += x
                    if not cap[e] and not cut:
                        cut = k + 1
                del path[cut - 1 :]
                a = to[path[-1]] if path else source
                continue
            while turn[a] < len(at[a]):
                e = at[a][turn[a]]
                if cap[e] and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(at[a]):
                path.append(at[a][turn[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1


def labelled(own: list[list[tuple[str, float]]], ties: list[tuple[int, int, float]], weights: dict[str, float]) -> list[bool]:
    """Which blocks, known by their features, the minimum cut calls content."""
    return cut_of([log_odds(x, weights) for x in own], ties)


def cut_of(odds: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    return minimum_cut([(max(x, 0.0), max(-x, 0.0)) for x in odds], ties)


def _often(words: Counter) -> list[str]:
    """The names of the most blocks, ties by name."""
    return [n for n, k in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:MOST_WORDS] if k >= WORD_BLOCKS]


def regression(rows: list[list[tuple[str, float]]], labels: list[bool]) -> dict[str, float]:
    """Logistic regression of the labels, with means PRIOR and the precision PRECISION."""
    names = sorted({n for r in rows for n, _ in r if not n.startswith("word:")} | {n for r in rows for n, _ in r if n in PRIOR})
    words = Counter(n for r in rows for n, _ in r if n not in PRIOR and n.startswith("word:"))
    names += sorted(_often(words))
    at = {n: i for i, n in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, r in enumerate(rows):
        for n, v in r:
            if n in at:
                x[i, at[n]] = v
    y = np.array(labels, float)
    mean = np.array([PRIOR.get(n, 0.0) for n in names])
    w = mean.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - PRECISION * (w - mean)
        bend = (x * (p * (1 - p))[:, None]).T @ x + PRECISION * np.eye(len(names))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return dict(PRIOR) | {n: float(v) for n, v in zip(names, w, strict=True)}


def fit(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """The weights that a bounded sample of pages gives; the prior where there are none."""
    own = pages.select(text_of(html_col).alias("html")).filter(F.length("html") <= SAMPLE_CHARS)
    own = own.withColumn("h", F.xxhash64("html", F.lit(5)))
    # The distinct pages of the least hashes, whatever the order of the rows and however often each is there.
    least = [r.h for r in own.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]
    if not least:
        return dict(PRIOR)
    sample = own.filter(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html")).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page in batch.column(0).to_pylist():
                found, spans = parsed(page)
                out.append(json.dumps([[own_features(b) for b in found], sorted(spans), edges(found)]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["page"])

    # At most SAMPLE_PAGES pages of SAMPLE_CHARS characters, without their texts. In an order of their own.
    known = [json.loads(x) for x in sorted(r.page for r in arrow_pass(sample, run, "page string").collect())]
    counts: Counter = Counter()
    for _, spans, _ in known:
        for w, a, b in spans:
            counts[f"word:{w}"] += b - a
    wanted = {n for n in PRIOR if n in counts} | set(_often(Counter({n: k for n, k in counts.items() if n not in PRIOR})))
    rows: list[list[tuple[str, float]]] = []
    for own_, spans, _ in known:
        made = [[(n, v) for n, v in b] for b in own_]
        for w, a, b in spans:
            if f"word:{w}" in wanted:
                for x in made[a:b]:
                    x.append((f"word:{w}", 1.0))
        rows += made
    weights = dict(PRIOR)
    for _ in range(TURNS if rows else 0):
        labels = [keep for own_, spans, ties in known for keep in cut_of(page_odds(own_, spans, weights).tolist(), ties)]
        weights = regression(rows, labels)
    return weights


def main_text(page: str, weights: dict[str, float] = PRIOR) -> str:
    own, spans = parsed(page)
    content = cut_of(page_odds([own_features(b) for b in own], spans, weights).tolist(), edges(own)) if own else []
    return "\n".join(b.text for b, keep in zip(own, content, strict=True) if keep)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of keep, text and n_chars of every page."""
    weights = fit(pages, html_col)
    narrow = pages.select(text_of(html_col).alias("__html"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py(), weights) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], [*keep, "text", "n_chars"]
            )

    kinds = dict(narrow.dtypes)
    return arrow_pass(narrow, run, "".join(f"`{c}` {kinds[c]}, " for c in keep) + "text string, n_chars long")


def op5_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
