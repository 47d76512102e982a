"""HTML extraction by minimum-cut labelling.

A page is split into blocks: runs of text between the tags that begin or end a block. A linear classifier of a block's own text
(its tag, length, share of link text, whether it ends a sentence) gives a log-odds of being content, bounded on both sides: the capacity
of its edge to one of the two terminals. The elements that hold blocks are nodes too. One that says what it is has an edge to a
terminal, with a capacity for each block that it holds (`article` and `main`: for each below them, however deep): `article` and `main` are for content, the tags of menus, footers,
sidebars, forms and site headers against it, and words in class, id and role for or against it in proportion to how plainly they say so. Inside an
article a word that prose has, too (`legal`, `share`, `form`), or one that is not the last of its name, is weak evidence, which the block's own text and its article outweigh.
Blocks are tied to their element, elements to the element around them, and blocks to their neighbours in the page: these are the smoothness
edges. The minimum cut, found as a maximum flow, separates content from boilerplate; so a short or much linked paragraph stays
with the article around it, a heading goes with its paragraphs, and an advert in an article goes although its text reads like one.
Content blocks are joined in page order by an empty line.

The classifier's weights are fitted by logistic regression, around those given, on the blocks of at most `Costs.max_pages` pages (by a
hash of the page) whose elements say plainly which they are (`article`, `main` against `nav`, `footer`, `aside`, `form`).

Defined results: a null or empty page, and one without content, give an empty text; an empty table gives an empty result; repeated
rows are extracted alike; broken markup is read as browsers do in the common cases (unclosed paragraphs, stray end tags, an
unclosed script hides the rest); very long pages are read whole, in time in proportion to their length, and elements count however deep they are; of more than
`Costs.silent` elements in a row that say nothing, the inner ones are one. A row is worked on by itself, so memory is bounded by the longest page beside an Arrow batch.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fields, table, text_of

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(script|style|template|iframe|textarea|select|title)\b(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^'\">])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr picture source "
    "math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt svg g text tspan object canvas".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section div nav aside footer header main form body html blockquote td th".split())
#: Elements whose texts are blocks of what is around them.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre figcaption caption summary tbody thead ul ol dl table blockquote".split())
#: Tags that are never part of a main text; a header is one outside an article.
APART = frozenset("nav aside footer form button menu dialog head noscript".split())
#: Words in class, id or role, for what is apart from a main text, for readers' comments and the like, and for the main text.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login search menu navbar nav navigation breadcrumb "
    "breadcrumbs sidebar aside footer header masthead toolbar pagination pager share sharing social widget copyright legal complementary contentinfo form".split()
)
#: Of those, words that articles have for their own parts.
PROSE_WORDS = frozenset("legal share sharing form search notice alert banner header copyright social widget login menu complementary promotion toolbar discussion related recommended respond".split())
#: Of those, words that nothing else is called.
AD_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo newsletter".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus discussion related recommended".split())
MAIN_WORDS = frozenset("article main content post story entry body text".split())
#: Names that begin with, or hold, the first tell of a layout, names that end in the second of a state; the third say nothing.
LAYOUT = frozenset("has no not with without is show hide".split())
STATES = frozenset("enabled disabled open closed active visible".split())
NEUTRAL = frozenset("left right top bottom layout container wrapper inner outer box page block area main".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class Costs:
    """Weights in units of a log-odds. text: of the classifier's features (FEATURES). clip: bound of a block's own cost. hard, plain, weak, main: of an element's tag, of the words of its names, of such words as articles use, of a main element, for each block in it.
    tied: of a block to an element that says what it is, and of such elements to one another; loose: to one that does not. neighbour: of blocks side by side. firmness: of the given weights against the fitted."""

    text: tuple[float, ...] = (-1.5, 1.0, 0.8, -0.5, 1.2, -3.0, 0.8)
    clip: float = 2.5
    hard: float = -8.0
    plain: float = -8.0
    main: float = 4.0
    named_main: float = 1.5
    weak: float = -1.5
    tied: float = 3.5
    loose: float = 0.8
    neighbour: float = 0.4
    silent: int = 8
    max_pages: int = 2_000
    firmness: float = 20.0


#: Of a block: a constant, whether it is a paragraph, a heading, a list item, its hundreds of characters up to two, share of characters in links, whether it ends a sentence.
FEATURES = ("bias", "paragraph", "heading", "listed", "long", "links", "sentence")


@dataclass
class Block:
    text: str
    holder: int  # number of the element that holds it; 0 for none
    features: tuple[float, ...]


@dataclass
class Holder:
    """An element: the number of the one around it, what it says for each of its blocks (above zero: content), and how many in a row, this one included, say nothing."""

    around: int
    says: float
    silent: int = 0


def says(tag: str, attributes: str, held_by: str, costs: Costs) -> tuple[float, str]:
    """What an element's tag and names say, and as what its inside is seen: main, comments, apart or nothing. held_by: as what the element around it is seen."""
    if tag in APART:
        return costs.hard, "apart" if tag != "form" else held_by
    if tag in ("html", "body"):
        return 0.0, held_by
    names = ["".join(n) for n in NAMED.findall(attributes)] if attributes else []
    apart = main = comments = weak = 0.0
    for name in " ".join(names).split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[-1] in STATES or not LAYOUT.isdisjoint(words):
            continue
        words = [w for w in words if w not in NEUTRAL] or words
        share = 1.0 if words[-1] in APART_WORDS or len(words) == 1 else 0.5  # the last word of a name is what it names
        found = set(words) & (APART_WORDS | COMMENT_WORDS)
        if held_by == "main" and found and (found <= PROSE_WORDS or words[-1] not in found and found.isdisjoint(AD_WORDS)):
            weak = max(weak, 1.0)
        elif found & COMMENT_WORDS:
            comments = 1.0
        elif found:
            apart = max(apart, share)
        elif set(words) & MAIN_WORDS:
            main = 1.0
    if comments:
        return costs.plain, "comments"
    if tag in ("article", "main") or "main" in names:
        return (costs.main, "main") if held_by in ("", "main") else (0.0, held_by)
    if attributes and HIDDEN.search(attributes):
        return costs.plain, "apart"
    if tag == "header" and held_by != "main":
        return costs.hard, "apart"
    if apart:
        return costs.plain * apart, "apart" if apart == 1.0 else held_by
    if weak:
        return costs.weak, held_by
    return (costs.named_main if main and not held_by else 0.0), held_by


def blocks(page: str, costs: Costs = Costs()) -> tuple[list[Block], list[Holder]]:
    found: list[Block] = []
    holders = [Holder(0, 0.0)]
    # open elements: tag, number of the holder, as what it is seen, number in the stack of the nearest element that is not inline
    stack: list[tuple[str, int, str, int]] = [("", 0, "", 0)]
    places: dict[str, list[int]] = {}  # of each open tag in the stack
    scopes: list[int] = [0]
    pieces: list[str] = []
    linked, links = 0, 0

    def end() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                tag, holder, _, _ = stack[stack[-1][3]]
                heading = tag[:1] == "h" and tag[1:].isdigit()
                features = (1.0, float(tag in ("p", "pre", "blockquote")), float(heading), float(tag == "li"), min(len(text) / 100, 2.0), min(1.0, linked / len(text)), float(text[-1] in ".!?…\"”»"))
                found.append(Block(text, holder, features))
        pieces.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal links
        while len(stack) > to:
            tag = stack.pop()[0]
            links -= tag == "a"
            places[tag].pop()
        while scopes[-1] >= to:
            scopes.pop()

    def open_(tag: str, holder: int, seen: str, block: bool) -> None:
        places.setdefault(tag, []).append(len(stack))
        if tag in SCOPES:
            scopes.append(len(stack))
        stack.append((tag, holder, seen, len(stack) if block else stack[-1][3]))

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            pieces.append(page[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        if not (tag := (m[3] or "").lower()):
            continue
        last = places[tag][-1] if places.get(tag) else 0
        if tag in INLINE:
            if tag in VOID:
                pieces.append(" " if tag == "br" else "")
            elif m[2]:
                if last > scopes[-1]:
                    close(last)
            else:
                open_(tag, stack[-1][1], stack[-1][2], False)
                links += tag == "a"
            continue
        end()
        if m[2]:
            if last and (tag in SCOPES or last > scopes[-1]):
                close(last)
            continue
        ended = CLOSES.get(tag, ("p",) if tag in SCOPES or tag[:1] == "h" else ())
        if (last := max((places[x][-1] for x in ended if places.get(x)), default=0)) and last >= scopes[-1]:  # an element that this one ends
            close(last)
        if tag in VOID:
            continue
        _, holder, seen, _ = stack[-1]
        z, seen = says(tag, m[4], seen, costs)
        # inside an element that says what it is, those that say nothing are part of it
        if z or (tag not in LEAVES and tag not in ("html", "body") and not holders[holder].says and holders[holder].silent < costs.silent):
            holders.append(Holder(holder, z, 0 if z else holders[holder].silent + 1))
            holder = len(holders) - 1
        open_(tag, holder, seen, True)
    pieces.append(page[at:])
    end()
    return found, holders


def max_flow(n: int, edges: list[tuple[int, int, float, float]]) -> list[bool]:
    """Whether each of the nodes is on the side of node 0 in the minimum cut from node 0 to node 1. edges: nodes and the capacity in both directions. Levels by breadth, then augmenting paths (Dinic)."""
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, there, back in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += (b, a)
        room += (there, back)
    while True:
        level = [-1] * n
        level[0] = 0
        queue = deque([0])
        while queue:
            for e in out[a := queue.popleft()]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[1] < 0:
            return [x >= 0 for x in level]
        place, path, a = [0] * n, [], 0
        while True:
            if a == 1:
                least = min(room[e] for e in path)
                first = len(path)
                for i, e in enumerate(path):
                    room[e] -= least
                    room[e ^ 1] += least
                    if room[e] <= 1e-9:
                        first = min(first, i)
                a = to[path[first] ^ 1]  # go on before the first edge that is full
                del path[first:]
                continue
            while place[a] < len(out[a]):
                e = out[a][place[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            else:
                if not path:
                    break
                a = to[path.pop() ^ 1]
                place[a] += 1
                continue
            path.append(e)
            a = to[e]


def own_costs(found: list[Block], costs: Costs) -> list[float]:
    """What the blocks' own texts say."""
    return [max(-costs.clip, min(costs.clip, sum(w * x for w, x in zip(costs.text, b.features, strict=True)))) for b in found]


def graph(found: list[Block], holders: list[Holder], costs: Costs) -> tuple[int, list[tuple[int, int, float, float]]]:
    """Number of nodes and edges: 0 and 1 are the terminals, then come the blocks, then the elements that hold some."""
    number: dict[int, int] = {}
    held = Counter(b.holder for b in found)
    below, edges = Counter(held), []
    for h in range(len(holders) - 1, 0, -1):  # an element comes after the one around it
        below[holders[h].around] += below[h]
    for h in held:
        while h and h not in number:
            number[h] = 2 + len(found) + len(number)
            h = holders[h].around
    for i, (b, z) in enumerate(zip(found, own_costs(found, costs), strict=True)):
        edges.append((0, i + 2, z, 0.0) if z > 0 else (i + 2, 1, -z, 0.0))
        if i and costs.neighbour:
            edges.append((i + 1, i + 2, costs.neighbour, costs.neighbour))
        if b.holder and (tie := costs.tied if holders[b.holder].says else costs.loose):
            edges.append((i + 2, number[b.holder], tie, tie))
    for h, node in number.items():
        z, around = holders[h].says * (below if holders[h].says == costs.main else held)[h], holders[h].around
        if z:
            edges.append((0, node, z, 0.0) if z > 0 else (node, 1, -z, 0.0))
        if around and (tie := costs.tied if holders[h].says and holders[around].says else costs.loose):
            edges.append((node, number[around], tie, tie))
    return 2 + len(found) + len(number), edges


def content(found: list[Block], holders: list[Holder], costs: Costs = Costs()) -> list[bool]:
    n, edges = graph(found, holders, costs)
    return max_flow(n, edges)[2 : 2 + len(found)]


def extract(page: str, costs: Costs = Costs()) -> tuple[str, int]:
    """The main text, and how many of the page's blocks the cut labels unlike their own text."""
    found, holders = blocks(page, costs)
    keep = content(found, holders, costs)
    return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k), sum((z > 0) != k for z, k in zip(own_costs(found, costs), keep, strict=True))


def examples(page: str, costs: Costs) -> list[tuple[tuple[float, ...], int]]:
    """Features of the blocks whose element says plainly what it is; lengths and shares to a tenth."""
    found, holders = blocks(page, costs)
    return [(tuple(round(x, 1) for x in b.features), int(z > 0)) for b in found if (z := holders[b.holder].says) in (costs.main, costs.hard)]


def fitted(pages: DataFrame, html_column: str = "html", costs: Costs = Costs()) -> Costs:
    """costs with the classifier's weights fitted on a bounded number of pages."""
    share = min(1.0, costs.max_pages / max(1, pages.count()))
    page = text_of(F.col(f"`{html_column}`"))
    some = pages.where(F.pmod(F.xxhash64(page), F.lit(1_000_000)) < int(share * 1_000_000)).select(page.alias("page"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for x in batch["page"]:
                seen.update(examples(x, costs))
        yield pd.DataFrame([(",".join(map(str, x)), y, n) for (x, y), n in seen.items()], columns=["x", "y", "n"])

    # features lie on a grid, so what comes to the driver is bounded by it
    rows = some.mapInPandas(count, fields("x string, y long, n long")).groupBy("x", "y").agg(F.sum("n").alias("n")).collect()
    if not {r.y for r in rows} == {0, 1}:
        return costs
    x, y, n = np.array([[float(v) for v in r.x.split(",")] for r in rows]), np.array([r.y for r in rows], float), np.array([r.n for r in rows], float)
    n = n * (y / (n * y).sum() + (1 - y) / (n * (1 - y)).sum()) * n.sum() / 2  # both kinds weigh the same
    prior = np.array(costs.text)
    w, firm = prior.copy(), costs.firmness * n.sum() / 1000
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope, bend = x.T @ (n * (y - p)) - firm * (w - prior), (x * (n * p * (1 - p))[:, None]).T @ x + firm * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return replace(costs, text=tuple(round(float(v), 6) for v in w))


def main_text(page: Column, costs: Costs = Costs()) -> Column:
    """text, and flipped: the blocks that the cut labels unlike their own text."""

    @F.pandas_udf(fields("text string, flipped long"))
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in batches:
            yield pd.DataFrame([extract(x, costs) for x in pages], columns=["text", "flipped"])

    return extracted(page)


def op9_mincut_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = pages.select("page_id", "url", main_text(text_of("html"), fitted(pages)).alias("m"))
    return found.select("page_id", "url", "m.text", F.length("m.text").cast("long").alias("n_chars"), "m.flipped")
