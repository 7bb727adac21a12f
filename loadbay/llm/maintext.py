"""Main text of web pages by a minimum cut.

A page is cut into blocks at block-level tags. A linear classifier over a block's markup and
words gives its cost of being called boilerplate or content; these become its capacities to the
two terminals. Blocks that follow one another, and consecutive blocks under the same container,
are joined by smoothness capacities that fall with their distance in the tree. The minimum cut
labels every block; content blocks, in page order, are the text.

Defined cases: a null or empty page gives an empty text; unclosed and stray tags are tolerated (a
closing tag closes up to its nearest open partner); text outside any tag is a block; a script,
style or comment that never ends takes the rest of the page; repeated rows come back repeated.
Only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from loadbay.llm import tokens as T

# Tag names of HTML.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav"
    " noscript ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# never text, whatever surrounds it
UNSEEN = frozenset("button datalist head iframe noscript object option select svg template textarea title".split())
RAW = re.compile(r"</(?:script|style)\s*>", re.I)
# a new <p>, <li> ... ends an open one of the same group
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"},
                "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
ENDS_P = BLOCK - {"body", "html", "head", "button", "option", "select", "title", "noscript"}
ENDS = {name: SELF_CLOSING.get(name, set()) | ({"p"} if name in ENDS_P else set()) for name in BLOCK}
# a quote holds a value together only after an equals sign; elsewhere it is a character like others
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^<>])*+)>|[^<]+|<", re.S)
NAMES = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
SPACE = re.compile(r"[\s ]+")
# Words of a class, id or role: boilerplate wherever they stand, or outside an article only (its own header, a
# section about privacy); and those that may stand beside them in one name. A name with any other word in it
# (comments-open, binary-search, elementor-widget, related-work) says nothing.
STRONG = re.compile(
    r"ads?|advert\w*|adsense|alert|bottombar|breadcrumbs?|commentlist|comments?|complementary|consent|contentinfo|cookies?|"
    r"disqus|gdpr|menu\w*|nav|navbar|navigation|newsletter|notice|notification|outbrain|pager|pagination|paywall|popup|promo\w*|"
    r"recommend(?:ed|ations?)?|related|replies|respond|share\w*|sharing|shoutbox|sidebar\w*|signup|social\w*|sponsor\w*|"
    r"subscribe|taboola|toolbar|topbar|trending|warningbox")
WEAK = re.compile(
    r"banner|bylinelinks|donate|foot|footer|header|hidden|login|masthead|metabar|modal|overlay|privacy|reply|search\w*|skip|"
    r"subscription|tags|widgets?")
BESIDE = frozenset(
    "1 2 3 4 a all and area article articles back bar block blog body bottom box btn button buttons by byline center col"
    " column container count cta desktop email entry feed fixed follow for form global group holder icons in inline inner"
    " item items js large latest layout left level line link links list main message meta mid middle mini mobile module more my"
    " new of on outer page pane panel policy popular post posts primary region right row section secondary side site slot"
    " small sticky stories story strip sub text the thread title to tool top unit up us user view wrap wrapper zone".split())
GOOD = re.compile(r"(?:^|[^a-z])(?:article\w*|blog-?post|body-?text|content|entry\w*|main\w*|post|post-?body|story\w*|text)(?:$|[^a-z])", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@lru_cache(1 << 14)
def meaning(value: str) -> tuple[bool, bool, bool]:
    """(strong, weak, good) of a class, id or role."""
    strong = weak = False
    for name in value.split():
        words = [w.lower() for w in WORDS.findall(name)]
        whole = "".join(words)
        hits = [bool(STRONG.fullmatch(w)) * 2 or bool(WEAK.fullmatch(w)) for w in (*words, whole)]
        if any(hits) and (hits[-1] or all(h or w in BESIDE for h, w in zip(hits, words))):
            strong |= 2 in hits
            weak |= 2 not in hits
    return strong, weak, bool(GOOD.search(value))


BAD_TAGS = frozenset("nav footer aside form menu dialog fieldset legend".split())
GOOD_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LONG = 12                  # words of a text that a weak name around it inside an article does not drop


class Holder:
    """A block-level element; its ancestors are reached by ``up``, so pages may nest at any depth."""
    __slots__ = ("up", "depth", "tag", "bad", "good", "weak")

    def __init__(self, up, depth, tag, bad, good, weak):
        self.up, self.depth, self.tag, self.bad, self.good, self.weak = up, depth, tag, bad, good, weak


class Block:
    __slots__ = ("text", "linked", "holder")

    def __init__(self, text, linked, holder):
        self.text, self.linked, self.holder = text, linked, holder


def blocks(page: str) -> list[Block]:
    """The page's text blocks with what the classifier looks at."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    # open tags: (name, holder, bad containers, good containers, unseen, weak names inside a good one)
    stack: list[tuple] = [("", Holder(None, 0, "", 0, 0, 0), 0, 0, False, 0)]
    opened: defaultdict[str, int] = defaultdict(int)
    pos, end = 0, len(page)
    in_link = 0

    def flush():
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts)) if any("&" in p for p in parts) else "".join(parts)).strip()
            if text:
                out.append(Block(text, min(1.0, linked / len(text)), stack[-1][1]))
            parts.clear()
        linked = 0

    def close(i: int):
        nonlocal in_link
        for s in stack[i:]:
            opened[s[0]] -= 1
            in_link -= s[0] == "a"
        del stack[i:]

    while pos < end:
        m = TOKEN.match(page, pos)
        pos = m.end()
        name = m.group(2)
        if name is None:
            if not stack[-1][4] and (page[m.start()] != "<" or pos - m.start() == 1):
                parts.append(m.group())
                if in_link:
                    linked += pos - m.start()
            continue
        name = name.lower()
        if m.group(1):                                       # closing
            for i in range(len(stack) - 1 if opened[name] else 0, 0, -1):
                if stack[i][0] == name:
                    if any(s[0] in BLOCK for s in stack[i:]):
                        flush()
                    close(i)
                    break
                if name not in BLOCK and stack[i][0] in BLOCK:
                    break                                    # a stray inline end tag
            continue
        if name in ("script", "style"):
            stop = RAW.search(page, pos)
            pos = stop.end() if stop else end
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br" and not stack[-1][4]:
                parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            ends = ENDS.get(name, ())
            some = any(opened[e] for e in ends)
            for i in range(len(stack) - 1 if some else 0, 0, -1):           # implied ends
                s = stack[i][0]
                if s in ends:
                    close(i)
                elif s in BLOCK:
                    break
        attrs = m.group(3)
        top = stack[-1]
        bad, good, unseen, weak = top[2], top[3], top[4] or name in UNSEEN, top[5]
        inside = good > 0
        if name in BAD_TAGS or name == "header" and not inside:
            bad += 1
        elif name in GOOD_TAGS:
            # comments of readers are often articles themselves
            good += 1 if not bad else 0
        if attrs and ("=" in attrs or "hidden" in attrs):
            for a in NAMES.finditer(attrs):
                key = a.group(1).lower()
                value = a.group(2) or a.group(3) or a.group(4) or ""
                if key == "style":
                    unseen |= "display:none" in value.replace(" ", "").lower()
                elif key == "hidden" or key == "aria-hidden":
                    unseen |= key == "hidden" and not value or value.lower() == "true"
                elif name in ("body", "html"):
                    continue
                elif name not in HEADINGS:
                    is_strong, is_weak, is_good = meaning(value)
                    if is_strong:
                        bad += 1
                    elif is_weak and not (inside or is_good):
                        bad += 1
                    elif is_weak:
                        weak += "header" not in value.lower()   # an article's own header holds its title
                    elif is_good:
                        good += 1
        if name == "a":
            in_link += 1
        if not attrs.rstrip().endswith("/") or name in BLOCK:
            up = top[1]
            holder = Holder(up, up.depth + 1, name, bad, good, weak) if name in BLOCK else up
            stack.append((name, holder, bad, good, unseen, weak))
            opened[name] += 1
        elif name == "a":
            in_link -= 1
    flush()
    return out


def cost(b: Block) -> float:
    """Linear score of a block; positive speaks for content."""
    words, h = b.text.count(" ") + 1, b.holder
    bad = min(h.bad, 2) + (h.weak > 0 and h.tag not in HEADINGS and (words < LONG or b.linked > 0.3))
    return (-1.2 + 0.9 * math.log1p(words) - 5.0 * b.linked - 10.0 * bad + 4.0 * min(h.good, 1)
            + (0.8 if h.tag in ("p", "pre", "blockquote") else 0.0)
            + (0.6 if h.tag in HEADINGS and h.good else 0.0)
            + (0.5 if b.text[-1] in ".!?:\"'”…)" else 0.0))


def _near(a: Holder, b: Holder) -> int:
    """Steps in the tree between two blocks' holders."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        steps += 1
    return steps


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut: maximum flow by shortest
    augmenting paths in levels, from nodes of positive gain to nodes of negative gain."""
    n = len(gain)
    side = [g > 0 for g in gain]
    if all(side[a] == side[b] for a, b, _ in edges):
        return side
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a, b, c, back):
        at[a].append(len(to))
        to.append(b)
        cap.append(c)
        at[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            link(s, i, g, 0.0)
        elif g < 0:
            link(i, t, -g, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for v in queue:
            for e in at[v]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        v = s
        while True:                                          # blocking flow
            if v == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                path, v = [], s
                continue
            while turn[v] < len(at[v]):
                e = at[v][turn[v]]
                if cap[e] > 1e-9 and level[to[e]] == level[v] + 1:
                    break
                turn[v] += 1
            if turn[v] < len(at[v]):
                path.append(at[v][turn[v]])
                v = to[path[-1]]
            elif v == s:
                break
            else:
                turn_from = to[path[-1] ^ 1]
                turn[turn_from] += 1
                path.pop()
                v = turn_from


def label(found: list[Block]) -> list[bool]:
    gain = [cost(b) for b in found]
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, 1.6 / (1 + _near(found[i - 1].holder, b.holder))))
        parent = id(b.holder.up or b.holder)
        before = last.get(parent)
        if before is not None and before < i - 1:
            edges.append((before, i, 0.6))
        last[parent] = i
    return min_cut(gain, edges)


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n\n".join(b.text for b, keep in zip(found, label(found)) if keep) if found else ""


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches, "html"):
        text = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
             pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars."""
    rows = pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", "url", "html")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
