"""HTML main text by minimum-cut labelling.

A page falls into text blocks (runs of text between block-level tags). Each
block is a node between two terminals, content and boilerplate: a linear
classifier on tags, class and id words, roles, link share and length gives the
costs of either label, which become the terminal capacities. A class or id counts
by its whole names, and a name that speaks of boilerplate is void on a container that
holds most of the page's text while no other part is named content. Blocks that are
neighbours on the page, and blocks that follow each other within one DOM
container, are joined by smoothness edges whose capacity falls with their
distance in the tree. The maximum flow separates content from boilerplate; the
content blocks are the text.

Scripts, styles and other raw elements, comments, hidden elements and markup
are no text. Character references are decoded, white space inside a block is
one space, blocks are joined by one newline; a ``<br>`` is white space. Null,
empty and text-free pages give an empty string; broken markup is read as
browsers do (unclosed tags end with their parents, a tag cut off by the end of
the page is dropped). Repeated rows are extracted one by one.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import textops as t

# --- fixed values: names of HTML elements and common names of page parts ---
RAW = frozenset("script style title textarea template noscript iframe noembed noframes xmp object svg math canvas audio video select datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html label legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
BAD_TAGS = frozenset("nav footer aside form menu button dialog head fieldset label legend search".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion reactions reviews".split())
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion promoted menu nav navbar navigation navi header masthead topbar footer "
    "bottom sidebar aside rail widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup signin login register "
    "share sharing social follow related recommended recommendations similar trending popular breadcrumb breadcrumbs crumbs pagination pager pages toolbar search searchform form copyright legal "
    "terms disclaimer skip sitemap tags tagcloud byline meta author secondary colophon".split()
)
STATE_WORDS = frozenset("has have with without no not is are show hide hidden layout template single".split())
GOOD_WORDS = frozenset("article articlebody content maincontent body post entry story text main prose".split())
CLOSED_BY = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "thead": "p", "tbody": "thead tr td th"}
SCOPE = frozenset("ul ol dl table body html article section div main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[a-zA-Z/][^>]*\Z",
    re.S,
)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HARD = 10_000


class Element:
    """An open element. ``word``: what its class or id says (SOFT or HARD boilerplate); ``marked``: the nearest
    element with such a word, itself included; ``outer``: the next one above that element."""

    __slots__ = ("name", "parent", "depth", "bad", "good", "link", "word", "marked", "outer", "hard")

    def __init__(self, name: str, parent: Element | None):
        self.name, self.parent, self.word, self.outer = name, parent, 0, None
        if parent is None:
            self.depth, self.bad, self.good, self.link, self.marked, self.hard = 0, False, 0, False, None, False
        else:
            self.depth, self.bad, self.good, self.link = parent.depth + 1, parent.bad, parent.good, parent.link or name == "a"
            self.marked, self.hard = parent.marked, parent.hard


SOFT, HARD = 1, 2


def _word_mark(name: str, value: str) -> tuple[int, bool]:
    """What the names in a class or id say: a mark (or 0), and whether they name content.

    A name that tells a state of the page (has-sidebar, no-menu) says nothing; one
    that ends in a word for content names content, whatever it begins with. For an
    article or main element only whole comment words count.
    """
    mark, good = 0, False
    for part in value.split():
        words = [w.lower() for w in _WORD.findall(part)]
        if not words or (words[0] in STATE_WORDS and len(words) > 1):
            continue
        if words[-1] in GOOD_WORDS:
            good = True
        elif name in ("article", "main"):
            mark = HARD if words[0] in COMMENT_WORDS and (len(words) == 1 or words[0].startswith("comment")) else mark
        elif COMMENT_WORDS.intersection(words):
            mark = HARD
        elif BAD_WORDS.intersection(words):
            mark = mark or SOFT
        elif GOOD_WORDS.intersection(words):
            good = True
    return mark, good


def _judge(e: Element, attrs: str) -> None:
    """What an element's name and attributes say about the text in it."""
    name = e.name
    if name in BAD_TAGS or (name == "header" and not e.good):
        e.bad = True
    if name in ("article", "main"):
        e.good = 4
        while e.marked is not None and e.marked.word == SOFT:
            e.marked = e.marked.outer
    if not attrs or name in ("html", "body"):
        return
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "role":
            if value.lower() in BAD_ROLES:
                e.bad = True
            elif value.lower() in ("main", "article"):
                e.good = 4
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
            e.bad = True
        elif key in ("class", "id"):
            mark, good = _word_mark(name, value)
            if mark > e.word:
                if not e.word:
                    e.outer, e.marked = e.marked, e
                e.word, e.hard = mark, e.hard or mark == HARD
            elif good and not mark and e.good < 3:
                e.good = 3


def _marks(e: Element, void: set[int]) -> tuple[bool, bool]:
    """Whether text in an element stands under a HARD and under a SOFT mark that is not void."""
    hard = soft = False
    m = e.marked
    while m is not None:
        if id(m) not in void:
            hard, soft = hard or m.word == HARD, soft or m.word == SOFT
        m = m.outer
    return hard, soft


def void_marks(found: list[tuple[str, int, Element]]) -> set[int]:
    """Elements whose mark does not hold: they have most of the page's text, and no text that is named
    content stands elsewhere. From the outside in."""
    chars: dict[int, int] = {}
    marked: dict[int, Element] = {}
    total = 0
    for text, _, e in found:
        if e.bad:
            continue
        total += len(text)
        m = e.marked
        while m is not None:
            chars[id(m)] = chars.get(id(m), 0) + len(text)
            marked[id(m)] = m
            m = m.outer
    void: set[int] = set()
    for k, m in sorted(marked.items(), key=lambda x: x[1].depth):
        if 2 * chars[k] <= total:
            continue
        elsewhere = False
        for _, _, e in found:
            if e.good >= 3 and not e.bad and not elsewhere:
                x, inside, free = e.marked, False, True
                while x is not None:
                    inside, free = inside or x is m, free and id(x) in void
                    x = x.outer
                elsewhere = not inside and free
        if not elsewhere:
            void.add(k)
    return void


def blocks(source: str) -> list[tuple[str, int, Element]]:
    """(text, characters in links, element) of every text block in page order."""
    root = Element("#root", None)
    top = root
    out: list[tuple[str, int, Element]] = []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                where = top
                while where.name not in BLOCK and where.parent is not None:
                    where = where.parent
                out.append((text, linked, top if top.bad or top.hard else where))
            parts.clear()
        linked = 0

    def close(names: str) -> None:
        """Ends the nearest open element of these names, if one is open within the list or section."""
        nonlocal top
        wanted, e = names.split(), top
        while e.parent is not None and e.name not in SCOPE:
            if e.name in wanted:
                flush()
                top = e.parent
                return
            e = e.parent

    at, size = 0, len(source)
    find = _TOKEN.search
    while at < size:
        m = find(source, at)
        text = source[at : m.start()] if m else source[at:]
        if text:
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if top.link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[6]
        if not name or (m[2] and not m[4]):
            continue
        name = name.lower()
        if m[1] or m[5]:
            if name in BLOCK:
                flush()
            elif name == "br":
                parts.append(" ")
            e = top
            while e.parent is not None and e.name != name:
                if e.name in SCOPE and name not in BLOCK:
                    break
                e = e.parent
            if e.parent is not None and e.name == name:
                top = e.parent
            continue
        attrs = m[3] or m[7] or ""
        if name in RAW:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                if end is None:
                    at = size
                else:
                    stop = source.find(">", end.start())
                    at = size if stop < 0 else stop + 1
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name in CLOSED_BY:
                close(CLOSED_BY[name])
            e = top  # an open paragraph ends where a block begins
            while e.parent is not None and e.name not in BLOCK:
                e = e.parent
            if e.name == "p":
                top = e.parent
            if name == "body":  # the head has ended
                while top.parent is not None and top.name != "html":
                    top = top.parent
        elif name == "br":
            parts.append(" ")
        if name not in VOID:
            top = Element(name, top)
            _judge(top, attrs)
    flush()
    return out


def content_score(text: str, linked: int, e: Element, hard: bool = False, soft: bool = False) -> int:
    """Hundredths of log odds that a block is content; ``hard``, ``soft``: the marks it stands under."""
    if e.bad or hard:
        return -_HARD
    n = text.count(" ") + 1
    score = -60 + min(n, 60) * 4 - 400 * min(1.0, linked / len(text)) + 100 * e.good - 600 * soft
    if text[-1] in ".!?:;\"'”»…" or ". " in text:
        score += 60
    if e.name in ("p", "blockquote", "pre"):
        score += 70
    elif e.name[0] == "h" and e.name[1:].isdigit():
        score += 50
    elif e.name in ("li", "td", "th", "dt", "dd"):
        score -= 30
    return round(score)


def _distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def min_cut(score: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node is on the content side of a minimum cut (the smallest such side).

    Node i has a capacity |score| from the content terminal if it is positive and
    to the boilerplate terminal if negative; edges hold in both directions.
    """
    n = len(score)
    left = [max(0, s) for s in score]  # what the content terminal can still send
    room = [max(0, -s) for s in score]
    links: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    cap: list[int] = []
    for a, b, c in edges:
        links[a].append(len(to))
        to.append(b)
        cap.append(c)
        links[b].append(len(to))
        to.append(a)
        cap.append(c)
    while True:
        # levels from all nodes that can still send
        level = [0 if x else -1 for x in left]
        queue = deque(i for i in range(n) if left[i])
        reach = False
        while queue:
            a = queue.popleft()
            reach = reach or room[a] > 0
            for k in links[a]:
                if cap[k] and level[to[k]] < 0:
                    level[to[k]] = level[a] + 1
                    queue.append(to[k])
        if not reach:
            return [x >= 0 for x in level]
        begin = [0] * n
        for s in range(n):
            while left[s]:
                path: list[int] = []
                a = s
                while True:
                    if room[a]:
                        flow = min([left[s], room[a], *(cap[k] for k in path)])
                        left[s] -= flow
                        room[a] -= flow
                        for k in path:
                            cap[k] -= flow
                            cap[k ^ 1] += flow
                        break
                    while begin[a] < len(links[a]):
                        k = links[a][begin[a]]
                        if cap[k] and level[to[k]] == level[a] + 1:
                            break
                        begin[a] += 1
                    if begin[a] < len(links[a]):
                        path.append(links[a][begin[a]])
                        a = to[path[-1]]
                    elif path:
                        level[a] = -1
                        a = to[path.pop() ^ 1]
                    else:
                        break
                if not path and not room[s] and begin[s] >= len(links[s]):
                    break
    return []


def main_text(source: str | None) -> str:
    """Main text of one page."""
    found = blocks(source or "")
    if not found:
        return ""
    void = void_marks(found)
    score = [content_score(*b, *_marks(b[2], void)) for b in found]
    edges = []
    last: dict[int, int] = {}
    for i, (_, _, e) in enumerate(found):
        if i:
            edges.append((i - 1, i, 120 // (1 + _distance(found[i - 1][2], e))))
        holder = id(e.parent or e)
        if last.get(holder, i - 1) != i - 1:
            edges.append((last[holder], i, 40))
        last[holder] = i
    keep = min_cut(score, edges)
    return "\n".join([b[0] for b, k in zip(found, keep, strict=True) if k])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html)."""

    def fn(batches):
        for batch in batches:
            _, offs = t.text_bytes(batch.column("html"))
            for a, b in t.pieces(offs):
                part = batch.slice(a, b - a)
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(x) for x in texts], pa.int64())})

    return pages.select("page_id", "url", "html").mapInArrow(fn, "page_id long, url string, text string, n_chars long")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
