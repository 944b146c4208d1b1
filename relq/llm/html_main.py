"""HTML extraction: the maximum-scoring subsequence of a page's tokens.

A page is read as a sequence of words and tags.  Every token has a score: what
its kind (word or tag) says, plus what the containers that it stands in say
(``article``, ``nav``, an element whose class names an advert, ...).  A linear
scan finds the contiguous run of tokens with the largest sum: the content
region.  Text whose nearest container speaks against content is left out (such
a container costs the region about as much as one bad tag, however long it
is), and the rest is joined block by block.  An ``article`` in a ``form`` is
thus content, an advert in an ``article`` is not.  A container around nearly
all of a page's prose (``frames``: a form around the whole page, a
``content-sidebar-wrap``) says nothing.

Scores are log odds counted on labelled pages: those that mark their article
themselves (``article`` or ``main`` elements).  Spark counts words and tags
inside and outside of the marked element over all labelled rows, where the
nearest container decides as well, so a name that stands around marked content
more often than not speaks for content; a container starts with the fixed prior counts below, so names that no labelled page has
still mean something.  Only these counts (one row for each known container
name) reach the driver.

Defined results: a null or empty page, and one without visible words, gives
the empty text; a page cut off in the middle is read as far as it goes;
repeated rows are extracted each for itself; an empty table gives no rows; other
columns are ignored, whatever their names; pages of any length are read whole, in
linear time, and a quote that is never closed reaches to the page's end.  White space inside a block is
one space (``br`` is white space); blocks are joined by one line feed.
"""

from __future__ import annotations

import html
import math
import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import slices

# Elements and what they mean.
CONTENT_TAGS = frozenset("article main".split())
AGAINST_TAGS = frozenset("nav header footer aside form menu dialog".split())
AGAINST_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form header login "
    "masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted recommended related respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split())
RAW_TAGS = frozenset("script style textarea title noscript template iframe".split())
HIDDEN_TAGS = frozenset("head script style textarea title noscript template iframe svg math button select option object audio video canvas".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
INLINE_TAGS = frozenset("a abbr b br cite code em font i img input label q s small span strong sub sup time u".split())
KNOWN_TAGS = BLOCK_TAGS | INLINE_TAGS
CLOSED_BY_SIBLING = {"p": BLOCK_TAGS, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
                     "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"})}

FRAMES = AGAINST_WORDS | {"<form>"}  # names that can stand around a whole page
FRAME_SHARE, PROSE = 10, 10  # words in a frame for one outside; least words of a block of prose
PRIOR_WORDS = 20.0
LARGEST = 3.0
LEAST, LARGEST_TAG, LEAST_WORD = 0.1, 1.0, 0.5  # containers say more than a single tag
# Possessive parts throughout: what is read once is not read again.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|[^<]++|<(/?)([A-Za-z][^\s/>]*+)|<", re.S)
# What may stand behind a tag's name; quotes only count where a value begins, and
# a value whose quote is never closed goes on to the end of the page.
_ATTRIBUTES = re.compile(r"(?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|(?![\"'])[^\s>]*+))?+|=)*+")
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Za-z]+")


def containers(tag: str, attributes: str) -> tuple[str, ...]:
    """The known container names of an element: its tag's and its class's."""
    own = [f"<{tag}>"] if tag in CONTENT_TAGS or tag in AGAINST_TAGS else []
    if "=" in attributes and tag not in ("html", "body"):
        for found in _NAMES.finditer(attributes):
            own += [w for w in map(str.lower, _PARTS.findall(found[1] or found[2] or found[3] or "")) if w in AGAINST_WORDS]
    return tuple(dict.fromkeys(own))


class Container:
    """A container around tokens, in the one that it stands in."""

    __slots__ = ("outer", "place", "names", "depth", "value", "positive", "chain", "can", "nearest", "said")

    def __init__(self, outer: Container | None, place: int, names: tuple[str, ...]):
        self.outer, self.place, self.names = outer, place, names
        self.depth = 1 + (outer.depth if outer else 0)


def tokens(page: str):
    """(kind, text or tag, container, hidden) of each token: kind is ``text``,
    ``block`` (a tag at which a block ends) or ``tag`` (any other tag); the
    container is the innermost one, or None.  Time is linear in the page."""
    # open elements: tag, container, hidden, place in the stack of the innermost block element
    stack: list[tuple[str, Container | None, bool, int]] = []
    opened: dict[str, int] = {}
    at = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            opened[stack.pop()[0]] -= 1

    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        closing, tag = m[1], m[2]
        if tag is None:
            if not m[0].startswith(("<!", "<?")):
                yield "text", m[0], *(stack[-1][1:3] if stack else (None, False))
            continue
        begin, at = at, _ATTRIBUTES.match(page, at).end()
        attributes, at = page[begin:at], at + 1
        tag = tag.lower()
        kind, hidden = "block" if tag in BLOCK_TAGS else "tag", stack[-1][2] if stack else False
        if closing:
            if opened.get(tag):
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                close(depth)
        else:
            # inline elements left open in a paragraph end with it
            block = stack[-1][3] if stack else -1
            if block >= 0 and tag in CLOSED_BY_SIBLING.get(stack[block][0], ()):
                close(block)
            _, held, hidden, block = stack[-1] if stack else ("", None, False, -1)
            if tag not in VOID_TAGS and not attributes.rstrip().endswith("/"):
                own = containers(tag, attributes)
                stack.append((tag, Container(held, at, own) if own else held, hidden or tag in HIDDEN_TAGS, len(stack) if tag in BLOCK_TAGS else block))
                opened[tag] = opened.get(tag, 0) + 1
            if tag in RAW_TAGS:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*+>?", re.I).search(page, at)
                at = end.end() if end else len(page)
                if stack and stack[-1][0] == tag:
                    close(len(stack) - 1)
        yield kind, f"{tag}/" if tag in KNOWN_TAGS else "tag/", stack[-1][1] if stack else None, hidden


def _outwards(held: Container | None):
    while held is not None:
        yield held
        held = held.outer


def _marked(held: Container | None, known: dict[Container | None, bool]) -> bool:
    """Whether the nearest container marks content; one that says both (an
    ``article`` with a comment's class) leaves it to those around it."""
    passed = []
    for one in _outwards(held):
        if one in known:
            break
        passed.append(one)
    for one in reversed(passed):
        content = one.names[0][1:-1] in CONTENT_TAGS
        if content and len(one.names) > 1:
            known[one] = known[one.outer] if one.outer is not None else True
        else:
            known[one] = content
    return known[held] if held is not None else False


def counts(page: str) -> dict[tuple[str, bool], int]:
    """Words and tags, all in all and by container, inside and outside of the
    marked content; nothing for a page that marks none."""
    out: dict[tuple[str, bool], int] = {}
    known: dict[Container | None, bool] = {}
    keys: dict[Container | None, frozenset[str]] = {None: frozenset(["word"])}
    marked = False
    for kind, text, held, hidden in tokens(page):
        if hidden:
            continue
        inside = _marked(held, known)
        if held not in keys:
            passed = []
            for one in _outwards(held):
                if one in keys:
                    break
                passed.append(one)
            for one in reversed(passed):
                # classes of a content element say nothing about containers
                content = one.names[0][1:-1] in CONTENT_TAGS
                keys[one] = keys[one.outer].union(one.names[:1] if content else one.names)
                marked |= content
        if kind == "text":
            n = len(text.split())
            if n:
                for key in keys[held]:
                    out[key, inside] = out.get((key, inside), 0) + n
        else:
            out[text, inside] = out.get((text, inside), 0) + 1
    return out if marked else {}


def weights(found: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of each kind of token and of each container name."""
    kinds = ["word", "tag/", *(f"{t}/" for t in sorted(KNOWN_TAGS))]
    total = {side: sum(found.get((k, side), 0) + PRIOR_WORDS for k in kinds) for side in (True, False)}
    out = {k: max(-LARGEST, min(LARGEST, math.log((found.get((k, True), 0) + PRIOR_WORDS) / total[True]) - math.log((found.get((k, False), 0) + PRIOR_WORDS) / total[False]))) for k in kinds}
    out = {k: max(w, LEAST_WORD) if k == "word" else max(-LARGEST_TAG, min(w, -LEAST)) for k, w in out.items()}  # words speak for content, tags against it
    for name, for_it in [(f"<{t}>", True) for t in CONTENT_TAGS] + [(f"<{t}>", False) for t in AGAINST_TAGS] + [(w, False) for w in AGAINST_WORDS]:
        inside = found.get((name, True), 0) + PRIOR_WORDS * (1 if for_it else 0.05)
        outside = found.get((name, False), 0) + PRIOR_WORDS * (0.05 if for_it else 1)
        out[name] = max(-LARGEST, min(LARGEST, math.log(inside / outside)))
    return out


class _Against:
    """A container that speaks against content, in the next such one outside of
    it (up to one that speaks for content)."""

    __slots__ = ("place", "outer", "inner", "prose", "within", "listed")

    def __init__(self, place: int, outer: _Against | None):
        self.place, self.outer, self.inner, self.prose, self.within, self.listed = place, outer, [], 0, 0, False


def _valued(held: Container, weight: dict[str, float], done: set[int]) -> None:
    """What a container and those around it say."""
    passed = []
    for one in _outwards(held):
        if one.place in done:
            break
        passed.append(one)
    for one in reversed(passed):
        outer = one.outer
        done.add(one.place)
        one.value = sum(weight[h] for h in one.names)
        one.positive, one.chain, one.can = (outer.positive, outer.chain, outer.can) if outer else (None, None, True)
        if one.value > LEAST:
            one.positive, one.chain, one.can = one, None, True
        elif one.value < -LEAST:
            one.chain, one.can = _Against(one.place, one.chain), one.can and FRAMES.issuperset(one.names)


def frames(found: list, weight: dict[str, float]) -> frozenset[int]:
    """Places of the containers that speak against content but stand around
    nearly all of the page, from outside in: every container that speaks for
    content is inside, and there is ``FRAME_SHARE`` times as much prose (blocks
    of ``PROSE`` words) inside as there are words that stand in none."""
    block, texts, size, done = 0, [], {}, set()
    first: Container | None = None  # that speaks for content
    shared, depth = 0, 0  # containers that stand around all of those, and least depth since the first
    for kind, text, held, hidden in found:
        block += kind == "block"
        depth = min(depth, held.depth if held else 0)
        if hidden:
            continue
        if held is not None:
            if held.place not in done:
                _valued(held, weight, done)
            if held.positive is not None:
                if first is None:
                    first, shared, depth = held.positive, held.positive.depth - 1, held.depth
                shared = min(shared, depth, held.positive.depth - 1)
        if kind == "text":
            n = len(text.split())
            texts.append((block, held, n))
            size[block] = size.get(block, 0) + n
    outside, links = 0, []
    for block, held, n in texts:
        if held is None or held.can and held.chain is None:
            outside += n
        elif held.can and size[block] >= PROSE:
            link = held.chain
            link.prose += n
            while link is not None and not link.listed:
                link.listed = True
                links.append(link)
                link = link.outer
    links.sort(key=lambda x: -x.place)  # inner ones begin behind those around them
    for link in links:
        link.within += link.prose
        if link.outer is not None:
            link.outer.within += link.within
            link.outer.inner.append(link)
    allowed = None
    if first is not None:
        allowed = {one.place for one in _outwards(first) if one.depth <= shared}
    # the largest of the outermost ones, as long as it is large enough
    heap = [(-x.within, x.place, x) for x in links if x.outer is None]
    heapify(heap)
    around: set[int] = set()
    while heap:
        within, place, link = heappop(heap)
        if allowed is not None and place not in allowed:
            continue
        if -within <= FRAME_SHARE * outside:
            break
        around.add(place)
        outside += link.prose
        for x in link.inner:
            heappush(heap, (-x.within, x.place, x))
    return frozenset(around)


def main_text(page: str, weight: dict[str, float]) -> str:
    """The main text of a page."""
    best, best_span, total, start = 0.0, None, 0.0, 0
    pieces: list[tuple[int, str, bool]] = []  # block, text, whether its nearest container speaks against it
    block, was_against = 0, False
    found = list(tokens(page))
    around = frames(found, weight)
    seen: set[int] = set()
    for kind, text, held, hidden in found:
        block += kind == "block"
        if hidden:
            continue
        against, said = False, 0.0
        if held is not None:
            if held.place not in seen:
                passed = []
                for one in _outwards(held):
                    if one.place in seen:
                        break
                    passed.append(one)
                for one in reversed(passed):
                    seen.add(one.place)
                    value = 0.0 if one.place in around else one.value
                    one.nearest = value if abs(value) > LEAST else one.outer.nearest if one.outer else 0.0
                    one.said = (one.outer.said if one.outer else 0.0) + max(value, 0.0)
            against, said = held.nearest < 0, held.said
        if kind == "text" or text == "br/":
            pieces.append((block, text if kind == "text" else " ", against))
        if against:  # its words are left out; the whole container counts about as one bad tag
            gain = (0.0 if kind == "text" else -LEAST) - (0.0 if was_against else LARGEST_TAG)
        else:
            gain = weight["word" if kind == "text" else text] + said
            gain *= len(html.unescape(text).split()) if kind == "text" else 1
        was_against = against
        if total <= 0:
            total, start = 0.0, len(pieces) - (kind == "text")
        total += gain
        if total > best:
            best, best_span = total, (start, len(pieces))
    if best_span is None:
        return ""
    out: dict[int, list[str]] = {}
    for number, text, against in pieces[best_span[0]:best_span[1]]:
        if not against:
            out.setdefault(number, []).append(text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in out.values())
    return "\n".join(line for line in lines if line)


def learn(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weights counted over all labelled rows of ``pages``."""
    def run(batches):
        total: dict[tuple[str, bool], int] = {}
        for part in slices(batches, "html"):
            for page in part.column("html").to_pylist():
                for key, n in counts(page or "").items():
                    total[key] = total.get(key, 0) + n
        if total:
            yield pa.record_batch({"name": pa.array([k for k, _ in total], pa.string()), "inside": pa.array([i for _, i in total], pa.bool_()), "n": pa.array(list(total.values()), pa.int64())})

    found = pages.select(F.col(html_col).cast("string").alias("html")).mapInArrow(run, "name string, inside boolean, n long")
    return weights({(r["name"], r["inside"]): r["n"] for r in found.groupBy("name", "inside").agg(F.sum("n").alias("n")).collect()})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weight: dict[str, float] | None = None) -> DataFrame:
    """(id, url, text, n_chars) of each row; weights are learned from ``pages``
    themselves unless given."""
    weight = learn(pages, html_col) if weight is None else weight

    def run(batches):
        for part in slices(batches, "html"):
            texts = [main_text(p or "", weight) for p in part.column("html").to_pylist()]
            yield pa.record_batch({"id": part.column("id"), "url": part.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string, n_chars long").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
