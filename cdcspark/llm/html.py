"""Main text of web pages, by container paths that a host's pages agree on.

First pass: every page's text blocks give their length, less what stands in links, to the element that holds them and half
of it to the one above. From the best element the vote climbs to the outermost article or main around it or, without one, to
the least element that also holds the rest of the article. Its path, in tags and classes with numbers generalised, is the
page's vote. Spark sums votes per host, and on how many pages each path holds text, with partial aggregates, so a host with
a third of all pages is one row per path and task. Second pass: each page is read again. It gives the text at a winning path
of its host, if that covers most of its own best element or if its host knows this one as what stands beside the text.

Otherwise it gives the text of its own best element. Pages are parsed whole, in one streaming scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import bounded_batches
from cdcspark.session import written

#: A path wins if it has at least this part of its host's votes; so no host has more than the inverse of it.
WIN_SHARE = 0.05
#: The part of a page's own best element that a host's path must hold to be taken in its place.
COVERS = 0.8

#: Fixed values of the format: elements without content or end tag; elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())

#: Fixed values of the format: elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)

#: Elements that never hold main text.
DROPPED = frozenset(
    "aside button canvas datalist dialog footer form head iframe input map menu nav noscript object option script select style svg "
    "template textarea title video audio xmp noframes".split()
)

#: Of these, the ones that are kept where the page's article, or its only heading of the first rank, stands inside.
_SPARED = {**dict.fromkeys("aside form header".split(), ("article", "h1")), **dict.fromkeys("dialog footer menu nav".split(), ("article",))}

#: Words of classes, ids and roles that mark what surrounds the main text.
_AROUND = frozenset(
    "ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs captcha comment comments complementary consent "
    "contentinfo cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promos recommended related replies reply respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Words that may stand beside them in one name; any other word (with, has, no, content, text, results) makes it the name of another thing.
_BESIDE = frozenset(
    "area bar block bottom box button buttons desktop fixed form global icons left link links list main mobile panel primary right "
    "secondary section site slot slots sticky top unit".split()
)
#: Words of the article, beside which only these surround it: its comments, but not its header.
_ARTICLE_WORDS = frozenset("article articles blog entry page post posts".split())
_BESIDE_ARTICLE = frozenset(
    "comment comments footer nav navigation pager pagination recommended related replies respond share sharing social".split()
)
#: Words of headings, which are the article's own inside it.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
_HEADING_WORDS = frozenset(("header", "masthead"))
#: Words of the page's own surroundings, which stand in its layout and in no article.
_PAGE_WORDS = frozenset("contentinfo footer masthead menu nav navbar navigation sidebar".split())
#: Names of layout, beside which a sidebar is what the element has and not what it is.
_LAYOUT = frozenset("container content layout main page row site wrap wrapper".split())
_PART = re.compile(r"[_-]+")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)"
    # A tag whose quotes do not match ends at the next bracket.
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
#: One attribute after the other, so that values are consumed and never searched for names.
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_READ = frozenset(("class", "id", "role", "hidden", "aria-hidden"))
_NUMBER = re.compile(r"\d+")


@dataclass(slots=True)
class Element:
    tag: str
    path: str
    parent: Element | None
    dropped: bool
    score: float = 0.0
    place: int = 0
    #: The innermost element around it, or itself, that goes unless it turns out to hold the article; what spares that one.
    doubtful: Element | None = None
    spared_by: tuple[str, ...] = ()
    gone: bool = True
    #: It holds the page's own navigation or footer, so it is the page's layout and no article.
    layout: bool = False


@dataclass(slots=True)
class Block:
    """Text between two block borders, and the element it stands in."""

    holder: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    #: Places in ``parts``, and their linked length, that go with a doubtful element.
    doubts: list[tuple[int, int, Element]] = field(default_factory=list)

    #: Joined once, when the page has been read.
    joined: str | None = None

    def text(self) -> str:
        if self.joined is None:
            self.joined = " ".join("".join(self.parts).split())
        return self.joined


@lru_cache(maxsize=10_000)
def _around(name: str) -> frozenset[str]:
    """The words by which a whole class, id or role names surroundings; none where it names something else."""
    parts = [x for x in _PART.split(name.lower()) if x]
    words = frozenset(x for x in parts if x in _AROUND)
    others = {x for x in parts if x not in words and x not in _BESIDE and not x[0].isdigit()}
    return words if words and (not others or others <= _ARTICLE_WORDS and words <= _BESIDE_ARTICLE) else frozenset()


def _surrounds(names: list[str]) -> frozenset[str]:
    """The words by which an element's names mark it as surroundings."""
    words = frozenset().union(*map(_around, names))
    if "sidebar" in words and not _LAYOUT.isdisjoint(x.lower() for x in names):
        return words - {"sidebar"}
    return words


def _step(tag: str, attributes: str) -> tuple[str, list[str], bool]:
    """The element's step in a path, its names that may mark it as surroundings, and if it is hidden."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return tag, [], False
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in _READ:
            found.setdefault(name, m[2] or m[3] or m[4] or "")
    classes = ".".join(sorted({_NUMBER.sub("#", x.lower()) for x in found.get("class", "").split()}))
    names = [y for x in ("class", "id", "role") for y in found.get(x, "").split()]
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    return f"{tag}.{classes}" if classes else tag, names, hidden


def blocks_of(html: str) -> list[Block]:
    """The page's blocks of text that are no surroundings, in page order. Broken and cut-off markup is read as far as it goes."""
    root = Element("", "", None, False)
    top, blocks, current, links, at = root, [], None, 0, 0
    end, places = len(html), 0
    doubtful: list[Element] = []
    landmarks: dict[str, list[Element]] = {"article": [], "h1": []}

    def add(raw: str) -> None:
        nonlocal current
        if top.dropped or not raw:
            return
        holder = top
        while holder.tag and holder.tag not in BLOCKS:
            holder = holder.parent
        if current is None:
            if raw.isspace():
                return
            current = Block(holder)
            blocks.append(current)
        text = unescape(raw)
        if top.doubtful is not None:
            current.doubts.append((len(current.parts), len(text) if links else 0, top.doubtful))
        current.parts.append(text)
        if links:
            current.linked += len(text)

    def close(tag: str) -> bool:
        """Ends the innermost open ``tag`` and all in it."""
        nonlocal top, links
        node = top
        while node is not None and node.tag != tag:
            node = node.parent
        if node is None or not node.tag:
            return False
        while top is not node:
            links -= top.tag == "a"
            top = top.parent
        links -= node.tag == "a"
        top = node.parent
        return True

    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or not m[4]:
            continue
        if m[1]:
            if tag in BLOCKS:
                current = None
            close(tag)
            continue
        if tag == "br" or tag == "wbr":
            if tag == "br":
                add(" ")
            continue
        if tag in BLOCKS:
            current = None
            _close_open(top, tag, close)
        if tag in RAW:
            # Ends at its own end tag, whatever stands between.
            done = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            at = end if done is None else (html.find(">", done.start()) + 1 or end)
            continue
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        step, names, hidden = _step(tag, m[3])
        words = _surrounds(names) if names else frozenset()
        around, spared_by = bool(words) or hidden, ("article", "h1")
        if words and not hidden and (tag in _HEADINGS or words <= _HEADING_WORDS) and _inside_article(top):
            around = False
        if tag in _SPARED and (tag != "header" or not _inside_article(top)):
            around, spared_by = True, _SPARED[tag]
        places += 1
        hard = top.dropped or tag in DROPPED and tag not in _SPARED
        top = Element(tag, f"{top.path}/{step}", top, hard, 0.0, places, top.doubtful, spared_by)
        # The page's frame itself is never surroundings, whatever its classes say.
        if tag in ("nav", "footer") or not words.isdisjoint(_PAGE_WORDS) and around:
            top.parent.layout = True
        if around and not hard and tag not in ("html", "body", "main", "article"):
            top.doubtful = top
            doubtful.append(top)
        if not hard and (tag in ("main", "h1") or tag == "article" and not words):
            landmarks["h1" if tag == "h1" else "article"].append(top)
        links += tag == "a"
    if doubtful:
        _settle(blocks, doubtful, landmarks)
    return blocks


def _settle(blocks: list[Block], doubtful: list[Element], landmarks: dict[str, list[Element]]) -> None:
    """Takes out what stands in doubtful elements, but keeps those around the article or the first heading if it is nowhere else."""
    for kind, held in landmarks.items():
        if any(e.doubtful is None for e in held):
            continue
        seen: set[int] = set()
        for e in held:
            node = e.doubtful
            while node is not None and id(node) not in seen:
                seen.add(id(node))
                if kind in node.spared_by:
                    node.gone = False
                node = node.parent.doubtful
    for e in doubtful:  # outer ones come first
        outer = e.parent.doubtful
        e.gone = e.gone or outer is not None and outer.gone
    for block in blocks:
        for i, linked, e in block.doubts:
            if e.gone:
                block.parts[i] = ""
                block.linked -= linked


def _inside_article(node: Element | None) -> bool:
    while node is not None:
        if node.tag in ("article", "main"):
            return True
        node = node.parent
    return False


#: Elements that a new block of the same kind ends, and what the search for them stops at.
_SIBLINGS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd", ("dl",)), "dt": ("dt", ("dl",)), "option": ("option", ("select",)),
             "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table"))}


def _close_open(top: Element, tag: str, close) -> None:
    """Ends what a start tag ends without an end tag: an open paragraph, or the item before."""
    node = top
    while node is not None and node.tag and (node.tag not in BLOCKS or node.tag == "p"):
        if node.tag == "p":
            close("p")
            break
        node = node.parent
    if tag in _SIBLINGS:
        same, stops = _SIBLINGS[tag]
        node = top
        while node is not None and node.tag and node.tag not in stops:
            if node.tag == same:
                close(same)
                return
            node = node.parent


def _worth(block: Block) -> int:
    return len(block.text()) - 2 * block.linked


def best_element(blocks: list[Block]) -> Element | None:
    """The element that holds the article: the one whose own blocks, and the blocks one level below, hold most text outside
    links, or what is around it and holds more of the article."""
    seen: dict[int, Element] = {}
    for block in blocks:
        worth = _worth(block)
        if worth <= 0:
            continue
        node, share = block.holder if block.holder.tag in _CONTAINERS else block.holder.parent, 1.0
        while node is not None and share >= 0.5:
            if node.tag in _CONTAINERS:
                node.score += share * worth
                seen[id(node)] = node
                share /= 2
            node = node.parent
    if not seen:
        return None
    return _whole(max(seen.values(), key=lambda e: (e.score, -e.place)), blocks)


def _whole(best: Element, blocks: list[Block]) -> Element:
    """The outermost article or main around ``best``; without one, the least element around it that holds the first heading,
    and then each one below the page's frame that is no layout and adds more text outside links than in them."""
    chain, node = [], best
    while node is not None:
        chain.append(node)
        node = node.parent
    for node in reversed(chain):
        if node.tag in ("article", "main"):
            return node
    order = {id(e): i for i, e in enumerate(chain)}
    known: dict[int, int] = dict(order)
    # For each element of the chain, what it holds besides the one before.
    adds, has_text, heading = [0] * len(chain), [False] * len(chain), len(chain)
    for block in blocks:
        if not block.text():
            continue
        walked, node, first = [], block.holder, False
        while id(node) not in known:
            walked.append(node)
            node = node.parent
        at = known[id(node)]
        for x in walked:
            known[id(x)] = at
        node = block.holder
        while node.tag and node.tag not in _CONTAINERS:
            first = first or node.tag == "h1"
            node = node.parent
        if first:
            heading = min(heading, at)
        adds[at] += _worth(block)
        has_text[at] = True
    found = heading if heading < len(chain) else 0
    for i in range(found + 1, len(chain)):
        if chain[i].tag in _FRAME or chain[i].layout or has_text[i] and adds[i] <= 0:
            break
        if has_text[i]:
            found = i
    return chain[found]


_CONTAINERS = frozenset("article main section div td body blockquote center html dd li".split())
#: Around the whole page; the nameless one is the root of a page without them.
_FRAME = frozenset(("", "html", "body"))


def key_of(path: str) -> int:
    """64 bits for a path."""
    return int.from_bytes(blake2b(path.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def vote(html: str) -> tuple[str, float] | None:
    """Path and score of the page's best element."""
    best = best_element(blocks_of(html))
    return (best.path, best.score) if best else None


def _held(blocks: list[Block]) -> set[str]:
    """Paths of all elements that hold text outside links, the page's frame aside."""
    seen: set[int] = set()
    paths: set[str] = set()
    for block in blocks:
        if _worth(block) <= 0:
            continue
        node = block.holder
        while node is not None and id(node) not in seen:
            seen.add(id(node))
            if node.tag not in _FRAME:
                paths.add(node.path)
            node = node.parent
    return paths


def votes(html: str) -> list[tuple[int, str | None, float]]:
    """Key and score of every path that holds text on the page; the best element's has its path, the others have none."""
    blocks = blocks_of(html)
    best = best_element(blocks)
    if best is None:
        return []
    return [(key_of(best.path), best.path, best.score), *((key_of(x), None, 0.0) for x in _held(blocks) if x != best.path)]


def extract(html: str, paths: list[str], beside: list[int] | frozenset[int] = ()) -> str:
    """Blocks inside elements at the first of ``paths`` that holds most of the page's own best element, else inside that one;
    all if it has none. An element whose path's key is ``beside`` the text on its host gives way to any of ``paths``."""
    blocks = blocks_of(html)
    texts = [(b, t) for b in blocks if (t := b.text())]
    best = best_element(blocks)

    def within(path: str) -> list[tuple[Block, str]]:
        inside = path + "/"
        return [(b, t) for b, t in texts if b.holder.path == path or b.holder.path.startswith(inside)]

    if best is None:
        return "\n".join(t for _, t in texts)
    own = within(best.path)
    held, total = {id(b) for b, _ in own}, sum(len(t) for _, t in own)
    give_way = bool(beside) and key_of(best.path) in beside
    for path in paths:
        if path == best.path:
            return "\n".join(t for _, t in own)
        found = within(path)
        if found and (give_way or sum(len(t) for b, t in found if id(b) in held) >= COVERS * total):
            return "\n".join(t for _, t in found)
    return "\n".join(t for _, t in own)


def host(url: Column) -> Column:
    """Host of a url in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """Per host its winning paths, most voted first, and the keys of paths beside the text: host, paths, beside.

    A path is beside the text if it holds text on many of a host's pages and is the best one on less than half of them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (h, *found) for h, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for found in votes(x.as_py() or "")
            ]
            hosts, keys, paths, scores = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())],
                ["host", "key", "path", "score"],
            )

    bounded_batches(pages.sparkSession)
    found = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(work, "host string, key long, path string, score double")
    found = found.groupBy("host", "key").agg(
        F.count("path").alias("n"), F.count(F.lit(1)).alias("held"), F.max("path").alias("path"),
        F.sum(F.col("score").cast("long")).alias("score"),
    ).where("n > 0")
    hosts = found.groupBy(F.col("host").alias("of")).agg(F.sum("n").alias("all"))
    least = F.lit(WIN_SHARE) * F.col("all")
    known = found.join(hosts, F.col("host") == F.col("of")).where(F.col("held") >= least)
    won = (F.col("n") >= least) & (2 * F.col("n") >= F.col("held"))
    best = F.sort_array(F.collect_list(F.when(won, F.struct("n", "score", "path"))), asc=False)
    return known.groupBy("host").agg(
        F.transform(best, lambda x: x["path"]).alias("paths"),
        F.collect_list(F.when(2 * F.col("n") < F.col("held"), F.col("key"))).alias("beside"),
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page; blocks are joined by line feeds.

    Null, empty or text-free html gives an empty text; pages without a host (null or odd url) vote together; repeated rows
    give repeated results; other columns are ignored.
    """
    pages = pages.select("page_id", "url", "html")
    winners = written(host_paths(pages), "html-paths")
    rows = pages.withColumn("_host", host(F.col("url")))
    # A row per host, joined by its written size; where that needs a shuffle, adaptive execution splits a hot host.
    rows = rows.join(winners.withColumnRenamed("host", "_host"), "_host", "left").select("page_id", "url", "html", "paths", "beside")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            texts = [extract(x.as_py() or "", paths or [], frozenset(beside or ())) for x, paths, beside in known]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    bounded_batches(pages.sparkSession)
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")
