"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of element paths (tags with their classes). For every
path the tree knows on how many pages it occurs, in which presentations (sequences of children) and
with which contents (text blocks). Importance follows from two entropies to the base of the path's
number of pages:

* presentation: a path that looks different from page to page is important, one that always looks
  the same is not;
* content: a text block found on one page alone is important, one found on every page is not. The
  content importance of a path is the mean over the blocks at it and below it.

* variation: on a host with a branch whose presentation varies much (VARIED), which is where its pages
  have their own content, a path of short texts whose branch and parent always look the same is as
  unimportant as it is constant beside that branch, even if its words are other ones on each page:
  adverts and footers change their text, not their place. Inside of an article this doesn't count.

A path's importance is a mixture of the first two, times its share of the variation. A text block at its place has one too: DECAY of what it
shows by itself, which is little where most pages have it, and the rest from its path. An article or
main element around a node adds PRIOR to its importance, and is no more than that. What is below LOW on
at least MIN_PAGES pages of a host is cut out of each page of that host: a path with everything below
it, a block alone. Pages of a host with the same text count once, so a site full of copies keeps it.

Besides, elements that HTML or their class, id or role mark as navigation, header, footer, sidebar,
notice, advert, form, script, style or comment are cut on every page, and so are blocks outside of
articles that are links as a whole.

Every path on at least MIN_PAGES pages is judged, with its own number of pages as the entropies' base.
Counts are reduced in each task before they are dealt out, by host and path and value, so a host with a
third of all pages is no load. What is low on at least one in RARE of a host's pages makes a list of
bounded size, which reaches the host's pages by broadcast; all other low paths and blocks are found by
a join of the pages' paths, salted, and reach their pages by the page's digest.

A page is parsed in linear time and memory: elements more than DEEPEST levels down share the path of
their ancestor there and their own tag, equal paths are one string, and long classes count by a hash.

Defined results: a null or empty page, or one without text, gives an empty text; equal pages of a
host give equal texts; a null url makes a host of its own; repeated rows are counted once; an
empty table gives an empty result; pages are parsed whole; only key, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import join_counted, stored

MIN_PAGES = 8
RARE = 10
SALTS = 64
LOW = 0.15
DECAY = 0.9
VARIED = 0.3  # presentation entropy of a branch that tells where a host's content is
SHORT = 5.0  # mean power of two of a text's words up to which a path has short texts
PRIOR = 0.04  # at most; too little to keep a block that every page of a host has
SLICE_ROWS = 500
DEEPEST = 40
LONG_MARK = 48
MARK = "\x00"

# Fixed lists: elements without content of their own, elements that stay within a line, elements
# whose content is no main text, and words that mark a class, id or role as such.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr img del".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
CUT = frozenset("head nav footer aside form button select script style noscript template iframe svg "
                "menu dialog canvas object".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 "
                            "h5 h6 header hr main nav ol p pre section table ul".split()),
             "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]),
             "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|"
    r"footer|header|masthead|cookies?|consent|gdpr|notices?|popup|modal|comments?|replies|disqus|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|widget|"
    r"pagination|pager|toolbar|copyright|legal|navigation|contentinfo|complementary)(?:$|[\s_-])",
    re.I)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
NUMBER = re.compile(r"\d+")
ARTICLE = r">(article|main)(\.|>|$)"


class Element:
    """``base`` is the path its children continue: its own, or beyond DEEPEST that of its ancestor."""

    __slots__ = ("tag", "path", "base", "depth", "cut", "main", "children")

    def __init__(self, tag: str, path: str, base: str, depth: int, cut: bool, main: bool):
        self.tag, self.path, self.base, self.depth = tag, path, base, depth
        self.cut, self.main = cut, main
        self.children: list[str] = []


class Open:
    """The open elements from the root on, and where each tag is among them."""

    def __init__(self, root: Element):
        self.stack = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def pop(self) -> None:
        self.places[self.stack.pop().tag].pop()

    def close(self, tag: str) -> None:
        """Close the innermost element of this tag with all that is open in it, if there is one."""
        if self.places.get(tag):
            first = self.places[tag][-1]
            while len(self.stack) > first:
                self.pop()


def parse(page: str) -> tuple[list[tuple[Element, str, bool]], list[Element]]:
    """Text blocks in page order (innermost block element, text, all of it linked), and elements."""
    opened = Open(Element("", "", "", 0, False, False))
    stack, paths = opened.stack, {}
    every, blocks_found = [], []
    buffer: list[str] = []
    linked, free, links, at = False, False, 0, 0

    def flush() -> None:
        nonlocal linked, free
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                blocks_found.append((stack[-1], text, linked and not free))
            buffer.clear()
        linked = free = False

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            text = html.unescape(page[at:m.start()])
            buffer.append(text)
            if not text.isspace():
                linked, free = linked or links > 0, free or links == 0
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing = name.lower(), (m[1] or m[4]) == "/"
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else 1
            continue
        flush()
        links = 0
        if closing:
            opened.close(tag)
            continue
        if tag in VOID:
            stack[-1].children.append(tag)
            continue
        while tag in CLOSED_BY.get(stack[-1].tag, ()):
            opened.pop()
        top, given = stack[-1], m[3] or m[6] or ""
        names = [html.unescape(v.strip("\"'")) for _, v in ATTRIBUTE.findall(given)] if given else []
        mark = ".".join(sorted(NUMBER.sub("#", " ".join(names)).split()))
        main = top.main or tag in ("article", "main")
        cut = (top.cut or tag in CUT or tag == "header" and not main
               or any(MARKED.search(v) for v in names) and tag not in ("html", "body"))
        if len(mark) > LONG_MARK:
            mark = f"{_number(mark):x}"
        own = f"{top.base}>{tag}.{mark}" if mark else f"{top.base}>{tag}"
        own = paths.setdefault(own, own)
        depth = top.depth + 1
        new = Element(tag, own, own if depth <= DEEPEST else top.base, depth, cut, main)
        top.children.append(tag)
        every.append(new)
        if tag in RAW:
            end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        opened.push(new)
    if at < len(page):
        buffer.append(html.unescape(page[at:]))
        free = True
    flush()
    return blocks_found, every


def host(url: str | None) -> str:
    """The host of an address, lower-cased, with a mark before it; a null has none."""
    if url is None:
        return ""
    rest = url.split("://", 1)[-1]
    return "=" + re.split(r"[/?#]", rest, maxsplit=1)[0].rsplit("@", 1)[-1].lower()


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, html) of each page; the digest is of the text that no mark cuts."""
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            sites = [host(url) for url in part.column(0).to_pylist()]
            texts = [main_text(page or "", frozenset()) for page in part.column(1).to_pylist()]
            digests = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sites, pa.string()), pa.array(digests, pa.binary()), part.column(1)],
                ["host", "digest", "html"])


def _sizes(found: list[tuple[Element, str, bool]]) -> dict[str, int]:
    """Words of a page's longest text at each path."""
    out: dict[str, int] = {}
    for e, text, _ in found:
        out[e.path] = max(out.get(e.path, 0), text.count(" ") + 1)
    return out


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, kind, value, n): how many pages of this part show a path with a presentation
    (kind s), a text block (kind t), texts of so many words, as a power of two (kind w), or at all
    (kind p)."""
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            part, seen = batch.slice(start, SLICE_ROWS), Counter()
            for site, page in zip(*[c.to_pylist() for c in part.columns]):
                found, every = parse(page or "")
                own = {("", "p", 0)}
                for e in every:
                    own.add((e.path, "p", 0))
                    run = [c for c, before in zip(e.children, [None, *e.children]) if c != before]
                    shape = f"{len(e.children)}:{' '.join(run)}"
                    own.add((e.path, "s", _number(shape)))
                own |= {(e.path, "t", _number(text)) for e, text, _ in found}
                own |= {(path, "w", (1 + size).bit_length()) for path, size in _sizes(found).items()}
                seen.update((site, *o) for o in own)
            columns = list(zip(*((*k, n) for k, n in seen.items()))) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(),
                                                          pa.int64(), pa.int64()))],
                ["host", "path", "kind", "value", "n"])


def page_values(pages: DataFrame, url: str, page: str) -> DataFrame:
    """(host, path, kind, value, n): what the distinct pages of each host show, and where."""
    single = (pages.select(F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").alias("html"))
              .mapInArrow(_fingerprints, "host string, digest binary, html string")
              .groupBy("host", "digest").agg(F.min("html").alias("html")))
    seen = (single.select("host", "html")
            .mapInArrow(_observed, "host string, path string, kind string, value bigint, n bigint")
            .groupBy("host", "path", "kind", "value").agg(F.sum("n").alias("n")))
    return stored(seen, "page-values")


def style_tree(pages: DataFrame, url: str, page: str) -> DataFrame:
    """(host, path, pages, host_pages, importance): the merged trees, importance from 0 to 1."""
    return _tree(page_values(pages, url, page))


def _prior():
    """What an article or main element at or around a path adds to its importance."""
    return F.when(F.col("path").rlike(ARTICLE), PRIOR).otherwise(0.0)


def _judged(seen: DataFrame) -> DataFrame:
    """(host, path, pages, host_pages) of the paths that have evidence enough."""
    sizes = seen.where("path = '' AND kind = 'p'").select("host", F.col("n").alias("host_pages"))
    return (seen.where("path <> '' AND kind = 'p'").select("host", "path", F.col("n").alias("pages"))
            .where(F.col("pages") >= MIN_PAGES).join(sizes, "host"))


def _tree(seen: DataFrame) -> DataFrame:
    paths = _judged(seen)
    base = F.log(F.col("pages"))
    known = seen.where("path <> ''").join(paths, ["host", "path"])
    share = F.col("n") / F.col("pages")
    shown = known.where("kind = 's'").groupBy("host", "path").agg(
        F.least(F.lit(1.0), F.sum(-share * F.log(share) / base)).alias("presentation"))
    texts = seen.where("kind = 't' AND path <> ''").groupBy("host", "path").agg(
        F.sum(F.log("n")).alias("logs"), F.count("*").alias("blocks"))
    steps = F.split("path", ">")
    above = texts.select("host", "logs", "blocks", F.explode(F.transform(
        F.sequence(F.lit(2), F.size(steps)),
        lambda k: F.concat_ws(">", F.slice(steps, F.lit(1), k)))).alias("path"))
    content = above.groupBy("host", "path").agg(
        (F.sum("logs") / F.sum("blocks")).alias("spread"))
    # Largest presentation and text of a path's branch, beside those of its parent and its host.
    words = known.where("kind = 'w'").groupBy("host", "path").agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("words"))
    around = paths.join(shown, ["host", "path"], "left").join(words, ["host", "path"], "left").select(
        "host", "path", "pages", "host_pages", F.coalesce("presentation", F.lit(0.0)).alias("own"),
        F.coalesce("words", F.lit(0.0)).alias("words"))
    branch = around.select("host", "own", "words", F.explode(F.transform(
        F.sequence(F.lit(2), F.size(steps)),
        lambda k: F.concat_ws(">", F.slice(steps, F.lit(1), k)))).alias("path")).groupBy(
        "host", "path").agg(F.max("own").alias("inner"), F.max("words").alias("longest"))
    whole = around.where(F.col("pages") * 2 >= F.col("host_pages")).groupBy("host").agg(
        F.max("own").alias("most"))
    parent = F.regexp_replace("path", ">[^>]*$", "")
    up = around.select("host", F.col("path").alias("parent"), F.col("own").alias("outer"))
    constant = (branch.withColumn("parent", parent).join(up, ["host", "parent"], "left")
                .join(whole, "host").where((F.col("most") >= VARIED) & (F.col("longest") < SHORT))
                .where(~F.col("path").rlike(ARTICLE))
                .select("host", "path", F.least(F.lit(1.0), F.greatest("inner", F.coalesce(
                    "outer", F.lit(0.0))) / F.col("most")).alias("varied")))
    mixture = F.lit(1 - DECAY) * F.coalesce("presentation", F.lit(0.0)) + DECAY * (1 - F.col("spread") / base)
    return (paths.join(content, ["host", "path"]).join(shown, ["host", "path"], "left")
            .join(constant, ["host", "path"], "left")
            .select("host", "path", "pages", "host_pages", F.least(F.lit(1.0), (
                mixture * F.coalesce("varied", F.lit(1.0)) + _prior())).alias("importance")))


def low_blocks(seen: DataFrame, tree: DataFrame) -> DataFrame:
    """(host, path, pages, host_pages, importance): text blocks of low importance at their places,
    with the block's number after the path."""
    worth = 1 - F.log("n") / F.log("pages")
    each = (seen.where("kind = 't' AND path <> ''").join(tree, ["host", "path"])
            .withColumn("importance", DECAY * worth + (1 - DECAY) * F.col("importance") + _prior()))
    return each.where(F.col("importance") < LOW).select(
        "host", F.concat_ws(MARK, "path", F.col("value").cast("string")).alias("path"),
        F.col("n").alias("pages"), "host_pages", "importance")


def low_paths(tree: DataFrame) -> DataFrame:
    """(host, low): each host's paths and blocks of low importance on one in RARE of its pages or more."""
    low = tree.where((F.col("importance") < LOW) & (F.col("pages") * RARE >= F.col("host_pages")))
    return low.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("low"))


def _shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, path): the paths and blocks of each page that may be cut."""
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            out = []
            for site, digest, page in zip(*[c.to_pylist()
                                            for c in batch.slice(start, SLICE_ROWS).columns]):
                own = set()
                for e, text, _ in parse(page or "")[0]:
                    if e.cut or not e.path:
                        continue
                    own.add(f"{e.path}{MARK}{_number(text)}")
                    path = e.path
                    while path and path not in own:
                        own.add(path)
                        path = path.rpartition(">")[0]
                out += [(site, digest, path) for path in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in (list(zip(*out)) or [[]] * 3)],
                ["host", "digest", "path"])


def rare_low(placed: DataFrame, judged: DataFrame) -> DataFrame:
    """(digest, own, n): what is low on fewer than one in RARE of a host's pages, for each page that
    has such, with the number of its copies."""
    rare = stored(judged.where((F.col("importance") < LOW)
                               & (F.col("pages") * RARE < F.col("host_pages")))
                  .select("host", "path"), "rare-paths")
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    shown = (placed.select("host", "digest", "html")
             .mapInArrow(_shown, "host string, digest string, path string")
             .withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS))))
    found = (shown.join(rare.withColumn("salt", F.explode(salts)), ["host", "path", "salt"])
             .groupBy("digest").agg(F.collect_set("path").alias("own")))
    copies = placed.groupBy("digest").agg(F.count("*").alias("n"))
    return stored(stored(found, "page-rare-paths").join(copies, "digest"), "page-low-paths")


def main_text(page: str, low: frozenset[str]) -> str:
    """The page's blocks that are left, one to a line."""
    kept = []
    for element, text, linked in parse(page)[0]:
        if element.cut or linked and not element.main:
            continue
        if low and (_below(element.path, low) or f"{element.path}{MARK}{_number(text)}" in low):
            continue
        kept.append(text)
    return "\n".join(kept)


def _below(path: str, low: frozenset[str]) -> bool:
    while path:
        if path in low:
            return True
        path = path.rpartition(">")[0]
    return False


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            texts = [main_text(page or "", frozenset([*(low or ()), *(own or ())]))
                     for page, low, own in zip(*[part.column(k).to_pylist() for k in (2, 3, 4)])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())],
                ["id", "url", "text"])


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url",
              page: str = "html") -> DataFrame:
    """(id, url, text): the main text of every page."""
    rows = pages.select(F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{page}`").alias("html"))
    seen = page_values(pages, url, page)
    tree = stored(_tree(seen), "style-tree")
    judged = stored(tree.unionByName(low_blocks(seen, tree)), "judged-paths")
    low = low_paths(judged)
    site = F.coalesce(F.concat(F.lit("="), F.lower(F.regexp_extract(
        "url", r"^(?:(?s:.*?)://)?(?:[^/?#]*@)?([^/?#]*)", 1))), F.lit(""))
    placed = rows.withColumn("host", site).withColumn("digest", F.sha2(F.concat_ws(
        MARK, "host", F.coalesce("html", F.lit(""))), 256))
    sizes = stored(placed.groupBy("host").agg(F.count("*").alias("n")).join(low, "host"), "low-paths")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    joined = join_counted(placed, sizes, "host", "n", total).drop("n")
    few = rare_low(placed, judged)
    joined = join_counted(joined, few, "digest", "n", few.agg(F.sum("n")).first()[0] or 0)
    kind = dict(pages.dtypes)[key]
    return joined.select("id", "url", "html", "low", "own").mapInArrow(
        _extracted, f"id {kind}, url string, text string")
