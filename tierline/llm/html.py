"""Main text of web pages by site style trees.

Pages of one host are merged into a tree of elements, keyed by the path of
tags and classes from the root.  Two importances are taken from it, both
between 0 (the same everywhere) and 1:

* presentation: the entropy, in units of log m, of the child sequences that
  the element has on the m pages that hold it;
* content: 1 - log k / log m for a block of text that k of the m pages hold
  at that place; for an element, the mean over all blocks below it.

They combine as (1 - G^l) * presentation + G^l * content for an element with
l child sequences.  Branches (elements and single blocks) below ``THRESHOLD``
are removed from each page.  Menus, forms, adverts, comments and the like, as
the markup states them, weigh nothing and are not in the tree.  Article and
main elements are a weight: on pages that have some, blocks beside them need a
content importance of ``BESIDE``, and branches within them go as elsewhere,
unless these are most of their text: then the page is a copy of an article and
keeps it whole.  Hosts with fewer than ``MIN_PAGES`` pages have no statistics;
all their branches count as important, but blocks beside an article or main
element go if that holds at least half of the page's text.  The same holds for
places that fewer pages of a larger host have.

Class and id names (as whole names, or by a first or last part that is clear),
forms and headers are a hint only.  What they mark goes, but it never takes an
article or main element along, unless the page has another one apart (articles
among comments), and it does not go where next to nothing of the page would be
left: then the largest of the marked elements, a wrapper of the page or parts of
it that are all marked alike, count as unmarked, what is marked inside them
still goes, and the tree decides on the rest.

Statistics are pre-aggregated by Spark before they are shuffled, so a host
that holds a third of all pages is many small counts, not one group; only the
branches to remove come back, joined to the pages by host.

Edge cases: null and empty html give an empty text; a null url or one without
``://`` belongs to the host "".  Broken markup is read as browsers do: open
elements end with their parents, an unfinished tag at the end is dropped.  Very
long pages are read whole; elements at any depth are told apart, those below
``MAX_DEPTH`` count as their ancestor's in the tree.  Only the three columns
named are looked at, and inside they have names of their own.
Equal rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Set
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tierline.llm.common import ascii_lower, slices, small_batches
from tierline.sources.sinks import stage_table

THRESHOLD = 0.3
#: The same for blocks beside an article or main element.
BESIDE = 0.7
MIN_PAGES = 5
G = 0.9
#: Deeper elements count as parts of their ancestor at this depth.
MAX_DEPTH = 24
#: Share of a page's text that must be left when what names, forms and headers
#: mark is gone.
LEAST_LEFT = 0.05

# What HTML says about elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag ends an open element of these kinds.
ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
ENDS_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_ENDS = {tag: ENDS_SAME.get(tag, set()) | ({"p"} if tag in ENDS_P else set()) for tag in ENDS_P | set(ENDS_SAME)}
SCOPE = set("table ul ol dl article main section aside nav div body html td th".split())
NOT_TEXT = set(
    "head script style noscript template svg math iframe object canvas audio video nav footer aside button select "
    "textarea menu dialog title".split()
)
NOT_TEXT_ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar".split())
NOT_TEXT_NAMES = set(
    "ad ads adsbygoogle adsense adslot adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs "
    "comment commentlist comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal "
    "nav navbar navigation newsletter notice notification overlay paywall popular popup promo promotion recommended related "
    "reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar trending "
    "widget".split()
)
#: Beside one of these words another name of the same element says nothing.
CONTENT_NAMES = set("article content main story".split())
MAIN = {"article", "main"}

_TAG = re.compile(r"""</?([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
_NAME = re.compile(r"[^a-z]+")
#: Before a word they say that it is not there, or beside.
AROUND = set("no not non without with has hide after before pre post".split())
#: Words that compound names of content begin or end with as well (share-price,
#: social-policy): they tell only as a whole name.
AMBIGUOUS = set(
    "ad alert banner comment comments consent copyright disclaimer menu modal notice notification overlay popular promo "
    "promotion recommended related reply replies respond share sharing skip social sponsor sponsored subscribe trending".split()
)


@dataclass(slots=True)
class Element:
    tag: str
    path: int  # digest of the tags and classes from the root
    noise: bool
    named: int  # 2: it or one around it is marked; 1: an article or main element within such an element
    main: bool
    marks: tuple[int, ...] = ()  # the marked elements it is in, by number, from the outermost
    shape: list[str] = field(default_factory=list)


@dataclass(slots=True)
class Block:
    text: str
    chain: tuple[int, ...]  # elements from the root down
    main: bool
    named: int
    marks: tuple[int, ...]
    outer: int  # so many of them lie around the article or main element, or are it


def _digest(text: str) -> int:
    h = xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if source.strip(" \t\r\n/"):
        for name, value in _ATTR.findall(source):
            out.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
    return out


@lru_cache(4096)
def _says_noise(name: str) -> bool:
    """Whether a class or id is a word of NOT_TEXT_NAMES, but for digits and
    the like around it, or a compound that begins or ends with a clear one."""
    parts = [x for x in _NAME.split(name) if x]
    if len(parts) < 2:
        return bool(parts) and parts[0] in NOT_TEXT_NAMES
    clear = NOT_TEXT_NAMES - AMBIGUOUS
    if parts[0] in AROUND:
        return False
    return parts[0] in clear or (parts[-1] in clear and parts[-2] not in AROUND) or set(parts) <= NOT_TEXT_NAMES


@lru_cache(4096)
def _says_header(name: str) -> bool:
    parts = [x for x in _NAME.split(name) if x]
    return parts[:1] == ["header"] or (parts[-1:] == ["header"] and parts[-2] not in AROUND)


def _marked(tag: str, names: list[str], inside_main: bool) -> bool:
    """Whether tag or names hint at something else than content."""
    if tag == "form":
        return True
    if not inside_main and (tag == "header" or any(map(_says_header, names))):
        return True
    if any(not CONTENT_NAMES.isdisjoint(_NAME.split(n)) and not _says_noise(n) for n in names):
        return False
    return any(map(_says_noise, names))


def _released(blocks: list[Block], numbers: dict[int, int], most: int) -> set[int]:
    """Marked elements (by number; ``numbers`` has their paths) that count as
    unmarked because next to nothing would be left without them."""
    free: set[int] = set()
    marked = [b for b in blocks if b.named == 2]
    if not marked or any(b.main and b.named <= most for b in blocks):
        return free
    total = sum(len(b.text) for b in blocks)
    while True:
        held: Counter = Counter()
        left = sum(len(b.text) for b in blocks if b.named < 2)
        for b in marked:
            outermost = next((m for m in b.marks if m not in free), None)
            if outermost is None:
                left += len(b.text)
            else:
                held[outermost] += len(b.text)
        if not held or left >= LEAST_LEFT * total:
            return free
        largest = max(held, key=lambda m: (held[m], -m))
        free.update(m for m in held if numbers[m] == numbers[largest])


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks of text in page order and the elements of a page, both without
    what the markup calls something else than content."""
    blocks: list[Block] = []
    elements: list[Element] = []
    stack: list[Element] = [Element("", 0, False, 0, False)]
    held: list[str] = []
    is_open: defaultdict[str, int] = defaultdict(int)  # tags of open elements, to look for those only
    numbers: dict[int, int] = {}  # marked elements and their paths

    def end_block() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            tree = [e for e in stack[1 : MAX_DEPTH + 1] if e.tag not in INLINE]
            outer = next((i + 1 for i, e in enumerate(tree) if e.main), len(tree))
            around = next(e for e in reversed(stack) if e.tag not in INLINE)
            blocks.append(Block(text, tuple(e.path for e in tree), stack[-1].main, around.named, around.marks, outer))

    def close(index: int) -> None:
        if any(e.tag not in INLINE for e in stack[index:]):
            end_block()
        for e in stack[index:]:
            is_open[e.tag] -= 1
        del stack[index:]

    def text(piece: str) -> None:
        if piece and not stack[-1].noise:
            held.append(entities.unescape(piece) if "&" in piece else piece)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        follow = page[lt + 1 : lt + 3]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if follow[:1] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = follow[:1] == "/"
        letter = follow[1:2] if closing else follow[:1]
        if not (letter.isascii() and letter.isalpha()):
            text("<")
            at = lt + 1
            continue
        m = _TAG.match(page, lt)
        if m:
            tag, source, at = m[1].lower(), m[2], m.end()
        else:  # an unclosed quote, or the page ends within the tag
            end = page.find(">", lt)
            if end < 0:
                break
            tag = re.match("[A-Za-z][^\\s/>]*", page[lt + 1 + closing : end])[0].lower()
            source, at = "", end + 1
        if closing:
            for i in range(len(stack) - 1, 0, -1) if is_open[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            if tag == "p" or tag in ENDS_P:
                end_block()
            continue
        if tag == "br":
            text(" ")
            continue
        if tag not in INLINE:
            end_block()
        ends = _ENDS.get(tag, ())
        for i in range(len(stack) - 1, 0, -1) if any([is_open[t] for t in ends]) else ():
            if stack[i].tag in ends:
                close(i)
                break
            if stack[i].tag in SCOPE:
                break
        attributes = _attributes(source)
        label = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
        names = {x for x in _NAME.split(label) if x}
        parent = stack[-1]
        noise = (
            parent.noise
            or tag in NOT_TEXT
            or attributes.get("role", "").lower() in NOT_TEXT_ROLES
            or "hidden" in attributes
            or attributes.get("aria-hidden", "").lower() == "true"
            or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        )
        is_main = tag in MAIN or attributes.get("role", "").lower() in MAIN
        main = parent.main or is_main
        named, marks = parent.named, parent.marks
        role = attributes.get("role", "").lower()
        if is_main:
            named, marks = min(named, 1), ()
        elif (
            (names or role == "form" or tag in ("form", "header"))
            and tag not in ("html", "body")
            and (role == "form" or _marked(tag, label.split(), parent.main))
        ):
            if tag in INLINE:
                noise = True  # part of a line: gone for good
            else:
                named, marks = 2, (*marks, len(numbers))
        shape = f"{tag}.{'.'.join(sorted(names))}" if names else tag
        if tag not in INLINE and (not parent.shape or parent.shape[-1] != shape):  # repeats count once
            parent.shape.append(shape)
        element = Element(tag, _digest(f"{parent.path}/{shape}"), noise, named, main, marks)
        if len(marks) > len(parent.marks):
            numbers[marks[-1]] = element.path
        if tag not in INLINE and not noise and len(stack) <= MAX_DEPTH:
            elements.append(element)
        if tag in VOID:
            continue
        if tag in RAW:
            m = re.compile(f"</{re.escape(tag)}", re.IGNORECASE).search(page, at)
            at = n if not m else m.start()
        stack.append(element)
        is_open[tag] += 1
    end_block()
    # Articles within such names are comments or cards if the page has others.
    most = 0 if any(b.main and not b.named for b in blocks) else 1
    free = _released(blocks, numbers, most)

    def stays(x: Block | Element) -> bool:
        return x.named <= most or (x.named == 2 and free.issuperset(x.marks))

    return [b for b in blocks if stays(b)], [e for e in elements if stays(e)]


def page_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^.*?://([^/?#]*)", 1))


STATS = "host string, node bigint, kind int, value bigint, chain array<bigint>, n bigint"


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of child sequences (kind 0) and of blocks of text (kind 1) by
    host and element: pages that have them."""
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    for batch in batches:
        for part in slices(batch, "html"):
            counts: Counter = Counter()
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                if not page:
                    continue
                blocks, elements = parse(page)
                shapes: dict[int, list[str]] = {}
                for e in elements:
                    shapes.setdefault(e.path, []).append(" ".join(e.shape))
                counts.update((host, p, 0, _digest("|".join(sorted(set(s)))), ()) for p, s in shapes.items())
                counts.update({(host, b.chain[-1], 1, _digest(b.text), b.chain) for b in blocks if b.chain})
            columns = list(zip(*(k for k in counts), strict=True)) if counts else [[]] * 5
            arrays = [pa.array(c, t) for c, t in zip([*columns, list(counts.values())], types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "node", "kind", "value", "chain", "n"])


def noise_branches(pages: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` (host, html) -> (host, nodes, blocks, weak, known): digests of
    the elements and of the (element, text) pairs of low importance, of the
    pairs that are below ``BESIDE`` only, and of all elements that hold text
    and have statistics."""
    counts = (
        pages.select("host", "html")
        .mapInArrow(_statistics, STATS)
        .groupBy("host", "kind", "node", "value", "chain")
        .agg(F.sum("n").alias("n"))
    )
    counts = stage_table(counts, "style-tree")
    # A path is in one parent only, so sums by (host, node) are of one element.
    shapes = counts.where("kind = 0").groupBy("host", "node").agg(
        F.sum("n").alias("m"),
        F.count("*").alias("l"),
        F.sum(F.col("n") * F.log("n")).alias("n_log_n"),
    )
    shapes = shapes.where(F.col("m") >= min_pages).select(
        "host",
        "node",
        "m",
        "l",
        # The entropy of n_i / m, in units of log m.
        (1 - F.col("n_log_n") / F.col("m") / F.log("m")).alias("presentation"),
    )
    blocks = (
        counts.where("kind = 1")
        .join(shapes.select("host", "node", "m"), ["host", "node"])
        .withColumn("content", 1 - F.log(F.least("n", "m")) / F.log("m"))
    )
    below = (
        blocks.select("host", F.explode(F.slice("chain", 1, F.size("chain") - 1)).alias("node"), "n", (F.col("n") * F.col("content")).alias("weighted"))
        .groupBy("host", "node")
        .agg((F.sum("weighted") / F.sum("n")).alias("content"))
    )
    kept = F.pow(F.lit(G), F.col("l"))
    low_nodes = (
        shapes.join(below, ["host", "node"])
        .where((1 - kept) * F.col("presentation") + kept * F.col("content") < threshold)
        .select("host", "node")
    )
    pair = F.col("node").bitwiseXOR(F.col("value"))
    low = F.col("content") < threshold
    judged = blocks.groupBy("host").agg(
        F.collect_set(F.when(low, pair)).alias("blocks"),
        F.collect_set(F.when(~low & (F.col("content") < BESIDE), pair)).alias("weak"),
        F.collect_set("node").alias("known"),
    )
    nodes = low_nodes.groupBy("host").agg(F.collect_set("node").alias("nodes"))
    return judged.join(nodes, "host", "left").select("host", "nodes", "blocks", "weak", "known")


def main_text(
    page: str | None, nodes: set[int], texts: set[int], weak: Set[int] = frozenset(), known: Set[int] = frozenset()
) -> str:
    """The page's text without branches of low importance."""
    if not page:
        return ""
    chosen, _ = parse(page)

    def low(b: Block, above: int = 0) -> bool:
        return not nodes.isdisjoint(b.chain[above:]) or bool(b.chain) and b.chain[-1] ^ _digest(b.text) in texts

    def size(blocks: Iterable[Block]) -> int:
        return sum(len(b.text) for b in blocks)

    main = [b for b in chosen if b.main]
    if not main:
        kept = [not low(b) for b in chosen] if nodes or texts else [True] * len(chosen)
    else:
        # What an article or main element holds is judged by itself.
        gone = {id(b) for b in main if low(b, b.outer)} if nodes or texts else set()
        if 2 * size(b for b in main if id(b) in gone) > size(main):
            gone = set()
        short = 2 * size(main) < size(chosen)

        def beside(b: Block) -> bool:
            if not b.chain or b.chain[-1] not in known:
                return short and not low(b)
            return not low(b) and b.chain[-1] ^ _digest(b.text) not in weak

        kept = [id(b) not in gone if b.main else beside(b) for b in chosen]
    return "\n".join(b.text for b, keep in zip(chosen, kept, strict=True) if keep)


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(id_col, url_col, text) for every row."""
    small_batches(pages.sparkSession)
    own = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), page_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")
    )
    noise = stage_table(noise_branches(own, threshold, min_pages), "noise")
    kinds = {c: own.schema[c].dataType.simpleString() for c in ("id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [
                    main_text(h, *(set(x or ()) for x in judged))
                    for h, *judged in zip(*(part.column(c).to_pylist() for c in ("html", "nodes", "blocks", "weak", "known")), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    out = own.join(noise, "host", "left").select("id", "url", "html", "nodes", "blocks", "weak", "known")
    return out.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string").withColumnsRenamed({"id": id_col, "url": url_col})
