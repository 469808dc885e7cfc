"""HTML extraction by site template removal.

A page is parsed once into blocks of text and the subtrees around them.  Subtrees, inside articles too,
are hashed and counted per host in Spark; those that recur across many pages of their host are the
site's template and are deleted.  Pages count by several min-hashes of their main text, so that copies and
near copies of an article are not taken for a template, and inside an article a subtree must stand on
half of its host's pages.  Elements whose name, and containers whose role or class, says menu, header,
footer, sidebar, notice, advert, form or comment go as well; where a page marks its article, only that
is kept.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import discard, materialise

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|noframes|select"
DROPPED = frozenset("nav header footer aside form button fieldset dialog menu head figcaption object audio video canvas".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
CONTAINERS = frozenset("div section ul ol dl table".split())
SCOPES = frozenset("article main section body html td th table div aside nav footer header form".split())

TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|</([a-z][^\s>/]*)[^>]*(?:>|\Z)|<([a-z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S | re.I)
NAMED = re.compile(r"""(?:\b(?:class|id|role|aria-label)\s*=\s*)(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
SIGN = re.compile(
    r"^(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|cookie|user|reader)[-_])?"
    r"(?:ads?|adverts?|advertis\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|header|masthead|footer|comments?|commentlist|replies|reply|respond|disqus|form|newsletter|subscri\w*|popup|modal|share|sharing|social|related|widgets?|toolbar|pagination|pager|search|login|complementary|contentinfo|skip)"
    r"(?:[-_](?:bar|box|list|section|wrapper|container|area|block|links?|menu|banner|buttons?|form|notice|widget|unit|slot|thread|overlay))?$",
    re.I,
)
SPACE = re.compile(r"\s+")
MIN_PAGES, SHARE, SEEDS, SHINGLE = 5, 0.5, 3, 5
"""A subtree is template if it stands on MIN_PAGES different pages of its host, however large the host; in an article, on SHARE of them too."""
OUTSIDE, LATE, ARTICLE = 0, 1, 2


@dataclass
class Element:
    """An open element: whether it is dropped, for its own or an outer name (NAME) or only for a class (CLASS), and where it lies."""

    name: str
    drop: int
    place: int
    text: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)


KEPT, CLASS, NAME = 0, 1, 2


def signed(name: str, attributes: str) -> bool:
    """Whether an element is a container of which a whole class, id or role names a page part other than the main text."""
    return bool(attributes) and name in CONTAINERS and any(SIGN.match(word) for m in NAMED.finditer(attributes) for word in (m[1] or m[2] or m[3] or "").split())


def clean(pieces: list[str]) -> str:
    return SPACE.sub(" ", entities.unescape("".join(pieces))).strip()


def parse(source: str | None) -> list[tuple[str, int, list[int]]]:
    """Blocks (text, place, hashes of the subtrees around it) that no dropped element holds.

    A class drops no article: what an article holds inside a container of such a class has place LATE, for
    pages without any other article.  Markup that is not closed ends with the page; text without any element is one block.
    """
    source = source or ""
    stack = [Element("", KEPT, OUTSIDE)]
    blocks: list[tuple[str, int]] = []
    around: list[list[int]] = []
    pieces: list[str] = []

    def end_block() -> None:
        if pieces:
            if text := clean(pieces):
                top = stack[-1]
                for e in stack:
                    e.text.append(text)
                if not top.drop:
                    blocks.append((text, top.place))
                    around.append([])
                    for e in stack[1:]:
                        e.blocks.append(len(blocks) - 1)
            pieces.clear()

    def pop() -> None:
        e = stack.pop()
        if e.name in BLOCK and e.text and e.name not in ("html", "body"):
            h = xxhash.xxh64_intdigest("\x00".join([e.name, *e.text]).encode("utf-8", "surrogatepass"), 1) >> 1
            for k in e.blocks:
                around[k].append(h)

    at = 0
    for m in TOKEN.finditer(source):
        if m.start() > at:
            pieces.append(source[at : m.start()])
        at = m.end()
        if m[3]:
            name = m[3].lower()
            if name in VOID:
                if name == "hr":
                    end_block()
                else:
                    pieces.append(" " if name == "br" else "")
                continue
            if name in BLOCK:
                end_block()
                if name in CLOSES_P:
                    _close(stack, "p", pop, end_block)
                if name in ("li", "dd", "dt", "tr", "td", "th", "option"):
                    _close(stack, name, pop, end_block, stop=("ul", "ol", "dl", "table"))
            elif name not in DROPPED:
                continue
            top = stack[-1]
            drop, place = top.drop, top.place
            if name in ("article", "main"):
                place = LATE if place == LATE or drop == CLASS else ARTICLE
                drop = KEPT if drop == CLASS else drop
            elif name in DROPPED and not (name == "header" and place):
                drop = NAME
            elif name not in ("html", "body") and signed(name, m[4]):
                drop = max(drop, CLASS)
            if m[4] and HIDDEN.search(m[4]):
                drop = NAME
            stack.append(Element(name, drop, place))
        elif m[2]:
            name = m[2].lower()
            if name in BLOCK or name in DROPPED:
                end_block()
                _close(stack, name, pop, end_block, stop=())
    if at < len(source):
        rest = source[at:]
        pieces.append(rest)
    end_block()
    while len(stack) > 1:
        pop()
    return [(text, place, hs) for (text, place), hs in zip(blocks, around, strict=True)]


def main_blocks(source: str | None) -> tuple[list[tuple[str, list[int]]], bool]:
    """Blocks (text, subtree hashes) of the article, or of the whole page if it marks none, and whether it does."""
    found = parse(source)
    best = max((place for _, place, _ in found), default=OUTSIDE)
    return [(text, around) for text, place, around in found if place == best], best != OUTSIDE


def signatures(texts: list[str]) -> list[int]:
    """Min-hashes of the shingles of five words: near copies mostly agree in them, pages that share a template do not."""
    words = " ".join(texts).encode("utf-8", "surrogatepass").split()
    runs = {b" ".join(words[k : k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1))}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, runs), dtype=np.uint64, count=len(runs))
    mixed = [(hashes ^ (hashes >> np.uint64(31 + k))) * np.uint64(0x9E3779B97F4A7C15 + 2 * k) for k in range(SEEDS)]
    return [int(x.min() >> np.uint64(1)) for x in mixed]


def _close(stack: list[Element], name: str, pop, end_block, stop: tuple[str, ...] | None = None) -> None:
    """Ends the open element ``name`` and what is open inside it, if there is one in scope."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name == name:
            end_block()
            while len(stack) > k:
                pop()
            return
        if stack[k].name in (SCOPES if stop is None else stop):
            return


def host_of(url: Column) -> Column:
    """Host in lower case, null without one; pages without a host form one site."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for source in batch["html"]:
            blocks, marked = main_blocks(source)
            rows.append((marked, signatures([text for text, _ in blocks]), [{"text": text, "around": around} for text, around in blocks]))
        out = pd.DataFrame(rows, columns=["marked", "signatures", "blocks"])
        yield pd.concat([batch[["page_id", "url"]].reset_index(drop=True), out], axis=1)


def different(rows: DataFrame, *keys: str) -> DataFrame:
    """Number ``n`` of different pages for each value of ``keys``: the most that any min-hash tells apart."""
    each = rows.select(*keys, F.posexplode("signatures").alias("seed", "signature")).distinct()
    return each.groupBy(*keys, "seed").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max("n").alias("n"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page row.

    Null and empty pages, and pages of template only, have an empty text; very long pages are read whole.
    Repeated rows and near copies are extracted each, but count about once as evidence of a template; a
    subtree at exactly ``min_pages`` pages, or exactly SHARE of them, goes.  Null ids and urls stay; pages
    without a host form one site.  An empty table gives no rows.  Only page_id, url and html are read, so
    further columns cannot clash.
    """
    schema = "page_id long, url string, marked boolean, signatures array<long>, blocks array<struct<text:string,around:array<long>>>"
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInPandas(_parsed, schema)
    # pages of a host that mark an article and those that do not are two sites
    site = F.xxhash64(host_of(F.col("url")), "marked")
    parsed = materialise(read.withColumn("site", site).withColumn("row", F.monotonically_increasing_id()), "pages")
    each = parsed.select("row", "site", "marked", "signatures", F.explode(F.array_distinct(F.flatten("blocks.around"))).alias("hash"))
    subtrees = each.withColumn("subtree", F.xxhash64("site", "hash"))
    # what stands on too few pages, equal ones counted too, is no template; few subtrees are left to look at
    often = materialise(subtrees.groupBy("subtree").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages).select("subtree"), "often")
    common = materialise(subtrees.join(often, "subtree", "left_semi").select("row", "site", "marked", "signatures", "hash", "subtree"), "common")
    counts = different(common, "subtree", "site", "marked").filter(F.col("n") >= min_pages)
    sites = different(parsed.select("site", "signatures"), "site").select("site", F.col("n").alias("pages"))
    template = counts.join(sites, "site").filter(~F.col("marked") | (F.col("n") >= SHARE * F.col("pages")))
    template = materialise(template.select("subtree"), "template")
    # written first, so that a small table is broadcast and the texts are not shuffled
    hit = materialise(common.join(template, "subtree", "left_semi").groupBy("row").agg(F.collect_set("hash").alias("bad")), "hit")
    discard(often, common, template)
    own = F.filter("blocks", lambda b: ~F.arrays_overlap(b["around"], F.coalesce("bad", F.array().cast("array<long>"))))
    done = parsed.join(hit, "row", "left").select("page_id", "url", F.array_join(F.transform(own, lambda b: b["text"]), "\n\n").alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
