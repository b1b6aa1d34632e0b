"""Main text of web pages by site template removal.

Every element subtree that could be a part of a site's template is hashed twice: by what
it says, and by its skeleton, the tags and names it is made of and stands in. Hashes are
counted per host over the host's different pages. A subtree is deleted if its words recur
on several of them, or if its skeleton does and is no prose there: mostly links, or a few
words outside paragraphs and headings, and seldom a page's main part. What a host shows
on a few pages only is told by its tags, roles and class names. Then the article is taken
where the page marks one, else its main part, else the rest of the body; several articles
that say less than the rest are cards that point elsewhere. Prose inside an article, or
inside the innermost element with half of a page's prose where none is marked, is never a
template: pages that quote or copy each other keep their text.
"""

from __future__ import annotations

import re
from collections.abc import Container, Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import identified, slices, small, stored, take

#: Elements by what they are in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
DROPPED = set(
    "aside button canvas datalist dialog fieldset footer form head label menu nav noscript object option output "
    "search select svg template".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = set("aside center details div dl figure footer form header menu nav ol section table ul".split())
PROSE = set("blockquote h1 h2 h3 h4 h5 h6 p pre".split())
#: Elements that an opening tag ends, and those it does not look beyond.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements inside of which a paragraph may stay open: blocks that themselves end one do not.
KEEP_P = set("caption dd dt html body legend li summary tbody td tfoot th thead tr option".split())
#: Roles, and words of class names and ids, of what is not the article.
ROLES = set("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
NAMES = set(
    "ad ads adbox adcontainer adslot adsense adunit advert advertisement advertisements advertising adverts alert "
    "announcement announcements banner banners breadcrumb breadcrumbs comment commentlist comments consent cookie "
    "cookies disqus footer gdpr interstitial login masthead menu menus modal nav navbar navigation navmenu newsletter "
    "notice notices notification notifications overlay pager pagination paywall popup popups promo promos promoted "
    "promotion recommended related replies reply responses share sharing sidebar sidebars sidenav signin signup "
    "sitemap skip social sponsor sponsored sponsors subnav subscribe subscription teaser teasers toolbar topbar topnav "
    "widget widgets".split()
)
#: Words that leave a name's meaning as it is, and first words that deny it.
PLAIN = set(
    "area bar block bottom box col container fixed group inner item items left link links list menu module outer "
    "panel right row section slot sticky text top unit wrap wrapper".split()
)
ABOUT = set("has hide is no not with without".split())
_SKIPPED = r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
_NAME = r"<(/?)([A-Za-z][^\s/>]*)"
_QUOTED = r"(?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*+"
#: A tag ends at the first > outside quotes, or, where a quote never closes, at the first >.
TOKEN = re.compile(rf"{_SKIPPED}|{_NAME}({_QUOTED})>|{_NAME}([^>]*)>", re.S)
#: The same for tags that begin before a quote that never closes,
CHEAP = re.compile(rf"{_SKIPPED}|{_NAME}([^>]*)>", re.S)
#: and behind the page's last >.
LAST = re.compile(r"<!--.*|<!\[CDATA\[.*()()()", re.S)
QUOTED = re.compile(_QUOTED, re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Bytes of pages parsed at a time.
PART = 8 << 20


def named(value: str, inside: bool) -> int:
    """2 if a class or id names furniture, 1 if it only holds such a word, else 0."""
    found = 0
    for name in value.split():
        words = re.findall(r"[a-z]+", HUMP.sub(" ", name).lower())
        known = [w in NAMES or (w == "header" and not inside) for w in words]
        if any(known) and words[0] not in ABOUT:
            plain = all(k or w in PLAIN for k, w in zip(known, words, strict=True))
            found = max(found, 2 if known[-1] or plain else 1)
    return found


def unwanted(tag: str, attributes: str, inside: bool) -> int:
    """Whether tag, role, or names say that an element is not a part of the article.

    2: it is not. 1: a name hints at it, which an article, a main part or prose in it refutes.
    """
    if tag in DROPPED or (tag == "header" and not inside):
        return 2
    if not attributes or tag in ("html", "body", "main"):
        return 0
    found = 0
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            found = max(found, named(value, inside))
        elif (
            (name == "role" and value.lower() in ROLES)
            or name == "hidden"
            or (name == "aria-hidden" and value.lower() == "true")
            or (name == "style" and re.search(r"display\s*:\s*none", value, re.I))
        ):
            return 2
    return 0 if found == 1 and (tag == "article" or tag in PROSE) else found


def label(tag: str, attributes: str) -> str:
    """An element's tag and names, numbers aside, as a part of a skeleton."""
    names = set()
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        if name.lower() in ("class", "id", "role"):
            names.update(re.sub(r"[0-9]+", "", v) for v in "".join(values).split())
    return " ".join([tag, *sorted(names)])


class Element:
    """An open element."""

    __slots__ = ("tag", "gone", "hint", "level", "block", "word", "label", "path", "parts", "said")

    def __init__(self, tag: str, gone: bool, hint: bool, level: int, block: int, word: int, label: str, path: int, said: tuple[int, int, int]):
        self.tag, self.gone, self.hint, self.level = tag, gone, hint, level
        self.block, self.word = block, word  # how many blocks and words came before it
        self.label, self.path, self.said = label, path, said
        self.parts: list[str] = []  # skeletons of its children, runs of equal ones as one

    def add(self, part: str) -> None:
        if not self.parts or self.parts[-1] != part:
            self.parts.append(part)


class Subtree(NamedTuple):
    """A closed element that may be a template: where it is, and what it says."""

    text: int  # hash of tags and words
    shape: int  # hash of its skeleton and the path to it
    tag: str
    named: bool
    level: int
    first: int  # its blocks and its words, by the places of the first and behind the last
    last: int
    start: int
    end: int
    words: int
    linked: int
    prose: int


class Page:
    """One pass over a page's tags: its text blocks and its candidate subtrees."""

    def __init__(self, html: str, templates: Container[int] | None = None, seed: int = 0):
        self.seed = seed
        self.blocks: list[tuple[str, int, bool] | None] = []  # text, 2 in an article or 1 in a main part, whether prose
        self.subtrees: list[Subtree] = []
        self.words: list[str] = []  # tags and texts so far, for hashing
        self.buffer: list[str] = []
        self.said = (0, 0, 0)  # words so far: all, in links, in prose elements
        self.links = self.prose = self.articles = 0
        self.body = xxhash.xxh64()  # of the texts in prose elements
        self.stack = [Element("", False, False, 0, 0, 0, "", 0, self.said)]
        at = 0
        lower = None
        unclosed, last = 0, html.rfind(">")
        while (m := (LAST if at > last else CHEAP if at < unclosed else TOKEN).search(html, at)) is not None:
            if m.start() > at:
                self.text(html[at : m.start()])
            at = m.end()
            if m.re is TOKEN and m[5]:
                # Behind it no such quote follows, so that a page is scanned in vain twice at most.
                unclosed = QUOTED.match(html, m.end(5)).end()
            slash, tag, attributes = m.groups()[:3] if m[2] else m.groups()[-3:]
            tag = (tag or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self.text(m[0][9:].removesuffix("]]>"), decode=False)
            elif slash:
                self.end(tag)
            elif tag in RAW:
                lower = html.lower() if lower is None or len(lower) != len(html) else lower
                close = (lower if len(lower) == len(html) else html).find(f"</{tag}", at)
                at = len(html) if close < 0 else html.find(">", close) + 1 or len(html)
            else:
                self.start(tag, attributes)
        self.text(html[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush()
        if templates:
            for node, _, tree in self.nodes():
                if node in templates:
                    self.remove(tree.first, tree.last)

    def text(self, raw: str, decode: bool = True) -> None:
        if raw:
            text = unescape(raw) if decode and "&" in raw else raw
            self.words.append(text)
            if n := len(text.split()):
                words, linked, prose = self.said
                self.said = (words + n, linked + n * (self.links > 0), prose + n * (self.prose > 0))
                self.stack[-1].add("")
                if self.prose:
                    self.body.update(" ".join(text.split()).encode("utf-8", "surrogatepass"))
            if not self.stack[-1].gone:
                self.buffer.append(text)

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.blocks.append((text, self.stack[-1].level, self.prose > 0))

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            if tag not in KEEP_P:
                self.close({"p"}, BLOCKS - {"p"})
            if tag in ENDS:
                self.close(*ENDS[tag])
            self.flush()
        elif tag == "br":
            self.text(" ")
        if tag in VOID:
            return
        outer = self.stack[-1]
        level = outer.level
        found = unwanted(tag, attributes, level == 2)
        gone = outer.gone or found == 2
        if not gone and tag == "article":
            self.articles += level < 2
            level = 2
        elif not gone and (tag == "main" or re.search(r"role\s*=\s*[\"']?main\b", attributes, re.I)):
            level = max(level, 1)
        name = label(tag, attributes)
        path = xxhash.xxh64_intdigest(outer.label, outer.path)
        at = (len(self.blocks), len(self.words))
        self.stack.append(Element(tag, gone, found == 1, level, *at, name, path, self.said))
        self.words.append(f"<{tag}>")
        self.links += tag == "a"
        self.prose += tag in PROSE

    def close(self, tags: set[str], stops: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i].tag in stops:
                return

    def end(self, tag: str) -> None:
        self.close({tag}, set() if tag in BLOCKS else BLOCKS)

    def pop(self) -> None:
        own = self.stack[-1]
        tag = own.tag
        if tag in BLOCKS:
            self.flush()
        self.links -= tag == "a"
        self.prose -= tag in PROSE
        self.stack.pop()
        said = tuple(a - b for a, b in zip(self.said, own.said, strict=True))
        # Inline markup without names is no part of a skeleton.
        plain = own.label == tag and tag != "a" and tag not in BLOCKS
        skeleton = f"{own.label}({','.join(own.parts)})"
        if len(skeleton) > 64:
            skeleton = f"{own.label}({xxhash.xxh64_hexdigest(skeleton)})"
        for part in own.parts if plain else (skeleton,):
            self.stack[-1].add(part)
        if not said[0]:
            return
        blocks = [block for block in self.blocks[own.block :] if block]
        if own.hint and not any(level > self.stack[-1].level or prose for _, level, prose in blocks):
            self.remove(own.block, len(self.blocks))
        if tag in CONTAINERS or tag == "main" or (tag in PROSE and own.level < 2):
            body = " ".join("".join(self.words[own.word :]).split())
            text = xxhash.xxh64_intdigest(body, self.seed) - (1 << 63)
            path = xxhash.xxh64_intdigest(own.path.to_bytes(8, "big"), self.seed)
            shape = xxhash.xxh64_intdigest(skeleton, path) - (1 << 63)
            place = (own.block, len(self.blocks), own.word, len(self.words))
            self.subtrees.append(Subtree(text, shape, tag, own.label != tag, own.level, *place, *said))

    def remove(self, first: int, last: int) -> None:
        self.blocks[first:last] = [None] * (last - first)

    def nodes(self) -> Iterator[tuple[int, bool, Subtree]]:
        """Hashes that may be a template's, and whether they are a skeleton's."""
        half = [t for t in self.subtrees if t.tag not in PROSE and 2 * t.prose >= self.said[2] > 0]
        body = min(half, key=lambda t: t.end - t.start, default=None)
        for tree in self.subtrees:
            inside = tree.level == 2 or (body and body.start < tree.start and tree.end <= body.end)
            if tree.tag == "main":
                continue
            if not inside or (tree.tag in CONTAINERS and not tree.prose):
                yield tree.text, False, tree
            if tree.tag in CONTAINERS and (not inside or (tree.named and 2 * tree.linked >= tree.words)):
                yield tree.shape, True, tree

    def counted(self) -> dict[int, list[int]]:
        """By hash: whether of a skeleton, how often it occurs, its words (all, in links, in
        prose elements), and whether one of its subtrees is the page's main part: holds half
        of the words outside links."""
        rest = self.said[0] - self.said[1]
        out: dict[int, list[int]] = {}
        for node, shape, tree in self.nodes():
            row = out.setdefault(node, [int(shape), 0, 0, 0, 0, 0])
            for i, n in enumerate((1, tree.words, tree.linked, tree.prose), 1):
                row[i] += n
            row[5] |= 2 * (tree.words - tree.linked) >= rest > 0
        return out

    def own(self, html: str) -> int:
        """A hash of what the page says in prose, or of all of it where it has none."""
        return (self.body.intdigest() if self.said[2] else xxhash.xxh64_intdigest(html)) - (1 << 63)

    def main_text(self) -> str:
        blocks = [block for block in self.blocks if block]
        if self.articles > 1:
            cards = sum(len(text) for text, level, _ in blocks if level == 2)
            if cards < sum(len(text) for text, level, prose in blocks if level < 2 and prose):
                blocks = [block for block in blocks if block[1] < 2]
        best = max((level for _, level, _ in blocks), default=0)
        return "\n".join(text for text, level, _ in blocks if level == best)


class Sorted:
    """Membership in a sorted array: a set of millions would take ten times its bytes."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def __contains__(self, value: int) -> bool:
        at = int(self.values.searchsorted(value))
        return at < len(self.values) and int(self.values[at]) == value


def _host() -> Column:
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(host, F.lit(""))


#: Columns of the counted subtrees, after host, node and page.
COUNTS = ("shape", "times", "words", "linked", "prose", "main")


def _subtrees(rows: DataFrame, *keys: str) -> DataFrame:
    """The key columns, node, page (a hash of its prose), and COUNTS, of rows (host, html, *keys)."""
    schema = rows.select(*keys, F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("page")).schema
    for name in COUNTS:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch.column(1)), PART):
                rows, found = [], []
                for i, (host, html) in enumerate(zip(*(c.to_pylist() for c in part.columns[:2]), strict=True)):
                    page = Page(html, seed=xxhash.xxh64_intdigest(host))
                    own = page.own(html)
                    for node, counts in page.counted().items():
                        rows.append(i)
                        found.append((node, own, *counts))
                kept = pa.RecordBatch.from_arrays(part.columns[2:], names=list(keys)).take(pa.array(rows, pa.int64()))
                values = zip(*found, strict=True) if found else [()] * (2 + len(COUNTS))
                columns = [pa.array(v, pa.int64()) for v in values]
                yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=schema.names)

    return rows.select("host", "html", *[F.col(k) for k in keys]).mapInArrow(run, schema)


def templates(pages: DataFrame, min_pages: int = 5, few_words: int = 30) -> DataFrame:
    """(node, n): hashes, which cover the host, of the subtrees that are a site's template.

    n different pages of the host have it, min_pages at least. A subtree that is alike by
    its skeleton alone must also be no prose, over all its occurrences: half of its words
    in links, or at most few_words words, a tenth of them in paragraphs or headings, and
    two occurrences a page; and be the main part of at most half of its pages. Pages of
    the same prose count once, whatever is around it.
    """
    rows = take(pages, "url", "html").where("html is not null").select(_host().alias("own"), "html")
    rows = _subtrees(rows.select("own", "html", F.col("own").alias("host")), "own")
    rows = rows.groupBy("own", "node", "page", "shape").agg(*[F.max(c).alias(c) for c in COUNTS[1:]])
    sums = [F.sum(c).alias(c) for c in COUNTS[1:]]
    counts = rows.groupBy("own", "node", "shape").agg(F.count("*").alias("n"), *sums)
    short = f"10 * prose <= words and words <= {int(few_words)} * times and times <= 2 * n"
    alike = f"2 * main <= n and (2 * linked >= words or ({short}))"
    return counts.where(f"n >= {int(min_pages)} and (shape = 0 or ({alike}))").select("node", "n")


def _told(rows: DataFrame, sites: DataFrame, split: int) -> DataFrame:
    """rows with `nodes`: the templates among the subtrees of each page, by shuffle.

    A template of more than `split` pages is spread over as many tasks as that fills;
    there are at most subtrees / split such templates.
    """
    heavy = sites.where(F.col("n") > split).select("node", F.ceil(F.col("n") / split).cast("int").alias("parts"))
    own = _subtrees(rows.where("html is not null"), "file", "at").select("file", "at", "node")
    own = own.join(small(heavy), "node", "left")
    own = own.withColumn("salt", F.pmod(F.xxhash64("file", "at"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    salts = F.sequence(F.lit(0), (F.ceil(F.col("n") / split) - 1).cast("int"))
    told = own.join(sites.select("node", F.explode(salts).alias("salt")), ["node", "salt"])
    told = told.groupBy("file", "at").agg(F.collect_list("node").alias("nodes"))
    return rows.join(told, ["file", "at"], "left").select("page_id", "url", "html", "host", "nodes")


def main_texts(pages: DataFrame, broadcast_nodes: int = 4_000_000, split: int = 1_000_000, **limits) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html).

    A null or empty html, and a page of templates only, has an empty text. Pages without
    a url share the host ''. Repeated rows stay rows. The templates are counted, and
    broadcast up to broadcast_nodes hashes (8 bytes each); beyond, they are joined with the
    subtrees of each page by shuffle.
    """
    spark = pages.sparkSession
    sites = stored(templates(pages, **limits), "html-templates")
    known = None
    if sites.count() <= broadcast_nodes:
        known = spark.sparkContext.broadcast(np.sort(sites.select("node").toPandas()["node"].to_numpy("int64")))
        rows = take(pages, "page_id", "url", "html").select("*", _host().alias("host"), F.lit(None).cast("array<long>").alias("nodes"))
    else:
        rows = _told(identified(pages, "page_id", "url", "html").withColumn("host", _host()), sites, split)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "text", "n_chars"]
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch.column(2)), PART):
                texts = []
                for html, host, nodes in zip(*(c.to_pylist() for c in part.columns[2:]), strict=True):
                    deleted = frozenset(nodes or ()) if known is None else Sorted(known.value)
                    texts.append(Page(html or "", deleted, xxhash.xxh64_intdigest(host)).main_text())
                sizes = pa.array(map(len, texts), pa.int64())
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
