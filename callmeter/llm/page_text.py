"""Main text of web pages by template deduction from equivalence classes of tokens.

After Arasu and Garcia-Molina, "Extracting Structured Data from Web Pages"
(SIGMOD 2003). A page's tokens are its block elements and its blocks of text,
each told apart by the path of elements around it. Over the pages of a host:

1. A token's occurrence vector is its count on each distinct page. Tokens of
   equal vectors that occur on nearly all pages are an equivalence class.
2. A class is put in order by the mean place of its tokens. A pair of
   neighbours in that order holds on a page if their occurrences alternate and
   no occurrence of another class is cut apart between them: what lies between
   are whole tuples of it, so that classes nest. A class falls into the
   longest parts whose pairs hold on nearly all pages, ``SUPPORT`` of them; a
   part of one token proves nothing and is no template. So odd pages void
   nothing, and a token that is frequent by chance, with a vector of its own
   or in no fixed place, is data.
3. The parts are the template. What a page holds between their tokens are its
   slots; text that is itself a template token is no data, which a paragraph
   that all pages share, once each, is too: it cannot be told from a notice.
   Of the slots those of the article are returned: inside ``article`` or
   ``main`` where a page has one, unless these are cards beside a longer text
   of its own, otherwise all inside the containers of the slots that hold a
   good share of the host's text.

Elements that are never part of an article (menus, headers, footers, sidebars,
notices, adverts, comments) are left out by their name, role, class or id;
forms, hidden elements and those marked by class or id not where they hold the
article element or most of the page's text. A paragraph, heading or list item
is left out by a class only if that names it as a whole. Headings and
paragraphs inside an article are data even where they repeat, as copies of an
article do. A host with fewer than ``LEAST_PAGES`` distinct pages has no
template, since of two pages none tells a template from a paragraph they
share; its pages' articles follow from the elements alone.

A page is parsed once; its tokens and blocks are stored, and all steps read
those. Null html gives an empty text; a null url is a host of its own. Ids play
no part; repeated pages have a result each and count as one page of their host.
An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import os
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callmeter.operators.durable import cut_lineage, ensure_checkpoint_dir

LEAST_PAGES = 3
# A template token occurs on at least this share of a host's pages.
SUPPORT = 0.9
# The slots with this share of the text of the host's largest slot show where the article is, where no element does.
SLOT_SHARE = 0.1
# Templates up to this size in all are broadcast; larger ones are joined by host.
BROADCAST_BYTES = 32 << 20

# Names of elements, and words of roles, classes and ids.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption article main section".split())
# Of these, those that hold sentences.
SENTENCES = PROSE - {"article", "main", "section"}
# Elements of running text, and cells, which may be those of a layout: all others are containers.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 hgroup blockquote pre li ul ol dl dt dd figure figcaption table thead tbody tfoot tr html body".split())
CELLS = frozenset(["td", "th"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes svg math canvas audio video object select".split())
# Of these, those with nothing else in them: without an end tag they reach to the end of the page.
TEXT_ONLY = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
FOREIGN = frozenset(["svg", "math"])
OPTIONS = frozenset(["option", "optgroup"])
LEFT_OUT = frozenset("nav header footer aside menu dialog button head datalist".split())
# Left out as well, but for what holds the article or most of the text.
MARKED = frozenset(["form"])
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget widgets".split()
)
CLOSED_BY = {
    "p": BLOCKS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|</?[a-zA-Z][^<>]*+\Z""",
    re.S,
)
# Elements that end an svg or math element that is still open, and those inside which they do not.
_BREAKOUT = re.compile(r"<(?:/p|p|div|h[1-6]|ul|ol|li|dl|dd|dt|table|pre|blockquote|center|body|hr|img|br|span|b|i|em|strong)(?=[\s/>])", re.I)
_HTML_INSIDE = re.compile(r"<(?:foreignobject|desc|annotation-xml|mtext|mi|mo|mn|ms)\b", re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """A block of text: its place among the page's tokens, and what is known of it."""

    text: str
    token: int
    place: int
    left_out: bool
    in_article: bool
    prose: bool
    # Elements around it that class words would leave out.
    marks: tuple[int, ...]
    # Numbers of the containers around it, from the outermost; cells are negative.
    inside: tuple[int, ...]
    # Which of the page's outermost articles holds it, from 1 on; 0 for none.
    article: int = 0


@dataclass
class _Open:
    name: str
    path: str
    left_out: bool
    in_article: bool
    inside: tuple[int, ...] = ()
    marks: tuple[int, ...] = ()
    article: int = 0


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _is_left_out(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in LEFT_OUT and not (name == "header" and in_article):
        return True
    if attributes.get("role", "").lower() in LEFT_OUT_ROLES:
        return True
    return False


def _is_marked(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is left out unless it holds the article or most of the page's text."""
    if name in MARKED:
        return True
    if name in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    # A part of a name says what a container holds, but not what a paragraph is.
    words = named.split() if name in SENTENCES else _WORDS.findall(named)
    return not LEFT_OUT_WORDS.isdisjoint(words)


class Parser:
    """One page: ``tags``, the keys of its block elements in order, and ``blocks``."""

    def __init__(self, html: str):
        self.tags: list[int] = []
        self.blocks: list[Block] = []
        self._stack = [_Open("", "", False, False)]
        self._text: list[str] = []
        self._ends: dict[str, dict[int, int]] = {}
        self._marked = self._outermost = 0
        # Marks around each outermost article or main element that has no class word itself.
        self._articles: list[tuple[int, ...]] = []
        self._read(html)
        self._leave_out()

    def _read(self, html: str) -> None:
        at = 0
        while True:
            m = _TAG.search(html, at)
            self._text.append(html[at : m.start() if m else len(html)])
            if m is None:
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(name)
                continue
            self._open(name, m[3] or m[6] or "")
            if name in TEXT_ONLY:
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif name in RAW:
                at = self._end(html, name, m.start(), at)
            elif name in OPTIONS:
                after = html.find("<", at)
                at = after if after >= 0 else len(html)
        self._flush()

    def _end(self, html: str, name: str, start: int, at: int) -> int:
        """Where the element that starts at ``start`` ends: at its own end tag, or with its start tag, at ``at``, if it has none."""
        if name not in self._ends:
            ends, opened = {}, []
            for m in re.compile(rf"<(/?){name}(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>", re.I).finditer(html):
                if not m[1]:
                    if not (name in FOREIGN and m[0].endswith("/>")):
                        opened.append(m.start())
                elif opened:
                    ends[opened.pop()] = m.end()
            self._ends[name] = ends
        end = self._ends[name].get(start, at)
        if name in FOREIGN and end > at:
            breakout = _BREAKOUT.search(html, at, end)
            if breakout and not _HTML_INSIDE.search(html, at, breakout.start()):
                return at
        return end

    def _leave_out(self) -> None:
        """Leave out what class words mark, but no element that holds the article or most of the page's text."""
        chars: Counter = Counter()
        total = 0
        for block in self.blocks:
            if not block.left_out:
                total += len(block.text)
                for mark in block.marks:
                    chars[mark] += len(block.text)
        kept = {mark for mark, n in chars.items() if 2 * n > total}
        fewest = min(map(len, self._articles), default=0)
        kept.update(mark for marks in self._articles if len(marks) == fewest for mark in marks)
        for block in self.blocks:
            block.left_out = block.left_out or not kept.issuperset(block.marks)

    def _flush(self) -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(self._text))).strip()
        self._text = []
        if text:
            top = self._stack[-1]
            token = _key(f"{top.path}\0{text}")
            self.blocks.append(Block(text, token, len(self.tags), top.left_out, top.in_article, top.name in PROSE, top.marks, top.inside, top.article))

    def _open(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text.append(" ")
        if name in VOID - {"hr"} or name in OPTIONS:
            return
        block = name in BLOCKS
        if name == "label" and any(o.name in MARKED for o in self._stack) and self._stack[-1].name not in SENTENCES:
            # The name of a field; in a sentence a label is a part of it.
            self._flush()
            self._marked += 1
            top = self._stack[-1]
            self._stack.append(_Open(name, top.path, top.left_out, top.in_article, top.inside, (*top.marks, self._marked), top.article))
            return
        if name in RAW or not block and name not in LEFT_OUT and "=" not in attributes and "hidden" not in attributes:
            return
        parts = _attributes(attributes) if attributes else {}
        marked = _is_marked(name, parts)
        if not block and not marked and not _is_left_out(name, parts, self._stack[-1].in_article):
            return
        self._flush()
        if block:
            while name in CLOSED_BY.get(self._stack[-1].name, ()):
                self._stack.pop()
        if name == "hr":
            return
        top = self._stack[-1]
        in_article = top.in_article or name in ("article", "main")
        left_out = top.left_out or _is_left_out(name, parts, top.in_article)
        path = f"{top.path}/{name}.{parts.get('class', '')}#{parts.get('id', '')}" if block else top.path
        inside = top.inside
        if block and name not in FLOW:
            inside += (-1 - len(self.tags) if name in CELLS else 1 + len(self.tags),)
        if in_article and not (top.in_article or left_out or marked):
            self._articles.append(top.marks)
        if marked:
            self._marked += 1
        marks = (*top.marks, self._marked) if marked else top.marks
        article = top.article
        if in_article and not top.in_article:
            self._outermost += 1
            article = self._outermost
        self._stack.append(_Open(name, path, left_out, in_article, inside, marks, article))
        if block:
            self.tags.append(_key(path))

    def _close(self, name: str) -> None:
        depth = next((i for i in range(len(self._stack) - 1, 0, -1) if self._stack[i].name == name), 0)
        if depth:
            # An inline element does not close the blocks opened inside it.
            if name not in BLOCKS and any(x.name in BLOCKS for x in self._stack[depth + 1 :]):
                return
            self._flush()
            del self._stack[depth:]
        elif name in BLOCKS:
            self._flush()


@dataclass
class Page:
    """What is kept of a parsed page: its tokens in order, tags and candidate blocks, and the blocks that are not left out.

    ``place`` is where a block stands among the tokens, ``tag`` how many of
    them are tags, by their places.
    """

    tokens: np.ndarray
    is_tag: np.ndarray
    blocks: list[Block]


def _stored(page: Parser) -> tuple[list[int], list[bool], list[Block]]:
    """Tokens in page order, which of them are tags, and the blocks to keep, their ``place`` among the tokens."""
    tokens: list[int] = []
    is_tag: list[bool] = []
    kept = []
    at = 0
    for block in page.blocks:
        tokens += page.tags[at : block.place]
        is_tag += [True] * (block.place - at)
        at = block.place
        if not block.left_out:
            block.place = len(tokens)
            kept.append(block)
        if not (block.in_article and block.prose):
            tokens.append(block.token)
            is_tag.append(False)
    return tokens + page.tags[at:], is_tag + [True] * (len(page.tags) - at), kept


def read_page(html: str) -> Page:
    tokens, is_tag, blocks = _stored(Parser(html))
    return Page(np.array(tokens, np.int64), np.array(is_tag, bool), blocks)


_BLOCK = pa.struct(
    [
        ("text", pa.string()),
        ("token", pa.int64()),
        ("place", pa.int32()),
        ("in_article", pa.bool_()),
        ("prose", pa.bool_()),
        ("inside", pa.list_(pa.int32())),
        ("article", pa.int32()),
    ]
)
_PARSED = (
    "host string, tokens array<long>, tags array<boolean>, "
    "blocks array<struct<text:string,token:long,place:int,in_article:boolean,prose:boolean,inside:array<int>,article:int>>"
)


def _parse(pages: DataFrame) -> DataFrame:
    """Each page parsed, stored as Parquet: row, page_id, url, hash of its html, host, tokens, tags and blocks."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        "url",
        F.xxhash64("html").alias("page"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.col("html").alias("__html"),
    )
    schema = StructType([*rows.schema.fields[:4], *StructType.fromDDL(_PARSED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Blocks hold their texts, so batches stay as small as those that come in.
            parsed = [_stored(Parser(html or "")) for html in batch.column(5).to_pylist()]
            blocks = [
                [{n: getattr(b, n) for n in ("text", "token", "place", "in_article", "prose", "inside", "article")} for b in p[2]]
                for p in parsed
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array([p[0] for p in parsed], pa.list_(pa.int64())),
                    pa.array([p[1] for p in parsed], pa.list_(pa.bool_())),
                    pa.array(blocks, pa.list_(_BLOCK)),
                ],
                names=schema.names,
            )

    folder = f"{ensure_checkpoint_dir(pages.sparkSession)}/pages-{uuid.uuid4().hex}"
    rows.mapInArrow(run, schema).write.parquet(folder)
    return pages.sparkSession.read.schema(schema).parquet(folder)


def _distinct_pages(parsed: DataFrame) -> DataFrame:
    """(row, host, tokens) of one page of each distinct html of a host."""
    first = parsed.groupBy("host", "page").agg(F.min("row").alias("row")).select("row")
    return cut_lineage(parsed.select("row", "host", "tokens").join(first, "row"))


def _occurrences(distinct: DataFrame) -> DataFrame:
    """Per host and token: pages it occurs on, fingerprint of its occurrence vector, sum of its first places. Token 0 counts pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0, 0, 0])
        for batch in batches:
            rows, hosts, all_tokens = (c.to_pylist() for c in batch.columns)
            for number, host, tokens in zip(rows, hosts, all_tokens, strict=True):
                own = sums[host, 0]
                own[0] += 1
                first = {token: place for place, token in reversed(list(enumerate(tokens)))}
                for token, n in Counter(tokens).items():
                    own = sums[host, token]
                    own[0] += 1
                    own[1] ^= _key(f"{number} {n}")
                    own[2] += first[token]
            if len(sums) > 1 << 18:
                yield _rows(sums)
                sums.clear()
        yield _rows(sums)

    def _rows(sums: dict) -> pa.RecordBatch:
        keys = [pa.array([h for h, _ in sums], pa.string()), pa.array([t for _, t in sums], pa.int64())]
        values = [pa.array([v[k] for v in sums.values()], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*keys, *values], names=["host", "token", "pages", "vector", "places"])

    found = distinct.mapInArrow(run, "host string, token long, pages long, vector long, places long")
    return found.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("places").alias("places")
    )


def _classes(distinct: DataFrame) -> DataFrame:
    """One row (host, classes) per host with enough pages: the token lists of its equivalence classes, each in order.

    A class of one token is none.
    """
    found = cut_lineage(_occurrences(distinct))
    hosts = found.filter((F.col("token") == 0) & (F.col("pages") >= LEAST_PAGES)).select("host", F.col("pages").alias("all_pages"))
    frequent = found.filter((F.col("token") != 0) & (F.col("pages") >= LEAST_PAGES * SUPPORT)).join(hosts, "host")
    frequent = frequent.filter(F.col("pages") >= SUPPORT * F.col("all_pages"))
    place = F.struct((F.col("places") / F.col("pages")).alias("place"), "token")
    lists = frequent.groupBy("host", "vector").agg(F.sort_array(F.collect_list(place)).alias("tokens")).filter(F.size("tokens") > 1)
    return lists.groupBy("host").agg(F.sort_array(F.collect_list(F.col("tokens.token"))).alias("classes"))


def _with_host_table(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Give each row the one other column of ``table`` for its ``host``, null if there is none."""
    table = cut_lineage(table.withColumnRenamed("host", "__of"))
    column = table.columns[1]
    flat = F.flatten(column) if table.schema[column].dataType.simpleString().startswith("array<array") else F.col(column)
    size = table.agg(F.sum(F.size(flat)) * 16 + F.sum(F.length("__of"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return rows.join(table, F.col("host") == F.col("__of"), "left").drop("__of")


def held_pairs(tokens: list[int], classes: list[list[int]]) -> list[list[bool]]:
    """For each class and each pair of neighbours in its order, whether the pair holds on a page.

    It holds if the two alternate, the first one first, and whatever token of
    another class occurs between two of them occurs there as often as all
    others of that class.
    """
    own = {token: k for k, c in enumerate(classes) for token in c}
    places: dict[int, list[int]] = defaultdict(list)
    for place, token in enumerate(tokens):
        if token in own:
            places[token].append(place)
    order = [(place, token) for token, at in places.items() for place in at]
    order.sort()
    rank = {place: k for k, (place, _) in enumerate(order)}
    # The stretch of each tuple of a class that is whole on this page.
    spans: list[tuple[int, int]] = []
    out = []
    for c in classes:
        at = [places.get(token, []) for token in c]
        if len({len(x) for x in at}) == 1 and at[0]:
            spans += [(rank[min(tuple_)], rank[max(tuple_)]) for tuple_ in zip(*at, strict=True)]
    for c in classes:
        held = []
        for a, b in zip(c[:-1], c[1:], strict=True):
            first, second = places.get(a, []), places.get(b, [])
            both = [x for pair in zip(first, second, strict=False) for x in pair]
            held.append(len(first) == len(second) and len(first) > 0 and all(x < y for x, y in zip(both[:-1], both[1:], strict=True)))
        out.append(held)
    ends = sorted(set(spans))
    for c, held in zip(classes, out, strict=True):
        for k, (a, b) in enumerate(zip(c[:-1], c[1:], strict=True)):
            if held[k]:
                held[k] = all(_is_whole(rank[x], rank[y], ends) for x, y in zip(places[a], places[b], strict=True))
    return out


def _is_whole(low: int, high: int, spans: list[tuple[int, int]]) -> bool:
    """Whether no tuple begins between two places and ends beyond them, unless it began before them too."""
    return not any(low < begin < high < end for begin, end in spans)


def _valid_parts(distinct: DataFrame, classes: DataFrame) -> DataFrame:
    """One row (host, template) per host: the tokens of its template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            for host, tokens, classes in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for number, held in enumerate(held_pairs(tokens, classes)):
                    sums[host, number, -1] += 1
                    sums.update((host, number, k) for k, holds in enumerate(held) if holds)
        keys = [[key[i] for key in sums] for i in range(3)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[0], pa.string()), *(pa.array(k, pa.int64()) for k in keys[1:]), pa.array(list(sums.values()), pa.int64())],
            names=["host", "class", "pair", "pages"],
        )

    rows = _with_host_table(distinct, classes).filter(F.col("classes").isNotNull()).select("host", "tokens", "classes")
    counts = rows.mapInArrow(run, "host string, class long, pair long, pages long")
    counts = cut_lineage(counts.groupBy("host", "class", "pair").agg(F.sum("pages").alias("pages")))
    whole = counts.filter("pair = -1").select("host", "class", F.col("pages").alias("all_pages"))
    held = counts.filter("pair >= 0").join(whole, ["host", "class"]).filter(F.col("pages") >= SUPPORT * F.col("all_pages"))
    # Both tokens of a pair that holds belong to a part of two or more.
    listed = classes.select("host", F.posexplode("classes").alias("class", "tokens"))
    both = held.join(listed, ["host", "class"]).select(
        "host", F.explode(F.array(F.get("tokens", F.col("pair").cast("int")), F.get("tokens", F.col("pair").cast("int") + 1))).alias("token")
    )
    return both.groupBy("host").agg(F.sort_array(F.collect_set("token")).alias("template"))


class _Template:
    """The template tokens of a host, and which of their slots are of the article."""

    def __init__(self, tokens: list[int] | None, main: list[int] | None = None):
        self.tokens, self.main = frozenset(tokens or ()), frozenset(main or ())

    def slots(self, page: Page) -> list[int]:
        """The template element that each block follows, 0 for none."""
        known = np.array([t in self.tokens for t in page.tokens], bool) & page.is_tag if len(page.tokens) else np.zeros(0, bool)
        last = np.maximum.accumulate(np.where(known, np.arange(1, len(known) + 1), 0)) if len(known) else known
        before = [int(last[b.place - 1]) if b.place else 0 for b in page.blocks]
        return [int(page.tokens[k - 1]) if k else 0 for k in before]


def _page(tokens: list[int], tags: list[bool], blocks: list[dict]) -> Page:
    made = [
        Block(b["text"], b["token"], b["place"], False, b["in_article"], b["prose"], (), tuple(b["inside"]), b["article"]) for b in blocks
    ]
    return Page(np.array(tokens, np.int64), np.array(tags, bool), made)


def _main_slots(parsed: DataFrame, templates: DataFrame) -> DataFrame:
    """One row (host, main) per host: the template elements whose slots hold a good share of the host's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Template] = {}
        found: Counter = Counter()
        for batch in batches:
            for host, tokens, tags, places, sizes, template in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if host not in held:
                    held[host] = _Template(template)
                blocks = [Block("", 0, place, False, False, False, (), ()) for place in places]
                slots = held[host].slots(Page(np.array(tokens, np.int64), np.array(tags, bool), blocks))
                for slot, size in zip(slots, sizes, strict=True):
                    found[host, slot] += size
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _ in found], pa.string()),
                pa.array([t for _, t in found], pa.int64()),
                pa.array(list(found.values()), pa.int64()),
            ],
            names=["host", "token", "chars"],
        )

    sizes = F.transform("blocks.text", F.length)
    rows = parsed.select("host", "tokens", "tags", F.col("blocks.place").alias("places"), sizes.alias("sizes"))
    rows = _with_host_table(rows, templates).filter(F.col("template").isNotNull())
    slots = rows.mapInArrow(run, "host string, token long, chars long").groupBy("host", "token").agg(F.sum("chars").alias("chars"))
    slots = cut_lineage(slots)
    largest = slots.groupBy("host").agg(F.max("chars").alias("largest"))
    main = slots.join(largest, "host").filter(F.col("chars") >= SLOT_SHARE * F.col("largest"))
    return main.groupBy("host").agg(F.sort_array(F.collect_list("token")).alias("main"))


def _contained(page: Page, template: _Template, blocks: list[Block]) -> list[Block]:
    """The blocks inside the containers of the page's main slots.

    A slot's container is the smallest that holds all its blocks. A slot that
    lies in the body itself takes the body's own text, lists and tables.
    """
    main: dict[int, list[Block]] = defaultdict(list)
    kept = {id(b) for b in blocks}
    for b, slot in zip(page.blocks, template.slots(page), strict=True):
        if slot in template.main and id(b) in kept:
            main[slot].append(b)
    containers = {os.path.commonprefix([b.inside for b in own]) for own in main.values()}
    chosen = {id(b) for own in main.values() for b in own}

    def is_in(b: Block) -> bool:
        return any(b.inside[: len(c)] == c if c else all(x < 0 for x in b.inside) for c in containers)

    return [b for b in blocks if id(b) in chosen or is_in(b)]


def _longest_container(blocks: list[Block], least: int) -> tuple[int, ...] | None:
    """The innermost container whose own and inner text is longer than ``least``; None if there is none."""
    chars: Counter = Counter()
    for b in blocks:
        for k in range(1, len(b.inside) + 1):
            chars[b.inside[:k]] += len(b.text)
    long = [c for c, n in chars.items() if n > least]
    return max(long, key=lambda c: (len(c), chars[c]), default=None)


def _article(page: Page, template: _Template) -> str:
    blocks = [b for b in page.blocks if b.in_article and b.prose or b.token not in template.tokens]
    articles: Counter = Counter()
    for b in blocks:
        articles[b.article] += len(b.text)
    outside = articles.pop(0, 0)
    if articles:
        # Several short ones beside a longer text of another container are cards.
        other = [b for b in blocks if not b.article]
        longer = _longest_container(other, max(articles.values())) if len(articles) > 1 and outside > sum(articles.values()) else None
        if longer is None:
            return "\n".join(b.text for b in blocks if b.article)
        return "\n".join(b.text for b in other if b.inside[: len(longer)] == longer)
    if template.tokens:
        blocks = _contained(page, template, blocks) or blocks
    return "\n".join(b.text for b in blocks)


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text and n_chars."""
    parsed = _parse(pages)
    distinct = _distinct_pages(parsed)
    classes = cut_lineage(_classes(distinct))
    templates = cut_lineage(_valid_parts(distinct, classes))
    main = _main_slots(parsed, templates)
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Template] = {}
        for batch in batches:
            texts = []
            columns = [c.to_pylist() for c in batch.columns[2:]]
            for host, tokens, tags, blocks, template, own in zip(*columns, strict=True):
                if host not in held:
                    held[host] = _Template(template, own)
                texts.append(_article(_page(tokens, tags, blocks), held[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = parsed.select("page_id", "url", "host", "tokens", "tags", "blocks")
    return _with_host_table(_with_host_table(rows, templates), main).mapInArrow(run, schema)
