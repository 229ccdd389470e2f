"""Main text of web pages: every host's repeated runs, and the markup's word on what they are.

A page's HTML becomes blocks (runs of text between block elements). Scripts,
styles and the like hold no text; elements that markup names as furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments) hold no main text.

Every page of every host takes the same way. A page is two token streams (a token is
a word or a block's start): what is inside its articles, and the rest. The streams of
a host's pages, either kind for itself, are one text, whose suffixes are put in order
by the 64-bit names of their first ``WINDOW`` tokens, wherever their pages lie.
Neighbours from distinct pages make a repeat; every token under one is covered.

* A page with main text inside an ``article`` element has that text. It is the author's,
  so it stays even where the host's articles repeat it (``n_repeated`` counts these
  words). But ``MENU`` neighbouring blocks or more that are mostly links and wholly
  covered are a menu.
* Of any other page covered words go, and a block that lost some keeps its unique runs
  of ``RUN`` words or more.

Pages go as slices of about ``SLICE`` bytes of text, which are shuffled once. A slice first
asks which of its suffixes can have a neighbour at all: equal windows of ``WINDOW``
tokens hold equal least windows of ``SHORT``, which are fewer, and 32 bits of a name and
its part tell enough. Only suffixes whose answer is yes are put in order, by whole names.
A part is a range of names, their number grows with the input, and a name is in a part
once a slice: a run that all pages share is an entry a slice. Pages of a host with
equal HTML are one page, so that a copy alone makes nothing repeat: the slice with the
smallest number counts it, the others only ask.

Edge cases: null or blank HTML, and a page of furniture alone, give an empty text;
a null ``url`` is a host of its own; text without markup is one block; an ``article``
without main text counts as none; repeated rows give the same row again; long pages
are read whole; an empty table gives an empty one; a column of another name is passed over.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.words import U, Words, mix

#: Tokens that a repeat has at least.
WINDOW = 10
#: Tokens of the windows by which slices first ask for repeats.
SHORT = 6
#: Words of a unique run that stays in a block that lost others.
RUN = 5
#: Bytes of text of a slice, about; bytes of HTML for a task, and for a part of the names.
SLICE, TASK, PART = 2 << 20, 64 << 20, 128 << 20
#: A block whose words are links beyond this share is a menu on a page without an article; inside one it may be.
LINKED = 0.5
#: Neighbouring blocks of links that are a menu inside an article, if the host repeats them.
MENU = 3

# --- fixed values: elements and names of HTML --------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea title button datalist".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
#: Elements that end where another of these starts, up to the element that holds them.
IMPLIED = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion menu menus nav navbar navigation navi breadcrumb breadcrumbs "
                  "sidebar footer masthead topbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription paywall signup login "
                  "share sharing social related recommended pagination pager widget widgets comment comments disqus reply replies respond".split())
TALK = frozenset("comment comments disqus reply replies respond".split())
LAYOUT = frozenset("no not has with without is".split())
# -----------------------------------------------------------------------------
_SPACERS = frozenset("br td th option".split())


#: How sure it is that an element holds no main text: an ``article`` inside it is one nevertheless, or is none.
SOFT, HARD = 1, 2


def _named(tag: str, attrs: list, inside: bool) -> int:
    """What an element's tag, role and names say of it: 0, ``SOFT`` or ``HARD``.

    Names are looked at word by word; one that begins with a word like ``no`` or
    ``has`` (``no-sidebar``) tells of the page's layout, not of the element.
    """
    if tag in FURNITURE:
        return SOFT if tag == "form" else HARD
    if tag == "header" and not inside:
        return SOFT
    if tag in ("html", "body", "main") or not attrs:
        return 0
    values = dict(attrs)
    names: set[str] = set()
    for name in f"{values.get('class') or ''} {values.get('id') or ''}".lower().split():
        words = re.split("[-_:/]+", name)
        if words[0] not in LAYOUT:
            names.update(words)
    if TALK & names:
        return HARD
    hidden = "hidden" in values or (values.get("role") or "").strip().lower() in ROLES
    return SOFT if hidden or (tag != "article" and NAMES & names) else 0


class Blocks(HTMLParser):
    """Collects ``blocks`` = (text, in an article, furniture, words in links) in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, bool, bool, int]] = []
        self.open: list[tuple[str, bool, int]] = []      # (tag, silent, furniture), each inherited
        self.count: dict[str, int] = {}
        self.words: dict[tuple[bool, bool], list[str]] = {}
        self.linked: dict[tuple[bool, bool], int] = {}
        self.silent, self.furniture = False, 0

    def _flush(self) -> None:
        for (inside, furniture), parts in self.words.items():
            text = " ".join("".join(parts).split())
            if text:
                self.blocks.append((text, inside, furniture, self.linked.get((inside, furniture), 0)))
        if self.words:
            self.words, self.linked = {}, {}

    def _settle(self) -> None:
        _, self.silent, self.furniture = self.open[-1] if self.open else ("", False, 0)

    def _pop(self, tag: str) -> None:
        while self.open:
            last = self.open.pop()[0]
            self.count[last] -= 1
            if last == tag:
                break
        self._settle()

    def _imply(self, tag: str) -> None:
        """Close what a new element closes: a paragraph before a block, an item before its next."""
        if tag in BLOCK and self.count.get("p"):
            for held, *_ in reversed(self.open):
                if held == "p":
                    self._pop("p")
                    break
                if held in BLOCK:
                    break
        holders = IMPLIED.get(tag)
        if holders and self.count.get(tag):
            for held, *_ in reversed(self.open):
                if held == tag:
                    self._pop(tag)
                    break
                if held in holders:
                    break

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self._flush()
        self._imply(tag)
        if tag in _SPACERS:
            self.handle_data(" ")
        if tag in VOID:
            return
        if tag == "body" and self.count.get("head"):
            self._pop("head")
        inside = self.count.get("article", 0) > 0
        self.silent |= tag in SILENT
        if tag == "article" and self.furniture == SOFT:
            self.furniture = 0  # a page in one form, a column that is called a widget
        self.furniture = max(self.furniture, _named(tag, attrs, inside))
        self.open.append((tag, self.silent, self.furniture))
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash at the end means nothing in HTML but in void elements

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if not self.count.get(tag):
            return
        if tag in BLOCK or tag in SILENT or tag in IMPLIED:
            self._pop(tag)
        else:  # an inline element ends alone
            at = next(k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag)
            del self.open[at]
            self.count[tag] -= 1
            self._settle()

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        where = (self.count.get("article", 0) > 0, self.furniture > 0)
        self.words.setdefault(where, []).append(data)
        if self.count.get("a"):
            self.linked[where] = self.linked.get(where, 0) + len(data.split())

    def close(self) -> None:
        super().close()
        self._flush()


def blocks_of(html: str | None) -> list[tuple[str, bool, bool, int]]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    return parser.blocks


def _links(block: tuple[str, bool, bool, int]) -> bool:
    return block[3] > LINKED * len(block[0].split())


def _loose(block: tuple[str, bool, bool, int]) -> bool:
    """Whether markup leaves open if the block is main text."""
    return not block[2] and not _links(block)


def fenced_text(html: str | None) -> str:
    """The text inside the page's articles; of a page that has none, what markup leaves open."""
    blocks = blocks_of(html)
    inside = [b[0] for b in blocks if b[1] and not b[2]]
    return "\n".join(inside or [b[0] for b in blocks if _loose(b)])


def tokens_of(texts: list[str]) -> list[str]:
    """The page's token stream: before each block's words a mark of its start."""
    return [t for text in texts for t in ("\n", *text.split())]


def unique_text(texts: list[str], loose: list[bool], covered: list[int], window: int, run: int) -> str:
    """The loose blocks without the words under a repeat (``covered``: where repeats start), in runs of ``run`` words or whole."""
    tokens = tokens_of(texts)
    hit = bytearray(len(tokens))
    for k in covered:
        hit[k:k + window] = b"\1" * min(window, len(tokens) - k)
    out, at = [], 0
    for text, open_ in zip(texts, loose):
        words = text.split()
        gone = hit[at + 1:at + 1 + len(words)]
        at += 1 + len(words)
        if not open_:
            continue
        if not any(gone):
            out.append(text)
            continue
        kept, now = [], []
        for word, g in zip([*words, ""], [*gone, 1]):
            if not g:
                now.append(word)
                continue
            kept += now if len(now) >= run else []
            now = []
        if kept:
            out.append(" ".join(kept))
    return "\n".join(out)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))


def article_text(blocks: list[tuple[str, bool, bool, int]], covered: np.ndarray) -> tuple[str, int]:
    """The text of an article's blocks but for menus, and how many of its words are ``covered`` (a flag a token)."""
    held: list[tuple[str, int]] = []
    menu: list[tuple[str, int]] = []

    def settle() -> None:
        if len(menu) < MENU:
            held.extend(menu)
        menu.clear()

    at = 0
    for block in blocks:
        size = len(block[0].split())
        hits = int(covered[at + 1:at + 1 + size].sum())
        at += 1 + size
        if block[2]:
            continue
        if hits == size and _links(block):
            menu.append((block[0], hits))
            continue
        settle()
        held.append((block[0], hits))
    if held:  # else the article is a list of links
        settle()
    held += menu
    return "\n".join(t for t, _ in held), sum(n for _, n in held)


def _digest(*texts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(texts).encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _packed(held: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    row, page_id, url, host, page, blocks = zip(*held)
    rows = pa.RecordBatch.from_arrays(
        [pa.array(page_id, kinds.field("page_id").type), pa.array(url, kinds.field("url").type), pa.array(host, pa.uint64()), pa.array(page, pa.uint64()),
         *(pa.array([[b[k] for b in p] for p in blocks], pa.list_(kind)) for k, kind in enumerate((pa.string(), pa.bool_(), pa.bool_(), pa.int32())))],
        names=["page_id", "url", "host", "page", "texts", "inside", "furniture", "linked"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), pa.array([zlib.compress(sink.getvalue(), 4)], pa.binary())], names=["slice", "pages"])


def _unpacked(pages: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zlib.decompress(pages)).read_next_batch()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of pages as blocks, named by their first row."""
    held, size, kinds = [], 0, None
    for batch in batches:
        kinds = batch.schema
        for row, page_id, url, host, html in zip(*(batch.column(c).to_pylist() for c in ("row", "page_id", "url", "host", "html"))):
            blocks = blocks_of(html)
            held.append((row, page_id, url, _digest(host), _digest(host, html or ""), blocks))
            size += sum(len(b[0]) for b in blocks)
            if size >= SLICE:
                yield _packed(held, kinds)
                held, size = [], 0
    if held:
        yield _packed(held, kinds)


def _entries(values: np.ndarray, page: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how many pages that count hold each (2: or more)."""
    order = np.lexsort((page, values) if counts.all() else (page, ~counts, values))
    values, page, counts = values[order], page[order], counts[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return values, np.zeros(0, np.int64)
    n = np.add.reduceat(counts.astype(np.int64), first)
    return values[first], np.where(page[first] != page[first + np.maximum(n, 1) - 1], 2, np.minimum(n, 1))


class Suffixes:
    """The suffixes of a slice's token streams: two streams a page, the text outside articles and that inside."""

    def __init__(self, pages: bytes, copies: list | None, bits: int):
        self.bits = bits
        self.rows = _unpacked(pages)
        self.blocks = [list(zip(*p)) for p in zip(*(self.rows.column(c).to_pylist() for c in ("texts", "inside", "furniture", "linked")))]
        self.words = words = Words(pa.array([" ".join("\x1f " + b[0] for b in p if b[1] == kind) for p in self.blocks for kind in (False, True)], pa.large_string()))
        self.at, names = words.windows(WINDOW)
        stream = words.text[self.at]
        host = mix(self.rows.column("host").to_numpy()[stream // 2] + (stream % 2).astype(U))
        page = self.rows.column("page").to_numpy()
        self.page = page[stream // 2]
        self.counts = ~np.isin(page, np.array(copies or [], np.int64).astype(U))[stream // 2]
        self.name = mix(names ^ host)
        at, short = words.windows(SHORT)
        value = np.zeros(len(words.start), U)
        value[at] = short
        least = value[self.at]
        for k in range(1, WINDOW - SHORT + 1):
            least = np.minimum(least, value[self.at + k])
        self.least = mix(least ^ host) >> U(32 - bits)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the first question: part and 32 bits of a name."""
        return _entries(self.least, self.page, self.counts)

    def _answer(self, values: np.ndarray, part: np.ndarray, hits: list) -> np.ndarray:
        """A flag for each of the distinct ``values``, whose parts were answered one by one."""
        out = np.zeros(len(values), bool)
        for row in hits or []:
            a, b = np.searchsorted(part, [row["part"], row["part"] + 1])
            out[a:b] = np.unpackbits(np.frombuffer(row["hit"], np.uint8), count=b - a).astype(bool)
        return out

    def chosen(self, hits: list) -> np.ndarray:
        """The suffixes that may have a neighbour."""
        values = self.asked()[0]
        return np.flatnonzero(self._answer(values, values >> U(32), hits)[np.searchsorted(values, self.least)])

    def ordered(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of their names."""
        return _entries(self.name[chosen], self.page[chosen], self.counts[chosen])

    def covered(self, may: list, hits: list) -> np.ndarray:
        """The tokens at which a repeat starts."""
        chosen = self.chosen(may)
        values = self.ordered(chosen)[0]
        return self.at[chosen[self._answer(values, values >> U(64 - self.bits), hits)[np.searchsorted(values, self.name[chosen])]]]

    def judged(self, may: list, hits: list) -> Iterator[tuple[str, int]]:
        """The text of each page, and its words that are repeated."""
        starts = self.covered(may, hits)
        cover = np.zeros(len(self.words.start) + 1, np.int64)
        cover[starts] += 1
        cover[starts + WINDOW] -= 1  # a start is there once
        cover = np.cumsum(cover) > 0
        first = self.words.first
        for k, blocks in enumerate(self.blocks):
            inside = [b for b in blocks if b[1]]
            if any(not b[2] for b in inside):
                yield article_text(inside, cover[first[2 * k + 1]:first[2 * k + 2]])
                continue
            rest = [b for b in blocks if not b[1]]
            a, b = np.searchsorted(starts, [first[2 * k], first[2 * k + 1]])
            yield unique_text([x[0] for x in rest], [_loose(x) for x in rest], (starts[a:b] - first[2 * k]).tolist(), WINDOW, RUN), 0


def _rows(number: int, part: np.ndarray, names: np.ndarray, pages: np.ndarray) -> pa.RecordBatch:
    """A slice's entries, a row a part."""
    edge = np.flatnonzero(np.diff(part, prepend=part[:1] - U(1), append=part[-1:] + U(1)))
    spans = list(zip(edge[:-1], edge[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(part[a]) for a, _ in spans], pa.int32()), pa.array([number] * len(spans), pa.int64()), pa.array([names[a:b].tobytes() for a, b in spans], pa.binary()),
         *(pa.array([np.packbits(pages[a:b] >= k).tobytes() for a, b in spans], pa.binary()) for k in (1, 2))], names=["part", "slice", "names", "one", "two"])


ENTRIES = "part int, slice long, names binary, one binary, two binary"


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pages of each slice."""
    for batch in batches:
        for number, pages in zip(batch.column("slice").to_pylist(), batch.column("pages")):
            page = np.unique(_unpacked(pages.as_py()).column("page").to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(page), number)), pa.array(page)], names=["slice", "page"])


def _first_names(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pages, copies in zip(batch.column("slice").to_pylist(), batch.column("pages"), batch.column("copies")):
                values, held = Suffixes(pages.as_py(), copies.as_py(), bits).asked()
                if len(values):
                    yield _rows(number, values >> U(32), values.astype(np.uint32), held)
    return run


def _whole_names(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pages, copies, may in zip(batch.column("slice").to_pylist(), *(batch.column(c) for c in ("pages", "copies", "may"))):
                suffixes = Suffixes(pages.as_py(), copies.as_py(), bits)
                values, held = suffixes.ordered(suffixes.chosen(may.as_py()))
                if len(values):
                    yield _rows(number, values >> U(64 - bits), values, held)
    return run


def _neighbours(kind: type):
    """Puts a part's names in order and tells each slice which of its own are those of two pages."""
    def run(part: pa.Table) -> pa.Table:
        names = [np.frombuffer(x, kind) for x in part.column("names").to_pylist()]
        edge = np.cumsum([len(n) for n in names])[:-1]
        one, two = (np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(n)) for n, x in zip(names, part.column(c).to_pylist())]) for c in ("one", "two"))
        names = np.concatenate(names)
        order = np.argsort(names, kind="stable")
        names, pages = names[order], (one.astype(np.int64) + two)[order]
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        hit = np.empty(len(names), bool)
        hit[order] = (np.add.reduceat(pages, np.flatnonzero(new)) >= 2)[np.cumsum(new) - 1]
        return pa.table({"slice": part.column("slice"), "part": part.column("part"), "hit": pa.array([np.packbits(x).tobytes() for x in np.split(hit, edge)], pa.binary())})
    return run


def _judged(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pages, copies, may, hits in zip(*(batch.column(c) for c in ("pages", "copies", "may", "hits"))):
                suffixes = Suffixes(pages.as_py(), copies.as_py(), bits)
                texts, repeated = zip(*suffixes.judged(may.as_py(), hits.as_py()))
                yield pa.RecordBatch.from_arrays([suffixes.rows.column("page_id"), suffixes.rows.column("url"), pa.array(texts, pa.string()), pa.array(repeated, pa.int64())],
                                                 names=["page_id", "url", "text", "n_repeated"])
    return run


def judged_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated): a row a page; ``n_repeated`` words of the text are repeated by other articles of the host."""
    spark = pages.sparkSession
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK))
    bits = max(4, (size // PART).bit_length())
    kind = pages.schema["page_id"].dataType.simpleString(), pages.schema["url"].dataType.simpleString()
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", host_of(F.col("url")).alias("host"), "html")
    slices = rows.mapInArrow(_slices, "slice long, pages binary").repartition(tasks, "slice")

    # what meets the slices is dealt by the same number, else Spark would deal the slices anew instead of reusing their shuffle
    def answers(entries: DataFrame, kind: type, name: str) -> DataFrame:
        hits = entries.repartition(tasks, "part").groupBy("part").applyInArrow(_neighbours(kind), "slice long, part int, hit binary")
        return hits.repartition(tasks, "slice").groupBy("slice").agg(F.collect_list(F.struct("part", "hit")).alias(name)).hint("merge")

    held = slices.mapInArrow(_pages, "slice long, page long").groupBy("page").agg(F.array_sort(F.collect_list("slice")).alias("slices")).where("size(slices) > 1")
    copies = held.select("page", F.explode(F.expr("slice(slices, 2, size(slices) - 1)")).alias("slice")).repartition(tasks, "slice").groupBy("slice").agg(F.collect_list("page").alias("copies"))
    slices = slices.join(copies.hint("merge"), "slice", "left")
    asked = slices.join(answers(slices.mapInArrow(_first_names(bits), ENTRIES), np.uint32, "may"), "slice", "left")
    known = asked.join(answers(asked.mapInArrow(_whole_names(bits), ENTRIES), np.uint64, "hits"), "slice", "left")
    texts = known.select("pages", "copies", "may", "hits").mapInArrow(_judged(bits), f"page_id {kind[0]}, url {kind[1]}, text string, n_repeated long")
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_repeated")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): a row a page."""
    return judged_pages(pages).drop("n_repeated")
