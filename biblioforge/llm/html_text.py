"""Main text of pages, with repeated boilerplate found by host suffix arrays (operator 5).

A page is cut into blocks. Marked-up regions decide what they can: a block inside <article> or <main> is content, one
inside navigation, header, footer, sidebar, notice, advert, hidden or comment markup is not, nor one of a form outside
an article in it. A class or id names such a
part only if it holds no other word (class=ad, id=nav-menu), and an <article> or <main> inside is content again; one
that also has other words (layout has-sidebar, search-page) leaves its blocks undecided. Blocks that no markup
places are decided by repetition: the token streams of a host's undecided blocks, each page's in one piece, form a
suffix array in shards.

1. A stream is cut into segments, the runs of windows of RUN tokens that have the same minimizer (the leftmost SHINGLE
   tokens with the least hash). Equal windows of a host lie in segments of one minimizer, so a shard of whole minimizers
   holds all suffixes that can have RUN tokens in common. Minimizers of one page alone leave.
2. Equal segments are one class; a class of two distinct pages (copies of a page are one) is repeated as a whole.
3. A segment of each class is in its shard's suffix array, made by prefix doubling, with the longest common prefixes of
   neighbours. The intervals whose common prefix is RUN tokens or more and that have suffixes of two distinct pages are
   repeated: their suffixes begin covered runs. A longer common run is the union of its runs of RUN tokens.
4. A minimizer with over LIMIT different segments (a menu before very many texts) is split: the doubled names of its
   windows at depth RUN are grouped instead, which are the same intervals.

Blocks of fewer than RUN but at least SHORT tokens are also covered if another page has the very same block. Covered runs
are cut out of their blocks; the unique ones stay, in page order.

Runs of RUN tokens don't recur by chance in prose, on small hosts or large ones; shorter ones do, the more the larger
the host. Classes are counted with a partial aggregate per task, so a host with a third of all pages is no hot
key. Pages are parsed once; only those with blocks that no markup places are shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioforge.llm.common import _MIX3, Scratch, hashed_words, mix, window_hashes
from biblioforge.llm.substring_dedup import _least, joined, suffix_array

RUN = 16  # tokens of a run that count as repeated, a power of two
SHORT = 4  # tokens of a block that counts as repeated as a whole
SHINGLE = 6  # tokens of a minimizer
SHARD_TOKENS, LIMIT = 300_000, 2000  # of a suffix array, and different segments of a minimizer in it

#: Elements by role.
SKIPPED = frozenset("script style noscript template svg math iframe object embed canvas audio video head title select option textarea button".split())
BOILER = frozenset("nav header footer aside form dialog menu".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended comment comments respond reply replies disqus cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup share social form search login pagination pager skip".split()
)
COMMENT_WORDS = frozenset("comment comments respond reply replies disqus".split())
PART_WORDS = frozenset("body list item items thread section area author meta wrapper wrap container box block inner text children depth parent odd even div li ul ol slot tools top bottom left right main site primary secondary bar".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")  # names and values are read one after the other, so a value never counts as a name
_RAW = frozenset("script style textarea title noscript iframe".split())
OTHER, CONTENT, CHROME, NAMED = 0, 1, 2, 3  # NAMED: chrome by class or id alone


def _mark(attributes: str) -> int | None:
    """CHROME for hidden parts, roles and reader comments; NAMED for a class or id of nothing but boilerplate and part words; OTHER for one with such words among others."""
    mark = None
    for name, a, b, c in _ATTR.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in BOILER_ROLES):
            return CHROME
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return CHROME
        if name in ("class", "id"):
            words = set(re.findall(r"[a-z]+", value))
            if words & COMMENT_WORDS and words <= BOILER_WORDS | PART_WORDS:
                return CHROME
            if mark == NAMED:
                continue
            if words & BOILER_WORDS and words <= BOILER_WORDS | PART_WORDS:
                mark = NAMED
            elif words & BOILER_WORDS:
                mark = OTHER
    return mark


def page_blocks(source: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the non-empty blocks of a page in order; white space is one space, character references are decoded.

    Unclosed elements end with the enclosing one, a block element also ends an open paragraph; a page that breaks off
    keeps what came before.
    """
    source = source or ""
    stack: list[tuple[str, int]] = []  # element, kind of what is inside; -1 skipped
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    kind = OTHER

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text and kind >= 0:
                out.append((kind, text))

    at, size = 0, len(source)
    while at < size:
        m = _TOKEN.search(source, at)
        if not m:
            if kind >= 0:
                parts.append(source[at:])
            break
        if kind >= 0 and m.start() > at:
            parts.append(source[at : m.start()])
        at = m.end()
        if m[1] is not None and kind >= 0:
            parts.append(html.escape(m[1], quote=False))
        if not m[3]:
            continue
        name = m[3].lower()
        if m[2]:
            if name == "p" or any(n == name for n, _ in stack):
                if name in BLOCKS:
                    flush()
                while any(n == name for n, _ in stack):
                    n, _ = stack.pop()
                    if n in BLOCKS:
                        flush()
                    kind = stack[-1][1] if stack else OTHER
                    if n == name:
                        break
            continue
        if name in ("br", "wbr"):
            if name == "br" and kind >= 0:
                parts.append(" ")
            continue
        if name in BLOCKS:
            flush()
            if any(n == "p" for n, _ in stack):  # inline elements left open inside a paragraph end with it
                while stack[-1][0] != "p" and stack[-1][0] not in BLOCKS:
                    stack.pop()
                if stack[-1][0] == "p":
                    stack.pop()
                kind = stack[-1][1] if stack else OTHER
            if name in ("li", "dt", "dd", "td", "th", "tr") and stack and stack[-1][0] == name:
                stack.pop()
                kind = stack[-1][1] if stack else OTHER
        if name in VOID:
            continue
        if name in SKIPPED:
            inner = -1
        elif kind in (-1, CHROME):
            inner = kind
        elif name == "form":
            inner = NAMED if _mark(m[4]) != CHROME else CHROME  # a server may wrap the whole page in one
        elif name == "header" and kind == CONTENT:
            inner = CONTENT if _mark(m[4]) is None else _mark(m[4])  # the article's own title
        elif name in BOILER:
            inner = CHROME
        else:
            mark = _mark(m[4]) if name not in ("html", "body") else None
            if mark == CHROME:
                inner = CHROME
            elif name in MAIN:
                inner = CONTENT if mark != NAMED else NAMED if kind == NAMED else OTHER
            elif kind == NAMED or mark is None:
                inner = kind
            else:
                inner = mark
        if m[4].rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in _RAW:  # its content is no markup
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if inner != kind:
            flush()
        stack.append((name, inner))
        kind = inner
    flush()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", (url or "").strip(), re.I)
    return (m[1].rpartition("@")[2] if m else "").lower()


def suffix_names(host: str, words: np.ndarray) -> np.ndarray:
    """Name of (host, first RUN tokens) of each suffix of a page's token stream that has so many, by prefix doubling."""
    names, depth = mix(words ^ hash_text(host)), 1
    while depth < RUN:
        names, depth = mix(names[:-depth] * _MIX3 + names[depth:]), depth * 2
    return names.view(np.int64)


def block_name(host: str, words: np.ndarray) -> int | None:
    """Name of (host, whole block), for blocks that are too short for a run."""
    if not SHORT <= len(words) < RUN:
        return None
    return int(mix(window_hashes(words, len(words)) ^ hash_text(host)).view(np.int64)[0])


def hash_text(text: str) -> np.uint64:
    h = hashed_words(text.replace(" ", "_") or "_")
    return h[0] if len(h) else np.uint64(0)


def repeated_suffixes(pieces: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Pieces of token hashes, and the least and greatest of the pages that hold each -> for each piece, the places of the suffixes in intervals of RUN tokens or more and two pages."""
    text, begins = joined(pieces)
    order, lcp = suffix_array(text)
    first = np.concatenate(([0], np.flatnonzero(lcp < RUN) + 1))  # of each interval
    of = np.searchsorted(begins, order, "right") - 1
    two = np.minimum.reduceat(low[of], first) != np.maximum.reduceat(high[of], first)
    # An interval of one suffix may be a piece's end, shorter than RUN.
    place = order - begins[of]
    fits = place + RUN <= np.array([len(p) for p in pieces])[of]
    hit = np.repeat(two, np.diff(np.append(first, len(order)))) & fits
    return [np.sort(x) for x in np.split(place[hit][np.argsort(of[hit], kind="stable")], np.cumsum(np.bincount(of[hit], minlength=len(pieces)))[:-1])]


def segments(host: str, words: np.ndarray) -> tuple[np.ndarray, ...]:
    """(minimizer of the host, first token, number of windows) of the segments of a page's token stream."""
    if len(words) < RUN:
        return (np.empty(0, np.int64),) * 3
    keys = window_hashes(words, SHINGLE)
    at = _least(keys, RUN - SHINGLE + 1)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    return mix(keys[at[first]] ^ hash_text(host)).view(np.int64), first, np.diff(np.append(first, len(at)))


_BLOCK = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("blocks", pa.list_(pa.struct([("kind", pa.int8()), ("text", pa.string()), ("tokens", pa.int32()), ("name", pa.int64())]))),
        ("copy", pa.int64()),
    ]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            piece = batch.slice(k, 200)
            blocks, copies = [], []
            for url, source in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                host, own, stream = host_of(url), [], []
                for kind, text in page_blocks(source):
                    if kind == OTHER:
                        stream.append(hashed_words(text))
                        own.append({"kind": kind, "text": text, "tokens": len(stream[-1]), "name": block_name(host, stream[-1])})
                    elif kind == CONTENT:
                        own.append({"kind": kind, "text": text, "tokens": 0, "name": None})
                blocks.append(own)
                whole = np.concatenate(stream) if stream else np.empty(0, np.uint64)
                copies.append(int(mix(window_hashes(whole, len(whole)) ^ hash_text(host)).view(np.int64)[0]) if len(whole) else 0)
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(blocks, _BLOCK.field("blocks").type), pa.array(copies, pa.int64())], schema=_BLOCK)


def _stream(blocks: list[dict]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *(hashed_words(b["text"]) for b in blocks if b["kind"] == OTHER)])


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """url, blocks, copy -> m, h, copy, at, n: the segments with their minimizers and names."""
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            parts = [(np.empty(0, np.int64),) * 5]
            for url, blocks, copy in zip(*(c.to_pylist() for c in batch.slice(k, 200).columns), strict=True):
                words = _stream(blocks)
                m, first, n = segments(host_of(url), words)
                h = np.empty(len(m), np.int64)
                for size in np.unique(n).tolist():
                    own = np.flatnonzero(n == size)
                    h[own] = window_hashes(words, size + RUN - 1)[first[own]].view(np.int64)
                parts.append((m, h, np.full(len(m), copy), first, n))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts, strict=True)], names=["m", "h", "copy", "at", "n"])


_PIECE = pa.schema([("m", pa.int64()), ("h", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("words", pa.binary()), ("place", pa.int64()), ("name", pa.int64())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """url, blocks, wanted -> the tokens of the segments that are wanted of a page; of crowded minimizers, their windows' names."""
    for batch in batches:
        for k in range(0, batch.num_rows, 50):
            out = []
            for url, blocks, wanted in zip(*(c.to_pylist() for c in batch.slice(k, 50).columns), strict=True):
                words, names = _stream(blocks), None
                for x in wanted:
                    row = {c: x[c] for c in ("m", "h", "lo", "hi")}
                    if x["crowded"]:
                        names = suffix_names(host_of(url), words) if names is None else names
                        out += [row | {"place": i, "name": int(names[x["at"] + i])} for i in range(x["n"])]
                    else:
                        own = mix(words[x["at"] : x["at"] + x["n"] + RUN - 1] ^ hash_text(host_of(url)))  # a shard has several hosts
                        out.append(row | {"words": own.tobytes()})
            yield pa.RecordBatch.from_pylist(out, _PIECE)


def _search(table: pa.Table) -> pa.Table:
    low, high = np.asarray(table["lo"]), np.asarray(table["hi"])
    found = repeated_suffixes([np.frombuffer(w, np.uint64) for w in table["words"].to_pylist()], low, high)
    size = np.array([len(x) for x in found])
    return pa.table({"m": np.repeat(np.asarray(table["m"]), size), "h": np.repeat(np.asarray(table["h"]), size), "place": np.concatenate(found).astype(np.int64)})


def _covered(undecided: DataFrame, scratch: Scratch, limit: int) -> DataFrame:
    """copy, starts: where the repeated runs of RUN tokens begin in the token stream of the pages that are copies of each other."""
    rows = scratch.keep(undecided.select("url", "blocks", "copy").mapInArrow(_segment_rows, "m long, h long, copy long, at long, n long"), "segments")
    shared = rows.groupBy("m").agg(F.min("copy").alias("lo"), F.max("copy").alias("hi")).where("lo <> hi").select("m")
    rows = scratch.keep(rows.join(shared, "m", "left_semi"), "occurrences")
    held = F.min(F.struct("copy", "at", "n")).alias("held")
    classes = scratch.keep(rows.groupBy("m", "h").agg(F.min("copy").alias("lo"), F.max("copy").alias("hi"), held), "classes")
    sizes = classes.groupBy("m").agg(F.count("*").alias("different"), F.count_if(F.expr("lo = hi")).alias("open")).where("different > 1 and open > 0")
    wanted = scratch.keep(classes.join(sizes, "m").withColumn("crowded", F.col("different") > limit), "wanted")
    shards = wanted.where("not crowded").count() * 24 // SHARD_TOKENS + 1
    item = F.struct("m", "h", "lo", "hi", "held.at", "held.n", "crowded")
    asked = wanted.groupBy(F.col("held.copy").alias("copy")).agg(F.collect_list(item).alias("wanted"))
    fetched = undecided.join(asked, "copy").groupBy("copy").agg(F.first(F.struct("url", "blocks", "wanted")).alias("x")).select("x.*")
    kinds = "m long, h long, lo long, hi long, words binary, place long, name long"
    pieces = scratch.keep(fetched.mapInArrow(_pieces, kinds), "pieces")
    found = pieces.where("words is not null").groupBy(F.pmod(F.xxhash64("m"), F.lit(shards)).alias("shard")).applyInArrow(_search, "m long, h long, place long")
    windows = pieces.where("name is not null")
    names = windows.groupBy("name").agg(F.min("lo").alias("low"), F.max("hi").alias("high")).where("low <> high").select("name")
    found = found.union(windows.join(names, "name", "left_semi").select("m", "h", "place"))
    whole = classes.where("lo <> hi").select("m", "h", F.lit(None).cast("array<long>").alias("places"))
    open_ = found.join(classes.where("lo = hi"), ["m", "h"], "left_semi").groupBy("m", "h").agg(F.collect_list("place").alias("places"))
    every = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    hits = rows.join(whole.union(open_), ["m", "h"]).select("copy", F.transform(F.coalesce("places", every), lambda i: i + F.col("at")).alias("starts"))
    return hits.groupBy("copy").agg(F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts"))


def _main_blocks(blocks: list[dict], starts: list[int], repeated: set[int]) -> list[str]:
    """Texts of the content blocks, and of the undecided ones without their repeated runs.

    Of a block that is covered as a whole, or is another page's too, nothing stays. Otherwise the covered runs of RUN
    tokens or more go and the others stay: fewer covered tokens at a block's edge are the end of a run around it.
    """
    steps = np.zeros(sum(b["tokens"] for b in blocks) + 1, np.int64)
    np.add.at(steps, np.array(starts, np.int64), 1)
    np.add.at(steps, np.array(starts, np.int64) + RUN, -1)
    covered = np.cumsum(steps[:-1]) > 0
    out, at = [], 0
    for b in blocks:
        own = covered[at : at + b["tokens"]]
        at += b["tokens"]
        if b["kind"] == CONTENT or not own.any() and b["name"] not in repeated:
            out.append(b["text"])
        elif b["name"] not in repeated and not own.all():
            edge = np.diff(np.concatenate(([0], own.view(np.int8), [0])))
            keep = np.ones(len(own), bool)
            for lo, hi in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                keep[lo:hi] = hi - lo < RUN
            words = b["text"].split(" ")
            out.append(" ".join(words[i] for i in np.flatnonzero(keep)))
    return out


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for blocks, starts, repeated in zip(*(batch.column(k).to_pylist() for k in ("blocks", "starts", "repeated")), strict=True):
            texts.append("\n\n".join(_main_blocks(blocks, starts or (), set(repeated or ()))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, limit: int = LIMIT) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    pages: page_id, url, html; other columns are ignored. Null or empty html has an empty text. A null url is a host of
    its own. Pages of a host with the same undecided text are copies of one page, which repetition doesn't count; each
    returns a row. An empty table gives none. limit: see the module; it changes no result.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    scratch = Scratch(pages.sparkSession, "html-text")
    cut = scratch.keep(pages.mapInArrow(_cut, "page_id long, url string, blocks array<struct<kind:byte,text:string,tokens:int,name:long>>, copy long"), "blocks")
    undecided = F.exists("blocks", lambda b: b.kind == OTHER)
    apart = cut.where(undecided)
    short = apart.select("copy", F.explode(F.array_distinct(F.filter("blocks.name", lambda x: x.isNotNull()))).alias("name"))
    again = short.groupBy("name").agg(F.min("copy").alias("lo"), F.max("copy").alias("hi")).where("lo <> hi").select("name")
    again = short.join(again, "name").groupBy("copy").agg(F.collect_set("name").alias("repeated"))
    apart = apart.join(again, "copy", "left").join(_covered(apart, scratch, limit), "copy", "left").select(*cut.columns, "repeated", "starts")
    none = F.lit(None).cast("array<long>")
    return cut.where(~undecided).withColumn("repeated", none).withColumn("starts", none).union(apart).mapInArrow(_join, "page_id long, url string, text string, n_chars long")
