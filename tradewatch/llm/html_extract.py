"""Main text of web pages: page structure, and a host's suffix array for what structure leaves open.

1. Each page is cut into blocks of text. Markup gives a block a zone: OUT
   (menus, page headers and footers, sidebars, notices, adverts, forms,
   reader comments, by element or role), DOUBTFUL (the same, but told by class
   or id alone), ARTICLE, MAIN, or OPEN.
2. Token streams of a host's pages, concatenated, are sorted as a suffix array
   by their first RUN tokens; equal neighbours from PAGES different pages are
   substrings of RUN tokens or more that repeat across the host. A host is
   dealt into chunks of bounded size, copies of one page (which count once)
   taken out before; chunks report how many pages each of
   their suffix classes has, and the sums over the host tell the repeated ones.
   Only classes that a page still to be decided has are looked for (a bitmap of
   fixed size tells which may be); other stretches of the streams aren't moved.
3. A page with an article gives its blocks there. On a page without, the
   blocks of its main part (or else its OPEN ones) that repeated runs cover go
   and the unique ones stay; if that would leave nothing, the page is a copy of
   other pages, not boilerplate, and keeps its blocks. A page whose only other
   blocks are DOUBTFUL is decided in the same way.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import slices, written
from tradewatch.llm.decontam import in_table, lookup_table

#: Tokens of a repeated run, pages it must be on, share of a block that makes it boilerplate.
RUN, PAGES, COVERED = 8, 3, 0.5
#: Tokens of a chunk of a host, on average.
CHUNK_TOKENS = 200_000

DOUBTFUL, OUT, OPEN, MAIN, ARTICLE = -1, 0, 1, 2, 3

_RAW = "script|style|noscript|template|textarea|title|iframe|svg|select|noframes|xmp|object|canvas|math"
_TAG = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])(?:"[^"]*"|'[^']*'|[^>"'])*>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)"""
    r"""|</[^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S | re.I)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_WORD = re.compile(r"[^\W_]+")

# Elements that stay inside a line, and elements without an end.
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark "
                    "q s samp small span strike strong sub sup time tt u var wbr".split())
_EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements, roles and words of class or id that tell a zone.
_OUT_TAGS = frozenset("head nav header footer aside form dialog menu button fieldset".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                       "toolbar".split())
_OUT_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright discussion disqus footer form gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification overlay pager pagination popup promo promoted promotion recommended "
    "related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription teaser toolbar topbar widget widgets".split())
#: A name that begins or ends with one of those tells a zone too ("post-comments", "sidebar-left"), unless it has a word
#: that makes it a state of something else ("has-sidebar", "comments-open", "search-results").
_STATE_WORDS = frozenset("closed disabled enabled fixed has hide is no off on open results show sticky with without".split())
#: Beginnings of run-together names ("commentlist").
_OUT_STARTS = ("advert", "breadcrumb", "comment", "footer", "navbar", "sidebar")
#: Words that say nothing beside one of an article or main part.
_PLAIN_WORDS = frozenset("area bar block box buttons container global inner item items links list page section site slot "
                         "unit wrap wrapper".split())
#: Elements that hold a page's text whatever their class or id says.
_WHOLE_TAGS = frozenset("html body main article".split())
_ARTICLE_WORDS = frozenset("article entry post story".split())
_MAIN_WORDS = frozenset("body content main text".split())
#: Elements whose zone is kept on the stack.
_NESTING = frozenset("html body head nav header footer aside form dialog menu button fieldset article main section div "
                     "ul ol dl table figure details blockquote center span p li td".split())


def parts_of(name: str) -> list[str]:
    """The words of a class name or id, in lower case."""
    return [w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))]


def out_name(name: str, words: frozenset[str]) -> bool:
    """Whether a class name or id begins or ends with one of `words` and is no state."""
    parts = parts_of(name)
    if not parts or not _STATE_WORDS.isdisjoint(parts):
        return False
    return parts[0] in words or parts[-1] in words or parts[0].startswith(_OUT_STARTS)


def whole_name(name: str, words: frozenset[str]) -> bool:
    """Whether a class name or id is one of `words`, or a compound of them, words of main text and plain words."""
    parts = set(parts_of(name))
    return bool(parts & words) and parts <= words | _ARTICLE_WORDS | _MAIN_WORDS | _PLAIN_WORDS


def best_zone(zones: list[int]) -> int:
    """The zone of a page's main text; DOUBTFUL before nothing at all."""
    best = max(zones, default=OUT)
    return DOUBTFUL if best == OUT and DOUBTFUL in zones else best


def zone_of(name: str, attrs: str, around: int) -> int:
    """The zone of an element inside one of zone `around`."""
    if around == OUT or (name in _OUT_TAGS and not (around == ARTICLE and name == "header")):
        return OUT
    if around == DOUBTFUL and not attrs:
        return DOUBTFUL
    if not attrs:
        return ARTICLE if name == "article" else max(around, MAIN) if name == "main" else around
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)} if attrs.strip() else {}
    role = found.get("role", "").lower()
    if role in _OUT_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return OUT
    if around == DOUBTFUL:
        return DOUBTFUL
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    of_article = any(not _ARTICLE_WORDS.isdisjoint(parts_of(x)) for x in names)
    # An article's own header holds its title; "post-header" and the like are no page headers.
    out = _OUT_WORDS - {"header"} if around == ARTICLE or of_article else _OUT_WORDS
    if name not in _WHOLE_TAGS and any(out_name(x, out) for x in names):
        return DOUBTFUL
    if name == "article" or role == "article" or (name != "body" and any(whole_name(x, _ARTICLE_WORDS) for x in names)):
        return ARTICLE
    if name == "main" or role == "main" or (name in ("div", "section", "td") and any(whole_name(x, _MAIN_WORDS) for x in names)):
        return max(around, MAIN)
    return around


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of a page's non-empty blocks in order: references decoded, white space made single."""
    stack: list[tuple[str, int]] = [("", OPEN)]
    out: list[tuple[int, str]] = []
    part: list[str] = []
    at = 0

    def close() -> None:
        text = "".join(part)
        part.clear()
        if "&" in text:
            text = html.unescape(text)
        text = " ".join(text.split())
        if text:
            out.append((stack[-1][1], text))

    for m in _TAG.finditer(page):
        part.append(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m["raw"]:
                part.append(" ")
            continue
        name = name.lower()
        if name in _INLINE and name != "span":
            if name == "br":
                part.append(" ")
            continue
        if name == "span":
            # Only an out-of-article span changes anything; other spans are part of the line.
            if m["end"]:
                if stack[-1][0] == "span":
                    close()
                    stack.pop()
            elif (zone := zone_of(name, m["attrs"], stack[-1][1])) <= OUT and stack[-1][1] != zone:
                close()
                stack.append(("span", zone))
            continue
        close()
        if name not in _NESTING or name in _EMPTY:
            continue
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        elif not m["attrs"].rstrip().endswith("/"):
            if name in ("p", "li", "td") or stack[-1][0] == "p":
                while stack[-1][0] in ("p", "span"):        # an open paragraph ends where a block begins
                    stack.pop()
            if name == "body":                              # the head ends here, closed or not
                stack[1:] = [s for s in stack[1:] if s[0] == "html"]
            zone = zone_of(name, m["attrs"], stack[-1][1])
            if name not in ("p", "li", "td") or zone != stack[-1][1]:
                stack.append((name, zone))
    part.append(page[at:])
    close()
    return out


def host_of(url: str | None) -> str:
    """The host of a URL, lower-cased, without user and port; empty if there is none."""
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def token_hashes(text: str) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in text.split()), np.uint32)


def suffix_classes(stream: np.ndarray, length: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array by the first `length` tokens, class of each suffix in that order), by prefix doubling.

    Suffixes in one class begin with the same `length` tokens (the ends of the stream are
    told apart by their length).
    """
    n = len(stream)
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64) + 1
    order, known = np.argsort(rank, kind="stable"), 1
    while known < length:
        step = min(known, length - known)
        after = np.zeros(n, np.int64)
        if step < n:
            after[:n - step] = rank[step:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate(([1], np.diff(key[order]) != 0))) if n else rank
        rank = np.empty(n, np.int64)
        rank[order] = new
        known += step
    return order, rank[order]


def run_hashes(tokens: np.ndarray, length: int = RUN) -> np.ndarray:
    """64-bit hash (signed) of the `length` tokens from each place on."""
    n = max(0, len(tokens) - length + 1)
    x = np.zeros(n, np.uint64)
    for i in range(length):
        x = x * np.uint64(0x9E3779B97F4A7C15) + tokens[i:i + n].astype(np.uint64) + np.uint64(1)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def parsed(pages: DataFrame) -> DataFrame:
    """(row, page_id, url, host, blocks, best, sign, n): pages cut into blocks, written.

    `best` is the zone of the page's main text, `sign` a 64-bit hash of its words and `n` their number (OUT
    blocks too); `row` numbers the pages.
    """
    block = pa.list_(pa.struct([("zone", pa.int32()), ("text", pa.string()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for b in slices(batches, "html", 4 << 20):
            out = []
            for i, u, h in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                found = blocks(h or "")
                hashes = [token_hashes(t) for _, t in found]
                every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint32)
                out.append({"row": key, "page_id": i, "url": u, "host": host_of(u),
                            "blocks": [{"zone": z, "text": t, "words": len(x)} for (z, t), x in zip(found, hashes)],
                            "best": best_zone([z for z, _ in found]),
                            "sign": xxhash.xxh64_intdigest(every.tobytes()) - (1 << 63), "n": len(every)})
                key += 1
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("row", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()),
                ("blocks", block), ("best", pa.int32()), ("sign", pa.int64()), ("n", pa.int64())]))

    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return written(columns.mapInArrow(
        run, "row long, page_id long, url string, host string, "
             "blocks array<struct<zone:int,text:string,words:int>>, best int, sign long, n long"), "pages")


def trimmed(tokens: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """`tokens` with what is in no run that begins at a place `asked` (a mask) cut to one 0 a stretch."""
    kept = np.zeros(len(tokens), bool)
    for k in range(RUN):
        kept[k:k + len(asked)] |= asked
    gap = ~kept
    gap[1:] &= kept[:-1]
    return np.where(kept, tokens, np.uint32(0))[kept | gap] if kept.any() else tokens[:0]


def streams(rows: DataFrame, wanted=None) -> DataFrame:
    """(row, host, tokens, sign, n): the hashes of all words of parsed pages. With `wanted`, a broadcast
    bitmap of runs, only the stretches that may hold one of them, and pages that have one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = [token_hashes(" ".join(texts)) for texts in b.column("texts").to_pylist()]
            if wanted is not None:
                tokens = [trimmed(t, in_table(wanted.value, run_hashes(t))) for t in tokens]
            out = pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("host"), pa.array([t.tobytes() for t in tokens], pa.binary()),
                 b.column("sign"), b.column("n")], ["row", "host", "tokens", "sign", "n"])
            yield out if wanted is None else out.filter(pa.array([len(t) > 0 for t in tokens], pa.bool_()))

    return rows.select("row", "host", F.col("blocks.text").alias("texts"), "sign", "n").mapInArrow(
        run, "row long, host string, tokens binary, sign long, n long")


def repeated_runs(rows: DataFrame, run_length: int = RUN, least_pages: int = PAGES, wanted=None) -> DataFrame:
    """(host, run): hashes of the runs of `run_length` tokens on `least_pages` different pages of a host.

    The chunks' suffix arrays are groups of about CHUNK_TOKENS tokens, however
    large the host is. `wanted` is a broadcast bitmap of the runs asked for (None: all).
    """
    # Copies of a page meet as one key, once a map task, before any chunk is made.
    streams = written(rows.select("host", "tokens", "sign", "n").distinct(), "streams")
    sizes = streams.groupBy("host").agg(F.ceil(F.sum(F.length("tokens")) / (4 * CHUNK_TOKENS)).alias("chunks"))
    # Cut alike, pages can have the same tokens: the sign deals them.
    dealt = (streams.join(sizes, "host")
             .select("host", "tokens", F.pmod(F.xxhash64("tokens", "sign"), F.greatest("chunks", F.lit(1))).alias("chunk")))

    def classes(pdf: pd.DataFrame) -> pd.DataFrame:
        streams = [np.frombuffer(t, np.uint32) for t in pdf["tokens"]]
        lengths = np.array([len(s) for s in streams])
        # A token of its own after each page: no run goes from one page into the next.
        stream = np.concatenate([np.append(s.astype(np.int64), (1 << 32) + k) for k, s in enumerate(streams)])
        page = np.repeat(np.arange(len(streams)), lengths + 1)
        hashes = np.concatenate([np.append(run_hashes(s, run_length), np.zeros(
            len(s) + 1 - max(0, len(s) - run_length + 1), np.int64)) for s in streams])
        whole = np.concatenate([np.arange(n + 1) + run_length <= n for n in lengths])
        order, label = suffix_classes(stream, run_length)
        order, label = order[whole[order]], label[whole[order]]
        # Pages of each class of neighbours in the suffix array.
        each = np.unique(np.stack((label, page[order])), axis=1)
        names, n = np.unique(each[0], return_counts=True)
        first = order[np.searchsorted(label, names)] if len(names) else order
        if wanted is not None:
            some = in_table(wanted.value, hashes[first])
            first, n = first[some], n[some]
        return pd.DataFrame({"host": pdf["host"].iloc[0] if len(pdf) else "", "run": hashes[first], "pages": n})

    # One key of both: a grouping by host and chunk would keep the join's dealing by host alone.
    part = F.concat_ws("/", "host", "chunk").alias("part")
    found = dealt.groupBy(part).applyInPandas(classes, "host string, run long, pages long")
    return found.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= least_pages).select(
        "host", "run")


def chosen(zones: list[int], words: list[int], covered: np.ndarray | None) -> list[int]:
    """Which blocks are the main text; `covered` marks the page's tokens in repeated runs."""
    best = best_zone(zones)
    inside = [i for i, z in enumerate(zones) if z == best and z != OUT]
    if best == ARTICLE or covered is None:
        return inside
    ends = np.cumsum(words)
    unique = [i for i in inside if covered[ends[i] - words[i]:ends[i]].sum() < COVERED * max(words[i], 1)]
    return unique or inside


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page row, whole html.

    Blocks are joined by a line feed. Null or empty html, and pages without
    any text outside menus and the like, give an empty text; a null url is
    the host "" ; repeated rows and null ids stay; other columns are ignored;
    an empty table gives an empty result.
    """
    rows = parsed(pages)
    undecided = streams(rows.where(F.col("best").isin(MAIN, OPEN, DOUBTFUL)))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, host, t in zip(*(b.column(c).to_pylist() for c in ("row", "host", "tokens"))):
                found = run_hashes(np.frombuffer(t, np.uint32))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * n, pa.int64()), pa.array([host] * n, pa.string()), pa.array(range(n), pa.int32()),
                     pa.array(found)], ["row", "host", "at", "run"])

    asked = written(undecided.select("row", "host", "tokens").mapInArrow(
        places, "row long, host string, at int, run long"), "asked")
    wanted = pages.sparkSession.sparkContext.broadcast(lookup_table(asked.select(F.col("run").alias("gram"))))
    runs = written(repeated_runs(streams(rows, wanted), wanted=wanted), "runs")
    # Written, so that its size is known: pages aren't shuffled where few have repeated runs.
    covers = written(asked.join(runs, ["host", "run"], "left_semi").groupBy("row").agg(F.collect_list("at").alias("at")),
                     "covers")
    decided = rows.select("row", "page_id", "url", "blocks", "n").join(covers, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for found, n, at in zip(*(b.column(c).to_pylist() for c in ("blocks", "n", "at"))):
                covered = None
                if at:
                    covered = np.zeros(n, bool)
                    for k in range(RUN):
                        covered[np.array(at) + k] = True
                keep = chosen([x["zone"] for x in found], [x["words"] for x in found], covered)
                texts.append("\n".join(found[i]["text"] for i in keep))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    return (decided.mapInArrow(run, "page_id long, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))
