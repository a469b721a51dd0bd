"""Main text of web pages: page structure, and suffix arrays over the pages of a host.

Each page becomes a stream of blocks of three kinds: main (inside the article or main element),
chrome (menus, headers, footers, sidebars, notices, adverts, forms, comments) and plain (neither).
The main blocks are the text, of pages without any the plain ones, in both cases without the
boilerplate that suffix arrays find: the words of a host's pages are concatenated and sorted to the
length of the shortest run looked for, what lies outside articles in one stream, articles in another.

* Outside articles, a run that distinct pages repeat is boilerplate, and plain blocks covered by such
  runs go.
* Articles quote each other and are copied, so a run in them is boilerplate only if distinct pages
  repeat it and at least half of the host's articles show it. Main blocks that such runs cover wholly
  go, unless they are most of an article: that is a copy of another one.

Unique blocks stay (``n_cut`` counts the words that went).

A host with many words is dealt into shards, each with its own suffix arrays. Outside articles, shards
tell which of their runs which pages show, Spark counts the pages of each run over all shards of the
host, and the shards get those back that enough pages show. In articles, a run that half of a host's
articles show is shown by half of those of some shard: these few are counted in all shards. So a page's
text depends on the other pages of its host, but not on how they are dealt.

Pages are parsed twice rather than stored: for the runs, and for the texts. The second time only hosts
with something to decide are shuffled: with a page that marks no article, or with such runs in articles.

Defined results: null or empty html gives an empty text; a null url is a host of its own; repeated
rows are pages of their own and do not count as distinct pages if their blocks are the same. Other
columns are ignored. Without pages there are no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage

CHROME, MAIN, PLAIN = 0, 1, 2
SHARD_WORDS = 500_000
WORD_CHARS = 6  # of html for each word, at least
MOST_BROADCAST = 50_000  # hosts, some 5 MB

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>|<[a-zA-Z/!?][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_CHROME_TAGS = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu"}
_CHROME_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu",
}
_CHROME_NAMES = set(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent gdpr "
    "notice notices menu nav navbar navigation sidebar footer masthead breadcrumb breadcrumbs "
    "comment comments disqus respond share sharing social related newsletter subscribe signup "
    "popup modal overlay widget toolbar pagination pager login search".split()
)


def _marks(name: str, attributes: str, in_article: bool) -> int | None:
    """CHROME or MAIN if an element starts such a part, else None."""
    if name in _CHROME_TAGS or (name == "header" and not in_article):
        return CHROME
    found = None
    if "=" in attributes or "hidden" in attributes:
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key in ("class", "id") and not _CHROME_NAMES.isdisjoint(re.split(r"[\s_-]+", value)):
                return CHROME
            if key == "role" and value in _CHROME_ROLES or key == "hidden":
                return CHROME
            if key == "style" and "display:none" in value.replace(" ", ""):
                return CHROME
            if (key == "role" and value == "main") or (key == "itemprop" and value == "articlebody"):
                found = MAIN
    return MAIN if name in ("article", "main") else found


def blocks_of(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of each block in page order."""
    page = page or ""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int | None]] = []  # open elements that matter for the kind
    chrome = main = 0
    texts: dict[int, list[str]] = {CHROME: [], MAIN: [], PLAIN: []}

    def flush() -> None:
        for kind, parts in texts.items():
            if parts:
                raw = "".join(parts)
                parts.clear()
                text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
                if text:
                    out.append((kind, text))

    def say(text: str) -> None:
        texts[CHROME if chrome else MAIN if main else PLAIN].append(text)

    at = 0
    while match := _TAG.search(page, at):
        if match.start() > at:
            say(page[at : match.start()])
        at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            say(" ")
            continue
        block = name in _BLOCK
        if block:
            flush()
        if match[1]:
            if any(name == open_name for open_name, _ in stack):
                while True:
                    closed, kind = stack.pop()
                    chrome -= kind == CHROME
                    main -= kind == MAIN
                    if closed == name:
                        break
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}[\s>/]|\Z", re.I).search(page, at)
            at = end.start()
            continue
        if name in _VOID:
            continue
        if block and stack and stack[-1][0] == "p":  # a new block ends an open paragraph
            _, kind = stack.pop()
            chrome -= kind == CHROME
            main -= kind == MAIN
        kind = _marks(name, match[3] or "", main > 0)
        if kind is not None or name in ("div", "section", "ul", "ol", "table", "header", "span"):
            stack.append((name, kind))
            chrome += kind == CHROME
            main += kind == MAIN
    if at < len(page):
        say(page[at:])
    flush()
    if any(kind == MAIN for kind, _ in out):
        out = [(MAIN if kind == MAIN else CHROME, text) for kind, text in out]
    return out


def content_of(blocks: list[tuple[int, str]]) -> int:
    """Equal for pages with the same blocks."""
    return xxhash.xxh3_64_intdigest("\n".join(t for _, t in blocks).encode()) - 2**63


def _unpacked(raw: bytes) -> list[dict]:
    lines = zstandard.decompress(raw).decode()
    return [{"kind": int(line[0]), "text": line[1:]} for line in lines.split("\n")] if lines else []


def _parse(batches: Iterator[pa.RecordBatch]):
    """Pages with ``content`` and packed blocks instead of html; no block holds a line end."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        pages = [blocks_of(page) for page in columns.pop("html").to_pylist()]
        packed = [pack("\n".join([f"{k}{t}" for k, t in blocks]).encode()) for blocks in pages]
        parsed = {
            "content": ([content_of(blocks) for blocks in pages], pa.int64()),
            "packed": (packed, pa.binary()),
        }
        yield batch_of({n: (c, None) for n, c in columns.items()} | parsed)


def _articles(batches: Iterator[pa.RecordBatch]):
    """Texts of pages all of whose main blocks stay."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        pages = [blocks_of(page) for page in columns.pop("html").to_pylist()]
        texts = ["\n".join([t for k, t in blocks if k == MAIN]) for blocks in pages]
        yield batch_of({n: (c, None) for n, c in columns.items()} | {"text": (texts, pa.string())})


def suffix_ranks(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """Rank of every suffix by its first tokens, by prefix doubling up to ``depth`` tokens.

    Returns the ranks and the number of tokens they compare (a power of two, at most ``depth``).
    """
    ranks = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    done = 1
    while 2 * done <= depth:
        after = np.full(len(ranks), -1, np.int64)
        after[:-done] = ranks[done:]
        ranks = np.unique(ranks * (len(ranks) + 1) + after + 1, return_inverse=True)[1]
        done *= 2
    return ranks.astype(np.int64), done


def _covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Positions inside runs of ``length`` from the marked starts."""
    edges = np.zeros(len(starts) + length + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + length, -1)
    return np.cumsum(edges)[: len(starts)] > 0


@dataclass
class Streams:
    """The blocks of some pages as one token stream with its suffix array."""

    texts: list[str]
    kinds: list[int]
    places: list[tuple[int, int]]  # page and place of each block
    contents: np.ndarray  # of the page of each block
    sizes: np.ndarray  # in words
    words: pa.Array
    ranks: np.ndarray  # of the run from each word on
    inside: np.ndarray  # whether that run ends in its page
    length: int  # of runs, in words

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)[:-1]))

    @property
    def pages(self) -> np.ndarray:
        return np.array([page for page, _ in self.places])

    def run_pages(self, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs (rank, content of a page) of all runs, in order.

        ``of`` takes the place of the content of each block.
        """
        ranks = self.ranks[self.inside]
        contents = np.repeat(self.contents if of is None else of, self.sizes)[self.inside]
        order = np.lexsort((contents, ranks))
        ranks, contents = ranks[order], contents[order]
        new = np.ones(len(ranks), bool)
        new[1:] = (np.diff(ranks) != 0) | (contents[1:] != contents[:-1])
        return ranks[new], contents[new]

    def run_keys(self, wanted: np.ndarray | None = None) -> dict[int, bytes]:
        """The same key for the same run in every shard, by rank; of the wanted ranks or all."""
        ranks, first = np.unique(np.where(self.inside, self.ranks, -1), return_index=True)
        if wanted is not None:
            asked = np.isin(ranks, wanted)
            ranks, first = ranks[asked], first[asked]
        if not len(ranks):
            return {}
        words = self.words.to_pylist()
        return {
            rank: xxhash.xxh3_128_digest(" ".join(words[at : at + self.length]).encode())
            for rank, at in zip(ranks.tolist(), first.tolist())
            if rank >= 0
        }

    def short_pages(self, of: np.ndarray | None = None) -> dict[str, set[int]]:
        """The pages of each block shorter than a run, which counts by its whole text."""
        out: dict[str, set[int]] = {}
        numbers = (self.contents if of is None else of).tolist()
        for text, content, size in zip(self.texts, numbers, self.sizes):
            if size < self.length:
                out.setdefault(text, set()).add(content)
        return out


def _short_key(text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"\n{text}".encode())


def streams_of(
    pages: list[tuple[int, list[dict]]], run: int, articles: bool = False
) -> Streams | None:
    """Streams of (content, blocks) of pages, outside or inside articles; None without words."""
    texts, kinds, places, contents, parts = [], [], [], [], []
    part = 0
    for page, (content, blocks) in enumerate(pages):
        part += 1
        for place, block in enumerate(blocks):
            if (block["kind"] == MAIN) != articles:
                part += 1
                continue
            texts.append(block["text"])
            kinds.append(block["kind"])
            places.append((page, place))
            contents.append(content)
            parts.append(part)
    if not texts:
        return None
    split = pc.split_pattern(pa.array(texts, pa.string()), " ")
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    words = pc.list_flatten(split)
    tokens = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # a separator of its own after each page and article, so that no run crosses them
    ends = np.flatnonzero(np.diff(np.repeat(np.array(parts), sizes))) + 1
    stream = np.insert(tokens, ends, -1 - np.arange(len(ends)))
    ranks, length = suffix_ranks(stream, run)
    ranks = np.delete(ranks, ends + np.arange(len(ends)))
    inside = np.ones(len(ranks), bool)
    for back in range(1, length):
        spots = np.concatenate((ends, [len(ranks)])) - back
        inside[spots[spots >= 0]] = False
    return Streams(
        texts, kinds, places, np.array(contents, np.int64), sizes, words, ranks, inside, length
    )


def shard_runs(
    pages: list[tuple[int, list[dict]]], run: int, least: int
) -> Iterator[tuple[bytes, int]]:
    """(key, content) of each run and short block with the pages that show it.

    ``least`` pages of a shard are enough to know that so many of the host do.
    """
    streams = streams_of(pages, run)
    if streams is None:
        return
    ranks, contents = streams.run_pages()
    nth = np.arange(len(ranks)) - np.searchsorted(ranks, ranks)
    keys = streams.run_keys()
    for rank, content in zip(ranks[nth < least].tolist(), contents[nth < least].tolist()):
        yield keys[rank], content
    for text, shown in streams.short_pages().items():
        key = _short_key(text)
        for content in sorted(shown)[:least]:
            yield key, content


def repeated_blocks(
    pages: list[tuple[int, list[dict]]], run: int, least: int, known: set[bytes] | None = None
) -> list[set[int]]:
    """For each page the places of its plain blocks that are boilerplate by repetition.

    ``known`` holds the keys that enough pages of the host show; without it these are all of them.
    """
    gone: list[set[int]] = [set() for _ in pages]
    streams = streams_of(pages, run)
    if streams is None:
        return gone
    often = np.zeros(int(streams.ranks.max()) + 1, bool)
    shorts = streams.short_pages()
    if known is None:
        ranks, _ = streams.run_pages()
        shown = np.bincount(ranks, minlength=len(often))
        often = shown >= least
        repeated = {text for text, own in shorts.items() if len(own) >= least}
    else:
        for rank, key in streams.run_keys().items():
            often[rank] = key in known
        repeated = {text for text in shorts if _short_key(text) in known}
    covered = _covered(streams.inside & often[streams.ranks], streams.length)
    counts = np.add.reduceat(covered, streams.starts, dtype=np.int64)
    for block, (page, place) in enumerate(streams.places):
        if streams.kinds[block] == PLAIN and (
            streams.texts[block] in repeated or counts[block] >= 0.9 * streams.sizes[block]
        ):
            gone[page].add(place)
    return gone


def shared_in_articles(
    pages: list[tuple[int, list[dict]]], run: int, least: int, known: set[bytes] | None = None
) -> tuple[int, list[tuple[bytes, int, list[int]]]]:
    """Number of articles; (key, articles, distinct pages) of the runs and short blocks in them.

    Of those in ``known``, without it of those that at least half of the articles show. Of the
    distinct pages ``least`` are enough to know that so many of the host do.
    """
    streams = streams_of(pages, run, articles=True)
    if streams is None:
        return 0, []
    numbers = streams.pages
    total = len(np.unique(numbers))
    ranks, shown = streams.run_pages(numbers)
    counts = np.bincount(ranks, minlength=int(streams.ranks.max()) + 1)
    contents = {page: content for page, content in zip(numbers.tolist(), streams.contents.tolist())}

    def distinct(own) -> list[int]:
        return sorted({contents[page] for page in own})[:least]

    out = []
    wanted = None if known is not None else np.flatnonzero((counts > 0) & (2 * counts >= total))
    for rank, key in streams.run_keys(wanted).items():
        if known is None or key in known:
            first = np.searchsorted(ranks, rank)
            own = shown[first : first + counts[rank]].tolist()
            out.append((key, len(own), distinct(own)))
    for text, own in streams.short_pages(numbers).items():
        if 2 * len(own) >= total if known is None else _short_key(text) in known:
            out.append((_short_key(text), len(own), distinct(own)))
    return total, out


def repeated_in_articles(
    pages: list[tuple[int, list[dict]]], run: int, least: int, known: set[bytes] | None = None
) -> list[set[int]]:
    """For each page the places of its main blocks that are boilerplate by repetition.

    ``known`` holds the keys that enough articles of the host show; without it these are all of them.
    """
    gone: list[set[int]] = [set() for _ in pages]
    if known is None:
        _, shared = shared_in_articles(pages, run, least)
        known = {key for key, _, own in shared if len(own) >= least}
    streams = streams_of(pages, run, articles=True) if known else None
    if streams is None:
        return gone
    often = np.zeros(int(streams.ranks.max()) + 1, bool)
    for rank, key in streams.run_keys().items():
        often[rank] = key in known
    covered = _covered(streams.inside & often[streams.ranks], streams.length)
    counts = np.add.reduceat(covered, streams.starts, dtype=np.int64)
    words, cut = [0] * len(pages), [0] * len(pages)
    for block, (page, place) in enumerate(streams.places):
        size = int(streams.sizes[block])
        words[page] += size
        if counts[block] == size or (
            size < streams.length and _short_key(streams.texts[block]) in known
        ):
            gone[page].add(place)
            cut[page] += size
    return [places if 2 * n <= all_ else set() for places, n, all_ in zip(gone, cut, words)]


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for (host, _), group in groupby(rows, key=lambda row: (row["host"], row["shard"])):
        yield host, list(group)


_TOLD = "host string, shard bigint, kind int, run binary, content bigint"
_COUNTED = "host string, run binary, n bigint, content bigint"
_TEXTS = "page_id bigint, url string, text string, n_chars bigint, n_cut bigint"
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
OUTSIDE, INSIDE, OPEN = 0, 1, 2  # what shards tell: runs outside and in articles, and open hosts


def _rows(schema: str, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    fields = [field.split() for field in schema.split(", ")]
    while some := list(islice(rows, 20_000)):
        yield batch_of({name: (list(c), _TYPES[kind]) for (name, kind), c in zip(fields, zip(*some))})


def _pages_of(rows: list[dict]) -> list[tuple[int, list[dict]]]:
    return [(row["content"], _unpacked(row["packed"])) for row in rows]


def _undecided(blocks: list[dict]) -> bool:
    """No article is marked, so the plain blocks are the text."""
    return any(block["kind"] == PLAIN for block in blocks)


def _tell(batches: Iterator[pa.RecordBatch], run: int, least: int):
    """What shards know (``_TOLD``); of a host that is one shard, only whether it is open."""

    def told() -> Iterator[tuple]:
        for host, rows in _by_shard(batches):
            pages = _pages_of(rows)
            shard = rows[0]["shard"]
            is_open = any(_undecided(blocks) for _, blocks in pages)
            if rows[0]["whole"]:
                is_open = is_open or any(repeated_in_articles(pages, run, least))
            else:
                for key, content in shard_runs(pages, run, least):
                    yield host, shard, OUTSIDE, key, content
                for key, _, _ in shared_in_articles(pages, run, least)[1]:
                    yield host, shard, INSIDE, key, None
            if is_open:
                yield host, shard, OPEN, None, None

    yield from _rows(_TOLD, told())


def _count(batches: Iterator[pa.RecordBatch], run: int, least: int):
    """How many articles of each shard show the runs asked for, and with no run all articles."""

    def counted() -> Iterator[tuple]:
        for host, rows in _by_shard(batches):
            asked = {row["run"] for row in rows if row["run"] is not None}
            pages = _pages_of([row for row in rows if row["run"] is None])
            total, shared = shared_in_articles(pages, run, least, asked)
            yield host, None, total, None
            for key, n, own in shared:
                for nth, content in enumerate(own):
                    yield host, key, 0 if nth else n, content

    yield from _rows(_COUNTED, counted())


def _clean(batches: Iterator[pa.RecordBatch], run: int, least: int):
    """Texts of the pages of open hosts, of shards with the runs known of their host."""

    def texts() -> Iterator[tuple]:
        for _, rows in _by_shard(batches):
            known: dict[bool, set[bytes] | None] = {True: set(), False: set()}
            for row in rows:
                if row["run"] is not None:
                    known[row["article"]].add(row["run"])
            rows = [row for row in rows if row["run"] is None]
            if rows and rows[0]["whole"]:
                known = {True: None, False: None}
            pages = _pages_of(rows)
            plain = repeated_blocks(pages, run, least, known[False])
            main = repeated_in_articles(pages, run, least, known[True])
            for row, (_, blocks), *gone in zip(rows, pages, plain, main):
                kind = PLAIN if _undecided(blocks) else MAIN
                gone = gone[0] | gone[1]
                own = [(i, b["text"]) for i, b in enumerate(blocks) if b["kind"] == kind]
                text = "\n".join([t for i, t in own if i not in gone])
                cut = sum(t.count(" ") + 1 for i, t in own if i in gone)
                yield row["page_id"], row["url"], text, len(text), cut

    yield from _rows(_TEXTS, texts())


def main_text(
    pages: DataFrame, run: int = 16, least_pages: int = 3, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """page_id, url, text, n_chars, n_cut of pages with page_id, url, html.

    Boilerplate is what ``least_pages`` distinct pages of a host show in runs of ``run`` words, in
    articles if half of them do. A task holds one shard of a host at a time: at most some
    ``shard_words`` words.
    """
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z]+://([^/?#]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"),
        F.col("html").cast("string"), host.alias("host"),
    )

    def few(hosts: DataFrame) -> DataFrame:
        """To be broadcast if they are few, as counted."""
        return F.broadcast(hosts) if hosts.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else hosts

    shard_chars = WORD_CHARS * shard_words
    sizes = stage(rows.groupBy("host").agg(F.sum(F.length("html")).alias("n")), "html-sizes")
    shards = sizes.filter(F.col("n") > shard_chars).select(
        "host", F.ceil(F.col("n") / shard_chars).alias("n_shards")
    )
    parts = max(
        spark.sparkContext.defaultParallelism, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // shard_chars)
    )
    # by id and url, so that every pass deals alike and copies of a page spread
    dealt = rows.join(few(shards), "host", "left").select(
        "host",
        F.pmod(F.xxhash64("page_id", "url"), F.coalesce("n_shards", F.lit(1))).alias("shard"),
        F.col("n_shards").isNull().alias("whole"),
        "page_id", "url", "html",
    )

    def parsed(frame: DataFrame) -> DataFrame:
        kinds = ", ".join(f"{n} {k}" for n, k in frame.dtypes if n != "html")
        return in_batches(frame, _parse, f"{kinds}, content bigint, packed binary")

    def by_shard(frame: DataFrame, function, schema: str) -> DataFrame:
        together = frame.repartition(parts, "host", "shard").sortWithinPartitions("host", "shard")
        return in_batches(together, partial(function, run=run, least=least_pages), schema)

    told = stage(by_shard(parsed(dealt.drop("page_id", "url")), _tell, _TOLD), "html-runs")
    asked = told.filter(F.col("kind") == INSIDE).select("host", "run").distinct()

    def in_all_shards(runs: DataFrame) -> DataFrame:
        shard = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_shards") - 1))
        return runs.join(few(shards), "host").select("host", shard.alias("shard"), "run")

    inside = asked
    if not asked.isEmpty():
        some = dealt.join(few(asked.select("host").distinct()), "host", "left_semi")
        shown = parsed(some.drop("page_id", "url")).unionByName(in_all_shards(asked), allowMissingColumns=True)
        counted = stage(by_shard(shown, _count, _COUNTED), "html-counts")
        articles = counted.filter("run IS NULL").groupBy("host").agg(F.sum("n").alias("articles"))
        inside = (
            counted.filter("run IS NOT NULL").groupBy("host", "run")
            .agg(F.sum("n").alias("n"), F.countDistinct("content").alias("n_pages"))
            .join(articles, "host")
            .filter((2 * F.col("n") >= F.col("articles")) & (F.col("n_pages") >= least_pages))
            .select("host", "run")
        )
    open_hosts = told.filter(F.col("kind") == OPEN).select("host").unionByName(inside.select("host"))
    open_hosts = stage(open_hosts.distinct(), "html-open")

    outside = told.filter(F.col("kind") == OUTSIDE).join(few(open_hosts), "host", "left_semi")
    known = (
        outside.groupBy("host", "run")
        .agg(F.countDistinct("content").alias("n_pages"))
        .filter(F.col("n_pages") >= least_pages)
        .select("host", "run")
    )
    answers = outside.select("host", "shard", "run").distinct().join(known, ["host", "run"])
    answers = answers.withColumn("article", F.lit(False)).unionByName(
        in_all_shards(inside).withColumn("article", F.lit(True))
    )
    shown = parsed(dealt.join(few(open_hosts), "host", "left_semi")).unionByName(
        answers, allowMissingColumns=True
    )
    decided = by_shard(shown, _clean, _TEXTS)
    closed = dealt.join(few(open_hosts), "host", "left_anti").select("page_id", "url", "html")
    marked = in_batches(closed, _articles, "page_id bigint, url string, text string").select(
        "page_id", "url", "text",
        F.length("text").cast("bigint").alias("n_chars"), F.lit(0).cast("bigint").alias("n_cut"),
    )
    return marked.unionByName(decided)
