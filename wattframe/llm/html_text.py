"""Main text of web pages: by page structure, and by what the pages of a host repeat."""

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .shingles import mixed

#: Distinct pages of a host that one suffix array holds, on average.
PAGES_PER_ARRAY = 512
#: Hosts, or runs of hosts, at most, that are sent to all tasks.
MOST_SENT = 500_000
#: Tokens that must be the same on several pages for them to be repeated.
RUN_TOKENS = 6
#: Repeated tokens in a row that are boilerplate in a block that isn't repeated as a whole.
LONG_RUN = 20
#: Distinct pages of a host, whatever its size, on which a run must come to be repeated.
LEAST_PAGES = 3
#: Distinct articles of a host, besides more than half of them, on which a run must come to be no part of an article.
MANY_ARTICLES = 10

# Element names and words of class, id and role.
_UNREAD = "script style template noscript textarea title select svg math iframe object canvas audio video button".split()
_REGIONS = frozenset("nav header footer aside form dialog menu".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)

_CUES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu"
    " breadcrumb breadcrumbs header masthead footer sidebar widget cookie cookies consent gdpr notice popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations"
    " comment comments disqus replies respond form search pagination pager toolbar copyright complementary contentinfo"
    " search alert alertdialog".split()
)
_REMARKS = frozenset("comment comments disqus replies respond reply".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<unread>" + "|".join(_UNREAD) + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=unread)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?(?P<broken>[a-z][^\s/>]*+)[^<>]*+>",
    re.S | re.I,
)
_LABEL = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


class _Element:
    __slots__ = ("name", "labels", "begin", "end", "cued", "container")

    def __init__(self, name: str, attributes: str, begin: int) -> None:
        self.name, self.begin, self.end = name, begin, -1
        self.labels = set()
        for found in _LABEL.finditer(attributes):
            value = found[2] or found[3] or found[4] or ""
            for label in value.lower().split():
                self.labels.add(label)
                self.labels.update(re.split(r"[-_]+", label))
        hidden = bool(attributes) and _HIDDEN.search(attributes) is not None
        remarks = not self.labels.isdisjoint(_REMARKS)
        self.container = name in ("article", "main") and not remarks and not hidden
        self.container = self.container or (name in ("div", "section") and "main" in self.labels)
        cued = hidden or remarks or name in _REGIONS or not self.labels.isdisjoint(_CUES)
        self.cued = cued and not self.container and name not in ("html", "body", "main")


def page_blocks(page: str) -> tuple[str | None, list[str], list[bool]]:
    """The text of a page's article, or None if nothing marks one; the blocks outside it, and which are marked as none.

    White space within a block is one blank; blocks are in page order. An
    element that is never closed ends where an article begins, or with the page.
    """
    # pass 1: elements that can matter, with their extent in tags
    tags = list(_TAG.finditer(page))
    elements: list[_Element] = []
    open_: dict[str, list[_Element]] = {}
    articles: list[int] = []
    for nth, tag in enumerate(tags):
        name = tag["name"] or tag["broken"]
        if not name:
            continue
        name = name.lower()
        if name not in _BLOCKS and name != "span" and name != "a":
            continue
        if tag["end"] or tag[0].startswith("</"):
            if stack := open_.get(name):
                element = stack.pop()
                if element is not None:
                    element.end = nth
            continue
        attributes = tag["attributes"] or ""
        element = None
        if attributes or name in _REGIONS or name in ("article", "main"):
            element = _Element(name, attributes, nth)
            if element.container:
                articles.append(nth)
            if element.cued or element.container:
                elements.append(element)
            else:
                element = None
        open_.setdefault(name, []).append(element)
    for element in elements:
        if element.end < 0:
            later = next((a for a in articles if a > element.begin), len(tags))
            element.end = later if element.cued else len(tags)
    # an element marked as no article that holds one is only its frame; a header within an article may have its title
    container_at = [e for e in elements if e.container]
    if any(e.name == "article" for e in container_at):
        container_at = [e for e in container_at if e.name == "article"]
    cued_at = [
        e
        for e in elements
        if e.cued
        and not (e.name not in ("nav", "aside", "footer") and any(e.begin < c.begin and c.begin < e.end for c in container_at))
        and not (e.name == "header" and any(c.begin < e.begin < c.end for c in container_at))
    ]
    container_at = [c for c in container_at if not any(e.begin < c.begin < e.end for e in cued_at)]
    # pass 2: the text between the tags, in blocks
    change = np.zeros((2, len(tags) + 2), np.int32)
    for row, some in enumerate((container_at, cued_at)):
        for e in some:
            change[row, e.begin + 1] += 1
            change[row, min(e.end, len(tags)) + 1] -= 1
    inside, cued = (np.cumsum(change, axis=1) > 0).tolist()
    main: list[str] = []
    outside: list[str] = []
    marked: list[bool] = []
    run: list[str] = []
    state = (False, False)

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            if state[0] and not state[1]:
                main.append(text)
            else:
                outside.append(text)
                marked.append(state[1])

    at = 0
    for nth, tag in enumerate(tags):
        run.append(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or tag["broken"] or "").lower()
        now = (inside[nth + 1], cued[nth + 1])
        if name in _BLOCKS or now != state:
            flush()
            state = now
        elif name == "br":
            run.append(" ")
    run.append(page[at:])
    flush()
    return ("\n".join(main) if container_at else None), outside, marked


#: In place of a hash for the end of a page with fewer tokens than a run.
_END = np.uint64(0x9E3779B97F4A7C15)


def _hash(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass"))


class _Hashes(dict):
    """Hashes of tokens, kept for so many."""

    def __missing__(self, token: str) -> int:
        found = _hash(token)
        if len(self) < 200_000:
            self[token] = found
        return found


class _Runs:
    """The runs of ``length`` tokens of some pages, equal ones with equal numbers.

    The streams are laid end to end with a mark of its own behind each, and their
    suffixes are sorted by prefix doubling as far as ``length`` tokens; suffixes
    that agree that far are neighbours then. A page with fewer tokens than
    ``length`` has runs too, up to its end.
    """

    def __init__(self, streams: list[list[str]], length: int) -> None:
        self.length = length
        self.sizes = sizes = np.array([len(s) + 1 for s in streams], np.int64)
        self.numbers: dict[str, int] = {}
        self.flat = flat = np.empty(int(sizes.sum()), np.int64)
        self.ends = ends = np.cumsum(sizes)
        alike: dict[tuple[str, ...], int] = {}
        page = np.empty(len(streams), np.int64)
        for k, stream in enumerate(streams):
            flat[ends[k] - sizes[k] : ends[k] - 1] = [self.numbers.setdefault(t, len(self.numbers)) for t in stream]
            page[k] = alike.setdefault(tuple(stream), k)
        # the marks: one for short pages, else one for each, so that no run crosses pages
        self.short = sizes - 1 < length
        flat[ends - 1] = len(self.numbers) + np.where(self.short, 0, 1 + np.arange(len(streams)))
        n = len(flat)
        rank = flat
        reach = 1
        self.after_end = ends[np.repeat(np.arange(len(streams)), sizes)]
        while reach < length:
            step = min(reach, length - reach)
            # beyond its page a suffix is as long as it is
            there = np.arange(n) + step
            second = np.where(there < self.after_end, rank[np.minimum(there, n - 1)] + 1, 0)
            _, rank = np.unique(rank * (n + len(self.numbers) + len(streams) + 2) + second, return_inverse=True)
            rank = rank.reshape(-1)
            reach += step
        self.rank = rank
        self.pages = len(alike)
        # distinct pages among the neighbours that agree
        pairs = np.unique(rank * len(streams) + np.repeat(page, sizes))
        self.spread = np.bincount(pairs // len(streams), minlength=int(rank.max()) + 1)

    def hashes(self, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each run by its number, the same for the same run of other arrays, and which can be on other pages.

        ``some``: the numbers of those that are asked for.
        """
        tokens = np.append(np.array([_hash(t) for t in self.numbers], np.uint64), _END)
        first = np.empty(len(self.spread), np.int64)
        first[self.rank[::-1]] = np.arange(len(self.rank))[::-1]
        first = first if some is None else first[some]
        out = np.zeros(len(first), np.uint64)
        shared = np.ones(len(first), bool)
        for k in range(self.length):
            there = first + k
            inside = there < self.after_end[first]
            token = self.flat[np.minimum(there, len(self.flat) - 1)]
            shared &= ~inside | (token < len(tokens))
            value = np.where(inside, tokens[np.minimum(token, len(tokens) - 1)], np.uint64(k))
            out = mixed(out * np.uint64(3) + value)
        return out, shared

    def covered(self, repeated: np.ndarray) -> list[np.ndarray]:
        """For each page's tokens, which are part of a run whose number is repeated."""
        common = np.zeros(len(self.flat) + 1, np.int64)
        begins = np.flatnonzero(repeated[self.rank])
        stop = np.minimum(begins + self.length, self.after_end[begins])
        np.add.at(common, begins, 1)
        np.add.at(common, stop, -1)
        covered = np.cumsum(common[:-1]) > 0
        return [covered[b - s : b - 1] for b, s in zip(self.ends, self.sizes, strict=True)]


def repeated_tokens(streams: list[list[str]], least: int, length: int = RUN_TOKENS) -> list[np.ndarray]:
    """For each page's tokens, which are part of a run of ``length`` that ``least`` distinct pages have.

    Pages with the same tokens count as one.
    """
    if not streams:
        return []
    runs = _Runs(streams, length)
    return runs.covered(runs.spread >= least)


def unique_text(blocks: list[str], marked: list[bool], covered: np.ndarray) -> str:
    """The blocks that aren't marked as boilerplate, without those covered as a whole and without long covered runs."""
    kept, at = [], 0
    for block, skip in zip(blocks, marked, strict=True):
        tokens = block.split(" ")
        own = covered[at : at + len(tokens)]
        at += len(tokens)
        if skip or own.all():
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
        left, done = [], 0
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if b - a >= LONG_RUN:
                left += tokens[done:a]
                done = b
        kept.append(" ".join(left + tokens[done:]))
    return "\n".join(kept)


_PARSED = "page_id long, url string, host string, main string, blocks array<string>, marked array<boolean>"


def _parsed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        main, blocks, marked = [], [], []
        for page in frame.column(3).to_pylist():
            text, outside, cued = page_blocks(page or "")
            main.append(text)
            blocks.append(outside)
            marked.append(cued)
        columns = [
            *frame.columns[:3],
            pa.array(main, pa.string()),
            pa.array(blocks, pa.list_(pa.string())),
            pa.array(marked, pa.list_(pa.bool_())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "main", "blocks", "marked"])


def _streams(group: pa.Table) -> list[list[str]]:
    return [[t for block in page for t in block.split(" ")] for page in group.column("blocks").to_pylist()]


def _runs_of_array(group: pa.Table) -> pa.Table:
    """The runs of an array's pages, with the number of its distinct pages that have them."""
    runs = _Runs(_streams(group), RUN_TOKENS)
    hashes, shared = runs.hashes()
    n = int(shared.sum())
    key = [pa.repeat(group.column(c)[0], n) for c in ("host", "array")]
    columns = [*key, pa.array(hashes[shared].view(np.int64)), pa.array(runs.spread[shared].astype(np.int64))]
    return pa.table(columns, ["host", "array", "run", "pages"])


def _texts_of_array(group: pa.Table, repeated: pa.Table) -> pa.Table:
    out = pa.schema([("host", pa.string()), ("page", pa.string()), ("text", pa.string())])
    if not len(group):
        return out.empty_table()
    runs = _Runs(_streams(group), RUN_TOKENS)
    if group.column("arrays")[0].as_py() == 1:
        covered = runs.covered(runs.spread >= LEAST_PAGES)
    else:
        hashes, shared = runs.hashes()
        known = repeated.column("run").to_numpy().view(np.uint64)
        covered = runs.covered(shared & np.isin(hashes, known))
    pages = zip(group.column("blocks").to_pylist(), group.column("marked").to_pylist(), covered, strict=True)
    texts = pa.array([unique_text(*page) for page in pages], pa.string())
    return pa.table([group.column("host"), group.column("page"), texts], schema=out)


def _texts_by_host(pages: DataFrame) -> DataFrame:
    """The text of each distinct page (host, page, stream, blocks, marked) without what its host repeats."""
    pages = written(pages.dropDuplicates(["host", "page"]), "distinct-pages")
    # pages of the same tokens are in one array, so the distinct pages of its runs add up over the host
    arrays = written(pages.groupBy("host").agg(F.ceil(F.count("*") / PAGES_PER_ARRAY).alias("arrays")), "arrays")
    array = F.pmod(F.xxhash64("stream"), F.col("arrays")).alias("array")
    dealt = pages.join(_few(arrays), "host").select("host", array, "arrays", "page", "blocks", "marked")
    large = dealt.where("arrays > 1").groupBy("host", "array")
    runs = written(large.applyInArrow(_runs_of_array, "host string, array long, run long, pages long"), "runs")
    repeated = runs.groupBy("host", "run").agg(F.sum("pages").alias("on")).where(F.col("on") >= LEAST_PAGES)
    repeated = runs.join(repeated.select("host", "run"), ["host", "run"], "left_semi").select("host", "array", "run")
    both = dealt.groupBy("host", "array").cogroup(repeated.groupBy("host", "array"))
    return both.applyInArrow(_texts_of_array, "host string, page string, text string")


def _few(hosts: DataFrame, runs: str | None = None) -> DataFrame:
    """The hosts, marked to be sent to all tasks if there are few enough: else pages are shuffled by host first.

    Hosts with lists of runs count by these.
    """
    number = hosts.agg(F.sum(F.size(runs))).first()[0] or 0 if runs else hosts.count()
    return F.broadcast(hosts) if number <= MOST_SENT else hosts


def article_text(article: str, covered: np.ndarray) -> str:
    """The blocks of an article without those covered as a whole; an article that is mostly so is a copy and stays."""
    kept, at, gone = [], 0, 0
    for block in article.split("\n"):
        size = block.count(" ") + 1
        if covered[at : at + size].all():
            gone += size
        else:
            kept.append(block)
        at += size
    return "\n".join(kept) if 2 * gone <= at else article


def _tokens(article: str) -> list[str]:
    return article.replace("\n", " ").split(" ")


_ARTICLES = "host string, stream long, packed binary"
_COMMON = "host string, run long"
_SEEN = "host string, run long, stream long"


def _articles(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The articles of pages (url, host, html), packed, equal ones of a task once; of a host's pages without one a NULL."""
    seen: set[tuple[str, bytes]] = set()
    schema = pa.schema([("host", pa.string()), ("stream", pa.int64()), ("packed", pa.binary())])
    for frame in frames:
        rows = []
        for host, page in zip(frame.column("host").to_pylist(), frame.column("html"), strict=True):
            article = page_blocks(page.as_py())[0]
            text = b"" if article is None else b"\n" + article.encode()
            key = host, xxhash.xxh3_128_digest(text)
            if key not in seen:
                seen.add(key)
                packed = None if article is None else len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)
                rows.append((host, _number(text.replace(b"\n", b" ")), packed))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _number(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _common_of_array(group: pa.Table) -> pa.Table:
    """The runs that more than half of an array's distinct articles have; a NULL if the host has pages without one."""
    packed = group.column("packed").to_pylist()
    streams = [
        _tokens(pa.decompress(p[8:], int.from_bytes(p[:8], "little"), "zstd", asbytes=True)[1:].decode()) for p in packed if p is not None
    ]
    found = [None] if None in packed else []
    if streams:
        runs = _Runs(streams, RUN_TOKENS)
        # a run of most of a host's articles is one of most of some array's
        common = 2 * runs.spread > runs.pages
        if group.column("arrays")[0].as_py() == 1:
            common &= runs.spread >= MANY_ARTICLES
        if common.any():
            hashes, shared = runs.hashes(np.flatnonzero(common))
            found += hashes[shared].view(np.int64).tolist()
    return pa.table([pa.repeat(group.column("host")[0], len(found)), pa.array(found, pa.int64())], ["host", "run"])


def _runs_of_page(tokens: np.ndarray, length: int) -> np.ndarray:
    """The hash of the run that begins at each token of one page, as ``_Runs`` gives it, from the tokens' hashes.

    A page with fewer tokens than ``length`` has runs up to its end, any other only whole ones.
    """
    n = len(tokens)
    begins = np.arange(n - length + 1 if n >= length else n)
    ended = np.append(tokens, _END)
    out = np.zeros(len(begins), np.uint64)
    for k in range(length):
        value = np.where(begins + k <= n, ended[np.minimum(begins + k, n)], np.uint64(k))
        out = mixed(out * np.uint64(3) + value)
    return out


def _known_runs(frame: pa.RecordBatch, hashes: _Hashes) -> Iterator[tuple[int, str | None, np.ndarray, np.ndarray]]:
    """Of each page (host, html, runs) its number and article, the known runs that this has, and which tokens they cover."""
    for nth, (page, known) in enumerate(zip(frame.column("html"), frame.column("runs"), strict=True)):
        article = page_blocks(page.as_py())[0]
        covered = np.zeros(0, bool)
        runs = np.zeros(0, np.uint64)
        if article is not None and known.is_valid:
            tokens = _tokens(article)
            runs = _runs_of_page(np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens)), RUN_TOKENS)
            at = np.flatnonzero(np.isin(runs, known.values.to_numpy().view(np.uint64)))
            covered = np.zeros(len(tokens), bool)
            covered[np.minimum(at[:, None] + np.arange(RUN_TOKENS), len(tokens) - 1)] = True
            runs = np.unique(runs[at])
        yield nth, article, runs, covered


def _seen_runs(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which known runs an article has, and a NULL for each article."""
    schema = pa.schema([("host", pa.string()), ("run", pa.int64()), ("stream", pa.int64())])
    hashes = _Hashes()
    for frame in frames:
        hosts, rows = frame.column("host").to_pylist(), []
        for nth, article, runs, _ in _known_runs(frame, hashes):
            if article is not None:
                stream = _number(b" " + article.replace("\n", " ").encode())
                rows += [(hosts[nth], run, stream) for run in (None, *runs.view(np.int64).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _article_texts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the pages that mark an article, without the blocks in it that consist of known runs."""
    hashes = _Hashes()
    for frame in frames:
        at, texts = [], []
        for nth, article, _, covered in _known_runs(frame, hashes):
            if article is not None:
                at.append(nth)
                texts.append(article_text(article, covered) if covered.any() else article)
        kept = frame.take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _common_runs(rows: DataFrame) -> DataFrame:
    """From pages (host, html) the runs that more than half of the articles of one of a host's arrays have.

    A host with pages that mark no article has a NULL, too.
    """
    arrays = rows.groupBy("host").agg(F.ceil(F.count("*") / PAGES_PER_ARRAY).alias("arrays"))
    articles = rows.select("host", "html").mapInArrow(_articles, _ARTICLES)
    dealt = articles.join(_few(written(arrays, "arrays")), "host")
    dealt = dealt.select("host", F.pmod("stream", "arrays").alias("array"), "arrays", "packed")
    return written(dealt.groupBy("host", "array").applyInArrow(_common_of_array, _COMMON), "common-runs")


def _boilerplate(rows: DataFrame, common: DataFrame) -> DataFrame:
    """Of common runs (host, run) those that come on most of a host's distinct articles, as a list per host."""
    some = common.groupBy("host").agg(F.collect_set("run").alias("runs"))
    seen = rows.join(_few(written(some, "some-runs"), "runs"), "host").select("host", "html", "runs").mapInArrow(_seen_runs, _SEEN)
    on = written(seen.groupBy("host", "run").agg(F.count_distinct("stream").alias("on")), "counted-runs")
    articles = on.where("run IS NULL").select("host", F.col("on").alias("articles"))
    most = (2 * F.col("on") > F.col("articles")) & (F.col("on") >= MANY_ARTICLES)
    most = on.where("run IS NOT NULL").join(articles, "host").where(most)
    return written(most.groupBy("host").agg(F.collect_list("run").alias("runs")), "boilerplate")


def main_texts(pages: DataFrame) -> DataFrame:
    """The main text of each row of ``pages`` (page_id, url, html), as blocks joined by line breaks.

    Scripts, styles and other unread elements go first. If an element marks the
    article, its blocks are the text, without regions inside it that their
    element or label marks as menus, adverts, notices, forms or remarks. The
    articles of a host are laid end to end in suffix arrays, too: runs of
    ``RUN_TOKENS`` that more than half of its distinct articles have, and
    ``MANY_ARTICLES`` at least, are boilerplate, and unmarked blocks that
    consist of them go, unless they are most of the article, which then is a
    copy. Pages without such an element are judged by their host: the tokens outside
    articles of all its pages are laid end to end in suffix arrays, and runs of
    ``RUN_TOKENS`` that ``LEAST_PAGES`` distinct pages of the host have are
    repeated. Blocks that consist of repeated runs go, and of other blocks
    ``LONG_RUN`` repeated tokens or more in a row; what is left and no label
    marks is the text. A host with many pages has several arrays; these report
    hashes of their runs, which are added up over the host, so a host of any
    size is judged alike.

    NULL html counts as empty and gives an empty text. Pages with NULL or odd
    urls form a host of their own. Repeated rows, and pages with the same tokens,
    give a row each and count as one page of a host. Other columns are ignored;
    an empty table gives an empty result. Returns page_id, url, text and n_chars
    (code points).
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    out = ("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    runs = _common_runs(rows)
    common = runs.where("run IS NOT NULL")
    if common.isEmpty():
        marked = rows.withColumn("runs", F.lit(None).cast("array<long>"))
    else:
        marked = rows.join(_few(_boilerplate(rows, common), "runs"), "host", "left")
    marked = marked.select("page_id", "url", "html", "runs")
    found = marked.mapInArrow(_article_texts, "page_id long, url string, text string").select(*out)
    hosts = written(runs.where("run IS NULL").select("host").distinct(), "open-hosts")
    if hosts.isEmpty():
        return found
    parsed = written(rows.join(_few(hosts), "host").select(*rows.columns).mapInArrow(_parsed, _PARSED), "parsed-pages")
    stream = F.md5(F.array_join("blocks", " "))
    page = F.md5(F.concat_ws("\n", F.array_join("blocks", "\n"), F.array_join(F.col("marked").cast("array<string>"), " ")))
    open_ = parsed.withColumns({"stream": stream, "page": page})
    texts = _texts_by_host(open_.select("host", "page", "stream", "blocks", "marked"))
    rest = open_.where("main IS NULL").select("page_id", "url", "host", "page").join(texts, ["host", "page"])
    return found.unionByName(rest.select(*out))
