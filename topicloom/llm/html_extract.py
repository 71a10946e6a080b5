"""HTML extraction: structure first, then a host suffix array for what structure leaves in doubt.

A page's markup is cut into blocks of text in one pass. Blocks in menus, headers, footers, sidebars, notices, adverts,
forms, reader comments, scripts and styles are dropped. If the page has an article or main element, the blocks inside
are its text, since passages there may well recur on other pages; where it has none, every block is in doubt. So are,
inside an article, blocks whose class only hints at something else ("promo-text", a paragraph of class "notice").

Blocks in doubt face the suffix array of their host: the token streams of all its pages' blocks outside articles and in
doubt are concatenated and suffixes sorted. A run of RUN tokens or more that stands on PAGES distinct pages is
boilerplate. A block that such runs cover from end to end goes; any other stays whole, so no sentence is cut. Pages are
distinct by what they say: copies of a page count once, and can't erase each other.

A host is cut into shards of bounded size. Each shard's suffix array gives every distinct run of RUN tokens once for
each of its first PAGES pages; these meet by a 128-bit digest over the whole host, so that runs shared across shards
count too and no hot host lands in one task.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.shared import lean, materialize, prepare
from topicloom.llm.url_filters import host_of

#: Tokens in the shortest run that counts as boilerplate, and the distinct pages of a host that it must stand on.
RUN, PAGES = 12, 3
#: Tokens of a host that one suffix array takes, about.
SHARD_TOKENS = 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
SKIPPED = RAW | frozenset("head nav header footer aside form button select option menu dialog audio video canvas map".split())
CONTAINERS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold the text itself: a name on one of them puts it in doubt but doesn't drop it.
CONTENT = HEADINGS | frozenset("p li dt dd td th blockquote pre figcaption caption".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
#: Words of class names and identifiers that tell what isn't article text.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead comment comments disqus respond replies "
    "social share sharing related recommended teaser teasers widget widgets login signup search".split()
)
#: Words that only say where or in what form, so that "site-header" or "share-buttons-top" still is one thing by name.
NEUTRAL = frozenset(
    "site page global main top bottom left right primary secondary header bar box area block list item items container wrapper wrap inner outer section links link "
    "button buttons icons slot unit form text posts articles content group panel thread".split()
)
#: A name that begins so tells of the layout around it.
STATES = frozenset("has with no without is js layout".split())
COMMENTS = frozenset("comment comments disqus respond replies".split())
#: What the heading of reader comments says, in four languages.
COMMENTS_HEADING = re.compile(
    r"(?:\d+ )?(?:comments?|responses?|replies|reader comments|leave a (?:comment|reply)|kommentare?|commentaires?|comentarios?)(?: \(\d+\))?:?", re.IGNORECASE
)
#: A paragraph ends where one of these begins.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Inline elements that are looked through for an open paragraph.
MOST_INLINE = 64
_TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+)*+)>"""
)
_ATTR = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?+""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.IGNORECASE) for t in RAW}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

WANTED, DOUBTED, SOFT, HARD = range(4)


def _by_name(value: str) -> int:
    """What a class attribute or identifier says: nothing, a hint, what isn't article text, or reader comments."""
    worst = WANTED
    for token in value.split():
        words = [w.lower() for w in _WORDS.findall(token)]
        if not words or words[0] in STATES:
            continue
        named = NAMED.intersection(words)
        if words in (["header"], ["site", "header"], ["page", "header"], ["main", "header"], ["global", "header"]):
            worst = max(worst, SOFT)
        elif named:
            plain = all(w in NAMED or w in NEUTRAL or w.isdigit() for w in words)
            worst = max(worst, DOUBTED if not plain else HARD if named & COMMENTS else SOFT)
    return worst


def _judged(tag: str, attributes: str) -> tuple[int, bool]:
    """How an element is taken, and whether it is a container."""
    container = tag in CONTAINERS
    if tag in SKIPPED:
        return HARD, False
    if not attributes or attributes.isspace() or tag in ("html", "body"):
        return WANTED, container
    worst = WANTED
    for name, *values in _ATTR.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            return HARD, container
        if name == "role":
            if value.lower() in ROLES:
                return HARD, container
            container |= value.lower() == "main"
        elif name == "itemprop":
            container |= value == "articleBody"
        elif name in ("class", "id"):
            worst = max(worst, _by_name(value))
    if container and tag == "main":
        worst = WANTED
    return (min(worst, DOUBTED) if tag in CONTENT else worst), container


class _Reader:
    """One pass over a page. Blocks are (text, in a container, in a container under a soft name, doubted, its container)."""

    def __init__(self) -> None:
        self.found: list[tuple[str, bool, bool, bool, int]] = []
        self.text: list[str] = []
        self.stack: list[tuple[str, int, bool]] = []  # tag, how it is taken, whether it is a container
        self.open: Counter[str] = Counter()
        self.levels = [0, 0, 0, 0]
        self.boxes: list[str] = []  # tags of the outermost containers
        self.chars: list[list[int]] = []  # of each: all characters, those of links
        self.depth = 0
        self.seen = False

    def say(self, s: str) -> None:
        if not self.levels[HARD]:
            self.text.append(s)
            if self.depth and self.open["a"]:
                self.chars[-1][1] += len(s)

    def close_block(self) -> None:
        if not self.text:
            return
        body = " ".join(html.unescape("".join(self.text)).split())
        self.text.clear()
        if not body or (self.levels[SOFT] and not self.depth):
            return
        if self.depth:
            self.chars[-1][0] += len(body)
        self.found.append((body, self.depth > 0, self.levels[SOFT] > 0, self.levels[DOUBTED] > 0, len(self.boxes) - 1))
        if self.stack and self.stack[-1][0] in HEADINGS and len(body) < 40 and COMMENTS_HEADING.fullmatch(body):
            self.reader_comments()

    def reader_comments(self) -> None:
        """The section that a heading of comments stands in is theirs, unless it is the article itself."""
        for i in range(len(self.stack) - 2, -1, -1):
            tag, taken, container = self.stack[i]
            if tag in INLINE or tag in HEADINGS:
                continue
            if tag in ("section", "div", "main") and not (container and tag != "main") and taken != HARD:
                self.found.pop()
                self.levels[taken] -= 1
                self.levels[HARD] += 1
                self.stack[i] = (tag, HARD, container)
            return

    def push(self, tag: str, taken: int, container: bool) -> None:
        if container and not self.depth and not self.levels[HARD]:
            self.boxes.append(tag)
            self.chars.append([0, 0])
            self.seen = True
        container = container and not self.levels[HARD]
        self.stack.append((tag, taken, container))
        self.open[tag] += 1
        self.levels[taken] += 1
        self.depth += container

    def leave(self, n: int) -> None:
        self.close_block()
        while len(self.stack) > n:
            tag, taken, container = self.stack.pop()
            self.open[tag] -= 1
            self.levels[taken] -= 1
            self.depth -= container

    def end(self, tag: str) -> None:
        if not self.open[tag]:
            if tag == "br":
                self.say(" ")
            elif tag == "p":
                self.close_block()
            return
        i = len(self.stack) - 1
        plain = True
        while self.stack[i][0] != tag:
            plain &= self.stack[i][0] in INLINE and self.stack[i][1] == WANTED
            i -= 1
        if tag in INLINE and plain and self.stack[i][1] == WANTED:  # text of a block may go on after it
            for t, taken, _ in self.stack[i:]:
                self.open[t] -= 1
                self.levels[taken] -= 1
            del self.stack[i:]
        else:
            self.leave(i)

    def begin(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.say(" ")
            elif tag == "hr":
                self.close_block()
            return
        if tag in ENDS_P and self.open["p"]:
            for i in range(len(self.stack) - 1, max(-1, len(self.stack) - MOST_INLINE), -1):
                if self.stack[i][0] == "p":
                    self.leave(i)
                    break
                if self.stack[i][0] not in INLINE:
                    break
        if tag in INLINE and attributes.rstrip().endswith("/"):
            return
        taken, container = _judged(tag, attributes)
        if taken or tag not in INLINE:
            self.close_block()
        self.push(tag, taken, container)

    def read(self, page: str) -> None:
        """HTML's own rule for what isn't closed is kept: a tag or comment that never ends takes the rest of the page."""
        at, unclosed = 0, set()
        while (lt := page.find("<", at)) >= 0:
            if lt > at:
                self.say(page[at:lt])
            after = page[lt + 1 : lt + 2]
            if after in ("!", "?"):
                if page.startswith("<!--", lt):
                    to = page.find("-->", lt + 4)
                    at = to + 3
                elif page.startswith("<![CDATA[", lt) and "]" not in unclosed:
                    to = page.find("]]>", lt + 9)
                    if to < 0:
                        unclosed.add("]")
                        at = lt
                        continue
                    self.say(html.escape(page[lt + 9 : to]))
                    at = to + 3
                else:
                    to = page.find(">", lt)
                    at = to + 1
                if to < 0:
                    at = len(page)
                continue
            if not (after.isascii() and after.isalpha()) and not (after == "/" and page[lt + 2 : lt + 3].isalpha()):
                if after == "/":  # a comment, however it looks
                    to = page.find(">", lt)
                    at = to + 1 if to >= 0 else len(page)
                else:
                    self.say("<")
                    at = lt + 1
                continue
            m = _TAG.match(page, lt)
            if not m:
                at = len(page)
                break
            at, tag = m.end(), m[2].lower()
            if m[1]:
                self.end(tag)
            elif tag in RAW:
                e = None if tag in unclosed else _RAW_END[tag].search(page, at)
                if e:
                    at = e.end()
                elif tag not in ("svg", "math"):
                    at = len(page)
                else:
                    unclosed.add(tag)
            else:
                self.begin(tag, m[3])
        if at < len(page):
            self.say(page[at:])
        self.close_block()

    def blocks(self) -> list[tuple[str, int]]:
        """(text, 0 wanted, 1 in doubt, 2 only told to the host) in page order."""
        inside = [b for b in self.found if b[1] and not b[2]]
        buried = not inside and any(b[1] for b in self.found)
        if not (inside or buried):
            return [(b[0], 1) for b in self.found if not b[2]] if not self.seen else [(b[0], 2) for b in self.found if not b[2]]
        own = [b for b in self.found if b[1]] if buried else inside
        boxes = {b[4] for b in own}
        mains = {i for i in boxes if self.boxes[i] == "main"}
        kept = mains or boxes
        if len(kept) > 1:  # teasers are links
            kept = {i for i in kept if 2 * self.chars[i][1] <= self.chars[i][0]} or kept
        chosen = {id(b) for b in own if b[4] in kept}
        return [(b[0], int(b[3]) if id(b) in chosen else 2) for b in self.found if id(b) in chosen or not b[2]]


def blocks(page: str) -> list[tuple[str, int]]:
    reader = _Reader()
    reader.read(page)
    return reader.blocks()


_PARTS = pa.list_(pa.struct([("text", pa.string()), ("state", pa.int32())]))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, page_id, url, host, html) to row, page_id, url, host, text (null while in doubt), parts."""
    for b in batches:
        texts, parts = [], []
        for page in b.column(4).to_pylist():
            found = blocks(page or "")
            doubted = any(state == 1 for _, state in found)
            texts.append(None if doubted else " ".join(t for t, state in found if not state))
            parts.append([{"text": t, "state": state} for t, state in found if doubted or state])
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(texts, pa.string()), pa.array(parts, _PARTS)], ["row", "page_id", "url", "host", "text", "parts"])


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in order of their first `depth` codes (by prefix doubling), and the rank classes of the positions:
    equal ranks mean equal runs of `depth` codes. Runs don't reach past the end."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    done = 1
    while done < depth:
        step = min(done, depth - done)
        ahead = np.full(n, -1, dtype=np.int64)
        ahead[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        done += step
    return np.argsort(rank, kind="stable"), rank


def _digest(tokens: list[str]) -> bytes:
    return xxhash.xxh3_128_digest("\x00".join(tokens))


def _stream(parts: list[dict]) -> list[str]:
    """The tokens of a page's blocks that are in doubt or only told to the host."""
    return [t for p in parts if p["state"] for t in p["text"].split(" ")]


def _shard_runs(run: int, pages: int):
    def close(host: str, streams: dict[bytes, list[str]]) -> pa.RecordBatch:
        """Each distinct run of a shard with up to `pages` of the pages it stands on."""
        names = list(streams)
        stream: list[str | None] = []
        owner: list[int] = []
        for i, tokens in enumerate(streams.values()):
            stream += [*tokens, None]  # no run crosses pages
            owner += [i] * (len(tokens) + 1)
        vocabulary: dict[str, int] = {}
        codes = np.array([-1 - i if t is None else vocabulary.setdefault(t, len(vocabulary)) for i, t in enumerate(stream)], dtype=np.int64)
        barrier = np.cumsum(codes < 0)
        order, rank = suffix_array(codes, run)
        full = np.zeros(len(codes), dtype=bool)
        if len(codes) > run:
            full[:-run] = (barrier[run - 1 : -1] == barrier[:-run]) & (codes[:-run] >= 0)
        order = order[full[order]]
        ranks, who = rank[order], np.array(owner, dtype=np.int64)[order]
        # Stable order: the pages of a run ascend, so a page's first place in a run is where owner or run changes.
        new_run = np.r_[True, ranks[1:] != ranks[:-1]] if len(order) else np.zeros(0, dtype=bool)
        new_page = new_run | np.r_[True, who[1:] != who[:-1]] if len(order) else new_run
        nth = np.cumsum(new_page) - np.repeat(np.cumsum(new_page)[new_run], np.diff(np.append(np.flatnonzero(new_run), len(order)))) if len(order) else who
        take = new_page & (nth < pages)
        group = np.cumsum(new_run) - 1
        digests = [_digest(stream[p : p + run]) for p in order[new_run].tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([host] * int(take.sum()), pa.string()), pa.array([digests[g] for g in group[take].tolist()], pa.binary()), pa.array([names[w] for w in who[take].tolist()], pa.binary())],
            ["host", "run", "page"],
        )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, host, page, parts) sorted by shard."""
        shard, host, streams = None, "", {}
        for b in batches:
            for s, h, page, parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard:
                    if streams:
                        yield close(host, streams)
                    shard, host, streams = s, h, {}
                streams.setdefault(bytes(page), _stream(parts))
        if streams:
            yield close(host, streams)

    return runs


def _page_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, parts) with the digest and the length of the page's stream."""
    for b in batches:
        streams = [_stream(parts) for parts in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([_digest(s) for s in streams], pa.binary()), pa.array([len(s) for s in streams], pa.int64())], ["host", "parts", "page", "size"]
        )


def _places(run: int):
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (row, host, parts): the runs of each page with their places."""
        for b in batches:
            for row, host, parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                tokens = _stream(parts)
                n = max(0, len(tokens) - run + 1)
                runs = [_digest(tokens[i : i + run]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * n, pa.int64()), pa.array([host] * n, pa.string()), pa.array(runs, pa.binary()), pa.array(range(n), pa.int32())], ["row", "host", "run", "place"]
                )

    return places


def _unique(run: int):
    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (page_id, url, parts, places): the text without blocks in doubt that repeated runs cover."""
        for b in batches:
            texts = []
            for parts, places in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                edge = np.zeros(len(_stream(parts)) + 1, dtype=np.int64)
                for p in places or ():
                    edge[p] += 1
                    edge[p + run] -= 1
                covered, at, kept = np.cumsum(edge)[:-1] > 0, 0, []
                for p in parts:
                    n = len(p["text"].split(" ")) if p["state"] else 0
                    if not p["state"] or (p["state"] == 1 and not covered[at : at + n].all()):
                        kept.append(p["text"])
                    at += n
                texts.append(" ".join(kept))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return unique


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    run: int = RUN,
    least_pages: int = PAGES,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Per row of `pages`: id_col, url_col, text (empty if none), n_chars.

    Null and empty html give empty text; a page without host shares a nameless one. Repeated rows and copies are one
    page to the suffix array and get the same text. Pages are read in one pass, so time grows with their length only.
    Other columns of `pages` are left out. An empty table gives an empty result.
    """
    prepare(pages.sparkSession)
    slim = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        host_of(F.col(f"`{url_col}`").cast("string")).alias("host"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    of_id = slim.schema["page_id"].dataType.simpleString()
    schema = f"row long, page_id {of_id}, url string, host string, text string, parts array<struct<text:string,state:int>>"
    split = materialize(slim.mapInArrow(lean(_split), schema), "blocks")
    doubted = split.where("text is null")
    result = split.where("text is not null").select("page_id", "url", "text")
    if not doubted.isEmpty():
        hosts = materialize(doubted.select("host").distinct(), "hosts")
        told = split.where("exists(parts, p -> p.state > 0)").join(hosts, "host", "left_semi").select("host", "parts")
        digests = told.mapInArrow(_page_digests, "host string, parts array<struct<text:string,state:int>>, page binary, size long")
        evidence = materialize(digests.where(F.col("size") >= run), "evidence")
        weight = evidence.groupBy("host").agg(F.sum("size").alias("total"))
        # Copies of a page meet in one shard, and count once.
        dealt = evidence.join(weight, "host").withColumn(
            "shard", F.concat_ws("\x00", "host", F.expr(f"pmod(xxhash64(page), cast(ceil(total / {shard_tokens}) as int))"))
        )
        runs = dealt.select("shard", "host", "page", "parts").repartition("shard").sortWithinPartitions("shard", "page")
        found = runs.mapInArrow(lean(_shard_runs(run, least_pages)), "host string, run binary, page binary")
        # Shards share no page, so rows of a run are its distinct pages.
        repeated = materialize(found.groupBy("host", "run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages).select("host", "run"), "repeated-runs")
        own = doubted.select("row", "host", "parts").mapInArrow(lean(_places(run)), "row long, host string, run binary, place int")
        covered = own.join(repeated, ["host", "run"]).groupBy("row").agg(F.collect_set("place").alias("places"))
        rest = doubted.join(covered, "row", "left").select("page_id", "url", "parts", "places")
        result = result.unionByName(rest.mapInArrow(lean(_unique(run)), f"page_id {of_id}, url string, text string"))
    return result.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
