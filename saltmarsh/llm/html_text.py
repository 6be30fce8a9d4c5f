"""Main text of web pages: markup where it says what a block is, a suffix array over the host's pages where it does not."""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage

#: What elements mean.
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
CHROME = set("nav footer aside form button select menu dialog svg canvas object audio video map head".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CHROME_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar header footer masthead comment comments reply replies disqus respond share sharing social related recommended widget login search skip form forms".split()
)
MAIN_WORDS = set("content article post entry story articlebody maincontent".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*))(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")

MAIN, OPEN, FRAME, HEADING = 0, 1, 2, 3
LEAST_RUN = 4  # tokens of a repeated substring
LEAST_PAGES = 3  # distinct pages it has to be on, and
LEAST_SHARE = 0.2  # share of the distinct pages of its host
BUNDLE = 128  # pages of a host in one suffix array
LETTERS = 4_000_000  # characters of html in one suffix array


def _marks(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element is chrome, is an article or main element, and is content by its class or id."""
    if tag in CHROME:
        return True, False, False
    main, content = tag in ("article", "main"), False
    if not attributes or tag in ("html", "body"):
        return False, main, False
    words: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            words.update(_SPLIT.split(value))
        elif name == "role":
            if value in CHROME_ROLES:
                return True, False, False
            main = main or value in ("main", "article")
        elif name == "itemprop" and value == "articlebody":
            main = True
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True, False, False
    if words & CHROME_WORDS and tag != "main" and not (tag == "article" and not words & {"comment", "comments", "ad", "ads", "sponsored", "promo", "related", "widget"}):
        return True, False, False
    return False, main, bool(words & MAIN_WORDS)


def parse(html: str | None) -> list[tuple[int, str]]:
    """(role, text) of the page's text blocks in order.

    The main text is what lies in article elements, else in a main element, else in elements whose class or id
    names content; without any of them the blocks that no markup marks as chrome are open.
    A header element outside of an article is chrome; inside, its headings count. Open blocks that are mostly link text are chrome.
    """
    if not html:
        return []
    stack: list[tuple[str, int]] = []  # tag, bits: 1 chrome, 2 article, 4 main, 8 content, 16 header, 32 heading, 64 link
    open_tags: dict[str, int] = {}
    bits = 0
    found: list[tuple[int, str, int]] = []
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                found.append((bits, text, linked))
            parts.clear()
        linked = 0

    pos, n = 0, len(html)
    while pos < n:
        m = _TOKEN.search(html, pos)
        end = m.start() if m else n
        if end > pos:
            piece = html[pos:end]
            parts.append(piece)
            if bits & 64:
                linked += len(piece.strip())
        if not m:
            break
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCKS:
                flush()
            if open_tags.get(tag):
                while stack:
                    last, bits_before = stack.pop()
                    open_tags[last] -= 1
                    bits = bits_before
                    if last == tag:
                        break
            continue
        if tag in BLOCKS:
            flush()
            while open_tags.get("p") and tag != "br":  # a paragraph ends where a block begins
                last, bits = stack.pop()
                open_tags[last] -= 1
        if tag in RAW:
            close = re.compile(f"</{tag}", re.I).search(html, pos)
            pos = close.start() if close else n
            stop = html.find(">", pos)
            pos = stop + 1 if stop >= 0 else n
            continue
        if tag in VOID or (m[3] or m[6] or "").endswith("/") and tag not in BLOCKS:
            continue
        chrome, main, content = _marks(tag, m[3] or m[6] or "")
        stack.append((tag, bits))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        bits |= chrome * 1 | (main and tag != "main") * 2 | (tag == "main") * 4 | content * 8
        if tag == "header":
            bits |= 16
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            bits |= 32
        elif tag == "a":
            bits |= 64
    flush()

    def framed(b: int) -> bool:
        return bool(b & 1) or bool(b & 16) and not (b & 2 and b & 32)

    for wanted in (2, 4, 8):
        if any(b & wanted and not framed(b) for b, _, _ in found):
            return [((HEADING if b & 32 else MAIN) if b & wanted and not framed(b) else FRAME, t) for b, t, _ in found]
    return [(FRAME if framed(b) or 2 * k > len(t) else OPEN, t) for b, t, k in found]


def _number(word: str, memo: dict[str, int]) -> int:
    """64 bits that stand for a word in every task."""
    if word not in memo:
        if len(memo) > 1 << 20:
            memo.clear()
        memo[word] = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little")
    return memo[word]


def heads_of(words: np.ndarray, run: int = LEAST_RUN) -> np.ndarray:
    """64-bit hashes of every ``run`` words in a row, from the numbers of the words."""
    n = max(0, len(words) - run + 1)
    out = np.zeros(n, np.uint64)
    for k in range(run):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return out.view(np.int64)


def _distinct(batches):
    """Per page (host, html) the number of its tokens' text, its roles and its blocks, joined by line ends (no block has one) and
    compressed for the shuffle; copies within a task go on once."""
    press = zstandard.ZstdCompressor(level=3)
    seen: set[tuple] = set()
    for batch in batches:
        out: list[tuple] = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            blocks = parse(html.as_py())
            roles, text = [r for r, _ in blocks], "\n".join(t for _, t in blocks)
            key = host, blake2b(text.encode() + b"\n\n" + bytes(roles), digest_size=16).digest()
            if key in seen:
                continue
            if len(seen) > 1 << 20:
                seen.clear()
            seen.add(key)
            content = int.from_bytes(blake2b(text.replace("\n", " ").encode(), digest_size=8).digest(), "little", signed=True)
            out.append((host, content, roles, press.compress(text.encode())))
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["host", "content", "roles", "texts"])


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, ordered by at least the first ``depth`` tokens, and the rank of each suffix's
    first ``depth`` tokens (equal ranks: equal heads)."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    n, have = len(tokens), 1
    while have < depth:
        step = min(have, depth - have)
        ahead = np.full(n, -1, np.int64)
        ahead[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        have += step
    return np.argsort(rank, kind="stable"), rank


def head_pages(pages: list[list[str]], framed: list[np.ndarray], least_run: int) -> tuple:
    """Heads of ``least_run`` tokens by the suffix array of the pages: where each page begins, the rank of the head at each place, the places
    whose head does not run over a page's end, per rank the number of distinct pages (by their tokens) that have it and that have it within
    a frame, and the number of distinct pages."""
    number: dict[str, int] = {}
    distinct: dict[bytes, int] = {}
    streams, owners = [], []
    for p in pages:
        streams.append(np.array([number.setdefault(w, len(number)) for w in p], np.int64))
        owners.append(distinct.setdefault(streams[-1].tobytes(), len(distinct)))
    cut = [np.append(s, -1 - k) for k, s in enumerate(streams)]
    tokens = np.concatenate(cut) if cut else np.zeros(0, np.int64)
    place = np.append(0, np.cumsum([len(c) for c in cut])).astype(np.int64)
    whole = np.zeros(len(tokens), bool)
    if len(tokens) <= least_run:
        return place, np.zeros(len(tokens), np.int64), whole, np.zeros((2, 1), np.int64), len(distinct)
    _, rank = suffix_order(tokens, least_run)
    owner = np.repeat(owners, np.diff(place))
    begun = np.append(0, np.cumsum(np.concatenate([np.append(f, False) for f in framed]).astype(np.int64)))
    head = np.arange(max(0, len(tokens) - least_run + 1))
    for a, s in zip(place[:-1], streams):
        whole[a : a + max(0, len(s) - least_run + 1)] = True
    in_frame = np.zeros(len(tokens), bool)
    in_frame[head] = begun[head + least_run] - begun[head] == least_run
    on = []
    for counted in (whole, whole & in_frame):
        pairs = np.unique(rank[counted] * (len(distinct) + 1) + owner[counted])
        on.append(np.bincount(pairs // (len(distinct) + 1), minlength=int(rank.max()) + 1))
    return place, rank, whole, np.array(on), len(distinct)


def covered(hit: np.ndarray, n: int, least_run: int = LEAST_RUN) -> np.ndarray:
    """Which of ``n`` tokens lie in a head that begins at a place of ``hit``."""
    edges = np.zeros(n + least_run + 1, np.int64)
    edges[hit] += 1
    edges[hit + least_run] -= 1
    return np.cumsum(edges)[:n] > 0


def repeated(pages: list[list[str]], framed: list[np.ndarray], least_run: int = LEAST_RUN, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each page's tokens, which are covered by substrings of ``least_run`` or more tokens that are repeated across enough
    distinct pages, and which by such that are repeated so within frames (``framed`` says which tokens are framed).

    Pages of the same tokens count as one.
    """
    place, rank, whole, on, distinct = head_pages(pages, framed, least_run)
    inside = [covered(np.flatnonzero(whole & (o[rank] >= max(least_pages, least_share * distinct))), len(rank), least_run) for o in on]
    return [(inside[0][a : a + len(p)], inside[1][a : a + len(p)]) for a, p in zip(place[:-1], pages)]


def _words(roles: list[int], texts: list[str]) -> tuple[list[list[str]], np.ndarray]:
    """The tokens of every block, and which tokens of the page are framed."""
    blocks = [t.split(" ") for t in texts]
    return blocks, np.repeat(np.array(roles, np.int64) == FRAME, [len(b) for b in blocks]) if roles else np.zeros(0, bool)


FEW = 16  # distinct pages of a bundle that tells of all its heads; others leave out heads of a single page


def _bundle_heads(table: pa.Table) -> pa.Table:
    """Heads of a bundle with the number of distinct pages that have them and have them within frames. The row without
    a head holds the number of distinct pages. ``loss`` is how many pages a head can have that is left out."""
    open_up = zstandard.ZstdDecompressor()
    memo: dict[str, int] = {}
    pages, frames = [], []
    for roles, packed in zip(table.column("roles").to_pylist(), table.column("texts").to_pylist()):
        blocks, frame = _words(roles, open_up.decompress(packed).decode().split("\n") if roles else [])
        pages.append([w for b in blocks for w in b])
        frames.append(frame)
    place, rank, whole, on, distinct = head_pages(pages, frames, LEAST_RUN)
    if table.column("bundles")[0].as_py() == 1:  # all of the host: heads on too few pages are decided
        least, loss = max(LEAST_PAGES, LEAST_SHARE * distinct), 0
    else:
        least = 1 if distinct < FEW else 2
        loss = least - 1
    at = np.flatnonzero(whole & (on[0][rank] >= least))
    told, first = np.unique(rank[at], return_index=True)
    at = at[first]
    page = np.searchsorted(place, at, side="right") - 1
    head = np.zeros(len(at), np.int64)
    for p in np.unique(page).tolist():
        mine = page == p
        head[mine] = heads_of(np.array([_number(w, memo) for w in pages[p]], np.uint64))[at[mine] - place[p]]
    host = table.column("host")[0].as_py()
    return pa.table(
        [
            pa.array([host] * (len(at) + 1), pa.string()),
            pa.array([None, *head.tolist()], pa.int64()),
            pa.array(np.append(distinct, on[0][told])),
            pa.array(np.append(0, on[1][told])),
            pa.array(np.full(len(at) + 1, loss, np.int64)),
        ],
        ["host", "head", "n", "framed", "loss"],
    )


def _page_heads(batches):
    """Per page (host, html, heads): those of the heads that it has, and whether within a frame."""
    memo: dict[str, int] = {}
    for batch in batches:
        for host, html, wanted in zip(*[batch.column(k) for k in range(3)]):
            blocks = parse(html.as_py())
            parts, frame = _words([r for r, _ in blocks], [t for _, t in blocks])
            words = [w for p in parts for w in p]
            heads = heads_of(np.array([_number(w, memo) for w in words], np.uint64))
            begun = np.append(0, np.cumsum(frame.astype(np.int64)))
            framed = begun[LEAST_RUN:] - begun[:-LEAST_RUN] == LEAST_RUN if len(heads) else np.zeros(0, bool)
            mine = np.isin(heads, wanted.values.to_numpy())
            content = int.from_bytes(blake2b(" ".join(words).encode(), digest_size=8).digest(), "little", signed=True)
            n = int(mine.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([host.as_py()] * n, pa.string()), pa.array(np.full(n, content, np.int64)), pa.array(heads[mine]), pa.array(framed[mine].astype(np.int64))], ["host", "content", "head", "framed"]
            )


def _clean(batches):
    """Pages (page_id, url, html, anywhere, in_frames) without the tokens that the host's repeated heads cover."""
    memo: dict[str, int] = {}
    for batch in batches:
        out = []
        for html, *given in zip(*[batch.column(k) for k in (2, 3, 4)]):
            blocks = parse(html.as_py())
            parts, _ = _words([r for r, _ in blocks], [t for _, t in blocks])
            heads = heads_of(np.array([_number(w, memo) for p in parts for w in p], np.uint64))
            n = sum(map(len, parts))
            anywhere, in_frames = (covered(np.flatnonzero(np.isin(heads, g.values.to_numpy())), n) if g.is_valid and len(g.values) else np.zeros(n, bool) for g in given)
            kept, at = [], 0
            for (role, text), block in zip(blocks, parts):
                here = slice(at, at + len(block))
                at += len(block)
                if role == HEADING or role == MAIN and not in_frames[here].all():
                    kept.append(text)
                elif role == OPEN:
                    kept.extend(w for w, gone in zip(block, anywhere[here].tolist()) if not gone)
            out.append(" ".join(kept))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def repeated_heads(pages: DataFrame) -> DataFrame:
    """Per host the heads that are on at least ``LEAST_PAGES`` and ``LEAST_SHARE`` of all its distinct pages (``anywhere``) and that are so
    within frames (``in_frames``).

    Suffix arrays of bundles give the pages of each head, which are added up over the host's bundles. Pages of
    equal tokens lie in one bundle and count once. Large bundles leave out heads of a single page; heads for which that could
    decide are counted again on all pages of the host.
    """
    sizes = pages.groupBy("host").agg(F.count("*").alias("pages"), F.sum(F.coalesce(F.length("html"), F.lit(0))).alias("letters"))
    bundles = F.greatest(F.ceil(F.col("pages") / BUNDLE), F.ceil(F.col("letters") / LETTERS))
    sizes = cut_lineage(sizes.select("host", bundles.cast("long").alias("bundles")))
    distinct = pages.select("host", "html").mapInArrow(_distinct, "host string, content long, roles array<int>, texts binary")
    dealt = distinct.join(sizes, "host").withColumn("bundle", F.pmod("content", "bundles"))
    told = cut_lineage(dealt.groupBy("host", "bundle").applyInArrow(_bundle_heads, "host string, head long, n long, framed long, loss long"))
    least = F.greatest(F.lit(float(LEAST_PAGES)), F.sum("n") * F.lit(LEAST_SHARE))
    hosts = told.where("head IS NULL").groupBy("host").agg(least.alias("least"), F.sum("loss").alias("all_loss"))
    heads = told.where("head IS NOT NULL").groupBy("host", "head").agg(F.sum("n").alias("n"), F.sum("framed").alias("framed"), F.sum("loss").alias("loss")).join(hosts, "host")
    missed = F.col("all_loss") - F.col("loss")
    heads = heads.where(F.col("n") + missed >= F.col("least"))
    open_ = F.greatest(*[F.when((F.col(c) < F.col("least")) & (F.col(c) + missed >= F.col("least")), 1).otherwise(0) for c in ("n", "framed")]) == 1
    heads = cut_lineage(heads.select("host", "head", "n", "framed", "least", open_.alias("open")))
    decided, rest = heads.where("NOT open"), heads.where("open")
    if not rest.isEmpty():
        wanted = rest.groupBy("host").agg(F.collect_list("head").alias("heads"))
        found = pages.join(wanted, "host").select("host", "html", "heads").mapInArrow(_page_heads, "host string, content long, head long, framed long")
        on = found.groupBy("host", "content", "head").agg(F.max("framed").alias("framed")).groupBy("host", "head").agg(F.count("*").alias("n"), F.sum("framed").alias("framed"))
        decided = decided.unionByName(on.join(rest.select("host", "head", "least", "open"), ["host", "head"]))
    hit = [F.collect_list(F.when(F.col(c) >= F.col("least"), F.col("head"))).alias(name) for c, name in (("n", "anywhere"), ("framed", "in_frames"))]
    return cut_lineage(decided.where("n >= least").groupBy("host").agg(*hit))


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    The token streams of a host's distinct pages are concatenated in bundles, by a hash of the tokens, of about ``BUNDLE`` pages and at most about
    ``LETTERS`` characters of html, so that a large host is many bundles; only a single longer page exceeds that. Suffix arrays of the
    bundles show the substrings of ``LEAST_RUN`` or more tokens that repeat across distinct pages; their pages are counted over the whole host.
    Where markup says what the article is, its headings stay, and a block of it goes if
    it is covered by substrings that repeat across pages as frames (menus, notices, footers): whole articles and
    passages do recur on other pages, and are no boilerplate for that. Of other pages, everything covered goes from the open blocks
    and unique runs stay.

    Null or empty html: empty text. Null url: the host is empty. Repeated rows are extracted each for itself.
    Other columns are not read. An empty table gives an empty table.
    """
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host = F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit(""))
    hits = repeated_heads(rows.select(host.alias("host"), "html"))
    text = rows.withColumn("host", host).join(hits, "host", "left").select("page_id", "url", "html", "anywhere", "in_frames").mapInArrow(_clean, "page_id long, url string, text string")
    return text.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
