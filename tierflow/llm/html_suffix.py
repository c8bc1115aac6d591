"""Main text of web pages, with a suffix array per host.

Pages are parsed to blocks of text.  The token streams of a host's pages are
concatenated, and a suffix array, sorted to the depth of ``min_run`` tokens,
finds all substrings of that length or more that recur on another page of the
host, and on how many pages each stands.  Blocks that such runs cover are
boilerplate; what is unique to a page stays.

Every page of every host goes through this, and every block is judged by it.
Repetition alone can't judge two cases, so markup raises or lowers its bar
there.  Inside an ``article`` or ``main`` element other pages may repeat a
passage (copies of an article, quotes, licence lines): a block goes only if
runs that stand on most pages of the host (wide ones) cover it, and not if
they cover the article as a whole.  Menus, headers, footers, sidebars,
notices, adverts, forms and comments go although no other page of the host
repeats them.  A class or id that only hints at these can't drop an article
(see ``_roles``).

A large host is cut into shards of bounded bytes, by page.  A suffix array
counts the pages of each run inside a shard.  A run that stands on most pages
of the host does so in one of its shards at least, so the shards first name
such runs, then all of them count these.  If a host has blocks that need to
know whether a run recurs at all (``OPEN`` or ``HINT``), the hashes of all
distinct runs of its shards are counted.  So the result doesn't depend on the
shards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.stages import staged
from tierflow.llm.words import grams, word_hashes

MIN_RUN = 8
COVERED = 0.5
#: A block of an article goes if its runs stand on this share of the pages of
#: the host, and on so many pages at least.
WIDE_SHARE, WIDE_PAGES = 0.5, 5
#: Bytes of html in a shard of a host, about.
SHARD_BYTES = 1 << 20
#: Bytes of html to a token, about.
TOKEN_BYTES = 6
#: Shards whose runs are compared in one group, on the average.
SHARDS_A_PART = 16

#: Roles of text.  HINT: inside an article, but marked as a side.
ARTICLE, OPEN, SIDE, HINT = 0, 1, 2, 3
#: Kinds of elements: without a mark; article or main; an article marked as a
#: side; a side by element or role; header element; class or id a side word;
#: the same, but a word for a header; a side word in a part of class or id;
#: class or id with a main word.
PLAIN, MAIN, NOTED, ASIDE, HEADER, WORD, TOP, PART, NAMED = range(9)

# HTML elements by their role.
RAW = "script style noscript template textarea title iframe"
SIDES = "nav footer aside form dialog menu svg object select button"
VOID = "area base br col embed hr img input link meta param source track wbr"
#: Elements whose end tag is often left out: they open no region.
LOOSE = "p li dt dd tr td th thead tbody tfoot option b i em strong u s small sub sup font html body"
BLOCKS = ("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
          "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section "
          "summary table tbody td tfoot th thead tr ul title")
#: Words of class and id attributes that mark what is not the article.
SIDE_WORDS = ("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie "
              "cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice "
              "pagination popup promo promoted related share sharing sidebar signup social sponsor sponsored "
              "subscribe toolbar widget")
MAIN_WORDS = "article articlebody entry post postbody"

_RAW, _SIDES, _VOID, _LOOSE, _BLOCKS = (frozenset(x.split()) for x in (RAW, SIDES, VOID, LOOSE, BLOCKS))
_SIDE_WORDS, _MAIN_WORDS = frozenset(SIDE_WORDS.split()), frozenset(MAIN_WORDS.split())
_TOP_WORDS = frozenset(("header", "masthead"))
_SIDE_MARKS = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form"))
_TAG = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""")
_HINT = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HINT_WORD = re.compile(r"[a-z0-9]+")


def _kind(tag: str, attributes: str) -> int:
    """What an element says of its text."""
    marks: list[str] = []
    main, whole, parts = False, set(), set()
    for name, value in _HINT.findall(attributes):
        value = value.strip("\"'").lower()
        words = set(_HINT_WORD.findall(value))
        if name.lower() == "role":
            marks += words
        else:
            main = main or bool(words & _MAIN_WORDS)
            whole |= _SIDE_WORDS.intersection(value.split())
            parts |= words & _SIDE_WORDS
    if tag == "main" or "main" in marks:
        return MAIN
    if tag == "article" or "article" in marks:
        return NOTED if parts else MAIN
    if tag == "form":
        return WORD
    if tag in _SIDES or tag == "head" or _SIDE_MARKS.intersection(marks):
        return ASIDE
    if tag == "header":
        return HEADER
    if whole:
        return TOP if parts <= _TOP_WORDS else WORD
    if parts:
        return PLAIN if parts <= _TOP_WORDS else PART
    return NAMED if main else PLAIN


def _roles(kinds: list[int], above: list[int], own: list[int]) -> list[int]:
    """Role of each region, given its kind, the region around it (of a lower
    index) and the code points of its own blocks.

    An article or main element is an article wherever it stands, unless it is
    itself marked as a side and stands in one (a comment, a teaser).  A class
    or id that is a side word, a form and a side element that is never closed
    may be wrappers: they are no side if they hold an article, or half of the
    article they stand in, or half of a page without articles.  A word that is
    only a part of a class or id (no-sidebar, entry-header) makes no side: the
    suffix array judges the text, as it does that of the large ones."""
    n = len(kinds)
    size, holds, outer = own[:], [False] * n, [False] * n
    for r in range(n - 1, 0, -1):
        holds[r] = holds[r] or kinds[r] == MAIN and size[r] > 0
        holds[above[r]] |= holds[r]
        if kinds[r] != ASIDE:
            size[above[r]] += size[r]
    roles, article = [OPEN] * n, [0] * n
    found = False
    for r in range(1, n):
        up, kind = above[r], kinds[r]
        outer[r] = outer[up] or kind == ASIDE or kind in (WORD, TOP) and not holds[r]
        found |= size[r] > 0 and not outer[r] and kind in (MAIN, NOTED, NAMED)
    for r in range(1, n):
        up, kind = above[r], kinds[r]
        role, article[r] = roles[up], article[up]
        inside = role in (ARTICLE, HINT)
        if kind == MAIN or role != SIDE and kind in (NOTED, NAMED):
            role, article[r] = ARTICLE, r
        elif kind == ASIDE or kind == HEADER and not inside:
            role = SIDE
        elif (kind == WORD or kind == TOP and not inside) and role != SIDE and not holds[r]:
            large = 2 * size[r] >= size[article[r]] and (inside or not found)
            role = SIDE if not large else HINT if inside else OPEN
        elif kind == PART and role == ARTICLE:
            role = HINT
        roles[r] = role
    return roles


def parse(html: str) -> list[tuple[int, str]]:
    """Blocks of a page: (role, text), in order, without empty ones.  A tag or
    comment that is cut off at the end of the page has no text."""
    blocks: list[tuple[int, str]] = []
    held: list[str] = []
    # regions of the page; the first is the page itself
    kinds, above, own = [PLAIN], [0], [0]
    stack: list[tuple[str, int]] = []
    region, at = 0, 0

    def flush():
        text = " ".join("".join(held).split())
        if text:
            blocks.append((region, text))
            own[region] += len(text)
        held.clear()

    def unclosed(r: int):
        if kinds[r] == ASIDE:
            kinds[r] = WORD

    while at < len(html):
        m = _TAG.search(html, at)
        if not m:
            rest = html[at:]
            cut = re.search(r"<[a-zA-Z/!?][^>]*$", rest)
            held.append(unescape(rest[:cut.start()] if cut else rest))
            break
        if m.start() > at:
            held.append(unescape(html[at:m.start()]))
        at = m.end()
        if m.group().startswith("<!"):
            if m.group() == "<!--":
                end = html.find("-->", at)
                at = end + 3 if end >= 0 else len(html)
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in _BLOCKS:
            flush()
        if tag == "body":  # it ends the head, closed or not
            stack, region = [], 0
        if m[1]:
            if any(t == tag for t, _ in stack):
                flush()
                while True:
                    name, r = stack.pop()
                    region = above[r]
                    if name == tag:
                        break
                    unclosed(r)
            continue
        if tag in _RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in _VOID or tag in _LOOSE or m[3].endswith("/"):
            continue
        kind = _kind(tag, m[3])
        if kind != PLAIN:
            flush()
        kinds.append(kind)
        above.append(region)
        own.append(0)
        region = len(kinds) - 1
        stack.append((tag, region))
    flush()
    for _, r in stack:
        unclosed(r)
    roles = _roles(kinds, above, own)
    return [(roles[r], text) for r, text in blocks]


def run_pages(tokens: np.ndarray, page: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, number of pages that hold it) of each run of ``depth`` tokens
    inside one of the concatenated pages, by start.  ``page`` does not decrease."""
    n = len(tokens)
    if n < depth:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # ranks of the suffixes by their first 1, 2, 4, ... tokens, up to the depth
    rank, width = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while width < depth:
        step = min(width, depth - width)
        after = np.full(n, -1, np.int64)
        after[:n - step] = rank[step:]
        rank, width = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64), width + step
    start = np.flatnonzero(page[:n - depth + 1] == page[depth - 1:])  # inside one page
    by_rank = np.argsort(rank[start], kind="stable")
    order = start[by_rank]
    count = np.empty(len(start), np.int64)
    if len(order):
        # suffixes of equal prefix are neighbours; the stable sort keeps them by page
        fresh = np.diff(rank[order], prepend=-1) != 0
        first = np.flatnonzero(fresh)
        pages = np.add.reduceat((fresh | (np.diff(page[order], prepend=-1) != 0)).astype(np.int64), first)
        count[by_rank] = np.repeat(pages, np.diff(first, append=len(order)))
    return start, count


def _cover(n: int, start: np.ndarray, depth: int) -> np.ndarray:
    """Which of n tokens lie in a run of ``depth`` tokens from one of ``start``."""
    edges = np.zeros(n + 1, np.int64)
    edges[start] += 1
    np.subtract.at(edges, start + depth, 1)
    return np.cumsum(edges[:n]) > 0


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, depth: int) -> np.ndarray:
    """Which tokens of concatenated pages lie in a substring of ``depth``
    tokens that also occurs on another page.  ``page`` does not decrease."""
    start, count = run_pages(tokens, page, depth)
    return _cover(len(tokens), start[count > 1], depth)


def _streams(pages: list[list[tuple[int, str]]], owner: list) -> tuple[np.ndarray, np.ndarray, list, list[list[int]]]:
    """Token hashes of the pages of a shard, those of one ``owner`` side by
    side; the number of the owner of each token; (page, start, end); and the
    number of words of each block of a page.  Hash 0 is a mark before each
    block.  Hashes depend on the words alone, so those of all shards compare."""
    names: dict = {}
    order = sorted(range(len(pages)), key=lambda i: names.setdefault(owner[i], len(names)))
    sizes = [[len(text.split()) for _, text in blocks] for blocks in pages]
    ends = np.cumsum([sum(sizes[i]) + len(sizes[i]) for i in order], dtype=np.int64)
    marks = np.asarray([n + 1 for i in order for n in sizes[i]], np.int64)
    total = int(ends[-1]) if len(ends) else 0
    word = np.ones(total, bool)
    word[np.cumsum(marks) - marks] = False
    tokens = np.zeros(total, np.uint64)
    tokens[word] = word_hashes("\n".join(text for i in order for _, text in pages[i]).encode())
    starts = np.concatenate([[0], ends]).astype(np.int64)
    whose = np.repeat(np.asarray([names[owner[i]] for i in order], np.int64), np.diff(starts))
    return tokens, whose, [(i, int(a), int(b)) for i, a, b in zip(order, starts, ends)], sizes


def _runs(tokens: np.ndarray, start: np.ndarray, depth: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes of ``bits`` of the runs from ``start``, the first
    place of each in ``start``, and the number of each run."""
    return np.unique(grams(tokens, depth)[start] >> np.uint64(64 - bits), return_index=True, return_inverse=True)


def _bits(shards: int, shard_bytes: int) -> int:
    """Bits of a run's hash: of all the runs of a host less than one pair is
    expected to agree by chance.  Fewer bits are less to shuffle."""
    return min(64, 2 * max(16, int(np.ceil(np.log2(max(shards * shard_bytes / TOKEN_BYTES, 1))))))


def _packed(values: np.ndarray) -> bytes:
    """Numbers, byte by byte of each, compressed."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(),
                       codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def judge(pages: list[list[tuple[int, str]]], owner: list, min_run: int = MIN_RUN, covered: float = COVERED,
          everywhere: tuple | None = None) -> list[tuple[str, int, int]]:
    """(text, repeated words, words of wide runs) of the pages of one shard,
    given as blocks.  Pages of the same ``owner`` are one page; ``everywhere``
    has, of a host of several shards, runs of this shard (None: all), the pages
    of the host that hold each, the number of its pages, and the bits of a
    run's hash.

    Side blocks go.  An open one or a hint goes if repeated runs cover at least
    the share ``covered`` of it, a block of an article if wide runs do; inside
    an article only if the article is no copy as a whole, i.e. they cover less
    of it.  If nothing would be left of a page without an article, it is a copy
    as a whole: its blocks stay."""
    tokens, whose, cuts, sizes = _streams(pages, owner)
    start, count = run_pages(tokens, whose, min_run)
    n_pages = len(set(owner))
    if everywhere is not None:
        known, held, n_pages, bits = everywhere
        found, _, number = _runs(tokens, start, min_run, bits)
        total = held
        if known is not None:
            total = np.zeros(len(found), np.int64)
            total[np.searchsorted(found, known)] = held
        count = np.maximum(count, total[number])
    again = _cover(len(tokens), start[count > 1], min_run)
    wide = _cover(len(tokens), start[count >= max(WIDE_PAGES, WIDE_SHARE * n_pages)], min_run)
    # sums over any stretch of tokens
    again, wide = (np.concatenate([[0], np.cumsum(x)]).tolist() for x in (again, wide))
    out: list[tuple[str, int, int]] = [("", 0, 0)] * len(pages)
    for i, first, end in cuts:
        kept, opened, blocks, at = [], [], [], first
        inside, in_wide, in_again = 0, 0, 0
        for (role, text), n in zip(pages[i], sizes[i]):
            at, to = at + 1, at + 1 + n
            found, widely = again[to] - again[at], wide[to] - wide[at]
            blocks.append((role, text, (widely if role == ARTICLE else found) >= covered * n))
            if role in (ARTICLE, HINT):
                inside, in_wide, in_again = inside + n, in_wide + widely, in_again + found
            at = to
        copied = {ARTICLE: in_wide >= covered * inside, HINT: in_again >= covered * inside}
        for role, text, mostly in blocks:
            if role != SIDE and not mostly or copied.get(role):
                kept.append(text)
            if role in (OPEN, HINT):
                opened.append(text)
        out[i] = "\n".join(kept or opened), again[end] - again[first], wide[end] - wide[first]
    return out


def keep_unique(pages: list[list[tuple[int, str]]], owner: list, min_run: int = MIN_RUN,
                covered: float = COVERED) -> list[tuple[str, int]]:
    """(text, repeated words) of the pages of a host, see ``judge``."""
    return [(text, n) for text, n, _ in judge(pages, owner, min_run, covered)]


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as the roles of their blocks, a byte each, and the texts, one a
    line, compressed."""
    for b in batches:
        roles, sizes, texts = [], [], []
        for html in b["html"].to_pylist():
            blocks = parse(html or "")
            text = "\n".join(t for _, t in blocks).encode()
            roles.append(bytes(r for r, _ in blocks))
            sizes.append(len(text))
            texts.append(pa.compress(text, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays(
            [*(b[c] for c in ("page_id", "url", "host", "shards", "shard")), pa.array(roles, pa.binary()),
             pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())],
            names=["page_id", "url", "host", "shards", "shard", "roles", "size", "texts"])


def _pages(table: pa.Table) -> tuple[list, list]:
    """Blocks and owner of each page of a shard."""
    blocks = []
    for roles, size, packed in zip(*(table[c].to_pylist() for c in ("roles", "size", "texts"))):
        text = pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True).decode() if size else ""
        blocks.append(list(zip(roles, text.split("\n"))))
    return blocks, list(zip(table["page_id"].to_pylist(), table["url"].to_pylist()))


def _has_open(blocks: list[tuple[int, str]]) -> bool:
    return any(r in (OPEN, HINT) for r, _ in blocks)


def _counted(table: pa.Table, min_run: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of a shard, sorted, and the pages of it that hold each."""
    tokens, whose, _, _ = _streams(*_pages(table))
    start, count = run_pages(tokens, whose, min_run)
    found, first, _ = _runs(tokens, start, min_run, _bits(table["shards"][0].as_py(), shard_bytes))
    return found, count[first]


def _split(runs: np.ndarray, shards: int, shard_bytes: int) -> list[tuple[int, int]]:
    """(start, end) of each part of sorted runs; parts are ranges of hashes."""
    parts = -(-shards // SHARDS_A_PART)
    part = (runs >> np.uint64(_bits(shards, shard_bytes) - 32)) * np.uint64(parts) >> np.uint64(32)
    edges = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64)).tolist()
    return list(zip(edges[:-1], edges[1:]))


_NAMED_RUNS = pa.schema([("host", pa.string()), ("part", pa.int64()), ("shard", pa.int32()), ("shards", pa.int32()),
                         ("open", pa.bool_()), ("pages", pa.int64()), ("n", pa.int64()), ("runs", pa.binary())])
_COUNTED_RUNS = pa.schema([*_NAMED_RUNS, ("held", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _shard_wide(min_run: int, shard_bytes: int):
    """The runs on most pages of a shard, by part; the first part also has
    whether blocks are open and the number of pages.  None if the shard is the
    whole host."""
    def run(table: pa.Table) -> pa.Table:
        host, shard, shards = (table[c][0].as_py() for c in ("host", "shard", "shards"))
        rows = []
        if shards > 1:
            blocks, owner = _pages(table)
            found, held = _counted(table, min_run, shard_bytes)
            pages = len(set(owner))
            found = found[held >= WIDE_SHARE * pages]
            for part, (a, b) in enumerate(_split(found, shards, shard_bytes)):
                if b > a or not part:
                    rows.append((host, part, shard, shards, not part and any(map(_has_open, blocks)),
                                 0 if part else pages, b - a, _packed(found[a:b])))
        return _table(rows, _NAMED_RUNS)
    return run


def _host_wide(table: pa.Table) -> pa.Table:
    """Of one part of the runs that shards name: all, for each shard."""
    host, part, shards = (table[c][0].as_py() for c in ("host", "part", "shards"))
    runs = np.unique(np.concatenate([_unpacked(x, n) for x, n in zip(table["runs"].to_pylist(), table["n"].to_pylist())]))
    row = (shards, any(table["open"].to_pylist()), sum(table["pages"].to_pylist()), len(runs), _packed(runs))
    return _table([(host, part, shard, *row) for shard in range(shards)], _NAMED_RUNS)


def _shard_runs(min_run: int, shard_bytes: int):
    """The runs of a shard that its host must count and the pages of the shard
    that hold each, by part: all if the host has open blocks, else those named."""
    def run(table: pa.Table, named: pa.Table) -> pa.Table:
        rows = []
        opened, pages = any(named["open"].to_pylist()), sum(named["pages"].to_pylist())
        if len(table) and (opened or sum(named["n"].to_pylist())):
            host, shard, shards = (table[c][0].as_py() for c in ("host", "shard", "shards"))
            found, held = _counted(table, min_run, shard_bytes)
            if not opened:
                wanted = np.isin(found, np.concatenate([_unpacked(x, n) for x, n in zip(named["runs"].to_pylist(),
                                                                                       named["n"].to_pylist())]))
                found, held = found[wanted], held[wanted]
            for part, (a, b) in enumerate(_split(found, shards, shard_bytes)):
                if b > a:
                    rows.append((host, part, shard, shards, opened, pages, b - a,
                                 _packed(np.diff(found[a:b], prepend=np.uint64(0))), _packed(held[a:b])))
        return _table(rows, _COUNTED_RUNS)
    return run


def _shared_runs(table: pa.Table) -> pa.Table:
    """Of one part of the runs of a host: for each shard, the pages of the host
    that hold each of its runs.  Pages are dealt whole, so the shards add up.
    A shard whose runs are all counted knows them."""
    sizes = table["n"].to_pylist()
    runs = np.concatenate([np.cumsum(_unpacked(x, n), dtype=np.uint64) for x, n in zip(table["runs"].to_pylist(), sizes)])
    held = np.concatenate([_unpacked(x, n) for x, n in zip(table["held"].to_pylist(), sizes)])
    _, number = np.unique(runs, return_inverse=True)
    total = np.bincount(number, weights=held)[number]
    held = pa.array([_packed(x) for x in np.split(total, np.cumsum(sizes)[:-1])], pa.binary())
    if table["open"][0].as_py():
        table = table.set_column(table.column_names.index("runs"), "runs", pa.nulls(len(sizes), pa.binary()))
    return table.set_column(table.column_names.index("held"), "held", held)


def _shard_texts(min_run: int, covered: float, shard_bytes: int):
    """The pages of a shard."""
    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        everywhere = None
        if len(shared):
            shared = shared.sort_by("part")
            sizes, runs = shared["n"].to_pylist(), shared["runs"].to_pylist()
            known = None if shared["open"][0].as_py() else np.concatenate(
                [np.cumsum(_unpacked(x, n), dtype=np.uint64) for x, n in zip(runs, sizes)])
            held = np.concatenate([_unpacked(x, n) for x, n in zip(shared["held"].to_pylist(), sizes)])
            everywhere = (known, held.astype(np.int64), shared["pages"][0].as_py(),
                          _bits(shared["shards"][0].as_py(), shard_bytes))
        pages, owner = _pages(table)
        found = judge(pages, owner, min_run, covered, everywhere)
        return pa.table({"page_id": table["page_id"], "url": table["url"],
                         "text": pa.array([t for t, _, _ in found], pa.string()),
                         "n_repeated": pa.array([n if _has_open(p) else None for p, (_, n, _) in zip(pages, found)],
                                                pa.int64()),
                         "n_wide": pa.array([n for _, _, n in found], pa.int64())})
    return run


def extract_main_text(pages: DataFrame, min_run: int = MIN_RUN, covered: float = COVERED,
                      shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """page_id, url, text (empty if none), n_chars (its code points),
    n_repeated and n_wide of (page_id, url, html).  n_wide counts the words of
    a page in runs that stand on most pages of the host, n_repeated those that
    recur on another page of it, boilerplate or not; the latter is null if
    markup leaves no block of the page open.

    Character references are decoded, white space inside a block becomes one
    space, and blocks are joined by one line end.  Null and empty html gives
    an empty text.  Pages without a host are one host.  Rows that repeat a
    page_id and url are one page, so they are no repetition of each other.
    An empty table gives an empty table.  Other columns are ignored.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    # the html of a host sets the number of its shards, and so their size; few hosts have more than one
    large = staged(rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("n")).where(F.col("n") > shard_bytes)
                   .select("host", F.ceil(F.col("n") / shard_bytes).cast("int").alias("shards")), "html-hosts")
    shards = F.coalesce("shards", F.lit(1))
    blocks = (rows.join(F.broadcast(large), "host", "left")
              .select("page_id", "url", "html", "host", shards.alias("shards"),
                      F.pmod(F.xxhash64("page_id", "url"), shards).cast("int").alias("shard"))
              .mapInArrow(_parse_batches, "page_id long, url string, host string, shards int, shard int, roles binary, "
                                          "size long, texts binary"))
    # all uses of the blocks by shard read one shuffle
    by_shard = blocks.groupBy("host", "shard")
    named = "host string, part long, shard int, shards int, open boolean, pages long, n long, runs binary"
    counted = f"{named}, held binary"
    wide = (by_shard.applyInArrow(_shard_wide(min_run, shard_bytes), named)
            .groupBy("host", "part").applyInArrow(_host_wide, named))
    shared = (by_shard.cogroup(wide.groupBy("host", "shard")).applyInArrow(_shard_runs(min_run, shard_bytes), counted)
              .groupBy("host", "part").applyInArrow(_shared_runs, counted))
    texts = (by_shard.cogroup(shared.groupBy("host", "shard"))
             .applyInArrow(_shard_texts(min_run, covered, shard_bytes),
                           "page_id long, url string, text string, n_repeated long, n_wide long"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated", "n_wide")
