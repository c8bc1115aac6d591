"""Fill-in-middle transformation by content-defined chunk memoization.

A text is cut into units (words of A-Z letters, or single other code points)
at two random unit counts; the three parts are put in the order in which a
model learns to fill in the middle.  Finding the cuts takes the number of
units of every text and the place of two of them:

1. a rolling hash of the last ``WINDOW`` bytes cuts the text into chunks, so
   passages that many documents share are cut alike wherever they stand;
2. the summary of a chunk is its number of units and code points, and whether
   a letter is at its first and last byte.  Summaries are kept by content: a
   chunk finds the summary of an earlier one only if all its bytes are equal;
3. two chunks combine by adding their counts, less one if a word goes across
   the boundary.  A search over the running counts finds the chunk that holds
   a cut, and only this chunk is walked.

The whole work is one pass without a shuffle.  The cache belongs to a task
and is bounded in bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.words import mix

#: The marks of the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Bytes under the rolling hash; a power of two.
WINDOW = 32
#: A chunk has 2 ** CHUNK_BITS bytes on the average, and never more than
#: MOST; the next one begins at least LEAST bytes later.
CHUNK_BITS = 10
LEAST, MOST = 128, 1 << 16
#: Bytes of text hashed at a time, and bytes of chunks that a task remembers.
PIECE_BYTES = 1 << 19
CACHE_BYTES = 32 << 20
#: Rows of a batch that goes back to Spark.
ROWS = 256

_UNIT = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xBF][\x80-\xBF]*")
_RANDOM = mix(np.arange(1001, 1257, dtype=np.uint64)).astype(np.uint32)
_FACTOR = 0x9E3779B1


def _rolling(piece: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each byte of a piece (of fewer
    bytes, at its start)."""
    h, width = _RANDOM[piece], 1
    while width < WINDOW:
        after = h.copy()
        after[width:] += h[:-width] * np.uint32(pow(_FACTOR, width, 1 << 32))
        h, width = after, 2 * width
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a UTF-8 text end; never inside a code point."""
    whole, ends, last = np.frombuffer(data, np.uint8), [], 0

    def cut(at: int):
        nonlocal last
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        last = at
        if at < len(data):
            ends.append(at)

    for at in range(0, len(whole), PIECE_BYTES):
        from_ = max(0, at - WINDOW + 1)
        h = _rolling(whole[from_:at + PIECE_BYTES])[at - from_:]
        marks = at + 1 + np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0)
        i, stop = 0, at + len(h)
        while True:
            i += int(np.searchsorted(marks[i:], last + LEAST))
            mark = int(marks[i]) if i < len(marks) else stop
            if mark - last > MOST:
                cut(last + MOST)
            elif i < len(marks):
                cut(mark)
            else:
                break
    ends.append(len(data))
    return ends


class UnitCounter:
    """Counts and finds units; remembers the summaries of chunks."""

    def __init__(self, cache_bytes: int = CACHE_BYTES):
        self.limit, self.held = cache_bytes, 0
        self.seen: dict[bytes, tuple[int, int, bool, bool]] = {}

    def _summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        """(units, code points, first byte is a letter, last byte is one)."""
        found = self.seen.get(chunk)  # a dict compares the bytes, not only their hash
        if found is None:
            units = len(_UNIT.findall(chunk))
            found = units, len(chunk.decode()), chunk[:1].isalpha(), chunk[-1:].isalpha()
            if self.held + len(chunk) > self.limit:
                self.seen.clear()
                self.held = 0
            self.seen[chunk] = found
            self.held += len(chunk)
        return found

    def read(self, data: bytes) -> CountedText:
        ends = chunk_ends(data) if data else []
        starts = [0, *ends[:-1]]
        units, chars, joined, before = [], [], [], False
        for lo, hi in zip(starts, ends):
            n, points, first, last = self._summary(data[lo:hi])
            across = first and before
            units.append(n - across)  # units that begin in this chunk
            chars.append(points)
            joined.append(across)
            before = last
        return CountedText(data, starts, ends, np.cumsum(units), np.cumsum(chars), joined)


class CountedText:
    """A text, the running counts of its chunks, and the places of its units."""

    def __init__(self, data, starts, ends, units, chars, joined):
        self.data, self.starts, self.ends, self.units, self.chars, self.joined = data, starts, ends, units, chars, joined
        self.n = int(units[-1]) if len(units) else 0

    def place(self, unit: int) -> tuple[int, int]:
        """(byte, code point) at which a unit begins; the end for ``n``."""
        if unit >= self.n:
            return len(self.data), int(self.chars[-1]) if len(self.chars) else 0
        k = int(np.searchsorted(self.units, unit, side="right"))
        inside = unit - (int(self.units[k - 1]) if k else 0) + self.joined[k]
        lo, hi = self.starts[k], self.ends[k]
        for i, m in enumerate(_UNIT.finditer(self.data, lo, hi)):
            if i == inside:
                break
        before = int(self.chars[k - 1]) if k else 0
        return m.start(), before + len(self.data[lo:m.start()].decode())


def _transformed(at: int):
    """Add n, form, the lengths of prefix and middle, and the output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnitCounter()
        marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
        p, s, m = marks
        for b in (whole.slice(lo, ROWS) for whole in batches for lo in range(0, whole.num_rows, ROWS)):
            n, form, before, middle, out = [], [], [], [], []
            texts = b.column(at).cast(pa.binary()).to_pylist()
            asked, h1, h2 = (b[c].to_pylist() for c in ("_form", "_h1", "_h2"))
            for text, kind, a, z in zip(texts, asked, h1, h2):
                text = text or b""
                counted = counter.read(text)
                n.append(counted.n)
                if not text or kind == "plain" or any(x in text for x in marks):
                    form.append("plain")
                    before.append(None)
                    middle.append(None)
                    out.append(text)
                    continue
                cuts = sorted((a % (counted.n + 1), z % (counted.n + 1)))
                (lo, first), (hi, second) = counted.place(cuts[0]), counted.place(cuts[1])
                form.append(kind)
                before.append(first)
                middle.append(second - first)
                parts = [s, text[hi:], p, text[:lo]] if kind == "spm" else [p, text[:lo], s, text[hi:]]
                out.append(b"".join([*parts, m, text[lo:hi]]))
            own = [c for c, name in zip(b.columns, b.schema.names) if name not in ("_form", "_h1", "_h2")]
            own += [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(own, names=[f"c{i}" for i in range(len(own))])
    return run


def fill_in_middle(docs: DataFrame, seed: int = 1, fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``docs`` with the columns ``n`` (units of the text), ``form`` (plain,
    psm or spm), ``prefix_chars``, ``middle_chars`` (code points; null if
    plain) and ``output`` (the transformed text).  They replace columns of
    those names; all others are passed on.

    Units are matches of ``[A-Za-z]+|[^A-Za-z]`` from the left.  The draws of
    a document are the first four 8-digit groups of the hex SHA-256 of the
    seed, a colon and its ``doc_id``: the first two cut, the third keeps the
    text plain in all but ``fim_percent`` of 100 cases, the fourth puts the
    suffix first in ``spm_percent``.  So reruns agree, and rows that repeat a
    ``doc_id`` and its text have equal results.

    A null text counts as empty.  Empty texts and those that hold a mark
    (``<P>``, ``<S>``, ``<M>``) stay plain, so ``restored`` is exact.  A null
    ``doc_id`` draws as an empty one.  An empty table gives an empty table.
    """
    added = ["n", "form", "prefix_chars", "middle_chars", "output"]
    docs = docs.drop(*added)
    names = docs.columns
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    form = (F.when(draw[2] % 100 >= fim_percent, "plain").when(draw[3] % 100 < spm_percent, "spm")
            .otherwise("psm"))
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), digest.alias("_digest"))
    rows = rows.select(*(f"c{i}" for i in range(len(names))), form.alias("_form"),
                       draw[0].alias("_h1"), draw[1].alias("_h2"))
    kinds = [f.dataType for f in docs.schema] + [T.LongType(), T.StringType(), T.LongType(), T.LongType(),
                                                 T.StringType()]
    return rows.mapInArrow(_transformed(names.index("text")),
                           T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)])
                           ).toDF(*names, *added)


def restored(output: Column, form: Column) -> Column:
    """The text from which ``fill_in_middle`` made an output of a form.  The
    marks are unique in it: no text that holds one is transformed."""
    after = 1 + len(PREFIX)
    second = F.when(form == "spm", F.locate(PREFIX, output)).otherwise(F.locate(SUFFIX, output))
    last = F.locate(MIDDLE, output)
    head = output.substr(F.lit(after), second - after)
    tail = output.substr(second + len(SUFFIX), last - second - len(SUFFIX))
    middle = output.substr(last + len(MIDDLE), F.length(output))
    return (F.when(form == "psm", F.concat(head, middle, tail))
            .when(form == "spm", F.concat(tail, middle, head)).otherwise(output))
