"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed against all earlier text (documents of smaller
``doc_id``, and its own earlier words).  Factors of ``window`` words or more
are duplicate spans, and their words are removed.  The result is exact up to
hashes: a word goes if and only if a window of ``window`` consecutive words
covers it whose words also start earlier.

The reference is indexed in blocks.  Of each window, the ``anchor``-word gram
of smallest hash is its anchor, so equal windows have equal anchors wherever
they stand, and neighbouring windows mostly share one: a block is the run of
windows with the same anchor (about eight).  The jobs are

1. hash the texts, and list each document's anchors;
2. keep the anchors that occur at two places (all others start no copy);
3. give each document its kept anchors, and cut its text into blocks;
4. index the blocks: each distinct one refers to its first place, and every
   other place of it is a piece of a factor that refers there;
5. at the ends of factors, where blocks share an anchor but not all words, the
   windows are checked one by one and give pieces of one window;
6. parse each document greedily from its start: a factor takes in piece after
   piece, blocks and windows alike, while they follow each other both in the
   document and in the reference;
7. join the factors to the texts and cut them out.

A piece refers to the first place of its words, so where that place moves to
another text a new factor starts, even if the old reference would run on; this
splits factors, but covers the same words.  No job compares documents in
pairs: 4 and 5 keep the first place of each block or window by aggregation, so
a passage in a third of all documents is counted map-side, and 6 sorts the
pieces of one document.  Copies of a whole text are parsed once: each later one
is a single factor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.stages import staged
from tierflow.llm.words import grams, grouped, mix

WINDOW = 20
ANCHOR = 6

_U = np.uint64
_LAST = (1 << 63) - 1


def _blocks(h: np.ndarray, counts: np.ndarray, window: int, anchor: int):
    """Blocks of the texts whose word hashes are ``h``: text, first window
    (word offset in the text), number of windows, anchor hash; and the hash of
    each window with the block it is in."""
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(h) - window + 1
    if n <= 0 or not (counts >= window).any():
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, _U), np.empty(0, _U)
    ok = np.flatnonzero(text[:n] == text[window - 1:])
    g = grams(h, anchor)
    best, at = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window - anchor + 1):
        smaller = g[j:j + n] < best
        np.copyto(best, g[j:j + n], where=smaller)
        at[smaller] = j
    at = (at + np.arange(n))[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1] + 1)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(ok)))
    where = text[ok[start]]
    return where, ok[start] - first[where], size, best[ok[start]], grams(h, window)[ok]


def _anchor_lists(window: int, anchor: int):
    """Per document, its distinct anchors and those that recur inside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].cast(pa.binary()).to_pylist()
            once, again, length = [None] * len(texts), [None] * len(texts), np.zeros(len(texts), np.int64)
            for lo, h, counts in grouped(texts):
                length[lo:lo + len(counts)] = counts
                where, _, _, g, _ = _blocks(h, counts, window, anchor)
                cut = np.searchsorted(where, np.arange(len(counts) + 1))
                for i in range(len(counts)):
                    own, n = np.unique(g[cut[i]:cut[i + 1]], return_counts=True)
                    once[lo + i], again[lo + i] = own.view(np.int64), own[n > 1].view(np.int64)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["ord"], b["d1"], b["d2"], pa.array(length), pa.array(once, kind), pa.array(again, kind)],
                names=["ord", "d1", "d2", "n_words", "anchors", "recurring"])
    return run


_ANCHORS = "ord long, d1 long, d2 long, n_words long, anchors array<long>, recurring array<long>"


def _cut_blocks(window: int, anchor: int):
    """The blocks of each document that have a kept anchor, with the hash of
    each of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].cast(pa.binary()).to_pylist()
            order, d1 = b["ord"].to_numpy(), b["d1"].to_numpy()
            kept = [np.asarray(x, np.int64) for x in b["kept"].to_pylist()]
            for lo, h, counts in grouped(texts):
                where, start, size, g, w = _blocks(h, counts, window, anchor)
                cut = np.searchsorted(where, np.arange(len(counts) + 1))
                keep = np.zeros(len(where), bool)
                for i in range(len(counts)):
                    own = slice(cut[i], cut[i + 1])
                    keep[own] = np.isin(g[own].view(np.int64), kept[lo + i])
                if not keep.any():
                    continue
                wanted = np.repeat(keep, size)
                begin = np.cumsum(size) - size
                # the first and last window of a block cover all of its words
                same = mix(mix(w[begin]) + w[begin + size - 1] * _U(0x9FB21C651E98DF25)
                           + size.astype(_U))[keep]
                offsets = np.append(0, np.cumsum(size[keep])).astype(np.int32)
                whole = pa.ListArray.from_arrays(pa.array(offsets), pa.array(w[wanted].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[keep].view(np.int64)), pa.array(same.view(np.int64)),
                     pa.array(order[lo + where[keep]]), pa.array(d1[lo + where[keep]]),
                     pa.array(start[keep].astype(np.int32)), pa.array(size[keep].astype(np.int32)), whole],
                    names=["g", "same", "ord", "d1", "start", "size", "windows"])
    return run


_BLOCKS = "g long, same long, ord long, d1 long, start int, size int, windows array<long>"


def _cut_spans(text_at: int):
    """Remove the words that spans cover; what is kept is joined by spaces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text_at).cast(pa.binary()).to_pylist()
            out, words, removed = [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            spans, copy = b["_spans"].to_pylist(), b["_copy"].to_pylist()
            for i, t in enumerate(texts):
                w = (t or b"").split()
                words[i] = len(w)
                if copy[i]:
                    w = []
                elif spans[i]:
                    at = np.asarray(spans[i], np.int64)
                    depth = np.zeros(len(w) + 1, np.int64)
                    np.add.at(depth, at >> 32, 1)
                    np.add.at(depth, at & 0xFFFFFFFF, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    w = [x for x, g in zip(w, gone) if not g]
                removed[i] = words[i] - len(w)
                out.append(b" ".join(w))
            own = [c for c, name in zip(b.columns, b.schema.names) if name not in ("_ord", "_d1", "_spans", "_copy")]
            own[text_at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(words), pa.array(removed)],
                names=[f"c{i}" for i in range(len(own) + 2)])
    return run


def _slim(docs: DataFrame):
    """(order, text hashes and text of each row, the expressions of the keys)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = {"ord": F.coalesce(F.col("doc_id"), F.lit(_LAST)).cast("long"),
             "d1": F.xxhash64(text), "d2": F.xxhash64(F.lit(1), text)}
    return docs.select(text.alias("text"), *(c.alias(n) for n, c in keyed.items())), keyed


def _greedy(pieces: DataFrame, window: int) -> DataFrame:
    """Factors of each document: from left to right, a factor takes in the
    next piece if it starts where the factor ends, here and in the reference.
    Rows that repeat a document repeat its pieces: one of each counts."""
    w = Window.partitionBy("ord", "d1").orderBy("start")
    pieces = (pieces.withColumn("_before", F.lag("start").over(w))
              .where(~F.col("_before").eqNullSafe(F.col("start"))).drop("_before"))
    runs_on = (F.lag(F.col("start") + F.col("size")).over(w).eqNullSafe(F.col("start"))
               & F.lag("r_d1").over(w).eqNullSafe(F.col("r_d1"))
               & F.lag(F.col("r_start") + F.col("size")).over(w).eqNullSafe(F.col("r_start")))
    begin = F.last(F.when(~F.col("_on"), F.col("start")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (pieces.withColumn("_on", runs_on).withColumn("_begin", begin)
            .groupBy("ord", "d1", F.col("_begin").alias("start"))
            .agg((F.sum("size") + F.lit(window - 1)).cast("int").alias("n_words"),
                 F.first("r_d1").alias("ref"), F.min("r_start").alias("ref_start")))


def _parse(slim: DataFrame, window: int, anchor: int):
    """(factors of one document of each text, anchors of all, first of each text)."""
    anchors = staged(slim.mapInArrow(_anchor_lists(window, anchor), _ANCHORS), "substring-anchors")
    found = (anchors.select("d1", F.explode("anchors").alias("g"))
             .groupBy("g").agg(F.min("d1").alias("a"), F.max("d1").alias("b"))
             .where("a <> b").select("g"))
    kept = staged(found.union(anchors.select(F.explode("recurring").alias("g"))).distinct(),
                  "substring-kept")

    # one document stands for the copies of a text: the first of them
    first = staged(anchors.groupBy("d1", "d2").agg(F.min("ord").alias("ord"), F.max("n_words").alias("n")),
                   "substring-first")
    lists = staged(anchors.select("ord", "d1", F.explode("anchors").alias("g")).join(kept, "g", "left_semi")
                   .groupBy("ord", "d1").agg(F.collect_set("g").alias("kept"))
                   .join(first.select("ord", "d1").distinct(), ["ord", "d1"], "left_semi"),
                   "substring-lists")

    blocks = staged(slim.select("ord", "d1", "text").join(lists, ["ord", "d1"])
                    .mapInArrow(_cut_blocks(window, anchor), _BLOCKS), "substring-blocks")
    place = F.struct("ord", "d1", "start")
    classes = staged(blocks.groupBy("g", "same", "size")
                     .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")),
                     "substring-classes")
    mixed = classes.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g")

    copied = staged(blocks.drop("windows").join(classes.where("n > 1"), ["g", "same", "size"])
                    .where(place != F.col("first"))
                    .select("ord", "d1", "start", "size", F.col("first.d1").alias("r_d1"),
                            F.col("first.start").alias("r_start")),
                    "substring-copied")
    # boundaries: only the first block of each class can hold a first window
    heads = (classes.join(mixed, "g", "left_semi").select("first.*", "g", "size")
             .join(blocks.select("ord", "d1", "start", "g", "windows"), ["ord", "d1", "start", "g"]))
    single = staged(heads.select("g", "ord", "d1", "start", F.posexplode("windows").alias("i", "w"))
                    .select("g", "w", "ord", "d1", (F.col("start") + F.col("i")).alias("start")),
                    "substring-windows")
    firsts = (single.groupBy("g", "w").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("g", "w", "first"))
    edges = (single.join(firsts, ["g", "w"]).where(place != F.col("first"))
             .select("ord", "d1", "start", F.lit(1).alias("size"), F.col("first.d1").alias("r_d1"),
                     F.col("first.start").alias("r_start")))
    return _greedy(copied.union(edges), window), anchors, first



def factors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The factors of ``window`` words or more of every distinct text, parsed
    in the first document that has it: ``doc_id`` (2**63 - 1 where it is null),
    ``text_hash``, ``start`` and ``n_words`` (in words), and where the same
    words stand earlier: ``ref`` (hash of that text; the own one for a repeat
    within a text) and ``ref_start``.  Factors of a document may overlap by up
    to ``window`` - 1 words.  Empty and null texts and empty tables have none.
    """
    return _parse(_slim(docs)[0], window, anchor)[0].withColumnsRenamed({"ord": "doc_id", "d1": "text_hash"})


def dedup_substrings(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept words, joined by one space,
    and two more columns: ``n_words`` (of the input text) and ``n_removed``.
    They replace columns of those names.

    Words are matches of ``[^\\x20\\x09-\\x0D]+``, unchanged.  A window is
    ``window`` consecutive words of one document; a word goes if a window
    covers it whose words also start earlier: in a document of smaller
    ``doc_id``, or in the same document before it.  Windows are judged on the
    input.  Every other column, whatever its name, is passed on.

    Null and empty texts have no words and give an empty text.  A null
    ``doc_id`` comes after all others.  Documents that share a ``doc_id`` but
    not the text are ordered by the text's hash; rows that repeat a
    ``doc_id`` and its text are one document, and each gets its result.  An
    empty table gives an empty table.
    """
    if not 1 <= anchor < window:
        raise ValueError("anchor must be shorter than the window")
    docs = docs.drop("n_words", "n_removed")
    slim, keyed = _slim(docs)
    found, anchors, first = _parse(slim, window, anchor)
    begin = F.shiftleft(F.col("start").cast("long"), 32)
    spans = (found.withColumn("span", begin.bitwiseOR((F.col("start") + F.col("n_words")).cast("long")))
             .groupBy("ord", "d1").agg(F.collect_list("span").alias("_spans")))
    # every later copy of a text is a copy as a whole
    later = (anchors.join(first.withColumnRenamed("ord", "_first"), ["d1", "d2"])
             .where(F.col("ord") > F.col("_first")).where(F.col("n_words") >= window)
             .select("ord", "d1").distinct())
    cuts = staged(spans.select("ord", "d1", "_spans", F.lit(False).alias("_copy"))
                  .union(later.select("ord", "d1", F.expr("cast(null as array<bigint>)"), F.lit(True))),
                  "substring-cuts")

    names = docs.columns
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    joined = (docs.select(*own, keyed["ord"].alias("_ord"), keyed["d1"].alias("_d1"))
              .join(cuts.withColumnsRenamed({"ord": "_ord", "d1": "_d1"}), ["_ord", "_d1"], "left")
              .select(*(f"c{i}" for i in range(len(names))), "_ord", "_d1", "_spans", "_copy"))
    fields = [T.StructField(f"c{i}", docs.schema[i].dataType) for i in range(len(names))]
    fields += [T.StructField(f"c{len(names)}", T.LongType()), T.StructField(f"c{len(names) + 1}", T.LongType())]
    out = joined.mapInArrow(_cut_spans(names.index("text")), T.StructType(fields))
    return out.toDF(*names, "n_words", "n_removed")
