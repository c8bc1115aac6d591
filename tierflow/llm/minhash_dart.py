"""Near-duplicate documents by DartMinHash signatures and banding.

A document is the weighted set of its runs of ``shingle`` consecutive words,
weighted by how often each occurs.  Darts are thrown at the plane of elements,
weights and ranks: each unit of weight of each element receives darts at ranks
that form a Poisson process, hashed from the element and the unit alone, and
each dart falls on a random coordinate.  A document keeps, per coordinate, the
earliest dart that hits its regions.  Two documents agree in a coordinate with
probability equal to their weighted Jaccard similarity.  As the ranks of a
unit's darts grow, only the first few darts matter: the work per document is
the number of its words plus about ``size * ln(size)`` darts, not their
product.

Signatures are cut into bands; documents that agree in a band are candidates.
Every link is verified on whole texts.  A band's bucket is never expanded into
rows of pairs: first all of its documents are compared with its hub, the one
with most companions over all bands.  That joins most groups (an original and
its copies).  What remains are buckets whose documents are not all in one
class yet; there, blocks of bounded size are compared as a whole by a matrix
product, which emits a spanning forest of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.components import components
from tierflow.llm.stages import staged
from tierflow.llm.words import grams, grouped, mix

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 5
#: Documents in a block of a bucket; two blocks meet in one task.
BLOCK = 512

_U = np.uint64
_LAST = (1 << 63) - 1


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle of the texts with word hashes ``h``.  A
    text of fewer than k words has one shingle, of all of its words; a text
    without words has none."""
    text = np.repeat(np.arange(len(counts)), counts)
    n = max(len(h) - k + 1, 0)
    ok = np.flatnonzero(text[:n] == text[k - 1:]) if n else np.empty(0, np.int64)
    where, what = text[ok], grams(h, k)[ok] if n else np.empty(0, _U)
    first = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < k))
    own = [mix(grams(h[first[i]:first[i] + counts[i]], int(counts[i])) + _U(int(counts[i]))) for i in short]
    if own:
        where, what = np.concatenate([where, short]), np.concatenate([what, *own])
    return where, what


def dart_minhash(where: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int,
                 size: int, seed: int = 0) -> np.ndarray:
    """Signatures (n x size, uint64) of n weighted sets given as rows (set,
    element, weight > 0), elements distinct within a set.  Sets without rows
    get zeros.

    Weights are cut into units; of the last, partial unit of an element only
    the darts below the weight count.
    """
    signature = np.zeros((n, size), _U)
    if not len(where):
        return signature
    units = np.ceil(weight).astype(np.int64)
    row = np.repeat(np.arange(len(where)), units)
    unit = np.arange(len(row)) - np.repeat(np.cumsum(units) - units, units)
    room = np.minimum(weight[row] - unit, 1.0)
    cell = mix(element[row] + mix(unit.astype(_U) + _U((seed << 32) + 1)))
    owner = where[row]
    total = np.bincount(where, weights=weight, minlength=n)
    # rank up to which a set expects enough darts to hit every coordinate
    limit = np.zeros(n)
    np.divide(size * (math.log(size) + 2), total, out=limit, where=total > 0)

    best, flat = np.full(n * size, np.inf), signature.reshape(-1)
    # sets of little weight need many darts from each unit: throw more at once
    for few, width in ((limit <= 4, 2), (limit > 4, 32)):
        live = np.flatnonzero(few[owner])
        rank, thrown = np.zeros(len(cell)), np.zeros(len(cell), _U)
        reach = limit.copy()
        while len(live):
            while len(live):
                turn = thrown[live][:, None] + np.arange(1, width + 1, dtype=_U)
                dart = mix(cell[live][:, None] + mix(turn))
                gap = (dart >> _U(11)).astype(np.float64) * 2.0 ** -53
                at_rank = rank[live][:, None] - np.cumsum(np.log1p(-gap), axis=1)
                near = at_rank <= reach[owner[live]][:, None]
                hits = near.sum(axis=1)
                some = np.flatnonzero(hits)
                thrown[live[some]] += hits[some].astype(_U)
                rank[live[some]] = at_rank[some, hits[some] - 1]
                i, _ = np.nonzero(near)
                dart, r, own = dart[near], at_rank[near], live[i]
                other = mix(dart + _U(0x9E3779B97F4A7C15))
                inside = (other >> _U(32)).astype(np.float64) * 2.0 ** -32 < room[own]
                r, dart = r[inside], dart[inside]
                at = owner[own[inside]] * size + (other[inside] % _U(size)).astype(np.int64)
                np.minimum.at(best, at, r)
                first = r == best[at]
                flat[at[first]] = dart[first]
                live = live[hits == width]
            # a coordinate that no dart has hit needs darts of higher rank
            missing = np.isinf(best.reshape(n, size)).any(axis=1) & few & (total > 0)
            reach[missing] *= 2
            live = np.flatnonzero(missing[owner])
    return signature


def _signatures(shingle: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, bands + 1, dtype=_U))
        for b in batches:
            texts = b["text"].cast(pa.binary()).to_pylist()
            for lo, h, counts in grouped(texts):
                n = len(counts)
                where, element, weight = weighted(h, counts, shingle)
                signature = dart_minhash(where, element, weight, n, bands * rows, seed)
                keys = np.tile(salt, (n, 1))
                for r in range(rows):
                    keys = mix(keys + signature[:, r::rows])
                some = np.flatnonzero(counts > 0)
                flat = pa.array(keys[some].reshape(-1).view(np.int64))
                offsets = pa.array((np.arange(len(some) + 1) * bands).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b["id"].slice(lo, n).take(pa.array(some, pa.int64())), pa.ListArray.from_arrays(offsets, flat)],
                    names=["id", "keys"])
    return run


def weighted(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, occurrences), by text and shingle."""
    where, what = shingles(h, counts, k)
    if not len(where):
        return where, what, np.empty(0)
    order = np.lexsort((what, where))
    where, what = where[order], what[order]
    new = np.ones(len(where), bool)
    new[1:] = (where[1:] != where[:-1]) | (what[1:] != what[:-1])
    at = np.flatnonzero(new)
    return where[at], what[at], np.diff(np.append(at, len(where))).astype(np.float64)


def _bags(texts: list[bytes], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for _, h, counts in grouped(texts):
        where, what, n = weighted(h, counts, k)
        cut = np.searchsorted(where, np.arange(len(counts) + 1))
        out += [(what[i:j], n[i:j]) for i, j in zip(cut[:-1], cut[1:])]
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags of shingles (0 if either is
    empty)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / max(a[1].sum() + b[1].sum() - both, 1e-300))


def _verify(shingle: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = _bags(b["text"].cast(pa.binary()).to_pylist(), shingle)
            # rows come sorted by leader, so neighbours share its text
            texts, right, last = b["lead_text"].cast(pa.binary()).to_pylist(), [], (None, None)
            for t in texts:
                if t != last[0]:
                    last = (t, _bags([t], shingle)[0])
                right.append(last[1])
            ok = [similarity(x, y) >= threshold for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays([b["id"], b["lead"], pa.array(ok, pa.bool_())],
                                             names=["id", "lead", "ok"])
    return run


def _linked(shingle: int, threshold: float):
    """Compare all documents of a block, or of two, and emit links that join
    those which similar pairs connect."""
    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].combine_chunks()
        bags = _bags(table["text"].cast(pa.binary()).to_pylist(), shingle)
        a, b = spanning_links(bags, threshold)
        return pa.table({"id": ids.take(pa.array(a, pa.int64())), "lead": ids.take(pa.array(b, pa.int64()))})
    return run


def spanning_links(bags: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> tuple[list[int], list[int]]:
    """Links (i, j) of bags of similarity ``threshold`` or more that connect
    all bags which such links connect, without cycles."""
    n = len(bags)
    owner = np.repeat(np.arange(n), [int(w.sum()) for _, w in bags])
    # the k-th occurrence of a shingle is an element of its own
    unit = np.concatenate([mix(np.repeat(e, w.astype(np.int64))
                               + mix(_nth(w.astype(np.int64)).astype(_U))) for e, w in bags])
    total = np.bincount(owner, minlength=n).astype(np.float32)
    _, column, uses = np.unique(unit, return_inverse=True, return_counts=True)
    often = uses[column] > 1
    rank = np.cumsum(uses > 1) - 1
    owner, column = owner[often], rank[column[often]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), np.float32)
    width = max(1, (1 << 22) // n)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        x = np.zeros((n, width), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        both += x @ x.T
    i, j = np.nonzero(np.triu(both >= threshold * (total[:, None] + total[None, :] - both) - 1e-3, 1))
    root, links = list(range(n)), ([], [])
    for x, y in zip(i.tolist(), j.tolist()):
        a, b = x, y
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        while root[b] != b:
            root[b] = root[root[b]]
            b = root[b]
        if a != b and both[x, y] / (float(total[x]) + float(total[y]) - float(both[x, y])) >= threshold:
            root[max(a, b)] = min(a, b)
            links[0].append(x)
            links[1].append(y)
    return links


def _nth(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c of ``counts``."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE,
                    bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """``docs`` with two more columns: ``class_id``, the smallest ``doc_id``
    of the document's near-duplicates (its own if it has none), and
    ``is_first``, true for the one document that stands for its class.  They
    replace columns of those names.

    Documents are linked if the weighted Jaccard similarity of their word
    shingles is ``threshold`` or more; classes are connected components.
    With the given bands and rows, a pair of similarity s meets in no band
    with probability ``(1 - s**rows)**bands``: 0.0004 at 0.8, 1e-7 at 0.9.

    Equal texts are always linked; null counts as an empty text.  Texts
    without words are linked to equal texts only, those of fewer words than a
    shingle to texts of the same words.  A null ``doc_id`` comes last, and is
    the class of documents that have no other.  Rows that repeat a ``doc_id``
    and its text are one document, and all have its result.  An empty table
    gives an empty table.  Other columns are passed on.
    """
    return _labelled(docs.drop("class_id", "is_first"),
                     _classes(docs, threshold, shingle, bands, rows, block, seed))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are first in their class, with its columns;
    of rows that repeat a ``doc_id`` and its text, one."""
    classes = _classes(docs, **({"threshold": THRESHOLD, "shingle": SHINGLE, "bands": BANDS,
                                 "rows": ROWS, "block": BLOCK, "seed": 0} | options))
    first = _labelled(docs.drop("class_id", "is_first"), classes).where("is_first").drop("class_id", "is_first")
    if not classes.where("leads and rows > 1").isEmpty():
        first = first.dropDuplicates(["doc_id", "text"])
    return first


def _labelled(docs: DataFrame, classes: DataFrame) -> DataFrame:
    names = docs.columns
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    kept = [f"c{i}" for i in range(len(names))]
    joined = docs.select(*own, *_keys()).join(classes.withColumnRenamed("ord", "lead_ord"), ["d1", "d2"])
    # the largest order stands for a null doc_id
    return joined.select(
        *kept, F.when(F.col("root") != _LAST, F.col("root")).alias("class_id"),
        (F.col("leads") & (F.col("ord") == F.col("lead_ord"))).alias("is_first")).toDF(*names, "class_id", "is_first")


def _keys() -> list:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2"),
            F.coalesce(F.col("doc_id"), F.lit(_LAST)).cast("long").alias("ord")]


def _classes(docs: DataFrame, threshold: float, shingle: int, bands: int, rows: int,
             block: int, seed: int) -> DataFrame:
    """The class of each distinct text: d1, d2 (its hashes), ord (its smallest
    doc_id), rows (that have both), root (the class), leads."""
    text = F.coalesce(F.col("text"), F.lit(""))

    # copies of a text: one row stands for all of them
    copies = staged(docs.select(*_keys()).groupBy("d1", "d2", "ord").agg(F.count(F.lit(1)).alias("rows"))
                    .groupBy("d1", "d2").agg(F.min(F.struct("ord", "rows")).alias("x")).select("d1", "d2", "x.*"),
                    "dart-copies")
    ident = F.struct("ord", "d1", "d2")
    # whole texts of one row per distinct text; repeats of its doc_id vanish
    slim = docs.select(text.alias("text"), *_keys())
    sigs = staged(slim.select(ident.alias("id"), "text")
                  .mapInArrow(_signatures(shingle, bands, rows, seed),
                              "id struct<ord:bigint,d1:bigint,d2:bigint>, keys array<bigint>")
                  .select("id.*", "keys"), "dart-signatures")
    entries = (sigs.join(copies, ["d1", "d2", "ord"], "left_semi").dropDuplicates(["d1", "d2", "ord"])
               .select(ident.alias("id"), F.posexplode("keys").alias("band", "key")))
    shared = staged(entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "dart-shared")
    members = staged(entries.join(shared, ["band", "key"], "left_semi"), "dart-members")
    involved = members.select("id.*").distinct()
    texts = staged(slim.join(involved, ["ord", "d1", "d2"], "left_semi").dropDuplicates(["ord", "d1", "d2"])
                   .select(ident.alias("id"), "text"), "dart-texts")

    degree = members.join(shared, ["band", "key"]).groupBy("id").agg(F.sum("n").alias("degree"))
    hubs = (members.join(degree, "id").groupBy("band", "key")
            .agg(F.min(F.struct((-F.col("degree")).alias("order"), "id")).alias("hub"))
            .select("band", "key", F.col("hub.id").alias("lead")))
    pairs = members.join(hubs, ["band", "key"]).where(F.col("id") != F.col("lead")).select("id", "lead").distinct()
    hub_links = _verified(pairs, texts, shingle, threshold)

    rooted = members.join(components(hub_links), F.col("id") == F.col("node"), "left").select(
        "band", "key", "id", F.coalesce("root", "id").alias("root"))
    # a set of documents often fills several buckets: one of them is enough
    split = (rooted.groupBy("band", "key")
             .agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("ids"))
             .where("a <> b").groupBy("n", "ids").agg(F.min(F.struct("band", "key")).alias("x"))
             .select("x.*", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    rest = (members.join(split, ["band", "key"])
            .withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("id", "band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
            .join(texts, "id"))
    kind = "struct<ord:bigint,d1:bigint,d2:bigint>"
    block_links = staged(rest.groupBy("band", "key", "i", "j")
                         .applyInArrow(_linked(shingle, threshold), f"id {kind}, lead {kind}"), "dart-block-links")
    roots = (components(hub_links.union(block_links.withColumnsRenamed({"id": "a", "lead": "b"})))
             .select("node.*", "root"))
    copies = copies.join(roots, ["ord", "d1", "d2"], "left")
    return staged(copies.select("d1", "d2", "rows", "ord", F.coalesce("root.ord", "ord").alias("root"),
                                (F.coalesce("root", ident) == ident).alias("leads")), "dart-classes")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The pairs (id, lead) that are similar, as links (a, b)."""
    both = (pairs.join(texts, "id")
            .join(texts.withColumnsRenamed({"id": "lead", "text": "lead_text"}), "lead")
            .select("id", "lead", "text", "lead_text").sortWithinPartitions("lead"))
    kind = "struct<ord:bigint,d1:bigint,d2:bigint>"
    found = both.mapInArrow(_verify(shingle, threshold), f"id {kind}, lead {kind}, ok boolean")
    return staged(found.where("ok").select(F.col("id").alias("a"), F.col("lead").alias("b")), "dart-hub-links")
