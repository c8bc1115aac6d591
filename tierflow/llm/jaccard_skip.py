"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its word shingles.  A document q can only be linked
with one that stands on at least T of the inverted lists of q's shingles, T
being the threshold's share of q's size.  A search in an index of sets

* divides q's lists into short and long ones, fewer than T of them long;
* merges the short lists and counts, for each document, the lists it is on;
* skips those that can't reach T even if all long lists had them, and probes
  the long lists for the rest by binary search;
* keeps the documents that reach the overlap which the two sizes ask for.

An index of all documents is too large for a task, so Spark deals documents
to parts first, without loss:

1. A census counts, for each document, its lists that hold another document.
   Hashes go to buckets as packed arrays, each once from a batch of documents,
   and only sums come back.  Who is on fewer than T shared lists has no link;
   in most corpora few documents remain, whatever passages they quote.
2. Among those, with short lists first, two linked documents share one of the
   first ``size - T + 1`` shingles of each (were all lists but those long, this
   is the search above).  Each such shingle names the smallest document that
   has it, and all documents that are dealt to a name are one index.
3. Parts of more shingles than ``PART`` are cut; their smallest document is in
   each cut, and what is not connected with it visits the other cuts, too.

Nothing is broadcast.  Results are exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.components import components
from tierflow.llm.minhash_dart import weighted
from tierflow.llm.stages import staged
from tierflow.llm.words import grouped, mix

SHINGLE = 3
PERCENT = 90
#: Shingles of a part that is searched as one index, about.
PART = 1 << 20
#: Shingles counted in one bucket, and in one batch of documents, about.
BUCKET, BATCH = 1 << 22, 1 << 20
#: Weight of a probe against a merged entry when lists are divided.
PROBE = 0.1

_U = np.uint64
_LAST = (1 << 63) - 1


def _sets(texts: list[bytes], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts: (index of the first, place of each text's shingles,
    distinct shingles of each text, ascending; numbers of words)."""
    for lo, h, counts in grouped([t.lower() for t in texts]):  # bytes: only A-Z change
        where, what, _ = weighted(h, counts, k)
        yield lo, np.searchsorted(where, np.arange(len(counts) + 1)), what, counts


def needed(size: int, percent: int) -> int:
    """Shingles that a set of a size shares with any that it is linked with."""
    return -(-percent * size // 100)


def search_links(sets: list[np.ndarray], percent: int = PERCENT, visitors: int = 0) -> list[tuple[int, int]]:
    """Links among ``sets`` that connect all those which links of at least
    ``percent`` Jaccard similarity connect.  The first one's links come first;
    sets already connected with it are not searched again.  The last
    ``visitors`` sets are searched for in the others only."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    tokens, number = np.unique(np.concatenate(sets), return_inverse=True)
    resident = owner < n - visitors
    # the index: (list, document) in one sorted array
    index = np.sort(number[resident].astype(np.int64) * n + owner[resident])
    starts = np.searchsorted(index, np.arange(len(tokens) + 1) * n)
    length = np.diff(starts)
    cuts = np.append(0, np.cumsum(sizes))
    root, links = list(range(n)), []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for q in (range(n - visitors, n) if visitors else range(n)):
        if q and not visitors and find(q) == find(0):
            continue
        size = int(sizes[q])
        least = needed(size, percent)
        lists = number[cuts[q]:cuts[q + 1]]
        lists = lists[length[lists] > (not visitors)]
        if not size or len(lists) < least:
            continue
        lists = lists[np.argsort(length[lists], kind="stable")]
        n_long = min(least - 1, int(least / (PROBE * math.log2(1 + int(length[lists[-1]])) + 1)))
        short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
        spans = length[short]
        at = np.arange(spans.sum()) + np.repeat(starts[short] - (np.cumsum(spans) - spans), spans)
        counts = np.bincount(index[at] % n, minlength=n)
        counts[q] = 0
        found = np.flatnonzero((counts >= max(least - n_long, 1)) & (100 * sizes >= percent * size)
                               & (percent * sizes <= 100 * size))
        if n_long and len(found):
            keys = (long.astype(np.int64)[:, None] * n + found[None, :])
            place = np.minimum(np.searchsorted(index, keys), len(index) - 1)
            counts[found] += (index[place] == keys).sum(axis=0)
        both = counts[found]
        for d in found[100 * both >= percent * (size + sizes[found] - both)].tolist():
            a, b = find(q), find(d)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((q, d))
    return links


def _census(k: int, percent: int, bits: int):
    """Packed shingles of batches of documents, by the first ``bits`` bits of
    their hash.  A row has the next 32 bits of the shingles that one document
    of the batch has, how many of them each document has, and the shingles
    that several have.  One more row a batch describes its documents: hashes
    of the text, size, and shared lists so far, less those that are needed."""
    def rows(part: int, d1: list, d2: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        size = np.array([len(x) for x in sets], np.int32)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), size)
        names, number, n = np.unique(np.concatenate(sets) >> _U(32 - bits), return_inverse=True, return_counts=True)
        several = n[number] > 1
        shared = np.bincount(owner[several], minlength=len(sets)) - [needed(int(x), percent) for x in size]
        own = np.flatnonzero(~several)
        bucket = (names[number[own]] >> _U(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")  # by bucket, then document
        own, bucket = own[order], bucket[order]
        low, owner = names[number[own]].astype(np.uint32), owner[own]
        again = names[n > 1]
        again_bucket, again = (again >> _U(32)).astype(np.int32), again.astype(np.uint32)
        out = {"bucket": [], "docs": [], "n": [], "lists": [], "again": []}
        for i in np.union1d(bucket, again_bucket).tolist():
            lo, hi = np.searchsorted(bucket, [i, i + 1])
            docs, counts = np.unique(owner[lo:hi], return_counts=True)
            found = again[slice(*np.searchsorted(again_bucket, [i, i + 1]))]
            for name, x in zip(out, (i, docs, counts.astype(np.int32), low[lo:hi], found)):
                out[name].append(x if name == "bucket" else x.tobytes())
        ends = [d1[0] % (1 << bits), np.array(d1, np.int64).tobytes(), np.array(d2, np.int64).tobytes(),
                size.tobytes(), shared.astype(np.int32).tobytes()]
        batch = int((mix(np.array(d1, np.int64).view(_U)) * mix(np.arange(1, len(d1) + 1))).sum().view(np.int64))
        kinds = (pa.int32(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays(
            [pa.array([batch] * (len(out["bucket"]) + 1), pa.int64()), pa.array([part] * (len(out["bucket"]) + 1), pa.int32()),
             pa.array([False] * len(out["bucket"]) + [True]),
             *(pa.array([*x, end], kind) for x, end, kind in zip(out.values(), ends, kinds))],
            names=["batch", "part", "about", "bucket", "docs", "n", "lists", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, d1, d2, sets, held, seen = TaskContext.get().partitionId(), [], [], [], 0, set()
        for b in batches:
            h1, h2 = b["d1"].to_pylist(), b["d2"].to_pylist()
            for lo, cut, what, _ in _sets(b["text"].cast(pa.binary()).to_pylist(), k):
                for i, (x, y) in enumerate(zip(cut[:-1], cut[1:]), lo):
                    if (h1[i], h2[i]) in seen:  # copies in a batch count once
                        continue
                    seen.add((h1[i], h2[i]))
                    d1.append(h1[i])
                    d2.append(h2[i])
                    sets.append(what[x:y])
                    held += y - x
                if held >= BATCH:
                    yield rows(part, d1, d2, sets)
                    d1, d2, sets, held, seen = [], [], [], 0, set()
        if sets:
            yield rows(part, d1, d2, sets)
    return run


_PACKED = "batch long, part int, about boolean, bucket int, docs binary, n binary, lists binary, again binary"
_SUMS = "batch long, part int, about boolean, docs binary, n binary, lists binary, again binary"


def _sum_bucket(table: pa.Table) -> pa.Table:
    """Of one bucket: how many lists that are shared with other batches each
    document of a batch is on.  Descriptions pass through."""
    about = table.filter(table["about"]).drop_columns("bucket")
    table = table.filter(pa.compute.invert(table["about"]))
    lists = [np.frombuffer(x, np.uint32) for x in table["lists"].to_pylist()]
    again = [np.frombuffer(x, np.uint32) for x in table["again"].to_pylist()]
    every = np.concatenate([*lists, *again]) if lists else np.empty(0, np.uint32)
    order = np.argsort(every, kind="stable")
    new = np.diff(every[order].astype(np.int64), prepend=-1) > 0
    shared = np.empty(len(every), bool)
    sizes = np.diff(np.append(np.flatnonzero(new), len(every)))
    shared[order] = np.repeat((sizes > 1), sizes)
    at, docs, counts = 0, [], []
    for x, d, n in zip(lists, table["docs"].to_pylist(), table["n"].to_pylist()):
        d, n = np.frombuffer(d, np.int32), np.frombuffer(n, np.int32)
        found = shared[at:at + len(x)]
        at += len(x)
        sums = np.add.reduceat(found, np.cumsum(n) - n, dtype=np.int32) if len(n) else n
        docs.append(d[sums > 0].tobytes())
        counts.append(sums[sums > 0].astype(np.int32).tobytes())
    none = pa.nulls(len(docs), pa.binary())
    sums = pa.table([table["batch"], table["part"], table["about"], pa.array(docs, pa.binary()),
                     pa.array(counts, pa.binary()), none, none], names=about.column_names)
    return pa.concat_tables([about, sums])


def _sum_batch(table: pa.Table) -> pa.Table:
    """(d1, d2, size, linkable) of the documents of a batch."""
    rows = table.to_pylist()
    about = next(r for r in rows if r["about"])
    d1, d2 = (np.frombuffer(about[c], np.int64) for c in ("docs", "n"))
    size, shared = np.frombuffer(about["lists"], np.int32), np.frombuffer(about["again"], np.int32).copy()
    for r in rows:
        if not r["about"]:
            shared[np.frombuffer(r["docs"], np.int32)] += np.frombuffer(r["n"], np.int32)
    return pa.table({"d1": d1, "d2": d2, "size": size, "linkable": pa.array((shared >= 0) & (size > 0))})


def _shingles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, cut, what, _ in _sets(b["text"].cast(pa.binary()).to_pylist(), k):
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(what.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b["d1"].slice(lo, len(lists)), lists], names=["d1", "lists"])
    return run


def _searched(k: int, percent: int, visiting: bool):
    """Links (a, b) of the documents of a part."""
    def run(table: pa.Table) -> pa.Table:
        # the part's name comes first; visitors come last
        order = np.lexsort((table["ord"].to_numpy(), table["visits"].to_numpy(zero_copy_only=False)))
        texts = table["text"].cast(pa.binary()).take(pa.array(order)).to_pylist()
        ids = table["ord"].to_numpy()[order]
        sets = [what[i:j] for _, cut, what, _ in _sets(texts, k) for i, j in zip(cut[:-1], cut[1:])]
        visitors = int(np.count_nonzero(table["visits"].to_numpy(zero_copy_only=False)))
        if visiting and not visitors or visitors == len(sets):
            links = []
        else:
            links = search_links(sets, percent, visitors)
        return pa.table({"a": pa.array([ids[i] for i, _ in links], pa.int64()),
                         "b": pa.array([ids[j] for _, j in links], pa.int64())})
    return run


def jaccard_components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE,
                       part: int = PART) -> DataFrame:
    """``docs`` with two more columns: ``n_shingles`` (distinct shingles of
    the document) and ``component_id`` (the smallest ``doc_id`` that links
    reach from it, itself included).  They replace columns of those names; all
    others are passed on.

    Words are matches of ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased.  Two
    documents are linked if 100 times their common shingles are at least
    ``percent`` times all of theirs.  A text of fewer words than a shingle is
    one shingle.  Null and empty texts, and those without words, have none and
    are linked with nothing, not even each other.

    Rows that share a ``doc_id`` are one document: what is linked with one of
    them is linked with all.  A null ``doc_id`` comes last, and is the
    component of documents that have no other.  An empty table gives an empty
    table.
    """
    docs = docs.drop("n_shingles", "component_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2"),
            F.coalesce(F.col("doc_id"), F.lit(_LAST)).cast("long").alias("ord")]
    slim = docs.select(text.alias("text"), *keys)
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(31, math.ceil(math.log2(max(1, total / 6 / BUCKET))))
    # every text, whatever its copies: its size, and whether it can have a link
    census = staged(slim.select("text", "d1", "d2").mapInArrow(_census(shingle, percent, bits), _PACKED)
                    .groupBy("bucket").applyInArrow(_sum_bucket, _SUMS).groupBy("batch", "part")
                    .applyInArrow(_sum_batch, "d1 long, d2 long, size int, linkable boolean")
                    .groupBy("d1", "d2").agg(F.max("size").alias("size"), F.max("linkable").alias("linkable")),
                    "skip-census")
    classes = staged(slim.select("d1", "d2", "ord").groupBy("d1", "d2").agg(F.min("ord").alias("ord"))
                     .join(census, ["d1", "d2"]), "skip-classes")
    texts = staged(slim.join(classes.where("linkable").select("d1", "d2", "ord"), ["d1", "d2", "ord"], "left_semi")
                   .dropDuplicates(["d1", "d2", "ord"]), "skip-texts", compression="zstd")

    # narrow rows: the hash stands for the document until its lists are chosen
    lists = texts.select("text", "d1").mapInArrow(_shingles(shingle), "d1 long, lists array<long>").select(
        "d1", F.explode("lists").alias("list"))
    shared = staged(lists.groupBy("list").agg(F.count(F.lit(1)).cast("int").alias("n")).where("n > 1"), "skip-shared")
    # of a document on n shared lists, the first n - T + 1, short ones first
    begin = (lists.join(shared, "list").groupBy("d1")
             .agg(F.array_sort(F.collect_list(F.struct("n", "list"))).alias("lists"))
             .join(classes.where("linkable"), "d1")
             .withColumn("many", F.size("lists") - F.ceil(F.col("size") * percent / 100) + 1).where("many > 0")
             .select("d1", "d2", "ord", "size", F.expr("slice(lists, 1, cast(greatest(many, 0) as int))").alias("lists")))
    entries = staged(begin.select("d1", "d2", "ord", "size", F.explode("lists.list").alias("list")), "skip-entries")
    names = entries.groupBy("list").agg(F.min("ord").alias("name"), F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = staged(entries.join(names.drop("n"), "list").select("name", "d1", "d2", "ord", "size").distinct(),
                   "skip-dealt")
    cuts = dealt.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")).where("n > 1").select(
        "name", F.ceil(F.col("total") / part).cast("int").alias("cuts"))
    involved = staged(dealt.join(cuts, "name").select(
        "name", "d1", "d2", "ord", "cuts", F.pmod(F.xxhash64("d1", "d2"), F.col("cuts")).cast("int").alias("cut")),
        "skip-parts")
    texts = staged(slim.join(involved.select("d1", "d2", "ord").distinct(), ["d1", "d2", "ord"], "left_semi")
                   .dropDuplicates(["d1", "d2", "ord"]), "skip-texts", compression="zstd")

    ident = ["name", "cut", "d1", "d2", "ord"]
    at_home = involved.where("ord <> name").select(*ident).union(
        involved.where("ord = name").withColumn("cut", F.explode(F.expr("sequence(0, cuts - 1)"))).select(*ident))
    at_home = at_home.withColumn("visits", F.lit(False))

    def links(rows: DataFrame, visiting: bool, to: str) -> DataFrame:
        return staged(rows.join(texts, ["d1", "d2", "ord"]).select("name", "cut", "ord", "visits", "text")
                      .groupBy("name", "cut").applyInArrow(_searched(shingle, percent, visiting), "a long, b long"), to)

    found = links(at_home, False, "skip-links")
    many = involved.where("cuts > 1")
    if not many.isEmpty():
        roots = staged(components(found), "skip-roots")
        rooted = (many.join(roots, F.col("ord") == F.col("node"), "left").drop("node")
                  .withColumn("own", F.coalesce("root", "ord")).drop("root")
                  .join(roots.withColumnsRenamed({"node": "name", "root": "name_root"}), "name", "left"))
        apart = rooted.where(F.col("own") != F.coalesce("name_root", "name"))
        guests = (apart.withColumn("to", F.explode(F.expr("sequence(0, cuts - 1)"))).where("to <> cut")
                  .select("name", F.col("to").alias("cut"), "d1", "d2", "ord", F.lit(True).alias("visits")))
        hosts = at_home.join(guests.select("name", "cut").distinct(), ["name", "cut"], "left_semi")
        found = found.union(links(hosts.select(guests.columns).union(guests), True, "skip-visits"))
    roots = components(found)
    classes = classes.join(roots, F.col("ord") == F.col("node"), "left").select(
        "d1", "d2", F.col("size").cast("long").alias("size"), F.coalesce("root", "ord").alias("root"))

    columns = docs.columns
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    component = F.when(F.col("size") == 0, F.col("ord")).otherwise(F.col("root"))
    return docs.select(*own, *keys).join(classes, ["d1", "d2"]).select(
        *(f"c{i}" for i in range(len(columns))), "size",
        F.when(component != _LAST, component).alias("_component")).toDF(*columns, "n_shingles", "component_id")
