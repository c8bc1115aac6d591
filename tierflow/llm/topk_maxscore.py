"""Exact top-k search by MaxScore over sharded posting lists.

A vector's terms are its signed dimensions: dimension d has one posting list
of the vectors that are positive there, and one of those that are negative.  A
query term is the list on the query's own side; its bound is the query's
weight times the list's largest impact.  With the terms sorted by bound, the
weakest ones whose bounds together stay below the k-th best score so far are
non-essential: a vector that is in none of the other lists cannot be among the
best.  The essential lists are traversed; of the vectors found there, those
that can still compete are probed for the other terms, from the strongest
down.  What is left after that is scored in full, and only then do the
dimensions of opposite sign, which can only lower a score, come in.

The table is cut into shards of bounded size, and the queries into blocks.
Each task indexes one shard and runs one block of queries over it; the best of
all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a shard, and queries in a block.
SHARD = 16_384
BLOCK = 4_096
LONG_MAX = (1 << 63) - 1
#: Scores travel as three digits that sort like the exact integer: what is
#: above 80 bits, and twice 40 bits.
DIGITS = ("s80", "s40", "s0")


class Shard:
    """Vectors (n x dims) with ids, and their posting lists.  Rows and queries
    are int64 or, where sums could leave 64 bits, objects (Python's integers)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.lists: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for d in range(rows.shape[1]):
            x = self.rows[:, d]
            for sign in (1, -1):
                where = np.flatnonzero(x * sign > 0)
                if len(where):
                    self.lists[d, sign] = where, np.abs(x[where])
        self.bound = {t: int(impact.max()) for t, (_, impact) in self.lists.items()}
        # the vectors of largest impact of each list: where good scores are likely
        self.champions = {t: where[np.argsort(-impact, kind="stable")[:32]]
                          for t, (where, impact) in self.lists.items()}

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best vectors but those with the query's id,
        the best first, ties to smaller ids."""
        terms = [(int(abs(w)) * self.bound[t], int(abs(w)), t) for d, w in enumerate(query) if w
                 for t in ((d, 1 if w > 0 else -1),) if t in self.bound]
        terms.sort(key=lambda t: (t[0], t[2]))
        mine = slice(*np.searchsorted(self.ids, [own, own + 1]))
        if len(self.ids) - (mine.stop - mine.start) <= k:
            return self._best(np.arange(len(self.ids)), mine, query, k)
        floor = None
        if terms:
            seeds = np.unique(np.concatenate([self.champions[t] for _, _, t in terms[-8:]]))
            scores, _ = self._best(seeds, mine, query, k)
            floor = int(scores[-1]) if len(scores) == k else None
        if floor is None or floor <= 0:
            # vectors in no list score 0 or less: all take part
            return self._best(np.arange(len(self.ids)), mine, query, k)
        total = np.cumsum(np.array([t[0] for t in terms], self.rows.dtype))
        first = int(np.searchsorted(total, floor))  # terms before it are non-essential
        found = np.zeros(len(self.ids), self.rows.dtype)
        for _, w, t in terms[first:]:
            where, impact = self.lists[t]
            found[where] += w * impact
        left = int(total[first - 1]) if first else 0
        live = np.flatnonzero((found > 0) & (found + left >= floor))
        sums = found[live]
        for i in range(first - 1, -1, -1):  # probe the others while competitive
            if len(live) <= 64:
                break
            bound, w, (d, sign) = terms[i]
            sums = sums + w * np.maximum(self.rows[live, d] * sign, 0)
            left -= bound
            keep = sums + left >= floor
            live, sums = live[keep], sums[keep]
        return self._best(live, mine, query, k)

    def _best(self, at: np.ndarray, mine: slice, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = at[(at < mine.start) | (at >= mine.stop)]
        scores = self.rows[at] @ query
        order = np.argsort(-scores, kind="stable")[:k]  # positions ascend, and ids with them
        return scores[order], self.ids[at[order]]


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows; shorter lists are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    values, length = column.values.to_numpy(), np.diff(offsets)
    out = np.zeros((len(column), dims), np.int64)
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = values[offsets[0]:offsets[-1]]
    return out


def _largest(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


def _digits(scores: np.ndarray) -> list[np.ndarray]:
    low = (1 << 40) - 1
    top = scores >> (63 if scores.dtype == np.int64 else 80)
    return [x.astype(np.int64) for x in (top, (scores >> 40) & low, scores & low)]


def _searcher(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        if queries.num_rows and rows.num_rows:
            dims = max(1, *(int(np.diff(c.combine_chunks().offsets.to_numpy()).max())
                            for c in (queries["x"], rows["x"])))
            x, qs = _matrix(rows["x"], dims), _matrix(queries["x"], dims)
            # bounds add up twice a score at most
            wide = 2 * dims * _largest(x) * _largest(qs) > LONG_MAX
            kind = object if wide else np.int64
            shard = Shard(rows["vec_id"].to_numpy(), x.astype(kind))
            for own, q in zip(queries["query_id"].to_pylist(), qs.astype(kind)):
                scores, ids = shard.search(own, q, k)
                near = np.clip(scores, -LONG_MAX - 1, LONG_MAX) if wide else scores
                for column, part in zip(out, (np.full(len(ids), own), ids, near, *_digits(scores))):
                    column.append(part)
        flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
        return pa.table({n: pa.array(x.astype(np.int64)) for n, x in zip(("query_id", "vec_id", "score", *DIGITS), flat)})
    return run


def quantized(table: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, x): components as floor(scale * component), component as
    double.  Vectors that are null or hold null or non-finite components are
    left out, and so are rows without vec_id.  A component beyond 64 bits
    becomes the nearest of them."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    ok = ~F.coalesce(F.exists("embedding", lambda c: c.isNull() | F.isnan(c.cast("double"))
                              | (F.abs(c.cast("double")) == float("inf"))), F.lit(True))
    least = F.transform("x", lambda c: F.greatest(c, F.lit(-LONG_MAX)))
    return (table.where(ok & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).withColumn("x", least))


def top_k(queries: DataFrame, rows: DataFrame, k: int, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k rows of highest
    inner product, all if there are fewer, ties to the smaller vec_id.

    Both tables hold (vec_id, x) with integer arrays; shorter arrays count as
    filled with zeros.  Candidates are all rows but those with the query's own
    vec_id.  Rows that repeat another are candidates of their own, and equal
    queries count once.  Empty tables give an empty result.  Other columns are
    ignored.  Ranks follow the exact scores, however large the components; a
    score that a long can't hold is given as the nearest that it can.
    """
    n, m = rows.count(), queries.count()
    if not n or not m:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards, blocks = -(-n // shard), -(-m // block)
    # every task gets one shard and one block, both of bounded size; rows that
    # repeat are spread, as the row's place is part of the hash
    place = F.xxhash64("vec_id", F.monotonically_increasing_id())
    r = rows.select("vec_id", "x", F.pmod(place, F.lit(shards)).cast("int").alias("shard")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    q = (queries.select("vec_id", "x").distinct().select(F.col("vec_id").alias("query_id"), "x",
                                                         F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(blocks))
                                                         .cast("int").alias("block"))
         .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    local = (q.groupBy("shard", "block").cogroup(r.groupBy("shard", "block"))
             .applyInArrow(_searcher(k), ", ".join(f"{c} long" for c in ("query_id", "vec_id", "score", *DIGITS))))
    best = Window.partitionBy("query_id").orderBy(*[F.desc(d) for d in DIGITS], "vec_id")
    return (local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

