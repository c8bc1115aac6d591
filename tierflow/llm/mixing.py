"""Mixing sources to target weights by Pareto order sampling.

A source gets a target number of words.  Every document's expected number of
copies follows from it; the whole part is certain, and the fraction is the
probability of one more copy.  Documents are ranked by Pareto's order key,

    (u / (1 - u)) / (p / (1 - p)),

with u a random number hashed from the document and p its fraction, and those
of smallest key get the extra copy, as many as come nearest to the target.
The sample so has (nearly) fixed size and the wanted unequal inclusion
probabilities, and needs no second draw.

A source is never sorted in one task.  Keys are cut into bins; sums per bin
say in which bin the cut falls, and only that bin is ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.stages import staged
from tierflow.operators.changes import dense_index

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
#: Documents in a bin of the order key.
BIN = 1000

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn.  Together
    they share ``share`` of all words by weight; a target stops at ``cap``
    times its source's size, and the excess is shared again by weight until
    none is above.
    """
    n = len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("rank") - 1) % n + 1).cast("int"))
    listed = sizes.select("source", "source_size", F.col("source").isNull().alias("unnamed"))
    ranked = staged(dense_index(listed, ["unnamed", "source"], "rank")
                    .select("source", "source_size", weight.alias("weight")), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # the common factor: sources that reach their cap leave the rest to others
    factor = None
    while True:
        full = F.lit(False) if factor is None else F.col("weight") * F.lit(factor) >= cap * F.col("source_size")
        spent, free = ranked.agg(F.sum(F.when(full, F.col("source_size")).otherwise(0)),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = max(share * total - cap * (spent or 0), 0.0) / free if free else 0.0
        if factor is not None and new <= factor:
            break
        factor = new
    return ranked.select("source", "source_size",
                         F.least(F.col("weight") * factor, cap * F.col("source_size")).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
                doc_weight: str | None = None, seed: int = 0) -> DataFrame:
    """``docs`` with four more columns: ``size`` (words of the text),
    ``source_size``, ``target`` (both of its source, in words) and ``copies``
    (how often the mix takes the document, 0 to ``cap``).  They replace
    columns of those names; all others are passed on.

    Within a source, documents are expected ``target / source_size`` times
    each; or, with ``doc_weight``, in proportion to that column (null and
    negative count as 0), where no document exceeds ``cap`` and others make up
    for it as far as they can.

    A null text has 0 words.  Null sources are one source, the last.  A
    source without words has target 0.  Which documents get an extra copy
    depends on doc_id, text, source and ``seed`` alone, so reruns agree; rows
    that repeat all of these get equal copies.  An empty table gives an empty
    table.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    names = docs.columns
    cols = {"_size": word_count(F.col("text")),
            "_hash": F.xxhash64(F.lit(seed), "doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)), "source"),
            "_w": (F.lit(1.0) if doc_weight is None
                   else F.greatest(F.coalesce(F.col(f"`{doc_weight}`").cast("double"), F.lit(0.0)), F.lit(0.0)))}
    keyed = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)),
                        F.col("source").alias("_source"), *(c.alias(k) for k, c in cols.items()))
    slim = staged(keyed.select(F.col("_source").alias("source"), "_size", "_hash", "_w"), "mix-documents")
    stats = slim.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = staged(source_targets(stats.select("source", "source_size"), weights, share, cap), "mix-targets")
    rates = _rates(slim, targets, cap, uniform=doc_weight is None)
    plan = (stats.drop("source_size").withColumnRenamed("source", "s")
            .join(rates, F.col("s").eqNullSafe(F.col("source"))).drop("s"))
    plan = staged(plan.select("source", "source_size", "target", "rate",
                              F.ceil(F.col("n") / BIN).alias("bins")), "mix-plan")
    cut = _cuts(slim, plan, cap)

    known = plan.join(cut.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(F.col("source")), "left").drop("s")
    known = staged(known.withColumnRenamed("source", "_s"), "mix-cuts")
    out = keyed.join(known, F.col("_source").eqNullSafe(F.col("_s")))
    expected = F.least(F.col("_w") * F.col("rate"), F.lit(cap))
    extra = F.struct(_key(expected), F.col("_hash")) <= F.struct(F.col("cut_key"), F.col("cut_hash"))
    copies = F.floor(expected) + F.when((expected > F.floor(expected)) & extra, 1).otherwise(0)
    return out.select(*(f"c{i}" for i in range(len(names))), "_size", "source_size", "target",
                      copies.cast("int").alias("copies")).toDF(*names, "size", "source_size", "target", "copies")


def _rates(slim: DataFrame, targets: DataFrame, cap: float, uniform: bool) -> DataFrame:
    """(source, source_size, target, rate): documents of weight w are expected
    min(w * rate, cap) times, such that their words add up to the target."""
    if uniform:
        return targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                  .otherwise(0.0))
    rates = targets.withColumn("rate", F.lit(0.0))
    while True:
        full = F.col("_w") * F.col("rate") >= cap
        sums = (slim.join(rates.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(F.col("source")))
                .groupBy("source").agg(
                    F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                    F.first("rate").alias("rate"), F.sum(F.when(full, F.col("_size")).otherwise(0)).alias("full"),
                    F.sum(F.when(full, 0.0).otherwise(F.col("_w") * F.col("_size"))).alias("free")))
        new = F.when(F.col("free") > 0, F.greatest(F.col("target") - cap * F.col("full"), F.lit(0.0)) / F.col("free"))
        sums = staged(sums.withColumn("new", F.greatest(F.coalesce(new, F.col("rate")), F.col("rate"))), "mix-rates")
        done = sums.where(F.col("new") > F.col("rate") * (1 + 1e-12)).isEmpty()
        rates = sums.select("source", "source_size", "target", F.col("new").alias("rate"))
        if done:
            return rates


def _key(expected: Column) -> Column:
    """Pareto's order key k of a document, as k / (1 + k)."""
    p = expected - F.floor(expected)
    u = (F.shiftrightunsigned(F.col("_hash"), 11).cast("double") + 0.5) * 2.0 ** -53
    return (u * (1 - p)) / (u * (1 - p) + p * (1 - u))


def _cuts(slim: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """(source, cut_key, cut_hash): the last document that gets an extra copy."""
    rows = slim.join(plan.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(F.col("source"))).drop("s")
    expected = F.least(F.col("_w") * F.col("rate"), F.lit(cap))
    rows = (rows.withColumn("whole", F.floor(expected) * F.col("_size")).withColumn("key", _key(expected))
            .withColumn("drawn", expected > F.floor(expected))
            .withColumn("bin", F.floor(F.col("key") * F.col("bins"))))
    sums = staged(rows.groupBy("source", "bin").agg(
        F.sum("whole").alias("whole"), F.first("target").alias("target"),
        F.sum(F.when(F.col("drawn"), F.col("_size")).otherwise(0)).alias("words")), "mix-bins")
    wanted = sums.groupBy("source").agg((F.first("target") - F.sum("whole")).alias("wanted"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (sums.select("source", "bin", "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
            .join(wanted.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(F.col("source"))).drop("s"))
    # the last bin that starts below the wanted words holds the cut
    at = (bins.where("before < wanted and words > 0").groupBy("source")
          .agg(F.max(F.struct("bin", "before", "wanted")).alias("x")).select(F.col("source").alias("s"), "x.*"))
    inside = (rows.where("drawn").select("source", "bin", "key", "_hash", "_size")
              .join(at.withColumnRenamed("bin", "b"),
                    F.col("s").eqNullSafe(F.col("source")) & (F.col("b") == F.col("bin"))).drop("s", "b"))
    ranked = Window.partitionBy("source").orderBy("key", "_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = inside.withColumn("middle", F.col("before") + F.sum("_size").over(ranked) - F.col("_size") / 2)
    last = taken.where("middle <= wanted").groupBy("source").agg(F.max(F.struct("key", "_hash")).alias("x"))
    # none of the bin: the cut is before it
    none = at.select(F.col("s").alias("source"), "bin").join(
        plan.select(F.col("source").alias("p"), "bins"), F.col("p").eqNullSafe(F.col("source"))).select(
        "source", (F.col("bin") / F.col("bins")).alias("low"))
    return (none.join(last.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(F.col("source")), "left")
            .select("source", F.coalesce("x.key", "low").alias("cut_key"),
                    F.coalesce("x._hash", F.lit(-(1 << 63))).alias("cut_hash")))
