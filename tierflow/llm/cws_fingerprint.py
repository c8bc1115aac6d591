"""Document fingerprints by consistent weighted sampling, in Spark SQL alone.

A document is the weighted set of its words, weighted by their counts.  For
each of ``SAMPLES`` samples, every term draws r, c ~ Gamma(2, 1) and b ~
U(0, 1) from hashes of the term and the sample's number, and with its weight S

    t = floor(ln S / r + b),    ln a = ln c - r * (t - b + 1).

The sample is the pair (term, t) of smallest a.  Two documents agree in a
sample with probability equal to the generalised Jaccard similarity of their
weights.  The pair and its rank are packed in one long, so that a sample is a
``min``, and a fingerprint is one hash aggregation.

``compare_edited`` lays the table out once, in ranges of ``doc_id``; texts,
words and fingerprints then stay in their partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32
#: Documents in a range, and the most ranges.
RANGE = 512
MAX_RANGES = 4096

#: Bits of a sample that name its (term, t); the others hold its rank.
_NAME = 20


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _sample(j: int) -> Column:
    """Sample j of the row's ``term`` (a hash) and ``weight`` as a long:
    its rank above the bits that name it."""
    # two hashes give five uniform numbers
    h, g = F.xxhash64("term", F.lit(2 * j)), F.xxhash64("term", F.lit(2 * j + 1))

    def uniform(bits: Column, low: int, width: int) -> Column:
        return (F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1)).cast("double") + 0.5) * 2.0 ** -width

    # a row without a term has no weight, and so no sample
    r = -F.log(uniform(h, 0, 32) * uniform(h, 32, 32))
    c = -F.log(uniform(g, 0, 24) * uniform(g, 24, 24))
    b = uniform(g, 48, 16)
    t = F.floor(F.col("log_weight") / r + b)
    log_a = F.log(c) - r * (t - b + 1)
    # log_a is within -2**8 .. 2**8 for weights to 2**100
    rank = F.floor((log_a + 512.0) * 2.0 ** 32).cast("long")
    name = F.xxhash64("term", t, F.lit(j)).bitwiseAND(F.lit((1 << _NAME) - 1))
    return F.shiftleft(rank, _NAME).bitwiseOR(name)


def weighted_terms(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``term`` (a hash) and ``weight`` (a count) instead of the
    column ``text``: a row for each distinct word, one with nulls if there is
    none.  The counts are run lengths of the sorted word hashes."""
    others = [c for c in df.columns if c != text]
    df = df.select(*others, F.array_sort(F.transform(words(F.col(text)), lambda w: F.xxhash64(w))).alias("h"))
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("h"), F.lit(1))), lambda i: (F.size("h") > 0) & (
        (i == 1) | (F.element_at("h", i) != F.element_at("h", F.greatest(i - 1, F.lit(1))))))
    df = df.select(*others, "h", starts.alias("starts"))
    end = lambda k: F.when(k + 1 < F.size("starts"), F.col("starts")[k + 1]).otherwise(F.size("h") + 1)
    runs = F.transform("starts", lambda i, k: F.struct(F.element_at("h", i).alias("term"),
                                                       (end(k) - i).alias("weight")))
    return df.select(*others, F.explode_outer(runs).alias("run")).select(*others, "run.term", "run.weight")


def fingerprints(weighted: DataFrame, by: list[str], samples: int = SAMPLES) -> DataFrame:
    """``by`` and ``samples``: an array of longs for each group of
    (..., term long, weight); null for a group whose only terms are null."""
    rows = weighted.withColumn("log_weight", F.log(F.col("weight").cast("double")))
    found = rows.groupBy(*by).agg(*(F.min(_sample(j)).alias(f"s{j}") for j in range(samples)))
    return found.select(*by, F.when(F.col("s0").isNotNull(), F.array(*(f"s{j}" for j in range(samples))))
                        .alias("samples"))


def as_text(samples: Column) -> Column:
    """Four hexadecimal digits for each sample; empty if there is none."""
    digits = F.transform(samples, lambda s: F.lpad(F.lower(F.hex(F.xxhash64(s).bitwiseAND(F.lit(0xFFFF)))), 4, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two arrays; 1 if both are null, 0 if one is."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return (F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0)
            .otherwise(same / F.greatest(F.size(a), F.lit(1))))


def fingerprint_texts(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(text, samples) of each distinct text of ``docs``; a null text counts
    as empty and has null samples, like all texts without words."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct()
    return fingerprints(weighted_terms(texts.select("text", F.col("text").alias("t")), "t"), ["text"], samples)


def _ranges(docs: DataFrame, size: int) -> list[list[int]]:
    """First doc_ids of ranges of about ``size`` documents, the smallest
    doc_id first, in rows of 64 (so that few comparisons find a range)."""
    n, low = docs.agg(F.count("doc_id"), F.min("doc_id")).first()
    if not n:
        return []
    count = min(max(1, n // size), MAX_RANGES)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10 * count)).first()[0] \
        if count > 1 else []
    firsts = sorted({low, *cuts})
    return [firsts[i:i + 64] for i in range(0, len(firsts), 64)]


def compare_edited(docs: DataFrame, samples: int = SAMPLES, size: int = RANGE) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is
    the start of the next document's.

    Returns doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint (strings), near_edited and near_next: the likeness of
    the text's fingerprint to the edited text's and to the next document's.
    The edited text replaces the last floor(n_chars / 2) code points by the
    first as many (or all) of the next document in ascending doc_id; after the
    last comes the first.

    A null text counts as empty.  Texts without words have an empty
    fingerprint; two of them are alike (1), one and another text are not (0).
    Null doc_ids come last.  Rows of equal doc_id follow each other by text.
    A lone document is its own next one.  An empty table gives an empty
    table.  Other columns are ignored.
    """
    cuts = _ranges(docs, size)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if cuts:
        table = F.array(*(F.array(*map(F.lit, row)) for row in cuts))
        line = F.greatest(F.size(F.filter(table, lambda row: row[0] <= F.col("doc_id"))), F.lit(1))
        inside = F.size(F.filter(F.element_at(table, line), lambda first: first <= F.col("doc_id")))
        last = sum(map(len, cuts)) - 1
        own = F.when(F.col("doc_id").isNull(), last).otherwise((line - 1) * 64 + inside - 1).cast("int")
        first = F.element_at(F.element_at(table, line), F.greatest(inside, F.lit(1)))
    else:
        last, own, first = 0, F.lit(0), F.lit(None).cast("long")
    # the first documents of a range also end the one before it
    rows = rows.withColumn("range", own).withColumn("starts", F.col("doc_id").eqNullSafe(first))
    before = F.when(F.col("range") == 0, last).otherwise(F.col("range") - 1)
    rows = rows.withColumn("place", F.explode(F.when(
        F.col("starts"), F.array(F.struct(F.col("range").alias("r"), F.lit(0).alias("after")),
                                 F.struct(before.alias("r"), F.lit(1).alias("after"))))
        .otherwise(F.array(F.struct(F.col("range").alias("r"), F.lit(0).alias("after"))))))
    tasks = max(1, (last + 1) // 4)
    rows = rows.select("doc_id", "text", F.col("place.r").alias("range"), F.col("place.after").alias("after")
                       ).repartition(tasks, "range")
    order = Window.partitionBy("range").orderBy("after", F.col("doc_id").asc_nulls_last(), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    rows = (rows.withColumn("n", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
            .withColumn("edited", F.when(F.col("after") == 0, F.concat(
                F.col("text").substr(F.lit(1), F.length("text") - half),
                F.col("next").substr(F.lit(1), half)))))
    sides = (rows.select("range", "n", "after", "doc_id", F.length("text").cast("long").alias("n_chars"),
                         F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("text")),
                                           F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text"))))
                         .alias("side"))
             .where("side.text is not null")
             .select("range", "n", "after", "doc_id", "n_chars", "side.is_edited", F.col("side.text").alias("text"),
                     F.when(F.col("side.is_edited"), F.sha2("side.text", 256)).alias("sha")))
    found = fingerprints(weighted_terms(sides, "text"),
                         ["range", "n", "after", "doc_id", "n_chars", "is_edited", "sha"], samples)
    # each text is followed by its edited text and by the next document's
    line = Window.partitionBy("range").orderBy("n", "is_edited")
    both = found.select(
        "*", F.lead("sha").over(line).alias("edited_sha256"), F.lead("samples").over(line).alias("edited"),
        F.lead("samples", 2).over(line).alias("next")).where("after = 0 and not is_edited")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("samples")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("edited")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next")).alias("near_next"))
