"""Language identification by compression with per-language dictionaries.

A language is represented by raw text: a zstandard raw-content dictionary of
labelled documents.  A text is encoded with each dictionary; the language
whose dictionary gives the fewest bytes wins, and the text is rejected if the
margin to the next one is narrow.

Texts are lower-cased, and everything but letters becomes single spaces, so
case, digits and table marks carry no evidence.  They are encoded whole, in
pieces of ``PIECE`` bytes: in a longer stretch a text's own beginning would
replace the dictionary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of the sample that a dictionary is made of, and of the languages.
ROWS_PER_LANG = 64
CHARS_PER_ROW = 2048
MAX_LANGS = 256

PIECE = 4096
LEVEL = 9
#: Pieces under this size are also encoded at another level: one byte more or
#: less decides there.
SHORT, SHORT_LEVEL = 1024, 3
#: Levels that break a tie, in turn.
TIE_LEVELS = (12, 6, 5)

#: A text is rejected if the next language is not at least this share of the
#: encoded bytes worse, or less than MIN_MARGIN bytes.  Chosen on held-out rows:
#: see the README.
MIN_SHARE, MIN_MARGIN = 0.02, 1

UNKNOWN = "und"

_GAPS = re.compile(r"[\W\d_]+")


def normalized(text: str) -> bytes:
    """Lower-case letters with single spaces; empty if there is no letter."""
    words = _GAPS.sub(" ", text.lower()).strip()
    return f" {words} ".encode() if words else b""


def learn(labelled: DataFrame, rows_per_lang: int = ROWS_PER_LANG,
          chars_per_row: int = CHARS_PER_ROW) -> dict[str, bytes]:
    """A dictionary for each non-null ``lang`` of (text, lang) rows.

    The sample is bounded: of each language, the ``rows_per_lang`` distinct
    texts of smallest hash, and of each at most ``chars_per_row`` characters
    (this bounds the training sample alone; predictions read whole texts).
    More than ``MAX_LANGS`` languages raise ValueError.  Null texts and texts
    without a letter are left out; without any labelled text there is no
    dictionary.
    """
    rows = labelled.select("lang", "text").where("lang is not null and text is not null").where(
        F.col("text").rlike(r"\p{L}"))
    hashed = rows.select("lang", F.xxhash64("text").alias("h"), F.substring("text", 1, chars_per_row).alias("text"))
    langs = hashed.select("lang").distinct().limit(MAX_LANGS + 1).count()
    if langs > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    by_hash = Window.partitionBy("lang").orderBy("h")
    picked = (hashed.select("lang", "h").distinct()
              .withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= rows_per_lang).drop("r"))
    # at most MAX_LANGS * rows_per_lang rows: small enough to broadcast and to collect
    sample = (hashed.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
              .collect())
    sample.sort(key=lambda r: (r["lang"], r["h"]))
    out: dict[str, bytes] = {}
    for r in sample:
        out[r["lang"]] = out.get(r["lang"], b"") + normalized(r["text"])
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.dictionaries = [dictionaries[x] for x in self.langs]
        self.by_level: dict[int, list[zstandard.ZstdCompressor]] = {}

    def _encoders(self, level: int) -> list[zstandard.ZstdCompressor]:
        out = self.by_level.setdefault(level, [])
        for d in self.dictionaries[len(out):]:
            raw = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            out.append(zstandard.ZstdCompressor(level=level, dict_data=raw, write_checksum=False,
                                                write_content_size=False, write_dict_id=False))
        return out

    def sizes(self, data: bytes) -> list[int]:
        """Encoded bytes by language."""
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        out = [sum(len(e.compress(p)) for p in pieces) for e in self._encoders(LEVEL)]
        if len(pieces[-1]) < SHORT:
            out = [n + len(e.compress(pieces[-1])) for n, e in zip(out, self._encoders(SHORT_LEVEL))]
        for level in TIE_LEVELS:
            if out.count(min(out)) == 1:
                break
            out = [n + len(e.compress(pieces[-1])) for n, e in zip(out, self._encoders(level))]
        return out

    def predict(self, text: str | None, min_margin: int, min_share: float = MIN_SHARE) -> tuple[str, float, bool]:
        data = normalized(text) if text else b""
        if not data or not self.langs:
            return UNKNOWN, 0.0, True
        sizes = self.sizes(data)
        best = min(sizes)
        # a byte fewer makes a language 256 times as likely
        score = 1 / sum(2.0 ** (8 * (best - n)) for n in sizes if n - best < 100)
        # best counts all levels that broke a tie, so one byte of many tries is a small share
        least = max(min_margin, min_share * best)
        margin = min((n - best for i, n in enumerate(sizes) if i != sizes.index(best)), default=least)
        return self.langs[sizes.index(best)], score, margin < least


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: int = MIN_MARGIN,
             min_share: float = MIN_SHARE) -> DataFrame:
    """``docs`` with three more columns from ``text`` alone: ``lang_pred``,
    ``score`` (the likelihood share of the winner, 0 to 1) and ``rejected``.
    They replace columns of those names; all others are passed on.

    Null and empty texts and those without a letter give ``und``, score 0, and
    are rejected, and so are all texts if there is no dictionary; so is a text
    whose best language is less than ``min_margin`` bytes, or ``min_share`` of
    its encoded bytes, better than the next: a language that was not learned,
    mixed text, noise.  Ties go to the first language in code point order.  Repeated rows have equal results; an empty table gives
    an empty table.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    names = docs.columns
    at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for b in batches:
            found = [classifier.predict(t, min_margin, min_share) for t in b.column(at).to_pylist()]
            more = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[f"c{i}" for i in range(len(names) + 3)])

    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
    fields += [T.StructField(f"c{len(names) + i}", t) for i, t in
               enumerate((T.StringType(), T.DoubleType(), T.BooleanType()))]
    return docs.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(run, T.StructType(fields)).toDF(
        *names, "lang_pred", "score", "rejected")


def held_out() -> Column:
    """Documents kept from training: crc32 of the doc_id as text mod 4 is 2
    (a null doc_id is not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
