"""SentencePiece BPE encoding with a prefix table.

Merging pairs by score, as the library does, is replaced by an exact dynamic
program.  The encoding of a prefix of a text is unique, and its last token
determines it: remove the token, and what is left is the encoding of the
shorter prefix.  So a table with the last token of every prefix holds all
encodings.  It is filled from left to right: an Aho-Corasick automaton gives
the pieces that end at a position, and a piece is the last token if and only
if it is compatible with the last token of the prefix before it, i.e. if the
two alone would be merged no further.  The ids are recovered backwards.

Pieces hold the space mark only in front, so a text is encoded word by word,
and words are remembered in a bounded cache.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
#: Entries of each of the caches of a task.
CACHE = 300_000
#: Texts that are encoded, and words that are put together, at a time.
ROWS = 512
RUN = 65_536


class PrefixEncoder:
    """Encodes like ``SentencePieceProcessor(model_file).encode(text)`` without
    begin or end ids, and decodes like ``decode(ids)``, for BPE models with
    byte fallback and without user-defined symbols."""

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(size)]
        special = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i)
                   for i in range(size)]
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes beyond a word")
        self.scores = {p: self.model.get_score(i) for p, i in self.ids.items()}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        # line ends that no piece goes across end a word, too
        ends = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        self.words = re.compile(f"{MARK}*[^{MARK}{ends}]+|{MARK}+" + (f"|[{ends}]" if ends else ""))
        self.digits = [str(i) for i in range(size)]
        self.surfaces = [bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode()
                         for i, p in enumerate(self.pieces)]
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, (p, len(p)))
        self.automaton.make_automaton()
        self.history: dict[str, tuple | None] = {}
        self.compatible: dict[tuple[str, str], bool] = {}
        self.young: dict[str, str | tuple[str, bytes]] = {}
        self.old: dict[str, str | tuple[str, bytes]] = {}

    def _merges(self, token: str) -> tuple[list[float], list[str], list[str]] | None:
        """How the characters of a token become one: scores of the merges in
        order, and the first and the last symbol before each and at the end.
        None if they end as more than one symbol."""
        if token not in self.history:
            out, order, heads, tails = list(token), [], [token[0]], [token[-1]]
            while len(out) > 1:
                best, at = None, -1
                for i in range(len(out) - 1):
                    score = self.scores.get(out[i] + out[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if at < 0:
                    break
                out[at:at + 2] = [out[at] + out[at + 1]]
                order.append(best)
                heads.append(out[0])
                tails.append(out[-1])
            self.history[token] = (order, heads, tails) if len(out) == 1 else None
        return self.history[token]

    def _fits(self, left: str, right: str) -> bool:
        """Whether the tokens stay as they are side by side; left may be
        empty: whether right is a token at all.

        Each side's own merges come in the order they have alone, so the two
        orders are walked together, by score and then from the left; the pair
        breaks if a merge across the boundary is ever the best."""
        if not left:
            return self._merges(right) is not None
        key = (left, right)
        found = self.compatible.get(key)
        if found is None:
            if len(self.compatible) >= CACHE:
                self.compatible.clear()
            found = self.compatible[key] = self._stays(left, right)
        return found

    def _stays(self, left: str, right: str) -> bool:
        first, second = self._merges(left), self._merges(right)
        if first is None or second is None:
            return False
        (mine, _, tails), (other, heads, _) = first, second
        i = j = 0
        while True:
            across = self.scores.get(tails[i] + heads[j])
            a = mine[i] if i < len(mine) else None
            b = other[j] if j < len(other) else None
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is None and b is None:
                return True
            if b is None or a is not None and a >= b:
                i += 1
            else:
                j += 1

    def tokens(self, word: str) -> list[str]:
        """The tokens of one word: pieces, and characters that are no piece."""
        last: list[str | None] = [None] * (len(word) + 1)
        last[0], filled, known = "", 0, self.compatible
        for end, (piece, length) in self.automaton.iter(word):  # by end, the longest first
            end += 1
            while filled < end - 1:
                filled += 1
                if last[filled] is None:  # a character that is no piece
                    last[filled] = word[filled - 1]
            if last[end] is None:
                left = last[end - length]
                fits = known.get((left, piece))
                if self._fits(left, piece) if fits is None else fits:
                    last[end] = piece
        out, end = [], len(word)
        while end:
            token = last[end] or word[end - 1]
            out.append(token)
            end -= len(token)
        return out[::-1]

    def _encoded(self, word: str) -> str | tuple[str, bytes]:
        """The ids of a word joined by commas; with their decoded bytes, where
        these are not the word itself."""
        found = self.old.get(word)
        if found is None:
            ids: list[int] = []
            for token in self.tokens(word):
                one = self.ids.get(token)
                if one is not None:
                    ids.append(one)
                else:
                    ids += [self.bytes[b] for b in token.encode()]
            found, surface = ",".join([self.digits[i] for i in ids]), self._surface(ids)
            if surface != word.replace(MARK, " ").encode():
                found = found, surface
        if len(self.young) >= CACHE:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def _surface(self, ids: list[int]) -> bytes:
        """Decoded bytes of ids that are not the first of their text."""
        return b"".join([self.surfaces[i] for i in ids])

    def runs(self, text: str) -> Iterator[tuple[str, bytes]]:
        """(ids joined by commas, decoded bytes) of runs of words, of bounded
        length."""
        found = (m.group() for m in self.words.finditer(self.model.normalize(text)))
        get = self.young.get
        while run := list(islice(found, RUN)):
            coded = [get(w) or self._encoded(w) for w in run]
            get = self.young.get
            try:
                yield ",".join(coded), "".join(run).replace(MARK, " ").encode()
            except TypeError:
                yield (",".join(c if isinstance(c, str) else c[0] for c in coded),
                       b"".join(w.replace(MARK, " ").encode() if isinstance(c, str) else c[1]
                                for w, c in zip(run, coded)))

    def encode(self, text: str) -> np.ndarray:
        return self.coded(text, ("ids",))["ids"]

    def coded(self, text: str, want: tuple[str, ...]) -> dict:
        """The wanted ones of ``COLUMNS`` of a text.  Digests are updated run
        by run, so they hold neither the ids nor the decoded text."""
        n, first, sha, decoded_sha = 0, True, hashlib.sha256(), hashlib.sha256()
        ids, decoded = [np.empty(0, np.int32)], []
        for listed, surface in self.runs(text):
            n += listed.count(",") + 1
            if first and surface[:1] == b" ":
                surface = surface[1:]  # the library's own space before a text
            if "ids_sha256" in want:
                sha.update(listed.encode() if first else f",{listed}".encode())
            if "decoded_sha256" in want:
                decoded_sha.update(surface)
            if "ids" in want:
                ids.append(np.fromstring(listed, dtype=np.int32, sep=","))
            if "decoded" in want:
                decoded.append(surface)
            first = False
        found = {"ids": lambda: np.concatenate(ids), "n_tokens": lambda: n, "ids_sha256": sha.hexdigest,
                 "decoded": lambda: b"".join(decoded).decode("utf-8", "replace"),
                 "decoded_sha256": decoded_sha.hexdigest}
        return {c: found[c]() for c in want}

    def decode(self, ids: list[int]) -> str:
        surface = self._surface([i for i in ids if not self.model.is_control(i)])
        return (surface[1:] if surface[:1] == b" " else surface).decode("utf-8", "replace")


#: What ``encode_texts`` can give.
COLUMNS = {"ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), "n_tokens": (T.LongType(), pa.int64()),
           "ids_sha256": (T.StringType(), pa.string()), "decoded": (T.StringType(), pa.string()),
           "decoded_sha256": (T.StringType(), pa.string())}


def encode_texts(docs: DataFrame, model_file: str, columns: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``docs`` with the given columns of its ``text``: ``ids`` (array of
    int), ``n_tokens`` (their number), ``ids_sha256`` (of the decimal ids joined
    by commas), ``decoded`` (the ids decoded again) and ``decoded_sha256``.
    They replace columns of those names; all others are passed on.

    A null text counts as empty, which has no ids.  Repeated rows have equal
    results; an empty table gives an empty table.  ``model_file`` must be
    readable on every executor.
    """
    docs = docs.drop(*columns)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PrefixEncoder(model_file)
        text, codes = "", encoder.coded("", columns)  # copies of a text stand side by side in a mix
        for b in (whole.slice(lo, ROWS) for whole in batches for lo in range(0, whole.num_rows, ROWS)):
            found = []
            for t in b.column(at).to_pylist():
                if (t or "") != text:
                    text = t or ""
                    codes = encoder.coded(text, columns)
                found.append(codes)
            more = [pa.array([f[c] for f in found], COLUMNS[c][1]) for c in columns]
            yield pa.RecordBatch.from_arrays([*b.columns, *more],
                                             names=[f"c{i}" for i in range(len(names) + len(columns))])

    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
    fields += [T.StructField(f"c{len(names) + i}", COLUMNS[c][0]) for i, c in enumerate(columns)]
    return docs.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(run, T.StructType(fields)).toDF(
        *names, *columns)
