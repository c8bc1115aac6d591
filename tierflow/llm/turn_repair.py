"""Conversation structure repair by depth-first branch-and-bound.

A conversation is well formed if its roles are an optional system turn, then
user and assistant in turns, ending with an assistant; or if it is empty.  The
cheapest edits (keep, rerole, delete, insert) that make it so are searched
depth first on an explicit stack.  A node is (rows read, last role written);
its bound is the cost so far plus a lower bound of the suffix, taken backwards
over costs alone; only the incumbent settles audits.  (A looser bound, in which
a system turn may stand wherever a user turn may, left long conversations
without an end in sight.)  A node is cut if the incumbent (cost, audit) can't
be beaten, or if the node's dominance table holds a better prefix.  Two
prefixes of equal cost at one node are never prefixes of each other (they would
differ by paid inserts), so the order of (cost, audit) among prefixes is that
of their completions, and the search is exact when the stack is empty.

Spark does the rest.  Rows are dealt by ranges of (conversation, turn), so a
conversation of any length is split over tasks.  A conversation that lies
inside one range is repaired there.  Those at the edges of ranges, and those
whose texts outgrow a buffer, leave one letter a row; the letters are joined
in order and searched in pieces (cheapest edits between any two states of
each piece, which combine), and only then are their texts streamed, in order
and in bounded memory, through the digest.  The audit, one letter a row, is a
cell of the result, so these letters need no more room than the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.stages import staged

#: Costs of edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: Rows of a piece of a long conversation.
PIECE = 48
#: Bytes of texts of one conversation held until its edits are known.
BUFFER_BYTES = 8 << 20
#: Searches that a task remembers, by their letters.
REMEMBERED = 1 << 14

#: States: the last role written.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user or assistant turn put in where it may stand.
_NEXT = (USER, USER, ASSISTANT, USER)
#: State after a kept turn of an initial.
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
_DONE = frozenset((START, ASSISTANT))
#: More than any edits cost.
_NEVER = 1 << 60
_SPACE = " \t\n\x0b\x0c\r"


def _bounds(kinds: str, exits: frozenset[int]) -> list[list[int]]:
    """Lower bounds of each suffix, by state: its cost without the audit."""
    def closed(costs: list[int]) -> list[int]:
        for _ in range(2):  # two inserts lead from any state to any that can follow
            costs = [min(c, INSERT + costs[to]) for c, to in zip(costs, _NEXT)]
        return costs

    out = [closed([0 if q in exits else _NEVER for q in range(4)])]
    for k in reversed(kinds):
        after = out[-1]
        now = [DELETE + c for c in after]
        if k != "-":
            fee = TRUNCATED * k.isupper()
            now = [min(c, REROLE + fee + after[to]) for c, to in zip(now, _NEXT)]
            for (q, initial), to in _KEPT.items():
                if initial == k.lower():
                    now[q] = min(now[q], fee + after[to])
        out.append(closed(now))
    return out[::-1]


def search(kinds: str, entry: int, exits: frozenset[int]) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from a state to one of ``exits``,
    the ASCII-least of them; None if there are none.

    ``kinds`` has a letter for each row: ``-`` for one that must be deleted,
    else its role's initial (s, u, a; x for any other), upper case if its text
    is truncated."""
    bounds = _bounds(kinds, exits)
    if bounds[0][entry] >= _NEVER:
        return None
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if best is not None:
            least = cost + bounds[i][state]
            if least > best[0] or least == best[0] and audit > best[1][:len(audit)]:
                continue
        known = table.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        table[i, state] = cost, audit
        if i == len(kinds) and state in exits and (best is None or (cost, audit) < best):
            best = cost, audit
        to = _NEXT[state]
        nodes = [(i, to, cost + INSERT, audit + "I")]
        if i < len(kinds):
            k = kinds[i]
            nodes.append((i + 1, state, cost + DELETE, audit + "D"))
            if k != "-":
                fee = TRUNCATED * k.isupper()
                nodes.append((i + 1, to, cost + REROLE + fee, audit + "R"))
                kept = _KEPT.get((state, k.lower()))
                if kept is not None:
                    nodes.append((i + 1, kept, cost + fee, audit + "K"))
        # the most promising node is on top, of equal ones the ASCII-least
        nodes.sort(key=lambda n: (n[2] + bounds[n[0]][n[1]], n[3]), reverse=True)
        stack += [n for n in nodes if bounds[n[0]][n[1]] < _NEVER]
    return best


def _between(kinds: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest edits of a run of rows between any two states."""
    if len(kinds) <= PIECE:
        return _piece(kinds)
    half = len(kinds) // PIECE // 2 * PIECE or PIECE
    left, right = _between(kinds[:half]), _between(kinds[half:])
    out = {}
    for entry in range(4):
        for to in range(4):
            both = [(a[0] + b[0], a[1] + b[1]) for via in range(4)
                    if (a := left.get((entry, via))) and (b := right.get((via, to)))]
            if both:
                out[entry, to] = min(both)
    return out


@lru_cache(REMEMBERED)
def _piece(kinds: str) -> dict[tuple[int, int], tuple[int, str]]:
    found = {(e, x): search(kinds, e, frozenset((x,))) for e in range(4) for x in range(4)}
    return {k: v for k, v in found.items() if v}


@lru_cache(REMEMBERED)
def _short(kinds: str) -> tuple[int, str]:
    return search(kinds, START, _DONE)


def repair(kinds: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    if len(kinds) <= PIECE:
        return _short(kinds)
    found = _between(kinds)
    return min(found[START, x] for x in _DONE if (START, x) in found)


class _Writer:
    """The digest of a repaired conversation, turn by turn."""

    def __init__(self, audit: str):
        self.audit, self.at, self.initial, self.sha = audit, 0, "", hashlib.sha256()

    def _write(self, role: str, text: str):
        if self.initial:
            self.sha.update(b"\n")
        # an empty role has no initial, and is never kept
        self.initial = role[0]
        self.sha.update(f"{role}:{text}".encode())

    def _new(self) -> str:
        return "assistant" if self.initial == "u" else "user"

    def inserts(self):
        while self.audit[self.at:self.at + 1] == "I":
            self._write(self._new(), "")
            self.at += 1

    def row(self, role: str, text: str):
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self._write(role if letter == "K" else self._new(), text)

    def digest(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


class _Conversation:
    """What the rows of one conversation in one range add up to."""

    def __init__(self, conv_id):
        self.conv_id, self.kinds, self.held, self.rows = conv_id, [], 0, []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first_turn = self.last_turn = None
        self.turns, self.first, self.last, self.before = 0, "", "", None

    def add(self, turn, role: str, text: str, copies: int, blank: bool, cut: bool, seen: bool):
        if not copies:
            return
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        for _ in range(copies):
            again = seen or self.before == (turn, role, text)
            self.before = turn, role, text
            fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
            if fault:
                self.counts[fault] += 1
            if not self.kinds:
                self.first = initial
            elif self.last + initial not in ("su", "ua", "au"):
                self.counts["illegal"] += 1
            self.last = initial
            k = initial if initial and initial in "sua" else "x"
            self.kinds.append("-" if blank or again else k.upper() if cut else k)
            self.held += 2 + len(role) + len(text)
            if self.held <= BUFFER_BYTES:
                self.rows.append((role, text))
            else:
                self.rows = []

    def row(self, part: int, edge: bool) -> tuple:
        """A row of ``_PARTS``: whole, or open if it lies at an edge."""
        kinds = "".join(self.kinds)
        head = (self.conv_id, part)
        if edge or self.held > BUFFER_BYTES:
            return (*head, True, *self.counts.values(), None, None, None, None, kinds, self.first_turn, self.last_turn,
                    self.turns, self.first, self.last)
        cost, audit = repair(kinds)
        out = _Writer(audit)
        for role, text in self.rows:
            out.row(role, text)
        gaps = _gaps(self.first_turn, self.last_turn, self.turns)
        return (*head, False, *self.counts.values(), gaps, cost, audit, out.digest(), None, None, None, None, None, None)


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return 0 if first is None else min(last - first + 1 - turns, (1 << 63) - 1)


_RESULT = [("gaps", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_PARTS = [("conv_id", pa.int64()), ("part", pa.int32()), ("open", pa.bool_()), ("blank", pa.int64()),
          ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), *_RESULT,
          ("kinds", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
          ("first", pa.string()), ("last", pa.string())]
_COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_SQL = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string"}


def _schema(fields) -> str:
    return ", ".join(f"`{n}` {_SQL[t]}" for n, t in fields)


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations of one range of rows, sorted."""
    part, now, edge, out = TaskContext.get().partitionId(), None, True, []
    for b in batches:
        for conv_id, *row in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.row(part, edge))
                    edge = False
                now = _Conversation(conv_id)
            now.add(*row)
        if len(out) >= 1000:
            yield _batch(out, _PARTS)
            out = []
    if now is not None:
        out.append(now.row(part, True))
    yield _batch(out, _PARTS)


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results, without digests, of conversations given as ordered parts."""
    fields = [(n, t) for n, t in _PARTS if n in _COLUMNS]
    for b in batches:
        out = []
        for conv_id, parts in zip(b["conv_id"].to_pylist(), b["parts"].to_pylist()):
            total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            first_turn = last_turn = None
            turns, last = 0, None
            for p in parts:
                for name in total:
                    total[name] += p[name]
                if p["kinds"]:
                    total["illegal"] += last is not None and last + p["first"] not in ("su", "ua", "au")
                    last = p["last"]
                if p["turns"]:
                    turns += p["turns"] - (p["first_turn"] == last_turn)
                    first_turn = p["first_turn"] if first_turn is None else first_turn
                    last_turn = p["last_turn"]
            cost, audit = repair("".join(p["kinds"] for p in parts))
            out.append((conv_id, *total.values(), _gaps(first_turn, last_turn, turns), cost, audit, None))
        yield _batch(out, fields)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256): for each conversation a row with its audit
    comes first, then its turns in order."""
    fields = [("conv_id", pa.int64()), ("repaired_sha256", pa.string())]
    conv_id, writer, out = None, None, []
    for b in batches:
        for id_, audit, role, text, copies in zip(*(b[c].to_pylist() for c in ("conv_id", "audit", "role", "text", "copies"))):
            if audit is not None:
                if writer is not None:
                    out.append((conv_id, writer.digest()))
                conv_id, writer = id_, _Writer(audit)
                continue
            for _ in range(copies):
                writer.row(role, text)
        if len(out) >= 1000:
            yield _batch(out, fields)
            out = []
    if writer is not None:
        out.append((conv_id, writer.digest()))
    yield _batch(out, fields)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0, 1 or 2, side by side) of
    ``conversations`` after the contract's damage, which the CRC-32 of
    ``conv_id:turn`` decides.  Nulls are one space, but for ids and turns."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of each conversation of (conv_id, turn, role, text), and
    optionally ``copies``: how often a row stands there (1 without it; rows of
    0 only name their conversation).

    Rows are taken by turn, nulls first; those of one turn by role, then text.
    The first fault of a row counts: blank (no visible character), duplicate
    (its role and text came earlier), truncated (the last visible character is
    none of ``.!?``).  Blank and duplicate rows are deleted.  ``gaps`` ignores
    null turns.  A null role or text counts as one space; a null ``conv_id`` is
    a conversation of its own; a role that begins with none of s, u and a, or
    is empty, can't be kept.  A conversation without rows, or of rows that all
    go, has an empty audit or one of D, and the digest of an empty string.  An
    empty table gives an empty table.  Other columns are ignored.
    """
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))
    seen = rows.withColumn("d1", F.xxhash64("conv_id", "role", "text")).withColumn(
        "d2", F.xxhash64(F.lit(1), "conv_id", "role", "text"))
    # texts that recur in their conversation, and where they stand first
    again = staged(seen.where("copies > 0").groupBy("d1", "d2")
                   .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("turn").isNull()).alias("undated"),
                        F.min("turn").alias("since"))
                   .where("n > 1").select("d1", "d2", "undated", "since"), "turn-again")
    visible = F.rtrim(F.col("text"), F.lit(_SPACE))
    later = F.when(F.col("undated"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("since"))
    marked = seen.join(again, ["d1", "d2"], "left").select(
        "conv_id", "turn", "role", "text", "copies", (visible == "").alias("blank"),
        (~F.right(visible, F.lit(1)).isin(".", "!", "?")).alias("cut"), F.coalesce(later, F.lit(False)).alias("seen"))
    # ties of a turn are dealt by the begin of their text, which is how they sort
    begin = F.when(F.length("role") <= 64, F.substring("text", 1, 64))
    parts = staged(marked.repartitionByRange("conv_id", "turn", F.substring("role", 1, 64), begin)
                   .sortWithinPartitions("conv_id", "turn", "role", "text")
                   .mapInArrow(_read_ranges, _schema(_PARTS)), "turn-parts")

    whole = parts.where("not open").select(*_COLUMNS)
    part = F.struct("part", *(n for n, _ in _PARTS[3:7]), *(n for n, _ in _PARTS[-6:]))
    joined = staged(parts.where("open").groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
                    .mapInArrow(_join_parts, _schema([x for x in _PARTS if x[0] in _COLUMNS])), "turn-joined")
    heads = joined.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit("").alias("text"), F.lit(1).alias("copies"), "audit", F.lit(0).alias("at"))
    ids = joined.select(F.col("conv_id").alias("id"))
    turns = (rows.where("copies > 0").join(ids, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi")
             .withColumn("audit", F.lit(None).cast("string")).withColumn("at", F.lit(1)))
    digests = (heads.union(turns).repartition("conv_id").sortWithinPartitions("conv_id", "at", "turn", "role", "text")
               .mapInArrow(_digests, "id long, repaired_sha256 string"))
    rest = (joined.drop("repaired_sha256")
            .join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).select(*_COLUMNS))
    return whole.union(rest)
