import hashlib
import itertools
import random
import re
import zlib

import pytest

from tierflow.llm import turn_repair
from tierflow.llm.turn_repair import damaged, repair, repair_conversations, search

LEGAL = re.compile("(s?(ua)+)?")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def exhaustive(kinds):
    """Cheapest (cost, audit) over all edits with up to two inserts a gap."""
    best = None
    for inserts in itertools.product(range(3), repeat=len(kinds) + 1):
        for letters in itertools.product("DKR", repeat=len(kinds)):
            if any(k == "-" and x != "D" for k, x in zip(kinds, letters)):
                continue
            cost = 2 * sum(inserts) + sum({"D": 3, "K": 0, "R": 2}[x] + (x != "D" and k.isupper())
                                          for k, x in zip(kinds, letters))
            audit = "".join("I" * n + x for n, x in zip(inserts, [*letters, ""]))
            if best and (cost, audit) >= best:
                continue
            kept = iter(kinds)
            choices = []
            for x in audit:
                k = next(kept) if x != "I" else ""
                if x == "K":
                    choices.append([k.lower()])
                elif x in "RI":
                    choices.append("ua")
            if any(LEGAL.fullmatch("".join(roles)) for roles in itertools.product(*choices)):
                best = cost, audit
    return best


def table(kinds):
    """Cheapest (cost, audit) by a table over all prefixes."""
    step = {0: 2, 1: 2, 2: 3, 3: 2}
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserted(front):
        for _ in range(4):
            for q, (c, a) in list(front.items()):
                new = c + 2, a + "I"
                if step[q] not in front or new < front[step[q]]:
                    front[step[q]] = new
        return front
    front = inserted({0: (0, "")})
    for k in kinds:
        after = {}
        for q, (c, a) in front.items():
            found = [(q, c + 3, a + "D")]
            if k != "-":
                fee = k.isupper()
                found.append((step[q], c + 2 + fee, a + "R"))
                if (q, k.lower()) in keep:
                    found.append((keep[q, k.lower()], c + fee, a + "K"))
            for to, cost, audit in found:
                if to not in after or (cost, audit) < after[to]:
                    after[to] = cost, audit
        front = inserted(after)
    return min(front[q] for q in (0, 3) if q in front)


def brute(rows):
    """The contract, conversation by conversation, on damaged rows
    (conv_id, turn, role, text, copies)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv and r[4]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        own = [r for r in own for _ in range(r[4])]
        kinds, counts, seen = "", [0, 0, 0], set()
        for _, _, role, text, _ in own:
            shown = VISIBLE.findall(text)
            k = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not shown:
                counts[0] += 1
                k = "-"
            elif (role, text) in seen:
                counts[1] += 1
                k = "-"
            elif shown[-1] not in ".!?":
                counts[2] += 1
                k = k.upper()
            seen.add((role, text))
            kinds += k
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = table(kinds)
        lines, at, last = [], iter(own), ""
        for x in audit:
            r = next(at) if x != "I" else None
            if x != "D":
                role = r[2] if x == "K" else "assistant" if last == "u" else "user"
                last = role[0]
                lines.append(f"{role}:{r[3] if r else ''}")
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def harm(conv, turn, role, text):
    h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    text = "" if h in (0, 1) else re.sub("[.!?]", "", text) if h == 2 else text
    return conv, turn, "user" if h == 4 else role, text, {0: 0, 3: 2}.get(h, 1)


def check(spark, rows):
    got = repair_conversations(damaged(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", kinds string")))
    assert got.columns == COLUMNS
    found = got.collect()
    have = {r["conv_id"]: tuple(r)[1:] for r in found}
    assert len(found) == len(have)
    assert have == brute([harm(*r) for r in rows])
    return have


@pytest.mark.parametrize("length", range(5))
def test_search_equals_all_edits(length):
    rng = random.Random(length)
    cases = {"".join(rng.choice("suaxSUAX-") for _ in range(length)) for _ in range(20 if length > 3 else 60)}
    for kinds in cases:
        assert search(kinds, 0, frozenset((0, 3))) == exhaustive(kinds) == table(kinds), kinds


def test_long_conversations_are_searched_in_pieces():
    rng = random.Random(9)
    for n in (47, 48, 49, 96, 97, 500, 3000):
        for letters in ("suaxSUAX-", "ua", "u", "a", "s", "sS", "x", "uuuuuuaS", "saas-"):
            kinds = "".join(rng.choice(letters) for _ in range(n))
            assert repair(kinds) == table(kinds), (n, letters)


def test_random_tables_equal_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    texts = ["Well.", "Yes!", "no", "", "  ", None, "Half a", "Why?", "\t\n", "end.  \n", "é"]
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] if rng.random() < .6 else ["system", "tool", "", None, "User"])
            at = rng.choice([turn, turn + rng.randint(0, 3), None]) if rng.random() < .3 else turn
            rows.append((conv, at, role, rng.choice(texts) if rng.random() < .5 else f"Text {turn} of {conv}."))
    rng.shuffle(rows)
    check(spark, rows)


def test_one_conversation_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "BUFFER_BYTES", 300)
    rng = random.Random(6)
    rows = [(5, t, ("user", "assistant")[t % 2] if rng.random() < .9 else "system", rng.choice(["a.", f"t {t}!", f"c {t}"]))
            for t in range(4000)]
    rows += [(c, t, "user", "x " * 100 + f"{t}.") for c in (4, 6) for t in range(20)]
    rows += [(7, 3, r, x) for r in ("user", "assistant") for x in ("a.", "b.", "a.", "") for _ in range(5)]
    found = check(spark, rows)
    assert len(found[5][6]) > 3000


def test_edge_tables(spark):
    assert repair_conversations(damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    dropped = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert check(spark, [(1, dropped, "user", "Hello.")])[1] == (0, 0, 0, 0, 0, 0, "", empty)
    check(spark, [(2, 0, "user", "y" * 3_000_000 + "."), (2, 1, "assistant", "z. " * 500_000)])
    plain = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello.")], SCHEMA)
    assert repair_conversations(plain).collect()[0]["audit"] == "KK"
