import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.helpers import EXTRA, docs_frame
from tierflow.llm import fim_chunks
from tierflow.llm.fim_chunks import UnitCounter, chunk_ends, fill_in_middle, restored

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text, seed=1):
    """(n, form, prefix_chars, middle_chars, output) by the contract."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, texts, ids=None, extra=True):
    df = fill_in_middle(docs_frame(spark, texts, ids, extra=extra))
    got = df.withColumn("again", restored(F.col("output"), F.col("form"))).collect()
    ids = ids or list(range(len(texts)))
    want = sorted(((i, *brute(i, t), t or "") for i, t in zip(ids, texts)), key=repr)
    have = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["again"])
                   for r in got), key=repr)
    assert have == want
    return df


def test_random_texts_and_shared_passages(spark):
    rng = random.Random(1)
    shared = "".join(rng.choice("ab é漢 z.\n") for _ in range(5000))
    texts = []
    for i in range(120):
        own = "".join(rng.choice("abcXYZ    éß漢😀.,\n") for _ in range(rng.randint(0, 3000)))
        texts.append(own + shared * (i % 3) + own[:100])
    df = check(spark, texts)
    assert {r["form"] for r in df.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_edge_rows(spark):
    texts = [None, "", "a", "é", "  ", "<P>", "a<S>b", "x<M", "<P", "a\x00b\x85c d", "<", ">" * 40] * 5
    df = check(spark, texts)
    assert df.columns[5:5 + len(EXTRA) - 1] == [c for c in EXTRA if c != "n"]
    check(spark, ["same words", "same words", "other words here"], [7, 7, None])
    assert fill_in_middle(docs_frame(spark, ["a"]).limit(0)).count() == 0


def test_very_long_texts(spark):
    check(spark, ["word " * 400_000, "q" * 1_500_000, "é" * 900_000, "ab1" * 500_000], extra=False)


def test_chunks_follow_the_content():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(40_000)).encode()
    a, b = b"one " * 50 + passage, b"another start" * 31 + passage
    cuts = [{x - len(t) for x in chunk_ends(t)} for t in (a, b)]
    assert len(cuts[0] & cuts[1]) > 0.9 * len(cuts[0])
    for t in (a, b, b"z" * 300_000, "漢".encode() * 100_000):
        ends = chunk_ends(t)
        assert ends == sorted(set(ends)) and ends[-1] == len(t)
        assert max(y - x for x, y in zip([0, *ends], ends)) <= fim_chunks.MOST + 3
        for e in ends:
            t[:e].decode()


def test_marks_at_the_end_of_a_text():
    rng = random.Random(7)
    base = "".join(rng.choice("abcdefgh é漢") for _ in range(30_000)).encode()
    marked = [e for e in chunk_ends(base)[:-1]]
    assert len(marked) > 20
    for e in marked:  # a mark at the last byte ends the text, and no chunk is empty
        assert chunk_ends(base[:e]) == [x for x in marked if x < e] + [e]
    counter = UnitCounter()
    assert [counter.read(base[:e]).n for e in marked] == [len(UNIT.findall(base[:e].decode())) for e in marked]


def test_cache_is_bounded_and_shared():
    rng = random.Random(4)
    counter = UnitCounter(cache_bytes=20_000)
    passage = "".join(rng.choice("abc de") for _ in range(12_000)).encode()
    first = counter.read(passage).n
    held = len(counter.seen)
    assert counter.read(passage).n == first and len(counter.seen) == held
    for _ in range(20):
        counter.read(bytes(rng.choice(b"xyz ") for _ in range(5000)))
        assert counter.held <= 20_000 + fim_chunks.MOST
    assert counter.read(passage).n == first == len(UNIT.findall(passage.decode()))
