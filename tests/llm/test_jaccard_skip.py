import random

import numpy as np
import pytest

from tests.llm.helpers import docs_frame, words
from tierflow.llm import jaccard_skip
from tierflow.llm.jaccard_skip import jaccard_components, search_links


def shingle_set(text, k=3):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = words(low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def least_reachable(ids, sets, percent=90):
    """The smallest id that links reach, by all pairs."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (x, a) in enumerate(zip(ids, sets)):
        for y, b in zip(ids[:i], sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(x), find(y)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def check(spark, texts, ids=None, **options):
    ids = ids or list(range(len(texts)))
    df = jaccard_components(docs_frame(spark, texts, ids), **options)
    assert df.columns[-2:] == ["n_shingles", "component_id"] and "key" in df.columns
    sets = [shingle_set(t) for t in texts]
    want = least_reachable(ids, sets)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())
    assert got == sorted((i, len(s), want[i]) for i, s in zip(ids, sets))
    return got


def family(rng, n, length, edits, vocab):
    """A chain of texts, each an edited copy of an earlier one."""
    out = [[rng.choice(vocab) for _ in range(length)]]
    while len(out) < n:
        w = list(rng.choice(out[-5:]))
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append(w)
    return [" ".join(w) for w in out]


def corpus(rng):
    vocab = [f"w{i}" for i in range(500)]
    passage = " ".join(rng.choice(vocab) for _ in range(40))
    texts = []
    for length, edits in ((20, 1), (60, 2), (60, 4), (200, 6), (200, 12), (9, 1), (3, 1)):
        texts += family(rng, 25, length, edits, vocab)
    texts += [passage + " " + " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += texts[::7] + [t.upper() for t in texts[::11]] + ["  ".join(t.split()) for t in texts[::13]]
    ids = list(range(1000, 1000 + len(texts)))
    rng.shuffle(ids)
    return texts, ids


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_pairs(spark, seed):
    texts, ids = corpus(random.Random(seed))
    got = check(spark, texts, ids)
    assert 20 < len({c for _, _, c in got}) < len(got) - 50


def test_cut_parts_and_many_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_skip, "BUCKET", 500)
    texts, ids = corpus(random.Random(5))
    check(spark, texts, ids, part=400)


def test_search_equals_all_pairs():
    rng = np.random.default_rng(3)
    for n, size, pool in ((30, 12, 16), (60, 40, 46), (40, 100, 105), (25, 1, 4)):
        sets = [np.unique(rng.choice(pool, min(size, pool), replace=False)).astype(np.uint64) for _ in range(n)]
        sets += [s[:-1] for s in sets[:5]]
        want = least_reachable(list(range(len(sets))), [set(s.tolist()) for s in sets])
        links = search_links(sets)
        root = list(range(len(sets)))
        for _ in sets:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        assert root == [want[i] for i in range(len(sets))]
        # residents are found by visitors wherever they are linked
        v = len(sets) // 3
        found = {b for a, b in search_links(sets, visitors=v)}
        assert all(b < len(sets) - v for b in found)


def test_edge_rows(spark):
    texts = [None, None, "", " \n", "One", "one ", "one two", "ONE\ttwo", "É x", "é x", "a b c", "a b c", "a\x1cb"]
    got = check(spark, texts)
    assert [c for _, _, c in got] == [0, 1, 2, 3, 4, 4, 6, 6, 8, 9, 10, 10, 12]
    assert jaccard_components(docs_frame(spark, ["a"]).limit(0)).count() == 0
    t = " ".join(f"y{i}" for i in range(40))
    rows = jaccard_components(docs_frame(spark, [t, t, t + " z", "q r s"], [None, None, 4, None])).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in rows) == [
        (-1, 1, 4), (-1, 38, 4), (-1, 38, 4), (4, 39, 4)]


def test_very_long_texts(spark):
    rng = random.Random(8)
    long = [str(rng.randint(0, 10 ** 6)) for _ in range(300_000)]
    edited = list(long)
    for i in range(0, len(long), 60):
        edited[i] = "x"
    other = list(long)
    for i in range(0, len(long), 20):
        other[i] = "x"
    rows = jaccard_components(docs_frame(spark, [" ".join(long), " ".join(edited), " ".join(other)], extra=False)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(0, 0), (1, 0), (2, 2)]
