import random

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import docs_frame, near_classes
from tierflow.llm.minhash_dart import dart_minhash, drop_near_duplicates, near_duplicates
from tierflow.llm.queries import QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_brute_force(spark, sf):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '/root/testdata/{sf}/documents.parquet'").fetchall()
    want = dict(zip([d[0] for d in docs], near_classes([d[1] for d in docs], [d[0] for d in docs])))
    got = QUERIES["op10_minhash_dart"](spark, f"/root/testdata/{sf}").collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert all(r["is_first"] == (r["doc_id"] == r["class_id"]) for r in got) and len(got) == len(docs)


def test_collision_rate_is_weighted_jaccard():
    rng = np.random.default_rng(1)
    e = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    a, b = np.r_[np.full(200, 1.5), np.full(50, 4.0)], np.r_[np.full(100, 3.0), np.full(150, 1.2)]
    sig = dart_minhash(np.repeat([0, 1], 250), np.r_[e[:250], e[50:]], np.r_[a, b], 3, 4000)
    wa, wb = np.r_[a, np.zeros(50)], np.r_[np.zeros(50), b]
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    assert not sig[2].any() and sig[:2].all()
    alone = dart_minhash(np.zeros(250, int), e[:250], a, 1, 4000)
    assert (alone[0] == sig[0]).all()


def test_large_group_of_near_copies_and_bystanders(spark):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(300)]
    texts = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(300)] = f"edit{i}"
        texts.append(" ".join(w))
    texts += [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(200)) for _ in range(20)]
    ids = [1000 - i for i in range(len(texts))]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs_frame(spark, texts, ids)).collect()}
    assert got == dict(zip(ids, near_classes(texts, ids)))
    assert drop_near_duplicates(docs_frame(spark, texts, ids)).count() == 21


def test_edge_cases(spark):
    long = " ".join(f"z{i}" for i in range(200_000))
    texts = [None, "", " ", " ", "one two", "one  two", "one", long, long + " end", "\x85 é"]
    df = docs_frame(spark, texts, [5, 6, 7, 8, 9, 10, 11, 12, 13, None])
    got = [(r["doc_id"], r["class_id"], r["is_first"]) for r in near_duplicates(df).collect()]
    assert sorted(g for g in got if g[0]) == [
        (5, 5, True), (6, 5, False), (7, 7, True), (8, 7, False), (9, 9, True), (10, 9, False),
        (11, 11, True), (12, 12, True), (13, 12, False)]
    assert [g for g in got if g[0] is None] == [(None, None, True)]
    assert near_duplicates(df).columns[:5] == df.columns[:5]
    assert near_duplicates(df.limit(0)).count() == 0 and drop_near_duplicates(df.limit(0)).count() == 0


def test_repeated_rows(spark):
    df = docs_frame(spark, ["a b c d e f"] * 3 + ["x"], [4, 4, 9, 2])
    got = sorted((r["doc_id"], r["class_id"], r["is_first"]) for r in near_duplicates(df).collect())
    assert got == [(2, 2, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 4]


def test_block_links_match_pairwise_similarity():
    from tierflow.llm.minhash_dart import _bags, similarity, spanning_links
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 40)}" for _ in range(120)]
    texts = []
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(120)] = f"e{rng.randint(0, 30)}"
        texts.append(" ".join(w).encode())
    texts += [b"a b", b"a b c", b""]
    bags = _bags(texts, 5)
    want = near_classes([t.decode() for t in texts], list(range(len(texts))))
    root = list(range(len(texts)))
    for i, j in zip(*spanning_links(bags, 0.8)):
        assert similarity(bags[i], bags[j]) >= 0.8
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    assert root == want


def test_small_blocks_give_the_same_classes(spark):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    texts = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(120)] = f"edit{rng.randint(0, 999)}"
        texts.append(" ".join(w))
    df = docs_frame(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(df, block=7, bands=40).collect()}
    assert got == dict(enumerate(near_classes(texts, list(range(80)))))
