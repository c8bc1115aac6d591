import random

import pytest

from tests.llm.helpers import EXTRA, cut_words, docs_frame
from tests.oracle_harness import compare
from tierflow.llm import oracle, queries
from tierflow.llm.substring_dedup import WINDOW, dedup_substrings, factors


def rows(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in df.collect()}


def test_matches_sql(spark):
    r = compare(spark, "op9", queries.QUERIES["op9_substring_dedup"], oracle.OP9, "/root/testdata/sf0.001")
    assert r["values_match"], r


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_with_shared_passages(spark, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3 if seed == 0 else 400)]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(15, 60))] for _ in range(6)]
    texts = []
    for _ in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            w += p[a:] if rng.random() < .5 else [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        texts.append(rng.choice([" ", "\n", " \t "]).join(w))
    texts += texts[:10]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    got = rows(dedup_substrings(docs_frame(spark, texts, ids)))
    assert got == cut_words(list(zip(ids, texts)))


def test_edge_cases(spark):
    w = [f"x{i}" for i in range(30)]
    texts = [None, "", " \n", " ".join(w[:19]), " ".join(w[:19]), " ".join(w), "  ".join(w), "a " * 50, "é\x1cb\x85 z"]
    df = dedup_substrings(docs_frame(spark, texts))
    assert df.columns[5:11] == list(EXTRA)
    got = rows(df)
    assert got == cut_words(list(enumerate(texts)))
    assert got[4][1] == 0 and got[6] == (30, 30, "") and got[7][2] == "a"
    assert all(r["key"] is None and r["size"] == 7 for r in df.collect())


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = " ".join(f"y{i}" for i in range(25))
    got = dedup_substrings(docs_frame(spark, [t, t, t, t], [3, 3, None, 5])).select("doc_id", "n_removed").collect()
    assert sorted((r[0] is None, r[0], r[1]) for r in got if r[0]) == [(False, 3, 0), (False, 3, 0), (False, 5, 25)]
    assert [r[1] for r in got if r[0] is None] == [25]
    assert dedup_substrings(docs_frame(spark, ["a"]).limit(0)).count() == 0


def test_very_long_text_and_long_word(spark):
    rng = random.Random(5)
    long = " ".join(str(rng.randint(0, 10 ** 6)) for _ in range(400_000)) + " " + "q" * 3_000_000
    mid = " ".join(long.split(" ")[1000:2000])
    got = rows(dedup_substrings(docs_frame(spark, [long, mid], extra=False)))
    assert got[0][:2] == (400_001, 0) and got[1] == (1000, 1000, "")


def test_factors_refer_to_earlier_words_and_cover_all_copies(spark):
    rng = random.Random(11)
    fresh = iter(range(10 ** 6))
    def new(n):
        return [f"n{next(fresh)}" for _ in range(n)]
    long, other = new(400), new(60)
    texts = [new(30) + long + new(10), new(25) + long[100:300] + new(40) + other, long[350:] + new(5) + long[:120],
             other + long[90:110] + other, new(8) + other[:19] + new(8)]
    texts += [[f"c{i % 7}" for i in range(100)]]
    joined = [" ".join(t) for t in texts]
    docs = docs_frame(spark, joined + [joined[1]], list(range(len(texts))) + [1])       # a repeated row
    hashes = {r["h"]: r["doc_id"] for r in docs.selectExpr("doc_id", "xxhash64(text) AS h").collect()}
    found = factors(docs).collect()
    covered = [set() for _ in texts]
    for f in found:
        d, r = hashes[f["text_hash"]], hashes[f["ref"]]
        assert d == f["doc_id"] and f["n_words"] >= WINDOW and (r, f["ref_start"]) < (d, f["start"])
        n = f["n_words"]
        assert texts[d][f["start"]:f["start"] + n] == texts[r][f["ref_start"]:f["ref_start"] + n]
        covered[d] |= set(range(f["start"], f["start"] + n))
    want = cut_words(list(enumerate(joined)))
    assert {i: len(c) for i, c in enumerate(covered)} == {i: want[i][1] for i in want}
    # a passage of one place is one factor, however many blocks it spans
    assert [(f["start"], f["n_words"], f["ref_start"]) for f in found if f["doc_id"] == 1] == [(25, 200, 130)]
    assert sorted((f["start"], f["n_words"], hashes[f["ref"]]) for f in found if f["doc_id"] == 2) == [(0, 50, 0), (55, 120, 0)]
    assert {f["doc_id"] for f in found} == {1, 2, 3, 5}
    got = rows(dedup_substrings(docs))
    assert got == want
    assert factors(docs.limit(0)).count() == 0
