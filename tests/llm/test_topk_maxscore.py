import numpy as np
import pytest

from tierflow.llm.topk_maxscore import Shard, quantized, top_k


def brute(queries, rows, k):
    out = {}
    for qid, q in queries:
        scored = sorted((-sum(a * b for a, b in zip(q, x)), i) for i, x in rows if i != qid)
        out[qid] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard,block", [(7, 3), (1000, 1000)])
def test_matches_brute_force_with_ties_and_signs(spark, shard, block):
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-3, 4, 6)]) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(200, [0] * 6), (250, [-1] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    queries = [r for r in rows if r[0] % 50 == 0]
    got = found(top_k(df.where("vec_id % 50 = 0"), df, 5, shard, block))
    assert got == brute(queries, rows, 5)


def test_shard_search_prunes_exactly():
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(3000, 32)) * 200).astype(np.int64)
    shard = Shard(np.arange(3000), x)
    for own in range(0, 3000, 500):
        scores, ids = shard.search(own, x[own], 5)
        all_scores = x @ x[own]
        order = [i for i in np.lexsort((np.arange(3000), -all_scores)) if i != own][:5]
        assert ids.tolist() == order and scores.tolist() == all_scores[order].tolist()


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [0.5, -0.25], "a"), (1, None, "a"), (2, [None, 1.0], "b"), (3, [nan, 1.0], "b"),
            (4, [float("inf"), 0.0], None), (5, [0.001, -0.001], None), (5, [0.001, -0.001], None),
            (50, [1.0, 1.0], "c"), (None, [1.0, 1.0], "c"), (6, [], "d")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    q = quantized(df)
    assert sorted((r["vec_id"], list(r["x"])) for r in q.collect()) == [
        (0, [128, -64]), (5, [0, -1]), (5, [0, -1]), (6, []), (50, [256, 256])]
    got = found(top_k(q.where("vec_id % 50 = 0"), q, 5))
    assert got[0] == [(50, 16384), (5, 64), (5, 64), (6, 0)]
    assert got[50] == [(0, 16384), (6, 0), (5, -256), (5, -256)]
    assert top_k(q.limit(0), q, 5).collect() == [] and top_k(q, q.limit(0), 5).collect() == []


@pytest.mark.parametrize("size", [40_000_000, 1 << 45, (1 << 63) - 1])
def test_large_components_rank_by_exact_scores(spark, size):
    rng = np.random.default_rng(7)
    rows = [(i, [int(v) for v in rng.integers(-9, 10, 8)]) for i in range(150)]
    for i in range(0, 150, 3):  # large and nearly equal: ranks hang on the last bits
        rows[i] = (i, [size - int(abs(v)) if d % 2 else -size + int(abs(v)) for d, v in enumerate(rows[i][1])])
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    queries = [r for r in rows if r[0] % 50 == 0]
    got = found(top_k(df.where("vec_id % 50 = 0"), df, 5, 40, 2))
    limit = (1 << 63) - 1
    want = {q: [(i, max(min(s, limit), -limit - 1)) for i, s in best] for q, best in brute(queries, rows, 5).items()}
    assert got == want


def test_components_beyond_64_bits_become_the_nearest(spark):
    df = spark.createDataFrame([(0, [1e300, -1e300]), (1, [2.0**40, 1.0])], "vec_id long, embedding array<double>")
    limit = (1 << 63) - 1
    assert sorted((r["vec_id"], list(r["x"])) for r in quantized(df).collect()) == [
        (0, [limit, -limit]), (1, [1 << 48, 256])]
