import hashlib

import duckdb
import pytest

from tests.llm.helpers import docs_frame, words
from tierflow.llm.cws_fingerprint import as_text, compare_edited, fingerprint_texts
from tierflow.llm.queries import QUERIES


def edited_texts(rows):
    """[(doc_id, text, edited, next)] in ascending (doc_id, text)."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        out.append((i, t, t[:len(t) - half] + after[:half], after))
    return out


def check(spark, out, rows):
    want = edited_texts(rows)
    texts = sorted({x for r in want for x in r[1:]})
    prints = {r["text"]: (r["samples"], r["f"]) for r in fingerprint_texts(
        spark.createDataFrame([(t,) for t in texts], "text string")).select(
        "text", "samples", as_text("samples").alias("f")).collect()}

    def like(a, b):
        a, b = prints[a][0], prints[b][0]
        if a is None or b is None:
            return float(a is None and b is None)
        return sum(x == y for x, y in zip(a, b)) / len(a)

    want = [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), prints[t][1], prints[e][1], like(t, e), like(t, n))
            for i, t, e, n in want]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_query_matches_brute_force(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    check(spark, QUERIES["op8_cws_fingerprint"](spark, "/root/testdata/sf0.001"), rows)


@pytest.mark.parametrize("size", [3, 512])
def test_edge_rows(spark, size):
    texts = [None, "", "a", "a b", "a b", "\t \n", "x y z " * 5000, "äöü 🙂🙂 ß", "one two three", "one two four"]
    ids = [0, 1, 5, 7, 7, 9, 12, 20, 21, None]
    check(spark, compare_edited(docs_frame(spark, texts, ids=ids), size=size), list(zip(ids, texts)))


def test_lone_and_no_document(spark):
    docs = docs_frame(spark, ["a b c d"])
    check(spark, compare_edited(docs), [(0, "a b c d")])
    assert compare_edited(docs.limit(0)).collect() == []


def test_collision_rate_is_generalised_jaccard(spark):
    a = " ".join(["a"] * 6 + ["b"] * 3 + ["c"] * 1 + [f"u{i}" for i in range(10)])
    b = " ".join(["a"] * 2 + ["b"] * 5 + ["c"] * 1 + [f"u{i}" for i in range(4, 14)])
    count = lambda t: {w: words(t).count(w) for w in words(t)}
    x, y = count(a), count(b)
    want = sum(min(x.get(w, 0), y.get(w, 0)) for w in x | y) / sum(max(x.get(w, 0), y.get(w, 0)) for w in x | y)
    s, t = (r["samples"] for r in fingerprint_texts(docs_frame(spark, [a, b]), samples=256).collect())
    assert abs(sum(i == j for i, j in zip(s, t)) / 256 - want) < 0.1


def test_main_path_is_native(spark):
    plan = QUERIES["op8_cws_fingerprint"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "MapInPandas", "ExistingRDD"))
