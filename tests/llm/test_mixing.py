import math
from collections import defaultdict

import duckdb
import pytest

from tests.llm.helpers import docs_frame, words
from tierflow.llm.mixing import mix_sources
from tierflow.llm.queries import QUERIES


def brute_targets(sizes):
    """{source: target} of {source: words}: the share rule, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left = {}, 1.5 * sum(sizes.values())
    free = set(order)
    while free:
        factor = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * factor >= 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * factor for s in free}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def check_mix(rows, slack):
    """Rows of (size, source, source_size, target, copies)."""
    sizes, took = defaultdict(int), defaultdict(int)
    for size, source, *_, copies in rows:
        sizes[source] += size
        took[source] += copies * size
    targets = brute_targets(sizes)
    for size, source, source_size, target, copies in rows:
        assert source_size == sizes[source] and math.isclose(target, targets[source], rel_tol=1e-9, abs_tol=1e-9)
        rate = target / source_size if source_size else 0
        assert copies in (math.floor(rate + 1e-12), math.ceil(rate - 1e-12)) and copies <= 2
    for source, target in targets.items():
        largest = max(r[0] for r in rows if r[1] == source)
        assert abs(took[source] - target) <= slack * largest


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_meets_targets(spark, sf):
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '/root/testdata/{sf}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op2_mix_sources"](spark, f"/root/testdata/{sf}").collect()}
    assert len(got) == len(docs)
    rows = []
    for i, text, source in docs:
        r, n = got[i], len(words(text))
        assert r["size"] == n
        rows.append((n, source, r["source_size"], r["target"], r["taken"] // n if n else 0))
    check_mix([r for r in rows if r[0]], 1)


def test_edge_rows_and_reruns(spark):
    texts = [None, "", " \t\n", "a b c", "a b c", "x " * 20_000, "one"] + [f"w{i} a b" for i in range(40)]
    sources = ["s1", "s1", "s2", None, None, "s1", "s2"] + ["s3", None] * 20
    docs = docs_frame(spark, texts, sources=sources)
    out = mix_sources(docs)
    assert out.columns == [c for c in docs.columns if c != "size"] + ["size", "source_size", "target", "copies"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(texts) and got[0]["size"] == got[1]["size"] == got[2]["size"] == 0
    check_mix([(r["size"], r["source"], r["source_size"], r["target"], r["copies"])
               for r in got.values() if r["size"]], 1)
    again = {r["doc_id"]: r["copies"] for r in mix_sources(docs.repartition(7)).collect()}
    assert again == {i: r["copies"] for i, r in got.items()}
    assert mix_sources(docs.limit(0)).collect() == []


def test_repeated_rows_get_equal_copies(spark):
    docs = docs_frame(spark, ["a b c d"] * 9 + ["e f"] * 9, ids=[7] * 9 + list(range(100, 109)), extra=False)
    got = mix_sources(docs).where("doc_id = 7").select("copies").distinct().collect()
    assert len(got) == 1


def test_document_weights(spark):
    docs = docs_frame(spark, ["a b"] * 200, extra=False).selectExpr(
        "*", "CASE WHEN doc_id = 0 THEN NULL WHEN doc_id = 1 THEN -3.0 WHEN doc_id < 100 THEN 1.0 ELSE 4.0 END AS q")
    rows = mix_sources(docs, share=0.8, doc_weight="q").collect()
    copies = {r["doc_id"]: r["copies"] for r in rows}
    assert copies[0] == copies[1] == 0 and max(copies.values()) <= 2
    assert abs(2 * sum(copies.values()) - rows[0]["target"]) <= 2
    light, heavy = (sum(copies[i] for i in r) / len(r) for r in (range(2, 100), range(100, 200)))
    assert heavy > 2.5 * light
