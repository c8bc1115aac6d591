import hashlib
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline as pipeline
from tests.llm.helpers import cut_words, docs_frame, near_classes, words
from tests.llm.test_mixing import brute_targets
from tierflow.llm.langid_zstd import Classifier, learn
from tierflow.llm.stages import staged
from tierflow.session import scratch_path

DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_stages_match_brute_force(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    language, near, cut, mix, tokens = (f for _, f in pipeline.STAGES)

    rows = docs.collect()
    classifier = Classifier(learn(docs))
    found = {r["doc_id"]: classifier.predict(r["text"], 1) for r in rows}
    docs = staged(language(spark, docs, sf_dir), "t-language")
    assert docs.columns == names
    assert {r["doc_id"]: r["lang"] for r in docs.collect()} == {i: f[0] for i, f in found.items() if not f[2]}

    rows = docs.collect()
    ids = [r["doc_id"] for r in rows]
    classes = near_classes([r["text"] for r in rows], ids)
    docs = staged(near(spark, docs, sf_dir), "t-near")
    assert docs.columns == names
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(set(classes))

    want = cut_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    docs = staged(cut(spark, docs, sf_dir), "t-cut")
    assert docs.columns == names
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()} == {
        i: (t, len(t)) for i, (_, _, t) in want.items() if t}

    rows = docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    docs = staged(mix(spark, docs, sf_dir), "t-mix")
    assert docs.columns == names
    copies = Counter(r["doc_id"] for r in docs.collect())
    assert max(copies.values()) <= 2 and set(copies) <= {r["doc_id"] for r in rows}
    for source, target in brute_targets(sizes).items():
        own = [r for r in rows if r["source"] == source]
        taken = sum(copies[r["doc_id"]] * len(words(r["text"])) for r in own)
        assert abs(taken - target) <= max(len(words(r["text"])) for r in own)

    library = sentencepiece.SentencePieceProcessor(model_file=pipeline.MODEL)
    out = tokens(spark, docs, sf_dir).collect()
    assert Counter(r["doc_id"] for r in out) == copies
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out:
        ids = library.encode(texts[r["doc_id"]])
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run_with_edge_rows(spark):
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    texts = ["good morning to all of you " * 3, None, "", "12 34", long, "a short one", "a short one", "good evening"]
    root = scratch_path(spark, "t-pipeline")
    docs = docs_frame(spark, texts, ids=[1, 2, 3, None, 5, 6, 6, 8], sources=["s", None, "s", "t", None, "s", "s", "t"])
    docs.write.parquet(f"{root}/documents.parquet")
    out = pipeline.run(spark, root)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]
    rows = out.collect()
    assert {r["doc_id"] for r in rows} <= {1, 5, 6, 8}
    copies = Counter(r["doc_id"] for r in rows)
    assert copies[5] >= 1 and copies[6] <= 2  # one of the two rows of id 6 stays


def test_run_on_an_empty_table(spark):
    root = scratch_path(spark, "t-pipeline-empty")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{root}/documents.parquet")
    assert pipeline.run(spark, root).collect() == []
