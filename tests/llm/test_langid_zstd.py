import random
import string

import duckdb
import pytest

from tests.llm.helpers import docs_frame
from tierflow.llm.langid_zstd import MAX_LANGS, MIN_MARGIN, Classifier, held_out, identify, learn, normalized
from tierflow.llm.queries import QUERIES

EN = "the quick brown fox jumps over the lazy dog and then it goes home to sleep by the fire "
DE = "der schnelle braune fuchs springt über den faulen hund und geht dann nach hause um zu schlafen "


def test_held_out_accuracy(spark):
    labels = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(labels)
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and labels[r["doc_id"]] is not None and r["lang_pred"] != "und"]
    assert len(held) > 50
    assert sum(r["lang_pred"] == labels[r["doc_id"]] for r in held) / len(held) >= 0.97


def test_normalized():
    assert normalized("Ein  TAG, 12_3 x") == b" ein tag x "
    assert normalized("12 -- _") == normalized("") == b""


def test_edge_rows(spark):
    texts = [EN * 2, DE * 2, None, "", "123 -- !", EN * 3, DE * 3, EN * 3, "The " + EN * 4000]
    langs = ["en", "de", "en", None, "de", None, None, None, None]
    docs = docs_frame(spark, texts, langs=langs)
    dictionaries = learn(docs)
    assert sorted(dictionaries) == ["de", "en"]
    out = identify(docs, dictionaries)
    assert out.columns == docs.columns + ["lang_pred", "score", "rejected"]
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in out.collect()}
    assert got[2] == got[3] == got[4] == ("und", True)
    assert got[5] == got[7] == got[8] == ("en", False) and got[6] == ("de", False)
    assert identify(docs.limit(0), dictionaries).collect() == [] and learn(docs.limit(0)) == {}
    assert {r["lang_pred"] for r in identify(docs, {}).collect()} == {"und"}


def test_narrow_margins_are_rejected():
    same = Classifier({"a": normalized(EN), "b": normalized(EN)})
    lang, score, rejected = same.predict(EN, 1)
    assert (lang, rejected) == ("a", True) and abs(score - 0.5) < 1e-9
    both = Classifier({"en": normalized(EN), "de": normalized(DE)})
    assert both.predict(EN, 1)[2] is False and both.predict(EN, 10_000)[2] is True


def test_number_of_languages_is_bounded(spark):
    rows = spark.range(MAX_LANGS + 1).selectExpr("concat('l', id) AS lang", "'some text' AS text")
    with pytest.raises(ValueError):
        learn(rows)


def test_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").withColumn(
        "held_out", held_out())
    learned = Classifier(learn(docs.where("not held_out and lang in ('de', 'en', 'es')")))
    rows = docs.where("held_out").select("text", "lang").collect()
    rejected = lambda rs: [learned.predict(r["text"], MIN_MARGIN)[2] for r in rs]
    foreign = rejected([r for r in rows if r["lang"] == "fr" and len(r["text"]) > 400])
    clean = rejected([r for r in rows if r["lang"] != "fr" and len(r["text"]) > 100])
    assert len(foreign) > 20 and sum(foreign) / len(foreign) >= 0.85
    assert len(clean) > 100 and sum(clean) / len(clean) <= 0.01


def test_noise_is_rejected_at_any_length():
    both = Classifier({"en": normalized(EN * 3), "de": normalized(DE * 3)})
    draw = random.Random(5)
    for n in (30, 300, 3000, 100_000):
        noise = "".join(draw.choice(string.ascii_lowercase + "  ") for _ in range(n))
        assert both.predict(noise, MIN_MARGIN)[2]
    assert not both.predict("und geht dann nach hause", MIN_MARGIN)[2]
