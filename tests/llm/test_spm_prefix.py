import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece

from tests.llm.helpers import docs_frame
from tierflow.llm.queries import QUERIES
from tierflow.llm.spm_prefix import PrefixEncoder, encode_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op6_sentencepiece"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        ids = library.encode(text or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_random_texts_equal_the_library(library):
    rng = random.Random(3)
    encoder = PrefixEncoder(MODEL)
    parts = ["the", "ing", "un", "ab", "aaa", "zz", " ", "  ", "\n", "\t", "\r\n", "▁", "é", "ß", "字", "字典", "🙂", "́",
             "​", "\x00", "0x1F", "!!", "...", "ſ", "ﬁ", "<s>", "</s>", "<unk>", "<0x41>"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        ids = library.encode(text)
        assert encoder.encode(text).tolist() == ids, repr(text)
        assert encoder.decode(ids) == library.decode(ids), repr(text)


def test_edge_rows(spark, library):
    texts = [None, "", " ", "a", "a", "word " * 60_000, "x" * 3000, "  tail"]
    docs = docs_frame(spark, texts).selectExpr("*", "'clash' AS ids", "doc_id AS c0")
    out = encode_texts(docs, MODEL, ("ids", "decoded", "n_tokens"))
    assert out.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded", "n_tokens"]
    for r in out.collect():
        want = library.encode(texts[r["doc_id"]] or "")
        assert list(r["ids"]) == want and r["n_tokens"] == len(want) and r["decoded"] == library.decode(want)
    assert encode_texts(docs.limit(0), MODEL).collect() == []
