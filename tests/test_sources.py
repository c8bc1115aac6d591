"""JSON lines round trip and JDBC option building (no database is started)."""

import json

import pytest
from pyspark.sql import functions as F

from tierflow.plans import bronze
from tierflow.sources import jdbc, jsonl
from tierflow.sources import testdata as td
from tierflow.session import scratch_path

from tests.conftest import SF001


def test_jsonl_round_trip(spark):
    raw = td.raw_clicks(spark, SF001).drop("_ingested_at")
    path = scratch_path(spark, "t-jsonl")
    jsonl.write_lines(raw, path)
    back = jsonl.read_clicks(spark, path)
    assert not any(r._malformed for r in back.collect())
    back = back.drop("_malformed").withColumn("metadata", F.from_json("metadata", raw.schema["metadata"].dataType))
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_jdbc_options():
    conn = {"url": "jdbc:x://h/db", "user": "u", "password": "p"}
    r = jdbc.read_options(conn, "orders", partition_column="order_id", lower_bound=0,
                          upper_bound=1000, num_partitions=8)
    assert r["numPartitions"] == "8" and r["partitionColumn"] == "order_id"
    with pytest.raises(ValueError):
        jdbc.read_options(conn, "orders", partition_column="order_id")
    w = jdbc.write_options(conn, "orders", mode="overwrite")
    assert w["truncate"] == "true" and w["batchsize"] == "10000"


def test_jdbc_credentials_from_env(monkeypatch):
    monkeypatch.setenv("JDBC_URL", "jdbc:x://h/db")
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.delenv("JDBC_PASSWORD", raising=False)
    with pytest.raises(KeyError):
        jdbc.connection()


def test_jdbc_refuses_nested_columns(spark):
    raw = td.raw_clicks(spark, SF001)          # has the metadata struct
    with pytest.raises(ValueError, match="metadata"):
        jdbc.write(raw, {"url": "jdbc:none:", "user": "u", "password": "p"}, "t")
    jdbc.check_writable(raw.drop("metadata"))  # flat frames pass


def test_malformed_json_line_keeps_a_null_row(spark):
    path = scratch_path(spark, "t-bad-json")
    spark.createDataFrame([('{"event_id":"e1","user_id":1,"ts":"2025-09-04T09:30:00Z"}',),
                           ('{"event_id": broken',)], "value string") \
        .write.text(path)
    rows = jsonl.read_clicks(spark, path).collect()
    assert len(rows) == 2
    assert sorted((r.event_id is None) for r in rows) == [False, True]
    assert [r._malformed for r in rows if r.event_id is None] == ['{"event_id": broken']


def test_metadata_is_open_and_lines_keep_their_text(spark):
    path = scratch_path(spark, "t-open-json")
    lines = ['{"event_id":"e1","metadata":{"plan":"gold","k":"abc","n":{"x":[1,2.50]}}}',
             '{"event_id":"e2","user_id":"no number","metadata":{"os":"linux"}}', 'no json "at" all',
             '{"event_id":"e3","metadata":{}}', '{"event_id":"e4"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {r["event_id"]: r["metadata_json"] for r in bronze.clicks(jsonl.read_clicks(spark, path)).collect()}
    assert got["e1"] == '{"plan":"gold","k":"abc","n":{"x":[1,2.50]}}' and got["e3"] == "{}" and got["e4"] is None
    assert json.loads(got["e2"]) == {"_malformed": lines[1], "os": "linux"}
    assert json.loads(got[None]) == {"_malformed": lines[2]}
