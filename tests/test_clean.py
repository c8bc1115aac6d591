"""Unit tests for the scalar functions (K1-K15, C7) and their traps."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from tierflow.functions import clean as K


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_norm_lower_strips_spaces_only(spark):
    out = one(spark, K.norm_lower("s"), [(" Click ",), ("\tClick",), (None,)], "s string")
    assert out == ["click", "\tclick", None]


def test_collapse_slashes_and_http_trap(spark):
    out = one(spark, K.collapse_slashes("s"),
              [("//a///b",), (" /x?next=http://h//p ",), ("/",), (None,)], "s string")
    assert out == ["/a/b", "/x?next=http:/h/p", "/", None]


def test_parse_instant_any_zone(spark):
    rows = [("2025-09-04T09:30:00Z",), ("garbage",), (None,)]
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out = one(spark, K.parse_instant("s"), rows, "s string")
            assert out == [dt.datetime(2025, 9, 4, 9, 30), None, None], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_to_utc_ntz_is_noop_on_ntz_and_lenient_on_text(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "junk", "2024-01-02T05:04:05+02:00",
                                 "2024-01-02", "2024-01-02 03:04:05Z")],
                               "a string, b string, z string, d string, zz string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("ntz"), "a", "b", "z", "d", "zz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = df.select(*[K.to_utc_ntz(df, c) for c in ("ntz", "a", "b", "z", "d", "zz")]).first()
            assert r[0] == r[1] == r[3] == r[5] == dt.datetime(2024, 1, 2, 3, 4, 5), tz
            assert r[2] is None
            assert r[4] == dt.datetime(2024, 1, 2), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_first_time(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(None, t), (None, None)], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(K.first_time(F.col("a"), F.col("b"))).collect()] == [t, None]


def test_struct_to_json_omits_nulls(spark):
    df = spark.createDataFrame([(("x", None),), (None,)], "m struct<a:string,b:string>")
    assert [r[0] for r in df.select(K.struct_to_json("m")).collect()] == ['{"a":"x"}', None]


def test_json_paths_edge_documents(spark):
    docs = [(None,), ("{}",), ('{"browser":null}',), ('{"browser":{"a":1}}',),
            ("not json",), ('{"browser":"chrome","os":"ios"}',), ('{"browser":5}',)]
    df = spark.createDataFrame(docs, "j string")
    for once in (True, False):
        out = [tuple(r) for r in K.with_json_fields(df, "j", ("browser", "os"), parse_once=once)
               .select("browser", "os").collect()]
        assert out == [(None, None), (None, None), (None, None), ('{"a":1}', None),
                       (None, None), ("chrome", "ios"), ("5", None)], once
    assert [tuple(r) for r in df.select(*K.json_paths("j", ("browser", "os"))).collect()] == out


def test_json_parsed_once_in_plan(spark):
    df = spark.createDataFrame([('{"browser":"x"}',)], "j string")
    plan = K.with_json_fields(df, "j")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_typed_null_and_business_key(spark):
    df = spark.range(1).select(K.typed_null("string").alias("c"), K.business_key(F.lit(42)).alias("k"))
    assert df.schema["c"].dataType.simpleString() == "string"
    assert df.first()["k"] == "42"


def test_date_key_and_day(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 9, 4, 23, 59),), (None,)], "t timestamp_ntz")
    out = df.select(K.date_key("t"), K.to_day("t"), F.date_format("t", "yyyyMMdd").cast("int")).collect()
    assert tuple(out[0]) == (20250904, dt.date(2025, 9, 4), 20250904)
    assert tuple(out[1]) == (None, None, None)


def test_placeholder_count(spark):
    df = spark.createDataFrame([(decimal.Decimal("1.50"),), (None,), (decimal.Decimal("0.00"),)],
                               "a decimal(12,2)")
    assert [r[0] for r in df.select(K.placeholder_count("a")).collect()] == [1, None, 1]


def test_load_stamp(spark):
    r = spark.range(1).select(K.load_stamp("2025-01-01 00:00:00"), K.load_stamp()).first()
    assert r[0] == dt.datetime(2025, 1, 1)
    assert isinstance(r[1], dt.datetime)


def test_col_or_null_keeps_type(spark):
    df = spark.createDataFrame([(1,)], "a bigint")
    out = df.select(K.col_or_null(df, "a", "bigint").alias("a"),
                    K.col_or_null(df, "missing", "decimal(18,2)").alias("m"))
    assert out.schema["m"].dataType.simpleString() == "decimal(18,2)"
    assert tuple(out.first()) == (1, None)
