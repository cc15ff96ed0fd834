import datetime as dt
from decimal import Decimal

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import (
    as_type,
    cast_columns,
    code_description,
    decode_json,
    encode_json,
    hours,
    replace_text,
    surrogate_key,
    truncate,
)
from tripflow.schemas import PAYMENT_DESCRIPTIONS


def test_truncate_returns_zone_less_starts(spark):
    df = spark.createDataFrame([(ts("2020-02-29 13:45:10.5"),), (None,)], "t timestamp_ntz")
    out = df.select(truncate("hour", "t").alias("h"), truncate("month", "t").alias("m"))
    assert [f.dataType for f in out.schema] == [T.TimestampNTZType()] * 2
    assert set(rows(out)) == {(None, None), (ts("2020-02-29 13:00:00"), ts("2020-02-01 00:00:00"))}


def test_hours_keeps_fractions_and_nulls(spark):
    df = spark.createDataFrame([(5400,), (None,)], "s int")
    assert set(rows(df.select(hours("s")))) == {(1.5,), (None,)}
    assert set(rows(df.select(hours(F.col("s") * 2)))) == {(3.0,), (None,)}


def test_replace_is_literal(spark):
    df = spark.createDataFrame([("Boro Zone",), ("B.ro",), (None,)], "z string")
    assert set(rows(df.select(replace_text("z", "Boro", "Green")))) == {
        ("Green Zone",),
        ("B.ro",),
        (None,),
    }


def test_surrogate_key_counts_null_as_empty(spark):
    import hashlib

    df = spark.createDataFrame([(1, "a"), (None, "a"), (None, None)], "v int, p string")
    expected = {hashlib.md5(t.encode()).hexdigest() for t in ("1-a", "-a", "-")}
    assert {r[0] for r in df.select(surrogate_key("v", "p")).collect()} == expected


def test_code_description_is_null_for_other_codes(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 6, 7, None)], "c int")
    got = dict(rows(df.select("c", code_description("c", PAYMENT_DESCRIPTIONS))))
    assert got == {0: None, 1: "Credit card", 6: "Voided trip", 7: None, None: None}


@pytest.mark.parametrize("value, expected", [(2.7, 3), (2.5, 2), (3.5, 4), (-1.6, -2), (None, None)])
def test_integer_cast_rounds_half_even(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(as_type(F.col("x"), T.DoubleType(), T.IntegerType())).first()[0] == expected


def test_lenient_cast_gives_null_where_strict_raises(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "7")], "n double, s string")
    types = {"n": T.IntegerType(), "s": T.IntegerType()}
    assert set(rows(cast_columns(df, types, strict=False))) == {(None, None), (1, 7)}
    with pytest.raises(Exception):
        cast_columns(df, types).collect()


def test_decimal_cast_keeps_cents(spark):
    df = spark.createDataFrame([(12.5678,)], "x double")
    out = cast_columns(df, {"x": T.DecimalType(18, 2)})
    assert out.first()[0] == Decimal("12.57")


def test_json_both_ways_and_malformed(spark):
    schema = T.StructType([T.StructField("number", T.LongType())])
    df = spark.createDataFrame([(1,), (None,)], "number long")
    texts = [r[0] for r in df.select(encode_json("number")).collect()]
    assert sorted(texts) == ['{"number":1}', "{}"]
    raw = spark.createDataFrame([('{"number":1}',), ("{}",), ("{oops",)], "v string")
    got = {tuple(r[0]) for r in raw.select(decode_json("v", schema)).collect()}
    assert got == {(1, None), (None, None), (None, "{oops")}


def test_date_of_timestamp(spark):
    df = spark.createDataFrame([(ts("2020-01-31 23:59:59"),)], "t timestamp_ntz")
    assert df.select(F.to_date("t")).first()[0] == dt.date(2020, 1, 31)
