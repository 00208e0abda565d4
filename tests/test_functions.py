"""The shared expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow import functions as sf


def test_half_even_and_midpoint(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (3.5,), (-2.5,), (12.5,), (5.5,)], "x double")
    rounded = df.select(F.expr(sf.half_even_sql("x")))
    assert [r[0] for r in rounded.collect()] == [0, 2, 2, 4, -2, 12, 6]
    assert rounded.schema.fields[0].dataType.simpleString() == "bigint"
    kept = df.select(F.expr(sf.half_even_value_sql("CAST(x AS BIGINT)")))
    assert kept.schema.fields[0].dataType.simpleString() == "bigint"
    pair = spark.createDataFrame([(11, 39), (11, None)], "a bigint, b bigint")
    assert [r[0] for r in pair.select(F.expr(sf.midpoint_sql("a", "b"))).collect()] == [25.0, None]


def test_month_label(spark):
    df = spark.createDataFrame([("201801_usage.json",), ("2018",)], "f string")
    assert [r[0] for r in df.select(sf.month_label("f")).collect()] == ["201801", "2018"]
    assert [r[0] for r in df.select(F.expr(sf.month_label_sql("f"))).collect()] == ["201801", "2018"]


def test_file_identity_and_name(spark):
    paths = [
        ("file:/a/201801_usage.json", "file:/a/201801_usage.json", "201801_usage.json"),
        ("file:/a%20b/x+y%2Bz.json", "file:/a b/x+y+z.json", "x+y+z.json"),
        ("s3://k/file=201801_usage.json/part-0.json", "s3://k/file=201801_usage.json", "201801_usage.json"),
        ("file:/d/file=a%253Ab/part-0.json", "file:/d/file=a:b", "a:b"),
        ("199801", "199801", "199801"),
    ]
    df = spark.createDataFrame([(p,) for p, *_ in paths], "p string")
    got = df.selectExpr(f"{sf.file_key_sql('p')} AS f").selectExpr("f", sf.file_name_sql("f"))
    assert [tuple(r) for r in got.collect()] == [tuple(x[1:]) for x in paths]
