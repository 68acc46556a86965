"""Golden cases of the dynamic-value rules."""

import datetime as dt

from pyspark.sql import functions as F

from shopfold.functions.numeric import js_round2
from shopfold.functions.text import (format_duration, relative_time, slugify, truncate_sample,
                                     unmapped_label)
from shopfold.functions.values import parse_money, parse_qty, resolve_texts


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).collect()[0]["r"]


def test_parse_money_cases(spark):
    cases = {"1.234,56 lei": 1.23456, "--5": 0.0, "1e5": 15.0, "12-3": 12.0, "299.90": 299.9,
             "": 0.0, "abc": 0.0, "-0": 0.0, ".5": 0.5, "RON -7.25": -7.25}
    for text, want in cases.items():
        assert one(spark, parse_money(F.col("x")), text) == want, text


def test_parse_qty_cases(spark):
    cases = {"1,5": 1.0, " 2 kg": 2.0, "1e2": 100.0, "x3": 0.0, "+4": 4.0, "-0": 0.0,
             "Infinity": float("inf")}
    for text, want in cases.items():
        assert one(spark, parse_qty(F.col("x")), text) == want, text


def test_js_round2_is_floor_half_up(spark):
    assert one(spark, js_round2(F.col("x")), 1.005, "x double") == 1.0
    assert one(spark, js_round2(F.col("x")), -2.5 / 100, "x double") == -0.02
    assert one(spark, js_round2(F.col("x")), 1.234, "x double") == 1.23
    assert one(spark, js_round2(F.col("x")), 1e300, "x double") == 1e300


def test_first_truthy_text(spark):
    docs = ['{"a": 0, "b": "0"}', '{"a": "", "b": 7}', '{"a": false, "b": null}',
            '{"a": 1.50, "b": 2}', '{"a": {"k": 1}}', '{"a": [], "b": 3}']
    df = spark.createDataFrame([(d,) for d in docs], "d string").select(
        F.monotonically_increasing_id().alias("i"), F.parse_json("d").alias("v"))
    out = resolve_texts(df, {"t": (["variant_get(v, '$.a', 'variant')",
                                    "variant_get(v, '$.b', 'variant')"], "dflt")})
    got = [r["t"] for r in out.orderBy("i").collect()]
    assert got == ["0", "7", "dflt", "1.5", '{"k":1}', "[]"]


def test_labels(spark):
    assert one(spark, slugify(F.col("x")), "  Mega Shop!! RO ") == "mega-shop-ro"
    assert one(spark, format_duration(F.col("x")), 59, "x long") == "59s"
    assert one(spark, format_duration(F.col("x")), 125, "x long") == "2m 5s"
    assert one(spark, truncate_sample(F.col("x")), None) == "—"
    assert one(spark, truncate_sample(F.col("x")), "a" * 61) == "a" * 57 + "…"
    assert one(spark, truncate_sample(F.col("x")), "a" * 60) == "a" * 60
    assert one(spark, unmapped_label(F.col("x")), "weird") == "[UNMAPPED] weird"
    as_of = F.lit(dt.datetime(2024, 1, 2, 12, 0, 0))
    for ts, want in [(dt.datetime(2024, 1, 2, 11, 59, 30), "just now"),
                     (dt.datetime(2024, 1, 2, 11, 15, 0), "45m ago"),
                     (dt.datetime(2024, 1, 2, 1, 0, 0), "11h ago"),
                     (dt.datetime(2023, 12, 1, 1, 0, 0), "01.12.2023")]:
        assert one(spark, relative_time(F.col("x"), as_of), ts, "x timestamp") == want
