"""Property check: the Spark number parsers against a plain-Python model of the
JavaScript rules, on random texts (one DataFrame per batch, no UDF)."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopfold.functions.values import parse_money, parse_qty

ALPHABET = "0123456789.-+eE ,xl"

# parseFloat reads the longest prefix that is a decimal literal.
_JS_FLOAT = re.compile(r"[+-]?(Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)")


def js_parse_float(text: str) -> float:
    m = _JS_FLOAT.match(text.lstrip(" \t\n\r\v\f"))
    if not m:
        return math.nan
    lit = m.group(0)
    if lit.endswith("Infinity"):
        return -math.inf if lit.startswith("-") else math.inf
    return float(lit)


def js_or_zero(x: float) -> float:
    return 0.0 if (math.isnan(x) or x == 0) else x


def model_money(text: str) -> float:
    return js_or_zero(js_parse_float(re.sub(r"[^0-9.\-]+", "", text)))


def model_qty(text: str) -> float:
    return js_or_zero(js_parse_float(text))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=50, max_size=80))
def test_parsers_match_js_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", parse_money(F.col("t")).alias("m"), parse_qty(F.col("t")).alias("q"))
    for r in got.collect():
        assert r.m == model_money(r.t), (r.t, r.m)
        assert r.q == model_qty(r.t), (r.t, r.q)
