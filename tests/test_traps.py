"""Semantic traps as tests."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelqa.functions.render import py_double
from labelqa.functions.similarity import fixed2
from labelqa.operators import leaves


def test_t2_two_decimals_like_python(spark):
    random.seed(3)
    vals = [90.625, 0.125, 2.675, 79.995, 100.0, 0.0] + [random.uniform(0, 100) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(fixed2("x")).collect()]
    assert got == [f"{v:.2f}" for v in vals]


def test_t4_python_float_text_fixed_cases(spark):
    vals = [1e22, 1e16, 1e15, 10000000.0, 1234567.0, 0.0001, 0.00001, 1.5e-7, -0.0, 0.0,
            12345678.9, 1e-3, 123456789012345.6, -2.5e-10, 1.7976931348623157e308, 2.5e-300]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(py_double("x")).collect()]
    assert got == [str(v) for v in vals]
    # JDK 17 prints the smallest subnormal as 4.9E-324 (not shortest): same double
    tiny = spark.createDataFrame([(5e-324,)], "x double").select(py_double("x")).collect()[0][0]
    assert tiny == "4.9e-324" and float(tiny) == 5e-324


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=50))
def test_t4_python_float_text_property(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(py_double("x")).collect()]
    # JDK 17's Double.toString is not always the shortest digit string; allow
    # those rare values to differ only when the digits parse to the same double
    for g, v in zip(got, vals):
        assert g == str(v) or float(g) == v


def test_t26_null_struct_vs_struct_of_nulls(spark):
    schema = T.StructType([T.StructField("density", T.StructType([
        T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType())]))])
    df = spark.createDataFrame([(None,), ((None, None),)], schema)
    got = [[x.path for x in r[0]] for r in
           df.select(leaves.typed_leaves(F.struct("density"), schema)).collect()]
    assert got == [["density"], ["density.value", "density.unit"]]


def test_t5_empty_list_has_no_leaf(spark):
    df = spark.createDataFrame([('{"a": null, "b": []}',)], "j string")
    got = [(x.path, x.kind) for x in df.select(leaves.json_leaves("j")).collect()[0][0]]
    assert got == [("a", "null")]


def test_t13_unicode_word_boundary(spark):
    from labelqa.operators.scoring import word_pattern
    df = spark.createDataFrame([("éminimum",), ("un minimum",), ("the_end",), ("the end",)], "t string")
    got = [r[0] for r in df.select(F.col("t").rlike(word_pattern("minimum")),
                                   ).collect()]
    assert got == [False, True, False, False]
    got = [r[0] for r in df.select(F.col("t").rlike(word_pattern("the"))).collect()]
    assert got == [False, False, False, True]


def test_one_pass_word_presence_equals_per_word(spark):
    from labelqa.operators.scoring import patterns_present, word_pattern
    words = ["the", "there", "25", "New York", "é", "a_b"]
    texts = ["the the", "there", "éthe", "the_end", "THE", "x 25.", "New York", "New  York",
             "é!", "a_b c", "", None, "therethe there", "25x 25"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    one = df.select(patterns_present(F.col("t"), words).alias("f")).collect()
    per = df.select(F.array(*[F.col("t").rlike(word_pattern(w)) for w in words]).alias("f")).collect()
    assert [r.f for r in one] == [r.f for r in per]


def test_t9_sentinel_text_is_a_real_value(spark):
    from labelqa.operators import scoring
    e = spark.createDataFrame([(1, 0, "a", "FIELD_NOT_FOUND", "str")],
                              "case_no int, pos int, path string, value string, kind string")
    a = spark.createDataFrame([(1, "a", "FIELD_NOT_FOUND", "str")],
                              "case_no int, path string, value string, kind string")
    r = scoring.score_leaves(e, a, ["case_no"]).collect()[0]
    assert r.hit and r.score == 100.0 and r.pass_fail == "Pass"


def test_t12_dollar_accepts_one_trailing_newline(spark):
    from labelqa.functions import rules
    df = spark.createDataFrame([("1234567A\n",), ("10-5-20\n",), ("1234567A\n\n",)], "v string")
    got = df.select(rules.registration_id("v").alias("r"), rules.grade("v").alias("g")).collect()
    assert got[0].r == "1234567A\n" and got[1].g == "10-5-20\n" and got[2].r is None


def test_t20_non_string_website_rejects_record(spark):
    import json
    from labelqa.operators import standardize as S
    df = spark.createDataFrame([(1, json.dumps({"organizations": [{"website": 12, "phone_number": 5}]}))],
                               "id long, raw string")
    r = S.standardize(df, "raw", ["id"]).collect()[0]
    assert r.record is None
    assert sorted((x.loc, x.kind) for x in r._issues) == [
        ("organizations[0].phone_number", "string_type"), ("organizations[0].website", "string_type")]
