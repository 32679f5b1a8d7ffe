"""Leaves by shape equal the walk of each text, whichever of the two ways a text takes."""

import json

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from labelqa.operators import leaves, shapes

TEXTS = [
    '{"a": 1, "b": {"c": [1, 2.50, null, true, false, "x"], "d": {}}, "e": []}',
    '{"a":1,"b":2,"a":3}', '{"a":{"x":1},"a":{"y":2}}', '{"a":{"x":1},"a":7,"b":[]}', '{"a.b":1,"a":{"b":2}}',
    '{"a": -0, "b": -0.0, "c": 1.0, "d": 100, "e": 0.0001, "f": 0.00001, "g": 1e5, "h": 12345678901234567890123}',
    '{"a": 0.1000, "b": 123456789.123456, "c": 1234567890.1, "d": 10.10, "e": 0.00012300}',
    '{"a": NaN, "b": Infinity, "c": -Infinity}', '{"a": "\\u00e9", "b": "\\ud83d\\ude00"}',
    '{"a": "q\\"uo\\\\te\\/\\n\\t", "k\\"ey": "#", "c": " # "}', '{"# ": "#", "x": ":", "y": "a\\": 1"}',
    '{"a": "line\nbreak"}', '{"a": "tab\there", "b": "x"}', '{"a": "bad \\x", "b": "y"}', '{"a": "open', '"abc\\"', '{"a": "x" "y"}',
    "{'a': 1}", '{"a": 01}', '{"a": 1.}', '{"a": .5}', '{"a": --1}', '{"a": +1}', '{"a": 1 2}', '{"a" 1}', '{"a": tru}', '{"a":1,}',
    '{"a": "\\ud83d", "b\\udc00": 1}', '[1, [2, [3]], {"a": []}]', "[]", "{}", "5", '"text"', "null", "", " ", "﻿{}", '{"é": "ü😀", "": 1, "n": {"": 2}}',
    '  {"a" :\t1 ,\n"b": [ ] }', '{"a": 1} ', '["a":1]', '{"a":{"b":1}', "[" * 30 + "]" * 30, '{"v": "' + "x" * 100_000 + '"}',
]


def _both(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    got = shapes.read(df, {"j": "r"}, **kw).select("i", "r").orderBy("i").collect()
    want = df.select("i", leaves.json_read("j").alias("r")).orderBy("i").collect()
    return got, want


def test_traps_equal_the_walk(spark):
    got, want = _both(spark, TEXTS + [None, "[" * 100_000, TEXTS[0]])
    for g, w in zip(got, want, strict=True):
        assert g == w, TEXTS[g["i"]] if g["i"] < len(TEXTS) else g["i"]


def test_without_a_dictionary_and_with_a_small_one(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "j string")
    for known in (shapes.learn(df, ["j"], most=1), shapes.learn(df.where("false"), ["j"])):
        got, want = _both(spark, TEXTS, shapes=known)
        assert got == want


def test_common_documents_do_not_need_python(spark):
    texts = [json.dumps({"n": i, "s": f"t{i}", "d": {"x": i / 4, "l": [i, None]}}) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    known = shapes.learn(df, ["j"])
    assert known.count() == 1
    assert [tuple(s) for s in known.first()["spots"]] == [("n", 0), ("s", 1), ("d.x", 2), ("d.l[0]", 3), ("d.l[1]", 4)]
    from pyspark.sql import functions as F
    assert df.where(~F.forall(shapes.scalars("j"), shapes._plain)).count() == 0


def test_two_columns_and_rows(spark):
    df = spark.createDataFrame([(1, '{"a": 1}', '{"b": "x"}'), (2, None, "{"), (3, '{"a": 2}', '{"b": null}')], "i int, e string, a string")
    out = {r["i"]: r for r in shapes.read(df, {"e": "x", "a": "y"}).collect()}
    assert set(out[1].asDict()) == {"i", "e", "a", "x", "y"}
    assert out[1]["x"]["leaves"][0]["value"] == "1" and out[3]["y"]["leaves"][0]["kind"] == "null"
    assert out[2]["x"] == (None, None) and out[2]["y"]["issue"] == "invalid_json"
    for c in ("e", "a"):
        rows = sorted(map(tuple, shapes.leaf_rows(df, ["i"], c).collect()), key=repr)
        assert rows == sorted(map(tuple, leaves.json_leaf_rows(df, ["i"], c).collect()), key=repr)


def test_many_escapes_do_not_overflow(spark):
    texts = ['{"a": "' + '\\n' * 300_000 + '"}', '{"b": "' + "\\\\" * 300_000 + '", "c": ' + "9" * 5000 + "}"]
    got, want = _both(spark, texts)
    assert got == want


_json = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text(st.characters(codec="utf-8"), max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(st.characters(codec="utf-8"), max_size=3), inner, max_size=3), max_leaves=8)


@settings(max_examples=15, deadline=None, database=None, phases=[Phase.generate])    # shrinking would start Spark jobs for minutes
@given(st.lists(st.tuples(_json, st.booleans(), st.integers(0, 40)), min_size=20, max_size=40))
def test_random_texts(spark, drawn):
    texts = [json.dumps(v, ensure_ascii=a) for v, a, _ in drawn]
    texts += [t[:k] + t[k + 1:] for t, (_, _, k) in zip(texts, drawn, strict=True)]    # one character lost
    got, want = _both(spark, texts)
    assert got == want


@pytest.mark.parametrize("form", ['{"a": # ', '" # ', "{ # : # }"])
def test_shapes_that_cannot_be_read(form):
    assert shapes.spots_of(form) is None
