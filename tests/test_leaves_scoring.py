"""Leaf flattening (typed and schema-less) and scoring."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelqa.operators import leaves, scoring


def json_leaf_map(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d) if not isinstance(d, str) else d)
                                for i, d in enumerate(docs)], "i int, j string")
    rows = df.select("i", leaves.json_leaves("j").alias("l")).orderBy("i").collect()
    return [None if r.l is None else [(x.pos, x.path, x.value, x.kind) for x in r.l] for r in rows]


def test_flatten_reference_cases(spark):
    docs = [
        {"company_name": "Nature's aid", "company_address": None},
        {"density": {"value": None, "unit": None}, "volume": {"value": 10, "unit": "liter"}},
        ["step 1", "step 2"],
        {"steps": ["a", "b"], "materials": ["soil"]},
        {"ga": {"title": "T", "nutrients": [{"nutrient": "N", "value": 8.5, "unit": "%"}]},
         "cautions_en": None},
    ]
    got = json_leaf_map(spark, docs)
    assert got[0] == [(0, "company_name", "Nature's aid", "str"), (1, "company_address", None, "null")]
    assert got[1] == [(0, "density.value", None, "null"), (1, "density.unit", None, "null"),
                      (2, "volume.value", "10", "int"), (3, "volume.unit", "liter", "str")]
    assert got[2] == [(0, "[0]", "step 1", "str"), (1, "[1]", "step 2", "str")]
    assert [p for _, p, _, _ in got[3]] == ["steps[0]", "steps[1]", "materials[0]"]
    assert got[4] == [(0, "ga.title", "T", "str"), (1, "ga.nutrients[0].nutrient", "N", "str"),
                      (2, "ga.nutrients[0].value", "8.5", "float"),
                      (3, "ga.nutrients[0].unit", "%", "str"), (4, "cautions_en", None, "null")]


def test_flatten_edge_cases(spark):
    got = json_leaf_map(spark, [
        {"a": {}, "b": [], "c": 1},          # empty containers yield nothing
        "5",                                  # scalar root yields nothing
        '{"a": 1, "a": 2}',                   # duplicate key: last value wins
        {"a.b": 1, "a": {"b": 2}},            # T21 colliding path: first position, last value
        {"x": True, "y": 1e22, "z": 10.0},    # Python str rendering
        "not json",
    ])
    assert got[0] == [(0, "c", "1", "int")]
    assert got[1] == []
    assert got[2] == [(0, "a", "2", "int")]
    assert got[3] == [(0, "a.b", "2", "int")]
    assert got[4] == [(0, "x", "True", "bool"), (1, "y", "1e+22", "float"), (2, "z", "10.0", "float")]
    assert got[5] is None


def test_typed_matches_schemaless(spark):
    schema = T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("w", T.ArrayType(T.StructType([T.StructField("value", T.DoubleType()),
                                                      T.StructField("unit", T.StringType())]))),
        T.StructField("d", T.StructType([T.StructField("value", T.DoubleType()),
                                         T.StructField("unit", T.StringType())])),
        T.StructField("ok", T.BooleanType()),
        T.StructField("n", T.LongType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ])
    rows = [("a", [(1.5, "kg"), (None, "lb")], None, True, 3, []),
            (None, None, (1e22, None), None, None, ["x", None]),
            ("b", [], (0.0001, "g"), False, -7, None),
            ("c", [(12345678.9, "t")], (-0.0, "x"), True, 0, ["y"])]
    df = spark.createDataFrame(rows, schema)
    typed = df.select(leaves.typed_leaves(F.struct(*df.columns), schema).alias("l")).collect()
    js = df.select(leaves.json_leaves(F.to_json(F.struct(*df.columns),
                                                {"ignoreNullFields": "false"})).alias("l")).collect()
    for a, b in zip(typed, js):
        assert [tuple(x) for x in a.l] == [tuple(x) for x in b.l]


def test_accuracy_reference_cases(spark):
    e = spark.createDataFrame([(1, 0, "field_1", "value_1", "str"), (1, 1, "field_2", "value_2", "str"),
                               (2, 0, "field_1", "value_1", "str"), (2, 1, "field_2", "value_2", "str"),
                               (3, 0, "field_1", "value_1", "str"), (3, 1, "field_2", "value_2", "str")],
                              "case_no int, pos int, path string, value string, kind string")
    a = spark.createDataFrame([(1, "field_1", "value_1", "str"), (1, "field_2", "value_2", "str"),
                               (2, "field_1", "wrong_value", "str"),
                               (2, "field_2", "another_wrong_value", "str"),
                               (3, "field_1", "value_1", "str"), (3, "extra", "x", "str")],
                              "case_no int, path string, value string, kind string")
    got = {(r.case_no, r.path): (r.score, r.pass_fail, r.hit)
           for r in scoring.score_leaves(e, a, ["case_no"]).collect()}
    assert got[(1, "field_1")] == (100.0, "Pass", True)
    assert int(got[(2, "field_1")][0]) == 27 and int(got[(2, "field_2")][0]) == 15
    assert got[(3, "field_2")] == (0.0, "Fail", False)
    assert (3, "extra") not in got


def test_score_records_and_threshold(spark):
    # 4/5 similar = exactly 80.0 passes; T3: 10 vs 10.0 fails
    df = spark.createDataFrame([(1, '{"a": "abcde", "b": 10, "c": null}', '{"a": "abcdX", "b": 10.0}')],
                               "case_no int, e string, a string")
    rec = df.select("case_no", leaves.json_leaves("e").alias("e"), leaves.json_leaves("a").alias("a"))
    got = {r.path: (r.score, r.pass_fail, r.hit) for r in
           scoring.score_records(rec, "e", "a", ["case_no"]).collect()}
    assert got["a"] == (80.0, "Pass", True)
    assert got["b"][1] == "Fail" and got["b"][0] == 50.0
    assert got["c"] == (0.0, "Fail", False)


def py_lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def py_similarity(a, b):
    a, b = a or "", b or ""
    m = max(len(a), len(b))
    return 100.0 if m == 0 else (1 - (py_lev(a, b) / m)) * 100


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=12)),
                          st.one_of(st.none(), st.text(max_size=12))), min_size=1, max_size=20))
def test_similarity_matches_python(spark, pairs):
    from labelqa.functions.similarity import similarity
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(similarity("a", "b")).collect()]
    want = [py_similarity(a, b) for a, b in pairs]
    assert got == want
    assert all(0.0 <= g <= 100.0 for g in got)


def test_leaf_rows_equal_leaf_arrays(spark):
    docs = ['{"a": {"b": [1, 2.5, null]}, "c": true}', "[1, [2, {\"x\": \"y\"}]]", "bad", None, "{}"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i long, j string")
    rows = sorted((tuple(r) for r in leaves.json_leaf_rows(df, ["i"], "j").collect()), key=repr)
    arr = sorted(tuple(r) for r in df.select("i", F.inline(leaves.json_leaves("j"))).collect())
    assert rows == sorted([*arr, (2, -1, None, "invalid_json", "error")], key=repr) and len(rows) == 8


REC = T.StructType([
    T.StructField("s", T.StringType()),
    T.StructField("d", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("b", T.BooleanType()),
    T.StructField("w", T.ArrayType(T.StructType([T.StructField("value", T.DoubleType()),
                                                  T.StructField("unit", T.StringType())]))),
    T.StructField("g", T.StructType([T.StructField("t", T.StringType()),
                                     T.StructField("l", T.ArrayType(T.StringType()))])),
])

_dbl = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64))
_txt = st.one_of(st.none(), st.text(max_size=6))
_row = st.tuples(
    _txt, _dbl, st.one_of(st.none(), st.integers(-2**62, 2**62)), st.one_of(st.none(), st.booleans()),
    st.one_of(st.none(), st.lists(st.one_of(st.none(), st.tuples(_dbl, _txt)), max_size=3)),
    st.one_of(st.none(), st.tuples(_txt, st.one_of(st.none(), st.lists(_txt, max_size=3)))),
)


@settings(max_examples=20, deadline=None)
@given(st.lists(_row, min_size=1, max_size=15))
def test_typed_flatten_property(spark, rows):
    """Catalyst flatten == Python walk of the same record's JSON."""
    df = spark.createDataFrame(rows, REC)
    typed = df.select(leaves.typed_leaves(F.struct(*df.columns), REC).alias("l")).collect()
    js = df.select(leaves.json_leaves(F.to_json(F.struct(*df.columns),
                                                {"ignoreNullFields": "false"})).alias("l")).collect()
    for a, b in zip(typed, js):
        ta, tb = [tuple(x) for x in a.l], [tuple(x) for x in b.l]
        assert [x[:2] + x[3:] for x in ta] == [x[:2] + x[3:] for x in tb]   # pos, path, kind
        for x, y in zip(ta, tb):   # values: same text, or JDK 17 non-shortest digits
            assert x[2] == y[2] or (x[3] == "float" and float(x[2]) == float(y[2]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="abcé ", max_size=15)),
                          st.one_of(st.none(), st.text(alphabet="abcé ", max_size=15))),
                min_size=1, max_size=30),
       st.sampled_from([80.0, 50.0, 95.0]))
def test_bounded_label_equals_full(spark, pairs, threshold):
    from labelqa.functions.similarity import pass_fail, pass_fail_bounded, similarity
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(pass_fail(similarity("a", "b"), threshold).alias("x"),
                    pass_fail_bounded("a", "b", threshold).alias("y")).collect()
    assert all(r.x == r.y for r in got)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab é", max_size=8), st.text(alphabet="ab é", max_size=8)),
                min_size=1, max_size=30))
def test_similarity_properties(spark, pairs):
    """Symmetric, within 0..100, and 100 exactly when the texts are equal."""
    from labelqa.functions.similarity import similarity
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", similarity("a", "b").alias("s"), similarity("b", "a").alias("t")).collect():
        assert r.s == r.t and 0.0 <= r.s <= 100.0
        assert (r.s == 100.0) == (r.a == r.b)


def test_key_value_scores_python_rendering(spark):
    import json as _json
    e = {"a": {"x": 1, "y": [1.0, None]}, "b": ["p", "q"], "c": None, "d": True, "e": 10}
    a = {"a": {"x": 1, "y": [1, None]}, "b": ["p"], "d": True, "e": 10.0}
    df = spark.createDataFrame([(1, _json.dumps(e), _json.dumps(a))], "id long, e string, a string")
    got = {r.key: (r.expected, r.actual, r.score)
           for r in scoring.key_value_scores(df, "e", "a", ["id"], render="python").collect()}
    for k, v in e.items():
        want_e, want_a = str(v), (str(a[k]) if k in a else None)
        assert got[k][:2] == (want_e, want_a)
        assert got[k][2] == py_similarity(want_e, want_a)


def test_membership_helpers(spark):
    df = spark.createDataFrame(
        [([(1.5, "kg"), (None, "lb")], [("X", "+18003279462")])],
        "w array<struct<value:double,unit:string>>, o array<struct<name:string,phone_number:string>>")
    r = df.select(scoring.contains_value(F.col("w"), F.lit(None).cast("double"), F.lit("lb")).alias("a"),
                  scoring.contains_value(F.col("w"), F.lit(1.5), F.lit("lb")).alias("b"),
                  scoring.contains_rendered(F.col("o"), "+18003279462").alias("c"),
                  scoring.contains_rendered(F.col("o"), "www.x.com").alias("d")).collect()[0]
    assert (r.a, r.b, r.c, r.d) == (True, False, True, False)


def test_read_builds_flat_columns(spark):
    """No object per leaf on the way to Arrow; the same leaves as ``leaves_of``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    from labelqa.operators import leaves
    from labelqa.schema import LEAVES

    texts = ['{"a": 1, "b": [true, null, 2.50, "x", ""], "c": {"d": "é", "\\ud83d": "\\ud83d!"}}', "{}", "[]", "7", None,
             '{"a": 1, "a": {"b": 2}, "a.b": 3}', '[{"k": -0.0}, [], [[1e400]]]', '{"x": 1234567890123456789012}']
    docs = [None if t is None else leaves._by_path(json.loads(t)) for t in texts]
    got = leaves._leaf_lists(docs, to_arrow_type(LEAVES))
    want = [None if t is None else leaves.leaves_of(json.loads(t)) for t in texts]
    assert got.type == to_arrow_type(LEAVES) and got.to_pylist() == want
    assert leaves._leaf_lists([], got.type).to_pylist() == [] and leaves._leaf_lists([None], got.type).to_pylist() == [None]
    assert isinstance(got, pa.ListArray) and got.null_count == 1
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, '{"broken": '])], "k int, t string")
    rows = {r["k"]: r for r in df.select("k", leaves.json_read("t").alias("r")).select("k", "r.*").collect()}
    assert [rows[k]["leaves"] and [x.asDict() for x in rows[k]["leaves"]] for k in range(len(texts))] == want
    assert (rows[len(texts)]["leaves"], rows[len(texts)]["issue"]) == (None, "invalid_json")
