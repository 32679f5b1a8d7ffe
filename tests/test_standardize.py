"""Record standardisation from raw JSON."""

import json

import pytest

from pyspark.sql import functions as F

from labelqa.operators import standardize as S


def std(spark, docs):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d))
                                for i, d in enumerate(docs)], "id long, raw string")
    return {r.id: r for r in S.standardize(df, "raw", ["id"]).collect()}


def test_numbers_by_raw_type(spark):
    vals = ["2", "2 mg/L", "2mgl", "~2", "approximately 2", "2 or 3",
            "mg/L", "", " ", None, True, ["2"], {"value": "2"}, -5.5, "-5", 1e22, 7]
    docs = [{"weight": [{"value": v, "unit": "kg"}]} for v in vals]
    got = [std(spark, docs)[i].record.weight[0].value for i in range(len(vals))]
    assert got == [2.0] * 6 + [None] * 7 + [-5.5, 5.0, 1e22, 7.0]   # T15


def test_defaults_and_null_lists(spark):
    r = std(spark, [{"fertiliser_name": "Test", "cautions_en": None, "instructions_en": None,
                     "ingredients_en": None, "weight": None, "registration_number": None}])[0]
    rec = r.record
    assert r._issues == []
    assert rec.cautions_en == [] and rec.cautions_fr is None          # T18
    assert rec.instructions_en == [] and rec.ingredients_en == [] and rec.weight == []
    assert rec.registration_number == [] and rec.organizations == []


def test_nested_rules(spark):
    r = std(spark, [{
        "organizations": [{"name": "X", "website": "A.com", "phone_number": "800 640 9605"},
                          {"phone_number": "123-456-7890"}],
        "registration_number": [{"identifier": "1234567A", "type": "FERTILIZER"},
                                {"identifier": "1234567a", "type": "fertilizer_product"}],
        "npk": "10-5-20x",
        "guaranteed_analysis_en": {"title": "Guaranteed minimum analysis", "nutrients": None},
        "guaranteed_analysis_fr": {"title": None, "is_minimal": True,
                                   "nutrients": [{"nutrient": "N", "value": "2 %", "unit": "%"}]},
    }])[0]
    rec = r.record
    assert r._issues == []
    assert [o.website for o in rec.organizations] == ["www.a.com", None]
    assert [o.phone_number for o in rec.organizations] == ["+18006409605", None]
    assert [(x.identifier, x.type) for x in rec.registration_number] == [
        ("1234567A", None), (None, "fertilizer_product")]
    assert rec.npk is None
    assert rec.guaranteed_analysis_en.is_minimal is True and rec.guaranteed_analysis_en.nutrients == []
    assert rec.guaranteed_analysis_fr.is_minimal is True                  # T19
    assert rec.guaranteed_analysis_fr.nutrients[0].value == 2.0


def test_rejections(spark):
    got = std(spark, [
        {"fertiliser_name": 5},
        {"weight": [{"value": 1}]},
        {"ingredients_en": [{"value": 1}], "cautions_en": ["a", None]},
        {"registration_number": [{"type": "x"}], "density": "heavy"},
        {"instructions_fr": "not a list", "organizations": [None]},
        {"guaranteed_analysis_en": {"is_minimal": "perhaps"}, "website": 1},
        "[1, 2]", "{broken", '{"a": 1',
        {"guaranteed_analysis_en": {"is_minimal": 2}}, {"guaranteed_analysis_en": {"is_minimal": []}},
    ])

    def issues(i):
        return sorted((x.loc, x.kind) for x in got[i]._issues)
    assert issues(0) == [("fertiliser_name", "string_type")]
    assert issues(1) == [("weight[0].unit", "missing")]
    assert issues(2) == [("cautions_en[1]", "string_type"), ("ingredients_en[0].nutrient", "missing")]
    assert issues(3) == [("density", "model_type"), ("registration_number[0].identifier", "missing")]
    assert issues(4) == [("instructions_fr", "list_type"), ("organizations[0]", "model_type")]
    assert issues(5) == [("guaranteed_analysis_en.is_minimal", "bool_type")]
    assert issues(6) == [("", "model_type")]
    assert issues(7) == [("", "invalid_json")] and issues(8) == [("", "invalid_json")]  # T27
    assert issues(9) == issues(10) == [("guaranteed_analysis_en.is_minimal", "bool_type")]
    assert all(got[i].record is None for i in range(11))


def test_lax_booleans_and_duplicate_keys(spark):
    pydantic = pytest.importorskip("pydantic")
    model = pydantic.create_model("M", is_minimal=(bool | None, None))
    values = ["yes", "TRUE", "off", "0", "t", "maybe", "", 1, 0, 2, 1.0, 0.5, True, None, [], {}]
    got = std(spark, [{"guaranteed_analysis_en": {"is_minimal": v}} for v in values])
    for v, row in zip(values, [got[i] for i in range(len(values))], strict=True):
        try:
            want = model(is_minimal=v).is_minimal
        except pydantic.ValidationError:
            assert [x.loc for x in row._issues] == ["guaranteed_analysis_en.is_minimal"], v
            continue
        assert row._issues == [] and row.record.guaranteed_analysis_en.is_minimal == want, v
    twice = std(spark, ['{"npk": "1-2-3", "npk": "4-5-6"}'])[0]         # T27: the last value counts
    assert twice._issues == [] and twice.record.npk == "4-5-6"


def test_rule_counts_and_split(spark):
    df = spark.createDataFrame([(1, '{"weight": [{"value": 1}, {"unit": "g"}]}'),
                                (2, '{"npk": "1-2-3"}')], "id long, raw string")
    s = S.standardize(df, "raw", ["id"])
    assert S.rejects(s).count() == 1 and S.accepted(s).count() == 1
    counts = {(r.loc, r.kind): r.n_issues for r in S.rule_counts(s).collect()}
    assert counts == {("weight[].unit", "missing"): 1, ("weight[].value", "missing"): 1}


def test_idempotent_on_clean_output(spark):
    docs = [{"organizations": [{"website": "www.a.com", "phone_number": "+18006409605"}],
             "npk": "1-2-3", "registration_number": [{"identifier": "1234567A", "type": None}]}]
    first = std(spark, docs)[0].record
    again_json = json.dumps({"organizations": [o.asDict() for o in first.organizations],
                             "npk": first.npk,
                             "registration_number": [x.asDict() for x in first.registration_number]})
    second = std(spark, [again_json])[0].record
    assert second.organizations == first.organizations and second.npk == first.npk
    assert second.registration_number == first.registration_number


def test_specification(spark):
    df = spark.createDataFrame([
        (1, '{"humidity": "30 percent", "ph": "~6.5%", "solubility": "10molL"}'),
        (2, '{"humidity": "forty", "ph": true, "solubility": ["10"]}'),
        (3, '{"humidity": 30}')], "id long, raw string")
    got = {r.id: r for r in S.specification(df, "raw", ["id"]).collect()}
    assert (got[1].humidity, got[1].ph, got[1].solubility) == (30.0, 6.5, 10.0)
    assert (got[2].humidity, got[2].ph, got[2].solubility) == (None, None, None)
    assert sorted(x.loc for x in got[3]._issues) == ["ph", "solubility"]


def test_issues_only_mode_matches(spark):
    docs = [{"weight": [{"value": 1}]}, {"npk": "1-2-3"}, {"cautions_en": [None]}, "[1]"]
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)],
                               "id long, raw string")
    full = {r.id: r._issues for r in S.standardize(df, "raw", ["id"]).collect()}
    only = S.standardize(df, "raw", ["id"], with_record=False)
    assert only.columns == ["id", "_issues"]
    assert {r.id: r._issues for r in only.collect()} == full
