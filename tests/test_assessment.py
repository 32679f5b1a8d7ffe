"""Images to scores in one plan; artefacts of failed documents."""

import json
import os

from pyspark.sql import functions as F

from labelqa.operators import extract
from labelqa.plans import analyze, assess


def make_case(root, name, images, golden):
    folder = os.path.join(root, name)
    os.makedirs(folder)
    for image, content in images.items():
        with open(os.path.join(folder, image), "wb") as f:
            f.write(content)
    with open(os.path.join(folder, "expected_output.json"), "w") as f:
        f.write(golden)


def makers():
    """Nested, so that workers get them by value."""
    def make_ocr():
        def read(row):
            text = bytes(row["content"]).decode()
            if text == "blurred":
                raise OSError("no text")
            return text
        return read

    def make_extractor():
        def fn(row):
            if "fail" in row["text"]:
                raise ValueError("refused")
            name, npk, *rest = row["text"].split()
            weight = {"value": rest[0]} if rest else {"value": "5 kg", "unit": "kg"}
            return extract.Prediction(f"read {name}", {"fertiliser_name": name, "npk": npk, "weight": [weight]})
        return fn

    return make_ocr, make_extractor


make_ocr, make_extractor = makers()


def test_images_to_scores(spark, tmp_dir):
    root, out = os.path.join(tmp_dir, "labels"), os.path.join(tmp_dir, "out")
    golden = json.dumps({"fertiliser_name": "Grow", "npk": "1-2-3", "weight": [{"value": 5.0, "unit": "kg"}], "lot_number": None, "color": "red"})
    make_case(root, "label_1", {"a.png": b"Grow", "b.png": b"1-2-3"}, golden)
    make_case(root, "label_2", {"a.png": b"Grow", "b.png": b"1-2"}, golden)           # bad grade: null
    make_case(root, "label_3", {"a.png": b"Grow", "b.png": b"blurred"}, golden)       # failed page
    make_case(root, "label_4", {"a.png": b"fail"}, golden)                            # failed extraction
    make_case(root, "label_5", {"a.png": b"Grow 1-2-3", "b.png": b"7"}, golden)       # weight without unit
    make_case(root, "label_6", {"a.png": b"Grow 1-2-3"}, "{")                         # broken golden
    done = assess.run_images(spark, root, make_ocr, make_extractor, out, "r1")
    scores = {(r.case_no, r.path): (r.expected, r.actual, r.hit, r.pass_fail) for r in done.scores.collect()}
    assert {c for c, _ in scores} == {1, 2}
    assert scores[1, "npk"] == ("1-2-3", "1-2-3", True, "Pass")
    assert scores[1, "weight[0].value"] == ("5.0", "5.0", True, "Pass")
    assert scores[1, "lot_number"] == (None, None, True, "Pass")        # a null of the record, not a miss
    assert scores[1, "color"][2:] == (False, "Fail")
    assert scores[2, "npk"] == ("1-2-3", None, True, "Fail")
    failures = {r.case_no: r.error for r in done.failures.collect()}
    assert failures == {3: "failed pages: 1", 4: "ValueError: refused", 5: "rejected: weight[0].unit: missing", 6: "golden: invalid_json"}
    assert all(r.speed >= 0 for r in done.scores.select("speed").collect())
    assert done.overall.first().total_test_cases == 2
    left = spark.read.parquet(os.path.join(out, "artefacts")).select(F.element_at(F.split("doc", "/"), -1).alias("case"), "stage", "content", "data").collect()
    found = {(r.case, r.stage): r.content if r.data is None else bytes(r.data) for r in left}
    assert found == {("label_3", "image"): b"blurred", ("label_4", "text"): "fail", ("label_5", "text"): "Grow 1-2-3 7",
                     ("label_5", "reasoning"): "read Grow",
                     ("label_5", "record"): '{"fertiliser_name": "Grow", "npk": "1-2-3", "weight": [{"value": "7"}]}'}


def test_validated_assessment_of_a_folder(spark, tmp_dir):
    root = os.path.join(tmp_dir, "labels")
    make_case(root, "label_1", {"a.png": b"x"}, json.dumps({"npk": "1-2-3", "cautions_en": None, "extra": 1}))
    make_case(root, "label_2", {"a.png": b"x"}, json.dumps({"npk": "1-2-3"}))

    def make():
        return lambda row: {"npk": "1-2-3", "extra": 1} if row["case_dir"] == "label_1" else {"npk": 5}

    raw = assess.run(spark, root, make)
    assert raw.scores.count() == 4 and raw.failures.count() == 0
    done = assess.run(spark, root, make, validate=True)
    got = {r.path: (r.hit, r.score) for r in done.scores.collect()}
    assert got == {"npk": (True, 100.0), "cautions_en": (True, 100.0), "extra": (False, 0.0)}     # unknown keys are no part of a record
    assert [(r.case_no, r.error) for r in done.failures.collect()] == [(2, "rejected: npk: string_type")]


def test_no_cases_left_to_score(spark, tmp_dir):
    root = os.path.join(tmp_dir, "labels")
    make_case(root, "label_1", {"a.png": b"blurred"}, "{}")
    done = assess.run_images(spark, root, make_ocr, make_extractor)
    assert done.scores.count() == 0 and done.failures.count() == 1


def test_null_text_and_reasoning(spark):
    docs = spark.createDataFrame([(1, None), (2, "Grow 1-2-3")], "doc long, text string")
    make_extractor = makers()[1]

    def make():
        def fn(row):
            if row["text"] is None:
                raise ValueError("nothing to read")
            return make_extractor()(row)
        return fn

    done = analyze.analyze_texts(docs, make)
    assert [(r.doc, r.record.npk) for r in done.records.collect()] == [(2, "1-2-3")]
    assert [(r.doc, r.stage, r.content, r.error) for r in done.artefacts.collect()] == [("1", "text", None, "ValueError: nothing to read")]


def test_results_without_reasoning_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "Grow 1-2-3")], "doc long, text string")
    out = extract.apply_extractor(docs, make_extractor, "doc", ["text"])
    assert out.columns == ["doc", "result", "error", "seconds"]
    assert json.loads(out.first().result)["npk"] == "1-2-3"
