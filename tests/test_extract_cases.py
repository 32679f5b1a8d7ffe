"""I1-I4, P3-P8 extraction, S1-S2 case discovery, A13 assessment, streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F

from labelqa.operators import extract, leaves
from labelqa.plans import assess
from labelqa.sources import cases
from labelqa.streaming import incremental

# folder of label_* case directories with golden files (optional, read only)
GOLDEN_ROOT = os.environ.get("LABELQA_GOLDEN_ROOT", "")


def test_apply_extractor_isolates_failures(spark):
    df = spark.createDataFrame([(i, "x " * i) for i in range(20)], "id long, text string")

    def make():
        def fn(rec):
            if rec["id"] % 7 == 3:
                raise RuntimeError("boom")
            return {"n": len(rec["text"].split())}
        return fn

    out = extract.apply_extractor(df, make, "id", ["text"])
    ok, dead = extract.split_results(out)
    assert ok.count() == 17 and dead.count() == 3
    r = {x.id: x for x in out.collect()}
    assert json.loads(r[5].result) == {"n": 5} and r[3].error == "RuntimeError: boom"
    assert all(x.seconds >= 0 for x in r.values())


def test_plan_work(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    done = spark.createDataFrame([(1, "e1", "gpt-4o")], "doc_id long, engine string, model string")
    todo, unsupported = extract.plan_work(spark, docs, "doc_id", ["e1", "e2"],
                                          ["gpt-4o", "gpt-3.5-turbo", "other"], done)
    rows = {(r.doc_id, r.engine, r.model): r for r in todo.collect()}
    assert len(rows) == 2 * 2 * 2 - 1 and (1, "e1", "gpt-4o") not in rows
    r = rows[(2, "e2", "gpt-3.5-turbo")]
    assert (r.max_tokens, r.api_version) == (12000, "2024-02-01")
    assert r.ocr_key == "ocr_e2_2" and r.llm_key == "llm_gpt-3.5-turbo_ocr_e2_2"
    assert [x.model for x in unsupported.collect()] == ["other"]


def test_request_and_patterns(spark):
    df = spark.createDataFrame([("Reg 1234567A grade 10-5-20 www.Soil.com call (757) 321-4567, 12.5 kg bag",)],
                               "t string")
    f = df.select(extract.pattern_fields(F.col("t")).alias("f")).collect()[0].f
    assert (f.registration, f.npk, f.website, f.phone_number, f.weight_value, f.weight_unit) == (
        "1234567A", "10-5-20", "www.soil.com", "+17573214567", 12.5, "kg")
    req = df.select(extract.request_text(F.col("t"))).collect()[0][0]
    assert req.endswith("12.5 kg bag") and "Translation of the text is prohibited." in req
    page = spark.createDataFrame([("<html><script>var x='<p>';</script><p>A &amp; B</p></html>",)], "h string")
    assert page.select(extract.html_text(F.col("h"))).collect()[0][0].split() == ["A", "&", "B"]


def make_tree(root, structure):
    # Spark file sources give no rows for 0-byte files, so fixtures hold one byte
    for d, files in structure.items():
        os.makedirs(os.path.join(root, d), exist_ok=True)
        for name, content in files.items():
            with open(os.path.join(root, d, name), "w") as fh:
                fh.write(content or "x")


def test_discovery(spark, tmp_dir):
    make_tree(tmp_dir, {
        "label_001": {"image001.png": "", "image002.JPG": "", "expected_output.json": "{}"},
        "label_002": {"image001.png": "", "expected_output.json": "{}"},
        "label_003": {"b.jpg": "", "a.png": "", "expected_output.json": "{}", "notes.jpeg": ""},
        "other": {"x.png": ""},
        "other/label_009": {"x.png": "", "expected_output.json": "{}"},   # nested: not a case
    })
    found = cases.discover(spark, tmp_dir).orderBy("case_no").collect()
    assert [(r.case_no, r.case_dir, r.n_images) for r in found] == [
        (1, "label_001", 2), (2, "label_002", 1), (3, "label_003", 2)]
    man = cases.manifest(spark, tmp_dir).filter("case_dir = 'label_003'").orderBy("seq").collect()
    assert [os.path.basename(r.path) for r in man] == ["a.png", "b.jpg"]


def test_discovery_sees_empty_files_and_directories(spark, tmp_dir):
    """As a directory listing does: zero-byte images count, an empty case directory is an error."""
    root = os.path.join(tmp_dir, "with space")
    make_tree(root, {f"label_{i:03}": {"expected_output.json": "{}"} for i in range(40)})
    for i in range(40):
        open(os.path.join(root, f"label_{i:03}", "image.PNG"), "w").close()
    found = cases.discover(spark, root).orderBy("case_no").collect()
    assert [(r.case_no, r.case_dir, r.n_images) for r in found] == [(i + 1, f"label_{i:03}", 1) for i in range(40)]
    assert {r.length for r in cases.manifest(spark, root).select("length").collect()} == {0}
    assert cases.image_bytes(spark, root).count() == 0
    # the paths agree with those of Spark's own sources
    assert found[0].golden == cases.list_files(spark, root).where("name = 'expected_output.json'").agg({"path": "min"}).first()[0]
    os.makedirs(os.path.join(root, "label_017b"))
    inv = {r.case_dir: r.issues for r in cases.inventory(spark, root).where(F.size("issues") > 0).collect()}
    assert inv == {"label_017b": [cases.NO_IMAGES, cases.NO_GOLDEN]}
    with pytest.raises(FileNotFoundError, match="No image files found in label_017b"):
        cases.discover(spark, root)


def test_listing_is_split_over_tasks(spark, tmp_dir):
    from labelqa.sources.listing import arrow_uri, list_directories
    make_tree(tmp_dir, {f"label_{i}": {"a.png": ""} for i in range(10)})
    df = list_directories(spark, tmp_dir, "label_", directories=3)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 10
    assert arrow_uri("viewfs://cluster/x") is None and arrow_uri("s3a://b/x") == "s3://b/x" and arrow_uri("file:/a/b") == "file:///a/b"


def test_empty_golden_fails_its_case_only(spark, tmp_dir):
    root = os.path.join(tmp_dir, "labels")
    make_tree(root, {"label_001": {"a.png": "", "expected_output.json": json.dumps({"f": "v"})}, "label_002": {"a.png": ""}})
    open(os.path.join(root, "label_002", "expected_output.json"), "w").close()
    out = assess.run(spark, root, lambda: (lambda rec: {"f": "v"}))
    assert [r.case_no for r in out.case_stats.collect()] == [1]
    assert [(r.case_no, r.error.split(":")[0]) for r in out.failures.collect()] == [(2, "golden")]


@pytest.mark.parametrize("structure,message", [
    ({"label_001": {"image001.png": "", "image002.jpg": ""}}, "Expected output JSON not found"),
    ({"label_001": {"expected_output.json": "{}"}}, "No image files found"),
    ({"empty": {"readme.txt": ""}}, "No label directories found"),
])
def test_discovery_errors(spark, tmp_dir, structure, message):
    make_tree(tmp_dir, structure)
    with pytest.raises(FileNotFoundError, match=message):
        cases.discover(spark, tmp_dir)


@pytest.mark.skipif(not GOLDEN_ROOT or not os.path.isdir(GOLDEN_ROOT),
                    reason="set LABELQA_GOLDEN_ROOT to a golden corpus")
def test_golden_corpus_counts(spark):
    """Regression numbers of the 35 golden files (read as data)."""
    g = cases.golden_texts(spark, GOLDEN_ROOT)
    lv = g.select("dir", F.inline(leaves.json_leaves("json")))
    assert g.count() == 35
    assert lv.count() == 2129
    assert lv.select("path").distinct().count() == 184
    assert lv.filter("kind = 'null'").count() == 637
    per = {r.dir.rsplit("/", 1)[1]: r["count"] for r in lv.groupBy("dir").count().collect()}
    assert per["label_002"] == 32 and per["label_011"] == 162


def test_assessment_end_to_end(spark, tmp_dir):
    root = os.path.join(tmp_dir, "labels")
    make_tree(root, {
        "label_001": {"a.png": "", "expected_output.json": json.dumps({"field_1": "value_1", "field_2": "value_2"})},
        "label_002": {"a.png": "", "expected_output.json": json.dumps({"field_1": "value_1", "n": 10})},
        "label_003": {"a.png": "", "expected_output.json": "{}"},
    })

    def make():
        def fn(rec):
            if rec["case_dir"] == "label_003":
                raise ValueError("extractor failed")
            if rec["case_dir"] == "label_001":
                return {"field_1": "value_1", "field_2": "value_2"}
            return {"field_1": "wrong_value", "n": 10.0}
        return fn

    out = os.path.join(tmp_dir, "out")
    a = assess.run(spark, root, make, out_dir=out, run_id="t")
    s = {(r.case_no, r.path): r for r in a.scores.collect()}
    assert s[(1, "field_1")].pass_fail == "Pass" and s[(1, "field_2")].score == 100.0
    assert int(s[(2, "field_1")].score) == 27 and s[(2, "n")].score == 50.0   # T3
    assert a.failures.count() == 1                                             # T23
    o = a.overall.collect()[0]
    assert o.total_test_cases == 2 and o.total_pass_rate == 0.5
    md = open([os.path.join(dp, f) for dp, _, fs in os.walk(os.path.join(out, "markdown"))
               for f in fs if f.startswith("part-") and os.path.getsize(os.path.join(dp, f))][0]).read()
    assert md.startswith("# Field Analysis Report")


def test_streaming_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    docs = [{"doc_id": i, "raw": json.dumps({"npk": f"{i}-2-3", "weight": [{"value": f"{i} kg", "unit": "kg"}]})}
            for i in range(6)] + [{"doc_id": 9, "raw": json.dumps({"weight": [{"value": 1}]})}]
    with open(os.path.join(src, "part1.json"), "w") as fh:
        fh.write("\n".join(json.dumps(d) for d in docs))
    sink, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    q = incremental.standardize_stream(spark, src, sink, ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.count() == 7
    assert got.filter(F.size("_issues") > 0).select("doc_id").collect()[0][0] == 9
    w = {r.doc_id: r.record.weight[0].value for r in got.filter(F.size("_issues") == 0).collect()}
    assert w == {i: float(i) for i in range(6)}
    # a second run sees no new files and writes nothing new (P5 incremental)
    q = incremental.standardize_stream(spark, src, sink, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == 7


def test_score_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "produced")
    os.makedirs(src)
    rows = [{"case_no": 1, "actual_json": json.dumps({"a": "x", "b": "yy"})},
            {"case_no": 1, "actual_json": json.dumps({"a": "x", "b": "yy"})},  # re-delivered
            {"case_no": 2, "actual_json": json.dumps({"a": "z"})}]
    with open(os.path.join(src, "p.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    gold = spark.createDataFrame([(1, json.dumps({"a": "x", "b": "yz"})), (2, json.dumps({"a": "z", "c": 1}))],
                                 "case_no long, expected_json string")
    sink, ckpt = os.path.join(tmp_dir, "scores"), os.path.join(tmp_dir, "ck2")
    q = incremental.score_stream(spark, src, incremental.expected_leaves(gold), sink, ckpt)
    q.awaitTermination(120)
    got = {(r.case_no, r.path): r.score for r in spark.read.parquet(sink).collect()}
    assert got == {(1, "a"): 100.0, (1, "b"): 50.0, (2, "a"): 100.0, (2, "c"): 0.0}


def test_analyze_pages_end_to_end(spark):
    from labelqa.plans import analyze
    pages = spark.createDataFrame(
        [("d1", 1, "d1/p1.png", bytearray(b"Grade 10-5-20")), ("d1", 2, "d1/p2.png", bytearray(b"net 12 kg")),
         ("d2", 1, "d2/p1.png", bytearray(b"unreadable")), ("d3", 1, "d3/p1.png", bytearray(b"x"))],
        "doc string, seq long, path string, content binary")

    def make_ocr():
        def ocr(rec):
            text = bytes(rec["content"]).decode()
            if text == "unreadable":
                raise ValueError("ocr failed")
            return text
        return ocr

    def make_llm():
        def llm(rec):
            t = rec["text"]
            if t == "x":
                return {"npk": 5}                      # rejected: non-string grade
            return {"npk": t.split()[1], "weight": [{"value": t.split()[-2], "unit": "kg"}]}
        return llm

    a = analyze.analyze_pages(pages, make_ocr, make_llm)
    recs = {r.doc: r for r in a.records.collect()}
    assert recs["d1"].record.npk == "10-5-20" and recs["d1"].record.weight[0].value == 12.0
    assert recs["d3"].record is None and recs["d3"]._issues[0].kind == "string_type"
    assert [r.path for r in a.page_failures.collect()] == ["d2/p1.png"]
    assert "d2" not in recs


def test_key_value_scores_and_artefacts(spark, tmp_dir):
    from labelqa.operators import scoring
    from labelqa.sinks import artefacts
    df = spark.createDataFrame([(1, '{"a": "x", "b": [1, 2], "c": null}', '{"a": "x", "b": [1, 3]}')],
                               "id long, e string, a string")
    got = {r.key: r.score for r in scoring.key_value_scores(df, "e", "a", ["id"]).collect()}
    assert got["a"] == 100.0 and got["c"] == 100.0 and 0 < got["b"] < 100
    rec = spark.createDataFrame([(1, None, "x")], "id long, npk string, lot string")
    assert rec.select(artefacts.record_json(F.struct("npk", "lot"))).collect()[0][0] == '{"npk":null,"lot":"x"}'
    rows = spark.createDataFrame([("1", "ocr", "text", None), ("2", "ocr", "t2", None),
                                  ("2", "record", None, "ValueError: bad")],
                                 "doc string, stage string, content string, error string")
    path = os.path.join(tmp_dir, "artefacts")
    artefacts.write_artefacts(artefacts.artefact_rows(rows, "doc", "ocr", "content", error="error"), path, "r1")
    kept = spark.read.parquet(path)
    assert sorted(r.doc for r in kept.collect()) == ["2", "2"]            # K5: failures only


def test_small_operators(spark, tmp_dir):
    from labelqa.operators import layout
    names = spark.createDataFrame([("image_001.png",), ("a.b.jpg",), ("noext",)], "n string")
    assert [r[0] for r in names.select(extract.strip_extension(F.col("n"))).collect()] == [
        "image_001", "a.b", "noext"]
    docs = spark.createDataFrame([("d1",), ("d2",)], "doc string")
    man = spark.createDataFrame([("d1", 1, 10, 10)], "doc string, seq long, width long, height long")
    assert [r.doc for r in layout.empty_documents(docs, man).collect()] == ["d2"]   # D4
    make_tree(tmp_dir, {"label_001": {"a.png": "png-bytes", "ocr.md": "# text\nline",
                                      "expected_output.json": "{}"}})
    imgs = cases.image_bytes(spark, tmp_dir).collect()
    assert len(imgs) == 1 and bytes(imgs[0].content) == b"png-bytes"
    md = cases.texts(spark, tmp_dir, "*.md").collect()
    assert [r.text for r in md] == ["# text\nline"]


def test_compact_texts(spark, tmp_dir):
    root = os.path.join(tmp_dir, "labels")
    make_tree(root, {f"label_{i:03d}": {"a.png": "x", "expected_output.json": json.dumps({"i": i})}
                     for i in range(1, 6)})
    out = os.path.join(tmp_dir, "compact")
    t = cases.compact_texts(spark, root, out)
    got = sorted(json.loads(r.text)["i"] for r in t.collect())
    assert got == [1, 2, 3, 4, 5] and {r.name for r in t.collect()} == {"expected_output.json"}
    same = sorted(json.loads(r.json)["i"] for r in cases.golden_texts(spark, root).collect())
    assert same == got


def test_incremental_stages(spark, tmp_dir):
    from labelqa.plans import stages
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, body string")
    calls = os.path.join(tmp_dir, "calls")
    os.makedirs(calls)

    def engine(tag, fail_on):
        def make():
            def run(rec):
                open(os.path.join(calls, f"{tag}-{rec['doc_id']}-{os.getpid()}-{id(rec)}"), "w").close()
                if rec["doc_id"] in fail_on:
                    raise RuntimeError("engine failed")
                return f"{tag}:{rec['body']}"
            return run
        return make

    text_store, rec_store = os.path.join(tmp_dir, "texts"), os.path.join(tmp_dir, "records")
    failed = stages.text_stage(spark, docs, "doc_id", ["body"],
                               {"e1": engine("e1", {3}), "e2": engine("e2", set())}, text_store)
    assert [r.doc_id for r in failed.collect()] == [3]
    assert spark.read.parquet(text_store).count() == 11
    assert len(os.listdir(calls)) == 12          # each (doc, engine) called exactly once
    # second run: only the failed pair is retried (and now succeeds)
    again = stages.text_stage(spark, docs, "doc_id", ["body"],
                              {"e1": engine("e1", set()), "e2": engine("e2", set())}, text_store)
    assert again.count() == 0 and spark.read.parquet(text_store).count() == 12

    def model():
        def run(rec):
            return {"npk": "1-2-3", "source": rec["text"]}
        return run
    assert stages.record_stage(spark, text_store, "doc_id", {"m1": model}, rec_store).count() == 0
    recs = spark.read.parquet(rec_store)
    assert recs.count() == 12
    assert {r.llm_key for r in recs.filter("doc_id = 2 AND engine = 'e2'").collect()} == {"llm_m1_ocr_e2_2"}
    # nothing left to do
    stages.record_stage(spark, text_store, "doc_id", {"m1": model}, rec_store)
    assert spark.read.parquet(rec_store).count() == 12


def test_stats_from_stream_partials(spark, tmp_dir):
    from labelqa.operators import stats
    rows = [(c, p, f"f{p}", float((c * 7 + p * 13) % 101), (c + p) % 3 != 0) for c in range(1, 9) for p in range(4)]
    src = os.path.join(tmp_dir, "scored")
    os.makedirs(src)
    for part in range(3):   # three files = up to three micro-batches
        with open(os.path.join(src, f"p{part}.json"), "w") as fh:
            for c, p, path, score, hit in rows[part::3]:
                fh.write(json.dumps({"case_no": c, "pos": p, "path": path, "score": score, "hit": hit,
                                     "pass_fail": "Pass" if score >= 80 else "Fail"}) + "\n")
    schema = "case_no long, pos int, path string, score double, hit boolean, pass_fail string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    sink, ckpt = os.path.join(tmp_dir, "partials"), os.path.join(tmp_dir, "ck3")
    incremental.stats_partials_stream(stream, sink, ckpt).awaitTermination(120)
    got = [tuple(r) for r in incremental.field_stats_from_partials(spark, sink).collect()]
    want = [tuple(r) for r in stats.by_field(spark.read.schema(schema).json(src)).collect()]
    assert got == want and len(got) == 4


def test_strict_modes(spark, tmp_dir):
    from labelqa.sources import reports
    docs = spark.createDataFrame([(1,)], "doc_id long")
    with pytest.raises(ValueError, match="not supported"):
        extract.plan_work(spark, docs, "doc_id", ["e"], ["gpt-4o", "other"], strict=True)
    empty = os.path.join(tmp_dir, "empty.csv")
    with open(empty, "w") as fh:
        fh.write("Test Case,Field Name,Pass/Fail,Accuracy Score,Pipeline Speed (seconds),Expected Value,Actual Value\n")
    with pytest.raises(ValueError, match="empty"):
        reports.read_report(spark, empty, strict=True)
    assert reports.read_report(spark, empty).count() == 0


def test_record_stage_retries_failures(spark, tmp_dir):
    from labelqa.plans import stages
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(4)], "doc_id long, body string")
    text_store, rec_store = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "r")

    def ocr():
        return lambda rec: rec["body"]
    stages.text_stage(spark, docs, "doc_id", ["body"], {"e": ocr}, text_store)

    def flaky(bad):
        def make():
            def run(rec):
                if rec["text"] in bad:
                    raise ValueError("model failed")
                return {"text": rec["text"]}
            return run
        return make
    failed = stages.record_stage(spark, text_store, "doc_id", {"m": flaky({"t1", "t2"})}, rec_store)
    assert sorted(r.doc_id for r in failed.collect()) == [1, 2]
    assert spark.read.parquet(rec_store).count() == 2
    failed = stages.record_stage(spark, text_store, "doc_id", {"m": flaky(set())}, rec_store)
    assert failed.count() == 0
    assert sorted(r.doc_id for r in spark.read.parquet(rec_store).collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize("text,number", [
    ("ring 011 44 20 7946 0958 soon", "+442079460958"), ("(1-800-327-9462)", "+18003279462"), ("450 - 655 - 6147", "+14506556147"),
    ("Tel-450-655-6147", "+14506556147"), ("call (450)  655-6147", "+14506556147"), ("450/655/6147", "+14506556147"), ("1-800-GOT-JUNK", "+18004685865"),
    ("+1 (450) 655 6147", "+14506556147"), ("011-44-2079460958.", "+442079460958"), ("grade 10-450-655-6147", None), ("key A4506556147", None), ("450 655 61470", None),
])
def test_phone_numbers_in_running_text(spark, text, number):
    got = spark.createDataFrame([(text,)], "t string").select(extract.pattern_fields(F.col("t"))["phone_number"].alias("n")).first()
    assert got.n == number
