"""Limits that used to be hit silently, and results that used to depend on luck."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelqa.operators import extract, layout, leaves, prefix, scoring, stats
from labelqa.plans import analyze, stages
from labelqa.sources.cases import number_cases
from labelqa.streaming import incremental


def test_ranks_of_text_keys_over_many_rows(spark):
    """Two hundred thousand rows, an extra column kept, no exchange reused."""
    n = 200_000
    rows = spark.range(n).select(F.lit("one").alias("doc"), F.format_string("%09d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("seq"),
                                 F.pmod(F.col("id") * 7919, F.lit(n)).alias("want"), (F.col("id") % 5 + 1).alias("height"), (F.col("id") % 3).alias("width"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ranked = prefix.rank_within(rows, "doc", "seq")
        assert ranked.where("rank <> want + 1 or height is null").count() == 0 and ranked.count() == n
        assert layout.page_layout(rows).where("page_no <> cast(seq as bigint) + 1 or n_pages <> 200000").count() == 0
        cases = number_cases(rows.select(F.concat(F.lit("label_"), "seq").alias("case_dir"), "want"))
        assert cases.where("case_no <> want + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_sparse_integers_nulls_and_row_counts(spark):
    df = spark.createDataFrame([("a", 10**12 * k, 1, None if k == 1 else 2) for k in range(5)] + [(None, 1, 4, 3), ("b", None, 2, 2)], "doc string, seq long, height int, width int")
    got = {(r.doc, r.seq): (r.page_no, r.n_pages) for r in layout.page_layout(df).collect()}
    assert len(got) == 7 and got[("a", 10**12)] == (2, 5) and got[(None, 1)] == (1, 1) and got[("b", None)] == (1, 1)


def test_null_page_text_keeps_spans_and_text_together(spark):
    df = spark.createDataFrame([("d", 1, "ab"), ("d", 2, None), ("d", 3, "c")], "doc string, seq int, text string")
    text = layout.join_page_texts(df, "doc", "seq", "text").first()["text"]
    spans = [(r.page_no, r.start_pos, r.end_pos, r.n_pages, r.total_len) for r in layout.page_spans(df, "doc", "seq", "text").orderBy("page_no").collect()]
    assert text == "ab  c" and spans == [(1, 0, 2, 3, 5), (2, 3, 3, 3, 5), (3, 4, 5, 3, 5)]


@pytest.mark.parametrize("case, pos", [(1, 2**24 + 5), (2**39, 3), (2**62, 2**40)])
def test_first_appearance_of_large_numbers(spark, case, pos):
    df = spark.createDataFrame([(case, pos, "p", 90.0, "Pass", True), (case, pos + 1, "p", 90.0, "Pass", True)], "case_no long, pos long, path string, score double, pass_fail string, hit boolean")
    r = stats.by_field(df).first()
    assert (r.first_case, r.first_pos) == (case, pos)


def test_first_appearance_of_text_cases(spark):
    df = spark.createDataFrame([("b", 1, "p", 90.0, "Pass", True), ("a", 7, "p", 90.0, "Pass", True)], "case_no string, pos int, path string, score double, pass_fail string, hit boolean")
    assert stats.by_field(df).first()["first_case"] == "a"


def test_unreadable_records_are_rows(spark):
    deep = "[" * 100_000 + "]" * 100_000
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{broken"), (3, deep), (4, None)], "_id long, doc string")
    rows = {(r["_id"], r["path"], r["value"], r["kind"]) for r in leaves.json_leaf_rows(df, ["_id"], "doc").collect()}
    assert rows == {(1, "a", "1", "int"), (2, None, "invalid_json", "error"), (3, None, "nested_too_deep", "error")}
    assert [r[0] for r in df.select(leaves.json_issue("doc")).collect()] == [None, "invalid_json", "nested_too_deep", None]


def test_large_records_score_like_small_ones(spark):
    def record(n):
        return json.dumps({f"k{i}": i for i in range(n)})

    df = spark.createDataFrame([(n, record(n), record(n // 2)) for n in (0, 3, 64, 65, 4000)], "case_no long, e string, a string")
    s = scoring.score_records(df.select("case_no", leaves.json_leaves("e").alias("e"), leaves.json_leaves("a").alias("a")), "e", "a", ["case_no"])
    got = {r.case_no: (r.n, r.hits) for r in s.groupBy("case_no").agg(F.count("*").alias("n"), F.sum(F.col("hit").cast("int")).alias("hits")).collect()}
    assert got == {n: (n, n // 2) for n in (3, 64, 65, 4000)}


@pytest.mark.parametrize("text, want", [
    ("1-800-327-9462 450-655-6147", (None, None, "+18003279462")),
    ("Call 1-800-640-9605", (None, None, "+18006409605")),
    ("Lot 123456789A", (None, None, None)),
    ("Reg. 1234567A, 10-5.5-20.", ("1234567A", "10-5.5-20", None))])
def test_pattern_boundaries(spark, text, want):
    f = spark.createDataFrame([(text,)], "t string").select(extract.pattern_fields(F.col("t")).alias("f")).first()["f"]
    assert (f.registration, f.npk, f.phone_number) == want


def test_keys_with_apostrophes_are_compared(spark):
    df = spark.createDataFrame([(json.dumps({"it's": "abc", "x": [1, 2]}), json.dumps({"it's": "zzz", "x": [1, 2]}))], "e string, a string")
    got = {r.key: (r.expected, r.actual, r.score) for r in scoring.key_value_scores(df, "e", "a", []).collect()}
    assert got == {"it's": ("abc", "zzz", 0.0), "x": ("[1,2]", "[1,2]", 100.0)}


def test_failed_page_fails_its_document(spark):
    pages = spark.createDataFrame([("d1", 1, "p1", b"a"), ("d1", 2, "p2", b"bad"), ("d2", 1, "p3", b"c")], "doc string, seq int, path string, content binary")

    def make_ocr():
        def ocr(rec):
            if rec["content"] == b"bad":
                raise ValueError("unreadable")
            return rec["content"].decode()
        return ocr

    def make_extractor():
        return lambda rec: {"fertiliser_name": rec["text"]}
    out = analyze.analyze_pages(pages, make_ocr, make_extractor)
    assert [r.doc for r in out.records.collect()] == ["d2"]
    assert [(r.doc, r.error) for r in out.doc_failures.collect()] == [("d1", "failed pages: 1")]
    assert out.page_failures.count() == 1


def test_broken_store_is_not_an_empty_one(spark, tmp_dir):
    assert stages._done(spark, f"{tmp_dir}/none", ["id"]) is None
    with open(f"{tmp_dir}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):  # noqa: B017  the reader's error, whichever it is
        stages._done(spark, tmp_dir, ["id"]).count()
    spark.range(1).write.parquet(f"{tmp_dir}/other")
    with pytest.raises(AnalysisException):
        stages._done(spark, f"{tmp_dir}/other", ["absent"])


def test_replayed_batch_counts_once(spark, tmp_dir):
    scored = spark.createDataFrame([(1, 0, "p", 90.0, "Pass", True)], "case_no long, pos int, path string, score double, pass_fail string, hit boolean")
    for _ in range(2):          # what a retry does: the same batch again
        incremental._partials(scored).write.mode("overwrite").parquet(f"{tmp_dir}/partials/batch_id=0")
    assert incremental.field_stats_from_partials(spark, f"{tmp_dir}/partials").first()["occurrences"] == 1
    schema = T.StructType(scored.schema.fields)
    scored.write.parquet(f"{tmp_dir}/in")
    q = incremental.stats_partials_stream(spark.readStream.schema(schema).parquet(f"{tmp_dir}/in"), f"{tmp_dir}/again", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    assert incremental.field_stats_from_partials(spark, f"{tmp_dir}/again").first()["occurrences"] == 1
