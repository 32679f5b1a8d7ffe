"""Statistics, CSV round trip, markdown document."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelqa.operators import stats
from labelqa.sinks import reports as sink
from labelqa.sources import reports as src

ROWS = [  # case_no, pos, path, expected, actual, hit, score, pass_fail, speed
    (1, 0, "name", "A", "A", True, 100.0, "Pass", 5.44),
    (1, 1, "npk", "10-5-20", None, False, 0.0, "Fail", 5.44),
    (1, 2, "note", 'say "hi"\nnow', 'say "hi"\nnow', True, 100.0, "Pass", 5.44),
    (2, 0, "name", "B", "C", True, 0.0, "Fail", 2.0),
    (2, 1, "npk", "1-2-3", "1-2-4", True, 79.996, "Fail", 2.0),  # T6: shows 80.00, still Fail
    (3, 0, "extra", None, "x", True, 0.0, "Fail", 1.0),
    (3, 1, "name", "D", "D", True, 100.0, "Pass", 1.0),
]
SCHEMA = ("case_no long, pos int, path string, expected string, actual string, hit boolean, "
          "score double, pass_fail string, speed double")


def scored(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def pandas_model():
    df = pd.DataFrame(ROWS, columns=SCHEMA.replace(",", "").split()[::2])
    df["s2"] = df.score.map(lambda x: float(f"{x:.2f}"))
    df["Pass"] = df.pass_fail == "Pass"
    df["Missing"] = ~df.hit
    return df


def test_field_case_overall(spark):
    p = pandas_model()
    f = stats.by_field(scored(spark)).collect()
    assert [r.path for r in f] == ["name", "npk", "note", "extra"]  # first-appearance order
    want = p.groupby("path").agg(m=("s2", "mean"), pr=("Pass", "mean"), mr=("Missing", "mean"),
                                 n=("path", "count"))
    for r in f:
        w = want.loc[r.path]
        assert abs(r.accuracy_mean - w.m) < 1e-6 and abs(r.pass_rate - w.pr) < 1e-6
        assert abs(r.missing_rate - w.mr) < 1e-6 and r.occurrences == w.n
    c = stats.by_case(scored(spark)).collect()
    assert [r.case_no for r in c] == [1, 2, 3]
    assert abs(c[1].average_accuracy_score - (0.0 + 80.0) / 2) < 1e-9
    o = stats.overall(scored(spark)).collect()[0]
    assert abs(o.total_pass_rate - p.Pass.mean()) < 1e-6       # T7: row weighted
    assert abs(o.average_pipeline_speed - p.speed.mean()) < 1e-6
    assert o.total_test_cases == 3
    g = stats.grouping_sets(scored(spark))
    assert g.filter("level = 'field'").count() == 4 and g.filter("level = 'case'").count() == 3
    assert g.filter("level = 'overall'").count() == 1


def test_csv_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    sink.write_csv(scored(spark), path, run_id="r1")
    back = src.read_report(spark, os.path.join(path, "run_id=r1"))
    rows = back.orderBy("Test Case").collect()
    assert len(rows) == len(ROWS)
    first = rows[0]
    assert (first["Test Case"], first["Field Name"], first["Pass/Fail"], first["Accuracy Score"],
            first["Pipeline Speed (seconds)"]) == (1, "name", "Pass", 100.0, 5.44)
    texts = {r["Field Name"]: r for r in rows if r["Test Case"] == 1}
    assert texts["npk"]["Actual Value"] == "FIELD_NOT_FOUND"
    assert texts["note"]["Expected Value"] == 'say "hi"\nnow'       # T11
    again = stats.by_field(src.report_scores(src.read_report(spark, os.path.join(path, "run_id=r1"), positions=True)), file_order=True).collect()
    assert [r.path for r in again] == ["name", "npk", "note", "extra"]
    assert again[1].missing_rate == 0.5
    # several part files: file-name order, whatever the split packing
    multi = os.path.join(tmp_dir, "multi")
    rows = sink.report_rows(scored(spark)).orderBy("Test Case", "_pos").drop("_pos")
    rows.repartitionByRange(3, "Test Case").write.option("header", True).option("escape", '"').csv(multi)
    again = stats.by_field(src.report_scores(src.read_report(spark, multi, positions=True)), file_order=True).collect()
    assert [r.path for r in again] == ["name", "npk", "note", "extra"]


def reference_markdown(field_rows, case_rows, pass_rate, speed, total):
    """The document layout, written out independently for the test."""
    out = "# Field Analysis Report\n\n## Field-Level Aggregation\n\n"
    out += "".join(s + "\n\n" for s in sink.FIELD_SECTION[1:])
    out += "\n".join(sink.FIELD_HEADER) + "\n"
    for p, m, pr, mr, n in field_rows:
        out += f"| {p} | {m:.2f} | {pr:.2f} | {mr:.2f} | {n}/{total} |\n"
    out += "\n## Test Case-Level Aggregation\n\n"
    out += "".join(s + "\n\n" for s in sink.CASE_SECTION[1:])
    out += "\n".join(sink.CASE_HEADER) + "\n"
    for c, pr, m in case_rows:
        out += f"| {c} | {pr:.2f} | {m:.2f} |\n"
    out += "\n## Overall Pipeline Metrics\n\n"
    out += f"- Total Pass Rate: {pass_rate:.2f}\n"
    out += f"- Average Pipeline Speed: {speed:.2f} seconds\n"
    out += f"\n- Total Number of Test Cases: {total}\n"
    return out


def test_markdown_document(spark, tmp_dir):
    s = scored(spark)
    f, c, o = stats.by_field(s), stats.by_case(s), stats.overall(s)
    lines = sink.markdown_lines(spark, f, c, o, o.select("total_test_cases").scalar())
    path = os.path.join(tmp_dir, "md")
    sink.write_markdown(lines, path)
    got = sink.read_markdown(spark, path)
    fr = [(r.path, r.accuracy_mean, r.pass_rate, r.missing_rate, r.occurrences) for r in f.collect()]
    cr = [(r.case_no, r.overall_pass_rate, r.average_accuracy_score) for r in c.collect()]
    orow = o.collect()[0]
    want = reference_markdown(fr, cr, orow.total_pass_rate, orow.average_pipeline_speed, 3)
    assert got == want


def test_speed_absent_is_not_available(spark):
    s = scored(spark).drop("speed")
    o = stats.overall(s)
    lines = [r.line for r in sink.overall_lines(o).orderBy("k").collect()]
    assert lines[1] == "- Average Pipeline Speed: Not available"


def test_quoted_csv_is_read_by_many_tasks(spark, tmp_dir):
    """Fields with line ends, quotes and separators across split borders: rows
    and order as the reader of whole files gives them."""
    import csv
    import random

    from labelqa.schema import REPORT, REPORT_COLUMNS
    rng = random.Random(5)
    folder = os.path.join(tmp_dir, "big")
    os.makedirs(folder)
    for name, rows in (("a.csv", 700), ("b.csv", 3), ("c.csv", 0)):
        with open(os.path.join(folder, name), "w", newline="") as fh:
            out = csv.writer(fh, lineterminator="\r\n" if name == "b.csv" else "\n")
            out.writerow(REPORT_COLUMNS)
            for i in range(rows):
                text = "".join(rng.choice('ab ,"\n é') for _ in range(rng.choice([0, 3, 30, 5000 if i % 97 == 0 else 8])))
                out.writerow([i, f"f[{i % 7}]", "Pass", f"{i % 100}.50", "0.1250", text, "x" + text[::-1]])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = src.read_report(spark, folder, positions=True)
        assert found.rdd.getNumPartitions() > 20
        got = [tuple(r) for r in found.orderBy("file", "pos").drop("file", "pos").collect()]
        df = spark.read.schema(REPORT).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST").csv(folder)
        assert sorted(map(repr, got)) == sorted(repr(tuple(r)) for r in df.collect())
        assert [r[0] for r in got] == [*range(700), 0, 1, 2]
        with open(os.path.join(folder, "d.csv"), "w") as fh:
            fh.write(",".join(REPORT_COLUMNS) + "\nnot a number,f,Pass,1.0,1.0,a,b\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            src.read_report(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
