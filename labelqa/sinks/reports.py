"""CSV report and markdown report sinks.

The markdown report is written as ordered lines: each line carries a
``(section, key)`` sort key and the writer range-partitions on it, so part
files concatenated in name order form the document. No part of the report
passes through the driver or a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import MISSING, fixed2, fixed4
from ..schema import REPORT_COLUMNS


def report_rows(scored: DataFrame) -> DataFrame:
    """K1 projection: the seven text columns of the CSV report.

    Score with two decimals, speed with four, the sentinel for misses; null
    values stay null and are written as empty fields.
    """
    speed = F.col("speed") if "speed" in scored.columns else F.lit(None).cast("double")
    return scored.select(
        F.col("case_no").alias(REPORT_COLUMNS[0]),
        F.col("path").alias(REPORT_COLUMNS[1]),
        F.col("pass_fail").alias(REPORT_COLUMNS[2]),
        fixed2(F.col("score")).alias(REPORT_COLUMNS[3]),
        fixed4(speed).alias(REPORT_COLUMNS[4]),
        F.col("expected").alias(REPORT_COLUMNS[5]),
        F.when(F.col("hit"), F.col("actual")).otherwise(F.lit(MISSING)).alias(REPORT_COLUMNS[6]),
        F.col("pos").alias("_pos"),
    )


def write_csv(scored: DataFrame, path: str, run_id: str | None = None) -> None:
    """Header row, quoted fields; one folder per run instead of a minute stamp."""
    rows = report_rows(scored).orderBy(REPORT_COLUMNS[0], "_pos").drop("_pos")
    # empty strings written as nothing, like nulls (same bytes as a Python csv writer)
    w = (rows.write.mode("overwrite").option("header", True).option("escape", '"')
         .option("emptyValue", ""))
    w.csv(path if run_id is None else f"{path}/run_id={run_id}")


# ------------------------------------------------------------------ markdown

# Fixed text of the report (section titles, explanations, table headers).
TITLE = "# Field Analysis Report"
FIELD_SECTION = [
    "## Field-Level Aggregation",
    "The following table provides an overview of the accuracy, pass rate, and missing rate for each field across all test cases.",
    "`Field name`: correspond to a unique field in the Inspection.",
    "`Average Accuracy Score`: the average accuracy score for the given field across all test cases.",
    "`Pass Rate`: the percentage of test cases where the given field passed the accuracy threshold(default is 80%).",
    "`Missing Rate`: the percentage of test cases where the given field was not found in the Inspection returned by the pipeline.",
    "`Occurrences`: the number of times the given field was found across all test cases.",
]
FIELD_HEADER = [
    "| Field Name | Average Accuracy Score | Pass Rate | Missing Rate | Occurrences |",
    "|------------|------------------------|-----------|--------------|-------------|",
]
CASE_SECTION = [
    "## Test Case-Level Aggregation",
    "The following table provides an overview of the overall pass rate and average accuracy score for each test case.",
    "`Overall Pass Rate`: the percentage of fields that passed the accuracy threshold(default is 80%) in the given test case.",
    "`Average Accuracy Score`: the average accuracy score for all fields in the given test case.",
]
CASE_HEADER = [
    "| Test Case | Overall Pass Rate | Average Accuracy Score |",
    "|-----------|-------------------|------------------------|",
]
OVERALL_SECTION = "## Overall Pipeline Metrics"


def field_rows(field_stats: DataFrame, total_cases) -> DataFrame:
    """One table line per field; ``total_cases`` is a column or int."""
    total = F.lit(total_cases) if isinstance(total_cases, int) else total_cases
    return field_stats.select(
        "*",
        F.concat(
            F.lit("| "), F.col("path"), F.lit(" | "), fixed2("accuracy_mean"),
            F.lit(" | "), fixed2("pass_rate"), F.lit(" | "), fixed2("missing_rate"),
            F.lit(" | "), F.col("occurrences").cast("string"), F.lit("/"),
            total.cast("string"), F.lit(" |"),
        ).alias("line"),
    )


def case_rows(case_stats: DataFrame) -> DataFrame:
    """A10: one table line per case."""
    return case_stats.select(
        "*",
        F.concat(F.lit("| "), F.col("case_no").cast("string"), F.lit(" | "),
                 fixed2("overall_pass_rate"), F.lit(" | "),
                 fixed2("average_accuracy_score"), F.lit(" |")).alias("line"),
    )


def overall_lines(overall: DataFrame) -> DataFrame:
    """The overall block (one row of aggregates -> four lines)."""
    speed = F.when(F.col("average_pipeline_speed").isNull(),
                   F.lit("- Average Pipeline Speed: Not available")).otherwise(
        F.concat(F.lit("- Average Pipeline Speed: "), fixed2("average_pipeline_speed"),
                 F.lit(" seconds")))
    lines = F.array(
        F.concat(F.lit("- Total Pass Rate: "), fixed2("total_pass_rate")),
        speed, F.lit(""),
        F.concat(F.lit("- Total Number of Test Cases: "),
                 F.col("total_test_cases").cast("string")))
    return overall.select(F.posexplode(lines).alias("k", "line"))


def markdown_lines(spark, field_stats: DataFrame, case_stats: DataFrame,
                   overall: DataFrame, total_cases) -> DataFrame:
    """``(section, k1, k2, line)`` for the whole document, in section order.

    ``field_stats`` is ``stats.by_field`` output (``first_case``/``first_pos``
    give the first-appearance order); ``total_cases`` is an int or a scalar
    column (``overall.select(...).scalar()``), never a join.
    """
    def fixed(section: int, lines: list[str]) -> DataFrame:
        rows = [(section, i, 0, s) for i, s in enumerate(lines)]
        return spark.createDataFrame(rows, "section int, k1 long, k2 long, line string")

    head = [TITLE, ""]
    for s in FIELD_SECTION:
        head += [s, ""]
    head += FIELD_HEADER
    mid = [""]
    for s in CASE_SECTION:
        mid += [s, ""]
    mid += CASE_HEADER
    fields = field_rows(field_stats, total_cases).select(
        F.lit(1).alias("section"), F.col("first_case").cast("long").alias("k1"),
        F.col("first_pos").cast("long").alias("k2"), "line")
    cases = case_rows(case_stats).select(F.lit(3).alias("section"),
                                         F.col("case_no").cast("long").alias("k1"),
                                         F.lit(0).cast("long").alias("k2"), "line")
    tail = overall_lines(overall).select(F.lit(5).alias("section"), F.col("k").cast("long").alias("k1"),
                                         F.lit(0).cast("long").alias("k2"), "line")
    return (fixed(0, head).unionByName(fields).unionByName(fixed(2, mid)).unionByName(cases)
            .unionByName(fixed(4, ["", OVERALL_SECTION, ""])).unionByName(tail))


def write_markdown(lines: DataFrame, path: str) -> None:
    """K2: range-partitioned sort; part files in name order form the document."""
    lines.orderBy("section", "k1", "k2").select("line").write.mode("overwrite").text(path)


def read_markdown(spark, path: str) -> str:
    """Concatenate written part files in order (for tests and small reports)."""
    import glob
    import os
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    return "".join(open(p, encoding="utf-8").read() for p in parts)
