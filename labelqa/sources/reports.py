"""Read a CSV assessment report back as a scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.similarity import MISSING
from ..schema import REPORT, REPORT_COLUMNS
from .csv_records import read_csv


def read_report(spark: SparkSession, path: str, strict: bool = False, positions: bool = False) -> DataFrame:
    """Explicit schema, quoted multi-line fields; malformed input fails the job.

    A file is read by as many tasks as it has splits (``csv_records``). A
    missing path fails at read time; with ``strict`` a report without rows is
    an error too (one-row probe, nothing collected). ``positions`` adds
    ``file`` and ``pos``, the file order of the rows.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in REPORT.fields)
    df = read_csv(spark, path, columns)
    if strict and df.limit(1).count() == 0:
        raise ValueError(f"CSV file is empty at {path}")
    return df if positions else df.drop("file", "pos")


def report_scores(report: DataFrame) -> DataFrame:
    """Report rows as the scored-leaf table used by ``operators.stats``.

    ``report`` comes from ``read_report`` with ``positions``: (file, pos) is
    the file order used for first appearance (A3). A row is missing when its
    actual value is the sentinel (A1).
    """
    c = REPORT_COLUMNS
    return report.select(
        F.col(c[0]).alias("case_no"),
        "file", "pos",
        F.col(c[1]).alias("path"), F.col(c[2]).alias("pass_fail"),
        F.col(c[3]).alias("score"), F.col(c[4]).alias("speed"),
        F.col(c[5]).alias("expected"), F.col(c[6]).alias("actual"),
        (~F.coalesce(F.col(c[6]) == MISSING, F.lit(False))).alias("hit"))
