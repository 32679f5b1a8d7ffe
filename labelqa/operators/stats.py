"""Accuracy statistics by field, by case and overall.

Input is a scored leaf table with ``case_no, pos, path, score, pass_fail,
hit`` (and optionally ``speed``). All statistics are hash aggregates with
map-side partial aggregation, so a path or case that holds a third of all
rows costs one partial row per task, never one task for the whole group.
Stats use the score rounded to two decimals (the report's text, T6) while
Pass/Fail keeps the unrounded comparison.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import PASS, fixed2

POS_SPAN = 1 << 63       # every non-negative long is a position


def first_key(case: str = "case_no", pos: str = "pos") -> Column:
    """(case, position) in one decimal: ordered by case, then position, and
    still a fixed-width buffer of a hash aggregate."""
    return F.col(case).cast("decimal(19,0)") * F.lit(Decimal(POS_SPAN)) + F.col(pos).cast("decimal(19,0)")


def first_columns(key: str, pos_type: str = "long") -> list[Column]:
    return [F.expr(f"cast(({key} - pmod({key}, {POS_SPAN})) / {POS_SPAN} as long)").alias("first_case"),
            F.expr(f"cast(pmod({key}, {POS_SPAN}) as {pos_type})").alias("first_pos")]


def prepare(scored: DataFrame) -> DataFrame:
    """A1: derived Pass / Missing flags and the two-decimal score."""
    return scored.select(
        "*",
        (F.col("pass_fail") == PASS).cast("int").alias("_pass"),
        (~F.col("hit")).cast("int").alias("_missing"),
        fixed2(F.col("score")).cast("double").alias("_score2"),
    )


def by_field(scored: DataFrame, digits: int = 6, file_order: bool = False) -> DataFrame:
    """A3-A5: per path, in first-appearance order (case order, then leaf order).

    With ``file_order`` the order is the row order of a read report:
    ``(file, pos)`` (see ``sources.reports.report_scores``); ``first_case``
    is the case of the first row. This path orders by a struct (sort
    aggregate); it serves report files, the scored table uses one decimal key.
    """
    p = prepare(scored)
    common = [
        F.round(F.avg("_score2"), digits).alias("accuracy_mean"),
        F.round(F.avg("_pass"), digits).alias("pass_rate"),
        F.round(F.avg("_missing"), digits).alias("missing_rate"),
        F.count(F.lit(1)).alias("occurrences"),
    ]
    if file_order:
        agg = p.groupBy("path").agg(*common, F.min(F.struct("file", "pos", "case_no")).alias("_f"))
        return (agg.select("*", F.col("_f.case_no").alias("first_case"),
                           F.col("_f.pos").alias("first_pos"), F.col("_f.file").alias("_file"))
                .orderBy("_file", "first_pos").drop("_f", "_file"))
    if not isinstance(scored.schema["case_no"].dataType, T.IntegralType):     # e.g. text ids
        agg = p.groupBy("path").agg(*common, F.min(F.struct("case_no", "pos")).alias("_f"))
        return (agg.select("*", F.col("_f.case_no").alias("first_case"), F.col("_f.pos").alias("first_pos"))
                .drop("_f").orderBy("first_case", "first_pos"))
    agg = p.groupBy("path").agg(*common, F.min(first_key()).alias("_first"))
    # the sort is a range-partitioned sort of the aggregate, not a single-task window
    return agg.select("*", *first_columns("_first", scored.schema["pos"].dataType.simpleString())).drop("_first").orderBy("first_case", "first_pos")


def by_case(scored: DataFrame, digits: int = 6) -> DataFrame:
    """Per case, ascending by case."""
    p = prepare(scored)
    return (p.groupBy("case_no").agg(
        F.round(F.avg("_pass"), digits).alias("overall_pass_rate"),
        F.round(F.avg("_score2"), digits).alias("average_accuracy_score"),
        F.count(F.lit(1)).alias("n_fields"),
    ).orderBy("case_no"))


def overall(scored: DataFrame, digits: int = 6) -> DataFrame:
    """Row-weighted pass rate and speed (T7), distinct case count."""
    p = prepare(scored)
    speed = (F.round(F.avg("speed"), digits) if "speed" in scored.columns
             else F.lit(None).cast("double"))
    return p.agg(
        F.round(F.avg("_pass"), digits).alias("total_pass_rate"),
        speed.alias("average_pipeline_speed"),
        F.count_distinct("case_no").alias("total_test_cases"),
        F.count(F.lit(1)).alias("total_fields"),
    )


def grouping_sets(scored: DataFrame, digits: int = 6) -> DataFrame:
    """Field, case and overall rows in one Expand + one shuffle."""
    p = prepare(scored)
    g = p.groupingSets([["path"], ["case_no"], []], "path", "case_no").agg(
        F.grouping_id("path", "case_no").alias("_gid"),
        F.round(F.avg("_score2"), digits).alias("accuracy_mean"),
        F.round(F.avg("_pass"), digits).alias("pass_rate"),
        F.round(F.avg("_missing"), digits).alias("missing_rate"),
        F.count(F.lit(1)).alias("n"))
    level = (F.when(F.col("_gid") == 1, F.lit("field")).when(F.col("_gid") == 2, F.lit("case"))
             .otherwise(F.lit("overall")))
    return g.select(level.alias("level"), "path", "case_no", "accuracy_mean", "pass_rate",
                    "missing_rate", "n")
