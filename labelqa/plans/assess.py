"""The end-to-end assessment job.

discover cases -> read goldens -> run the extractor per case (durably
materialised, failures isolated) -> standardise -> flatten both sides ->
score -> CSV report -> statistics -> markdown report.

The golden and produced JSON of a case meet in one row (one shuffle join on
``case_no``); flattening and scoring are then narrow. The scores are stored
once and the three statistics read them. A case whose extractor fails, or
whose golden or produced text cannot be read, is in ``failures``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract, leaves, scoring, standardize, stats
from ..session import durable
from ..sinks import reports as sink
from ..sinks.artefacts import record_json
from ..sources import cases as src
from . import analyze


@dataclass
class Assessment:
    scores: DataFrame
    field_stats: DataFrame
    case_stats: DataFrame
    overall: DataFrame
    failures: DataFrame


def score_json(pairs: DataFrame, key: str = "case_no", speed: str | None = None) -> DataFrame:
    """Score ``(key, expected_json, actual_json[, speed])`` rows."""
    keep = [key] + ([speed] if speed else [])
    rec = pairs.select(*keep, leaves.json_leaves("expected_json").alias("e"),
                       leaves.json_leaves("actual_json").alias("a"))
    out = score_leaf_lists(rec, keep)
    return out.withColumnRenamed(key, "case_no") if key != "case_no" else out


def score_leaf_lists(rec: DataFrame, keep: list[str]) -> DataFrame:
    """Score ``(keep, e, a)`` rows of leaf lists; a null list has no leaves."""
    none = F.array().cast(leaves.LEAVES)
    rec = rec.select(*keep, F.coalesce("e", none).alias("e"), F.coalesce("a", none).alias("a"))
    return scoring.score_records(rec, "e", "a", keep)


def validated(produced: DataFrame, raw: str, keep: list[str]) -> DataFrame:
    """``keep, actual_json, error``: the produced JSON as the record that
    standardisation makes of it, nulls and defaults kept, or why it is rejected."""
    std = standardize.standardize(produced, raw, keep)
    return std.select(*keep, record_json(F.col("record")).alias("actual_json"),
                      F.concat(F.lit("rejected: "), standardize.issue_text()).alias("error"))


def assess_pairs(spark: SparkSession, pairs: DataFrame, failed: DataFrame | None = None,
                 out_dir: str | None = None, run_id: str | None = None, validate: bool = False) -> Assessment:
    """A13 from ``(case_no, expected_json, actual_json, speed)`` on: score,
    statistics, reports. With ``validate`` the produced JSON is standardised
    first, and rejected records join the failures."""
    if out_dir and not run_id:
        raise ValueError("run_id names this run's reports: earlier ones are never replaced")
    keep = ["case_no", "expected_json", "speed"]
    pairs = (validated(pairs, "actual_json", keep) if validate
             else pairs.select(*keep, "actual_json", F.lit(None).cast("string").alias("error")))
    # each text is parsed and walked once: leaves and issue together, stored before they are used twice
    read = pairs.select("case_no", "speed", "error", leaves.json_read("expected_json").alias("e"), leaves.json_read("actual_json").alias("a"))
    problem = F.coalesce("error", F.concat(F.lit("golden: "), "e.issue"), F.concat(F.lit("produced: "), "a.issue"))
    read = durable(read.select("case_no", "speed", problem.alias("error"), F.col("e.leaves").alias("e"), F.col("a.leaves").alias("a")), "pairs")
    failures = read.where(F.col("error").isNotNull()).select("case_no", "error")
    if failed is not None:
        failures = failed.unionByName(failures, allowMissingColumns=True)
    scores = durable(score_leaf_lists(read.where(F.col("error").isNull()), ["case_no", "speed"]), "scores")
    field = stats.by_field(scores)
    case = stats.by_case(scores)
    overall = stats.overall(scores)
    if out_dir:
        sink.write_csv(scores, f"{out_dir}/csv", run_id)
        total = overall.select("total_test_cases").scalar()
        lines = sink.markdown_lines(spark, field, case, overall, total)
        sink.write_markdown(lines, f"{out_dir}/markdown/run_id={run_id}")
    return Assessment(scores, field, case, overall, failures)


def run(spark: SparkSession, root: str, make_extractor, out_dir: str | None = None,
        run_id: str | None = None, validate: bool = False) -> Assessment:
    """``make_extractor()`` returns ``fn(row) -> record dict`` for a case row
    ``{case_no, dir, case_dir}``; it is built once per partition. Its record is
    scored as it is, or with ``validate`` as the standardised record."""
    found = durable(src.discover(spark, root), "cases")
    gold = src.golden_texts(spark, root)
    produced = extract.apply_extractor(found, make_extractor, "case_no", ["dir", "case_dir"], carry=["dir"])
    ok, failed = extract.split_results(durable(produced, "extracted"))
    pairs = (ok.join(gold, "dir", "left")     # an empty golden file has no row
             .select("case_no", F.coalesce("json", F.lit("")).alias("expected_json"),
                     F.col("result").alias("actual_json"), F.col("seconds").alias("speed")))
    return assess_pairs(spark, pairs, failed, out_dir, run_id, validate)


def run_images(spark: SparkSession, root: str, make_ocr, make_extractor, out_dir: str | None = None,
               run_id: str | None = None) -> Assessment:
    """The whole way: images -> page texts -> document text -> record ->
    standardised record -> score against the golden of the case.

    ``make_ocr()`` and ``make_extractor()`` as in ``analyze.analyze_pages``.
    A case with a failed page, a failed extraction, a rejected record or a
    broken golden is in ``failures``; its artefacts go to ``out_dir``.
    """
    found = durable(src.discover(spark, root), "cases")
    pages = src.manifest(spark, root).join(src.image_bytes(spark, root), "path", "left")
    pages = pages.withColumn("content", F.coalesce("content", F.lit("").cast("binary")))     # images of zero bytes
    done = analyze.analyze_pages(pages, make_ocr, make_extractor, doc="dir", seq="seq", key="path")
    records = durable(done.records.select("dir", F.col("seconds").alias("speed"), record_json(F.col("record")).alias("actual_json"),
                                          standardize.issue_text().alias("why")), "records")
    failed = done.doc_failures.select("dir", "error").unionByName(
        records.where("why is not null").select("dir", F.concat(F.lit("rejected: "), "why").alias("error")))
    pairs = (records.where("why is null").join(found, "dir").join(src.golden_texts(spark, root), "dir", "left")
             .select("case_no", F.coalesce("json", F.lit("")).alias("expected_json"), "actual_json", "speed"))
    if out_dir and run_id:
        done.write_artefacts(f"{out_dir}/artefacts", run_id)
    return assess_pairs(spark, pairs, failed.join(found.select("dir", "case_no"), "dir"), out_dir, run_id)
