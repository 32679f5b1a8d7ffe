"""K3-K6: stage artefacts and record JSON.

Artefacts (OCR text, reasoning, record JSON, document bytes) are rows of one
table ``(doc, stage, content, data, error, run_id)`` written to parquet and
partitioned by run and stage, instead of timestamped files that collide
under concurrency. With ``failed_only`` (the reference's behaviour) only
artefacts of failed documents are kept (K5); nothing is deleted afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_json(record: Column) -> Column:
    """K6: record as JSON text with null fields kept."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def artefact_rows(df: DataFrame, doc: str, stage: str, content: str | None = None,
                  data: str | None = None, error: str | None = None) -> DataFrame:
    return df.select(
        F.col(doc).cast("string").alias("doc"), F.lit(stage).alias("stage"),
        (F.col(content).cast("string") if content else F.lit(None).cast("string")).alias("content"),
        (F.col(data).cast("binary") if data else F.lit(None).cast("binary")).alias("data"),
        (F.col(error) if error else F.lit(None).cast("string")).alias("error"))


def write_artefacts(rows: DataFrame, path: str, run_id: str, failed_only: bool = True) -> None:
    """K3/K4/K5: append artefacts of one run; failed documents only by default."""
    out = rows
    if failed_only:
        failed = rows.filter(F.col("error").isNotNull()).select("doc").distinct()
        out = rows.join(failed, "doc", "left_semi")
    (out.withColumn("run_id", F.lit(run_id)).write.mode("append")
     .partitionBy("run_id", "stage").parquet(path))
