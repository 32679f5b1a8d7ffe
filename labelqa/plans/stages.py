"""P3-P7 as a plan: incremental text and record stages over several engines.

Stage 1 (text): documents x engines, minus pairs already in the text store,
run through the engine's client, successful rows appended to the store
(parquet, partitioned by engine). Stage 2 (records): stored texts x models,
minus triples already in the record store, same pattern. Each stage reads the
previous stage's durable table, so lineage is cut between them, and a rerun
only retries what failed (failures are returned, not stored).

Fan-out is an ``explode`` of the fixed engine / model name lists; one
``mapInPandas`` dispatches every row to its engine's client, which is built
lazily once per partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract
from ..session import durable

Factory = Callable[[], Callable[[dict], object]]


def _dispatch(factories: dict[str, Factory], by: str) -> Factory:
    def make():
        clients: dict[str, Callable] = {}

        def run(rec):
            name = rec[by]
            if name not in clients:
                clients[name] = factories[name]()
            return clients[name](rec)
        return run
    return make


def _done(spark: SparkSession, store: str, cols: list[str]) -> DataFrame | None:
    """Rows already in a store (any file system); None before the first run."""
    try:
        return spark.read.parquet(store).select(*cols)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":    # anything else is a broken store
            raise
        return None


def text_stage(spark: SparkSession, docs: DataFrame, key: str, inputs: list[str],
               engines: dict[str, Factory], store: str) -> DataFrame:
    """Stage 1: returns this run's failures; successes are appended to ``store``."""
    work = docs.select(key, *inputs, F.explode(F.array(*[F.lit(e) for e in engines])).alias("engine"))
    done = _done(spark, store, [key, "engine"])
    if done is not None:
        work = work.join(done, [key, "engine"], "left_anti")          # P5
    work = work.withColumn("ocr_key", F.format_string("ocr_%s_%s", F.col("engine"),
                                                        F.col(key).cast("string")))   # P7
    out = extract.apply_extractor(work, _dispatch(engines, "engine"), "ocr_key", inputs,
                                  carry=[key, "engine"])
    # written once before use: the store write and the failure list must not
    # both re-run the (paid) calls
    ok, failed = extract.split_results(durable(out, "text-stage"))
    (ok.select(key, "engine", "ocr_key", F.col("result").alias("text"), "seconds")
     .write.mode("append").partitionBy("engine").parquet(store))
    return failed


def record_stage(spark: SparkSession, text_store: str, key: str, models: dict[str, Factory],
                 store: str) -> DataFrame:
    """Stage 2: stored texts x models; returns failures, appends successes."""
    texts = spark.read.parquet(text_store)
    work = texts.select(key, "engine", "ocr_key", "text",
                        F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    done = _done(spark, store, [key, "engine", "model"])
    if done is not None:
        work = work.join(done, [key, "engine", "model"], "left_anti")
    work = work.withColumn("llm_key", F.format_string("llm_%s_%s", F.col("model"), F.col("ocr_key")))
    out = extract.apply_extractor(work, _dispatch(models, "model"), "llm_key", ["text"],
                                  carry=[key, "engine", "model"])
    ok, failed = extract.split_results(durable(out, "record-stage"))
    (ok.select(key, "engine", "model", "llm_key", F.col("result").alias("record"), "seconds")
     .write.mode("append").partitionBy("model").parquet(store))
    return failed
