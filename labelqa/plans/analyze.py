"""Documents -> text -> record, as one distributed plan.

* text per page image (I1) with a user callable, one client per partition;
* page texts joined in page order with one space (D5) - the composite's
  text - per document (documents are bounded: a label has a few pages);
* record extraction from the text (I4a) with a second user callable;
* standardisation and rejection of the produced JSON (I5, N*).

Each external call is written durably before it is used (``durable``), so
retries and later actions never repeat paid calls; failures at any step are
isolated per page / document and returned as dead letters (P6).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import extract, layout, standardize
from ..session import durable
from ..sinks import artefacts


@dataclass
class Analysis:
    records: DataFrame      # doc, seconds, record, _issues (accepted and rejected)
    page_failures: DataFrame
    doc_failures: DataFrame
    artefacts: DataFrame    # K3-K5: what failed documents left: doc, stage, content, data, error

    def write_artefacts(self, path: str, run_id: str) -> None:
        """K3-K5; only failed documents have any."""
        artefacts.write_artefacts(self.artefacts, path, run_id, failed_only=False)


def analyze_pages(pages: DataFrame, make_ocr, make_extractor, doc: str = "doc",
                  seq: str = "seq", key: str = "path") -> Analysis:
    """``pages(doc, seq, path, content)`` -> standardised records per doc."""
    text = extract.apply_extractor(pages, make_ocr, key, ["content"], carry=[doc, seq])
    text = durable(text, "page-text")
    ok, bad_pages = extract.split_results(text)
    docs = layout.join_page_texts(ok.select(doc, seq, F.col("result").alias("text")), doc, seq, "text")
    spent = ok.groupBy(F.col(doc).alias("__timed")).agg(F.sum("seconds").alias("ocr_seconds"))
    docs = docs.join(spent, F.col(doc).eqNullSafe(F.col("__timed")), "left").drop("__timed")
    # a document with a failed page is not read from the pages that are left
    broken = bad_pages.groupBy(doc).agg(F.concat(F.lit("failed pages: "), F.count(F.lit(1)).cast("string")).alias("error"))
    whole = docs.join(broken.select(F.col(doc).alias("__doc")), F.col(doc).eqNullSafe(F.col("__doc")), "left_anti")
    out = analyze_texts(whole, make_extractor, doc, bad_pages)
    failed = broken.select(doc, F.lit(None).cast("string").alias("result"), "error")
    images = pages.select(key, "content").join(bad_pages.select(key, doc, "error"), key)     # K4
    left = artefacts.artefact_rows(images, doc, "image", data="content", error="error")
    return Analysis(out.records, bad_pages, out.doc_failures.unionByName(failed, allowMissingColumns=True),
                    out.artefacts.unionByName(left))


def analyze_texts(docs: DataFrame, make_extractor, doc: str = "doc",
                  page_failures: DataFrame | None = None) -> Analysis:
    """``docs(doc, text)`` (text already extracted) -> standardised records.

    A document fails when its extractor does or its record is rejected; what
    was known of it by then (text, reasoning, produced record) is kept.
    """
    carry = ["text"] + [c for c in docs.columns if c == "ocr_seconds"]
    pred = extract.apply_extractor(docs, make_extractor, doc, ["text"], carry, reasoning=True)
    pred = durable(pred, "prediction")
    spent = F.col("seconds") + (F.coalesce("ocr_seconds", F.lit(0.0)) if "ocr_seconds" in carry else 0.0)
    ok, bad_docs = extract.split_results(pred.withColumn("seconds", spent).drop("ocr_seconds"))
    std = standardize.standardize(ok, "result", [doc, "seconds", "text", "reasoning", "result"])
    rejected = standardize.rejects(std).select(doc, "text", "reasoning", "result", F.concat(
        F.lit("rejected: "), standardize.issue_text()).alias("error"))
    failed = rejected.unionByName(bad_docs.select(doc, "text", "reasoning", "result", "error"))
    stages = F.array(*(F.struct(F.lit(stage).alias("stage"), F.col(col).alias("content"))
                       for stage, col in (("text", "text"), ("reasoning", "reasoning"), ("record", "result"))))
    left = failed.select(F.col(doc).cast("string").alias("doc"), F.inline(stages), F.lit(None).cast("binary").alias("data"), "error")
    empty = docs.sparkSession.createDataFrame([], "path string, result string, error string")
    return Analysis(std.select(doc, "seconds", "record", "_issues"), page_failures if page_failures is not None else empty,
                    bad_docs.drop("text"), left.where("content is not null or stage = 'text'"))


def records_from_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """P2 without external calls: text -> pattern fields (I4b) -> record JSON
    (K6) -> standardised record and issues (I5, N*), all in the JVM."""
    f = F.col("_f")
    weight = F.when(f["weight_value"].isNotNull(),
                    F.array(F.struct(f["weight_value"].alias("value"), f["weight_unit"].alias("unit"))))
    rec = F.struct(
        F.array(F.struct(f["website"].alias("website"), f["phone_number"].alias("phone_number")))
        .alias("organizations"),
        F.when(f["registration"].isNotNull(), F.array(F.struct(f["registration"].alias("identifier"))))
        .alias("registration_number"),
        weight.alias("weight"),
        f["npk"].alias("npk"))
    raw = docs.select(key, extract.pattern_fields(F.col(text)).alias("_f")).select(
        key, artefacts.record_json(rec).alias("raw"))
    return standardize.standardize(raw, "raw", [key])
