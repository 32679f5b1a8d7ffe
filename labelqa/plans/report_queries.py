"""Queries of whole jobs over the driver tables, with DuckDB oracles: the
validated assessment, its CSV and markdown reports, artefacts of failed
documents, image admission and joined page texts. Importing this module adds
them to ``driver_queries``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract, layout, stats
from ..session import durable, ensure_checkpoint_dir
from ..sinks import reports as sink
from ..sources.reports import read_report, report_scores
from ..sources.tables import table
from . import analyze, assess
from . import driver_queries as dq
from .driver_queries import register


def _new_path(spark, name: str) -> str:
    import os
    import uuid
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- A13: validated assessment
# Goldens and raw records are built from the orders by two independent texts;
# the raw ones hold the seeded violations of ``record_rejects``, and some
# goldens are broken.

_GOLDEN_SQL = """CASE WHEN o_orderkey % 41 = 0 THEN '{"fertiliser_name": ' ELSE
  '{"fertiliser_name": "' || o_orderpriority || '", "npk": "' || CAST(o_custkey % 20 AS STRING) || '-' || CAST(o_orderkey % 10 AS STRING) || '-5"'
  || ', "lot_number": "LOT ' || CAST(o_orderkey AS STRING) || '"'
  || ', "weight": [{"value": ' || CAST(o_custkey % 50 AS STRING) || ', "unit": "kg"}, {"value": ' || CAST(o_custkey % 90 AS STRING) || '.0, "unit": "lb"}]'
  || ', "density": {"value": 1.' || CAST(o_orderkey % 10 AS STRING) || '}, "volume": null, "producer": "unknown"'
  || ', "guaranteed_analysis_en": {"is_minimal": ' || CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END || '}}' END"""

_GRADE = "CAST(o_custkey % 20 AS VARCHAR) || '-' || CAST(o_orderkey % 10 AS VARCHAR) || '-5'"
#: path, golden text, produced text, found; the produced text is that of the standardised record.
_ASSESSED = [
    ("fertiliser_name", "o_orderpriority", "o_orderpriority", "TRUE"),
    ("npk", _GRADE, f"CASE WHEN o_orderkey % 3 <> 0 THEN {_GRADE} END", "TRUE"),
    ("lot_number", "'LOT ' || o_orderkey", "'LOT' || o_orderkey", "TRUE"),
    ("weight[0].value", "CAST(o_custkey % 50 AS VARCHAR)", "CASE WHEN o_orderkey % 7 <> 0 THEN (o_custkey % 50) || '.0' END", "TRUE"),
    ("weight[0].unit", "'kg'", "'kg'", "TRUE"),
    ("weight[1].value", "(o_custkey % 90) || '.0'", "(o_custkey % 90) || '.0'", "TRUE"),
    ("weight[1].unit", "'lb'", "'lb'", "TRUE"),
    ("density.value", "'1.' || (o_orderkey % 10)", "CASE WHEN o_orderkey % 2 = 1 THEN '1.' || (o_orderkey % 10) END", "o_orderkey % 2 = 1"),
    ("volume", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "TRUE"),
    ("producer", "'unknown'", "CAST(NULL AS VARCHAR)", "FALSE"),
    ("guaranteed_analysis_en.is_minimal", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'True' ELSE 'False' END",
     """CASE WHEN o_orderpriority = '1-URGENT' THEN 'True' WHEN o_orderpriority <> '2-HIGH' THEN 'False'
             WHEN o_orderkey % 2 = 0 THEN 'True' END""", "TRUE"),
]


def _assessment_cte() -> str:
    parts = " UNION ALL ".join(
        f"SELECT o_orderkey AS case_no, {k} AS pos, '{path}' AS path, {e} AS expected, {a} AS actual, {hit} AS hit FROM fit"
        for k, (path, e, a, hit) in enumerate(_ASSESSED))
    similar = dq._SIM.format(e="coalesce(expected, 'None')", a="coalesce(actual, 'None')")
    return f"""{dq._ISSUES_SQL},
why AS (SELECT id, 'rejected: ' || string_agg(loc || ': ' || kind, '; ' ORDER BY loc || ': ' || kind) AS error FROM issues GROUP BY id),
judged AS (SELECT o.*, CASE WHEN why.error IS NOT NULL THEN why.error WHEN o_orderkey % 41 = 0 THEN 'golden: invalid_json' END AS error
           FROM orders o LEFT JOIN why ON o_orderkey = id),
fit AS (SELECT * FROM judged WHERE error IS NULL),
leafs AS ({parts}),
scored AS (SELECT *, CASE WHEN NOT hit THEN CAST(0 AS DOUBLE) ELSE {similar} END AS score FROM leafs)"""


def _assess_orders(spark, sf) -> assess.Assessment:
    pairs = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("case_no"), F.expr(_GOLDEN_SQL).alias("expected_json"),
        F.expr(dq.RAW_RECORD_SQL).alias("actual_json"), ((F.col("o_custkey") % 8) / 4).alias("speed"))
    return assess.assess_pairs(spark, pairs, validate=True)


@register("assessment_scores", f"""WITH {_assessment_cte()}
SELECT case_no, pos, path, expected, actual, hit, score, CASE WHEN score >= 80.0E0 THEN 'Pass' ELSE 'Fail' END AS outcome FROM scored
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL, error FROM judged WHERE error IS NOT NULL""")
def assessment_scores(spark, sf):
    """Scored leaves of the accepted cases, and one row per failed case."""
    done = _assess_orders(spark, sf)
    scored = done.scores.select("case_no", "pos", "path", "expected", "actual", "hit", "score", F.col("pass_fail").alias("outcome"))
    return scored.unionByName(done.failures.select("case_no", F.col("error").alias("outcome")), allowMissingColumns=True)


@register("assessment_overall", f"""WITH {_assessment_cte()},
n AS (SELECT count(DISTINCT case_no) AS total_test_cases, count(*) AS total_fields, round(avg(CAST(score >= 80.0E0 AS INTEGER)), 6) AS total_pass_rate,
             round(avg((o_custkey % 8) / 4), 6) AS average_pipeline_speed
      FROM scored JOIN orders ON case_no = o_orderkey)
SELECT n.*, (SELECT count(*) FROM judged WHERE error IS NOT NULL) AS failed_cases FROM n""")
def assessment_overall(spark, sf):
    done = _assess_orders(spark, sf)
    failed = done.failures.agg(F.count(F.lit(1)).alias("failed_cases"))
    return done.overall.select("*", failed.scalar().alias("failed_cases"))


# ---------------------------------------------------------------- K1, S4, A10-A12: reports

def _timed_scores(spark, sf):
    return durable(dq.field_scores_df(spark, sf).withColumn("speed", (F.col("case_no") % 16) / 8), "scores")


@register("csv_report_rows", f"""WITH {dq.FIELD_SCORES_CTE}
SELECT case_no, path, pass_fail, _score2 AS score, (case_no % 16) / 8 AS speed, nullif(expected, '') AS expected,
       CASE WHEN hit THEN nullif(actual, '') ELSE 'FIELD_NOT_FOUND' END AS actual, hit
FROM prep""")
def csv_report_rows(spark, sf):
    """The report of a run as CSV files, read back."""
    path = _new_path(spark, "csv")
    sink.write_csv(_timed_scores(spark, sf), path, "r1")
    back = report_scores(read_report(spark, f"{path}/run_id=r1", positions=True))
    return back.select("case_no", "path", "pass_fail", "score", "speed", "expected", "actual", "hit")


@register("report_field_stats", f"""WITH {dq.FIELD_SCORES_CTE}
SELECT path, round(avg(_score2), 6) AS accuracy_mean, round(avg(_pass), 6) AS pass_rate,
       round(avg(_missing), 6) AS missing_rate, count(*) AS occurrences, min(case_no) AS first_case
FROM prep GROUP BY path""")
def report_field_stats(spark, sf):
    """Field statistics of a report that only exists as files."""
    path = _new_path(spark, "csv")
    sink.write_csv(_timed_scores(spark, sf), path, "r1")
    return stats.by_field(report_scores(read_report(spark, f"{path}/run_id=r1", positions=True)), file_order=True).drop("first_pos")


def _fixed_lines(section: int, lines: list[str]) -> str:
    rows = ", ".join(f"({section}, {k}, 0, '{line}')" for k, line in enumerate(lines))
    return f"SELECT * FROM (VALUES {rows}) f(section, k1, k2, line)"


def _spaced(lines: list[str]) -> list[str]:
    return [x for line in lines for x in (line, "")]


@register("markdown_report_lines", f"""WITH {dq.FIELD_SCORES_CTE},
fs AS (SELECT path, round(avg(_score2), 6) AS m, round(avg(_pass), 6) AS p, round(avg(_missing), 6) AS x, count(*) AS n,
              min({{'c': case_no, 'p': pos}}) AS f FROM prep GROUP BY path),
cs AS (SELECT case_no, round(avg(_pass), 6) AS p, round(avg(_score2), 6) AS m FROM prep GROUP BY case_no),
ov AS (SELECT round(avg(_pass), 6) AS p, round(avg((case_no % 16) / 8), 6) AS s, count(DISTINCT case_no) AS n FROM prep),
l AS (
  {_fixed_lines(0, [sink.TITLE, "", *_spaced(sink.FIELD_SECTION), *sink.FIELD_HEADER])}
  UNION ALL SELECT 1, f.c, f.p, '| ' || path || ' | ' || printf('%.2f', m) || ' | ' || printf('%.2f', p) || ' | ' || printf('%.2f', x)
     || ' | ' || n || '/' || (SELECT n FROM ov) || ' |' FROM fs
  UNION ALL {_fixed_lines(2, ["", *_spaced(sink.CASE_SECTION), *sink.CASE_HEADER])}
  UNION ALL SELECT 3, case_no, 0, '| ' || case_no || ' | ' || printf('%.2f', p) || ' | ' || printf('%.2f', m) || ' |' FROM cs
  UNION ALL {_fixed_lines(4, ["", sink.OVERALL_SECTION, ""])}
  UNION ALL SELECT 5, k, 0, CASE k WHEN 0 THEN '- Total Pass Rate: ' || printf('%.2f', p) WHEN 1 THEN '- Average Pipeline Speed: ' || printf('%.2f', s) || ' seconds'
     WHEN 2 THEN '' ELSE '- Total Number of Test Cases: ' || n END FROM ov, range(4) t(k))
SELECT CAST(section AS INTEGER) AS section, CAST(k1 AS BIGINT) AS k1, CAST(k2 AS BIGINT) AS k2, line FROM l""")
def markdown_report_lines(spark, sf):
    scored = _timed_scores(spark, sf)
    overall = stats.overall(scored)
    total = overall.select("total_test_cases").scalar()
    return sink.markdown_lines(spark, stats.by_field(scored), stats.by_case(scored), overall, total)


# ---------------------------------------------------------------- K3-K5: artefacts of failed documents

def explaining_extractor():
    """Deterministic stand-in that explains itself: fails on some texts, and
    gives others a weight without its unit, which the record model rejects."""
    def fn(rec):
        n = len((rec["text"] or "").split())
        if n % 11 == 0:
            raise ValueError("extractor rejected the document")
        weight = {"value": n} if n % 7 == 0 else {"value": n, "unit": "kg"}
        return extract.Prediction(f"{n} words", {"weight": [weight]})
    return fn


@register("failed_artefacts", r"""
WITH w AS (SELECT CAST(doc_id AS VARCHAR) AS doc, text, len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D\x1C-\x20\x{85}\x{A0}]+')) AS n FROM documents),
f AS (SELECT *, CASE WHEN n % 11 = 0 THEN 'ValueError: extractor rejected the document' ELSE 'rejected: weight[0].unit: missing' END AS error
      FROM w WHERE n % 11 = 0 OR n % 7 = 0),
a AS (SELECT doc, 'text' AS stage, text AS content, error FROM f
  UNION ALL SELECT doc, 'reasoning', n || ' words', error FROM f WHERE n % 11 <> 0
  UNION ALL SELECT doc, 'record', '{"weight": [{"value": ' || n || '}]}', error FROM f WHERE n % 11 <> 0)
SELECT doc, stage, length(content) AS chars, md5(content) AS content_md5, error, 'r1' AS run_id FROM a""")
def failed_artefacts(spark, sf):
    """Text, reasoning and record of the documents that failed, from the store."""
    done = analyze.analyze_texts(table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text"), explaining_extractor)
    path = _new_path(spark, "artefacts")
    done.write_artefacts(path, "r1")
    back = spark.read.parquet(path)
    return back.select("doc", F.col("stage").cast("string").alias("stage"), F.length("content").cast("bigint").alias("chars"),
                       F.md5("content").alias("content_md5"), "error", F.col("run_id").cast("string").alias("run_id"))


# ---------------------------------------------------------------- D1, D4, D5

def _image_files(spark, sf):
    """An image file per part, made from its row: PNG headers, some of them
    with a wrong signature, cut short or of no width."""
    k = F.col("p_partkey")
    four = lambda c: F.lpad(F.hex(c), 8, "0")
    magic = F.when(k % 11 == 0, F.lit("FFD8FFE000104A46")).otherwise(F.lit(layout.PNG_MAGIC))
    width = F.when(k % 17 == 0, F.lit(0).cast("long")).otherwise((100 + k * 37 % 500).cast("long"))
    head = F.concat(magic, F.lit("0000000D49484452"), four(width), four((F.col("p_size") * 10).cast("long")))
    content = F.unhex(F.when(k % 13 == 0, F.left(head, F.lit(40))).otherwise(head))
    return table(spark, sf, "part").select(k.cast("string").alias("path"), content.alias("content"))


@register("image_admission", """
WITH p AS (SELECT *, p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 17 <> 0 AND p_size > 0 AS ok FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS path, CASE WHEN ok THEN CAST(100 + p_partkey * 37 % 500 AS BIGINT) END AS width,
       CASE WHEN ok THEN CAST(p_size * 10 AS BIGINT) END AS height, ok AS admitted, CASE WHEN NOT ok THEN 'Invalid image data' END AS error
FROM p""")
def image_admission(spark, sf):
    return layout.admit_images(_image_files(spark, sf))


@register("empty_documents", """
SELECT p_brand || '/' || p_size || '/' || p_type AS doc FROM part GROUP BY ALL
HAVING bool_and(p_partkey % 11 = 0 OR p_partkey % 13 = 0 OR p_partkey % 17 = 0)""")
def empty_documents(spark, sf):
    """Documents none of whose images was admitted."""
    doc = F.concat_ws("/", "p_brand", F.col("p_size").cast("string"), "p_type").alias("doc")
    parts = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("path"), doc)
    admitted = layout.admit_images(_image_files(spark, sf)).where("admitted")
    return layout.empty_documents(parts.select("doc").distinct(), parts.join(admitted, "path"))


@register("page_text_join", """
SELECT conv_id, string_agg(coalesce(text, ''), ' ' ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id""")
def page_text_join(spark, sf):
    return layout.join_page_texts(table(spark, sf, "conversations"), "conv_id", "turn", "text")


# ---------------------------------------------------------------- S1, S1b: cases of a file inventory
# A table of paths and lengths, as an object store's inventory gives it: images
# in several spellings, some of zero bytes, goldens missing, directories
# without files, and files that belong to no case.

_LISTED = [
    ("p_partkey % 3 <> 0", "'label_' || p_partkey || '/image_1.png'", "p_size"),
    ("p_partkey % 4 = 1", "'label_' || p_partkey || '/image_2.JPG'", "0"),
    ("p_partkey % 5 <> 2", "'label_' || p_partkey || '/expected_output.json'", "p_size * 7"),
    ("p_partkey % 9 = 0", "'label_' || p_partkey || '/scan.jpeg'", "p_size"),
    ("p_partkey % 6 = 0", "'label_' || p_partkey || '/'", "0"),
    ("p_partkey % 7 = 0", "'label_' || p_partkey || '/old/image_3.png'", "p_size"),
    ("p_partkey % 8 = 0", "'other_' || p_partkey || '/image_1.png'", "p_size"),
]
_ROOT = "s3://bucket/labels"


@register("case_inventory", f"""
WITH f AS ({' UNION ALL '.join(f"SELECT {path} AS path FROM part WHERE {when}" for when, path, _ in _LISTED)}),
c AS (SELECT split_part(path, '/', 1) AS case_dir, split_part(path, '/', 2) AS name, path FROM f
      WHERE path LIKE 'label_%' AND length(path) - length(replace(path, '/', '')) = 1),
g AS (SELECT case_dir, count(*) FILTER (lower(name) LIKE '%.png' OR lower(name) LIKE '%.jpg') AS n_images,
             max(CASE WHEN name = 'expected_output.json' THEN '{_ROOT}/' || path END) AS golden FROM c GROUP BY case_dir)
SELECT '{_ROOT}/' || case_dir AS dir, case_dir, n_images, golden,
       concat_ws('; ', CASE WHEN n_images = 0 THEN 'No image files found' END, CASE WHEN golden IS NULL THEN 'Expected output JSON not found' END) AS issues,
       CASE WHEN n_images > 0 AND golden IS NOT NULL THEN row_number() OVER (PARTITION BY n_images > 0 AND golden IS NOT NULL ORDER BY case_dir) END AS case_no
FROM g""")
def case_inventory(spark, sf):
    from ..sources import cases
    part = table(spark, sf, "part")
    one = lambda when, path, size: part.where(when).select(F.expr(f"concat('{_ROOT}/', {path})").alias("path"), F.expr(size).cast("long").alias("length"))
    files = one(*_LISTED[0])
    for row in _LISTED[1:]:
        files = files.union(one(*row))
    found = durable(cases.inventory_of(cases.listed_files(files, _ROOT)), "inventory")
    numbers = cases.number_cases(found.where(F.size("issues") == 0)).select("case_dir", F.col("case_no").cast("long").alias("case_no"))
    return found.join(numbers, "case_dir", "left").select("dir", "case_dir", F.col("n_images").cast("long").alias("n_images"), "golden",
                                                          F.concat_ws("; ", "issues").alias("issues"), "case_no")


# ---------------------------------------------------------------- N9: the nutrients of a guaranteed analysis
# Null, absent and filled lists, an entry without its required name, no analysis.

_ANALYSIS = """CASE WHEN p_partkey % 20 = 6 THEN '{"guaranteed_analysis_en": {"title": "T", "nutrients": [{"nutrient": null, "value": 1, "unit": "%"}]}}'
  WHEN p_partkey % 4 = 0 THEN '{"guaranteed_analysis_en": {"title": "T", "nutrients": null}}'
  WHEN p_partkey % 4 = 1 THEN '{"guaranteed_analysis_en": {"title": "T"}}'
  WHEN p_partkey % 4 = 2 THEN '{"guaranteed_analysis_en": {"title": "T", "nutrients": [{"nutrient": "N' || CAST(p_size AS STRING) || '", "value": "about '
    || CAST(p_size AS STRING) || '.5 percent", "unit": "%"}, {"nutrient": "P", "value": -3, "unit": null}]}}'
  ELSE '{"guaranteed_analysis_en": null}' END"""


@register("nutrient_standardize", """
WITH p AS (SELECT p_partkey, p_size, p_partkey % 20 <> 6 AS accepted, CASE WHEN p_partkey % 20 = 6 THEN -1 ELSE p_partkey % 4 END AS form FROM part)
SELECT p_partkey, accepted, CASE WHEN accepted THEN form <> 3 END AS has_analysis,
       CAST(CASE WHEN form IN (0, 1) THEN 0 WHEN form = 2 THEN 2 END AS BIGINT) AS n_nutrients,
       CASE WHEN form IN (0, 1) THEN '' WHEN form = 2 THEN 'N' || p_size || '=' || p_size || '.5 %;P=-3.0 ' END AS nutrients
FROM p""")
def nutrient_standardize(spark, sf):
    from ..operators import standardize
    raw = table(spark, sf, "part").select("p_partkey", F.expr(_ANALYSIS).alias("doc"))
    std = standardize.standardize(raw, "doc", ["p_partkey"])
    accepted, analysis = F.size("_issues") == 0, F.col("record")["guaranteed_analysis_en"]
    shown = F.transform(analysis["nutrients"], lambda n: F.concat(n["nutrient"], F.lit("="), n["value"].cast("string"), F.lit(" "), F.coalesce(n["unit"], F.lit(""))))
    there = accepted & analysis.isNotNull()
    return std.select("p_partkey", accepted.alias("accepted"), F.when(accepted, analysis.isNotNull()).alias("has_analysis"),
                      F.when(there, F.size(analysis["nutrients"])).cast("long").alias("n_nutrients"), F.when(there, F.array_join(shown, ";")).alias("nutrients"))
