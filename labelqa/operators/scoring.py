"""Match expected leaves to produced leaves and score each pair.

Two physical shapes of the same left join on path (E2):

* ``score_records``: expected and produced leaves sit in the same row (the
  produced record is computed from the case row, or the two record tables
  were joined once on the case key). The match is a per-row map lookup,
  so scoring adds no shuffle at all.
* ``score_leaves``: two long leaf tables, left-joined on ``(case, path)``;
  one shuffle on a key that is unique per case, so it cannot skew.

A miss is detected with a join marker (``hit``), never by comparing with
the sentinel text (T9); the sentinel is written only by the report sink.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import PASS_THRESHOLD, pass_fail, similarity


def compare_text(value: Column, kind: Column) -> Column:
    """Text the assessment compares: Python ``str``; a null leaf is ``None``."""
    return F.when(kind == "null", F.lit("None")).otherwise(value)


def _score_columns(threshold: float) -> list[Column]:
    e_txt = compare_text(F.col("expected"), F.col("expected_kind"))
    a_txt = compare_text(F.col("actual"), F.col("actual_kind"))
    score = F.when(F.col("hit"), similarity(e_txt, a_txt)).otherwise(F.lit(0.0))
    return [score.alias("score")]


def _finish(df: DataFrame, threshold: float) -> DataFrame:
    df = df.select("*", *_score_columns(threshold))
    return df.withColumn("pass_fail", pass_fail(F.col("score"), threshold))


def score_records(df: DataFrame, expected: str, actual: str, keep: list[str],
                  threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Score per row; ``expected``/``actual`` are leaf arrays (see ``leaves``)."""
    def entries(part: Column) -> Column:
        return F.map_from_entries(F.transform(
            part, lambda a: F.struct(a["path"], F.struct(a["value"].alias("v"), a["kind"].alias("k")))))

    # a map lookup scans its keys: large records get about sqrt(n) maps by hash of the path
    n = F.greatest(F.lit(1), F.sqrt(F.size(actual)).cast("int"))
    marked = F.transform(F.col(actual), lambda a: F.struct(F.pmod(F.xxhash64(a["path"]), n).alias("h"), a.alias("a")))
    many = F.transform(F.sequence(F.lit(0), n - 1), lambda b: entries(
        F.transform(F.filter(marked, lambda m: m["h"] == b), lambda m: m["a"])))
    small = F.coalesce(F.size(actual), F.lit(0)) <= 64
    df = df.select("*", F.when(small, F.array(entries(F.col(actual)))).otherwise(many).alias("__maps"))

    def looked_up(path: Column) -> Column:
        place = F.pmod(F.xxhash64(path), F.size("__maps")).cast("int")
        return F.try_element_at(F.col("__maps")[place], path)

    pairs = F.transform(F.col(expected), lambda e: F.struct(
        e["pos"].alias("pos"), e["path"].alias("path"),
        e["value"].alias("expected"), e["kind"].alias("expected_kind"),
        looked_up(e["path"]).alias("_a")))
    long = df.select(*keep, F.inline(pairs))
    hit = F.col("_a").isNotNull()
    e_txt = compare_text(F.col("expected"), F.col("expected_kind"))
    a_txt = compare_text(F.col("_a.v"), F.col("_a.k"))
    score = F.when(hit, similarity(e_txt, a_txt)).otherwise(F.lit(0.0))
    # one projection: actual, hit, score and label together
    return long.select(
        *keep, "pos", "path", "expected", "expected_kind",
        F.col("_a.v").alias("actual"), F.col("_a.k").alias("actual_kind"), hit.alias("hit"),
        score.alias("score"), pass_fail(score, threshold).alias("pass_fail"))


def score_leaves(expected: DataFrame, actual: DataFrame, keys: list[str],
                 threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Left join long leaf tables on ``keys + path``; extra produced leaves ignored."""
    e = expected.select(*keys, "pos", "path", F.col("value").alias("expected"),
                        F.col("kind").alias("expected_kind"))
    a = actual.select(*keys, "path", F.col("value").alias("actual"),
                      F.col("kind").alias("actual_kind"), F.lit(True).alias("hit"))
    j = e.join(a, [*keys, "path"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return _finish(j, threshold)


# ------------------------------------------------------------ record checks

def key_value_scores(df: DataFrame, expected_json: str, actual_json: str,
                     keep: list[str], render: str = "json") -> DataFrame:
    """Per top-level expected key, similarity of the whole rendered value.

    ``render="json"``: values as JSON text (strings unquoted), all in the JVM.
    ``render="python"``: values as Python ``str()`` of the parsed value
    (``{'a': 1}``, ``['x']``, ``None``, ``True``), exactly what the
    reference compares; a small pandas UDF renders each document's top-level
    values, the similarity stays in the JVM. An absent produced key scores
    against the empty string. The key list of one record is exploded in
    place (bounded by the record), no shuffle.
    """
    if render == "python":
        e = _python_values(F.col(expected_json))
        a = _python_values(F.col(actual_json))
        rec = df.select(*keep, e.alias("_e"), a.alias("_a"))
        x = rec.select(*keep, "_a", F.explode("_e").alias("key", "expected"))
        act = F.try_element_at(F.col("_a"), F.col("key"))
        return x.select(*keep, "key", "expected", act.alias("actual"),
                        similarity(F.col("expected"), act).alias("score"))
    # each document is parsed once, whatever its number of keys
    parsed = df.select(*keep, F.from_json(expected_json, "map<string,string>").alias("_e"),
                       F.from_json(actual_json, "map<string,string>").alias("_a"))
    rows = parsed.select(*keep, "_a", F.explode("_e").alias("key", "expected"))
    act = F.try_element_at(F.col("_a"), F.col("key"))
    return rows.select(*keep, "key", "expected", act.alias("actual"),
                       similarity(F.col("expected"), act).alias("score"))


def _render_values(text):
    """Top-level ``(key, str(value))`` pairs of a JSON object (Python ``str``)."""
    if text is None:
        return None
    try:
        doc = json.loads(text)
    except ValueError:
        return None
    if not isinstance(doc, dict):
        return None
    return {k: str(v) for k, v in doc.items()}


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def _python_values_udf(s: pd.Series) -> pd.Series:
    return s.map(_render_values)


def _python_values(col: Column) -> Column:
    return _python_values_udf(col)


def missing_keys(expected_keys: Column, actual_keys: Column) -> Column:
    """Expected top-level keys absent from the produced record."""
    return F.array_except(expected_keys, F.coalesce(actual_keys, F.array().cast("array<string>")))


def contains_value(arr: Column, value, unit) -> Column:
    """Does an array of ``struct<value, unit>`` hold this pair (null-safe)?"""
    return F.exists(arr, lambda e: e["value"].eqNullSafe(value) & e["unit"].eqNullSafe(unit))


def contains_rendered(arr: Column, text: str) -> Column:
    """Does a text occur in the rendered list (nulls kept, like a
    record's string form)? Rendering is JSON text."""
    return F.contains(F.to_json(arr, {"ignoreNullFields": "false"}), F.lit(text))


def word_pattern(word: str) -> str:
    """``\\bword\\b`` with Unicode word characters, same in Java, RE2 and Python."""
    import re
    return r"(^|[^\p{L}\p{N}_])" + re.escape(word) + r"($|[^\p{L}\p{N}_])"


def patterns_present(text: Column, words: list[str]) -> Column:
    """One boolean per word (array, in the given order); plan-time list.

    One ``rlike`` per word: each stops at the first occurrence, which
    measured faster than a single pass extracting every occurrence of all
    words (common words occur many times per text).
    """
    return F.array(*[text.rlike(word_pattern(w)) for w in words])
