"""Queries over the driver tables, one per operator family, with DuckDB oracles.

Each query reads whole tables and returns a DataFrame; ``ORACLE`` holds the
equivalent DuckDB SQL over the same parquet tables. Computed columns carry
the same names on both sides; averages are rounded to six decimals on both
sides (summation order differs between engines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import phone, rules
from ..operators import edit_distance, extract, layout, leaves, patterns, scoring, shapes, standardize, stats
from ..sinks.reports import field_rows
from ..session import durable
from ..sources.tables import table

ORACLE: dict[str, str] = {}
QUERIES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- E1-E5
# Expected records are customer / supplier rows; the produced record is a
# deterministic perturbation of the same row (an extractor's output keyed
# by the case row), so expected and produced leaves meet in the same row
# and scoring adds no shuffle.

CUSTOMER_EXPECTED = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("nation", T.IntegerType()), T.StructField("balance", T.DoubleType())])
CUSTOMER_PRODUCED = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("nation", T.DoubleType()), T.StructField("balance", T.DoubleType())])
SUPPLIER_RECORD = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType()),
    T.StructField("balance", T.DoubleType())])


def _customer_leaves(c: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    expected = F.struct(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    produced = F.struct(
        F.when(k % 7 == 0, F.regexp_replace("c_name", "0", "")).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 5 == 1, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").cast("double").alias("nation"),
        F.when(k % 3 == 0, F.floor("c_acctbal").cast("double")).otherwise(F.col("c_acctbal")).alias("balance"))
    rec = c.select((k * 2).alias("case_no"), (F.col("c_acctbal") < 0).alias("__debt"),
                   expected.cast(CUSTOMER_EXPECTED).alias("__e"),
                   produced.cast(CUSTOMER_PRODUCED).alias("__p"))
    a_leaves = leaves.typed_leaves("__p", CUSTOMER_PRODUCED)
    # the extractor returns no segment for accounts in debt
    a_leaves = F.filter(a_leaves, lambda x: ~((x["path"] == "segment") & F.col("__debt")))
    return rec.select("case_no", leaves.typed_leaves("__e", CUSTOMER_EXPECTED).alias("e"),
                     a_leaves.alias("a"))


def _supplier_leaves(s: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    expected = F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
                        F.col("s_acctbal").alias("balance"))
    produced = F.struct(
        F.when(k % 4 == 0, F.upper("s_name")).otherwise(F.col("s_name")).alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.when(k % 3 == 1, F.col("s_acctbal") + F.lit(1.0)).otherwise(F.col("s_acctbal")).alias("balance"))
    rec = s.select((k * 2 + 1).alias("case_no"), (F.col("s_acctbal") < 0).alias("__debt"),
                   expected.cast(SUPPLIER_RECORD).alias("__e"),
                   produced.cast(SUPPLIER_RECORD).alias("__p"))
    a_leaves = leaves.typed_leaves("__p", SUPPLIER_RECORD)
    # the extractor returns no nation for suppliers in debt
    a_leaves = F.filter(a_leaves, lambda x: ~((x["path"] == "nation") & F.col("__debt")))
    return rec.select("case_no", leaves.typed_leaves("__e", SUPPLIER_RECORD).alias("e"),
                     a_leaves.alias("a"))


SCORE_COLS = ["case_no", "pos", "path", "expected", "actual", "hit", "score", "pass_fail"]


def field_scores_df(spark: SparkSession, sf: str) -> DataFrame:
    c = scoring.score_records(_customer_leaves(table(spark, sf, "customer")), "e", "a", ["case_no"])
    s = scoring.score_records(_supplier_leaves(table(spark, sf, "supplier")), "e", "a", ["case_no"])
    return c.select(*SCORE_COLS).unionByName(s.select(*SCORE_COLS))


_SIM = """CASE WHEN greatest(length({e}), length({a})) = 0 THEN CAST(100 AS DOUBLE)
            WHEN {e} = {a} THEN CAST(100 AS DOUBLE)
            ELSE (CAST(1 AS DOUBLE) - levenshtein({e}, {a}) / greatest(length({e}), length({a})))
                 * CAST(100 AS DOUBLE) END"""

FIELD_SCORES_CTE = f"""
exp AS (
  SELECT c_custkey * 2 AS case_no, 0 AS pos, 'name' AS path, c_name AS expected FROM customer
  UNION ALL SELECT c_custkey * 2, 1, 'segment', c_mktsegment FROM customer
  UNION ALL SELECT c_custkey * 2, 2, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey * 2, 3, 'balance', CAST(c_acctbal AS VARCHAR) FROM customer
  UNION ALL SELECT s_suppkey * 2 + 1, 0, 'name', s_name FROM supplier
  UNION ALL SELECT s_suppkey * 2 + 1, 1, 'nation', CAST(s_nationkey AS VARCHAR) FROM supplier
  UNION ALL SELECT s_suppkey * 2 + 1, 2, 'balance', CAST(s_acctbal AS VARCHAR) FROM supplier
),
act AS (
  SELECT c_custkey * 2 AS case_no, 'name' AS path,
         CASE WHEN c_custkey % 7 = 0 THEN replace(c_name, '0', '') ELSE c_name END AS actual
  FROM customer
  UNION ALL SELECT c_custkey * 2, 'segment',
         CASE WHEN c_custkey % 5 = 1 THEN lower(c_mktsegment) ELSE c_mktsegment END
  FROM customer WHERE NOT c_acctbal < 0
  UNION ALL SELECT c_custkey * 2, 'nation', CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey * 2, 'balance',
         CAST(CASE WHEN c_custkey % 3 = 0 THEN floor(c_acctbal) ELSE c_acctbal END AS VARCHAR)
  FROM customer
  UNION ALL SELECT s_suppkey * 2 + 1, 'name',
         CASE WHEN s_suppkey % 4 = 0 THEN upper(s_name) ELSE s_name END FROM supplier
  UNION ALL SELECT s_suppkey * 2 + 1, 'nation', CAST(s_nationkey AS VARCHAR)
  FROM supplier WHERE NOT s_acctbal < 0
  UNION ALL SELECT s_suppkey * 2 + 1, 'balance',
         CAST(CASE WHEN s_suppkey % 3 = 1 THEN s_acctbal + 1.0E0 ELSE s_acctbal END AS VARCHAR)
  FROM supplier
),
scored AS (
  SELECT e.case_no, e.pos, e.path, e.expected, a.actual, a.path IS NOT NULL AS hit,
         CASE WHEN a.path IS NULL THEN CAST(0 AS DOUBLE) ELSE
           {_SIM.format(e="coalesce(e.expected, 'None')", a="coalesce(a.actual, 'None')")} END AS score
  FROM exp e LEFT JOIN act a ON e.case_no = a.case_no AND e.path = a.path
),
scores AS (
  SELECT *, CASE WHEN score >= 80.0E0 THEN 'Pass' ELSE 'Fail' END AS pass_fail FROM scored
),
prep AS (
  SELECT *, CAST(pass_fail = 'Pass' AS INTEGER) AS _pass, CAST(NOT hit AS INTEGER) AS _missing,
         CAST(printf('%.2f', score) AS DOUBLE) AS _score2
  FROM scores
)"""


@register("field_scores", f"WITH {FIELD_SCORES_CTE} SELECT {', '.join(SCORE_COLS)} FROM scores")
def field_scores(spark, sf):
    return field_scores_df(spark, sf)


@register("field_stats", f"""WITH {FIELD_SCORES_CTE}
SELECT path, round(avg(_score2), 6) AS accuracy_mean, round(avg(_pass), 6) AS pass_rate,
       round(avg(_missing), 6) AS missing_rate, count(*) AS occurrences,
       min({{'c': case_no, 'p': pos}}).c AS first_case, min({{'c': case_no, 'p': pos}}).p AS first_pos
FROM prep GROUP BY path""")
def field_stats(spark, sf):
    return stats.by_field(field_scores_df(spark, sf))


@register("case_stats", f"""WITH {FIELD_SCORES_CTE}
SELECT case_no, round(avg(_pass), 6) AS overall_pass_rate,
       round(avg(_score2), 6) AS average_accuracy_score, count(*) AS n_fields
FROM prep GROUP BY case_no""")
def case_stats(spark, sf):
    return stats.by_case(field_scores_df(spark, sf))


@register("overall_stats", f"""WITH {FIELD_SCORES_CTE}
SELECT round(avg(_pass), 6) AS total_pass_rate, CAST(NULL AS DOUBLE) AS average_pipeline_speed,
       count(DISTINCT case_no) AS total_test_cases, count(*) AS total_fields
FROM prep""")
def overall_stats(spark, sf):
    return stats.overall(field_scores_df(spark, sf))


@register("stats_grouping_sets", f"""WITH {FIELD_SCORES_CTE}
SELECT CASE WHEN grouping(path) = 0 THEN 'field' WHEN grouping(case_no) = 0 THEN 'case'
            ELSE 'overall' END AS level,
       path, case_no, round(avg(_score2), 6) AS accuracy_mean, round(avg(_pass), 6) AS pass_rate,
       round(avg(_missing), 6) AS missing_rate, count(*) AS n
FROM prep GROUP BY GROUPING SETS ((path), (case_no), ())""")
def stats_grouping_sets(spark, sf):
    return stats.grouping_sets(field_scores_df(spark, sf))


@register("markdown_field_rows", f"""WITH {FIELD_SCORES_CTE},
fs AS (
  SELECT path, round(avg(_score2), 6) AS accuracy_mean, round(avg(_pass), 6) AS pass_rate,
         round(avg(_missing), 6) AS missing_rate, count(*) AS occurrences
  FROM prep GROUP BY path
)
SELECT path, '| ' || path || ' | ' || printf('%.2f', accuracy_mean) || ' | ' || printf('%.2f', pass_rate)
       || ' | ' || printf('%.2f', missing_rate) || ' | ' || CAST(occurrences AS VARCHAR) || '/'
       || CAST((SELECT count(DISTINCT case_no) FROM prep) AS VARCHAR) || ' |' AS line
FROM fs""")
def markdown_field_rows(spark, sf):
    scored = durable(field_scores_df(spark, sf), "scores")     # scored once, read by both
    total = stats.overall(scored).select("total_test_cases").scalar()
    return field_rows(stats.by_field(scored), total).select("path", "line")


# ---------------------------------------------------------------- N1-N10

@register("first_number", r"""
SELECT 'part' AS src, p_partkey AS id,
       nullif(regexp_extract(p_brand, '[0-9]+(\.[0-9]+)?', 0), '') AS num_text,
       CAST(nullif(regexp_extract(p_brand, '[0-9]+(\.[0-9]+)?', 0), '') AS DOUBLE) AS num
FROM part
UNION ALL
SELECT 'orders', o_orderkey, nullif(regexp_extract(o_orderpriority, '[0-9]+(\.[0-9]+)?', 0), ''),
       CAST(nullif(regexp_extract(o_orderpriority, '[0-9]+(\.[0-9]+)?', 0), '') AS DOUBLE)
FROM orders
UNION ALL
SELECT 'documents', doc_id, nullif(regexp_extract(text, '[0-9]+(\.[0-9]+)?', 0), ''),
       CAST(nullif(regexp_extract(text, '[0-9]+(\.[0-9]+)?', 0), '') AS DOUBLE)
FROM documents""")
def first_number(spark, sf):
    def one(df, src, key, col):
        return df.select(F.lit(src).alias("src"), F.col(key).alias("id"),
                         rules.first_number(col).alias("num_text"),
                         rules.number_from_string(col).alias("num"))
    return (one(table(spark, sf, "part"), "part", "p_partkey", "p_brand")
            .unionByName(one(table(spark, sf, "orders"), "orders", "o_orderkey", "o_orderpriority"))
            .unionByName(one(table(spark, sf, "documents"), "documents", "doc_id", "text")))


@register("website_standardize", """
SELECT page_id, url,
       lower(CASE WHEN starts_with(url, 'www.') THEN url ELSE 'www.' || url END) AS website
FROM pages""")
def website_standardize(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", "url", rules.website("url").alias("website"))


def _grade_raw() -> "F.Column":
    n = F.floor("l_quantity").cast("string")
    p = F.round(F.col("l_discount") * 100).cast("bigint").cast("string")
    k = F.round(F.col("l_tax") * 100).cast("bigint").cast("string")
    ln = F.col("l_linenumber")
    return (F.when(ln == 4, F.concat(n, F.lit(".5-"), p, F.lit("-"), k))
            .when(ln == 5, F.concat(n, F.lit(" - "), p, F.lit(" - "), k))
            .when(ln == 6, F.concat(n, F.lit(":"), p, F.lit(":"), k))
            .when(ln == 7, F.concat(n, F.lit("--"), p))
            .otherwise(F.concat(n, F.lit("-"), p, F.lit("-"), k)))


_GRADE_RAW_SQL = """
  CASE l_linenumber
    WHEN 4 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.5-' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR)
    WHEN 5 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || ' - ' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || ' - ' || CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR)
    WHEN 6 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR)
    WHEN 7 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '--' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR)
    ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR)
  END"""


@register("grade_validate", f"""
WITH g AS (SELECT l_orderkey, l_linenumber, {_GRADE_RAW_SQL} AS raw FROM lineitem),
v AS (SELECT *, CASE WHEN regexp_full_match(raw, '[0-9]+(\\.[0-9]+)?-[0-9]+(\\.[0-9]+)?-[0-9]+(\\.[0-9]+)?')
                     THEN raw END AS grade FROM g)
SELECT l_orderkey, l_linenumber, raw, grade,
       CAST(split_part(grade, '-', 1) AS DOUBLE) AS n,
       CAST(split_part(grade, '-', 2) AS DOUBLE) AS p,
       CAST(split_part(grade, '-', 3) AS DOUBLE) AS k
FROM v""")
def grade_validate(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", _grade_raw().alias("raw"))
    parts = rules.grade_parts("raw")
    return li.select("l_orderkey", "l_linenumber", "raw", rules.grade("raw").alias("grade"),
                     parts["n"].alias("n"), parts["p"].alias("p"), parts["k"].alias("k"))


@register("registration_validate", """
WITH r AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber
      WHEN 3 THEN lpad(CAST(l_orderkey AS VARCHAR), 7, '0') || lower(l_returnflag)
      WHEN 5 THEN lpad(CAST(l_orderkey AS VARCHAR), 7, '0') || l_returnflag || 'X'
      WHEN 6 THEN lpad(CAST(l_orderkey AS VARCHAR), 6, '0') || l_returnflag
      ELSE lpad(CAST(l_orderkey AS VARCHAR), 7, '0') || l_returnflag END AS raw_id,
    CASE WHEN l_linenumber = 2 THEN upper(CASE l_linestatus WHEN 'O' THEN 'fertilizer_product'
                                                            ELSE 'ingredient_component' END)
         WHEN l_linestatus = 'O' THEN 'fertilizer_product' ELSE 'ingredient_component' END AS raw_type
  FROM lineitem)
SELECT l_orderkey, l_linenumber, raw_id,
       CASE WHEN regexp_full_match(raw_id, '[0-9]{7}[A-Z]') THEN raw_id END AS identifier,
       raw_type,
       CASE WHEN raw_type IN ('ingredient_component', 'fertilizer_product') THEN raw_type END AS type
FROM r""")
def registration_validate(spark, sf):
    li = table(spark, sf, "lineitem")
    key7 = F.lpad(F.col("l_orderkey").cast("string"), 7, "0")
    ln = F.col("l_linenumber")
    raw_id = (F.when(ln == 3, F.concat(key7, F.lower("l_returnflag")))
              .when(ln == 5, F.concat(key7, F.col("l_returnflag"), F.lit("X")))
              .when(ln == 6, F.concat(F.lpad(F.col("l_orderkey").cast("string"), 6, "0"),
                                      F.col("l_returnflag")))
              .otherwise(F.concat(key7, F.col("l_returnflag"))))
    base = F.when(F.col("l_linestatus") == "O", F.lit("fertilizer_product")).otherwise(
        F.lit("ingredient_component"))
    raw_type = F.when(ln == 2, F.upper(base)).otherwise(base)
    r = li.select("l_orderkey", "l_linenumber", raw_id.alias("raw_id"), raw_type.alias("raw_type"))
    return r.select("l_orderkey", "l_linenumber", "raw_id",
                    rules.registration_id("raw_id").alias("identifier"), "raw_type",
                    rules.registration_type("raw_type").alias("type"))


# The same fields for an engine without look-around: the neighbours are part
# of the match and group 1 is the field.
_PHONE_FIND_SQL = r"(?:^|[^0-9A-Za-z+\-]|(?:^|[^0-9])-)(" + extract.PHONE_FORMS + ")"
_REGISTRATION_FIND_SQL = r"(?:^|[^0-9A-Za-z])([0-9]{7}[A-Z])(?:$|[^0-9A-Za-z])"
_GRADE_FIND_SQL = (r"(?:^|[^0-9A-Za-z.\-])([0-9]{1,3}(?:\.[0-9]+)?-[0-9]{1,3}(?:\.[0-9]+)?-[0-9]{1,3}(?:\.[0-9]+)?)"
                   r"(?:$|[^0-9A-Za-z\-])")


def _phone_sql(col: str) -> str:
    return phone.to_e164_sql(col)


def _customer_phone(k="c_custkey", n="c_nationkey"):
    return f"""CASE {n} % 8
      WHEN 0 THEN '(' || CAST(200 + {k} % 800 AS VARCHAR) || ') 555-' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')
      WHEN 1 THEN '1-' || CAST(200 + {k} % 800 AS VARCHAR) || '-555-' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')
      WHEN 2 THEN '+44 20 7946 ' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')
      WHEN 3 THEN CAST(100 + {k} % 900 AS VARCHAR) || ' 555 ' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') || ' ext'
      WHEN 4 THEN 'Tel: 1-800-' || CASE {k} % 3 WHEN 0 THEN 'GOT-JUNK' WHEN 1 THEN 'FLOWERS' ELSE 'CALL-NOW' END
      WHEN 5 THEN '(' || CAST(200 + {k} % 800 AS VARCHAR) || ') 555-' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')
                  || ' ext. ' || CAST({k} % 100 AS VARCHAR)
      WHEN 6 THEN '011 44 20 7946 ' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')
      ELSE 'Phone ' || CAST(200 + {k} % 800 AS VARCHAR) || '.555.' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')
           || ' or fax' END"""


# Numbers inside running text in the forms that people write. The SQL knows
# what stands in each text and its number; it does not search.
_LAST4 = "lpad(CAST(c_custkey % 10000 AS {t}), 4, '0')"
_WRITTEN = [  # text before, number, text after, E.164
    ("'ring '", "'011 44 20 7946 ' || {l}", "' soon'", "'+44207946' || {l}"),
    ("'free ('", "'1-800-327-' || {l}", "')'", "'+1800327' || {l}"),
    ("'at '", "'450 - 655 - ' || {l}", "''", "'+1450655' || {l}"),
    ("'Tel-'", "'450-655-' || {l}", "', daily'", "'+1450655' || {l}"),
    ("'call '", "'(450)  655-' || {l}", "' now'", "'+1450655' || {l}"),
    ("''", "'450/655/' || {l}", "'.'", "'+1450655' || {l}"),
    ("'dial '", "'1-800-GOT-JUNK'", "', box ' || c_custkey", "'+18004685865'"),
]


def _written(part, t="VARCHAR"):
    """The chosen parts of the form that a customer's key picks."""
    pick = lambda row: " || ".join(row[k].replace("{l}", _LAST4.format(t=t)) for k in part)
    return "CASE c_custkey % 7 " + " ".join(f"WHEN {i} THEN {pick(row)}" for i, row in enumerate(_WRITTEN)) + " END"


@register("phone_standardize", f"""
WITH c AS (SELECT doc_id, regexp_extract_all(text, '{_PHONE_FIND_SQL}', 1) AS arr FROM documents),
cand AS (
  SELECT 'documents' AS src, doc_id AS id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos,
         unnest(arr) AS raw
  FROM c
  UNION ALL
  SELECT 'customer', c_custkey, 0, {_customer_phone()} FROM customer
)
SELECT src, id, pos, raw, {_phone_sql('raw')} AS e164 FROM cand
UNION ALL SELECT 'written', c_custkey, 0, {_written([1])}, {_written([3])} FROM customer""")
def phone_standardize(spark, sf):
    # candidates keep their position in the text: narrow, no grouping shuffle
    texts = table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text").unionByName(
        table(spark, sf, "customer").select(F.lit("written").alias("src"), F.col("c_custkey").alias("id"), F.expr(_written([0, 1, 2], "STRING")).alias("text")))
    docs = texts.select("src", "id", F.posexplode(F.regexp_extract_all("text", F.lit(extract.PHONE_FIND_RE), 0)).alias("pos", "raw"))
    cust = table(spark, sf, "customer").select(
        F.lit("customer").alias("src"), F.col("c_custkey").alias("id"), F.lit(0).alias("pos"),
        F.expr(_customer_phone().replace("VARCHAR", "STRING")).alias("raw"))
    return docs.unionByName(cust).select("src", "id", "pos", "raw", phone.to_e164("raw").alias("e164"))


_TITLE_SQL = """CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN ''
  ELSE 'Guaranteed ' || CASE p_type WHEN 'SMALL' THEN 'minimum ' WHEN 'ECONOMY' THEN 'Minimal '
                                    WHEN 'PROMO' THEN 'subminimal ' WHEN 'LARGE' THEN 'MINIM '
                                    ELSE '' END || p_name || ' analysis' END"""
_INCOMING_SQL = "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 2 = 0 END"


@register("minimal_title", f"""
WITH t AS (SELECT p_partkey, {_TITLE_SQL} AS title, {_INCOMING_SQL} AS incoming FROM part)
SELECT p_partkey, title, incoming,
       CASE WHEN length(title) > 0 THEN regexp_matches(title, '(?i)\\bminim\\w*\\b') ELSE incoming END
         AS is_minimal
FROM t""")
def minimal_title(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.expr(_TITLE_SQL).alias("title"), F.expr(_INCOMING_SQL).alias("incoming"))
    return p.select("p_partkey", "title", "incoming",
                    rules.is_minimal("title", "incoming").alias("is_minimal"))


@register("null_list_default", """
WITH agg AS (
  SELECT l_orderkey, count(*) AS n, list_sort(list_distinct(list(l_returnflag))) AS flags
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(n, 0) AS n_items,
       CAST(len(coalesce(flags, [])) AS INTEGER) AS n_flags, array_to_string(coalesce(flags, []), ',') AS flags
FROM orders LEFT JOIN agg ON o_orderkey = l_orderkey""")
def null_list_default(spark, sf):
    # per-order list of distinct return flags: bounded by the flag domain,
    # built with partial aggregation; orders without items get [].
    agg = (table(spark, sf, "lineitem").groupBy("l_orderkey")
           .agg(F.count(F.lit(1)).alias("n"),
                F.array_sort(F.collect_set("l_returnflag")).alias("flags")))
    o = table(spark, sf, "orders").select("o_orderkey")
    j = o.join(agg, o.o_orderkey == agg.l_orderkey, "left")
    flags = rules.empty_if_null("flags", "string")
    return j.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_items"),
                    F.size(flags).alias("n_flags"), F.array_join(flags, ",").alias("flags"))


# ---------------------------------------------------------------- D2, D3, D5
# Parts as images of documents (one document per brand): width derived from
# the key, height from the size; ordered by key within the brand.

def _manifest(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("doc"), F.col("p_partkey").alias("seq"),
        (F.lit(100) + (F.col("p_partkey") * 37) % 500).cast("bigint").alias("width"),
        (F.col("p_size") * 10).cast("bigint").alias("height"))


_MANIFEST_SQL = """m AS (SELECT p_brand AS doc, p_partkey AS seq,
    CAST(100 + (p_partkey * 37) % 500 AS BIGINT) AS width, CAST(p_size * 10 AS BIGINT) AS height
  FROM part)"""


@register("composite_layout", f"""WITH {_MANIFEST_SQL}
SELECT doc, seq, width, height, CAST(0 AS BIGINT) AS x,
  CAST(coalesce(sum(height) OVER (PARTITION BY doc ORDER BY seq
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS y,
  CAST(max(width) OVER (PARTITION BY doc) AS BIGINT) AS canvas_width,
  CAST(sum(height) OVER (PARTITION BY doc) AS BIGINT) AS canvas_height
FROM m""")
def composite_layout(spark, sf):
    return layout.composite_layout(_manifest(spark, sf))


@register("page_layout", f"""WITH {_MANIFEST_SQL}
SELECT doc, seq, row_number() OVER (PARTITION BY doc ORDER BY seq) AS page_no,
  count(*) OVER (PARTITION BY doc) AS n_pages,
  612.0E0 AS page_width, 792.0E0 AS page_height,
  612.0E0 / width AS scale_x, 792.0E0 / height AS scale_y
FROM m""")
def page_layout(spark, sf):
    return layout.page_layout(_manifest(spark, sf))


@register("page_text_concat", """
WITH p AS (SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS len FROM conversations),
s AS (
  SELECT conv_id, turn, len,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS page_no,
    coalesce(sum(len) OVER (PARTITION BY conv_id ORDER BY turn
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      + (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) AS start_pos,
    count(*) OVER (PARTITION BY conv_id) AS n_pages,
    sum(len) OVER (PARTITION BY conv_id) + count(*) OVER (PARTITION BY conv_id) - 1 AS total_len
  FROM p)
SELECT conv_id, turn, page_no, CAST(start_pos AS BIGINT) AS start_pos,
       CAST(start_pos + len AS BIGINT) AS end_pos, n_pages, CAST(total_len AS BIGINT) AS total_len
FROM s""")
def page_text_concat(spark, sf):
    conv = table(spark, sf, "conversations")
    return layout.page_spans(conv, "conv_id", "turn", "text")


# Pages as a text recogniser might return them against the pages as given; every
# third conversation is a page range of one document. DuckDB's distance counts
# bytes, so the input is texts of one-byte signs.
@register("page_text_similarity", """
WITH p AS (
  SELECT CASE WHEN conv_id % 3 = 0 THEN -1 ELSE conv_id END AS doc, conv_id, turn, text,
    CASE conv_id % 5 WHEN 0 THEN replace(text, 'ou', 'o') WHEN 1 THEN replace(text, 'e ', 'e') WHEN 2 THEN '' ELSE text END AS seen
  FROM (SELECT conv_id, turn, regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]', '?', 'g') AS text FROM conversations)),
d AS (
  SELECT doc, string_agg(text, ' ' ORDER BY conv_id, turn) AS a, string_agg(seen, ' ' ORDER BY conv_id, turn) AS b FROM p GROUP BY doc),
l AS (SELECT doc, length(a) AS left_chars, length(b) AS right_chars, CASE WHEN a = b THEN 0 ELSE levenshtein(a, b) END AS distance FROM d)
SELECT doc, left_chars, right_chars, distance,
  CASE WHEN distance = 0 THEN 100.0E0 ELSE (1.0E0 - distance / greatest(left_chars, right_chars)) * 100.0E0 END AS score
FROM l""")
def page_text_similarity(spark, sf):
    conv = table(spark, sf, "conversations").select(
        F.when(F.col("conv_id") % 3 == 0, F.lit(-1)).otherwise(F.col("conv_id")).alias("doc"),
        F.struct("conv_id", "turn").alias("seq"), F.regexp_replace("text", r"[^\x00-\x7F]", "?").alias("text"))
    kind = F.col("seq.conv_id") % 5
    seen = (F.when(kind == 0, F.replace("text", F.lit("ou"), F.lit("o"))).when(kind == 1, F.replace("text", F.lit("e "), F.lit("e")))
            .when(kind == 2, F.lit("")).otherwise(F.col("text")))
    return edit_distance.joined_text_scores(conv, conv.withColumn("text", seen), "doc", "seq", "text")


# ---------------------------------------------------------------- E1 (schema-less)

def _order_doc() -> "F.Column":
    doc = F.struct(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
                 (F.col("o_orderpriority") == "1-URGENT").alias("urgent")).alias("info"),
        F.array("o_orderpriority", "o_orderstatus").alias("tags"),
        F.array().cast("array<string>").alias("empty"),
        F.create_map().cast("map<string,string>").alias("none"),
        F.lit(None).cast("string").alias("note"))
    return F.to_json(doc, {"ignoreNullFields": "false"})


_KIND_SQL = """CASE t.type WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'null'
                 WHEN 'DOUBLE' THEN 'float' ELSE 'int' END"""
_VALUE_SQL = """CASE t.type WHEN 'VARCHAR' THEN t.atom->>'$' WHEN 'NULL' THEN NULL
                  WHEN 'BOOLEAN' THEN CASE WHEN CAST(t.atom AS VARCHAR) = 'true' THEN 'True' ELSE 'False' END
                  ELSE CAST(t.atom AS VARCHAR) END"""


@register("leaf_fields", f"""
WITH j AS (
  SELECT 'events' AS src, event_id AS id, props AS doc FROM events
  UNION ALL
  SELECT 'orders', o_orderkey,
    CAST(json_object('key', o_orderkey,
      'info', json_object('status', o_orderstatus, 'total', o_totalprice,
                          'urgent', o_orderpriority = '1-URGENT'),
      'tags', json_array(o_orderpriority, o_orderstatus), 'empty', json_array(),
      'none', json_object(), 'note', NULL) AS VARCHAR)
  FROM orders)
SELECT src, j.id AS id,
  CAST(row_number() OVER (PARTITION BY src, j.id ORDER BY t.id) - 1 AS INTEGER) AS pos,
  replace(t.fullkey, '$.', '') AS path, {_VALUE_SQL} AS value, {_KIND_SQL} AS kind
FROM j, json_tree(j.doc) t
WHERE t.type NOT IN ('OBJECT', 'ARRAY')""")
def leaf_fields(spark, sf):
    return leaves.json_leaf_rows(_leaf_documents(spark, sf), ["src", "id"], "doc")


def _leaf_documents(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events").select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"), F.col("props").alias("doc"))
    od = table(spark, sf, "orders").select(
        F.lit("orders").alias("src"), F.col("o_orderkey").alias("id"), _order_doc().alias("doc"))
    return ev.unionByName(od)


@register("leaf_fields_by_shape", ORACLE["leaf_fields"])
def leaf_fields_by_shape(spark, sf):
    """The leaves of ``leaf_fields`` without Python for documents of common shapes."""
    return shapes.leaf_rows(_leaf_documents(spark, sf), ["src", "id"], "doc")


# ---------------------------------------------------------------- E7, E9, E10

EXPECTED_EVENT_KEYS = ["k", "user_id", "event_type"]


@register("key_presence", """
WITH k AS (SELECT event_id, json_keys(props) AS keys FROM events)
SELECT event_id, CAST(len(keys) AS INTEGER) AS n_keys,
  array_to_string(list_sort(list_filter(['k', 'user_id', 'event_type'], lambda x: NOT list_contains(keys, x))), ',')
    AS missing,
  len(list_filter(['k', 'user_id', 'event_type'], lambda x: NOT list_contains(keys, x))) = 0 AS ok
FROM k""")
def key_presence(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.json_object_keys("props").alias("keys"))
    expected = F.array(*[F.lit(k) for k in EXPECTED_EVENT_KEYS])
    miss = scoring.missing_keys(expected, F.col("keys"))
    return ev.select("event_id", F.size("keys").alias("n_keys"),
                     F.array_join(F.array_sort(miss), ",").alias("missing"),
                     (F.size(miss) == 0).alias("ok"))


# Patterns: the words of the benchmark items and all runs of two and three of them.
@register("pattern_table_presence", r"""
WITH w AS (SELECT regexp_extract_all(text, '[^ \t\r\n]+') AS w FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT array_to_string(w[i:i + k], ' ') AS pattern
  FROM w, unnest([0, 1, 2]) AS a(k), unnest(range(1, len(w) + 1)) AS b(i) WHERE i + k <= len(w)),
pw AS (SELECT pattern, regexp_extract_all(pattern, '[\p{L}\p{N}_]+') AS ws FROM p),
dw AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents),
maybe AS (
  SELECT pattern, f.doc_id FROM pw JOIN dw f ON f.word = ws[1] JOIN dw l ON l.word = ws[len(ws)] AND l.doc_id = f.doc_id WHERE pattern <> ws[1]
  UNION ALL SELECT pattern, doc_id FROM pw, documents WHERE len(ws) = 0),
hit AS (
  SELECT pattern, doc_id FROM pw JOIN dw ON word = pattern
  UNION ALL
  SELECT pattern, doc_id FROM maybe JOIN documents USING (doc_id)
  WHERE contains(text, pattern) AND regexp_matches(text, '(^|[^\p{L}\p{N}_])' || regexp_escape(pattern) || '($|[^\p{L}\p{N}_])'))
SELECT pattern, count(doc_id) AS n_texts FROM p LEFT JOIN hit USING (pattern) GROUP BY pattern""")
def pattern_table_presence(spark, sf):
    words = table(spark, sf, "benchmark").select(F.regexp_extract_all("text", F.lit(r"[^ \t\r\n]+"), F.lit(0)).alias("w"))
    runs = F.flatten(F.transform(F.array(*[F.lit(k) for k in (1, 2, 3)]), lambda k: F.filter(
        F.transform("w", lambda x, i: F.when(i + k <= F.size("w"), F.array_join(F.slice("w", i + 1, k), " "))), F.isnotnull)))
    known = words.select(F.explode(runs).alias("pattern"))
    return patterns.pattern_counts(table(spark, sf, "documents"), "doc_id", "text", known, "pattern").select("pattern", "n_texts")


@register("membership", """
SELECT l_orderkey,
  bool_or(l_quantity IS NOT DISTINCT FROM 10.0E0) AS has_10kg,
  bool_or(l_quantity IS NOT DISTINCT FROM 22.0E0 AND l_returnflag = 'R') AS has_22_r,
  bool_or(contains(l_returnflag || l_linestatus, 'RF')) AS has_rf_text
FROM lineitem GROUP BY l_orderkey""")
def membership(spark, sf):
    li = table(spark, sf, "lineitem")
    weight = F.array(F.struct(F.col("l_quantity").alias("value"), F.lit("kg").alias("unit")),
                     F.struct(F.col("l_quantity").alias("value"), F.col("l_returnflag").alias("unit")))
    rows = li.select(
        "l_orderkey",
        scoring.contains_value(weight, F.lit(10.0), F.lit("kg")).alias("a"),
        scoring.contains_value(weight, F.lit(22.0), F.lit("R")).alias("b"),
        F.contains(F.array_join(F.array("l_returnflag", "l_linestatus"), ""), F.lit("RF")).alias("c"))
    # membership per order as a partial aggregate: no list is gathered
    return rows.groupBy("l_orderkey").agg(F.bool_or("a").alias("has_10kg"),
                                          F.bool_or("b").alias("has_22_r"),
                                          F.bool_or("c").alias("has_rf_text"))


PRESENCE_WORDS = ["the", "and", "der", "und", "les", "que", "con", "License", "MIT"]


def _presence_sql() -> str:
    flags = [f"regexp_matches(text, '{scoring.word_pattern(w)}')" for w in PRESENCE_WORDS]
    n = " + ".join(f"CAST({f} AS INTEGER)" for f in flags)
    s = " || ".join(f"CASE WHEN {f} THEN '1' ELSE '0' END" for f in flags)
    return f"SELECT doc_id, {n} AS n_present, ({n}) = {len(flags)} AS all_present, {s} AS flags FROM documents"


@register("pattern_presence", _presence_sql())
def pattern_presence(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", scoring.patterns_present(F.col("text"), PRESENCE_WORDS).alias("f"))
    n = F.aggregate("f", F.lit(0), lambda acc, x: acc + x.cast("int"))
    return d.select("doc_id", n.alias("n_present"), (n == len(PRESENCE_WORDS)).alias("all_present"),
                    F.array_join(F.transform("f", lambda x: F.when(x, "1").otherwise("0")), "")
                    .alias("flags"))


# ---------------------------------------------------------------- P3-P5, P7, I2, I3

ENGINES = ["document_intelligence", "layout_v2"]
REQUESTED_MODELS = ["gpt-3.5-turbo", "gpt-4o", "not-registered"]


def _done(spark, sf):
    lab = table(spark, sf, "labels")
    a = lab.filter(F.col("quality") == 1).select("doc_id", F.lit("document_intelligence").alias("engine"),
                                                  F.lit("gpt-4o").alias("model"))
    b = lab.filter(F.col("toxic") == 1).select("doc_id", F.lit("layout_v2").alias("engine"),
                                                F.lit("gpt-3.5-turbo").alias("model"))
    return a.unionByName(b)


@register("work_remaining", """
WITH models(model, max_tokens, api_version) AS (
  VALUES ('gpt-3.5-turbo', 12000, '2024-02-01'), ('gpt-4o', NULL, '2024-02-15-preview')),
done AS (
  SELECT doc_id, 'document_intelligence' AS engine, 'gpt-4o' AS model FROM labels WHERE quality = 1
  UNION ALL SELECT doc_id, 'layout_v2', 'gpt-3.5-turbo' FROM labels WHERE toxic = 1),
fan AS (
  SELECT doc_id, e.engine, r.model FROM documents,
    (VALUES ('document_intelligence'), ('layout_v2')) e(engine),
    (VALUES ('gpt-3.5-turbo'), ('gpt-4o'), ('not-registered')) r(model))
SELECT f.doc_id, f.engine, f.model, CAST(m.max_tokens AS INTEGER) AS max_tokens, m.api_version,
  'ocr_' || f.engine || '_' || CAST(f.doc_id AS VARCHAR) AS ocr_key,
  'llm_' || f.model || '_ocr_' || f.engine || '_' || CAST(f.doc_id AS VARCHAR) AS llm_key
FROM fan f JOIN models m ON f.model = m.model
WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.doc_id = f.doc_id AND d.engine = f.engine
                                         AND d.model = f.model)""")
def work_remaining(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    todo, _ = extract.plan_work(spark, docs, "doc_id", ENGINES, REQUESTED_MODELS, _done(spark, sf))
    return todo


def _request_sql() -> str:
    head = (extract.TASK + "\n\nRequirements:" + extract.REQUIREMENTS + "\nText:\n").replace("'", "''")
    return (f"SELECT doc_id, '{head}' || coalesce(text, '') AS request, "
            f"CAST(length('{head}' || coalesce(text, '')) AS INTEGER) AS request_len FROM documents")


@register("request_text", _request_sql())
def request_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", extract.request_text(F.col("text")).alias("request"))
    return d.select("doc_id", "request", F.length("request").alias("request_len"))


# ---------------------------------------------------------------- I4b, I1/I4a/P6/P8

def _pattern_sql() -> str:
    X = extract
    strip = ("replace(regexp_replace(regexp_replace(regexp_replace(html, "
             "'(?s)<script[^>]*>.*?</script>', ' ', 'g'), '(?s)<style[^>]*>.*?</style>', ' ', 'g'), "
             "'<[^>]+>', ' ', 'g'), '&amp;', '&')")

    def first(t, pat, g=0):
        return f"nullif(regexp_extract({t}, '{pat}', {g}), '')"

    reg = first("t", _REGISTRATION_FIND_SQL, 1)
    grade = first("t", _GRADE_FIND_SQL, 1)
    site = first("t", X.WEBSITE_RE)
    ph = first("t", _PHONE_FIND_SQL, 1)
    fields = f"""
      CASE WHEN regexp_full_match({reg}, '[0-9]{{7}}[A-Z]') THEN {reg} END AS registration,
      CASE WHEN regexp_full_match({grade}, '[0-9]+(\\.[0-9]+)?-[0-9]+(\\.[0-9]+)?-[0-9]+(\\.[0-9]+)?')
           THEN {grade} END AS npk,
      lower(CASE WHEN starts_with({site}, 'www.') THEN {site} ELSE 'www.' || {site} END) AS website,
      {_phone_sql(ph)} AS phone_number,
      CAST({first('t', X.WEIGHT_RE, 1)} AS DOUBLE) AS weight_value,
      {first('t', X.WEIGHT_RE, 3)} AS weight_unit"""
    return f"""
WITH p AS (SELECT 'pages' AS src, page_id AS id, {first('html', X.TITLE_RE, 1)} AS title,
                  {strip} AS t FROM pages
           UNION ALL SELECT 'documents', doc_id, NULL, text FROM documents)
SELECT src, id, title, {fields} FROM p"""


@register("pattern_extract", _pattern_sql())
def pattern_extract(spark, sf):
    X = extract
    pages = table(spark, sf, "pages").select(
        F.lit("pages").alias("src"), F.col("page_id").alias("id"),
        X._first(F.col("html"), X.TITLE_RE, 1).alias("title"), X.html_text(F.col("html")).alias("t"))
    docs = table(spark, sf, "documents").select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
        F.lit(None).cast("string").alias("title"), F.col("text").alias("t"))
    both = pages.unionByName(docs)
    return both.select("src", "id", "title", X.pattern_fields(F.col("t")).alias("f")).select(
        "src", "id", "title", "f.*")


def word_count_extractor():
    """Deterministic stand-in extractor; fails on a seeded subset of texts."""
    def fn(rec):
        words = (rec["text"] or "").split()
        if len(words) % 11 == 0:
            raise ValueError("extractor rejected the document")
        return {"n_words": len(words), "n_lines": (rec["text"] or "").count("\n") + 1}
    return fn


@register("apply_extractor", r"""
WITH w AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D\x1C-\x20\x{85}\x{A0}]+')) AS n,
                  length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS lines
           FROM documents)
SELECT doc_id, CASE WHEN n % 11 <> 0 THEN '{"n_words": ' || n || ', "n_lines": ' || lines || '}' END AS result,
       CASE WHEN n % 11 = 0 THEN 'ValueError: extractor rejected the document' END AS error, TRUE AS timed
FROM w""")
def apply_extractor(spark, sf):
    docs = table(spark, sf, "documents")
    out = extract.apply_extractor(docs, word_count_extractor, "doc_id", ["text"])
    return out.select("doc_id", "result", "error", (F.col("seconds") >= 0).alias("timed"))


# ---------------------------------------------------------------- S1, S1c: order and numbers over text keys

@register("image_order", """
SELECT l_returnflag AS dir, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '/' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS path,
       l_quantity AS quantity,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '/' || l_linenumber || '_' || l_partkey || '_' || l_suppkey) AS seq
FROM lineitem""")
def image_order(spark, sf):
    from ..operators.prefix import rank_within
    key = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), F.lit("/"),
                   F.concat_ws("_", *(F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey"))))
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("dir"), key.alias("path"), F.col("l_quantity").alias("quantity"))
    return rank_within(rows, "dir", "path").withColumnRenamed("rank", "seq")


@register("case_numbering", """
SELECT 'label_' || o_orderkey AS case_dir, o_custkey AS owner, row_number() OVER (ORDER BY 'label_' || o_orderkey) AS case_no
FROM orders""")
def case_numbering(spark, sf):
    from ..sources.cases import number_cases
    return number_cases(table(spark, sf, "orders").select(
        F.concat(F.lit("label_"), F.col("o_orderkey").cast("string")).alias("case_dir"), F.col("o_custkey").alias("owner")))


# ---------------------------------------------------------------- E2 as a join of two tables

@register("field_scores_joined", f"WITH {FIELD_SCORES_CTE} SELECT {', '.join(SCORE_COLS)} FROM scores")
def field_scores_joined(spark, sf):
    """Expected and produced leaves are two tables, met on (case, path)."""
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    both = _customer_leaves(c).unionByName(_supplier_leaves(s))
    expected = both.select("case_no", F.inline("e"))
    produced = both.select("case_no", F.inline("a"))
    return scoring.score_leaves(expected, produced, ["case_no"]).select(*SCORE_COLS)


# ---------------------------------------------------------------- N11

_SPEC_SQL = """'{"humidity": "' || p_size || ' percent"' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE ', "ph": ' || p_size % 14 END
  || ', "solubility": ' || CASE WHEN p_partkey % 5 = 0 THEN 'null' WHEN p_partkey % 5 = 1 THEN '"none"' ELSE '"~' || p_size % 9 || '.5%"' END || '}'"""


@register("specification_standardize", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS humidity, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size % 14 AS DOUBLE) END AS ph,
       CASE WHEN p_partkey % 5 > 1 THEN CAST(p_size % 9 AS DOUBLE) + CAST(0.5 AS DOUBLE) END AS solubility,
       CASE WHEN p_partkey % 7 = 0 THEN 'ph:missing' ELSE '' END AS issues
FROM part""")
def specification_standardize(spark, sf):
    raw = table(spark, sf, "part").select("p_partkey", F.expr(_SPEC_SQL).alias("doc"))
    out = standardize.specification(raw, "doc", ["p_partkey"])
    return out.select("p_partkey", "humidity", "ph", "solubility",
                      F.array_join(F.transform("_issues", lambda x: F.concat_ws(":", x["loc"], x["kind"])), ",").alias("issues"))


# ---------------------------------------------------------------- N11-N14
# Raw records as JSON text, one per order, with seeded violations. The text
# is built by one SQL expression valid in both engines.

RAW_RECORD_SQL = """'{"fertiliser_name": ' || CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey AS STRING)
      ELSE '"' || o_orderpriority || '"' END
  || ', "lot_number": "LOT' || CAST(o_orderkey AS STRING) || '"'
  || ', "npk": ' || CASE WHEN o_orderkey % 37 = 0 THEN '12'
      ELSE '"' || CAST(o_custkey % 20 AS STRING) || '-' || CAST(o_orderkey % 10 AS STRING)
           || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '-5' END || '"' END
  || ', "registration_number": [' || CASE WHEN o_orderkey % 17 = 0 THEN '{"type": "fertilizer_product"}'
      ELSE '{"identifier": "' || lpad(CAST(o_orderkey AS STRING), 7, '0') || o_orderstatus
           || '", "type": "fertilizer_product"}' END || ']'
  || ', "weight": [{"value": ' || CASE WHEN o_orderkey % 7 = 0 THEN 'true' ELSE CAST(o_custkey % 50 AS STRING) END
  || ', "unit": "kg"}, {"value": "' || CAST(o_custkey % 90 AS STRING) || ' lb", "unit": '
  || CASE WHEN o_orderkey % 19 = 0 THEN '5' ELSE '"lb"' END || '}]'
  || ', "density": ' || CASE WHEN o_orderkey % 23 = 0 THEN '{"value": 1.25}' WHEN o_orderkey % 2 = 0 THEN 'null'
      ELSE '{"value": "~1.' || CAST(o_orderkey % 10 AS STRING) || ' g/ml", "unit": "g/ml"}' END
  || ', "cautions_en": ' || CASE WHEN o_orderkey % 29 = 0 THEN '["' || o_orderstatus || '", null]'
      WHEN o_orderkey % 4 = 0 THEN 'null' ELSE '["keep dry"]' END
  || ', "ingredients_en": [{"nutrient": ' || CASE WHEN o_orderkey % 31 = 0 THEN 'null' ELSE '"N"' END
  || ', "value": "' || CAST(o_orderkey % 12 AS STRING) || '%"}]'
  || ', "guaranteed_analysis_en": {"title": ' || CASE o_orderpriority WHEN '1-URGENT' THEN '"Guaranteed minimum analysis"'
      WHEN '2-HIGH' THEN '""' ELSE '"Guaranteed analysis"' END
  || ', "nutrients": null, "is_minimal": ' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'null' END || '}}'"""

_ISSUES_SQL = f"""
raw AS (SELECT o_orderkey AS id, {RAW_RECORD_SQL} AS doc FROM orders),
tree AS (SELECT r.id, t.fullkey, t.type, t.value FROM raw r, json_tree(r.doc) t),
issues AS (
  SELECT id, 'fertiliser_name' AS loc, 'string_type' AS kind FROM raw
   WHERE json_type(doc, '$.fertiliser_name') NOT IN ('VARCHAR', 'NULL')
  UNION ALL SELECT id, 'npk', 'string_type' FROM raw WHERE json_type(doc, '$.npk') NOT IN ('VARCHAR', 'NULL')
  UNION ALL SELECT id, replace(fullkey, '$.', '') || '.identifier', 'missing' FROM tree
   WHERE regexp_full_match(fullkey, '\\$\\.registration_number\\[[0-9]+\\]') AND type = 'OBJECT'
     AND json_type(value, '$.identifier') IS NULL
  UNION ALL SELECT id, replace(fullkey, '$.', '') || '.value', 'missing' FROM tree
   WHERE regexp_full_match(fullkey, '\\$\\.(weight\\[[0-9]+\\]|density)') AND type = 'OBJECT'
     AND json_type(value, '$.value') IS NULL
  UNION ALL SELECT id, replace(fullkey, '$.', '') || '.unit', 'missing' FROM tree
   WHERE regexp_full_match(fullkey, '\\$\\.(weight\\[[0-9]+\\]|density)') AND type = 'OBJECT'
     AND json_type(value, '$.unit') IS NULL
  UNION ALL SELECT id, replace(fullkey, '$.', ''), 'string_type' FROM tree
   WHERE regexp_full_match(fullkey, '\\$\\.(weight\\[[0-9]+\\]|density)\\.unit') AND type NOT IN ('VARCHAR', 'NULL')
  UNION ALL SELECT id, replace(fullkey, '$.', ''), 'string_type' FROM tree
   WHERE regexp_full_match(fullkey, '\\$\\.cautions_en\\[[0-9]+\\]') AND type <> 'VARCHAR'
  UNION ALL SELECT id, replace(fullkey, '$.', '') || '.nutrient',
         CASE WHEN json_type(value, '$.nutrient') IS NULL THEN 'missing' ELSE 'string_type' END FROM tree
   WHERE regexp_full_match(fullkey, '\\$\\.ingredients_en\\[[0-9]+\\]') AND type = 'OBJECT'
     AND coalesce(json_type(value, '$.nutrient'), 'ABSENT') <> 'VARCHAR'
)"""


def _std_orders(spark, sf, with_record=True):
    raw = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"),
                                            F.expr(RAW_RECORD_SQL).alias("doc"))
    return standardize.standardize(raw, "doc", ["id"], with_record=with_record)


@register("record_rejects", f"""WITH {_ISSUES_SQL}
SELECT id, count(*) AS n_issues, string_agg(loc || ':' || kind, ';' ORDER BY loc || ':' || kind) AS issues
FROM issues GROUP BY id""")
def record_rejects(spark, sf):
    rej = standardize.rejects(_std_orders(spark, sf, with_record=False))
    text = F.array_join(F.array_sort(F.transform(
        "_issues", lambda x: F.concat(x["loc"], F.lit(":"), x["kind"]))), ";")
    return rej.select("id", F.size("_issues").cast("bigint").alias("n_issues"), text.alias("issues"))


@register("rule_counts", f"""WITH {_ISSUES_SQL}
SELECT regexp_replace(loc, '\\[[0-9]+\\]', '[]', 'g') AS loc, kind, count(*) AS n_issues
FROM issues GROUP BY ALL""")
def rule_counts(spark, sf):
    return standardize.rule_counts(_std_orders(spark, sf, with_record=False))


def _num_sql(path: str) -> str:
    return f"""CASE json_type(doc, '{path}')
      WHEN 'VARCHAR' THEN CAST(nullif(regexp_extract(doc->>'{path}', '[0-9]+(\\.[0-9]+)?', 0), '') AS DOUBLE)
      WHEN 'BOOLEAN' THEN NULL WHEN 'NULL' THEN NULL
      ELSE CAST(json_extract(doc, '{path}') AS DOUBLE) END"""


@register("record_standardize", f"""WITH {_ISSUES_SQL},
ok AS (SELECT * FROM raw WHERE id NOT IN (SELECT id FROM issues)),
f AS (SELECT id, doc, doc->>'$.guaranteed_analysis_en.title' AS title FROM ok)
SELECT id, doc->>'$.fertiliser_name' AS fertiliser_name,
  CASE WHEN regexp_full_match(doc->>'$.npk', '[0-9]+(\\.[0-9]+)?-[0-9]+(\\.[0-9]+)?-[0-9]+(\\.[0-9]+)?')
       THEN doc->>'$.npk' END AS npk,
  CASE WHEN regexp_full_match(doc->>'$.registration_number[0].identifier', '[0-9]{{7}}[A-Z]')
       THEN doc->>'$.registration_number[0].identifier' END AS identifier,
  CAST(json_array_length(doc, '$.weight') AS INTEGER) AS n_weights,
  {_num_sql('$.weight[0].value')} AS weight_0,
  {_num_sql('$.weight[1].value')} AS weight_1,
  CASE WHEN json_type(doc, '$.density') = 'OBJECT' THEN {_num_sql('$.density.value')} END AS density_value,
  CAST(CASE json_type(doc, '$.cautions_en') WHEN 'ARRAY' THEN json_array_length(doc, '$.cautions_en')
       ELSE 0 END AS INTEGER) AS n_cautions,
  {_num_sql('$.ingredients_en[0].value')} AS ingredient_value,
  title,
  CASE WHEN length(title) > 0 THEN regexp_matches(title, '(?i)\\bminim\\w*\\b')
       ELSE CASE WHEN json_type(doc, '$.guaranteed_analysis_en.is_minimal') = 'BOOLEAN'
                 THEN CAST(json_extract(doc, '$.guaranteed_analysis_en.is_minimal') AS BOOLEAN) END
  END AS is_minimal
FROM f""")
def record_standardize(spark, sf):
    r = standardize.accepted(_std_orders(spark, sf)).select("id", "record.*")
    return r.select(
        "id", "fertiliser_name", "npk",
        F.col("registration_number")[0]["identifier"].alias("identifier"),
        F.size("weight").alias("n_weights"),
        F.col("weight")[0]["value"].alias("weight_0"), F.col("weight")[1]["value"].alias("weight_1"),
        F.col("density.value").alias("density_value"), F.size("cautions_en").alias("n_cautions"),
        F.col("ingredients_en")[0]["value"].alias("ingredient_value"),
        F.col("guaranteed_analysis_en.title").alias("title"),
        F.col("guaranteed_analysis_en.is_minimal").alias("is_minimal"))


# ---------------------------------------------------------------- E8

def _perturbed_order_doc() -> "F.Column":
    k = F.col("o_orderkey")
    status = F.when(k % 3 == 0, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus"))
    tags = F.when(k % 4 == 0, F.array("o_orderstatus", "o_orderpriority")).otherwise(
        F.array("o_orderpriority", "o_orderstatus"))
    doc = F.struct(
        k.alias("key"),
        F.struct(status.alias("status"), F.col("o_totalprice").alias("total"),
                 (F.col("o_orderpriority") == "1-URGENT").alias("urgent")).alias("info"),
        tags.alias("tags"))
    return F.to_json(doc, {"ignoreNullFields": "false"})


@register("key_value_scores", f"""
WITH d AS (
  SELECT o_orderkey,
    CAST(json_object('key', o_orderkey,
      'info', json_object('status', o_orderstatus, 'total', o_totalprice,
                          'urgent', o_orderpriority = '1-URGENT'),
      'tags', json_array(o_orderpriority, o_orderstatus), 'empty', json_array(),
      'none', json_object(), 'note', NULL) AS VARCHAR) AS e,
    CAST(json_object('key', o_orderkey,
      'info', json_object('status', CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END,
                          'total', o_totalprice, 'urgent', o_orderpriority = '1-URGENT'),
      'tags', CASE WHEN o_orderkey % 4 = 0 THEN json_array(o_orderstatus, o_orderpriority)
                   ELSE json_array(o_orderpriority, o_orderstatus) END) AS VARCHAR) AS a
  FROM orders),
k AS (SELECT o_orderkey, e, a, unnest(json_keys(e)) AS key FROM d),
v AS (SELECT o_orderkey, key,
        CASE WHEN json_type(e, '$.' || key) = 'NULL' THEN NULL ELSE json_extract_string(e, '$.' || key) END AS expected,
        CASE WHEN json_type(a, '$.' || key) = 'NULL' THEN NULL ELSE json_extract_string(a, '$.' || key) END AS actual
      FROM k)
SELECT o_orderkey, key, expected, actual,
  {_SIM.format(e="coalesce(expected, '')", a="coalesce(actual, '')")} AS score
FROM v""")
def key_value_scores(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _order_doc().alias("e"),
                                          _perturbed_order_doc().alias("a"))
    return scoring.key_value_scores(o, "e", "a", ["o_orderkey"])


# ---------------------------------------------------------------- D2 with hot documents
# Line items as the images of three documents (one per return flag): each
# document holds about a third of all rows. The chunked running sums keep
# every window task bounded by the chunk size.

@register("hot_document_layout", """
WITH m AS (SELECT l_returnflag AS doc, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  CAST(100 + l_partkey % 500 AS BIGINT) AS width,
                  CAST(floor(l_quantity) AS BIGINT) + 1 AS height
           FROM lineitem)
SELECT doc, l_orderkey, l_linenumber, l_partkey, l_suppkey, width, height, CAST(0 AS BIGINT) AS x,
  CAST(coalesce(sum(height) OVER (PARTITION BY doc ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS y,
  CAST(max(width) OVER (PARTITION BY doc) AS BIGINT) AS canvas_width,
  CAST(sum(height) OVER (PARTITION BY doc) AS BIGINT) AS canvas_height
FROM m""")
def hot_document_layout(spark, sf):
    # image order = (order, line, part, supplier), a unique key of the table
    m = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("doc"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
        (F.lit(100) + F.col("l_partkey") % 500).cast("bigint").alias("width"),
        (F.floor("l_quantity").cast("bigint") + 1).alias("height"))
    return layout.composite_layout(m).select("doc", "seq.*", "width", "height", "x", "y",
                                             "canvas_width", "canvas_height")


# ---------------------------------------------------------------- P2 over the given texts

def _document_records_sql() -> str:
    base = _pattern_sql()
    return f"""
WITH pe AS ({base})
SELECT src, id, TRUE AS accepted, CAST(0 AS INTEGER) AS n_issues, npk, website, phone_number,
       registration, weight_value, weight_unit
FROM pe"""


@register("document_records", _document_records_sql())
def document_records(spark, sf):
    from . import analyze
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("pages:"), F.col("page_id").cast("string")).alias("key"),
        extract.html_text(F.col("html")).alias("t"))
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("documents:"), F.col("doc_id").cast("string")).alias("key"), F.col("text").alias("t"))
    std = analyze.records_from_texts(pages.unionByName(docs), "key", "t")
    r = F.col("record")
    return std.select(
        F.split_part("key", F.lit(":"), F.lit(1)).alias("src"),
        F.split_part("key", F.lit(":"), F.lit(2)).cast("bigint").alias("id"),
        (F.size("_issues") == 0).alias("accepted"), F.size("_issues").alias("n_issues"),
        r["npk"].alias("npk"), r["organizations"][0]["website"].alias("website"),
        r["organizations"][0]["phone_number"].alias("phone_number"),
        F.try_element_at(r["registration_number"], F.lit(1))["identifier"].alias("registration"),
        F.try_element_at(r["weight"], F.lit(1))["value"].alias("weight_value"),
        F.try_element_at(r["weight"], F.lit(1))["unit"].alias("weight_unit"))


# ---------------------------------------------------------------- streaming form of A4

# ten digits: a mean of two-decimal scores may lie halfway between two six-digit
# numbers, where the order of summation decides the rounding
@register("field_stats_streamed", ORACLE["field_stats"].replace(", 6)", ", 10)"))
def field_stats_streamed(spark, sf):
    """Field scores of the given tables arrive as files; statistics are kept
    as per-micro-batch partials (Structured Streaming) and combined on read."""
    import os
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..streaming import incremental
    base = os.path.join(ensure_checkpoint_dir(spark), f"stream-stats-{uuid.uuid4().hex}")
    scores = field_scores_df(spark, sf)
    scores.select("case_no", "pos", "path", "score", "hit", "pass_fail").write.parquet(f"{base}/in")
    stream = (spark.readStream.schema(spark.read.parquet(f"{base}/in").schema)
              .option("maxFilesPerTrigger", 4).parquet(f"{base}/in"))
    q = incremental.stats_partials_stream(stream, f"{base}/partials", f"{base}/ckpt")
    q.awaitTermination()
    return incremental.field_stats_from_partials(spark, f"{base}/partials", digits=10)
