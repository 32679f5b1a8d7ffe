"""Standardise raw JSON records into the inspection schema.

Input is raw JSON text; the raw JSON type of every value matters (a numeric
string loses its sign, a JSON number keeps it, a boolean or list becomes
null), so values are read as VARIANT and branched on their type.

The work is a short chain of projections, all Catalyst expressions (no
Python, no shuffle). Each stage computes a value once and later stages
only reference it, so no sub-expression is evaluated twice:

1. parse the text; cast the root to a struct of VARIANT fields (absent key
   = SQL null, JSON null = variant null);
2. probe each field once: as an object of VARIANT sub-fields, or as an
   array of VARIANT / of such objects;
3. type tag ("kind") of every probed value, list elements included;
4. values and issues from the tags.

Bad values are coerced to null as the record model does; structural faults
reject the whole record and are listed in ``_issues`` as ``(loc, kind)``:
``missing`` (required key absent), ``string_type`` (non-string, or null
where a string is required), ``list_type``, ``model_type`` (not an
object), ``bool_type``, ``invalid_json``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import phone, rules
from ..schema import INSPECTION, ISSUE

# kinds of scalars: the first three letters of the engine's type names
STRING, BOOLEAN = "STR", "BOO"
NUMERIC = ["TIN", "SMA", "INT", "BIG", "DEC", "DOU", "FLO"]
ISSUES_T = f"array<{ISSUE.simpleString()}>"

# Sub-fields of the nested models: (name, conversion, required key, non-null).
MODELS = {
    "value": [("value", "num", True, False), ("unit", "str", True, False)],
    "nutrient": [("nutrient", "str", True, True), ("value", "num", False, False),
                 ("unit", "str", False, False)],
    "registration": [("identifier", "regid", True, False), ("type", "enum", False, False)],
    "organization": [("name", "str", False, False), ("address", "str", False, False),
                     ("website", "web", False, False), ("phone_number", "phone", False, False)],
}
# Top-level fields: (name, shape, argument).
FIELDS = [
    ("organizations", "models", "organization"),
    ("fertiliser_name", "scalar", "str"),
    ("registration_number", "models", "registration"),
    ("lot_number", "scalar", "str"),
    ("weight", "models", "value"),
    ("density", "model", "value"),
    ("volume", "model", "value"),
    ("npk", "scalar", "grade"),
    ("guaranteed_analysis_en", "analysis", None),
    ("guaranteed_analysis_fr", "analysis", None),
    ("cautions_en", "strings", "absent_null"),
    ("cautions_fr", "strings", "absent_null"),
    ("instructions_en", "strings", None),
    ("instructions_fr", "strings", None),
    ("ingredients_en", "models", "nutrient"),
    ("ingredients_fr", "models", "nutrient"),
]
ANALYSIS_V = "struct<title: variant, nutrients: variant, is_minimal: variant>"


def _vstruct(model: str) -> str:
    return "struct<" + ", ".join(f"{n}: variant" for n, *_ in MODELS[model]) + ">"


TOP_V = "struct<" + ", ".join(f"{n}: variant" for n, *_ in FIELDS) + ">"


# ------------------------------------------------------------ expressions

#: Texts beyond this may not fit the engine's VARIANT; where one can't be
#: parsed it is reported as ``too_large``, not as broken JSON.
VARIANT_BYTES = 16 << 20
# Texts taken as a boolean, in either case.
TRUE_TEXTS, FALSE_TEXTS = ("1", "on", "t", "true", "y", "yes"), ("0", "off", "f", "false", "n", "no")


def lax_boolean(x: Column, k: Column) -> Column:
    """A boolean, a text or a number that stands for one; null otherwise."""
    text, number = F.lower(F.try_variant_get(x, "$", "string")), F.try_variant_get(x, "$", "double")
    return (F.when(k == BOOLEAN, F.try_variant_get(x, "$", "boolean"))
            .when((k == STRING) & text.isin(*TRUE_TEXTS), True).when((k == STRING) & text.isin(*FALSE_TEXTS), False)
            .when(k.isin(*NUMERIC) & (number == 1), True)
            .when(k.isin(*NUMERIC) & (number == 0), False))

def kind(x: Column, obj: Column | None = None, arr: Column | None = None) -> Column:
    """'absent', 'null', 'object', 'array' or three letters of the scalar type's name.

    ``obj``/``arr`` are the object / array probes of ``x`` when known, so the
    type name is only computed for scalars (cheap).
    """
    c = F.when(x.isNull(), F.lit("absent")).when(F.is_variant_null(x), F.lit("null"))
    if obj is not None:
        c = c.when(obj.isNotNull(), F.lit("object"))
    if arr is not None:
        c = c.when(arr.isNotNull(), F.lit("array"))
    return c.otherwise(F.substring(F.schema_of_variant(x), 1, 3))


def _empty() -> Column:
    return F.array().cast(ISSUES_T)


class Issues:
    """Issue candidates of a record: single nullable structs and arrays.

    Materialised once as ``concat(filter(array(singles), not null), arrays)``
    instead of concatenating many one-element arrays per record.
    """

    def __init__(self, singles=(), arrays=()):
        self.singles, self.arrays = list(singles), list(arrays)

    def __add__(self, other: "Issues") -> "Issues":
        return Issues(self.singles + other.singles, self.arrays + other.arrays)

    def only_if(self, cond: Column) -> "Issues":
        return Issues([F.when(cond, x) for x in self.singles],
                      [F.when(cond, a) for a in self.arrays])

    def to_array(self) -> Column:
        parts = []
        if self.singles:
            parts.append(F.filter(F.array(*self.singles), lambda x: x.isNotNull()))
        parts += [F.coalesce(a, _empty()) for a in self.arrays]
        if not parts:
            return _empty()
        return parts[0] if len(parts) == 1 else F.concat(*parts)


def issue(cond: Column, loc: Column, k: str) -> Issues:
    return Issues([F.when(cond, F.struct(loc.alias("loc"), F.lit(k).alias("kind")))])


def cat(*parts: Issues) -> Issues:
    out = Issues()
    for p in parts:
        out = out + p
    return out


def str_val(x: Column, k: Column) -> Column:
    return F.when(k == STRING, F.try_variant_get(x, "$", "string"))


def num_val(x: Column, k: Column) -> Column:
    """Bool -> null; JSON number -> itself; string -> first number; else null."""
    return (F.when(k.isin(*NUMERIC), F.try_variant_get(x, "$", "double"))
            .when(k == STRING, rules.number_from_string(F.try_variant_get(x, "$", "string"))))


def _convert(conv: str, x: Column, k: Column) -> Column:
    if conv == "num":
        return num_val(x, k)
    s = str_val(x, k)
    return {"str": s, "web": rules.website(s), "phone": phone.to_e164(s),
            "regid": rules.registration_id(s), "enum": rules.registration_type(s),
            "grade": rules.grade(s)}[conv]


def _leaf_issues(conv: str, required: bool, nonnull: bool, k: Column, loc: Column) -> Issues:
    parts = []
    if required:
        parts.append(issue(k == "absent", loc, "missing"))
    if conv not in ("num", "enum"):
        ok = [STRING, "absent"] if nonnull else [STRING, "null", "absent"]
        parts.append(issue(~k.isin(*ok), loc, "string_type"))
    return cat(*parts)


def _tagged(o: Column, model: str) -> Column:
    """Sub-fields of a probed object with their kinds: ``struct<n: struct<x, k>>``."""
    return F.struct(*[F.struct(o[n].alias("x"), kind(o[n]).alias("k")).alias(n)
                      for n, *_ in MODELS[model]])


def _model_value(t: Column, model: str) -> Column:
    return F.struct(*[_convert(conv, t[n]["x"], t[n]["k"]).alias(n)
                      for n, conv, *_ in MODELS[model]])


def _model_issues(t: Column, model: str, loc: Column) -> Issues:
    return cat(*[_leaf_issues(conv, req, nn, t[n]["k"], F.concat(loc, F.lit("." + n)))
                 for n, conv, req, nn in MODELS[model]])


def _idx(base: Column, i: Column) -> Column:
    return F.concat(base, F.lit("["), i.cast("string"), F.lit("]"))


# ------------------------------------------------------------ staged plan

def _list_stages(name: str, src: Column, model: str | None, stage_offset: int,
                 stages: list[dict]) -> None:
    """Register list-of-models / list-of-strings work into ``stages``."""
    x, a, e = f"__{name}_x", f"__{name}_a", f"__{name}_e"
    k, it = f"__{name}_k", f"__{name}_it"
    s0 = stages[stage_offset]
    s0[x] = src
    s0[a] = F.try_variant_get(src, "$", "array<variant>")
    if model:
        s0[e] = F.try_variant_get(src, "$", f"array<{_vstruct(model)}>")
        stages[stage_offset + 1][k] = kind(F.col(x), arr=F.col(a))
        # zip the raw elements with their object probes: one lambda variable
        # per element, cheap field access instead of re-indexing the probe
        zipped = F.arrays_zip(F.col(a).alias("v"), F.col(e).alias("o"))
        stages[stage_offset + 1][it] = F.transform(zipped, lambda z: F.struct(
            kind(z["v"], obj=z["o"]).alias("k"), _tagged(z["o"], model).alias("t")))
    else:
        stages[stage_offset + 1][k] = kind(F.col(x), arr=F.col(a))
        stages[stage_offset + 1][it] = F.transform(F.col(a), lambda v: F.struct(
            v.alias("x"), kind(v).alias("k")))


def _list_result(name: str, model: str | None, base: Column, absent_null: bool):
    k, it = F.col(f"__{name}_k"), F.col(f"__{name}_it")
    if model:
        vals = F.transform(it, lambda r: F.when(r["k"] == "object", _model_value(r["t"], model)))
        el_iss = F.flatten(F.transform(it, lambda r, i: (
            _model_issues(r["t"], model, _idx(base, i)).only_if(r["k"] == "object")
            + issue(r["k"] != "object", _idx(base, i), "model_type")).to_array()))
    else:
        vals = F.transform(it, lambda r: str_val(r["x"], r["k"]))
        el_iss = F.flatten(F.transform(it, lambda r, i: _leaf_issues(
            "str", False, True, r["k"], _idx(base, i)).to_array()))
    value = (F.when(k == "array", vals).when(k == "null", F.array())
             .when(k == "absent", F.lit(None) if absent_null else F.array()))
    issues = cat(issue(~k.isin("array", "null", "absent"), base, "list_type"),
                 Issues(arrays=[F.when(k == "array", el_iss)]))
    return value, issues


@functools.lru_cache(maxsize=1)
def _compiled():
    """The stage columns and the final (record, issues) columns, built once.

    Columns only name other columns, so one build serves every call.
    """
    top = F.col("__top")
    stages: list[dict] = [{} for _ in range(5)]
    results = {}
    for name, shape, arg in FIELDS:
        src = top[name]
        if shape == "scalar":
            stages[0][f"__{name}_x"] = src
            stages[1][f"__{name}_k"] = kind(F.col(f"__{name}_x"))
        elif shape == "model":
            stages[0][f"__{name}_x"] = src
            stages[0][f"__{name}_o"] = F.try_variant_get(src, "$", _vstruct(arg))
            stages[1][f"__{name}_k"] = kind(F.col(f"__{name}_x"), obj=F.col(f"__{name}_o"))
            stages[1][f"__{name}_t"] = _tagged(F.col(f"__{name}_o"), arg)
        elif shape in ("models", "strings"):
            _list_stages(name, src, arg if shape == "models" else None, 0, stages)
        elif shape == "analysis":
            stages[0][f"__{name}_x"] = src
            stages[0][f"__{name}_o"] = F.try_variant_get(src, "$", ANALYSIS_V)
            stages[1][f"__{name}_k"] = kind(F.col(f"__{name}_x"), obj=F.col(f"__{name}_o"))
            o = F.col(f"__{name}_o")
            stages[1][f"__{name}_title_x"] = o["title"]
            stages[1][f"__{name}_min_x"] = o["is_minimal"]
            stages[2][f"__{name}_title_k"] = kind(F.col(f"__{name}_title_x"))
            stages[2][f"__{name}_min_k"] = kind(F.col(f"__{name}_min_x"))
            _list_stages(f"{name}_n", o["nutrients"], "nutrient", 1, stages)

    for name, shape, arg in FIELDS:
        base = F.lit(name)
        if shape == "scalar":
            x, k = F.col(f"__{name}_x"), F.col(f"__{name}_k")
            results[name] = (_convert(arg, x, k), _leaf_issues("str", False, False, k, base))
        elif shape == "model":
            k, t = F.col(f"__{name}_k"), F.col(f"__{name}_t")
            results[name] = (F.when(k == "object", _model_value(t, arg)),
                             cat(issue(~k.isin("object", "null", "absent"), base, "model_type"),
                                 _model_issues(t, arg, base).only_if(k == "object")))
        elif shape in ("models", "strings"):
            results[name] = _list_result(name, arg if shape == "models" else None, base,
                                         arg == "absent_null")
        elif shape == "analysis":
            k = F.col(f"__{name}_k")
            tx, tk = F.col(f"__{name}_title_x"), F.col(f"__{name}_title_k")
            mx, mk = F.col(f"__{name}_min_x"), F.col(f"__{name}_min_k")
            nvals, niss = _list_result(f"{name}_n", "nutrient", F.lit(f"{name}.nutrients"), False)
            title = str_val(tx, tk)
            incoming = lax_boolean(mx, mk)
            value = F.struct(title.alias("title"),
                             F.coalesce(nvals, F.array()).alias("nutrients"),  # N9
                             rules.is_minimal(title, incoming).alias("is_minimal"))
            iss = cat(_leaf_issues("str", False, False, tk, F.lit(f"{name}.title")), niss,
                      issue(~mk.isin("null", "absent") & incoming.isNull(), F.lit(f"{name}.is_minimal"),
                            "bool_type"))
            results[name] = (F.when(k == "object", value),
                             cat(issue(~k.isin("object", "null", "absent"), base, "model_type"),
                                 iss.only_if(k == "object")))

    fields = [results[f.name][0].cast(f.dataType).alias(f.name) for f in INSPECTION.fields]
    large = F.array(F.struct(F.lit("").alias("loc"), F.lit("too_large").alias("kind")))
    issues = (F.when(F.col("__v").isNull() & F.col("__large"), large)
              .when(F.col("__v").isNull(), F.array(F.struct(F.lit("").alias("loc"),
                                                               F.lit("invalid_json").alias("kind"))))
              .when(top.isNull(), F.array(F.struct(F.lit("").alias("loc"),
                                                    F.lit("model_type").alias("kind"))))
              .otherwise(cat(*[results[n][1] for n, *_ in FIELDS]).to_array()))
    top_col = F.try_variant_get(F.col("__v"), "$", TOP_V).alias("__top")
    # one-row inline = Generate node: issues are computed once, and a later
    # filter on _issues cannot be pushed below it (no re-evaluation)
    final_issues = F.inline(F.array(F.struct(issues.alias("_issues"))))
    return top_col, [[c.alias(n) for n, c in st.items()] for st in stages if st], F.struct(*fields), \
        final_issues


def standardize(df: DataFrame, raw: str, keep: list[str], with_record: bool = True) -> DataFrame:
    """``keep + record + _issues`` from the JSON text column ``raw``.

    ``with_record=False`` returns ``keep + _issues`` only and skips building
    the record values (rejection reports and rule counts need only issues).
    """
    top_col, stages, record, final_issues = _compiled()
    d = df.select(*keep, F.try_parse_json(F.col(raw)).alias("__v"),
                  (F.octet_length(raw) > VARIANT_BYTES).alias("__large"))
    d = d.select("*", top_col)
    for cols in stages:
        d = d.select("*", *cols)
    if not with_record:
        return d.select(*keep, final_issues)
    # issues come out of a one-row Generate (a filter on them stays above it);
    # the record is built in the projection above, so a filter on _issues
    # runs before any record is assembled and unused fields can be pruned
    g = d.select("*", final_issues)
    return g.select(*keep, F.when(F.size("_issues") == 0, record).alias("record"), "_issues")


def rejects(std: DataFrame) -> DataFrame:
    return std.filter(F.size("_issues") > 0)


def accepted(std: DataFrame) -> DataFrame:
    return std.filter(F.size("_issues") == 0)


def issue_text(issues: str = "_issues") -> Column:
    """``loc: kind`` of every issue, sorted and joined; null without issues."""
    each = F.transform(issues, lambda x: F.concat_ws(": ", F.nullif(x["loc"], F.lit("")), x["kind"]))
    return F.when(F.size(issues) > 0, F.array_join(F.array_sort(each), "; "))


def generic_loc(loc: Column) -> Column:
    """``weight[3].unit`` -> ``weight[].unit``: counts per rule, not per index."""
    return F.regexp_replace(loc, r"\[[0-9]+\]", "[]")


def rule_counts(std: DataFrame) -> DataFrame:
    """Number of issues per (rule location, kind); partial aggregation."""
    x = std.select(F.explode("_issues").alias("_i"))
    return x.groupBy(generic_loc(F.col("_i.loc")).alias("loc"), F.col("_i.kind").alias("kind")).agg(
        F.count(F.lit(1)).alias("n_issues"))


# ------------------------------------------------------------ N11

SPEC_KEYS = ("humidity", "ph", "solubility")


def specification(df: DataFrame, raw: str, keep: list[str]) -> DataFrame:
    """Three required numeric keys, each coerced like N2."""
    s = df.select(*keep, F.try_variant_get(F.try_parse_json(F.col(raw)), "$",
                                           "struct<" + ", ".join(f"{k}: variant" for k in SPEC_KEYS)
                                           + ">").alias("__o"))
    s = s.select(*keep, *[F.col("__o")[k].alias(f"__{k}") for k in SPEC_KEYS])
    s = s.select("*", *[kind(F.col(f"__{k}")).alias(f"__{k}_k") for k in SPEC_KEYS])
    return s.select(*keep, *[num_val(F.col(f"__{k}"), F.col(f"__{k}_k")).alias(k) for k in SPEC_KEYS],
                    cat(*[issue(F.col(f"__{k}_k") == "absent", F.lit(k), "missing")
                          for k in SPEC_KEYS]).to_array().alias("_issues"))
