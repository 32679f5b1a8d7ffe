"""E1 without a schema and without Python for common documents: leaves by shape.

The *shape* of a JSON text is the text with every scalar replaced by a mark;
keys, brackets and their order stay. All texts of one shape have the same paths
at the same places, so a shape is walked once, and a text of a known shape only
needs its scalars in order:

1. ``learn``: the shapes of a table are counted, the commonest are walked
   (``spots``: each leaf's path and the number of its scalar) and stored. Repeated
   keys are settled here, as in ``leaves.leaves_of``: first position, last value.
2. ``read``: every text meets the dictionary by its shape and its scalars become
   leaves in Catalyst. Texts of other shapes, and those whose scalars Catalyst
   might write otherwise than Python (``\\u`` escapes, exponents, numbers of many
   digits, NaN, bad syntax), take ``leaves.json_read``. Every text takes one of
   the two ways, with equal results.

The dictionary is bounded by ``most`` shapes and ``DICTIONARY_CHARS`` characters
of shapes and paths, so the stored table stays below the size up to which Spark broadcasts
a join side by itself; no hint forces it. Texts beyond it are read by the second
way, none is dropped.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable
from . import leaves

MOST_SHAPES = 1024
SHAPE_CHARS = 16_384            # longer shapes are not learnt
DICTIONARY_CHARS = 8_000_000    # all learnt shapes and their paths together

_STRING = r'"[^"\\\x00-\x1f]*+(?:\\["\\/bfnrt][^"\\\x00-\x1f]*+)*+"'
_KEY = rf"{_STRING}[ \t\n\r]*+:"
_BARE = r'[^ \t\n\r",:\[\]{}]++'
_TOKEN = rf"({_KEY})|{_STRING}|{_BARE}"
_MARK = " # "
# scalars whose Python text follows from their own text
_INT = r"-?(?:0|[1-9][0-9]{0,17})"
_FLOAT = r"-?(?:0\.[0-9]{1,4}|0\.0{0,3}[1-9][0-9]{0,13}|[1-9][0-9]{0,8}\.[0-9]{1,6})"

SPOTS = T.StructType([T.StructField("spots", T.ArrayType(T.StructType([
    T.StructField("path", T.StringType()), T.StructField("at", T.IntegerType())])))])


def shape(col) -> Column:
    """The text with every scalar outside a key as a mark; null stays null."""
    col = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(col, F.lit(_TOKEN), F.lit("$1" + _MARK))


def scalars(col) -> Column:
    """The scalars of a text as written, in order, keys left out."""
    col = F.col(col) if isinstance(col, str) else col
    found = F.regexp_extract_all(col, F.lit(_TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~F.endswith(t, F.lit(":")) | ~F.startswith(t, F.lit('"')))


def spots_of(form: str) -> list[tuple[str, int]] | None:
    """Path and scalar number of every leaf of a shape, in leaf order; None where
    the shape is not that of a readable document with strict strings."""
    count = iter(range(len(form)))
    marked = re.compile(rf"({_KEY}){_MARK}|{_MARK}")
    if '"' in marked.sub("", form):          # a string that the token pattern does not take
        return None
    text = marked.sub(lambda m: m[1] or f" {next(count)} ", form)
    try:
        return [(leaf["path"], int(leaf["value"])) for leaf in leaves.leaves_of(json.loads(text))]
    except (ValueError, RecursionError):
        return None


def _walked(form: Column) -> Column:
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(SPOTS.fields[0].dataType)

    @F.arrow_udf(SPOTS)
    def walk(forms: pa.Array) -> pa.Array:
        found = [spots_of(f) for f in forms.to_pylist()]
        rows = [None if f is None else [{"path": p, "at": at} for p, at in f] for f in found]
        return pa.StructArray.from_arrays([pa.array(rows, kind)], ["spots"])

    return walk(form)


def learn(df: DataFrame, cols: list[str], most: int = MOST_SHAPES) -> DataFrame:
    """``(form, spots)`` of the commonest shapes of the text columns ``cols``, stored.

    Counting combines before the shuffle; at most ``most`` shapes are kept, in
    order of their number of texts, while their paths fit ``DICTIONARY_CHARS``.
    """
    texts = df.select(F.explode(F.array(*[shape(c) for c in cols])).alias("form"))
    texts = texts.where(F.length("form") <= SHAPE_CHARS)
    common = texts.groupBy("form").count().orderBy(F.desc("count"), "form").limit(most)
    walked = common.select("form", "count", _walked(F.col("form"))["spots"].alias("spots")).where("spots is not null")
    # a window over at most `most` rows
    size = F.length("form") + F.aggregate("spots", F.lit(0), lambda n, s: n + F.length(s["path"]) + 8)
    total = F.sum(size.cast("long")).over(Window.orderBy(F.desc("count"), "form"))
    walked = walked.select("form", "spots", total.alias("chars"))
    return durable(walked.where(F.col("chars") <= DICTIONARY_CHARS).select("form", "spots"), "shapes")


def _plain(token: Column) -> Column:
    return F.startswith(token, F.lit('"')) | token.rlike(rf"^(?:{_INT}|{_FLOAT}|true|false|null)$")


def _leaf(spot: Column, i: Column, token: Column) -> Column:
    """One leaf from its scalar as written (``_plain``)."""
    body = F.call_function("substr", token, F.lit(2), F.length(token) - 2)
    text = F.when(F.contains(token, F.lit("\\")), F.from_json(
        F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]).otherwise(body)
    cut = F.regexp_replace(token, "0+$", "")
    number = F.when(~F.contains(token, F.lit(".")), F.when(token == "-0", F.lit("0")).otherwise(token)).otherwise(
        F.when(F.endswith(cut, F.lit(".")), F.concat(cut, F.lit("0"))).otherwise(cut))
    quoted = F.startswith(token, F.lit('"'))
    value = (F.when(quoted, text).when(token == "null", F.lit(None).cast("string"))
             .when(token == "true", F.lit("True")).when(token == "false", F.lit("False")).otherwise(number))
    kind = (F.when(quoted, F.lit("str")).when(token == "null", F.lit("null")).when(token.isin("true", "false"), F.lit("bool"))
            .when(F.contains(token, F.lit(".")), F.lit("float")).otherwise(F.lit("int")))
    return F.struct(i.alias("pos"), spot["path"].alias("path"), value.alias("value"), kind.alias("kind"))


def read(df: DataFrame, cols: dict[str, str], shapes: DataFrame | None = None) -> DataFrame:
    """``df`` with ``struct(leaves, issue)`` per text column of ``cols`` (text
    column to new name), equal to ``leaves.json_read`` of each. ``shapes`` is a
    dictionary of ``learn``, also one of other rows; by default that of ``df``."""
    shapes = learn(df, list(cols)) if shapes is None else shapes
    out = df
    for text, name in cols.items():
        known = shapes.select(F.col("form").alias("__form"), F.col("spots").alias("__spots"))
        out = out.withColumn("__shape", shape(text)).join(known, F.col("__shape") == F.col("__form"), "left")
        out = out.withColumn("__scalars", F.when(F.col("__spots").isNotNull(), scalars(text)))
        easy = F.coalesce(F.forall("__scalars", _plain), F.lit(False))
        out = out.withColumn("__easy", easy).drop("__shape", "__form")
        out = out.withColumn("__other", leaves.json_read(F.when(~F.col("__easy"), F.col(text))))
        mine = F.transform("__spots", lambda s, i: F.transform(
            F.array(F.get("__scalars", s["at"])), lambda t: _leaf(s, i, t))[0])
        out = out.withColumn(name, F.when(F.col("__easy"), F.struct(
            mine.alias("leaves"), F.lit(None).cast("string").alias("issue"))).otherwise(F.col("__other")))
        out = out.drop("__spots", "__scalars", "__easy", "__other")
    return out


def leaf_rows(df: DataFrame, keep: list[str], col: str, shapes: DataFrame | None = None) -> DataFrame:
    """Long form ``(keep..., pos, path, value, kind)``, the rows of ``leaves.json_leaf_rows``."""
    got = read(df.select(*keep, col), {col: "__read"}, shapes)
    issue = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("path"),
                             F.col("__read.issue").alias("value"), F.lit(leaves.ISSUE).alias("kind")))
    return got.select(*keep, F.inline(F.when(F.col("__read.issue").isNotNull(), issue).otherwise(F.col("__read.leaves"))))
