"""Flatten nested records to ``(pos, path, value, kind)`` leaves.

Two paths, both narrow (no shuffle, no groupBy):

* ``typed_leaves`` walks a known Spark schema once on the driver and emits a
  single Catalyst expression (``transform`` / ``flatten`` / ``concat``);
  it runs in whole-stage code generation. A null struct or list is one
  leaf, an empty list yields nothing, values are rendered as Python ``str``.
* ``json_leaves`` handles schema-less JSON text, where key order, duplicate
  keys and the raw JSON number type matter (T21, T25, T27); a small
  Arrow-batched pandas UDF walks each document.
"""

from __future__ import annotations

import functools
import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.render import kind_of, py_text
from ..schema import LEAVES


def _leaf(path: Column, value: Column, kind: Column) -> Column:
    return F.struct(path.alias("path"), value.cast("string").alias("value"),
                    kind.alias("kind"))


def _null_leaf(path: Column) -> Column:
    return F.array(_leaf(path, F.lit(None).cast("string"), F.lit("null")))


def _child(path: Column | None, name: str) -> Column:
    return F.lit(name) if path is None else F.concat(path, F.lit("." + name))


def _index(path: Column | None, i: Column) -> Column:
    head = F.lit("") if path is None else path
    return F.concat(head, F.lit("["), i.cast("string"), F.lit("]"))


def _walk(col: Column, dtype: T.DataType, path: Column | None) -> Column:
    if isinstance(dtype, T.StructType):
        parts = [_walk(col[f.name], f.dataType, _child(path, f.name)) for f in dtype.fields]
        children = F.concat(*parts) if parts else F.array().cast(children_type())
        if path is None:
            return F.when(col.isNull(), F.array().cast(children_type())).otherwise(children)
        return F.when(col.isNull(), _null_leaf(path)).otherwise(children)
    if isinstance(dtype, T.ArrayType):
        elem = dtype.elementType
        flat = F.flatten(F.transform(col, lambda e, i: _walk(e, elem, _index(path, i))))
        if path is None:
            return F.coalesce(flat, F.array().cast(children_type()))
        return F.when(col.isNull(), _null_leaf(path)).otherwise(flat)
    if path is None:  # scalar root yields nothing
        return F.array().cast(children_type())
    kind = F.when(col.isNull(), F.lit("null")).otherwise(F.lit(kind_of(dtype)))
    return F.array(_leaf(path, py_text(col, dtype), kind))


def children_type() -> T.ArrayType:
    return T.ArrayType(T.StructType(LEAVES.elementType.fields[1:]))


def typed_leaves(col, dtype: T.DataType) -> Column:
    """Leaves of a struct/array column with schema ``dtype`` in document order.

    With a column name the expression is built once per (name, schema) and
    reused: it only names the column, and building it costs many driver ->
    JVM calls.
    """
    if isinstance(col, str):
        return _typed_leaves_cached(col, dtype.json())
    return _typed_leaves(col, dtype)


def _typed_leaves(col: Column, dtype: T.DataType) -> Column:
    raw = _walk(col, dtype, None)
    return F.transform(raw, lambda x, i: F.struct(
        i.alias("pos"), x["path"].alias("path"), x["value"].alias("value"),
        x["kind"].alias("kind")))


@functools.lru_cache(maxsize=64)
def _typed_leaves_cached(name: str, dtype_json: str) -> Column:
    return _typed_leaves(F.col(name), T._parse_datatype_json_string(dtype_json))


def explode_leaves(df: DataFrame, leaves_col: str, keep: list[str]) -> DataFrame:
    """Long form ``(keep..., pos, path, value, kind)``; narrow ``inline``."""
    return df.select(*keep, F.inline(F.col(leaves_col)))


# ---------------------------------------------------------------- schema-less

def _python_text(v):
    if v is None:
        return None, "null"
    if isinstance(v, bool):
        return str(v), "bool"
    if isinstance(v, int):
        return str(v), "int"
    if isinstance(v, float):
        return str(v), "float"
    return str(v), "str"


def leaves_of(data) -> list[dict]:
    """Leaves of one parsed JSON value, same keys and order as a Python walk.

    A path seen twice keeps its first position and its last value. Half of a
    surrogate pair (``\\ud83d`` alone) has no UTF-8 form and becomes ``?``.
    """
    rows = []
    for pos, (path, v) in enumerate(_by_path(data).items()):
        text, kind = _python_text(v)
        rows.append({"pos": pos, "path": _encodable(path), "value": text and _encodable(text), "kind": kind})
    return rows


def _by_path(data) -> dict[str, object]:
    out: dict[str, object] = {}

    def walk(node, parent: str) -> None:
        if isinstance(node, dict):
            items = ((f"{parent}.{k}" if parent else k, v) for k, v in node.items())
        elif isinstance(node, list):
            items = ((f"{parent}[{i}]" if parent else f"[{i}]", v) for i, v in enumerate(node))
        else:
            return
        for key, v in items:
            if isinstance(v, (dict, list)):
                walk(v, key)
            else:
                out[key] = v

    walk(data, "")
    return out


def _encodable(text: str) -> str:
    return text if text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


ISSUE = "error"     # kind of the one row that stands for a record without leaves


def _read(s, walk=leaves_of):
    """``(leaves, issue)`` of a text, by one parse and one walk."""
    if s is None:
        return None, None
    try:
        return walk(json.loads(s)), None
    except ValueError:
        return None, "invalid_json"
    except RecursionError:
        return None, "nested_too_deep"


@F.pandas_udf(T.StringType())
def _json_issue_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda text: _read(text)[1])


def json_issue(col) -> Column:
    """``invalid_json`` or ``nested_too_deep`` where ``json_leaves`` is null
    for a text that is not; null otherwise."""
    return _json_issue_udf(F.col(col) if isinstance(col, str) else col)


@F.pandas_udf(LEAVES)
def _json_leaves_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda text: _read(text)[0])


def json_leaves(col) -> Column:
    """Leaves of JSON text; null for null or unparseable text."""
    col = F.col(col) if isinstance(col, str) else col
    return _json_leaves_udf(col)


READ = T.StructType([T.StructField("leaves", LEAVES), T.StructField("issue", T.StringType())])


def _leaf_lists(docs: list[dict | None], kind: pa.ListType) -> pa.Array:
    """``LEAVES`` of documents given as ``path: value``; flat columns, no object per leaf."""
    ends, places, paths, texts, kinds = [0], [], [], [], []
    for doc in docs:
        if doc:
            places += range(len(doc))
            paths += [path if path.isascii() else _encodable(path) for path in doc]
            for v in doc.values():
                text, k = (v, "str") if type(v) is str else _python_text(v)
                texts.append(text and _encodable(text))
                kinds.append(k)
        ends.append(len(places))
    fields = kind.value_type
    flat = pa.StructArray.from_arrays([pa.array(c, fields.field(n).type) for c, n in (
        (places, "pos"), (paths, "path"), (texts, "value"), (kinds, "kind"))], fields=[fields.field(n) for n in ("pos", "path", "value", "kind")])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, type=kind, mask=pa.array([d is None for d in docs], pa.bool_()))


def json_read(col) -> Column:
    """``struct(leaves, issue)``: what ``json_leaves`` and ``json_issue`` give, from one walk."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(LEAVES)

    @F.arrow_udf(READ)
    def read(texts: pa.Array) -> pa.Array:
        found = [_read(s, _by_path) for s in texts.to_pylist()]
        return pa.StructArray.from_arrays([_leaf_lists([f[0] for f in found], kind), pa.array([f[1] for f in found], pa.string())], READ.names)

    return read(F.col(col) if isinstance(col, str) else col)


def json_leaf_rows(df: DataFrame, keep: list[str], col: str) -> DataFrame:
    """Long form ``(keep..., pos, path, value, kind)`` of JSON text, directly.

    Same walk as ``json_leaves`` but emitted as rows by ``mapInPandas``: no
    nested array is built per document, which is cheaper when the long table
    is what is wanted. Null text yields no rows; a text that cannot be read
    yields one row with kind ``error`` and the reason as its value.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in keep)
    schema += ", pos int, path string, value string, kind string"

    def run(batches):
        for pdf in batches:
            out = {c: [] for c in keep}
            pos, path, value, kind = [], [], [], []
            texts = pdf.iloc[:, len(keep)].tolist()
            carried = [pdf.iloc[:, k].tolist() for k in range(len(keep))]
            for k, text in enumerate(texts):
                rows, issue = _read(text)
                if issue is not None:
                    rows = [{"pos": -1, "path": None, "value": issue, "kind": ISSUE}]
                if not rows:
                    continue
                for c, values in zip(keep, carried, strict=True):
                    out[c].extend([values[k]] * len(rows))
                for r in rows:
                    pos.append(r["pos"])
                    path.append(r["path"])
                    value.append(r["value"])
                    kind.append(r["kind"])
            if not pos:
                continue
            res = pd.DataFrame(out)
            res["pos"], res["path"], res["value"], res["kind"] = pos, path, value, kind
            yield res

    return df.select(*keep, col).mapInPandas(run, schema)
