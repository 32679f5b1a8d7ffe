"""E5: Python ``str()`` text of typed values, as column expressions.

The assessment compares ``str(value)``; Spark's cast differs for doubles
outside [1e-3, 1e7) (``1.0E7`` vs ``10000000.0``, ``1.0E22`` vs ``1e+22``)
and for booleans (``true`` vs ``True``). The double path re-assembles the
shortest-digit text Spark produces into Python's layout: fixed notation for
decimal exponents -4..15, else ``d.ddde+XX``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


SCI_RE = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"


def _python_layout(t: Column) -> Column:
    """Spark's ``d.dddE±n`` text (a lambda variable) in Python's layout."""
    sign = F.regexp_extract(t, SCI_RE, 1)
    lead = F.regexp_extract(t, SCI_RE, 2)
    frac0 = F.regexp_extract(t, SCI_RE, 3)
    frac = F.when(frac0 == "0", F.lit("")).otherwise(frac0)
    exp = F.regexp_extract(t, SCI_RE, 4).try_cast("int")
    digits = F.concat(lead, frac)
    nd = F.length(digits)
    # fixed notation for -4 <= exp < 16
    big = F.when(
        nd <= exp + 1,
        F.concat(digits, F.repeat(F.lit("0"), exp + 1 - nd), F.lit(".0")),
    ).otherwise(F.concat(F.call_function("substr", digits, F.lit(1), exp + 1), F.lit("."),
                         F.call_function("substr", digits, exp + 2)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    fixed = F.when(exp >= 0, big).otherwise(small)
    mant = F.when(F.length(frac) > 0, F.concat(lead, F.lit("."), frac)).otherwise(lead)
    e_abs = F.abs(exp).cast("string")
    expo = F.concat(F.when(exp < 0, F.lit("e-")).otherwise(F.lit("e+")),
                    F.when(F.length(e_abs) < 2, F.lpad(e_abs, 2, "0")).otherwise(e_abs))
    return F.concat(sign, F.when((exp >= -4) & (exp < 16), fixed).otherwise(F.concat(mant, expo)))


def py_double(c) -> Column:
    c = _c(c).cast("double")
    s = c.cast("string")
    # only scientific texts need re-assembly (|x| < 1e-3 or >= 1e7); the
    # rewrite runs once per such value (one-element transform as a let)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(c), F.lit("nan"))
        .when(c == float("inf"), F.lit("inf"))
        .when(c == float("-inf"), F.lit("-inf"))
        .when((F.abs(c) >= F.lit(1e-3)) & (F.abs(c) < F.lit(1e7)) | (c == 0), s)
        .otherwise(F.transform(F.array(s), _python_layout)[0])
    )


def py_bool(c) -> Column:
    c = _c(c)
    return F.when(c, F.lit("True")).when(~c, F.lit("False"))


def py_text(c, dtype: T.DataType) -> Column:
    """``str(value)`` for a scalar column of Spark type ``dtype`` (null stays null)."""
    c = _c(c)
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return py_bool(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return py_double(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("string")
    return c.cast("string")


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "str"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    return "str"
