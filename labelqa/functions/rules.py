"""Standardisation rules as Catalyst column expressions.

Every function takes and returns a ``Column``; nothing here leaves the JVM.
Regular expressions use explicit ASCII classes where the record model is
ASCII (N1, N5, N7) so that Java, RE2 and Python agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the record model (must equal the reference's behaviour).
FIRST_NUMBER_RE = r"[0-9]+(\.[0-9]+)?"
REGISTRATION_RE = r"^[0-9]{7}[A-Z]$"
GRADE_RE = r"^[0-9]+(\.[0-9]+)?-[0-9]+(\.[0-9]+)?-[0-9]+(\.[0-9]+)?$"
REGISTRATION_TYPES = ["ingredient_component", "fertilizer_product"]
MINIMAL_RE = r"(?iU)\bminim\w*\b"
WEBSITE_PREFIX = "www."


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_number(c) -> Column:
    """Text of the first unsigned decimal number, null when none.

    Signs, thousands separators and exponents are not part of the match
    (``-5`` gives ``5``, ``1,234.5`` gives ``1``).
    """
    return F.regexp_substr(_c(c), F.lit(FIRST_NUMBER_RE))


def number_from_string(c) -> Column:
    """N2 for string input: first number as double."""
    return first_number(c).cast("double")


def website(c) -> Column:
    """Prefix ``www.`` unless already there (case-sensitive), then lower-case."""
    c = _c(c)
    return F.lower(F.when(c.startswith(WEBSITE_PREFIX), c)
                   .otherwise(F.concat(F.lit(WEBSITE_PREFIX), c)))


def registration_id(c) -> Column:
    """Seven digits and one upper-case letter, else null."""
    c = _c(c)
    return F.when(c.rlike(REGISTRATION_RE), c)


def registration_type(c) -> Column:
    """One of the two registration types, else null."""
    c = _c(c)
    return F.when(c.isin(*REGISTRATION_TYPES), c)


def grade(c) -> Column:
    """``N-P-K`` grade with optional decimals, else null."""
    c = _c(c)
    return F.when(c.rlike(GRADE_RE), c)


def grade_parts(c) -> Column:
    """The three numbers of a valid grade as ``struct<n,p,k: double>``."""
    g = grade(c)
    return F.when(g.isNotNull(), F.struct(
        F.split_part(g, F.lit("-"), F.lit(1)).cast("double").alias("n"),
        F.split_part(g, F.lit("-"), F.lit(2)).cast("double").alias("p"),
        F.split_part(g, F.lit("-"), F.lit(3)).cast("double").alias("k"),
    ))


def is_minimal(title, incoming=None) -> Column:
    """A non-empty title decides; otherwise the incoming flag stays."""
    t = _c(title)
    keep = F.lit(None).cast("boolean") if incoming is None else _c(incoming)
    return F.when(F.length(t) > 0, t.rlike(MINIMAL_RE)).otherwise(keep)


def empty_if_null(c, element_type: str) -> Column:
    """A null list becomes an empty list of the same element type."""
    return F.coalesce(_c(c), F.array().cast(f"array<{element_type}>"))
