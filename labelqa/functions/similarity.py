"""Normalised edit similarity and the pass/fail label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the assessment.
PASS_THRESHOLD = 80.0
MISSING = "FIELD_NOT_FOUND"
PASS, FAIL = "Pass", "Fail"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def similarity(a, b) -> Column:
    """``(1 - lev/max(len)) * 100`` over code points; null counts as ''.

    Both empty gives 100. Equal strings short-cut the O(n*m) distance.
    The arithmetic is the same sequence of double operations as the
    Python formula, so results are bit-equal.
    """
    a = F.coalesce(_c(a), F.lit(""))
    b = F.coalesce(_c(b), F.lit(""))
    longest = F.greatest(F.length(a), F.length(b))
    return (
        F.when(longest == 0, F.lit(100.0))
        .when(a == b, F.lit(100.0))
        .otherwise((F.lit(1.0) - F.levenshtein(a, b) / longest) * F.lit(100.0))
    )


def passes(score, threshold: float = PASS_THRESHOLD) -> Column:
    """True when ``score >= threshold`` (4/5 = exactly 80.0 passes)."""
    return _c(score) >= F.lit(float(threshold))


def pass_fail(score, threshold: float = PASS_THRESHOLD) -> Column:
    return F.when(passes(score, threshold), F.lit(PASS)).otherwise(F.lit(FAIL))


def fixed2(c) -> Column:
    """Text of ``c`` with two decimals, rounded like Python's ``f'{x:.2f}'``."""
    return _format(c, "0.00")


def fixed4(c) -> Column:
    return _format(c, "0.0000")


def _format(c, pattern: str) -> Column:
    # format_number with a pattern string is reachable through SQL only.
    return F.call_function("format_number", _c(c), F.lit(pattern))


def pass_fail_bounded(a, b, threshold: float = PASS_THRESHOLD) -> Column:
    """E4 without the full O(n*m) distance: the label only.

    A pair can pass only if ``lev <= (1 - threshold/100) * maxlen``, so the
    distance is computed with the bounded (O(n*k)) form and an upper bound
    one above that; the exact score formula then decides, giving the same
    label as ``pass_fail(similarity(a, b))``.
    """
    a = F.coalesce(_c(a), F.lit(""))
    b = F.coalesce(_c(b), F.lit(""))
    longest = F.greatest(F.length(a), F.length(b))
    k = F.floor((F.lit(1.0) - F.lit(threshold) / F.lit(100.0)) * longest).cast("int") + F.lit(1)
    d = F.call_function("levenshtein", a, b, k)
    score = (F.lit(1.0) - d / longest) * F.lit(100.0)
    ok = (longest == 0) | (a == b) | ((d >= 0) & (score >= F.lit(float(threshold))))
    return F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL))
