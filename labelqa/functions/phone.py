"""Phone text to E.164, as one column expression.

The steps follow the public behaviour of common phone-number parsers for the
default region Canada:

1. keep the text from the first ``+`` or digit; drop trailing characters
   that are not letters, digits or ``#``;
2. drop an extension suffix (``ext``, ``ext.``, ``extn``, ``extension``,
   ``x``, ``#`` followed by up to seven digits);
3. the rest must look like a number: at least three digits, each optionally
   preceded by punctuation, then digits, letters or punctuation only;
4. with three or more letters, letters become keypad digits (vanity
   numbers); otherwise only the digits are kept;
5. ``+`` (or the international prefix ``011``) selects a calling code from a
   short fixed list; otherwise the North American plan applies, with an
   optional national prefix ``1``.

Calling codes form a prefix-free code, so the longest-prefix match is a
plain ``CASE``: no table, no join. Without the full national metadata an
unassigned area code of a valid shape is accepted (known gap).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calling code -> national significant number pattern.
# North America (the default region, Canada) first.
PLANS = [
    ("1", r"[2-9][0-9]{2}[2-9][0-9]{6}"),
    ("33", r"[1-9][0-9]{8}"),
    ("44", r"[1-9][0-9]{8,9}"),
    ("49", r"[1-9][0-9]{5,13}"),
    ("52", r"[1-9][0-9]{9}"),
    ("61", r"[1-9][0-9]{8}"),
]
INTERNATIONAL_PREFIX = "011"
# Phone keypad letters.
KEYPAD_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEYPAD_DIGITS = "22233344455566677778889999"

START_RE = r"[+0-9].*$"
TRAILING_RE = r"[^A-Za-z0-9#]+$"
EXTENSION_RE = r"(?i) *(;ext=|extension|extn\.?|ext\.?|x|#) *[0-9]{1,7}#?$"
PUNCT = r"\-x ().\/\[\]~*"
VIABLE_RE = rf"^\+*([{PUNCT}]*[0-9]){{3,}}[{PUNCT}A-Za-z0-9]*$"


def _let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and use it in ``fn`` (Catalyst does not share
    sub-expressions across CASE branches; a one-element transform does)."""
    return F.transform(F.array(value), fn)[0]


def to_e164(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    cleaned = F.regexp_replace(F.regexp_replace(F.regexp_extract(c, START_RE, 0), TRAILING_RE, ""),
                               EXTENSION_RE, "")

    def with_text(s: Column) -> Column:
        letters = F.length(F.regexp_replace(s, "[^A-Za-z]", ""))
        mapped = F.when(letters >= 3, F.translate(F.upper(s), KEYPAD_LETTERS, KEYPAD_DIGITS)).otherwise(s)
        parts = F.struct(F.regexp_replace(mapped, "[^0-9]", "").alias("d"),
                         s.startswith("+").alias("plus"), s.rlike(VIABLE_RE).alias("viable"))
        return _let(parts, with_digits)

    def with_digits(p: Column) -> Column:
        digits, plus = p["d"], p["plus"]
        idd = ~plus & digits.startswith(INTERNATIONAL_PREFIX)
        intl_digits = F.when(idd, F.substring(digits, len(INTERNATIONAL_PREFIX) + 1, 64)).otherwise(digits)
        n = F.length(digits)
        national = (F.when((n == 11) & digits.startswith("1"), F.substring(digits, 2, 10))
                    .when(n == 10, digits))
        domestic = F.when(national.rlike(f"^{PLANS[0][1]}$"), F.concat(F.lit("+1"), national))
        intl = None
        for code, pattern in PLANS:
            cond = intl_digits.rlike(f"^{code}{pattern}$")
            val = F.concat(F.lit("+"), intl_digits)
            intl = F.when(cond, val) if intl is None else intl.when(cond, val)
        return F.when(p["viable"], F.when(plus | idd, intl).otherwise(domestic))

    return F.when(c.isNotNull(), _let(cleaned, with_text))


def to_e164_sql(col: str) -> str:
    """The same steps as DuckDB SQL (used by the oracle of ``phone_standardize``)."""
    s = (f"regexp_replace(regexp_replace(regexp_extract({col}, '{START_RE}', 0), "
         f"'{TRAILING_RE}', ''), '{EXTENSION_RE}', '')")
    letters = f"length(regexp_replace({s}, '[^A-Za-z]', '', 'g'))"
    mapped = (f"CASE WHEN {letters} >= 3 THEN translate(upper({s}), '{KEYPAD_LETTERS}', "
              f"'{KEYPAD_DIGITS}') ELSE {s} END")
    d = f"regexp_replace({mapped}, '[^0-9]', '', 'g')"
    plus = f"starts_with({s}, '+')"
    idd = f"(NOT {plus} AND starts_with({d}, '{INTERNATIONAL_PREFIX}'))"
    idig = f"CASE WHEN {idd} THEN substr({d}, {len(INTERNATIONAL_PREFIX) + 1}) ELSE {d} END"
    nat = (f"CASE WHEN length({d}) = 11 AND starts_with({d}, '1') THEN substr({d}, 2, 10) "
           f"WHEN length({d}) = 10 THEN {d} END")
    dom = f"CASE WHEN regexp_full_match({nat}, '{PLANS[0][1]}') THEN '+1' || {nat} END"
    intl = "CASE " + " ".join(
        f"WHEN regexp_full_match({idig}, '{code}{pat}') THEN '+' || {idig}" for code, pat in PLANS
    ) + " END"
    return (f"CASE WHEN regexp_matches({s}, '{VIABLE_RE}') THEN "
            f"(CASE WHEN {plus} OR {idd} THEN {intl} ELSE {dom} END) END")
