"""Column functions for invoice values: dates, amounts, numbers, parties.

Each function maps Column -> Column with built-in expressions only, so the
rules run inside Spark tasks and stay null-safe (no match -> null).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import UI, U, col, let, py_strip, strip_chars, rstrip_chars, words

DATE_RE = UI + "|".join(fixed.DATE_ALTERNATIVES)
AMOUNT_RE = U + fixed.AMOUNT
CURRENCY_PREFIX = U + "^" + fixed.CURRENCY + r"\s*"


def nonempty(c) -> Column:
    c = col(c)
    return F.when(c != "", c)


def find_date(c) -> Column:
    """Leftmost date of the six styles, as written; null when none."""
    return let(F.regexp_extract(col(c), DATE_RE, 0), nonempty)


def find_amounts(c) -> Column:
    """All amount tokens (stripped), left to right."""
    return F.transform(F.regexp_extract_all(col(c), F.lit(AMOUNT_RE), 0), py_strip)


def is_year(c) -> Column:
    return col(c).rlike(U + fixed.YEAR_ONLY)


def is_monetary(c) -> Column:
    def of(t):
        digits = F.char_length(F.regexp_replace(t, r"(?U)\D", ""))
        return (~is_year(t)) & (
            t.rlike(fixed.CURRENCY) | t.rlike(r"(?U)[.,]\d{2}\b") | (digits >= 3)
        )
    return let(py_strip(col(c)), of)


def strip_currency(c) -> Column:
    return py_strip(F.regexp_replace(col(c), CURRENCY_PREFIX, ""))


def amount_as_double(c) -> Column:
    """EU / US separators; -1.0 when the token does not parse."""
    t = strip_currency(col(c))
    t = F.replace(F.replace(t, F.lit(" "), F.lit("")), F.lit("\u00a0"), F.lit(""))
    number = lambda t: (
        F.when(t.rlike(U + fixed.EU_GROUPED),
               F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(t.rlike(U + fixed.EU_SIMPLE), F.replace(t, F.lit(","), F.lit(".")))
        .otherwise(F.replace(t, F.lit(","), F.lit("")))
    )
    return F.coalesce(let(t, number).try_cast("double"), F.lit(-1.0))


def largest_monetary(c) -> Column:
    """The largest monetary token of a string (first wins ties), or null."""
    init = F.struct(F.lit(-1.0).alias("v"), F.lit(None).cast("string").alias("t"))

    def step(acc, x):
        larger = lambda v: F.when(v > acc["v"], F.struct(v.alias("v"), x.alias("t"))).otherwise(acc)
        return F.when(is_monetary(x), let(amount_as_double(x), larger)).otherwise(acc)

    return F.aggregate(find_amounts(c), init, step, lambda acc: acc["t"])


def valid_invoice_number(c) -> Column:
    """First whitespace token (minus trailing ':,.;') that is not a bare
    year and looks like an invoice number."""
    toks = F.transform(words(c), lambda w: rstrip_chars(w, fixed.INVOICE_NUMBER_TRAILING))
    ok = F.filter(toks, lambda t: (~is_year(t)) & t.rlike(UI + fixed.INVOICE_NUMBER_VALUE))
    return F.get(ok, 0)


def clean_party(c) -> Column:
    """Trim ' :,-'; cut at a tax/bank/contact word; null when under 2 chars
    or under 2 letters."""
    t = strip_chars(col(c), fixed.PARTY_STRIP_CHARS)
    t = strip_chars(F.regexp_replace(t, "(?s)" + UI + fixed.PARTY_CUT + ".*$", ""),
                    fixed.PARTY_STRIP_CHARS)
    return let(t, lambda t: F.when((F.char_length(t) >= 2) & (F.regexp_count(t, F.lit(r"\p{L}")) >= 2), t))


def trim_doc_type_suffix(c) -> Column:
    return py_strip(F.regexp_replace(col(c), UI + fixed.DOC_TYPE_SUFFIX, ""))


def is_stop_row(c) -> Column:
    return col(c).rlike(UI + fixed.STOP_ROW)


def is_doc_type_word(c) -> Column:
    return col(c).rlike(UI + "^" + fixed.DOC_TYPE_WORD + "$")


def group_count(pattern: str) -> int:
    return re.compile(pattern).groups
