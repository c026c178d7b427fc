"""Six invoice fields from plain text, line by line.

Each document's text is split into its lines once, inside the row; every rule
is an array expression over those lines (``transform`` / ``filter`` /
``aggregate``). No explode, no shuffle: the job is a single narrow stage that
scales with the number of documents and runs unchanged on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.invoice import (
    clean_party, find_date, group_count, is_doc_type_word, largest_monetary,
    nonempty, strip_currency, valid_invoice_number,
)
from ..functions.text import UI, U, let, lines as split_lines, py_strip


def _tail(line: Column, label: str) -> Column:
    """Text after the leftmost label match (line[m.end():])."""
    g = group_count(label) + 1
    return F.regexp_extract(line, "(?s)" + UI + "(?:" + label + ")(.*)$", g)


def _next_nonblank(ls: Column, i: Column, k: int) -> Column:
    """First non-blank of the next k lines, stripped, or null."""
    nxt = F.filter(F.slice(ls, i + 2, k), lambda x: py_strip(x) != "")
    return py_strip(F.get(nxt, 0))


def _first(arr: Column) -> Column:
    return F.get(F.filter(arr, lambda x: x.isNotNull()), 0)


def label_value_lookup(ls: Column, label: str, validate) -> Column:
    """First label line whose tail validates, else whose first non-blank
    line among the next three validates; later label lines are tried when
    neither does."""
    cands = F.transform(
        ls,
        lambda line, i: F.when(
            line.rlike(UI + label),
            F.coalesce(validate(_tail(line, label)), validate(_next_nonblank(ls, i, 3))),
        ),
    )
    return _first(cands)


def _number_value(s: Column) -> Column:
    return valid_invoice_number(let(F.regexp_extract(s, fixed.TEXT_NUMBER_VALUE, 1), nonempty))


def text_invoice_number(text: Column, ls: Column) -> Column:
    by_label = label_value_lookup(ls, fixed.TEXT_NUMBER_LABEL, _number_value)
    hashed = nonempty(F.regexp_extract(text, U + fixed.TEXT_HASH_NUMBER, 1))
    return F.coalesce(by_label, F.concat(F.lit("#"), hashed))


def text_invoice_date(ls: Column) -> Column:
    return label_value_lookup(ls, fixed.TEXT_ISSUE_LABEL, find_date)


def text_due_date(ls: Column) -> Column:
    return label_value_lookup(ls, fixed.TEXT_DUE_LABEL, find_date)


def _tail_or_next(tail: Column, nxt: Column) -> Column:
    """struct(v): the clean tail, else the next line cleaned; null without both."""
    below = let(nxt, lambda n: F.when(n.isNotNull(), F.struct(clean_party(n).alias("v"))))
    return let(tail, lambda t: F.when(t.isNotNull(), F.struct(t.alias("v"))).otherwise(below))


def text_recipient(ls: Column) -> Column:
    """First label line that has a clean tail or any non-blank line in the
    next three decides; the next line is returned cleaned, even when that
    cleans to null."""
    label = fixed.TEXT_RECIPIENT_LABEL

    def one(line, i):
        return F.when(line.rlike(UI + label), _tail_or_next(clean_party(F.regexp_extract(line, UI + label, 1)),
                                                            _next_nonblank(ls, i, fixed.TEXT_RECIPIENT_NEXT_LINES)))

    return _first(F.transform(ls, one))["v"]


def text_issuer(ls: Column) -> Column:
    """Seller label at line start (tail, else next non-blank of four);
    otherwise the first clean line of the top 15 that is not a doc-type word."""
    label = fixed.TEXT_SELLER_LABEL

    def one(line, i):
        return F.when(line.rlike(UI + label), _tail_or_next(clean_party(F.regexp_extract(line, UI + label, 2)),
                                                            _next_nonblank(ls, i, fixed.TEXT_ISSUER_NEXT_LINES)))

    labelled = _first(F.transform(ls, one))
    heads = F.transform(F.slice(ls, 1, fixed.TEXT_ISSUER_TOP_LINES), clean_party)
    guess = F.get(F.filter(heads, lambda h: h.isNotNull()
                           & (F.char_length(h) >= fixed.TEXT_ISSUER_MIN_LEN)
                           & ~is_doc_type_word(h)), 0)
    return F.when(labelled.isNotNull(), labelled["v"]).otherwise(guess)


def text_total(ls: Column) -> Column:
    """Last total line (not a subtotal line) holding a monetary token; the
    largest token of that line, currency stripped."""
    cands = F.transform(
        ls,
        lambda line: F.when(
            line.rlike(UI + fixed.TEXT_TOTAL_LABEL) & ~line.rlike(UI + fixed.SUBTOTAL),
            largest_monetary(line),
        ),
    )
    last = F.try_element_at(F.filter(cands, lambda x: x.isNotNull()), F.lit(-1))
    return strip_currency(last)


def extract_fields(text: Column) -> Column:
    """All six fields as one struct; null or empty text gives six nulls."""
    return fields_from_lines(text, split_lines(text))


def fields_from_lines(text: Column, ls: Column) -> Column:
    return F.struct(
        text_invoice_number(text, ls).alias("invoice_number"),
        text_invoice_date(ls).alias("invoice_date"),
        text_due_date(ls).alias("due_date"),
        text_issuer(ls).alias("issuer"),
        text_recipient(ls).alias("recipient"),
        text_total(ls).alias("total"),
    )


def extract_from_text(df: DataFrame, text_col: str = "text", keep=("doc_id",)) -> DataFrame:
    """(keep..., six fields) for each row of ``df``. The lines are split once
    into their own column (a projection Catalyst keeps, since the split is
    used by every rule) and all six rules read it."""
    staged = df.select(*keep, F.col(text_col).alias("_text"), split_lines(F.col(text_col)).alias("_ls"))
    return staged.select(*keep, fields_from_lines(F.col("_text"), F.col("_ls")).alias("f")).select(*keep, "f.*")


def non_null_count(df: DataFrame) -> Column:
    return sum((F.coalesce(F.col(f), F.lit("")) != "").cast("int") for f in fixed.FIELDS)
