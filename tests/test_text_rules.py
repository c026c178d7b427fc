"""Hand-worked cases for the text-path invoice rules (expected values follow
the rules as built, not the design notes)."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import invoice as inv
from quarry.functions import text as tx
from quarry.operators.extract_text import extract_from_text

FIELDS = ["invoice_number", "invoice_date", "due_date", "issuer", "recipient", "total"]


def extract(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return extract_from_text(df).collect()[0].asDict()


def scalar(spark, expr, value):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(expr(F.col("s")).alias("r")).collect()[0]["r"]


@pytest.mark.parametrize("text,field,expected", [
    ("Date of issue: 11/03/2017", "invoice_date", "11/03/2017"),
    ("Date of issue:\n11/03/2017", "invoice_date", "11/03/2017"),
    ("Due date:\n21/09/2022", "due_date", "21/09/2022"),
    ("TOTAL: $ 283,46", "total", "283,46"),
    ("Total $ 268,46  $ 15,00  $ 283,46", "total", "283,46"),
    ("Total 300.00 20.00", "total", "300.00"),
    ("Sub total 10.00", "total", None),
    ("Invoice No: 2024", "invoice_number", None),
    ("Invoice No: INV-804 ", "invoice_number", "INV-804"),
    ("Paid with ref #68021 today", "invoice_number", "#68021"),
    ("Seller:\nNorthgate Parts\nClient:\nHarbour PLC", "issuer", "Northgate Parts"),
    ("Seller:\nNorthgate Parts\nClient:\nHarbour PLC", "recipient", "Harbour PLC"),
])
def test_field_cases(spark, text, field, expected):
    assert extract(spark, text)[field] == expected


def test_due_line_wins_issue_date(spark):
    r = extract(spark, "Due date: 21/09/2022")
    assert r["invoice_date"] == "21/09/2022" and r["due_date"] == "21/09/2022"


@pytest.mark.parametrize("text", ["", None])
def test_empty_gives_six_nulls(spark, text):
    r = extract(spark, text)
    assert all(r[f] is None for f in FIELDS)


def test_month_name_date(spark):
    assert scalar(spark, inv.find_date, "Issued October 7, 2019") == "October 7, 2019"


def test_largest_not_rightmost(spark):
    assert scalar(spark, inv.largest_monetary, "Total 300.00 20.00") == "300.00"


def test_amount_parsing(spark):
    assert scalar(spark, inv.amount_as_double, "5.820,00") == 5820.0
    assert scalar(spark, inv.amount_as_double, "$ 5,820.00") == 5820.0
    assert scalar(spark, inv.amount_as_double, "283,46") == 283.46


def test_year_is_not_monetary(spark):
    assert scalar(spark, inv.is_monetary, "2024") is False
    assert scalar(spark, inv.is_monetary, "150") is True


def test_clean_party(spark):
    assert scalar(spark, inv.clean_party, " Acme Ltd VAT 123 ") == "Acme Ltd"
    assert scalar(spark, inv.clean_party, "12") is None


def test_strip_unicode_space(spark):
    assert scalar(spark, tx.py_strip, " text\t") == "text"


def test_blank_document_has_no_words(spark):
    assert scalar(spark, tx.n_words, "   ") == 0


def test_splitlines_semantics(spark):
    assert scalar(spark, tx.lines, "a\r\nb\n") == ["a", "b"]
    assert scalar(spark, tx.lines, "") == []


def test_trailing_blank_lines_do_not_change_fields(spark):
    base = "Acme Ltd\nInvoice No: INV-9\nTotal $ 10.00"
    assert extract(spark, base) == extract(spark, base + "\n\n\n")


def test_classifier_text(spark):
    out = scalar(spark, tx.clean_for_classifier, "Invoice Number 12\nHello  WORLD-\nwide\n 7 \n")
    assert out.startswith("__inv_number__ __inv_header__")
    assert out.endswith("invoice number 12 hello worldwide")


def test_a_value_is_parsed_once(spark):
    """Rules bind what they use more than once instead of repeating it."""
    df = spark.createDataFrame([("EUR 1.234,50",)], "s string")
    plan = lambda f: df.select(f(F.col("s")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan(inv.clean_party).count("regexp_replace(") == 3
    assert plan(inv.find_date).count("regexp_extract(") == 1
    assert plan(inv.largest_monetary).count("regexp_replace(") == 5
