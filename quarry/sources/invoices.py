"""Invoices rendered from the order tables, with their truth and word boxes.

One invoice per order that has line items, in five layouts that use the labels
the rules look for; values come from the order row, so the truth is a plain
projection. Party names are neutral (no label words).

The layouts are data (``LAYOUTS``): one spec renders the text both as a Spark
expression and as DuckDB SQL, so oracles see byte-identical text. Money is
computed in integer cents so no engine-specific rounding enters.

Scale: lineitem is joined to part on partkey and aggregated by order (partial
aggregation map-side), then joined to orders on orderkey. AQE picks broadcast
for a side under the broadcast threshold and sort-merge otherwise; nothing is
collected, and the text itself is a per-row projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# Rendering choices for the fixture invoices.
DATE_STYLES_SPARK = ["yyyy-MM-dd", "dd.MM.yyyy", "d MMM yyyy", "MMM d, yyyy"]
DATE_STYLES_SQL = ["%Y-%m-%d", "%d.%m.%Y", "%-d %b %Y", "%b %-d, %Y"]
CURRENCIES = ["€", "$", "RM", "£"]
TAX_RATES = [0, 7, 12, 19, 25]
DUE_DAYS = 21
NUMBER_OFFSET = 1000
PO_OFFSET = 10000
LINE_STRIDE = 1 << 32          # a word's idx: line number, then place in the line


class V(str):
    """A placeholder for a rendered value inside a layout spec."""


NUM, ISSUE, DUE, ISSUER, RECIP, TOTAL, SUB, TAX, UNIT, QTY, PCT, CUR, ITEM, PO = (
    V("num"), V("issue"), V("due"), V("issuer"), V("recipient"), V("total"), V("sub"),
    V("tax"), V("unit"), V("qty"), V("pct"), V("cur"), V("item"), V("po"))

LAYOUTS = [
    # 0: warehouse bill, what is to be paid comes first
    ["Balance Due ", CUR, " ", TOTAL, "\nPay by ", DUE, "\nBill No. ", NUM, "\nIssue Date ", ISSUE,
     "\n\nCustomer: ", RECIP, "\nVendor: ", ISSUER, "\nItems: ", QTY, ", the first is ", ITEM],
    # 1: account sheet, every value stands below its label
    [ISSUER, "\n\nClient\n", RECIP, "\n\nInvoice Number\n", NUM, "\n\nDate of Issue\n", ISSUE,
     "\n\nPayment Due Date\n", DUE, "\n\nTotal Payable\n", CUR, " ", TOTAL],
    # 2: reply to a purchase order, its own number stands last
    ["Reply to your order\nPO Number: ", PO, "\nIssued On: ", ISSUE, "\nDue: ", DUE, "\nRemit To: ", ISSUER,
     "\nShipped To: ", RECIP, "\n\nQuantity ", QTY, " at ", CUR, " ", UNIT, "\nSub Total ", CUR, " ", SUB,
     "\nTotal Due ", CUR, " ", TOTAL, "\nInv # ", NUM],
    # 3: counter note with the number in its heading
    ["Counter note #", NUM, "\n", QTY, " x ", ITEM, "\nAmount Due: ", CUR, " ", TOTAL, "\nDated: ", ISSUE,
     "\nBill From: ", ISSUER, "\nSold To: ", RECIP, "\nPayment Due: ", DUE],
    # 4: memo in sentences
    ["Memo for ", RECIP, "\nWe deliver ", ITEM, " with ", PCT, "% VAT, ", TAX, " in all.\nInvoice # ", NUM, " is payable on\nDue Date ", DUE,
     " and was written on ", ISSUE, "\nTotal ", CUR, " ", TOTAL, "\n", ISSUER],
]

TRUTH = {"invoice_number": NUM, "invoice_date": ISSUE, "due_date": DUE,
         "issuer": ISSUER, "recipient": RECIP, "total": TOTAL}


# ----------------------------------------------------------------- Spark --

def _pick(arr: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in arr]), (idx + 1).cast("int"))


def _money(cents: Column) -> Column:
    return F.format_string("%,.2f", cents / 100.0)


def _fmt_date(d: Column, style: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, pat in reversed(list(enumerate(DATE_STYLES_SPARK))):
        out = F.when(style == i, F.date_format(d, pat)).otherwise(out)
    return out


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order with items: keys, date, total, first supplier, item, lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    per_order = (
        li.join(part, li.l_partkey == part.p_partkey, "left")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("suppkey"), F.min("p_name").alias("item"),
             F.count(F.lit(1)).alias("n_lines"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "inner").drop("l_orderkey")


def _spark_values() -> dict[str, Column]:
    k = F.col("o_orderkey")
    issue = F.to_date("o_orderdate")
    style = (k % 9) % 4
    pct = _pick(TAX_RATES, k % 5)
    total_c = F.round(F.col("o_totalprice") * 100).cast("long")
    sub_c = F.floor(total_c * 100 / (pct + 100)).cast("long")
    qty = F.col("n_lines").cast("long")
    return {
        "num": F.concat(F.lit("INV-"), (k + NUMBER_OFFSET).cast("string")),
        "issue": _fmt_date(issue, style),
        "due": _fmt_date(F.date_add(issue, DUE_DAYS), style),
        "issuer": F.concat(F.lit("Acme Works "), F.col("suppkey").cast("string"), F.lit(" Ltd")),
        "recipient": F.concat(F.lit("Blue Sky Retail "), F.col("o_custkey").cast("string"), F.lit(" Inc")),
        "total": _money(total_c),
        "sub": _money(sub_c),
        "tax": _money(total_c - sub_c),
        "unit": _money(F.floor(sub_c / qty).cast("long")),
        "qty": qty.cast("string"),
        "pct": pct.cast("string"),
        "cur": _pick(CURRENCIES, k % 4),
        "item": F.coalesce(F.col("item"), F.lit("goods")),
        "po": F.concat(F.lit("PO-"), (F.col("o_custkey") + PO_OFFSET).cast("string")),
    }


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, layout, text) plus truth columns t_<field>."""
    o = order_facts(spark, sf_dir)
    v = _spark_values()
    layout = (F.col("o_orderkey") % 5).cast("int")

    def render(spec) -> Column:
        return F.concat(*[v[p] if isinstance(p, V) else F.lit(p) for p in spec])

    text = F.lit(None).cast("string")
    for i in reversed(range(len(LAYOUTS))):
        text = F.when(layout == i, render(LAYOUTS[i])).otherwise(text)
    return o.select(
        F.col("o_orderkey").alias("doc_id"), layout.alias("layout"), text.alias("text"),
        *[v[val].alias(f"t_{f}") for f, val in TRUTH.items()],
        v["cur"].alias("t_currency"),
    )


def truth(df: DataFrame) -> DataFrame:
    return df.select("doc_id", *[F.col(f"t_{f}").alias(f) for f in TRUTH])


# ------------------------------------------------------------------- SQL --

def _sql_values() -> dict[str, str]:
    def pick(arr, idx):
        lits = ", ".join("'" + str(a) + "'" if isinstance(a, str) else str(a) for a in arr)
        return f"[{lits}][CAST({idx} AS INTEGER) + 1]"

    def fmt(d):
        arms = " ".join(f"WHEN {i} THEN strftime({d}, '{s}')" for i, s in enumerate(DATE_STYLES_SQL))
        return f"(CASE (o_orderkey % 9) % 4 {arms} END)"

    def money(c):
        return f"format('{{:,.2f}}', ({c}) / 100.0)"

    issue = "CAST(o_orderdate AS DATE)"
    pct = pick(TAX_RATES, "o_orderkey % 5")
    total_c = "CAST(round(o_totalprice * 100) AS BIGINT)"
    sub_c = f"(({total_c}) * 100 // ({pct} + 100))"
    return {
        "num": f"('INV-' || CAST(o_orderkey + {NUMBER_OFFSET} AS VARCHAR))",
        "issue": fmt(issue),
        "due": fmt(f"CAST({issue} + INTERVAL {DUE_DAYS} DAY AS DATE)"),
        "issuer": "('Acme Works ' || CAST(suppkey AS VARCHAR) || ' Ltd')",
        "recipient": "('Blue Sky Retail ' || CAST(o_custkey AS VARCHAR) || ' Inc')",
        "total": money(total_c),
        "sub": money(sub_c),
        "tax": money(f"{total_c} - {sub_c}"),
        "unit": money(f"{sub_c} // n_lines"),
        "qty": "CAST(n_lines AS VARCHAR)",
        "pct": f"CAST({pct} AS VARCHAR)",
        "cur": pick(CURRENCIES, "o_orderkey % 4"),
        "item": "coalesce(item, 'goods')",
        "po": f"('PO-' || CAST(o_custkey + {PO_OFFSET} AS VARCHAR))",
    }


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def invoices_sql_cte(name: str = "inv") -> str:
    """DuckDB CTEs ending in ``name``: same columns and text as ``invoices``."""
    v = _sql_values()

    def render(spec):
        return " || ".join(v[p] if isinstance(p, V) else _sql_lit(p) for p in spec)

    arms = " ".join(f"WHEN {i} THEN {render(spec)}" for i, spec in enumerate(LAYOUTS))
    truth_cols = ",\n         ".join(f"{v[val]} AS t_{f}" for f, val in TRUTH.items())
    return f"""
inv_facts AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, suppkey, item, n_lines
  FROM orders JOIN (
    SELECT l_orderkey, min(l_suppkey) AS suppkey, min(p_name) AS item, count(*) AS n_lines
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
  ) po ON o_orderkey = po.l_orderkey
),
{name} AS (
  SELECT o_orderkey AS doc_id, CAST(o_orderkey % 5 AS INTEGER) AS layout,
         CASE CAST(o_orderkey % 5 AS INTEGER) {arms} END AS text,
         {truth_cols},
         {v['cur']} AS t_currency
  FROM inv_facts
)"""


# ------------------------------------------------------------ word boxes --

def word_boxes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Word boxes of a text laid out on a grid: line n at top = 12 n, a
    character 6 units wide, words split on single spaces; page 1.

    Per row only (no shuffle): lines and words are exploded in place.
    """
    lines = docs.select("doc_id", F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    words = (lines.select("doc_id", "line_no", "line", F.posexplode(F.split("line", " ")).alias("pos", "w"))
             .where(F.col("w") != ""))
    # a word begins behind the blank that ends the words before it
    off = F.when(F.col("pos") > 0, F.length(F.call_function("substring_index", F.col("line"), F.lit(" "), F.col("pos"))) + 1).otherwise(0)
    top = (F.col("line_no") * 12).cast("double")
    x0 = (off * 6).cast("double")
    return words.select(
        "doc_id",
        F.lit(1).alias("page"),
        (F.col("line_no").cast("long") * LINE_STRIDE + F.col("pos")).alias("idx"),
        F.col("w").alias("text"),
        x0.alias("x0"),
        (x0 + F.length("w") * 6).cast("double").alias("x1"),
        top.alias("top"),
        (top + 10).alias("bottom"),
        F.lit(-1).alias("conf"),
    )


def word_boxes_sql(inv: str = "inv") -> str:
    """DuckDB SELECT of the same word boxes from table ``inv``."""
    return f"""
SELECT doc_id, 1 AS page, CAST(line_no AS BIGINT) * {LINE_STRIDE} + pos AS idx, w AS text,
       CAST(off * 6 AS DOUBLE) AS x0, CAST(off * 6 + length(w) * 6 AS DOUBLE) AS x1,
       CAST(line_no * 12 AS DOUBLE) AS top, CAST(line_no * 12 + 10 AS DOUBLE) AS bottom, -1 AS conf
FROM (
  SELECT doc_id, line_no, pos, pieces[pos + 1] AS w,
         coalesce(list_sum(list_transform(pieces[1:pos], lambda q: length(q) + 1)), 0) AS off
  FROM (
    SELECT doc_id, line_no, pieces, unnest(range(len(pieces))) AS pos
    FROM (
      SELECT doc_id, line_no, string_split(line, ' ') AS pieces
      FROM (
        SELECT doc_id, lines[i + 1] AS line, i AS line_no
        FROM (SELECT doc_id, lines, unnest(range(len(lines))) AS i
              FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM {inv}))
      )
    )
  )
) WHERE w <> ''"""
