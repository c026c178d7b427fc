"""Registered invoice queries: rendering, text-path rules, extraction and
its evaluation. Each entry pairs a Spark builder with a DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import invoice as inv_fn
from ..functions import text as tx
from ..operators import evaluate as ev
from ..operators import extract_text as et
from ..sources.invoices import invoices, invoices_sql_cte, truth, word_boxes, word_boxes_sql
from . import sql as S

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


TRUTH_COLS = ("doc_id",) + tuple("t_" + f for f in fixed.FIELDS)


def _inv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoices(spark, sf_dir)


def _pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return et.extract_from_text(_inv(spark, sf_dir), keep=("doc_id",))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inv(spark, sf_dir).select("doc_id", F.posexplode(tx.lines("text")).alias("line_no", "line"))


WITH_INV = "WITH " + invoices_sql_cte("inv")
WITH_EXPECTED = WITH_INV + ",\n" + S.TEXT_EXPECTED_CTE.strip()
LINES_SQL = """
inv_lines AS (
  SELECT doc_id, i AS line_no, ls[i + 1] AS line
  FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM inv))
)"""
WITH_LINES = WITH_INV + "," + LINES_SQL

# -- sources -------------------------------------------------------------------


@register("synthetic_invoices", WITH_INV + """
SELECT doc_id, layout, text, t_invoice_number, t_invoice_date, t_due_date, t_issuer,
       t_recipient, t_total, t_currency FROM inv""")
def q_synthetic_invoices(spark, sf_dir):
    return _inv(spark, sf_dir)


@register("words_from_text", WITH_INV + ", wb AS (" + word_boxes_sql("inv") + ") SELECT * FROM wb")
def q_words_from_text(spark, sf_dir):
    return word_boxes(_inv(spark, sf_dir))


@register("text_lines", WITH_LINES + " SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM inv_lines")
def q_text_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


# -- scalar rules over invoice lines -----------------------------------------------

DATE_SQL = "|".join(fixed.DATE_ALTERNATIVES)
AMOUNT_SQL = fixed.AMOUNT.replace(r"\u00A0", r"\x{00A0}")


@register("find_date", WITH_LINES + f"""
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
       regexp_extract(line, '(?i){DATE_SQL}', 0) AS date_text
FROM inv_lines WHERE regexp_extract(line, '(?i){DATE_SQL}', 0) <> ''""")
def q_find_date(spark, sf_dir):
    d = _lines(spark, sf_dir).select("doc_id", "line_no", inv_fn.find_date("line").alias("date_text"))
    return d.where(F.col("date_text").isNotNull())


AMOUNT_TOKENS_SQL = WITH_LINES + f""",
tok AS (
  SELECT doc_id, line_no, pos, trim(toks[pos + 1], ' ') AS token
  FROM (SELECT doc_id, line_no, toks, unnest(range(len(toks))) AS pos
        FROM (SELECT doc_id, line_no, regexp_extract_all(line, '{AMOUNT_SQL}') AS toks FROM inv_lines))
),
scored AS (
  SELECT *, regexp_replace(regexp_replace(token, '^(?:[$€£]|RM|USD|EUR|GBP)\\s*', ''), '[ \\x{{00A0}}]', '', 'g') AS t,
         NOT regexp_full_match(token, '(?:19|20)[0-9]{{2}}')
           AND (regexp_matches(token, '[$€£]|RM|USD|EUR|GBP') OR regexp_matches(token, '[.,][0-9]{{2}}\\b')
                OR length(regexp_replace(token, '[^0-9]', '', 'g')) >= 3) AS is_monetary
  FROM tok
),
valued AS (
  SELECT *, coalesce(TRY_CAST(CASE WHEN regexp_full_match(t, '[0-9]{{1,3}}(?:\\.[0-9]{{3}})+,[0-9]{{2}}')
                                 THEN replace(replace(t, '.', ''), ',', '.')
                               WHEN regexp_full_match(t, '[0-9]+,[0-9]{{2}}') THEN replace(t, ',', '.')
                               ELSE replace(t, ',', '') END AS DOUBLE), -1.0) AS amount
  FROM scored
)"""


@register("find_amounts", AMOUNT_TOKENS_SQL + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos AS INTEGER) AS pos, token FROM valued""")
def q_find_amounts(spark, sf_dir):
    d = _lines(spark, sf_dir).select("doc_id", "line_no", F.posexplode(inv_fn.find_amounts("line")).alias("pos", "token"))
    return d


@register("is_monetary", AMOUNT_TOKENS_SQL + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos AS INTEGER) AS pos, is_monetary FROM valued""")
def q_is_monetary(spark, sf_dir):
    d = q_find_amounts(spark, sf_dir)
    return d.select("doc_id", "line_no", "pos", inv_fn.is_monetary("token").alias("is_monetary"))


@register("amount_as_double", AMOUNT_TOKENS_SQL + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos AS INTEGER) AS pos, amount FROM valued""")
def q_amount_as_double(spark, sf_dir):
    d = q_find_amounts(spark, sf_dir)
    return d.select("doc_id", "line_no", "pos", inv_fn.amount_as_double("token").alias("amount"))


@register("largest_monetary", AMOUNT_TOKENS_SQL + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, token FROM valued WHERE is_monetary AND amount > -1.0
QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY amount DESC, pos) = 1""")
def q_largest_monetary(spark, sf_dir):
    d = _lines(spark, sf_dir).select("doc_id", "line_no", inv_fn.largest_monetary("line").alias("token"))
    return d.where(F.col("token").isNotNull())


@register("strip_currency", AMOUNT_TOKENS_SQL + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos AS INTEGER) AS pos,
       trim(regexp_replace(token, '^(?:[$€£]|RM|USD|EUR|GBP)\\s*', ''), ' ') AS value FROM valued""")
def q_strip_currency(spark, sf_dir):
    d = q_find_amounts(spark, sf_dir)
    return d.select("doc_id", "line_no", "pos", inv_fn.strip_currency("token").alias("value"))


@register("valid_invoice_number", WITH_LINES + """
, toks AS (
  SELECT doc_id, line_no, pos, regexp_replace(ws[pos + 1], '[:,.;]+$', '') AS cand
  FROM (SELECT doc_id, line_no, ws, unnest(range(len(ws))) AS pos
        FROM (SELECT doc_id, line_no, list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '') AS ws
              FROM inv_lines))
)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, arg_min(cand, pos) AS number
FROM toks
WHERE NOT regexp_full_match(cand, '(?:19|20)[0-9]{2}')
  AND regexp_full_match(cand, '(?i)#?[A-Z0-9][A-Z0-9\\-/]{2,19}')
GROUP BY doc_id, line_no""")
def q_valid_invoice_number(spark, sf_dir):
    d = _lines(spark, sf_dir).select("doc_id", "line_no", inv_fn.valid_invoice_number("line").alias("number"))
    return d.where(F.col("number").isNotNull())


@register("clean_party", WITH_LINES + """
, s1 AS (SELECT doc_id, line_no, regexp_replace(line, '^[ :,\\-]+|[ :,\\-]+$', '', 'g') AS t FROM inv_lines),
s2 AS (SELECT doc_id, line_no,
              regexp_replace(regexp_replace(t, '(?is)\\b(tax\\s*id|vat|iban|phone|tel|email|bank)\\b.*$', ''),
                             '^[ :,\\-]+|[ :,\\-]+$', '', 'g') AS t FROM s1)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, t AS party FROM s2
WHERE length(t) >= 2 AND length(regexp_replace(t, '[^\\pL]', '', 'g')) >= 2""")
def q_clean_party(spark, sf_dir):
    d = _lines(spark, sf_dir).select("doc_id", "line_no", inv_fn.clean_party("line").alias("party"))
    return d.where(F.col("party").isNotNull())


@register("trim_doc_type_suffix", WITH_LINES + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
       trim(regexp_replace(line, '(?i)\\s+(INVOICE|RECEIPT|BILL|STATEMENT|TAX\\s*INVOICE|QUOTATION|QUOTE)\\s*$', ''), ' ') AS trimmed
FROM inv_lines""")
def q_trim_doc_type_suffix(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", "line_no", inv_fn.trim_doc_type_suffix("line").alias("trimmed"))


@register("is_stop_row", WITH_LINES + """
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, regexp_matches(line, '(?i)^(tax\\s*id|vat(?:\\s*no)?|iban|swift|phone|tel|fax|email|e-?mail|website|www\\.|http|payment|bank|account|contact|reg(?:istration)?|invoice|items?|description|qty|quantity|date)\\b') AS is_stop
FROM inv_lines""")
def q_is_stop_row(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", "line_no", inv_fn.is_stop_row("line").alias("is_stop"))


# -- text-path fields ------------------------------------------------------------------

def _field_query(field: str):
    def q(spark, sf_dir):
        return _pred(spark, sf_dir).select("doc_id", field)
    return q


for _f, _num in [("invoice_number", 59), ("invoice_date", 60), ("due_date", 61),
                 ("recipient", 62), ("issuer", 63), ("total", 64)]:
    register(f"text_{_f}", WITH_EXPECTED + f" SELECT doc_id, {_f} FROM expected")(_field_query(_f))


@register("extract_from_text", WITH_EXPECTED + """
SELECT doc_id, invoice_number, invoice_date, due_date, issuer, recipient, total FROM expected""")
def q_extract_from_text(spark, sf_dir):
    return _pred(spark, sf_dir)


@register("extract_job", WITH_EXPECTED + """
SELECT 'invoice_' || CAST(doc_id AS VARCHAR) || '.txt' AS filename, invoice_number, invoice_date, due_date,
       issuer, recipient, total,
       CAST((invoice_number IS NOT NULL AND invoice_number <> '') AS INTEGER)
       + CAST((invoice_date IS NOT NULL AND invoice_date <> '') AS INTEGER)
       + CAST((due_date IS NOT NULL AND due_date <> '') AS INTEGER)
       + CAST((issuer IS NOT NULL AND issuer <> '') AS INTEGER)
       + CAST((recipient IS NOT NULL AND recipient <> '') AS INTEGER)
       + CAST((total IS NOT NULL AND total <> '') AS INTEGER) AS non_null_count
FROM expected""")
def q_extract_job(spark, sf_dir):
    docs = _inv(spark, sf_dir).select(
        F.concat(F.lit("invoice_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), "text")
    out = et.extract_from_text(docs, keep=("filename",))
    return out.withColumn("non_null_count", et.non_null_count(out))


# -- evaluation -------------------------------------------------------------------------

LONG_SQL = ", lf AS (" + S.long_form("expected", "inv") + ")"


@register("join_pred_gold", WITH_EXPECTED + """
SELECT e.doc_id, e.invoice_number, e.invoice_date, e.due_date, e.issuer, e.recipient, e.total,
       i.t_invoice_number AS gt_invoice_number, i.t_invoice_date AS gt_invoice_date,
       i.t_due_date AS gt_due_date, i.t_issuer AS gt_issuer, i.t_recipient AS gt_recipient,
       i.t_total AS gt_total
FROM expected e JOIN inv i ON e.doc_id = i.doc_id""")
def q_join_pred_gold(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    gold = truth(inv).select("doc_id", *[F.col(f).alias("gt_" + f) for f in fixed.FIELDS])
    return et.extract_from_text(inv).join(gold, "doc_id", "inner")


@register("field_recall", WITH_EXPECTED + LONG_SQL + f"""
SELECT field, count_if(coalesce(gold, '') <> '') AS gt_present,
       count_if(coalesce(gold, '') <> '' AND ({S.field_match('pred', 'gold', 'field')})) AS hits,
       round(count_if(coalesce(gold, '') <> '' AND ({S.field_match('pred', 'gold', 'field')}))
             / count_if(coalesce(gold, '') <> ''), 4) AS recall
FROM lf GROUP BY field""")
def q_field_recall(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    return ev.field_recall(et.extract_from_text(inv, keep=TRUTH_COLS))


def _norm_sql(x: str, field: str = "field") -> str:
    return f"""coalesce(CASE WHEN {field} IN ('invoice_date', 'due_date')
                   THEN regexp_replace(lower({x}), '[\\s,.\\-/]', '', 'g')
                 WHEN {field} IN ('issuer', 'recipient') THEN regexp_replace(lower({x}), '[^a-z0-9]', '', 'g')
                 ELSE regexp_replace(regexp_replace(lower({x}), '[\\s,$€£#]', '', 'g'), '\\.+$', '') END, '')"""


@register("field_match_rates", WITH_EXPECTED + LONG_SQL + f"""
, n AS (SELECT field, {_norm_sql('pred')} AS p, {_norm_sql('gold')} AS g FROM lf)
SELECT field, count_if(g <> '') AS n_with_gt,
       round(count_if(g <> '' AND p = g) / greatest(count_if(g <> ''), 1), 3) AS exact_match,
       round(count_if(g <> '' AND p <> '' AND (contains(g, p) OR contains(p, g)))
             / greatest(count_if(g <> ''), 1), 3) AS relaxed_match
FROM n GROUP BY field""")
def q_field_match_rates(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    return ev.field_match_rates(et.extract_from_text(inv, keep=TRUTH_COLS))


@register("mistakes_per_field", WITH_EXPECTED + LONG_SQL + f"""
, m AS (SELECT doc_id, field, pred, gold,
               row_number() OVER (PARTITION BY field ORDER BY doc_id) AS rn
        FROM lf WHERE gold IS NOT NULL AND {_norm_sql('pred')} <> {_norm_sql('gold')})
SELECT field, doc_id, pred, gold, CAST(rn AS INTEGER) AS rn FROM m WHERE rn <= 5""")
def q_mistakes_per_field(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    return ev.mistakes_per_field(et.extract_from_text(inv, keep=TRUTH_COLS), n=5)


_FILL = " UNION ALL ".join(
    f"SELECT '{f}' AS field, count({f}) AS non_null, count(*) AS n_rows FROM expected" for f in fixed.FIELDS)


@register("field_fill_rate", WITH_EXPECTED + f"""
SELECT field, non_null, n_rows, round(CAST(non_null AS DOUBLE) * 100.0 / n_rows, 1) AS pct FROM ({_FILL})""")
def q_field_fill_rate(spark, sf_dir):
    return ev.field_fill_rate(_pred(spark, sf_dir))


_NN = " + ".join(f"CAST(coalesce({f}, '') <> '' AS INTEGER)" for f in fixed.FIELDS)


@register("non_null_count", WITH_EXPECTED + f"SELECT doc_id, {_NN} AS non_null_count FROM expected")
def q_non_null_count(spark, sf_dir):
    p = _pred(spark, sf_dir)
    return p.select("doc_id", et.non_null_count(p).alias("non_null_count"))


@register("worst_documents", WITH_EXPECTED + f"""
SELECT doc_id, {_NN} AS non_null_count FROM expected ORDER BY non_null_count, doc_id LIMIT 10""")
def q_worst_documents(spark, sf_dir):
    return ev.worst_documents(_pred(spark, sf_dir), n=10)


# -- gold JSON -----------------------------------------------------------------------------

def _gold_json_flat(inv: DataFrame) -> DataFrame:
    """Gold as a flat JSON map whose keys vary with the layout; every 50th
    document carries broken JSON."""
    k = F.col("layout")
    date_key = F.element_at(F.array(*[F.lit(x) for x in fixed.GOLD_KEYS["invoice_date"]]), (k % 4 + 1))
    total_key = F.element_at(F.array(*[F.lit(x) for x in fixed.GOLD_KEYS["total"]]), (k % 4 + 1))
    issuer_key = F.element_at(F.array(*[F.lit(x) for x in fixed.GOLD_KEYS["issuer"]]), (k % 4 + 1))
    recip_key = F.element_at(F.array(*[F.lit(x) for x in fixed.GOLD_KEYS["recipient"]]), (k % 5 + 1))
    m = F.create_map(
        F.lit("INVOICE_NUMBER"), F.col("t_invoice_number"),
        date_key, F.col("t_invoice_date"),
        F.lit("DUE_DATE"), F.col("t_due_date"),
        total_key, F.col("t_total"),
        issuer_key, F.col("t_issuer"),
        recip_key, F.col("t_recipient"),
    )
    js = F.when(F.col("doc_id") % 50 == 0, F.lit("{not json")).otherwise(F.to_json(m))
    return inv.select("doc_id", js.alias("gold_json"))


@register("gold_json_flat", WITH_INV + """
SELECT doc_id,
       CASE WHEN doc_id % 50 <> 0 THEN t_invoice_number END AS invoice_number,
       CASE WHEN doc_id % 50 <> 0 THEN t_invoice_date END AS invoice_date,
       CASE WHEN doc_id % 50 <> 0 THEN t_due_date END AS due_date,
       CASE WHEN doc_id % 50 <> 0 THEN t_total END AS total,
       CASE WHEN doc_id % 50 <> 0 THEN t_issuer END AS issuer,
       CASE WHEN doc_id % 50 <> 0 THEN t_recipient END AS recipient
FROM inv""")
def q_gold_json_flat(spark, sf_dir):
    return ev.gold_from_json_map(_gold_json_flat(_inv(spark, sf_dir)))


@register("gold_json_nested", WITH_INV + """
SELECT doc_id, t_invoice_number AS invoice_number, t_invoice_date AS invoice_date,
       CASE WHEN layout <> 4 THEN t_due_date END AS due_date,
       t_issuer AS issuer, t_recipient AS recipient, t_total AS total
FROM inv""")
def q_gold_json_nested(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    js = F.to_json(F.struct(
        F.struct(F.col("t_invoice_number").alias("invoice_number"),
                 F.col("t_invoice_date").alias("invoice_date"),
                 F.when(F.col("layout") != 4, F.col("t_due_date")).otherwise(F.lit("")).alias("due_date"),
                 F.col("t_issuer").alias("seller_name"),
                 F.col("t_recipient").alias("client_name")).alias("invoice"),
        F.struct(F.col("t_total").alias("total")).alias("subtotal")))
    return ev.gold_from_json_nested(inv.select("doc_id", js.alias("gold_json")))


# -- signals on invoices --------------------------------------------------------------------

_SIG_SQL = ", ".join(
    f"CASE WHEN regexp_matches(text, '(?i){pat}') THEN '{tok}' END" for tok, pat in fixed.INVOICE_SIGNALS)


@register("invoice_signals", WITH_INV + f"""
SELECT doc_id, array_to_string(list_filter([{_SIG_SQL}], lambda x: x IS NOT NULL), ' ') AS signals
FROM inv""")
def q_invoice_signals(spark, sf_dir):
    return _inv(spark, sf_dir).select("doc_id", F.array_join(tx.invoice_signals("text"), " ").alias("signals"))


@register("signal_count", WITH_INV + f"""
SELECT doc_id, CAST(len(list_filter([{_SIG_SQL}], lambda x: x IS NOT NULL)) AS INTEGER) AS n_signals FROM inv""")
def q_signal_count(spark, sf_dir):
    return _inv(spark, sf_dir).select("doc_id", tx.signal_count("text").alias("n_signals"))


# -- layout path (word boxes of the rendered invoices) -----------------------------------

from ..operators import extract_layout as el  # noqa: E402

# What the layout rules return on the grid word boxes, derived by hand from
# the rules. Layout 1: a 60-unit column keeps 3 words of the name below its
# label; the issuer has no label and is the header guess. Layouts 2 and 3: an
# issuer label's block is the next row (300 units wide). Layout 3: the number
# is the word behind "#". Layout 4: the bare "date" of "Due Date" ends the row
# start; its greeting is the header guess.
LAYOUT_EXPECTED_CTE = """
lexpected AS (
  SELECT doc_id, layout,
         CASE WHEN layout = 3 THEN '#' || t_invoice_number ELSE t_invoice_number END AS invoice_number,
         CASE WHEN layout = 4 THEN t_due_date ELSE t_invoice_date END AS invoice_date,
         t_due_date AS due_date,
         CASE layout WHEN 2 THEN 'Shipped To: ' || t_recipient WHEN 3 THEN 'Sold To: ' || t_recipient
                     WHEN 4 THEN 'Memo for ' || t_recipient ELSE t_issuer END AS issuer,
         CASE WHEN layout = 1 THEN 'Blue Sky Retail' WHEN layout <> 4 THEN t_recipient END AS recipient,
         t_total AS total
  FROM inv
)"""
WITH_LEXPECTED = WITH_INV + ",\n" + LAYOUT_EXPECTED_CTE.strip()
WB_CTE = ", wb AS (" + word_boxes_sql("inv") + ")"


def _pages(spark, sf_dir):
    return el.pages(word_boxes(_inv(spark, sf_dir)))


def _layout(spark, sf_dir, wanted=fixed.FIELDS):
    return el.extract_from_words(word_boxes(_inv(spark, sf_dir)), wanted)


@register("extract_from_words", WITH_LEXPECTED + """
SELECT doc_id, invoice_number, invoice_date, due_date, issuer, recipient, total FROM lexpected""")
def q_extract_from_words(spark, sf_dir):
    return _layout(spark, sf_dir)


for _f in fixed.FIELDS:
    register(f"layout_{_f}", WITH_LEXPECTED + f" SELECT doc_id, {_f} FROM lexpected")(
        (lambda f: lambda spark, sf_dir: _layout(spark, sf_dir, [f]).select("doc_id", f))(_f))


@register("extract_invoice_fields", WITH_EXPECTED + ",\n" + LAYOUT_EXPECTED_CTE.strip() + """
SELECT t.doc_id, coalesce(l.invoice_number, t.invoice_number) AS invoice_number,
       coalesce(l.invoice_date, t.invoice_date) AS invoice_date, coalesce(l.due_date, t.due_date) AS due_date,
       coalesce(l.issuer, t.issuer) AS issuer, coalesce(l.recipient, t.recipient) AS recipient,
       coalesce(l.total, t.total) AS total
FROM expected t JOIN lexpected l ON t.doc_id = l.doc_id""")
def q_extract_invoice_fields(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    return el.merge_layout_text(et.extract_from_text(inv), el.extract_from_words(word_boxes(inv)))


@register("merge_layout_text", WITH_EXPECTED + ",\n" + LAYOUT_EXPECTED_CTE.strip() + """
SELECT t.doc_id, coalesce(l.invoice_number, t.invoice_number) AS invoice_number,
       coalesce(l.invoice_date, t.invoice_date) AS invoice_date, coalesce(l.due_date, t.due_date) AS due_date,
       coalesce(l.issuer, t.issuer) AS issuer, coalesce(l.recipient, t.recipient) AS recipient,
       coalesce(l.total, t.total) AS total
FROM expected t LEFT JOIN (SELECT * FROM lexpected WHERE layout <> 0) l ON t.doc_id = l.doc_id""")
def q_merge_layout_text(spark, sf_dir):
    """Layout result only for pages of layouts 1-4 (layout 0 keeps its text result)."""
    inv = _inv(spark, sf_dir)
    lay = el.extract_from_words(word_boxes(inv.where(F.col("layout") != 0)))
    return el.merge_layout_text(et.extract_from_text(inv), lay)


@register("first_nonnull_across_pages", WITH_LEXPECTED + """
SELECT doc_id, invoice_number, invoice_date, due_date, issuer, recipient, total FROM lexpected""")
def q_first_nonnull_across_pages(spark, sf_dir):
    """Page 1 = the invoice, page 2 = the same page with every word replaced,
    so without labels and values: the merge must keep page 1's values."""
    inv = _inv(spark, sf_dir)
    wb = word_boxes(inv)
    noise = wb.withColumn("page", F.lit(2)).withColumn("text", F.lit("Notes"))
    return el.first_across_pages(el.extract_from_pages(el.pages(wb.unionByName(noise))))


@register("reading_order_text", WITH_LINES + """
SELECT doc_id, 1 AS page, string_agg(lt, chr(10) ORDER BY line_no) AS text
FROM (SELECT doc_id, line_no, array_to_string(list_filter(string_split(line, ' '), lambda w: w <> ''), ' ') AS lt
      FROM inv_lines) WHERE lt <> '' GROUP BY doc_id""")
def q_reading_order_text(spark, sf_dir):
    return el.reading_order_text(word_boxes(_inv(spark, sf_dir)))


@register("group_rows", WITH_LINES + """
SELECT doc_id, 1 AS page, CAST(count(*) AS INTEGER) AS n_rows
FROM (SELECT doc_id, line_no FROM inv_lines WHERE len(list_filter(string_split(line, ' '), lambda w: w <> '')) > 0)
GROUP BY doc_id""")
def q_group_rows(spark, sf_dir):
    return el.rows_per_page(_pages(spark, sf_dir))


@register("line_height", WITH_INV + WB_CTE + """
SELECT doc_id, page, avg(bottom - top) AS line_height FROM wb GROUP BY doc_id, page""")
def q_line_height(spark, sf_dir):
    return _pages(spark, sf_dir).select("doc_id", "page", F.col("lh").alias("line_height"))


@register("y_overlap", WITH_INV + WB_CTE + """
, nx AS (SELECT doc_id, idx, top, bottom, lead(top) OVER (PARTITION BY doc_id, page ORDER BY idx) AS t2,
                lead(bottom) OVER (PARTITION BY doc_id, page ORDER BY idx) AS b2 FROM wb)
SELECT doc_id, idx,
       CASE WHEN least(bottom, b2) > greatest(top, t2) AND least(bottom - top, b2 - t2) > 0
            THEN (least(bottom, b2) - greatest(top, t2)) / least(bottom - top, b2 - t2) ELSE 0.0 END AS overlap
FROM nx WHERE t2 IS NOT NULL""")
def q_y_overlap(spark, sf_dir):
    pg = _pages(spark, sf_dir)
    pairs = F.transform(F.slice("W", 1, F.size("W") - 1),
                        lambda w, i: F.struct(w["idx"].alias("idx"), el.y_overlap(w, F.element_at("W", i + 2)).alias("overlap")))
    return pg.where("doc_id is not null").select("doc_id", F.inline(pairs))


@register("right_of_join", WITH_INV + WB_CTE + """
SELECT l.doc_id, l.page, l.text AS label,
       coalesce(string_agg(r.text, ' ' ORDER BY r.x0, r.top, r.idx) FILTER (WHERE r.idx IS NOT NULL), '') AS right_text,
       l.idx AS label_idx
FROM (SELECT * FROM wb WHERE text LIKE '%:') l
LEFT JOIN wb r ON r.doc_id = l.doc_id AND r.page = l.page AND r.idx <> l.idx AND r.x0 >= l.x1 - 2
     AND least(l.bottom, r.bottom) > greatest(l.top, r.top)
     AND (least(l.bottom, r.bottom) - greatest(l.top, r.top)) / least(l.bottom - l.top, r.bottom - r.top) >= 0.5
GROUP BY l.doc_id, l.page, l.text, l.idx""")
def q_right_of_join(spark, sf_dir):
    """Per page array form (no pair rows); the oracle states it as a join."""
    pg = _pages(spark, sf_dir)
    return el.right_of_labels(pg.where("doc_id is not null")).select("doc_id", "page", "label", "right_text",
                                                                     F.col("idx").alias("label_idx"))


@register("word_box_source", WITH_INV + WB_CTE + """
SELECT doc_id, idx, text FROM wb
WHERE trim(text) <> '' AND NOT ((length(text) * 13) % 100 - 1 >= 0 AND (length(text) * 13) % 100 - 1 < 30)""")
def q_word_box_source(spark, sf_dir):
    """OCR-style confidence derived from the word (length * 13 mod 100 - 1)."""
    wb = word_boxes(_inv(spark, sf_dir)).withColumn(
        "conf", ((F.length("text") * 13) % 100 - 1).cast("string"))
    return el.word_box_filter(wb).select("doc_id", "idx", "text")


# -- remaining rule-level queries --------------------------------------------------------------

from ..functions import labels as _labels  # noqa: E402
from ..operators import train as _tr  # noqa: E402
from .feature_plans import rule_predictions as _rule_predictions  # noqa: E402,F401


NUMBERED_WORDS = """SELECT doc_id, page, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY idx) - 1 AS INTEGER) AS i,
    text, x0, x1, top, bottom FROM wb"""
_OVERLAP_SQL = """(least(a.bottom, b.bottom) > greatest(a.top, b.top) AND least(a.bottom - a.top, b.bottom - b.top) > 0
    AND (least(a.bottom, b.bottom) - greatest(a.top, b.top)) / least(a.bottom - a.top, b.bottom - b.top) >= 0.5)"""
_ALL_LABELS = "|".join(f"(?:{p.pattern})" for p in _labels.PATTERNS)
# the label spans by the patterns themselves: phrases of 1 to 5 words on one
# line, matched in full; per start word and pattern the shortest
WITH_SPANS = WITH_INV + WB_CTE + f"""
, w AS ({NUMBERED_WORDS}),
pat(label_set, pattern_rank, rx) AS (VALUES {", ".join(f"('{p.label_set}', {p.rank}, '{p.pattern}')" for p in _labels.PATTERNS)}),
on_line AS (SELECT a.doc_id, a.page, a.i, b.i - a.i AS d, b.text, {_OVERLAP_SQL} OR a.i = b.i AS same
    FROM w a JOIN w b ON b.doc_id = a.doc_id AND b.page = a.page AND b.i BETWEEN a.i AND a.i + 4),
phrase AS (SELECT doc_id, page, i, d, bool_and(same) OVER o AS ok, trim(string_agg(text, ' ') OVER o) AS raw
    FROM on_line WINDOW o AS (PARTITION BY doc_id, page, i ORDER BY d)),
cand AS (SELECT doc_id, page, i, d, raw LIKE '%:' AS colon, trim(regexp_replace(lower(raw), ':+$', '')) AS s FROM phrase WHERE ok),
likely AS (SELECT * FROM cand WHERE regexp_full_match(s, '{_ALL_LABELS}')),
hit AS (SELECT doc_id, page, label_set, pattern_rank, i, min(d) AS d, arg_min(colon, d) AS colon
    FROM likely JOIN pat ON regexp_full_match(s, rx) GROUP BY ALL),
scored AS (SELECT h.doc_id, h.page, label_set, pattern_rank, h.i AS start, CAST(h.i + d + 1 AS INTEGER) AS "end",
        CASE WHEN colon THEN 2 ELSE 0 END + CASE WHEN EXISTS (SELECT 1 FROM w b WHERE b.doc_id = a.doc_id AND b.page = a.page AND b.i <> a.i
            AND b.x1 <= a.x0 - 5 AND {_OVERLAP_SQL}) THEN 0 ELSE 1 END AS score, a.text AS label, a.top
    FROM hit h JOIN w a ON a.doc_id = h.doc_id AND a.page = h.page AND a.i = h.i),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id, page, label_set, pattern_rank ORDER BY score DESC, start) = 1)"""


@register("pick_value", WITH_LEXPECTED + " SELECT doc_id, due_date AS value FROM lexpected")
def q_pick_value(spark, sf_dir):
    found = el.scan(_pages(spark, sf_dir), texts=("value", "due"))
    return found.select("doc_id", el.pick_value(F.col("texts"), inv_fn.find_date).alias("value"))


@register("pick_inline", WITH_INV + """
SELECT doc_id, CASE layout WHEN 0 THEN t_invoice_number WHEN 2 THEN '# ' || t_invoice_number
                           WHEN 4 THEN t_invoice_number || ' is payable on' END AS value FROM inv""")
def q_pick_inline(spark, sf_dir):
    found = el.scan(_pages(spark, sf_dir), texts=("inline", "number"))
    return found.select("doc_id", el.pick_inline(F.col("texts")).alias("value"))


@register("pick_block_below", WITH_INV + """
SELECT doc_id, CASE layout WHEN 2 THEN 'Shipped To: ' || t_recipient WHEN 3 THEN 'Sold To: ' || t_recipient END AS value FROM inv""")
def q_pick_block_below(spark, sf_dir):
    found = el.scan(_pages(spark, sf_dir), rows=("block", "issuer"))
    return found.select("doc_id", el.pick_block_below(F.col("rows")).alias("value"))


# the top quarter of layout 0 is its first two lines: an amount, and the due
# date, which reads as an amount when written with dots
@register("header_company_guess", WITH_INV + """
SELECT doc_id, CASE layout WHEN 0 THEN CASE WHEN NOT regexp_matches(t_due_date, '[0-9][.,][0-9]{2}') THEN 'Pay by ' || t_due_date END
                           WHEN 1 THEN t_issuer WHEN 2 THEN 'Reply to your order' WHEN 3 THEN 'Counter note #' || t_invoice_number
                           ELSE 'Memo for ' || t_recipient END AS value FROM inv""")
def q_header_company_guess(spark, sf_dir):
    found = el.scan(_pages(spark, sf_dir), rows=("header", None))
    return found.select("doc_id", el.header_company_guess(F.col("rows")).alias("value"))


@register("label_positions", WITH_SPANS + """
SELECT doc_id, page, label_set, CAST(row_number() OVER (PARTITION BY doc_id, page, label_set ORDER BY pattern_rank) - 1 AS INTEGER) AS position,
       start, "end", label, top FROM best""")
def q_label_positions(spark, sf_dir):
    return el.label_positions(_pages(spark, sf_dir))


@register("best_label_span", WITH_SPANS + " SELECT doc_id, page, label_set, pattern_rank, start, \"end\", score FROM best")
def q_best_label_span(spark, sf_dir):
    return el.best_label_spans(_pages(spark, sf_dir))


@register("label_spans", WITH_SPANS + " SELECT doc_id, page, label_set, pattern_rank, start, \"end\", score FROM scored")
def q_label_spans(spark, sf_dir):
    return el.label_spans(_pages(spark, sf_dir))


@register("below_join", WITH_INV + WB_CTE + f"""
, w AS ({NUMBERED_WORDS}),
h AS (SELECT doc_id, page, avg(bottom - top) AS lh FROM w GROUP BY ALL),
b AS (SELECT l.doc_id, l.page, l.i AS word_idx, l.text AS label, r.text, r.top, r.x0, r.i, lh,
             min(r.top) OVER (PARTITION BY l.doc_id, l.page, l.i) AS first_top
      FROM w l JOIN h USING (doc_id, page) LEFT JOIN w r ON r.doc_id = l.doc_id AND r.page = l.page AND r.i <> l.i
           AND r.top > l.bottom - lh * 0.2 AND r.top < l.bottom + 2 * lh
      WHERE l.text LIKE '%:')
SELECT doc_id, page, word_idx, label, string_agg(text, ' ' ORDER BY x0, top, i) FILTER (top - first_top < lh * 0.6) AS below_text
FROM b GROUP BY doc_id, page, word_idx, label""")
def q_below_join(spark, sf_dir):
    return el.first_row_below(_pages(spark, sf_dir))


@register("label_value_lookup", WITH_INV + """
SELECT doc_id, CASE WHEN layout = 2
       THEN 'PO-' || CAST(CAST(regexp_extract(t_recipient, '([0-9]+)', 1) AS BIGINT) + 10000 AS VARCHAR) END AS value
FROM inv""")
def q_label_value_lookup(spark, sf_dir):
    """Generic label -> value lookup over lines: a 'PO Number' label with the
    invoice-number validator."""
    ls = tx.lines("text")
    v = et.label_value_lookup(ls, r"po\s*number\s*:?", inv_fn.valid_invoice_number)
    return _inv(spark, sf_dir).select("doc_id", v.alias("value"))


@register("error_to_null_row", WITH_EXPECTED + """
SELECT doc_id, """ + ", ".join(f"CASE WHEN doc_id % 97 <> 0 THEN {f} END AS {f}" for f in fixed.FIELDS) + """
FROM expected""")
def q_error_to_null_row(spark, sf_dir):
    """Unreadable documents (every 97th has no text) keep their row with six nulls."""
    inv = _inv(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 97 != 0, F.col("text")))
    return et.extract_from_text(inv)


@register("normalise_for_match", WITH_INV + """
SELECT doc_id,
       regexp_replace(regexp_replace(lower(t_total), '[\\s,$€£#]', '', 'g'), '\\.+$', '') AS total_norm,
       regexp_replace(lower(t_invoice_date), '[\\s,.\\-/]', '', 'g') AS date_norm,
       regexp_replace(lower(t_issuer), '[^a-z0-9]', '', 'g') AS issuer_norm
FROM inv""")
def q_normalise_for_match(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    return inv.select("doc_id", ev.norm_value(F.col("t_total")).alias("total_norm"),
                      ev.norm_date(F.col("t_invoice_date")).alias("date_norm"),
                      ev.norm_text(F.col("t_issuer")).alias("issuer_norm"))


@register("normalise_labeled", WITH_INV + f"""
SELECT doc_id, regexp_replace(t_invoice_date, '[^0-9]', '', 'g') AS date_norm,
       {S.norm_amount('t_total')} AS total_norm, {S.norm_str('t_issuer')} AS issuer_norm
FROM inv""")
def q_normalise_labeled(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    return inv.select("doc_id", ev.norm_digits(F.col("t_invoice_date")).alias("date_norm"),
                      ev.norm_amount(F.col("t_total")).alias("total_norm"),
                      ev.norm_str(F.col("t_issuer")).alias("issuer_norm"))


@register("field_match", WITH_EXPECTED + LONG_SQL + f"""
SELECT doc_id, field, {S.field_match('pred', 'gold', 'field')} AS is_match FROM lf""")
def q_field_match(spark, sf_dir):
    inv = _inv(spark, sf_dir)
    lf = ev.long_form(et.extract_from_text(inv, keep=TRUTH_COLS))
    return lf.select("doc_id", "field", ev.field_match(F.col("pred"), F.col("gold"), F.col("field")).alias("is_match"))


@register("invoice_override", WITH_INV + f"""
, s AS (SELECT doc_id, CAST(len(list_filter([{_SIG_SQL}], lambda x: x IS NOT NULL)) AS INTEGER) AS n_signals,
               CASE WHEN regexp_matches(text, '[éèêç]') THEN 'fr' WHEN regexp_matches(text, '[üßäö]') THEN 'de'
                    WHEN regexp_matches(text, '[ñáíó]') THEN 'es' ELSE 'en' END AS pred FROM inv)
SELECT doc_id, CASE WHEN n_signals >= 4 THEN 'invoice' ELSE pred END AS label,
       CASE WHEN n_signals >= 4 THEN 0.0 ELSE 1.0 END AS confidence, n_signals >= 4 AS overridden FROM s""")
def q_invoice_override(spark, sf_dir):
    """Signal override on a fixed rule predictor (class map = its guess)."""
    t = F.col("text")
    pred = (F.when(t.rlike("[éèêç]"), "fr").when(t.rlike("[üßäö]"), "de")
            .when(t.rlike("[ñáíó]"), "es").otherwise("en"))
    scored = _inv(spark, sf_dir).select(
        "doc_id", pred.alias("label"), F.lit(1.0).alias("confidence"),
        F.create_map(pred, F.lit(1.0)).alias("proba"), tx.signal_count("text").alias("n_signals"))
    return _tr.invoice_override(scored).select("doc_id", "label", "confidence", "overridden")


# Integer widths as Spark returns them.
for _name, _types in {
    'field_recall': {'gt_present': 'BIGINT', 'hits': 'BIGINT'},
    'field_match_rates': {'n_with_gt': 'BIGINT'},
    'invoice_override': {'confidence': 'DOUBLE'},
}.items():
    ORACLES[_name] = S.typed(ORACLES[_name], **_types)
