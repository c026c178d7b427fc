"""Scoring extracted fields against gold: fill rate, match rates, recall,
mistakes.

Predictions and gold are joined once on ``doc_id`` and unpivoted to
``(doc_id, field, pred, gold)``; every metric is then a grouped aggregate
over ``field`` (six groups, partial aggregation map-side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import WS, py_strip

DATE_FIELDS = ("invoice_date", "due_date")
PARTY_FIELDS = ("issuer", "recipient")


# -- normalisers of the labeled-image evaluation -----------------------------

def norm_digits(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(c, r"(?U)\D", ""), F.lit(""))


def norm_amount(c: Column) -> Column:
    t = F.regexp_replace(c, r"(?U)[^\d.,]", "")
    t = F.when(t.rlike(r"(?U)^\d+,\d{2}$"), F.replace(t, F.lit(","), F.lit("."))) \
        .otherwise(F.replace(t, F.lit(","), F.lit("")))
    v = t.try_cast("double")
    return F.coalesce(F.when(v.isNotNull(), F.format_string("%.2f", v)).otherwise(t), F.lit(""))


def norm_str(c: Column) -> Column:
    return F.coalesce(F.lower(py_strip(F.regexp_replace(c, WS + "+", " "))), F.lit(""))


def field_match(pred: Column, gold: Column, field: Column) -> Column:
    """No gold: prediction must be empty. Dates compare digits, totals two
    decimals, numbers without '#', parties by substring either way."""
    p_empty = F.coalesce(pred, F.lit("")) == ""
    g_empty = F.coalesce(gold, F.lit("")) == ""
    pn, gn = norm_str(pred), norm_str(gold)
    by_field = (
        F.when(field.isin(*DATE_FIELDS), norm_digits(pred) == norm_digits(gold))
        .when(field == "total", norm_amount(pred) == norm_amount(gold))
        .when(field == "invoice_number",
              F.regexp_replace(pn, "^#+", "") == F.regexp_replace(gn, "^#+", ""))
        .otherwise(F.contains(pn, gn) | F.contains(gn, pn))
    )
    return F.when(g_empty, p_empty).when(p_empty, F.lit(False)).otherwise(by_field)


# -- normalisers of the sheet evaluation -------------------------------------

def norm_value(c: Column) -> Column:
    t = F.regexp_replace(F.lower(c), r"[\s,$€£#]", "")
    return F.coalesce(F.regexp_replace(t, r"\.+$", ""), F.lit(""))


def norm_date(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.lower(c), r"[\s,.\-/]", ""), F.lit(""))


def norm_text(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.lower(c), r"[^a-z0-9]", ""), F.lit(""))


def norm_for_field(c: Column, field: Column) -> Column:
    return (F.when(field.isin(*DATE_FIELDS), norm_date(c))
            .when(field.isin(*PARTY_FIELDS), norm_text(c))
            .otherwise(norm_value(c)))


# -- shapes -------------------------------------------------------------------

def long_form(pred: DataFrame, gold: DataFrame | None = None, gold_prefix: str = "t_") -> DataFrame:
    """(doc_id, field, pred, gold) for docs in both tables. With ``gold``
    None, the gold values are columns ``<gold_prefix><field>`` of ``pred``
    itself (same row, no join)."""
    if gold is None:
        j = pred.select("doc_id", *fixed.FIELDS,
                        *[F.col(gold_prefix + f).alias("g_" + f) for f in fixed.FIELDS])
    else:
        g = gold.select("doc_id", *[F.col(f).alias("g_" + f) for f in fixed.FIELDS])
        j = pred.select("doc_id", *fixed.FIELDS).join(g, "doc_id", "inner")
    pairs = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("pred"), F.col("g_" + f).alias("gold"))
        for f in fixed.FIELDS
    ])
    return j.select("doc_id", F.inline(pairs))


def _field_order() -> Column:
    m = F.create_map(*[x for i, f in enumerate(fixed.FIELDS) for x in (F.lit(f), F.lit(i))])
    return m[F.col("field")]


def field_recall(pred: DataFrame, gold: DataFrame | None = None) -> DataFrame:
    """Per field: rows with gold, hits, recall (4 decimals, null = n/a)."""
    lf = long_form(pred, gold)
    has_gold = F.coalesce(F.col("gold"), F.lit("")) != ""
    hit = has_gold & field_match(F.col("pred"), F.col("gold"), F.col("field"))
    out = lf.groupBy("field").agg(
        F.count_if(has_gold).alias("gt_present"),
        F.count_if(hit).alias("hits"),
    )
    return out.select(
        "field", "gt_present", "hits",
        F.round(F.try_divide(F.col("hits").cast("double"), F.col("gt_present")), 4).alias("recall"),
    )


def field_match_rates(pred: DataFrame, gold: DataFrame | None = None) -> DataFrame:
    """Per field: rows with gold, exact and relaxed (substring) match rate."""
    lf = long_form(pred, gold)
    f = F.col("field")
    p, g = norm_for_field(F.col("pred"), f), norm_for_field(F.col("gold"), f)
    have = g != ""
    exact = have & (p == g)
    relaxed = have & (p != "") & F.contains(g, p) | have & (p != "") & F.contains(p, g)
    out = lf.groupBy("field").agg(
        F.count_if(have).alias("n_with_gt"),
        F.count_if(exact).alias("n_exact"),
        F.count_if(relaxed).alias("n_relaxed"),
    )
    den = F.greatest(F.col("n_with_gt"), F.lit(1)).cast("double")
    return out.select(
        "field", "n_with_gt",
        F.round(F.col("n_exact") / den, 3).alias("exact_match"),
        F.round(F.col("n_relaxed") / den, 3).alias("relaxed_match"),
    )


def field_fill_rate(pred: DataFrame) -> DataFrame:
    """Per field: non-null predictions and their percent of rows."""
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count(F.col(f)).alias(f) for f in fixed.FIELDS]
    wide = pred.agg(*aggs)
    long = wide.select("n_rows", F.inline(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("non_null")) for f in fixed.FIELDS])))
    return long.select(
        "field", "non_null", "n_rows",
        F.round(F.try_divide(F.col("non_null") * 100.0, F.col("n_rows")), 1).alias("pct"),
    )


def mistakes_per_field(pred: DataFrame, gold: DataFrame | None = None, n: int = 5) -> DataFrame:
    """First n mismatches per field, in doc_id order."""
    lf = long_form(pred, gold)
    f = F.col("field")
    miss = F.col("gold").isNotNull() & (
        norm_for_field(F.col("pred"), f) != norm_for_field(F.col("gold"), f))
    w = Window.partitionBy("field").orderBy("doc_id")
    return (lf.where(miss).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("field", "doc_id", "pred", "gold", "rn"))


def worst_documents(pred: DataFrame, n: int = 10, key: str = "doc_id") -> DataFrame:
    nn = sum((F.coalesce(F.col(f), F.lit("")) != "").cast("int") for f in fixed.FIELDS)
    return pred.select(key, nn.alias("non_null_count")).orderBy("non_null_count", key).limit(n)


def gold_from_json_map(df: DataFrame, json_col: str = "gold_json") -> DataFrame:
    """Flat gold JSON: per field the first non-empty of several keys; bad
    JSON gives nulls."""
    m = F.from_json(F.col(json_col), "map<string,string>")
    cols = []
    for f, keys in fixed.GOLD_KEYS.items():
        cols.append(F.coalesce(*[F.when(F.try_element_at(m, F.lit(k)) != "", F.try_element_at(m, F.lit(k))) for k in keys]).alias(f))
    return df.select("doc_id", *cols)


def gold_from_json_nested(df: DataFrame, json_col: str = "gold_json") -> DataFrame:
    cols = [F.when(F.get_json_object(F.col(json_col), p) != "",
                   F.get_json_object(F.col(json_col), p)).alias(f)
            for f, p in fixed.GOLD_PATHS.items()]
    return df.select("doc_id", *cols)
