"""Six invoice fields from word boxes (layout path), per page.

Words are grouped once per (doc_id, page) into an array of structs in reading
order; a page is physically bounded (hundreds to a few thousand words), so the
group never grows with the corpus. ``page_words.scan`` then looks at many pages
at a time and lists, per rule, the texts the rule may take its value from:

* visual rows: one sweep over the words sorted by (top, x0); a word joins the
  current row when its top is within ``tol`` of the row's first word (the
  anchor), not of the previous word;
* label matches: for each start word that can begin a label, the lower-cased
  text of the next 1..5 words that stay on the start word's line (y-overlap
  >= 0.5) is looked up in the dictionary of all label spellings
  (``functions.labels``); per pattern the shortest one counts. Its score
  prefers a trailing ':' (+2), then a row start (+1);
* the best span per pattern has the highest score, then the lowest index;
* values: same-row words right of the label (up to the next ``...:`` word),
  else up to 4 visual rows below, column-aligned first, then the whole row;
* blocks: up to 6 rows below within a column window.

The rules here decide on these texts: the first one that validates wins,
patterns in order; a stop row ends a block.

Fields of several pages are merged by page order (first non-null), and the
layout result is merged with the text-path result field by field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, labels
from ..functions.invoice import (
    clean_party, find_date, is_doc_type_word, is_stop_row, largest_monetary, strip_currency,
    trim_doc_type_suffix, valid_invoice_number,
)
from ..functions.text import UI, U, let, py_strip, strip_chars
from .page_words import scan

# -- geometry -------------------------------------------------------------------------

def y_overlap(a: Column, b: Column) -> Column:
    """Shared height / smaller height, 0 when none."""
    top = F.greatest(a["top"], b["top"])
    bot = F.least(a["bottom"], b["bottom"])
    span = F.least(a["bottom"] - a["top"], b["bottom"] - b["top"])
    return F.when((bot > top) & (span > 0), (bot - top) / span).otherwise(F.lit(0.0))


def line_height(W: Column) -> Column:
    n = F.size(W)
    tot = F.aggregate(W, F.lit(0.0), lambda a, w: a + (w["bottom"] - w["top"]))
    return F.when(n > 0, tot / n).otherwise(F.lit(fixed.DEFAULT_LINE_HEIGHT))


def sort_by_x(ws: Column) -> Column:
    """Stable sort by x0 (ties keep (top, index) order)."""
    keyed = F.transform(ws, lambda w: F.struct(w["x0"].alias("k"), w["top"].alias("t"), w["i"].alias("j"),
                                               w.alias("w")))
    return F.transform(F.sort_array(keyed), lambda s: s["w"])


def join_text(ws: Column) -> Column:
    return F.array_join(F.transform(ws, lambda w: w["text"]), " ")


def group_rows(ws: Column, tol: Column) -> Column:
    """Visual rows: sort by (top, x0), cut where a word's top leaves the row's
    first word by ``tol`` or more, then sort each row by x0. The sweep carries
    the current anchor and the places of the cuts, not the words."""
    keyed = F.transform(ws, lambda w: F.struct(w["top"].alias("t"), w["x0"].alias("x"), w["i"].alias("j"),
                                               w.alias("w")))

    def cut_rows(o):
        start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("at"),
                         F.array().cast("array<int>").alias("cuts"))

        def step(acc, w):
            joins = F.coalesce(F.abs(w["t"] - acc["anchor"]) < tol, F.lit(False))
            return F.struct(F.when(joins, acc["anchor"]).otherwise(w["t"]).alias("anchor"), (acc["at"] + 1).alias("at"),
                            F.when(joins, acc["cuts"]).otherwise(F.array_append(acc["cuts"], acc["at"])).alias("cuts"))

        cuts = F.aggregate(o, start, step, lambda acc: acc["cuts"])
        return let(cuts, lambda c: F.transform(c, lambda s, k: sort_by_x(F.transform(
            F.slice(o, s + 1, F.coalesce(F.get(c, k + 1), F.size(o)) - s), lambda x: x["w"]))))

    return let(F.sort_array(keyed), cut_rows)


# -- pickers ----------------------------------------------------------------------------

def _first(arr: Column) -> Column:
    return F.get(F.filter(arr, lambda x: x.isNotNull()), 0)


def _first_of(arr: Column, fn) -> Column:
    """fn(x) of the first x (in order) where it is not null. A fold with
    coalesce: fn is not evaluated once a value was found."""
    return F.aggregate(arr, F.lit(None).cast("string"), lambda acc, x: F.coalesce(acc, fn(x)))


def _text_of(text: Column, validate) -> Column:
    return let(py_strip(text), validate)


def pick_value(texts: Column, validate) -> Column:
    """Per label span (pattern order): same-row right text; else up to 4 rows
    below, column-aligned then whole row; first candidate that validates.
    ``texts``: a scan of kind "value"."""
    return _first_of(texts, lambda t: _text_of(t, validate))


def pick_block_below(blocks: Column) -> Column:
    """First clean, column-aligned row below a block label; a stop row ends
    that label's block. ``blocks``: a scan of kind "block"."""
    def usable(texts):
        stops = F.transform(texts, lambda t: F.coalesce(is_stop_row(t), F.lit(False)))
        first_stop = F.array_position(stops, True)
        kept = F.when(first_stop > 0, F.slice(texts, 1, (first_stop - 1).cast("int"))).otherwise(texts)
        return _first_of(kept, lambda t: let(t, clean_party))

    return _first_of(blocks, lambda rows: let(F.transform(rows, py_strip), usable))


def pick_inline(texts: Column) -> Column:
    """Same-row text right of the first label (pattern order) that has any,
    up to the next '...:' word (no validation). ``texts``: a scan of kind "inline"."""
    return _first_of(texts, py_strip)


def header_company_guess(rows: Column) -> Column:
    """The first visual row among the words of the page's top quarter that
    looks like a company's name. ``rows``: a scan of kind "header"."""
    def cand(r):
        t = trim_doc_type_suffix(strip_chars(r, fixed.PARTY_STRIP_CHARS))
        return let(t, lambda t: F.when(~((F.char_length(t) < 3) | is_doc_type_word(t) | is_stop_row(t) | t.rlike(U + fixed.HEADER_MONEY)
                                         | (F.regexp_count(t, F.lit(r"\p{L}")) < 3)), t))

    return _first_of(rows, cand)


# -- fields -----------------------------------------------------------------------------
# Each field of a page by the scans it needs (``SCANS``).

def layout_invoice_number() -> Column:
    """By the labels, else the first word that is a number behind "#"."""
    rx = UI + "^" + fixed.HASH_NUMBER_WORD + "$"
    marked = _first(F.transform("_marked", lambda t: F.when(t.rlike(rx), F.concat(F.lit("#"), F.regexp_extract(t, rx, 1)))))
    return F.coalesce(pick_value(F.col("_number"), valid_invoice_number), marked)


def layout_invoice_date() -> Column:
    """By the labels, else the first dated visual row whose rounded top is not
    that of a due-date label (half-even rounding)."""
    return F.coalesce(pick_value(F.col("_issue"), find_date), _first_of(F.col("_undated"), lambda t: let(t, find_date)))


def layout_due_date() -> Column:
    return pick_value(F.col("_due"), find_date)


def layout_issuer() -> Column:
    """An issuer's block comes before the value beside its label."""
    return F.coalesce(pick_block_below(F.col("_issuer_block")), pick_value(F.col("_issuer"), clean_party), header_company_guess(F.col("_header")))


def layout_recipient() -> Column:
    """The value beside the label comes before the block."""
    return F.coalesce(pick_value(F.col("_recipient"), clean_party), pick_block_below(F.col("_recipient_block")))


def layout_total() -> Column:
    """Same-row amount right of the first label word, else the 2 rows below;
    the largest monetary token, currency stripped."""
    return let(_first_of(F.col("_total"), lambda t: let(t, largest_monetary)), strip_currency)


# Per field its rule and the scans it reads.
FIELDS = {
    "invoice_number": (layout_invoice_number, {"_number": ("value", "number"), "_marked": ("marked", None)}),
    "invoice_date": (layout_invoice_date, {"_issue": ("value", "issue"), "_undated": ("undated", None)}),
    "due_date": (layout_due_date, {"_due": ("value", "due")}),
    "issuer": (layout_issuer, {"_issuer_block": ("block", "issuer"), "_issuer": ("value", "issuer"), "_header": ("header", None)}),
    "recipient": (layout_recipient, {"_recipient": ("value", "recipient"), "_recipient_block": ("block", "recipient")}),
    "total": (layout_total, {"_total": ("total", None)}),
}


# -- label matches -----------------------------------------------------------------------

def spans(M: Column, label_set: str) -> Column:
    """Best span of each pattern of a set that has one, in pattern order:
    struct(neg, start, end, p)."""
    mine = labels.numbers(label_set)

    def best(own):
        each = F.transform(F.array(*map(F.lit, mine)), lambda p: F.array_min(F.transform(
            F.filter(own, lambda m: m["p"] == p),
            lambda m: F.struct((-m["score"]).alias("neg"), m["start"].alias("start"), m["end"].alias("end"), m["p"].alias("p")))))
        return F.filter(each, lambda b: b.isNotNull())

    # bound: a projection with one use of M is merged into this one, and M would
    # be matched anew for each pattern
    return let(F.filter(M, lambda m: m["p"].between(mine[0], mine[-1])), best)


# -- page and document -------------------------------------------------------------------

def pages(words: DataFrame) -> DataFrame:
    """(doc_id, page, W, lh, R): W the page's words in reading order (with
    their ``idx`` in the source), lh their mean height, R its visual rows."""
    w = F.struct(F.col("idx").alias("k"), F.col("text"), F.col("x0").cast("double").alias("x0"),
                 F.col("x1").cast("double").alias("x1"), F.col("top").cast("double").alias("top"),
                 F.col("bottom").cast("double").alias("bottom"))
    # words that are dealt by document already (as after a join on it) stay where
    # they are; others are gathered by page before they are sent
    g = words.groupBy("doc_id", "page").agg(F.sort_array(F.collect_list(w)).alias("_w"))
    plain = F.transform("_w", lambda s, i: F.struct(
        i.cast("int").alias("i"), *[s[c].alias(c) for c in ("text", "x0", "x1", "top", "bottom")], s["k"].alias("idx")))
    g = g.select("doc_id", "page", plain.alias("W"))
    g = g.select("doc_id", "page", "W", line_height(F.col("W")).alias("lh"))
    return g.select("*", group_rows(F.col("W"), F.col("lh") * fixed.ROW_TOL_FACTOR).alias("R"))


def with_matches(pg: DataFrame) -> DataFrame:
    """M: every match of every label pattern: struct(p, start, end, colon, score),
    p the pattern's number, in order of start and length."""
    return scan(pg, keep=pg.columns, M=("matches", None))


def extract_from_pages(pg: DataFrame, wanted=fixed.FIELDS) -> DataFrame:
    """(doc_id, page, the wanted ones of the six fields) for each page of word
    boxes: the matches once, then the pickers."""
    found = scan(pg, **{k: v for f in wanted for k, v in FIELDS[f][1].items()})
    return found.select("doc_id", "page", *[FIELDS[f][0]().alias(f) for f in wanted])


def first_across_pages(per_page: DataFrame) -> DataFrame:
    """Per document, per field, the value of the first page that has one."""
    return per_page.groupBy("doc_id").agg(*[
        F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("page"))).alias(f) for f in per_page.columns if f in fixed.FIELDS])


def extract_from_words(words: DataFrame, wanted=fixed.FIELDS) -> DataFrame:
    return first_across_pages(extract_from_pages(pages(words), wanted))


def merge_layout_text(text_fields: DataFrame, layout_fields: DataFrame) -> DataFrame:
    """Per field the layout value when present, else the text value."""
    t = text_fields.select("doc_id", *[F.col(f).alias("t_" + f) for f in fixed.FIELDS])
    lay = layout_fields.select("doc_id", *[F.col(f).alias("l_" + f) for f in fixed.FIELDS])
    j = t.join(lay, "doc_id", "left")
    return j.select("doc_id", *[F.coalesce(F.col("l_" + f), F.col("t_" + f)).alias(f) for f in fixed.FIELDS])


def reading_order_text(words: DataFrame) -> DataFrame:
    """Words -> lines by y band (tol = max(3, mean height / 2)), joined."""
    pg = pages(words)
    rows = group_rows(F.col("W"), F.greatest(F.lit(fixed.READING_ORDER_MIN_TOL), F.col("lh") / 2))
    return pg.select("doc_id", "page", F.array_join(F.transform(rows, join_text), "\n").alias("text"))


def word_box_filter(words: DataFrame, min_conf: int = fixed.OCR_MIN_CONF) -> DataFrame:
    """Drop blank words and words with 0 <= conf < min_conf (-1 is kept)."""
    conf = F.coalesce(F.col("conf").try_cast("double").cast("int"), F.lit(-1))
    return words.where((py_strip(F.col("text")) != "") & ~((conf >= 0) & (conf < min_conf)))


def _inlined(pg: DataFrame, structs: Column) -> DataFrame:
    """One row per struct. The outer form, as the optimizer derives a filter on
    the whole array from the inner one and evaluates it below the page's columns."""
    return pg.select("doc_id", "page", F.explode_outer(structs).alias("s")).where("s is not null").select("doc_id", "page", "s.*")


def right_of_labels(pg: DataFrame) -> DataFrame:
    """For each word ending with ':' the text of the words on its row right
    of it (x0 >= x1 - 2, y-overlap >= 0.5), in x order."""
    found = scan(pg, s=("beside", None))
    return _inlined(found, F.col("s")).withColumnRenamed("text", "right_text")


def rows_per_page(pg: DataFrame) -> DataFrame:
    return pg.select("doc_id", "page", F.size("R").alias("n_rows"))


def first_row_below(pg: DataFrame) -> DataFrame:
    """For each word ending with ':' the text of the first visual row below it
    (band join inside the page)."""
    found = scan(pg, s=("below", None))
    return _inlined(found, F.col("s")).withColumnRenamed("text", "below_text").drop("idx")


def _set_names() -> tuple[Column, Column]:
    """Label set and place in it of a match's pattern number ``p``."""
    names = F.array(*[F.lit(p.label_set) for p in labels.PATTERNS])
    ranks = F.array(*[F.lit(p.rank) for p in labels.PATTERNS])
    return F.get(names, F.col("p")).alias("label_set"), F.get(ranks, F.col("p")).alias("pattern_rank")


def label_spans(pg: DataFrame) -> DataFrame:
    """(doc_id, page, label_set, pattern_rank, start, end, score): every span
    that matches a label pattern, of all label sets."""
    return _inlined(scan(pg, M=("matches", None)), F.col("M")).select("doc_id", "page", *_set_names(), "start", "end", "score")


def best_label_spans(pg: DataFrame) -> DataFrame:
    """The best span of each pattern, of all label sets, in the same columns."""
    best = F.concat(*[spans(F.col("M"), name) for name in labels.LABEL_SETS])
    return _inlined(scan(pg, M=("matches", None)), best).select("doc_id", "page", *_set_names(), "start", "end", (-F.col("neg")).alias("score"))


def label_positions(pg: DataFrame) -> DataFrame:
    """(doc_id, page, label_set, position, start, end, label, top): the labels
    found of each set, in pattern order, with the label's first word."""
    def listed(name):
        return F.transform(spans(F.col("M"), name), lambda sp, k: F.struct(
            F.lit(name).alias("label_set"), k.alias("position"), sp["start"].alias("start"), sp["end"].alias("end"),
            F.element_at(F.col("W"), sp["start"] + 1)["text"].alias("label"), F.element_at(F.col("W"), sp["start"] + 1)["top"].alias("top")))
    return _inlined(scan(pg, keep=["W"], M=("matches", None)), F.concat(*[listed(name) for name in labels.LABEL_SETS]))
