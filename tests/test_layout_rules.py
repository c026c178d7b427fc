"""Hand-worked layout cases: inline value, row folding on the anchor word,
confidence filter."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import labels
from quarry.operators import extract_layout as el
from quarry.operators import page_words as pw
from quarry.sources.invoices import word_boxes

SCHEMA = "doc_id long, page int, idx long, text string, x0 double, x1 double, top double, bottom double"


def words(spark, rows):
    return spark.createDataFrame([(1, 1, i, *r) for i, r in enumerate(rows)], SCHEMA)


def test_inline_date(spark):
    w = words(spark, [("Date", 100.0, 125.0, 10.0, 20.0), ("of", 130.0, 140.0, 10.0, 20.0),
                      ("issue:", 145.0, 200.0, 10.0, 20.0), ("11/03/2017", 400.0, 460.0, 10.0, 20.0)])
    r = el.extract_from_words(w).collect()[0]
    assert r["invoice_date"] == "11/03/2017"


def test_block_below(spark):
    w = words(spark, [("Seller:", 0.0, 42.0, 0.0, 10.0), ("Client:", 300.0, 342.0, 0.0, 10.0),
                      ("Northgate", 0.0, 24.0, 12.0, 22.0), ("Parts", 30.0, 48.0, 12.0, 22.0),
                      ("Harbour", 300.0, 324.0, 12.0, 22.0), ("PLC", 330.0, 348.0, 12.0, 22.0)])
    r = el.extract_from_words(w).collect()[0]
    # the block reaches 300 units right of the label, so it takes the
    # client's first word too (the rules as built)
    assert r["issuer"] == "Northgate Parts Harbour"
    assert r["recipient"] == "Harbour PLC"


def test_rows_fold_on_anchor(spark):
    w = words(spark, [("a", 0.0, 6.0, 10.0, 16.0), ("b", 10.0, 16.0, 14.0, 20.0),
                      ("c", 20.0, 26.0, 17.0, 23.0), ("d", 30.0, 36.0, 18.0, 24.0)])
    pg = el.pages(w)
    rows = pg.select(el.group_rows(F.col("W"), F.lit(6.0)).alias("r")).collect()[0]["r"]
    assert [[x["text"] for x in row] for row in rows] == [["a", "b"], ["c", "d"]]


def test_conf_filter(spark):
    df = spark.createDataFrame([("x", "-1"), ("y", "10"), ("z", "30"), (" ", "90")], "text string, conf string")
    kept = sorted(r["text"] for r in el.word_box_filter(df).collect())
    assert kept == ["x", "z"]


def test_no_words_no_fields(spark):
    w = spark.createDataFrame([], SCHEMA)
    assert el.extract_from_words(w).count() == 0


def plain_spans(page):
    """(pattern, start, end, score) of every label match, word by word with the patterns themselves."""
    def overlap(a, b):
        both, least = min(a[4], b[4]) - max(a[3], b[3]), min(a[4] - a[3], b[4] - b[3])
        return both / least if both > 0 and least > 0 else 0.0

    out = []
    for i, w in enumerate(page):
        begins = not any(o is not w and o[2] <= w[1] - 5 and overlap(w, o) >= 0.5 for o in page)
        done = set()
        for n in range(1, 6):
            line = page[i:i + n]
            if len(line) < n or any(overlap(w, o) < 0.5 for o in line[1:]):
                break
            raw = " ".join(o[0] for o in line).strip()
            phrase = raw.lower().rstrip(":").strip()
            for k, p in enumerate(labels.PATTERNS):
                if k not in done and re.fullmatch(p.pattern, phrase, re.I):
                    done.add(k)
                    out.append((k, i, i + n, 2 * raw.endswith(":") + begins))
    return out


def random_page(seed, n, lines):
    r = random.Random(seed)
    vocab = ["Invoice", "No", "no.", "Number:", "#", "Date", "date:", "of", "issue", "Due", "DUE:", "Total", "Amount", "Sub", "Grand", "Bill", "To",
             "to:", "From:", "Sold", "Inv", "Ref", "PO", "x", "12.50", "Acme", "Payment", "due", "Balance", "Ship", "Customer", "Vendor:"]
    out = []
    for _ in range(n):
        x, y, h = r.randrange(0, 500), 12.0 * r.randrange(lines) + r.choice([0, 0, 0, 3, 6]), r.choice([10.0, 10.0, 10.0, 14.0, 5.0])
        out.append((r.choice(vocab), float(x), float(x + 20), y, y + h))
    return sorted(out, key=lambda w: (w[3], w[1]))


def test_label_spans_against_the_patterns(spark):
    pages = {d: random_page(d, 150, 14) for d in range(12)}
    pages[99] = random_page(99, 60, 4) + [("Date:", 0.0, 9.0, 0.0, 400.0)]               # one word as high as the page
    w = spark.createDataFrame([(d, 1, i, *x) for d, p in pages.items() for i, x in enumerate(p)], SCHEMA)
    rank = {(p.label_set, p.rank): k for k, p in enumerate(labels.PATTERNS)}
    got = sorted((r.doc_id, rank[r.label_set, r.pattern_rank], r.start, r.end, r.score) for r in el.label_spans(el.pages(w)).collect())
    assert got == sorted((d, *m) for d, p in pages.items() for m in plain_spans(p)) and len(got) > 200
    best = {(r.doc_id, rank[r.label_set, r.pattern_rank]): (r.start, r.end, r.score) for r in el.best_label_spans(el.pages(w)).collect()}
    want = {}
    for d, k, a, b, score in got:
        if (d, k) not in want or (-score, a) < (-want[d, k][2], want[d, k][0]):
            want[d, k] = (a, b, score)
    assert best == want
    found = el.label_positions(el.pages(w)).collect()
    assert {(r.doc_id, r.label_set, r.start, r.end) for r in found} == {(d, labels.PATTERNS[k].label_set, a, b) for (d, k), (a, b, _) in want.items()}
    assert all(r.label == pages[r.doc_id][r.start][0] and r.top == pages[r.doc_id][r.start][3] for r in found)


def test_words_beside_and_below_are_found_in_their_rows(spark):
    """The rows around a word hold all words that the rules look at."""
    pages = {d: random_page(d, 120, 10) for d in range(20, 28)}
    pages[98] = random_page(98, 50, 4) + [("bar:", 0.0, 3.0, 0.0, 500.0)]
    w = spark.createDataFrame([(d, 1, i, *x) for d, p in pages.items() for i, x in enumerate(p)], SCHEMA)

    def overlap(a, b):
        both, least = min(a[4], b[4]) - max(a[3], b[3]), min(a[4] - a[3], b[4] - b[3])
        return both > 0 and least > 0 and both / least >= 0.5

    right, below = {}, {}
    for d, p in pages.items():
        lh = sum(x[4] - x[3] for x in p) / len(p)
        for i, x in enumerate(p):
            if x[0].endswith(":"):
                beside = sorted((o[1], o[3], j) for j, o in enumerate(p) if j != i and o[1] >= x[2] - 2 and overlap(x, o))
                right[d, i] = " ".join(p[j][0] for _, _, j in beside)
                under = sorted((o[3], o[1], j) for j, o in enumerate(p) if j != i and x[4] - lh * 0.2 < o[3] < x[4] + 2 * lh)
                row = [u for u in under if u[0] - under[0][0] < lh * 0.6]
                below[d, i] = " ".join(p[j][0] for _, _, j in sorted(row, key=lambda u: (u[1], u[0], u[2]))) or None
    assert {(r.doc_id, r.word_idx): r.right_text for r in el.right_of_labels(el.pages(w)).collect()} == right
    assert {(r.doc_id, r.word_idx): r.below_text for r in el.first_row_below(el.pages(w)).collect()} == below


def test_words_keep_their_place_in_the_source(spark):
    """Results name a word by its source's idx without reading the words again."""
    w = words(spark, [("No:", 0.0, 18.0, 0.0, 10.0), ("7", 24.0, 30.0, 0.0, 10.0), ("Due:", 0.0, 24.0, 12.0, 22.0)])
    pg = el.pages(w.withColumn("idx", F.col("idx") * 1000 + 5))
    assert sorted((r.idx, r.right_text) for r in el.right_of_labels(pg).collect()) == [(5, "7"), (2005, "")]


def test_word_boxes_begin_behind_the_words_before_them(spark):
    text = " a  bc d\n\nlast "
    boxes = word_boxes(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"))
    want = [(n, m.group(), m.start() * 6.0, m.end() * 6.0) for n, line in enumerate(text.split("\n")) for m in re.finditer("[^ ]+", line)]
    assert [(int(r.top / 12), r.text, r.x0, r.x1) for r in boxes.orderBy("idx").collect()] == want
    # an offset is one expression, not a fold over the words before it
    assert "lambdafunction" not in boxes._jdf.queryExecution().optimizedPlan().toString()


def test_labels_with_other_blanks_and_letters_are_found(spark):
    """The short way for plain ASCII and the full one agree."""
    found = {}
    for k, (a, b) in enumerate([("Total", "Due:"), ("Total", "DUE :"), ("\u00a0Total", "due:"), ("Total\t", "Due"), ("B\u0131ll", "to::")]):
        w = words(spark, [(a, 0.0, 30.0, 0.0, 10.0), (b, 36.0, 60.0, 0.0, 10.0)])
        found[k] = {(r.label_set, r.start, r.end) for r in el.label_spans(el.pages(w)).collect()}
        p = [(re.sub(r"\s+", " ", x.lower().translate(str.maketrans("ıſ", "is"))), y) for x, y in ((a, 0), (b, 1))]
        spans = {(i, j): re.sub(":+$", "", " ".join(t for t, _ in p[i:j]).strip()).strip() for i, j in ((0, 1), (1, 2), (0, 2))}
        want = {(q.label_set, i, j) for (i, j), s in spans.items() for q in labels.PATTERNS if re.fullmatch(q.pattern, s)}
        # per start word and pattern the shortest one only
        assert found[k] <= want and {(n, i) for n, i, _ in found[k]} == {(n, i) for n, i, _ in want}


def test_spellings_are_the_patterns_languages():
    for s, numbers in labels.LABELS.items():
        assert numbers == [k for k, p in enumerate(labels.PATTERNS) if re.fullmatch(p.pattern, s)]
    assert labels.spellings(r"bill(?:ed)?\s*to") == {"bill to", "billto", "billed to", "billedto"}
    with pytest.raises(ValueError):
        labels.spellings(r"no\d+")


def test_a_large_page_costs_in_proportion(spark):
    """Ten times the words on ten times the lines: no rule looks through the whole page per word."""
    def seconds(n):
        w = spark.createDataFrame([(1, 1, i, *x) for i, x in enumerate(random_page(5, n, n // 10))], SCHEMA)
        pg = el.with_matches(el.pages(w)).select("doc_id", "R", "M")
        times = []
        for _ in range(3):
            t = time.time()
            pg.collect()
            times.append(time.time() - t)
        return min(times)

    small, large = seconds(500), seconds(5000)
    assert large < 25 * small, (small, large)


def test_spans_match_labels_once(spark):
    """M is not evaluated anew for each pattern when the optimizer merges its projection into the pickers'."""
    match = F.struct(F.lit(labels.numbers("issuer")[0]).alias("p"), F.col("id").cast("int").alias("start"), F.lit(2).alias("end"),
                     F.lit(True).alias("colon"), F.lit(2).alias("score"))
    pg = spark.range(3).select("id", F.array_repeat(match, F.col("id").cast("int")).alias("M"))
    got = pg.select("id", el.spans(F.col("M"), "issuer").alias("s"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_repeat") == 1 and not re.search(r"array_min\(transform\(filter\((?!lambda)", plan)
    assert {r.id: [tuple(x) for x in r.s] for r in got.collect()} == {k: [(-2, k, 2, labels.numbers("issuer")[0])] * (k > 0) for k in range(3)}


def test_pages_are_scanned_together_as_each_alone(spark):
    """The rules' words come from array
    operations over many pages, not from lambdas that Spark interprets per word."""
    def lists(pages):
        cols = ["text", "x0", "x1", "top", "bottom"]
        W = pa.array([[{**dict(zip(cols, x)), "idx": i} for i, x in enumerate(p)] for p in pages],
                     pa.list_(pa.struct([("text", pa.string()), *((c, pa.float64()) for c in cols[1:]), ("idx", pa.int64())])))
        words = pw.Words(W, np.array([sum(x[4] - x[3] for x in p) / max(len(p), 1) for p in pages]))
        found = words.matches()
        return {(k, s): pw.column_of(words, found, k, s).to_pylist() for k, s in rules}

    rules = [(k, s) for k in ("value", "inline", "block") for s in labels.LABEL_SETS]
    rules += [(k, None) for k in ("matches", "total", "undated", "header", "marked", "beside", "below")]
    pages = [random_page(s, 40 + s, 8) for s in range(9)] + [[("x", 0.0, 6.0, 0.0, 10.0)]]
    alone = [lists([p]) for p in pages]
    assert lists(pages) == {r: [a[r][0] for a in alone] for r in rules}
    assert all(any(a[k, s][0] for a in alone) for k, s in rules if k not in ("marked",))

    w = spark.createDataFrame([(1, 1, i, *x) for i, x in enumerate(pages[0])], SCHEMA)
    plan = el.extract_from_words(w)._jdf.queryExecution().optimizedPlan().toString()
    # the visual rows, a fold over a page's words, are not built for it
    assert "MapInArrow" in plan and "array_append" not in plan


def test_words_dealt_by_document_are_not_dealt_again(spark):
    """The words are most of what a layout query holds: they are moved only if they must be."""
    words = spark.range(0, 400).selectExpr(
        "id % 20 AS doc_id", "cast(id % 3 AS int) AS page", "id AS idx", "concat('w', id) AS text", "double(id) AS x0", "double(id + 5) AS x1",
        "0D AS top", "10D AS bottom")
    moves = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    dealt = words.repartition(7, "doc_id").select((F.col("doc_id") + 0).alias("other"), "*")
    assert moves(el.pages(words)) == 1 and moves(el.pages(dealt)) == 1
    listed = lambda df: sorted((r.doc_id, r.page, [w.idx for w in r.W]) for r in el.pages(df).collect())
    assert listed(words) == listed(dealt) and len(listed(words)) == 60
