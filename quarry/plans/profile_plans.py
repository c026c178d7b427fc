"""Registered profiling, cleaning, dedup and scalar-text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..operators import corpus as cp
from ..operators import dedup as dd
from ..operators import profile as pf
from ..sources.invoices import invoices, invoices_sql_cte
from ..sources.tables import table
from . import sql as S
from .sql import WS, q, re2_unicode

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


NW = S.n_words("text")
STRIP = S.strip("text")
ROUND = 4


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


# -- counts and shares --------------------------------------------------------------


@register("value_counts", "SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def q_value_counts(spark, sf_dir):
    return pf.value_counts(docs(spark, sf_dir), "lang")


@register("class_share", """
SELECT lang, round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 2) AS pct
FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def q_class_share(spark, sf_dir):
    return pf.class_share(docs(spark, sf_dir), "lang")


def _describe_sql(expr: str, name: str, src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    x = _dbl(expr)
    return (f"SELECT {g}'{name}' AS \"column\", count({x}) AS count, round(avg({x}), {ROUND}) AS mean, "
            f"round(stddev_samp({x}), {ROUND}) AS std, min({x}) AS min, "
            f"round(quantile_cont({x}, 0.25), {ROUND}) AS p25, round(quantile_cont({x}, 0.5), {ROUND}) AS p50, "
            f"round(quantile_cont({x}, 0.75), {ROUND}) AS p75, max({x}) AS max FROM {src}{gb}")


def _measures(df: DataFrame) -> DataFrame:
    return df.select("lang", F.char_length("text").alias("num_chars"), tx.n_words("text").alias("num_words"))


@register("describe", _describe_sql("length(text)", "num_chars", "documents") + " UNION ALL "
          + _describe_sql(NW, "num_words", "documents"))
def q_describe(spark, sf_dir):
    return pf.describe(_measures(docs(spark, sf_dir)), ["num_chars", "num_words"])


@register("describe_by_group", _describe_sql(NW, "num_words", "documents", "lang"))
def q_describe_by_group(spark, sf_dir):
    return pf.describe(_measures(docs(spark, sf_dir)), ["num_words"], group="lang")


_NULL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@register("null_profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS n_null, "
    f"round(CAST(count_if({c} IS NULL) AS DOUBLE) * 100.0 / count(*), 2) AS pct "
    f"FROM (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
    for c in _NULL_COLS) + ") ORDER BY n_null DESC, \"column\" LIMIT 20")
def q_null_profile(spark, sf_dir):
    d = docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left").select(*_NULL_COLS)
    return pf.null_profile(d, 20)


@register("text_quality_counts", f"""
SELECT count(*) AS total, count_if(s = '') AS empty,
       round(avg(CAST(s = '' AS DOUBLE)) * 100, 2) AS empty_pct,
       count_if({S.n_words('s')} < 20) AS under_20_words
FROM (SELECT {S.strip("coalesce(text, '')")} AS s FROM documents)""")
def q_text_quality_counts(spark, sf_dir):
    return pf.text_quality_counts(docs(spark, sf_dir), "text", 20)


@register("duplicate_rate", """
SELECT count(*) - count(DISTINCT text) AS duplicates,
       round(CAST(count(*) - count(DISTINCT text) AS DOUBLE) * 100.0 / count(*), 2) AS duplicate_pct
FROM documents""")
def q_duplicate_rate(spark, sf_dir):
    return pf.duplicate_rate(docs(spark, sf_dir), "text")


@register("distinct_texts", "SELECT count(DISTINCT text) AS n_distinct FROM documents")
def q_distinct_texts(spark, sf_dir):
    return docs(spark, sf_dir).agg(F.count_distinct(pf.text_key("text")).alias("n_distinct"))


def _presence_sql(flags, src: str, text: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    parts = []
    for name, pat, ci in flags:
        flag = "(?i)" if ci else ""
        parts.append(f"SELECT {g}{q(name)} AS feature, round(avg(CAST(regexp_matches({text}, "
                     f"{q(flag + re2_unicode(pat))}) AS DOUBLE)) * 100, 2) AS pct FROM {src}{gb}")
    return " UNION ALL ".join(parts)


@register("feature_presence", _presence_sql(fixed.NEWS_FLAGS, "documents", "text"))
def q_feature_presence(spark, sf_dir):
    d = docs(spark, sf_dir)
    return pf.feature_presence(d, pf.flags_from(fixed.NEWS_FLAGS, "text"))


@register("feature_presence_by_label", _presence_sql(fixed.NEWS_FLAGS, "documents", "text", "lang"))
def q_feature_presence_by_label(spark, sf_dir):
    d = docs(spark, sf_dir)
    return pf.feature_presence(d, pf.flags_from(fixed.NEWS_FLAGS, "text"), group="lang")


EMAIL_SQL = f"""(SELECT conv_id * 1000 + turn AS doc_id, role AS subject, text AS message,
   {S.strip(f"{S.strip('coalesce(role, ' + chr(39) + chr(39) + ')')} || ' ' || {S.strip('coalesce(text, ' + chr(39) + chr(39) + ')')}")} AS text
 FROM conversations)"""


@register("structure_flags", _presence_sql(fixed.EMAIL_FLAGS, EMAIL_SQL, "text"))
def q_structure_flags(spark, sf_dir):
    e = cp.email_corpus(spark, sf_dir)
    return pf.feature_presence(e, pf.flags_from(fixed.EMAIL_FLAGS, "text"))


CONTRACT_SQL = f"""(SELECT page_id AS doc_id,
   {S.strip("regexp_replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '[ \t]+', ' ', 'g')")} AS text
 FROM pages)"""


@register("contract_flags", _presence_sql(fixed.CONTRACT_FLAGS, CONTRACT_SQL, "text"))
def q_contract_flags(spark, sf_dir):
    c = cp.contract_corpus(spark, sf_dir)
    return pf.feature_presence(c, pf.flags_from(fixed.CONTRACT_FLAGS, "text"))


def _ratio_sql(expr_count: str) -> str:
    return f"CAST({expr_count} AS DOUBLE) / greatest(length(text), 1)"


RATIOS_SQL = {
    "digit_ratio": _ratio_sql("length(regexp_replace(text, '[^\\p{Nd}]', '', 'g'))"),
    "uppercase_ratio": _ratio_sql("length(regexp_replace(text, '[^\\p{Lu}]', '', 'g'))"),
    "newline_ratio": _ratio_sql("length(text) - length(replace(text, chr(10), ''))"),
    "punct_ratio": _ratio_sql(f"length(regexp_replace(text, '[\\pL\\pN{WS[1:-1]}]', '', 'g'))"),
}


@register("noise_profile", " UNION ALL ".join(
    _describe_sql(v, k, "documents") for k, v in RATIOS_SQL.items()))
def q_noise_profile(spark, sf_dir):
    return pf.noise_profile(docs(spark, sf_dir), "text")


@register("noise_ratios", "SELECT doc_id, " + ", ".join(
    f"round({v}, 6) AS {k}" for k, v in RATIOS_SQL.items()) + " FROM documents")
def q_noise_ratios(spark, sf_dir):
    return docs(spark, sf_dir).select(
        "doc_id", *[F.round(v, 6).alias(k) for k, v in tx.noise_ratios("text").items()])


def _stop_sql() -> str:
    return "(" + ", ".join(q(w) for w in pf.english_stop_words()) + ")"


STOP = _stop_sql()
TOKENS_SQL = "(SELECT lang, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')) AS word FROM documents)"


@register("top_words", f"""
SELECT word, count(*) AS count FROM {TOKENS_SQL}
WHERE word NOT IN {STOP} GROUP BY word ORDER BY count DESC, word LIMIT 20""")
def q_top_words(spark, sf_dir):
    return pf.top_words(docs(spark, sf_dir), "text", 20)


@register("top_words_by_label", f"""
SELECT lang, word, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT lang, word, count(*) AS count,
         row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
  FROM {TOKENS_SQL} WHERE word NOT IN {STOP} GROUP BY lang, word) WHERE rank <= 15""")
def q_top_words_by_label(spark, sf_dir):
    return pf.top_words(docs(spark, sf_dir), "text", 15, group="lang")


@register("corpus_summary", f"""
SELECT count(*) AS n_docs, count(DISTINCT text) AS n_distinct,
       round(avg({_dbl('nw')}), {ROUND}) AS mean_words, round(quantile_cont({_dbl('nw')}, 0.5), {ROUND}) AS median_words,
       max(nw) AS max_words, count_if(nw < 5) AS n_under_5_words, count_if(nw > 500) AS n_over_500_words,
       count(DISTINCT lang) AS n_labels
FROM (SELECT text, lang, {NW} AS nw FROM documents)""")
def q_corpus_summary(spark, sf_dir):
    d = docs(spark, sf_dir).select("text", "lang", tx.n_words("text").alias("nw"))
    x = F.col("nw").cast("double")
    return d.agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_distinct(pf.text_key("text")).alias("n_distinct"),
        F.round(F.avg(x), ROUND).alias("mean_words"), F.round(F.percentile(x, 0.5), ROUND).alias("median_words"),
        F.max("nw").alias("max_words"), F.count_if(F.col("nw") < 5).alias("n_under_5_words"),
        F.count_if(F.col("nw") > 500).alias("n_over_500_words"),
        F.count_distinct("lang").alias("n_labels"))


@register("repeated_names", """
SELECT count(*) AS n_repeated FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)""")
def q_repeated_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.groupBy("p_name").count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n_repeated"))


def _hist_sql(expr: str, bins: int, src: str) -> str:
    return f"""
WITH x AS (SELECT {_dbl(expr)} AS x FROM {src}), b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
h AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin,
             lo, hi FROM x, b WHERE x IS NOT NULL)
SELECT bin, count(*) AS count, round(lo + bin * ((hi - lo) / {bins}), {ROUND}) AS left_edge FROM h GROUP BY bin, lo, hi"""


@register("length_histogram", _hist_sql(NW, 50, "documents"))
def q_length_histogram(spark, sf_dir):
    return pf.length_histogram(_measures(docs(spark, sf_dir)), "num_words", 50)


@register("length_histogram_by_label", f"""
WITH x AS (SELECT lang, {_dbl(NW)} AS x FROM documents), b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
h AS (SELECT lang, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin, lo, hi
      FROM x, b WHERE x IS NOT NULL)
SELECT lang, bin, count(*) AS count, round(lo + bin * ((hi - lo) / 50), {ROUND}) AS left_edge FROM h GROUP BY lang, bin, lo, hi""")
def q_length_histogram_by_label(spark, sf_dir):
    return pf.length_histogram(_measures(docs(spark, sf_dir)), "num_words", 50, group="lang")


@register("dataset_checks", f"""
SELECT 'news' AS dataset, count(*) AS n_rows, 3 AS n_columns, count_if({S.strip("coalesce(text, '')")} = '') AS n_blank,
       count(*) - count(DISTINCT text) AS n_duplicates, count(DISTINCT lang) AS n_labels FROM documents
UNION ALL
SELECT 'email', count(*), 3, count_if({S.strip("coalesce(text, '')")} = ''), count(*) - count(DISTINCT text),
       count(DISTINCT subject) FROM {EMAIL_SQL}
UNION ALL
SELECT 'contract', count(*), 3, count_if({S.strip("coalesce(text, '')")} = ''), count(*) - count(DISTINCT text), 1
FROM {CONTRACT_SQL}""")
def q_dataset_checks(spark, sf_dir):
    return cp.dataset_checks({
        "news": docs(spark, sf_dir).select("doc_id", "text", F.col("lang").alias("label")),
        "email": cp.email_corpus(spark, sf_dir).select("doc_id", "text", F.col("subject").alias("label")),
        "contract": cp.contract_corpus(spark, sf_dir).select("doc_id", "text", F.lit("contract").alias("label")),
    })


@register("schema_profile", """
SELECT c.column_name AS "column",
       CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                        WHEN 'DOUBLE' THEN 'double' ELSE lower(c.data_type) END AS type,
       n.non_null, n.n_rows
FROM information_schema.columns c JOIN (
  SELECT 'doc_id' AS col, count(doc_id) AS non_null, count(*) AS n_rows FROM documents
  UNION ALL SELECT 'text', count(text), count(*) FROM documents
  UNION ALL SELECT 'lang', count(lang), count(*) FROM documents
  UNION ALL SELECT 'source', count(source), count(*) FROM documents
  UNION ALL SELECT 'n_chars', count(n_chars), count(*) FROM documents
) n ON c.column_name = n.col
WHERE c.table_name = 'documents'""")
def q_schema_profile(spark, sf_dir):
    return pf.schema_profile(docs(spark, sf_dir))


@register("distinct_values", "SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL")
def q_distinct_values(spark, sf_dir):
    return docs(spark, sf_dir).select("lang").distinct().where(F.col("lang").isNotNull())


# -- projections, filters, cleaning ---------------------------------------------------


@register("project_rename", "SELECT doc_id, text, lang AS label FROM documents")
def q_project_rename(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", "text", "lang").withColumnRenamed("lang", "label")


@register("drop_if_present", "SELECT doc_id, text, lang, n_chars FROM documents")
def q_drop_if_present(spark, sf_dir):
    return docs(spark, sf_dir).drop("source", "Unnamed: 0")


@register("null_to_empty", """
SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality, coalesce(CAST(l.toxic AS VARCHAR), '') AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_null_to_empty(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", tx.null_to_empty("quality").alias("quality"), tx.null_to_empty("toxic").alias("toxic"))


@register("concat_fields", f"SELECT doc_id, subject, message, text FROM {EMAIL_SQL}")
def q_concat_fields(spark, sf_dir):
    return cp.email_corpus(spark, sf_dir).select("doc_id", "subject", "message", "text")


@register("constant_label", "SELECT doc_id, text, 'news' AS doc_type FROM documents")
def q_constant_label(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", "text", F.lit("news").alias("doc_type"))


@register("sequence_id", """
SELECT doc_id, printf('inv_%04d', row_number() OVER (ORDER BY doc_id) - 1) AS seq_id FROM documents""")
def q_sequence_id(spark, sf_dir):
    d = dd.sequence_id(docs(spark, sf_dir).select("doc_id"), "doc_id", "seq")
    return d.select("doc_id", F.format_string("inv_%04d", F.col("seq")).alias("seq_id"))


@register("filter_nonempty", f"SELECT doc_id FROM documents WHERE {S.strip(chr(99) + 'oalesce(text, ' + chr(39) + chr(39) + ')')} <> ''")
def q_filter_nonempty(spark, sf_dir):
    return docs(spark, sf_dir).where(tx.py_strip(tx.null_to_empty("text")) != "").select("doc_id")


@register("filter_min_words", f"SELECT doc_id FROM documents WHERE {NW} >= 5")
def q_filter_min_words(spark, sf_dir):
    return docs(spark, sf_dir).where(tx.n_words("text") >= fixed.MIN_WORDS).select("doc_id")


MERGED_SQL = f"""(
  SELECT 'news' AS doc_type, doc_id, text, CAST(NULL AS BOOLEAN) AS is_synthetic FROM documents
  UNION ALL SELECT 'email', doc_id, text, NULL FROM {EMAIL_SQL}
  UNION ALL SELECT 'contract', doc_id, text, NULL FROM {CONTRACT_SQL}
  UNION ALL SELECT 'invoice', doc_id, text, true FROM inv)"""
WITH_INV = "WITH " + invoices_sql_cte("inv") + " "


@register("filter_max_words", WITH_INV + f"""
SELECT doc_type, doc_id FROM {MERGED_SQL}
WHERE {NW} <= CASE doc_type WHEN 'email' THEN 5000 WHEN 'contract' THEN 30000 ELSE {NW} END""")
def q_filter_max_words(spark, sf_dir):
    return cp.filter_max_words(cp.merged_corpus(spark, sf_dir, with_invoices=True)).select("doc_type", "doc_id")


@register("union_missing_columns", WITH_INV + f"""
SELECT doc_type, doc_id, text, is_synthetic FROM {MERGED_SQL}""")
def q_union_missing_columns(spark, sf_dir):
    return cp.merged_corpus(spark, sf_dir, with_invoices=True).select("doc_type", "doc_id", "text", "is_synthetic")


@register("split_real_synthetic", WITH_INV + f"""
SELECT CASE WHEN coalesce(is_synthetic, false) THEN 'synthetic' ELSE 'real' END AS split, doc_type,
       count(*) AS n FROM {MERGED_SQL} GROUP BY 1, 2""")
def q_split_real_synthetic(spark, sf_dir):
    m = cp.merged_corpus(spark, sf_dir, with_invoices=True)
    split = F.when(F.coalesce(F.col("is_synthetic"), F.lit(False)), "synthetic").otherwise("real")
    return m.groupBy(split.alias("split"), "doc_type").agg(F.count(F.lit(1)).alias("n"))


@register("input_quarantine", f"""
SELECT doc_id, CASE WHEN text IS NULL THEN 'unreadable'
                    WHEN {STRIP} = '' THEN 'empty'
                    WHEN length({STRIP}) < 40 THEN 'needs_ocr' END AS reason
FROM documents""")
def q_input_quarantine(spark, sf_dir):
    return cp.quarantine(docs(spark, sf_dir)).select("doc_id", "reason")


@register("skip_missing_files", """
SELECT l.doc_id, l.quality, l.toxic FROM labels l WHERE l.doc_id IN (SELECT doc_id FROM documents)""")
def q_skip_missing_files(spark, sf_dir):
    return table(spark, sf_dir, "labels").join(docs(spark, sf_dir).select("doc_id"), "doc_id", "left_semi")


@register("optional_column", "SELECT doc_id, lang AS label FROM documents")
def q_optional_column(spark, sf_dir):
    d = docs(spark, sf_dir)
    label = "Spam/Ham" if "Spam/Ham" in d.columns else "lang"
    return d.select("doc_id", F.col(f"`{label}`").alias("label"))


@register("enough_text", f"SELECT doc_id, length({STRIP}) >= 40 AS enough_text FROM documents")
def q_enough_text(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.enough_text("text").alias("enough_text"))


# -- joins and name sets ----------------------------------------------------------------

# The words of all news texts and the words of all email texts.
NAMES_L = f"(SELECT DISTINCT word AS p_name FROM {TOKENS_SQL})"
NAMES_R = "(SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')) AS p_name FROM conversations)"


def _names(spark, sf_dir):
    words = lambda df: df.select(F.explode(pf.tokens("text")).alias("p_name")).distinct()
    return words(docs(spark, sf_dir)), words(table(spark, sf_dir, "conversations"))


@register("names_in_both", f"SELECT p_name FROM {NAMES_L} WHERE p_name IN {NAMES_R}")
def q_names_in_both(spark, sf_dir):
    left, right = _names(spark, sf_dir)
    return left.join(right, "p_name", "left_semi")


@register("names_only_left", f"""
SELECT p_name FROM {NAMES_L} WHERE p_name NOT IN {NAMES_R} ORDER BY p_name LIMIT 20""")
def q_names_only_left(spark, sf_dir):
    left, right = _names(spark, sf_dir)
    return left.join(right, "p_name", "left_anti").orderBy("p_name").limit(20)


@register("names_only_right", f"SELECT p_name FROM {NAMES_R} WHERE p_name NOT IN {NAMES_L}")
def q_names_only_right(spark, sf_dir):
    left, right = _names(spark, sf_dir)
    return right.join(left, "p_name", "left_anti")


@register("join_row_to_file", """
SELECT l.doc_id, l.quality, d.lang, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def q_join_row_to_file(spark, sf_dir):
    return (table(spark, sf_dir, "labels").select("doc_id", "quality")
            .join(docs(spark, sf_dir).select("doc_id", "lang", "n_chars"), "doc_id", "inner"))


@register("attach_columns", f"""
SELECT doc_id, {NW} AS num_words, length(text) AS num_chars, lang FROM documents""")
def q_attach_columns(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.n_words("text").alias("num_words"),
                                      F.char_length("text").alias("num_chars"), "lang")


@register("guess_type", "SELECT p_partkey, CASE " + " ".join(
    f"WHEN contains(lower(p_name || ' ' || p_type), {q(k)}) THEN {q(k)}" for k in fixed.CONTRACT_TYPES)
    + " ELSE 'other' END AS guessed_type FROM part")
def q_guess_type(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", tx.guess_type(F.concat_ws(" ", "p_name", "p_type")).alias("guessed_type"))


@register("strip_name_suffix", f"""
SELECT p_partkey, {S.strip("replace(replace(p_name || CASE WHEN p_size % 2 = 0 THEN '.pdf' ELSE '.txt' END, '.pdf', ''), '.txt', '')")} AS name
FROM part""")
def q_strip_name_suffix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    fname = F.concat(F.col("p_name"), F.when(F.col("p_size") % 2 == 0, ".pdf").otherwise(".txt"))
    return p.select("p_partkey", tx.strip_name_suffix(fname).alias("name"))


# -- dedup, order, sample ---------------------------------------------------------------------


@register("dedup_keep_first", "SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY text")
def q_dedup_keep_first(spark, sf_dir):
    return dd.dedup_keep_first(docs(spark, sf_dir), "text", "doc_id", keep=["doc_id"]).select("doc_id", "n_copies")


@register("show_all_duplicates", """
SELECT doc_id, n_copies FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS n_copies FROM documents)
WHERE n_copies > 1""")
def q_show_all_duplicates(spark, sf_dir):
    return dd.show_all_duplicates(docs(spark, sf_dir), "text").select("doc_id", "n_copies")


@register("top_n_longest", f"""
SELECT doc_id, {NW} AS num_words FROM documents ORDER BY num_words DESC, doc_id LIMIT 10""")
def q_top_n_longest(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", tx.n_words("text").alias("num_words"))
    return d.orderBy(F.desc("num_words"), "doc_id").limit(10)


@register("top_n_shortest", f"""
SELECT doc_id, {NW} AS num_words FROM documents ORDER BY num_words, doc_id LIMIT 10""")
def q_top_n_shortest(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", tx.n_words("text").alias("num_words"))
    return d.orderBy("num_words", "doc_id").limit(10)


@register("seeded_sample", f"""
SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{fixed.SEED}'), doc_id LIMIT 20""")
def q_seeded_sample(spark, sf_dir):
    return dd.seeded_sample(docs(spark, sf_dir), "doc_id", 20, fixed.SEED).select("doc_id", "lang")


# -- per-document text transforms ---------------------------------------------------------------


@register("collapse_whitespace", f"""
SELECT doc_id, {S.strip(f"regexp_replace(text, '{WS}+', ' ', 'g')")} AS text FROM documents""")
def q_collapse_whitespace(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.collapse_whitespace("text").alias("text"))


@register("collapse_horizontal", """
SELECT doc_id, regexp_replace(text, '[ \t]+', ' ', 'g') AS text FROM conversations_v""".replace(
    "conversations_v", "(SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations)"))
def q_collapse_horizontal(spark, sf_dir):
    c = cp.email_corpus(spark, sf_dir).select("doc_id", F.col("message").alias("text"))
    return c.select("doc_id", tx.collapse_horizontal("text").alias("text"))


@register("html_space_clean", """
SELECT page_id, replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' ') AS text FROM pages""")
def q_html_space_clean(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", tx.html_space_clean(F.regexp_replace("html", "<[^>]*>", " ")).alias("text"))


@register("text_measures", f"""
SELECT doc_id, length(text) AS num_chars, {NW} AS num_words,
       CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INTEGER) AS num_lines FROM documents""")
def q_text_measures(spark, sf_dir):
    return docs(spark, sf_dir).select(
        "doc_id", F.char_length("text").alias("num_chars"), tx.n_words("text").alias("num_words"),
        tx.n_lines("text").alias("num_lines"))


@register("truncate_words", f"""
SELECT doc_id, array_to_string(list_slice({S.words('text')}, 1, 500), ' ') AS text FROM documents""")
def q_truncate_words(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.truncate_words("text").alias("text"))


_SIGNALS_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN regexp_matches(raw, {q('(?i)' + pat)}) THEN {q(tok)} END" for tok, pat in fixed.INVOICE_SIGNALS
) + "], lambda x: x IS NOT NULL)"

CLEAN_SQL = f"""(SELECT doc_id, lang, array_to_string({_SIGNALS_SQL}, ' ') AS sig,
  array_to_string(list_slice({S.words(f"lower(regexp_replace(text, '(?m)^{WS}*\\p{{Nd}}+{WS}*$', ' ', 'g'))")}, 1, 500), ' ') AS body
  FROM (SELECT doc_id, lang, replace(text, '-' || chr(10), '') AS text, text AS raw FROM documents))"""


@register("clean_for_classifier", f"""
SELECT doc_id, CASE WHEN sig = '' THEN body ELSE sig || ' ' || body END AS text FROM {CLEAN_SQL}""")
def q_clean_for_classifier(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.clean_for_classifier("text").alias("text"))


@register("process_documents", f"""
SELECT c.doc_id, d.text AS raw_text, CASE WHEN sig = '' THEN body ELSE sig || ' ' || body END AS classifier_text
FROM {CLEAN_SQL} c JOIN documents d ON c.doc_id = d.doc_id""")
def q_process_documents(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", F.col("text").alias("raw_text"), tx.clean_for_classifier("text").alias("classifier_text"))


@register("strip_signal_tokens", f"""
SELECT doc_id, {S.strip(f"regexp_replace(regexp_replace(CASE WHEN sig = '' THEN body ELSE sig || ' ' || body END, '__[a-z_]+__', ' ', 'g'), '{WS}+', ' ', 'g')")} AS text
FROM {CLEAN_SQL}""")
def q_strip_signal_tokens(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", tx.clean_for_classifier("text").alias("t"))
    return d.select("doc_id", tx.strip_signal_tokens("t").alias("text"))


@register("softmax", """
SELECT vec_id, list_transform(e, lambda x: round(x / list_sum(e), 6)) AS probs
FROM (SELECT vec_id, list_transform(v, lambda x: exp(x - list_max(v))) AS e
      FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings))""")
def q_softmax(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double"))
    return e.select("vec_id", F.transform(tx.softmax(v), lambda x: F.round(x, 6)).alias("probs"))



_INVOICE_FLAGS = [(name, pattern, True) for name, pattern in fixed.INVOICE_TERMS]


# the oracle's engine does not take an escape before a letter it does not know
@register("invoice_terms", WITH_INV + _presence_sql(
    [(n, p.replace("\\€", "€").replace("\\£", "£"), ci) for n, p, ci in _INVOICE_FLAGS], "inv", "text"))
def q_invoice_terms(spark, sf_dir):
    """Percent of invoices that hold each term."""
    return pf.feature_presence(invoices(spark, sf_dir), pf.flags_from(_INVOICE_FLAGS, "text"))


# Integer widths as Spark returns them.
for _name, _types in {
    'null_profile': {'n_null': 'BIGINT'},
    'text_quality_counts': {'empty': 'BIGINT', 'under_20_words': 'BIGINT'},
    'corpus_summary': {'n_under_5_words': 'BIGINT', 'n_over_500_words': 'BIGINT'},
    'dataset_checks': {'n_blank': 'BIGINT'},
    'attach_columns': {'num_chars': 'INTEGER'},
    'text_measures': {'num_chars': 'INTEGER'},
}.items():
    ORACLES[_name] = S.typed(ORACLES[_name], **_types)
