"""Column functions for text: strip, words, lines, measures, cleaning.

All of these are built-in Spark expressions (JVM side, no Python per row).
Java regexes are ASCII by default; ``(?U)`` gives the Unicode classes that
Python's ``str`` methods and ``re`` use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

U = "(?U)"
UI = "(?iU)"

# Line breaks as str.splitlines() sees them.
LINE_BREAKS = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"
# Whitespace as str.isspace() sees it; valid in Java and RE2 alike.
WS = r"[\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(expr: Column, fn) -> Column:
    """Bind ``expr`` once and use it in ``fn`` (keeps expression trees
    linear instead of copying a sub-expression at every use)."""
    return F.get(F.transform(F.array(expr), fn), 0)


def py_strip(c) -> Column:
    """str.strip(): drop leading/trailing Unicode whitespace."""
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def strip_chars(c, chars: str) -> Column:
    """str.strip(chars) for a literal character set."""
    cls = "".join("\\" + ch if ch in r"\^-]" else ch for ch in chars)
    return F.regexp_replace(col(c), f"^[{cls}]+|[{cls}]+$", "")


def rstrip_chars(c, chars: str) -> Column:
    cls = "".join("\\" + ch if ch in r"\^-]" else ch for ch in chars)
    return F.regexp_replace(col(c), f"[{cls}]+$", "")


def words(c) -> Column:
    """str.split(): whitespace tokens, no empty strings."""
    return F.filter(F.split(col(c), WS + "+"), lambda w: w != "")


def n_words(c) -> Column:
    return F.size(words(c))


def lines(c) -> Column:
    """str.splitlines(): split on all line breaks, drop one trailing empty."""
    arr = F.split(col(c), LINE_BREAKS)
    return F.when(
        (F.size(arr) > 0) & (F.element_at(arr, -1) == ""),
        F.slice(arr, 1, F.size(arr) - 1),
    ).otherwise(arr)


def n_lines(c) -> Column:
    """Newlines + 1, as the profile counts lines."""
    return (F.regexp_count(col(c), F.lit("\n")) + 1).cast("int")


def collapse_whitespace(c) -> Column:
    """re.sub(r'\\s+', ' ', s).strip()"""
    return py_strip(F.regexp_replace(col(c), WS + "+", " "))


def collapse_horizontal(c) -> Column:
    """Spaces and tabs collapse to one space, line breaks stay."""
    return F.regexp_replace(col(c), "[ \t]+", " ")


def html_space_clean(c) -> Column:
    return F.replace(col(c), F.lit("&nbsp;"), F.lit(" "))


def null_to_empty(c) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def concat_fields(a, b) -> Column:
    """(a.strip() + ' ' + b.strip()).strip()"""
    return py_strip(F.concat(py_strip(null_to_empty(a)), F.lit(" "), py_strip(null_to_empty(b))))


def truncate_words(c, n: int = fixed.MAX_WORDS) -> Column:
    return F.array_join(F.slice(words(c), 1, n), " ")


def noise_ratios(c) -> dict[str, Column]:
    s = col(c)
    denom = F.greatest(F.char_length(s), F.lit(1)).cast("double")
    return {
        "digit_ratio": F.regexp_count(s, F.lit(r"\p{Nd}")) / denom,
        "uppercase_ratio": F.regexp_count(s, F.lit(r"\p{Lu}")) / denom,
        "newline_ratio": F.regexp_count(s, F.lit("\n")) / denom,
        "punct_ratio": F.regexp_count(s, F.lit(r"[^\p{L}\p{N}\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85]")) / denom,
    }


def invoice_signals(c) -> Column:
    """Signal tokens that fire on the raw text, in fixed order."""
    s = col(c)
    return F.array_compact(F.array(*[
        F.when(s.rlike(UI + pat), F.lit(tok)) for tok, pat in fixed.INVOICE_SIGNALS
    ]))


def signal_count(c) -> Column:
    return F.size(invoice_signals(c))


def strip_signal_tokens(c) -> Column:
    return collapse_whitespace(F.regexp_replace(col(c), fixed.SIGNAL_TOKEN, " "))


def clean_for_classifier(c) -> Column:
    """Flags on the raw text; drop '-\\n'; blank digit-only lines; lower;
    collapse whitespace; first 500 words; prepend fired signal tokens."""
    raw = col(c).cast("string")
    t = F.replace(raw, F.lit(fixed.HYPHEN_BREAK), F.lit(""))
    t = F.regexp_replace(t, r"(?mU)^\s*\d+\s*$", " ")
    t = F.lower(t)
    # a signal's pattern is looked for once: its token stands in front, with a blank
    fired = [F.when(raw.rlike(UI + pat), F.lit(tok + " ")).otherwise(F.lit("")) for tok, pat in fixed.INVOICE_SIGNALS]
    return F.concat(*fired, truncate_words(t))


def enough_text(c, min_chars: int = fixed.OCR_MIN_TEXT_CHARS) -> Column:
    return F.char_length(py_strip(col(c))) >= min_chars


def guess_type(c, keywords=None) -> Column:
    keywords = keywords or fixed.CONTRACT_TYPES
    name = F.lower(col(c).cast("string"))
    expr = F.lit("other")
    for kw in reversed(keywords):
        expr = F.when(F.contains(name, F.lit(kw)), F.lit(kw)).otherwise(expr)
    return expr


def strip_name_suffix(c) -> Column:
    return py_strip(F.replace(F.replace(col(c), F.lit(".pdf"), F.lit("")), F.lit(".txt"), F.lit("")))


def softmax(c) -> Column:
    """Max-shifted softmax over an array<double> of margins."""
    arr = col(c)
    m = F.array_max(arr)
    ex = F.transform(arr, lambda x: F.exp(x - m))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda x: x / tot)
