"""SQL fragments for the DuckDB oracles (RE2 regex, ``'g'`` for global).

The oracles recompute each registered query from the base tables with
plain SQL so the driver can compare results value by value.
"""

from __future__ import annotations

# Whitespace as Python's str.isspace() sees it (RE2 and Java accept it).
WS = r"[\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def n_words(x: str) -> str:
    return f"CAST(len({words(x)}) AS INTEGER)"


def count_re(x: str, pat: str) -> str:
    """Number of non-overlapping matches of pat in x."""
    return f"CAST(len(regexp_extract_all({x}, '{pat}')) AS INTEGER)"


# What the text rules return per layout (hand-derived from the rules). Layout
# 1: the total's amount stands on the next line. Layout 2: none of its labels
# but the total's is known to the text rules, so its heading is taken for the
# issuer. Layout 3: the number has no label and letters, the date's label is
# unknown. Layout 4: the bare "date" label precedes the due date, the greeting
# is the first clean line.
TEXT_EXPECTED_CTE = """
expected AS (
  SELECT doc_id, layout,
         CASE WHEN layout IN (0, 1, 2, 4) THEN t_invoice_number END AS invoice_number,
         CASE WHEN layout IN (0, 1) THEN t_invoice_date WHEN layout = 4 THEN t_due_date END AS invoice_date,
         CASE WHEN layout <> 2 THEN t_due_date END AS due_date,
         CASE layout WHEN 2 THEN 'Reply to your order' WHEN 4 THEN 'Memo for ' || t_recipient ELSE t_issuer END AS issuer,
         CASE WHEN layout IN (0, 1, 3) THEN t_recipient END AS recipient,
         CASE WHEN layout <> 1 THEN t_total END AS total
  FROM inv
)"""

FIELDS = ["invoice_number", "invoice_date", "due_date", "issuer", "recipient", "total"]


def long_form(pred: str, gold: str, gold_prefix: str = "t_") -> str:
    parts = [
        f"SELECT p.doc_id, '{f}' AS field, p.{f} AS pred, g.{gold_prefix}{f} AS gold "
        f"FROM {pred} p JOIN {gold} g ON p.doc_id = g.doc_id"
        for f in FIELDS
    ]
    return "\nUNION ALL\n".join(parts)


def norm_str(x: str) -> str:
    return f"coalesce(lower({strip(f'regexp_replace({x}, {chr(39)}{WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}), '')"


def norm_amount(x: str) -> str:
    t = f"regexp_replace({x}, '[^0-9.,]', '', 'g')"
    t2 = (f"CASE WHEN regexp_full_match({t}, '[0-9]+,[0-9]{{2}}') THEN replace({t}, ',', '.') "
          f"ELSE replace({t}, ',', '') END")
    return (f"coalesce(CASE WHEN TRY_CAST({t2} AS DOUBLE) IS NOT NULL "
            f"THEN format('{{:.2f}}', TRY_CAST({t2} AS DOUBLE)) ELSE {t2} END, '')")


def field_match(p: str, g: str, field: str) -> str:
    pn, gn = norm_str(p), norm_str(g)
    return f"""CASE WHEN coalesce({g}, '') = '' THEN coalesce({p}, '') = ''
     WHEN coalesce({p}, '') = '' THEN false
     WHEN {field} IN ('invoice_date', 'due_date')
       THEN regexp_replace({p}, '[^0-9]', '', 'g') = regexp_replace({g}, '[^0-9]', '', 'g')
     WHEN {field} = 'total' THEN {norm_amount(p)} = {norm_amount(g)}
     WHEN {field} = 'invoice_number'
       THEN regexp_replace({pn}, '^#+', '') = regexp_replace({gn}, '^#+', '')
     ELSE contains({pn}, {gn}) OR contains({gn}, {pn}) END"""


_WORD = r"[\pL\pN_]"
_NONWORD = r"[^\pL\pN_]"


def re2_unicode(p: str) -> str:
    """Rewrite a Python-style pattern for a *presence test* in RE2 with
    Python's Unicode classes: \\d, \\w, \\s become Unicode classes and \\b
    becomes an explicit word/non-word edge (it may consume one character,
    which a boolean test does not see)."""
    out, i, n = [], 0, len(p)
    in_class = False
    while i < n:
        ch = p[i]
        if ch == "\\" and i + 1 < n:
            nxt = p[i + 1]
            if nxt == "d":
                out.append(r"\p{Nd}" if in_class else r"\p{Nd}")
            elif nxt == "w":
                out.append(r"\pL\pN_" if in_class else _WORD)
            elif nxt == "s":
                out.append(WS[1:-1] if in_class else WS)
            elif nxt == "b" and not in_class:
                prev = "".join(out)
                start = (not prev) or prev.endswith("|") or prev.endswith("(") or prev.endswith("(?:")
                cls = prev[prev.rfind("["):] if prev.endswith("]") else ""
                nonword_cls = cls and not any(c.isalnum() or c == "_" for c in cls[1:-1].replace("\\", ""))
                if start:
                    out.append(f"(?:^|{_NONWORD})")
                elif nonword_cls:
                    out.append(_WORD)
                else:
                    out.append(f"(?:{_NONWORD}|$)")
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def typed(sql: str, **types: str) -> str:
    """The query with some columns cast, so both engines return one type
    (sums and conditional counts are wider integers in the oracle's engine)."""
    casts = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in types.items())
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"
