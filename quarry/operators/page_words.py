"""The geometry of the layout rules, for many pages at a time.

``scan`` maps batches of pages (``extract_layout.pages``) to what the rules look
at: label matches, and per rule the texts it may take its value from, in the
order in which it tries them. Words beside and below a label are found by ranges
of their tops, so no rule looks through the whole page. Which of the texts holds
a value is decided by the column functions of ``functions.invoice``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType

from ..functions import fixed, labels

WORDS_AT_ONCE = 100_000
MATCH = "struct<p:int,start:int,end:int,colon:boolean,score:int>"
BESIDE = "struct<word_idx:int,label:string,text:string,idx:bigint>"
TYPES = {"matches": f"array<{MATCH}>", "block": "array<array<string>>", "beside": f"array<{BESIDE}>", "below": f"array<{BESIDE}>"}
ARROW_MATCH = pa.struct([("p", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("colon", pa.bool_()), ("score", pa.int32())])
SIMPLE = re.compile(r"[!-~]+(?: [!-~]+)*")
#: Beginnings of labels after which another word may follow.
OPEN = {s[:k] for s in labels.LABELS for k, c in enumerate(s) if c == " "}
FIRST = set(labels.FIRST_WORDS)


def phrase(text: str) -> tuple[str, bool]:
    """A label's spelling as ``labels`` lists it, and whether a ':' ends it."""
    if SIMPLE.fullmatch(text):
        return text.lower().rstrip(":").rstrip(" "), text.endswith(":")
    plain = re.sub(r"\s+", " ", text.strip().lower().replace("ı", "i").replace("ſ", "s"))
    return plain.rstrip(":").strip(), text.strip().endswith(":")


def listed(groups: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    """Values of ascending groups as ``n`` lists."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(groups, np.arange(n + 1)), pa.int32()), values)


class Words:
    """The words of some pages in reading order; a span is its page, first word
    and the word behind its last one, as places among all these words."""

    def __init__(self, W: pa.ListArray, lh: np.ndarray):
        flat, size = W.flatten(), W.value_lengths().to_numpy()
        self.n, self.lh = len(size), lh
        self.first = np.r_[0, np.cumsum(size)]
        self.g = np.repeat(np.arange(self.n), size)
        self.text, self.idx = flat.field("text"), flat.field("idx")
        self.x0, self.x1, self.top, self.bottom = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("x0", "x1", "top", "bottom"))
        self.colon = pc.fill_null(pc.ends_with(self.text, ":"), False).to_numpy(zero_copy_only=False)
        self.known = self.text.is_valid().to_numpy(zero_copy_only=False)
        self.tallest = np.zeros(self.n)
        np.maximum.at(self.tallest, self.g, np.abs(self.bottom - self.top))
        # by page and top, with tops as ranks, so that a range of tops in a page is one search
        self.by_top = np.lexsort((self.x0, self.top, self.g))
        self.tops = np.unique(self.top)
        self.key = (self.g * (len(self.tops) + 1) + np.searchsorted(self.tops, self.top))[self.by_top]

    def between(self, g, low, high) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for the words with low <= top <= high, by (query, top, x0, place)."""
        of = lambda v, side: np.searchsorted(self.key, g * (len(self.tops) + 1) + np.searchsorted(self.tops, v, side))
        lo, hi = of(low, "left"), of(high, "right")
        n = np.maximum(hi - lo, 0)
        q = np.repeat(np.arange(len(g)), n)
        return q, self.by_top[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[q]]

    def overlap(self, a, b) -> np.ndarray:
        """Whether words share at least half of the smaller height."""
        both = np.minimum(self.bottom[a], self.bottom[b]) - np.maximum(self.top[a], self.top[b])
        least = np.minimum(self.bottom[a] - self.top[a], self.bottom[b] - self.top[b])
        ok = (both > 0) & (least > 0)
        return ok & (both / np.where(ok, least, 1.0) >= fixed.MIN_Y_OVERLAP)

    def on_line(self, ref) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for the words on the line of each reference word."""
        g, top = self.g[ref], self.top[ref]
        slack = 1e-6 * (1 + np.abs(top) + self.tallest[g])
        q, w = self.between(g, top - self.tallest[g] - slack, self.bottom[ref])
        keep = self.overlap(ref[q], w)
        return q[keep], w[keep]

    def by_x(self, groups, w) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((w, self.top[w], self.x0[w], groups))
        return groups[order], w[order]

    def joined(self, groups, w, n: int) -> pa.Array:
        """Texts of the words of ascending groups, joined with blanks."""
        keep = self.known[w]
        return pc.binary_join(listed(groups[keep], n, self.text.take(pa.array(w[keep]))), " ")

    def row_numbers(self, q, w, tol) -> np.ndarray:
        """Visual rows of each query's words, by (top, x0): a row ends where a
        top leaves its first one by ``tol`` or more."""
        out, last, row, anchor = [], -1, 0, 0.0
        tol = tol.tolist()
        for s, t in zip(q.tolist(), self.top[w].tolist()):
            if s != last:
                last, row, anchor = s, 0, t
            elif not abs(t - anchor) < tol[s]:
                row, anchor = row + 1, t
            out.append(row)
        return np.array(out, np.int64)

    # -- labels

    def matches(self):
        """(start, end, p, colon, score) of every label match, by start word
        and length; per start word and pattern the shortest span."""
        code = self.text.dictionary_encode()
        begins = [t is not None and phrase(t)[0].split(" ")[0] in FIRST for t in code.dictionary.to_pylist()]
        at = code.indices.fill_null(len(begins)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.array([*begins, False])[at])
        end = self.first[self.g[starts] + 1]
        reach = np.minimum(end - starts, fixed.SPAN_MAX_EXTRA_WORDS + 1)
        same = np.ones(len(starts), bool)
        n_line = np.ones(len(starts), np.int64)
        for k in range(1, fixed.SPAN_MAX_EXTRA_WORDS + 1):
            same &= (k < reach) & self.overlap(starts, np.minimum(starts + k, end - 1))
            n_line += same
        text = self.text.to_pylist()
        known: dict[str, tuple] = {}
        found = []
        for i, n in zip(starts.tolist(), n_line.tolist()):
            done: set[int] = set()
            for k in range(1, n + 1):
                t = text[i] if k == 1 else " ".join([x for x in text[i:i + k] if x is not None])
                if t not in known:
                    s, colon = phrase(t)
                    known[t] = labels.LABELS.get(s, ()), colon, bool(SIMPLE.fullmatch(t)) and t.lower() not in OPEN
                numbers, colon, ends = known[t]
                for p in numbers:
                    if p not in done:
                        done.add(p)
                        found.append((i, i + k, p, colon))
                if ends:
                    break
        start, stop, p, colon = (np.array(c, np.int64) for c in (zip(*found) if found else [()] * 4))
        at_start = np.unique(start)
        q, w = self.on_line(at_start)
        left = (w != at_start[q]) & (self.x1[w] <= self.x0[at_start[q]] - fixed.ROW_START_GAP)
        first = np.bincount(q[left], minlength=len(at_start)) == 0
        return start, stop, p, colon, 2 * colon + first[np.searchsorted(at_start, start)]

    def best(self, found, label_set: str) -> tuple[np.ndarray, ...]:
        """(page, start, end) of the best span of each pattern, by page and pattern."""
        start, stop, p, _, score = found
        mine = labels.numbers(label_set)
        own = np.flatnonzero((p >= mine[0]) & (p <= mine[-1]))
        g = self.g[start]
        own = own[np.lexsort((stop[own], start[own], -score[own], p[own], g[own]))]
        new = np.r_[True, (np.diff(p[own]) != 0) | (np.diff(g[own]) != 0)][:len(own)]
        return g[own[new]], start[own[new]], stop[own[new]]

    def total_spans(self, found) -> tuple[np.ndarray, ...]:
        """Every span of a total label, bottom-most first."""
        start, stop, p, *_ = found
        mine = labels.numbers("total")
        own = np.flatnonzero((p >= mine[0]) & (p <= mine[-1]) & (stop - start <= fixed.TOTAL_SPAN_MAX_EXTRA_WORDS + 1))
        g = self.g[start]
        own = own[np.lexsort((stop[own], start[own], p[own], -self.top[start[own]], g[own]))]
        return g[own], start[own], stop[own]

    def ends_of(self, s, e) -> tuple[np.ndarray, np.ndarray]:
        """Smallest x0 and largest x1 of each span."""
        places = [np.minimum(s + k, e - 1) for k in range(fixed.SPAN_MAX_EXTRA_WORDS + 1)]
        return np.min([self.x0[i] for i in places], 0), np.max([self.x1[i] for i in places], 0)

    # -- words beside and below a span

    def right_of(self, s, e, x_end) -> tuple[np.ndarray, np.ndarray]:
        q, w = self.on_line(s)
        keep = ((w < s[q]) | (w >= e[q])) & (self.x0[w] >= x_end[q] - fixed.RIGHT_SLACK)
        return self.by_x(q[keep], w[keep])

    def until_next_label(self, q, w) -> tuple[np.ndarray, np.ndarray]:
        """Up to the next word that ends with ':', other than the first."""
        begin = np.searchsorted(q, q)
        cut = self.colon[w] & (np.arange(len(q)) > begin)
        before = np.cumsum(cut)
        keep = before - np.where(begin > 0, before[begin - 1], 0) == 0
        return q[keep], w[keep]

    def rows_below(self, s, e, n: int) -> tuple[np.ndarray, ...]:
        """(query, row, word) of the first ``n`` visual rows below each span's first word."""
        lh, bottom = self.lh[self.g[s]], self.bottom[s]
        low, high = bottom - lh * 0.2, bottom + (n + 1) * lh
        q, w = self.between(self.g[s], low, high)
        keep = ((w < s[q]) | (w >= e[q])) & (self.top[w] > low[q]) & (self.top[w] < high[q])
        q, w = q[keep], w[keep]
        row = self.row_numbers(q, w, lh * fixed.ROW_TOL_FACTOR)
        keep = row < n
        return q[keep], row[keep], w[keep]

    # -- texts that a rule tries, per page in its order

    def texts(self, parts, g, per_span: bool = False) -> pa.Array:
        """``parts``: (span, place in the span's order, word), words by x; one
        text per span and place."""
        span, place, w = (np.concatenate([p[k] for p in parts]) for k in range(3))
        group = span * 100 + place
        order = np.argsort(group, kind="stable")
        group, w = group[order], w[order]
        at, group = np.unique(group, return_inverse=True)
        text = self.joined(group, w, len(at))
        if per_span:
            return listed(g, self.n, listed(at // 100, len(g), text))
        return listed(g[at // 100], self.n, text)

    def value(self, g, s, e) -> pa.Array:
        """Right of each label up to the next one; then four rows below, of each
        the words in the label's column, then all."""
        left, right = self.ends_of(s, e)
        q, w = self.until_next_label(*self.right_of(s, e, right))
        parts = [(q, np.zeros(len(q), np.int64), w)]
        q, row, w = self.rows_below(s, e, fixed.VALUE_ROWS_BELOW)
        column = np.maximum(fixed.VALUE_COL_TOL[0], self.lh[g] * fixed.VALUE_COL_TOL[1])
        aligned = np.abs(self.x0[w] - left[q]) <= column[q]
        for keep, place in ((aligned, 1), (np.ones(len(q), bool), 2)):
            group, x = self.by_x((q * 100 + 2 * row + place)[keep], w[keep])
            parts.append((group // 100, group % 100, x))
        return self.texts(parts, g)

    def inline(self, g, s, e) -> pa.Array:
        q, w = self.until_next_label(*self.right_of(s, e, self.ends_of(s, e)[1]))
        return self.texts([(q, np.zeros(len(q), np.int64), w)], g)

    def block(self, g, s, e) -> pa.Array:
        """Per label: of six rows below, the words under it."""
        left = self.ends_of(s, e)[0]
        q, row, w = self.rows_below(s, e, fixed.BLOCK_ROWS_BELOW)
        column = np.maximum(fixed.BLOCK_COL_TOL[0], self.lh[g] * fixed.BLOCK_COL_TOL[1])[q]
        x, low, high = self.x0[w], left[q], left[q] + fixed.BLOCK_X_RIGHT
        keep = ((np.abs(x - low) <= column) | ((x >= low - column) & (x <= high))) & (x <= high)
        group, w = self.by_x((q * 100 + row)[keep], w[keep])
        return self.texts([(group // 100, group % 100, w)], g, per_span=True)

    def total(self, g, s, e) -> pa.Array:
        """Right of each label's first word; then two rows below."""
        q, w = self.right_of(s, e, self.x1[s])
        below, row, x = self.rows_below(s, e, fixed.TOTAL_ROWS_BELOW)
        group, x = self.by_x(below * 100 + row + 1, x)
        return self.texts([(q, np.zeros(len(q), np.int64), w), (group // 100, group % 100, x)], g)

    def rows(self, some) -> tuple[np.ndarray, ...]:
        """(page, row number over all pages, word) of some words' visual rows."""
        w = self.by_top[some[self.by_top]]
        row = self.row_numbers(self.g[w], w, self.lh * fixed.ROW_TOL_FACTOR)
        group, w = self.by_x(self.g[w] * (int(row.max(initial=0)) + 1) + row, w)
        at, group = np.unique(group, return_inverse=True)
        return self.g[w[np.searchsorted(group, np.arange(len(at)))]], group, w

    def header(self) -> pa.Array:
        """The visual rows of the top quarter of each page."""
        low, high = np.full(self.n, np.inf), np.full(self.n, -np.inf)
        np.minimum.at(low, self.g, self.top)
        np.maximum.at(high, self.g, self.bottom)
        g, row, w = self.rows(self.bottom <= (low + (high - low) * fixed.HEADER_FRACTION)[self.g])
        return listed(g, self.n, self.joined(row, w, len(g)))

    def undated(self, due_g, due_s) -> pa.Array:
        """The visual rows whose rounded top is not that of a due-date label."""
        g, row, w = self.rows(np.ones(len(self.g), bool))
        top = np.rint(self.top[w[np.searchsorted(row, np.arange(len(g)))]])
        due = set(zip(due_g.tolist(), np.rint(self.top[due_s]).tolist()))
        keep = np.array([k not in due for k in zip(g.tolist(), top.tolist())], bool)
        return listed(g[keep], self.n, self.joined(row, w, len(g)).filter(pa.array(keep)))

    def marked(self) -> pa.Array:
        """Words with a '#', in reading order."""
        at = np.flatnonzero(pc.fill_null(pc.match_substring(self.text, "#"), False).to_numpy(zero_copy_only=False))
        return listed(self.g[at], self.n, self.text.take(pa.array(at)))

    def labelled(self, below: bool) -> pa.Array:
        """For each word that ends with ':' the words right of it, or the row below it."""
        at = np.flatnonzero(self.colon)
        if below:
            q, _, w = self.rows_below(at, at + 1, 1)
            q, w = self.by_x(q, w)
        else:
            q, w = self.right_of(at, at + 1, self.x1[at])
        text = self.joined(q, w, len(at))
        if below:
            text = pc.if_else(pa.array(np.bincount(q, minlength=len(at)) > 0), text, pa.scalar(None, pa.string()))
        own = pa.array(at)
        place = pa.array(at - self.first[self.g[at]], pa.int32())
        return listed(self.g[at], self.n, pa.StructArray.from_arrays([place, self.text.take(own), text, self.idx.take(own)],
                                                                      ["word_idx", "label", "text", "idx"]))


def column_of(words: Words, found, kind: str, label_set: str | None) -> pa.Array:
    match kind:
        case "matches":
            start, stop, p, colon, score = found
            base = words.first[words.g[start]]
            fields = [p, start - base, stop - base, colon.astype(bool), score]
            return listed(words.g[start], words.n, pa.StructArray.from_arrays(
                [pa.array(v, f.type) for v, f in zip(fields, ARROW_MATCH)], fields=list(ARROW_MATCH)))
        case "value" | "inline" | "block":
            return getattr(words, kind)(*words.best(found, label_set))
        case "total":
            return words.total(*words.total_spans(found))
        case "undated":
            return words.undated(*words.best(found, "due")[:2])
        case "header" | "marked":
            return getattr(words, kind)()
        case "beside" | "below":
            return words.labelled(kind == "below")
    raise ValueError(kind)


def scan(pg: DataFrame, keep=(), **rules: tuple[str, str | None]) -> DataFrame:
    """(doc_id, page, the columns to keep, one column per rule): a rule is a kind
    and the label set it works on."""
    src = pg.select(*dict.fromkeys(("doc_id", "page", *keep, "W", "lh")))
    carried = [c for c in src.columns if c in ("doc_id", "page", *keep)]
    by_label = any(kind in ("matches", "value", "inline", "block", "total", "undated") for kind, _ in rules.values())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            size = np.cumsum(b.column("W").value_lengths().to_numpy())
            while done < b.num_rows:
                before = size[done - 1] if done else 0
                n = max(1, int(np.searchsorted(size, before + WORDS_AT_ONCE, "right")) - done)
                part = b.slice(done, n)
                done += n
                words = Words(part.column("W"), part.column("lh").to_numpy(zero_copy_only=False))
                found = words.matches() if by_label else None
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *(column_of(words, found, *r) for r in rules.values())],
                                                 names=[*carried, *rules])

    schema = StructType([src.schema[c] for c in carried])
    for name, (kind, _) in rules.items():
        schema = schema.add(name, ArrayType.fromDDL(TYPES.get(kind, "array<string>")))
    return src.mapInArrow(task, schema)
