"""Quality rules as a short-circuit cascade, native: DataFrame and SQL functions only.

Each rule is a predicate that rejects a text. On a bounded sample every rule's cost (seconds a row, timed) and selectivity
(share rejected) are estimated; the cascade then asks the rules in falling order of rejection per cost inside one CASE,
so a rejected text never reaches the dearer rules. The order changes what is spent, never which texts are kept.
"""

from __future__ import annotations

import contextlib
import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that separates words: space and U+0009 to U+000D.
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8
#: Rows that the estimates are made on.
SAMPLE_ROWS = 2000
#: Files that they are drawn from, and timings of each rule.
SAMPLE_FILES = 8
TIMINGS = 2


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text; null or blank: an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of 8 words that occur at least twice; windows are compared by 64-bit hashes.

    Window hashes come from doubling (pairs, fours, eights). Only texts with a repeated hash sort (hash, place) pairs and
    measure the union of the repeated windows, so the work is n log n for any text.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")

    def doubled(step: int):
        return lambda h: F.zip_with(F.slice(h, 1, F.size(h) - step), F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))

    def places(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = _let(pairs, lambda p: F.filter(p, lambda x, i: F.get(p, i - 1)["h"].eqNullSafe(x["h"]) | F.get(p, i + 1)["h"].eqNullSafe(x["h"])))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.aggregate(F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p)), lambda a, b: F.least(b - a, F.lit(window))), F.lit(0), lambda s, g: s + g)
        return gaps + window

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(places(h), covered))

    h: Column = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1 << i for i in range(window.bit_length() - 1)):
        h = _let(h, doubled(step))
    return F.when(F.size(words) <= window, 0).otherwise(_let(h, counted)).cast("long")


class Parts:
    """What rules look at, each a column: given where it is a column already, else computed where a rule asks for it."""

    def __init__(self, text: Column, words: Column, lines: Column, **known: Column):
        self.text, self.words, self.lines, self.known = text, words, lines, known

    def _get(self, name: str, make: Callable[[], Column]) -> Column:
        return self.known[name] if name in self.known else make()

    n_words = property(lambda self: self._get("n_words", lambda: F.size(self.words).cast("long")))
    word_chars = property(lambda self: self._get("word_chars", lambda: word_chars(self.words)))
    n_symbols = property(lambda self: self._get("n_symbols", lambda: n_symbols(self.text)))
    n_dup_lines = property(lambda self: self._get("n_dup_lines", lambda: n_dup_lines(self.lines)))
    n_repeat_words = property(lambda self: self._get("n_repeat_words", lambda: n_repeat_words(self.words)))


@dataclass(frozen=True)
class Rule:
    """rejects(parts): true for a text to drop; null counts as false."""

    name: str
    rejects: Callable[[Parts], Column]


def base_failed(n_words: Column, repeat: Column) -> Column:
    return (n_words < 20) | (100 * repeat > 30 * n_words)


def rules(min_words: int = 20) -> list[Rule]:
    """The rules of this engine's filter; thresholds are fixed and documented, all on whole texts.

    short: under min_words words. repeats: over 30 % of the words in repeated 8-word windows. symbols: more than one marker
    character for ten words. word_length: mean word under 2 or over 12 characters. lines: over 40 % of the lines
    with a word repeat an earlier one (three lines at least). letters: under 60 % of the words hold a letter. shouting: over
    60 % of the words end in '!!' or more. vocabulary: 100 words or more of which under 12 % differ; beyond 2,000 words the
    bound falls with the root of the length, since long prose repeats its words (5,400 different ones in a million).
    """

    def vocabulary(p: Parts) -> Column:
        different = F.size(F.array_distinct(p.words)).cast("long")
        return (p.n_words >= 100) & (100 * different < 12 * p.n_words) & (10 * different * different < 288 * p.n_words)

    return [
        Rule("short", lambda p: p.n_words < min_words),
        Rule("symbols", lambda p: 10 * p.n_symbols > p.n_words),
        Rule("word_length", lambda p: (p.word_chars < 2 * p.n_words) | (p.word_chars > 12 * p.n_words)),
        Rule("lines", lambda p: (F.size(p.lines) >= 3) & (10 * p.n_dup_lines > 4 * F.size(p.lines))),
        Rule("shouting", lambda p: 10 * F.size(F.filter(p.words, lambda x: x.endswith("!!"))) > 6 * p.n_words),
        Rule("letters", lambda p: 10 * F.size(F.filter(p.words, lambda x: x.rlike(r"\p{L}"))) < 6 * p.n_words),
        Rule("vocabulary", vocabulary),
        Rule("repeats", lambda p: 100 * p.n_repeat_words > 30 * p.n_words),
    ]


def prepare(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """text, words and lines beside the columns asked for by callers."""
    text = F.col(f"`{text_col}`")
    return docs.select("*", words_of(text).alias("words"), lines_of(text).alias("lines"))


def _sample(docs: DataFrame, text_col: str, rows: int) -> DataFrame:
    """About ``rows`` texts: a share of the rows of a few files spread over the table, or of all rows where it is no file scan."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    files = sorted(docs.inputFiles()) if "_metadata" not in docs.columns else []
    if len(files) > SAMPLE_FILES:
        chosen = [files[i * len(files) // SAMPLE_FILES] for i in range(SAMPLE_FILES)]
        with contextlib.suppress(AnalysisException):  # a frame that is no plain scan has no such column
            part = docs.where(F.col("_metadata.file_path").isin(chosen)).select(F.col(f"`{text_col}`").alias("text"))
            n = part.count()
            if n >= rows:
                return part.sample(rows / n, 1)
    n = texts.count()
    return texts if n <= rows else texts.sample(rows / n, 1)


def order_rules(docs: DataFrame, text_col: str = "text", own: list[Rule] | None = None, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules in the order of the cascade: at each step the one that rejects most of what the rules before it leave, per cost.

    Both are estimated on about ``rows`` rows of docs, which stay on the executors. What rules reject together is counted
    once; costs are the least of some timings after a first one that compiles the rule, in powers of two, so that small
    differences between runs do not turn the order. An empty table: as given.
    """
    own = rules() if own is None else own
    sample = prepare(_sample(docs, text_col, rows)).persist()
    try:
        if not sample.count():
            return own
        parts = Parts(F.col("text"), F.col("words"), F.col("lines"))
        fails = [F.coalesce(rule.rejects(parts), F.lit(False)) for rule in own]

        def timed(what: Column) -> float:
            began = time.perf_counter()
            sample.agg(F.count_if(what)).first()
            return time.perf_counter() - began

        least = lambda what: min(timed(what) for _ in range(1 + TIMINGS))  # the first run compiles and never is the least
        idle = least(F.lit(True))
        cost = [2.0 ** round(math.log2(max(least(f) - idle, 1e-3))) for f in fails]
        together = [(r["f"], r["n"]) for r in sample.select(F.array(*fails).alias("f")).groupBy("f").agg(F.count("*").alias("n")).collect()]
    finally:
        sample.unpersist()
    out: list[int] = []
    while len(out) < len(own):
        left = [(f, n) for f, n in together if not any(f[i] for i in out)]
        gain = {i: sum(n for f, n in left if f[i]) / cost[i] for i in range(len(own)) if i not in out}
        out.append(max(gain, key=lambda i: (gain[i], -cost[i], -i)))
    return [own[i] for i in out]


def verdict(ordered: list[Rule], parts: Parts) -> Column:
    """Name of the first rule in order that rejects, else null; CASE stops at the first hit."""
    fails = lambda rule: F.coalesce(rule.rejects(parts), F.lit(False))
    out = F.when(fails(ordered[0]), F.lit(ordered[0].name))
    for rule in ordered[1:]:
        out = out.when(fails(rule), F.lit(rule.name))
    return out


def filter_documents(docs: DataFrame, text_col: str = "text", own: list[Rule] | None = None) -> DataFrame:
    """The rows of docs that no rule rejects, all columns kept; a null or empty text is short and goes.

    Repeated rows are judged alike; an empty table stays empty; columns may have any names. Words and lines are bound
    inside the one filter expression: as columns they would be inlined, and split anew, wherever a rule names them.
    """
    ordered = order_rules(docs, text_col, own)
    text = F.col(f"`{text_col}`")
    parts = F.struct(text.alias("t"), words_of(text).alias("w"), lines_of(text).alias("l"))
    return docs.where(_let(parts, lambda s: verdict(ordered, Parts(s["t"], s["w"], s["l"])).isNull()))


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for every row of docs.

    kept: not base_failed and no rule of the cascade rejects. The counts are asked for every row, so the rules read them;
    short and repeats are base_failed itself. Null text: no words, so base_failed. Repeated rows each get
    their row; null doc_ids pass through; other columns are ignored; no rows give no rows.
    """
    ordered = [r for r in order_rules(docs) if r.name not in ("short", "repeats")]
    rows = prepare(docs.select("doc_id", "text"))
    counted = rows.select(
        "doc_id", "text", "words", "lines",
        F.size("words").cast("long").alias("n_words"), word_chars(F.col("words")).alias("word_chars"), n_symbols(F.col("text")).alias("n_symbols"),
        n_dup_lines(F.col("lines")).alias("n_dup_lines"), n_repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    parts = Parts(F.col("text"), F.col("words"), F.col("lines"), **{n: F.col(n) for n in names})
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return counted.select("doc_id", *names, failed.alias("base_failed"), F.when(failed, False).otherwise(verdict(ordered, parts).isNull()).alias("kept"))


MEASURE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
w AS (SELECT k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT k, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g FROM (SELECT k, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM g) WHERE n > 1),
c AS (SELECT k, CAST(sum(least(coalesce(nxt - i, 8), 8)) AS BIGINT) AS n_repeat_words FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nxt FROM r) GROUP BY k),
m AS (SELECT w.k, doc_id, ws, ls, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN c USING (k)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR (len(ls) >= 3 AND 10 * n_dup_lines > 4 * len(ls))
    OR 10 * len(list_filter(ws, lambda x: ends_with(x, '!!'))) > 6 * n_words
    OR 10 * len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) < 6 * n_words
    OR (n_words >= 100 AND 100 * len(list_distinct(ws)) < 12 * n_words AND 10 * len(list_distinct(ws)) * len(list_distinct(ws)) < 288 * n_words)) AS kept
FROM b
"""
