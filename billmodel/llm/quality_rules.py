"""Quality rules as a short-circuit cascade, on built-in functions only.

A document is kept if no rule rejects it. Rules cost unequal amounts and reject
unequal shares, so each rule's time and share of rejections are first measured
on a bounded sample, and the rules are put in order of rejections per cost. The
verdict is one CASE over the ordered rules: a rule is evaluated only for rows
that no rule before it has rejected. The order changes the cost, never the
verdict, so the sample's size and bias do not reach the result.

Defined results: a null or empty text has no words and is rejected by the word
count; a rule that is null for a row does not reject it; null ids, repeated rows
and extra columns pass through; an empty table gives an empty result (and the
order in which the rules were given).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import BLANK, let

#: Words in a window, and rows that cost and selectivity are measured on.
WINDOW = 8
SAMPLE_ROWS = 1000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), "")


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[#*$%&|<>]")).cast("long")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{BLANK}]"))


def repeats(values: Column) -> Column:
    """How many elements equal an earlier one."""
    return (F.size(values) - F.size(F.array_distinct(values))).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows of ``window`` words that the text holds twice or more.

    Windows are compared by 64-bit hash. Few texts repeat one; only for those
    are the windows sorted with their positions."""
    def prints(h: Column) -> Column:
        return F.when(F.size(h) >= window, F.transform(F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, window))))

    def cover(at: Column) -> Column:
        # at: sorted starts of repeated windows; each adds what the next leaves
        def add(sum_: Column, i: Column) -> Column:
            return sum_ + F.least(F.lit(window), F.element_at(at, i + 1) - F.element_at(at, i)).cast("long")

        last = F.size(at)
        return F.when(last > 1, F.aggregate(F.sequence(F.lit(1), last - 1), F.lit(0).cast("long"), add)).otherwise(F.lit(0).cast("long")) + window

    def starts(s: Column) -> Column:
        def again(i: Column) -> Column:
            mine = F.element_at(s, i)["h"]
            return ((i > 1) & (F.try_element_at(s, F.greatest(i - 1, F.lit(1)))["h"] == mine)) | F.coalesce(F.try_element_at(s, i + 1)["h"] == mine, F.lit(False))

        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(1), F.size(s)), again), lambda i: F.element_at(s, i)["i"]))

    def count(p: Column) -> Column:
        ordered = F.sort_array(F.transform(p, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(p)) < F.size(p), let(let(ordered, starts), cover)).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.coalesce(let(let(hashes, prints), count), F.lit(0).cast("long"))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words of every whole text."""
    text = F.col(f"`{text_col}`").cast("string")
    made = docs.withColumn("__words", words_of(text)).withColumn("__lines", lines_of(text))
    return made.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": word_chars(F.col("__words")),
        "n_symbols": symbols(text),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": repeats(F.col("__lines")),
        "n_repeat_words": repeated_words(F.col("__words")),
    }).drop("__words", "__lines")


@dataclass(frozen=True)
class Rule:
    """Rejects rows where ``rejects`` is true. ``rejects`` may use columns of the
    table or work its measure out from the text itself."""

    name: str
    rejects: Column


def text_rules(text_col: str = "text") -> list[Rule]:
    """The rules on bare texts: each works out only what it needs."""
    text = F.col(f"`{text_col}`").cast("string")
    words = words_of(text)
    n = F.size(words)
    return [
        Rule("few_words", n < 20),
        Rule("repeated_words", let(words, lambda w: 100 * repeated_words(w) > 30 * F.size(w))),
        Rule("symbols", symbols(text) > n),
        Rule("word_length", let(words, lambda w: (word_chars(w) > 15 * F.size(w)) | (word_chars(w) < 2 * F.size(w)))),
        Rule("repeated_lines", let(lines_of(text), lambda x: 100 * repeats(x) > 50 * F.size(x))),
    ]


def measured_rules() -> list[Rule]:
    """The same rules on the columns of ``measured``."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        Rule("few_words", n < 20),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 30 * n),
        Rule("symbols", F.col("n_symbols") > n),
        Rule("word_length", (chars > 15 * n) | (chars < 2 * n)),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    ]


def ordered(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """``rules`` by rejections per cost on ``sample``, best first."""
    kept = sample.cache()
    try:
        rows = kept.count()
        if not rows or len(rules) < 2:
            return rules

        def seconds(column: Column) -> tuple[float, int]:
            took = []
            for _ in range(2):  # the first run also compiles
                began = time.perf_counter()
                (n,) = kept.agg(F.count_if(column)).first()
                took.append(time.perf_counter() - began)
            return took[-1], n

        idle, _ = seconds(F.lit(True))
        worth = {}
        for r in rules:
            cost, rejected = seconds(F.coalesce(r.rejects, F.lit(False)))
            worth[r.name] = rejected / rows / max(cost - idle, 1e-3)
        return sorted(rules, key=lambda r: -worth[r.name])
    finally:
        kept.unpersist()


def cascade(rules: list[Rule]) -> Column:
    """Name of the first of ``rules`` that rejects the row, else null."""
    out = F.when(F.coalesce(rules[0].rejects, F.lit(False)), F.lit(rules[0].name))
    for r in rules[1:]:
        out = out.when(F.coalesce(r.rejects, F.lit(False)), F.lit(r.name))
    return out


def quality_rules(docs: DataFrame, text_col: str = "text", with_measures: bool = False, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``kept`` and ``rejected_by`` (the rule in cascade order that
    rejected the row; which one depends on the measured order), and with the
    columns of ``measured`` if asked for; the rules then read those columns, so
    that nothing is worked out twice."""
    order = [r.name for r in ordered(docs.select(text_col).limit(sample_rows), text_rules(text_col))]
    by_name = {r.name: r for r in (measured_rules() if with_measures else text_rules(text_col))}
    judged = (measured(docs, text_col) if with_measures else docs).withColumn("rejected_by", cascade([by_name[n] for n in order]))
    return judged.withColumn("kept", F.col("rejected_by").isNull())
