"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

Each rule rejects on a condition. On a sample, the time a rule takes and the share
of rows it rejects are measured; rules then run in the order of rejection per
cost, and a row that one rule rejects is not put to the later ones. The order
changes the time, never the verdict.

Words are what stands between the six white-space characters of ASCII. Repeated
windows are found per text by sorting its windows with their places, so that no
row meets another.

Defined results: a null text has no words and fails the base rule, as an empty
one does. A rule whose condition is null rejects nothing. Rows are judged one by one:
equal ones get equal verdicts, rows without an id theirs, an empty table an empty
result. A text of any length is read whole, within its own row. Columns of the input
stay, but for those named as a count or verdict (``n_words``, ``word_chars``,
``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``), which are
replaced, and names that begin with ``_rule_``, which are reserved.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]+"

#: Share of rows looked at, and rows at most, to estimate cost and selectivity.
SAMPLE_SHARE, SAMPLE_ROWS = 0.02, 2000

#: Columns that only the rules see.
WORDS, LINES = "_rule_words", "_rule_lines"


class Rule(NamedTuple):
    """Rows for which ``rejects`` holds go."""

    name: str
    rejects: Column


class Estimate(NamedTuple):
    name: str
    seconds: float
    rejected: float

    @property
    def merit(self) -> float:
        return self.rejected / max(self.seconds, 1e-4)


def measured(docs: DataFrame, text: str = "text", window: int = 3) -> DataFrame:
    """``docs`` with its words (array) and counts.

    Added: _rule_words, _rule_lines (number of lines with a word), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({
        WORDS: F.filter(F.split(body, _SPACE), lambda w: w != ""),
        "_rule_texts": lines,
        "n_symbols": (F.length(body) - F.length(F.regexp_replace(body, _SYMBOLS, ""))).cast("long"),
    })
    return out.withColumns({
        "n_words": F.size(WORDS).cast("long"),
        "word_chars": F.length(F.array_join(WORDS, "")).cast("long"),
        LINES: F.size("_rule_texts").cast("long"),
        "n_dup_lines": (F.size("_rule_texts") - F.size(F.array_distinct("_rule_texts"))).cast("long"),
        "n_repeat_words": _repeated(F.col(WORDS), window).cast("long"),
    }).drop("_rule_texts")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column, window: int) -> Column:
    """Words in windows that the array holds twice or more."""

    def windows(w: Column) -> Column:
        starts = F.slice(w, 1, F.greatest(F.size(w) - (window - 1), F.lit(0)))
        text_of = lambda x, i: F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, window)])
        return F.array_sort(F.transform(starts, lambda x, i: F.struct(text_of(x, i).alias("w"), i.alias("i"))))

    def again(near: Column) -> Column:
        same = lambda e, i: (e["w"] == F.get(near, i - 1)["w"]) | (e["w"] == F.get(near, i + 1)["w"])
        return F.transform(F.filter(near, same), lambda e: e["i"])

    # words covered by windows that start at the repeated places
    return F.aggregate(
        F.array_sort(_let(words, lambda w: _let(windows(w), again))),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct(
            (i + window).alias("end"), (a["n"] + i + window - F.greatest(i, a["end"])).alias("n")
        ),
        lambda a: a["n"],
    )


def base_failed(least_words: int = 50, repeated_percent: int = 50) -> Column:
    words = F.col("n_words")
    return (words < least_words) | (100 * F.col("n_repeat_words") > repeated_percent * words)


def standard_rules() -> list[Rule]:
    """Rules on the counts of :func:`measured` and on its words."""
    words, n = F.col(WORDS), F.col("n_words")

    def more(part: Column, percent: int) -> Column:
        return 100 * part > percent * n

    return [
        Rule("symbols", more(F.col("n_symbols"), 10)),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.col(LINES)),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("letterless_words", more(F.size(F.filter(words, lambda w: ~w.rlike(r"\p{L}"))), 30)),
        Rule("shouting", more(F.size(F.filter(words, lambda w: w.endswith("!"))), 30)),
        Rule("capitals", more(F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}{2,}"))), 50)),
        Rule("few_words_again_and_again", 20 * F.size(F.array_distinct(words)) < n),
    ]


def estimate(docs: DataFrame, rules: list[Rule], text: str = "text") -> list[Estimate]:
    """Seconds and share of rejected rows of each rule, on a sample of bounded size.

    Only sampled rows are counted, once, before the rules are timed on them.
    """
    sample = measured(docs.sample(fraction=SAMPLE_SHARE, seed=1).limit(SAMPLE_ROWS), text).persist()
    try:
        total = sample.count()
        found = []
        for rule in rules:
            began = time.perf_counter()
            hits = sample.agg(F.count_if(rule.rejects)).first()[0]
            found.append(Estimate(rule.name, time.perf_counter() - began, hits / total if total else 0.0))
        return found
    finally:
        sample.unpersist()


def ordered(rules: list[Rule], estimates: list[Estimate]) -> list[Rule]:
    """Rules by rejection per cost, best first; equal ones stay as they are."""
    merit = {e.name: e.merit for e in estimates}
    return sorted(rules, key=lambda r: -merit.get(r.name, 0.0))


def verdict(rules: list[Rule]) -> Column:
    """True where no rule rejects; the first that rejects ends the evaluation."""
    out = None
    for rule in rules:
        out = (F if out is None else out).when(rule.rejects, False)
    return out.otherwise(True) if out is not None else F.lit(True)


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with its counts, ``base_failed`` and ``kept``."""
    rules = standard_rules() if rules is None else rules
    counted = measured(docs, text)
    order = ordered(rules, estimate(docs, rules, text))
    fails = base_failed()
    return counted.withColumns({
        "base_failed": fails,
        "kept": verdict([Rule("base", fails), *order]),
    }).drop(WORDS, LINES)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).drop("text")

