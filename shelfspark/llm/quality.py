"""Quality rules as a short-circuit cascade (DataFrame functions only).

Each rule rejects a document by one predicate over counters of its text. A
sample tells what each rule costs and how many documents it rejects; the rules
are then chained in descending order of rejection per cost, so that most bad
documents meet a cheap, selective rule first and the costly rules run only for
what is left (CASE WHEN stops at the first hit). The order changes the cost,
never the verdict: a document is rejected if any rule rejects it. The counters
are returned columns, so they are worked out for every document and once in the
sample, before the rules are timed; what is timed and short-circuited is what a
rule does beyond them.

Null and empty texts count as no words and no lines with a word; extra columns
pass through untouched unless they carry the name of an output column, which
is then replaced; repeated rows are judged one by one.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import unused
from shelfspark.session import written

#: The six white-space characters of the contract: space and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
COUNTERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WORKING = ("_text", "_words", "_lines", "_windows", "_sorted", "_twice")
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """``reject`` maps the working columns (text, words, counters) to a boolean."""

    name: str
    reject: Column


def default_rules() -> list[Rule]:
    words = F.greatest(F.size("_words"), F.lit(1))
    return [
        Rule("symbols", F.col("n_symbols") > 0.1 * F.col("word_chars")),
        Rule("word_length", (F.col("word_chars") > 25 * words) | (F.col("word_chars") < 2 * words)),
        Rule("repeated_lines", F.col("n_dup_lines") > 0.3 * F.size("_lines")),
        Rule("few_letters", F.size(F.filter("_words", lambda w: w.rlike("\\p{L}"))) < 0.6 * words),
        Rule("few_distinct_words", F.size(F.array_distinct("_words")) < 0.05 * words),
        Rule("long_lines", F.length(F.col("_text")) > 40_000 * F.greatest(F.size("_lines"), F.lit(1))),
    ]


def with_counters(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_text``, ``_words``, ``_lines`` and the counters of the contract.

    ``n_repeat_words`` counts the words that lie in a three-word window which
    the text holds twice or more. Windows are 64-bit hashes of their words;
    only texts with a repeated window sort them.
    """
    out = docs.drop(*COUNTERS).withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    trimmed = F.btrim("_text", F.lit(SPACE))
    out = out.withColumn("_words", F.when(trimmed == "", F.array().cast("array<string>"))
                         .otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1)))
    n = F.size("_words")
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("_windows", windows)
    out = out.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_sorted", lambda x, i: (F.coalesce(F.get("_sorted", i - 1)["h"] == x["h"], F.lit(False)))
                     | (F.coalesce(F.get("_sorted", i + 1)["h"] == x["h"], F.lit(False))))
    out = out.withColumn("_twice", F.transform(twice, lambda x: x["i"]))
    covered = F.array_distinct(F.flatten(F.transform("_twice", lambda p: F.array(p, p + 1, p + 2))))
    return out.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        "n_symbols": (F.size(F.split("_text", SYMBOLS, -1)) - 1).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("_sorted").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long"),
    }).drop("_windows", "_sorted", "_twice")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measured(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule over the sample; each time
    is the better of two runs, less the time of a job that reads the same
    columns and applies no rule."""

    def run(reject: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            began = time.perf_counter()
            share = sample.agg(F.avg(reject.cast("double")), F.sum(F.size("_words")), F.sum(F.size("_lines")),
                               F.sum(F.length("_text"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - began)
        return best, share

    idle, _ = run(F.lit(False))
    return [(r, max(s - idle, 1e-4), share) for r in rules for s, share in [run(F.coalesce(r.reject, F.lit(False)))]]


def ordered(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in descending order of rejection per cost on a random sample of
    about ``sample_rows`` documents (all of a smaller table); ties by name."""
    n = docs.count()
    if not n:
        return sorted(rules, key=lambda r: r.name)
    part = docs.select(text).sample(fraction=min(1.0, sample_rows / n), seed=7)
    sample = written(with_counters(part, text).repartition(4), "rule-sample")
    figures = measured(sample, rules)
    return [r for r, _, _ in sorted(figures, key=lambda x: (-x[2] / x[1], x[0].name))]


def cascade(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Adds the counters, ``base_failed`` and ``kept`` to every document. Write
    the result before filtering by it: the planner would copy the counters'
    nested expressions into the filter many times."""
    # input columns that carry a working column's name stand aside
    aside = {c: unused(docs, f"{c}_aside") for c in docs.columns if c.lower() in WORKING}
    docs, text = docs.withColumnsRenamed(aside), aside.get(text, text)
    chain = ordered(docs, rules or default_rules(), text, sample_rows)
    verdict = F.when(base_failed(), F.lit(False))
    for rule in chain:
        verdict = verdict.when(F.coalesce(rule.reject, F.lit(False)), F.lit(False))
    out = with_counters(docs.drop("base_failed", "kept"), text)
    return out.withColumns({"base_failed": base_failed(), "kept": verdict.otherwise(F.lit(True))}) \
        .drop("_text", "_words", "_lines").withColumnsRenamed({v: k for k, v in aside.items()})
