"""Quality rules as a short-circuit cascade, ordered by measured rejection per cost.

Every rule is a SQL predicate that is true for a document to reject.  On a sample
the operator measures each rule's share of rejected documents and the time Spark
takes to evaluate it, sorts by share / time, and compiles the rules into one CASE in
that order: a rule is evaluated only for documents that all earlier ones let
pass.  The order decides cost, never the verdict, which is the conjunction.
Everything is a projection: no shuffle, no Python.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import words_column
from harborline.session import materialize

WINDOW = 5   # words in a repeated window


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: str   # SQL over the columns of features()


# Predicates over t (the text), w (its words) and the base statistics.
RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("capitals", "2 * char_length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]+', '')) > char_length(regexp_replace(t, '[^A-Za-zÀ-ÖØ-öø-ÿ]+', ''))"),
    Rule("exclamation", "5 * regexp_count(t, '!!') > n_words"),
    Rule("one_word", "4 * size(array_distinct(w)) < least(n_words, 100)"),
)


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and t, w, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Windows are compared by a 64-bit hash of their words within one document.  A
    text whose windows all differ - most - skips the sort.
    """
    k = WINDOW - 1
    step = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("t"))
    step = step.withColumn("w", F.expr(words_column("t")))
    step = step.withColumn("lines", F.expr(r"filter(split(t, '\n'), x -> trim(BOTH ' \t\n\u000B\u000C\r' FROM x) != '')"))
    window = ", ".join(f"w[i + {j}]" for j in range(WINDOW))
    step = step.withColumns({
        "n_words": F.expr("cast(size(w) AS bigint)"),
        "word_chars": F.expr("cast(char_length(array_join(w, '')) AS bigint)"),
        "n_symbols": F.expr("cast(char_length(regexp_replace(t, '[^#*$%&|<>]+', '')) AS bigint)"),
        "n_lines": F.expr("cast(size(lines) AS bigint)"),
        "n_dup_lines": F.expr("cast(size(lines) - size(array_distinct(lines)) AS bigint)"),
        "h": F.expr(f"CASE WHEN size(w) > {k} THEN transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64({window})) ELSE array() END"),
    })
    step = step.withColumn("s", F.expr(
        "CASE WHEN size(array_distinct(h)) < size(h) THEN sort_array(transform(h, (x, i) -> struct(x AS h, i AS i))) END"))
    step = step.withColumn("p", F.expr(
        "sort_array(transform(filter(s, (x, j) -> get(s, j - 1).h <=> x.h OR get(s, j + 1).h <=> x.h), x -> x.i))"))
    return step.withColumn("n_repeat_words", F.expr(
        f"coalesce(aggregate(transform(p, (x, j) -> least({WINDOW}, coalesce(get(p, j + 1) - x, {WINDOW}))), 0L, (a, x) -> a + x), 0L)")
    ).drop("lines", "h", "s", "p")


def order_rules(sample: DataFrame, rules: tuple[Rule, ...]) -> list[Rule]:
    """Rules by share of rejected sample rows per second of evaluation, best first."""
    total, *counts = sample.agg(F.count("*"), *[F.count_if(F.expr(r.rejects)) for r in rules]).first()

    def seconds(predicate: str) -> float:
        best = float("inf")
        for _ in range(2):
            began = time.perf_counter()
            sample.agg(F.count_if(F.expr(predicate))).first()
            best = min(best, time.perf_counter() - began)
        return best

    idle = seconds("n_words IS NULL")
    gain = {r.name: (n / max(1, total)) / max(1e-4, seconds(r.rejects) - idle) for r, n in zip(rules, counts)}
    return sorted(rules, key=lambda r: -gain[r.name])


def quality_cascade(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES,
                    base: str = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words", sample_rows: int = 2000) -> DataFrame:
    """``keep`` (default: all columns), the base statistics, base_failed and kept.

    The order of rules is fitted on at most ``sample_rows`` rows; all rows are
    judged.  NULL and empty texts have no words and fail the base rule.  Input
    columns travel in a struct, so their names cannot clash; added columns win
    over input columns of the same name.  Repeated rows are judged alike; an
    empty table gives an empty result.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    names = [c for c in (keep if keep is not None else docs.columns) if c not in added]
    packed = docs.select(F.struct(*names).alias("_row"), F.col(text).alias("_text"))
    # One hash class in 16 before the limit: a limit alone would gather sample_rows of every partition.
    some = packed.select("_text").where(F.pmod(F.xxhash64("_text"), F.lit(16)) == 0).limit(sample_rows)
    sample = materialize(features(some, [], "_text"), "rule_sample")
    ordered = order_rules(sample, rules)
    judged = features(packed, ["_row"], "_text").withColumn("base_failed", F.expr(base))
    case = "CASE WHEN base_failed THEN false " + " ".join(f"WHEN {r.rejects} THEN false" for r in ordered) + " ELSE true END"
    # A filter on the verdict must not be pushed below: it would copy the expressions of the
    # statistics into every place that reads them.  A generator of one row keeps it above.
    verdict = F.struct(*added[:-1], F.expr(case).alias("kept"))
    return judged.select("_row", F.inline(F.array(verdict))).select("_row.*", *added)
