"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Fixed base rules reject a document outright. Beyond them, each rule compares one measure with a cutoff of the
document's stratum (its length class). A cutoff is allowed if, among the stratum's labelled good documents that
pass the base rules, so few would be rejected that a true false-rejection rate above the rule's share of ``risk`` is
ruled out by the exact binomial tail. Cutoffs are tried from the mildest on, and the first that fails its test ends
the sequence, so one level per rule and stratum holds for all its cutoffs; ``delta`` is divided by the number of
rules and strata. With probability ``1 - delta``, no stratum loses more than ``risk`` of its good documents to all its
rules together.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, lgamma, log, log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, id_and_text, materialise

WORD_BREAK = r"[ \t-\r]+"
LENGTH_CLASSES = (150, 500)
RISK, DELTA = 0.05, 0.05

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Reject if the measure is above (or, with ``above`` false, below) the cutoff."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]
    above: bool = True

    def fails(self, cutoff: float | Column) -> Column:
        value, limit = F.expr(self.measure), cutoff if isinstance(cutoff, Column) else F.lit(float(cutoff))
        return value > limit if self.above else value < limit


# Candidate cutoffs are parameters, fixed before any label is seen; mild ones first. No divisor is 0: Spark works out what
# several strata share before it looks at the base rules, also for texts without words.
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", (0.8, 0.4, 0.2, 0.1, 0.05, 0.02)),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", (0.7, 0.5, 0.3, 0.2, 0.1)),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", (0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("long_words", "word_chars / greatest(n_words, 1)", (20.0, 12.0, 10.0, 9.0, 8.0, 7.0)),
    Rule("short_words", "word_chars / greatest(n_words, 1)", (2.0, 2.5, 3.0, 3.5, 4.0), above=False),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", (0.7, 0.5, 0.3, 0.2, 0.1)),
    Rule("exclamations", "n_exclamations / greatest(n_words, 1)", (0.6, 0.3, 0.1, 0.05, 0.02)),
)


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def with_measures(rows: DataFrame, text_col: str = TEXT) -> DataFrame:
    """Add the measures of each text. All work stays inside the row and is linear but for one sort.

    Windows of three words are told apart by 64-bit hash. Those found twice stand next to each other after a
    sort by hash and place; the words they cover are counted by walking over their places in order.
    """
    text = F.col(text_col)
    words = F.filter(F.split(text, WORD_BREAK, -1), lambda word: word != "")
    cut = rows.withColumn("words", F.explode(F.array(words)))
    hashes = (
        "transform(sequence(2, n_words - 1), i -> struct(xxhash64(words[i - 2], words[i - 1], words[i]) AS h, i AS p))"
    )
    # The outer one-element transform gives the sorted array a name, so that it is made once, not per element.
    repeated = f"""
        CASE WHEN n_words < 4 THEN array()
        ELSE element_at(transform(array(array_sort({hashes})), s -> sort_array(transform(
            filter(sequence(0, n_words - 3), k -> (k > 0 AND s[k].h = s[greatest(k - 1, 0)].h)
                OR (k < n_words - 3 AND s[k].h = s[least(k + 1, n_words - 3)].h)),
            k -> s[k].p))), 1)
        END"""
    covered = """
        aggregate(repeated, struct(cast(0 AS bigint) AS n, cast(-9 AS int) AS last),
            (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n)"""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^ \t-\r]"))
    return (
        cut.withColumn("n_words", F.size("words"))
        .withColumn("repeated", F.expr(repeated))
        .withColumn("lines", F.explode(F.array(lines)))
        .select(
            *[F.col(c) for c in rows.columns if c != text_col],
            F.col("n_words").cast("bigint").alias("n_words"),
            F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
            _length_without(text, r"[^#*$%&|<>]+").cast("bigint").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
            F.expr(covered).alias("n_repeat_words"),
            F.size("lines").cast("bigint").alias("n_lines"),
            _length_without(text, r"\P{Lu}+").cast("bigint").alias("n_capitals"),
            _length_without(text, r"[^!]+").cast("bigint").alias("n_exclamations"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def stratum(classes: tuple[int, ...] = LENGTH_CLASSES) -> Column:
    """The document's length class, from 0: how many of the bounds its words reach."""
    return sum((F.col("n_words") >= bound).cast("int") for bound in classes)


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) of n trials with rate p, exact to rounding.

    The terms are summed from the largest of them, at the mode or at k, to both sides, in proportion to it: none
    overflows, and each side ends where terms no longer count.
    """
    if k >= n:
        return 1.0

    def term(i: int) -> float:
        return lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p)

    peak = min(k, int((n + 1) * p))
    top, total = term(peak), 0.0
    for side in (range(peak, -1, -1), range(peak + 1, k + 1)):
        for i in side:
            share = exp(term(i) - top)
            total += share
            if share < 1e-25:
                break
    return min(1.0, exp(top + log(total)))


def choose_cutoffs(
    measured: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = RISK, delta: float = DELTA,
    classes: tuple[int, ...] = LENGTH_CLASSES,
) -> dict[tuple[int, str], float]:
    """The strictest allowed cutoff by stratum and rule; a pair without one has no cutoff and rejects nothing.

    Counts come from one aggregate over all labelled documents: strata times cutoffs numbers reach the driver.
    Null ids and labels other than 1 are left out.
    """
    good = labels.filter("quality = 1").select(F.col("doc_id").alias(ID)).filter(F.col(ID).isNotNull()).distinct()
    held = measured.join(good, ID).filter(~base_failed()).withColumn("stratum", stratum(classes))
    counts = [
        F.count_if(rule.fails(cutoff)).alias(f"{rule.name}_{i}")
        for rule in rules
        for i, cutoff in enumerate(rule.cutoffs)
    ]
    rows = held.groupBy("stratum").agg(F.count("*").alias("n"), *counts).collect()
    level = delta / ((len(classes) + 1) * len(rules))
    chosen = {}
    for row in rows:
        for rule in rules:
            for i, cutoff in enumerate(rule.cutoffs):
                if binomial_tail(row["n"], row[f"{rule.name}_{i}"], risk / len(rules)) > level:
                    break
                chosen[row["stratum"], rule.name] = cutoff
    return chosen


def verdict(chosen: dict[tuple[int, str], float], rules: tuple[Rule, ...] = RULES) -> Column:
    """True for documents that some rule with a cutoff in their stratum rejects."""
    by_name = {rule.name: rule for rule in rules}
    failing = [(F.col("stratum") == s) & by_name[name].fails(cutoff) for (s, name), cutoff in sorted(chosen.items())]
    rejected = F.lit(False)
    for fails in failing:
        rejected = rejected | F.coalesce(fails, F.lit(False))
    return rejected


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Columns ``doc_id``, the measures, ``stratum``, ``base_failed`` and ``kept``; one row per input row.

    Texts are read once: the measures are written, and the cutoffs and the verdicts work on those numbers. Null and
    empty texts have no words and fail the base rules. Without labels only the base rules reject.
    """
    measured = materialise(with_measures(id_and_text(docs)), "measures")
    chosen = choose_cutoffs(measured, labels, risk=risk, delta=delta)
    judged = measured.withColumn("stratum", stratum()).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & ~verdict(chosen)).withColumnRenamed(ID, "doc_id")
